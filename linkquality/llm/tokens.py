"""Exact token ids of whole texts, with a word memo in front of the tokenizer.

A byte-level BPE vocabulary of this kind cuts a text before every single
space that stands between two visible characters, around a line feed that
does, and before a last stop or comma behind a letter, and encodes the pieces
one by one.  Texts repeat most of their words, so Arrow numbers the different
pieces of a slice of texts, each Python worker remembers the ids of the pieces
it has met and asks the ``tokenizers`` library only for new ones, many in one
call.  A text in which some piece begins or ends in anything unusual (double
spaces, tabs, other white space, marks outside ASCII), or that holds the
string of an added token, is handed to the library whole.  ``tests/llm`` holds
both ways against each other.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Iterator
from operator import attrgetter

from .common import held

TOKENIZER = "byte_bpe_50k.json"
SLICE_BYTES, SLICE_ROWS = 4 << 20, 4096     # of text, encoded at once
NEW_PIECES = 32                             # handed to the library in one call


def default_path() -> str:
    """The vocabulary file installed beside the libraries."""
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: the
    visible Latin-1 characters for themselves, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = byte_letters()
LETTERS = "".join(BYTE_LETTERS[b] for b in range(256))
FEED, SPACE = BYTE_LETTERS[10], BYTE_LETTERS[32]
ACROSS = re.compile(r"\S[ \n]|\n\S|[^\W\d_][.,]|\ufffd[.,]")
ID = attrgetter("id")
LONG_CUT = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def _plain(ch: str) -> bool:
    return "!" <= ch <= "~" or ch.isalnum()


class Encoder:
    """``encode_all(texts)``: the ids of each text as little-endian uint32 bytes.

    ``memo_words`` bounds the memory of the memo (about 60 bytes a word, and
    the words of one slice); of a full one the pieces met last stay.
    Words of letters, with a stop or comma or without, are pieces to the
    vocabulary's pre-tokenizer and go straight to its BPE model.  A vocabulary
    that does not cut texts like this (seen from its tokens and tried on a
    sample) is used plainly.
    """

    def __init__(self, path: str, memo_words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # texts with the string of an added token are never cut
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo_words, self.model = memo_words, self.tokenizer.model
        sample = "Plain words, and É ones.\nIt's 2 (two) \"lines\" of x1."
        try:
            self.memo = self._cuts_at_blanks()
            self.memo = self.memo and self.encode(sample) == self.whole(sample)
        except Exception:       # another kind of model: its own way of failing
            self.memo = False

    def _cuts_at_blanks(self) -> bool:
        """Whether no token goes on from a visible character to a blank or
        line feed, from a line feed to a visible character or from a letter to
        a stop, so that pieces don't touch each other's ids."""
        import numpy as np
        import pyarrow as pa
        tokens = self.tokenizer.get_vocab(with_added_tokens=False)
        byte = {ch: b for b, ch in BYTE_LETTERS.items()}
        texts = (bytes(map(byte.__getitem__, t)).decode("utf-8", "replace")
                 for t in tokens if SPACE in t[1:] or FEED in t or "." in t[1:] or "," in t[1:])
        if (not {SPACE, FEED} <= tokens.keys() or any(re.search(ACROSS, t) for t in texts)
                or any(" " in t or "\n" in t for t in self.added)):
            return False
        self.heads = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.heads[[i for t, i in tokens.items() if t[0] in (SPACE, FEED)]] = True
        # the memo: pieces, their numbers of ids, those one behind another, when met
        self.known, self.sizes = pa.array([".", ","]), np.ones(2, np.int32)
        self.ids = np.frombuffer(self.whole(".") + self.whole(","), "<u4")
        self.met, self.now = np.zeros(2, np.int32), 0
        return len(self.ids) == 2

    def whole(self, text: str) -> bytes:
        import numpy as np
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def _new(self, pieces: list[str]):
        """Ids of pieces, each a blank or line feed and a word: an order of
        the pieces, in it their numbers of ids (0 where a text can't be cut
        there) and all ids one behind another."""
        import numpy as np
        words, others, bad = [], [], []
        for k, piece in enumerate(pieces):
            if piece[1:].isalpha() or piece[-1] in ".," and piece[1:-1].isalpha():
                words.append(k)
            elif len(piece) > 1 and _plain(piece[1]) and _plain(piece[-1]):
                others.append(k)
            else:
                bad.append(k)
        good, ids = words + others, array("I")
        for kind in (words, others):
            for at in range(0, len(kind), NEW_PIECES):
                text = "".join([pieces[k] for k in kind[at:at + NEW_PIECES]])
                if kind is words:
                    letters = codecs.charmap_decode(text.encode(), "strict", LETTERS)[0]
                    ids.extend(map(ID, self.model.tokenize(letters)))
                else:
                    ids.extend(self.tokenizer.encode(text, add_special_tokens=False).ids)
        ids = np.array(ids, np.uint32)
        sizes = np.diff(np.flatnonzero(self.heads[ids]), append=len(ids))
        if len(sizes) != len(good):     # a vocabulary without a letter for some byte
            each = [np.frombuffer(self.whole(pieces[k]), "<u4") for k in good]
            sizes, ids = np.array([*map(len, each)], int), np.concatenate(each)
        return good + bad, np.concatenate([sizes, np.zeros(len(bad), int)]), ids

    def _places(self, pieces):
        """Each of an Arrow array's different pieces' place in the memo."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        self.now += 1
        if len(self.known) + len(pieces) > self.memo_words:
            keep = np.argsort(-self.met, kind="stable")[:max(self.memo_words // 2, 2)]
            keep = np.union1d(keep, (0, 1))
            self.ids = self._joined(keep)
            self.known, self.sizes, self.met = self.known.take(pa.array(keep)), self.sizes[keep], self.met[keep]
        found = pc.index_in(pieces, self.known)
        missing = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
        places = found.fill_null(0).to_numpy().copy()
        if len(missing):
            new = pieces.take(pa.array(missing))
            order, sizes, ids = self._new(new.to_pylist())
            places[missing[order]] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new.take(pa.array(order))])
            self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        self.met[places] = self.now
        return places

    def _joined(self, places):
        """The ids of the memo's pieces at these places, one behind another."""
        import numpy as np
        n, ends = self.sizes[places], np.cumsum(self.sizes, dtype=np.int64)
        upto = np.cumsum(n, dtype=np.int64)
        index = np.repeat((ends - self.sizes)[places] - upto + n, n)
        index += np.arange(len(index))
        return self.ids[index]

    def _slice(self, texts, leads: list[str]) -> list[bytes]:
        """Ids of the texts of an Arrow array.  A lead is a line feed before a
        text's beginning, a blank before a part from a text's middle."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        odd = np.zeros(len(texts), bool)        # encoded whole
        for token in self.added:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        led = pc.binary_join_element_wise(pa.array(leads), pc.if_else(pa.array(odd), "", texts), "")
        offsets = np.frombuffer(led.buffers()[1], np.int32, len(led) + 1)
        raw = np.frombuffer(led.buffers()[2], np.uint8, offsets[-1])
        blank = (raw == 32) | (raw == 10)
        stop = (raw == 46) | (raw == 44)
        stop[1:] &= ((raw[:-1] | 32) - 97) < 26
        stop[:-1] &= blank[1:]
        cuts = np.flatnonzero(blank | stop)
        pieces = pa.StringArray.from_buffers(
            len(cuts), pa.py_buffer(np.append(cuts, len(raw)).astype(np.int32)), led.buffers()[2])
        coded = pieces.dictionary_encode()
        places = self._places(coded.dictionary)[coded.indices.to_numpy()]
        n = self.sizes[places]
        ends = np.cumsum(n, dtype=np.int64)
        flat = self._joined(places).astype("<u4", copy=False).tobytes()
        first = np.searchsorted(cuts, offsets[:-1])
        odd |= np.logical_or.reduceat(n == 0, first)
        begin = (ends - n)[first]
        bounds = zip(odd.tolist(), leads, begin.tolist(), [*begin[1:].tolist(), int(ends[-1])])
        # the ids of a leading line feed are one, and not the text's
        return [self.whole(lead.strip("\n") + texts[k].as_py()) if whole
                else flat[4 * (a + (lead == "\n")):4 * b]
                for k, (whole, lead, a, b) in enumerate(bounds)]

    def _long(self, text: str) -> bytes:
        """Ids of a long text, in parts cut at blanks between plain letters."""
        import pyarrow as pa
        if any(t in text for t in self.added):
            return self.whole(text)
        out, at, lead = [], 0, "\n"
        while lead:
            m = LONG_CUT.search(text, at + SLICE_BYTES)
            part = text[at:m.start()] if m else text[at:]
            out += self._slice(pa.array([part], pa.string()), [lead])
            at, lead = (m.end(), " ") if m else (at, "")
        return b"".join(out)

    def encode_all(self, texts) -> Iterator[bytes]:
        """The ids of each text of an Arrow string array; none for null."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        texts = pc.fill_null(texts, "")
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        at = 0
        while at < len(sizes):
            upto = int(np.searchsorted(np.cumsum(sizes[at:at + SLICE_ROWS]), SLICE_BYTES, "right"))
            part = texts.slice(at, max(upto, 1))
            at += len(part)
            if not self.memo:
                yield from map(self.whole, part.to_pylist())
            elif not upto:
                yield self._long(part[0].as_py())
            else:
                yield from self._slice(part.cast(pa.string()), ["\n"] * len(part))

    def encode(self, text: str | None) -> bytes:
        import pyarrow as pa
        return next(self.encode_all(pa.array([text], pa.string())))


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    return held(("encoder", path), lambda: Encoder(path))
