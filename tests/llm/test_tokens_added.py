import numpy as np
from tokenizers import Tokenizer

from linkquality.llm.tokens import Encoder, default_path


def test_added_tokens_as_a_fresh_tokenizer_encodes_them():
    plain, enc = Tokenizer.from_file(default_path()), Encoder(default_path(), memo_words=500)
    for text in ("a <|endoftext|> x", "<|endoftext|>", "word<|endoftext|>word, <|endoftext|>.", "x <|endoftext|",
                 "a <|endoftext|>\nline two", "no token here", "<|endoftext|> x"):
        got = np.frombuffer(enc.encode(text), "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids, text
    assert np.frombuffer(enc.encode("a <|endoftext|> x"), "<u4").tolist() == [64, 220, 50256, 2124]
