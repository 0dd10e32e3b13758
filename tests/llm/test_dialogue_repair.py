import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
from linkquality.llm import dialogue_repair as dr

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(initials, required, truncated):
    """Cheapest, then ASCII-least, edits by relaxing every way to every
    (row, state) until nothing changes; insertions in front of each row and at
    the end."""
    nexts = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    here = {"": (0, "")}
    for i in range(len(initials) + 1):
        while True:
            grown = dict(here)
            for q, (cost, path) in here.items():
                for c in "ua":
                    if c in nexts[q]:
                        new = (cost + 2, path + "I")
                        grown[nexts[q][c]] = min(grown.get(nexts[q][c], new), new)
            if grown == here:
                break
            here = grown
        if i == len(initials):
            return min(v for q, v in here.items() if q in ("", "a"))
        after = {}
        for q, (cost, path) in here.items():
            ways = [(q, cost + 3, "D")]
            if not required[i]:
                ways += [(nexts[q][initials[i]], cost + truncated[i], "K")] if initials[i] in nexts[q] else []
                ways += [(nexts[q][c], cost + 2 + truncated[i], "R") for c in "ua" if c in nexts[q]]
            for to, new, e in ways:
                after[to] = min(after.get(to, (new, path + e)), (new, path + e))
        here = after


def brute(rows):
    """rows (conv, turn, role, text) after damage -> conv -> report."""
    chats = defaultdict(list)
    for conv, turn, role, text in rows:
        chats[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, chat in chats.items():
        chat.sort()
        seen, faults = set(), []
        for _, _, role, text in chat:
            end = text.rstrip(SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else
                          "" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[:1] for _, _, r, _ in chat]
        cost, audit = cheapest(initials, [f in ("blank", "duplicate") for f in faults],
                               [f == "truncated" for f in faults])
        lines, q, k = [], "", 0
        for e in audit:
            name = {"": "user", "s": "user", "u": "assistant", "a": "user"}[q]
            if e == "I":
                lines.append(name + ":")
            else:
                role, text = chat[k][2:]
                k += 1
                if e != "D":
                    lines.append((name if e == "R" else role) + ":" + text)
            if e != "D":
                q = lines[-1][:1]
        turns = {t for some, t, *_ in chat if some}
        n = Counter(faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_search_is_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(4000):
        n = rng.randint(0, 9)
        initials = [rng.choice("suuuaaat ") .strip() for _ in range(n)]
        required = [int(rng.random() < 0.2) for _ in range(n)]
        truncated = [not r and rng.random() < 0.3 for r in required]
        got = dr.search(dr.Rows(initials, required, truncated))
        assert got == cheapest(initials, required, truncated), (initials, required, truncated)


def test_estimate_never_exceeds_the_cost():
    rng = random.Random(2)
    names = {dr.START: "", dr.SYSTEM: "s", dr.USER: "u", dr.ASSISTANT: "a"}
    for _ in range(500):
        n = rng.randint(1, 7)
        rows = dr.Rows([rng.choice("sua") for _ in range(n)], [int(rng.random() < 0.2) for _ in range(n)], [False] * n)
        for start in names:
            for goal in (None, *names):
                got = dr.search(rows, start, goal)
                if got:
                    assert rows.estimate(0, start, goal) <= got[0]


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_blocks_change_nothing(size):
    rng = random.Random(size)
    for _ in range(400):
        n = rng.randint(1, 12)
        initials = [rng.choice("suaua") for _ in range(n)]
        required = [int(rng.random() < 0.25) * rng.randint(1, 3) for _ in range(n)]
        truncated = [not r and rng.random() < 0.3 for r in required]
        parts = [dr.solve_block(initials[i:i + size], required[i:i + size], truncated[i:i + size], False, i == 0)
                 for i in range(0, n, size)]
        cost, way, tail = dr.choose_states([{p[:2]: (p[2], p[4]) for p in b} for b in parts])
        edits = "".join(next(p[3] for p in b if p[:2] == w) for b, w in zip(parts, way)) + tail
        assert (cost, edits) == dr.search(dr.Rows(initials, required, truncated))


def test_long_runs_stay_cheap():
    for initials in ("u" * 256, "uua" * 85, "uas" * 85, "s" * 200, "a" * 255):
        rows = dr.Rows(list(initials), [0] * len(initials), [False] * len(initials))
        assert dr.search(rows) == cheapest(initials, [0] * len(initials), [False] * len(initials))


def report(df, **kw):
    rows = dr.faults(df)
    texts = {r.conv: r for r in dr.transcripts(dr.repair(rows, **kw)).collect()}
    counts = {r.conv: r for r in dr.fault_counts(rows).collect()}
    assert set(texts) == set(counts)
    return {c: (counts[c].gaps, counts[c].blank, counts[c].duplicate, counts[c].truncated, r.illegal, r.cost, r.audit,
                r.repaired_sha256) for c, r in texts.items()}


def chats(seed, convs=25, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            text = rng.choice(["Yes.", "No!", "ends", "  ", "", None, "a\nb? \t", f"t{t}.", "é。", "x" * 50 + "."])
            rows += [(c, rng.choice([t, t, t, None, 2 * t]), rng.choice(["user", "assistant", "system", "tool", "", None]),
                      text)] * rng.choice([1, 1, 1, 2])
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    rows += [(900, t, "user" if t % 2 else "assistant", f"Line {t}.") for t in range(700)]           # one long dialogue
    rows += [(901, 5, "user", "Again.")] * 300 + [(902, 3 * t, "user", "Same.") for t in range(300)]  # hot repeats
    return rows


@pytest.mark.parametrize("block_rows", [3, 256])
def test_repair_equals_brute_force(spark, block_rows):
    rows = chats(7)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, conv string, seq int").repartition(4)
    assert report(df, block_rows=block_rows) == brute(rows)
    assert report(df, block_bytes=60) == brute(rows)


def test_messages_are_the_repaired_dialogue(spark):
    rows = [(1, 0, "assistant", "A."), (1, 1, "assistant", "B"), (1, 1, "assistant", "B"), (2, 0, "system", "S.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(dr.messages(dr.repair(dr.faults(df))).collect(), key=lambda r: (r.conv, r.seq, r.step))
    assert [(r.conv, r.edit, r.role, r.text) for r in got] == [
        (1, "R", "user", "A."), (1, "K", "assistant", "B"), (1, "D", "assistant", "B"), (2, "D", "system", "S.")]
    assert dr.messages(dr.repair(dr.faults(df.limit(0)))).count() == 0


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def test_query_equals_brute_force(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    want = brute(damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r.conv_id: tuple(r[n] for n in names) for r in entry.queries()["op12_dialogue_repair"](spark, SF).collect()}
    assert got == {c: want.get(c, empty) for c, *_ in rows}
    df = spark.createDataFrame(chats(9, longest=40), "conv_id long, turn long, role string, text string")
    assert Counter(map(tuple, dr.damaged(df).collect())) == Counter(damage(chats(9, longest=40)))
