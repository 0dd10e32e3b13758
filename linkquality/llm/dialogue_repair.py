"""Repair of conversation structure by iterative-deepening A*.

A conversation is repaired by edits that make its role initials match
``(s?(ua)+)?``: keep a message (K, 0), give it the role user or assistant
(R, 2), delete it (D, 3; required for blank and repeated messages) or insert
an empty one (I, 2); a truncated message that stays adds 1.  Sought is the
cheapest edit string, of equally cheap ones the least in ASCII order.

The search is depth-first in ASCII edit order under a cost bound that grows by
one.  A table of failed (row, state) pairs with the budget they failed under
cuts repeated work, and an admissible estimate cuts hopeless paths, so the
first accepting path is the answer (``search``).

Messages are dealt to tasks in ranges of (conversation, turn, role, text), so
a conversation of any length is spread, and solved in blocks of bounded rows
and bytes.  A conversation inside one block is solved at once.  Of a longer
one each block is searched for every pair of the automaton's states before
and after it; the blocks' costs, 16 small numbers a block, then choose the
states between blocks.  Blocks end with the edit of their last row, so no
block's string is the beginning of another's, and comparing blocks one by one
compares the whole strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed

BLOCK_ROWS, BLOCK_BYTES = 256, 1 << 20
SPACE = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)          # states: what the last role was
# What the pattern allows: state -> initial -> next state; and what a new or
# renamed message there must be.
ALLOWED = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
CLOSING = {START: 0, SYSTEM: 4, USER: 2, ASSISTANT: 0}      # cost of inserting up to an accepting end
NEVER = 1 << 40


# ------------------------------------------------------------------- search

class Rows:
    """What the search needs of a run of messages: ``initials``, ``required``
    (number of messages the row stands for that must be deleted, else 0) and
    ``truncated``; and the cost that is certainly still to come from a row."""

    def __init__(self, initials: list[str], required: list[int], truncated: list[bool]):
        self.initials, self.required, self.truncated = initials, required, truncated
        n = len(initials)
        self.size = n
        self.forced = [0] * (n + 1)        # deletions and truncations from here on
        self.free = [n] * (n + 1)          # next row that need not be deleted
        self.run = [0] * (n + 1)           # illegal neighbours in a row, from the free row on
        self.later = [0] * (n + 1)         # cost of the runs after that one
        self.all = [0] * (n + 1)           # cost of deleting everything
        for i in range(n - 1, -1, -1):
            self.forced[i] = self.forced[i + 1] + (3 * required[i] or int(truncated[i]))
            self.all[i] = self.all[i + 1] + 3 * (required[i] or 1)
            if required[i]:
                self.free[i], self.run[i], self.later[i] = self.free[i + 1], self.run[i + 1], self.later[i + 1]
                continue
            self.free[i], after = i, self.free[i + 1]
            if after < n and initials[i] + initials[after] not in ("su", "ua", "au"):
                self.run[i], self.later[i] = self.run[i + 1] + 1, self.later[i + 1]
            else:
                self.later[i] = self.later[i + 1] + 2 * -(-self.run[i + 1] // 2)

    def estimate(self, i: int, state: int, goal: int | None) -> int:
        """A bound from below for the cost from row ``i`` on.  An edit beyond
        the forced ones costs 2 at least and mends two illegal neighbours of
        one run at most; the states start and system can only be kept by
        deleting."""
        if goal in (START, SYSTEM):
            if state == goal:
                return self.all[i]
            return self.all[i] - 3 if (goal, state) == (SYSTEM, START) else NEVER
        first = self.free[i]
        if first == self.size:
            return self.forced[i] + (CLOSING[state] if goal is None else 0)
        run = self.run[first] + (self.initials[first] not in ALLOWED[state])
        return self.forced[i] + 2 * -(-run // 2) + self.later[first]


def search(rows: Rows, start: int = START, goal: int | None = None) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest, then ASCII-least, edit string from state
    ``start``; ``goal`` None: to an accepting end, messages may be inserted
    behind the last row; else to that state, ending with the last row.  None
    where no string leads there."""
    n = rows.size
    if goal == SYSTEM and start == START and not any(
            c == "s" and not d for c, d in zip(rows.initials, rows.required)):
        return None
    bound = rows.estimate(0, start, goal)
    failed: dict[tuple[int, int], int] = {}
    while bound < NEVER:
        found = _within(rows, start, goal, bound, failed, n)
        if found is not None:
            return bound, found
        bound += 1
    return None


def _moves(rows: Rows, i: int, state: int, goal: int | None):
    """(edits, cost, next row, next state) in ASCII order of the edits."""
    inside, wanted = i < rows.size, WANTED[state]
    if inside:
        many = rows.required[i] or 1
        yield "D" * many, 3 * many, i + 1, state
    if inside or goal is None:
        yield "I", 2, i, ALLOWED[state][wanted]
    if inside and not rows.required[i]:
        extra = int(rows.truncated[i])
        kept = ALLOWED[state].get(rows.initials[i])
        if kept is not None:
            yield "K", extra, i + 1, kept
        yield "R", 2 + extra, i + 1, ALLOWED[state][wanted]


def _within(rows: Rows, start: int, goal: int | None, bound: int, failed: dict, n: int) -> str | None:
    """The first accepting path of cost ``bound`` at most."""
    stack = [(0, start, 0, "", _moves(rows, 0, start, goal))]
    while stack:
        i, state, spent, _, moves = stack[-1]
        if i == n and (state in (START, ASSISTANT) if goal is None else state == goal):
            return "".join(frame[3] for frame in stack)
        for edits, cost, row, after in moves:
            total = spent + cost
            if (total + rows.estimate(row, after, goal) <= bound
                    and failed.get((row, after), -1) < bound - total):
                stack.append((row, after, total, edits, _moves(rows, row, after, goal)))
                break
        else:
            failed[i, state] = max(failed.get((i, state), -1), bound - spent)
            stack.pop()
    return None


def solve_block(initials, required, truncated, closed: bool, first: bool) -> list[tuple[int, int, int, str, int]]:
    """(state before, state after, cost, edits, place) of a block's cheapest
    strings; ``closed``: the block is a whole conversation (state after: -1);
    ``first``: it begins one.  ``place`` ranks the strings of one state before
    by ASCII order."""
    rows = Rows(initials, required, truncated)
    if closed:
        cost, edits = search(rows)
        return [(START, -1, cost, edits, 0)]
    out = []
    for start in (START,) if first else range(4):
        ends = [(goal, got) for goal in range(4) if (got := search(rows, start, goal)) is not None]
        ranks = {edits: k for k, edits in enumerate(sorted(got[1] for _, got in ends))}
        out += [(start, goal, cost, edits, ranks[edits]) for goal, (cost, edits) in ends]
    return out


def choose_states(blocks: list[dict[tuple[int, int], tuple[int, int]]]) -> tuple[int, list[tuple[int, int]], str]:
    """The cheapest, then ASCII-least, way through a conversation's blocks,
    each given as (before, after) -> (cost, place): total cost, the states
    around each block, the insertions behind the last."""
    ahead = [dict(CLOSING)]
    for block in reversed(blocks):
        left = {}
        for (before, after), (cost, _) in block.items():
            if after in ahead[-1]:
                left[before] = min(left.get(before, NEVER), cost + ahead[-1][after])
        ahead.append(left)
    ahead.reverse()
    state, way = START, []
    for block, here, then in zip(blocks, ahead, ahead[1:]):
        _, after = min((place, after) for (before, after), (cost, place) in block.items()
                       if before == state and after in then and cost + then[after] == here[state])
        way.append((state, after))
        state = after
    return ahead[0][START], way, "I" * (CLOSING[state] // 2)


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str], copies: list[int]):
    """(edit, role, text) of each edit, in order; deletions with what they
    delete, and one for every copy a row stands for."""
    row, left = 0, copies[0] if copies else 0
    for edit in edits:
        role, text = ("", "") if edit == "I" else (roles[row], texts[row])
        if edit in "IR":
            role = NAMES[WANTED[state]]
        if edit != "D":
            state = ALLOWED[state][role[:1]]
        if edit != "I":
            left -= 1
            if not left:
                row += 1
                left = copies[row] if row < len(copies) else 0
        yield edit, role, text


# ------------------------------------------------------------- Spark stages

def faults(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """conv, turn, role, text, copies, fault of the messages: fault is the
    first of blank, duplicate, truncated that holds, or empty.

    Messages go by turn (null turns first), those of one turn by role and
    text; a null role or text counts as one blank; messages without a
    conversation are one conversation; a message repeated any number of times
    within a turn is a row with its number of copies, the first of a kind
    apart from the rest; texts of any length are read whole; an empty table
    gives an empty one; other columns are not read.  ``repair`` and
    ``fault_counts`` read the result, which is checkpointed."""
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))
    same = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    key = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    firsts = (same.groupBy("conv", "role", "text").agg(F.min(key).alias("least"))
              .select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "least"))
    rows = (same.join(firsts, same["conv"].eqNullSafe(firsts["c"]) & (same["role"] == firsts["r"])
                      & (same["text"] == firsts["t"]))
            .withColumn("new", key == F.col("least")))
    end = F.rtrim("text", F.lit(SPACE))
    own = (F.when(end == "", "blank").when(~F.col("new"), "duplicate")
           .when(F.right(end, F.lit(1)).isin(".", "!", "?"), "").otherwise("truncated"))
    rest = F.when(end == "", "blank").otherwise("duplicate")
    parts = F.when(F.col("new") & (F.col("n") > 1) & (end != ""), F.array(
        F.struct(F.lit(1).cast("long").alias("copies"), own.alias("fault")),
        F.struct((F.col("n") - 1).alias("copies"), rest.alias("fault"))))
    one = F.array(F.struct(F.col("n").alias("copies"), own.alias("fault")))
    return checkpointed(
        rows.select("conv", "turn", "role", "text", F.explode(F.coalesce(parts, one)).alias("part"))
        .select("conv", "turn", "role", "text", "part.*"))


def _values(batch, *columns: str, rows: int = 256):
    """The values of a batch's columns row by row, a few rows at a time as
    Python objects."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield from zip(*(part.column(c).to_pylist() for c in columns))


def _blocks(rows: DataFrame, block_rows: int, block_bytes: int) -> DataFrame:
    """conv, seq, closed, its rows as arrays, its cheapest strings; blocks of
    one conversation ascend by ``seq``."""
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    rest = F.when(F.col("fault") == "duplicate", 1).otherwise(0)       # behind the first of their kind
    dealt = (rows.repartitionByRange(*order, F.left("text", F.lit(64)))
             .sortWithinPartitions(*order, "text", rest))
    kind = rows.schema["conv"].dataType.simpleString()

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        high, k = TaskContext.get().partitionId() << 40, 0
        held, size, owner = [], 0, None
        out, out_size = [], 0
        schema = None

        def solved(last: bool, ends: bool, begins: bool):
            """The held rows as one block; ``ends`` and ``begins``: the
            conversation certainly ends and begins with it."""
            nonlocal held, size, k, out_size
            roles, texts, copies, faults = (list(c) for c in zip(*held))
            initials = [r[:1] for r in roles]
            required = [n if f in ("blank", "duplicate") else 0 for n, f in zip(copies, faults)]
            closed = ends and begins
            paths = solve_block(initials, required, [f == "truncated" for f in faults], closed, begins)
            row = (owner, high + k, closed, roles, texts, copies,
                   [dict(zip(("before", "after", "cost", "edits", "place"), p)) for p in paths])
            held, k, out_size = [], k + 1, out_size + size
            size = 0
            out.append(row)

        def flush():
            nonlocal out, out_size
            cols = list(zip(*out))
            out, out_size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

        path = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()),
                          ("edits", pa.string()), ("place", pa.int32())])
        fresh = False          # whether the owner's rows surely begin in this partition
        started = False
        whole = True           # no block of the owner was cut before
        for batch in batches:
            if schema is None:
                schema = pa.schema([("conv", batch.schema.field("conv").type), ("seq", pa.int64()),
                                    ("closed", pa.bool_()), ("roles", pa.list_(pa.string())),
                                    ("texts", pa.list_(pa.string())), ("copies", pa.list_(pa.int64())),
                                    ("paths", pa.list_(path))])
            for conv, role, text, n, fault in _values(batch, "conv", "role", "text", "copies", "fault"):
                if started and conv != owner:
                    solved(False, True, fresh and whole)
                    fresh, whole = True, True
                elif held and (len(held) >= block_rows or size >= block_bytes):
                    solved(False, False, fresh and whole)
                    whole = False
                owner, started = conv, True
                held.append((role, text, n, fault))
                size += len(text) + 64
                if out_size > 4 << 20 or len(out) >= 2048:
                    yield flush()
        if held:
            solved(True, False, fresh and whole)
        if out:
            yield flush()

    return dealt.select("conv", "role", "text", "copies", "fault").mapInArrow(
        cut, f"conv {kind}, seq long, closed boolean, roles array<string>, texts array<string>, copies array<long>, "
             "paths array<struct<before: int, after: int, cost: long, edits: string, place: int>>")


def _ways(blocks: DataFrame) -> DataFrame:
    """conv, seq, before, after, tail, of every block of a conversation that
    is not closed.  Only states, costs and ranks of its blocks meet in a task,
    about a thousandth of its rows."""
    kind = blocks.schema["conv"].dataType.simpleString()
    narrow = blocks.where("not closed").select("conv", "seq", F.transform("paths", lambda p: F.struct(
        p["before"].alias("before"), p["after"].alias("after"), p["cost"].alias("cost"),
        p["place"].alias("place"))).alias("paths"))

    def choose(batches):
        import pyarrow as pa
        held, owner, kind_of = [], None, None

        def done():
            cost, way, tail = choose_states([b for _, b in held])
            last = len(held) - 1
            return pa.RecordBatch.from_arrays(
                [pa.array([owner] * len(held), kind_of), pa.array([s for s, _ in held], pa.int64()),
                 pa.array([w[0] for w in way], pa.int32()), pa.array([w[1] for w in way], pa.int32()),
                 pa.array([tail if k == last else "" for k in range(len(held))], pa.string())],
                names=["conv", "seq", "before", "after", "tail"])

        for batch in batches:
            kind_of = batch.schema.field("conv").type
            for conv, seq, paths in _values(batch, "conv", "seq", "paths"):
                if held and conv != owner:
                    yield done()
                    held = []
                owner = conv
                held.append((seq, {(p["before"], p["after"]): (p["cost"], p["place"]) for p in paths}))
        if held:
            yield done()

    return (narrow.repartition("conv").sortWithinPartitions("conv", "seq")
            .mapInArrow(choose, f"conv {kind}, seq long, before int, after int, tail string"))


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """conv, seq, before, roles, texts, copies, edits, cost: the messages of
    every conversation (``faults``) in blocks, with the edits that repair it.
    The blocks' size changes no edit.  ``messages`` and ``transcripts`` read
    the result."""
    blocks = checkpointed(_blocks(rows, block_rows, block_bytes))
    keep = ["conv", "seq", "roles", "texts", "copies"]
    whole = blocks.where("closed").select(*keep, F.col("paths")[0].alias("p")).select(
        *keep, "p.before", "p.edits", "p.cost")
    ways = _ways(blocks).withColumnsRenamed({"conv": "c", "seq": "s"})
    parts = blocks.where("not closed")
    parts = (parts.join(ways, parts["conv"].eqNullSafe(ways["c"]) & (parts["seq"] == ways["s"]))
             .select(*keep, "tail", "before",
                     F.filter("paths", lambda p: (p["before"] == F.col("before"))
                              & (p["after"] == F.col("after")))[0].alias("p"))
             .select(*keep, "before", F.concat("p.edits", "tail").alias("edits"),
                     (F.col("p.cost") + 2 * F.length("tail")).alias("cost")))
    return whole.unionByName(parts)


def messages(repaired: DataFrame) -> DataFrame:
    """conv, seq, step, edit, role, text: every edit with the message it keeps,
    renames, inserts or deletes; the repaired conversation is the rows whose
    edit is not D, by (seq, step)."""
    kind = repaired.schema["conv"].dataType.simpleString()

    def steps(batches):
        import pyarrow as pa
        for batch in batches:
            for conv, seq, *block in _values(batch, "conv", "seq", "edits", "before", "roles", "texts", "copies"):
                got = list(apply_edits(*block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * len(got), batch.schema.field("conv").type),
                     pa.array([seq] * len(got), pa.int64()), pa.array(range(len(got)), pa.int64()),
                     *(pa.array([g[k] for g in got], pa.string()) for k in range(3))],
                    names=["conv", "seq", "step", "edit", "role", "text"])

    return repaired.mapInArrow(steps, f"conv {kind}, seq long, step long, edit string, role string, text string")


def transcripts(repaired: DataFrame) -> DataFrame:
    """conv, cost, audit, illegal, repaired_sha256 of every conversation:
    summed cost, all edits, illegal neighbours before the repair, and the
    SHA-256 of its repaired ``role:text`` lines.  A digest of a whole
    conversation can't be put together from parts, so its blocks stream
    through one task, one block in memory at a time."""
    kind = repaired.schema["conv"].dataType.simpleString()

    def digest(batches):
        import hashlib

        import pyarrow as pa
        owner, state, kind_of = None, None, None
        ready = []

        def closed():
            cost, audit, illegal, _, sha, _ = state
            return owner, cost, "".join(audit), illegal, sha.hexdigest()

        def out():
            cols = list(zip(*ready))
            ready.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (kind_of, pa.int64(), pa.string(), pa.int64(), pa.string()))],
                names=["conv", "cost", "audit", "illegal", "repaired_sha256"])

        for batch in batches:
            kind_of = batch.schema.field("conv").type
            for conv, cost, edits, before, roles, texts, copies in _values(
                    batch, "conv", "cost", "edits", "before", "roles", "texts", "copies"):
                if state is not None and conv != owner:
                    ready.append(closed())
                    state = None
                    if len(ready) >= 2048:
                        yield out()
                owner = conv
                state = state or [0, [], 0, None, hashlib.sha256(), False]
                state[0] += cost
                state[1].append(edits)
                for role, n in zip(roles, copies):
                    c = role[:1]
                    state[2] += n - 1 + (state[3] is not None and state[3] + c not in ("su", "ua", "au"))
                    state[3] = c
                for edit, role, text in apply_edits(edits, before, roles, texts, copies):
                    if edit != "D":
                        if state[5]:
                            state[4].update(b"\n")
                        state[4].update(f"{role}:{text}".encode())
                        state[5] = True
        if state is not None:
            ready.append(closed())
        if ready:
            yield out()

    return (repaired.repartition("conv").sortWithinPartitions("conv", "seq").mapInArrow(
        digest, f"conv {kind}, cost long, audit string, illegal long, repaired_sha256 string"))


def fault_counts(rows: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated of every conversation
    (``faults``); ``gaps`` is the number of turns missing between its first
    and last, null turns ignored, zero where all are null."""
    names = ("blank", "duplicate", "truncated")
    turns = rows.groupBy("conv", "turn").agg(*[
        F.sum(F.when(F.col("fault") == f, F.col("copies")).otherwise(0)).alias(f) for f in names])
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
                                     *[F.sum(f).alias(f) for f in names])


# ----------------------------------------------------------- damaged copies

def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", mod: int = 20) -> DataFrame:
    """``df`` (the four columns) with faults put in by the CRC-32 of
    ``conversation:turn`` modulo ``mod``: 0 drops a row, 1 empties its text,
    2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user; nulls in the
    key, the role and the text count as one blank."""
    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text(conv_col), F.lit(":"), text(turn_col))) % mod
    return (df.select(conv_col, turn_col, text(role_col).alias(role_col), text(text_col).alias(text_col),
                      kind.alias("__kind")).where("__kind <> 0")
            .select(conv_col, turn_col,
                    F.when(F.col("__kind") == 4, "user").otherwise(F.col(role_col)).alias(role_col),
                    F.when(F.col("__kind") == 1, "").when(
                        F.col("__kind") == 2, F.translate(F.col(text_col), ".!?", "")).otherwise(F.col(text_col))
                    .alias(text_col),
                    F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                    .alias("__copy"))
            .drop("__copy"))
