"""Operator 13: conversation structure repair by Hirschberg's divide and conquer.

A conversation is legal when its role initials read ``(s?(ua)+)?``. Four
states say what has been read: nothing, a system turn, a user turn, an
assistant turn. Each row is kept, given another role or deleted, after
inserted empty turns; the cheapest edits win, and of those the ASCII-least
string of their initials (D, I, K, R).

The conversations are sorted across all tasks (a long one spans many) and cut
into blocks of at most ``block_rows`` rows, and three passes follow:

1. each block is reduced to what it costs between any two states;
2. for each conversation, the block ends are crossed in states chosen by
   Hirschberg's scheme over the blocks: costs forward from the start and
   backward from the end meet in the middle, the best crossing of least audit
   is taken, and both halves are solved alike;
3. the same inside each block, between its two states, gives the edits.

Memory is linear in a block, and no task holds the rows of a conversation. Pass
2 holds some 100 bytes a block of a conversation, a fortieth of the audit
string that its row in the result holds. Forward costs carry the order
of the four states' least audits. All audits that end at the same row have one
letter a row besides their insertions, so none is a prefix of another, and a
comparison of two halves ends in the first one.

Defined cases: a null conversation id is a conversation of its own; null turns
come first; null roles and texts count as one space; rows of one turn are
ordered by role, then text; a conversation without rows costs nothing; roles
are legal by their first letter; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwspark.llm.common import text_digest, written

BLOCK_ROWS = 4096
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 60
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ROLES = {"u": "user", "a": "assistant"}
_INITIALS = "sua"
#: the turn that may be inserted in a state, and the state it leads to
_INSERTED = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
_TURN = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: cost of the turns inserted at the end, by state; two turns finish a lone system turn
AT_END = (0, 2 * INSERT, INSERT, 0)
TAIL = ("", "ua", "a", "")
BLANK, CUT, FIRST = 4, 8, 16
SPACE = r"\x20\x09-\x0D"


# ------------------------------------------------------------ one row, one block
@lru_cache(maxsize=None)
def edits_of(initial: str, must_go: bool, cut: bool) -> dict[tuple[int, int], tuple[int, str, str]]:
    """(from, to) -> (cost, audit, edit) of one row; an edit is the inserted initials, the letter, the new initial."""
    found: dict[tuple[int, int], tuple[int, str, str]] = {}
    for start in STATES:
        state, before = start, ""
        for n in range(3):  # more insertions lead to no further state
            choices = [(DELETE, "D", state, "")]
            if not must_go:
                extra = TRUNCATED if cut else 0
                for i in _INITIALS:
                    if (state, i) in _TURN and (i == initial or i in ROLES):
                        kept = i == initial
                        choices.append((extra + (0 if kept else REROLE), "K" if kept else "R", _TURN[state, i], "" if kept else i))
            for cost, letter, to, new in choices:
                option = (cost + n * INSERT, "I" * n + letter, before + letter + new)
                if (start, to) not in found or option < found[start, to]:
                    found[start, to] = option
            turn, state = _INSERTED[state]
            before += turn
    return found


def _ranked(options: list[list[tuple[int, object]]]) -> tuple:
    """Rows of (cost, order): the order of each row's audits, which are comparable keys."""
    out = []
    for row in options:
        keys = sorted({k for c, k in row if c < FAR})
        out.append(tuple((c, keys.index(k)) if c < FAR else (FAR, 0) for c, k in row))
    return tuple(out)


@lru_cache(maxsize=None)
def row_steps(initial: str, must_go: bool, cut: bool) -> tuple:
    """Costs and audit order of one row: steps[from][to] = (cost, order among the ends of one start)."""
    e = edits_of(initial, must_go, cut)
    return _ranked([[e[s, t][:2] if (s, t) in e else (FAR, "") for t in STATES] for s in STATES])


@lru_cache(maxsize=1 << 16)
def forward(reached: tuple, steps: tuple) -> tuple[int, tuple]:
    """One element further: (added base cost, (cost above the base, order) by state)."""
    best = [min((reached[s][0] + steps[s][t][0], reached[s][1], steps[s][t][1]) for s in STATES) for t in STATES]
    base = min(b[0] for b in best)
    ranked = _ranked([[(min(FAR, c - base) if c < FAR else FAR, (o, p)) for c, o, p in best]])[0]
    return base, ranked


@lru_cache(maxsize=1 << 16)
def backward(steps: tuple, left: tuple[int, ...]) -> tuple[int, ...]:
    """Cost from each state through the element to the end, up to a constant."""
    found = [min(steps[s][t][0] + left[t] for t in STATES) for s in STATES]
    base = min(found)
    return tuple(min(FAR, c - base) for c in found)


def at(state: int) -> tuple:
    return tuple((0 if s == state else FAR, 0) for s in STATES)


def only(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else FAR for s in STATES)


def through(elements: list[tuple], reached: tuple) -> tuple[int, tuple]:
    """Cost and (cost, order) by state after all elements."""
    total = 0
    for e in elements:
        base, reached = forward(reached, e)
        total += base
    return total, reached


def block_steps(elements: list[tuple]) -> tuple:
    """The elements as one: steps[from][to] = (cost, order)."""
    found = []
    for s in STATES:
        total, reached = through(elements, at(s))
        found.append(tuple((total + c, o) if c < FAR else (FAR, 0) for c, o in reached))
    return tuple(found)


def crossings(elements: list[tuple], start: int, end: tuple[int, ...]) -> list[int]:
    """The state after each element on the cheapest, audit-least path from ``start``; ``end`` costs each final state."""
    states = [start] * len(elements)
    todo = [(0, len(elements), start, end)] if elements else []
    while todo:
        low, high, first, last = todo.pop()
        if high - low == 1:
            states[low] = min(STATES, key=lambda t: (elements[low][first][t][0] + last[t], elements[low][first][t][1]))
            continue
        mid = (low + high) // 2
        reached = through(elements[low:mid], at(first))[1]
        left = last
        for k in range(high - 1, mid - 1, -1):
            left = backward(elements[k], left)
        cross = min(STATES, key=lambda s: (reached[s][0] + left[s], reached[s][1]))
        todo += [(low, mid, first, only(cross)), (mid, high, cross, last)]
    return states


# --------------------------------------------------------------- rows and faults
def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` after the damage that crc32 of ``conv_id:turn`` gives each row."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), F.pmod(F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))), F.lit(20)).alias("fate"))
    rows = rows.where("fate <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows sorted over all tasks, written with ``seq``, which follows that order, and what the faults need.

    The last key tells equal rows apart, so that not even those meet in one task.
    """
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("nth")]
    rows = rows.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the last character that is no space, without a regular expression's search from every position
    last = F.right(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), F.lit(1))
    initial = F.when(F.col("role") == "", 0).otherwise(F.position(F.left("role", F.lit(1)), F.lit(_INITIALS)))
    code = initial + F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(0)
    return written(rows.select("conv_id", "role", "text", F.monotonically_increasing_id().alias("seq"), code.cast("int").alias("code"), text_digest(F.col("text")).alias("digest")), "turns")


def _steps(codes: list[int], firsts: list[bool]) -> tuple[list[tuple], list[tuple], dict[str, int]]:
    """Elements and kinds of a block's rows, and its counts of faults."""
    kinds, n = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for code, first in zip(codes, firsts):
        blank, cut = bool(code & BLANK), bool(code & CUT)
        n["blank"] += blank
        n["duplicate"] += not blank and not first
        n["truncated"] += cut and first
        kinds.append(((" " + _INITIALS)[code & 3], blank or not first, cut))
    return [row_steps(*k) for k in kinds], kinds, n


_STEPS = "array<long>"


def _flat(steps: tuple) -> list[int]:
    return [v for row in steps for cell in row for v in cell]


def _nested(flat: list[int]) -> tuple:
    cells = [(flat[i], flat[i + 1]) for i in range(0, 32, 2)]
    return tuple(tuple(cells[4 * s : 4 * s + 4]) for s in STATES)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _legal_pairs(initials: str) -> int:
    """Neighbours that no legal conversation has."""
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def blocks_of(rows: DataFrame, block_rows: int) -> DataFrame:
    """Pass 1: each block's codes, steps between states and counts, written."""
    block = F.floor(F.col("seq") / block_rows).alias("block")
    slim = rows.select("conv_id", block, "seq", "code")
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("seq").alias("seq"))
    marked = slim.unionAll(firsts.select("conv_id", block, "seq", F.lit(FIRST).alias("code")))
    grouped = marked.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("seq", "code"))).alias("rows"))
    conv = rows.schema["conv_id"]
    schema = T.StructType([conv, *T._parse_datatype_string(f"seq long, codes array<int>, steps {_STEPS}, initials string, blank long, duplicate long, truncated long, illegal long").fields])

    def summarize(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            out = []
            for conv_id, marks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                # a first row is followed by its mark, which has the same seq and the greater code
                codes, is_first = [], []
                for m in marks:
                    if m["code"] == FIRST:
                        is_first[-1] = True
                    else:
                        codes.append(m["code"])
                        is_first.append(False)
                steps, kinds, n = _steps(codes, is_first)
                read = "".join(k[0] for k in kinds)
                out.append((conv_id, marks[0]["seq"], [c | (FIRST if f else 0) for c, f in zip(codes, is_first)], _flat(block_steps(steps)), read[0] + read[-1], *n.values(), _legal_pairs(read)))
            yield _batch(out, schema)

    return written(grouped.select("conv_id", "rows").mapInArrow(summarize, schema), "blocks")


def paths_of(blocks: DataFrame) -> DataFrame:
    """Pass 2: the states between the blocks of each conversation and its counts, written."""
    counts = ["blank", "duplicate", "truncated", "illegal"]
    grouped = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seq", "steps", "initials"))).alias("blocks"), *[F.sum(c).alias(c) for c in counts])
    schema = T.StructType([blocks.schema["conv_id"], *T._parse_datatype_string("path array<struct<seq:long,first:int,last:int,end:boolean>>, cost long, blank long, duplicate long, truncated long, illegal long").fields])

    def solve(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            out = []
            for row in b.to_pylist():
                steps = [_nested(x["steps"]) for x in row["blocks"]]
                states = crossings(steps, START, AT_END)
                total, reached = through(steps, at(START))
                path = [{"seq": x["seq"], "first": f, "last": t, "end": x is row["blocks"][-1]} for x, f, t in zip(row["blocks"], [START, *states], states)]
                between = sum(_legal_pairs(x["initials"][1] + y["initials"][0]) for x, y in zip(row["blocks"], row["blocks"][1:]))
                out.append((row["conv_id"], path, total + min(reached[s][0] + AT_END[s] for s in STATES), row["blank"], row["duplicate"], row["truncated"], row["illegal"] + between))
            yield _batch(out, schema)

    return written(grouped.select("conv_id", "blocks", *counts).mapInArrow(solve, schema), "paths")


def block_edits(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Pass 3: ``conv_id``, ``seq`` of the block's first row, ``edits`` (one string a row) and ``tail`` (inserted at the end)."""
    ends = paths.select(F.explode("path").alias("p")).select("p.*")
    joined = blocks.select("conv_id", "seq", "codes").join(ends, "seq").select("conv_id", "seq", "codes", "first", "last", "end")
    schema = T.StructType([blocks.schema["conv_id"], *T._parse_datatype_string("seq long, edits array<string>, tail string").fields])

    def solve(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            out = []
            for row in b.to_pylist():
                steps, kinds, _ = _steps([c & ~FIRST for c in row["codes"]], [bool(c & FIRST) for c in row["codes"]])
                states = crossings(steps, row["first"], only(row["last"]))
                edits = [edits_of(*k)[f, t][2] for k, f, t in zip(kinds, [row["first"], *states], states)]
                out.append((row["conv_id"], row["seq"], edits, TAIL[row["last"]] if row["end"] else ""))
            yield _batch(out, schema)

    return joined.mapInArrow(solve, schema)


# ------------------------------------------------------------------------ results
def edits_for(edit: str, role: str, text: str) -> list[tuple[str, str | None, str | None]]:
    """(letter, role, text) for each edit of one row; a deleted row has no role and text."""
    out: list[tuple[str, str | None, str | None]] = []
    rerole = edit[-2:-1] == "R"
    for c in edit[:-2] if rerole else edit[:-1]:
        out.append(("I", ROLES[c], ""))
    if rerole:
        out.append(("R", ROLES[edit[-1]], text))
    elif edit[-1] == "K":
        out.append(("K", role, text))
    else:
        out.append(("D", None, None))
    return out


def _merged(rows: DataFrame, blocks: DataFrame, keys: list[Column], heads: DataFrame | None = None) -> DataFrame:
    """Rows and the edits of their blocks in order, dealt by ``keys``: a block's edits come before its rows."""
    none = "cast(null as {})".format
    parts = [
        rows.selectExpr("conv_id", "seq", "1 as kind", "role", "text", f"{none('array<string>')} as edits", f"{none('string')} as tail", f"{none('array<long>')} as numbers"),
        blocks.selectExpr("conv_id", "seq", "0 as kind", f"{none('string')} as role", f"{none('string')} as text", "edits", "tail", f"{none('array<long>')} as numbers"),
    ]
    if heads is not None:
        parts.append(heads.selectExpr("conv_id", "-1L as seq", "kind", f"{none('string')} as role", f"{none('string')} as text", f"{none('array<string>')} as edits", f"{none('string')} as tail", "numbers"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.repartition(*keys).sortWithinPartitions("conv_id", "seq", "kind")


class Repair:
    """The repair of a table of turns (see ``damaged`` for the columns); each part is computed when it is asked for."""

    def __init__(self, turns: DataFrame, block_rows: int = BLOCK_ROWS):
        self.block_rows = block_rows
        self.rows = ordered(turns)
        self.blocks = blocks_of(self.rows, block_rows)
        self.paths = paths_of(self.blocks)

    def edits(self) -> DataFrame:
        """One row an edit: ``conv_id``, ``seq`` and ``n`` (order), ``edit`` (K, R, D, I), ``role`` and ``text`` of the result."""
        block = F.floor(F.col("seq") / self.block_rows)
        schema = T.StructType([self.rows.schema["conv_id"], *T._parse_datatype_string("seq long, n int, edit string, role string, text string").fields])

        def apply(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            todo: Iterator[str] = iter(())
            tail, left = "", 0
            for b in got:
                out = []
                for conv_id, seq, kind, role, text, edits, last in zip(*(b.column(i).to_pylist() for i in range(7))):
                    if kind == 0:
                        todo, tail, left = iter(edits), last, len(edits)
                        continue
                    left -= 1
                    made = edits_for(next(todo), role, text)
                    if left == 0:
                        made += [("I", ROLES[c], "") for c in tail]
                    out += [(conv_id, seq, n, *m) for n, m in enumerate(made)]
                yield _batch(out, schema)

        return _merged(self.rows, block_edits(self.blocks, self.paths), [F.col("conv_id"), block]).mapInArrow(apply, schema)

    def digests(self, ids: DataFrame) -> DataFrame:
        """One row for each of ``ids`` (``conv_id``, ``gaps``): counts, cost, audit and the repaired text's hash.

        A hash of a whole conversation needs its rows in order, so they stream
        through one task, which holds the audit and the state of the hash.
        """
        heads = ids.select("conv_id", F.lit(0).alias("kind"), F.array(F.col("gaps").cast("long")).alias("numbers"))
        counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
        heads = heads.unionAll(self.paths.select("conv_id", F.lit(1).alias("kind"), F.array(*counts).alias("numbers")))
        fields = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
        schema = T.StructType([self.rows.schema["conv_id"], *T._parse_datatype_string(fields).fields])

        def digest(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            conv: tuple | None = None
            todo: Iterator[str] = iter(())
            gaps, numbers, audit, sha, turns, tail, left = 0, [0] * 5, [], hashlib.sha256(), 0, "", 0

            def said(made: list) -> None:
                nonlocal turns
                for letter, role, text in made:
                    audit.append(letter)
                    if letter != "D":
                        sha.update((("\n" if turns else "") + f"{role}:{text}").encode())
                        turns += 1

            for b in got:
                out = []
                for conv_id, seq, kind, role, text, edits, last, given in zip(*(b.column(i).to_pylist() for i in range(8))):
                    if seq < 0:
                        if conv is not None and kind == 0:
                            out.append((*conv, gaps, *numbers, "".join(audit), sha.hexdigest()))
                        if kind == 0:
                            conv, gaps, numbers, audit, sha, turns = (conv_id,), given[0], [0] * 5, [], hashlib.sha256(), 0
                        else:
                            numbers = given
                    elif kind == 0:
                        todo, tail, left = iter(edits), last, len(edits)
                    else:
                        left -= 1
                        said(edits_for(next(todo), role, text))
                        if left == 0:
                            said([("I", ROLES[c], "") for c in tail])
                yield _batch(out, schema)
            if conv is not None:
                yield _batch([(*conv, gaps, *numbers, "".join(audit), sha.hexdigest())], schema)

        return _merged(self.rows, block_edits(self.blocks, self.paths), [F.col("conv_id")], heads).mapInArrow(digest, schema)


def gaps_of(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``gaps`` of every original conversation; turns are those left after the damage."""
    seen = conversations.select("conv_id", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn")).unionAll(turns.select("conv_id", "turn")).distinct()
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return seen.groupBy("conv_id").agg(F.coalesce(span.cast("long"), F.lit(0).cast("long")).alias("gaps"))


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, Repair]:
    """Damage and repair ``conversations``: the gaps of each conversation, and its repair."""
    turns = damaged(conversations)
    return gaps_of(conversations, turns), Repair(turns, block_rows)
