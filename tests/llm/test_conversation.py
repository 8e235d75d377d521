"""Operator 13 against a search over all edits, and its defined cases."""

import hashlib
import heapq
import random
import re
import zlib

from dwspark.llm import conversation as C
from dwspark.llm.queries import op13_conversation_repair  # noqa: F401 - registered query, held against SQL below

SCHEMA = "conv_id long, turn long, role string, text string, digest string, seq string, block string"


def faulty(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying edits in the order of (cost, audit); the first legal end wins."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, k, state, said = heapq.heappop(heap)
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in said)):
            return cost, audit, said
        if (k, audit) in done or cost > 7 * len(rows) + 9:
            continue
        done.add((k, audit))
        roles = "".join(r[:1] for r, _ in said)
        for role in ("user", "assistant"):
            if re.fullmatch("s?(ua)*u?", roles + role[0]):
                heapq.heappush(heap, (cost + 3, audit + "I", k, state, (*said, (role, ""))))
        if k < len(rows):
            role, text, fault = rows[k]
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, state, said))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault else 0
                options = [("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)]
                for letter, new, price in options:
                    if re.fullmatch("s?(ua)*u?", roles + new[:1]) and new[:1]:
                        heapq.heappush(heap, (cost + extra + price, audit + letter, k + 1, state, (*said, (new, text))))
    raise AssertionError


def expected(rows):
    """The contract's columns for rows (conv_id, turn, role, text) of one conversation."""
    kept = []
    for conv, turn, role, text in rows:
        one = lambda v: " " if v is None else str(v)
        fate = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", one(text))}.get(fate, one(text))
        kept += [(turn, "user" if fate == 4 else one(role), text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {t for t, _, _ in kept if t is not None}
    faults = faulty([r[1:] for r in kept])
    cost, audit, said = cheapest(faults)
    count = [f for _, _, f in faults]
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(faults, faults[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in said)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(count.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def result(spark, rows, block_rows=4096):
    given = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    gaps, repair = C.repair(given, block_rows)
    got = repair.digests(gaps).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in got}, repair


def conversations(seed, convs, size):
    rng, rows = random.Random(seed), []
    for conv in convs:
        for _ in range(rng.randint(1, size)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Hi.", "What? ", "so it goes", "", " \t\n", None, "é!", "\n\x0b.\n", "a "])
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 7, 9]), role, text))
    return rows


def test_equals_search_over_all_edits(spark):
    rows = conversations(5, [None, *range(60)], 5)
    want = {c: expected([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    got, _ = result(spark, rows)
    assert got == want
    # blocks of two rows: every conversation is crossed at block ends
    assert result(spark, rows, block_rows=2)[0] == want


def test_blocks_do_not_change_a_long_conversation(spark):
    rows = [r for k in range(300) for r in conversations(k, [1], 6)] + [(2, 1, "user", "Hm.")] * 500
    rows = [(c, None if t is None else t + 10 * i, r, f"{x}{i % 7}." if x else x) for i, (c, t, r, x) in enumerate(rows)]
    whole, _ = result(spark, rows)
    cut, repair = result(spark, rows, block_rows=16)
    assert whole == cut
    edits = repair.edits().orderBy("conv_id", "seq", "n").collect()
    for conv in (1, 2):
        mine = [e for e in edits if e["conv_id"] == conv]
        assert "".join(e["edit"] for e in mine) == whole[conv][6]
        said = [f"{e['role']}:{e['text']}" for e in mine if e["edit"] != "D"]
        assert hashlib.sha256("\n".join(said).encode()).hexdigest() == whole[conv][7]
        assert re.fullmatch("(s?(ua)+)?", "".join(e["role"][0] for e in mine if e["edit"] != "D"))


def test_dropped_and_empty(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got, _ = result(spark, [(conv, 0, "user", "Hi.")])
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert result(spark, [])[0] == {}
