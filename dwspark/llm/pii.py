"""Operator 1: personal data by weak supervision, in Spark expressions only.

Base spans come from four patterns (email, ip, card, phone) with their checks.
Candidates for further spans (secrets: mixed runs of letters and digits; phone
numbers without a country code) come from looser patterns. Labelers vote on
each candidate, for (+1), against (-1) or not at all (0): regex labelers on its form,
gazetteer labelers on the words before it, context labelers on what surrounds
it. Spark counts the combinations of votes and features over all documents: a
small table, bounded by the number of combinations. On it, expectation
maximisation estimates the share of true spans and how reliable each labeler
is, and a logistic span classifier is fitted to the resulting probabilities. Its weights
become one Spark expression; candidates at 0.5 or more that overlap no base span are added.

Positions are sums of the lengths of what lies between matches and of the
matches, so each text is read by each pattern a fixed number of times.

Defined cases: null and empty texts have no spans; repeated rows and ids give
equal rows; other columns are ignored; with an empty table, or none of a kind
of candidate, nothing is learnt and nothing is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the contract, written so that no engine backtracks over long runs: runs are taken
# whole (++), and a match starts at a run's start or where the last one ended (\G).
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATES = {
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{8,}+",
}
ORDER = [*KINDS, "secret"]
_BYTE = r"^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
# Gazetteers: words that introduce a value, by kind.
_CUES = {"secret": "password|passwd|pwd|passphrase|secret|token|credential|api[_ -]?key|access[_ -]?key|auth|bearer", "phone": "phone|tel|telephone|mobile|cell|fax|call|sms|whatsapp"}
VOTES = ["form", "cue", "marks", "mixing", "size"]
_EMPTY = "cast(array() as array<struct<start:int,end:int,value:string,before:string,after:string>>)"


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value, before, after>> of the matches: code points, and the text around."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
    starts = F.aggregate(lengths, start, lambda a, x: F.struct((a["at"] + x["g"] + F.coalesce(x["m"], F.lit(0))).alias("at"), F.concat(a["out"], F.array(a["at"] + x["g"])).alias("out")))["out"]

    def spans(parts: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            at = F.get(parts["starts"], i)
            return F.struct(at.alias("start"), (at + F.length(m)).alias("end"), m.alias("value"), F.right(F.get(parts["gaps"], i), F.lit(30)).alias("before"), F.left(F.get(parts["gaps"], i + 1), F.lit(8)).alias("after"))

        return F.transform(parts["found"], one)

    # evaluated once for the text, and only if the pattern is there
    whole = F.transform(F.array(F.struct(found.alias("found"), gaps.alias("gaps"), starts.alias("starts"))), spans)
    return F.when(F.regexp_like(text, F.lit(pattern)), F.get(whole, F.lit(0))).otherwise(F.expr(_EMPTY))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weigh(d: Column, i: Column) -> Column:
        twice = d.cast("int") * (i % 2 + 1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    weighed = F.transform(F.reverse(F.regexp_extract_all(digits, F.lit("[0-9]"), F.lit(0))), weigh)
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, s: Column) -> Column:
    n = F.length(_digits(s["value"]))
    if kind == "ip":
        return F.forall(F.split(s["value"], r"\.", -1), lambda p: F.regexp_like(p, F.lit(_BYTE)))
    if kind == "card":
        return n.between(12, 19) & _luhn(_digits(s["value"]))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _spans(rows: Column, kind: str) -> Column:
    return F.transform(rows, lambda s: F.struct(s["start"], F.lit(ORDER.index(kind)).alias("order"), s["end"], F.lit(kind).alias("kind"), s["value"]))


def base_spans(text: Column) -> Column:
    """Base spans of all kinds, by start, then kind as listed."""

    def passing(kind: str):
        return lambda s: _passes(kind, s)

    return F.array_sort(F.concat(*[_spans(F.filter(located(text, p), passing(k)), k) for k, p in KINDS.items()]))


def votes(kind: str, s: Column) -> dict[str, Column]:
    """The labelers of a candidate."""
    value, before, after = s["value"], F.lower(s["before"]), s["after"]
    size = F.length(value)
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    out = {"cue": F.when(F.regexp_like(before, F.lit(rf"(?:{_CUES[kind]})[^a-z0-9]{{0,6}}$")), yes).otherwise(none)}
    if kind == "secret":
        turns = F.size(F.regexp_extract_all(value, F.lit("[0-9]+|[A-Za-z]+"), F.lit(0)))
        out["form"] = F.when(F.regexp_like(value, F.lit("^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|[0-9a-f]{16,}|[0-9A-F]{16,})$")), yes).when(F.regexp_like(value, F.lit("^(?:[A-Za-z]{4,}[0-9]{1,4}|[0-9]+[a-z]{1,3})$")), no).otherwise(none)
        out["marks"] = F.when(F.regexp_like(before, F.lit("[=:\"'`]$")), yes).when(F.regexp_like(before, F.lit("[@./_-]$")) | F.regexp_like(after, F.lit("^[@_/]")), no).otherwise(none)
        out["mixing"] = F.when(turns >= 4, yes).when(turns <= 2, no).otherwise(none)
        out["size"] = F.when(size >= 16, yes).when(size < 12, no).otherwise(none)
    else:
        out["form"] = F.when(F.regexp_like(value, F.lit(r"^(?:\([2-9][0-9]{2}\) |[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}$")), yes).otherwise(none)
        out["marks"] = F.when(F.regexp_like(before, F.lit("[0-9][ .-]?$")) | F.regexp_like(after, F.lit("^[ .-]?[0-9]")), no).otherwise(none)
        out["mixing"] = F.when(F.size(F.array_distinct(F.regexp_extract_all(value, F.lit(r"[ .-]"), F.lit(0)))) == 1, yes).otherwise(none)
        out["size"] = F.when(F.regexp_like(value, F.lit("^.?[01]")), no).otherwise(none)
    return out


def candidates(text: Column) -> Column:
    """array<struct<kind, start, end, value, form, cue, marks, mixing, size, length, share>>; the last two are features."""

    def judged(kind: str):
        def one(s: Column) -> Column:
            size = F.length(s["value"])
            v = votes(kind, s)
            length = F.least(F.floor(size / 8), F.lit(5)).cast("int")
            share = F.floor(4 * F.length(_digits(s["value"])) / size).cast("int")
            return F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["value"], *[v[k].alias(k) for k in VOTES], length.alias("length"), share.alias("share"))

        return one

    return F.concat(*[F.transform(located(text, p), judged(k)) for k, p in CANDIDATES.items()])


def em(patterns: dict[tuple[int, ...], float], rounds: int = 60) -> dict[tuple[int, ...], float]:
    """Probability of a true span for each combination of votes.

    The share of true spans and each labeler's votes on true and on false ones
    are estimated in turn with the probabilities, from the majority vote on. Votes are taken as independent
    given the truth. Prior counts hold that a labeler is right more often than wrong.
    """
    p = {v: 1 / (1 + math.exp(-1.5 * sum(v))) for v in patterns}
    total = sum(patterns.values())
    for _ in range(rounds):
        true = sum(n * p[v] for v, n in patterns.items())
        share = (true + 1) / (total + 2)
        reliability = []
        for k in range(len(next(iter(patterns), ()))):
            on = {s: {1: 1.0 + 2 * (s == 1), 0: 2.0, -1: 1.0 + 2 * (s == 0)} for s in (1, 0)}
            for v, n in patterns.items():
                on[1][v[k]] += n * p[v]
                on[0][v[k]] += n * (1 - p[v])
            reliability.append({vote: math.log(on[1][vote] / sum(on[1].values())) - math.log(on[0][vote] / sum(on[0].values())) for vote in (1, 0, -1)})
        new = {v: 1 / (1 + math.exp(-max(-30.0, min(30.0, math.log(share / (1 - share)) + sum(r[x] for r, x in zip(reliability, v)))))) for v in patterns}
        done = max((abs(new[v] - p[v]) for v in p), default=0) < 1e-9
        p = new
        if done:
            break
    return p


def _features(kind: str, v: tuple[int, ...], length: int, share: int) -> list[str]:
    return [f"kind={kind}", *(f"{kind}:{name}={x}" for name, x in zip(VOTES, v) if x), f"{kind}:length={length}", f"{kind}:share={share}"]


def fit_classifier(cells: list[tuple[list[str], float, float]], steps: int = 400) -> dict[str, float]:
    """Logistic weights of features, by gradient ascent on (features, count, probability), with a small penalty."""
    w = {f: 0.0 for fs, _, _ in cells for f in fs}
    total = sum(n for _, n, _ in cells) or 1.0
    g2 = dict.fromkeys(w, 1e-8)
    for _ in range(steps):
        gradient = {f: -1e-4 * x for f, x in w.items()}
        for fs, n, p in cells:
            error = p - 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[f] for f in fs)))))
            for f in fs:
                gradient[f] += n / total * error
        for f, g in gradient.items():
            g2[f] += g * g
            w[f] += 0.5 * g / math.sqrt(g2[f])
    return w


def learn(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Weights of the span classifier, from the votes on all candidates of all documents."""
    found = docs.where(F.col(text_col).isNotNull()).select(F.explode(candidates(F.col(text_col))).alias("c"))
    keys = ["kind", *VOTES, "length", "share"]
    rows = found.select(*[F.col("c")[k].alias(k) for k in keys]).groupBy(*keys).count().collect()
    cells = []
    for kind in CANDIDATES:
        own = [r for r in rows if r["kind"] == kind]
        patterns: dict[tuple[int, ...], float] = {}
        for r in own:
            v = tuple(r[k] for k in VOTES)
            patterns[v] = patterns.get(v, 0) + r["count"]
        p = em(patterns)
        cells += [(_features(kind, v, r["length"], r["share"]), r["count"], p[v]) for r in own for v in [tuple(r[k] for k in VOTES)]]
    return fit_classifier(sorted(cells))


def _accepted(weights: dict[str, float], c: Column) -> Column:
    score = F.lit(0.0)
    for f, w in sorted(weights.items()):
        kind, _, rest = f.rpartition(":")
        name, _, value = rest.partition("=")
        test = c["kind"] == value if name == "kind" else (c["kind"] == kind) & (c[name] == int(value))
        score = score + F.when(test, F.lit(w)).otherwise(0.0)
    return score >= 0


def find_pii(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``base`` and ``spans``, arrays of struct<start, order, end, kind, value> by start, then kind."""
    weights = learn(docs, text_col) if weights is None else weights
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    out = out.select("doc_id", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("found"))

    def free(c: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    order = lambda c: F.array_position(F.array(*map(F.lit, ORDER)), c["kind"]).cast("int") - 1
    added = F.filter("found", lambda c: _accepted(weights, c) & free(c)) if weights else F.filter("found", lambda c: F.lit(False))
    added = F.transform(added, lambda c: F.struct(c["start"], order(c).alias("order"), c["end"], c["kind"], c["value"]))
    return out.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def as_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
