"""Operator 7: toxicity by Levenshtein automata over a learned lexicon, with context windows.

Fit, on at most ``max_rows`` labelled documents (taken by hash of their id):

1. the lexicon: words and word beginnings (stems) much more frequent in toxic
   than in clean documents, in many different contexts; and the repeated
   stems, of which the same holds for documents with two or more of their
   words. A clean text holds such a word now and then, so they hit only in
   documents with more of them than chance explains (a Poisson tail below
   ``CHANCE`` at ``BURST`` times the rate of clean documents);
2. the known words: near misses of a term that are not clearly more frequent
   in toxic documents, which are therefore no misspellings; and the cues:
   ``CUES`` and the words that stand close to terms in clean documents
   (reports, quotations);
3. a logistic model of what a document holds: abuse, misspelled abuse and
   mentions. A hit is a mention if it is quoted or a cue is within
   ``CONTEXT`` words. Abuse and misspelled abuse never speak for a document.

Known words and cues come from one half of the labelled documents and the
logistic model from the other, so that it sees misspellings as new texts
have them. Toxic documents of that half count a second time, at the weight
``MISSPELLED_SHARE``, with one letter of each term changed.

Scoring reads every word of every text. A word goes once through the lexicon
trie intersected with the Levenshtein automata of all its terms; the worker
remembers the result. Nothing is shuffled.

Defined cases: a null or empty text has no hits and gets the model's base
score; without labelled documents of both classes the lexicon is empty and
the score is the prior; repeated rows get equal scores; several labels for an
id count as toxic if one does; other columns are ignored or passed through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.llm.automaton import FUZZY, STEM, LexiconAutomaton
from dwspark.llm.common import WORD_RE, written

MAX_ROWS = 20_000
THRESHOLD = 0.7
CONTEXT = 4
STEM_SIZES = (4, 5, 6, 7)
REPEATED_SIZES = (3, 4, 5, 6, 7)
BURST, CHANCE = 4.0, 0.003  # of repeated stems: texts differ in language and subject, so a rate may be this much higher
MISSPELLED_SHARE = 0.25
# Words that report what somebody said, in the languages of the texts; more are learnt.
CUES = frozenset(
    "said says wrote quote quoted quotes called word words term slur insult insults report reported reports "
    "sagte schrieb zitat wort beleidigung nannte dit écrit citation mot insulte dijo escribió cita palabra insulto llamó".split()
)
MOST = (4, 4, 4)  # abuse, misspelled, mentions: counts above are as good as this
PRIOR_WEIGHTS = (-3.0, 5.0, 4.5, 2.0)  # base, abuse, misspelled, mention: used as they are without labels of both classes
# Prior evidence of the fit, as (counts, clean documents, toxic documents); real documents soon outweigh it.
PRIOR_CELLS = (((1, 0, 0), 0.3, 3.0), ((0, 1, 0), 0.4, 3.0), ((0, 0, 1), 3.0, 1.0), ((0, 0, 4), 3.0, 1.0))
CACHE_SIZE = 400_000
_QUOTES = re.compile("[\"“”„«»]")


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 3


def poisson_tail(k: int, mean: float) -> float:
    """Probability of ``k`` or more."""
    if k > mean + 20 * math.sqrt(mean) + 40:
        return 0.0
    below, term = 0.0, math.exp(-mean) if mean < 700 else 0.0
    if not term:  # a normal tail is close enough
        return 0.5 * math.erfc((k - 0.5 - mean) / math.sqrt(2 * mean))
    for i in range(k):
        below += term
        term *= mean / (i + 1)
    return max(0.0, 1 - below)


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    known: frozenset[str] = frozenset()
    cues: frozenset[str] = CUES
    weights: tuple[float, ...] = PRIOR_WEIGHTS
    repeated: dict[str, float] = field(default_factory=dict)  # repeated stems: share of a clean document's words

    def score(self, counts: tuple[int, ...]) -> float:
        x = [1.0, *(math.sqrt(min(c, m)) for c, m in zip(counts, MOST))]
        return 1 / (1 + math.exp(-sum(a * b for a, b in zip(self.weights, x))))


class Matcher:
    """A model's hits in texts; one for each Python worker."""

    def __init__(self, model: Model):
        self.model, self.automaton, self.cache = model, LexiconAutomaton(model.terms, [*model.stems, *model.repeated]), {}

    def kinds(self, own: set[str]) -> dict[str, str]:
        """Kind of each word that hits."""
        cache = self.cache
        if len(cache) > CACHE_SIZE:
            cache.clear()
        out, forms = {}, {}
        for w in own:
            found = cache.get(w, 0)
            if found == 0:
                found = self.automaton.match(w)
                found = cache[w] = None if found and found[0] == FUZZY and w in self.model.known else found
            if found is None:
                continue
            if found[0] == STEM and found[1] in self.model.repeated:
                forms.setdefault(found[1], []).append(w)
            else:
                out[w] = found[0]
        for stem, words in forms.items():
            if len(words) > 1 and poisson_tail(len(words), BURST * self.model.repeated[stem] * len(own)) < CHANCE:
                out.update(dict.fromkeys(words, STEM))
        return out

    def hits(self, text: str | None) -> list[tuple[str, str, bool, set[str]]]:
        """(word, kind, quoted, words around it) of each hit."""
        low = text.lower() if text else ""
        kinds = self.kinds(set(WORD_RE.findall(low)))
        if not kinds:
            return []
        found, all_words = [], list(WORD_RE.finditer(low))
        quotes = [m.start() for m in _QUOTES.finditer(low)]
        line, line_end, before, q = 0, -1, 0, 0
        for k, m in enumerate(all_words):
            kind = kinds.get(m.group())
            if not kind:
                continue
            if m.start() > line_end:  # quotes count from the start of the line on
                line = low.rfind("\n", 0, m.start()) + 1
                line_end = low.find("\n", m.start())
                line_end = len(low) if line_end < 0 else line_end
                while q < len(quotes) and quotes[q] < line:
                    q += 1
                before = q
            while q < len(quotes) and quotes[q] < m.start():
                q += 1
            quoted = (q - before) % 2 == 1 and q < len(quotes) and quotes[q] < line_end
            around = {x.group() for x in all_words[max(0, k - CONTEXT) : k + CONTEXT + 1] if x.group() not in kinds}
            found.append((m.group(), kind, quoted, around))
        return found

    def counts(self, text: str | None) -> tuple[int, int, int]:
        """Abuse, misspelled abuse, mentions."""
        out = [0, 0, 0]
        for _, kind, quoted, around in self.hits(text):
            out[2 if quoted or around & self.model.cues else 1 if kind == FUZZY else 0] += 1
        return tuple(out)


def _counted(rows: DataFrame, count, schema: str) -> DataFrame:
    """``count(texts, labels) -> {column: values}`` of each batch."""

    def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in got:
            out = count(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if out:
                yield pa.record_batch({k: pa.array(v) for k, v in out.items()})

    return rows.select("text", "toxic").mapInArrow(run, schema)


def _gram_counts(texts: list[str], labels: list[int]) -> dict[str, list]:
    """Documents with each word ("w="), stem ("s=") or two words of a stem ("r="), by label.

    Bits of the words before it in toxic ones, and of the words with a stem;
    words with a stem in clean documents (under "r="; "" counts all words).
    """
    n, contexts, forms, clean_words = (Counter(), Counter()), {}, {}, Counter()
    for text, toxic in zip(texts, labels):
        before, seen, begins = "", set(), {}
        for w in WORD_RE.findall(text.lower()):
            grams = ["w=" + w, *("s=" + w[:k] for k in STEM_SIZES if len(w) >= k), *("r=" + w[:k] for k in REPEATED_SIZES if len(w) >= k)]
            if grams[0] not in seen:
                for g in grams:
                    if g[0] == "r":
                        begins[g] = begins.get(g, 0) + 1
            seen.update(g for g in grams if g[0] != "r")
            if toxic:
                bit = 1 << (hash_word(before) % 63)
                form = 1 << (hash_word(w) % 63)
                for g in grams:
                    contexts[g] = contexts.get(g, 0) | bit
                    forms[g] = forms.get(g, 0) | form
            before = w
        n[toxic].update(seen)
        n[toxic].update(g for g, k in begins.items() if k > 1)
        if not toxic:
            clean_words.update(begins)
            clean_words["r="] += sum(1 for g in seen if g[0] == "w")
    grams = list(n[0].keys() | n[1].keys() | clean_words.keys())
    return {
        "gram": grams, "n_toxic": [n[1][g] for g in grams], "n_clean": [n[0][g] for g in grams], "contexts": [contexts.get(g, 0) for g in grams],
        "forms": [forms.get(g, 0) for g in grams], "clean_words": [clean_words[g] for g in grams],
    }


def hash_word(w: str) -> int:
    import zlib

    return zlib.crc32(w.encode())


def learn_lexicon(train: DataFrame, n_toxic: int, n_clean: int, least_odds: float = 20.0) -> tuple[list[str], list[str], dict[str, float]]:
    """(terms, stems, repeated stems): at least ``least_odds`` times as frequent in toxic documents, and in several contexts."""
    support = max(5, n_toxic // 200)
    names = ("n_toxic", "n_clean", "clean_words")
    grams = _counted(train, _gram_counts, "gram string, n_toxic long, n_clean long, contexts long, forms long, clean_words long")
    grams = grams.groupBy("gram").agg(*(F.sum(c).alias(c) for c in names), F.bit_or("contexts").alias("contexts"), F.bit_or("forms").alias("forms"))
    toxic_share, clean = (F.col("n_toxic") + 0.5) / (n_toxic + 1), F.col("n_clean")
    # for one word that is enough, two clean documents more than seen are assumed: a rare one needs more evidence
    rare = F.when(F.col("gram").startswith("r="), (clean + 0.5) / (n_clean + 1)).otherwise((clean + 2) / (n_clean + 4) * 1.5)
    odds = toxic_share / rare
    good = (F.col("n_toxic") >= support) & (odds >= least_odds) & (F.bit_count("contexts") >= F.least(F.lit(8), F.ceil(F.col("n_toxic") / 2)))
    rows = {r["gram"]: r for r in grams.where(good | (F.col("gram") == "r=")).collect()}
    n_words = max(1, rows.pop("r=")["clean_words"]) if "r=" in rows else 1
    found: dict[str, tuple[int, str]] = {}  # stem -> (toxic documents, gram)
    for kind in "sr":
        firsts: list[str] = []
        for g in sorted((g for g in rows if g[0] == kind), key=lambda g: (len(g), g)):
            if rows[g]["forms"].bit_count() < 4 or any(g[2:].startswith(f) for f in firsts):
                continue
            # a stem, unless one word makes up most of it
            most = max((r["n_toxic"] for w, r in rows.items() if w[0] == "w" and w[2:].startswith(g[2:])), default=0)
            if kind == "s" and most >= 0.6 * rows[g]["n_toxic"]:
                continue
            # as long as it loses hardly any document
            longer = [h for h in rows if h[0] == kind and h[2:].startswith(g[2:]) and rows[h]["n_toxic"] >= 0.95 * rows[g]["n_toxic"]]
            stem = max(longer, key=lambda h: (len(h), h))
            firsts.append(g[2:])
            if stem[2:] not in found or found[stem[2:]][0] < rows[stem]["n_toxic"]:
                found[stem[2:]] = (rows[stem]["n_toxic"], stem)
    chosen: list[str] = []  # of stems that begin alike, the one in most documents
    for stem in sorted(found, key=lambda k: (-found[k][0], k)):
        if not any(stem.startswith(c) or c.startswith(stem) for c in chosen):
            chosen.append(stem)
    repeated = {c: (rows[found[c][1]]["clean_words"] + 0.5) / n_words for c in sorted(chosen) if found[c][1][0] == "r"}
    terms = [g[2:] for g in rows if g[0] == "w" and not any(g[2:].startswith(c) for c in chosen)]
    return sorted(terms), sorted(c for c in chosen if c not in repeated), repeated


def learn_context(train: DataFrame, model: Model, least_odds: float = 5.0) -> tuple[frozenset[str], frozenset[str]]:
    """(known words, cues) of labelled documents."""

    def count(texts, labels):
        matcher, near, cues, n = Matcher(model), (Counter(), Counter()), (Counter(), Counter()), [0, 0]
        for text, toxic in zip(texts, labels):
            hits = matcher.hits(text)
            n[toxic] += 1
            near[toxic].update({w for w, kind, *_ in hits if kind == FUZZY})
            cues[toxic].update({a for _, kind, _, around in hits if kind != FUZZY for a in around})
        words = ["", *(near[0].keys() | near[1].keys() | cues[0].keys() | cues[1].keys())]
        near[0][""], near[1][""] = n
        return {"word": words, "near": [near[0][w] for w in words], "near_toxic": [near[1][w] for w in words], "clean": [cues[0][w] for w in words], "toxic": [cues[1][w] for w in words]}

    names = ("near", "near_toxic", "clean", "toxic")
    found = _counted(train, count, "word string, " + ", ".join(f"{c} long" for c in names)).groupBy("word").agg(*(F.sum(c).alias(c) for c in names))
    rows = found.where((F.col("word") == "") | (F.col("near") > 0) | ((F.col("clean") >= 5) & (F.col("clean") >= 8 * F.col("toxic")))).collect()
    n = next(((r["near"], r["near_toxic"]) for r in rows if r["word"] == ""), (0, 0))
    rows = [r for r in rows if r["word"]]
    known = frozenset(r["word"] for r in rows if r["near"] and (r["near_toxic"] + 0.5) / (n[1] + 1) < least_odds * (r["near"] + 0.5) / (n[0] + 1))
    return known, frozenset(r["word"] for r in rows if r["clean"] >= 5 and r["clean"] >= 8 * r["toxic"])


def misspell(text: str, terms: frozenset[str]) -> str:
    """``text`` with one letter of each term of five or more letters changed, as its hash and place say."""

    def change(m: re.Match) -> str:
        w = m.group()
        if w.lower() not in terms or len(w) < 5:
            return w
        h = hash_word(f"{w}{m.start()}")
        at = 1 + h % (len(w) - 1)
        return w[:at] + ("", "0", "x", w[at] * 2)[h // 64 % 4] + w[at + 1 :]

    return re.sub(WORD_RE.pattern, change, text)


def fit_weights(cells: list[tuple[tuple[int, ...], float, float]]) -> tuple[float, ...]:
    """Logistic weights by Newton's method on (counts, clean, toxic) and the prior evidence; a count whose weight would be negative gets 0."""
    free = [True] * 4
    while True:
        w = _newton([*cells, *PRIOR_CELLS], np.array(free))
        worst = min((v, k) for k, v in enumerate(w) if k)
        if worst[0] >= 0:
            return w
        free[worst[1]] = False


def _newton(cells: list[tuple[tuple[int, ...], float, float]], free: np.ndarray) -> tuple[float, ...]:
    x = np.array([[1.0, *(math.sqrt(min(c, m)) for c, m in zip(k, MOST))] for k, _, _ in cells])
    clean, toxic = (np.array([c[i] for c in cells], dtype=float) for i in (1, 2))
    x, w = x[:, free], np.array(PRIOR_WEIGHTS)[free]
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (toxic - (clean + toxic) * p) - 0.01 * w
        step = np.linalg.solve((x.T * ((clean + toxic) * p * (1 - p))) @ x + 0.01 * np.eye(len(w)), gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    out = np.zeros(4)
    out[free] = w
    return tuple(float(v) for v in out)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from labels whose id's crc32 modulo 3 is not 1; at most ``max_rows`` of them."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 1))
    own = own.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # at most max_rows ids: a proven bound for the broadcast
    train = written(texts.join(F.broadcast(own), "doc_id").select("text", "toxic", remainder(F.col("doc_id")).alias("half")), "labelled")
    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model()
    terms, stems, repeated = learn_lexicon(train, n[1], n[0])
    model = Model(terms, stems, cues=frozenset(), repeated=repeated)
    sides = [learn_context(train.where(F.col("half") == h), model) for h in (0, 2)]

    def cell_counts(texts, labels):
        matcher, plain = Matcher(Model(terms, stems, sides[0][0], sides[0][1] | CUES, repeated=repeated)), frozenset(terms)
        cells: dict = {}
        for text, toxic in zip(texts, labels):
            own = matcher.counts(text)
            key = tuple(min(c, m) for c, m in zip(own, MOST))
            cells.setdefault(key, [0.0, 0.0])[toxic] += 1
            if toxic and any(own):
                changed = misspell(text, plain)
                if changed != text:
                    key = tuple(min(c, m) for c, m in zip(matcher.counts(changed), MOST))
                    cells.setdefault(key, [0.0, 0.0])[1] += MISSPELLED_SHARE
        keys = list(cells)
        return {"a": [k[0] for k in keys], "b": [k[1] for k in keys], "c": [k[2] for k in keys], "clean": [cells[k][0] for k in keys], "toxic": [cells[k][1] for k in keys]}

    cells = _counted(train.where(F.col("half") == 2), cell_counts, "a long, b long, c long, clean double, toxic double")
    # sums of quarters are exact, in any order
    rows = cells.groupBy("a", "b", "c").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).collect()
    weights = fit_weights(sorted(((r["a"], r["b"], r["c"]), r["clean"], r["toxic"]) for r in rows))
    return Model(terms, stems, sides[0][0] | sides[1][0], (sides[0][1] & sides[1][1]) | CUES, weights, repeated)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows ``row`` (struct of the columns but the text), ``text``, ``score``, ``n_abuse``, ``n_misspelled``, ``n_mentions``."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    whole = docs.select(F.struct(*rest).alias("row"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value)
        for batch in got:
            counts = [matcher.counts(t.as_py()) for t in batch.column(1)]
            scores = {c: sent.value.score(c) for c in set(counts)}
            out = {"row": batch.column(0), "text": batch.column(1), "score": pa.array([scores[c] for c in counts], pa.float64())}
            yield pa.record_batch(out | {name: pa.array([c[k] for c in counts], pa.int64()) for k, name in enumerate(("n_abuse", "n_misspelled", "n_mentions"))})

    return whole.mapInArrow(run, f"row {whole.schema['row'].dataType.simpleString()}, text string, score double, n_abuse long, n_misspelled long, n_mentions long")
