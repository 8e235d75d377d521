"""Operator 4 against the tokenizer library itself."""

import random

import public_tokenizers as P
from dwspark.llm import tokens
from tokenizers import Tokenizer

PATH = P.path("word_bpe_49k.json")


def test_equals_the_library(spark):
    random.seed(5)
    alphabet = list("abcXYZ019 .,'\n\t<|>éÉßñΣσς€Ａ漢ﬁİ́  ") + ["'s", "'LL", "<|endoftext|>", "<|startoftext|>", " the", "ing"] * 3
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 80))) for _ in range(3000)]
    texts += ["", " ", "a" * 20_000, "word " * 30_000, "İΣ"]
    want = [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert tokens.count_tokens(texts, PATH, {}) == want
    rows = [(i, t, 7) for i, t in enumerate(texts)]
    got = tokens.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens long").repartition(5), PATH, limit=100).collect()
    assert [r["n_tokens"] for r in sorted(got)] == want
    assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 100) for r in got)


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string"
    got = tokens.token_counts(spark.createDataFrame([(None, None), (1, "a b"), (1, "a b")], schema), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == [(0, 0, 0), (1, 3, 2), (1, 3, 2)]
    assert tokens.token_counts(spark.createDataFrame([], schema), PATH).count() == 0


def test_frequent_table_is_bounded_and_keeps_the_heavy_ones(spark):
    rows = [(i, f"common words w{'abcdefghij'[i % 10] * (1 + i // 10)}") for i in range(2000)]
    found = tokens.frequent_pretokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(200), PATH, summary_size=16, table_size=32)
    assert {"common", "words"} <= set(found) and len(found) <= 32


def test_texts_of_other_scripts_use_the_tiers_too():
    random.seed(6)
    han, kana, hangul = lambda a, b: chr(random.randint(a, b)), "のをはがーカタメﾊ゙がゔ", "한국어가각각"
    alphabet = [han(0x4E00, 0x9FFF) for _ in range(40)] + list(kana) + list(hangul) + list("、。「」！？ 　 \t\nabZ9,.ё🙂👩‍👩‍👧́ ​̸=<|") + ["<|endoftext|>", " ", " the "] * 3
    alphabet += list("שלוםمرحباनमस्तेไทยքარΣσİı")
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(6000)]
    texts += ["漢字" * 20_000, "שלום עולם " * 10_000, "🙂" * 5_000, " ́x", "á ́", "゙か"]
    want = [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert tokens.count_tokens(texts, PATH, {}) == want
    top = {p: len(Tokenizer.from_file(PATH).encode(p, add_special_tokens=False).ids) for p in ("the", "の", "🙂")}
    assert tokens.count_tokens(texts, PATH, top) == want
    # only the piece with the emoji is not split into pre-tokens
    s = tokens._tools(PATH)
    assert tokens.lookups("Common words, 漢字 and 🙂! again", s) == ["common", "words", ",", "漢字", "and", "again", "🙂!"]
    assert all(len(p) <= tokens.PIECE_CHARS for p in s["cache"] if not s["plain"].fullmatch(p))
