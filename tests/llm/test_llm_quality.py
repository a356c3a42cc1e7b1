"""Rules, forest, token counts, shards, classifier: against brute force and held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF001
from tidemark.llm import catalog, fm_quality, rules_forest, sharding, token_counts
from tidemark.llm.tables import read

TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "x\n\nx\ny\nx ", "# $a% b|c <d>", "é ü ß wort",
         "w " * 60, "word" * 3000, "\n".join(["same line"] * 4), "A" * 50 + " b", "a b c a b c"]


def docs(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name, value in more.items():
        df = df.selectExpr("*", f"{value} AS {name}")
    return df


def rule_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k: k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_rule_counts_against_brute_force(spark):
    got = rules_forest.rule_statistics(docs(spark, TEXTS, features="'clash'")).collect()
    for r in got:
        want = rule_counts(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, TEXTS[r.doc_id]


def test_rules_query(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF001, "documents").collect()}
    marks = {r.doc_id: r.quality for r in read(spark, SF001, "labels").collect()}
    rows = catalog.QUERIES["op1_quality_rules"](spark, SF001).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        n, chars, sym, dup, rep = rule_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, sym, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (r.base_failed and r.kept)
    judged = [(r.kept, marks[r.doc_id]) for r in rows if r.doc_id in marks and not r.base_failed]
    assert np.mean([kept for kept, good in judged if good]) > 0.97
    assert np.mean([kept for kept, good in judged if not good]) < 0.1


def test_forest_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = {r.doc_id: r.kept for r in rules_forest.apply_rules(docs(spark, TEXTS), none).collect()}
    assert got == {i: rule_counts(t)[0] >= 50 and 2 * rule_counts(t)[4] <= rule_counts(t)[0]
                   for i, t in enumerate(TEXTS)}
    assert rules_forest.apply_rules(docs(spark, []), none).count() == 0


def test_forest_sets_outliers_apart():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (500, 3)), rng.normal(12, 1, (20, 3))])
    s = rules_forest.Forest(x, 50, 256, 4, seed=1).score(x)
    assert s[500:].min() > np.quantile(s[:500], 0.99)


def test_calibration_prefers_the_separating_edge():
    hist = np.zeros((rules_forest.BINS, 2))
    hist[300, 1], hist[700, 0] = 90, 10
    assert 0.3 < rules_forest.calibrate(hist) <= 0.7


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    path = catalog.vocabulary("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def test_token_counts_equal_the_library(spark, word_tokenizer):
    path, tok = word_tokenizer
    texts = TEXTS + ["it's <|endoftext|> é ́x", "<|startoftext|>a<|endoftext|>", "a\x1cb\x85c d", "1234 ½ ٣",
                     "日本語テキスト 🙂🙂", "İSTANBUL ΣΑΣ"]
    got = {r.doc_id: r for r in token_counts.token_counts(docs(spark, texts, n_tokens="0"), path, limit=20).collect()}
    for i, t in enumerate(texts):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 20), t


def test_token_counts_on_the_table(spark, word_tokenizer):
    path, tok = word_tokenizer
    texts = {r.doc_id: r.text for r in read(spark, SF001, "documents").collect()}
    got = {r.doc_id: r.n_tokens for r in catalog.QUERIES["op2_token_counts"](spark, SF001).collect()}
    ids = sorted(texts)[::9]
    want = [len(e) for e in tok.encode_batch([texts[i] for i in ids], add_special_tokens=False)]
    assert set(got) == set(texts) and [got[i] for i in ids] == want


def test_token_counts_refuse_tokenizers_that_keep_spaces():
    with pytest.raises(ValueError, match="white space"):
        token_counts.PieceLengths(catalog.vocabulary("byte_bpe_50k.json"))


def test_shards_are_contiguous_balanced_and_gapless(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF001, "documents").collect()}
    rows = catalog.QUERIES["op3_sharding"](spark, SF001).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    biggest = max(r.size for r in rows)
    total = sum(r.size for r in rows)
    for s in range(8):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 8) <= biggest
    order = [(r.shard, r.slot) for r in sorted(rows, key=lambda r: (r.text_crc32, r.doc_id))]
    assert order == sorted(order)


def test_shards_of_edge_rows(spark):
    got = sharding.byte_shards(docs(spark, [None, "", "a", "a", "a"] * 3, shard="'clash'"), 4).collect()
    assert len(got) == 15 and Counter(r.size for r in got) == {1: 6, 2: 9}
    same = spark.createDataFrame([(1, "t")] * 6, "doc_id bigint, text string")
    got = sharding.byte_shards(same, 3).collect()
    assert Counter(r.shard for r in got) == {0: 2, 1: 2, 2: 2}
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(3) for k in range(2)]
    assert sharding.byte_shards(docs(spark, []), 4).count() == 0


def test_classifier_held_out_accuracy(spark):
    marks = {r.doc_id: r.quality for r in read(spark, SF001, "labels").collect()}
    rows = catalog.QUERIES["op5_quality_classifier"](spark, SF001).collect()
    assert len(rows) == read(spark, SF001, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    assert np.mean([p == q for p, q in held]) > 0.95


def test_machine_uses_the_sum_of_squares_identity():
    rng = np.random.default_rng(3)
    size = fm_quality.BUCKETS + fm_quality.NUMBERS * (1 + fm_quality.BINS)
    m = fm_quality.Machine(w=rng.normal(size=size), v=rng.normal(size=(size, 3)), bias=0.5)
    f, x = np.array([3, 70, 500]), np.array([0.5, -1.0, 2.0])
    pairs = sum(m.v[f[i]] @ m.v[f[j]] * x[i] * x[j] for i in range(3) for j in range(i + 1, 3))
    assert m.margin(np.zeros(3, int), f, x, 1)[0] == pytest.approx(0.5 + m.w[f] @ x + pairs)


def test_classifier_edge_rows(spark):
    d = docs(spark, TEXTS, n_chars="CAST(NULL AS BIGINT)", score="'clash'")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = fm_quality.fit(d, none)
    assert {r._score for r in fm_quality.with_scores(d, model, out="_score").collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))] + [(3, None)], "doc_id bigint, quality int")
    scored = fm_quality.with_scores(d, fm_quality.fit(d, some), out="_score")
    assert scored.columns == [*d.columns, "_score"] and scored.count() == len(TEXTS)
    assert fm_quality.fit(docs(spark, [], n_chars="1L"), some).mean is None
