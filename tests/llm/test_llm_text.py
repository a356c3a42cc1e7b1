"""Encoding, personal data, language model: against the library, plain regexes and plain counting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tidemark.llm import bpe, catalog, deleted_interp, pii_bootstrap
from tidemark.llm.tables import read


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


EDGE = [None, "", " ", "  \n ", "a  b", "foo  <|endoftext|> bar", "<|endoftext|><|endoftext|>", "x <|endoftext|>",
        "it's we'll  'S", "é ü  ß　y", "1 234  ½", "a\tb\r\n c", "日本語 🙂🙂 é", "word" * 2000,
        "a\x1cb\x85 c", "tail   "]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = catalog.vocabulary("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = EDGE + [r.text for r in read(spark, SF001, "documents").where("doc_id % 10 = 0").collect()]
    got = bpe.decode(bpe.encode(docs(spark, texts).withColumn("ids", F.lit("clash")), path), path).collect()
    assert len(got) == len(texts)
    for r in got:
        want = tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want, texts[r.doc_id]
        assert r.decoded == tok.decode(want, skip_special_tokens=False)


def test_bpe_query_round_trip(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF001, "documents").collect()}
    rows = catalog.QUERIES["op4_bpe"](spark, SF001).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: sha(t or "") for i, t in texts.items()}


def test_decoding_ids_that_cut_a_character(spark):
    path = catalog.vocabulary("byte_bpe_50k.json")
    ids = bpe.encode(docs(spark, ["🙂"]), path).first().ids
    cut = spark.createDataFrame([(0, ids[:1]), (1, [])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(cut, path).collect()} == {0: "�", 1: ""}


# ---------------------------------------------------------------- personal data
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PII = [None, "", "a@b.c@d.e", "x@y@z.com a.b_x@d.e.", "é ü bob.1@mail.example.com, 1.2.3.4.5.6.7.8", "999.1.1.1 001.002.3.4",
       "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (988) 555-2485. +12 3", "+49 30 123456-78 x 4111111111111111",
       "no digits", "1" * 400 + "@" + "a" * 300, "a" * 5000 + " 7", "🙂 q@r.st 🙂 10.0.0.1"]


def test_base_spans_equal_plain_regexes(spark):
    got = pii_bootstrap.find(docs(spark, PII + PII).withColumn("base", F.lit(1))).select(
        "doc_id", pii_bootstrap.render(F.col("base")).alias("b"), pii_bootstrap.render(F.col("spans")).alias("s")).collect()
    for r in got:
        want = plain_spans((PII + PII)[r.doc_id])
        assert r.b == ",".join(want), PII[r.doc_id % len(PII)]
        assert set(want) <= set(r.s.split(",")) | {""}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="a1.@+-() 4é", max_size=40), min_size=20, max_size=20))
def test_base_spans_on_random_texts(spark, texts):
    rows = docs(spark, texts).select("doc_id", pii_bootstrap.render(F.transform(
        pii_bootstrap.base_spans(F.col("text")), lambda s: F.struct(s["kind"], s["start"], s["end"]))).alias("b"))
    for r in rows.collect():
        assert r.b == ",".join(plain_spans(texts[r.doc_id])), texts[r.doc_id]


def test_pii_query(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF001, "documents").collect()}
    for r in catalog.QUERIES["op9_pii"](spark, SF001).collect():
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == sha(",".join(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k, _ in PATTERNS]
        assert set(want) <= set(r.spans.split(",")) | {""}


def test_bootstrap_finds_identifiers_of_a_known_pattern(spark):
    """Phones without a country code share the end of known phones; codes and versions do not."""
    known = [f"call us at +1 ({200 + i}) 555-{1000 + i} today" for i in range(30)]
    new = ["reach me at (919) 555-7777 please", "license version 2.0 of 2004", "code AKIA99XX11 here"]
    rows = pii_bootstrap.find(docs(spark, known + new)).where("doc_id >= 30").collect()
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in rows}
    assert spans == {30: [(3, 12, 26)], 31: [], 32: []}


def test_bootstrap_finds_as_many_unseen_as_known(spark):
    """Unknown instances are neutral; those that fail the kind's check speak against the pattern."""
    known = [f"call us at +1 ({200 + i}) 555-{1000 + i} today" for i in range(30)]
    new = [f"reach me at ({300 + i}) 555-{7000 + i} please" for i in range(30)]
    rows = pii_bootstrap.find(docs(spark, known + new)).where("doc_id >= 30").collect()
    assert {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in rows} == {
        30 + i: [(3, 12, 26)] for i in range(30)}
    against = [f"see lines {100 + i}-{1000 + i} there" for i in range(30)]
    rows = pii_bootstrap.find(docs(spark, known + against)).where("doc_id >= 30").collect()
    assert all(r.spans == [] for r in rows)


def test_bootstrap_finds_numbers_in_long_runs(spark):
    known = [f"call us at +1 ({200 + i}) 555-{1000 + i} today" for i in range(30)]
    run = "list: " + " ".join(f"({300 + i}) 555-{7000 + i}" for i in range(12)) + " end"
    two = "both (919) 555-7777 (919) 555-7778 here"
    rows = pii_bootstrap.find(docs(spark, [*known, run, two])).where("doc_id >= 30").collect()
    assert {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in rows} == {
        30: [(3, 6 + 15 * i, 20 + 15 * i) for i in range(12)], 31: [(3, 5, 19), (3, 20, 34)]}


def test_masking(spark):
    d = docs(spark, ["mail a@b.cd or +49 30 123456-78!", None, "none", "x@y.zz"]).withColumn("n_chars", F.lit(1))
    got = {r.doc_id: r.text for r in pii_bootstrap.masked(d).collect()}
    assert got == {0: "mail [EMAIL] or [PHONE]!", 1: None, 2: "none", 3: "[EMAIL]"}
    assert pii_bootstrap.masked(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- language model
def tokens(text):
    lower = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\0end"]


def test_base_scores_equal_plain_counts(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF001, "documents").collect()}
    unseen = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    c = Counter(t for i, x in texts.items() if not unseen[i] for t in tokens(x))
    n, v = sum(c.values()), len(c)
    rows = catalog.QUERIES["op7_lm_scoring"](spark, SF001).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        t = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            unseen[r.doc_id], len(t), sum(c[x] > 0 for x in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), rel_tol=1e-9)
        assert r.score < 0
    new = [r for r in rows if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)  # the model predicts unseen texts better


def test_model_scores_equal_plain_interpolation(spark):
    """Every count that the blocks exchange enters the score as plain counting gives it."""
    texts = ["The cat sat", "the cat ran on", "a dog sat", None, "the the the", "cat", "The cat sat", "zebra cat"]
    unseen = F.col("doc_id") == 7
    got = {r.doc_id: r for r in deleted_interp.score(docs(spark, texts), unseen, block_ids=3).collect()}
    train = [tokens(t) for t in texts[:7]]
    uni = Counter(t for x in train for t in x)
    pair = Counter(p for x in train for p in zip(["\0begin", *x], x))
    n, v = sum(uni.values()), len(uni)
    context = uni + Counter({"\0begin": len(train)})
    for i, t in enumerate(texts):
        x = tokens(t)
        p = [(pair[h, w] / max(context[h], 1), uni[w] / n, 1 / (v + 1)) for h, w in zip(["\0begin", *x], x)]
        low = sum(math.log10(min(y for y in q if y > 0)) for q in p) - 7 * len(p)
        assert low < got[i].score <= sum(math.log10(max(q)) for q in p) + 1e-9
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(x), sum(uni[w] > 0 for w in x), n)


def test_model_scores_are_exact_for_given_weights(spark, monkeypatch):
    """Scores with fixed weights per context bucket; estimates of the held-out rows leave these rows out of all counts."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["The", "the", "cat", "sat", "on", "é", "mat" + str(rng.randrange(9))], k=rng.randrange(9)))
             for _ in range(90)]
    weights = np.random.default_rng(1).dirichlet([2, 2, 2], 66)
    seen = []
    monkeypatch.setattr(deleted_interp, "learn_weights", lambda cells, v: seen.extend(cells) or weights)
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = deleted_interp.score(d, F.col("doc_id") % 5 == 1, block_ids=16).collect()
    train = [(i, tokens(t)) for i, t in rows if i is None or i % 5 != 1]
    hashes = {r.doc_id: r.h for r in d.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(deleted_interp.HELD_SHARE)).alias("h")).collect()}

    def counts(part):
        uni = Counter(w for x in part for w in x)
        return uni, Counter(p for x in part for p in zip(["\0begin", *x], x)), uni + Counter({"\0begin": len(part)})

    uni, pair, context = counts([x for _, x in train])
    n, v = sum(uni.values()), len(uni)

    def score(x):
        total = 0.0
        for h, w in zip(["\0begin", *x], x):
            lam = weights[1 + int(math.log2(context[h])) if context[h] else 0]
            total += math.log10(lam[0] * pair[h, w] / max(context[h], 1) + lam[1] * uni[w] / n + lam[2] / (v + 1))
        return total

    want = sorted((str(i), score(tokens(t))) for i, t in rows)
    got = sorted((str(r.doc_id), r.score) for r in out)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert all(math.isclose(a, b, rel_tol=1e-9) for (_, a), (_, b) in zip(got, want))
    held = [x for i, x in train if hashes[i] == 0]
    uni, _, _ = counts([x for i, x in train if hashes[i] != 0])
    mean = sum(uni[w] for x in held for w in x) / sum(uni.values())
    assert held and math.isclose(sum(c * p1 for _, c, _, p1 in seen), mean, rel_tol=1e-9)


def test_counts_beyond_four_bytes():
    for x in ([], [0, 5], [7, 1 << 32], [1 << 40, 3]):
        assert deleted_interp._unpack_counts(deleted_interp._pack_counts(np.array(x, np.int64))).tolist() == x


def test_weights_by_em_follow_the_held_out_tokens():
    sure = [(3, 100.0, 0.5, 0.01)]
    none = [(0, 100.0, 0.0, 0.01)]
    lam = deleted_interp.learn_weights(sure + none, v=1000)
    assert lam[3][0] > 0.8 and lam[0][1] > 0.8
    assert abs(lam.sum(1) - 1).max() < 1e-6


def test_language_model_of_nothing(spark):
    assert deleted_interp.score(docs(spark, []), F.lit(False)).count() == 0
    only = deleted_interp.score(docs(spark, ["a b", None]), F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, round(r.score, 9)) for r in only} == {(0, 0, round(r.score, 9)) for r in only}


def test_added_spans_belong_to_their_text(spark):
    """Rows of one id or without an id get the spans of their own text, in the query's form and masked."""
    learn = [(1000 + k, f"call now +1 (9{k:02d}) 555-{2000 + k} today") for k in range(40)]
    clean, hit = "a nice text without any such numbers in it at all", "call now (919) 555-7777 today"
    rows = learn + [(40, clean), (40, hit), (40, clean + "!"), (None, hit), (None, clean), (None, hit)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = pii_bootstrap.masked(d).collect()
    found = Counter((r.doc_id, r.text) for r in out if r.doc_id in (40, None))
    assert len(out) == len(rows)
    masked = {t for _, t in found if "[PHONE]" in t}
    assert len(masked) == 1 and found[40, masked.copy().pop()] == 1 and found[None, masked.pop()] == 2
    assert found[40, clean] == found[40, clean + "!"] == found[None, clean] == 1
    spans = Counter((r.doc_id, len(r.spans)) for r in pii_bootstrap.find(d).collect() if r.doc_id in (40, None))
    assert spans == {(40, 0): 2, (40, 1): 1, (None, 1): 2, (None, 0): 1}


def test_spans_of_a_text_full_of_identifiers(spark):
    n = 20_000
    text = " ".join(f"user{i}@mail{i}.com" for i in range(n))
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = d.select(pii_bootstrap.base_spans(F.col("text")).alias("s")).first().s
    assert [f"email:{s.start}:{s.end}" for s in spans] == plain_spans(text) and len(spans) == n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab1'é日🙂 \t\n  　\x1c\x85.<|"), max_size=25) | st.just("x<|endoftext|> \n<|endoftext|>y"),
                max_size=4))
def test_words_are_a_safe_cut(texts):
    import pyarrow as pa

    path = catalog.vocabulary("byte_bpe_50k.json")
    tok = bpe._tokenizer(path)
    found, sizes = bpe.words(pa.array(texts, pa.large_string()), ["<|endoftext|>"])
    flat, at = found.to_pylist(), 0
    for text, n in zip(texts, sizes, strict=True):
        parts = flat[at:at + n]
        at += n
        assert "".join(parts) == text
        want = tok.encode(text, add_special_tokens=False).ids
        assert [i for p in parts for i in tok.encode(p, add_special_tokens=False).ids] == want


def test_bpe_of_texts_without_words(spark):
    path = catalog.vocabulary("byte_bpe_50k.json")
    got = bpe.decode(bpe.encode(docs(spark, [None, "", None]), path), path).collect()
    assert sorted((r.doc_id, r.ids, r.decoded) for r in got) == [(0, [], ""), (1, [], ""), (2, [], "")]
    assert bpe.encode(docs(spark, []), path).collect() == []


def test_bpe_slice_in_bounded_memory():
    """A gathered slice holds no text, and its ids are given some documents at a time."""
    import pyarrow as pa

    path = catalog.vocabulary("byte_bpe_50k.json")
    tok, rng = bpe._tokenizer(path), random.Random(5)
    known = ["w%d" % (k * 7919) for k in range(500)]
    texts = [" ".join(rng.choices(known, k=2500)) for _ in range(1000)] + ["", "<|endoftext|>"]
    usual, pool = pa.default_memory_pool(), pa.system_memory_pool()
    pa.set_memory_pool(pool)
    start = pool.bytes_allocated()
    try:
        gathered, rows = bpe._Slice(), pa.array(texts, pa.large_string())
        size = rows.nbytes
        for first, run in bpe.ts.slices(rows):
            gathered.add(pa.array(range(first, first + len(run))), run, *bpe.words(run, ["<|endoftext|>"]))
        del rows, run
        assert pool.bytes_allocated() - start < size // 2
        own, dealt = (pa.Table.from_batches([b]) for b in (gathered.numbers(3), gathered.dealt(3, 7)))
        found = []
        for row in dealt.to_pylist():
            ids = [tok.encode(w, add_special_tokens=False).ids
                   for w in bpe._unpacked_strings(row["word_lengths"], row["words"], row["n"]).to_pylist()]
            found.append(row | {"n_ids": sum(map(len, ids)), "lengths": bpe._packed(np.array([len(x) for x in ids])),
                                "word_ids": bpe._packed(np.array([i for x in ids for i in x]))})
        found, got, most = pa.Table.from_pylist(found), {}, 0
        before = pool.bytes_allocated()
        for first, lists in bpe._slice_ids(own, found):
            most = max(most, pool.bytes_allocated() - before)
            got |= enumerate(lists.to_pylist(), first)
    finally:
        pa.set_memory_pool(usual)
    assert sorted(got) == list(range(len(texts)))
    assert most < 4 * sum(map(len, got.values())) // 2
    for k in [0, 1, 499, 998, 999, 1000, 1001]:
        assert got[k] == tok.encode(texts[k], add_special_tokens=False).ids
