"""Periodic runs: the enhanced suffix array against the definition."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import catalog, suffix_runs
from tidemark.llm import textstats as ts
from tidemark.llm.tables import read

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(words, min_words=24, min_periods=3):
    """Every maximal stretch of smallest period q, q by q."""
    n, out = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - i + q
            if length >= max(min_words, min_periods * q):
                part = words[i:i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts, min_words=24, min_periods=3):
    w = ts.words(pa.array(texts, pa.large_string()))
    got = suffix_runs.slice_runs(w, len(texts), min_words, min_periods)
    return [got.get(i, []) for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=5), st.sampled_from([(2, 2), (6, 3), (5, 2), (24, 3)]))
def test_short_words_of_two_letters(docs, least):
    assert found([" ".join(d) for d in docs], *least) == [brute(d, *least) for d in docs]


def test_planted_periods():
    rng = random.Random(3)
    docs = []
    for k in range(60):
        words = [rng.choice("abcdefg") + str(rng.randrange(3 + k)) for _ in range(rng.randrange(0, 400))]
        for _ in range(rng.randrange(4)):
            unit = [rng.choice("xyz") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 20))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (unit * 12)[: rng.randrange(len(unit) * 2, len(unit) * 9 + 1)]
        docs.append(words)
    docs += [["a"] * 500, ["a", "b"] * 300 + ["a"] * 100, [], ["a"] * 23, ["a"] * 24, ["a", "b", "c", "d", "e", "f", "g", "h"] * 3]
    want = [brute(d) for d in docs]
    assert found([" ".join(d) for d in docs]) == want
    assert sum(map(len, want)) > 60


def test_long_periodic_text_takes_no_square_time():
    words = (["w%d" % i for i in range(700)] * 30)[:20_000]
    assert found([" ".join(words), " ".join(["same"] * 20_000)]) == [[(0, 20_000, 700)], [(0, 20_000, 1)]]


def planted(i, text):
    """The words of a document as the query rebuilds them."""
    words = WORD.findall(text or "")
    h = zlib.crc32(str(i).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want_row(i, words):
    runs = brute(words)
    drop = {j for s, length, q in runs for j in range(s + q, s + length)}
    best = suffix_runs.strongest(runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *top, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(x for j, x in enumerate(words) if j not in drop)))


def test_query_equals_brute_force(spark):
    rows = [r for r in read(spark, SF001, "documents").collect() if len(r.text or "") < 30_000]
    want = {r.doc_id: want_row(r.doc_id, planted(r.doc_id, r.text)) for r in rows if len(WORD.findall(r.text or "")) < 1200}
    got = {r.doc_id: tuple(r) for r in catalog.QUERIES["op12_periodic_runs"](spark, SF001).collect()}
    assert len(want) > 900
    assert {i: got[i] for i in want} == want
    assert sum(w[1] > 0 for w in want.values()) > 50


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "x " * 30, 3), (4, "x " * 30, 4), (4, "x " * 30, 5), (5, "é " * 30, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed)
                  for r in suffix_runs.periodic_runs(docs).collect()), key=str)
    run = (0, 30, 1)
    assert got == sorted([(1, [], None, ""), (2, [], None, ""), (None, [run], run, "x"), (4, [run], run, "x"),
                          (4, [run], run, "x"), (5, [], None, "é " * 30)], key=str)
    assert suffix_runs.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        suffix_runs.periodic_runs(docs, min_periods=1)
