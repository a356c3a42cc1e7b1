"""Exact duplicates: the extendible-hash index against a plain fold."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import hash_index

WHITE = re.compile("[\x20\x09-\x0D]")


def plain(rows):
    """(doc_id, keep_id, group_size, text_sha256) per row, and the groups' numbers of kept rows."""
    groups = {}
    for i, text in rows:
        groups.setdefault(WHITE.sub("", text or ""), []).append((-len(text or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)[3]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[3], keep, len(members), sha) for m in members]
    return sorted(out, key=str)


def found(df):
    rows = df.collect()
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    kept = [(r.text_sha256) for r in rows if r.kept]
    assert sorted(kept) == sorted({r.text_sha256 for r in rows})  # one row of each group stays
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=str)


LONG = "a very long text " * 20_000
ROWS = ([(1, "a b"), (2, "ab "), (3, "a\tb\n\x0b\x0c\r"), (4, None), (5, ""), (6, " \n"), (7, "é b"), (8, "éb"), (9, "éb"),
         (10, "a b"), (11, "a b"), (12, LONG), (13, LONG + " "), (None, "ab"), (None, "lonely"), (None, "lonely"),
         (2, "ab "), (14, "A B")] + [(100 + k, "hot copy" + " " * (k % 3)) for k in range(300)]
        + [(1000 + k, f"text {k}") for k in range(200)])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)


def few_keys(text):
    return F.xxhash64(F.pmod(F.xxhash64(text), F.lit(7)))


@pytest.mark.parametrize("key,capacity", [(F.xxhash64, None), (F.xxhash64, 1000), (few_keys, None), (few_keys, 2000)])
def test_groups_equal_a_plain_fold(docs, key, capacity):
    assert found(hash_index.exact_duplicates(docs, key=key, capacity=capacity)) == plain(ROWS)


def test_chains_hold_every_row_and_collisions_are_found(docs):
    index = hash_index.build(docs, key=few_keys, capacity=2000)
    assert index.links.agg(F.sum("_rows")).first()[0] == len(ROWS)
    assert index.collided.count() == 7
    assert index.links.agg(F.max("_page")).first()[0] > 0  # keys beyond a bucket have overflow pages
    assert hash_index.build(docs).collided.isEmpty()


def test_doubling_splits_only_overfull_buckets():
    assert hash_index.split_overfull({}, 4, 10) == [0, 1]
    assert hash_index.split_overfull({0: 9, 15: 9}, 4, 10) == [0, 1]
    # slots 0 and 1 of 16 together overfill their bucket down to the last bit
    assert hash_index.split_overfull({0: 6, 1: 6, 15: 3}, 4, 10) == [0, 1, 2, 2, 3, 3, 3, 3] + [4] * 8
    assert hash_index.split_overfull({3: 99}, 2, 10) == [0, 0, 1, 2]


def test_empty_table_types_and_clashing_names(spark, docs):
    assert hash_index.exact_duplicates(docs.limit(0)).collect() == []
    odd = spark.createDataFrame([("x", "t 1", 5, 6, 7), ("y", "t1", 5, 6, 7), (None, "t1", 5, 6, 7)],
                                "name string, body string, keep_id int, _key int, kept int")
    rows = hash_index.exact_duplicates(odd, id_col="name", text_col="body").collect()
    assert sorted((r.name, r.keep_id, r.group_size, r.kept) for r in rows if r.name) == [
        ("x", "x", 3, True), ("y", "x", 3, False)]


def test_plan_has_no_python(docs):
    plan = hash_index.exact_duplicates(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
