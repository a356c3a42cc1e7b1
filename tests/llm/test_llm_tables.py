"""Nearest neighbours, Jaccard join, mix and pipeline: against brute force and the SQL."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from conftest import SF001
from oracle_compare import duck
from pyspark.sql import functions as F
from tidemark.llm import catalog, chosen_path, mixing, multi_index
from tidemark.llm.mixing import Level
from tidemark.llm.tables import read


def docs(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


# ---------------------------------------------------------------- nearest neighbours
def brute_neighbours(rows, is_query, k):
    x = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in filter(is_query, x):
        s = sorted(((float(x[q] @ v), i) for i, v in x.items() if i != q), key=lambda t: (-t[0], t[1]))
        out[q] = s[:k]
    return out


def test_search_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in read(spark, SF001, "embeddings").collect()]
    want = brute_neighbours(rows, lambda i: i % 20 == 0, 20)
    got = defaultdict(list)
    for r in catalog.QUERIES["op6_nearest_neighbours"](spark, SF001).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    hits = 0
    for q, best in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        exact = {i: s for s, i in brute_neighbours(rows, lambda i: i == q, len(rows))[q]}
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in mine)
        assert mine == sorted(mine, key=lambda t: (-t[2], t[1]))
        hits += len({i for _, i, _ in mine} & {i for _, i in best})
    assert set(got) == set(want) and hits / (20 * len(want)) >= 0.9


def test_search_prunes_and_still_finds(spark):
    """With few centroids and a small share of cells, near vectors are found among several thousand."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 4
    x = centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16)) * 0.5
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = multi_index.search(df, F.col("id") % 100 == 0, k=5, centroids=16, probe=0.1, least=100).collect()
    want = brute_neighbours(list(enumerate(x)), lambda i: i % 100 == 0, 5)
    hits = sum(r.vec_id in {i for _, i in want[r.query_id]} for r in found)
    assert len(found) == 150 and hits / 150 >= 0.9


def test_search_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (9, []), (20, [1.0, 0.0]), (40, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = multi_index.search(df, F.col("id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 1, 1.0), (0, 2, 20, 1.0), (0, 3, 2, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 0.0)]
    assert multi_index.search(df.where("vec_id = 3"), F.lit(True)).count() == 0


def test_repeated_query_rows_have_lists_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [0.5, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = multi_index.search(df, F.col("id") % 20 == 0, k=3).collect()
    want = []
    for n, (i, v) in enumerate(rows[:3]):
        others = sorted((-(v[0] * w[0] + v[1] * w[1]), j) for m, (j, w) in enumerate(rows) if m != n)
        want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(others[:3])]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_walk_visits_cells_by_falling_sum():
    rng = np.random.default_rng(2)
    books = multi_index.Codebooks(rng.normal(size=(200, 6)), 8)
    q, sizes = rng.normal(size=6), np.ones((8, 8), int)
    sums = [books.first[i] @ q[:3] + books.second[j] @ q[3:] for i, j in books.walk(q, sizes, 64)]
    assert len(sums) == 64 and sums == sorted(sums, reverse=True)
    assert len(books.walk(q, sizes, 10)) == 10


# ---------------------------------------------------------------- Jaccard join
def shingle_set(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_join(rows, similarity=0.8):
    """(links, class) of every id, by comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    by = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            by[g].add(i)
    links, parent = Counter(), {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j in {j for g in s for j in by[g] if j > i}:
            both = len(s & sets[j])
            if both >= similarity * (len(s) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: (links[i], top(i)) for i in sets}


def near_copies(rng, base, count, changes):
    out = []
    for _ in range(count):
        w = base.split()
        for _ in range(changes):
            w[rng.integers(len(w))] = f"new{rng.integers(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_join_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF001, "documents").collect()]
    want = brute_join(rows)
    got = {r.doc_id: (r.n_links, r.class_id) for r in catalog.QUERIES["op8_jaccard_join"](spark, SF001).collect()}
    assert got == want


def test_join_of_groups_larger_than_a_node(spark, monkeypatch):
    """Small nodes: sets split along paths, and what no token splits is compared in blocks; no link is lost."""
    monkeypatch.setattr(chosen_path, "BUCKET", 8)
    monkeypatch.setattr(chosen_path, "LEVELS", 1)
    rng = np.random.default_rng(4)
    base = " ".join(f"w{i}" for i in range(120))
    texts = near_copies(rng, base, 40, 1) + near_copies(rng, base, 20, 3) + [f"other {i} text of its own words" for i in range(20)]
    got = {r.doc_id: (r.n_links, r.class_id) for r in chosen_path.jaccard_join(docs(spark, texts)).collect()}
    want = brute_join(list(enumerate(texts)))
    assert sum(n for n, _ in got.values()) >= 0.995 * sum(n for n, _ in want.values())
    assert {i: c for i, (_, c) in got.items()} == {i: c for i, (_, c) in want.items()}


def test_runs_hold_the_recall_at_the_deepest_level():
    """A pair at the threshold, its equal tokens varying, whose common nodes split to the last level."""
    deepest, miss = chosen_path.LEVELS + 1, 1 - chosen_path.RECALL
    first, more = chosen_path.plan_runs(chosen_path.RECALL, deepest)
    assert chosen_path.lost(15, 0, deepest) > 0.02
    assert chosen_path.lost(first, more, deepest) <= miss < chosen_path.lost(first, more - 1, deepest)
    assert chosen_path.lost(first, 0, chosen_path.SPLITS) <= miss


def test_join_recall_at_the_last_level(spark, monkeypatch):
    """A group of different near copies at the threshold, in nodes that split to the last level: links are found."""
    monkeypatch.setattr(chosen_path, "BUCKET", 24)
    rng = np.random.default_rng(11)
    base = " ".join(f"w{i}" for i in range(97))
    texts = near_copies(rng, base, 90, 1)
    seen, block = [], chosen_path.keep
    monkeypatch.setattr(chosen_path, "keep", lambda df, name: seen.append(name) or block(df, name))
    got = {r.doc_id: r.n_links for r in chosen_path.jaccard_join(docs(spark, texts)).collect()}
    want = {i: n for i, (n, _) in brute_join(list(enumerate(texts))).items()}
    assert f"nodes_{chosen_path.LEVELS}" in seen
    found = sum(got.values()) / sum(want.values())
    print("recall", found)
    assert all(got[i] <= want[i] for i in want) and found >= chosen_path.RECALL


def test_join_edge_rows(spark):
    texts = [None, "", "  ", "one two", "one  two", "one three", "a b c d e", "a b c d e", "word " * 6000, "word " * 300]
    d = docs(spark, texts).withColumn("rep", F.lit("clash")).withColumn("class_id", F.lit(1))
    got = {r.doc_id: (r.class_id, r.copy_id, r.n_links) for r in chosen_path.jaccard_join(d).collect()}
    assert got == {0: (0, 0, 0), 1: (1, 1, 0), 2: (2, 2, 0), 3: (3, 3, 1), 4: (3, 3, 1), 5: (5, 5, 0), 6: (6, 6, 1),
                   7: (6, 6, 1), 8: (8, 8, 1), 9: (8, 8, 1)}
    assert chosen_path.jaccard_join(docs(spark, [])).count() == 0
    twice = docs(spark, ["x y z"]).union(docs(spark, ["x y z"])).union(docs(spark, ["x y z"], 1))
    classes = chosen_path.jaccard_join(twice)
    assert [(r.class_id, r.n_links) for r in classes.collect()] == [(0, 2)] * 3
    assert [r.doc_id for r in chosen_path.one_of_each(twice, classes).collect()] == [0]


def test_rows_without_id_and_ids_on_two_texts(spark):
    """Every row stands for its own text: against brute force over row numbers."""
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4)]
    near = lambda t, k: " ".join(["new%d" % k, *t.split()[1:]])
    rows = [(None, base[0]), (None, near(base[0], 1)), (1, base[1]), (1, base[2]), (3, near(base[2], 2)), (4, near(base[1], 3)),
            (5, base[3]), (5, base[3]), (None, base[3]), (None, ""), (None, None), (6, "alone here")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_join([(k, t) for k, (_, t) in enumerate(rows)])
    out = chosen_path.jaccard_join(d)
    got = sorted((str(r.doc_id), r.n_links) for r in out.collect())
    assert got == sorted((str(rows[k][0]), n) for k, (n, _) in want.items())
    groups = Counter(c for _, c in want.values())
    bare = sum(not (t or "").strip() for _, t in rows)
    assert out.select("class_key").where("class_key IS NOT NULL").distinct().count() == len(groups) - bare
    kept = Counter((r.doc_id, r.text) for r in chosen_path.one_of_each(d, out).collect())
    assert sum(kept.values()) == len(groups) and kept[5, base[3]] == 1 and kept[None, ""] == 1 and kept[None, None] == 1
    assert sum(kept[x] for x in [(None, base[0]), (None, near(base[0], 1))]) == 1
    assert kept[1, base[1]] == 1 and kept[1, base[2]] == 1


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {(r.u, r.m) for r in chosen_path.components(edges).collect()}
    assert got == {(i, 1) for i in range(2, 41)} | {(101, 100)}


# ---------------------------------------------------------------- mix
def test_mix_query_equals_its_sql(spark):
    got = catalog.QUERIES["op10_mixing"](spark, SF001)
    con = duck(SF001).execute(catalog.ORACLE["op10_mixing"])
    names = [c[0] for c in con.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(con.fetchall())


def leaves(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, tokens long")


def test_shortages_go_to_siblings_before_ancestors(spark):
    levels = (Level("a", {"x": 1, "y": 1}), Level("b", {"big": 3}))
    rows = leaves(spark, [("x", "big", 10), ("x", "small", 500), ("y", "big", 500), ("y", "small", 500)])
    got = {(r.a, r.b): r.budget for r in mixing.allocate(rows, levels, (1, 5), 1).collect()}
    # 302 tokens: 151 each; x/big can give 10 only, its sibling takes the other 141 before y gets any
    assert got == {("x", "big"): 10, ("x", "small"): 141, ("y", "big"): 113, ("y", "small"): 37}
    rows = leaves(spark, [("x", "big", 10), ("x", "small", 20), ("y", "big", 500), ("y", "small", 500)])
    got = {(r.a, r.b): r.budget for r in mixing.allocate(rows, levels, (1, 2), 1).collect()}
    assert got == {("x", "big"): 10, ("x", "small"): 20, ("y", "big"): 363, ("y", "small"): 121}


def test_epochs_and_prefix(spark):
    rows = spark.createDataFrame([(i, "s", 10) for i in range(50)], "doc_id long, b string, tokens long")
    level = (Level("b"),)
    plan = mixing.plan(rows, level, (3, 2), 2, seed=1)
    out = Counter(r.doc_id for r in mixing.mix(rows, plan, level, seed=1).collect())
    assert Counter(out.values()) == {2: 25, 1: 25}
    second = sorted(range(50), key=lambda i: hashlib.md5(f"1:1:{i}".encode()).hexdigest())[:25]
    assert {i for i, n in out.items() if n == 2} == set(second)
    again = Counter(r.doc_id for r in mixing.mix(rows, mixing.plan(rows, level, (3, 2), 2, 1), level, seed=1).collect())
    assert out == again


def test_mix_edge_rows(spark):
    rows = spark.createDataFrame([(None, "s", 5), (1, "s", 0), (2, "empty", 0), (3, "s", 7), (3, "s", 7)],
                                 "doc_id long, b string, tokens long")
    level = (Level("b"),)
    plan = mixing.plan(rows, level, (1, 1), 1, seed=1)
    assert sorted((str(r.doc_id), r.epoch) for r in mixing.mix(rows, plan, level, 1).collect()) == [
        ("1", 0), ("3", 0), ("3", 0), ("None", 0)]
    none = rows.limit(0)
    assert mixing.mix(none, mixing.plan(none, level, (1, 1), 1, 1), level, 1).count() == 0
    raw = spark.createDataFrame([(1, None, None, None), (2, "a b", "en", "src7")],
                                "doc_id long, text string, lang string, source string")
    assert [tuple(r) for r in catalog.mix_rows(raw).orderBy("doc_id").collect()] == [
        (1, "unknown", "unknown", "unknown", 0), (2, "domain3", "en", "src7", 2)]


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages_against_plain_python(spark, tmp_path):
    """Each stage on its predecessor's rows: labels, brute-force join, regex masks, SQL mix, library tokens."""
    from tokenizers import Tokenizer

    from test_llm_text import plain_spans

    columns = read(spark, SF001, "documents").columns
    kept, tables = read(spark, SF001, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, SF001).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        tables.append(kept)
    assert all(t.columns == columns for t in tables[:4])
    start, good, single, clean, mixed, coded = (t.collect() for t in [read(spark, SF001, "documents"), *tables])
    marks = {r.doc_id: r.quality for r in read(spark, SF001, "labels").collect()}
    stay = {r.doc_id for r in good}
    judged = [(r.doc_id in stay, marks[r.doc_id]) for r in start if r.doc_id in marks]
    assert np.mean([a == bool(b) for a, b in judged]) > 0.97
    want = {i for i, (_, c) in brute_join([(r.doc_id, r.text) for r in good]).items() if i == c}
    assert sorted(r.doc_id for r in single) == sorted(want)
    for before, after in zip(sorted(single), sorted(clean)):
        text = before.text
        spans = sorted(((int(s), int(e), k) for k, s, e in (x.split(":") for x in plain_spans(text))), reverse=True)
        for s, e, k in spans:
            text = f"{text[:s]}[{k.upper()}]{text[e:]}"
        assert (after.doc_id, after.text, after.n_chars) == (before.doc_id, text, len(text))
    tables[2].coalesce(1).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    con = duck(SF001)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/in/documents.parquet/*.parquet'")
    sql = con.execute(f"SELECT doc_id FROM ({catalog.ORACLE['op10_mixing']})").fetchall()
    assert Counter(r.doc_id for r in mixed) == Counter(i for i, in sql)
    tok = Tokenizer.from_file(catalog.vocabulary("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in mixed}
    assert Counter(r.doc_id for r in coded) == Counter(r.doc_id for r in mixed)
    for r in coded:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pipeline_of_odd_and_empty_rows(spark, tmp_path):
    ddl = "doc_id long, text string, lang string, source string, n_chars long, _score string"
    rows = [(None, None, None, None, None, "clash"), (1, "", "en", "src1", 0, None), (1, "", "en", "src1", 0, None),
            (2, "mail a@b.cd now", None, "x", None, ""), (3, "mail a@b.cd now", "en", None, 15, "")]
    spark.createDataFrame([(1, 1), (3, 0), (None, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for given in (rows, []):
        kept = spark.createDataFrame(given, ddl)
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept.drop("_score"), str(tmp_path))
        assert kept.count() <= 2 * len(given)


def test_every_query_is_registered_once_per_operator():
    names = [q.split("_")[0] for q in catalog.QUERIES]
    assert sorted(names, key=lambda x: int(x[2:])) == [f"op{n}" for n in range(1, 14)]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "pii", "mixing", "bpe"]
