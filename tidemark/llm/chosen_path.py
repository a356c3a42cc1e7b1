"""Jaccard join of word n-gram sets by chosen paths.

Every document is its set of ``n``-word shingles, embedded as ``TOKENS`` min-hash
tokens.  A run splits all sets recursively: at a node, each token is sampled
with probability 1 / (similarity * TOKENS), and a set goes to the children of the
sampled tokens it holds.  Sets that share a node of at most ``BUCKET`` sets are
compared there; larger nodes split on.  A pair at the least similarity stays
together along at least one path of a run with a probability that falls with
the number of splits, so the number of runs follows from the target recall: all
sets take the runs for ``SPLITS`` splits, and sets of nodes that split on after
that take further ones, for the deepest level, among themselves.

* Documents with equal sets are one class before anything else, so copies never
  meet in a node.
* A pair is checked in one node only, the first that both sets share (each row
  carries its nodes), so links are counted without listing pairs.
* Nodes first compare tokens; only sets with a likely partner travel to a node
  in full, where the exact similarity decides.
* A node that is still too large after ``LEVELS`` splits (sets alike in almost all
  tokens) is compared exactly in blocks of rows.

Result: one row per document with its class (smallest id among the documents
linked to it directly or in steps), its copy (smallest id with an equal set) and
its number of links (other documents of similarity >= the threshold, copies
included).

Inside the join a set is known by a number of its own, never by an id.  Its text is
fetched by the id and the key of one text that has the set.

Cases: a text of fewer than ``n`` words is one shingle; texts without words
(null, empty) link to nothing and form their own class; every row stands for its
own text, so rows without an id link as others do and an id on two texts is two
documents; repeated rows are copies of each other; ids of a class without any id
are null (``class_key`` still tells classes apart); extra columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textstats as ts
from .tables import keep, text_key

TOKENS = 64
BUCKET = 4096
LEVELS = 6
SPLITS = 3
RECALL = 0.999
LIKELY = 0.25  # tokens may agree this much less than the threshold (5 standard deviations) for a pair to be checked
SEED = 29


def _parted(splits: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(weight, probability) that a run parts a pair at the threshold within ``splits`` splits, by its equal tokens."""
    equal = np.arange(TOKENS + 1)
    weight = np.array([math.comb(TOKENS, int(k)) * similarity ** k * (1 - similarity) ** (TOKENS - k) for k in equal])
    p = np.ones(TOKENS + 1)
    for _ in range(splits):
        p = 1 - np.exp(-equal / (similarity * TOKENS) * p)
    return weight, 1 - p


def runs_for(recall: float, levels: int = SPLITS, similarity: float = 0.8) -> int:
    """Runs until a pair at the threshold has met with probability ``recall``, when nodes split ``levels`` times."""
    weight, parted = _parted(levels, similarity)
    return next(r for r in itertools.count(1) if weight @ parted ** r <= 1 - recall)


def lost(runs: int, more: int, deepest: int, similarity: float = 0.8) -> float:
    """Probability that a pair at the threshold is lost, whose common nodes may split ``deepest`` times.

    Either no run keeps it together for ``SPLITS`` splits, or it shares a node that splits on, and is then parted in
    all runs and all ``more`` ones that the sets of such nodes take.
    """
    weight, early = _parted(SPLITS, similarity)
    late = _parted(max(deepest, SPLITS), similarity)[1]
    return float(weight @ (early ** runs + (late ** runs - early ** runs) * late ** more))


def plan_runs(recall: float, deepest: int, similarity: float = 0.8) -> tuple[int, int]:
    """Runs of all sets and further runs of the sets in deep nodes; one run above the least leaves room for these."""
    first = runs_for(recall, SPLITS, similarity) + 1
    return first, next(m for m in itertools.count() if lost(first, m, deepest, similarity) <= 1 - recall)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(w: ts.Words, rows: int, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each document of a slice."""
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(x, SEED) for x in w.distinct.cast(pa.large_binary()).to_pylist()),
                         np.uint64, len(w.distinct))
    h = hashed[w.code] if len(w.code) else np.zeros(0, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    grams = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for k in range(n):
        grams = grams * base + h[k: k + len(grams)]
    grams = _mix(grams)
    ends = np.cumsum(w.per_row)
    out = []
    for i in range(rows):
        a, b = ends[i] - w.per_row[i], ends[i]
        if b - a >= n:
            out.append(np.unique(grams[a: b - n + 1]))
        elif b > a:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = one * base + x
            out.append(_mix(np.array([one])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _multipliers() -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, TOKENS, dtype=np.uint64) | np.uint64(1)


def embed(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """Id, text key, 128-bit set id (null: no words) and min-hash tokens per document."""
    a = _multipliers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in ts.lean_batches(batches):
                for start, texts in ts.slices(batch.column(1)):
                    sets = shingles(ts.words(texts), len(texts), n)
                    s1 = [int(np.sum(s, dtype=np.uint64).view(np.int64)) if len(s) else None for s in sets]
                    s2 = [int(np.bitwise_xor.reduce(_mix(s + np.uint64(1))).view(np.int64)) if len(s) else None
                          for s in sets]
                    tokens = [((s[:, None] * a).min(0) >> np.uint64(32)).astype(np.uint32).tobytes() if len(s) else
                              None for s in sets]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(k).slice(start, len(texts)) for k in (0, 2, 3)]
                        + [pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(tokens, pa.binary())],
                        names=["id", "h1", "h2", "s1", "s2", "tokens"])

    return docs.select(id_col, F.col(text_col).cast("string"), *text_key(F.col(text_col))).mapInArrow(
        run, f"id {dict(docs.dtypes)[id_col]}, h1 long, h2 long, s1 long, s2 long, tokens binary")


def _matrix(column: pa.Array, width: int = TOKENS) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), width)


def _sampled(node: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, token number) of the tokens that each row's node samples; rows of one node sample the same."""
    with np.errstate(over="ignore"):
        draw = _mix(node[:, None] + np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return np.nonzero(draw < np.uint64(int(2.0 ** 64 / (similarity * TOKENS))))


def _split(rows: DataFrame, similarity: float, runs: range) -> DataFrame:
    """(node, rep) of the children: of every run's root if ``rows`` has no ``node``, else of each row's node."""
    roots = _mix(np.arange(runs.start + 1, runs.stop + 1, dtype=np.uint64) * np.uint64(1_000_003 + SEED))
    at_root = "node" not in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.lean_batches(batches):
            if not batch.num_rows:
                continue
            rep, m = batch.column(0), _matrix(batch.column(1))
            if at_root:
                r, j = _sampled(roots, similarity)
                row, node = np.repeat(np.arange(len(m)), len(r)), np.tile(roots[r], len(m))
                j = np.tile(j, len(m))
            else:
                own = batch.column(2).to_numpy().view(np.uint64)
                row, j = _sampled(own, similarity)
                node = own[row]
            with np.errstate(over="ignore"):
                child = _mix(_mix(node ^ (j.astype(np.uint64) + np.uint64(7)) * np.uint64(0xA24BAED4963EE407))
                             + m[row, j].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), rep.take(pa.array(row))],
                                             names=["node", "rep"])

    cols = ["rep", "tokens"] + ([] if at_root else ["node"])
    return rows.select(*cols).mapInArrow(run, f"node long, rep long")


def _nodes(reps: DataFrame, similarity: float, recall: float) -> DataFrame:
    """(node, rep, side) of all nodes to compare: at most BUCKET rows each; side 1 and 2 meet, side 0 meets all."""
    first, more = plan_runs(recall, LEVELS + 1, similarity)
    done, deep = _descend(reps, similarity, range(first))
    if deep is None:
        return done
    deep = keep(deep.distinct(), "deep")
    again = range(first, first + more)
    return done.unionByName(_descend(reps.join(deep, "rep"), similarity, again)[0])


def _descend(reps: DataFrame, similarity: float, runs: range) -> tuple[DataFrame, DataFrame | None]:
    """The nodes to compare of these runs, and (rep) of the sets in nodes that are too large after ``SPLITS`` splits."""
    frontier = _split(reps, similarity, runs)
    done = deep = None
    for level in range(LEVELS + 1):
        sizes = frontier.groupBy("node").count().where("count > 1")
        sized = keep(frontier.join(sizes, "node"), f"nodes_{level}")
        small = sized.where(F.col("count") <= BUCKET).select("node", "rep", F.lit(0).alias("side"))
        large = sized.where(F.col("count") > BUCKET)
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            return done, deep
        if level < LEVELS:
            if level == SPLITS - 1:
                deep = large.select("rep")
            frontier = _split(large.select("node", "rep").join(reps.select("rep", "tokens"), "rep"), similarity,
                              range(0))
    # Blocks of a node that no token splits: every pair of blocks is a node of its own.
    blocks = large.withColumn("_of", F.expr(f"cast(ceil(2 * count / {BUCKET}) as int)")).withColumn(
        "_b", F.expr("cast(pmod(xxhash64(rep, 1), _of) as int)"))
    pairs = blocks.withColumn("_o", F.explode(F.expr("sequence(0, _of - 1)"))).select(
        F.xxhash64("node", F.least("_b", "_o"), F.greatest("_b", "_o")).alias("node"), "rep",
        F.when(F.col("_b") == F.col("_o"), 0).when(F.col("_b") < F.col("_o"), 1).otherwise(2).alias("side"))
    return done.unionByName(pairs), deep


def _may_meet(side: np.ndarray) -> np.ndarray:
    """Pairs that a node compares: side 0 meets all, other sides only meet each other."""
    return (side[:, None] == 0) | (side[:, None] != side[None, :])


def _first_here(node: int, nodes: list[np.ndarray], sides: list[np.ndarray], side: np.ndarray) -> np.ndarray:
    """Boolean matrix: the pair (i < j) is to be compared in this node, as no earlier one compares it.

    ``nodes`` and ``sides`` list all nodes of each row, ``side`` the rows' sides here.
    """
    m = len(nodes)
    todo = np.triu(np.ones((m, m), bool), 1) & _may_meet(side)
    who = np.repeat(np.arange(m), [len(x) for x in nodes])
    all_nodes, all_sides = np.concatenate(nodes), np.concatenate(sides)
    early = np.flatnonzero(all_nodes < node)
    early = early[np.argsort(all_nodes[early], kind="stable")]
    cut = np.flatnonzero(np.diff(all_nodes[early])) + 1
    for g in np.split(early, cut):
        if len(g) > 1:
            todo[np.ix_(who[g], who[g])] &= ~_may_meet(all_sides[g])
    return todo


def _likely(rows: DataFrame, similarity: float) -> DataFrame:
    """(node, rep) of the rows that have a likely partner whose first common node this is."""
    need = (similarity - LIKELY) * TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.lean_batches(batches):
            members = batch.column(1)
            at = members.offsets.to_numpy()
            flat = members.flatten()
            if not len(flat):
                continue
            ids, side, tokens, lists = (flat.field(k) for k in ("rep", "side", "tokens", "nodes"))
            m, here = _matrix(tokens), side.to_numpy()
            list_at = lists.offsets.to_numpy()
            list_node, list_side = (lists.values.field(k).to_numpy() for k in ("node", "side"))
            nodes = batch.column(0).to_numpy()
            at = at - at[0]
            take, of = [], []
            for k in range(len(nodes)):
                a, b = int(at[k]), int(at[k + 1])
                alike = np.zeros((b - a, b - a), bool)
                for i in range(a, b - 1):
                    alike[i - a, i - a + 1:] = (m[i + 1: b] == m[i]).sum(1) >= need
                if alike.any():
                    spans = [slice(list_at[i], list_at[i + 1]) for i in range(a, b)]
                    todo = alike & _first_here(nodes[k], [list_node[x] for x in spans], [list_side[x] for x in spans],
                                               here[a:b])
                    hit = np.flatnonzero(todo.any(0) | todo.any(1)) + a
                    take.append(hit)
                    of.append(np.full(len(hit), nodes[k]))
            if take:
                hit = np.concatenate(take)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(of)), ids.take(pa.array(hit))],
                                                 names=["node", "rep"])

    grouped = rows.groupBy("node").agg(F.collect_list(F.struct("rep", "side", "tokens", "nodes")).alias("m"))
    return grouped.mapInArrow(run, f"node long, rep long")


def _spread_sets(rows: DataFrame, n: int) -> DataFrame:
    """Rows (rep, text, copies, nodes, at) -> one row with the shingle set for each node of ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in ts.lean_batches(batches):
                for start, texts in ts.slices(batch.column(1)):
                    part = batch.slice(start, len(texts))
                    sets = pa.array([s.tobytes() for s in shingles(ts.words(texts), len(texts), n)], pa.binary())
                    times = part.column(4).value_lengths().to_numpy()
                    row = pa.array(np.repeat(np.arange(len(texts)), times))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(4).flatten(), part.column(0).take(row), part.column(2).take(row),
                         part.column(3).take(row), sets.take(row)], names=["node", "rep", "copies", "nodes", "grams"])

    return rows.select("rep", "text", "copies", "nodes", "at").mapInArrow(
        run, f"node long, rep long, copies long, nodes array<struct<node:long,side:int>>, grams binary")


def _verify(rows: DataFrame, similarity: float) -> DataFrame:
    """(rep, links, root): links found in each node, and the smallest rep that they tie this one to there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.lean_batches(batches):
            reps, links, roots = [], [], []
            for node, members in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = members.as_py()
                got.sort(key=lambda r: r["rep"])
                lists = [np.array([x["node"] for x in r["nodes"]], np.int64) for r in got]
                sides = [np.array([x["side"] for x in r["nodes"]], np.int32) for r in got]
                todo = _first_here(node, lists, sides, np.array([s[x == node][0] for x, s in zip(lists, sides)]))
                sets = [np.frombuffer(r["grams"], np.uint64) for r in got]
                copies = np.array([r["copies"] for r in got])
                found = np.zeros(len(got), np.int64)
                root = np.arange(len(got))
                for i, j in _linked(sets, todo, similarity):
                    found[i] += copies[j].sum()
                    found[j] += copies[i]
                    merged = np.unique(np.concatenate((root[j], root[[i]])))
                    root[np.isin(root, merged)] = merged[0]
                for k in np.flatnonzero(found):
                    reps.append(got[k]["rep"])
                    links.append(int(found[k]))
                    roots.append(got[root[k]]["rep"])
            kind = batch.schema.field(1).type.value_type.field("rep").type
            yield pa.RecordBatch.from_arrays([pa.array(reps, kind), pa.array(links, pa.int64()), pa.array(roots, kind)],
                                             names=["rep", "links", "root"])

    grouped = rows.groupBy("node").agg(F.collect_list(F.struct("rep", "copies", "nodes", "grams")).alias("m"))
    return grouped.mapInArrow(run, f"rep long, links long, root long")


def _linked(sets: list[np.ndarray], todo: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each set i, the later sets j of ``todo`` with |i & j| / |i | j| >= similarity."""
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(flat.max() + 1, np.int64)
    for i in range(len(sets)):
        j = np.flatnonzero(todo[i])
        j = j[np.minimum(sizes[j], sizes[i]) >= similarity * np.maximum(sizes[j], sizes[i]) - 1e-9]
        if not len(j):
            continue
        own = flat[ends[i] - sizes[i]: ends[i]]
        marked[own] = 1
        common = np.array([marked[flat[ends[x] - sizes[x]: ends[x]]].sum() for x in j])
        marked[own] = 0
        ok = common >= similarity * (sizes[j] + sizes[i] - common) - 1e-9
        if ok.any():
            yield i, j[ok]


def components(edges: DataFrame) -> DataFrame:
    """(v, m) with m the smallest member of v's component, for every vertex v other than m, from edges (u, v).

    Alternates two star contractions until nothing changes; each round is written
    to the shared folder, and only row counts and sums reach the driver.
    """
    edges = keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(),
                 "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where(
            "u != v").distinct()
        edges = keep(small, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select("u", F.col("v").alias("m"))
        mark = now


def _same_row(id_col: str, of_id: str) -> Column:
    """Rows of one id and one text; null ids are equal, and the id spreads a text that many rows share."""
    return F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col("h1") == F.col("of_h1")) & (F.col("h2") == F.col("of_h2"))


def jaccard_join(docs: DataFrame, similarity: float = 0.8, n: int = 5, recall: float = RECALL,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``class_id``, ``copy_id`` and ``n_links`` for every row of ``docs``.

    For :func:`one_of_each` also the text key ``h1``, ``h2``, ``class_key`` (a number per class; null: a text without
    words) and ``leads`` (the row's id and text are those that stand for the class).
    """
    rows = keep(embed(docs, n, id_col, text_col), "tokens")
    least = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "h1", "h2"))
    sets = rows.where("s1 IS NOT NULL").groupBy("s1", "s2").agg(
        least.alias("least"), F.count(F.lit(1)).alias("copies"), F.first("tokens").alias("tokens"))
    reps = keep(sets.withColumn("rep", F.monotonically_increasing_id()), "reps")  # written: the numbers stay
    nodes = keep(_nodes(reps, similarity, recall), "compare")
    lists = nodes.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("node", "side"))).alias("nodes"))
    known = keep(lists.join(reps.select("rep", "copies", "tokens"), "rep"), "listed")
    placed = known.select("rep", "tokens", "nodes", F.explode("nodes").alias("x")).select(
        "x.node", "x.side", "rep", "tokens", "nodes")
    likely = keep(_likely(placed, similarity).groupBy("rep").agg(F.collect_list("node").alias("at")), "likely")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"), *text_key(F.col(text_col)))
    wanted = (likely.join(known.select("rep", "copies", "nodes"), "rep").join(reps.select("rep", "least"), "rep")
              .select("rep", "copies", "nodes", "at", *[F.col(f"least.{c}").alias(f"of_{c}") for c in ("id", "h1", "h2")]))
    full = _spread_sets(texts.join(wanted, _same_row("_id", "of_id")).dropDuplicates(["rep"]), n)
    found = keep(_verify(full, similarity), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v"))).select(F.col("u").alias("rep"), "m")
    of_class = reps.select("rep", "least").join(roots, "rep", "left").select(
        "rep", "least", F.coalesce("m", "rep").alias("class_key"))
    first = of_class.groupBy("class_key").agg(F.min("least").alias("first"))
    classes = (reps.select("s1", "s2", "rep", "copies").join(of_class, "rep").join(links, "rep", "left")
               .join(first, "class_key").select("s1", "s2", "class_key", F.col("first.id").alias("class_id"), F.col("least.id").alias("copy_id"),
                       F.col("first.h1").alias("_h1"), F.col("first.h2").alias("_h2"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = rows.select("id", "h1", "h2", "s1", "s2").join(classes, ["s1", "s2"], "left")
    bare = F.col("class_key").isNull()
    leads = bare | (F.col("id").eqNullSafe(F.col("class_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
    return named.select(
        F.col("id").alias(id_col), F.when(bare, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(bare, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "h1", "h2", "class_key", leads.alias("leads"))


def one_of_each(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document that stands for each class (``jaccard_join``'s result): the one of smallest id, once.

    Rows without an id come last; texts without words are classes of their own and all stay.
    """
    lead = classes.where("leads").groupBy(F.col(id_col).alias("of_id"), F.col("h1").alias("of_h1"), F.col("h2").alias("of_h2")).agg(
        F.count("class_key").alias("_n"))  # 0: a text without words
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("_id"), *text_key(F.col(text_col)))
    kept = whole.join(lead, _same_row("_id", "of_id"))
    if not lead.where("_n > 1").isEmpty():  # repeated rows
        kept = kept.where("_n <= 1").unionByName(kept.where("_n > 1").dropDuplicates(["h1", "h2", "_id"]))
    return kept.select("doc.*")
