"""Language-model scores by deleted interpolation of n-gram estimates (bigram, unigram, uniform).

The probability of a token is ``l2 * c(h w) / c(h) + l1 * c(w) / N + l0 / (V + 1)``
with weights that depend on the frequency bucket of the context ``h``.  The
weights are learned by expectation-maximisation on held-out counts: a share of the
training documents is deleted from the counts and predicted by the rest.

Counting and lookup share one shuffle.  A *block* is a bounded run of documents;
each scan task sends, per block and hash range, the block's sorted distinct n-gram
hashes with their counts.  The reducer of a range adds the training blocks up and
answers every block with the totals in the order of its question, so an
answer is a plain array of counts.  Scoring brings a block's documents together
with its answers; texts are shuffled once.  N-grams are 64-bit hashes.

Cases: a null or empty text is its end token alone; repeated rows count each; an
empty training set leaves the uniform estimate; extra columns are not read.
Blocks are runs of ``BLOCK_IDS`` ids; rows without an id are dealt to blocks by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textstats as ts
from .tables import keep, partitions

BLOCK_IDS = 2048
HELD_SHARE = 20  # one in so many training documents is held out for the weights
EM_ROUNDS = 60
# Roles of documents, and with them of blocks.
UNSEEN, TRAIN, HELD = 0, 1, 2

_END, _BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _unigram(h: np.ndarray) -> np.ndarray:
    return _mix(h) | np.uint64(1)  # odd keys are single tokens, even ones pairs


_BEGIN_KEY = _unigram(np.array([_BEGIN]))[0]


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words, then the end, of each text) and the number of tokens per text."""
    out, lens = [], []
    for _, part in ts.slices(texts):
        w = ts.words(pc.ascii_lower(part))
        hashed = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in w.distinct.cast(pa.large_binary()).to_pylist()),
                             np.uint64, len(w.distinct))
        got = np.full(len(w.code) + len(part), _END, np.uint64)
        if len(w.code):
            got[np.arange(len(w.code)) + w.row] = hashed[w.code]
        out.append(got)
        lens.append(w.per_row + 1)
    return np.concatenate(out or [np.zeros(0, np.uint64)]), np.concatenate(lens or [np.zeros(0, np.int64)])


def _keys(tokens: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unigram key, pair key, index of the context's unigram or -1 at a text's start) of every token."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    starts = np.cumsum(lens) - lens
    before[starts] = _BEGIN
    context = np.arange(len(tokens)) - 1
    context[starts] = -1
    pair = _mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens) & ~np.uint64(1)
    return _unigram(tokens), pair, context


def _pack(x: np.ndarray) -> bytes:
    """Byte planes of an integer array: equal high bytes stand together and compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, len(raw) // size).T).view(kind).ravel()


def _pack_sorted(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=np.uint64(0)))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


def _pack_counts(x: np.ndarray) -> bytes:
    """Counts in four bytes each, or in eight where one of them needs it."""
    kind = np.uint32 if not len(x) or x.max() < 1 << 32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + _pack(x.astype(kind))


def _unpack_counts(raw: bytes) -> np.ndarray:
    return _unpack(raw[1:], {4: np.uint32, 8: np.uint64}[raw[0]]).astype(np.int64)


def _block_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of a set of documents with their counts; the start counts once a document."""
    tokens, lens = _tokens(texts)
    uni, pair, _ = _keys(tokens, lens)
    keys, n = np.unique(np.concatenate([uni, pair]), return_counts=True)
    at = int(np.searchsorted(keys, _BEGIN_KEY))
    return np.insert(keys, at, _BEGIN_KEY), np.insert(n, at, len(lens))


def _questions(rows: DataFrame, bits: int) -> DataFrame:
    """(bucket, block, keys, counts): the n-grams of each block by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in ts.lean_batches(batches):
                blocks = batch.column(0).to_numpy()
                for block in np.unique(blocks):
                    keys, n = _block_grams(batch.column(1).take(pa.array(np.flatnonzero(blocks == block))))
                    bucket = (keys >> np.uint64(64 - bits)).astype(np.int32)
                    cut = np.flatnonzero(np.diff(bucket)) + 1
                    first = bucket[np.concatenate(([0], cut))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(first, pa.int32()), pa.array(np.full(len(first), block), pa.int64()),
                         pa.array([_pack_sorted(x) for x in np.split(keys, cut)], pa.binary()),
                         pa.array([_pack_counts(x) for x in np.split(n, cut)], pa.binary())],
                        names=["bucket", "block", "keys", "counts"])

    return rows.select("block", "text").mapInArrow(run, "bucket int, block long, keys binary, counts binary")


def _answers(questions: DataFrame) -> DataFrame:
    """(block, bucket, total, held, types): training counts in the order of each block's distinct keys."""

    def run(group: pa.Table) -> pa.Table:
        blocks = group.column("block").to_numpy()
        keys = [_unpack_sorted(x) for x in group.column("keys").to_pylist()]
        counts = [_unpack_counts(x) for x in group.column("counts").to_pylist()]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        flat = np.concatenate(counts)
        role = np.repeat(blocks % 3, [len(x) for x in keys])
        total, held = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        np.add.at(total, place, flat * (role != UNSEEN))
        np.add.at(held, place, flat * (role == HELD))
        types = int(((total > 0) & (distinct % np.uint64(2) == 1) & (distinct != _BEGIN_KEY)).sum())
        at = np.split(place, np.cumsum([len(x) for x in keys])[:-1])
        out = []
        for k, block in enumerate(np.unique(blocks)):
            asked = np.unique(np.concatenate([at[i] for i in np.flatnonzero(blocks == block)]))
            out.append((block, _pack_counts(total[asked]), _pack_counts(held[asked]) if block % 3 == HELD else None,
                        0 if k else types))
        block, t, h, n = zip(*out)
        bucket = group.column("bucket")[0].as_py()
        return pa.table([pa.array(block, pa.int64()), pa.array([bucket] * len(out), pa.int32()), pa.array(t, pa.binary()),
                         pa.array(h, pa.binary()), pa.array(n, pa.int64())],
                        names=["block", "bucket", "total", "held", "types"])

    return questions.groupBy("bucket").applyInArrow(
        run, "block long, bucket int, total binary, held binary, types long")


class _Counts:
    """Counts of a block's tokens from its answers: c(w), c(h w) and c(h) per token."""

    def __init__(self, texts: pa.Array, answers: pa.Table):
        tokens, self.lens = _tokens(texts)
        uni, pair, self.context = _keys(tokens, self.lens)
        keys, place = np.unique(np.concatenate([uni, pair, [_BEGIN_KEY]]), return_inverse=True)
        self.uni, self.pair, self.begin = place[: len(uni)], place[len(uni): -1], place[-1]
        order = np.argsort(answers.column("bucket").to_numpy())
        self.total = self._joined(answers.column("total"), order)
        self.held = self._joined(answers.column("held"), order)
        if len(self.total) != len(keys):
            raise ValueError(f"{len(self.total)} answers to {len(keys)} n-grams: the blocks of both passes differ")

    @staticmethod
    def _joined(column: pa.ChunkedArray, order: np.ndarray) -> np.ndarray:
        raw = column.to_pylist()
        return np.concatenate([np.zeros(0, np.int64), *(_unpack_counts(raw[i]) for i in order if raw[i] is not None)])

    def of_tokens(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w = counts[self.uni]
        return w, counts[self.pair], np.where(self.context < 0, counts[self.begin], w[self.context])


def context_bucket(c: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + floor(log2(count))."""
    return np.where(c > 0, 1 + np.log2(np.maximum(c, 1)).astype(np.int64), 0)


def _estimates(w: np.ndarray, pair: np.ndarray, context: np.ndarray, n: int, v: int) -> tuple[np.ndarray, ...]:
    """Bigram, unigram and uniform estimates."""
    return (pair / np.maximum(context, 1), w / max(n, 1), np.full(len(w), 1 / (v + 1)))


def learn_weights(cells: list[tuple], v: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (l2, l1, l0) per context bucket by EM.

    A cell is (bucket, tokens, mean bigram estimate, mean unigram estimate).  Each bucket starts from, and is
    tied by a few tokens to, the weights of all buckets together.
    """
    out = np.tile([0.3, 0.5, 0.2], (66, 1))
    if not cells:
        return out
    x = np.array(cells, dtype=np.float64)
    p = np.column_stack([x[:, 2], x[:, 3], np.full(len(x), 1 / (v + 1))])

    def em(rows: np.ndarray, start: np.ndarray, tied: float) -> np.ndarray:
        lam = start.copy()
        for _ in range(rounds):
            share = p[rows] * lam
            share = x[rows, 1][:, None] * share / share.sum(1, keepdims=True)
            lam = share.sum(0) + tied * start
            lam = np.maximum(lam / lam.sum(), 1e-6)
            lam /= lam.sum()
        return lam

    every = em(np.arange(len(x)), out[0], 0.0)
    out[:] = every
    for b in np.unique(x[:, 0]).astype(int):
        out[b] = em(np.flatnonzero(x[:, 0] == b), every, 20.0)
    return out


def _cells(rows: DataFrame, answers: DataFrame, n: int, v: int) -> DataFrame:
    """Held-out tokens by context bucket and half octaves of both estimates, predicted without the held-out counts."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            c = _Counts(docs.column("text").combine_chunks(), found)
        w, pair, context = c.of_tokens(c.total - c.held)
        p2, p1, _ = _estimates(w, pair, context, n, v)
        log = lambda p: np.where(p > 0, np.floor(-2 * np.log2(np.maximum(p, 2.0 ** -60))), 127).astype(np.int64)
        cell = (context_bucket(context) * 128 + log(p2)) * 128 + log(p1)
        cells, place = np.unique(cell, return_inverse=True)
        total = lambda x: pa.array(np.bincount(place, weights=x, minlength=len(cells)))
        return pa.table([pa.array(cells), total(np.ones(len(cell))), total(p2), total(p1)],
                        names=["cell", "n", "p2", "p1"])

    found = _cogrouped(rows, answers).applyInArrow(run, "cell long, n double, p2 double, p1 double")
    return found.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1"))


def _cogrouped(rows: DataFrame, answers: DataFrame):
    return rows.groupBy("block").cogroup(answers.groupBy("block"))


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          block_ids: int = BLOCK_IDS) -> DataFrame:
    """Base and model score of every document; documents where ``held_out`` holds are not learned from."""
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)[id_col]
    unseen = F.coalesce(held_out, F.lit(False))
    role = F.when(unseen, UNSEEN).when(F.pmod(F.xxhash64(F.col(id_col)), F.lit(HELD_SHARE)) == 0, HELD).otherwise(TRAIN)
    number = F.col(id_col) if id_type in ("tinyint", "smallint", "int", "bigint") else \
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 40))
    number = F.coalesce(number.cast("long"), F.pmod(F.xxhash64(F.col(text_col).cast("string")), F.lit(1 << 26)))
    # 3 * run of ids + role, so that the role is the block modulo 3 (runs are made non-negative).
    run_of = F.pmod(F.floor(number / F.lit(block_ids)), F.lit(1 << 50))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), unseen.alias("unseen"),
                       (run_of * 3 + role).cast("long").alias("block"))
    bits = max(3, (2 * partitions(spark) - 1).bit_length())
    answers = keep(_answers(_questions(rows, bits)), "ngram_counts")
    n, n_held, v = _totals(answers, rows)
    held = _cells(rows.where(F.col("block") % 3 == HELD), answers.where(F.col("block") % 3 == HELD), n - n_held, v)
    cells = [(r["cell"] >> 14, r["n"], r["p2"] / r["n"], r["p1"] / r["n"]) for r in held.collect()]
    return _scored(rows, answers, n, v, learn_weights(cells, v), id_col, id_type)


def _totals(answers: DataFrame, rows: DataFrame) -> tuple[int, int, int]:
    """Training tokens, those of them in held-out rows, and distinct training tokens."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1
    held = F.sum(F.when(F.col("block") % 3 == HELD, words))
    n, n_held = rows.where(F.col("block") % 3 != UNSEEN).agg(F.sum(words), held).first()
    return n or 0, n_held or 0, answers.agg(F.sum("types")).first()[0] or 0


def _scored(rows: DataFrame, answers: DataFrame, n: int, v: int, weights: np.ndarray, id_col: str,
            id_type: str) -> DataFrame:
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            c = _Counts(docs.column("text").combine_chunks(), found)
        w, pair, context = c.of_tokens(c.total)
        lam = weights[context_bucket(context)]
        p2, p1, p0 = _estimates(w, pair, context, n, v)
        doc = np.repeat(np.arange(len(c.lens)), c.lens)
        per_doc = lambda x: np.bincount(doc, weights=x, minlength=len(c.lens))
        return pa.table([
            docs.column("id"), docs.column("unseen"), pa.array(c.lens.astype(np.int64)),
            pa.array(per_doc(w > 0).astype(np.int64)), pa.array(np.full(len(c.lens), n), pa.int64()),
            pa.array(per_doc(np.log10((w + 0.5) / (n + 0.5 * (v + 1))))),
            pa.array(per_doc(np.log10(lam[:, 0] * p2 + lam[:, 1] * p1 + lam[:, 2] * p0)))],
            names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _cogrouped(rows, answers).applyInArrow(
        run, f"{id_col} {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
