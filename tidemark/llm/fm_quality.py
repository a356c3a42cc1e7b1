"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Every document is a sparse vector: its lower-cased words hashed into buckets
(log counts, scaled to length 1), its rule statistics and length metadata as
numbers and as one-hot quantile bins.  All pairwise interactions enter through
rank-``k`` factors; the sum-of-squares identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``
scores a document in time linear in its words.

The fit runs in one task on a bounded sample of labelled rows (``SAMPLE_ROWS``,
the rows of smallest hash); every document is then scored where it lies, without
a shuffle.  Labels, language, source and ids are no inputs.

Cases: a null text is an empty one; a null ``n_chars`` is the text's own length;
several labels of one id count as their highest; without labels of both classes
every score is 0.5; repeated rows are scored each; extra columns pass through.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textstats as ts
from .tables import crc32_mod, hash_sample

BUCKETS = 1 << 14
RANK = 8
BINS = 8
SAMPLE_ROWS = 12_000
STEPS = 800  # mini-batches of the fit, however many rows there are
BATCH = 128
RATE = 0.05
SEED = 11


def _numbers(s: dict[str, np.ndarray], meta_chars: np.ndarray) -> np.ndarray:
    """Structure statistics and metadata, one row per document."""
    length = np.where(np.isnan(meta_chars), s["n_codepoints"], meta_chars)
    return np.column_stack([ts.ratios(s), np.log1p(s["n_words"]), np.log1p(length)])


NUMBERS = len(ts.RATIOS) + 2


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the hashed words, ordered by row."""
    w = ts.words(texts)
    bucket_of = np.fromiter((zlib.crc32(x.lower()) & (BUCKETS - 1) for x in w.distinct.cast(
        pa.large_binary()).to_pylist()), np.int64, len(w.distinct))
    key, n = np.unique(w.row * BUCKETS + bucket_of[w.code] if len(w.code) else np.zeros(0, np.int64),
                       return_counts=True)
    row, value = key // BUCKETS, np.log1p(n)
    norm = np.sqrt(np.bincount(row, weights=value ** 2, minlength=len(texts)))
    return row, key % BUCKETS, value / np.maximum(norm[row], 1e-12)


class Machine:
    """Weights, factors and the scaling of the numbers.  ``mean is None``: no model, every score is 0.5."""

    def __init__(self, mean=None, scale=None, edges=None, bias=0.0, w=None, v=None):
        self.mean, self.scale, self.edges, self.bias, self.w, self.v = mean, scale, edges, bias, w, v

    def design(self, words: tuple[np.ndarray, ...], numbers: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, feature, value) of all features: words, numbers, bins."""
        rows, n = len(numbers), NUMBERS
        z = np.clip((numbers - self.mean) / self.scale, -4, 4) / 4
        bins = np.column_stack([np.searchsorted(self.edges[:, j], numbers[:, j]) for j in range(n)])
        every = np.repeat(np.arange(rows), n)
        at = np.tile(np.arange(n), rows)
        row = np.concatenate([words[0], every, every])
        feature = np.concatenate([words[1], BUCKETS + at, BUCKETS + n + at * BINS + bins.ravel()])
        value = np.concatenate([words[2], z.ravel(), np.full(rows * n, 1 / np.sqrt(n))])
        return row, feature, value

    def margin(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        total = self.bias + np.bincount(row, weights=self.w[feature] * value, minlength=rows)
        for f in range(self.v.shape[1]):
            vx = self.v[feature, f] * value
            s = np.bincount(row, weights=vx, minlength=rows)
            total += 0.5 * (s * s - np.bincount(row, weights=vx * vx, minlength=rows))
        return total

    def score(self, texts: pa.Array, meta_chars: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(texts), 0.5)
        d = self.design(_hashed(texts), _numbers(ts.statistics(texts), meta_chars))
        return 1 / (1 + np.exp(-np.clip(self.margin(*d, len(texts)), -35, 35)))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, mean=self.mean, scale=self.scale, edges=self.edges, bias=self.bias,
                            w=self.w.astype(np.float32), v=self.v.astype(np.float32))
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> "Machine":
        z = np.load(io.BytesIO(raw))
        return Machine(z["mean"], z["scale"], z["edges"], float(z["bias"]), z["w"].astype(float), z["v"].astype(float))


def train(words: list[tuple[np.ndarray, np.ndarray]], numbers: np.ndarray, y: np.ndarray) -> Machine:
    """Logistic loss, AdaGrad over mini-batches; ``words`` holds (bucket, value) per document."""
    rng = np.random.default_rng(SEED)
    size = BUCKETS + NUMBERS * (1 + BINS)
    m = Machine(numbers.mean(0), np.maximum(numbers.std(0), 1e-9),
                np.quantile(numbers, np.arange(1, BINS) / BINS, axis=0), float(np.log(y.mean() / (1 - y.mean()))),
                np.zeros(size), rng.normal(0, 0.05, (size, RANK)))
    gw, gv, gb = np.full(size, 1e-8), np.full((size, RANK), 1e-8), 1e-8
    order = np.zeros(0, np.int64)
    for _ in range(STEPS):
        if len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(y))])
        part, order = order[:BATCH], order[BATCH:]
        lens = [len(words[i][0]) for i in part]
        w = (np.repeat(np.arange(len(part)), lens), np.concatenate([words[i][0] for i in part]),
             np.concatenate([words[i][1] for i in part]))
        row, feature, value = m.design(w, numbers[part])
        err = 1 / (1 + np.exp(-np.clip(m.margin(row, feature, value, len(part)), -35, 35))) - y[part]
        g = err[row] * value / len(part)
        step = np.bincount(feature, weights=g, minlength=size) + 1e-6 * m.w
        gw += step ** 2
        m.w -= RATE * step / np.sqrt(gw)
        for f in range(RANK):
            vx = m.v[feature, f] * value
            s = np.bincount(row, weights=vx, minlength=len(part))
            step = np.bincount(feature, weights=g * (s[row] - vx), minlength=size) + 1e-6 * m.v[:, f]
            gv[:, f] += step ** 2
            m.v[:, f] -= RATE * step / np.sqrt(gv[:, f])
        gb += err.mean() ** 2
        m.bias -= RATE * err.mean() / np.sqrt(gb)
    return m


def _meta(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        meta_col: str = "n_chars", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Machine from the ``sample_rows`` labelled rows of smallest hash; ``labelled`` holds only rows to learn from."""
    marks = (labelled.where(F.col(label_col).isNotNull()).groupBy(id_col)
             .agg((F.max(label_col) > 0).cast("double").alias("_y")))
    marks = hash_sample(marks, id_col, sample_rows, SEED).withColumn("_h", F.xxhash64(F.col(id_col), F.lit(SEED)))
    # The sample's size is bounded, so its ids may be broadcast and its vectors gathered in one task.
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("_t"), F.col(meta_col).cast("double").alias("_m"))
    sample = rows.join(F.broadcast(marks), id_col).select("_h", "_y", "_m", "_t")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.lean_batches(batches):
            for start, texts in ts.slices(batch.column(3)):
                row, bucket, value = _hashed(texts)
                cut = np.searchsorted(row, np.arange(1, len(texts)))
                numbers = _numbers(ts.statistics(texts), _meta(batch.column(2).slice(start, len(texts))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), batch.column(1).slice(start, len(texts)),
                     pa.array([x.astype(np.int16).tobytes() for x in np.split(bucket, cut)], pa.binary()),
                     pa.array([x.astype(np.float32).tobytes() for x in np.split(value, cut)], pa.binary()),
                     pa.array(list(numbers), pa.list_(pa.float64()))], names=["h", "y", "bucket", "value", "numbers"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for batch in ts.lean_batches(batches) for r in batch.to_pylist()]
        got.sort(key=lambda r: (r["h"], r["bucket"], r["value"]))  # the same model however the rows arrive
        y = np.array([r["y"] for r in got])
        if len(got) and 0 < y.mean() < 1:
            words = [(np.frombuffer(r["bucket"], np.int16).astype(np.int64),
                      np.frombuffer(r["value"], np.float32).astype(float)) for r in got]
            model = train(words, np.array([r["numbers"] for r in got]), y).dump()
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    model = (sample.mapInArrow(vectors, "h long, y double, bucket binary, value binary, numbers array<double>")
             .repartition(1).mapInArrow(learn, "model binary").collect())
    return Machine.load(bytes(model[0][0])) if model else Machine()


def with_scores(docs: DataFrame, model: Machine, out: str = "score", text_col: str = "text",
                meta_col: str = "n_chars", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and the score of each document."""
    keep = list(docs.columns if keep is None else keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.lean_batches(batches):
            for start, texts in ts.slices(batch.column(0)):
                part = batch.slice(start, len(texts))
                score = model.score(texts, _meta(part.column(1)))
                yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(score)], names=[*keep, out])

    schema = docs.select(*keep).withColumn(out, F.lit(0.0)).schema
    return docs.select(F.col(text_col).cast("string").alias("_text"), F.col(meta_col).cast("double").alias("_meta"),
                       *keep).mapInArrow(run, schema)


def training_rows(labels: DataFrame, id_col: str = "doc_id", folds: int = 5) -> DataFrame:
    """Label rows outside the held-out fold."""
    return labels.where(crc32_mod(id_col, folds) != 0)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(crc32_mod(id_col, folds) == 0, F.lit(False))
