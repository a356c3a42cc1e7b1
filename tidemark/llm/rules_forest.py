"""Quality rules with an isolation forest over rule statistics.

Each document is reduced to a few length-free rule statistics (symbol, repeat,
capital and punctuation shares, ...).  Random trees over a bounded sample of
labelled rows split a random statistic at a random point; documents that land
on short paths are anomalous.  The threshold on the path-length score is
calibrated on *all* labelled rows that pass the base rule: the score edge with
the best sum of bad rows above it and good rows below it, as shares.  The statistics table (a few dozen
bytes a document) is written once; the forest is a few hundred KB.

Cases: a null text is an empty one (all counts 0, base rule fails); repeated
rows are scored each; without labelled rows of both classes the forest has no
threshold and only the base rule decides; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textstats as ts
from .tables import hash_sample, keep

TREES = 100
TREE_ROWS = 1024  # rows drawn for each tree
SAMPLE_ROWS = 25_600  # bound of the labelled rows gathered for the fit
DEPTH = 4  # splits on a path: enough to cut off junk, too few to cut off the tails of ordinary documents
BINS = 1000  # score bins of the calibration histogram
# The statistics that the base rule does not cover already.
SPLIT_ON = ("word_length", "symbols", "upper", "shout")
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the integer counts of ``textstats.COUNTS`` and a ``features`` array per document."""

    columns = [ts.RATIOS.index(c) for c in SPLIT_ON]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.lean_batches(batches):
            for start, texts in ts.slices(batch.column(1)):
                s = ts.statistics(texts)
                feats = ts.ratios(s)[:, columns]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), *[pa.array(s[c], pa.int64()) for c in ts.COUNTS],
                     pa.FixedSizeListArray.from_arrays(pa.array(feats.ravel()), feats.shape[1]).cast(
                         pa.list_(pa.float64()))],
                    names=[id_col, *ts.COUNTS, "features"])

    schema = f"{id_col} {dict(docs.dtypes)[id_col]}, " + ", ".join(f"{c} long" for c in ts.COUNTS)
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema + ", features array<double>")


class Forest:
    """Isolation trees as flat arrays: node i splits ``feature[i] < at[i]`` to its left child, else the right."""

    def __init__(self, sample: np.ndarray, trees: int, size: int, depth: int, seed: int):
        rng = np.random.default_rng(seed)
        size = min(size, len(sample))
        self.limit = depth
        self.scale = _average_path(size)
        self.trees = [self._grow(sample[rng.permutation(len(sample))[:size]], rng) for _ in range(trees)]

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, at, left, right, depth = [], [], [], [], []

        def node(part: np.ndarray, level: int) -> int:
            i = len(feature)
            for col, v in ((feature, -1), (at, 0.0), (left, i), (right, i), (depth, level + _average_path(len(part)))):
                col.append(v)
            lo, hi = part.min(0), part.max(0)
            open_ = np.flatnonzero(hi > lo)
            if level < self.limit and len(part) > 1 and len(open_):
                f = int(rng.choice(open_))
                cut = rng.uniform(lo[f], hi[f])
                below = part[:, f] < cut
                if below.any() and not below.all():
                    feature[i], at[i] = f, cut
                    left[i] = node(part[below], level + 1)
                    right[i] = node(part[~below], level + 1)
            return i

        node(rows, 0)
        return tuple(np.array(x) for x in (feature, at, left, right, depth))

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / usual path): near 1 for rows that random splits set apart at once."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, at, left, right, depth in self.trees:
            pos = np.zeros(len(x), np.int64)
            for _ in range(self.limit):
                f = feature[pos]
                go_left = x[rows, np.maximum(f, 0)] < at[pos]
                pos = np.where(f < 0, pos, np.where(go_left, left[pos], right[pos]))
            total += depth[pos]
        return 2.0 ** (-total / len(self.trees) / max(self.scale, 1e-9))


def _average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def with_scores(stats: DataFrame, forest: Forest, out: str = "anomaly") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ts.lean_batches(batches):
            if batch.num_rows:
                f = batch.column(batch.schema.get_field_index("features"))
                x = f.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield batch.append_column(out, pa.array(forest.score(x)))

    return stats.mapInArrow(run, stats.withColumn(out, F.lit(0.0)).schema)


def fit(stats: DataFrame, labelled: DataFrame, id_col: str, label_col: str, trees: int = TREES, size: int = TREE_ROWS,
        depth: int = DEPTH, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> tuple[Forest, float] | None:
    """Forest from a bounded sample of the labelled rows; threshold from all of them (None: no usable labels)."""
    marks = labelled.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("_label"))
    known = stats.where(f"NOT ({BASE_FAILED})").select(id_col, "features").join(marks, id_col)
    sample = hash_sample(known, id_col, sample_rows, seed).select("features").toPandas()["features"]
    if len(sample) < 2:
        return None
    forest = Forest(np.array(sample.tolist(), dtype=np.float64), trees, size, depth, seed)
    scored = with_scores(known.select("features", "_label"), forest)
    hist = np.zeros((BINS, 2))
    for b, label, n in (scored.groupBy(F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).alias("b"),
                                       (F.col("_label") > 0).cast("int").alias("l")).count().collect()):
        hist[b, label] += n
    return None if hist.sum(0).min() == 0 else (forest, calibrate(hist))


def calibrate(hist: np.ndarray) -> float:
    """Score edge with the largest (share of bad rows at or above it) - (share of good rows there)."""
    above = np.cumsum(hist[::-1], axis=0)[::-1] / hist.sum(0)
    return int(np.argmax(above[:, 0] - above[:, 1])) / BINS


def apply_rules(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality") -> DataFrame:
    """Base rule counts, anomaly score and verdict for every document."""
    stats = keep(rule_statistics(docs, id_col, text_col), "rule_stats")
    model = fit(stats, labelled, id_col, label_col)
    base_failed = F.expr(BASE_FAILED)
    if model is None:
        scored, odd = stats.withColumn("anomaly", F.lit(0.0)), F.lit(False)
    else:
        scored, odd = with_scores(stats, model[0]), F.col("anomaly") >= F.lit(model[1])
    return scored.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & ~odd)
