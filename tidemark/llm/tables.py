"""Table helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where a result feeds several later jobs: the lineage is cut, and an
    executor lost later does not repeat the work before this point.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, id_col: str, rows: int, seed: int) -> DataFrame:
    """The ``rows`` rows of smallest seeded id hash, in that order; all rows if there are fewer.

    The hash range is cut by the row count first (with five standard deviations to spare), so that hardly more than
    ``rows`` rows come together, however many partitions there are.
    """
    space = 1 << 40
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(space))
    n = df.count()
    if n > rows:
        df = df.where(place < int(space * min(1.0, (rows + 5 * rows ** 0.5 + 25) / n)))
    return df.orderBy(place, id_col).limit(rows)


def crc32_mod(col: str, mod: int) -> Column:
    """crc32 of the value's decimal text, modulo ``mod`` (the fold rule of the labelled queries)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(mod)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> list[Column]:
    """``h1`` and ``h2``: a 128-bit key of a text (null: of an empty one).  Rows of one key hold one text, whatever their ids."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]
