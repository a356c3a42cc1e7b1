"""The shop's string hash (h = h*31 + char, 32-bit overflow) masked to 2^bits.

Masking every step is exact because 2^bits divides 2^32, so the fold stays in
BIGINT and never overflows.  Runs as a JVM higher-order function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_hash(s: Column, bits: int = 29) -> Column:
    mask = F.lit((1 << bits) - 1).cast("bigint")
    chars = F.split(s, "")
    return F.aggregate(chars, F.lit(0).cast("bigint"), lambda acc, c: (acc * 31 + F.ascii(c)).bitwiseAND(mask))


def string_hash_sql(expr: str, bits: int = 29) -> str:
    """DuckDB form of ``string_hash`` (for oracles)."""
    mask = (1 << bits) - 1
    return (f"list_reduce(list_transform(string_split({expr}, ''), lambda c: CAST(ascii(c) AS BIGINT)), "
            f"lambda a, c: (a * 31 + c) & {mask}, CAST(0 AS BIGINT))")
