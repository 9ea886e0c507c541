"""What the text operators share: shared scratch tables and small text helpers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ..scratch import materialise as materialise
from ..scratch import scratch_dir as scratch_dir

#: The 64-bit finaliser of splitmix64 (Steele, Lea, Flood 2014).
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


#: A key with more than this part of all rows counts as hot, so there are at most so many.
HOT_SHARE = 1000


def hot_among(counts: DataFrame, key: str | list[str], n: str, total: int) -> DataFrame:
    """Of counts (key, or columns, and rows n of each), the hot keys with __parts, into how many their rows are dealt.

    All parts together are 2 * HOT_SHARE at most. A written table.
    """
    parts = F.ceil(F.col(n) * HOT_SHARE / F.lit(max(total, 1))).cast("long").alias("__parts")
    return materialise(counts.filter(F.col(n) * HOT_SHARE > total).select(*([key] if isinstance(key, str) else key), parts))


def hot_keys(rows: DataFrame, key: str | list[str]) -> DataFrame:
    """The keys that more than 1 / HOT_SHARE of all rows have, with __parts, as a written table."""
    return hot_among(rows.groupBy(key).agg(F.count("*").alias("__n")), key, "__n", rows.count())


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str | list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with lookup (one row a key) on a key, or columns, that every row has.

    hot: keys with __parts. Rows of a hot key are dealt to its parts by a hash of their
    single values, and its row of lookup is copied to each, so that no task gets all rows
    of one and no row of lookup, whatever its size, goes to all tasks.
    """
    keys = [key] if isinstance(key, str) else key
    if hot.isEmpty():
        return rows.join(lookup, keys, how)
    few = F.broadcast(hot.select(*keys, "__parts"))
    single = [f.name for f in rows.schema.fields if isinstance(f.dataType, AtomicType)]
    parts = F.coalesce("__parts", F.lit(1).cast("long"))
    dealt = rows.join(few, keys, "left").withColumn("__part", F.pmod(F.xxhash64(*single), parts)).drop("__parts")
    copies = lookup.join(few, keys, "left").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("__parts")
    return dealt.join(copies, [*keys, "__part"], how).drop("__part")


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on an array of uint64."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(MIX_A)
        x ^= x >> np.uint64(27)
        x *= np.uint64(MIX_B)
        x ^= x >> np.uint64(31)
    return x


def crc32_of_id(id_col: str | Column) -> Column:
    """CRC-32 of a number's decimal text; null for a null id."""
    return F.crc32((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string").cast("binary"))
