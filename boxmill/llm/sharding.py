"""Minimax contiguous partition of documents into shards, texts kept together.

Equal texts are one atomic group; groups are ordered by a hash of the text and, at
large scale, taken together by a remainder of that hash, so that the ordered list of
sizes is bounded whatever the data. The smallest capacity for which a greedy walk
needs no more shards than there are is found by binary search, and the list is cut
where that walk cuts. A group over an even share gets a shard of its own first, or
the capacity that it forces would leave later shards empty.

Only DataFrame functions touch the rows; the search runs over the bounded list.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SUBS = 1024


def greedy_cuts(sums: list[int], low: int, high: int, capacity: int, shards: int) -> list[int] | None:
    """Ends of runs of sums[low:high] that hold capacity at most, or None if shards do not do."""
    cuts, at = [], low
    while at < high:
        at = min(high, bisect_right(sums, sums[at] + capacity) - 1)
        cuts.append(at)
        if len(cuts) > shards or len(cuts) > 1 and cuts[-1] == cuts[-2]:
            return None
    return cuts


def minimax_cuts(sizes: list[int], shards: int) -> list[int]:
    """Ends of the runs of a contiguous partition into at most shards runs, with least largest sum."""
    sums = [0, *accumulate(sizes)]
    low, high = max(sizes, default=0), sums[-1]
    while low < high:
        mid = (low + high) // 2
        if greedy_cuts(sums, 0, len(sizes), mid, shards) is None:
            low = mid + 1
        else:
            high = mid
    return greedy_cuts(sums, 0, len(sizes), low, shards) or []


def assign(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size: groups over an even share alone, the rest by minimax_cuts."""
    out = [-1] * len(sizes)
    left, total, used = shards, sum(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if left <= 1 or sizes[i] * left <= total:
            break
        out[i], used, left, total = used, used + 1, left - 1, total - sizes[i]
    rest = [i for i in range(len(sizes)) if out[i] < 0]
    start = 0
    for shard, end in enumerate(minimax_cuts([sizes[i] for i in rest], left)):
        for i in rest[start:end]:
            out[i] = used + shard
        start = end
    return out


def shard_documents(docs: DataFrame, shards: int = 24, units: int = 65_536, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    size: UTF-8 bytes of the text (null: none) plus 8. law: 'bytes'. slot: order by id
    within hidden parts of a shard, gapless from 0. grown_shard: null. Null and empty
    texts are one group. Rows with equal ids are rows of their own; ties among them are
    broken by the text's hash. units bounds the list of sizes that the driver reads; a
    unit is a set of whole groups. Other columns are ignored; an empty table gives no
    rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialise(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("hash"),
        ).withColumn("unit", F.pmod("hash", F.lit(units)).cast("int"))
    )
    found = rows.groupBy("unit").agg(F.sum("size").alias("bytes")).orderBy("unit").collect()  # units rows at most
    shard_of = assign([r["bytes"] for r in found], shards)
    runs: list[list[int]] = []
    for row, shard in zip(found, shard_of, strict=True):
        if not runs or runs[-1][2] != shard:
            runs.append([row["unit"], row["unit"], shard])
        runs[-1][1] = row["unit"]
    # Neighbouring units of one shard are one run: about twice as many runs as shards.
    cases = " ".join(f"WHEN unit <= {last} THEN {shard}" for _, last, shard in runs)
    shard = F.expr(f"CASE {cases} END") if runs else F.lit(0)
    sub = F.pmod(F.xxhash64("doc_id"), F.lit(SUBS)).cast("int")
    placed = rows.select("doc_id", "size", "text_crc32", "hash", shard.cast("int").alias("shard"), sub.alias("sub"))
    ahead = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "sub").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "sub", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "sub").orderBy("doc_id", "hash")
    return placed.join(starts, ["shard", "sub"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.row_number().over(within) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
