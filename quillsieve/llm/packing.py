"""Filling containers of one capacity: best fit over the histogram of sizes.

The plan is made over counts, not documents: sizes are at most the capacity, so the histogram has at most ``capacity``
rows however many documents there are, and so has the list of bin patterns about as many.  Documents then take the
planned slots by joining on their rank within their size.  A text larger than a bin is cut into full bins and a rest;
the rest is planned like any other item.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.operators.ranks import running_sum

#: Documents of one size that are ranked in one bucket, about, and the fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 200_000, 64


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing over counts: ``(number of bins, sizes in each)`` patterns covering every item once.

    Items of a size are placed together: into the open patterns with the least room that still takes them, the rest into
    new bins.  Work grows with the number of different sizes, not with the counts.
    """
    rooms: list[int] = []  # sorted, the rooms that open patterns have
    opened: dict[int, list[list]] = {}  # room: [bins, content]
    done: list[tuple[int, tuple[int, ...]]] = []

    def put(room: int, bins: int, content: tuple[int, ...]) -> None:
        if room == 0:
            done.append((bins, content))
            return
        if room not in opened:
            opened[room] = []
            insort(rooms, room)
        opened[room].append([bins, content])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left > 0:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern = opened[room][-1]
                each = min(room // size, left) if pattern[0] * (room // size) > left else room // size
                bins = min(pattern[0], left // each) if each else 0
                pattern[0] -= bins
                if pattern[0] == 0:
                    opened[room].pop()
                    if not opened[room]:
                        del opened[room]
                        rooms.pop(at)
                put(room - each * size, bins, pattern[1] + (size,) * each)
                left -= bins * each
            else:
                each = min(capacity // size, left)
                bins = left // each
                put(capacity - each * size, bins, (size,) * each)
                left -= bins * each
    return done + [(bins, content) for patterns in opened.values() for bins, content in patterns if bins]


def _slots(plan: list[tuple[int, tuple[int, ...]]]) -> pd.DataFrame:
    """One row per pattern and size in it: the ranks it takes and the first bin number and place they go to."""
    taken: dict[int, int] = {}
    rows, first_bin = [], 0
    for pattern, (bins, content) in enumerate(plan):
        place = 0
        for size in dict.fromkeys(content):
            each = content.count(size)
            rows.append((size, taken.get(size, 0), each, first_bin, place, pattern))
            taken[size] = taken.get(size, 0) + each * bins
            place += each
        first_bin += bins
    slots = pd.DataFrame(rows, columns=["size", "first_rank", "each", "first_bin", "place", "pattern"])
    return slots.sort_values(["size", "first_rank"], ignore_index=True)


def pack(docs: DataFrame, key: str, size: Column, capacity: int) -> DataFrame:
    """Rows ``(key, piece, pieces, size, start, bin, place)``: where each document, or each piece of an oversized one, goes.

    ``start`` is the offset of the piece in tokens.  Documents without a size (null) are left out; those of size 0 take
    no room and have ``bin`` -1.  Bins are numbered from 0; the full pieces of oversized documents and items of exactly
    the capacity are planned like the others and get a bin each.  Equal sizes are ranked by the hash of the key and the
    key itself, so the result doesn't depend on the partitioning; ``key`` must be unique.  An empty table gives no rows.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    sized = docs.select(F.col(key), size.cast("bigint").alias("total")).filter(F.col("total").isNotNull())
    whole = F.floor(F.col("total") / capacity)
    rest = F.col("total") % capacity
    pieces = F.greatest(F.lit(1), whole + F.when(rest > 0, 1).otherwise(0)).cast("int")
    cut = sized.withColumn("pieces", pieces).select("*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    cut = cut.withColumn("start", F.col("piece").cast("bigint") * capacity)
    cut = cut.withColumn("size", F.least(F.lit(capacity), F.col("total") - F.col("start")))
    planned = cut.filter(F.col("size") > 0)
    # at most `capacity` rows: the sizes up to it
    counts = {int(r["size"]): int(r["count"]) for r in planned.groupBy("size").count().collect()}
    slots = _slots(plan_bins(counts, capacity))
    by_size = {int(k): v.reset_index(drop=True) for k, v in slots.groupby("size")} if len(slots) else {}
    lookup = {k: tuple(v[c].to_numpy() for c in ("first_rank", "each", "first_bin", "place")) for k, v in by_size.items()}
    # buckets are ranges of the hash, so the ranks don't depend on their number
    buckets = 1 << max(LEAST_BUCKETS - 1, max(counts.values(), default=0) // BUCKET_ROWS).bit_length()
    planned = planned.withColumn("_hash", F.xxhash64(key)).withColumn("_bucket", F.shiftrightunsigned("_hash", 65 - buckets.bit_length()))
    ranked = running_sum(planned, ["size"], "_bucket", ["_hash", key, "piece"], F.lit(1), "_rank").drop("_bucket", "_hash")
    sent = docs.sparkSession.sparkContext.broadcast(lookup)  # a few numbers per size up to the capacity

    def place_bins(batches):
        for batch in batches:
            bins, places = np.zeros(len(batch), dtype="int64"), np.zeros(len(batch), dtype="int64")
            for value, at in batch.groupby("size").indices.items():
                first_rank, each, first_bin, place = sent.value[int(value)]
                rank = batch["_rank"].to_numpy()[at] - 1
                slot = np.searchsorted(first_rank, rank, side="right") - 1
                beyond = rank - first_rank[slot]
                bins[at] = first_bin[slot] + beyond // each[slot]
                places[at] = place[slot] + beyond % each[slot]
            yield batch.drop(columns="_rank").assign(bin=bins, place=places)

    columns = [key, "piece", "pieces", "size", "start"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.select(*columns).schema)
    placed = ranked.select(*columns, "_rank").mapInPandas(place_bins, f"{schema}, bin bigint, place bigint")
    empty = cut.filter(F.col("size") == 0).select(*columns, F.lit(-1).cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("place"))
    return placed.unionByName(empty)


def oversized(packed: DataFrame, key: str) -> DataFrame:
    """The documents that the plan gave more than one slot, in column ``key``."""
    return packed.filter((F.col("bin") >= 0) & (F.col("pieces") > 1) & (F.col("piece") == 0)).select(key)


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: bins, tokens, their lower bound and the share of room left unused."""
    shared = F.when(F.col("bin") >= 0, F.col("bin"))
    total = packed.filter(F.col("size") > 0).agg(
        F.count_distinct(shared).alias("bins"),
        F.sum("size").cast("bigint").alias("tokens"),
    )
    total = total.withColumn("least_bins", F.ceil(F.col("tokens") / capacity))
    return total.withColumn("unused_share", F.round(1 - F.col("tokens") / (F.col("bins") * capacity), 6))
