"""Operator 3: shards of near-equal bytes by sampled splitters.

Records are ordered by (hash of the text, doc_id, number of the row). A size-weighted sample
of the hashes gives quantile boundaries that cut the order into ranges, many for each shard.
The ranges are then weighed over all records; one that is overfull is sampled again from its
own records and subdivided, by hash while it has several texts, else by the rest of the
order, until no range is overfull or it is a single record. Ranges are small, so positions
come from a window over a range and the sums of the ranges before it.

Equal texts share a shard unless their group alone outweighs one. A group of more than 1/64 of a
shard has ranges of its own: such groups are placed whole first, the heaviest on the lightest shard (at
most 64 for each shard, so the driver can deal them out). All other texts fill up the shards as runs of the
order, a group where its middle lies. Only a group that outweighs a shard is cut, as part of the runs.

Defined results: a null text has 0 bytes and a null crc, and all null texts are one group;
null doc_ids come first; equal rows are told apart by the number of the row; an empty table
gives no rows. A record larger than a shard makes its shard that much larger. Extra columns
are ignored.
"""

from __future__ import annotations

import bisect
import heapq
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.functions import pandas_udf

from tillcast.llm.common import table
from tillcast.session import stage

#: A shard is cut into about PER_SHARD ranges; a group of equal texts above 1/WHOLE of a shard has ranges of its own.
SHARDS, PER_SHARD, WHOLE, PER_RECORD = 40, 256, 64, 16
ORDER = ["hash", "id", "row"]


def records(docs: DataFrame) -> DataFrame:
    """The compact table that is sharded: no texts."""
    text = F.col("text").cast("binary")
    return docs.select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + PER_RECORD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.coalesce(F.xxhash64(F.col("text")), F.lit(0)).alias("hash"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
                       F.monotonically_increasing_id().alias("row"))


def drawn(rows: DataFrame, n: int) -> list[tuple]:
    """A size-weighted sample of exactly ``n`` records at most (exponential races: the least
    of -ln(u) / size), u from the record itself, so reruns agree."""
    u = (F.xxhash64("hash", "id", "row").bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    return [tuple(r) for r in rows.select(*ORDER, (-F.log(u) / F.col("size")).alias("race"))
            .orderBy("race", *ORDER).limit(n).select(*ORDER).collect()]


def range_of(splitters: list[tuple]) -> Column:
    """The number of splitters at or below a record, by binary search."""
    hashes = np.array([s[0] for s in splitters], dtype=np.int64)

    @pandas_udf("int")
    def find(hash: pd.Series, id: pd.Series, row: pd.Series) -> pd.Series:
        low, high = np.searchsorted(hashes, hash, "left"), np.searchsorted(hashes, hash, "right")
        for i in np.flatnonzero(low != high):  # the record's hash is itself a splitter's
            low[i] = bisect.bisect_right(splitters, (hash.iat[i], id.iat[i], row.iat[i]), low[i], high[i])
        return pd.Series(low.astype(np.int32))

    return find(*ORDER)


LOWEST = (-(1 << 63), -1)


def text_cuts(hashes: list[int]) -> set[tuple]:
    """Splitters before the drawn texts, and also behind those drawn twice or more: a heavy
    text gets a range of its own."""
    often = {h for h, n in Counter(hashes).items() if n > 1 and h < (1 << 63) - 1}
    return {(h, *LOWEST) for h in hashes} | {(h + 1, *LOWEST) for h in often}


def split_ranges(rows: DataFrame, total: int, n_ranges: int, whole: float) -> list[tuple]:
    """Splitters under which no range of several texts weighs over twice the mean, and no
    range of one text over ``whole`` bytes, unless it is one record."""
    splitters = sorted(text_cuts([h for h, _, _ in drawn(rows, n_ranges)]))
    while True:
        full = rows.withColumn("range", range_of(splitters)).groupBy("range").agg(
            F.sum("size").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high"), F.count("*").alias("n"))
        limit = F.when(F.col("low") == F.col("high"), max(whole, 2 * total / n_ranges)).otherwise(2 * total / n_ranges)
        over = full.filter((F.col("bytes") > limit) & (F.col("n") > 1))
        over = {r["range"]: r for r in over.collect()}
        if not over:
            return splitters
        inside = rows.withColumn("range", range_of(splitters)).filter(F.col("range").isin(list(over)))
        # Enough draws that each overfull range is cut to about the mean.
        more = drawn(inside, sum(-(-2 * r["bytes"] * n_ranges // total) for r in over.values()))
        texts, new = [], set()
        for s in more:
            r = over[bisect.bisect_right(splitters, s)]
            if r["low"] == r["high"]:
                new.add(s)
            else:
                texts.append(s[0])
        new |= text_cuts(texts)
        for r in over.values():  # always progress: the lowest text apart from the others
            if r["low"] != r["high"]:
                new.add((r["low"] + 1, *LOWEST))
        merged = sorted(set(splitters) | new)
        if merged == splitters:
            return splitters
        splitters = merged


def placement(ranges: list[tuple[int, int, int, int]], total: int, shards: int) -> tuple[dict[int, int], list[float]]:
    """For ``ranges`` (range, bytes, least and highest hash): the shard of each range of a heavy text, and
    the ends of the shards' shares in the bytes of all other ranges."""
    share, weights = total / shards, defaultdict(int)
    for _, size, low, high in ranges:
        if low == high:
            weights[low] += size
    heavy = sorted(((size, h) for h, size in weights.items() if share / WHOLE < size <= share), reverse=True)
    loads, where = [(0, i) for i in range(shards)], {}
    for size, h in heavy:  # the heaviest first, on the lightest shard
        load, i = heapq.heappop(loads)
        where[h] = i
        heapq.heappush(loads, (load + size, i))
    # The level to which the rest fills up all shards that are below it.
    rest, ordered = total - sum(size for size, _ in heavy), sorted(load for load, _ in loads)
    level = next(x for k in range(shards, 0, -1) if (x := (rest + sum(ordered[:k])) / k) >= ordered[k - 1])
    room = np.zeros(shards)
    for load, i in loads:
        room[i] = max(level - load, 0.0)
    return {r: where[low] for r, _, low, high in ranges if low == high and low in where}, np.cumsum(room).tolist()


def shard(rows: DataFrame, shards: int = SHARDS, per_shard: int = PER_SHARD) -> DataFrame:
    """A stored ``records`` table with shard and slot."""
    spark = rows.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    splitters = split_ranges(rows, total, shards * per_shard, total / shards / WHOLE) if total else []
    ranged = stage(rows.withColumn("range", range_of(splitters)), "ranged")
    # One row per range: their number is bounded by shards, per_shard and the subdivisions.
    ranges = sorted(map(tuple, ranged.groupBy("range").agg(F.sum("size"), F.min("hash"), F.max("hash")).collect()))
    fixed, ends = placement(ranges, total, shards) if total else ({}, [0.0])
    starts, filled = [], 0
    for r, size, _, _ in ranges:
        starts.append((r, fixed.get(r), filled))
        filled += 0 if r in fixed else size
    starts = F.broadcast(spark.createDataFrame(starts, "range int, fixed int, bytes_before long"))
    group = W.partitionBy("range", "hash")
    inside = W.partitionBy("range").orderBy(*ORDER)
    run = F.lit(0)
    for end in ends[:-1]:
        run = run + (F.col("middle") >= end).cast("int")
    out = (ranged.join(starts, "range")
           .withColumn("end", F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
           .withColumn("place", F.row_number().over(inside))
           .withColumn("middle", (F.min(F.col("end") - F.col("size")).over(group) + F.max("end").over(group)) / 2)
           .withColumn("shard", F.coalesce("fixed", run)))
    out = stage(out.select("doc_id", "size", "text_crc32", "shard", "range", "place"), "placed")
    # A shard's rows in a range are neighbours; the ranges of a shard follow each other.
    parts, before, counts = [], 0, out.groupBy("shard", "range").agg(F.min("place"), F.count("*")).collect()
    for i, (shard_, range_, first, n) in enumerate(sorted(map(tuple, counts))):
        before = 0 if i and parts[-1][0] != shard_ else before
        parts.append((shard_, range_, before - first))
        before += n
    parts = F.broadcast(spark.createDataFrame(parts, "shard int, range int, shift long"))
    return out.join(parts, ["shard", "range"]).withColumn("slot", F.col("place") + F.col("shift"))


def op3_sampled_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(stage(records(table(spark, sf_dir, "documents")), "records"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
