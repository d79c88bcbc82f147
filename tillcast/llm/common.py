"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillcast.session import stage

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and
#: carriage return (in Python: ``bytes.split()``).
WORD = r"[^\x20\x09-\x0D]+"

#: Most rows and bytes of a side that is broadcast (checked by a count before each use).
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``mod`` = ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == remainder, F.lit(False))


def bounded_broadcast(df: DataFrame, rows: int, row_bytes: int = 64, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` and their bytes are within bounds;
    beyond them the join is left to the planner (shuffled, AQE splits skewed keys). A table with
    columns of free length gives the greatest ``row_bytes``; a few numbers or hashes need no more
    than the default."""
    return F.broadcast(df) if rows <= limit and rows * row_bytes <= BROADCAST_BYTES else df


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with its gapless position (from 0) in the given order, without one global task:
    range partitions, a row number in each, and the sizes of the partitions before it."""
    parts = stage(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranked")
    sizes = parts.groupBy("__part").count()
    # One row per partition, so this window is as small as the number of partitions.
    before = sizes.select("__part", (F.sum("count").over(W.orderBy("__part")) - F.col("count")).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1
    return (parts.withColumn("__inside", inside).join(F.broadcast(before), "__part")
            .withColumn(name, F.col("__before") + F.col("__inside")).drop("__part", "__before", "__inside"))


def byte_chunks(texts, limit: int = 4_000_000):
    """An Arrow column of texts in chunks of about ``limit`` bytes: (first row, list of bytes);
    a null is empty."""
    chunk, first, held = [], 0, 0
    for i, value in enumerate(texts.cast("binary")):
        chunk.append(value.as_py() or b"")
        held += len(chunk[-1])
        if held >= limit:
            yield first, chunk
            chunk, first, held = [], i + 1, 0
    if chunk:
        yield first, chunk


def running_sum(a: Column) -> Column:
    """Running sums of an array of int, by doubling: no array grows element by element."""
    def step(sums: Column, k: Column) -> Column:
        behind = F.slice(F.concat(F.array_repeat(F.lit(0), F.call_function("shiftleft", F.lit(1), k)), sums), 1, F.size(sums))
        return F.zip_with(sums, behind, lambda x, y: x + y)

    return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(a), F.lit(1)))).cast("int")), a, step)
