"""Operator 5: best-fit-decreasing packing of token pieces into sequences.

Best fit decreasing depends on lengths only, and a length is at most ``capacity``. So the
packing is planned on the histogram of lengths (at most ``capacity`` numbers, whatever the
corpus): lengths are dealt longest first, each to the tightest sequence it fits, found in
logarithmic time by a segment tree over remaining capacities. Sequences with the same
remaining capacity are interchangeable and are kept as runs of consecutive numbers, so one
step places all pieces of a length that meet the same run. The plan is a list of runs:
"the pieces of length l with ranks a to b lie in the sequences from s on, m in each, from
offset o". It is exactly the packing that the one-by-one algorithm gives.

A piece's rank among those of its length is its rank in its task plus the counts of the
tasks before: no window over a length, however common that is.

Defined results: a null or empty text is the closing id alone; equal rows are packed each;
a null doc_id is kept as null; an empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.functions import pandas_udf

from tillcast.llm.common import bounded_broadcast, table
from tillcast.llm.tokens import tokenizer
from tillcast.session import stage

CAPACITY, END_ID = 4096, 1

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank_in_part", pa.int64())])


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in its task;
    ``keep_ids`` adds the ids themselves."""
    schema = PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if keep_ids else PIECES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = tokenizer(path).encode, np.zeros(capacity + 1, dtype=np.int64)
        part, end = TaskContext.get().partitionId(), END_ID.to_bytes(4, "little")
        for batch in batches:
            cols: list[list] = [[] for _ in schema]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at:at + 4 * capacity]
                    length = len(piece) // 4
                    row = [doc, n, at // 4, length, zlib.crc32(piece), part, seen[length]]
                    for col, value in zip(cols, row + [np.frombuffer(piece, "<i4")] * keep_ids, strict=True):
                        col.append(value)
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank_in_part long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, ddl)


class CapacityTree:
    """Which remaining capacities have open sequences; ``tightest(need)`` is the least such
    capacity that is at least ``need``."""

    def __init__(self, capacity: int):
        self.n = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.n)

    def set(self, capacity: int, has: bool) -> None:
        i = capacity + self.n
        self.any[i] = has
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        i = need + self.n
        while not self.any[i]:  # climb to the nearest subtree to the right that has any
            while i & 1:
                i //= 2
            if i == 0:
                return None
            i += 1
        while i < self.n:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.n


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best fit decreasing of ``counts`` (length: number of pieces). Rows: length, first rank,
    first sequence, pieces per sequence, first offset; in order of length and rank."""
    tree, runs, made, rows = CapacityTree(capacity), {}, 0, []

    def open_run(left: int, first: int, n: int) -> None:
        if n and left:
            runs.setdefault(left, []).append((first, n))
            tree.set(left, True)

    for length in sorted(counts, reverse=True):
        rank, need = 0, counts[length]
        while need:
            left = tree.tightest(length)
            if left is None:
                left, each = capacity, capacity // length
                first, n = made, -(-need // each)
                made += n
            else:
                each = left // length
                first, n = runs[left].pop()
                if not runs[left]:
                    tree.set(left, False)
            full = min(n, need // each)  # sequences that take as many as fit
            if full:
                rows.append((length, rank, first, each, capacity - left))
                open_run(left - each * length, first, full)
                rank, need = rank + full * each, need - full * each
            if need and full < n:  # one takes the rest
                rows.append((length, rank, first + full, need, capacity - left))
                open_run(left - need * length, first + full, 1)
                full, need = full + 1, 0
            open_run(left, first + full, n - full)
    order = sorted(rows)
    return np.array(order, dtype=np.int64).reshape(-1, 5)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A stored ``pieces`` table with sequence_id and offset."""
    counts = stage(cut.groupBy("length", "part").count(), "lengths")
    # One row per task and length at most; the window of a length has one row per task.
    before = counts.withColumn("before", F.sum("count").over(W.partitionBy("length").orderBy("part")) - F.col("count")).drop("count")
    per_length = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}
    plan = best_fit(per_length, capacity)
    step = 1 << 44  # more than the pieces of one length
    keys = plan[:, 0] * step + plan[:, 1]

    @pandas_udf("sequence_id long, offset long")
    def seat(length, rank):
        import pandas as pd
        run = plan[np.searchsorted(keys, length.to_numpy() * step + rank.to_numpy(), side="right") - 1]
        nth = rank.to_numpy() - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 2] + nth // run[:, 3], "offset": run[:, 4] + nth % run[:, 3] * run[:, 0]})

    placed = cut.join(bounded_broadcast(before, counts.count()), ["length", "part"])
    placed = placed.withColumn("seat", seat("length", F.col("before") + F.col("rank_in_part")))
    return placed.select(*[c for c in cut.columns if c not in ("part", "rank_in_part")], "seat.sequence_id", "seat.offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    return place(stage(pieces(docs, capacity, path, keep_ids), "pieces"), capacity)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
