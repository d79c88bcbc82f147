"""Operator 9: near-duplicate groups by b-bit MinHash.

1. ``signatures``: each text's set of word shingles gives minima under ``bands * rows`` hash
   functions. A band key is a hash of ``rows`` whole minima; the signature keeps the low
   ``BITS`` bits of every minimum, packed 16 to a 64-bit integer. No sets are stored.
2. Documents with equal sets are one class, named by its least doc_id; only classes go on.
3. Each band bucket pairs its classes with its least class (its hub): linear in the bucket.
4. A pair's similarity is estimated from the equal groups of bits in both signatures,
   corrected for chance collisions (1 in 2^BITS); pairs clearly below the threshold go
   (``MARGIN`` is about five standard deviations). The rest is confirmed on full sets,
   recomputed from the texts of the documents concerned.
5. Confirmed links give components. In a bucket that still holds several components, every
   class outside its largest component is compared with all others, in blocks of bounded
   size, on signatures and then full sets; links found merge components. So every pair that
   shares a bucket is either compared or already in one component.

Two texts at the threshold share no band with probability (1 - t^rows)^bands: 3e-7 at 0.85
and 6e-5 at 0.8.

Defined results: a null text, or one without words, has an empty set and is linked with
nothing; one with fewer words than a shingle has one shingle, the whole sequence; rows with
a null doc_id are not linked (component null, kept); repeated rows share a set and thus a
component; an empty table gives no rows. Extra columns are ignored, and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import bounded_broadcast, byte_chunks, table
from tillcast.llm.components import components
from tillcast.session import stage

BANDS, ROWS, BITS, MARGIN = 32, 6, 4, 0.15
#: Rows of a block on either side in the comparison of what a bucket has left.
BLOCK = 256
PRIME = np.uint64(0x9E3779B97F4A7C15)
LOW = int("1" * 16, 16)  # the lowest bit of each group of four


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of ``width`` words;
    A-Z are lower-cased."""
    split = [t.lower().split() for t in texts]
    ids = {w: i for i, w in enumerate({w for s in split for w in s})}
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), dtype=np.uint64, count=len(ids))
    sets = []
    for words in split:
        h = hashes[np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=len(words))]
        n = min(width, len(words))
        x = np.full(len(words) - n + (n > 0), n, dtype=np.uint64)
        for i in range(n):
            x = x * PRIME + h[i:len(words) - n + 1 + i]
        sets.append(np.unique(mixed(x)))
    return sets


def minima(sets: list[np.ndarray], functions: int) -> np.ndarray:
    """The least value of each set (none empty) under each hash function."""
    draw = np.random.default_rng(9)
    a = draw.integers(0, 1 << 31, functions, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = draw.integers(0, 1 << 32, functions, dtype=np.uint32)
    out = np.empty((len(sets), functions), dtype=np.uint32)
    first = 0
    while first < len(sets):  # blocks that stay in a core's cache
        last, held = first, 0
        while last < len(sets) and (held == 0 or held + len(sets[last]) <= 1 << 16):
            held += len(sets[last])
            last += 1
        x = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[first:last - 1]])
        buffer = np.empty_like(x)
        for i in range(functions):
            np.multiply(x, a[i], out=buffer)
            np.add(buffer, b[i], out=buffer)
            out[first:last, i] = np.minimum.reduceat(buffer, starts)
        first = last
    return out


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(least), bands)).copy()
    grouped = least.reshape(len(least), bands, rows).astype(np.uint64)
    for i in range(rows):
        keys = mixed(keys * PRIME + grouped[:, :, i])
    return keys.view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, 16 to an integer."""
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(least), -1, 16)
    shift = np.arange(16, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shift, axis=2).view(np.int64)


def estimate(a: Column, b: Column, functions: int) -> Column:
    """Similarity from two packed signatures: the share of equal groups of bits, corrected
    for those that are equal by chance."""
    x = F.zip_with(a, b, lambda p, q: p.bitwiseXOR(q))
    fold = F.transform(x, lambda v: v.bitwiseOR(F.shiftrightunsigned(v, 1)))
    fold = F.transform(fold, lambda v: F.bit_count(v.bitwiseOR(F.shiftrightunsigned(v, 2)).bitwiseAND(F.lit(LOW))))
    differ = F.aggregate(fold, F.lit(0), lambda total, v: total + v)
    chance = 1 / (1 << BITS)
    return (1 - differ / functions - chance) / (1 - chance)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for every row of ``a`` against every row of ``b``."""
    x = (a[:, None, :] ^ b[None, :, :]).view(np.uint64)
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    differ = np.bitwise_count(x & np.uint64(LOW)).sum(axis=2, dtype=np.int64)
    chance = 1 / (1 << BITS)
    return (1 - differ / (16 * a.shape[1]) - chance) / (1 - chance)


def signatures(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets; null if empty), bands, signature."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("signature", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_chunks(batch.column(1)):
                sets = shingle_sets(texts, width)
                some = [i for i, s in enumerate(sets) if len(s)]
                least = minima([sets[i] for i in some], bands * rows)
                keys, low = [None] * len(sets), [None] * len(sets)
                for i, k, s in zip(some, band_keys(least, bands, rows), packed(least), strict=True):
                    keys[i], low[i] = k, s
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(keys, schema.field(3).type), pa.array(low, schema.field(4).type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id long, n_shingles long, set_key binary, bands array<long>, signature array<long>")


def full_sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """The shingle sets of the classes (class_id, set_key), from the texts; an id that names
    several classes has a row for each."""
    schema = pa.schema([("class_id", pa.int64()), ("set_key", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in byte_chunks(batch.column(2)):
                rows = batch.slice(first, len(texts))
                found = shingle_sets(texts, width)
                # A doc_id can come with several texts: only the class's own counts.
                own = [i for i, (s, k) in enumerate(zip(found, rows.column(1).to_pylist(), strict=True))
                       if len(s) and xxhash.xxh3_128_digest(s.tobytes()) == k]
                at = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at),
                                                  pa.array([found[i].view(np.int64) for i in own], schema.field(2).type)], schema=schema)

    n = classes.count()
    wanted = docs.select(F.col("doc_id").cast("long").alias("class_id"), "text").join(bounded_broadcast(classes, n), "class_id")
    out = stage(wanted.select("class_id", "set_key", "text").mapInArrow(sets, "class_id long, set_key binary, shingles array<long>"), "sets")
    # Each class has a row at least, so only more rows than classes can hold repeated ones.
    return (out if out.count() == n else out.dropDuplicates(["class_id", "set_key"])).drop("set_key")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets reach the similarity."""
    a = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("in_a"))
    b = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("in_b"))
    both = F.size(F.array_intersect("in_a", "in_b")).cast("long")
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", both.alias("both"), (F.size("in_a") + F.size("in_b")).cast("long").alias("sum"))
    return joined.filter(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b")


def left_over(buckets: DataFrame, signed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components that meet in a bucket (key, class_id, component);
    for each two components of a block at most one link."""
    at_least = percent / 100 - MARGIN
    sizes = buckets.groupBy("key", "component").count()
    main = sizes.groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("main"),
                                    F.sum("count").alias("n"), F.max("count").alias("n_main"))
    rows = buckets.join(main, "key").withColumn("minor", F.col("component") != F.col("main"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    minor_blocks = F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int")
    spread = F.xxhash64("class_id", "key")
    # Each member meets every block of minors; each minor also meets every block of members.
    members = rows.select("key", "class_id", "component", F.lit(False).alias("minor"), F.pmod(spread, blocks).cast("int").alias("i"),
                          F.explode(F.sequence(F.lit(0), minor_blocks - 1)).alias("j"))
    minors = rows.filter("minor").select("key", "class_id", "component", F.lit(True).alias("minor"),
                                         F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"), F.pmod(spread, minor_blocks).cast("int").alias("j"))
    signatures_of = signed.select("class_id", "signature")

    def close_pairs(block: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, np.ndarray]:
        """Minors, members and which of their pairs are close by signature and apart by component."""
        minor = block[block["minor"]].reset_index(drop=True)
        member = block[~block["minor"]].reset_index(drop=True)
        if not len(minor) or not len(member):
            return minor, member, np.zeros((len(minor), len(member)), dtype=bool)
        close = estimates(np.stack(minor["signature"]), np.stack(member["signature"])) >= at_least
        return minor, member, close & (minor["component"].to_numpy()[:, None] != member["component"].to_numpy()[None, :])

    def close_rows(block: pd.DataFrame) -> pd.DataFrame:
        minor, member, close = close_pairs(block)
        return pd.concat([minor[close.any(axis=1)], member[close.any(axis=0)]])

    # Signatures alone leave the few rows for which full sets are needed.
    blocks_of = members.unionAll(minors).join(signatures_of, "class_id").select("key", "i", "j", "class_id", "component", "minor", "signature")
    few = blocks_of.groupBy("key", "i", "j").applyInPandas(close_rows, blocks_of.schema)
    full = few.join(sets, "class_id")

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        minor, member, close = close_pairs(block)
        links, joined = [], {}

        def root(c):
            while joined.get(c, c) != c:
                c = joined[c]
            return c

        for p, q in zip(*np.nonzero(close), strict=True):
            x, y = root(minor["component"][p]), root(member["component"][q])
            if x != y:
                a, b = minor["shingles"][p], member["shingles"][q]
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    joined[max(x, y)] = min(x, y)
                    links.append((minor["class_id"][p], member["class_id"][q]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return full.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def groups(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    signed = stage(signatures(docs, width, bands, rows), "signatures")
    named = signed.filter("set_key is not null and doc_id is not null")
    classes = stage(named.groupBy("set_key").agg(F.min("doc_id").alias("class_id")), "classes")
    own = stage(named.join(classes, (named["doc_id"] == classes["class_id"]) & (named["set_key"] == classes["set_key"]))
                .select("class_id", classes["set_key"], "bands", "signature").dropDuplicates(["class_id", "set_key"]), "own")
    banded = own.select("class_id", F.explode("bands").alias("key"))
    shared = stage(banded.groupBy("key").agg(F.min("class_id").alias("hub"), F.count("*").alias("n")).filter("n > 1"), "shared")
    met = stage(banded.join(bounded_broadcast(shared, shared.count()), "key"), "met")
    pairs = met.filter("class_id <> hub").select(F.col("class_id").alias("a"), F.col("hub").alias("b")).distinct()
    a = own.select(F.col("class_id").alias("a"), F.col("signature").alias("sa"))
    b = own.select(F.col("class_id").alias("b"), F.col("signature").alias("sb"))
    close = pairs.join(a, "a").join(b, "b").filter(estimate(F.col("sa"), F.col("sb"), bands * rows) >= percent / 100 - MARGIN)
    close = stage(close.select("a", "b"), "close")
    # Full sets are needed for these pairs, and for the buckets with several members beside the hub.
    needed = close.select(F.explode(F.array("a", "b")).alias("class_id")).unionAll(met.filter("n > 2").select("class_id")).distinct()
    sets = full_sets(docs, own.select("class_id", "set_key").join(needed, "class_id", "left_semi"), width)
    links = stage(confirmed(close, sets, percent), "links")
    found = components(links)
    open_ = met.filter("n > 2").select("key", "class_id").join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    open_ = stage(open_.select("key", "class_id", F.coalesce("root", "class_id").alias("component")), "open")
    several = open_.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    more = stage(left_over(open_.join(several, "key", "left_semi"), own, sets, percent), "more")
    if not more.isEmpty():
        found = components(links.unionAll(more))
    roots = classes.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    roots = roots.select("set_key", F.coalesce("root", "class_id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(roots, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def dedup(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` of which one stays per component (the least doc_id), with their
    columns. A doc_id that comes with several texts goes only if none of them stays; rows
    equal in doc_id and text become one."""
    found = stage(groups(docs, **how).filter("doc_id is not null").select("doc_id", "kept"), "groups")
    ids = stage(found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).filter("not kept or n > 1"), "ids")
    gone, again = ids.filter("not kept").select("doc_id"), ids.filter("kept").select("doc_id")
    left = docs.join(bounded_broadcast(gone, gone.count()), "doc_id", "left_anti")
    n = again.count()
    if not n:
        return left
    again = bounded_broadcast(again, n)
    return left.join(again, "doc_id", "left_anti").unionByName(left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))


def op9_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"), width=3, percent=85)
