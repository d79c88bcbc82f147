"""Operator 2: mix sources to target weights by nested hash thresholds.

Every document has a pseudo-random 60-bit key. A source that needs ``r`` of its words
takes the documents whose key is below a threshold; a larger budget has a larger
threshold, so mixes are nested. The threshold is found without sorting: a histogram
of words by source and the key's first 12 bits shows the bucket in which the budget
falls, only the documents of that bucket are counted again by the next 12 bits, and so
on until the bucket holds one key. The mix itself is then a filter on the key.

Defined results: a null text has size 0; a null source is a source of its own, ordered
last; a null doc_id counts as the empty id; rows equal in id and text share a key, and of
those at the threshold as many are taken as fit (which ones is fixed by a stored numbering,
made for these rows alone); an empty table gives an empty mix; a source without words has
target 0. Documents of size 0 follow the same rule (their words taken are 0); very long texts
are sized whole. Extra columns, whatever their names, are ignored by ``plan`` and kept by ``mix``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillcast.llm.common import WORD, bounded_broadcast, ranked, table
from tillcast.session import stage

LEVEL_BITS, LEVELS = 12, 5


def key(doc_id: Column, text: Column) -> Column:
    """60 bits of md5 over id and text."""
    seed = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(seed.cast("binary")), 1, 15), 16, 10).cast("long")


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A non-null key that orders sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def sized(docs: DataFrame) -> DataFrame:
    """The compact table on which thresholds are found: no texts."""
    return docs.select("doc_id", source_key(F.col("source")).alias("source_key"), size(F.col("text")).alias("size"),
                       key(F.col("doc_id"), F.col("text")).alias("key"))


@dataclass
class Plan:
    """One row per source: source_key, source_size, target, repeats (whole passes), threshold
    (documents below it are taken once more), and of the equal rows at the threshold how many
    there are (``copies``) and how many are taken once more (``fit``)."""

    sources: DataFrame
    n_sources: int
    row_bytes: int  # at most, with the longest source's name
    divided: bool  # whether any source takes some of its equal rows, but not all

    def join(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with source_key and key) with their source's columns and ``times``."""
        out = rows.join(bounded_broadcast(self.sources, self.n_sources, self.row_bytes), "source_key")
        at = F.col("key") == F.col("threshold")
        more = (F.col("key") < F.col("threshold")) | (at & (F.col("fit") == F.col("copies")))
        times = F.col("repeats") + F.when(more, 1).otherwise(0)
        if not self.divided:
            return out.withColumn("times", times)
        some = at & (F.col("fit") > 0) & (F.col("fit") < F.col("copies"))
        equal = stage(out.filter(some).withColumn("__place", F.monotonically_increasing_id()), "equal")
        ends = self.places(equal)
        equal = equal.join(bounded_broadcast(ends, self.n_sources, self.row_bytes), "source_key")
        equal = equal.withColumn("times", F.col("repeats") + F.when(F.col("__place") <= F.col("__end"), 1).otherwise(0))
        return out.filter(~some).withColumn("times", times).unionByName(equal.drop("__place", "__end"))

    def places(self, equal: DataFrame) -> DataFrame:
        """The place of each source's last row that fits: row numbers inside each stored
        partition, after the sizes of the partitions before it, so no task holds a whole group."""
        part = F.shiftright("__place", 33)
        rows = equal.select("source_key", "fit", "__place", part.alias("__part"))
        sizes = rows.groupBy("source_key", "__part").count()
        up_to = F.sum("count").over(W.partitionBy("source_key").orderBy("__part"))
        before = sizes.select("source_key", "__part", (up_to - F.col("count")).alias("__before"))
        inside = F.row_number().over(W.partitionBy("source_key", "__part").orderBy("__place"))
        numbered = rows.withColumn("__inside", inside).join(before, ["source_key", "__part"])
        return (numbered.filter(F.col("__before") + F.col("__inside") == F.col("fit"))
                .select("source_key", F.col("__place").alias("__end")))


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Target words per source: ``share`` of all words dealt by weight; no target above
    ``most`` times its source, the excess dealt again by weight until none is above."""
    level = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranks = stage(ranked(sizes, F.col("source_key")).withColumn("weight", level), "sources")
    cap = most * F.col("source_size")
    total = ranks.agg(F.sum("source_size")).first()[0] or 0
    per_weight, n_capped = 0.0, -1
    while True:  # each pass caps at least one more source or ends
        over = cap < F.col("weight") * F.lit(per_weight)
        capped, weight, n = ranks.agg(F.sum(F.when(over, F.col("source_size"))), F.sum(F.when(~over, F.col("weight"))),
                                      F.count(F.when(over, 1))).first()
        if n == n_capped or not weight:
            break
        n_capped = n
        per_weight = (share * total - most * (capped or 0)) / weight
    return ranks.withColumn("target", F.when(over, cap.cast("double")).otherwise(F.col("weight") * F.lit(per_weight)))


def plan(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> Plan:
    """Targets and thresholds for a stored ``sized`` table.

    Whole passes come first; of the words that are left, documents are taken in order of
    their keys as long as more than half of the next one still fits, so a source's words
    differ from its target by at most half of one document.
    """
    goal = targets(rows.groupBy("source_key").agg(F.sum("size").alias("source_size")), weights, share, most)
    goal = goal.withColumn("repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("long"))
    goal = stage(goal.withColumn("left", F.col("target") - F.col("repeats") * F.col("source_size")), "targets")
    n, longest = goal.agg(F.count("*"), F.max(F.octet_length("source_key"))).first()
    row_bytes = 64 + (longest or 0)
    found, open_ = [], goal.select("source_key", "left", F.lit(0).cast("double").alias("before"), F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        inside = rows.withColumn("bucket", F.shiftright("key", shift))
        if level:
            inside = inside.withColumn("prefix", F.shiftright("key", shift + LEVEL_BITS))
            inside = inside.join(bounded_broadcast(open_.select("source_key", "prefix"), n, row_bytes), ["source_key", "prefix"], "left_semi")
        hist = inside.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("copies"),
                                                             F.min("key").alias("low"), F.max("key").alias("high"))
        up_to = F.sum("words").over(W.partitionBy("source_key").orderBy("bucket"))
        hist = hist.join(open_, "source_key").withColumn("start", F.col("before") + up_to - F.col("words"))
        # The boundary bucket is the last one that starts within the budget.
        edge = hist.filter(F.col("start") <= F.col("left")).groupBy("source_key").agg(
            F.max_by(F.struct("bucket", "start", "words", "copies", "low", "high", "left"), "bucket").alias("b")).select("source_key", "b.*")
        edge = stage(edge, "edge")
        single = F.col("low") == F.col("high")
        # Equal rows have equal sizes: the j-th fits if more than half of it is still wanted.
        each = F.col("words") / F.col("copies")
        fit = F.ceil((2 * (F.col("left") - F.col("start")) - each) / F.nullif(2 * each, F.lit(0.0)))
        fit = F.least(F.greatest(F.coalesce(fit, F.when(F.col("start") < F.col("left"), F.col("copies")).otherwise(0)), F.lit(0)), F.col("copies"))
        found.append(edge.filter(single).select("source_key", F.col("low").alias("threshold"), "copies", fit.cast("long").alias("fit")))
        open_ = edge.filter(~single).select("source_key", "left", F.col("start").alias("before"), F.col("bucket").alias("prefix"))
        if open_.isEmpty():
            break
    ends = found[0]
    for more in found[1:]:
        ends = ends.unionByName(more)
    filled = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("threshold", "copies", "fit")]
    made = stage(goal.join(ends, "source_key", "left").select("source_key", "source_size", "target", "repeats", *filled), "mix")
    return Plan(made, n, row_bytes, not made.filter((F.col("fit") > 0) & (F.col("fit") < F.col("copies"))).isEmpty())


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: ``docs`` with each row as many times as the mix takes it."""
    made = plan(stage(sized(docs), "sized"), **how)
    cols = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), source_key(F.col("source")).alias("source_key"),
                       key(F.col("doc_id"), F.col("text")).alias("key"))
    return (made.join(rows).filter(F.col("times") > 0)
            .select("__row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("__time")).select("__row.*"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(sized(table(spark, sf_dir, "documents")), "sized")
    return plan(rows).join(rows).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


#: Keys, targets and thresholds in SQL: the capped sources are the shortest prefix, by size
#: over weight, after which nobody is above the cap.
OP2_SQL = """
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS k
  FROM documents),
s AS (
  SELECT sk, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY encode(sk)) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY sk),
p AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w, sk) AS n,
    coalesce(sum(source_size) OVER (ORDER BY source_size / w, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(w) OVER (ORDER BY source_size / w, sk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
    sum(source_size) OVER () AS total
  FROM s),
l AS (
  SELECT (1.5::DOUBLE * total::DOUBLE - 2::DOUBLE * capped::DOUBLE) / rest::DOUBLE AS per_weight
  FROM p WHERE 2 * source_size >= w * ((1.5::DOUBLE * total::DOUBLE - 2::DOUBLE * capped::DOUBLE) / rest::DOUBLE)
  ORDER BY n LIMIT 1),
t AS (
  SELECT sk, source_size, CASE WHEN 2 * source_size < w * per_weight THEN (2 * source_size)::DOUBLE ELSE w * per_weight END AS target
  FROM p, l),
r AS (
  SELECT sk, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS repeats
  FROM t),
n AS (SELECT *, row_number() OVER (PARTITION BY sk, k) AS j FROM d),
g AS (SELECT sk, k, sum(size) AS words FROM d GROUP BY sk, k),
c AS (SELECT sk, k, sum(words) OVER (PARTITION BY sk ORDER BY k) - words AS start FROM g)
SELECT n.doc_id, n.size, r.source_size, r.target,
  (n.size * (r.repeats + CASE WHEN 2 * c.start + (2 * n.j - 1) * n.size < 2 * (r.target - r.repeats * r.source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM n JOIN r USING (sk) JOIN c ON c.sk = n.sk AND c.k = n.k
"""
