"""Operator 12: how filters interact, from one stored id table per filter.

Each filter's failing rows are a relation of row ids, stored once. For every set of filters
that an order can begin with, left-anti joins with these relations leave the survivors; a
left-semi join of the survivors with the next filter's relation gives what it removes; a
left-semi join of the filter's own relation with those of the set gives what it would have
removed but came too late for (redundant). Documents that fail nothing survive every set, so
they are counted and not joined.

All sets are joined in one plan: the ids are dealt out once by id, each row is then repeated
for the sets (within its task, after the shuffle), and the join's condition picks the filters
of the set. Orders only read the counts of their sets, so 120 orders cost 32 sets.

Defined results: a null text is empty, a null lang is the part ''; a row is its own document,
also if its doc_id is null or repeated; "identical to a smaller doc_id's text" is never true of
or by a null doc_id and not true of a repeated row (its id is not smaller); a document is good
(toxic) if any row of labels with its id says so; an empty table has no parts and no rows.
Very long texts are counted whole. Extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import WORD, table
from tillcast.session import stage

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def rules(text: Column) -> dict[str, Column]:
    """The filters that a text decides alone, by letter: true if it fails."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    chars = F.char_length(text)
    capitals = chars - F.char_length(F.translate(text, CAPITALS, ""))
    return {"A": F.regexp_count(text, F.lit(WORD)) < MIN_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
            "C": 100 * capitals > MAX_CAPITALS * chars,
            "D": text.rlike(r"[#$%&*|]")}


def repeats_a_smaller_id(rows: DataFrame) -> DataFrame:
    """The ``uid`` of rows (uid, doc_id, text_key) whose text a smaller doc_id has too."""
    # Only texts with two ids are stored, and stored so that a text with a third of all rows
    # is a skewed join, which Spark splits, and not a skewed aggregate.
    first = rows.groupBy("text_key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = stage(first.filter("first < last").select("text_key", "first"), "first_ids")
    return rows.join(first, "text_key").filter("doc_id > first").select("uid")


def audit(rows: DataFrame, failing: dict[str, DataFrame], orders: list[str]) -> DataFrame:
    """Counts per part, order and step. ``rows``: stored (uid, part, good, toxic), uid unique;
    ``failing``: per filter letter the stored table of failing ``uid``."""
    bit = {f: 1 << i for i, f in enumerate(failing)}
    every = (1 << len(bit)) - 1
    fails = None
    for f, ids in failing.items():
        one = ids.select("uid", F.lit(bit[f]).alias("filter"))
        fails = one if fails is None else fails.unionByName(one)
    # Hash joins keep the repeated rows unsorted; the side that is hashed is one partition's ids.
    right = fails.select(F.col("uid").alias("other"), F.col("filter").alias("by")).hint("shuffle_hash")
    same = F.col("uid") == F.col("other")
    in_set = F.col("set").bitwiseAND(F.col("by")) != 0
    numbers = lambda lo: F.explode(F.lit(list(range(lo, every + 1)))).alias("set")
    bits = F.lit(list(bit.values()))

    touched = rows.repartition("uid").join(right, same, "left_semi")
    sets = touched.select("*", numbers(0))
    survivors = sets.join(right, same & in_set, "left_anti")
    ahead = survivors.select("*", F.explode(F.filter(bits, lambda b: F.col("set").bitwiseAND(b) == 0)).alias("filter"))
    removed = ahead.join(right, same & (F.col("filter") == F.col("by")), "left_semi")
    owned = fails.repartition("uid").join(rows.select("uid", "part").hint("shuffle_hash"), "uid")
    late = (owned.select("*", numbers(1)).filter(F.col("set").bitwiseAND(F.col("filter")) == 0).join(right, same & in_set, "left_semi"))

    count = lambda what: F.sum(F.col(what).cast("long"))
    totals = rows.groupBy("part").agg(F.count("*").alias("total"))
    hit = touched.groupBy("part").agg(F.count("*").alias("hit"))
    kept = survivors.groupBy("part", "set").agg(F.count("*").alias("left"))
    gone = removed.groupBy("part", "set", "filter").agg(F.count("*").alias("removed"), count("good").alias("good_lost"), count("toxic").alias("toxic_lost"))
    spare = late.groupBy("part", "set", "filter").agg(F.count("*").alias("redundant"))
    gone, parts = stage(gone, "removed"), stage(totals.join(hit, "part", "left"), "parts")
    # A set of s of k filters comes before a filter in s! (k - s - 1)! of the k! orders.
    k = len(bit)
    ways = F.lit([math.factorial(s) * math.factorial(k - s - 1) if s < k else 0 for s in range(k + 1)])
    values = gone.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * F.get(ways, F.bit_count("set"))).cast("long").alias("shapley"),
        F.sum(F.when(F.col("set") + F.col("filter") == every, F.col("removed"))).alias("unique_fails"))

    steps = [{"filter_order": o, "step": i + 1, "set": sum(bit[f] for f in o[:i]), "filter": bit[o[i]]} for o in orders for i in range(len(o))]
    step = F.explode(F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,set:int,filter:int>>"))
    grid = parts.select("part", "total", F.coalesce("hit", F.lit(0)).alias("hit"), step.alias("s")).select("part", "total", "hit", "s.*")
    grid = grid.withColumn("after", F.col("set") + F.col("filter"))
    out = (grid.join(gone, ["part", "set", "filter"], "left").join(spare, ["part", "set", "filter"], "left").join(values, ["part", "filter"], "left")
           .join(kept.withColumnRenamed("set", "after"), ["part", "after"], "left"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("part", "filter_order", "step", (F.col("total") - F.col("hit") + F.coalesce("left", F.lit(0))).cast("long").alias("kept"),
                      *map(zero, ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")))


def label_flags(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic: one row per labelled id."""
    says = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    return stage(labels.filter("doc_id is not null").groupBy("doc_id").agg(says("quality").alias("good"), says("toxic").alias("toxic")), "labelled")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over ``docs``, in all orders."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text.cast("binary"), 256).alias("text_key"),
                       *[rule.alias(f) for f, rule in rules(text).items()])
    base = stage(base.withColumn("uid", F.monotonically_increasing_id()), "judged")  # stored, so an id stays a row's
    failing = {f: stage(base.filter(F.col(f)).select("uid"), f"failing_{f}") for f in "ABCD"}
    failing["E"] = stage(repeats_a_smaller_id(base.select("uid", "doc_id", "text_key")), "failing_E")
    known = F.lit(False)
    rows = base.select("uid", "doc_id", "part").join(label_flags(labels), "doc_id", "left").select(
        "uid", "part", F.coalesce("good", known).alias("good"), F.coalesce("toxic", known).alias("toxic"))
    return audit(stage(rows, "audited"), failing, ["".join(p) for p in permutations(FILTERS)])


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: By failure patterns: a document is removed at the first filter of the order that it fails.
OP12_SQL = r"""
WITH l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
d AS (
  SELECT t.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
    len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS e
  FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
p AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS failed,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM d GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT v.f || w.f || x.f || y.f || z.f AS filter_order FROM f v, f w, f x, f y, f z
  WHERE len(list_distinct([v.f, w.f, x.f, y.f, z.f])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM o),
g AS (
  SELECT part, filter_order, step,
    coalesce(sum(n) FILTER (NOT regexp_matches(failed, '[' || substr(filter_order, 1, step) || ']')), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (mine AND NOT gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failed = letter), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (gone), 0)::BIGINT AS toxic_lost
  FROM (
    SELECT *, contains(failed, letter) AS mine,
      contains(failed, letter) AND (step = 1 OR NOT regexp_matches(failed, '[' || substr(filter_order, 1, greatest(step - 1, 1)) || ']')) AS gone
    FROM (SELECT p.*, s.*, substr(filter_order, step, 1) AS letter FROM p, s))
  GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1))::BIGINT AS shapley
FROM g
"""
