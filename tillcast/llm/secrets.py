"""Operator 13 [native]: secrets judged by who has them, in DataFrame functions only.

Base patterns give the spans of each text: assignments to a telling name, access key ids and
long runs of hexadecimal digits. Long runs of token characters are candidates too. The value of
every candidate is hashed, and over the whole corpus it is counted in how many distinct
repositories and by how many distinct owners it occurs. A value that ``OWNERS`` or more owners
have is ``copied``: an example of a manual, a fixture, a license. One that fewer have and that
looks live (long, letters and digits, many different characters, no placeholder word) is
``owned``; anything else is ``weak``. Base spans stay whatever their verdict; the method adds
the candidates that are ``owned`` and touch no base span, as kind ``token``.

Positions come without a Python worker: the pieces between a pattern's matches (``split``) and
the matches themselves add up to the text, so running sums of their lengths are the positions.
Only texts that a pattern hits are cut up.

``documents`` has no repositories: a document (doc_id) stands for one, its source for the owner.
Counts are taken step by step over (value, owner, repository), (value, owner) and (value), each
combined before its shuffle, so a value that a third of all rows hold meets no single task.

Defined results: a null text is empty; the matches of a kind do not overlap, those of different
kinds may; a null source is one owner, null ids of a source are one repository; repeated rows are
scanned each, and count once as the same repository; a text without spans has an empty list and
the hash of the empty text; very long texts are scanned whole; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import running_sum, table
from tillcast.session import stage

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind, pattern, and the group that holds the value. The order is that of the list of spans.
BASE = (("assign", ASSIGN, 2), ("access", r"AKIA[A-Z0-9]+", 0), ("hex", r"[0-9a-f]{24,}", 0))
LEAST = {"assign": 6, "access": 20, "hex": 24}
ADDED = "token"
TOKEN, TOKEN_LEAST = r"[A-Za-z0-9+/_=-]{20,}", 20
OWNERS = 3
LIVE_LEAST, LIVE_DISTINCT = 16, 8
PLACEHOLDER = "(?i)example|sample|changeme|placeholder|dummy|your|xxxx|0000|1234"
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def matches(text: Column, kind: str, rank: int, pattern: str, group: int, least: int) -> Column:
    """The matches of ``pattern`` whose value has ``least`` characters, as an array of SPAN."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    lengths = F.transform(found, F.char_length)
    # A match ends where all pieces and matches up to it do.
    ends = running_sum(F.zip_with(F.slice(gaps, 1, F.size(found)), lengths, lambda g, n: g + n))
    rows = F.filter(F.arrays_zip(ends.alias("end"), found.alias("match"), values.alias("value")), lambda m: F.char_length(m["value"]) >= least)
    spans = F.transform(rows, lambda m: F.struct((m["end"] - F.char_length(m["match"])).alias("start"), F.lit(rank).alias("rank"),
                                                 F.lit(kind).alias("kind"), m["end"].alias("end"), m["value"].alias("value")))
    return F.when(text.rlike(pattern), spans.cast(SPAN))


def scan(docs: DataFrame) -> DataFrame:
    """uid, doc_id, owner, repository, ``base`` and ``extra``: the spans of the base patterns in
    order, and the token runs that touch none of them. Stored: one pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    kinds = [(kind, pattern, group, LEAST[kind]) for kind, pattern, group in BASE] + [(ADDED, TOKEN, 0, TOKEN_LEAST)]
    owner = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
    rows = docs.select("doc_id", owner.alias("owner"), *[matches(text, k, i, *how).alias(f"__{k}") for i, (k, *how) in enumerate(kinds)])
    held = lambda k: F.coalesce(F.col(f"__{k}"), F.array().cast(SPAN))
    rows = rows.select("doc_id", "owner", F.array_sort(F.concat(*[held(k) for k, *_ in kinds[:-1]])).alias("base"), held(ADDED).alias("extra"))
    apart = lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    rows = rows.withColumn("extra", F.filter("extra", apart)).withColumn("uid", F.monotonically_increasing_id())
    return stage(rows, "scanned")


def looks_live(value: Column) -> Column:
    return ((F.char_length(value) >= LIVE_LEAST) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER)
            & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_DISTINCT))


def ownership(candidates: DataFrame, owners: int = OWNERS) -> DataFrame:
    """Per value_hash of ``candidates`` (value_hash, live, owner, repository): n_found, n_repositories,
    n_owners and the verdict."""
    found = candidates.groupBy("value_hash", "live", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = found.groupBy("value_hash", "live", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("r"))
    held = by_owner.groupBy("value_hash", "live").agg(F.sum("n").alias("n_found"), F.sum("r").alias("n_repositories"), F.count("*").alias("n_owners"))
    verdict = F.when(F.col("n_owners") >= owners, "copied").when(F.col("live"), "owned").otherwise("weak")
    return held.select("value_hash", "n_found", "n_repositories", "n_owners", verdict.alias("verdict"))


def candidates(scanned: DataFrame) -> DataFrame:
    """One row per candidate of a ``scan``: uid, its span, value_hash, live, owner and repository."""
    rows = scanned.select("uid", "doc_id", "owner", F.explode(F.concat("base", "extra")).alias("span")).select("uid", "doc_id", "owner", "span.*")
    return rows.select("uid", "start", "rank", "kind", "end", F.sha2("value", 256).alias("value_hash"), looks_live(F.col("value")).alias("live"),
                       "owner", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("repository"))


def listed(spans: Column, *more: str) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"), *[s[m] for m in more])
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def find_secrets(docs: DataFrame, owners: int = OWNERS) -> DataFrame:
    """Per row of ``docs``: counts and digest of the base spans, all spans, and all with their verdicts."""
    scanned = scan(docs)
    each = stage(candidates(scanned), "candidates")
    # Both sides of this join are stored, so a value that many hold is a skewed join, which Spark splits.
    judged = each.join(stage(ownership(each, owners), "owners"), "value_hash")
    judged = judged.filter((F.col("kind") != ADDED) | (F.col("verdict") == "owned"))
    spans = judged.groupBy("uid").agg(F.collect_list(F.struct("start", "rank", "kind", "end", "verdict")).alias("spans"))
    count = lambda c, what: F.coalesce(F.size(F.filter(c, what)), F.lit(0)).cast("long")
    of = lambda kind: count("base", lambda s: s["kind"] == kind).alias(f"n_{kind}")
    said = lambda v: count("spans", lambda s: s["verdict"] == v).alias(f"n_{v}")
    return scanned.join(spans, "uid", "left").select(
        "doc_id", *[of(kind) for kind, *_ in BASE], F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(listed(F.col("spans")), F.lit("")).alias("spans"), *[said(v) for v in ("owned", "copied", "weak")],
        F.coalesce(listed(F.col("spans"), "verdict"), F.lit("")).alias("verdicts"))


def op13_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


#: The same patterns (RE2 folds more letters than ASCII, so the names are spelt out) and counts.
OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text, coalesce('+' || source, '-') AS owner FROM documents),
k(rank, kind, re, grp, least) AS (VALUES
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', '(AKIA[A-Z0-9]+)', 1, 20), (2, 'hex', '([0-9a-f]{24,})', 1, 24), (3, 'token', '([A-Za-z0-9+/_=-]{20,})', 1, 20)),
r AS (
  SELECT uid, rank, kind, least, regexp_extract_all(text, re) AS found, regexp_extract_all(text, re, grp) AS vals, string_split_regex(text, re) AS pieces
  FROM d, k),
m AS (
  SELECT uid, rank, kind, least, unnest(found) AS whole, unnest(vals) AS value, unnest(range(1, len(found) + 1)) AS i, pieces, found FROM r),
s AS (
  SELECT uid, rank, kind, value, start, start + length(whole) AS stop FROM (
    SELECT *, (list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
    FROM m) WHERE length(value) >= least),
c AS (
  SELECT s.*, d.owner, coalesce(d.doc_id::VARCHAR, '') AS repository,
    length(value) >= 16 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
      AND NOT regexp_matches(value, '(?i)example|sample|changeme|placeholder|dummy|your|xxxx|0000|1234') AND len(list_distinct(string_split(value, ''))) >= 8 AS live
  FROM s JOIN d USING (uid)
  WHERE kind <> 'token' OR NOT EXISTS (SELECT 1 FROM s b WHERE b.uid = s.uid AND b.kind <> 'token' AND b.start < s.stop AND s.start < b.stop)),
o AS (SELECT value, count(DISTINCT owner) AS owners FROM c GROUP BY value),
j AS (
  SELECT c.*, CASE WHEN o.owners >= 3 THEN 'copied' WHEN live THEN 'owned' ELSE 'weak' END AS verdict FROM c JOIN o USING (value)),
a AS (
  SELECT uid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind <> 'token'), '') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
    count(*) FILTER (verdict = 'owned') AS n_owned, count(*) FILTER (verdict = 'copied') AS n_copied, count(*) FILTER (verdict = 'weak') AS n_weak,
    string_agg(kind || ':' || start || ':' || stop || ':' || verdict, ',' ORDER BY start, rank) AS verdicts
  FROM j WHERE kind <> 'token' OR verdict = 'owned' GROUP BY uid)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned, coalesce(n_copied, 0) AS n_copied, coalesce(n_weak, 0) AS n_weak, coalesce(verdicts, '') AS verdicts
FROM d LEFT JOIN a USING (uid)
"""
