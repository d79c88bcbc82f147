"""Operator 10 [native]: document fingerprints by winnowing, in DataFrame functions only.

Each code point is hashed; the polynomial (Karp-Rabin) hash of every run of ``GRAM`` code points, base 2
and modulo a prime, is rolled up by doubling: a hash of two runs comes from theirs. A gram belongs to
its last code point; the first ones of a text have fewer code points. Its hash is the polynomial's
complement to the prime. In each window of ``WINDOW`` neighbouring grams the least hash is chosen, the
rightmost of equal ones. A gram is packed as complement * 2^32 + position, so one maximum settles both. A
text of at most 2 * ``WINDOW`` code points keeps all its grams. Guarantee: two texts that share a run of ``GRAM + WINDOW - 1`` code points
share a chosen hash, and so do two that share their first ``WINDOW``: a copy that keeps the
first half of a text that is not empty is always found.

A text is fingerprinted once, where it is read. Choices are local, so the edited text (a document's
first half and the start of the next one's) takes the choices of both documents and only the two
seams - around the join and at the cut end - are hashed again. Only a document's text and choices
travel to the one before it.

The next document by doc_id comes from a window over ranges of (doc_id, hash of the text), each
range with the first document of the next one added, so no task sorts the whole table and equal ids
spread. Ranges are cut so that one holds about ``RANGE_BYTES`` of text.

Defined results: a null text is empty; an empty text has the empty fingerprint, and two of those have
likeness 1; documents are ordered by doc_id, null first, then the text's hash; a sole document is its
own next; repeated rows stay; very long texts are fingerprinted whole; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillcast.llm.common import table

GRAM, WINDOW = 16, 32  # powers of two
PRIME = (1 << 31) - 1
POSITIONS = (1 << 32) - 1
RANGE_BYTES = 64 << 20


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def grown(a: Column, width: int, join) -> Column:
    """For each place of the bigint array ``a`` all of the ``width`` entries that end there in one, by
    doubling: ``join`` takes those of a run, of the run behind it, and the latter's length. Before the
    first place are zeros; ``width`` - 1 places without meaning follow the last one. ``a`` is computed once."""
    def step(runs: Column, by: int) -> Column:
        if by == width:
            return runs
        before = F.concat(F.array_repeat(F.lit(0).cast("bigint"), by), runs)
        return let(F.zip_with(before, runs, lambda x, y: join(x, y, by)), lambda r: step(r, 2 * by))

    return let(a, lambda runs: step(runs, 1))


def choices(text: Column, skip: Column | None = None, at: Column | None = None, whole: Column | None = None) -> Column:
    """The packed chosen grams of a text. The first ``skip`` grams are context only, the first one
    after them has position ``at``; if ``whole``, all are kept."""
    skip, n = F.lit(0) if skip is None else skip, F.char_length(text)
    points = F.transform(F.split(text, ""), lambda p: F.crc32(p.cast("binary")))
    place = lambda i: i.cast("bigint") if at is None else i + at.cast("bigint")

    def chosen(packed: Column) -> Column:
        keep_all = F.size(packed) <= 2 * WINDOW if whole is None else whole
        # The first window that is whole ends at gram ``WINDOW``; no packed gram is below the zeros.
        first = F.greatest(F.least(F.size(packed), F.lit(WINDOW)), F.lit(1))
        highest = grown(packed, WINDOW, lambda x, y, by: F.greatest(x, y))
        return F.when(keep_all, packed).otherwise(F.array_distinct(F.slice(highest, first, F.size(packed) - first + 1)))

    polynomials = grown(points, GRAM, lambda x, y, by: F.shiftleft(x, by) + y)
    packed = lambda g: F.transform(F.slice(g, skip + 1, n - skip), lambda x, i: F.shiftleft(x % PRIME, 32).bitwiseOR(place(i)))
    return let(let(polynomials, packed), chosen)


def between(packed: Column, low: Column, high: Column) -> Column:
    """The choices at positions from ``low`` to ``high``."""
    return F.filter(packed, lambda x: x.bitwiseAND(F.lit(POSITIONS)).between(low, high))


def hashes(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda x: F.shiftright(x, 32)))


def printed(packed: Column) -> Column:
    """By position, each choice in hexadecimal digits: the last eight are the position, those before
    them the hash's complement."""
    return F.array_join(F.transform(packed, F.hex), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def range_of(id_: Column, mark: Column, ids: Column, marks: Column, n: int) -> Column:
    """The last of ``n`` sorted bounds (``ids``, ``marks``) that is not above (id, mark): a binary
    search. The first bound is the least of all keys."""
    widths = [1 << i for i in range(n.bit_length() - 1, -1, -1)]

    def step(at: Column, width: Column) -> Column:
        to = at + width
        i = F.least(to, F.lit(n - 1))
        below = (F.get(ids, i) < id_) | ((F.get(ids, i) == id_) & (F.get(marks, i) <= mark))
        return F.when((to < n) & below, to).otherwise(at)

    return F.aggregate(F.lit(widths), F.lit(0), step)


def with_next(rows: DataFrame, bounds: list[tuple[int, int]]) -> tuple[DataFrame, W]:
    """``rows`` dealt into the ranges of ``bounds``, and the window whose next row is the next
    document; rows with ``ghost`` only serve as the next of their range's last document."""
    n = len(bounds)
    ids, marks = (F.lit([b[i] for b in bounds]).cast("array<bigint>") for i in (0, 1))
    rows = rows.withColumn("range", range_of(F.col("id"), F.col("mark"), ids, marks, n))
    first = (F.get(ids, F.col("range")) == F.col("id")) & (F.get(marks, F.col("range")) == F.col("mark"))
    place = lambda r, ghost: F.struct(r.alias("range"), F.lit(ghost).alias("ghost"))
    own, before = place(F.col("range"), False), place((F.col("range") + n - 1) % n, True)
    rows = rows.withColumn("place", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own)))).drop("range")
    return rows.select("*", "place.*").drop("place"), W.partitionBy("range").orderBy("ghost", "id", "mark")


def range_bounds(keys: DataFrame) -> list[tuple[int, int]]:
    """The least (id, mark) of each range of ``keys`` (id, mark, size), ranges of about
    ``RANGE_BYTES``: as many rows reach the driver as there are ranges."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(parts, -(-(keys.agg(F.sum("size")).first()[0] or 0) // RANGE_BYTES))
    dealt = keys.select("id", "mark").repartitionByRange(n, "id", "mark").withColumn("part", F.spark_partition_id())
    return sorted(tuple(r.low) for r in dealt.groupBy("part").agg(F.min(F.struct("id", "mark")).alias("low")).collect())


def with_edited(rows: DataFrame) -> DataFrame:
    """``rows`` (text, own, next_text, next_own) with ``edited`` and its choices ``changed``."""
    a, b, m = F.col("a"), F.col("b"), F.col("m")
    rows = rows.withColumn("n_chars", F.char_length("text")).withColumn("b", F.floor(F.col("n_chars") / 2).cast("int"))
    rows = rows.withColumn("a", F.col("n_chars") - F.col("b"))
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), a), F.substring(F.col("next_text"), F.lit(1), b)))
    rows = rows.withColumn("m", F.char_length("edited")).withColumn("b", m - a)
    short = m <= 2 * WINDOW  # keeps all grams: the first seam is all of it
    # Windows that lie in the kept part, or in the borrowed part after its first grams, choose as in
    # their documents. All others lie in one of two stretches of grams.
    stretches = ((F.when(short, 0).otherwise(F.greatest(F.lit(0), a - 2 * WINDOW + 2)), F.least(m, a + GRAM + 2 * WINDOW - 3)),
                 (F.greatest(F.lit(0), m - 2 * WINDOW + 2), m))
    for name, (low, end) in zip(("join", "tail"), stretches, strict=True):
        rows = rows.withColumn("low", low).withColumn("skip", F.least(F.col("low"), F.lit(GRAM - 1)))
        start = F.col("low") - F.col("skip")
        rows = rows.withColumn("seam", F.substring(F.col("edited"), start + 1, end - start))
        rows = rows.withColumn(name, choices(F.col("seam"), F.col("skip"), F.col("low"), short))
    inner = F.lit(GRAM + WINDOW - 2)  # where the borrowed part's own choices begin, from the join
    parts = F.concat(between(F.col("own"), F.lit(0), a - WINDOW), between(F.col("join"), a - WINDOW + 1, a + inner - 1),
                     F.transform(between(F.col("next_own"), inner, b - WINDOW), lambda x: x + a),
                     between(F.col("tail"), a + F.greatest(inner, b - WINDOW + 1), m))
    return rows.withColumn("changed", F.when(short, F.col("join")).otherwise(parts)).drop("low", "skip", "seam", "join", "tail")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likeness to it."""
    text = F.coalesce("text", F.lit(""))
    keys = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("mark")]
    bounds = range_bounds(docs.select(*keys, F.octet_length(text).alias("size"))) or [(0, 0)]
    rows, window = with_next(docs.select("doc_id", text.alias("text"), *keys, choices(text).alias("own")), bounds)
    rows = rows.withColumn("next_text", F.lead("text").over(window)).withColumn("next_own", F.lead("own").over(window))
    rows = with_edited(rows.filter("not ghost").drop("ghost", "range", "id", "mark"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("text", "next_text", "edited")
    for c in ("own", "changed", "next_own"):
        rows = rows.withColumn(f"{c}_hashes", hashes(F.col(c)))
    return rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", printed(F.col("own")).alias("fingerprint"),
                       printed(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own_hashes"), F.col("changed_hashes")).alias("near_edited"),
                       likeness(F.col("own_hashes"), F.col("next_own_hashes")).alias("near_next"))


def op10_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(table(spark, sf_dir, "documents"))
