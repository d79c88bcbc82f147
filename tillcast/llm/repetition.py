"""Operator 6: quality rules with repeated substrings from a suffix array.

Texts are sequences of words. A chunk of whole texts is sorted at once: prefix doubling
ranks the suffixes of every text by 1, 2, 4, ... words, going on only with those that are
still tied, until all differ. The kept ranks of each step give the longest common prefix
of neighbours in the suffix array. A run of neighbours whose common prefix is at least m
words is an LCP interval; the deepest interval of a suffix is the longest repeated substring
that starts there, and the union of these spans is what maximal repeats cover.

Verdict: a text fails if repeats of ``min_words`` or more cover more than ``max_covered`` of
its words, or if its longest repeat has more than ``max_longest`` words and is over
``max_longest_share`` of them. ``base_failed`` is the contract's plain rule.

Defined results: a null or empty text has all counts 0 and fails by its length; equal rows
get equal rows; a null doc_id is kept; an empty table gives no rows. The work and memory of a
text are n log n in its words. Other columns pass through ``filter_repetition`` unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tillcast.llm.common import byte_chunks, table

#: The word breaks and the symbols that are counted.
SPACES = np.array([0x20, *range(0x09, 0x0E)])
SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)

BASE_WINDOW, MIN_WORDS, MAX_COVERED, MAX_LONGEST, MAX_LONGEST_SHARE = 8, 5, 0.3, 50, 0.15


def repeat_lengths(words: np.ndarray, text: np.ndarray, end: np.ndarray, least: int) -> np.ndarray:
    """For each position the length of the longest substring from there that occurs again in
    its text, 0 if it is shorter than ``least``. ``text``: the number of the position's text,
    ascending; ``end``: where that text ends."""
    n = len(words)
    repeats = np.zeros(n, dtype=np.int64)
    if n < 2:
        return repeats
    key = text * (int(words.max()) + 1) + words
    rank, tied = np.zeros(n, dtype=np.int64), np.arange(n)
    steps, width = [], 0
    while True:
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        fresh = np.empty(len(key), dtype=bool)
        fresh[0], fresh[1:] = True, key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))  # of the new group
        old = rank[tied]
        lead = np.empty(len(key), dtype=bool)
        lead[0], lead[1:] = True, old[1:] != old[:-1]
        base = np.maximum.accumulate(np.where(lead, np.arange(len(key)), 0))  # of the old group
        rank = rank.copy()
        rank[tied] = old + first - base
        steps.append(rank)
        single = fresh & np.append(fresh[1:], True)
        tied = tied[~single]
        if not len(tied):
            break
        width = 2 * width or 1
        after = tied + width
        inside = after < end[tied]
        key = rank[tied] * (n + 1) + np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[rank] = np.arange(n)
    # Neighbours that share the largest power of two up to ``least`` words can have such a prefix.
    near = min(int(least).bit_length() - 1, len(steps) - 1)
    a, b = suffixes[:-1], suffixes[1:]
    at = np.flatnonzero(steps[near][a] == steps[near][b])
    a, b, common = a[at], b[at], np.zeros(len(at), dtype=np.int64)
    for i in range(len(steps) - 1, -1, -1):
        p, q = a + common, b + common
        same = (p < end[a]) & (q < end[b])
        same &= steps[i][np.minimum(p, n - 1)] == steps[i][np.minimum(q, n - 1)]
        common += same << i
    common[common < least] = 0
    np.maximum.at(repeats, a, common)
    np.maximum.at(repeats, b, common)
    return repeats


def covered_by(repeats: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a repeat of ``least`` words or more."""
    from_ = np.flatnonzero(repeats >= least)
    edges = np.zeros(len(repeats) + 1, dtype=np.int64)
    edges[from_] += 1
    np.subtract.at(edges, from_ + repeats[from_], 1)
    return np.cumsum(edges[:-1]) > 0


def spans(covered: np.ndarray) -> list[tuple[int, int]]:
    """The runs of covered positions: (first, length)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


RESULT = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                    ("n_repeat_words", pa.int64()), ("covered_words", pa.int64()), ("longest_repeat", pa.int64()),
                    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("length", pa.int64())])))])
RESULT_DDL = ("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,covered_words:long,"
              "longest_repeat:long,spans:array<struct<first:long,length:long>>>")


def measure(texts: list[bytes], min_words: int) -> list[dict]:
    split = [t.split() for t in texts]
    counts = np.array([len(s) for s in split], dtype=np.int64)
    ids = {w: i for i, w in enumerate({w for s in split for w in s})}
    words = np.fromiter((ids[w] for s in split for w in s), dtype=np.int64, count=int(counts.sum()))
    number, ends = np.repeat(np.arange(len(texts)), counts), np.cumsum(counts)
    repeats = repeat_lengths(words, number, np.repeat(ends, counts), min(min_words, BASE_WINDOW))
    base, cover = covered_by(repeats, BASE_WINDOW), covered_by(repeats, min_words)
    rows = []
    for i, text in enumerate(texts):
        own = slice(ends[i] - counts[i], ends[i])
        by_byte = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
        lines = [line for line in text.split(b"\n") if line.strip()]
        longest = int(repeats[own].max(initial=0))
        rows.append({
            "n_words": int(counts[i]), "word_chars": int(len(text) - by_byte[0x80:0xC0].sum() - by_byte[SPACES].sum()),
            "n_symbols": int(by_byte[SYMBOLS].sum()), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": int(base[own].sum()), "covered_words": int(cover[own].sum()),
            "longest_repeat": longest if longest >= min_words else 0,
            "spans": [{"first": a, "length": b} for a, b in spans(cover[own])]})
    return rows


def repetition(text: Column, min_words: int = MIN_WORDS) -> Column:
    """The counts and the spans of repeats of a whole text, as a struct."""

    @arrow_udf(RESULT_DDL)
    def counted(texts: pa.Array) -> pa.Array:
        rows = []
        for _, chunk in byte_chunks(texts):
            rows += measure(chunk, min_words)
        return pa.array(rows, RESULT)

    return counted(text)


def verdict(r: Column, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST,
            max_longest_share: float = MAX_LONGEST_SHARE) -> tuple[Column, Column]:
    """(base_failed, kept) of a ``repetition`` struct."""
    n = r["n_words"]
    base_failed = (n < 20) | (100 * r["n_repeat_words"] > 30 * n)
    longest = (r["longest_repeat"] > max_longest) & (r["longest_repeat"] > max_longest_share * n)
    return base_failed, ~base_failed & (r["covered_words"] <= max_covered * n) & ~longest


def filter_repetition(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*cols).alias("__row"), repetition(F.col("text")).alias("__found"))
    return rows.filter(verdict(F.col("__found"), **limits)[1]).select("__row.*")


def op6_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", repetition(F.col("text")).alias("r"))
    base_failed, kept = verdict(F.col("r"))
    return found.select("doc_id", "r.n_words", "r.word_chars", "r.n_symbols", "r.n_dup_lines", "r.n_repeat_words",
                        base_failed.alias("base_failed"), kept.alias("kept"), "r.covered_words", "r.longest_repeat", "r.spans")
