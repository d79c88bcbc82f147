"""Operator 4: language identification with spans, by scripts and Viterbi over words.

A word (a run of letters, lower-cased) belongs to a script by the code point of its first
letter; its candidates are the languages that use the script. Each candidate scores the word
by its hashed character n-grams (1 to 4, with word boundaries) under the counts learned for
that language. Viterbi finds the best sequence of languages for the words of a text, with a
penalty for each switch, so a mixed text falls into spans and a single odd word does not
make one. The prediction is the language of most letters; the score is its share of them.

Viterbi runs over all texts of a chunk in step: word t of every text that has one. Learned on
a bounded sample: of each language about ``FIT_DOCS`` documents of at most ``FIT_CHARS``
characters, chosen by a hash of the id among those that are not held out. Prediction covers
all whole texts.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every
text if nothing was learned; a null lang or doc_id teaches nothing; words of a script that no
language uses say nothing; ties go to the language that is first by code point; equal texts
get equal rows; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tillcast.llm.common import held_out, table

#: Unicode block ranges by script (first, last code point).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)], "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)], "hebrew": [(0x590, 0x5FF)], "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)], "bengali": [(0x980, 0x9FF)], "tamil": [(0xB80, 0xBFF)], "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)], "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)], "kana": [(0x3040, 0x30FF)], "han": [(0x3400, 0x9FFF)],
}
OTHER = "other"

FIT_DOCS, FIT_CHARS, HASH_BITS, ORDERS = 3_000, 100_000, 15, (1, 2, 3, 4)
SWITCH, SMOOTH, USES_SCRIPT = 12.0, 0.5, 0.01
#: The contract's fold.
MOD, HELD_OUT = 5, 0
CHUNK_WORDS, CACHED_WORDS = 500_000, 400_000
WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def script_of(word: str) -> str:
    code = ord(word[0])
    if code < 0x250:
        return "latin"
    return next((s for s, ranges in SCRIPTS.items() if any(a <= code <= b for a, b in ranges)), OTHER)


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of words between their boundaries, and the number of the word
    that each belongs to."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    found, owners = [], []
    for n in ORDERS:
        h = np.full(max(len(codes) - n + 1, 0), n, dtype=np.uint64)
        for i in range(n):
            h = (h ^ codes[i:len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        whole = owner[:len(h)] == owner[n - 1:]
        found.append((h[whole] >> np.uint64(64 - HASH_BITS)).astype(np.int64))
        owners.append(owner[:len(h)][whole])
    return np.concatenate(found), np.concatenate(owners)


@dataclass
class Languages:
    """``names``; ``log_prior`` by language; ``log_share`` of each n-gram by (hash, language);
    ``uses`` whether a language uses a script."""

    names: list[str]
    log_prior: np.ndarray
    log_share: np.ndarray
    uses: dict[str, np.ndarray]

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row per word, one score per language, 0 for the best; languages of other
        scripts are out of the question, and a word of a script that none uses says nothing."""
        gram, owner = ngrams(words)
        own = np.stack([np.bincount(owner, weights=self.log_share[gram, i], minlength=len(words)) for i in range(len(self.names))], axis=1)
        no = np.zeros(len(self.names), dtype=bool)
        allowed = np.array([self.uses.get(script_of(w), no) for w in words])
        own = np.where(allowed, own / len(ORDERS), -1e4)
        return np.where(allowed.any(axis=1)[:, None], own - own.max(axis=1, keepdims=True), 0).astype(np.float32)


def viterbi(scores: np.ndarray, counts: np.ndarray, log_prior: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word. ``scores``: words by labels, text after text, all with
    words; ``counts``: the number of words of each text."""
    n, labels = scores.shape
    order = np.argsort(-counts, kind="stable")
    starts, lengths = (np.cumsum(counts) - counts)[order], counts[order]
    switched = np.zeros((n, labels), dtype=bool)
    source = np.zeros(n, dtype=np.int32)
    best = log_prior + scores[starts]
    # How many texts have a word t: the texts are sorted by length.
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    for t in range(1, int(lengths[0])):
        at = starts[:active[t]] + t
        held = best[:active[t]]
        top = held.argmax(axis=1)
        jump = held[np.arange(len(held)), top][:, None] - switch
        change = jump > held
        switched[at], source[at] = change, top
        best[:active[t]] = np.where(change, jump, held) + scores[at]
    path = np.zeros(n, dtype=np.int32)
    state = best.argmax(axis=1)
    for t in range(int(lengths[0]) - 1, 0, -1):
        at, now = starts[:active[t]] + t, state[:active[t]]
        path[at] = now
        state[:active[t]] = np.where(switched[at, now], source[at], now)
    path[starts] = state
    return path


def labelled(texts: list[str | None], model: Languages, cache: dict[str, np.ndarray], with_spans: bool) -> list[dict]:
    """lang_pred, score and spans (language, first word, words) of each text."""
    split = [[w for w in words_of(t) if w.isascii() or any(c.isalpha() for c in w)] for t in texts]
    rows = [{"lang_pred": "und", "score": 0.0, "spans": []} for _ in texts]
    some = [i for i, s in enumerate(split) if s]
    if not model.names or not some:
        return rows
    ids = {w: i for i, w in enumerate({w for i in some for w in split[i]})}
    if len(cache) + len(ids) > CACHED_WORDS:
        cache.clear()
    new = [w for w in ids if w not in cache]
    for first in range(0, len(new), 20_000):  # pieces, for memory
        piece = new[first:first + 20_000]
        cache.update(zip(piece, model.word_scores(piece), strict=True))
    by_word = np.stack([cache[w] for w in ids])
    counts = np.array([len(split[i]) for i in some])
    words = np.fromiter((ids[w] for i in some for w in split[i]), dtype=np.int64, count=int(counts.sum()))
    letters = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))[words]
    path = viterbi(by_word[words], counts, model.log_prior, SWITCH)
    text = np.repeat(np.arange(len(some)), counts)
    share = np.bincount(text * len(model.names) + path, weights=letters, minlength=len(some) * len(model.names)).reshape(len(some), -1)
    for k, i in enumerate(some):
        top = int(share[k].argmax())
        rows[i]["lang_pred"], rows[i]["score"] = model.names[top], float(share[k][top] / share[k].sum())
    if with_spans:
        ends = np.cumsum(counts)
        for k, i in enumerate(some):
            own = path[ends[k] - counts[k]:ends[k]]
            cuts = np.flatnonzero(np.diff(own)) + 1
            firsts = np.concatenate(([0], cuts))
            rows[i]["spans"] = [{"lang": model.names[own[a]], "first": int(a), "words": int(n)}
                                for a, n in zip(firsts, np.diff(np.append(firsts, len(own))), strict=True)]
    return rows


def fit(docs: DataFrame) -> Languages:
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), MOD, HELD_OUT))
    known = known.withColumn("short", F.char_length("text") <= FIT_CHARS)
    counted_rows = known.groupBy("lang").agg(F.count("*").alias("n"), F.count(F.when(F.col("short"), 1)).alias("n_short")).collect()  # a row per language
    per_lang, per_short = ({r.lang: r[c] for r in counted_rows} for c in ("n", "n_short"))
    names = sorted(per_lang, key=lambda s: s.encode())
    if not names:
        return Languages([], np.zeros(0), np.zeros((0, 0)), {})
    spark = docs.sparkSession
    # Long texts teach only a language that has no others.
    rates = spark.createDataFrame([(n, i, min(1.0, FIT_DOCS / (per_short[n] or per_lang[n])), not per_short[n]) for i, n in enumerate(names)],
                                  "lang string, label int, rate double, long boolean")
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(F.broadcast(rates), "lang").filter((u < F.col("rate")) & (F.col("short") | F.col("long"))).select("label", "text").repartition(16)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, letters = {}, Counter()
        for batch in batches:
            seen: dict[int, Counter] = {}
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen.setdefault(label, Counter()).update(words_of(text.as_py()))
            for label, counter in ((k, c) for k, c in seen.items() if c):
                own = grams.setdefault(label, np.zeros(1 << HASH_BITS))
                gram, owner = ngrams(list(counter))
                own += np.bincount(gram, weights=np.fromiter(counter.values(), float, len(counter))[owner], minlength=1 << HASH_BITS)
                for word, n in counter.items():
                    letters[label, script_of(word)] += n * len(word)
        for label, own in grams.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"label": [label] * len(at), "gram": at, "script": [None] * len(at), "n": own[at].astype(np.int64)}, schema)
        if letters:
            yield pa.RecordBatch.from_pydict({"label": [k for k, _ in letters], "gram": [None] * len(letters),
                                              "script": [s for _, s in letters], "n": list(letters.values())}, schema)

    schema = pa.schema([("label", pa.int32()), ("gram", pa.int32()), ("script", pa.string()), ("n", pa.int64())])
    counts = np.zeros((1 << HASH_BITS, len(names)))
    by_script: dict[str, np.ndarray] = {}
    totals = sample.mapInArrow(counted, "label int, gram int, script string, n long").groupBy("label", "gram", "script").agg(F.sum("n"))
    for label, gram, script, n in totals.collect():  # at most 2^HASH_BITS and the scripts for each language
        if script is None:
            counts[gram, label] = n
        else:
            by_script.setdefault(script, np.zeros(len(names)))[label] = n
    share = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=0)
    letters = np.maximum(sum(by_script.values()), 1) if by_script else np.ones(len(names))
    uses = {s: n / letters >= USES_SCRIPT for s, n in by_script.items() if (n / letters >= USES_SCRIPT).any()}
    prior = np.array([per_lang[n] for n in names], dtype=float)
    return Languages(names, np.log(prior / prior.sum()).astype(np.float32), np.log(share).astype(np.float32), uses)


RESULT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()),
                    ("spans", pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())])))])
_CACHES: dict[str, dict[str, np.ndarray]] = {}


def identify(text: Column, model: Languages, with_spans: bool = True) -> Column:
    """Struct of lang_pred, score and spans of a whole text."""
    name = f"{zlib.crc32(model.log_share.tobytes()):x}"

    @arrow_udf("struct<lang_pred:string,score:double,spans:array<struct<lang:string,first:long,words:long>>>")
    def identified(texts: pa.Array) -> pa.Array:
        if name not in _CACHES:
            _CACHES.clear()
        cache = _CACHES.setdefault(name, {})
        rows, chunk, held = [], [], 0
        for text in texts:
            chunk.append(text.as_py())
            held += len(chunk[-1] or "") // 5 + 1  # about a word in five characters
            if held >= CHUNK_WORDS:
                rows += labelled(chunk, model, cache, with_spans)
                chunk, held = [], 0
        rows += labelled(chunk, model, cache, with_spans)
        return pa.array(rows, RESULT)

    return identified(text)


def op4_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", held_out(F.col("doc_id"), MOD, HELD_OUT).alias("held_out"), identify(F.col("text"), fit(docs)).alias("r"))
    span = lambda s: F.concat_ws(":", s["lang"], s["first"].cast("string"), s["words"].cast("string"))
    return found.select("doc_id", "held_out", "r.lang_pred", "r.score", F.size("r.spans").alias("n_spans"),
                        F.array_join(F.transform("r.spans", span), ",").alias("spans"))
