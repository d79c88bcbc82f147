import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int64()), ("toxic", pa.int64())])
TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
#: Names that the operators use for columns of their own.
CLASHING = ("size", "key", "score", "bucket", "label", "hash", "row", "id", "class_id", "rank", "count", "length", "part", "times", "weight",
            "range", "shard", "position", "kept", "set_key", "n", "words", "ghost", "edited", "own", "found", "turns", "last", "answer")

VOCABULARY = {"en": [a + b for a in ("th", "er", "on", "an", "re") for b in ("ing", "ed", "ly", "tion", "ou", "st")],
              "de": [a + b for a in ("ver", "ge", "zu", "ein", "sch") for b in ("heit", "keit", "ung", "lich", "ö", "ß")]}


def prose(draw: random.Random, n: int, lang: str = "en") -> str:
    words = [draw.choice(VOCABULARY[lang]) + draw.choice(VOCABULARY[lang]) for _ in range(n)]
    return ". ".join(" ".join(words[i:i + 12]) for i in range(0, n, 12))


def write(folder, docs, labels=(), turns=(), extra=False):
    for name, rows, schema in (("documents", docs, DOCS), ("labels", labels, LABELS), ("conversations", turns, TURNS)):
        table = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
        if extra:
            for column in CLASHING:
                table = table.append_column(column, pa.array(["x"] * len(table), pa.string()))
        pq.write_table(table, folder / f"{name}.parquet")
    return str(folder)


def corpus(n: int = 120, seed: int = 5):
    """Documents of two languages with junk, toxic words, copies and near copies; labels."""
    draw, docs, labels = random.Random(seed), [], []
    for i in range(n):
        lang = draw.choice(("en", "de"))
        text, quality, toxic = prose(draw, draw.randint(30, 120), lang), 1, 0
        if i % 6 == 1:
            text, quality = " ".join(w + "&&&" for w in text.split()), 0
        elif i % 6 == 2:
            text, toxic = text + " zorgscum zorgfool zorgrat", 1
        elif i % 10 == 3 and docs:
            text = docs[-3][1]
        elif i % 10 == 7 and docs:
            words = docs[-4][1].split()
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        docs.append((i, text, lang, f"src{draw.choice((0, 0, 0, 1, 2, 3))}", len(text)))
        labels.append((i, quality, toxic))
    return docs, labels


@pytest.fixture(scope="session")
def plain(tmp_path_factory):
    docs, labels = corpus()
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c // 3}") for c in range(20) for t in range(c % 5 + 1)]
    return write(tmp_path_factory.mktemp("plain"), docs, labels, turns)


@pytest.fixture(scope="session")
def clashing(tmp_path_factory):
    docs, labels = corpus()
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c // 3}") for c in range(20) for t in range(c % 5 + 1)]
    return write(tmp_path_factory.mktemp("clashing"), docs, labels, turns, extra=True)


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return write(tmp_path_factory.mktemp("empty"), [])


@pytest.fixture(scope="session")
def odd(tmp_path_factory):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    docs, labels = corpus(60)
    draw = random.Random(8)
    long = prose(draw, 60_000)
    docs += [(None, None, None, None, None), (None, "a text without an id", "en", "src0", 20), (None, "a text without an id", "en", "src0", 20),
             (1000, None, "en", None, 0), (1001, "", None, "src9", 0), (1002, " \n\t ", "de", "src9", 4), (1003, long, "en", "src0", len(long)),
             (1004, "x" * 300_000, "en", "src0", 300_000), (1005, "word", "en", "src1", 4), (1006, "two words", "en", "src1", 9),
             (1007, "привет мир ünï\x85  \x1c日本語 ∑ <|endoftext|>", None, "src1", 20), (1008, "a " * 20_000, "en", "src2", 40_000)]
    docs += [docs[0], docs[0], (3, "another text of an id that is there", "en", "src0", 35), (2000, docs[5][1], "en", "src0", 1), (2001, docs[5][1], "en", "src0", 1)]
    labels += [(None, 1, 1), (1003, None, None), (0, 0, 1), (5, 7, 7), (9999, 1, 1)]
    turns = [(None, 0, "user", "hi"), (None, None, None, None), (1, 0, "user", "q"), (1, 1, "assistant", None), (0, 0, "user", "q"), (0, 0, "user", "q"),
             (0, 1, "assistant", "a <|end|> \\ b"), (2, 0, "user", "no answer"), (7, 3, "assistant", "y" * 100_000), (6, 0, "assistant", "short")]
    return write(tmp_path_factory.mktemp("odd"), docs, labels, turns)
