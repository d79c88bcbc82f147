"""Queries and their parts against plain versions in Python, the contract, or held-out labels."""
import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillcast.llm import chat, language, minhash, mixing, packing, quality, queries, repetition, sharding, toxicity, winnowing
from tillcast.llm.tokens import segments, tokenizer
from tools.oracle_check import canon, compare

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
@pytest.mark.parametrize("folder", ["sf0.001", "odd"])
def test_oracle(spark, request, name, folder):
    path = request.getfixturevalue("odd") if folder == "odd" else f"/root/testdata/{folder}"
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    ok, diff = compare(canon(queries.QUERIES[name](spark, path).toPandas()), canon(con.execute(queries.ORACLE[name]).df()))
    assert ok, diff


# 1 quality

def test_quality_on_held_out_labels(spark, documents, labels):
    rows = {r.doc_id: r for r in quality.op1_quality_classifier(spark, SF).collect()}
    assert set(rows) == set(documents)
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(rows[d].held_out for d in held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    right = [rows[d].predicted == labels[d].quality for d in held]
    assert sum(right) / len(right) > 0.95


def test_discriminant_equals_the_formula():
    draw = np.random.default_rng(0)
    x, y = draw.normal(size=(400, 3)) @ draw.normal(size=(3, 3)), np.repeat([0, 1], [150, 250])
    x[y == 1] += 1
    n = np.array([150.0, 250.0])
    model = quality.shrunk(n, np.array([x[y == k].sum(0) for k in (0, 1)]), np.array([x[y == k].T @ x[y == k] for k in (0, 1)]), 0.2, 0.1)
    z = x / model.scale
    cov = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    pooled = (cov[0] * 150 + cov[1] * 250) / 400
    logs = []
    for k in (0, 1):
        c = 0.8 * cov[k] + 0.2 * pooled
        c = 0.9 * c + 0.1 * np.trace(c) / 3 * np.eye(3)
        d = z - z[y == k].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.log(np.linalg.det(c)))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1] - np.log(250 / 150))))


def test_quality_without_a_class():
    zeros = np.zeros((2, 2)), np.zeros((2, 2, 2))
    assert quality.shrunk(np.zeros(2), *zeros, 0.1, 0.1).scores(np.zeros((3, 2))).tolist() == [0.5] * 3
    assert quality.shrunk(np.array([0.0, 4.0]), *zeros, 0.1, 0.1).scores(np.zeros((1, 2))).tolist() == [1.0]


# 2 mixing

def test_mix_meets_targets_and_is_nested(spark, documents):
    rows = mixing.op2_mix_sources(spark, SF).collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[documents[r.doc_id].source].append(r)
    total = sum(r.size for r in rows)
    for own in by_source.values():
        assert own[0].source_size == sum(r.size for r in own) and own[0].target <= 2 * own[0].source_size + 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
        assert all(r.taken <= 2 * r.size for r in own)
    assert abs(sum(own[0].target for own in by_source.values()) - 1.5 * total) < 1e-3
    small = mixing.plan(mixing.sized(spark.read.parquet(f"{SF}/documents.parquet")), share=0.4)
    large = mixing.plan(mixing.sized(spark.read.parquet(f"{SF}/documents.parquet")), share=0.6)
    low, high = ({r.source_key: (r.repeats, r.threshold) for r in p.sources.collect()} for p in (small, large))
    assert all(low[s] <= high[s] for s in low)


# 3 sharding

def test_shards_are_whole_even_and_gapless(spark, documents):
    rows = sharding.op3_sampled_splitter_shards(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(documents) and len(rows) == len(documents)
    shards = defaultdict(list)
    for r in rows:
        raw = documents[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        shards[r.shard].append(r)
    mean, largest = sum(r.size for r in rows) / 40, max(r.size for r in rows)
    for shard, own in shards.items():
        assert 0 <= shard < 40 and sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - mean) <= largest
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.op3_sampled_splitter_shards(spark, SF).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_hot_text_is_subdivided(spark):
    rows = [(i, "hot text" if i % 3 else f"text {i}") for i in range(3000)]
    placed = sharding.shard(sharding.stage(sharding.records(spark.createDataFrame(rows, "doc_id long, text string"))), shards=10).collect()
    sizes = Counter()
    for r in placed:
        sizes[r.shard] += r.size
    assert len(sizes) == 10 and max(sizes.values()) < 1.05 * min(sizes.values())


# 4 language

def test_viterbi_is_the_best_path():
    draw, numbers = random.Random(1), np.random.default_rng(1)
    for _ in range(60):
        labels, counts = draw.choice([1, 2, 3]), [draw.randint(1, 5) for _ in range(draw.randint(1, 4))]
        scores, prior, switch = numbers.normal(size=(sum(counts), labels)) * 2, numbers.normal(size=labels), draw.choice([0.5, 2])
        path, first = language.viterbi(scores, np.array(counts), prior, switch), 0

        def value(p):
            return prior[p[0]] + sum(scores[first + i, k] for i, k in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:]))

        for n in counts:
            best = max(value(p) for p in itertools.product(range(labels), repeat=n))
            assert abs(value(path[first:first + n].tolist()) - best) < 1e-9
            first += n


def test_language_on_held_out_documents(spark, documents):
    rows = {r.doc_id: r for r in language.op4_language_spans(spark, SF).collect()}
    held = [d for d, r in rows.items() if r.held_out]
    right = [rows[d].lang_pred == documents[d].lang for d in held]
    assert len(rows) == len(documents) and sum(right) / len(right) > 0.97


def test_mixed_text_falls_into_spans(spark, documents):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    some = {}
    for r in documents.values():
        if 40 < len(r.text.split()) < 400:
            some.setdefault(r.lang, r.text)
    text = some["en"] + "\n" + some["de"]
    spans = language.labelled([text], model, {}, True)[0]["spans"]
    longest = sorted(spans, key=lambda s: -s["words"])[:2]
    assert {s["lang"] for s in longest} == {"en", "de"}
    assert sum(s["words"] for s in spans) == len(language.words_of(text))
    assert language.labelled(["12 + 3", None], model, {}, True)[0]["lang_pred"] == "und"


# 5 packing

def test_ids_are_the_tokenizers():
    own, draw = tokenizer(), random.Random(2)
    letters = [chr(i) for i in range(256)] + [" "] * 60 + list("abcdefgh'st") * 10 + ["<|endoftext|>", "Σ", "ŭ", "日"]
    for _ in range(800):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 60)))
        assert own.encode(text) == np.array(own.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    long = "some words here " * 200
    assert "".join(segments(long, 100)) == long and len(list(segments(long, 100))) > 10
    assert b"".join(map(own.encode, segments(long, 100))) == own.encode(long)


def one_by_one(lengths, capacity):
    left = []
    for length in sorted(lengths, reverse=True):
        fit = min((b for b in left if b >= length), default=None)
        if fit is not None:
            left.remove(fit)
        left.append((capacity if fit is None else fit) - length)
    return sorted(left)


def test_best_fit_is_the_one_by_one_algorithm():
    draw = random.Random(3)
    for _ in range(150):
        capacity = draw.choice([7, 16, 50, 100])
        lengths = [draw.randint(1, capacity) for _ in range(draw.randint(0, 200))]
        plan, seats = packing.best_fit(Counter(lengths), capacity), defaultdict(list)
        for length, n in Counter(lengths).items():
            own = plan[plan[:, 0] == length]
            for rank in range(n):
                run = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
                nth = rank - run[1]
                seats[int(run[2] + nth // run[3])].append((int(run[4] + nth % run[3] * length), length))
        for taken in seats.values():
            at = 0
            for offset, length in sorted(taken):
                assert offset == at
                at += length
            assert at <= capacity
        assert sorted(capacity - sum(n for _, n in taken) for taken in seats.values()) == one_by_one(lengths, capacity)


def check_packing(rows, texts):
    """Pieces are the tokens of the texts (a list of (doc_id, text)), whole, in gapless seats."""
    whole, want = tokenizer().whole, Counter()
    for doc, text in texts:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for n, first in enumerate(range(0, len(ids), 4096)):
            part = ids[first:first + 4096]
            want[doc, n, first, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    seats = defaultdict(list)
    for r in rows:
        seats[r.sequence_id].append((r.offset, r.length))
    for own in seats.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(seats) == len(one_by_one([r.length for r in rows], 4096))


def test_packing(spark, documents):
    check_packing(packing.op5_best_fit_packing(spark, SF).collect(), [(r.doc_id, r.text) for r in documents.values()])


def test_packed_ids_round_trip(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None), (3, "more " * 50)], "doc_id long, text string")
    rows = packing.pack(docs, capacity=16, keep_ids=True).orderBy("doc_id", "piece").collect()
    ids = defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length <= 16
        ids[r.doc_id] += r.ids
    assert ids[2] == [1] and ids[1] == tokenizer().whole.encode("some words", add_special_tokens=False).ids + [1]


# 6 repetition

def plain_repeats(words, least):
    n, out = len(words), [0] * len(words)
    for i, j in itertools.permutations(range(n), 2):
        k = 0
        while i + k < n and j + k < n and words[i + k] == words[j + k]:
            k += 1
        out[i] = max(out[i], k)
    return [k if k >= least else 0 for k in out]


def test_suffix_array_repeats():
    draw = random.Random(4)
    for _ in range(120):
        texts = [[draw.randrange(draw.choice([1, 2, 3, 20])) for _ in range(draw.choice([0, 1, 2, 10, 30]))] for _ in range(draw.randint(1, 5))]
        counts = np.array([len(t) for t in texts])
        words = np.array([w for t in texts for w in t], dtype=np.int64)
        for least in (1, 3, 5, 8):
            got = repetition.repeat_lengths(words, np.repeat(np.arange(len(texts)), counts), np.repeat(np.cumsum(counts), counts), least)
            assert got.tolist() == [k for t in texts for k in plain_repeats(t, least)]


def plain_base(text):
    words = (text or "").encode().split()
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\v\f\r")]
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))


@pytest.mark.parametrize("folder", ["sf", "odd"])
def test_quality_rules_base(spark, odd, folder):
    path = SF if folder == "sf" else odd
    texts = Counter()
    for r in spark.read.parquet(f"{path}/documents.parquet").collect():
        n, *rest = plain_base(r.text)
        texts[(r.doc_id, n, *rest, n < 20 or 100 * rest[-1] > 30 * n)] += 1
    rows = repetition.op6_repetition_rules(spark, path).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == texts
    assert all(not (r.base_failed and r.kept) for r in rows)
    assert all(sum(s.length for s in r.spans) == r.covered_words for r in rows)


# 7 toxicity

def test_toxicity_on_the_held_out_fold(spark):
    rows = {r.doc_id: r for r in toxicity.op7_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in labels)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    caught = [rows[r.doc_id].predicted for r in labels if r.toxic]
    clean = [rows[r.doc_id].predicted for r in labels if not r.toxic]
    assert sum(caught) / len(caught) > 0.85 and sum(clean) / len(clean) < 0.05


def test_non_negative_risk_learns_from_positives_and_unlabelled():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdef") for _ in range(5))
    clean = [" ".join(word() for _ in range(30)) for _ in range(400)]
    toxic = [" ".join([*(word() for _ in range(30)), "zorgscum"]) for _ in range(120)]
    code = lambda t: np.array([f for w in sorted(toxicity.distinct_words(t)) for f in toxicity.word_features(w)])
    model = toxicity.train([code(t) for t in toxic[:60]], [code(t) for t in clean[:300] + toxic[60:90]], 0.1)
    assert (model.scores(toxic[90:], {}) > 0.7).all() and (model.scores(clean[300:], {}) < 0.7).all()
    assert toxicity.train([], [], 0.1).scores(["a", None], {}).tolist() == [0, 0]


# 8 chat

def test_preference_format(spark):
    turns = lambda *t: [(i, r, x) for i, (r, x) in enumerate(t)]
    kind = "array<struct<turn:long,role:string,text:string>>"
    pairs = [(1, turns(("user", "q"), ("assistant", "a <|end|>")), turns(("user", "q"), ("assistant", "b"), ("user", "c"))),
             (2, turns(("user", "q")), turns(("user", "q"))), (3, [], turns(("assistant", "x")))]
    rows = {r.pair_id: r for r in chat.format_pairs(spark.createDataFrame(pairs, f"pair_id long, chosen {kind}, rejected {kind}")).collect()}
    one = rows[1]
    assert one.prompt == "<|user|>\nq\n<|end|>\n" and one.n_prompt_turns == 1
    assert one.chosen == "<|assistant|>\na <\\|end|>\n<|end|>\n" and one.rejected.endswith("<|user|>\nc\n<|end|>\n")
    for text, mask, want in ((one.chosen, one.chosen_mask, "a <\\|end|>\n<|end|>\n"), (one.rejected, one.rejected_mask, "b\n<|end|>\n")):
        start, length = map(int, mask.split(":"))
        assert text[start:start + length] == want
    assert (rows[2].chosen, rows[2].rejected, rows[2].chosen_mask) == ("", "", "") and rows[3].prompt == "" and rows[3].chosen == ""


# 9 near-duplicates

def plain_groups(docs, width, percent):
    sets, at, parent = {}, defaultdict(list), {}
    for doc, text in docs:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        sets[doc] = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()
        parent[doc] = doc
        for s in sets[doc]:
            at[s].append(doc)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc, own in sets.items():
        for other, both in Counter(d for s in own for d in at[s] if d < doc).items():
            if 100 * both >= percent * (len(own) + len(sets[other]) - both):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_groups_equal_brute_force(spark, documents, width, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.groups(docs, width, percent).collect()}
    assert got == plain_groups([(r.doc_id, r.text) for r in documents.values()], width, percent)


def test_large_groups_and_chains(spark):
    """A group of many near copies whose least member is an outlier, and a chain of edits."""
    draw = random.Random(6)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(500):
        words = list(base)
        for _ in range(draw.choice((1, 2, 3))):
            words[draw.randrange(120)] = f"e{draw.randrange(9999)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(60):
        chain = chain[1:] + [f"d{i}"]
        rows.append((1000 + i, " ".join(chain)))
    rows += [(2000 + i, " ".join(f"u{draw.randrange(99999)}" for _ in range(50))) for i in range(200)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == plain_groups(rows, 3, 85)


def test_links_of_an_id_with_two_texts_beside_repeated_rows(spark):
    """Both texts of id 1 keep their near copies, whether or not other rows are repeated."""
    draw = random.Random(13)
    texts = [[f"{c}{draw.randrange(9999)}" for _ in range(80)] for c in "abc"]
    near = [" ".join([*t[:-1], "changed"]) for t in texts]
    a, b, c = map(" ".join, texts)
    rows = [(1, a), (1, b), (2, near[0]), (3, near[1]), (4, c), (5, near[2])]
    for again in ([], [(4, c)], [(1, a)], [(1, b), (1, b)]):
        docs = spark.createDataFrame(rows + again, "doc_id long, text string")
        assert {(r.doc_id, r.component_id) for r in minhash.groups(docs, 3, 80).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}


def test_b_bit_estimate(spark):
    draw = random.Random(7)
    a = {f"x{i}" for i in range(900)}
    b = set(draw.sample(sorted(a), 700)) | {f"y{i}" for i in range(200)}
    true = len(a & b) / len(a | b)
    sets = [np.unique(minhash.mixed(np.array([zlib.crc32(x.encode()) * 2654435761 for x in s], dtype=np.uint64))) for s in (a, b)]
    low = minhash.packed(minhash.minima(sets, 192))
    assert abs(minhash.estimates(low[:1], low[1:])[0, 0] - true) < 0.12
    df = spark.createDataFrame([(low[0].tolist(), low[1].tolist())], "a array<long>, b array<long>")
    found = df.select(minhash.estimate(df["a"], df["b"], 192)).first()[0]
    assert abs(found - minhash.estimates(low[:1], low[1:])[0, 0]) < 1e-12


# 10 winnowing

def plain_fingerprint(text):
    """Grams by last code point, least of each window (rightmost of equal ones), all of a short text."""
    k, w = winnowing.GRAM, winnowing.WINDOW
    h = [zlib.crc32(c.encode()) for c in text]
    grams = []
    for i in range(len(h)):
        x = 0
        for y in h[max(i - k + 1, 0):i + 1]:
            x = (2 * x + y) % winnowing.PRIME
        grams.append(winnowing.PRIME - x)
    if len(grams) <= 2 * w:
        return list(zip(grams, range(len(grams))))
    return list(dict.fromkeys((lambda i: (grams[i], i))(min(range(s, s + w), key=lambda i: (grams[i], -i))) for s in range(len(grams) - w + 1)))


def check_fingerprints(rows, texts, most=None):
    """``rows`` by place in ``texts``, which are in the documents' order; the first ``most`` of them."""
    prints = [plain_fingerprint(t) for t in texts[:most and most + 1]]
    for i, (text, own) in list(enumerate(zip(texts, prints)))[:most]:
        r, after, half = rows[i], (i + 1) % len(texts), len(text) // 2
        edited = text[:len(text) - half] + texts[after][:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        changed = plain_fingerprint(edited)
        said = lambda p: " ".join(f"{(winnowing.PRIME - h << 32) + at:X}" for h, at in p)
        assert (r.fingerprint, r.edited_fingerprint) == (said(own), said(changed))
        for found, other in ((r.near_edited, changed), (r.near_next, prints[after])):
            a, b = {h for h, _ in own}, {h for h, _ in other}
            assert abs(found - (len(a & b) / len(a | b) if a | b else 1)) < 1e-12
        assert r.near_edited > 0


def test_winnowing(spark, documents):
    order = sorted(documents)
    rows = {r.doc_id: r for r in winnowing.op10_winnowing_fingerprints(spark, SF).collect()}
    assert set(rows) == set(order)
    check_fingerprints([rows[d] for d in order], [documents[d].text for d in order], 250)
    assert all(r.near_edited > 0 for r in rows.values())
    long = [rows[d] for d in order if len(documents[d].text) > 500]
    assert sum(r.near_edited > 0.15 for r in long) / len(long) > 0.95 and sum(r.near_next < 0.1 for r in long) / len(long) > 0.9


def test_winnowing_of_odd_texts(spark):
    """Short texts, texts without white space, every length around the seams' sizes."""
    draw = random.Random(12)
    pick = lambda alphabet, n: "".join(draw.choice(alphabet) for _ in range(n))
    odd = ["", "x", "ab", "日本", "one two", "z" * 400, "".join(chr(draw.randrange(0x4E00, 0x9FFF)) for _ in range(3000)), "😀é" * 20,
           pick("0123456789abcdef", 5000), "".join(chr(draw.randrange(0xE01, 0xE2E)) for _ in range(63)), ""]
    texts = odd + [pick(draw.choice(["ab", "abcdefghij \n", "日本é😀"]), n) for n in list(range(240)) + [draw.randint(0, 420) for _ in range(300)]]
    draw.shuffle(texts)
    rows = {r.doc_id: r for r in winnowing.edited_pairs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    check_fingerprints([rows[i] for i in range(len(texts))], texts)


def test_winnowing_hashes_a_code_point_once(spark):
    assert str(winnowing.choices(F.col("text"))).count("crc32(") == 1


def test_winnowing_grown(spark):
    """Runs that end at each place, shorter ones at the start."""
    a = F.array(*[F.lit(x).cast("long") for x in range(1, 7)])
    sums, highest = spark.range(1).select(winnowing.grown(a, 4, lambda x, y, by: x + y), winnowing.grown(F.reverse(a), 4, lambda x, y, by: F.greatest(x, y))).first()
    assert (sums[:6], highest[:6]) == ([1, 3, 6, 10, 14, 18], [6, 6, 6, 6, 5, 4])


def test_winnowing_of_repeated_and_null_ids(spark, monkeypatch):
    """Equal ids spread over ranges: each row's next is some row that follows it, all but one once."""
    monkeypatch.setattr(winnowing, "RANGE_BYTES", 400)
    rows = [(None if i % 3 else 5, f"text number {i} " * 3) for i in range(200)] + [(5, "same")] * 9 + [(7, None)]
    got = winnowing.edited_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((d, len(t or "")) for d, t in rows)
    edited = {hashlib.sha256((a[:len(a) - len(a) // 2] + b[:len(a) // 2]).encode()).hexdigest()
              for _, a in ((d, t or "") for d, t in rows) for _, b in ((d, t or "") for d, t in rows)}
    assert {r.edited_sha256 for r in got} <= edited and len({r.edited_sha256 for r in got}) >= 200


# pipeline

def test_pipeline_against_a_plain_version(spark, plain):
    """Each stage from its predecessor's rows: decisions by the operators' queries or plain code."""
    docs = spark.read.parquet(f"{plain}/documents.parquet")
    scores = {r.doc_id: r.score for r in quality.op1_quality_classifier(spark, plain).collect()}
    kept = [r for r in docs.collect() if scores[r.doc_id] >= 0.3]
    assert kept and len(kept) < docs.count()
    kept = [r for r in kept if (b := plain_base(r.text))[0] >= 20 and 100 * b[-1] <= 30 * b[0]]
    groups = plain_groups([(r.doc_id, r.text) for r in kept], 5, 80)
    kept = [r for r in kept if groups[r.doc_id][1] == r.doc_id]
    con = duckdb.connect()
    import pandas as pd
    frame = pd.DataFrame([r.asDict() for r in kept])  # noqa: F841
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    times = {d: taken // size for d, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({queries.ORACLE['op2_mix_sources']})").fetchall()}
    texts = [(r.doc_id, r.text) for r in kept for _ in range(times[r.doc_id])]
    check_packing(corpus_pipeline.run(spark, plain).collect(), texts)
