"""Results that must not depend on how the work is cut up: block and bucket sizes."""
import random

from pyspark.sql import functions as F

from tillcast.llm import chat, language, minhash, mixing, sharding, toxicity
from tillcast.session import stage


def test_left_over_comparison_in_small_blocks(spark, monkeypatch):
    """Buckets of many components are compared whole, also when they span several blocks."""
    draw = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        for at in draw.sample(range(60), 5):
            words[at] = f"e{i % 30}x{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id: r.component_id for r in minhash.groups(docs, 1, 80).collect()}
    monkeypatch.setattr(minhash, "BLOCK", 7)
    assert {r.doc_id: r.component_id for r in minhash.groups(docs, 1, 80).collect()} == whole


def test_equal_texts_share_a_shard(spark):
    rows = [(i, f"text {i // 3}" * 20) for i in range(3000)]
    placed = sharding.shard(stage(sharding.records(spark.createDataFrame(rows, "doc_id long, text string"))), shards=5)
    assert placed.groupBy("text_crc32").agg({"shard": "max"}).count() == 1000
    assert placed.select("text_crc32", "shard").distinct().count() == 1000


def test_the_fits_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    """An id of 400 rows teaches once; long positives teach where there are no others."""
    monkeypatch.setattr(toxicity, "FIT_CHARS", 50)
    rows = [(7, "same text of an id " * (1 + i % 2)) for i in range(400)] + [(100 + i, f"words number{i}") for i in range(50)]
    rows += [(1000 + i, "zorgscum " * 20) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1000 + i, 1) for i in range(40)] + [(7, 0)] + [(100 + i, 0) for i in range(50)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda positive, unlabelled, prior: seen.append((len(positive), len(unlabelled))))
    toxicity.fit(docs, labels)
    learn = lambda ids: len([i for i in ids if toxicity.zlib.crc32(str(i).encode()) % 3 != 1])
    positives = learn(range(1000, 1040))
    assert seen == [(positives, positives + learn([7]) + learn(range(100, 150)))]


def test_risk_gradient_against_finite_differences():
    """One step of the fit moves each weight against the slope of the plainly written non-negative risk."""
    import numpy as np
    draw = np.random.default_rng(3)
    x, u = draw.random((30, 4)), draw.random((60, 4))
    prior = 0.3

    def risk(w):
        zp, zu = x @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        toxic = lambda z: np.log1p(np.exp(-z)).mean()
        clean = lambda z: np.log1p(np.exp(z)).mean()
        return prior * toxic(zp) + max(0.0, clean(zu) - prior * clean(zp))

    for w in (np.zeros(5), draw.normal(size=5), np.array([-9.0, -9, -9, -9, -9])):
        sig = lambda z: 1 / (1 + np.exp(-z))
        zp, zu = x @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        live = float(np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean() > 0)
        gp, gu = prior * (sig(zp) - 1 - live * sig(zp)) / len(zp), live * sig(zu) / len(zu)     # the fit's formula
        mine = np.append(x.T @ gp + u.T @ gu, gp.sum() + gu.sum())
        plain = [(risk(w + h) - risk(w - h)) / 2e-6 for h in np.eye(5) * 1e-6]
        assert np.allclose(mine, plain, atol=1e-5)


def test_a_language_of_long_texts_only_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_CHARS", 200)
    rows = [(i, "the thing and other things of the thing", "en") for i in range(40)]
    rows += [(100 + i, "schön heit keit ungeheuer über die straße " * 20, "de") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.names == ["de", "en"]
    got = {r.doc_id: r.p for r in docs.select("doc_id", language.identify(F.col("text"), model)["lang_pred"].alias("p")).collect()}
    assert all(got[i] == ("en" if i < 100 else "de") for i in got)


def test_rows_of_no_conversation_do_not_meet(spark):
    rows = [(None, i, "assistant", f"t{i}") for i in range(300)] + [(4, 0, "user", "q"), (4, 1, "assistant", "a"), (4, 2, "assistant", "b")]
    got = chat.format_pairs(chat.partner_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert len(got) == 301 and all(r.n_prompt_turns == 1 for r in got if r.pair_id is None)


def test_mask_of_a_long_conversation(spark):
    rows = [(4, i, "assistant" if i % 2 else "user", f"turn {i} <| \\") for i in range(3000)]
    pairs = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    r = pairs.select(chat.rendered(F.col("turns")).alias("text"), chat.mask(F.col("turns")).alias("mask")).first()
    spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",")]
    want = [f"turn {i} <\\| \\\\\n<|end|>\n" for i in range(1, 3000, 2)]
    assert [r["text"][a:a + n] for a, n in spans] == want


def test_no_group_below_a_shard_is_split(spark):
    """Over the whole sf0.1 table, and with groups just below and above a shard: shards stay near equal."""
    placed = sharding.op3_sampled_splitter_shards(spark, "/root/testdata/sf0.1")
    groups = placed.groupBy("text_crc32").agg(F.sum("size").alias("bytes"), F.countDistinct("shard").alias("n")).collect()
    loads = [r.b for r in placed.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("top")).collect()]
    share = sum(loads) / 40
    assert len(loads) == 40 and max(loads) < 1.02 * share and min(loads) > 0.98 * share
    assert all(r.n == 1 for r in groups if r.bytes <= share)
    rows = [(i, "x" * 984) for i in range(90)] + [(100 + i, "y" * 984) for i in range(350)] + [(1000 + i, f"{i:05}" * 100) for i in range(1100)]
    placed = sharding.shard(stage(sharding.records(spark.createDataFrame(rows, "doc_id long, text string"))), shards=10).collect()
    where, loads, slots = {}, {}, {}
    for r in placed:
        where.setdefault(r.text_crc32, set()).add(r.shard)
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = sorted((len(s) for s in where.values()), reverse=True)
    assert sizes[0] >= 4 and sizes[1] == 1      # only the text that outweighs a shard is cut
    assert max(loads.values()) - min(loads.values()) < 0.05 * sum(loads.values()) / 10
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equal_rows_fill_a_target_to_half_a_row(spark):
    """101 equal rows of one source: as many are taken as fit, the same rows count in both outputs."""
    rows = [(7, "one two three", "a", f"extra {i % 4}") for i in range(101)] + [(i, f"some words of {i} " * 5, "b", None) for i in range(8, 20)]
    rows += [(50, None, "c", None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, times string").repartition(7)
    for share in (0.1, 0.37, 0.6, 1.5):
        made = mixing.plan(stage(mixing.sized(docs)), share=share)
        taken = made.join(stage(mixing.sized(docs))).groupBy("source_key").agg(
            F.sum(F.col("size") * F.col("times")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("size"))
        for r in taken.collect():
            assert abs(r.taken - r.target) <= r["size"] / 2 + 1e-9
        mixed = mixing.mix(docs, share=share)
        assert mixed.columns == docs.columns
        got = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"\w+"))).alias("n")).collect() if r.source == "a"}
        assert got.get("a", 0) == {r.source_key: r.taken for r in taken.collect()}["0a"]


def test_broadcasts_are_bounded_in_rows_and_bytes(spark):
    from tillcast.llm.common import bounded_broadcast
    marked = lambda **how: "broadcast" in bounded_broadcast(spark.range(3), **how)._jdf.queryExecution().logical().toString()
    assert marked(rows=1_000_000) and not marked(rows=1_000_001)
    assert marked(rows=60, row_bytes=1_000_000) and not marked(rows=65, row_bytes=1_000_000)
