"""Every query on nulls, odd texts, repeated rows, an empty table and clashing column names."""
import pytest

import corpus_pipeline
from tillcast.llm.queries import QUERIES

COLUMNS = {
    "op1": ["doc_id", "held_out", "score", "predicted"], "op2": ["doc_id", "size", "source_size", "target", "taken"],
    "op3": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], "op4": ["doc_id", "held_out", "lang_pred", "score"],
    "op5": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op6": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op7": ["doc_id", "held_out", "score", "predicted"], "op8": ["pair_id", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"],
    "op9": ["doc_id", "n_shingles", "component_id", "kept"],
    "op10": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op11": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op13": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
}
ALL = list(QUERIES)


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.mark.parametrize("name", ALL)
def test_empty_table(spark, empty, name):
    df = QUERIES[name](spark, empty)
    assert df.columns[:len(COLUMNS[name.split("_")[0]])] == COLUMNS[name.split("_")[0]] or name.startswith("op8")
    assert set(COLUMNS[name.split("_")[0]]) <= set(df.columns)
    assert df.collect() == []


@pytest.mark.parametrize("name", ALL)
def test_odd_rows_have_results(spark, odd, name):
    df = QUERIES[name](spark, odd)
    n = spark.read.parquet(f"{odd}/documents.parquet").count()
    found = df.collect()
    if name.startswith("op8"):
        assert len(found) == 7  # two rows of no conversation
    elif name.startswith("op11"):
        assert len(found) == 6
    elif name.startswith("op12"):
        assert len(found) == 3 * 600
    elif name.startswith("op5"):
        assert len([r for r in found if r.piece == 0]) == n
    else:
        assert len(found) == n


@pytest.mark.parametrize("name", ALL)
def test_clashing_columns_change_nothing(spark, plain, clashing, name):
    drop = ("sequence_id", "offset")  # any numbers
    a, b = QUERIES[name](spark, plain), QUERIES[name](spark, clashing)
    assert a.columns == b.columns
    assert rows(a.drop(*drop)) == rows(b.drop(*drop))


@pytest.mark.parametrize("name", ["empty", "odd", "clashing"])
def test_pipeline_stages(spark, request, name):
    folder = request.getfixturevalue(name)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for stage, step in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(step(spark, docs, folder).collect(), docs.schema)
        assert docs.columns == columns, stage
    assert (docs.count() == 0) == (n == 0)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert (out.count() == 0) == (n == 0)
