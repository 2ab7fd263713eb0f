"""Null and repeated ids in the pipeline's stages that remove lines and documents."""

import random

import corpus_pipeline
import pytest
from barforge.llm.line_dedup import without_repeated_lines


@pytest.mark.parametrize("most", [1 << 20, -1])
def test_null_and_repeated_ids(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr("barforge.llm.shared.BROADCAST_BYTES", most)
    rng = random.Random(31)
    make = lambda: " ".join("".join(rng.choice("abcdefghijk") for _ in range(6)) for _ in range(14))
    shared, a, b, c, d, e = (make() for _ in range(6))
    rows = [(1, shared), (None, f"{shared}\n{a}"), (None, f"{b}\n{shared}"), (None, c), (7, f"{d}\n{shared}"), (7, e), (None, None)]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    left = without_repeated_lines(docs)
    assert left.columns == docs.columns
    want = [(1, shared), (None, a), (None, b), (None, c), (7, d), (7, e), (None, None)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, want))
    rows = [(None, f"{a} {b}"), (None, f"{a} {b}"), (None, f"{a} {b} more"), (3, c), (3, d), (4, c), (None, c), (5, None), (None, "")]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    got = corpus_pipeline.near_copies(spark, docs, str(tmp_path)).collect()
    assert len(got) == 5 and {(r.doc_id, r.text) for r in got if r.doc_id} == {(3, c), (3, d), (5, None)}
    assert sum(r.doc_id is None and (r.text or "").startswith(a) for r in got) == 1


def test_columns_with_the_names_that_joins_add(spark, tmp_path):
    names = ["_gone", "_key", "_row", "_h", "_doc", "_text", "_same", "_maybe", "_word", "_bits", "_bit", "bucket", "blob", "id", "h", "n", "kept"]
    rng = random.Random(33)
    make = lambda: " ".join("".join(rng.choice("abcdefghijk") for _ in range(6)) for _ in range(14))
    a, b, c = make(), make(), make()
    rows = [(1, f"{a}\n{b}"), (2, f"{a}\n{b}"), (3, f"{c}\n{a}")]
    docs = spark.createDataFrame([(i, t, *(x + str(i) for x in names)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{x} string" for x in names))
    left = without_repeated_lines(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r["_gone"], r["id"]) for r in left] == [(1, f"{a}\n{b}", "_gone1", "id1"), (3, c, "_gone3", "id3")]
    kept = corpus_pipeline.near_copies(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted((r.doc_id, r["_key"]) for r in kept.collect()) == [(1, "_key1"), (3, "_key3")]
    assert without_repeated_lines(docs.limit(0)).collect() == [] and corpus_pipeline.near_copies(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_repeated_rows_and_null_ids_in_the_other_stages(spark, tmp_path):
    rng = random.Random(35)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijk") for _ in range(6)) for _ in range(n))
    good, item = make(70), make(25)
    rows = [(1, good), (1, good), (1, "short"), (None, good), (None, None), (2, f"{good} {item}"), (2, f"{good} {item}"), (None, f"{item} {good}")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(0, item), (None, make(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == ["1", "1", "2", "2", "None", "None"]
    clean = corpus_pipeline.benchmark_free(spark, left, str(tmp_path))
    assert clean.columns == docs.columns and sorted(str(r.doc_id) for r in clean.collect()) == ["1", "1", "None"]
    packed = corpus_pipeline.packed(spark, clean, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in packed) == ["1", "1", "None"] and len({(r.sequence_id, r.offset) for r in packed}) == 3
    spark.createDataFrame([(0, item)], "item_id long, text string").limit(0).write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.benchmark_free(spark, docs, f"{tmp_path}/none").count() == len(rows)
    for stage in (corpus_pipeline.quality, corpus_pipeline.benchmark_free, corpus_pipeline.packed):
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
