"""Every stage of the pipeline against plain Python over its own input."""

import random

import corpus_pipeline
from barforge.llm.shared import stash

from test_near_dedup import brute


def test_stages(spark, tmp_path):
    rng = random.Random(12)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 8))) for _ in range(n))
    item, shared = make(30), make(25)
    texts = [f"{make(60)}\n{make(60)}" for _ in range(12)]
    texts += [texts[0], texts[1].replace(" ", "  ", 1)]  # copies, one of them not quite
    texts += [f"{make(40)} {item} {make(40)}", "too short", None, "", f"{make(70)}\n{shared}", f"{make(70)}\n{shared}"]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stash(stage(spark, kept[-1], str(tmp_path)), name))
        if name != "packing":
            assert kept[-1].columns == docs.columns
    rows = [{r.doc_id: r.text for r in d.collect()} for d in kept[:-1]]
    assert rows[0].keys() - rows[1].keys() == {15, 16, 17}
    assert rows[1].keys() - rows[2].keys() == {12, 13}  # all their lines are in documents 0 and 1
    assert rows[2][18] == texts[18] and rows[2][19] == texts[19].split("\n")[0] and rows[2][3] == texts[3]
    want = {c for _, _, c in brute(sorted(rows[2].items()), 80)}
    assert rows[3].keys() == want
    assert rows[3].keys() - rows[4].keys() == {14}
    packed = kept[-1].collect()
    assert {r.doc_id for r in packed} == rows[4].keys()
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in again) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)
