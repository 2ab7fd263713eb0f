"""Packed shuffles, sieves, hot keys and groups in blocks of rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barforge.llm import packed
from barforge.llm.linking import BAND, components_in_memory, meet, roots_in_memory, roots_of_groups, whole_groups
from barforge.llm.near_dedup import word_shingler
from barforge.llm.shared import parted, sieved

KIND = np.dtype([("k", "<u8"), ("v", "<i4")])


def test_records_come_back_by_bucket(monkeypatch):
    monkeypatch.setattr(packed, "HELD_BYTES", 4000)
    rng = np.random.default_rng(3)
    records = np.zeros(5000, KIND)
    records["k"], records["v"] = rng.integers(0, 300, 5000), np.arange(5000)
    packer, rows = packed.Packer("k", 16), []
    for part in np.array_split(records, 37):
        if packer.add(part):
            rows += list(zip(*(c.to_pylist() for c in packer.out()), strict=True))
    rows += list(zip(*(c.to_pylist() for c in packer.out()), strict=True))
    assert packer.out() is None
    rows.sort(key=lambda r: r[0])
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in x], pa.int32()), pa.array([r[1] for r in x], pa.binary())], names=["bucket", "blob"]) for x in (rows[:5], rows[5:6], rows[6:])]
    buckets = list(packed.whole_buckets(iter(batches), KIND))
    assert sorted(np.concatenate(buckets)["v"].tolist()) == list(range(5000))
    keys = [set(b["k"].tolist()) for b in buckets]
    assert len(keys) <= 16 and sum(map(len, keys)) == len(set.union(*keys))  # no key is in two buckets
    most = max(len(b) for b in packed.whole_buckets(iter(batches), KIND, lambda x: x[np.unique(x["k"], return_index=True)[1]]))
    assert most < max(map(len, buckets))
    assert list(packed.whole_buckets(iter([]), KIND)) == [] and len(packed.blobs(records[:0], "k", 16)[0]) == 0


def test_a_hot_key_shrinks_to_what_does_not_agree():
    records = np.zeros(9000, BAND)
    records["key"], records["h"] = 32, np.arange(9000)
    records["sketch"] = np.where(np.arange(9000) % 3 == 0, 0, 0x1111111111111111 * np.uint64(7)).astype(np.uint64)
    links, left = meet(records)
    assert len(left) == 1 and len(links) == 8999  # beyond STRETCH all are joined to the first
    links, left = meet(records[:900])
    assert sorted(left["h"].tolist()) == [0, 1] and {tuple(x) for x in links.tolist()} == {(i, int(i % 3 > 0)) for i in range(2, 900)}
    links, left = meet(np.concatenate((records[:2], records[:2])))
    assert sorted(map(tuple, links.tolist())) == [(0, 0), (1, 1)] and len(left) == 2
    assert len(meet(records[:0])[0]) == 0


def test_sieves_pass_all_that_is_wanted(spark):
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("h"))
    keys = rows.filter("id % 50 = 7").select("h")
    got = {r.id for r in sieved(rows, keys, "h").collect()}
    assert {i for i in range(20_000) if i % 50 == 7} <= got and len(got) < 450
    maybe, others = parted(rows, keys, "h")
    assert {r.id for r in maybe.collect()} == got and {r.id for r in others.collect()} == set(range(20_000)) - got
    assert sieved(rows, keys.limit(0), "h").count() == 0 and parted(rows, keys.limit(0), "h")[1].count() == 20_000


def test_groups_many_at_once():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(200)]
    rows, want = [], []
    for g in range(60):
        base = rng.choice(words, 60).tolist()
        for _ in range(int(rng.choice([1, 2, 3, 7, 20]))):
            text = list(base)
            for _ in range(int(rng.integers(0, 5))):
                text[int(rng.integers(0, 60))] = str(rng.choice(words))
            rows.append((g, " ".join(text)))
    sets = [set(word_shingler(pa.array([t]))[0].tolist()) for _, t in rows]
    linked = [[i == j or (rows[i][0] == rows[j][0] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])) for j in range(len(rows))] for i in range(len(rows))]
    linked = np.array(linked)
    want = components_in_memory(len(rows), lambda low, high: linked[low:high, low:].copy(), 7)
    table = pa.table({"g": [g for g, _ in rows], "sig": [b"\0"] * len(rows), "text": [t for _, t in rows]})
    got = []
    for part in whole_groups(iter(table.to_batches(max_chunksize=9))):
        got += (roots_of_groups(part, word_shingler, 80, 100) + len(got)).tolist()
    assert got == want.tolist()
    assert roots_in_memory([np.array([1], np.uint64)] * 3, 80, 100).tolist() == [0, 0, 0]
