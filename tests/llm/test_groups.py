"""Groups beyond the limits that chance collisions chain together; blobs that go before the rest."""

import os
import random

import pyarrow as pa
from test_near_dedup import brute

from barforge.llm import linking, packed
from barforge.llm.line_dedup import char_shingles, line_dedup, without_repeated_lines
from barforge.llm.near_dedup import near_duplicates
from barforge.llm.shared import discard, shared_folder, stash_apart


def test_a_chained_group_is_settled_by_its_buckets(spark, monkeypatch):
    """Its texts' shingles, hundreds for each, are not written down; no link is lost."""
    monkeypatch.setattr(linking, "MOST_NODES", 30)
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(2400)]
    texts = [" ".join(words[i : i + 200]) for i in range(0, 2200, 30)]  # neighbours at 0.73
    for i in (3, 20, 41):
        copy = texts[i].split()
        copy[100] = "other"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    sizes, large = [], linking._by_bucket if hasattr(linking, "_by_bucket") else None

    def seen(members, *rest):
        sizes.append(members.count())
        return large(members, *rest)

    monkeypatch.setattr(linking, "_by_bucket", seen, raising=False)
    monkeypatch.setattr(linking, "_large", lambda *_: (_ for _ in ()).throw(AssertionError("shingles written down")))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 85)
    assert sizes and sizes[0] > 30


def test_either_part_goes_by_itself(spark):
    rows = spark.range(100).selectExpr("id", "case when id % 3 = 0 then id end as own")
    without, others = stash_apart(rows, "parts", "own")
    assert (without.count(), others.count()) == (66, 34)
    discard(others)
    assert not os.path.exists(others._barforge_path.removeprefix("file://"))
    assert without.count() == 66 and without.columns == rows.columns
    none, all_of_them = stash_apart(rows.filter("own is not null"), "parts", "own")
    assert none.isEmpty() and all_of_them.count() == 34


def test_the_stage_of_lines_takes_chained_groups(spark, monkeypatch):
    monkeypatch.setattr(linking, "MOST_NODES", 30)
    monkeypatch.setattr(linking, "_large", lambda *_: (_ for _ in ()).throw(AssertionError("shingles written down")))
    rng = random.Random(6)
    run = "".join(rng.choice("abcdefghij ") for _ in range(3000))
    lines = [run[i : i + 200].replace(" ", "k") for i in range(0, 2700, 30)]  # neighbours at 0.73
    copy = lines[7][:100] + "X" + lines[7][101:]
    docs = spark.createDataFrame([(0, "\n".join(lines)), (1, f"{copy}\nown line")], "doc_id long, text string")
    left = {r.doc_id: r.text for r in without_repeated_lines(docs).collect()}
    assert left == {0: "\n".join(lines), 1: "own line"}


def tables(spark, label):
    folder = shared_folder(spark).removeprefix("file://")
    return {x for x in os.listdir(folder) if x.startswith(f"barforge-{label}-")}


def test_blobs_go_part_by_part(spark, monkeypatch):
    """While a part is dealt out, those before it are gone; rows are those of a single pass."""
    rng = random.Random(8)
    make = lambda: "".join(rng.choice("abcdefghij ") for _ in range(90))
    lines = [make() for _ in range(60)]
    lines += [x[:40] + "X" + x[41:] for x in lines[:20]] + lines[30:50]
    docs = spark.createDataFrame([(i, "\n".join(lines[i::5])) for i in range(5)], "doc_id long, text string")
    whole = sorted(map(tuple, line_dedup(docs).collect()))
    monkeypatch.setattr(packed, "PASS_PARTITIONS", 1)
    sizes, links = [], linking.bucket_links

    def seen(blobs):
        folder = os.path.dirname(blobs._barforge_path.removeprefix("file://"))
        sizes.append((sum(x != "_apart=-1" for x in os.listdir(folder) if x.startswith("_apart=")), blobs.count()))
        return links(blobs)

    monkeypatch.setattr(linking, "bucket_links", seen)
    assert sorted(map(tuple, line_dedup(docs).collect())) == whole and whole
    assert [n for n, _ in sizes] == [4, 3, 2, 1] and all(n for _, n in sizes)


def test_the_stage_of_lines_leaves_no_table_of_lines(spark):
    before = {x: tables(spark, x) for x in ("lines", "links", "met", "named")}
    docs = spark.createDataFrame([(0, "a line that stands twice\nanother"), (1, "a line that stands twice\nthird")], "doc_id long, text string")
    left = {r.doc_id: r.text for r in without_repeated_lines(docs).collect()}
    assert left == {0: "a line that stands twice\nanother", 1: "third"}
    folder = shared_folder(spark).removeprefix("file://")
    for x, known in before.items():  # of lines the folder itself stays, empty
        assert not [f for t in tables(spark, x) - known for _, _, fs in os.walk(f"{folder}/{t}") for f in fs if f.endswith(".parquet")]


def test_a_bucket_beyond_the_limits_is_settled_by_blocks(spark, monkeypatch):
    """Edited copies of one line and lines that are not linked, all in common buckets."""
    monkeypatch.setattr(linking, "MOST_NODES", 20)
    monkeypatch.setattr(linking, "MOST_SHINGLES", 4000)
    monkeypatch.setattr(linking, "_large", lambda *_: (_ for _ in ()).throw(AssertionError("shingles written down")))
    rng = random.Random(7)
    line = [rng.choice("abcdefghij") * 2 + rng.choice("klmnop") for _ in range(60)]
    texts = []
    for _ in range(45):
        copy = list(line)
        for at in rng.sample(range(60), rng.choice((1, 2, 3, 9))):
            copy[at] = rng.choice("uvwxyz") * 3
        texts.append(" ".join(copy))
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in texts]
    root = list(range(45))
    for i in range(45):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert len(set(root)) > 3
    found = line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: r.component_doc for r in found}
    assert [got.get(i, i) for i in range(45)] == root
    blocks = linking.roots_by_blocks(pa.chunked_array([texts]), char_shingles, 80, 100)
    assert blocks.tolist() == root
