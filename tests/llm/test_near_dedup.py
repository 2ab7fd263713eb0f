"""Near-duplicates against brute force over all pairs, on either way through a group."""

import random

import pytest

from barforge.llm import linking
from barforge.llm.near_dedup import near_duplicates
from barforge.llm.substring_dedup import substring_dedup
from barforge.llm.line_dedup import line_dedup, without_repeated_lines


def sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, num):
    known = [(d, sets(t)) for d, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, x) in enumerate(known):
        for j in range(i):
            y = known[j][1]
            if x and y and 100 * len(x & y) >= num * len(x | y):
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(known):
        groups.setdefault(find(i), []).append(d)
    return sorted((d, len(x), min(groups[find(i)])) for i, (d, x) in enumerate(known))


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(140)]
    rows = []
    for _ in range(70):  # edited copies, some of copies
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
            text[rng.randrange(len(text))] = rng.choice(words)
        if rng.random() < 0.2:
            text = text[: rng.randint(100, 140)]
        rows.append(" ".join(text))
    for _ in range(12):  # second-hand copies share edits
        text = rows[rng.randrange(70)].split()
        text[rng.randrange(len(text))] = "fresh"
        rows.append(" ".join(text))
    rows += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(30)]
    rows += [rows[3].upper(), rows[3], "  " + rows[3].replace(" ", "\n\t"), "", None, " \n", "one two", "ONE two", "one two three four"]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("most", [512, 8])
def test_against_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(linking, "MOST_NODES", most)
    monkeypatch.setattr(linking, "RARE", 20)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, id string, h string")
    got = near_duplicates(docs, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_nulls_repeats_and_empty(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (9, text), (None, None), (1, "")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_duplicates(docs).collect())
    assert got == sorted([("None", 4, "4", False), ("4", 4, "4", True), ("4", 4, "4", True), ("9", 4, "4", False), ("None", 0, "None", False), ("1", 0, "1", True)])
    assert near_duplicates(docs.limit(0)).collect() == []


def test_paragraphs_that_repeat(spark):
    rng = random.Random(3)
    make = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    passage = make(60)
    edited = passage.split()
    edited[30] = "other"
    docs = [(0, make(50) + "\n" + passage), (1, passage + "\n" + make(20)), (2, make(40) + "\n" + " ".join(edited)), (3, make(80)), (4, "short one\nshort one"), (5, None), (6, "")]
    got = substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.paragraph, r.component_doc, r.kept) for r in got if r.word is None) == [(0, 1, 0, True), (1, 0, 0, False), (2, 1, 0, False)]
    assert sorted((r.doc_id, r.paragraph, r.words) for r in got if r.word is not None) == [(0, 1, 60), (1, 0, 60)]


def test_lines_that_repeat(spark):
    rng = random.Random(4)
    make = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(14))
    line, own = make(), [make() for _ in range(4)]
    changed = line[:40] + "X" + line[41:]
    docs = [(0, f"{own[0]}\n{line}", 5), (1, f"{line}\n\n{own[1]}", 5), (2, changed, 5), (3, f"{own[2]}\n{own[3]}\n{own[2]}", 5), (4, None, 5), (5, "", 5), (6, "é\né", 5)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, n_chars long")
    got = sorted((r.doc_id, r.line, r.component_doc, r.kept) for r in line_dedup(docs).collect())
    assert got == [(0, 1, 0, True), (1, 0, 0, False), (2, 0, 0, False), (3, 0, 3, True), (3, 2, 3, False), (6, 0, 6, True), (6, 1, 6, False)]
    left = {r.doc_id: r.text for r in without_repeated_lines(docs).collect()}
    assert left == {0: f"{own[0]}\n{line}", 1: f"\n{own[1]}", 3: f"{own[2]}\n{own[3]}", 4: None, 5: "", 6: "é"}
    assert without_repeated_lines(docs).columns == docs.columns
