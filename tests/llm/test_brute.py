"""Lines, paragraphs and the k-d tree against plain Python over all pairs or all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.llm import linking
from barforge.llm.kd_sharding import kd_leaves
from barforge.llm.line_dedup import line_dedup
from barforge.llm.substring_dedup import substring_dedup


def classes(sets, num):
    """First member of each one's class, over all pairs."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if 100 * len(x & sets[j]) >= num * len(x | sets[j]) and x & sets[j]:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


def expected(places, sets, num):
    """(doc, place, first doc, first place, occurrences, kept) of classes of several."""
    first = classes(sets, num)
    size = {r: first.count(r) for r in first}
    return sorted((*places[i], *places[r], size[r], i == r) for i, r in enumerate(first) if size[r] > 1)


def edited(rng, units, rate, fresh):
    return [rng.choice(fresh) if rng.random() < rate else u for u in units]


@pytest.mark.parametrize("most", [8192, 6])
def test_lines(spark, monkeypatch, most):
    monkeypatch.setattr(linking, "MOST_NODES", most)
    monkeypatch.setattr(linking, "RARE", 10)
    rng = random.Random(41)
    letters = list("abcdefghijklmnopqrstuvwxyzé ")
    base = [[rng.choice(letters) for _ in range(rng.choice([3, 20, 90, 200]))] for _ in range(25)]
    docs = []
    for d in range(60):
        lines = ["".join(edited(rng, rng.choice(base), rng.choice([0, 0, 0.005, 0.01, 0.03]), letters)) for _ in range(rng.randint(0, 6))]
        docs.append((d, "\n".join(x for line in lines for x in (line, *[" "] * (rng.random() < 0.1)))))
    docs += [(60, None), (61, ""), (62, "\n\n")]
    rows = [((d, k), line) for d, t in docs for k, line in enumerate((t or "").split("\n")) if line.strip(" \t\x0b\x0c\r")]
    sets = [{line[i : i + 8] for i in range(max(1, len(line) - 7))} for _, line in rows]
    got = line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.line, r.component_doc, r.component_line, r.occurrences, r.kept) for r in got) == expected([p for p, _ in rows], sets, 80)


def test_paragraphs(spark):
    rng = random.Random(43)
    words = [f"w{i}" for i in range(500)]
    base = [[rng.choice(words) for _ in range(rng.choice([10, 35, 80, 150]))] for _ in range(15)]
    docs = [(d, "\n".join(" ".join(edited(rng, rng.choice(base), rng.choice([0, 0.005, 0.01, 0.02]), words)) for _ in range(rng.randint(0, 4)))) for d in range(70)]
    rows = [((d, k), line.split()) for d, t in docs for k, line in enumerate(t.split("\n")) if len(line.split()) >= 30]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, w in rows]
    got = substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).filter("word is null").collect()
    assert sorted((r.doc_id, r.paragraph, r.component_doc, r.component_paragraph, r.occurrences, r.kept) for r in got) == expected([p for p, _ in rows], sets, 80)


def test_tree_of_weighted_medians(spark):
    rng = np.random.default_rng(8)
    n = 700
    points = [(int(t), int(w), float(x), float(y)) for t, w, x, y in zip(rng.integers(0, 1 << 32, n), rng.integers(1, 5000, n), rng.random(n) ** 3, rng.integers(0, 4, n) / 4, strict=True)]
    got = {r.tie: r.leaf for r in kd_leaves(spark.createDataFrame(points, "tie long, weight long, x0 double, x1 double"), 4).collect()}

    def cut(rows, leaf, depth):
        if depth == 0:
            return {r[0]: leaf for r in rows}
        spread = [max(r[a] for r in rows) - min(r[a] for r in rows) for a in (2, 3)]
        axis = 2 + int(spread[1] > spread[0])
        placed = sorted((((int(r[axis] * ((1 << 28) - 1)) << 32) + r[0]) >> 12, r) for r in rows)
        total, upto, at = sum(r[1] for r in rows), 0, None
        for place, r in placed:
            upto += r[1]
            if 2 * upto >= total:
                at = place
                break
        left, right = [r for p, r in placed if p <= at], [r for p, r in placed if p > at]
        return cut(left, 2 * leaf, depth - 1) | (cut(right, 2 * leaf + 1, depth - 1) if right else {})

    assert got == cut(points, 0, 4)
    assert kd_leaves(spark.createDataFrame(points, "tie long, weight long, x0 double, x1 double").limit(0), 2).agg(F.count("*")).first()[0] == 0
