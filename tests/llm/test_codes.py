"""Vector codes against plain Python, with ties, repeated entries and missing components."""

import hashlib
import math
import random

import numpy as np
import pytest

from barforge.llm.queries import op13_vector_codes
from barforge.llm.vector_codes import EntryTree, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, rounds=6):
    kept = [(i, [math.floor(4096 * float(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    step = len(kept[0][1]) // 8
    cut = lambda v: [v[p * step : p * step + step] for p in range(8)]
    parts = [cut(v) for _, v, _ in kept]
    books = [[parts[e][p] for e in range(min(16, len(kept)))] for p in range(8)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda x, book: min((gap(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            own = {}
            for x in parts:
                own.setdefault(near(x[p], books[p])[1], []).append(x[p])
            for k, xs in own.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by = [], {}
    for (i, _, lab), x in zip(kept, parts, strict=True):
        found = [near(x[p], books[p]) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
        by[lab] = by.get(lab, 0) + out[-1][2]
    return sorted(((i, c, e, by[lab], sha) for i, c, e, lab in out), key=str)


def got(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "n", "width"), [(1, 300, 16), (2, 9, 8), (3, 120, 64)])
def test_against_plain_python(spark, seed, n, width):
    rng = random.Random(seed)
    few = [-1.5, -0.25, 0.0, 0.125, 1e-5, -1e-5, 3.0]  # many ties and equal parts
    rows = [(k, [rng.choice(few) if seed != 3 else rng.gauss(0, 1) for _ in range(width)], rng.choice([None, 1, 2])) for k in range(n)]
    rows += [(3, rows[2][1], 1), (None, rows[1][1], None), (n, None, 1), (n + 1, [None] * width, 1), (n + 2, [math.nan] * width, 2), (n + 3, [math.inf] + [0.0] * (width - 1), 2)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    rng.shuffle(rows)
    assert got(vector_codes(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert got(op13_vector_codes(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_entries_by_branch_and_bound():
    rng = np.random.default_rng(4)
    for spread in (3, 5000, 1 << 27):
        entries = rng.integers(-spread, spread, (16, 8))
        entries[5] = entries[11] = entries[2]
        points = np.concatenate([rng.integers(-spread, spread, (2000, 8)), entries, (entries[:8] + entries[8:]) // 2])
        gaps = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        entry, best = EntryTree(entries).nearest(points)
        assert (best == gaps.min(axis=1)).all() and (entry == gaps.argmin(axis=1)).all()


def test_empty_lengths_and_clashing_columns(spark):
    assert vector_codes(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(k, [float(k % 5)] * 8, 1) for k in range(40)]
    odd = [(90, [1.0] * 16, 1), (91, [], 1)]
    wide = spark.createDataFrame([(*r, *"12345") for r in rows + odd], f"{SCHEMA}, code string, ints string, vector string, _label string, error string")
    assert got(vector_codes(wide)) == brute(rows)
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([(1, [1.0] * 9, 1)], SCHEMA))
