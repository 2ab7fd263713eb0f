"""The limits of a group say how its pairs are found, not which are."""

import random

import numpy as np
import pyarrow as pa
import pytest

from barforge.llm import line_dedup, linking
from barforge.llm.words import MinHash

SEED, ROWS, BANDS = 9, 4, 3


def chained():
    """Lines edited step by step: neighbours in the chain are near 0.8, so that few bands are often missed."""
    rng = random.Random(12)
    texts = []
    for _ in range(4):
        line = [rng.choice("abcdefghijklmnop") for _ in range(400)]
        for _ in range(30):
            line = list(line)
            for at in rng.sample(range(400), rng.choice((3, 4, 5, 6))):
                line[at] = rng.choice("qrstuvwxyz")
            texts.append("".join(line))
    return texts


def rooted(n, pairs):
    root = list(range(n))
    for i, j in pairs:
        a, b = sorted((root[i], root[j]))
        root = [a if r == b else r for r in root]
    return root


def pairs_of(texts):
    """(links that share a band of the signature, links that share none), by brute force."""
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in texts]
    sigs = (line_dedup.line_signer(MinHash(BANDS, ROWS, SEED))(pa.array(texts))[1] & 0xFF).reshape(len(texts), BANDS, ROWS)
    with_band, without = [], []
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                (with_band if (sigs[i] == sigs[j]).all(axis=1).any() else without).append((i, j))
    return with_band, without


@pytest.fixture
def few_bands(monkeypatch):
    monkeypatch.setattr(line_dedup, "BANDS", BANDS)
    monkeypatch.setattr(line_dedup, "ROWS", ROWS)


# nodes that one task takes, times that a bucket may have: small groups, buckets, shingles written down
@pytest.mark.parametrize(("most", "larger"), [(8192, 4), (6, 4), (6, 0)])
def test_rows_do_not_depend_on_the_limits(spark, monkeypatch, few_bands, most, larger):
    monkeypatch.setattr(linking, "MOST_NODES", most)
    monkeypatch.setattr(linking, "LARGER", larger)
    monkeypatch.setattr(linking, "RARE", 4)
    texts = chained()
    with_band, without = pairs_of(texts)
    expected = rooted(len(texts), with_band)
    assert without and expected != rooted(len(texts), with_band + without)  # the rule decides something here
    found = line_dedup.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: r.component_doc for r in found}
    assert [got.get(i, i) for i in range(len(texts))] == expected


def test_allowed_asks_two_signatures_alone():
    rng = np.random.default_rng(3)
    for values, n in ((2, 40), (4, 200), (200, 60)):  # dense and thin
        sigs = rng.integers(0, values, (n, 12)).astype(np.uint8)
        same = sigs[:, None] == sigs[None]
        plain = same.reshape(n, n, 4, 3).all(axis=-1).any(axis=-1) & (same.sum(axis=-1) >= 5)
        met = linking.allowed(sigs, 3, 5)
        assert (met(0, n) == plain).all() and (met(7, 20) == plain[7:20, 7:]).all()
