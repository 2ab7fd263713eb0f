"""Recall of decontamination at the operator's own limit, against exact distances."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from barforge.llm.decontamination import MOST_EDITS, Items, infix_distance, least_distances, plain, streams


@pytest.mark.parametrize(("rate", "least"), [(0.1, 0.98), (0.15, 0.98), (0.18, 0.95), (0.2, 0.95)])
def test_recall_of_scattered_edits(rate, least):
    rng = random.Random(17)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n))
    texts = [make(rng.randint(15, 59)) for _ in range(200)]
    items, edited, within = Items(list(enumerate(texts))), [], []
    for k, t in enumerate(texts):
        change = "".join(rng.choice(["", c + rng.choice("xyz"), rng.choice("xyzé")]) if rng.random() < rate else c for c in t)
        edited.append(f"{make(40)} {change} {make(40)}")
        known = items.texts[k]
        within.append(infix_distance(known, plain(edited[-1])) <= MOST_EDITS * len(known))
    found = [k in x for k, x in enumerate(items.scan(pa.array(edited)))]
    assert sum(within) >= 50 and not any(f and not w for f, w in zip(found, within, strict=True))
    assert sum(found) >= least * sum(within)


def test_pieces_bound_the_distance():
    rng = random.Random(2)
    make = lambda n: "".join(rng.choice("abcé") for _ in range(n))
    patterns, texts = [make(rng.randint(1, 150)) for _ in range(60)], [make(rng.randint(0, 200)) for _ in range(60)]
    for p, t, n in zip(patterns, texts, least_distances(patterns, texts).tolist(), strict=True):
        exact = infix_distance(p, t)
        assert n <= exact and (len(p) > 64 or n == exact)


def test_windows_of_any_reach_are_walked_alike():
    rng = random.Random(23)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n))
    texts = [make(n) for n in (3, 20, 60, 200)]
    items = Items(list(enumerate(texts)))
    data, begin = streams(pa.array([f"{make(30)} {t} {make(9)}" for t in texts] + [texts[1], make(50), "a"]))
    for grams in items.grams:
        place, target = grams.hits(data)
        owner = np.searchsorted(begin, place, side="right") - 1
        inside = place + grams.size <= begin[owner + 1]
        place, target, owner = place[inside], target[inside], owner[inside]
        at = place, target, begin[owner], begin[owner + 1]
        assert len(place) and (items.walked(data, *at) == items.sampled(items.windows(data, *at), target)).all()


def test_long_items_take_bounded_memory():
    rng = random.Random(29)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n))
    long = make(7000)
    items = Items([(1, long), (2, make(30))])
    assert len(long) > 40_000
    docs = pa.array([f"{make(20)} {long} {make(20)}" if k % 2 else make(8000) for k in range(30)])
    tracemalloc.start()
    found = items.scan(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x.get(0) for x in found] == [0 if k % 2 else None for k in range(30)] and peak < 150 << 20


def test_all_items_against_all_texts():
    """Whatever is found is right, and what is not found lies beyond the limit or is one of few."""
    rng = random.Random(31)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n))
    texts = [make(rng.randint(2, 40)) for _ in range(40)]
    texts += [texts[3], texts[4] + " more", " ".join(texts[5].split()[3:])]  # items like others
    items = Items(list(enumerate(texts)))
    docs = []
    for _ in range(60):
        t = rng.choice(texts)
        change = "".join(rng.choice(["", c, "x"]) if rng.random() < rng.choice([0, 0.1, 0.3]) else c for c in t)
        docs.append(f"{make(rng.randint(0, 30))} {change} {make(rng.randint(0, 30))} {rng.choice(texts) if rng.random() < 0.3 else ''}")
    found, lost, there = items.scan(pa.array(docs)), 0, 0
    for doc, own in zip(docs, found, strict=True):
        text = plain(doc)
        for k, t in enumerate(items.texts):
            exact = infix_distance(t, text)
            within = exact <= MOST_EDITS * len(t)
            there += within
            lost += within and k not in own
            assert k not in own or (within and own[k] == exact)
    assert there > 60 and lost <= 0.05 * there
