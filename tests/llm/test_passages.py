"""Passages that repeat inside lines or over several, against all stretches of all texts."""

import random

from barforge.llm.substring_dedup import substring_dedup


def test_passages_wherever_they_stand(spark):
    rng = random.Random(21)
    make = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    wrap = lambda words, n: "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))
    inside, wrapped, line, short = make(60), make(70), make(55), make(45)
    texts = [(0, " ".join(make(33) + inside + make(20))), (1, " ".join(make(5) + inside + make(90)).upper())]
    texts += [(2, wrap(make(7) + wrapped, 12)), (3, wrap(make(30) + wrapped + make(9), 17))]
    texts += [(4, " ".join(line)), (5, " ".join(make(40)) + "\n" + " ".join(line))]
    texts += [(6, " ".join(short + make(50))), (7, " ".join(make(50) + short)), (8, "same " * 70), (9, None), (10, "")]
    texts += [(None, " ".join(make(8) + inside + make(8))), (None, " ".join(make(99))), (11, wrap(copy := make(80), 20)), (12, wrap(copy, 20))]
    rng.shuffle(texts)
    places = {}
    for k, (_, t) in enumerate(texts):
        w = (t or "").lower().split()
        for i in range(len(w) - 49):
            places.setdefault(tuple(w[i : i + 50]), []).append((k, i))
    want = {(texts[k][0], w, i + j) for w, at in places.items() for k, i in at for j in range(50) if len({x for x, _ in at}) > 1}
    want = {(d, place) for d, _, place in want}
    rows = substring_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    known = {d: (t or "").split("\n") for d, t in texts if d is not None}
    got = set()
    for r in rows:
        begin = r.word if r.word is not None else len(" ".join(known[r.doc_id][: r.paragraph]).split())
        got |= {(r.doc_id, begin + j) for j in range(r.words or len(known[r.doc_id][r.paragraph].split()))}
    assert got == want
    passages = sorted((str(r.doc_id), r.word, r.words, r.component_doc, r.component_word, r.kept) for r in rows if r.word is not None)
    assert passages == sorted([("0", 33, 60, 0, 33, True), ("1", 5, 60, 0, 33, False), ("None", 8, 60, 0, 33, False), ("2", 7, 70, 2, 7, True), ("3", 30, 70, 2, 7, False), ("4", 0, 55, 4, 0, True), ("5", 40, 55, 4, 0, False), ("11", 0, 80, 11, 0, True), ("12", 0, 80, 11, 0, False)])
    assert {(r.doc_id, r.paragraph) for r in rows if r.word is None} == {(4, 0), (5, 1)}
    assert next(r.paragraph for r in rows if r.doc_id == 3 and r.word is not None) == 1
    assert substring_dedup(spark.createDataFrame(texts[:1], "doc_id long, text string").limit(0)).collect() == []
