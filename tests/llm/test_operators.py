"""The other training-data operators against brute force, round trips and edge cases."""

import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barforge.llm.decontamination import infix_distance, leaks, without_leaks
from barforge.llm.kd_sharding import kd_shards
from barforge.llm.license_scan import TELLING, TEMPLATES, Template, by_license, license_scan, longest_increasing, notices, patience, words_of
from barforge.llm.oracles import QUALITY
from barforge.llm.packing import best_fit, pack
from barforge.llm.quality_rules import keep_good, quality_rules
from barforge.llm.token_counts import PrefixCounts, token_counts
from barforge.llm.token_shards import ShardReader, ShardWriter, read_shards, write_shards
from barforge.llm.tokens import ChunkEncoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def docs(spark, texts, sources=None):
    return spark.createDataFrame([(i if t != "no id" else None, t, "en", sources[i] if sources else "s", 0, "x") for i, t in enumerate(texts)], SCHEMA)


def odd_texts(n=300, seed=2):
    rng = random.Random(seed)
    bits = ["a", "b", "É", "é", "́", " ", "  ", "\n", "\n\n", "\t", "\xa0", "　", "<|endoftext|>", "'s", "'S", "1", "23", ".", "!!", "ß", "Σ", "σΑΣ ", "İ", "가", "foo", "Étoile", "über.", "naïve!?", "\x1c", "\x00", "\r\n", "🙂", "Foo,"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_those_of_whole_texts(path):
    texts = odd_texts(2000)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in ChunkEncoder(path).encode(pa.array(texts))] == want


def test_chunks_are_forgotten_but_not_ids(monkeypatch):
    monkeypatch.setattr("barforge.llm.tokens.MOST_CHUNKS", 5)
    own, whole = ChunkEncoder(WORD), Tokenizer.from_file(WORD)
    for text in ("one two three four", "five six seven eight nine ten eleven", "one six", ""):
        assert own.encode(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def brute_counts(text):
    w, text = (text or "").encode().split(), text or ""
    words = [x.decode() for x in w]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_hosts(spark):
    rng = random.Random(1)
    texts = odd_texts(60) + [" ".join(rng.choice("abcde") for _ in range(n)) for n in (3, 4, 49, 50, 80)] + [None, "", "x y z x y z\nx y z\n\nx y z"]
    good = " ".join(f"w{i}" for i in range(60))
    texts += [good] * 40 + ["bad"] * 400
    sources = ["odd"] * (len(texts) - 440) + ["fine"] * 39 + ["foul"] * 401
    got = sorted(quality_rules(docs(spark, texts, sources)).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got] == [brute_counts(t) for t in texts]
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    verdicts = Counter((sources[r.doc_id], r.base_failed, r.host_rejected, r.kept) for r in got)
    assert verdicts["fine", False, False, True] == 39 and verdicts["foul", False, True, False] == 1 and verdicts["foul", True, False, False] == 400
    left = keep_good(docs(spark, texts, sources))
    assert left.columns == [c.split()[0] for c in SCHEMA.split(", ")] and {r.doc_id for r in left.collect()} == {r.doc_id for r in got if r.kept}
    assert quality_rules(docs(spark, texts).limit(0)).collect() == []
    nowhere = docs(spark, [good, None, "x"]).withColumn("source", pytest.importorskip("pyspark.sql.functions").lit(None).cast("string"))
    assert sorted(r.kept for r in quality_rules(nowhere).collect()) == [False, False, True]


def brute_infix(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edit_distance_within():
    rng = random.Random(5)
    for _ in range(300):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert infix_distance(p, t * 3) == brute_infix(p, t * 3)


def test_leaks(spark):
    rng = random.Random(8)
    make = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n))
    items = [make(rng.randint(15, 60)) for _ in range(20)]
    texts, planted = [], set()
    for i in range(120):
        body = [make(rng.randint(0, 80)), make(rng.randint(0, 80))]
        k = i % 20
        item = items[k]
        if i < 40:
            texts.append(f"{body[0]} {item} {body[1]}")
        elif i < 80:  # an edit in about every twentieth character, other case and line ends
            edited = "".join(rng.choice(["", "zz", "q"]) if rng.random() < 0.05 else c for c in item)
            texts.append(f"{body[0]}\n{edited.upper().replace(' ', chr(10), 2)}. {body[1]}")
        else:
            texts.append(" ".join(body))
            continue
        planted.add((i, k))
    texts += [None, "", "no id"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(90, None, "x"), (91, "", "x"), (None, "nothing of the kind stands anywhere here", "x")], "item_id long, text string, doc_id string")
    found = leaks(docs(spark, texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted
    assert all(r.distance == 0 for r in found if r.doc_id < 40)
    assert {r.doc_id for r in without_leaks(docs(spark, texts), bench).collect()} == {*range(80, 122), None}
    assert leaks(docs(spark, texts), bench.limit(0)).collect() == [] and leaks(docs(spark, texts).limit(0), bench).collect() == []


def test_packing(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([1, 5, 40, 300, 2500]))) for _ in range(120)] + [None, "", "no id", "x " * 5000]
    got = pack(docs(spark, texts), WORD).collect()
    whole = Tokenizer.from_file(WORD)
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts) if t != "no id"}
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id is not None:
            by_doc.setdefault(r.doc_id, []).append(r)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert by_doc.keys() == ids.keys()
    for d, rows in by_doc.items():
        at = 0
        for k, r in enumerate(sorted(rows, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (r.length == 4096 or r.start + r.length == len(ids[d]))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[d][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[d])
    assert len(by_seq) <= 1.02 * sum(r.length for r in got) / 4096 + 1
    assert pack(docs(spark, texts).limit(0), WORD).collect() == []


def test_every_capacity_binds_through_pack(spark):
    rng = random.Random(16)
    rows = docs(spark, [" ".join("word" for _ in range(rng.choice([1, 3, 9, 30]))) for _ in range(200)])
    for most_docs, most_attention in ((3, None), (None, 64 * 64), (4, 64 * 70)):
        got = {}
        for r in pack(rows, WORD, capacity=64, most_docs=most_docs, most_attention=most_attention).collect():
            got.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for own in got.values():
            assert sorted(o for o, _ in own) == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
            assert sum(n for _, n in own) <= 64 and len(own) <= (most_docs or 64) and sum(n * n for _, n in own) <= (most_attention or 64 * 64)


def test_every_capacity_binds():
    lengths = np.array([10] * 30 + [50] * 6)
    for docs_, attention in ((4, 10_000), (100, 10_000), (100, 3000)):
        bins, offsets = best_fit(lengths, 100, docs_, attention)
        for b in set(bins.tolist()):
            own = lengths[bins == b]
            assert own.sum() <= 100 and len(own) <= docs_ and (own**2).sum() <= attention
            assert sorted(offsets[bins == b].tolist()) == sorted(set(offsets[bins == b].tolist()))


def test_shards(spark, tmp_path, monkeypatch):
    texts = [*odd_texts(200), "", None, "no id"]
    rows = docs(spark, texts).unionAll(docs(spark, ["repeated"]))
    whole = Tokenizer.from_file(BYTE)
    ids = lambda t: [*whole.encode(t or "", add_special_tokens=False).ids, 0]
    manifest = write_shards(rows, BYTE, 0)
    got = sorted(read_shards(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id is None for r in got] == [True] + [False] * (len(got) - 1)
    assert [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in got[1:])
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id not in (None, 0):
            own = ids(texts[r.doc_id])
            assert (r.n_tokens, r.ids_crc32) == (len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert read_shards(write_shards(rows.limit(0), BYTE, 0)).collect() == []
    # few ranges of many shards each: the same rows in the same places
    monkeypatch.setattr("barforge.llm.token_shards.MOST_RANGES", 2)
    small = write_shards(rows, BYTE, 0, shard_bytes=100)
    shards = sorted(small.collect(), key=lambda r: r.shard)
    assert len(shards) > 6 and len({r.shard >> 20 for r in shards}) == 2 and [r.first for r in shards] == sorted(r.first for r in shards)
    assert sorted(read_shards(small).collect(), key=lambda r: r.start) == got
    path = f"{tmp_path}/one.sst"
    out = ShardWriter(path)
    keys = [None, -(1 << 63), -5, 0, 7, 7, 300, 1 << 40]
    for k in keys:
        for _ in range(3000 if k == 7 else 1):
            out.add(k, np.arange(100) + (k or 0) % 50)
    out.close()
    with ShardReader(path) as shard:
        assert [k for k, _ in shard if k != 7] == [k for k in keys if k != 7]
        for k in keys:
            assert shard.get(k).tolist() == (np.arange(100) + (k or 0) % 50).tolist()
        assert all(shard.get(k) is None for k in (1, 6, 8, -1, 1 << 50))


def test_token_counts_and_prefixes(spark):
    texts = [*odd_texts(200), None, "", "word " * 3000]
    got = {r.doc_id: r for r in token_counts(docs(spark, texts), WORD, 2048).collect()}
    whole = Tokenizer.from_file(WORD)
    count = lambda t: len(whole.encode(t, add_special_tokens=False).ids)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((t or "").encode()), count(t or ""), count(t or "") > 2048)
    assert (got[202].n_words, got[202].words_in_limit) == (3000, 2048) and got[200].words_in_limit == 0
    for t in ("Hello, wörld! unbelievable\n\tthings  ", *odd_texts(20, 9)):
        table = PrefixCounts(t, WORD)
        assert [table.count(i) for i in range(len(t) + 1)] == [count(t[:i]) for i in range(len(t) + 1)]
        assert table.total() == count(t)
        for budget in (0, 1, 3):
            assert table.truncate(budget) == t[: max(i for i in range(len(t) + 1) if count(t[:i]) <= budget)]
    odd = "lower" * 500
    got = token_counts(docs(spark, [f"a {odd} b"]), WORD, 10).collect()[0]
    cut = 2 + got.chars_over
    assert got.words_in_limit == 1 and count(f"a {odd}"[:cut]) <= 10 < count(f"a {odd}"[: cut + 1])
    assert token_counts(docs(spark, texts).limit(0), WORD).collect() == []


def test_counts_at_prefixes_of_chunks():
    rng = random.Random(7)
    own, whole = ChunkEncoder(WORD), Tokenizer.from_file(WORD)
    known = ["internationalization", "don't", "they'll've", "'re", "''re", "x" * 70, "日本語のテキスト", "ΣΑΣ", "İstanbul", "<|endoftext|>x", "e\u0301a", "🙂🙂a", "QWxhZGRpbjpvcGVuIHNlc2FtZQ==", "rock'n'roll's"]
    known += ["".join(rng.choice("thereingatonsé'1.") for _ in range(rng.randint(1, 25))) for _ in range(300)]
    want = [[len(whole.encode(w[:i], add_special_tokens=False).ids) for i in range(len(w) + 1)] for w in known]
    plain = own.library
    calls = []
    own.library = lambda text: calls.append(text) or plain(text)
    assert [own.prefix_table(w) for w in known] == want
    assert len(calls) < 1.2 * len(known)  # one for each word, more only for odd spellings


def test_prefixes_across_white_space_marks_and_special_strings():
    """No prefix of a text is encoded again, whatever it is spelled with; long ones take no time to speak of."""
    rng = random.Random(3)
    own, whole = ChunkEncoder(WORD), Tokenizer.from_file(WORD)
    count = lambda t: len(whole.encode(t, add_special_tokens=False).ids)
    letters = [*"thereing'srvelmd's1.-<|", "e\u0301", "\u0301", "\u0327", "\u1ea1\u0307", "\u1100", "\u1161", "\u11a8", "\u3000", "\u00a0", "\u0085", "\x1c", "\u200b"]
    letters += ["<|endoftext|>", "<|startoftext|>", "<|end", "日", "🙂", "İ", "Σ", "ß", "\u0bca", "ﬁ", "½", "Ω", "Å", "\u0323", "\u0315"]
    plain, asked = own.library, []
    own.library = lambda text: asked.append(text) or plain(text)
    for _ in range(600):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 14)))
        assert own.prefix_table(text) == [count(text[:i]) for i in range(len(text) + 1)], text
    pieces = sum(map(len, asked))
    assert pieces < 600 * 40
    han = lambda n: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(n))
    long = [han(20_000) + "\u3000" + han(20_000), "".join(rng.choice(["e\u0301", "a", "<|", "\u3000", "字", "x\u0323", "<|endoftext|>"]) for _ in range(20_000)), "a" + "\u0301" * 20_000]
    for text in long:
        asked.clear()
        began = time.monotonic()
        table = own.prefix_table(text)
        assert time.monotonic() - began < 20 and sum(map(len, asked)) <= len(text)
        for i in (0, 1, 57, len(text) // 3, len(text) // 2 + 1, len(text) - 1, len(text)):
            assert table[i] == count(text[:i])


def test_patience():
    rng = random.Random(4)
    for _ in range(200):
        v = [rng.randrange(30) for _ in range(rng.randrange(12))]
        own = [v[i] for i in longest_increasing(v)]
        assert own == sorted(set(own))
        best = [0] * len(v)
        for i, x in enumerate(v):
            best[i] = 1 + max((best[j] for j in range(i) if v[j] < x), default=0)
        assert len(own) == max(best, default=0)
        a, b = ([rng.choice("abcdefg") for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert patience(a, a) == [(i, i) for i in range(len(a))]


def test_licenses(spark):
    texts = ["Lorem ipsum.\nLicensed under the Apache License, Version 2.0.", "Licensed  under\nCC BY-NC 4.0", "released under THE mit license; licensed under CC BY 4.0", "a license of no kind", None, "", "This work was licensed under the GNU General Public License, version 3"]
    got = sorted((r.doc_id, r.license, r.coverage) for r in license_scan(docs(spark, texts)).collect())
    assert got == [(0, "Apache-2.0", 1.0), (1, "CC-BY-NC-4.0", 1.0), (2, "CC-BY-4.0", 1.0), (2, "MIT", 1.0), (6, "GPL-3.0", round(11 / 12, 6))]
    assert license_scan(docs(spark, texts).limit(0)).collect() == []


def test_notices_next_to_each_other():
    rng = random.Random(9)
    table = {k: Template(words_of(t), 0.8) for k, t in TEMPLATES.items()}
    for _ in range(150):
        name = rng.choice(list(TEMPLATES))
        base, copies = words_of(TEMPLATES[name]), []
        for _ in range(rng.choice([1, 2, 3, 5])):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "edited"
            copies.append(copy)
        text = ["before"] * 3 + [w for c in copies for w in c] + ["after"] * 3
        # against all windows of the template's size, by longest common subsequences
        best = {k: max(lcs(text[i : i + len(t.words)], t.words) for i in range(len(text))) for k, t in table.items() if abs(len(t.words) - len(base)) < 3}
        got = {k: n for k, _, n, _, _ in notices(" ".join(text), table)}
        top = max(best.values())
        if top >= 0.8 * len(base):
            assert max(got.values(), default=0) >= top, (name, got, best)
    assert notices("nothing here", table) == []


def test_licenses_that_are_told_apart():
    table = {k: Template(words_of(t), 0.8, TELLING.get(k, "|")) for k, t in TEMPLATES.items()}
    names = lambda text: [(x[0], x[5]) for x in by_license(notices(text, table))]
    sa, by = "This is CC BY-SA 4.0 licensed work. Licensed under CC BY-SA 4.0.", "Other parts: Licensed under CC BY 4.0"
    assert names(f"{sa} and then {by}") == [("CC-BY-SA-4.0", 1), ("CC-BY-4.0", 1)] and names(f"{by}. {sa}") == [("CC-BY-4.0", 1), ("CC-BY-SA-4.0", 1)]
    assert names("Licensed under CC BY-ND 4.0") == [("CC-BY-ND-4.0", 1)]
    for other in ("Licensed under CC BY-XX 3.0", "Released under the BSD License", "Licensed under CC BY 3.0", "Licensed under the Apache License, Version 1.1", "Licensed under CC BY-SA-ND 4.0"):
        assert names(other) == [], other
    assert names("This work is licensed under the GNU General Public License, version 2") == [("GPL-2.0", 1)]
    assert names("This work is licensed under the GNU Lesser General Public License, version 3") == []
    assert names("Licensed under CC BY 4.0. " * 3 + "Released under the MIT License") == [("CC-BY-4.0", 3), ("MIT", 1)]


def test_notices_in_any_order_against_what_was_put_there():
    rng = random.Random(19)
    table = {k: Template(words_of(t), 0.8, TELLING.get(k, "|")) for k, t in TEMPLATES.items()}
    for _ in range(120):
        chosen, text = [rng.choice(list(TEMPLATES)) for _ in range(rng.randint(1, 5))], []
        for name in chosen:
            words = words_of(TEMPLATES[name])
            loose = [i for i, w in enumerate(words) if w not in TELLING.get(name, "").split() and len(words) >= 8]
            if loose and rng.random() < 0.5:
                words[rng.choice(loose)] = "edited"
            text += [*words, *["filler"] * rng.randint(0, 3)]
        got = by_license(notices(" ".join(text), table))
        assert {x[0]: x[5] for x in got} == Counter(chosen), (chosen, got)
        # no other window of any template covers more than what is kept there
        spans = [(x[3], x[4], x[2]) for x in notices(" ".join(text), table)]
        for k, t in table.items():
            for i in range(0, max(1, len(text) - len(t.words) + 1), 7):
                n = lcs(text[i : i + len(t.words)], t.words)
                if n >= t.least and n > max((m for a, b, m in spans if a < i + len(t.words) and i < b), default=0):
                    assert not t.must <= {j for _, j in patience(text[i : i + len(t.words)], t.words)} or not t.foreign.isdisjoint(text[i : i + len(t.words)]), (k, i)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_hosts_light_and_hot_by_sql(spark, monkeypatch):
    monkeypatch.setattr("barforge.llm.quality_rules.HEAVY", 0.1)
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(good, "hot")] * 300 + [("bad", "hot")] * 20 + [(good, None)] * 100 + [("bad", None)] * 90
    rows += [("bad", "foul")] * 60 + [(good, "foul")] * 2 + [(good, "fine")] * 40 + [("bad", "one")] + [(good + " # $ & # $ & # $", "signs")] * 50
    rows = [(i, t, s) for i, (t, s) in enumerate(rows)]
    got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    con = duckdb.connect()
    con.register("documents", pa.table({n: list(c) for n, c in zip(("doc_id", "text", "source"), zip(*rows, strict=True), strict=True)}))
    want = con.sql(f"SELECT doc_id, base_failed, host_rejected, kept FROM ({QUALITY})").fetchall()
    assert sorted((r.doc_id, r.base_failed, r.host_rejected, r.kept) for r in got) == sorted(want)
    verdicts = Counter((rows[r.doc_id][2], r.host_rejected) for r in got)
    assert verdicts["foul", True] == 2 and verdicts["signs", True] == 50 and verdicts["hot", True] == verdicts[None, True] == verdicts["one", True] == 0


def test_shards_by_bytes(spark):
    rng = random.Random(3)
    texts = ["x" * rng.choice([1, 10, 100, 400]) for _ in range(3000)] + ["same"] * 1500 + [None, "", "no id", "é" * 50]
    sources = [rng.choice(["hot"] * 3 + ["a", "b"]) for _ in texts]
    got = kd_shards(docs(spark, texts, sources)).collect()
    assert len(got) == len(texts)
    size, slots = Counter(), {}
    for r in got:
        text = ("no id" if r.doc_id is None else texts[r.doc_id]) or ""
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text.encode()) + 1, zlib.crc32(text.encode()), "bytes", None)
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(size) == list(range(16)) and max(size.values()) - min(size.values()) <= 0.03 * max(size.values()) + 800
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert kd_shards(docs(spark, texts).limit(0)).collect() == []
    assert {r.shard for r in kd_shards(docs(spark, ["a"] * 64), None, 32).collect()} == {0, 1, 2, 3}
