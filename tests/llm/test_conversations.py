"""Conversation repair against a search over all edits, row by row."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from barforge.llm.conversation_repair import audits, conversation_repair, damaged, repaired, solve
from barforge.llm.queries import op12_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
FORM = re.compile("(s?(ua)+)?")
BLANK = " \t\n\x0b\f\r"


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """rows: (role, fault). The first accepted of all edit sequences by (cost, audit)."""
    heap = [(0, "", 0, "", ())]
    seen = set()
    while heap:
        cost, audit, i, roles, made = heapq.heappop(heap)
        if (i, roles[-2:], len(roles) > 1, roles[:1]) in seen and len(roles) > 0:
            continue
        if roles:
            seen.add((i, roles[-2:], len(roles) > 1, roles[:1]))
        if i == len(rows) and FORM.fullmatch(roles):
            return cost, audit, made
        grow = []
        for role in ("user", "assistant"):
            grow.append((3, "I", i, role, (role, None)))
        if i < len(rows):
            role, fault = rows[i]
            grow.append((4, "D", i + 1, None, None))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                grow.append((more, "K", i + 1, role, (role, i)))
                grow += [(3 + more, "R", i + 1, r, (r, i)) for r in ("user", "assistant")]
        for c, letter, j, role, row in grow:
            now = roles if role is None else roles + role[:1]
            if role is not None and (not role or not re.fullmatch("s?(ua)*u?", now)):
                continue
            heapq.heappush(heap, (cost + c, audit + letter, j, now, made if row is None else (*made, row)))


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = harmed([r for r in rows if r[0] == conv])
        digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
        faults, seen = [], set()
        for _, _, role, text in own:
            visible = text.rstrip(BLANK)
            faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for _, t, _, _ in own if t is not None]
        cost, audit, made = cheapest([(r[2], f) for r, f in zip(own, faults, strict=True)])
        lines = [f"{role}:{'' if i is None else own[i][3]}" for role, i in made]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def got(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def made(rng, conversations):
    texts = ["Yes.", "No!", "Why?", "cut off", "  ", "", None, "Well. \n", "done.\x0b", "ü…", "a ", "?"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u", "a"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(9)):
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, None if rng.random() < 0.1 else turn * rng.choice([1, 1, 1, 3]), role, rng.choice(texts) if rng.random() < 0.5 else f"Text {turn}."))
    return rows + [(None, t, "user", "No home.") for t in (1, 2, 2, None)]


def test_against_all_edits(spark):
    rows = made(random.Random(5), 300)
    random.Random(6).shuffle(rows)
    assert got(conversation_repair(damaged(spark.createDataFrame(rows, SCHEMA)))) == brute(rows)


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    df = op12_conversation_repair(spark, "/root/testdata/sf0.01")
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(df) == want and len(want) == 100


def test_long_and_repeated(spark):
    assert solve("") == (0, "") and solve("ua" * 50_000) == (0, "K" * 100_000) and solve("x" * 5) == (20, "DDDDD")
    assert solve("u") == (3, "KI") and solve("s") == (4, "D") and solve("uu") == (3, "KR") and solve("A") == (4, "D")
    rows = [(1, t, ("user", "assistant")[t % 2], f"Row {t}." + " x" * (40_000 if t == 7 else 0)) for t in range(3000)] + [(2, 0, "user", "Same.")] * 500
    assert got(conversation_repair(damaged(spark.createDataFrame(rows, SCHEMA)))) == brute(rows)


def test_without_rows_and_with_clashing_columns(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Gone.")]
    one = got(conversation_repair(damaged(spark.createDataFrame(rows, SCHEMA))))
    assert one == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} == brute(rows)
    assert conversation_repair(damaged(spark.createDataFrame([], SCHEMA))).collect() == []
    rows = made(random.Random(8), 20)
    names = "digest string, fault string, audit string, part string, copies string, signature string, place string, _conv string, cost string"
    wide = spark.createDataFrame([(*r, *"123456789") for r in rows], f"{SCHEMA}, {names}")
    assert got(conversation_repair(damaged(wide))) == brute(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", ""), (2, 0, "assistant", "First."), (2, 1, "user", "So.")]
    table = spark.createDataFrame(rows, SCHEMA)
    found = audits(table)
    assert {r.conv_id: (r.cost, r.audit) for r in found.collect()} == {1: (7, "KRD"), 2: (6, "IKKI")}
    said = sorted((r.conv_id, r.place, r.role, r.text, r.edit) for r in repaired(table, found).collect())
    assert said == [
        (1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "Again.", "R"),
        (2, 0, "user", "", "I"), (2, 1, "assistant", "First.", "K"), (2, 2, "user", "So.", "K"), (2, 3, "assistant", "", "I"),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_signatures(seed):
    rng = random.Random(seed)
    for _ in range(200):
        signature = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(8)))
        name = {"s": "system", "u": "user", "a": "assistant", "o": "other", "x": "user"}
        rows = [(name[c.lower()], "blank" if c == "x" else "truncated" if c.isupper() else "") for c in signature]
        assert solve(signature) == cheapest(rows)[:2], signature
