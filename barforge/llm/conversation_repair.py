"""Conversation structure repair: signatures, each solved once, audits and replayed edits.

A conversation is reduced to its signature, one character a row for role and fault. Each
distinct signature is solved once, by recursion over (row, role that came last) with a memo,
and its audit, one character an edit, is joined back and replayed over the texts. Rows of a
conversation pass a task one after the other, sorted by Spark: no conversation is gathered,
what a task remembers of one is its signature and a digest for each text it has seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, discard, stash
from .words import freeing

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
BLANKS = " \\t\\n\\u000b\\f\\r"

#: What came last: nothing yet, system, user, assistant; and which of them is due then.
STATES, DUE = "^sua", (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): a damage for each row by a checksum of conv_id and turn.

    Of twenty rows about one each is dropped (copies 0), emptied, robbed of its ``[.!?]``,
    repeated (copies 2) and given to the user. Nulls count as one space; other columns go.
    """
    said = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(said["conv_id"], F.lit(":"), said["turn"]).cast("binary")) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(said["role"]).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said["text"], "[.!?]", "")).otherwise(said["text"]).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with what orders and judges them: digest, initial (one of suao) and fault (b, t or none)."""
    visible = F.expr(f"trim(TRAILING '{BLANKS}' FROM text)")
    initial = F.substring("role", 1, 1)
    return rows.withColumns(
        {
            "digest": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))),
            "initial": F.when(initial.isin("s", "u", "a"), initial).otherwise("o"),
            "fault": F.when(visible == "", "b").when(~F.right(visible, F.lit(1)).isin(".", "!", "?"), "t").otherwise(""),
        }
    )


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Conversations whole in one partition each, their rows by turn, nulls first, ties by digest."""
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(), "digest")


class _Signed:
    """What is counted of one conversation while its rows pass."""

    def __init__(self) -> None:
        self.signature, self.seen, self.turns = bytearray(), set(), [None, None, 0]
        self.counts, self.last = {"b": 0, "d": 0, "t": 0, "illegal": 0}, ""

    def add(self, turn: int | None, digest: bytes, initial: str, fault: str) -> None:
        first, last, distinct = self.turns
        if turn is not None and turn != last:
            self.turns = [turn if first is None else first, turn, distinct + 1]
        if fault != "b":
            if digest in self.seen:
                fault = "d"
            self.seen.add(digest)
        if fault:
            self.counts[fault] += 1
        if self.last and self.last + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last = initial
        self.signature += b"x" if fault in ("b", "d") else (initial.upper() if fault else initial).encode()

    def row(self) -> tuple:
        first, last, distinct = self.turns
        c = self.counts
        return 0 if first is None else last - first + 1 - distinct, c["b"], c["d"], c["t"], c["illegal"], self.signature.decode()


SIGNED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, now, done = None, None, []
    kinds = [pa.int64()] * 6 + [pa.string()]
    names = [x.split()[0] for x in SIGNED.split(", ")]

    def out() -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for conv, turn, digest, initial, fault, copies in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "digest", "initial", "fault", "copies")), strict=True):
            if now is None or conv != at:
                if now is not None:
                    done.append((at, *now.row()))
                at, now = conv, _Signed()
            for _ in range(copies):
                now.add(turn, digest, initial, fault)
        yield out()
        done = []
    if now is not None:
        done.append((at, *now.row()))
        yield out()


def solve(signature: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a signature, of equal ones the ASCII-least.

    best(row, state) is the least over the edits that may come next, of which no two have one
    letter, so that ties are settled by that letter. The memo is filled from the last row on,
    which keeps the recursion off the interpreter's stack. Insertions lead from state to
    state of one row, at a cost, so two rounds settle them.
    """
    n = len(signature)
    memo = bytearray(4 * (n + 1))
    after = [0, 2 * INSERT, INSERT, 0]
    memo[4 * n :] = b".II."
    for i in range(n - 1, -1, -1):
        c = signature[i]
        own, cut = STATES.find(c.lower()), CUT if c.isupper() else 0
        best = []
        for q in range(4):
            found = [(DELETE + after[q], 68)]
            if c != "x":
                if own == DUE[q] or (own == 1 and q == 0):
                    found.append((KEEP + cut + after[own], 75))
                found.append((REROLE + cut + after[DUE[q]], 82))
            best.append(min(found))
        for _ in range(2):
            best = [min(best[q], (INSERT + best[DUE[q]][0], 73)) for q in range(4)]
        memo[4 * i : 4 * i + 4] = bytes(x[1] for x in best)
        after = [x[0] for x in best]
    audit, i, q = bytearray(), 0, 0
    while (edit := memo[4 * i + q]) != 46:
        audit.append(edit)
        if edit == 75:
            q = STATES.find(signature[i].lower())
        elif edit != 68:
            q = DUE[q]
        i += edit != 73
    return after[0], audit.decode()


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signatures = batch["signature"].to_pylist()
        solved = [solve(s) for s in signatures]
        yield pa.RecordBatch.from_arrays([pa.array(signatures, pa.string()), pa.array([c for c, _ in solved], pa.int64()), pa.array([a for _, a in solved], pa.string())], names=["signature", "cost", "audit"])


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation.

    rows: conv_id, turn, role, text and, if there, copies: how often the row stands there; with
    0 it only says that the conversation exists. A row's fault is the first of: blank (no
    visible character), duplicate (role and text seen earlier), truncated (the last visible
    character ends no sentence). A null conv_id is a conversation like others; nulls in role
    and text count as one space; rows of one turn are ordered by a digest of role and text, and
    equal rows are duplicates. Turns count without nulls. An empty table gives no rows.
    """
    signed = stash(_in_order(_marked(_whole(rows)).drop("role", "text")).mapInArrow(freeing(_sign), SIGNED), "signed")
    solved = stash(signed.select("signature").distinct().mapInArrow(freeing(_solve), "signature string, cost long, audit string"), "solved")
    small = broadcast_if_small(solved, F.length("signature") + F.length("audit") + 16)
    out = stash(signed.join(solved if small is None else small, "signature").drop("signature"), "audits")
    discard(signed)
    discard(solved)
    return out


def _whole(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text, copies.alias("copies"))


REPAIRED = "conv_id long, place long, role string, text string, edit string"


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each conversation, its audit ahead of them, into repaired ones."""
    names = [x.split()[0] for x in REPAIRED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    conv, audit, at, state, place, done = None, "", 0, 0, 0, []

    def put(role: str, text: str, edit: str) -> None:
        nonlocal place, state
        done.append((conv, place, role, text, edit))
        place, state = place + 1, max(0, STATES.find(role[:1]))

    def insert() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            put(ROLES[DUE[state]], "", "I")
            at += 1

    def out() -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for c, head, role, text, copies in zip(*(batch[x].to_pylist() for x in ("conv_id", "audit", "role", "text", "copies")), strict=True):
            if head is not None:
                insert()  # what is left of the one before
                conv, audit, at, state, place = c, head, 0, 0, 0
                continue
            for _ in range(copies):
                insert()
                edit, at = audit[at], at + 1
                if edit != "D":
                    put(role if edit == "K" else ROLES[DUE[state]], text, edit)
        yield out()
        done = []
    insert()
    if done:
        yield out()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the rows that the edits of ``audits`` make of ``rows``.

    place counts from 0 in a conversation, edit is K, R or I; what is deleted has no row.
    Each conversation's rows stand in one partition, in order.
    """
    said = _marked(_whole(rows)).select("conv_id", F.lit(1).alias("part"), "turn", "digest", "role", "text", "copies", F.lit(None).cast("string").alias("audit"))
    none = {c: F.lit(None).cast(k).alias(c) for c, k in (("turn", "long"), ("digest", "binary"), ("role", "string"), ("text", "string"), ("copies", "int"))}
    heads = found.select("conv_id", F.lit(0).alias("part"), *none.values(), "audit")
    return _in_order(heads.unionByName(said.filter("copies > 0")), "part").mapInArrow(freeing(_replay), REPAIRED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha, done = None, None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([h for _, h in done], pa.string())], names=["conv_id", "repaired_sha256"])

    for batch in batches:
        for c, place, role, text in zip(*(batch[x].to_pylist() for x in ("conv_id", "place", "role", "text")), strict=True):
            line = f"{role}:{text}".encode()
            if place == 0:
                if sha is not None:
                    done.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256(line)
            else:
                sha.update(b"\n" + line)
        yield out()
        done = []
    if sha is not None:
        done.append((conv, sha.hexdigest()))
        yield out()


def conversation_repair(rows: DataFrame) -> DataFrame:
    """What ``audits`` says of each conversation, with repaired_sha256 of its repaired rows.

    The digest is of ``role:text``, joined by newlines; of nothing, where nothing is left.
    """
    found = audits(rows)
    digests = repaired(rows, found).mapInArrow(freeing(_hashed), "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "_conv")
    whole = found.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return whole.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
