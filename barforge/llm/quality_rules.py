"""Host-level quality rules: rule failures by host, shrunk by an empirical beta prior.

Everything is DataFrame functions. A document's counts are array functions within its row,
so that no word is shuffled; hosts are aggregated with partial sums. Between the two passes
the counts are written, and by ``keep_good`` the rows that it returns, as counting them anew
would cost more than reading them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, stash

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: A host is rejected if one of its rules' shrunk failure rates exceeds this: if most of what it
#: has fails. Hosts whose rates differ by chance alone stay near the prior's mean, far below.
HOST_RATE = 0.5
#: Hosts with at least this share of all rows are broadcast: there are at most 1/HEAVY.
HEAVY = 0.001

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = {
    "base": "n_words < 50 or 100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
}


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once for a row: a lambda's variable is never inlined."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are sorted with their places, equal neighbours give the places of repeated
    windows, and the distinct places that those cover are counted: n log n in a row.
    """

    def windows(w: Column) -> Column:
        n = F.size(w)
        grams = F.arrays_zip(F.slice(w, 1, n - 2).alias("a"), F.slice(w, 2, n - 2).alias("b"), F.slice(w, 3, n - 2).alias("c"))
        return F.transform(grams, lambda g, i: F.struct(F.xxhash64(g["a"], g["b"], g["c"]).alias("h"), F.hash(g["c"], g["b"], g["a"]).alias("k"), i.alias("i")))

    def covered(s: Column) -> Column:
        n = F.size(s)
        pairs = F.zip_with(
            F.slice(s, 1, n - 1), F.slice(s, 2, n - 1),
            lambda x, y: F.when((x["h"] == y["h"]) & (x["k"] == y["k"]), F.array(x["i"], y["i"])),
        )
        starts = F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        _let(words, lambda w: _let(F.array_sort(windows(w)), covered))
    )


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with COUNTS, n_lines and base_failed from each whole text (null: as empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.char_length
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return (
        docs.withColumn("_words", F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", n(F.translate(text, SPACES, "")).cast("long"))
        .withColumn("n_symbols", (n(text) - n(F.translate(text, SYMBOLS, ""))).cast("long"))
        .withColumn("_lines", lines)
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", _repeated(F.col("_words")).cast("long"))
        .drop("_words", "_lines")
        .withColumn("base_failed", F.expr(RULES["base"]))
    )


def host_verdicts(counted: DataFrame, host: str, host_rate: float = HOST_RATE) -> DataFrame:
    """(host, n, rejected): rates of failures by host, drawn to the prior of all hosts.

    For each rule a beta prior is fitted to the hosts' rates by moments: mean m and
    variance v, weighted by rows, give a strength s = m (1 - m) / v - 1 within [1, 1000];
    a host's rate is (failures + s m) / (n + s). Few rows thus say little against a host.
    A null host is no host.
    """
    fails = {k: F.expr(rule).cast("long") for k, rule in RULES.items()}
    hosts = stash(
        counted.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), *(F.sum(x).alias(f"f_{k}") for k, x in fails.items())),
        "hosts",
    )
    total = F.sum("n").cast("double")
    prior = hosts.agg(
        total.alias("_rows"),
        *(F.try_divide(F.sum(f"f_{k}").cast("double"), total).alias(f"m_{k}") for k in RULES),
        *(F.try_divide(F.sum(F.col(f"f_{k}").cast("double") * F.col(f"f_{k}") / F.col("n")), total).alias(f"q_{k}") for k in RULES),
    )
    rejected = F.lit(False)
    for k in RULES:
        m, v = F.col(f"m_{k}"), F.col(f"q_{k}") - F.col(f"m_{k}") * F.col(f"m_{k}")
        strength = F.when(v > 1e-12, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(1.0)), F.lit(1000.0))).otherwise(1000.0)
        rejected = rejected | ((F.col(f"f_{k}") + strength * m) / (F.col("n") + strength) > host_rate)
    # one row of moments beside every host
    out = stash(hosts.crossJoin(F.broadcast(prior)).select("host", "n", (F.col("n") >= HEAVY * F.col("_rows")).alias("heavy"), rejected.alias("rejected")), "verdicts")
    discard(hosts)
    return out


def with_verdicts(counted: DataFrame, host: str, verdicts: DataFrame) -> DataFrame:
    """``counted`` with ``kept``. Rows of hot hosts and of none do not go through a shuffle.

    The verdicts of hot hosts, at most 1/HEAVY of them, are broadcast, and settle their rows.
    Only if a light host is rejected are the other rows, those of light hosts, joined by host.
    """
    heavy = verdicts.filter("heavy").select(F.col("host").alias("_host"), F.col("rejected").alias("_heavy"))
    light = verdicts.filter("rejected and not heavy").select(F.col("host").alias("_host"), F.lit(True).alias("_light"))
    out = counted.join(F.broadcast(heavy), F.col(host) == F.col("_host"), "left").drop("_host")
    if light.isEmpty():
        out = out.withColumn("_light", F.lit(False))
    else:
        settled = F.col(host).isNull() | F.col("_heavy").isNotNull()
        rest = out.filter(~settled).join(light, F.col(host) == F.col("_host"), "left").drop("_host")
        out = out.filter(settled).withColumn("_light", F.lit(False)).unionByName(rest)
    kept = ~(F.col("base_failed") | F.coalesce("_heavy", "_light", F.lit(False)))
    return out.withColumn("kept", kept).drop("_heavy", "_light")


def quality_rules(docs: DataFrame, host: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """Counts and verdicts for each row of ``docs`` (doc_id, text, ``host``; others ignored).

    Returns doc_id, the COUNTS, base_failed, host_rejected and kept, a row for each input
    row, repeated rows included. A null or empty text has no words and fails; a row with a
    null host gets no verdict from hosts; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col(host).cast("string").alias("_source"), "text")
    counted = stash(with_counts(rows).drop("text"), "counts")
    judged = with_verdicts(counted, "_source", host_verdicts(counted, "_source", host_rate))
    return judged.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & ~F.col("kept")).alias("host_rejected"), "kept")


def keep_good(docs: DataFrame, host: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that quality_rules keeps, with all their columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    counted = stash(with_counts(docs.select(row, F.col(host).cast("string").alias("_source"), "text")).drop("text"), "counts")
    verdicts = host_verdicts(counted, "_source", host_rate)
    return with_verdicts(counted, "_source", verdicts).filter("kept").select("_row.*")
