"""Quality rules kept as a ledger of bits.

Every document is measured once and every rule is evaluated once. The ledger
stores the measurements and one long with a bit per failed rule. What happens to
a document is decided later by a policy, a versioned set of rules that reject:
a policy is a mask, so another version, or the effect of leaving a rule out,
costs a bitwise AND over the ledger and no further look at the texts.

Results: NULL and empty texts have no words and measure 0 everywhere, and so
fail ``few_words`` alone. Repeated rows stay repeated, other columns are left
alone, an empty table gives an empty ledger.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_caps_words",
    "n_plain_words",
]
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\v\f"
WINDOW = 5


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five words that occur twice or more, the first occurrence included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    size = max(2, len(index))
    if size == len(words):
        return 0
    code, bound = ids[:n], size
    for k in range(1, WINDOW):
        if bound > (1 << 62) // size:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            bound = n
        code, bound = code * size + ids[k : k + n], bound * size
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[inverse] > 1)
    edge[starts] += 1
    np.subtract.at(edge, starts + WINDOW, 1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "replace").split()  # of bytes: splits at ASCII white space only
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(w.isupper() and len(w) > 2 for w in words),
        sum(w[:1].isalnum() or w[0] > 127 for w in words),
    )


@F.arrow_udf(StructType([StructField(m, LongType()) for m in MEASURES]))
def measured(texts: pa.Array) -> pa.Array:
    rows = [measure(t.as_py()) for t in texts]
    columns = list(zip(*rows)) if rows else [()] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=MEASURES)


# Each rule: its name and when it fails, over the measurements. A rule's bit is its
# place in this list, so rules are only ever added at the end.
RULES = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words AND n_symbols >= 3"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines AND n_dup_lines >= 2"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    ("capitals", "100 * n_caps_words > 50 * n_words"),
    ("not_words", "100 * n_plain_words < 60 * n_words"),
]
BIT = {name: i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: int
    rejects: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BIT[name] for name in self.rejects)


# Versions of what rejects a document. A version that was in use is never changed.
POLICIES = {
    1: Policy(1, ("few_words", "repeated_words")),
    2: Policy(2, tuple(BIT)),
}
CURRENT = 2


def bits(measures: str) -> Column:
    """A long with the bit of each rule that fails, over a struct column of measurements."""
    fails = [F.expr(re.sub(r"[a-z]\w+", rf"`{measures}`.\g<0>", condition)) for _, condition in RULES]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0).cast("long"))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``measures`` (struct) and ``failed`` (long of bits)."""
    rows = docs.select(F.col(key).alias("key"), measured(F.col(text)).alias("measures"))
    return rows.select(F.col("key").alias(key), "measures", bits("measures").alias("failed"))


def passes(failed: Column, policy: Policy) -> Column:
    return failed.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def kept_documents(docs: DataFrame, policy: Policy, text: str = "text") -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), measured(docs[text]).alias("measures"))
    return whole.filter(passes(bits("measures"), policy)).select("row.*")


def ablation(ledger: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: rows it fails, fails alone, and rows kept with and without it.

    One pass: the ledger is reduced to its distinct bit patterns (at most two to
    the number of rules), and the rules are counted over these.
    """
    mask = F.lit(policy.mask).cast("long")
    patterns = ledger.select(F.col("failed").bitwiseAND(mask).alias("failed")).groupBy("failed").agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << BIT[r]).cast("long").alias("bit")) for r in policy.rejects))
    rows = patterns.select("failed", "n", F.explode(rules).alias("r"))
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("failed") == F.col("r.bit")
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        total(hit)("failed_rows"),
        total(alone)("failed_alone"),
        total(F.col("failed") == 0)("kept_rows"),
        total((F.col("failed") == 0) | alone)("kept_without"),
    )
