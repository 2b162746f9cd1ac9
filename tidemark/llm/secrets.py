"""Secrets in texts: known forms, and strings that look random.

Known forms (assignments to a password-like name, access keys, long hex strings)
are found by pattern. Besides, candidate strings (20 or more characters of one
alphabet) are searched for a window of 20 characters of high Shannon entropy.
The window slides one character at a time; its character counts and the sum of
``c * log2(c)`` over them are brought up to date for the one character that
leaves and the one that enters, never recounted. Sums are whole numbers (scaled
by 2**20), so no rounding gathers on the way. The limit depends on the character
class of the candidate. Allow-listed strings (identifiers in the standard
8-4-4-4-12 form, numbers) are suppressed, and so are windows that overlap an
allowed part (words for placeholders, runs of the alphabet): a candidate such as
``examples/<key>`` is still found by the windows of its key. Spans of known forms
are never suppressed.

Built-in functions only. NULL and empty texts have no spans. Repeated rows stay
repeated, an empty table gives an empty table, other columns are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import either_case, let
from tidemark.llm.spans import in_order, masked, matches

NAMES = [*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")]
ASSIGN = (
    "(" + "|".join(NAMES) + ")"
    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
# Runs of 24 or more alone, as others would be dropped; a search starts only where a run starts.
LONG_HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"

WINDOW = 20
SCALE = 1 << 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
# Character classes in the order they are tried: kind, pattern, least bits per character.
CLASSES = [
    ("entropy_hex", "^([0-9]*[a-f][0-9a-f]*|[0-9]*[A-F][0-9A-F]*)$", 3.0),
    ("entropy_alnum", "^([a-z]*[0-9][a-z0-9]*|[A-Z]*[0-9][A-Z0-9]*)$", 3.5),
    ("entropy_base64", "[0-9+/]", 3.8),
]
# Strings that look random and are no secrets, and parts of strings no window may overlap.
ALLOWED = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$|^[0-9-]+$"
ALLOWED_PARTS = "|".join([*map(either_case, ("example", "placeholder")), "[Xx]{6}", "0123456789", either_case("abcdefgh")])
BASE_KINDS = ["assign", "access", "hex"]
KINDS = BASE_KINDS + [c[0] for c in CLASSES]


def _weight(count: int) -> int:
    return round(count * math.log2(count) * SCALE) if count else 0


WEIGHTS = [_weight(c) for c in range(WINDOW + 1)]


def most_spread(text: Column) -> Column:
    """The least sum of ``c * log2(c)`` (scaled) of a window of 20 characters: low means high entropy."""
    weights = F.array(*(F.lit(w).cast("long") for w in WEIGHTS))
    codes = F.transform(F.split(text, ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)

    def step(code: Column):
        def slide(acc: Column, i: Column) -> Column:
            enters = code[i]
            leaves = F.when(i >= WINDOW, code[F.greatest(i - WINDOW, F.lit(0))]).otherwise(F.lit(-1))

            def moved(m: Column) -> Column:
                gone = acc["counts"][F.greatest(m["leaves"], F.lit(0))]
                less = F.when(m["leaves"] >= 0, weights[F.greatest(gone - 1, F.lit(0))] - weights[gone]).otherwise(0)
                held = acc["counts"][m["enters"]] - F.when(m["enters"] == m["leaves"], 1).otherwise(0)
                total = acc["total"] + less + weights[held + 1] - weights[held]
                return F.struct(
                    F.transform(
                        acc["counts"],
                        lambda c, k: c + F.when(k == m["enters"], 1).otherwise(0) - F.when(k == m["leaves"], 1).otherwise(0),
                    ).alias("counts"),
                    total.cast("long").alias("total"),
                    F.when(i >= WINDOW - 1, F.least(acc["best"], total)).otherwise(acc["best"]).cast("long").alias("best"),
                )

            return let(F.struct(enters.alias("enters"), leaves.alias("leaves")), moved)

        start = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
            F.lit(0).cast("long").alias("total"),
            F.lit(1 << 40).cast("long").alias("best"),
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(code) - 1), start, slide, lambda acc: acc["best"])

    return let(codes, step)


def most_allowed(bits: float) -> int:
    """The largest scaled sum of a window that has so many bits per character or more."""
    return math.floor(WINDOW * SCALE * (math.log2(WINDOW) - bits))


def random_strings(text: Column) -> Column:
    """Spans of candidate strings whose entropy reaches the limit of their class."""

    def judged(s: Column) -> Column:
        # Windows beside the allowed parts: those of the pieces between them.
        pieces = F.filter(F.split(s["found"], ALLOWED_PARTS, -1), lambda p: F.length(p) >= WINDOW)
        kind = F.lit(None).cast("string")
        for name, pattern, bits in reversed(CLASSES):
            spread = F.array_min(F.transform(pieces, most_spread))
            high = F.when(spread <= most_allowed(bits), F.lit(name))
            kind = F.when(s["found"].rlike(pattern), high).otherwise(kind)
        return F.struct(kind.alias("kind"), s["start"], s["end"], s["found"])

    candidates = F.filter(matches(text, CANDIDATE, "candidate"), lambda s: ~s["found"].rlike(ALLOWED))
    return F.filter(F.transform(candidates, judged), lambda s: s["kind"].isNotNull())


def known_forms(text: Column) -> Column:
    assign = F.filter(matches(text, ASSIGN, "assign", 2), lambda s: F.length(s["found"]) >= 6)
    access = F.filter(matches(text, ACCESS, "access"), lambda s: F.length(s["found"]) >= 20)
    return F.concat(assign, access, matches(text, LONG_HEX, "hex"))


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``base`` (spans of known forms) and ``spans`` (all), both in order."""
    whole = F.coalesce(docs[text], F.lit(""))
    found = docs.select(docs[key], known_forms(whole).alias("base"), random_strings(whole).alias("random"))
    return found.select(
        key,
        in_order(F.col("base"), BASE_KINDS).alias("base"),
        in_order(F.concat("base", "random"), KINDS).alias("spans"),
    )


def without_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced by a mark."""
    whole = F.coalesce(docs[text], F.lit(""))
    spans = in_order(F.concat(known_forms(whole), random_strings(whole)), KINDS)
    return docs.withColumn(text, F.when(docs[text].isNotNull(), let(spans, lambda s: masked(whole, s, mark))))
