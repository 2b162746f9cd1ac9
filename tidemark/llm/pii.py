"""Personal data in texts: patterns propose, checksums confirm, context words adjust.

Each kind has a pattern that proposes spans and a validator on the span itself
(Luhn for cards, mod-97 for bank accounts, ranges for the rest). What is left
gets a score: a start value by kind, more if a context word of the kind stands
near the span, less if a word stands there that speaks against it. Near is what
comes shortly before the span, and shortly behind it what comes before the clause
ends, unless a number follows there, whose word it may be. The
spans of the four base kinds are always reported; spans of the other kinds only
if their score reaches the limit, so a bare ten-digit number is reported after
"call" and not after "order".

Patterns of runs start only where a run starts or the last match ended, and use
possessive quantifiers, so very long runs of one class take linear time and no
stack.

Built-in functions only. NULL and empty texts have no spans. Repeated rows stay
repeated, an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import either_case, let
from tidemark.llm.spans import NO_SPANS, in_order, masked, matches

LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
DIGITS_START = r"(?:(?<![0-9])|\G)[0-9]++"
IP = DIGITS_START + r"\.[0-9]++\.[0-9]++\.[0-9]++"
# Only chains of 14 digits or more: others would be dropped, and chains never overlap.
CARD = r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?){13}[0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The method's own kinds.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"  # where one may start
IBAN_REST = range(30, 10, -1)  # characters that may follow, longest first
# Registered lengths by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27,
    "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27,
    "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25,
    "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18,
    "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33,
    "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
IBAN_WIDTH = 4 + 2 * 30 + 1  # code points that decide where one ends
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9.-]?[0-9])"

BASE_KINDS = ["email", "ip", "card", "phone"]
# The method's kinds: pattern, start score in hundredths, words for, words against.
OWN = {
    "iban": (IBAN, 70, "iban|account|bank|konto|compte|cuenta|transfer", "example|sample"),
    "ssn": (SSN, 40, "ssn|social|security", "order|invoice|part|serial|version"),
    "local_phone": (LOCAL_PHONE, 20, "phone|tel|call|mobile|cell|fax|telefon", "order|invoice|part|serial|item|id"),
}
KINDS = BASE_KINDS + list(OWN)
FOR, AGAINST, LIMIT = 40, 40, 60
CONTEXT = 40  # code points on either side of a span in which context words count
BEHIND = r"^[^0-9,;.!?\n\r]*+(?![0-9])"  # of those behind it: the rest of the clause, unless a digit is met first


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check; the last digit is the check digit."""

    def added(d: Column, i: Column) -> Column:
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    values = F.transform(F.split(F.reverse(number), ""), lambda ch: ch.cast("int"))
    total = F.aggregate(F.transform(values, added), F.lit(0), lambda acc, x: acc + x)
    return total % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number of 15 to 34 characters has the remainder 1 under mod 97."""
    compact = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    values = F.transform(F.split(moved, ""), lambda ch: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ch) - 1)
    rest = F.aggregate(values, F.lit(0), lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return F.length(compact).between(15, 34) & (rest == 1)


def accounts(text: Column) -> Column:
    """Spans of account numbers, disjoint and in order: at each start a chain that passes mod-97.

    A chain of capitals and digits may run on into what follows the account ("DE89 ... 00 BIC"), so
    each of its ends where no letter or digit follows is tried. Of those that pass, the one of the
    country's length is taken, or else the longest.
    """

    def longest(s: Column) -> Column:
        rest = F.substring(text, (s["start"] + 1).cast("int"), F.lit(IBAN_WIDTH))
        ends = let(
            rest,
            lambda r: F.array(
                *(F.regexp_extract(r, rf"^[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n}}}(?![A-Za-z0-9])", 0) for n in IBAN_REST)
            ),
        )
        valid = F.filter(ends, lambda e: (e != "") & mod_97(e))
        length = F.try_element_at(F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair)), F.substring(s["found"], 1, 2))
        regular = lambda e: F.length(F.replace(e, F.lit(" "), F.lit(""))) == length
        return F.transform(
            let(valid, lambda v: F.slice(F.concat(F.filter(v, regular), v), 1, 1)),
            lambda e: F.struct(s["kind"], s["start"], (s["start"] + F.length(e)).alias("end"), e.alias("found")),
        )

    def apart(acc: Column, s: Column) -> Column:
        free = F.coalesce(F.try_element_at(acc, F.lit(-1))["end"] <= s["start"], F.lit(True))
        return F.when(free, F.array_append(acc, s)).otherwise(acc).cast(NO_SPANS)

    def found(starts: Column) -> Column:
        return F.aggregate(F.flatten(F.transform(starts, longest)).cast(NO_SPANS), F.array().cast(NO_SPANS), apart)

    return F.when(text.rlike(IBAN), let(matches(text, IBAN, "iban"), found)).otherwise(F.array().cast(NO_SPANS))


def _low_parts(found: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return found.rlike(rf"^{part}(?:\.{part}){{3}}$")


def base_spans(text: Column) -> Column:
    """Spans of the four base kinds that pass their checks."""

    def card(s: Column) -> Column:
        return let(digits(s["found"]), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))

    return F.concat(
        matches(text, EMAIL, "email"),
        F.filter(matches(text, IP, "ip"), lambda s: _low_parts(s["found"])),
        F.filter(matches(text, CARD, "card"), card),
        F.filter(matches(text, PHONE, "phone"), lambda s: F.length(digits(s["found"])).between(10, 15)),
    )


def _score(text: Column, s: Column, kind: str) -> Column:
    _, start, words_for, words_against = OWN[kind]
    before = F.substring(
        text, F.greatest(s["start"] - CONTEXT, F.lit(0)).cast("int") + 1, F.least(s["start"], F.lit(CONTEXT)).cast("int")
    )

    behind = F.regexp_extract(F.substring(text, s["end"].cast("int") + 1, F.lit(CONTEXT)), BEHIND, 0)

    def has(words: str) -> Column:
        pattern = "(?:^|[^A-Za-z])(?:" + "|".join(either_case(w) for w in words.split("|")) + ")(?![A-Za-z])"
        return before.rlike(pattern) | behind.rlike(pattern)

    return (
        F.lit(start) + F.when(has(words_for), FOR).otherwise(0) - F.when(has(words_against), AGAINST).otherwise(0)
    )


def _likely(text: Column, kind: str):
    return lambda s: _score(text, s, kind) >= LIMIT


def own_spans(text: Column) -> Column:
    """Spans of the method's kinds whose score reaches the limit."""
    found = []
    for kind, (pattern, *_) in OWN.items():
        spans = accounts(text) if kind == "iban" else matches(text, pattern, kind)
        found.append(F.filter(spans, _likely(text, kind)))
    return F.concat(*found)


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``base`` (spans of the base kinds) and ``spans`` (all), both in order.

    A span of the method's kinds that lies inside a base span is left out.
    """
    whole = F.coalesce(docs[text], F.lit(""))
    found = docs.select(docs[key], base_spans(whole).alias("base"), own_spans(whole).alias("own"))
    new = F.filter(
        "own",
        lambda s: ~F.exists(F.col("base"), lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])),
    )
    return found.select(
        key,
        in_order(F.col("base"), BASE_KINDS).alias("base"),
        in_order(F.concat(F.col("base"), new), KINDS).cast(NO_SPANS).alias("spans"),
    )


def without_personal_data(docs: DataFrame, text: str = "text", mark: str = "[PII]") -> DataFrame:
    """The same rows and columns with every span in ``text`` replaced by a mark."""
    whole = F.coalesce(docs[text], F.lit(""))
    spans = in_order(F.concat(base_spans(whole), own_spans(whole)), KINDS)
    return docs.withColumn(text, F.when(docs[text].isNotNull(), let(spans, lambda s: masked(whole, s, mark))))
