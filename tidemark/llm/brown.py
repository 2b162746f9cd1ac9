"""Class-based bigram scoring of texts (Brown classes, exchange clustering).

Tokens are words and one end per text. Every training token is counted. A word
has a class; a text is scored by

    P(w1 .. wn) = product of P(class(wi) | class(wi-1)) * P(wi | class(wi))

where the text begins in the class of the end token.

Classes. The 8,192 most frequent training words (``LEXICON``, a parameter of
the model) start in classes by frequency and are moved by exchange clustering:
each word goes to the class that raises the log-likelihood of the class bigrams
most. All other words, also those that training never saw, have a class by their
form: the range of their letters and their last letter. Both kinds of classes
are conditioned on and predicted alike.

The training texts are read once for the exchange: they become counts of pairs of
neighbouring word numbers. In a sweep, tasks sum from these how often each word
follows and precedes each class and itself, and each block of words moves its words
one after the other against its own copy of the class bigrams, by the exact change
of the likelihood there. As blocks do not see each other's moves, the moves of a
sweep are taken together only if the likelihood of all pairs rises; otherwise the
half of them that gains most is tried, and so on; where no part raises it, each word
is asked for its move alone, and the halving ends at the latest with the one that
gains most. So the likelihood never falls. Sweeps end when none raises it by more
than ``TOLERANCE`` of itself. What reaches
the driver is the lexicon, its classes and the class bigrams, all of a size that
the parameters fix.

Smoothing. A class bigram probability is mixed with the class's own probability
(Witten-Bell: by the number of distinct followers). A word's probability in a
class of forms is ``(c + 1) / (N + V + 1)`` over the class's tokens and distinct
words, one share being left for words not seen; lexicon words have their share
of their class.

Results: NULL and empty texts are the end token alone. Repeated rows count as
often as they occur. Without training tokens every probability is the uniform
one over the classes. A NULL id is scored and not trained on.
"""

from __future__ import annotations

import bisect
import uuid
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.sources.scratch import frozen

LEXICON = 8_192  # words at most, the most frequent ones
CLASSES = 32
TOLERANCE = 1e-5  # share of the likelihood by which a sweep must raise it for another one to follow
BLOCK = 512  # words that one task moves
# So many words, the most frequent ones, whose counts every scoring task holds besides the lexicon and
# the end; the counts of all others are joined.
HELD_COUNTS = 131_072

END = 0  # word number of the end token, alone in class 0
END_WORD = ""  # how counts name it: no word is empty
RANGES = [0x80, 0x100, 0x250, 0x400, 0x530, 0x3000]
VOWELS, FREQUENT = b"aeiouy", b"nrst"
FORMS = 4 * (len(RANGES) + 1)
TOTAL = 1 + CLASSES + FORMS


def form(word: bytes) -> int:
    """The class of forms of a word: range of its highest character, kind of its last ASCII letter."""
    high = 0 if word.isascii() else bisect.bisect_right(RANGES, ord(max(word.decode("utf-8", "replace"))))
    letters = word.rstrip(b".,;:!?\"')]}0123456789")
    last = letters[-1:] if letters[-1:].isalpha() else b""
    return high * 4 + (0 if not last else 1 if last in VOWELS else 2 if last in FREQUENT else 3)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


class Numbers(dict):
    """Word numbers: 1.. for the lexicon, above it one for each form.

    ``frequent`` words (the lexicon first) are looked up, the forms of others are
    kept for a while.
    """

    def __init__(self, lexicon: int, frequent: list[bytes], keep: int = 200_000):
        super().__init__()
        self.lexicon, self.first_form, self.keep, self.frequent = lexicon, lexicon + 1, keep, {}
        for i, w in enumerate(frequent):
            self.frequent[w] = i + 1 if i < lexicon else self.first_form + form(w)
        self.update(self.frequent)

    def __missing__(self, word: bytes) -> int:
        number = self.first_form + form(word)
        if len(self) >= len(self.frequent) + self.keep:
            self.clear()
            self.update(self.frequent)
        if len(word) <= 64:
            self[word] = number
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words of a text, and of its end."""
        out = np.zeros(len(words) + 1, np.uint16)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.uint16, len(words))
        return out


_kept: dict[str, object] = {}


def held(name: str, build):
    """An object that a worker builds once and keeps; the latest two names stay."""
    if name not in _kept:
        while len(_kept) >= 2:
            _kept.pop(next(iter(_kept)))
        _kept[name] = build()
    return _kept[name]


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): how often each token occurs."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # Splitting at single blanks leaves empty strings; they are dropped, then one end per text is added.
    words = F.array_append(F.array_remove(F.split(lower, r"[\x20\x09-\x0D]", -1), ""), END_WORD)
    return texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list:
    """Rows of the ``most`` most frequent words, by falling count; of equal counts those of least hash.

    The cut is narrowed by small aggregates: words by magnitude of their count (16
    steps to the power of two), by count within the magnitude that overflows, and
    within the count that overflows by a hash, 12 bits at a time. So no task sends
    more than it has above the cut, and all together at most ``most`` rows.
    """
    tie = F.xxhash64("word")
    keys = [-F.floor(16 * F.log2("n")), -F.col("n"), *(F.shiftright(tie, bits) for bits in (52, 40, 28, 16, 4, 0))]
    room, inside, taken = most, F.lit(True), F.lit(False)
    for key in keys:
        last = over = None
        for value, words in sorted(tuple(r) for r in counts.filter(inside).groupBy(key.alias("key")).count().collect()):
            if words > room:
                over = value
                break
            last, room = value, room - words
        if last is not None:
            taken = taken | (inside & (key <= last))
        if over is None or not room:
            break
        inside = inside & (key == over)
    return sorted(counts.filter(taken).collect(), key=lambda r: (-r.n, r.word))


# --- exchange clustering --------------------------------------------------------------


def start_classes(n_lexicon: int) -> np.ndarray:
    """Class of each word number before the first sweep: the end, words by frequency in turn, forms as they are."""
    lexicon = 1 + np.arange(n_lexicon) % CLASSES
    return np.concatenate([[0], lexicon, 1 + CLASSES + np.arange(FORMS)]).astype(np.int64)


WIDTH = 2 * TOTAL + 1  # cells of a word: after each class, before each class, beside itself


def _pairs(numbered: DataFrame) -> DataFrame:
    """(pair, n): how often each word number is followed by each other, as ``first * 2**16 + second``.

    A task sends each pair once for every batch of texts. There are at most as many
    pairs as the square of the lexicon, whatever the length of the texts.
    """

    def count(batches):
        for batch in batches:
            column = batch.column(0)
            if not len(column):
                continue
            # Texts end with the end token, which also stands before the first word of the next.
            stream = np.frombuffer(b"\0\0" + b"".join(column.to_pylist()), np.uint16).astype(np.int64)
            pairs, counts = np.unique((stream[:-1] << 16) + stream[1:], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(counts, pa.int64())], names=["pair", "n"])

    counted = numbered.select("numbers").mapInArrow(count, "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def _packed(pairs: DataFrame) -> DataFrame:
    """(pairs, counts): the pairs as packed 64-bit numbers, a batch of them in a row, since every sweep reads them all."""

    def pack(batches):
        for batch in batches:
            columns = [pa.array([batch.column(name).to_numpy().tobytes()], pa.binary()) for name in ("pair", "n")]
            yield pa.RecordBatch.from_arrays(columns, names=["pairs", "counts"])

    return frozen(pairs.mapInArrow(pack, "pairs binary, counts binary"), "brown-pairs")


def _cells(pairs: DataFrame, classes: np.ndarray, n_lexicon: int, bigrams_only: bool = False) -> DataFrame:
    """(cell, n) of packed pairs: how often each lexicon word follows and precedes each class, and itself, and the class bigrams.

    Cells of word ``w`` are ``w * WIDTH`` on; behind the last word come the class
    bigrams. A task sends each of its cells once.
    """
    name, shared = uuid.uuid4().hex, pairs.sparkSession.sparkContext.broadcast(classes)
    size = 0 if bigrams_only else n_lexicon + 1

    def count(batches):
        of = held(name, lambda: shared.value)
        counts = np.zeros(size * WIDTH + TOTAL * TOTAL, np.int64)
        packs = (pack for batch in batches for pack in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for pair, n in packs:
            pair, n = np.frombuffer(pair, np.int64), np.frombuffer(n, np.int64)
            first, second = pair >> 16, pair & 0xFFFF
            a, b = of[first], of[second]
            np.add.at(counts, size * WIDTH + a * TOTAL + b, n)
            for word, side in ((second, a), (first, TOTAL + b), (np.where(first == second, first, size), 2 * TOTAL)):
                known = word < size
                np.add.at(counts, (word * WIDTH + side)[known], n[known])
        cells = np.flatnonzero(counts)
        at = np.where(cells < size * WIDTH, cells, cells - size * WIDTH + (n_lexicon + 1) * WIDTH)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[cells], pa.int64())], names=["cell", "n"])

    counted = pairs.select("pairs", "counts").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return counted if bigrams_only else frozen(counted, "brown-cells")


def _bigrams(cells: DataFrame, n_lexicon: int) -> np.ndarray:
    """The class bigrams, TOTAL x TOTAL, on the driver."""
    first = (n_lexicon + 1) * WIDTH
    out = np.zeros(TOTAL * TOTAL, np.int64)
    for cell, n in cells.filter(F.col("cell") >= first).collect():
        out[cell - first] = n
    return out.reshape(TOTAL, TOTAL)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def likelihood(bigrams: np.ndarray) -> float:
    """What the classes change of the log-likelihood: ``x log x`` over the bigrams less the same over both margins."""
    table = bigrams.astype(float)
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def gains(after: np.ndarray, before: np.ndarray, beside: float, table: np.ndarray) -> np.ndarray:
    """Change of the likelihood when a word joins each class in ``CHOICE``, but for a term that is the same for all.

    ``table`` has no bigram of the word. ``after`` and ``before`` count the other words'
    classes on its left and right, ``beside`` the word next to itself.
    """
    columns, rows = table[:, CHOICE], table[CHOICE].T
    left, right = _xlogx(columns + after[:, None]) - _xlogx(columns), _xlogx(rows + before[:, None]) - _xlogx(rows)
    # The cell of a class with itself gets both sides, once.
    own, at = np.arange(1, 1 + CLASSES), np.arange(CLASSES)
    both = table[own, own] + after[CHOICE] + before[CHOICE] + beside
    gain = left.sum(0) + right.sum(0) - left[own, at] - right[own, at] + _xlogx(both) - _xlogx(table[own, own])
    # Other words stand before and behind this one whatever its class.
    margin = table.sum(1)[CHOICE] + after[CHOICE]
    gain -= _xlogx(margin + before.sum() + beside) - _xlogx(margin)
    margin = table.sum(0)[CHOICE] + before[CHOICE]
    return gain - _xlogx(margin + after.sum() + beside) + _xlogx(margin)


CHOICE = slice(1, 1 + CLASSES)


def exchanged(
    counts: np.ndarray, beside: np.ndarray, classes: np.ndarray, bigrams: np.ndarray, alone: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """New classes of a block of words after one exchange sweep, and what each word gained by its move.

    ``counts`` is (words, 2, TOTAL): how often each word follows and precedes each
    class, ``beside`` how often it follows itself. With ``alone`` each word moves as if
    no other did.
    """
    table, out, gained = bigrams.astype(float), classes.copy(), np.zeros(len(classes))
    for w in range(len(out)):
        after, before, itself, a = counts[w, 0].astype(float), counts[w, 1].astype(float), float(beside[w]), out[w]
        if not after.any():
            continue
        after[a] -= itself
        before[a] -= itself
        table[:, a] -= after
        table[a, :] -= before
        table[a, a] -= itself
        # Neighbours of the same block may have moved since they were counted; their old cells may be short.
        gain = gains(after, before, itself, np.maximum(table, 0))
        best = int(np.argmax(gain))
        gained[w] = gain[best] - gain[a - 1]
        if gained[w] > 1e-6:
            out[w] = 1 + best
        to = a if alone else out[w]
        table[:, to] += after
        table[to, :] += before
        table[to, to] += itself
    return out, gained


def moved(counts: np.ndarray, classes: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """``exchanged`` for words that never follow themselves: the new classes alone."""
    return exchanged(counts, np.zeros(len(classes)), classes, bigrams)[0]


def _sweep(cells: DataFrame, classes: np.ndarray, bigrams: np.ndarray, n_lexicon: int, alone: bool) -> list[tuple[int, int]]:
    """(word number, new class) of the words that move in one sweep, those that gain most first: a task for each block."""

    def move(block):
        cell, n = block.column("cell").to_numpy(), block.column("n").to_numpy()
        first = int(cell.min()) // (WIDTH * BLOCK) * BLOCK
        size = min(BLOCK, n_lexicon + 1 - first)
        counts = np.zeros(size * WIDTH, np.int64)
        counts[cell - first * WIDTH] = n
        counts = counts.reshape(size, WIDTH)
        skip = 1 if first == 0 else 0  # the end token stays in its class
        old, counts = classes[first + skip : first + size], counts[skip:]
        new, gained = exchanged(counts[:, : 2 * TOTAL].reshape(-1, 2, TOTAL), counts[:, -1], old, bigrams, alone)
        went = np.flatnonzero(new != old)
        numbers = [pa.array(went + first + skip, pa.int64()), pa.array(new[went], pa.int64()), pa.array(gained[went], pa.float64())]
        return pa.table(numbers, names=["number", "class", "gained"])

    words = cells.filter(F.col("cell") < (n_lexicon + 1) * WIDTH)
    block = F.floor(F.col("cell") / (WIDTH * BLOCK)).alias("block")
    moves = words.groupBy(block).applyInArrow(move, "number long, class long, gained double").collect()
    return [(r["number"], r["class"]) for r in sorted(moves, key=lambda r: (-r["gained"], r["number"]))]


def clustered(pairs: DataFrame, n_lexicon: int, sweeps: int | None = None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Classes of all word numbers, their bigrams, and the likelihood after each sweep that was taken.

    Without a number of ``sweeps`` they go on until the likelihood stops rising.
    """
    pairs, classes = _packed(pairs), start_classes(n_lexicon)
    cells = _cells(pairs, classes, n_lexicon)
    bigrams = _bigrams(cells, n_lexicon)
    rise = [likelihood(bigrams)]
    while sweeps is None or len(rise) <= sweeps:
        better = False
        for alone in (False, True):
            moves = [] if better else _sweep(cells, classes, bigrams, n_lexicon, alone)
            while moves and not better:
                trial = classes.copy()
                numbers, to = zip(*moves)
                trial[list(numbers)] = to
                table = _bigrams(_cells(pairs, trial, n_lexicon, bigrams_only=True), n_lexicon)
                better = likelihood(table) > rise[-1]
                moves = moves[: len(moves) // 2]
        if not better:
            break
        classes, bigrams = trial, table
        rise.append(likelihood(table))
        if rise[-1] - rise[-2] <= TOLERANCE * abs(rise[-2]):
            break
        if sweeps is None or len(rise) <= sweeps:
            cells = _cells(pairs, classes, n_lexicon)
    return classes, bigrams, rise


# --- the model ------------------------------------------------------------------------


@dataclass
class Model:
    """A fitted model: its tables, and the counts of all training tokens."""

    lexicon: list[bytes]
    classes: np.ndarray  # class of each word number
    transition: np.ndarray  # log10 probability, TOTAL x TOTAL
    emission: np.ndarray  # log10 probability of a lexicon word (or the end) in its class, by word number
    form_share: np.ndarray  # log10 of tokens + distinct words + 1 of each class of forms
    held: dict[bytes, int]  # counts of the most frequent tokens
    counts: DataFrame  # (word, n)
    total: int
    distinct: int


@F.arrow_udf(IntegerType())
def form_of(words: pa.Array) -> pa.Array:
    return pa.array([form((w or "").encode("utf-8", "replace")) for w in words.to_pylist()], pa.int32())


def number_words(texts: DataFrame, lexicon: int, frequent: list[bytes]) -> DataFrame:
    """(numbers): each text as packed 16-bit word numbers."""
    name, shared = uuid.uuid4().hex, texts.sparkSession.sparkContext.broadcast(frequent)

    @F.arrow_udf(BinaryType())
    def numbered(column: pa.Array) -> pa.Array:
        numbers = held(name, lambda: Numbers(lexicon, shared.value))
        return pa.array([numbers.of(tokens(t.as_py())).tobytes() for t in column], pa.binary())

    return texts.select(numbered(F.col("text")).alias("numbers"))


def fit(texts: DataFrame, lexicon: int = LEXICON, sweeps: int | None = None) -> Model:
    """A model of the texts (column ``text``)."""
    counts = frozen(word_counts(texts), "brown-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    real = counts.filter(F.col("word") != END_WORD)
    chosen = {r.word for r in most_frequent(real, lexicon)}
    # Both cuts are in one order, so all of the lexicon is among these; it comes first.
    top = sorted(most_frequent(real, max(HELD_COUNTS, lexicon)), key=lambda r: r.word not in chosen)
    frequent = [r.word.encode() for r in top]
    words = frequent[: len(chosen)]
    held_counts = {r.word.encode(): r.n for r in top}
    # The end is in every text and always held, whatever its rank.
    held_counts |= {END_WORD.encode(): r.n for r in counts.filter(F.col("word") == END_WORD).collect()}
    numbered = frozen(number_words(texts, len(words), frequent), "brown-numbers")

    classes, bigrams, _ = clustered(_pairs(numbered), len(words), sweeps)
    bigrams = bigrams.astype(float)

    tokens_of, distinct_of = np.zeros(FORMS), np.zeros(FORMS)
    others = counts.filter(F.col("word") != END_WORD).groupBy(form_of(F.col("word")).alias("form"))
    for f, n, v in others.agg(F.sum("n"), F.count(F.lit(1))).collect():
        tokens_of[f], distinct_of[f] = n, v
    for w in words:
        tokens_of[form(w)] -= held_counts[w]
        distinct_of[form(w)] -= 1

    columns, rows = bigrams.sum(0), bigrams.sum(1)
    own = (columns + 1) / (columns.sum() + TOTAL)
    kinds = (bigrams > 0).sum(1)
    mixed = (bigrams + kinds[:, None] * own) / np.maximum(rows + kinds, 1)[:, None]
    mixed[rows + kinds == 0] = own
    in_class = np.bincount(classes[1 : len(words) + 1], [held_counts[w] for w in words], minlength=TOTAL)
    emission = np.zeros(len(words) + 1)
    for i, w in enumerate(words):
        emission[i + 1] = np.log10(held_counts[w] / in_class[classes[i + 1]])
    return Model(
        words, classes, np.log10(mixed), emission, np.log10(tokens_of + distinct_of + 1), held_counts, counts, total, distinct
    )


_RARE = pa.struct([("word", pa.string()), ("n", pa.int64()), ("form", pa.int32())])
_PARTS = StructType(
    [
        StructField("n_tokens", LongType()),
        StructField("n_known", LongType()),
        StructField("base", DoubleType()),
        StructField("score", DoubleType()),
        StructField(
            "rare",
            ArrayType(StructType([StructField("word", StringType()), StructField("n", LongType()), StructField("form", IntegerType())])),
        ),
    ]
)


class Scorer:
    """What a task needs to score texts: for each frequent word all that depends on it alone."""

    def __init__(self, lexicon, classes, transition, emission, form_share, held, total, distinct):
        self.transition, self.form_share = transition, form_share
        frequent = [w for w in held if w != END_WORD.encode()]
        self.ids = {w: i for i, w in enumerate(frequent)}
        self.end = len(frequent)
        size, forms = len(lexicon), np.array([form(w) for w in frequent] + [0], np.int64)
        counts = np.array([held[w] for w in frequent] + [held.get(END_WORD.encode(), 0)], np.int64)
        log = np.log10(counts + 1.0)
        self.known = counts > 0
        self.base = log - np.log10(total + distinct + 1)
        self.gives = log - form_share[forms]
        self.gives[:size], self.gives[-1] = emission[1:], 0.0
        self.classes = 1 + CLASSES + forms
        self.classes[:size], self.classes[-1] = classes[1 : size + 1], 0
        self.forms = Forms()

    def parts(self, text: str | None) -> tuple:
        """Numbers of tokens and known ones, base and score of a text without its words of unknown count, and these words."""
        words = tokens(text)
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        ids = np.append(ids, self.end)
        c, rare = self.classes[ids], {}
        where = np.flatnonzero(ids < 0)
        for i in where.tolist():
            w = words[i]
            rare[w] = rare.get(w, 0) + 1
            c[i] = 1 + CLASSES + self.forms[w]
        ids = ids[ids >= 0]
        score = self.transition[np.append(0, c[:-1]), c].sum() + self.gives[ids].sum()
        return len(c), int(self.known[ids].sum()), float(self.base[ids].sum()), float(score), rare


class Forms(dict):
    """Forms of words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = form(word)
        if len(word) <= 64:
            self[word] = value
        return value


def scored(docs: DataFrame, model: Model, keep: list[str], text: Column) -> DataFrame:
    """The columns ``keep``, then ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10 probabilities).

    Frequent words are scored where the text is; the others, grouped by text, are
    joined with the counts of all training tokens.
    """
    name, spark = uuid.uuid4().hex, docs.sparkSession
    names = ("lexicon", "classes", "transition", "emission", "form_share", "held", "total", "distinct")
    shared = spark.sparkContext.broadcast({n: getattr(model, n) for n in names})

    @F.arrow_udf(_PARTS)
    def parts(column: pa.Array) -> pa.Array:
        scorer = held(name, lambda: Scorer(**shared.value))
        rows, offsets, words, counts, forms = [], [0], [], [], []
        for t in column:
            *numbers, rare = scorer.parts(t.as_py())
            rows.append(numbers)
            words += [w.decode("utf-8", "replace") for w in rare]
            counts += rare.values()
            forms += [scorer.forms[w] for w in rare]
            offsets.append(len(words))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        flat = pa.StructArray.from_arrays(
            [pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(forms, pa.int32())], fields=list(_RARE)
        )
        columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat))
        return pa.StructArray.from_arrays(columns, names=_PARTS.names)

    # The row number is fixed by writing it.
    rows = docs.select(F.struct(*keep).alias("doc"), F.monotonically_increasing_id().alias("row"), parts(text).alias("p"))
    rows = frozen(rows, "brown-parts")
    rare = rows.select("row", F.explode("p.rare").alias("r")).select("row", "r.*")
    met = rare.join(model.counts.withColumnRenamed("n", "c"), "word", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + 1.0)
    shares = F.array(*(F.lit(float(x)) for x in model.form_share))
    base_share = float(np.log10(model.total + model.distinct + 1))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * (log - base_share)).alias("base"),
        F.sum(F.col("n") * (log - shares[F.col("form")])).alias("score"),
    )
    return rows.join(sums, "row", "left").select(
        "doc.*",
        "p.n_tokens",
        (F.col("p.n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        (F.col("p.base") + F.coalesce(sums["base"], F.lit(0.0))).alias("base_score"),
        (F.col("p.score") + F.coalesce(sums["score"], F.lit(0.0))).alias("score"),
    )


def score_held_out(docs: DataFrame, spark: SparkSession, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the documents whose crc32 of the key leaves another remainder by 7 than 2, score all.

    Returns key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (unigram with one added) and ``score`` (log10 probability).
    """
    rest = F.crc32(docs[key].cast("string").cast("binary")) % 7
    rows = docs.select(docs[key].alias("id"), docs[text].cast("string").alias("text"), rest.alias("rest"))
    model = fit(rows.filter(F.col("rest") != 2).select("text"))
    held_out = F.coalesce(F.col("rest") == 2, F.lit(False)).alias("held_out")
    out = scored(rows.select("id", held_out, "text"), model, ["id", "held_out"], F.col("text"))
    return out.select(
        F.col("id").alias(key), "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
