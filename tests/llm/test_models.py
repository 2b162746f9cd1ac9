"""Class-based scoring, quality grades, chat trees and repeated passages."""

import math
import random
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import brute
from tidemark.llm import bpe, brown, chat, grades, suffixes
from tidemark.llm.queries import QUERIES
from tidemark.operators.blocks import Limits


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


# --- class-based scoring -------------------------------------------------------------


def test_exchange_finds_classes():
    """Words of two kinds that follow each other in turn end up in classes of one kind."""
    rng = random.Random(2)
    n = 40
    stream = np.array([1 + 2 * rng.randrange(n // 2) + i % 2 for i in range(40_000)])
    classes = brown.start_classes(n)
    classes[1 : n + 1] = 1 + np.array([rng.randrange(4) for _ in range(n)])

    def likelihood(table):
        f = brown._xlogx
        return f(table).sum() - f(table.sum(0)).sum() - f(table.sum(1)).sum()

    values = []
    for _ in range(4):
        c = classes[stream]
        table = np.zeros((brown.TOTAL, brown.TOTAL))
        np.add.at(table, (c[:-1], c[1:]), 1)
        values.append(likelihood(table))
        counts = np.zeros((n + 1, 2, brown.TOTAL), np.int64)
        np.add.at(counts, (stream[1:], 0, c[:-1]), 1)
        np.add.at(counts, (stream[:-1], 1, c[1:]), 1)
        classes[1 : n + 1] = brown.moved(counts[1:], classes[1 : n + 1], table)
    assert values[-1] > values[0] + 1000
    assert not set(classes[1 : n + 1 : 2]) & set(classes[2 : n + 1 : 2])


def stream_cells(stream, classes, n):
    """Class bigrams, counts (word, side, class) and self-pairs of a stream of word numbers."""
    c, table = classes[stream], np.zeros((brown.TOTAL, brown.TOTAL))
    np.add.at(table, (c[:-1], c[1:]), 1)
    counts = np.zeros((n + 1, 2, brown.TOTAL), np.int64)
    np.add.at(counts, (stream[1:], 0, c[:-1]), 1)
    np.add.at(counts, (stream[:-1], 1, c[1:]), 1)
    beside = np.bincount(stream[1:][stream[1:] == stream[:-1]], minlength=n + 1)
    return table, counts, beside


def test_gains_are_exact():
    """Each gain is the change of the likelihood that counting all bigrams anew gives, for words that follow themselves too."""
    rng = np.random.default_rng(4)
    n = 12
    stream = np.concatenate([[0], np.repeat(rng.integers(1, n + 1, 600), rng.integers(1, 4, 600)), [0]])
    classes = brown.start_classes(n)
    classes[1 : n + 1] = 1 + rng.integers(0, 5, n)
    table, counts, beside = stream_cells(stream, classes, n)
    assert beside[1:].min() > 0
    for w in range(1, n + 1):
        a, after, before = classes[w], counts[w, 0].astype(float), counts[w, 1].astype(float)
        after[a] -= beside[w]
        before[a] -= beside[w]
        without = table.copy()
        without[:, a] -= after
        without[a, :] -= before
        without[a, a] -= beside[w]
        assert without.min() >= 0
        got = brown.gains(after, before, beside[w], without)
        want = []
        for to in range(1, 1 + brown.CLASSES):
            other = classes.copy()
            other[w] = to
            want.append(brown.likelihood(stream_cells(stream, other, n)[0]))
        assert np.allclose(got - got[a - 1], np.array(want) - want[a - 1], atol=1e-6)


def test_the_likelihood_never_falls(spark, folder, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    words = brown.most_frequent(brown.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")).filter("word != ''"), 120)
    words = [r.word.encode() for r in words]
    numbers = brown.Numbers(len(words), words)
    lines = [numbers.of(brown.tokens(t)) for t in texts]
    numbered = spark.createDataFrame([(x.tobytes(),) for x in lines], "numbers binary").repartition(3)
    pairs = brown._pairs(numbered)
    stream = np.concatenate([[0], *lines]).astype(np.int64)
    want = {}
    for pair in zip(stream[:-1].tolist(), stream[1:].tolist()):
        want[pair] = want.get(pair, 0) + 1
    # Batches begin with the end token, which every text before them ends with.
    assert {(r.pair >> 16, r.pair & 0xFFFF): r.n for r in pairs.collect()} == want
    monkeypatch.setattr(brown, "BLOCK", 40)
    monkeypatch.setattr(brown, "TOLERANCE", 0)
    classes, bigrams, rise = brown.clustered(pairs, len(words))
    assert len(rise) > 3 and all(x < y for x, y in zip(rise, rise[1:]))
    table, counts, beside = stream_cells(stream, classes, len(words) + brown.FORMS)
    assert (bigrams == table).all() and math.isclose(rise[-1], brown.likelihood(table))
    # The end token and the forms stay where they are, and no word alone would raise the likelihood by moving.
    assert classes[0] == 0 and (classes[len(words) + 1 :] == brown.start_classes(len(words))[len(words) + 1 :]).all()
    for w in range(1, len(words) + 1):
        _, gained = brown.exchanged(counts[w : w + 1], beside[w : w + 1], classes[w : w + 1], table)
        assert gained[0] < 1e-3
    # A number of sweeps is a bound.
    assert brown.clustered(pairs, len(words), 2)[2] == rise[:3] and brown.clustered(pairs, len(words), 0)[2] == rise[:1]


def test_scores_against_plain(spark, folder, monkeypatch):
    """Scores by the formula of the module, over classes of a fitted model, word by word."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    monkeypatch.setattr(brown, "HELD_COUNTS", 700)
    train = [brown.tokens(r.text) for r in docs.filter("doc_id % 2 = 0").collect()]
    model = brown.fit(docs.filter("doc_id % 2 = 0").select("text"), lexicon=300, sweeps=2)
    lexicon = {w: int(model.classes[1 + i]) for i, w in enumerate(model.lexicon)}
    in_class = lambda w: 0 if w == b"" else lexicon.get(w, 1 + brown.CLASSES + brown.form(w))
    counts, seen, kind_tokens, kind_words = {}, np.zeros((brown.TOTAL, brown.TOTAL)), np.zeros(brown.TOTAL), np.zeros(brown.TOTAL)
    for words in train:
        last = 0
        for w in [*words, b""]:
            counts[w] = counts.get(w, 0) + 1
            seen[last, in_class(w)] += 1
            last = in_class(w)
    for w, n in counts.items():
        kind_tokens[in_class(w)] += n
        kind_words[in_class(w)] += 1
    own = (seen.sum(0) + 1) / (seen.sum() + brown.TOTAL)
    kinds = (seen > 0).sum(1)

    def plain(text):
        total, last = 0.0, 0
        for w in [*brown.tokens(text), b""]:
            c, n = in_class(w), counts.get(w, 0)
            p = own[c] if not seen[last].any() else (seen[last, c] + kinds[last] * own[c]) / (seen[last].sum() + kinds[last])
            if w in lexicon:
                p *= n / kind_tokens[c]
            elif w:
                p *= (n + 1) / (kind_tokens[c] + kind_words[c] + 1)
            total, last = total + math.log10(p), c
        return total

    got = {r.doc_id: r.score for r in brown.scored(docs, model, ["doc_id"], docs["text"]).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        assert math.isclose(got[i], plain(text), rel_tol=1e-9)


def test_numbers_forget_and_keep():
    numbers = brown.Numbers(2, [b"the", b"of", b"and"], keep=3)
    words = [b"the", b"a1", b"\xc3\xa9t\xc3\xa9", b"of", b"zzz", b"!!", b"the", b"\xff"] * 3
    first = numbers.of(words).tolist()
    assert first[:1] == [1] and first[3] == 2 and first[-1] == brown.END
    assert first == [*(numbers[w] for w in words), 0]


def test_transitions_and_emissions_sum_to_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text")
    model = brown.fit(docs, lexicon=500, sweeps=1)
    assert np.allclose((10**model.transition).sum(1), 1)
    lexicon = 10 ** model.emission[1:]
    for c in set(model.classes[1 : len(model.lexicon) + 1]):
        assert abs(lexicon[model.classes[1 : len(model.lexicon) + 1] == c].sum() - 1) < 1e-9
    assert (model.classes[1 + len(model.lexicon) :] > brown.CLASSES).all()


def test_rare_words_are_joined(spark, folder, monkeypatch):
    """The score does not depend on which counts a task holds."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    whole = {r.doc_id: r for r in brown.score_held_out(docs, spark).collect()}
    monkeypatch.setattr(brown, "HELD_COUNTS", 9000)
    for r in brown.score_held_out(docs, spark).collect():
        w = whole[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (w.n_tokens, w.n_known, w.train_tokens)
        assert math.isclose(r.base_score, w.base_score, rel_tol=1e-9) and math.isclose(r.score, w.score, rel_tol=1e-9)


def test_most_frequent_words_of_equal_count(spark):
    """The cut is exact also inside one magnitude and inside one count."""
    counts = spark.range(20_000).selectExpr("concat('w', id) AS word", "7L AS n").cache()
    assert len(brown.most_frequent(counts, 8_192)) == 8_192 and len(brown.most_frequent(counts, 20_000)) == 20_000
    more = counts.unionAll(spark.range(3_000).selectExpr("concat('v', id) AS word", "1000 + id % 30 AS n"))
    most = brown.most_frequent(more, 2_000)
    want = sorted((1000 + i % 30 for i in range(3_000)), reverse=True)[:2_000]
    assert [r.n for r in most] == want
    fewer = {r.word for r in brown.most_frequent(more, 1_234)}
    assert len(fewer) == 1_234 and fewer <= {r.word for r in most}
    assert brown.most_frequent(counts, 0) == [] and brown.most_frequent(counts.limit(0), 5) == []


def test_flat_words_and_the_end_are_held(spark, monkeypatch):
    """A lexicon of words of equal count, and an end token that more words than are held reach."""
    text = " ".join(f"w{i}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text + " " + text)], "id int, text string")
    model = brown.fit(docs, sweeps=0)
    assert len(model.lexicon) == 8_192
    monkeypatch.setattr(brown, "HELD_COUNTS", 5)
    model = brown.fit(docs, lexicon=3, sweeps=0)
    assert len(model.lexicon) == 3 and len(model.held) == 6 and model.held[b""] == 1
    (row,) = brown.scored(docs, model, ["id"], docs["text"]).collect()
    assert (row.n_tokens, row.n_known) == (40_001, 40_001)


def test_op4_against_plain(spark):
    folder = "/root/testdata/sf0.01"
    rows = rows_of(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")
    want, better, worse = brute.unigram(rows), 0.0, 0.0
    for r in QUERIES["op4_class_scoring"](spark, folder).collect():
        held_out, n_tokens, n_known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n_tokens, n_known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        if held_out:
            better, worse = better + r.score, worse + base
    assert better > worse * 0.97  # the classes say more about unseen texts than counts alone


def test_scoring_of_awkward_rows(spark, awkward, no_documents):
    assert brown.score_held_out(no_documents, spark).count() == 0
    got = brown.score_held_out(awkward, spark).collect()
    assert len(got) == awkward.count()
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) and r.n_tokens >= 1 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}


# --- quality grades --------------------------------------------------------------------


def plain_loss(z, grade, cuts):
    """Minus the log-likelihood by the definition, grade by grade."""
    total = 0.0
    for x, g in zip(z, grade):
        above = [1.0, *(1 / (1 + math.exp(t - x)) for t in cuts), 0.0]
        total -= math.log(above[g] - above[g + 1])
    return total


def test_likelihood_and_its_slopes():
    rng = np.random.default_rng(3)
    z, grade, free, h = rng.normal(0, 3, 200), rng.integers(0, 3, 200), np.array([-0.7, 0.4]), 1e-5
    value, by_z, by_free = grades.loss(z, grade, free)
    assert value == pytest.approx(plain_loss(z, grade, grades.thresholds_of(free)), rel=1e-10)
    for i in range(2):
        step = np.eye(2)[i] * h
        slope = (plain_loss(z, grade, grades.thresholds_of(free + step)) - plain_loss(z, grade, grades.thresholds_of(free - step))) / (2 * h)
        assert by_free[i] == pytest.approx(slope, rel=1e-5)
    for i in range(20):
        cuts = grades.thresholds_of(free)
        slope = (plain_loss([z[i] + h], [grade[i]], cuts) - plain_loss([z[i] - h], [grade[i]], cuts)) / (2 * h)
        assert by_z[i] == pytest.approx(slope, rel=1e-4, abs=1e-8)
    far, _, slopes = grades.loss(np.array([300.0, -300.0, 300.0]), np.array([0, 2, 1]), np.array([0.0, -8.0]))
    assert np.isfinite(far) and np.isfinite(slopes).all()


def test_a_fit_reaches_the_plain_optimum():
    """One feature, grades drawn from a known model: no plain step from the fitted numbers lowers the loss."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, 4000)
    grade = (x[:, None] * 2 + rng.logistic(size=4000)[:, None] > np.array([-0.5, 1.5])).sum(1)
    signed = [(np.array([7 if v > 0 else 8]), np.array([abs(v)], np.float32), int(g)) for v, g in zip(x, grade)]
    model = grades.fit_rows(signed)
    w7, w8 = float(model.weights[7]), float(model.weights[8])
    assert (w7, w8, *model.thresholds) == pytest.approx((2, -2, -0.5, 1.5), abs=0.25)

    def cost(w7, w8, low, high):
        z = [w7 * v if v > 0 else -w8 * v for v in x]
        return plain_loss(z, grade, [low, high]) / 4000 + grades.PENALTY / 2 * (w7 * w7 + w8 * w8)

    best = cost(w7, w8, *model.thresholds)
    for i in range(4):
        for move in (-0.05, 0.05):
            there = np.array([w7, w8, *model.thresholds])
            there[i] += move
            assert cost(*there) > best


def test_scores_are_features_times_weights(spark):
    rng = np.random.default_rng(7)
    model = grades.Model(rng.normal(0, 1, grades.PLACES).astype(np.float32), np.array([-1.0, 1.0]))
    texts = ["", None, "One one, ONE two 33 ((x))", "a b a b " * 40, "!? -- \u00e9\u00c9 " + "w" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = docs.select("doc_id", grades.graded(docs, model, docs.text).alias("g")).collect()
    for r in found:
        z = sum(float(model.weights[p]) * v for p, v in grades.features(texts[r.doc_id]).items())
        above = [1 / (1 + math.exp(t - z)) for t in model.thresholds]
        assert (r.g.expected_grade, r.g.top_probability) == pytest.approx((sum(above), above[1]), rel=1e-6)


def test_grades_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 4 <> 1"), labels.filter("doc_id % 4 = 1")
    rows = grades.classified(docs, train).join(test, "doc_id").collect()

    def kept(of):
        found = [r.kept for r in rows if of(r)]
        return sum(found) / len(found)

    assert kept(lambda r: r.quality == 1 and r.toxic == 0) > 0.95
    assert kept(lambda r: r.quality == 0) < 0.15
    assert kept(lambda r: r.toxic == 1) < 0.55  # a third of these have no toxic word
    means = [np.mean([r.expected_grade for r in rows if r.quality + 1 - r.toxic == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    assert all(0 <= r.top_probability <= 1 and r.top_probability <= r.expected_grade for r in rows)


def test_grades_do_not_depend_on_layout(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    first = sorted(rows_of(grades.classified(docs, labels), "doc_id", "top_probability"))
    again = sorted(rows_of(grades.classified(docs.repartition(7), labels.repartition(3)), "doc_id", "top_probability"))
    assert first == again


def test_grades_of_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame(
        [(4, 1, 0, "a"), (4, 0, 1, "b"), (5, None, 0, "c"), (None, 1, 1, "d"), (99, 1, 0, "e"), (6, 0, 0, "f"), (7, 7, 0, "g")],
        "doc_id long, quality int, toxic int, text string",
    )
    for docs in (awkward, no_documents):
        for some in (labels, labels.filter("doc_id > 1000")):
            got = grades.classified(docs, some).collect()
            assert len(got) == docs.count()
            assert all(r.kept is not None for r in got)
    assert {r.kept for r in grades.classified(awkward, labels.filter("doc_id > 1000")).collect()} == {True}


# --- chat trees --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer(spark):
    return bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_escaping_is_reversible():
    rng = random.Random(9)
    parts = [*chat.CONTROL, "\\", "<", "s>", "[", "INST]", "/", "SYS>>", "x", " ", "\n", "<\\s>", "[\\\\/INST]"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        safe = chat.escaped(text)
        assert chat.unescaped(safe) == text
        assert not any(c in safe for c in chat.CONTROL)


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


CHATS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", "a"), (1, 3, "assistant", "b"),
    (2, 0, "user", "hello"), (2, 1, "assistant", "hi"), (2, 2, "user", "c"),
    (3, 0, "user", "hello"), (3, 1, "assistant", "no"),
    (4, 0, "user", "hello"), (4, 1, "assistant", "hi"), (4, 2, "user", "a"), (4, 3, "assistant", "b"),
    (5, 0, "system", "<<SYS>> [INST] <\\s>"), (5, 1, None, None), (5, None, "assistant", "x\n</s>[/INST]"),
    (6, 0, "assistant", ""), (6, 0, "assistant", ""), (6, 0, "[/INST]\n", " y "),
    (None, 1, "user", "no id"), (None, 0, "assistant", "é日本 \U0001f600"),
]


def check_tree(tree, rows, n_shared=None):
    nodes = tree.nodes().collect()
    by_node = {n.node: n for n in nodes}
    assert len(by_node) == len(nodes)
    for tree_id in {n.tree for n in nodes}:
        # The packed sequence has no gap, and stands depth-first.
        own = sorted((n for n in nodes if n.tree == tree_id), key=lambda n: n.packed_start)
        at, stack = 0, []
        for n in own:
            assert n.packed_start == at and n.n_tokens == len(n.ids)
            at += n.n_tokens
            stack = stack[: n.depth]
            assert (stack[-1] if stack else None) == n.parent
            covered = [(by_node[x].packed_start, by_node[x].packed_start + by_node[x].n_tokens) for x in stack]
            assert sorted(i for a, b in covered for i in range(a, b)) == [i for s in n.attends for i in range(s.start, s.end)]
            assert n.position_start == sum(b - a for a, b in covered)
            assert all(x.end < y.start for x, y in zip(n.attends, n.attends[1:]))
            stack.append(n.node)
    want = brute.chat(rows)
    got = {r.conv: r.turns for r in tree.read_back(tree.nodes()).collect()}
    assert got.keys() == want.keys()
    for conv, turns in got.items():
        said = "".join(f"{t.role}\n{t.text}\n" for t in turns)
        loss = "".join(t.loss for t in turns)
        assert (len(turns), brute.sha(said), len(loss), brute.sha(loss)) == want[conv]
    return nodes


def test_tree_of_shared_turns(spark, tokenizer):
    nodes = check_tree(chat.PrefixTree(conversations(spark, CHATS), tokenizer), CHATS)
    assert len([n for n in nodes if n.depth == 0]) == 4
    assert len(nodes) == 1 + 2 + 2 + 1 + 3 + 3 + 2


def test_tree_of_random_conversations(spark, tokenizer):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice("ab")) for c in range(80) for t in range(rng.randrange(1, 9))]
    check_tree(chat.PrefixTree(conversations(spark, rows), tokenizer), rows)


def digests_of(tree, nodes=None):
    rows = tree.digests(tree.nodes() if nodes is None else nodes).collect()
    return {r.conv: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_tree_in_blocks(spark, tokenizer):
    # Conversations, trees and pieces are all cut into blocks of a few rows.
    rng = random.Random(16)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice("ab")) for c in range(60) for t in range(rng.randrange(1, 25))]
    rows += [(c, t, "user", str(t) if t < 30 + c else f"{c} {t}") for c in (100, 101, 102) for t in range(60)]
    tree = chat.PrefixTree(conversations(spark, rows).repartition(3), tokenizer, limits=Limits(0, 4))
    check_tree(tree, rows)
    assert digests_of(tree) == brute.chat(rows)


def test_reading_back_goes_through_the_packed_sequence(spark, tokenizer):
    tree = chat.PrefixTree(conversations(spark, CHATS), tokenizer)
    nodes = tree.nodes().cache()
    want = brute.chat(CHATS)
    assert digests_of(tree, nodes) == want
    # Without the intervals of ancestors a conversation does not begin at position 0.
    blind = nodes.withColumn("attends", F.slice("attends", 1, 0))
    with pytest.raises(Exception, match="position"):
        digests_of(tree, blind)
    shifted = nodes.withColumn("position_start", F.col("position_start") + F.when(F.col("depth") == 2, 1).otherwise(0))
    with pytest.raises(Exception, match="position"):
        digests_of(tree, shifted)
    # Intervals that are one turn off, and the same number of tokens long, show in the digests.
    said = {1: [("user", "x"), ("user", "y"), ("user", "z")], 2: [("user", "x"), ("user", "q"), ("user", "r")]}
    rows = [(c, t, *turn) for c, turns in said.items() for t, turn in enumerate(turns)]
    tree = chat.PrefixTree(conversations(spark, rows), tokenizer)
    nodes = tree.nodes().cache()
    assert digests_of(tree, nodes) == brute.chat(rows)
    size = nodes.first().n_tokens
    assert {n.n_tokens for n in nodes.collect()} == {size}
    late = nodes.filter((F.col("depth") == 2) & (F.size("attends") > 1)).first()
    own = F.struct(F.lit(0).cast("long").alias("start"), F.lit(2 * size).cast("long").alias("end"))
    swapped = nodes.withColumn("attends", F.when(F.col("node") == late.node, F.array(own)).otherwise(F.col("attends")))
    got, want = digests_of(tree, swapped), brute.chat(rows)
    assert [got[c] == want[c] for c in sorted(want)].count(False) == 1


def test_a_very_long_conversation(spark, tokenizer):
    n = 100_000
    turn = F.col("id")
    role = F.when(turn % 2 == 0, "user").otherwise("assistant")
    one = spark.range(n).select(F.lit(7).cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), turn.cast("string").alias("text"))
    # Others leave it at its beginning, in its midst and at its end.
    others = [one.filter(turn < k).withColumn("conv_id", F.lit(k).cast("long")) for k in (1, n // 2, n)]
    apart = one.filter(F.col("turn") < n // 2).withColumn("conv_id", F.lit(8).cast("long"))
    apart = apart.withColumn("text", F.when(F.col("turn") < n // 4, F.col("text")).otherwise(F.concat(F.lit("b"), "text")))
    rows = reduce(DataFrame.unionByName, [*others, apart], one)
    tree = chat.PrefixTree(rows.repartition(6), tokenizer, limits=Limits(0, 20_000))
    assert digests_of(tree) == brute.chat(rows_of(rows, "conv_id", "turn", "role", "text"))
    assert tree.tokens.count() == n + n // 4


def test_chats_with_columns_of_the_same_names(spark, tokenizer):
    rows = conversations(spark, CHATS)
    names = ["conv", "node", "place", "tree", "depth", "parent", "row", "at", "own", "part0", "root0", "stretch", "c", "n_tokens"]
    clash = rows.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))
    assert digests_of(chat.PrefixTree(clash, tokenizer)) == brute.chat(CHATS)


def test_op6_against_plain(spark, folder):
    rows = rows_of(spark.read.parquet(f"{folder}/conversations.parquet"), "conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    want = brute.chat([*rows, (-1, 0, "user", says), (-1, 1, "assistant", says)])
    got = QUERIES["op6_chat_prefix_tree"](spark, folder).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want


def test_no_conversations(spark, tokenizer):
    tree = chat.PrefixTree(conversations(spark, []), tokenizer)
    assert tree.nodes().count() == 0 and tree.read_back(tree.nodes()).count() == 0
    assert digests_of(tree) == {}


# --- repeated passages ---------------------------------------------------------------------


def test_every_passage_has_a_selected_place():
    rng = np.random.default_rng(8)
    for n in (49, 50, 51, 300):
        places = suffixes.selected(suffixes.gram_hashes([b"%d" % x for x in rng.integers(0, 50, n)]))
        for start in range(n - suffixes.LEAST + 1):
            assert any(start <= p and p + suffixes.GRAM <= start + suffixes.LEAST for p in places)


@pytest.mark.parametrize("few", [True, False])
def test_repeated_passages_against_plain(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(suffixes, "BROADCAST_ROWS", -1)
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(5000)}"
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 120, 400)]
    texts = []
    for _ in range(60):
        parts = [[word() for _ in range(rng.randrange(80))], rng.choice(passages), [word() for _ in range(rng.randrange(80))]]
        texts.append(" ".join(sum(parts, [])))
    texts += [" ".join(word() for _ in range(150))] * 3 + ["short text"] * 2 + ["Upper " * 30, "upper " * 30, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = brute.repeated_words(texts)
    got = {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in suffixes.repeated_passages(docs).collect()}
    assert got == {i: w for i, w in enumerate(want) if w}


def test_copies_apart_in_both_orders(spark):
    """X Y Z in a few texts, many with X Y or Y Z alone: the copies are neighbours in neither order."""
    rng = random.Random(31)
    word = lambda: f"w{rng.randrange(100_000)}"
    texts = []
    for _ in range(6):
        x, y, z = ([word() for _ in range(20)] for _ in range(3))
        pad = lambda: [word() for _ in range(60)]
        texts += [" ".join(pad() + x + y + z + pad()) for _ in range(3)]
        texts += [" ".join(pad() + part + pad()) for part in (x + y, y + z) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = brute.repeated_words(texts)
    rows = suffixes.repeated_passages(docs).collect()
    got = {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in rows}
    assert got == {i: w for i, w in enumerate(want) if w} and len(got) >= 6
    assert all(r.others and any(o // 83 == r.doc_id // 83 for o in r.others) for r in rows)


def test_words_in_common_against_plain():
    rng = random.Random(41)
    texts = ["", "a", "a b", "ab", "a bc", "é a", *(" ".join(rng.choices(["a", "b", "ab", "é"], k=rng.randrange(6))) for _ in range(60))]
    for a in texts:
        for b in texts:
            n = 0
            for x, y in zip(a.split(), b.split()):
                if x != y:
                    break
                n += 1
            assert suffixes.words_in_common(a, b) == n, (a, b)


def test_a_form_letter_sends_one_window(spark, monkeypatch):
    """Many copies of a long passage around Y beside X Y Z: their windows are asked for, but only leaders answer."""
    rng = random.Random(37)
    word = lambda: f"w{rng.randrange(100_000)}"
    words = lambda n: [word() for _ in range(n)]
    texts = []
    for _ in range(6):
        x, y, z, before, behind = (words(20) for _ in range(5))
        texts += [" ".join(words(60) + x + y + z + words(60)) for _ in range(3)]
        texts += [" ".join(words(60) + part + words(60)) for part in (x + y, y + z) for _ in range(30)]
        texts += [" ".join(words(60) + before + y + behind + words(60)) for _ in range(60)]
    written = {}
    frozen = suffixes.frozen

    def counted(df, name):
        written[name] = frozen(df, name)
        return written[name]

    monkeypatch.setattr(suffixes, "frozen", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = brute.repeated_words(texts)
    got = {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in suffixes.repeated_passages(docs).collect()}
    assert got == {i: w for i, w in enumerate(want) if w} and len(got) >= 6 * 63
    asked = written["suffix-asked"].count()
    assert 0 < written["suffix-windows"].count() <= 10 * asked


def test_op10_against_plain(spark, folder):
    rows = rows_of(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")
    want = {i: w for (i, _), w in zip(rows, brute.repeated_words([t for _, t in rows])) if w}
    got = QUERIES["op10_repeated_passages"](spark, folder).collect()
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        spans = [tuple(map(int, s.split(":"))) for s in r.spans.split(",")]
        assert {i for a, b in spans for i in range(a, b)} == want[r.doc_id]
        assert r.n_repeated == len(want[r.doc_id])


def test_passages_of_awkward_rows(awkward, no_documents):
    assert suffixes.repeated_passages(no_documents).count() == 0
    got = suffixes.repeated_passages(awkward).collect()
    assert {r.doc_id for r in got} == {5, 7}
    assert {r.doc_id: r.n_repeated for r in got} == {5: 60_000, 7: 40_000}
