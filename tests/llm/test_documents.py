"""Benchmark decontamination and near duplicates against plain versions."""

import random

import numpy as np
import pytest

import brute
from tidemark.llm import decontaminate, neardup, shingles
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def by_text(row):
    return tuple(map(str, row))


# --- decontamination -------------------------------------------------------------

ITEMS = [
    ("long", "One two three four five six seven eight nine ten eleven twelve"),
    ("same", "one two three four five six seven eight nine ten"),
    ("ten", " ".join(["the"] * 30)),
    ("short", "red green blue"),
    ("word", "zebra!"),
    ("none", " ... "),
    (None, "alpha beta gamma delta epsilon zeta eta"),
    ("null", None),
    ("short", "pink purple"),
]
DOCUMENTS = [
    "x one two three four five six seven eight nine ten y",
    "one two three four five six seven eight nine",
    "a two three four five six seven eight nine ten eleven twelve b " * 3,
    "the " * 40,
    "the " * 9,
    "Red, GREEN blue! red green red green blue",
    "a zebra and zebra",
    "alpha beta gamma delta epsilon zeta eta theta alpha beta",
    "pink purple pink",
    "",
    None,
    "Ünder straße Ünder",
]


@pytest.mark.parametrize("few", [True, False])
def test_contamination_against_plain(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    rng = random.Random(11)
    extra = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(60))) for _ in range(60)]
    items = [*ITEMS, *((f"r{i}", " ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 15)))) for i in range(8))]
    texts = DOCUMENTS + extra
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = rows_of(decontaminate.contamination(docs, bench), "doc_id", "n_words", "n_hit", "items")
    assert sorted(got) == [(i, *brute.contamination(t, items)) for i, t in enumerate(texts)]
    kept = decontaminate.uncontaminated(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, n, _ in sorted(got) if n == 0]


def test_op2_against_plain(spark, folder):
    items = rows_of(spark.read.parquet(f"{folder}/benchmark.parquet"), "item_id", "text")
    docs = dict(rows_of(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text"))
    for r in QUERIES["op2_decontamination"](spark, folder).collect():
        n_words, n_hit, found = brute.contamination(docs[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items) == (n_words, n_hit, len(found))
        assert r.items_sha256 == brute.sha(",".join(found)) and r.contaminated == (n_hit > 0)


def test_contamination_of_awkward_rows(spark, awkward, no_documents):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog again", "z")], "item_id int, text string, window string")
    none = bench.filter("item_id > 1")
    assert decontaminate.contamination(no_documents, bench).count() == 0
    assert decontaminate.contamination(awkward, none).filter("n_hit > 0").count() == 0
    assert decontaminate.uncontaminated(awkward, none).count() == awkward.count()
    got = decontaminate.contamination(awkward, bench).filter("n_hit > 0").collect()
    assert [(r.doc_id, r.n_hit, r["items"]) for r in got] == [(None, 10, ["1"])]
    kept = decontaminate.uncontaminated(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 1


# --- near duplicates ---------------------------------------------------------------


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 60, 500, 5000):
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = pool[:n], pool[: n + n // 2]
        x, y = shingles.sketch(np.unique(a)), shingles.sketch(np.unique(b))
        assert (x != np.iinfo(np.uint64).max).all()
        if n >= 60:
            assert abs((x == y).mean() - 2 / 3) < 0.15
    assert (shingles.sketch(np.array([5], np.uint64)) == shingles.sketch(np.array([5], np.uint64))).all()


def copies(rng, words, n, changes):
    """Texts near to one text: each with a few words changed."""
    base = [rng.choice(words) for _ in range(120)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(changes + 1)):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_against_plain(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = ["", None, " \n", "one", "one", "One", "one two", "a b c d e", "a b c d e", "a b c d f"]
    for size, changes in ((40, 3), (25, 8), (10, 5), (2, 1), (2, 2), (2, 3)):
        texts += copies(rng, words, size, changes)
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(4, 200))) for _ in range(40)]
    # A chain: neighbours are linked, the ends are not.
    base = [rng.choice(words) for _ in range(100)]
    texts += [" ".join(base[i : i + 60]) for i in range(0, 40, 4)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = rows_of(neardup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    want = [(i, n, c, i == c) for i, n, c in brute.near_duplicates(rows)]
    assert sorted(got) == sorted(want)
    kept = neardup.one_of_each_group(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c, _ in want if i == c)


def test_op9_against_plain(spark, folder):
    rows = rows_of(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text")
    got = rows_of(QUERIES["op9_near_duplicates"](spark, folder), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(got) == sorted((i, n, c, i == c) for i, n, c in brute.near_duplicates(rows))


def test_near_duplicates_of_awkward_rows(awkward, no_documents):
    assert neardup.near_duplicates(no_documents).count() == 0
    assert neardup.one_of_each_group(no_documents).count() == 0
    rows = rows_of(awkward, "doc_id", "text")
    got = rows_of(neardup.near_duplicates(awkward), "doc_id", "n_shingles", "component_id")
    assert sorted(got, key=by_text) == sorted(brute.near_duplicates(rows), key=by_text)
    kept = neardup.one_of_each_group(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in {r[0] for r in rows})


def test_components(spark):
    rng = random.Random(4)
    for n, m in ((1, 0), (50, 30), (200, 150), (300, 299)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != 299 else [(i, i + 1) for i in range(299)]
        frame = spark.createDataFrame(pairs, "a long, b long")
        parent = list(range(n))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in pairs:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
        nodes = {x for p in pairs for x in p}
        assert sorted(rows_of(components(frame), "node", "label")) == sorted((i, find(i)) for i in nodes)


def test_a_shared_passage_and_a_wide_group_make_no_quadratic_work(spark):
    """Groups as they occur: many documents with one passage, and copies with any number of changes."""
    rng = random.Random(21)
    word = lambda: f"w{rng.randrange(20_000)}"
    passage = [word() for _ in range(40)]
    texts = [" ".join([word() for _ in range(60)] + passage + [word() for _ in range(40)]) for _ in range(120)]
    base = [word() for _ in range(150)]
    for _ in range(120):
        text = list(base)
        for _ in range(rng.randrange(26)):
            text[rng.randrange(150)] = word()
        texts.append(" ".join(text))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = rows_of(neardup.near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == sorted(brute.near_duplicates(rows))
