"""The pipeline, stage by stage, against plain versions."""

import public_tokenizers
import pytest
import tiktoken

import brute
import corpus_pipeline
from tidemark.llm import bpe, rules, secrets


def plain_stages(docs, items):
    """ids and texts of the documents after each stage, from a dict id -> text."""
    book = {m: i for i, m in enumerate(rules.MEASURES)}

    def kept(text):
        m = rules.measure(text)
        q = brute.quality(text)
        assert all(m[book[k]] == v for k, v in q.items() if k in book)
        n, lines = m[book["n_words"]], m[book["n_lines"]]
        bad = q["base_failed"] or (10 * q["n_symbols"] > n and q["n_symbols"] >= 3)
        bad |= 100 * q["n_dup_lines"] > 30 * lines and q["n_dup_lines"] >= 2
        bad |= n > 0 and not 2 * n <= q["word_chars"] <= 20 * n
        bad |= 100 * m[book["n_caps_words"]] > 50 * n or 100 * m[book["n_plain_words"]] < 60 * n
        return not bad

    docs = {i: t for i, t in docs.items() if kept(t)}
    yield docs
    docs = {i: docs[i] for i, _, c in brute.near_duplicates(list(docs.items())) if i == c}
    yield docs
    docs = {i: t for i, t in docs.items() if brute.contamination(t, items)[1] == 0}
    yield docs
    yield {i: masked(t) for i, t in docs.items()}


def masked(text):
    spans = brute.secret_base(text) + brute.random_base(text, secrets.CLASSES, secrets.ALLOWED, secrets.ALLOWED_PARTS)
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start > at or not out:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_every_stage_against_plain(spark, folder):
    source = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs, columns = source, source.columns
    plain = plain_stages({r.doc_id: r.text for r in source.collect()}, items)
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain):
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
        rows = docs.collect()
        assert {r.doc_id: r.text for r in rows} == want, name
        assert all(r.n_chars == len(r.text) for r in rows) or name != "secret_scan"
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: list(r.ids) for r in got} == {i: library.encode_ordinary(t) for i, t in want.items()}
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in got)


def test_stages_on_awkward_rows(spark, awkward, no_documents, folder):
    for docs in (awkward, no_documents):
        docs = docs.selectExpr("doc_id", "text", "'en' AS lang", "source", "length(text) AS n_chars", "1 AS key", "2 AS row", "3 AS measures")
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, folder)
            assert got.columns == docs.columns or name == "byte_level_bpe"
            assert got.count() <= docs.count()
