"""Token counts, importance resampling and fill-in-the-middle against plain versions."""

import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

import brute
from tidemark.llm import importance, infill, lengths
from tidemark.llm.queries import QUERIES

PIECES = ["a", "Bc ", " de", "'s", "'ll", "12", " 3", "\n", "\n\n ", "\t", "  ", "!?", "<|endoftext|>", "<|end", "of", "é", "日本", "\U0001f600", " ", " ", "x1y2", "-"]


def made_up(seed, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(longest))) for _ in range(n)]


# --- token counts ----------------------------------------------------------------------


def file_of(name):
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def library_counts(name, texts):
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        return [len(ids) for ids in model.encode([t or "" for t in texts], num_threads=1)]
    model = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
    return [len(model.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_pieces_count_as_whole_texts(name):
    texts = [None, "", *made_up(3, 300, 120), "a" * 5_000, " " * 3_000 + "b"]
    library = lengths.Library(name, file_of(name))
    assert library.cuts == (name == "byte_bpe_50k.json")
    want = library_counts(name, texts)
    for batch, piece in [(1 << 18, 1 << 15), (64, 1), (1, 7), (300, 40)]:
        assert library.counts(pa.array(texts, pa.string()), batch, piece) == want


@pytest.mark.parametrize("kept", [1, 40, 300_000])
def test_words_are_counted_once_and_as_in_whole_texts(monkeypatch, kept):
    monkeypatch.setattr(lengths, "KEPT_WORDS", kept)
    rng = random.Random(11)
    marks = [*PIECES, "'", "'s", "don't", '"', "(", ")", ",", ".", "...", ":/", "?", "!", "\r\n", "\x1c", "\x85", "\u2003", "\u0301", "ɏ", "×", "ß", "Ωx", "²", "½", "_"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(60))) for _ in range(1_500)]
    texts += ["The same words, and the same words again. " * 40, "é" * 100 + " " + "z" * 100, "'" * 90 + "s"]
    library = lengths.Library("byte_bpe_50k.json", file_of("byte_bpe_50k.json"))
    seen, plain = [], library.lengths
    library.lengths = lambda some: seen.extend(some) or plain(some)
    assert library.counts(pa.array(texts, pa.string()), 2_000) == library_counts("byte_bpe_50k.json", texts)
    assert all("".join(lengths.WORD.findall(t)) == t for t in texts)
    if kept > len(seen):
        short = [w for w in seen if len(w) <= lengths.KEPT_LENGTH]
        assert len(short) == len(set(short)) and seen.count(" same") == 1


def test_pieces_are_the_text():
    for text in made_up(5, 200, 60):
        for size in (1, 5, 30):
            assert "".join(lengths.pieces(text, size)) == text


def test_a_tokenizer_with_other_rules_is_not_cut():
    config = json.loads(file_of("byte_bpe_50k.json"))
    assert lengths.may_cut(config)
    assert not lengths.may_cut({**config, "normalizer": {"type": "NFC"}})
    assert not lengths.may_cut({**config, "pre_tokenizer": {**config["pre_tokenizer"], "add_prefix_space": True}})
    assert not lengths.may_cut({**config, "added_tokens": [{**config["added_tokens"][0], "content": "a b"}]})
    assert not lengths.may_cut({**config, "added_tokens": [{**config["added_tokens"][0], "lstrip": True}]})


def test_op11_against_library(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(docs, library_counts("byte_bpe_50k.json", docs.values())))
    rows = QUERIES["op11_token_counts"](spark, folder).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == want and len(rows) == len(docs)
    assert all(r.n_bytes == len((docs[r.doc_id] or "").encode()) and r.over_limit == (r.n_tokens > 512) for r in rows)


def test_counts_of_awkward_rows(spark, awkward, no_documents):
    counter = lengths.TokenCounter(spark, public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    want = zip((i for i, _ in rows), library_counts("byte_bpe_50k.json", [t for _, t in rows]))
    got = lengths.token_counts(awkward, counter).collect()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_tokens)) for r in got)
    assert lengths.token_counts(no_documents, counter).count() == 0
    named = awkward.withColumnsRenamed({"doc_id": "n_tokens", "text": "n_bytes"}).withColumnRenamed("key", "key2")
    assert lengths.token_counts(named.withColumnRenamed("n_tokens", "id"), counter, 1, "id", "n_bytes").count() == len(rows)


# --- importance resampling ---------------------------------------------------------------

WORDS = ["the", "The", "of", "a1", "x", "straße", "日本", "w" * 40, "zeta", "eta", "no-one", "e.g."]


def corpus(seed, n, longest):
    rng = random.Random(seed)
    weights = [2.0 ** -i for i in range(len(WORDS))]
    return [" ".join(rng.choices(WORDS, weights, k=rng.randrange(longest))) for _ in range(n)]


def test_states_give_the_crc_of_bytes():
    rng = random.Random(2)
    for _ in range(200):
        a, b = rng.randbytes(rng.randrange(9)), rng.randbytes(rng.randrange(1, importance.HEAD_BYTES + 2))
        state = importance.advanced(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))
        assert int(state[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


@pytest.mark.parametrize("piece", [1, 30, 1 << 21])
@pytest.mark.parametrize("head", [0, 3, 100])
def test_features_against_plain(piece, head):
    texts = [None, "", "one", *corpus(4, 40, 30), " ".join(WORDS * 3)]
    words = [w.lower().encode() for w in ("the", "of", "a1", "x", "zeta", "eta")][:head]
    pairs = [b"the the", b"the of", b"of the", b"zeta eta"] if head else []
    hasher = importance.Hasher(importance.Head.of(words, pairs))
    got = [[] for _ in texts]
    for part in importance.worded(pa.array(texts, pa.string()), piece):
        for at, crc in hasher.features(part):
            for d, c in zip(part.doc[at].tolist(), crc.tolist()):
                got[d].append(c)
    for text, found in zip(texts, got):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.LOWER))
        runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
        assert sorted(found) == sorted(zlib.crc32(f.encode()) for f in runs)


def as_rows(df, key="doc_id"):
    return sorted(map(str, (tuple(r[c] for c in (key, "n_features", "weight", "score", "rank")) for r in df.collect())))


def test_resampled_against_plain(spark, monkeypatch):
    docs = [*enumerate([None, "", "the", *corpus(7, 300, 60)]), (5, "the " * 25), (5, "the " * 25), (None, "of " * 30)]
    target = [None, *corpus(8, 5, 30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    want = sorted(map(str, brute.resampled(docs, target, percent=30)))
    assert as_rows(importance.resampled(df, items, percent=30)) == want
    # Ranks put together from blocks, and a head of a few words.
    monkeypatch.setattr(importance, "GROUP_ROWS", 20)
    monkeypatch.setattr(importance, "HEAD", 4)
    assert as_rows(importance.resampled(df, items, percent=30)) == want


def test_the_head_is_what_is_frequent(spark):
    docs = spark.createDataFrame([("the cat sat on the mat " * 5,), ("the cat " * 9,), (None,), ("rare",)], "text string")
    head = importance.frequent(docs, head=2)
    assert head.words == [b"the", b"cat"]
    assert head.pairs.tolist() == [1, 2]
    assert importance.frequent(docs.filter("text IS NULL")).words == []


def test_a_summary_stays_small():
    summary = importance.Frequent(10)
    for i in range(5_000):
        summary.add([(b"often", 1), (str(i).encode(), 1)])
        assert len(summary.counts) <= 42
    assert summary.first()[0][0] == b"often"


def test_resampled_awkward_rows(spark, awkward, no_documents):
    items = spark.createDataFrame([("the quick brown fox jumps", 1)], "text string, key int")
    none = no_documents.select("text")
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    for target, plain in ((items, ["the quick brown fox jumps"]), (none, [])):
        got = importance.resampled(awkward, target, percent=50)
        assert as_rows(got) == sorted(map(str, brute.resampled(docs, plain, percent=50)))
    assert importance.resampled(no_documents, items).count() == 0


def test_op12_against_plain(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert as_rows(QUERIES["op12_importance_resampling"](spark, folder)) == sorted(map(str, brute.resampled(docs, target)))


# --- fill in the middle ------------------------------------------------------------------


@pytest.mark.parametrize("piece", [1, 2, 7, 1 << 20])
def test_cut_places_against_plain(monkeypatch, piece):
    monkeypatch.setattr(infill, "PIECE", piece)
    for text in ["", " ", "a", " a ", "ab  cd \n", *made_up(9, 60, 90), "é " * 700]:
        units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        data = np.frombuffer(text.encode(), np.uint8)
        ends = infill.unit_ends(data)
        assert np.diff(ends, prepend=0).tolist() == [len(u) for u in units]
        skips = infill.SkipList(np.diff(ends, prepend=0))
        for rank in {0, 1, len(units) // 2, len(units) - 1, len(units)}:
            if 0 <= rank <= len(units):
                assert skips.place(rank) == len("".join(units[:rank]))


def test_lanes_carry_the_widths_of_the_lane_below():
    widths = np.arange(1, 5_001)
    skips = infill.SkipList(widths)
    assert len(skips.lanes) == 4
    for (units, points), (above, wide) in zip(skips.lanes, skips.lanes[1:]):
        assert above.tolist() == [int(units[i : i + infill.FAN].sum()) for i in range(0, len(units), infill.FAN)]
        assert wide.tolist() == [int(points[i : i + infill.FAN].sum()) for i in range(0, len(points), infill.FAN)]
    assert [skips.place(r) for r in range(5_001)] == [0, *np.cumsum(widths).tolist()]


def test_infilled_against_plain(spark):
    texts = [None, "", " ", "x", "a <P> b c", "a <S b", "<M>", "<", "> <P", *made_up(10, 400, 40), "<P" + " >" * 9]
    docs = spark.createDataFrame([*enumerate(texts), (None, "no key at all")], "doc_id long, text string")
    made = infill.infilled(docs)
    got = made.withColumn("back", infill.restored(made["output"], made["form"])).collect()
    plain = {i: (t, brute.infilled(i, t)) for i, t in [*enumerate(texts), (None, "no key at all")]}
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        text, want = plain[r.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want
        assert r.back == (text or "")


def test_infilled_with_other_parameters(spark):
    marks = infill.Marks("[pre]", "[suf]", "[mid]")
    docs = spark.createDataFrame([*enumerate(made_up(12, 100, 20))], "key long, output string")
    made = infill.infilled(docs, 42, 100, 0, marks, "key", "output")
    rows = made.withColumn("back", infill.restored(made["output"], made["form"], marks)).join(docs.withColumnRenamed("output", "was"), "key")
    for r in rows.collect():
        assert r.back == r.was
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute.infilled(r.key, r.was, marks.all, 100, 0)
    for bad in [("<a", "a>", "m"), ("x", "x", "y"), ("", "a", "b"), ("<P>", "a<P>b", "m")]:
        with pytest.raises(ValueError):
            infill.Marks(*bad)


def test_infilled_awkward_rows(spark, awkward, no_documents):
    docs = {(r.doc_id, r.text) for r in awkward.collect()}
    made = infill.infilled(awkward)
    got = made.withColumn("back", infill.restored(made["output"], made["form"])).collect()
    assert len(got) == awkward.count()
    want = {(i, *brute.infilled(i, t), t or "") for i, t in docs}
    assert {(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got} == want
    assert infill.infilled(no_documents).count() == 0
