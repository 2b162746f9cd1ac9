"""Token counts of texts by the library of a tokenizer file, without their ids.

Arrow functions encode texts in batches and return lengths only. A batch of the
library is filled by bytes, not by rows, so that one with long texts costs as much
memory as one with short texts; a text longer than ``PIECE`` is cut at safe
boundaries and its pieces are counted one by one. A boundary is safe if no token
reaches across it whatever stands around it. For a byte-level tokenizer with the
usual pattern those are the places before a blank that follows no white space,
between letters, digits and punctuation (Latin letters, ASCII digits, the usual
marks), but not after an apostrophe: the pattern ends a match at each of them, and
looks ahead only from white space. A batch of such pieces is cut at all of these
places, and of the words that this gives, the library gets each one once as long as
its length is kept. Other tokenizers get whole texts.

Results, per row: NULL and empty texts have no tokens and no bytes; strings of
special tokens inside a text count as the library's defaults have it. Repeated rows
stay repeated, other columns are left alone, an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a library batch, and the length from which a text is cut (in characters); the words whose
# lengths are kept in a task (twice as many at most), and the longest that is kept. They bound the memory
# of a worker and change no result.
BATCH = 1 << 18
PIECE = 1 << 15
KEPT_WORDS = 300_000
KEPT_LENGTH = 48

# Letters, punctuation and other characters that are so in every version of Unicode.
LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
MARK = r'!"(),./:;?'
NO_SPACE = r"!-~\u00A1-\u167F"
SAFE = re.compile(
    rf"(?<=[{NO_SPACE}])(?=[ \t\n])"
    rf"|(?<=[{LETTER}])(?=[0-9'{MARK}])"
    rf"|(?<=[0-9])(?=[{LETTER}'{MARK}])"
    rf"|(?<=[{MARK}])(?=[{LETTER}0-9])"
)
# The text up to a safe boundary: the first two for speed, the last for all else.
WORD = re.compile(
    rf" ?[{LETTER}]++(?![^ \t\n0-9'{MARK}])"
    rf"|[{MARK}]++(?![^ \t\n0-9{LETTER}])"
    rf"|(?s:.)+?(?:{SAFE.pattern}|\Z)"
)


def may_cut(config: dict) -> bool:
    """Whether ``SAFE`` holds for a tokenizer file: byte-level, nothing before the pattern, plain added tokens."""
    split, model = config.get("pre_tokenizer") or {}, config.get("model") or {}
    added = config.get("added_tokens") or []
    return (
        config.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space", True)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or SAFE.search(t["content"]) for t in added)
    )


def pieces(text: str, size: int) -> Iterator[str]:
    """A text cut at the first safe boundary after every ``size`` characters."""
    at = 0
    while len(text) - at > size:
        border = SAFE.search(text, at + size)
        if border is None:
            break
        yield text[at : border.start()]
        at = border.start()
    yield text[at:] if at else text


class Library:
    """One tokenizer file, loaded: lengths of a batch of texts."""

    def __init__(self, name: str, content: bytes):
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            self.cuts = False
        elif name.endswith(".json"):
            # Spark gives a task one core; the library's own threads would take those of other tasks.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            import tokenizers

            model = tokenizers.Tokenizer.from_str(content.decode())
            model.no_truncation()
            model.no_padding()
            self.lengths = lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            self.cuts = may_cut(json.loads(content))
        else:
            raise ValueError(f"no library for {name}")
        self.kept: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def sums(self, texts: list[str]) -> list[int]:
        """Lengths of texts as sums over their words.

        Of two generations of kept words the older is forgotten when the younger is full.
        """
        cut = list(map(WORD.findall, texts))
        kept = self.kept
        new = set(chain.from_iterable(cut)).difference(kept)
        kept.update((word, self.older[word]) for word in new.intersection(self.older))
        unknown = list(new.difference(kept))
        kept.update(zip(unknown, self.lengths(unknown)))
        total = [sum(map(kept.__getitem__, words)) for words in cut]
        for word in unknown:
            if len(word) > KEPT_LENGTH:
                del kept[word]
        if len(kept) >= KEPT_WORDS:
            self.kept, self.older = {}, kept
        return total

    def counts(self, texts: pa.Array, batch: int = BATCH, piece: int = PIECE) -> list[int]:
        """Tokens of each text of an array."""
        total = [0] * len(texts)
        waiting: list[str] = []
        rows: list[int] = []
        size = 0

        def encode() -> None:
            for row, n in zip(rows, self.sums(waiting) if self.cuts else self.lengths(waiting)):
                total[row] += n
            waiting.clear()
            rows.clear()

        for row, value in enumerate(texts):
            text = value.as_py()
            if not text:
                continue
            for part in pieces(text, piece) if self.cuts else (text,):
                waiting.append(part)
                rows.append(row)
                size += len(part)
                if size >= batch:
                    encode()
                    size = 0
        if waiting:
            encode()
        return total


class TokenCounter:
    """Counts of tokens as a column, for one tokenizer file.

    The file is read on the driver and sent as a Spark broadcast, whose size is that
    of the vocabulary. Each task loads it once and lets it go at its end.
    """

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            self.shared = spark.sparkContext.broadcast((os.path.basename(path), file.read()))

    def count(self, text: Column) -> Column:
        """long: the number of tokens of a text."""
        shared = self.shared

        @F.arrow_udf("long")
        def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            library = Library(*shared.value)
            for texts in batches:
                yield pa.array(library.counts(texts), pa.int64())

        # Named nondeterministic so that Spark computes it once where its result is used twice.
        return tokens.asNondeterministic()(text)


def token_counts(docs: DataFrame, counter: TokenCounter, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, ``n_bytes``, ``n_tokens`` and whether they exceed ``limit``."""
    counted = docs.select(
        docs[key].alias("key"),
        F.octet_length(F.coalesce(docs[text], F.lit(""))).cast("long").alias("n_bytes"),
        counter.count(docs[text]).alias("n_tokens"),
    )
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
