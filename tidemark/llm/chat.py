"""Chat formatting as a prefix tree of turns.

Conversations that begin with the same turns share them: a node of the tree is a
turn together with all turns before it, and is formatted and tokenised once. The
nodes of a tree are laid out depth-first in one packed sequence. Each node has

- its place in the packed sequence (``packed_start``, in tokens),
- the position id of its first token, which counts along its own path
  (``position_start``), so that it is what it would be in the conversation alone,
- ``attends``: the intervals of the packed sequence its tokens may attend to, its
  ancestors' (neighbouring intervals joined), besides itself causally,
- the interval of its own tokens under the loss (the text of assistant turns).

A packed sequence is kept as rows of nodes in order, never as one value, so a
tree may hold any share of all conversations. A conversation is read back from
these rows alone: what its last turn attends to, in order of position ids.

No step holds a whole conversation, and the work is linear in turns. A node is
named by sums over its path of digests of (depth, role, text), which are carried
along a conversation as any running sum is, and across the blocks of one that is
too long for a task. What is gathered per conversation are its forks and the
intervals it sees: together no more than there are turns, and few where turns are
not shared.

The template is ``<s>[INST] role [/INST]text</s>`` for each turn. Where a role or
a text contains one of the control strings, a backslash is put behind its first
character (one more where there are some already); reading back takes it out
again, so any text survives.

Depth-first order needs no walk: conversations are sorted by the nodes of their
path that have siblings, a node is placed where the first conversation through it
is, and by depth. The nodes of one place are a piece: they follow one another.

Results: NULL texts and roles are empty ones. Turns are in the order of ``turn``,
equal ones by role and text; repeated rows are repeated turns. Rows of a NULL
conversation id are one conversation.
"""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.bpe import Tokenizer, id_lists
from tidemark.operators.blocks import BLOCK, Limits, attach, block_order, carried, in_blocks, split_by_group_size, summarise
from tidemark.operators.windows import numbered
from tidemark.sources.scratch import frozen

# The control strings of the template.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
HEAD, MIDDLE, TAIL = "<s>[INST] ", " [/INST]", "</s>"
LOSS_ROLE = "assistant"
# Intervals meet the nodes they hold by stretches of so many tokens of the packed sequence.
STRETCH = 512
# A control string whose first character may be followed by backslashes.
_FIND = re.compile("|".join(f"({re.escape(c[0])})(\\\\*)({re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(re.escape(HEAD) + "(.*?)" + re.escape(MIDDLE) + "(.*)" + re.escape(TAIL), re.DOTALL)


def escaped(text: str) -> str:
    return _FIND.sub(lambda m: "".join((g or "") + ("\\" if i % 3 == 0 and g is not None else "") for i, g in enumerate(m.groups())), text)


def unescaped(text: str) -> str:
    return _FIND.sub(lambda m: "".join((g or "")[1:] if i % 3 == 1 else (g or "") for i, g in enumerate(m.groups())), text)


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """A turn in the template: what stands before its text, its text, what stands behind."""
    return HEAD + escaped(role) + MIDDLE, escaped(text), TAIL


_TOKENS = StructType(
    [StructField("ids", ArrayType(IntegerType())), StructField("loss_start", IntegerType()), StructField("loss_end", IntegerType())]
)
_READ = StructType(
    [
        StructField("role", StringType()),
        StructField("text", StringType()),
        StructField("loss", StringType()),
        StructField("chars", LongType()),
    ]
)


def tokenised(tokenizer: Tokenizer, role: Column, text: Column) -> Column:
    """struct: ids of a formatted turn, and where the ids under the loss are. The three parts are encoded one by one."""
    load = tokenizer._loader()

    @F.arrow_udf(_TOKENS)
    def encode(roles: pa.Array, texts: pa.Array) -> pa.Array:
        encoded, packed, starts, ends = load().encode, [], [], []
        for r, t in zip(roles.to_pylist(), texts.to_pylist()):
            before, said, behind = map(encoded, formatted(r, t))
            packed.append(before + said + behind)
            starts.append(len(before) // 4)
            ends.append(starts[-1] + (len(said) // 4 if r == LOSS_ROLE else 0))
        columns = [id_lists(packed), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
        return pa.StructArray.from_arrays(columns, names=_TOKENS.names)

    return encode.asNondeterministic()(role, text)


def said(tokenizer: Tokenizer, ids: Column, loss_start: Column, loss_end: Column) -> Column:
    """struct: role, text, text under the loss (unescaped) and formatted length of a turn, from its ids alone."""
    load = tokenizer._loader()

    @F.arrow_udf(_READ)
    def decode(arrays: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        decoded, rows = load().decode, []
        flat, at = arrays.flatten().to_numpy(), list(accumulate(arrays.value_lengths().to_pylist(), initial=0))
        for i, (first, last) in enumerate(zip(starts.to_pylist(), ends.to_pylist())):
            own = flat[at[i] : at[i + 1]].tolist()
            whole, loss = decoded(own).decode(), decoded(own[first:last]).decode()
            role, text = _TURN.fullmatch(whole).groups()
            rows.append((unescaped(role), unescaped(text), unescaped(loss), len(whole)))
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_READ.names)

    return decode.asNondeterministic()(ids, loss_start, loss_end)


def sums_upto(df: DataFrame, keys: list[str], order: str, values: list[str], limits: Limits = Limits()) -> DataFrame:
    """Adds ``<value>_upto``: sums of whole numbers over the group up to the row, by ``order``, which is unique there."""

    def inside(part) -> dict[str, Column]:
        w = part.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {f"{v}_upto": F.sum(v).over(w) for v in values}

    split = split_by_group_size(df, keys, limits)
    plain = split.ordinary.withColumns(inside(Window.partitionBy(*keys)))
    if split.oversized is None:
        return plain
    rows = in_blocks(split, [F.asc(order)], inside)
    earlier = block_order(split).rowsBetween(Window.unboundedPreceding, -1)
    carry = summarise(split, rows, {v: F.sum(v) for v in values}).select(
        *keys, BLOCK, *(F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(v) for v in values)
    )
    whole = [(F.col(f"{v}_upto") + carried(v)).alias(f"{v}_upto") for v in values]
    return plain.unionByName(attach(split, rows, carry).select(*df.columns, *whole))


def steps(turns: DataFrame, key: str, turn: str, role: str, text: str, limits: Limits = Limits()) -> DataFrame:
    """(conv, depth, tree, parent, node, role, text): each turn with the digests of the conversation up to it.

    A digest is that of the depth and of four sums of 32-bit parts of the digests of
    all turns so far, each taken with its depth. The first turn's digest is the tree.
    """
    rows = turns.select(
        turns[key].alias("conv"),
        turns[turn].alias("at"),
        F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns[text].cast("string"), F.lit("")).alias("text"),
    )
    rows = numbered(rows, ["conv"], ["at", "role", "text"], limits, name="row")
    own = F.md5(F.concat_ws(" ", F.col("row").cast("string"), F.md5("role"), F.md5("text")).cast("binary"))
    rows = rows.select("conv", (F.col("row") - 1).cast("int").alias("depth"), "role", "text", own.alias("own"))
    part = [F.conv(F.substring("own", 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    names, roots = [f"part{i}" for i in range(4)], [f"root{i}" for i in range(4)]
    rows = rows.withColumns(dict(zip(names, part)))
    rows = rows.withColumns({r: F.when(F.col("depth") == 0, F.col(n)).otherwise(0) for r, n in zip(roots, names)})
    rows = sums_upto(rows.drop("own"), ["conv"], "depth", names + roots, limits)

    def named(depth: Column, sums: list[Column]) -> Column:
        return F.md5(F.concat_ws(" ", depth.cast("string"), *(x.cast("string") for x in sums)).cast("binary"))

    upto = [F.col(f"{n}_upto") for n in names]
    above = named(F.col("depth") - 1, [u - F.col(n) for u, n in zip(upto, names)])
    return rows.select(
        "conv",
        "depth",
        named(F.lit(0), [F.col(f"{r}_upto") for r in roots]).alias("tree"),
        F.when(F.col("depth") > 0, above).alias("parent"),
        named(F.col("depth"), upto).alias("node"),
        "role",
        "text",
    )


class PrefixTree:
    """``conversations``: (conv, tree, place, n_turns, leaf). ``nodes``: one row per node, see the module."""

    def __init__(
        self,
        turns: DataFrame,
        tokenizer: Tokenizer,
        key: str = "conv_id",
        turn: str = "turn",
        role: str = "role",
        text: str = "text",
        limits: Limits = Limits(),
    ):
        self.tokenizer, self.limits = tokenizer, limits
        found = frozen(steps(turns, key, turn, role, text, limits), "chat-steps")
        self.steps = found.select("conv", "depth", "tree", "parent", "node")
        nodes = found.groupBy("node").agg(*(F.first(c).alias(c) for c in ("tree", "parent", "depth", "role", "text")))
        tokens = nodes.select("node", "tree", "parent", "depth", tokenised(tokenizer, F.col("role"), F.col("text")).alias("t"))
        self.tokens = frozen(tokens.select("node", "tree", "parent", "depth", "t.*"), "chat-tokens").withColumn(
            "n_tokens", F.size("ids").cast("long")
        )
        self.conversations = frozen(self._ordered(), "chat-order")

    def _ordered(self) -> DataFrame:
        """The conversations with their places in the depth-first order of their trees."""
        kin = self.tokens.select("parent").groupBy("parent").count().filter((F.col("count") > 1) & F.col("parent").isNotNull())
        forks = self.steps.join(kin.select("parent"), "parent", "left_semi").select("conv", "depth", "node")
        along = forks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("forks"))
        along = along.select(F.col("conv").alias("c"), F.concat_ws("", "forks.node").alias("along"))
        whole = self.steps.groupBy("conv").agg(
            F.first("tree").alias("tree"), (F.max("depth") + 1).cast("long").alias("n_turns"), F.max_by("node", "depth").alias("leaf")
        )
        whole = whole.join(along, whole["conv"].eqNullSafe(F.col("c")), "left").drop("c")
        whole = whole.withColumn("along", F.coalesce("along", F.lit("")))
        # A conversation that ends where another one goes on stands before it.
        return numbered(whole, ["tree"], ["along", "n_turns", "conv"], self.limits, name="place").drop("along")

    def nodes(self) -> DataFrame:
        """One row per node: tree, node, parent, depth, packed_start, position_start, n_tokens, ids, loss, attends."""
        places = self.conversations.select(F.col("conv").alias("c"), "place")
        through = self.steps.join(places, F.col("conv").eqNullSafe(F.col("c"))).groupBy("node").agg(F.min("place").alias("place"))
        own = self.tokens.select("node", "tree", "depth", "n_tokens").join(through, "node")
        own = frozen(sums_upto(own, ["tree", "place"], "depth", ["n_tokens"], self.limits), "chat-placed")
        # Lengths of pieces, then where they start: a tree may be large.
        added = own.groupBy("tree", "place").agg(F.sum("n_tokens").alias("added"))
        before = sums_upto(added, ["tree"], "place", ["added"], self.limits)
        before = before.select("tree", "place", (F.col("added_upto") - F.col("added")).alias("piece_start"))
        start = F.col("piece_start") + F.col("n_tokens_upto") - F.col("n_tokens")
        own = own.join(before, ["tree", "place"]).select("node", "tree", "place", "piece_start", "n_tokens", start.alias("packed_start"))
        own = frozen(own, "chat-packed")

        # A piece sees what its conversation has of other pieces: one interval of each.
        there = own.select("node", F.col("place").alias("piece"), "packed_start", (F.col("packed_start") + F.col("n_tokens")).alias("end"))
        seen = self.steps.select("conv", "tree", "node").join(there, "node").groupBy("conv", "tree", "piece")
        seen = seen.agg(F.min("packed_start").alias("start"), F.max("end").alias("end"))
        homes = self.conversations.select(F.col("conv").alias("c"), "place")
        seen = seen.join(homes, F.col("conv").eqNullSafe(F.col("c"))).filter(F.col("piece") != F.col("place"))
        seen = seen.groupBy("tree", "place").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("over"))
        pieces = before.join(seen, ["tree", "place"], "left").select(
            "tree",
            "place",
            F.coalesce("over", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("over"),
        )
        in_piece = F.col("packed_start") - F.col("piece_start")
        inside = F.array(F.struct(F.col("piece_start").alias("start"), F.col("packed_start").alias("end")))
        over = F.when(in_piece > 0, F.concat("over", inside)).otherwise(F.col("over"))
        met = own.join(pieces, ["tree", "place"]).select(
            "node",
            "packed_start",
            (F.aggregate("over", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]) + in_piece).alias("position_start"),
            joined_intervals(over).alias("attends"),
        )
        return self.tokens.join(met, "node").select(
            "tree",
            "node",
            "parent",
            "depth",
            "packed_start",
            "position_start",
            "n_tokens",
            "ids",
            "loss_start",
            "loss_end",
            "attends",
        )

    def turns(self, nodes: DataFrame) -> DataFrame:
        """(conv, position_start, role, text, loss, chars, n_tokens): what the last turn of each conversation attends to, and itself.

        The nodes are found by their places in the packed sequence; each is decoded once.
        """
        leaves = nodes.select(F.col("node").alias("leaf"), "tree", "packed_start", "n_tokens", "attends")
        own = F.struct(F.col("packed_start").alias("start"), (F.col("packed_start") + F.col("n_tokens")).alias("end"))
        sees = self.conversations.select("conv", "leaf").join(leaves, "leaf")
        sees = sees.select("conv", "tree", F.explode(F.concat("attends", F.array(own))).alias("i"))
        stretches = F.sequence(F.floor(F.col("i.start") / STRETCH), F.floor((F.col("i.end") - 1) / STRETCH))
        sees = sees.select("conv", "tree", "i.start", "i.end", F.explode(stretches).alias("stretch"))
        read = nodes.select(
            "tree",
            F.floor(F.col("packed_start") / STRETCH).alias("stretch"),
            "packed_start",
            "position_start",
            "n_tokens",
            said(self.tokenizer, F.col("ids"), F.col("loss_start"), F.col("loss_end")).alias("r"),
        )
        held = (F.col("packed_start") >= F.col("start")) & (F.col("packed_start") < F.col("end"))
        met = sees.join(read, ["tree", "stretch"]).filter(held)
        return met.select("conv", "position_start", "r.role", "r.text", "r.loss", "r.chars", "n_tokens")

    def read_back(self, nodes: DataFrame) -> DataFrame:
        """(conv, turns): the turns of each conversation in order of their position ids, in one row."""
        turn = F.struct("position_start", "role", "text", "loss", "chars", "n_tokens")
        return self.turns(nodes).groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def digests(self, nodes: DataFrame) -> DataFrame:
        """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), digested turn after turn.

        A digest runs along a whole conversation in one task, which holds one batch of
        turns of it. Position ids that leave a gap or overlap are an error.
        """
        dealt = self.turns(nodes).repartition("conv").sortWithinPartitions("conv", "position_start")
        fields = [dealt.schema["conv"], *_DIGESTS]
        return dealt.mapInArrow(_digested, StructType(fields))


_DIGESTS = [
    StructField("n_turns", LongType()),
    StructField("turns_sha256", StringType()),
    StructField("loss_chars", LongType()),
    StructField("loss_sha256", StringType()),
    StructField("formatted_chars", LongType()),
]


def _digested(batches):
    """Digests of conversations whose turns come in order, one conversation after the other."""
    names = ["conv", *(field.name for field in _DIGESTS)]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    conv = conv_kind = all_turns = loss_turns = None
    n = position = loss_chars = chars = 0
    done = []

    def finished():
        return conv, n, all_turns.hexdigest(), loss_chars, loss_turns.hexdigest(), chars

    def batch_of(rows):
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate([conv_kind, *kinds])]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        conv_kind = batch.schema.field(0).type
        for c, at, role, text, loss, size, n_tokens in zip(*(column.to_pylist() for column in batch.columns)):
            if all_turns is None or c != conv:
                if all_turns is not None:
                    done.append(finished())
                conv, all_turns, loss_turns = c, hashlib.sha256(), hashlib.sha256()
                n = position = loss_chars = chars = 0
            if at != position:
                raise ValueError(f"conversation {c}: position {at} where {position} should follow")
            all_turns.update(f"{role}\n{text}\n".encode())
            loss_turns.update(loss.encode())
            n, position, loss_chars, chars = n + 1, position + n_tokens, loss_chars + len(loss), chars + size
        if done:
            yield batch_of(done)
            done = []
    if all_turns is not None:
        yield batch_of([finished()])


def joined_intervals(intervals: Column) -> Column:
    """Intervals in order, those that touch as one."""
    at = lambda i, field: F.try_element_at(intervals, i.cast("int"))[field]
    # Element numbers of try_element_at count from 1, those of filter from 0.
    first = F.filter(intervals, lambda x, i: (i == 0) | (at(F.greatest(i, F.lit(1)), "end") != x["start"]))
    last = F.filter(intervals, lambda x, i: (i == F.size(intervals) - 1) | (at(i + 2, "start") != x["end"]))
    return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))
