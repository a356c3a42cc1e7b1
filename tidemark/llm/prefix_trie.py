"""The trie of conversation prefixes, from sorted sequences and range minima over their LCPs.

A turn is a 128-bit digest of its role and text, a conversation the array of its
turns.  Conversations are sorted over the whole table (range partitions on
(turns, id), so that even one sequence that many conversations share is spread)
and every partition, a *block*, works alone:

- the LCP of each conversation with the one before it; a prefix longer than that
  LCP is met there for the first time and is a candidate (k, depth);
- each candidate searches its right extent, and for its parent the left extent,
  by binary descent in a sparse table of LCP minima, independently of all others:
  no stack.  The extent gives the members; a second sparse table the smallest id;
- candidates in (place, depth) order are in pre-order, so sums over a subtree are
  differences of running sums.

Only prefixes of a block's first or last conversation can go on in another block.
These fragments (blocks x depth of them) are joined afterwards: at each depth, a
fragment continues the one before it where the LCP between the blocks reaches
its depth.  Sums that are still open are completed from the fragments alone.

The digest of a node's ends takes the ids of its members of exactly that depth in
order; ids of a node that spans blocks are streamed through the hash, block after
block, as SHA-256 allows no other way.

Cases: turns stand by number (null first), turns of equal number by digest; null role
and text count as empty; repeated rows are turns of their own; rows without a
conversation id belong to none and take no part; an empty table has no nodes; a
conversation's turns (40 bytes each) make one row, its texts never do; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .mixing import word_tokens
from .range_minima import Minima
from .tables import keep, partitions

BLOCK_TURNS = 500_000  # turns in a block, on average, at most
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = -1

TURNS = "array<struct<symbol:binary,tokens:bigint>>"
FRAGMENT = ("block int, node long, depth int, place long, first boolean, last boolean, conv long, parent long, "
            "parent_conv long, n_convs long, n_children long, n_leaves long, saved long, tokens long, ends string, "
            "open_ends string, first_turns array<binary>, last_turns array<binary>")


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv, turns): each conversation's turns in order, as digests with their word counts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)  # role and text cannot run together
    symbol = F.unhex(F.substring(F.sha2(name.cast("binary"), 256), 1, 32))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), symbol.alias("symbol"), word_tokens(text).alias("tokens")).alias("t"))
    return (rows.groupBy("conv").agg(F.array_sort(F.collect_list("t"), _turn_order).alias("t"))
            .select("conv", F.transform("t", lambda t: F.struct(t["symbol"], t["tokens"])).cast(TURNS).alias("turns")))


def _turn_order(a: Column, b: Column) -> Column:
    def sign(x: Column, y: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1)

    number = (F.when(a["turn"].isNull() & b["turn"].isNull(), F.lit(None).cast("int")).when(a["turn"].isNull(), -1)
              .when(b["turn"].isNull(), 1).otherwise(sign(a["turn"], b["turn"])))
    return F.coalesce(number, sign(a["symbol"], b["symbol"]), F.lit(0))


class Block:
    """The nodes of a block of sorted conversations, in pre-order."""

    def __init__(self, conv: np.ndarray, turns: pa.ListArray):
        flat = turns.flatten()
        symbols = flat.field("symbol").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        tokens = flat.field("tokens").to_numpy(zero_copy_only=False)
        self.conv, self.n = conv, len(conv)
        self.size = np.diff(turns.offsets.to_numpy()).astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        lcp = self._lcp(symbols, begin)
        # Candidates: every prefix met for the first time, by place and depth.
        known = np.maximum(lcp[:-1], 0)
        fresh = self.size - known
        self.base = np.concatenate(([0], np.cumsum(fresh)))
        self.place = np.repeat(np.arange(self.n), fresh)
        self.depth = np.arange(len(self.place)) - self.base[self.place] + known[self.place] + 1
        minima = Minima(lcp)
        self.right = minima.after(self.place + 1, self.depth) - 1
        self.least = Minima(conv).least(self.place, self.right) if self.n else conv
        self.tokens = tokens[begin[self.place] + self.depth - 1]
        above = self.depth > 1
        self.parent = np.full(len(self.place), ROOT)
        left = minima.before(self.place[above], self.depth[above] - 1)
        self.parent[above] = self.base[left] + self.depth[above] - 2 - known[left]
        self.last = self.right == self.n - 1
        self.open = self.last | (self.place == 0)
        self.members = self.right - self.place + 1
        closed = ~self.open
        self.children = np.bincount(self.parent[closed] + 1, minlength=len(self.place) + 1)  # entry 0: the root's
        self.leaves = self._below(closed & (self.children[1:] == 0))
        self.saved = self._below(np.where(closed, (self.members - 1) * self.tokens, 0))
        # Equal conversations stand together: where each such stretch starts, its end.
        opens = np.ones(self.n + 1, bool)
        opens[1:-1] = ~((lcp[1:-1] == self.size[1:]) & (lcp[1:-1] == self.size[:-1]))
        self.stretch = np.flatnonzero(opens)

    def _lcp(self, symbols: np.ndarray, begin: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n + 1, np.int64)
        out[[0, -1]] = -1
        at, depth = np.arange(1, self.n), 0
        while len(at):
            at = at[np.minimum(self.size[at - 1], self.size[at]) > depth]
            at = at[symbols[begin[at - 1] + depth] == symbols[begin[at] + depth]]
            depth += 1
            out[at] = depth
        return out

    def _below(self, own: np.ndarray) -> tuple[np.ndarray, int]:
        """Sums over the subtree of each node, and over all nodes."""
        upto = np.concatenate(([0], np.cumsum(own, dtype=np.int64)))
        return upto[self.base[self.right + 1]] - upto[:-1], int(upto[-1])

    def ends(self) -> list[str | None]:
        """The ids, joined, of the conversations that end in each node; None: none do."""
        out: list[str | None] = [None] * len(self.place)
        for a, b in zip(self.stretch[:-1].tolist(), self.stretch[1:].tolist(), strict=True):
            if self.base[a + 1] > self.base[a]:  # its whole sequence is met here first
                out[int(self.base[a + 1]) - 1] = ",".join(map(str, self.conv[a:b].tolist()))
        return out

    def fragments(self, block: int, turns: pa.ListArray) -> pa.RecordBatch:
        """All nodes of the block, the root first; ``open`` ones may go on in other blocks."""
        ends = self.ends()
        opened = self.open.tolist()
        outer = self.parent >= 0
        of_parent = np.where(outer, self.parent, 0)
        closed_parent = outer & ~self.open[of_parent]
        root_ends = int(np.searchsorted(self.size, 1))  # turnless conversations come first

        def column(top, rest, kind=pa.int64()):
            return pa.array(np.concatenate(([top], rest)), kind)

        rows = len(self.place) + 1
        digests = [None, *(None if o else NO_ENDS if e is None else hashlib.sha256(e.encode()).hexdigest()
                           for o, e in zip(opened, ends, strict=True))]
        chunks = [",".join(map(str, self.conv[:root_ends].tolist())) if root_ends else None,
                  *(e if o else None for o, e in zip(opened, ends, strict=True))]

        def edge(k):
            return pa.array([[t["symbol"] for t in turns[k].as_py()]] + [None] * (rows - 1), pa.list_(pa.binary()))

        parent_conv = np.where(closed_parent, self.least[of_parent] if len(of_parent) else 0, 0)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(rows, block), pa.int32()),
            column(ROOT, np.arange(len(self.place))),
            column(0, self.depth, pa.int32()),
            column(0, self.place),
            column(True, self.place == 0, pa.bool_()),
            column(True, self.last, pa.bool_()),
            column(self.conv.min(), self.least),
            column(ROOT, self.parent),
            pa.array(np.concatenate(([0], parent_conv)), pa.int64(), mask=np.concatenate(([True], ~closed_parent))),
            column(self.n, self.members),
            pa.array(self.children),
            column(self.leaves[1], self.leaves[0]),
            column(self.saved[1], self.saved[0]),
            column(0, self.tokens),
            pa.array(digests, pa.string()),
            pa.array(chunks, pa.string()),
            edge(0),
            edge(self.n - 1),
        ], names=[c.split()[0] for c in FRAGMENT.split(", ")])


def _block_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [b for b in batches if b.num_rows]
    if parts:
        whole = pa.Table.from_batches(parts).combine_chunks()
        turns = whole.column("turns").chunk(0) if whole.column("turns").num_chunks else None
        conv = whole.column("conv").to_numpy()
        yield Block(conv, turns).fragments(TaskContext.get().partitionId(), turns)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, island, ends) from (depth, island, open_ends) in order; one chunk of ids is held at a time."""
    now, state = None, None
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.int64()),
                                           pa.array([d[2] for d in done], pa.string())], names=["depth", "island", "ends"])

    for batch in batches:
        for depth, island, chunk in zip(batch.column("depth").to_pylist(), batch.column("island").to_pylist(),
                                        batch.column("open_ends"), strict=True):
            if (depth, island) == now:
                state.update(b",")
            else:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (depth, island), hashlib.sha256()
            state.update(chunk.as_buffer())
        if done:
            yield out()
            done.clear()
    if now is not None:
        done.append((*now, state.hexdigest()))
        yield out()


def _join_blocks(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes that may span blocks, whole; and (block, node, conv): the smallest member of each open fragment's node."""
    edges = nodes.where(F.col("node") == ROOT).select("block", "first_turns", "last_turns")
    # One row per block: their number follows from the block size, not from what is in them.
    before = F.lag("last_turns").over(Window.orderBy("block"))
    same = F.array_position(F.zip_with(before, F.col("first_turns"), lambda x, y: x.eqNullSafe(y)), False)
    shared = edges.select("block", F.when(same > 0, same - 1).otherwise(F.size("first_turns")).alias("shared"),
                          before.isNull().alias("foremost"))
    shared = shared.select("block", F.when(~F.col("foremost"), F.col("shared")).otherwise(-1).alias("shared"))
    frags = nodes.where(F.col("first") | F.col("last")).drop("first_turns", "last_turns", "parent_conv", "ends").join(shared, "block")
    frags = frags.withColumn("opens", ~(F.col("first") & (F.col("depth") <= F.col("shared"))))
    frags = keep(frags.withColumn("island", F.sum(F.col("opens").cast("long")).over(
        Window.partitionBy("depth").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, 0))), "fragments")

    whole = frags.groupBy("depth", "island").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"), F.max("tokens").alias("tokens"),
        F.sum("n_children").alias("closed_children"))
    named = keep(frags.select("block", "node", "depth", "island").join(
        whole.select("depth", "island", "conv"), ["depth", "island"]), "named")
    parents = (frags.where("opens and depth > 0").select("depth", "island", "block", F.col("parent").alias("node"))
               .join(named.select("block", "node", F.col("island").alias("parent_island"),
                                  F.col("conv").alias("parent_conv")), ["block", "node"])
               .select("depth", "island", "parent_island", "parent_conv"))
    children = (parents.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_island").alias("island"))
                .agg(F.count(F.lit(1)).alias("open_children")))
    whole = keep(whole.join(parents, ["depth", "island"], "left").join(children, ["depth", "island"], "left")
                 .withColumn("n_children", F.col("closed_children") + F.coalesce("open_children", F.lit(0))), "whole")

    # A node's own part counts where it starts; below a fragment stand the open nodes that start in it.
    own = frags.join(whole.select("depth", "island", F.col("n_children").alias("all_children"), F.col("n_convs").alias("all_convs")),
                     ["depth", "island"])
    own = (own.withColumn("own_leaf", F.when(F.col("opens") & (F.col("all_children") == 0), 1).otherwise(0).cast("long"))
           .withColumn("own_saved", F.when(F.col("opens"), (F.col("all_convs") - 1) * F.col("tokens")).otherwise(0).cast("long")))
    onward = Window.partitionBy("block").orderBy(F.desc("place"), F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    here = Window.partitionBy("block", "place").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)

    def below(name: str) -> Column:
        return F.when(F.col("last"), F.sum(name).over(onward)).otherwise(F.sum(name).over(here))

    sums = (own.select("depth", "island", (F.col("n_leaves") + below("own_leaf")).alias("n_leaves"),
                       (F.col("saved") + below("own_saved")).alias("saved"))
            .groupBy("depth", "island").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    ends = (frags.where(F.col("open_ends").isNotNull()).select("depth", "island", "block", "open_ends")
            .repartition(partitions(nodes.sparkSession), "depth", "island").sortWithinPartitions("depth", "island", "block")
            .select("depth", "island", "open_ends").mapInArrow(_hash_ends, "depth int, island long, ends string"))
    out = (whole.join(sums, ["depth", "island"]).join(ends, ["depth", "island"], "left")
           .withColumn("ends", F.coalesce("ends", F.lit(NO_ENDS))))
    return out, named.select("block", "node", "conv")


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of the trie of ``conversations`` (``conv``, ``turns`` as :func:`sequences` gives them; ids distinct).

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.
    """
    spark = conversations.sparkSession
    conversations = keep(conversations.select("conv", "turns"), "sequences")
    total = conversations.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    blocks = max(partitions(spark), -(-total // block_turns))
    order = [F.transform("turns", lambda t: t["symbol"]), F.col("conv")]
    nodes = keep(conversations.repartitionByRange(blocks, *order).sortWithinPartitions(*order)
                 .mapInArrow(_block_nodes, FRAGMENT), "nodes")
    spanning, named = _join_blocks(nodes)
    closed = nodes.where(~(F.col("first") | F.col("last"))).join(
        named.select("block", F.col("node").alias("parent"), F.col("conv").alias("open_parent")), ["block", "parent"], "left")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    closed = closed.select("conv", F.col("depth").cast("long"), F.coalesce("parent_conv", "open_parent"), "n_convs",
                           "n_children", "n_leaves", "saved", "ends").toDF(*names)
    spanning = spanning.select("conv", F.col("depth").cast("long"), "parent_conv", "n_convs", "n_children", "n_leaves",
                               "saved_tokens", "ends").toDF(*names)
    return spanning.unionByName(closed)
