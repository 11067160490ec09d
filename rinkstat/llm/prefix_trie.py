"""Prefix trie of conversations by burst tries.

A conversation is a string of turn ids.  All of them start in one container
under the root, which bursts into shards by the first turn id.  A container
that is too large bursts: its strings give up their next turn ids, which become
trie heads, and move to the container under the last of them.  The number of
ids given up doubles from round to round, so long common beginnings take few
rounds.  A container that is small enough (or holds one string) stays: its
strings are sorted and one sweep over neighbours yields its nodes.

What a head knows of its subtree is a sum over its member conversations.  A
node belongs to its smallest member, and a conversation owns the nodes of its
string from some depth on, so it is enough to know from which depth: children,
leaves and saved tokens of a head then add up with partial sums, and neither a
common first turn nor a group of copies gathers in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Turns (and strings) that a container holds at most, unless it is one string.
CONTAINER = 1000
#: Conversation ids whose decimal texts are joined at once.
ID_BLOCK = 1024
EMPTY = hashlib.sha256(b"").hexdigest()
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string"
)
SWEPT = NODES + ", kind byte"
NODE, OWNER = 0, 1


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that name a turn; NULL counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def conversations(rows: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: each conversation's ``(id, bytes)`` by turn, NULL first, equal turns by id."""
    turn = F.struct(
        "turn", turn_id(F.col("role"), F.col("text")).alias("id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
    )
    return (
        rows.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).alias("turns"))
    )


def grafted(convs: DataFrame, step: int = 5, most: int = 9) -> DataFrame:
    """Every conversation's first ``h`` turns replaced by those of its family's first, ``h`` from a CRC-32 of its id."""
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(step))
    heads = stored(
        convs.filter(F.pmod("conv_id", F.lit(step)) == 0).select(
            F.col("conv_id").alias("_first"), F.slice("turns", 1, most - 1).alias("_head")
        ),
        "family-heads",
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    none = F.array().cast(convs.schema["turns"].dataType)
    return convs.join(heads, first == F.col("_first"), "left").select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("_head", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))
        ).alias("turns"),
    )


def burst(strings: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """``strings (conv_id, turns)`` dealt to containers, and the part of them to be swept.

    ``path`` holds the names of the trie heads of a string, from the root on; the
    last one is its container.  Strings that end in a head whose container is
    too large are in no container that is swept.
    """
    names = lambda stride: F.aggregate(
        F.slice("turns", F.size("path"), F.lit(stride)), F.col("path"),
        lambda path, t: F.array_append(path, F.unhex(F.md5(F.concat(F.element_at(path, -1), t["id"])))),
    )
    root = F.array(F.unhex(F.md5(F.lit(b""))))
    state = stored(strings.withColumn("path", root).withColumn("path", names(1)), "burst-strings")
    kept, swept, stride = [], [], 1
    while True:
        left = F.size("turns") - F.size("path") + 1
        held = state.withColumn("_container", F.element_at("path", -1)).withColumn("_left", left)
        full = stored(
            held.groupBy(F.col("_container").alias("_full"))
            .agg(F.sum(F.col("_left") + 1).alias("_weight"), F.count(F.lit(1)).alias("_n"))
            .filter((F.col("_weight") > limit) & (F.col("_n") > 1)).select("_full"),
            "burst-containers",
        )
        on = F.col("_container") == F.col("_full")
        small = held.join(full, on, "left_anti").drop("_container", "_left")
        over = held.join(full, on, "left_semi")
        kept.append(small)
        swept.append(small)
        if full.isEmpty():
            break
        kept.append(over.filter("_left = 0").drop("_container", "_left"))
        state = stored(over.filter("_left > 0").drop("_container", "_left").withColumn("path", names(stride)), "burst-strings")
        stride *= 2
    everything, containers = kept[0], swept[0]
    for more in kept[1:]:
        everything = everything.unionByName(more)
    for more in swept[1:]:
        containers = containers.unionByName(more)
    return everything, containers


class _Node:
    __slots__ = ("depth", "bytes", "before", "up", "least", "n", "ends", "children", "leaves", "saved")

    def __init__(self, depth: int, size: int, before: int, up: _Node | None):
        self.depth, self.bytes, self.before, self.up = depth, size, before, up
        self.least, self.n, self.ends, self.children, self.leaves, self.saved = None, 0, [], 0, 0, 0

    def join(self, conv: int, n: int) -> None:
        self.least = conv if self.least is None else min(self.least, conv)
        self.n += n

    def close(self) -> None:
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.bytes
        if self.up is not None:
            self.up.join(self.least, self.n)
            self.up.children += 1
            self.up.leaves += self.leaves
            self.up.saved += self.saved


def sweep(strings: list[tuple[int, int, int, list[bytes], list[int]]]) -> tuple[list[_Node], dict[int, tuple[int, int]], set[int]]:
    """The nodes below a container from its sorted strings ``(conv_id, depth, before, ids, bytes)``.

    Also from which ``(depth, bytes before it)`` each conversation owns nodes
    here, and which ones own a leaf.
    """
    top = _Node(strings[0][1], 0, strings[0][2], None)
    stack, done, previous = [top], [], []
    for conv, _, _, ids, sizes in strings:
        same = 0
        for a, b in zip(previous, ids, strict=False):
            if a != b:
                break
            same += 1
        while len(stack) - 1 > same:
            node = stack.pop()
            node.close()
            done.append(node)
        for i in range(same, len(ids)):
            up = stack[-1]
            stack.append(_Node(up.depth + 1, sizes[i], up.before + up.bytes, up))
        stack[-1].ends.append(conv)
        stack[-1].join(conv, 1)
        previous = ids
    while len(stack) > 1:
        node = stack.pop()
        node.close()
        done.append(node)
    owned, leaf = {}, set()
    for node in done:
        if node.up is top or node.up.least != node.least:
            owned[node.least] = (node.depth, node.before)
        if not node.children:
            leaf.add(node.least)
    return done, owned, leaf


def _ends(convs: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(convs))).encode()).hexdigest() if convs else EMPTY


def swept_rows(containers: DataFrame) -> DataFrame:
    """A ``NODE`` row per node below the containers, and an ``OWNER`` row per conversation.

    The latter says from which ``depth`` the conversation owns nodes
    (``saved_tokens``: bytes before it) and in ``n_leaves`` whether it owns a leaf.
    """
    schema = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string(), "byte": pa.int8()}[f.split()[1]]) for f in SWEPT.split(",")])

    def rows_of(strings: list[tuple]) -> Iterator[tuple]:
        nodes, owned, leaf = sweep(strings)
        for n in nodes:
            yield n.least, n.depth, n.up.least, n.n, n.children, n.leaves, n.saved, _ends(n.ends), NODE
        for conv, depth, before, ids, sizes in strings:
            at, shared = owned.get(conv, (depth + len(ids) + 1, before + sum(sizes)))
            yield conv, at, None, None, None, int(conv in leaf), shared, None, OWNER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def strings() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("container", "conv_id", "depth", "before", "ids", "bytes")), strict=True)

        out = []
        for _, group in groupby(strings(), itemgetter(0)):
            out += rows_of([s[1:] for s in group])
            if len(out) > 20_000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

    depth = F.size("path") - 1
    rest = F.slice("turns", depth + 1, F.size("turns"))
    rows = containers.select(
        F.element_at("path", -1).alias("container"), "conv_id", depth.alias("depth"),
        _sum(F.slice("turns", F.lit(1), depth)).alias("before"),
        F.transform(rest, lambda t: t["id"]).alias("ids"), F.transform(rest, lambda t: t["bytes"]).alias("bytes"),
    )
    return rows.repartition("container").sortWithinPartitions("container", "ids", "conv_id").mapInArrow(run, SWEPT)


def _sum(turns: Column) -> Column:
    return F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + t["bytes"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` from ``(node, conv_id)``: ids are joined a block at a time and streamed through the digest."""
    blocks = ends.groupBy("node", F.shiftright("conv_id", ID_BLOCK.bit_length() - 1).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True)

        for node, group in groupby(rows(), itemgetter(0)):
            sha = hashlib.sha256(next(group)[1].encode())
            for _, ids in group:
                sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], names=["node", "ends_sha256"])

    return blocks.repartition("node").sortWithinPartitions("node", "block").mapInArrow(run, "node binary, ends_sha256 string")


def trie_nodes(strings: DataFrame, limit: int = CONTAINER) -> DataFrame:
    """One row per distinct beginning of ``strings (conv_id, turns array<struct<id binary, bytes long>>)``.

    ``conv_id`` must be unique and not NULL.  A node is named by its smallest
    member and its ``depth``; the root has depth 0 and no parent.  Conversations
    without turns are members of the root.  Equal strings are members of the
    same nodes.  An empty table has no root and gives no row.  Extra columns
    aren't read, so names can't clash.  A conversation's turn ids (24 bytes a
    turn), never its texts, are held as one value.
    """
    everything, containers = burst(strings.select("conv_id", "turns"), limit)
    everything = stored(everything, "burst-done")
    swept = stored(swept_rows(containers), "swept-nodes")
    heads = stored(
        everything.select(
            "conv_id", F.size("turns").alias("len"), "path",
            F.aggregate(
                F.slice("turns", F.lit(1), F.size("path") - 1), F.array(F.lit(0).cast("long"), F.lit(0).cast("long")),
                lambda sums, t: F.array_append(sums, F.element_at(sums, -1) + t["bytes"]),
            ).alias("sums"),
        ).select("conv_id", "len", "path", "sums", F.posexplode("path").alias("depth", "node"))
        .select(
            "node", "depth", F.expr("CASE WHEN depth > 0 THEN path[depth - 1] END").alias("up"), "conv_id", "len",
            F.expr("sums[depth]").alias("before"),
        ),
        "trie-heads",
    )
    named = stored(
        heads.groupBy("node").agg(
            F.min("conv_id").alias("owner"), F.first("depth").alias("depth"), F.first("before").alias("before"),
            (F.max("len") == F.first("depth")).alias("leaf"),
        ),
        "head-owners",
    )
    owned = named.groupBy(F.col("owner").alias("_owner")).agg(
        F.min("depth").alias("_from"), F.min("before").alias("_shared"), F.max(F.col("leaf").cast("long")).alias("_leaf")
    )
    below = swept.filter(f"kind = {OWNER}").select(
        F.col("conv_id").alias("_conv"), F.col("depth").alias("_at"), F.col("saved_tokens").alias("_before"), F.col("n_leaves").alias("_own_leaf")
    )
    known = everything.select("conv_id", F.size("turns").alias("_len"), _sum(F.col("turns")).alias("_all"))
    known = known.join(owned, F.col("conv_id") == F.col("_owner"), "left").join(below, F.col("conv_id") == F.col("_conv"), "left")
    known = stored(
        known.select(
            F.col("conv_id").alias("_conv"), F.coalesce("_from", "_at", F.col("_len") + 1).alias("_from"),
            F.coalesce("_shared", "_before", "_all").alias("_shared"),
            F.greatest(F.coalesce("_leaf", F.lit(0)), F.coalesce("_own_leaf", F.lit(0))).alias("_leaf"),
        ),
        "owned-depths",
    )
    parents = named.select(F.col("node").alias("_up"), F.col("owner").alias("parent_conv_id"))
    sums = (
        heads.join(known, F.col("conv_id") == F.col("_conv")).groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").cast("long").alias("depth"), F.first("up").alias("up"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count(F.when((F.col("len") > F.col("depth")) & (F.col("_from") <= F.col("depth") + 1), 1)).alias("n_children"),
            F.sum("_leaf").alias("n_leaves"),
            F.sum(F.greatest(F.col("_shared") - F.col("before"), F.lit(0))).alias("saved_tokens"),
        )
    )
    ends = ends_digests(heads.filter("len = depth").select("node", "conv_id")).withColumnRenamed("node", "_node")
    top = (
        sums.join(parents, F.col("up") == F.col("_up"), "left").join(ends, F.col("node") == F.col("_node"), "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    )
    columns = [f.split()[0] for f in NODES.split(",")]
    return top.select(*columns).unionByName(swept.filter(f"kind = {NODE}").select(*columns))
