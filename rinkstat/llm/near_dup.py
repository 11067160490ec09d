"""Near-duplicates: MinHash signatures under a multi-index Hamming join.

A document's set of word shingles is signed with b-bit MinHash values.  The
signature is split into chunks; by the pigeonhole principle two signatures that
differ in at most ``chunks * (errors + 1) - 1`` places agree in some chunk but
for ``errors`` places.  All ways to leave out that many places of each chunk
are enumerated as keys, so two documents under that distance share a key, and
none is missed.  The number of chunks follows from the wanted similarity: a
pair at the threshold stays under the distance but for a stated probability.
Links are confirmed on full sets.

Equal sets are one class from the start, and classes that are already connected
are never compared.  First the members of strict keys (two whole chunks) meet a
few pivots each, which joins copies of copies at a cost linear in a key's size.
Then the members of a key whose components still differ are compared inside
tasks, a large key in pairs of blocks dealt to many tasks, on long one-bit
signatures; only pairs that pass, each under the first key that both hold, are
emitted and confirmed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import combinations, count
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .words import Words, as_long, chunks, mix

SHINGLE = 5
CHUNK = 5
ERRORS = 1
#: Pivots of a strict key in each of the first rounds.
PIVOTS = (2, 8)
#: Bits of the long signatures, and members of a key that are compared in one go.
BITS, BLOCK = 1024, 512
SETS = "doc_id long, n_shingles long, digest binary, signature array<short>"


def tail(n: int, p: float, most: int) -> float:
    """Probability that more than ``most`` of ``n`` places differ, each with probability ``p``."""
    term = lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p))
    return sum(term(i) for i in range(most + 1, n + 1))


def chunks_for(threshold: float, chunk: int = CHUNK, errors: int = ERRORS, miss: float = 1e-6) -> int:
    """The fewest chunks for which a pair at the threshold exceeds the distance with probability below ``miss``."""
    return next(m for m in range(1, 1000) if tail(m * chunk, 1 - threshold, m * (errors + 1) - 1) < miss)


def bits_for(threshold: float, bits: int = BITS, miss: float = 1e-6) -> int:
    """The distance of one-bit signatures that a pair at the threshold exceeds with probability below ``miss``."""
    return next(d for d in range(bits) if tail(bits, (1 - threshold) / 2, d) < miss)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text (A-Z folded); texts of fewer words are one shingle."""
    for first, end, data, offsets in chunks(column):
        words = Words(data, offsets)
        hashes = words.hashes(lower=True)
        grams, _ = words.runs(hashes, k)
        for i in range(end - first):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= k:
                yield np.unique(grams[a : b - k + 1])
            elif b > a:
                yield mix(np.bitwise_xor.reduce(mix(hashes[a:b] + np.arange(1, b - a + 1, dtype=np.uint64)))[None] + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def sign(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value under each of the permutations ``h * factor`` of 32-bit hashes."""
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 1 << 14):
        np.minimum(low, (short[i : i + (1 << 14), None] * factors).min(axis=0), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16).view(np.int16)


def signatures(docs: DataFrame, key: str, text: str, length: int, shingle: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, signature)``; a document without words has no digest."""
    factors = np.random.default_rng(11).integers(0, 1 << 31, length, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            counts, digests, signed = [], [], []
            for s in shingle_sets(batch.column("text"), shingle):
                counts.append(len(s))
                digests.append(digest_of(s))
                signed.append(sign(s, factors))
            flat = pa.array(np.concatenate(signed), pa.int16())
            places = pa.array(np.arange(0, len(signed) * length + 1, length, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(places, flat)],
                names=["doc_id", "n_shingles", "digest", "signature"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(measure, SETS)


def long_signature(shingles: np.ndarray, seeds: np.ndarray) -> bytes:
    """A bit of the smallest value under each of many permutations, packed."""
    low = np.full(len(seeds), 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 512):
        x = (short[i : i + 512, None] ^ seeds) * np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0xC2B2AE35)
        np.minimum(low, x.min(axis=0), out=low)
    return np.packbits((low * np.uint32(0x9E3779B1)) >> np.uint32(31)).tobytes()


def kept_places(n_chunks: int, chunk: int = CHUNK, errors: int = ERRORS) -> list[tuple[int, ...]]:
    """The places of each key: for each chunk, all ways to leave ``errors`` places out."""
    return [tuple(c * chunk + i for i in keep) for c in range(n_chunks) for keep in combinations(range(chunk), chunk - errors)]


def keyed(classes: DataFrame, places: list[tuple[int, ...]]) -> DataFrame:
    """``(n, key, rep)``: the key number ``n`` of every class, a hash of its signature at ``places[n]``."""
    keys = F.array(*[F.xxhash64(F.lit(n), *[F.col("signature")[i] for i in p]) for n, p in enumerate(places)])
    return classes.select(F.posexplode(keys).alias("n", "key"), "rep")


def _shared(members: DataFrame, by: str = "rep") -> DataFrame:
    """The keys of ``members`` that hold different values of ``by``, and how many members they have."""
    return (
        members.groupBy("key").agg(F.min(by).alias("_a"), F.max(by).alias("_b"), F.count(F.lit(1)).alias("size"))
        .filter("_a < _b").select("key", "size")
    )


def digest_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def with_digest(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the ``digest`` of each text's shingles, NULL for a text without words."""
    docs = docs.drop("digest")
    schema = T.StructType([*docs.schema.fields, T.StructField("digest", T.BinaryType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                digests = pa.array([digest_of(s) for s in shingle_sets(batch.column(text), shingle)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, digests], names=[*batch.schema.names, "digest"])

    return docs.mapInArrow(measure, schema)


def uniquely_named(classes: DataFrame, name: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """``classes`` stored with a ``rep`` that no two digests share.

    ``name`` hashes the digest.  Digests that got the same name are hashed again
    with the number of the round until all names differ.
    """
    classes = stored(classes.withColumn("rep", name("digest")), "equal-sets")
    for again in count(1):
        twice = stored(classes.groupBy("rep").count().filter("count > 1").select("rep", F.lit(True).alias("_twice")), "equal-names")
        if twice.isEmpty():
            return classes
        anew = F.when(F.col("_twice"), name("digest", F.lit(again))).otherwise(F.col("rep"))
        classes = stored(classes.join(twice, "rep", "left").withColumn("rep", anew).drop("_twice"), "equal-sets")


def _class_table(docs: DataFrame, wanted: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``(rep, shingles, bits)`` of the classes ``wanted (first_id, rep, digest)``, one row each.

    Of the texts that share a class's first id only those of its digest count.
    """
    seeds = np.random.default_rng(13).integers(0, 1 << 32, BITS, dtype=np.uint32)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("digest").to_pylist()
            found = [(i, s) for i, s in enumerate(shingle_sets(batch.column("text"), shingle)) if digest_of(s) == own[i]]
            if not found:
                continue
            sets = [s for _, s in found]
            places = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pa.array([i for i, _ in found])), pa.ListArray.from_arrays(pa.array(places), pa.array(as_long(np.concatenate(sets)), pa.int64())),
                 pa.array([long_signature(s, seeds) for s in sets], pa.binary())],
                names=["rep", "shingles", "bits"],
            )

    rows = docs.select(F.col(key).cast("long").alias("first_id"), F.col(text).alias("text")).join(wanted, "first_id")
    return rows.mapInArrow(gather, "rep long, shingles array<long>, bits binary").dropDuplicates(["rep"])


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` with 100 * intersection >= threshold * union."""
    both = F.size(F.array_intersect("_x", "_y"))
    return (
        pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("_y")), "b")
        .join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("_x")), "a")
        .filter(100 * both >= threshold * (F.size("_x") + F.size("_y") - both))
        .select("a", "b")
    )


def pivot_pairs(members: DataFrame, labels: DataFrame, pivots: int) -> DataFrame:
    """Each member of a key with the key's pivots (the smallest member of each of ``pivots`` salts), unless connected."""
    placed = members.select("key", "rep").join(labels, "rep")
    placed = stored(placed.join(_shared(placed, "comp").select("key"), "key", "left_semi"), "key-members")
    lead = placed.groupBy("key", F.pmod(F.xxhash64("rep"), F.lit(pivots))).agg(F.min(F.struct("rep", "comp")).alias("_l"))
    lead = lead.select("key", F.col("_l.rep").alias("_p"), F.col("_l.comp").alias("_c"))
    return (
        placed.join(lead, "key").filter("rep <> _p AND comp <> _c")
        .select(F.least("rep", "_p").alias("a"), F.greatest("rep", "_p").alias("b")).distinct()
    )


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``_group``: at most a batch and the group begun before it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("_group").to_numpy()
        if held and held[-1].column("_group")[-1].as_py() != group[0]:
            yield pa.Table.from_batches(held)
            held = []
        last = int(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def block_pairs(
    members: DataFrame, labels: DataFrame, classes: DataFrame, places: list[tuple[int, ...]], bits: int, block: int = BLOCK,
) -> DataFrame:
    """The pairs ``(a, b)`` that share a key, are not connected and differ in at most ``bits`` bits.

    A key's members are dealt to blocks; every pair of blocks is one group of
    rows, and a task holds about one group at a time.  A pair that shares
    several keys is emitted under the first of them only.
    """
    placed = members.join(labels, "rep")
    unsettled = _shared(placed, "comp").select("key", F.ceil(F.col("size") / block).cast("int").alias("_blocks"))
    placed = placed.join(unsettled, "key").withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    dealt = placed.select("*", F.explode(others).alias("_other")).select(
        "key", "n", "rep", "comp", "_own", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j")
    )
    rows = dealt.join(classes, "rep").withColumn("_group", F.xxhash64("key", "_i", "_j"))

    kept = np.array(places)

    def links(table: pa.Table) -> pa.RecordBatch:
        group, n, rep, comp, own, i_, j_ = (
            table.column(c).to_numpy() for c in ("_group", "n", "rep", "comp", "_own", "_i", "_j")
        )
        packed = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(rep), -1)
        signed = table.column("signature").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))
        left, right = [], []
        for begin, end in zip(starts, np.append(starts[1:], len(order)), strict=True):
            rows = order[begin:end]
            if (comp[rows] == comp[rows[0]]).all():
                continue
            same_block = i_[rows[0]] == j_[rows[0]]
            first = rows if same_block else rows[own[rows] == i_[rows]]
            second = rows if same_block else rows[own[rows] == j_[rows]]
            for at, x in enumerate(first):
                y = second[at + 1 :] if same_block else second
                y = y[comp[y] != comp[x]]
                y = y[np.bitwise_count(packed[y] ^ packed[x]).sum(axis=1) <= bits]
                for z in y:
                    agree = signed[x] == signed[z]
                    if np.argmax(agree[kept].all(axis=1)) == n[x]:
                        left.append(min(rep[x], rep[z]))
                        right.append(max(rep[x], rep[z]))
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            yield links(table)

    return rows.repartition("_group").sortWithinPartitions("_group").mapInArrow(compare, "a long, b long").distinct()


def connect(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels (rep, comp)`` after joining the components that ``links (a, b)`` connect; a label is the smallest member.

    Every label points to its smallest neighbour, pointers are followed to
    their ends, links are renamed, until no link joins two labels.
    """
    of = lambda side, name: labels.select(F.col("rep").alias(side), F.col("comp").alias(name))
    edges = links.join(of("a", "x"), "a").join(of("b", "y"), "b").filter("x <> y").select("x", "y").distinct()
    edges = stored(edges, "component-links")
    while not edges.isEmpty():
        both = edges.union(edges.select("y", "x"))
        ends = stored(both.groupBy("x").agg(F.min(F.least("x", "y")).alias("to")), "component-pointers")
        while True:
            on = ends.select(F.col("x").alias("to"), F.col("to").alias("_on"))
            moved = stored(ends.join(on, "to", "left").select("x", F.coalesce("_on", "to").alias("to"), (F.col("_on") < F.col("to")).alias("_moved")), "component-pointers")
            ends = moved.select("x", "to")
            if moved.filter("_moved").isEmpty():
                break
        to = ends.select(F.col("x").alias("comp"), "to")
        labels = stored(labels.join(to, "comp", "left").select("rep", F.coalesce("to", "comp").alias("comp")), "component-labels")
        edges = stored(
            edges.join(ends.select("x", F.col("to").alias("_x")), "x").join(ends.select(F.col("x").alias("y"), F.col("to").alias("_y")), "y")
            .filter("_x <> _y").select(F.col("_x").alias("x"), F.col("_y").alias("y")).distinct(),
            "component-links",
        )
    return labels


def near_duplicates(
    docs: DataFrame, threshold: int = 85, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
    n_chunks: int | None = None, pivots: tuple[int, ...] = PIVOTS, block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Documents with Jaccard similarity of at least ``threshold`` percent are
    linked; ``component_id`` is the smallest id reachable and ``kept`` marks it.
    NULL, empty and blank texts have no shingles and are linked with nothing.
    Rows that share an id are judged by their own texts, so they can lie in
    different components.  A row with a NULL id is linked with nothing and kept;
    its component is NULL.  An empty table stays empty.
    """
    return judged(docs, threshold, key, text, shingle, n_chunks, pivots, block).drop("digest", "comp")


def judged(
    docs: DataFrame, threshold: int = 85, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
    n_chunks: int | None = None, pivots: tuple[int, ...] = PIVOTS, block: int = BLOCK,
) -> DataFrame:
    """``near_duplicates`` with the ``digest`` of each row's shingles and the name ``comp`` of its component.

    Classes of equal sets have names of 64 bits (``rep``) that no two share, and
    a component the smallest name; its smallest id is taken at the end.
    """
    n_chunks = n_chunks or chunks_for(threshold / 100)
    places = kept_places(n_chunks)
    strict = [tuple(range(c * CHUNK, (c + 2) * CHUNK)) for c in range(n_chunks - 1)]
    signed = stored(signatures(docs, key, text, n_chunks * CHUNK, shingle), "signatures")
    classes = uniquely_named(
        signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.min("signature").alias("signature"))
    )
    every = keyed(classes, places)
    members = stored(every.join(_shared(every).select("key"), "key", "left_semi"), "key-members")
    involved = stored(members.select("rep").distinct(), "key-classes")
    wanted = classes.join(involved, "rep", "left_semi").select("first_id", "rep", "digest")
    table = stored(_class_table(docs, wanted, key, text, shingle), "class-table")
    sets = table.select("rep", "shingles")
    short = stored(classes.join(involved, "rep", "left_semi").select("rep", "signature"), "class-signatures")
    labels = stored(involved.withColumn("comp", F.col("rep")), "component-labels")

    tight = stored(keyed(short, strict), "strict-members")
    for many in pivots:
        pairs = stored(pivot_pairs(tight, labels, many), "class-pairs")
        labels = connect(labels, confirmed(pairs, sets, threshold))
    rest = block_pairs(members, labels, short.join(table.select("rep", "bits"), "rep"), places, bits_for(threshold / 100), block)
    labels = connect(labels, confirmed(stored(rest, "class-pairs"), sets, threshold))

    ids = labels.join(classes.select("rep", "first_id"), "rep").groupBy("comp").agg(F.min("first_id").alias("component_id"))
    named = labels.join(ids, "comp").select("rep", "comp", "component_id")
    found = classes.join(named, "rep", "left").select(
        "digest", F.coalesce("comp", "rep").alias("comp"), F.coalesce("component_id", "first_id").alias("component_id")
    )
    result = signed.select("doc_id", "n_shingles", "digest").join(found, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return result.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "digest", "comp",
    )
