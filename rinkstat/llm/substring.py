"""Substring dedup by seed and extend on winnowed anchors.

Every window of ``WINDOW`` words has a seed: its ``SEED``-word run of smallest
hash, the leftmost of ties.  Equal windows have equal seeds at the same place,
so only documents that share a seed can share a window.  An anchor is a seed
with the run of windows that it stands for, and its extent is all their words.

* Anchors meet by seed.  Where a smaller document holds the same extent, the
  whole extent is a repeat: extension to both sides is done at once.
* Where a seed is shared but the extent isn't (the edges of a repeat), the
  anchor's windows are compared one by one.
* The words under all windows found this way are the union of the maximal
  repeats of at least ``WINDOW`` words.

Documents never meet in pairs.  Of equal extents in one batch only the smallest
document is sent on, and a seed that already differs in extent within a batch
is announced once and its anchors are dealt by extent, so a common passage
sends a row per batch to a task, not one per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .words import Words, as_long, chunks, mix, powers

WINDOW = 13
#: Words in a seed; the guarantee holds for any value up to ``WINDOW``.
SEED = 4
#: Kinds of rows on their way to the task that compares them.
BY_SEED, ANNOUNCED, BY_EXTENT, SETTLED = 0, 1, 2, 3
ROWS = "part long, kind byte, seed long, extent long, doc_id long"


class Anchors:
    """The anchors of a run of documents: ``seed, extent, doc`` and their windows ``begin .. end - 1`` (word numbers)."""

    def __init__(self, words: Words, window: int, seed: int):
        hashes = words.hashes()
        self.words, self.window, n = words, window, len(hashes)
        grams, _ = words.runs(hashes, seed)
        places = max(0, n - window + 1)
        inside = words.doc[:places] == words.doc[window - 1 :] if places else np.zeros(0, bool)
        low = grams[:places].copy()
        spread = window - seed + 1
        for j in range(1, spread):
            np.minimum(low, grams[j : places + j], out=low)
        at = np.arange(places)
        for j in range(spread - 1, -1, -1):
            at[grams[j : places + j] == low] = j
        starts = np.flatnonzero(inside)
        at = at[starts] + starts  # word where each window's seed begins
        first = np.ones(len(starts), bool)
        first[1:] = at[1:] != at[:-1]
        head = np.flatnonzero(first)
        self.begin = starts[head]
        self.end = starts[np.append(head[1:], len(starts)) - 1] + 1 if len(head) else starts[:0]
        where = at[head]
        self.doc = words.doc[where]
        self.seed = grams[where]
        # Hash of the words of an extent, by prefix sums of hash * power.
        base = 0xD1342543DE82EF95
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(base, n), out=total[1:])
        back = powers(base, n + 1, True)
        span = lambda a, b: mix((total[b] - total[a]) * back[a] + (b - a).astype(np.uint64))
        self._span = span
        self.extent = mix(span(self.begin, self.end + window - 1) + (where - self.begin).astype(np.uint64))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(anchor, first word, hash)`` of every window of the anchors ``which``."""
        sizes = self.end[which] - self.begin[which]
        anchor = np.repeat(which, sizes)
        first = self.begin[anchor] + np.arange(len(anchor)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return anchor, first, self._span(first, first + self.window)


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts by ``columns`` (the first is the major one), and where a new value of all but the last begins."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns[:-1]], axis=0)
    return order, new


def _send(seed: np.ndarray, extent: np.ndarray, doc: np.ndarray, by_seed: bool) -> pa.RecordBatch:
    """The rows that one batch of documents sends on."""
    order, new = _groups(seed, extent, doc)
    seed, extent, doc = seed[order], extent[order], doc[order]
    group = np.cumsum(new) - 1
    smallest = doc[new][group] if len(doc) else doc
    repeated = ~new
    repeated[1:] &= doc[1:] == doc[:-1]  # the same document again
    settled, lead = (doc > smallest) & ~repeated, new
    kinds = np.full(len(seed), BY_EXTENT, np.int8)
    announced = np.zeros(0, np.uint64)
    if by_seed:
        lead_seed = seed[lead]
        values, counts = np.unique(lead_seed, return_counts=True)
        announced = values[counts > 1]
        kinds[lead] = np.where(np.isin(lead_seed, announced), BY_EXTENT, BY_SEED)
    kinds[settled] = SETTLED
    part = np.where(kinds == BY_SEED, seed, np.where(kinds == SETTLED, mix(doc.view(np.uint64)), seed ^ mix(extent)))
    keep = lead | settled
    none = np.zeros(len(announced), np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(as_long(np.concatenate([part[keep], announced]))),
        pa.array(np.concatenate([kinds[keep], np.full(len(announced), ANNOUNCED, np.int8)])),
        pa.array(as_long(np.concatenate([seed[keep], announced]))),
        pa.array(as_long(np.concatenate([extent[keep], none.view(np.uint64)]))),
        pa.array(np.concatenate([doc[keep], none])),
    ], names=["part", "kind", "seed", "extent", "doc_id"])


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").to_numpy(zero_copy_only=False)


def anchor_rows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, found = _ids(batch), []
            for first, _, data, offsets in chunks(batch.column("text")):
                a = Anchors(Words(data, offsets), window, seed)
                found.append((a.seed, a.extent, ids[first + a.doc]))
            yield _send(*[np.concatenate(c) for c in zip(*found, strict=True)], by_seed=True)

    return docs.mapInArrow(find, ROWS)


def _compared(rows: DataFrame) -> DataFrame:
    """``(doc_id, extent, settled)``: whether a smaller document holds the same; FALSE where only the seed is shared."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        kind, seed, extent, doc = (
            np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in parts]) for c in ("kind", "seed", "extent", "doc_id")
        )
        done = kind == SETTLED
        out_doc, out_extent, out_state = [doc[done]], [extent[done]], [np.ones(done.sum(), bool)]
        announced = np.unique(seed[kind == ANNOUNCED])
        for k in (BY_SEED, BY_EXTENT):
            own = kind == k
            s, e, d = seed[own], extent[own], doc[own]
            order, new = _groups(s, e, d)
            s, e, d = s[order], e[order], d[order]
            smallest = d[new][np.cumsum(new) - 1] if len(d) else d
            later = d > smallest
            shared = np.ones(len(s), bool)
            if k == BY_SEED:
                values, inverse, counts = np.unique(s[new], return_inverse=True, return_counts=True)
                shared_lead = (counts > 1)[inverse] | np.isin(s[new], announced)
                shared = shared_lead[np.cumsum(new) - 1] if len(s) else shared
            keep = later | (new & shared)
            out_doc.append(d[keep])
            out_extent.append(e[keep])
            out_state.append(later[keep])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in (out_doc, out_extent, out_state)], names=["doc_id", "extent", "settled"]
        )

    return rows.repartition("part").mapInArrow(compare, "doc_id long, extent long, settled boolean")


def _listed(column: pa.Array, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the row of each (NULL lists are empty)."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.repeat(np.arange(rows), sizes)


def _marked(values: np.ndarray, rows: np.ndarray, listed: np.ndarray, listed_rows: np.ndarray, first: int, end: int) -> np.ndarray:
    """Whether each (row, value) is among the listed ones; all rows lie in ``first .. end - 1``."""
    salt = lambda v, r: mix(v + mix(r.astype(np.uint64) + np.uint64(1)))
    own = slice(*np.searchsorted(listed_rows, (first, end)))  # they are in row order
    return np.isin(salt(values, rows), salt(listed[own], listed_rows[own]))


def window_rows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """The windows of the anchors in ``open`` of each document, on their way to be compared."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, found = _ids(batch), []
            listed, listed_rows = _listed(batch.column("open"), batch.num_rows)
            for first, end, data, offsets in chunks(batch.column("text")):
                a = Anchors(Words(data, offsets), window, seed)
                which = np.flatnonzero(_marked(a.extent, first + a.doc, listed, listed_rows, first, end))
                anchor, _, hashes = a.windows(which)
                found.append((a.seed[anchor], hashes, ids[first + a.doc[anchor]]))
            yield _send(*[np.concatenate(c) for c in zip(*found, strict=True)], by_seed=False)

    return docs.mapInArrow(find, ROWS)


def removed(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept_text)`` from the documents and their found extents and windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            extents = _listed(batch.column("settled"), batch.num_rows)
            windows = _listed(batch.column("found"), batch.num_rows)
            n_words, n_removed, digests, kept = [], [], [], []
            for first, end, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets)
                a = Anchors(words, window, seed)
                whole = _marked(a.extent, first + a.doc, *extents, first, end)
                anchor, start, hashes = a.windows(np.flatnonzero(~whole))
                start = start[_marked(hashes, first + a.doc[anchor], *windows, first, end)]
                cover = np.zeros(len(words.doc) + 1, np.int64)
                np.add.at(cover, a.begin[whole], 1)
                np.add.at(cover, a.end[whole] + window - 1, -1)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + window, -1)
                stay = np.cumsum(cover[:-1]) == 0
                gone = words.counts - np.diff(np.concatenate([[0], np.cumsum(stay)])[words.first])
                for i in range(end - first):
                    split = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    if gone[i]:
                        split = compress(split, stay[words.first[i] : words.first[i + 1]].tolist())
                    text = b" ".join(split)
                    digests.append(hashlib.sha256(text).hexdigest())
                    kept.append(text)
                n_words.append(words.counts)
                n_removed.append(gone)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(np.concatenate(c), pa.int64()) for c in (n_words, n_removed)],
                 pa.array(digests, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return docs.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept_text)``, one row per row of ``docs``.

    A word goes if a window over it has a word sequence that also starts in a
    document with a smaller id.  NULL text has no words; a NULL id is neither
    smaller nor larger than any, so such rows stay whole and take nothing from
    others; rows that share an id don't dedup each other.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = rows.filter("doc_id IS NOT NULL")
    listed = stored(
        _compared(anchor_rows(known, window, seed)).groupBy("doc_id").agg(
            F.collect_list(F.when(F.col("settled"), F.col("extent"))).alias("settled"),
            F.collect_list(F.when(~F.col("settled"), F.col("extent"))).alias("open"),
        ),
        "anchor-lists",
    )
    edges = known.join(listed.filter(F.size("open") > 0).select("doc_id", "open"), "doc_id")
    found = (
        _compared(window_rows(edges, window, seed)).filter("settled")
        .groupBy("doc_id").agg(F.collect_list("extent").alias("found"))
    )
    # Both joins read the texts from one exchange by id.
    joined = known.join(listed.select("doc_id", "settled"), "doc_id", "left").join(found, "doc_id", "left")
    nobody = rows.filter("doc_id IS NULL").withColumns(
        {c: F.lit(None).cast("array<long>") for c in ("settled", "found")}
    )
    return removed(joined.unionByName(nobody), window, seed)
