"""Repeated byte strings by prefix-free parsing.

Every text is parsed at triggers: places where the rolling hash of ``TRIGGER``
bytes is the smallest of a window of ``WINDOW`` bytes (the leftmost of ties).
Each window then holds a trigger, and equal windows hold it at the same place.
(A fixed residue of the hash, the usual trigger, leaves some windows without
one.)  The bytes up to and over a trigger are a phrase; what follows from the
trigger on is a suffix of the parse.

A window's place in corpus order is a pair: the suffix of its phrase, then the
suffix of the parse, cut where the window ends.  No phrase suffix that ends
with a trigger is a proper prefix of another, so the pair orders windows as
their bytes would, and equal windows become neighbours.  The order of both
parts is that of their fingerprints; which bytes come first doesn't matter to
find neighbours.

* The dictionary comes first: all windows of one trigger at a time, as one
  entry.  Where a smaller document holds the same entry, all its windows repeat
  and none is looked at again, so repetitive text costs its dictionary only.
* Of entries that share a trigger but are not the same (the edges of a repeat),
  one document sends its windows, and these are put in corpus order themselves.

No group of copies meets in one task: equal entries of one batch are reduced to
the smallest document first, and a trigger that has several entries within a
batch is announced once and its entries are dealt one by one.

Millions of small rows would cost Spark more than the work on them.  So the rows
of a batch are sorted by ``part``, cut into buckets (ranges of ``part``) and sent
as one block of records for each bucket.  A task takes its buckets in turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffles_freed, stored
from .words import chunks, mix, powers, text_buffer

WINDOW = 50
TRIGGER = 24
#: Bytes of text parsed at once; a longer text is parsed in slices that overlap by a window.
SLICE = 1 << 17
#: Bytes of rows (of ``ROW_BYTES``) that are reduced together before they are sent on.
SEND_BYTES = 1 << 24
ROW_BYTES = 24
#: Buckets that rows are dealt to, for each shuffle partition and at least.
BUCKETS, LEAST_BUCKETS = 8, 4096
#: Kinds of rows on their way to the task that orders them.
BY_TRIGGER, ANNOUNCED, BY_ENTRY, SETTLED = 0, 1, 2, 3
#: Kind of the rows that tell a document of an entry to look into; ``SETTLED`` tells it of one that repeats.
OPEN = 4
#: Records of one bucket and kind; their documents are counted from ``base`` in ``width`` bytes each.
BLOCKS = "bucket int, kind byte, base long, width byte, records binary"
LISTS = "doc_id long, settled binary, open binary"
_BYTE, _SALT, _LOW = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFFFFFFFF)
#: Multiplier of the hash that ranks triggers, and of its last step; the low bits of a rank make room for a place within a slice.
_RANK, _SPREAD, _PLACE = 0x9E3779B1, np.uint32(0x85EBCA6B), 18


def slices(column: pa.Array, window: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, begin, bytes, offsets)``: runs of whole texts, or a slice from ``begin`` of one long text."""
    for first, end, data, offsets in chunks(column, SLICE):
        if end == first + 1 and len(data) > SLICE:
            for begin in range(0, len(data) - window + 1, SLICE):
                part = data[begin : begin + SLICE + window - 1]
                yield first, begin, part, np.array([0, len(part)])
        else:
            yield first, 0, data, offsets


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every ``size`` consecutive values."""
    low, have = values, 1
    while 2 * have <= size:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    places = len(values) - size + 1
    return np.minimum(low[:places], low[size - have : size - have + places]) if have < size else low


def ranks(data: np.ndarray, size: int) -> np.ndarray:
    """A 32-bit hash of every ``size`` consecutive bytes, by doubling: only its high bits are good."""
    have, length, done, out = data.astype(np.uint32), 1, 0, None
    factor = lambda n: np.uint32(pow(_RANK, n, 1 << 32))
    places = len(data) - size + 1
    while True:
        if size & length:  # the next ``length`` bytes, after the ``done`` ones
            part = have[done : done + places]
            out = part.copy() if out is None else out * factor(length) + part
            done += length
        if done == size:
            break
        have = have[:-length] * factor(length) + have[length:]
        length *= 2
    return (out ^ (out >> np.uint32(15))) * _SPREAD


class Parse:
    """The dictionary entries of some texts: ``trigger, entry, doc`` and their windows ``begin .. end - 1`` (places)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, trigger: int = TRIGGER):
        n, self.window = len(data), window
        places = n - window + 1
        if places <= 0:
            self.begin = self.end = self.doc = np.zeros(0, np.int64)
            self.trigger = self.entry = np.zeros(0, np.uint64)
            return
        self._total = np.zeros(n + 1, np.uint64)
        np.cumsum(data * powers(_BYTE, n), out=self._total[1:])
        self._back = powers(_BYTE, n + 1, True)
        # A rank has as many bits whatever is parsed beside, so that equal windows have their trigger at the same place.
        shift, kind = (_PLACE, np.uint32) if n >> _PLACE == 0 else (32, np.uint64)
        ranked = (ranks(data, trigger) >> np.uint32(_PLACE)).astype(kind) << kind(shift)
        ranked |= np.arange(len(ranked), dtype=kind)
        at = sliding_min(ranked, window - trigger + 1) & kind((1 << shift) - 1)
        # Entries begin where the trigger changes, where a text begins and after its last window.
        first = np.empty(places, bool)
        np.not_equal(at[1:], at[:-1], out=first[1:])
        first[0] = True
        cuts = np.concatenate([offsets[1:-1], offsets[1:] - window + 1])
        first[cuts[(cuts >= 0) & (cuts < places)]] = True
        begin = np.flatnonzero(first)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(begin, offsets)))
        inside = begin + window <= offsets[1:][doc]
        self.begin, self.end, self.doc = begin[inside], np.append(begin[1:], places)[inside], doc[inside]
        self.at = at[self.begin].astype(np.int64)
        self.stop = self.at + trigger
        self.trigger = self._print(self.at, self.stop)
        self.entry = self._pair(self.begin, self.end + window - 1, self.at, self.stop)

    def _print(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self._total[b] - self._total[a]) * self._back[a] + (b - a).astype(np.uint64) * _SALT)

    def _pair(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Fingerprint of the phrase suffix ``a .. stop`` and the parse suffix ``at .. b``."""
        return mix(self._print(a, stop) + mix(self._print(at, b) + _SALT))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(number of the entry, place, fingerprint)`` of every window of the entries ``which``."""
        sizes = self.end[which] - self.begin[which]
        number = np.repeat(which, sizes)
        place = self.begin[number] + np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return number, place, self._pair(place, place + self.window, self.at[number], self.stop[number]) if len(number) else np.zeros(0, np.uint64)


def in_order(key: np.ndarray, *then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by ``key`` and ``then``, and the places in it of rows whose key is perhaps not their own.

    Keys are sorted with their row number in place of the low bits; only rows that share the rest are compared in full.
    """
    bits = np.uint64(max(1, (len(key) - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = (key & ~low) | np.arange(len(key), dtype=np.uint64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    packed >>= bits
    same = np.zeros(len(key) + 1, bool)
    np.equal(packed[1:], packed[:-1], out=same[1:-1])
    crowd = np.flatnonzero(same[1:] | same[:-1])
    rows = order[crowd]
    order[crowd] = rows[np.lexsort((*[c[rows] for c in reversed(then)], key[rows]))]
    return order, crowd


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before it in any column."""
    lead = np.ones(len(columns[0]), bool)
    if len(lead):
        lead[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return lead


def _records(width: int, checked: bool) -> np.dtype:
    return np.dtype([*[("low", "<u4")] * checked, ("entry", "<u8"), ("doc", f"<u{width}")])


def _blocks(kind: int, part: np.ndarray, buckets: int, entry: np.ndarray, doc: np.ndarray, low: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Blocks of rows in order of ``part``."""
    if not len(part):
        return
    base = doc.min()
    away = doc.view(np.uint64) - base.view(np.uint64)
    width = next(w for w in (1, 2, 4, 8) if int(away.max()) < 1 << 8 * w)
    records = np.empty(len(part), _records(width, low is not None))
    if low is not None:
        records["low"] = low
    records["entry"] = entry
    records["doc"] = away
    bucket = ((part >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    starts = np.flatnonzero(changes(bucket))
    offsets = (np.append(starts, len(part)) * records.itemsize).astype(np.int32)
    n = len(starts)
    yield pa.RecordBatch.from_arrays([
        pa.array(bucket[starts].astype(np.int32)), pa.array(np.full(n, kind, np.int8)), pa.array(np.full(n, base)), pa.array(np.full(n, width, np.int8)),
        pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(records)]),
    ], names=["bucket", "kind", "base", "width", "records"])


def _told(kind: int, doc: np.ndarray, entry: np.ndarray, buckets: int, **more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of what documents are told, each document in one bucket."""
    part = mix(doc.view(np.uint64))
    order = np.argsort(part)
    yield from _blocks(kind, part[order], buckets, entry[order], doc[order], **{k: v[order] for k, v in more.items()})


def _opened(batch: pa.RecordBatch, checked: bool) -> tuple[np.ndarray, ...]:
    """``(bucket, kind, entry, doc, low)`` of every record (without ``low`` unless ``checked``)."""
    bucket, kind, base, width = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "kind", "base", "width"))
    data, offsets = text_buffer(batch.column("records"))
    entries, docs, lows = [], [], []
    starts = np.flatnonzero(changes(width))
    for a, b in zip(starts, [*starts[1:], len(width)], strict=True):
        records = data[offsets[a] : offsets[b]].view(_records(width[a], checked))
        entries.append(records["entry"])
        docs.append(records["doc"].astype(np.int64))
        if checked:
            lows.append(records["low"])
    sizes = np.diff(offsets) // (_records(1, checked).itemsize - 1 + width.astype(np.int64))
    doc = np.concatenate(docs)
    doc += np.repeat(base, sizes)
    return np.repeat(bucket, sizes), np.repeat(kind, sizes), np.concatenate(entries), doc, *(np.concatenate(x) for x in [lows] * checked)


def _by_bucket(blocks: DataFrame, handle: Callable[..., Iterator[pa.RecordBatch]], checked: bool, schema: str) -> DataFrame:
    """Gives ``handle`` the records of whole buckets, some buckets at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _opened(batch, checked)
            last = int(np.searchsorted(new[0], new[0][-1], "left"))  # rows are sorted by bucket
            if held and new[0][0] != held[-1][0][-1]:
                yield from handle(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            if last:
                yield from handle(*map(np.concatenate, zip(*held, [c[:last] for c in new], strict=True)))
                held = []
            held.append(tuple(c[last:].copy() for c in new))
        if held:
            yield from handle(*map(np.concatenate, zip(*held, strict=True)))

    return blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _reduced(trigger: np.ndarray, entry: np.ndarray, doc: np.ndarray, by_trigger: bool, buckets: int) -> Iterator[pa.RecordBatch]:
    """The rows to send for some texts: of equal entries the smallest document, the others are settled."""
    order, crowd = in_order(trigger, entry, doc) if by_trigger else in_order(entry, trigger, doc)
    trigger, entry, doc = trigger[order], entry[order], doc[order]
    # Only a row in a crowd can share its entry or its trigger.
    t, e, d = trigger[crowd], entry[crowd], doc[crowd]
    lead = changes(t, e)
    again = ~lead
    again[1:] &= d[1:] == d[:-1]
    settled = (d > d[lead][np.cumsum(lead) - 1]) & ~again if len(d) else again
    yield from _told(SETTLED, d[settled], e[settled], buckets, low=np.zeros(int(settled.sum()), np.uint32))
    sent = np.ones(len(trigger), bool)
    sent[crowd] = lead
    if by_trigger:
        group = np.cumsum(changes(t[lead])) - 1
        several = (np.bincount(group) > 1)[group]
        part, e, d = t[lead][several], e[lead][several], d[lead][several]
        sent[crowd[lead][several]] = False
        announced = np.unique(part)
        none = np.zeros(len(announced), np.int64)
        yield from _blocks(ANNOUNCED, announced, buckets, none, none, announced & _LOW)
        order = np.argsort(e)
        yield from _blocks(BY_ENTRY, e[order], buckets, e[order], d[order], part[order] & _LOW)
        yield from _blocks(BY_TRIGGER, trigger[sent], buckets, entry[sent], doc[sent], trigger[sent] & _LOW)
    else:
        yield from _blocks(BY_ENTRY, entry[sent], buckets, entry[sent], doc[sent], trigger[sent] & _LOW)


def _sent(batches: Iterator[pa.RecordBatch], window: int, trigger: int, by_trigger: bool, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows for the entries of each text, or for the windows of its ``open`` entries."""
    found, held = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        wanted = None if by_trigger else Listed(batch.column("open"))
        for first, _, data, offsets in slices(batch.column("text"), window):
            p = Parse(data, offsets, window, trigger)
            if by_trigger:
                found.append((p.trigger, p.entry, ids[first + p.doc]))
            else:
                number, _, prints = p.windows(np.flatnonzero(wanted.has(p.entry, first + p.doc, first, first + len(offsets) - 1)))
                found.append((p.trigger[number], prints, ids[first + p.doc[number]]))
            held += len(found[-1][0]) * ROW_BYTES
            if held >= SEND_BYTES:
                yield from _reduced(*[np.concatenate(c) for c in zip(*found, strict=True)], by_trigger, buckets)
                found, held = [], 0
    if held:
        yield from _reduced(*[np.concatenate(c) for c in zip(*found, strict=True)], by_trigger, buckets)


def neighbours(rows: DataFrame, by_trigger: bool, buckets: int) -> DataFrame:
    """Puts the rows in order and tells each document what a smaller one holds too; buckets stream by.

    ``by_trigger``, a document is also told of its entries that share a trigger only.
    """

    def compare(bucket: np.ndarray, kind: np.ndarray, entry: np.ndarray, doc: np.ndarray, low: np.ndarray) -> Iterator[pa.RecordBatch]:
        done = kind == SETTLED
        docs, entries, opened = [doc[done]], [entry[done]], []
        key = (low.astype(np.uint64) << np.uint64(32)) | bucket.astype(np.uint64)  # stands for the trigger
        own = kind == BY_TRIGGER
        if own.any():
            announced = np.unique(key[kind == ANNOUNCED])
            k, e, d = key[own], entry[own], doc[own]
            order, crowd = in_order(k, e, d)
            if len(announced):
                near = announced[np.minimum(np.searchsorted(announced, k[order]), len(announced) - 1)] == k[order]
                near[crowd] = True
                crowd = np.flatnonzero(near)
            order = order[crowd]
            k, e, d = k[order], e[order], d[order]
            lead = changes(k, e)
            later = d > d[lead][np.cumsum(lead) - 1]
            group = np.cumsum(changes(k[lead])) - 1
            shared = (np.bincount(group) > 1)[group]
            shared |= np.isin(k[lead], announced)
            docs.append(d[later])
            entries.append(e[later])
            opened.append((d[lead][shared], e[lead][shared]))
        own = kind == BY_ENTRY
        if own.any():
            e, c, d = entry[own], low[own], doc[own]
            order, crowd = in_order(e, c, d)
            if by_trigger:
                crowd = np.arange(len(e))
            order = order[crowd]
            e, c, d = e[order], c[order], d[order]
            lead = changes(e, c)
            later = d > d[lead][np.cumsum(lead) - 1]
            docs.append(d[later])
            entries.append(e[later])
            if by_trigger:
                opened.append((d[lead], e[lead]))
        yield from _told(SETTLED, np.concatenate(docs), np.concatenate(entries), buckets)
        if opened:
            yield from _told(OPEN, *[np.concatenate(c) for c in zip(*opened, strict=True)], buckets)

    def gathered(bucket: np.ndarray, kind: np.ndarray, entry: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
        docs = np.unique(doc)
        key = 2 * np.searchsorted(docs, doc) + (kind == OPEN)
        bits = max(1, (len(key) - 1).bit_length())
        entry = entry[np.sort((key << bits) | np.arange(len(key))) & ((1 << bits) - 1)]
        sizes = np.bincount(key, minlength=2 * len(docs))
        mine = np.repeat(np.arange(len(sizes)) % 2, sizes)
        lists = []
        for k in (0, 1):
            offsets = np.concatenate([[0], 8 * np.cumsum(sizes[k::2])]).astype(np.int32)
            lists.append(pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(offsets), pa.py_buffer(entry[mine == k])]))
        yield pa.RecordBatch.from_arrays([pa.array(docs), *lists], names=["doc_id", "settled", "open"])

    return _by_bucket(_by_bucket(rows, compare, True, BLOCKS), gathered, False, LISTS)


class Listed:
    """A column of fingerprint lists (as bytes), asked for runs of rows (NULL lists are empty)."""

    def __init__(self, column: pa.Array):
        data, offsets = text_buffer(column)
        self.ends, self.values = offsets // 8, data.view(np.uint64)

    def has(self, prints: np.ndarray, rows: np.ndarray, first: int, end: int) -> np.ndarray:
        """Whether each fingerprint is in the list of its row; all rows lie in ``first .. end - 1``."""
        a, b = self.ends[first], self.ends[end]
        if a == b:
            return np.zeros(len(prints), bool)
        own = np.repeat(np.arange(first, end), np.diff(self.ends[first : end + 1]))
        listed = self.values[a:b] + own.astype(np.uint64) * _SALT
        listed.sort()
        asked = prints + rows.astype(np.uint64) * _SALT
        return listed[np.minimum(np.searchsorted(listed, asked), b - a - 1)] == asked


OUTPUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def told_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch in two: the documents that were told something, and the others, which needn't be parsed."""
    for batch in batches:
        sizes = [pc.fill_null(pc.binary_length(batch.column(c)), 0) for c in ("settled", "found")]
        told = pc.greater(pc.add(*sizes), 0)
        for rows in (batch.filter(told), batch.filter(pc.invert(told))):
            if rows.num_rows:
                yield rows


def removed(docs: DataFrame, window: int, trigger: int, with_parts: bool) -> DataFrame:
    """One row per document from its ``settled`` entries and the ``found`` windows of its ``open`` ones."""
    schema = OUTPUT + (", spans array<struct<begin: long, end: long>>, kept binary" if with_parts else "")
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in told_first(batches):
            settled, opened, found = (Listed(batch.column(c)) for c in ("settled", "open", "found"))
            n_bytes, gone, n_spans, digests, spans, kept = [], [], [], [], [], []

            def repeats(data: np.ndarray, offsets: np.ndarray, first: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                """``(begin, end)`` of the strings that go, slice by slice of one long text."""
                long = end == first + 1 and len(data) > SLICE
                for start in range(0, len(data) - window + 1, SLICE) if long else (0,):
                    part = data[start : start + SLICE + window - 1] if long else data
                    p = Parse(part, np.array([0, len(part)]) if long else offsets, window, trigger)
                    if not len(p.begin):
                        continue
                    rows = first + p.doc
                    whole = np.flatnonzero(settled.has(p.entry, rows, first, end))
                    yield start + p.begin[whole], start + p.end[whole] + window - 1
                    if found.ends[first] < found.ends[end]:
                        # Only open entries share a window with an entry that is not the same.
                        number, place, prints = p.windows(np.flatnonzero(opened.has(p.entry, rows, first, end)))
                        place = place[found.has(prints, rows[number], first, end)]
                        yield start + place, start + place + window

            for first, end, data, offsets in chunks(batch.column("text"), SLICE):
                begins, ends = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if settled.ends[first] < settled.ends[end] or found.ends[first] < found.ends[end]:
                    begins, ends = map(np.concatenate, zip((begins, ends), *repeats(data, offsets, first, end), strict=True))
                    order = np.argsort(begins)
                    begins, ends = begins[order], np.maximum.accumulate(ends[order])
                    if len(begins):  # runs, each within one text
                        lead = np.ones(len(begins), bool)
                        doc = np.searchsorted(offsets, begins, "right")
                        lead[1:] = (begins[1:] > ends[:-1]) | (doc[1:] != doc[:-1])
                        begins, ends = begins[lead], ends[np.append(np.flatnonzero(lead)[1:], len(lead)) - 1]
                edges = np.searchsorted(begins, offsets)
                raw = memoryview(np.ascontiguousarray(data))
                for a, b, i, j in zip(*[x.tolist() for x in (offsets[:-1], offsets[1:], edges[:-1], edges[1:])], strict=True):
                    own, to = begins[i:j].tolist(), ends[i:j].tolist()
                    rest = b"".join([raw[x:y] for x, y in zip([a, *to], [*own, b], strict=True)]) if own else raw[a:b]
                    n_bytes.append(b - a)
                    gone.append(b - a - len(rest))
                    n_spans.append(j - i)
                    digests.append(hashlib.sha256(rest).hexdigest())
                    if with_parts:
                        spans.append([{"begin": x - a, "end": y - a} for x, y in zip(own, to, strict=True)])
                        kept.append(bytes(rest))
            columns = [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in (n_bytes, gone, n_spans)], pa.array(digests, pa.string())]
            names = [f.split()[0] for f in OUTPUT.split(", ")]
            if with_parts:
                columns, names = [*columns, pa.array(spans, span_type), pa.array(kept, pa.binary())], [*names, "spans", "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(cut, schema)


def buckets_of(spark: SparkSession) -> int:
    return max(LEAST_BUCKETS, BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")))


def dedup_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, trigger: int = TRIGGER, with_parts: bool = True,
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept)``, one row per row of ``docs``.

    A byte of a text's UTF-8 form goes if a string of ``window`` bytes over it
    also starts in a document with a smaller id; strings are judged on the
    input.  ``spans`` are the maximal removed runs (end exclusive) and ``kept``
    the remaining bytes, which may end within a character; both only
    ``with_parts``.  NULL text is empty; a text shorter than the window stays
    whole.  A NULL id is neither smaller nor larger than any, so such rows stay
    whole and take nothing from others; rows that share an id (ties, repeated
    rows) don't dedup each other.  Other columns of ``docs`` are not read, so
    names can't clash.  An empty table stays empty.  Memory in a task follows
    ``SLICE`` and the longest single text, of which only bytes and marks are held.
    """
    if not 0 < trigger <= window:
        raise ValueError("the trigger must fit in the window")
    rows = docs.select(key, text)
    if rows.dtypes != [("doc_id", "bigint"), ("text", "string")]:  # else taken as they are: only so do both joins share an exchange
        rows = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = rows.filter("doc_id IS NOT NULL")

    buckets = buckets_of(docs.sparkSession)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sent(batches, window, trigger, True, buckets)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sent(batches, window, trigger, False, buckets)

    lists = neighbours(known.mapInArrow(entries, BLOCKS), True, buckets)
    with shuffles_freed(docs.sparkSession):  # the entries' shuffle is as large as all that follows
        listed = stored(lists, "phrase-lists")
    edges = known.join(listed.filter("length(open) > 0").select("doc_id", "open"), "doc_id")
    found = neighbours(edges.mapInArrow(windows, BLOCKS), False, buckets).select("doc_id", F.col("settled").alias("found"))
    # Both joins read the texts from one exchange by id.
    joined = known.join(listed, "doc_id", "left").join(found, "doc_id", "left")
    nobody = rows.filter("doc_id IS NULL").withColumns({c: F.lit(None).cast("binary") for c in ("settled", "open", "found")})
    return removed(joined.unionByName(nobody), window, trigger, with_parts)
