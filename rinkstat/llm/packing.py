"""Best-fit packing planned on a histogram of lengths.

Documents become token ids; ids longer than a sequence are cut into pieces.
Best-fit decreasing runs over the histogram (one entry per length, at most the
sequence length many) and yields plan rows "the pieces of this length with
ranks a to b go to these sequences".  Pieces take their slots by joining on
length and rank; ranks come from counts per length and salt, so that no length
is numbered in one task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .words import Words, chunks

#: Bytes of text whose words are told apart at once.
CHUNK_BYTES = 1 << 21
#: Words whose ids a worker keeps before it starts over.
CACHE_WORDS = 1_000_000
PIECES_SCHEMA = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


class WordIds:
    """Token ids of words, kept so that a word is encoded once.

    The tokenizer drops white space and never joins ids over it, so a text's ids
    are those of its space-separated words one after the other.  Words of plain
    letters with marks at their end go straight to the tokenizer's model (the
    lower-cased letters, then the marks); all others through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        moved = iter(range(256, 512))
        self.byte_char = {b: chr(b if b in kept else next(moved)) for b in range(256)}
        self.plain = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.marks: dict[str, list[int]] = {"": []}
        self.ids, self.begin, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]

    def _ids(self, words: list[bytes]) -> list[list[int]]:
        out, letters = [], {}
        for word in words:
            text = word.decode()
            if (match := self.plain(text)) is None:
                out += self._whole([text])
                continue
            core, mark = match.groups()
            if (ids := letters.get(core)) is None:
                low = core.lower()
                if not low.isascii():
                    low = "".join(map(self.byte_char.__getitem__, low.encode()))
                ids = letters[core] = [t.id for t in self.tokenizer.model.tokenize(low)]
            if mark not in self.marks:
                self.marks[mark] = self._whole([mark])[0]
            out.append(ids + self.marks[mark] if mark else ids)
        return out

    def learn(self, words: list[bytes]) -> None:
        found = self._ids(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
        first, last = len(self.index), len(self.index) + len(words)
        for w in words:
            self.index[w] = len(self.index)
        while len(self.begin) < last:
            self.begin, self.size = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.size, 2 * len(self.size))
        while len(self.ids) < self.used + len(flat):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.size[first:last] = sizes
        self.begin[first:last] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, learning those not known yet."""
        index = self.index
        try:
            return np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        except KeyError:
            unknown = [w for w in dict.fromkeys(words) if w not in index]
        if len(index) + len(unknown) > CACHE_WORDS:
            self.clear()
            index, unknown = self.index, list(dict.fromkeys(words))
        self.learn(unknown)
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([0, *map(len, texts)])
        return self.encode_bytes(np.frombuffer(b"".join(texts), np.uint8), ends)

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the n + 1 offsets of the texts.

        Words are dictionary-encoded in Arrow, so only the distinct ones become Python objects.
        """
        words = Words(data, offsets)
        if not len(words.starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        edges = np.stack([words.starts, words.ends], axis=1).ravel().astype(np.int32)  # words and gaps in turn
        spans = pa.Array.from_buffers(
            pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = spans.take(pa.array(np.arange(0, len(edges) - 1, 2))).dictionary_encode()
        at = self.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sizes = self.size[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.begin[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[words.first]


def word_ids(path: str) -> WordIds:
    """The worker's encoder; it hangs on the tokenizer library's module, so that it outlives a task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_word_ids", {})
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, text: str = "text") -> DataFrame:
    """One row per piece: the columns of ``docs`` but for the text, and ``piece, start, length, ids_crc32``.

    A document is its ids, then ``end_id``; NULL text is empty, so every
    document has a piece.  Only documents longer than ``capacity`` are cut.
    Existing columns of these names are replaced.
    """
    docs = docs.drop(*PIECES_SCHEMA.names)
    keep = [f.name for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*[docs.schema[c] for c in keep], *PIECES_SCHEMA.fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer_path)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            for first, end, data, offsets in chunks(batch.column(text), CHUNK_BYTES):
                ids, places = known.encode_bytes(data, offsets)
                ids = np.insert(ids, places[1:], np.uint32(end_id)).astype("<u4")
                places = places + np.arange(len(places))
                raw = memoryview(ids.tobytes())
                for i in range(end - first):
                    begin, stop = int(places[i]), int(places[i + 1])
                    for piece, start in enumerate(range(begin, stop, capacity)):
                        last = min(start + capacity, stop)
                        rows.append(first + i)
                        pieces.append(piece)
                        starts.append(start - begin)
                        lengths.append(last - start)
                        sums.append(zlib.crc32(raw[4 * start : 4 * last]))
            own = batch.select(keep).take(pa.array(rows)) if keep else None
            columns = [pa.array(pieces, pa.int32()), *[pa.array(x, pa.int64()) for x in (starts, lengths, sums)]]
            yield pa.RecordBatch.from_arrays([*(own.columns if keep else []), *columns], names=[*keep, *PIECES_SCHEMA.names])

    return docs.mapInArrow(cut, schema)


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows ``(length, first, last, sequence, each, offset)``.

    Pieces of a length with ranks ``first <= r < last`` go to sequence
    ``sequence + (r - first) // each`` at ``offset + (r - first) % each * length``.
    Sequences with the same room are kept as runs; the work grows with the
    number of lengths and runs, not of pieces.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, how many)
    plan: list[tuple[int, int, int, int, int, int]] = []
    opened = 0
    present = np.zeros(capacity + 1, bool)

    def give_back(room: int, first: int, many: int) -> None:
        if room > 0 and many > 0:
            runs.setdefault(room, []).append((first, many))
            present[room] = True

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fits = np.flatnonzero(present[length:])
            if len(fits):
                room = int(fits[0]) + length
                first, many = runs[room].pop()
                if not runs[room]:
                    present[room] = False
            else:
                each = capacity // length
                first, many, room = opened, -(-left // each), capacity
                opened += many
            each = room // length
            full = min(many, left // each)
            if full:
                plan.append((length, rank, rank + full * each, first, each, capacity - room))
                give_back(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            first, many = first + full, many - full
            if many and left and left < each:
                plan.append((length, rank, rank + left, first, left, capacity - room))
                give_back(room - left * length, first, 1)
                rank, left, first, many = rank + left, 0, first + 1, many - 1
            give_back(room, first, many)
    return plan


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) and their ``sequence_id`` and ``offset``.

    Only the histogram, at most ``capacity`` rows, reaches the driver.  Pieces
    of one length are interchangeable; ties of ``order`` may swap slots.  An
    empty table stays empty.  ``pieces`` is read twice: store it first.
    """
    spark = pieces.sparkSession
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.drop("sequence_id", "offset").withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    cells = stored(salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")), "length-cells")
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_best_fit(histogram, capacity),
        "_length long, _first long, _last long, _sequence long, _each long, _offset long",
    )
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    in_cell = W.partitionBy("length", "_salt").orderBy(*order)
    ranked = (
        salted.withColumn("_local", F.row_number().over(in_cell) - 1).join(starts, ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_local"))
    )
    step = F.col("_rank") - F.col("_first")
    slots = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_last"))
    return ranked.join(F.broadcast(plan), slots).select(  # the plan grows with the number of lengths only
        *[c for c in pieces.columns if c not in ("sequence_id", "offset")],
        (F.col("_sequence") + F.floor(step / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + step % F.col("_each") * F.col("length")).cast("long").alias("offset"),
    )
