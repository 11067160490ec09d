"""Document fingerprints: invertible Bloom lookup sketches, with DataFrame functions only.

A text's paragraphs (lines, long ones in pieces of one size throughout, so that
every part of a text weighs the same) become keys: the hash of the paragraph and
of how often the text holds it.  A text's sketch is sized to its keys: they are
dealt by some of their bits to as many small tables as hold them, and each key goes
into one cell of each of the three parts of its table; a cell holds a count, the
XOR of its keys and the XOR of their check hashes.  Sketches of two sizes are
compared after adding up the larger one's tables to the number of the smaller.  Two
versions' tables are subtracted cell by cell, and peeling cells that hold one key
recovers the keys that differ.  A table that can't be peeled is retried larger:
its keys are dealt by more bits to as many tables as would hold all keys, and a
table that fails again is dealt to four.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Cells in each of the three parts of a table; two bits of a key name its cell in a part.
PART_CELLS = 4
PARTS = 3
#: Code points in a paragraph piece at most.
PIECE = 96
#: Keys per table of a text's sketch at most, on average; a sketch has a power of two of tables.
KEYS = 8
#: Keys of both texts per table for which the first retry makes room.
LOAD = 5
#: Growths until the bits of a key are used up.
LEVELS = (64 - 2 * PARTS) // 2
LONGS = "array<bigint>"
SIGNED = "array<struct<k:bigint,s:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def paragraph_keys(text: Column) -> Column:
    """The keys of a text, one per different paragraph piece; none for NULL or empty text."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^\\n]{{1,{PIECE}}}"), F.lit(0))
    hashes = F.array_sort(F.transform(pieces, lambda p: F.xxhash64(p)))

    def runs(h: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: (i == 0) | (F.get(h, i) != F.get(h, i - 1)))
        return let(first, lambda b: F.transform(
            b, lambda at, i: F.xxhash64(F.get(h, at), F.coalesce(F.get(b, i + 1), F.size(h)) - at)
        ))

    return let(hashes, lambda h: F.when(F.size(h) > 0, runs(h)).otherwise(F.array().cast(LONGS)))


def _bits(key: Column, shift: Column, mask: Column) -> Column:
    return F.call_function("shiftrightunsigned", key, shift).bitwiseAND(mask)


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(1))


def _cell(n: Column, k: Column, h: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), k.cast("long").alias("k"), h.cast("long").alias("h"))


#: Of every cell: the mask of the two key bits it looks at, and their value.
PLACES = [((PART_CELLS - 1) << (2 * part), value << (2 * part)) for part in range(PARTS) for value in range(PART_CELLS)]


def _places() -> Column:
    """``(mask, value)`` of every cell."""
    return F.array(*[
        F.struct(F.lit(m).cast("long").alias("mask"), F.lit(v).cast("long").alias("value")) for m, v in PLACES
    ])


def cells_of(keys: Column) -> Column:
    """The table of ``keys``: an array of cells ``(n, k, h)``."""
    def fill(place: Column) -> Column:
        own = F.filter(keys, lambda k: k.bitwiseAND(place["mask"]) == place["value"])
        zero = _cell(F.lit(0), F.lit(0), F.lit(0))
        return F.aggregate(own, zero, lambda a, k: _cell(a["n"] + 1, a["k"].bitwiseXOR(k), a["h"].bitwiseXOR(_check(k))))

    return F.transform(_places(), fill)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["h"].bitwiseXOR(y["h"])))


def peel(cells: Column) -> Column:
    """The signed keys of a subtracted table, or NULL if it can't be peeled whole.

    Every round empties a cell, so as many rounds as cells are enough.
    """
    empty = F.array().cast(SIGNED)

    def pure(state: Column) -> Column:
        alone = F.filter(state, lambda c: (F.abs(c["n"]) == 1) & (c["h"] == _check(c["k"])))
        return F.array_distinct(F.transform(alone, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("s"))))

    def without(state: Column, found: Column) -> Column:
        def clean(cell: Column, place: Column) -> Column:
            own = F.filter(found, lambda p: p["k"].bitwiseAND(place["mask"]) == place["value"])
            return F.aggregate(own, cell, lambda a, p: _cell(
                a["n"] - p["s"], a["k"].bitwiseXOR(p["k"]), a["h"].bitwiseXOR(_check(p["k"]))
            ))

        return F.zip_with(state, _places(), clean)

    def step(acc: Column, _: Column) -> Column:
        def go(found: Column) -> Column:
            return F.struct(
                F.when(F.size(found) > 0, without(acc["cells"], found)).otherwise(acc["cells"]).alias("cells"),
                F.concat(acc["keys"], found).alias("keys"), (F.size(found) > 0).alias("going"),
            )

        return F.when(acc["going"], let(pure(acc["cells"]), go)).otherwise(acc)

    start = F.struct(cells.alias("cells"), empty.alias("keys"), F.lit(True).alias("going"))
    rounds = F.sequence(F.lit(1), F.lit(PARTS * PART_CELLS + 1))

    def finish(acc: Column) -> Column:
        clear = F.forall(acc["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["h"] == 0))
        return F.when(clear, acc["keys"])

    return F.aggregate(rounds, start, step, finish)


def _number(key: Column, bits: Column) -> Column:
    """The table of ``key`` among ``2 ** bits``: the bits after those that name its cells."""
    return _bits(key, F.lit(2 * PARTS), F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)


def _log2_tables(n_keys: Column, load: int) -> Column:
    """The logarithm of the fewest tables that hold at most ``load`` keys each on average."""
    return F.ceil(F.log2(F.greatest(n_keys / load, F.lit(1.0)))).cast("int")


def sketch_of(keys: Column) -> Column:
    """The sketch of ``keys``: ``2 ** b`` tables, as many as hold at most ``KEYS`` keys each on average, in linear space."""
    bits = _log2_tables(F.size(keys), KEYS)
    last = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    marks = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda t: F.struct(t.alias("t"), F.lit(False).alias("own"), F.lit(0).cast("long").alias("k")))
    own = F.transform(keys, lambda k: F.struct(_number(k, bits).alias("t"), F.lit(True).alias("own"), k.alias("k")))

    def tables(r: Column) -> Column:
        def cut(begin: Column) -> Column:
            def one(at: Column, i: Column) -> Column:
                mine = F.slice(r, at + 2, F.coalesce(F.get(begin, i + 1), F.size(r)) - at - 1)
                return let(F.transform(mine, lambda e: e["k"]), cells_of)

            return F.transform(begin, one)

        return let(F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: ~F.get(r, i)["own"]), cut)

    return let(F.array_sort(F.concat(marks, own)), tables)


def folded(sketch: Column, tables: Column) -> Column:
    """``sketch`` with fewer tables (a power of two): the sum of those whose numbers agree in the last bits."""
    def one(t: Column) -> Column:
        rest = F.filter(F.sequence(t, F.size(sketch) - 1, tables), lambda i: i != t)
        add = lambda x, y: F.zip_with(x, y, lambda c, d: _cell(c["n"] + d["n"], c["k"].bitwiseXOR(d["k"]), c["h"].bitwiseXOR(d["h"])))
        return F.aggregate(rest, F.get(sketch, t), lambda acc, i: add(acc, F.get(sketch, i)))

    return F.when(F.size(sketch) == tables, sketch).otherwise(F.transform(F.sequence(F.lit(0), tables - 1), one))


def first_tables(sketch_a: Column, sketch_b: Column) -> Column:
    """The signed keys of each table of the smaller sketch, NULL where a subtracted table can't be peeled."""
    tables = F.least(F.size(sketch_a), F.size(sketch_b))
    return F.transform(F.zip_with(folded(sketch_a, tables), folded(sketch_b, tables), subtract), peel)


def _table(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _deal(a: Column, b: Column, bits: Column) -> Column:
    """The keys of both sides dealt to ``2 ** bits`` tables, without the empty ones, in linear space."""
    of = lambda keys, side: F.transform(keys, lambda k: F.struct(
        _number(k, bits).alias("t"), F.lit(side).alias("s"), k.alias("k")
    ))

    def tables(r: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: (i == 0) | (F.get(r, i)["t"] != F.get(r, i - 1)["t"]))

        def cut(begin: Column) -> Column:
            def one(at: Column, i: Column) -> Column:
                own = F.slice(r, at + 1, F.coalesce(F.get(begin, i + 1), F.size(r)) - at)
                side = lambda x, s: F.transform(F.filter(x, lambda e: e["s"] == s), lambda e: e["k"])
                return let(own, lambda x: _table(side(x, 1), side(x, -1)))

            return F.transform(begin, one)

        return let(first, cut)

    return let(F.array_sort(F.concat(of(a, 1), of(b, -1))), tables)


def differences(a: Column, b: Column, first: Column) -> Column:
    """The keys that only ``a`` holds (``s`` = 1) or only ``b`` (``s`` = -1), recovered from their sketches.

    ``first`` is a column of a DataFrame that holds their ``first_tables`` (it is
    used several times).  The keys of the tables that fail are dealt to more
    tables; if one still fails when all bits are used up, its keys are compared
    as sets.
    """
    def four(table: Column, shift: Column) -> Column:
        def part(v: Column) -> Column:
            own = lambda keys: F.filter(keys, lambda k: _bits(k, shift, F.lit(3)) == v)
            return _table(own(table["a"]), own(table["b"]))

        parts = F.transform(F.array(*[F.lit(v).cast("long") for v in range(4)]), part)
        return F.filter(parts, lambda t: (F.size(t["a"]) > 0) | (F.size(t["b"]) > 0))

    def step(acc: Column, _: Column) -> Column:
        tried = F.transform(acc["open"], lambda t: F.struct(t.alias("t"), peel(subtract(cells_of(t["a"]), cells_of(t["b"]))).alias("got")))

        def go(r: Column) -> Column:
            failed = F.filter(r, lambda x: x["got"].isNull())
            got = F.flatten(F.transform(F.filter(r, lambda x: x["got"].isNotNull()), lambda x: x["got"]))
            return F.struct(
                F.flatten(F.transform(failed, lambda x: four(x["t"], acc["shift"]))).alias("open"),
                F.concat(acc["keys"], got).alias("keys"), (acc["shift"] + 2).alias("shift"),
            )

        return F.when(F.size(acc["open"]) > 0, let(tried, go)).otherwise(acc)

    def finish(acc: Column) -> Column:
        def rest(t: Column) -> Column:
            signed = lambda keys, s: F.transform(keys, lambda k: F.struct(k.alias("k"), F.lit(s).alias("s")))
            return F.concat(signed(F.array_except(t["a"], t["b"]), 1), signed(F.array_except(t["b"], t["a"]), -1))

        return F.concat(acc["keys"], F.flatten(F.transform(acc["open"], rest)))

    had = _log2_tables(F.size(first), 1)
    bits = F.greatest(had + 1, _log2_tables(F.size(a) + F.size(b), LOAD))
    failed = lambda keys: F.filter(keys, lambda k: F.get(first, _number(k, had).cast("int")).isNull())
    got = F.flatten(F.filter(first, lambda x: x.isNotNull()))
    start = F.struct(_deal(failed(a), failed(b), bits).alias("open"), got.alias("keys"), (bits + 2 * PARTS).alias("shift"))
    tries = F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), start, step, finish)
    return F.when(F.exists(first, lambda x: x.isNull()), tries).otherwise(got)


def likeness(a: Column, b: Column, first: Column) -> Column:
    """1 minus the keys that differ over all keys; 1 for two empty texts."""
    every = F.size(a) + F.size(b)
    return F.when(every == 0, F.lit(1.0)).otherwise(1 - F.size(differences(a, b, first)) / every)


def fingerprint(sketch: Column) -> Column:
    """A text's sketch as text: tables divided by ``|``, cells by ``;``; equal texts have equal fingerprints."""
    cell = lambda c: F.concat_ws(":", c["n"].cast("string"), F.hex(c["k"]), F.hex(c["h"]))
    return F.array_join(F.transform(sketch, lambda t: F.array_join(F.transform(t, cell), ";")), "|")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """The number of the last of the sorted ``bounds`` that is not above ``key`` (NULL: the last range)."""
    if not bounds:
        return F.lit(0)
    step = isqrt(len(bounds) - 1) + 1
    listed = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast(LONGS)  # noqa: E731  one constant
    upto = lambda values: F.greatest(F.size(F.filter(values, lambda b: b <= key)), F.lit(1)) - 1
    inner = let(upto(listed(bounds[::step])), lambda i: i * step + upto(F.slice(listed(bounds), i * step + 1, F.lit(step))))
    return F.when(key.isNull(), F.lit(len(bounds) - 1)).otherwise(inner)


def in_ranges(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` dealt to ranges of the key (``_range``), with a copy of each range's first row behind the range before.

    In ``W.partitionBy("_range").orderBy("_copy", key, text)`` every row that is
    not a copy (``_copy``) is then followed by the next row of the whole table;
    the last by the first.  Only the ranges' first keys, four per shuffle
    partition, reach the driver.  The key is an integer; NULL keys come last.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(key).alias("_k")).filter("_k IS NOT NULL")
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = ids.repartitionByRange(ranges, "_k").groupBy(F.spark_partition_id()).agg(F.min("_k").alias("k"))
    bounds = sorted(r["k"] for r in firsts.collect())
    own = _range_of(F.col(key), bounds)
    before = F.pmod(own - 1, F.lit(max(1, len(bounds))))
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast(LONGS) if bounds else None
    is_first = F.get(listed, own) == F.col(key) if bounds else F.lit(True)
    place = F.struct(own.alias("_range"), F.lit(False).alias("_copy"))
    copy = F.struct(before.alias("_range"), F.lit(True).alias("_copy"))
    places = F.when(F.coalesce(is_first, F.lit(False)), F.array(place, copy)).otherwise(F.array(place))
    return docs.drop("_range", "_copy").withColumn("_p", F.explode(places)).select("*", "_p._range", "_p._copy").drop("_p")


def edited_and_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_chars, edited_sha256, keys, sketch)`` for every row of ``docs``, the keys and sketch of its
    edited text (``edited_``) and of the next document (``next_``), and the first tables of either comparison
    (``edited_first``, ``next_first``).

    The edited text has its last quarter replaced by as many first code points
    of the next document.  NULL text is empty.  Rows of one key follow each
    other by text.
    """
    order = W.partitionBy("_range").orderBy("_copy", F.col(key).asc_nulls_last(), text)
    keyed = W.partitionBy("_range").orderBy("_copy", F.col(key).asc_nulls_last(), "_at")
    rows = in_ranges(docs.select(key, F.coalesce(F.col(text), F.lit("")).alias(text)), key, text)
    quarter = F.floor(F.length(text) / 4).cast("int")
    rows = rows.withColumns({"_next": F.lead(text).over(order), "_at": F.row_number().over(order)})
    rows = rows.withColumn(
        "_edited", F.concat(F.substring(F.col(text), F.lit(1), F.length(text) - quarter), F.substring(F.col("_next"), F.lit(1), quarter))
    )
    rows = rows.select(
        key, "_range", "_copy", "_at", F.length(text).cast("long").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        paragraph_keys(F.col(text)).alias("keys"), paragraph_keys(F.col("_edited")).alias("edited_keys"),
    )
    rows = rows.withColumns({"sketch": sketch_of(F.col("keys")), "edited_sketch": sketch_of(F.col("edited_keys"))})
    after = {f"next_{c}": F.lead(c).over(keyed) for c in ("keys", "sketch")}
    rows = rows.withColumns(after).filter("NOT _copy").drop("_range", "_copy", "_at")
    return rows.withColumns({f"{o}_first": first_tables(F.col("sketch"), F.col(f"{o}_sketch")) for o in ("edited", "next")})
