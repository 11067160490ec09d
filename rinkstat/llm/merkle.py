"""Merkle manifest of a dataset, its proofs found by pointer jumping.

Rows become leaves.  Within a group the leaves are numbered by a key; every
``ARITY`` consecutive nodes become their parent until one is left, the group's
subroot.  Subroots, in the order of their groups, are the leaves of a top tree,
whose last node is the root.

Every run of siblings is a row of one table.  A node's segment is its siblings
to the left and to the right, and a pointer to its parent.  The table of nodes
is joined with itself: a node's pointer jumps to where its ancestor points, and
the ancestor's segment is appended, so the distance covered doubles and a tree
of height h needs log2(h) joins.  Leaves of a run share all that lies above, so
their common parent jumps for them and each leaf takes its parent's finished
segments in a last join.

Numbers come from ranges of (group, key) and one count per range and group, so
neither a hot group nor equal keys gather in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

ARITY = 8
_TOP = -1  # number of the top tree


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as text: ``-`` for NULL, else its UTF-8 byte count, ``:`` and the value."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def _joined(raws: Column) -> Column:
    """The hex texts of an array of digests, one after the other."""
    return F.concat_ws("", F.transform(raws, _hex))


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``_place`` (0, 1, ... within ``group`` by ``order``, NULLs first) and ``_size``, the group's rows."""
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())  # splits ranges of equal rows
    dealt = spread.repartitionByRange(group, *order, "_tie").sortWithinPartitions(group, *order, "_tie")
    dealt = stored(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "merkle-ranges")
    # The range number is in the upper bits; the rows of a group within a range are consecutive.
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    runs = stored(dealt.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")), "merkle-runs")
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = stored(
        runs.select(
            F.col(group).alias("_group"), F.col("_range").alias("_r"),
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(W.partitionBy(group)).alias("_size"),
        ),
        "merkle-starts",
    )
    return (
        dealt.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_r")))
        .withColumn("_place", F.col("_at") + F.col("_shift")).drop("_group", "_r", "_shift", "_at", "_range")
    )


def _runs(nodes: DataFrame, level: int, arity: int) -> DataFrame:
    """``(tree, level, run, kids, many)``: the runs of ``nodes (tree, place, hash, many)``; only trees of several nodes go on."""
    kids = F.sort_array(F.collect_list(F.struct("place", "hash")))
    return stored(
        nodes.filter("many > 1").groupBy("tree", F.expr(f"place div {arity}").alias("run"))
        .agg(F.transform(kids, lambda k: k["hash"]).alias("kids"), F.first("many").alias("many"))
        .select("tree", F.lit(level).alias("level"), "run", "kids", "many"),
        "merkle-level",
    )


def _grown(leaves: DataFrame, arity: int) -> tuple[DataFrame, DataFrame]:
    """All runs of the trees over ``leaves (tree, place, hash, many)``, and each tree's last node ``(tree, level, hash)``."""
    spark = leaves.sparkSession
    most = leaves.agg(F.max("many")).first()[0] or 0
    nodes, level, tables = leaves, 0, []
    last = [nodes.filter("many = 1").select("tree", F.lit(0).alias("level"), "hash")]
    while most > 1:
        runs = _runs(nodes, level, arity)
        tables.append(runs)
        level, most = level + 1, -(-most // arity)
        nodes = runs.select(
            "tree", F.col("run").alias("place"), F.unhex(digest(_joined(F.col("kids")))).alias("hash"),
            F.ceil(F.col("many") / arity).cast("long").alias("many"),
        )
        last.append(nodes.filter("many = 1").select("tree", F.lit(level).alias("level"), "hash"))
    empty = spark.createDataFrame([], "tree long, level int, run long, kids array<binary>, many long")

    def union(frames: list[DataFrame], start: DataFrame) -> DataFrame:
        for f in frames:
            start = start.unionByName(f)
        return start

    return union(tables, empty), union(last[1:], last[0])


def _others(kids: Column, place: Column) -> Column:
    """The segment ``(left, right)``: the digests before and after number ``place`` of a run, as bytes."""
    bytes_of = lambda part: F.aggregate(part, F.lit(b""), lambda a, b: F.concat(a, b))
    return F.struct(
        bytes_of(F.slice(kids, F.lit(1), place)).alias("left"), bytes_of(F.slice(kids, place + 2, F.size(kids))).alias("right")
    )


def _jumped(nodes: DataFrame) -> DataFrame:
    """``nodes (tree, level, place, up, path)`` after jumping until no pointer leads on.

    ``up`` is the node pointed to, NULL beyond the root, ``path`` the segments up to there.
    """
    while True:
        on = nodes.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        nodes = stored(
            nodes.join(on, F.col("up") == F.col("_id"), "left").select(
                "id", F.col("_up").alias("up"), F.concat("path", F.coalesce("_path", F.array().cast(nodes.schema["path"].dataType))).alias("path")
            ),
            "merkle-jumps",
        )
        if nodes.filter("up IS NOT NULL").isEmpty():
            return nodes.select("id", "path")


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its segments."""
    return F.aggregate(path, start, lambda h, s: digest(_hex(s["left"]), h, _hex(s["right"])))


def manifest(
    docs: DataFrame, leaf: Column, tampered: Column | None = None, group: str = "lang", key: str = "doc_id", arity: int = ARITY,
) -> DataFrame:
    """``(<key>, leaf, subroot, root, path, folded_root, verified)``, one row per row of ``docs``.

    ``leaf`` is the leaf's digest (lower-case hex), ``tampered`` one to test the
    proof with (NULL: the leaf itself).  Leaves of a group are ordered by ``key``
    (NULL first), then by digest; groups by UTF-8 bytes, NULL first and apart
    from the empty text.  ``path`` holds the siblings ``(left, right)`` of each
    level, as bytes, from the leaf up; a node without siblings has empty ones.
    Repeated rows are leaves of their own.  NULLs in other columns are the
    caller's matter (``field`` tells them from texts).  Columns other than
    ``group`` and ``key`` aren't kept, so names can't clash.  An empty table has
    no leaf and gives no row.
    """
    if arity < 2:
        raise ValueError("a node needs two children at least")
    tampered = F.lit(None).cast("string") if tampered is None else tampered
    rows = docs.select(
        F.col(key).alias("_key"), F.col(group).alias("_tree"), F.unhex(leaf).alias("hash"), F.unhex(tampered).alias("_tampered")
    )
    placed = numbered(rows, "_tree", "_key", "hash")
    trees = stored(numbered(rows.select("_tree", F.lit(0).alias("_one")).distinct(), "_one", "_tree").select(
        F.col("_tree").alias("_name"), F.col("_place").alias("tree")), "merkle-trees")
    leaves = stored(
        placed.join(trees, F.col("_tree").eqNullSafe(F.col("_name"))).select(
            "tree", F.col("_place").alias("place"), F.col("_size").alias("many"), "hash", "_key", "_tampered"
        ),
        "merkle-leaves",
    )
    runs, last = _grown(leaves.select("tree", "place", "hash", "many"), arity)
    last = stored(last, "merkle-subroots")
    tops = last.select(F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "hash")
    n_trees = tops.count()
    top_runs, top = _grown(tops.withColumn("many", F.lit(n_trees).cast("long")), arity)
    runs = stored(runs.unionByName(top_runs), "merkle-runs-all")
    root = top.select(_hex(F.col("hash"))).first()  # one digest

    # A run is the node above its kids: of its own tree, or, as a subroot, of the top tree.
    name = lambda tree, level, place: F.struct(tree.alias("tree"), level.alias("level"), place.alias("place"))
    is_last = F.col("many") <= arity
    in_top = F.col("tree") == _TOP
    up_tree = F.when(is_last & ~in_top, F.lit(_TOP)).otherwise(F.col("tree")).cast("long")
    up_level = F.when(is_last & ~in_top, F.lit(0)).otherwise(F.col("level") + 1)
    at = F.when(is_last & ~in_top, F.col("tree")).otherwise(F.col("run"))
    whole = runs.select(
        name(F.col("tree"), F.col("level"), F.col("run")).alias("id"),
        name(up_tree, up_level, F.floor(at / arity).cast("long")).alias("up"), (at % arity).cast("int").alias("_i"),
    )
    # Lone leaves are subroots without a run of their own.
    lone = last.filter("level = 0").select(
        name(F.col("tree"), F.lit(-1), F.lit(0).cast("long")).alias("id"),
        name(F.lit(_TOP).cast("long"), F.lit(0), F.floor(F.col("tree") / arity).cast("long")).alias("up"),
        (F.col("tree") % arity).cast("int").alias("_i"),
    )
    above = runs.select(name(F.col("tree"), F.col("level"), F.col("run")).alias("_id"), "kids")
    none = F.array().cast("array<struct<left: binary, right: binary>>")
    nodes = whole.unionByName(lone).join(above, F.col("up") == F.col("_id"), "left").select(
        "id", F.when(F.col("kids").isNotNull(), F.col("up")).alias("up"),
        F.when(F.col("kids").isNotNull(), F.array(_others(F.col("kids"), F.col("_i")))).otherwise(none).alias("path"),
    )
    paths = _jumped(stored(nodes, "merkle-nodes"))

    # The last join: every leaf with the run above it and that run's path.
    ready = stored(
        paths.join(above.withColumnRenamed("_id", "id"), "id", "left")
        .join(last.select(F.col("tree").alias("_t"), _hex(F.col("hash")).alias("subroot")), F.col("id.tree") == F.col("_t"), "left")
        .filter(f"id.tree <> {_TOP} AND id.level <= 0").select("id", "kids", "path", "subroot"),
        "merkle-paths",
    )
    run = F.when(F.col("many") > 1, name(F.col("tree"), F.lit(0), F.floor(F.col("place") / arity).cast("long"))).otherwise(
        name(F.col("tree"), F.lit(-1), F.lit(0).cast("long"))
    )
    own = F.array(_others(F.col("kids"), (F.col("place") % arity).cast("int")))
    proved = (
        leaves.withColumn("_run", run).join(ready, F.col("_run") == F.col("id"))
        .select(
            F.col("_key").alias(key), _hex(F.col("hash")).alias("leaf"), "subroot", F.lit(root[0] if root else None).alias("root"),
            F.when(F.col("kids").isNotNull(), F.concat(own, F.col("path"))).otherwise(F.col("path")).alias("path"),
            _hex(F.coalesce("_tampered", "hash")).alias("_start"),
        )
    )
    return proved.withColumn("folded_root", folded(F.col("_start"), F.col("path"))).drop("_start").withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def proof_sha256(path: Column) -> Column:
    """Digest of a path's siblings, level by level, left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"])))))
