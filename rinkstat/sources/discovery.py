"""Fields that payloads hold beyond the declared schema.

Ingest reads payloads with a declared schema, so a field that the source adds
would vanish.  Here documents are parsed once as VARIANT: declared fields become
typed columns, all others of a record stay together in one VARIANT column, and
a report says which fields occur, how often and with which types.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRAS = "extras"


def records(docs: DataFrame, text: str, field: str, carry: Sequence[str] = ()) -> DataFrame:
    """``(carry..., record)``: every record of ``{field: [record, ...]}`` as ``map<string, variant>``.

    Malformed documents, documents without the field and elements that are no
    object have no record here; ``split_malformed`` counts the documents.
    """
    parsed = F.try_parse_json(F.col(text))
    listed = docs.select(*carry, F.explode(F.try_variant_get(parsed, f"$['{field}']", "array<variant>")).alias("_v"))
    return listed.select(*carry, F.try_variant_get("_v", "$", "map<string, variant>").alias("record")).filter("record IS NOT NULL")


def discovered_fields(rows: DataFrame, declared: T.StructType) -> DataFrame:
    """``(field, n_records, types, merged_type, declared)``: one row per field of ``records``.

    ``types`` are the kinds of values met, sorted (``VOID`` for JSON null),
    ``merged_type`` the one type that holds them all (``VARIANT`` if none does).
    Partial aggregates combine per task; the result is as small as the schema.
    """
    each = rows.select(F.explode("record").alias("field", "value"))
    kind = F.regexp_replace(F.schema_of_variant("value"), "<.*", "")
    return each.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.array_join(F.sort_array(F.collect_set(kind)), ",").alias("types"),
        F.schema_of_variant_agg("value").alias("merged_type"),
    ).withColumn("declared", F.col("field").isin(declared.names))


def extras(record: Column, declared: T.StructType) -> Column:
    """The undeclared fields of a record as one VARIANT object, NULL if there are none."""
    rest = F.map_filter(record, lambda name, _: ~name.isin(declared.names))
    return F.when(F.size(rest) > 0, F.call_function("to_variant_object", rest))


def typed_with_extras(rows: DataFrame, declared: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """``records`` as rows: ``carry``, the declared columns (NULL where absent or of another type) and ``extras``."""
    columns = [F.try_variant_get(F.col("record")[f.name], "$", f.dataType.simpleString()).alias(f.name) for f in declared.fields]
    return rows.select(*carry, *columns, extras(F.col("record"), declared).alias(EXTRAS))
