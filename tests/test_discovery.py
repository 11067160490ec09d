"""Undeclared payload fields are reported and kept."""

import json

from rinkstat.operators.merge import union_by_name
from rinkstat.schemas import TEAM_RECORD
from rinkstat.sources import discovery as SD


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc int, json string")


PAYLOADS = (
    '{"data":[{"id":1,"fullName":"A","triCode":"AAA"},{"id":2,"fullName":"B","triCode":"BBB","venue":7}]}',
    '{"data":[{"id":"x","venue":"big","arena":{"seats":[1,2],"name":null}},{"id":3,"venue":null}, 5, null]}',
    '{"data":[{"id":4,"we.ird \'na\\"me":true}],"total":1}',
    '{"error":"not found"}', '{"data":[{"id":', "", None, "[]", '{"data":{}}',
)


def test_fields_are_reported(spark):
    got = {r.field: r for r in SD.discovered_fields(SD.records(docs(spark, *PAYLOADS), "json", "data"), TEAM_RECORD).collect()}
    assert {f: (r.n_records, r.types, r.declared) for f, r in got.items()} == {
        "id": (5, "BIGINT,STRING", True), "fullName": (2, "STRING", True), "triCode": (2, "STRING", True),
        "venue": (3, "BIGINT,STRING,VOID", False), "arena": (1, "OBJECT", False), "we.ird 'na\"me": (1, "BOOLEAN", False),
    }
    assert got["id"].merged_type == "VARIANT" and got["arena"].merged_type == "OBJECT<name: VOID, seats: ARRAY<BIGINT>>"


def test_extras_are_kept(spark):
    rows = SD.typed_with_extras(SD.records(docs(spark, *PAYLOADS), "json", "data", ["doc"]), TEAM_RECORD, ["doc"])
    assert rows.columns == ["doc", "id", "fullName", "triCode", "extras"]
    got = sorted(
        ((r.doc, r.id, r.fullName, json.loads(r.extras) if r.extras else None) for r in rows.selectExpr("doc", "id", "fullName", "to_json(extras) AS extras").collect()),
        key=repr,
    )
    assert got == sorted([
        (0, 1, "A", None), (0, 2, "B", {"venue": 7}), (1, None, None, {"arena": {"seats": [1, 2], "name": None}, "venue": "big"}),
        (1, 3, None, {"venue": None}), (2, 4, None, {"we.ird 'na\"me": True}),
    ], key=repr)


def test_merges_with_the_stored_table(spark, tmp_path):
    """Rows with extras merge by name with a table written before there were any."""
    old = spark.createDataFrame([(8, "Old", "OLD")], TEAM_RECORD)
    new = SD.typed_with_extras(SD.records(docs(spark, *PAYLOADS), "json", "data"), TEAM_RECORD)
    path = str(tmp_path / "teams")
    union_by_name(new, old).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.count() == 6 and back.filter("extras IS NOT NULL").count() == 4
    assert [r.v for r in back.selectExpr("try_variant_get(extras, '$.venue', 'int') AS v").filter("v IS NOT NULL").collect()] == [7]


def test_no_documents(spark):
    rows = SD.records(docs(spark, "{}"), "json", "data")
    assert SD.discovered_fields(rows, TEAM_RECORD).count() == 0 and SD.typed_with_extras(rows, TEAM_RECORD).count() == 0
