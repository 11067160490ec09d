"""Tables whose texts are all NULL or empty, through every operator that reads texts."""

import pytest
from pyspark.sql import functions as F

from rinkstat.llm import decision_rules, near_dup, packing, secrets, site_quality, substring, version_sketch

from .data import frame
from .test_packing import PATH

ROWS = [(1, None, None, None, None), (2, "", None, None, 0), (None, None, None, None, None)]
LABELS = "doc_id long, quality int, toxic int"
OPERATORS = {
    "rules": lambda s, d: decision_rules.quality_rules(d, s.createDataFrame([(1, 0, 0), (2, 1, 0)], LABELS)),
    "substring": lambda s, d: substring.dedup_substrings(d),
    "sketch": lambda s, d: version_sketch.edited_and_next(d),
    "sites": lambda s, d: site_quality.classify(d, s.createDataFrame([(1, 0, 0), (2, 1, 0)], LABELS)),
    "near": lambda s, d: near_dup.near_duplicates(d),
    "pieces": lambda s, d: packing.pack(packing.token_pieces(d, PATH)),
    "secrets": lambda s, d: secrets.scan(d).drop("secret_spans"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_each_row_comes_back(spark, name):
    got = OPERATORS[name](spark, frame(spark, ROWS).withColumn("extra", F.lit(1))).collect()
    assert sorted((r.doc_id for r in got), key=repr) == [1, 2, None]
