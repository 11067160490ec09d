"""Named SQL functions registered in the session.

They are SQL UDFs (``CREATE TEMPORARY FUNCTION .. RETURN <expr>``): Catalyst
inlines the body, so no Python worker runs and code generation is kept.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalar import TOI_PATTERN

TOI_SECONDS_SQL = f"""
CREATE OR REPLACE TEMPORARY FUNCTION {{name}}(t STRING)
RETURNS INT
RETURN CASE WHEN t RLIKE '{TOI_PATTERN}'
            THEN try_add(try_multiply(try_cast(substring_index(t, ':', 1) AS INT), 60),
                         try_cast(substring_index(t, ':', -1) AS INT))
       END
"""


def register_toi_seconds(spark: SparkSession, name: str = "toi_seconds") -> str:
    spark.sql(TOI_SECONDS_SQL.format(name=name))
    return name
