"""Incremental ingest of landed game-log files with Structured Streaming.

The daily batch "pick up what landed, merge it into the warehouse" becomes a
file stream run with ``trigger(availableNow=True)``: each run processes every
file not yet seen (tracked in the checkpoint) and stops.  Each micro-batch is
parsed once into the shared scratch folder; malformed files and rows without
a whole key are set aside under the batch's number, and the other rows are
upserted into the keyed parquet table through the staged swap.  Re-applying a
batch after a failure gives the same table and the same rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import split_null_keys
from ..schemas import CORRUPT_COLUMN, GAME_LOG_PAYLOAD
from ..session import scratch_dir
from ..sinks.parquet import delete_path, upsert_partitioned, upsert_table
from ..sources import payloads as S

GAME_KEYS = ["playerId", "gameId"]


def game_log_batch(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(games_info rows, rejected files) of one batch of whole-file texts."""
    parsed = S.parse_payloads(batch, "_json", GAME_LOG_PAYLOAD)
    good, rejected = S.split_malformed(parsed, ["gameLog"])
    records = S.flatten_keyed_array(
        good, "gameLog", {"playerId": F.col(S.ENTITY_COLUMN).try_cast("bigint")}
    )
    return S.game_log_to_games_info(records), rejected.select(S.ENTITY_COLUMN, CORRUPT_COLUMN)


def start_game_log_ingest(
    spark: SparkSession,
    landing_dir: str,
    table_path: str,
    checkpoint_location: str,
    rejects_path: str | None = None,
    known_players: DataFrame | None = None,
    games_partition: tuple[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``query.awaitTermination()`` waits for the run to end.

    ``known_players`` (a DataFrame with ``playerId``) restricts the ingest to
    known keys with a semi-join, as the batch ingest does.
    ``games_partition=(column, sql_expr)`` merges each batch into a table
    partitioned by a function of the game id, rewriting only the partitions
    the batch touches; ``max_files_per_trigger`` bounds a batch's size.
    """
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    texts = (
        reader
        .load(landing_dir)
        .select(
            F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias(S.ENTITY_COLUMN),
            F.col("value").alias("_json"),
        )
    )

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        rows, rejected = game_log_batch(batch)
        rows, keyless = split_null_keys(rows, GAME_KEYS)
        if known_players is not None:
            rows = rows.join(known_players.select("playerId"), "playerId", "left_semi")
        if rejects_path is not None:
            keyless = keyless.select(
                F.col("playerId").cast("string").alias(S.ENTITY_COLUMN),
                F.to_json(F.struct("*")).alias(CORRUPT_COLUMN),
            )
            rejected.unionByName(keyless).write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/epoch={epoch_id}")
        landed = scratch_dir(session, f"batch-{epoch_id}")
        rows.write.parquet(landed)
        rows = session.read.parquet(landed)
        if games_partition is None:
            upsert_table(session, rows, table_path, GAME_KEYS)
        else:
            column, expr = games_partition
            upsert_partitioned(session, rows.withColumn(column, F.expr(expr)), table_path, GAME_KEYS, column)
        delete_path(session, landed)

    return (
        texts.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
