"""Run one batch: ``spark-submit -m rinkstat <batch> [options]`` or
``python -m rinkstat <batch> [options]``.

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
executors and ``spark.checkpoint.dir`` are whatever spark-submit / the cluster
configures.  Any scheduler can call these once per run date.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import pipeline as PL


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="rinkstat")
    ap.add_argument("batch", choices=["teams", "players", "aggregates", "schedule", "publish"])
    ap.add_argument("--landing", help="landed JSON root")
    ap.add_argument("--raw", help="raw zone root")
    ap.add_argument("--dwh", required=True, help="warehouse root")
    ap.add_argument("--ds", help="run date YYYY-MM-DD")
    ap.add_argument("--num-files", type=int, default=None)
    ap.add_argument("--games-partition", nargs=2, metavar=("COLUMN", "SQL_EXPR"),
                    help="keep games_info partitioned, e.g. season 'CAST(gameId DIV 1000000 AS INT)'")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password")
    ap.add_argument("--jdbc-driver")
    ap.add_argument("--jdbc-connections", type=int, default=8)
    ap.add_argument("--dedupe-by", metavar="COLUMN", help="keep one roster row per player, e.g. updatedDt")
    args = ap.parse_args(argv)
    part = tuple(args.games_partition) if args.games_partition else None

    spark = SparkSession.builder.appName(f"rinkstat-{args.batch}").getOrCreate()
    if args.batch == "teams":
        PL.teams_batch(spark, args.landing, args.raw, args.dwh, args.ds)
    elif args.batch == "players":
        _, rejected = PL.players_batch(
            spark, args.landing, args.raw, args.dwh, args.ds, dedupe_by=args.dedupe_by, games_partition=part
        )
        rejected.groupBy("kind").count().show(truncate=False)
    elif args.batch == "aggregates" and part is not None:
        PL.refresh_mart(spark, args.dwh, part)
        PL.refresh_aggregates(spark, args.dwh, part, args.num_files)
    elif args.batch == "aggregates":
        PL.mart_and_aggregates(spark, args.dwh, args.num_files)
    elif args.batch == "schedule":
        PL.schedule_batch(spark, args.landing, args.raw, args.dwh, args.ds)
    elif args.batch == "publish":
        PL.publish(
            spark, args.dwh, args.jdbc_url, user=args.jdbc_user, password=args.jdbc_password,
            driver=args.jdbc_driver, games_partition=part, num_partitions=args.jdbc_connections,
        )
    return 0


if __name__ == "__main__":
    sys.exit(main())
