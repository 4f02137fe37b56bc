"""Run the whole job: ``python -m tillstar --source CSV_FOLDER --root OUTPUT``."""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import SparkSession

from tillstar.functions import AsOf
from tillstar.plans.pipeline import run_pipeline
from tillstar.session import get_session
from tillstar.sinks.jdbc import Database
from tillstar.sources.calendar import FIRST_DATE, LAST_DATE, build_dim_date


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillstar", description=__doc__)
    parser.add_argument("--source", required=True, help="folder of the twelve CSV files")
    parser.add_argument("--root", required=True, help="folder to write to")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="the day taken as today")
    parser.add_argument("--first-date", default=FIRST_DATE)
    parser.add_argument("--last-date", default=LAST_DATE)
    parser.add_argument(
        "--multi-line",
        action="store_true",
        help="fields may hold line breaks; files are then cut into records by their quotes",
    )
    parser.add_argument(
        "--bad-records", type=int, default=0, help="records of a table that may be unreadable in part"
    )
    parser.add_argument("--skip-corrupt", action="store_true", help="leave out unreadable files, and tell which")
    parser.add_argument("--resume", action="store_true", help="take over the tables that an earlier run has finished")
    parser.add_argument("--jdbc-url", help="also load dimensions and facts into this database")
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    parser.add_argument("--jdbc-user", help="the password is read from TILLSTAR_JDBC_PASSWORD")
    given = parser.parse_args(arguments)

    database = None
    if given.jdbc_url:
        login = {
            "driver": given.jdbc_driver,
            "user": given.jdbc_user,
            "password": os.environ.get("TILLSTAR_JDBC_PASSWORD"),
        }
        database = Database(given.jdbc_url, {k: v for k, v in login.items() if v})

    shared = SparkSession.getActiveSession() is not None  # someone else's: theirs to stop
    spark = get_session()
    try:
        dates = build_dim_date(spark, given.first_date, given.last_date)
        written = run_pipeline(
            spark,
            given.source,
            given.root,
            AsOf(given.as_of),
            dates,
            database,
            given.bad_records,
            by_quotes=given.multi_line,
            skip_corrupt=given.skip_corrupt,
            resume=given.resume,
        )
        written.orderBy("table_name", "metric").show(written.count(), truncate=False)
    finally:
        if not shared:
            spark.stop()


if __name__ == "__main__":
    main()
