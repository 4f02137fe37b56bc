"""The whole run: source tables to wide tables, star schema and sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import AbstractContextManager, nullcontext
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import AsOf
from tillstar.operators.quality import flag_counts
from tillstar.operators.rules import transform
from tillstar.operators.sizes import LARGE_BYTES, estimated_bytes
from tillstar.plans.progress import Progress, files_version, fingerprint, layout_parts, rules_parts
from tillstar.plans.star import DIMENSIONS, FACTS, build_dimension, build_fact
from tillstar.plans.tables import TABLES
from tillstar.session import new_path, remove, scratch, shuffles_freed, side_by_side
from tillstar.sinks import jdbc, parquet
from tillstar.sources.calendar import build_dim_date
from tillstar.sources.csv import BAD_RECORD, file_inventory, read_csv
from tillstar.sources.schemas import SCHEMAS

ORDERS = "fact_orders"


def run_pipeline(
    spark: SparkSession,
    source: str | Mapping[str, DataFrame],
    root: str,
    as_of: AsOf = AsOf(),
    dim_date: DataFrame | None = None,
    database: jdbc.Database | None = None,
    bad_records: int = 0,
    facts_partitioned_by: Mapping[str, Sequence[str]] = {},
    by_quotes: bool = False,
    skip_corrupt: bool = False,
    version: str | None = None,
    resume: bool = False,
    use_up: bool = False,
) -> DataFrame:
    """Build everything under ``root`` and return rows (table_name, metric, value).

    ``source`` is the folder of the twelve CSV files, or the tables themselves.
    Each table is written once and read back by whatever is built from it, so
    nothing is computed twice: dimensions and facts scan only the wide columns
    they hold, and the facts that need order keys read two columns of the
    written order fact.  Row and flag counts come out of the writes.

    CSV files are parsed once each, into Parquet that goes when the wide table is
    written.  They are read in splits, without line breaks in fields; with
    ``by_quotes`` fields may hold some.  With ``skip_corrupt`` broken files are
    left out, and the run tells how many and which (``files_left_out``,
    ``files_in_part``, and a metric of 1 with the name of each).  More than
    ``bad_records`` bad records in a table are an error once it is written.
    ``facts_partitioned_by`` lays facts out by columns, such as ``fact_orders`` by
    ``order_year`` and ``order_month`` (added then from its date).

    Every table of a folder that is finished gets a record of what it was made
    from: files, rules, layout, and the tables it was built on.  With ``resume``
    a table whose record says the same is taken over as it is, so a run that
    broke off goes on where it stopped, and one after a change builds what
    follows from it.  Tables given as such are recorded if ``version`` names
    their content.

    Disk: shuffle files go with the write that made them, a table's keys and ids
    on their way with the table, and of tables of more than ``LARGE_BYTES`` one
    is built at a time.  With ``use_up`` a CSV file, or folder of files, is
    removed as soon as its wide table is finished, for folders made for the run.
    """
    folder = source.rstrip("/") if isinstance(source, str) else None
    progress = Progress(spark, root, resume)
    versions: dict[str, str] = {}
    wide: dict[str, DataFrame] = {}
    star: dict[str, DataFrame] = {}
    rows_of: dict[str, int] = {}
    large = Lock()

    def alone(*tables: DataFrame) -> AbstractContextManager:
        """Large tables wait for each other: what they hold on disk meanwhile does not add up."""
        return large if sum(map(estimated_bytes, tables)) > LARGE_BYTES else nullcontext()

    def keep(
        name: str, parts: Sequence, path: str, into: dict[str, DataFrame], build: Callable[[], tuple[dict[str, int], DataFrame]]
    ) -> dict[str, int]:
        """Build, write and record a table, or take it over."""
        recorded = None not in parts
        label = f"wide_{name}" if into is wide else name
        versions[label] = fingerprint(*parts) if recorded else None
        found = progress.take(label, versions[label], path)
        if found and recorded:
            into[name] = found.table
            return found.counts
        counts, written = build()
        into[name] = written
        if recorded:
            progress.put(label, versions[label], counts, written.schema)
        return counts

    def keep_wide(name: str) -> dict[str, int]:
        rules, path = TABLES[name], parquet.wide_path(root, name)
        made_from = folder and f"{folder}/{name}.csv"
        told = files_version(spark, made_from) if made_from else version

        def build() -> tuple[dict[str, int], DataFrame]:
            with scratch(spark):  # the rows as read, and what repeats in them, go once the table is written
                given = csv_rows(name, made_from) if made_from else source[name]
                with alone(given):
                    if made_from:
                        before, rows = parsed(name, given)
                        df = transform(rows, rules, as_of)
                        counts = parquet.load_wide(df, root, name, flag_counts(rules.flag_names()))
                    else:
                        seen, rows = Observation(), given
                        counted = [F.count(F.lit(1)).alias("rows_initial"), F.lit(0).cast("bigint").alias("bad_records")]
                        if BAD_RECORD in rows.columns:
                            counted[1] = F.count(BAD_RECORD).alias("bad_records")
                        df = transform(rows.observe(seen, *counted).drop(BAD_RECORD), rules, as_of)
                        counts = parquet.load_wide(df, root, name, flag_counts(rules.flag_names()))
                        # Where no row is left, Spark replaces the plan, and what was observed in it is lost.
                        before = seen.get if counts["rows"] else rows.agg(*counted).first().asDict()
            counts |= row_counts(before, counts["rows"])
            if made_from and skip_corrupt:
                counts |= left_out(made_from)
            return counts, spark.read.schema(df.schema).parquet(path)

        counts = keep(name, [told, rules_parts(rules, as_of), by_quotes, skip_corrupt], path, wide, build)
        if made_from and use_up:
            remove(spark, made_from)
        return counts

    def csv_rows(name: str, path: str) -> DataFrame:
        how = {"multi_line": False, "keep_bad": True, "by_quotes": by_quotes, "skip_corrupt": skip_corrupt}
        return read_csv(spark, path, SCHEMAS[name], **how)

    def parsed(name: str, rows: DataFrame) -> tuple[dict[str, int], DataFrame]:
        """A table's CSV as Parquet, and its rows and bad records: cleaning and flags read the rows several times."""
        held = new_path(spark, f"read-{name}")
        seen = parquet.write_parquet(rows, held, observe=[F.count(BAD_RECORD).alias("bad_records")])
        stored = spark.read.schema(rows.schema).parquet(held).drop(BAD_RECORD)
        return {"rows_initial": seen["rows"], "bad_records": seen["bad_records"]}, stored

    def row_counts(seen: dict[str, int], rows: int) -> dict[str, int]:
        if seen["bad_records"] > bad_records:
            raise ValueError(f"{seen['bad_records']} bad records, {bad_records} are allowed")
        removed = seen["rows_initial"] - rows
        return seen | {"rows_cleaned": rows, "rows_final": rows, "duplicates_removed": removed}

    def left_out(path: str) -> dict[str, int]:
        broken = file_inventory(spark, path).filter("state <> 'read'").collect()  # a row a broken file
        counts = {f"files_{s.replace(' ', '_')}": sum(f.state == s for f in broken) for s in ("left out", "in part")}
        return counts | {f"{f.state}: {f.file.rsplit('/', 1)[-1]}": 1 for f in broken}

    def keep_dimension(name: str) -> dict[str, int]:
        path = parquet.dimension_path(root, name)

        def build() -> tuple[dict[str, int], DataFrame]:
            built_on = [wide[DIMENSIONS[name].table]] if name in DIMENSIONS else []
            with alone(*built_on), scratch(spark):  # its rows in key order go once it is written
                if name == "dim_date":
                    df = build_dim_date(spark) if dim_date is None else dim_date
                else:
                    df = build_dimension(name, wide[DIMENSIONS[name].table])
                counts = parquet.load_dimension(df, root, name)
            return counts, spark.read.schema(df.schema).parquet(path)

        if name == "dim_date":  # small, and given as a table that has no version
            counts = keep(name, [None], path, star, build)
            days = star[name].agg(F.min("date"), F.max("date")).first()
            versions[name] = fingerprint(counts["rows"], *days)
            return counts
        layout = DIMENSIONS[name]
        return keep(name, [versions[f"wide_{layout.table}"], layout_parts(layout)], path, star, build)

    def keep_fact(name: str) -> dict[str, int]:
        path, layout = parquet.fact_path(root, name), FACTS[name]
        laid_out = list(facts_partitioned_by.get(name, ()))

        def build() -> tuple[dict[str, int], DataFrame]:
            with alone(wide[layout.table]), scratch(spark):  # so do ids and keys on their way
                df = build_fact(name, wide[layout.table], star, rows_of=rows_of)
                if name == ORDERS and laid_out:
                    day = F.col("order_date")
                    parts = {"order_year": F.year(day), "order_month": F.month(day)}
                    df = df.withColumns({c: parts[c] for c in laid_out if c in parts})
                counts = parquet.load_fact(df, root, name, laid_out)
            return counts, spark.read.schema(df.schema).parquet(path)

        built_on = [versions[k.dimension] for k in layout.lookups]
        counts = keep(name, [versions[f"wide_{layout.table}"], *built_on, layout_parts(layout), laid_out], path, star, build)
        rows_of[name] = counts["rows"]
        star[name] = star[name].drop("order_year", "order_month")
        return counts

    with shuffles_freed(spark):  # all that stays is under ``root``
        loaded = side_by_side(keep_wide, TABLES)
        written = {f"wide_{name}": counts for name, counts in loaded.items()}
        written |= side_by_side(keep_dimension, ["dim_date", *DIMENSIONS])
        rows_of |= {name: written[name]["rows"] for name in ["dim_date", *DIMENSIONS]}
        written |= side_by_side(keep_fact, [ORDERS])
        written |= side_by_side(keep_fact, [name for name in FACTS if name != ORDERS])

    if database is not None:
        dimensions = {n: df for n, df in star.items() if n.startswith("dim_")}
        facts = {n: df for n, df in star.items() if n in FACTS}
        for name, rows in jdbc.load_warehouse(dimensions, facts, database).items():
            written[name] = written[name] | {"database_rows": rows}

    rows = [
        (table, metric, int(value))
        for table, metrics in written.items()
        for metric, value in metrics.items()
    ]
    return spark.createDataFrame(rows, "table_name string, metric string, value bigint")
