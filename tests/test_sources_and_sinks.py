"""CSV in, calendar, Parquet and JDBC out, the whole run."""

from __future__ import annotations

import datetime as dt
import gzip
import random
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oracle import DATA
from tillstar import session
from tillstar.__main__ import main
from tillstar.plans import pipeline
from tillstar.plans.pipeline import run_pipeline
from tillstar.plans.star import DIMENSIONS, FACTS
from tillstar.plans.tables import TABLES
from tillstar.sinks import jdbc, parquet
from tillstar.sources.calendar import build_dim_date
from tillstar.sources.csv import extract_all, file_inventory, read_csv
from tillstar.sources.schemas import SCHEMAS
from tillstar.verify import queries as registered
from tillstar.verify.bindings import source_table

SF = str(DATA / "sf0.001")
MEMORY = jdbc.Database(
    "jdbc:derby:memory:tests;create=true",
    {"driver": "org.apache.derby.jdbc.EmbeddedDriver"},
    connections=2,
)


def test_csv_keeps_signs_zeros_quotes_and_line_breaks(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text(
        'phone,id,note,barcode\n+919876543210,1,"say ""hi""\nthen go",0012345678905\n,2,,\n'
    )
    rows = read_csv(spark, str(file), "id BIGINT, phone STRING, barcode STRING").collect()
    assert rows[0].asDict() == {
        "phone": "+919876543210",
        "id": 1,
        "note": 'say "hi"\nthen go',
        "barcode": "0012345678905",
    }
    assert rows[1].phone is None and rows[1].id == 2


def test_csv_problems_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none.csv"), "id BIGINT")
    file = tmp_path / "t.csv"
    file.write_text("id\n1\n")
    with pytest.raises(ValueError, match="name"):
        read_csv(spark, str(file), "id BIGINT, name STRING")


def test_headers_are_checked_in_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,first,last\n1,Ann,Lee\n")
    (tmp_path / "b.csv").write_text("id,last,first\n2,Ray,Bob\n")
    for multi_line in (True, False):
        rows = read_csv(spark, str(tmp_path), "id BIGINT, first STRING, last STRING", multi_line=multi_line)
        with pytest.raises(Exception, match="header|Header"):
            rows.collect()


def test_bad_records_are_errors_or_kept(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text(
        "id,day,at,amount,ok,n\n12.0,2024-05-01,2024-05-01 10:00:00,1.5,TRUE,41.0\n"
        "x,05/01/2024,2024-05-01,1e3,maybe,4.5\n3,,,,,\n4,2024-05-01,2024-05-01,1,true\n"
        '5,"",2024-05-01,2,false,1,extra\n'
    )
    schema = "id BIGINT, day DATE, at TIMESTAMP, amount DOUBLE, ok BOOLEAN, n INT"
    for multi_line in (True, False):
        with pytest.raises(Exception, match="bad record in .*t.csv"):
            read_csv(spark, str(file), schema, multi_line).select("amount").collect()
        rows = read_csv(spark, str(file), schema, multi_line, keep_bad=True).collect()
        good, odd, empty, short, long = rows
        assert (good.id, good.day, good.amount, good.ok, good.n) == (12, dt.date(2024, 5, 1), 1.5, True, 41)
        assert good._bad_record is None and empty._bad_record is None and empty.id == 3
        assert odd.amount == 1000.0 and odd.id is odd.day is odd.ok is odd.n is None
        assert odd._bad_record == "id=x; day=05/01/2024; ok=maybe; n=4.5"
        assert short.id == 4 and "4,2024-05-01" in short._bad_record
        assert "extra" in long._bad_record


def test_the_test_for_bad_records_computes_no_value_again(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("id,amount\n12.0,1.5\n,\n")
    rows = read_csv(spark, str(file), "id BIGINT, amount DOUBLE", multi_line=False)
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_cast") == 3, text  # id as it is and without .0, amount
    assert [tuple(r) for r in rows.collect()] == [(12, 1.5), (None, None)]


def test_extract_all_parses_once_and_tells_nulls_and_empty_tables(spark, monkeypatch):
    text = registered.extract_tables(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in text
    df = spark.createDataFrame([(1, None, 0.0, True), (1, "a", -0.0, False), (None, "a", 1.5, None)], "a int, b string, c double, d boolean")
    told = {k: v for one in registered.different_values(df) for k, v in one.first().asDict().items()}
    assert told == {"different a": 1, "different b": 1, "different c": 2, "different d": 2}
    told = {k: v for one in registered.different_values(df.limit(0)) for k, v in one.first().asDict().items()}
    assert set(told.values()) == {0} and len(told) == 4


def test_a_run_parses_every_file_once(spark, tmp_path, monkeypatch):
    scans = []
    plain = parquet.write_parquet

    def write_parquet(df, path, *args, **also):
        scans.append(df._jdf.queryExecution().optimizedPlan().toString().count(" csv"))
        return plain(df, path, *args, **also)

    monkeypatch.setattr(parquet, "write_parquet", write_parquet)
    run_pipeline(spark, registered.csv_folder(spark, SF), str(tmp_path / "run"), registered.AS_OF)
    assert sum(scans) == len(TABLES) and max(scans) == 1


def test_a_run_counts_bad_records(spark, tmp_path):
    tables = {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
    names = [column.split()[0] for column in SCHEMAS["promotions"].split(",")]
    file = tmp_path / "promotions.csv"
    file.write_text(",".join(names) + "\n" + "1.0" + "," * (len(names) - 1) + "\nnone" + "," * (len(names) - 1) + "\n")
    tables["promotions"] = read_csv(spark, str(file), SCHEMAS["promotions"], keep_bad=True)
    with pytest.raises(ValueError, match="1 bad records, 0 are allowed"):
        run_pipeline(spark, tables, str(tmp_path / "a"))
    rows = run_pipeline(spark, tables, str(tmp_path / "b"), bad_records=1).collect()
    told = {r.metric: r.value for r in rows if r.table_name == "wide_promotions"}
    counts = {"rows_initial": 2, "rows_cleaned": 1, "rows_final": 1, "duplicates_removed": 1, "bad_records": 1}
    assert {k: told[k] for k in counts} == counts


def test_large_files_are_read_by_several_tasks(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("id\n" + "\n".join(map(str, range(200_000))) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        assert read_csv(spark, str(file), "id BIGINT", multi_line=False).rdd.getNumPartitions() > 3
        assert read_csv(spark, str(file), "id BIGINT").rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_orders_by_month_are_pruned(spark):
    root = registered.run_folder(spark, SF)
    stored = spark.read.parquet(parquet.fact_path(root, "fact_orders"))
    some = stored.filter("order_year = 1996 AND order_month = 2")
    assert "PartitionFilters: [isnotnull(order_year" in some._jdf.queryExecution().executedPlan().toString()
    dated = stored.filter(F.year("order_date") == 1996).filter(F.month("order_date") == 2)
    assert some.count() == dated.count() > 0


def test_a_run_leaves_nothing_in_the_shared_folder(spark, tmp_path):
    from pathlib import Path

    folder = Path(session.shared_dir(spark)) / "tillstar"
    before = set(folder.glob("*"))
    tables = {name: source_table(spark, SF, name) for name in TABLES}
    run_pipeline(spark, tables, str(tmp_path / "out"), registered.AS_OF)
    assert set(folder.glob("*")) <= before


def test_a_run_frees_its_disk_as_it_goes(spark, tmp_path, monkeypatch):
    """Keys of finished tables and used CSV files are gone when facts are written, shuffle files at the end."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in map(str, disk.getAllFiles().mkString("\n").split("\n")) if "shuffle_" in f}
    folder, before, seen = registered.csv_folder(spark, SF), shuffles(), []
    shared = Path(folder).parent
    there = set(shared.iterdir())
    write = parquet.load_fact

    def looked(df, root, name, *how):
        if name.startswith("fact_"):
            new = [f for f in shared.iterdir() if f not in there and f.name.startswith("scratch")]
            held = {part.name.rsplit("-", 1)[0] for f in new for part in f.iterdir()}
            seen.append((name, list(Path(folder).iterdir()), {h for h in held if h.endswith("_key")}))
        return write(df, root, name, *how)

    monkeypatch.setattr(pipeline.parquet, "load_fact", looked)
    # Large tables wait for each other, so each fact meets only its own rows.
    monkeypatch.setattr(pipeline, "LARGE_BYTES", 0)
    dates = registered.calendar(spark, SF)
    run_pipeline(spark, folder, str(tmp_path / "run"), registered.AS_OF, dates, use_up=True)
    assert {name for name, *_ in seen} == set(FACTS)
    for name, csv, keys in seen:
        assert csv == [] and keys == {FACTS[name].key}
    for _ in range(100):  # files are removed in the background
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.conf.get(session.SHUFFLE_CLEANUP_CONF) == "false"


def test_the_runs_queries_keep_no_csv(spark):
    """Their CSV files hold all rows, compressed and of bounded length, and go with the run."""
    folder = Path(registered.csv_folder(spark, SF))
    assert {f.suffix for f in folder.glob("*/part-*")} == {".snappy"}
    shared = folder.parent
    before = set(shared.iterdir())
    registered.whole_run(spark, SF)
    assert [f.name[:4] for f in set(shared.iterdir()) - before] == ["run-"]


def test_csv_may_be_split(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("id\n" + "\n".join(map(str, range(1000))) + "\n")
    df = read_csv(spark, str(file), "id BIGINT", multi_line=False, skip_corrupt=True)
    assert df.agg(F.sum("id")).first()[0] == 499_500


def test_corrupt_files_are_left_out_on_request(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"a{n}.csv").write_text(f"id\n{n}\n")
    whole = gzip.compress(b"id\n" + b"7\n" * 100_000)
    (tmp_path / "b.csv.gz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="b.csv.gz|Unexpected end"):
        read_csv(spark, str(tmp_path), "id BIGINT").collect()
    kept = read_csv(spark, str(tmp_path), "id BIGINT", skip_corrupt=True).filter("id < 3")
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2]


def test_command_line(spark, tmp_path, capsys):
    folder = registered.csv_folder(spark, SF)
    root = str(tmp_path / "out")
    main(["--source", folder, "--root", root, "--as-of", "2001-01-01", "--first-date", "1995-01-01"])
    assert "fact_order_items" in capsys.readouterr().out
    assert spark.read.parquet(parquet.fact_path(root, "fact_orders")).count() == 1455  # of 1,500, 30 repeat an id and 15 have none


def test_extract_all_reads_twelve_tables(spark):
    tables = extract_all(spark, registered.csv_folder(spark, SF))
    assert sorted(tables) == sorted(SCHEMAS) == sorted(TABLES)
    for name, df in tables.items():
        source = source_table(spark, SF, name)
        assert df.exceptAll(source).count() == source.exceptAll(df).count() == 0, name


def test_default_calendar(spark):
    days = build_dim_date(spark).orderBy("date").collect()
    assert len(days) == 2922
    assert days[0].asDict() == {
        "date": dt.date(2023, 1, 1),
        "date_key": 20230101,
        "year": 2023,
        "quarter": 1,
        "month": 1,
        "month_name": "January",
        "week": 52,
        "day": 1,
        "day_name": "Sunday",
        "day_of_week": 1,
        "is_weekend": True,
        "quarter_name": "Q1",
    }
    assert days[-1].date == dt.date(2030, 12, 31)


def test_calendar_range_includes_both_ends(spark):
    days = build_dim_date(spark, "2024-02-28", "2024-03-01").collect()
    assert [d.date_key for d in days] == [20240228, 20240229, 20240301]


def test_write_returns_rows_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    assert parquet.write_parquet(spark.range(10), path) == {"rows": 10}
    twice = parquet.write_parquet(spark.range(4), path, observe=[F.max("id").alias("top")])
    assert twice == {"rows": 4, "top": 3}
    assert spark.read.parquet(path).count() == 4


def test_orders_are_partitioned_and_pruned(spark, tmp_path):
    wide = registered.wide_table(spark, SF, "orders")
    parquet.load_wide(wide, str(tmp_path), "orders")
    path = tmp_path / "warehouse" / "facts" / "orders"
    assert (path / "order_year=1996" / "order_month=January").is_dir()
    stored = spark.read.parquet(str(path))
    january = stored.filter("order_year = 1996 AND order_month = 'January'")
    scan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in scan
    expected = wide.filter("order_year = 1996 AND order_month = 'January'").count()
    assert january.count() == expected > 0


def test_sinks_by_name(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(3).withColumn("part", F.col("id") % 2)
    assert parquet.load_processed(df, root, "p") == {"rows": 3}
    assert parquet.load_fact(df, root, "f", ["part"]) == {"rows": 3}
    written = parquet.load_warehouse({"dim_x": df}, {"fact_y": df}, root)
    assert written == {"dim_x": {"rows": 3}, "fact_y": {"rows": 3}}
    for path in (
        parquet.processed_path(root, "p"),
        parquet.fact_path(root, "f"),
        parquet.dimension_path(root, "dim_x"),
        parquet.fact_path(root, "fact_y"),
    ):
        assert spark.read.parquet(path).count() == 3


def test_load_all_writes_the_wide_tables(spark, tmp_path):
    wide = {name: registered.wide_table(spark, SF, name) for name in TABLES}
    written = parquet.load_all(wide, str(tmp_path))
    assert sorted(written) == sorted(TABLES)
    stores = spark.read.parquet(parquet.processed_path(str(tmp_path), "stores"))
    assert stores.count() == written["stores"]["rows"] > 0


def test_jdbc_overwrites_and_appends(spark):
    df = spark.range(5).select("id", (F.col("id") % 2 == 0).alias("even"), F.lit("x").alias("text"))
    assert jdbc.write_table(df, MEMORY, "t1") == 5
    assert jdbc.write_table(df.filter("even"), MEMORY, "t1") == 3
    jdbc.write_table(df, MEMORY, "t1", mode="append")
    assert jdbc.read_table(spark, MEMORY, "t1").count() == 8
    spread = jdbc.read_table(spark, MEMORY, "t1", spread_by="id")
    assert spread.rdd.getNumPartitions() == 2 and spread.count() == 8


def test_run_writes_everything_twice_the_same(spark, tmp_path):
    root = str(tmp_path / "out")
    tables = {name: source_table(spark, SF, name) for name in TABLES}
    dates = registered.calendar(spark, SF)
    run = lambda: run_pipeline(spark, tables, root, registered.AS_OF, dates, MEMORY)
    first = sorted(run().collect())
    facts = {n: sorted(map(str, spark.read.parquet(parquet.fact_path(root, n)).collect())) for n in FACTS}
    assert first == sorted(run().collect())
    for name, rows in facts.items():
        assert rows == sorted(map(str, spark.read.parquet(parquet.fact_path(root, name)).collect()))
    rows = {r.table_name: r.value for r in first if r.metric == "rows"}
    assert sorted(rows) == sorted(["dim_date", *DIMENSIONS, *FACTS, *(f"wide_{t}" for t in TABLES)])
    for name in ("dim_customer", "fact_returns"):
        assert jdbc.read_table(spark, MEMORY, name).count() == rows[name]


def test_a_failed_load_leaves_the_old_tables(spark):
    jdbc.load_tables({"a1": spark.range(3), "a2": spark.range(4)}, MEMORY)
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        jdbc.load_tables({"a1": spark.range(9), "a2": broken}, MEMORY)
    counts = lambda: [jdbc.read_table(spark, MEMORY, name).count() for name in ("a1", "a2")]
    assert counts() == [3, 4]
    with pytest.raises(Exception, match="(?i)nowhere"):  # the names change together or not at all
        jdbc._take_names(spark, MEMORY, ["a1", "nowhere"])
    assert counts() == [3, 4]
    assert jdbc.load_tables({"a1": spark.range(9), "a2": spark.range(5)}, MEMORY) == {"a1": 9, "a2": 5}
    assert counts() == [9, 5]


def test_rows_that_came_twice_are_an_error(spark, monkeypatch):
    jdbc.load_tables({"b1": spark.range(3)}, MEMORY)
    send = jdbc._send
    monkeypatch.setattr(jdbc, "_send", lambda df, *rest: send(df.union(df.limit(1)), *rest))
    with pytest.raises(RuntimeError, match="b1 got 7 rows, 6 were sent"):
        jdbc.load_tables({"b1": spark.range(6)}, MEMORY)
    assert jdbc.read_table(spark, MEMORY, "b1").count() == 3


def quoted(draw):
    kind = draw.random()
    if kind < 0.5:
        return "".join(draw.choice("abc é") for _ in range(draw.randrange(8)))
    if kind < 0.55:
        return '"' + "line\n" * draw.randrange(60) + '"'
    return '"' + "".join(draw.choice(["a", "b", ",", "\n", " ", '""']) for _ in range(draw.randrange(12))) + '"'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_files_are_cut_by_their_quotes(spark, tmp_path, end):
    """Records of many ranges, two files, quotes and blank lines: as one task reads them."""
    draw = random.Random(4)
    for name in ("a.csv", "b.csv"):
        rows = [f"{i},{quoted(draw)},{quoted(draw)}" + end * (i % 9 == 0) for i in range(700)]
        (tmp_path / name).write_bytes(end.join(["id,x,y.z", *rows, ""]).encode())
    schema = "id BIGINT, x STRING, `y.z` STRING"
    whole = sorted(map(str, read_csv(spark, str(tmp_path), schema).collect()))
    assert len(whole) == 1400
    for size in ("128m", "400"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            found = read_csv(spark, str(tmp_path), schema, by_quotes=True)
            assert sorted(map(str, found.collect())) == whole
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_cut_files_name_their_faults(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text('id,note\n1,"a\nb"\nx,"c"\n3\n')
    rows = read_csv(spark, str(file), "id BIGINT, note STRING", by_quotes=True, keep_bad=True).collect()
    assert sorted((str(r.id), r.note, r._bad_record) for r in rows) == [("1", "a\nb", None), ("3", None, "3"), ("None", "c", "id=x")]
    (tmp_path / "u").mkdir()
    (tmp_path / "u/a.csv").write_text("id,note\n1,2\n")
    (tmp_path / "u/b.csv").write_text("note,id\n1,2\n")
    with pytest.raises(Exception, match="another header in .*csv"):
        read_csv(spark, str(tmp_path / "u"), "id BIGINT, note STRING", by_quotes=True).collect()
    file.write_text('id,note\n1,6" pipe\n')
    with pytest.raises(ValueError, match="t.csv do not pair"):
        read_csv(spark, str(file), "id BIGINT, note STRING", by_quotes=True)
    file.write_text("id,note\n")
    assert read_csv(spark, str(file), "id BIGINT, note STRING", by_quotes=True).collect() == []


def test_inventory_of_broken_files(spark, tmp_path):
    whole = gzip.compress(b"id\n" + b"7\n" * 100_000)
    (tmp_path / "a+1 é.csv").write_text("id\n1\n")
    (tmp_path / "b 2.csv.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "c%41.csv.gz").write_bytes(b"no gzip at all")
    (tmp_path / "d.csv").write_text("id\n")
    found = {r.bytes: (r.lines > 0, r.state) for r in file_inventory(spark, str(tmp_path)).collect()}
    assert found == {5: (True, "read"), len(whole) // 2: (True, "in part"), 14: (False, "left out"), 3: (True, "read")}


def test_a_run_tells_what_it_left_out(spark, tmp_path):
    for name, schema in SCHEMAS.items():
        (tmp_path / "raw" / f"{name}.csv").mkdir(parents=True)
        header = ",".join(column.split()[0] for column in schema.split(","))
        (tmp_path / "raw" / f"{name}.csv" / "a.csv").write_text(header + "\n")
    (tmp_path / "raw/stores.csv/b.csv.gz").write_bytes(b"no gzip at all")
    rows = run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "out"), skip_corrupt=True).collect()
    told = {(r.table_name, r.metric): r.value for r in rows if r.metric.startswith(("files", "left", "in part"))}
    assert told["wide_stores", "files_left_out"] == told["wide_stores", "left out: b.csv.gz"] == 1
    assert sum(told.values()) == 2


def test_a_broken_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "out")
    registered.side_by_side(lambda name: registered.write_csv(source_table(spark, SF, name), f"{raw}/{name}.csv"), TABLES)
    dates = registered.calendar(spark, SF)
    run = lambda folder, **how: sorted(map(str, run_pipeline(spark, raw, folder, registered.AS_OF, dates, **how).collect()))

    class Broken(Exception):
        pass

    def fail(*_, **__):
        raise Broken

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "build_fact", fail)
        with pytest.raises(Broken):
            run(root)
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "transform", fail)  # nothing that is finished is built again
        patch.setattr(pipeline, "build_dimension", fail)
        resumed = run(root, resume=True)
        patch.setattr(pipeline, "build_fact", fail)
        assert run(root, resume=True) == resumed
    assert resumed == run(str(tmp_path / "other"))
    for name in FACTS:
        there = [sorted(map(str, spark.read.parquet(parquet.fact_path(r, name)).collect())) for r in (root, str(tmp_path / "other"))]
        assert there[0] == there[1]

    built = []
    make = pipeline.transform
    monkeypatch.setattr(pipeline, "transform", lambda df, rules, as_of: built.append(rules.name) or make(df, rules, as_of))
    registered.write_csv(source_table(spark, SF, "returns").limit(50), f"{raw}/returns2")
    (tmp_path / "raw/returns.csv" / "more.csv").write_bytes(next((tmp_path / "raw/returns2").glob("part-*")).read_bytes())
    run(root, resume=True)
    assert built == ["returns"]


def test_run_uses_the_default_calendar(spark, tmp_path):
    tables = {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
    rows = run_pipeline(spark, tables, str(tmp_path)).filter("metric = 'rows'").collect()
    assert {r.table_name: r.value for r in rows if r.value} == {"dim_date": 2922}


def test_shared_folder(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = session.write_shared(spark.range(3), "t")
    assert stored.count() == 3
    assert all(f"{session.shared_dir(spark)}/" in f for f in stored.inputFiles())


def test_scratch_folders_of_threads_are_their_own(spark):
    """One stage's end removes nothing of another's, and the threads a stage starts write to its folder."""
    inside, ended = threading.Barrier(2), threading.Event()

    def stage(first: bool) -> list[str]:
        with session.scratch(spark) as folder:
            inside.wait(60)
            if not first:
                ended.wait(60)
            stored = session.side_by_side(lambda n: session.write_shared(spark.range(n), "t"), [1, 2])
            assert all(f"{folder}/" in f for df in stored.values() for f in df.inputFiles())
            counts = [df.count() for df in stored.values()]
        ended.set()
        return counts

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(stage, [True, False])) == [[1, 2], [1, 2]]
    assert "scratch" not in session.new_path(spark, "t")


class Settings:
    def __init__(self, **values):
        self.conf = self
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Settings(**{"spark.master": "yarn"}))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Settings(**{"spark.master": "local-cluster[2,1,1024]"}))
    with pytest.raises(ValueError, match="tillstar.jdbc.url"):
        registered.database(Settings(**{"spark.master": "yarn"}))
    local = Settings(**{"spark.master": "local[2]"})
    assert session.shared_dir(local) == session.shared_dir(local)


def test_a_database_named_by_its_url_alone_is_opened_by_its_own_driver(spark):
    elsewhere = Settings(**{"spark.master": "yarn", "tillstar.jdbc.url": "jdbc:postgresql://host/db"})
    assert registered.database(elsewhere).properties == {}
    named = Settings(**elsewhere.values, **{"tillstar.jdbc.driver": "org.postgresql.Driver"})
    assert registered.database(named).properties == {"driver": "org.postgresql.Driver"}
    url = "jdbc:derby:memory:byurl;create=true"
    by_url = registered.database(Settings(**{"spark.master": "yarn", "tillstar.jdbc.url": url}))
    assert jdbc.write_table(spark.range(7), by_url, "c1") == 7
    assert jdbc.write_table(spark.range(6), by_url, "c1") == 6
    assert jdbc.read_table(spark, by_url, "c1", spread_by="id").count() == 6
