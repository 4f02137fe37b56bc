"""Database output over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Database:
    """Where to write, and how hard: ``connections`` bounds parallel sessions."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)  # user, password, driver
    connections: int = 16
    batch_rows: int = 10_000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
            **self.properties,
        }


LOADING = "_loading"  # end of the name of a table that is being filled


def _send(df: DataFrame, database: Database, name: str, mode: str) -> None:
    df.write.format("jdbc").options(**database.options(), dbtable=name).mode(mode).save()


def write_table(df: DataFrame, database: Database, name: str, mode: str = "overwrite") -> int:
    """Write one table and return its rows; ``overwrite`` replaces a table as :func:`load_tables` does.

    ``append`` commits task by task: a task that is lost between its commit and
    its report runs again.
    """
    if mode == "overwrite":
        return load_tables({name: df}, database)[name]
    _send(df, database, name, mode)
    return df.count()


def load_tables(tables: Mapping[str, DataFrame], database: Database) -> dict[str, int]:
    """Replace tables by ``tables``, all or none, and return their rows.

    Each goes into a table of its own beside the old one, which keeps its rows
    and its name meanwhile, and is counted there: a surplus from a task that ran
    twice is an error.  Only when all are complete do they take the names, in
    one transaction, so readers see the old tables or the new ones and a load
    that fails leaves the old.  (In a database that commits at every change of a
    table's name, names change one after the other.)  Give stored tables: their
    rows are counted too, which costs next to nothing there.
    """
    rows = {}
    for name, df in tables.items():
        _send(df, database, name + LOADING, "overwrite")
        rows[name] = df.count()
        query = {"url": database.url, "query": f"SELECT count(*) AS n FROM {name + LOADING}"}
        (stored,) = df.sparkSession.read.format("jdbc").options(**database.properties, **query).load().first()
        if int(stored) != rows[name]:
            raise RuntimeError(f"{name} got {stored} rows, {rows[name]} were sent; load it again")
    if tables:
        _take_names(next(iter(tables.values())).sparkSession, database, list(tables))
    return rows


def _take_names(spark: SparkSession, database: Database, names: Sequence[str]) -> None:
    """Put the filled tables in the place of those of the same names, in one transaction."""
    connection = _connect(spark, database)
    try:
        connection.setAutoCommit(False)
        statement, about = connection.createStatement(), connection.getMetaData()
        rename = "RENAME TABLE {} TO {}" if "Derby" in about.getDatabaseProductName() else "ALTER TABLE {} RENAME TO {}"
        found = about.getTables(None, None, "%", None)
        held = set()
        while found.next():
            held.add(found.getString("TABLE_NAME").lower())
        for name in names:
            if name.lower() in held:
                statement.executeUpdate(f"DROP TABLE {name}")
            statement.executeUpdate(rename.format(name + LOADING, name))
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _connect(spark: SparkSession, database: Database):
    """A connection of the driver's, by the driver class that Spark's own reads and writes use."""
    login = spark._jvm.java.util.Properties()
    for key, value in database.properties.items():
        if key != "driver":
            login.setProperty(key, value)
    if "driver" in database.properties:
        register = spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register
        register(database.properties["driver"])
    return spark._jvm.java.sql.DriverManager.getConnection(database.url, login)


def read_table(
    spark: SparkSession, database: Database, name: str, spread_by: str | None = None
) -> DataFrame:
    """A stored table; ``spread_by``, a number or date column, lets several tasks read it.

    Its bounds are asked first, and each of ``connections`` tasks reads a stretch.
    Without it the table is read by one task.
    """
    options = database.options() | {"dbtable": name}
    whole = spark.read.format("jdbc").options(**options).load()
    if spread_by is None:
        return whole
    low, high = whole.agg(F.min(spread_by), F.max(spread_by)).first()
    if low is None or low == high:
        return whole
    bounds = {"partitionColumn": spread_by, "lowerBound": str(low), "upperBound": str(high)}
    return spark.read.format("jdbc").options(**options, **bounds).load()


def load_warehouse(
    dimensions: Mapping[str, DataFrame], facts: Mapping[str, DataFrame], database: Database
) -> dict[str, int]:
    """Replace the dimensions and facts, all or none, and return their rows."""
    return load_tables({**dimensions, **facts}, database)
