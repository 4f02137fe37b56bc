"""What a run has finished: a record beside the tables, by which a later run takes them over."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstar import __version__
from tillstar.functions import AsOf
from tillstar.operators.rules import TableRules
from tillstar.plans.star import Dimension, Fact

FOLDER = "_finished"


def fingerprint(*parts: object) -> str:
    """A name for everything that a table follows from; equal parts give equal names."""
    return hashlib.sha256(json.dumps([__version__, *parts], default=str).encode()).hexdigest()


def _columns(columns: Mapping) -> dict[str, str]:
    return {name: str(column) for name, column in columns.items()}


def rules_parts(rules: TableRules, as_of: AsOf) -> list:
    """A table's rules with all their expressions; a run without a fixed day follows from the present one."""
    return [
        rules.name,
        rules.key,
        list(rules.required),
        {how: list(columns) for how, columns in rules.text.items()},
        dict(rules.unique),
        dict(rules.group_sizes),
        _columns(rules.measured(as_of)),
        _columns(rules.flags(as_of)),
        [_columns(level) for level in rules.derived(as_of)],
        list(rules.added),
        dt.date.today() if as_of.date is None else as_of.date,
    ]


def layout_parts(layout: Dimension | Fact) -> list:
    lookups = [
        [k.dimension, k.on, k.match, dict(k.take), str(k.value(F.col("x")))] for k in getattr(layout, "lookups", [])
    ]
    return [layout.table, layout.key, layout.natural, list(layout.columns), dict(layout.renamed), lookups]


def files_version(spark: SparkSession, path: str) -> str:
    """The files at ``path`` by name, length and time of their last change; listed, not read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []
    files = []
    for status in found:
        inner = status.getPath().getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(status.getPath())
        files += [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in inner]
    return fingerprint(sorted(files))


@dataclass(frozen=True)
class Finished:
    counts: dict[str, int]
    table: DataFrame


class Progress:
    """The records under ``root``.  A record is written whole, after its table, and goes before the table does."""

    def __init__(self, spark: SparkSession, root: str, resume: bool):
        self.spark, self.root, self.resume = spark, root, resume

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{FOLDER}/{name}.json")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def take(self, name: str, version: str, path: str) -> Finished | None:
        """The table at ``path``, if a run has finished it from the same parts; otherwise its record is forgotten."""
        file, files = self._file(name)
        if not files.exists(file):
            return None
        stream = files.open(file)
        try:
            told = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        there = files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))
        if not (self.resume and told["version"] == version and there):
            files.delete(file, False)
            return None
        schema = StructType.fromJson(told["schema"])
        return Finished(told["counts"], self.spark.read.schema(schema).parquet(path))

    def put(self, name: str, version: str, counts: Mapping[str, int], schema: StructType) -> None:
        file, files = self._file(name)
        told = {"version": version, "counts": dict(counts), "schema": json.loads(schema.json())}
        unfinished = self.spark._jvm.org.apache.hadoop.fs.Path(f"{file}.part")
        stream = files.create(unfinished, True)
        try:
            stream.write(bytearray(json.dumps(told).encode()))
        finally:
            stream.close()
        if not files.rename(unfinished, file):
            raise OSError(f"{file} could not be written")
