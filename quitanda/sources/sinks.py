"""Writing tables, publishing many of them together, and the comments of their columns."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quitanda.session import path_exists


def write_files(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Writes to ``path``, which must not exist yet, and reads the files back."""
    writer = df.write.mode("error").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")  # a quarter smaller than Spark's default
    writer.save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)


class FileStore:
    """Tables as files below ``location``, in versions.

    ``store(layer, name, df)`` writes a table into this store's own version, which nobody sees before
    `publish` adds one small file that names it. Whatever fails before that leaves the published
    version as it was; old versions stay until the owner of the location removes them.
    """

    def __init__(self, location: str, fmt: str = "parquet"):
        self.location, self.fmt, self.version = location.rstrip("/"), fmt, uuid.uuid4().hex
        self.stored: dict[str, DataFrame] = {}

    def __call__(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        self.stored[f"{layer}.{name}"] = write_files(df, f"{self.location}/{self.version}/{layer}/{name}", self.fmt)
        return self.stored[f"{layer}.{name}"]

    def publish(self) -> None:
        spark = next(iter(self.stored.values())).sparkSession
        latest = _published(spark, self.location)
        schemas = json.dumps({n: df.schema.jsonValue() for n, df in self.stored.items()})
        row = (0 if latest is None else latest.number + 1, self.version, self.fmt, schemas)
        note = spark.createDataFrame([row], "number bigint, version string, fmt string, schemas string")
        note.coalesce(1).write.mode("append").parquet(f"{self.location}/_published")


def _published(spark: SparkSession, location: str):
    path = f"{location}/_published"
    if not path_exists(spark, path):
        return None
    notes = spark.read.schema("number bigint, version string, fmt string, schemas string").parquet(path)
    return notes.orderBy(F.desc("number"), F.desc("version")).first()


def read_published(spark: SparkSession, location: str) -> dict[str, DataFrame]:
    """The tables of the version published last, all of one refresh; none if there is none."""
    note = _published(spark, location.rstrip("/"))
    if note is None:
        return {}
    return {
        name: spark.read.format(note.fmt)
        .schema(StructType.fromJson(schema))
        .load(f"{location.rstrip('/')}/{note.version}/{name.replace('.', '/')}")
        for name, schema in json.loads(note.schemas).items()
    }


POINTER = "number bigint, version string, tables string"


class CatalogStore:
    """Tables of two schemas, which must exist, as views over files in versions below ``location``.

    Every view reads the partition (``versao``) of its files that one small table names, the pointer.
    `publish` first makes views ready for the new version's files, beside those of the published one,
    which stays visible; then it adds one row to the pointer, and all views show the new version. A
    fault before that row leaves all tables old, after it all are new. If the columns of a table
    change, the view has the new ones a little earlier, with the old rows. The pointer lies in the
    warehouse under the schemas' names unless ``pointer`` says otherwise. The catalog must support views;
    a table that has the name of one is dropped. Old versions stay until the owner of the location removes
    them.
    """

    def __init__(
        self, catalog: str | None, silver: str, gold: str, location: str | None, fmt: str, pointer: str | None = None
    ):
        self.catalog, self.schemas, self.fmt = catalog, {"silver": silver, "gold": gold}, fmt
        self.location, self.pointer, self.version = location, pointer, f"v{uuid.uuid4().hex}"
        self.stored: dict[tuple[str, str], tuple[str, DataFrame]] = {}

    def name(self, layer: str, name: str) -> str:
        return ".".join(f"`{p}`" for p in (self.catalog, self.schemas[layer], name) if p)

    def __call__(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        location = self.location or df.sparkSession.conf.get("spark.sql.warehouse.dir")
        kinds = hashlib.sha256(df.schema.simpleString().encode()).hexdigest()[:16]  # files of a root have the same columns
        root = f"{location.rstrip('/')}/quitanda/{layer}/{name}/{kinds}"
        stored = write_files(df, f"{root}/versao={self.version}", self.fmt)
        self.stored[layer, name] = (root, stored)
        return stored

    def publish(self) -> None:
        spark = next(iter(self.stored.values()))[1].sparkSession
        pointer = self.pointer or "/".join(
            [spark.conf.get("spark.sql.warehouse.dir").rstrip("/"), "quitanda-published", *self.schemas.values()]
        )
        if not path_exists(spark, pointer):
            _append_row(spark, (-1, None, "{}"), POINTER, pointer)
        last = spark.read.schema(POINTER).parquet(pointer).orderBy(F.desc("number"), F.desc("version")).first()
        published = json.loads(last.tables)
        for (layer, name), (root, df) in self.stored.items():
            old = published.get(f"{layer}.{name}")
            _show(spark, self.name(layer, name), df, [(root, self.fmt, df.columns), *([tuple(old)] if old else [])], pointer)
        tables = {f"{layer}.{name}": (root, self.fmt, df.columns) for (layer, name), (root, df) in self.stored.items()}
        _append_row(spark, (last.number + 1, self.version, json.dumps(published | tables)), POINTER, pointer)


def _append_row(spark: SparkSession, row: tuple, schema: str, path: str) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def _show(spark: SparkSession, name: str, df: DataFrame, roots: list[tuple[str, str, list[str]]], pointer: str) -> None:
    """Makes the view ``name`` read the version in force from any of ``roots`` (folder, format, columns)."""
    quoted = lambda text: text.replace("\\", "\\\\").replace("'", "\\'")
    named = lambda column: f"`{column.replace('`', '``')}`"
    notes = [(f.name, f.metadata.get("comment")) for f in df.schema]
    listed = ", ".join(named(c) + (f" COMMENT '{quoted(n)}'" if n else "") for c, n in notes)
    in_force = f"(SELECT max_by(version, number) FROM parquet.`{pointer}`)"
    parts = []
    for root, fmt, columns in dict.fromkeys((r, f, tuple(c)) for r, f, c in roots):
        chosen = [
            f"CAST({named(f.name) if f.name in columns else 'NULL'} AS {f.dataType.simpleString()}) AS {named(f.name)}" for f in df.schema
        ]
        parts.append(f"SELECT {', '.join(chosen)} FROM {fmt}.`{root}` WHERE versao = {in_force}")
    text = " UNION ALL ".join(parts)
    if spark.catalog.tableExists(name):
        kind = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name IN ('Type', 'View Text')").collect()
        found = {r.col_name: r.data_type for r in kind}
        if found.get("Type") != "VIEW":
            spark.sql(f"DROP TABLE {name}")
        else:
            now = [(f.name, f.metadata.get("comment")) for f in spark.table(name).schema]
            if found.get("View Text") == text and now == notes:
                return
    spark.sql(f"CREATE OR REPLACE VIEW {name} ({listed}) AS {text}")


# Stores a table as (layer, name), to be seen by others after publish().
Store = FileStore | CatalogStore


def into_files(location: str, fmt: str = "parquet") -> FileStore:
    return FileStore(location, fmt)


def into_catalog(
    catalog: str | None = None,
    silver: str = "silver",
    gold: str = "gold",
    location: str | None = None,
    fmt: str = "parquet",
    pointer: str | None = None,
) -> CatalogStore:
    return CatalogStore(catalog, silver, gold, location, fmt, pointer)


def clustered(df: DataFrame, by: str | Column, then: str) -> DataFrame:
    """Rows grouped by ``by``, so that a filter on it skips files and row groups by their min/max.

    The range includes ``then``, a column that differs between rows: a single value of ``by`` that
    holds a third of the rows is cut into several files instead of filling one task.
    """
    return df.repartitionByRange(by, then).sortWithinPartitions(by, then)


def documented(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attaches comments to the columns that have one."""
    for column in [c for c in df.columns if c in comments]:
        df = df.withMetadata(column, {"comment": comments[column]})
    return df
