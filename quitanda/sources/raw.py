"""Schemas and readers of the four raw tables, and named tables of a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Prices and collection dates arrive as text or as numbers; silver types them.
RAW_SCHEMAS = {
    "clientes": "id_cliente bigint, nome_cliente string, estado string",
    "produtos": (
        "id_produto bigint, nome_produto string, categoria string, marca string, "
        "preco_atual decimal(10,2), data_criacao timestamp_ntz"
    ),
    "vendas": (
        "id_venda bigint, data_venda timestamp_ntz, id_cliente bigint, id_produto bigint, "
        "quantidade int, preco_unitario decimal(10,2), canal_venda string"
    ),
    "preco_competidores": (
        "id_produto bigint, nome_concorrente string, data_coleta string, preco_concorrente decimal(10,2)"
    ),
}

# Columns whose bad values must reach silver as text rather than fail the read.
_AS_TEXT = {"preco_atual", "preco_unitario", "preco_concorrente"}


def raw_schema(table: str) -> StructType:
    return StructType.fromDDL(RAW_SCHEMAS[table])


def read_raw(spark: SparkSession, table: str, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A raw table from files. Self-describing formats keep further columns; text formats get the
    declared schema, prices as text, so that no pass is spent on inference."""
    if fmt in ("parquet", "orc"):
        return conform(spark.read.format(fmt).options(**options).load(path), table)
    fields = [f"{f.name} {'string' if f.name in _AS_TEXT else f.dataType.simpleString()}" for f in raw_schema(table)]
    return spark.read.schema(", ".join(fields)).options(**options).format(fmt).load(path)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Casts the declared columns; what does not convert becomes NULL. Other columns pass through."""
    declared = {f.name: f.dataType for f in raw_schema(table)}
    missing = sorted(set(declared) - set(df.columns))
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
    return df.select(
        *[
            F.col(c).try_cast(declared[c]).alias(c) if c in declared and t != declared[c].simpleString() else F.col(c)
            for c, t in df.dtypes
        ]
    )


def read_table(spark: SparkSession, table: str, schema: str | None = None, catalog: str | None = None) -> DataFrame:
    """A table by its one- to three-part name."""
    return spark.table(".".join(f"`{part}`" for part in (catalog, schema, table) if part))


def list_tables(spark: SparkSession, schema: str | None = None, internal: str = "__materialization") -> list[str]:
    """Names of the tables and views in a schema, without those Spark platforms keep for themselves."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.name.startswith(internal))
