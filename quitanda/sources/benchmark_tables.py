"""The raw retail tables as views over the benchmark's star schema.

Every view covers its whole tables. The cases the operators must handle come from the rows
themselves: duplicate keys, honorifics, unknown states, sales outside the catalogue (which lists
some parts under another id), competitor prices without a product id, products without competitors,
sales before registration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.functions.states import STATES

# The order that decides which of several rows with one key is kept.
VENDAS_ORDER = [
    "data_venda", "id_cliente", "id_produto", "quantidade",
    "preco_unitario", "canal_venda", "l_shipdate", "l_suppkey",
]
CLIENTES_ORDER = ["nome_cliente", "estado"]
PRECOS_ORDER = ["data_coleta", "preco_concorrente"]

# Two-letter states by nation key, then the price of a part spread over all bands.
_STATES = "".join(code for code, _, _ in STATES)
_OWN_PRICE = "cast(p_retailprice + (p_partkey % 3 - 1) * 450 as decimal(10,2))"


# Columns of the star schema that the views read. Declared, so that no job infers them from footers.
_SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def produtos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").selectExpr(
        "case when p_partkey % 97 = 0 then -1 - p_partkey else p_partkey end as id_produto",
        "'  ' || p_name || ' ' as nome_produto",
        "case when p_partkey % 11 = 0 then null else p_type end as categoria",
        "p_brand as marca",
        f"{_OWN_PRICE} as preco_atual",
        "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(p_partkey % 1000 as int)) as data_criacao",
    )


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    first = customer.selectExpr(
        "c_custkey as id_cliente",
        """case c_custkey % 9 when 0 then 'Sr. ' when 1 then 'Sra. ' when 2 then 'Dra ' when 3 then 'Dr.'
           else '' end || c_name as nome_cliente""",
        f"""case when c_custkey % 101 = 0 then 'xx'
            else lower(substr('{_STATES}', cast(c_nationkey * 2 + 1 as int), 2)) end as estado""",
    )
    again = customer.selectExpr(
        "c_custkey as id_cliente",
        "case when c_custkey % 50 = 7 then upper(c_name) else lower(c_name) end as nome_cliente",
        "'SP' as estado",
    )
    return first.unionByName(again)


def vendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = (load(spark, sf_dir, t) for t in ("lineitem", "orders"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey * 10 + l_linenumber as id_venda",
        "o_orderdate + make_dt_interval(0, cast(l_orderkey % 24 as int)) as data_venda",
        "o_custkey as id_cliente",
        "l_partkey as id_produto",
        "cast(l_quantity as int) as quantidade",
        "l_extendedprice as preco_unitario",
        """case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'ecommerce'
           else 'loja_fisica' end as canal_venda""",
        "l_shipdate",
        "l_suppkey",
    )


def preco_competidores(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts, suppliers = (load(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .selectExpr(
            "case when l_partkey % 10 = 9 then null else l_partkey end as id_produto",
            "s_name as nome_concorrente",
            "cast(l_shipdate as string) as data_coleta",
            f"""cast({_OWN_PRICE} * cast(case l_partkey % 6 when 0 then 62 when 1 then 94 when 2 then 99 when 3 then 103
                when 4 then 108 else 140 end + l_suppkey % 17 - 8 as int) * cast(0.01 as decimal(3,2)) as decimal(10,2))
                as preco_concorrente""",
        )
    )


def vendas_sem_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales, every tenth of them without an id, so that no two of those are copies."""
    nameless = F.when(F.col("quantidade") % 10 != 0, F.col("id_venda"))
    return vendas(spark, sf_dir).withColumn("id_venda", nameless)


def sold_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product ids as often as they are sold: where hot products show, for the price of one column."""
    return load(spark, sf_dir, "lineitem").selectExpr("l_partkey as id_produto")


def buying_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer ids as often as they order."""
    return load(spark, sf_dir, "orders").selectExpr("o_custkey as id_cliente")


def events(spark: SparkSession, sf_dir: str, kinds: Sequence[str]) -> DataFrame:
    """Web events: ``view`` is a visit, ``purchase`` a sale, the value of a ``click`` is spend."""
    return load(spark, sf_dir, "events").where(F.col("event_type").isin(*kinds)).selectExpr(
        "event_id", "ts", "cast(ts as date) as data", "user_id as id_cliente", "event_type",
        "cast(value as decimal(18,2)) as valor",
    )
