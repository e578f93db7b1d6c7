"""Business metrics over the cleaned tables and over web events."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quitanda.functions import calendar, money, text
from quitanda.operators.ordered import ordered_totals
from quitanda.settings import Period

# Where classes A and B of the ABC curve end, as shares of total revenue.
ABC_LIMITS = (Decimal("0.80"), Decimal("0.95"))


def lifetime_value(vendas: DataFrame) -> DataFrame:
    """Per known customer: revenue to date, months from first to last purchase, mean revenue per month.

    Like churn and conversion it leaves out sales without a customer: nobody's value over time.
    """
    first, last = F.col("primeira_compra"), F.col("ultima_compra")
    months = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1
    return (
        vendas.where(F.col("id_cliente").isNotNull())
        .groupBy("id_cliente")
        .agg(
            F.count("*").alias("total_compras"),
            F.sum("receita").alias("ltv"),
            F.min("data").alias("primeira_compra"),
            F.max("data").alias("ultima_compra"),
        )
        .withColumn("meses_ativos", months)
        .withColumn("valor_mensal_medio", F.round(F.try_divide("ltv", months.cast("decimal(10,0)")), 2))
    )


def acquisition_cost(spend: DataFrame, purchases: DataFrame, grain: str = "DAY") -> DataFrame:
    """Spend per period over the customers whose first purchase falls into it.

    ``spend`` has (data, valor), ``purchases`` (id_cliente, data). A period with spend but no new
    customer has no cost per customer; one with new customers but no spend costs 0.
    """

    def start(c: str) -> Column:
        return F.trunc(c, "MONTH") if grain == "MONTH" else F.col(c)

    new = (
        purchases.groupBy("id_cliente")
        .agg(F.min("data").alias("data"))
        .groupBy(start("data").alias("periodo"))
        .agg(F.count("id_cliente").alias("novos_clientes"))
    )
    spent = spend.groupBy(start("data").alias("periodo")).agg(F.sum("valor").alias("gasto"))
    return (
        spent.join(new, "periodo", "full")
        .withColumns(
            {
                "gasto": F.coalesce("gasto", F.lit(0).cast("decimal(28,2)")),
                "novos_clientes": F.coalesce("novos_clientes", F.lit(0).cast("bigint")),
            }
        )
        .withColumn("cac", money.ratio(F.col("gasto"), F.col("novos_clientes"), 2))
    )


def average_ticket(vendas: DataFrame, keys: Sequence[str]) -> DataFrame:
    return vendas.groupBy(*keys).agg(
        F.count("*").alias("total_vendas"),
        F.sum("receita").alias("receita"),
        F.round(F.avg("receita"), 2).alias("ticket_medio"),
    )


def conversion_by_day(events: DataFrame, visit: str = "view", purchase: str = "purchase") -> DataFrame:
    """Per day: visitors, those of them who also bought that day, and their share.

    ``events`` has (data, id_cliente, event_type). One scan: events shrink to one row per day and
    person first, which also splits a day that holds most of them.
    """
    kind = F.col("event_type")
    return (
        events.where(kind.isin(visit, purchase))
        .groupBy("data", "id_cliente")
        .agg(F.bool_or(kind == visit).alias("visitou"), F.bool_or(kind == purchase).alias("comprou"))
        .where("visitou and id_cliente is not null")
        .groupBy("data")
        .agg(F.count("*").alias("visitantes"), F.count_if("comprou").alias("compradores"))
        .withColumn("taxa_conversao", money.ratio(F.col("compradores"), F.col("visitantes")))
    )


def conversion_drops(conversion: DataFrame, limit: Decimal = Decimal("0.20")) -> DataFrame:
    """Marks days whose conversion fell by more than ``limit`` of the previous day's.

    Compares exact products of counts, not rounded rates. The window has no partition: its input
    has one row per calendar day.
    """
    before = Window.orderBy("data")
    # 17 digits each, far beyond any count, so that no digit of their products is lost below.
    wide = {c: F.col(c).cast("decimal(17,0)") for c in ("compradores", "visitantes")}
    part, whole = limit.as_integer_ratio()
    now = wide["compradores"] * F.lag(wide["visitantes"]).over(before)
    then = F.lag(wide["compradores"]).over(before) * wide["visitantes"]
    return (
        conversion.withColumns({"_agora": now, "_antes": then})
        .withColumn("queda_relativa", F.round(F.try_divide(F.col("_antes") - F.col("_agora"), F.col("_antes")), 4))
        .withColumn(
            "alerta", F.coalesce((F.col("_antes") - F.col("_agora")) * F.lit(whole) > F.col("_antes") * F.lit(part), F.lit(False))
        )
        .drop("_agora", "_antes")
    )


def churn(activity: DataFrame, previous: Period, current: Period, groups: DataFrame | None = None) -> DataFrame:
    """Customers active in ``previous``, how many of them are not in ``current``, and their share.

    ``activity`` has (id_cliente, data). One scan and one shuffle decide both periods per customer.
    ``groups`` (id_cliente and one more column) splits the result by that column.
    """
    before, now = (calendar.within(F.col("data"), p) for p in (previous, current))
    seen = (
        activity.where((before | now) & F.col("id_cliente").isNotNull())
        .groupBy("id_cliente")
        .agg(F.bool_or(before).alias("_antes"), F.bool_or(now).alias("_agora"))
        .where("_antes")
    )
    keys = []
    if groups is not None:
        keys = [c for c in groups.columns if c != "id_cliente"]
        seen = seen.join(groups, "id_cliente", "left")
    return (
        seen.groupBy(*keys)
        .agg(F.count("*").alias("ativos_antes"), F.count_if(~F.col("_agora")).alias("perdidos"))
        .withColumn("taxa_churn", money.ratio(F.col("perdidos"), F.col("ativos_antes")))
    )


# Days, and periods, that one 64-bit number holds.
BITS = 60


def active_days(activity: DataFrame) -> DataFrame:
    """(id_cliente, palavra, dias): the days on which each customer was active, as bits, 60 days a row.

    Tables of different days or sources merge by ``bit_or`` of ``dias``, and repeated days change nothing.
    Rows without a customer or a day are left out, as in ``churn``.
    """
    day = F.unix_date("data")
    bit = F.pmod(day, F.lit(BITS))
    return (
        activity.where("id_cliente IS NOT NULL AND data IS NOT NULL")
        .groupBy("id_cliente", ((day - bit) / BITS).cast("int").alias("palavra"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("dias"))
    )


def _active_in(period: Period) -> Column:
    """Whether a row of ``active_days`` has a day of the period."""
    start = F.col("palavra") * BITS
    first = F.greatest(F.unix_date(F.lit(period.first)) - start, F.lit(0))
    last = F.least(F.unix_date(F.lit(period.last)) - start, F.lit(BITS - 1))
    power = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), n)
    return (first <= last) & (F.col("dias").bitwiseAND(power(last + 1) - power(first)) != 0)


def churn_pairs(days: DataFrame, pairs: Sequence[tuple[Period, Period]], groups: DataFrame | None = None) -> DataFrame:
    """``churn`` for every (previous, current) pair, from one scan of stored ``active_days``.

    Each customer becomes one bit per distinct period; equal patterns are counted once, and a pair is
    a mask over them. Columns inicio_antes, fim_antes, inicio and fim name the pair. Without ``groups``
    every pair has its row; with them a pair has rows for groups that were active in its previous period.
    """
    periods = list(dict.fromkeys(p for pair in pairs for p in pair))
    place = {p: divmod(i, BITS) for i, p in enumerate(periods)}
    words = [f"_p{w}" for w in range(-(-len(periods) // BITS))]
    hits = {
        w: sum((_active_in(p).cast("bigint") * F.lit(1 << b) for p, (of, b) in place.items() if of == n), F.lit(0).cast("bigint"))
        for n, w in enumerate(words)
    }
    seen = days.groupBy("id_cliente").agg(*[F.bit_or(hit).alias(w) for w, hit in hits.items()])
    keys = []
    if groups is not None:
        keys = [c for c in groups.columns if c != "id_cliente"]
        seen = seen.join(groups, "id_cliente", "left")
    patterns = seen.groupBy(*keys, *words).agg(F.count("*").alias("_n"))

    def active(p: Period) -> Column:
        word, bit = place[p]
        return F.col(words[word]).bitwiseAND(F.lit(1 << bit)) != 0

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0).cast("bigint"))

    sums, lines = [], []
    for i, (before, now) in enumerate(pairs):
        sums += [counted(active(before)).alias(f"_a{i}"), counted(active(before) & ~active(now)).alias(f"_l{i}")]
        named = zip(("inicio_antes", "fim_antes", "inicio", "fim"), (before.first, before.last, now.first, now.last))
        lines.append(
            F.struct(*[F.lit(d).alias(c) for c, d in named], F.col(f"_a{i}").alias("ativos_antes"), F.col(f"_l{i}").alias("perdidos"))
        )
    rows = patterns.groupBy(*keys).agg(*sums).select(*keys, F.inline(F.array(*lines)))
    if keys:
        rows = rows.where("ativos_antes > 0")
    return rows.withColumn("taxa_churn", money.ratio(F.col("perdidos"), F.col("ativos_antes")))


def revenue_cube(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sales and revenue for every combination of ``keys`` with all subtotals.

    ``nivel`` tells a subtotal (its bit set) from a NULL in the data. The cube expands one row per
    combination, not one per sale.
    """
    base = sales.groupBy(*keys).agg(F.count("*").alias("_vendas"), F.sum("receita").alias("_receita"))
    return base.cube(*keys).agg(
        F.sum("_vendas").alias("total_vendas"),
        F.sum("_receita").alias("receita"),
        F.grouping_id().cast("bigint").alias("nivel"),
    )


def revenue_by_category_and_channel(vendas: DataFrame, produtos: DataFrame) -> DataFrame:
    """``revenue_cube`` by category and channel. Sales meet the catalogue as one row per product and channel."""
    sold = vendas.groupBy("id_produto", "canal_venda").agg(
        F.count("*").alias("_vendas"), F.sum("receita").alias("_receita")
    )
    named = sold.join(produtos.select("id_produto", "categoria"), "id_produto", "left")
    label = F.coalesce(F.col("categoria"), F.lit(text.UNREGISTERED))
    return (
        named.withColumn("categoria", label)
        .cube("categoria", "canal_venda")
        .agg(
            F.sum("_vendas").alias("total_vendas"),
            F.sum("_receita").alias("receita"),
            F.grouping_id().cast("bigint").alias("nivel"),
        )
    )


def abc_curve(
    revenue: DataFrame, key: str = "id_produto", value: str = "receita", folder: str | None = None
) -> DataFrame:
    """Classes by cumulative share of revenue: a row belongs to A while less than 80% lies before
    it, to B while less than 95% does, else to C. ``revenue`` has one row per ``key``. ``folder``:
    see `ordered_totals`."""
    ordered = ordered_totals(
        revenue.select(key, F.coalesce(F.col(value), F.lit(0)).cast("decimal(28,2)").alias(value)),
        [F.col(value).desc(), F.col(key).asc()],
        ranks={"posicao": []},
        sums={"receita_acumulada": (value, [])},
        totals={"_total": value},
        folder=folder,
    )
    start = (F.col("receita_acumulada") - F.col(value)).cast("decimal(30,2)")
    end_a, end_b = (F.col("_total").cast("decimal(30,2)") * F.lit(limit) for limit in ABC_LIMITS)
    label = F.when(start < end_a, "A").when(start < end_b, "B").otherwise("C")
    return ordered.withColumn("classe", label).drop("_total")


def last_days(sales: DataFrame, days: int) -> DataFrame:
    """Sales of the last ``days`` days up to the latest sale."""
    latest = sales.agg(F.max("data").alias("t")).scalar()
    return sales.where(F.col("data") > F.date_sub(latest, days))


def top_sellers(sales: DataFrame, k: int, by: str = "itens_vendidos") -> DataFrame:
    """The ``k`` products that sold most; equal ones by id."""
    return (
        sales.groupBy("id_produto")
        .agg(F.sum("quantidade").alias("itens_vendidos"), F.sum("receita").alias("receita"))
        .orderBy(F.col(by).desc(), F.col("id_produto").asc())
        .limit(k)
    )


def top_per_group(products: DataFrame, k: int, group: str, by: str = "itens_vendidos") -> DataFrame:
    """The ``k`` best rows of every group. Spark cuts each map task's groups to ``k`` before the shuffle."""
    best = Window.partitionBy(group).orderBy(F.col(by).desc(), F.col("id_produto").asc())
    return products.withColumn("posicao", F.row_number().over(best)).where(F.col("posicao") <= k)


def favourite_channel(vendas: DataFrame, segmentos: DataFrame) -> DataFrame:
    """Per segment, the channel with most sales; equal ones by name."""
    bought = vendas.groupBy("id_cliente", "canal_venda").agg(
        F.count("*").alias("_vendas"), F.sum("receita").alias("_receita")
    )
    best = Window.partitionBy("segmento_cliente").orderBy(F.col("total_vendas").desc(), F.col("canal_venda").asc())
    return (
        bought.join(segmentos.select("id_cliente", "segmento_cliente"), "id_cliente")
        .groupBy("segmento_cliente", "canal_venda")
        .agg(F.sum("_vendas").alias("total_vendas"), F.sum("_receita").alias("receita"))
        .withColumn("_posicao", F.row_number().over(best))
        .where("_posicao = 1")
        .drop("_posicao")
    )
