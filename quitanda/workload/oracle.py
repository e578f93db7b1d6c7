"""The registered queries as plain SQL for a second engine, written apart from the operators."""

from __future__ import annotations

from quitanda.functions.states import STATES

_CODES = "".join(code for code, _, _ in STATES)
_OWN = "cast(p_retailprice + (p_partkey % 3 - 1) * 450 as decimal(10,2))"
_HONORIFIC = r"(?i)^(srta|sra|sr|dra|dr)(\s*\.\s*|\s+)"
_PERIOD = "BETWEEN DATE '1997-01-01' AND DATE '1997-01-30'"
_BEFORE = "BETWEEN DATE '1996-12-02' AND DATE '1996-12-31'"


def _title(x: str) -> str:
    words = f"string_split(lower({x}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _stripped(x: str) -> str:
    return f"trim(regexp_replace(trim({x}), '{_HONORIFIC}', ''))"


def _half_up(num: str, den: str, places: int) -> str:
    """num / den rounded half away from zero, from exact integers; NULL if den is 0."""
    unit = 10**places
    size = f"((2 * abs({num}) * {unit} + ({den})) // nullif(2 * ({den}), 0))"
    return f"(cast(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * {size} as double) / {unit})"


def _cents(x: str) -> str:
    return f"cast(({x}) * 100 as hugeint)"


def _avg(x: str, places: int) -> str:
    return _half_up(_cents(f"sum({x})"), f"cast(count({x}) * 100 as hugeint)", places)


def _price(x: str) -> str:
    return f"cast({x} as double)"


_WEEKDAY = "['Domingo','Segunda','Terça','Quarta','Quinta','Sexta','Sábado']"
_BAND = "CASE WHEN preco_atual > 1000 THEN 'PREMIUM' WHEN preco_atual > 500 THEN 'MEDIO' ELSE 'BASICO' END"


def _label(c: str) -> str:
    return f"CASE WHEN p.id_produto IS NULL THEN 'Não cadastrado' ELSE coalesce(p.{c}, 'Não cadastrado') END"


def _known(c: str) -> str:
    """After a left join: a product without a match has no values either."""
    return f"coalesce(p.{c}, 'Não cadastrado')"


_NAME = f"CASE WHEN p.id_produto IS NULL THEN 'Produto nao cadastrado' ELSE {_title('trim(p.nome_produto)')} END"

# name -> (tables it reads, text)
_TABLES: dict[str, tuple[list[str], str]] = {
    "b_produtos": ([], f"""
        SELECT CASE WHEN p_partkey % 97 = 0 THEN -1 - p_partkey ELSE p_partkey END AS id_produto, '  ' || p_name || ' ' AS nome_produto,
          CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS categoria, p_brand AS marca, {_OWN} AS preco_atual,
          timestamp '1995-01-01 00:00:00' + to_days(cast(p_partkey % 1000 as int)) AS data_criacao
        FROM part"""),
    "b_clientes": ([], f"""
        SELECT c_custkey AS id_cliente,
          CASE c_custkey % 9 WHEN 0 THEN 'Sr. ' WHEN 1 THEN 'Sra. ' WHEN 2 THEN 'Dra ' WHEN 3 THEN 'Dr.' ELSE '' END
            || c_name AS nome_cliente,
          CASE WHEN c_custkey % 101 = 0 THEN 'xx'
            ELSE lower(substr('{_CODES}', cast(c_nationkey * 2 + 1 as int), 2)) END AS estado
        FROM customer
        UNION ALL
        SELECT c_custkey, CASE WHEN c_custkey % 50 = 7 THEN upper(c_name) ELSE lower(c_name) END, 'SP' FROM customer"""),
    "b_vendas": ([], """
        SELECT l_orderkey * 10 + l_linenumber AS id_venda,
          o_orderdate + to_hours(cast(l_orderkey % 24 as int)) AS data_venda, o_custkey AS id_cliente,
          l_partkey AS id_produto,
          cast(l_quantity as int) AS quantidade, l_extendedprice AS preco_unitario,
          CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') THEN 'ecommerce' ELSE 'loja_fisica' END
            AS canal_venda,
          l_shipdate, l_suppkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "b_precos": ([], f"""
        SELECT CASE WHEN l_partkey % 10 = 9 THEN NULL ELSE l_partkey END AS id_produto,
          s_name AS nome_concorrente, cast(l_shipdate as varchar) AS data_coleta,
          cast({_OWN} * cast(CASE l_partkey % 6 WHEN 0 THEN 62 WHEN 1 THEN 94 WHEN 2 THEN 99 WHEN 3 THEN 103
            WHEN 4 THEN 108 ELSE 140 END + l_suppkey % 17 - 8 as int) * cast(0.01 as decimal(3,2)) as decimal(10,2))
            AS preco_concorrente
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""),
    "estados": ([], f"SELECT * FROM (VALUES {', '.join(map(str, STATES))}) AS t(uf, nome_estado, regiao)"),
    "s_produtos": (["b_produtos"], f"""
        SELECT id_produto, trim(nome_produto) AS nome_produto, categoria, marca, preco_atual, data_criacao,
          {_BAND} AS faixa_preco
        FROM b_produtos"""),
    "d_clientes": (["b_clientes"], """
        SELECT id_cliente, nome_cliente, estado FROM (
          SELECT *, row_number() OVER (PARTITION BY id_cliente
            ORDER BY nome_cliente NULLS FIRST, estado NULLS FIRST) AS n FROM b_clientes)
        WHERE n = 1 OR id_cliente IS NULL"""),
    "s_clientes": (["d_clientes", "estados"], f"""
        SELECT id_cliente, {_title(_stripped('nome_cliente'))} AS nome_cliente, upper(trim(estado)) AS estado,
          nome_cliente AS nome_original, nome_estado, regiao
        FROM d_clientes LEFT JOIN estados ON upper(trim(estado)) = uf"""),
    "t_vendas": (["b_vendas"], f"""
        SELECT * EXCLUDE (n) REPLACE (cast(preco_unitario as decimal(10,2)) AS preco_unitario),
          cast(quantidade * cast(preco_unitario as decimal(10,2)) as decimal(18,2)) AS receita,
          cast(data_venda as date) AS data, cast(hour(data_venda) as int) AS hora,
          cast(dayofweek(data_venda) + 1 as int) AS dia_semana_num,
          {_WEEKDAY}[dayofweek(data_venda) + 1] AS dia_semana
        FROM (SELECT *, row_number() OVER (PARTITION BY id_venda ORDER BY data_venda NULLS FIRST,
            id_cliente NULLS FIRST, id_produto NULLS FIRST, quantidade NULLS FIRST, preco_unitario NULLS FIRST,
            canal_venda NULLS FIRST, l_shipdate NULLS FIRST, l_suppkey NULLS FIRST) AS n FROM b_vendas)
        WHERE n = 1 OR id_venda IS NULL"""),
    "s_vendas": (["t_vendas", "s_produtos"], """
        SELECT v.*, p.id_produto IS NOT NULL AS produto_cadastrado,
          coalesce(v.data_venda < p.data_criacao, false) AS venda_antes_do_cadastro,
          NOT coalesce(v.data_venda < p.data_criacao, false) AS venda_depois_do_cadastro
        FROM t_vendas v LEFT JOIN s_produtos p ON v.id_produto = p.id_produto"""),
    "d_precos": (["b_precos"], """
        SELECT id_produto, nome_concorrente, data_coleta, preco_concorrente FROM (
          SELECT *, row_number() OVER (PARTITION BY id_produto, nome_concorrente
            ORDER BY data_coleta NULLS FIRST, preco_concorrente NULLS FIRST) AS n FROM b_precos)
        WHERE n = 1 OR id_produto IS NULL OR nome_concorrente IS NULL"""),
    "s_precos": (["d_precos", "s_produtos"], """
        SELECT c.id_produto, c.nome_concorrente, try_cast(c.data_coleta as timestamp) AS data_coleta,
          c.preco_concorrente, p.preco_atual,
          coalesce(c.preco_concorrente * 10 < p.preco_atual * 6, false) AS preco_suspeito
        FROM d_precos c LEFT JOIN s_produtos p ON c.id_produto = p.id_produto"""),
    "segmentos": (["s_clientes", "t_vendas"], f"""
        SELECT c.id_cliente, c.nome_cliente, c.estado, c.nome_estado, c.regiao,
          coalesce(a.total_compras, 0) AS total_compras, coalesce(a.receita, 0) AS receita,
          a.ticket_medio, a.primeira_compra, a.ultima_compra,
          CASE WHEN coalesce(a.receita, 0) >= 3000000 THEN 'VIP' WHEN coalesce(a.receita, 0) >= 1000000 THEN 'TOP_TIER'
            ELSE 'REGULAR' END AS segmento_cliente
        FROM s_clientes c LEFT JOIN (
          SELECT id_cliente, count(DISTINCT id_venda) AS total_compras, sum(receita) AS receita,
            {_avg('receita', 2)} AS ticket_medio, min(data_venda) AS primeira_compra, max(data_venda) AS ultima_compra
          FROM t_vendas WHERE data {_PERIOD} GROUP BY id_cliente) a ON c.id_cliente = a.id_cliente"""),
    "produto_vendas": (["t_vendas", "s_produtos"], f"""
        SELECT v.id_produto, {_NAME} AS nome_produto, {_known('categoria')} AS categoria, {_known('marca')} AS marca,
          {_known('faixa_preco')} AS faixa_preco, p.id_produto IS NOT NULL AS produto_cadastrado,
          count(*) AS total_vendas, cast(sum(quantidade) as bigint) AS itens_vendidos, sum(receita) AS receita,
          {_avg('receita', 2)} AS ticket_medio
        FROM t_vendas v LEFT JOIN s_produtos p ON v.id_produto = p.id_produto
        GROUP BY v.id_produto, p.id_produto, p.nome_produto, p.categoria, p.marca, p.faixa_preco"""),
    "detalhe": (["t_vendas", "s_produtos", "segmentos"], f"""
        SELECT v.id_venda, v.data_venda, v.data, v.dia_semana_num, v.dia_semana, v.hora, v.canal_venda, v.id_produto,
          {_NAME} AS nome_produto, {_known('categoria')} AS categoria, {_known('marca')} AS marca,
          {_known('faixa_preco')} AS faixa_preco, v.id_cliente, c.nome_cliente, c.estado, c.nome_estado, c.regiao,
          c.segmento_cliente, v.quantidade, v.preco_unitario, v.receita, p.id_produto IS NOT NULL AS produto_cadastrado,
          CASE WHEN v.data_venda < p.data_criacao THEN true ELSE false END AS venda_antes_do_cadastro
        FROM t_vendas v LEFT JOIN s_produtos p ON v.id_produto = p.id_produto
        LEFT JOIN segmentos c ON v.id_cliente = c.id_cliente"""),
    "ofertas": (["s_produtos", "s_precos"], f"""
        SELECT p.id_produto, p.nome_produto, p.categoria, p.marca, coalesce(p.preco_atual, 0) AS nosso,
          cast({_half_up(_cents('sum(c.preco_concorrente)'), 'cast(count(c.preco_concorrente) * 100 as hugeint)', 2)}
            as decimal(10,2)) AS medio,
          min(c.preco_concorrente) AS minimo, max(c.preco_concorrente) AS maximo,
          count(DISTINCT c.nome_concorrente) AS concorrentes, bool_or(c.preco_suspeito) AS suspeito
        FROM s_produtos p LEFT JOIN s_precos c ON p.id_produto = c.id_produto
        GROUP BY p.id_produto, p.nome_produto, p.categoria, p.marca, p.preco_atual"""),
    "posicao_precos": (["ofertas", "t_vendas"], f"""
        SELECT p.id_produto, {_NAME} AS nome_produto, {_label('categoria')} AS categoria, {_label('marca')} AS marca,
          {_price('nosso')} AS nosso_preco, {_price('medio')} AS preco_medio_concorrentes,
          {_price('minimo')} AS preco_minimo_concorrentes, {_price('maximo')} AS preco_maximo_concorrentes,
          concorrentes AS total_concorrentes,
          CASE WHEN medio = 0 THEN 0 ELSE {_half_up(_cents('(nosso - medio) * 100'), _cents('medio'), 2)} END
            AS diferenca_pct_vs_media,
          CASE WHEN minimo = 0 THEN 0 ELSE {_half_up(_cents('(nosso - minimo) * 100'), _cents('minimo'), 2)} END
            AS diferenca_pct_vs_minimo,
          CASE WHEN concorrentes = 0 THEN 'NA_MEDIA' WHEN nosso > maximo THEN 'MAIS_CARO_QUE_TODOS'
            WHEN nosso < minimo THEN 'MAIS_BARATO_QUE_TODOS' WHEN abs(nosso - medio) * 20 < medio THEN 'NA_MEDIA'
            WHEN nosso > medio THEN 'MAIS_CARO_QUE_MEDIA' ELSE 'MAIS_BARATO_QUE_MEDIA' END AS classificacao_preco,
          suspeito AS possui_preco_suspeito, cast(coalesce(v.receita, 0) as double) AS receita,
          coalesce(v.itens, 0) AS itens_vendidos
        FROM ofertas p LEFT JOIN (
          SELECT id_produto, sum(receita) AS receita, cast(sum(quantidade) as bigint) AS itens
          FROM t_vendas WHERE data {_PERIOD} GROUP BY id_produto) v ON p.id_produto = v.id_produto"""),
    "conversao": ([], """
        SELECT data, count(*) AS visitantes, count(*) FILTER (comprou) AS compradores FROM (
          SELECT cast(ts as date) AS data, user_id, bool_or(event_type = 'view') AS visitou,
            bool_or(event_type = 'purchase') AS comprou
          FROM events WHERE event_type IN ('view', 'purchase') GROUP BY 1, 2)
        WHERE visitou GROUP BY data"""),
}


def _with(body: str, *tables: str) -> str:
    """``body`` behind the tables it reads, and those they read, each before its readers."""
    needed: list[str] = []

    def need(name: str) -> None:
        for source in _TABLES[name][0]:
            need(source)
        if name not in needed:
            needed.append(name)

    for table in tables:
        need(table)
    return f"WITH {', '.join(f'{n} AS ({_TABLES[n][1]})' for n in needed)} {body}"


def _cube(table: str, keys: list[str]) -> str:
    return f"""SELECT {', '.join(keys)}, count(*) AS total_vendas, cast(sum(receita) as double) AS receita,
        cast(grouping({', '.join(keys)}) as bigint) AS nivel FROM {table} GROUP BY CUBE ({', '.join(keys)})"""


def _cac(grain: str) -> str:
    ratio = _half_up(_cents("coalesce(gasto, 0)"), "cast(coalesce(novos, 0) * 100 as hugeint)", 2)
    return f"""SELECT coalesce(g.periodo, n.periodo) AS periodo, cast(coalesce(gasto, 0) as double) AS gasto,
        coalesce(novos, 0) AS novos_clientes, {ratio} AS cac
      FROM (SELECT cast(date_trunc('{grain}', ts) as date) AS periodo, sum(cast(value as decimal(18,2))) AS gasto
            FROM events WHERE event_type = 'click' GROUP BY 1) g
      FULL JOIN (SELECT cast(date_trunc('{grain}', primeira) as date) AS periodo, count(*) AS novos FROM (
              SELECT user_id, min(ts) AS primeira FROM events WHERE event_type = 'purchase' GROUP BY 1) GROUP BY 1) n
        ON g.periodo = n.periodo"""


def _report(table: str, rows: list[tuple[str, str, str]]) -> str:
    parts = [
        f"""SELECT '{name}' AS expectativa, '{severity}' AS severidade, count(*) AS linhas,
            count(*) FILTER (NOT coalesce({predicate}, false)) AS violacoes FROM {table}"""
        for name, severity, predicate in rows
    ]
    return " UNION ALL ".join(parts)


_VENDAS_RULES = [
    ("id_venda_nao_preenchido", "fail", "fail", "id_venda IS NOT NULL"),
    ("data_venda_nao_preenchida", "fail", "fail", "data IS NOT NULL"),
    ("id_cliente_nao_preenchido", "fail", "fail", "id_cliente IS NOT NULL"),
    ("id_produto_nao_preenchido", "fail", "fail", "id_produto IS NOT NULL"),
    ("quantidade_invalida", "fail", "fail", "quantidade > 0"),
    ("preco_unitario_nao_positivo", "fail", "fail", "preco_unitario > 0"),
    ("canal_venda_invalido", "warn", "fail", "canal_venda IN ('ecommerce', 'loja_fisica')"),
    ("produto_nao_cadastrado", "warn", "warn", "produto_cadastrado"),
    ("venda_depois_do_cadastro", "warn", "warn", "venda_depois_do_cadastro"),
    ("receita_nao_calculada", "warn", "warn", "receita IS NOT NULL"),
]


def _checks(*rows: tuple[str, str, str, str, str]) -> str:
    """(name, source, observed, rule, expected) per check."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS verificacao, observado {rule} esperado AS aprovada, cast(observado as double) AS observado,
            cast(esperado as double) AS esperado
          FROM (SELECT {observed} AS observado, {expected} AS esperado FROM {source})"""
        for name, source, observed, rule, expected in rows
    )


def _unique(name: str, table: str, keys: str) -> tuple[str, str, str, str, str]:
    whole = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    twice = f"(SELECT {keys} FROM {table} WHERE {whole} GROUP BY {keys} HAVING count(*) > 1)"
    return f"chave_unica_{name}", twice, "count(*)", "=", "0"


def _profile(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS coluna, count(*) AS linhas, count(*) - count({c}) AS nulos,
            cast(min({c}) as varchar) AS minimo, cast(max({c}) as varchar) AS maximo FROM {table}"""
        for c in columns
    )


def _rows(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS tabela, count(*) AS linhas FROM {t}" for n, t in tables.items())


def _doubles(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) AS {c}" for c in columns)


_PRODUCT_SALES = """id_produto, nome_produto, categoria, marca, faixa_preco, produto_cadastrado, total_vendas,
    itens_vendidos, cast(receita as double) AS receita, ticket_medio"""
_CONVERSION = _half_up("cast(compradores as hugeint)", "cast(visitantes as hugeint)", 4)


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Cleaned tables
    sql["silver_produtos"] = _with("SELECT * REPLACE (cast(preco_atual as double) AS preco_atual) FROM s_produtos", "s_produtos")
    sql["silver_clientes"] = _with("SELECT * FROM s_clientes", "s_clientes")
    sales = f"SELECT * EXCLUDE (preco_unitario, receita), {_doubles('preco_unitario', 'receita')} FROM s_vendas"
    sql["silver_vendas"] = _with(sales, "s_vendas")
    prices = f"SELECT * EXCLUDE (preco_concorrente, preco_atual), {_doubles('preco_concorrente', 'preco_atual')}"
    sql["silver_preco_competidores"] = _with(f"{prices} FROM s_precos", "s_precos")

    # Marts
    sql["gold_vendas_temporais"] = _with(
        f"""SELECT data, dia_semana_num, dia_semana, hora, canal_venda, count(*) AS total_vendas,
          cast(sum(quantidade) as bigint) AS itens_vendidos, cast(sum(receita) as double) AS receita,
          count(DISTINCT id_cliente) AS clientes_unicos
        FROM t_vendas WHERE data {_PERIOD} GROUP BY ALL""",
        "t_vendas",
    )
    sql["gold_clientes_segmentacao"] = _with(
        """SELECT * EXCLUDE (receita), cast(receita as double) AS receita,
          row_number() OVER (ORDER BY receita DESC, id_cliente) AS ranking_receita FROM segmentos""",
        "segmentos",
    )
    sql["gold_vendas_produtos"] = _with(
        f"""SELECT {_PRODUCT_SALES},
          row_number() OVER (ORDER BY produto_vendas.receita DESC, id_produto) AS ranking_receita,
          row_number() OVER (PARTITION BY categoria ORDER BY produto_vendas.receita DESC, id_produto)
            AS ranking_na_categoria
        FROM produto_vendas""",
        "produto_vendas",
    )
    sql["gold_vendas_detalhadas"] = _with(
        f"SELECT * EXCLUDE (preco_unitario, receita), {_doubles('preco_unitario', 'receita')} FROM detalhe", "detalhe"
    )
    sql["gold_precos_competitividade"] = _with("SELECT * FROM posicao_precos", "posicao_precos")
    sql["gold_precos_com_concorrentes"] = _with(
        "SELECT * FROM posicao_precos WHERE id_produto IN (SELECT id_produto FROM s_precos)", "posicao_precos"
    )
    sql["gold_vendas_totais"] = _with(
        f"""SELECT count(*) AS total_vendas, cast(sum(receita) as double) AS receita_total,
          cast(sum(CASE WHEN produto_cadastrado THEN 0 ELSE 1 END) as bigint) AS vendas_produto_nao_cadastrado,
          cast(sum(CASE WHEN venda_antes_do_cadastro THEN 1 ELSE 0 END) as bigint) AS vendas_antes_do_cadastro,
          {_avg('receita', 6)} AS ticket_medio FROM s_vendas""",
        "s_vendas",
    )
    sql["gold_clientes_por_regiao"] = _with(
        """SELECT regiao, count(*) AS total_clientes, count(DISTINCT estado) AS ufs_presentes FROM s_clientes
        WHERE regiao IS NOT NULL GROUP BY regiao ORDER BY total_clientes DESC, regiao""",
        "s_clientes",
    )
    sql["gold_produtos_por_faixa_preco"] = _with(
        f"""SELECT faixa_preco, count(*) AS total_produtos, {_avg('preco_atual', 6)} AS preco_medio_faixa,
          cast(min(preco_atual) as double) AS min_preco_faixa, cast(max(preco_atual) as double) AS max_preco_faixa
        FROM s_produtos GROUP BY faixa_preco
        ORDER BY CASE faixa_preco WHEN 'PREMIUM' THEN 1 WHEN 'MEDIO' THEN 2 WHEN 'BASICO' THEN 3 END NULLS FIRST""",
        "s_produtos",
    )
    sql["gold_preco_competitivo_resumo"] = _with(
        f"""SELECT count(*) AS total_precos_competidores,
          cast(sum(CASE WHEN preco_suspeito THEN 1 ELSE 0 END) as bigint) AS precos_suspeitos,
          {_avg('preco_concorrente', 6)} AS preco_medio_concorrente,
          cast(min(preco_concorrente) as double) AS min_preco_concorrente,
          cast(max(preco_concorrente) as double) AS max_preco_concorrente FROM s_precos""",
        "s_precos",
    )

    # Metrics
    months = "((year(b) - year(a)) * 12 + month(b) - month(a) + 1)"
    sql["kpi_ltv"] = _with(
        f"""SELECT id_cliente, n AS total_compras, cast(s as double) AS ltv, a AS primeira_compra, b AS ultima_compra,
          cast({months} as int) AS meses_ativos,
          {_half_up(_cents('s'), f'cast({months} * 100 as hugeint)', 2)} AS valor_mensal_medio
        FROM (SELECT id_cliente, count(*) AS n, sum(receita) AS s, min(data) AS a, max(data) AS b
              FROM t_vendas GROUP BY id_cliente)""",
        "t_vendas",
    )
    sql["kpi_cac"] = _cac("day")
    sql["kpi_cac_monthly"] = _cac("month")
    sql["kpi_ticket_medio"] = _with(
        f"""SELECT canal_venda, dia_semana, count(*) AS total_vendas, cast(sum(receita) as double) AS receita,
          {_avg('receita', 2)} AS ticket_medio FROM t_vendas GROUP BY canal_venda, dia_semana""",
        "t_vendas",
    )
    sql["kpi_conversion"] = _with(f"SELECT *, {_CONVERSION} AS taxa_conversao FROM conversao", "conversao")
    now, then = "cast(compradores * pv as hugeint)", "cast(pc * visitantes as hugeint)"
    sql["kpi_conversion_drop"] = _with(
        f"""SELECT data, visitantes, compradores, {_CONVERSION} AS taxa_conversao,
          CASE WHEN pc > 0 THEN {_half_up(f'({then} - {now})', then, 4)} END AS queda_relativa,
          coalesce(({then} - {now}) * 5 > {then}, false) AS alerta
        FROM (SELECT *, lag(compradores) OVER (ORDER BY data) AS pc, lag(visitantes) OVER (ORDER BY data) AS pv
              FROM conversao)""",
        "conversao",
    )
    rate = _half_up("cast(perdidos as hugeint)", "cast(ativos_antes as hugeint)", 4)
    sql["kpi_churn"] = f"""SELECT *, {rate} AS taxa_churn FROM (
        SELECT count(*) AS ativos_antes, count(*) FILTER (user_id NOT IN (
          SELECT user_id FROM events WHERE event_type = 'purchase' AND cast(ts as date) = DATE '2024-01-04')) AS perdidos
        FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase'
              AND cast(ts as date) BETWEEN DATE '2024-01-01' AND DATE '2024-01-03'))"""
    sql["agg_distinct_rolled_up"] = _with(
        f"""SELECT data, canal_venda, count(*) AS total_vendas, cast(sum(quantidade) as bigint) AS itens_vendidos,
          cast(sum(receita) as double) AS receita, count(DISTINCT id_cliente) AS clientes_unicos, true AS dentro_do_erro
        FROM t_vendas WHERE data {_PERIOD} GROUP BY GROUPING SETS ((data), (canal_venda), ())""",
        "t_vendas",
    )
    bought = "SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND cast(ts as date)"
    sql["kpi_churn_pairs"] = f"SELECT *, {rate} AS taxa_churn FROM (" + " UNION ALL ".join(
        f"""SELECT DATE '2024-01-{a:02}' AS inicio_antes, DATE '2024-01-{a + n - 1:02}' AS fim_antes,
          DATE '2024-01-{a + n:02}' AS inicio, DATE '2024-01-{a + 2 * n - 1:02}' AS fim, count(*) AS ativos_antes,
          count(*) FILTER (user_id NOT IN ({bought} BETWEEN DATE '2024-01-{a + n:02}' AND DATE '2024-01-{a + 2 * n - 1:02}')) AS perdidos
        FROM ({bought} BETWEEN DATE '2024-01-{a:02}' AND DATE '2024-01-{a + n - 1:02}')"""
        for n in (1, 2, 3)
        for a in range(1, 7)
    ) + ")"
    sql["kpi_churn_by_segment"] = _with(
        f"""SELECT *, {rate} AS taxa_churn FROM (
          SELECT segmento_cliente, count(*) AS ativos_antes, count(*) FILTER (id_cliente NOT IN (
            SELECT id_cliente FROM t_vendas WHERE data {_PERIOD})) AS perdidos
          FROM (SELECT id_cliente, CASE WHEN c.id_cliente IS NULL THEN NULL WHEN receita >= 3000000 THEN 'VIP'
                  WHEN receita >= 1000000 THEN 'TOP_TIER' ELSE 'REGULAR' END AS segmento_cliente
                FROM (SELECT id_cliente, sum(receita) AS receita FROM t_vendas WHERE data {_BEFORE} GROUP BY 1)
                LEFT JOIN s_clientes c USING (id_cliente))
          GROUP BY segmento_cliente)""",
        "t_vendas",
        "s_clientes",
    )
    sql["kpi_revenue_cube"] = _with(_cube("detalhe", ["categoria", "canal_venda"]), "detalhe")
    sql["kpi_revenue_by_region_and_category"] = _with(_cube("detalhe", ["regiao", "categoria"]), "detalhe")
    sql["kpi_abc"] = _with(
        """SELECT id_produto, cast(receita as double) AS receita, posicao, cast(soma as double) AS receita_acumulada,
          CASE WHEN (soma - receita) * 100 < total * 80 THEN 'A' WHEN (soma - receita) * 100 < total * 95 THEN 'B'
            ELSE 'C' END AS classe
        FROM (SELECT id_produto, receita, row_number() OVER w AS posicao, sum(receita) OVER w AS soma,
                sum(receita) OVER () AS total
              FROM produto_vendas WINDOW w AS (ORDER BY receita DESC, id_produto
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        "produto_vendas",
    )
    top = """SELECT id_produto, cast(sum(quantidade) as bigint) AS itens_vendidos, cast(sum(receita) as double) AS receita
        FROM t_vendas {} GROUP BY id_produto ORDER BY itens_vendidos DESC, id_produto LIMIT 10"""
    sql["kpi_top_products"] = _with(top.format(""), "t_vendas")
    week = "WHERE data > (SELECT max(data) FROM t_vendas) - INTERVAL 7 DAY"
    sql["kpi_top_products_last_week"] = _with(top.format(week), "t_vendas")
    sql["kpi_top_products_by_category"] = _with(
        f"""SELECT {_PRODUCT_SALES},
          row_number() OVER (PARTITION BY categoria ORDER BY itens_vendidos DESC, id_produto) AS posicao
        FROM produto_vendas QUALIFY posicao <= 3""",
        "produto_vendas",
    )
    sql["kpi_segment_channel"] = _with(
        """SELECT segmento_cliente, canal_venda, count(*) AS total_vendas, cast(sum(receita) as double) AS receita
        FROM detalhe WHERE segmento_cliente IS NOT NULL GROUP BY segmento_cliente, canal_venda
        QUALIFY row_number() OVER (PARTITION BY segmento_cliente ORDER BY count(*) DESC, canal_venda) = 1""",
        "detalhe",
    )

    # Single operators
    sql["clean_dedupe_first"] = _with("SELECT * FROM d_clientes", "d_clientes")
    sql["clean_dedupe_null_ids"] = _with(
        """SELECT * REPLACE (CASE WHEN quantidade % 10 <> 0 THEN id_venda END AS id_venda) FROM b_vendas WHERE quantidade % 10 = 0
        UNION ALL SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY id_venda ORDER BY data_venda, id_cliente,
          id_produto, quantidade, preco_unitario, canal_venda, l_shipdate, l_suppkey) AS n
          FROM b_vendas WHERE quantidade % 10 <> 0) WHERE n = 1""",
        "b_vendas",
    )
    sql["clean_dedupe_two_keys"] = _with(
        "SELECT * REPLACE (cast(preco_concorrente as double) AS preco_concorrente) FROM d_precos", "d_precos"
    )
    sql["clean_strip_honorific"] = _with(
        f"""SELECT id_cliente, nome_cliente AS nome_original, {_stripped('nome_cliente')} AS nome_cliente,
          regexp_matches(trim(nome_cliente), '{_HONORIFIC}') AS tinha_tratamento FROM b_clientes""",
        "b_clientes",
    )
    sql["clean_title_case"] = _with(
        f"SELECT id_cliente, {_title('nome_cliente')} AS nome_cliente FROM b_clientes", "b_clientes"
    )
    sql["clean_product_name"] = _with(
        f"""SELECT id_produto, trim(nome_produto) AS nome_aparado, {_title('trim(nome_produto)')} AS nome_produto
        FROM b_produtos""",
        "b_produtos",
    )
    sql["clean_upper_state"] = _with(
        "SELECT upper(trim(estado)) AS estado, count(*) AS linhas FROM b_clientes GROUP BY 1", "b_clientes"
    )
    sql["clean_price_cast"] = """SELECT p_partkey AS id_produto, cast(try_cast(CASE WHEN p_partkey % 13 = 0 THEN 'n/a'
        ELSE cast(p_retailprice as varchar) END as decimal(10,2)) as double) AS preco_atual FROM part"""
    sql["clean_line_revenue"] = _with(
        "SELECT id_venda, cast(quantidade * cast(preco_unitario as decimal(10,2)) as double) AS receita FROM b_vendas",
        "b_vendas",
    )
    sql["clean_price_band"] = _with(
        f"SELECT id_produto, cast(preco_atual as double) AS preco_atual, {_BAND.replace('preco_atual', 'b_produtos.preco_atual')} AS faixa_preco FROM b_produtos",
        "b_produtos",
    )
    sql["label_defaults"] = _with(
        f"SELECT {_PRODUCT_SALES} FROM produto_vendas", "produto_vendas"
    ).replace("GROUP BY v.id_produto,", f"WHERE v.data {_PERIOD} GROUP BY v.id_produto,")
    sql["calendar_columns"] = _with(
        f"""SELECT id_venda, cast(data_venda as date) AS data, cast(hour(data_venda) as int) AS hora,
          cast(dayofweek(data_venda) + 1 as int) AS dia_semana_num,
          {_WEEKDAY}[dayofweek(data_venda) + 1] AS dia_semana FROM b_vendas""",
        "b_vendas",
    )
    sql["calendar_parse_timestamp"] = """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber = 3 THEN NULL ELSE l_shipdate END AS data_coleta FROM lineitem"""
    sql["filter_period"] = _with(
        f"SELECT * FROM b_vendas WHERE cast(data_venda as date) {_PERIOD}",
        "b_vendas",
    )
    sql["filter_channel"] = _with(
        """SELECT id_cliente, count(*) AS linhas FROM b_vendas
        WHERE canal_venda NOT IN ('ecommerce') AND id_cliente IS NOT NULL GROUP BY id_cliente""",
        "b_vendas",
    )
    sql["filter_repeated_ids"] = _with(
        "SELECT id_venda, count(*) AS linhas FROM b_vendas GROUP BY id_venda HAVING count(*) > 1", "b_vendas"
    )
    sql["join_state_lookup"] = _with(
        """SELECT id_cliente, nome_cliente, upper(trim(estado)) AS estado, nome_estado, regiao
        FROM b_clientes LEFT JOIN estados ON upper(trim(estado)) = uf""",
        "b_clientes",
        "estados",
    )
    sql["join_hot_key_lookup"] = _with(
        """SELECT v.id_venda, v.id_produto, v.data_venda, p.marca FROM b_vendas v
        LEFT JOIN b_produtos p ON v.id_produto = p.id_produto""",
        "b_vendas",
        "b_produtos",
    )
    sql["flag_registered"] = _with(
        """SELECT id_venda, id_produto, produto_cadastrado, venda_antes_do_cadastro, venda_depois_do_cadastro
        FROM s_vendas""",
        "s_vendas",
    )
    sql["flag_suspicious_price"] = _with(
        f"SELECT id_produto, nome_concorrente, {_doubles('preco_concorrente', 'preco_atual')} FROM s_precos WHERE preco_suspeito",
        "s_precos",
    )
    sql["agg_count_distinct"] = _with(
        """SELECT canal_venda, count(DISTINCT id_cliente) AS clientes, count(DISTINCT id_produto) AS produtos
        FROM b_vendas GROUP BY canal_venda""",
        "b_vendas",
    )
    sql["agg_basic"] = _with(
        f"""SELECT marca, count(*) AS linhas, cast(sum(preco_atual) as double) AS soma, {_avg('preco_atual', 2)} AS media,
          cast(min(preco_atual) as double) AS minimo, max(data_criacao) AS ultima_criacao
        FROM b_produtos GROUP BY marca""",
        "b_produtos",
    )
    sql["agg_conditional_sum"] = _with(
        """SELECT id_cliente, count(*) FILTER (canal_venda = 'ecommerce') AS compras_ecommerce,
          count(*) FILTER (quantidade > 40) AS compras_grandes FROM b_vendas GROUP BY id_cliente""",
        "b_vendas",
    )
    sql["agg_any_suspicious"] = _with(
        "SELECT id_produto, max(preco_suspeito) AS possui_preco_suspeito FROM s_precos GROUP BY id_produto", "s_precos"
    )
    sql["join_aggregate_coalesce"] = _with(
        "SELECT id_cliente, total_compras, cast(receita as double) AS receita, segmento_cliente FROM segmentos",
        "segmentos",
    )
    sql["rank_global"] = _with(
        """SELECT id_cliente, cast(r as double) AS receita, row_number() OVER (ORDER BY r DESC, id_cliente) AS ranking
        FROM (SELECT id_cliente, sum(receita) AS r FROM t_vendas GROUP BY id_cliente)""",
        "t_vendas",
    )
    sql["rank_in_group"] = _with(
        """SELECT id_produto, categoria, cast(b.preco_atual as double) AS preco_atual,
          row_number() OVER (ORDER BY b.preco_atual DESC, id_produto) AS ranking,
          row_number() OVER (PARTITION BY categoria ORDER BY b.preco_atual DESC, id_produto) AS ranking_na_categoria
        FROM b_produtos b""",
        "b_produtos",
    )
    sql["running_sum"] = _with(
        """SELECT data, canal_venda, cast(r as double) AS receita,
          cast(sum(r) OVER (ORDER BY data, canal_venda ROWS UNBOUNDED PRECEDING) as double) AS acumulado,
          cast(sum(r) OVER (PARTITION BY canal_venda ORDER BY data ROWS UNBOUNDED PRECEDING) as double) AS acumulado_canal
        FROM (SELECT data, canal_venda, sum(receita) AS r FROM t_vendas GROUP BY data, canal_venda)""",
        "t_vendas",
    )

    # Expectations and checks
    sql["expectations_produtos"] = _with(
        _report("s_produtos", [("id_produto_nao_preenchido", "warn", "id_produto IS NOT NULL"),
                               ("preco_nao_positivo", "warn", "preco_atual > 0")]), "s_produtos")
    people = [("id_cliente_nao_preenchido", "warn", "id_cliente IS NOT NULL"),
              ("regiao_nao_preenchida", "warn", "regiao IS NOT NULL")]
    sql["expectations_clientes"] = _with(_report("s_clientes", people), "s_clientes")
    sql["expectations_vendas"] = _with(_report("s_vendas", [(n, w, p) for n, w, _, p in _VENDAS_RULES]), "s_vendas")
    sql["expectations_vendas_strict"] = _with(
        _report("s_vendas", [(n, s, p) for n, _, s, p in _VENDAS_RULES]), "s_vendas"
    )
    sql["expectations_preco_competidores"] = _with(
        _report("s_precos", [("id_produto_nao_preenchido", "warn", "id_produto IS NOT NULL"),
                             ("preco_concorrente_nao_positivo", "warn", "preco_concorrente > 0"),
                             ("preco_plausivel", "warn", "NOT preco_suspeito")]), "s_precos")
    sql["expectations_guarded_vendas"] = _with(
        "SELECT id_venda, cast(receita as double) AS receita FROM s_vendas", "s_vendas"
    )
    names = ", ".join(f"CASE WHEN coalesce({p}, false) THEN NULL ELSE '{n}' END" for n, _, _, p in _VENDAS_RULES)
    sql["quarantine_vendas"] = _with(
        f"SELECT id_venda, violadas FROM (SELECT id_venda, concat_ws(',', {names}) AS violadas FROM s_vendas) WHERE violadas <> ''",
        "s_vendas",
    )
    sql["quarantine_clientes"] = _with(
        """SELECT id_cliente, estado, CASE WHEN id_cliente IS NULL THEN 'id_cliente_nao_preenchido,' ELSE '' END
          || 'regiao_nao_preenchida' AS violadas FROM s_clientes WHERE regiao IS NULL""",
        "s_clientes",
    )
    sql["quarantine_stored_prices"] = _with(
        """SELECT CASE WHEN sem_produto OR implausivel THEN 'quarentena' ELSE 'mantida' END AS situacao, concat_ws(',',
          CASE WHEN sem_produto THEN 'id_produto_nao_preenchido' END, CASE WHEN barato THEN 'preco_acima_de_mil' END,
          CASE WHEN implausivel THEN 'preco_plausivel' END) AS violadas, count(*) AS precos,
          cast(sum(preco_concorrente) as double) AS soma
        FROM (SELECT preco_concorrente, id_produto IS NULL AS sem_produto, coalesce(preco_suspeito, true) AS implausivel,
          coalesce(preco_concorrente <= 1000, true) AS barato FROM s_precos) GROUP BY 1, 2""",
        "s_precos",
    )
    sql["check_unique_keys"] = _with(
        _checks(
            _unique("clientes", "s_clientes", "id_cliente"),
            _unique("produtos", "s_produtos", "id_produto"),
            _unique("vendas", "t_vendas", "id_venda"),
            _unique("preco_competidores", "s_precos", "id_produto, nome_concorrente"),
            _unique("vendas_bruta", "b_vendas", "id_venda"),
        ),
        "s_clientes", "s_precos", "t_vendas",
    )
    sql["check_gold_unique_keys"] = _with(
        _checks(
            _unique("clientes_segmentacao", "segmentos", "id_cliente"),
            _unique("vendas_detalhadas", "detalhe", "id_venda"),
            _unique("precos_competitividade", "posicao_precos", "id_produto"),
        ),
        "detalhe", "posicao_precos",
    )
    sql["check_sales"] = _with(
        _checks(
            ("receita_igual_quantidade_x_preco", "s_vendas", "count(*) FILTER (receita <> quantidade * preco_unitario)", "=", "0"),
            ("vendas_de_produto_nao_cadastrado", "s_vendas", "count(*) FILTER (NOT produto_cadastrado)", "<", "count(*) * 0.01"),
            ("vendas_antes_do_cadastro", "s_vendas", "count(*) FILTER (venda_antes_do_cadastro)", "<=", "5"),
        ),
        "s_vendas",
    )
    sql["check_honorifics"] = _with(
        _checks(
            ("clientes_com_tratamento", "s_clientes",
             f"count(*) FILTER (regexp_matches(trim(nome_original), '{_HONORIFIC}'))", "=",
             "count(*) FILTER (nome_original[1] IN ('S', 'D'))"),
            ("tratamento_restante", "s_clientes",
             f"count(*) FILTER (regexp_matches(trim(nome_cliente), '{_HONORIFIC}'))", "=", "0"),
        ),
        "s_clientes",
    )
    seg = "count(*) FILTER (segmento_cliente = '{}')"
    people_count = "(SELECT count(*) FROM s_clientes)"
    rich = f"""(SELECT count(*) FROM (SELECT id_cliente, sum(receita) AS gasto FROM t_vendas WHERE data {_PERIOD} GROUP BY 1)
      WHERE {{}} AND id_cliente IN (SELECT id_cliente FROM s_clientes))"""
    sql["check_segments"] = _with(
        _checks(
            ("segmento_desconhecido", "segmentos", "count(*) FILTER (segmento_cliente NOT IN ('VIP','TOP_TIER','REGULAR'))", "=", "0"),
            ("vip_abaixo_do_limite", "segmentos", "count(*) FILTER (segmento_cliente = 'VIP' AND receita < 3000000)", "=", "0"),
            ("total_de_clientes", "segmentos", "count(*)", "=", people_count),
            ("clientes_VIP", "segmentos", seg.format("VIP"), "=", rich.format("gasto >= 3000000")),
            ("clientes_TOP_TIER", "segmentos", seg.format("TOP_TIER"), "=", rich.format("gasto >= 1000000 AND gasto < 3000000")),
            ("clientes_REGULAR", "segmentos", seg.format("REGULAR"), "=", people_count + " - " + rich.format("gasto >= 1000000")),
        ),
        "segmentos", "s_clientes", "t_vendas",
    )
    sql["check_detail"] = _with(
        _checks(
            ("vendas_sem_segmento_ou_regiao", "detalhe", "count(*) FILTER (segmento_cliente IS NULL OR regiao IS NULL)", "=", "0"),
            ("linhas_vendas_detalhadas", "detalhe", "count(*)", "=", "(SELECT count(*) FROM t_vendas)"),
            ("vendas_ecommerce", "detalhe", "count(*) FILTER (canal_venda = 'ecommerce')", "=",
             "(SELECT count(*) FROM t_vendas WHERE canal_venda = 'ecommerce')"),
        ),
        "detalhe", "t_vendas",
    )
    sql["check_prices"] = _with(
        _checks(
            ("produtos_na_visao_de_precos", "posicao_precos", "count(*)", "=", "(SELECT count(*) FROM s_produtos)"),
            ("mais_caros_que_todos", "posicao_precos", "count(*) FILTER (classificacao_preco = 'MAIS_CARO_QUE_TODOS')", "=",
             """(SELECT count(*) FROM s_produtos JOIN (SELECT id_produto, max(preco_concorrente) AS maximo FROM s_precos GROUP BY 1)
               USING (id_produto) WHERE preco_atual > maximo)"""),
            ("produtos_com_preco_suspeito", "posicao_precos", "count(*) FILTER (possui_preco_suspeito)", "=",
             "(SELECT count(DISTINCT id_produto) FROM s_precos WHERE preco_suspeito)"),
        ),
        "posicao_precos", "s_precos",
    )
    total = "(SELECT sum(receita) FROM t_vendas)"
    sql["check_same_revenue"] = _with(
        " UNION ALL ".join(
            f"""SELECT 'receita_{name}' AS verificacao, sum(receita) = {total} AS aprovada,
              cast(sum(receita) as double) AS observado, cast({total} as double) AS esperado FROM {table}"""
            for name, table in [("vendas_temporais", "t_vendas"), ("vendas_produtos", "produto_vendas"),
                                ("vendas_detalhadas", "detalhe"), ("clientes_segmentacao", "segmentos")]
        ),
        "produto_vendas", "detalhe",
    )
    inside = f"data {_PERIOD}"
    known = "id_cliente IN (SELECT id_cliente FROM s_clientes)"
    sql["check_reconciliation"] = _with(
        f"""SELECT cast(sum(receita) as double) AS receita_vendas,
          cast(coalesce(sum(receita) FILTER ({inside} AND {known}), 0) as double) AS receita_segmentos,
          cast(coalesce(sum(receita) FILTER (NOT ({inside})), 0) as double) AS fora_do_periodo,
          cast(coalesce(sum(receita) FILTER ({inside} AND NOT ({known})), 0) as double) AS cliente_desconhecido
        FROM t_vendas""",
        "t_vendas",
        "s_clientes",
    )
    silver_rows = {"clientes": "s_clientes", "produtos": "s_produtos", "vendas": "t_vendas", "preco_competidores": "s_precos"}
    sql["check_row_counts"] = _with(_rows(silver_rows), "s_clientes", "s_precos", "t_vendas")

    # Profiles, sinks, refresh, stream
    sql["profile_vendas"] = _with(
        _profile("b_vendas", ["id_venda", "data_venda", "id_cliente", "id_produto", "quantidade", "preco_unitario",
                              "canal_venda", "l_shipdate", "l_suppkey"]), "b_vendas")
    sql["profile_produtos"] = _with(
        _profile("b_produtos", ["id_produto", "nome_produto", "categoria", "marca", "preco_atual", "data_criacao"]),
        "b_produtos",
    )
    sql["profile_clientes"] = _with(_profile("b_clientes", ["id_cliente", "nome_cliente", "estado"]), "b_clientes")
    sql["profile_preco_competidores"] = _with(
        _profile("b_precos", ["id_produto", "nome_concorrente", "data_coleta", "preco_concorrente"]), "b_precos"
    )
    exact = ["id_venda", "data_venda", "id_cliente", "id_produto", "quantidade", "preco_unitario", "canal_venda", "l_shipdate", "l_suppkey"]
    sql["profile_vendas_distinct"] = _with(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS coluna, count(*) AS linhas, count(*) - count({c}) AS nulos, count(DISTINCT {c}) AS distintos,
              cast(min({c}) as varchar) AS minimo, cast(max({c}) as varchar) AS maximo FROM b_vendas"""
            for c in exact
        ),
        "b_vendas",
    )
    sql["source_three_part_name"] = """SELECT l_linenumber, count(*) AS linhas, cast(sum(cast(l_quantity as bigint)) as bigint) AS itens
      FROM lineitem GROUP BY 1"""
    sql["source_catalog_tables"] = _with(_rows(silver_rows), "s_clientes", "s_precos", "t_vendas")
    sql["sink_clustered_by_date"] = _with(
        f"""SELECT data, count(*) AS total_vendas, cast(sum(receita) as double) AS receita FROM t_vendas
        WHERE data {_PERIOD} GROUP BY data""",
        "t_vendas",
    )
    comments = {
        "id_produto": "Código do produto",
        "nome_produto": "Nome do produto em forma de título; ''Produto nao cadastrado'' fora do catálogo",
        "categoria": "Categoria do produto, ou ''Não cadastrado''",
        "marca": "Marca do produto, ou ''Não cadastrado''",
        "faixa_preco": "PREMIUM, MEDIO ou BASICO conforme o preço atual; ''Não cadastrado'' fora do catálogo",
        "produto_cadastrado": "Se o produto consta do catálogo",
        "total_vendas": "Número de vendas",
        "itens_vendidos": "Soma das quantidades",
        "receita": "Soma de quantidade vezes preço unitário",
        "ticket_medio": "Receita média por venda",
    }
    sql["documented_columns"] = _with(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS coluna, count(*) AS linhas, count(*) - count({c}) AS nulos, '{t}' AS comentario
              FROM produto_vendas"""
            for c, t in comments.items()
        ),
        "produto_vendas",
    )
    hours = f"(SELECT DISTINCT data, hora, canal_venda FROM t_vendas WHERE data {_PERIOD})"
    marts = {
        "clientes_segmentacao": "segmentos",
        "vendas_temporais": hours,
        "vendas_produtos": "produto_vendas",
        "vendas_detalhadas": "detalhe",
        "precos_competitividade": "posicao_precos",
        "vendas_totais": "(SELECT count(*) FROM t_vendas)",
        "clientes_por_regiao": "(SELECT DISTINCT regiao FROM s_clientes WHERE regiao IS NOT NULL)",
        "produtos_por_faixa_preco": "(SELECT DISTINCT faixa_preco FROM s_produtos)",
        "preco_competitivo_resumo": "(SELECT count(*) FROM s_precos)",
    }
    counted = {f"silver.{n}": t for n, t in silver_rows.items()} | {f"gold.{n}": t for n, t in marts.items()}
    sql["refresh_row_counts"] = _with(_rows(counted), "produto_vendas", "detalhe", "posicao_precos")
    sql["published_revenue"] = _with(
        "SELECT canal_venda, count(*) AS total_vendas, cast(sum(receita) as double) AS receita FROM t_vendas GROUP BY 1", "t_vendas"
    )
    sql["check_documentation"] = " UNION ALL ".join(
        f"SELECT '{v}_{n}' AS verificacao, true AS aprovada, {seen}::DOUBLE AS observado, {seen}::DOUBLE AS esperado"
        for n in marts
        for v, seen in (("colunas_sem_comentario", 0), ("tabela_com_linhas", 1))
    )
    sql["expectations_dropped_prices"] = _with(
        """SELECT nome_concorrente, count(*) AS precos, cast(sum(preco_concorrente) as double) AS soma FROM s_precos
        WHERE id_produto IS NOT NULL AND NOT preco_suspeito GROUP BY 1""",
        "s_precos",
    )
    sql["stream_hourly_sales"] = """SELECT cast(ts as date) AS data, cast(hour(ts) as int) AS hora,
        CASE WHEN user_id % 2 = 0 THEN 'ecommerce' ELSE 'loja_fisica' END AS canal_venda, count(*) AS total_vendas,
        count(*) AS itens_vendidos, cast(sum(cast(value as decimal(18,2))) as double) AS receita,
        count(DISTINCT user_id) AS clientes_unicos
      FROM events WHERE event_type = 'purchase' GROUP BY 1, 2, 3"""
    sql["stream_hourly_sales_refreshes"] = sql["stream_hourly_sales"]
    sql["daily_refresh_temporais"] = sql["gold_vendas_temporais"]
    sql["daily_refresh_produtos"] = sql["gold_vendas_produtos"]
    sql["daily_refresh_totais"] = sql["gold_vendas_totais"]
    return sql
