"""Comments of the marts' columns, written into their schemas."""

from __future__ import annotations

_PRODUCT = {
    "id_produto": "Código do produto",
    "nome_produto": "Nome do produto em forma de título; 'Produto nao cadastrado' fora do catálogo",
    "categoria": "Categoria do produto, ou 'Não cadastrado'",
    "marca": "Marca do produto, ou 'Não cadastrado'",
    "faixa_preco": "PREMIUM, MEDIO ou BASICO conforme o preço atual; 'Não cadastrado' fora do catálogo",
    "produto_cadastrado": "Se o produto consta do catálogo",
}
_CUSTOMER = {
    "id_cliente": "Código do cliente",
    "nome_cliente": "Nome do cliente em forma de título, sem tratamento",
    "estado": "Sigla da UF do cliente",
    "nome_estado": "Nome da UF; nulo se a sigla não existe",
    "regiao": "Região do país; nula se a sigla não existe",
    "segmento_cliente": "VIP, TOP_TIER ou REGULAR, pela receita no período",
}
_CALENDAR = {
    "data": "Dia da venda",
    "hora": "Hora da venda, de 0 a 23",
    "dia_semana_num": "Dia da semana, 1 = domingo",
    "dia_semana": "Nome do dia da semana",
    "canal_venda": "Canal da venda: ecommerce ou loja_fisica",
}
_SALES = {
    "total_vendas": "Número de vendas",
    "itens_vendidos": "Soma das quantidades",
    "receita": "Soma de quantidade vezes preço unitário",
    "ticket_medio": "Receita média por venda",
    "ranking_receita": "Posição geral por receita; empates pelo código",
}


def _pick(*groups: dict, **own: str) -> dict[str, str]:
    merged: dict[str, str] = {}
    for group in groups:
        merged.update(group)
    return {**merged, **own}


GOLD_COMMENTS = {
    "clientes_segmentacao": _pick(
        _CUSTOMER,
        _SALES,
        total_compras="Número de compras no período",
        receita="Receita do cliente no período; 0 para quem não comprou",
        primeira_compra="Primeira compra no período",
        ultima_compra="Última compra no período",
    ),
    "vendas_temporais": _pick(
        _CALENDAR,
        _SALES,
        clientes_unicos="Clientes distintos neste dia, hora e canal; não se soma entre linhas",
    ),
    "vendas_produtos": _pick(
        _PRODUCT,
        _SALES,
        ranking_na_categoria="Posição por receita dentro da categoria; empates pelo código",
    ),
    "vendas_detalhadas": _pick(
        _CALENDAR,
        _PRODUCT,
        _CUSTOMER,
        id_venda="Código da venda",
        data_venda="Momento da venda",
        quantidade="Itens desta venda",
        preco_unitario="Preço por item nesta venda",
        receita="Quantidade vezes preço unitário",
        venda_antes_do_cadastro="Se a venda é anterior à entrada do produto no catálogo",
    ),
    "precos_competitividade": _pick(
        _PRODUCT,
        nosso_preco="Nosso preço atual; 0 se não há preço",
        preco_medio_concorrentes="Média dos preços dos concorrentes, a centavos",
        preco_minimo_concorrentes="Menor preço entre os concorrentes",
        preco_maximo_concorrentes="Maior preço entre os concorrentes",
        total_concorrentes="Número de concorrentes com preço para o produto",
        diferenca_pct_vs_media="Distância percentual do nosso preço à média",
        diferenca_pct_vs_minimo="Distância percentual do nosso preço ao mínimo",
        classificacao_preco="Posição do nosso preço frente aos concorrentes",
        possui_preco_suspeito="Se algum concorrente está abaixo de 60% do nosso preço; nulo sem concorrentes",
        receita="Receita do produto no período",
        itens_vendidos="Itens vendidos no período",
    ),
    "vendas_totais": _pick(
        _SALES,
        receita_total="Receita de todas as vendas",
        vendas_produto_nao_cadastrado="Vendas de produtos fora do catálogo",
        vendas_antes_do_cadastro="Vendas anteriores à entrada do produto no catálogo",
    ),
    "clientes_por_regiao": _pick(
        regiao="Região do país", total_clientes="Clientes da região", ufs_presentes="UFs distintas com clientes"
    ),
    "produtos_por_faixa_preco": _pick(
        faixa_preco="PREMIUM, MEDIO ou BASICO",
        total_produtos="Produtos na faixa",
        preco_medio_faixa="Preço médio da faixa",
        min_preco_faixa="Menor preço da faixa",
        max_preco_faixa="Maior preço da faixa",
    ),
    "preco_competitivo_resumo": _pick(
        total_precos_competidores="Preços de concorrentes conhecidos",
        precos_suspeitos="Preços abaixo de 60% do nosso",
        preco_medio_concorrente="Preço médio dos concorrentes",
        min_preco_concorrente="Menor preço de concorrente",
        max_preco_concorrente="Maior preço de concorrente",
    ),
}
