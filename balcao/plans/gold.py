"""Business marts over the cleaned tables.

Each mart can be had on its own from the cleaned sales. A whole run goes through
four summaries instead, which read the sales once each and serve ten marts: a row per
product, per customer, per combination of a few small domains, and per month, channel
and range of customer ids. The last holds bitmaps of customers, from which distinct ones
are counted exactly per month or channel. The coupons read the sales themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.functions import cleaning
from balcao.operators.summaries import (
    Mart,
    Measure,
    amount,
    distinct,
    fine_summary,
    known,
    latest,
    mean,
    roll_up,
    share_pct,
    summarize,
    units,
)
from balcao.operators.typing import require_key

SALES = {"qtd_vendas": known("venda_id")}
BUYERS = {"qtd_clientes_unicos": distinct("cliente_id")}
ITEMS = {"qtd_itens": units("quantidade")}
REVENUE = {"receita_total": amount("valor_total")}
TICKET = {"ticket_medio": mean("valor_total")}
FREIGHT = {"receita_frete": amount("valor_frete")}
FREIGHT_MEAN = {"frete_medio": mean("valor_frete")}

SALES_MARTS = {
    "receita_mensal": Mart(["ano_mes"], SALES | BUYERS | REVENUE | TICKET | FREIGHT),
    "receita_categoria": Mart(["categoria"], SALES | ITEMS | REVENUE | FREIGHT, "receita_total"),
    "receita_regiao": Mart(["regiao"], SALES | BUYERS | REVENUE | TICKET, "receita_total"),
    "receita_canal": Mart(
        ["canal"], SALES | BUYERS | REVENUE | TICKET | FREIGHT_MEAN, "receita_total"
    ),
    "top_produtos": Mart(
        ["produto_id", "nome", "categoria"],
        SALES | ITEMS | REVENUE | TICKET,
        "receita_total",
        top=20,
    ),
    "ranking_transportadoras": Mart(
        ["transportadora"],
        {"qtd_entregas": known("venda_id"), "prazo_medio_dias": mean("prazo_dias")}
        | FREIGHT_MEAN
        | FREIGHT,
        "qtd_entregas",
    ),
    "vendas_turno": Mart(["turno"], SALES | REVENUE | TICKET),
    "metodos_pagamento": Mart(
        ["metodo"],
        SALES
        | REVENUE
        | {
            "parcelas_medio": mean("parcelas"),
            "pct_parcelada": share_pct("parceladas", "parcelas > 1", of="venda_id"),
        },
        "receita_total",
    ),
}

TOP_CUSTOMERS = Mart(
    ["cliente_id", "nome_cliente"],
    {"qtd_compras": known("venda_id"), "total_gasto": amount("valor_total")} | TICKET,
    "total_gasto",
    top=20,
)
REVIEWS = {"qtd_avaliacoes": known("avaliacao_id"), "nota_media": mean("nota")}
BY_CATEGORY = Mart(["categoria"], REVIEWS, "nota_media")
BY_REGION = Mart(["regiao"], REVIEWS, "nota_media")
COUPONS = Mart(
    ["cupom_id"],
    {"qtd_usos": known("venda_id"), "receita_com_cupom": amount("valor_total")} | TICKET,
    "qtd_usos",
    grows=True,
)


def _rfm(as_of: date | str | None) -> Mapping[str, Measure]:
    since = lambda day: F.datediff(cleaning.reference_day(as_of), day)
    return {
        "recencia_dias": latest("data_venda", since),
        "frequencia": known("venda_id"),
        "monetario": amount("valor_total"),
    }


# Keys of the summaries, and the sales marts that each one serves. Name and category
# belong to a product, the region to a customer: each summary has a row per entity. The
# third has a row per carrier, part of day and payment method, whatever the data, the last
# one per month, channel and 32,768 customer ids.
BY_PRODUCT = "_resumo_produto"
BY_CUSTOMER = "_resumo_cliente"
BY_KIND = "_resumo_tipo"
BY_MONTH = "_resumo_mes_canal"
SUMMARY_KEYS = {
    BY_PRODUCT: ["produto_id", "nome", "categoria"],
    BY_CUSTOMER: ["cliente_id", "regiao"],
    BY_KIND: ["transportadora", "turno", "metodo"],
    BY_MONTH: ["ano_mes", "canal"],
}
SERVED_BY = {
    "receita_regiao": BY_CUSTOMER,
    "receita_categoria": BY_PRODUCT,
    "top_produtos": BY_PRODUCT,
    "ranking_transportadoras": BY_KIND,
    "vendas_turno": BY_KIND,
    "metodos_pagamento": BY_KIND,
    "receita_mensal": BY_MONTH,
    "receita_canal": BY_MONTH,
}


def product_summary(sales: DataFrame) -> DataFrame:
    return fine_summary(sales, SUMMARY_KEYS[BY_PRODUCT], _measures_served(BY_PRODUCT))


def customer_summary(sales: DataFrame) -> DataFrame:
    per_customer = [*TOP_CUSTOMERS.measures.values(), *_rfm(None).values()]
    measures = [*_measures_served(BY_CUSTOMER), *per_customer]
    return fine_summary(sales, SUMMARY_KEYS[BY_CUSTOMER], measures)


def kind_summary(sales: DataFrame) -> DataFrame:
    return fine_summary(sales, SUMMARY_KEYS[BY_KIND], _measures_served(BY_KIND))


def month_summary(sales: DataFrame) -> DataFrame:
    return fine_summary(sales, SUMMARY_KEYS[BY_MONTH], _measures_served(BY_MONTH))


def _measures_served(summary: str) -> list[Measure]:
    marts = [SALES_MARTS[name] for name, source in SERVED_BY.items() if source == summary]
    return [measure for mart in marts for measure in mart.measures.values()]


Grouping = Callable[[DataFrame, list[str], Mapping[str, Measure]], DataFrame]


def top_clientes(sales: DataFrame, customers: DataFrame, group: Grouping = summarize) -> DataFrame:
    """Summed per customer first, so one row per customer meets the names.

    With ``group=roll_up``, ``sales`` is the customer summary.
    """
    spent = group(sales, ["cliente_id"], TOP_CUSTOMERS.measures)
    names = customers.select("cliente_id", F.col("nome").alias("nome_cliente"))
    return TOP_CUSTOMERS.arrange(spent.join(names, "cliente_id"))


def clientes_rfm(
    sales: DataFrame,
    customers: DataFrame,
    as_of: date | str | None = None,
    group: Grouping = summarize,
) -> DataFrame:
    """Recency in days, frequency and money spent per customer."""
    scored = group(sales, ["cliente_id"], _rfm(as_of))
    who = customers.select("cliente_id", "nome", "regiao", "faixa_score")
    return scored.join(who, "cliente_id")


def top_clientes_of_summary(fine: DataFrame, customers: DataFrame) -> DataFrame:
    return top_clientes(fine, customers, roll_up)


def clientes_rfm_of_summary(
    fine: DataFrame, customers: DataFrame, as_of: date | str | None = None
) -> DataFrame:
    return clientes_rfm(fine, customers, as_of, roll_up)


def satisfacao_categoria(reviews: DataFrame) -> DataFrame:
    """Reviews without a surviving sale form the group of the null category."""
    return BY_CATEGORY.of(reviews)


def satisfacao_regiao(reviews: DataFrame, customers: DataFrame) -> DataFrame:
    """Partial sums per customer meet the regions, not single reviews."""
    with_sale = require_key(reviews, "cliente_id")
    per_customer = fine_summary(with_sale, ["cliente_id"], BY_REGION.measures.values())
    located = per_customer.join(customers.select("cliente_id", "regiao"), "cliente_id")
    return BY_REGION.of_summary(located)


def estoque_critico(products: DataFrame) -> DataFrame:
    """Products out of stock."""
    gone = products.filter(~F.col("disponivel"))
    columns = ["produto_id", "nome", "categoria", "estoque", "razao_social"]
    return gone.select(*columns)


def in_order(name: str, mart: DataFrame) -> DataFrame:
    """A growing mart in the order of its report. They are published unsorted."""
    orders = {
        "clientes_rfm": [F.desc("monetario"), F.col("cliente_id")],
        "estoque_critico": [F.col("estoque"), F.col("produto_id")],
    }
    return COUPONS.in_order(mart) if name == "cupons_performance" else mart.orderBy(*orders[name])


def cupons_performance(sales: DataFrame, coupons: DataFrame) -> DataFrame:
    used = summarize(require_key(sales, "cupom_id"), ["cupom_id"], COUPONS.measures)
    about = coupons.select("cupom_id", "codigo", "tipo", "valor", "categoria")
    return COUPONS.arrange(used.join(about, "cupom_id"))
