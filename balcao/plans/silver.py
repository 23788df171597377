"""Cleaned and enriched tables, from raw ones.

Each job takes published inputs and returns one table; nothing runs until the
caller writes the result. ``on_error`` is passed on to ``cast_columns``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.functions import cleaning, money
from balcao.operators.spreading import left_lookup
from balcao.operators.typing import cast_columns, require_key

# States that decide which rows count.
SALE_DONE = "CONCLUIDO"
PAYMENT_DONE = "PAGO"
DELIVERY_VOID = "CANCELADO"


def fornecedores(raw: DataFrame) -> DataFrame:
    kept = require_key(raw, "fornecedor_id")
    return kept.withColumn("cnpj", cleaning.digits_only(F.col("cnpj")))


def cupons(raw: DataFrame, as_of: date | str | None = None, on_error: str = "raise") -> DataFrame:
    typed = cast_columns(
        require_key(raw, "cupom_id"),
        {
            "validade_inicio": "date",
            "validade_fim": "date",
            "valor": "double",
            "uso_minimo": "double",
        },
        on_error,
    )
    valid = cleaning.active_on(F.col("validade_inicio"), F.col("validade_fim"), as_of)
    return typed.withColumn("ativo", valid)


def fretes(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    # An unknown status is dropped along with the void one, as the comparison is null.
    kept = require_key(raw, "frete_id").filter(F.col("status_entrega") != DELIVERY_VOID)
    return cast_columns(kept, {"valor_frete": "double", "prazo_dias": "int"}, on_error)


def pagamentos(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    kept = require_key(raw, "pagamento_id").filter(F.col("status_pagamento") == PAYMENT_DONE)
    typed = cast_columns(kept, {"valor_pago": "double", "parcelas": "int"}, on_error)
    return typed.withColumn("eh_parcelado", cleaning.flag_gt(F.col("parcelas"), 1))


def purchase_stats(raw_sales: DataFrame) -> DataFrame:
    """Completed purchases and items per customer."""
    done = raw_sales.filter(F.col("status") == SALE_DONE)
    return done.groupBy("cliente_id").agg(
        F.count("venda_id").alias("qtd_compras"), F.sum("quantidade").alias("qtd_itens")
    )


def with_purchase_stats(customers: DataFrame, raw_sales: DataFrame) -> DataFrame:
    """Counters stay null for customers without completed sales."""
    return customers.join(purchase_stats(raw_sales), "cliente_id", "left")


def clientes(raw: DataFrame, raw_sales: DataFrame, on_error: str = "raise") -> DataFrame:
    typed = cast_columns(
        require_key(raw, "cliente_id"), {"data_cadastro": "date", "ativo": "boolean"}, on_error
    )
    labelled = typed.withColumns(
        {
            "documento": cleaning.digits_only(F.col("documento")),
            "faixa_score": cleaning.score_band(F.col("score_credito")),
        }
    )
    return with_purchase_stats(labelled, raw_sales)


def with_supplier(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    about = suppliers.select("fornecedor_id", "razao_social", "segmento")
    return left_lookup(products, about, "fornecedor_id", row_key="produto_id")


def produtos(raw: DataFrame, suppliers: DataFrame, on_error: str = "raise") -> DataFrame:
    typed = cast_columns(raw, {"preco": "double", "estoque": "int"}, on_error)
    stocked = typed.withColumn("disponivel", cleaning.flag_gt(F.col("estoque"), 0))
    return with_supplier(stocked, suppliers)


def star_join(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    shipping: DataFrame,
    payments: DataFrame,
) -> DataFrame:
    """Sales with all four companions; a sale that misses any of them is dropped.

    Shipping and payment share the sale id, so the sales are shuffled on it once
    for both, before the attributes of the smaller tables make the rows wider.
    """
    return (
        sales.join(
            shipping.select(
                "venda_id", "valor_frete", "prazo_dias", "transportadora", "status_entrega"
            ),
            "venda_id",
        )
        .join(payments.select("venda_id", "metodo", "parcelas"), "venda_id")
        .join(products.select("produto_id", "preco", "nome", "categoria"), "produto_id")
        .join(customers.select("cliente_id", "regiao", "faixa_score"), "cliente_id")
    )


def vendas(
    raw: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    shipping: DataFrame,
    payments: DataFrame,
    on_error: str = "raise",
) -> DataFrame:
    typed = cast_columns(
        raw.filter(F.col("status") == SALE_DONE),
        {"data_venda": "date", "quantidade": "int", "desconto_pct": "double"},
        on_error,
    )
    return star_join(typed, products, customers, shipping, payments).withColumns(
        {
            "turno": cleaning.part_of_day(F.col("hora_venda")),
            "valor_total": money.line_value(
                F.col("preco"), F.col("quantidade"), F.col("desconto_pct")
            ),
            "ano_mes": cleaning.month_key(F.col("data_venda")),
        }
    )


def review_chain(reviews: DataFrame, sales: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews with their sale and, through it, their product.

    Reviews whose sale did not survive keep nulls. Their product key is null too,
    and the second lookup spreads them over the tasks.
    """
    with_sale = left_lookup(
        reviews,
        sales.select("venda_id", "cliente_id", "produto_id", "valor_total", "ano_mes"),
        "venda_id",
        row_key="avaliacao_id",
    )
    named = products.select("produto_id", F.col("nome").alias("produto_nome"), "categoria")
    return left_lookup(with_sale, named, "produto_id", row_key="avaliacao_id")


def avaliacoes(
    raw: DataFrame, sales: DataFrame, products: DataFrame, on_error: str = "raise"
) -> DataFrame:
    typed = cast_columns(require_key(raw, "avaliacao_id"), {"data": "date", "nota": "int"}, on_error)
    return review_chain(typed, sales, products)
