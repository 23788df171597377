"""Synthetic retail tables, each one Spark job over a table of keys.

Every value is a draw from the key, so a table of any size comes out the same
however it is partitioned, and a companion table can be generated on its own.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from balcao.functions import money
from balcao.functions.draws import Draws
from balcao.operators.lookups import assign_valid_coupon, lookup_default
from balcao.operators.ordered import position, with_prefix
from balcao.operators.sampling import sample_exact
from balcao.operators.spreading import shuffled
from balcao.plans import datagen_values as V
from balcao.plans.silver import SALE_DONE
from balcao.sources import schemas
from balcao.sources.drops import export_csv
from balcao.sources.scratch import stage

SEED = 42
ID = "id"


def gen_keys(spark: SparkSession, n: int) -> DataFrame:
    """Keys 1 to n."""
    return spark.range(1, n + 1)


def _columns(table: str) -> list[str]:
    return [part.split()[0] for part in schemas.RAW[table].split(", ")]


def _day(offset: Column) -> Column:
    return F.date_add(F.lit(V.FIRST_DAY), offset.cast("int"))


def _numbered(prefix: str, width: int) -> Column:
    number = F.col(ID).cast("string")
    full = F.greatest(F.lit(width), F.length(number))
    return F.concat(F.lit(prefix + " "), F.lpad(number, full, F.lit("0")))


def _digits(draws: Draws, name: str, width: int) -> Column:
    return F.lpad(F.pmod(draws.bits(name), F.lit(10**width)).cast("string"), width, "0")


def _person_id(draws: Draws) -> Column:
    blocks = [_digits(draws, f"cpf{i}", 3) for i in range(3)]
    return F.concat(F.concat_ws(".", *blocks), F.lit("-"), _digits(draws, "cpf3", 2))


def _company_id(draws: Draws) -> Column:
    blocks = [_digits(draws, f"cnpj{i}", width) for i, width in enumerate([2, 3, 3])]
    branch = F.concat_ws("-", F.lit("0001"), _digits(draws, "cnpj3", 2))
    return F.concat_ws("/", F.concat_ws(".", *blocks), branch)


def masked_id(draws: Draws, kind: Column) -> Column:
    """Tax id in the mask of a person or of a company."""
    return F.when(kind == "PF", _person_id(draws)).otherwise(_company_id(draws))


def gen_fornecedores(keys: DataFrame, seed: int = SEED, portable: bool = False) -> DataFrame:
    d = Draws(ID, seed, portable)
    placed = keys.withColumn("regiao", d.choice("regiao", V.REGIONS))
    return placed.select(
        F.col(ID).alias("fornecedor_id"),
        _numbered("Fornecedor", 6).alias("razao_social"),
        _company_id(d).alias("cnpj"),
        "regiao",
        d.choice_by("cidade", F.col("regiao"), V.CITIES).alias("cidade"),
        F.concat(F.lit("+55 11 "), _digits(d, "contato", 8)).alias("contato"),
        d.choice("segmento", V.SEGMENTS).alias("segmento"),
    )


def gen_clientes(keys: DataFrame, seed: int = SEED + 1, portable: bool = False) -> DataFrame:
    d = Draws(ID, seed, portable)
    drawn = keys.withColumns(
        {
            "regiao": d.choice("regiao", V.REGIONS),
            "tipo_cliente": d.weighted("tipo", V.PERSON_WEIGHTS),
        }
    )
    is_person = F.col("tipo_cliente") == "PF"
    return drawn.select(
        F.col(ID).alias("cliente_id"),
        F.when(is_person, _numbered("Cliente", 9)).otherwise(_numbered("Empresa", 9)).alias("nome"),
        "tipo_cliente",
        masked_id(d, F.col("tipo_cliente")).alias("documento"),
        "regiao",
        d.choice_by("cidade", F.col("regiao"), V.CITIES).alias("cidade"),
        _day(d.integer("cadastro", 0, V.DAYS)).alias("data_cadastro"),
        d.weighted("ativo", V.ACTIVE_WEIGHTS).alias("ativo"),
        F.round(d.uniform("score", *map(float, V.SCORES)), 1).alias("score_credito"),
    )


def gen_produtos(
    keys: DataFrame, n_suppliers: int, seed: int = SEED + 3, portable: bool = False
) -> DataFrame:
    d = Draws(ID, seed, portable)
    category = F.col("categoria")
    prefix = d.choice_by("prefixo", category, V.NAME_PREFIXES)
    model = d.integer("modelo", 100, 999).cast("string")
    return keys.withColumn("categoria", d.choice("categoria", V.CATEGORIES)).select(
        F.col(ID).alias("produto_id"),
        F.concat_ws(" ", prefix, model).alias("nome"),
        "categoria",
        F.round(d.uniform_by("preco", category, V.PRICE_RANGES), 2).alias("preco"),
        d.integer("estoque", *V.STOCK).alias("estoque"),
        F.round(d.uniform("peso", *map(float, V.WEIGHT_KG)), 2).alias("peso_kg"),
        d.key_in("fornecedor", n_suppliers).alias("fornecedor_id"),
    )


def gen_cupons(keys: DataFrame, seed: int = SEED + 2, portable: bool = False) -> DataFrame:
    d = Draws(ID, seed, portable)
    shortest, longest = V.COUPON_LENGTH
    drawn = keys.withColumns(
        {
            "tipo": d.choice("tipo", V.COUPON_KINDS),
            "categoria": d.choice("categoria", [*V.CATEGORIES, V.ANY_CATEGORY]),
            "_inicio": d.integer("inicio", 0, V.DAYS - longest),
        }
    )
    end = F.least(F.col("_inicio") + d.integer("duracao", shortest, longest), F.lit(V.DAYS))
    fixed = F.round(d.uniform("valor", *map(float, V.COUPON_AMOUNT)), 2)
    percent = d.integer("percentual", *V.COUPON_PERCENT).cast("double")
    minimum = F.round(d.uniform("minimo", *map(float, V.COUPON_MINIMUM)), 2)
    return drawn.select(
        F.col(ID).alias("cupom_id"),
        F.concat(
            F.upper(F.substring("categoria", 1, 4)), d.integer("codigo", 1000, 9999).cast("string")
        ).alias("codigo"),
        "tipo",
        F.when(F.col("tipo") == V.COUPON_KINDS[0], fixed).otherwise(percent).alias("valor"),
        _day(F.col("_inicio")).alias("validade_inicio"),
        _day(end).alias("validade_fim"),
        "categoria",
        F.when(d.chance("livre", V.COUPON_FREE_CHANCE), 0.0).otherwise(minimum).alias("uso_minimo"),
    )


def _day_slots(spark: SparkSession) -> DataFrame:
    """Each day as many times as its month weighs, numbered from 0.

    A uniform slot then is a weighted day. The table has one row per unit of
    weight over a fixed calendar, so numbering it in one task is safe.
    """
    weight = F.element_at(
        F.create_map(*[F.lit(part) for pair in V.MONTH_WEIGHTS.items() for part in pair]),
        F.month("dia"),
    )
    days = spark.range(V.DAYS).select(_day(F.col("id")).alias("dia"))
    repeated = days.select("dia", F.explode(F.sequence(F.lit(1), weight)).alias("vez"))
    slot = F.row_number().over(Window.orderBy("dia", "vez")) - 1
    return repeated.select("dia", slot.cast("bigint").alias("casa"))


def total_day_weight() -> int:
    days = (V.FIRST_DAY + timedelta(days=offset) for offset in range(V.DAYS))
    return sum(V.MONTH_WEIGHTS[day.month] for day in days)


def seasonal_date(df: DataFrame, draws: Draws, name: str) -> DataFrame:
    """Add a date column drawn with the months' weights."""
    slots = _day_slots(df.sparkSession).withColumnRenamed("dia", name)
    drawn = df.withColumn("casa", F.pmod(draws.bits(name), F.lit(total_day_weight())))
    return drawn.join(F.broadcast(slots), "casa").drop("casa")


def gen_vendas(
    keys: DataFrame,
    n_customers: int,
    n_products: int,
    coupons: DataFrame,
    seed: int = SEED + 4,
    portable: bool = False,
) -> DataFrame:
    d = Draws(ID, seed, portable)
    clock = F.concat_ws(
        ":",
        *[
            F.lpad(d.integer(name, low, high).cast("string"), 2, "0")
            for name, (low, high) in {
                "hora": V.HOURS, "minuto": (0, 59), "segundo": (0, 59)
            }.items()
        ],
    )
    sold = seasonal_date(keys, d, "data_venda").withColumns(
        {
            "venda_id": F.col(ID),
            "cliente_id": d.key_in("cliente", n_customers),
            "produto_id": d.key_in("produto", n_products),
            "quantidade": d.weighted("quantidade", V.QUANTITY_WEIGHTS),
            "desconto_pct": d.choice("desconto", V.DISCOUNTS),
            "status": d.choice("status", V.STATUSES),
            "canal": d.choice("canal", V.CHANNELS),
            "hora_venda": clock,
        }
    )
    with_coupon = assign_valid_coupon(
        sold,
        coupons,
        d.chance("usa_cupom", V.COUPON_CHANCE),
        d.bits("cupom"),
        row_key="venda_id",
    )
    return with_coupon.select(*_columns("vendas"))


def gen_fretes(
    sales: DataFrame, customers: DataFrame, seed: int = SEED + 5, portable: bool = False
) -> DataFrame:
    """One delivery per sale; far regions pay more and wait longer."""
    d = Draws("venda_id", seed, portable)
    region, status = F.col("regiao"), F.col("status")
    factor = F.lit(1.0)
    for name, times in V.FREIGHT_FACTORS.items():
        factor = F.when(region == name, times).otherwise(factor)
    price = F.least(d.uniform("frete", *map(float, V.FREIGHT)) * factor, F.lit(float(V.FREIGHT_CAP)))
    promised = F.when(
        region.isin(V.FAR_REGIONS), d.integer("prazo_longe", *V.FAR_LEAD_DAYS)
    ).otherwise(d.integer("prazo", *V.LEAD_DAYS))
    taken = d.integer("prazo_real", 1, F.greatest(F.lit(2), promised - 3))
    located = lookup_default(
        sales.select("venda_id", "cliente_id", "status"),
        customers, "cliente_id", "regiao", V.DEFAULT_REGION, row_key="venda_id",
    )
    return located.select(
        F.col("venda_id").alias("frete_id"),
        "venda_id",
        F.round(price, 2).alias("valor_frete"),
        F.when(status == SALE_DONE, taken).otherwise(promised).alias("prazo_dias"),
        d.choice("transportadora", V.CARRIERS).alias("transportadora"),
        F.when(status == SALE_DONE, "ENTREGUE")
        .when(status == "CANCELADO", "CANCELADO")
        .otherwise(d.choice("entrega", V.OPEN_DELIVERY))
        .alias("status_entrega"),
    )


def gen_pagamentos(
    sales: DataFrame,
    products: DataFrame,
    shipping: DataFrame,
    seed: int = SEED + 6,
    portable: bool = False,
) -> DataFrame:
    """One payment per sale, of goods and freight; only credit cards take instalments."""
    d = Draws("venda_id", seed, portable)
    status = F.col("status")
    priced = lookup_default(
        sales.select("venda_id", "produto_id", "quantidade", "desconto_pct", "status"),
        products, "produto_id", "preco", V.DEFAULT_PRICE, row_key="venda_id",
    )
    billed = priced.join(shuffled(shipping.select("venda_id", "valor_frete")), "venda_id")
    drawn = billed.withColumn("metodo", d.weighted("metodo", V.METHOD_WEIGHTS))
    return drawn.select(
        F.col("venda_id").alias("pagamento_id"),
        "venda_id",
        "metodo",
        F.when(F.col("metodo") == V.INSTALMENT_METHOD, d.integer("parcelas", *V.INSTALMENTS))
        .otherwise(1)
        .alias("parcelas"),
        money.invoice_value(
            F.col("preco"), F.col("quantidade"), F.col("desconto_pct"), F.col("valor_frete")
        ).alias("valor_pago"),
        F.when(status == SALE_DONE, "PAGO")
        .when(status == "CANCELADO", d.choice("devolucao", V.VOID_PAYMENT))
        .otherwise(d.choice("aberto", V.OPEN_PAYMENT))
        .alias("status_pagamento"),
    )


def gen_avaliacoes(
    sales: DataFrame, seed: int = SEED + 7, portable: bool = False, share: float = V.REVIEW_SHARE
) -> DataFrame:
    """Reviews of an exact share of the completed sales, numbered by sale."""
    d = Draws("venda_id", seed, portable)
    done = sales.filter(F.col("status") == SALE_DONE).select("venda_id", "data_venda")
    chosen = sample_exact(done, "venda_id", share, seed, portable)
    rated = with_prefix(chosen, [], ["venda_id"], avaliacao_id=position()).withColumn(
        "nota", d.choice("nota", V.RATINGS)
    )
    mood = (
        F.when(F.col("nota") >= 4, "positivo").when(F.col("nota") == 3, "neutro").otherwise("negativo")
    )
    written = F.date_add("data_venda", d.integer("demora", *V.REVIEW_DELAY))
    return rated.select(
        "avaliacao_id",
        "venda_id",
        "nota",
        d.choice_by("comentario", mood, V.COMMENTS).alias("comentario"),
        F.least(written, _day(F.lit(V.DAYS))).alias("data"),
    )


def gen_all(
    spark: SparkSession, volumes: dict[str, int] | None = None, seed: int = SEED
) -> dict[str, DataFrame]:
    """All eight tables as stored intermediate results, ready to export."""
    n = V.VOLUMES | (volumes or {})
    keys = {name: gen_keys(spark, count) for name, count in n.items()}
    made = {
        "fornecedores": gen_fornecedores(keys["fornecedores"], seed),
        "clientes": stage(gen_clientes(keys["clientes"], seed + 1), "clientes"),
        "cupons": stage(gen_cupons(keys["cupons"], seed + 2), "cupons"),
        "produtos": stage(gen_produtos(keys["produtos"], n["fornecedores"], seed + 3), "produtos"),
    }
    sales = gen_vendas(keys["vendas"], n["clientes"], n["produtos"], made["cupons"], seed + 4)
    made["vendas"] = stage(sales, "vendas")
    made["fretes"] = stage(gen_fretes(made["vendas"], made["clientes"], seed + 5), "fretes")
    made["pagamentos"] = gen_pagamentos(made["vendas"], made["produtos"], made["fretes"], seed + 6)
    made["avaliacoes"] = gen_avaliacoes(made["vendas"], seed + 7)
    return made


def export_all(tables: dict[str, DataFrame], folder: str, stamp: str) -> None:
    """One CSV drop per table, all with the same stamp."""
    for name, df in tables.items():
        export_csv(df, folder, name, stamp)


def invariants(
    sales: DataFrame,
    shipping: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    coupons: DataFrame,
    share: float = V.REVIEW_SHARE,
) -> DataFrame:
    """Violations per rule that generated tables must keep; all counts should be 0."""
    bad = lambda condition: F.count_if(~F.coalesce(condition, F.lit(False)))
    done = F.col("status") == SALE_DONE
    joined = sales.join(
        shipping.drop("frete_id"), "venda_id", "full"
    ).join(payments.drop("pagamento_id"), "venda_id", "full")
    per_sale = joined.agg(
        bad(F.col("status").isNotNull() & F.col("status_entrega").isNotNull()).alias("um_frete"),
        bad(F.col("status").isNotNull() & F.col("status_pagamento").isNotNull()).alias("um_pagamento"),
        bad(~done | (F.col("status_entrega") == "ENTREGUE")).alias("concluido_entregue"),
        bad(~done | (F.col("status_pagamento") == "PAGO")).alias("concluido_pago"),
        bad((F.col("parcelas") == 1) | (F.col("metodo") == V.INSTALMENT_METHOD)).alias("parcelas"),
        bad(F.col("valor_frete").between(V.FREIGHT[0], V.FREIGHT_CAP)).alias("faixa_frete"),
    )
    used = sales.filter(F.col("cupom_id").isNotNull())
    validity = coupons.select("cupom_id", "validade_inicio", "validade_fim")
    per_coupon = used.join(shuffled(validity), "cupom_id", "left").agg(
        bad(
            F.col("data_venda").between(F.col("validade_inicio"), F.col("validade_fim"))
        ).alias("cupom_valido")
    )
    state = sales.select("venda_id", "status", "data_venda")
    per_review = reviews.join(shuffled(state), "venda_id", "left").agg(
        bad(done).alias("avaliada_concluida"),
        bad(F.col("data") >= F.col("data_venda")).alias("avaliada_depois"),
        (F.count(F.lit(1)) - F.max("avaliacao_id")).alias("numeracao"),
        F.count(F.lit(1)).alias("_feitas"),
    )
    wanted = sales.agg(F.floor(F.count_if(done) * share).alias("_esperadas"))
    sampled = per_review.agg(F.max("_feitas").alias("_feitas")).unionByName(
        wanted.select((-F.col("_esperadas")).alias("_feitas"))
    ).agg(F.sum("_feitas").alias("amostra_exata"))
    reports = [per_sale, per_coupon, per_review.drop("_feitas"), sampled]
    return reduce(DataFrame.unionByName, [_as_rows(report) for report in reports])


def _as_rows(report: DataFrame) -> DataFrame:
    rules = [
        F.struct(F.lit(c).alias("regra"), F.col(c).cast("bigint").alias("violacoes"))
        for c in report.columns
    ]
    return report.select(F.inline(F.array(*rules)))
