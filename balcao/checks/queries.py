"""Registered queries: one per operator and table job, over a folder of given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.checks.warehouse import AS_OF, Warehouse, open_warehouse
from balcao.functions import cleaning, money
from balcao.operators import lookups
from balcao.operators.ordered import latest_n, latest_per_group
from balcao.operators.sampling import sample_exact
from balcao.operators.typing import REJECTED, cast_columns, require_key
from balcao.plans import audit, audit_state, datagen, gold, runs, silver
from balcao.plans.runs import DIRECT_GOLD_JOBS, GOLD_JOBS, SILVER_JOBS, Job
from balcao.sources import drops, layers, schemas
from balcao.sources.scratch import fresh_path, stage

EARLIER_DAY = "1997-06-30"
OLD_STAMP, MIDDLE_STAMP, NEW_STAMP = "20240101T000000", "20240101T180000", "20240102T120000"

Query = Callable[[Warehouse], DataFrame]


def raw_table(name: str) -> Query:
    return lambda w: w.raw(name)


# --- sources and sinks -------------------------------------------------------------


def csv_roundtrip(w: Warehouse) -> DataFrame:
    folder = fresh_path(w.spark, "csv")
    drops.export_csv(w.raw("vendas"), folder, "vendas", NEW_STAMP)
    return drops.pick_drop(w.spark, folder, "vendas", schemas.RAW["vendas"])


def _two_drops(w: Warehouse) -> str:
    """An older drop without the open sales, and a newer one with all of them."""
    folder = fresh_path(w.spark, "drops")
    settled = w.raw("vendas").filter(F.col("status") != "PENDENTE")
    drops.export_csv(settled, folder, "vendas", OLD_STAMP)
    drops.export_csv(w.raw("vendas"), folder, "vendas", NEW_STAMP)
    return folder


def pick_drop(which: str) -> Query:
    return lambda w: drops.pick_drop(
        w.spark, _two_drops(w), "vendas", schemas.RAW["vendas"], which
    )


def pick_drop_strict(w: Warehouse) -> DataFrame:
    """Every choice of drop in a folder that also holds backups, a stray name and a compressed drop.

    Only the older drop is plain text: three more plain copies of the sales would be most of what is written.
    """
    folder = fresh_path(w.spark, "drops")
    sales = w.raw("vendas")
    drops.export_csv(sales.filter(F.col("status") != "PENDENTE"), folder, "vendas", OLD_STAMP)
    others = (f"vendas_{NEW_STAMP}.csv.bak", f"vendas_{OLD_STAMP}.csv.gz.tmp", "vendas_1_oldT5.csv")
    for name in (*others, f"vendas_{NEW_STAMP}.csv.gz"):
        sales.write.option("header", True).option("compression", "gzip").csv(f"{folder}/{name}")
    picked = [
        drops.pick_drop(w.spark, folder, "vendas", schemas.RAW["vendas"], which).withColumn("escolha", F.lit(which))
        for which in ("latest", "first", "all")
    ]
    return reduce(DataFrame.unionByName, picked)


def pick_drifted(on_error: str) -> Query:
    """All drops of the sales, whose headers differ: another order, missing and added columns.

    Of rows that are rejected as their drop lacks a column, only that they are is compared.
    """

    def picked(w: Warehouse) -> DataFrame:
        folder = fresh_path(w.spark, "drops")
        sales = w.raw("vendas")
        backwards = sales.filter(F.col("status") != "PENDENTE").select(*reversed(sales.columns))
        drops.export_csv(backwards, folder, "vendas", OLD_STAMP)
        fewer = sales.filter(F.col("quantidade") > 25).drop("canal", "hora_venda")
        drops.export_csv(fewer, folder, "vendas", MIDDLE_STAMP)
        first, *rest = sales.columns
        added = sales.select(first, (F.col("venda_id") % 7).alias("loja"), *rest, F.lit("x,y").alias("nota"))
        drops.export_csv(added, folder, "vendas", NEW_STAMP)
        found = drops.pick_drop(w.spark, folder, "vendas", schemas.RAW["vendas"], "all", on_error)
        if drops.REJECTED in found.columns:
            return found.withColumn(drops.REJECTED, F.col(drops.REJECTED).isNotNull())
        return found

    return picked


def pick_inferred(w: Warehouse) -> DataFrame:
    """Two drops of the products without a declared schema, the older one without the stock."""
    folder = fresh_path(w.spark, "drops")
    drops.export_csv(w.raw("produtos").drop("estoque"), folder, "produtos", OLD_STAMP)
    drops.export_csv(w.raw("produtos"), folder, "produtos", NEW_STAMP)
    return drops.pick_drop(w.spark, folder, "produtos", which="all")


def drop_missing(w: Warehouse) -> DataFrame:
    """What a raw layer logs when only the sales have a drop."""
    folder, root = fresh_path(w.spark, "drops"), fresh_path(w.spark, "faltas")
    drops.export_csv(w.raw("vendas"), folder, "vendas", NEW_STAMP)
    runs.run_bronze(w.spark, folder, root, "r1")
    return runs.read_audit(w.spark, root).select("camada", "tabela", "fase", "row_count", "status")


def drop_report(w: Warehouse) -> DataFrame:
    """The report, with sizes that depend on the writer reduced to whether there are any."""
    report = drops.drop_report(w.spark, _two_drops(w))
    return report.select(
        "tabela", "carimbo", (F.col("arquivos") >= 1).alias("tem_arquivos"), (F.col("bytes") > 0).alias("tem_bytes")
    )


def publish_roundtrip(w: Warehouse) -> DataFrame:
    """Second version of a table, made from its own first version."""
    root = fresh_path(w.spark, "camadas")
    layers.publish(w.raw("vendas"), root, "bronze", "vendas")
    first = layers.read_table(w.spark, root, "bronze", "vendas")
    layers.publish(first.filter(F.col("status") == "CONCLUIDO"), root, "bronze", "vendas")
    return layers.read_table(w.spark, root, "bronze", "vendas")


def publish_history(w: Warehouse) -> DataFrame:
    root = fresh_path(w.spark, "camadas")
    names = ["vendas", "fretes", "clientes"]
    layers.publish_all(w.spark, {n: w.raw(n) for n in names}, root, "bronze")
    layers.publish(
        w.raw("vendas").filter(F.col("status") == "CONCLUIDO"), root, "bronze", "vendas"
    )
    history = [layers.table_history(w.spark, root, "bronze", n, n=None) for n in names]
    together = history[0].unionByName(history[1]).unionByName(history[2])
    return together.select("camada", "tabela", "versao", "operacao", "linhas")


def describe_tables(w: Warehouse) -> DataFrame:
    return layers.describe_tables({name: w.raw(name) for name in schemas.RAW})


def sample_tables(w: Warehouse) -> DataFrame:
    """Five rows of every raw table, by the key that their lines hold."""
    keys = {name: schema.split()[0] for name, schema in schemas.RAW.items()}
    lines = layers.sample_rows({name: w.raw(name) for name in keys}, seed=7, keys=keys)
    key = F.coalesce(*[F.when(F.col("tabela") == name, F.get_json_object("linha", f"$.{key}")) for name, key in keys.items()])
    return lines.select("tabela", key.cast("bigint").alias("chave"))


def row_counts(w: Warehouse) -> DataFrame:
    return layers.row_counts({name: w.raw(name) for name in schemas.RAW})


def audit_append(w: Warehouse) -> DataFrame:
    """The log appended in two halves, read back under the declared schema."""
    path = fresh_path(w.spark, "auditoria")
    log = w.raw("pipeline_audit").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    layers.append(log.filter(F.col("status") == audit.OK), path)
    layers.append(log.filter(F.col("status") != audit.OK), path)
    back = w.spark.read.schema(schemas.AUDIT).parquet(path)
    return back.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def audit_append_rows(w: Warehouse) -> DataFrame:
    """One run's records, a row per layer, table and phase, appended layer by layer as a run does."""
    path = fresh_path(w.spark, "auditoria")
    log = w.raw("pipeline_audit").filter(F.col("run_id") == "r01")
    records = log.groupBy("run_id", "camada", "tabela", "fase").agg(
        F.min("timestamp").cast("timestamp").alias("timestamp"),
        F.sum("duracao_ms").alias("duracao_ms"),
        F.sum("row_count").alias("row_count"),
        F.min("status").alias("status"),
        F.max("erro_mensagem").alias("erro_mensagem"),
    )
    names = [part.split()[0] for part in schemas.AUDIT.split(", ")]
    rows = [tuple(row[name] for name in names) for row in records.collect()]  # tables times phases
    for layer in (runs.BRONZE, runs.SILVER, runs.GOLD):
        audit.audit_append(w.spark, [row for row in rows if row[names.index("camada")] == layer], path)
    back = w.spark.read.schema(schemas.AUDIT).parquet(path)
    return back.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def audit_by_fold(state: str) -> Query:
    """A question answered from its state, after three folds of a log whose parts come in no order."""

    def answered(w: Warehouse) -> DataFrame:
        root = fresh_path(w.spark, "estado")
        log = f"{root}/{runs.AUDIT_LOG}"
        rows = w.raw("pipeline_audit").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        for part in range(3):
            layers.append(rows.filter(F.pmod(F.xxhash64("timestamp", "duracao_ms"), F.lit(3)) == part), log)
            audit_state.fold(w.spark, root, log)
        found = audit_state.STATES[state].answer(audit_state.state_table(w.spark, root, state))
        return found.withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz")) if "run_ts" in found.columns else found

    return answered


def audit_quantiles(w: Warehouse) -> DataFrame:
    """Whether the ranks of folded p95 values keep to their error, by counting the log around them."""
    estimates = audit_by_fold("quantis")(w)
    phase = ["camada", "tabela", "fase"]
    done = audit.successes(w.raw("pipeline_audit")).filter(F.col("duracao_ms").isNotNull())
    around = done.join(estimates, phase).groupBy(*phase, "qtd_sucessos").agg(
        F.avg((F.col("duracao_ms") < F.col("duracao_p95_ms")).cast("int")).alias("abaixo"),
        F.avg((F.col("duracao_ms") <= F.col("duracao_p95_ms")).cast("int")).alias("ate"),
    )
    kept = (F.col("abaixo") <= 0.95 + audit.RANK_ERROR) & (F.col("ate") >= 0.95 - audit.RANK_ERROR)
    return around.select(*phase, "qtd_sucessos", kept.alias("dentro_do_erro"))


def silver_quarantine(w: Warehouse) -> DataFrame:
    """Good and rejected shipments of a cleaned layer, from raw ones with unreadable lead times."""
    root = fresh_path(w.spark, "quarentena")
    days = F.when(F.col("venda_id") % 97 == 0, "?").otherwise(F.col("prazo_dias").cast("string"))
    layers.publish(w.raw("fretes").withColumn("prazo_dias", days), root, runs.BRONZE, "fretes")
    runs.run_silver(w.spark, root, "r1", AS_OF, on_error="quarantine")
    good = layers.read_table(w.spark, root, runs.SILVER, "fretes")
    bad = layers.read_table(w.spark, root, runs.SILVER, f"fretes{runs.REJECTS}")
    bad = bad.withColumn("motivo", F.array_join(REJECTED, ",")).drop(REJECTED)
    return good.withColumn("motivo", F.lit("")).unionByName(bad)


# --- cleaning and filters ----------------------------------------------------------


def cast_text(w: Warehouse) -> DataFrame:
    """Sales as text, some of it unreadable."""
    unreadable = F.concat(F.lit("?"), F.col("quantidade").cast("string"))
    return w.raw("vendas").select(
        "venda_id",
        F.when(F.col("venda_id") % 89 == 0, "ontem")
        .otherwise(F.col("data_venda").cast("string"))
        .alias("data_venda"),
        F.when(F.col("venda_id") % 97 == 0, unreadable)
        .otherwise(F.col("quantidade").cast("string"))
        .alias("quantidade"),
        F.col("desconto_pct").cast("string").alias("desconto_pct"),
    )


TEXT_TYPES = {"data_venda": "date", "quantidade": "int", "desconto_pct": "double"}


def cast_null(w: Warehouse) -> DataFrame:
    return cast_columns(cast_text(w), TEXT_TYPES, on_error="null")


def cast_quarantine(w: Warehouse) -> DataFrame:
    typed = cast_columns(cast_text(w), TEXT_TYPES, on_error="quarantine")
    rejected = typed.filter(F.size(REJECTED) > 0)
    return rejected.select("venda_id", F.array_join(REJECTED, ",").alias("colunas"))


def digits_only(w: Warehouse) -> DataFrame:
    return w.raw("clientes").select(
        "cliente_id", cleaning.digits_only(F.col("documento")).alias("documento")
    )


def score_band(w: Warehouse) -> DataFrame:
    return w.raw("clientes").select(
        "cliente_id",
        "score_credito",
        cleaning.score_band(F.col("score_credito")).alias("faixa_score"),
    )


def part_of_day(w: Warehouse) -> DataFrame:
    clock = F.when(F.col("venda_id") % 53 != 0, F.col("hora_venda"))
    return w.raw("vendas").select("venda_id", cleaning.part_of_day(clock).alias("turno"))


def active_on(w: Warehouse) -> DataFrame:
    start, end = F.col("validade_inicio"), F.col("validade_fim")
    return w.raw("cupons").select(
        "cupom_id",
        cleaning.active_on(start, end, AS_OF).alias("ativo"),
        cleaning.active_on(start, end, EARLIER_DAY).alias("ativo_antes"),
    )


def flags(w: Warehouse) -> DataFrame:
    return w.raw("pagamentos").select(
        "pagamento_id", cleaning.flag_gt(F.col("parcelas"), 1).alias("eh_parcelado")
    )


def stock_flags(w: Warehouse) -> DataFrame:
    return w.raw("produtos").select(
        "produto_id", cleaning.flag_gt(F.col("estoque"), 0).alias("disponivel")
    )


def line_value(w: Warehouse) -> DataFrame:
    priced = w.raw("vendas").join(w.raw("produtos").select("produto_id", "preco"), "produto_id")
    value = money.line_value(F.col("preco"), F.col("quantidade"), F.col("desconto_pct"))
    return priced.select("venda_id", value.alias("valor_total"))


def month_key(w: Warehouse) -> DataFrame:
    return w.raw("vendas").select(
        "venda_id", cleaning.month_key(F.col("data_venda")).alias("ano_mes")
    )


def required_key(w: Warehouse) -> DataFrame:
    return require_key(w.raw("vendas"), "cupom_id").select("venda_id", "cupom_id")


def status_equal(w: Warehouse) -> DataFrame:
    done = w.raw("vendas").filter(F.col("status") == silver.SALE_DONE)
    return done.select("venda_id", "status")


def status_not(w: Warehouse) -> DataFrame:
    """A null status is dropped along with the excluded one."""
    partly_known = w.raw("fretes").withColumn(
        "status_entrega", F.when(F.col("frete_id") % 59 != 0, F.col("status_entrega"))
    )
    kept = partly_known.filter(F.col("status_entrega") != silver.DELIVERY_VOID)
    return kept.select("frete_id", "status_entrega")


def flag_false(w: Warehouse) -> DataFrame:
    return w.clean("produtos").filter(~F.col("disponivel")).select("produto_id", "disponivel")


def positive_rows(w: Warehouse) -> DataFrame:
    return w.raw("pipeline_audit").filter(F.col("row_count") > 0).select(
        "run_id", "timestamp", "row_count"
    )


# --- joins -------------------------------------------------------------------------


def purchase_stats_left(w: Warehouse) -> DataFrame:
    who = w.raw("clientes").select("cliente_id", "nome")
    return silver.with_purchase_stats(who, w.raw("vendas"))


def supplier_left(w: Warehouse) -> DataFrame:
    what = w.raw("produtos").select("produto_id", "fornecedor_id")
    return silver.with_supplier(what, w.raw("fornecedores"))


def star_join(w: Warehouse) -> DataFrame:
    return silver.star_join(
        w.raw("vendas").select("venda_id", "cliente_id", "produto_id", "quantidade"),
        w.raw("produtos"),
        w.clean("clientes"),
        w.clean("fretes"),
        w.clean("pagamentos"),
    )


def review_left_chain(w: Warehouse) -> DataFrame:
    reviews = w.raw("avaliacoes").select("avaliacao_id", "venda_id")
    return silver.review_chain(reviews, w.clean("vendas"), w.raw("produtos"))


def lookup_default(w: Warehouse) -> DataFrame:
    sold = w.raw("vendas").select("venda_id", "cupom_id")
    return lookups.lookup_default(
        sold, w.raw("cupons"), "cupom_id", "codigo", "SEM CUPOM", row_key="venda_id"
    )


def coupon_interval_join(w: Warehouse) -> DataFrame:
    return lookups.valid_pairs_per_day(w.raw("vendas"), w.raw("cupons"))


def coupon_smallest(w: Warehouse) -> DataFrame:
    sold = w.raw("vendas").select("venda_id", "data_venda")
    return lookups.smallest_valid_coupon(sold, w.raw("cupons"))


def coupon_assigned(w: Warehouse) -> DataFrame:
    sold = w.raw("vendas").select("venda_id", "data_venda")
    eligible, pick = F.col("venda_id") % 5 == 0, F.col("venda_id") * 7919
    return lookups.assign_valid_coupon(
        sold, w.raw("cupons"), eligible, pick, row_key="venda_id"
    )


# --- ordered rows ------------------------------------------------------------------


def latest_row(w: Warehouse) -> DataFrame:
    newest_first = [F.desc("timestamp"), F.desc("duracao_ms")]
    last = latest_per_group(w.raw("pipeline_audit"), ["camada", "tabela"], newest_first)
    return last.select("camada", "tabela", "timestamp", "duracao_ms", "status")


def latest_rows(w: Warehouse) -> DataFrame:
    newest_first = [F.desc("timestamp"), F.desc("duracao_ms")]
    last = latest_n(w.raw("pipeline_audit"), ["camada", "tabela", "fase"], newest_first, 30)
    return last.select("camada", "tabela", "fase", "timestamp", "duracao_ms")


# --- generated data ----------------------------------------------------------------


def _keys(w: Warehouse, table: str, key: str) -> DataFrame:
    return w.given(table).select((F.col(key) + 1).alias("id"))


class Generated:
    """Generated tables with as many rows as the given ones, kept like raw tables."""

    def __init__(self, w: Warehouse):
        self.w = w

    def table(self, name: str) -> DataFrame:
        kept = self.w.generated
        if name not in kept:
            kept[name] = stage(self.plan(name), f"gerada-{name}")
        return kept[name]

    def plan(self, name: str) -> DataFrame:
        w = self.w
        if name == "fornecedores":
            return datagen.gen_fornecedores(_keys(w, "supplier", "s_suppkey"), portable=True)
        if name == "clientes":
            return datagen.gen_clientes(_keys(w, "customer", "c_custkey"), portable=True)
        if name == "produtos":
            suppliers = w.given("supplier").count()
            return datagen.gen_produtos(_keys(w, "part", "p_partkey"), suppliers, portable=True)
        if name == "cupons":
            return datagen.gen_cupons(_keys(w, "part", "p_partkey"), portable=True)
        if name == "vendas":
            return datagen.gen_vendas(
                w.raw("v_linha").select(F.col("venda_id").alias("id")),
                w.given("customer").count(),
                w.given("part").count(),
                self.table("cupons"),
                portable=True,
            )
        if name == "fretes":
            return datagen.gen_fretes(self.table("vendas"), self.table("clientes"), portable=True)
        if name == "pagamentos":
            return datagen.gen_pagamentos(
                self.table("vendas"), self.table("produtos"), self.table("fretes"), portable=True
            )
        return datagen.gen_avaliacoes(self.table("vendas"), portable=True)


def generated(name: str) -> Query:
    return lambda w: Generated(w).plan(name)


def gen_fast(w: Warehouse) -> DataFrame:
    """Sales drawn with Spark's own hash, summed by what the draws must respect."""
    keys = w.raw("v_linha").select(F.col("venda_id").alias("id"))
    sold = datagen.gen_vendas(
        keys, w.given("customer").count(), w.given("part").count(), Generated(w).table("cupons")
    )
    return sold.agg(
        F.count(F.lit(1)).alias("vendas"),
        F.count_if(~F.col("quantidade").between(1, 10)).alias("fora_quantidade"),
        F.count_if(~F.col("desconto_pct").isin(0, 5, 10, 15, 20)).alias("fora_desconto"),
        F.count_if(~F.col("data_venda").between("2022-01-01", "2024-06-18")).alias("fora_data"),
    )


def gen_invariants(w: Warehouse) -> DataFrame:
    made = Generated(w)
    names = ["vendas", "fretes", "pagamentos", "avaliacoes", "cupons"]
    return datagen.invariants(*[made.table(name) for name in names])


def exact_sample(w: Warehouse) -> DataFrame:
    done = w.raw("vendas").filter(F.col("status") == silver.SALE_DONE)
    return sample_exact(done, "venda_id", 0.7, seed=7, portable=True).select("venda_id")


# --- registry ----------------------------------------------------------------------


def _silver(name: str) -> Query:
    return lambda w: w.cleaned(name)


def _gold(job: Job) -> Query:
    return lambda w: w.built(job)


def _asked(question: Callable[..., DataFrame], **options) -> Query:
    return lambda w: question(w.raw("pipeline_audit"), **options)


# Marts that a whole run derives from the fine summaries.
SHARED = [*gold.SALES_MARTS, "top_clientes", "clientes_rfm"]

QUERIES: dict[str, Query] = {
    "csv_roundtrip": csv_roundtrip,
    "pick_latest_drop": pick_drop("latest"),
    "pick_first_drop": pick_drop("first"),
    "pick_all_drops": pick_drop("all"),
    "pick_drop_strict": pick_drop_strict,
    "pick_drifted_drops": pick_drifted("null"),
    "pick_drifted_quarantine": pick_drifted("quarantine"),
    "pick_inferred_drops": pick_inferred,
    "drop_missing": drop_missing,
    "drop_report": drop_report,
    "publish_roundtrip": publish_roundtrip,
    "publish_history": publish_history,
    "describe_tables": describe_tables,
    "row_counts": row_counts,
    "sample_tables": sample_tables,
    "cast_columns": cast_null,
    "cast_quarantine": cast_quarantine,
    "digits_only": digits_only,
    "score_band": score_band,
    "part_of_day": part_of_day,
    "active_on": active_on,
    "flags": flags,
    "stock_flags": stock_flags,
    "line_value": line_value,
    "month_key": month_key,
    "require_key": required_key,
    "status_equal": status_equal,
    "status_not": status_not,
    "flag_false": flag_false,
    "positive_rows": positive_rows,
    "purchase_stats_left": purchase_stats_left,
    "supplier_left": supplier_left,
    "star_join": star_join,
    "review_left_chain": review_left_chain,
    "coupon_interval_join": coupon_interval_join,
    "coupon_smallest": coupon_smallest,
    "coupon_assigned": coupon_assigned,
    "lookup_default": lookup_default,
    **{f"silver_{name}": _silver(name) for name in SILVER_JOBS},
    **{f"gold_{name}": _gold(job) for name, job in DIRECT_GOLD_JOBS.items()},
    **{f"gold_shared_{name}": _gold(GOLD_JOBS[name]) for name in SHARED},
    "audit_append": audit_append,
    "audit_append_rows": audit_append_rows,
    "silver_quarantine": silver_quarantine,
    "audit_run_summary": _asked(audit.run_summary),
    "audit_run_totals": _asked(audit.run_totals),
    "audit_volume_by_layer": _asked(audit.volume_by_layer),
    "audit_volume_level": _asked(audit.volumes),
    "audit_last_status": _asked(audit.last_status),
    "audit_failed_layers": _asked(audit.failed_layers),
    "audit_layer_series": _asked(audit.layer_series),
    "audit_phase_grid": _asked(audit.phase_grid),
    "audit_phase_trend": _asked(audit.phase_trend),
    "audit_phase_stats": _asked(audit.phase_stats),
    "audit_layer_totals": _asked(audit.layer_totals),
    "audit_layer_totals_latest": _asked(audit.layer_totals, latest_only=True),
    "audit_table_volumes": _asked(audit.table_volumes),
    "audit_folded_phase_stats": audit_by_fold("fases"),
    "audit_folded_layer_totals": audit_by_fold("totais"),
    "audit_folded_table_volumes": audit_by_fold("volumes"),
    "audit_folded_quantiles": audit_quantiles,
    "audit_sla_breaches": _asked(audit.sla_breaches),
    "running_max": _asked(audit.latest_mark),
    "latest_per_group": latest_row,
    "latest_n": latest_rows,
    **{f"gen_{name}": generated(name) for name in schemas.RAW},
    "gen_fast": gen_fast,
    "gen_invariants": gen_invariants,
    "exact_sample": exact_sample,
}


def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(open_warehouse(spark, str(folder)))
