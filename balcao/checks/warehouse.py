"""Layered stand-in tables over one folder of given tables.

The raw and cleaned tables are written once per session to the shared scratch
folder and read back, as in the real layout: marts read published tables, and
their filters and column choices reach the file scan.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from balcao.checks.standins import BASE_TABLES, STANDINS, StandIn, inputs_of
from balcao.plans.runs import BRONZE, GOLD, GOLD_JOBS, SILVER, SILVER_JOBS, Job
from balcao.sources.scratch import stage

AS_OF = "2001-12-31"

#: What numbers the line items of one key. Further columns of the stand-in's order would only part
#: rows that are equal in all of its columns.
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]

_OPEN: dict[tuple[str, str], "Warehouse"] = {}
_LOCK = threading.RLock()


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._raw: dict[str, DataFrame] = {}
        self._clean: dict[str, DataFrame] = {}
        self._summaries: dict[str, DataFrame] = {}
        self.generated: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        """A given table, or a stand-in derived from given tables."""
        with _LOCK:
            if name not in self._raw:
                if name in BASE_TABLES:
                    self._raw[name] = self.given(name)
                elif name == "vendas":
                    self._raw[name] = self._sales().drop("o_orderpriority")
                else:
                    plans = {"v_linha": self._lines, "pagamentos": self._payments}
                    self._raw[name] = stage(plans.get(name, lambda: self.derived(name))(), name)
            return self._raw[name]

    def _lines(self) -> DataFrame:
        """Plan of the numbered line items, dealt out by order."""
        items = self.given("lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER).repartition("l_orderkey")
        copies = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*LINE_ORDER)
        numbered = items.withColumn("copia", F.row_number().over(copies))
        return numbered.select(*[F.expr(text).alias(name) for name, text in STANDINS["v_linha"].columns.items()])

    def _sales(self) -> DataFrame:
        """The sales, written once with the priority of their orders, which payments need.

        Line items meet their orders where they are numbered, so they are shuffled once.
        """
        if "_vendas" not in self._raw:
            source, columns = STANDINS["vendas"]
            wider = StandIn(source, {**columns, "o_orderpriority": "o.o_orderpriority"})
            self._raw["_vendas"] = stage(self._planned(wider, {"v_linha": self._lines(), "orders": self.raw("orders")}), "vendas")
        return self._raw["_vendas"]

    def _payments(self) -> DataFrame:
        """Plan of the payments: lines and orders that a sale meets are those written with the sales."""
        source, columns = STANDINS["pagamentos"]
        lines = "JOIN v_linha l ON v.venda_id=l.venda_id JOIN orders o ON l.l_orderkey=o.o_orderkey"
        met = StandIn(source.replace(lines, "JOIN v_linha o ON v.venda_id=o.venda_id"), columns)
        known = self._sales().select("venda_id", "o_orderpriority")
        return self._planned(met, {"vendas": self.raw("vendas"), "v_linha": known})

    def derived(self, name: str) -> DataFrame:
        """Plan of a stand-in over its (stored) inputs."""
        return self._planned(STANDINS[name], {table: self.raw(table) for table in inputs_of(STANDINS[name].source)})

    def _planned(self, standin: StandIn, inputs: dict[str, DataFrame]) -> DataFrame:
        text = standin.sql()
        for table in inputs:
            text = _rename_table(text, table, "{" + f"{table}__bruta" + "}")
        return self.spark.sql(text, **{f"{table}__bruta": df for table, df in inputs.items()})

    def clean(self, name: str) -> DataFrame:
        """A cleaned table, written on first use."""
        with _LOCK:
            if name not in self._clean:
                self._clean[name] = stage(self.cleaned(name), f"{name}-limpa")
            return self._clean[name]

    def cleaned(self, name: str) -> DataFrame:
        """Plan of a cleaned table over its stored inputs."""
        return self.built(SILVER_JOBS[name])

    def summary(self, name: str) -> DataFrame:
        """A fine summary, written on first use."""
        with _LOCK:
            if name not in self._summaries:
                self._summaries[name] = stage(self.built(GOLD_JOBS[name]), name)
            return self._summaries[name]

    def built(self, job: Job) -> DataFrame:
        """Plan of a table over its stored inputs."""
        stored = {BRONZE: self.raw, SILVER: self.clean, GOLD: self.summary}
        inputs = [stored[layer](name) for layer, name in job.inputs]
        return job.build(*inputs, as_of=AS_OF) if job.dated else job.build(*inputs)


def _rename_table(text: str, table: str, replacement: str) -> str:
    return re.sub(rf"\b(FROM|JOIN) {table}\b", lambda found: f"{found[1]} {replacement}", text)


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, folder)
    with _LOCK:
        if key not in _OPEN:
            _OPEN[key] = Warehouse(spark, folder)
        return _OPEN[key]
