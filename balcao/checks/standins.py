"""Raw retail tables and an audit log, derived from a generic star schema.

Each stand-in is one FROM clause and a set of named expressions. The text is
valid both in Spark SQL and in the SQL engine that checks the results.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class StandIn(NamedTuple):
    source: str
    columns: dict[str, str]

    def sql(self) -> str:
        chosen = ", ".join(f"{text} AS {name}" for name, text in self.columns.items())
        return f"SELECT {chosen} FROM {self.source}"




def padded(number: str, width: int) -> str:
    """A number as text with leading zeros, in full where it is longer than ``width``."""
    text = f"CAST({number} AS STRING)"
    return f"lpad({text},CAST(greatest({width},length({text})) AS INT),'0')"


BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

STANDINS = {
    # Every line item, numbered where order and line repeat: rows that tie are equal, so
    # any numbering of them gives the same table. Line and copy stay below the factors.
    "v_linha": StandIn(
        "(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, "
        "l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
        "l_shipdate) AS copia FROM lineitem) l",
        {
            "venda_id": "(l_orderkey*1009+l_linenumber)*1013+copia",
            "l_orderkey": "l_orderkey",
            "produto_id": "l_partkey",
            "quantidade": "CAST(l_quantity AS INT)",
            "desconto_pct": "CAST(round(l_discount*100) AS INT)",
        },
    ),
    "fornecedores": StandIn(
        "supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey",
        {
            "fornecedor_id": "s_suppkey",
            "razao_social": "s_name",
            "cnpj": (
                "lpad(CAST(s_suppkey%100 AS STRING),2,'0')||'.'"
                "||lpad(CAST(s_suppkey%1000 AS STRING),3,'0')||'.678/0001-'"
                "||lpad(CAST(s_suppkey%97 AS STRING),2,'0')"
            ),
            "regiao": "r_name",
            "cidade": "n_name",
            "contato": "'+55 11 '||" + padded("s_suppkey", 8),
            "segmento": (
                "CASE s_suppkey%4 WHEN 0 THEN 'Eletrônicos' WHEN 1 THEN 'Alimentos' "
                "WHEN 2 THEN 'Livros' ELSE 'Diversos' END"
            ),
        },
    ),
    "clientes": StandIn(
        "customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey",
        {
            "cliente_id": "c_custkey",
            "nome": "c_name",
            "tipo_cliente": "CASE WHEN c_custkey%20<17 THEN 'PF' ELSE 'PJ' END",
            "documento": (
                "CASE WHEN c_custkey%20<17 THEN lpad(CAST(c_custkey%1000 AS STRING),3,'0')"
                "||'.456.789-'||lpad(CAST(c_custkey%97 AS STRING),2,'0') "
                "ELSE '12.345.678/0001-'||lpad(CAST(c_custkey%97 AS STRING),2,'0') END"
            ),
            "regiao": "r_name",
            "cidade": "n_name",
            "data_cadastro": "CAST(DATE '1995-01-01' + CAST(c_custkey%900 AS INT) AS DATE)",
            "ativo": "CAST(CASE WHEN c_custkey%20<17 THEN 1 ELSE 0 END AS INT)",
            "score_credito": (
                "CASE WHEN c_custkey%50<>0 "
                "THEN CAST(3000+(c_custkey*37)%7001 AS DOUBLE)/CAST(10 AS DOUBLE) END"
            ),
        },
    ),
    "produtos": StandIn(
        "part",
        {
            "produto_id": "p_partkey",
            "nome": "p_name||' '||CAST(p_partkey AS STRING)",
            "categoria": "p_type",
            "preco": "p_retailprice",
            "estoque": "CAST((p_partkey*7+p_size)%25 AS INT)",
            "peso_kg": "CAST(p_size AS DOUBLE)/CAST(2 AS DOUBLE)",
            "fornecedor_id": "p_partkey%110",
        },
    ),
    "cupons": StandIn(
        "part",
        {
            "cupom_id": "p_partkey+1",
            "codigo": "'CUP'||" + padded("p_partkey", 4),
            "tipo": "CASE WHEN p_partkey%2=0 THEN 'fixo' ELSE 'percentual' END",
            "valor": "CAST(5+p_size AS DOUBLE)",
            "validade_inicio": "CAST(DATE '1995-01-01'+CAST((p_partkey*13)%2000 AS INT) AS DATE)",
            "validade_fim": (
                "CAST(DATE '1995-01-01'"
                "+CAST((p_partkey*13)%2000+30+p_partkey%151 AS INT) AS DATE)"
            ),
            "categoria": "p_type",
            "uso_minimo": (
                "CAST(CASE WHEN p_partkey%10<3 THEN 0 ELSE 50+p_size*5 END AS DOUBLE)"
            ),
        },
    ),
    "vendas": StandIn(
        "v_linha v JOIN orders o ON v.l_orderkey=o.o_orderkey",
        {
            "venda_id": "v.venda_id",
            "cliente_id": "o.o_custkey",
            "produto_id": "v.produto_id",
            "quantidade": "v.quantidade",
            "desconto_pct": "v.desconto_pct",
            "cupom_id": "CASE WHEN v.venda_id%5=0 THEN o.o_custkey+1 END",
            "status": (
                "CASE o.o_orderstatus WHEN 'F' THEN 'CONCLUIDO' "
                "WHEN 'P' THEN 'CANCELADO' ELSE 'PENDENTE' END"
            ),
            "canal": (
                "CASE o.o_orderkey%5 WHEN 2 THEN 'loja_fisica' WHEN 3 THEN 'app' "
                "WHEN 4 THEN 'televendas' ELSE 'online' END"
            ),
            "data_venda": "CAST(o.o_orderdate AS DATE)",
            "hora_venda": (
                "lpad(CAST(6+v.venda_id%17 AS STRING),2,'0')||':'"
                "||lpad(CAST(v.venda_id%60 AS STRING),2,'0')||':'"
                "||lpad(CAST((v.venda_id*7)%60 AS STRING),2,'0')"
            ),
        },
    ),
    "fretes": StandIn(
        "vendas",
        {
            "frete_id": "venda_id",
            "venda_id": "venda_id",
            "valor_frete": "CAST(1200+(venda_id*7919)%3300 AS DOUBLE)/CAST(100 AS DOUBLE)",
            "prazo_dias": "CAST(1+venda_id%15 AS INT)",
            "transportadora": (
                "CASE venda_id%4 WHEN 0 THEN 'Correios' WHEN 1 THEN 'Jadlog' "
                "WHEN 2 THEN 'Total Express' ELSE 'Braspress' END"
            ),
            "status_entrega": (
                "CASE status WHEN 'CONCLUIDO' THEN 'ENTREGUE' "
                "WHEN 'CANCELADO' THEN 'CANCELADO' ELSE 'EM_TRANSITO' END"
            ),
        },
    ),
    "pagamentos": StandIn(
        "(SELECT v.venda_id, v.status, CASE substr(o.o_orderpriority,1,1) "
        "WHEN '3' THEN 'cartao_credito' WHEN '4' THEN 'boleto' WHEN '5' THEN 'cartao_debito' "
        "ELSE 'pix' END AS metodo FROM vendas v JOIN v_linha l ON v.venda_id=l.venda_id "
        "JOIN orders o ON l.l_orderkey=o.o_orderkey) t",
        {
            "pagamento_id": "venda_id",
            "venda_id": "venda_id",
            "metodo": "metodo",
            "parcelas": (
                "CAST(CASE WHEN metodo='cartao_credito' THEN 1+venda_id%12 ELSE 1 END AS INT)"
            ),
            "valor_pago": "CAST(100+venda_id%9000 AS DOUBLE)",
            "status_pagamento": (
                "CASE status WHEN 'CONCLUIDO' THEN 'PAGO' "
                "WHEN 'CANCELADO' THEN 'ESTORNADO' ELSE 'PENDENTE' END"
            ),
        },
    ),
    "avaliacoes": StandIn(
        "vendas WHERE status='CONCLUIDO'",
        {
            "avaliacao_id": "venda_id",
            "venda_id": "CASE WHEN venda_id%101=0 THEN -venda_id ELSE venda_id END",
            "nota": "CAST(1+(venda_id*31)%5 AS INT)",
            "comentario": (
                "CASE WHEN (venda_id*31)%5>=3 THEN 'Recomendo!' "
                "WHEN (venda_id*31)%5=2 THEN 'Produto razoável.' ELSE 'Não recomendo.' END"
            ),
            "data": "CAST(data_venda+CAST(1+venda_id%30 AS INT) AS DATE)",
        },
    ),
    "pipeline_audit": StandIn(
        "events",
        {
            "run_id": "'r'||lpad(CAST(day(ts) AS STRING),2,'0')",
            "timestamp": "ts",
            "camada": "CASE event_id%3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END",
            "tabela": (
                "CASE user_id%4 WHEN 0 THEN 'vendas' WHEN 1 THEN 'clientes' "
                "WHEN 2 THEN 'produtos' ELSE 'fretes' END"
            ),
            "fase": (
                "CASE WHEN event_type IN ('view','click') THEN 'leitura' "
                "WHEN event_type='purchase' THEN 'escrita' ELSE 'transformacao' END"
            ),
            "duracao_ms": "CAST(round(value*100) AS BIGINT)",
            "row_count": (
                "CASE WHEN event_type='purchase' THEN (event_id*7919)%100000 ELSE 0 END"
            ),
            # Every third day fails now and then, every third skips, and the rest succeed.
            "status": (
                "CASE WHEN event_id%23=0 AND day(ts)%3=0 THEN 'erro' "
                "WHEN event_id%29=0 AND day(ts)%3=2 THEN 'ignorado' ELSE 'sucesso' END"
            ),
            "erro_mensagem": "CASE WHEN event_id%23=0 AND day(ts)%3=0 THEN 'falha '||event_type END",
        },
    ),
}


def inputs_of(source: str) -> list[str]:
    """Tables that a FROM clause names, out of the ones known here."""
    words = set(re.findall(r"[a-z_]+", source))
    return [name for name in [*BASE_TABLES, *STANDINS] if name in words]
