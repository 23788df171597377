"""SQL counterparts of the registered queries, for an independent engine.

Each text reads only the given tables. Stand-ins, cleaned tables and generated
tables appear as common table expressions, included where a query names them.
"""

from __future__ import annotations

import re

from balcao.checks.queries import EARLIER_DAY, SHARED
from balcao.checks.standins import STANDINS
from balcao.checks.warehouse import AS_OF
from balcao.functions.draws import SCALE, slots
from balcao.plans import datagen
from balcao.plans import datagen_values as V
from balcao.plans.audit import SLA_MINUTES, SLA_RUN_MINUTES
from balcao.sources import schemas

AMOUNT = "DECIMAL(20,4)"


def r2(value: str, places: int = 2) -> str:
    """Half-up rounding of the shortest decimal text of a double."""
    text = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,12))"
    return f"CAST(round({text}, {places}) AS DOUBLE)"


def total(column: str) -> str:
    return r2(f"sum(CAST({column} AS {AMOUNT}))")


def mean(column: str) -> str:
    return r2(f"CAST(sum(CAST({column} AS {AMOUNT})) AS DOUBLE)/count({column})")


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def exact_line(price: str, units: str, pct: str) -> str:
    return (
        f"CAST({price} AS DECIMAL(14,4))*CAST({units} AS DECIMAL(9,0))"
        f"*CAST(100-{pct} AS DECIMAL(7,4))*CAST(0.01 AS DECIMAL(3,2))"
    )


BAND = (
    "CASE WHEN score_credito>=700 THEN 'bom' WHEN score_credito>=500 THEN 'regular' "
    "ELSE 'ruim' END"
)


def shift(clock: str) -> str:
    hour = f"CAST(substr({clock},1,2) AS INT)"
    return f"CASE WHEN {hour}<12 THEN 'manhã' WHEN {hour}<18 THEN 'tarde' ELSE 'noite' END"


def digits(column: str) -> str:
    return f"regexp_replace({column},'[^0-9]','','g')"


def active(day: str) -> str:
    return f"(DATE '{day}'>=validade_inicio AND DATE '{day}'<=validade_fim)"


COUPON_DAYS = (
    "SELECT c.cupom_id, d.dia AS data_venda FROM {coupons} c JOIN {days} d "
    "ON d.dia BETWEEN c.validade_inicio AND c.validade_fim"
)

CTES: dict[str, str] = {name: standin.sql() for name, standin in STANDINS.items()}
CTES |= {
    "s_fornecedores": f"SELECT * REPLACE ({digits('cnpj')} AS cnpj) FROM fornecedores",
    "s_cupons": f"SELECT *, {active(AS_OF)} AS ativo FROM cupons",
    "s_fretes": "SELECT * FROM fretes WHERE status_entrega<>'CANCELADO'",
    "s_pagamentos": (
        "SELECT *, parcelas>1 AS eh_parcelado FROM pagamentos WHERE status_pagamento='PAGO'"
    ),
    "s_compras": (
        "SELECT cliente_id, count(venda_id) AS qtd_compras, "
        f"{big('sum(quantidade)')} AS qtd_itens FROM vendas WHERE status='CONCLUIDO' GROUP BY 1"
    ),
    "s_clientes": (
        f"SELECT c.* REPLACE ({digits('documento')} AS documento, ativo=1 AS ativo), "
        f"{BAND} AS faixa_score, qtd_compras, qtd_itens "
        "FROM clientes c LEFT JOIN s_compras USING (cliente_id)"
    ),
    "s_produtos": (
        "SELECT p.*, estoque>0 AS disponivel, razao_social, segmento "
        "FROM produtos p LEFT JOIN s_fornecedores USING (fornecedor_id)"
    ),
    "s_vendas": (
        "SELECT v.* REPLACE (CAST(v.desconto_pct AS DOUBLE) AS desconto_pct), "
        f"{shift('hora_venda')} AS turno, p.preco, p.nome, p.categoria, c.regiao, c.faixa_score, "
        "f.valor_frete, f.prazo_dias, f.transportadora, f.status_entrega, g.metodo, g.parcelas, "
        f"CAST(round({exact_line('p.preco', 'v.quantidade', 'v.desconto_pct')},2) AS DOUBLE) "
        "AS valor_total, strftime(data_venda,'%Y-%m') AS ano_mes "
        "FROM vendas v JOIN s_produtos p USING (produto_id) JOIN s_clientes c USING (cliente_id) "
        "JOIN s_fretes f USING (venda_id) JOIN s_pagamentos g USING (venda_id) "
        "WHERE v.status='CONCLUIDO'"
    ),
    "s_avaliacoes": (
        "SELECT a.*, v.cliente_id, v.produto_id, v.valor_total, v.ano_mes, "
        "p.nome AS produto_nome, p.categoria FROM avaliacoes a "
        "LEFT JOIN s_vendas v ON a.venda_id=v.venda_id "
        "LEFT JOIN s_produtos p ON v.produto_id=p.produto_id"
    ),
    "dias_venda": "SELECT DISTINCT data_venda AS dia FROM vendas",
    "cupom_dias": COUPON_DAYS.format(coupons="cupons", days="dias_venda"),
    "cupom_vez": (
        "SELECT *, row_number() OVER (PARTITION BY data_venda ORDER BY cupom_id) AS vez, "
        "count(*) OVER (PARTITION BY data_venda) AS opcoes FROM cupom_dias"
    ),
    "runs_camada": (
        "SELECT run_id, camada, min(timestamp) AS inicio, max(timestamp) AS run_ts, "
        f"{big('sum(duracao_ms)')} AS duracao_total_ms, count(*) AS qtd_fases, "
        "CASE WHEN bool_or(status='erro') THEN 'erro' WHEN bool_or(status='ignorado') THEN 'ignorado' "
        "ELSE 'sucesso' END AS status "
        "FROM pipeline_audit GROUP BY run_id, camada"
    ),
    "volumes": (
        f"SELECT camada, run_id, {big('sum(row_count)')} AS linhas, "
        "CASE WHEN sum(row_count)>=2000000 THEN 'red' WHEN sum(row_count)>=500000 THEN 'yellow' "
        "ELSE 'green' END AS nivel FROM pipeline_audit WHERE fase='escrita' GROUP BY camada, run_id"
    ),
    "ultimas": (
        "SELECT camada, run_id, CASE status WHEN 'erro' THEN 1 WHEN 'ignorado' THEN 2 ELSE 0 END AS codigo, "
        "CASE status WHEN 'erro' THEN 'Erro' WHEN 'ignorado' THEN 'Ignorado' ELSE 'Sucesso' END AS rotulo "
        "FROM runs_camada "
        "QUALIFY row_number() OVER (PARTITION BY camada ORDER BY run_ts DESC, run_id DESC)=1"
    ),
    "totais_camada": (
        "SELECT camada, run_id, max(timestamp) AS run_ts, "
        f"{big('sum(duracao_ms) FILTER (status=' + repr('sucesso') + ')')} AS duracao_total_ms, "
        "count(DISTINCT tabela) FILTER (status='sucesso') AS qtd_tabelas_sucesso, "
        "count(DISTINCT tabela) FILTER (status='erro') AS qtd_tabelas_erro "
        "FROM pipeline_audit GROUP BY camada, run_id"
    ),
}


def against_run_before(source: str, group: str, value: str, before: str) -> str:
    change = f"({value}-{before})*100/nullif({before},0)"
    return (
        f"SELECT *, {r2(change)} AS variacao_vs_run_anterior_pct FROM (SELECT *, "
        f"lag({value} IGNORE NULLS) OVER (PARTITION BY {group} ORDER BY run_ts, run_id) "
        f"AS {before} FROM {source}) t"
    )


CTES["totais_comparados"] = against_run_before(
    "totais_camada", "camada", "duracao_total_ms", "duracao_anterior"
)


# --- generated tables --------------------------------------------------------------


class Drawn:
    """The draws of ``balcao.functions.draws`` in their portable form, as SQL text."""

    def __init__(self, key: str, seed: int):
        self.key, self.seed = key, seed

    def bits(self, name: str) -> str:
        text = f"md5('{self.seed}:{name}:'||CAST({self.key} AS VARCHAR))"
        return f"CAST('0x'||substr({text},1,13) AS BIGINT)"

    def unit(self, name: str) -> str:
        return f"({self.bits(name)}/CAST({SCALE} AS DOUBLE))"

    def uniform(self, name: str, low, high) -> str:
        low, high = f"CAST({low} AS DOUBLE)", f"CAST({high} AS DOUBLE)"
        return f"({low}+{self.unit(name)}*({high}-{low}))"

    def integer(self, name: str, low, high) -> str:
        return f"CAST({low}+{self.bits(name)}%({high}-{low}+1) AS INT)"

    def key_in(self, name: str, count: str) -> str:
        return f"({self.bits(name)}%{count}+1)"

    def choice(self, name: str, values: list) -> str:
        listed = ",".join(repr(v) for v in values)
        return f"([{listed}])[{self.bits(name)}%{len(values)}+1]"

    def choice_by(self, name: str, given: str, values: dict) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {self.choice(name, v)}" for k, v in values.items())
        return f"CASE {given} {cases} END"

    def uniform_by(self, name: str, given: str, ranges: dict) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {self.uniform(name, *v)}" for k, v in ranges.items())
        return f"CASE {given} {cases} END"

    def weighted(self, name: str, weights: dict) -> str:
        return self.choice(name, slots(weights))

    def digits(self, name: str, width: int) -> str:
        return f"lpad(CAST({self.bits(name)}%{10**width} AS VARCHAR),{width},'0')"


def day(offset: str) -> str:
    return f"CAST(DATE '{V.FIRST_DAY}'+CAST({offset} AS INT) AS DATE)"


def numbered(prefix: str, width: int) -> str:
    return f"'{prefix} '||repeat('0',CAST({width}-length(CAST(id AS VARCHAR)) AS INT))||CAST(id AS VARCHAR)"


def company_id(d: Drawn) -> str:
    a, b, c, e = [d.digits(f"cnpj{i}", w) for i, w in enumerate([2, 3, 3, 2])]
    return f"{a}||'.'||{b}||'.'||{c}||'/0001-'||{e}"


def person_id(d: Drawn) -> str:
    a, b, c, e = [d.digits(f"cpf{i}", w) for i, w in enumerate([3, 3, 3, 2])]
    return f"{a}||'.'||{b}||'.'||{c}||'-'||{e}"


def _generated() -> dict[str, str]:
    seed = datagen.SEED
    f, c, k, p = (Drawn("id", seed + i) for i in range(4))
    v, s, g, a = (
        Drawn("id", seed + 4),
        Drawn("venda_id", seed + 5),
        Drawn("venda_id", seed + 6),
        Drawn("venda_id", seed + 7),
    )
    weight = "CASE month(dia) " + " ".join(f"WHEN {m} THEN {w}" for m, w in V.MONTH_WEIGHTS.items()) + " END"
    factor = "CASE regiao " + " ".join(f"WHEN '{r}' THEN {x}" for r, x in V.FREIGHT_FACTORS.items()) + " ELSE 1 END"
    far = ",".join(repr(r) for r in V.FAR_REGIONS)
    promised = (
        f"CASE WHEN regiao IN ({far}) THEN {s.integer('prazo_longe', *V.FAR_LEAD_DAYS)} "
        f"ELSE {s.integer('prazo', *V.LEAD_DAYS)} END"
    )
    taken = s.integer("prazo_real", 1, "greatest(2,prometido-3)")
    freight_value = f"least({s.uniform('frete', *V.FREIGHT)}*CAST({factor} AS DOUBLE),{V.FREIGHT_CAP}.0)"
    mood = "CASE WHEN nota>=4 THEN 'positivo' WHEN nota=3 THEN 'neutro' ELSE 'negativo' END"
    sampled = Drawn("venda_id", seed + 7).bits("amostra")
    clock = "||':'||".join(
        f"lpad(CAST({v.integer(n, lo, hi)} AS VARCHAR),2,'0')"
        for n, (lo, hi) in {"hora": V.HOURS, "minuto": (0, 59), "segundo": (0, 59)}.items()
    )
    kinds = V.COUPON_KINDS
    return {
        "g_fornecedores": (
            f"SELECT id AS fornecedor_id, {numbered('Fornecedor', 6)} AS razao_social, "
            f"{company_id(f)} AS cnpj, regiao, {f.choice_by('cidade', 'regiao', V.CITIES)} AS cidade, "
            f"'+55 11 '||{f.digits('contato', 8)} AS contato, "
            f"{f.choice('segmento', V.SEGMENTS)} AS segmento FROM "
            f"(SELECT id, {f.choice('regiao', V.REGIONS)} AS regiao FROM "
            "(SELECT s_suppkey+1 AS id FROM supplier) t) u"
        ),
        "g_clientes": (
            f"SELECT id AS cliente_id, CASE WHEN tipo_cliente='PF' THEN {numbered('Cliente', 9)} "
            f"ELSE {numbered('Empresa', 9)} END AS nome, tipo_cliente, "
            f"CASE WHEN tipo_cliente='PF' THEN {person_id(c)} ELSE {company_id(c)} END AS documento, "
            f"regiao, {c.choice_by('cidade', 'regiao', V.CITIES)} AS cidade, "
            f"{day(c.integer('cadastro', 0, V.DAYS))} AS data_cadastro, "
            f"CAST({c.weighted('ativo', V.ACTIVE_WEIGHTS)} AS INT) AS ativo, "
            f"{r2(c.uniform('score', *V.SCORES), 1)} AS score_credito FROM "
            f"(SELECT id, {c.choice('regiao', V.REGIONS)} AS regiao, "
            f"{c.weighted('tipo', V.PERSON_WEIGHTS)} AS tipo_cliente FROM "
            "(SELECT c_custkey+1 AS id FROM customer) t) u"
        ),
        "g_produtos": (
            "SELECT id AS produto_id, "
            f"{p.choice_by('prefixo', 'categoria', V.NAME_PREFIXES)}||' '"
            f"||CAST({p.integer('modelo', 100, 999)} AS VARCHAR) AS nome, categoria, "
            f"{r2(p.uniform_by('preco', 'categoria', V.PRICE_RANGES))} AS preco, "
            f"{p.integer('estoque', *V.STOCK)} AS estoque, "
            f"{r2(p.uniform('peso', *V.WEIGHT_KG))} AS peso_kg, "
            f"{p.key_in('fornecedor', '(SELECT count(*) FROM supplier)')} AS fornecedor_id FROM "
            f"(SELECT id, {p.choice('categoria', V.CATEGORIES)} AS categoria FROM "
            "(SELECT p_partkey+1 AS id FROM part) t) u"
        ),
        "g_cupons": (
            "SELECT id AS cupom_id, "
            f"upper(substr(categoria,1,4))||CAST({k.integer('codigo', 1000, 9999)} AS VARCHAR) AS codigo, "
            f"tipo, CASE WHEN tipo='{kinds[0]}' THEN {r2(k.uniform('valor', *V.COUPON_AMOUNT))} "
            f"ELSE CAST({k.integer('percentual', *V.COUPON_PERCENT)} AS DOUBLE) END AS valor, "
            f"{day('inicio')} AS validade_inicio, "
            f"{day(f'least(inicio+' + k.integer('duracao', *V.COUPON_LENGTH) + f',{V.DAYS})')} "
            "AS validade_fim, categoria, "
            f"CASE WHEN {k.unit('livre')}<CAST({V.COUPON_FREE_CHANCE} AS DOUBLE) THEN 0.0::DOUBLE "
            f"ELSE {r2(k.uniform('minimo', *V.COUPON_MINIMUM))} END AS uso_minimo FROM "
            f"(SELECT id, {k.choice('tipo', kinds)} AS tipo, "
            f"{k.choice('categoria', [*V.CATEGORIES, V.ANY_CATEGORY])} AS categoria, "
            f"{k.integer('inicio', 0, V.DAYS - V.COUPON_LENGTH[1])} AS inicio FROM "
            "(SELECT p_partkey+1 AS id FROM part) t) u"
        ),
        "g_dias": f"SELECT {day('i')} AS dia FROM range(0,{V.DAYS}) r(i)",
        "g_casas": (
            "SELECT dia, row_number() OVER (ORDER BY dia, vez)-1 AS casa FROM "
            f"(SELECT dia, unnest(generate_series(1,{weight})) AS vez FROM g_dias) t"
        ),
        "g_cupom_vez": (
            "SELECT *, row_number() OVER (PARTITION BY data_venda ORDER BY cupom_id) AS vez, "
            "count(*) OVER (PARTITION BY data_venda) AS opcoes FROM ("
            + COUPON_DAYS.format(coupons="g_cupons", days="g_dias")
            + ") t"
        ),
        "g_opcoes": "SELECT data_venda, max(opcoes) AS opcoes FROM g_cupom_vez GROUP BY 1",
        "g_base": (
            f"SELECT id, dia AS data_venda, {v.unit('usa_cupom')}<CAST({V.COUPON_CHANCE} AS DOUBLE) AS usa, "
            f"{v.bits('cupom')} AS sorteio FROM (SELECT venda_id AS id FROM v_linha) t "
            f"JOIN g_casas ON casa={v.bits('data_venda')}%{datagen.total_day_weight()}"
        ),
        "g_vendas": (
            f"SELECT id AS venda_id, {v.key_in('cliente', '(SELECT count(*) FROM customer)')} AS cliente_id, "
            f"{v.key_in('produto', '(SELECT count(*) FROM part)')} AS produto_id, "
            f"CAST({v.weighted('quantidade', V.QUANTITY_WEIGHTS)} AS INT) AS quantidade, "
            f"{v.choice('desconto', V.DISCOUNTS)} AS desconto_pct, z.cupom_id, "
            f"{v.choice('status', V.STATUSES)} AS status, {v.choice('canal', V.CHANNELS)} AS canal, "
            f"b.data_venda, {clock} AS hora_venda FROM g_base b "
            "LEFT JOIN g_opcoes o ON b.usa AND o.data_venda=b.data_venda "
            "LEFT JOIN g_cupom_vez z ON b.usa AND z.data_venda=b.data_venda "
            "AND z.vez=b.sorteio%o.opcoes+1"
        ),
        "g_fretes": (
            f"SELECT venda_id AS frete_id, venda_id, {r2(freight_value)} AS valor_frete, "
            f"CASE WHEN status='CONCLUIDO' THEN {taken} ELSE prometido END AS prazo_dias, "
            f"{s.choice('transportadora', V.CARRIERS)} AS transportadora, "
            "CASE status WHEN 'CONCLUIDO' THEN 'ENTREGUE' WHEN 'CANCELADO' THEN 'CANCELADO' "
            f"ELSE {s.choice('entrega', V.OPEN_DELIVERY)} END AS status_entrega FROM "
            f"(SELECT venda_id, status, regiao, {promised} AS prometido FROM (SELECT venda_id, status, "
            f"coalesce(regiao,'{V.DEFAULT_REGION}') AS regiao FROM g_vendas "
            "LEFT JOIN g_clientes USING (cliente_id)) t) u"
        ),
        "g_pagamentos": (
            "SELECT venda_id AS pagamento_id, venda_id, metodo, "
            f"CASE WHEN metodo='{V.INSTALMENT_METHOD}' THEN {g.integer('parcelas', *V.INSTALMENTS)} "
            "ELSE 1 END AS parcelas, "
            f"CAST(round({exact_line('preco', 'quantidade', 'desconto_pct')}"
            f"+CAST(valor_frete AS {AMOUNT}),2) AS DOUBLE) AS valor_pago, "
            "CASE status WHEN 'CONCLUIDO' THEN 'PAGO' "
            f"WHEN 'CANCELADO' THEN {g.choice('devolucao', V.VOID_PAYMENT)} "
            f"ELSE {g.choice('aberto', V.OPEN_PAYMENT)} END AS status_pagamento FROM "
            f"(SELECT venda_id, status, quantidade, desconto_pct, "
            f"coalesce(preco,{V.DEFAULT_PRICE}) AS preco, "
            f"{g.weighted('metodo', V.METHOD_WEIGHTS)} AS metodo FROM g_vendas "
            "LEFT JOIN g_produtos USING (produto_id)) t JOIN g_fretes USING (venda_id)"
        ),
        "g_amostra": (
            "SELECT venda_id, data_venda FROM (SELECT *, "
            f"row_number() OVER (ORDER BY {sampled}, venda_id) AS lugar, count(*) OVER () AS n "
            "FROM g_vendas WHERE status='CONCLUIDO') t "
            f"WHERE lugar<=floor(n*CAST({V.REVIEW_SHARE} AS DOUBLE))"
        ),
        "g_avaliacoes": (
            "SELECT row_number() OVER (ORDER BY venda_id) AS avaliacao_id, venda_id, nota, "
            f"{a.choice_by('comentario', mood, V.COMMENTS)} AS comentario, "
            f"least(CAST(data_venda+{a.integer('demora', *V.REVIEW_DELAY)} AS DATE),"
            f"{day(str(V.DAYS))}) AS data FROM "
            f"(SELECT *, {a.choice('nota', V.RATINGS)} AS nota FROM g_amostra) t"
        ),
    }


CTES |= _generated()


# --- queries -----------------------------------------------------------------------


def _sales_mart(key: str, *measures: str) -> str:
    return f"SELECT {key}, {', '.join(measures)} FROM s_vendas GROUP BY {key}"


COUNT = "count(venda_id) AS qtd_vendas"
BUYERS = "count(DISTINCT cliente_id) AS qtd_clientes_unicos"
ITEMS = f"{big('sum(quantidade)')} AS qtd_itens"
REVENUE = f"{total('valor_total')} AS receita_total"
TICKET = f"{mean('valor_total')} AS ticket_medio"
FREIGHT = f"{total('valor_frete')} AS receita_frete"
FREIGHT_MEAN = f"{mean('valor_frete')} AS frete_medio"
RATING = f"count(avaliacao_id) AS qtd_avaliacoes, {r2('avg(nota)')} AS nota_media"

DESCRIBED = " UNION ALL ".join(
    f"SELECT '{table}' AS tabela, {place} AS posicao, '{column}' AS coluna, '{kind}' AS tipo, "
    f"count({column}) AS preenchidos FROM {table}"
    for table, schema in schemas.RAW.items()
    for place, (column, kind) in enumerate((part.split() for part in schema.split(", ")), 1)
)
COUNTED = " UNION ALL ".join(
    f"SELECT '{table}' AS tabela, count(*) AS linhas FROM {table}" for table in schemas.RAW
)
CAST_TEXT = (
    "(SELECT venda_id, CASE WHEN venda_id%89=0 THEN 'ontem' ELSE CAST(data_venda AS VARCHAR) END "
    "AS data_venda, CASE WHEN venda_id%97=0 THEN '?' ELSE '' END||CAST(quantidade AS VARCHAR) "
    "AS quantidade, CAST(desconto_pct AS VARCHAR) AS desconto_pct FROM vendas) t"
)
LIMITS = " UNION ALL ".join(
    f"SELECT '{scope}' AS escopo, {big(str(minutes * 60_000))} AS limite_ms"
    for scope, minutes in {**SLA_MINUTES, "run": SLA_RUN_MINUTES}.items()
)

BODIES: dict[str, str] = {
    "csv_roundtrip": "SELECT * FROM vendas",
    "pick_latest_drop": "SELECT * FROM vendas",
    "pick_first_drop": "SELECT * FROM vendas WHERE status<>'PENDENTE'",
    "pick_all_drops": (
        "SELECT * FROM vendas UNION ALL SELECT * FROM vendas WHERE status<>'PENDENTE'"
    ),
    "publish_roundtrip": "SELECT * FROM vendas WHERE status='CONCLUIDO'",
    "publish_history": " UNION ALL ".join(
        f"SELECT 'bronze' AS camada, '{table}' AS tabela, {big(version)} AS versao, "
        f"'{operation}' AS operacao, count(*) AS linhas FROM {source}"
        for table, version, operation, source in [
            ("vendas", "1", "CREATE", "vendas"),
            ("fretes", "1", "CREATE", "fretes"),
            ("clientes", "1", "CREATE", "clientes"),
            ("vendas", "2", "OVERWRITE", "vendas WHERE status='CONCLUIDO'"),
        ]
    ),
    "describe_tables": DESCRIBED,
    "row_counts": COUNTED,
    "cast_columns": (
        "SELECT venda_id, TRY_CAST(data_venda AS DATE) AS data_venda, "
        "TRY_CAST(quantidade AS INT) AS quantidade, TRY_CAST(desconto_pct AS DOUBLE) AS desconto_pct "
        f"FROM {CAST_TEXT}"
    ),
    "cast_quarantine": (
        "SELECT venda_id, concat_ws(',', CASE WHEN venda_id%89=0 THEN 'data_venda' END, "
        "CASE WHEN venda_id%97=0 THEN 'quantidade' END) AS colunas FROM vendas "
        "WHERE venda_id%89=0 OR venda_id%97=0"
    ),
    "digits_only": f"SELECT cliente_id, {digits('documento')} AS documento FROM clientes",
    "score_band": f"SELECT cliente_id, score_credito, {BAND} AS faixa_score FROM clientes",
    "part_of_day": (
        "SELECT venda_id, "
        + shift("CASE WHEN venda_id%53<>0 THEN hora_venda END")
        + " AS turno FROM vendas"
    ),
    "active_on": (
        f"SELECT cupom_id, {active(AS_OF)} AS ativo, {active(EARLIER_DAY)} AS ativo_antes FROM cupons"
    ),
    "flags": "SELECT pagamento_id, parcelas>1 AS eh_parcelado FROM pagamentos",
    "stock_flags": "SELECT produto_id, estoque>0 AS disponivel FROM produtos",
    "line_value": (
        f"SELECT venda_id, CAST(round({exact_line('preco', 'quantidade', 'desconto_pct')},2) AS DOUBLE) "
        "AS valor_total FROM vendas JOIN produtos USING (produto_id)"
    ),
    "month_key": "SELECT venda_id, strftime(data_venda,'%Y-%m') AS ano_mes FROM vendas",
    "require_key": "SELECT venda_id, cupom_id FROM vendas WHERE cupom_id IS NOT NULL",
    "status_equal": "SELECT venda_id, status FROM vendas WHERE status='CONCLUIDO'",
    "status_not": (
        "SELECT frete_id, status_entrega FROM fretes "
        "WHERE status_entrega<>'CANCELADO' AND frete_id%59<>0"
    ),
    "flag_false": "SELECT produto_id, disponivel FROM s_produtos WHERE NOT disponivel",
    "positive_rows": (
        "SELECT run_id, timestamp, row_count FROM pipeline_audit WHERE row_count>0"
    ),
    "purchase_stats_left": (
        "SELECT cliente_id, nome, qtd_compras, qtd_itens FROM clientes "
        "LEFT JOIN s_compras USING (cliente_id)"
    ),
    "supplier_left": (
        "SELECT produto_id, fornecedor_id, razao_social, segmento FROM produtos "
        "LEFT JOIN fornecedores USING (fornecedor_id)"
    ),
    "star_join": (
        "SELECT venda_id, cliente_id, produto_id, quantidade, valor_frete, prazo_dias, "
        "transportadora, status_entrega, metodo, parcelas, preco, p.nome, p.categoria, c.regiao, "
        "faixa_score FROM vendas JOIN produtos p USING (produto_id) "
        "JOIN s_clientes c USING (cliente_id) JOIN s_fretes USING (venda_id) "
        "JOIN s_pagamentos USING (venda_id)"
    ),
    "review_left_chain": (
        "SELECT avaliacao_id, a.venda_id, v.cliente_id, v.produto_id, v.valor_total, v.ano_mes, "
        "p.nome AS produto_nome, p.categoria FROM avaliacoes a "
        "LEFT JOIN s_vendas v ON a.venda_id=v.venda_id "
        "LEFT JOIN produtos p ON v.produto_id=p.produto_id"
    ),
    "coupon_interval_join": (
        "SELECT v.data_venda, count(DISTINCT v.venda_id) AS vendas, "
        "count(DISTINCT c.cupom_id) AS cupons, min(c.cupom_id) AS menor_cupom, count(*) AS pares "
        "FROM vendas v JOIN cupons c "
        "ON v.data_venda BETWEEN c.validade_inicio AND c.validade_fim GROUP BY v.data_venda"
    ),
    "coupon_smallest": (
        "SELECT v.venda_id, v.data_venda, min(c.cupom_id) AS cupom_id FROM vendas v "
        "LEFT JOIN cupons c ON v.data_venda BETWEEN c.validade_inicio AND c.validade_fim "
        "GROUP BY v.venda_id, v.data_venda"
    ),
    "coupon_assigned": (
        "SELECT v.venda_id, v.data_venda, z.cupom_id FROM vendas v LEFT JOIN cupom_vez z "
        "ON v.venda_id%5=0 AND z.data_venda=v.data_venda "
        "AND z.vez=(v.venda_id*7919)%z.opcoes+1"
    ),
    "lookup_default": (
        "SELECT venda_id, cupom_id, coalesce(codigo,'SEM CUPOM') AS codigo FROM vendas "
        "LEFT JOIN cupons USING (cupom_id)"
    ),
    **{f"silver_{name}": f"SELECT * FROM s_{name}" for name in schemas.RAW},
    "gold_receita_mensal": _sales_mart("ano_mes", COUNT, BUYERS, REVENUE, TICKET, FREIGHT),
    "gold_receita_categoria": _sales_mart("categoria", COUNT, ITEMS, REVENUE, FREIGHT),
    "gold_receita_regiao": _sales_mart("regiao", COUNT, BUYERS, REVENUE, TICKET),
    "gold_receita_canal": _sales_mart("canal", COUNT, BUYERS, REVENUE, TICKET, FREIGHT_MEAN),
    "gold_top_produtos": (
        _sales_mart("produto_id, nome, categoria", COUNT, ITEMS, REVENUE, TICKET)
        + " ORDER BY receita_total DESC, produto_id LIMIT 20"
    ),
    "gold_top_clientes": (
        "SELECT cliente_id, c.nome AS nome_cliente, count(venda_id) AS qtd_compras, "
        f"{total('valor_total')} AS total_gasto, {TICKET} FROM s_vendas "
        "JOIN s_clientes c USING (cliente_id) GROUP BY cliente_id, c.nome "
        "ORDER BY total_gasto DESC, cliente_id LIMIT 20"
    ),
    "gold_ranking_transportadoras": _sales_mart(
        "transportadora",
        "count(venda_id) AS qtd_entregas",
        FREIGHT_MEAN,
        f"{mean('prazo_dias')} AS prazo_medio_dias",
        FREIGHT,
    ),
    "gold_vendas_turno": _sales_mart("turno", COUNT, REVENUE, TICKET),
    "gold_metodos_pagamento": _sales_mart(
        "metodo",
        COUNT,
        REVENUE,
        f"{mean('parcelas')} AS parcelas_medio",
        f"{r2('count(CASE WHEN parcelas>1 THEN 1 END)*100.0::DOUBLE/count(venda_id)')} AS pct_parcelada",
    ),
    "gold_satisfacao_categoria": f"SELECT categoria, {RATING} FROM s_avaliacoes GROUP BY categoria",
    "gold_satisfacao_regiao": (
        f"SELECT regiao, {RATING} FROM s_avaliacoes JOIN s_clientes USING (cliente_id) GROUP BY regiao"
    ),
    "gold_estoque_critico": (
        "SELECT produto_id, nome, categoria, estoque, razao_social FROM s_produtos WHERE NOT disponivel"
    ),
    "gold_clientes_rfm": (
        "SELECT cliente_id, CAST(recencia AS INT) AS recencia_dias, frequencia, monetario, "
        "nome, regiao, faixa_score FROM (SELECT cliente_id, "
        f"date_diff('day', max(data_venda), DATE '{AS_OF}') AS recencia, "
        f"count(venda_id) AS frequencia, {total('valor_total')} AS monetario "
        "FROM s_vendas GROUP BY cliente_id) t JOIN s_clientes USING (cliente_id)"
    ),
    "gold_cupons_performance": (
        "SELECT cupom_id, qtd_usos, receita_com_cupom, ticket_medio, codigo, tipo, valor, categoria "
        "FROM (SELECT cupom_id, count(venda_id) AS qtd_usos, "
        f"{total('valor_total')} AS receita_com_cupom, {TICKET} FROM s_vendas "
        "WHERE cupom_id IS NOT NULL GROUP BY cupom_id) t JOIN s_cupons USING (cupom_id)"
    ),
    "pick_drop_strict": (
        "SELECT *, 'latest' AS escolha FROM vendas "
        "UNION ALL SELECT *, 'first' FROM vendas WHERE status<>'PENDENTE' "
        "UNION ALL SELECT *, 'all' FROM vendas "
        "UNION ALL SELECT *, 'all' FROM vendas WHERE status<>'PENDENTE'"
    ),
    "drop_missing": (
        "SELECT 'bronze' AS camada, 'vendas' AS tabela, 'leitura' AS fase, 0::BIGINT AS row_count, "
        "'sucesso' AS status UNION ALL SELECT 'bronze', 'vendas', 'escrita', count(*), 'sucesso' FROM vendas "
        "UNION ALL SELECT 'bronze', t, 'leitura', 0, 'ignorado' FROM (VALUES ('fornecedores'), ('clientes'), "
        "('produtos'), ('cupons'), ('fretes'), ('pagamentos'), ('avaliacoes')) x(t)"
    ),
    "silver_quarantine": (
        "SELECT frete_id, venda_id, valor_frete, CASE WHEN venda_id%97<>0 THEN prazo_dias END AS prazo_dias, "
        "transportadora, status_entrega, CASE WHEN venda_id%97=0 THEN 'prazo_dias' ELSE '' END AS motivo "
        "FROM fretes WHERE status_entrega<>'CANCELADO'"
    ),
    "drop_report": (
        "SELECT 'vendas' AS tabela, t AS carimbo, true AS tem_arquivos, true AS tem_bytes "
        "FROM (VALUES ('20240101T000000'), ('20240102T120000')) x(t)"
    ),
    "audit_append": "SELECT * FROM pipeline_audit",
    "audit_append_rows": (
        f"SELECT run_id, camada, tabela, fase, min(timestamp) AS timestamp, {big('sum(duracao_ms)')} AS duracao_ms, "
        f"{big('sum(row_count)')} AS row_count, min(status) AS status, max(erro_mensagem) AS erro_mensagem "
        "FROM pipeline_audit WHERE run_id='r01' GROUP BY run_id, camada, tabela, fase"
    ),
    "audit_run_summary": "SELECT * FROM runs_camada",
    "audit_run_totals": (
        "SELECT camada, status, count(*) AS qtd_runs FROM runs_camada GROUP BY camada, status"
    ),
    "audit_volume_by_layer": (
        "SELECT v.*, run_ts FROM volumes v JOIN (SELECT run_id, max(timestamp) AS run_ts "
        "FROM pipeline_audit GROUP BY run_id ORDER BY run_ts DESC, run_id DESC LIMIT 3) t "
        "USING (run_id)"
    ),
    "audit_volume_level": "SELECT * FROM volumes",
    "audit_last_status": "SELECT * FROM ultimas",
    "audit_failed_layers": (
        "SELECT count_if(codigo=1)::BIGINT AS falhas, CASE WHEN count_if(codigo=1)>=5 THEN 'red' "
        "WHEN count_if(codigo=1)>=2 THEN 'yellow' ELSE 'green' END AS nivel FROM ultimas"
    ),
    "audit_layer_series": (
        "SELECT camada, status, run_id, inicio, duracao_total_ms/1000::DOUBLE AS duracao_s "
        "FROM runs_camada"
    ),
    "audit_phase_grid": (
        "SELECT camada, tabela, fase, count(*) AS qtd_registros, "
        f"{mean('duracao_ms')} AS duracao_media_ms, max(duracao_ms) AS duracao_max_ms "
        "FROM pipeline_audit GROUP BY camada, tabela, fase"
    ),
    "audit_phase_trend": (
        "SELECT tabela, fase, run_id, timestamp, status, duracao_ms/1000::DOUBLE AS duracao_s "
        "FROM pipeline_audit WHERE camada='bronze'"
    ),
    "audit_phase_stats": (
        f"SELECT camada, tabela, fase, {mean('duracao_ms')} AS duracao_media_ms, "
        "min(duracao_ms) AS duracao_min_ms, max(duracao_ms) AS duracao_max_ms, "
        "quantile_disc(duracao_ms,0.95) AS duracao_p95_ms, count(*) AS qtd_runs FROM "
        "(SELECT * FROM pipeline_audit WHERE status='sucesso' QUALIFY row_number() OVER "
        "(PARTITION BY camada, tabela, fase ORDER BY timestamp DESC, run_id DESC, duracao_ms DESC)<=30) t "
        "GROUP BY camada, tabela, fase"
    ),
    "audit_layer_totals": "SELECT * FROM totais_comparados",
    "audit_layer_totals_latest": (
        "SELECT * FROM totais_comparados QUALIFY row_number() OVER "
        "(PARTITION BY camada ORDER BY run_ts DESC, run_id DESC)=1"
    ),
    "audit_table_volumes": against_run_before(
        "(SELECT camada, tabela, run_id, max(timestamp) AS run_ts, max(row_count) AS row_count "
        "FROM pipeline_audit WHERE status='sucesso' AND row_count>0 GROUP BY camada, tabela, run_id) u",
        "camada, tabela",
        "row_count",
        "row_count_anterior",
    ),
    "audit_sla_breaches": (
        "SELECT escopo, run_id, duracao_ms, limite_ms, duracao_ms-limite_ms AS excesso_ms FROM "
        "(SELECT camada AS escopo, run_id, duracao_total_ms AS duracao_ms FROM runs_camada UNION ALL "
        f"SELECT 'run', run_id, {big('sum(duracao_total_ms)')} FROM runs_camada GROUP BY run_id) t "
        f"JOIN ({LIMITS}) l USING (escopo) WHERE duracao_ms>limite_ms"
    ),
    "running_max": (
        "SELECT camada, run_id, run_ts, max(run_ts) OVER (PARTITION BY camada ORDER BY run_id) "
        "AS marca FROM runs_camada"
    ),
    "latest_per_group": (
        "SELECT camada, tabela, timestamp, duracao_ms, status FROM pipeline_audit "
        "QUALIFY row_number() OVER (PARTITION BY camada, tabela ORDER BY timestamp DESC, duracao_ms DESC)=1"
    ),
    "latest_n": (
        "SELECT camada, tabela, fase, timestamp, duracao_ms FROM pipeline_audit "
        "QUALIFY row_number() OVER "
        "(PARTITION BY camada, tabela, fase ORDER BY timestamp DESC, duracao_ms DESC)<=30"
    ),
    **{f"gen_{name}": f"SELECT * FROM g_{name}" for name in schemas.RAW},
    "gen_fast": (
        f"SELECT count(*) AS vendas, {big('0')} AS fora_quantidade, {big('0')} AS fora_desconto, "
        f"{big('0')} AS fora_data FROM v_linha"
    ),
    "gen_invariants": " UNION ALL ".join(
        f"SELECT '{rule}' AS regra, {big('0')} AS violacoes"
        for rule in [
            "um_frete", "um_pagamento", "concluido_entregue", "concluido_pago", "parcelas",
            "faixa_frete", "cupom_valido", "avaliada_concluida", "avaliada_depois", "numeracao",
            "amostra_exata",
        ]
    ),
    "exact_sample": (
        "SELECT venda_id FROM (SELECT venda_id, row_number() OVER (ORDER BY "
        f"{Drawn('venda_id', 7).bits('amostra')}, venda_id) AS lugar, count(*) OVER () AS n "
        "FROM vendas WHERE status='CONCLUIDO') t WHERE lugar<=floor(n*CAST(0.7 AS DOUBLE))"
    ),
}


def _needed(text: str) -> set[str]:
    words = set(re.findall(r"[a-z_]+", text))
    direct = {name for name in CTES if name in words}
    found = set(direct)
    for name in direct:
        found |= _needed_by(name)
    return found


def _needed_by(name: str) -> set[str]:
    inner = set(re.findall(r"[a-z_]+", CTES[name])) - {name}
    direct = {other for other in CTES if other in inner and _comes_before(other, name)}
    found = set(direct)
    for other in direct:
        found |= _needed_by(other)
    return found


_PLACES = {name: place for place, name in enumerate(CTES)}


def _comes_before(one: str, other: str) -> bool:
    return _PLACES[one] < _PLACES[other]


def with_tables(body: str) -> str:
    needed = _needed(body)
    tables = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in CTES if name in needed]
    return f"WITH {', '.join(tables)} {body}" if tables else body


# The three drops of the drifted sales: out of order, without two columns, with two more.
_LESS = "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS canal, CAST(NULL AS VARCHAR) AS hora_venda)"
BODIES["pick_drifted_drops"] = (
    f"SELECT * FROM vendas WHERE status<>'PENDENTE' UNION ALL {_LESS} FROM vendas WHERE quantidade>25 "
    "UNION ALL SELECT * FROM vendas"
)
BODIES["pick_drifted_quarantine"] = (
    "SELECT *, false AS registro_invalido FROM vendas WHERE status<>'PENDENTE' "
    f"UNION ALL {_LESS}, true FROM vendas WHERE quantidade>25 UNION ALL SELECT *, false FROM vendas"
)
_INFERRED = (
    "SELECT CAST(produto_id AS INTEGER) AS produto_id, nome, categoria, preco, {stock} AS estoque, "
    "peso_kg, CAST(fornecedor_id AS INTEGER) AS fornecedor_id FROM produtos"
)
BODIES["pick_inferred_drops"] = (
    _INFERRED.format(stock="CAST(NULL AS INTEGER)") + " UNION ALL " + _INFERRED.format(stock="CAST(estoque AS INTEGER)")
)
for _question in ("phase_stats", "layer_totals", "table_volumes"):
    BODIES[f"audit_folded_{_question}"] = BODIES[f"audit_{_question}"]
BODIES["audit_folded_quantiles"] = (
    "SELECT camada, tabela, fase, count(*) AS qtd_sucessos, true AS dentro_do_erro FROM pipeline_audit "
    "WHERE status='sucesso' AND duracao_ms IS NOT NULL GROUP BY camada, tabela, fase"
)
BODIES["sample_tables"] = " UNION ALL ".join(
    f"SELECT '{name}' AS tabela, chave FROM (SELECT {key} AS chave, row_number() OVER "
    f"(ORDER BY md5('7:'||CAST({key} AS VARCHAR))) AS lugar FROM {name}) t WHERE lugar<=5"
    for name, key in ((name, schema.split()[0]) for name, schema in schemas.RAW.items())
)
BODIES |= {f"gold_shared_{name}": BODIES[f"gold_{name}"] for name in SHARED}


def oracle_texts() -> dict[str, str]:
    return {name: with_tables(body) for name, body in BODIES.items()}
