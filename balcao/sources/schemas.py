"""Declared schemas of the raw drops and of the audit log.

Declaring them saves the extra pass that type inference makes over every file,
and keeps the time of day a text instead of a timestamp on the day of the run.
"""

# Column names and types that consumers rely on.
RAW = {
    "fornecedores": (
        "fornecedor_id bigint, razao_social string, cnpj string, regiao string, "
        "cidade string, contato string, segmento string"
    ),
    "clientes": (
        "cliente_id bigint, nome string, tipo_cliente string, documento string, regiao string, "
        "cidade string, data_cadastro date, ativo int, score_credito double"
    ),
    "produtos": (
        "produto_id bigint, nome string, categoria string, preco double, estoque int, "
        "peso_kg double, fornecedor_id bigint"
    ),
    "cupons": (
        "cupom_id bigint, codigo string, tipo string, valor double, validade_inicio date, "
        "validade_fim date, categoria string, uso_minimo double"
    ),
    "vendas": (
        "venda_id bigint, cliente_id bigint, produto_id bigint, quantidade int, "
        "desconto_pct int, cupom_id bigint, status string, canal string, data_venda date, "
        "hora_venda string"
    ),
    "fretes": (
        "frete_id bigint, venda_id bigint, valor_frete double, prazo_dias int, "
        "transportadora string, status_entrega string"
    ),
    "pagamentos": (
        "pagamento_id bigint, venda_id bigint, metodo string, parcelas int, "
        "valor_pago double, status_pagamento string"
    ),
    "avaliacoes": (
        "avaliacao_id bigint, venda_id bigint, nota int, comentario string, data date"
    ),
}

AUDIT = (
    "run_id string, timestamp timestamp, camada string, tabela string, fase string, "
    "duracao_ms bigint, row_count bigint, status string, erro_mensagem string"
)

PUBLISH_LOG = (
    "camada string, tabela string, versao bigint, operacao string, linhas bigint, "
    "caminho string, publicado_em timestamp"
)
