"""Fixed values of the generated data: volumes, domains, weights and word lists."""

from datetime import date

# Everything below must stay as it is for generated data to keep its
# domains, weights and wording.

VOLUMES = {
    "fornecedores": 50,
    "clientes": 100_000,
    "produtos": 1_000,
    "cupons": 200,
    "vendas": 1_000_000,
}

CATEGORIES = [
    "Eletrônicos", "Roupas", "Alimentos", "Livros", "Esportes", "Casa", "Beleza", "Automotivo",
]
ANY_CATEGORY = "TODAS"

REGIONS = ["Sul", "Sudeste", "Norte", "Nordeste", "Centro-Oeste"]
DEFAULT_REGION = "Sudeste"

CITIES = {
    "Sul": ["Curitiba", "Porto Alegre", "Florianópolis", "Caxias do Sul", "Joinville"],
    "Sudeste": ["São Paulo", "Rio de Janeiro", "Belo Horizonte", "Campinas", "Santos"],
    "Norte": ["Manaus", "Belém", "Porto Velho", "Macapá", "Boa Vista"],
    "Nordeste": ["Salvador", "Recife", "Fortaleza", "Natal", "Maceió"],
    "Centro-Oeste": ["Brasília", "Goiânia", "Campo Grande", "Cuiabá", "Palmas"],
}

FIRST_DAY = date(2022, 1, 1)
DAYS = 900
MONTH_WEIGHTS = {1: 5, 2: 7, 3: 9, 4: 8, 5: 10, 6: 7, 7: 7, 8: 8, 9: 8, 10: 9, 11: 15, 12: 15}

STATUSES = ["CONCLUIDO", "CONCLUIDO", "CONCLUIDO", "CANCELADO", "PENDENTE"]
CHANNELS = ["online", "online", "loja_fisica", "app", "televendas"]
DISCOUNTS = [0, 0, 0, 5, 5, 10, 15, 20]
QUANTITY_WEIGHTS = {1: 40, 2: 25, 3: 15, 4: 7, 5: 4, 6: 3, 7: 2, 8: 1.5, 9: 1, 10: 0.5}
HOURS = (6, 22)
COUPON_CHANCE = 0.20

PERSON_WEIGHTS = {"PF": 85, "PJ": 15}
ACTIVE_WEIGHTS = {1: 85, 0: 15}
SCORES = (300, 1000)

PRICE_RANGES = {
    "Eletrônicos": (100, 5000),
    "Roupas": (20, 200),
    "Alimentos": (5, 150),
    "Livros": (20, 200),
    "Esportes": (30, 800),
    "Casa": (10, 300),
    "Beleza": (10, 300),
    "Automotivo": (50, 2000),
}
DEFAULT_PRICE = 100.0
STOCK = (0, 500)
WEIGHT_KG = (0.1, 30)

COUPON_KINDS = ["fixo", "percentual"]
COUPON_LENGTH = (30, 180)
COUPON_AMOUNT = (10, 100)
COUPON_PERCENT = (5, 25)
COUPON_MINIMUM = (50, 300)
COUPON_FREE_CHANCE = 0.3

CARRIERS = ["Correios", "Jadlog", "Total Express", "Braspress"]
FREIGHT = (12, 45)
FREIGHT_CAP = 120
FREIGHT_FACTORS = {"Norte": 1.5, "Nordeste": 1.5, "Centro-Oeste": 1.2}
LEAD_DAYS = (3, 15)
FAR_LEAD_DAYS = (7, 20)
FAR_REGIONS = ["Norte", "Nordeste"]
OPEN_DELIVERY = ["PREPARANDO", "EM_TRANSITO"]

METHOD_WEIGHTS = {"pix": 40, "cartao_credito": 35, "cartao_debito": 10, "boleto": 15}
INSTALMENT_METHOD = "cartao_credito"
INSTALMENTS = (1, 12)
VOID_PAYMENT = ["ESTORNADO", "CANCELADO"]
OPEN_PAYMENT = ["PENDENTE", "PROCESSANDO"]

REVIEW_SHARE = 0.7
REVIEW_DELAY = (1, 30)
RATINGS = [5, 5, 5, 4, 4, 4, 3, 3, 2, 1]

SEGMENTS = [
    "Eletrônicos", "Alimentos", "Têxtil", "Cosméticos", "Livros", "Esportivos",
    "Casa e Construção", "Automotivo", "Logística", "Diversos",
]

NAME_PREFIXES = {
    "Eletrônicos": [
        "Smartphone", "Notebook", "Tablet", "Fone", "Monitor", "Teclado", "Mouse", "Câmera",
        "Smart TV", "Carregador",
    ],
    "Roupas": [
        "Camiseta", "Calça", "Moletom", "Jaqueta", "Bermuda", "Vestido", "Saia", "Polo",
        "Blazer", "Short",
    ],
    "Alimentos": [
        "Arroz", "Feijão", "Azeite", "Café", "Açúcar", "Macarrão", "Molho", "Granola",
        "Proteína", "Chá",
    ],
    "Livros": [
        "Manual de", "Guia de", "Introdução a", "O Poder do", "Princípios de", "Arte de",
        "Fundamentos de", "Dominando", "Python e", "Spark:",
    ],
    "Esportes": [
        "Tênis", "Bicicleta", "Haltere", "Corda", "Luva", "Capacete", "Joelheira", "Garrafa",
        "Mochila", "Esteira",
    ],
    "Casa": [
        "Sofá", "Tapete", "Luminária", "Panela", "Aspirador", "Ventilador", "Porta-retratos",
        "Travesseiro", "Lençol", "Vaso",
    ],
    "Beleza": [
        "Shampoo", "Condicionador", "Creme", "Perfume", "Sérum", "Protetor", "Batom",
        "Delineador", "Máscara", "Esfoliante",
    ],
    "Automotivo": [
        "Pneu", "Óleo", "Filtro", "Limpador", "Película", "Capa", "Carregador Veicular", "GPS",
        "Kit Ferramentas", "Tapete Auto",
    ],
}

COMMENTS = {
    "positivo": [
        "Excelente produto!", "Entrega rápida e produto de qualidade.", "Recomendo!",
        "Muito bom, chegou antes do prazo.", "Produto conforme descrito.",
        "Satisfeito com a compra.", "Boa qualidade pelo preço.", "Entrega antes do previsto.",
    ],
    "neutro": [
        "Ok, mas poderia ser melhor.", "Produto razoável.", "Atendeu, mas demorou um pouco.",
        "Esperava mais pelo preço.", "Funciona bem, nada especial.", "Entrega dentro do prazo.",
    ],
    "negativo": [
        "Produto veio com defeito.", "Demora excessiva na entrega.", "Não recomendo.",
        "Péssima qualidade.", "Arrependi da compra.", "Produto diferente da descrição.",
        "Veio amassado.",
    ],
}
