"""Column names, types and source aliases of the contract table."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical column names of the contract table and its dimensions.
CCB = "CCB"
DISBURSED_ON = "Data do Desembolso"
TYPED_ON = "Data de Digitação"
STATUS = "Status"
TABLE_ID = "Identificador da tabela"
TABLE_NAME = "Tabela Nome"
GROSS = "Valor Bruto"
NET = "Valor Líquido"
BROKER_CODE = "codigo_nova"
FUND_RAW = "fundo_raw"
EMAIL = "E-mail"
AGENCY = "Orgao"
INSTALMENTS = "Qtd Parcelas"

PRODUCT = "Produto"
FUND = "Fundo"
BANK = "Bancarizadora"
BROKER = "Nome Corretor"
PARTNER = "Parceiro"
COMMERCIAL = "Comercial"
REGIONAL = "Regional"
SUPERINTENDENT = "Superintendente"

PRODUCT_KEY = "PRODUTO__ID"
BROKER_KEY = "Código Corretor"
HIERARCHY_KEY = "Cod Parceiro"

# Columns that enrichment derives.
MONTH = "Mes"
COHORT = "Mes2"
CATEGORY = "Categoria"

# How many rows, rows with an id and rows with an amount a row stands for: 1 or 0 in
# the enriched contracts, more in the cubes they are folded to.
N_ROWS = "_linhas"
N_IDS = "_contratos"
N_GROSS = "_com_valor"

# Amounts keep the places their source has, up to six; totals are rounded at output only.
MONEY = T.DecimalType(28, 6)
# The type of every summed amount the metrics return.
TOTAL = T.DecimalType(28, 2)

CONTRACT = T.StructType(
    [
        T.StructField(CCB, T.StringType()),
        T.StructField(DISBURSED_ON, T.TimestampNTZType()),
        T.StructField(TYPED_ON, T.TimestampNTZType()),
        T.StructField(STATUS, T.StringType()),
        T.StructField(TABLE_ID, T.StringType()),
        T.StructField(TABLE_NAME, T.StringType()),
        T.StructField(GROSS, MONEY),
        T.StructField(NET, MONEY),
        T.StructField(BROKER_CODE, T.LongType()),
        T.StructField(FUND_RAW, T.StringType()),
        T.StructField(EMAIL, T.StringType()),
        T.StructField(AGENCY, T.StringType()),
        T.StructField(INSTALMENTS, T.IntegerType()),
    ]
)

# Database column -> canonical column. Where several map to one
# target, the first non-null in this order wins.
SOURCE_ALIASES = {
    "ccb_numero": CCB,
    "data_pagamento": DISBURSED_ON,
    "data_digitado": TYPED_ON,
    "data_digitacao": TYPED_ON,
    "created_at": TYPED_ON,
    "data_criacao": TYPED_ON,
    "status_proposta": STATUS,
    "tabela_id": TABLE_ID,
    "valor_bruto": GROSS,
    "valor_liquido": NET,
    "email": EMAIL,
    "email_corretor": EMAIL,
    "login_corretor": EMAIL,
    "orgao": AGENCY,
    "qtd_parcelas": INSTALMENTS,
    "tabela_nome": TABLE_NAME,
}

# Contract columns that would collide with a dimension attribute.
COLLISIONS = {
    PARTNER: "Parceiro_prod",
    PRODUCT: "Produto_original",
    FUND: "Fundo_original",
    BANK: "Bancarizadora_original",
}

LEVELS = (SUPERINTENDENT, REGIONAL, COMMERCIAL, PARTNER)
