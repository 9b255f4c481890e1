"""Hand-made contracts with values that are easy to add up."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from creditmill import schema as s
from creditmill.operators.enrich import enrich_contracts

AS_OF = dt.date(2026, 3, 10)  # a Tuesday, the seventh business day of 22

DIMS = {
    "tables": (
        [("t1", "F1", "FGTS", "B1"), (" T2 ", "F2", "CLT", "B2"), ("3.0", None, "OUTRO", "B3")],
        f"{s.PRODUCT_KEY} string, Fundo string, Produto string, Bancarizadora string",
    ),
    "broker": (
        [("1", "Corretor 1"), ("2", "Corretor 2"), (None, "Sem codigo")],
        f"`{s.BROKER_KEY}` string, `{s.BROKER}` string",
    ),
    "hierarchy": (
        [("1", "Parceiro A", "Com Um", "Norte Um", "10 - Super - X"),
         ("2", "Parceiro B", "Com Dois", "Sul Dois", "Super Y"),
         (None, "Parceiro N", "Com Nulo", "Nulo", "Super N")],
        "`﻿Cod Parceiro ` string, Parceiro string, Comercial string, "
        "`Nome Regional` string, Superintendente string",
    ),
}


def contract(ccb, paid, typed, status, table, gross, broker="1", name="Tab", fund=None, net=None):
    def stamp(text):
        return dt.datetime.fromisoformat(text) if text else None

    amount = None if gross is None else Decimal(gross)
    return (
        ccb, stamp(paid), stamp(typed), status, table, name, amount,
        amount if net is None else Decimal(net), broker, fund,
    )


SCHEMA = (
    f"`{s.CCB}` string, `{s.DISBURSED_ON}` timestamp_ntz, `{s.TYPED_ON}` timestamp_ntz, "
    f"`{s.STATUS}` string, `{s.TABLE_ID}` string, `{s.TABLE_NAME}` string, "
    f"`{s.GROSS}` decimal(18,2), `{s.NET}` decimal(18,2), `{s.BROKER_CODE}` string, "
    f"`{s.FUND_RAW}` string"
)

D, C = "Desembolsado", "Cancelado"

CONTRACTS = [
    contract("a", "2026-01-05", "2026-01-02", D, "t1", "100.00"),
    contract("b", "2026-01-06", "2026-02-03", D, "T1 ", "200.50", net="150.25"),
    contract("c", "2026-02-07", "2026-02-03", D, "t2", "400.00", broker="2"),
    contract("d", "2026-03-02", "2026-03-01", D, "t2", "50.00", broker="2"),
    contract("e", "2026-03-10 09:30", "2026-03-10 08:00", D, "t1", "70.00", broker="9"),
    contract("f", "2026-04-02", "2026-03-09", D, "t1", "30.00"),  # after the reference date
    contract("g", None, "2026-03-05", D, "t1", "999.00"),  # disbursed without date
    contract("h", None, "2026-03-10 10:00", C, "t2", "10.00"),
    contract("i", None, None, "Em averbação", "3", None),
    contract("j", "2026-03-10", "2026-01-20", "Aguardando desembolso", "zz", "5.00"),
]


def dims(spark):
    return {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in DIMS.items()}


def enriched(spark, rows=CONTRACTS, **kwargs):
    df = spark.createDataFrame(rows, SCHEMA)
    return enrich_contracts(df, **dims(spark), order=[s.DISBURSED_ON, s.TYPED_ON, s.GROSS], **kwargs)


def rows_of(df):
    """Rows as tuples, amounts as plain numbers."""
    return [
        tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in df.collect()
    ]
