"""Profiles of the contract table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as s
from creditmill.functions import cleaning as cl
from creditmill.functions import measures as ms
from creditmill.operators.align import clean_headers, contract_sources
from creditmill.operators.enrich import attach_products
from creditmill.operators.keys import top_rows


def value_counts_top(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Most frequent values of a column, nulls left out."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("valor"))
    return top_rows(values.count().withColumnRenamed("count", "n"), n, "n", "valor")


def date_coverage(df: DataFrame) -> DataFrame:
    """Rows with and without a disbursement date, overall and among the disbursed."""
    day = F.col(s.DISBURSED_ON)
    done = F.col(s.STATUS) == cl.DISBURSED
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(day).alias("com_data"),
        F.count_if(day.isNull()).alias("sem_data"),
        F.count_if(done & day.isNotNull()).alias("des_com_data"),
        F.count_if(done & day.isNull()).alias("des_sem_data"),
        F.to_date(F.min(day)).alias("primeira"),
        F.to_date(F.max(day)).alias("ultima"),
    )


def raw_status_profile(raw: DataFrame, column: str, n: int = 30) -> DataFrame:
    """Most frequent status codes of a source, with the label each is translated to."""
    code = F.col(f"`{column}`").cast("string")
    values = raw.where(code.isNotNull()).groupBy(code.alias("codigo")).agg(F.count(F.lit(1)).alias("n"))
    return top_rows(values.withColumn("status", cl.translate_status(F.col("codigo"))), n, "n", "codigo")


def parse_coverage(raw: DataFrame) -> DataFrame:
    """Per date and amount column of a source: values that are there, read, and lost.

    Blanks and the texts for missing values are not there; what is there and is no date
    or amount is lost, and would otherwise turn null without a sign.
    """
    df = clean_headers(raw)
    kinds = {f.name: f.dataType for f in s.CONTRACT.fields}
    used = [
        (target, source)
        for target, found in contract_sources(df.columns).items()
        for source in found
        if isinstance(kinds[target], (T.TimestampNTZType, T.DecimalType))
    ]
    there = {f"_raw{i}": cl.known_name(df[f"`{source}`"].cast("string")) for i, (_, source) in enumerate(used)}
    read = {}
    for i, (target, source) in enumerate(used):
        c = df[f"`{source}`"]
        read[f"_read{i}"] = cl.money(c, df.schema[source].dataType) if isinstance(kinds[target], T.DecimalType) else c
    both = df.select(*[c.alias(n) for n, c in {**there, **read}.items()])
    dates = [f"_read{i}" for i, (target, _) in enumerate(used) if isinstance(kinds[target], T.TimestampNTZType)]
    both = cl.parse_timestamps(both, *dates)
    counts = both.agg(*[
        c for i in range(len(used)) for c in (
            F.count(f"_raw{i}").alias(f"raw{i}"),
            F.count_if(F.col(f"_raw{i}").isNotNull() & F.col(f"_read{i}").isNotNull()).alias(f"read{i}"),
        )
    ])
    rows = [
        F.struct(
            F.lit(source).alias("coluna"), F.lit(target).alias("destino"), F.col(f"raw{i}").alias("presentes"),
            F.col(f"read{i}").alias("lidos"), (F.col(f"raw{i}") - F.col(f"read{i}")).alias("perdidos"),
        )
        for i, (target, source) in enumerate(used)
    ]
    return counts.select(F.inline(F.array(*rows)))


def match_rate(contracts: DataFrame, tables: DataFrame) -> DataFrame:
    """Contracts whose product table names a fund, before duplicates are removed."""
    return attach_products(contracts, tables).agg(
        F.count(s.FUND).alias("com_fundo"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("pct", ms.percent(F.col("com_fundo"), F.col("total")))



# Candidates per column that the sketch returns, and the items it tracks.
CANDIDATES = 1000
TRACKED = 10000


def frequent_values(df: DataFrame, n: int = 10, candidates: int = CANDIDATES, tracked: int = TRACKED) -> DataFrame:
    """coluna, valor (as text), n, ordem: the `n` most frequent non-null values of every
    column with exact counts, ties by text.

    One aggregate gives every column's frequent-items sketch (`approx_top_k`, partial
    in each task, merged at the end) and its non-null rows; nothing is shuffled by value.
    A second pass counts the candidates exactly. Any other value occurs at most as often
    as the rows the candidates leave over, so when the n-th count is above that, the
    list is exact; a column where it is not (many distinct values) is counted by a
    group on its values instead.
    """
    names = df.columns
    spark = df.sparkSession
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(names)])
    first = texts.agg(*[x for i in range(len(names)) for x in (
        F.expr(f"approx_top_k(c{i}, {candidates}, {tracked})").alias(f"t{i}"), F.count(f"c{i}").alias(f"n{i}"))]).first()
    found = [(i, item["item"]) for i in range(len(names)) for item in (first[f"t{i}"] or []) if item["item"] is not None]
    exact: dict[tuple[int, str], int] = {}
    if found:
        wanted = F.broadcast(spark.createDataFrame(found, "col int, valor string"))
        pairs = texts.select(F.explode(F.array(*[F.struct(F.lit(i).alias("col"), F.col(f"c{i}").alias("valor"))
                                                 for i in range(len(names))])).alias("p")).select("p.*")
        counted = pairs.join(wanted, ["col", "valor"], "left_semi").groupBy("col", "valor").agg(F.count(F.lit(1)).alias("n"))
        exact = {(r["col"], r["valor"]): r["n"] for r in counted.collect()}
    parts = []
    for i, name in enumerate(names):
        ranked = sorted(((c, v) for (col, v), c in exact.items() if col == i), key=lambda x: (-x[0], x[1]))
        left_over = first[f"n{i}"] - sum(c for c, _ in ranked)
        if (len(ranked) >= n and ranked[n - 1][0] > left_over) or left_over == 0:
            rows = [(name, v, c, k + 1) for k, (c, v) in enumerate(ranked[:n])]
            parts.append(spark.createDataFrame(rows, "coluna string, valor string, n long, ordem long"))
        else:
            values = texts.where(F.col(f"c{i}").isNotNull()).groupBy(F.col(f"c{i}").alias("valor")).agg(F.count(F.lit(1)).alias("n"))
            ordem = F.row_number().over(Window.orderBy(F.desc("n"), "valor"))
            parts.append(values.orderBy(F.desc("n"), "valor").limit(n).select(
                F.lit(name).alias("coluna"), "valor", "n", ordem.cast("long").alias("ordem")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
