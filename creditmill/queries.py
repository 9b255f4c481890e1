"""Registered queries: every metric over the contract view of the star tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill import schema as s
from creditmill.functions import calendar as cal
from creditmill.functions import cleaning as cl
from creditmill.functions import display
from creditmill.operators.align import align_to, resolve_contracts
from creditmill.operators.cells import CUBES, cube, cubes
from creditmill.operators.enrich import enrich_contracts as enrich
from creditmill.operators.keys import first_per_key
from creditmill.operators.materialize import checkpoint_root, computed_once
from creditmill.plans import access, funnel, hierarchy, pricing, production, quality, tables
from creditmill.plans.panel import panel_texts
from creditmill.sources import runs, sinks, star
from creditmill.sources.readers import read_first_existing
from creditmill.streaming import daily, snapshots, windows

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = star.AS_OF
LEAD = "PROMO"
SECONDS = ("MICRO", "LARGE")


def as_doubles(df: DataFrame) -> DataFrame:
    """Exact decimals become doubles only here, where results leave the library."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _metric(metric: Callable[..., DataFrame], *args, needs: str = "", **kwargs) -> Query:
    """`metric` over the enriched contracts with the dimensions it `needs`."""
    wanted = set(needs.split())

    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = star.enriched(
            spark, folder, products="products" in wanted, sales="sales" in wanted,
            table_names="tables" in wanted,
        )
        return as_doubles(metric(df, *args, **kwargs))

    return query


def scan_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Columnar scan with a fallback path; the preferred copy does not exist here."""
    paths = [f"{folder}/producao.parquet", f"{folder}/lineitem.parquet"]
    line = read_first_existing(spark, paths, star.SCHEMAS["lineitem"])
    return line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("contrato"),
        F.col("l_shipdate").alias("data"), F.col("l_extendedprice").alias("valor"),
    )


def dedupe_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of every contract id, found on the contract table itself."""
    unique = first_per_key(star.contracts(spark, folder), s.CCB, star.DEDUPE_ORDER)
    return as_doubles(unique).select(
        s.CCB, s.STATUS, s.DISBURSED_ON, s.TYPED_ON, s.TABLE_ID, s.GROSS, s.NET, s.BROKER_CODE
    )


def enrich_contracts(df: DataFrame) -> DataFrame:
    return df.select(
        s.CCB, s.PRODUCT, s.FUND, s.BANK, s.BROKER, s.PARTNER, s.COMMERCIAL, s.REGIONAL,
        s.SUPERINTENDENT, s.MONTH, s.COHORT, s.CATEGORY,
    )


def slice_filter(df: DataFrame) -> DataFrame:
    picked = funnel.slice_filter(df, AS_OF, periodo="mes", produto=LEAD, status=cl.DISBURSED)
    return picked.select(s.CCB, s.FUND, s.GROSS)


def _zulu(column: str) -> Column:
    """``2026-01-02T03:04:05Z``"""
    return F.concat(F.translate(F.col(column).cast("string"), " ", "T"), F.lit("Z"))


def raw_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """The line items under database column names and with text dates."""
    line, order = star.table(spark, folder, "lineitem"), star.table(spark, folder, "orders")
    return line.join(order, line.l_orderkey == order.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ccb_numero"),
        F.date_format("l_shipdate", "d/M/yyyy").alias("data_pagamento"),
        F.when(F.col("l_linenumber") > 2, _zulu("o_orderdate")).alias("data_digitado"),
        F.col("o_orderdate").alias("created_at"),
        F.lower(F.when(F.col("l_returnflag") == "R", "CANCELED").otherwise(F.col("o_orderstatus")))
        .alias("status_proposta"),
        F.concat(F.lit(" "), F.col("l_extendedprice").cast("string")).alias("valor_bruto"),
        F.col("l_quantity").alias("extra"),
    )


def schema_align(spark: SparkSession, folder: str) -> DataFrame:
    reference = T.StructType(
        [*s.CONTRACT.fields[:4], s.CONTRACT[s.GROSS], s.CONTRACT[s.AGENCY],
         T.StructField("so_referencia", T.StringType())]
    )
    aligned = align_to(resolve_contracts(raw_contracts(spark, folder)), reference)
    return as_doubles(aligned.select(*reference.names, "extra"))


def status_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a status code as a source has it."""
    code = (
        F.when(F.col("l_returnflag") == "R", "Canceled")
        .when(F.col("l_linenumber") == 1, "FOO_status")
        .when(F.col("l_linenumber") == 2, "signature_analysis")
        .when(F.col("l_linenumber") == 3, "In_Averbation")
        .when(F.col("l_linenumber") == 4, "REPROVED")
        .when(F.col("l_linenumber") != 5, "RISK_ANALYSIS")
    )
    return star.table(spark, folder, "lineitem").select(code.alias("codigo"))


def value_counts_raw_status(spark: SparkSession, folder: str) -> DataFrame:
    return quality.raw_status_profile(status_codes(spark, folder), "codigo")


def status_translate(spark: SparkSession, folder: str) -> DataFrame:
    return (
        status_codes(spark, folder)
        .select("codigo", cl.translate_status(F.col("codigo")).alias("status"))
        .withColumn("categoria", cl.status_category(F.col("status")))
        .groupBy("codigo", "status", "categoria")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def mixed_dates() -> Column:
    """Order dates written in thirteen ways."""
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 13
    text = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, _zulu("o_orderdate"))
        .when(kind == 2, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 23:30:00-03:00")))
        .when(kind == 3, F.date_format(day, "d/M/yyyy"))
        .when(kind == 4, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:20:30.123456")))
        .when(kind == 5, F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" 07:05")))
        .when(kind == 6, F.lit("0000-00-00"))
        .when(kind == 7, F.date_format(day, "dd/MM/yy"))
        .when(kind == 8, F.date_format(day, "dd MMM yyyy"))
        .when(kind == 9, F.date_format(day, "MMMM d, yyyy"))
        .when(kind == 10, F.concat(F.date_format(day, "yyyyMMdd"), F.lit("103000")))
        .when(kind == 11, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:20:30 PM")))
        .otherwise(F.concat(F.lit("lixo "), F.date_format(day, "yyyy")))
    )
    return text


def date_parse_mixed(spark: SparkSession, folder: str) -> DataFrame:
    written = star.table(spark, folder, "orders").select("o_orderkey", mixed_dates().alias("data"))
    return cl.parse_timestamps(written, "data")


def parse_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a source with dates of all kinds and amounts of which some are none."""
    amount, kind = F.col("o_totalprice").cast("string"), F.col("o_orderkey") % 5
    raw = star.table(spark, folder, "orders").select(
        mixed_dates().alias("data_pagamento"), F.col("o_orderdate").alias("created_at"),
        F.when(kind == 0, F.concat(F.lit("R$ "), amount)).when(kind > 1, amount).alias("valor_bruto"),
    )
    return quality.parse_coverage(raw)


def cohort_without_typing(spark: SparkSession, folder: str) -> DataFrame:
    """Cohorts of a source that has no typing date: the disbursement date stands in."""
    code = F.when(F.col("l_linestatus") == "F", "DISBURSED").otherwise("CANCELED")
    raw = star.table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ccb_numero"),
        F.col("l_shipdate").alias("data_pagamento"), code.alias("status_proposta"),
    )
    return funnel.cohort_conversion(enrich(resolve_contracts(raw), order=None))


def business_days(spark: SparkSession, folder: str) -> DataFrame:
    days = star.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("dia")).distinct()
    return days.select(
        "dia", cal.business_days_total(F.col("dia")).alias("tdu"),
        cal.business_days_elapsed(F.col("dia")).alias("pdu"),
    )


def business_days_holidays(spark: SparkSession, folder: str) -> DataFrame:
    """Working days of each order day's month, in all and up to the day, with holidays:
    running counts of a calendar over the span of the days, looked up twice per range."""
    days = star.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("dia")).distinct()
    span = days.agg(F.min("dia").alias("a"), F.max("dia").alias("b")).first()
    if span["a"] is None:
        return days.select("dia", F.lit(None).cast("bigint").alias("tdu"), F.lit(None).cast("bigint").alias("pdu"))
    first = span["a"].replace(day=1) - dt.timedelta(days=1)
    last = (span["b"].replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    calendar = cal.working_calendar(spark, first, last)
    return cal.with_working_days(days, "dia", calendar).select("dia", "tdu", "pdu")


def month_label(spark: SparkSession, folder: str) -> DataFrame:
    months = star.table(spark, folder, "orders").groupBy(
        cal.month_key(F.col("o_orderdate")).alias("mes")
    ).agg(F.count(F.lit(1)).alias("n"))
    return months.select("mes", cal.month_label(F.col("mes")).alias("rotulo"), "n")


def strip_prefix(spark: SparkSession, folder: str) -> DataFrame:
    names = star.hierarchy(spark, folder).groupBy(s.SUPERINTENDENT).agg(F.count(F.lit(1)).alias("n"))
    return names.select(
        s.SUPERINTENDENT, cl.after_prefix(F.col(s.SUPERINTENDENT)).alias("nome"), "n"
    )


def display_formats(df: DataFrame) -> DataFrame:
    """Monthly production as texts."""
    return production.monthly_production(df).select(
        cal.month_label(F.col(s.MONTH)).alias("mes"),
        display.thousands(F.col("C") * 1000).alias("contratos"),
        display.currency(F.col("B")).alias("bruto"),
        display.currency(F.col("L") - F.col("B")).alias("diferenca"),
    )


def headline_texts(df: DataFrame) -> DataFrame:
    return panel_texts(df, AS_OF)


def match_rate(spark: SparkSession, folder: str) -> DataFrame:
    return quality.match_rate(star.contracts(spark, folder), star.product_tables(spark, folder))


def value_counts_all_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The ten most frequent values of every column of the raw contract source."""
    return quality.frequent_values(star.table(spark, folder, "lineitem"))


def value_counts_top10(df: DataFrame) -> DataFrame:
    return quality.value_counts_top(df, s.STATUS)


def metrics_json(df: DataFrame) -> DataFrame:
    """Three metrics as JSON records, the contracts read once for all of them."""
    read_by = {
        "months": production.monthly_production, "sales": production.rank_partner,
        "cohorts": funnel.cohort_conversion,
    }
    stored = computed_once(cubes(df, AS_OF, *read_by))
    parts = [
        sinks.json_records(sinks.panel_rows(metric(cube(stored, name))), metric.__name__)
        for name, metric in read_by.items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


def one_cube(df: DataFrame, name: str) -> DataFrame:
    return cube(cubes(df, AS_OF, name), name)


def current_run(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly production stored as a run, checked by its digest on read-back and named in
    the manifest; the rows a reader of the manifest finds."""
    root = f"{checkpoint_root(spark)}/runs-{uuid.uuid4().hex}"
    sinks.publish_run(QUERIES["monthly_production"](spark, folder), root, "1")
    return runs.read_current(spark, root)


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Stored snapshots and changes: some users have a newer row on either side only, and
    some are in one of them alone."""
    events = star.table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type", "value")
    stored = F.pmod(F.col("event_id") + F.col("user_id"), F.lit(3)) == 0
    return sinks.merge_snapshots(events.where(stored), events.where(~stored | stored.isNull()), "user_id", "ts")


def stream_latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The latest event of every user, kept as keyed state by one run of a stream."""
    schema = star.table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type", "value").schema
    updates = spark.readStream.schema(star.SCHEMAS["events"]).option("maxFilesPerTrigger", 1).parquet(
        f"{folder}/events.parque[t]").select(*schema.names)
    run = f"{checkpoint_root(spark)}/latest-{uuid.uuid4().hex}"
    order = ["ts", "event_id", "event_type", "value"]
    snapshots.run_latest(updates, "user_id", order, f"{run}/table", f"{run}/state")
    return snapshots.read_latest(spark, f"{run}/table", schema, "user_id", order)


def semi_join_entitled(spark: SparkSession, folder: str) -> DataFrame:
    df = star.enriched(spark, folder)
    readers = star.table(spark, folder, "supplier").where(F.col("s_acctbal") > 0)
    return as_doubles(
        access.entitled(df, s.BROKER_CODE, readers, "s_suppkey").select(s.CCB, s.BROKER_CODE, s.GROSS)
    )


def roster_left_join(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as profiles, their last order date as the account's block time."""
    profiles = star.table(spark, folder, "customer")
    accounts = star.table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("banned_until")
    )
    return access.roster(
        profiles, accounts, dt.datetime(2001, 7, 17), login="c_custkey", role="c_mktsegment",
        email="o_custkey", order=("HOUSEHOLD", "MACHINERY"), keep=("c_name",),
    )


def spread_waterfall(df: DataFrame) -> DataFrame:
    priced = pricing.spread_waterfall(df)
    return priced.select(
        s.CCB, "tac_rs", "agio_rs", "iof_rs", "liquido_rs", "spread_bruto", "spread_bruto_pct",
        "spread_contrato", "spread_contrato_pct", "base_repasse", "repasse", "spread_final",
        "spread_final_pct",
    )


# Costs high enough that small tickets lose money.
COSTLY = pricing.Pricing(agio=0.02, tac=0.12, form=900.0, cef=150.0, rep=0.10)
HOPELESS = pricing.Pricing(agio=0.02, tac=0.12, form=900.0, cef=150.0, rep=0.42)


def breakeven_ticket(df: DataFrame) -> DataFrame:
    """Contracts below the breakeven ticket of the costly parameters, per fund and without."""
    p = COSTLY.literals()
    return (
        df.withColumn("ticket_minimo", pricing.breakeven_ticket(p))
        .groupBy(s.FUND, "ticket_minimo")
        .agg(F.count(F.when(F.col(s.GROSS) < F.col("ticket_minimo"), 1)).alias("abaixo"),
             F.count(s.GROSS).alias("total"))
    )


def breakeven_fee(df: DataFrame) -> DataFrame:
    p = COSTLY.literals()
    return df.select(
        s.CCB, pricing.breakeven_fee(F.col(s.GROSS).cast("double"), p).alias("tac_minima")
    )


def breakeven_payout(df: DataFrame) -> DataFrame:
    p = COSTLY.literals()
    return df.select(
        s.CCB, pricing.breakeven_payout(F.col(s.GROSS).cast("double"), p).alias("repasse_maximo")
    )


def spread_advice(df: DataFrame) -> DataFrame:
    return pricing.spread_advice(df, p=COSTLY.literals()).select(
        s.CCB, "spread_final", "negativo", "aumento_ticket", "sem_ticket", "aumento_tac_pp",
        "reducao_repasse_pp",
    )


def spread_scenarios(df: DataFrame) -> DataFrame:
    """The smallest and the largest ticket of every fund under two parameter sets."""
    scenarios = {"padrao": pricing.Pricing(), "custoso": HOPELESS}
    return pricing.spread_scenarios(pricing.ticket_range(df), scenarios).select(
        s.FUND, "ticket", "cenario", s.GROSS, "spread_final", "negativo", "sem_ticket", "aumento_tac_pp"
    )


def stream_daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Events taken in by one run of the stream, then the table it keeps."""
    # A pattern, so that the table may be one file or a folder of files.
    events = spark.readStream.schema(star.SCHEMAS["events"]).parquet(f"{folder}/events.parque[t]")
    run = f"{checkpoint_root(spark)}/daily-{uuid.uuid4().hex}"
    daily.run_daily_totals(events, "ts", "value", f"{run}/table", f"{run}/state")
    return as_doubles(daily.read_daily_totals(spark, f"{run}/table"))


def stream_window_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Events through one run of the windowed stream with a watermark and its late side;
    the day windows a reader finds."""

    def source() -> DataFrame:
        return spark.readStream.schema(star.SCHEMAS["events"]).option("maxFilesPerTrigger", 1).parquet(
            f"{folder}/events.parque[t]")

    run = f"{checkpoint_root(spark)}/windows-{uuid.uuid4().hex}"
    windows.run_window_totals(source, "ts", "value", f"{run}/table", f"{run}/state")
    totals = windows.read_window_totals(spark, f"{run}/table")
    return as_doubles(totals.select(F.to_date("inicio").alias("dia"), "C", "B"))


def batch_daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    events = star.table(spark, folder, "events")
    return as_doubles(daily.daily_totals(events, "ts", "value"))


QUERIES: dict[str, Query] = {
    "scan_contracts": scan_contracts,
    "dedupe_contracts": dedupe_contracts,
    "enrich_contracts": _metric(enrich_contracts, needs="products sales"),
    "monthly_production": _metric(production.monthly_production),
    "product_month": _metric(production.product_month, needs="products"),
    "fund_month": _metric(production.fund_month, needs="products"),
    "fund_totals": _metric(production.fund_totals, needs="products"),
    "distinct_products": _metric(production.distinct_products, needs="products"),
    **{f"cube_{name}": _metric(one_cube, name, needs="products sales") for name in CUBES},
    "grand_totals": _metric(production.grand_totals),
    "rank_superintendent": _metric(production.rank_superintendent, needs="sales"),
    "rank_partner": _metric(production.rank_partner, needs="sales"),
    "top4_wide": _metric(production.top4_wide, needs="sales"),
    "product_kpis": _metric(production.product_kpis, AS_OF, LEAD, needs="products"),
    "mtd_totals": _metric(production.mtd_totals, AS_OF),
    "mtd_product": _metric(production.mtd_product, AS_OF, needs="products"),
    "mtd_fund": _metric(production.mtd_fund, AS_OF, needs="products"),
    "today_totals": _metric(production.today_totals, AS_OF),
    "today_partner": _metric(production.today_partner, AS_OF, needs="sales"),
    "today_product": _metric(production.today_product, AS_OF, needs="products"),
    "today_fund": _metric(production.today_fund, AS_OF, needs="products"),
    "day_by_day": _metric(production.day_by_day, AS_OF),
    "run_rate": _metric(production.run_rate, AS_OF),
    "level_rankings": _metric(hierarchy.level_rankings, needs="sales"),
    "level_rankings_product": _metric(hierarchy.level_rankings_product, needs="products sales"),
    "rank_partner_enriched": _metric(hierarchy.rank_partner_enriched, needs="sales"),
    "sup_month": _metric(hierarchy.sup_month, needs="sales"),
    "reg_month": _metric(hierarchy.reg_month, needs="sales"),
    "sup_month_product": _metric(hierarchy.sup_month_product, needs="products sales"),
    "reg_month_product": _metric(hierarchy.reg_month_product, needs="products sales"),
    "partner_month": _metric(hierarchy.partner_month, needs="sales"),
    "status_mix": _metric(funnel.status_mix),
    "status_rollup": _metric(funnel.status_rollup),
    "conversion_product": _metric(funnel.conversion_product, needs="products"),
    "conversion_fund": _metric(funnel.conversion_fund, needs="products"),
    "funnel_product": _metric(funnel.funnel_product, needs="products"),
    "funnel_fund": _metric(funnel.funnel_fund, needs="products"),
    "cohort_conversion": _metric(funnel.cohort_conversion),
    "cohort_conversion_dense": _metric(funnel.cohort_conversion, dense=True),
    "dense_month_product": _metric(funnel.dense_month_product, needs="products"),
    "product_series": _metric(funnel.product_series, LEAD, SECONDS, needs="products"),
    "product_fund_pairs": _metric(funnel.product_fund_pairs, needs="products"),
    "period_slices": _metric(funnel.period_slices, AS_OF),
    "period_slices_product": _metric(funnel.period_slices_product, AS_OF, needs="products"),
    "period_slices_fund": _metric(funnel.period_slices_fund, AS_OF, needs="products"),
    "period_slices_status": _metric(funnel.period_slices_status, AS_OF),
    "slice_filter": _metric(slice_filter, needs="products"),
    "table_mix_month": _metric(tables.table_mix_month, AS_OF, needs="products tables"),
    "table_mix_month_product": _metric(tables.table_mix_month_product, AS_OF, needs="products tables"),
    "date_parse_mixed": date_parse_mixed,
    "parse_coverage": parse_coverage,
    "cohort_without_typing": cohort_without_typing,
    "value_counts_raw_status": value_counts_raw_status,
    "status_translate": status_translate,
    "schema_align": schema_align,
    "business_days": business_days,
    "business_days_holidays": business_days_holidays,
    "month_label": month_label,
    "strip_prefix": strip_prefix,
    "display_formats": _metric(display_formats),
    "headline_texts": _metric(headline_texts),
    "match_rate": match_rate,
    "value_counts_top10": _metric(value_counts_top10),
    "value_counts_all_columns": value_counts_all_columns,
    "date_coverage": _metric(quality.date_coverage),
    "spread_waterfall": _metric(spread_waterfall),
    "breakeven_ticket": _metric(breakeven_ticket, needs="products"),
    "breakeven_fee": _metric(breakeven_fee),
    "breakeven_payout": _metric(breakeven_payout),
    "spread_advice": _metric(spread_advice),
    "spread_scenarios": _metric(spread_scenarios, needs="products"),
    "spread_by_fund": _metric(pricing.spread_by, needs="products"),
    "metrics_json": _metric(metrics_json, needs="sales"),
    "current_run": current_run,
    "latest_snapshot": latest_snapshot,
    "stream_latest_snapshot": stream_latest_snapshot,
    "semi_join_entitled": semi_join_entitled,
    "roster_left_join": roster_left_join,
    "stream_daily_totals": stream_daily_totals,
    "batch_daily_totals": batch_daily_totals,
    "stream_window_totals": stream_window_totals,
}
