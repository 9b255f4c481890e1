"""The three recurring steps: refresh the contracts, build the panel, publish it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from creditmill import schema as s
from creditmill.operators.align import align_to, clean_headers, contract_sources, resolve_contracts
from creditmill.operators.enrich import enrich_contracts
from creditmill.operators.materialize import tables_dropped
from creditmill.plans.panel import panel_metrics, write_panel
from creditmill.session import sized_shuffles
from creditmill.sources.sinks import add_snapshots, read_run, write_run


def refresh_contracts(
    raw: DataFrame, root: str, run: str, reference: T.StructType | None = None
) -> int:
    """Store the canonical contracts of a raw table as a run. Columns come in the order
    of `reference`, usually the schema of the run before. Returns the rows stored.

    A source none of whose columns is a contract column or a known alias of one is an
    error: the run would hold nulls only. `quality.parse_coverage(raw)` then tells, per
    recognised date and amount column, what could not be read."""
    found = contract_sources(clean_headers(raw).columns)
    if not found:
        raise ValueError(f"no column of the source is known; it has {raw.columns[:20]}")
    contracts = resolve_contracts(raw)
    return write_run(contracts if reference is None else align_to(contracts, reference), root, run)


def build_panel(
    contracts: DataFrame,
    tables: DataFrame,
    broker: DataFrame,
    hierarchy: DataFrame,
    as_of: dt.date,
    root: str,
    run: str,
    order: Sequence[str | Column],
    shuffled_bytes: int | None = None,
) -> str:
    """Store the enriched contracts and every panel metric of a run; returns the folder
    of the metrics. `shuffled_bytes` is the size of the narrow deduplicated contracts, for
    the number of shuffle partitions. Intermediate tables are gone afterwards."""
    spark = contracts.sparkSession
    location = f"{root}/panel/run={run}"
    with sized_shuffles(spark, shuffled_bytes), tables_dropped(spark):
        enriched = enrich_contracts(contracts, tables, broker, hierarchy, order=order)
        write_run(enriched, f"{root}/enriched", run, (s.MONTH,))
        stored = read_run(spark, f"{root}/enriched", run)
        write_panel(panel_metrics(stored, as_of), location)
    return location


def publish_panel(
    spark: SparkSession, snapshots: str, scope: str, location: str, at: dt.datetime
) -> None:
    """Point the scope at the panel's folder, by a new version of its snapshot. Readers see
    the old panel or the new one, and `snapshot_changed` tells them which."""
    row = spark.createDataFrame(
        [(scope, location, at)], "escopo string, html string, atualizado_em timestamp"
    )
    add_snapshots(row, snapshots)
