"""From a raw source table to the stored panel, as the README shows it."""

import datetime as dt
import glob
import json

from creditmill import jobs
from creditmill import schema as s
from creditmill.operators.align import resolve_contracts
from creditmill.operators.enrich import enrich_contracts
from creditmill.operators.materialize import checkpoint_root
from creditmill.plans import production
from creditmill.plans.panel import panel_metrics, write_panel
from creditmill.sources.readers import read_table
from creditmill.sources.sinks import read_run, read_snapshot, snapshot_changed, write_run
from fixtures import AS_OF, dims, rows_of

RAW = """ccb_numero,data_pagamento,created_at,status_proposta,tabela_id,tabela_nome,valor_bruto,valor_liquido,codigo_nova,fundo
1,2026-01-05T10:00:00Z,02/01/2026,DISBURSED,t1,Tab,100.00,90.00,1.0,x
1,2026-01-06,02/01/2026,DISBURSED,t1,Tab,555.00,555.00,1.0,x
2,10/3/2026,2026-03-09 23:30:00-03:00,disbursed,T2,Tab,200.50,150.25,2,
3,0000-00-00,2026-03-10,CANCELED,t1,Tab,abc,,7,
4,,nan,IN_AVERBATION,nan,,,,,
"""


def test_the_three_jobs(spark, tmp_path, monkeypatch):
    (tmp_path / "raw.csv").write_text(RAW, encoding="utf-8")
    raw = read_table(spark, f"{tmp_path}/raw.csv")
    base, store = f"{tmp_path}/contracts", f"{tmp_path}/snapshots"
    assert jobs.refresh_contracts(raw, base, "1") == 5
    before = read_run(spark, base, "1").schema
    assert jobs.refresh_contracts(raw.drop("fundo", "tabela_nome"), base, "2", before) == 5
    assert read_run(spark, base, "2").columns == before.names
    seen = []
    monkeypatch.setattr(jobs, "write_panel", lambda *a: (seen.append(spark.conf.get("spark.sql.shuffle.partitions")), write_panel(*a)))
    before = set(glob.glob(f"{checkpoint_root(spark)}/table-*".removeprefix("file:")))
    location = jobs.build_panel(
        read_run(spark, base, "1"), *dims(spark).values(), AS_OF, str(tmp_path), "1",
        [s.DISBURSED_ON, s.GROSS, s.NET], shuffled_bytes=30 * 2**30,
    )
    assert seen == ["240"]
    assert set(glob.glob(f"{checkpoint_root(spark)}/table-*".removeprefix("file:"))) <= before
    first, second = dt.datetime(2026, 3, 10, 8), dt.datetime(2026, 3, 10, 9)
    jobs.publish_panel(spark, store, "painel", "elsewhere", first)
    jobs.publish_panel(spark, store, "painel", location, second)
    assert snapshot_changed(spark, store, "painel", first)
    current = read_snapshot(spark, store, "painel").first().html
    assert spark.read.json(f"{current}/grand_totals").first().total_reg == 4


def test_from_raw_text_to_the_panel(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(RAW, encoding="utf-8")
    contracts = resolve_contracts(read_table(spark, f"{tmp_path}/raw.csv"))
    df = enrich_contracts(contracts, **dims(spark), order=[s.DISBURSED_ON, s.GROSS, s.NET])
    assert write_run(df, f"{tmp_path}/runs", "1", (s.MONTH,)) == 4
    stored = read_run(spark, f"{tmp_path}/runs", "1")

    assert rows_of(production.monthly_production(stored)) == [
        ("2026-01", 1, 100.0, 90.0, 100, 90), ("2026-03", 1, 200.5, 150.25, 200, 150),
    ]
    assert rows_of(production.today_product(stored, AS_OF)) == [("CLT", 1, 200.5, 150.25)]

    metrics = panel_metrics(stored, AS_OF)
    write_panel(metrics, f"{tmp_path}/panel")

    def records(name):
        files = sorted((tmp_path / "panel" / name).glob("part-*"))
        return [json.loads(line) for f in files for line in f.read_text().splitlines()]

    assert {p.name for p in (tmp_path / "panel").iterdir()} == set(metrics)
    assert records("monthly_production")[0] == {
        "Mes": "Jan/26", "C": 1, "B": 100.0, "L": 90.0, "ticketB": 100, "ticketL": 90,
    }
    # The typing time of the second contract is already the 10th in UTC.
    today = {r["periodo"]: r for r in records("period_slices")}["hoje"]
    assert (today["total"], today["desemb"], today["canc"]) == (2, 1, 1)
    assert [r["dia"] for r in records("day_by_day") if r["C"]] == [10]
    assert {r["Tabela"]: r["C"] for r in records("table_mix_month")} == {"Tab - F2": 1, "Tab - F1": 1}
    assert records("status_mix")[0] == {"Categoria": "Desembolsado", "v": 2}
    assert {r["Nome parceiro"] for r in records("partner_month")} == {"Parceiro A", "Parceiro B"}
