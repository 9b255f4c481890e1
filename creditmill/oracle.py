"""Equivalent SQL for the registered queries, to be run by another engine.

The contract view, the duplicates' order and the dimensions are those of
`sources.star`; `{today}` stands for its reference date.
"""

from __future__ import annotations

TODAY = "DATE '2001-07-17'"

CONTRACTS = """
contrato AS (
  SELECT *,
    CASE WHEN status = 'Desembolsado' AND l_partkey % 50 <> 0 THEN l_shipdate END AS pago,
    CAST(round(bruto * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS liq
  FROM (
    SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS ccb, l_shipdate, l_partkey, l_suppkey,
      l_extendedprice, l_discount, o_orderdate AS digitado,
      CASE WHEN l_returnflag = 'R' THEN 'Cancelado'
           WHEN o_orderstatus IN ('F', 'O') THEN 'Desembolsado'
           WHEN l_linenumber = 1 THEN 'FOO_STATUS'
           WHEN l_returnflag = 'A' THEN 'Aguardando assinatura'
           ELSE 'Rejeitada pela análise de risco' END AS status,
      CASE WHEN l_quantity <> 13 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS bruto
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
),
unico AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ccb
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS ordem
    FROM contrato)
  WHERE ordem = 1
),
vendas AS (
  SELECT s_suppkey, s_name AS parceiro, concat(n_name, '-', s_suppkey % 3) AS comercial,
    n_name AS regional,
    CASE WHEN r_name = 'ASIA' THEN r_name ELSE concat(r_regionkey, ' - ', r_name) END AS sup
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey % 7 <> 0
),
fato AS (
  SELECT u.ccb, u.status, u.pago, u.digitado, u.bruto, u.liq, u.l_partkey, u.l_suppkey,
    strftime(u.pago, '%Y-%m') AS mes, strftime(u.digitado, '%Y-%m') AS mes2,
    CASE WHEN u.status = 'Desembolsado' THEN 'Desembolsado'
         WHEN u.status = 'Cancelado' THEN 'Cancelado'
         WHEN u.status = 'Aguardando assinatura' THEN 'Ag. Assinatura'
         WHEN u.status = 'FOO_STATUS' THEN 'Outros' ELSE 'Em Analise' END AS cat,
    u.status = 'Desembolsado' AS des, u.status = 'Desembolsado' AND u.pago IS NOT NULL AS dd,
    n.p_name AS tabela,
    p.p_type AS produto, CASE WHEN p.p_size % 10 <> 0 THEN p.p_brand END AS fundo, p.p_name AS banco,
    coalesce(v.parceiro, 'Usuario interno / operacional') AS parceiro,
    coalesce(v.comercial, 'Usuario interno / operacional') AS comercial,
    coalesce(v.regional, 'Usuario interno / operacional') AS regional,
    coalesce(v.sup, 'Usuario interno / operacional') AS sup
  FROM unico u
  LEFT JOIN part n ON n.p_partkey = u.l_partkey
  LEFT JOIN part p ON p.p_partkey = u.l_partkey AND p.p_partkey % 40 <> 0
  LEFT JOIN vendas v ON v.s_suppkey = u.l_suppkey
),
pago AS (SELECT * FROM fato WHERE dd)
"""

# Sums leave as doubles, counts as bigints.
CBL = (
    "count(ccb) AS \"C\", CAST(coalesce(sum(bruto), 0) AS DOUBLE) AS \"B\", "
    "CAST(coalesce(sum(liq), 0) AS DOUBLE) AS \"L\""
)
NIVEL_CBL = CBL.replace("count(ccb)", "count(bruto)")
TOTALS = CBL.replace("count(ccb)", "count(*)")

FUNNEL = """count(ccb) AS total, count(CASE WHEN {done} THEN ccb END) AS desemb,
  count(ccb) - count(CASE WHEN {done} THEN ccb END) AS canc, CAST(0 AS BIGINT) AS andamento,
  CAST(coalesce(sum(CASE WHEN {done} THEN bruto END), 0) AS DOUBLE) AS bruta,
  CAST(coalesce(sum(CASE WHEN {done} THEN liq END), 0) AS DOUBLE) AS liq"""
FUNNEL_CONV = FUNNEL + """,
  round_even(CAST(count(CASE WHEN {done} THEN ccb END) AS DOUBLE) / CAST(count(ccb) AS DOUBLE) * 100, 1)
    AS conv"""

PERIODS = """
periodo AS (
  SELECT 'todos' AS periodo, * FROM fato
  UNION ALL SELECT 'mes', * FROM fato WHERE CAST(digitado AS DATE) >= date_trunc('month', {today})
  UNION ALL SELECT '7d', * FROM fato WHERE CAST(digitado AS DATE) >= {today} - 6
  UNION ALL SELECT 'hoje', * FROM fato WHERE CAST(digitado AS DATE) = {today}
)"""

LEVELS = """
niveis AS (
  SELECT 'Superintendente' AS nivel, sup AS nome, * FROM pago
  UNION ALL SELECT 'Regional', regional, * FROM pago
  UNION ALL SELECT 'Comercial', comercial, * FROM pago
  UNION ALL SELECT 'Parceiro', parceiro, * FROM pago
),
visto AS (
  SELECT {key} nome, sup, regional, comercial FROM (
    SELECT {key} parceiro AS nome, sup, regional, comercial,
      row_number() OVER (PARTITION BY {key} parceiro ORDER BY pago, sup, regional, comercial) AS o
    FROM pago WHERE {filter}) WHERE o = 1
),
ranking AS (
  SELECT *, row_number() OVER (PARTITION BY {key} nivel ORDER BY "Bd" DESC, nome) AS pos
  FROM (SELECT {key} nivel, nome, {measures}, coalesce(sum(bruto), 0) AS "Bd"
        FROM niveis WHERE length(nome) > 5 AND {filter} GROUP BY {key} nivel, nome)
)"""

RANKED = """
SELECT {select} r.nivel, r.nome, r."C", r."B", r."L", v.sup AS "Superintendente",
  v.regional AS "Regional", v.comercial AS "Comercial"
FROM ranking r LEFT JOIN visto v ON r.nivel = 'Parceiro' AND v.nome = r.nome {join}
WHERE pos <= CASE r.nivel WHEN 'Superintendente' THEN 10 WHEN 'Regional' THEN 20
                          WHEN 'Comercial' THEN 40 ELSE 30 END"""

# gross, net base and spreads in double, in the order the formulas are stated.
PRICED = """
preco AS (
  SELECT *, contrato_s - repasse AS final_s FROM (
    SELECT *, (b * t + b * a) - (f + c) AS contrato_s, greatest(0.0, net) * r AS repasse FROM (
      SELECT *, b - b * t - b * i - d AS net FROM (
        SELECT fato.*, CAST(bruto AS DOUBLE) AS b, {params} FROM {source} AS fato)))
)"""


def _params(a: float, t: float, form: float, cef: float, r: float) -> str:
    values = {"a": a, "t": t, "i": 0.0325, "d": 1.2, "f": form, "c": cef, "r": r}
    return ", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in values.items())


DEFAULT = _params(0.07, 0.30, 5.80, 1.84, 0.42)
COSTLY = _params(0.02, 0.12, 900.0, 150.0, 0.10)
HOPELESS = _params(0.02, 0.12, 900.0, 150.0, 0.42)

TICKET = """CASE WHEN (t + a) - (1.0 - t - i) * r > 0
  AND ((f + c) - d * r) / ((t + a) - (1.0 - t - i) * r) > 0
  THEN ((f + c) - d * r) / ((t + a) - (1.0 - t - i) * r) END"""
FEE = "((f + c) + b * r - b * a - b * i * r - d * r) / (b * (1.0 + r))"
FEE = f"CASE WHEN b > 0 AND {FEE} >= 0 THEN {FEE} END"
PAYOUT = "(b * (t + a) - (f + c)) / greatest(0.0, b - b * t - b * i - d)"
PAYOUT = (
    f"CASE WHEN b > 0 AND greatest(0.0, b - b * t - b * i - d) > 0 "
    f"AND {PAYOUT} >= 0 AND {PAYOUT} < r THEN {PAYOUT} END"
)


def _over_facts(body: str, *more: str) -> str:
    ctes = ",".join([CONTRACTS, *more])
    return f"WITH {ctes} {body}".replace("{today}", TODAY)


def _top(key: str, name: str, n: int, source: str = "pago", where: str = "TRUE", extra: str = "") -> str:
    return _over_facts(
        f"SELECT {key} AS \"{name}\", {extra} {CBL} FROM {source} WHERE {where} AND {key} IS NOT NULL "
        f"GROUP BY {key} ORDER BY coalesce(sum(bruto), 0) DESC, {key} LIMIT {n}"
    )


def _by(keys: dict[str, str], where: str = "TRUE", measures: str = CBL) -> str:
    names = ", ".join(f'{k} AS "{v}"' for k, v in keys.items())
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return _over_facts(
        f"SELECT {names}, {measures} FROM pago WHERE {where} AND {present} GROUP BY {', '.join(keys)}"
    )


MTD = "pago >= date_trunc('month', {today})"
ON_DAY = "CAST(pago AS DATE) = {today}"


def _month_label(month: str) -> str:
    names = ("Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez")
    cases = " ".join(f"WHEN '{i:02d}' THEN '{n}'" for i, n in enumerate(names, 1))
    return f"concat(CASE substr({month}, 6, 2) {cases} END, '/', substr({month}, 3, 2))"


def _thousands(integer: str) -> str:
    """Digits of a non-negative integer in groups of three."""
    return f"regexp_replace(CAST({integer} AS VARCHAR), '(\\d)(?=(\\d{{3}})+$)', '\\1.', 'g')"


def _currency(amount: str) -> str:
    # `format` groups by comma; the marks change places.
    return (
        f"concat(CASE WHEN {amount} < 0 THEN '-' ELSE '' END, 'R$ ', "
        f"translate(format('{{:,.2f}}', CAST(abs({amount}) AS DOUBLE)), ',.', '.,'))"
    )


def _short(amount: str) -> str:
    return (
        f"CASE WHEN {amount} >= 1000000 THEN format('R$ {{:.2f}}M', round_even({amount} / 1000000, 2)) "
        f"ELSE format('R$ {{:.0f}}K', round_even({amount} / 1000, 0)) END"
    )


TABLE_MIX = """count(ccb) AS "C", count(CASE WHEN des THEN ccb END) AS "Cdes",
  CAST(coalesce(sum(CASE WHEN des THEN bruto END), 0) AS DOUBLE) AS "B",
  CAST(coalesce(sum(CASE WHEN des THEN liq END), 0) AS DOUBLE) AS "L" """
IN_MONTH = "(mes = strftime({today}, '%Y-%m') OR mes2 = strftime({today}, '%Y-%m'))"

COHORT = """
eixo AS (SELECT DISTINCT mes FROM pago),
coorte AS (
  SELECT mes2, count(ccb) AS "Total", count(CASE WHEN des THEN ccb END) AS "Desemb",
    count(CASE WHEN status = 'Cancelado' THEN ccb END) AS "Canc"
  FROM fato WHERE mes2 IS NOT NULL GROUP BY mes2
)"""
COHORT_SELECT = """
SELECT mes AS "Mes", coalesce("Total", 0) AS "Total", coalesce("Desemb", 0) AS "Desemb",
  coalesce("Canc", 0) AS "Canc",
  CASE WHEN "Total" > 0 THEN round_even(CAST("Desemb" AS DOUBLE) / CAST("Total" AS DOUBLE) * 100, 1)
       ELSE 0.0 END AS "Conv"
FROM eixo {join} JOIN coorte ON mes = mes2"""

MONTHLY = """
mensal AS (
  SELECT mes, count(ccb) AS c, coalesce(sum(bruto), 0) AS bd, coalesce(sum(liq), 0) AS ld
  FROM pago GROUP BY mes
)"""
TICKETS = """CAST(CASE WHEN c > 0 THEN round_even(CAST(bd AS DOUBLE) / c, 0) ELSE 0 END AS BIGINT) AS "ticketB",
  CAST(CASE WHEN c > 0 THEN round_even(CAST(ld AS DOUBLE) / c, 0) ELSE 0 END AS BIGINT) AS "ticketL" """

BUSINESS_DAYS = """(SELECT count(*) FROM generate_series(date_trunc('month', {day}), {until}, INTERVAL 1 DAY) g(x)
  WHERE isodow(x) < 6)"""


def _business_days(day: str, total: bool) -> str:
    return BUSINESS_DAYS.replace("{day}", day).replace("{until}", f"last_day({day})" if total else day)


PRODUCT_TOTALS = """
prod AS (
  SELECT produto, count(ccb) AS total, count(CASE WHEN dd THEN ccb END) AS desemb,
    coalesce(sum(CASE WHEN dd THEN bruto END), 0) AS bruta, coalesce(sum(CASE WHEN dd THEN liq END), 0) AS liq,
    count(CASE WHEN dd AND CAST(pago AS DATE) = {today} THEN ccb END) AS hoje_c,
    coalesce(sum(CASE WHEN dd AND CAST(pago AS DATE) = {today} THEN bruto END), 0) AS hoje_b,
    coalesce(sum(CASE WHEN dd AND CAST(pago AS DATE) = {today} THEN liq END), 0) AS hoje_l
  FROM fato WHERE produto IS NOT NULL GROUP BY produto
)"""

KPI = """papel, produto AS "Produto", total, desemb, hoje_c, CAST(bruta AS DOUBLE) AS bruta,
  CAST(liq AS DOUBLE) AS liq, CAST(hoje_b AS DOUBLE) AS hoje_b, CAST(hoje_l AS DOUBLE) AS hoje_l,
  round_even(CAST(desemb AS DOUBLE) / total * 100, 1) AS conv,
  CAST(round_even(CAST(bruta AS DOUBLE) / desemb, 0) AS BIGINT) AS ticket"""

STATUS_CODE = """CASE WHEN l_returnflag = 'R' THEN 'Canceled' WHEN l_linenumber = 1 THEN 'FOO_status'
  WHEN l_linenumber = 2 THEN 'signature_analysis' WHEN l_linenumber = 3 THEN 'In_Averbation'
  WHEN l_linenumber = 4 THEN 'REPROVED' WHEN l_linenumber <> 5 THEN 'RISK_ANALYSIS' END"""

_SUP_FIELDS = ", ".join(
    f"""coalesce(max(CASE WHEN pos = {i} THEN nome END), '-') AS sup{i}_n,
  coalesce(max(CASE WHEN pos = {i} THEN "C" END), 0) AS sup{i}_c,
  coalesce(max(CASE WHEN pos = {i} THEN "B" END), 0.0) AS sup{i}_b,
  coalesce(max(CASE WHEN pos = {i} THEN "L" END), 0.0) AS sup{i}_l"""
    for i in range(1, 5)
)
_SUP_NAME = "CASE WHEN contains(sup, ' - ') THEN substr(sup, strpos(sup, ' - ') + 3) ELSE sup END"

# Group keys of each cube: those that are columns of the result, and the others.
_PAID_BUCKET = f"""CASE WHEN strftime(pago, '%Y-%m') = strftime({TODAY}, '%Y-%m')
  THEN strftime(pago, '%Y-%m-%d') ELSE mes END"""
_TYPED_BUCKET = f"""CASE WHEN digitado < least(date_trunc('month', {TODAY}), {TODAY} - INTERVAL 6 DAY) THEN 'antes'
  WHEN digitado >= {TODAY} + INTERVAL 1 DAY THEN 'depois' ELSE strftime(digitado, '%Y-%m-%d') END"""
_STATUS, _PRODUCT, _FUND = 'status AS "Status"', 'produto AS "Produto"', 'fundo AS "Fundo"'
_LEVELS = ('sup AS "Superintendente"', 'regional AS "Regional"', 'comercial AS "Comercial"', 'parceiro AS "Parceiro"')
CUBE_KEYS = {
    "months": ((_STATUS, _PRODUCT, _FUND), ("mes",)),
    "sales": ((_STATUS, _PRODUCT, *_LEVELS), ("mes",)),
    "cohorts": ((_STATUS,), ("mes", "mes2")),
    "recent": ((f"{_PAID_BUCKET} AS _pago", _STATUS, _PRODUCT, _FUND), ()),
    "partners": ((f"{_PAID_BUCKET} AS _pago", _STATUS, _LEVELS[3]), ()),
    "periods": ((f"{_TYPED_BUCKET} AS _digitado", _STATUS, _PRODUCT, _FUND), ()),
}


def _cube(name: str) -> str:
    shown, hidden = CUBE_KEYS[name]
    shown = [k for k in shown if not k.endswith((" AS _pago", " AS _digitado"))]
    buckets = [k.rsplit(" AS ", 1)[0] for k in CUBE_KEYS[name][0] if k.endswith((" AS _pago", " AS _digitado"))]
    keys = ", ".join([*[k.rsplit(" AS ", 1)[0] for k in shown], *hidden, *buckets])
    return _over_facts(
        f"""SELECT {", ".join(shown)}, min(pago) AS "Data do Desembolso", min(digitado) AS "Data de Digitação",
          count(*) AS _linhas, count(ccb) AS _contratos, count(bruto) AS _com_valor,
          CAST(sum(bruto) AS DOUBLE) AS "Valor Bruto", CAST(sum(liq) AS DOUBLE) AS "Valor Líquido",
          strftime(min(pago), '%Y-%m') AS "Mes", strftime(min(digitado), '%Y-%m') AS "Mes2", min(cat) AS "Categoria"
        FROM fato GROUP BY {keys}"""
    )


ORACLE: dict[str, str] = {
    "scan_contracts": (
        "SELECT l_orderkey * 10 + l_linenumber AS contrato, l_shipdate AS data, l_extendedprice AS valor "
        "FROM lineitem"
    ),
    "dedupe_contracts": _over_facts(
        'SELECT ccb AS "CCB", status AS "Status", pago AS "Data do Desembolso", '
        'digitado AS "Data de Digitação", CAST(l_partkey AS VARCHAR) AS "Identificador da tabela", '
        'CAST(bruto AS DOUBLE) AS "Valor Bruto", CAST(liq AS DOUBLE) AS "Valor Líquido", '
        'l_suppkey AS codigo_nova FROM fato'
    ),
    "enrich_contracts": _over_facts(
        'SELECT ccb AS "CCB", produto AS "Produto", fundo AS "Fundo", banco AS "Bancarizadora", '
        'parceiro AS "Nome Corretor", parceiro AS "Parceiro", comercial AS "Comercial", '
        'regional AS "Regional", sup AS "Superintendente", mes AS "Mes", mes2 AS "Mes2", '
        'cat AS "Categoria" FROM fato'
    ),
    "monthly_production": _over_facts(
        f'SELECT mes AS "Mes", c AS "C", CAST(bd AS DOUBLE) AS "B", CAST(ld AS DOUBLE) AS "L", {TICKETS} '
        "FROM mensal", MONTHLY,
    ),
    "product_month": _by({"mes": "Mes", "produto": "Produto"}),
    "fund_month": _by({"mes": "Mes", "fundo": "Fundo"}),
    "fund_totals": _by({"fundo": "Fundo"}),
    "distinct_products": _over_facts(
        'SELECT DISTINCT produto AS "Produto" FROM pago WHERE produto IS NOT NULL'
    ),
    **{f"cube_{name}": _cube(name) for name in CUBE_KEYS},
    "grand_totals": _over_facts(
        """SELECT count(*) AS total_reg, count(CASE WHEN dd THEN 1 END) AS total_des,
        CAST(coalesce(sum(CASE WHEN dd THEN bruto END), 0) AS DOUBLE) AS total_bruto,
        CAST(coalesce(sum(CASE WHEN dd THEN liq END), 0) AS DOUBLE) AS total_liq,
        round_even(CAST(count(CASE WHEN dd THEN 1 END) AS DOUBLE) / count(*) * 100, 1) AS conv_geral FROM fato"""
    ),
    "rank_superintendent": _top("sup", "Superintendente", 8, where="length(sup) > 5",
                                extra=f"{_SUP_NAME} AS nome,"),
    "rank_partner": _top("parceiro", "Parceiro", 15, where="length(parceiro) > 5"),
    "top4_wide": _over_facts(
        f"SELECT {_SUP_FIELDS} FROM sups",
        f"""sups AS (SELECT {_SUP_NAME} AS nome, {CBL},
          row_number() OVER (ORDER BY coalesce(sum(bruto), 0) DESC, sup) AS pos
          FROM pago WHERE length(sup) > 5 GROUP BY sup)""",
    ),
    "product_kpis": _over_facts(
        f"""SELECT {KPI} FROM (
          SELECT 'lead' AS papel, * FROM prod WHERE produto = 'PROMO'
          UNION ALL SELECT * FROM (SELECT 'runner_up' AS papel, * FROM prod WHERE produto <> 'PROMO'
                                   ORDER BY total DESC, produto LIMIT 1))""",
        PRODUCT_TOTALS,
    ),
    "mtd_totals": _over_facts(f"SELECT {TOTALS} FROM pago WHERE {MTD}"),
    "mtd_product": _by({"produto": "Produto"}, MTD),
    "mtd_fund": _by({"fundo": "Fundo"}, MTD),
    "today_totals": _over_facts(f"SELECT {TOTALS} FROM pago WHERE {ON_DAY}"),
    "today_partner": _top("parceiro", "Parceiro", 15, where=ON_DAY),
    "today_product": _by({"produto": "Produto"}, ON_DAY),
    "today_fund": _by({"fundo": "Fundo"}, ON_DAY),
    "day_by_day": _over_facts(
        """SELECT CAST(d AS INTEGER) AS dia, coalesce("C", 0) AS "C", coalesce("B", 0.0) AS "B",
          coalesce("L", 0.0) AS "L"
        FROM generate_series(1, day({today})) g(d) LEFT JOIN dias ON d = dia
        WHERE EXISTS (SELECT 1 FROM dias)""",
        f"""dias AS (SELECT day(pago) AS dia, {CBL} FROM pago
          WHERE mes = strftime({{today}}, '%Y-%m') GROUP BY 1)""",
    ),
    "run_rate": _over_facts(
        """SELECT mes, "C", "B", "L", pdu, tdu, round_even(CAST(pdu AS DOUBLE) / tdu * 100, 1) AS pct,
          proj_b, proj_l, CAST(round_even(CAST("C" AS DOUBLE) / pdu * tdu, 0) AS BIGINT) AS proj_c,
          CAST(ant_b AS DOUBLE) AS ant_b, ant_c,
          round_even((proj_b / CAST(ant_b AS DOUBLE) - 1) * 100, 1) AS var_b
        FROM (SELECT *, round_even("B" / pdu * tdu, 2) AS proj_b, round_even("L" / pdu * tdu, 2) AS proj_l
              FROM atual, uteis, anterior)""",
        MONTHLY,
        f"""atual AS (SELECT {_month_label("strftime({today}, '%Y-%m')")} AS mes, {TOTALS}
          FROM pago WHERE {MTD}),
        uteis AS (SELECT {_business_days("{today}", False)} AS pdu, {_business_days("{today}", True)} AS tdu),
        anterior AS (SELECT bd AS ant_b, c AS ant_c FROM mensal ORDER BY mes DESC LIMIT 1 OFFSET 1)""",
    ),
    "level_rankings": _over_facts(
        RANKED.format(select="", join=""), LEVELS.format(key="", filter="TRUE", measures=NIVEL_CBL)
    ),
    "level_rankings_product": _over_facts(
        RANKED.format(select='r.produto AS "Produto",', join="AND v.produto = r.produto"),
        LEVELS.format(key="produto,", filter="produto IS NOT NULL", measures=NIVEL_CBL),
    ),
    "rank_partner_enriched": _over_facts(
        """SELECT r.nome AS "Parceiro", r."C", r."B", r."L", v.sup AS "Superintendente",
          v.regional AS "Regional", v.comercial AS "Comercial"
        FROM ranking r JOIN visto v ON v.nome = r.nome WHERE nivel = 'Parceiro' AND pos <= 30""",
        LEVELS.format(key="", filter="TRUE", measures=NIVEL_CBL),
    ),
    "sup_month": _by({"sup": "Superintendente", "mes": "Mes"}, "length(sup) > 5", NIVEL_CBL),
    "reg_month": _by({"regional": "Regional", "mes": "Mes"}, "length(regional) > 5", NIVEL_CBL),
    "sup_month_product": _by(
        {"produto": "Produto", "sup": "Superintendente", "mes": "Mes"}, "length(sup) > 5", NIVEL_CBL
    ),
    "reg_month_product": _by(
        {"produto": "Produto", "regional": "Regional", "mes": "Mes"}, "length(regional) > 5", NIVEL_CBL
    ),
    "partner_month": _over_facts(
        """SELECT parceiro AS "Parceiro", mes AS "Mes", c AS "C", CAST(round_even(bd, 0) AS BIGINT) AS "B",
          CAST(round_even(ld, 0) AS BIGINT) AS "L"
        FROM celula WHERE parceiro IN (SELECT parceiro FROM posto WHERE pos <= 30)
          OR parceiro IN (SELECT parceiro FROM celula GROUP BY parceiro ORDER BY sum(bd) DESC, parceiro LIMIT 30)""",
        """celula AS (SELECT parceiro, mes, count(bruto) AS c, coalesce(sum(bruto), 0) AS bd,
            coalesce(sum(liq), 0) AS ld FROM pago WHERE length(parceiro) > 5 GROUP BY parceiro, mes),
        posto AS (SELECT *, row_number() OVER (PARTITION BY mes ORDER BY bd DESC, parceiro) AS pos FROM celula)""",
    ),
    "status_mix": _over_facts('SELECT cat AS "Categoria", count(ccb) AS v FROM fato GROUP BY cat'),
    "status_rollup": _over_facts(
        """SELECT count(CASE WHEN cat = 'Desembolsado' THEN ccb END) AS st_des,
          count(CASE WHEN cat = 'Cancelado' THEN ccb END) AS st_canc,
          count(CASE WHEN cat NOT IN ('Desembolsado', 'Cancelado') THEN ccb END) AS st_ag FROM fato"""
    ),
    "conversion_product": _over_facts(
        """SELECT produto AS "Produto", count(ccb) AS "Total", count(CASE WHEN dd THEN ccb END) AS "Desemb"
        FROM fato WHERE produto IS NOT NULL GROUP BY produto"""
    ),
    "conversion_fund": _over_facts(
        """SELECT fundo AS "Fundo", count(ccb) AS "Total", count(CASE WHEN dd THEN ccb END) AS "Desemb",
          round_even(CAST(count(CASE WHEN dd THEN ccb END) AS DOUBLE) / count(ccb) * 100, 1) AS conv
        FROM fato WHERE fundo IS NOT NULL GROUP BY fundo"""
    ),
    "funnel_product": _over_facts(
        f"""SELECT produto AS "Produto", {FUNNEL.format(done="dd")}
        FROM fato WHERE produto IS NOT NULL GROUP BY produto"""
    ),
    "funnel_fund": _over_facts(
        f"""SELECT fundo AS "Fundo", {FUNNEL_CONV.format(done="dd")}
        FROM fato WHERE fundo IS NOT NULL GROUP BY fundo"""
    ),
    "cohort_conversion": _over_facts(COHORT_SELECT.format(join="INNER"), COHORT),
    "cohort_conversion_dense": _over_facts(COHORT_SELECT.format(join="LEFT"), COHORT),
    "dense_month_product": _over_facts(
        """SELECT p.produto AS "Produto", m.mes AS "Mes", count(f.ccb) AS "C"
        FROM (SELECT DISTINCT produto FROM pago WHERE produto IS NOT NULL) p
        CROSS JOIN (SELECT DISTINCT mes FROM pago) m
        LEFT JOIN pago f ON f.produto = p.produto AND f.mes = m.mes GROUP BY p.produto, m.mes"""
    ),
    "product_series": _over_facts(
        """SELECT mes AS "Mes", count(CASE WHEN produto = 'PROMO' THEN ccb END) AS lead,
          count(CASE WHEN produto = CASE WHEN EXISTS (SELECT 1 FROM pago WHERE produto = 'MICRO')
                                         THEN 'MICRO' ELSE 'LARGE' END THEN ccb END) AS second
        FROM pago GROUP BY mes"""
    ),
    "product_fund_pairs": _over_facts(
        """SELECT DISTINCT produto AS "Produto", fundo AS "Fundo" FROM pago
        WHERE produto IS NOT NULL AND fundo IS NOT NULL"""
    ),
    "period_slices": _over_facts(
        """SELECT n.periodo, count(ccb) AS total, count(CASE WHEN des THEN 1 END) AS desemb,
          count(CASE WHEN cat = 'Cancelado' THEN 1 END) AS canc,
          count(ccb) - count(CASE WHEN des THEN 1 END) - count(CASE WHEN cat = 'Cancelado' THEN 1 END) AS andamento,
          CAST(coalesce(sum(CASE WHEN des THEN bruto END), 0) AS DOUBLE) AS bruta,
          CAST(coalesce(sum(CASE WHEN des THEN liq END), 0) AS DOUBLE) AS liq
        FROM (VALUES ('todos'), ('mes'), ('7d'), ('hoje')) n(periodo) LEFT JOIN periodo p USING (periodo)
        GROUP BY n.periodo""",
        PERIODS,
    ),
    "period_slices_product": _over_facts(
        f"""SELECT periodo, produto AS "Produto", {FUNNEL.format(done="des")}
        FROM periodo WHERE produto IS NOT NULL GROUP BY periodo, produto""", PERIODS,
    ),
    "period_slices_fund": _over_facts(
        f"""SELECT periodo, fundo AS "Fundo", {FUNNEL_CONV.format(done="des")}
        FROM periodo WHERE fundo IS NOT NULL GROUP BY periodo, fundo""", PERIODS,
    ),
    "period_slices_status": _over_facts(
        'SELECT periodo, cat AS "Categoria", count(ccb) AS v FROM periodo GROUP BY periodo, cat', PERIODS
    ),
    "slice_filter": _over_facts(
        """SELECT ccb AS "CCB", fundo AS "Fundo", CAST(bruto AS DOUBLE) AS "Valor Bruto" FROM fato
        WHERE digitado >= date_trunc('month', {today}) AND produto = 'PROMO' AND cat = 'Desembolsado'"""
    ),
    "table_mix_month": _over_facts(
        f"""SELECT concat_ws(' - ', tabela, fundo) AS "Tabela", {TABLE_MIX} FROM fato
        WHERE tabela IS NOT NULL AND {IN_MONTH} GROUP BY tabela, fundo"""
    ),
    "table_mix_month_product": _over_facts(
        f"""SELECT produto AS "Produto", concat_ws(' - ', tabela, fundo) AS "Tabela", {TABLE_MIX} FROM fato
        WHERE tabela IS NOT NULL AND produto IS NOT NULL AND {IN_MONTH} GROUP BY produto, tabela, fundo"""
    ),
    "date_parse_mixed": """SELECT o_orderkey, CASE o_orderkey % 13
          WHEN 0 THEN date_trunc('day', o_orderdate) WHEN 1 THEN o_orderdate
          WHEN 2 THEN date_trunc('day', o_orderdate) + INTERVAL 26 HOUR + INTERVAL 30 MINUTE
          WHEN 3 THEN date_trunc('day', o_orderdate)
          WHEN 4 THEN date_trunc('day', o_orderdate) + INTERVAL 37230123456 MICROSECOND
          WHEN 5 THEN date_trunc('day', o_orderdate) + INTERVAL 425 MINUTE
          WHEN 7 THEN date_trunc('day', o_orderdate) WHEN 8 THEN date_trunc('day', o_orderdate)
          WHEN 9 THEN date_trunc('day', o_orderdate)
          WHEN 10 THEN date_trunc('day', o_orderdate) + INTERVAL 630 MINUTE
          WHEN 11 THEN date_trunc('day', o_orderdate) + INTERVAL 80430 SECOND END AS data
        FROM orders""",
    "status_translate": f"""SELECT codigo, status,
          CASE status WHEN 'Cancelado' THEN 'Cancelado'
            WHEN 'Aguardando análise de assinatura' THEN 'Ag. Assinatura'
            WHEN 'Assinatura reprovada' THEN 'Ag. Assinatura' WHEN 'Em averbação' THEN 'Em Averbacao'
            WHEN 'Rejeitada pela análise de risco' THEN 'Em Analise' ELSE 'Outros' END AS categoria,
          count(*) AS n
        FROM (SELECT codigo, CASE codigo WHEN 'Canceled' THEN 'Cancelado'
                WHEN 'signature_analysis' THEN 'Aguardando análise de assinatura'
                WHEN 'In_Averbation' THEN 'Em averbação' WHEN 'REPROVED' THEN 'Assinatura reprovada'
                WHEN 'RISK_ANALYSIS' THEN 'Rejeitada pela análise de risco' ELSE codigo END AS status
              FROM (SELECT {STATUS_CODE} AS codigo FROM lineitem)) GROUP BY codigo, status""",
    "schema_align": """SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS "CCB",
          date_trunc('day', l_shipdate) AS "Data do Desembolso", o_orderdate AS "Data de Digitação",
          CASE WHEN l_returnflag = 'R' THEN 'Cancelado' ELSE lower(o_orderstatus) END AS "Status",
          CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS "Valor Bruto",
          CAST(NULL AS VARCHAR) AS "Orgao", CAST(NULL AS VARCHAR) AS so_referencia, l_quantity AS extra
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "business_days": f"""SELECT dia, {_business_days("dia", True)} AS tdu, {_business_days("dia", False)} AS pdu
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dia FROM orders)""",
    "month_label": f"""SELECT mes, {_month_label("mes")} AS rotulo, count(*) AS n
        FROM (SELECT strftime(o_orderdate, '%Y-%m') AS mes FROM orders) GROUP BY mes""",
    "strip_prefix": f"""SELECT sup AS "Superintendente", {_SUP_NAME} AS nome, count(*) AS n FROM (
          SELECT CASE WHEN r_name = 'ASIA' THEN r_name ELSE concat(r_regionkey, ' - ', r_name) END AS sup
          FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          WHERE s_suppkey % 7 <> 0) GROUP BY sup""",
    "display_formats": _over_facts(
        f"""SELECT {_month_label("mes")} AS mes, translate(format('{{:,}}', c * 1000), ',', '.') AS contratos,
          {_currency("bd")} AS bruto, {_currency("(ld - bd)")} AS diferenca FROM mensal""", MONTHLY,
    ),
    "headline_texts": _over_facts(
        f"""SELECT '17/07/2001' AS data_ref, translate(format('{{:,}}', n), ',', '.') AS registros,
          translate(format('{{:,}}', d), ',', '.') AS desembolsados,
          concat(round_even(CAST(d AS DOUBLE) / n * 100, 1), '%') AS conversao,
          {_short("b")} AS bruto, {_short("l")} AS liquido
        FROM (SELECT count(*) AS n, count(CASE WHEN dd THEN 1 END) AS d,
                CAST(sum(CASE WHEN dd THEN bruto END) AS DOUBLE) AS b,
                CAST(sum(CASE WHEN dd THEN liq END) AS DOUBLE) AS l FROM fato)"""
    ),
    "match_rate": _over_facts(
        """SELECT com_fundo, total, round_even(CAST(com_fundo AS DOUBLE) / total * 100, 1) AS pct FROM (
          SELECT count(CASE WHEN p_partkey % 40 <> 0 AND p_size % 10 <> 0 THEN p_brand END) AS com_fundo,
            count(*) AS total
          FROM contrato LEFT JOIN part ON p_partkey = l_partkey)"""
    ),
    "value_counts_top10": _over_facts(
        """SELECT status AS valor, count(*) AS n FROM fato WHERE status IS NOT NULL
        GROUP BY status ORDER BY n DESC, status LIMIT 10"""
    ),
    "value_counts_raw_status": f"""SELECT codigo, count(*) AS n, any_value(CASE codigo
            WHEN 'Canceled' THEN 'Cancelado' WHEN 'signature_analysis' THEN 'Aguardando análise de assinatura'
            WHEN 'In_Averbation' THEN 'Em averbação' WHEN 'REPROVED' THEN 'Assinatura reprovada'
            WHEN 'RISK_ANALYSIS' THEN 'Rejeitada pela análise de risco' ELSE codigo END) AS status
        FROM (SELECT {STATUS_CODE} AS codigo FROM lineitem) WHERE codigo IS NOT NULL
        GROUP BY codigo ORDER BY n DESC, codigo LIMIT 30""",
    "parse_coverage": """SELECT 'data_pagamento' AS coluna, 'Data do Desembolso' AS destino, count(*) AS presentes,
          count(*) - count(CASE WHEN o_orderkey % 13 IN (6, 12) THEN 1 END) AS lidos,
          count(CASE WHEN o_orderkey % 13 IN (6, 12) THEN 1 END) AS perdidos FROM orders
        UNION ALL SELECT 'created_at', 'Data de Digitação', count(o_orderdate), count(o_orderdate), 0 FROM orders
        UNION ALL SELECT 'valor_bruto', 'Valor Bruto', count(CASE WHEN o_orderkey % 5 <> 1 THEN 1 END),
          count(CASE WHEN o_orderkey % 5 > 1 THEN 1 END), count(CASE WHEN o_orderkey % 5 = 0 THEN 1 END) FROM orders""",
    "cohort_without_typing": """SELECT mes AS "Mes", total AS "Total", desemb AS "Desemb", canc AS "Canc",
          CASE WHEN total > 0 THEN round_even(CAST(desemb AS DOUBLE) / total * 100, 1) ELSE 0.0 END AS "Conv"
        FROM (SELECT strftime(l_shipdate, '%Y-%m') AS mes, count(*) AS total,
                count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS desemb,
                count(CASE WHEN l_linestatus <> 'F' THEN 1 END) AS canc
              FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1) WHERE desemb > 0""",
    "date_coverage": _over_facts(
        """SELECT count(*) AS total, count(pago) AS com_data, count(*) - count(pago) AS sem_data,
          count(CASE WHEN des AND pago IS NOT NULL THEN 1 END) AS des_com_data,
          count(CASE WHEN des AND pago IS NULL THEN 1 END) AS des_sem_data,
          CAST(min(pago) AS DATE) AS primeira, CAST(max(pago) AS DATE) AS ultima FROM fato"""
    ),
    "spread_waterfall": _over_facts(
        """SELECT ccb AS "CCB", b * t AS tac_rs, b * a AS agio_rs, b * i AS iof_rs, net AS liquido_rs,
          b * t + b * a AS spread_bruto, CASE WHEN b > 0 THEN (b * t + b * a) / b ELSE 0.0 END AS spread_bruto_pct,
          contrato_s AS spread_contrato, CASE WHEN b > 0 THEN contrato_s / b ELSE 0.0 END AS spread_contrato_pct,
          greatest(0.0, net) AS base_repasse, repasse, final_s AS spread_final,
          CASE WHEN b > 0 THEN final_s / b ELSE 0.0 END AS spread_final_pct FROM preco""",
        PRICED.format(params=DEFAULT, source="fato"),
    ),
    "breakeven_ticket": _over_facts(
        f"""SELECT fundo AS "Fundo", {TICKET} AS ticket_minimo,
          count(CASE WHEN b < {TICKET} THEN 1 END) AS abaixo, count(b) AS total
        FROM preco GROUP BY fundo, a, t, i, d, f, c, r""",
        PRICED.format(params=COSTLY, source="fato"),
    ),
    "breakeven_fee": _over_facts(
        f'SELECT ccb AS "CCB", {FEE} AS tac_minima FROM preco', PRICED.format(params=COSTLY, source="fato")
    ),
    "breakeven_payout": _over_facts(
        f'SELECT ccb AS "CCB", {PAYOUT} AS repasse_maximo FROM preco',
        PRICED.format(params=COSTLY, source="fato"),
    ),
    "spread_advice": _over_facts(
        f"""SELECT ccb AS "CCB", final_s AS spread_final, final_s < 0 AS negativo,
          CASE WHEN final_s < 0 THEN {TICKET} - b END AS aumento_ticket,
          final_s < 0 AND ({TICKET}) IS NULL AS sem_ticket,
          CASE WHEN final_s < 0 AND ({FEE}) > t THEN (({FEE}) - t) * 100 END AS aumento_tac_pp,
          CASE WHEN final_s < 0 THEN (r - ({PAYOUT})) * 100 END AS reducao_repasse_pp FROM preco""",
        PRICED.format(params=COSTLY, source="fato"),
    ),
    "spread_scenarios": _over_facts(
        f"""SELECT fundo AS "Fundo", ticket, cenario, b AS "Valor Bruto", final_s AS spread_final,
          final_s < 0 AS negativo, final_s < 0 AND ({TICKET}) IS NULL AS sem_ticket,
          CASE WHEN final_s < 0 AND ({FEE}) > t THEN (({FEE}) - t) * 100 END AS aumento_tac_pp FROM preco""",
        f"""pontas AS (
          SELECT fundo, 'minimo' AS ticket, min(bruto) AS bruto FROM pago
            WHERE bruto IS NOT NULL GROUP BY fundo
          UNION ALL SELECT fundo, 'maximo', max(bruto) FROM pago
            WHERE bruto IS NOT NULL GROUP BY fundo),
        cenarios AS (
          SELECT *, 'padrao' AS cenario, {DEFAULT} FROM pontas
          UNION ALL SELECT *, 'custoso', {HOPELESS} FROM pontas)""",
        PRICED.format(params="1 AS um", source="cenarios"),
    ),
    "spread_by_fund": _over_facts(
        """SELECT fundo AS "Fundo", n AS "C", b AS "B", round_even(s, 2) AS spread_contrato,
          round_even(s - base * CAST(0.42 AS DOUBLE), 2) AS spread_final,
          round_even(CASE WHEN b > 0 THEN (s - base * CAST(0.42 AS DOUBLE)) / b ELSE 0.0 END * 100, 4)
            AS spread_final_pct
        FROM (SELECT *, b * (CAST(0.3 AS DOUBLE) + CAST(0.07 AS DOUBLE))
                - n * (CAST(5.8 AS DOUBLE) + CAST(1.84 AS DOUBLE)) AS s
              FROM (SELECT fundo, count(*) AS n, CAST(sum(bruto) AS DOUBLE) AS b,
                      CAST(sum(greatest(bruto - bruto * 0.3 - bruto * 0.0325 - 1.2, 0)) AS DOUBLE) AS base
                    FROM pago WHERE bruto IS NOT NULL GROUP BY fundo))"""
    ),
    "metrics_json": _over_facts(
        f"""SELECT 'monthly_production' AS metrica, concat('{{"Mes":"', {_month_label("mes")}, '","C":', c,
            ',"B":', CAST(bd AS DECIMAL(28,2)), ',"L":', CAST(ld AS DECIMAL(28,2)),
            ',"ticketB":', "ticketB", ',"ticketL":', "ticketL", '}}') AS registro
          FROM (SELECT *, {TICKETS} FROM mensal)
        UNION ALL SELECT * FROM (
          SELECT 'rank_partner', concat('{{"Nome parceiro":"', parceiro, '","C":', count(ccb),
            ',"B":', CAST(coalesce(sum(bruto), 0) AS DECIMAL(28,2)),
            ',"L":', CAST(coalesce(sum(liq), 0) AS DECIMAL(28,2)), '}}')
          FROM pago WHERE length(parceiro) > 5 GROUP BY parceiro
          ORDER BY coalesce(sum(bruto), 0) DESC, parceiro LIMIT 15)
        UNION ALL SELECT 'cohort_conversion', concat('{{"Mes":"', {_month_label('"Mes"')}, '","Total":', "Total",
            ',"Desemb":', "Desemb", ',"Canc":', "Canc", ',"Conv":', "Conv", '}}')
          FROM ({COHORT_SELECT.format(join="INNER")})""",
        MONTHLY, COHORT,
    ),
    "latest_snapshot": """SELECT user_id, ts, event_id, event_type, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC) AS ordem FROM events)
        WHERE ordem = 1""",
    "semi_join_entitled": _over_facts(
        """SELECT ccb AS "CCB", l_suppkey AS codigo_nova, CAST(bruto AS DOUBLE) AS "Valor Bruto" FROM fato
        WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""
    ),
    "roster_left_join": """SELECT c_custkey, c_name, c_mktsegment,
          coalesce(ultimo > TIMESTAMP '2001-07-17 00:00:00', FALSE) AS bloqueado
        FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS ultimo FROM orders GROUP BY o_custkey)
          ON c_custkey = o_custkey""",
    "batch_daily_totals": """SELECT CAST(ts AS DATE) AS dia, count(*) AS "C",
          CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "B" FROM events GROUP BY 1""",
}
ORACLE["stream_daily_totals"] = ORACLE["batch_daily_totals"]
ORACLE["current_run"] = ORACLE["monthly_production"]
ORACLE["stream_window_totals"] = ORACLE["batch_daily_totals"]
ORACLE["stream_latest_snapshot"] = ORACLE["latest_snapshot"]


def _frequent_values(table: str, columns: list[str], n: int = 10) -> str:
    parts = [
        f"""SELECT * FROM (SELECT '{c}' AS coluna, CAST({c} AS VARCHAR) AS valor, count(*) AS n,
              row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS ordem
            FROM {table} WHERE {c} IS NOT NULL GROUP BY CAST({c} AS VARCHAR)) WHERE ordem <= {n}"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


ORACLE["business_days_holidays"] = """
    WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dia FROM orders),
    cal AS (
        SELECT CAST(d AS DATE) AS d,
               isodow(d) <= 5 AND strftime(d, '%m-%d') NOT IN
                 ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02', '11-15', '12-25') AS util
        FROM generate_series((SELECT CAST(min(date_trunc('month', dia)) AS TIMESTAMP) FROM days),
                             (SELECT CAST(max(last_day(dia)) AS TIMESTAMP) FROM days), INTERVAL 1 DAY) t(d))
    SELECT dia, count(CASE WHEN util THEN 1 END) AS tdu, count(CASE WHEN util AND d <= dia THEN 1 END) AS pdu
    FROM days JOIN cal ON date_trunc('month', d) = date_trunc('month', dia) GROUP BY dia"""


# The columns of the raw contract source, in their order.
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ORACLE["value_counts_all_columns"] = _frequent_values("lineitem", LINEITEM_COLUMNS)
