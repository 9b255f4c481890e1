"""Text, number, date and status expressions for raw contract columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmill.schema import MONEY

WHITESPACE = " \t\n\r\x0b\x0c"

# Texts that stand for a missing name.
BLANK_NAMES = ("nan", "none", "")

DISBURSED = "Desembolsado"
CANCELLED = "Cancelado"
INTERNAL_LABEL = "Usuario interno / operacional"

# Proposal status code -> label.
STATUS_LABELS = {
    "DISBURSED": "Desembolsado",
    "CANCELED": "Cancelado",
    "CANCELLED": "Cancelado",
    "CANCEL": "Cancelado",
    "AWAITING_SIGNATURE": "Aguardando assinatura",
    "SIGNATURE_PENDING": "Aguardando assinatura",
    "PENDING": "Pendente",
    "IN_FINALIZE": "Aguardando desembolso",
    "FINALIZING": "Aguardando desembolso",
    "AWAITING_DISBURSE": "Aguardando desembolso",
    "SIGNATURE_APPROVED": "Assinatura aprovada",
    "SIGNATURE_REPROVED": "Assinatura reprovada",
    "REPROVED": "Assinatura reprovada",
    "INTEGRATED": "Integrada no banco",
    "IN_BANK": "Integrada no banco",
    "IN_AVERBATION": "Em averbação",
    "AVERBATION": "Em averbação",
    "RISK_ANALYSIS": "Rejeitada pela análise de risco",
    "REJECTED_BY_RISK": "Rejeitada pela análise de risco",
    "REJECTED_BY_RISK_ANALYSIS": "Rejeitada pela análise de risco",
    "AWAITING_RISK_ANALYSIS": "Aguardando análise de risco",
    "AWAITING_DISBURSEMENT": "Aguardando desembolso",
    "SIGNATURE_REJECTED": "Assinatura reprovada",
    "AWAITING_SIGNATURE_ANALYSIS": "Aguardando análise de assinatura",
    "SIGNATURE_ANALYSIS": "Aguardando análise de assinatura",
    "EXPIRED": "Expirado",
    "ERROR": "Erro",
    "PROCESSING": "Processando",
}

# A status belongs to the first category one of whose fragments
# it contains, ignoring case.
CATEGORY_RULES = (
    (("desembolsado",), "Desembolsado"),
    (("cancel",), "Cancelado"),
    (("assinatura", "reprovad"), "Ag. Assinatura"),
    (("desembolso", "integrad"), "Ag. Desembolso"),
    (("risco", "analise", "análise"), "Em Analise"),
    (("averbac", "averbação"), "Em Averbacao"),
)
OTHER_CATEGORY = "Outros"


def stripped(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def known_name(c: Column) -> Column:
    """`c` unchanged, or null when it is blank, ``nan`` or ``none``."""
    return F.when(~F.lower(stripped(c)).isin(*BLANK_NAMES), c)


def number(c: Column) -> Column:
    """Double, null for text that is no number."""
    value = stripped(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def money(c: Column, data_type: T.DataType) -> Column:
    """Amount with its places, up to six, null for text that is no number."""
    source = stripped(c) if isinstance(data_type, T.StringType) else c
    return source.try_cast(MONEY)


def text_key(c: Column) -> Column:
    """Join key of a product table id: no case, no blanks, no float suffix of a number."""
    return F.regexp_replace(F.lower(known_name(stripped(c))), r"^(\d+)\.0$", "$1")


def numeric_key(c: Column, integral: bool) -> Column:
    """Join key of a broker code, as long where both sides are integral."""
    return c.cast("bigint") if integral else number(c)


def utc_wall_clock(instant: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session time zone is."""
    return F.timestamp_add(
        "MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )


# English month names by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _named_month(text: Column) -> Column:
    """``05 Jan 2026`` and ``Jan 5, 2026``, with what follows, as day-first numbers."""
    numbers = F.create_map(*[F.lit(x) for i, name in enumerate(MONTHS) for x in (name, str(i + 1))])
    day_first = r"(?i)^(\d{1,2})[ -]([a-z]{3})[a-z]*\.?,?[ -](\d{4})"
    month_first = r"(?i)^([a-z]{3})[a-z]*\.? (\d{1,2}),? (\d{4})"

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    def numeric(pattern: str, day: int, name: int) -> Column:
        month = F.try_element_at(numbers, F.lower(part(pattern, name)))
        return F.concat(part(pattern, day), F.lit("/"), month, F.lit("/"), F.regexp_replace(text, pattern, "$3"))

    named = F.when(text.rlike(day_first), numeric(day_first, 1, 2)).when(text.rlike(month_first), numeric(month_first, 2, 1))
    return F.coalesce(named, text)


def _twelve_hours(text: Column) -> Column:
    """A time with AM or PM at the end, as a time of 24 hours."""
    pattern = r"(?i)^(.*[ T])(\d{1,2}):(\d{2})(:\d{2}(?:\.\d+)?)?\s*([ap])\.?m\.?$"

    def part(group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    hour = part(2).try_cast("int") % 12 + F.when(F.lower(part(5)) == "p", 12).otherwise(0)
    seconds = F.when(part(4) == "", F.lit(":00")).otherwise(part(4))
    written = F.concat(part(1), F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), part(3), seconds)
    return F.when(text.rlike(pattern), written).otherwise(text)


def _usual(text: Column) -> Column:
    """The usual ISO forms, which pass as they are."""
    return (
        (F.substring(text, 5, 1) == "-")
        & ((F.length(text) <= 16) | (F.substring(text, 17, 1) == ":"))
        & (F.upper(F.substring(text, -1, 1)) != "M")
    )


def _numeric_forms(iso: Column) -> Column:
    """Day-first, slashed and compact dates, years of two digits, zoned times without seconds."""
    iso = F.regexp_replace(iso, r"^(\d{1,2})[/.](\d{1,2})[/.]([0-6]\d)(?!\d)", "$1-$2-20$3")
    iso = F.regexp_replace(iso, r"^(\d{1,2})[/.](\d{1,2})[/.]([7-9]\d)(?!\d)", "$1-$2-19$3")
    iso = F.regexp_replace(iso, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6")
    iso = F.regexp_replace(iso, r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})", "$3-$2-$1")
    iso = F.regexp_replace(iso, r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    iso = F.regexp_replace(iso, r"^(\d{4})(\d{2})(\d{2})\b", "$1-$2-$3")
    return F.regexp_replace(iso, r"([T ]\d{1,2}:\d{2})(Z|[+-]\d{2}:?\d{2})?$", "$1:00$2")


def iso_text(c: Column) -> Column:
    """ISO spelling of a date text. The usual ISO forms pass as they are; day-first,
    slashed and compact dates, English month names, years of two digits (1970 to 2069),
    twelve-hour times and zoned times without seconds are rewritten.

    One expression; `iso_columns` gives the same texts in projections of their own,
    which is what a plan over many rows should use."""
    text = stripped(c)
    return F.when(_usual(text), text).otherwise(_numeric_forms(_twelve_hours(_named_month(text))))


def iso_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """`iso_text` of the named columns, stage by stage: each stage is a projection of its
    own, so a stage refers to the text before it as a column and no expression is
    repeated inside another; the stages for month names and twelve-hour times run only
    on texts that have a letter, which no other form has."""
    if not names:
        return df
    flag = {name: f"__usual_{i}" for i, name in enumerate(names)}
    df = df.withColumns({name: stripped(F.col(f"`{name}`")) for name in names})
    df = df.withColumns({flag[name]: _usual(F.col(f"`{name}`")) for name in names})

    def where_letters(name: str, stage) -> Column:
        c = F.col(f"`{name}`")
        return F.when(~F.col(flag[name]) & c.rlike("[A-Za-z]"), stage(c)).otherwise(c)

    df = df.withColumns({name: where_letters(name, _named_month) for name in names})
    df = df.withColumns({name: where_letters(name, _twelve_hours) for name in names})
    df = df.withColumns({name: F.when(F.col(flag[name]), F.col(f"`{name}`")).otherwise(_numeric_forms(F.col(f"`{name}`")))
                         for name in names})
    return df.drop(*flag.values())


def iso_timestamp(c: Column) -> Column:
    """Zone-free UTC timestamp of ISO text, null for any other. A zone is told by its
    place at the end, which the sign in a plain date cannot reach."""
    signs = ("+", "-")
    zoned = c.endswith("Z") | (
        (F.length(c) > 16)
        & (
            F.substring(c, -6, 1).isin(*signs)
            | F.substring(c, -5, 1).isin(*signs)
            | F.substring(c, -3, 1).isin(*signs)
        )
    )
    parsed = F.when(zoned, utc_wall_clock(c.try_cast("timestamp"))).otherwise(
        c.try_cast("timestamp_ntz")
    )
    return F.when(F.substring(c, 5, 1) == "-", parsed)


def parse_timestamps(df: DataFrame, *columns: str) -> DataFrame:
    """Zone-free UTC timestamps in place of date columns of any type.

    Text may be ISO (blank or ``T``, ``Z`` or an offset, fractions, no seconds),
    ``yyyyMMdd`` with or without ``HHmmss``, day-first with slashes, dots or dashes and
    years of four or (after slashes or dots) two digits, or with an English month name;
    times may be of twelve hours with AM or PM. Anything else is null.
    Text goes through the projections of `iso_columns`, so that each is rewritten once
    and not per use.
    """
    texts, parsed = [], {}
    for name in columns:
        c, found = df[f"`{name}`"], df.schema[name].dataType
        if isinstance(found, T.TimestampType):
            parsed[name] = utc_wall_clock(c)
        elif isinstance(found, T.StringType):
            texts.append(name)
            parsed[name] = iso_timestamp(F.col(f"`{name}`"))
        else:
            parsed[name] = c.cast("timestamp_ntz")
    df = iso_columns(df, texts)
    return df.withColumns(parsed) if parsed else df


def translate_status(c: Column) -> Column:
    """Label of a proposal status code; an unknown status stays as it is."""
    labels = F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, F.upper(c)), c)


def status_category(c: Column) -> Column:
    text = F.lower(c)
    category = F.when(F.lit(False), F.lit(None).cast("string"))
    for fragments, name in CATEGORY_RULES:
        hit = text.contains(fragments[0])
        for fragment in fragments[1:]:
            hit = hit | text.contains(fragment)
        category = category.when(hit, F.lit(name))
    return category.otherwise(F.lit(OTHER_CATEGORY))


def valid_name(c: Column) -> Column:
    """Hierarchy names of five characters or fewer are codes or null tokens."""
    return F.length(c) > 5


def after_prefix(c: Column) -> Column:
    """Text after the first `` - ``, or all of it."""
    return F.element_at(F.split(c, " - ", 2), -1)


def table_label(name: Column, fund: Column) -> Column:
    return F.concat_ws(" - ", name, stripped(known_name(fund)))
