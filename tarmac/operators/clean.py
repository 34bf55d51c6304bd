"""From raw report rows to flights: projection, missing values, types, route.

Everything here is a narrow projection, so reading, cleaning and writing a
report is one stage without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import calendar
from tarmac.functions import columns as C
from tarmac.schema import (
    ADDED_COLUMNS,
    DOUBLE_COLUMNS,
    FLIGHTS_SCHEMA,
    INT_COLUMNS,
    NA_TOKENS,
    NO_FLIGHT_NUMBER,
    RAW_TO_CLEAN,
    REPORT_SCHEMA,
    REQUIRED_FLAGS,
    ZERO_FILLED,
)


def select_report_columns(raw: DataFrame, *extra: str) -> DataFrame:
    """The 20 report columns by name, renamed; anything else is dropped."""
    return raw.select(*RAW_TO_CLEAN, *extra).withColumnsRenamed(RAW_TO_CLEAN)


#: a decimal number, with an exponent or not; Java's parser alone would also take ``5d`` or ``0x1p3``
NUMBER = r"^\\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$"
#: of texts made of these alone, Java's parser takes just what ``NUMBER`` does, so most fields need no look at the pattern
PLAIN = "0123456789.+-"

NUMERIC = [*INT_COLUMNS, *DOUBLE_COLUMNS]


def _present(name: str) -> str:
    """The text of a field, NULL for every token that means "missing"."""
    tokens = ", ".join(f"'{token}'" for token in NA_TOKENS)
    return f"CASE WHEN {name} NOT IN ({tokens}) THEN {name} END"


def _parsed(name: str, text: str | None = None, plain: str | None = None) -> str:
    """The number that a text (the column's own, if none is given) spells, NULL if it spells none. Ints go through double: ``'1.00'`` is 1.

    ``plain`` may name a flag that is only true where the text is made of ``PLAIN`` alone.
    """
    text = text or name
    plain = f"{plain} AND {text} != ''" if plain else f"ltrim('{PLAIN}', {text}) = ''"
    number = f"CASE WHEN {plain} OR {text} RLIKE '{NUMBER}' THEN try_cast({text} AS double) END"
    return f"try_cast({number} AS int)" if name in INT_COLUMNS else number


def parse_text_rows(text: DataFrame, bad: str | None = None) -> DataFrame:
    """Typed columns from the all-string report columns; other columns are kept.

    ``bad`` names a flag to add: true where a row cannot be loaded, so that its whole report
    is rejected. That is a flag which must be present but is not, a number that does not
    parse, or (column ``_overflow`` of the report reader) more fields than the header
    has. Texts and one look at all numbers of a row, numbers, and the flag are three projections, each of which the JVM
    still compiles; no token spells a number, so the list of tokens is searched only for fields that are none.
    """
    others = [c for c in text.columns if c not in REPORT_SCHEMA.names]
    texts = [c for c in REPORT_SCHEMA.names if c not in NUMERIC]
    fields = {c: f"_text_{c}" for c in NUMERIC}
    plain = f"concat_ws('', {', '.join(NUMERIC)}) NOT RLIKE '[^{PLAIN}]' AS _plain"
    present = text.selectExpr(*others, *[f"{_present(c)} AS {c}" for c in texts], *[f"{c} AS {field}" for c, field in fields.items()], plain)
    typed = present.selectExpr(*others, *texts, *fields.values(), *[f"{_parsed(c, field, '_plain')} AS {c}" for c, field in fields.items()])
    columns = [*others, *REPORT_SCHEMA.names]
    if bad is None:
        return typed.select(columns)
    missing_flag = [f"{c} IS NULL" for c in REQUIRED_FLAGS]
    unparsable = [f"({c} IS NULL AND {_present(field)} IS NOT NULL)" for c, field in fields.items()]
    return typed.selectExpr(*columns, f"{' OR '.join([*missing_flag, *unparsable, '_overflow IS NOT NULL'])} AS {bad}")


def _filled(name: str, sql_type: str) -> str:
    if name in ZERO_FILLED:
        return f"CAST(coalesce({name}, 0) AS {sql_type}) AS {name}"
    if name == "flight_number":
        return f"CAST(coalesce({name}, {NO_FLIGHT_NUMBER}) AS {sql_type}) AS {name}"
    return f"CAST({name} AS {sql_type}) AS {name}"


def fill_missing(flights: DataFrame) -> DataFrame:
    """Missing delays become zero *before* any average is taken; flags become ints."""
    others = [c for c in flights.columns if c not in REPORT_SCHEMA.names]
    return flights.selectExpr(*others, *[_filled(f.name, f.dataType.simpleString()) for f in REPORT_SCHEMA.fields])


def add_route(flights: DataFrame) -> DataFrame:
    """Fills ``route`` where it is NULL, and adds the column if it is absent."""
    if "route" in flights.columns:
        return flights.withColumn("route", F.coalesce("route", C.route()))
    return flights.withColumn("route", C.route())


def clean_reports(text: DataFrame) -> DataFrame:
    """All-string report rows to flights."""
    return add_route(fill_missing(parse_text_rows(text)))


def check_reports(text: DataFrame, months: int) -> DataFrame:
    """All-string report rows to flights with the flag ``bad``: true for a row that cannot be loaded.

    A row that names a month ``months`` or more away from its report's own is bad too: its columns must have been
    shifted. Bad rows lose their month, so that they make no partitions.
    """
    rows = add_route(fill_missing(parse_text_rows(text, bad="bad")))
    away = F.abs(calendar.months_from_report(F.col("source_file"), F.col("year"), F.col("month"))) >= months
    rows = rows.withColumn("bad", F.col("bad") | F.coalesce(away, F.lit(False)))
    return rows.withColumns({c: F.when(~F.col("bad"), F.col(c)) for c in ("year", "month")}).select(*FLIGHTS_SCHEMA.names, "bad")


def add_missing_columns(flights: DataFrame) -> DataFrame:
    """Brings a table written before some columns existed to the current schema."""
    types = {f.name: f.dataType for f in FLIGHTS_SCHEMA.fields}
    absent = {c: F.lit(None).cast(types[c]) for c in ADDED_COLUMNS if c not in flights.columns}
    return flights.withColumns(absent) if absent else flights


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Appends frames by column name; a column one frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
