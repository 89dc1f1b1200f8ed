"""Named queries of sources, sinks, text rules and contracts, and the same in DuckDB SQL.

The wide sheet of these queries is made from the orders: twelve rows with
numbers and labels as people write them, and a column for each of eight days of
the month, of which one does not exist and one is no date.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CANONICAL_COLUMNS, COMMODITIES, LAGS, PRICE_FEATURES, REQUIRED_COLUMNS, TARGET_VALUES
from ..functions import exprs as E
from ..operators import analytics as A
from ..operators import features as P
from ..operators.checks import contract_report, violations
from ..operators.service import parse_payloads, read_training_csv
from ..sources.artifacts import Files, joined
from ..sources.ingest import canonical_long, header_date, normal_date_header, parse_wide, top_level_rows
from ..sources.panels import table
from ..sources.shared import shared_folder
from ..sources.sinks import write_csv, write_engineered
from .queries import _KEYS, _rounded_list, on_panel, on_ready, panel, query, ready, rounded, sql

#: Row numbers and labels of the sheet; ~ stands for a no-break space, ^ for a tab.
NUMBERS = ["I", "II", "1", " iii ", "IV^", "~V", "vi", "VII", "A", None, "X~", "2"]
LABELS = ["Beras", "Cabai~Merah", "Beras Kualitas Bawah", "Bawang  Merah ", "^Telur Ayam", "Minyak Goreng", "Daging Ayam", "Gula^ Pasir", "Beras", "Beras", "Unknown", None]
#: Headers of the sheet's columns, by the day of the month that each shows.
HEADERS = ["1/ 03/ 2024", " 02 / 3/2024", "03/03/2024", "4/3/2024 ", "5 /03/ 2024", "29/02/2024", "30/02/2024", "Total"]


def _typed(x: str | None) -> str | None:
    return None if x is None else x.replace("~", " ").replace("^", "\t")


def wide_sheet(spark, sf) -> DataFrame:
    """The sheet: ``No``, ``Komoditas (Rp)`` and a text column for each header."""
    orders = table(spark, sf, "orders").where("dayofmonth(o_orderdate) <= 8").groupBy((F.col("o_orderkey") % 12).cast("int").alias("k"))
    price = F.max("o_totalprice")
    shown = lambda d: F.max(F.when(F.dayofmonth("o_orderdate") == d, F.col("o_totalprice")))
    text = lambda d: F.when(F.floor(shown(d)) % 5 == 0, "-").otherwise(F.format_number(F.floor(shown(d)), 0))
    prices = orders.agg(price.alias("highest"), *(text(d).alias(f"d{d}") for d in range(1, 9)))
    names = spark.createDataFrame([(k, _typed(n), _typed(x)) for k, (n, x) in enumerate(zip(NUMBERS, LABELS, strict=True))], "k int, number string, label string")
    both = names.join(prices, "k", "left")
    return both.select(F.col("number").alias("No"), F.col("label").alias("Komoditas (Rp)"), *(F.col(f"d{d}").alias(h) for d, h in enumerate(HEADERS, 1)))


def _text_sql(x: str | None) -> str:
    if x is None:
        return "NULL"
    return "'" + x.replace("~", "' || chr(160) || '").replace("^", "' || chr(9) || '") + "'"


_SHEET_ROWS = "names AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, {_text_sql(n)}, {_text_sql(x)})" for k, (n, x) in enumerate(zip(NUMBERS, LABELS, strict=True))) + ") v(k, number, label))"
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIPPED = rf"regexp_replace(regexp_replace({{x}}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"
_NORMAL = rf"trim(regexp_replace(coalesce({{x}}, ''), '{_SPACE}+', ' ', 'g'))"
_ROMAN = f"coalesce(regexp_full_match({_STRIPPED.replace('{x}', 'number')}, '(?i)[IVXLCDM]+'), false)"
_NAMES = "CASE " + " ".join(f"WHEN {_NORMAL.replace('{x}', 'label')} = '{k}' THEN '{v}'" for k, v in COMMODITIES.items()) + " END"
_DAYS = "headers AS (SELECT d, CAST(try_strptime(regexp_replace(h, '\\s', '', 'g'), '%d/%m/%Y') AS DATE) AS date FROM (VALUES " + ", ".join(f"({d}, '{h}')" for d, h in enumerate(HEADERS, 1)) + ") v(d, h))"
_CELLS = "cells AS (SELECT o_orderkey % 12 AS k, day(o_orderdate) AS d, CAST(floor(max(o_totalprice)) AS BIGINT) AS price FROM orders WHERE day(o_orderdate) <= 8 GROUP BY 1, 2)"


@query(
    sql(
        f"""SELECT headers.date, {_NAMES} AS commodity, CASE WHEN price % 5 <> 0 THEN CAST(price AS DOUBLE) END AS price_idr
  FROM names CROSS JOIN headers LEFT JOIN cells ON cells.k = names.k AND cells.d = headers.d
  WHERE headers.date IS NOT NULL AND {_ROMAN} AND {_NAMES} IS NOT NULL""",
        _SHEET_ROWS, _DAYS, _CELLS,
    )
)
def ingest_wide_sheet(spark, sf):
    """Sheet to canonical panel: headers, top-level rows, names, prices, melt."""
    sheet = parse_wide(wide_sheet(spark, sf))
    return canonical_long(top_level_rows(sheet), sheet)


_LABELLED = "keyed AS (SELECT o_orderkey, number, label FROM orders JOIN names ON k = o_orderkey % 12)"


@query(sql(f"SELECT {_NORMAL.replace('{x}', 'label')} AS label, {_NAMES} AS commodity, {_ROMAN} AS top_level, count(*) AS n_rows, min(o_orderkey) AS first_key FROM keyed GROUP BY 1, 2, 3", _SHEET_ROWS, _LABELLED))
def sheet_labels(spark, sf):
    """Which rows are top-level ones and what their labels mean, for labels dealt to all orders."""
    k = F.col("o_orderkey") % 12
    pick = lambda texts: F.element_at(F.array(*(F.lit(_typed(x)).cast("string") for x in texts)), (k + 1).cast("int"))
    rows = table(spark, sf, "orders").select("o_orderkey", pick(NUMBERS).alias("number"), E.normal_text(pick(LABELS)).alias("label"))
    named = rows.select("o_orderkey", "label", E.commodity_of("label").alias("commodity"), E.is_roman("number").alias("top_level"))
    return named.groupBy("label", "commodity", "top_level").agg(F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_key"))


_ROMAN_KEY = "CASE o_orderkey % 6 WHEN 0 THEN 'I' WHEN 1 THEN ' xiv ' WHEN 2 THEN 'IV.' WHEN 3 THEN '12' WHEN 4 THEN chr(9) || 'MCMXC' ELSE NULL END"


@query(sql(f"SELECT o_orderkey % 6 AS kind, count(*) AS n_rows, count(*) FILTER (WHERE {_ROMAN}) AS n_roman FROM n GROUP BY 1", f"n AS (SELECT o_orderkey, {_ROMAN_KEY} AS number FROM orders)"))
def roman_filter(spark, sf):
    k = F.col("o_orderkey") % 6
    number = F.when(k == 0, "I").when(k == 1, " xiv ").when(k == 2, "IV.").when(k == 3, "12").when(k == 4, "\tMCMXC")
    return table(spark, sf, "orders").groupBy(k.alias("kind")).agg(F.count("*").alias("n_rows"), F.count_if(E.is_roman(number)).alias("n_roman"))


_MONTH_HEADERS = "h AS (SELECT DISTINCT day(o_orderdate) || ' / 0' || month(o_orderdate) || '/' || year(o_orderdate) AS header, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders WHERE month(o_orderdate) < 10)"


@query(sql("SELECT header, strftime(date, '%d/%m/%Y') AS normal, date, max(o_totalprice) AS highest FROM h WHERE year(date) = (SELECT max(year(date)) FROM h) GROUP BY 1, 2, 3", _MONTH_HEADERS))
def header_dates(spark, sf):
    """The days of the last year as untidy headers of a sheet, whose dates are found again.

    Headers are schema, so they are read on the driver: as many as days of a year.
    """
    orders = table(spark, sf, "orders").where(F.month("o_orderdate") < 10)
    last = orders.agg(F.max(F.year("o_orderdate")).alias("_last"))
    day = F.to_date("o_orderdate")
    untidy = F.concat_ws("", F.dayofmonth(day), F.lit(" / 0"), F.month(day), F.lit("/"), F.year(day))
    own = orders.crossJoin(F.broadcast(last)).where(F.year("o_orderdate") == F.col("_last"))
    highest = own.groupBy(untidy.alias("header")).agg(F.max("o_totalprice").alias("highest"))
    headers = [r["header"] for r in highest.select("header").collect()]
    read = spark.createDataFrame([(h, normal_date_header(h), header_date(h)) for h in headers], "header string, normal string, date date")
    return highest.join(read, "header").select("header", "normal", "date", "highest")


_DIRTY = """dirty AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'someday' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date,
  CASE WHEN o_orderkey % 89 <> 0 THEN o_orderpriority END AS commodity, CASE WHEN o_orderkey % 83 = 0 THEN 'n/a' WHEN o_orderkey % 79 <> 0 THEN CAST(o_totalprice AS VARCHAR) END AS price_idr FROM orders)"""
_EXPECTED = ["1-URGENT", "2-HIGH", "9-NONE"]


@query(
    sql(
        f"""SELECT count(*) FILTER (WHERE TRY_CAST(date AS DATE) IS NULL) AS unparsable_dates, count(*) FILTER (WHERE commodity NOT IN ({', '.join(f"'{x}'" for x in _EXPECTED)})) AS unexpected_rows,
  (SELECT string_agg(x, ',' ORDER BY x) FROM (VALUES {', '.join(f"('{x}')" for x in _EXPECTED)}) v(x) WHERE x NOT IN (SELECT commodity FROM dirty WHERE commodity IS NOT NULL)) AS missing_names,
  count(*) FILTER (WHERE price_idr IS NOT NULL AND TRY_CAST(price_idr AS DOUBLE) IS NULL) AS non_numeric_prices,
  (SELECT count(*) FROM (SELECT 1 FROM dirty GROUP BY date, commodity HAVING count(*) > 1)) AS duplicate_keys,
  (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM dirty GROUP BY date, commodity HAVING count(*) > 1))::BIGINT AS duplicate_rows FROM dirty""",
        _DIRTY,
    )
)
def canonical_violations(spark, sf):
    """What a validation counts in rows with broken dates, names, prices and keys."""
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        F.when(k % 97 == 0, "someday").otherwise(F.to_date("o_orderdate").cast("string")).alias("date"),
        F.when(k % 89 != 0, F.col("o_orderpriority")).alias("commodity"),
        F.when(k % 83 == 0, "n/a").when(k % 79 != 0, F.col("o_totalprice").cast("string")).alias("price_idr"),
    )
    return violations(rows.select(*CANONICAL_COLUMNS), _EXPECTED).withColumn("missing_names", F.array_join("missing_names", ","))


@query(on_ready(f"SELECT {_KEYS}, {_rounded_list([*PRICE_FEATURES, *TARGET_VALUES.values()])} FROM ready"))
def training_csv_scan(spark, sf):
    """The training panel written as ordered CSV into the shared folder and read by its schema."""
    write_csv(ready(spark, sf), folder := _scratch(spark, "training"))
    return rounded(read_training_csv(spark, folder))


#: Folders that these queries wrote, the newest for each name: the one before goes when a query is asked again.
_SCRATCH: dict[str, str] = {}


def _scratch(spark, name: str) -> str:
    if name in _SCRATCH:
        Files(spark).delete(_SCRATCH[name])
    _SCRATCH[name] = joined(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    return _SCRATCH[name]


@query(on_ready("SELECT date, commodity, round(price_lag_7d - price_idr, 4) AS drop_7d, round((price_idr - rolling_mean_30d) / (rolling_std_30d + 1e-6), 4) AS price_zscore_30d FROM ready"))
def engineered_sink(spark, sf):
    """The frame with engineered features written as Parquet and read again."""
    path = write_engineered(P.base_features(ready(spark, sf)), _scratch(spark, "engineered"), "v2", "parquet")
    return rounded(spark.read.parquet(path).select("date", "commodity", (F.col("price_lag_7d") - F.col("price_idr")).alias("drop_7d"), "price_zscore_30d"), 4)


@query(on_ready(f"SELECT date, commodity, price_idr, year, is_month_end, {_rounded_list(LAGS)}, round(volatility_30d_pct, 4) AS volatility_30d_pct FROM ready"))
def payload_rows(spark, sf):
    """Rows as JSON objects, with a field too many, and back by the input contract."""
    text = ready(spark, sf).select(F.to_json(F.struct("*", F.lit(1).alias("extra"))).alias("payload"))
    out = parse_payloads(text, "payload")
    return out.select("date", "commodity", "price_idr", "year", "is_month_end", *(F.round(c, 6).alias(c) for c in LAGS), F.round("volatility_30d_pct", 4).alias("volatility_30d_pct"))


_GIVEN = ["extra_a", *[c for c in REQUIRED_COLUMNS if c not in ("price_lag_7d", "month")], "target_7d_inflation_pct"]
_NULLS = " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) FILTER (WHERE {1 if c == 'extra_a' else c} IS NULL) AS n_null FROM ready" for c in _GIVEN)


@query(
    on_ready(
        "SELECT coalesce(g.c, e.c) AS column_name, CASE WHEN e.c IS NULL THEN 'extra' WHEN g.c IS NULL THEN 'missing' ELSE 'present' END AS status, e.k AS position, n_null FROM ("
        + _NULLS + ") g FULL JOIN (SELECT unnest([" + ", ".join(f"'{c}'" for c in REQUIRED_COLUMNS) + f"]) AS c, CAST(unnest(range({len(REQUIRED_COLUMNS)})) AS INTEGER) AS k) e ON g.c = e.c"
    )
)
def input_contract_report(spark, sf):
    """Present, missing and extra columns of a frame against the input contract, with the nulls of those it has."""
    frame = ready(spark, sf).withColumn("extra_a", F.lit(1)).select(*_GIVEN)
    report = spark.createDataFrame(contract_report(frame.columns, REQUIRED_COLUMNS), "column_name string, status string, position int")
    nulls = frame.agg(F.map_from_arrays(F.array(*map(F.lit, _GIVEN)), F.array(*(F.count_if(F.col(c).isNull()) for c in _GIVEN))).alias("n"))
    return report.crossJoin(F.broadcast(nulls)).select("column_name", "status", "position", F.try_element_at("n", F.col("column_name")).alias("n_null"))


@query(on_ready("SELECT DISTINCT date, CAST(quarter(date) AS INTEGER) AS quarter FROM ready"))
def calendar_quarter(spark, sf):
    return panel(spark, sf).select("date", E.quarter().alias("quarter")).distinct()


_ROLES = {"categorical": ["commodity"], "flag": ["is_observed_source", "is_month_start", "is_month_end"], "time": ["date", "year", "month", "week_of_year", "day_of_week"], "target": list(TARGET_VALUES.values())}


_ROLE_OF = [(c, r) for r, cs in (_ROLES | {"numeric": ["price_idr", *PRICE_FEATURES]}).items() for c in cs]


@query(on_ready(" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{r}' AS role, count({c}) AS n_known FROM ready" for c, r in _ROLE_OF)))
def variable_groups(spark, sf):
    """The role of each column, with how many of its values are known."""
    frame = ready(spark, sf)
    roles = [(c, role) for role, columns in A.variable_groups(frame).items() for c in columns]
    long = frame.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("role"), F.col(c).cast("string").alias("value")) for c, r in roles))).alias("x")).select("x.*")
    return long.groupBy("column_name", "role").agg(F.count("value").alias("n_known"))


@query(on_panel("SELECT commodity, date FROM panel QUALIFY row_number() OVER (PARTITION BY commodity ORDER BY date) = 1"))
def first_rows(spark, sf):
    """The first row of each commodity in panel order."""
    return panel(spark, sf).groupBy("commodity").agg(F.min("date").alias("date"))
