"""Assertions on schemas and data; each raises ValueError with what is wrong."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CANONICAL_COLUMNS, COMMODITIES, MODEL_FEATURES, REQUIRED_COLUMNS
from .positions import with_positions


def require_columns(frame: DataFrame, columns: Iterable[str], what: str = "required columns") -> None:
    if missing := [c for c in columns if c not in frame.columns]:
        raise ValueError(f"Missing {what}: {missing}")


def require_input_contract(frame: DataFrame) -> None:
    require_columns(frame, REQUIRED_COLUMNS, "feature-ready input columns")


def contract_report(columns: Iterable[str], expected: Iterable[str]) -> list[tuple[str, str, int | None]]:
    """(column, status, position in the contract): present, missing, or extra (which scoring leaves out)."""
    columns, expected = list(columns), list(expected)
    held = set(columns)
    out = [(c, "present" if c in held else "missing", k) for k, c in enumerate(expected)]
    return out + [(c, "extra", None) for c in columns if c not in set(expected)]


def require_no_leakage(columns: Iterable[str]) -> None:
    if leaking := [c for c in columns if c.startswith("target_")]:
        raise ValueError(f"Target leakage detected in feature columns: {leaking}")


def require_column_order(columns: list[str], expected: list[str] = MODEL_FEATURES) -> None:
    if list(columns) != list(expected):
        raise ValueError("Engineered feature column order differs from the training contract")


def duplicate_pairs(frame: DataFrame) -> DataFrame:
    """date, commodity, n of keys with more than one row (summed before the shuffle)."""
    return frame.groupBy("date", "commodity").agg(F.count("*").alias("n")).where("n > 1")


def require_unique_keys(frame: DataFrame) -> None:
    found = duplicate_pairs(frame).orderBy("commodity", "date").limit(10).collect()
    if found:
        raise ValueError(f"Duplicate (date, commodity) rows, such as {[(str(r['date']), r['commodity']) for r in found]}")


def unique_day(rows: str) -> Column:
    """A filter that all rows pass, and that fails the job where a key's ``rows`` are more than one."""
    message = F.concat(F.lit("Duplicate (date, commodity) rows: "), F.coalesce(F.col("date").cast("string"), F.lit("null")), F.lit(", "), F.col("commodity"))
    return F.when(F.col(rows) > 1, F.raise_error(message).isNull()).otherwise(True)


def violations(frame: DataFrame, names=None) -> DataFrame:
    """One row of counts: unparsable dates, unexpected names, non-numeric prices, repeated keys and their surplus rows, and the configured names that are missing.

    What is gathered is bounded: the configured names that occur.
    """
    require_columns(frame, CANONICAL_COLUMNS, "canonical columns")
    names = sorted(COMMODITIES.values() if names is None else names)
    known = F.col("commodity").isin(names)
    seen = F.collect_set(F.when(known, F.col("commodity")))
    counts = frame.agg(
        F.count_if(_bad_date()).alias("unparsable_dates"),
        F.count_if(F.col("commodity").isNotNull() & ~known).alias("unexpected_rows"),
        F.array_sort(F.array_except(F.array(*map(F.lit, names)), seen)).alias("missing_names"),
        F.count_if(_bad_price()).alias("non_numeric_prices"),
    )
    repeated = duplicate_pairs(frame).agg(F.count("*").alias("duplicate_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    # Two single rows side by side.
    return counts.crossJoin(F.broadcast(repeated))


def _bad_date() -> Column:
    return F.col("date").cast("string").try_cast("date").isNull()


def _bad_price() -> Column:
    return F.col("price_idr").isNotNull() & F.col("price_idr").cast("string").try_cast("double").isNull()


def bad_price_rows(frame: DataFrame, *order: str, limit: int = 10) -> DataFrame:
    """The first rows with a price that is no number: position (from 0, in the order given, else that of the canonical panel) and the row."""
    placed = with_positions(frame, *(order or ("date", "commodity")))
    return placed.where(_bad_price()).orderBy("position").limit(limit).select("position", *frame.columns)


def validate_canonical(frame: DataFrame, require_all: bool = True, names=None, order: tuple[str, ...] = ()) -> None:
    """Dates, names, prices and keys of a canonical panel; examples are looked for only where a count is not zero.

    Numbers of rows with bad prices count from 0 in ``order`` (date and
    commodity, if not given).
    """
    names = sorted(COMMODITIES.values() if names is None else names)
    got = violations(frame, names).first()
    if got["unparsable_dates"]:
        raise ValueError(f"Canonical panel has {got['unparsable_dates']} unparsable dates")
    if got["unexpected_rows"]:
        some = frame.where(F.col("commodity").isNotNull() & ~F.col("commodity").isin(names)).select("commodity").distinct().orderBy("commodity").limit(10).collect()
        raise ValueError(f"Unexpected commodities: {[r[0] for r in some]}")
    if require_all and got["missing_names"]:
        raise ValueError(f"Missing configured commodities: {got['missing_names']}")
    if got["non_numeric_prices"]:
        some = bad_price_rows(frame, *order).select("position").collect()
        raise ValueError(f"Non-numeric prices: {got['non_numeric_prices']} rows, the first at {[r[0] for r in some]}")
    if got["duplicate_keys"]:
        require_unique_keys(frame)


def require_rows(frame: DataFrame, what: str) -> None:
    if frame.isEmpty():
        raise ValueError(what)


def require_horizon(horizon: int) -> None:
    if horizon not in (7, 30):
        raise ValueError(f"Unsupported horizon: {horizon}; use 7 or 30")
