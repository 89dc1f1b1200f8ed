"""Wide sheets to the canonical long panel.

Headers are schema, not data, so dates are parsed on the driver; everything
else is a lazy plan: filter, unpivot, projections.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COMMODITIES, LABEL_COLUMN, NUMBER_COLUMN
from ..functions import exprs as E
from ..operators.checks import require_columns, require_rows

#: Characters that a day, a month and a year may take.
_SIZES = ((1, 2), (1, 2), (4, 4))


def _date_parts(header) -> list[str] | None:
    """Day, month and year of a header that has three numbers between slashes, as written."""
    parts = [p.strip() for p in str(header).split("/")]
    fits = len(parts) == 3 and all(p.isdecimal() and low <= len(p) <= high for p, (low, high) in zip(parts, _SIZES, strict=True))
    return parts if fits else None


def normal_date_header(header) -> str:
    """A date header as dd/mm/yyyy, whether or not that day exists; other text only loses its outer blanks."""
    if header is None:
        return ""
    parts = _date_parts(header)
    return "/".join(p.zfill(2) for p in parts) if parts else str(header).strip()


def header_date(header) -> date | None:
    """The day that a header names; None for other text and for days that don't exist."""
    parts = _date_parts(header)
    if not parts:
        return None
    day, month, year = map(int, parts)
    try:
        return date(year, month, day)
    except ValueError:
        return None


@dataclass(frozen=True)
class WideSheet:
    frame: DataFrame
    dates: dict[str, date]

    @property
    def metadata(self) -> list[str]:
        return [NUMBER_COLUMN, LABEL_COLUMN]


def parse_wide(frame: DataFrame) -> WideSheet:
    """Find the date columns; columns that are neither metadata nor dates are left out."""
    require_columns(frame, [NUMBER_COLUMN, LABEL_COLUMN], "metadata columns")
    dates = {c: d for c in frame.columns if c not in (NUMBER_COLUMN, LABEL_COLUMN) and (d := header_date(c))}
    if not dates:
        raise ValueError("No date columns found in the header")
    by_day = defaultdict(list)
    for c, d in dates.items():
        by_day[d].append(c)
    if repeated := {str(d): cs for d, cs in by_day.items() if len(cs) > 1}:
        raise ValueError(f"Duplicate logical dates in the header: {repeated}")
    return WideSheet(frame, dates)


def top_level_rows(sheet: WideSheet) -> DataFrame:
    """Rows numbered with Roman numerals, metadata and date columns."""
    rows = sheet.frame.where(E.is_roman(F.col(f"`{NUMBER_COLUMN}`")))
    require_rows(rows, "No top-level rows: none is numbered with a Roman numeral")
    return rows.select(*(F.col(f"`{c}`") for c in [*sheet.metadata, *sheet.dates]))


def canonical_long(rows: DataFrame, sheet: WideSheet, names: dict[str, str] | None = None) -> DataFrame:
    """date, commodity, price_idr of rows whose label is configured."""
    names = COMMODITIES if names is None else names
    known = rows.withColumn("commodity", E.commodity_of(E.normal_text(F.col(f"`{LABEL_COLUMN}`")), names)).where("commodity is not null")
    require_rows(known, "No configured commodity among the top-level rows")
    texts = known.select("commodity", *(F.col(f"`{c}`").cast("string").alias(f"d{k}") for k, c in enumerate(sheet.dates)))
    long = texts.unpivot("commodity", [f"d{k}" for k in range(len(sheet.dates))], "d", "text")
    days = F.create_map(*(x for k, d in enumerate(sheet.dates.values()) for x in (F.lit(f"d{k}"), F.lit(d))))
    return long.select(F.element_at(days, F.col("d")).alias("date"), "commodity", E.parse_price("text").alias("price_idr"))
