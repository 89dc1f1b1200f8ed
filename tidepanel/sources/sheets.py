"""Spreadsheet (.xlsx) source: a Python data source over the zip and XML of the file.

``spark.read.format("sheet").option("path", ...).load()`` gives every cell as
text; the first row names the columns. A sheet is small by its format (at most
1,048,576 rows), so one file is one partition; a glob gives one for each file.

Files of one glob are united by the names of their columns: a column that a file
lacks is null in its rows, and columns count in the order in which the files, by
name, bring them. A header that a file has twice is an error, as its cells could
not be told apart. Files are read where the tasks run, so they must lie in a
folder that all executors mount.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _column_number(reference: str) -> int:
    n = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _sheet_file(book: zipfile.ZipFile, sheet: str | int) -> str:
    sheets = ET.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets")
    entries = list(sheets)
    if isinstance(sheet, int) or sheet.isdigit():
        entry = entries[int(sheet)] if int(sheet) < len(entries) else None
    else:
        entry = next((e for e in entries if e.get("name") == sheet), None)
    if entry is None:
        raise ValueError(f"No sheet {sheet!r}")
    links = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(x.get("Target") for x in links if x.get("Id") == entry.get(_LINK))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of cell styles that show a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    own = {int(x.get("numFmtId")): x.get("formatCode", "") for x in root.iter(f"{_MAIN}numFmt")}
    dated = {n for n, code in own.items() if re.search(r"[dmy]", re.sub(r"\"[^\"]*\"|\[[^\]]*\]", "", code), re.I)} | set(range(14, 23))
    styles = root.find(f"{_MAIN}cellXfs")
    return {k for k, x in enumerate(styles if styles is not None else []) if int(x.get("numFmtId", 0)) in dated}


def read_cells(path: str, sheet: str | int = 0) -> Iterator[list[str | None]]:
    """Rows of a sheet as texts; empty cells and rows of none are None and skipped."""
    if not Path(path).exists():
        raise FileNotFoundError(path)
    with zipfile.ZipFile(path) as book:
        shared = [_text(x) for x in ET.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in book.namelist() else []
        dated = _date_styles(book)
        with book.open(_sheet_file(book, sheet)) as part:
            for _, row in ET.iterparse(part):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list[str | None] = []
                for k, c in enumerate(row):
                    at = _column_number(c.get("r")) if c.get("r") else k
                    cells.extend([None] * (at + 1 - len(cells)))
                    value, kind = c.find(f"{_MAIN}v"), c.get("t")
                    if kind == "inlineStr":
                        cells[at] = _text(c)
                    elif value is not None and value.text is not None:
                        text = value.text
                        if kind == "s":
                            text = shared[int(text)]
                        elif kind is None and int(c.get("s", 0)) in dated:
                            text = (date(1899, 12, 30) + timedelta(days=int(float(text)))).strftime("%d/%m/%Y")
                        cells[at] = text
                row.clear()
                if any(x is not None for x in cells):
                    yield cells


def _header(path: str, sheet: str | int) -> list[str]:
    first = next(read_cells(path, sheet), None)
    if first is None:
        raise ValueError(f"Sheet is empty: {path}")
    names = [f"_c{k}" if x is None else x for k, x in enumerate(first)]
    if len(set(names)) != len(names):
        raise ValueError(f"Sheet has repeated headers: {sorted({h for h in names if names.count(h) > 1})} in {path}")
    return names


def sheet_files(path: str) -> list[str]:
    """The file, or the files of a glob by name."""
    if not any(c in path for c in "*?["):
        if not Path(path).exists():
            raise FileNotFoundError(path)
        return [path]
    found = sorted(str(p) for p in Path(path).parent.glob(Path(path).name))
    if not found:
        raise FileNotFoundError(path)
    return found


def united_header(paths: list[str], sheet: str | int) -> list[str]:
    return list(dict.fromkeys(h for p in paths for h in _header(p, sheet)))


class _SheetPartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _SheetReader(DataSourceReader):
    def __init__(self, paths: list[str], sheet: str | int, columns: list[str]):
        self.paths, self.sheet, self.columns = paths, sheet, columns

    def partitions(self):
        return [_SheetPartition(p) for p in self.paths]

    def read(self, partition):
        own = {h: k for k, h in enumerate(_header(partition.path, self.sheet))}
        places = [own.get(c) for c in self.columns]
        rows = read_cells(partition.path, self.sheet)
        next(rows)
        for cells in rows:
            yield tuple(cells[k] if k is not None and k < len(cells) else None for k in places)


class SheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sheet"

    def _sheet(self):
        return self.options.get("sheet", "0")

    def schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in united_header(sheet_files(self.options["path"]), self._sheet())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SheetReader(sheet_files(self.options["path"]), self._sheet(), schema.fieldNames())


def read_sheet(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """The sheet, or the united sheets of a glob, as a frame of texts. Missing files and empty sheets are errors at once."""
    for file in sheet_files(path):
        _header(file, sheet)
        if len(list(zip(range(2), read_cells(file, sheet), strict=False))) < 2:
            raise ValueError(f"Sheet has no rows: {file}")
    spark.dataSource.register(SheetSource)
    return spark.read.format("sheet").option("sheet", str(sheet)).load(path)
