import zipfile
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepanel.config import COMMODITIES
from tidepanel.functions import exprs as E
from tidepanel.operators.checks import validate_canonical
from tidepanel.operators.service import read_training_csv
from tidepanel.plans.pipeline import build_dataset, build_from_wide, save_outputs
from tidepanel.sources.ingest import canonical_long, header_date, normal_date_header, parse_wide, top_level_rows
from tidepanel.sources.sheets import read_sheet

HEAD = ["No", "Komoditas (Rp)", " 7/ 8/2025", "28 /2/ 2025"]
NUMBERS = ["xi", " II", "IV\t", "\u00a0V", "C", "mm", "I"]
#: Prices as people type them, and what they mean.
PRICES = {"1,250": 1250.0, "Rp 87.500": 87500.0, "-": None, "n/a": None, "": None, "3 400": 3400.0, "12": 12.0}


def wide_rows():
    labels = [*COMMODITIES][::-1]
    labels[2] = labels[2].replace(" ", "\u00a0 \t")
    rows = [(n, f" {label}\n", shown, "9,999") for n, label, shown in zip(NUMBERS, labels, PRICES, strict=True)]
    return [("3", labels[0], "1", "1"), *rows, (None, labels[1], "2", "2"), ("IX", "Garam", "4", "4")]


def wide(spark, rows=None, head=HEAD):
    return spark.createDataFrame(rows or wide_rows(), ", ".join(f"`{h}` string" for h in head))


def write_xlsx(path, head, rows):
    def cell(k, r, v):
        return "" if v is None else f'<c r="{chr(65 + k)}{r}" t="inlineStr"><is><t>{v}</t></is></c>'

    body = "".join(f'<row r="{r}">' + "".join(cell(k, r, v) for k, v in enumerate(row)) + "</row>" for r, row in enumerate([head, *rows], 1))
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


@settings(max_examples=60, deadline=None)
@given(st.dates(date(1900, 1, 1), date(2200, 1, 1)), st.lists(st.sampled_from(["", " ", "  ", "\u00a0", "\t"]), min_size=6, max_size=6), st.booleans())
def test_header_dates_however_they_are_spaced(day, blanks, padded):
    parts = [f"{day.day:02d}" if padded else str(day.day), f"{day.month:02d}" if padded else str(day.month), str(day.year)]
    header = "/".join(f"{a}{p}{b}" for a, p, b in zip(blanks[::2], parts, blanks[1::2], strict=True))
    assert header_date(header) == day and normal_date_header(header) == day.strftime("%d/%m/%Y")


@pytest.mark.parametrize(("header", "normal"), [(None, ""), ("  Rata-rata ", "Rata-rata"), ("7/8/25", "7/8/25"), ("7/8/2025/1", "7/8/2025/1"), ("007/8/2025", "007/8/2025"), ("-7/8/2025", "-7/8/2025"), ("31/ 6/2025", "31/06/2025"), ("0/1/2025", "00/01/2025")])
def test_headers_that_are_no_dates(header, normal):
    assert header_date(header) is None and normal_date_header(header) == normal


def test_wide_to_panel(spark):
    sheet = parse_wide(wide(spark))
    assert list(sheet.dates.values()) == [date(2025, 8, 7), date(2025, 2, 28)]
    rows = top_level_rows(sheet)
    assert rows.count() == len(NUMBERS) + 1
    found = canonical_long(rows, sheet)
    validate_canonical(found)
    got = {(r["commodity"], r["date"]): r["price_idr"] for r in found.collect()}
    assert {got[c, date(2025, 8, 7)]: None for c in [*COMMODITIES.values()][::-1]} == dict.fromkeys(PRICES.values())
    assert all(got[c, date(2025, 2, 28)] == 9999.0 for c in COMMODITIES.values()) and len(got) == 14


def test_impossible_dates_are_no_columns(spark):
    sheet = parse_wide(wide(spark, head=["No", "Komoditas (Rp)", "30/02/2025", "1/12/2025"]))
    assert list(sheet.dates) == ["1/12/2025"]


@pytest.mark.parametrize(
    ("head", "message"),
    [
        (["No", "Komoditas (Rp)", "9/ 5/2025", "09/05/2025"], "Duplicate logical dates"),
        (["No", "Komoditas (Rp)", "a", "b"], "No date columns"),
        (["No", "Label", "3/5/2025", "4/5/2025"], "metadata columns"),
    ],
)
def test_bad_headers(spark, head, message):
    with pytest.raises(ValueError, match=message):
        parse_wide(wide(spark, head=head))


def test_no_roman_rows(spark):
    rows = [("1", *r[1:]) for r in wide_rows()]
    with pytest.raises(ValueError, match="Roman numeral"):
        build_from_wide(wide(spark, rows))


def test_price_text(spark):
    cases = {"2,750": 2750.0, "-": None, "": None, None: None, "na": None, "-8": 8.0, "7.5": 75.0, " 4\u00a0321 ": 4321.0, "Rp": None, "\u0663": None}
    got = spark.createDataFrame([(t,) for t in cases], "t string").select(E.parse_price("t")).collect()
    assert [r[0] for r in got] == list(cases.values())


def test_white_space_of_any_script(spark):
    texts = ["Cabai\u00a0Merah", "\u2003Cabai \t\x0b Merah\u3000", "Cabai\x1cMerah", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(E.normal_text("t"), E.is_roman(E.col("t"))).collect()
    assert [r[0] for r in got] == ["Cabai Merah"] * 3 + [""] and not any(r[1] for r in got)
    numbers = {"IV": True, "\tiv\u00a0": True, "I V": False, "IV.": False, "": False, "\n": False, "12": False, "IV\nX": False, None: False}
    got = spark.createDataFrame([(t,) for t in numbers], "t string").select(E.is_roman("t")).collect()
    assert [r[0] for r in got] == list(numbers.values())


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([("2025-05-09", "gula_pasir", 1.0), ("2025-05-09", "gula_pasir", 2.0)], "Duplicate"),
        ([("2026-01-01", "gold", 1.0)], "Unexpected commodities"),
        ([("someday", "beras", 1.0)], "unparsable dates"),
    ],
)
def test_validation(spark, rows, message):
    with pytest.raises(ValueError, match=message):
        validate_canonical(spark.createDataFrame(rows, "date string, commodity string, price_idr double"), require_all=False)


def test_missing_commodities_and_bad_prices(spark):
    one = spark.createDataFrame([("2026-01-01", "beras", "x")], "date string, commodity string, price_idr string")
    with pytest.raises(ValueError, match="Missing configured"):
        validate_canonical(one)
    with pytest.raises(ValueError, match="Non-numeric"):
        validate_canonical(one, require_all=False)


def test_sheet_to_files(spark, tmp_path):
    path = tmp_path / "prices.xlsx"
    write_xlsx(path, HEAD, [r if k != 1 else (*r[:3], None) for k, r in enumerate(wide_rows())])
    frame = read_sheet(spark, str(path))
    assert frame.columns == HEAD and frame.count() == len(wide_rows())
    out = build_dataset(spark, str(path))
    assert out.training_ready.count() == 14
    assert out.canonical.where("price_idr is null").count() == 4
    save_outputs(out, tmp_path / "out")
    again = spark.read.option("header", True).csv(str(tmp_path / "out" / "canonical.csv"))
    assert again.count() == 14 and again.columns == ["date", "commodity", "price_idr"]
    save_outputs(out, tmp_path / "one", single_file=True)
    (part,) = (tmp_path / "one" / "training_ready.csv").glob("part-*")
    keys = [tuple(line.split(",")[1::-1]) for line in part.read_text().splitlines()[1:]]
    assert len(keys) == 14 and keys == sorted(keys)


def test_single_file_is_written_after_parallel_work(spark, tmp_path):
    """The shuffle to one task comes after the windows, and the sort is that task's own."""
    from tidepanel.sources import sinks

    frame = spark.range(1000).selectExpr("cast(id % 7 as string) as commodity", "date_add(date'2025-01-01', cast(id as int)) as date").repartition(6)
    sinks.write_csv(frame, tmp_path / "x.csv", single_file=True)
    (part,) = (tmp_path / "x.csv").glob("part-*")
    assert len(part.read_text().splitlines()) == 1001


def test_training_csv_keeps_types(spark, tmp_path):
    out = build_from_wide(wide(spark))
    save_outputs(out, tmp_path / "out")
    again = read_training_csv(spark, str(tmp_path / "out" / "training_ready.csv"))
    assert dict(again.dtypes) == dict(out.training_ready.dtypes)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.training_ready.collect()))


def test_sheet_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_sheet(spark, str(tmp_path / "none.xlsx"))
    write_xlsx(tmp_path / "empty.xlsx", HEAD, [])
    with pytest.raises(ValueError, match="no rows"):
        read_sheet(spark, str(tmp_path / "empty.xlsx"))


def test_files_are_united_by_their_headers(spark, tmp_path):
    """Two months, with columns in different orders and numbers: every price stays under its own date."""
    write_xlsx(tmp_path / "a.xlsx", ["No", "Komoditas (Rp)", "01/01/2025", "02/01/2025"], [("I", "Beras", "10", "11")])
    write_xlsx(tmp_path / "b.xlsx", ["Komoditas (Rp)", "03/02/2025", "No", "01/02/2025", "02/02/2025"], [("Gula Pasir", "23", "I", "21", "22"), ("Beras", None, "II", "31")])
    frame = read_sheet(spark, str(tmp_path / "*.xlsx"))
    assert frame.columns == ["No", "Komoditas (Rp)", "01/01/2025", "02/01/2025", "03/02/2025", "01/02/2025", "02/02/2025"]
    rows = {tuple(r) for r in frame.collect()}
    assert rows == {("I", "Beras", "10", "11", None, None, None), ("I", "Gula Pasir", None, None, "23", "21", "22"), ("II", "Beras", None, None, None, "31", None)}
    write_xlsx(tmp_path / "c.xlsx", ["No", "No"], [("I", "II")])
    with pytest.raises(ValueError, match="repeated"):
        read_sheet(spark, str(tmp_path / "*.xlsx"))
    with pytest.raises(FileNotFoundError):
        read_sheet(spark, str(tmp_path / "none*.xlsx"))
