import datetime as dt

from fileflow.sources.excel import read_excel
from fileflow.testing import workbook_bytes
from tests.conftest import write


def test_padded_names_and_strip(spark, scratch):
    write(f"{scratch}/p.xlsx", workbook_bytes([("S", [["Employee ID", "  Name  ", "Salary"],
                                                      [1, "  Alice ", 100], [2, "Bob", 200]])]))
    r = read_excel(spark, f"{scratch}/p.xlsx")
    assert r.data.columns[:3] == ["employee_id", "name", "salary"]
    assert sorted((x.employee_id, x.name, x.salary) for x in r.data.collect()) == \
        [(1, "Alice", 100), (2, "Bob", 200)]


def test_empty_row_dropped_and_dates(spark, scratch):
    rows = [["id", "value", "date_col"], [1, "a", "2024-01-05"], [None, None, None], None,
            [3, "c", "not a date"]]
    write(f"{scratch}/e.xlsx", workbook_bytes([("S", rows)]))
    r = read_excel(spark, f"{scratch}/e.xlsx", date_columns=["date_col"])
    got = sorted((x.id, x.value, x.date_col, x.row_id) for x in r.data.collect())
    assert got == [(1, "a", dt.datetime(2024, 1, 5), 0), (3, "c", None, 1)]


def test_typed_date_cells(spark, scratch):
    rows = [["when", "flag"], [dt.datetime(2024, 2, 3, 4, 5, 6), True], [dt.date(2023, 1, 1), False]]
    write(f"{scratch}/d.xlsx", workbook_bytes([("S", rows)]))
    r = read_excel(spark, f"{scratch}/d.xlsx")
    assert dict(r.data.dtypes)["when"] == "timestamp"
    assert sorted(x.when for x in r.data.collect()) == [dt.datetime(2023, 1, 1),
                                                        dt.datetime(2024, 2, 3, 4, 5, 6)]
    assert dict(r.data.dtypes)["flag"] == "boolean"


def test_header_offset_sheet_by_name_and_all_sheets(spark, scratch):
    wb = workbook_bytes([("Intro", [["title"], ["x"]]),
                         ("Data", [["Report title"], ["Skip me"], ["k", "v"], ["a", 1]])])
    write(f"{scratch}/w.xlsx", wb)
    r = read_excel(spark, f"{scratch}/w.xlsx", sheet="Data", skip_rows=1, header_row=1)
    assert [(x.k, x.v) for x in r.data.collect()] == [("a", 1)]
    allr = read_excel(spark, f"{scratch}/w.xlsx", sheet=None)
    assert sorted(x.sheet for x in allr.data.collect()) == ["Data", "Data", "Data", "Intro"]


def test_binary_workbooks_rejected(spark, scratch):
    write(f"{scratch}/old.xls", b"\xd0\xcf\x11\xe0 not decoded")
    write(f"{scratch}/ok.xlsx", workbook_bytes([("S", [["a"], [1]])]))
    r = read_excel(spark, scratch)
    assert [x.reason for x in r.rejects.collect()] == ["binary workbook format not supported"]
    assert r.data.count() == 1
