"""CSV ingestion and cleaning (T-1) on a dirty file."""

import csv
import datetime as dt

import pytest

from starmart.params import Params
from starmart.sources import csv_ingest

HEADER = ("Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,"
          "Country/Region,City,State,Postal Code,Region,Product ID,Category,Sub-Category,"
          "Product Name,Sales,Quantity,Discount,Profit")

LINES = [
    "1,CA-1,08/11/2020,11/11/2020,Second Class,CG-1,Claire,Consumer,United States,Henderson,"
    "Kentucky,42420,South,FUR-1,Furniture,Bookcases,Shelf,261.96,2,0,41.91",
    "2,CA-2,8/6/2021,12/06/2021,sas,CG-2,Dan,Corporate,United States,Burlington,Vermont,,East,"
    "OFF-1,Office Supplies,Labels,Label,14.62,2,0,6.87",
    "3,CA-3,31/02/2021,02/03/2021,Standard Class,CG-3,Eve,Consumer,United States,Austin,Texas,"
    "78701,Central,TEC-1,Technology,Phones,Phone,22.37,3,0.2,-5.5",
    "4,CA-4,15/09/2021,20/09/2021,First Class,CG-4,Fay,Home Office,United States,Austin,Texas,"
    "05401,Central,TEC-2,Technology,Phones,Phone X,957.58,5,0.45,-383.03",
]


def test_stage_csv(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(HEADER + "\n" + "\n".join(LINES) + "\n")
    staged = csv_ingest.stage_csv(spark, str(path), Params())
    rows = {r.row_id: r for r in staged.collect()}
    assert 1 not in rows  # the known-bad row
    assert rows[2].order_date == dt.date(2021, 6, 8)  # one-digit day and month
    assert rows[2].postal_code == "05401"  # filled, leading zero kept
    assert rows[4].postal_code == "05401"
    assert rows[3].order_date is None  # impossible date -> NULL, counted below
    assert str(rows[4].discount) == "0.45"
    text = csv_ingest.read_sales_text(spark, str(path))
    assert {r.column_name: r.rejects for r in csv_ingest.reject_counts(text).collect()} == {"order_date": 1}
    assert sorted(r.ship_mode for r in csv_ingest.distinct_values(staged, "ship_mode").collect()) \
        == ["First Class", "Standard Class", "sas"]


def _write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def test_rfc4180_file_with_swapped_columns_and_bad_values(spark, tmp_path):
    """Written by Python's csv module: doubled quotes, commas, columns in
    another order, a bad date, a bad number, a short line."""
    names = HEADER.split(",")
    rows = [dict(zip(names, ln.split(","))) for ln in LINES]
    rows[1]["Product Name"] = 'Acme "Slim" Table, 3" Oak'
    rows[2]["Sales"] = "N/A"
    swapped = [*reversed(names), "Extra"]
    path = tmp_path / "swapped.csv"
    _write(path, swapped, [[r.get(n, "x") for n in swapped] for r in rows] + [["9.9", "0.1"]])
    text = csv_ingest.read_sales_text(spark, str(path))
    staged = {r.row_id: r for r in csv_ingest.clean(csv_ingest.typed(text), Params()).collect()}
    assert staged[2].product_name == 'Acme "Slim" Table, 3" Oak'
    assert (staged[2].state, staged[2].region, str(staged[2].sales)) == ("Vermont", "East", "14.6200")
    assert staged[3].sales is None and staged[3].order_date is None
    got = sorted((r.row_id or "", r.column_name, r.value) for r in csv_ingest.rejects(text).collect())
    assert got == [("", "*", "9.9,0.1"), ("3", "order_date", "31/02/2021"), ("3", "sales", "N/A")]


def test_quoted_newlines(spark, tmp_path):
    names = HEADER.split(",")
    row = dict(zip(names, LINES[1].split(","))) | {"Product Name": "two\nlines"}
    _write(tmp_path / "n.csv", names, [[row[n] for n in names]])
    text = csv_ingest.read_sales_text(spark, str(tmp_path / "n.csv"), multi_line=True)
    assert [r.product_name for r in csv_ingest.typed(text).collect()] == ["two\nlines"]


def test_missing_column_is_an_error(spark, tmp_path):
    _write(tmp_path / "m.csv", HEADER.split(",")[1:], [])
    with pytest.raises(ValueError, match="Row ID"):
        csv_ingest.read_sales_text(spark, str(tmp_path / "m.csv"))


def test_the_exported_csv_is_packed(spark, make_staging, tmp_path):
    from conftest import D, line

    rows = make_staging([line(i, i, D(2020, 1, 1)) for i in range(1, 30)])
    csv_ingest.export_csv(rows, str(tmp_path / "out"))
    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "out").glob("part-*"))
    assert csv_ingest.read_sales_text(spark, str(tmp_path / "out")).count() == 29
