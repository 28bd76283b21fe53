"""Reading CSV folders: blanks, quotes, unreadable values, unknown columns, differing headers."""

import gzip
from datetime import date

import pytest
from fixture_data import HEADER, ROWS_2017, ROWS_2018, write_fixture

from skytally import load_flight_lines, load_flights, read_landed, reports, rollup_flights
from skytally.sinks import land_flights
from skytally.sources import FLIGHT_SCHEMA


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_declared_schema_and_values(fixture_flights):
    assert [(f.name, f.dataType) for f in fixture_flights.schema] == [(f.name, f.dataType) for f in FLIGHT_SCHEMA]
    rows = fixture_flights.collect()
    assert len(rows) == 11
    assert {r.OP_CARRIER for r in rows} == {"AA", "DL", "D,L"}
    bad = [r for r in rows if r.OP_CARRIER == "D,L"][0]
    assert bad.ARR_DELAY is None and bad.DEP_DELAY == 1.0 and bad.DEST == "SFO"
    assert bad.FL_DATE == date(2017, 7, 6)


def test_blank_values_are_null(fixture_flights):
    codes = [r.CANCELLATION_CODE for r in fixture_flights.filter("CANCELLED = 1").collect()]
    assert sorted(codes, key=str) == ["B", None]


def test_bad_lines_are_kept_when_landed(spark, fixture_folder, tmp_path):
    land_flights(load_flights(spark, fixture_folder, keep_bad=True), str(tmp_path / "landed"))
    landed = read_landed(spark, str(tmp_path / "landed"), keep_bad=True)
    assert landed.count() == 11
    bad = landed.filter("_bad is not null").collect()
    assert [r._bad for r in bad] == ['2017-07-06,"D,L",8,ATL,SFO,1.0,abc,0.0,,q,,,,,']


def test_different_column_order_is_an_error(spark, tmp_path):
    write_fixture(tmp_path)
    swapped = HEADER.replace("ORIGIN,DEST", "DEST,ORIGIN")
    (tmp_path / "2018.csv").write_text(f"{swapped}\n{ROWS_2018}")
    for load in (load_flights, load_flight_lines):
        with pytest.raises(Exception, match="header"):
            load(spark, str(tmp_path)).collect()


def test_reports_on_columns_in_place_still_run(spark, tmp_path):
    write_fixture(tmp_path)
    swapped = HEADER.replace("OP_CARRIER,FLT,ORIGIN", "ORIGIN,FLT,OP_CARRIER")
    (tmp_path / "2018.csv").write_text(f"{swapped}\n{ROWS_2018}")
    flights = load_flights(spark, str(tmp_path))
    assert [tuple(r) for r in reports.cause_totals(flights).collect()] == [(15.0, 45.0, 15.0, 0.0, 45.0)]
    with pytest.raises(Exception, match="2018.csv"):
        reports.volume_by_group(flights).collect()


@pytest.mark.parametrize(
    "header_end, row_end",
    [(",Unnamed: 27", ","), (",", ","), (",X2,X2", ",a,b"), (" , Y ", ",a"), (",a`b", ","), ("\r", "\r")],
)
def test_odd_headers(spark, tmp_path, fixture_flights, header_end, row_end):
    for year, rows in ((2017, ROWS_2017), (2018, ROWS_2018)):
        body = "".join(f"{line}{row_end}\n" for line in rows.splitlines())
        (tmp_path / f"{year}.csv").write_text(f"{HEADER}{header_end}\n{body}")
    assert as_set(load_flights(spark, str(tmp_path))) == as_set(fixture_flights)
    assert as_set(load_flight_lines(spark, str(tmp_path))) == as_set(fixture_flights)


def test_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("FL_DATE,OP_CARRIER\n2017-01-01,AA\n")
    with pytest.raises(ValueError, match="ORIGIN"):
        load_flights(spark, str(tmp_path))


def test_all_files_are_read_whatever_their_names(spark, tmp_path, fixture_flights):
    (tmp_path / "2017.CSV").write_text(f"{HEADER}\n{ROWS_2017}")
    first, *rest = ROWS_2018.splitlines()
    (tmp_path / "part-00000").write_text(f"{HEADER}\n{first}\n")
    (tmp_path / "rest.txt").write_text("\n".join([HEADER, *rest, ""]))
    assert as_set(load_flights(spark, str(tmp_path))) == as_set(fixture_flights)
    assert as_set(load_flight_lines(spark, str(tmp_path))) == as_set(fixture_flights)


def test_files_that_hold_no_flights_are_an_error(spark, tmp_path):
    write_fixture(tmp_path)
    (tmp_path / "notes.txt").write_text("not,flights\n")
    with pytest.raises(Exception, match="header"):
        load_flights(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("first", ["F", "", '"F"', " F ", "FL"])
def test_first_column_of_any_name(spark, tmp_path, fixture_flights, first):
    for year, rows in ((2017, ROWS_2017), (2018, ROWS_2018)):
        body = "".join(f"F9,{line}\n" for line in rows.splitlines())
        (tmp_path / f"{year}.csv").write_text(f"{first},{HEADER}\n{body}")
    for load in (load_flights, load_flight_lines):
        flights = load(spark, str(tmp_path))
        assert flights.count() == 11 and as_set(flights) == as_set(fixture_flights)


def test_numbers_that_are_none_are_null(spark, tmp_path):
    body = ROWS_2018.replace("16.0,40.0", "Inf,NaN").replace("15.0,15.0", "-Infinity,15.0")
    (tmp_path / "2018.csv").write_text(f"{HEADER}\n{body}")
    for load in (load_flights, load_flight_lines):
        flights = load(spark, str(tmp_path))
        want = [("DL", 2, 15.0, 15.0)]
        assert [tuple(r) for r in reports.delay_by_group(flights).collect()] == want
        assert [tuple(r) for r in reports.delay_by_group(rollup_flights(flights)).collect()] == want
        assert [r.DEP_DELAY for r in flights.orderBy("FL_DATE", "OP_CARRIER").collect()] == [None, None, 20.0]


def test_subfolders_are_ignored(spark, tmp_path):
    write_fixture(tmp_path)
    (tmp_path / "output").mkdir()
    (tmp_path / "output" / "old.csv").write_text(f"{HEADER}\n{ROWS_2017}")
    assert load_flights(spark, str(tmp_path)).count() == 11


def test_compressed_files(spark, tmp_path, fixture_flights):
    write_fixture(tmp_path)
    (tmp_path / "2018.csv").unlink()
    (tmp_path / "2018.csv.gz").write_bytes(gzip.compress(f"{HEADER}\n{ROWS_2018}".encode()))
    assert as_set(load_flights(spark, str(tmp_path))) == as_set(fixture_flights)


def test_pattern(spark, fixture_folder):
    with pytest.warns(UserWarning, match="leaves out 1 files"):
        assert load_flights(spark, fixture_folder, pattern="2018*").count() == 3


def test_several_paths(spark, fixture_folder):
    files = [f"{fixture_folder}/2017.csv", f"{fixture_folder}/2018.csv"]
    assert as_set(load_flights(spark, files)) == as_set(load_flights(spark, fixture_folder))


def test_given_header(spark, fixture_folder, fixture_flights):
    assert as_set(load_flights(spark, fixture_folder, header=HEADER.split(","))) == as_set(fixture_flights)
    with pytest.raises(Exception, match="header"):
        load_flights(spark, fixture_folder, header=sorted(HEADER.split(","))).collect()


def test_times_in_dates_are_dropped(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{ROWS_2018.replace('2018-01-05,', '2018-01-05 00:00:00,')}")
    assert date(2018, 1, 5) in {r.FL_DATE for r in load_flights(spark, str(tmp_path)).collect()}


def test_short_and_unreadable_lines_do_not_stop_a_run(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{ROWS_2018}not a date,ZZ,9\n2018-02-30,YY,9,A,B,x,y,z\n")
    rows = {r.OP_CARRIER: r for r in load_flights(spark, str(tmp_path)).collect()}
    assert rows["ZZ"].FL_DATE is None and rows["ZZ"].ORIGIN is None
    assert rows["YY"].FL_DATE is None and rows["YY"].ORIGIN == "A" and rows["YY"].CANCELLED is None


def test_lines_give_the_same_flights(spark, fixture_folder, fixture_flights):
    assert as_set(load_flight_lines(spark, fixture_folder)) == as_set(fixture_flights)


def test_lines_drop_headers_in_the_middle(spark, tmp_path, fixture_flights):
    (tmp_path / "all.csv").write_text(f"{HEADER}\n{ROWS_2017}{HEADER}\n{ROWS_2018}")
    assert as_set(load_flight_lines(spark, str(tmp_path))) == as_set(fixture_flights)


def test_quoted_header_and_empty_lines(spark, tmp_path, fixture_flights):
    quoted = ",".join(f'"{name}"' for name in HEADER.split(","))
    (tmp_path / "2017.csv").write_text(f"{quoted}\n\n{ROWS_2017}\n\n")
    (tmp_path / "2018.csv").write_text(f"{quoted}\n{ROWS_2018}")
    for load in (load_flights, load_flight_lines):
        flights = load(spark, str(tmp_path))
        assert flights.count() == 11 and as_set(flights) == as_set(fixture_flights)


ODD_LINES = """not a date,ZZ,9
2018-02-30,YY,9,A,B,x,y,z
2018-01-01,XX,9,A,B,1.0,2.0,0.0,,q,1.0,1.0,1.0,1.0,1.0,extra
2018-01-01,"W,W",9,A,B,1.0,2.0,0.0
2018-01-01,"W,V",9,A,B,zz,2.0,0.0,,q,,,,,
"2018-01-01"," ""U"" ",9,A,"B",zz,2.0,0.0,,q,,,,,
 , , , , , , , , , , , , , ,\x20
2018-01-01,\tVV\t,9,A,B,NaN,Inf,Infinity,,q,1e3,0x1,1d,-,+1
"""


def test_both_ways_keep_the_same_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{ROWS_2017}{ODD_LINES}")
    by_csv, by_lines = (load(spark, str(tmp_path), keep_bad=True) for load in (load_flights, load_flight_lines))
    assert by_csv.columns == by_lines.columns
    assert as_set(by_csv) == as_set(by_lines)
    bad = {r._bad for r in by_lines.collect() if r._bad}
    assert len(bad) == 6 and any("abc" in line for line in bad)


def test_only_lines_with_quotes_go_through_the_parser(spark, fixture_folder):
    plan = load_flight_lines(spark, fixture_folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1 and "Contains(value" in plan
