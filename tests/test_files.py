import datetime as dt

import feedfiles as ff
import pytest
from conftest import order, rows
from pyspark.sql import functions as F

from shelfcast.functions import times
from shelfcast.operators import labs
from shelfcast.plans import bulk
from shelfcast.settings import DEFAULT_RULES
from shelfcast.sources import checks, feeds, landing, reports

D9, D10 = dt.date(2018, 4, 9), dt.date(2018, 4, 10)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("feeds")
    ff.write(path, ff.CBC % "2018-04-10", feeds.LABS, ff.LABS_A)
    ff.write(path, ff.CENSUS % "2018-04-10", feeds.CENSUS, ff.CENSUS_A)
    ff.write(path, ff.CENSUS % "2018-04-11", feeds.CENSUS, ff.CENSUS_B)
    ff.write(path, ff.ISSUES % "2018-04-10", feeds.TRANSFUSION, ff.ISSUES_A)
    ff.write(path, ff.ISSUES % "2018-04-11", feeds.TRANSFUSION, ff.ISSUES_B)
    ff.write(path, ff.STOCK % "2018-04-10", feeds.INVENTORY, ff.UNITS)
    return str(path)


def test_lab_scan_types_and_identifiers(spark, folder):
    df = feeds.read_feed(spark, folder, feeds.LABS)
    assert df.count() == 10
    assert "pat_mrn_id" not in df.columns and "pat_id" not in df.columns
    assert dict(df.dtypes)["result_time"] == "timestamp_ntz"
    assert dict(df.dtypes)["order_proc_id"] == "int"
    names = {r.file_name for r in df.select("file_name").distinct().collect()}
    assert names == {ff.CBC % "2018-04-10"}


def test_file_name_filter_prunes_the_listing(spark, folder):
    df = feeds.read_feed(spark, folder, feeds.TRANSFUSION)
    assert df.select("file_name").distinct().count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "file_name" in plan and "RLIKE" in plan.upper()


def test_bulk_labs(spark, folder, tmp_path):
    got = rows(bulk.process_all_labs(spark, folder, report_folder=str(tmp_path)))
    assert got == sorted(
        [
            (D9, "HGB", 8.5), (D9, "PLT", 0.0), (D9, "PLT", 5.0), (D9, "PLT", None),
            (D9, "WBC", 12.5), (D9, "WBC", 4.0), (dt.date(1975, 4, 10), "RBC", 4.1),
        ],
        key=order,
    )
    summary = reports.read_report(spark, str(tmp_path), "lab_summary", "2018-04-10")
    by_name = {r.base_name: r for r in summary.collect()}
    assert (by_name["HGB"].total_n, by_name["HGB"].abnormal_n) == (2, 2)
    assert (by_name["WBC"].total_n, by_name["WBC"].abnormal_n) == (2, 1)
    plt = by_name["PLT"]
    assert (plt.total_n, plt.missing_n, plt.min, plt.median, plt.max) == (4, 2, 0.0, 2.5, 5.0)
    missing = reports.read_report(spark, str(tmp_path), "lab_missing_values", "2018-04-10")
    assert rows(missing, "ord_value") == [("see note",), (None,)]


def test_strict_lab_numbers(spark, folder):
    raw = feeds.read_feed(spark, folder, feeds.LABS)
    values = labs.lab_values(raw, DEFAULT_RULES, strict=True)
    plt = values.filter("base_name = 'PLT'")
    assert rows(plt.filter("ord_value = '<0.15'"), "lab_value") == [(None,)]
    assert rows(plt.filter("ord_value = '<0.1'"), "lab_value") == [(0.0,)]
    assert labs.lab_missing_values(values, strict=True).count() == 3
    assert labs.lab_clean(values, dedupe="rows").count() == 9


def test_bulk_census_sums_dates_across_files(spark, folder, tmp_path):
    wide = bulk.process_all_census(spark, folder, report_folder=str(tmp_path))
    assert rows(wide, "date", "B1", "`E2-ICU`", "H2") == [(D9, 3, 1, 0), (D10, 1, 0, 0)]
    assert "UNKNOWN-9" not in wide.columns and len(wide.columns) == 27
    report = reports.read_report(spark, str(tmp_path), "census_summary", "2018-04-10")
    assert (D9, "UNKNOWN-9", 1) in rows(report, "date", "ward", "n")


def test_bulk_transfusion_sums_dates_across_files(spark, folder, tmp_path):
    used = bulk.process_all_transfusion(spark, folder, str(tmp_path))
    assert rows(used, "date", "used") == [(D9, 3), (D10, 6)]


def test_bulk_inventory(spark, folder, tmp_path):
    stock = bulk.process_all_inventory(spark, folder, str(tmp_path))
    assert rows(stock, "date", "count", "r1", "r2", "r3_plus") == [(D9, 5, 2, 2, 1)]
    expiry = reports.read_report(spark, str(tmp_path), "inventory_expiry", "2018-04-10")
    flags = rows(expiry, "already_expired")
    assert len(flags) == 8 and flags.count((True,)) == 2 and flags.count((None,)) == 1
    assert expiry.first().expiry_time == dt.datetime(2018, 4, 12, 23, 59)


def test_inventory_with_given_date(spark, folder):
    raw = feeds.read_feed(spark, folder, feeds.INVENTORY)
    done = bulk.process_inventory(raw, "2020-01-01").data
    assert rows(done, "date", "count") == [(dt.date(2020, 1, 1), 5)]


def test_checks_on_files(spark, folder, tmp_path):
    ff.write(tmp_path, ff.CBC % "2018-04-10", feeds.LABS, [])
    bad = [ff.lab("nonsense", "RBC", "4.1"), ff.lab("nonsense", "HCT", "30")]
    ff.write(tmp_path, ff.CBC % "2018-04-11", feeds.LABS, bad)
    path = str(tmp_path)
    assert rows(checks.empty_files(spark, path, feeds.LABS)) == [(ff.CBC % "2018-04-10",)]
    raw = feeds.read_feed(spark, path, feeds.LABS)
    assert rows(checks.bad_timestamps(raw, "result_time")) == [(ff.CBC % "2018-04-11", 2)]
    problems = checks.file_problems(spark, path, feeds.LABS, raw, landing.bad_stamp(feeds.LABS))
    assert rows(problems) == [(ff.CBC % "2018-04-10", 0, 0), (ff.CBC % "2018-04-11", 2, 1)]
    with pytest.raises(checks.FeedError):
        bulk.process_all_labs(spark, path)
    assert bulk.process_all_transfusion(spark, folder).count() == 2


def test_file_cardinality(spark, folder):
    bad = checks.file_cardinality_violations(spark, folder, ["2018-04-10", "2018-04-11"])
    assert rows(bad, "feed", "date", "n_files") == [("labs", dt.date(2018, 4, 11), 0)]
    assert rows(checks.file_cardinality_violations(spark, folder, ["2018-04-10"])) == []


def test_daily_files_carry_as_of(spark, folder):
    df = feeds.read_feed_for_dates(spark, folder, feeds.CENSUS, ["2018-04-11"])
    assert rows(df, "as_of") == [(dt.date(2018, 4, 11),)]
    both = feeds.read_feed_for_dates(spark, folder, feeds.CENSUS)
    assert both.select("as_of").distinct().count() == 2


def reordered(folder, name, feed, order, rows, extra=()):
    columns = [*[list(feed.columns)[i] for i in order], *extra]
    lines = ["\t".join(columns), *["\t".join(str(r.get(c, "extra")) for c in columns) for r in rows]]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_columns_are_found_by_each_files_header(spark, folder, tmp_path):
    """Two orders and one more column in a folder, with names that are patterns, read as one order does."""
    n = len(feeds.CENSUS.columns)
    full = [{c: r.get(c, "") for c in feeds.CENSUS.columns} for r in ff.CENSUS_A]
    reordered(tmp_path, ff.CENSUS % "2018-04-10", feeds.CENSUS, range(n), full)
    reordered(tmp_path, ff.CENSUS % "2018-04-11", feeds.CENSUS, [3, 5, *[i for i in range(n) if i not in (3, 5)]], full)
    reordered(tmp_path, (ff.CENSUS % "2018-04-12").replace(".txt", "[a] {b}.txt"), feeds.CENSUS, reversed(range(n)), full, ("MORE", "YET"))
    got = feeds.read_feed(spark, str(tmp_path), feeds.CENSUS)
    assert got.count() == 15 and "more" not in got.columns and "pat_id" not in got.columns
    columns = [c for c in got.columns if c != "file_name"]
    files = [r[0] for r in got.select("file_name").distinct().collect()]
    want = rows(feeds.read_feed(spark, folder, feeds.CENSUS, ff.CENSUS % "2018-04-10"), *columns)
    assert len(files) == 3
    assert all(rows(got.filter(F.col("file_name") == f), *columns) == want for f in files)


def test_one_file_in_another_order(spark, folder, tmp_path):
    reordered(tmp_path, ff.CENSUS % "2018-04-10", feeds.CENSUS, reversed(range(len(feeds.CENSUS.columns))),
              [{c: r.get(c, "") for c in feeds.CENSUS.columns} for r in ff.CENSUS_B])
    assert rows(bulk.process_census(feeds.read_feed(spark, str(tmp_path), feeds.CENSUS)).data, "ward", "n") == [("B1", 1)]


def test_header_without_a_column_is_an_error(spark, tmp_path):
    for name, columns in (("2018-04-10", list(feeds.CENSUS.columns)[1:]), ("2018-04-11", [*feeds.CENSUS.columns, "PAT_ID"])):
        folder = tmp_path / name
        folder.mkdir()
        (folder / (ff.CENSUS % name)).write_text("\t".join(columns) + "\nx\n")
        with pytest.raises(feeds.HeaderError, match="header"):
            feeds.read_feed(spark, str(folder), feeds.CENSUS)


def executions(spark, after=-1):
    """(number, scans of text files) of the executions later than ``after`` that Spark still lists."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    seen = spark._jsparkSession.sharedState().statusStore().executionsList()
    found = [seen.apply(i) for i in range(seen.size())]
    return [
        (e.executionId(), e.physicalPlanDescription().count("Scan csv"))
        for e in found if e.executionId() > after
    ]


def test_raw_text_is_scanned_once_per_feed(spark, folder, tmp_path):
    """Checks, reports and series of labs, patients and units read what has landed."""
    before = max((n for n, _ in executions(spark)), default=-1)
    bulk.process_all_labs(spark, folder, report_folder=str(tmp_path)).collect()
    bulk.process_all_census(spark, folder, report_folder=str(tmp_path)).collect()
    bulk.process_all_transfusion(spark, folder, str(tmp_path)).collect()
    made = executions(spark, before)
    assert len(made) > 6 and len([n for n, scans in made if scans]) == 3


def test_landed_files(spark, folder, tmp_path):
    ff.write(tmp_path, ff.CBC % "2018-04-10", feeds.LABS, [])
    ff.write(tmp_path, ff.CBC % "2018-04-11", feeds.LABS, [ff.lab("nonsense", "RBC", "4.1"), ff.lab("nonsense", "HCT", "30")])
    got = landing.land(spark, str(tmp_path), feeds.LABS, str(tmp_path / "into"))
    assert (got.n_rows, got.n_bad) == (2, 1) and got.rows.count() == 2
    assert rows(got.manifest) == [(ff.CBC % "2018-04-10", 0, 0), (ff.CBC % "2018-04-11", 2, 1)] == rows(got.problems())
    with pytest.raises(checks.FeedError, match="labs"):
        got.require_sound("labs")
    again = landing.land(spark, folder, feeds.LABS, str(tmp_path / "into"))
    assert again.rows.count() == 10 and again.problems().count() == 0
    assert not any("pat_" in c and "pat_enc" not in c for c in spark.read.parquet(str(tmp_path / "into/labs/rows")).columns)


def test_stamps(spark):
    texts = [
        ("04/09/2018  11:59:00PM", dt.datetime(2018, 4, 9, 23, 59)),
        ("4/9/2018 12:00:00 am", dt.datetime(2018, 4, 9)),
        ("04/09/2018 12:30:05 PM", dt.datetime(2018, 4, 9, 12, 30, 5)),
        ("04/09/2018 13:30:05 PM", None), ("02/30/2018 01:00:00 PM", None), ("", None), (None, None),
    ]
    df = spark.createDataFrame(texts, "t string, want timestamp_ntz")
    got = df.select(times.slash_stamp(F.col("t")).alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]
    texts = [
        ("09-Apr-18 08:01:54", dt.datetime(2018, 4, 9, 8, 1, 54)),
        ("31-DEC-69 23:59:59", dt.datetime(2069, 12, 31, 23, 59, 59)),
        ("01-jan-70 00:00:00", dt.datetime(1970, 1, 1)),
        ("01-Foo-18 00:00:00", None), ("32-Jan-18 00:00:00", None), (None, None),
    ]
    df = spark.createDataFrame(texts, "t string, want timestamp_ntz")
    got = df.select(times.dash_stamp(F.col("t")).alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]


def test_file_names(spark):
    name = "/a/b/" + ff.STOCK % "2018-04-10"
    df = spark.createDataFrame([(name,), ("nodate.csv",)], "f string")
    got = df.select(times.snapshot_date(F.col("f")), times.report_name(F.col("f"))).collect()
    assert got[0][0] == D9
    assert got[0][1] == (ff.STOCK % "2018-04-10").removesuffix(".csv") + "-summary"
    assert got[1][0] is None


def test_columnar_feeds(spark, folder, tmp_path):
    text = spark.read.schema(feeds.INVENTORY.schema).option("header", True).csv(
        f"{folder}/{ff.STOCK % '2018-04-10'}"
    )
    typed = text.withColumn("Days to Expire", F.expr("try_cast(`Days to Expire` AS DECIMAL(5, 1))"))
    for name, df in (("text", text), ("typed", typed)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        got = feeds.read_feed(spark, str(tmp_path / name), feeds.INVENTORY, "part-", "parquet")
        done = bulk.process_inventory(got, "2018-04-09").data
        assert rows(done, "date", "count", "r1", "r2", "r3_plus") == [(D9, 5, 2, 2, 1)]


def test_single_file_scan(spark, folder):
    one = feeds.read_feed(spark, f"{folder}/{ff.CENSUS % '2018-04-11'}", feeds.CENSUS)
    assert rows(bulk.process_census(one).data, "date", "ward", "n") == [(D9, "B1", 1)]


def test_reports_of_several_runs_stay(spark, tmp_path):
    """Without a date, with the same date, and again with other rows."""
    schema = "file_name string, n int"
    for name, n in (("CBC_2017.txt", 1), ("CBC_2018.txt", 2), ("a2018-04-10.txt", 3),
                    ("b2018-04-10.txt", 4), ("CBC_2018.txt", 5)):
        sheet = reports.of_file(spark.createDataFrame([(f"/x/{name}", n)], schema))
        reports.save_reports({"sheet": sheet}, str(tmp_path))
    got = rows(spark.read.parquet(f"{tmp_path}/sheet"), "report", "n")
    assert got == [("CBC_2017-summary", 1), ("CBC_2018-summary", 5), ("a2018-04-10-summary", 3),
                   ("b2018-04-10-summary", 4)]
    assert rows(reports.read_report(spark, str(tmp_path), "sheet", "2018-04-10"), "n") == [(4,)]


def test_a_report_that_loses_its_rows_is_cleared(spark, folder, tmp_path):
    """A corrected lab file has no missing values any more; another file's report stays."""
    feed, out = tmp_path / "feed", tmp_path / "reports"
    feed.mkdir()
    for day in ("2018-04-10", "2018-04-11"):
        ff.write(feed, ff.CBC % day, feeds.LABS, ff.LABS_A)
    bulk.process_all_labs(spark, str(feed), report_folder=str(out)).collect()
    assert reports.read_report(spark, str(out), "lab_missing_values", "2018-04-10").count() == 2
    ff.write(feed, ff.CBC % "2018-04-10", feeds.LABS, [ff.lab("09-Apr-18 08:01:54", "WBC", "12.5")])
    bulk.process_all_labs(spark, str(feed), report_folder=str(out), pattern="CBC_Daily2018-04-10").collect()
    assert reports.read_report(spark, str(out), "lab_missing_values", "2018-04-10").count() == 0
    assert reports.read_report(spark, str(out), "lab_missing_values", "2018-04-11").count() == 2
    assert reports.read_report(spark, str(out), "lab_summary", "2018-04-10").count() == 1


def test_cleared_reports_without_a_date_and_with_odd_names(spark, tmp_path):
    names, schema = ["CBC 2017=a%.txt", "b2018-04-10:x.txt"], "file_name string, n int"
    files = spark.createDataFrame([(n,) for n in names], "file_name string")
    full = reports.of_file(spark.createDataFrame([(n, 1) for n in names], schema))
    for sheet in (full, full.filter("report_date IS NOT NULL"), full.limit(0)):
        reports.save_reports({"sheet": sheet}, str(tmp_path), files=files)
        left = spark.read.parquet(f"{tmp_path}/sheet").select("report")
        assert rows(left) == rows(sheet, "report")
