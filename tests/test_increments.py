"""Seed, daily runs, backfill and streaming on generated daily files."""

import dataclasses
import datetime as dt
import math

import feedfiles as ff
import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfcast.plans import increments
from shelfcast.settings import Params, constant_rule, quantile_rule
from shelfcast.sources import checks, feeds, landing
from shelfcast.sources import state as store
from shelfcast.streaming import counts, ingest

PARAMS = Params(
    history_window=12, smoothing=3, model_update_frequency=3, start=4, penalty_factor=0.5,
    rules=(
        quantile_rule("HGB", 0.25, lambda v: v < 9.0),
        constant_rule("PLT", 150.0, lambda v: v < 150.0),
    ),
    wards=("B1", "C2"),
)
FIRST = dt.date(2018, 3, 1)  # first data day
SEED_DAYS = 14
RUN_DAYS = 8


def used_on(i: int) -> int:
    return 3 + (i * 7) % 5 + i % 3


def write_day(folder, i: int, late: int = 0, kind: str = "PLT", names=None) -> str:
    """Files named for the day after data day ``i``; ``late`` units belong to the day before."""
    names = names or (ff.CBC, ff.CENSUS, ff.ISSUES, ff.STOCK)
    day, as_of = FIRST + dt.timedelta(days=i), str(FIRST + dt.timedelta(days=i + 1))
    stamp, slash = day.strftime("%d-%b-%y"), day.strftime("%m/%d/%Y")
    ff.write(folder, names[0] % as_of, feeds.LABS, [
        ff.lab(f"{stamp} 08:0{k}:00", name, str(base + (i * k) % 9 + k))
        for k in range(1, 6) for name, base in (("HGB", 6), ("PLT", 145))
    ])
    ff.write(folder, names[1] % as_of, feeds.CENSUS, [
        ff.stay(f"{slash}  11:59:00PM", ward)
        for ward, n in (("B1", 2 + i % 4), ("C2", 1 + (i * 5) % 7)) for _ in range(n)
    ])
    before = (day - dt.timedelta(days=1)).strftime("%m/%d/%Y")
    ff.write(folder, names[2] % as_of, feeds.TRANSFUSION, [
        *[ff.issue(f"{slash}  08:00:00 AM", kind)] * used_on(i),
        *[ff.issue(f"{before}  08:00:00 AM")] * late,
    ])
    ff.write(folder, names[3] % as_of, feeds.INVENTORY, [ff.unit("0.5"), ff.unit("3")])
    return as_of


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    old, new = tmp_path_factory.mktemp("old"), tmp_path_factory.mktemp("new")
    seeded = [write_day(old, i) for i in range(SEED_DAYS)]
    days = [write_day(new, i) for i in range(SEED_DAYS, SEED_DAYS + RUN_DAYS)]
    return str(old), str(new), seeded[-1], days


@pytest.fixture(scope="module")
def daily_state(spark, folders, tmp_path_factory):
    old, new, seed_day, days = folders
    state = str(tmp_path_factory.mktemp("state"))
    increments.seed(spark, old, state, seed_day, PARAMS)
    predicted = [
        increments.predict_for_date(spark, new, state, d, PARAMS).first() for d in days
    ]
    return state, predicted


def test_daily_runs(spark, folders, daily_state):
    _, _, _, days = folders
    state, predicted = daily_state
    assert [str(p.date + dt.timedelta(days=1)) for p in predicted] == days
    assert all(math.isfinite(p.t_pred) for p in predicted)
    log = rows(store.read_table(spark, state, "runs"), "as_of", "age_before", "retrain", "reason")
    assert log.pop(0)[1:] == (None, False, "seed")
    assert [r[1] for r in log] == [None, 1, 2, 3, 4, 5, 6, 7]
    assert [r[3] for r in log] == ["first", None, None, "stale", None, None, "stale", None]
    usage = store.read_table(spark, state, "usage").groupBy("date").agg(F.sum("used"))
    assert [r[1] for r in rows(usage)] == [used_on(i) for i in range(SEED_DAYS + RUN_DAYS)]


def test_scaler_is_kept_between_retrains(spark, folders, daily_state):
    _, _, _, days = folders
    state, _ = daily_state
    by_day = [
        rows(store.read_day(spark, state, "scaler", d), "predictor", "center", "scale")
        for d in days[:4]
    ]
    assert by_day[0] == by_day[1] == by_day[2] != by_day[3]


def test_repeating_a_run_changes_nothing(spark, folders, daily_state):
    _, new, _, days = folders
    state, predicted = daily_state
    again = increments.predict_for_date(spark, new, state, days[-1], PARAMS).first()
    assert again == predicted[-1]
    assert store.read_table(spark, state, "usage").count() == SEED_DAYS + RUN_DAYS


def same_state(spark, state, daily, days, predicted, got):
    assert [(str(a), d) for a, d, _ in got] == [(d, p.date) for d, p in zip(days, predicted)]
    assert [t for _, _, t in got] == pytest.approx([p.t_pred for p in predicted], abs=1e-9)
    for table in ("runs", "usage", "census", "labs", "inventory"):
        columns = sorted(store.read_table(spark, state, table).columns)
        assert rows(store.read_table(spark, state, table), *columns) == rows(
            store.read_table(spark, daily, table), *columns
        )
    for column in ("center", "scale"):
        ours, theirs = (
            dict(rows(store.read_day(spark, s, "scaler", days[-1]), "predictor", column))
            for s in (state, daily)
        )
        assert ours == pytest.approx(theirs, abs=1e-9)


def test_backfill_equals_daily_runs(spark, folders, daily_state, tmp_path):
    """In one go, and in two with the second going on from the first one's runs."""
    old, new, seed_day, days = folders
    daily, predicted = daily_state
    for name, cuts in (("one", [days]), ("two", [days[:3], days[3:]])):
        state = str(tmp_path / name)
        increments.seed(spark, old, state, seed_day, PARAMS)
        got = []
        for part in cuts:
            got += rows(increments.backfill(spark, new, state, part, PARAMS))
        same_state(spark, state, daily, days, predicted, got)


def test_backfill_with_late_rows_and_a_day_without_units(spark, folders, tmp_path, tmp_path_factory):
    old, _, seed_day, _ = folders
    new = str(tmp_path_factory.mktemp("uneven"))
    late, kind = {2: 3}, {4: "RBC"}
    days = [
        write_day(tmp_path_factory.getbasetemp() / new, SEED_DAYS + i, late.get(i, 0), kind.get(i, "PLT"))
        for i in range(6)
    ]
    states = [str(tmp_path / n) for n in ("daily", "range")]
    for state in states:
        increments.seed(spark, old, state, seed_day, PARAMS)
    predicted = [increments.predict_for_date(spark, new, states[0], d, PARAMS).first() for d in days]
    assert predicted[4].date == predicted[3].date
    got = rows(increments.backfill(spark, new, states[1], days, PARAMS))
    same_state(spark, states[1], states[0], days, predicted, got)


def late_files(folder, days: int) -> list[str]:
    """A late row on every day; labs and patients of the day before come late too."""
    out = []
    for i in range(days):
        as_of = write_day(folder, SEED_DAYS + i, late=1 + i % 3)
        day = FIRST + dt.timedelta(days=SEED_DAYS + i)
        before = day - dt.timedelta(days=1 + i % 2)
        with (folder / (ff.CBC % as_of)).open("a") as f:
            row = ff.lab(before.strftime("%d-%b-%y") + " 07:00:00", "HGB", str(4 + i % 3))
            f.write("\t".join(str(row.get(c, "")) for c in feeds.LABS.columns) + "\n")
        with (folder / (ff.CENSUS % as_of)).open("a") as f:
            row = ff.stay(before.strftime("%m/%d/%Y") + "  11:59:00PM", "B1")
            f.write("\t".join(str(row.get(c, "")) for c in feeds.CENSUS.columns) + "\n")
        out.append(as_of)
    return out


def test_backfill_with_late_rows_on_every_day(spark, folders, tmp_path, tmp_path_factory):
    old, _, seed_day, _ = folders
    new = tmp_path_factory.mktemp("always-late")
    days = late_files(new, 6)
    states = [str(tmp_path / n) for n in ("daily", "range")]
    for state in states:
        increments.seed(spark, old, state, seed_day, PARAMS)
    predicted = [increments.predict_for_date(spark, str(new), states[0], d, PARAMS).first() for d in days]
    got = rows(increments.backfill(spark, str(new), states[1], days, PARAMS))
    same_state(spark, states[1], states[0], days, predicted, got)
    assert all(r == "several dates" for (r,) in rows(store.of_days(store.read_table(spark, states[1], "runs"), days[1:]), "reason"))


def test_steps_of_a_backfill_do_not_grow_with_its_days(spark, folders, tmp_path, tmp_path_factory):
    old, _, seed_day, _ = folders
    new = tmp_path_factory.mktemp("many-late")
    days = late_files(new, 12)

    def jobs(n):
        state = str(tmp_path / f"n{n}")
        increments.seed(spark, old, state, seed_day, PARAMS)
        spark.sparkContext.setJobGroup(f"backfill-{n}", "")
        increments.backfill(spark, str(new), state, days[:n], PARAMS)
        found = spark.sparkContext.statusTracker().getJobIdsForGroup(f"backfill-{n}")
        spark.sparkContext.setJobGroup("other", "")
        return len(found)

    assert jobs(12) <= 1.2 * jobs(4)  # adaptive execution counts a stage as a job


def test_broken_run_leaves_no_complete_day(spark, folders, tmp_path, monkeypatch):
    old, new, seed_day, days = folders
    state = str(tmp_path)
    increments.seed(spark, old, state, seed_day, PARAMS)
    increments.predict_for_date(spark, new, state, days[0], PARAMS)
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="broken"):
        def fail(*_):
            raise RuntimeError("broken")
        m.setattr(increments.forecast, "score", fail)
        increments.predict_for_date(spark, new, state, days[1], PARAMS)
    assert store.latest_day(spark, state) == days[0]
    assert store.read_committed(spark, state, "usage").filter(F.col("as_of") == days[1]).count() == 0
    with pytest.raises(store.StateError):
        increments.predict_for_date(spark, new, state, days[2], PARAMS)
    for d in days[1:3]:
        increments.predict_for_date(spark, new, state, d, PARAMS)
    log = rows(store.read_table(spark, state, "runs"), "as_of", "age_before")
    assert [age for _, age in log] == [None, None, 1, 2]


def test_days_that_lose_their_rows_are_cleared(spark, tmp_path):
    path, schema = str(tmp_path), "as_of date, date date, used bigint"
    d = [dt.date(2018, 4, i) for i in (10, 11, 12)]
    first = spark.createDataFrame([(x, x, 1) for x in d], schema)
    store.write_days(first, path, "usage", [str(x) for x in d])
    store.write_days(spark.createDataFrame([(d[0], d[0], 5)], schema), path, "usage", [str(x) for x in d[:2]])
    assert rows(store.read_table(spark, path, "usage"), "as_of", "used") == [(d[0], 5), (d[2], 1)]


def test_readers_keep_the_old_day_until_the_new_one_is_whole(
    spark, folders, tmp_path, tmp_path_factory, monkeypatch
):
    """A rerun with a corrected file: read in its midst, after it broke, and after it is through."""
    old, new, seed_day, days = folders
    corrected, state, day = tmp_path_factory.mktemp("corrected"), str(tmp_path), days[1]
    assert write_day(corrected, SEED_DAYS + 1, late=40) == day
    increments.seed(spark, old, state, seed_day, PARAMS)
    for d in days[:2]:
        increments.predict_for_date(spark, new, state, d, PARAMS)

    def seen():
        return {
            t: rows(store.read_committed(spark, state, t), *c)
            for t, c in (("usage", ("as_of", "date", "used")), ("prediction", ("as_of", "t_pred")),
                         ("labs", ("as_of", "date", "lab_value")))
        }

    before, early = seen(), store.read_committed(spark, state, "usage")
    score, midst = increments.forecast.score, []
    for broken in (True, False):
        def look(*args, broken=broken):
            written = rows(store.read_day(spark, state, "usage", day), "used")
            midst.append((written, seen(), store.latest_day(spark, state)))
            if broken:
                raise RuntimeError("broken")
            return score(*args)

        with monkeypatch.context() as m:
            m.setattr(increments.forecast, "score", look)
            if broken:
                with pytest.raises(RuntimeError, match="broken"):
                    increments.predict_for_date(spark, str(corrected), state, day, PARAMS)
                assert seen() == before and store.latest_day(spark, state) == day
            else:
                increments.predict_for_date(spark, str(corrected), state, day, PARAMS)
    for written, meanwhile, latest in midst:
        assert (40,) in written and meanwhile == before and latest == day
    after = seen()
    assert sum(r[2] for r in after["usage"]) == sum(r[2] for r in before["usage"]) + 40
    assert after["labs"] == before["labs"] and after["prediction"] != before["prediction"]
    assert rows(early, "as_of", "date", "used") == before["usage"]

    def attempts(table):
        return len(list((tmp_path / table / f"as_of={day}").glob("attempt=*")))

    assert store.vacuum(spark, state) == 0 and attempts("usage") == 3
    assert store.vacuum(spark, state, dt.timedelta(0)) > 0
    assert [attempts(t) for t in ("usage", "labs", "prediction", "runs")] == [1] * 4
    assert len(list((tmp_path / "writes").glob("*/*.parquet"))) == 1 and seen() == after
    assert store.vacuum(spark, state, dt.timedelta(0)) == 0


def test_attempts_that_are_not_committed_outlive_a_vacuum(spark, tmp_path):
    """Written after a day's line, and not yet part of it: kept, as is what the line points at."""
    path, day = str(tmp_path), "2018-04-10"
    d = dt.date.fromisoformat(day)
    for used in (1, 2):
        store.write_day(spark.createDataFrame([(d, used)], "date date, used bigint"), path, "usage", day)
    line = spark.createDataFrame([(d, d)], "as_of date, date date")
    store.write_day(store.plain_lines(line, "seed"), path, "runs", day)
    store.write_day(spark.createDataFrame([(d, 3)], "date date, used bigint"), path, "usage", day)
    for gone in (1, 0):
        assert store.vacuum(spark, path, dt.timedelta(0)) == gone
        assert rows(store.read_committed(spark, path, "usage"), "used") == [(2,)]
        assert rows(store.read_table(spark, path, "usage"), "used") == [(3,)]
    store.open_days(spark, path, [day])
    assert rows(store.read_committed(spark, path, "usage"), "used") == []
    assert store.latest_day(spark, path) is None


def test_feeds_under_other_names(spark, tmp_path, tmp_path_factory):
    """File names are parameters of a run."""
    names = ("blood-%s-1.txt", "beds-%s-1.txt", "issues-%s-1.txt", "shelf-%s-1.csv")
    own = [
        dataclasses.replace(f, pattern=n.split("-")[0], daily=n.split("%")[0] + "%s-")
        for f, n in zip(feeds.FEEDS.values(), names)
    ]
    params = dataclasses.replace(PARAMS, feeds=own)
    old, new = tmp_path_factory.mktemp("named-old"), tmp_path_factory.mktemp("named-new")
    seeded = [write_day(old, i, names=names) for i in range(SEED_DAYS)]
    day = write_day(new, SEED_DAYS, names=names)
    increments.seed(spark, str(old), str(tmp_path), seeded[-1], params)
    got = increments.predict_for_date(spark, str(new), str(tmp_path), day, params).first()
    assert math.isfinite(got.t_pred)
    bad = spark.createDataFrame([(None, "HGB")], "result_time timestamp_ntz, base_name string")
    assert bad.select(landing.bad_stamp(own[0], params.rules)).first()[0]


def test_report_from_state(spark, folders, daily_state, tmp_path):
    _, _, _, days = folders
    state, predicted = daily_state
    start, end = str(predicted[0].date), str(predicted[-1].date + dt.timedelta(days=2))
    report = increments.report_from_state(
        spark, state, start, end, PARAMS, offset=0, report_folder=str(tmp_path),
        report_date="2018-04-01",
    )
    got = report.orderBy("date").collect()
    assert len(got) == RUN_DAYS + 2 and len(report.columns) == 19
    assert [r["Platelet usage"] for r in got[:2]] == [used_on(SEED_DAYS), used_on(SEED_DAYS + 1)]
    assert got[0]["Inv. count"] == 2 and got[-1]["Platelet usage"] is None
    assert spark.read.parquet(f"{tmp_path}/prediction_report").count() == RUN_DAYS + 2


def test_late_rows_add_to_their_date_and_force_a_retrain(spark, folders, tmp_path, tmp_path_factory):
    old, _, seed_day, _ = folders
    new = tmp_path_factory.mktemp("late")
    days = [write_day(new, SEED_DAYS), write_day(new, SEED_DAYS + 1, late=2)]
    state = str(tmp_path)
    increments.seed(spark, old, state, seed_day, PARAMS)
    for d in days:
        increments.predict_for_date(spark, str(new), state, d, PARAMS)
    total = store.read_table(spark, state, "usage").groupBy("date").agg(F.sum("used").alias("n"))
    late_day = FIRST + dt.timedelta(days=SEED_DAYS)
    assert rows(total.filter(F.col("date") == F.lit(late_day)), "n") == [(used_on(SEED_DAYS) + 2,)]
    assert rows(store.read_day(spark, state, "runs", days[1]), "reason") == [("several dates",)]


def test_missing_files_and_missing_state_stop(spark, folders, tmp_path):
    old, new, seed_day, days = folders
    with pytest.raises(store.StateError):
        increments.predict_for_date(spark, new, str(tmp_path), days[0], PARAMS)
    increments.seed(spark, old, str(tmp_path), seed_day, PARAMS)
    with pytest.raises(checks.FeedError):
        increments.predict_for_date(spark, old, str(tmp_path), days[0], PARAMS)


def test_stream_ingest_writes_the_same_increments(spark, folders, daily_state, tmp_path):
    _, new, _, days = folders
    daily, _ = daily_state
    state = str(tmp_path / "state")
    for _ in range(2):  # the second round finds nothing new
        for q in ingest.ingest(spark, new, state, str(tmp_path / "cp"), PARAMS, maxFilesPerTrigger="3"):
            q.awaitTermination()
    for table in ("usage", "census", "labs", "inventory"):
        want = store.read_table(spark, daily, table).filter(F.col("as_of") >= days[0])
        columns = sorted(want.columns)
        assert rows(store.read_table(spark, state, table), *columns) == rows(want, *columns)
    assert store.latest_day(spark, state) is None
    for _ in range(2):
        ingest.close_days(spark, state)
        assert rows(store.read_table(spark, state, "runs"), "reason") == [("ingested",)] * len(days)


def test_second_file_for_a_committed_day(spark, tmp_path, tmp_path_factory):
    """In another batch: it stops the stream and changes nothing, or replaces and reopens the day."""
    folder, state, cp = tmp_path_factory.mktemp("twice"), str(tmp_path / "state"), str(tmp_path / "cp")
    days = [write_day(folder, SEED_DAYS + i) for i in range(2)]

    def take(replace=False):
        for q in ingest.ingest(spark, str(folder), state, cp, PARAMS, replace=replace):
            q.awaitTermination()

    take()
    ingest.close_days(spark, state)
    before = rows(store.read_committed(spark, state, "usage"), "as_of", "date", "used")
    assert [str(a) for a, _, _ in before] == days
    slash = (FIRST + dt.timedelta(days=SEED_DAYS)).strftime("%m/%d/%Y")
    second = (ff.ISSUES % days[0]).replace("08-01-54", "09-30-00")
    ff.write(folder, second, feeds.TRANSFUSION, [ff.issue(f"{slash}  09:00:00 AM")] * 40)
    with pytest.raises(Exception, match="Several transfusion files"):
        take()
    assert rows(store.read_committed(spark, state, "usage"), "as_of", "date", "used") == before
    take(replace=True)
    assert [str(a) for (a,) in rows(store.read_committed(spark, state, "usage"), "as_of")] == days[1:]
    ingest.close_days(spark, state)
    after = rows(store.read_committed(spark, state, "usage"), "as_of", "date", "used")
    assert after == [(*before[0][:2], 40), before[1]]
    assert rows(store.read_table(spark, state, "files_transfusion"), "file_name") == [(second,), (ff.ISSUES % days[1],)]


def test_running_counts_take_late_rows(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    path, cp = str(tmp_path / "counts"), str(tmp_path / "cp")

    def run():
        stream = feeds.stream_feed(spark, str(folder), feeds.TRANSFUSION)
        query = counts.write_updates(counts.running_usage(stream), path, cp).trigger(
            availableNow=True
        ).start()
        query.awaitTermination()
        return rows(counts.current_counts(spark, path, ["date"], "used"))

    ff.write(folder, ff.ISSUES % "2018-04-10", feeds.TRANSFUSION, ff.ISSUES_A)
    assert run() == [(dt.date(2018, 4, 9), 3), (dt.date(2018, 4, 10), 3)]
    ff.write(folder, ff.ISSUES % "2018-04-11", feeds.TRANSFUSION, ff.ISSUES_B)
    assert run() == [(dt.date(2018, 4, 9), 3), (dt.date(2018, 4, 10), 6)]


def test_running_counts_are_merged(spark, tmp_path):
    """A reader's input is bounded by the groups and a few batches; a broken merge changes nothing."""
    folder = tmp_path / "files"
    folder.mkdir()
    path, cp = str(tmp_path / "counts"), str(tmp_path / "cp")
    for i in range(7):
        ff.write(folder, ff.ISSUES % f"2018-04-{10 + i}", feeds.TRANSFUSION, ff.ISSUES_A)
        stream = feeds.stream_feed(spark, str(folder), feeds.TRANSFUSION)
        counts.write_updates(counts.running_usage(stream), path, cp, every=3).trigger(
            availableNow=True
        ).start().awaitTermination()
        n = 3 * (i + 1)
        want = [(dt.date(2018, 4, 9), n), (dt.date(2018, 4, 10), n)]
        assert rows(counts.current_counts(spark, path, ["date"], "used")) == want
    assert rows(spark.read.parquet(f"{path}/bases")) == [(2,), (5,)]
    read = counts.current_counts(spark, path, ["date"], "used")
    plan = read._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "InitialPlan" not in line]
    assert any("(batch" in x and "> 5" in x.split("PartitionFilters")[1] for x in scans)
    assert any("(upto" in x and "= 5" in x.split("PartitionFilters")[1] for x in scans)
    spark.read.parquet(f"{path}/base/upto=5").limit(1).write.parquet(f"{path}/base/upto=6")
    assert rows(counts.current_counts(spark, path, ["date"], "used")) == want
    counts.compact(spark, path, ["date"], "used", 6)
    assert rows(counts.current_counts(spark, path, ["date"], "used")) == want
