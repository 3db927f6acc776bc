import datetime as dt

from millrace.operators import runlog
from millrace.plans import reports

T = dt.datetime(2024, 1, 2, 6)


def later(seconds):
    return T + dt.timedelta(seconds=seconds)


def events(spark):
    rows = [
        runlog.start_event(1, "A", T, "TASK"),
        runlog.end_event(1, "A", later(65), "fine", rows_read=10, rows_inserted=9),
        runlog.start_event(2, "A", later(100), "TASK"),
        runlog.end_event(2, "A", later(101), rows_rejected=3),
        runlog.start_event(3, "B", T, "TASK"),
        runlog.fail_event(3, "B", later(7), "m" * 3000),
        runlog.start_event(4, "B", later(50), "TASK"),
    ]
    return runlog.rows_as_table(spark, rows, runlog.EVENT_SCHEMA)


def test_states(spark):
    got = {r.run_id: r for r in runlog.run_log(events(spark)).collect()}
    assert {i: r.status for i, r in got.items()} == {1: "SUCCESS", 2: "WARNING", 3: "FAILED", 4: "RUNNING"}
    assert (got[1].duration_seconds, got[1].rows_inserted, got[1].comments) == (65, 9, "fine")
    assert len(got[3].comments) == 1000 and got[3].rows_read == 0
    assert got[4].end_time is None and got[4].duration_seconds is None and got[4].run_date == T.date()


def test_views(spark, rows):
    log = runlog.run_log(events(spark))
    assert rows(reports.latest_run_status(log), "job_name", "status") == [("A", "WARNING"), ("B", "RUNNING")]
    stats = {r.job_name: r for r in reports.daily_summary(log, T.date()).collect()}
    assert (stats["A"].total_runs, stats["A"].warning_runs, stats["A"].avg_duration_seconds) == (2, 1, 33.0)
    assert reports.daily_summary(log, dt.date(2023, 1, 1)).isEmpty()


def test_errors(spark):
    rows = [runlog.error_row(i, 3, "B", later(i), "SQL_ERROR", "x" * 5000, {"i": i}) for i in range(30)]
    rows[29]["is_resolved"] = True
    errors = runlog.rows_as_table(spark, rows, runlog.ERROR_SCHEMA)
    log = runlog.run_log(events(spark))
    listed = reports.open_errors(errors, log).collect()
    assert len(listed) == 29 and listed[0].error_id == 28 and {r.run_status for r in listed} == {"FAILED"}
    assert len(listed[0].error_message) == 4000
    assert [r.error_id for r in reports.newest_open_errors(errors, log).collect()] == list(range(28, 8, -1))


def test_unknown_jobs_are_registered_once(spark, rows):
    registry = runlog.job_rows(spark, T)
    once = runlog.register_jobs(registry, events(spark), T)
    assert registry.count() == 16 and rows(once.where("layer = 'AD_HOC'"), "job_name") == [("A",), ("B",)]
    assert runlog.register_jobs(once, events(spark), T).count() == 18


def test_states_agree_with_the_log(spark, rows):
    names = ("run_id", "run_date", "job_name", *runlog.STATE_COLUMNS)
    assert rows(runlog.run_states(events(spark)), *names) == rows(runlog.run_log(events(spark)), *names)
    assert runlog.run_states(events(spark).limit(0)).isEmpty() and runlog.day_rows(runlog.run_states(events(spark).limit(0))).isEmpty()


def test_ties_repeats_and_ends_past_midnight(spark):
    past = T + dt.timedelta(days=40)
    listed = [
        runlog.start_event(1, "A", T, "TASK"),
        runlog.end_event(1, "A", past, "x", T.date(), rows_read=5, rows_inserted=1),
        runlog.end_event(1, "A", past, "y", T.date(), rows_read=3, rows_inserted=2),
        runlog.end_event(1, "A", later(3), "early", rows_read=99),
        runlog.start_event(2, "A", T, "TASK"),
        runlog.end_event(2, "A", later(9), rows_read=7),
        runlog.fail_event(2, "A", later(9), "broke"),
        runlog.end_event(3, None, later(1), rows_rejected=1),
        runlog.start_event(4, "B", T, "TASK"),
    ]
    table = runlog.rows_as_table(spark, [*listed, *listed], runlog.EVENT_SCHEMA)
    got = {r.run_id: r for r in runlog.run_states(table).collect()}
    assert len(got) == 4 and got[1].run_date == T.date()
    assert (got[1].end_time, got[1].rows_read, got[1].rows_inserted) == (past, 5, 2)
    assert (got[2].status, got[2].rows_read) == ("FAILED", 0)
    assert (got[3].status, got[3].job_name, got[3].start_time) == ("WARNING", None, None)
    days = {r.job_name: r for r in runlog.day_rows(runlog.run_states(table)).collect()}
    assert set(days) == {"A", "B", None} and (days["A"].total_runs, days["A"].run_id, days[None].timed_runs) == (2, 2, 0)


def test_day_rows_add_up(spark, rows):
    """Day rows of two halves of the runs add up to those of all runs."""
    states = runlog.run_states(events(spark))
    parts = [runlog.day_rows(states.where(half)) for half in ("run_id <= 2 OR run_id = 4", "run_id = 3")]
    whole = rows(reports.daily_run_stats(states))
    assert rows(reports.stats_of_days(parts[0].unionByName(parts[1]))) == whole
    assert rows(reports.stats_of_days(runlog.day_rows(states))) == whole
    names = ("job_name", "status", "start_time", "duration_seconds")
    assert rows(reports.latest_run_status(parts[0].unionByName(parts[1])), *names) == rows(reports.latest_run_status(states), *names)


def test_a_day_is_folded_by_hash_from_its_rows_alone(spark, tmp_path):
    events(spark).write.parquet(str(tmp_path / "events"))
    kept = spark.read.parquet(str(tmp_path / "events"))
    text = reports.daily_summary(runlog.run_states(kept), T.date())._jdf.queryExecution().toString()
    assert "EqualTo(run_date,2024-01-02)" in text and "SortAggregate" not in text


def test_error_ids_follow_on_past_any_number_of_files():
    found = [runlog.error_row(0, run, "A", T, "FILE_FORMAT", str(i), {"file": str(i)}) for run in (2, 1) for i in range(1500)]
    got = runlog.numbered(found, 40)
    assert [r["error_id"] for r in got] == list(range(41, 3041))
    assert [r["run_id"] for r in got] == [1] * 1500 + [2] * 1500 and got[3]["error_message"] == "3"


def test_events_are_dealt_by_run_before_they_are_folded(spark, tmp_path, rows):
    """No task holds the events of a whole file, and a run is folded where its events meet, once."""
    events(spark).write.parquet(str(tmp_path / "events"))
    kept = spark.read.parquet(str(tmp_path / "events"))
    text = runlog.run_states(kept, 10 * runlog.FOLD_EVENTS)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and ", 10)" in text
    assert rows(runlog.run_states(kept, 10 * runlog.FOLD_EVENTS)) == rows(runlog.run_states(kept)) == rows(runlog.run_states(kept, 0))
    days = runlog.day_rows(runlog.run_states(kept))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in days and days.count("Scan") == 1
