import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.feeds import FEEDS, pick
from millrace.operators import governance, quality, runlog
from millrace.plans import layers, reports
from millrace.sources.tables import Lake
from millrace.streaming.jobs import stream_distinct, stream_feed_files, stream_raw, stream_to_target

D1, D2, D3 = (dt.datetime(2024, 1, d, 6) for d in (1, 2, 3))

USUAL = {
    "customers": dict(customer_id="C1", first_name="a", last_name="b", date_of_birth="1980-01-02", national_id="1" * 9, email="x@y",
                      phone_number="123456", address_line1="1 Main St", city="c", region="NORTH", postal_code="1", plan_id="P1",
                      activation_date="2020-01-01", account_status="ACTIVE", customer_segment="SME", credit_score="700"),
    "plans": dict(plan_id="P1", plan_name="n", plan_type="PREPAID", monthly_fee="9.99", data_limit_gb="2", voice_minutes="100",
                  sms_count="100", currency="USD", effective_date="2023-01-01"),
    "devices": dict(device_id="D1", imei="001", customer_id="C1", device_model="m", device_os="o", activation_date="2020-01-01", device_status="ACTIVE"),
    "cdr": dict(cdr_id="R1", customer_id="C1", call_type="DATA", origin_number="1", destination_number="2", cell_tower_id="T1",
                call_start_ts="2024-01-05 10:00:00", call_end_ts="2024-01-05 10:01:00", duration_seconds="60", data_volume_mb="1.5",
                roaming_flag="N", region="NORTH"),
    "billing": dict(invoice_id="I1", customer_id="C1", billing_period="2024-01", plan_id="P1", usage_charges="1", tax_amount="1",
                    total_amount="20", invoice_date="2024-01-31", due_date="2024-02-15", invoice_status="OPEN"),
    "payments": dict(payment_id="Y1", invoice_id="I1", customer_id="C1", payment_date="2024-02-01", amount="20", payment_method="CARD",
                     card_last4="0042", payment_status="SUCCESS"),
    "towers": dict(tower_id="T1", region="NORTH", latitude="1", longitude="2", capacity_mbps="500", tower_status="ACTIVE"),
    "support_tickets": dict(ticket_id="K1", customer_id="C1", opened_at="2024-01-01 00:00:59", closed_at="", category="BILLING",
                            priority="LOW", ticket_status="OPEN", channel="APP"),
}


def send(folder, feed, name, *changed):
    """Write a feed file: the usual line with each set of changes."""
    where = folder / feed
    where.mkdir(parents=True, exist_ok=True)
    columns = FEEDS[feed].columns
    lines = [",".join((USUAL[feed] | c)[n] for n in columns) for c in changed]
    (where / name).write_text("\n".join([",".join(columns), *lines]) + "\n")


def outcome(outcomes):
    return {o[1]: o[2] for o in outcomes}


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_all_layers_on_all_feeds(spark, lake, tmp_path, rows):
    landing = tmp_path / "in"
    for feed in FEEDS:
        send(landing, feed, "one.csv", {})
    send(landing, "customers", "more.csv", {"customer_id": "C2", "region": "SOUTH"}, {"customer_id": "NA"}, {"customer_id": "C" * 21})
    first = layers.run_layers(lake, "all", D1, str(landing))
    assert first.where("status = 'FAILED'").isEmpty()
    assert rows(layers.read_rejects(lake, FEEDS["customers"]), "_reject") == [("customer_id is longer than 20: 21",)]

    send(landing, "customers", "two.csv", {"plan_id": "P2"}, {"customer_id": "C2", "region": "SOUTH", "email": "new@y"})
    send(landing, "billing", "two.csv", {"total_amount": "25", "invoice_status": "PAID", "usage_charges": "9"}, {"invoice_id": "I2"})
    send(landing, "support_tickets", "two.csv", {"closed_at": "2024-01-01 00:01:01", "ticket_status": "CLOSED", "priority": "HIGH"})
    send(landing, "cdr", "two.csv", {}, {"cdr_id": "R2", "call_type": "VOICE"}, {"cdr_id": "R3", "call_type": "SMS"})
    send(landing, "devices", "two.csv", {"activation_date": "2024-01-01", "device_status": "INACTIVE"}, {"device_id": "D2"})
    second = layers.run_layers(lake, "all", D2, str(landing))
    assert second.where("status = 'FAILED'").isEmpty()

    dim = layers.read_target(lake, FEEDS["customers"])
    assert rows(dim, "customer_sk", "customer_id", "plan_id", "email", "eff_start_ts", "eff_end_ts", "is_current") == [
        (1, "C1", "P1", "x@y", D1, D2, False),
        (2, "C2", "P1", "x@y", D1, None, True),  # only the e-mail differs: no version
        (3, "C1", "P2", "x@y", D2, None, True),
    ]
    billing = layers.read_target(lake, FEEDS["billing"])
    assert rows(billing.selectExpr("invoice_id", "int(total_amount)", "int(usage_charges)", "invoice_status", "loaded_at")) == [
        ("I1", 25, 1, "PAID", D2),
        ("I2", 20, 1, "OPEN", D2),
    ]
    staged = layers.read_stage(lake, FEEDS["billing"]).where("invoice_id = 'I1'").first()
    assert int(staged.usage_charges) == 9
    ticket = layers.read_target(lake, FEEDS["support_tickets"]).first()
    assert (int(ticket.resolution_minutes), ticket.priority, ticket.ticket_status) == (1, "LOW", "CLOSED")
    assert rows(layers.read_target(lake, FEEDS["cdr"]), "cdr_id", "usage_date") == [(f"R{i}", dt.date(2024, 1, 5)) for i in (1, 2, 3)]
    devices = layers.read_target(lake, FEEDS["devices"])
    assert rows(devices, "device_sk", "device_id", "activation_date", "device_status") == [
        (1, "D1", dt.date(2020, 1, 1), "INACTIVE"),
        (2, "D2", dt.date(2020, 1, 1), "ACTIVE"),
    ]
    summary = reports.customer_monthly_summary(layers.curated_tables(lake))
    assert rows(summary.selectExpr("int(invoice_amount)", "int(paid_amount)", "double(total_data_mb)", "int(total_voice_seconds)", "total_sms")) == [
        (20, None, 1.5, 60, 1),
        (25, 20, 1.5, 60, 1),
    ]

    third = layers.run_layers(lake, "all", D3, str(landing))  # nothing new
    assert {r.message for r in third.where("layer <> 'validate'").collect()} == {"no new files", "no new rows", "no changes to merge"}
    assert rows(layers.read_target(lake, FEEDS["customers"])) == rows(dim)

    log = layers.runs(lake)
    assert log.where("status = 'RUNNING'").isEmpty() and log.count() == 3 * 32
    today, worst = layers.day_report(lake, D1.date())
    assert today.count() == 32 and "longer than 20" in worst.first().error_message
    assert rows(layers.count_log(lake).where("check_status = 'MISMATCH'").select("source_row_count", "target_row_count").distinct()) == [(3, 2)]
    assert layers.validation_summary(lake).where("feed_name = 'customers' AND column_name = 'customer_id'").first().records_failed == 1
    assert layers.dq_checks(lake).where("check_name = 'NULL_CUSTOMER_ID'").agg(F.max("records_failed")).first()[0] == 1


def test_a_merge_replaces_only_the_months_it_touches(spark, lake, tmp_path, rows):
    feed, landing = FEEDS["billing"], tmp_path / "in"
    send(landing, "billing", "a.csv", *[{"invoice_id": f"I{m}", "billing_period": f"2024-0{m}"} for m in (1, 2, 3)], {"invoice_id": "I9", "billing_period": "soon"})
    layers.run_raw(lake, str(landing), [feed], D1), layers.run_staging(lake, [feed], D1), layers.run_curated(lake, D1, feeds=["billing"])
    before = set(lake.parts("curated/fact_billing"))
    # I2 comes back under another month; its row stays where it is
    send(landing, "billing", "b.csv", {"invoice_id": "I2", "billing_period": "2024-05", "total_amount": "7"})
    layers.run_raw(lake, str(landing), [feed], D2), layers.run_staging(lake, [feed], D2), layers.run_curated(lake, D2, feeds=["billing"])
    after = set(lake.parts("curated/fact_billing"))
    assert len(before) == len(after) == 4 and len(before & after) == 3
    assert rows(layers.read_target(lake, feed).selectExpr("invoice_id", "billing_period", "int(total_amount)")) == [
        ("I1", "2024-01", 20), ("I2", "2024-02", 7), ("I3", "2024-03", 20), ("I9", "soon", 20),
    ]


def test_full_rescan_gives_the_same_rows(spark, tmp_path, rows):
    landing, feeds = tmp_path / "in", pick("customers,payments,cdr")
    lakes = [Lake(spark, str(tmp_path / n)) for n in ("step", "full")]
    for at, name, status in ((D1, "a.csv", "PENDING"), (D2, "b.csv", "SUCCESS")):
        send(landing, "customers", name, {"region": "EAST" if at == D2 else "WEST"}, {"customer_id": f"C{at.day}"})
        send(landing, "payments", name, {"payment_status": status}, {"payment_id": f"Y9{at.day}"})
        send(landing, "cdr", name, {}, {"cdr_id": f"R9{at.day}"})
        for lake, full in zip(lakes, (False, True)):
            layers.run_raw(lake, str(landing), feeds, at)
            assert set(outcome(layers.run_staging(lake, feeds, at, full_rescan=full)).values()) == {"SUCCESS"}
            layers.run_curated(lake, at)
    for feed in feeds:
        step, full = ({r[feed.key]: r for r in layers.read_stage(lake, feed).collect()} for lake in lakes)
        assert {k: r[:-1] for k, r in step.items()} == {k: r[:-1] for k, r in full.items()}


def test_one_failing_feed_stops_no_other(spark, lake, tmp_path, monkeypatch):
    landing = tmp_path / "in"
    send(landing, "plans", "a.csv", {}), send(landing, "towers", "a.csv", {})
    read_feed = layers.files.read_feed

    def broken(spark, feed, *rest):
        if feed.name == "towers":
            raise OSError("disk on fire")
        return read_feed(spark, feed, *rest)

    monkeypatch.setattr(layers.files, "read_feed", broken)
    got = outcome(layers.run_raw(lake, str(landing), pick("towers,plans"), D1))
    assert got == {"S3_TO_RAW_TOWERS": "FAILED", "S3_TO_RAW_PLANS": "SUCCESS"}
    error = layers.errors(lake).first()
    assert error.severity == "CRITICAL" and "disk on fire" in error.error_message
    assert {r.status for r in layers.runs(lake).collect()} == {"FAILED", "SUCCESS"}


def test_feeds_without_files(spark, lake, tmp_path, rows):
    feeds = pick("towers,billing")
    assert set(outcome(layers.run_raw(lake, str(tmp_path / "in"), feeds, D1)).values()) == {"SUCCESS"}
    assert set(outcome(layers.run_validate(lake, str(tmp_path / "in"), feeds, D1)).values()) == {"SUCCESS"}
    assert set(outcome(layers.run_staging(lake, feeds, D1)).values()) == {"SUCCESS"}
    checked = layers.validation_summary(lake)
    assert checked.count() == 8 and rows(checked.select("records_checked", "check_status").distinct()) == [(0, "PASS")]


def test_files_that_are_gone_are_skipped(spark, lake, tmp_path, rows):
    landing = tmp_path / "in"
    send(landing, "towers", "a.csv", {})
    layers.run_raw(lake, str(landing), pick("towers"), D1)
    layers.run_validate(lake, str(tmp_path / "elsewhere"), pick("towers"), D1, count_summary=True)
    assert rows(layers.count_log(lake), "source_row_count", "target_row_count", "check_status") == [(None, 1, "SKIPPED")]
    recon = layers.validation_summary(lake).where("rule_type = 'ROW_COUNT_RECONCILIATION'").first()
    assert (recon.records_checked, recon.check_status) == (0, "PASS")


def test_an_uncommitted_batch_leaves_no_trace(spark, lake):
    batch = lake.begin("b1")
    lake.write(batch, "t", spark.range(3).selectExpr("id AS v"))
    assert lake.read("t", "v bigint").isEmpty()
    again = lake.begin("b1")
    lake.write(again, "t", spark.range(5).selectExpr("id AS v"))
    lake.commit(again, D1)
    assert lake.read("t", "v bigint").count() == 5 == lake.count("t")
    with pytest.raises(ValueError):
        lake.write(lake.begin("b1"), "t", spark.range(1).selectExpr("id AS v"))
    other = Lake(spark, lake.root)
    assert other.read("t", "v bigint").count() == 5


def test_streaming_equals_batch(spark, tmp_path, rows):
    feed, landing = FEEDS["cdr"], tmp_path / "in"
    send(landing, "cdr", "a.csv", {}, {"cdr_id": "R2"}, {"cdr_id": "R2"}, {"cdr_id": "R7", "call_start_ts": "bad"})
    stream, batch = Lake(spark, str(tmp_path / "stream")), Lake(spark, str(tmp_path / "batch"))
    run = lambda: stream_to_target(stream, feed, str(landing / "cdr"), str(tmp_path / "ck")).awaitTermination()
    run()
    send(landing, "cdr", "b.csv", {"cdr_id": "R2"}, {"cdr_id": "R3", "call_start_ts": "2023-12-31 23:59:59"})
    run(), run()  # the last one finds nothing new
    layers.run_raw(batch, str(landing), [feed], D1)
    layers.run_staging(batch, [feed], D1, dedupe=True)
    layers.run_curated(batch, D1, feeds=["cdr"])
    for read in (lambda lake: layers.read_stage(lake, feed), lambda lake: layers.read_target(lake, feed)):
        got = [rows(read(lake).drop("updated_at", "loaded_at")) for lake in (stream, batch)]
        assert got[0] == got[1] and len(got[0]) == 3
    assert layers.read_raw(stream, feed).count() == layers.read_raw(batch, feed).count() == 6


def test_streamed_dimension_versions(spark, lake, tmp_path, rows):
    feed, landing = FEEDS["customers"], tmp_path / "in"
    for name, plan in (("a.csv", "P1"), ("b.csv", "P2")):
        send(landing, "customers", name, {"plan_id": plan})
        stream_to_target(lake, feed, str(landing / "customers"), str(tmp_path / "ck")).awaitTermination()
    assert rows(layers.read_target(lake, feed), "customer_sk", "plan_id", "is_current") == [(1, "P1", False), (2, "P2", True)]


def test_streamed_raw_takes_each_file_once(spark, lake, tmp_path):
    feed, landing = FEEDS["towers"], tmp_path / "in"
    send(landing, "towers", "a.csv", {})
    for _ in range(2):
        stream_raw(lake, feed, str(landing / "towers"), str(tmp_path / "ck")).awaitTermination()
    assert layers.read_raw(lake, feed).count() == 1


def test_bounded_state_dedupe(spark, tmp_path, rows):
    feed, landing = FEEDS["cdr"], tmp_path / "in"
    send(landing, "cdr", "a.csv", {}, {}, {"cdr_id": "R2"}, {"cdr_id": ""})
    out = str(tmp_path / "out")
    distinct = stream_distinct(stream_feed_files(spark, feed, str(landing / "cdr")), feed)
    query = distinct.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.read.parquet(out), "cdr_id") == [("R1",), ("R2",)]


def test_two_feeds_stream_into_one_lake(spark, lake, tmp_path):
    landing = tmp_path / "in"
    for name in ("towers", "plans"):
        send(landing, name, "a.csv", {})
        stream_raw(lake, FEEDS[name], str(landing / name), str(tmp_path / f"ck-{name}")).awaitTermination()
    assert [layers.read_raw(lake, FEEDS[name]).count() for name in ("towers", "plans")] == [1, 1]


def test_a_new_checkpoint_drops_no_files(spark, lake, tmp_path):
    feed, landing = FEEDS["towers"], tmp_path / "in"
    send(landing, "towers", "a.csv", {})
    stream_raw(lake, feed, str(landing / "towers"), str(tmp_path / "ck1")).awaitTermination()
    send(landing, "towers", "b.csv", {"tower_id": "T2"})
    stream_raw(lake, feed, str(landing / "towers"), str(tmp_path / "ck2")).awaitTermination()
    assert layers.read_raw(lake, feed).count() == 3


def test_a_commit_that_died_without_rows_is_written_again(spark, lake, tmp_path):
    (tmp_path / "lake" / "commits" / "commit=b1" / "_temporary").mkdir(parents=True)
    batch = lake.begin("b1")
    lake.write(batch, "t", spark.range(2).selectExpr("id AS v"))
    lake.commit(batch, D1)
    assert lake.read("t", "v bigint").count() == 2
    again = lake.begin("b1")
    lake.write(again, "other", spark.range(1).selectExpr("id AS v"))
    with pytest.raises(ValueError):
        lake.commit(again, D1)


@pytest.mark.parametrize("name", ["cdr", "customers"])
def test_what_is_staged_while_curated_runs_is_carried_over_next(spark, lake, tmp_path, monkeypatch, name):
    feed, landing, key = FEEDS[name], tmp_path / "in", FEEDS[name].key
    send(landing, name, "a.csv", {})
    layers.run_raw(lake, str(landing), [feed], D1)
    layers.run_staging(lake, [feed], D1)
    plainly = layers.curate

    def meanwhile(*args, **kwargs):
        monkeypatch.setattr(layers, "curate", plainly)
        send(landing, name, "b.csv", {key: "X2"})
        layers.run_raw(lake, str(landing), [feed], D2)
        layers.run_staging(lake, [feed], D2)
        return plainly(*args, **kwargs)

    monkeypatch.setattr(layers, "curate", meanwhile)
    layers.run_curated(lake, D1, feeds=[name])
    assert layers.read_target(lake, feed).count() == 1
    layers.run_curated(lake, D3, feeds=[name])
    assert layers.read_target(lake, feed).count() == 2


def test_a_layer_is_run_again_at_its_batch_time(spark, lake, tmp_path, monkeypatch):
    feed, landing = FEEDS["towers"], tmp_path / "in"
    send(landing, "towers", "a.csv", {})
    with monkeypatch.context() as broken:
        broken.setattr(layers, "land", lambda *a: 1 / 0)
        assert outcome(layers.run_raw(lake, str(landing), [feed], D1)) == {feed.load_job: "FAILED"}
    assert outcome(layers.run_raw(lake, str(landing), [feed], D1)) == {feed.load_job: "SUCCESS"}
    assert layers.read_raw(lake, feed).count() == 1
    assert layers.runs(lake).select("run_id").distinct().count() == 2


def test_line_breaks_and_malformed_lines_in_batch_and_stream(spark, lake, tmp_path, rows):
    feed, landing = FEEDS["towers"], tmp_path / "in"
    send(landing, "towers", "a.csv", {"region": '"NOR\nTH"'}, {"tower_id": "T2", "region": '"x"y'}, {"tower_id": "T3"})
    read, inserted, updated, rejected = layers.run_raw(lake, str(landing), [feed], D1)[0][3:7]
    assert (read, inserted, rejected) == (3, 2, 1)
    assert outcome(layers.run_validate(lake, str(landing), [feed], D1)) == {feed.validate_job: "WARNING"}
    assert rows(layers.count_log(lake), "source_row_count", "target_row_count") == [(3, 2)]
    streamed = Lake(spark, str(tmp_path / "streamed"))
    stream_raw(streamed, feed, str(landing / "towers"), str(tmp_path / "ck")).awaitTermination()
    for each in (lake, streamed):
        assert rows(layers.read_raw(each, feed), "tower_id", "region") == [("T1", "NOR\nTH"), ("T3", "NORTH")]
        assert rows(layers.read_rejects(each, feed), "tower_id", "_reject") == [("T2", "malformed: text behind a closing quote")]


def test_bounded_state_dedupe_leaves_out_refused_rows(spark, tmp_path, rows):
    feed, landing = FEEDS["cdr"], tmp_path / "in"
    send(landing, "cdr", "a.csv", {}, {"cdr_id": "R2", "region": '"x"y'})
    out = str(tmp_path / "out")
    distinct = stream_distinct(stream_feed_files(spark, feed, str(landing / "cdr")), feed)
    written = distinct.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
    written.trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(out), "cdr_id") == [("R1",)]


@pytest.mark.parametrize("name", ["customers", "devices", "cdr"])
def test_a_small_merge_touches_only_the_buckets_of_its_keys(spark, lake, tmp_path, rows, name):
    feed, landing = FEEDS[name], tmp_path / "in"
    send(landing, name, "a.csv", *[{feed.key: f"K{i}"} for i in range(60)])
    change = {"customers": {"plan_id": "P2"}, "plans": {"plan_name": "x"}, "devices": {"device_model": "x"}, "towers": {"capacity_mbps": "7"}, "cdr": {}}[name]
    tables = [layers.stage_table(feed), layers.DIM_CURRENT if name == "customers" else layers.target_table(feed)]
    seen = []
    for at, file in ((D1, None), (D2, "b.csv")):
        if file:
            send(landing, name, file, {feed.key: "K7"} | change, {feed.key: "new"})
        layers.run_raw(lake, str(landing), [feed], at), layers.run_staging(lake, [feed], at), layers.run_curated(lake, at, feeds=[name])
        seen.append([set(lake.parts(t)) for t in tables])
    before, after = seen
    assert len(before[0]) > 20
    if name == "cdr":
        assert before[0] < after[0] and len(after[0] - before[0]) == 1
    else:
        for old, new in zip(before, after, strict=True):
            assert len(old - new) <= 2 and 1 <= len(new - old) <= 2 and len(old & new) > 20
    target = layers.read_target(lake, feed)
    assert target.select(feed.key).distinct().count() == 61 == layers.read_stage(lake, feed).count()
    if name == "customers":
        assert target.where("is_current").count() == 61 and target.count() == 62
    if feed.target.surrogate:
        assert target.where(f"{feed.key} = 'new'").first()[feed.target.surrogate] == (62 if name == "customers" else 61)


def test_each_error_is_stored_once_and_nothing_new_is_not_read(spark, lake, tmp_path, rows):
    feed, landing = FEEDS["towers"], tmp_path / "in"
    for at, name in ((D1, "a.csv"), (D2, "b c.csv"), (D3, "c.csv")):
        send(landing, "towers", name, {"tower_id": f"T{at.day}"}, {"tower_id": f"X{at.day}", "region": "north"})
        layers.run_raw(lake, str(landing), [feed], at)
        layers.run_validate(lake, str(landing), [feed], at)
        assert layers.validation_errors(lake).count() == at.day
        assert layers.count_log(lake).count() == at.day
    idle = layers.run_validate(lake, str(landing), [feed], D3 + dt.timedelta(hours=1))
    assert idle[0][-1] == "no new rows" and layers.validation_errors(lake).count() == 3
    last = layers.validation_summary(lake).where(F.col("checked_at") > F.lit(D3).cast("timestamp_ntz"))
    assert rows(last.select("records_checked", "check_status").distinct()) == [(0, "PASS")]
    layers.run_validate(lake, str(landing), [feed], D3 + dt.timedelta(hours=2), full_scan=True)
    assert layers.validation_errors(lake).count() == 6
    assert rows(layers.count_log(lake).select("check_status").distinct()) == [("MATCH",)]


@pytest.mark.parametrize("on_delete", ["keep", "close"])
def test_removed_keys_reach_the_dimension_by_policy(spark, lake, tmp_path, rows, on_delete):
    feed, landing = FEEDS["customers"], tmp_path / "in"
    send(landing, "customers", "a.csv", *[{"customer_id": f"C{i}"} for i in range(4)])
    layers.run_raw(lake, str(landing), [feed], D1), layers.run_staging(lake, [feed], D1), layers.run_curated(lake, D1, feeds=["customers"])
    send(landing, "customers", "b.csv", {"customer_id": "C1", "plan_id": "P2"}, {"customer_id": "C2", "plan_id": "P2"}, {"customer_id": "new"})
    layers.run_raw(lake, str(landing), [feed], D2), layers.run_staging(lake, [feed], D2)
    send(landing, "customers", "c.csv", {"customer_id": "C1", "plan_id": "P3"})
    layers.run_raw(lake, str(landing), [feed], D3), layers.run_staging(lake, [feed], D3)
    gone = spark.createDataFrame([("C2",), ("C3",), ("new",), ("unknown",), (None,)], "customer_id string")
    assert layers.remove_keys(lake, feed, gone, D3) == 3
    assert rows(layers.read_stage(lake, feed), "customer_id") == [("C0",), ("C1",)]
    pending = layers.pending_changes(lake, feed)
    assert rows(pending, "customer_id", "plan_id", "_action", "_is_update") == [
        ("C1", "P1", "DELETE", True), ("C1", "P3", "INSERT", True), ("C2", "P1", "DELETE", False), ("C3", "P1", "DELETE", False),
    ]
    layers.run_curated(lake, D3, feeds=["customers"], on_delete=on_delete)
    current = {"keep": [("C0", "P1"), ("C1", "P3"), ("C2", "P1"), ("C3", "P1")], "close": [("C0", "P1"), ("C1", "P3")]}[on_delete]
    assert rows(layers.read_target(lake, feed).where("is_current"), "customer_id", "plan_id") == current
    assert layers.read_target(lake, feed).count() == 5


def test_day_rows_follow_the_events_month_by_month(spark, lake, tmp_path, rows):
    later = D1 + dt.timedelta(days=40)
    send(tmp_path / "in", "towers", "a.csv", {})
    layers.run_raw(lake, str(tmp_path / "in"), [FEEDS["towers"]], D1)
    assert layers.fold_runs(lake, D1) == {"2024-01"} and layers.fold_runs(lake, D1) == set()
    first = lake.parts(layers.RUN_DAYS)

    layers.run_staging(lake, [FEEDS["towers"]], later)
    assert layers.fold_runs(lake, later) == {"2024-02"}
    assert set(first) < set(lake.parts(layers.RUN_DAYS))  # January was not written again

    # The end of a run that started in January, logged in February.
    batch = lake.begin("late")
    late = [runlog.start_event(7, "LONG", D2, "TASK"), runlog.end_event(7, "LONG", later, day=D2.date(), rows_read=4)]
    layers.log_events(lake, batch, runlog.rows_as_table(spark, late, runlog.EVENT_SCHEMA), rebalance=False)
    lake.commit(batch, later)
    assert layers.fold_runs(lake, later) == {"2024-01"}
    days = layers.run_days(lake)
    assert rows(reports.stats_of_days(days)) == rows(reports.daily_run_stats(layers.runs(lake)))
    assert days.where("job_name = 'LONG'").first().total_rows_read == 4
    assert rows(layers.runs(lake, D2.date()), "job_name") == [("LONG",)]


def test_registries_hold_one_row_per_job_rule_and_region(spark, lake, tmp_path, rows):
    send(tmp_path / "in", "towers", "a.csv", {})
    feed = FEEDS["towers"]
    for at in (D1, D2):
        layers.run_raw(lake, str(tmp_path / "in"), [feed], at)
        layers.run_staging(lake, [feed], at)
    jobs = layers.job_registry(lake)
    assert jobs.count() == 17 == jobs.select("job_name").distinct().count()
    assert rows(jobs.where("layer = 'AD_HOC'"), "job_name", "created_at") == [(feed.load_job, D1)]
    rules = layers.rule_registry(lake)
    expected = sorted(quality.rule_lines(FEEDS.values()))
    assert sorted(tuple(r) for r in rules.collect()) == expected
    assert len(lake.parts(layers.RULE_REGISTRY)) == 1  # the second run wrote nothing

    seen = governance.row_filter(spark.createDataFrame([("NORTH",), ("SOUTH",)], "region string"), "region", "R_ANALYST_NORTH", layers.role_regions(lake))
    assert rows(seen) == [("NORTH",)]


def test_a_changed_registry_row_stays_as_it_was_set(spark, lake, monkeypatch):
    layers.load_registries(lake, ["MINE"], D1)
    monkeypatch.setattr(runlog, "JOBS", (*runlog.JOBS, ("MINE", "STAGE_LOAD", "a", "b", "c"), ("NEW", "STAGE_LOAD", "a", "b", "c")))
    layers.load_registries(lake, ["MINE"], D2)
    got = {r.job_name: r for r in layers.job_registry(lake).collect()}
    assert len(got) == 18 and (got["MINE"].layer, got["MINE"].created_at, got["NEW"].created_at) == ("AD_HOC", D1, D2)


def test_load_warnings_name_their_file_and_are_numbered_over_runs(spark, lake, tmp_path):
    feed, landing = FEEDS["towers"], tmp_path / "in"
    for at, names in ((D1, "ab"), (D2, "c")):
        for name in names:
            send(landing, "towers", f"{name}.csv", {}, {"tower_id": "T" * 99})
        layers.run_raw(lake, str(landing), [feed], at)
    logged = layers.errors(lake).withColumn("context", F.parse_json("error_context"))
    got = logged.selectExpr("error_id", "variant_get(context, '$.file', 'string')", "variant_get(context, '$.error_limit', 'int')", "severity")
    found = sorted(tuple(r) for r in got.collect())
    assert [(i, name.rsplit("/", 1)[-1], n, kind) for i, name, n, kind in found] == [
        (1, "a.csv", 2, "WARNING"), (2, "b.csv", 2, "WARNING"), (3, "c.csv", 2, "WARNING")
    ]
    days = {r.job_name: r for r in runlog.day_rows(runlog.run_states(layers.run_events(lake, D1.date()))).collect()}
    assert days[feed.load_job].warning_runs == 1
