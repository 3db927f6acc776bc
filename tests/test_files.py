import datetime as dt

import pytest

from millrace.feeds import FEEDS
from millrace.sources import files

AT = dt.datetime(2024, 1, 1, 6)
TOWERS = FEEDS["towers"]


@pytest.fixture
def towers(tmp_path):
    folder = tmp_path / "towers"
    folder.mkdir()
    head = "tower_id,region,latitude,longitude,capacity_mbps,tower_status\n"
    (folder / "a.csv").write_text(
        head + 'T1,NORTH,1.5,2.5,500,ACTIVE\nT2,"x, y","q""z",NULL,null,NA\nT3,SOUTH\nT4,EAST,1,2,3,ACTIVE,surplus,more\n'
    )
    (folder / "b c.csv").write_text(head + "T" * 21 + ",NORTH,1,2,3,ACTIVE\n,WEST,1,2,3,ACTIVE\n")
    return str(folder)


def test_null_tokens_quotes_and_ragged_rows(spark, towers, rows):
    df = files.read_feed(spark, TOWERS, towers, AT)
    got = {r.tower_id: r for r in df.collect()}
    assert got["T1"].latitude == "1.5" and got["T1"]._load_ts == AT
    assert (got["T2"].region, got["T2"].latitude) == ("x, y", 'q"z')
    assert (got["T2"].longitude, got["T2"].capacity_mbps, got["T2"].tower_status) == (None, None, None)
    assert got["T3"].region == "SOUTH" and got["T3"].tower_status is None
    assert got["T4"].tower_status == "ACTIVE"
    assert all(r.source_file_name.endswith(".csv") for r in got.values())


def test_rejects_leave_the_other_rows(spark, towers):
    good, bad = files.split_rejects(files.read_feed(spark, TOWERS, towers, AT), TOWERS)
    assert good.count() == 5 and bad.count() == 1
    assert bad.first()._reject == "tower_id is longer than 20: 21"


def test_load_report_per_file(spark, towers, rows):
    flagged = files.flag_rejects(files.read_feed(spark, TOWERS, towers, AT), TOWERS)
    report = files.load_report(flagged, TOWERS, AT)
    assert rows(report, "rows_parsed", "rows_loaded", "errors_seen", "first_error") == [
        (2, 1, 1, "tower_id is longer than 20: 21"),
        (4, 4, 0, None),
    ]
    assert rows(files.load_totals(report)) == [("towers", 2, 6, 5, 1)]


def test_listed_names_match_row_provenance(spark, towers):
    listed = files.list_files(spark, towers)
    history = files.read_feed(spark, TOWERS, towers, AT).select("source_file_name").distinct()
    assert listed.count() == 2 and files.unseen_files(listed, history).count() == 0


def test_source_counts_count_lines(spark, towers, rows):
    assert rows(files.source_file_counts(spark, TOWERS, towers), "source_row_count") == [(2,), (4,)]


def test_gzip_is_read(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("h\nT9,NORTH,1,2,3,ACTIVE\n")
    assert files.read_feed(spark, TOWERS, str(tmp_path), AT).first().tower_id == "T9"


def test_json_array(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"tower_id": "T1", "region": "NA"},\n {"tower_id": "T2", "capacity_mbps": "5"}]')
    got = {r.tower_id: r for r in files.read_json_feed(spark, TOWERS, str(tmp_path), AT).collect()}
    assert got["T1"].region is None and got["T2"].capacity_mbps == "5"


HEAD = "tower_id,region,latitude,longitude,capacity_mbps,tower_status\n"


def loaded_and_refused(spark, folder, **options):
    good, bad = files.split_rejects(files.read_feed(spark, TOWERS, str(folder), AT, **options), TOWERS)
    return {tuple(r)[:6] for r in good.collect()}, {(r.tower_id, r._reject) for r in bad.collect()}


def test_line_breaks_in_quotes_are_one_row(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_bytes((HEAD + 'T1,"NOR\nTH",1,2,3,ACTIVE\nT2,"a\r\nb",1,2,3,"x\n"\n\n  \n').encode())
    (tmp_path / "b.csv").write_bytes((HEAD + 'T3,EAST,1,2,3,NA\nT4,"q",1\n').replace("\n", "\r\n").encode() + b"T5,W,1,2,3,A\n")
    good, bad = loaded_and_refused(spark, tmp_path)
    assert good == {
        ("T1", "NOR\nTH", "1", "2", "3", "ACTIVE"),
        ("T2", "a\r\nb", "1", "2", "3", "x\n"),
        ("T3", "EAST", "1", "2", "3", None),
        ("T4", "q", "1", None, None, None),
        ("T5", "W", "1", "2", "3", "A"),
    }
    assert not bad
    assert rows(files.source_file_counts(spark, TOWERS, str(tmp_path)), "source_row_count") == [(2,), (3,)]


def test_malformed_lines_are_refused_and_counted(spark, tmp_path, rows):
    lines = ['T1,"x"y,1', 'T2,""z,1', 'T3,"""a""b",1', 'T4,a"b""c,1', 'T5,"""",""', 'T6,"q" ,1', "T7", 'T8,"p,q",1,2,3,A,s,"t"']
    lines += [f"T9,{','.join('1234A')},{','.join('stuvwxy')}", 'T10,"o,1', 'T11,"p",1']
    (tmp_path / "a.csv").write_text(HEAD + "\n".join([*lines, 'T12,N,1,2,3,A,"open', "T13,N", ""]))
    good, bad = loaded_and_refused(spark, tmp_path)
    assert {(r[0], r[1]) for r in good} == {
        ("T3", '"a"b'), ("T4", 'a"b""c'), ("T5", '"'), ("T6", "q"), ("T7", None), ("T8", "p,q"), ("T9", "1"),
    }
    assert bad == {("T1", files.BEHIND), ("T2", files.BEHIND), ("T10", files.BEHIND), ("T12", files.UNCLOSED)}
    flagged = files.flag_rejects(files.read_feed(spark, TOWERS, str(tmp_path), AT), TOWERS)
    assert rows(files.load_report(flagged, TOWERS, AT), "rows_parsed", "rows_loaded", "errors_seen") == [(11, 7, 4)]
    by_line, refused = loaded_and_refused(spark, tmp_path, multiline=False)
    assert {r[0] for r in by_line} == {"T3", "T4", "T5", "T6", "T7", "T8", "T9", "T11", "T13"}
    assert {r[0] for r in refused} == {"T1", "T2", "T10", "T12"}


def test_first_error_is_the_first_in_the_file(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text(HEAD + 'T1,N,1,2,3,A\n"T2\n",N,1,2,3,A\n\nT3,"x"y\n' + "T" * 21 + ",N\n" + 'T5,"a"b\n')
    flagged = files.flag_rejects(files.read_feed(spark, TOWERS, str(tmp_path), AT), TOWERS)
    assert rows(files.load_report(flagged, TOWERS, AT), "rows_parsed", "errors_seen", "first_error", "first_error_line") == [
        (5, 3, files.BEHIND, 6)
    ]


def test_any_number_of_surplus_fields_loads(spark, tmp_path):
    for n in range(12):
        (tmp_path / f"{n}.csv").write_text(HEAD + f'T{n},"NOR\nTH",1,2,3,ACTIVE' + ",s" * n + "\n")
    good, bad = loaded_and_refused(spark, tmp_path)
    assert len(good) == 12 and not bad


def reference_rows(spark, folder):
    """The same files by Spark's own reader, a task per file, without surplus fields."""
    options = dict(header=True, multiLine=True, lineSep="\n", quote='"', escape='"', mode="PERMISSIVE", enforceSchema=True)
    got = spark.read.schema(", ".join(f"{c} string" for c in TOWERS.columns)).options(**options).csv(str(folder))
    return sorted((tuple(None if v is None else v.removesuffix("\r") for v in r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
def test_quoted_files_split_anywhere_give_the_rows_of_whole_files(spark, tmp_path, size):
    import random

    dice = random.Random(size)
    value = lambda: dice.choice(["a", "b c", "", '"x\ny"', '"p,q"', '"d""e"', '"\n\n"', '"l\r\nm"', '""', "r\"s", "NA", '"é\n漢"', '"' + "w\n" * 40 + '"'])
    for name in ("a", "b", "c"):
        lines = [",".join([f"{name}{i}", *[value() for _ in range(5)]]) for i in range(60)]
        (tmp_path / f"{name}.csv").write_bytes((HEAD + "\n".join(lines) + "\n" * (name != "b")).encode())
    (tmp_path / "plain.csv").write_text(HEAD + "\n".join(f"P{i},N,1,2,3,A" for i in range(99)))
    (tmp_path / "head.csv").write_text('"tower\nid",region\n\nH1,N,1,2,3,A\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = files.text_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > (20 if size < 100 else 1 if size < 5000 else 0)
        got = files.read_feed(spark, TOWERS, str(tmp_path), AT)
        mine = sorted(tuple(r) for r in got.select(*TOWERS.columns).na.fill("").collect())
        assert got.where("_malformed IS NOT NULL").isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    theirs = sorted(tuple("" if v in files.NULL_TOKENS or v is None else v for v in r) for r in reference_rows(spark, tmp_path))
    assert mine == theirs


def test_a_quote_left_open_gathers_no_more_than_the_longest_record(spark, tmp_path, monkeypatch):
    from millrace.sources import records

    monkeypatch.setattr(records, "LONGEST", 300)
    (tmp_path / "a.csv").write_text(HEAD + 'T1,"' + "x\n" * 100 + '",1\nT2,"open\n' + "T3,N\n" * 500)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = records.file_records(files.text_lines(spark, str(tmp_path))).select("_line", "_raw").collect()
        good, bad = loaded_and_refused(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r[0], len(r[1])) for r in raw) == [(2, 207), (103, len('T2,"open'))]
    assert not good and bad == {("T1", "region is longer than 50: 200"), ("T2", files.UNCLOSED)}


def test_files_are_scanned_once_for_their_blocks_and_once_for_their_records(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text(HEAD + "T1,N,1,2,3,A\n \t\n!,S,1,2,3,A\n")
    (tmp_path / "b.csv").write_text(HEAD)
    (tmp_path / "c.csv").write_text("\n\n")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    read = files.read_feed(spark, TOWERS, str(tmp_path), AT)
    assert rows(read, "tower_id", "_line") == [("!", 4), ("T1", 2)]
    assert plan(read).count("FileScan text") == 1
    counts = files.source_file_counts(spark, TOWERS, str(tmp_path))
    assert rows(counts, "source_row_count") == [(2,)] and "FileScan text" not in plan(counts)
    (tmp_path / "d.csv").write_text(HEAD + 'T2,"N\nO",1,2,3,A\n\nT3,N\n')
    assert rows(files.source_file_counts(spark, TOWERS, str(tmp_path)), "source_row_count") == [(2,), (2,)]
    assert rows(files.read_feed(spark, TOWERS, str(tmp_path), AT), "tower_id", "_line") == [("!", 4), ("T1", 2), ("T2", 2), ("T3", 5)]


def test_blocks_do_not_follow_the_cores(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "T1,N,1,2,3,A\n")
    spark.conf.unset("spark.sql.files.minPartitionNum")
    files.read_feed(spark, TOWERS, str(tmp_path), AT)
    assert spark.conf.get("spark.sql.files.minPartitionNum") == str(spark.sparkContext.defaultParallelism)
