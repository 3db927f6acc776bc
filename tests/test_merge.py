import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.feeds import FEEDS
from millrace.operators.changes import appended_rows, keys_ending_in, latest_inserts, replay, snapshot_diff
from millrace.operators.history import scd2_apply
from millrace.operators.latest import latest_by_key, newest_first, total_order
from millrace.operators.merge import changes_of, insert_absent, merge_counts, state, tracked_change, upsert
from millrace.operators.staging import merge_stage, stage_rows
from millrace.operators.surrogate import assign_keys

T0, T1, T2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
SCHEMA = "k string, a string, b int, stamp timestamp_ntz"


def target(spark, *data):
    return spark.createDataFrame([(*d, T0) for d in data], SCHEMA)


def source(spark, *data):
    return spark.createDataFrame(list(data), "k string, a string, b int")


@pytest.mark.parametrize("small", [False, True])
def test_upsert_all_columns(spark, rows, small):
    out = upsert(target(spark, ("1", "x", 1), ("2", "y", None)), source(spark, ("2", None, 5), ("3", "n", 7)), ["k"],
                 stamp="stamp", batch_ts=T1, small=small)
    assert rows(out) == [("1", "x", 1, T0, "keep"), ("2", None, 5, T1, "update"), ("3", "n", 7, T1, "insert")]
    assert tuple(merge_counts(out).first()) == (1, 1, 1)


@pytest.mark.parametrize("small", [False, True])
def test_upsert_column_subset_keeps_first_value(spark, rows, small):
    out = upsert(target(spark, ("1", "x", 1)), source(spark, ("1", "new", 9), ("2", "n", 2)), ["k"], update=["b"],
                 stamp="stamp", batch_ts=T1, small=small)
    assert rows(out) == [("1", "x", 9, T1, "update"), ("2", "n", 2, T1, "insert")]


@pytest.mark.parametrize("small", [False, True])
def test_gate_ignores_nulls_and_untracked_columns(spark, rows, small):
    old = target(spark, ("1", "x", 1), ("2", None, 1), ("3", "x", 1), ("4", "x", 1))
    new = source(spark, ("1", "x", 9), ("2", "now", 9), ("3", None, 9), ("4", "z", 9))
    out = upsert(old, new, ["k"], when=tracked_change(["a"]), stamp="stamp", batch_ts=T1, small=small)
    assert rows(out) == [("1", "x", 1, T0, "keep"), ("2", None, 1, T0, "keep"), ("3", "x", 1, T0, "keep"), ("4", "z", 9, T1, "update")]


def test_columns_the_source_lacks(spark, rows):
    old = target(spark, ("1", "x", 1))
    new = source(spark, ("1", "y", 0), ("2", "z", 0)).drop("b")
    for small in (False, True):
        out = upsert(old, new, ["k"], stamp="stamp", batch_ts=T1, small=small)
        assert rows(out, "k", "a", "b") == [("1", "y", 1), ("2", "z", None)]


def test_upsert_against_a_plain_dict(spark, rows):
    rng = random.Random(7)
    for partitions in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        old = {f"k{i}": (rng.choice("abc"), rng.choice([None, 1, 2])) for i in rng.sample(range(60), 40)}
        new = {f"k{i}": (rng.choice(["a", "b", None]), rng.choice([None, 1, 2])) for i in rng.sample(range(60), 40)}
        expected = {k: (*v, T0, "keep") for k, v in old.items()}
        for k, v in new.items():
            if k not in old:
                expected[k] = (*v, T1, "insert")
            elif None not in (v[0], old[k][0]) and v[0] != old[k][0]:
                expected[k] = (*v, T1, "update")
        frames = target(spark, *[(k, *v) for k, v in old.items()]), source(spark, *[(k, *v) for k, v in new.items()])
        for small in (False, True):
            out = upsert(*frames, ["k"], when=tracked_change(["a"]), stamp="stamp", batch_ts=T1, small=small)
            assert rows(out) == sorted(((k, *v) for k, v in expected.items()), key=repr)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_upsert_twice_changes_nothing_more(spark, rows):
    old, new = target(spark, ("1", "x", 1)), source(spark, ("1", "y", 2), ("2", "z", 3))
    once = state(upsert(old, new, ["k"], when=tracked_change(["a"]), stamp="stamp", batch_ts=T1))
    twice = upsert(once, new, ["k"], when=tracked_change(["a"]), stamp="stamp", batch_ts=T2)
    assert rows(state(twice)) == rows(once)
    assert changes_of(twice).isEmpty()


@pytest.mark.parametrize("small", [False, True])
def test_insert_absent(spark, rows, small):
    old, new = target(spark, ("1", "x", 1)), source(spark, ("1", "n", 0), ("2", "n", 1), ("2", "n", 1), ("3", "n", 1))
    assert rows(insert_absent(old, new, ["k"], small=small), "k") == [("2",), ("2",), ("3",)]
    assert rows(insert_absent(old, new, ["k"], dedupe=True, small=small), "k") == [("2",), ("3",)]


def test_latest_is_the_same_whatever_the_partitioning(spark, rows):
    data = [(f"k{i % 3}", T0 if i % 2 else T1, f"f{i % 4}", i % 5) for i in range(60)]
    results = set()
    for n in (1, 4, 13):
        df = spark.createDataFrame(data, "k string, at timestamp_ntz, file string, v int").repartition(n)
        results.add(tuple(rows(latest_by_key(df, ["k"], total_order(df, ["k"], ("at", "file"))))))
    assert len(results) == 1
    best = {k: max(r[1:] for r in data if r[0] == k) for k in {r[0] for r in data}}
    assert dict((r[0], r[1:]) for r in results.pop()) == best


def test_diff_and_replay(spark, rows):
    before = source(spark, ("1", "x", 1), ("2", None, 2), ("3", "z", 3), ("5", "s", None))
    after = source(spark, ("1", "x", 1), ("2", "now", 2), ("4", "n", 4), ("5", "s", None))
    diff = snapshot_diff(before, after, ["k"])
    assert rows(diff) == [
        ("2", "now", 2, "INSERT", True),
        ("2", None, 2, "DELETE", True),
        ("3", "z", 3, "DELETE", False),
        ("4", "n", 4, "INSERT", False),
    ]
    assert rows(replay(before, diff, ["k"])) == rows(after)
    assert snapshot_diff(after, after, ["k"]).isEmpty()
    assert rows(snapshot_diff(before, after, ["k"], ["b"]), "k", "_action") == [("3", "DELETE"), ("4", "INSERT")]
    assert rows(appended_rows(before, after, ["k"]), "k") == [("4",)]


CHANGES = "id string, v string, updated_at timestamp_ntz, _action string, _is_update boolean"


def changes(spark, *data):
    return spark.createDataFrame(list(data), CHANGES)


def test_latest_change_decides(spark, rows):
    df = changes(
        spark,
        ("1", "old", T0, "DELETE", True), ("1", "new", T0, "INSERT", True), ("2", "a", T0, "INSERT", False),
        ("2", "a", T1, "DELETE", False), ("3", "a", T0, "INSERT", False), ("3", "b", T1, "INSERT", True),
    )
    assert rows(latest_inserts(df, "id"), "id", "v") == [("1", "new"), ("3", "b")]
    assert rows(keys_ending_in(df, "id", "DELETE")) == [("2",)]


def test_history_invariants(spark, rows):
    dim = spark.createDataFrame([], "id string, v string, eff_start_ts timestamp_ntz, eff_end_ts timestamp_ntz, is_current boolean")
    rng = random.Random(3)
    times = [T0 + dt.timedelta(days=d) for d in range(4)]
    for at in times:
        batch = [(f"k{i}", f"v{rng.randrange(9)}", at, "INSERT", False) for i in rng.sample(range(8), 5)]
        batch.append(("gone", "x", at, "DELETE" if at > T0 else "INSERT", False))
        dim = scd2_apply(dim, changes(spark, *batch), "id", ["id", "v"], at)
    found = {}
    for r in dim.collect():
        found.setdefault(r.id, []).append(r)
    for versions in found.values():
        versions.sort(key=lambda r: r.eff_start_ts)
        assert sum(r.is_current for r in versions) == 1 and versions[-1].is_current
        for a, b in zip(versions, versions[1:]):
            assert a.eff_end_ts == b.eff_start_ts and not a.is_current
        assert versions[-1].eff_end_ts is None
    assert len(found["gone"]) == 1  # a delete leaves the current version


def test_deletes_close_on_request(spark, rows):
    dim = spark.createDataFrame([("1", "a", T0, None, True)], "id string, v string, eff_start_ts timestamp_ntz, eff_end_ts timestamp_ntz, is_current boolean")
    gone = changes(spark, ("1", "a", T1, "DELETE", False))
    out = scd2_apply(dim, gone, "id", ["id", "v"], T1, on_delete="close")
    assert rows(out) == [("1", "a", T0, T1, False)]


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(1000).select(F.format_string("k%05d", (F.col("id") * 37) % 1000).alias("k"))
    got = [(r.sk, r.k) for r in assign_keys(df.repartition(7), "sk", 50, "k").orderBy("sk").collect()]
    assert [s for s, _ in got] == list(range(51, 1051)) and [k for _, k in got] == sorted(k for _, k in got)
    assert assign_keys(df.limit(0), "sk", 50, "k").count() == 0


def test_staging_edge_cases(spark, rows):
    feed = FEEDS["cdr"]
    line = {c: None for c in feed.columns} | {"cdr_id": "c1", "call_start_ts": "2024-01-05 10:00:00", "source_file_name": "f", "_load_ts": T0}
    data = [line, line, {**line, "cdr_id": None}, {**line, "cdr_id": "c2", "call_start_ts": "soon"}, {**line, "cdr_id": "c3"}]
    raw = spark.createDataFrame([tuple(d[n] for n in (*feed.columns, "source_file_name", "_load_ts")) for d in data], feed.raw_schema)
    staged = stage_rows(raw, feed)
    assert rows(staged, "cdr_id", "roaming_flag") == [("c1", False), ("c1", False), ("c3", False)]
    empty = spark.createDataFrame([], feed.stage_schema)
    first = state(merge_stage(empty, staged, feed, T0))
    assert first.count() == 3 and merge_stage(first, staged, feed, T1).isEmpty()
    assert merge_stage(empty, staged, feed, T0, dedupe=True).count() == 2


def test_change_sets_of_several_batches_make_one(spark, rows):
    """Against the difference of the two outer states, for all sequences of three changes of a key."""
    import datetime as dt
    from itertools import product

    from millrace.operators.changes import net_changes, snapshot_diff

    kind = "k string, v int, _action string, _is_update boolean, _changed_at timestamp_ntz"
    made, before, after = [], [], []
    for n, (start, *steps) in enumerate(product([True, False], *[["set", "drop", "none"]] * 3)):
        key, held = f"k{n:02d}", 0 if start else None
        if start:
            before.append((key, 0))
        for i, step in enumerate(steps):
            at = dt.datetime(2024, 1, 1 + i)
            if step == "set":
                if held is not None:
                    made.append((key, held, "DELETE", True, at))
                made.append((key, i + 1, "INSERT", held is not None, at))
                held = i + 1
            elif step == "drop" and held is not None:
                made.append((key, held, "DELETE", False, at))
                held = None
        if held is not None:
            after.append((key, held))
    wanted = snapshot_diff(*[spark.createDataFrame(x, "k string, v int") for x in (before, after)], ["k"])
    got = net_changes(spark.createDataFrame(made, kind).repartition(3), "k").drop("_changed_at")
    assert rows(got) == rows(wanted)


def test_change_pairs_hold_the_old_row(spark, rows):
    import datetime as dt

    from millrace.operators.merge import change_pairs, upsert

    at = dt.datetime(2024, 1, 2)
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    source = spark.createDataFrame([("a", 9), ("d", 4)], "k string, v int")
    for small in (False, True):
        merged = upsert(target, source, ["k"], small=small, before=True)
        assert rows(change_pairs(merged, at)) == [("a", 1, "DELETE", True, at), ("a", 9, "INSERT", True, at), ("d", 4, "INSERT", False, at)]
