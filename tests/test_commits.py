"""What counts as written: markers, versions, id ranges, the log's manifest, applied state, layers."""

import json
import os
import threading
from datetime import datetime, timedelta

import pytest
from compare import plan_text
from pyspark.sql import functions as F

from martkeeper.operators import grants as G
from martkeeper.plans import reconcile as R
from martkeeper.plans import registry
from martkeeper.sources import markers, sinks
from martkeeper.sources.runlog import COMMITS, RunConflict, RunLog
from martkeeper.sources.stored import LayerStore, input_fingerprint
from martkeeper.sources.tables import ParquetFolder

NOW = datetime(2024, 1, 15, 12)


def test_one_of_many_creates_a_marker(spark, tmp_path):
    won = []

    def create(i):
        if markers.publish(spark, f"{tmp_path}/m/x", f"text {i}"):
            won.append(i)

    threads = [threading.Thread(target=create, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and markers.read(spark, f"{tmp_path}/m/x") == f"text {won[0]}"
    assert markers.names(spark, f"{tmp_path}/m") == ["x"]  # no drafts are left
    assert markers.read(spark, f"{tmp_path}/m/y") is None and markers.names(spark, f"{tmp_path}/n") is None


# Versions ------------------------------------------------------------------------------------


def test_a_half_written_version_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_version(spark.range(2), path, 1)
    spark.range(5).write.parquet(f"{path}/{sinks.VERSION_DATA}/000000000002-dead")
    os.remove(f"{path}/{sinks.VERSION_DATA}/000000000002-dead/_SUCCESS")
    os.makedirs(f"{path}/_version=3")
    assert sinks.latest_version(spark, path) == 1 and sinks.read_version(spark, path).count() == 2
    with pytest.raises(ValueError):
        sinks.read_version(spark, path, 2)


def test_two_writers_of_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_version(spark.range(2), path, 1, owner="a") is True
    assert sinks.write_version(spark.range(9), path, 1, owner="a") is False  # a repeat keeps the first
    for owner in ("b", None):
        with pytest.raises(sinks.VersionConflict):
            sinks.write_version(spark.range(3), path, 1, owner=owner)
    assert sinks.read_version(spark, path).count() == 2


def test_writers_that_meet_at_the_marker(spark, tmp_path, monkeypatch):
    """Both have written their rows before either publishes."""
    path = str(tmp_path / "t")
    publish = markers.publish

    def late(session, name, text):
        monkeypatch.setattr(markers, "publish", publish)
        sinks.write_version(spark.range(7), path, 1, owner="first")
        return publish(session, name, text)

    monkeypatch.setattr(markers, "publish", late)
    with pytest.raises(sinks.VersionConflict):
        sinks.write_version(spark.range(3), path, 1, owner="second")
    assert sinks.read_version(spark, path).count() == 7


# The log -------------------------------------------------------------------------------------


def rows(spark, n, at=NOW, first=1, extra=None):
    df = spark.range(n).select(
        (F.col("id") + first).alias("audit_id"), F.lit(at).cast("timestamp").alias("action_time"),
        F.lit("grant").alias("action"))
    return df.withColumn(extra, F.lit(1)) if extra else df


def append(log, run, n, at=NOW, extra=None):
    own = log.reservation(run) or log.reserve(run, n)
    log.commit(own, rows(log.spark, n, at, own.first, extra))
    return own


def test_interleaved_runs_have_dense_ids_and_a_retry_keeps_its_range(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    assert log.read() is None
    rows(spark, 3).write.parquet(log.path)  # a seed
    a, b = (log.reservation(r) or log.reserve(r, n) for r, n in (("a", 4), ("b", 2)))
    assert (a.first, b.first) == (4, 8)
    log.commit(b, rows(spark, 2, first=b.first))
    again = RunLog(spark, log.path).reservation("a")  # the first run died and is started again
    assert again == a
    log.commit(again, rows(spark, 4, first=again.first))
    log.commit(again, rows(spark, 4, first=again.first))
    assert sorted(r.audit_id for r in log.read().collect()) == list(range(1, 10))
    with pytest.raises(RunConflict):
        log.commit(log.reserve("c", 5), rows(spark, 4))
    assert log.read().count() == 9


def test_two_runs_that_read_the_same_end(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    found = []

    def run(name):
        found.append(RunLog(spark, log.path).reserve(name, 10))

    threads = [threading.Thread(target=run, args=(f"r{i}",)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted((r.number, r.first) for r in found) == [(i, 1 + 10 * i) for i in range(6)]


def test_times_prune_folders_and_schemas_come_from_the_manifest(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    for day in range(4):
        append(log, f"d{day}", 2, NOW + timedelta(days=day), "extra" if day == 3 else None)
    append(log, "empty", 0)
    recent = log.read(since=NOW + timedelta(days=2, hours=-1))
    assert recent.count() == 4 and recent.columns == ["audit_id", "action_time", "action", "_run", "extra"]
    assert {os.path.basename(os.path.dirname(f))[:12] for f in recent.inputFiles()} == {f"{2:012d}", f"{3:012d}"}
    assert log.read().filter("extra IS NULL").count() == 6
    nothing = log.read(since=NOW + timedelta(days=9))
    assert nothing.count() == 0 and "extra" in nothing.columns
    bad = spark.range(1).selectExpr("'x' AS audit_id", "now() AS action_time", "'a' AS action")
    log.commit(log.reserve("bad", 1), bad)
    with pytest.raises(TypeError, match="audit_id"):
        log.read()


def test_compaction_keeps_rows_and_untouched_days(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    for i in range(6):
        append(log, f"r{i}", 3, NOW + timedelta(hours=12 * i), "extra" if i == 4 else None)
    before = {tuple(r) for r in log.read().select("audit_id", "action_time", "_run", "extra").collect()}
    open_run = log.reserve("unfinished", 1)
    append(log, "behind", 1, NOW + timedelta(days=9))
    assert log.compact() == 5 and log.compact() is None  # stops at the unfinished run
    assert {p.day for p in log.pieces()} == {"2024-01-15", "2024-01-16", "2024-01-17", "2024-01-18", None}
    after = log.read().select("audit_id", "action_time", "_run", "extra")
    assert before < {tuple(r) for r in after.collect()} and after.count() == 19
    first = {p.day: p.folder for p in log.pieces()}
    log.commit(open_run, rows(spark, 1, NOW, open_run.first))
    assert log.compact() == 7
    second = {p.day: p.folder for p in log.pieces()}
    assert second["2024-01-16"] == first["2024-01-16"] and second["2024-01-15"] != first["2024-01-15"]
    assert log.read().count() == 20 and len(log.obsolete()) == 8
    day = log.read(since=NOW + timedelta(days=2), until=NOW + timedelta(days=3))
    assert {f.split("_day=")[1][:10] for f in day.inputFiles()} == {"2024-01-17", "2024-01-18"}


# The job -------------------------------------------------------------------------------------


def control_of(spark, folder, now=NOW):
    path = f"{folder}/control"
    sinks.write_version(G.seed_grants(spark, now, now + timedelta(days=14)), path, 1)
    return path


def test_interleaved_jobs(spark, tmp_path, monkeypatch):
    """A second job runs whole between the reservation and the commit of the first."""
    control, log = control_of(spark, tmp_path), str(tmp_path / "log")
    other = control_of(spark, tmp_path / "other")
    commit = RunLog.commit

    def interrupted(self, own, df):
        monkeypatch.setattr(RunLog, "commit", commit)
        R.reconcile(spark, other, log, 1, "second", NOW)
        commit(self, own, df)

    monkeypatch.setattr(RunLog, "commit", interrupted)
    R.reconcile(spark, control, log, 1, "first", NOW)
    got = RunLog(spark, log).read().select("audit_id", "_run").collect()
    assert sorted(r.audit_id for r in got) == list(range(1, 29))
    assert {r._run for r in got if r.audit_id <= 14} == {"first"}


def test_a_job_that_died_before_its_commit(spark, tmp_path, monkeypatch):
    control, log = control_of(spark, tmp_path), str(tmp_path / "log")

    def dies(self, own, df):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(RunLog, "commit", dies)
        with pytest.raises(OSError):
            R.reconcile(spark, control, log, 1, "a", NOW, diff=True)
    assert RunLog(spark, log).read() is None
    R.reconcile(spark, control_of(spark, tmp_path / "b"), log, 1, "b", NOW)
    R.reconcile(spark, control, log, 1, "a", NOW, diff=True)  # as if b had not run in between
    got = RunLog(spark, log).read().select("audit_id", "_run").collect()
    assert sorted((r.audit_id, r._run) for r in got) == [(i, "a") for i in range(1, 15)] + [
        (i, "b") for i in range(15, 29)]
    with pytest.raises(sinks.VersionConflict):
        R.reconcile(spark, control, log, 1, "c", NOW + timedelta(days=1))


def test_applied_state_is_a_snapshot_plus_the_runs_since(spark, tmp_path):
    control, path = control_of(spark, tmp_path), str(tmp_path / "log")
    log = RunLog(spark, path)
    for version, days in ((1, 0), (2, 1), (3, 15), (4, 16)):
        done = R.reconcile(spark, control, path, version, f"r{version}", NOW + timedelta(days=days), diff=True)
        replay = G.latest_actions(log.read())
        state = R.applied_state(log)
        assert state.exceptAll(replay).isEmpty() and replay.exceptAll(state).isEmpty()
    assert done.actions.count() == 0 and log.read().count() == 20
    assert sinks.latest_version(spark, f"{path}/{R.APPLIED}") == 3
    R.reconcile(spark, control, path, 5, "plain", NOW + timedelta(days=17))  # doesn't write a snapshot
    base, seen = R._known(log)
    assert (base, seen) == (3, [4])
    files = R.applied_state(log).inputFiles()
    assert len({os.path.dirname(f) for f in files}) == 2
    assert sum(f"/{R.APPLIED}/" in f for f in files) and not any("/000000000000-" in f for f in files if "_data/" in f and R.APPLIED not in f)


def test_audit_hourly_reads_the_last_days_only(spark, folder):
    src = ParquetFolder(spark, folder)
    df = registry.queries()["audit_hourly"](spark, folder)
    days = {f.split("_day=")[1][:10] for f in df.inputFiles()}
    known = {p.day for p in registry.event_log(src).pieces()}
    assert days == {d for d in known if d >= "2024-01-19"} and len(known - days) > 10
    assert "PushedFilters: [IsNotNull(action_time), GreaterThanOrEqual(action_time" in plan_text(df)


# Stored layers -------------------------------------------------------------------------------


def test_a_layer_is_written_once_and_half_written_ones_do_not_count(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(6).selectExpr("id", "CAST(id % 2 AS INT) AS k", "'x' AS v")

    def store():
        return LayerStore(spark, "f", str(tmp_path), {"t": ["k"]})

    os.makedirs(f"{store().folder}/t-dead")
    assert not store().has("t")
    one, two = store().layer("t", build), store().layer("t", build)
    assert len(built) == 1 and one.columns == two.columns == ["id", "k", "v"] and two.count() == 6
    assert "PartitionFilters: [isnotnull(k" in plan_text(two.filter("k = 1"))
    other = LayerStore(spark, "g", str(tmp_path))
    assert other.layer("t", build).count() == 6 and len(built) == 2


def test_of_two_builders_the_first_ones_layer_is_used(spark, tmp_path):
    def slow():
        LayerStore(spark, "f", str(tmp_path)).layer("t", lambda: spark.range(1))
        return spark.range(2)

    assert LayerStore(spark, "f", str(tmp_path)).layer("t", slow).count() == 1


def test_the_fingerprint_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    spark.range(3).write.parquet(path)
    one = input_fingerprint(spark, [path])
    assert input_fingerprint(spark, [path]) == one
    spark.range(1).write.mode("append").parquet(path)
    assert input_fingerprint(spark, [path]) != one


def lineitem_reads(plans):
    return sum(plan_text(p).count("lineitem.parquet") for p in plans)


@pytest.mark.parametrize("name, most", [("segment_speed_and_margin", 2), ("margin_by_channel", 1), ("gold_hcp", 3)])
def test_lineitem_is_read_no_more_than_needed(spark, folder, tmp_path, monkeypatch, name, most):
    """The query's own plan and those of all layers that it makes the store build."""
    plans = []
    write = LayerStore._write

    def seen(self, layer, df):
        plans.append(df)
        return write(self, layer, df)

    monkeypatch.setattr(LayerStore, "_write", seen)
    monkeypatch.setattr(registry, "code_fingerprint", lambda: str(tmp_path))
    df = registry.queries()[name](spark, folder)
    built = len(plans)
    assert built and lineitem_reads([*plans, df]) <= most and lineitem_reads([df]) == 0
    again = registry.queries()[name](spark, folder)
    assert len(plans) == built and again.exceptAll(df).isEmpty()
