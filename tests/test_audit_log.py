"""The audit log keeps every row and gives unique ids, whatever the run ids and the seed."""

from datetime import datetime, timedelta

import pytest

from martkeeper.operators import grants as G
from martkeeper.plans.reconcile import reconcile
from martkeeper.sources import sinks

NOW = datetime(2024, 1, 15, 12)


def seeded(spark, folder):
    control, log = f"{folder}/control", f"{folder}/log"
    sinks.write_version(G.seed_grants(spark, NOW, NOW + timedelta(days=14)), control, 1)
    return control, log


def ids(spark, log):
    return [r.audit_id for r in sinks.read_merged(spark, log).select("audit_id").collect()]


@pytest.mark.parametrize("run", ["007", "1e3", "2024-01-01", "", "null", "r7"])
def test_a_repeated_run_replaces_its_rows(spark, tmp_path, run):
    control, log = seeded(spark, tmp_path)
    for _ in range(3):
        reconcile(spark, control, log, 1, run, NOW)
        assert sorted(ids(spark, log)) == list(range(1, 15))
    assert {r[0] for r in sinks.read_merged(spark, log).select(sinks.RUN).collect()} == {run}


def test_seed_two_runs_and_a_late_repeat(spark, tmp_path):
    control, log = seeded(spark, tmp_path)
    sinks.append(G.with_audit_id(G.seed_audit(spark, NOW)), log)
    reconcile(spark, control, log, 1, "a", NOW)
    reconcile(spark, control, log, 2, "b", NOW + timedelta(minutes=15))
    assert sorted(ids(spark, log)) == list(range(1, 31))
    reconcile(spark, control, log, 1, "a", NOW)
    again = ids(spark, log)
    assert len(again) == len(set(again)) == 30


def test_diff_logs_only_what_changes(spark, tmp_path):
    control, log = seeded(spark, tmp_path)
    first = reconcile(spark, control, log, 1, "a", NOW, diff=True)
    assert first.actions.count() == 14
    second = reconcile(spark, control, log, 2, "b", NOW + timedelta(minutes=15), diff=True)
    assert second.actions.count() == 0 and len(ids(spark, log)) == 14
    expired = reconcile(spark, control, log, 3, "c", NOW + timedelta(days=15), diff=True)
    assert {(r.action, r.principal_id) for r in expired.actions.collect()} == {("revoke", "analyst@example.com")}
    assert len(ids(spark, log)) == 20


def test_an_unreadable_log_is_an_error(spark, tmp_path):
    control, log = seeded(spark, tmp_path)
    spark.createDataFrame([(1,)], "other int").write.parquet(log)
    with pytest.raises(Exception, match="audit_id"):
        reconcile(spark, control, log, 1, "a", NOW)


def test_ids_do_not_depend_on_the_groups(spark):
    rows = G.audit_rows(G.grant_actions(G.seed_grants(spark, NOW, NOW + timedelta(days=1)), NOW), NOW)
    few = {tuple(r) for r in G.with_audit_id(rows, rows_per_group=1_000).collect()}
    many = {tuple(r) for r in G.with_audit_id(rows, rows_per_group=1).collect()}
    assert few == many and len(few) == 14
