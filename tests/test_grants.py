from datetime import datetime, timedelta

from pyspark.sql import functions as F

from martkeeper.operators import grants as G
from martkeeper.plans.reconcile import reconcile
from martkeeper.sources import sinks

NOW = datetime(2024, 1, 15, 12, 0, 0)
TICK = timedelta(microseconds=1)


def edge_grants(spark):
    def row(who, kind, name, until, active=True):
        return (who, "user", kind, name, "SELECT", until, "o", NOW, "o", active)

    return spark.createDataFrame(
        [
            row("never", "TABLE", "t", None),
            row("at", "TABLE", "t", NOW),
            row("before", "TABLE", "t", NOW - TICK),
            row("after", "TABLE", "t", NOW + TICK),
            row("off", "TABLE", "t", NOW + TICK, False),
            row("twin", "SCHEMA", "same", NOW - TICK),
            row("twin", "TABLE", "same", None),
        ],
        G.GRANT_SCHEMA,
    )


def test_validity_at_the_instant(spark):
    grants = edge_grants(spark)
    active = {r.principal_id: r.grant_count for r in G.active_grants(grants, NOW).collect()}
    assert active == {"never": 1, "after": 1, "twin": 1}
    assert tuple(G.grant_counts(grants, NOW).first()) == (6, 1, 3, 3)


def test_actions_and_statements(spark):
    actions = {
        (r.action, r.principal_id, r.securable_type): r.statement
        for r in G.grant_actions(edge_grants(spark), NOW).collect()
    }
    assert len(actions) == 6
    assert actions[("grant", "never", "TABLE")] == "GRANT SELECT ON TABLE t TO user 'never'"
    assert actions[("revoke", "twin", "SCHEMA")] == "REVOKE SELECT ON SCHEMA same FROM user 'twin'"
    assert ("grant", "twin", "TABLE") in actions


def test_sweep_uses_the_whole_key_and_is_idempotent(spark):
    once = G.deactivate_expired(edge_grants(spark), NOW)
    twin = {r.securable_type: r._active for r in once.filter("principal_id = 'twin'").collect()}
    assert twin == {"SCHEMA": False, "TABLE": True}
    again = G.deactivate_expired(once, NOW)
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    assert G.grant_actions(once, NOW).filter("action = 'revoke'").count() == 0


def test_audit_ids_are_dense_also_for_copies(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("a"),
        F.lit(None).cast("string").alias("b"),
    )
    numbered = G.with_audit_id(rows, 41)
    ids = sorted(r.audit_id for r in numbered.collect())
    assert ids == list(range(42, 942))
    back = numbered.groupBy("a").count().filter("a = 'same'").first()
    assert back["count"] == 300
    one, two = G.with_audit_id(rows), G.with_audit_id(rows.repartition(7))
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)


def test_copies_are_written_in_steps(spark, monkeypatch):
    monkeypatch.setattr(G, "COPIES_PER_STEP", 7)
    rows = spark.range(50).select(F.lit("x").alias("a"))
    assert sorted(r.audit_id for r in G.with_audit_id(rows).collect()) == list(range(1, 51))


def test_cycle_writes_new_version_and_replaces_its_own_audit(spark, tmp_path):
    control, log = str(tmp_path / "access_control"), str(tmp_path / "audit")
    sinks.write_version(edge_grants(spark), control, 1)
    for _ in range(2):  # the second pass repeats the run
        done = reconcile(spark, control, log, 1, "run-1", NOW)
    assert done.version == sinks.latest_version(spark, control) == 2
    assert sinks.read_version(spark, control).filter("_active").count() == 3
    audit = sinks.read_merged(spark, log)
    assert sorted(r.audit_id for r in audit.collect()) == list(range(1, 7))
    by_action = {r.action: r.actions for r in done.summary.collect()}
    assert by_action == {"grant": 3, "revoke": 3}
    later = reconcile(spark, control, log, 2, "run-2", NOW + timedelta(minutes=15))
    assert later.version == 3
    everything = sinks.read_merged(spark, log)
    assert sorted(r.audit_id for r in everything.collect()) == list(range(1, 10))
    again = reconcile(spark, control, log, 1, "run-1", NOW)  # a late repeat of the first run
    assert again.version == 2
    everything = sinks.read_merged(spark, log)
    ids = [r.audit_id for r in everything.collect()]
    assert len(ids) == len(set(ids)) == 9
    highest = spark.range(1).select(G.highest_audit_id(everything).alias("m")).first().m
    assert highest == max(ids)


def test_audit_by_hour(spark):
    times = [NOW, NOW - timedelta(minutes=59), NOW - timedelta(hours=24), NOW - timedelta(hours=24) - TICK]
    log = spark.createDataFrame([(t, "grant") for t in times] + [(NOW, "expire")],
                                "action_time timestamp, action string")
    got = [tuple(r) for r in G.audit_by_hour(log, NOW).collect()]
    assert got == [
        (datetime(2024, 1, 15, 12), "expire", 1), (datetime(2024, 1, 15, 12), "grant", 1),
        (datetime(2024, 1, 15, 11), "grant", 1), (datetime(2024, 1, 14, 12), "grant", 1)]


def test_seeded_grants(spark):
    grants = G.seed_grants(spark, NOW, NOW + timedelta(days=14))
    count = {r.principal_id: r.grant_count for r in G.active_grants(grants, NOW).collect()}
    assert count == {"analyst@example.com": 6, "steward@example.com": 8}
    later = {r.principal_id: r.grant_count
             for r in G.active_grants(grants, NOW + timedelta(days=14)).collect()}
    assert later == {"steward@example.com": 8}
    audit = G.with_audit_id(G.seed_audit(spark, NOW))
    assert audit.columns == G.AUDIT_SCHEMA.names and audit.count() == 2
