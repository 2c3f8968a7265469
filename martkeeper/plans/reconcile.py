"""The grant reconcile job: evaluate, audit, deactivate, in one pass over the grant table.

Jobs may overlap. Each reserves its ids before it writes, its rows count when its commit marker
exists, and a version of the grant table is published by one job only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkeeper.operators import grants as G
from martkeeper.sources import sinks
from martkeeper.sources.runlog import Reservation, RunConflict, RunLog

STAGED, APPLIED = "_staged", "_applied"


@dataclass(frozen=True)
class Reconciled:
    """What a run left behind: the new version of the grants, its actions, the last day's audit."""

    version: int
    actions: DataFrame
    summary: DataFrame


def reconcile(
    spark: SparkSession,
    grants_path: str,
    audit_path: str,
    version: int,
    run_id: str,
    now: datetime | str,
    executed_by: str = G.EXECUTOR,
    diff: bool = False,
) -> Reconciled:
    """Bring version ``version`` of the grant table up to ``now``.

    Valid rows are granted again and expired ones revoked, one audit row each; expired rows are
    marked inactive in version ``version + 1``. With ``diff`` only what differs from the applied
    state is done and logged: the applied state of a grant is its latest action in the log. It is
    kept as a snapshot that each such run advances by the runs since, so the whole log is read only
    by the first one. A log that was seeded with plain rows is taken as it is.

    Repeating a run with the same arguments keeps its ids and what it has committed, so a job that
    failed half-way can simply be started again. Of two runs that start from the same version the
    second raises :class:`~martkeeper.sources.sinks.VersionConflict` and has to be started from the
    version that the first one made.
    """
    grants = sinks.read_version(spark, grants_path, version)
    log = RunLog(spark, audit_path)
    own = log.reservation(run_id)
    base, seen = (own.base, list(own.seen)) if own else _known(log)
    actions = G.grant_actions(grants, now)
    if diff:
        state = applied_state(log, base, seen)
        if state is not None:
            actions = G.not_applied(actions, state)
    staged = f"{log.path}/{STAGED}/{uuid.uuid4().hex}"
    G.count_copies(G.audit_rows(actions, now, executed_by)).write.parquet(staged)
    counted = spark.read.parquet(staged)
    rows = counted.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    if own is None:
        own = log.reserve(run_id, rows, base, tuple(seen))
    elif own.rows != rows:
        raise RunConflict(f"run {run_id!r} reserved {own.rows} ids and has {rows} rows")
    log.commit(own, G.numbered(counted, own.first - 1))
    if diff:
        _advance(log, own)
    sinks.write_version(G.deactivate_expired(grants, now), grants_path, version + 1, owner=run_id)
    summary = hourly_summary(log, now)
    return Reconciled(version + 1, actions, summary)


def hourly_summary(log: RunLog, now: datetime | str) -> DataFrame:
    """Actions per hour over the last day; folders of older rows aren't listed."""
    at = log.spark.sql("SELECT 1").select(F.lit(now).cast("timestamp")).first()[0]
    return G.audit_by_hour(log.read(since=at - timedelta(days=1)), now)


def _snapshot(log: RunLog, upto: int | None = None) -> int | None:
    """The newest snapshot of the applied state, by the run that it includes last."""
    try:
        return sinks.latest_version(log.spark, f"{log.path}/{APPLIED}", upto)
    except ValueError:
        return None


def _known(log: RunLog) -> tuple[int | None, list[int]]:
    """The newest snapshot, and the runs that are committed since."""
    base = _snapshot(log)
    return base, log.committed(-1 if base is None else base)


def applied_state(log: RunLog, base: int | None = None, seen: list[int] | None = None) -> DataFrame | None:
    """The latest action of each grant: a snapshot, advanced by the runs since.

    Without arguments as of now. Without a snapshot plain rows of the log belong to it as well.
    """
    if seen is None:
        base, seen = _known(log)
    if base is None:
        return G.advanced(log.plain(), log.read_runs(seen))
    state = sinks.read_version(log.spark, f"{log.path}/{APPLIED}", base)
    return G.advanced(state, log.read_runs(seen))


def _advance(log: RunLog, own: Reservation) -> None:
    """Publish the state after this run, if all runs before it are committed.

    If one isn't, the next run that finds them complete publishes theirs. The snapshot's name is
    the run's number, and its rows follow from the log, so whoever writes it first is right.
    """
    base = _snapshot(log, own.number)
    if base == own.number:
        return
    start = -1 if base is None else base
    done = [n for n in log.committed(start) if n <= own.number]
    if done == list(range(start + 1, own.number + 1)):
        state = applied_state(log, base, done)
        sinks.write_version(state, f"{log.path}/{APPLIED}", own.number, owner="applied state")
