"""Policy-as-code grants: evaluation, expiry sweep, action rows, audit log.

A grant is valid while it is active and its expiry is unknown or in the future; at the expiry
itself it has expired. ``now`` is a parameter of every operator, so one run sees one instant and
a repeated run gives the same rows. The sweep is one pass over the table, with no row loop.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.sources.tables import local_rows

KEY = ["principal_id", "principal_type", "securable_type", "securable_name", "privilege"]

# The columns of the grant table and of the audit log.
GRANT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in KEY]
    + [
        T.StructField("expires_at", T.TimestampType(), True),
        T.StructField("created_by", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("granted_by", T.StringType(), False),
        T.StructField("_active", T.BooleanType(), False),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_id", T.LongType(), False),
        T.StructField("action_time", T.TimestampType(), False),
        T.StructField("action", T.StringType(), True),
    ]
    + [T.StructField(c, T.StringType(), False) for c in KEY]
    + [
        T.StructField("reason", T.StringType(), True),
        T.StructField("executed_by", T.StringType(), True),
    ]
)

# The texts of the audit rows.
GRANT_REASON = "Idempotent apply cycle"
REVOKE_REASON = "Access expired"
EXECUTOR = "apply_access_control_job"


def _instant(now: datetime | str | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def is_valid(now: datetime | str | Column) -> Column:
    return F.col("_active") & (
        F.col("expires_at").isNull() | (F.col("expires_at") > _instant(now))
    )


def is_expired(now: datetime | str | Column) -> Column:
    """Still marked active although the expiry has passed: what the sweep has to revoke."""
    return F.col("_active") & (F.col("expires_at") <= _instant(now))


def active_grants(grants: DataFrame, now: datetime | str | Column) -> DataFrame:
    """Valid grants per principal."""
    return (
        grants.filter(is_valid(now))
        .groupBy("principal_id")
        .agg(F.count(F.lit(1)).alias("grant_count"))
    )


def grant_counts(grants: DataFrame, now: datetime | str | Column) -> DataFrame:
    """Rows by mark and by time, in one pass: the two differ until the sweep has run."""
    return grants.agg(
        F.count_if(F.col("_active")).alias("active_rows"),
        F.count_if(~F.col("_active")).alias("inactive_rows"),
        F.count_if(is_valid(now)).alias("valid_rows"),
        F.count_if(is_expired(now)).alias("to_revoke_rows"),
    )


def grant_actions(grants: DataFrame, now: datetime | str | Column) -> DataFrame:
    """One row per statement of a reconcile cycle: grants for valid rows, revokes for expired.

    The statements are rendered, not executed.
    """
    action = F.when(is_valid(now), "grant").when(is_expired(now), "revoke")
    granted = F.format_string(
        "GRANT %s ON %s %s TO %s '%s'",
        "privilege", "securable_type", "securable_name", "principal_type", "principal_id",
    )
    revoked = F.format_string(
        "REVOKE %s ON %s %s FROM %s '%s'",
        "privilege", "securable_type", "securable_name", "principal_type", "principal_id",
    )
    is_grant = F.col("action") == "grant"
    return grants.select(*KEY, action.alias("action")).filter("action IS NOT NULL").select(
        "action",
        *KEY,
        F.when(is_grant, granted).otherwise(revoked).alias("statement"),
        F.when(is_grant, GRANT_REASON).otherwise(REVOKE_REASON).alias("reason"),
    )


def deactivate_expired(grants: DataFrame, now: datetime | str | Column) -> DataFrame:
    """The grant table with expired rows marked inactive, to be written as a new version."""
    return grants.withColumn(
        "_active", F.when(is_expired(now), F.lit(False)).otherwise(F.col("_active"))
    )


def audit_rows(
    actions: DataFrame, now: datetime | str | Column, executed_by: str = EXECUTOR
) -> DataFrame:
    """Audit rows without their id."""
    return actions.select(
        _instant(now).alias("action_time"),
        "action",
        *KEY,
        "reason",
        F.lit(executed_by).alias("executed_by"),
    )


STATE = [*KEY, "action", "action_time", "audit_id"]


def latest_actions(log: DataFrame) -> DataFrame:
    """The applied state: the latest action per grant, by time and then by id."""
    newest = F.max_by(F.struct("action", "action_time", "audit_id"), F.struct("action_time", "audit_id"))
    return log.groupBy(*KEY).agg(newest.alias("newest")).select(*KEY, "newest.*")


def advanced(state: DataFrame | None, delta: DataFrame | None) -> DataFrame | None:
    """The applied state after the rows of ``delta``, without a look at older rows."""
    rows = [d.select(*STATE) for d in (state, delta) if d is not None]
    if not rows:
        return None
    return latest_actions(rows[0] if len(rows) == 1 else rows[0].union(rows[1]))


def not_applied(actions: DataFrame, log: DataFrame) -> DataFrame:
    """The actions that differ from the latest action of the same grant in a log or a state."""
    latest = latest_actions(log).select(*KEY, "action")
    return actions.join(latest, [*KEY, "action"], "left_anti").select(*actions.columns)


COPIES_PER_STEP = 100_000
ROWS_PER_GROUP = 100_000


def count_copies(rows: DataFrame) -> DataFrame:
    """Equal rows once, with ``_copies``: any number of copies is one row in a shuffle."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))


def with_audit_id(
    rows: DataFrame,
    after: int | Column = 0,
    rows_per_group: int = ROWS_PER_GROUP,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Number rows ``after + 1`` onward, in an order given by the rows alone.

    Equal rows are counted first. ``stage`` may write the counted rows somewhere and read them back;
    they are used three times, for their number, for the offsets and for the ids. Distinct rows
    are placed within even groups (the first hexadecimal digits of a digest of the row name the
    group), as many digits as it takes for ``rows_per_group`` rows, and the groups' offsets are a
    running sum of their counts. Copies are then written out again in steps of bounded size. No
    task holds more than a group. The ids follow the digests, whatever the number of groups.
    """
    counted = count_copies(rows)
    return numbered(stage(counted) if stage else counted, after, rows_per_group)


def numbered(
    counted: DataFrame, after: int | Column = 0, rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """:func:`with_audit_id` of rows that are counted already."""
    columns = [c for c in counted.columns if c != "_copies"]
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digits = _digits(counted, rows_per_group)
    counted = counted.withColumn("_digest", F.md5(F.concat_ws("|", *parts))).withColumn(
        "_group", F.substring("_digest", F.lit(1), digits)
    )
    per_group = counted.groupBy("_group").agg(F.sum("_copies").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_group")) - F.col("_n")
    offsets = per_group.select("_group", earlier.alias("_offset"))
    within = Window.partitionBy("_group").orderBy("_digest", *columns)
    before = F.sum("_copies").over(within) - F.col("_copies")
    steps = F.sequence(
        F.lit(0), F.floor((F.col("_copies") - 1) / COPIES_PER_STEP).cast("bigint")
    )
    placed = (
        counted.withColumn("_before", before)
        .join(offsets, "_group")
        .withColumn("_step", F.explode(steps))
    )
    first = F.col("_step") * COPIES_PER_STEP
    last = F.least(F.col("_copies"), first + COPIES_PER_STEP) - 1
    after = F.lit(after) if isinstance(after, int) else after
    return placed.withColumn("_copy", F.explode(F.sequence(first, last))).select(
        (after + F.col("_offset") + F.col("_before") + F.col("_copy") + 1)
        .cast("bigint")
        .alias("audit_id"),
        *columns,
    )


def _digits(counted: DataFrame, rows_per_group: int) -> Column:
    """Hexadecimal digits that make groups of about so many distinct rows, from their number."""
    share = counted.agg(F.count(F.lit(1)).alias("n")).scalar() / F.lit(rows_per_group)
    return F.greatest(F.ceil(F.log(16.0, F.greatest(share, F.lit(1.0)))), F.lit(1)).cast("int")


def highest_audit_id(audit: DataFrame) -> Column:
    """The highest id so far as a scalar subquery, 0 for an empty log."""
    return audit.agg(F.coalesce(F.max("audit_id"), F.lit(0)).alias("m")).scalar()


def audit_by_hour(audit: DataFrame, now: datetime | str | Column) -> DataFrame:
    """Actions per hour and kind over the last day before ``now``, newest hour first."""
    recent = F.col("action_time") >= _instant(now) - F.expr("INTERVAL 1 DAY")
    return (
        audit.filter(recent)
        .groupBy(F.date_trunc("hour", F.col("action_time")).alias("action_hour"), "action")
        .agg(F.count(F.lit(1)).alias("actions"))
        .orderBy(F.desc("action_hour"), F.asc("action"))
    )


# What the two seed tables below contain.
def seed_grants(
    spark: SparkSession,
    now: datetime,
    expires: datetime,
    schema: str = "main.analytics",
    governance: str = "main.governance",
    owner: str = "facilitator@example.com",
) -> DataFrame:
    """The initial grants: an analyst with 6 that expire, a steward with 8 that do not."""
    analyst, steward = "analyst@example.com", "steward@example.com"
    views = [
        "mv_revenue_by_channel",
        "mv_fulfillment_rate",
        "mv_recognized_revenue",
        "mv_recurring_revenue",
        "mv_gross_margin",
    ]
    gold = ["gold_patients", "gold_claims", "gold_revenue_summary"]
    control = f"{governance}.access_control"
    wanted = [(analyst, "SCHEMA", schema, "USE_SCHEMA", expires)]
    wanted += [(analyst, "VIEW", f"{schema}.{v}", "SELECT", expires) for v in views]
    wanted += [(steward, "SCHEMA", schema, "USE_SCHEMA", None)]
    wanted += [(steward, "TABLE", f"{schema}.{t}", "SELECT", None) for t in gold]
    wanted += [
        (steward, "SCHEMA", governance, "USE_SCHEMA", None),
        (steward, "TABLE", control, "SELECT", None),
        (steward, "TABLE", control, "MODIFY", None),
        (steward, "TABLE", f"{control}_audit", "SELECT", None),
    ]
    rows = [
        (who, "user", kind, name, privilege, until, owner, now, owner, True)
        for who, kind, name, privilege, until in wanted
    ]
    return local_rows(spark, rows, GRANT_SCHEMA)


def seed_audit(
    spark: SparkSession,
    now: datetime,
    schema: str = "main.analytics",
    governance: str = "main.governance",
) -> DataFrame:
    """Audit rows of the initial set-up, without ids."""
    rows = [
        (now, "grant", "analyst@example.com", "user", "SCHEMA", schema, "USE_SCHEMA",
         "Foundation: initial sandbox setup", "foundation_job"),
        (now, "grant", "steward@example.com", "user", "SCHEMA", governance, "USE_SCHEMA",
         "Foundation: initial governance setup", "foundation_job"),
    ]
    return local_rows(spark, rows, T.StructType(AUDIT_SCHEMA.fields[1:]))
