"""Attribute-based governance: tags, mask and row-filter policies, the governed read.

Tags and policies are metadata: a handful of rows per table, needed while the plan is built. The
governed read is a library transform and not an isolation boundary: whoever holds the raw
DataFrame can read it. Layers are therefore built from raw tables, and :meth:`Governance.secure`
is applied once, where users read. A table that already holds tokens must not carry the key tag,
or its keys would be hashed twice and joins would lose rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.functions.calc import flag
from martkeeper.functions.masks import (
    mask_dob_year,
    mask_last4,
    mask_redact,
    region_row_filter,
    tokenize_key,
)
from martkeeper.sources.tables import local_rows


class GovernanceError(ValueError):
    """A tag, column or policy that does not exist or does not fit."""


@dataclass(frozen=True)
class ColumnTag:
    table: str
    column: str
    key: str
    value: str


@dataclass(frozen=True)
class Policy:
    """A mask or a row filter for every tagged column of the tables of a schema."""

    name: str
    schema: str
    kind: str  # "mask" or "row_filter"
    function: Callable[[Column], Column]
    tag_key: str
    tag_value: str
    exempt: Sequence[str] = ()

    def applies_to(self, caller: Caller) -> bool:
        return not caller.names() & set(self.exempt)


@dataclass(frozen=True)
class Caller:
    user: str
    groups: Sequence[str] = ()

    def names(self) -> set[str]:
        return {self.user, *self.groups}


def parse_principals(text: str) -> list[str]:
    """Comma-separated principals; blanks are dropped, and a blank list exempts no one."""
    return [p.strip() for p in text.split(",") if p.strip()]


@dataclass
class Governance:
    """Taxonomy, column tags and policies."""

    taxonomy: Mapping[str, Sequence[str]]
    tags: list[ColumnTag] = field(default_factory=list)
    policies: dict[str, Policy] = field(default_factory=dict)

    def classify(self, tag: ColumnTag, columns: Iterable[str] | None = None) -> None:
        """Tag a column. Key and value must be in the taxonomy, the column in ``columns``."""
        if tag.value not in self.taxonomy.get(tag.key, ()):
            raise GovernanceError(f"no governed tag {tag.key}={tag.value}")
        if columns is not None and tag.column.lower() not in {c.lower() for c in columns}:
            raise GovernanceError(f"{tag.table} has no column {tag.column}")
        if tag not in self.tags:
            self.tags.append(tag)

    def add_policy(self, policy: Policy) -> None:
        """Add or replace a policy."""
        if policy.kind not in ("mask", "row_filter"):
            raise GovernanceError(f"unknown kind of policy: {policy.kind}")
        if policy.tag_value not in self.taxonomy.get(policy.tag_key, ()):
            raise GovernanceError(f"no governed tag {policy.tag_key}={policy.tag_value}")
        self.policies[policy.name] = policy

    def tagged_columns(self, table: str, key: str, value: str) -> list[str]:
        """Columns of the table that carry the tag; names are compared without case, as in Spark."""
        wanted = (table.lower(), key, value)
        return [t.column for t in self.tags if (t.table.lower(), t.key, t.value) == wanted]

    def row_predicate(self, schema: str, table: str, caller: Caller) -> Column | None:
        """Conjunction of the row filters that apply; an unknown result hides the row."""
        out = None
        for policy, column in self._matches("row_filter", schema, table, caller):
            term = policy.function(F.col(column))
            out = term if out is None else out & term
        return out

    def secure(self, df: DataFrame, schema: str, table: str, caller: Caller) -> DataFrame:
        """What the caller may see: row filters on the raw values first, then the masks."""
        predicate = self.row_predicate(schema, table, caller)
        if predicate is not None:
            df = df.filter(predicate)
        masked: dict[str, Column] = {}
        for policy, column in self._matches("mask", schema, table, caller):
            own = [c for c in df.columns if c.lower() == column.lower()]
            if len(own) != 1:
                raise GovernanceError(f"{table} has {len(own)} columns named {column}")
            if own[0] in masked:
                raise GovernanceError(f"two masks for {table}.{column}")
            mask = policy.function(F.col(own[0]))
            made = df.select(mask.alias("m")).schema["m"].dataType
            if made != df.schema[own[0]].dataType:
                raise GovernanceError(f"{policy.name} turns {table}.{column} into {made.simpleString()}")
            masked[own[0]] = mask
        return df.withColumns(masked) if masked else df

    def blocked_rows(self, df: DataFrame, schema: str, table: str, caller: Caller) -> DataFrame:
        """(total_rows, visible_rows, blocked_rows) in one pass."""
        predicate = self.row_predicate(schema, table, caller)
        visible = F.lit(True) if predicate is None else flag(predicate)
        return df.agg(
            F.count(F.lit(1)).alias("total_rows"), F.count_if(visible).alias("visible_rows")
        ).withColumn("blocked_rows", F.col("total_rows") - F.col("visible_rows"))

    def _matches(
        self, kind: str, schema: str, table: str, caller: Caller
    ) -> list[tuple[Policy, str]]:
        return [
            (p, c)
            for p in self.policies.values()
            if p.kind == kind and p.schema == schema and p.applies_to(caller)
            for c in self.tagged_columns(table, p.tag_key, p.tag_value)
        ]

    def taxonomy_df(self, spark: SparkSession) -> DataFrame:
        rows = [(k, v) for k, values in self.taxonomy.items() for v in values]
        return local_rows(spark, rows, _strings("tag", "value"))

    def tags_df(self, spark: SparkSession) -> DataFrame:
        rows = [(t.table, t.column, t.key, t.value) for t in self.tags]
        return local_rows(spark, rows, _strings("table", "column", "tag", "value"))

    def coverage_gaps(self, spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Columns that are tagged in one table while their namesake elsewhere is not."""
        rows = sorted(
            {
                (name, t.column, t.key, t.value, t.table)
                for t in self.tags
                for name, df in tables.items()
                if t.column.lower() in {c.lower() for c in df.columns}
                and t.column.lower() not in {c.lower() for c in self.tagged_columns(name, t.key, t.value)}
            }
        )
        return local_rows(spark, rows, _strings("table", "column", "tag", "value", "tagged_in"))


def entitled_rows(
    df: DataFrame, column: str, entitlements: DataFrame, principal: str
) -> DataFrame:
    """Row filter by an entitlement table (principal, value) instead of a constant."""
    allowed = entitlements.filter(F.col("principal") == principal).select(
        F.col("value").alias(column)
    )
    return df.join(allowed, column, "left_semi").select(*df.columns)


# The tag taxonomy of the mart.
TAXONOMY = {"pii": ["ssn", "dob", "name", "patient_key"], "access_scope": ["region"]}
DEFAULT_EXEMPT = ("stewards", "admins")
CERTIFIED_SCHEMA = "analytics"
SANDBOX_SCHEMA = "sandbox"


def default_governance(
    exempt: Sequence[str] = DEFAULT_EXEMPT, regions: Sequence[str] = ("US West",)
) -> Governance:
    """The mart's tags and policies: ssn, dob, name and key masks, and the region filter.

    The key is tagged on every table that exposes it, so that masked callers can still join, and
    the key policy also covers the sandbox.
    """
    gov = Governance(TAXONOMY)
    tags = {
        "gold_patients": {
            "ssn": ("pii", "ssn"),
            "region": ("access_scope", "region"),
            "dob": ("pii", "dob"),
            "patient_name": ("pii", "name"),
            "patient_id": ("pii", "patient_key"),
        },
        "gold_claims": {"patient_id": ("pii", "patient_key")},
        "gold_revenue_summary": {"patient_id": ("pii", "patient_key")},
        "patient_payer_segment": {"patient_id": ("pii", "patient_key")},
    }
    for table, columns in tags.items():
        for column, (key, value) in columns.items():
            gov.classify(ColumnTag(table, column, key, value))
    exempt = tuple(exempt)
    masks = {
        "mask_ssn_policy": (mask_last4, "ssn", CERTIFIED_SCHEMA),
        "mask_dob_policy": (mask_dob_year, "dob", CERTIFIED_SCHEMA),
        "mask_name_policy": (mask_redact, "name", CERTIFIED_SCHEMA),
        "mask_patient_key_policy": (tokenize_key, "patient_key", CERTIFIED_SCHEMA),
        "sandbox_patient_key_policy": (tokenize_key, "patient_key", SANDBOX_SCHEMA),
    }
    for name, (function, value, schema) in masks.items():
        gov.add_policy(Policy(name, schema, "mask", function, "pii", value, exempt))
    gov.add_policy(
        Policy(
            "region_row_filter_policy",
            CERTIFIED_SCHEMA,
            "row_filter",
            lambda c: region_row_filter(c, tuple(regions)),
            "access_scope",
            "region",
            exempt,
        )
    )
    return gov


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), False) for n in names])
