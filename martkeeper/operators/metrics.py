"""Metric views: declared filter, joins, dimensions and measures, evaluated at any grouping.

A measure is an aggregate expression that is evaluated at the grouping of the question. Averages
and distinct counts are never derived from a finer result, because they are not additive.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeeper.sources.tables import TableRegistry

Where = str | Mapping[str, object] | Callable[[Mapping[str, Column]], Column]


class MetricError(ValueError):
    """A question that the view or the surface does not allow."""


@dataclass(frozen=True)
class Join:
    """Many-to-one join of the source to another table, usable as ``name.column``.

    ``on`` is written as ``source.k = name.k``. The join is a left join to one row per key, so the
    source's rows decide the measures, and a question that names none of its columns skips it.
    """

    name: str
    source: str
    on: str


@dataclass(frozen=True)
class MetricView:
    """A named semantic definition over a table of the registry."""

    name: str
    source: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    filter: str | None = None
    joins: Sequence[Join] = ()
    comment: str = ""

    def sources(self) -> list[str]:
        return [self.source, *(j.source for j in self.joins)]


@dataclass
class MetricCatalog:
    """Metric views over a registry of tables."""

    tables: TableRegistry
    views: dict[str, MetricView] = field(default_factory=dict)

    def define(self, view: MetricView) -> MetricView:
        """Define or replace a view. It is certified when all its sources are."""
        for source in view.sources():
            self.tables.is_certified(source)
        self.views[view.name] = view
        self.tables.put(
            view.name,
            lambda: self._rows(view),
            certified=all(self.tables.is_certified(s) for s in view.sources()),
            kind="METRIC_VIEW",
        )
        return view

    def view(self, name: str) -> MetricView:
        if name not in self.views:
            raise MetricError(f"unknown metric view: {name}")
        return self.views[name]

    def is_certified(self, name: str) -> bool:
        """Certification of the sources as they are now, not as they were at definition."""
        return all(self.tables.is_certified(s) for s in self.view(name).sources())

    def query(
        self,
        name: str,
        measures: Sequence[str],
        dims: Sequence[str] = (),
        where: Where | None = None,
        order_by: Sequence[str | int | Column] | None = None,
        limit: int | None = None,
        post: Mapping[str, Column | str] | None = None,
        with_notice: bool = False,
    ) -> DataFrame:
        """Dimensions and measures of a view, grouped by all the dimensions asked for.

        ``where`` is about dimension names: a mapping of name to value or list of values, a
        function from the mapping of dimension columns to a predicate, or a SQL predicate.
        ``post`` replaces or adds output columns computed from the measures. ``with_notice`` adds
        ``_uncertified``. ``order_by`` takes names, expressions, or numbers of output columns from
        1 on, negative ones for descending order.
        """
        view = self.view(name)
        rows = self.rows(name, measures, dims, where)
        # Grouped under internal names: a dimension often differs from a source column by case
        # only, which would make the measures ambiguous.
        keys = [F.expr(view.dimensions[d]).alias(f"_d{i}") for i, d in enumerate(dims)]
        aggs = [F.expr(view.measures[m]).alias(f"_m{i}") for i, m in enumerate(measures)]
        out = rows.groupBy(*keys).agg(*aggs).select(
            *[F.col(f"_d{i}").alias(d) for i, d in enumerate(dims)],
            *[F.col(f"_m{i}").alias(m) for i, m in enumerate(measures)],
        )
        if post:
            out = out.withColumns({c: F.expr(e) if isinstance(e, str) else e for c, e in post.items()})
        if with_notice:
            out = out.withColumn("_uncertified", F.lit(not self.is_certified(name)))
        if order_by:
            out = out.orderBy(*order_by)
        return out.limit(limit) if limit is not None else out

    def rows(
        self,
        name: str,
        measures: Sequence[str],
        dims: Sequence[str] = (),
        where: Where | None = None,
    ) -> DataFrame:
        """The rows that a question aggregates: joined as far as it needs, and filtered."""
        view = self.view(name)
        _known(view.name, "measure", measures, view.measures)
        _known(view.name, "dimension", dims, view.dimensions)
        if not measures:
            raise MetricError(f"{view.name}: at least one measure is needed")
        rows = self._rows(view, _used_joins(view, measures, dims, where))
        return rows if where is None else _apply_where(view, rows, where)

    def join_check(self, name: str) -> DataFrame:
        """(join, keys, duplicate_keys) per declared join; a duplicate key inflates measures."""
        out = None
        for j in self.view(name).joins:
            keys = re.findall(rf"\b{re.escape(j.name)}\.(\w+)", j.on)
            checked = (
                self.tables.get(j.source)
                .groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("n"))
                .agg(
                    F.count(F.lit(1)).alias("keys"),
                    F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                )
                .select(F.lit(j.name).alias("join"), "keys", "duplicate_keys")
            )
            out = checked if out is None else out.unionByName(checked)
        if out is None:
            raise MetricError(f"{name} declares no join")
        return out

    def _rows(self, view: MetricView, joins: Sequence[Join] | None = None) -> DataFrame:
        """Source rows after the declared filter and joins.

        A joined table is packed into a struct named after the join, so ``name.column`` resolves
        and an unqualified column is always the source's. Catalyst reads only the fields used.
        """
        rows = self.tables.get(view.source).alias("source")
        if view.filter:
            rows = rows.filter(view.filter)
        for j in view.joins if joins is None else joins:
            packed = self.tables.get(j.source).select(F.struct("*").alias(j.name))
            rows = rows.join(packed, F.expr(j.on), "left")
        return rows


@dataclass(frozen=True)
class Surface:
    """What a group of users may ask: listed views, minus excluded dimensions.

    ``allow_uncertified`` names the views that may rest on uncertified tables; their results carry
    the notice column.
    """

    name: str
    views: Sequence[str]
    excluded: Mapping[str, Sequence[str]] = field(default_factory=dict)
    allow_uncertified: Sequence[str] = ()

    def dimensions(self, catalog: MetricCatalog, name: str) -> list[str]:
        """The dimensions of a view that the surface offers."""
        return [d for d in catalog.view(name).dimensions if d not in self.excluded.get(name, ())]

    def query(
        self,
        catalog: MetricCatalog,
        name: str,
        measures: Sequence[str],
        dims: Sequence[str] = (),
        where: Where | None = None,
        **options: object,
    ) -> DataFrame:
        """As :meth:`MetricCatalog.query`, within the surface."""
        if name not in (*self.views, *self.allow_uncertified):
            raise MetricError(f"{name} is not on the surface {self.name}")
        certified = catalog.is_certified(name)
        if not certified and name not in self.allow_uncertified:
            raise MetricError(f"{name} rests on uncertified tables")
        hidden = set(self.excluded.get(name, ()))
        refused = hidden & set(dims)
        if refused:
            raise MetricError(f"{name}: excluded from {self.name}: {sorted(refused)}")
        if hidden and isinstance(where, Mapping) and hidden & set(where):
            raise MetricError(f"{name}: excluded from {self.name}: {sorted(hidden & set(where))}")
        if hidden and where is not None and not isinstance(where, Mapping):
            raise MetricError(f"{name} has excluded dimensions; give the filter as a mapping")
        options.setdefault("with_notice", not certified)
        return catalog.query(name, measures, dims, where, **options)


def _known(view: str, what: str, asked: Sequence[str], declared: Mapping[str, str]) -> None:
    unknown = [a for a in asked if a not in declared]
    if unknown:
        raise MetricError(f"{view}: unknown {what} {unknown}")


def _used_joins(
    view: MetricView, measures: Sequence[str], dims: Sequence[str], where: Where | None
) -> list[Join]:
    """Joins whose name occurs in an expression of the question."""
    if where is not None and not isinstance(where, Mapping):
        return list(view.joins)
    texts = [view.measures[m] for m in measures] + [view.dimensions[d] for d in dims]
    texts += [view.dimensions[d] for d in where or {} if d in view.dimensions]
    texts.append(view.filter or "")
    used: list[Join] = []
    for j in reversed(view.joins):
        if any(re.search(rf"\b{re.escape(j.name)}\b\s*`?\.", t) for t in texts):
            used.insert(0, j)
            texts.append(j.on)
    return used


def _apply_where(view: MetricView, rows: DataFrame, where: Where) -> DataFrame:
    if isinstance(where, Mapping):
        _known(view.name, "dimension", list(where), view.dimensions)
        for name, wanted in where.items():
            dim = F.expr(view.dimensions[name])
            many = isinstance(wanted, (list, tuple, set))
            rows = rows.filter(dim.isin(list(wanted)) if many else dim == F.lit(wanted))
        return rows
    if callable(where):
        return rows.filter(where({d: F.expr(e) for d, e in view.dimensions.items()}))
    return _where_text(view, rows, where)


def _where_text(view: MetricView, rows: DataFrame, where: str) -> DataFrame:
    """SQL predicate over dimension names.

    Dimensions become columns beside the source's. A dimension that bears the name of a source
    column and stands for that column is already there; one that stands for something else would
    be ambiguous.
    """
    present = {c.lower() for c in rows.columns}
    added = {}
    for name, e in view.dimensions.items():
        if name.lower() not in present:
            added[name] = F.expr(e)
        elif name.lower() != e.lower():
            raise MetricError(f"{view.name}: give the filter on {name} as a mapping")
    return rows.select("*", *[e.alias(n) for n, e in added.items()]).filter(where)
