"""Roll-ups of metric views: the state of their measures at one grouping, asked at any coarser one.

A state is what can be added to another state of the same measure: sums for SUM, counts for COUNT, both
for AVG, extremes for MIN and MAX, and a HyperLogLog sketch for COUNT(DISTINCT ...). Sums,
counts and extremes give the measure exactly. A distinct count can't be derived from finer counts;
its sketches can be united, and estimate it to about 1.04 / sqrt(2^lg_k) of its value (one standard
error). That is why a roll-up has to be asked for: :meth:`MetricCatalog.query` stays exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeeper.operators.metrics import MetricCatalog, MetricError, Where

LG_K = 12
# Standard errors that an estimate may be off by before it counts as wrong.
ERRORS = 4

CALL = re.compile(r"\b(COUNT|SUM|AVG|MIN|MAX)\s*\(\s*(DISTINCT\s+)?((?:[^()]|\([^()]*\))*)\)", re.IGNORECASE)
AGGREGATE = re.compile(r"\b(COUNT|SUM|AVG|MIN|MAX|ANY_VALUE|STDDEV\w*|VAR\w*|PERCENTILE\w*|MEDIAN|MODE)\s*\(", re.I)


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate, as a share of the count."""
    return 1.04 / math.sqrt(2**lg_k)


def within_bound(estimate: Column | str, exact: Column | str, lg_k: int = LG_K) -> Column:
    """Whether an estimate is as near to the exact count as its sketch promises."""
    estimate, exact = (F.col(c) if isinstance(c, str) else c for c in (estimate, exact))
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * ERRORS * relative_error(lg_k))


def sketch(column: Column | str, lg_k: int = LG_K) -> Column:
    """The sketch of a column's distinct values; NULL isn't one."""
    column = F.col(column) if isinstance(column, str) else column
    return F.hll_sketch_agg(column.cast("string"), lg_k)


def united(sketches: Column | str) -> Column:
    """The estimated distinct count of a group of sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketches))


def distinct_rollup(
    facts: DataFrame, dims: Sequence[str], counted: Mapping[str, str], lg_k: int = LG_K
) -> DataFrame:
    """Sketches per grouping, to be united at coarser ones. One pass, combined on the map side."""
    return facts.groupBy(*dims).agg(*[sketch(c, lg_k).alias(out) for out, c in counted.items()])


@dataclass(frozen=True)
class _State:
    """The aggregates that are kept for a call, and the call over their columns."""

    kept: Mapping[str, str]
    merged: str


def _state(call: re.Match, names: Callable[[str], str], lg_k: int) -> _State:
    function, distinct, argument = call[1].upper(), call[2], call[3].strip()
    if distinct:
        if function != "COUNT":
            raise MetricError(f"{call[0]} has no state that could be merged")
        kept = f"HLL_SKETCH_AGG(CAST({argument} AS STRING), {lg_k})"
        return _State({names(kept): kept}, f"HLL_SKETCH_ESTIMATE(HLL_UNION_AGG({names(kept)}))")
    if function == "AVG":
        total, count = f"SUM({argument})", f"COUNT({argument})"
        return _State(
            {names(total): total, names(count): count},
            f"TRY_DIVIDE(SUM({names(total)}), SUM({names(count)}))",
        )
    kept = f"{function}({argument})"
    again = "SUM" if function == "COUNT" else function
    return _State({names(kept): kept}, f"{again}({names(kept)})")


@dataclass(frozen=True)
class MetricRollup:
    """States of measures at ``dims``: a table, and how each measure is put together from it."""

    view: str
    dims: Sequence[str]
    states: DataFrame
    merged: Mapping[str, str]
    types: Mapping[str, str]

    def query(
        self, measures: Sequence[str], dims: Sequence[str] = (), where: Mapping[str, object] | None = None
    ) -> DataFrame:
        """Measures at a grouping of some of the kept dimensions; ``where`` names kept ones too."""
        for what, asked, known in (("measure", measures, self.merged), ("dimension", dims, self.dims),
                                   ("dimension", where or {}, self.dims)):
            unknown = [a for a in asked if a not in known]
            if unknown:
                raise MetricError(f"the roll-up of {self.view} keeps no {what} {unknown}")
        rows = self.states
        place = {d: F.col(f"_d{i}") for i, d in enumerate(self.dims)}
        for d, wanted in (where or {}).items():
            many = isinstance(wanted, (list, tuple, set))
            rows = rows.filter(place[d].isin(list(wanted)) if many else place[d] == F.lit(wanted))
        out = [F.expr(self.merged[m]).cast(self.types[m]).alias(m) for m in measures]
        return rows.groupBy(*[place[d].alias(d) for d in dims]).agg(*out)


def roll_up(
    catalog: MetricCatalog,
    name: str,
    dims: Sequence[str],
    measures: Sequence[str] | None = None,
    where: Where | None = None,
    lg_k: int = LG_K,
    store: Callable[[DataFrame], DataFrame] | None = None,
) -> MetricRollup:
    """Keep the states of a view's measures at a grouping; ``store`` writes them somewhere.

    One pass over the view's rows. A measure may combine several aggregates; one without a state
    that could be merged is refused.
    """
    view = catalog.view(name)
    measures = list(view.measures) if measures is None else list(measures)
    kept: dict[str, str] = {}

    def column(aggregate: str) -> str:
        return kept.setdefault(re.sub(r"\s+", " ", aggregate), f"_s{len(kept)}")

    needed: dict[str, str] = {}
    merged: dict[str, str] = {}
    for m in measures:

        def replaced(call: re.Match) -> str:
            state = _state(call, column, lg_k)
            needed.update(state.kept)
            return state.merged

        text = view.measures[m] if m in view.measures else None
        if text is None:
            raise MetricError(f"{name}: unknown measure {m}")
        rest = CALL.sub("", text)
        if AGGREGATE.search(rest):
            raise MetricError(f"{m} has no state that could be merged: {text}")
        merged[m] = CALL.sub(replaced, text)
    exact = catalog.query(name, measures, dims, where)
    rows = catalog.rows(name, measures, dims, where)
    keys = [F.expr(view.dimensions[d]).alias(f"_d{i}") for i, d in enumerate(dims)]
    states = rows.groupBy(*keys).agg(*[F.expr(e).alias(c) for c, e in needed.items()])
    types = {f.name: f.dataType.simpleString() for f in exact.schema if f.name in merged}
    return MetricRollup(name, tuple(dims), store(states) if store else states, merged, types)
