"""Declarative column checks: ``{column: {check: {comparator: value, "tolerance": t}}}``.

All checks of a table are computed by ONE aggregation over the table (a
single scan; partial aggregates per task, a one-row result), then unpivoted
into a report with one row per (column, check, comparator)::

    column, check, actual, comparator, expected, tolerance, passed

Checks: ``null_check`` (count of NULLs), ``distinct_check`` (count of distinct
values), ``unique_check`` (non-NULL count minus distinct count), ``min``,
``max``. Comparators: ``equal_to``, ``greater_than``, ``geq_to``,
``less_than``, ``leq_to``. A tolerance ``t`` widens the bound by ``t*|v|``
(0 = exact, 1 = 100 %). With ``accept_none`` an empty result (e.g. MIN of no
rows) counts as 0.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import ConstraintViolation

CHECKS = ("null_check", "distinct_check", "unique_check", "min", "max")
COMPARATORS = ("equal_to", "greater_than", "geq_to", "less_than", "leq_to")


def _aggregate(check: str, column: str) -> Column:
    c = F.col(column)
    if check == "null_check":
        return F.sum(F.when(c.isNull(), 1).otherwise(0))
    if check == "distinct_check":
        return F.count_distinct(c)
    if check == "unique_check":
        return F.count(c) - F.count_distinct(c)
    if check == "min":
        return F.min(c)
    if check == "max":
        return F.max(c)
    raise ValueError(f"unknown check {check!r}; known: {CHECKS}")


def _bounds(comparator: str, expected: float, tolerance: float | None):
    """(low, low_strict, high, high_strict) of the accepted range; None = open.
    The tolerance widens the bound by ``tolerance * |expected|``."""
    slack = abs(expected) * (tolerance or 0.0)
    lo, hi = expected - slack, expected + slack
    if comparator == "equal_to":
        return lo, False, hi, False
    if comparator == "greater_than":
        return lo, True, None, False
    if comparator == "geq_to":
        return lo, False, None, False
    if comparator == "less_than":
        return None, False, hi, True
    if comparator == "leq_to":
        return None, False, hi, False
    raise ValueError(f"unknown comparator {comparator!r}; known: {COMPARATORS}")


def _passed(actual: Column, comparator: str, expected: float, tolerance: float | None) -> Column:
    lo, lo_strict, hi, hi_strict = _bounds(comparator, expected, tolerance)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((actual > F.lit(lo)) if lo_strict else (actual >= F.lit(lo)))
    if hi is not None:
        cond = cond & ((actual < F.lit(hi)) if hi_strict else (actual <= F.lit(hi)))
    return F.coalesce(cond, F.lit(False))


def passes(actual: float | None, comparator: str, expected: float, tolerance: float | None) -> bool:
    """The same test on a value already on the driver (a check result)."""
    if actual is None:
        return False
    lo, lo_strict, hi, hi_strict = _bounds(comparator, expected, tolerance)
    if lo is not None and not (actual > lo if lo_strict else actual >= lo):
        return False
    if hi is not None and not (actual < hi if hi_strict else actual <= hi):
        return False
    return True


def _flatten(mapping: Mapping[str, Mapping[str, Mapping[str, float]]]):
    for column, checks in mapping.items():
        for check, spec in checks.items():
            tolerance = spec.get("tolerance")
            if spec.get("partition_clause") is not None:
                raise ValueError(f"check {column}.{check}: use ``where`` to filter rows, not partition_clause")
            comparators = [k for k in spec if k not in ("tolerance", "partition_clause")]
            if not comparators:
                raise ValueError(f"check {column}.{check} has no comparator")
            for comparator in comparators:
                yield column, check, comparator, float(spec[comparator]), tolerance


def _plan(mapping):
    """(specs, [(alias, aggregate column)]) with each (column, check) computed once."""
    specs = list(_flatten(mapping))
    aliases: dict[tuple[str, str], str] = {}
    aggs = []
    for column, check, _, _, _ in specs:
        if (column, check) not in aliases:
            alias = f"a{len(aliases)}"
            aliases[(column, check)] = alias
            aggs.append((alias, check, _aggregate(check, column).cast("double").alias(alias)))
    return specs, aliases, aggs


def _report(one: DataFrame, specs, aliases, accept_none: bool) -> DataFrame:
    """Unpivot a one-row frame of aggregate values into the report."""
    rows = []
    for column, check, comparator, expected, tolerance in specs:
        actual = F.col(aliases[(column, check)])
        if accept_none:
            actual = F.coalesce(actual, F.lit(0.0))
        rows.append(F.struct(
            F.lit(column).alias("column"), F.lit(check).alias("check"),
            actual.alias("actual"), F.lit(comparator).alias("comparator"),
            F.lit(expected).cast("double").alias("expected"),
            F.lit(tolerance).cast("double").alias("tolerance"),
            _passed(actual, comparator, expected, tolerance).alias("passed")))
    return one.select(F.inline(F.array(*rows)))


def column_checks(df: DataFrame, mapping: Mapping[str, Mapping[str, Mapping[str, float]]],
                  where: str | Column | None = None, accept_none: bool = True) -> DataFrame:
    """Report of every configured check (see module doc)."""
    if where is not None:
        df = df.where(where)
    specs, aliases, aggs = _plan(mapping)
    return _report(df.agg(*[a for _, _, a in aggs]), specs, aliases, accept_none)


class ObservedChecks:
    """Checks computed *while* another action (e.g. the snapshot write) runs.

    ``observe`` attaches the check aggregates to ``df`` as observed metrics,
    so no extra pass over the data is needed. Distinct-count checks cannot be
    observed; they are computed by ``report`` with one aggregation instead.
    """

    def __init__(self, df: DataFrame, mapping, accept_none: bool = True):
        from pyspark.sql import Observation
        self.spark = df.sparkSession
        self.accept_none = accept_none
        self.specs, self.aliases, aggs = _plan(mapping)
        self._source = df
        self._observable = [(a, c) for a, chk, c in aggs if chk not in ("distinct_check", "unique_check")]
        self._deferred = [(a, c) for a, chk, c in aggs if chk in ("distinct_check", "unique_check")]
        self.observation = Observation("cdcmart_checks")
        self.df = df.observe(self.observation, *[c for _, c in self._observable]) if self._observable else df

    def values(self) -> dict[str, float | None]:
        """Aggregate values by alias, after the observed action has run."""
        values = {a: self.observation.get.get(a) for a, _ in self._observable} if self._observable else {}
        if self._deferred:
            row = self._source.agg(*[c for _, c in self._deferred]).first()
            values.update({a: row[a] for a, _ in self._deferred})
        return {a: (None if v is None else float(v)) for a, v in values.items()}

    def failures(self) -> list[tuple[str, str, float | None, str, float]]:
        """Failing checks as (column, check, actual, comparator, expected)."""
        values = self.values()
        out = []
        for column, check, comparator, expected, tolerance in self.specs:
            actual = values[self.aliases[(column, check)]]
            if actual is None and self.accept_none:
                actual = 0.0
            if not passes(actual, comparator, expected, tolerance):
                out.append((column, check, actual, comparator, expected))
        return out

    def report(self) -> DataFrame:
        """The report as a DataFrame, after the observed action has run."""
        from pyspark.sql import types as T
        values = self.values()
        names = list(values)
        schema = T.StructType([T.StructField(a, T.DoubleType()) for a in names])
        one = self.spark.createDataFrame([tuple(values[a] for a in names)], schema)
        return _report(one, self.specs, self.aliases, self.accept_none)


def require_checks(report: DataFrame) -> None:
    """Raise when any row of a check report failed (the report has one row per check)."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise ConstraintViolation("checks failed: " + "; ".join(
            f"{r['column']}.{r['check']} = {r['actual']} not {r['comparator']} {r['expected']}"
            + (f" (tolerance {r['tolerance']})" if r["tolerance"] is not None else "")
            for r in failed))
