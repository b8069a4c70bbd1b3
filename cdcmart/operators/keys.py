"""Key and length constraints, checked rather than enforced.

Spark's file tables do not enforce PRIMARY KEY, NOT NULL or VARCHAR limits,
so they are expressed as queries that return the violations. Both are one
aggregation (partial aggregation before the shuffle, so a hot key reaches the
reducer as one row per map task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(ValueError):
    """A key, length or quality constraint does not hold."""


def key_violations(df: DataFrame, keys: Sequence[str], allow_null: bool = False) -> DataFrame:
    """Rows ``(keys..., n, reason)``: duplicate keys and, unless ``allow_null``,
    keys with a NULL part (``reason`` = ``duplicate`` / ``null_key``).

    With ``allow_null`` (a UNIQUE constraint) a key with a NULL part never
    collides with another.
    """
    keys = list(keys)
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    reason = (F.when(has_null, F.lit(None if allow_null else "null_key"))
               .when(F.col("n") > 1, F.lit("duplicate")))
    return (grouped.select(*keys, F.col("n").cast("bigint").alias("n"), reason.alias("reason"))
                   .where(F.col("reason").isNotNull()))


def require_key(df: DataFrame, keys: Sequence[str], allow_null: bool = False) -> None:
    """Raise ``ConstraintViolation`` when ``keys`` is not a key of ``df``.

    Brings at most a handful of violating rows to the driver for the message.
    """
    sample = key_violations(df, keys, allow_null).limit(5).collect()
    if sample:
        shown = ", ".join(str(tuple(r[k] for k in keys)) + f" x{r['n']} ({r['reason']})" for r in sample)
        raise ConstraintViolation(f"key {tuple(keys)} violated: {shown}")


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per limited column: ``column, max_length, limit_length, violations``.

    One pass; ``violations`` counts values longer than the limit
    (characters, as VARCHAR(n) counts them).
    """
    aggs = []
    for c, n in limits.items():
        aggs.append(F.max(F.length(F.col(c))).alias(f"m_{c}"))
        aggs.append(F.count(F.when(F.length(F.col(c)) > n, 1)).alias(f"v_{c}"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"),
                              F.col(f"m_{c}").cast("bigint").alias("max_length"),
                              F.lit(n).cast("bigint").alias("limit_length"),
                              F.col(f"v_{c}").cast("bigint").alias("violations"))
                     for c, n in limits.items()])
    return one.select(F.inline(rows))


class ObservedConstraints:
    """Keys without NULL parts and text lengths, checked *while* an action
    (the snapshot write) runs: no pass of its own. Uniqueness cannot be
    observed; the merge checks it on the changes and the new keys."""

    def __init__(self, df: DataFrame, keys: Sequence[str], limits: Mapping[str, int]):
        from pyspark.sql import Observation
        self.limits = {c: n for c, n in limits.items() if c in df.columns}
        self.keys = list(keys)
        self.observation = Observation("cdcmart_constraints")
        self.df = df.observe(self.observation, *[F.count(F.when(F.col(k).isNull(), 1)).alias(f"null_{k}") for k in self.keys],
                             *[F.count(F.when(F.length(c) > n, 1)).alias(f"long_{c}") for c, n in self.limits.items()])

    def require(self, what: str) -> None:
        """Raise when the observed rows break a constraint, after the action."""
        counts = self.observation.get
        bad = [f"{counts[f'null_{k}']} rows without {k}" for k in self.keys if counts[f"null_{k}"]]
        bad += [f"{counts[f'long_{c}']} texts of {c} over {n} characters" for c, n in self.limits.items() if counts[f"long_{c}"]]
        if bad:
            raise ConstraintViolation(f"{what}: " + "; ".join(bad))
