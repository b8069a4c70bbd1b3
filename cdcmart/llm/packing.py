"""Length buckets with the least padding, and token-budget batches inside them.

A dynamic programme over the histogram of all lengths chooses the boundaries;
every document is padded to the boundary of its bucket, and each batch holds
as many documents as the token budget allows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table

#: rows that one task numbers together; batches run on over all groups of a bucket
GROUP_ROWS = 2048
#: lengths are kept exactly up to here; beyond, the histogram has 4096 steps an octave
EXACT_LENGTHS = 1 << 15
OCTAVE_STEPS = 4096


def word_count(text: Column) -> Column:
    """Words of a text: runs of bytes other than blanks and 09 to 0D."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def histogram_length(length: Column) -> Column:
    """The length as the histogram holds it: exact up to EXACT_LENGTHS, then
    rounded up to a step of 1/4096 of its octave, so that the histogram's size
    is bounded by the number of octaves and not by the data."""
    octave = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double")))
    step = F.greatest(F.lit(1), F.pow(F.lit(2.0), octave) / OCTAVE_STEPS).cast("long")
    return F.when(length <= EXACT_LENGTHS, length).otherwise(F.ceil(length / step) * step).cast("long")


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The at most ``buckets`` boundaries (values of ``lengths``, sorted, all
    positive) for which the sum of counts * (boundary - length) is smallest.

    Cost of a bucket (i, j] is lengths[j] * (C[j] - C[i]) minus a sum over all
    lengths that no choice changes. It obeys the quadrangle inequality, so each
    layer of the programme is solved by halving, with monotone choices.
    """
    n = len(lengths)
    if n <= buckets:
        return [int(x) for x in lengths]
    before = np.concatenate([[0.0], np.cumsum(counts.astype(np.float64))])
    cost = np.full(n + 1, np.inf)
    cost[0] = 0.0
    choices = []
    for _ in range(buckets):
        new, choice = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(b, mid - 1) + 1)
            total = cost[i] + lengths[mid - 1] * (before[mid] - before[i])
            k = int(np.argmin(total))
            new[mid], choice[mid] = total[k], i[k]
            todo += [(lo, mid - 1, a, int(i[k])), (mid + 1, hi, int(i[k]), b)]
        choices.append(choice)
        cost = new
    out, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(choice[j])
    return out[::-1]


def pack(docs: DataFrame, buckets: int = 16, token_budget: int = 32_768, length: Column | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, length, bucket_length, padding, batch_id, slot per row of ``docs``.

    ``length`` is a token count per row (default: words of the text). Bucket
    boundaries minimise the padding of the whole table; a batch holds
    max(1, budget // bucket_length) rows of one bucket, each padded to its
    bucket_length. Rows are numbered inside groups of about 2,048 rows of a
    bucket, so no task numbers a whole bucket; the rows of the groups before it
    are added to each, so only the last batch of a bucket may not be full.

    A null or empty text has length 0 and goes to the bucket of boundary 0,
    with batches of ``token_budget`` rows. A row longer than the budget is a
    batch of its own and is never cut. Rows that repeat a doc_id, or have none,
    are packed each; ties are ordered by doc_id; an empty table gives an empty
    result; other columns are ignored.
    """
    measure = word_count(docs[text_col]) if length is None else F.coalesce(length, F.lit(0)).cast("long")
    # written once, so that no text is measured again where a plan repeats the expression
    rows = scratch_table(docs.select(docs[id_col].alias("doc_id"), measure.alias("length"),
                                     F.xxhash64(docs[id_col], docs[text_col]).alias("deal")), "lengths")
    seen = (rows.groupBy(histogram_length(F.col("length")).alias("size")).agg(F.count("*").alias("n"))
            .orderBy("size").collect())
    positive = [(r["size"], r["n"]) for r in seen if r["size"] > 0]
    bounds = optimal_boundaries(np.array([s for s, _ in positive], np.int64), np.array([n for _, n in positive], np.int64),
                                buckets) if positive else []
    per_bucket, at = {b: 0 for b in [0, *bounds]}, 0
    for size, n in ((r["size"], r["n"]) for r in seen):
        while size > [0, *bounds][at]:
            at += 1
        per_bucket[[0, *bounds][at]] += n
    bound = F.lit(bounds[-1] if bounds else 0).cast("long")
    groups = F.lit(1).cast("long")
    for b in reversed([0, *bounds]):
        bound = F.when(F.col("length") <= b, F.lit(b).cast("long")).otherwise(bound)
    for b, n in per_bucket.items():
        groups = F.when(F.col("bucket_length") == b, F.lit(max(1, -(-n // GROUP_ROWS))).cast("long")).otherwise(groups)
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_length"), F.lit(1))))
    placed = rows.withColumn("bucket_length", bound).withColumn("part", F.pmod("deal", groups))
    # one row per group, of about GROUP_ROWS rows each
    before = (placed.groupBy("bucket_length", "part").agg(F.count("*").alias("n"))
              .select("bucket_length", "part", F.coalesce(F.sum("n").over(
                  Window.partitionBy("bucket_length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    numbered = (placed.withColumn("row", F.row_number().over(
                    Window.partitionBy("bucket_length", "part").orderBy("doc_id", "deal")) - 1)
                .join(before, ["bucket_length", "part"])
                .withColumn("row", F.col("row") + F.col("before"))
                .withColumn("per_batch", per_batch.cast("long")))
    return numbered.select(
        "doc_id", "length", "bucket_length", (F.col("bucket_length") - F.col("length")).alias("padding"),
        F.concat_ws("-", "bucket_length", F.floor(F.col("row") / F.col("per_batch")).cast("long")).alias("batch_id"),
        (F.col("row") % F.col("per_batch")).cast("int").alias("slot"))
