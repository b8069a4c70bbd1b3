"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into segments; the mean and the deviation of each segment give
a lower bound of the distance between two vectors and so, as the score is an
inner product, an upper bound of it: per segment the product of the means plus
at most the product of the deviations. Coarse bounds (few segments) come
first, finer ones only for the survivors, exact scores for the rest.

Queries and candidates are packed into blocks; every pair of blocks is one row
of work. Scores and bounds of integer vectors are computed in float64 only
where every sum stays exact, otherwise in Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table

#: rows of a block
QUERY_ROWS, CANDIDATE_ROWS = 512, 4096
SEGMENTS = (1, 4, 16)
SCALE = 1024
_EXACT = float(1 << 53)
_Key = tuple[pa.Scalar, ...]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, v (floor(scale * x) per component, as double) of the rows that
    take part: without null, nor null or non-finite components."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("x"))
    x = F.col("x")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # the large values that floor() takes to long are integers already
    whole = F.transform(x, lambda c: F.when(F.abs(c) < 2.0 ** 40, F.floor(c * scale).cast("double")).otherwise(c * scale))
    return (rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(finite)
            .select("vec_id", whole.alias("v"), F.size("x").alias("dim")))


def segment_statistics(m: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row and segment the mean and the deviation (both times the root of
    the segment's size, so that products of them are sums over components)."""
    edges = np.linspace(0, m.shape[1], min(segments, max(1, m.shape[1])) + 1).astype(int)
    sizes = np.diff(edges)
    sums = np.add.reduceat(m, edges[:-1], axis=1) if m.shape[1] else np.zeros((len(m), 1))
    squares = np.add.reduceat(m * m, edges[:-1], axis=1) if m.shape[1] else np.zeros((len(m), 1))
    sizes = np.maximum(sizes, 1)
    mean = sums / np.sqrt(sizes)
    return mean, np.sqrt(np.maximum(squares - mean * mean, 0)), sizes


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors held as doubles."""
    most = (np.abs(q).max() if q.size else 0.0) * (np.abs(c).max() if c.size else 0.0) * max(1, q.shape[1])
    if most < _EXACT:
        return (q @ c.T).astype(np.int64)
    big = np.array([[int(x) for x in row] for row in q], object) @ np.array([[int(x) for x in row] for row in c], object).T
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return np.array([[min(max(int(x), low), high) for x in row] for row in big], np.int64)


def best_of_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """(query, candidate, score) of each query's k best candidates of a block:
    a candidate is scored only if no bound puts it under the k-th best of the
    candidates that the coarsest bounds rank first."""
    if not len(q_ids) or not len(c_ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    levels = [(*segment_statistics(q, s)[:2], *segment_statistics(c, s)[:2]) for s in SEGMENTS]
    slack = 1e-6 * (1 + np.sqrt((q * q).sum(axis=1)) * np.sqrt((c * c).sum(axis=1)).max())
    # the fixed start: scores of the candidates that the coarsest bound puts first
    first = min(len(c_ids), 8 * k)
    qm, qd, cm, cd = levels[0]
    bound = qm @ cm.T + qd @ cd.T
    lead = np.argpartition(-bound, first - 1, axis=1)[:, :first]
    out_q, out_c, out_s = [], [], []
    for i in range(len(q_ids)):
        own = lead[i][c_ids[lead[i]] != q_ids[i]]
        scored = exact_scores(q[i:i + 1], c[own])[0]
        floor = np.sort(scored)[-k] if len(scored) >= k else None
        live = np.flatnonzero((c_ids != q_ids[i]) & ((bound[i] >= floor - slack[i]) if floor is not None else True))
        for qm2, qd2, cm2, cd2 in levels[1:]:
            if floor is None or len(live) <= k:
                break
            live = live[cm2[live] @ qm2[i] + cd2[live] @ qd2[i] >= floor - slack[i]]
        score = exact_scores(q[i:i + 1], c[live])[0]
        best = np.lexsort((c_ids[live], -score))[:k]
        out_q.append(np.full(len(best), q_ids[i]))
        out_c.append(c_ids[live[best]])
        out_s.append(score[best])
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s)


def _pack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, flat


def _packed(rows: DataFrame, name: str, per_block: int) -> DataFrame:
    """dim, <name> (block number), ids and values of up to about ``per_block`` rows."""
    total = rows.count()
    blocks = max(1, -(-total // per_block))

    def pack(key: _Key, table: pa.Table) -> pa.Table:
        ids, flat = _pack(table)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), name: pa.array([key[1].as_py()], pa.int64()),
                         f"{name}_ids": pa.array([ids.tobytes()], pa.binary()),
                         f"{name}_values": pa.array([flat.tobytes()], pa.binary())})
    # ids are dealt by their hash, so blocks are of like size
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    return dealt.groupBy("dim", name).applyInArrow(pack, f"dim int, {name} long, {name}_ids binary, {name}_values binary")


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
                vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: of every row where ``is_query`` (over
    vec_id) holds the k other rows with the highest inner product of the
    integer vectors; ties go to the smaller vec_id; all, if there are fewer.

    A null id or vector, or a vector with a null or non-finite component,
    takes no part. Only vectors of one length are compared. A row that repeats
    another's id and vector counts once; a query is never its own candidate,
    nor is a row that repeats its id. Scores beyond 64 bits stop at the
    largest number. An empty table, or one without queries, gives an empty
    result; other columns are ignored.
    """
    rows = scratch_table(integer_vectors(vectors, id_col, vector_col, scale).distinct(), "vectors")
    queries = scratch_table(_packed(rows.where(is_query), "q", QUERY_ROWS), "queries")
    candidates = scratch_table(_packed(rows, "c", CANDIDATE_ROWS), "candidates")
    # each pair of blocks is a row: every candidate block with the number of every query block
    last = queries.agg(F.max("q")).first()[0]
    pairs = candidates.select("dim", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last or 0).cast("long"))).alias("q"))
    work = (pairs.join(queries, ["dim", "q"]).join(candidates, ["dim", "c"])
            .select("dim", "q_ids", "q_values", "c_ids", "c_values"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["c_ids"], np.int64)
                q = np.frombuffer(row["q_values"], np.float64).reshape(len(q_ids), row["dim"])
                c = np.frombuffer(row["c_values"], np.float64).reshape(len(c_ids), row["dim"])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in best_of_block(q_ids, q, c_ids, c, k)],
                                                 ["query_id", "vec_id", "score"])

    found = work.mapInArrow(search, "query_id long, vec_id long, score long")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
