"""Prefix trie of conversations, rolled up by centroid decomposition.

``rebuild`` gives every conversation the first turns of a shared one;
``trie_nodes`` finds the distinct prefixes; ``rollup`` adds values over all
subtrees; ``conversation_trie`` puts them together.

A node is named by its smallest member and its depth. All members of a node
share the chain of nodes above it, so the table (conversation, depth, node)
answers "which node of that depth lies above this one" by one equi-join,
whatever the depth of the trie.

Rollup. A component of the parent-edge forest is split at its centroid, the
deepest node whose subtree holds at least half of the component: the total of
that subtree is the centroid's own result and is added to every node on the
path from the centroid to the top of the component; the subtrees below the
centroid and the rest above it are components of at most half the size, which
are split in turn. Components of more than ``most`` nodes are split by joins
over the whole table, all of them in one round, so the rounds grow with the
logarithm of nodes / ``most`` and not with the depth; smaller ones are split
to the end inside a task by the same rule.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.materials import with_position
from .common import scratch_table

#: turns of a conversation whose digests are chained in one row
CHAINED = 1024
#: width of the id ranges whose members are joined to one text before hashing
ID_RANGE = 4096
#: centroids that may be broadcast, one small row each
BROADCAST_ROWS = 100_000


def _turns(convs: DataFrame) -> DataFrame:
    """conv, turn, digest of role and text, code points of the text."""
    role, text = F.coalesce(convs["role"], F.lit("")), F.coalesce(convs["text"], F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return convs.select(convs["conv_id"].cast("long").alias("conv"), convs["turn"].alias("turn"), digest.alias("digest"),
                        F.length(text).cast("long").alias("chars")).where("conv IS NOT NULL")


def rebuild(convs: DataFrame, shared: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after every conversation ``conv`` has got the
    first ``head`` turns of conversation ``shared`` and then its own turns
    after its first ``head``: rows (conv, depth, digest, chars) with depth
    from 1, and (conv, len).

    The rows are numbered by one range sort of ids and digests, so a
    conversation of very many turns is spread over tasks like any others.
    """
    numbered = scratch_table(with_position(_turns(convs).orderBy("conv", "turn", "digest"), "place"), "turns")
    own = scratch_table(numbered.groupBy("conv").agg(F.min("place").alias("first"), F.count("*").alias("n"))
                        .withColumn("shared", shared).withColumn("head", head), "convs")
    placed = scratch_table(numbered.join(own, "conv").select(
        "conv", (F.col("place") - F.col("first") + 1).alias("at"), "head", "shared", "digest", "chars"), "placed")
    led = own.join(own.select(F.col("conv").alias("shared"), F.col("n").alias("n_shared")), "shared", "left")
    led = scratch_table(led.withColumn("lead", F.least("head", F.coalesce("n_shared", F.lit(0)))), "led")
    # by position, so that a conversation that very many share is dealt over the turns; at most ``head`` rows a conversation
    wanted = (led.where("lead > 0").select("conv", "shared", F.explode(F.sequence(F.lit(1), F.col("lead"))).alias("depth")))
    taken = placed.select(F.col("conv").alias("shared"), F.col("at").alias("depth"), "digest", "chars")
    first = wanted.join(taken, ["shared", "depth"]).select("conv", "depth", "digest", "chars")
    rest = (placed.where("at > head").join(led.select("conv", "lead"), "conv")
            .select("conv", (F.col("at") - F.col("head") + F.col("lead")).alias("depth"), "digest", "chars"))
    return (first.unionByName(rest),
            led.select("conv", (F.col("lead") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("len")))


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv, depth, chars, key: a digest of the first ``depth`` turns. Digests
    are chained in runs of CHAINED turns; the runs of a conversation in turn."""
    run = F.floor((F.col("depth") - 1) / CHAINED)
    runs = scratch_table(
        turns.groupBy("conv", run.alias("run"))
        .agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "chars"))).alias("turns"))
        .withColumn("whole", F.sha2(F.array_join(F.transform("turns", lambda t: t["digest"]), ""), 256)), "runs")

    def chain(items: str, at: str, digest: str, start: Column) -> Column:
        """at, chars and key per item: its digest chained to the key before it."""
        before = lambda got: F.coalesce(F.try_element_at(got, F.lit(-1))["key"], start)
        return F.aggregate(
            items, F.array().cast("array<struct<at:bigint,chars:bigint,key:string>>"),
            lambda got, x: F.concat(got, F.array(F.struct(
                x[at].cast("bigint").alias("at"), x["chars"].alias("chars"),
                F.sha2(F.concat(before(got), x[digest]), 256).alias("key")))))

    several = runs.where("run > 0").select("conv").distinct()
    starts = (runs.join(several, "conv", "left_semi")
              .groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(
                  F.col("run"), F.col("whole"), F.lit(0).cast("bigint").alias("chars")))).alias("items"))
              .select("conv", F.explode(chain("items", "run", "whole", F.lit(""))).alias("s"))
              .select("conv", (F.col("s.at") + 1).alias("run"), F.col("s.key").alias("start")))
    begun = runs.drop("whole").join(starts, ["conv", "run"], "left")
    keyed = chain("turns", "depth", "digest", F.coalesce("start", F.lit("")))
    return (begun.select("conv", F.explode(keyed).alias("p"))
            .select("conv", F.col("p.at").alias("depth"), F.col("p.chars").alias("chars"), F.col("p.key").alias("key")))


def trie_nodes(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, chain). ``nodes``: node (smallest member), depth, parent,
    n_convs, chars, n_children, size (nodes of its subtree); ``chain``: for
    every conversation and depth the node there, depth 0 included."""
    prefixes = scratch_table(_prefixes(turns), "prefixes")
    distinct = scratch_table(prefixes.groupBy("key").agg(
        F.min("conv").alias("node"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")), "distinct")
    root = convs.agg(F.min("conv"), F.count("*")).first()
    top = F.lit(root[0]).cast("long")
    chain = scratch_table(
        prefixes.select("conv", "depth", "key").join(distinct.select("key", "node", "n_convs", "chars"), "key")
        .select("conv", "depth", "node", "n_convs", "chars")
        .unionByName(convs.select("conv", F.lit(0).cast("long").alias("depth"), top.alias("node"),
                                  F.lit(root[1]).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("chars"))), "chain")
    # a conversation owns the nodes of which it is the smallest member: from some depth on all of its own
    owned = (chain.groupBy("conv").agg(F.count(F.when(F.col("node") == F.col("conv"), 1)).alias("owned"),
                                       F.max("depth").alias("len")))
    owned = scratch_table(owned, "owned")
    below = scratch_table(chain.join(owned.select("conv", "owned"), "conv").groupBy("node", "depth")
                          .agg(F.sum("owned").alias("below")), "below")
    mine = chain.where("node = conv").drop("conv")
    parents = chain.select(F.col("conv").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    nodes = scratch_table(
        mine.join(parents, ["node", "depth"], "left").join(below, ["node", "depth"])
        .join(owned.select(F.col("conv").alias("node"), "owned", "len"), "node")
        # the subtree: what its members own, but of the smallest member only the nodes from here on
        .withColumn("size", F.col("below") - F.col("owned") + F.col("len") - F.col("depth") + 1)
        .drop("below", "owned", "len"), "nodes")
    children = (nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count("*").alias("n_children")))
    nodes = scratch_table(nodes.join(children, ["node", "depth"], "left")
                          .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie")
    return nodes, chain


def centroid_sums(parent: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of a forest: ``parent`` holds the row of each row's parent
    (-1: none) and stands before its children; ``values`` is (rows, k)."""
    n = len(parent)
    above = parent.tolist()
    sums, children = np.zeros_like(values), [[] for _ in range(n)]
    label, size = list(range(n)), [0] * n
    for x, p in enumerate(above):
        if p >= 0:
            label[x] = label[p]
            children[p].append(x)
    parts: dict[int, list[int]] = {}
    for x in range(n):
        parts.setdefault(label[x], []).append(x)
    todo = list(parts.values())  # each with its top first, parents before children
    gone = [False] * n
    while todo:
        part = todo.pop()
        top, many = part[0], len(part)
        if many == 1:
            sums[top] += values[top]
            gone[top] = True
            continue
        for x in part:
            size[x] = 1
        for x in reversed(part):
            if x != top:
                size[above[x]] += size[x]
        centre = top
        while True:
            heavy = [y for y in children[centre] if not gone[y] and label[y] == label[centre] and 2 * size[y] >= many]
            if not heavy:
                break
            centre = heavy[0]
        old, pieces, inside = label[top], {}, [centre]
        for x in part:
            if x == centre:
                label[x] = -1
                continue
            up = above[x] if x != top else -1
            if up == centre:
                label[x] = n + x  # a piece is named by its top; names of former rounds never come back
            elif up >= 0 and label[up] != old:
                label[x] = label[up]
            if label[x] != old:
                inside.append(x)
            pieces.setdefault(label[x], []).append(x)
        total = values[inside].sum(axis=0)
        sums[centre] += total
        gone[centre] = True
        x = centre
        while x != top:
            x = above[x]
            sums[x] += total
        todo.extend(pieces.values())
    return sums


def _solve(values: Sequence[str]):
    """Splits all components of one bin to the end."""
    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([("depth", "ascending")])
        node, depth = (table.column(c).to_numpy() for c in ("node", "depth"))
        up = table.column("parent").to_numpy(zero_copy_only=False)
        tops = (table.column("top").to_numpy() == node) & (table.column("top_depth").to_numpy() == depth)
        row = {key: i for i, key in enumerate(zip(node.tolist(), depth.tolist()))}
        parent = np.array([-1 if t else row[(int(p), d - 1)] for p, d, t in zip(up, depth.tolist(), tops.tolist())], np.int64)
        sums = centroid_sums(parent, np.stack([table.column(v).to_numpy() for v in values], 1))
        return pa.table({"node": node, "depth": depth} | {v: sums[:, i] for i, v in enumerate(values)})
    return solve


def rollup(nodes: DataFrame, chain: DataFrame, values: Sequence[str], most: int = 50_000) -> DataFrame:
    """node, depth and, per value, its sum over the node's subtree.

    ``nodes``: node, depth, parent (null at the top), size and the values
    (longs); ``chain``: conv, depth, node as of ``trie_nodes``. An empty table
    gives an empty result.
    """
    sums = [F.sum(v).cast("long").alias(v) for v in values]
    top = nodes.where("parent IS NULL").select("node", "depth").first()
    work = scratch_table(nodes.select("node", "depth", "parent", "size", *values).withColumns({
        "top": F.lit(top[0] if top else None).cast("long"), "top_depth": F.lit(top[1] if top else None).cast("long")}), "work")
    place = chain.select(F.col("conv").alias("node"), F.col("depth").alias("centre_depth"), F.col("node").alias("there"))
    done = []
    while True:
        large = scratch_table(work.groupBy("top", "top_depth").agg(F.count("*").alias("total")).where(F.col("total") > most), "large")
        n_large = large.count()
        if n_large == 0:
            break
        near = F.broadcast if n_large <= BROADCAST_ROWS else (lambda df: df)
        centres = scratch_table(
            work.join(near(large), ["top", "top_depth"]).where(2 * F.col("size") >= F.col("total"))
            .groupBy("top", "top_depth").agg(F.max_by(F.struct("node", "depth", "size"), "depth").alias("c"))
            .select("top", "top_depth", F.col("c.node").alias("centre"), F.col("c.depth").alias("centre_depth"),
                    F.col("c.size").alias("centre_size")), "centres")
        split = work.join(near(centres), ["top", "top_depth"], "left")
        # the node of the centroid's depth, and of the one below it, above each node
        deep = split.where(F.col("depth") >= F.col("centre_depth")).join(place, ["node", "centre_depth"])
        under = place.select("node", (F.col("centre_depth") - 1).alias("centre_depth"), F.col("there").alias("child"))
        inside = scratch_table(deep.where(F.col("there") == F.col("centre"))
                               .join(under, ["node", "centre_depth"], "left"), "inside")
        totals = scratch_table(inside.groupBy("top", "top_depth", "centre", "centre_depth", "centre_size").agg(*sums), "totals")
        path = scratch_table(
            totals.withColumnRenamed("centre", "conv").join(
                chain.select("conv", F.col("depth").alias("path_depth"), F.col("node").alias("path_node")), "conv")
            .where((F.col("path_depth") >= F.col("top_depth")) & (F.col("path_depth") < F.col("centre_depth")))
            .select(F.col("path_node").alias("node"), F.col("path_depth").alias("depth"),
                    F.col("centre_size").alias("less"), *values), "path")
        done += [totals.select(F.col("centre").alias("node"), F.col("centre_depth").alias("depth"), *values),
                 path.select("node", "depth", *values)]
        kept = inside.where(F.col("depth") > F.col("centre_depth")).select(
            "node", "depth", "parent", "size", *values, F.col("child").alias("top"), (F.col("centre_depth") + 1).alias("top_depth"))
        rest = (work.join(inside.select("node", "depth"), ["node", "depth"], "left_anti")
                .join(path.select("node", "depth", "less"), ["node", "depth"], "left")
                .withColumn("size", F.col("size") - F.coalesce("less", F.lit(0))).drop("less"))
        work = scratch_table(rest.unionByName(kept), "work")
    bins = max(1, -(-work.count() // most))
    solved = (work.withColumn("bin", F.pmod(F.xxhash64("top", "top_depth"), F.lit(bins))).groupBy("bin")
              .applyInArrow(_solve(values), "node long, depth long, " + ", ".join(f"{v} long" for v in values)))
    for part in done:
        solved = solved.unionByName(part)
    return solved.groupBy("node", "depth").agg(*sums)


def _hash_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined texts of each node, rows sorted by node and
    range; a node's rows may run over any number of batches."""
    now, state = None, None
    for batch in batches:
        out = []
        for node, depth, members in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "members"))):
            if (node, depth) != now:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (node, depth), hashlib.sha256(members.encode())
            else:
                state.update(b"," + members.encode())
        yield _hashed(out)
    if now is not None:
        yield _hashed([(*now, state.hexdigest())])


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                       pa.array(cols[2], pa.string())], ["node", "depth", "ends_sha256"])


def end_digests(chain: DataFrame, convs: DataFrame) -> DataFrame:
    """node, depth, ends_sha256 of the nodes where a conversation ends. Ids are
    joined in ranges first, so a node where very many end takes few rows; the
    digest itself is one stream by its nature and holds one row at a time."""
    ends = chain.select("conv", "depth", "node").join(convs.select("conv", F.col("len").alias("depth")), ["conv", "depth"])
    joined = (ends.groupBy("node", "depth", F.floor(F.col("conv") / ID_RANGE).alias("range"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("members")))
    return (joined.repartition("node", "depth").sortWithinPartitions("node", "depth", "range")
            .select("node", "depth", "members").mapInArrow(_hash_members, "node long, depth long, ends_sha256 string"))


def conversation_trie(convs: DataFrame, shared: Column, head: Column, most: int = 50_000) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations.

    ``shared`` and ``head`` are expressions over ``conv``: the conversation
    whose first turns are taken over, and how many. Returns per node conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Turns are ordered by ``turn`` with nulls first, ties by the digest of role
    and text; repeated rows are turns of their own. A null role or text is
    empty. Rows with a null conv_id belong to no conversation and are left
    out. A conversation left without turns is a member of the root alone. An
    empty table has no smallest member and gives an empty result. Other
    columns are ignored.
    """
    turns, known = rebuild(convs, shared, head)
    known = scratch_table(known, "rebuilt")
    nodes, chain = trie_nodes(turns, known)
    valued = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"),
                                "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    rolled = rollup(valued, chain, ["n_leaves", "saved_tokens"], most)
    return (nodes.join(rolled, ["node", "depth"]).join(end_digests(chain, known), ["node", "depth"], "left")
            .select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
