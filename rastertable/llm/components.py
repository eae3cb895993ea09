"""Connected components of a table of links, by union-find in tasks and contraction between them.

A task joins the links it reads to a spanning forest. Then, round by round, every node moves to the
neighbour of lowest random rank and links between nodes that met vanish; the expected number of
rounds is logarithmic. Each round is a table in the shared folder, and no node's links need to fit in
a task. Once only ``FEW_LINKS`` are left, one task joins them: a round plans some twenty stages,
whose tasks and plans the driver keeps track of however few links they carry.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, shared_table


def find(parent: dict, x):
    """The root of ``x``, halving the path on the way."""
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that links a-b reach, for nodes 0 .. n - 1."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


#: Nodes a task's forest may hold before it starts another.
FOREST_NODES = 500_000


def _forest(batches):
    """Of a task's links, those that join two trees."""
    import pyarrow as pa

    parent: dict = {}
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(parent, a), find(parent, b)
            keep.append(x != y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        yield batch.filter(pa.array(keep, pa.bool_()))
        if len(parent) > FOREST_NODES:
            parent = {}


#: Links that are left to one task, a fixed number whatever the input.
FEW_LINKS = 1 << 14


def _least(batches):
    """Every node of a task's links, and the least node that they reach."""
    import pyarrow as pa

    parent: dict = {}
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    if parent:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parent), kind), pa.array([find(parent, x) for x in list(parent)], kind)], ["node", "parent"])


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach, for every node of ``links`` (a, b)."""
    links = links.select("a", "b").where("a != b")
    links = shared_table(links.mapInArrow(_forest, links.schema), "links")
    moves: list[DataFrame] = []
    while (n := links.count()) > FEW_LINKS:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        turn = F.lit(len(moves))
        best = F.min(F.struct(F.xxhash64("b", turn).alias("rank"), F.col("b").alias("at")))
        own = F.struct(F.xxhash64("a", turn).alias("rank"), F.col("a").alias("at"))
        move = (both.groupBy("a").agg(best.alias("best"), F.count("*").alias("degree"))
                .select(F.col("a").alias("node"), F.least(F.col("best"), own)["at"].alias("parent"), "degree"))
        move = shared_table(move, "moves")
        moves.append(move)
        for end in ("a", "b"):
            links = join_groups(links.withColumnRenamed(end, "node"), move, "node", "degree", 2 * n)
            links = links.drop("node", "degree").withColumnRenamed("parent", end)
        links = (links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .distinct())
        links = shared_table(links, "links")
    if n:
        kind = links.schema["a"].dataType.simpleString()
        last = shared_table(links.coalesce(1).mapInArrow(_least, f"node {kind}, parent {kind}"), "moves")
        if not moves:
            return last.select("node", F.col("parent").alias("component"))
        moves.append(last)
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    at = moves[0].select("node", "parent")
    for move in moves[1:]:
        onward = move.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        at = at.join(onward, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent"))
    at = shared_table(at, "roots")
    least = at.groupBy("parent").agg(F.min("node").alias("component"), F.count("*").alias("size"))
    return join_groups(at, least, "parent", "size", at.count()).select("node", "component")
