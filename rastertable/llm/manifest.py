"""A dataset manifest as a Merkle DAG: digest-to-children records, and proofs by descent from the root.

Rows are leaves; runs of ``fanout`` neighbours become a node, level by level, one tree per partition of
the dataset and one over the partitions' roots. What is stored is content-addressed: a node's digest and
its children's digests, equal nodes once. A leaf's address is its rank written digit by digit from the
root down. Requests descend together: a round looks up the records of all nodes on the way to some
request, once per node however many requests pass it, keeps the children not taken as a segment of the
path, and goes on with those that are taken. At the leaf the segments are reversed, leaf to root.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flattened, join_groups, nested, shared_table

FANOUT = 8
_DIGEST = 32  # bytes
_SEGMENT = "struct<before: binary, after: binary>"


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of all fields in a row: ``-`` where null, else length in UTF-8 bytes, ``:``, value."""
    text = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256))


def _node(children: Column) -> Column:
    return F.unhex(F.sha2(hexed(children), 256))


@dataclass
class Manifest:
    """``records`` (digest, children, uses): children as digests in a row, uses as places in the DAG.
    ``leaves`` (row, more.., leaf, subroot, address). ``root`` is None for an empty dataset."""
    records: DataFrame
    leaves: DataFrame
    root: bytes | None
    n_leaves: int
    depth: int


def _ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``idx``, the place in its part by ``order``, and ``n``, the part's size.

    Sorted ranges number their own rows; the ranges' counts, one row per range and part, give each
    range its start. A part of any size is spread over ranges.
    """
    fields = T.StructType([*nodes.schema, T.StructField("slot", T.IntegerType()), T.StructField("inside", T.LongType())])

    def run(batches):
        slot, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not len(batch):
                continue
            part = batch.column("part")
            codes = part.dictionary_encode().indices.to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)]])
            inside = np.arange(len(codes)) - np.repeat(cuts[:-1], np.diff(cuts))
            inside[:cuts[1]] += seen if part[0].as_py() == last else 0
            last, seen = part[-1].as_py(), int(inside[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(batch), slot, np.int32)), pa.array(inside)], fields.names)

    sorted_rows = nodes.repartitionByRange("part", *order).sortWithinPartitions("part", *order)
    placed = shared_table(sorted_rows.mapInArrow(run, fields), "ranks")
    per_range = placed.groupBy("part", "slot").agg(F.count("*").alias("rows"))
    in_part = Window.partitionBy("part")
    before = in_part.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select("part", "slot", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
                              F.sum("rows").over(in_part).alias("n"))
    return (placed.join(starts, ["part", "slot"]).withColumn("idx", F.col("start") + F.col("inside"))
            .drop("slot", "inside", "start"))


def _tree(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame, int]:
    """Levels of records above ``nodes`` (part, idx, n, digest), the parts' roots (part, digest, depth),
    and the depth of the deepest part."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots, depth = [], [nodes.where("n = 1").select("part", "digest", F.lit(0).alias("depth"))], 0
    while most > 1:
        depth += 1
        children = F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda c: F.hex(c["digest"]))
        level = (nodes.where("n > 1").groupBy("part", F.expr(f"idx div {fanout}").alias("idx"))
                 .agg(F.unhex(F.array_join(children, "")).alias("children"),
                      F.ceil(F.first("n") / fanout).alias("n"))
                 .withColumn("digest", _node(F.col("children"))))
        level = shared_table(level, f"level{depth}")
        levels.append(level.select("digest", "children"))
        roots.append(level.where("n = 1").select("part", "digest", F.lit(depth).alias("depth")))
        nodes, most = level.select("part", "idx", "n", "digest"), -(-most // fanout)
    parts = roots[0]
    for more in roots[1:]:
        parts = parts.unionByName(more)
    return levels, parts, depth


def _digits(rank: Column, depth: Column, fanout: int) -> Column:
    """``depth`` digits of ``rank`` in base ``fanout``."""
    return F.when(depth == 0, "").otherwise(F.lpad(F.conv(rank.cast("string"), 10, fanout), depth, "0"))


def build(docs: DataFrame, fields: list[str], id_col: str = "doc_id", part_col: str = "lang", fanout: int = FANOUT,
          with_columns: list[str] | None = None, more: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``: ``fields`` make a leaf, ``part_col`` names its partition.

    Partitions come in order of their names (UTF-8 bytes, null first), leaves by id (null first), then by
    leaf; rows that repeat each other whole stand side by side, with equal leaves. A partition of one row
    has that leaf as its root. ``with_columns`` are carried along (the id by default), ``more`` are further
    columns computed from the input row. Texts are hashed as they are read and do not shuffle. An empty
    table has no root and no leaves.
    """
    if not 2 <= fanout <= 36:
        raise ValueError("fanout is 2 to 36")
    carried = [id_col] if with_columns is None else list(with_columns)
    extra = more or {}
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in carried])
    name = F.col(f"`{part_col}`").cast("string")
    leaves = shared_table(docs.select(
        row.alias("row"), *[c.alias(f"more_{k}") for k, c in extra.items()],
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("part"), F.col(f"`{id_col}`").alias("id"),
        leaf_digest(*[F.col(f"`{c}`") for c in fields]).alias("digest"),
        F.monotonically_increasing_id().alias("uid")), "leaves")
    ranked = shared_table(_ranked(leaves, ["id", "digest", "uid"]), "ranked")
    n = ranked.count()
    levels, parts, deep = _tree(ranked.select("part", "idx", "n", "digest"), fanout)
    sizes = ranked.groupBy("part").agg(F.first("n").alias("size"))
    tops = parts.select(F.lit("").alias("part"), F.col("part").alias("name"), "digest", "depth")
    tops = shared_table(_ranked(tops, ["name"]), "partitions")
    top_levels, whole, top_deep = _tree(tops.select("part", "idx", "n", "digest"), fanout)
    root = whole.select("digest").first()
    named = (tops.join(sizes.withColumnRenamed("part", "name"), "name")
             .select(F.col("name").alias("part"), "size", F.col("digest").alias("subroot"), "depth",
                     _digits(F.col("idx"), F.lit(top_deep), fanout).alias("top")))
    addressed = join_groups(ranked, named, "part", "size", n).select(
        "row", *[f"more_{k}" for k in extra], F.col("digest").alias("leaf"), "subroot",
        F.concat("top", _digits(F.col("idx"), F.col("depth"), fanout)).alias("address"))
    records = leaves.sparkSession.createDataFrame([], "digest binary, children binary")
    for level in levels + top_levels:
        records = records.unionByName(level)
    records = records.groupBy("digest").agg(F.first("children").alias("children"), F.count("*").alias("uses"))
    return Manifest(shared_table(records, "records"), shared_table(addressed, "addressed"),
                    bytes(root[0]) if root else None, n, deep + top_deep)


def _child(digit: Column) -> Column:
    """Length of the children before a digit, in bytes."""
    return digit * _DIGEST


def _segment(children: Column, digit: Column) -> Column:
    """The children that a digit does not take, those before it and those after it."""
    return F.struct(F.substring(children, F.lit(1), _child(digit)).alias("before"),
                    F.substring(children, _child(digit) + _DIGEST + 1, F.length(children)).alias("after"))


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (a column ``address``, others carried) with ``path``, leaf level first: an array of
    (before, after), the siblings' digests in a row.

    Addresses may repeat; an inner node's gives the path of that node, one of no node or null gives no row.
    A round per level joins the nodes
    that some request passes with their records. Requests meet their path at the last node only, so a path
    travels once per run of neighbours; nodes with very many requests, and records of nodes that repeated
    rows make equal, are few by count and are broadcast.
    """
    spark = requests.sparkSession
    empty = F.array().cast(f"array<{_SEGMENT}>")
    if manifest.root is None:
        return requests.where("false").withColumn("path", empty)
    total = requests.count()
    digit = lambda c: F.conv(c, 36, 10).cast("int")
    at = F.explode(F.sequence(F.lit(0), F.length("address") - 1)).alias("level")
    asked = requests.where("length(address) > 0").select("address", at)
    taken = F.call_function("shiftleft", F.lit(1).cast("bigint"), digit(F.expr("substring(address, level + 1, 1)")))
    below = F.col("level") + 1 < F.length("address")
    passed = shared_table(
        asked.groupBy("level", F.expr("substring(address, 1, level)").alias("prefix"))
        .agg(F.bit_or(F.when(below, taken).otherwise(0)).alias("onward"),
             F.count_if(~below).alias("here")).repartition("level", "prefix"), "passed")
    nodes = spark.createDataFrame([("", manifest.root)], "prefix string, digest binary").withColumn("path", empty)
    opened = []
    for level in range(manifest.depth):
        wanted = passed.where(F.col("level") == level).drop("level")
        found = join_groups(nodes.join(wanted, "prefix"), manifest.records, "digest", "uses", manifest.n_leaves)
        found = shared_table(found.drop("digest", "uses"), f"opened{level}")
        opened.append(found.where("here > 0").select("prefix", "children", "path", "here"))
        width = (F.length("children") / _DIGEST).cast("int")
        onward = F.filter(F.sequence(F.lit(0), width - 1), lambda d: F.getbit(F.col("onward"), d) == 1)
        nodes = (found.where("onward <> 0").withColumn("digit", F.explode(onward)).select(
            F.concat("prefix", F.lower(F.conv(F.col("digit").cast("string"), 10, 36))).alias("prefix"),
            F.substring(F.col("children"), _child(F.col("digit")) + 1, F.lit(_DIGEST)).alias("digest"),
            F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path")))
    alone = requests.where("address = ''").where(F.lit(manifest.depth == 0)).withColumn("path", empty)
    if not opened:
        return alone
    ends = opened[0]
    for more in opened[1:]:
        ends = ends.unionByName(more)
    inner = nested(requests.where("length(address) > 0"), prefix=F.expr("substring(address, 1, length(address) - 1)"),
                   digit=digit(F.expr("right(address, 1)")))
    met = join_groups(inner, ends, "prefix", "here", total)
    met = met.where(_child(F.col("digit")) < F.length("children"))
    path = F.reverse(F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))))
    return flattened(met.withColumn("path", path.cast(f"array<{_SEGMENT}>")), "path")


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings' digests as hex text, in the path's order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: hexed(F.concat(s["before"], s["after"]))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root, as hex text, that a leaf and its siblings give."""
    return F.aggregate(path, hexed(leaf), lambda acc, s: F.sha2(
        F.concat(hexed(s["before"]), acc, hexed(s["after"])), 256))


def audit(manifest: Manifest, claimed: str | None = None) -> DataFrame:
    """Every leaf with its proof, checked: the carried columns, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256``, ``folded_root`` and ``verified``.

    ``claimed`` names one of the columns given to ``build`` as ``more``: a leaf digest to check in place of
    the stored one; where it is null the stored one is taken.
    """
    held = manifest.leaves.select("row", "leaf", "subroot", "address",
                                  (F.coalesce(f"more_{claimed}", "leaf") if claimed else F.col("leaf")).alias("claimed"))
    root = F.lit(None if manifest.root is None else manifest.root.hex()).cast("string")
    checked = proofs(manifest, held).select(
        "row", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), root.alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("claimed"), F.col("path")).alias("folded_root"))
    return flattened(checked.withColumn("verified", F.col("folded_root") == F.col("root")),
                     "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
