"""Near duplicates by SuperMinHash: signatures, bands, verification on full sets, union-find groups.

A document is the set of its distinct five-word shingles. Documents with equal sets form one class
and are handled once, so copies never meet as pairs. In a bucket of a band, members are first
compared with the bucket's least class only. Where that leaves a bucket in several components, every
member is compared with those of other components, since any such pair may still be a link: as pairs
in small buckets, and block against block in others, where tasks hold a block's whole sets and report
a tree of links instead of pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flattened, give_back, join_groups, mixed, nested, shared_table, slices, text_or_empty, texts, words
from .components import components, least_reached

SHINGLE = 5
#: 32 bands of 4: a pair of similarity 0.75 shares no band about once in 193,000 times, by (1 - 0.75^4)^32.
BANDS, ROWS = 32, 4
SIMILARITY = 75  # per cent
#: Buckets up to SMALL members are compared as pairs, others as blocks of about BLOCK_ROWS.
SMALL, BLOCK_ROWS = 12, 192


def shingles(text: pa.Array) -> list[np.ndarray]:
    """For each text, its distinct shingles as sorted 64-bit hashes."""
    flat, starts = words(pc.ascii_lower(text))
    coded = flat.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False).astype(object)
    known = pd.util.hash_array(names, categorize=False) if len(names) else np.empty(0, np.uint64)
    h = known[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.empty(0, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    n = len(h) - SHINGLE + 1
    rolled = np.zeros(max(0, n), np.uint64)
    for i in range(SHINGLE):
        rolled = mixed(rolled * factor + h[i:i + len(rolled)])
    found = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= SHINGLE:
            found.append(np.unique(rolled[a:b - SHINGLE + 1]))
        elif b > a:  # the whole sequence as one
            one = np.full(1, b - a, np.uint64)
            for x in h[a:b]:
                one = mixed(one * factor + x)
            found.append(one)
        else:
            found.append(h[:0])
    return found


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash of each set, one row of ``m`` values.

    An element visits the m places in the order of its own random permutation; at step j it offers
    j + (a random fraction). A place keeps its least offer. A set whose places are all taken after
    step j stops there, since later steps can only offer more. All sets of a slice step together.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    kept = np.full(len(sets) * m, np.iinfo(np.uint64).max, np.uint64)
    if not sizes.sum():
        return kept.reshape(-1, m)
    element, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = None
    for j in range(m):
        drawn = mixed(element + np.uint64((j + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
        k = j + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        if order is None:
            place = k
        else:
            row = np.arange(len(element))
            place = order[row, k].astype(np.int64)
            order[row, k] = order[:, j]
            order[:, j] = place
        np.minimum.at(kept, owner * m + place, np.uint64(j << 32) | (drawn >> np.uint64(32)))
        open_set = (kept.reshape(-1, m).max(1) == np.iinfo(np.uint64).max) & (sizes > 0)
        if not open_set.any():
            break
        still = open_set[owner]
        if order is None:  # only sets that go on need their permutations
            element, owner, k = element[still], owner[still], k[still]
            order = np.tile(np.arange(m, dtype=np.uint16), (len(element), 1))
            order[np.arange(len(k)), k] = 0
            order[:, 0] = k
        elif still.mean() < 0.7:
            element, owner, order = element[still], owner[still], order[still]
    return kept.reshape(-1, m)


def bands(signature: np.ndarray, n_bands: int, n_rows: int) -> np.ndarray:
    """A 64-bit hash for each band, its number included."""
    parts = signature[:, :n_bands * n_rows].reshape(-1, n_bands, n_rows)
    h = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), parts.shape[:2])
    for i in range(n_rows):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return h.view(np.int64)


def _sketch(n_bands: int, n_rows: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(texts(part))
                h = bands(signatures(sets, n_bands * n_rows), n_bands, n_rows)
                full = np.array([len(s) > 0 for s in sets], bool)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(full * n_bands)]), pa.int32()),
                    pa.array(h[full].ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("print"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.binary()), lists], ["id", "print", "n", "key", "bands"])
            give_back()
    return run


def _sets(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            sets = shingles(texts(part))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]), pa.int32()),
                pa.array(np.concatenate(sets).view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("key"), lists], ["key", "shingles"])
        give_back()


def _verified(similarity: int):
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            sides = []
            for name in ("set_a", "set_b"):
                column = batch.column(name)
                sides.append((column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(
                    pc.list_value_length(column).to_numpy())])))
            (x, at), (y, by) = sides
            for i in range(batch.num_rows):
                s, t = x[at[i]:at[i + 1]], y[by[i]:by[i + 1]]
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep[i] = 100 * common >= similarity * (len(s) + len(t) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _faced(similarity: int):
    """Two blocks of a bucket: the links between them as a tree of links."""
    def run(key, table):
        low, high = key[1].as_py(), key[2].as_py()
        table = table.combine_chunks()
        block = table.column("block").to_numpy()
        lists = table.column("shingles").combine_chunks()
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        known, code, count = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        member = np.repeat(np.arange(len(size)), size)
        shared = count[code] > 1  # what one member has alone is in no intersection
        rank = np.cumsum(count > 1) - 1
        column, member = rank[code[shared]], member[shared]
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        common = np.zeros((len(left), len(right)))
        order = np.argsort(column, kind="stable")
        column, member = column[order], member[order]
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, (start, start + 4096))
            held = np.zeros((len(size), 4096), np.float32)
            held[member[a:b], column[a:b] - start] = 1
            common += held[left] @ held[right].T
        i, j = np.nonzero(100 * common >= similarity * (size[left][:, None] + size[right][None] - common))
        a, b = left[i], right[j]
        if low == high:
            a, b = a[a < b], b[a < b]
        root = least_reached(len(size), a, b)
        names = table.column("key").to_pylist()
        moved = np.flatnonzero(root != np.arange(len(size)))
        return pa.table({"a": pa.array([names[root[k]] for k in moved], pa.binary()),
                         "b": pa.array([names[k] for k in moved], pa.binary())})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    n_bands: int = BANDS, n_rows: int = ROWS, similarity: int = SIMILARITY,
                    with_columns: list[str] | None = None) -> DataFrame:
    """Every row with ``n_shingles``, ``component_id`` and ``kept``.

    Letters A-Z are lowered; words are runs without ASCII white space. Texts of one to four words are
    one shingle; texts without words (null ones too) have none, link with nothing and are kept.
    ``component_id`` is the smallest id that links reach, null ids aside; rows that repeat both id and
    text are marked alike.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    sketch = shared_table(rows.mapInArrow(
        _sketch(n_bands, n_rows), f"id {kind}, print bigint, n bigint, key binary, bands array<bigint>"), "sketch")
    total = sketch.count()
    first = F.min(F.struct("id", "print"))
    classes = shared_table(sketch.where("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("least"), F.count("*").alias("size"), first.alias("first"),
        F.any_value("n").alias("n"), F.any_value("bands").alias("bands")), "classes")
    links = _links(classes, rows, n_bands, similarity)
    named = components(links).select(F.col("node").alias("key"), "component")
    grouped = classes.select("key", "least", "size").join(named, "key", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "key"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("classes"))
    ids = join_groups(grouped, least, "component", "classes", total).select("key", "size", "component_id")
    ids = shared_table(ids, "class-ids")
    slim = sketch.select("id", "print", "n", "key")
    marked = (join_groups(slim.where("key IS NOT NULL"), ids, "key", "size", total)
              .select("id", "print", "n", "component_id")
              .unionByName(slim.where("key IS NULL").select("id", "print", "n", F.col("id").alias("component_id"))))
    marked = marked.select("id", "print", F.col("n").alias("n_shingles"), "component_id",
                           F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    if with_columns is not None and list(with_columns) == [id_col]:
        return marked.select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")
    return _beside(docs, marked, id_col, text_col, with_columns)


def _beside(docs: DataFrame, marked: DataFrame, id_col: str, text_col: str,
            with_columns: list[str] | None) -> DataFrame:
    """The marks next to the whole input rows they were made from."""
    carried = docs.columns if with_columns is None else list(with_columns)
    whole = nested(docs, id2=F.col(f"`{id_col}`"), print2=F.xxhash64(text_or_empty(f"`{text_col}`")))
    whole = whole.withColumn("row", F.struct(*[F.col("row").getField(c).alias(c) for c in carried]))
    once = marked.dropDuplicates(["id", "print"])
    both = whole.join(once.hint("merge"), F.col("id2").eqNullSafe(F.col("id")) & (F.col("print2") == F.col("print")))
    return flattened(both, "n_shingles", "component_id", "kept")


def _links(classes: DataFrame, rows: DataFrame, n_bands: int, similarity: int) -> DataFrame:
    """Verified links (a, b) between classes, enough to connect all that any links connect."""
    spread = classes.select("key", "n", F.explode("bands").alias("bucket"))
    buckets = (spread.groupBy("bucket").agg(F.min("key").alias("hub"), F.min_by("n", "key").alias("hub_n"),
                                            F.count("*").alias("members")).where("members > 1"))
    members = shared_table(join_groups(spread, buckets, "bucket", "members", classes.count() * n_bands), "buckets")
    # fewer shared shingles than the smaller set has, no fewer in all than the larger
    able = F.expr(f"100 * least(n, other_n) >= {similarity} * greatest(n, other_n)")
    wanted = members.select("key").distinct().join(classes.select("key", "first"), "key")
    wanted = wanted.select("key", F.col("first.id").alias("id2"), F.col("first.print").alias("print2"))
    found = rows.join(wanted.hint("merge"), rows["id"].eqNullSafe(F.col("id2")) & (rows["print"] == F.col("print2")))
    found = found.groupBy("key").agg(F.any_value("text").alias("text"))
    sets = shared_table(found.mapInArrow(_sets, "key binary, shingles array<bigint>"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            own = sets.select(F.col("key").alias(side), F.col("shingles").alias(f"set_{side}"))
            pairs = pairs.join(own.hint("merge"), side)
        return pairs.mapInArrow(_verified(similarity), "a binary, b binary")

    to_hub = (members.where("key != hub").withColumn("other_n", F.col("hub_n")).where(able)
              .select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct())
    links = shared_table(verified(to_hub), "hub-links")
    named = components(links).select(F.col("node").alias("key"), "component")
    placed = (members.select("bucket", "key", "n", "members").join(named, "key", "left")
              .withColumn("component", F.coalesce("component", "key")))
    placed = shared_table(placed, "placed")
    split = (placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                          F.any_value("members").alias("m")).where("low != high"))
    split = join_groups(placed, split.select("bucket", "m"), "bucket", "m", placed.count())
    split = shared_table(split.select("bucket", "key", "n", "component", "m"), "split-buckets")
    few = split.where(F.col("m") <= SMALL)
    other = few.select("bucket", F.col("key").alias("b"), F.col("n").alias("other_n"),
                       F.col("component").alias("other"))
    across = (few.join(other.hint("merge"), "bucket").where("component < other").where(able)
              .select(F.least("key", "b").alias("a"), F.greatest("key", "b").alias("b")).distinct())
    across = across.join(to_hub.hint("merge"), ["a", "b"], "left_anti")  # these are known
    parts = F.ceil(F.col("m") / BLOCK_ROWS)
    block = F.pmod(F.xxhash64("key", "bucket"), parts)
    many = (split.where(F.col("m") > SMALL).withColumn("block", block)
            .withColumn("facing", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
            .withColumn("low", F.least("block", "facing")).withColumn("high", F.greatest("block", "facing"))
            .join(sets.hint("merge"), "key")
            .select("bucket", "low", "high", "block", "key", "component", "shingles"))
    faced = many.groupBy("bucket", "low", "high").applyInArrow(_faced(similarity), "a binary, b binary")
    return links.unionByName(shared_table(verified(across), "cross-links")).unionByName(shared_table(faced, "block-links"))
