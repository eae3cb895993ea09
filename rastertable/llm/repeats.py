"""Repeated byte strings by merged Burrows-Wheeler transforms.

Which bytes lie in a string of ``length`` bytes that also starts elsewhere? Three steps, none of
which loses one:

1. Anchors. A window's anchor is its ``GRAM``-byte string of least hash, the first of equals. Equal
   windows have equal anchors at equal places, so a window whose anchor occurs once does not repeat.
   Neighbouring windows with the same anchor are one run; its bytes are the anchor's context.
   Occurrences with equal contexts form one class with a weight.
2. Classes of one anchor meet. Where there is one class alone, all its windows repeat if it occurs
   twice. Otherwise the contexts' bytes are fetched, shards of them get transforms of bounded order,
   and the shards' interleave is refined a few symbols at a time: after h symbols rows stand in the
   order of the h bytes before their window's end, and rows between two boundaries have these in
   common. Rows alone between boundaries are final and leave, so nothing is sorted anew. After
   ``length`` symbols, what is still together are the repeated intervals.
3. Ranges go back to all occurrences, and meet the documents they belong to.

An anchor with more than ``HOT_CLASSES`` classes is cut by where its windows begin: windows that
begin in the same ``RANGES``-th share all bytes but a few. Equal pieces count as one before they meet,
and pieces that share these bytes but differ are merged as contexts are. Where more than ``HOT_CLASSES``
pieces share them, these are compared window by window, by digests. That and the count of equal pieces
are sums by key and joins that spread a large key over tasks, so no task holds all documents of a passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (flat_bytes, flattened, in_filter, filter_size, join_groups, maybe_repeated, mixed, nested,
                     shared_table, slices, text_or_empty, texts)

LENGTH = 200
GRAM = 50
HOT_CLASSES, RANGES = 2000, 8
#: Bytes of contexts that one task merges at a time, and the shards they are dealt to.
BUCKET_BYTES, SHARDS = 1 << 17, 4

_BASE = 0x9E3779B97F4A7C15 | 1


class Hashes:
    """Polynomial hashes of any substring of some bytes, modulo 2^64."""

    _powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64),) * 2

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Hashes._powers[0]) < n:
            back = pow(_BASE, -1, 1 << 64)
            Hashes._powers = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(
                np.full(n, x, np.uint64), dtype=np.uint64)]) for x in (_BASE, back))
        self.up, self.down = Hashes._powers
        value = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[data] * self.up[:n - 1], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def every(self, size: int) -> np.ndarray:
        """Of each substring of ``size`` bytes."""
        n = max(0, len(self.sums) - size)
        return mixed((self.sums[size:size + n] - self.sums[:n]) * self.down[:n])


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """The least of x[i : i + size] for each i where that is whole."""
    n = len(x) - size + 1
    if n <= 0:
        return x[:0]
    blocks = -(-len(x) // size)
    fill = np.pad(x, (0, blocks * size - len(x)), mode="edge").reshape(blocks, size)
    ahead = np.minimum.accumulate(fill, 1).ravel()
    behind = np.minimum.accumulate(fill[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1:size - 1 + n])


def anchors(data: np.ndarray, at: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor, of texts in a row (bytes and offsets): the anchor's place, its
    text and hash, the hash of the run's bytes, the run's first window and its number of windows."""
    hashes = Hashes(data)
    h = hashes.every(gram)
    bits = np.uint64(max(24, len(data).bit_length()))
    packed = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    anchor = (_least(packed, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[:len(anchor)]
    start = np.flatnonzero(np.arange(length, len(anchor) + length) <= at[owner + 1]) if len(anchor) else owner
    anchor, text = anchor[start], owner[start]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])) \
        if len(start) else start
    count = np.diff(np.concatenate([first, [len(start)]]))
    place, low = anchor[first], start[first]
    context = hashes.of(low, low + count - 1 + length) + (place - low).astype(np.uint64) * np.uint64(257)
    return place, text[first], h[place], mixed(context), low, count


ORDER = 8


def shard_transform(data: np.ndarray) -> np.ndarray:
    """Rows of a shard: its places in the order of the ``ORDER`` bytes that follow each."""
    padded = np.concatenate([data, np.zeros(ORDER, np.uint8)]).astype(np.uint64)
    key = np.zeros(len(data), np.uint64)
    for k in range(ORDER):
        key = key << np.uint64(8) | padded[k:k + len(data)]
    return np.argsort(key)


def _symbols(data: np.ndarray, length: int) -> tuple[int, np.ndarray]:
    """The widest step whose strings are few enough to be 16-bit symbols, and the symbol that ends at
    each place."""
    for width in (4, 2):
        if length % width == 0 and len(data) >= width:
            wide = np.zeros(len(data) + 1, np.uint32)
            for k in range(width):
                wide[width:] = wide[width:] << np.uint32(8) | data[k:len(data) - width + 1 + k]
            found, symbol = np.unique(wide, return_inverse=True)
            if len(found) < 1 << 16:
                return width, symbol.ravel().astype(np.uint16)
    return 1, np.concatenate([[0], data]).astype(np.uint16)


def merged_intervals(strings: list[bytes], colour: np.ndarray, lead: np.ndarray, length: int,
                     shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the strings that equal another one of their colour at the same place.

    ``lead`` is the anchor's place in each string; windows are compared where their anchors are. Returns
    string, first byte and interval of each such window; windows of an interval are equal.
    """
    dealt = np.concatenate([np.arange(k, len(strings), shards) for k in range(shards)])
    size = np.array([len(s) for s in strings], np.int64)[dealt]
    data = np.frombuffer(b"".join(strings[i] for i in dealt), np.uint8)
    begin = np.cumsum(size) - size
    place_of_row, base = [], 0
    for k in range(shards):
        n = int(size[np.flatnonzero(dealt % shards == k)].sum())
        place_of_row.append(shard_transform(data[base:base + n]) + base)
        base += n
    place_of_row = np.concatenate(place_of_row).astype(np.int32)
    row_of_place = np.empty(len(data) + 1, np.int32)
    row_of_place[place_of_row] = np.arange(len(data), dtype=np.int32)
    row_of_place[-1] = len(data)  # the end of all strings has no bytes behind it
    place_of_row = np.append(place_of_row, np.int32(len(data)))
    width, symbol_at = _symbols(data, length)
    symbol = symbol_at[place_of_row]  # what stands before each row
    step = row_of_place[np.maximum(place_of_row - width, 0)]  # the row that this leads to
    # one row per window: the place behind it, coloured by group and distance to the anchor
    windows = size - length + 1
    which = np.repeat(np.arange(len(size)), windows)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    tone = colour[dealt][which] * np.int64(4 * length) + inside - lead[dealt][which] + 2 * length
    row = row_of_place[begin[which] + inside + length]
    order = np.lexsort((row, tone))
    row, tone, window = row[order], tone[order], order.astype(np.int32)
    block = np.cumsum(np.concatenate([[True], tone[1:] != tone[:-1]]), dtype=np.int32) if len(row) else row

    def together(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are not alone between boundaries, and where boundaries are."""
        edge = np.ones(len(keys[0]) + 1, bool)
        edge[1:-1] = keys[0][1:] != keys[0][:-1]
        for key in keys[1:]:
            edge[1:-1] |= key[1:] != key[:-1]
        return ~(edge[:-1] & edge[1:]), edge[:-1]

    keep, _ = together(block)
    row, block, window = row[keep], block[keep], window[keep]
    for _ in range(length // width):
        if not len(row):
            break
        c = symbol[row]
        order = np.argsort(c, kind="stable")
        c, block, row = c[order], block[order], step[row[order]]
        keep, edge = together(c, block)
        window = window[order][keep]
        row, block = row[keep], np.cumsum(edge[keep], dtype=np.int32)
    return dealt[which[window]], inside[window], block


def _anchored(length: int, gram: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, at = flat_bytes(texts(part))
                place, text, h, context, low, count = anchors(data, at, length, gram)
                which = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(which), part.column("print").take(which),
                     pa.array((place - at[text]).astype(np.int32)), pa.array(h.view(np.int64)),
                     pa.array(context.view(np.int64)), pa.array((place - low).astype(np.int16)),
                     pa.array(count.astype(np.int16))],
                    ["id", "print", "place", "anchor", "context", "lead", "windows"])
    return run


def _fetched(length: int):
    """The bytes of wanted contexts."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text, wanted in zip(part.column("text").to_pylist(), part.column("wanted").to_pylist()):
                    data = text.encode("utf-8", "surrogatepass")
                    for w in wanted:
                        first = w["place"] - w["lead"]
                        rows.append((w["anchor"], w["context"], w["weight"], w["lead"],
                                     data[first:first + w["windows"] - 1 + length]))
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64()] * 3 + [pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["anchor", "context", "weight", "lead", "bytes"])
    return run


def _cut(length: int, gram: int):
    """Wanted contexts cut by where their windows begin: the bytes of each piece and their digest, and
    a hash of the bytes that all windows of its range hold."""
    edges = np.linspace(0, length - gram + 1, RANGES + 1).astype(int).tolist()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text, wanted in zip(part.column("text").to_pylist(), part.column("wanted").to_pylist()):
                    data = text.encode("utf-8", "surrogatepass")
                    for w in wanted:
                        p, most_lead, least_lead = w["place"], w["lead"], w["lead"] - w["windows"] + 1
                        for least, beyond in zip(edges[:-1], edges[1:]):
                            # windows of this range begin high .. low bytes before the anchor
                            high, low = min(most_lead, beyond - 1), max(least_lead, least)
                            if high < low:
                                continue
                            piece, core = data[p - high:p - low + length], data[p - least:p + length - beyond + 1]
                            group = hashlib.blake2b(core + b"%d %d" % (w["anchor"], least), digest_size=8).digest()
                            own = hashlib.blake2b(piece + b"%d %d" % (w["anchor"], high), digest_size=16).digest()
                            rows.append((w["anchor"], w["context"], w["weight"],
                                         int.from_bytes(group, "little", signed=True), least, high, own, piece))
                columns = list(zip(*rows)) or [()] * 8
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["anchor", "context", "weight", "grp", "least", "lead", "piece", "bytes"])
    return run


def _windows(length: int):
    """Each window of a piece: its place there, and a digest of its bytes, anchor and place before it."""
    def run(batches):
        for batch in batches:
            rows = []
            for piece, anchor, lead, data in zip(*(batch.column(c).to_pylist() for c in ("piece", "anchor", "lead", "bytes"))):
                for k in range(len(data) - length + 1):
                    own = hashlib.blake2b(data[k:k + length] + b"%d %d" % (anchor, lead - k), digest_size=16).digest()
                    rows.append((piece, k, own))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int32(), pa.binary()))],
                                             ["piece", "at", "window"])
    return run


def _merged(length: int):
    def run(key, table):
        column = {name: table.column(name).to_pylist() for name in table.column_names}
        once: dict[tuple, int] = {}
        weight: list[int] = []
        of, seen = [], set()
        for k, name in enumerate(zip(column["anchor"], column["lead"], column["bytes"])):
            i = once.setdefault(name, len(once))
            if i == len(weight):
                weight.append(0)
            own = column["anchor"][k], column["context"][k]
            if own not in seen:  # rows of a repeated document are one
                seen.add(own)
                weight[i] += column["weight"][k]
            of.append(i)
        names, weights = list(once), np.array(weight, np.int64)
        colour = np.unique(np.array([n[0] for n in names], np.int64), return_inverse=True)[1].ravel()
        lead = np.array([n[1] for n in names], np.int64)
        which, first, _ = merged_intervals([n[2] for n in names], colour, lead, length)
        # a context that occurs twice repeats by itself
        sizes = np.array([len(n[2]) for n in names], np.int64)
        heavy = np.flatnonzero(weights > 1)
        light = weights[which] == 1
        which, first = which[light], first[light]
        order = np.lexsort((first, which))
        which, first = which[order], first[order]
        gap = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (first[1:] > first[:-1] + 1), [True]])) \
            if len(which) else np.zeros(1, int)
        covered: list[list[int]] = [[] for _ in names]
        for a, b in zip(gap[:-1].tolist(), gap[1:].tolist()):
            covered[which[a]] += [int(first[a]), int(first[b - 1]) + length]
        for i in heavy.tolist():
            covered[i] = [0, int(sizes[i])]
        found = [k for k, i in enumerate(of) if covered[i]]
        return pa.table({"anchor": pa.array([column["anchor"][k] for k in found], pa.int64()),
                         "context": pa.array([column["context"][k] for k in found], pa.int64()),
                         "ranges": pa.array([[x - column["lead"][k] for x in covered[of[k]]] for k in found],
                                            pa.list_(pa.int32()))})
    return run


def _removed(with_text: bool):
    def run(batches):
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                data, spans = text.encode("utf-8", "surrogatepass"), []
                for a, b in sorted((r["a"], r["b"]) for r in ranges or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                edges = [0, *(x for s in spans for x in s), len(data)]
                out.append((spans, len(data), sum(b - a for a, b in spans),
                            b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))))
            spans, size, gone, kept = zip(*out) if out else ((),) * 4
            columns = {
                "row": batch.column("row"), "n_bytes": pa.array(size, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array([len(s) for s in spans], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                "removed": pa.array([[x for s in y for x in s] for y in spans], pa.list_(pa.int64()))}
            if with_text:
                columns["kept_text"] = pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())
            yield pa.RecordBatch.from_pydict(columns)
    return run


RESULTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept_text")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, with_columns: list[str] | None = None,
                   with_text: bool = True) -> DataFrame:
    """Every input row with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``removed`` (starts
    and ends of the removed runs in turn) and ``kept_text`` (the rest; a cut character shows as U+FFFD).

    Texts are UTF-8 bytes, null as empty; a text shorter than ``length`` keeps all. Rows that repeat
    both id and text are texts of their own, so all of them are removed where they are long enough.
    ``length`` is at least ``gram``, the bytes an anchor is made of.
    """
    if not 1 <= gram <= length:
        raise ValueError(f"length is at least {gram}, the bytes of an anchor, not {length}")
    carried = docs.columns if with_columns is None else list(with_columns)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    kind = rows.schema["id"]
    found = shared_table(rows.mapInArrow(_anchored(length, gram), T.StructType([kind, *T._parse_datatype_string(
        "print bigint, place int, anchor bigint, context bigint, lead smallint, windows smallint").fields])), "anchors")
    n = found.count()
    found = shared_table(maybe_repeated(found, F.col("anchor"), n).where("maybe").drop("maybe"), "repeated-anchors")
    n = found.count()
    classes = shared_table(found.groupBy("anchor", "context").agg(
        F.count("*").alias("weight"), F.min(F.struct("id", "print", "place", "lead", "windows")).alias("first")), "contexts")
    groups = classes.groupBy("anchor").agg(F.sum("weight").alias("occurrences"), F.count("*").alias("classes"))
    placed = join_groups(classes, groups.where("occurrences > 1"), "anchor", "classes", n)
    placed = shared_table(placed, "placed")
    begin = -F.col("first.lead").cast("int")
    lone = placed.where("classes = 1").select("anchor", "context", F.array(
        begin, begin + F.col("first.windows").cast("int") + (length - 1)).alias("ranges"), "weight")
    several = _several(rows, placed.where("classes > 1").where(F.col("classes") <= HOT_CLASSES), length, gram)
    hot = placed.where("classes > 1").where(F.col("classes") > HOT_CLASSES)
    if not hot.isEmpty():
        several = several.unionByName(_hot(rows, hot, length, gram))
    ranges = (several.groupBy("anchor", "context").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
              .join(placed.select("anchor", "context", "weight"), ["anchor", "context"]).select(*lone.columns))
    ranges = shared_table(lone.unionByName(ranges), "ranges")
    hits = join_groups(found, ranges, ["anchor", "context"], "weight", n)
    pair = F.struct((F.col("place") + F.col("r.a")).alias("a"), (F.col("place") + F.col("r.b")).alias("b"))
    halves = F.transform(F.sequence(F.lit(0), (F.size("ranges") / 2).cast("int") - 1), lambda i: F.struct(
        F.get("ranges", 2 * i).alias("a"), F.get("ranges", 2 * i + 1).alias("b")))
    spans = (hits.select("id", "print", "place", F.explode(halves).alias("r")).select("id", "print", pair.alias("s"))
             .groupBy("id", "print").agg(F.collect_set("s").alias("ranges")))
    spans = spans.select(F.col("id").alias("id2"), F.col("print").alias("print2"), "ranges")
    whole = nested(docs, id=F.col(f"`{id_col}`"), text=text_or_empty(f"`{text_col}`"))
    whole = whole.withColumn("print", F.xxhash64("text")).withColumn(
        "row", F.struct(*[F.col("row").getField(c).alias(c) for c in carried]))
    both = whole.join(spans.hint("merge"), F.col("id").eqNullSafe(F.col("id2")) & (F.col("print") == F.col("print2")), "left")
    more = T._parse_datatype_string("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                                    "removed array<bigint>" + ", kept_text string" * with_text).fields
    out = both.select("row", "text", "ranges").mapInArrow(
        _removed(with_text), T.StructType([both.schema["row"], *more]))
    return flattened(out, *RESULTS[:len(more)])


def _with_wanted(rows: DataFrame, classes: DataFrame) -> tuple[DataFrame, int]:
    """Texts that hold the first occurrence of a class, with these occurrences; and their number."""
    wanted = classes.select("first.*", "anchor", "context", "weight")
    per_row = (wanted.groupBy(F.col("id").alias("id2"), F.col("print").alias("print2"))
               .agg(F.collect_list(F.struct("place", "lead", "windows", "anchor", "context", "weight")).alias("wanted")))
    per_row = shared_table(per_row, "wanted")
    size = per_row.agg(F.coalesce(F.sum(F.size("wanted")), F.lit(0)), F.count("*")).first()
    near = in_filter(rows, F.xxhash64("id", "print"), per_row.select(F.xxhash64("id2", "print2").alias("h")),
                     filter_size(4 * size[1])).where("maybe")
    both = near.join(per_row.hint("merge"), near["id"].eqNullSafe(F.col("id2")) & (near["print"] == F.col("print2")))
    return both.select("text", "wanted"), size[0]


def _several(rows: DataFrame, classes: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, context, ranges) of contexts that differ but share an anchor."""
    both, n = _with_wanted(rows, classes)
    found = both.mapInArrow(_fetched(length), "anchor bigint, context bigint, weight bigint, lead int, bytes binary")
    return _met(found, n * (2 * length - gram), length)


def _met(strings: DataFrame, size: int, length: int) -> DataFrame:
    """(anchor, context, ranges) of strings whose anchors are equal, merged in buckets of about
    ``BUCKET_BYTES``, of ``size`` bytes in all; an anchor has at most ``HOT_CLASSES`` of them."""
    dealt = strings.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(max(1, size // BUCKET_BYTES))))
    return dealt.groupBy("bucket").applyInArrow(_merged(length), "anchor bigint, context bigint, ranges array<int>")


def _hot(rows: DataFrame, classes: DataFrame, length: int, gram: int) -> DataFrame:
    """``_several`` for anchors with any number of contexts."""
    both, _ = _with_wanted(rows, classes)
    cut = shared_table(both.mapInArrow(_cut(length, gram), "anchor bigint, context bigint, weight bigint, grp bigint, "
                                                           "least int, lead int, piece binary, bytes binary"), "cut")
    place = ["anchor", "context", "least"]
    own = cut.withColumn("size", F.length("bytes")).drop("bytes")
    own = shared_table(own.dropDuplicates(place), "pieces-of-contexts")  # rows of a repeated document are one
    pieces = shared_table(own.groupBy("piece", "grp", "anchor", "least", "lead", "size").agg(
        F.min("context").alias("context"), F.sum("weight").alias("weight"), F.count("*").alias("contexts")), "pieces")
    groups = pieces.groupBy("grp").agg(F.count("*").alias("rivals")).where("rivals > 1")
    rivals = shared_table(join_groups(pieces, groups, "grp", "rivals", pieces.count()).select(
        *place, "grp", "piece", "lead", "rivals"), "rivals")

    def with_bytes(some: DataFrame, n: int) -> DataFrame:
        held = in_filter(cut.select(*place, "bytes"), F.xxhash64(*place), some.select(F.xxhash64(*place).alias("h")),
                         filter_size(4 * n)).where("maybe").drop("maybe").dropDuplicates(place)
        return held.join(some.hint("merge"), place)

    few, many = rivals.where(F.col("rivals") <= HOT_CLASSES), rivals.where(F.col("rivals") > HOT_CLASSES)
    n_few, n_many = few.count(), many.count()
    # a piece is named by its group and the least of its contexts
    merged = _met(with_bytes(few, n_few).select(F.col("grp").alias("anchor"), "context", F.lit(1).cast("bigint").alias("weight"),
                                                "lead", "bytes"), n_few * (length + (length - gram) // RANGES), length)
    found = pieces.join(merged.select(F.col("anchor").alias("grp"), "context", F.col("ranges").alias("met")),
                        ["grp", "context"], "left")
    some = F.col("met")
    if n_many:
        windows = shared_table(with_bytes(many, n_many).select("piece", "anchor", "lead", "bytes").mapInArrow(
            _windows(length), "piece binary, at int, window binary"), "windows")
        equal = windows.groupBy("window").agg(F.count("*").alias("pieces")).where("pieces > 1")
        shared = (join_groups(windows, equal, "window", "pieces", windows.count())
                  .groupBy("piece").agg(F.collect_set("at").alias("at")))
        starts = F.sort_array(F.filter("at", lambda k: ~F.array_contains("at", k - 1)))
        ends = F.sort_array(F.filter("at", lambda k: ~F.array_contains("at", k + 1)))
        some = F.coalesce(some, F.flatten(F.zip_with(
            starts, ends, lambda a, b: F.array(a - F.col("lead"), b - F.col("lead") + length))))
        found = found.join(shared, "piece", "left")
    # a piece that occurs twice repeats by itself
    ranges = F.when(F.col("weight") > 1, F.array(-F.col("lead"), F.col("size") - F.col("lead"))).otherwise(some)
    found = found.select("piece", "contexts", ranges.alias("ranges")).where("ranges IS NOT NULL")
    return (join_groups(own.select("piece", "anchor", "context"), shared_table(found, "pieces-that-repeat"), "piece",
                        "contexts", own.count()).select("anchor", "context", "ranges"))
