"""What several operators share: result columns beside clashing input columns, slices of Arrow
batches, words as Arrow arrays, tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import run_folder

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text a task looks at in one go.
SLICE_BYTES = 4 << 20


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def nested(df: DataFrame, **more: Column) -> DataFrame:
    """The input row as one column ``row``, so that no other column can clash with its columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(name) for name, c in more.items()])


def flattened(df: DataFrame, *results: str) -> DataFrame:
    """The columns of ``row``, then ``results``; an input column named like a result gives way."""
    taken = {r.lower() for r in results}
    kept = [f for f in df.schema["row"].dataType.names if f.lower() not in taken]
    return df.select(*[F.col("row").getField(f).alias(f) for f in kept], *results)


def shared_table(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows starts from files that
    outlive any executor, and work that several consumers need is done once."""
    path = run_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes of text each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes.astype(np.int64)), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def give_back() -> None:
    """Return what a Python worker has freed to the system. Workers live on from stage to stage, and what
    their allocators keep after one would count beside what the next one needs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_string or large_binary array without nulls, and its offsets."""
    array = pa.concat_arrays([array])
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    return data[first:offsets[-1]] if len(offsets) else data[:0], offsets - first


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """A batch's texts, null as empty, in buffers of their own: some string kernels misread the
    offsets of a slice."""
    array = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    data, offsets = flat_bytes(array)
    return pa.LargeStringArray.from_buffers(len(array), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(data))


def words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and the offset at which those of each text begin."""
    lists = pc.ascii_split_whitespace(text)
    flat = lists.flatten()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # blank ends of a text give ''
    if not full.all():
        owner = np.repeat(np.arange(len(size)), size)[full]
        flat, size = flat.filter(pa.array(full)), np.bincount(owner, minlength=len(size))
    return flat, np.concatenate([[0], np.cumsum(size)]).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the result."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


#: At most this many groups are hot, whatever the number of rows.
HOT_PART = 4096


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str,
                total: int) -> DataFrame:
    """``rows`` with the row of ``groups`` (one per key) of the same key; inner.

    ``size`` is the number of rows of a key and ``total`` that of all rows. Keys with a HOT_PART-th of
    all rows or more are few by that count, so their part of ``groups`` is broadcast and their rows
    stay where they are. All other rows shuffle, no key of theirs being large.
    """
    many = max(200, total // HOT_PART)
    marked = rows.join(F.broadcast(groups.where(F.col(size) >= many)), key, "left")
    few = (marked.where(F.col(size).isNull()).select(*rows.columns)
           .join(groups.where(F.col(size) < many).hint("merge"), key))
    return marked.where(F.col(size).isNotNull()).unionByName(few)


#: Bound of a broadcast Bloom filter: 2^21 words of 64 bits, 16 MiB of bits.
FILTER_WORDS = 1 << 21


def _bits(h: Column, words: int) -> list[tuple[Column, Column]]:
    """Word and mask of both bits of a hash."""
    places = [F.pmod(F.xxhash64(h, F.lit(seed)), F.lit(words * 64)) for seed in (1, 2)]
    one = F.lit(1).cast("bigint")
    return [(F.shiftright(p, 6).alias("word"),
             F.call_function("shiftleft", one, p.bitwiseAND(63).cast("int")).alias("mask"))
            for p in places]


def filter_size(n: int, most: int = FILTER_WORDS) -> int:
    """Words for ``n`` hashes at 16 bits each, within the bound of a broadcast."""
    return min(most, 1 << max(4, (n // 4).bit_length()))


def in_filter(rows: DataFrame, h: Column, hashes: DataFrame, words: int) -> DataFrame:
    """``rows`` and ``maybe``: false only where ``h`` is not among ``hashes`` (a column ``h``).

    Rows stay where they are; the filter's words are broadcast, ``words`` at most. A filter too small
    for its hashes says true more often, never false in error.
    """
    bits = F.array(*[F.struct(word, mask) for word, mask in _bits(F.col("h"), words)])
    table = (hashes.select(F.explode(bits).alias("b")).groupBy("b.word")
             .agg(F.bit_or("b.mask").alias("mask")))
    probed, known = rows.withColumn("__h", h), []
    for i, (word, mask) in enumerate(_bits(F.col("__h"), words)):
        held = table.select(F.col("word").alias(f"__word{i}"), F.col("mask").alias(f"__held{i}"))
        probed = (probed.withColumn(f"__word{i}", word).withColumn(f"__mask{i}", mask)
                  .join(F.broadcast(held), f"__word{i}", "left"))
        known.append(F.coalesce(F.col(f"__held{i}").bitwiseAND(F.col(f"__mask{i}")) != 0, F.lit(False)))
    return probed.select(*rows.columns, (known[0] & known[1]).alias("maybe"))


SLOTS_PER_ROW = 64


def maybe_repeated(rows: DataFrame, h: Column, n: int, words: int | None = None) -> DataFrame:
    """``rows`` and ``maybe``: false only where no other of the ``n`` rows has an equal ``h``.

    Pass one counts slots, 64 per row, dealt over all tasks: one slot of 8 bytes per row shuffles. Pass
    two is a Bloom filter of the slots that were taken twice, which every row probes in place.
    """
    slot = F.pmod(h, F.lit(max(1, SLOTS_PER_ROW * n)))
    twice = rows.select(slot.alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    return in_filter(rows, slot, twice.select("h"), words or filter_size(n))
