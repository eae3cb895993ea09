"""Tiles of equal key combined into one, as arrays.

Partial results are combined before the shuffle: a task keeps one accumulator per key it meets and
passes these on. After the shuffle the partial results of a key arrive one after another and only
one accumulator is held. So a key may repeat without bound, even one that most tiles share: what is
shuffled of it is an accumulator per task. Whole numbers are added and compared as 64-bit integers
beside a validity mask, so no value is rounded on the way.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of accumulators that a task holds before it passes them on.
HELD_BYTES = 64 * 1024 * 1024
#: Bytes of a batch that are worked on, or passed on, at once.
PART_BYTES = 4 * 1024 * 1024
#: Rank of a cell without data: higher than any other.
NO_RANK = np.iinfo(np.int64).max


# --- cells in Arrow --------------------------------------------------------------------------

def read_cells(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of all lists in a row (integers or doubles), which of them are data, where lists end.

    Of a slice of a column, the values of its own lists only."""
    ends = column.offsets.to_numpy()
    values, ends = column.values.slice(ends[0], ends[-1] - ends[0]), ends - ends[0]
    if pa.types.is_integer(values.type):
        ok = values.is_valid().to_numpy(zero_copy_only=False)
        return pc.fill_null(values, 0).to_numpy(zero_copy_only=False), ok, ends
    flat = values.to_numpy(zero_copy_only=False)
    return flat, ~np.isnan(flat), ends


def write_cells(rows: list[np.ndarray], ok: list[np.ndarray] | None = None) -> pa.ListArray:
    """Lists from arrays of one type; null where ``ok`` is false."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    mask = None if ok is None else ~np.concatenate(ok)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows), mask=mask))


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows of about PART_BYTES: copies made of a run stay small, however large
    the batches are that Spark sends."""
    for batch in batches:
        rows = max(1, len(batch) * PART_BYTES // max(1, batch.nbytes))
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)


# --- accumulators ----------------------------------------------------------------------------

class Fold:
    """What cells of equal place become. A state is a tuple of arrays, one element per cell.

    ``types`` are those of the state, ``empty`` the state of a cell nothing was seen of.
    """
    types: tuple[str, ...]
    empty: tuple

    def lift(self, v: np.ndarray, ok: np.ndarray, rank) -> tuple:
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def finish(self, state: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which cells have one."""
        raise NotImplementedError


class First(Fold):
    """The value of the lowest rank that has data; of equal ranks the smaller value."""

    def __init__(self, number: str):
        self.types, self.empty = (number, "bigint"), (0, NO_RANK)

    def lift(self, v, ok, rank):
        return np.where(ok, v, 0), np.where(ok, rank, NO_RANK)

    def merge(self, a, b):
        later = (b[1] < a[1]) | ((b[1] == a[1]) & (b[0] < a[0]))
        return np.where(later, b[0], a[0]), np.where(later, b[1], a[1])

    def finish(self, state):
        return state[0], state[1] != NO_RANK


class Sum(Fold):
    """Sum where every one has data."""

    def __init__(self, number: str):
        self.types, self.empty = (number, "bigint"), (0, 0)

    def lift(self, v, ok, rank):
        return np.where(ok, v, 0), (~ok).astype(np.int64)

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def finish(self, state):
        return state[0], state[1] == 0


class Extreme(Fold):
    def __init__(self, number: str, least: bool):
        self.types, self.empty, self.pick = (number, "bigint"), (0, 0), np.minimum if least else np.maximum

    def lift(self, v, ok, rank):
        return np.where(ok, v, 0), ok.astype(np.int64)

    def merge(self, a, b):
        both = self.pick(a[0], b[0])
        return np.where(a[1] == 0, b[0], np.where(b[1] == 0, a[0], both)), a[1] | b[1]

    def finish(self, state):
        return state[0], state[1] != 0


class Mean(Fold):
    def __init__(self, number: str):
        self.types, self.empty = (number, "bigint"), (0, 0)

    def lift(self, v, ok, rank):
        return np.where(ok, v, 0), ok.astype(np.int64)

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def finish(self, state):
        return state[0] / np.maximum(state[1], 1), state[1] != 0


class Spread(Fold):
    """Variance or standard deviation of a sample: count, mean and squared distances."""
    types, empty = ("bigint", "double", "double"), (0, 0.0, 0.0)

    def __init__(self, root: bool):
        self.root = root

    def lift(self, v, ok, rank):
        return ok.astype(np.int64), np.where(ok, v, 0).astype(float), np.zeros(v.shape)

    def merge(self, a, b):
        n = a[0] + b[0]
        share, gap = b[0] / np.maximum(n, 1), b[1] - a[1]
        return n, a[1] + gap * share, a[2] + b[2] + gap * gap * a[0] * share

    def finish(self, state):
        variance = state[2] / np.maximum(state[0] - 1, 1)
        return np.sqrt(variance) if self.root else variance, state[0] > 1


def fold_named(op: str, number: str) -> Fold:
    """The accumulator of an operation over ``number`` cells (bigint or double)."""
    if op in ("Min", "Max"):
        return Extreme(number, op == "Min")
    if op in ("Variance", "StandardDeviation"):
        return Spread(op == "StandardDeviation")
    return {"First": First, "Sum": Sum, "Mean": Mean}[op](number)


def fold_tiles(df: DataFrame, keys: list[str], flat: Column, n: int, op: str, number: str,
               rank: Column | None = None) -> DataFrame:
    """One row per key with ``flat``, the cells of all its rows combined.

    ``flat`` holds cells of type ``number`` (bigint or double), up to ``n`` of them, the result as many
    as the shortest row of a key. For "First", each cell comes from the row with the lowest rank that
    has data there, the smaller value where ranks are equal; a rank is a whole number, null the last.
    The result does not depend on the order of rows, but for the last bits of sums of doubles.
    """
    fold = fold_named(op, number)
    names = [f"s{i}" for i in range(len(fold.types))]
    last = F.lit(NO_RANK - 1)
    rows = df.select(*keys, flat.cast(f"array<{number}>").alias("flat"),
                     (F.lit(0).cast("bigint") if rank is None else
                      F.least(F.coalesce(rank.cast("bigint"), last), last)).alias("rank"))
    types = dict(rows.dtypes)
    head = ", ".join(f"{k} {types[k]}" for k in keys)
    result = "double" if op in ("Mean", "Variance", "StandardDeviation") else number

    def merged(a: tuple, b: tuple) -> tuple:
        size = min(len(a[0]), len(b[0]))
        return fold.merge(tuple(x[:size] for x in a), tuple(x[:size] for x in b))

    def table(found: list[tuple], key_types: list, columns: list[pa.Array], names_: list[str]) -> pa.RecordBatch:
        out = [pa.array([k[i] for k in found], t) for i, t in enumerate(key_types)]
        return pa.RecordBatch.from_arrays([*out, *columns], [*keys, *names_])

    def states(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Rows of partial results."""
        parts = []
        for name in names:
            values, _, ends = read_cells(batch.column(name))
            parts.append([values[a:b] for a, b in zip(ends, ends[1:])])
        return zip(*parts)

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        key_types: list = []
        size = n * 8 * len(names)

        def passed_on() -> Iterator[pa.RecordBatch]:
            """What is held, let go part by part."""
            while held:
                found = list(islice(held, max(1, PART_BYTES // size)))
                states = [held.pop(key) for key in found]
                columns = [write_cells([state[i] for state in states]) for i in range(len(names))]
                yield table(found, key_types, columns, names)

        for batch in in_parts(batches):
            key_types = [batch.schema.field(k).type for k in keys]
            found = zip(*[batch.column(k).to_pylist() for k in keys])
            ranks = batch.column("rank").to_pylist()
            values, ok, ends = read_cells(batch.column("flat"))
            for key, r, a, b in zip(found, ranks, ends, ends[1:]):
                state = fold.lift(values[a:b], ok[a:b], r)
                held[key] = merged(held[key], state) if key in held else state
                if len(held) * size > HELD_BYTES:
                    yield from passed_on()
        yield from passed_on()

    def after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, key_types = None, None, []

        def finished(done: list[tuple]) -> pa.RecordBatch:
            ends = [fold.finish(s) for _, s in done]
            return table([k for k, _ in done], key_types, [write_cells([v for v, _ in ends], [o for _, o in ends])], ["flat"])

        for batch in in_parts(batches):
            key_types = [batch.schema.field(k).type for k in keys]
            done: list[tuple] = []
            found = zip(*[batch.column(k).to_pylist() for k in keys])
            for key, part in zip(found, states(batch)):
                if key == last:
                    state = merged(state, part)
                    continue
                if last is not None:
                    done.append((last, state))
                last, state = key, tuple(x.copy() for x in part)
            if done:
                yield finished(done)
        if last is not None:
            yield finished([(last, state)])

    listed = ", ".join(f"{name} array<{t}>" for name, t in zip(names, fold.types))
    partial = rows.mapInArrow(before, f"{head}, {listed}")
    met = partial.repartition(*keys).sortWithinPartitions(*keys)
    return met.mapInArrow(after, f"{head}, flat array<{result}>")


def shared_bands(n_cells: int, element: str) -> Column:
    """The bands of a ``flat`` column, as many as it holds."""
    last = (F.size("flat") / n_cells).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice("flat", b * n_cells + 1, n_cells)).cast(
        f"array<array<{element}>>")


def unflatten(n_cells: int, bands: int, element: str) -> Column:
    """The bands of a ``flat`` column."""
    return F.array(*[F.slice("flat", b * n_cells + 1, n_cells) for b in range(bands)]).cast(
        f"array<array<{element}>>")
