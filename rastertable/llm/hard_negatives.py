"""Hard negatives by a secondary sort: pairs travel under the key (anchor, descending score, id).

Anchors are a stated query set against all rows. They are dealt in blocks, the rows in sections; a task
holds one block and streams one section through it, so every pair is scored once and none is written.
What a section hands on is small: for each anchor its best rows of the same label, and, once an anchor's
positives are known, the first rows of other labels in each positive's window. These pairs are shuffled
by anchor and sorted by key; a streaming pass then meets an anchor's positives and negatives from the top
score down. A positive opens a window, negatives inside fill it, and nothing but the open windows is held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_table

#: Anchors that a task holds at once, rows that it scores at once, rows of a section at most.
BLOCK, BATCH, SECTION = 2048, 1024, 1 << 20
NOTHING = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Mining:
    """Positives an anchor has, negatives each of them gets, and the window in percent: a negative's
    score s fulfils ``low * positive <= 100 * s <= high * positive``."""
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _usable(vector: Column, scale: int) -> Column:
    """Whether all components are finite and any score of two such vectors fits a long."""
    most = F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size(vector), F.lit(1))) - 1
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(
        F.abs(x.cast("double") * scale) <= most, F.lit(False))), F.lit(False))


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``; both hold whole numbers."""
    if not a.shape[1] or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _first(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores of every line, in order; of equal scores the one further left
    comes first. NOTHING marks places without a score and comes last."""
    width = scores.shape[1]
    held = scores[scores != NOTHING]
    if width > k and held.size and max(abs(int(held.max())), abs(int(held.min()))) < (1 << 62) // width:
        last = width - 1 - np.arange(width)
        keyed = np.where(scores == NOTHING, NOTHING + last, scores * width + last)  # no two are equal
        keyed = np.sort(np.partition(keyed, width - k, axis=1)[:, width - k:], axis=1)[:, ::-1]
        return width - 1 - np.where(keyed < NOTHING + width, keyed - NOTHING, keyed % width)
    return np.argsort(-np.maximum(scores, NOTHING + 1), axis=1, kind="stable")[:, :k]


class _Best:
    """The first k rows of every line by score, over a stream of columns in ascending order of id."""

    def __init__(self, lines: int, k: int):
        self.k, self.scores = k, np.empty((lines, 0), np.int64)
        self.names = np.empty((lines, 0, 2), np.int64)  # id and uid

    def add(self, scores: np.ndarray, names: np.ndarray) -> None:
        place = _first(scores, self.k)
        both = np.concatenate([self.scores, np.take_along_axis(scores, place, 1)], 1)
        named = np.concatenate([self.names, names[place]], 1)
        place = _first(both, self.k)
        self.scores = np.take_along_axis(both, place, 1)
        self.names = np.take_along_axis(named, place[:, :, None], 1)

    def pairs(self) -> np.ndarray:
        """Line, score, id, uid."""
        line, place = np.nonzero(self.scores != NOTHING)
        return np.column_stack([line, self.scores[line, place], self.names[line, place]])


PAIR = ["anchor", "anchor_id", "score", "id", "uid"]


class _Section:
    """One block of anchors while one section streams by; vectors of another length have no score."""

    def __init__(self, how: Mining, windowed: bool):
        self.how, self.windowed, self.parts, self.best = how, windowed, [], []

    def _open(self) -> None:
        """All anchors are here: matrices by length of vector, an empty list of best rows per window."""
        block = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
        self.uid, self.id, self.label = (block.column(c).to_numpy() for c in ("uid", "id", "label"))
        vector = _vectors(block)
        lengths = np.array([len(v) for v in vector])
        self.groups = [(lines, np.stack([vector[i] for i in lines]))
                       for lines in (np.flatnonzero(lengths == n) for n in np.unique(lengths))]
        if self.windowed:
            self.top = np.full((len(self.uid), self.how.positives), NOTHING)
            for i, scores in enumerate(block.column("windows").to_pylist()):
                self.top[i, :len(scores)] = scores
        count, k = (self.how.positives, self.how.negatives) if self.windowed else (1, self.how.positives)
        self.best = [_Best(len(self.uid), k) for _ in range(count)]

    def rows(self, part: pa.RecordBatch) -> None:
        if not self.parts:
            return
        if not self.best:
            self._open()
        uid, ids, label = (part.column(c).to_numpy() for c in ("uid", "id", "label"))
        vector = _vectors(part)
        lengths = np.array([len(v) for v in vector])
        scores = np.full((len(self.uid), len(uid)), NOTHING)
        for lines, matrix in self.groups:
            mine = np.flatnonzero(lengths == matrix.shape[1])
            if len(mine):
                scores[np.ix_(lines, mine)] = _scores(matrix, np.stack([vector[i] for i in mine]))
        same = self.label[:, None] == label[None, :]
        names = np.column_stack([ids, uid])
        if not self.windowed:
            scores[~same | (self.uid[:, None] == uid[None, :])] = NOTHING
            self.best[0].add(scores, names)
            return
        scores[same] = NOTHING
        for j, best in enumerate(self.best):
            low, high = _window(self.top[:, j], self.how)
            inside = (scores >= low[:, None]) & (scores <= high[:, None]) & (self.top[:, j] != NOTHING)[:, None]
            best.add(np.where(inside, scores, NOTHING), names)

    def pairs(self) -> Iterator[pa.RecordBatch]:
        """Each pair once, though windows overlap."""
        if self.best:
            found = np.unique(np.concatenate([b.pairs() for b in self.best]), axis=0)
            line, score, ids, uid = found.T
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (
                self.uid[line], self.id[line], score, ids, uid)], PAIR)


def _window(top: np.ndarray, how: Mining) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score in the window of a positive: low * p <= 100 * s <= high * p.

    Quotient and remainder by 100 keep the products far from the bounds of a long."""
    def times(percent: int, up: bool) -> np.ndarray:
        whole, rest = np.divmod(top, 100)
        part = rest * percent
        return whole * percent + (-(-part // 100) if up else part // 100)

    top = np.where(top == NOTHING, 0, top)
    return times(how.low, True), times(how.high, False)


def _vectors(part: pa.RecordBatch) -> list[np.ndarray]:
    lists = part.column("vector")
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    ends = ends - ends[0]
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _swept(rows: DataFrame, anchors: DataFrame, n: int, n_anchors: int, how: Mining) -> DataFrame:
    """The pairs that the sections hand on.

    ``anchors`` may carry ``windows``, the scores of their positives; without, pairs are candidates for
    positives. A section is at most SECTION rows, or less so that all tasks have work.
    """
    spark = rows.sparkSession
    blocks = max(1, -(-n_anchors // BLOCK))
    sections = max(1, -(-n // SECTION), -(-2 * spark.sparkContext.defaultParallelism // blocks))
    section = F.pmod(F.xxhash64("uid"), F.lit(sections)).cast("int")
    block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    windowed = "windows" in anchors.columns
    windows = F.col("windows") if windowed else F.lit(None).cast("array<bigint>")
    both = (anchors.select("uid", "id", "label", "vector", windows.alias("windows"), F.lit(0).alias("kind"),
                           block.alias("block"), every(sections).alias("section"))
            .unionByName(rows.select("uid", "id", "label", "vector", F.lit(None).cast("array<bigint>").alias("windows"),
                                     F.lit(1).alias("kind"), section.alias("section"), every(blocks).alias("block"))))

    def run(batches):
        now, held = None, _Section(how, windowed)
        for batch in batches:
            places = [batch.column(c).to_numpy() for c in ("block", "section", "kind")]
            cuts = np.flatnonzero(np.any([p[1:] != p[:-1] for p in places], axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(batch)]):
                if now != (key := (places[0][start], places[1][start])):
                    yield from held.pairs()
                    now, held = key, _Section(how, windowed)
                if places[2][start] == 0:
                    held.parts.append(batch.slice(start, end - start))
                    continue
                for at in range(start, end, BATCH):
                    held.rows(batch.slice(at, min(BATCH, end - at)))
        yield from held.pairs()

    dealt = both.repartitionById(blocks * sections, F.col("block") * sections + F.col("section"))
    ordered = dealt.sortWithinPartitions("block", "section", "kind", "id")
    return ordered.mapInArrow(run, ", ".join(f"{c} bigint" for c in PAIR))


def _by_anchor(pairs: DataFrame) -> DataFrame:
    """Secondary sort: an anchor's pairs in one task, best score first, positives before negatives of
    equal score, then by id."""
    return pairs.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "id")


def _stream(how: Mining):
    """Over pairs in order: windows open at positives, negatives fill them."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        now, windows = None, []  # (positive id, its score, how many negatives it has)
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "anchor_id", "score", "kind", "id"))
            for anchor, anchor_id, score, kind, name in zip(*columns):
                if anchor != now:
                    now, windows = anchor, []
                if kind == 0:
                    windows.append([name, score, 0])
                    continue
                for window in windows:
                    if window[2] < how.negatives and how.low * window[1] <= 100 * score <= how.high * window[1]:
                        window[2] += 1
                        out.append((anchor_id, window[0], window[2], name, window[1], score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return run


def _positives(how: Mining):
    """Over candidates in order: an anchor's first ones."""
    def run(batches):
        now, taken = None, 0
        for batch in batches:
            keep = []
            for i, anchor in enumerate(batch.column("anchor").to_pylist()):
                now, taken = anchor, taken + 1 if anchor == now else 1
                if taken <= how.positives:
                    keep.append(i)
            if keep:
                yield batch.take(pa.array(keep))

    return run


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", scale: int = 256, how: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition over ``vectors``: these rows are the query set. A score is the integer
    inner product of vectors whose components became floor(scale * x). An anchor's positives are its
    first ``how.positives`` other rows of the same label by descending score, then ascending id; each
    positive gets the first ``how.negatives`` rows of other labels in its window, in the same order.

    Rows with a null id, label or vector, or with a component that is null, not finite or so large that a
    score would not fit a long, take no part. Vectors of different lengths have no score. Rows that repeat
    an id are rows of their own, and an anchor of a repeated id gives the results of each. Other columns
    are not read. An empty table, one without anchors, or an anchor without positives gives no rows.
    """
    picked = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("bigint").alias("label"),
        F.col(f"`{vector_col}`").alias("raw"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    used = picked.where("id IS NOT NULL AND label IS NOT NULL").where(_usable(F.col("raw"), scale))
    rows = shared_table(used.select("id", "label", "is_anchor", quantised(F.col("raw"), scale).alias("vector"),
                                    F.monotonically_increasing_id().alias("uid")), "vectors")
    anchors = rows.where("is_anchor")
    n, n_anchors = rows.count(), anchors.count()

    candidates = _swept(rows, anchors, n, n_anchors, how).withColumn("kind", F.lit(0))
    positives = shared_table(_by_anchor(candidates).mapInArrow(_positives(how), candidates.schema), "positives")
    windows = positives.groupBy(F.col("anchor").alias("uid")).agg(
        F.sort_array(F.collect_list("score"), asc=False).alias("windows"))  # a few scores per anchor
    negatives = (_swept(rows, anchors.join(windows, "uid"), n, n_anchors, how)
                 .withColumn("kind", F.lit(1)))
    return (_by_anchor(positives.unionByName(negatives))
            .mapInArrow(_stream(how), "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                      "positive_score bigint, negative_score bigint"))
