"""Quality scores: random Fourier features over document statistics, ridge, isotonic calibration.

Statistics of a text (shares of character classes, word lengths, repetition of words and lines) are
standardized and mapped to cosines of random projections, which approximate a Gaussian kernel. Tasks
sum the normal equations of their rows; the driver adds a fixed number of such sums and solves once.
For calibration each half of the rows is scored by a fit on the other half; bins of these scores are
pooled until the share of label 1 never falls.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, flattened, nested, shared_table, slices, text_or_empty, texts, words

NAMES = ("log_words", "word_length", "word_length_spread", "distinct_words", "adjacent_repeats",
         "commonest_word", "repeated_lines", "log_words_per_line", "upper", "digits", "sentence_marks",
         "exclamation", "symbols", "controls", "not_ascii", "white_space")
FEATURES = 256
#: Labelled rows the fit uses at most, picked by a hash of doc_id; enough for 256 weights many times over.
FIT_ROWS = 200_000
SUMS = 8
RIDGE = 1e-3
BINS = 2048
THRESHOLD = 0.3
LEAST = 1e-3  # of the score comes from the ridge score itself and orders rows inside a pool


def _classes() -> np.ndarray:
    """lower 0, upper 1, digit 2, sentence mark 3, ! 4, other symbol 5, control 6, lead byte 7,
    white space 8, continuation byte 9"""
    of = np.full(256, 5, np.int64)
    of[:32], of[127], of[128:192], of[192:] = 6, 6, 9, 7
    for chars, k in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1),
                     ("0123456789", 2), (".,;:?'\"()-", 3), ("!", 4), (" \t\n\v\f\r", 8)):
        of[[ord(c) for c in chars]] = k
    return of


def statistics(text: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text; zeros for an empty one."""
    n = len(text)
    data, at = flat_bytes(text)
    owner = np.repeat(np.arange(n), np.diff(at))
    chars = np.bincount(owner * 10 + _classes()[data], minlength=n * 10).reshape(n, 10).astype(float)
    length = np.maximum(1, chars[:, :9].sum(1))
    out = np.zeros((n, len(NAMES)))
    for name, k in (("upper", 1), ("digits", 2), ("sentence_marks", 3), ("exclamation", 4),
                    ("symbols", 5), ("controls", 6), ("not_ascii", 7), ("white_space", 8)):
        out[:, NAMES.index(name)] = chars[:, k] / length

    def repetition(flat: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shares: distinct items, items equal to the one before, the commonest item."""
        size, of = np.diff(at), np.repeat(np.arange(n), np.diff(at))
        code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        some, count = np.unique(of * max(1, len(flat)) + code, return_counts=True)
        of_some = some // max(1, len(flat))
        top = np.zeros(n, np.int64)
        np.maximum.at(top, of_some, count)
        again = np.bincount(of[1:][(code[1:] == code[:-1]) & (of[1:] == of[:-1])], minlength=n)
        size = np.maximum(1, size)
        return np.bincount(of_some, minlength=n) / size, again / size, top / size

    flat, at = words(text)
    count, of = np.diff(at), np.repeat(np.arange(n), np.diff(at))
    size = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(float)
    some = np.maximum(1, count)
    mean = np.bincount(of, size, minlength=n) / some
    spread = np.sqrt(np.maximum(0, np.bincount(of, size * size, minlength=n) / some - mean * mean))
    distinct, adjacent, top = repetition(flat, at)
    lines = pc.split_pattern(text, "\n")
    line_at = np.concatenate([[0], np.cumsum(pc.list_value_length(lines).to_numpy(zero_copy_only=False))]).astype(np.int64)
    distinct_lines, _, _ = repetition(lines.flatten(), line_at)
    for name, value in (("log_words", np.log1p(count)), ("word_length", np.log1p(mean)),
                        ("word_length_spread", np.log1p(spread)), ("distinct_words", distinct),
                        ("adjacent_repeats", adjacent), ("commonest_word", top),
                        ("repeated_lines", 1 - distinct_lines),
                        ("log_words_per_line", np.log1p(count / np.maximum(1, np.diff(line_at))))):
        out[:, NAMES.index(name)] = value
    return out


@dataclass(frozen=True)
class Model:
    """What a fit leaves: standardization, projections, weights, calibration steps."""
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray | None
    shares: np.ndarray | None

    def cosines(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(z), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:  # nothing to learn from
            return np.full(len(x), 0.5)
        raw = self.ridge(x)
        share = np.interp(raw, self.knots, self.shares)
        return (1 - LEAST) * share + LEAST * np.clip((raw + 1) / 3, 0, 1)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every row's whole text."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x = statistics(texts(part))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "x"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("x", T.ArrayType(T.DoubleType()))]))


def fold(id_col: str) -> F.Column:
    """crc32 of the id as text, modulo 5; 0 is held out from all learning."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def pooled(low: np.ndarray, ones: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of binned scores: each pool's mean score and share of ones."""
    pools: list[list[float]] = []
    for score, one, n in zip(low, ones, count):
        pools.append([score * n, one, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def fit(table: DataFrame, labels: DataFrame, label_col: str = "quality", label_id: str = "doc_id",
        n_features: int = FEATURES, fit_rows: int = FIT_ROWS, seed: int = 7) -> Model:
    """A model from ``features`` and labels 0/1; rows of fold 0 and null labels are left out.

    Folds 1 and 2 are one half of the rows for calibration, 3 and 4 the other; the final weights are
    those of both. An id with several labels counts as the larger; with more labelled rows than
    ``fit_rows``, a hash of the id picks that many.
    """
    rng = np.random.default_rng(seed)
    d = len(NAMES)
    directions = rng.standard_normal((d, n_features)) / np.sqrt(d) * 1.5
    phases = rng.uniform(0, 2 * np.pi, n_features)
    marks = (labels.select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .where("y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y")).withColumn("fold", fold("id"))
             .where("fold > 0"))
    n = marks.count()
    part = min(1.0, fit_rows / max(1, n))
    picked = marks.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < int(part * (1 << 20)) + (part >= 1))
    rows = shared_table(table.join(picked, "id").select("x", "y", F.col("fold").cast("int").alias("fold")), "labelled")
    moments = rows.select(*[F.col("x")[i].alias(f"c{i}") for i in range(d)], "y")
    found = moments.agg(F.count("*"), F.sum("y"), *[f(f"c{i}") for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    if not found[0] or found[1] in (0, found[0]):
        return Model(np.zeros(d), np.ones(d), directions, phases, None, None, None)
    mean, spread = np.array(found[2::2], float), np.array(found[3::2], float)
    blank = Model(mean, np.where(spread > 1e-9, spread, 1.0), directions, phases, None, None, None)

    def sums(batches):
        a, b, n = np.zeros((2, *(n_features + 1,) * 2)), np.zeros((2, n_features + 1)), [0, 0]
        for batch in batches:
            z, y, half = blank.cosines(_matrix(batch)), batch.column("y").to_numpy(), batch.column("fold").to_numpy() > 2
            for k in (0, 1):
                own = z[half == k]
                a[k] += own.T @ own
                b[k] += own.T @ y[half == k]
                n[k] += len(own)
        yield pa.RecordBatch.from_pydict({"half": [0, 1], "a": [x.tobytes() for x in a], "b": [x.tobytes() for x in b], "n": n})

    # few enough to add up on the driver: twice SUMS matrices of (FEATURES + 1) squared
    parts = rows.repartition(SUMS).mapInArrow(sums, "half bigint, a binary, b binary, n bigint").collect()

    def solved(halves: tuple[int, ...]) -> Model:
        own = [r for r in parts if r.half in halves]
        a = sum(np.frombuffer(r.a).reshape((n_features + 1,) * 2) for r in own)
        b = sum(np.frombuffer(r.b) for r in own)
        ridge = RIDGE * max(1, sum(r.n for r in own)) / n_features
        return replace(blank, weights=np.linalg.solve(a + ridge * np.eye(n_features + 1), b))

    model, halves = solved((0, 1)), [solved((1,)), solved((0,))]

    def raw(batches):
        for batch in batches:
            x, second = _matrix(batch), batch.column("fold").to_numpy() > 2
            s = np.clip(np.where(second, halves[1].ridge(x), halves[0].ridge(x)), -0.5, 1.5)
            yield pa.RecordBatch.from_pydict({"s": s, "y": batch.column("y")})

    scored = rows.mapInArrow(raw, "s double, y int")
    bins = (scored.groupBy(F.floor((F.col("s") + 0.5) / 2 * BINS).alias("bin"))
            .agg(F.avg("s").alias("s"), F.sum("y").alias("ones"), F.count("*").alias("n")).orderBy("bin").collect())
    knots, shares = pooled(*(np.array([r[k] for r in bins], float) for k in (1, 2, 3)))
    return replace(model, knots=knots, shares=shares)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every input row with ``score``, from its whole text alone."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                s = model.score(statistics(texts(part)))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(s)], ["row", "score"])

    rows = nested(docs, text=text_or_empty(f"`{text_col}`"))
    return flattened(rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])), "score")


def score_features(table: DataFrame, model: Model) -> DataFrame:
    """(id, score) from ``features``."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(_matrix(batch)))], ["id", "score"])

    return table.mapInArrow(run, T.StructType([table.schema["id"], T.StructField("score", T.DoubleType())]))
