"""Near duplicates among embeddings: product quantisation over coarse lists, exact cosine rerank.

Unit vectors within distance r of each other have cosine 1 - r^2/2 or more, so all bounds are plain
geometry and lose nothing:

- A vector within r of ``a`` can have its home in list c only if ``a`` lies within r of the half space
  nearer to c than to its own centroid. Those lists are ``a``'s probes, as many as it takes.
- In a list, members are codes of their residuals' subspaces. A table of ``a``'s distances to all
  codes gives its distance to a member's code; a member farther than r plus its own coding error is
  out. The rest get their cosine in double precision.

Equal vectors of a label are one class, counted with its size. Centroids and codes come from a bounded
sample; every vector is indexed. Lists are cut in blocks on both sides, so a list of any size is many
small groups, and a group reports a count and a root per vector instead of its pairs.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flattened, join_groups, nested, shared_table
from .components import components, least_reached

COSINE = 0.98
#: The sample that centroids and codes are fitted on.
TRAIN_ROWS = 20_000
LIST_ROWS, MOST_LISTS = 2000, 4096
SUBSPACES, CODES = 8, 64
BLOCK_ROWS = 4096
#: Slack of distance bounds against rounding.
SLACK = 1e-6


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    k = max(1, min(k, len(x)))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, centres)
        count = np.bincount(at, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, at, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(1, count)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(1) / 2
    return np.concatenate([np.argmax(x[i:i + 4096] @ centres.T - half, 1) for i in range(0, len(x), 4096)]
                          or [np.empty(0, int)])


@dataclass(frozen=True)
class Quantizer:
    """Coarse centroids, and for each subspace the codes of residuals."""
    centres: np.ndarray
    codes: np.ndarray  # subspace, code, component

    @staticmethod
    def fit(x: np.ndarray, lists: int, seed: int = 0) -> Quantizer:
        rng = np.random.default_rng(seed)
        centres = k_means(x, lists, rng)
        rest = _split(x - centres[nearest(x, centres)])
        k = max(1, min(CODES, len(x)))
        return Quantizer(centres, np.stack([k_means(rest[:, m], k, rng) for m in range(SUBSPACES)]))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home list, codes, and the coding error's length."""
        home = nearest(x, self.centres)
        rest = _split(x - self.centres[home])
        code = np.stack([nearest(rest[:, m], self.codes[m]) for m in range(SUBSPACES)], 1)
        error = rest - self.codes[np.arange(SUBSPACES), code]
        return home, code.astype(np.uint8), np.sqrt((error ** 2).sum((1, 2)))

    def probes(self, x: np.ndarray, home: np.ndarray, r: float) -> np.ndarray:
        """Which lists (columns) may hold a vector within ``r``."""
        square = ((x ** 2).sum(1)[:, None] + (self.centres ** 2).sum(1) - 2 * x @ self.centres.T)
        between = np.sqrt(np.maximum(0, ((self.centres[:, None] - self.centres[None]) ** 2).sum(2))) \
            if len(self.centres) <= 512 else None
        apart = between[home] if between is not None else np.stack(
            [np.sqrt(((self.centres - self.centres[h]) ** 2).sum(1)) for h in home])
        own = square[np.arange(len(x)), home][:, None]
        return square - own <= 2 * (r + SLACK) * apart + SLACK


def _split(x: np.ndarray) -> np.ndarray:
    """Subspaces of equal width, the last filled up with zeros."""
    width = -(-x.shape[1] // SUBSPACES)
    return np.pad(x, ((0, 0), (0, width * SUBSPACES - x.shape[1]))).reshape(len(x), SUBSPACES, width)


def _units(raw: list[bytes], width: int) -> np.ndarray:
    """Unit vectors, shorter ones filled up with zeros."""
    out = np.zeros((len(raw), width))
    for i, b in enumerate(raw):
        v = np.frombuffer(b)
        out[i, :len(v)] = v / np.abs(v).max()
    return out / np.sqrt((out ** 2).sum(1))[:, None] if len(raw) else out


def _keyed(batches):
    """Each row's class: a digest of label and vector; null where the row links with nothing."""
    for batch in batches:
        keys, raw = [], []
        for label, v in zip(batch.column("label").to_pylist(), batch.column("v")):
            v = None if label is None or not v.is_valid else v.values.to_numpy(zero_copy_only=False).astype(float)
            if v is None or not len(v) or not np.isfinite(v).all() or not v.any():
                keys.append(None)
                raw.append(None)
                continue
            raw.append((v + 0.0).tobytes())
            keys.append(hashlib.blake2b(repr(label).encode() + b"\0" + raw[-1], digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(keys, pa.binary()),
                                          pa.array(raw, pa.binary())], ["id", "label", "key", "raw"])


def _with_key(batches):
    for batch in batches:
        key = next(_keyed([batch])).column("key")
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), key], ["row", "id", "key"])


def _linked(quantizer: Quantizer, width: int, cosine: float):
    r = math.sqrt(2 - 2 * cosine)

    def run(key, table):
        home = np.array(table.column("home").to_pylist(), bool)
        keys, size = table.column("key").to_pylist(), np.array(table.column("size").to_pylist(), np.int64)
        raw = table.column("raw").to_pylist()
        x = _units(raw, width)
        length = np.array([len(b) for b in raw])
        exact = np.zeros((len(raw), width))
        for i, b in enumerate(raw):
            exact[i, :len(b) // 8] = np.frombuffer(b)
        norm = np.sqrt((exact ** 2).sum(1))
        members, visitors = np.flatnonzero(home), np.flatnonzero(~home)
        codes = np.array([list(table.column("code")[int(i)].as_py()) for i in members], np.int64).reshape(-1, SUBSPACES)
        reach = (r + SLACK + np.array(table.column("error").to_pylist(), float)[members]) ** 2
        name = {k: i for i, k in enumerate(sorted(set(keys)))}
        node = np.array([name[k] for k in keys])
        links, ends = np.zeros(len(keys), np.int64), []
        centre = quantizer.centres[int(key[1].as_py())]
        for at in range(0, len(visitors), 256):
            some = visitors[at:at + 256]
            rest = _split(x[some] - centre)
            found = np.zeros((len(some), len(members)))
            for m in range(SUBSPACES):
                table_m = ((rest[:, m, None, :] - quantizer.codes[m][None]) ** 2).sum(2)
                found += table_m[:, codes[:, m]]
            i, j = np.nonzero(found <= reach)
            a, b = some[i], members[j]
            keep = (node[a] != node[b]) & (length[a] == length[b])
            a, b = a[keep], b[keep]
            near = np.concatenate([(exact[a[k:k + 65536]] * exact[b[k:k + 65536]]).sum(1)
                                   for k in range(0, len(a), 65536)] or [np.empty(0)]) / (norm[a] * norm[b])
            a, b = a[near >= cosine], b[near >= cosine]
            np.add.at(links, a, size[b])
            ends.append((node[a], node[b]))
        a, b = (np.concatenate([e[k] for e in ends] or [np.empty(0, int)]) for k in (0, 1))
        root, names = least_reached(len(name), a, b), sorted(name)
        touched = np.unique(np.concatenate([a, b]))
        per = np.bincount(node, links, minlength=len(name)).astype(np.int64)
        return pa.table({"key": pa.array([names[i] for i in touched], pa.binary()),
                         "links": pa.array(per[touched], pa.int64()),
                         "root": pa.array([names[root[i]] for i in touched], pa.binary())})
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", cosine: float = COSINE, train_rows: int = TRAIN_ROWS,
                    list_rows: int = LIST_ROWS, block_rows: int = BLOCK_ROWS,
                    with_columns: list[str] | None = None) -> DataFrame:
    """Every row with ``n_links``, ``component_id`` and ``kept``.

    Rows of the same label link where the cosine of their vectors, in double precision, is at least
    ``cosine``. Rows with a null label, or a vector that is null, empty, zero, or has null or non-finite
    components, link with nothing and are kept; so do vectors of different length with each other.
    ``component_id`` is the smallest id that links reach. Rows that repeat an id are rows of their own,
    each with the links of its own vector.
    """
    rows = nested(vectors, id=F.col(f"`{id_col}`"), label=F.col(f"`{label_col}`"),
                  v=F.col(f"`{vector_col}`").cast("array<double>"))
    carried = vectors.columns if with_columns is None else list(with_columns)
    rows = rows.withColumn("row", F.struct(*[F.col("row").getField(c).alias(c) for c in carried]))
    slim = rows.select("id", "label", F.when(~F.exists("v", lambda x: x.isNull()), F.col("v")).alias("v"))
    keyed = slim.mapInArrow(_keyed, T.StructType([slim.schema["id"], slim.schema["label"], T.StructField(
        "key", T.BinaryType()), T.StructField("raw", T.BinaryType())]))
    keyed = shared_table(keyed, "keyed")
    total = keyed.count()
    classes = shared_table(keyed.where("key IS NOT NULL").groupBy("key").agg(
        F.any_value("label").alias("label"), F.any_value("raw").alias("raw"), F.min("id").alias("least"),
        F.count("*").alias("size")), "classes")
    found = _search(classes, cosine, train_rows, list_rows, block_rows)
    links = found.groupBy("key").agg(F.sum("links").alias("others"))
    named = components(found.select(F.col("root").alias("a"), F.col("key").alias("b")))
    marked = (classes.select("key", "least", "size").join(links, "key", "left")
              .join(named.select(F.col("node").alias("key"), "component"), "key", "left")
              .withColumn("component", F.coalesce("component", "key")))
    least = marked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("classes"))
    marked = shared_table(join_groups(marked, least, "component", "classes", total).select(
        "key", "size", "component_id", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links")), "marked")
    parts = [keyed.where("key IS NULL").select("id", F.lit(0).cast("bigint").alias("n_links"),
                                               F.col("id").alias("component_id")),
             join_groups(keyed.where("key IS NOT NULL").select("id", "key"), marked, "key", "size", total)
             .select("id", "n_links", "component_id")]
    every = parts[0].unionByName(parts[1]).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    if carried == [id_col]:
        return every.select(F.col("id").alias(id_col), "n_links", "component_id", "kept")
    # whole rows come back by class; those without one are known by having none
    whole = rows.withColumn("v", F.when(~F.exists("v", lambda x: x.isNull()), F.col("v")))
    whole = whole.mapInArrow(_with_key, T.StructType([whole.schema["row"], whole.schema["id"], T.StructField("key", T.BinaryType())]))
    parts = [whole.where("key IS NULL").select("row", "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")),
             join_groups(whole.where("key IS NOT NULL"), marked, "key", "size", total).select("row", "id", "n_links", "component_id")]
    every = parts[0].unionByName(parts[1]).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    return flattened(every, "n_links", "component_id", "kept")


def _search(classes: DataFrame, cosine: float, train_rows: int, list_rows: int, block_rows: int) -> DataFrame:
    """(key, links, root) of linked classes, one row per group that saw a link."""
    spark = classes.sparkSession
    empty = "key binary, links bigint, root binary"
    n, longest = classes.agg(F.count("*"), F.max(F.octet_length("raw"))).first()
    if not n:
        return spark.createDataFrame([], empty)
    width = longest // 8
    sample = classes.orderBy(F.xxhash64("key"), "key").limit(train_rows).select("raw").collect()  # bounded
    lists = max(1, min(MOST_LISTS, n // list_rows))
    quantizer = Quantizer.fit(_units([bytes(r.raw) for r in sample], width), lists)
    r = math.sqrt(2 - 2 * cosine)

    def placed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _units(part.column("raw").to_pylist(), width)
                home, code, error = quantizer.encode(x)
                which = quantizer.probes(x, home, r)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("label"), part.column("size"), part.column("raw"),
                     pa.array(home, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error),
                     pa.array([np.flatnonzero(w).astype(np.int32) for w in which], pa.list_(pa.int32()))],
                    ["key", "label", "size", "raw", "list", "code", "error", "probes"])

    kind = classes.schema["label"].dataType.simpleString()
    index = shared_table(classes.select("key", "label", "size", "raw").mapInArrow(
        placed, f"key binary, label {kind}, size bigint, raw binary, list int, code binary, error double, "
                "probes array<int>"), "index")
    members = index.select("key", "label", "size", "raw", "list", "code", "error", F.lit(True).alias("home"))
    visits = index.select("key", "label", "size", "raw", F.explode("probes").alias("list"),
                          F.lit(None).cast("binary").alias("code"), F.lit(0.0).alias("error"), F.lit(False).alias("home"))
    both = members.unionByName(visits)
    # lists beyond a block on either side are cut there; only these few are named
    counts = (both.groupBy("label", "list").agg(F.sum(F.col("home").cast("bigint")).alias("m"), F.count("*").alias("n"))
              .select("label", "list", F.ceil(F.col("m") / block_rows).alias("mb"),
                      F.ceil((F.col("n") - F.col("m")) / block_rows).alias("vb")).where("mb > 1 OR vb > 1"))
    cut = both.join(F.broadcast(counts) if n <= 1 << 28 else counts, ["label", "list"], "left")
    salt = F.xxhash64("key")
    mb, vb = F.coalesce("mb", F.lit(1)), F.coalesce("vb", F.lit(1))
    every = lambda k: F.sequence(F.lit(0).cast("bigint"), k - 1)
    cut = (cut.withColumn("mine", F.explode(F.when(F.col("home"), F.array(F.pmod(salt, mb))).otherwise(every(mb))))
           .withColumn("yours", F.explode(F.when(F.col("home"), every(vb)).otherwise(F.array(F.pmod(salt, vb))))))
    return shared_table(cut.drop("mb", "vb").groupBy("label", "list", "mine", "yours").applyInArrow(
        _linked(quantizer, width, cosine), empty), "linked")
