"""Exact duplicates by two-pass Bloom filtering, DataFrame functions only.

Pass one hashes every text to one of 64 slots per row. A slot that a second row finds taken may hold
equal texts; only such slots enter the second filter. Pass two probes that filter on every row, in
place. Rows it knows may have an equal and shuffle, to be compared by SHA-256; all others have no
equal for certain and pass straight through.

The second filter is the only thing broadcast: ``FILTER_WORDS`` words of 64 bits at most. Where more
repeated hashes exist than it can tell apart, more rows shuffle; the result stays the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FILTER_WORDS, filter_size, flattened, join_groups, maybe_repeated, nested, text_or_empty


def _hashed(docs: DataFrame, id_col: str, text_col: str, filter_words: int) -> tuple[DataFrame, int]:
    rows = nested(docs, id=F.col(f"`{id_col}`"), text=text_or_empty(f"`{text_col}`"))
    n = docs.count()
    words = filter_size(n, filter_words)
    return maybe_repeated(rows, F.xxhash64("text"), n, words).withColumn("sha", F.sha2("text", 256)).drop("text"), n


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    with_columns: list[str] | None = None,
                    filter_words: int = FILTER_WORDS) -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of equal texts the row with the largest id stays. Null texts are empty and equal to each other. A
    null id is smaller than any other; rows that repeat both id and text are marked alike.
    ``with_columns`` names the input columns to carry (all by default).
    """
    carried = docs.columns if with_columns is None else list(with_columns)
    wanted = list(dict.fromkeys([*carried, id_col, text_col]))
    rows, n = _hashed(docs.select(*[F.col(f"`{c}`") for c in wanted]), id_col, text_col, filter_words)
    slim = F.struct(*[F.col("row").getField(c).alias(c) for c in carried] or [F.lit(None).alias("_")])
    rows = rows.withColumn("row", slim)
    alone = rows.where("NOT maybe").select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    some = rows.where("maybe").drop("maybe").withColumn("sha", F.unhex("sha"))
    groups = some.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    several = join_groups(some, groups, "sha", "group_size", n).select(
        "row", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
    return flattened(alone.unionByName(several), "keep_id", "group_size", "kept", "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    filter_words: int = FILTER_WORDS) -> DataFrame:
    """One row of each group of equal texts: that with the largest id, whole, in the input's columns.

    Groups meet as partial maxima, so a group of any size costs each task one row.
    """
    rows, _ = _hashed(docs, id_col, text_col, filter_words)
    best = F.max_by("row", F.struct("id", F.xxhash64("row")))
    some = rows.where("maybe").groupBy("sha").agg(best.alias("row"))
    return rows.where("NOT maybe").select("row").unionByName(some.select("row")).select("row.*")
