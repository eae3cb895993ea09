"""Mixing sources to target weights, DataFrame functions only.

Every row gets a hash-random key; within its source, rows are ordered by key. The key's high bits cut
a source into ranges of even size, so prefix sums run in two steps: the ranges' totals, then the rows
inside each range. A source of any size is spread over all its ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, flattened, nested, text_or_empty

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
#: Rows a key range should hold; the number of ranges follows from the number of rows.
RANGE_ROWS = 50_000


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: all sizes shared by weight.

    No target passes ``most`` times its source; what that leaves over is shared among the others by
    weight. Sorted by cap per weight, the capped sources come first, so one running sum finds the
    share per weight that uses up the whole. One row per source goes through one task.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("place", F.lit(len(weights))).cast("int") + 1)
    shares = (sizes.withColumn("place", F.row_number().over(by_name) - 1)
              .withColumn("weight", weight.cast("bigint"))
              .withColumn("cap", F.col("source_size") * most)
              .withColumn("whole", F.sum("source_size").over(everything))
              .withColumn("used", F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("left", F.sum("weight").over(onward))
              .withColumn("share", (F.col("whole") - F.col("used")).cast("double") / F.col("left")))
    fits = F.col("share") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(fits, F.struct("used", "share"))).over(everything).getField("share")
    return (shares.withColumn("level", level)
            .select("source", "source_size",
                    F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")),
                               F.col("cap").cast("double")).alias("target")))


def take(rows: DataFrame, n: int, seed: int, weights: tuple[int, ...], most: int,
         range_rows: int) -> DataFrame:
    """``rows`` (id, source, size, ..) with ``source_size``, ``target`` and ``taken``."""
    ranges = 1 << max(5, (n // range_rows).bit_length())
    name = F.concat_ws(":", F.lit(seed).cast("string"), F.col("id").cast("string"), F.col("size").cast("string"))
    key = F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")  # 60 bits, the same in any engine
    dealt = (rows.withColumn("key", key)
             .withColumn("range", F.shiftright("key", 60 - (ranges.bit_length() - 1))))
    totals = dealt.groupBy("source", "range").agg(F.sum("size").alias("total"))
    in_source = Window.partitionBy("source")
    before = in_source.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (totals.withColumn("start", F.coalesce(F.sum("total").over(before), F.lit(0)))
              .select(F.col("source").alias("s"), F.col("range").alias("r"), "start"))
    per_source = totals.groupBy("source").agg(F.sum("total").alias("source_size"))
    per_source = targets(per_source, weights, most)
    starts = starts.join(per_source, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "range").orderBy("key", "id", "size")
    sums = dealt.withColumn("inside", F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = sums.join(starts.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - whole * F.col("source_size") - F.col("start") - F.col("inside")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.withColumn("taken", (whole * F.col("size") + part).cast("bigint"))


def _rows(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return nested(docs, id=F.col(f"`{id_col}`"), source=F.col(f"`{source_col}`"),
                  size=n_words(text_or_empty(f"`{text_col}`")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 0,
        with_columns: list[str] | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every row with ``size`` (words), ``source_size``, ``target`` and ``taken``.

    Sources by code point, null last, get ``weights`` in turn. The mix goes through a source's rows in
    hash-random order, again from the start where the target passes the source's size, and stops at
    the target's word: a row there is taken in part. Texts without words have size and taken 0. Equal
    runs agree; rows with equal id and size have the same key and any order among themselves.
    """
    rows = _rows(docs, id_col, source_col, text_col)
    carried = docs.columns if with_columns is None else list(with_columns)
    rows = rows.withColumn("row", F.struct(*[F.col("row").getField(c).alias(c) for c in carried]))
    taken = take(rows, docs.count(), seed, weights, most, range_rows)
    return flattened(taken, "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text", length_col: str | None = "n_chars",
                    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 0,
                    range_rows: int = RANGE_ROWS) -> DataFrame:
    """The mix itself in the input's columns: a row for each time a document is taken.

    The last time may take only its first words; that row's text is cut behind them (and
    ``length_col`` follows). Documents without words bring nothing to a mix and are not in it.
    """
    taken = take(_rows(docs, id_col, source_col, text_col), docs.count(), seed, weights, most, range_rows)
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    copies = (taken.where("taken > 0")
              .withColumn("pass", F.explode(F.sequence(F.lit(1), times)))
              .withColumn("words", F.least(F.col("size"), F.col("taken") - (F.col("pass") - 1) * F.col("size"))))
    text = F.col("row").getField(text_col)
    pieces = F.regexp_extract_all(text, F.lit(f"{SPACE}*{WORD}"), F.lit(0))
    head = F.array_join(F.slice(pieces, 1, F.col("words").cast("int")), "")
    cut = F.when(F.col("words") < F.col("size"), head).otherwise(text)

    def column(name: str) -> Column:
        if name == text_col:
            return cut.alias(name)
        old = F.col("row").getField(name)
        if name == length_col:
            kind = docs.schema[name].dataType
            return F.when(F.col("words") < F.col("size"), F.char_length(cut).cast(kind)).otherwise(old).alias(name)
        return old.alias(name)

    return copies.select(*map(column, docs.columns))
