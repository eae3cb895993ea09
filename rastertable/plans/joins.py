"""Join strategies: broadcast behind a size check, shuffle with split hot keys beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000
SALTS = 16


def fits(df: DataFrame, row_bytes: int = 64, budget: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has few enough rows to be broadcast. Counts, but never past the limit."""
    most = max(1, budget // row_bytes)
    return df.select(F.lit(1)).limit(most + 1).count() <= most


def split_join(big: DataFrame, side: DataFrame, on: list[str], how: str, spread_by: list[str],
               side_spread_by: list[str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """Shuffle join in which a key with many rows is worked on by several tasks.

    Keys above ``hot_rows`` are counted first; there are at most rows/hot_rows of them, so their
    list is small by construction. Rows of ``big`` with such a key get one of ``_a`` numbers and
    meet a copy of the matching rows of ``side`` each. With ``side_spread_by`` (inner joins only)
    hot keys of ``side`` are split the same way the other way round.
    """
    limit = hot_rows or HOT_ROWS

    def hot(df: DataFrame, name: str) -> DataFrame:
        return (df.groupBy(*on).count().where(F.col("count") > limit)
                .select(*on, F.ceil(F.col("count") / limit).cast("int").alias(name)))

    if side_spread_by and how != "inner":
        raise ValueError("only inner joins can split both sides")
    parts = [("_a", big, spread_by)] + ([("_b", side, side_spread_by)] if side_spread_by else [])
    left, right = big, side
    for name, counted, spread in parts:
        keys = F.broadcast(hot(counted, "_n"))
        n = F.coalesce("_n", F.lit(1))
        pick = F.pmod(F.xxhash64(*spread), n).cast("int")
        copy = F.explode(F.sequence(F.lit(0), n - 1))
        here, there = (pick, copy) if name == "_a" else (copy, pick)
        left = left.join(keys, on, "left").withColumn(name, here).drop("_n")
        right = right.join(keys, on, "left").withColumn(name, there).drop("_n")
    names = [name for name, *_ in parts]
    return left.join(right.hint("merge"), [*on, *names], how).drop(*names)


def salted_join(big: DataFrame, side: DataFrame, on: list[str], spread_by: list[str],
                salts: int = SALTS) -> DataFrame:
    """Inner shuffle join with every row of ``side`` repeated ``salts`` times.

    For a ``side`` that is small next to ``big`` where counting the keys of ``big`` would mean to
    compute it twice.
    """
    salted = big.withColumn("_a", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    spread = side.withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread.hint("merge"), [*on, "_a"]).drop("_a")


def lookup_join(big: DataFrame, side: DataFrame, on: list[str], how: str = "inner",
                row_bytes: int = 64, spread_by: list[str] | None = None,
                side_spread_by: list[str] | None = None, most: int | None = None) -> DataFrame:
    """``big`` joined with ``side`` on equal columns.

    A side that passes ``fits`` is broadcast and ``big`` stays where it is; ``most`` is an upper
    bound of its rows where one is known, which saves counting them. Otherwise both are shuffled,
    and hot keys are split by the given columns.
    """
    if how not in ("inner", "left_semi", "left", "left_anti"):
        raise ValueError(how)
    known = most is not None and most * row_bytes <= BROADCAST_BYTES
    if known or fits(side, row_bytes):
        return big.join(F.broadcast(side), on, how)
    if not spread_by and not side_spread_by:
        return big.join(side.hint("merge"), on, how)
    if not spread_by:  # only the side can be hot: change places
        return split_join(side, big, on, how, side_spread_by)
    return split_join(big, side, on, how, spread_by, side_spread_by)
