"""Operators of the feature table: totals, the chain of left joins, ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import fill_zero, safe_ratio
from ..session import materialise

SALT, PARTS = "_salt", "_parts"


def grouped_total(df: DataFrame, keys: Sequence[str], value: str, total: str) -> DataFrame:
    """Sum of ``value`` per key group, nulls counted as 0 before the sum.

    So a group holding only nulls totals 0, not null. Map-side partial sums leave one row
    per key and task for the shuffle, however many rows one key holds.
    """
    return fill_zero(df, value).groupBy(*keys).agg(F.sum(value).alias(total))


def labelled_total(
    df: DataFrame, keys: Sequence[str], value: str, total: str, label: str, accepted: Sequence[str]
) -> DataFrame:
    """``grouped_total`` over the rows whose label is one of the accepted spellings.

    The comparison is case-sensitive and reaches the scan as a pushed-down ``IN``.
    """
    return grouped_total(df.filter(F.col(label).isin(*accepted)), keys, value, total)


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all the columns are non-null."""
    return df.filter(_all(F.col(c).isNotNull() for c in columns))


def _all(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def left_chain(
    base: DataFrame,
    sides: Sequence[DataFrame],
    keys: Sequence[str],
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Left equi-joins of ``base`` with each side in turn on the same keys.

    Where a side repeats a non-key column of the base, the base's column is kept: the
    copy is dropped before the join, so it is never read or shuffled. All joins use one
    key set, hence one partitioning; sides that were grouped by the keys come already
    partitioned. No join strategy is forced: AQE broadcasts a side only after measuring it.

    ``heavy``, from ``heavy_keys``, names the keys whose rows one task should not get
    alone. Rows of such a key are dealt over its ``parts`` by a hash of the row, and the
    sides' rows of that key, but no others, are repeated as often.
    """
    on = list(keys)
    if heavy is not None:
        row_hash = F.xxhash64(*base.columns)
        base = _with_parts(base, heavy, keys).withColumn(SALT, F.pmod(row_hash, PARTS)).drop(PARTS)
        on.append(SALT)
    joined = base
    for side in sides:
        side = side.drop(*[c for c in side.columns if c in joined.columns and c not in keys])
        if heavy is not None:
            parts = F.sequence(F.lit(0).cast("bigint"), F.col(PARTS) - 1)
            side = _with_parts(side, heavy, keys).withColumn(SALT, F.explode(parts)).drop(PARTS)
        joined = joined.join(side, on, "left")
    return joined.drop(SALT)


def _with_parts(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the number of parts of each row's key: 1 unless it is a heavy one."""
    named = heavy.select(*[F.col(k).alias(f"_heavy_{k}") for k in keys], F.col("parts").alias("_n"))
    same = _all(df[k].eqNullSafe(named[f"_heavy_{k}"]) for k in keys)
    # heavy_keys gives fewer rows than ``parts``.
    joined = df.join(F.broadcast(named), same, "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce("_n", F.lit(1)).alias(PARTS))


def heavy_keys(base: DataFrame, keys: Sequence[str], parts: int = 200) -> DataFrame:
    """(keys, parts) of every key with more than 1/``parts`` of the rows, null keys too: how
    many such shares it holds, rounded up.

    Costs one pass over the key columns, summed per key on the map side. There can be fewer
    than ``parts`` of them at any size, and the shares follow the rows alone.
    """
    sizes = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    total = base.agg(F.count(F.lit(1)).alias("total")).scalar()
    shares = F.ceil(F.col("size") * parts / total)
    return sizes.filter(F.col("size") * parts > total).select(*keys, shares.alias("parts"))


COPIES = "_copies"


def unique_side(side: DataFrame, keys: Sequence[str], on_repeat: str = "refuse") -> tuple[DataFrame, DataFrame]:
    """A side of a join with one row per key, and the keys that had more, with their counts.

    One pass over the side: it is grouped by the keys, map-side first, with the count of its rows
    and their least, and written; the join reads that table, already one row per key, and so does
    whoever wants the list of ``(keys, n)``. A key that holds most rows is one row per task.
    ``on_repeat="refuse"`` fails the write at the first repeated key and names it;
    "first" takes the least row of each key. Rows with a null in a key are left out, as they join
    with nothing.
    """
    if on_repeat not in ("refuse", "first"):
        raise ValueError(f"unknown rule {on_repeat!r}")
    known = side.filter(_all(F.col(k).isNotNull() for k in keys))
    others = [c for c in side.columns if c not in keys]
    least = F.min(F.struct(*others)) if others else F.lit(None)
    grouped = known.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES), least.alias("_least"))
    if on_repeat == "refuse":
        named = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        message = F.concat(F.lit(f"rows repeat key ({', '.join(keys)}) = ("), named, F.lit(")"))
        checked = F.when(F.col(COPIES) > 1, F.raise_error(message).cast("bigint")).otherwise(F.col(COPIES))
        grouped = grouped.withColumn(COPIES, checked)
    written = materialise(grouped, "unique-side")
    rows = written.select(*keys, *[F.col("_least")[c].alias(c) for c in others])
    repeated = written.filter(F.col(COPIES) > 1).select(*keys, F.col(COPIES).alias("n"))
    return rows.select(*side.columns), repeated


def with_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add ``{alias: (numerator, denominator)}`` as null-safe double ratios."""
    return df.withColumns(
        {alias: safe_ratio(F.col(a), F.col(b)) for alias, (a, b) in ratios.items()}
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Largest and smallest value of a column in one pass."""
    return df.agg(F.max(column).alias("max_value"), F.min(column).alias("min_value"))


def first_row(df: DataFrame, *order: str) -> DataFrame:
    """The first row in the given order: a top-1 per task, then of those; no full sort."""
    return df.orderBy(*order).limit(1)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null (or NaN) in any of the columns."""
    return df.na.drop(subset=list(columns))
