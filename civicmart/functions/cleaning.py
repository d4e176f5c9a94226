"""Cleaning rules as column expressions. Everything stays inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the label the open-data portal uses for an unknown place name.
UNKNOWN_PLACE = "No consta"

# Prefix of the columns that carry raw text beside a formatted one.
RAW = "_raw_"


def quoted(name: str) -> Column:
    """Column by its literal name, dots, spaces, accents and parentheses included."""
    return F.col("`" + name.replace("`", "``") + "`")


# Shapes that a cast can read. A failing cast builds an exception, some twenty times the
# cost of looking first; in a column full of sentinels that would set the pace.
WHOLE = r"^\s*+[+-]?+[0-9]++\s*+$"
NUMBER = (
    r"^\s*+[+-]?+(?:(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+[dDfF]?+"
    r"|(?i:nan|inf(?:inity)?+))\s*+$"
)


def to_int(value: Column) -> Column:
    """Text or number to int; anything unreadable ("-", "..", "") becomes null.

    A decimal text such as "46595.0" is truncated: a file whose column held one decimal
    would have been read as double before the cast to int.
    """
    text = value.cast("string")
    return F.when(text.rlike(WHOLE), text.try_cast("int")).when(
        text.rlike(NUMBER), text.try_cast("double").try_cast("int")
    )


def to_double(value: Column) -> Column:
    """Text or number to double; anything unreadable becomes null.

    Double rather than float, so 64.7 stays 64.7 in every copy of the table.
    """
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def hyphens_to_spaces(value: Column) -> Column:
    """Every hyphen becomes one space; nothing is trimmed or collapsed."""
    return F.translate(value, "-", " ")


def text_to_null(value: Column, sentinel: str = UNKNOWN_PLACE) -> Column:
    return F.nullif(value, F.lit(sentinel))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields null for a null or zero divisor, ANSI mode or not."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def fill_zero(df: DataFrame, *columns: str) -> DataFrame:
    return df.fillna({name: 0 for name in columns})


@dataclass(frozen=True)
class ColumnRule:
    """How one target column is made from one or more raw spellings of it.

    ``raw``       raw field names; the first non-null spelling wins.
    ``target``    name in the formatted table.
    ``kind``      "int", "double" or "string".
    ``hyphens``   replace hyphens by spaces, before the sentinel is compared.
    ``sentinel``  text that stands for a missing value.
    """

    raw: tuple[str, ...]
    target: str
    kind: str = "string"
    hyphens: bool = False
    sentinel: str | None = None

    def source(self, parent: str | None = None) -> Column:
        spellings = [quoted(parent)[name] if parent else quoted(name) for name in self.raw]
        return spellings[0] if len(spellings) == 1 else F.coalesce(*spellings)

    def column(self, parent: str | None = None) -> Column:
        value = self.source(parent)
        if self.kind == "int":
            value = to_int(value)
        elif self.kind == "double":
            value = to_double(value)
        elif self.kind != "string":
            raise ValueError(f"unknown kind {self.kind!r} for {self.target!r}")
        if self.hyphens:
            value = hyphens_to_spaces(value)
        if self.sentinel is not None:
            value = text_to_null(value, self.sentinel)
        return value.alias(self.target)


def apply_rules(
    df: DataFrame, rules: Iterable[ColumnRule], parent: str | None = None
) -> DataFrame:
    """One projection from raw to formatted columns; ``parent`` is a struct column."""
    return df.select(*[rule.column(parent) for rule in rules])


def apply_rules_beside_raw(
    df: DataFrame, rules: Iterable[ColumnRule], parent: str | None = None
) -> DataFrame:
    """``apply_rules``, and for each numeric column the raw text it was read from."""
    rules = list(rules)
    raw = [rule.source(parent).alias(RAW + rule.target) for rule in rules if rule.kind != "string"]
    return df.select(*[rule.column(parent) for rule in rules], *raw)


def rejected_counts(rules: Iterable[ColumnRule]) -> list[Column]:
    """Row count and, per numeric column, the rows whose raw text is present but unreadable.

    For ``agg`` or ``observe`` over ``apply_rules_beside_raw``: sentinels turned into null
    stay visible without another pass, and no text is parsed twice.
    """
    counts = [F.count(F.lit(1)).alias("rows")]
    for rule in rules:
        if rule.kind != "string":
            lost = quoted(RAW + rule.target).isNotNull() & quoted(rule.target).isNull()
            counts.append(F.count_if(lost).alias(f"rejected_{rule.target}"))
    return counts


FAILED, RAW_TEXT = "_failed", "_raw"


def apply_rules_with_failures(
    df: DataFrame, rules: Iterable[ColumnRule], parent: str | None = None
) -> DataFrame:
    """``apply_rules``, with ``FAILED``, the targets whose raw text is there but cannot be read, and
    ``RAW_TEXT``, the text of every rule's source where one of them failed (null elsewhere).

    Names are collected beside the casts: each text is parsed once.
    """
    rules = list(rules)
    source = lambda rule: rule.source(parent).cast("string")
    both = df.select(
        *[rule.column(parent) for rule in rules],
        F.struct(*[source(rule).alias(rule.target) for rule in rules]).alias(RAW_TEXT),
    )
    raw = lambda rule: F.col(RAW_TEXT)[rule.target]
    lost = [
        F.when(raw(rule).isNotNull() & quoted(rule.target).isNull(), F.lit(rule.target))
        for rule in rules
        if rule.kind != "string"
    ]
    failed = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    both = both.withColumn(FAILED, failed)
    return both.withColumn(RAW_TEXT, F.when(F.size(FAILED) > 0, F.col(RAW_TEXT)))
