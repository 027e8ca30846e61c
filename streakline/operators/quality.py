"""Data-quality checks as counts of failing rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from streakline.operators.key_bits import is_whole, orphaned_keys, repeated_keys

ROW_WISE = ("not_null", "accepted_values")


class Check(NamedTuple):
    """``kind`` is not_null, unique, accepted_values or relationship."""

    table: str
    column: str
    kind: str
    values: Sequence[str] = ()
    parent: tuple[str, str] | None = None


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def relationship_failures(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value the parent lacks; NULLs do not count.

    The child's values are counted first, so a value that a third of the rows
    share crosses the network once.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("failing"))
    known = parent.select(F.col(parent_column).alias(column))
    return values.join(known, column, "left_anti")


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.where(~F.col(column).isin(*values))


def _values(df: DataFrame, columns: Sequence[str], kind: str | None = None) -> DataFrame:
    """``c, value, n``: how often each value of each column occurs; one pass for all columns, NULLs left out.

    Values keep their type where all columns (and ``kind``) have one, else they become text.
    """
    kinds = {dict(df.dtypes)[c] for c in columns} | ({kind} if kind else set())
    shared = kinds.pop() if len(kinds) == 1 else "string"
    cells = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast(shared).alias("value")) for i, c in enumerate(columns)])
    melted = df.select(F.inline(cells)).where("value is not null")
    return melted.groupBy("c", "value").agg(F.count(F.lit(1)).alias("n"))


def _entries(df: DataFrame, checks: Sequence[Check], failing: Sequence[Column]) -> DataFrame:
    """Report rows of ``checks``: one aggregate of ``df`` each, in one pass."""
    counts = df.agg(*[F.coalesce(x, F.lit(0)).cast("bigint").alias(f"c{i}") for i, x in enumerate(failing)])
    rows = [
        F.struct(
            F.lit(c.table).alias("table"), F.lit(c.column).alias("column"), F.lit(c.kind).alias("check"), F.col(f"c{i}").alias("failing")
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _fails(check: Check) -> Column:
    """Does a row fail this row-wise check?"""
    return F.col(check.column).isNull() if check.kind == "not_null" else ~F.col(check.column).isin(*check.values)


#: Failing rows by check.
Counted = Mapping[Check, int]


def counted_write(df: DataFrame, checks: Sequence[Check], write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict[Check, int]]:
    """``write(df)``, and how many of the written rows failed each row-wise check of ``checks``.

    The counts are metrics that ride on the write, so the table is not scanned again for them.
    """
    own = [c for c in checks if c.kind in ROW_WISE]
    if not own:
        return write(df), {}
    seen = Observation(f"checks-{uuid.uuid4().hex}")
    stored = write(df.observe(seen, *[F.count_if(_fails(c)).alias(f"c{i}") for i, c in enumerate(own)]))
    found = seen.get
    return stored, {c: found[f"c{i}"] for i, c in enumerate(own)}


def _by_bits(tables: dict[str, DataFrame], check: Check) -> DataFrame | None:
    """The report row of a check of whole-number keys, found through bitmaps; None for other checks."""
    df = tables[check.table]
    if check.kind == "unique" and is_whole(df, check.column):
        return _entries(repeated_keys(df, check.column), [check], [F.count(F.lit(1))])
    if check.kind == "relationship" and is_whole(df, check.column) and is_whole(tables[check.parent[0]], check.parent[1]):
        orphans = orphaned_keys(df, check.column, tables[check.parent[0]], check.parent[1])
        return _entries(orphans, [check], [F.sum("failing")])
    return None


def quality_report(
    tables: dict[str, DataFrame], checks: Sequence[Check], counted: Counted | None = None, bitmaps: bool = False
) -> DataFrame:
    """All checks in one table: table, column, check, failing.

    A table is read once for its row-wise checks, unless all of them are ``counted``, once for all
    its unique columns, and once per parent that its columns refer to. With ``bitmaps`` each check
    of whole-number keys reads its column twice instead, and shuffles bitmaps and suspects only:
    for tables whose keys are too many to shuffle.
    """
    parts, counted = [], counted or {}
    if bitmaps:
        found = {c: _by_bits(tables, c) for c in checks}
        parts += [row for row in found.values() if row is not None]
        checks = [c for c in checks if found[c] is None]
    known_rows = [(c.table, c.column, c.kind, counted[c]) for c in checks if c in counted]
    if known_rows:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(known_rows, "`table` string, `column` string, `check` string, failing bigint"))
    for name in dict.fromkeys(c.table for c in checks):
        df, own = tables[name], [c for c in checks if c.table == name]
        row_wise = [c for c in own if c.kind in ROW_WISE and c not in counted]
        if row_wise:
            parts.append(_entries(df, row_wise, [F.count_if(_fails(c)) for c in row_wise]))
        unique = [c for c in own if c.kind == "unique"]
        if unique:
            values = _values(df, [c.column for c in unique])
            again = [F.count_if((F.col("c") == i) & (F.col("n") > 1)) for i in range(len(unique))]
            parts.append(_entries(values, unique, again))
        for parent in dict.fromkeys(c.parent for c in own if c.kind == "relationship"):
            related = [c for c in own if c.kind == "relationship" and c.parent == parent]
            of_parent = tables[parent[0]]
            values = _values(df, [c.column for c in related], dict(of_parent.dtypes)[parent[1]])
            known = of_parent.select(F.col(parent[1]).cast(dict(values.dtypes)["value"]).alias("value"))
            orphans = values.join(known, "value", "left_anti")
            parts.append(_entries(orphans, related, [F.sum(F.when(F.col("c") == i, F.col("n"))) for i in range(len(related))]))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
