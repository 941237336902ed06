"""Keeping a caller's columns apart from an operator's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with underscores put before it until no column of `df` has it (case does not count)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def packed(df: DataFrame, keep: list[str] | None = None, **more: Column) -> DataFrame:
    """The columns of `df` (`keep`: only these) in one struct column `row`, so that an operator's own columns cannot clash with them.

    `more` are further columns, made from the columns of `df`.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)])
    return df.select(row.alias("row"), *[c.alias(name) for name, c in more.items()])


def unpacked(df: DataFrame, *more: str) -> DataFrame:
    return df.select("row.*", *more)
