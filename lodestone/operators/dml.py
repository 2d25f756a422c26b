"""Upserts, updates and deletes as pure transformations of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def upsert(old: DataFrame, new: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of new replace or join old's by key, column by column; nulls of new and columns `keep` leave old's values."""
    fresh = new.select(F.col(key), *(F.col(c).alias(f"__new_{c}") for c in new.columns if c != key))
    both = old.join(fresh, key, "full_outer")

    def column(c: str) -> Column:
        if c == key or c not in new.columns:
            return F.col(c)
        return F.coalesce(F.col(c), F.col(f"__new_{c}")) if c in keep else F.coalesce(F.col(f"__new_{c}"), F.col(c))

    added = [F.col(f"__new_{c}").alias(c) for c in new.columns if c not in old.columns]
    return both.select(*(column(c).alias(c) for c in old.columns), *added)


def update_where(df: DataFrame, where: Column, **values: Column) -> DataFrame:
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    """Rows for which the condition is true go; null is not true."""
    return df.where(~F.coalesce(where, F.lit(False)))


def delete_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def markdown_table(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """One row `markdown`: header, rule and rows in order; for result sets that are shown to a reader."""
    line = F.concat(F.lit("|"), F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit("|"))
    rows = df.select(F.struct(*order, line.alias("line")).alias("r")).agg(F.sort_array(F.collect_list("r")).alias("rs"))
    head = "|" + "|".join(columns) + "|\n|" + "|".join("---" for _ in columns) + "|\n"
    return rows.select(F.concat(F.lit(head), F.array_join(F.transform("rs", lambda r: r["line"]), "\n")).alias("markdown"))
