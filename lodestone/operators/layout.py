"""Boxes of a page: overlaps, duplicates, rows and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def overlap(a: str, b: str, ratio: bool = True) -> Column:
    """Area of a and b's intersection, as a share of a's if ratio; a and b are prefixes of x0, x1, top, bottom."""
    c = lambda side, k: F.col(f"{side}{k}")
    wide = F.least(c(a, "x1"), c(b, "x1")) - F.greatest(c(a, "x0"), c(b, "x0"))
    high = F.least(c(a, "bottom"), c(b, "bottom")) - F.greatest(c(a, "top"), c(b, "top"))
    area = F.when((wide > 0) & (high > 0), wide * high).otherwise(0.0)
    own = (c(a, "x1") - c(a, "x0")) * (c(a, "bottom") - c(a, "top"))
    return F.when(own > 0, area / own).otherwise(0.0) if ratio else area


def prefixed(boxes: DataFrame, prefix: str, *keep: str) -> DataFrame:
    return boxes.select(*keep, *(F.col(c).alias(f"{prefix}{c}") for c in boxes.columns if c not in keep))


def assign(boxes: DataFrame, layouts: DataFrame, page: str = "page", least: float = 0.4) -> DataFrame:
    """Each box with the layout that covers most of it, if at least `least`; pages are joined, not all boxes."""
    both = prefixed(boxes, "a_", page).join(prefixed(layouts, "b_", page), page)
    both = both.where("a_x0 < b_x1 and b_x0 < a_x1 and a_top < b_bottom and b_top < a_bottom").withColumn("share", overlap("a_", "b_"))
    best = F.row_number().over(W.partitionBy(page, "a_id").orderBy(F.desc("share"), "b_id"))
    return both.withColumn("r", best).where((F.col("r") == 1) & (F.col("share") >= least)).select(page, F.col("a_id").alias("id"), F.col("b_id").alias("layout"), "share")


def suppress(layouts: DataFrame, page: str = "page", share: float = 0.7) -> DataFrame:
    """Layouts of a page and type without those that a better scored one covers (or that cover it) to `share`."""
    both = prefixed(layouts, "a_", page).join(prefixed(layouts, "b_", page), page).where("a_id <> b_id and a_type = b_type")
    close = (overlap("a_", "b_") >= share) | (overlap("b_", "a_") >= share)
    worse = (F.col("a_score") < F.col("b_score")) | ((F.col("a_score") == F.col("b_score")) & (F.col("a_id") > F.col("b_id")))
    gone = both.where(close & worse).select(page, F.col("a_id").alias("id")).distinct()
    return layouts.join(gone, [page, "id"], "left_anti")


def row_neighbours(boxes: DataFrame, page: str, order: list[str], middle: Column, height: float, reach: int = 12) -> DataFrame:
    """in_row: of the `reach` boxes before and reach - 1 after, those whose middle is within a line's height."""
    w = W.partitionBy(page).orderBy(*order).rowsBetween(-reach, reach - 1)
    near = F.collect_list("__y").over(w)
    counted = boxes.withColumn("__y", middle).withColumn("__near", near)
    return counted.withColumn("in_row", F.size(F.filter("__near", lambda y: F.abs(y - F.col("__y")) < height)) - 1).drop("__y", "__near")


def rows_of(boxes: DataFrame, page: str, top: str, gap: float, into: str = "row") -> DataFrame:
    """Row numbers by gaps and islands: a new row where the next box's top is more than `gap` below the last one's."""
    w = W.partitionBy(page).orderBy(top, "id")
    new = F.coalesce((F.col(top) - F.lag(top).over(w) > gap).cast("int"), F.lit(0))
    return boxes.withColumn("__new", new).withColumn(into, F.sum("__new").over(w)).drop("__new")


def table_text(cells: DataFrame, key: str, row: str, column: str, text: str) -> DataFrame:
    """`header: cell` lines of a grid whose first row is the header."""
    head = cells.where(F.col(row) == 0).select(key, column, F.col(text).alias("__head"))
    body = cells.where(F.col(row) > 0).join(head, [key, column], "left")
    part = F.when(F.coalesce("__head", F.lit("")) != "", F.concat("__head", F.lit(": "), F.col(text))).otherwise(F.col(text))
    lines = body.groupBy(key, row).agg(F.array_sort(F.collect_list(F.struct(column, part.alias("p")))).alias("ps"))
    return lines.select(key, row, F.array_join(F.transform("ps", lambda p: p["p"]), "; ").alias("line"))
