"""Document structure: bullet families, title levels, heading stacks, contents tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lodestone.functions.text import is_no_bullet

# Bullet patterns, highest level first, by family.
BULLETS = (
    (r"第[零一二三四五六七八九十百0-9]+(分?编|部分)", r"第[零一二三四五六七八九十百0-9]+章", r"第[零一二三四五六七八九十百0-9]+节", r"第[零一二三四五六七八九十百0-9]+条", r"[\(（][零一二三四五六七八九十百]+[\)）]"),
    (r"第[0-9]+章", r"第[0-9]+节", r"[0-9]{0,2}[\. 、]", r"[0-9]{0,2}\.[0-9]{0,2}[^a-zA-Z/%~-]", r"[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}", r"[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}"),
    (r"第[零一二三四五六七八九十百0-9]+章", r"第[零一二三四五六七八九十百0-9]+节", r"[零一二三四五六七八九十百]+[ 、]", r"[\(（][零一二三四五六七八九十百]+[\)）]", r"[\(（][0-9]{0,2}[\)）]"),
    (r"PART (ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE|TEN)", r"Chapter (I+V?|VI*|XI|IX|X)", r"Section [0-9]+", r"Article [0-9]+"),
)
#: Fixed value: headings of a contents table.
CONTENTS = r"^(contents|目录|目次|table of contents|致谢|acknowledge)$"


def _is_bullet(line: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(or_, (line.rlike("^(?:" + p + ")") for p in patterns)) & ~is_no_bullet(line)


def bullet_family(lines: DataFrame, key: str, line: str) -> DataFrame:
    """(key, family, hits): the family with most bullets; the first of equals, -1 without any."""
    hits = [F.sum(_is_bullet(F.col(line), ps).cast("int")) for ps in BULLETS]
    counted = lines.groupBy(key).agg(F.array(*hits).alias("hits"))
    best = F.array_max("hits")
    return counted.select(key, F.when(best > 0, F.array_position("hits", best) - 1).otherwise(-1).cast("int").alias("family"), best.alias("hits"))


def title_levels(lines: DataFrame, line: str, family: int, layout: str | None = None, into: str = "level") -> DataFrame:
    """Each line's bullet level in a family; titles by layout come below all bullets, body text last."""
    patterns = BULLETS[family]
    c = F.trim(line)
    level = F.lit(len(patterns) + 1)
    if layout:
        level = F.when(F.col(layout).rlike("title|head"), len(patterns)).otherwise(level)
    for k in range(len(patterns) - 1, -1, -1):
        level = F.when(_is_bullet(c, patterns[k : k + 1]), k).otherwise(level)
    return lines.withColumn(into, level)


def most_frequent_level(levels: DataFrame, key: str, body: int, level: str = "level") -> DataFrame:
    """(key, most): the most frequent level that is no body text, the higher of equals; body if there is none."""
    votes = levels.groupBy(key, level).agg(F.count("*").alias("n"))
    best = F.min_by(level, F.when(F.col(level) < body, F.struct(-F.col("n"), F.col(level))))
    return votes.groupBy(key).agg(F.coalesce(best, F.lit(body)).alias("most"))


def sections(levels: DataFrame, key: str, order: str, pivot: Column, level: str = "level", into: str = "section") -> DataFrame:
    """Section numbers: a new one where the level is at or above the pivot and changes."""
    w = W.partitionBy(key).orderBy(order)
    new = (F.col(level) <= pivot) & ~F.col(level).eqNullSafe(F.lag(level).over(w)) & F.lag(level).over(w).isNotNull()
    # The flag becomes a column first: a window cannot hold another.
    return levels.withColumn("__new", new.cast("int")).withColumn(into, F.sum("__new").over(w)).drop("__new")


def heading_stack(lines: DataFrame, key: str, order: str, line: str) -> DataFrame:
    """(key, order, stack, line) of body lines: the headings above them, each under the ones of fewer #."""
    depth = F.length(F.regexp_extract(line, r"^(#{1,6}) ", 1))
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    out = lines.withColumn("__d", depth)
    for k in range(1, 7):
        out = out.withColumn(f"__h{k}", F.last(F.when(F.col("__d") == k, F.struct(F.col(order).alias("at"), F.regexp_replace(line, r"^#+ ", "").alias("t"))), True).over(w))
    stack = []
    for k in range(1, 7):
        above = F.greatest(*(F.coalesce(F.col(f"__h{j}.at").cast("long"), F.lit(-1)) for j in range(1, k)), F.lit(-1), F.lit(-1))
        stack.append(F.when(F.col(f"__h{k}.at").cast("long") > above, F.col(f"__h{k}.t")))
    return out.where("__d = 0").select(key, order, F.concat_ws("\n", *stack).alias("stack"), line)


def repeats_within(lines: DataFrame, key: str, order: str, line: str, rows: int = 128) -> DataFrame:
    """Lines with the distance to the next line that begins alike (three characters), if within `rows`."""
    w = W.partitionBy(key, F.substring(line, 1, 3)).orderBy(order)
    gap = F.lead(order).over(w) - F.col(order)
    return lines.withColumn("next_in", F.when(gap <= rows, gap))


def without_contents(lines: DataFrame, key: str, order: str, line: str, rows: int = 128) -> DataFrame:
    """Drops a contents heading and what follows it up to where its first entry's prefix comes again.

    A heading is told by its line without position tags and blanks, in lower case as it stands.
    """
    w = W.partitionBy(key).orderBy(order)
    heading = F.regexp_replace(F.regexp_extract(line, r"(?s)^(.*?)(?:@@|$)", 1), r"[ \u00a0　]+", "").rlike(CONTENTS)
    first = lines.withColumn("__head", heading).withColumn("__after", F.lag("__head").over(w))
    entry = F.last(F.when(F.col("__after"), F.struct(F.col(order).alias("at"), F.substring(line, 1, 3).alias("prefix"))), True).over(w.rowsBetween(W.unboundedPreceding, 0))
    marked = first.withColumn("__entry", entry)
    again = (F.substring(line, 1, 3) == F.col("__entry.prefix")) & (F.col(order) > F.col("__entry.at")) & (F.col(order) <= F.col("__entry.at") + rows)
    ends = marked.where(again).groupBy(F.col(key).alias("__key"), F.col("__entry.at").alias("__at")).agg(F.min(order).alias("__end"))
    joined = marked.join(ends, (F.col(key) == F.col("__key")) & (F.col("__entry.at") == F.col("__at")), "left")
    inside = F.col("__entry").isNotNull() & (F.col(order) < F.coalesce("__end", F.col("__entry.at") + 1))
    return joined.where(~F.coalesce(F.col("__head"), F.lit(False)) & ~F.coalesce(inside, F.lit(False))).select(*lines.columns)


def bigram_overlap(a: Column, b: Column) -> Column:
    """Shared character pairs over the larger number of distinct pairs."""
    pairs = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(2))))
    return F.size(F.array_intersect(pairs(a), pairs(b))) / F.greatest(F.size(pairs(a)), F.size(pairs(b)), F.lit(1))
