"""A search index as tables: scrolls, point reads, field texts, exports, reports, checks of answers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Suffixes of fields that a point read leaves out.
HIDDEN = ("_vec", "_tks", "_ltks")
#: Rows of a scroll's page, seconds in which a change counts as recent, tokens after which a stream sends on.
PAGE, RECENT_SECONDS, SEND_TOKENS = 100, 600, 16


def scroll(rows: DataFrame, key: str, after: object | None = None, size: int = PAGE) -> DataFrame:
    """The page of rows whose key follows `after`; the last key of a page is the next one's cursor."""
    rest = rows if after is None else rows.where(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(size)


def scrolled(rows: DataFrame, key: str, size: int = PAGE) -> Iterator[DataFrame]:
    """All pages, one after the other."""
    after = None
    while last := scroll(rows, key, after, size).agg(F.max(key)).first()[0]:
        yield scroll(rows, key, after, size)
        after = last


def create(spark: SparkSession, name: str, schema: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({schema}) USING parquet")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def visible(rows: DataFrame) -> DataFrame:
    """Rows without vectors and tokens."""
    return rows.select(*(c for c in rows.columns if not c.endswith(HIDDEN)))


def field_texts(rows: DataFrame, key: str) -> DataFrame:
    """(key, field, text): lists joined by tabs, everything else as text; null fields go."""
    def one(name: str, kind: str) -> Column:
        text = F.array_join(F.col(name).cast("array<string>"), "\t") if kind.startswith("array") else F.col(name).cast("string")
        return F.struct(F.lit(name).alias("field"), text.alias("text"))

    pairs = F.array(*(one(c, kind) for c, kind in rows.dtypes if c != key))
    return rows.select(key, F.inline(pairs)).where("text is not null")


def recent(rows: DataFrame, changed: str, now: Column, seconds: int = RECENT_SECONDS) -> DataFrame:
    return rows.where(F.col(changed) >= now - F.expr(f"INTERVAL {seconds} SECONDS"))


def csv_lines(rows: DataFrame, columns: list[str]) -> Column:
    """A row as a CSV line; quotes are doubled, and values with a comma, quote or line end quoted."""
    def one(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return F.concat_ws(",", *map(one, columns))


def has_fields(answer: Column, wanted: dict[str, str]) -> Column:
    """Whether a JSON object has every key of wanted with a value of its type: string, number, boolean, array or object."""
    value = F.try_parse_json(answer)
    kinds = {"string": ("STRING",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",)}
    out = F.lit(True)
    for key, kind in wanted.items():
        found = F.schema_of_variant(F.try_variant_get(value, f"$.{key}", "variant"))
        out = out & F.coalesce(F.regexp_extract(found, "^[A-Z]+", 0).isin(*kinds[kind]), F.lit(False))
    return out


def valid_parameter(value: Column, rule: str, most: float | None = None) -> Column:
    """The checks of component parameters: string, empty, positive integer, positive number, nonnegative number, decimal in 0 to 1, boolean."""
    number, whole = value.try_cast("double"), value.try_cast("long")
    rules = {
        "string": value.isNotNull() & (value != ""),
        "empty": value.isNull() | (value == ""),
        "positive_integer": (whole > 0) & ~value.contains("."),
        "positive_number": number > 0,
        "nonnegative_number": number >= 0,
        "decimal": (number >= 0) & (number <= 1),
        "boolean": F.lower(value).isin("true", "false"),
    }
    ok = rules[rule] if most is None else rules[rule] & (number <= most)
    return F.coalesce(ok, F.lit(False))


def report_lines(metrics: DataFrame, query: str, metric: str) -> DataFrame:
    """(place, line): a Markdown table of the queries by ascending metric, then its mean."""
    body = metrics.select(F.col(metric).alias("m"), F.concat(F.lit("| "), F.col(query).cast("string"), F.lit(" | "), F.format_number(metric, 4), F.lit(" |")).alias("line"), F.col(query).cast("string").alias("q"))
    rows = body.select(F.struct(F.lit(1).alias("part"), "m", "q").alias("place"), "line")
    head = metrics.sparkSession.createDataFrame([(0, 0.0, "0", "| query | score |"), (0, 0.0, "1", "| --- | --- |")], "part int, m double, q string, line string")
    mean = metrics.agg(F.concat(F.lit("| mean | "), F.format_number(F.avg(metric), 4), F.lit(" |")).alias("line")).select(F.struct(F.lit(2).alias("part"), F.lit(0.0).alias("m"), F.lit("").alias("q")).alias("place"), "line")
    return head.select(F.struct("part", "m", "q").alias("place"), "line").unionByName(rows).unionByName(mean)


def html_table(headers: list[str], cells: list[str], caption: str) -> tuple[str, Column]:
    """Head and row of an HTML block: the caption, the header row, and one row's cells."""
    head = f"<table><caption>{caption}</caption><tr>" + "".join(f"<th>{h}</th>" for h in headers) + "</tr>"
    row = F.concat(F.lit("<tr>"), *(F.concat(F.lit("<td>"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("</td>")) for c in cells), F.lit("</tr>"))
    return head, row


def html_blocks(table: DataFrame, key: str, order: str, columns: list[str], size: int, caption: str) -> DataFrame:
    """(key, chunk, content): a sheet's rows as HTML tables of `size` rows, each with caption and header."""
    from lodestone.operators.chunking import grouped_rows

    head, row = html_table(columns, columns, caption)
    blocks = grouped_rows(table.withColumn("__row", row), order, "__row", size, key)
    return blocks.select(key, "chunk", F.concat(F.lit(head), F.replace("content", F.lit("; <tr>"), F.lit("<tr>")), F.lit("</table>")).alias("content"))


def sent_parts(pieces: DataFrame, key: str, order: str, n_tokens: str, least: int = SEND_TOKENS) -> DataFrame:
    """Of each streamed answer the moments it is sent on: the pieces at which `least` tokens are new, and its last one."""
    items = pieces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, n_tokens))).alias("items"))
    start = F.struct(F.array().cast("array<struct<at:bigint,total:bigint>>").alias("out"), F.lit(0).cast("long").alias("new"), F.lit(0).cast("long").alias("total"))

    def step(acc: Column, x: Column) -> Column:
        new, total = acc["new"] + x[n_tokens].cast("long"), acc["total"] + x[n_tokens].cast("long")
        send = new >= least
        out = F.when(send, F.concat(acc["out"], F.array(F.struct(x[order].cast("long").alias("at"), total.alias("total"))))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.when(send, F.lit(0).cast("long")).otherwise(new).alias("new"), total.alias("total"))

    def end(acc: Column) -> Column:
        last = F.struct(F.element_at("items", -1)[order].cast("long").alias("at"), acc["total"].alias("total"))
        return F.when(acc["new"] > 0, F.concat(acc["out"], F.array(last))).otherwise(acc["out"])

    return items.select(key, F.inline(F.aggregate("items", start, step, end)))
