"""Parser dispatch, résumé fields, detections, answers from SQL, and a file store."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestone.operators import chunking as C
from lodestone.operators import sql_surface as S

# Degrees by rank; markup in résumé fields; the file line that counts as none and the least time; tags dropped before tokens are taken.
DEGREES = ("初中", "高中", "中专", "大专", "专升本", "本科", "硕士", "博士", "博士后")
FIELD_MARKUP = r"""(?i)<[a-z0-9."=';,:\+_/ -]+>"""
NO_TIME, LEAST_TIME = "nan", "1970-01-01 00:00:00"
TABLE_TAGS = r"</?(table|td|caption|tr|th)( [^<>]{0,12})?>"
#: Overlap (intersection over union) from which a detection of the same class goes, and the least score of a detection.
MOST_OVERLAP, LEAST_SCORE = 0.2, 0.7
#: Boxes that one task handles, about.
TASK_BOXES = 50_000


def _whole(text: Column) -> Column:
    return F.array(text)


def _slides(text: Column) -> Column:
    return F.filter(F.split(text, "\f"), lambda p: F.trim(p) != "")


def _laws(text: Column) -> Column:
    """Articles: a line that begins with one takes the lines below it."""
    return F.filter(F.split(text, r"\n(?=第[零一二三四五六七八九十百0-9]+条|Article [0-9]+)"), lambda p: F.trim(p) != "")


def _rows(text: Column) -> Column:
    """`column:value; ...` of each line of a tab-separated text, under its first line."""
    lines = F.split(text, "\n")
    head = F.split(F.get(lines, F.lit(0)), "\t")
    row = lambda line: F.array_join(F.filter(F.zip_with(head, F.split(line, "\t"), lambda h, v: F.when(v != "", F.concat(h, F.lit(":"), v))), lambda x: x.isNotNull()), "; ")
    return F.filter(F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), row), lambda x: x != "")


def _questions(text: Column) -> Column:
    """Tab-separated question and answer lines; a line without a tab goes on with the answer above."""
    return F.filter(F.split(text, r"\n(?=[^\n]*\t)"), lambda p: p.contains("\t"))


def _mail(text: Column) -> Column:
    """The body below the header lines, as plain text."""
    return C.plain_chunks(F.regexp_replace(text, r"(?s)^(?:[A-Za-z-]+: [^\n]*\n)*\n?", ""))


#: Text parsers by id; an unknown id is parsed like plain text.  Pictures, audio and layouts need a model's text first.
PARSERS: dict[str, Callable[[Column], Column]] = {
    "general": C.plain_chunks, "naive": C.plain_chunks, "paper": C.plain_chunks, "book": C.plain_chunks, "manual": C.plain_chunks,
    "presentation": _slides, "laws": _laws, "qa": _questions, "table": _rows, "one": _whole, "picture": _whole, "audio": _whole, "email": _mail,
}


def dispatch(files: DataFrame, parser: str, text: str, key: str) -> DataFrame:
    """(key, parser, chunk, content): each file's text cut by its parser, in one pass over the files."""
    known = F.when(F.col(parser).isin(*PARSERS), F.col(parser)).otherwise("naive")
    chunks = F.lit(None).cast("array<string>")
    for name, parse in PARSERS.items():
        chunks = F.when(known == name, parse(F.col(text))).otherwise(chunks)
    return files.select(key, known.alias("parser"), F.posexplode(chunks).alias("chunk", "content"))


def field_text(value: Column) -> Column:
    return F.regexp_replace(value, FIELD_MARKUP, " ")


def table_text(value: Column) -> Column:
    """A chunk without its table tags, as it is tokenised."""
    return F.regexp_replace(value, TABLE_TAGS, " ")


def highest_degree(degrees: Column) -> Column:
    """The best known degree of a list; an unknown one if there is no other, empty without any."""
    rank = lambda d: F.array_position(F.array(*map(F.lit, DEGREES)), d)
    ranked = F.transform(degrees, lambda d, i: F.struct(rank(d).alias("r"), (-i).alias("i"), d.alias("d")))
    return F.coalesce(F.array_max(ranked)["d"], F.lit(""))


def time_text(value: Column) -> Column:
    """Epoch seconds or milliseconds as a time; other texts trimmed."""
    bare = F.trim(value.cast("string"))
    seconds = F.substring(bare, 1, 10).try_cast("long")
    return F.when(bare.rlike("^[0-9]{10,}"), F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")).otherwise(bare)


def year_month_day(value: Column) -> Column:
    """Struct of a date's parts as texts; month and day are 1 where they are missing or impossible."""
    t = time_text(value)
    year = F.when(t.rlike("^[0-9]{4}"), F.substring(t, 1, 4)).otherwise("")
    month = F.regexp_extract(t, r"[0-9]{4}.?([0-9]{1,2})", 1)
    day = F.regexp_extract(t, r"[0-9]{4}.?[0-9]{0,2}.?([0-9]{1,2})", 1)
    fits = lambda x, most: x.try_cast("int").between(1, most)
    return F.struct(year.alias("year"), F.when(fits(month, 12), month).otherwise("1").alias("month"), F.when(day == "", "01").when(fits(day, 31), day).otherwise("1").alias("day"))


def birth(value: Column, today: Column) -> Column:
    """Struct of birth date, birthday and age; null without a year."""
    p = year_month_day(value)
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    out = F.struct(F.concat_ws("-", p["year"], two(p["month"]), two(p["day"])).alias("birth_dt"), F.concat(two(p["month"]), two(p["day"])).alias("birthday_kwd"), (F.year(today) - p["year"].try_cast("int")).alias("age_int"))
    return F.when(p["year"] != "", out)


def greatest_time(lines: DataFrame, column: str) -> DataFrame:
    """One row: the greatest time text of a file's lines, or the least time."""
    return lines.where(F.col(column) != NO_TIME).agg(F.greatest(F.coalesce(F.max(column), F.lit(LEAST_TIME)), F.lit(LEAST_TIME)).alias("time"))


def kept_detections(boxes: DataFrame, page: str, kind: str, least_score: float = LEAST_SCORE, overlap: float = MOST_OVERLAP) -> DataFrame:
    """Greedy suppression: of each page and class the best scored box stays, those that overlap it go, and so on.

    boxes has id, x0, top, x1, bottom and score; a page's boxes of one class are few, and many pages share a task.
    """
    schema = boxes.schema
    tasks = max(1, -(-boxes.count() // TASK_BOXES))

    def greedy(x0, top, x1, bottom, area, order: np.ndarray) -> list[int]:
        kept = []
        while len(order):
            k, order = order[0], order[1:]
            kept.append(k)
            wide = np.clip(np.minimum(x1[order], x1[k]) - np.maximum(x0[order], x0[k]), 0, None)
            high = np.clip(np.minimum(bottom[order], bottom[k]) - np.maximum(top[order], top[k]), 0, None)
            order = order[wide * high < overlap * (area[order] + area[k] - wide * high)]
        return kept

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop(columns="__task").sort_values([page, kind, "score", "id"], ascending=[True, True, False, True], ignore_index=True)
        sides = [group[c].to_numpy("float64") for c in ("x0", "top", "x1", "bottom")]
        area = (sides[2] - sides[0]) * (sides[3] - sides[1])
        places = group.groupby([page, kind], sort=False).indices.values()
        return group.loc[[k for order in places for k in greedy(*sides, area, order)]]

    dealt = boxes.where(F.col("score") >= least_score).withColumn("__task", F.pmod(F.xxhash64(page, kind), F.lit(tasks)))
    return dealt.groupBy("__task").applyInPandas(run, schema)


def sql_prompt(table: str, fields: dict[str, str], question: str, last: str = "", error: str = "") -> str:
    """The question to a model: the table, its fields, the question, and what went wrong with the last statement."""
    out = [f"Table: {table}", "Fields:", *(f"{k}: {v}" for k, v in fields.items()), f"Question: {question}"]
    if error:
        out += [f"Your last SQL: {last}", f"Its error: {error}", "Correct it."]
    return "\n".join([*out, "Answer with one SQL statement and nothing else."])


def ask_sql(spark: SparkSession, model: Callable[[str], str], table: str, rows: DataFrame, fields: dict[str, str], question: str, tries: int = 2) -> DataFrame:
    """A question answered through a model's SQL over rows; a statement that fails is asked for again with its error."""
    from lodestone.operators.knowledge import projected

    last, error = "", ""
    for _ in range(tries):
        answer = model(sql_prompt(table, fields, question, last, error))
        try:
            last = projected(re.sub(r"(?i)^select\b", "select", S.clean_sql(answer)), [*fields])
            found = S.run(spark, {table: rows}, last)
            found.schema  # analysed here, so that an error is seen before the answer is used
            return found
        except Exception as e:  # a wrong statement goes back to the model
            error = str(e).splitlines()[0]
    raise ValueError(f"no SQL for the question: {error}")


def cited_table(rows: DataFrame, names: dict[str, str], order: list[str], doc: str = "doc_id", title: str = "docnm_kwd") -> tuple[DataFrame, DataFrame]:
    """(place, line): result rows as Markdown, each with a mark `##i$$` of its place, and the facets of their documents.

    Times of day at the end of a cell go; rows are a model's few, and are numbered in one task.
    """
    from pyspark.sql import Window as W

    shown = [c for c in rows.columns if c not in (doc, title)]
    heads = [re.sub(r"(/.*|（[^（）]+）)", "", names.get(c, c)) for c in shown]
    numbered = rows.withColumn("place", F.row_number().over(W.orderBy(*order)) - 1)
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    line = F.concat(F.lit("|"), F.concat_ws("|", *map(cell, shown)), F.lit("| ##"), F.col("place").cast("string"), F.lit("$$ |"))
    line = F.regexp_replace(line, r"T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+Z)?\|", "|")
    head = rows.sparkSession.createDataFrame([(-2, "|" + "|".join(heads) + "|Source|"), (-1, "|" + "|".join(["------"] * len(heads)) + "|------|")], "place int, line string")
    facets = rows.groupBy(doc).agg(F.min(title).alias("doc_name"), F.count("*").alias("count"))
    return head.unionByName(numbered.select("place", line.alias("line"))), facets


def graph_views(chunks: DataFrame, doc_id: object) -> DataFrame:
    """A document's graph and mind map chunks."""
    return chunks.where((F.col("doc_id") == F.lit(doc_id)) & F.col("knowledge_graph_kwd").isin("graph", "mind_map"))


class Store:
    """Objects by bucket and name in any file system that Spark reads, through Hadoop's interface."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf, self.root = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration(), root.rstrip("/")

    def _at(self, bucket: str, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{bucket}/{name}")
        return path.getFileSystem(self.conf), path

    def put(self, bucket: str, name: str, data: bytes) -> None:
        fs, path = self._at(bucket, name)
        out = fs.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def get(self, bucket: str, name: str) -> bytes:
        fs, path = self._at(bucket, name)
        source = fs.open(path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(source))
        finally:
            source.close()

    def exists(self, bucket: str, name: str) -> bool:
        fs, path = self._at(bucket, name)
        return bool(fs.exists(path))

    def remove(self, bucket: str, name: str) -> None:
        fs, path = self._at(bucket, name)
        fs.delete(path, False)
