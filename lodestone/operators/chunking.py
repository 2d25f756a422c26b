"""Cutting texts, tables and question lists into chunks."""

from __future__ import annotations

import email
import email.policy
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lodestone.functions.text import approximate_tokens

#: Fixed value: the delimiters of plain text.
DELIMITERS = "\n!?;。；！？"
CHUNK_TOKENS = 128
BATCH = 4
#: Rows of a table that are numbered in one task, where no key divides them.
RANGE_ROWS = 100_000
#: Bytes of a codec probe, and the order in which codecs are tried.
PROBE = 1024
CODECS = (
    "utf-8", "gb2312", "gbk", "utf_16", "ascii", "big5", "big5hkscs",
    "cp037", "cp273", "cp424", "cp437",
    "cp500", "cp720", "cp737", "cp775", "cp850", "cp852", "cp855", "cp856", "cp857",
    "cp858", "cp860", "cp861", "cp862", "cp863", "cp864", "cp865", "cp866", "cp869",
    "cp874", "cp875", "cp932", "cp949", "cp950", "cp1006", "cp1026", "cp1125",
    "cp1140", "cp1250", "cp1251", "cp1252", "cp1253", "cp1254", "cp1255", "cp1256",
    "cp1257", "cp1258", "euc_jp", "euc_jis_2004", "euc_jisx0213", "euc_kr",
    "gb2312", "gb18030", "hz", "iso2022_jp", "iso2022_jp_1", "iso2022_jp_2",
    "iso2022_jp_2004", "iso2022_jp_3", "iso2022_jp_ext", "iso2022_kr", "latin_1",
    "iso8859_2", "iso8859_3", "iso8859_4", "iso8859_5", "iso8859_6", "iso8859_7",
    "iso8859_8", "iso8859_9", "iso8859_10", "iso8859_11", "iso8859_13",
    "iso8859_14", "iso8859_15", "iso8859_16", "johab", "koi8_r", "koi8_t", "koi8_u",
    "kz1048", "mac_cyrillic", "mac_greek", "mac_iceland", "mac_latin2", "mac_roman",
    "mac_turkish", "ptcp154", "shift_jis", "shift_jis_2004", "shift_jisx0213",
    "utf_32", "utf_32_be", "utf_7",
)


def greedy(sections: Column, limit: int = CHUNK_TOKENS) -> Column:
    """array<string>: sections are added to a chunk until it already exceeds the limit.

    A fold over the sections of one text; a chunk overshoots by one section at most.  No sections give no chunk.
    """
    start = F.struct(F.array().cast("array<string>").alias("chunks"), F.lit(limit + 1).alias("n"))

    def step(acc: Column, section: Column) -> Column:
        n = approximate_tokens(section)
        full = acc["n"] > limit
        grown = F.concat(F.slice(acc["chunks"], F.lit(1), F.size(acc["chunks"]) - 1), F.array(F.concat(F.element_at(acc["chunks"], -1), section)))
        return F.struct(F.when(full, F.concat(acc["chunks"], F.array(section))).otherwise(grown).alias("chunks"), F.when(full, n).otherwise(acc["n"] + n).alias("n"))

    return F.aggregate(sections, start, step, lambda acc: acc["chunks"])


def sentences(text: Column, delimiters: str = DELIMITERS) -> Column:
    """Pieces that end with a delimiter; the first character of a piece never ends it."""
    escaped = "".join("\\n" if c == "\n" else c for c in delimiters)
    return F.regexp_extract_all(text, F.lit(rf"(?s).[^{escaped}]*[{escaped}]?"), F.lit(0))


def plain_chunks(text: Column, limit: int = CHUNK_TOKENS) -> Column:
    return greedy(sentences(text), limit)


def packed(chunks: DataFrame, key: str, order: str, tokens: str, budget: int) -> DataFrame:
    """Chunks of each key get a pack number under a token budget, and a batch of four within the pack."""
    rows = chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, tokens))).alias("items"))
    start = F.struct(F.array().cast("array<struct<o:bigint,pack:int,place:int>>").alias("out"), F.lit(0).alias("pack"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, x: Column) -> Column:
        n = x[tokens].cast("long")
        new = (acc["place"] > 0) & (acc["n"] + n >= budget)
        pack, place = acc["pack"] + new.cast("int"), F.when(new, 0).otherwise(acc["place"])
        item = F.struct(x[order].cast("long").alias("o"), pack.alias("pack"), place.alias("place"))
        return F.struct(F.concat(acc["out"], F.array(item)).alias("out"), pack.alias("pack"), (place + 1).alias("place"), (F.when(new, 0).otherwise(acc["n"]) + n).alias("n"))

    out = rows.select(key, F.explode(F.aggregate("items", start, step, lambda acc: acc["out"])).alias("x"))
    return out.select(key, F.col("x.o").alias(order), F.col("x.pack").alias("pack"), F.floor(F.col("x.place") / BATCH).cast("int").alias("batch"))


def row_chunks(table: DataFrame, columns: list[str]) -> Column:
    """`column:value; ...` of a row's non-empty cells."""
    cells = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))) for c in columns]
    return F.concat_ws("; ", *cells)


def grouped_rows(table: DataFrame, order: str, text: str, size: int = 10, partition: str | None = None) -> DataFrame:
    """Rows in order, `size` to a chunk, numbered inside each value of partition, or inside ranges of the order column.

    Without a partition key the table is dealt into ranges of a size, so that no task gets all rows; the chunks
    of a range are full but for its last.
    """
    if partition is None:
        partition = "__range"
        table = table.repartitionByRange(max(1, -(-table.count() // RANGE_ROWS)), order).withColumn(partition, F.spark_partition_id())
    w = W.partitionBy(partition).orderBy(order)
    numbered = table.withColumn("__chunk", F.floor((F.row_number().over(w) - 1) / size).cast("int"))
    out = numbered.groupBy(partition, "__chunk").agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("rows"))
    return out.select(partition, F.col("__chunk").alias("chunk"), F.array_join(F.transform("rows", lambda r: r[text]), "; ").alias("content"))


def question_pairs(lines: DataFrame, key: str, order: str, question: str, answer: str) -> DataFrame:
    """A question with the answers below it, up to the next question; lines before the first one go."""
    w = W.partitionBy(key).orderBy(order)
    marked = lines.withColumn("__q", F.sum(F.when(F.col(question).isNotNull(), 1).otherwise(0)).over(w)).where(F.col("__q") > 0)
    out = marked.groupBy(key, "__q").agg(F.first(question, True).alias("question"), F.array_sort(F.collect_list(F.when(F.col(answer).isNotNull(), F.struct(order, answer)))).alias("a"))
    return out.where(F.size("a") > 0).select(key, "question", F.array_join(F.transform("a", lambda x: x[answer]), "\n").alias("answer"))


def task_ranges(sizes: DataFrame, size: str, step: int) -> DataFrame:
    """Rows of sizes, one for each range [from_, to_) of `step`."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col(size) - 1, F.lit(0)).cast("long"), F.lit(step).cast("long"))
    return sizes.withColumn("from_", F.explode(starts)).withColumn("to_", F.least(F.col("from_") + step, F.col(size)))


def hierarchical(lines: DataFrame, key: str, order: str, level: str, text: str, depth: int = 3) -> DataFrame:
    """Each line of the lowest level with its nearest headings above, level by level.

    level is 1 for the highest heading; null is body text.  A heading is forgotten when a higher one follows.
    """
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    out = lines
    for k in range(1, depth + 1):
        last = F.last(F.when(F.col(level) == k, F.struct(order, text)), True).over(w)
        out = out.withColumn(f"__h{k}", last)
    path = []
    for k in range(1, depth + 1):
        above = [F.coalesce(F.col(f"__h{j}.{order}"), F.lit(-1)) for j in range(1, k)]
        fresh = F.col(f"__h{k}.{order}") > (F.greatest(*above) if len(above) > 1 else above[0] if above else F.lit(-2))
        path.append(F.when(fresh, F.col(f"__h{k}.{text}")))
    body = F.col(level).isNull()
    return out.where(body).select(key, order, F.concat_ws("\n", *path, F.col(text)).alias("content"))


def markdown_tables(text: Column) -> Column:
    """Bordered tables of a Markdown text: a header row, a rule and rows."""
    return F.regexp_extract_all(text, F.lit(r"(?m)(^\|.*\|[ \t]*\n\|(?:[ \t]*:?-+:?[ \t]*\|)+[ \t]*\n(?:\|.*\|[ \t]*(?:\n|$))*)"), F.lit(1))


def without_tables(text: Column) -> Column:
    return F.regexp_replace(text, r"(?m)^\|.*\|[ \t]*\n\|(?:[ \t]*:?-+:?[ \t]*\|)+[ \t]*\n(?:\|.*\|[ \t]*(?:\n|$))*", "")


def codec(blob: Column) -> Column:
    """The first codec that decodes the head of the bytes, or all of them; utf-8 if none does.

    Valid UTF-8 is told apart in the JVM; only other bytes go through Python.
    """

    @F.pandas_udf("string")
    def find(blobs: pd.Series) -> pd.Series:
        def decodes(b: bytes, name: str) -> bool:
            try:
                b.decode(name)
            except (UnicodeError, LookupError):
                return False
            return True

        def one(b: bytes | None) -> str | None:
            return None if b is None else next((c for c in CODECS if decodes(b[:PROBE], c) or decodes(b, c)), "utf-8")

        return blobs.map(one)

    # One argument that is null for valid UTF-8: Python gets no text it has nothing to say about.
    other = F.when(~F.is_valid_utf8(blob), blob)
    return F.when(blob.isNotNull(), F.coalesce(find(other), F.lit("utf-8")))


def json_chunks(text: Column, limit: int = 2000, least: int = 1800) -> Column:
    """array<string>: a JSON value cut along its structure into objects of about `limit` characters; lists become maps of indexes.

    A worklist of paths: what fits into the open object goes there whole; else the object is closed once it
    has `least` characters, and the value's members take its place in the list.  Single values always go in.
    """

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        shown = lambda x: json.dumps(x, ensure_ascii=False)
        indexed = lambda pairs: dict(pairs)

        def members(x) -> list[tuple[str, object]]:
            return [(str(i), v) for i, v in enumerate(x)] if isinstance(x, list) else list(x.items())

        def plain(x):
            return indexed((k, plain(v)) for k, v in members(x)) if isinstance(x, (list, dict)) else x

        def nested(leaves: list[tuple[tuple[str, ...], object]]) -> dict:
            root: dict = {}
            for path, v in leaves:
                at = root
                for k in path[:-1]:
                    at = at.setdefault(k, {})
                at[path[-1]] = v
            return root

        def one(t: str | None) -> list[str]:
            try:
                value = plain(json.loads(t or ""))
            except ValueError:
                return []
            if not isinstance(value, dict):
                return [shown(value)]
            todo, done, open_, used = [((k,), v) for k, v in reversed(value.items())], [], [], 2
            while todo:
                path, v = todo.pop()
                if len(shown({path[-1]: v})) >= limit - used and isinstance(v, dict):
                    if used >= least:
                        done, open_, used = [*done, open_], [], 2
                    todo += [((*path, k), x) for k, x in reversed(v.items())]
                    continue
                if len(shown({path[-1]: v})) >= limit - used and used >= least:
                    done, open_ = [*done, open_], []
                open_.append((path, v))
                used = len(shown(nested(open_)))
            return [shown(nested(x)) for x in [*done, open_] if x]

        return texts.map(one)

    return split(text)


def mail_parts(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, part, kind, text) of mail files: header lines, then text parts, attached mails included."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p, raw in zip(batch[path], batch[content]):
                m = email.message_from_bytes(raw or b"", policy=email.policy.default)
                rows.append((p, 0, "header", "\n".join(f"{k}: {v}" for k, v in m.items())))
                for i, part in enumerate(m.walk(), 1):
                    if part.get_content_maintype() == "text":
                        rows.append((p, i, part.get_content_subtype(), part.get_content()))
            yield pd.DataFrame(rows, columns=["path", "part", "kind", "text"])

    return files.select(path, content).mapInPandas(run, "path string, part int, kind string, text string")
