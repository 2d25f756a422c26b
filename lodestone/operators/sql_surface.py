"""Questions in SQL over typed chunk views: clean up, full-text rewrite, run."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Share of a question's tokens that a text must hold, and never fewer than one.
LEAST_SHARE = 0.3


def clean_sql(answer: str) -> str:
    """The first SELECT of a model's answer, up to a semicolon or the end of a code fence."""
    flat = re.sub(r"[\r\n]+", " ", answer)
    at = re.search(r"\bselect\b", flat, re.I)
    if not at:
        raise ValueError("no SELECT statement")
    return re.split(r";|```", flat[at.start() :])[0].strip()


def match(tokens: Column, wanted: list[str], share: float = LEAST_SHARE) -> Column:
    """Whether blank-separated tokens hold at least that share, rounded down, of the wanted ones."""
    own = F.split(tokens, " ")
    hits = sum((F.array_contains(own, w).cast("int") for w in wanted), F.lit(0))
    return hits >= max(1, int(share * len(wanted)))


def rewrite(sql: str) -> str:
    """`x_tks LIKE 'a b'` and `x_tks = 'a b'` become token matches."""

    def one(m: re.Match) -> str:
        wanted = m[3].replace("%", " ").lower().split()
        tests = " + ".join(f"CAST(array_contains(split({m[1]}, ' '), '{w}') AS INT)" for w in wanted) or "0"
        return f"({tests}) >= {max(1, int(LEAST_SHARE * len(wanted)))}"

    return re.sub(r"(\w+_l?tks)\s*(like|=)\s*'([^']*)'", one, sql.replace("`", ""), flags=re.I)


def run(spark: SparkSession, views: dict[str, DataFrame], answer: str) -> DataFrame:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(rewrite(clean_sql(answer)))


def run_statements(spark: SparkSession, text: str, most: int = 30) -> list[DataFrame | str]:
    """Each statement's first rows, or its error as text."""
    out: list[DataFrame | str] = []
    for statement in filter(str.strip, text.split(";")):
        try:
            out.append(spark.sql(statement).limit(most))
        except Exception as e:  # a wrong statement is an answer, not a crash
            out.append(str(e).splitlines()[0])
    return out
