"""Language identification, words first.

Words of labelled documents, and the character n-grams of those words, are counted for each language
over the whole table.  The model keeps each language's words and n-grams down to the least count
(in steps of an eighth of a doubling) at which there are no more than its parameters allow, so that it can be
sent to every task; rarer words are scored like unseen ones.  A text's known words add their log
frequency in each language; an unseen word falls back to its n-grams, longest known length first.
The score is that of the mean word, raised to the root of the number of words.

Words are runs of letters (Unicode categories L*), in lower case.

Defined results: a null text, or one without a letter, is `und` with score 0; so is every text
if there is no labelled document.  Ties go to the language whose name sorts first.  Repeated rows
give repeated results; other columns are never read as features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodestone.llm.common import bounded_batches, cut, trim

#: Bounds of the model: words, and n-grams of each length, kept for each language; and its cells, a
#: row for each of them with a column for each language: with very many languages the first two shrink.
MODEL_WORDS, MODEL_GRAMS, MODEL_CELLS = 40_000, 5_000, 32_000_000
#: Lengths of n-grams tried for an unseen word, in this order.
LENGTHS = (5, 4, 3, 2, 1)
#: Longer runs of letters are never words of the model (a row of it has bounded bytes), but their n-grams count.
WORD_CHARS = 40
#: Distinct words that a worker holds at once.
FLUSH_WORDS = 60_000
UNKNOWN = "und"


_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    found = _WORD.findall(text.lower())
    if text.isascii() or "".join(found).isalpha() or not found:
        return found
    # Python's word characters hold numbers that are no letters (superscripts, fractions, numerals): they part words.
    return [w for x in found for w in ((x,) if x.isalpha() else "".join([c if c.isalpha() else " " for c in x]).split())]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}

    def flush():
        return pd.DataFrame([(lang, w, n) for lang, c in counts.items() for w, n in c.items()], columns=["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            counts.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, counts.values())) > FLUSH_WORDS:
            yield flush()
            counts = {}
            trim()
    if counts:
        yield flush()
    counts = {}
    trim()


def _step(n: Column) -> Column:
    """Eighths of a doubling."""
    return F.floor(8 * F.log2(n) + 1e-9).cast("int")


def _frequent(counts: DataFrame, by: list[str], most: int) -> DataFrame:
    """Rows of the greatest counts n in each group: whole steps of counts, `most` rows at most."""
    steps = counts.groupBy(*by, _step(F.col("n")).alias("step")).count().collect()  # some hundred steps a group at most
    least: dict[tuple, int] = {}
    held: Counter = Counter()
    for r in sorted(steps, key=lambda r: -r["step"]):
        key = tuple(r[c] for c in by)
        held[key] += r["count"]
        if held[key] <= most:
            least[key] = r["step"]
    if not least:
        return counts.limit(0)
    schema = ", ".join(f"{c} {counts.schema[c].dataType.simpleString()}" for c in by) + ", least int"
    # An Arrow table stays in the JVM; a list of rows would start Python workers on the executors.
    columns = [*zip(*((*k, v) for k, v in least.items()))]
    bounds = counts.sparkSession.createDataFrame(pa.table([*map(pa.array, columns)], names=[*by, "least"]), schema)
    return counts.join(F.broadcast(bounds), by).where(_step(F.col("n")) >= F.col("least")).drop("least")


def _grams(counts: DataFrame) -> DataFrame:
    """(lang, size, gram, n) of all words (lang, word, n), a blank at either end of a word."""
    framed = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    each = F.concat(*(F.regexp_extract_all(framed, F.lit(r"(?s)(?=(.{%d}))." % k), F.lit(1)) for k in LENGTHS))
    found = counts.select("lang", F.explode(each).alias("gram"), "n").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return found.select("lang", F.length("gram").alias("size"), "gram", "n")


class Model:
    """Log frequencies: one float32 matrix with a row for each known word and n-gram, a column for each language."""

    def __init__(self, langs: list[str], words: dict[str, int], grams: dict[int, dict[str, int]], rows: np.ndarray):
        self.langs, self.words, self.grams, self.rows = langs, words, grams, rows

    @staticmethod
    def of(langs: list[str], words: dict[str, np.ndarray], grams: dict[int, dict[str, np.ndarray]]) -> Model:
        """From vectors: each key's counts become a row of the matrix."""
        rows = [*words.values(), *(v for g in grams.values() for v in g.values())]
        at = iter(range(len(rows)))
        numbered = {w: next(at) for w in words}
        return Model(langs, numbered, {k: {x: next(at) for x in g} for k, g in grams.items()}, np.array(rows, "float32").reshape(-1, max(1, len(langs))))

    @staticmethod
    def frequencies(rows: list[tuple[str, str, int]], langs: list[str]) -> dict[str, np.ndarray]:
        """(language, key, count) to each key's log frequencies; half a count is added everywhere."""
        at = {lang: i for i, lang in enumerate(langs)}
        counts: dict[str, np.ndarray] = {}
        total = np.zeros(len(langs))
        for lang, key, n in rows:
            counts.setdefault(key, np.zeros(len(langs)))[at[lang]] = n
            total[at[lang]] += n
        total += 0.5 * len(counts)
        return {k: np.log((v + 0.5) / total).astype("float32") for k, v in counts.items()}

    def backoff(self, word: str) -> np.ndarray:
        """The mean row of the word's known n-grams of the greatest length that has any."""
        w = f" {word} "
        for k in LENGTHS:
            known = self.grams.get(k, {})
            hits = [known[g] for i in range(len(w) - k + 1) if (g := w[i : i + k]) in known]
            if hits:
                return self.rows[hits].mean(0)
        return np.zeros(len(self.langs), "float32")


class Predictor:
    """A model with room for the rows of unseen words; repeated ones back off once."""

    def __init__(self, model: Model, room: int = FLUSH_WORDS):
        self.model, self.size, self.room = model, len(model.rows), room
        self.rows = np.concatenate([model.rows, np.zeros((room + 1, model.rows.shape[1]), "float32")])
        self.seen: dict[str, int] = {}

    def _row(self, word: str) -> int:
        at = self.seen.get(word)
        if at is None:
            at = self.size + len(self.seen)
            self.rows[at] = self.model.backoff(word)
            self.seen[word] = at
        return at

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        langs = self.model.langs
        if not words or not langs:
            return UNKNOWN, 0.0
        total, known = np.zeros(len(langs)), self.model.words
        step = min(self.room, 20_000)
        for a in range(0, len(words), step):
            part = words[a : a + step]
            if len(self.seen) + len(part) > self.room:  # no row is given anew while a part is summed
                self.seen.clear()
            total += self.rows[[known[w] if w in known else self._row(w) for w in part]].sum(0, dtype="float64")
        mean = total / math.sqrt(len(words))
        best = int(np.argmax(mean))
        return langs[best], float(1 / np.exp(mean - mean[best]).sum())


def fit(docs: DataFrame, words: int = MODEL_WORDS, grams: int = MODEL_GRAMS) -> Model:
    """Count every labelled text of docs (lang, text) and keep the bounded model."""
    bounded_batches(docs.sparkSession)
    labelled = docs.select(F.col("lang").cast("string").alias("lang"), "text").where("lang is not null and text is not null")
    counts = cut(labelled.mapInPandas(_count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "counts")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    cells = MODEL_CELLS // max(1, 2 * len(langs) ** 2)
    rows = lambda df, *c: [tuple(r) for r in df.select("lang", *c, "n").toPandas().itertuples(index=False)]
    table = Model.frequencies(rows(_frequent(counts.where(F.length("word") <= WORD_CHARS), ["lang"], min(words, cells)), "word"), langs)
    by_size: dict[int, list[tuple]] = {}
    gram_counts = cut(_grams(counts), "grams")
    for lang, size, gram, n in rows(_frequent(gram_counts, ["lang", "size"], min(grams, cells // len(LENGTHS))), "size", "gram"):
        by_size.setdefault(size, []).append((lang, gram, n))
    return Model.of(langs, table, {k: Model.frequencies(part, langs) for k, part in by_size.items()})


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """docs with a struct column (lang_pred, score)."""
    bounded_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MODEL_CELLS

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = Predictor(shipped.value)
        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score"])
        del one
        trim()

    return docs.withColumn(into, predict(F.col(text)))
