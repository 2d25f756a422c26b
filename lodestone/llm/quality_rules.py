"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics are Spark column expressions.  Shallow boosted trees are grown in numpy on a bounded
sample of labelled rows; every path from a root becomes a conjunctive rule; a lasso logistic fit
keeps few of them; those are compiled back into one Spark column expression, which scores every
row without Python.

Defined results: a null text is empty; empty texts get the score of all-zero statistics; a null
or missing label is not learned from; repeated ids count once in the sample, with their mean label; without labels of
both classes the score is the share of label 1 (0.5 without any).  Scores never look at labels,
lang, source or doc_id.  Extra columns stay as they are.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Labelled rows to learn from, at most: those whose hashed ids are least.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, LEAST_ROWS = 40, 3, 32, 10
LASSO, LASSO_STEPS = 0.0008, 600
THRESHOLD = 0.3


def _parts(text: Column) -> dict[str, Column]:
    t = F.coalesce(text, F.lit(""))
    return {"t": t, "words": F.array_remove(F.split(t, r"\s+"), ""), "lines": F.split(t, "\n")}


def _measures(p: dict[str, Column]) -> dict[str, Column]:
    """Numbers from a text's parts.

    Code points of a class are counted as the length of what is left without the others: a count of
    matches would make a string of each.  Short words are the runs left without the long ones, which leave no two runs side by side.
    """
    t, left = p["t"], lambda others: F.length(F.regexp_replace(p["t"], others, ""))
    short = F.regexp_replace(t, r"[\p{L}\p{N}]{4,}+", "")
    return {
        "n": F.length(t),
        "words": F.size(p["words"]),
        "distinct_words": F.size(F.array_distinct(p["words"])),
        "upper": left(r"\P{Lu}+"),
        "digits": left("[^0-9]+"),
        "symbols": left(r"[\p{L}\p{N}\s.,;:'’\"()-]+"),
        "stops": left("[^.,;:]+"),
        "short_words": F.regexp_count(short, F.lit(r"[\p{L}\p{N}]++")),
        "repeats": F.regexp_count(t, F.lit(r"(?<!\S)(\S++)\s\1(?!\S)")),
        "lines": F.size(p["lines"]),
        "distinct_lines": F.when(t != "", F.size(F.array_distinct(p["lines"]))).otherwise(0),
    }


#: Statistics as measure / measure (0 for none), or log1p of a measure.
RATIOS = {
    "chars": ("n", None),
    "words": ("words", None),
    "word_length": ("n", "words"),
    "distinct_words": ("distinct_words", "words"),
    "upper": ("upper", "n"),
    "digits": ("digits", "n"),
    "symbols": ("symbols", "n"),
    "stops": ("stops", "words"),
    "short_words": ("short_words", "words"),
    "repeats": ("repeats", "words"),
    "lines": ("lines", "words"),
    "distinct_lines": ("distinct_lines", "lines"),
}


def _bound(held: dict[str, Column], then: Callable[[dict[str, Column]], Column]) -> Column:
    """`then` of the held columns, each of which is computed once however often it is used."""
    one = F.struct(*(v.alias(k) for k, v in held.items()))
    return F.get(F.transform(F.array(one), lambda s: then({k: s[k] for k in held})), F.lit(0))


def measured(text: Column, used: Iterable[str], then: Callable[[dict[str, Column]], Column]) -> Column:
    """`then` of the statistics of a text that are named in used."""
    wanted = {k: RATIOS[k] for k in RATIOS if k in set(used)}
    needed = {m for pair in wanted.values() for m in pair if m}

    def ratios(m: dict[str, Column]) -> dict[str, Column]:
        double = lambda x: m[x].cast("double")
        return {k: F.log1p(double(a)) if b is None else F.when(m[b] > 0, double(a) / m[b]).otherwise(0.0) for k, (a, b) in wanted.items()}

    return _bound(_parts(text), lambda p: _bound({k: v for k, v in _measures(p).items() if k in needed}, lambda m: _bound(ratios(m), then)))


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; each is 0.0 for the empty one."""
    held = measured(text, RATIOS, lambda s: F.struct(*(v.alias(k) for k, v in s.items())))
    return {k: held[k] for k in RATIOS}


#: A condition is (statistic, is_above, bound): statistic > bound, or not.
Condition = tuple[str, bool, float]


@dataclass
class Rules:
    intercept: float = 0.0
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def column(self, stats: dict[str, Column]) -> Column:
        """The score as one expression over columns of statistics."""
        test = lambda c: stats[c[0]] > c[2] if c[1] else stats[c[0]] <= c[2]
        parts = [F.when(functools.reduce(operator.and_, map(test, rule)), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules]
        # A balanced sum keeps the expression tree shallow.
        parts.append(F.lit(self.intercept))
        while len(parts) > 1:
            parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1 :]
        return 1 / (1 + F.exp(-parts[0]))


def _tree(codes: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, rows: np.ndarray, depth: int, path: tuple, out: list, score: np.ndarray) -> None:
    """Grows one tree by second-order gain; out gets (path, rows) of every node below the root."""
    g, h = gradient[rows].sum(), hessian[rows].sum()
    score[rows] = g / (h + 1.0)
    if path:
        out.append(path)
    if depth == 0 or len(rows) < 2 * LEAST_ROWS:
        return
    best = (1e-6, None)
    for j in range(codes.shape[1]):
        c = codes[rows, j]
        gs, hs, ns = (np.bincount(c, w, BINS).cumsum()[:-1] for w in (gradient[rows], hessian[rows], np.ones(len(rows))))
        gain = gs**2 / (hs + 1.0) + (g - gs) ** 2 / (h - hs + 1.0) - g**2 / (h + 1.0)
        gain[(ns < LEAST_ROWS) | (len(rows) - ns < LEAST_ROWS)] = -1
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], (j, k))
    if best[1] is None:
        return
    j, k = best[1]
    above = codes[rows, j] > k
    for side in (False, True):
        _tree(codes, gradient, hessian, rows[above == side], depth - 1, (*path, (j, side, k)), out, score)


def learn(names: list[str], x: np.ndarray, y: np.ndarray) -> Rules:
    """Rules from an array of statistics (rows, len(names)) and labels 0 and 1."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        p = min(max(share, 0.001), 0.999)
        return Rules(float(np.log(p / (1 - p))))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    margin, paths = np.full(len(y), np.log(share / (1 - share))), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        _tree(codes, y - p, p * (1 - p), np.arange(len(y)), DEPTH, (), paths, step)
        margin += 0.3 * step
    holds = lambda p: np.logical_and.reduce([(codes[:, j] > k) == side for j, side, k in p])
    rules: dict[bytes, tuple] = {}  # rules that hold alike count once: the first stays
    for p in dict.fromkeys(tuple(sorted(p)) for p in paths):
        rules.setdefault(np.packbits(holds(p)).tobytes(), p)
    unique = [*rules.values()]
    # Lasso logistic regression by accelerated proximal steps; the intercept is not penalised.
    full = np.ones((len(y), len(unique) + 1), "float32")
    for i, p in enumerate(unique):
        full[:, i] = holds(p)
    rate = 4 * len(y) / max(1e-9, np.linalg.norm(full, 2) ** 2)
    w = np.zeros(full.shape[1])
    w[-1] = np.log(share / (1 - share))
    ahead, t = w.copy(), 1.0
    for _ in range(LASSO_STEPS):
        gap = 1 / (1 + np.exp(-(full @ ahead.astype("float32")))) - y
        new = ahead - rate * (full.T @ gap.astype("float32")) / len(y)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * LASSO, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t2 * (new - w), new, t2
    named = lambda p: tuple((names[j], side, float(edges[j][k])) for j, side, k in p)
    return Rules(float(w[-1]), [(named(p), float(v)) for p, v in zip(unique, w[:-1]) if abs(v) > 1e-4])


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id, statistics and `label` of at most `rows` labelled documents, chosen by hashed id."""
    hashed = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y")).orderBy(*hashed).limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by rows
    held = measured(F.col("text"), RATIOS, lambda s: F.struct(*(v.alias(k) for k, v in s.items())))
    stats = texts.select("doc_id", "y", held.alias("held")).select("doc_id", "y", "held.*")
    return stats.orderBy(*hashed, *RATIOS).limit(rows)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Rules:
    names = [*RATIOS]
    got = sample(docs, labels, label, rows).toPandas().drop_duplicates("doc_id")
    return learn(names, got[names].to_numpy("float64"), got["y"].to_numpy("float64"))


def score(docs: DataFrame, rules: Rules, into: str = "score") -> DataFrame:
    """docs with a score in 0 to 1."""
    used = {c[0] for rule, _ in rules.rules for c in rule}
    if not used:
        return docs.withColumn(into, rules.column({}))
    return docs.withColumn(into, measured(F.col("text"), used, rules.column))
