"""Tokens and questions where no dictionary is at hand: CJK texts, short questions, and the engine's score.

A question is small and becomes literals of the plan; texts are tokenised by Column expressions.
Dictionaries (word frequencies and tags, synonyms, stop words) are optional tables or mappings of the caller.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lodestone.functions import text as T
from lodestone.operators import retrieval as R

# Chinese characters; characters that separate tokens; marks that are dropped before weighing, or taken from a question.
HAN = "一-龥"
SEPARATORS = r""" ,\.<>/?;:'\[\]\\`!@#$%^&*\(\)\{\}\|_+=《》，。？、；‘’：“”【】~！￥%……（）——-"""
DROPPED = r"""[~—\t @#%!<>,\.\?":;'\{\}\[\]_=\(\)\|，。？》•●○↓《；‘’：“”【¥ 】…￥！、·（）×`&\\/「」\\]"""
QUESTION_MARKS = r"[ :\r\n\t,，。？?/`!！&\^%%]+"
SMALL_MARKS = r"""[ ,\./;'\[\]\\`~!@#$%\^&\*\(\)=\+_<>\?:"\{\}\|，。；‘’【】、！￥……（）——《》？：“”-]+"""
#: Shares of a question's clauses that must match: the first search, and after it found nothing.
LEAST_SHARE, FALLBACK_SHARE = 0.3, 0.1
#: Segments of a question, and keywords after which its segments add no more.
MOST_SEGMENTS, MOST_KEYWORDS = 256, 12
#: Runs of separators of which every character is a token, but for runs of dots and hyphens.
_HAN_TOKEN = rf"(?<![{SEPARATORS}])[.-]{{2,}}(?![{SEPARATORS}])|[a-z][a-z.-]*|[0-9][0-9,.-]*|\S"


def is_chinese(c: Column) -> Column:
    return c.rlike(f"^[{HAN}]")


def is_number(c: Column) -> Column:
    return c.rlike("^[0-9]")


def is_alphabet(c: Column) -> Column:
    return c.rlike("^[A-Za-z]")


def tokens(text: Column) -> Column:
    """array<string>: a text with Chinese characters gives each of them and its Latin and numeric runs, others their Latin tokens."""
    wide = F.when(text.rlike("[　\uff00-\uff5e]"), T.half_width(text)).otherwise(text)
    cut = lambda low: F.when(low.rlike(f"[{HAN}]"), F.regexp_extract_all(low, F.lit(_HAN_TOKEN), F.lit(0))).otherwise(R.tokens(low))
    return T.bound(F.lower(wide), cut)


def fine_tokens(tks: Column) -> Column:
    """Tokens, split at slashes if fewer than a fifth begin with a Chinese character: without a dictionary the rest cannot be split."""
    han = F.size(F.filter(tks, is_chinese))
    return F.when(han < 0.2 * F.size(tks), F.flatten(F.transform(tks, lambda t: F.split(t, "/")))).otherwise(tks)


def tokenise(line: str) -> list[str]:
    """As `tokens`, for a question."""
    low = "".join(" " if c == "　" else chr(ord(c) - 0xFEE0) if 0xFF01 <= ord(c) <= 0xFF5E else c for c in line).lower()
    return re.findall(_HAN_TOKEN, low) if re.search(f"[{HAN}]", low) else re.findall(R.TOKEN, low)


def pretoken(line: str, numbers: bool = False, stop_words: frozenset[str] = frozenset()) -> list[str]:
    """Tokens without stop words, single digits (unless numbers) and marks."""
    found = tokenise(re.sub(DROPPED, " ", line))
    return [t for t in found if t not in stop_words and (numbers or not re.match(r"[0-9]$", t)) and not re.match(DROPPED, t)]


def merged(tks: list[str], stop_words: frozenset[str] = frozenset()) -> list[str]:
    """Runs of two to four short tokens are glued, longer ones in pairs; a short first token joins a longer Chinese one."""
    short = lambda t: len(t) == 1 or re.fullmatch(r"[0-9a-z]{1,2}", t) is not None
    tks = [t for t in tks if t]
    out, at = [], 0
    if len(tks) > 1 and short(tks[0]) and len(tks[1]) > 1 and not re.match(r"[0-9a-zA-Z]", tks[1]):
        out, at = [" ".join(tks[:2])], 2
    while at < len(tks):
        run = next((k for k in range(at, len(tks)) if tks[k] in stop_words or not short(tks[k])), len(tks)) - at
        take = 1 if run < 2 else run if run < 5 else 2
        out.append(" ".join(tks[at : at + take]))
        at += take
    return out


def segments(line: str, functions: frozenset[str] = frozenset()) -> list[str]:
    """Blank-separated words; neighbours that both end in a Latin letter stay together, unless one is a function word."""
    out: list[str] = []
    for word in re.split(r"[ \t]+", line):
        latin = out and re.search(r"[a-zA-Z]$", out[-1]) and re.search(r"[a-zA-Z]$", word)
        if latin and word not in functions and out[-1] not in functions:
            out[-1] += " " + word
        else:
            out.append(word)
    return out


def weigh(tks: list[str]) -> list[tuple[str, float]]:
    """Tokens of one segment, marks dropped and short ones glued, with their share of its weight."""
    found = merged(pretoken(" ".join(tks)))
    each = [(t, R.term_weight(t)) for t in found]
    total = sum(w for _, w in each) or 1.0
    return [(t, w / total) for t, w in each]


@dataclass
class Clause:
    """A segment of a question: any of its terms may match; near holds the terms that are worth more close to each other."""

    segment: str
    terms: list[tuple[str, float]] = field(default_factory=list)
    near: list[str] = field(default_factory=list)
    synonyms: list[str] = field(default_factory=list)


def short_question(question: str, synonyms: dict[str, list[str]] | None = None) -> tuple[list[Clause], list[str]]:
    """Clauses and keywords of a Chinese question, or one of three words or fewer."""
    synonyms = synonyms or {}
    half = "".join(" " if c == "　" else chr(ord(c) - 0xFEE0) if 0xFF01 <= ord(c) <= 0xFF5E else c for c in question.lower())
    line = re.sub(QUESTION_MARKS, " ", half).strip()
    for pattern, by in ((T.INTERROGATIVES, ""), (T.QUESTION_WORDS, " "), (T.FILLERS, " ")):
        line = re.sub(pattern, by, line, flags=re.I)
    clauses, keywords = [], []
    for segment in [s for s in segments(line)[:MOST_SEGMENTS] if s]:
        own = synonyms.get(segment, [])
        clause = Clause(segment, synonyms=own)
        keywords += [segment, *own]
        weighed = weigh([segment])
        for term, w in sorted(weighed, key=lambda x: -x[1]):
            keywords.append(re.sub(r"""[ \\"']+""", "", term))
            clause.terms.append((term, w))
            if len(keywords) >= MOST_KEYWORDS:
                break
        clause.near = [t for t, _ in weighed] if len(weighed) > 1 else []
        clauses.append(clause)
    return clauses, list(dict.fromkeys(keywords))


def _phrase(joined: Column, phrase: str) -> Column:
    return joined.contains(f" {' '.join(tokenise(phrase))} ")


def _within(tks: Column, terms: list[str], slop: int) -> Column:
    """Whether the terms' first tokens all stand within a window of their number and slop more."""
    wanted = [t for term in terms for t in tokenise(term)]
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(tks), F.lit(1))), lambda i: F.array_contains(F.array(*map(F.lit, wanted)), F.get(tks, i - 1)))
    whole = lambda i: F.size(F.array_intersect(F.slice(tks, i, F.lit(len(wanted) + slop)), F.array(*map(F.lit, dict.fromkeys(wanted))))) == len(set(wanted))
    return F.exists(places, whole)


def match_clauses(tks: Column, clauses: list[Clause], share: float = LEAST_SHARE) -> Column:
    """The matched clauses' score, or null if fewer than share of them (rounded down, one at least) match.

    A term counts its weight, terms near each other 1.5 more, synonyms 0.7, and five times the terms where there are synonyms.
    """
    if not clauses:
        return F.lit(None).cast("double")
    joined = F.concat(F.lit(" "), F.array_join(tks, " "), F.lit(" "))
    return T.bound(F.struct(tks.alias("tks"), joined.alias("joined")), lambda x: _matched(x["tks"], x["joined"], clauses, share))


def _matched(tks: Column, joined: Column, clauses: list[Clause], share: float) -> Column:
    scores = []
    for c in clauses:
        own = reduce(lambda a, b: a + b, (F.when(_phrase(joined, t), F.lit(w)).otherwise(0.0) for t, w in c.terms), F.lit(0.0))
        if c.near:
            own = own + F.when(_within(tks, c.near, 4), 1.5).otherwise(0.0)
        if c.synonyms:
            own = 5 * own + reduce(lambda a, b: a + b, (F.when(_phrase(joined, s), 0.7).otherwise(0.0) for s in c.synonyms))
        scores.append(own)
    hits = lambda each: F.size(F.filter(each, lambda s: s > 0))
    total = lambda each: reduce(lambda a, b: a + b, (F.get(each, F.lit(i)) for i in range(len(scores))))
    return T.bound(F.array(*scores), lambda each: F.when(hits(each) >= max(1, int(share * len(clauses))), total(each)))


def engine_score(chunks: DataFrame, question: str, vector: list[float], column: str, least: float = 0.1, top: int = 1024) -> DataFrame:
    """Chunks (id, tks, vector column) that match the question, or are among the nearest matching ones, with tscore, vsim and their engine score.

    The score is 0.05 of the text's, BM25 of the terms by their weights, and the cosine for the `top` nearest matching
    chunks of at least `least`; statistics of the terms are taken over all chunks.
    """
    return _engine_scored(chunks, question, vector, column, least, top)[0]


def _engine_scored(chunks: DataFrame, question: str, vector: list[float], column: str, least: float, top: int) -> tuple[DataFrame, int]:
    """The scored chunks of `engine_score`, and how many match, counted with the terms' statistics."""
    weights = R.weights(question)
    terms = [*weights]
    stats = R.statistics(chunks, "tks", terms)
    # A generator keeps what matches: a condition would be pushed below the column of tokens, and cut the text once a term.
    matching = lambda tks: reduce(lambda a, b: a | b, (F.array_contains(tks, t) for t in terms))
    rest = [c for c in chunks.columns if c != "tks"]
    kept = chunks.select(*rest, F.explode(F.filter(F.array("tks"), matching)).alias("tks"))
    text = reduce(lambda a, b: a + b, (F.lit(w) * R.bm25(F.col("tks"), [t], stats) for t, w in weights.items()))
    norm = math.sqrt(math.fsum(x * x for x in vector)) or 1.0
    cosine = R.dot(F.col(column), R.literal_vector([x / norm for x in vector])) / F.sqrt(R.dot(F.col(column), F.col(column)))
    scored = kept.withColumn("tscore", text).withColumn("vsim", cosine)
    near = scored.where(F.col("vsim") >= least).orderBy(F.desc("vsim"), "id").limit(top).select("id", F.lit(True).alias("__near"))
    near = F.broadcast(near)  # at most `top` ids
    both = scored.join(near, "id", "left")
    return both.withColumn("score", R.QUERY_BOOST * F.col("tscore") + F.when(F.col("__near"), F.col("vsim")).otherwise(0.0)).drop("__near"), stats["matching"]


def retrieve(chunks: DataFrame, question: str, vector: list[float], column: str, page: int = 1, size: int = 30, least: float = 0.2, vector_weight: float = 0.3, top: int = 1024, model=None) -> tuple[DataFrame, DataFrame, int]:
    """A page of chunks (id, doc, tks, title and vector), the facets of its documents, and how many chunks match.

    The engine's order gives the candidates.  Up to page 3 they are reranked, by the question's shared words in content and title
    and the cosine, or by model(question, text) in the cosine's place; beyond, the engine's order stands and similarity is 1.
    """
    # Where no chunk matches, none does with a lower bound of the cosine either: it only adds to the score of matching ones.
    scored, total = _engine_scored(chunks, question, vector, column, least, top)
    order = F.desc("score"), F.col("id")
    if page > R.RERANK_PAGES:
        ranked = scored.orderBy(*order).limit(page * size)
        placed = ranked.withColumn("rank", F.row_number().over(W.orderBy(*order)))  # over at most page * size rows
        found = placed.where(F.col("rank") > (page - 1) * size).withColumn("sim", F.lit(1.0)).withColumn("tsim", F.lit(1.0)).withColumn("vsim", F.lit(1.0))
    else:
        candidates = scored.orderBy(*order).limit(size * R.RERANK_PAGES)
        words = F.concat("tks", F.col("title")) if "title" in chunks.columns else F.col("tks")
        if model is not None:
            candidates = candidates.withColumn("vsim", model(F.lit(question), T.squeeze_blanks(F.array_join(words, " "))))
        fused = candidates.withColumn("tsim", R.token_similarity(question, words))
        fused = fused.withColumn("sim", F.col("tsim") * (1 - vector_weight) + F.col("vsim") * vector_weight)
        placed = fused.withColumn("rank", F.row_number().over(W.orderBy(F.desc("sim"), "id")))  # over at most three pages
        found = placed.where((F.col("rank") > (page - 1) * size) & (F.col("rank") <= page * size) & (F.col("sim") >= least))
    facets = found.groupBy("doc").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "doc")
    return found.select("id", "doc", "rank", "sim", "tsim", "vsim"), facets, total


def tagged(tks: DataFrame, token: str, dictionary: DataFrame) -> DataFrame:
    """Tokens with their frequency and tag of a dictionary (word, freq, tag); 0 and empty for unknown ones."""
    known = dictionary.select(F.lower("word").alias(token), "freq", "tag").dropDuplicates([token])
    return tks.join(known, token, "left").withColumn("freq", F.coalesce("freq", F.lit(0))).withColumn("tag", F.coalesce("tag", F.lit("")))


def dictionary_of(lines: DataFrame, column: str = "value") -> DataFrame:
    """(word, freq, tag) of a user dictionary's lines `word freq tag`; the greatest frequency of a word counts."""
    parts = F.split(F.trim(column), r"[ \t]+")
    rows = lines.select(F.lower(F.get(parts, F.lit(0))).alias("word"), F.get(parts, F.lit(1)).try_cast("double").alias("freq"), F.get(parts, F.lit(2)).alias("tag"))
    return rows.where("word <> '' and freq is not null").groupBy("word").agg(F.max("freq").alias("freq"), F.max_by("tag", "freq").alias("tag"))
