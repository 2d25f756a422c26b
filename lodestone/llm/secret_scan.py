"""Secret scan: fixed patterns, and strings that a tokenizer can hardly shorten.

Natural text and identifiers take three or more characters a token under a byte-level BPE
vocabulary; random strings take under two.  A run of key characters whose ratio is low, and which
is neither a known digest nor an identifier or UUID, is reported as kind `random`.

Defined results: a null text is empty and has no spans; positions are code points, end exclusive;
repeated rows give repeated results; extra columns stay as they are.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lodestone.llm.common import bounded_batches, column_name, trim

KINDS = ("assign", "access", "hex", "random")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: A candidate has so many key characters, and at most so many characters a token.
RANDOM_LEAST, RANDOM_RATIO = 20, 2.1
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RANDOM_LEAST)
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_PURE_HEX = re.compile(r"[0-9a-fA-F]+")
_WORD_PART = re.compile(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}")
#: Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index into KINDS, end) of the base patterns."""
    out = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def is_known(run: str, tokens: Callable[[str], int]) -> bool:
    """Digests, UUIDs, plain numbers and identifiers are not secrets; tokens counts those of a string.

    A part of letters is a word only if the tokenizer shortens it: random letters are none.
    """
    core = run.strip("=_-+/")
    if not any(c.isalpha() for c in core):
        return True
    if len(core) in DIGEST_LENGTHS and _PURE_HEX.fullmatch(core) or _UUID.fullmatch(core):
        return True
    parts = _WORD_PART.findall(core)
    if 2 * sum(map(len, parts)) < len(core):
        return False
    return 2 * sum(len(p) for p in parts if len(p) > RANDOM_RATIO * tokens(p)) >= len(core)


def _ranks(ranks: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}


def scanner(ranks: str, pattern: str):
    """A function from a text to its sorted (start, kind index, end) spans."""
    import tiktoken

    enc = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=_ranks(ranks), special_tokens={})

    def tokens(run: str) -> int:
        return len(enc.encode_ordinary(run))

    def scan(text: str) -> list[tuple[int, int, int]]:
        found = base_spans(text)
        for m in _RUN.finditer(text):
            run = m.group()
            if len(run) <= RANDOM_RATIO * tokens(run) and not is_known(run, tokens):
                found.append((m.start(), 3, m.end()))
        return sorted(found)

    return scan


def secret_spans(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", into: str = "spans") -> DataFrame:
    """docs with one more column: the secret spans of the text, sorted by start and then kind.

    A column named `into` is replaced.
    ranks_path names a tiktoken rank file and pattern its splitting regex; both travel with the tasks.
    """
    bounded_batches(docs.sparkSession)
    with open(ranks_path, encoding="ascii") as f:
        ranks = f.read()
    kinds = KINDS

    @F.pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = scanner(ranks, pattern)
        for texts in batches:
            yield pd.Series([[{"kind": kinds[k], "start": a, "end": b} for a, k, b in scan(t)] if t else [] for t in texts])
        trim()

    return docs.withColumn(into, spans(F.col(text)))


def redact(docs: DataFrame, ranks_path: str, pattern: str, mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret span of text replaced by mark and n_chars counted anew; no row goes.

    Overlapping spans are replaced once, together.  A null text stays null.
    """
    name = column_name(docs, "spans")
    found = secret_spans(docs, ranks_path, pattern, into=name)
    # Fold from the left: (text so far, code points of the original consumed).
    step = lambda acc, s: F.struct(
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
        F.greatest(acc["at"], s["end"]).alias("at"),
    )
    kept = F.aggregate(
        F.col(name),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        step,
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))),
    )
    text = F.when(F.size(name) > 0, kept).otherwise(F.col("text"))
    out = found.withColumn("text", text).withColumn(name, F.size(name))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(name) == 0, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(docs.columns)


def digests(found: DataFrame, spans: str = "spans") -> DataFrame:
    """The contract's columns from a column of spans."""
    joined = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        joined(F.col(spans)).alias("spans"),
        count("random").alias("n_random"),
    )
