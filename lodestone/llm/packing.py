"""Best-fit packing of documents into training sequences under conflicts.

A document is cut into pieces of at most `capacity` tokens; full pieces fill bins of their own, the
rest is packed.  Pieces are placed longest first.  Open bins are kept ordered by residual; from the
first one that is large enough the search goes on through its successors until the first, and
so the tightest, that holds neither the piece's source nor its duplicate cluster.  Both are exact bitmaps
over a shard's bins.

Documents are dealt into shards by hash.  A shard is packed by one task, holds about SHARD_ROWS
rows (SHARD_BYTES, if it carries texts) and leaves at most a few bins half full, so the loss does not grow with the corpus.

Tokens are blank-separated words unless the caller brings counts of its own (those of word_bpe, say).

Defined results: a null or empty text has no token and no piece; a null source or cluster
conflicts with nothing; repeated rows are pieces of their own; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lodestone.llm.common import bounded_batches, column_name, maybe_broadcast, trim

#: Tokens are runs of non-blanks, cut after TOKEN_CHARS code points.
TOKEN_CHARS = 64
_TOKEN = r"\S{1,%d}" % TOKEN_CHARS
_TOKENS = re.compile(_TOKEN)
CAPACITY, SHARD_ROWS = 2048, 20_000
#: Bytes of texts in a shard that carries them.
SHARD_BYTES = 8 << 20
PIECES = "doc_id string, piece int, first_token long, n_tokens int, shard long, bin int, slot int, begin int"


class Bins:
    """Open bins by residual, with exact bitmaps.

    Bit k of an integer stands for bin k.  `at` has the bins of each residual, `near` those of SPAN neighbouring
    residuals, `sources` and `clusters` those that hold a source or cluster.  The successors that
    hold neither are the bits of a residual's bitmap that the two others leave, so a hot source costs
    a few operations on bitmaps for each piece, however many bins hold it.
    """

    SPAN = 64

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.at = [0] * (capacity + 1)
        self.near = [0] * (capacity // self.SPAN + 1)
        self.sources: dict[str, int] = {}
        self.clusters: dict[str, int] = {}
        self.residual: list[int] = []  # by number of the bin
        self.slots: list[int] = []

    def place(self, size: int, source: str | None, cluster: str | None) -> tuple[int, int, int]:
        """(bin, slot, first free token before this piece); of equally tight bins the oldest."""
        number = self._tightest(size, self.sources.get(source, 0) | self.clusters.get(cluster, 0))
        if number is None:
            number = len(self.residual)
            self.residual.append(self.capacity)
            self.slots.append(0)
        else:
            self._flip(number)
        begin, slot = self.capacity - self.residual[number], self.slots[number]
        self.residual[number] -= size
        self.slots[number] += 1
        if self.residual[number]:  # a full bin is closed
            self._flip(number)
        for held, x in ((self.sources, source), (self.clusters, cluster)):
            if x is not None:
                held[x] = held.get(x, 0) | 1 << number
        return number, slot, begin

    def _tightest(self, size: int, held: int) -> int | None:
        span, left = self.SPAN, size
        while left <= self.capacity:
            if self.near[left // span] & ~held:
                for residual in range(left, min((left // span + 1) * span, self.capacity + 1)):
                    if fits := self.at[residual] & ~held:
                        return (fits & -fits).bit_length() - 1
            left = (left // span + 1) * span
        return None

    def _flip(self, number: int) -> None:
        """Takes a bin out of its residual's bitmaps, or puts it there."""
        residual = self.residual[number]
        self.at[residual] ^= 1 << number
        self.near[residual // self.SPAN] ^= 1 << number


def _joined(text: str, spans: list[tuple[int, int]]) -> str:
    """The spans of text with single blanks, but for those that a long run was cut into."""
    ends = [None, *(b for _, b in spans)]
    return "".join(text[a:b] if end in (None, a) else " " + text[a:b] for (a, b), end in zip(spans, ends))


def pack_shard(group: pd.DataFrame, capacity: int, with_text: bool = False) -> pd.DataFrame:
    own = group["text"] if with_text else group["doc_id"]
    none = lambda x: None if x is None or x is pd.NA or x != x else x
    rows, rest = [], []
    for doc, n, source, cluster, text in zip(group["doc_id"], group["n"].tolist(), group["source"], group["cluster"], own):
        full, left = divmod(n, capacity)
        words = [m.span() for m in _TOKENS.finditer(text)] if with_text and full else []
        part = lambda k: _joined(text, words[k * capacity : (k + 1) * capacity]) if words else text
        rows += [(doc, k, k * capacity, capacity, -1, 0, 0, part(k)) for k in range(full)]
        if left:
            rest.append((-left, doc or "", none(cluster) or "", full, none(source), none(cluster), doc, part(full)))
    rest.sort(key=lambda x: x[:4])
    bins = Bins(capacity)
    for left, _, _, full, source, cluster, doc, text in rest:
        number, slot, begin = bins.place(-left, source, cluster)
        rows.append((doc, full, full * capacity, -left, number, slot, begin, text))
    trim()
    out = pd.DataFrame(rows, columns=["doc_id", "piece", "first_token", "n_tokens", "bin", "slot", "begin", "text"])
    whole = out["bin"] < 0
    out.loc[whole, "bin"] = len(bins.residual) + np.arange(int(whole.sum()))
    return out.assign(shard=int(group["shard"].iloc[0]))[[c.split()[0] for c in _schema(with_text).split(", ")]]


def _schema(with_text: bool) -> str:
    return PIECES + ", text string" * with_text


_BLANK = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
#: Code points that are counted together.
_CHUNK = 1 << 17


def count_tokens(texts: list[str]) -> np.ndarray:
    """The tokens of each text, many texts at once."""
    points = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    blank = _BLANK[np.minimum(points, 0x3001)]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view("i1")))
    begin, end = edge[::2], edge[1::2]
    ends = np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))
    total = np.concatenate([[0], np.cumsum((end - begin + TOKEN_CHARS - 1) // TOKEN_CHARS)])[ends]
    return np.diff(total, prepend=0)


def _counts(batch: pd.Series) -> np.ndarray:
    held, size, out = [], 0, []
    for t in batch:
        held.append(t or "")
        size += len(held[-1]) + 1
        if size >= _CHUNK:
            out.append(count_tokens(held))
            held, size = [], 0
    out.append(count_tokens(held) if held else np.zeros(0, "int64"))
    return np.concatenate(out)


def token_count(text: Column) -> Column:
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(_counts(texts))
        trim()

    # A filter on the count would otherwise be pushed below it, and every text go to Python twice.
    return count.asNondeterministic()(text)


def _names(batch: pd.Series) -> list[str | None]:
    import xxhash

    return [xxhash.xxh3_128_hexdigest(" ".join(t.lower().split()).encode("utf-8", "surrogatepass")) if t is not None else None for t in batch]


def text_cluster(text: Column) -> Column:
    """The duplicate cluster of a text that no other stage has named: equal but for case and blanks."""

    @F.pandas_udf("string")
    def name(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(_names(texts), dtype=object)
        trim()

    return name(text)


def counted_and_named(text: Column) -> Column:
    """token_count and text_cluster in one step: two would hold two Python workers a core."""

    @F.pandas_udf("n long, cluster string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame({"n": _counts(texts), "cluster": pd.Series(_names(texts), dtype=object)})
        trim()

    return both.asNondeterministic()(text)


def pack(docs: DataFrame, cluster: Column | None = None, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, with_text: bool = False, classes: DataFrame | None = None, tokens: Column | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, first_token, n_tokens and its shard, bin, slot and begin in the bin.

    with_text adds the piece's text: the whole text of an uncut document, else the piece's tokens
    with single blanks.  A document's duplicate cluster is `cluster`, or that which classes (text_hash, cluster; one
    row for each text that shares its class, by xxhash64) names, or else all texts equal but for case and blanks.
    tokens counts a row's tokens in place of its words (not with with_text, which cuts words).
    """
    if with_text and tokens is not None:
        raise ValueError("pieces with texts are cut by words")
    bounded_batches(docs.sparkSession)
    if classes is not None:
        cluster = F.xxhash64("text")
    given = docs
    if cluster is None and tokens is None:
        held = column_name(docs, "held")
        given = docs.withColumn(held, counted_and_named(F.col("text")))
        n, cluster = F.col(held)["n"], F.col(held)["cluster"]
    else:
        cluster = text_cluster(F.col("text")) if cluster is None else cluster
        n = token_count(F.col("text")) if tokens is None else F.coalesce(tokens, F.lit(0))
    items = given.select(F.col("doc_id").cast("string").alias("doc_id"), n.cast("long").alias("n"), F.col("source").cast("string").alias("source"), cluster.cast("string").alias("cluster"), *["text"] * with_text).where("n > 0")
    if classes is not None:
        named = classes.select(F.col("text_hash").cast("string").alias("cluster"), F.col("cluster").cast("string").alias("class"))
        items = items.join(maybe_broadcast(named, 96), "cluster", "left").withColumn("cluster", F.coalesce(F.concat(F.lit("class "), "class"), "cluster")).drop("class")
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text")) if with_text else F.lit(0)).first()
    shards = max(1, -(-rows // shard_rows), -(-(size or 0) // SHARD_BYTES))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "n"), F.lit(shards)))
    packed = dealt.groupBy("shard").applyInPandas(lambda g: pack_shard(g, capacity, with_text), _schema(with_text))
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))
