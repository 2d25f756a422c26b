"""BPE encoding and decoding through a distinct-word table.

Each scan task cuts its documents into words, block by block of bounded size.  A block becomes
its distinct words, numbered by falling frequency, and for each document the compressed numbers
of its words by position.  The words are dealt by hash into buckets; a word meets its like of all
blocks in one bucket, where it is encoded exactly once.  Its ids return to the blocks and are put
at each position of the word.  Decoding joins ids to the vocabulary's pieces.

Texts are never shuffled, only word numbers and, packed by block and bucket, distinct words.  The
table of words grows with the corpus, so it is only shuffled, never broadcast or collected; the
number of buckets grows with it.  A hot word counts once in each block, however often it occurs.

Defined results: a null text is the empty text, which has no ids and decodes to the empty text;
repeated rows give repeated results; an empty table gives an empty one; extra columns of the
input are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from lodestone.llm.common import block_count, bounded_batches, cut, trim

#: Code points of text in one block (a longer text is a block of its own).
BLOCK_CHARS = 14_000_000
#: Stored bytes of documents for each bucket of words.
BUCKET_BYTES = 4 << 20

#: Ids pass Python as text: pandas would turn a column with a null into floats.
ENCODED = "doc_id string, ids binary, decoded string"
DIGEST = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"

# The normalizer and pre_tokenizer of vocabularies whose usual texts Python's re splits alike.
USUAL_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
USUAL_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
USUAL_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
USUAL_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [USUAL_SPLIT, USUAL_BYTES]}

_LETTER = "a-zß-öø-ÿ"
#: Usual texts: of these characters.  They need no normalisation but lower case.
_UNUSUAL = re.compile(r"[^\t\n\x0b\x0c\r\x20-\x7eÀ-ÖØ-ßà-öø-ÿ]")
_USUAL_WORDS = re.compile(rf"[{_LETTER}]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\s{_LETTER}0-9]+")


class Splitter:
    """Cuts a text into the pieces whose ids do not depend on their neighbours.

    Usual texts are split by Python's re if the file's normalizer and pre_tokenizer are those that it
    stands for; all others by the library.  Files whose pieces could depend on each other are refused.
    """

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        v = json.loads(vocabulary)
        added, decoder = v.get("added_tokens", []), (v.get("decoder") or {}).get("type")
        if v["model"]["type"] != "BPE" or not v.get("pre_tokenizer") or v["model"].get("dropout"):
            raise ValueError("words are encoded one by one: only BPE with a pre_tokenizer and without dropout")
        if decoder not in (None, "ByteLevel") or any(x.get("normalized") or x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added):
            raise ValueError("a decoder or added token of this file looks beyond its word")
        self.usual = v.get("normalizer") == USUAL_NORMALIZER and v["pre_tokenizer"] == USUAL_PRE_TOKENIZER
        #: What stands between decoded pieces; None: the decoder joins bytes, word by word.
        self.joiner = " " if decoder is None else None
        special = sorted((x["content"] for x in added), key=len, reverse=True)
        self.has_special = re.compile("|".join(map(re.escape, special))) if special else None
        self.hint = os.path.commonprefix(special)

    @functools.cached_property
    def tok(self):
        """The library's tokenizer; only unusual texts need it to be split."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # its threads would each keep memory
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.vocabulary)

    def words(self, text: str) -> list[str]:
        if self.has_special is None or self.hint not in text or not self.has_special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.has_special.finditer(text):
            out += self._plain(text[at : m.start()]) + [m.group()]
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if self.usual and not _UNUSUAL.search(text):
            return _USUAL_WORDS.findall(text.lower())
        norm = self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text
        # The byte-level form of a piece would be normalised again; offsets give the piece itself.
        return [norm[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(norm)]


def _pieces(vocabulary: str) -> dict[int, str]:
    """Every id's piece."""
    v = json.loads(vocabulary)
    return {i: p for p, i in v["model"]["vocab"].items()} | {x["id"]: x["content"] for x in v.get("added_tokens", [])}


def _lines(words: list[str]) -> bytes:
    """Words as lines; those of other vocabularies may hold line ends."""
    return "\n".join([w.replace("\\", r"\\").replace("\n", r"\n") if "\n" in w or "\\" in w else w for w in words]).encode()


def _words(lines: bytes) -> list[str]:
    back = lambda w: re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], w) if "\\" in w else w
    return [back(w) for w in lines.decode().split("\n")]


def _pack(numbers: np.ndarray) -> bytes:
    """Word numbers as zstd of their byte planes: small numbers are frequent, so high planes are nearly empty."""
    return zstandard.compress(numbers.astype("<u4").view("u1").reshape(-1, 4).T.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), "u1").reshape(4, -1).T).view("<u4").ravel()


def _split(vocabulary: str, chars: int, buckets: int, want: str):
    """Rows of blocks: want is `words` (bucket, block, packed) or `docs` (block, doc_id, is_doc, packed).

    Both number a block's words alike.  The one row of `docs` with is_doc false has, for each word
    in order of bucket and then of first occurrence, its number.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, chunk, size, number, docs, part = Splitter(vocabulary), 0, 0, {}, [], 0

        def flush() -> pd.DataFrame:
            block = part << 20 | chunk
            words = list(number)
            bucket = np.array([zlib.crc32(w.encode()) % buckets for w in words], "int64")
            place = np.argsort(bucket, kind="stable")
            if want == "words":
                found, begin = np.unique(bucket[place], return_index=True)
                sides = zip(begin.tolist(), [*begin[1:].tolist(), len(words)])
                packed = [zstandard.compress(_lines([words[i] for i in place[a:b].tolist()]), 1) for a, b in sides]
                return pd.DataFrame({"bucket": found, "block": block, "packed": packed})
            flat = np.concatenate([np.frombuffer(x, "u4") for _, x in docs])
            order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            rank = np.empty(len(order), "u4")
            rank[order] = np.arange(len(order), dtype="u4")
            rows = [(block, doc, True, _pack(rank[np.frombuffer(x, "u4")])) for doc, x in docs]
            return pd.DataFrame([*rows, (block, None, False, _pack(rank[place]))], columns=["block", "doc_id", "is_doc", "packed"])

        for batch in batches:
            for part, doc, text in zip(batch["part"].tolist(), batch["doc_id"], batch["text"]):
                if size and size + len(text) > chars:
                    yield flush()
                    chunk, size, number, docs = chunk + 1, 0, {}, []
                    trim()
                docs.append((doc, array("I", [number.setdefault(w, len(number)) for w in cutter.words(text)])))
                size += len(text)
        if docs:
            yield flush()

    return run


def _encode(vocabulary: str):
    """One bucket: every distinct word is encoded once, and each block gets its words' ids."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tok = Splitter(vocabulary).tok
        lists = [_words(zstandard.decompress(x)) for x in rows["packed"]]
        codes, words = pd.factorize(np.array([w for ws in lists for w in ws], object))
        ids = [np.array(e.ids, "u4") for a in range(0, len(words), 4096) for e in tok.encode_batch(words[a : a + 4096].tolist(), add_special_tokens=False)]
        sizes, packed, at = np.array([len(x) for x in ids], "u4"), [], 0
        for ws in lists:
            own = codes[at : at + len(ws)]
            at += len(ws)
            packed.append((_pack(sizes[own]), _pack(np.concatenate([ids[c] for c in own.tolist()]))))
        del ids, words
        trim()
        return pd.DataFrame({"bucket": rows["bucket"], "block": rows["block"], "sizes": [a for a, _ in packed], "ids": [b for _, b in packed]})

    return run


def _assemble(vocabulary: str, whole: bool):
    def run(docs: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        pieces, cutter = _pieces(vocabulary), Splitter(vocabulary)
        joiner = cutter.joiner
        numbered = _unpack(docs.loc[~docs["is_doc"], "packed"].iloc[0]).tolist()
        ids_of, text_of, at = [b""] * len(numbered), [""] * len(numbered), 0
        for _, row in table.sort_values("bucket").iterrows():
            flat, end = _unpack(row["ids"]), 0
            for size in _unpack(row["sizes"]).tolist():
                own = flat[end : end + size]
                ids_of[numbered[at]] = own.tobytes()
                text_of[numbered[at]] = joiner.join([pieces[i] for i in own.tolist()]) if joiner else cutter.tok.decode(own.tolist(), skip_special_tokens=False)
                end += size
                at += 1
        rows = []
        for doc, is_doc, packed in zip(docs["doc_id"], docs["is_doc"], docs["packed"]):
            if not is_doc:
                continue
            numbers = _unpack(packed).tolist()
            ids = b"".join([ids_of[k] for k in numbers])
            decoded = (joiner or "").join([text_of[k] for k in numbers])
            if whole:
                rows.append((doc, ids, decoded))
            else:
                rows.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        del ids_of, text_of, pieces
        trim()
        return pd.DataFrame(rows, columns=[c.split()[0] for c in (ENCODED if whole else DIGEST).split(", ")])

    return run


def _is_scan(df: DataFrame) -> bool:
    """Whether df only reads files, filters and projects: then its partitions come out alike each time."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return all(re.match(r"[\s+:|-]*(Project|Filter|Relation)\b", line) for line in plan.splitlines() if line.strip())


def word_bpe(docs: DataFrame, vocabulary_path: str, whole: bool = True, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id with ids (little-endian unsigned 32-bit) and the decoded text, or their digests.

    vocabulary_path names a `tokenizers` JSON file; its text travels with the tasks, so that
    executors need no such file.  docs is read twice; if it is not a plain scan, it is written to
    the shared folder first, so that both readings cut it into the same blocks.
    """
    bounded_batches(docs.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = (texts if _is_scan(texts) else cut(texts, "texts")).select(F.spark_partition_id().alias("part"), "doc_id", "text")
    buckets = block_count(docs, BUCKET_BYTES)
    split = lambda want, schema: texts.mapInPandas(_split(vocabulary, block_chars, buckets, want), schema)
    words = split("words", "bucket long, block long, packed binary")
    packed = split("docs", "block long, doc_id string, is_doc boolean, packed binary")
    table = words.groupBy("bucket").applyInPandas(_encode(vocabulary), "bucket long, block long, sizes binary, ids binary")
    out = packed.groupBy("block").cogroup(table.groupBy("block")).applyInPandas(_assemble(vocabulary, whole), ENCODED if whole else DIGEST)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
