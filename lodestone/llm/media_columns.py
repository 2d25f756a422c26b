"""Media columns: progressive JPEG files in binary columns.

`store` keeps each text's bytes as the coefficients of a progressive JPEG, `read_back` decodes
stored files to their payload and to facts of their full-resolution RGB tensor, and `tensors`
decodes any progressive JPEG column to RGB tensors.

Defined results: a null or empty text is stored as 64 zero bytes; equal texts give equal files;
repeated rows give repeated results; extra columns stay as they are.  `tensors` gives null for
null bytes and for bytes that are no progressive JPEG it can read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lodestone.llm.common import bounded_batches

FACTS = "payload binary, media_bytes long, media_sha256 string, feature string"
DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature(rgb) -> str:
    """Shape, and each channel's mean, deviation and extremes; a function of the pixels alone."""
    flat = rgb.reshape(-1, 3)
    counts = [np.bincount(flat[:, c], minlength=256) for c in range(3)]
    levels = np.arange(256)
    facts = []
    for k in counts:
        mean = (k @ levels) / len(flat)
        facts.append(f"{mean:.4f}/{((k @ levels**2) / len(flat) - mean * mean) ** 0.5:.4f}/{np.flatnonzero(k)[0]}-{np.flatnonzero(k)[-1]}")
    return f"{rgb.shape[0]}x{rgb.shape[1]}x3 " + " ".join(facts)


def store(text: Column) -> Column:
    """The text's padded UTF-8 bytes as a progressive JPEG."""

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        from lodestone.llm.progressive_jpeg import pad, write_payload

        return pd.Series([write_payload(pad((t or "").encode())) for t in texts])

    return encode(text)


def _read(media: bytes):
    from lodestone.llm.progressive_jpeg import Decoder

    d = Decoder(media)
    return d.payload(), len(media), hashlib.sha256(media).hexdigest(), feature(d.rgb())


def read_back(media: Column) -> Column:
    """Struct of the payload, the file's size and digest, and the tensor's feature."""

    @F.pandas_udf(FACTS)
    def decode(files: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_read(x) for x in files], columns=[c.split()[0] for c in FACTS.split(", ")])

    return decode(media)


def tensors(docs: DataFrame, media: str, into: str = "rgb") -> DataFrame:
    """docs with a struct column (height, width, pixels): row-major uint8 RGB."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("height int, width int, pixels binary")
    def decode(files: pd.Series) -> pd.DataFrame:
        from lodestone.llm.progressive_jpeg import Decoder

        rows = []
        for x in files:
            try:
                t = Decoder(x).rgb() if x is not None else None
            except (ValueError, KeyError, IndexError, struct.error):
                t = None  # no progressive JPEG, or a broken one
            rows.append((None, None, None) if t is None else (t.shape[0], t.shape[1], t.tobytes()))
        return pd.DataFrame(rows, columns=["height", "width", "pixels"]).astype({"height": "Int32", "width": "Int32"})

    found = docs.withColumn(into, decode(F.col(media)))
    return found.withColumn(into, F.when(F.col(f"{into}.pixels").isNotNull(), F.col(into)))


def round_trip(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the digests of what was stored and read back."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(DIGEST)
    def digest(texts: pd.Series, files: pd.Series) -> pd.DataFrame:
        rows = []
        for t, media in zip(texts, files):
            payload, size, sha, fact = _read(media)
            rows.append((len((t or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), size, sha, fact))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in DIGEST.split(", ")])

    return docs.select("doc_id", digest(F.col(text), store(F.col(text))).alias("d")).select("doc_id", "d.*")
