"""Messages within a budget, and trees of summaries."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

_TOKENS = re.compile(r"\s*(?:[A-Za-z0-9]+|[^\sA-Za-z0-9])")


def count_tokens(text: str) -> int:
    return len(_TOKENS.findall(text))


def _cut(text: str, most: int) -> str:
    return "".join(_TOKENS.findall(text)[: max(0, most)])


def fit_messages(messages: list[dict], budget: int = 4000) -> tuple[int, list[dict]]:
    """All messages; else the system's and the last; else the longer of those two cut to the budget."""
    total = lambda ms: sum(count_tokens(m["content"]) for m in ms)
    if total(messages) < budget:
        return total(messages), messages
    kept = [dict(m) for m in messages[:-1] if m["role"] == "system"] + [dict(messages[-1])]
    if total(kept) < budget:
        return total(kept), kept
    first, last = count_tokens(kept[0]["content"]), count_tokens(kept[-1]["content"])
    if first / (first + last) > 0.8:
        kept[0]["content"] = _cut(kept[0]["content"], budget - last)
    else:
        kept[-1]["content"] = _cut(kept[-1]["content"], budget - (first if len(kept) > 1 else 0))
    return budget, kept


def extract(texts: list[str], most: int = 64) -> str:
    """A summary without a model: each text's first sentence, cut to its share of the budget."""
    share = max(1, most // max(1, len(texts)))
    return "\n".join(_cut(re.split(r"(?<=[.!?。！？])\s", t.strip())[0], share) for t in texts)


def gaussian_mixture(x: np.ndarray, most: int, seed: int = 224) -> np.ndarray:
    """Labels of spherical Gaussian mixtures, their number chosen by BIC."""
    n, d = x.shape
    best = (np.inf, np.zeros(n, int))
    for k in range(1, min(most, n - 1) + 1):
        rng = np.random.default_rng(seed)
        mean, var, share = x[rng.choice(n, k, replace=False)].copy(), np.full(k, x.var() + 1e-6), np.full(k, 1 / k)
        for _ in range(30):
            gap = ((x[:, None] - mean[None]) ** 2).sum(2)
            log = np.log(share) - 0.5 * d * np.log(2 * np.pi * var) - 0.5 * gap / var
            top = log.max(1, keepdims=True)
            p = np.exp(log - top)
            like = (top[:, 0] + np.log(p.sum(1))).sum()
            p /= p.sum(1, keepdims=True)
            own = p.sum(0) + 1e-9
            mean, share = p.T @ x / own[:, None], own / own.sum()
            var = (p * ((x[:, None] - mean[None]) ** 2).sum(2)).sum(0) / (d * own) + 1e-6
        bic = (k * (d + 2) - 1) * np.log(n) - 2 * like
        if bic < best[0]:
            # The first component above a tenth takes the row.
            best = (bic, np.array([np.flatnonzero(r > 0.1)[0] if (r > 0.1).any() else r.argmax() for r in p]))
    return best[1]


def summary_tree(chunks: DataFrame, key: str, text: str = "content", vector: str = "vector", summarise: Callable[[list[str]], str] = extract, most_clusters: int = 16, dims: int = 12) -> DataFrame:
    """(key, layer, node, content, n_children): each document's chunks clustered and summarised, layer on layer, to one root.

    One group is one document.  Vectors are reduced by principal components; a summary's vector is
    its children's mean, where no embedding model is at hand.
    """

    def build(group: pd.DataFrame) -> pd.DataFrame:
        k = group[key].iloc[0]
        texts, x = group[text].tolist(), np.stack([np.asarray(v, float) for v in group[vector]])
        rows, layer, seen = [], 0, 0
        while len(texts) > 1:
            if len(texts) == 2:
                labels = np.zeros(2, int)
            else:
                centred = x - x.mean(0)
                _, _, axes = np.linalg.svd(centred, full_matrices=False)
                labels = gaussian_mixture(centred @ axes[: min(dims, len(texts) - 2)].T, most_clusters)
                if len(set(labels.tolist())) >= len(texts):
                    labels = np.zeros(len(texts), int)
            layer += 1
            parts = [np.flatnonzero(labels == c) for c in np.unique(labels)]
            new = [summarise([texts[i] for i in p]) for p in parts]
            rows += [(k, layer, seen + i, t, len(p)) for i, (t, p) in enumerate(zip(new, parts))]
            seen += len(new)
            texts, x = new, np.stack([x[p].mean(0) for p in parts])
        return pd.DataFrame(rows, columns=[key, "layer", "node", "content", "n_children"])

    kind = dict(chunks.dtypes)[key]
    return chunks.select(key, text, F.col(vector)).groupBy(key).applyInPandas(build, f"{key} {kind}, layer int, node int, content string, n_children int")
