"""Datasets, documents and chunks under the names that callers know.

Tables are DataFrames; every call returns new ones, and `save` of the caller decides where they go.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from lodestone.functions import text as T
from lodestone.operators import chunking as C, dml, relational as R, retrieval

VALID, WASTED = "1", "0"


@dataclass(frozen=True)
class Catalog:
    """datasets (id, name, status), documents (id, dataset_id, name, text, status) and chunks (id, document_id, content, available_int)."""

    datasets: DataFrame
    documents: DataFrame
    chunks: DataFrame

    # datasets
    def create_dataset(self, id: str, name: str) -> Catalog:
        taken = {r[0] for r in self.datasets.where(F.col("status") == VALID).where(F.lower("name").startswith(name.lower())).select(F.lower("name")).collect()}
        number, unique = 0, name
        while unique.lower() in taken:
            number += 1
            unique = f"{name}({number})"
        row = self.datasets.sparkSession.createDataFrame([(id, unique, VALID)], "id string, name string, status string")
        return replace(self, datasets=self.datasets.unionByName(row, allowMissingColumns=True))

    def list_datasets(self, offset: int = 0, count: int = -1) -> DataFrame:
        if offset < 0:
            raise ValueError("offset below 0")
        rows = self.datasets.where(F.col("status") == VALID).orderBy("name", "id").offset(offset)
        return rows if count < 0 else rows.limit(count)

    def delete_dataset(self, id: str) -> Catalog:
        gone = self.documents.where(F.col("dataset_id") == id).select(F.col("id").alias("document_id"))
        return replace(
            self,
            datasets=dml.update_where(self.datasets, F.col("id") == id, status=F.lit(WASTED)),
            documents=dml.delete_where(self.documents, F.col("dataset_id") == id),
            chunks=self.chunks.join(gone, "document_id", "left_anti"),
        )

    # documents
    def list_documents(self, dataset_id: str, keywords: str = "", page: int = 1, size: int = 30) -> tuple[int, DataFrame]:
        rows = R.dynamic_filter(self.documents, dataset_id=dataset_id)
        if keywords:
            rows = rows.where(F.lower("name").contains(keywords.lower()))
        return rows.count(), R.page(rows, page, size, F.col("name"), F.col("id"))

    def change_status(self, document_id: str, status: str) -> Catalog:
        """Chunks of a switched-off document are not available."""
        mine = F.col("document_id") == document_id
        return replace(self, documents=dml.update_where(self.documents, F.col("id") == document_id, status=F.lit(status)), chunks=dml.update_where(self.chunks, mine, available_int=F.lit(int(status))))

    def run(self, document_ids: list[str], limit: int = C.CHUNK_TOKENS) -> Catalog:
        """(Re)chunks documents: their old chunks go, equal content of one document collapses."""
        mine = self.documents.where(F.col("id").isin(*document_ids))
        pieces = mine.select(F.col("id").alias("document_id"), F.explode(C.plain_chunks(F.col("text"), limit)).alias("content"))
        new = pieces.select(T.chunk_id(F.col("content"), F.col("document_id")).alias("id"), "document_id", "content", F.lit(1).alias("available_int")).dropDuplicates(["id"])
        kept = dml.delete_where(self.chunks, F.col("document_id").isin(*document_ids))
        return replace(self, chunks=kept.unionByName(new, allowMissingColumns=True))

    def delete_document(self, id: str) -> Catalog:
        return replace(self, documents=dml.delete_where(self.documents, F.col("id") == id), chunks=dml.delete_where(self.chunks, F.col("document_id") == id))

    # chunks
    def list_chunks(self, document_id: str, most: int = 1024) -> DataFrame:
        return self.chunks.where(F.col("document_id") == document_id).orderBy("id").limit(most)

    def switch_chunks(self, ids: list[str], available: int) -> Catalog:
        return replace(self, chunks=dml.update_where(self.chunks, F.col("id").isin(*ids), available_int=F.lit(available)))

    def set_chunk(self, id: str, content: str) -> Catalog:
        return replace(self, chunks=dml.update_where(self.chunks, F.col("id") == id, content=F.lit(content)))

    def retrieval_test(self, question: str, dataset_ids: list[str], top_n: int = 30, least: float = 0.2) -> DataFrame:
        docs = self.documents.where(F.col("dataset_id").isin(*dataset_ids) & (F.col("status") == VALID)).select(F.col("id").alias("document_id"), "name")
        rows = self.chunks.where(R.available(F.col("available_int"))).join(docs, "document_id")
        scored = rows.withColumn("similarity", retrieval.token_similarity(question, retrieval.tokens(F.col("content"))))
        return scored.where(F.col("similarity") >= least).orderBy(F.desc("similarity"), "id").limit(top_n)


def tree_of(markdown: str) -> dict:
    """A mind map of headings and bullets: {"id", "children"}, each name once, emphasis marks off."""
    root: dict = {"id": "root", "children": []}
    stack, seen = [(0, root)], set()
    for line in re.sub(r"```[^\n]*", "", markdown).splitlines():
        m = re.match(r"^(#+)\s+(.*)$|^(\s*)[-*+]\s+(.*)$", line)
        if not m:
            continue
        depth = len(m[1]) if m[1] else 100 + len(m[3]) // 2
        name = re.sub(r"\*+", "", m[2] or m[4] or "").strip()
        if not name or name in seen:
            continue
        seen.add(name)
        while stack[-1][0] >= depth:
            stack.pop()
        node = {"id": name, "children": []}
        stack[-1][1]["children"].append(node)
        stack.append((depth, node))
    return root["children"][0] if len(root["children"]) == 1 else root


def merge_trees(a: dict, b: dict) -> dict:
    """Children of one name merge; the first tree's come first."""
    mine = {c["id"]: c for c in a["children"]}
    children = [merge_trees(c, next(x for x in b["children"] if x["id"] == c["id"])) if any(x["id"] == c["id"] for x in b["children"]) else c for c in a["children"]]
    return {"id": a["id"], "children": children + [c for c in b["children"] if c["id"] not in mine]}
