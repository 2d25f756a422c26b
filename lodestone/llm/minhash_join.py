"""Near-duplicate documents by an inverted join over MinHash coordinates.

1. Each text becomes its set of word shingles; equal sets are one node from here on.
2. A node is posted under each of its COORDINATES (coordinate, value) pairs.  Pairs that only one
   node has are dropped.  A node with fewer than MATCHES pairs left can match none.
3. Prefix: two nodes that collide MATCHES times share one of their rarest m - MATCHES + 1 pairs
   (m: the pairs a node has left).  The frequent rest is skipped when partners are sought.
4. Merging: in each posting list of the prefix the node with the most frequent pairs is the anchor.
   Collisions of every other node with its anchors are counted over whole signatures; pairs of MATCHES and
   more are confirmed on their full sets: 100 * |A & B| >= 100 * similarity * |A | B|.
5. What the anchors leave: the nodes that met one anchor, in whichever lists, are a group; two nodes of one list are
   in the group of its anchor.  A group of several classes is merged in tasks of at most 2 * BLOCK nodes: there
   collisions of all pairs of different classes are counted, and those of MATCHES and more confirmed.  Nodes of the anchor's
   class come only if one outside it can still match them (collisions are a metric: 64 less them obeys the
   triangle inequality), and are not compared with each other; larger groups meet block by block.
6. Components of the links give each document's class.

A list gives as many pairs as it has nodes, never the pairs within it.  Two sets of similarity 0.8
collide in fewer than MATCHES = 40 of 64 coordinates with probability 3.5e-4; that is the only way to lose a link.

Defined results: a null text is empty; a document without words has the empty set and is linked
with nothing; one with fewer words than a shingle has its whole sequence as its one shingle.
Rows of one doc_id are documents of their own that share the id.  A class's id is its least
non-null doc_id (null if it has none).  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lodestone.llm.common import bounded_batches, cut, maybe_broadcast, trim
from lodestone.llm.components import components
from lodestone.llm.shingles import shingle_sets

COORDINATES, MATCHES, BLOCK = 64, 40, 256
_ODD = np.random.default_rng(20_240_817).integers(0, 1 << 31, COORDINATES, "u4") * np.uint32(2) + np.uint32(1)
_XOR = np.random.default_rng(20_240_818).integers(0, 1 << 32, COORDINATES, "u4")


def signature(shingles: np.ndarray) -> np.ndarray:
    """The posting keys: the shingle that each coordinate's permutation puts first, its low 6 bits replaced by the coordinate."""
    least, chosen = np.full(COORDINATES, 0xFFFFFFFF, "u4"), np.repeat(shingles[:1], COORDINATES)
    rows = np.arange(COORDINATES)
    for a in range(0, len(shingles), 4096):
        part = shingles[a : a + 4096]
        order = (part >> np.uint64(32)).astype("u4")[None] * _ODD[:, None]
        order ^= _XOR[:, None]
        at = order.argmin(1)
        value = order[rows, at]
        chosen, least = np.where(value < least, part[at], chosen), np.minimum(value, least)
    return ((chosen & ~np.uint64(63)) | rows.astype("u8")).view("i8")


def _node(shingles: np.ndarray, salt: int) -> tuple[int, int]:
    """128 bits of the set: its node, and what tells apart sets that share one."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16, salt=salt.to_bytes(8, "little")).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _signatures(words: int, salt: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, checks, sizes, keys = [], [], [], []
            for s in shingle_sets(batch["text"], words):
                node, check = _node(s, salt) if len(s) else (None, None)
                nodes.append(node)
                checks.append(check)
                sizes.append(len(s))
                keys.append(signature(s) if len(s) else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "n_shingles": sizes, "node": pd.array(nodes, "Int64"), "check": pd.array(checks, "Int64"), "keys": keys})
        trim()

    return run


def _sets(words: int, salt: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = list(shingle_sets(batch["text"], words))
            yield pd.DataFrame({"node": [_node(s, salt)[0] for s in sets], "shingles": [s.tobytes() for s in sets]})
        trim()

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes: rare members by listing their few pairs, frequent ones by products."""
    n = len(sets)
    counts = np.zeros(n * n, "int32")
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, "u8")
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, int)
    df = np.diff(np.r_[starts, len(flat)])
    for d in range(2, 17):
        own = owner[starts[df == d][:, None] + np.arange(d)]
        for a in range(d):
            for b in range(a + 1, d):
                counts += np.bincount(own[:, a] * n + own[:, b], minlength=n * n).astype("int32") if len(own) else 0
    counts = counts.reshape(n, n)
    counts += counts.T
    often = np.flatnonzero(df > 16)
    for a in range(0, len(often), 2048):
        part = often[a : a + 2048]
        x = np.zeros((n, len(part)), "float32")
        for j, k in enumerate(part):
            x[owner[starts[k] : starts[k] + df[k]], j] = 1
        counts += (x @ x.T).astype("int32")
    return counts


def _is_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


LINKS = "u long, v long"


def _anchored(percent: int):
    """Confirms the pairs (node, anchor) of a task; the anchors' own sets come as rows that name themselves."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = {node: np.frombuffer(x, "u8") for node, x in zip(group["node"].tolist(), group["shingles"])}
        out = [(u, v) for u, v in zip(group["node"].tolist(), group["anchor"].tolist()) if u != v and _is_link(sets[u], sets[v], percent)]
        del sets
        trim()
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return run


def _merged(percent: int):
    """Counts the collisions in each list of a task and confirms pairs of different classes on full sets."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        root: dict[int, int] = {}

        def find(k: int) -> int:
            while root.setdefault(k, k) != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        out = []
        for _, rows in group.groupby("list"):
            nodes, classes = rows["node"].tolist(), rows["class"].tolist()
            hits = overlaps([np.asarray(k, "i8") for k in rows["keys"]])
            sets = [np.frombuffer(x, "u8") for x in rows["shingles"]]
            size = np.array([len(s) for s in sets])
            # Sizes too different for the threshold are no candidates.
            near = 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])
            i, j = np.nonzero(np.triu((hits >= MATCHES) & near, 1))
            for k in np.argsort(-hits[i, j], kind="stable").tolist():
                a, b = int(i[k]), int(j[k])
                x, y = find(classes[a]), find(classes[b])
                if x != y and _is_link(sets[a], sets[b], percent):
                    root[max(x, y)] = min(x, y)
                    out.append((nodes[a], nodes[b]))
        trim()
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return run


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def _marked(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame, int]:
    """Each row's node, and each node's keys, first id and one place; nodes are 64 bits that 64 others confirm."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    schema = "doc_id string, text_hash long, n_shingles long, node long, check long, keys array<long>"
    for salt in range(8):
        marked = cut(texts.mapInPandas(_signatures(words, salt), schema).withColumn("doc_id", F.col("doc_id").cast("long")), "signatures")
        same = marked.where("node is not null").groupBy("node")
        place = F.min(F.struct(_key(F.col("doc_id")).alias("doc_key"), "text_hash")).alias("place")
        nodes = cut(same.agg(F.min("doc_id").alias("first_id"), place, F.min("check").alias("low"), F.max("check").alias("high"), F.first("keys").alias("keys")), "nodes")
        if nodes.where("low <> high").isEmpty():
            return marked, nodes, salt
    raise ValueError("sets could not be told apart by eight hashes")


def _lists(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, keys, weight) of nodes that can match, and the posting lists (key, node, weight) of their prefixes."""
    posted = nodes.select("node", F.explode("keys").alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("freq")).where("freq > 1")
    left = posted.join(shared, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("freq", "key"))).alias("ks")).where(F.size("ks") >= MATCHES)
    weight = F.aggregate("ks", F.lit(0).cast("long"), lambda n, k: n + k["freq"])
    left = cut(left.select("node", F.col("ks.key").alias("keys"), weight.alias("weight")), "left")
    prefix = left.select(F.explode(F.expr(f"slice(keys, 1, size(keys) - {MATCHES - 1})")).alias("key"), "node", "weight")
    return left.select("node", "keys"), prefix


def _met(prefix: DataFrame, sigs: DataFrame) -> DataFrame:
    """(node, anchor, part, hits): every node of a list with the list's anchor, and their collisions; a part has about BLOCK nodes."""
    anchors = maybe_broadcast(cut(prefix.groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("anchor"), F.count("*").alias("n")).where("n > 1").select("key", "anchor"), "anchors"), 16)
    pairs = cut(prefix.join(anchors, "key").where("node <> anchor").select("node", "anchor").distinct(), "pairs")
    large = pairs.groupBy("anchor").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    dealt = cut(pairs.join(maybe_broadcast(cut(large, "large"), 16), "anchor", "left").select("node", "anchor", part), "dealt")
    heads = dealt.select("anchor", "part").distinct().join(sigs.select(F.col("node").alias("anchor"), F.col("keys").alias("head")), "anchor")
    return cut(dealt.join(heads, ["anchor", "part"]).join(sigs, "node").select("node", "anchor", "part", F.size(F.array_intersect("keys", "head")).alias("hits")), "met")


def _anchor_links(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The confirmed links among the pairs (node, anchor) above the threshold."""
    retained = met.where(F.col("hits") >= MATCHES)
    task = F.pmod(F.xxhash64("anchor", "part"), F.lit(max(1, -(-retained.count() // BLOCK)))).alias("task")
    own = retained.select("node", "anchor", task).unionByName(retained.select(F.col("anchor").alias("node"), "anchor", task).distinct())
    return cut(own.join(sets, "node").groupBy("task").applyInPandas(_anchored(percent), LINKS), "links")


def _rest(met: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups that hold several classes: (anchor, node, inside, class), and how many nodes each has inside and outside its anchor's class."""
    of = classes.select("node", F.col("component").alias("class"))
    named = met.select("anchor", "node", "hits").join(of, "node", "left")
    named = named.join(of.select(F.col("node").alias("anchor"), F.col("class").alias("own")), "anchor", "left")
    named = cut(named.select("anchor", "node", "hits", F.coalesce("class", "node").alias("class"), F.coalesce("own", "anchor").alias("own")), "groups")
    outside = F.col("class") != F.col("own")
    most = named.where(outside).groupBy("anchor").agg(F.max("hits").alias("most"), F.min("class").alias("low"), F.max("class").alias("high"))
    most = maybe_broadcast(cut(most, "most"), 40)
    # distance(node, outsider) >= distance(outsider, anchor) - distance(node, anchor), distances being 64 less the collisions.
    near = outside | (F.col("most") + COORDINATES - F.col("hits") >= MATCHES)
    kept = cut(named.join(most, "anchor").where(near).select("anchor", "node", (~outside).alias("inside"), "class", (F.col("low") != F.col("high")).alias("mixed")), "kept")
    sizes = kept.groupBy("anchor").agg(F.sum(F.col("inside").cast("int")).alias("n_in"), F.sum((~F.col("inside")).cast("int")).alias("n_out"), F.first("mixed").alias("mixed"))
    return kept.drop("mixed"), cut(sizes.where("mixed or n_in > 0").drop("mixed"), "sizes")


def _rest_links(kept: DataFrame, sizes: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between different classes of a group; each class's nodes are joined as they are already."""
    whole = F.col("n_in") + F.col("n_out") <= 2 * BLOCK
    tasks = max(1, -(-int(sizes.where(whole).agg(F.sum(F.col("n_in") + F.col("n_out"))).first()[0] or 0) // BLOCK))
    ins, outs = F.ceil(F.col("n_in") / BLOCK).cast("int"), F.ceil(F.col("n_out") / BLOCK).cast("int")
    dealt = kept.join(maybe_broadcast(sizes, 32), "anchor").withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("inside"), ins).otherwise(outs)).cast("int"))
    number = lambda xs, f: F.transform(F.sequence(F.lit(1), xs), f)
    # Block i of the outsiders meets those from 1 on and the insiders' blocks, as -1, -2 and so on.
    own = F.col("block") + 1
    out = F.concat(number(outs, lambda x: F.xxhash64("anchor", F.least(x, own), F.greatest(x, own))), F.when(F.col("n_in") > 0, number(ins, lambda x: F.xxhash64("anchor", -x, own))).otherwise(F.array().cast("array<bigint>")))
    lists = F.when(whole, F.array(F.xxhash64("anchor"))).when(F.col("inside"), number(outs, lambda x: F.xxhash64("anchor", -own, x))).otherwise(out)
    rows = dealt.select("node", "class", whole.alias("whole"), F.explode(lists).alias("list"))
    rows = rows.select("node", "class", "list", F.when(F.col("whole"), F.pmod("list", F.lit(tasks))).otherwise(F.col("list")).alias("task"))
    return cut(rows.join(sigs, "node").join(sets, "node").groupBy("task").applyInPandas(_merged(percent), LINKS), "links")


def _linked(docs: DataFrame, words: int, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, text_hash, n_shingles, node) of each row, the nodes, and (node, component) of the linked ones."""
    if similarity < 0.8:
        raise ValueError("MATCHES is set for similarities of 0.8 or more")
    percent = round(100 * similarity)
    bounded_batches(docs.sparkSession)
    marked, nodes, salt = _marked(docs, words)
    sigs, prefix = _lists(nodes)
    met = _met(prefix, sigs)
    places = nodes.join(met.select("node").unionByName(met.select(F.col("anchor").alias("node"))).distinct(), "node", "left_semi").select("place.*")
    places = maybe_broadcast(cut(places, "places"), 48)
    texts = docs.select(_key(F.col("doc_id")).alias("doc_key"), F.xxhash64("text").alias("text_hash"), "text").join(places, ["doc_key", "text_hash"], "left_semi")
    sets = cut(texts.select("text").mapInPandas(_sets(words, salt), "node long, shingles binary").dropDuplicates(["node"]), "sets")
    links = _anchor_links(met, sets, percent)
    classes = cut(components(links), "classes")
    kept, sizes = _rest(met, classes)
    if not sizes.isEmpty():
        more = _rest_links(kept, sizes, sigs, sets, percent)
        if not more.isEmpty():
            classes = cut(components(links.unionByName(more)), "classes")
    return marked, nodes, classes


def _named(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component_id): the least first_id of each node's class."""
    own = nodes.select("node", "first_id").join(classes, "node", "left")
    own = cut(own, "own")
    least = own.where("component is not null").groupBy("component").agg(F.min("first_id").alias("least_id"))
    least = maybe_broadcast(cut(least, "least"), 16)
    linked = own.where("component is not null").join(least, "component").select("node", F.col("least_id").alias("component_id"))
    return cut(linked.unionByName(own.where("component is null").select("node", F.col("first_id").alias("component_id"))), "named")


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the row's id is its class's) and text_hash, which names the row's text."""
    marked, nodes, classes = _linked(docs, words, similarity)
    out = marked.select("doc_id", "n_shingles", "node", "text_hash").join(_named(nodes, classes), "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept"), "text_hash")


def text_classes(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """text_hash, cluster: the class of each different text that shares it with another one."""
    marked, nodes, classes = _linked(docs, words, similarity)
    texts = marked.where("node is not null").select("text_hash", "node").dropDuplicates(["text_hash"])
    alike = texts.groupBy("node").count().where("count > 1").select("node")
    wanted = alike.unionByName(classes.select("node")).distinct()
    return texts.join(wanted, "node", "left_semi").join(classes, "node", "left").select("text_hash", F.coalesce("component", "node").alias("cluster"))


def surplus(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """What goes if one row of each class stays: texts by (doc_id, text_hash), and those that stay but are repeated.

    The row that stays has the class's least doc_id (a null id comes last), and of rows that share it the
    least text_hash.  Rows without words are in neither table.
    """
    marked, nodes, classes = _linked(docs, words, similarity)
    rows = marked.where("node is not null").groupBy("node", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    rows = cut(rows.join(classes, "node", "left").select(F.coalesce("component", "node").alias("class"), F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash").alias("at"), "rows"), "rows")
    stays = cut(rows.groupBy("class").agg(F.min("at").alias("at")).select("at"), "stays")
    gone = rows.join(stays, "at", "left_anti").select("at.doc_id", "at.text_hash")
    again = rows.where("rows > 1").join(stays, "at", "left_semi").select("at.doc_id", "at.text_hash")
    return cut(gone, "gone"), cut(again, "again")
