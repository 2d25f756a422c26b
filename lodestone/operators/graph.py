"""Knowledge graphs as node and edge tables: parsing, merging, components, resolution, rules, search."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lodestone.streaming.shared import checkpointed

# Delimiters of extraction answers.
RECORD, FIELD, DONE = "##", "<|>", "<|COMPLETE|>"
#: Pairs in one question of entity resolution.
PAIR_BATCH = 30


def records(answers: DataFrame, key: str, text: str) -> DataFrame:
    """(key, fields): each record of an answer, outer parentheses and quotes off.

    Each record's fields come out of a generator: from a projection, every condition on a field would split the record again.
    """
    parts = F.split(F.replace(F.col(text), F.lit(DONE), F.lit("")), RECORD)
    each = answers.select(key, F.explode(parts).alias("record")).where(F.trim("record") != "")
    bare = F.regexp_replace(F.trim("record"), r"^\(|\)$", "")
    return each.select(key, F.explode(F.array(F.split(bare, re.escape(FIELD)))).alias("fields"))


def _bare(c: Column) -> Column:
    return F.trim(F.replace(c, F.lit('"'), F.lit("")))


def nodes_of(rows: DataFrame, key: str) -> DataFrame:
    """Entity records: name, type in capitals, description and source."""
    kind = F.lower(_bare(F.get("fields", F.lit(0))))
    found = rows.where((kind == "entity") & (F.size("fields") >= 4))
    return found.select(F.upper(_bare(F.get("fields", F.lit(1)))).alias("name"), F.upper(_bare(F.get("fields", F.lit(2)))).alias("type"), _bare(F.get("fields", F.lit(3))).alias("description"), F.col(key).cast("string").alias("source_id")).where("name <> '' and name <> type")


def edges_of(rows: DataFrame, key: str) -> DataFrame:
    """Relationship records with the ends in order."""
    kind = F.lower(_bare(F.get("fields", F.lit(0))))
    found = rows.where((kind == "relationship") & (F.size("fields") >= 5))
    a, b = F.upper(_bare(F.get("fields", F.lit(1)))), F.upper(_bare(F.get("fields", F.lit(2))))
    return found.select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"), _bare(F.get("fields", F.lit(3))).alias("description"), F.col(key).cast("string").alias("source_id"))


def _union(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(c)), "\n")


def merge_nodes(nodes: DataFrame) -> DataFrame:
    """One node for each name: united descriptions and sources, the type of the last source that has one."""
    # Sources are ordered as numbers where they are numbers.
    order = F.struct(F.coalesce(F.col("source_id").try_cast("long"), F.lit(-1)), "source_id")
    last = F.max_by("type", F.when(F.col("type") != "", order))
    return nodes.groupBy("name").agg(last.alias("type"), _union("description").alias("description"), _union("source_id").alias("source_id"), F.lit(1).alias("weight"))


def merge_edges(edges: DataFrame) -> DataFrame:
    """One edge for each pair: its weight counts mentions."""
    return edges.groupBy("src", "dst").agg(F.count("*").alias("weight"), _union("description").alias("description"), _union("source_id").alias("source_id"))


def with_endpoints(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes and, with empty attributes, the ends of edges that no node record names."""
    ends = edges.select(F.col("src").alias("name")).union(edges.select("dst")).distinct().join(nodes, "name", "left_anti")
    return nodes.unionByName(ends.select("name", *(F.lit(None).cast(t).alias(c) for c, t in nodes.dtypes if c != "name")))


def degrees(edges: DataFrame) -> DataFrame:
    """rank of each node; a self-loop counts twice."""
    ends = edges.select(F.col("src").alias("name")).unionByName(edges.select(F.col("dst").alias("name")))
    return ends.groupBy("name").agg(F.count("*").alias("rank"))


def fold(first: DataFrame, second: DataFrame, key: list[str], keep_first: bool) -> DataFrame:
    """Two graphs' rows by key: shared weights become one side's plus 1, all else comes from the second.

    keep_first takes the first side's weight (edges), else the second's (nodes).
    """
    old = first.select(*key, F.col("weight").alias("__w"), F.col("description").alias("__d"))
    both = second.join(old, key, "full_outer")
    weight = F.when(F.col("__w").isNull(), F.col("weight")).when(F.col("weight").isNull(), F.col("__w")).otherwise((F.col("__w") if keep_first else F.col("weight")) + 1)
    known = F.lower("description").contains(F.lower(F.substring("__d", 1, 32)))
    text = F.when(F.col("__d").isNull() | known, F.col("description")).otherwise(F.concat_ws("\n", "description", "__d"))
    return both.select(*key, weight.alias("weight"), text.alias("description"))


def connected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): least reachable node, by label propagation with pointer jumping.

    Each round takes the least label of a node's neighbours and then that label's own label, so that
    long chains take few rounds.  Each round ends in a checkpoint; labels never leave the cluster.
    """
    both = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    both = checkpointed(both.union(both.select("b", "a")).distinct())
    labels = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("next"))
        up = step.select(F.col("node").alias("at"), F.col("next").alias("above"))
        jumped = step.join(up, F.col("next") == F.col("at"), "left").select("node", "label", F.least("next", F.coalesce("above", "next")).alias("next"))
        jumped = checkpointed(jumped)
        if jumped.where("label <> next").isEmpty():
            return jumped.select("node", F.col("next").alias("component"))
        labels = jumped.select("node", F.col("next").alias("label"))


def largest_component(edges: DataFrame) -> DataFrame:
    found = connected(edges)
    sizes = found.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component").limit(1)
    return found.join(sizes, "component", "left_semi").select("node")


def resolution_pairs(nodes: DataFrame, block: str, name: str) -> DataFrame:
    """Pairs of one block whose names differ in at most half of the shorter one's characters.

    The join is on the block and a coarse length: names that differ in length by more than half of
    the shorter one cannot be a pair.
    """
    # Lengths l <= m of a pair obey m - l <= l // 2, so m <= 1.5 * l: power-of-1.5 bands are at most one apart.
    band = F.floor(F.log(F.greatest(F.length("a"), F.lit(1)).cast("double")) / F.log(F.lit(1.5))).cast("int")
    rows = nodes.select(block, F.col(name).alias("a")).distinct().withColumn("band", band)
    near = rows.select(block, F.col("a").alias("b"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    most = F.floor(F.least(F.length("a"), F.length("b")) / 2).cast("int")
    pairs = rows.join(near, [block, "band"]).where("a < b")
    return pairs.where(F.levenshtein("a", "b") <= most).select(block, "a", "b")


def contract(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """Edges between group keepers: (node, component) renames ends, inner edges go, weights add up."""
    name = lambda side: groups.select(F.col("node").alias(side), F.col("component").alias(f"{side}_to"))
    moved = edges.join(name("src"), "src", "left").join(name("dst"), "dst", "left")
    a, b = F.coalesce("src_to", "src"), F.coalesce("dst_to", "dst")
    return moved.where(a != b).groupBy(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")).agg(F.sum("weight").alias("weight"))


def communities(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """(node, community) by synchronous label propagation: the heaviest label around, ties to the least.

    A distributed stand-in for hierarchical clustering, whose ids depend on its implementation.
    """
    both = edges.select("src", "dst", "weight").union(edges.select("dst", "src", "weight")).toDF("a", "b", "weight")
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("community", F.col("node"))
    for _ in range(rounds):
        votes = both.join(labels, F.col("b") == F.col("node")).groupBy("a", "community").agg(F.sum("weight").alias("w"))
        # The own label votes too, which stops two-colour flicker.
        own = labels.select(F.col("node").alias("a"), "community", F.lit(1).cast("long").alias("w"))
        best = votes.unionByName(own).groupBy("a", "community").agg(F.sum("w").alias("w")).withColumn("r", F.row_number().over(W.partitionBy("a").orderBy(F.desc("w"), "community")))
        labels = checkpointed(best.where("r = 1").select(F.col("a").alias("node"), "community"))
    return labels


def community_weights(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Summed rank * weight of each community over the largest such sum."""
    sums = members.join(nodes, members["node"] == nodes["name"]).groupBy("community").agg(F.sum(F.col("rank") * F.col("weight")).alias("w"))
    top = sums.agg(F.max("w").alias("top"))
    return sums.crossJoin(F.broadcast(top)).select("community", (F.col("w") / F.col("top")).alias("weight"))  # top is one row


def normal_name(name: Column) -> Column:
    """Blanks around brackets go; `CJK(LATIN)` becomes `LATIN(CJK)`."""
    tight = F.regexp_replace(F.regexp_replace(name, r"\s*[(（]\s*", "("), r"\s*[)）]\s*", ")")
    return F.regexp_replace(tight, r"^([一-龥]+)\(([A-Za-z0-9 _-]+)\)$", "$2($1)")


def canonical_types(nodes: DataFrame, synonyms: list[list[str]]) -> DataFrame:
    """A type becomes the first of its row of synonyms."""
    pairs = [(s, row[0]) for row in synonyms for s in row]
    table = F.create_map(*(F.lit(x) for p in pairs for x in p)) if pairs else F.create_map().cast("map<string,string>")
    return nodes.withColumn("type", F.coalesce(F.element_at(table, F.col("type")) if pairs else F.lit(None), F.col("type")))


def clean_nodes(nodes: DataFrame, blacklist: list[str]) -> DataFrame:
    """Label and type fill each other in; blacklisted names and nodes without type, source or description go."""
    filled = nodes.withColumn("type", F.coalesce("type", "label")).withColumn("label", F.coalesce("label", "type"))
    return filled.where(~F.col("name").isin(*blacklist)).where("type is not null and source_id is not null and description is not null")


def claims(answers: DataFrame, key: str, text: str) -> DataFrame:
    """Eight-field claims; without subject or object they go."""
    names = ("subject_id", "object_id", "type", "status", "start_date", "end_date", "description", "source_text")
    rows = records(answers, key, text).where(F.size("fields") >= 2)
    out = rows.select(key, *(F.trim(F.get("fields", F.lit(i))).alias(n) for i, n in enumerate(names)))
    known = lambda c: F.col(c).isNotNull() & ~F.lower(c).isin("", "none")
    return out.where(known("subject_id") & known("object_id"))


def yes_pairs(answer: Column) -> Column:
    """Numbers of the questions that an answer affirms: ...<|>n<|>...&&yes&&... in each record."""
    parts = F.filter(F.split(answer, RECORD), lambda r: F.lower(F.regexp_extract(r, r"&&([^&]*)&&", 1)).isin("yes"))
    return F.filter(F.transform(parts, lambda r: F.regexp_extract(r, r"<\|>(\d+)<\|>", 1).try_cast("int")), lambda n: n.isNotNull() & (n <= PAIR_BATCH))


# ---------------------------------------------------------------- rules
_TOKEN = re.compile(r"\s*(\(|\)|=~|=|~|,|'[^']*'|\"[^\"]*\"|[^\s()=~,'\"]+)")


class Rule:
    """or > and > not over tests `type[.attribute] = v, v`, `~ v` (contains) or `=~ v` (pattern)."""

    def __init__(self, text: str):
        self.tokens, self.at = _TOKEN.findall(text), 0
        self.tests: list[Column] = []
        self.tree = self._any()
        if self.at != len(self.tokens):
            raise ValueError(f"rule not understood at {self.tokens[self.at]}")

    def _next(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def _take(self) -> str:
        if self.at >= len(self.tokens):
            raise ValueError("the rule ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def _any(self):
        parts = [self._all()]
        while self._next().lower() == "or":
            self._take()
            parts.append(self._all())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def _all(self):
        parts = [self._not()]
        while self._next().lower() == "and":
            self._take()
            parts.append(self._not())
        return parts[0] if len(parts) == 1 else ("and", parts)

    def _not(self):
        if self._next().lower() == "not":
            self._take()
            return ("not", [self._not()])
        if self._next() == "(":
            self._take()
            inner = self._any()
            if self._take() != ")":
                raise ValueError("missing )")
            return inner
        return self._test()

    def _test(self):
        kind, _, attribute = self._take().partition(".")
        test = F.col("type") == kind
        if self._next() in ("=", "~", "=~"):
            op, values = self._take(), [self._take().strip("'\"")]
            while self._next() == ",":
                self._take()
                values.append(self._take().strip("'\""))
            c = F.element_at(F.col("attributes"), attribute or "name")
            one = {"=": lambda v: c == v, "~": lambda v: c.contains(v), "=~": lambda v: c.rlike(v)}[op]
            hit = one(values[0])
            for v in values[1:]:
                hit = hit | one(v)
            test = test & hit
        self.tests.append(test)
        return len(self.tests) - 1

    def result(self) -> Column:
        """One aggregate over the nodes of a group: every test holds if any node meets it."""
        found = [F.coalesce(F.bool_or(t), F.lit(False)) for t in self.tests]

        def walk(x) -> Column:
            if isinstance(x, int):
                return found[x]
            op, parts = x
            out = walk(parts[0])
            if op == "not":
                return ~out
            for p in parts[1:]:
                out = (out | walk(p)) if op == "or" else (out & walk(p))
            return out

        return walk(self.tree)


def evaluate_rules(nodes: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """(key, one boolean for each rule) in one pass over nodes (key, type, attributes map)."""
    return nodes.groupBy(key).agg(*(Rule(text).result().alias(name) for name, text in rules.items()))


def search(entities: DataFrame, reports: DataFrame, texts: DataFrame, score: str, sizes: tuple[int, int, int] = (32, 32, 6)) -> DataFrame:
    """Best entities, then reports that name one of them, then texts: (bucket, rank, id)."""
    top = entities.orderBy(F.desc(score), "id").limit(sizes[0])
    about = reports.join(top.select(F.col("name").alias("entity")), "entity", "left_semi").groupBy("id").agg(F.max(score).alias(score))
    buckets = [top.select("id", score), about.orderBy(F.desc(score), "id").limit(sizes[1]), texts.select("id", score).orderBy(F.desc(score), "id").limit(sizes[2])]
    out = None
    for b, name in zip(buckets, ("entity", "community", "text")):
        ranked = b.select(F.lit(name).alias("bucket"), F.row_number().over(W.orderBy(F.desc(score), "id")).alias("rank"), F.col("id").cast("string").alias("id"))  # a bucket has few rows
        out = ranked if out is None else out.unionByName(ranked)
    return out
