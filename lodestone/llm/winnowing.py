"""Winnowing fingerprints, in DataFrame functions only.

Every K neighbouring code points of a text, at every offset and whatever they are, are one gram.
Of each WINDOW neighbouring grams the one of the greatest hash (the least complement) is chosen, the rightmost
of equals, and its position kept.  Two texts that share a run of K + WINDOW - 1 code points share a chosen hash,
wherever the run stands in either.  Spark has no scan over an array that could roll one gram's hash into the
next, so each gram is hashed by itself; which hashes are chosen does not depend on that.

Chosen values are longs: the hash in the upper 36 bits, the gram's position in the lower 28, so
the greatest long of a window is the choice with its rightmost tie.

Defined results: a null text is empty and has no fingerprint; a text of fewer than K code points has one
hash, of all of it; two empty fingerprints are alike (1.0).  Documents follow each other by
ascending doc_id (null first), those with one id by text; after the last comes the first.  Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


#: WINDOW is a power of two: a window's choice is found by doubling.
K, WINDOW = 12, 8
POSITION_BITS = 28
#: Documents that follow each other in one task, and the most such runs (bounds what the driver collects).
RUN_ROWS, MOST_RUNS = 2_000, 1 << 16
_FIRST = -(1 << 63)


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pairwise(xs: Column, apart: int, f) -> Column:
    """f of each element and the one `apart` places on; shorter by apart."""
    n = F.greatest(F.size(xs) - apart, F.lit(0))
    return F.zip_with(F.slice(xs, F.lit(1), n), F.slice(xs, F.lit(apart + 1), n), f)


def _position(value: Column) -> Column:
    return value.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))


def chosen(text: Column, offset: Column | None = None) -> Column:
    """array<long>: the chosen values of the text, by position; the text's first position is offset (a bound variable, or 0)."""
    grams = F.regexp_extract_all(text, F.lit(r"(?s)(?=(.{%d}))." % K), F.lit(1))
    grams = F.when(F.length(text) >= K, grams).otherwise(F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(text)))
    placed = F.transform(grams, lambda x, i: F.shiftleft(F.xxhash64(x), POSITION_BITS).bitwiseOR(i.cast("bigint") if offset is None else i + offset))

    def greatest(values: Column, apart: int) -> Column:
        if apart == WINDOW:
            return values
        return let(_pairwise(values, apart, lambda a, b: F.greatest(a, b)), lambda v: greatest(v, 2 * apart))

    few = lambda v: F.when(F.size(v) == 0, v).otherwise(F.array(F.array_max(v)))
    return let(placed, lambda v: F.when(F.size(v) < WINDOW, few(v)).otherwise(F.array_distinct(greatest(v, 1))))


def chosen_of_edit(values: Column, edited: Column, same: Column) -> Column:
    """The chosen values of a text whose first `same` code points are those of the text that has `values`.

    What windows inside the common part choose stays; windows from a little before its end are computed.
    """
    # Bound first: a lambda would compute it, and the length below it, for each element again.
    ends = F.struct((same - (K + WINDOW - 1)).cast("bigint").alias("last"), F.greatest(same - (K + 2 * WINDOW - 3), F.lit(0)).alias("begin"))

    def joined(at: Column) -> Column:
        # Every window with a position up to `last` lies in the common part.
        kept = F.filter(values, lambda v: _position(v) <= at["last"])
        return F.array_distinct(F.concat(kept, chosen(F.substring(edited, at["begin"] + 1, F.length(edited)), at["begin"].cast("bigint"))))

    return let(ends, joined)


def hashes_of(values: Column) -> Column:
    """The distinct hashes of chosen values."""
    return F.array_distinct(F.transform(values, lambda v: F.shiftright(v, POSITION_BITS)))


def positions_of(values: Column) -> Column:
    """The positions, in code points, of chosen values."""
    return F.transform(values, lambda v: _position(v).cast("int"))


def digest(values: Column) -> Column:
    """A 128-bit digest of the chosen values with their positions."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(values)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(1), values)), 16, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    return let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(n / (F.size(a) + F.size(b) - n)))


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """docs with a column array<struct<hash:long, position:int>>."""
    values = chosen(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumn(into, F.transform(values, lambda v: F.struct(F.shiftright(v, POSITION_BITS).alias("hash"), _position(v).cast("int").alias("position"))))


def _runs(keys: DataFrame, rows: int) -> tuple[Column, list[int]]:
    """An expression for the run of a key: runs ascend with the key and hold about RUN_ROWS rows."""
    n = min(MOST_RUNS, -(-rows // RUN_ROWS))
    bounds: list[int] = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        bounds = sorted(set(keys.select(F.percentile_approx("key", shares, max(10_000, 10 * n))).first()[0] or []))
    # Two levels of at most a few hundred comparisons each.
    step = max(1, round(len(bounds) ** 0.5))
    coarse = bounds[step - 1 :: step]
    fine = [bounds[i : i + step - 1] for i in range(0, len(bounds), step)] + [[]]
    longs = lambda xs: F.array(*map(F.lit, xs)).cast("array<bigint>") if xs else F.array().cast("array<bigint>")
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= F.col("key")))
    if not bounds:
        return F.lit(0).cast("long"), bounds
    group = below(longs(coarse))
    return let(group, lambda g: (g * step + below(F.get(F.array(*map(longs, fine)), g))).cast("long")), bounds


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fp and the text and fp of the next document; fp holds chosen values.

    Runs of neighbouring ids are sorted task by task.  Each run also gets the first document of the
    run that follows, so that no window spans all rows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("key"))
    n = rows.count()
    if n == 0:
        return rows.select("doc_id", "text", chosen(F.col("text")).alias("fp"), F.struct("text", chosen(F.col("text")).alias("fp")).alias("next"))
    run, _ = _runs(rows, n)
    rows = rows.withColumn("run", run)
    firsts = sorted(tuple(r) for r in rows.groupBy("run").agg(F.min("key").alias("key")).collect())  # at most MOST_RUNS pairs
    spark = docs.sparkSession
    before = {firsts[i][0]: firsts[i - 1][0] for i in range(len(firsts))}
    heads = spark.createDataFrame([(r, k, before[r]) for r, k in firsts], "run long, key long, before long")
    heads = rows.join(F.broadcast(heads), ["run", "key"]).groupBy("before").agg(F.min("text").alias("text"))
    added = heads.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("key"), F.col("before").alias("run"), F.lit(1).alias("head"))
    parts = max(len(firsts), int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = rows.withColumn("head", F.lit(0)).unionByName(added)
    dealt = both.repartition(min(parts, MOST_RUNS), "run").sortWithinPartitions("run", "head", "key", "text")
    marked = dealt.withColumn("fp", chosen(F.col("text")))
    ordered = W.partitionBy("run").orderBy("head", "key", "text")
    return marked.withColumn("next", F.lead(F.struct("text", "fp")).over(ordered)).where("head = 0").select("doc_id", "text", "fp", "next")


def edited(docs: DataFrame) -> DataFrame:
    """The contract's columns: fingerprints of each text and of its edited text, and their likeness."""
    pairs = with_next(docs)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    pairs = pairs.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next.text"), F.lit(1), quarter)))
    pairs = pairs.withColumn("edited_fp", chosen_of_edit(F.col("fp"), F.col("edited"), n - quarter))
    known = let(hashes_of(F.col("fp")), lambda own: F.struct(likeness(own, hashes_of(F.col("edited_fp"))).alias("near_edited"), likeness(own, hashes_of(F.col("next.fp"))).alias("near_next")))
    return pairs.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("fp")).alias("fingerprint"),
        digest(F.col("edited_fp")).alias("edited_fingerprint"),
        known.alias("near"),
    ).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near.near_edited", "near.near_next")
