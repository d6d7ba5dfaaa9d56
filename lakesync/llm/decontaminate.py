"""Benchmark decontamination by spaced-seed hashing.

Fixed masks ignore some positions, so a window with substituted words still
meets the benchmark under another mask or at another place. Masked hashes of all
documents join those of the benchmark; each hit fixes a diagonal (document
position minus item position), on which the tokens are compared. An item is
leaked where some ``WINDOW`` aligned tokens (or all of a shorter item) agree in
at least ``SIMILARITY``. The masks of each length meet every pattern of
substitutions that this allows (the tests enumerate them), so no leak is missed.

Null and empty texts hold nothing. Equal benchmark texts are searched once and
reported for each item_id; equal document rows give one row per item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

WINDOW = 20
SIMILARITY = 0.8
BROADCAST_ROWS = 1_000_000


def masks_of(n: int) -> tuple[tuple[int, ...], ...]:
    """The masks for items of n tokens; those of ``WINDOW`` tokens serve longer ones."""
    if n < 5:  # no substitution is allowed
        return (tuple(range(n)),)
    if n == 5:
        return ((0, 1, 2), (0, 1, 3))
    if n in (6, 7, 10, 11):
        return ((0, 1, 2, 3), (0, 1, 3, 4))
    return ((0, 2, 3, 4, 5), (0, 1, 2, 5, 6))


def _tokens(col):
    return F.filter(F.split(lower_ascii(F.coalesce(col, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _seeds(hashes: str, lengths: list[int], length=None):
    """(pos, h): a hash per place and mask of ``lengths``, where ``length`` is
    given only for the masks of that length. ``hashes`` is an array column of
    token hashes."""
    at = lambda i, o: F.get(F.col(hashes), i + o)
    n = F.size(hashes)
    none = F.array().cast("array<struct<pos:int,h:bigint>>")

    def places(mask):
        starts = F.when(n > mask[-1], F.sequence(F.lit(0), n - mask[-1] - 1)).otherwise(F.array().cast("array<int>"))
        kind = F.lit(",".join(map(str, mask)))
        made = F.transform(starts, lambda i: F.struct(i.alias("pos"), F.xxhash64(kind, *[at(i, o) for o in mask]).alias("h")))
        return made if length is None else F.when(length.isin([w for w in lengths if mask in masks_of(w)]), made).otherwise(none)

    return F.concat(none, *[places(mask) for mask in sorted({m for w in lengths for m in masks_of(w)})])


def _row_key():
    """The hash that stands for a row's doc_id and text."""
    return F.xxhash64("doc_id", F.col("text").cast("string"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start (token), n_same, n_item and best_window of every
    item leaked into a document."""
    return _leaks(docs, benchmark).drop("key")


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    b = benchmark.select("item_id", _tokens(F.col("text").cast("string")).alias("item")).where(F.size("item") > 0)
    b = stored(b.withColumn("item_key", F.xxhash64("item")), "benchmark")
    items = b.groupBy("item_key").agg(F.first("item").alias("item"))
    length = F.least(F.size("item"), F.lit(WINDOW))
    lengths = [r[0] for r in items.select(length).distinct().collect()]  # at most WINDOW values
    seeds = items.withColumn("hs", F.transform("item", lambda t: F.xxhash64(t)))
    seeds = seeds.select("item_key", F.explode(_seeds("hs", lengths, length)).alias("s"))
    seeds = stored(seeds.select("item_key", F.col("s.pos").alias("item_pos"), "s.h").distinct(), "seeds")
    d = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), _row_key().alias("key")).where("text is not null")
    found = d.select("key", F.transform(_tokens(F.col("text")), lambda t: F.xxhash64(t)).alias("hs")) \
        .select("key", F.explode(_seeds("hs", lengths)).alias("s")).select("key", "s.pos", "s.h")
    if seeds.count() <= BROADCAST_ROWS:  # rows of three numbers; beyond it a shuffle join
        seeds = F.broadcast(seeds)
    hits = stored(found.join(seeds, "h").select("key", "item_key", (F.col("pos") - F.col("item_pos")).alias("diag")).distinct(), "hits")
    texts = d.join(hits.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]) \
        .select("key", "doc_id", _tokens(F.col("text")).alias("words"))
    pairs = hits.join(texts, "key").join(items, "item_key")
    same = F.transform("item", lambda t, j: F.when((F.col("diag") + j >= 0) & (F.get("words", F.greatest(F.col("diag") + j, F.lit(0))) == t), 1).otherwise(0))
    pairs = pairs.withColumn("same", same).withColumn("w", F.least(F.lit(WINDOW), F.size("item")))
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("item") - F.col("w") + 1), lambda i: total(F.slice("same", i, F.col("w")))))
    pairs = pairs.select("key", "doc_id", "item_key", "w", F.size("item").alias("n_item"), total("same").alias("n_same"), best.alias("best_window"),
                         F.greatest("diag", F.lit(0)).alias("start")).where(F.col("best_window") >= SIMILARITY * F.col("w"))
    top = pairs.groupBy("key", "item_key").agg(F.max(F.struct("best_window", "n_same", (-F.col("start")).alias("s"), "doc_id", "n_item")).alias("t"))
    return top.join(b.select("item_key", "item_id"), "item_key").select(
        "key", "t.doc_id", "item_id", (-F.col("t.s")).alias("start"), "t.n_same", "t.n_item", "t.best_window")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a leaked item. Rows are judged one by
    one, by their doc_id (null or not) and text: a clean row stays beside a leaked
    one of its doc_id."""
    bad = stored(_leaks(docs, benchmark), "leaks").select(F.col("key").alias("_leaked")).distinct()
    return docs.join(bad, _row_key() == F.col("_leaked"), "left_anti")
