"""Near-duplicate groups by bottom-k sketches of one hash function.

Rows with equal shingle sets form a class. A class's sketch holds the ``K``
smallest hashes of its shingles; the classes that retain a value form that
value's inverted list.

1. A class linked at similarity t shares t of its shingles, so most of its
   smallest ``PROBE`` values are in lists with another class. Classes with fewer
   than the binomial tail allows (``LOST``) are linked with nothing and leave, as
   do nearly all texts without a near copy, whatever passages they share. Sets of
   at most ``PROBE`` shingles are judged exactly.
2. Every list links its members to one pivot, the member whose values are the
   most widespread (of a group of near copies, the text they were made from).
3. What is still apart is compared by the exact prefix filter on the full sets of
   the remaining classes: with shingles ordered from the rarest, two sets that
   meet the threshold share one of their first n - overlap + 1, where the overlap
   that both sizes require bounds the position on either side. Lists hold classes
   of different components only, and a pair must also pass an exact bound that needs
   no lookup: the bits in which two sets' parity signatures differ are no more than
   the shingles in which the sets do.

All pairs are filtered by size and the estimate on the union sketch (``MARGIN``
below the threshold) and confirmed on the full sets. Only step 1 and the estimate
can lose a link, each with a probability of about ``LOST``; a component loses it
only if no other path joins the two.

Null texts and texts without words: empty set, linked with nothing. Rows are
judged one by one: repeated rows and rows that share a doc_id but not the text
are linked by their texts alone. A row with a null doc_id belongs to its group
too; a group without any doc_id has none as its component_id, and such rows are
marked kept. Extra columns are not read. Long texts are hashed in blocks.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, balanced, with_position

K = 48
PROBE = 36
LOST = 1e-8
MARGIN = 0.3
SIGNATURE = 8  # 64-bit words of a parity signature
BROADCAST_ROWS = 250_000
BLOCK = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
# one random number a byte value, the same for A-Z and a-z
_BYTE = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    """``_BASE`` to the powers 0 .. n - 1, modulo 2^64."""
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the text's words (separated by ASCII blanks, A-Z as a-z),
    in order: polynomials over their UTF-8 bytes."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    out, lo = [], 0
    while lo < len(raw):
        hi = min(lo + BLOCK, len(raw))
        if hi < len(raw):  # up to the block's last separator, or the next one
            cut = np.flatnonzero(_SEPARATOR[raw[lo:hi]])
            if len(cut):
                hi = lo + int(cut[-1]) + 1
            else:
                after = np.flatnonzero(_SEPARATOR[raw[hi:]])
                hi = hi + int(after[0]) + 1 if len(after) else len(raw)
        part, lo = raw[lo:hi], hi
        inside = ~_SEPARATOR[part]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        size = edge[1::2] - edge[::2]
        if not len(size):
            continue
        first = np.cumsum(size) - size
        body = part[inside]
        at = np.arange(len(body)) - np.repeat(first, size)
        out.append(np.add.reduceat(_BYTE[body] * _powers(int(size.max()))[at], first))
    return _mixed(np.concatenate(out)) if out else np.empty(0, np.uint64)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes (as signed numbers) of the word shingles."""
    h = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(h):
        return np.empty(0, np.int64)
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = _mixed(out * np.uint64(_BASE) + h[i:len(h) - n + 1 + i])
    return np.unique(out.view(np.int64))


def least_shared(percent: int) -> int:
    """How many of ``PROBE`` values a linked class shares but for ``LOST``; a few
    points are allowed for values that the other sketch has cut off."""
    p, tail = percent / 100 - 0.04, 0.0
    for k in range(PROBE + 1):
        tail += comb(PROBE, k) * p ** k * (1 - p) ** (PROBE - k)
        if tail > LOST:
            return k
    return PROBE


def sketches(rows: DataFrame, width: int) -> DataFrame:
    """file, row, doc_id, n_shingles, set_key (digest of the set) and sketch."""

    def run(batches):
        import xxhash
        for b in batches:
            n, keys, least = [], [], []
            for text in b.column(3):
                s = shingle_hashes(text.as_py(), width)
                n.append(len(s))
                keys.append(xxhash.xxh128_digest(s.tobytes()))
                least.append(s[:K])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(least, pa.list_(pa.int64()))], ["file", "row", "doc_id", "n_shingles", "set_key", "sketch"])

    read = balanced(rows.select("file", "row", "doc_id", "text"))
    return read.mapInArrow(run, "file string, row long, doc_id long, n_shingles long, set_key binary, sketch array<long>")


def signature(shingles: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of shingles falls on it."""
    bits = np.bincount(shingles.view(np.uint64) % np.uint64(64 * SIGNATURE), minlength=64 * SIGNATURE) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def full_sets(rows: DataFrame, width: int) -> DataFrame:
    """node, n, shingles and signature of the rows (node, text)."""

    def run(batches):
        for b in batches:
            sets = [shingle_hashes(t.as_py(), width) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64())),
                                              pa.array([signature(s) for s in sets], pa.list_(pa.int64()))], ["node", "n", "shingles", "signature"])

    return rows.select("node", "text").mapInArrow(run, "node long, n long, shingles array<long>, signature array<long>")


def components(nodes: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Smallest reachable node per node (node, label), by alternating large-star
    and small-star contraction until the links no longer change. Each node's
    links are reduced to a minimum first, so a hub costs a partial aggregate."""
    edges = scratch.keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    digest = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.keep(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v")
                             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = digest(after)
        scratch.free(edges)
        edges = after
        if before == now:
            break
        before = now
    labels = edges.groupBy("u").agg(F.min("v").alias("label"))
    out = scratch.keep(nodes.join(labels, nodes.node == labels.u, "left").select("node", F.coalesce("label", "node").alias("label")))
    scratch.free(edges)
    return out


def _sizes_fit(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _overlap(a: str, b: str, percent: int):
    """The least intersection of sets of these sizes that meets the threshold."""
    return F.ceil(percent * (F.col(a) + F.col(b)) / (100 + percent))


def _confirmed(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) that meet the threshold on their full sets."""
    side = lambda c: reps.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes_fit("n_a", "n_b", percent))
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, K)
    shared = F.size(F.array_intersect(F.array_intersect("u", "s_a"), F.col("s_b")))
    likely = scratch.keep(sized.withColumn("u", union).where(shared >= (percent / 100 - MARGIN) * F.size("u")).select("a", "b"))
    other = lambda c, s, m: sets.select(F.col("node").alias(c), F.col("shingles").alias(s), F.col("n").alias(m))
    met = likely.join(other("a", "x", "n_a"), "a").join(other("b", "y", "n_b"), "b") \
        .withColumn("both", F.size(F.array_intersect("x", "y")).cast("long"))
    links = scratch.keep(met.where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b"))
    scratch.free(likely)
    return links


def _in_lists(retained: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The values (node, n, pos, v, df) that several classes retain, of the
    classes that can be linked."""
    lists = retained.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    held = scratch.keep(retained.select("node", "n", "pos", "v").join(lists, "v"))
    need = F.when(F.col("n") <= PROBE, F.ceil(percent * F.col("n") / 100)).otherwise(least_shared(percent))
    able = held.groupBy("node", "n").agg(F.count_if(F.col("pos") < PROBE).alias("c")).where(F.col("c") >= need).select("node")
    out = scratch.keep(held.join(able, "node", "left_semi"))
    scratch.free(held)
    return out


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """node, n, v, p: the shingles that others have too, at their place p from
    the class's rarest, as far as a smaller partner may need them."""
    each = sets.select("node", "n", F.explode("shingles").alias("v"))
    lists = each.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    held = each.join(lists, "v")
    mine = Window.partitionBy("node")
    placed = held.withColumn("c", F.count("*").over(mine)) \
        .withColumn("p", F.row_number().over(mine.orderBy("df", "v")) - 1 + F.col("n") - F.col("c"))
    return placed.where(F.col("p") <= F.col("n") - F.ceil(percent * F.col("n") / 100)).select("node", "n", "v", "p")


def _apart(prefixes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), b no larger than a, of different components that the prefix
    filter and the signatures leave. ``labels``: node, label, signature."""
    held = prefixes.join(labels, "node")
    names = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "p", "label", "signature")]
    larger = held.select("v", *names("a"))
    smaller = held.where(F.col("p") <= F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent))).select("v", *names("b"))
    o = _overlap("n_a", "n_b", percent)
    apart = sum((F.bit_count(F.get("signature_a", i).bitwiseXOR(F.get("signature_b", i))) for i in range(SIGNATURE)), F.lit(0))
    fits = ((F.col("label_a") != F.col("label_b")) & ((F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("node_b") < F.col("node_a"))))
            & (100 * F.col("n_b") >= percent * F.col("n_a")) & (F.col("p_a") <= F.col("n_a") - o) & (F.col("p_b") <= F.col("n_b") - o)
            & (apart <= F.col("n_a") + F.col("n_b") - 2 * o))
    return larger.join(smaller, "v").where(fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def grouped(rows: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """file, row, doc_id, n_shingles and label (equal for the rows of a group;
    null for empty sets) of the rows (file, row, doc_id, text)."""
    sk = scratch.keep(sketches(rows, width))
    first = F.min(F.struct("file", "row")).alias("at")
    reps = scratch.keep(sk.where("n_shingles > 0").groupBy("set_key").agg(
        F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), first)
        .withColumn("node", F.monotonically_increasing_id()))
    retained = reps.select("node", "n", F.posexplode("sketch").alias("pos", "v"))
    once = _in_lists(retained, percent, scratch)
    lists = _in_lists(once, percent, scratch)  # again, among those that are left
    scratch.free(once)
    nodes = scratch.keep(lists.groupBy("node").agg(F.sum("df").alias("spread"), F.first("n").alias("n")))
    at = nodes.join(reps.select("node", "at.*"), "node").select("node", "file", "row")
    at = F.broadcast(at) if nodes.count() <= BROADCAST_ROWS else at
    sets = scratch.keep(full_sets(rows.join(at, ["file", "row"]), width))

    member = lists.select("v", "node").join(nodes, "node")
    pivot = member.groupBy("v").agg(F.max(F.struct("spread", "node", "n")).alias("p"))
    pairs = member.join(pivot, "v").where((F.col("node") != F.col("p.node")) & (
        100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n"))) \
        .select(F.greatest("node", "p.node").alias("a"), F.least("node", "p.node").alias("b")).distinct()
    links = _confirmed(pairs, reps, sets, percent, scratch)
    labels = components(nodes.select("node"), links, scratch)
    prefixes = scratch.keep(_prefixes(sets, percent))
    signed = labels.join(sets.select("node", "signature"), "node")
    more = _confirmed(_apart(prefixes, signed, percent), reps, sets, percent, scratch)
    scratch.free(prefixes, sets, lists, labels)
    labels = components(nodes.select("node"), links.unionByName(more), scratch)
    classes = reps.select("set_key", "node").join(labels, "node", "left").select("set_key", F.coalesce("label", "node").alias("label"))
    return sk.select("file", "row", "doc_id", "n_shingles", "set_key").join(classes, "set_key", "left").drop("set_key")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs``."""
    with Scratch(docs.sparkSession) as scratch:
        rows = with_position(docs, scratch).select("file", "row", F.col("doc_id").cast("long").alias("doc_id"),
                                                   F.col("text").cast("string").alias("text"))
        labelled = scratch.keep(grouped(rows, width, percent, scratch))
        least = labelled.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
        component = F.when(F.col("label").isNotNull(), F.col("least")).otherwise(F.col("doc_id"))
        return scratch.result(labelled.join(least, "label", "left").select(
            "doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id (null
    last; of equal ones the first in the files). Rows without words all stay."""
    with Scratch(docs.sparkSession) as scratch:
        placed = with_position(docs, scratch)
        rows = placed.select("file", "row", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        labelled = scratch.keep(grouped(rows, width, percent, scratch).where("label is not null"))
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "file", "row")
        first = labelled.groupBy("label").agg(F.min(order).alias("first"))
        gone = scratch.keep(labelled.join(first, "label").where("file <> first.file or row <> first.row").select("file", "row"))
        gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
        return scratch.result(placed.join(gone, ["file", "row"], "left_anti").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns]))
