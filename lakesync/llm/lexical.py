"""Ranked lexical search by a dual tree over items and documents.

Every document becomes a sparse vector of term impacts, every item one of term
weights; a score is their integer product. Blocks of documents, ordered so that
neighbours share their weightiest term, form a tree whose nodes hold the largest
impact per term (coordinate maxima); the items form a second tree whose nodes
hold the largest weight per term. The product of two nodes' maxima bounds every
score below them, so a node pair whose bound is under the weakest kth score of
its items is dropped with all documents and items below it. Equal bounds go on,
so ties are decided exactly, by ascending doc_id (null first).

The kth scores start from a pass over one document in ``FIRST_PASS``: the kth
best of a part of the documents can only be lower than the kth best of all, so
this start never changes the result, only what is pruned.

Distinct item texts are searched in blocks of bounded size, each broadcast to
one pass over all documents. Null texts, and texts without terms, match nothing;
such documents count in no statistic. Repeated document
rows are ranked row by row; repeated items each get their rows; a null item_id
is kept. An empty table on either side gives no rows. Only the columns named
here are read, so others may have any name. Long texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import balanced, stored

TOP = 50
BLOCK_BYTES = 128 << 10
BLOCK_ITEMS = 512
FIRST_PASS = 64
DOC_LEVELS = (2048, 256, 32)   # documents under a node, root to leaf
ITEM_LEVELS = (64, 8, 1)       # items under a node, root to leaf
NULL_ID = -(1 << 63)

# UTF-8 bytes: A-Z lower-cased, the separators (all of them ASCII) blanks.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def text_terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TERMS).split() if text else []


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), term numbers of ``vocabulary`` and counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # terms of one item block

    def run(batches):
        known = shared.value
        for b in batches:
            n, terms, tfs = [], [], []
            for text in b.column(1):
                found = text_terms(text.as_py())
                counts = Counter(t for t in map(known.get, found) if t is not None)
                n.append(len(found))
                terms.append(list(counts))
                tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tfs"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return balanced(read).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Items:
    """A block of items as a tree: per level the node's weight maxima (rows, one
    column per term), and per node of the last level its item."""

    def __init__(self, item_terms: list[list[int]], weights: np.ndarray):
        heavy = [max(t, key=lambda i: (weights[i], i), default=-1) for t in item_terms]
        self.order = sorted(range(len(item_terms)), key=lambda i: (heavy[i], i))
        leaf = np.zeros((len(item_terms), len(weights)))
        for row, i in enumerate(self.order):
            leaf[row, item_terms[i]] = weights[item_terms[i]]
        self.levels = [np.maximum.reduceat(leaf, np.arange(0, len(leaf), size), axis=0) for size in ITEM_LEVELS]

    def weakest(self, kth: np.ndarray, level: int) -> np.ndarray:
        return np.minimum.reduceat(kth, np.arange(0, len(kth), ITEM_LEVELS[level]))


class Best:
    """Per item the ``top`` best (score, doc_id) so far; ``kth`` is the score that
    a further document must reach."""

    def __init__(self, floor: np.ndarray, top: int):
        self.kth, self.top = np.maximum(floor, 1), top
        self.scores = [np.empty(0, np.int64)] * len(floor)
        self.ids = [np.empty(0, np.int64)] * len(floor)

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        if len(scores) > self.top:
            keep = np.lexsort((ids, -scores))[:self.top]
            scores, ids = scores[keep], ids[keep]
            self.kth[item] = max(self.kth[item], scores[-1])
        self.scores[item], self.ids[item] = scores, ids


def _maxima(owner: np.ndarray, term: np.ndarray, value: np.ndarray, n_nodes: int):
    """Per node the (terms, largest values) of its entries."""
    order = np.lexsort((-value, term, owner))
    owner, term, value = owner[order], term[order], value[order]
    new = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(term) != 0)]) if len(owner) else np.empty(0, bool)
    owner, term, value = owner[new], term[new], value[new]
    cut = np.searchsorted(owner, np.arange(n_nodes + 1))
    return [(term[a:b], value[a:b]) for a, b in zip(cut, cut[1:])]


def search_block(ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, items: Items, best: Best) -> int:
    """Offers the block's documents (entries doc, term, impact) to ``best``;
    returns the number of document-item pairs that were scored."""
    if not len(doc):
        return 0
    heavy = items.levels[0].max(0)[term] * impact
    top = np.lexsort((heavy, doc))
    last = np.flatnonzero(np.concatenate([np.diff(doc[top]) != 0, [True]]))
    place_key = np.full(len(ids), -1)
    place_key[doc[top][last]] = term[top][last]
    place = np.empty(len(ids), np.int64)
    place[np.argsort(place_key, kind="stable")] = np.arange(len(ids))
    ids = ids[np.argsort(place)]
    doc = place[doc]
    trees = [_maxima(doc // size, term, impact, -(-len(ids) // size)) for size in DOC_LEVELS]
    single = _maxima(doc, term, impact, len(ids))
    scored = 0

    def descend(level: int, node: int, candidates: np.ndarray) -> None:
        nonlocal scored
        terms, most = trees[level][node]
        bound = items.levels[level][np.ix_(candidates, terms)] @ most
        alive = candidates[(bound >= items.weakest(best.kth, level)[candidates]) & (bound > 0)]
        if not len(alive):
            return
        if level + 1 < len(DOC_LEVELS):
            fan = ITEM_LEVELS[level] // ITEM_LEVELS[level + 1]
            below = (alive[:, None] * fan + np.arange(fan)).ravel()
            below = below[below < len(items.levels[level + 1])]
            wide = DOC_LEVELS[level] // DOC_LEVELS[level + 1]
            for child in range(node * wide, min((node + 1) * wide, len(trees[level + 1]))):
                descend(level + 1, child, below)
            return
        lo = node * DOC_LEVELS[level]
        hi = min(lo + DOC_LEVELS[level], len(ids))
        exact = np.zeros((hi - lo, len(terms)))
        for d in range(lo, hi):
            exact[d - lo, np.searchsorted(terms, single[d][0])] = single[d][1]
        # sums of integers below 2^53: exact in doubles
        scores = (exact @ items.levels[level][np.ix_(alive, terms)].T).astype(np.int64)
        scored += scores.size
        hits = scores >= best.kth[alive]
        for j in np.flatnonzero(hits.any(0)):
            best.add(alive[j], scores[hits[:, j], j], ids[lo:hi][hits[:, j]])

    for root in range(len(trees[0])):
        descend(0, root, np.arange(len(items.levels[0])))
    return scored


def _found(vecs: DataFrame, items: Items, weights: np.ndarray, kth: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """item (row of the tree), doc_id, score: at most ``top`` rows an item and task."""
    shared = vecs.sparkSession.sparkContext.broadcast((items, kth))  # one item block

    def run(batches):
        tree, start = shared.value
        best = Best(start.copy(), top)
        for b in batches:
            for lo in range(0, b.num_rows, DOC_LEVELS[0]):
                part = b.slice(lo, DOC_LEVELS[0])
                ids = part.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                size = np.diff(part.column(2).offsets.to_numpy())
                doc = np.repeat(np.arange(len(ids)), size)
                term = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False)
                n = part.column(1).to_numpy(zero_copy_only=False)
                search_block(ids, doc, term, impacts(tf, n[doc], n_docs, n_terms), tree, best)
        rows = [(i, d, s) for i in range(len(start)) for d, s in zip(best.ids[i].tolist(), best.scores[i].tolist())]
        item, ids, scores = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([
            pa.array([tree.order[i] for i in item], pa.int32()),
            pa.array([None if d == NULL_ID else d for d in ids], pa.int64()), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return vecs.select("doc_id", "n", "terms", "tfs").where("n > 0").mapInArrow(run, "item int, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, texts: list[str], top: int = TOP) -> DataFrame:
    """item (index into ``texts``, one block), rank, doc_id, score."""
    vocabulary: dict[bytes, int] = {}
    item_terms = [sorted({vocabulary.setdefault(t, len(vocabulary)) for t in text_terms(x)}) for x in texts]
    vecs = stored(vectors(docs, vocabulary), "vectors")
    total = vecs.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in vecs.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term of the block
        df[r["t"]] = r["count"]
    weights = np.array([weight(total["docs"], int(x)) for x in df], dtype=np.int64)
    items = Items(item_terms, weights)
    kth = np.ones(len(texts), np.int64)
    part = vecs.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(FIRST_PASS)) == 0)
    args = (total["docs"], max(total["terms"], 1), top)
    for r in _ranked(_found(part, items, weights, kth, *args), top).where(F.col("rank") == top).collect():  # one row an item
        kth[items.order.index(r["item"])] = r["score"]
    return _ranked(_found(vecs, items, weights, kth, *args), top).select("item", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score for every row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    texts = asked.select("text").distinct()
    size = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-(size["bytes"] or 0) // BLOCK_BYTES), -(-size["n"] // BLOCK_ITEMS))
    key = F.sha2("text", 256)
    out = None
    for k in range(blocks if size["n"] else 0):
        block = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k) if blocks > 1 else texts
        held = sorted(r["text"] for r in block.collect())  # about BLOCK_BYTES
        numbers = spark.createDataFrame([(i, t) for i, t in enumerate(held)], "item int, text string").select("item", key.alias("key"))
        found = stored(search(docs, held, top).join(F.broadcast(numbers), "item").drop("item"), "ranked")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "rank int, doc_id long, score long").join(
            items.select("item_id").limit(0), F.lit(True)).select("item_id", "rank", "doc_id", "score")
    return asked.select("item_id", key.alias("key")).join(out, "key").select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
terms AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM rows),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
len AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (SELECT DISTINCT i.r, i.item_id, i.term FROM (
    SELECT r, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS r, item_id, text FROM benchmark)) i),
scored AS (SELECT i.r AS item, i.item_id, tf.r, tf.doc_id,
    CAST(sum(CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
    FROM items i JOIN tf USING (term) JOIN df USING (term) JOIN len ON len.r = tf.r CROSS JOIN total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
