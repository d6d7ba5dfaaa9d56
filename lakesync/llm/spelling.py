"""Spelling variants: near words of a vocabulary by dynamic programming over
sorted lists.

A word of length L is listed once for each class c it can belong to as the
shorter or the longer word of a pair (c = L and c = L - 1), under its first
c // 2 code points and, read backwards, under its last c // 2: two words at one
edit share at least one of the two. A list holds the words of one class that
share that key, in sorted order. Every word of a list is matched against the
list by one row of the edit matrix per prefix, three cells wide; adjacent words
share the rows of their common prefix, and a range of the list is skipped as
soon as no cell of its shared prefix's row is at most 1.

Lists longer than ``LIST_ROWS`` are split, exactly: pairs that share one more
code point go to the list of the longer key; pairs that differ right there agree
in all that follows the edit, so they meet under (key, ending). A pair is counted
in one list only: lists name the prefix or ending that a pair must not share.

Null and empty texts have no words; a null doc_id is the empty string in the
hashed text; repeated rows count as often as they occur; an empty table has no
words. Other columns of ``docs`` are not read. Long texts are read whole.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import balanced, stored

MIN_LENGTH = 6
MIN_COUNT = 5
FORM_RATIO = 5
DELETE_EVERY = 199
LIST_ROWS = 4096
CHUNK_CELLS = 1 << 17
STEP_STATES = 1 << 18
FLUSH_WORDS = 200_000
NONE = 9  # a matrix cell outside the band

# Latin-1 bytes: letters kept, A-Z lower-cased, everything else a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def text_words(doc_id: str | None, text: str | None, min_length: int = MIN_LENGTH) -> list[bytes]:
    """Latin-1 words of at least ``min_length`` code points, after deletion."""
    if not text:
        return []
    # every code point becomes one byte; those outside Latin-1 a question mark
    runs = [r for r in text.encode("latin-1", "replace").translate(_LETTERS).split() if len(r) >= min_length]
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = []
    for r in runs:
        h = zlib.crc32(r if r.isascii() else r.decode("latin-1").encode(), start)
        if h % DELETE_EVERY == 0:
            at = h % len(r)
            r = r[:at] + r[at + 1:]
            if len(r) < min_length:
                continue
        out.append(r)
    return out


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """word, n over all documents; tasks count what they read before the shuffle."""

    def batch_of(counts):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                           pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                counts.update(text_words(doc_id, text.as_py(), min_length))
                if len(counts) > FLUSH_WORDS:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return balanced(read).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def one_edit_pairs(letters: np.ndarray, lengths: np.ndarray, lists: np.ndarray, depths: np.ndarray):
    """Row pairs (word, near word) at exactly one edit, both directions.

    Rows are words as code matrices (padded with 0), sorted within ``lists``
    (ascending numbers); the words of a list share their first ``depths`` codes.
    """
    n, width = letters.shape
    rows = np.arange(n)
    same = (letters[1:] == letters[:-1]) & (lists[1:] == lists[:-1])[:, None]
    lcp = np.concatenate([[-1], np.where(same.all(1), width, same.argmin(1))])
    lcp[1:][lists[1:] != lists[:-1]] = -1
    first = np.maximum.accumulate(np.where(lcp < 0, rows, 0))  # first row of the list
    padded = np.concatenate([letters, np.zeros((n, 3), letters.dtype)], axis=1)
    small = lambda x: np.asarray(x, np.int8)
    states = [np.empty(0, np.int32)] * 2 + [small([])] * 3  # list prefix (a row that has it), word, three cells
    found = []
    for d in range(int(depths.min()), width):
        begin = np.flatnonzero(depths == d)
        if len(begin):  # lists whose shared key ends here: the exact prefix, and one edit to either side
            more = (first[begin], begin, np.full(len(begin), 1 if d else NONE), np.zeros(len(begin)), np.where(lengths[begin] > d, 1, NONE))
            states = [np.concatenate([x, y.astype(x.dtype)]) for x, y in zip(states, more)]
            order = np.argsort(states[0], kind="stable")
            states = [x[order] for x in states]
        if not len(states[0]):
            if (depths > d).any():
                continue
            break
        # one child row per distinct prefix of d + 1 codes, and its parent's states
        child = np.flatnonzero((lcp <= d) & (lengths > d) & (depths <= d))
        parent = np.maximum.accumulate(np.where(lcp < d, rows, 0))[child]
        lo, hi = np.searchsorted(states[0], parent, "left"), np.searchsorted(states[0], parent, "right")
        child, lo, m = child[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        kept = []
        # so many states at a time: most end in this step
        for part in np.split(np.arange(len(child)), np.flatnonzero(np.diff(np.cumsum(m) // STEP_STATES)) + 1):
            size = m[part]
            at = np.repeat(lo[part] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
            node, word = np.repeat(child[part], size).astype(np.int32), states[1][at]
            left, mid, right = (x[at] for x in states[2:])
            code, gap = letters[node, d], lengths[word] - (d + 1)
            a = np.where(gap >= -1, np.minimum(left + small(padded[word, d - 1] != code) if d else mid + small(NONE), mid + 1), NONE)
            b = np.where(gap >= 0, np.minimum(np.minimum(mid + small(padded[word, d] != code), right + 1), a + 1), NONE)
            e = np.where(gap >= 1, np.minimum(right + small(padded[word, d + 1] != code), b + 1), NONE)
            last = np.where(gap == 0, b, np.where(gap == -1, a, np.where(gap == 1, e, NONE)))
            hit = (lengths[node] == d + 1) & (last == 1)
            found.append((word[hit], node[hit]))
            alive = np.minimum(np.minimum(a, b), e) <= 1
            kept.append([x[alive] for x in (node, word, small(a), small(b), small(e))])
        states = [np.concatenate(x) for x in zip(*kept)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _listed(words: DataFrame, min_length: int) -> DataFrame:
    """word, n and, per list, its name (cls, side, depth, at, key) and ``r``, the
    word as that side reads it."""
    size = F.char_length("word")
    sides = [(c, s) for c in (size, size - 1) for s in (0, 1)]
    one = F.explode(F.array(*[F.struct(c.alias("cls"), F.lit(s).alias("side")) for c, s in sides]))
    return words.select("word", "n", one.alias("x")).where(F.col("x.cls") >= min_length).select(
        "word", "n", "x.*", F.when(F.col("x.side") == 0, F.col("word")).otherwise(F.reverse("word")).alias("r")) \
        .withColumn("depth", F.floor(F.col("cls") / 2).cast("int")).withColumn("at", F.lit(-1)) \
        .withColumn("key", F.expr("left(r, depth)"))


_NAME = ["cls", "side", "depth", "at", "key"]


def _split(rows: DataFrame, list_rows: int) -> DataFrame:
    """Lists of more than ``list_rows`` rows split by one more code point, as long
    as a word of length cls has two left: the lists that cannot be split hold
    words that differ in two code points at most."""
    while True:
        long = rows.where("at < 0 and depth + 1 < cls").groupBy(*_NAME).agg(F.count("*").alias("m")).where(F.col("m") > list_rows)
        long = stored(long.drop("m"), "long_lists")
        if long.isEmpty():
            return rows
        part = rows.join(long, _NAME, "left_semi")
        deeper = part.withColumn("depth", F.col("depth") + 1).withColumn("key", F.expr("left(r, depth)"))
        # those that part at this code point: the rest after the edit is equal
        here = part.withColumn("at", F.col("depth")).withColumn(
            "key", F.concat(F.col("key"), F.lit(" "), F.expr("right(r, greatest(cls - 1 - depth, 0))")))
        rows = stored(rows.join(long, _NAME, "left_anti").unionByName(deeper).unionByName(here), "lists")


def _matched(chunk):
    """Near-word count and best near word per word of the chunk's lists."""
    words, n, cls, side, depth, at, lists, r = (np.array(x) if i not in (0, 7) else x for i, x in enumerate(zip(*chunk)))
    text = np.array([w.encode("latin-1") for w in r])
    width = text.dtype.itemsize
    letters = text.view(np.uint8).reshape(len(text), width)
    lengths = np.array([len(w) for w in r])
    x, y = one_edit_pairs(letters, lengths, lists, depth)
    ok = np.minimum(lengths[x], lengths[y]) == cls[x]
    x, y = x[ok], y[ok]
    columns = np.arange(width)
    agree = (letters[x] == letters[y]) | (columns >= np.minimum(lengths[x], lengths[y])[:, None])
    # split lists: the pair parts right at the key's end
    apart = (at[x] < 0) | ~agree[np.arange(len(x)), np.minimum(at[x], width - 1)] | (at[x] >= np.minimum(lengths[x], lengths[y]))
    # backward lists: pairs that share their first code points are in a forward list
    half = cls[x] // 2
    back = np.ones(len(x), bool)
    for i in np.flatnonzero(side[x] == 1):
        back[i] = r[x[i]][-half[i]:] != r[y[i]][-half[i]:]
    x, y = x[apart & back], y[apart & back]
    if not len(x):
        return None
    order = np.lexsort((np.array([words[i] for i in y]), -n[y], x))
    x, y = x[order], y[order]
    start = np.flatnonzero(np.diff(np.concatenate([[-1], x])))
    count = np.diff(np.concatenate([start, [len(x)]]))
    return pa.RecordBatch.from_arrays([
        pa.array([words[i] for i in x[start]], pa.string()), pa.array(count, pa.int64()),
        pa.array(n[y[start]], pa.int64()), pa.array([words[i] for i in y[start]], pa.string())], ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, list_rows: int = LIST_ROWS) -> DataFrame:
    """word, n_near and its near word of largest n (best, best_n; ties: the
    smallest) for the words that have one. ``words`` holds distinct (word, n) of
    Latin-1 words of at least ``min_length`` >= 3 code points."""
    rows = _split(stored(_listed(words, min_length), "lists"), list_rows)

    def run(batches):
        chunk, group, name, number, cells = [], [], None, 0, 0
        for b in batches:
            for word, n, r, *key in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                if key != name:
                    if len(group) > 1:
                        chunk += group
                        cells += len(group) * (name[0] + 1)
                    if cells > CHUNK_CELLS:
                        out = _matched(chunk)
                        if out:
                            yield out
                        chunk, cells = [], 0
                    group, name, number = [], key, number + 1
                group.append((word, n, key[0], key[1], key[2], key[3], number, r))
        chunk += group if len(group) > 1 else []
        out = _matched(chunk) if chunk else None
        if out:
            yield out

    lists = rows.select("word", "n", "r", *_NAME).repartition(*_NAME).sortWithinPartitions(*_NAME, "r")
    found = lists.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def followed(forms: DataFrame) -> DataFrame:
    """word, root from (word, form) links without cycles: each round replaces a
    link by the link of its end, so a chain of m links takes log2(m) rounds."""
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = links.join(on, "root", "left")
        if longer.where("further is not null").isEmpty():
            return links
        links = stored(longer.select("word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = FORM_RATIO, list_rows: int = LIST_ROWS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary."""
    words = stored(word_counts(docs, min_length).where(F.col("n") >= min_count), "vocabulary")
    near = near_words(words, min_length, list_rows)
    is_form = F.col("best_n") >= ratio * F.col("n")
    joined = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "variants")
    roots = followed(joined.where("form is not null"))
    return joined.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
