"""Best-fit packing of token pieces by hierarchical residual packing.

The pieces' sizes are dealt to the partitions by a hash, so that lengths which
are clustered in the input mix. Every partition packs its own pieces best-fit
decreasing and emits the bins it has filled. Underfull bins travel up a tree as items: each level deals them to
an eighth of the groups and packs them best-fit again. A group passes on its
``CARRY`` emptiest bins at most; after best-fit all but one bin are more than
half full, so the others could only take up one of the few passed-on small bins.
The rest are emitted as they are: no piece is dropped.

Null texts count as empty: one piece holding only the closing id 0. Repeated
rows and ids are packed row by row. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import balanced, stored

CAPACITY = 2048
NEARLY_FULL = 0.98
CARRY = 64
FAN_IN = 8
CLOSING_ID = 0
CACHE_PARTS = 400_000
NEW_PARTS = 4096
TEXT_BYTES = 32 << 20

# Latin letters (as one code point), digits, ASCII marks but the apostrophe.
_MARKS, _SMALL = r"!-&(-/:-@\[-`{-~", "a-z\u00DF-\u00F6\u00F8-\u00FF"
_PLAIN = f"^[{_SMALL}A-Z\u00C0-\u00D6\u00D8-\u00DE0-9{_MARKS}]+$"
_PART = f"[{_SMALL}]+|[0-9]|[{_MARKS}]+"

_TOKENIZERS: dict = {}
_KNOWN: dict = {}


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def _text_ids(path: str) -> TextIds:
    """What one worker's tasks have learned so far."""
    if path not in _KNOWN:
        _KNOWN[path] = TextIds(_tokenizer(path))
    return _KNOWN[path]


class TextIds:
    """Token ids of texts from those of their chunks and parts.

    The tokenizer drops white space and no token, nor any step of its normalizer,
    reaches across it, so a text's ids are those of its chunks between ASCII blanks,
    one after the other. A chunk of nothing but Latin letters, digits and ASCII marks
    (without the apostrophe of its contractions and the opening of a special token)
    is cut as the tokenizer cuts it, into runs of small letters, digits and runs of
    marks. Chunks and parts are Arrow arrays: only distinct new parts are encoded one
    by one. Of the known ones those that are not used again are forgotten when the
    cache is full."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self._forget()
        self.older = (self.known, self.start, self.flat)

    def _forget(self) -> None:
        """Nothing known but the empty chunk: ``known`` holds chunks and parts,
        ``start`` says where the ids of each begin in ``flat``."""
        self.known = pa.array([""], pa.large_string())
        self.start, self.flat = np.zeros(2, np.int64), np.empty(0, "<u4")

    def _add(self, some: pa.Array, size: np.ndarray, ids: np.ndarray) -> None:
        self.known, self.start, self.flat = (
            pa.concat_arrays([self.known, some]),
            np.concatenate([self.start, self.start[-1] + np.cumsum(size)]),
            np.concatenate([self.flat, ids]))

    def _add_lists(self, some: pa.Array, ids: list) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self._add(some, size, np.fromiter(itertools.chain.from_iterable(ids), "<u4", int(size.sum())))

    @staticmethod
    def chunks(texts: pa.Array) -> pa.Array:
        """The lists of the texts' chunks, some of them empty; null counts as empty."""
        return pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))

    @staticmethod
    def parts(text: str | None) -> pa.Array:
        """The chunks of one text."""
        return TextIds.chunks(pa.array([text], pa.large_string())).values

    def learn(self, chunks: pa.Array) -> np.ndarray:
        """Makes the ids of these chunks known until the next call; returns their numbers."""
        if len(self.known) > CACHE_PARTS:
            self.older = (self.known, self.start, self.flat)
            self._forget()
        distinct = chunks.dictionary_encode()
        new = _without(distinct.dictionary, self.known)
        plain = pc.and_not(pc.match_substring_regex(new, _PLAIN), pc.match_substring(new, "<|"))
        self._encode(new.filter(pc.invert(plain)))
        self._compose(new.filter(plain))
        at = _places(distinct.dictionary, self.known)
        return at[distinct.indices.to_numpy()]

    def _carry(self, new: pa.Array) -> pa.Array:
        """Adds those known before; returns the others."""
        known, start, flat = self.older
        before = pc.index_in(new, value_set=known)
        found = pc.is_valid(before)
        at = before.drop_null().to_numpy()
        self._add(new.filter(found), start[at + 1] - start[at], _gathered(start, flat, at))
        return new.filter(pc.invert(found))

    def _encode(self, new: pa.Array) -> None:
        """Adds chunks or parts by the tokenizer."""
        new = self._carry(new)
        word = pc.match_substring_regex(new, "^[a-z]+$")  # its own byte form
        words, rest = new.filter(word), new.filter(pc.invert(word))
        model = self.tokenizer.model
        self._add_lists(words, [[t.id for t in model.tokenize(w)] for w in words.to_pylist()])
        for lo in range(0, len(rest), NEW_PARTS):
            some = rest.slice(lo, NEW_PARTS)
            self._add_lists(some, [e.ids for e in self.tokenizer.encode_batch_fast(some.to_pylist(), add_special_tokens=False)])

    def _compose(self, new: pa.Array) -> None:
        """Adds plain chunks from the ids of their parts."""
        new = self._carry(new)
        parts = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(new), _PART, r"\0 "))
        distinct = parts.values.dictionary_encode()
        self._encode(_without(distinct.dictionary, self.known))
        at = _places(distinct.dictionary, self.known)[distinct.indices.to_numpy()]
        upto = np.concatenate([[0], np.cumsum(self.start[at + 1] - self.start[at])])
        size = np.diff(upto[parts.offsets.to_numpy()])
        more = pc.invert(pc.is_in(new, value_set=self.known))  # the others are parts themselves
        keep = more.to_numpy(zero_copy_only=False)
        self._add(new.filter(more), size[keep], self.gather(at)[np.repeat(keep, size)])

    def gather(self, at: np.ndarray) -> np.ndarray:
        """The ids of the chunks with these numbers."""
        return _gathered(self.start, self.flat, at)

    def ids(self, chunks: pa.Array) -> np.ndarray:
        return self.gather(self.learn(chunks))


def _without(some: pa.Array, known: pa.Array) -> pa.Array:
    return some.filter(pc.invert(pc.is_in(some, value_set=known)))


def _places(some: pa.Array, known: pa.Array) -> np.ndarray:
    """Where in ``known`` each of ``some`` is; all are there."""
    return pc.index_in(some, value_set=known).to_numpy()


def _gathered(start: np.ndarray, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    size = start[at + 1] - start[at]
    return flat[np.repeat(start[at] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]


def _by_bytes(b: pa.RecordBatch):
    """Slices of at most about ``TEXT_BYTES`` of text."""
    size = pc.binary_length(b.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = np.cumsum(size) // TEXT_BYTES
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), b.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield b.slice(lo, hi - lo)


def _cut(tokenizer_path: str, capacity: int):
    def run(batches):
        known = _text_ids(tokenizer_path)
        for b in batches:
            for part in _by_bytes(b):
                texts = known.chunks(part.column(1))
                at, upto = known.learn(texts.values), texts.offsets.to_numpy()
                row, piece, start, length, crc = [], [], [], [], []
                for i in range(len(texts)):
                    ids = np.append(known.gather(at[upto[i]:upto[i + 1]]), np.array([CLOSING_ID], "<u4"))
                    for n, begin in enumerate(range(0, len(ids), capacity)):
                        own = ids[begin:begin + capacity]
                        row.append(i)
                        piece.append(n)
                        start.append(begin)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.tobytes()))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every text's token pieces. The
    tokenizer must split at white space and drop it, as word_bpe_49k does."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return balanced(read).mapInArrow(_cut(tokenizer_path, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int):
    """Best-fit decreasing: per item its bin (the index of the bin's first item)
    and offset there; per bin its fill. Open bins are kept by free space, the
    free spaces in use as the bits of one integer."""
    owner, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_free: dict[int, list[int]] = {}
    free_bits, fill = 0, {}
    for i in np.argsort(-sizes, kind="stable"):
        i, size = int(i), int(sizes[i])
        fitting = free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                free_bits ^= 1 << free
        else:
            free, b = capacity, i
            fill[i] = 0
        owner[i], offset[i] = b, fill[b]
        fill[b] += size
        if free - size:
            by_free.setdefault(free - size, []).append(b)
            free_bits |= 1 << (free - size)
    return owner, offset, fill


def _pack(capacity: int, carry: int):
    def run(batches):
        frames = [p for p in batches if len(p)]
        if not frames:
            return
        pdf = pd.concat(frames)
        uid, size = pdf["uid"].to_numpy(), pdf["size"].to_numpy()
        owner, offset, fill = best_fit(size, capacity)
        under = sorted((b for b in fill if fill[b] < NEARLY_FULL * capacity), key=lambda b: (fill[b], b))
        half = [b for b in under if 2 * fill[b] <= capacity]
        passed = set(half + under[len(half):len(half) + carry])
        yield pd.DataFrame({"uid": uid, "bin": uid[owner], "offset": offset,
                            "fill": [fill[int(b)] for b in owner],
                            "passed": [int(b) in passed for b in owner]})
    return run


def pack(items: DataFrame, capacity: int = CAPACITY, carry: int = CARRY) -> DataFrame:
    """Places (uid, sequence_id, offset) for items (uid, size); uids are unique.

    Only the bins that a level passes on move up the tree; when it ends, each
    level's bins are told where they came to lie, from the top down, and the items
    learn it in one join."""
    schema = "uid long, bin long, offset long, fill long, passed boolean"
    groups = max(1, items.rdd.getNumPartitions())
    levels = [stored(items.select("uid", "size").repartition(groups, "uid").mapInPandas(_pack(capacity, carry), schema), "pack")]
    while groups > 1:
        groups = -(-groups // FAN_IN)
        bins = levels[-1].where("passed").select(F.col("bin").alias("uid"), F.col("fill").alias("size")).distinct()
        group = F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")
        # group i goes to task i
        levels.append(stored(bins.repartitionById(groups, group).mapInPandas(_pack(capacity, carry), schema), "pack"))
    # where the items of a level lie: in the bin that took their bin up, or in their own
    placed = levels.pop().select("uid", "bin", "offset")
    while levels:
        up = placed.select(F.col("uid").alias("bin"), F.col("bin").alias("up"), F.col("offset").alias("up_offset"))
        placed = levels.pop().join(up, "bin", "left").select(
            "uid", F.coalesce("up", "bin").alias("bin"), (F.col("offset") + F.coalesce("up_offset", F.lit(0))).alias("offset"))
    return placed.select("uid", F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    cut = stored(pieces(docs, tokenizer_path, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    places = pack(cut.select("uid", F.col("length").alias("size")), capacity)
    return cut.join(places, "uid").drop("uid")
