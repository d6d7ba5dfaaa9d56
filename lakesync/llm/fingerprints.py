"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text's paragraphs (lines, cut further after words whose hash says so, so that
an edit moves no more than the cut around it) become 64-bit digests, a repeated
paragraph once per occurrence. Each digest is added to one cell in each of three
parts of the sketch: count, xor of the digests, xor of check values. Subtracting
two sketches cancels shared digests; peeling cells of count +-1 recovers the
differing ones. Where peeling fails the sketches are built again: at the size
that holds all their digests if that is more, and ``GROWTH`` times as large from
then on. The sketches of many pairs lie in one array and are peeled together.

Likeness is shared / (shared + differing) digests; two empty texts are alike (1).
Equal texts have equal fingerprints. Null texts are empty. Every row gets a
result: rows of one doc_id follow each other by their text's hash, null doc_ids
come first. Very long texts are digested in blocks. An empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 24
GROWTH = 4
CUT_EVERY = 16
TARGET_BYTES = 16 << 20
CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 512
BLOCK = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(10).integers(0, 1 << 64, 256, np.uint64)
_BASE = 0xD1342543DE82EF95


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _runs(starts: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One hash per run of ``values`` (random numbers of bytes), a polynomial of
    the places in the run."""
    powers = np.full(int(sizes.max()), _BASE, np.uint64)
    powers[0] = 1
    at = np.arange(len(values)) - np.repeat(starts, sizes)
    return _mixed(np.add.reduceat(values * np.multiply.accumulate(powers)[at], starts), 7)


def _paragraph_ends(raw: np.ndarray) -> np.ndarray:
    """Where paragraphs end in ``raw``: after a line's end, and after a word whose
    hash is 0 modulo CUT_EVERY, with the blanks behind it. The last one may go on
    beyond ``raw``."""
    inside = ~_BLANK[raw]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    start, size = edge[::2], edge[1::2] - edge[::2]
    ends = np.flatnonzero(raw == 0x0A) + 1
    if len(start) > 1:
        words = _runs(np.cumsum(size) - size, size, _BYTE[raw[inside]])
        ends = np.union1d(ends, start[1:][words[:-1] % np.uint64(CUT_EVERY) == 0])
    return ends


def digests(text: str) -> np.ndarray:
    """One digest per paragraph; occurrence n of a repeated one has its own."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    out, lo, width = [], 0, BLOCK
    while lo < len(raw):
        part = raw[lo:lo + width]
        ends = _paragraph_ends(part)
        if lo + len(part) == len(raw):
            ends = ends if len(ends) and ends[-1] == len(part) else np.append(ends, len(part))
        elif not len(ends):
            width *= 2  # one paragraph longer than the block
            continue
        starts = np.concatenate([[0], ends[:-1]])
        out.append(_runs(starts, ends - starts, _BYTE[part[:ends[-1]]]))
        lo, width = lo + int(ends[-1]), BLOCK
    if not out:
        return np.empty(0, np.uint64)
    x = np.concatenate(out)
    order = np.argsort(x, kind="stable")
    new = np.concatenate([[True], np.diff(x[order]) != 0])
    nth = np.arange(len(x)) - np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
    again = np.empty(len(x), np.uint64)
    again[order] = nth
    return np.where(again > 0, _mixed(x + again * np.uint64(_BASE), 8), x)


def _places(x: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Each digest's cell in the three parts of a sketch of so many cells."""
    part = (cells // 3).astype(np.uint64)
    return np.stack([(_mixed(x, s) % part).astype(np.int64) + (s - 1) * part.astype(np.int64) for s in (1, 2, 3)])


def _added(sketch, x: np.ndarray, at: np.ndarray, sign) -> None:
    """Adds (sign 1) or subtracts (-1) digests at their three cells."""
    count, keys, checks = sketch
    check = _mixed(x, 4)
    for cell in at:
        np.add.at(count, cell, sign)
        np.bitwise_xor.at(keys, cell, x)
        np.bitwise_xor.at(checks, cell, check)


def _empty(cells: int):
    return np.zeros(cells, np.int64), np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)


def sketches(sets: list[np.ndarray]):
    """(count, xor of digests, xor of checks) of every set, CELLS cells each."""
    out = _empty(len(sets) * CELLS)
    x = np.concatenate([*sets, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _added(out, x, _places(x, np.full(len(x), CELLS)) + owner * CELLS, 1)
    return [part.reshape(-1, CELLS) for part in out]


def peel(sketch, start: np.ndarray, cells: np.ndarray):
    """Peels difference sketches that lie one behind the other (``start`` and
    ``cells`` of each): the digests found with their sign and owner, and which
    sketches came out empty."""
    count, keys, checks = sketch
    owner = np.repeat(np.arange(len(start)), cells)
    found = []
    todo = np.arange(len(count))
    while len(todo):
        todo = todo[np.abs(count[todo]) == 1]
        pure = todo[_mixed(keys[todo], 4) == checks[todo]]
        if not len(pure):
            break
        # a digest may be pure in several cells of its sketch
        _, first = np.unique(np.stack([owner[pure].astype(np.uint64), keys[pure]]), axis=1, return_index=True)
        pure = pure[first]
        x, of, sign = keys[pure], owner[pure], count[pure]
        found.append((x, of, sign))
        at = _places(x, cells[of]) + start[of]
        _added(sketch, x, at, -sign)
        todo = np.unique(at)
    left = (count != 0) | (keys != 0) | (checks != 0)
    done = np.bincount(owner[left], minlength=len(start)) == 0
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), done
    return (*(np.concatenate(c) for c in zip(*found)), done)


def differences(pairs: list[tuple[np.ndarray, np.ndarray]]):
    """Per pair the digests only in the first, only in the second, and the number
    of cells that gave them."""
    out: list = [None] * len(pairs)
    todo, cells = np.arange(len(pairs)), np.full(len(pairs), CELLS)
    while len(todo):
        start = np.cumsum(cells) - cells
        sketch = _empty(int(cells.sum()))
        for side, sign in ((0, 1), (1, -1)):
            sets = [pairs[i][side] for i in todo]
            x = np.concatenate(sets)
            of = np.repeat(np.arange(len(todo)), [len(s) for s in sets])
            _added(sketch, x, _places(x, cells[of]) + start[of], sign)
        x, of, sign, done = peel(sketch, start, cells)
        order = np.argsort(of, kind="stable")
        x, of, sign = x[order], of[order], sign[order]
        cut = np.searchsorted(of, np.arange(len(todo) + 1))
        for j in np.flatnonzero(done):
            part, s = x[cut[j]:cut[j + 1]], sign[cut[j]:cut[j + 1]]
            out[todo[j]] = (part[s > 0], part[s < 0], int(cells[j]))
        todo, cells = todo[~done], cells[~done]
        # room for every digest of the two, then ever more
        whole = np.array([CELLS * (-(-2 * (len(pairs[i][0]) + len(pairs[i][1])) // CELLS)) for i in todo], dtype=np.int64)
        cells = np.where(whole > cells, whole, cells * GROWTH)
    return out


def differing(x: np.ndarray, y: np.ndarray):
    """Digests only in x, only in y, and the number of cells that gave them."""
    return differences([(x, y)])[0]


def encoded(count: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> str:
    return base64.b64encode(count.astype("<i4").tobytes() + keys.astype("<u8").tobytes() + checks.astype("<u4").tobytes()).decode()


def likeness(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[float]:
    out = []
    for (x, y), (only_x, only_y, _) in zip(pairs, differences(pairs)):
        apart, total = len(only_x) + len(only_y), len(x) + len(y)
        out.append((total - apart) / (total + apart) if total else 1.0)
    return out


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _rows(chunk: list[tuple]) -> pa.RecordBatch:
    """Results of the rows (doc_id, text, its digests, next text, its digests)."""
    ids, texts, x, following, z = zip(*chunk)
    other = [edited(t, f) for t, f in zip(texts, following)]
    y = [digests(t) for t in other]
    prints = [[encoded(*cells) for cells in zip(*sketches(list(s)))] for s in (x, y)]
    like = likeness([*zip(x, y), *zip(x, z)])
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in other], pa.string()), pa.array(prints[0], pa.string()),
        pa.array(prints[1], pa.string()), pa.array(like[:len(x)], pa.float64()), pa.array(like[len(x):], pa.float64())], _FIELDS)


def _fingerprint(batches):
    """Rows sorted by part, then (copy, doc_id): each row is finished when the
    next row of its part has come; a part's copy row is only a next row."""
    held, chunk, size = None, [], 0
    for b in batches:
        for part, copy, doc_id, text in zip(*(b.column(i) for i in range(4))):
            text = text.as_py()
            this = (part.as_py(), doc_id.as_py(), text, digests(text))
            if held is not None and held[0] == this[0]:
                chunk.append((*held[1:], *this[2:]))
                size += len(text)
                if size > CHUNK_BYTES or len(chunk) >= CHUNK_ROWS:
                    yield _rows(chunk)
                    chunk, size = [], 0
            held = None if copy.as_py() else this
    if chunk:
        yield _rows(chunk)


def fingerprint_documents(docs: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Fingerprints of every text and of its half-replaced text.

    The next document comes from a range split of doc_id: each part also gets a
    copy of the first document of the part after it (the last part: of the first
    one). Documents whose doc_id is null come first, as in Spark's ascending
    order; those of equal doc_id follow each other by text.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0]
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    if size is None:
        return spark.createDataFrame([], schema)
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-size // target_bytes))
    cuts = sorted(set(d.select(key.alias("k")).approxQuantile("k", [i / parts for i in range(1, parts)], 0.2 / parts)))
    # a row's part is the number of cuts at or below its key
    bounds = F.array(*[F.lit(int(c)) for c in cuts]) if cuts else F.array().cast("array<long>")
    part = F.size(F.filter(bounds, lambda c: c <= key))
    ids = d.select(part.alias("part"), key.alias("k")).groupBy("part").agg(F.min("k").alias("k")).orderBy("part").collect()  # one row per part
    before = {r["k"]: ids[i - 1]["part"] for i, r in enumerate(ids)}
    number = {r["part"]: i for i, r in enumerate(ids)}  # numbered without gaps
    firsts = F.create_map(*[F.lit(x) for k, p in before.items() for x in (k, number[p])])
    dense = F.create_map(*[F.lit(x) for kv in number.items() for x in kv])
    to = F.array(F.struct(dense[part].alias("part"), F.lit(False).alias("copy")),
                 F.struct(firsts[key].alias("part"), F.lit(True).alias("copy")))
    sent = d.select("doc_id", "text", F.explode(to).alias("to")).where("to.part is not null") \
        .select("to.part", "to.copy", "doc_id", "text")
    # part i goes to task i: neither two parts in a task nor a task without one
    return sent.repartitionById(len(ids), "part").sortWithinPartitions("part", "copy", "doc_id", F.xxhash64("text")) \
        .mapInArrow(_fingerprint, schema)
