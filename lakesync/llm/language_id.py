"""Language identification of whole texts, with spans for mixed ones.

Script ranges narrow the candidate languages of each word, hashed character
n-grams score it under every language, and Viterbi decoding with a switching
penalty labels the words. The model is fitted on at most about ``TRAIN_ROWS``
labelled rows (a hash picks them when there are more, never over twice as many);
each row's whole text is used.

Null or letterless texts: ``und`` with score 0 and no spans. Without any
labelled text every document is ``und``. Repeated rows and null doc_ids are
judged row by row; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import balanced, sampled

TRAIN_ROWS = 20_000
BUCKETS = 1 << 14
SWITCH_PENALTY = 12.0
FOREIGN_SCRIPT = -8.0
SHARE_OF_SCRIPT = 0.005
CACHE_WORDS = 400_000
NEW_WORDS = 20_000
TEXTS = 128

# First and last code point of each script range.
SCRIPTS = {
    "latin": (0x0041, 0x024F), "greek": (0x0370, 0x03FF), "cyrillic": (0x0400, 0x052F),
    "armenian": (0x0530, 0x058F), "hebrew": (0x0590, 0x05FF), "arabic": (0x0600, 0x06FF),
    "devanagari": (0x0900, 0x097F), "bengali": (0x0980, 0x09FF), "thai": (0x0E00, 0x0E7F),
    "georgian": (0x10A0, 0x10FF), "kana": (0x3040, 0x30FF), "han": (0x4E00, 0x9FFF),
    "hangul": (0xAC00, 0xD7AF),
}
_NAMES = list(SCRIPTS)
_TOKEN = re.compile(r"[^\W\d_]+")


_FIRST = np.array([lo for lo, _ in SCRIPTS.values()])
_LAST = np.array([hi for _, hi in SCRIPTS.values()])
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one behind the other, and the words' lengths."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return codes, np.array([len(w) for w in words], dtype=np.int64)


def scripts_of(words: list[str]) -> np.ndarray:
    """Index of the script of most of each word's letters (first of equals); -1
    for other scripts, -2 for words without a letter."""
    codes, size = _codes(words)
    owner = np.repeat(np.arange(len(words)), size)
    letter = np.ones(len(codes), bool)
    for i in [i for i, w in enumerate(words) if not w.isalpha()]:
        letter[owner == i] = [ch.isalpha() for ch in words[i]]
    at = np.searchsorted(_FIRST, codes, "right") - 1
    script = np.where((at >= 0) & (codes <= _LAST[at]), at, len(_NAMES))
    counts = np.bincount((owner * (len(_NAMES) + 1) + script)[letter], minlength=len(words) * (len(_NAMES) + 1))
    counts = counts.reshape(len(words), -1)
    best = counts.argmax(1)
    return np.where(counts.sum(1) == 0, -2, np.where(best < len(_NAMES), best, -1))


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- to 4-grams of every bounded lower-cased word and of the
    word itself, and the word that each belongs to."""
    codes, size = _codes([f"<{w.lower()}>" for w in words])
    end = np.cumsum(size)
    left = np.repeat(end, size) - np.arange(len(codes))  # code points up to the word's end
    owner = np.repeat(np.arange(len(words)), size)
    value = codes.astype(np.uint64) + np.uint64(1)
    h, parts, of = np.zeros(len(codes), np.uint64), [], []
    for n in (1, 2, 3, 4):
        fits = np.flatnonzero(left >= n)
        h[fits] = h[fits] * _BASE + value[fits + n - 1]
        parts.append(h[fits])
        of.append(owner[fits])
    power = np.full(int(size.max(initial=1)), _BASE, np.uint64)
    power[0] = 1
    place = np.arange(len(codes)) - np.repeat(end - size, size)
    whole = np.add.reduceat(value * np.multiply.accumulate(power)[place], end - size) if len(words) else h
    parts.append(whole ^ np.uint64(0xABCDEF))
    of.append(np.arange(len(words)))
    x, of = np.concatenate(parts), np.concatenate(of)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64), of


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> dict:
    """The model: languages, log-probabilities per bucket, script candidates."""
    labelled = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"),
                           F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    labelled = sampled(labelled, ["id", "text"], train_rows)

    def count(batches):
        total: dict = {}
        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"]):
                row = total.setdefault(lang, {})
                for w in _TOKEN.findall(text):
                    row[w] = row.get(w, 0) + 1
                if len(row) > 200_000:
                    yield _counted({lang: row})
                    total[lang] = {}
        yield _counted(total)

    def _counted(total):
        rows = []
        for lang, words in total.items():
            c, s = np.zeros(BUCKETS), np.zeros(len(_NAMES) + 1)
            held = list(words)
            for lo in range(0, len(held), NEW_WORDS):
                part = held[lo:lo + NEW_WORDS]
                k = np.array([words[w] for w in part], dtype=np.float64)
                bucket, owner = grams(part)
                c += np.bincount(bucket, weights=k[owner], minlength=BUCKETS)
                script = scripts_of(part)
                s += np.bincount(script[script >= -1] % (len(_NAMES) + 1), weights=k[script >= -1], minlength=len(_NAMES) + 1)
            rows += [(lang, int(b), float(c[b])) for b in np.flatnonzero(c)]
            rows += [(lang, int(-1 - i), float(s[i])) for i in np.flatnonzero(s)]
        return pd.DataFrame(rows, columns=["lang", "bucket", "n"])

    counts = balanced(labelled.select("text", "lang")).mapInPandas(count, "lang string, bucket int, n double") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x BUCKETS rows at most
    langs = sorted(counts["lang"].unique())
    grid, scripts = np.zeros((len(langs), BUCKETS)), np.zeros((len(langs), len(_NAMES) + 1))
    for lang, bucket, k in counts.itertuples(index=False):
        (grid if bucket >= 0 else scripts)[langs.index(lang), bucket if bucket >= 0 else -1 - bucket] = k
    logp = np.log((grid + 0.5) / (grid.sum(1, keepdims=True) + 0.5 * BUCKETS)) if langs else grid
    share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
    return {"langs": langs, "logp": logp.T.copy(), "uses": share >= SHARE_OF_SCRIPT}


class WordScores(dict):
    """Word -> row of ``table``; row 0 is for words without letters. New words
    are scored together, and all are forgotten beyond ``CACHE_WORDS``."""

    def __init__(self, model):
        super().__init__()
        self.model, self.n = model, 1
        self.table = np.zeros((1024, len(model["langs"])))

    def learn(self, words) -> None:
        """Scores the words that are not known yet."""
        if len(self) > CACHE_WORDS:
            self.clear()
            self.n = 1
        new = list(set(words).difference(self))
        for lo in range(0, len(new), NEW_WORDS):
            self._add(new[lo:lo + NEW_WORDS])

    def _add(self, new: list[str]) -> None:
        script = scripts_of(new)
        self.update((w, 0) for w, s in zip(new, script) if s == -2)
        new, script = [w for w, s in zip(new, script) if s != -2], script[script != -2]
        if not new:
            return
        bucket, owner = grams(new)
        size = np.bincount(owner, minlength=len(new))
        s = np.stack([np.bincount(owner, weights=p, minlength=len(new)) for p in self.model["logp"].T[:, bucket]], axis=1) / size[:, None]
        s *= np.minimum([len(w) + 2 for w in new], 12)[:, None] / 3
        uses = self.model["uses"].T[script]
        foreign = ~uses & uses.any(1, keepdims=True)
        s = np.where(foreign, s.min(1, keepdims=True) + FOREIGN_SCRIPT, s)
        while self.n + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.update(zip(new, range(self.n, self.n + len(new))))
        self.table[self.n:self.n + len(new)] = s - s.max(1, keepdims=True)
        self.n += len(new)


def decode(scores: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Viterbi path over rows of per-language scores. If no stretch gains more
    than half the penalty against the best single language, that language is
    the optimal path and the recursion is skipped."""
    best = int(scores.sum(0).argmax())
    gain = np.zeros((len(scores) + 1, scores.shape[1]))
    np.cumsum(scores - scores[:, [best]], axis=0, out=gain[1:])
    if (gain - np.minimum.accumulate(gain, axis=0)).max() <= penalty / 2:
        return np.full(len(scores), best)
    back = np.empty(scores.shape, dtype=np.int16)
    state, own = scores[0].copy(), np.arange(scores.shape[1])
    for t in range(1, len(scores)):
        top = int(state.argmax())
        moved = state[top] - penalty
        stay = state >= moved
        back[t] = np.where(stay, own, top)
        state = np.where(stay, state, moved) + scores[t]
    path = np.empty(len(scores), dtype=np.int64)
    path[-1] = state.argmax()
    for t in range(len(scores) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text or "")


def identify_text(text: str | None, words: WordScores, found: list[str] | None = None) -> tuple[str, float, str]:
    """Language, share of letters' words in it, spans ``lang:start:end``.
    ``found`` are the text's tokens, if they are learnt already."""
    langs = words.model["langs"]
    if found is None:
        found = tokens(text) if langs else []
        words.learn(found)
    rows = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
    if not rows.any():
        return "und", 0.0, ""
    path = decode(words.table[rows])
    weight = np.array([len(w) for w in found]) * (rows > 0)
    mass = np.bincount(path, weights=weight, minlength=len(langs))
    top = int(mass.argmax())
    if (path == path[0]).all():
        return langs[top], 1.0, f"{langs[top]}:0:{len(text)}"
    starts = [m.start() for m in _TOKEN.finditer(text)]
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1)]
    at = [0, *(starts[c] for c in cuts[1:]), len(text)]
    return langs[top], float(mass[top] / mass.sum()), ",".join(f"{langs[path[c]]}:{at[i]}:{at[i + 1]}" for i, c in enumerate(cuts))


def _identified(docs: DataFrame, model: dict, names: list[str]) -> DataFrame:
    """row (the columns ``names``), lang_pred, score, spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers
    added = ["lang_pred", "score", "spans"]
    kept = docs.select(F.col("text").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))

    def run(batches):
        words = WordScores(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, TEXTS):
                part = b.slice(lo, TEXTS)
                texts = part.column(0).to_pylist()
                found = [tokens(t) if shared.value["langs"] else [] for t in texts]
                words.learn(itertools.chain.from_iterable(found))
                out = [identify_text(t, words, f) for t, f in zip(texts, found)]
                pred, score, spans = zip(*out)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                                  pa.array(spans, pa.string())], ["row", *added])

    schema = StructType([StructField("row", kept.schema["row"].dataType), *StructType.fromDDL(
        "lang_pred string, score double, spans string").fields])
    return balanced(kept).mapInArrow(run, schema)


def identify(docs: DataFrame, model: dict, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred, score and spans; a column
    of ``docs`` that bears one of these names gives way to it."""
    added = ["lang_pred", "score", "spans"]
    names = [c for c in (keep or ["doc_id"]) if c not in added]
    return _identified(docs, model, names).select("row.*", *added)


def in_a_language(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with all their columns."""
    return _identified(docs, model, docs.columns).where("lang_pred <> 'und'").select("row.*")


def held_out(doc_id):
    """True where crc32 of the id's decimal text is divisible by 5."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def predict_documents(docs: DataFrame) -> DataFrame:
    model = fit(docs.where(~held_out("doc_id")))
    return identify(docs, model).withColumn("held_out", held_out("doc_id"))
