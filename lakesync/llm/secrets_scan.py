"""Secret scan: fixed patterns and a linear-chain conditional random field.

Tokens are tagged begin (B), inside (I) or outside (O) from their shape, the words
and shapes of their neighbours and the file's kind, and decoded by Viterbi. The
field is fitted by gradient ascent on the likelihood of token windows of the
corpus, at most ``TRAIN_WINDOWS`` of them, picked by a hash and tagged by the
patterns. So that it learns more than the forms which the patterns know, secrets
of varied keys, separators, quotes and alphabets are planted in ordinary windows,
and harmless look-alikes (dates, versions, links, numbers, names) in others.
Spans it adds carry the kind ``crf``; pattern spans always stay.

Decoding runs on the stretches in which leaving O can pay off at all, those of a
positive sum of the tokens' largest possible gains. Outside them O is optimal.

Null texts are empty: no spans. Repeated rows and null ids are scanned row by row,
an empty table gives no rows. Long texts are scanned whole. Other columns are not
read by the scan; ``redact`` keeps them, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import balanced, sampled

TRAIN_WINDOWS = 4000
PLANTED = 3000
HARMLESS = 2500
WINDOW = 12
BUCKETS = 1 << 14
CACHE_TOKENS = 200_000
KINDS = ("assign", "access", "hex", "crf")
REDACTED = "[SECRET]"

# The base patterns.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is maximal, so shorter ones need no match
MIN_ASSIGN, MIN_ACCESS = 6, 20

# Words that name a secret.
KEY_WORDS = ("password", "passwd", "pwd", "passphrase", "secret", "token", "api_key", "apikey", "access_key", "auth_token",
             "client_secret", "private_key", "credential", "signing_key", "auth", "passwort", "contraseña")
_KEY = re.compile("(?i)" + "|".join(KEY_WORDS) + "|bearer")

_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+|[^\sA-Za-z0-9+/_.=-]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern spans by start, then kind as listed."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def shape(token: str) -> str:
    """Length class, share of digits and character classes of a token."""
    n = len(token)
    digits, upper = sum(c.isdigit() for c in token), sum(c.isupper() for c in token)
    size = "1" if n < 6 else "2" if n < 12 else "3" if n < 20 else "4"
    mixed = "m" if 0 < digits < n and digits * 8 > n else "d" if digits == n else "a"
    return f"{size}{mixed}{'U' if upper * 3 > n else 'u' if upper else 'l'}{'x' if n - sum(c.isalnum() for c in token) else ''}"


def turns(token: str) -> str:
    """How often a token changes between digits, small and capital letters, and
    whether it has letters and digits beside each other: random strings turn often."""
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "." for c in token[:80]]
    words = [k for k in kinds if k != "."]
    n = sum(x != y for x, y in zip(words, words[1:]))
    share = 10 * n // max(len(words), 1)
    return f"{min(n, 9) if n < 3 else 3 + (n >= 5) + (n >= 9)}{min(share, 5)}{'d' if 'd' in words else ''}{'u' if 'u' in words else ''}{'l' if 'l' in words else ''}"


def marks(token: str) -> str:
    """Marks inside a token, in order, without repeats."""
    return "".join(dict.fromkeys(c for c in token if not c.isalnum()))[:4]


def role(token: str) -> str:
    """What a token is to its neighbours: a key word, a mark, or a shape."""
    if any(c.isalnum() for c in token):
        return "key" if _KEY.search(token) else shape(token)
    return token[:3]


def _bucket(feature: str) -> int:
    import xxhash
    return xxhash.xxh32_intdigest(feature.encode("utf-8", "surrogatepass")) % BUCKETS


# features of a token for its own place, the place after it, the second after it, and the place before it
OWN, PREV, PREV2, NEXT = slice(0, 4), slice(4, 5), slice(5, 6), slice(6, 7)


def buckets_of(token: str) -> list[int]:
    size = "-" if len(token) < 8 else "8" if len(token) < 16 else "16" if len(token) < 24 else "24" if len(token) < 36 else "36"
    kind = role(token)
    return [_bucket(f) for f in (
        "shape " + shape(token), "turns " + turns(token) + size, "marks " + marks(token) + size, "role " + kind,
        "prev role " + kind, "prev2 role " + kind, "next role " + kind)]


def plain_form(token: str) -> tuple | None:
    """What the features of an ordinary word depend on: its case and length and
    whether a full stop follows; ``None`` for other tokens."""
    word = token[:-1] if token[-1] == "." else token
    if not (word.isascii() and word.isalpha()) or len(word) > 60 or _KEY.search(word):
        return None
    case = "l" if word.islower() else "U" if word.isupper() and len(word) > 1 else "c" if word[1:].islower() or len(word) == 1 else None
    return None if case is None else (case, len(word), len(token))


class TokenScores(dict):
    """Token -> row of ``table``: its three scores for each of the four places.
    All are forgotten beyond ``CACHE_TOKENS``."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights, self.n = weights, 0
        self.table, self.plain = np.zeros((1024, 12)), {}

    def __missing__(self, token: str) -> int:
        form = plain_form(token)
        if form in self.plain:
            row = self[token] = self.plain[form]
            return row
        if form:
            self.plain[form] = self.n
        if self.n == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        f = buckets_of(token)
        self.table[self.n] = np.concatenate([self.weights[f[part]].sum(0) for part in (OWN, PREV, PREV2, NEXT)])
        self[token] = self.n
        self.n += 1
        return self.n - 1

    def bound(self) -> None:
        if len(self) > CACHE_TOKENS:
            self.clear()
            self.n, self.table, self.plain = 0, np.zeros((1024, 12)), {}


def file_feature(text: str) -> int:
    lines = text.count("\n") + 1
    return _bucket(f"file {'code' if text.count('=') + text.count('{') > lines else 'prose'}")


def _scores(tokens: list[str], file: int, known: TokenScores) -> np.ndarray:
    at = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
    t = known.table[at]
    s = t[:, 0:3] + known.weights[file]
    s[1:] += t[:-1, 3:6]
    s[2:] += t[:-2, 6:9]
    s[:-1] += t[1:, 9:12]
    return s


def viterbi(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags (0 O, 1 B, 2 I); I follows only B or I. O precedes and follows."""
    state, back = scores[0] + trans[0], []
    for row in scores[1:]:
        step = state[:, None] + trans
        back.append(step.argmax(0))
        state = step.max(0) + row
    path = [int((state + trans[:, 0]).argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return np.array(path[::-1])


def _windows(batches):
    """Training windows: around each pattern span, and one more per text."""
    for pdf in batches:
        rows = []
        for text in pdf["text"]:
            spans = base_spans(text or "")
            toks = list(_TOKEN.finditer(text or ""))
            if not toks:
                continue
            starts = np.array([m.start() for m in toks])
            tags = np.zeros(len(toks), dtype=np.int8)
            for _, lo, hi in spans:
                a, b = np.searchsorted(starts, [lo, hi])
                tags[a:b] = 2
                tags[a:a + 1] = 1
            marks = [int(np.searchsorted(starts, lo)) for _, lo, _ in spans]
            marks.append(_bucket(text[:64]) % len(toks))
            for i in marks:
                lo, hi = max(0, i - WINDOW), i + WINDOW
                rows.append((_bucket(text[:64] + str(i)), [m[0][:200] for m in toks[lo:hi]], tags[lo:hi].tolist(), file_feature(text)))
        yield pd.DataFrame(rows, columns=["pick", "tokens", "tags", "file"])


_HEX, _DIGITS = "0123456789abcdef", "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_ALNUM = _LOWER + _LOWER.upper() + _DIGITS


def _of(rng, alphabet: str, lo: int, hi: int) -> str:
    return "".join(rng.choice(list(alphabet), int(rng.integers(lo, hi + 1))))


def secret_value(rng, kind: str) -> str:
    """A random secret: hexadecimal, base 64, letters and digits, prefixed, or a
    word with digits and capitals."""
    if kind == "hex":
        out = _of(rng, _HEX, 16, 64)
        return out.upper() if rng.random() < 0.3 else out
    if kind == "base64":
        return _of(rng, _ALNUM + "+/", 16, 60) + "=" * int(rng.integers(0, 3))
    if kind == "prefixed":
        return _of(rng, _LOWER, 2, 5) + str(rng.choice(["_", "-", "_" + _of(rng, _LOWER, 3, 4) + "_"])) + _of(rng, _ALNUM, 16, 40)
    if kind == "word":
        return _of(rng, _LOWER, 3, 8) + _of(rng, _DIGITS, 1, 4) + _of(rng, _ALNUM, 1, 4) + _of(rng, _DIGITS, 0, 2)
    return _of(rng, _ALNUM, 10, 32)


VALUES = ("hex", "base64", "prefixed", "word", "alnum")
FORMS = ("assign", "bearer", "bare", "sentence", "quoted")


def secret_snippet(rng, form: str, kind: str) -> tuple[str, int, int]:
    """A text with a secret, and where its span is: from the key to the value."""
    pick = lambda *x: str(rng.choice(x))
    key = pick(*KEY_WORDS) if rng.random() < 0.8 else pick(*KEY_WORDS) + pick("_", "-") + _of(rng, _LOWER, 2, 6)
    key = pick(key, key.upper(), key.capitalize(), key)
    value = secret_value(rng, kind)
    if form == "bare":  # nothing but its look tells a bare secret: only the long random kinds
        return value, 0, len(value)
    if form == "bearer":
        text = pick("Bearer ", "bearer ", "Basic ", "Token ") + value
        return pick("Authorization: ", "-H ", "") + text, -len(text), 0
    q = pick('"', "'", "")
    if form == "sentence":
        text = f"{key} {pick('is', 'was', '->', 'ist', 'es', 'est')} {q}{value}{q}"
    elif form == "quoted":
        text = f'"{key}"{pick(": ", ":", " : ", " => ")}"{value}"'
    else:
        text = f"{key}{pick('=', ' = ', ': ', ' := ', ':')}{q}{value}{q}"
    return text, 0, len(text)


def harmless_snippet(rng) -> str:
    """A text that looks like a secret or its key and is none."""
    pick = lambda *x: str(rng.choice(x))
    n = lambda lo, hi: str(rng.integers(lo, hi))
    word = lambda: _of(rng, _LOWER, 3, 12)
    return pick(
        f"{n(1990, 2040)}-{n(10, 13)}-{n(10, 29)}", f"{n(0, 30)}.{n(0, 30)}.{n(0, 30)}", f"https://www.{word()}.com/{word()}/{n(1, 9999)}",
        f"{word()}.{word()}@{word()}.org", f"+{n(1, 99)} {n(100, 999)} {n(1000, 9999)} {n(100, 9999)}", n(1, 10 ** 14), f"{n(1, 10 ** 6)}-{n(100, 9999)}-{n(1000, 9999)}",
        f"{word().capitalize()}{word().capitalize()}", f"{word()}_{word()}", word().upper(), f"{n(10, 255)}.{n(10, 255)}.{n(10, 255)}.{n(10, 255)}",
        f"the {pick(*KEY_WORDS)} of {word()}", f"{pick(*KEY_WORDS)} {word()}", f"{word()} = {n(0, 5000)}", f"{word()}: {word()}", f"{word()} = '{word()}'",
        f"{word().upper()}{n(1, 99)}", f"{word()}{n(1, 99)}", f"{n(1, 99)}{word()[:3]}", f"$$${word()}###", f"{word()}*** {word()}&&&", f"{word()}/{word()}.{word()[:3]}",
        f"{_of(rng, _LOWER.upper(), 2, 2)}{n(10, 99)} {n(1000, 9999)} {n(1000, 9999)} {n(1000, 9999)}", f"{word() * 3}", f"id={n(1, 10 ** 8)}",
        f"{n(0, 23)}:{n(10, 59)}:{n(10, 59)}", f"{n(1, 999)}-{n(1, 999)}-{n(1, 9999)}", f"{word()}-{word()}-{word()}", f"SPDX-License-Identifier: {word().upper()}-{n(1, 4)}.0")


def _planted(windows: list, rng, forms, values) -> list:
    """(tokens, tags, file) of ordinary windows with a secret or a harmless
    look-alike put between two of their tokens."""
    plain = [(list(r["tokens"]), r["file"]) for r in windows if not any(r["tags"])]
    out = []
    for i in range(PLANTED + HARMLESS if plain else 0):
        tokens, file = plain[int(rng.integers(len(plain)))]
        if i < PLANTED:
            form, kind = str(rng.choice(forms)), str(rng.choice(values))
            text, lo, hi = secret_snippet(rng, form, "base64" if form == "bare" and kind == "word" and "base64" in values else kind)
            lo, hi = lo % len(text), hi or len(text)
        else:
            text, lo, hi = harmless_snippet(rng), 0, 0
        found = list(_TOKEN.finditer(text))
        inner = [lo <= m.start() < hi for m in found]
        tags = [0 if not x else 1 if not any(inner[:k]) else 2 for k, x in enumerate(inner)]
        at = int(rng.integers(0, len(tokens) + 1))
        left = tokens[max(0, at - WINDOW):at]
        right = tokens[at:at + max(1, 2 * WINDOW - len(left) - len(found))]  # most windows of one length
        out.append((left + [m[0][:200] for m in found] + right, [0] * len(left) + tags + [0] * len(right), file))
    return out


def fit(docs: DataFrame, windows: int = TRAIN_WINDOWS, rounds: int = 30, forms=FORMS, values=VALUES) -> dict:
    """Weights (features x tags) and transitions fitted by full-batch AdaGrad.
    ``forms`` and ``values`` name the planted secrets."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    found = balanced(sampled(texts, ["text"], windows)).mapInPandas(_windows, "pick int, tokens array<string>, tags array<int>, file int")
    data = found.orderBy("pick", "tokens").limit(windows).collect()  # a bounded sample of short windows
    rows = [(list(r["tokens"]), list(r["tags"]), r["file"]) for r in data]
    rows += _planted(data, np.random.default_rng(3), list(forms), list(values))
    weights, trans = np.zeros((BUCKETS, 3)), np.zeros((3, 3))
    trans[0, 2] = -1e3
    free = np.ones((3, 3))
    free[0, 2] = 0
    known: dict = {}
    by_len: dict = {}
    for r in rows:
        by_len.setdefault(len(r[0]), []).append(r)
    sets = []
    for n, part in by_len.items():
        f = np.array([[known.get(t) or known.setdefault(t, buckets_of(t)) for t in tokens] for tokens, _, _ in part])
        sets.append((f, np.array([file for *_, file in part]), np.eye(3)[np.array([tags for _, tags, _ in part])]))
    g_w, g_t = np.full((BUCKETS, 3), 1e-6), np.full((3, 3), 1e-6)
    for _ in range(rounds):
        d_w, d_t = -0.01 * weights, np.zeros((3, 3))
        for f, file, gold in sets:
            a, b = gradient(f, file, gold, weights, trans)
            d_w += a
            d_t += b
        g_w += d_w ** 2
        g_t += d_t ** 2
        weights += 0.5 * d_w / np.sqrt(g_w)
        trans += 0.2 * free * d_t / np.sqrt(g_t)
    return {"weights": weights, "trans": trans}


def window_scores(f: np.ndarray, file: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores (windows x tokens x tags) from the tokens' buckets."""
    s = weights[f[:, :, OWN]].sum(2) + weights[file][:, None]
    s[:, 1:] += weights[f[:, :-1, PREV]].sum(2)
    s[:, 2:] += weights[f[:, :-2, PREV2]].sum(2)
    s[:, :-1] += weights[f[:, 1:, NEXT]].sum(2)
    return s


def gradient(f: np.ndarray, file: np.ndarray, gold: np.ndarray, weights: np.ndarray, trans: np.ndarray):
    """Gradient of the windows' log-likelihood by forward and backward sums."""
    s = window_scores(f, file, weights)
    m = s.shape[1]
    fwd, bwd = np.empty_like(s), np.empty_like(s)
    fwd[:, 0], bwd[:, -1] = s[:, 0] + trans[0], trans[:, 0]
    for t in range(1, m):
        fwd[:, t] = np.logaddexp.reduce(fwd[:, t - 1, :, None] + trans, axis=1) + s[:, t]
    for t in range(m - 2, -1, -1):
        bwd[:, t] = np.logaddexp.reduce(trans + (s[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
    z = np.logaddexp.reduce(fwd[:, -1] + trans[:, 0], axis=1)
    diff = gold - np.exp(fwd + bwd - z[:, None, None])
    d_w, d_t = np.zeros_like(weights), np.zeros((3, 3))
    for part, from_, to in ((OWN, 0, 0), (PREV, 0, 1), (PREV2, 0, 2), (NEXT, 1, 0)):
        at, own = f[:, from_:m - to, part], diff[:, to:m - from_]
        for tag in range(3):
            d_w[:, tag] += np.bincount(at.ravel(), weights=np.repeat(own[:, :, tag].ravel(), at.shape[2]), minlength=len(weights))
    np.add.at(d_w, file, diff.sum(1))
    for t in range(1, m):
        p = np.exp(fwd[:, t - 1, :, None] + trans + (s[:, t] + bwd[:, t])[:, None, :] - z[:, None, None])
        d_t += (gold[:, t - 1, :, None] * gold[:, t, None, :] - p).sum(0)
    d_t[0] += diff[:, 0].sum(0)
    d_t[:, 0] += diff[:, -1].sum(0)
    return d_w, d_t


def crf_spans(text: str, model: dict, known: TokenScores) -> list[tuple[str, int, int]]:
    """Token spans tagged B I*, by start."""
    words = _TOKEN.findall(text)
    if not words:
        return []
    trans = model["trans"]
    s = _scores(words, file_feature(text), known)
    # the most that a token off O can gain: its own score and one transition more than O to O
    extra = max(0.0, (trans - trans[0, 0]).max())
    gain = s[:, 1:].max(1) - s[:, 0] + 2 * extra
    # tokens of any stretch of positive total: the highest later sum beats the lowest earlier one
    total = np.concatenate([[0.0], np.cumsum(gain)])
    covered = np.maximum.accumulate(total[::-1])[::-1][1:] > np.minimum.accumulate(total)[:-1]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    if not len(edges):
        return []
    toks = list(_TOKEN.finditer(text))
    out = []
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        tags = viterbi(s[start:end], trans)
        k = 0
        while k < len(tags):
            if tags[k] == 1:
                e = k + 1
                while e < len(tags) and tags[e] == 2:
                    e += 1
                own = [m for m in toks[start + k:start + e] if any(map(str.isalnum, m[0]))]  # no quotes at the ends
                if own:
                    out.append(("crf", own[0].start(), own[-1].end()))
                k = e
            else:
                k += 1
    return out


def all_spans(text: str, model: dict, known: TokenScores):
    """Base spans, and all spans: the base ones and those of the field that no
    base span covers."""
    base = base_spans(text)
    covered = lambda a, b: any(lo <= a and b <= hi for _, lo, hi in base)
    added = [s for s in crf_spans(text, model, known) if not covered(s[1], s[2])]
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """Counts, digest and spans per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    def run(batches):
        known = TokenScores(shared.value["weights"])
        for b in batches:
            rows = []
            for text in b.column(1):
                base, every = all_spans(text.as_py() or "", shared.value, known)
                known.bound()
                n = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return balanced(read).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with every span of a text replaced by ``REDACTED``; overlapping
    spans become one. n_chars follows; rows without spans stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        known = TokenScores(shared.value["weights"])

        def one(text):
            if not text:
                return text
            out, at = [], 0
            spans = all_spans(text, shared.value, known)[1]
            known.bound()
            for _, lo, hi in spans:
                if lo >= at:
                    out += [text[at:lo], REDACTED]
                at = max(at, hi)
            return "".join([*out, text[at:]])
        return texts.map(one, na_action="ignore")

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    both = row.select("row", "text", clean("text").alias("clean"))
    change = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        change["n_chars"] = F.when(F.col("clean") == F.col("text"), F.col("row.n_chars")).otherwise(F.char_length("clean"))
    return both.select(*[change.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
