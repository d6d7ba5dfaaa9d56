"""Lexical search, quality scores and spelling variants against plain versions."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from lakesync.llm import common, lexical, quality, queries, spelling
from tests.conftest import SF_CHECK
from tests.oracle import duck, rows_of_spark, rows_of_sql

DOCS = "doc_id long, text string, score double, word string, rank int, item long"
BIG = 9007199254740993  # not a double


def docs_of(spark, rows):
    """Documents with extra columns named as internal and result columns."""
    return spark.createDataFrame([(i, t, 0.5, "w", 1, 7) for i, t in rows], DOCS)


# ------------------------------------------------------------- 11 lexical search
def plain_search(docs, items, top):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [(i, pattern.findall((t or "").translate(lower))) for i, t in docs]
    total, n_docs = sum(len(w) for _, w in words), sum(1 for _, w in words if w)
    df = collections.Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for doc_id, w in words:
            tf, m = collections.Counter(w), 50 + (50 * len(w) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
                    for t in set(pattern.findall((text or "").translate(lower))) if tf[t])
            if s > 0:
                scored.append((-s, doc_id is not None, doc_id or 0))
        out += [(item, r, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scored)[:top], 1)]
    return collections.Counter(out)


def found(spark, docs, items, top):
    got = lexical.rank_documents(docs_of(spark, docs), spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, rank int"), top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return collections.Counter(map(tuple, got.collect()))


def test_search_matches_sql(spark):
    assert rows_of_spark(queries.op11_lexical_search(spark, SF_CHECK)) == rows_of_sql(duck(SF_CHECK), lexical.ORACLE_SQL)


def test_search_with_ties_nulls_and_long_texts(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "straße", "Ünder9"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 30)))) for i in range(300)]
    docs += [(None, "w1 w2"), (BIG, "W1, w2; É"), (7000, None), (7001, ""), (7002, "!!"), (7003, "w3 " * 50_000 + "w4")]
    docs += [(8000 + i, "w5 w6 w7") for i in range(200)] + [(9, "w5 w6 w7")] * 3
    items = [(1, "w5 W6"), (2, "w1-w2 É"), (2, "w3 w4"), (None, "straße"), (3, None), (4, "?"), (5, "unheard"), (6, "w5 W6"), (6, "w5 W6")]
    for top in (1, 10, 500):
        assert found(spark, docs, items, top) == plain_search(docs, items, top)
    for some, asked in (([], items), (docs, []), ([(1, None)], [(1, "a")])):
        assert not found(spark, some, asked, 5)


def test_search_in_several_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 2)
    docs = [(i, f"a{i % 7} b{i % 5} c") for i in range(60)]
    items = [(i, f"a{i} b{i} c") for i in range(9)]
    assert found(spark, docs, items, 4) == plain_search(docs, items, 4)


def test_dual_tree_prunes_and_loses_nothing():
    rng = np.random.default_rng(2)
    terms, n_docs, n_items, top = 300, 6000, 40, 5
    weights = rng.integers(100, 9000, terms)
    groups = [np.arange(g * 30, g * 30 + 30) for g in range(10)]
    item_terms = [sorted(rng.choice(groups[i % 10], 6, replace=False).tolist()) for i in range(n_items)]
    tree = lexical.Items(item_terms, weights)
    best = lexical.Best(np.ones(n_items, np.int64), top)
    dense, scored = np.zeros((n_docs, terms), np.int64), 0
    for lo in range(0, n_docs, 2048):
        ids = np.arange(lo, min(lo + 2048, n_docs))
        doc, term = [], []
        for d in range(len(ids)):
            t = rng.choice(groups[rng.integers(10)], 8, replace=False)
            doc += [d] * 8
            term += t.tolist()
        impact = rng.integers(1, 900_000, len(doc))
        dense[ids[doc], term] = impact
        scored += lexical.search_block(ids, np.array(doc), np.array(term), impact, tree, best)
    for row, i in enumerate(tree.order):
        exact = dense[:, item_terms[i]] @ weights[item_terms[i]]
        want = sorted(zip((-exact).tolist(), range(n_docs)))[:top]
        assert sorted(zip((-best.scores[row]).tolist(), best.ids[row].tolist())) == want
    assert scored < n_docs * n_items / 2


# ------------------------------------------------------------- 12 quality
def test_quality_held_out(spark):
    rows = queries.op12_quality_classifier(spark, SF_CHECK).collect()
    documents = {r["doc_id"]: r for r in common.table(spark, SF_CHECK, "documents").collect()}
    assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(list(documents))
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, SF_CHECK, "labels").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    judged = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, _, q in judged if q], [s for s, _, q in judged if not q]
    assert sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad)) > 0.98
    assert sum(p == q for _, p, q in judged) / len(judged) > 0.95
    # equal texts, equal scores
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[documents[r["doc_id"]]["text"]].add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())


def test_held_out_labels_are_not_read(spark):
    docs, labels = common.table(spark, SF_CHECK, "documents"), common.table(spark, SF_CHECK, "labels")
    hidden = [r["doc_id"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    turned = labels.selectExpr("doc_id", f"if(doc_id in ({','.join(map(str, hidden))}), 1 - quality, quality) as quality")
    scores = lambda y: {(r["doc_id"], round(r["score"], 12)) for r in quality.classify(docs, y).collect()}
    assert scores(labels) == scores(turned)


def test_risk_gradient_and_correction():
    rng = np.random.default_rng(4)
    p, u, w = rng.normal(size=(30, 4)), rng.normal(size=(50, 4)), rng.normal(size=4)
    for prior, scale in ((0.3, 1), (0.9, 1), (0.9, 6)):
        first, second = quality.risk(w * scale, p, u, prior)
        part = (lambda x: sum(quality.risk(x, p, u, prior))) if second >= 0 else (lambda x: -quality.risk(x, p, u, prior)[1])
        slope = [(part(w * scale + d) - part(w * scale - d)) / 2e-6 for d in np.eye(4) * 1e-6]
        assert quality.step_direction(w * scale, p, u, prior) == pytest.approx(np.array(slope), abs=1e-5)


def test_prior_from_positives_and_unlabelled():
    rng = np.random.default_rng(6)
    good = lambda n: rng.normal(2, 1, n)
    for share in (0.3, 0.6, 0.9):
        u = np.concatenate([good(int(8000 * share)), rng.normal(-3, 1, 8000 - int(8000 * share))])
        assert quality.lowest_ratio(good(8000), u) == pytest.approx(share, abs=0.05)


def test_quality_without_zeros_and_edges(spark):
    docs = [(i, "plain words in a row. " * (i % 9 + 1)) for i in range(200)] + [(i, "$$$ ### !! %% " * (i % 9 + 1)) for i in range(200, 400)]
    docs += [(None, "plain words"), (BIG, None), (401, ""), (402, " \n"), (5, "plain again"), (403, "long words here " * 60_000)]
    labels = spark.createDataFrame([(i, 1) for i in range(150)] + [(3, 0), (None, 1), (7, None), (0, 1)], "doc_id long, quality int")
    # doc 3 is labelled both ways: no positive, and no zero either
    rows = quality.classify(docs_of(spark, docs), labels).collect()
    assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(i for i, _ in docs)
    assert all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert min(by[i] for i in range(10, 200)) > max(by[i] for i in range(200, 400))
    assert len({by[BIG], by[401], by[402]}) == 1
    nothing = docs_of(spark, [])
    assert quality.classify(nothing, labels).count() == 0
    assert {r["score"] for r in quality.classify(docs_of(spark, docs[:20]), labels.limit(0)).collect()} == {1.0}


def test_sample_bound_at_any_size():
    for total in (20_001, 10 ** 9, 10 ** 11, 10 ** 14):
        share = (common.hash_bound(6000, total) + (1 << 63)) / (1 << 64)
        assert share * total == pytest.approx(6000, rel=1e-6)


# ------------------------------------------------------------- 13 spelling variants
def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(docs, min_count=5):
    counts = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 6
    n = {w: k for w, k in counts.items() if k >= min_count}
    index = collections.defaultdict(set)  # words by themselves with one code point left out, and whole
    for w in n:
        for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            index[k].add(w)
    out = {}
    for w in n:
        others = {v for k in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} for v in index[k] if near(w, v)}
        best = min(others, key=lambda v: (-n[v], v), default=None)
        out[w] = [best if best and n[best] >= 5 * n[w] else None, n[w], len(others)]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row += [root, n.get(row[0])]
    return {(w, f, root, k, m, fn) for w, (f, k, m, root, fn) in out.items()}


def got_variants(df):
    rows = df.collect()
    out = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_of_the_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in common.table(spark, SF_CHECK, "documents").collect()]
    want = plain_variants(docs)
    assert got_variants(queries.op13_spelling_variants(spark, SF_CHECK)) == want
    assert any(f for _, f, *_ in want) and any(m > 1 for *_, m, _ in want)


def test_variants_edges(spark):
    chain = [("abcdefg", 5), ("abcdefgh", 25), ("abcdefghi", 125), ("abcdefghij", 625), ("xbcdefg", 5)]
    docs = [(i, " ".join([w] * k)) for i, (w, k) in enumerate(chain)]
    docs += [(None, "ÀÉîøû1Straßen straßEn STRAßEN straßen straßen straßem" + " straßem" * 5), (BIG, None), (91, ""), (92, "short words onlyy")]
    docs += [(93, "Ωmega日本語wörter " * 30_000 + "wörters " * 9), (94, "repeat " * 3)] + [(94, "repeat")] * 4
    assert got_variants(spelling.spelling_variants(docs_of(spark, docs))) == plain_variants(docs)
    assert spelling.spelling_variants(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("list_rows", [4096, 12, 2])
def test_near_words_however_lists_are_split(spark, list_rows):
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(6, 8))) for _ in range(500)} | {"tests" * 2000, "tests" * 2000 + "a"})
    n = {w: rng.randint(5, 60) for w in words}
    got = {tuple(r) for r in spelling.near_words(spark.createDataFrame(list(n.items()), "word string, n long"), list_rows=list_rows).collect()}
    want = set()
    for a in words:
        others = [b for b in words if near(a, b)]
        if others:
            best = min(others, key=lambda v: (-n[v], v))
            want.add((a, len(others), n[best], best))
    assert got == want
