"""Periodic runs against a quadratic search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from spanledger.llm import runs


def slow_runs(w, least):
    """Every maximal stretch of every period; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            b = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - b >= max(least, 2 * q):
                found.setdefault((b, i + q), q)
    return sorted(((b, e - b, q) for (b, e), q in found.items()), key=lambda r: (r[0], r[2]))


def fast(texts, least):
    ids = np.array([x for t in texts for x in t], np.int32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    out = [[] for _ in texts]
    for t, *run in runs.periodic_runs(ids, bounds, least).tolist():
        out[t].append(tuple(run))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_the_slow_search(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(30):
        t = [rng.randrange(rng.choice([1, 2, 3, 5, 50])) for _ in range(rng.choice([0, 1, 5, 11, 12, 13, 40, 120]))]
        if t and rng.random() < 0.6:
            a, p = rng.randrange(len(t)), rng.randint(1, max(1, len(t) // 3))
            t = [t[i] if i < a else t[a + (i - a) % p] if a + (i - a) % p < len(t) else t[i] for i in range(len(t))]
        if rng.random() < 0.3:
            t = t * rng.randint(1, 4)
        texts.append(t)
    least = rng.choice([2, 3, 12, 12, 12, 20])
    assert fast(texts, least) == [slow_runs(t, least) for t in texts]


def test_known_runs():
    assert fast([[1] * 12, [1] * 11, list(range(6)) * 2, list(range(5)) * 2, [9, *list(range(7)) * 3, 9]], 12) == [
        [(0, 12, 1)], [], [(0, 12, 6)], [], [(1, 21, 7)]
    ]
    fibonacci = [0]
    other = [0, 1]
    while len(other) < 1500:
        fibonacci, other = other, other + fibonacci
    assert fast([other], 12)[0] == slow_runs(other, 12)


def test_long_runs_end_soon():
    text = [*range(1000), *[1] * 300_000, *range(500), *([5, 6, 7] * 50_000)]
    assert fast([text], 12)[0] == [(1000, 300_000, 1), (301_500, 150_000, 3)]


TEXTS = [None, "", " \n\t ", "a", "one  two\tone two one two one two one two one two x", "ab " * 40, "x y z w " * 3 + "q", "é\x0bé\x1cé　é " * 12]


def row(text, least=12):
    """Words, runs and collapsed text of one text."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = slow_runs(w, least)
    drop = {i for b, n, q in found for i in range(b + q, b + n)}
    return len(w), found, " ".join(x for i, x in enumerate(w) if i not in drop)


def test_find_rows(spark):
    rows = [(i, t, "r") for i, t in enumerate(TEXTS)] * 2 + [(None, "b c " * 9, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string").repartition(3)
    got = sorted((r.doc_id or -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find(df).collect())
    assert got == sorted((d or -1, *row(t)) for d, t, _ in rows)
    assert runs.find(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def damaged(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def expected(doc_id, text):
    w = damaged(doc_id, text)
    _, found, collapsed = row(" ".join(w))
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = hashlib.sha256("".join(f"{b},{n},{q}\n" for b, n, q in found).encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, digest, hashlib.sha256(collapsed.encode()).hexdigest())


def test_query_over_documents(spark):
    from spanledger.llm import queries

    sf = "/root/testdata/sf0.001"
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {tuple(r) for r in queries.op12_periodic_runs(spark, sf).select(columns).collect()}
    rows = queries.documents(spark, sf).collect()
    want = {expected(r.doc_id, r.text) for r in rows if len(r.text or "") < 12_000}
    assert len(got) == len(rows) and want <= got
    assert any(r[1] for r in want)
