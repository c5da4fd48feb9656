"""Positional index, BagMinHash and NN-descent against brute force; the pipeline stage by stage."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanledger.llm import bag_minhash, byte_bpe, neighbours, positional_index, quality, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows_of(text, size):
    w = words_of(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def hits_of(text, items, size):
    """Words inside windows of the items, and the items that occur."""
    w = words_of(text)
    hit, found = set(), set()
    for item, held in items.items():
        for p in held:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    found.add(item)
    return len(w), len(hit), found


@pytest.fixture(scope="module")
def small_corpus():
    draw = random.Random(5)
    texts = [" ".join(draw.choice("a b c d É") for _ in range(n)) for n in (0, 1, 2, 3, 8, 40, 200, 200, 900)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[5]), (3, texts[5]), (None, texts[6]), (90, None), (91, "A, B! c. D a-b")]
    items = [(1, "a b c a"), (2, "d"), (3, ""), (4, None), (10, " ".join(draw.choice("abcd") for _ in range(9))), (5, "a b c a"), (6, "É b zz")]
    return docs, items


def test_contamination_against_brute_force(spark, small_corpus):
    docs, items = small_corpus
    held = {i: windows_of(t, 4) for i, t in items}
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).withColumn("term", F.lit("clash"))
    marks = spark.createDataFrame([*items, items[0]], "item_id bigint, text string")
    got = positional_index.contaminated_documents(df, marks, F.col("doc_id"), 4).collect()
    want = []
    for i, t in docs:
        n, hit, found = hits_of(t, held, 4)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want.append((i, n, hit, len(found), digest, hit > 0))
    rows = [(r.key and int(r.key), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got]
    assert sorted(rows, key=str) == sorted(want, key=str)
    kept = positional_index.clean(df, marks, 4)
    assert kept.columns == df.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted([d for d, w in zip(docs, want, strict=True) if not w[5]], key=str)


def test_phrases_and_proximity(spark, small_corpus):
    docs, _ = small_corpus
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    index = positional_index.build(df, F.col("doc_id"))
    phrases = [(1, ["a", "b"]), (2, ["c"]), (3, ["a", "a", "d"]), (4, ["zz", "a"])]
    asked = spark.createDataFrame(phrases, "phrase_id bigint, phrase array<string>")
    for slop in (0, 2):
        want = []
        for i, t in docs:
            w = words_of(t)
            for k, p in phrases:
                for a, x in enumerate(w):
                    at = a if x == p[0] else None
                    for q in p[1:]:
                        at = next((b for b in range(at + 1, len(w)) if w[b] == q), None) if at is not None else None
                    if at is not None and at - a - len(p) + 1 <= slop:
                        want.append((k, i, a, at))
        got = [(r.phrase_id, r.key and int(r.key), r.first_word, r.last_word) for r in positional_index.matches(index, asked, slop).collect()]
        assert Counter(got) == Counter(want)


def test_empty_tables_have_no_hits(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    (row,) = positional_index.contaminated_documents(docs, items, F.col("doc_id")).collect()
    assert (row.n_words, row.n_hit, row.items_sha256) == (3, 0, hashlib.sha256(b"").hexdigest())
    assert positional_index.contaminated_documents(docs.limit(0), items, F.col("doc_id")).count() == 0


def shingles_of(text):
    w = words_of(text)
    return Counter(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else Counter()


def similar(a, b):
    less = sum((a & b).values())
    return less / (sum(a.values()) + sum(b.values()) - less) if less else 0.0


def classes_of(rows):
    """Least member index of each row's class: equal texts, and similarity chains."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [shingles_of(t) for t in rows]
    held = defaultdict(set)
    for i, b in enumerate(bags):
        for s in b:
            held[s].add(i)
    for i, t in enumerate(rows):
        for j in {j for s in bags[i] for j in held[s] if j < i} | {j for j in range(i) if (rows[j] or "") == (t or "")}:
            if (rows[j] or "") == (t or "") or similar(bags[i], bags[j]) >= bag_minhash.SIMILAR:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(rows))]


def partition(keys):
    groups = defaultdict(list)
    for k, i in keys:
        groups[k].append(i)
    return sorted((sorted(g, key=str) for g in groups.values()), key=str)


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(2)
    runs = draw.integers(1, 2**63, 60).astype(np.uint64)
    a, b = draw.integers(0, 40, 60), draw.integers(0, 40, 60)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    same = []
    for k in range(30):
        x = bag_minhash.mix(runs + np.uint64(k))
        marks = [bag_minhash.signatures(np.zeros((c > 0).sum(), int), x[c > 0], c[c > 0], 1)[0] for c in (a, b)]
        same.append((marks[0] == marks[1]).mean())
    assert abs(np.mean(same) - want) < 4 * (want * (1 - want) / (30 * bag_minhash.SLOTS)) ** 0.5
    assert (marks[0] != 0).all()


def test_near_duplicates_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    base = words_of(rows[3][1])[:200]
    draw = random.Random(9)
    for k in range(80):  # a large group of near copies
        copy = list(base)
        copy[draw.randrange(len(copy))] = f"new{k}"
        rows.append((5000 + k, " ".join(copy)))
    rows += [(7000, "Te " * 300), (7001, "Te " * 290), (7002, "Te " * 200), (7003, None), (7004, ""), (7005, "one two"), (7006, "One two!"), (7007, "one")]
    rows += [(7008, "?!"), (7009, "?!"), (7010, "!?"), (None, "alone and without an id"), (7011, "x " + "y" * 200_000), (rows[9][0], rows[9][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).withColumn("digest", F.lit(1)).withColumn("_d", F.lit(1))
    got = bag_minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = classes_of([t for _, t in rows])
    assert partition((r.class_digest, r.doc_id) for r in got) == partition((c, i) for c, (i, _) in zip(want, rows, strict=True))
    least = defaultdict(list)
    for c, (i, _) in zip(want, rows, strict=True):
        least[c].append(i)
    names = {i: min((x for x in g if x is not None), default=None) for g in least.values() for i in g}
    assert all(r.class_id == names[r.doc_id] for r in got)
    kept = bag_minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([min(g, key=lambda x: (x is None, x)) for g in least.values()], key=str)


def test_near_duplicates_of_a_large_group_around_the_threshold(spark):
    draw = np.random.default_rng(3)
    size, base = 2500, [f"w{k}" for k in range(300)]
    texts, ids = [], {}
    for i in range(size):
        copy = list(base)
        for j, k in enumerate(draw.choice(300, draw.integers(4, 6), replace=False)):
            copy[k] = f"x{i}n{j}"
        texts.append(" ".join(copy))
    runs = [[ids.setdefault(r, len(ids)) for r in shingles_of(t)] for t in texts]  # no run occurs twice in a text
    counts = Counter(r for x in runs for r in x)
    common = {r: k for k, r in enumerate(r for r in counts if counts[r] > 1)}
    held = np.zeros((size, len(common)), np.float32)
    for i, x in enumerate(runs):
        held[i, [common[r] for r in x if r in common]] = 1
    less, n = held @ held.T, np.array([len(x) for x in runs])
    near = less / (n[:, None] + n - less) >= bag_minhash.SIMILAR
    least = np.arange(size)
    while True:
        new = np.where(near, least, size).min(1)
        if (new == least).all():
            break
        least = new
    assert 20 < len(set(least.tolist())) < size - 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    got = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(docs).collect()}
    wrong = sum(got[i] != c for i, c in enumerate(least.tolist()))
    assert wrong == 0, f"{wrong} of {size} texts are in another class"


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(bag_minhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


def test_dedup_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bag_minhash.near_duplicates(docs).count() == 0 and bag_minhash.deduplicate(docs).count() == 0


def test_neighbours_recall_and_scores(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet' ORDER BY 1").fetchall()
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = [r[0] for r in rows]
    got = defaultdict(list)
    for r in queries.op8_nn_descent(spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for i, q in enumerate(ids):
        if q % 50 == 0:
            best = sorted(((-float(x[i] @ x[j]), ids[j]) for j in range(len(ids)) if j != i))[:5]
            hits += len({v for v, _ in got[q]} & {v for _, v in best})
            assert len(got[q]) == 5 and got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
            for v, s in got[q]:
                assert s == pytest.approx(float(x[i] @ x[ids.index(v)]), abs=1e-12)
    assert hits >= 0.9 * 5 * len(got) and len(got) == sum(q % 50 == 0 for q in ids)


@pytest.mark.parametrize("noise", [1e-2, 1e-3])
def test_neighbours_within_a_tight_group(spark, noise):
    draw = np.random.default_rng(8)
    centre = draw.standard_normal(64)
    x = centre + noise * np.abs(centre).max() * draw.standard_normal((3000, 64))
    x = x.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>").repartition(8)
    got = defaultdict(set)
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got[r.query_id].add(r.vec_id)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    # Differences of units keep the digits that cosines near 1 would lose.
    hits = 0
    for q in range(0, 3000, 50):
        far = ((unit - unit[q]) ** 2).sum(1)
        far[q] = np.inf
        hits += len(got[q] & set(np.argsort(far)[:5].tolist()))
    assert hits >= 0.9 * 5 * 60, hits


def test_neighbours_with_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0, float(i % 2)]) for i in range(30)] + [(50, [0.0, 1.0, 0.0]), (100, [0.0, 1.0, 0.1]), (100, [0.0, 1.0, 0.1])]
    rows += [(150, None), (200, [0.0, 0.0, 0.0]), (250, [1.0, None, 0.0]), (300, [1.0, float("nan"), 0.0]), (350, [float("inf"), 0.0, 1.0]), (400, [1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("node", F.lit(0))
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 6)))
    assert set(got) == {0, 50, 100}
    assert got[0] == [(k + 1, 2 * (k + 1), 1.0) for k in range(5)]
    assert got[50][0][1] == 100 and got[100][0][1] == 50 and len(got[50]) == 5
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert [r.vec_id for r in neighbours.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [1, 2]
    assert neighbours.nearest(few.limit(0), F.col("vec_id") == 0).count() == 0


def test_pipeline_stages_against_brute_force(spark):
    docs = queries.documents(spark, SF)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "language", "near_duplicates", "decontamination", "byte_bpe"]
    model = queries.quality_model(spark, SF, docs)
    text = dict(docs.select("doc_id", "text").collect())

    out = stages["quality"](spark, docs, SF)
    good = {r.doc_id for r in docs.select("doc_id", model.score(F.col("text")).alias("s")).collect() if r.s >= quality.THRESHOLD}
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == good and 0 < len(good) < len(text)

    out = stages["language"](spark, out, SF)
    ids = sorted(i for i in good if any(c.isalpha() for c in text[i]))
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == ids

    out = stages["near_duplicates"](spark, out, SF)
    found = classes_of([text[i] for i in ids])
    ids = sorted({ids[c] for c in found})
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == ids

    out = stages["decontamination"](spark, out, SF)
    held = {r.item_id: windows_of(r.text, 10) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    every = {p for x in held.values() for p in x}
    size = {len(p) for p in every}
    clean = [i for i in ids if not any(tuple(w[k : k + n]) in every for w in [words_of(text[i])] for n in size for k in range(len(w) - n + 1))]
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == clean and len(clean) < len(ids)

    last = {r.doc_id: r for r in stages["byte_bpe"](spark, out, SF).collect()}
    assert sorted(last) == clean
    assert all(r.decoded_sha256 == hashlib.sha256(text[i].encode()).hexdigest() for i, r in last.items())
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in last.values()}
    ids_of = byte_bpe.encode_column(pa.array([text[clean[0]]]), *_tokenizer())[0]
    assert last[clean[0]].ids_sha256 == hashlib.sha256(",".join(map(str, ids_of.tolist())).encode()).hexdigest()


def _tokenizer():
    import public_tokenizers

    return public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN


def test_stages_with_rows_of_every_kind(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "the the and of", None, "s", 14), (2, "the the and of", None, "s", 14)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("_digest", F.lit(1))
    for frame in (docs, docs.limit(0)):
        at = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, SF)
            assert at.columns == docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, at, SF).count() == at.count() <= frame.count()


def test_every_query_runs_and_keeps_its_columns(spark):
    columns = {
        "op1": ["doc_id", "path", "licence", "score", "how", "licensed_by"],
        "op2": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op3": ["page_id", "url", "text", "n_chars"],
        "op4": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op5": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op6": ["doc_id", "class_id", "class_rows", "stays"],
        "op7": ["doc_id", "held_out", "score", "predicted"],
        "op8": ["query_id", "rank", "vec_id", "score"],
        "op9": ["doc_id", "held_out", "lang_pred", "score"],
    }
    for name, query in queries.QUERIES.items():
        df = query(spark, SF)
        assert df.count() > 0
        if name.split("_")[0] in columns:
            assert df.columns == columns[name.split("_")[0]]


def test_decontamination_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(f"SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({queries.ORACLES['op2_positional_index']})").fetchall()
    assert sorted(map(tuple, queries.op2_positional_index(spark, SF).collect())) == sorted(want)
