"""Packing: the search against the least number of sequences, and every piece against the tokenizer."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from spanledger.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def least(lengths, capacity):
    """The least number of bins by all subsets."""
    n = len(lengths)
    best = {0: (0, capacity)}  # done items: bins closed or open, filled
    for done in range(1 << n):
        bins, filled = best[done]
        for i in range(n):
            if not done >> i & 1:
                nxt = (bins, filled + lengths[i]) if filled + lengths[i] <= capacity else (bins + 1, lengths[i])
                key = done | 1 << i
                best[key] = min(best.get(key, (99, 0)), nxt)
    return best[(1 << n) - 1][0]


def check_plan(plan, counts, capacity):
    placed = Counter()
    for filling, copies in plan:
        assert copies > 0 and 0 < sum(n * k for n, k in filling) <= capacity
        for n, k in filling:
            placed[n] += k * copies
    assert placed == Counter({n: c for n, c in counts.items() if c})


@pytest.mark.parametrize("seed", range(60))
def test_search_finds_the_least_number(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 33, 100])
    lengths = [rng.randint(1 if seed % 3 else capacity // 4, capacity * 3 // 4) for _ in range(rng.randint(1, 11))]
    counts = Counter(lengths)
    plan, bound = packing.bin_completion(counts, capacity)
    check_plan(plan, counts, capacity)
    size = sum(c for _, c in plan)
    assert size == least(lengths, capacity) == bound
    assert packing.lower_bound(counts, capacity) <= size


def test_search_beats_best_fit():
    counts = {6: 2, 5: 1, 4: 1, 3: 3, 2: 1}  # best fit decreasing needs one more of capacity 10
    for lengths, capacity in (([6, 6, 5, 4, 3, 3, 3], 15), ([7, 6, 6, 4, 4, 3], 15), ([49, 41, 34, 33, 29, 26, 26, 22, 20, 19], 100)):
        counts = Counter(lengths)
        assert sum(c for _, c in packing.bin_completion(counts, capacity)[0]) == least(lengths, capacity)


def test_large_counts_and_hostile_histograms():
    rng = np.random.default_rng(5)
    for counts in ({4096: 10**9, 1: 3}, {1366: 10**6 + 1}, {2049: 5, 2047: 5, 1: 10}, dict(enumerate(rng.integers(0, 10**6, 4096).tolist(), 1)), {}):
        plan, bound = packing.bin_completion(counts, 4096)
        check_plan(plan, counts, 4096)
        size = sum(c for _, c in plan)
        assert bound <= size <= bound + max(1, bound // 1_000)


TEXTS = [
    None, "", " ", "Hello, World's end!  don't 'tis 's 12a3 x-'s ''t", "İstanbul ΑΣ ß ﬁ ﬀ éa̸ ≮ a≮", "<|endoftext|> a<|startoftext|>b", "　x y\x1cz\u0085w",
    "哈哈 一二三", "🙂🙂‍🙂 ok", "été d'été l'été", "a" * 3000, "x1y2 ½ Ⅷ ²", "'S 'Ll 've're'm'd'x", "no.1,2;(three)'four'", "Å Ω ẛ̣",
]


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(3)
    marks = "ab'S t.,-<>12é̸́ͅİΣ \n"
    texts = TEXTS + ["".join(rng.choices(marks, k=rng.randint(1, 40))) for _ in range(3000)]
    ids, bounds = packing.encode_column(pa.array(texts), PATH)
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def check_pieces(rows, texts, tokenizer, capacity):
    """Every piece against the tokenizer, and the sequences gapless and within the capacity."""
    held, per_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
        per_doc[r.doc_id].append(r)
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    expected = Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k : k + capacity], "<u4")
            expected[doc, k // capacity, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert expected == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    return len(held)


def test_pack_rows(spark, tokenizer):
    texts = list(enumerate(TEXTS)) * 2 + [(None, "x"), (99, "word " * 70 + "end")]
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in texts], "doc_id bigint, text string, part int, key int").repartition(5)
    packed = packing.pack(df, PATH, capacity=64)
    rows = packed.collect()
    used = check_pieces(rows, texts, tokenizer, 64)
    assert used == -(-sum(r.length for r in rows) // 64)
    assert {r.sequence_id: len(r.ids) for r in packing.sequences(packed).collect()} == {
        s: sum(r.length for r in rows if r.sequence_id == s) for s in {r.sequence_id for r in rows}
    }
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(empty, PATH).count() == 0


def test_query_over_documents(spark, tokenizer):
    from spanledger.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = queries.op13_best_fit_packing(spark, sf).collect()
    texts = [(r.doc_id, r.text) for r in queries.documents(spark, sf).collect()]
    used = check_pieces(rows, texts, tokenizer, 4096)
    assert used == packing.lower_bound(Counter(r.length for r in rows), 4096)
