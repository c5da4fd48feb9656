"""Repair of conversations against a search over all edits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from spanledger.llm import conversations

LEGAL = re.compile(r"(s?(ua)+)?\Z")
ENDED = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")
FULL = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """First fault of each row of (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        fault = "blank" if not FULL.search(text) else "duplicate" if (role, text) in seen else "" if ENDED.search(text) else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def all_edits(rows):
    """Least (cost, audit) and its rows, by trying everything: at most two insertions in each gap."""
    best = None
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    choices = [[("D", None), ("K", None), ("R", "user"), ("R", "assistant")] if f in ("", "truncated") else [("D", None)] for f in faults(rows)]
    bad = [f == "truncated" for f in faults(rows)]
    for puts in itertools.product(gaps, repeat=len(rows) + 1):
        for ops in itertools.product(*choices):
            cost, audit, kept = 0, "", []
            for put, op, row, cut in itertools.zip_longest(puts, ops, rows, bad):
                cost += 3 * len(put)
                audit += "I" * len(put)
                kept += [(p, "") for p in put]
                if op:
                    audit += op[0]
                    cost += {"D": 4, "K": 0, "R": 3}[op[0]] + (3 if cut and op[0] != "D" else 0)
                    kept += [] if op[0] == "D" else [(op[1] or row[1], row[2])]
            if LEGAL.match("".join(r[:1] or "?" for r, _ in kept)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, kept
    return best


def from_the_end(rows):
    """Least (cost, audit) and its rows, from the last row back, comparing strings."""
    fault = faults(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", []), "a": (0, "", [])}

    def put_in(b):
        for _ in range(2):
            for s, role in (("", "user"), ("s", "user"), ("u", "assistant"), ("a", "user")):
                if after[s] in b:
                    c, audit, kept = b[after[s]]
                    option = (c + 3, "I" + audit, [(role, ""), *kept])
                    if s not in b or option[:2] < b[s][:2]:
                        b = b | {s: option}
        return b

    best = put_in(best)
    for (_, role, text), f in zip(reversed(rows), reversed(fault), strict=True):
        now = {}
        for s in ("", "s", "u", "a"):
            options = []
            if s in best:
                c, audit, kept = best[s]
                options.append((c + 4, "D" + audit, kept))
            if f not in ("blank", "duplicate"):
                more = 3 if f else 0
                i = role[:1]
                if (i == after[s] or (i == "s" and s == "")) and i in best:
                    c, audit, kept = best[i]
                    options.append((c + more, "K" + audit, [(role, text), *kept]))
                if after[s] in best:
                    c, audit, kept = best[after[s]]
                    options.append((c + 3 + more, "R" + audit, [({"u": "user", "a": "assistant"}[after[s]], text), *kept]))
            if options:
                now[s] = min(options, key=lambda o: o[:2])
        best = put_in(now)
    return best[""]


def summary(rows, solve=from_the_end):
    """The result columns of one conversation of damaged (turn, role, text) rows in their order."""
    turns = {t for t, _, _ in rows if t is not None}
    fault = faults(rows)
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, kept = solve(rows)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit, digest,
    )


def ordered(rows):
    def place(row):
        turn, role, text = row
        return turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()

    return sorted(rows, key=place)


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", ""]
    return ordered((rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(["a.", "b", "c!", " ", "", "d? \n", "e.", "f"])) for _ in range(n))


@pytest.mark.parametrize("seed", range(12))
def test_two_searches_agree(seed):
    rng = random.Random(seed)
    rows = random_rows(rng, rng.randint(0, 3))
    assert all_edits(rows)[:2] == from_the_end(rows)[:2]
    assert all_edits(rows)[2] == from_the_end(rows)[2]


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(df):
    counts, blocks = conversations.repair(df)
    out = conversations.with_every_key(df, counts, conversations.digests(blocks))
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in out.collect()}


@pytest.mark.parametrize("block", [2, 256])
def test_rows_equal_the_search(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = random.Random(7)
    by_conv = {c: random_rows(rng, rng.choice([0, 1, 2, 3, 5, 8, 30])) for c in [None, *range(60)]}
    by_conv[61] = ordered([(1, "user", "x.")] * 40 + [(1, "assistant", "y")] * 3 + [(2, "system", " ")] * 5)
    data = [(c, t, r, x, "e", c, 0) for c, rows in by_conv.items() for t, r, x in rows]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string, digest string, conv bigint, part int")
    assert repaired(df.repartition(4)) == {c: summary(rows) for c, rows in by_conv.items() if rows}


def test_one_conversation_of_many_blocks(spark):
    rng = random.Random(1)
    rows = ordered((i // 2, rng.choice(["user", "assistant", "assistant", "system"]), f"{rng.randrange(3000)}{rng.choice('.!x')}") for i in range(4000))
    df = spark.createDataFrame([("c", *r) for r in rows] + [("d", 0, "user", "q."), ("d", 1, "assistant", "a.")], "conv_id string, turn int, role string, text string")
    assert repaired(df.repartition(6)) == {"c": summary(rows), "d": summary([(0, "user", "q."), (1, "assistant", "a.")])}


def test_nulls_and_empty(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert repaired(spark.createDataFrame([], schema)) == {}
    df = spark.createDataFrame([(1, None, None, "x."), (1, None, "user", None), (2, None, None, None)], schema)
    assert repaired(df) == {1: summary(ordered([(None, " ", "x."), (None, "user", " ")])), 2: summary([(None, " ", " ")])}


def test_query_over_conversations(spark):
    from spanledger.llm import queries

    sf = "/root/testdata/sf0.01"
    by_conv, keys = defaultdict(list), set()
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        keys.add(r.conv_id)
        code = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        text, role = " " if r.text is None else r.text, " " if r.role is None else r.role
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        by_conv[r.conv_id] += [(r.turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_conversation_repair(spark, sf).collect()}
    assert got == {c: summary(ordered(by_conv[c])) for c in keys}
