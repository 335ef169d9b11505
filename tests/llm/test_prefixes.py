"""The prefix trie against a trie built by loops, in one block and in many."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import prefixes
from ledgerlark.llm.common import remainder

TURNS = "conv_id bigint, turn bigint, role string, text string, marks string, key string"
LONG = " ".join(f"w{i}" for i in range(50_000))


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def sequences(rows):
    """conv_id to its ordered (digest, words) turns."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            words = len([w for w in text.encode().split()])
            out.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), words))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def opened(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = seqs.get(first, [])[:h] + own[h:]
    return out


def trie(seqs):
    """The nodes as the operator's rows, from sets of members."""
    members = {}
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    rows = []
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        parents = {n[:-1] for n in members if n}
        ends = sorted(c for c in who if len(seqs[c]) == len(node))
        rows.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
            sum(len(n) == len(node) + 1 for n in below), sum(n not in parents for n in below),
            sum((len(members[n]) - 1) * n[-1][1] for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(7)
    out = []
    for c in range(0, 90):
        for t in range(r.randrange(0, 6)):
            out.append((c, t, r.choice(["user", "assistant", None]), r.choice(["a", "a b", "c  d\te", "", None])))
    out += [(200 + i, t, "user", f"same {t}") for i in range(120) for t in range(3)]  # more than half are copies
    out += [(500, 1, "user", "tie"), (500, 1, "user", "other"), (500, None, "user", "first"), (500, 1, "user", "tie")]
    out += [(501, 0, "user", LONG), (502, 0, "user", LONG), (502, 1, "user", "x"), (None, 0, "user", "nobody"), (-25, 0, "ab", "c"), (-24, 0, "a", "bc")]
    out += [(600, t, "user", "again") for t in range(60)]
    return [(*x, "clash", "clash") for x in out]


@pytest.fixture(scope="module")
def turns(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("turns") / "t")
    spark.createDataFrame(rows, TURNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("cells", [250_000, 40, 3])
def test_trie(turns, rows, monkeypatch, cells):
    monkeypatch.setattr(prefixes, "BLOCK_CELLS", cells)  # 3: a prefix runs through many blocks
    monkeypatch.setattr(prefixes, "IDS_A_PIECE", 7)
    got = prefixes.prefix_trie(prefixes.turn_marks(turns)).collect()
    assert sorted(map(tuple, got), key=str) == trie(sequences(rows))


def test_shared_openings(turns, rows):
    marked = prefixes.shared_openings(prefixes.turn_marks(turns), 20, remainder(F.col("conv_id"), 4), 3)
    got = {r["conv_id"]: [tuple(m) for m in r["marks"]] for r in marked.collect()}
    assert got == opened(sequences(rows))
    assert any(not m for m in got.values())  # a conversation left without turns
    found = prefixes.prefix_trie(marked).collect()
    assert sorted(map(tuple, found), key=str) == trie(opened(sequences(rows)))


def test_no_conversations(spark, turns):
    for none in (turns.filter("false"), turns.filter("conv_id IS NULL")):
        assert prefixes.prefix_trie(prefixes.turn_marks(none)).collect() == []


def test_one_conversation_without_turns(spark):
    marked = spark.createDataFrame([(5, [])], f"conv_id bigint, marks {prefixes.MARKS}")
    ends = hashlib.sha256(b"5").hexdigest()
    assert list(map(tuple, prefixes.prefix_trie(marked).collect())) == [(5, 0, None, 1, 0, 1, 0, ends)]


def test_sparse_table():
    r = np.random.default_rng(1)
    values = r.integers(0, 5, 70)
    table = prefixes.SparseTable(values)
    begin = r.integers(0, 70, 200)
    end = np.minimum(begin + r.integers(0, 70, 200), 69)
    assert table.least(begin, end).tolist() == [values[a : b + 1].min() for a, b in zip(begin, end)]
    start, floor = r.integers(0, 71, 200), r.integers(0, 6, 200)
    ahead, back = table.reach(start, floor, True), table.reach(start, floor, False)
    for s, f, a, b in zip(start, floor, ahead, back):
        assert (values[s:a] >= f).all() and (a == 70 or values[a] < f)
        assert (values[b:s] >= f).all() and (b == 0 or values[b - 1] < f)
    assert prefixes.SparseTable(np.empty(0, int)).reach(np.array([0]), np.array([1]), True).tolist() == [0]
