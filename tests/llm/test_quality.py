"""The quality field against enumeration and loops, and on held-out labels."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import quality
from ledgerlark.llm.common import is_remainder

DOC = "doc_id bigint, text string, score string, good string, place string"
LABEL = "doc_id bigint, quality int, text string"


def field(seed=0):
    r = np.random.default_rng(seed)
    f = quality.Field(0.7)
    f.w = r.normal(size=f.w.shape) * 0.3
    f.bias, f.move, f.begin = r.normal(size=1), r.normal(size=(2, 2)), r.normal(size=2)
    return f


def margins_by_loop(f, x):
    out = []
    for i in range(len(x)):
        m = f.bias[0] + x[i] @ f.w[:, 0]
        if i:
            m += x[i - 1] @ f.w[:, 1]
        if i + 1 < len(x):
            m += x[i + 1] @ f.w[:, 2]
        out.append(m)
    return out


def weight(f, margins, labels):
    total = f.begin[labels[0]] + sum(m * y for m, y in zip(margins, labels))
    return math.exp(total + sum(f.move[a, b] for a, b in zip(labels, labels[1:])))


def enumerated(f, x):
    margins = margins_by_loop(f, x)
    ways = {y: weight(f, margins, y) for y in itertools.product((0, 1), repeat=len(x))}
    whole = sum(ways.values())
    return [sum(w for y, w in ways.items() if y[i]) / whole for i in range(len(x))], ways, whole


def chain_by_loop(f, x):
    """Forward and backward sums, line by line, in logarithms."""
    e = margins_by_loop(f, x)
    plus = lambda a, b: np.logaddexp(a, b)
    alpha = [[f.begin[0], f.begin[1] + e[0]]]
    for m in e[1:]:
        a = alpha[-1]
        alpha.append([plus(a[0] + f.move[0, 0], a[1] + f.move[1, 0]), plus(a[0] + f.move[0, 1], a[1] + f.move[1, 1]) + m])
    beta = [[0.0, 0.0]]
    for m in e[:0:-1]:
        b = beta[0]
        beta.insert(0, [plus(f.move[i, 0] + b[0], f.move[i, 1] + m + b[1]) for i in (0, 1)])
    return [1 / (1 + math.exp(a[0] + b[0] - a[1] - b[1])) for a, b in zip(alpha, beta)]


@pytest.fixture(scope="module")
def lines():
    r = np.random.default_rng(4)
    sizes = [1, 3, 0, 5, 2, 0, 4]
    return (r.random((sum(sizes), quality.WIDTH)) < 0.2).astype(np.float32), np.cumsum([0, *sizes])


def test_marginals_are_sums_over_all_labellings(lines):
    f, (x, starts) = field(), lines
    got = f.marginals(x, starts)[0]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            assert got[a:b] == pytest.approx(enumerated(f, x[a:b])[0], abs=1e-5)


def test_slopes_are_those_of_the_likelihood(lines):
    f, (x, starts) = field(), lines
    y = np.array([0, 1, 1, 0, 0, 0, 1, 1, 1, 0, 1, 0, 0, 1, 1], float)

    def likelihood():
        total = 0
        for a, b in zip(starts, starts[1:]):
            if b > a:
                _, ways, whole = enumerated(f, x[a:b])
                total += math.log(ways[tuple(y[a:b].astype(int))] / whole)
        return total / len(x)

    filled = np.array([s for s, t in zip(starts, starts[1:]) if t > s] + [starts[-1]])
    slopes = f.slopes(x, filled, y)
    for part, slope in zip(f.parts(), slopes):
        flat, given = part.reshape(-1), np.asarray(slope).reshape(-1)
        for i in range(0, len(flat), max(1, len(flat) // 12)):
            kept = flat[i]
            flat[i] = kept + 1e-4
            up = likelihood()
            flat[i] = kept - 1e-4
            down = likelihood()
            flat[i] = kept
            assert given[i] == pytest.approx((up - down) / 2e-4, abs=2e-5)


def test_measures():
    lines = [b"AB cd cd, 12!", "É | é | x".encode(), b"a b c a b c", b"#$ #$", b"z" * 5]
    copies = [1, 1, 1, 1, 4]
    got = quality.Measurer().steps(lines, copies)
    want = []
    for line, n in zip(lines, copies):
        words = line.lower().split()
        signs = [c for c in line if chr(c) not in " "]
        letters = [c for c in line if chr(c).isascii() and chr(c).isalpha()]
        triples = list(zip(words, words[1:], words[2:]))
        one = lambda v: max(v, 1)
        each = {
            "words": len(words), "bytes a word": len(signs) / one(len(words)),
            "capitals among letters": sum(chr(c).isupper() for c in letters) / one(len(letters)),
            "symbols among signs": sum(c in quality.SYMBOLS for c in line) / one(len(signs)),
            "digits among signs": sum(48 <= c < 58 for c in line) / one(len(signs)),
            "bars a word": line.count(b"|") / one(len(words)), "exclamations a word": line.count(b"!") / one(len(words)),
            "stops a word": sum(c in quality.STOPS for c in line) / one(len(words)),
            "words like the one before": sum(a == b for a, b in zip(words, words[1:])) / one(len(words)),
            "repeated words": (len(words) - len(set(words))) / one(len(words)),
            "repeated word triples": (len(triples) - len(set(triples))) / one(len(words) - 2),
            "lines like it in the text": n,
        }
        want.append([int(each[m] >= s) for m, steps in quality.STEPS.items() for s in steps])
    assert got.tolist() == want


def test_long_lines_are_counted_in_slices(monkeypatch):
    r = random.Random(2)
    lines = [" ".join(r.choice(["ab", "CD", "e!", "9", "#"]) for _ in range(n)).encode() for n in (3, 400, 1, 50)]
    whole = quality.Measurer().counts(lines).tolist()
    monkeypatch.setattr(quality, "EVERY", 37)
    assert quality.Measurer().counts(lines).tolist() == whole
    assert [sum(row) - (line.count(b" ") + 1) for row, line in zip(whole, lines)] == [len(x) - x.count(b" ") for x in lines]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8)))
    prose = lambda n: "\n".join(" ".join(word() for _ in range(12)) + "." for _ in range(n))
    junk = lambda n: "\n".join(" | ".join(word().upper() + "!!" for _ in range(6)) for _ in range(n))
    out = [(i, prose(1 + i % 5), 1) for i in range(60)] + [(100 + i, junk(1 + i % 5), 0) for i in range(40)]
    out += [(200 + i, out[0][1], 1) for i in range(80)]  # copies
    out += [(300, None, 1), (301, "", 0), (302, " \n\t\n ", 1), (303, prose(30_000), 1), (304, junk(3) + "\n" + prose(2), 0),
            (None, prose(2), 1), (305, prose(1) * 400, 1), (5, prose(2), 1)]
    return out


@pytest.fixture(scope="module")
def scored(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t, _ in rows], DOC).repartition(3)
    labels = spark.createDataFrame([(i, q, "clash") for i, _, q in rows] + [(1, None, "n"), (None, 1, "n"), (2, 1, "again")], LABEL)
    held = is_remainder(F.col("doc_id"), 5, 0)
    texts, mine = docs.select(F.col("doc_id").alias("id"), "text"), labels.filter(~held).select(F.col("doc_id").alias("id"), "quality")
    return quality.learn(texts, mine), quality.score_quality(docs, labels, held).select("doc.doc_id", "doc.text", "held_out", "predicted", "bad_lines", F.col("score").alias("s")).collect()


def test_scores_are_those_of_a_plain_chain(scored, rows):
    model, got = scored
    assert len(got) == len(rows)
    measurer = quality.Measurer()
    for r in got:
        text = (r["text"] or "").encode()
        lines = [(i, x) for i, x in enumerate(text.split(b"\n")) if x.strip()]
        if not lines:
            assert r["s"] == pytest.approx(model.prior) and r["bad_lines"] == []
            continue
        if len(lines) > 1000:
            continue
        only = [x for _, x in lines]
        good = chain_by_loop(model, measurer.steps(only, [only.count(x) for x in only]).astype(float))
        want = sum(len(x) * p for x, p in zip(only, good)) / sum(map(len, only))
        assert r["s"] == pytest.approx(want, abs=1e-4)
        assert r["predicted"] == int(r["s"] >= 0.3)
        assert r["bad_lines"] == [i for (i, _), p in zip(lines, good) if p < 0.5]


def test_held_out_rows_are_told_apart(scored, rows):
    truth = {i: q for i, t, q in rows if t and t.strip()}
    held = [r for r in scored[1] if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 15 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    long = next(r for r in scored[1] if r["doc_id"] == 303)
    assert long["s"] > 0.9 and not long["bad_lines"]


def test_tables_without_rows_or_labels(spark, rows):
    docs = spark.createDataFrame([(i, t, "c", "c", "c") for i, t, _ in rows[:5]], DOC)
    labels = spark.createDataFrame([(i, q, "c") for i, _, q in rows], LABEL)
    never = F.lit(False)
    assert quality.score_quality(docs.filter("false"), labels, never).collect() == []
    none = quality.score_quality(docs, labels.filter("false"), never).collect()
    assert [r["score"] for r in none] == pytest.approx([0.5] * 5)
    same = quality.score_quality(docs, labels.filter("quality = 1"), never).collect()
    assert all(r["score"] > 0.99 for r in same)
    assert all(r["score"] < 0.01 for r in quality.score_quality(docs, labels.withColumn("quality", F.lit(0)), never).collect())


def test_held_out_labels_of_the_tables(spark):
    from ledgerlark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op11_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    for value in (0, 1):
        found = [r["predicted"] == value for r in got if r["quality"] == value]
        assert sum(found) >= 0.9 * len(found) > 0
