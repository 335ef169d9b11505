"""Near duplicates that return kept rows only: the same rows, without a shuffle of what they keep."""

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import jaccard

WORDS = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = [(i, t) for i, t in enumerate(WORDS)]
    rows += [(100 + i, t) for i, t in enumerate(WORDS[:9])]  # exact copies
    rows += [(200 + i, t + " tail") for i, t in enumerate(WORDS[5:15])]  # near ones
    rows += [(3, WORDS[3]), (3, WORDS[3]), (None, WORDS[4]), (None, WORDS[20] + " end"), (None, None), (300, None), (300, "")]
    path = str(tmp_path_factory.mktemp("kept") / "d")
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_kept_only_gives_the_kept_rows(docs):
    columns = ("doc", "n_shingles", "component_id", "kept")
    every = jaccard.near_duplicates(docs, n=3, percent=80, keep=docs.columns).filter("kept").select(*columns)
    only = jaccard.near_duplicates(docs, n=3, percent=80, keep=docs.columns, kept_only=True).select(*columns)
    assert sorted(map(str, only.collect())) == sorted(map(str, every.collect()))
    assert only.count() == 30 + 3  # each text once; rows without words are alike to nothing


def test_texts_are_not_shuffled(spark, docs, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jaccard.near_duplicates(docs, n=3, percent=80, keep=docs.columns, kept_only=True).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "LeftSemi" in joins[0]  # only what the bitmap doubted wrongly


@pytest.mark.parametrize("bits", [16, 25])
def test_rows_without_others_however_small_the_bitmap(spark, tmp_path, monkeypatch, bits):
    whole = jaccard.bitmap_of
    monkeypatch.setattr(jaccard, "bitmap_of", lambda numbers, column, **_: whole(numbers, column, bits=bits))
    spark.range(20_000).select(F.col("id").alias("row"), F.lit("text").alias("text")).write.parquet(str(tmp_path / "rows"))
    rows, gone = spark.read.parquet(str(tmp_path / "rows")), spark.range(0, 20_000, 3).select(F.col("id").alias("row"))
    got = [r.row for r in jaccard.without(rows, gone).collect()]
    assert sorted(got) == [i for i in range(20_000) if i % 3]


def python_steps(plan):
    """The most Python steps that a task of the plan holds at once, by the tree of the physical plan."""
    above, most = [], 0
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        name = line.lstrip(" :+-*").split("(")[0].split(" ")[0]
        while above and above[-1][0] >= depth:
            above.pop()
        here = above[-1][1] if above else 0
        here = 0 if "Exchange" in name else here + (name in ("MapInArrow", "ArrowEvalPython"))
        above.append((depth, here))
        most = max(most, here)
    return most


def test_a_task_holds_one_python_worker(docs, monkeypatch):
    found, write = {}, jaccard.written

    def seen(df, name, **options):
        found[name] = max(found.get(name, 0), python_steps(df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name, **options)

    monkeypatch.setattr(jaccard, "written", seen)
    last = jaccard.near_duplicates(docs, n=3, percent=80, keep=docs.columns, kept_only=True)
    found["result"] = python_steps(last._jdf.queryExecution().executedPlan().toString())
    assert found["prefix-postings"] == found["result"] == 1
    assert max(found.values()) == 1


def test_texts_go_to_python_in_small_batches(spark, docs, monkeypatch):
    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", set(), jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name, **o: (seen.add(int(spark.conf.get(key))), write(df, name, **o))[1])
    before = spark.conf.get(key)
    jaccard.near_duplicates(docs, n=3, percent=80, kept_only=True)
    assert seen == {jaccard.TEXTS} and spark.conf.get(key) == before
