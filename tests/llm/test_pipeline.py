"""The pipeline: every stage works on what is left and keeps the columns; the queries are registered."""

import random

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ledgerlark.llm.queries import ORACLES, QUERIES


def test_every_query_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.count()
        if name != "mix":
            assert docs.columns == columns and 0 < after <= before
        before = after
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("name", ["near duplicates", "benchmark"])
def test_filters_keep_clean_rows_and_drop_the_rest(spark, sf_dir, tmp_path, name):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    clean = [(i, " ".join(f"u{i}v{j}" for j in range(50)), "en", "s", 1) for i in range(5)]
    bad = [(10, clean[0][1] + " tail", "en", "s", 1), (11, clean[0][1], "en", "s", 1)] if name == "near duplicates" else [(10, "a " + item, "en", "s", 1)]
    spark.createDataFrame(clean + bad, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "d"))
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, spark.read.parquet(str(tmp_path / "d")), sf_dir).collect()
    assert sorted(x.doc_id for x in got) == list(range(5))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Tables with cases for every stage, and the ids that should be left."""
    r, folder = random.Random(21), tmp_path_factory.mktemp("planted")
    speech = {"aa": ("bcdfg", "aeo"), "bb": ("klmnp", "iuy")}

    def prose(lang, n=70):
        hard, soft = speech[lang]
        return [r.choice(hard) + r.choice(soft) + r.choice(hard) + r.choice(soft) for _ in range(n)]

    item = prose("aa", 20)
    docs, labels, left, i = [], [], set(), 0

    def add(words, lang, keep, toxic=0, text=None):
        nonlocal i
        docs.append((i, " ".join(words) if text is None else text, lang, f"s{i % 3}", 1))
        labels.append((i, 1, toxic))
        left.update({i} if keep else ())
        i += 1

    clean = [(prose(lang), lang) for lang in ("aa", "bb") for _ in range(120)]
    for words, lang in clean:
        add(words, lang, True)
    for words, lang in clean[:20] + clean[120:140]:
        add(words, lang, False)  # an exact copy
        add([*words[:-1], "changed"], lang, False)  # and a near one
    for lang in ("aa", "bb"):
        for _ in range(30):
            words = prose(lang)
            for place, bad in enumerate(("xvwq", "qwvx", "vvxq", "wwxq", "xqqv", "vqxw", "qxvv", "wvqx")):
                words[8 * place + 3] = bad
            add(words, lang, False, toxic=1)
    for _ in range(10):
        words = prose("bb")
        add([*words[:30], *item[3:16], *words[30:]], "bb", False)  # thirteen words of a benchmark item
        add([*words[35:], *item[3:12], *words[:20]], "bb", True)  # nine words are no window
    for text in ("12 34 !! 5", "", " \n ", "ξψω ζθφ χψξ ωζθ φχψ ξωζ"):
        add([], None, False, text=text)
    docs.append((i, None, "aa", None, 1))
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(docs, columns).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([("i1", " ".join(item)), ("i2", None)], "item_id string, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), [d for d in docs if d[0] in left]


def test_planted_cases_are_caught_and_the_rest_is_mixed(spark, planted):
    sf_dir, left = planted
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(x.doc_id for x in got) == [d[0] for d in left]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", left)
    want = con.execute(f"SELECT doc_id, source, size, source_size, target, taken FROM ({ORACLES['op3_source_mix']}) JOIN documents USING (doc_id)")
    columns = ("doc_id", "source", "size", "source_size", "target", "taken")
    assert sorted(tuple(x[c] for c in columns) for x in got) == sorted(want.fetchall())


def test_a_corpus_without_documents(spark, planted, tmp_path):
    sf_dir, _ = planted
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").filter("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
