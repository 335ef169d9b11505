"""The operators against brute force, on small tables with awkward rows."""

import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import chat, decontaminate, jaccard, langid, lm, mixing, tokens, topk, toxicity, urls
from ledgerlark.llm.common import is_remainder

DOC = "doc_id bigint, text string, lang string, source string, row string, token string"
LONG = " ".join(f"w{i % 997} x{i}" for i in range(20_000))


def rng_text(r, n, vocabulary="abcdefghij"):
    return " ".join(r.choice(vocabulary) + r.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows."""
    r = random.Random(4)
    base = [rng_text(r, 60) for _ in range(12)]
    out = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    out += [(100 + i, t.replace(t.split()[30], "zz", 1), "en", "s0") for i, t in enumerate(base[:6])]
    out += [(200, base[0], None, None), (200, base[0], None, None), (201, base[0].upper(), "en", "s1")]
    out += [(300, None, "en", "s1"), (301, "", "en", "s1"), (302, " \t\n ", None, "s2"), (303, "one", "en", "s2"),
            (304, "one two", "en", "s2"), (305, "ONE\vTWO", "en", "s2"), (306, LONG, "en", "s0"), (307, LONG + " end", "en", "s0"),
            (None, "no id here at all", "en", "s0"), (308, "12 34 !!", "en", "s0"), (309, "日本語 のテキスト", "ja", "s0")]
    return [(*x, "clash", "clash") for x in out]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def words(text):
    return (text or "").encode().lower().split()


def held(i, modulus, value):
    return i is not None and zlib.crc32(str(i).encode()) % modulus == value


def test_lm_scores(docs, rows):
    counts = Counter()
    for i, text, *_ in rows:
        if not held(i, 7, 2):
            counts.update([*words(text), b""])
    n, v = sum(counts.values()), len(counts)
    for head in (200_000, 3):  # with 3, nearly all words are looked up by the join
        got = lm.score_texts(docs, is_remainder(F.col("doc_id"), 7, 2), setup=lm.Setup(head=head)).select("doc.*", "*").collect()
        assert len(got) == len(rows)
        want = Counter()
        for i, text, *_ in rows:
            t = [*words(text), b""]
            want[i, held(i, 7, 2), len(t), sum(counts[w] > 0 for w in t), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)] += 1
        assert Counter((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in got) == want
        assert all(math.isfinite(x.score) and x.score < 0 for x in got)


def test_lm_probabilities_are_normalised_and_learned():
    setup = lm.Setup(words=6, endings=2, order=2, size=4, noise=16, batch=64)
    model = lm.Model(setup, np.array([50.0] * 8))
    classes = np.array([0, 1, 2, 3] * 500)  # each class follows from the one before
    before = lm.contexts(classes, np.array([0]), 2, setup.classes)
    start = model.log_probabilities(before, classes).mean()
    trainer = lm.Trainer(model, 1)
    for _ in range(20):
        for a in range(0, len(classes), 64):
            trainer.step(before[a : a + 64], classes[a : a + 64])
    assert model.log_probabilities(before, classes).mean() > start + 1
    one = np.repeat(before[10:11], setup.classes, axis=0)
    assert np.exp(model.log_probabilities(one, np.arange(setup.classes))).sum() == pytest.approx(1, abs=1e-5)


def test_lm_words_inside_a_class_are_normalised(monkeypatch):
    r = np.random.default_rng(3)
    inner = lm.Inner(lm.Setup(words=1, endings=3, order=2, size=4), np.array([1, 1, 1, 2, 3, 3]), np.array([5.0, 1, 2, 7, 3, 3]))
    p = r.normal(size=(1, 4)).astype(np.float32)
    start = np.exp(inner.log_probabilities(np.repeat(p, 7, axis=0), np.arange(7)))
    assert start == pytest.approx([5 / 8, 1 / 8, 2 / 8, 1, 1 / 2, 1 / 2, 1], abs=1e-6)
    inner.target[:] = r.normal(size=inner.target.shape)
    found = np.exp(inner.log_probabilities(np.repeat(p, 7, axis=0), np.arange(7)))
    assert [found[:3].sum(), found[3], found[4:6].sum(), found[6]] == pytest.approx([1, 1, 1, 1], abs=1e-5)
    assert abs(found - start).max() > 0.05
    monkeypatch.setattr(lm, "CELLS", 4)  # a class at a position or two at once
    assert np.exp(inner.log_probabilities(np.repeat(p, 14, axis=0), np.arange(14) % 7)) == pytest.approx([*found, *found], abs=1e-6)


def test_lm_tells_words_of_one_ending_apart(spark):
    r = random.Random(12)
    cycle = [f"word{i}xx" for i in range(100)]  # each word follows from the one before, all have one ending
    texts = [" ".join(cycle[(a + j) % 100] for j in range(50)) for a in (r.randrange(100) for _ in range(3000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    got = lm.score_texts(docs, is_remainder(F.col("doc_id"), 7, 2), setup=lm.Setup(words=4, endings=2, order=2))
    gain, n = got.filter("held_out").agg(F.sum(F.col("score") - F.col("base_score")), F.sum("n_tokens")).first()
    assert gain / n > 0.4


def test_lm_scores_equal_a_loop_over_the_tokens(docs, rows, monkeypatch):
    seen, fitted = {}, lm.fitted

    def kept(train, start, inner, shared):
        seen.update(start=start, inner=inner, shared=shared.value, flat=fitted(train, start, inner, shared))
        return seen["flat"]

    monkeypatch.setattr(lm, "fitted", kept)
    setup = lm.Setup(words=5, endings=3, size=4, least=2)
    got = lm.score_texts(docs, is_remainder(F.col("doc_id"), 7, 2), setup=setup).select("doc.*", "*").collect()
    model, inner, (names, class_of, n_head, _, _, entry_of) = seen["start"], seen["inner"], seen["shared"]
    model.load(seen["flat"])
    inner.load(seen["flat"][len(model.flat()) :])
    setup, place = model.setup, {w: i for i, w in enumerate(names)}
    groups = np.bincount(inner.entry_class, minlength=setup.classes)[setup.words + setup.endings :]
    assert len(groups) > 1 and groups.max() <= math.ceil(math.sqrt(groups.sum()))  # bounded, though endings are uneven
    rest = [sum(n_head[i] + 1 for i, w in enumerate(names) if class_of[i] == setup.words + e) + 1 for e in range(setup.endings)]

    def token(w):
        """(class, entry or none, the word's share of a rare class)"""
        i = place.get(w)
        c = setup.words + lm.ending(w, setup.endings) if i is None else class_of[i]
        e = c - setup.words
        if 0 <= e < setup.endings:
            return c, e, ((0 if i is None else n_head[i]) + 1) / rest[e]
        return c, (None if i is None or entry_of[i] < 0 else entry_of[i]), 1.0

    def log10_of(text):
        out, before = 0.0, []
        for w in [*words(text), b""]:
            c, e, share = token(w)
            p = np.zeros(setup.size)
            for j in range(setup.order):
                bc, be, _ = before[-1 - j] if j < len(before) else (setup.classes, None, 1.0)
                p += model.weight[j] * (model.context[bc] + (0 if be is None else inner.context[be]))
            scores = [math.exp(float(model.target[k] @ p) + float(model.bias[k])) for k in range(setup.classes)]
            out += math.log10(scores[c] / sum(scores) * share)
            if c >= setup.words + setup.endings:
                inside = {k: math.exp(float(inner.target[k] @ p) + float(inner.bias[k])) for k in np.flatnonzero(inner.entry_class == c)}
                out += math.log10(inside[e] / sum(inside.values()))
            before.append((c, e, share))
        return out

    want = sorted((str(i), log10_of(text)) for i, text, *_ in rows)
    found = sorted((str(x.doc_id), x.score) for x in got)
    assert [i for i, _ in found] == [i for i, _ in want]
    assert [v for _, v in found] == pytest.approx([v for _, v in want], rel=1e-4)


def test_lm_beats_unigrams_on_held_out_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet".replace("sf0.001", "sf0.1")).select("doc_id", "text")
    got = lm.score_texts(docs, is_remainder(F.col("doc_id"), 7, 2)).filter("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0]


def library():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def test_token_counts_equal_the_library(docs, rows):
    path, tokenizer = library()
    got = tokens.token_counts(docs, path, limit=512).select("doc.doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    want = Counter()
    for i, text, *_ in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        want[i, len((text or "").encode()), n, n > 512] += 1
    assert Counter(map(tuple, got)) == want


def test_token_counts_of_random_texts():
    path, tokenizer = library()
    counter = tokens.TokenCounter(path, tokens.character_classes(path), chunk=2000)
    r, parts = random.Random(2), [" the", "'s", "'re", "'LL", " '", "  ", "\n\n", "<|endoftext|>", "----", "ing", " 　", "\x1c", "\x85"]
    texts = ["".join(r.choice([r.choice(parts), chr(r.choice([r.randrange(1, 0x250), r.randrange(1, 0xD800), r.randrange(0xE000, 0x110000)]))])
                     for _ in range(r.choice([1, 2, 5, 30]))) for _ in range(5000)]
    texts += ["", "x" * 3000, " " * 3000, "-" * 999, "aa" * 500]
    assert counter.count(texts).tolist() == [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_chunk_maps_agree_with_one_scan():
    path, _ = library()
    classes = tokens.character_classes(path)
    points = np.frombuffer((" It's  we'll 12a\n\n b" * 300).encode("utf-32-le"), np.uint32)
    whole = tokens.Splitter(classes, width=len(points)).starts(points)
    for width in (1, 7, 64):
        assert tokens.Splitter(classes, width=width).starts(points).tolist() == whole.tolist()


def brute_targets(sizes, weights, most):
    total, target, stopped = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in sizes if s not in stopped]
        rest = total - sum(most * sizes[s] for s in stopped)
        level = rest / sum(weights[s] for s in free) if free else 0
        over = {s for s in free if level * weights[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in stopped else level * weights[s] for s in sizes}
        stopped |= over


def test_mix(docs, rows):
    got = mixing.mix_sources(docs).select("doc.doc_id", "doc.source", "size", "source_size", "target", "taken").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix_sources(docs).select("doc.doc_id", "doc.source", "size", "source_size", "target", "taken").collect()))
    sizes = Counter()
    for _, text, _, source, *_ in rows:
        sizes[source] += len(words(text))
    order = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    target = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    taken = Counter()
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(target[x.source])
        assert x.taken in (0, x.size, 2 * x.size, 3 * x.size)
        taken[x.source] += x.taken
    assert len(got) == len(rows)


def test_mix_comes_near_its_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet".replace("sf0.001", "sf0.01"))
    got = mixing.mix_sources(docs).groupBy("doc.source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"), F.max("size").alias("m"))
    assert all(abs(x.t - x.g) <= x.m for x in got.collect())


def brute_rule(url, rules, default):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(h), len(p), verdict == "block", rule, verdict))
    return (host, path, *(max(fits)[3:] if fits else (None, default)))


def test_urls(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
             ("allow", "a.b.org"), ("block", "a.b.org"), ("allow", "b.org/x/y/")]
    r = random.Random(3)
    given = [None, "", "x", "://", "http://", "http://ORG", "http://a.org", "https://EXAMPLE.org/es/?q", "http://notexample.org/es/1", "http://b.org#/x"]
    given += ["http://" + r.choice(["example.org", "w.example.org", "a.b.org", "b.org", "x.com", "com", "c.a.b.org"])
              + r.choice(["", "/", "//"]) + "/".join(r.choice(["en", "es", "de", "fr", "x", "y", "1", "12"]) for _ in range(r.randrange(4)))
              + r.choice(["", "/", "?a=/de/", "#/fr/"]) for _ in range(500)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(given)], "page_id int, url string, host string")
    got = urls.judge_urls(pages, rules).orderBy("page.page_id").collect()
    assert [(x.host, x.path, x.rule, x.verdict) for x in got] == [brute_rule(u, rules, "allow") for u in given]
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_preferences(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "why"), (0, 3, "assistant", "so"), (1, 0, "user", "hi"),
             (1, 1, "assistant", "no"), (2, 0, "user", None), (3, 0, "user", "x"), (4, 0, "assistant", "same"), (5, 0, "assistant", "same"),
             (None, 0, "user", "lost"), (6, 0, None, "odd"), (6, 1, "assistant", ""), (7, 5, "assistant", "z" * 5000), (7, 5, "assistant", "z" * 5000)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    got = {x.conv_id: x for x in chat.format_preferences(chat.swapped_answers(chat.conversation_turns(df))).collect()}
    assert sorted(got) == list(range(8))
    assert {k: x.other_id for k, x in got.items()} == {0: 1, 1: 0, 2: None, 3: None, 4: 5, 5: 4, 6: 7, 7: 6}
    assert (got[3].n_prefix, got[3].prompt, got[3].chosen_text, got[3].rejected_text) == (0, "", "<|user|>\nx\n<|end|>\n", "")
    assert got[2].chosen_mask == got[2].rejected_mask == "" and got[2].rejected == []
    x = got[0]
    assert x.n_prefix == 3 and x.chosen_text == "<|assistant|>\nso\n<|end|>\n" and x.rejected_text == "<|assistant|>\nno\n<|end|>\n"
    assert x.prompt == "<|user|>\nhi\n<|end|>\n<|assistant|>\nyes\n<|end|>\n<|user|>\nwhy\n<|end|>\n" and x.chosen_mask == "14-16"
    a, b = map(int, x.rejected_mask.split("-"))
    assert x.rejected_text[a:b] == "no"
    assert got[4].n_prefix == 1 and got[4].chosen_text == got[4].rejected_text == got[4].chosen_mask == ""
    assert got[6].prompt == "<|" + "|>\nodd\n<|end|>\n" and got[6].chosen_mask == "14-14"


def test_preferences_of_no_conversation_and_of_clashing_columns(spark):
    turns = spark.createDataFrame([(4, 1, "assistant", "a", "x", "y"), (9, 1, "user", "b", "x", "y")],
                                  "conv_id bigint, turn bigint, role string, text string, chosen string, at string")
    pairs = lambda df: chat.format_preferences(chat.swapped_answers(chat.conversation_turns(df)))
    assert [(x.conv_id, x.other_id, x.rejected_text) for x in pairs(turns).orderBy("conv_id").collect()] == [(4, None, ""), (9, None, "")]
    assert pairs(turns.filter("false")).collect() == []


def brute_grams(text, n):
    padded = re.sub(r"(?:[^\w]|[\d_])+", " ", " " + text.lower() + " ")
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if padded.strip() else []


def test_language_grams_and_filter():
    texts = ["Ab, cd!", "", "x", "12 3", "été  ou", "a\nb", "zz"]
    keys, of = langid.text_grams(texts, 3)
    assert Counter(of.tolist()) == Counter(i for i, t in enumerate(texts) for _ in brute_grams(t, 3))
    alone = [langid.text_grams([t], 3)[0].tolist() for t in texts]
    assert [keys[of == i].tolist() for i in range(len(texts))] == alone
    every = np.unique(keys)
    masks = np.arange(len(every)) % 4
    model = langid.LanguageFilter(every, masks.astype(np.uint64), ["b", "a"], np.array([1.0, 1.0]), langid.Setup())
    assert ((model.masks(every) & masks) == masks).all()  # no language is ever missed


def test_language_grams_of_pieces_are_those_of_the_text():
    r = random.Random(8)
    texts = ["".join(r.choice("abÀß1 .\n日") for _ in range(k)) for k in (0, 1, 5, 30, 200)] + ["w" * 90, " " * 40, None]
    for n in (2, 3):
        whole = [Counter(langid.text_grams([t or ""], n)[0].tolist()) for t in texts]
        for size in (1, 4, 7, 64):
            found = [Counter() for _ in texts]
            for numbers, own, more, joined in langid.pieces(texts, n, size):
                keys, of = langid.text_grams(own, n, more, joined)
                for k, i in zip(keys.tolist(), of.tolist()):
                    found[numbers[i]][k] += 1
            assert found == whole


def test_language_of_long_texts(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text IS NOT NULL").limit(60).collect()
    spoken = spark.createDataFrame([(x.text, x.lang) for x in docs], "text string, lang string")
    model, texts = langid.learn(spoken), [x.text for x in docs]
    whole = model.predict(texts)
    monkeypatch.setattr(langid, "PORTION", 50)
    got = model.predict(texts)
    assert got[0] == whole[0] and got[1].tolist() == whole[1].tolist()


def test_language(docs, rows, spark, sf_dir):
    got = langid.identify(docs, is_remainder(F.col("doc_id"), 4, 2)).collect()
    assert len(got) == len(rows)
    for x in got:
        has = any(c.isalpha() for c in x.doc.text or "")
        assert (x.lang_pred != "und") == has and 0 <= x.score <= 1 and (has or x.score == 0)
    assert {x.lang_pred for x in langid.identify(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(False)).collect()} == {"und"}
    big = spark.read.parquet(f"{sf_dir}/documents.parquet".replace("sf0.001", "sf0.1"))
    judged = langid.identify(big, is_remainder(F.col("doc_id"), 4, 2), keep=["lang"]).filter("held_out AND doc.lang IS NOT NULL")
    right = judged.agg(F.avg((F.col("lang_pred") == F.col("doc.lang")).cast("double"))).first()[0]
    assert right > 0.98


def test_more_languages_than_a_slot_has_bits(spark):
    r = random.Random(6)
    spoken = {f"l{i:03}": [chr(0x4E00 + 20 * i + j) for j in range(20)] for i in range(150)}
    rows = [(lang, " ".join("".join(r.choices(own, k=4)) for _ in range(30))) for lang, own in spoken.items() for _ in range(3)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = langid.identify(docs, F.lit(False)).collect()
    assert len(got) == len(rows)
    assert all(x.lang_pred == x.doc.lang and x.score > 0.9 for x in got)


def test_counterfactual_penalty():
    r = np.random.default_rng(1)
    n = 4000
    insult, term, other = r.random(n) < 0.2, r.random(n) < 0.3, r.random(n) < 0.3
    y = (insult | (term & (r.random(n) < 0.5))).astype(float)  # the term goes along with the label, wrongly
    x = np.stack([insult, term, other], axis=1).astype(np.float32)
    swapped = np.stack([insult, other, term], axis=1).astype(np.float32)
    plain = toxicity.fit(x, swapped, y, toxicity.Setup(penalty=0))[0]
    fair = toxicity.fit(x, swapped, y, toxicity.Setup(penalty=10))[0]
    assert abs(fair[1] - fair[2]) < 0.3 * abs(plain[1] - plain[2]) and fair[0] > 1


def test_stem_levels():
    setup = toxicity.Setup(stem=4)
    words = ["abcdx", "abcdy", "abc"] + ["zz"] * 97
    found = toxicity.features_of(words, setup)
    assert {"abcdx", "abcdy", "abc", "zz", "abcd*1", "abcd*2", "abcd%1"} == found
    assert "abcd%3" in toxicity.features_of(words[:3], setup) and toxicity.features_of([], setup) == set()
    names = sorted(found)
    model = toxicity.Classifier(names, np.ones(len(names)), 0.0, setup)
    assert model.found(" ".join(words)) == list(range(len(names))) and model.found(None) == []


def test_toxicity(docs, rows, spark, sf_dir):
    nothing = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = toxicity.score_toxicity(docs, nothing, is_remainder(F.col("doc_id"), 3, 1)).collect()
    assert len(got) == len(rows) and {x.predicted for x in got} == {0}
    few = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (300, 0), (301, 0), (306, 0), (2, 0)], "doc_id bigint, toxic int")
    assert all(0 <= x.score <= 1 for x in toxicity.score_toxicity(docs, few, F.lit(False)).collect())
    where = sf_dir.replace("sf0.001", "check_s")
    if not Path(where).exists():
        pytest.skip("no larger tables here")
    big, labels = spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/labels.parquet")
    scored = toxicity.score_toxicity(big, labels, is_remainder(F.col("doc_id"), 3, 1), keep=["doc_id"])
    tested = scored.filter("held_out").join(labels, F.col("doc.doc_id") == F.col("doc_id"))
    found = {(x.toxic, x.predicted): x["count"] for x in tested.groupBy("toxic", "predicted").count().collect()}
    assert found[1, 1] > 0.97 * (found[1, 1] + found.get((1, 0), 0)) and found.get((0, 1), 0) < 0.005 * found[0, 0]


def brute_components(rows, n, percent):
    sets = []
    for _, text, *_ in rows:
        w = words(text)
        sets.append({tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    names = {k: min([d for d in v if d is not None], default=None) for k, v in least.items()}
    return Counter((doc, len(sets[i]), names[find(i)]) for i, (doc, *_) in enumerate(rows)), len(least)


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (2, 50), (1, 100)])
def test_near_duplicates(docs, rows, n, percent):
    got = jaccard.near_duplicates(docs, n=n, percent=percent).collect()
    want, groups = brute_components(rows, n, percent)
    assert Counter((x.doc.doc_id, x.n_shingles, x.component_id) for x in got) == want
    assert sum(x.kept for x in got) == groups


def test_near_duplicates_in_a_dense_group(spark, tmp_path):
    r = random.Random(8)
    base = [f"t{i}" for i in range(80)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 4])):
            text[r.randrange(80)] = f"q{r.randrange(1000)}"
        rows.append((1000 - i, " ".join(text)))
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(str(tmp_path / "d"))
    got = jaccard.near_duplicates(spark.read.parquet(str(tmp_path / "d")), n=3, percent=90).collect()
    want, _ = brute_components(rows, 3, 90)
    assert Counter((x.doc.doc_id, x.n_shingles, x.component_id) for x in got) == want


def brute_top(vectors, k):
    good = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in vectors
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, v in good:
        if q % 20 == 0:
            s = sorted(((-int(v @ u), i) for i, u in good if i != q and len(u) == len(v)))[:k]
            out.update((q, rank + 1, i, -x) for rank, (x, i) in enumerate(s))
    return out


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    r = np.random.default_rng(5)
    vectors = [(i, r.normal(size=6).round(2).tolist()) for i in range(300)]
    vectors += [(300 + i, [0.5] * 6) for i in range(60)]  # ties
    vectors += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, [1.0] * 6),
                (420, [2.0, 1.0]), (421, [3.0, 1.0]), (440, []), (441, [])]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    got = topk.top_k(df, df.filter("vec_id % 20 = 0"))
    assert Counter(map(tuple, got.collect())) == brute_top(vectors, 20)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_contamination(docs, rows, spark):
    r = random.Random(9)
    source = words(rows[3][1].replace(" ", ", "))
    quote = b" ".join(source[10:25]).decode().upper()
    items = [(1, quote), (10, quote), (2, "ONE-two"), (3, None), (4, " "), (5, rng_text(r, 30)), (None, "no id, here"), (7, " ".join(LONG.split()[5000:5010])),
             (8, " ".join(rows[3][1].split()[40:49])), (9, "zz " + rows[4][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(docs, bench).collect()
    want = Counter()
    for doc, text, *_ in rows:
        w, hit, found = item_words(text), set(), set()
        for item, t in items:
            v = item_words(t)
            size = min(10, len(v))
            wins = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if size else set()
            for i in range(len(w) - size + 1 if size else 0):
                if tuple(w[i : i + size]) in wins:
                    hit |= set(range(i, i + size))
                    found.add("" if item is None else str(item))
        want[doc, len(w), len(hit), tuple(sorted(found))] += 1
    assert Counter((x.doc.doc_id, x.n_words, x.n_hit, tuple(x["items"])) for x in got) == want
    assert any(x.n_hit for x in got)
    assert decontaminate.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("module", [jaccard, decontaminate, lm])
def test_rows_survive_other_file_splits_in_later_jobs(docs, rows, spark, monkeypatch, module):
    kept, name, sizes = module.written, "spark.sql.files.maxPartitionBytes", ["20k", "128m", "50k"]

    def other_splits(df, path):
        out = kept(df, path)
        sizes.append(sizes.pop(0))
        spark.conf.set(name, sizes[0])
        return out

    monkeypatch.setattr(module, "written", other_splits)
    usual = spark.conf.get(name)
    try:
        if module is jaccard:
            got = jaccard.near_duplicates(docs, n=5, percent=80)
        elif module is decontaminate:
            got = decontaminate.contamination(docs, spark.createDataFrame([(1, rows[3][1])], "item_id bigint, text string"))
        else:
            got = lm.score_texts(docs, is_remainder(F.col("doc_id"), 7, 2))
        for size in sizes:  # the caller acts later, and more than once
            spark.conf.set(name, size)
            found = got.collect()
            assert Counter(x.doc.doc_id for x in found) == Counter(r[0] for r in rows)
            if module is jaccard:
                want, _ = brute_components(rows, 5, 80)
                assert Counter((x.doc.doc_id, x.n_shingles, x.component_id) for x in found) == want
            elif module is decontaminate:
                assert {x.doc.doc_id: x.n_words for x in found}[306] == len(item_words(LONG))
            else:
                assert Counter((x.doc.doc_id, x.n_tokens) for x in found) == Counter((r[0], len(words(r[1])) + 1) for r in rows)
    finally:
        spark.conf.set(name, usual)


def test_empty_tables(docs, spark):
    none = docs.limit(0)
    assert lm.score_texts(none, F.lit(False)).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert langid.identify(none, F.lit(False)).count() == 0
    assert jaccard.near_duplicates(none).count() == 0
    assert decontaminate.contamination(none, spark.createDataFrame([(1, "a b")], "item_id int, text string")).count() == 0


def test_words_are_hashed_alike_wherever_they_stand():
    from ledgerlark.llm.common import WordHasher

    texts = [b"A b\tcc", b"", b"  ", b"cc b a", b"x" * 100]
    words_ = WordHasher(limit=8).of(texts)
    plain = [t.lower().split() for t in texts]
    assert np.diff(words_.starts).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    known = dict(zip(flat, words_.hashes.tolist()))
    assert [known[w] for w in flat] == words_.hashes.tolist() and len(set(known.values())) == len(known)
