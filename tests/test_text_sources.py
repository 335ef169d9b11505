import random
from decimal import Decimal
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import bonds, quality
from ledgerlark.sources import landing, pages, payloads, text

TICKER = "S29S5"
TAIL = "29-Aug-25 29-Sep-25 31 1.234,56 2,35% 1-Sep-25 2-Sep-25 123,45 1,00% 2,00% 3,00% 0,50% 28"
DUAL = "TTM26X1 29-Aug-25 31-dic-2026 500 1.000,00 1-Sep-25 99,5 2,1% 2,2% 0,1% 3,3% 400"


def report(*lines):
    return "\n".join(lines)


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def sections(spark, *lines):
    rows = text.extract_section_rows(docs(spark, report(*lines))).collect()
    return [(r["section"], r["ticker_symbol"], r["dm_dias"]) for r in rows]


def test_rows_belong_to_their_section(spark):
    got = sections(
        spark, f"{TICKER} {TAIL}", text.LECAP_TITLE, "Ticker Emision", f"{TICKER} {TAIL}",
        f" {TICKER} {TAIL}", f"S1{TICKER}", text.BONCAP_TITLE, f"T30J6 {TAIL} more tokens",
        text.DUAL_START, DUAL,
    )
    assert got == [(text.LECAP_TITLE, TICKER, "28"), (text.BONCAP_TITLE, "T30J6", "28")]


def test_section_does_not_reopen(spark):
    got = sections(
        spark, text.LECAP_TITLE, f"S1X1 {TAIL}", text.BONCAP_TITLE, f"T1X1 {TAIL}",
        text.LECAP_TITLE, f"S2X2 {TAIL}",
    )
    # The first section ended at the second title; the second ends where the first one's
    # title comes back.
    assert [(s, t) for s, t, _ in got] == [(text.LECAP_TITLE, "S1X1"), (text.BONCAP_TITLE, "T1X1")]


def test_own_title_may_repeat_inside_a_section(spark):
    got = sections(spark, text.LECAP_TITLE, f"S1X1 {TAIL}", text.LECAP_TITLE, f"S2X2 {TAIL}")
    assert [t for _, t, _ in got] == ["S1X1", "S2X2"]


def test_odd_white_space_and_empty_documents(spark):
    wide = f"{TICKER} {TAIL}".replace(" 31 ", "\t 31　 ")
    assert sections(spark, text.LECAP_TITLE, wide) == [(text.LECAP_TITLE, TICKER, "28")]
    assert text.extract_section_rows(docs(spark, "", None, "no tables")).count() == 0


def test_pattern_rows(spark):
    body = report("x", DUAL, text.DUAL_START, "Bono", DUAL, DUAL + " ", text.DUAL_END, DUAL)
    rows = text.extract_pattern_rows(docs(spark, body, report(text.DUAL_START, DUAL), "none")).collect()
    assert [(r["doc_id"], r["bono"], r["tir"], r["dm"]) for r in rows] == [
        (0, "TTM26X1", "3,3%", "400"),
        (1, "TTM26X1", "3,3%", "400"),
    ]


def test_bond_typing_and_quarantine(spark):
    bad = f"S9X9 {TAIL}".replace("2,35%", "#DIV/0!")
    rows = text.extract_section_rows(docs(spark, report(text.LECAP_TITLE, f"{TICKER} {TAIL}", bad)))
    good, rejected = quality.split_quarantine(bonds.type_bond_rows(rows))
    master = bonds.to_fixed_income(good).first()
    assert (master["amount_at_payment"], master["rate"], master["type"]) == (Decimal("1234.56"), Decimal("2.35"), "LECAP")
    daily = bonds.to_fixed_income_daily(good, F.lit("2025-09-01")).first()
    assert daily["price_per_100_nominal_value"] == Decimal("123.45")
    assert daily["modified_duration_in_days"] == 28
    assert [r["reject_reason"] for r in rejected.collect()] == ["bad_rate"]
    legacy = bonds.type_bond_rows(rows, legacy_price=True).first()
    assert legacy["price_per_100_nominal_value"] == Decimal("12345")
    failing, _ = quality.split_quarantine(bonds.type_bond_rows(rows), on_error="fail")
    with pytest.raises(Exception, match="bad_rate"):
        failing.collect()


def test_chunked_reports_give_the_rows_of_whole_ones(spark):
    """Cut at random into chunks, some empty, some within a title or a row; titles come again and in any order."""
    dice = random.Random(3)
    kinds = ["A one", "B two", "A and B", "row1 x y", "row2  x y z", "row3 x", "noise", "", "row4 A x"]
    texts = ["\n".join(dice.choices(kinds, k=dice.randrange(12))) for _ in range(60)] + ["", "A", "B\nrow1 a b", "\n\n"]
    chunks = []
    for i, t in enumerate(texts):
        edges = [0, *sorted(dice.choices(range(len(t) + 1), k=dice.randrange(8))), len(t)]
        chunks += [(i, n * 10, t[a:b] or None) for n, (a, b) in enumerate(zip(edges, edges[1:]))]
    dice.shuffle(chunks)
    rule = {"titles": ("A", "B"), "row_pattern": "^row", "headers": ("c1", "c2", "c3")}
    whole = text.extract_section_rows(docs(spark, *texts), **rule)
    parts = spark.createDataFrame(chunks, "doc_id long, chunk_no long, text string")
    found = text.extract_chunked_section_rows(parts.repartition(5), **rule)
    rows = sorted(map(tuple, whole.collect()))
    assert len(rows) > 30 and sorted(map(tuple, found.select(*whole.columns).collect())) == rows
    nobody = parts.withColumn("doc_id", F.when(F.col("doc_id") != 62, F.col("doc_id")).cast("long")).filter("doc_id IS NULL")
    assert text.extract_chunked_section_rows(nobody, **rule).count() == 1
    assert text.extract_chunked_section_rows(parts.limit(0), **rule).count() == 0


HTML = """<html><!-- <a href="/hidden">x</a> --><script>var a='<a href="/script">';</script>
<div class="top"><a href="/menu">m</a></div>
<div id=x class="listing Quick-Access"><div><span>deep</span></div><A  title='t' HREF='/r/1?a=1&amp;b=2'>r</A></div>
<a href="http://other.example/x">o</a><a name="n">none</a><a class="big pdfDownload" href="/f.pdf">p</a></html>"""


def page(spark, html=HTML):
    return spark.createDataFrame([(1, "https://site.example/a/b", html)], "page_id long, url string, html string")


def test_links(spark):
    links = [r["link"] for r in pages.extract_links(page(spark)).orderBy("link_no").collect()]
    assert links == [
        "https://site.example/menu",
        "https://site.example/r/1?a=1&b=2",
        "http://other.example/x",
        "https://site.example/f.pdf",
    ]


def test_links_mean_what_the_standard_library_says(spark):
    """Against urljoin, for every kind of link on every kind of page."""
    urls = ["http://a/b/c/d;p?q", "https://h.example", "http://h.example/x/", "http://h.example?k=1", "https://u@h:8080/a/../b/./c#z"]
    hrefs = ["g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x?y#s", "", ".", "./", "..", "../", "../g",
             "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h",
             "g;x=1/./y", "g?y/./x", "g?y/../x", "g#s/../x", "mailto:x@y", "http://o.example/é/%2e?q#f", "//o.example"]
    cases = spark.createDataFrame([(u, h) for u in urls for h in hrefs], "url string, href string")
    for row in cases.select("url", "href", pages.absolute(F.col("href"), F.col("url")).alias("link")).collect():
        page = row["url"]
        want = urljoin(page, row["href"])
        if row["href"] == "":  # the standard library keeps the page's fragment
            want = page.split("#")[0]
        assert row["link"] == want, (page, row["href"])
    doubled = spark.createDataFrame([("http://a/b/c", "d//e/../f")], "url string, href string")  # an empty segment is a segment
    assert doubled.select(pages.absolute(F.col("href"), F.col("url"))).first()[0] == "http://a/b/d//f"
    empty = spark.createDataFrame([(None, "/x"), ("http://a/b", None), ("no scheme", "/x"), ("no scheme", "http://a/b")], "url string, href string")
    assert [r[0] for r in empty.select(pages.absolute(F.col("href"), F.col("url"))).collect()] == [None, None, None, "http://a/b"]


def test_one_spelling_for_one_address(spark):
    pairs = [("HTTP://A.Example:80", "http://a.example/"), ("https://u:P@H:443/%7ea/%2e%2E/b%c3%a9?q=%2f%41#f", "https://u:P@h/b%C3%A9?q=%2FA"),
             ("https://h:80/a/./b/..", "https://h:80/a/"), ("http://h/100%", "http://h/100%"), ("mailto:x@y", "mailto:x@y"), ("http://h:/", "http://h/")]
    df = spark.createDataFrame(pairs, "a string, want string")
    assert [r[0] for r in df.select(pages.normal_address(F.col("a"))).collect()] == [w for _, w in pairs]


def test_links_lead_to_one_page_or_none(spark):
    links = spark.createDataFrame([(1, "http://H/a#x"), (2, "http://h/%61"), (3, "http://h/none"), (4, None), (4, None)], "id long, link string")
    there = spark.createDataFrame([(9, "http://h/a", "second"), (7, "http://h:80/./a", "first"), (5, None, "lost")], "page long, url string, file string")
    found = pages.follow_links(links, there, "link", "url", "page")
    assert sorted((r["id"], r["file"]) for r in found.collect() if r["file"]) == [(1, "first"), (2, "first")]
    assert found.count() == 5
    assert pages.follow_links(links, there.limit(0), "link", "url", "page").count() == 5


def test_container_and_class_links(spark):
    def first(tag, css=None, html=HTML):
        return pages.first_container_link(page(spark, html), tag, css).first()["href"]

    assert first("div") == "/menu"
    assert first("div", "listing Quick-Access") == "/r/1?a=1&b=2"
    assert first("div", "absent") is None
    nested = '<div class="c"><div>x</div></div><a href="/after">y</a>'
    assert first("div", "c", nested) is None
    assert pages.first_classed_link(page(spark), "pdfDownload").first()["href"] == "/f.pdf"
    assert pages.first_classed_link(page(spark), "pdf").first()["href"] is None


def test_payload_gate(spark):
    rows = [("A", "timestamp,open"), ("", "x"), ("B", f"{payloads.QUOTA_MARKER} as"), ("C", None)]
    df = spark.createDataFrame(rows, "symbol string, text string")
    got = [r["payload_status"] for r in payloads.gate_payloads(df).collect()]
    assert got == ["usable", "empty_symbol", "rate_limited", "no_answer"]


def test_payload_rows(spark):
    csv = "timestamp,open,high,low,close,volume\n2019-03-04,7,9,6.5,8.25,40\r\n2019-03-05,8,9,7.5,8.5,41\n"
    df = spark.createDataFrame(
        [("QQZ", csv), ("X", "timestamp,open"), ("E", '{\n "Error Message": "no"\n}'), ("N", None),
         ("L", "a\n" + payloads.QUOTA_MARKER + "\n2019-03-05,8,9,7.5,8.5,41"), ("H", "h\n2019-03-05,8,9,7.5,x,41")], "symbol string, text string")
    assert payloads.parse_price_payloads(df).count() == 2
    newest = payloads.parse_price_payloads(df, daily=True).collect()
    assert [(r["symbol"], str(r["timestamp"]), r["close"], r["volume"]) for r in newest] == [("QQZ", "2019-03-05", 8.5, 41)]
    rejected = payloads.rejected_price_lines(df).collect()
    assert sorted((r["symbol"], r["reject_reason"]) for r in rejected) == [
        ("E", "corrupt_line"), ("E", "corrupt_line"), ("H", "corrupt_line"), ("L", "rate_limited"), ("N", "no_answer"), ("X", "corrupt_body")]


def test_every_payload_gives_a_price_or_a_rejection(spark):
    row = "2019-03-04,7,9,6.5,8.25,40"
    bodies = {"good": f"h\n{row}", "mixed": f"h\n{row}\nx", "bad": "h\nx", "empty": "", "blank": " \n\t\r\n", "null": None, "header": "h\n",
              "error": '{"Error Message": "no"}', "quota": payloads.QUOTA_MARKER, "long quota": f"a\n{payloads.QUOTA_MARKER}\n{row}"}
    df = spark.createDataFrame(list(bodies.items()), "symbol string, text string")
    priced = {r["symbol"] for r in payloads.parse_price_payloads(df).collect()}
    rejected = {r["symbol"]: (r["reject_reason"], r["line"]) for r in payloads.rejected_price_lines(df).collect()}
    assert priced == {"good", "mixed"} and priced | set(rejected) == set(bodies)
    assert rejected == {
        "mixed": ("corrupt_line", "x"), "bad": ("corrupt_line", "x"), "empty": ("corrupt_body", None), "blank": ("corrupt_body", "\t"),
        "null": ("no_answer", None), "header": ("corrupt_body", "h"), "error": ("corrupt_body", '{"Error Message": "no"}'),
        "quota": ("rate_limited", payloads.QUOTA_MARKER), "long quota": ("rate_limited", "a"),
    }


def test_series_json(spark):
    good = """{"Meta Data": {"3. Last Refreshed": "2019-03-04"}, "Time Series (Daily)":
      {"2019-03-04": {"1. open": "7.5", "4. close": "8.25"}, "2019-03-05": {"1. open": "1"}}}"""
    partial = good.replace('Refreshed": "2019-03-04"', 'Refreshed": "2019-03-05"')
    absent = good.replace('Refreshed": "2019-03-04"', 'Refreshed": "2019-03-06"')
    rows = [("QQZ", good), ("PART", partial), ("GONE", absent), ("ERR", '{"Error Message": "x"}'),
            ("HTML", "<html>"), ("", good), ("NUL", None)]
    df = spark.createDataFrame(rows, "symbol string, payload string")
    got = {r["ticker"]: (r["price"], r["market"], r["date"]) for r in payloads.latest_from_series_json(df).collect()}
    assert got == {"QQZ": ("8.25", "US", "2019-03-04"), "PART": (None, "US", "2019-03-05")}


def test_landing_paths(spark):
    paths = ["s3://b/raw/daily/prices/US_NYSE_BRK_B/2025-10-20.csv", "raw/x.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = landing.parse_landing_path(df).drop("path").collect()
    assert tuple(map(str, got[0])) == ("raw", "daily", "prices", "US", "NYSE", "BRK_B", "2025-10-20")
    assert set(got[1]) == {None}
