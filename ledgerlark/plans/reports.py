"""Queries over report text, pages and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlark.functions import evaluate_once
from ledgerlark.operators import bonds, quality
from ledgerlark.plans import model
from ledgerlark.plans.registry import query
from ledgerlark.sources import landing, pages, payloads, text
from ledgerlark.sources.text import WS

# --- documents and pages -------------------------------------------------

TITLES = ("The ", "the of")
WORDS = ("w1", "w2", "w3", "w4", "w5", "w6")
FIRST_WORD = "^[A-Z][a-z]+"


def _section_sql(title: str, other: str) -> str:
    """One section by line numbers: start and end are minima over the document's lines."""
    return f"""
  SELECT doc_id, '{title}' AS section, list_filter(regexp_split_to_array(line, '{WS}+'), lambda x: x <> '') AS t
  FROM (
    SELECT *, min(n) FILTER (contains(line, '{other}') AND NOT contains(line, '{title}') AND n > start_n)
                OVER (PARTITION BY doc_id) AS end_n
    FROM (SELECT *, min(n) FILTER (contains(line, '{title}')) OVER (PARTITION BY doc_id) AS start_n FROM lines)
  )
  WHERE n > start_n AND (end_n IS NULL OR n < end_n) AND NOT contains(line, '{title}')
    AND regexp_matches(split_part(line, ' ', 1), '{FIRST_WORD}')"""


LINES = """
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents
)"""


SECTION_ROWS = f"""WITH {LINES}, rows AS (
  {_section_sql(*TITLES)} UNION ALL {_section_sql(*TITLES[::-1])}
) SELECT doc_id, section, {", ".join(f"t[{i + 1}] AS {w}" for i, w in enumerate(WORDS))}
FROM rows WHERE len(t) >= {len(WORDS)}"""


@query(SECTION_ROWS)
def section_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = model.table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.extract_section_rows(docs, "text", TITLES, FIRST_WORD, WORDS)


@query(SECTION_ROWS)
def section_rows_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows of texts that come in chunks of 300 characters, cut inside lines and words."""
    docs = model.table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", "text")
    starts = F.sequence(F.lit(0), F.greatest(F.length("text") - 1, F.lit(0)), F.lit(300))
    cut = docs.select("doc_id", F.posexplode(F.transform(starts, lambda a: F.substr(F.col("text"), a + 1, F.lit(300)))).alias("chunk_no", "text"))
    return text.extract_chunked_section_rows(cut, titles=TITLES, row_pattern=FIRST_WORD, headers=WORDS)


SPAN = ("the ", "License")
SENTENCE = {"first": "[A-Z][a-z]+", "second": "[a-z]+", "rest": "[A-Za-z ,.]+"}


@query(f"""WITH tails AS (
  SELECT doc_id, substring(text, strpos(text, '{SPAN[0]}')) AS tail FROM documents WHERE contains(text, '{SPAN[0]}')
), spans AS (
  SELECT doc_id, CASE WHEN contains(tail, '{SPAN[1]}') THEN left(tail, strpos(tail, '{SPAN[1]}') - 1) ELSE tail END AS span FROM tails
), lines AS (SELECT doc_id, unnest(string_split(span, chr(10))) AS line FROM spans)
SELECT doc_id, {", ".join(f"regexp_extract(line, '{text.line_pattern(SENTENCE)}', {i + 1}) AS {n}" for i, n in enumerate(SENTENCE))}
FROM lines WHERE regexp_matches(line, '{text.line_pattern(SENTENCE)}')""")
def pattern_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = model.table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.extract_pattern_rows(docs, "text", *SPAN, SENTENCE)


LINKS = """
links AS (
  SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS link_no
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs FROM pages)
),
full_links AS (
  SELECT page_id, CAST(link_no AS INTEGER) AS link_no, href,
    CASE WHEN href[1] = '/' AND href[2] <> '/' THEN regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || href ELSE href END AS link
  FROM links
)"""


@query(f"WITH {LINKS} SELECT * FROM full_links")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract_links(model.table(spark, sf_dir, "pages"))
    return found.select("page_id", "link_no", "href", "link")


@query(f"""WITH {LINKS} SELECT p.page_id, href, link
FROM pages p LEFT JOIN full_links l ON p.page_id = l.page_id AND link_no = 0""")
def page_first_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.first_container_link(model.table(spark, sf_dir, "pages"), "nav")
    return found.select("page_id", "href", "link")


@query("""SELECT page_id, hrefs[1] AS menu_href, hrefs[-1] AS file_href
FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs FROM pages)""")
def page_class_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lookups by class: a link inside a container, and a link that has the class itself."""
    menu = F.replace(F.col("html"), F.lit("<nav>"), F.lit('<nav class="menu main">'))
    marked = F.regexp_replace(menu, "<a (href=[^>]*>[^<]*</a></li></ul>)", "<a class='file pdf' $1")
    docs = model.table(spark, sf_dir, "pages").select("page_id", "url", marked.alias("html"))
    in_menu = pages.first_container_link(docs.withColumn("menu", F.col("html")), "nav", "main", html="menu")
    kept = in_menu.select("page_id", F.col("href").alias("menu_href"), "html")
    return pages.first_classed_link(kept, "pdf").select("page_id", "menu_href", F.col("href").alias("file_href"))


HOPS = """
parts AS (
  SELECT page_id, url, regexp_extract(url, '^([a-z]+:)', 1) AS scheme, regexp_extract(url, '^[a-z]+:(//[^/?#]+)', 1) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '([?][^#]*)', 1) AS query,
    regexp_extract_all(html, '<a href="([^"]*)">', 1)[-1] AS last_href FROM pages
),
files AS (
  SELECT scheme || host || path || query AS address, min(page_id) AS report_id,
    arg_min(scheme || host || last_href, page_id) AS file_link FROM parts GROUP BY address
),
entries AS (
  SELECT p.page_id, CASE p.page_id % 5
      WHEN 0 THEN upper(q.scheme) || upper(q.host) || ':' || if(q.scheme = 'http:', '80', '443') || '/./x/..' || q.path || q.query || '#part'
      WHEN 1 THEN q.host || q.path || q.query
      WHEN 2 THEN '../../../..' || q.path || q.query
      WHEN 3 THEN '?page=2&ref=x' END AS href,
    CASE p.page_id % 5
      WHEN 0 THEN q.scheme || q.host || q.path || q.query
      WHEN 1 THEN p.scheme || q.host || q.path || q.query
      WHEN 2 THEN p.scheme || p.host || q.path || q.query
      WHEN 3 THEN p.scheme || p.host || p.path || '?page=2&ref=x' END AS address
  FROM parts p JOIN parts q ON q.page_id = p.page_id - p.page_id % 10
)"""


@query(f"""WITH {HOPS}
SELECT page_id, href, e.address, report_id, file_link FROM entries e LEFT JOIN files f ON e.address = f.address""")
def page_two_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an entry page over the first link of its menu to a report page, and to the file that page links to.

    Ten pages each link to the first of them, in the ways that links are written: in full with capitals, the
    scheme's port and dot segments, without a scheme, up from the page's folder, as a query alone, or not at all.
    """
    table = model.table(spark, sf_dir, "pages")
    scheme, host, path, part = (F.regexp_extract("url", p, 1) for p in ("^([a-z]+:)", "^[a-z]+:(//[^/?#]+)", "^[a-z]+://[^/?#]+([^?#]*)", "([?][^#]*)"))
    port = F.when(scheme == "http:", ":80").otherwise(":443")
    goals = table.filter("page_id % 10 = 0").select(
        F.col("page_id").alias("_first"),
        F.concat(F.upper(scheme), F.upper(host), port, F.lit("/./x/.."), path, part, F.lit("#part")).alias("_full"),
        F.concat(host, path, part).alias("_host"),
        F.concat(F.lit("../../../.."), path, part).alias("_up"),
    )
    kind = F.col("page_id") % 5
    way = F.when(kind == 0, F.col("_full")).when(kind == 1, F.col("_host")).when(kind == 2, F.col("_up")).when(kind == 3, F.lit("?page=2&ref=x"))
    menu = F.concat(F.lit("<nav class='top'><a"), F.coalesce(F.concat(F.lit(' href="'), F.replace(way, F.lit("&"), F.lit("&amp;")), F.lit('"')), F.lit("")), F.lit(">m</a></nav>"))
    asking = table.select("page_id", "url", (F.col("page_id") - F.col("page_id") % 10).alias("_first"))
    entries = asking.join(goals, "_first").select("page_id", "url", menu.alias("html"))
    links = pages.first_container_link(entries, "nav", "top").select("page_id", "href", "link")
    marked = F.regexp_replace("html", "<a (href=[^>]*>[^<]*</a></li></ul>)", "<a class='file' $1")
    files = pages.first_classed_link(table.select("page_id", "url", marked.alias("html")), "file")
    reports = files.select(F.col("page_id").alias("report_id"), "url", pages.absolute(F.col("href"), F.col("url")).alias("file_link"))
    found = pages.follow_links(links, reports, "link", "url", "report_id")
    return found.select("page_id", "href", "address", "report_id", "file_link")


# --- payloads ------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN source = 'src0' THEN 'empty_symbol' WHEN text IS NULL THEN 'no_answer'
  WHEN contains(text, 'All rights reserved') THEN 'rate_limited' ELSE 'usable' END AS payload_status FROM documents""")
def payload_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbol = F.when(F.col("source") == "src0", "").otherwise(F.col("source"))
    docs = model.table(spark, sf_dir, "documents").select("doc_id", symbol.alias("symbol"), "text")
    return payloads.gate_payloads(docs, marker="All rights reserved").select("doc_id", "payload_status")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines, narrow as they are, over all tasks before texts are made of them and parsed."""
    columns = [*LINE_KEY, "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
    return model.table(spark, sf_dir, "lineitem").select(*columns).repartition(*LINE_KEY)


def _price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-line CSV payload per order line; every other one is oldest first."""

    def row(day: Column, price: str) -> Column:
        cells = [day.cast("string"), *[F.col(c).cast("string") for c in (price, price, price, price)]]
        return F.concat_ws(",", *cells, F.col("l_quantity").cast("bigint").cast("string"))

    day = F.col("l_shipdate").cast("date")
    new, old = row(day, "l_extendedprice"), row(F.date_sub(day, 1), "l_quantity")
    header = F.lit("timestamp,open,high,low,close,volume")
    body = F.when(F.col("l_returnflag") == "N", F.concat_ws("\n", header, old, new)).otherwise(
        F.concat_ws("\r\n", header, new, old, F.lit(""))
    )
    lines = model.table(spark, sf_dir, "lineitem")
    return evaluate_once(lines, text=body).select(*LINE_KEY, "text")


@query(f"""SELECT {", ".join(LINE_KEY)}, CAST(l_shipdate AS DATE) AS "timestamp", l_extendedprice AS "open",
  l_extendedprice AS high, l_extendedprice AS low, l_extendedprice AS "close", CAST(l_quantity AS BIGINT) AS volume FROM lineitem""")
def payload_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.parse_price_payloads(_price_payloads(spark, sf_dir), daily=True)


@query(f"""SELECT {", ".join(LINE_KEY)}, CAST(l_shipdate AS DATE) AS "timestamp", l_extendedprice AS "close" FROM lineitem
UNION ALL SELECT {", ".join(LINE_KEY)}, CAST(l_shipdate AS DATE) - 1, l_quantity FROM lineitem""")
def payload_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = payloads.parse_price_payloads(_price_payloads(spark, sf_dir))
    return rows.select(*LINE_KEY, "timestamp", "close")


REFUSED = f"note\n{payloads.QUOTA_MARKER}"
ERROR_BODY = '{\n"Error Message": "no such call"\n}'
ONE_LINE_ERROR = '{"Error Message": "no such call"}'


@query(f"""SELECT {", ".join(LINE_KEY)}, CAST(l_shipdate AS DATE) AS "timestamp", l_extendedprice AS "close",
  CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reject_reason FROM lineitem WHERE l_linenumber < 5
UNION ALL SELECT {", ".join(LINE_KEY)}, CAST(l_shipdate AS DATE) - 1, l_quantity, NULL, NULL FROM lineitem WHERE l_linenumber < 5
UNION ALL SELECT {", ".join(LINE_KEY)}, NULL, NULL, line, reason FROM lineitem, (VALUES
  (5, 0, 'note', 'rate_limited'), (5, 1, '{payloads.QUOTA_MARKER}', 'rate_limited'),
  (6, 0, '"Error Message": "no such call"', 'corrupt_line'), (6, 0, '{"}"}', 'corrupt_line'),
  (6, 1, '{ONE_LINE_ERROR}', 'corrupt_body'), (7, 0, NULL, 'corrupt_body'), (7, 1, NULL, 'no_answer'))
  AS r(n, kind, line, reason) WHERE l_linenumber = n AND l_orderkey % 2 = kind""")
def payload_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows and refusals of payloads among which are quota notices, errors of one and more lines, empty ones and nulls."""
    no, odd = F.col("l_linenumber"), F.col("l_orderkey") % 2 == 1
    body = (
        F.when(no == 5, F.when(odd, payloads.QUOTA_MARKER).otherwise(REFUSED))
        .when(no == 6, F.when(odd, ONE_LINE_ERROR).otherwise(ERROR_BODY))
        .when(no == 7, F.when(~odd, " \n"))
        .otherwise(F.col("text"))
    )
    answers = _price_payloads(spark, sf_dir).withColumn("text", body)
    nothing = F.lit(None).cast("string")
    good = payloads.parse_price_payloads(answers).select(
        *LINE_KEY, "timestamp", "close", nothing.alias("line"), nothing.alias("reject_reason")
    )
    return good.unionByName(payloads.rejected_price_lines(answers), allowMissingColumns=True)


@query("""SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ticker,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price, 'US' AS market,
  strftime(l_shipdate, '%Y-%m-%d') AS date
FROM lineitem WHERE l_returnflag <> 'N' AND l_linenumber <> 7""")
def series_json_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of flag N are errors, those of line 7 name a day they do not hold."""
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    named = F.when(F.col("l_linenumber") == 7, "1970-01-01").otherwise(day)
    older = F.date_format(F.date_sub(F.col("l_shipdate").cast("date"), 1), "yyyy-MM-dd")
    close = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    series = F.concat(
        F.lit('{"Meta Data": {"1. Information": "daily", "3. Last Refreshed": "'),
        named,
        F.lit('"}, "Time Series (Daily)": {"'),
        older,
        F.lit('": {"1. open": "1.0"}, "'),
        day,
        F.lit('": {"1. open": "2.0", "4. close": "'),
        close,
        F.lit('"}}}'),
    )
    error = F.lit('{"Error Message": "Invalid API call"}')
    payload = F.when(F.col("l_returnflag") == "N", error).otherwise(series)
    rows = evaluate_once(_spread_lines(spark, sf_dir), symbol=F.concat_ws("-", *LINE_KEY), payload=payload)
    return payloads.latest_from_series_json(rows)


@query("""SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events""")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.table(spark, sf_dir, "events").select(
        "event_id",
        landing.json_field("props", "$.k", "bigint").alias("k"),
        landing.json_field("props", "$.absent", "string").alias("absent"),
    )


@query(f"""SELECT {", ".join(LINE_KEY)}, CASE l_returnflag WHEN 'N' THEN 'daily' ELSE 'backfill' END AS mode,
  CASE WHEN p_size % 2 = 0 THEN 'US' ELSE 'AR' END AS country, p_brand AS exchange, p_name AS symbol,
  CAST(l_shipdate AS DATE) AS run_date
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def landing_path_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = model.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_size"
    )
    path = landing.landing_path(
        F.when(F.col("l_returnflag") == "N", "daily").otherwise("backfill"),
        F.lit("prices"),
        F.when(F.col("p_size") % 2 == 0, "US").otherwise("AR"),
        F.col("p_brand"),
        F.col("p_name"),
        F.date_format("l_shipdate", "yyyy-MM-dd"),
    )
    lines = model.table(spark, sf_dir, "lineitem").join(part, "l_partkey")
    parsed = landing.parse_landing_path(lines.select(*LINE_KEY, path.alias("path")))
    return parsed.select(*LINE_KEY, "mode", "country", "exchange", "symbol", "run_date")


# --- bond reports --------------------------------------------------------


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report text per order line, its numbers and dates in report notation.

    Lines of flag N stand in the second section, the others in the first. Line number 5 has
    a corrupt rate, number 6 one token too few, number 7 one too many.
    """

    def number(col: Column) -> Column:
        return F.translate(F.format_number(col.cast("decimal(18,2)"), 2), ",.", ".,")

    def percent(col: Column) -> Column:
        return F.concat(number(col), F.lit("%"))

    def day(offset: int) -> Column:
        return F.date_format(F.date_add(F.col("l_shipdate").cast("date"), offset), "d-MMM-yy")

    no = F.col("l_linenumber")
    spanish = F.replace(F.replace(day(30), F.lit("-Jan-"), F.lit("-ene-")), F.lit("-Aug-"), F.lit("-ago-"))
    cells = evaluate_once(
        _spread_lines(spark, sf_dir),
        ticker=F.concat(F.lit("S"), (F.col("l_suppkey") % 90 + 10).cast("string"), F.lit("E5")),
        issue=day(0),
        payment=day(30),
        payment_es=spanish,
        close=day(1),
        settle=day(2),
        amount=number(F.col("l_extendedprice")),
        lot=number(F.col("l_quantity")),
        discount=percent(F.col("l_discount") * 100),
        tax=percent(F.col("l_tax") * 100),
    )
    lot_rate, duration = F.concat("lot", F.lit("%")), F.col("l_orderkey").cast("string")
    row = F.concat_ws(
        " ",
        "ticker",
        "issue",
        "payment_es",
        F.lit("30"),
        "amount",
        F.when(no == 5, F.lit("#DIV/0!")).otherwise(F.col("discount")),
        "close",
        "settle",
        "lot",
        "tax",
        "discount",
        "tax",
        lot_rate,
        F.when(no != 6, duration),
        F.when(no == 7, F.lit("extra")),
    )
    dual = F.concat_ws(
        " ", "ticker", "issue", "payment", F.lit("30"), "amount", "close", "lot", "discount", "tax",
        lot_rate, "tax", duration,
    )
    second = F.col("l_returnflag") == "N"
    lines = F.concat_ws(
        "\n",
        F.lit("Daily report"),
        F.lit(text.LECAP_TITLE),
        F.lit("Ticker Issue Payment"),
        F.when(second, F.lit(" S10E5 a line that starts with a blank")).otherwise(row),
        F.lit(text.BONCAP_TITLE),
        F.when(second, row).otherwise(F.lit("no rows today")),
        F.lit(text.DUAL_START),
        dual,
        F.lit(text.DUAL_END),
        dual,
    )
    reports = evaluate_once(cells, text=lines)
    return reports.select(*LINE_KEY, "text")


def _typed_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.extract_section_rows(_reports(spark, sf_dir))
    good, _ = quality.split_quarantine(bonds.type_bond_rows(rows))
    return good


BOND_LINES = f"""
bond_lines AS (
  SELECT *, 'S' || CAST(l_suppkey % 90 + 10 AS VARCHAR) || 'E5' AS ticker_symbol,
    CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(38,9)) AS amount,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(38,9)) AS discount,
    CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(38,9)) AS tax, CAST(l_quantity AS DECIMAL(38,9)) AS lot
  FROM lineitem WHERE l_linenumber NOT IN (5, 6)
),
keyed AS (SELECT *, {model.KEY_SQL.format("ticker_symbol || '|byma'")} AS asset_key FROM bond_lines)"""


@query(f"""WITH {BOND_LINES}
SELECT asset_key, ticker_symbol, d AS issue_date, d + 30 AS payment_date, amount AS amount_at_payment, discount AS rate,
  CASE WHEN l_returnflag = 'N' THEN 'BONCAP' ELSE 'LECAP' END AS type FROM keyed""")
def fixed_income_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bonds.to_fixed_income(_typed_bonds(spark, sf_dir))


@query(f"""WITH {BOND_LINES}
SELECT asset_key, ticker_symbol, d + 1 AS snapshot_date, TIMESTAMP '{model.INGESTED_AT}' AS ingestion_timestamp,
  amount AS maturity_value, discount AS action_rate, lot AS price_per_100_nominal_value, tax AS period_yield,
  discount AS annual_percentage_rate, tax AS effective_annual_rate, lot AS effective_monthly_rate,
  l_orderkey AS modified_duration_in_days FROM keyed""")
def fixed_income_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = bonds.to_fixed_income_daily(_typed_bonds(spark, sf_dir), model.ingested_at())
    return daily.withColumn("ingestion_timestamp", model.ntz("ingestion_timestamp"))


@query(f"""SELECT {", ".join(LINE_KEY)}, CASE WHEN l_returnflag = 'N' THEN 'BONCAP' ELSE 'LECAP' END AS type,
  'bad_rate' AS reject_reason FROM lineitem WHERE l_linenumber = 5""")
def fixed_income_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.extract_section_rows(_reports(spark, sf_dir))
    _, rejected = quality.split_quarantine(bonds.type_bond_rows(rows))
    kind = bonds.instrument_type(F.col("section")).alias("type")
    return rejected.select(*LINE_KEY, kind, "reject_reason")


@query(f"""SELECT {", ".join(LINE_KEY)}, 'S' || CAST(l_suppkey % 90 + 10 AS VARCHAR) || 'E5' AS bono,
  strftime(l_shipdate, '%-d-%b-%y') AS fecha_emision, '30' AS plazo_vto,
  translate(format('{{:,.2f}}', l_extendedprice), ',.', '.,') AS monto_vto, CAST(l_orderkey AS VARCHAR) AS dm FROM lineitem""")
def dual_bond_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.extract_pattern_rows(_reports(spark, sf_dir))
    return rows.select(*LINE_KEY, "bono", "fecha_emision", "plazo_vto", "monto_vto", "dm")
