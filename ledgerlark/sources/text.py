"""Rows out of report text: inside one document's row without a shuffle, or over the chunks of documents of any length."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlark.functions.scalars import WS

# Fixed values -----------------------------------------------------------
LECAP_TITLE = "LETRAS DEL TESORO CAPITALIZABLES EN PESOS (LECAP)"
BONCAP_TITLE = "BONOS DEL TESORO CAPITALIZABLES EN PESOS (BONCAP)"
BOND_TITLES = (LECAP_TITLE, BONCAP_TITLE)
DUAL_START = "BONOS DUALES"
DUAL_END = "2 - Índice Caución BYMA"
INSTRUMENT = r"^[A-Z]{1,4}[0-9]{1,2}[A-Z][0-9]{1,2}"
BOND_HEADERS = (
    "ticker_symbol",
    "fecha_emision",
    "fecha_pago",
    "plazo_vencimiento_dias",
    "monto_al_vencimiento",
    "tasa_de_liquidacion",
    "fecha_cierre",
    "fecha_liquidacion",
    "precio_vn_100",
    "rendimiento_periodo",
    "tna",
    "tea",
    "tem",
    "dm_dias",
)
_DATE = r"[0-9]{1,2}-[A-Za-z]{3}-[0-9]{2,4}"
_NUMBER = r"[0-9,.]+"
_PERCENT = r"[0-9.,]+%"
DUAL_FIELDS = {
    "bono": r"[A-Z]{1,4}[0-9]{1,2}[A-Z][0-9]{1,2}",
    "fecha_emision": _DATE,
    "fecha_pago": _DATE,
    "plazo_vto": r"[0-9]+",
    "monto_vto": _NUMBER,
    "fecha": _DATE,
    "cotiz": _NUMBER,
    "tem_fija": _PERCENT,
    "tem_tamar": _PERCENT,
    "spread": _PERCENT,
    "tir": _PERCENT,
    "dm": r"[0-9]+",
}
# ------------------------------------------------------------------------


def line_pattern(fields: dict[str, str]) -> str:
    """A whole-line regular expression: the fields as groups, white space between."""
    return "^" + f"{WS}+".join(f"({p})" for p in fields.values()) + "$"


def extract_section_rows(
    docs: DataFrame,
    text: str = "text",
    titles: Sequence[str] = BOND_TITLES,
    row_pattern: str = INSTRUMENT,
    headers: Sequence[str] = BOND_HEADERS,
) -> DataFrame:
    """Table rows under section titles, one output row per table row.

    A section starts after the first line that holds its title and ends at the first later
    line that holds another title (and not its own). A line is a row if its first
    space-separated token matches ``row_pattern`` and it has at least ``len(headers)``
    tokens; further tokens are dropped. Lines stay an array inside the document row, so a
    document is parsed where it was read.
    """
    keep = [c for c in docs.columns if c != text]
    # Documents without any title end here.
    titled = docs.filter(reduce(lambda a, b: a | b, [_has(t)(F.col(text)) for t in titles]))
    lines = titled.select(*keep, F.split(F.col(text), "\n").alias("_lines"))
    return _rows_of_sections(_with_sections(lines, titles), keep, titles, row_pattern, headers)


def extract_chunked_section_rows(
    chunks: DataFrame,
    doc: str = "doc_id",
    chunk_no: str = "chunk_no",
    text: str = "text",
    titles: Sequence[str] = BOND_TITLES,
    row_pattern: str = INSTRUMENT,
    headers: Sequence[str] = BOND_HEADERS,
) -> DataFrame:
    """The rows of :func:`extract_section_rows`, of documents that come in numbered chunks, cut anywhere.

    No document has to fit a row or a task. Each chunk keeps the whole lines between its first and last line break; the
    pieces of a line that chunks cut are put together by the number of chunks with a line break before them. For each
    title such a run of lines maps the state before it (not begun, inside, over) to the state after it. States
    only grow, so the maps compose to two positions of a document and title, both partial minima: the
    first run that begins the section, and the first that ends it after that.
    Only a single line, and the list of a document's chunk numbers, must fit a task. A null text is an empty chunk; a
    null document is a document like any other. Chunk numbers are unique in a document. Runs are made
    anew for each of three passes: first begin, first end, rows.
    """
    same_doc = F.col(f"l.{doc}").eqNullSafe(F.col(f"r.{doc}"))
    breaks = F.contains(F.col(text), F.lit("\n"))
    whole = chunks.select(doc, chunk_no, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # The window sees numbers and a flag only.
    before = F.sum(F.col("_broken").cast("bigint")).over(Window.partitionBy(doc).orderBy(chunk_no))
    numbered = chunks.select(doc, chunk_no, F.coalesce(breaks, F.lit(False)).alias("_broken")).withColumn("_no", before)
    joined = whole.alias("l").join(numbered.alias("r"), same_doc & (F.col(f"l.{chunk_no}") == F.col(f"r.{chunk_no}")))
    placed = joined.select(F.col(f"l.{doc}").alias(doc), F.col(f"l.{chunk_no}").alias(chunk_no), "_broken", "_no", F.split("_text", "\n").alias("_all"))

    # Run 2k is the inside of the k-th chunk with a line break, run 2k + 1 the line from there to the next such chunk.
    size = F.size("_all")
    inner = placed.filter("_broken").select(doc, (2 * F.col("_no")).alias("_run"), F.slice("_all", F.lit(2), size - 2).alias("_lines"))
    head = F.struct((F.col("_no") - F.col("_broken").cast("int")).alias("no"), F.col("_all")[0].alias("piece"))
    tail = F.struct(F.col("_no").alias("no"), F.element_at("_all", -1).alias("piece"))
    pieces = placed.select(doc, chunk_no, F.posexplode(F.when(F.col("_broken"), F.array(head, tail)).otherwise(F.array(head))).alias("_at", "_p"))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(chunk_no, "_at", F.col("_p.piece").alias("piece")))), lambda x: x["piece"]), "")
    seams = pieces.groupBy(doc, (2 * F.col("_p.no") + 1).alias("_run")).agg(F.array(line).alias("_lines"))
    runs = inner.unionByName(seams)

    numbers = list(enumerate(titles))
    begins = [F.min(F.when(F.exists("_lines", _has(t)), F.col("_run"))).alias(f"_begin{i}") for i, t in numbers]
    begun = _beside(runs, runs.groupBy(doc).agg(*begins), doc)
    after_title = _with_sections(begun, titles)
    stops = []
    for i, t in numbers:
        later = (F.col("_run") > F.col(f"_begin{i}")) & F.exists("_lines", _has_other(t, titles))
        own = (F.col("_run") == F.col(f"_begin{i}")) & (F.col(f"_end{i}") > 0)
        stops.append(F.min(F.when(later | own, F.col("_run"))).alias(f"_stop{i}"))
    stopped = _beside(begun, after_title.groupBy(doc).agg(*stops), doc)

    # What a run's lines are to a title: all before the section, all inside it up to its end, or all behind it.
    inside = {
        i: (F.col("_run") > F.col(f"_begin{i}")) & (F.col(f"_stop{i}").isNull() | (F.col("_run") <= F.col(f"_stop{i}")))
        for i, _ in numbers
    }
    touched = reduce(lambda a, b: a | b, [inside[i] | (F.col("_run") == F.col(f"_begin{i}")) for i, _ in numbers])
    begins_here = {i: F.col("_run") == F.col(f"_begin{i}") for i, _ in numbers}
    sections = _with_sections(stopped.filter(touched), titles, inside, begins_here)
    return _rows_of_sections(sections, [doc], titles, row_pattern, headers)


def _beside(rows: DataFrame, facts: DataFrame, doc: str) -> DataFrame:
    """Rows with what is known of their document; a document without a number is one too."""
    found = rows.alias("l").join(facts.alias("r"), F.col(f"l.{doc}").eqNullSafe(F.col(f"r.{doc}")))
    return found.select("l.*", *[F.col(f"r.{c}") for c in facts.columns if c != doc])


def _has(title: str) -> Callable[[Column], Column]:
    return lambda line: F.contains(line, F.lit(title))


def _has_other(title: str, titles: Sequence[str]) -> Callable[[Column], Column]:
    others = [_has(t) for t in titles if t != title]
    return lambda line: reduce(lambda a, h: a | h(line), others, F.lit(False)) & ~_has(title)(line)


def _with_sections(
    lines: DataFrame,
    titles: Sequence[str],
    inside: dict[int, Column] | None = None,
    begins: dict[int, Column] | None = None,
) -> DataFrame:
    """Rows with ``_lines`` and, by title, the lines after it (``_tail``) and which of them ends the section (``_end``).

    Where ``inside`` holds, the section has begun before the first line; where ``begins`` does not, it does not begin.
    """
    # Each step is a column of its own, so that no step is evaluated twice.
    numbered = list(enumerate(titles))
    starts = lines.select(
        "*",
        *[
            F.array_position(F.transform("_lines", _has(t)), True).cast("int").alias(f"_start{i}")
            for i, t in numbered
        ],
    )

    def tail(i: int) -> Column:
        begun = F.col(f"_start{i}") > 0
        here = F.slice("_lines", F.col(f"_start{i}") + 1, F.size("_lines"))
        after = F.when(begun if begins is None else begun & begins[i], here)
        return after if inside is None else F.when(inside[i], F.col("_lines")).otherwise(after)

    tails = starts.select("*", *[tail(i).alias(f"_tail{i}") for i, _ in numbered])
    return tails.select(
        "*",
        *[
            F.array_position(F.transform(f"_tail{i}", _has_other(t, titles)), True).cast("int").alias(f"_end{i}")
            for i, t in numbered
        ],
    )


def _rows_of_sections(
    ends: DataFrame, keep: Sequence[str], titles: Sequence[str], row_pattern: str, headers: Sequence[str]
) -> DataFrame:
    def row_tokens(lines: Column, title: str) -> Column:
        rows = F.filter(
            lines,
            lambda x: ~_has(title)(x) & F.substring_index(x, " ", 1).rlike(row_pattern),
        )
        # A literal split is cheap; the white-space class is compiled once by regexp_replace.
        single = F.transform(rows, lambda x: F.regexp_replace(x, f"{WS}+", " "))
        tokens = F.transform(single, lambda x: F.filter(F.split(x, " "), lambda t: t != ""))
        full = F.filter(tokens, lambda t: F.size(t) >= len(headers))
        return F.transform(
            full, lambda t: F.struct(F.lit(title).alias("section"), t.alias("tokens"))
        )

    sections = []
    for i, title in enumerate(titles):
        tail, end = F.col(f"_tail{i}"), F.col(f"_end{i}")
        body = F.when(end > 0, F.slice(tail, 1, end - 1)).otherwise(tail)
        sections.append(F.coalesce(row_tokens(body, title), F.array()))
    return ends.select(*keep, F.explode(F.flatten(F.array(*sections))).alias("_row")).select(
        *keep,
        F.col("_row.section").alias("section"),
        *[F.col("_row.tokens")[i].alias(h) for i, h in enumerate(headers)],
    )


def extract_pattern_rows(
    docs: DataFrame,
    text: str = "text",
    start: str = DUAL_START,
    end: str = DUAL_END,
    fields: dict[str, str] | None = None,
) -> DataFrame:
    """Lines between two markers that match a whole-line pattern, split into its groups.

    The span runs from the first ``start`` marker to the next ``end`` marker or, without
    one, to the end of the text.
    """
    fields = DUAL_FIELDS if fields is None else fields
    pattern = line_pattern(fields)
    keep = [c for c in docs.columns if c != text]
    # Each step is a column of its own, so that no step is evaluated twice.
    found = docs.select(*keep, text, F.locate(start, F.col(text)).alias("_begin"))
    tails = found.filter("_begin > 0").select(*keep, F.substr(text, "_begin").alias("_tail"))
    lines = F.split(F.substring_index("_tail", end, 1), "\n")
    # One replacement puts a line break, which no line has, before every group: the pattern runs once per line, and
    # a line that begins with a break is a row.
    mark = "".join(f"\n${i + 1}" for i in range(len(fields)))
    marked = F.transform(lines, lambda x: F.regexp_replace(x, F.lit(pattern), F.lit(mark)))
    rows = F.filter(marked, lambda x: F.startswith(x, F.lit("\n")))
    return (
        tails.select(*keep, F.explode(rows).alias("_line"))
        .select(*keep, F.split("_line", "\n").alias("_parts"))
        .select(*keep, *[F.col("_parts")[i + 1].alias(n) for i, n in enumerate(fields)])
    )
