"""Links out of HTML pages, row by row, and the pages they lead to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_ANCHOR = r"(?is)<a\b[^>]*>"
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_ADDRESS = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?\z"
_PART_NAMES = ("scheme", "authority", "path", "query", "fragment")


def visible_markup(html: Column) -> Column:
    """The page without comments and scripts, where markup is not markup."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>", "")


def href_of(tag: Column) -> Column:
    """The href of a start tag, null if it has none."""
    quoted = F.concat(*[F.regexp_extract(tag, _HREF, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(_HREF), F.replace(quoted, F.lit("&amp;"), F.lit("&")))


def absolute(href: Column, url: Column) -> Column:
    """The address a link of a page means, by the rules of RFC 3986 (5.2): the link's own parts, the page's for the rest.

    Known are links with a scheme, without one (``//host/x``), from the root, from the page's folder, of a query or a
    fragment only, and empty ones; dot segments go, but for those of a page's path that is taken over whole. A link with a scheme but no path from the root (``mailto:x``)
    stays as it is. Null if either is null, or if the link needs a page's address that has no scheme.
    """
    own, page = _parts(href), _parts(url)
    folder = F.when((page["authority"] != "") & (page["path"] == ""), F.lit("/")).otherwise(
        F.regexp_extract(page["path"], r"(?s)^(.*/)", 1)
    )
    rooted = own["path"].startswith("/")
    far = (own["scheme"] != "") | (own["authority"] != "")
    walked = without_dots(F.when(far | rooted, own["path"]).otherwise(F.concat(folder, own["path"])))
    path = F.when(~far & (own["path"] == ""), page["path"]).otherwise(walked)
    query = F.when(~far & (own["path"] == "") & (own["query"] == ""), page["query"]).otherwise(own["query"])
    site = F.when(own["authority"] != "", F.concat(page["scheme"], own["authority"])).otherwise(
        F.concat(page["scheme"], page["authority"])
    )
    site = F.when(own["scheme"] != "", F.concat(own["scheme"], own["authority"])).otherwise(site)
    known = (own["scheme"] != "") | (page["scheme"] != "")
    return F.when(known, F.concat(site, path, query, own["fragment"]))


def _parts(address: Column) -> dict[str, Column]:
    """The five parts of an address with their marks (``http:``, ``//host``, ``/x``, ``?q``, ``#f``); absent ones are empty."""
    return {name: F.regexp_extract(address, _ADDRESS, i + 1) for i, name in enumerate(_PART_NAMES)}


def without_dots(path: Column) -> Column:
    """A path from the root without the segments ``.`` and ``..``; other paths unchanged."""
    # A mark at either end makes all segments alike: a last dot segment leaves its slash.
    ended = F.regexp_replace(path, r"(/\.\.?)\z", "$1/")
    start = F.array().cast("array<string>")

    def step(kept: Column, segment: Column) -> Column:
        parent = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(segment == "..", parent).when(segment == ".", kept).otherwise(F.concat(kept, F.array(segment)))

    segments = F.split(F.substr(ended, F.lit(2)), "/", -1)
    walked = F.concat(F.lit("/"), F.array_join(F.aggregate(segments, start, step), "/"))
    return F.when(path.rlike(r"(?s)^/(.*/)?\.\.?(/|\z)"), walked).otherwise(path)


def normal_address(address: Column) -> Column:
    """One spelling for addresses that are the same by RFC 3986 (6.2), without the fragment.

    Scheme and host are lower-cased, the scheme's own port goes, escapes are upper-cased and those of letters,
    digits and ``-._~`` undone, dot segments go and an empty path after a host becomes ``/``.
    """
    part = _parts(address)
    scheme = F.lower(part["scheme"])
    login = F.regexp_extract(part["authority"], r"^//([^@]*@)", 1)
    host = F.lower(F.regexp_replace(part["authority"], r"^//([^@]*@)?", ""))
    host = F.when(scheme == "http:", F.regexp_replace(host, r":(80)?$", "")).when(
        scheme == "https:", F.regexp_replace(host, r":(443)?$", "")
    ).otherwise(F.regexp_replace(host, r":$", ""))
    site = F.when(part["authority"] != "", F.concat(F.lit("//"), login, host)).otherwise(F.lit(""))
    path = F.when((part["authority"] != "") & (part["path"] == ""), F.lit("/")).otherwise(part["path"])
    return F.concat(scheme, site, without_dots(_plain_escapes(path)), _plain_escapes(part["query"]))


def _plain_escapes(text: Column) -> Column:
    """Percent escapes in upper case, those of unreserved characters as the character."""

    def piece(x: Column, i: Column) -> Column:
        code = F.upper(F.substring(x, 1, 2))
        letter = F.char(F.conv(code, 16, 10).cast("bigint"))
        rest = F.substr(x, F.lit(3))
        escaped = F.when(letter.rlike(r"^[A-Za-z0-9\-._~]$"), F.concat(letter, rest)).otherwise(F.concat(F.lit("%"), code, rest))
        return F.when(i == 0, x).when(x.rlike("^[0-9A-Fa-f]{2}"), escaped).otherwise(F.concat(F.lit("%"), x))

    return F.when(F.contains(text, F.lit("%")), F.array_join(F.transform(F.split(text, "%", -1), piece), "")).otherwise(text)


def follow_links(links: DataFrame, pages: DataFrame, link: str, url: str, page_id: str) -> DataFrame:
    """Every row of ``links`` with the columns of the page that its link leads to, null where there is none.

    ``pages`` should be narrow: take out of a page what is needed before it is joined. Link and address are compared
    in their normal spelling; of pages with one address the smallest id counts. Links without an
    address get a key of their own, so that they do not meet in one task; a page that very many links
    lead to is one row on the right, and adaptive execution cuts the left side.
    """
    address = normal_address(F.col(url))
    named = pages.filter(address.isNotNull()).select(address.alias("_address"), F.struct(*pages.columns).alias("_page"))
    by_address = named.groupBy("_address").agg(F.min_by("_page", F.col("_page")[page_id]).alias("_page"))
    goal = normal_address(F.col(link))
    nowhere = F.concat(F.lit(" "), F.xxhash64(*links.columns).cast("string"))  # no address begins with a blank
    asked = links.select("*", goal.alias("address"), F.coalesce(goal, nowhere).alias("_address"))
    found = asked.join(by_address, "_address", "left")
    return found.select(*links.columns, "address", *[F.col("_page")[c].alias(c) for c in pages.columns])


def extract_links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Every link of every page with its position, relative and absolute."""
    keep = [c for c in pages.columns if c != html]
    tags = F.regexp_extract_all(visible_markup(F.col(html)), F.lit(_ANCHOR), F.lit(0))
    hrefs = F.filter(F.transform(tags, href_of), lambda h: h.isNotNull())
    found = pages.select(*keep, F.posexplode(hrefs).alias("link_no", "href"))
    return found.withColumn("link", absolute(F.col("href"), F.col(url)))


def first_container_link(
    pages: DataFrame,
    tag: str,
    css_class: str | None = None,
    html: str = "html",
    url: str = "url",
) -> DataFrame:
    """The first link inside the first container of a kind (null if there is none).

    The container ends at its own closing tag: nested containers of the same tag are
    counted, not guessed. If its first anchor has no href there is no link.
    """
    attr = _class_test(css_class)
    opening = rf"(?is)<{tag}\b{attr}[^>]*>"
    edge = rf"(?is)(?=<{tag}\b|</{tag}\s*>)"
    body = visible_markup(F.col(html))
    inside = F.try_element_at(F.split(body, opening, 2), F.lit(2))
    start = F.struct(F.lit(1).alias("depth"), F.lit(None).cast("string").alias("anchor"))

    def step(acc: Column, piece: Column) -> Column:
        depth = (
            acc["depth"]
            + F.when(piece.rlike(rf"(?is)^<{tag}\b"), 1).otherwise(0)
            - F.when(piece.rlike(rf"(?is)^</{tag}\s*>"), 1).otherwise(0)
        )
        here = F.regexp_extract(piece, _ANCHOR, 0)
        # Once the container is closed the depth stays at zero, whatever follows.
        depth = F.when(acc["depth"] > 0, depth).otherwise(F.lit(0))
        anchor = F.coalesce(acc["anchor"], F.when((depth > 0) & (here != ""), here))
        return F.struct(depth.alias("depth"), anchor.alias("anchor"))

    anchor = F.aggregate(F.split(inside, edge), start, step)["anchor"]
    keep = [c for c in pages.columns if c != html]
    linked = pages.select(*keep, href_of(anchor).alias("href"))
    return linked.withColumn("link", absolute(F.col("href"), F.col(url)))


def first_classed_link(
    pages: DataFrame, css_class: str, html: str = "html", url: str = "url"
) -> DataFrame:
    """The first link that has a class, as written."""
    pattern = rf"(?is)<a\b{_class_test(css_class)}[^>]*>"
    tag = F.regexp_extract(visible_markup(F.col(html)), pattern, 0)
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, href_of(F.when(tag != "", tag)).alias("href"))


def _class_test(css_class: str | None) -> str:
    """Look-ahead for a tag's class attribute: the exact value or one of its words."""
    if css_class is None:
        return ""
    word = r"\Q" + css_class + r"\E"
    return (
        rf"""(?=[^>]*\bclass\s*=\s*(?:"(?:[^">]*\s)?{word}(?:\s[^">]*)?\""""
        rf"""|'(?:[^'>]*\s)?{word}(?:\s[^'>]*)?'|{word}(?=[\s>])))"""
    )
