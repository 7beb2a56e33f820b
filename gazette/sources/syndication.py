"""Feed documents in XML (RSS 0.9x to 2.0, RSS 1.0, Atom) as feed entries.

A feed is cut into its entries first and each of them is parsed alone, so one that
breaks off, or has one bad entry, still gives the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.rows import computed_once
from gazette.functions.text import as_col

# --- fixed values: names that RSS, Atom and their modules use -----------------
ATOM = "http://www.w3.org/2005/Atom"
ENTRY = (
    "`_rdf:about` string, id string, guid struct<_VALUE string, _isPermaLink string>, "
    "link array<struct<_VALUE string, _href string, _rel string>>, title string, "
    "summary string, description string, content string, `content:encoded` string, "
    "published string, pubDate string, issued string, "
    "updated string, `dc:date` string, modified string"
)
XML_ENTITIES = r"(?:amp|lt|gt|quot|apos|#\d+|#[xX][0-9a-fA-F]+);"
NOT_IN_XML = r"[^\x09\x0a\x0d\x20-\x{d7ff}\x{e000}-\x{fffd}\x{10000}-\x{10ffff}]"

_CDATA = "<![CDATA["
_CDATA_EDGE = r"(?=<!\[CDATA\[)|(?<=\]\]>)"
_WHOLE_ENTRY = r"(?s)<(item|entry)(?=[\s>]).*?</\1\s*>"


def _escaped(c: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


def _plain_markup(piece: Column) -> Column:
    """A piece of a feed without CDATA sections, comments and entities unknown to XML."""
    literal = F.regexp_replace(piece, r"^<!\[CDATA\[|\]\]>$", "")
    markup = F.regexp_replace(piece, r"(?s)<!--.*?-->", "")
    markup = F.regexp_replace(markup, f"&(?!{XML_ENTITIES})", "&amp;")
    return F.when(piece.startswith(_CDATA), _escaped(literal)).otherwise(markup)


def entry_texts(xml: Column | str) -> Column:
    """The whole entries of a feed document, each as XML text of its own."""
    text = F.regexp_replace(as_col(xml), NOT_IN_XML, "")
    pieces = F.transform(F.split(text, _CDATA_EDGE), _plain_markup)
    markup = F.array_join(pieces, "")
    # Atom under a prefix: <a:feed xmlns:a="..."> has <a:entry>.
    prefix = F.regexp_extract(markup, rf"xmlns:([\w.-]+)\s*=\s*[\"']{ATOM}[\"']", 1)
    bare = F.regexp_replace(
        markup, F.concat(F.lit(r"(</?)\Q"), prefix, F.lit(r"\E:(?=\w)")), F.lit("$1")
    )
    root = F.concat(F.lit("<"), prefix, F.lit(":feed"))
    whole = F.when((prefix != "") & markup.contains(root), bare).otherwise(markup)
    return F.regexp_extract_all(whole, F.lit(_WHOLE_ENTRY), F.lit(0))


def _filled(*columns: Column) -> Column:
    """The first that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def feed_entries(feeds: DataFrame, xml: str = "xml", keep: list[str] | None = None) -> DataFrame:
    """One row per entry, as ``normalize_rss`` takes them; ``keep`` are columns of the feed.

    The summary is the entry's summary or description, or else its content. The
    link is the alternate one, or the guid where that is an address. An entry that is
    no XML has only NULLs. Unknown entities stay as they are written, and so does
    a repeated element's last value. Extra columns have to be named in ``keep``.
    """
    keep = keep or []
    cut = feeds.select(*keep, F.explode(entry_texts(xml)).alias("_entry"))
    read = cut.select(*keep, F.from_xml("_entry", ENTRY).alias("_e"))

    def of(name: str) -> Column:
        return F.col("_e").getField(name)

    guid = of("guid").getField("_VALUE")
    links = of("link")
    chosen = F.get(
        F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), F.lit(0)
    )
    permanent = F.coalesce(of("guid").getField("_isPermaLink"), F.lit("true")) != "false"
    columns = {
        "id": _filled(of("id"), guid, of("_rdf:about")),
        "link": _filled(
            chosen["_href"], chosen["_VALUE"], F.when(permanent & guid.rlike("^https?://"), guid)
        ),
        "title": of("title"),
        "summary": _filled(
            of("summary"), of("description"), of("content"), of("content:encoded")
        ),
        "description": of("description"),
        "published": _filled(of("published"), of("pubDate"), of("issued")),
        "updated": _filled(of("updated"), of("dc:date"), of("modified")),
    }
    return computed_once(read, [c.alias(name) for name, c in columns.items()], *keep)


def broken_feeds(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """Feeds that are not well-formed and give no entry either; nothing is read from them."""
    shape, options = "_corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}
    bad = F.from_xml(xml, shape, options)["_corrupt"].isNotNull()
    return feeds.where(F.col(xml).isNull() | ((F.size(entry_texts(xml)) == 0) & bad))
