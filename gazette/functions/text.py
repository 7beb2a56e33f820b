"""Text expressions. All of them stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette.schemas import KEYWORD_DEFAULT, SECTION_KEYWORDS

# White space as Python's str.split() and str.strip() see it. Java's \s is
# ASCII only, so it would miss a no-break or an ideographic space.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
NOT_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
SPACE_CHARS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(as_col(c), F.lit(SPACE_CHARS))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and white-space-only text."""
    return ~F.coalesce(as_col(c).rlike(NOT_SPACE), F.lit(False))


def is_falsy(c: Column | str) -> Column:
    """True for NULL and empty text, but not for white space."""
    return F.coalesce(as_col(c), F.lit("")) == ""


def truthy(c: Column | str) -> Column:
    """The text itself, or NULL where it is empty."""
    return F.nullif(as_col(c), F.lit(""))


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words; NULL counts as no words."""
    text = F.coalesce(as_col(c), F.lit(""))
    # White space at either end makes one empty piece there.
    edges = text.rlike("^" + SPACE).cast("int") + F.substring(text, -1, 1).rlike(SPACE).cast("int")
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, SPACE + "+")) - edges)


def min_words(c: Column | str, n: int) -> Column:
    """``word_count(c) >= n`` without splitting.

    One possessive match that stops at the n-th word: no array is built and
    the tail of a long body is never looked at.
    """
    if n <= 0:
        return F.lit(True)
    pattern = f"^{SPACE}*+(?:{NOT_SPACE}++{SPACE}++){{{n - 1}}}+{NOT_SPACE}"
    return F.coalesce(as_col(c).rlike(pattern), F.lit(False))


def hash16(c: Column | str) -> Column:
    """First 16 hex digits of the SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(as_col(c), 256), 1, 16)


def at_uri_to_url(c: Column | str) -> Column:
    """Web address of an ``at://<did>/<collection>/<record>`` URI."""
    parts = F.split(F.replace(as_col(c), F.lit("at://"), F.lit("")), "/")
    return F.when(
        F.size(parts) >= 3,
        F.concat(
            F.lit("https://bsky.app/profile/"), F.get(parts, 0), F.lit("/post/"), F.get(parts, 2)
        ),
    ).otherwise(F.lit("https://bsky.app"))


def classify_section(title: Column | str) -> Column:
    """First section any of whose keywords occurs anywhere in the title."""
    lowered = F.lower(as_col(title))
    result: Column | None = None
    for section, words in SECTION_KEYWORDS.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | lowered.contains(word)
        result = F.when(hit, section) if result is None else result.when(hit, section)
    return result.otherwise(F.lit(KEYWORD_DEFAULT))


def ellipsize(c: Column | str, limit: int) -> Column:
    """Text longer than ``limit`` is cut so that it ends in three dots."""
    text = as_col(c)
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))
    ).otherwise(text)


# --- fixed values: month and zone names of mail dates (RFC 822) ---------------
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
ZONES = {
    "ut": "+00:00", "gmt": "+00:00", "utc": "+00:00", "z": "+00:00", "": "+00:00",
    "est": "-05:00", "edt": "-04:00", "cst": "-06:00", "cdt": "-05:00",
    "mst": "-07:00", "mdt": "-06:00", "pst": "-08:00", "pdt": "-07:00",
}
MAIL_DATE = (
    r"^\s*(?i:(?:[a-z]{3,9}\s*,?\s+)?(\d{1,2})\s+([a-z]{3})[a-z]*\s+(\d{4}|\d{2})"
    r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([a-z]*|[+-]\d{2}:?\d{2}))\s*$"
)


def parse_time(c: Column | str) -> Column:
    """ISO-8601 text or a mail date as a timestamp, naive text read as UTC, else NULL.

    The day's name in a mail date may be missing, its year may have two digits.
    """
    text = as_col(c)

    def iso(parts: Column) -> Column:
        day, month, year, hour, minute, second, zone = (F.get(parts, F.lit(i)) for i in range(7))
        century = F.when(year >= "70", "19").otherwise("20")
        return F.concat(
            F.when(F.length(year) == 4, year).otherwise(F.concat(century, year)),
            F.lit("-"),
            lookup({m: f"{i:02}" for i, m in enumerate(MONTHS, 1)}, month),
            F.lit("-"),
            F.lpad(day, 2, "0"),
            F.lit("T"),
            F.lpad(hour, 2, "0"),
            F.lit(":"),
            minute,
            F.lit(":"),
            F.when(second == "", "00").otherwise(second),
            F.when(
                zone.rlike(r"^[+-]"), F.regexp_replace(zone, r"^(...):?(..)$", "$1:$2")
            ).otherwise(lookup(ZONES, zone)),
        )

    # Taken apart once; the lambda is what keeps Spark from writing the match out per part.
    parts = F.split(F.lower(F.regexp_replace(text, MAIL_DATE, "$1|$2|$3|$4|$5|$6|$7")), r"\|")
    mail = F.get(F.transform(F.array(parts), iso), F.lit(0))
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text)).when(
        text.rlike(MAIL_DATE), F.try_to_timestamp(mail)
    )


def iso_time(c: Column | str, zone: str = "Z") -> Column:
    """A timestamp as ISO-8601 UTC text, with a fraction only if it has one."""
    ts = as_col(c)
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.when(
        micros == 0, F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss'{zone}'")
    ).otherwise(F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'{zone}'"))


def is_http_url(c: Column | str) -> Column:
    """An absolute http or https address with a host, of at most 2083 characters."""
    text = as_col(c)
    return F.coalesce(
        text.rlike(r"^(?i:https?)://[^/\s?#]+") & (F.length(text) <= 2083), F.lit(False)
    )


def canonical_url(c: Column | str) -> Column:
    """An http(s) address with its scheme and host in lower case, without the
    scheme's own port, and with at least a slash as path; other text unchanged.

    Other normalisation (percent or punycode encoding) is left to the source.
    """
    text = as_col(c)
    parts = r"^((?i)https?)://([^/?#]*)(.*)$"
    scheme = F.lower(F.regexp_extract(text, parts, 1))
    host = F.lower(F.regexp_extract(text, parts, 2))
    rest = F.regexp_extract(text, parts, 3)
    port = F.when(scheme == "http", r":80$").otherwise(r":443$")
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(
        is_http_url(text), F.concat(scheme, F.lit("://"), F.regexp_replace(host, port, ""), path)
    ).otherwise(text)


def lookup(mapping: dict[str, str], key: Column | str, default: str | None = None) -> Column:
    """A constant mapping as an expression; it is part of the plan, not a join."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), as_col(key))
    return found if default is None else F.coalesce(found, F.lit(default))
