"""Text functions on columns; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_u(c: Column) -> Column:
    """Trim all Unicode white space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip_u(F.regexp_replace(c, r"(?U)\s+", " "))


def normal_word(c: Column) -> Column:
    return F.lower(strip_u(c))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def html_escape(c: Column) -> Column:
    for mark, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(mark), F.lit(code))
    return c


def url_quote(c: Column) -> Column:
    """Percent-encoding of a path segment; the slash stays."""
    c = F.url_encode(c)
    for mark, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        c = F.replace(c, F.lit(mark), F.lit(plain))
    return c


def capitalized(c: Column) -> Column:
    """First character upper, all others lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def word_prefix(c: Column) -> Column:
    """The two-letter bucket of a word: Cyrillic as it is, one letter doubled with `a`, anything else `11`."""
    p = strip_u(F.lower(F.substring(c, 1, 2)))
    one = F.when(F.length(p) == 1, F.concat(p, F.lit("a"))).otherwise(p)
    return F.when(p == "", "11").when(p.rlike(r"^[Ѐ-ӿ]"), p).when(one.rlike(r"^\p{L}\p{L}$"), one).otherwise("11")


def without_notes(c: Column) -> Column:
    """Drops [bracketed notes]."""
    return strip_u(F.regexp_replace(c, r"(?U)\s*\[.*?\]\s*", " "))


def example_lines(cell: Column) -> Column:
    """The lines of an example cell's markup: anchors out, split at br, tags out, white space squeezed, empties out."""
    bare = F.regexp_replace(cell, r"(?is)<a\b[^>]*>.*?</a>", "")
    lines = F.transform(F.split(bare, r"(?i)<br\s*/?>"), lambda x: squeeze(F.regexp_replace(x, r"<[^>]+>", "")))
    return F.filter(lines, lambda x: x != "")


def example_pair(cell: Column) -> Column:
    """The first two lines, or two nulls."""
    lines = example_lines(cell)
    part = lambda i: F.when(F.size(lines) >= 2, F.try_element_at(lines, F.lit(i)))
    return F.struct(part(1).alias("example_en"), part(2).alias("example_tr"))


def u32be(c: Column) -> Column:
    """Four bytes, most significant first."""
    return F.unhex(F.lpad(F.hex(c.cast("long")), 8, "0"))
