"""Text functions as native column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Characters that count as white space, at the ends of a text and inside it: named one by one, as Java's own class of them
#: looks up each character's properties.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK_RUN = rf"[{BLANKS}]+"


@lru_cache(maxsize=1)
def _bare_letters() -> tuple[str, str]:
    """Characters that decompose to one base character and marks, and those bases; built from the Unicode data."""
    marked, bare = ["đ", "Đ"], ["d", "D"]
    for code in range(0x80, 0x30000):
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != c:
            marked.append(c)
            bare.append(base)
    return "".join(marked), "".join(bare)


def fold(text: Column) -> Column:
    """Lower case without accents, white space squeezed and trimmed: the key for all marker comparisons."""
    bare = F.regexp_replace(F.translate(text, *_bare_letters()), r"\p{Mn}", "")
    return F.lower(strip(F.regexp_replace(bare, BLANK_RUN, " ")))


def head(text: Column, most: int) -> Column:
    """The beginning of a text with its first `most` characters that are neither white space nor marks, each of which folds
    to one character at least; a text with fewer is as it was. fold(head(...)) begins with the same `most` characters as
    fold of the whole, and is longer than most - 1 if and only if that is."""
    skipped = rf"{BLANKS}\p{{Mn}}"
    return F.regexp_replace(text, rf"(?s)^((?:[{skipped}]*+[^{skipped}]){{{most}}}).+$", "$1")


def fold_short(text: Column, most: int) -> Column:
    """fold of a text that folds to at most `most` characters; of any longer one null or the beginning of its fold, which is
    longer than `most` too. Printable ASCII without two spaces together folds to as many characters as are no spaces at least,
    one of two: a text that begins with enough of it is long without a fold."""
    enough = 2 * most + 2
    long = text.rlike(rf"^[\x20-\x7e]{{{enough}}}") & ~F.contains(F.substring(text, 1, enough), F.lit("  "))
    return F.when(~long, fold(head(text, most + 1)))


def fold_plain(text: Column) -> Column:
    """Accents off and lower case, white space as it is."""
    return F.lower(F.translate(text, *_bare_letters()))


def slug(text: Column, most: int = 48) -> Column:
    """At most `most` letters, digits and dashes. Each ASCII letter or digit is a character of the slug, so what comes after
    one more than fit is not looked at."""
    text = F.regexp_replace(text, rf"(?s)^((?:[^A-Za-z0-9]*+[A-Za-z0-9]){{{most + 1}}}).+$", "$1")
    dashed = F.regexp_replace(F.regexp_replace(fold(text), "[^a-z0-9]+", "-"), "^-|-$", "")
    return F.regexp_replace(F.substring(dashed, 1, most), "-+$", "")


def file_slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def strip(text: Column) -> Column:
    """Without white space at either end; looks at the ends only."""
    return F.btrim(text, F.lit(BLANKS))


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, "[ \t\u00a0]+", " ")


def html_escape(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def strip_html(text: Column, most: int = 800) -> Column:
    return F.substring(strip(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), BLANK_RUN, " ")), 1, most)


def html_cleanup(text: Column) -> Column:
    """Join neighbouring emphasis, drop a list item's own dash and block quotes."""
    for tag in ("em", "strong"):
        text = F.regexp_replace(text, rf"</{tag}>(\s*)<{tag}>", "$1")
    text = F.regexp_replace(text, r"<li>\s*[-–—•]\s*", "<li>")
    return F.replace(F.replace(text, F.lit("<blockquote>"), F.lit("")), F.lit("</blockquote>"), F.lit(""))


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition, which Spark has no function for."""
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


def data_uri(data: Column, mime: Column) -> Column:
    """An <img> with its bytes inline; empty without data. base64() breaks lines, which an attribute must not."""
    body = F.concat(F.lit('<img src="data:'), mime, F.lit(";base64,"), F.regexp_replace(F.base64(data), "[\r\n]", ""), F.lit('">'))
    return F.when(F.length(data) > 0, body).otherwise(F.lit(""))


def mime_of(extension: Column) -> Column:
    """The types of a package's media parts."""
    kinds = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "wmf": "image/x-wmf", "emf": "image/x-emf", "wdp": "image/vnd.ms-photo"}
    out = F.lit("image/png")
    for name, mime in kinds.items():
        out = F.when(F.lower(extension) == name, F.lit(mime)).otherwise(out)
    return out


def definition_list(pairs: list[tuple[str, Column]]) -> Column:
    """<dl> of the pairs whose value is not empty."""
    items = [F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"<dt>{k}</dt><dd>"), html_escape(v), F.lit("</dd>"))) for k, v in pairs]
    return F.concat(F.lit("<dl>"), F.array_join(F.array_compact(F.array(*items)), ""), F.lit("</dl>"))


def ray_names(text: Column) -> Column:
    """Rays such as Ox or Oy outside tags as mathematics."""
    return F.regexp_replace(text, r"(?<![A-Za-z])O([uvmxyz])(?![A-Za-z])(?![^<]*>)", "\\\\(O$1\\\\)")
