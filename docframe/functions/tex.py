"""Formula text as native column expressions: comparison form, balance counts, confidence, defect flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Commands without weight in a comparison, and spellings that count as one.
DROPPED = ("left", "right", "mathrm", "text")
SAME = (("\\neq", "\\ne"), ("\\leq", "\\le"), ("\\geq", "\\ge"), ("°", "^\\circ"), ("\\rightarrow", "\\to"), ("\\Rightarrow", "\\to"), ("\\cdot", "."), ("~", ""))


def normalize(latex: Column) -> Column:
    latex = F.regexp_replace(latex, rf"\\(?:{'|'.join(DROPPED)})(?![A-Za-z])", "")
    for spelling, kept in SAME:
        latex = F.replace(latex, F.lit(spelling), F.lit(kept))
    return F.regexp_replace(latex, r"[\s{}]", "")


def balance(latex: Column) -> Column:
    """Open minus closed: braces that are not escaped, and fences."""
    opened, closed = (F.regexp_count(latex, F.lit(rf"(?<!\\)\{b}")) for b in "{}")
    left, right = (F.regexp_count(latex, F.lit(rf"\\{w}(?![a-z])")) for w in ("left", "right"))
    return F.struct((opened - closed).alias("braces"), (left - right).alias("fences"))


def confidence(source: Column, selectors: Column) -> Column:
    """Certain for typed sources, high for a decoded formula without templates, lower with; 0 without a formula."""
    decoded = F.when(F.coalesce(F.size(selectors), F.lit(0)) <= 0, 0.98).otherwise(0.93)
    return F.when(source.isin("tex", "omml"), 1.0).when(source == "mtef", decoded).when(source == "mtef_partial", decoded - 0.2).otherwise(0.0)


def sendable(latex: Column) -> Column:
    """Braces and fences in balance."""
    b = balance(latex)
    return (b["braces"] == 0) & (b["fences"] == 0)


_WORD = r"\p{L}*[\p{L}&&[^A-Za-z]]\p{L}*"


def display(latex: Column) -> Column:
    """The formula as a page's typesetter should get it: one spelling of "not equal" and of set difference, indices that
    were typed beside their letter, limits below their operator, words in other scripts as text."""
    for spelling, kept in (("\\neq", "\\ne"), ("≠", "\\ne "), ("∖", "\\setminus ")):
        latex = F.replace(latex, F.lit(spelling), F.lit(kept))
    latex = F.regexp_replace(latex, r"(?<![\\A-Za-z])([A-Za-z])([0-9]+)(?![0-9A-Za-z])", "$1_{$2}")
    latex = F.regexp_replace(latex, r"(?<![A-Za-z])\\?(lim|max|min|sup|inf) ?_", r"\\$1\\limits_")
    return F.regexp_replace(latex, rf"(?<!\\text\{{[^{{}}]{{0,200}})(?<!\p{{L}}){_WORD}(?: +{_WORD})*", r"\\text{ $0 }")
