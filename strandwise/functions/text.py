"""Column builders for dirty text; all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "no value".
NO_VALUE = ["", "-", "--", "?", ".", "n/a", "n.a.", "na", "none", "null", "nil", "nan", "unknown", "n.d.", "nd", "not determined", "not available", "see comment", "tbd", "inactive"]
# Those that stand in identifier and text columns; a measured value may also be "inactive" or "ND".
NO_TEXT = ["", "-", "--", "?", ".", "n/a", "n.a.", "na", "none", "null", "nil", "nan", "unknown", "not available"]

BLANKS = " \t\n\x0b\f\r\u00a0"


def outer_trim(c: Column) -> Column:
    """Without outer white space of any kind, no-break spaces included; null stays null."""
    return F.btrim(c, F.lit(BLANKS))


def no_text(c: Column) -> Column:
    """True where a text is null, blank or a placeholder for "no value", in any case."""
    return c.isNull() | F.lower(outer_trim(c)).isin(NO_TEXT)


def plain_id(c: Column) -> Column:
    """An identifier without letter case, outer blanks and braces; null where nothing is left."""
    bare = F.lower(F.btrim(c, F.lit(BLANKS + "{}")))
    return F.when(bare != "", bare)


def squeeze(c: Column) -> Column:
    """Lower case without any blank; compares names, mechanisms and the like."""
    return F.translate(F.lower(c), BLANKS, "")


def accession_of(term: Column) -> Column:
    """The accession (two or more capitals, colon, four digits) in a term written in either order."""
    found = F.upper(F.regexp_extract(term, r"(?i)(?:^|[:\s])([A-Z]{2,}:\d{4})(?:$|[:\s])", 1))
    return F.when(found != "", found)


def trigrams(c: Column) -> Column:
    """The distinct three-sign sequences of a text's words in lower case, each word with two blanks before and one behind it."""
    words = F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != "")
    each = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, 3)))
    return F.array_distinct(F.flatten(each))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Common trigrams over all trigrams of two texts; 0 if neither has any, null if one is null."""
    x, y = trigrams(a), trigrams(b)
    both = F.size(F.array_intersect(x, y))
    every = F.size(x) + F.size(y) - both
    return F.when(a.isNotNull() & b.isNotNull(), F.when(every == 0, 0.0).otherwise(both / every))
