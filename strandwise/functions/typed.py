"""Typed readings of free-form values; null where the text is not of the kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.text import no_text, outer_trim

# Spellings of true and false.
TRUE_WORDS = ["true", "t", "yes", "y", "1", "on"]
FALSE_WORDS = ["false", "f", "no", "n", "0", "off"]
# Notations of a date and their patterns.
DATE_NOTATIONS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{3,} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^[A-Z][a-z]{3,} \d{1,2} \d{4}$", "MMMM d yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
]

#: A number that is not the tail of a word such as IC50, with thousands or decimal commas and powers of ten.
NUMBER = r"(?<![\p{L}\d.,])([-+\u2212]?(?:\d[\d.,]*|\.\d+))(?:\s*(?:[x×*·]\s*10\s*\^?\s*|[eE])([-+\u2212]?\d+)(?![\d.]))?"


def decimal_text(d: Column) -> Column:
    """Digits with a decimal point only: 1,830.0 has a thousands comma, 66,4 a decimal one.

    Several commas without a point are thousands; a single comma without a point is a decimal comma.
    """
    thousands = d.rlike(r"^[-+]?\d{1,3}(,\d{3})+\.\d*$|^[-+]?\d{1,3}(,\d{3}){2,}$")
    return F.when(thousands, F.replace(d, F.lit(","), F.lit(""))).otherwise(F.replace(d, F.lit(","), F.lit(".")))


def real_date(v: Column) -> Column:
    """ISO text of a real date in one of DATE_NOTATIONS; day comes before month where both fit."""
    read = F.lit(None).cast("timestamp")
    for shape, pattern in reversed(DATE_NOTATIONS):
        read = F.when(v.rlike(shape), F.try_to_timestamp(v, F.lit(pattern))).otherwise(read)
    return F.date_format(F.when(F.year(read) > 0, read), "yyyy-MM-dd")


def with_typed_text(df: DataFrame, kind: str, value: str, out: str) -> DataFrame:
    """Adds `out`: the value in a spelling that a cast of its kind reads, or null where it is of no use to the kind.

    quantity: the first number that the text states. double: a plain number with decimal point or comma.
    integer: a whole number (9606.0 states one, 9606.5 does not). boolean: TRUE_WORDS and FALSE_WORDS. date: a real
    date in one of DATE_NOTATIONS. Any other kind is text: anything but blanks and placeholders for "no value".
    The steps are separate projections, so each expression is evaluated once and stays in generated code.
    """
    k = F.col(kind)
    v, m, p, d, t = (F.col(f"__{c}") for c in "vmpdt")
    plain = v.rlike(r"^[-+]?(\d[\d,]*\.?\d*|\.\d+)([eE][-+]?\d+)?$")
    steps = df.withColumn("__v", outer_trim(F.col(value)))
    steps = steps.withColumn("__m", F.when(k == "quantity", F.regexp_extract(v, NUMBER, 1)).when((k == "double") & plain, v))
    steps = steps.withColumn("__p", F.when(k == "quantity", F.regexp_extract(v, NUMBER, 2))).withColumn("__m", F.regexp_replace(F.replace(m, F.lit("\u2212"), F.lit("-")), r"[.,]+$", ""))
    steps = steps.withColumn("__d", decimal_text(m))
    steps = steps.withColumn("__t", F.when(k == "date", F.initcap(F.regexp_replace(F.regexp_replace(v, r"[T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?[Zz]?$", ""), r"[,\s]+|(?<=[A-Za-z]{3})\.", " "))))
    steps = steps.withColumn("__t", F.regexp_replace(t, r"\s+", " "))
    word = F.lower(v)
    cell = (
        F.when(k == "quantity", F.when(p != "", F.concat(d, F.lit("e"), F.replace(p, F.lit("\u2212"), F.lit("-")))).when(d != "", d))
        .when(k == "double", d)
        .when(k == "integer", F.nullif(F.regexp_extract(v, r"^([-+]?\d+)(?:\.0*)?$", 1), F.lit("")))
        .when(k == "boolean", F.when(word.isin(TRUE_WORDS), "true").when(word.isin(FALSE_WORDS), "false"))
        .when(k == "date", real_date(t))
        .when(~no_text(v), v)
    )
    return steps.withColumn(out, cell).drop("__v", "__m", "__p", "__d", "__t")


#: SQL types of the kinds of attribute.
SQL_TYPES = {"quantity": "double", "double": "double", "integer": "bigint", "boolean": "boolean", "date": "date", "text": "string"}
