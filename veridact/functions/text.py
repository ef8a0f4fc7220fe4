"""Text functions of the engine as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_STRIP = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


@F.pandas_udf(StringType())  # a type object: a name would need a session at import
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """NFC; the JVM has no function for it, so texts beyond ASCII go through Python. Rows of ASCII only
    pass the worker as nulls: every batch crosses, their texts don't."""
    odd = c.rlike(r"[^\x00-\x7f]")
    return F.when(odd, _nfc(F.when(odd, c))).otherwise(c)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _STRIP, "")


def fold_invisible(c: Column) -> Column:
    """NFC, one kind of line break, no zero-width space or byte order mark, plain spaces."""
    c = F.regexp_replace(nfc(c), r"\r\n?", "\n")
    return F.regexp_replace(F.regexp_replace(c, "[​﻿]", ""), r"\p{Zs}", " ")


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def fold_linebreaks(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[ \n]+", " "))


def content_hash(c: Column) -> Column:
    return F.substring(F.sha2(strip(c), 256), 1, 16)


def month_of(c: Column) -> Column:
    """YYYY-MM of a date written with dots or dashes; null if it isn't one."""
    m = F.substring(F.replace(F.trim(c), F.lit("."), F.lit("-")), 1, 7)
    return F.when(m.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), m)


def shift_month(month: Column, back: int) -> Column:
    n = F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int") - 1 - back
    return F.format_string("%04d-%02d", F.floor(n / 12).cast("int"), (n % 12 + 1).cast("int"))


def sentiment_prior(rating: Column) -> Column:
    return F.when(rating <= 2, "negative").when(rating >= 4, "positive").otherwise("neutral")


def date_rank(date: Column) -> Column:
    """A string that sorts the latest date first."""
    return F.translate(F.replace(date, F.lit("."), F.lit("-")), "0123456789", "9876543210")


def goods_numbers(url: Column) -> Column:
    """The different goods numbers in a url, in order; null for a null url."""
    return F.array_distinct(F.regexp_extract_all(url, F.lit(r"\b(A\d{12})\b")))


def outer_json(wrote: Column) -> Column:
    """The object inside what a model wrote around it: reasoning blocks and fences go, the outermost braces stay. Empty where there are none."""
    bare = F.regexp_replace(F.regexp_replace(wrote, "(?s)<reasoning>.*?</reasoning>", ""), "```(json)?", "")
    return F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
