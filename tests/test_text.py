import unicodedata

from pyspark.sql import functions as F

from veridact.functions import text

ODD = ["", " a ", " x　", "a\r\nb\rc", "﻿z​y", "é", "\x1ca\x1f", "가나", None, "plain"]


def table(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def got(df, c):
    return [r[0] for r in df.orderBy("i").select(c.alias("x")).collect()]


def test_strip_is_the_unicode_one(spark):
    df = table(spark, ODD)
    assert got(df, text.strip(F.col("t"))) == [None if v is None else v.strip() for v in ODD]


def test_nfc_and_fold(spark):
    def fold(v):
        v = unicodedata.normalize("NFC", v).replace("\r\n", "\n").replace("\r", "\n").replace("​", "").replace("﻿", "")
        return "".join(" " if unicodedata.category(c) == "Zs" else c for c in v)

    df = table(spark, ODD)
    assert got(df, text.nfc(F.col("t"))) == [None if v is None else unicodedata.normalize("NFC", v) for v in ODD]
    assert got(df, text.fold_invisible(F.col("t"))) == [None if v is None else fold(v) for v in ODD]


def test_months(spark):
    dates = ["2024.09.03", " 2024-12-31", "2024/01/01", "2024-13-01", "", None]
    df = table(spark, dates)
    assert got(df, text.month_of(F.col("t"))) == ["2024-09", "2024-12", None, None, None, None]
    months = table(spark, ["2026-08", "2024-01", "2000-12"])
    assert got(months, text.shift_month(F.col("t"), 23)) == ["2024-09", "2022-02", "1999-01"]
    assert got(table(spark, ["2024.09.03", "2023-01-01"]), text.date_rank(F.col("t"))) == ["7975-90-96", "7976-98-98"]


def test_sentiment_prior(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 6)], "i int")
    assert got(df, text.sentiment_prior(F.col("i"))) == ["negative", "negative", "neutral", "positive", "positive"]
