import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import codes, dates, measures


def column(spark, values, kind, *exprs):
    """Results of expressions of ``v``, given as functions, for each value."""
    rows = [(i, v) for i, v in enumerate(values)]
    v = F.col("v")
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", *[e(v).alias(f"x{n}") for n, e in enumerate(exprs)])
    out = [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r.i)]
    return [r[0] if len(r) == 1 else r for r in out]


def test_yymmdd(spark):
    values = [930101, 10101, 960229, 970229, 931301, 930100, 930132, 0, -930101, 1930101, None, 991231]
    assert column(spark, values, "int", dates.parse_yymmdd) == [
        dt.date(1993, 1, 1), dt.date(1901, 1, 1), dt.date(1996, 2, 29), None, None, None, None, None, None, None, None,
        dt.date(1999, 12, 31)]


def test_yymmdd_prefix(spark):
    values = ["931107 00:00:00", "001107 00:00:00", "9311", "abcdef", "", None, "930230 00:00:00"]
    assert column(spark, values, "string", dates.parse_yymmdd_prefix) == [
        dt.date(1993, 11, 7), dt.date(1900, 11, 7), None, None, None, None, None]


def test_birth_number(spark):
    values = [706213, 450204, 10101, 700231, 706231, 705101, None]
    got = column(spark, values, "int", dates.birth_gender, dates.birth_date, lambda v: dates.birth_age(v, 1998))
    assert got == [
        ("F", dt.date(1970, 12, 13), 28),
        ("M", dt.date(1945, 2, 4), 53),
        ("M", dt.date(1901, 1, 1), 97),
        ("M", None, 28),
        ("F", dt.date(1970, 12, 31), 28),
        ("F", dt.date(1970, 1, 1), 28),
        ("M", None, None),
    ]


def test_calendar(spark):
    calendar = dates.Calendar("1993-11-01", "1994-02-01")
    values = [dt.date(1993, 10, 31), dt.date(1993, 11, 1), dt.date(1994, 2, 28), dt.date(1994, 3, 1), None]
    assert calendar.months == 4
    assert column(spark, values, "date", calendar.number) == [0, 1, 4, 5, None]
    assert spark.range(1).select(calendar.texts()).head()[0] == ["1993-11", "1993-12", "1994-01", "1994-02"]


def test_codes(spark):
    symbols = ["", " ", None, "UROK", " SIPO "]
    assert column(spark, symbols, "string", lambda v: codes.blank_to(v, "NONE")) == ["NONE", "NONE", "NONE", "UROK", "SIPO"]
    assert column(spark, symbols, "string", codes.is_blank) == [True, True, False, False, False]
    labels = {"A": "one", "B": "two"}
    assert column(spark, ["A", "B", "C", None], "string", lambda v: codes.decode_codes(v, labels)) == ["one", "two", None, None]
    assert column(spark, ["A", "C", None], "string", lambda v: codes.decode_codes(v, labels, "rest")) == ["one", "rest", "rest"]
    assert column(spark, ["VYBER", "PRIJEM", None], "string", lambda v: codes.merge_code(v, "VYBER", "VYDAJ")) == ["VYDAJ", "PRIJEM", None]
    assert column(spark, ["?", " ? ", "1.5", " 2 ", None, "x"], "string", lambda v: codes.placeholder_to_null(v, "double")) == [
        None, None, 1.5, 2.0, None, None]
    kinds = ["PRIJEM", "VYDAJ", "VYBER", None]
    assert column(spark, kinds, "string", lambda v: codes.signed(v, F.lit(5), "PRIJEM")) == [5, -5, -5, -5]
    assert column(spark, ["A", "B", None], "string", lambda v: codes.flag(v.isin("B", "D"))) == [0, 1, 0]


def test_measures(spark):
    df = spark.createDataFrame([(1, 2), (0, 0)], "part int, whole int")
    got = [r[0] for r in df.select(measures.percent(F.col("part"), F.col("whole"))).collect()]
    assert got == [50.0, None]
    assert df.filter("part > 9").agg(measures.exact_mean(F.col("part"))).head()[0] is None
