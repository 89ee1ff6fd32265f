import datetime as dt

from pyspark.sql import functions as F

from ohlcflow.functions.schema import has_nested_column
from ohlcflow.functions.text import escape_utf8, is_broken_utf8, repair_utf8
from ohlcflow.functions.timefn import (
    date_to_datetime,
    datetime_days_before,
    days_before,
    hours_before_midnight,
    months_before,
    parse_date,
    parse_datetime,
    to_epoch_seconds,
    today_kst,
    utc_to_kst_date,
    years_before,
)


def test_repair_python_byte_literals(spark):
    samples = ["안녕", "plain", "it's a \\ test\n\ttab", "é€😀", ""]
    lits = [str(s.encode("utf-8")) for s in samples]   # Python's own repr: b'...' or b"..."
    lits = [l if l.startswith("b'") else "b'" + l[2:-1].replace("'", "\\'") + "'" for l in lits]
    df = spark.createDataFrame([(l, s) for l, s in zip(lits, samples)], "lit string, want string")
    got = [(r.want, r.got) for r in df.select("want", repair_utf8(F.col("lit")).alias("got")).collect()]
    assert all(w == g for w, g in got), got


def test_escape_matches_python_repr_and_round_trips(spark):
    samples = ["안녕 world", "x\ny\tz\r", "back\\slash", "naïve café"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    rows = df.select("t", escape_utf8(F.col("t")).alias("e")).select("t", "e", repair_utf8(F.col("e")).alias("r")).collect()
    for r in rows:
        assert r.r == r.t
        assert r.e == str(r.t.encode("utf-8"))


def test_octal_and_named_escapes(spark):
    df = spark.createDataFrame([("b'\\354\\225\\210\\x41\\n'",)], "s string")
    assert df.select(repair_utf8(F.col("s")).alias("r")).first().r == "안A\n"


def test_mixed_and_broken_escapes(spark):
    cases = {
        r"b'\xec\225\210'": "안",              # one character, two kinds of escape
        r"\u00ec\u0095\u0088": "안",           # bytes written as code points
        "\xec\x95\x88": "안",                  # bytes misread as Latin-1
        r"\uc548 x": "안 x",
        "caf\xe9": "caf\xe9",                   # a Latin-1 character of its own
        r"caf" + "\xe9" + r"\xec\x95\x88": "caf\xe9안",
        r"\777": "?7",                          # no byte: \77, then a plain 7
        r"b'\xff'": None,
        r"b'\xec\x95'": None,
        r"a\xc3": None,
        "b''": "", "": "", "b'": "b'", "\\": "\\", r"\q": r"\q", r"\\x41": r"\x41",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "s string")
    rows = df.select("s", repair_utf8(F.col("s")).alias("r"), is_broken_utf8(F.col("s")).alias("b")).collect()
    assert {r.s: r.r for r in rows} == {**cases, None: None}
    assert {r.s for r in rows if r.b} == {k for k, v in cases.items() if v is None}


def test_iso_text_and_bad_text(spark):
    cases = {
        "2022-03-20T15:00:00+00:00": "2022-03-20 15:00:00", "2022-03-20T15:00:00Z": "2022-03-20 15:00:00",
        "2022-03-20T15:00:00.250+0900": "2022-03-20 06:00:00.250", "2022-03-20 15:00:00.5": "2022-03-20 15:00:00.500",
        "2022-03-20t15:00:00z": "2022-03-20 15:00:00", "2022-13-40T00:00:00Z": None, "n/a": None, "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    rows = df.select("s", F.date_format(parse_datetime("s"), "yyyy-MM-dd HH:mm:ss.SSS").alias("t"), utc_to_kst_date("s").alias("k")).collect()
    assert {r.s: r.t for r in rows} == {k: v and v.ljust(20, ".").ljust(23, "0") for k, v in cases.items()}
    assert {r.s: r.k for r in rows}["n/a"] is None


def test_long_ranges_do_not_overflow(spark):
    from ohlcflow.plans.backfill import second_chunks

    day = 86400
    n = spark.range(1).select(F.size(second_chunks(F.lit(0).cast("long"), F.lit(100 * 365 * day).cast("long"), day)).alias("n"))
    assert n.first().n == 100 * 365 + 1


def test_calendar_functions(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 31),)], "d date")
    r = df.select(
        months_before("d", 1).alias("m1"),
        years_before("d", 7).alias("y7"),
        days_before("d", 31).alias("d31"),
        datetime_days_before("d", 1).alias("dt1"),
        hours_before_midnight("d", 5).alias("h5"),
        date_to_datetime("d").alias("mid"),
        to_epoch_seconds("d").alias("ep"),
    ).first()
    assert r.m1 == dt.date(2024, 2, 29)        # clamps once
    assert r.y7 == dt.date(2017, 3, 31)
    assert r.d31 == dt.date(2024, 2, 29)
    assert r.ep == int(dt.datetime(2024, 3, 31, tzinfo=dt.timezone.utc).timestamp())
    assert (r.mid.hour, r.h5.day, r.h5.hour) == (0, 30, 19)
    assert r.dt1.day == 30


def test_kst_and_parsing(spark):
    df = spark.createDataFrame([("2024-01-01 15:30:00", "2024/02/03", "20240204", "bad")], "a string, b string, c string, d string")
    r = df.select(
        utc_to_kst_date(F.to_timestamp("a")).alias("k"),
        parse_date("b").alias("pb"),
        parse_date("c").alias("pc"),
        parse_datetime("d").alias("pd"),
        today_kst().alias("today"),
    ).first()
    assert r.k == "2024-01-02"
    assert (r.pb, r.pc, r.pd) == (dt.date(2024, 2, 3), dt.date(2024, 2, 4), None)
    assert isinstance(r.today, dt.date)


def test_has_nested_column(spark):
    df = spark.createDataFrame([], "Data struct<Data: array<struct<time: long>>>, x int, s struct<a: struct<b: int>>")
    assert has_nested_column(df, "Data.Data")
    assert has_nested_column(df, "s.a.b")
    assert not has_nested_column(df, "x.y")          # non-struct parent
    assert not has_nested_column(df, "s.z")
    assert not has_nested_column(df, "")


def test_escape_repair_random_texts(spark):
    import ast
    import random

    rnd = random.Random(5)
    alphabet = list("abc xyz'\"\\\t\n\r\x00\x07\x7f") + ["é", "ß", "안", "녕", "中", "😀", "​", "ÿ"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", "t", escape_utf8(F.col("t")).alias("e")).select(
        "i", "t", "e", repair_utf8(F.col("e")).alias("r")
    ).collect()
    for r in rows:
        assert r.r == r.t
        assert ast.literal_eval(r.e).decode("utf-8") == r.t    # a valid Python bytes literal


# --- Fixed values: free-form texts and what they mean (UTC). ---
FREE = {
    "Jan 2, 2024 3:04 PM": "2024-01-02 15:04:00", "2 January 2024": "2024-01-02 00:00:00",
    "Tue, 02 Jan 2024 15:04:05 GMT": "2024-01-02 15:04:05", "Tue Jan  2 15:04:05 2024": "2024-01-02 15:04:05",
    "01/02/2024": "2024-01-02 00:00:00", "13/02/2024": "2024-02-13 00:00:00", "02.01.2024 15:04": "2024-02-01 15:04:00",
    "20240102150405": "2024-01-02 15:04:05", "20240102T1504": "2024-01-02 15:04:00", "20240102": "2024-01-02 00:00:00",
    "02-Jan-24": "2024-01-02 00:00:00", "2024 Jan 02": "2024-01-02 00:00:00", "January 2nd, 2024": "2024-01-02 00:00:00",
    "2nd of January 2024": "2024-01-02 00:00:00", "2 Jan 2024 15:04:05 KST": "2024-01-02 06:04:05",
    "2 Jan 2024 15:04:05 +0900": "2024-01-02 06:04:05", "2 Jan 2024 15:04:05 -03:30": "2024-01-02 18:34:05",
    "1/2/24 3:04:05 pm": "2024-01-02 15:04:05", "3:04 a.m. 2 Jan 2024": "2024-01-02 03:04:00",
    "3pm Jan 2 2024": "2024-01-02 15:00:00", "12am Jan 2 2024": "2024-01-02 00:00:00", "12:30 PM, 2 Jan 2024": "2024-01-02 12:30:00",
    "2024-13-01": "2024-01-13 00:00:00", "2024-01-02 15:04:05.123456789": "2024-01-02 15:04:05.123456",
    "Wednesday, 3 January 2024 at 10:00 UTC+09:00": "2024-01-03 01:00:00", "2024-01-02T15:04Z": "2024-01-02 15:04:00",
    "Sept. 5, '99": "1999-09-05 00:00:00", "31/12/68": "2068-12-31 00:00:00", "31/12/69": "1969-12-31 00:00:00",
    "12-31-2024": "2024-12-31 00:00:00", "MAY 5 2024": "2024-05-05 00:00:00", "  2024/1/2  ": "2024-01-02 00:00:00",
}
NO_DATES = [
    "Feb 30, 2024", "n/a 2024-01-02", "foo 12", "", " ", "Jan 2024", "2 Jan 2024 15:04 PST", "25:00 Jan 2 2024",
    "13 pm Jan 2 2024", "10/11", "monday", "2 Jan 2024 5", "2024-02-30", "12:60 1 Jan 2024", "32 Jan 2024", None,
]
# --- end of fixed values ---


def test_free_form_dates(spark):
    from ohlcflow.functions.timefn import parse_datetime

    rows = [(k, v) for k, v in FREE.items()] + [(k, None) for k in NO_DATES]
    df = spark.createDataFrame(rows, "text string, want string")
    got = df.select("text", "want", parse_datetime("text").cast("string").alias("got")).collect()
    assert [(r.text, r.got) for r in got] == [(r.text, r.want) for r in got]
    listed = df.select(parse_datetime("text", free=False).alias("got"), "text").where("got IS NOT NULL").collect()
    assert {r.text for r in listed} == {"20240102", "2024-01-02 15:04:05.123456789", "  2024/1/2  "} - {"2024-01-02 15:04:05.123456789"}
