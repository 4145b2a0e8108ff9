import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import times

CASES = [
    ("2024-03-05T10:11:12.123+1100", "2024-03-04 23:11:12.123000"),
    ("2024-03-05T10:11:12.1+1100", "2024-03-04 23:11:12.100000"),
    ("2024-03-05T10:11:12.123+0000", "2024-03-05T10:11:12.123+0000"),
    ("2024-13-05T10:11:12.123+1100", "2024-13-05T10:11:12.123+1100"),
    ("2024-03-05T10:11:12.1234567+1100", "2024-03-05T10:11:12.1234567+1100"),
    ("2024-03-05T10:11:12.123+1100 x", "2024-03-05T10:11:12.123+1100 x"),
    ("2024-02-30T10:11:12.123+1100", "2024-02-30T10:11:12.123+1100"),
    ("hello", "hello"),
    (None, None),
]


def test_to_utc_text(spark):
    df = spark.createDataFrame([(a,) for a, _ in CASES], "s string")
    got = [r[0] for r in df.select(times.to_utc_text("s")).collect()]
    assert got == [b for _, b in CASES]


def test_to_utc_text_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(CASES[0][0],)], "s string")
        assert df.select(times.to_utc_text("s")).first()[0] == CASES[0][1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_format_mark(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 4, 23, 11, 59, 900000),)], "t timestamp_ntz")
    assert df.select(times.format_mark("t")).first()[0] == "2024/03/05 10:11"


def test_mark_text_roundtrip(spark):
    df = spark.createDataFrame([("2024/03/05 10:11",)], "s string")
    got = df.select(times.mark_text_to_utc("s")).first()[0]
    assert got == dt.datetime(2024, 3, 4, 23, 11)


def test_parse_mark_variants(spark):
    df = spark.createDataFrame([("2024-03-05T10:11:12.123+1100",), ("2024-03-04T23:11:12.123+00:00",), ("junk",)], "s string")
    got = [r[0] for r in df.select(times.parse_mark("s")).collect()]
    assert got == [dt.datetime(2024, 3, 4, 23, 11, 12, 123000)] * 2 + [None]


def test_mark_as_utc_types(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12, 0),)], "t timestamp_ntz")
    assert df.select(times.mark_as_utc("t", T.TimestampNTZType())).first()[0] == dt.datetime(2024, 1, 1, 12, 0)
    s = df.select(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSZ").alias("s"))
    assert s.select(times.mark_as_utc("s", T.StringType())).first()[0] == dt.datetime(2024, 1, 1, 12, 0)


def test_exact_in_a_daylight_saving_session_zone(spark):
    """Wall times inside the session zone's spring-forward gap stay exact."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        # 2024-03-31 02:30 does not exist in Paris; as UTC text it must survive
        df = spark.createDataFrame([("2024-03-31T13:30:00.250+1100",)], "s string")
        assert df.select(times.to_utc_text("s")).first()[0] == "2024-03-31 02:30:00.250000"
        ntz = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30, 0, 250000),)], "t timestamp_ntz")
        assert ntz.select(times.source_text("t")).first()[0] == "2024-03-31T13:30:00.250+1100"
        assert ntz.select(times.format_mark("t")).first()[0] == "2024/03/31 13:30"
        back = ntz.select(times.mark_text_to_utc(times.format_mark("t"))).first()[0]
        assert back == dt.datetime(2024, 3, 31, 2, 30)
        assert df.select(times.parse_mark("s")).first()[0] == dt.datetime(2024, 3, 31, 2, 30, 0, 250000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ntz_text_paths_agree(spark):
    """The date_format path (fixed-offset session zone) and the zone-free
    path spell every wall clock the same way."""
    import random

    rnd = random.Random(9)
    base = dt.datetime(1970, 1, 1)
    vals = [base + dt.timedelta(microseconds=rnd.randrange(0, 2_000_000_000_000_000)) for _ in range(300)]
    vals += [dt.datetime(2024, 3, 5, 10, 11, 12), dt.datetime(2024, 3, 5, 10, 11, 12, 100000), dt.datetime(1999, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    fast = [r[0] for r in df.select(times.ntz_text("t")).collect()]  # session zone is UTC here
    base_part, frac = times._ntz_parts(F.col("t"))
    slow = [r[0] for r in df.select(F.concat(base_part, F.lit("."), frac)).collect()]
    assert fast == slow == [v.strftime("%Y-%m-%d %H:%M:%S.%f") for v in vals]
