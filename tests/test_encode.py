import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlog.functions import encode as E
from strandlog.functions.scalars import authorized, enabled, positive_number
from strandlog.plans import catalogue


def one(spark, value, logical, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(E.encode(F.col("v"), logical, "t.c", df.schema["v"].dataType).alias("o")).collect()[0]["o"]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("2026-08-27 10:00:00", "2026-08-27T10:00:00.000000Z"),
        ("2026-08-27 10:00:00+07", "2026-08-27T03:00:00.000000Z"),
        ("2026-08-27", "2026-08-27T00:00:00.000000Z"),
        ("2026-08-27Z", "2026-08-27T00:00:00.000000Z"),
        ("2026-08-27 10:00.5", "2026-08-27T10:00:00.500000Z"),
        ("2026-08-27 09:17:45.746275+00", "2026-08-27T09:17:45.746275Z"),
        ("2026-08-27 16:17:45.746275+0700", "2026-08-27T09:17:45.746275Z"),
        ("2026-08-27T09:17:45.746+00:00", "2026-08-27T09:17:45.746000Z"),
        ("2026-08-27 09:17:45.1234567", "2026-08-27T09:17:45.123456Z"),
        (" 2026-08-27 23:30:00-01:30 ", "2026-08-28T01:00:00.000000Z"),
    ],
)
def test_timestamps(spark, value, want):
    assert one(spark, value, "timestamp") == want


@pytest.mark.parametrize("value", ["not a date", "12:30", "2026", "infinity", "12026-01-01", "2026-02-30", "2026-08-27.5"])
def test_bad_timestamps(spark, value):
    with pytest.raises(Exception, match="t.c: not a timestamp"):
        one(spark, value, "timestamp")


def test_timestamps_in_another_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
    try:
        assert one(spark, "2026-08-27 10:00:00+07", "timestamp") == "2026-08-27T03:00:00.000000Z"
        ntz = spark.sql("select timestamp_ntz'2026-08-27 10:00:00.000001' v")
        assert ntz.select(E.encode_timestamp(F.col("v"), "t.c", T.TimestampNTZType())).collect()[0][0] == "2026-08-27T10:00:00.000001Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("logical", "value", "want"),
    [("bigint", "9007199254740993", "9007199254740993"), ("numeric", "0.1000000000000000001", "0.1000000000000000001"), ("integer", "42", 42), ("integer", "-9007199254740991", -9007199254740991),
     ("boolean", "t", 1), ("boolean", "false", 0), ("real", "1.5", 1.5), ("json", '{"n":1}', '{"n":1}'), ("text", "x", "x"), ("text", None, None), ("boolean", None, None)],
)
def test_values(spark, logical, value, want):
    assert one(spark, value, logical) == want


@pytest.mark.parametrize(("logical", "value"), [("integer", "9007199254740993"), ("integer", ""), ("integer", "1e3"), ("integer", "1.5"), ("boolean", "maybe"), ("boolean", "TRUE"), ("boolean", "y"), ("real", "abc"), ("real", "NaN"), ("real", "Infinity"), ("blob", "nope")])
def test_bad_values(spark, logical, value):
    with pytest.raises(Exception, match="t.c: "):
        one(spark, value, logical)


def test_other_types(spark):
    assert one(spark, True, "boolean", "boolean") == 1 and one(spark, 10, "integer", "long") == 10
    assert bytes(one(spark, bytearray(b"ab"), "blob", "binary")) == b"ab"
    assert one(spark, {"n": None, "m": 1}, "json", "struct<n:int,m:int>") == '{"n":null,"m":1}'
    assert one(spark, [1, 2], "json", "array<int>") == "[1,2]"


def test_size_guard(spark):
    assert len(one(spark, "é" * 900_000, "text")) == 900_000
    with pytest.raises(Exception, match="2000000 byte cap"):
        one(spark, "é" * 1_000_001, "text")


def test_scalars():
    assert positive_number("5") == 5 and positive_number("-1", 3) == 3 and positive_number("x") is None and positive_number("inf", 2) == 2
    assert enabled("true") and not enabled("TRUE") and not enabled(None)
    assert authorized("Bearer s", "s") and not authorized("Bearer s", "") and not authorized("s", "s") and not authorized(None, "s")


def test_all_texts_are_encoded(spark, tmp_path):
    rows = [(1, "short", 5), (2, "é" * 30_000, 30_000), (3, "no length", None), (4, None, None), (5, "", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    body = {r["doc_id"]: r["body"] for r in catalogue.QUERIES["encode_blob_all"](spark, str(tmp_path)).collect()}
    assert body == {i: t if t is None else t.encode().hex() for i, t, _ in rows}
    size = {r["doc_id"]: r["n"] for r in catalogue.QUERIES["encode_size_all"](spark, str(tmp_path)).collect()}
    assert size == {i: t if t is None else len(t.encode()) for i, t, _ in rows}
