import pytest
from pyspark.sql import functions as F

from tidepool.functions import scalar as S


def _one(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_null_or_empty(spark):
    assert _one(spark, [None, "", " ", "a"], S.is_null_or_empty("s")) == [True, True, False, False]


def test_utf16_length_counts_surrogate_pairs(spark):
    assert _one(spark, ["a\U0001F600", "abc", "", None], S.utf16_length("s")) == [3, 3, 0, None]


def test_base64_encode_is_one_line(spark):
    got = _one(spark, ["x" * 100], S.base64_encode(F.encode("s", "UTF-8")))[0]
    assert "\n" not in got and "\r" not in got and got.endswith("eA==")


def test_base64_decode_tolerant_and_padding(spark):
    got = _one(spark, ["aGVsbG8=", "aGVsbG8", "@@@", "a", "", None],
               S.base64_decode("s", strict=False))
    assert [None if g is None else bytes(g) for g in got] == [b"hello", b"hello", None, None,
                                                               b"", None]


def test_base64_decode_strict_raises(spark):
    with pytest.raises(Exception, match="Illegal base64"):
        _one(spark, ["@@@"], S.base64_decode("s", strict=True))


def test_json_element_empty(spark):
    docs = ['{"k": []}', '{"k":"[]"}', '{"k":[null]}', '{}', '{"k":null}', '{"k":""}',
            '{"k":{}}', '{"k":0}', '{"k":false}', 'not json']
    want = [True, False, False, True, True, True, False, False, False, None]
    assert _one(spark, docs, S.json_element_empty("s", "$.k")) == want


def test_abbreviate_middle(spark):
    vals = ["abcdefghijklmnop", "abcdefgh", "abc", "", None]
    assert _one(spark, vals, S.abbreviate_middle("s", 3, 2)) == [
        "abc*.*op", "abcdefgh", "abc", "", ""]
    assert _one(spark, vals, S.abbreviate_middle("s", 3, 2, None)) == [
        "abcop", "abcgh", "abc", "", ""]
    assert _one(spark, ["abcdef"], S.abbreviate_middle("s", 0, 0, "..")) == [".."]
    with pytest.raises(ValueError):
        S.abbreviate_middle("s", -1, 2)
