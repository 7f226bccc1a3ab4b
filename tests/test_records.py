import pytest

from tidepool.functions import records as R

SAMPLE_V2 = '{"symbol":"AAPL","trade":"SELL","price":20.0,"quantity":12,"id":123}'


def _parse(spark, texts, strict):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = R.parse_trades(df, "s", "r", "v1", strict=strict)
    return [r.r for r in out.select("r").collect()]


def test_v2_record_read_as_v1(spark):
    (r,) = _parse(spark, [SAMPLE_V2], strict=True)
    assert r.tickerSymbol is None and r.tradeType is None
    assert (r.price, r.quantity, r.id) == (20.0, 12, "123")


def test_coercions_like_the_object_mapper(spark):
    text = '{"tickerSymbol":"X","price":"20.5","quantity":12.7,"id":9,"zzz":[1]}'
    (r,) = _parse(spark, [text], strict=True)
    assert (r.tickerSymbol, r.price, r.quantity, r.id) == ("X", 20.5, 12, "9")
    (m,) = _parse(spark, ['{"tickerSymbol":"X"}'], strict=True)
    assert (m.price, m.quantity, m.id, m.tradeType) == (0.0, 0, None, None)
    (z,) = _parse(spark, ['{"price":null,"quantity":null}'], strict=True)
    assert (z.price, z.quantity) == (0.0, 0)


def test_tolerant_parse_nulls_bad_records(spark):
    got = _parse(spark, ['{"tickerSymbol":"X",', '[1,2]', '', '{"price":"abc"}',
                         '{"tickerSymbol":"Y","price":1.5}'], strict=False)
    assert got[:4] == [None, None, None, None]
    assert got[4].tickerSymbol == "Y" and got[4].price == 1.5


@pytest.mark.parametrize("bad", ['{"tickerSymbol":"X",', '{"price":"abc"}', '[1]'])
def test_strict_parse_raises(spark, bad):
    with pytest.raises(Exception):
        _parse(spark, [bad], strict=True)


def test_json_roundtrip_and_nulls_written(spark):
    df = spark.createDataFrame([("S", None, 1.25, 3, "i1")],
                               "tickerSymbol string, tradeType string, price double, "
                               "quantity bigint, id string")
    text = df.select(R.trade_to_json("v1").alias("j")).first().j
    assert text == '{"tickerSymbol":"S","tradeType":null,"price":1.25,"quantity":3,"id":"i1"}'
    back = R.parse_trades_bytes(df.select(R.trade_to_json_bytes("v1").alias("value")))
    r = back.first().trade
    assert (r.tickerSymbol, r.tradeType, r.price, r.quantity, r.id) == ("S", None, 1.25, 3, "i1")


def test_bytes_decode_replaces_invalid_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"ok\xff"),)], "value binary")
    assert df.select(R.decode_utf8("value")).first()[0] == "ok�"


def test_trade_line_and_payload(spark):
    df = spark.createDataFrame([("S", "BUY", 1.5, 3, "i1")],
                               "tickerSymbol string, tradeType string, price double, "
                               "quantity bigint, id string")
    assert df.select(R.trade_line("v1")).first()[0] == "ID i1: BUY 3 shares of S for $1.50"
    data = df.select(R.payload("id")).first()[0]
    assert len(data) == 1024 and data[:64] == data[64:128]
    rnd = df.select(R.payload("id", deterministic=False, seed=3)).first()[0]
    assert len(rnd) == 1024 and rnd.isalnum()
