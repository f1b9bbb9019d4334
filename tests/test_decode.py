import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparktape.operators import decode, health
from sparktape.functions.columns import iso_to_ns
from sparktape.plans.queries import read_binance
from sparktape.schema import FRAME
from sparktape.sources import frames as frame_sources
from sparktape.sources import tables
from sparktape.sources.frames import frames_from_kafka

MS = 1_716_163_200_123
NS = MS * 1_000_000
ISO, ISO_NS = "2023-02-09T20:19:35.39625135Z", 1_675_973_975_396_251_350


def binance(**changes):
    trade = {"e": "trade", "E": MS, "s": "BTCUSDT", "t": 99999, "p": "67000.50", "q": "0.005",
             "T": MS, "m": False, "M": True} | changes
    return {k: v for k, v in trade.items() if v is not ...}


def trade(**changes):
    one = {"trade_id": "42", "product_id": "BTC-USD", "price": "21720.50", "size": "0.00413",
           "side": "BUY", "time": ISO} | changes
    return {k: v for k, v in one.items() if v is not ...}


def coinbase(*trades, kind="update", channel="market_trades"):
    return {"channel": channel, "timestamp": ISO, "sequence_num": 0,
            "events": [{"type": kind, "trades": list(trades)}]}


def run(spark, source, *frames, **options):
    """(status, reason, ticks) of each frame."""
    texts = [f if isinstance(f, str) else json.dumps(f) for f in frames]
    received = NS if source == "binance" else ISO_NS
    rows = spark.createDataFrame([(source, t, received + i) for i, t in enumerate(texts)], FRAME)
    decoded = decode.decode_frames(rows, now_ns=NS + 10**9, **options)
    ticks = {}
    for t in decode.frame_ticks(decoded).collect():
        ticks.setdefault(t.received_ns - received, []).append(t)
    found = sorted(decoded.collect(), key=lambda r: r.received_ns)
    return [(r.status, r.reason, ticks.get(i, [])) for i, r in enumerate(found)]


def test_binance_fields(spark):
    buy, sell, wrapped = run(
        spark, "binance", binance(), binance(m=True, p="67000.12345678", q="0.00000001"),
        {"stream": "btcusdt@trade", "data": binance(s="ETHUSDT")},
    )
    (tick,) = buy[2]
    assert (tick.exchange, tick.symbol, tick.side, tick.trade_id) == ("binance", "BTCUSDT", "buy", "99999")
    assert (tick.price, tick.timestamp_ns, tick.received_ns) == (Decimal("67000.50"), NS, NS)
    assert sell[2][0].side == "sell"
    assert (sell[2][0].price, sell[2][0].size) == (Decimal("67000.12345678"), Decimal("1E-8"))
    assert wrapped[2][0].symbol == "ETHUSDT"
    assert {r[0] for r in (buy, sell, wrapped)} == {"parsed"}


def test_binance_ignored(spark):
    found = run(spark, "binance", {"e": "depthUpdate", "s": "BTCUSDT"}, {"result": None, "id": 1}, {},
                {"stream": "x", "data": {"e": "kline"}})
    assert [(r[0], r[1], r[2]) for r in found] == [("ignored", None, [])] * 4


@pytest.mark.parametrize(
    ("frame", "reason"),
    [
        ("not-json{{{{", "malformed"),
        ('{"e":"trade"', "malformed"),
        (json.dumps(binance()) + "xyz", "malformed"),
        (json.dumps(binance()) + "}", "malformed"),
        ("", "malformed"),
        (str(binance()), "malformed"),
        ("[1]", "not an object"),
        ("null", "not an object"),
        ('{"data":null}', "not an object"),
        ('{"data":"x"}', "not an object"),
        (binance(p="-1"), "price must be > 0"),
        (binance(p="x"), "Cannot convert"),
        (binance(q="0"), "size must be > 0"),
        (binance(p=...), "missing"),
        (binance(s=...), "missing"),
        (binance(t=...), "missing"),
        (binance(m=...), "missing"),
        (binance(T="soon"), "not readable"),
        (binance(T=9_999_999_999_999_999), "not readable"),
        (binance(T=4_000_000_000_000), "future"),
        (binance(T=MS + 5_000), "clock sync"),
    ],
)
def test_binance_errors(spark, frame, reason):
    ((status, why, ticks),) = run(spark, "binance", frame)
    assert (status, ticks) == ("error", [])
    assert reason in why


def test_coinbase_frames(spark):
    snapshot = coinbase(trade(price="21500.00", size="0.1"), trade(side="SELL", price="21499.50"), kind="snapshot")
    update = coinbase(trade(product_id="ETH-USD", price="1620.75", size="1.5"))
    several = {"channel": "market_trades", "events": [
        {"type": "l2", "trades": [{"side": "LONG"}]}, {"type": "update"},
        {"type": "update", "trades": []}, {"type": "update", "trades": [trade(trade_id=7), trade(trade_id="abc-123")]}]}
    found = run(spark, "coinbase", snapshot, update, several)
    assert [len(r[2]) for r in found] == [2, 1, 2]
    assert {r[0] for r in found} == {"parsed"}
    assert {(t.side, t.price) for t in found[0][2]} == {("buy", Decimal(21500)), ("sell", Decimal("21499.5"))}
    (eth,) = found[1][2]
    assert (eth.symbol, eth.exchange, eth.timestamp_ns) == ("ETH-USD", "coinbase", ISO_NS)
    assert {t.trade_id for t in found[2][2]} == {"7", "abc-123"}


def test_coinbase_ignored(spark):
    found = run(spark, "coinbase", {"channel": "subscriptions", "events": [{"subscriptions": {}}]},
                {"channel": "market_trades"}, {"channel": "market_trades", "events": []}, {"type": "x"},
                coinbase(trade(side="LONG"), kind="other"))
    assert [r[0] for r in found] == ["ignored"] * 5


@pytest.mark.parametrize(
    ("frame", "reason"),
    [
        ("{{{{not-json", "malformed"),
        ('"text"', "not an object"),
        ({"channel": "market_trades", "events": None}, "missing"),
        ({"channel": "market_trades", "events": "x"}, "missing"),
        ({"channel": "market_trades", "events": [None]}, "missing"),
        ({"channel": "market_trades", "events": [{"type": "update", "trades": None}]}, "missing"),
        (coinbase(None), "missing"),
        (coinbase(trade(side="LONG")), "Unknown side"),
        (coinbase(trade(side=...)), "missing"),
        (coinbase(trade(time="2023-02-09T20:19:35+00:00")), "not readable"),
        (coinbase(trade(time="2023-02-09")), "not readable"),
        (coinbase(trade(time="9999-01-01T00:00:00Z")), "not readable"),
        (coinbase(trade(price="NaN")), "Cannot convert"),
    ],
)
def test_coinbase_errors(spark, frame, reason):
    ((status, why, ticks),) = run(spark, "coinbase", frame)
    assert (status, ticks) == ("error", [])
    assert reason in why


def test_what_a_bad_trade_does_to_its_frame(spark):
    mixed = coinbase(trade(trade_id="a"), trade(trade_id="b", size="0"), trade(trade_id="c"))
    ((status, why, ticks),) = run(spark, "coinbase", mixed)
    assert (status, why, [t.trade_id for t in ticks]) == ("error", "size must be > 0", ["a"])
    ((status, why, ticks),) = run(spark, "coinbase", mixed, on_error="per_trade")
    assert (status, why, {t.trade_id for t in ticks}) == ("error", "size must be > 0", {"a", "c"})
    with pytest.raises(ValueError, match="on_error"):
        run(spark, "coinbase", mixed, on_error="skip")


def test_numbers_in_json_are_accepted(spark):
    ((status, _, (tick,)),) = run(spark, "binance", binance(p=67000.5, q=1))
    assert (status, tick.price, tick.size) == ("parsed", Decimal("67000.5"), Decimal(1))


def test_error_excerpt_and_counts(spark):
    long_text = "{" + "x" * 1_000
    rows = spark.createDataFrame(
        [("binance", long_text, NS), ("binance", json.dumps(binance()), NS), ("kraken", "{}", NS)], FRAME
    )
    decoded = decode.decode_frames(rows, now_ns=NS)
    errors = {r.source: r for r in decode.frame_errors(decoded).collect()}
    assert errors["binance"].excerpt == long_text[:300]
    assert errors["kraken"].reason == "no decoder for this source"
    counts = {r.exchange: r.n_errors for r in health.parse_errors(decoded).collect()}
    assert counts == {"binance": 1, "kraken": 1}


def test_binary_frames(spark):
    good = json.dumps(binance(s="ÄÖ")).encode()
    rows = spark.createDataFrame([("binance", good, NS), ("binance", b"\xff\xfe{", NS)],
                                 "source string, raw binary, received_ns long")
    decoded = decode.decode_frames(rows, now_ns=NS)
    assert decode.frame_ticks(decoded).first().symbol == "ÄÖ"
    error = decode.frame_errors(decoded).first()
    assert (error.reason, error.excerpt) == ("frame is not UTF-8", "fffe7b")


def test_kafka_records(spark):
    records = spark.createDataFrame(
        [("binance", json.dumps(binance()).encode(), MS * 1000)], "topic string, value binary, us long"
    ).withColumn("timestamp", F.timestamp_micros("us"))
    ticks = decode.frame_ticks(decode.decode_frames(frames_from_kafka(records), now_ns=NS))
    assert ticks.first().received_ns == NS


def test_a_feed_of_ones_own(spark):
    """Frames such as `SYM,price,size,b,ns,id` from an exchange the package does not know."""
    def read(parts, text):
        one = decode.candidate_sql(
            symbol=f"{parts}[0]", price=f"{parts}[1]", size=f"{parts}[2]",
            side=f"CASE {parts}[3] WHEN 'b' THEN 'buy' WHEN 's' THEN 'sell' ELSE {parts}[3] END",
            timestamp_ns=f"try_cast({parts}[4] AS BIGINT)", trade_id=f"get({parts}, 5)",
        )
        return F.expr(decode.outcome_sql("NULL", f"array({one})"))

    mine = decode.Decoder("plainex", (lambda text: F.split(text, ","),), read)
    decode.register_decoder(mine)
    try:
        good, bad = run(spark, "plainex", f"AAA,1.5,2,b,{ISO_NS},9", f"AAA,1.5,2,x,{ISO_NS},9")
        assert (good[0], good[2][0].exchange, good[2][0].side) == ("parsed", "plainex", "buy")
        assert (bad[0], bad[1]) == ("error", "Unknown side")
    finally:
        del decode._DECODERS["plainex"]


@pytest.mark.parametrize(
    ("text", "ns"),
    [
        (ISO, ISO_NS),
        ("2023-01-01T00:00:00Z", 1_672_531_200 * 10**9),
        ("2023-01-01T00:00:01.1234567890Z", 1_672_531_201 * 10**9 + 123_456_789),
        ("2023-01-01T00:00:01.5Z", 1_672_531_201 * 10**9 + 500_000_000),
        ("2023-01-01T00:00:01.5", 1_672_531_201 * 10**9 + 500_000_000),
        ("2024-03-10T02:30:00.000000001Z", 1_710_037_800 * 10**9 + 1),
        ("2023-01-01T00:00:01+00:00", None),
        ("2023-13-01T00:00:01Z", None),
        ("2023-01-01", None),
    ],
)
def test_iso_times(spark, text, ns):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = spark.createDataFrame([(text,)], "t string")
        assert rows.select(iso_to_ns("t")).first()[0] == ns
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_subscriptions_fold_case(spark):
    ticks = spark.createDataFrame(
        [("binance", "BTCUSDT"), ("binance", "ETHUSDT"), ("coinbase", "BTC-USD")], "exchange string, symbol string"
    )
    assert decode.subscribed(ticks, ["btcusdt"], "binance").count() == 1
    assert decode.subscribed(ticks, ["btc-usd", "Eth-Usd"], "coinbase").count() == 1
    with pytest.raises(ValueError, match="At least one symbol"):
        decode.subscribed(ticks, [], "binance")


@pytest.mark.parametrize("source", ["binance", "coinbase"])
@pytest.mark.parametrize(
    "after", [',"x":1', ',"z":5}', ',"f":{"e":"trade"}', ',{"a":1}', '],[1', ',"1"', " x", "}"]
)
def test_nothing_may_follow_a_frame(spark, source, after):
    frame = {
        "binance": '{"e":"trade","s":"BTCUSDT","t":1,"p":"1","q":"1","T":1736899200000,"m":true}',
        "coinbase": '{"channel":"market_trades","events":[]}',
    }[source]
    rows = spark.createDataFrame(
        [(source, frame, 1736899200000000000), (source, frame + after, 1736899200000000000)],
        "source string, raw string, received_ns long",
    )
    found = {r.raw: r.status for r in decode.decode_frames(rows).collect()}
    assert found[frame] in ("parsed", "ignored")
    assert found[frame + after] == "error"


# -- feeds read by Python ------------------------------------------------------------------


def test_a_python_feed_gives_the_rows_of_its_sql_twin(spark, sf_dir):
    frames = tables.event_frames(spark, sf_dir)
    twin = decode.decode_frames(frames, tables.AS_OF_NS, python_feeds={"binance": read_binance})
    plain = decode.decode_frames(frames, tables.AS_OF_NS)
    for part in (decode.frame_ticks, decode.frame_errors, lambda d: d.drop("trades")):
        assert part(twin).exceptAll(part(plain)).count() == part(plain).exceptAll(part(twin)).count() == 0
    plan = twin._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPythonUDTF" in plan or "BatchEvalPythonUDTF" in plan
    assert "Exchange" not in plan


def test_a_python_feed_says_why_it_cannot_read(spark):
    def read(text):
        if text == "bad":
            raise ValueError("no such thing")
        good = {"symbol": "S", "price": "1.5", "size": "2", "side": "buy", "timestamp_ns": 1_700_000_000_000_000_000, "trade_id": "1"}
        return [] if text == "none" else [good, good | {"price": "0"}, good | {"trade_id": None}]

    now = 1_700_000_000_000_000_000
    raws = ["bad", "none", "three", None]
    rows = [("mine", raw, now) for raw in raws] + [("binance", "{", now), ("unknown", "x", now), (None, "x", now)]
    frames = spark.createDataFrame(rows, "source string, raw string, received_ns long")
    found = {(r.source, r.raw): r for r in decode.decode_frames(frames, now, python_feeds={"mine": read}).collect()}
    assert len(found) == len(rows)
    assert (found["mine", "bad"].status, found["mine", "bad"].reason) == ("error", "no such thing")
    assert found["mine", "none"].status == "ignored"
    assert (found["mine", "three"].reason, len(found["mine", "three"].trades)) == ("price must be > 0", 1)
    assert found["mine", None].reason == decode.MALFORMED
    assert found["unknown", "x"].reason == found[None, "x"].reason == decode.NO_DECODER


def test_a_python_feed_streams(spark, sf_dir, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    tables.event_frames(spark, sf_dir).write.parquet(landing)
    stream = frame_sources.stream_frames(spark, landing)
    ticks = decode.frame_ticks(decode.decode_frames(stream, tables.AS_OF_NS, python_feeds={"binance": read_binance}))
    (
        ticks.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    batch = decode.frame_ticks(decode.decode_frames(frame_sources.read_frames(spark, landing), tables.AS_OF_NS))
    got = spark.read.schema(ticks.schema).parquet(out)
    assert got.exceptAll(batch).count() == batch.exceptAll(got).count() == 0
