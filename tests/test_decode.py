from feed import collect, frames, hello, payload, utc_text

from pyspark.sql import functions as F

from barloom.operators import announcements as ann
from barloom.operators import conformance, wire_report
from barloom.operators import decode as dec
from barloom.plans import adapters
from barloom.schemas import POINT_KEYS
from barloom.sources import frames as source
from barloom.sources.symbols import symbols_table

SPY_ONLY = [{"id": "SPY", "category": "etf", "role": "trade"}]


def decoded(spark, messages, subscribed=None):
    return dec.decode(frames(spark, messages), subscribed)


def reasons(spark, texts, topic="SPY"):
    rows = decoded(spark, [(topic, t) for t in texts]).orderBy("arrival").collect()
    return [r["refusal_reason"] for r in rows]


def test_every_field_of_a_point(spark):
    out = dec.points(decoded(spark, [("SPY", payload())]))
    assert collect(out, utc_text("bar_time")) == [("2026-05-06 15:42:00",)]
    row = out.first()
    assert [row[c] for c in ("low", "bid", "open", "close", "ask", "high")] == [73.0, 73.125, 73.25, 73.375, 73.5, 73.625]
    assert row["ts"] == 1778082137.25
    quantities = [row[c] for c in ("el_volume", "el_ticks", "el_upticks", "el_downticks", "el_open_interest")]
    assert quantities == [642, 59, 391, 251, 17]


def test_refusals_in_order_of_checks(spark):
    cases = {
        "nonsense": "bad_json",
        "[1]": "not_an_object",
        "null": "not_an_object",
        payload(seq="x"): "bad_seq",
        payload(sid=None): "bad_sid",
        payload(proto=1, seq="x"): "bad_seq",
        payload(proto=1): "bad_proto",
        payload(proto="2"): "bad_proto",
        payload(proto=...): "bad_proto",
        payload(seq=...): "missing_seq",
        payload(ts_str="2026-04/18-01:30:45 下午"): "bad_ts_str",
        payload(ts_str="2026-004/18-13:30:45"): "bad_ts_str",
        payload(ts_str="", ts="x"): "bad_ts",
        payload(ts_str=..., ts=...): "missing_ts",
        payload(bar_type=...): "missing_bar_type",
        payload(bar_interval=None): "bad_bar_interval",
        payload(o="abc"): "bad_o",
        payload(bid="abc"): "bad_bid",
        payload(ts=None): "bad_ts",
        payload(el_volume=...): "missing_el_volume",
        payload(el_ticks=None): "bad_el_ticks",
        payload(el_ticks="12.7"): "bad_el_ticks",
        payload(category=[1]): "bad_category",
        '{"proto":2,"seq":99,"sid":1,"ts":1.0,"ts_str":""}': "missing_bar_type",
        '{"v":4,"pv":1,"kind":"tick","seq":1}': "bad_proto",
    }
    assert reasons(spark, cases) == list(cases.values())


def test_accepted_spellings(spark):
    texts = [
        payload(proto=2.0),
        payload(seq=None),
        payload(sid=...),
        payload(el_ticks=12.7, bar_type="1", category=True),
        payload(ts_str=5),
        payload(ts_str=None),
        payload(bid=..., ask=0),
        payload(extra="key"),
        payload(ts_str="2026-4/8-9:5:1"),
        payload().replace('"seq": 1', '"seq": 1, "seq": 3'),
    ]
    assert reasons(spark, texts) == [None] * len(texts)
    rows = decoded(spark, [("SPY", t) for t in texts]).orderBy("arrival").collect()
    assert [r["observed"] for r in rows[:3]] == [True, False, True]
    assert (rows[2]["sid"], rows[9]["seq"]) == (0, 3)
    assert (rows[3]["el_ticks"], rows[3]["bar_type"], rows[3]["category"]) == (12, 1, 1)
    assert [r["time_from_receive_clock"] for r in rows[4:6]] == [True, True]
    assert (rows[6]["bid"], rows[6]["ask"]) == (None, None)


def test_refused_frames_keep_their_payload_and_never_stop_the_rest(spark):
    out = decoded(spark, [("SPY", "junk"), ("SPY", payload(ts=1e300, ts_str=...)), ("SPY", payload())])
    kept = dict(collect(dec.refused(out), "refusal_reason", "payload"))
    assert kept["bad_json"] == "junk"
    assert dec.points(out).count() == 1
    assert dict(collect(dec.refusals_by_reason(out), "refusal_reason", "frames")) == {"bad_json": 1, "bad_ts": 1}


def test_refused_frames_are_still_counted_for_loss(spark):
    out = decoded(spark, [("SPY", payload(proto=1, seq=5)), ("SPY", "junk")])
    assert collect(dec.observed(out), "seq") == [(5,)]


def test_prefix_topics_are_dropped_not_refused(spark):
    out = decoded(spark, [("SPYG", payload()), ("SPY", payload())], symbols_table(spark, SPY_ONLY))
    assert collect(out, "topic", "refusal_reason") == [("SPY", None)]


def test_daylight_saving_flags(spark):
    stamps = ["2026-03/08-02:30:00", "2026-11/01-01:30:00", "2026-11/01-02:30:00"]
    out = dec.points(decoded(spark, [("SPY", payload(ts_str=s)) for s in stamps])).orderBy("arrival")
    assert collect(out, utc_text("bar_time"), "wall_clock_skipped", "wall_clock_repeated") == [
        ("2026-03-08 07:30:00", True, False),
        ("2026-11-01 05:30:00", False, True),
        ("2026-11-01 07:30:00", False, False),
    ]


def test_announcements(spark):
    messages = [
        ("__ts2py__", hello(category=1)),
        ("__ts2py__", hello(seq=2, category=2)),
        ("__ts2py__", hello(symbol="QQQ", bar_interval=5)),
        ("__ts2py__", hello(symbol=None)),
        ("__ts2py__", hello(symbol="")),
        ("__ts2py__", hello(symbol=...)),
        ("__ts2py__", hello(proto=1)),
        ("__ts2py__", hello(category="x")),
        ("SPY", payload()),
    ]
    symbols = symbols_table(spark, [*SPY_ONLY, {"id": "VXX", "category": "volatility", "role": "context"}])
    out = decoded(spark, messages, symbols)
    charts = ann.announced_charts(dec.announcements(out))
    marked = ann.with_subscription(charts, symbols).orderBy("symbol")
    assert collect(marked, "symbol", "bar_interval", "category", "receiving") == [
        ("QQQ", 5, 2, False),
        ("SPY", 1, 2, True),
    ]
    assert collect(ann.unsubscribed_charts(charts, symbols), "symbol") == [("QQQ",)]
    assert collect(ann.silent_symbols(symbols, charts), "id") == [("VXX",)]
    assert sorted(collect(dec.refusals_by_reason(out), "refusal_reason", "frames")) == [
        ("bad_category", 1),
        ("bad_symbol", 2),
        ("missing_symbol", 1),
    ]


def test_conformance_is_stricter_than_decoding(spark):
    messages = [
        ("SPY", payload()),
        ("SPY", payload(extra=1, bid=None)),
        ("SPY", payload(seq=0, category=True, ts="1", el_ticks=1.5)),
        ("__ts2py__", hello(symbol="")),
        ("SPY", "[1]"),
        ("SPY", payload(proto=2.0)),
    ]
    found = conformance.violations(frames(spark, messages))
    assert sorted(collect(found, "arrival", "violation")) == [
        (1, "extra:extra"),
        (2, "minimum:seq"),
        (2, "type:category"),
        (2, "type:el_ticks"),
        (2, "type:ts"),
        (3, "minLength:symbol"),
        (4, "type:object"),
    ]


def test_recording_order_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"topic":"A","payload":"1"}\n\n{"topic":"B","payload":"2"}\n')
    (tmp_path / "b.jsonl").write_text('{"topic":"C","payload_invalid_utf8":"?"}\n')
    read = source.read_recording(spark, str(tmp_path))
    assert collect(read.orderBy("arrival"), "arrival", "topic", "payload", "payload_invalid_utf8") == [
        (0, "A", "1", None),
        (1, "B", "2", None),
        (2, "C", None, "?"),
    ]


def test_log_messages_become_frames(spark):
    rows = [(b"SPY", b'{"a":1}', 4, None), (b"SPY", b"\xff{", 5, None)]
    log = spark.createDataFrame(rows, "key binary, value binary, offset bigint, timestamp timestamp")
    out = source.frames_from_log(log).orderBy("arrival").collect()
    assert (out[0]["payload"], out[0]["payload_invalid_utf8"]) == ('{"a":1}', None)
    assert out[1]["payload"] is None and out[1]["payload_invalid_utf8"].endswith("{")


def test_latency_percentiles_by_direct_sorting(spark):
    import random
    import statistics
    from datetime import datetime, timedelta, timezone

    from barloom.schemas import FRAME

    rng = random.Random(3)
    base = datetime(2026, 4, 20, tzinfo=timezone.utc)
    rows, expected = [], []
    for i in range(301):
        sent = base.timestamp() + i
        delay = rng.choice([rng.uniform(0, 0.01), rng.uniform(0, 5000), rng.uniform(0, 900_000)])
        landed = base + timedelta(seconds=i) + timedelta(microseconds=int(delay * 1e6))
        rows.append((i, "SPY", payload(ts=sent), None, landed))
        micros = (landed - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
        expected.append((micros / 1e6 - sent) * 1000.0)
    expected.sort()
    got = wire_report.latency_percentiles(spark.createDataFrame(rows, FRAME)).first()
    pick = lambda p: expected[min(int(len(expected) * p), len(expected) - 1)]
    assert tuple(got) == (301, statistics.median(expected), pick(0.95), pick(0.99), expected[-1])


def test_conformance_reads_and_parses_once(spark, tmp_path):
    frames(spark, [("SPY", payload())]).write.parquet(str(tmp_path / "frames"))
    found = conformance.violations(spark.read.parquet(str(tmp_path / "frames")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 1


def test_conformance_looks_no_field_up_by_name(spark):
    found = conformance.violations(frames(spark, [("SPY", payload())]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at" not in plan


def test_conformance_of_odd_fields(spark):
    messages = [
        ("SPY", payload(seq=2.5, bar_type=60.0, ask={"a": 1})),
        ("SPY", payload(seq=[1], ts_str=None, o="1.5")),
        ("SPY", "null"),
        ("SPY", "{}"),
        ("__ts2py__", hello(symbol=None)),
    ]
    found = sorted(collect(conformance.violations(frames(spark, messages)), "arrival", "violation"))
    assert [r for r in found if r[0] != 3] == [
        (0, "type:ask"),
        (0, "type:seq"),
        (1, "type:o"),
        (1, "type:seq"),
        (1, "type:ts_str"),
        (2, "type:object"),
        (4, "type:symbol"),
    ]
    assert sorted(v for a, v in found if a == 3) == sorted(f"missing:{k}" for k in POINT_KEYS)


def test_numbers_are_those_of_decoding(spark):
    texts = [
        payload(), payload(seq=None), payload(seq="7"), payload(seq=7.5), payload(sid=None), payload(sid="x"), payload(sid=[1]),
        payload(seq=2**70), payload(proto=1, ts_str="soon"), '{"seq": 3}', ' {"seq": 4, "sid": 9}', '{"seq": true, "sid": "8"}',
        "[1]", "null", "{}", "not json", None, '{"seq": 1, "seq": 2}',
    ]
    told = frames(spark, [(topic, t) for topic in ("SPY", "__ts2py__", "QQQ") for t in texts])
    for subscribed in (None, symbols_table(spark, SPY_ONLY)):
        want = dec.observed(dec.decode(told, subscribed)).select("arrival", "sid", "topic", "seq").collect()
        found = dec.numbers(told, subscribed)
        assert sorted(found.collect()) == sorted(want) and want
    assert "bar_interval" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_a_landed_part_writes_payloads_for_its_own_frames_alone(spark):
    early = F.col("landed_at") < F.lit("2024-01-15").cast("timestamp")
    sf_dir = "/root/testdata/sf0.001"
    parts = [adapters.frames(spark, sf_dir, part) for part in (early, ~early)]
    both = parts[0].unionByName(parts[1])
    whole = adapters.frames(spark, sf_dir)
    assert both.exceptAll(whole).isEmpty() and whole.exceptAll(both).isEmpty()
    plan = parts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("StructsToJson") < plan.index("Filter")
