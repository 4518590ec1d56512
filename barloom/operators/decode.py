"""Frames to points, announcements and refused frames, in one parse.

Payloads become VARIANT, whose casts coerce the way the feed's consumers do
(`12.0`, `"12"` and `true` are integers, NULL and `"12.7"` are not). Every test
is a `try_` expression, so no frame can fail a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import market
from barloom.functions import timeconv as tc
from barloom.functions.settle import settled
from barloom.schemas import CONTROL_TOPIC, PROTOCOL, QUANTITIES, WIRE_PRICES

POINT, ANNOUNCEMENT = "point", "announcement"
# A wrong protocol on an announcement is logged, but not counted as refused.
UNCOUNTED = "announcement_protocol"

POINT_COLUMNS = [
    "arrival", "symbol", "bar_time", "bar_type", "bar_interval", "category",
    "open", "high", "low", "close", *QUANTITIES, "bid", "ask", "ts",
    "time_from_receive_clock", "wall_clock_skipped", "wall_clock_repeated",
]


def route(frames: DataFrame, subscribed: DataFrame | None = None) -> DataFrame:
    """Label frames by topic and drop topics nobody subscribed to.

    The transport matches prefixes, so a topic must equal a subscribed symbol.
    Dropped frames are neither refused nor seen by the loss count.
    """
    control = F.col("topic") == CONTROL_TOPIC
    labelled = frames.withColumn("route", F.when(control, ANNOUNCEMENT).otherwise(POINT))
    if subscribed is None:
        return labelled
    wanted = subscribed.select(F.col("id").alias("topic")).distinct()
    joined = labelled.join(wanted.withColumn("_wanted", F.lit(True)), "topic", "left")
    return joined.where(control | F.col("_wanted")).drop("_wanted")


# Typed fields come out in one cast and fields whose JSON type matters in another;
# an unusable field is NULL without spoiling its neighbours.
TYPED = ", ".join(
    [
        *[f"{c} bigint" for c in ("seq", "sid", "bar_type", "bar_interval", "category")],
        *[f"{c} double" for c in ("proto", "ts", "o", "h", "l", "c", "bid", "ask")],
        *[f"{c} bigint" for c in QUANTITIES],
        "ts_str string, symbol string",
    ]
)
AS_SENT = ", ".join(f"{c} variant" for c in ("seq", "sid", "proto", "bid", "ask", "symbol"))


def _first_unusable(required: list[tuple[Column, str]]) -> Column:
    """The refusal reason for the first `(is unusable, key)` that holds."""
    keys = F.array(*[F.when(bad, F.lit(key)) for bad, key in required])
    key = F.get(F.array_compact(keys), F.lit(0))
    sent = F.try_variant_get("_v", F.concat(F.lit("$."), key), "variant")
    return F.concat(F.when(sent.isNull(), "missing_").otherwise("bad_"), key)


def _given(name: str) -> Column:
    """Present and not a JSON null."""
    sent = F.col(f"_sent.{name}")
    return sent.isNotNull() & ~F.coalesce(F.is_variant_null(sent), F.lit(False))


def _is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def decode(frames: DataFrame, subscribed: DataFrame | None = None) -> DataFrame:
    """One row per routed frame with its typed fields and first refusal reason.

    `observed` marks frames the loss count sees: any JSON object whose `seq` is
    an integer, also when a later check refuses the frame.
    """
    keep = [c for c in ("landed_at", "payload_invalid_utf8") if c in frames.columns]
    base = ["arrival", "topic", "route", "payload", *keep, "_v"]
    point = F.col("route") == POINT
    parsed = (
        route(frames, subscribed)
        .withColumn("_v", F.try_parse_json("payload"))
        .withColumns(
            {
                "_typed": F.try_variant_get("_v", "$", f"struct<{TYPED}>"),
                "_sent": F.try_variant_get("_v", "$", f"struct<{AS_SENT}>"),
            }
        )
    )
    fields = parsed.select(
        *base,
        F.col("payload").rlike(r"^\s*\{").alias("_object"),
        "_typed.seq",
        F.when(F.col("_sent.sid").isNull(), 0).otherwise(F.col("_typed.sid")).alias("sid"),
        _given("seq").alias("_numbered"),
        F.col("_sent.seq").isNotNull().alias("_has_seq"),
        (
            F.coalesce(F.col("_typed.proto") == PROTOCOL, F.lit(False))
            & ~_is_string(F.col("_sent.proto"))
        ).alias("_proto_ok"),
        F.when(~point & _is_string(F.col("_sent.symbol")), F.col("_typed.symbol")).alias(
            "_announced"
        ),
        F.col("_typed.ts_str").alias("_stamp"),
        tc.parse_wall_clock(F.col("_typed.ts_str")).alias("_wall"),
        *[F.col(f"_typed.{c}") for c in ("bar_type", "bar_interval", "category")],
        *[F.col(f"_typed.{key}").alias(name) for name, key in WIRE_PRICES.items()],
        *[F.col(f"_typed.{q}") for q in QUANTITIES],
        *[F.col(f"_typed.{q}").alias(f"_{q}") for q in ("bid", "ask")],
        *[(_given(q) & F.col(f"_typed.{q}").isNull()).alias(f"_bad_{q}") for q in ("bid", "ask")],
        "_typed.ts",
    )
    # A stamp that is no text counts as absent; only text can be unreadable.
    unread = F.col("_wall").isNull() & (F.col("_stamp") != "")
    timed = fields.withColumn(
        "_bad_stamp", F.when(unread, _is_string(F.try_variant_get("_v", "$.ts_str", "variant"))).otherwise(F.lit(False))
    ).withColumn(
        "bar_time",
        F.when(F.col("_wall").isNotNull(), tc.floor_minute(tc.instant_of(F.col("_wall")))).when(
            ~F.col("_bad_stamp"), tc.floor_minute(tc.from_epoch(F.col("ts")))
        ),
    )

    is_object = F.col("_v").isNotNull() & F.coalesce(F.col("_object"), F.lit(False))
    numbered = F.col("seq").isNotNull() & F.col("sid").isNotNull()
    required = ["bar_time", "bar_type", "bar_interval", "category", *WIRE_PRICES, *QUANTITIES, "ts"]
    complete = F.col("_proto_ok") & F.col("_has_seq") & ~F.col("_bad_bid") & ~F.col("_bad_ask")
    for c in required:
        complete = complete & F.col(c).isNotNull()
    checked = timed.withColumns(
        {
            "_fine": point & is_object & complete & (~F.col("_numbered") | numbered),
            "_observed": is_object & F.col("_numbered") & numbered,
        }
    )

    unreadable = F.coalesce(
        F.when(F.col("payload").isNull(), F.lit("not_utf8")),
        F.when(F.col("_v").isNull(), F.lit("bad_json")),
        F.when(~is_object, F.lit("not_an_object")),
        F.when(F.col("_numbered") & F.col("seq").isNull(), F.lit("bad_seq")),
        F.when(F.col("_numbered") & F.col("sid").isNull(), F.lit("bad_sid")),
    )
    def empty(*columns: str) -> list[tuple[Column, str]]:
        return [(F.col(c).isNull(), WIRE_PRICES.get(c, c)) for c in columns]

    point_reason = F.coalesce(
        unreadable,
        F.when(~F.col("_proto_ok"), F.lit("bad_proto")),
        F.when(~F.col("_has_seq"), F.lit("missing_seq")),
        F.when(F.col("_bad_stamp"), F.lit("bad_ts_str")),
        _first_unusable(
            [
                (F.col("bar_time").isNull(), "ts"),
                *empty("bar_type", "bar_interval", "category", *WIRE_PRICES),
                *[(F.col(f"_bad_{q}"), q) for q in ("bid", "ask")],
                *empty("ts", *QUANTITIES),
            ]
        ),
    )
    nameless = F.coalesce(F.col("_announced") == "", F.lit(True))
    hello_reason = F.coalesce(
        unreadable,
        F.when(~F.col("_proto_ok"), F.lit(UNCOUNTED)),
        _first_unusable([(nameless, "symbol"), *empty("category", "bar_type", "bar_interval")]),
    )
    reason = F.when(F.col("_fine"), F.lit(None)).otherwise(
        F.when(point, point_reason).otherwise(hello_reason)
    )
    wall = F.col("_wall")
    return checked.select(
        *base[:-1],
        "seq",
        "sid",
        settled(F.coalesce("_observed", F.lit(False))).alias("observed"),
        settled(reason).alias("refusal_reason"),
        F.when(point, F.col("topic")).otherwise(F.col("_announced")).alias("symbol"),
        "bar_time",
        "bar_type",
        "bar_interval",
        "category",
        *WIRE_PRICES,
        *QUANTITIES,
        market.quote(F.col("_bid")).alias("bid"),
        market.quote(F.col("_ask")).alias("ask"),
        "ts",
        wall.isNull().alias("time_from_receive_clock"),
        F.coalesce(tc.wall_clock_skipped(wall), F.lit(False)).alias("wall_clock_skipped"),
        F.coalesce(tc.wall_clock_repeated(wall), F.lit(False)).alias("wall_clock_repeated"),
    )


def points(decoded: DataFrame) -> DataFrame:
    accepted = (F.col("route") == POINT) & F.col("refusal_reason").isNull()
    return decoded.where(accepted).select(*POINT_COLUMNS)


def announcements(decoded: DataFrame) -> DataFrame:
    accepted = (F.col("route") == ANNOUNCEMENT) & F.col("refusal_reason").isNull()
    return decoded.where(accepted).select(
        "arrival", "symbol", "bar_type", "bar_interval", "category"
    )


def refused(decoded: DataFrame) -> DataFrame:
    """Frames for the dead-letter table: counted refusals, payload untouched."""
    kept = [c for c in ("payload_invalid_utf8", "landed_at") if c in decoded.columns]
    return decoded.where(
        F.col("refusal_reason").isNotNull() & (F.col("refusal_reason") != UNCOUNTED)
    ).select("arrival", "topic", "payload", *kept, "refusal_reason")


def refusals_by_reason(decoded: DataFrame) -> DataFrame:
    return refused(decoded).groupBy("refusal_reason").agg(F.count("*").alias("frames"))


def observed(decoded: DataFrame) -> DataFrame:
    return decoded.where("observed").select("arrival", "sid", "topic", "seq")


def numbers(frames: DataFrame, subscribed: DataFrame | None = None) -> DataFrame:
    """`observed(decode(frames))` for those who need nothing else of a frame: of its fields
    only the counter's two are cast."""
    parsed = route(frames, subscribed).withColumn("_v", F.try_parse_json("payload"))
    pair = parsed.select(
        "arrival",
        "topic",
        F.col("payload").rlike(r"^\s*\{").alias("_object"),
        settled(F.try_variant_get("_v", "$", "struct<seq bigint, sid bigint>")).alias("_typed"),
        settled(F.try_variant_get("_v", "$", "struct<seq variant, sid variant>")).alias("_sent"),
    )
    fields = pair.select(
        "arrival",
        F.when(F.col("_sent.sid").isNull(), 0).otherwise(F.col("_typed.sid")).alias("sid"),
        "topic",
        "_typed.seq",
        (F.col("_object") & _given("seq")).alias("_numbered"),
    )
    return fields.where("_numbered AND seq IS NOT NULL AND sid IS NOT NULL").drop("_numbered")
