"""Frames against their closed schema: keys, types and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.settle import settled
from barloom.schemas import CONTROL_TOPIC, HELLO_KEYS, POINT_KEYS, PROTOCOL

STRINGS, NUMBERS, NULLABLE = {"ts_str", "symbol"}, {"ts", "o", "h", "l", "c", "bid", "ask"}, {
    "bid",
    "ask",
}


def _numeric(key: str) -> Column:
    kind = F.col(f"_k_{key}")
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _violation(key: str) -> Column:
    kind, value = F.col(f"_k_{key}"), F.col(f"_number.{key}")
    if key in STRINGS:
        ok = kind == "STRING"
    elif key in NUMBERS:
        ok = _numeric(key)
        if key in NULLABLE:
            ok = ok | (kind == "VOID")
    else:
        ok = _numeric(key) & (value == F.floor(value))
    return F.when(kind.isNull(), F.lit(f"missing:{key}")).when(ok, F.lit(None)).otherwise(F.lit(f"type:{key}"))


def _limits(keys: list[str]) -> list[Column]:
    checks = [
        F.when(_numeric("proto") & (F.col("_number.proto") != PROTOCOL), F.lit("const:proto")),
        F.when(_numeric("seq") & (F.col("_number.seq") < 1), F.lit("minimum:seq")),
    ]
    if "symbol" in keys:
        empty = F.try_variant_get("_sent.symbol", "$", "string") == ""
        checks.append(F.when((F.col("_k_symbol") == "STRING") & empty, F.lit("minLength:symbol")))
    return checks


def violations(frames: DataFrame) -> DataFrame:
    """One row per (frame, broken rule). The topic picks the schema.

    Frames are read once and a payload is parsed once. Its known fields come out in one
    cast, the numbers among them in another; no field is looked up by its name.
    """
    known = [*POINT_KEYS, *(k for k in HELLO_KEYS if k not in POINT_KEYS)]
    whole = [k for k in known if k not in STRINGS | NUMBERS]
    parsed = frames.select("arrival", "topic", settled(F.try_parse_json("payload")).alias("_v"))

    def cast(kind: str) -> Column:
        return settled(F.try_variant_get("_v", "$", kind))

    fields = parsed.select(
        "arrival",
        "topic",
        F.col("_v").isNull().alias("_unread"),
        cast(f"struct<{', '.join(f'{k} variant' for k in known)}>").alias("_sent"),
        cast(f"struct<{', '.join(f'{k} double' for k in whole)}>").alias("_number"),
        F.map_keys(cast("map<string,variant>")).alias("_keys"),
    )
    typed = fields.select("*", *[F.schema_of_variant(f"_sent.{k}").alias(f"_k_{k}") for k in known])

    def broken(keys: list[str]) -> Column:
        extra = F.transform(
            F.array_except("_keys", F.array(*[F.lit(k) for k in keys])),
            lambda k: F.concat(F.lit("extra:"), k),
        )
        return F.concat(F.array_compact(F.array(*[_violation(k) for k in keys], *_limits(keys))), extra)

    found = (
        F.when(F.col("_unread"), F.array(F.lit("not_json")))
        .when(F.col("_sent").isNull(), F.array(F.lit("type:object")))
        .when(F.col("topic") == CONTROL_TOPIC, broken(HELLO_KEYS))
        .otherwise(broken(POINT_KEYS))
    )
    return typed.select("arrival", "topic", F.explode(found).alias("violation"))
