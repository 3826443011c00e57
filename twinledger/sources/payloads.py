"""Trades as JSON payloads, in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinledger.functions.numbers import to_number
from twinledger.operators.validate import trade_reject_reasons
from twinledger.schema import PRICE_TYPE, TRADE_COLUMNS

_PAYLOAD = T.StructType(
    [T.StructField(c, T.StringType()) for c in TRADE_COLUMNS]
    + [T.StructField("_corrupt_record", T.StringType())]
)


def to_json_payload(columns: list[str] | None = None) -> Column:
    return F.to_json(F.struct(*(columns or TRADE_COLUMNS)))


def parse_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON text to typed trades with ``reject_reasons``.

    Every field is read as text and coerced on its own. Reasons tell apart text that is not JSON,
    a field that is absent, and a field whose value breaks a rule.
    """
    parsed = df.withColumn("_p", F.from_json(F.col(payload), _PAYLOAD, {"mode": "PERMISSIVE"}))
    malformed = F.col("_p._corrupt_record").isNotNull() | F.col("_p").isNull()
    text = {c: F.col(f"_p.{c}") for c in TRADE_COLUMNS}
    absent = [F.when(text[c].isNull(), F.lit(f"missing {c}")) for c in TRADE_COLUMNS]
    typed = parsed.withColumns(
        {
            **text,
            "price": to_number(text["price"]).try_cast(PRICE_TYPE),
            "quantity": to_number(text["quantity"]).try_cast("int"),
        }
    )
    missing = F.array_compact(F.array(*absent))
    reasons = (
        F.when(malformed, F.array(F.lit("malformed payload")))
        .when(F.size(missing) > 0, missing)
        .otherwise(trade_reject_reasons())
    )
    return typed.withColumn("reject_reasons", reasons).drop("_p")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
