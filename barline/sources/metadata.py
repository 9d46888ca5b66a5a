"""Exchange metadata: JSON documents as universe, margin-pair and margin-asset rows.

A key that is absent takes its default, and an explicit null counts as false, so documents are
read as VARIANT: a struct schema could not tell the two apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_documents(spark: SparkSession, path) -> DataFrame:
    """One row `value` per file. Exchange metadata is a single document of a few megabytes."""
    return spark.read.text(path, wholetext=True)


def _field(item: str, key: str, kind: str) -> Column:
    return F.try_variant_get(item, f"$.{key}", kind)


def truthy(item: str, key: str, default) -> Column:
    """Truth of a JSON value the way a script would see it, or `default` if the key is absent."""
    value = _field(item, key, "variant")
    text = _field(item, key, "string")
    kind = F.schema_of_variant(value)
    default = default if isinstance(default, Column) else F.lit(default)
    return (
        F.when(value.isNull(), default)
        .when(F.is_variant_null(value), F.lit(False))
        .when(kind == "BOOLEAN", _field(item, key, "boolean"))
        .when(kind == "STRING", text != "")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(F.coalesce(_field(item, key, "double") != 0, F.lit(True)))
    )


def _items(json_df: DataFrame, path: str) -> DataFrame:
    items = F.variant_get(F.parse_json("value"), path, "array<variant>")
    return json_df.select(F.posexplode(items).alias("position", "item"))


def _required(key: str) -> Column:
    message = F.lit(f"exchange metadata: a symbol has no {key}")
    return F.coalesce(_field("item", key, "string"), F.raise_error(message).cast("string"))


def parse_symbols(json_df: DataFrame) -> DataFrame:
    """Universe rows of {"symbols": [...]} documents, with their place in the document.

    A symbol without a name or a status fails the job.
    """
    permissions = F.coalesce(_field("item", "permissions", "array<string>"), F.array().cast("array<string>"))
    text = lambda key: F.when(
        _field("item", key, "variant").isNull(), F.lit("")
    ).otherwise(_field("item", key, "string"))
    return _items(json_df, "$.symbols").select(
        "position",
        _required("symbol").alias("symbol"),
        _required("status").alias("status"),
        text("baseAsset").alias("base_asset"),
        text("quoteAsset").alias("quote_asset"),
        F.coalesce(_field("item", "orderTypes", "array<string>"), F.array().cast("array<string>")).alias(
            "order_types"
        ),
        permissions.alias("permissions"),
        truthy("item", "isMarginTradingAllowed", F.array_contains(permissions, "MARGIN")).alias(
            "is_margin_trading_allowed"
        ),
    )


def _flagged(json_df: DataFrame, key: str, flag: str, default: bool, name: str) -> DataFrame:
    value = _field("item", key, "string")
    rows = _items(json_df, "$").where(F.coalesce(value, F.lit("")) != "")
    return rows.select("position", F.upper(value).alias(key), truthy("item", flag, default).alias(name))


def parse_margin_pairs(json_df: DataFrame) -> DataFrame:
    """(symbol, is_margin_trade) of [{...}] documents; the flag is true if absent."""
    return _flagged(json_df, "symbol", "isMarginTrade", True, "is_margin_trade")


def parse_margin_assets(json_df: DataFrame) -> DataFrame:
    """(asset, is_borrowable) of [{...}] documents; the flag is false if absent."""
    return _flagged(json_df, "asset", "isBorrowable", False, "is_borrowable")
