"""Lenient casts, type buckets and types guessed from column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of booleans.
TRUE_WORDS = ["TRUE", "T", "YES", "Y", "1"]
FALSE_WORDS = ["FALSE", "F", "NO", "N", "0"]

# Target type names and their Spark types.
SPARK_TYPE = {
    "INTEGER": "bigint",
    "INT64": "bigint",
    "FLOAT": "double",
    "FLOAT64": "double",
    "BOOLEAN": "boolean",
    "BOOL": "boolean",
    "TIMESTAMP": "timestamp",
    "DATE": "date",
    "STRING": "string",
}

# Name patterns per type, tried in this order.
NAME_PATTERNS = {
    "INTEGER": {
        "exact": [
            "id", "count", "quantity", "qty", "number", "num", "size", "age", "year", "month", "day", "week",
            "hour", "minute", "second",
        ],
        "prefix": ["num_", "count_", "total_", "max_", "min_", "id_"],
        "suffix": [
            "_id", "_count", "_num", "_qty", "_size", "_age", "_year", "_month", "_day", "_key", "_code",
        ],
        "contains": [],
    },
    "FLOAT64": {
        "exact": [
            "price", "cost", "amount", "rate", "ratio", "percentage", "percent", "score", "weight", "height",
            "latitude", "longitude", "lat", "lon", "lng",
        ],
        "prefix": ["price_", "cost_", "amount_", "rate_", "total_amount", "total_cost"],
        "suffix": [
            "_price", "_cost", "_amount", "_rate", "_ratio", "_percent", "_percentage", "_score", "_weight",
            "_height",
        ],
        "contains": ["amount", "price", "cost", "revenue", "profit", "margin"],
    },
    "TIMESTAMP": {
        "exact": [
            "timestamp", "created_at", "updated_at", "modified_at", "deleted_at", "last_modified",
            "last_updated",
        ],
        "prefix": ["timestamp_", "ts_"],
        "suffix": ["_timestamp", "_at", "_time", "_datetime"],
        "contains": ["timestamp", "_at", "datetime"],
    },
    "DATE": {
        "exact": [
            "date", "birth_date", "start_date", "end_date", "created_date", "updated_date",
        ],
        "prefix": ["date_", "dt_"],
        "suffix": ["_date", "_dt"],
        "contains": ["_date", "date_"],
    },
    "BOOLEAN": {
        "exact": [
            "active", "enabled", "deleted", "valid", "verified", "completed", "success", "failed",
        ],
        "prefix": ["is_", "has_", "can_", "should_", "will_", "was_", "are_"],
        "suffix": ["_flag", "_active", "_enabled", "_deleted"],
        "contains": [],
    },
}


def _present(value: Column) -> Column:
    return F.when(~value.isin("NULL", ""), value)


def _is_text(source: T.DataType) -> bool:
    return isinstance(source, (T.StringType, T.VarcharType, T.CharType))


def lenient_cast(
    value: Column, target: str, source: T.DataType = T.StringType(), mode: str = "safe"
) -> Column:
    """Cast that yields null instead of failing.

    ``safe`` casts numbers as they stand; ``legacy`` strips every character a number cannot hold
    before an integer or float cast, so ``12.50`` becomes 1250. Only text is stripped: a source
    that is already typed is cast directly.
    """
    kind = target.upper()
    spark_type = SPARK_TYPE.get(kind, target.lower())
    text = _is_text(source)
    if kind == "STRING":
        return F.nullif(value.cast("string"), F.lit("NULL"))
    if spark_type == "boolean":
        word = F.upper(value.cast("string"))
        return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))
    if not text:
        return value.try_cast(spark_type)
    given = _present(value)
    if spark_type in ("bigint", "double"):
        keep = "[^0-9-]" if spark_type == "bigint" else "[^0-9.-]"
        digits = F.regexp_replace(given, keep, "") if mode == "legacy" else given
        return digits.try_cast(spark_type)
    calendar = F.when(given.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), given)
    if spark_type == "date":
        compact = F.try_to_timestamp(given, F.lit("yyyyMMdd")).cast("date")
        return F.when(given.rlike("^[0-9]{8}$"), compact).otherwise(calendar.try_cast("date"))
    if spark_type == "timestamp":
        return calendar.try_cast("timestamp")
    return value.try_cast(spark_type)


def type_bucket(type_text: Column, strict: bool = False) -> Column:
    """One of string, integer, numeric, boolean, date, timestamp, other."""
    low = F.lower(type_text)

    def holds(*words: str) -> Column:
        return low.rlike("|".join(words))

    text = holds("string", "varchar") if strict else holds("string", "char")
    date = holds("date") if strict else holds("date") & ~holds("timestamp")
    return (
        F.when(text, F.lit("string"))
        .when(holds("int", "long"), F.lit("integer"))
        .when(holds("double", "float", "decimal"), F.lit("numeric"))
        .when(holds("bool"), F.lit("boolean"))
        .when(date, F.lit("date"))
        .when(holds("timestamp"), F.lit("timestamp"))
        .otherwise(F.lit("other"))
    )


def _pattern(rules: dict[str, list[str]]) -> str:
    forms = {"exact": "^({})$", "prefix": "^({})", "suffix": "({})$", "contains": "({})"}
    return "|".join(form.format("|".join(rules[kind])) for kind, form in forms.items() if rules[kind])


def infer_type(name: Column, current: Column) -> Column:
    """Better type for a STRING column judged by its name; other types stay."""
    low = F.lower(name)
    guess = F.when(current != "STRING", current)
    for kind, rules in NAME_PATTERNS.items():
        guess = guess.when(low.rlike(_pattern(rules)), F.lit(kind))
    return guess.otherwise(current)
