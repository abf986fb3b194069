"""Column expressions shared by the operators.  All run inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk per country code, any other country gets the default.
COUNTRY_RISK = {
    "GB": 0.2,
    "US": 0.3,
    "DE": 0.2,
    "AU": 0.3,
    "SG": 0.4,
    "BE": 0.2,
    "FR": 0.2,
    "CA": 0.3,
}
DEFAULT_COUNTRY_RISK = 0.5

# Class codes, deliberately not alphabetical.
LABEL_CODES = {"Iris-versicolor": 0, "Iris-virginica": 1, "Iris-setosa": 2}
LABEL_NAMES = {
    "Setosa": "Iris-setosa",
    "Versicolor": "Iris-versicolor",
    "Virginica": "Iris-virginica",
}

MAX_ERROR_CHARS = 2048

# Exact type for money: sums of it do not depend on the order of addition.
MONEY = "decimal(28,9)"


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or null."""
    return F.when(condition, 1).otherwise(0)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when dividing by zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def days_since(registered: Column, event: Column) -> Column:
    """Whole days from registration to the event, never negative, null if either is null."""
    days = F.datediff(event.cast("date"), registered.cast("date"))
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0))).cast("bigint")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def day_of_week(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts).cast("bigint")


def lookup(value: Column, mapping: Mapping, otherwise: Column) -> Column:
    """CASE over a fixed mapping."""
    chain = F
    for key, mapped in mapping.items():
        chain = chain.when(value == F.lit(key), F.lit(mapped))
    return chain.otherwise(otherwise)


def country_risk(country: Column) -> Column:
    return lookup(country, COUNTRY_RISK, F.lit(DEFAULT_COUNTRY_RISK))


def label_code(label: Column) -> Column:
    """Class code as text; a label without a code passes through unchanged."""
    return lookup(label, {k: str(v) for k, v in LABEL_CODES.items()}, label)


def label_code_strict(label: Column) -> Column:
    """Class code as a number, null for a label without a code."""
    return lookup(label, LABEL_CODES, F.lit(None).cast("int")).cast("bigint")


def batch_entity_id(row_id: Column, source: Column) -> Column:
    """``{Id}_{source}``; a null source gives null, a null Id fails the job."""
    checked = F.coalesce(
        row_id.cast("bigint"), F.raise_error(F.lit("Id must not be null")).cast("bigint")
    )
    return F.concat(checked.cast("string"), F.lit("_"), source)


def stream_entity_id(sample_id: Column) -> Column:
    """``{sample_id}_streaming``; an absent or zero id gets eight random hex digits."""
    random_hex = F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 8)
    given = F.when(sample_id != 0, sample_id.cast("string"))
    return F.concat(F.coalesce(given, random_hex), F.lit("_streaming"))


def resolved_entity_id(entity_id: Column, sample_id: Column) -> Column:
    """Entity id if non-empty, else ``{sample_id}_streaming``, else null."""
    derived = F.concat(sample_id.cast("string"), F.lit("_streaming"))
    return F.coalesce(F.nullif(entity_id, F.lit("")), derived)


def truncated(message: Column) -> Column:
    return F.substring(message, 1, MAX_ERROR_CHARS)


def readable(payload: Column) -> Column:
    """Bytes as text when they are UTF-8, otherwise as hex; null stays null."""
    return F.coalesce(F.try_validate_utf8(payload.cast("string")), F.hex(payload))


def features_json(names: Sequence[str]) -> Column:
    return F.to_json(F.struct(*names))


def prediction_text(prediction: Column) -> Column:
    return F.coalesce(prediction.cast("string"), F.lit("unknown"))


def unix_second(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def hash_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """Seeded bucket 0..buckets-1 of a key, the same in every engine that has md5."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
