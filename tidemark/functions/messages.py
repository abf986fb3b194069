"""Lax typed reading of JSON messages, the error taxonomy, and dead-letter rows.

Payloads are parsed once into VARIANT; every check is a JVM expression on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import DEAD_LETTER_SCHEMA, conform, traced
from tidemark.functions.scalars import readable, resolved_entity_id, truncated

FEATURE_FIELDS = ("sepal_length", "sepal_width", "petal_length", "petal_width")

# Text forms accepted as a number.
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"

BAD_JSON = "json_decode"
INVALID = "validation"
MISSING_ID = "missing_field"
MISSING_FEATURES = "missing_features"
FETCH_ERROR = "fetch_error"
SHORT_REPLY = "short_reply"


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later filters and projections refer to instead of re-evaluating.

    The optimizer copies a projected expression into every filter pushed below it, which
    would parse a payload again per rule.  Values that come out of a generator stay put.
    """
    fields = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.explode(F.array(fields)).alias("_once")).select(
        *df.columns, "_once.*"
    )


def _opened(messages: DataFrame, payload: str, fields: tuple[str, ...]) -> DataFrame:
    """Parses each payload once; per field its JSON type and its text.

    The type is VOID for an explicit null and SQL null for an absent field.
    """
    text = F.try_validate_utf8(F.col(payload).cast("string"))
    parsed = computed_once(messages, _doc=F.try_parse_json(text))
    doc = F.col("_doc")
    is_object = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    opened = {"_object": is_object}
    for name in fields:
        described = F.schema_of_variant(F.try_variant_get(doc, f"$.{name}", "variant"))
        opened[f"_type_{name}"] = F.regexp_extract(described, r"^[A-Z]+", 0)
        opened[f"_text_{name}"] = F.try_variant_get(doc, f"$.{name}", "string")
    return computed_once(parsed, **opened).drop("_doc")


def _lax_double(name: str) -> Column:
    """A finite double from a JSON number, boolean or numeric text, else null."""
    kind, text = F.col(f"_type_{name}"), F.col(f"_text_{name}")
    value = (
        F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), text.try_cast("double"))
        .when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
        .when((kind == "STRING") & text.rlike(DECIMAL_TEXT), F.trim(text).try_cast("double"))
    )
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def _lax_long(name: str) -> Column:
    """An integer from a whole JSON number, boolean or whole numeric text, else null."""
    kind, text = F.col(f"_type_{name}"), F.col(f"_text_{name}")
    number = text.try_cast("double")
    return (
        F.when(kind == "BIGINT", text.try_cast("bigint"))
        .when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0))
        .when(
            kind.isin("DECIMAL", "DOUBLE", "FLOAT") & (number == F.floor(number)),
            number.try_cast("bigint"),
        )
        .when(
            (kind == "STRING") & text.rlike(INTEGER_TEXT),
            F.regexp_extract(text, r"[+-]?\d+", 0).try_cast("bigint"),
        )
    )


def _given(name: str) -> Column:
    """The field is present and not null."""
    return F.coalesce(F.col(f"_type_{name}") != "VOID", F.lit(False))


def _error(kind: Column, message: Column) -> Column:
    return F.when(
        kind.isNotNull(),
        F.struct(kind.alias("error_type"), truncated(message).alias("error_message")),
    )


def read_feature_messages(messages: DataFrame, payload: str = "value") -> DataFrame:
    """Typed fields of feature messages plus a nullable ``error`` struct.

    Four numbers are required; ``sample_id`` (integer) and ``timestamp`` (text) are optional.
    The first failing rule decides the error type.
    """
    opened = _opened(messages, payload, (*FEATURE_FIELDS, "sample_id", "timestamp"))
    typed = computed_once(
        opened,
        **{n: _lax_double(n) for n in FEATURE_FIELDS},
        timestamp=F.when(F.col("_type_timestamp") == "STRING", F.col("_text_timestamp")),
        sample_id=_lax_long("sample_id"),
    )
    rules = [F.when(F.col(n).isNull(), F.lit(n)) for n in FEATURE_FIELDS]
    rules += [
        F.when(F.col(n).isNull() & _given(n), F.lit(n)) for n in ("sample_id", "timestamp")
    ]
    failing = F.array_compact(F.array(*rules))
    no_object = ~F.col("_object")
    kind = F.when(no_object, BAD_JSON).when(F.size(failing) > 0, INVALID)
    message = F.when(no_object, F.lit("payload is not a JSON object")).otherwise(
        F.concat(F.lit("invalid or missing: "), F.array_join(failing, ", "))
    )
    return computed_once(typed, error=_error(kind, message)).select(
        *messages.columns, *FEATURE_FIELDS, "timestamp", "sample_id", "error"
    )


def read_inference_messages(messages: DataFrame, payload: str = "value") -> DataFrame:
    """Entity id and pass-through timestamp of scoring requests plus ``error``."""

    def printed(name: str) -> Column:
        # A decimal such as 7.0 keeps its point, as it is printed in the message.
        kind, text = F.col(f"_type_{name}"), F.col(f"_text_{name}")
        whole = kind.isin("DECIMAL", "DOUBLE") & ~text.contains(".") & ~text.contains("E")
        return F.when(_given(name), F.when(whole, F.concat(text, F.lit(".0"))).otherwise(text))

    # A number or boolean that is zero or false counts as "no entity id", as does "".
    given = printed("entity_id")
    zero = (F.col("_type_entity_id") != "STRING") & given.isin("0", "0.0", "false", "[]", "{}")
    resolved = computed_once(
        _opened(messages, payload, ("entity_id", "sample_id", "timestamp")),
        entity_id=resolved_entity_id(F.when(~zero, given), printed("sample_id")),
    )
    no_object = ~F.col("_object")
    kind = F.when(no_object, BAD_JSON).when(F.col("entity_id").isNull(), MISSING_ID)
    message = F.when(no_object, F.lit("payload is not a JSON object")).otherwise(
        F.lit("Message missing entity_id and sample_id")
    )
    return computed_once(resolved, error=_error(kind, message)).select(
        *messages.columns, "entity_id", F.col("_text_timestamp").alias("timestamp"), "error"
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull()).drop("error")


def refused(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNotNull())


def dead_letters(
    failed: DataFrame,
    pipeline: str,
    stage: str,
    as_of: Column,
    entity_id: Column | None = None,
    payload: Column | None = None,
    retry_count: Column | None = None,
    trace_id: Column | None = None,
) -> DataFrame:
    """Dead-letter rows of a frame that carries an ``error`` struct; traced if there is an id."""
    null = F.lit(None)
    rows = failed.select(
        (null if entity_id is None else entity_id).alias("entity_id"),
        F.lit(pipeline).alias("pipeline"),
        F.lit(stage).alias("stage"),
        F.col("error.error_type").alias("error_type"),
        truncated(F.col("error.error_message")).alias("error_message"),
        (null if payload is None else readable(payload)).alias("original_message"),
        as_of.alias("timestamp"),
        (null if retry_count is None else retry_count).alias("retry_count"),
        (null if trace_id is None else trace_id).alias("trace_id"),
    )
    return conform(rows, DEAD_LETTER_SCHEMA if trace_id is None else traced(DEAD_LETTER_SCHEMA))


def missing_features(names: list[str] | tuple[str, ...]) -> Column:
    """Sorted names of the listed columns that are null in a row."""
    return F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in sorted(names)]))
