"""Feature contracts: which columns play which role, and the schemas of every sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_D, _S, _L, _TS = T.DoubleType(), T.StringType(), T.LongType(), T.TimestampType()
_I, _B = T.IntegerType(), T.BooleanType()

#: Roles a column of a contract can have.
FEATURE, LABEL, SOURCE, ENTITY, TIME = "feature", "label", "source", "entity", "time"
#: Roles whose values are always there.
_REQUIRED = (SOURCE, ENTITY, TIME)


def _field(name: str, kind: T.DataType, role: str, **spellings: str) -> T.StructField:
    """A column with its role and its names in other tables and messages."""
    return T.StructField(
        name, kind, role not in _REQUIRED, {"role": role, "spellings": spellings}
    )


class FeatureContract:
    """A modelling project's table: a schema whose fields carry roles and other spellings.

    ``served`` tells whether the online store holds the project's rows.
    """

    def __init__(self, name: str, *fields: T.StructField, served: bool = True):
        self.name, self.served = name, served
        self.schema = T.StructType(list(fields))

    def having(self, role: str) -> list[str]:
        return [f.name for f in self.schema if f.metadata["role"] == role]

    def _only(self, role: str) -> str | None:
        return next(iter(self.having(role)), None)

    @property
    def features(self) -> list[str]:
        return self.having(FEATURE)

    @property
    def entity(self) -> str:
        return self._only(ENTITY)

    @property
    def time(self) -> str:
        return self._only(TIME)

    @property
    def label(self) -> str | None:
        return self._only(LABEL)

    @property
    def sink(self) -> T.StructType:
        """The schema as stored: names, types and required columns."""
        return T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in self.schema])

    def renames(self, spelling: str) -> dict[str, str]:
        """Name in one spelling -> canonical name."""
        found = {
            f.metadata["spellings"][spelling]: f.name
            for f in self.schema
            if spelling in f.metadata["spellings"]
        }
        if not found:
            raise KeyError(f"contract {self.name!r} has no spelling {spelling!r}")
        return found

    def to_source(self, spelling: str) -> dict[str, str]:
        """Canonical name -> name in one spelling."""
        return {canonical: other for other, canonical in self.renames(spelling).items()}


_ROW_KEYS = (
    _field("source", _S, SOURCE),
    _field("entity_id", _S, ENTITY),
    _field("feature_timestamp", _TS, TIME),
)


def _required(field: T.StructField) -> T.StructField:
    return T.StructField(field.name, field.dataType, False, field.metadata)


# Canonical, camel-case and snake-case spellings of the measurements.
IRIS = FeatureContract(
    "iris",
    *map(
        _required,
        (
            _field("sepal_length_cm", _D, FEATURE, camel="SepalLengthCm", snake="sepal_length"),
            _field("sepal_width_cm", _D, FEATURE, camel="SepalWidthCm", snake="sepal_width"),
            _field("petal_length_cm", _D, FEATURE, camel="PetalLengthCm", snake="petal_length"),
            _field("petal_width_cm", _D, FEATURE, camel="PetalWidthCm", snake="petal_width"),
        ),
    ),
    _field("species", _S, LABEL, camel="Species"),
    *_ROW_KEYS,
)

# The model's inputs from a transfer and its sender's trailing windows.
SCALARS = (
    "tx_count_1h",
    "tx_count_24h",
    "tx_count_7d",
    "tx_count_30d",
    "avg_amount_7d",
    "max_amount_7d",
    "total_amount_24h",
    "cross_border_ratio_7d",
    "unique_recipients_7d",
    "unique_currencies_7d",
)
USER_ATTRIBUTES = ("account_age_days", "is_business", "is_kyc_verified", "country_risk_score")
TRANSFER_FEATURES = (
    "source_amount",
    "is_cross_border",
    "hour_of_day",
    "day_of_week",
    *SCALARS,
    *USER_ATTRIBUTES,
    "amount_ratio_to_avg",
)

# One row per transfer, offline only.
TRANSFERS = FeatureContract(
    "fraud",
    *(_field(name, _D, FEATURE) for name in TRANSFER_FEATURES),
    _field("label", _I, LABEL),
    *_ROW_KEYS,
    served=False,
)

# Arrays of the two rings of buckets, position = slot.
_LISTS = T.ArrayType(T.ArrayType(_S))
_RINGS = {
    "hourly_bucket_hour": T.ArrayType(_L),
    "hourly_tx_count": T.ArrayType(_L),
    "hourly_amount_sum": T.ArrayType(_D),
    "hourly_amount_max": T.ArrayType(_D),
    "hourly_cross_border_count": T.ArrayType(_L),
    "hourly_recipients": _LISTS,
    "daily_bucket_day": T.ArrayType(_L),
    "daily_tx_count": T.ArrayType(_L),
    "daily_amount_sum": T.ArrayType(_D),
    "daily_amount_max": T.ArrayType(_D),
    "daily_cross_border_count": T.ArrayType(_L),
    "daily_recipients": _LISTS,
    "daily_currencies": _LISTS,
}

# One row per user with ring buffers, and one with population averages: the one served online.
TRANSFER_USERS = FeatureContract(
    "fraud_user",
    *(_field(name, _D, FEATURE) for name in USER_ATTRIBUTES),
    *(_field(name, kind, FEATURE) for name, kind in _RINGS.items()),
    *(_field(f"global_{name}", _D, FEATURE) for name in SCALARS),
    _field("source", _S, SOURCE),
    _field("user_id", _S, ENTITY),
    _field("feature_timestamp", _TS, TIME),
)

REGISTRY = {c.name: c for c in (IRIS, TRANSFERS, TRANSFER_USERS)}


def contract(name: str) -> FeatureContract:
    if name not in REGISTRY:
        raise KeyError(f"unknown contract {name!r}; available: {sorted(REGISTRY)}")
    return REGISTRY[name]


def _schema(spec: Sequence[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in spec])


RAW_SCHEMA = _schema(
    [
        ("Id", _L, True),
        ("SepalLengthCm", _D, True),
        ("SepalWidthCm", _D, True),
        ("PetalLengthCm", _D, True),
        ("PetalWidthCm", _D, True),
        ("Species", _S, True),
        ("source", _S, True),
        ("load_timestamp", _TS, True),
    ]
)

FEATURE_SCHEMA = IRIS.sink

# Sink schemas (name, type, nullable).
PREDICTION_SCHEMA = _schema(
    [
        ("entity_id", _S, False),
        ("features", _S, True),
        ("timestamp", _TS, False),
        ("prediction", _S, False),
        ("class_probabilities", T.ArrayType(_D), True),
        ("prediction_timestamp", _TS, False),
        ("model_service", _S, False),
        ("processing_time", _D, True),
        ("dataflow_processing_time", _TS, False),
    ]
)

DEAD_LETTER_SCHEMA = _schema(
    [
        ("entity_id", _S, True),
        ("pipeline", _S, False),
        ("stage", _S, False),
        ("error_type", _S, False),
        ("error_message", _S, False),
        ("original_message", _S, True),
        ("timestamp", _TS, False),
        ("retry_count", _L, True),
    ]
)


def traced(schema: T.StructType) -> T.StructType:
    """A sink's schema with the id of the message that each row comes from."""
    return T.StructType([*schema.fields, T.StructField("trace_id", _S, True)])


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Ordered projection that skips names the frame does not have."""
    return df.select(*[n for n in names if n in df.columns])


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Project and cast to a sink schema, dropping extra columns.

    Nullable columns that are absent are filled with null; absent required columns are an
    error at planning time.  ``strict`` makes a null in a required column fail the job.
    """
    absent = [f.name for f in schema.fields if f.name not in df.columns and not f.nullable]
    if absent:
        raise ValueError(f"required columns absent: {absent}")
    present = set(df.columns)
    shaped = df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
    if not strict:
        return shaped

    def checked(f: T.StructField) -> Column:
        if f.nullable:
            return F.col(f.name)
        message = F.lit(f"required column {f.name} is null")
        refused = F.raise_error(message).cast(f.dataType)
        return F.coalesce(F.col(f.name), refused).alias(f.name)

    return shaped.select(*[checked(f) for f in schema.fields])
