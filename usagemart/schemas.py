"""Every table of the data model as an explicit schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(name: str, limit: int | None = None, comment: str | None = None) -> T.StructField:
    metadata = {}
    if limit:
        metadata["max_length"] = limit
    if comment:
        metadata["comment"] = comment
    return T.StructField(name, T.StringType(), True, metadata)


def _field(name: str, dtype: T.DataType, comment: str | None = None) -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment} if comment else {})


# Customer master record as the CRM delivers it: dates are ISO text, money is a float.
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    _text("first_name"),
    _text("last_name"),
    _text("email"),
    _text("company"),
    _text("segment"),
    _text("registration_date"),
    _text("status"),
    T.StructField("lifetime_value", T.DoubleType()),
])

# One row per customer and day.
TELEMETRY_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("session_duration_minutes", T.LongType()),
    T.StructField("page_views", T.LongType()),
    T.StructField("clicks", T.LongType()),
    T.StructField("conversions", T.LongType()),
])

# The aggregated telemetry columns, in mart order.
METRIC_TYPES = {
    "total_session_minutes": T.LongType(),
    "avg_session_minutes": T.DoubleType(),
    "active_days": T.LongType(),
    "total_page_views": T.LongType(),
    "total_clicks": T.LongType(),
    "total_conversions": T.LongType(),
    "conversion_rate": T.DoubleType(),
    "engagement_score": T.DoubleType(),
}

# Customers joined with their metrics, before the typed load.
STAGED_SCHEMA = T.StructType(
    CUSTOMER_SCHEMA.fields
    + [T.StructField(name, dtype) for name, dtype in METRIC_TYPES.items()]
    + [_text("load_date"), _text("created_at")]
)


def _mart(key: T.DataType, counter: T.DataType, money: T.DataType, amount: T.DataType,
          rate: T.DataType) -> T.StructType:
    return T.StructType([
        _field("customer_id", key, "Primary key"),
        _text("first_name", 100),
        _text("last_name", 100),
        _text("email", 255, "Unique when present"),
        _text("company", 200),
        _text("segment", 50, "Code of the segment dimension"),
        _field("registration_date", T.DateType()),
        _text("status", 20),
        _field("lifetime_value", money),
        _field("total_session_minutes", amount),
        _field("avg_session_minutes", amount),
        _field("active_days", counter, "Telemetry rows with a session duration"),
        _field("total_page_views", counter),
        _field("total_clicks", counter),
        _field("total_conversions", counter),
        _field("conversion_rate", rate, "Conversions in percent of clicks"),
        _field("engagement_score", amount, "Weighted activity score"),
        _field("load_date", T.DateType()),
        _field("created_at", T.TimestampNTZType()),
        _field("updated_at", T.TimestampNTZType()),
    ])


# The mart as declared: the limits that dq_type_violations reports against.
DECLARED_MART_SCHEMA = _mart(T.IntegerType(), T.IntegerType(), T.DecimalType(12, 2),
                             T.DecimalType(10, 2), T.DecimalType(5, 2))

# The mart as stored. Same names and scales, but wide enough that one very active customer
# cannot fail the load of everybody else. 18 digits still fit a machine word.
MART_SCHEMA = _mart(T.LongType(), T.LongType(), T.DecimalType(18, 2), T.DecimalType(18, 2),
                    T.DecimalType(18, 2))

MART_COLUMNS = MART_SCHEMA.fieldNames()

SEGMENT_SCHEMA = T.StructType([
    _text("segment_code", 50),
    _text("segment_name", 100),
    _text("description"),
    _field("min_engagement_score", T.DecimalType(10, 2)),
    _field("max_engagement_score", T.DecimalType(10, 2)),
])

SEGMENT_PERFORMANCE_SCHEMA = T.StructType([
    _text("segment"),
    _field("customer_count", T.LongType()),
    _field("avg_lifetime_value", T.DoubleType()),
    _field("avg_engagement", T.DoubleType()),
    _field("total_conversions", T.LongType()),
    _field("avg_conversion_rate", T.DoubleType()),
    _field("last_update_date", T.DateType()),
])

AUDIT_SCHEMA = T.StructType([
    _text("audit_id"),
    _text("process_name", 100),
    _field("execution_date", T.DateType()),
    _field("start_time", T.TimestampNTZType()),
    _field("end_time", T.TimestampNTZType()),
    _field("records_processed", T.LongType()),
    _text("status", 20),
    _text("error_message"),
    _field("created_at", T.TimestampNTZType()),
])

# Who calls, as read from an already verified token, and whose data they ask for.
CLAIMS_SCHEMA = T.StructType([
    _text("email"),
    _text("preferred_username"),
    _text("aud"),
    _field("iat", T.LongType()),
    _field("exp", T.LongType()),
    _field("requested_customer_id", T.LongType()),
])
