"""Table schemas, keys and contract values of the data model.

The values below are fixed: they are the contract of the source system and of
the change stream, and results only match when they match.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(20, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


HOTELS = _struct(
    hotel_id=T.LongType(), name=T.StringType(), city=T.StringType(), country=T.StringType(),
    stars=T.IntegerType(), created_at=T.TimestampType(), updated_at=T.TimestampType(),
)
CUSTOMERS = _struct(
    customer_id=T.LongType(), first_name=T.StringType(), last_name=T.StringType(),
    email=T.StringType(), loyalty_tier=T.StringType(),
    created_at=T.TimestampType(), updated_at=T.TimestampType(),
)
BOOKINGS = _struct(
    booking_id=T.LongType(), customer_id=T.LongType(), hotel_id=T.LongType(),
    check_in=T.DateType(), check_out=T.DateType(), status=T.StringType(),
    total_amount=MONEY, currency=T.StringType(),
    created_at=T.TimestampType(), updated_at=T.TimestampType(),
)
PAYMENTS = _struct(
    payment_id=T.LongType(), booking_id=T.LongType(), amount=MONEY, currency=T.StringType(),
    payment_method=T.StringType(), status=T.StringType(), paid_at=T.TimestampType(),
    created_at=T.TimestampType(), updated_at=T.TimestampType(),
)
LINEAGE = _struct(
    _ingested_at=T.TimestampType(), _source_file=T.StringType(), _interval_start=T.DateType(),
)
SOURCE_TABLES = {
    "hotels": HOTELS, "customers": CUSTOMERS, "bookings": BOOKINGS, "payments": PAYMENTS,
}
PRIMARY_KEY = {
    "hotels": "hotel_id", "customers": "customer_id",
    "bookings": "booking_id", "payments": "payment_id",
}

# Row images travel as JSON: dates as days since 1970, money as text,
# instants as ISO-8601 text.
BOOKING_IMAGE = _struct(
    booking_id=T.LongType(), customer_id=T.LongType(), hotel_id=T.LongType(),
    check_in=T.IntegerType(), check_out=T.IntegerType(), status=T.StringType(),
    total_amount=T.StringType(), currency=T.StringType(),
    created_at=T.StringType(), updated_at=T.StringType(),
)
CUSTOMER_IMAGE = _struct(
    customer_id=T.LongType(), first_name=T.StringType(), last_name=T.StringType(),
    email=T.StringType(), loyalty_tier=T.StringType(),
    created_at=T.StringType(), updated_at=T.StringType(),
)
CHANGE_SOURCE = _struct(
    ts_ms=T.LongType(), snapshot=T.StringType(), schema=T.StringType(), table=T.StringType(),
    txId=T.LongType(), lsn=T.LongType(), sequence=T.StringType(),
)
# before / after stay text: the raw layer keeps the images as they were emitted.
CHANGE_ENVELOPE = _struct(
    before=T.StringType(), after=T.StringType(), source=CHANGE_SOURCE,
    op=T.StringType(), ts_ms=T.LongType(),
)
CHANGE_LOG = _struct(
    op=T.StringType(), lsn=T.LongType(), tx_id=T.LongType(),
    source_ts=T.TimestampType(), captured_at=T.TimestampType(), snapshot=T.StringType(),
    _key=T.StringType(), before=T.StringType(), after=T.StringType(),
    _kafka_topic=T.StringType(), _kafka_partition=T.IntegerType(), _kafka_offset=T.LongType(),
    _ingested_at=T.TimestampType(),
)
# The columns a Kafka source delivers (key and value decoded to text).
MESSAGE = _struct(
    topic=T.StringType(), partition=T.IntegerType(), offset=T.LongType(),
    key=T.StringType(), value=T.StringType(),
)
PIPELINE_EVENT = _struct(
    horodatage=T.StringType(), evenement=T.StringType(), dag_id=T.StringType(),
    task_id=T.StringType(), run_id=T.StringType(), logical_date=T.StringType(),
    tentative=T.LongType(), retries=T.LongType(), relances_max=T.LongType(),
    duree_tentative_s=T.DoubleType(), exception_type=T.StringType(),
    exception_message=T.StringType(), scenario_runbook=T.StringType(),
)

# Fixed values of the source contract.
TIERS = ["standard", "silver", "gold"]
BOOKING_STATUSES = ["pending", "confirmed", "cancelled", "completed"]
REVENUE_STATUSES = ["confirmed", "completed"]
CANCELLATION_BASE = ["confirmed", "completed", "cancelled"]
PAYMENT_METHODS = ["card", "transfer", "paypal", "cash"]
PAYMENT_STATUSES = ["pending", "captured", "refunded", "failed"]
STARS = [1, 2, 3, 4, 5]
CURRENCIES = ["EUR"]
CHANGE_OPS = ["r", "c", "u", "d"]

# Fixed defaults of the platform.
CALENDAR_START, CALENDAR_END = "2026-01-01", "2027-12-31"
RETENTION_DAYS = 60
