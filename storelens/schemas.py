"""Canonical schemas of the feeds.

Fixed values: column names, their order and kind. Integer widths are the widest the sources use.
"""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


POS = _schema(
    transaction_id=StringType(),
    store_id=LongType(),
    product_id=LongType(),
    quantity=LongType(),
    revenue=DoubleType(),
    discount_applied=DoubleType(),
    timestamp=DoubleType(),
)

INVENTORY = _schema(
    inventory_id=LongType(),
    product_id=LongType(),
    warehouse_id=IntegerType(),
    stock_level=LongType(),
    restock_threshold=DoubleType(),
    last_updated=DoubleType(),
)

WEB_LOGS = _schema(
    session_id=StringType(),
    user_id=LongType(),
    page=StringType(),
    timestamp=DoubleType(),
)

# Ratings arrive as free text; see functions.numbers.number.
CRM_LOGS = _schema(
    id=LongType(),
    customer_id=LongType(),
    interaction_type=StringType(),
    rating=StringType(),
    timestamp=DoubleType(),
)

# One stream may carry web and CRM records, so a decoded record has the fields of both. Ids may be
# numbers or texts.
RECORD = _schema(
    id=StringType(),
    session_id=StringType(),
    customer_id=StringType(),
    interaction_type=StringType(),
    rating=StringType(),
    timestamp=DoubleType(),
)

# Object-created notification as found in a queue message body.
NOTIFICATION = _schema(
    Event=StringType(),
    Records=ArrayType(
        _schema(s3=_schema(bucket=_schema(name=StringType()), object=_schema(
            key=StringType(), versionId=StringType(), eTag=StringType(), sequencer=StringType())))
    ),
)

# Interaction types with a meaning of their own.
FEEDBACK, COMPLAINT, LOYALTY, RESOLUTION = "Feedback", "Complaint", "Loyalty", "Resolution"

# Fields a customer interaction must carry.
CRM_REQUIRED = ["customer_id", "interaction_type", "timestamp"]
