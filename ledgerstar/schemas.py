"""Explicit schemas and column types for every table and layer."""

from __future__ import annotations

import pyspark.sql.types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


def schema(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[type_]) for name, type_ in columns.items()])


def text_schema(columns: list[str]) -> T.StructType:
    return schema(dict.fromkeys(columns, "string"))


# The flat transaction file. Its first, unnamed column is a row index.
# The file's times carry no zone, so they are read as zone-free timestamps.
RAW_SCHEMA = schema(
    {
        "row_index": "bigint",
        "trans_date_trans_time": "timestamp",
        "cc_num": "bigint",
        "merchant": "string",
        "category": "string",
        "amt": "double",
        "first": "string",
        "last": "string",
        "gender": "string",
        "street": "string",
        "city": "string",
        "state": "string",
        "zip": "int",
        "lat": "double",
        "long": "double",
        "city_pop": "int",
        "job": "string",
        "dob": "date",
        "trans_num": "string",
        "unix_time": "bigint",
        "merch_lat": "double",
        "merch_long": "double",
        "is_fraud": "int",
    }
)
RAW_COLUMNS = RAW_SCHEMA.names[1:]

# The columns that make one customer record; the card number is one of them.
CUSTOMER_ATTRIBUTES = [
    "first", "last", "gender", "street", "city", "state",
    "zip", "lat", "long", "city_pop", "job", "dob",
]
CUSTOMER_KEY = ["cc_num", *CUSTOMER_ATTRIBUTES]

# Landing and bronze dimensions, where every column is text.
CUSTOMER_COLUMNS = [*CUSTOMER_ATTRIBUTES, "cust_uuid"]
MERCHANT_COLUMNS = ["merchant", "merch_lat", "merch_long", "merch_uuid"]
CARD_COLUMNS = [
    "cc_num", "card_provider", "card_category", "expiration_date", "issue_date", "credit_limit",
]


LANDING_DIMENSIONS = {
    "dim_customer": text_schema(CUSTOMER_COLUMNS),
    "dim_merchant": text_schema(MERCHANT_COLUMNS),
    "dim_card": text_schema(CARD_COLUMNS),
}

LANDING_FACT = T.StructType(
    [*RAW_SCHEMA.fields[1:], *text_schema(["merch_uuid", "cust_uuid"]).fields]
)

# Text, so that '01' stays '01' when the partition folders are read back.
DAY_PARTITIONS = ["year", "month", "day"]
BRONZE_FACT = T.StructType([*LANDING_FACT.fields, *text_schema(DAY_PARTITIONS).fields])

# The casts of the silver layer.
SILVER_CASTS = {
    "dim_customer": {
        "zip": "int",
        "lat": "double",
        "long": "double",
        "city_pop": "int",
        "dob": "date",
    },
    "dim_merchant": {"merch_lat": "double", "merch_long": "double"},
    "dim_card": {"expiration_date": "date", "issue_date": "date", "credit_limit": "int"},
    "fact_transactions": {"cc_num": "string"},
}

# The only fact columns allowed past bronze. An allow-list, so that a new
# personal column in the source cannot leak.
FACT_COLUMNS = [
    "trans_num", "merch_uuid", "cust_uuid", "trans_date_trans_time", "cc_num",
    "category", "amt", "unix_time", "is_fraud",
]

# Column order of the staging views.
STAGING_COLUMNS = {
    "dim_customer": [
        "zip", "long", "job", "first", "cust_uuid", "state", "city",
        "dob", "gender", "last", "street", "city_pop", "lat",
    ],
    "dim_merchant": ["merch_long", "merch_uuid", "merch_lat", "merchant"],
    "dim_card": [
        "card_category", "card_provider", "cc_num", "credit_limit", "expiration_date", "issue_date",
    ],
    "fact_transactions": [
        "cust_uuid", "trans_date_trans_time", "is_fraud", "merch_uuid", "amt",
        "cc_num", "category", "trans_num", "unix_time",
    ],
}

# The 29 declared tests of the gold layer.
GOLD_TESTS = {
    "dim_card": {
        "not_null": [
            "cc_num", "card_provider", "expiration_date", "issue_date", "credit_limit",
            "is_top_card",
        ],
        "unique": ["cc_num"],
    },
    "dim_customer": {
        "not_null": ["cust_uuid", "first", "last", "dob", "age"],
        "unique": ["cust_uuid"],
    },
    "dim_merchant": {
        "not_null": ["merch_uuid", "merchant"],
        "unique": ["merch_uuid"],
    },
    "fact_transactions": {
        "not_null": [
            "trans_num", "merch_uuid", "cust_uuid", "amt", "is_fraud",
            "first", "last", "merchant", "card_provider", "credit_limit",
        ],
        "unique": ["trans_num"],
        "relationships": {
            "merch_uuid": ("dim_merchant", "merch_uuid"),
            "cust_uuid": ("dim_customer", "cust_uuid"),
        },
    },
}
