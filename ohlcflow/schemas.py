"""Declared schemas, column lists and fixed values.

Nothing is inferred: raw payloads, ticks and quotes are read with these types.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DecimalType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# --- Fixed values: these must equal the reference's for right results. ---
# Bar columns in the order the bar table keeps them.
BAR_COLUMNS = ["time", "high", "low", "open", "close", "volumefrom", "volumeto"]
# Columns cast to double after the explode.
PRICE_COLUMNS = ["high", "low", "open", "close", "volumefrom", "volumeto"]
# Served document: bar columns plus the symbol.
SERVED_COLUMNS = ["time", "high", "low", "open", "close", "volumefrom", "volumeto", "symbol"]
# Bar time text format.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Provider answer that marks a rate-limited request.
RATE_LIMIT_MESSAGE = "You are over your rate limit please upgrade your account!"
# Envelope status values.
RESPONSE_SUCCESS = "Success"
RESPONSE_ERROR = "Error"
# Quote currency and the oldest date the provider has.
DEFAULT_TSYM = "USD"
OLDEST_DATE = "2010-07-17"
# Bars per request, look-back horizons of the tiers.
API_CHUNK_SIZE = 2000
YEARS_BEFORE = 7
DAYS_BEFORE = 7
# Tier name, endpoint, bars per day.
TIERS = [
    ("daily", "histoday", 1),
    ("hourly", "histohour", 24),
    ("minutely", "histominute", 1440),
]
# Symbols per quote request.
QUOTE_CHUNK_SIZE = 10
# Seoul, the zone run dates are rendered in.
KST_ZONE = "Asia/Seoul"
# --- end of fixed values ---

# Columns that identify a series.
PARTITION_COLUMNS = ["symbol", "batch_unit"]

# Partition columns of the bar table: an increment rewrites a year of a symbol and tier.
TABLE_PARTITIONS = ["symbol", "batch_unit", "year"]
# What identifies a landed raw document.
RAW_KEYS = ["symbol", "batch_unit", "request"]

# Prices and times may come as numbers or as text: they are read as text and cast later.
BAR_STRUCT = StructType([StructField(c, StringType()) for c in BAR_COLUMNS])

# one raw JSON document per request.
PAYLOAD_SCHEMA = StructType(
    [
        StructField("Response", StringType()),
        StructField("Message", StringType()),
        StructField(
            "Data",
            StructType([StructField("Data", ArrayType(BAR_STRUCT))]),
        ),
    ]
)

# a bar row as stored (time as text).
BAR_ROW_SCHEMA = StructType(
    [StructField("time", StringType())]
    + [StructField(c, DoubleType()) for c in PRICE_COLUMNS]
    + [StructField("symbol", StringType()), StructField("batch_unit", StringType())]
)

# Landed raw documents: many requests of a series in a file, a folder per delivery.
RAW_SCHEMA = StructType([StructField(c, StringType()) for c in ("request", "payload", "delivery", *PARTITION_COLUMNS)])
# Rejected documents, by what is wrong with them, with the time they landed.
QUARANTINE_SCHEMA = StructType(
    [StructField(c, StringType()) for c in ("request", "payload", *PARTITION_COLUMNS)]
    + [StructField("ingest_seq", LongType()), StructField("status", StringType())]
)

# What the bar table stores.
BAR_TABLE_SCHEMA = StructType(
    BAR_ROW_SCHEMA.fields + [StructField("ingest_seq", LongType()), StructField("year", StringType())]
)

# A bar made of a part of its ticks: who made it, its version, the place of its open and
# close among all ticks, and its values. A table that merges such bars keeps them per bar.
ORDER_KEYS = ["open_key", "close_key"]
PART_STRUCT = StructType(
    [StructField("part", StringType()), StructField("seq", LongType())]
    + [StructField(c, DecimalType(38, 0)) for c in ORDER_KEYS]
    + [StructField(c, DoubleType()) for c in PRICE_COLUMNS]
)

# multi-symbol quote payload {symbol: {currency: price}}, read level by level so that
# one bad value spoils neither its document nor its neighbours.
QUOTE_SCHEMA = MapType(StringType(), StringType())

# tick record carried in the stream value.
TICK_SCHEMA = StructType(
    [StructField("symbol", StringType()), StructField("close", DoubleType())]
)

# F8: market-cap info record.
COIN_INFO_SCHEMA = StructType(
    [
        StructField("CoinInfo", StructType([StructField("Name", StringType())])),
        StructField("mktcap", DoubleType()),
    ]
)
