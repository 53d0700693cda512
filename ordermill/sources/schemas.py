"""The four relations, with fixed types instead of inference."""

from __future__ import annotations

from pyspark.sql import types as T

# As many digits as revenue is computed with; a reader refuses more instead of rounding.
PRICE = T.DecimalType(16, 6)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("registration_date", T.TimestampNTZType()),
        T.StructField("customer_type", T.StringType()),
    ]
)
PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("cost_price", PRICE),
    ]
)
# order_date stays text until the cleaning stage has settled its format.
ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("region_code", T.StringType()),
    ]
)
# discount_percent stays double so that 150 or -5 survive to be flagged.
ORDER_ITEMS = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", PRICE),
        T.StructField("discount_percent", T.DoubleType()),
    ]
)

SCHEMAS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
}

# After cleaning, order dates are timestamps.
CLEAN_SCHEMAS = SCHEMAS | {
    "orders": T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType() if f.name == "order_date" else f.dataType)
            for f in ORDERS
        ]
    )
}

# The texts that CSV readers of the pandas family take as missing.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
