"""Order analytics on Spark: cleaning, validation, business queries and period reports."""
