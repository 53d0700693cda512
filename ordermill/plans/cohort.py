"""Registration cohorts and their retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import month_start, month_text, thirty_day_month
from ordermill.functions.money import percent_of
from ordermill.operators.joins import Tables


# Months per bigint of a mask; the sign stays out of it.
BITS = 63


def _active_users(tables: Tables, max_month: int) -> DataFrame:
    """Per cohort, the active customers of each 30-day month since its first day, as columns ``m0``, ``m1`` ...

    A customer's orders are reduced to the set of their days before they are shuffled, which the
    calendar bounds however many orders there are. Beside the customer's cohort the days become a mask
    with a bit per month, rows that repeat a customer are united by ``bit_or``, and a cohort's counts are
    sums of bits: no row per customer and day, and nothing distinct is counted.
    """
    days = (
        tables["orders"]
        .filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .groupBy("customer_id")
        .agg(F.collect_set(F.to_date("order_date")).alias("days"))
    )
    cohorts = tables["customers"].select("customer_id", month_start(F.col("registration_date")).alias("cohort"))

    def mask(first: int) -> Column:
        """The months from ``first`` that one bigint holds."""
        last = min(first + BITS - 1, max_month)

        def add(found: Column, day: Column) -> Column:
            month = thirty_day_month(F.col("cohort"), day)
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (month - first).cast("int"))
            return F.when(month.between(first, last), found.bitwiseOR(bit)).otherwise(found)

        return F.aggregate("days", F.lit(0).cast("bigint"), add)

    words = range(0, max_month + 1, BITS)
    masks = cohorts.join(days, "customer_id").select("customer_id", "cohort", *(mask(w).alias(f"w{w}") for w in words))
    united = masks.groupBy("customer_id", "cohort").agg(*(F.bit_or(f"w{w}").alias(f"w{w}") for w in words))
    months = range(max_month + 1)
    bits = {m: F.shiftright(f"w{m // BITS * BITS}", m % BITS).bitwiseAND(F.lit(1)) for m in months}
    return (
        united.groupBy("cohort")
        .agg(*(F.sum(bits[m]).alias(f"m{m}") for m in months))
        .withColumn("cohort_month", month_text(F.col("cohort")))
        .filter(F.greatest(*(F.col(f"m{m}") for m in months), F.lit(0)) > 0)
    )


def cohort_activity(tables: Tables, max_month: int = 3, k: int = 12) -> DataFrame:
    """One row per cohort with a column per month; the ``k`` latest cohorts."""
    months = [F.col(f"m{m}").alias(f"month_{m}_active") for m in range(max_month + 1)]
    wide = _active_users(tables, max_month).select("cohort_month", *months)
    if max_month >= 1:
        retained = percent_of(F.col("month_1_active"), F.col("month_0_active"))
        wide = wide.withColumn("retention_rate_month_1", retained)
    return wide.orderBy(F.desc("cohort_month")).limit(k)


def retention_rate(tables: Tables, max_month: int = 3) -> DataFrame:
    """The same activity in long form, each month as a percentage of month 0."""
    rows = [
        F.struct(F.lit(m).cast("bigint").alias("month_number"), F.col(f"m{m}").alias("active_users"))
        for m in range(max_month + 1)
    ]
    # Without anyone in month 0 there is nothing to compare with.
    month_0 = F.when(F.col("m0") > 0, F.col("m0"))
    return (
        _active_users(tables, max_month)
        .select("cohort_month", month_0.alias("month_0"), F.inline(F.array(*rows)))
        .filter("active_users > 0")
        .select(
            "cohort_month",
            "month_number",
            "active_users",
            percent_of(F.col("active_users"), F.col("month_0")).alias("retention_rate"),
        )
        .orderBy("cohort_month", "month_number")
    )
