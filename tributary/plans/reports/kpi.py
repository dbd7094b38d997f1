"""Customer KPIs by week and month, for groups and in total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import money
from tributary.plans.reports.sales import net_amount

SUMS = ("gross", "taxed", "units", "margin")


def prime_group(by_promotion: Column, by_order: Column) -> Column:
    """An order is prime by promotion first, by its own flag otherwise."""
    return F.when(F.coalesce(by_promotion, by_order, F.lit(False)), F.lit("PRIME")).otherwise(F.lit("NO PRIME"))


def order_kpi_input(lines: DataFrame, orders: DataFrame, default_margin: int) -> DataFrame:
    """One row per order: amounts summed, margin filled, prime group decided.

    lines(order_id, gross, taxed, units, margin, promo_prime),
    orders(order_id, customer_id, created, prime).
    """
    rolled = lines.groupBy("order_id").agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.max(F.when(F.col("promo_prime"), F.lit(True))).alias("promo_prime"),
    )
    return rolled.join(orders, "order_id").select(
        "order_id", "customer_id", "created", "gross", "taxed", "units",
        F.coalesce(F.col("margin"), F.lit(default_margin)).alias("margin"),
        prime_group(F.col("promo_prime"), F.col("prime")).alias("segment"),
    )


def _finish(totals: DataFrame, keys: list[str], factor: float) -> DataFrame:
    net = net_amount(F.col("gross"), F.col("taxed"), factor)
    return totals.select(
        *keys,
        "customers",
        "orders",
        money.major(F.col("gross")).alias("gross"),
        F.col("units").cast("bigint").alias("units"),
        (net / 100.0).alias("net"),
        money.major(F.col("margin")).alias("margin"),
        (money.ratio(F.col("gross"), F.col("customers")) / 100.0).alias("spend_per_customer"),
        money.ratio(F.col("orders"), F.col("customers")).alias("frequency"),
        (money.ratio(F.col("gross"), F.col("orders")) / 100.0).alias("ticket"),
        money.ratio(F.col("units"), F.col("orders")).alias("units_per_ticket"),
        (money.ratio(F.col("gross"), F.col("units")) / 100.0).alias("unit_price"),
        money.ratio(F.col("margin"), net).alias("margin_share"),
    )


def _per_customer(orders: DataFrame, keys: list[str]) -> DataFrame:
    return orders.groupBy(*keys, "customer_id").agg(
        F.count(F.lit(1)).alias("orders"), *[F.sum(c).alias(c) for c in SUMS]
    )


def _per_group(customers: DataFrame, keys: list[str]) -> DataFrame:
    return customers.groupBy(*keys).agg(
        F.count("customer_id").alias("customers"),
        F.sum("orders").alias("orders"),
        *[money.exact_sum(F.col(c)).alias(c) for c in SUMS],
    )


def customer_kpis(orders: DataFrame, period: Column, factor: float = money.TAX_FACTOR) -> DataFrame:
    """KPIs per period and group. Orders go to one row per customer first, then to the group."""
    keys = ["period", "segment"]
    return _finish(_per_group(_per_customer(orders.withColumn("period", period), keys), keys), keys, factor)


def customer_kpis_with_total(orders: DataFrame, period: Column, factor: float = money.TAX_FACTOR) -> DataFrame:
    """KPIs per period and group, and per period under ``TOTAL``.

    The large input is summed per customer once; only those sums are doubled.
    """
    keys = ["period", "segment"]
    base = _per_customer(orders.withColumn("period", period), keys)
    both = base.withColumn("segment", F.explode(F.array(F.col("segment"), F.lit("TOTAL"))))
    merged = both.groupBy(*keys, "customer_id").agg(
        F.sum("orders").alias("orders"), *[F.sum(c).alias(c) for c in SUMS]
    )
    return _finish(_per_group(merged, keys), keys, factor)
