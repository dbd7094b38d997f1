"""Buyers that take bulk quantities at a loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import money
from tributary.operators.joins import semi
from tributary.operators.sets import either

KEYS = ["customer_id", "material_id", "chain"]


def bulk_pairs(detail: DataFrame, food_units: int = 12, electro_units: int = 3) -> DataFrame:
    """Customer and material pairs over their threshold with a negative margin.

    detail(customer_id, material_id, chain, order_id, units, net, margin, area):
    area is ``FOOD``, ``ELECTRO`` or other. The two disjoint rules are one
    filter over one aggregate.
    """
    pairs = detail.groupBy(*KEYS, "area").agg(
        F.sum("units").alias("units"), F.sum("net").alias("net"), F.sum("margin").alias("margin")
    )
    loss = money.ratio(F.col("margin"), F.col("net")) < 0
    return either(
        pairs,
        [
            (F.col("area") == "FOOD") & (F.col("units") >= food_units) & loss,
            (F.col("area") == "ELECTRO") & (F.col("units") >= electro_units) & loss,
        ],
    )


def bulk_buyers(detail: DataFrame, food_units: int = 12, electro_units: int = 3) -> DataFrame:
    """Distinct detail rows of those pairs."""
    return semi(detail, bulk_pairs(detail, food_units, electro_units), KEYS).distinct()
