"""Promotion lines: share of the discount and of the margin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import money
from tributary.operators.skew import with_group_stats


def _cents(c):
    """Rounded to two decimals, half up."""
    return money.minor(c).cast("double") / 100.0


def discount_share(lines: DataFrame, keys: list[str] | None = None, stored: bool = False) -> DataFrame:
    """Share of each promotion line in its item's discount, and its margin.

    lines(order_id, material_id, promotion, quantity, discount, net, margin):
    discount, net and margin in hundredths. The share is 1 when the item has no
    discount. When the item sold more than the line and the margin exceeds the
    line's net amount, the margin is scaled to the line's quantity. ``stored``
    says that the lines only read stored columns, which then need no staging.
    """
    keys = keys or ["order_id", "material_id"]
    stats = with_group_stats(
        lines,
        keys,
        stored=stored,
        discount_total=F.sum("discount"),
        margin_total=F.sum("margin"),
        quantity_total=F.sum("quantity"),
    )
    share = _cents(F.coalesce(money.ratio(F.abs(F.col("discount")), F.abs(F.col("discount_total"))), F.lit(1.0)))
    with_share = stats.withColumn("share", share)
    margin = _cents(F.col("margin_total").cast("double") / 100.0 * F.col("share"))
    scaled = F.col("promo_margin") / F.col("quantity_total") * F.col("quantity")
    too_much = (F.col("quantity_total") > F.col("quantity")) & (F.col("promo_margin") > F.col("net") / 100.0)
    return (
        with_share.withColumn("promo_margin", margin)
        .withColumn("promo_margin", F.when(too_much, scaled).otherwise(F.col("promo_margin")))
        .drop("discount_total")
    )


def _rounded(c):
    return F.floor(c + 0.5)


def _shares(total, upto, weight, whole):
    """The part of ``total`` between two points of a running weight, in whole numbers: parts add up to the total."""
    at = lambda w: _rounded(total.cast("double") * w.cast("double") / whole.cast("double"))
    return at(upto) - at(upto - weight)


def allocate(items: DataFrame, lines: DataFrame, keys: list[str] | None = None, tie: list[str] | None = None) -> DataFrame:
    """Spread each sold item's margin over its promotions, so that nothing is counted twice and nothing lost.

    items(keys, quantity, net, margin): one row per sold item. lines(keys, promotion, quantity, discount, net):
    any number per item; their item facts are not repeated in them. Amounts are hundredths. A line's share is its part
    of the item's discount, or an equal part where the item has none; shares of an item add up to 1. A line that
    covers part of the item's units and whose margin exceeds its net amount is scaled to its units. What the lines do not
    take is the margin of units sold without promotion: ``rest_margin``, on the item's first line alone, so that over
    any lines ``promo_margin`` and ``rest_margin`` add up to the items' margins.
    """
    keys = keys or ["order_id", "material_id"]
    item = Window.partitionBy(*keys)
    inside = item.orderBy("promotion", *(tie or []), "discount", "quantity", "net")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.abs(F.coalesce("discount", F.lit(0)))
    weighed = lines.withColumn("_all", F.sum(size).over(item)).withColumn("_weight", F.when(F.col("_all") > 0, size).otherwise(F.lit(1).cast("bigint")))
    weighed = weighed.withColumns({"_upto": F.sum("_weight").over(running), "_whole": F.sum("_weight").over(item), "_n": F.row_number().over(inside)})
    facts = items.select(*keys, F.col("quantity").alias("item_quantity"), F.col("margin").alias("item_margin"))
    joined = weighed.join(facts, keys)
    place = (F.col("_upto"), F.col("_weight"), F.col("_whole"))
    spread = joined.withColumns({"share": _shares(F.lit(100), *place) / 100.0, "_margin": _shares(F.col("item_margin"), *place)})
    capped = (F.col("item_quantity") > F.col("quantity")) & (F.col("_margin") > F.col("net"))
    scaled = _rounded(F.col("_margin").cast("double") * F.col("quantity") / F.col("item_quantity"))
    taken = spread.withColumn("promo_margin", F.when(capped, scaled).otherwise(F.col("_margin")))
    rest = F.when(F.col("_n") == 1, F.col("item_margin") - F.sum("promo_margin").over(item)).otherwise(F.lit(0))
    return taken.withColumn("rest_margin", rest).drop("_all", "_weight", "_upto", "_whole", "_n", "_margin")


def split_delivery(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Delivery promotions, and the rest (a missing name belongs to the rest)."""
    delivery = F.coalesce(F.lower("promotion").like("%deliver%"), F.lit(False))
    return lines.filter(delivery), lines.filter(~delivery)


def promotion_summary(shared: DataFrame, by: list[str]) -> DataFrame:
    return shared.groupBy(*by).agg(
        F.sum("quantity").alias("quantity"),
        F.sum("net").alias("net"),
        F.sum("discount").alias("discount"),
        F.sum(money.minor(F.col("promo_margin"), 4)).alias("promo_margin"),
    )
