"""Picking detail and stock-outs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import labels, money


def _grams(unit: Column, by_weight: Column, by_piece: Column) -> Column:
    return F.when(unit == "kg", by_weight).when(unit == "un", by_piece)


def _whole(c: Column) -> Column:
    return F.floor(c + 0.5)


def pick_detail(items: DataFrame, weights: DataFrame, skus: DataFrame, orders: DataFrame) -> DataFrame:
    """Requested and picked units and grams per ordered item, with its replacement.

    items(id, order_id, sku, unit, quantity, quantity_picked, price, substitute_of),
    weights(item_id, weight), skus(sku, kg_factor, unit_factor),
    orders(order_id, status). Weights are summed per item before the join. An
    item has at most one replacement with a sku.
    """
    weighed = weights.groupBy("item_id").agg(F.sum(F.coalesce("weight", F.lit(0))).alias("weight"))
    rich = (
        items.join(weighed, items["id"] == weighed["item_id"], "left")
        .drop("item_id")
        .join(skus, "sku", "left")
    )
    main = rich.filter(F.col("substitute_of").isNull())
    repl = rich.filter(F.col("substitute_of").isNotNull() & F.col("sku").isNotNull()).select(
        "substitute_of", *[F.col(c).alias(f"r_{c}") for c in ("id", "sku", "unit", "quantity_picked", "weight", "unit_factor")]
    )
    joined = main.drop("substitute_of").join(repl, F.col("id") == F.col("substitute_of"), "left")
    zero = F.lit(0)
    requested = _grams(
        F.col("unit"),
        F.coalesce(_whole(F.col("quantity") * 1000 * F.col("kg_factor")), zero),
        F.coalesce(_whole(F.col("quantity") * 1000 * F.col("unit_factor")), zero),
    )
    picked = _grams(
        F.col("unit"),
        F.coalesce(_whole(F.col("weight")), zero),
        F.coalesce(_whole(F.col("quantity_picked") * 1000 * F.col("unit_factor")), zero),
    )
    replaced = _grams(
        F.col("r_unit"), _whole(F.col("r_weight")), _whole(F.col("r_quantity_picked") * 1000 * F.col("r_unit_factor"))
    )
    out = joined.withColumns(
        {
            "requested_units": F.coalesce(F.col("quantity"), zero),
            "picked_units": F.coalesce(F.col("quantity_picked"), zero),
            "requested_grams": requested,
            "picked_grams": picked,
            "replaced_grams": replaced,
            "amount_requested": F.col("price") * F.coalesce(F.col("quantity"), zero),
        }
    ).withColumns(
        {
            "difference_units": F.col("requested_units") - F.col("picked_units"),
            "difference_grams": F.col("requested_grams") - F.col("picked_grams"),
        }
    )
    wanted = orders.filter(~F.col("status").isin(list(labels.NOT_PICKED_CODES)))
    return out.join(wanted, "order_id").select(
        "order_id", "id", "sku", "unit", "requested_units", "picked_units", "difference_units",
        "requested_grams", "picked_grams", "difference_grams", "amount_requested",
        F.col("r_sku").alias("replacement_sku"), "replaced_grams",
    )


def stockouts(items: DataFrame, materials: DataFrame, tolerance: float = 0.9) -> DataFrame:
    """Missing units and amounts of picked orders.

    items(order_id, material_id, store, price, substitute, unit, requested,
    picked): requested and picked are already in the item's unit (kilograms or
    pieces); price in hundredths. A weighed item counts as complete above the
    tolerance. materials(material_id, tax_type).
    """
    direct = F.when(F.col("substitute") == "NO", F.col("picked"))
    per_item = items.groupBy("order_id", "store", "material_id", "price", "substitute", "unit").agg(
        F.sum("requested").alias("requested"), F.sum(direct).alias("direct")
    )
    capped = F.coalesce(F.least(F.col("direct"), F.col("requested")), F.lit(0.0))
    capped = F.when(F.col("direct").isNull(), F.lit(0.0)).otherwise(capped)
    enough = money.ratio(capped, F.col("requested")) > tolerance
    final = F.when(
        F.col("unit") == "KG", F.when(enough, F.col("requested")).otherwise(F.lit(0.0))
    ).otherwise(capped)
    short = per_item.filter(F.col("substitute") == "NO").withColumn("picked", final).withColumn(
        "missing", F.col("requested") - F.col("picked")
    )
    priced = short.filter(F.col("missing") > 0).join(materials.select("material_id", "tax_type"), "material_id")
    gross = F.col("missing") * F.col("price") / 100.0
    return priced.select(
        "order_id", "store", "material_id", "unit", "requested", "picked", "missing",
        gross.alias("gross"),
        money.net_of_tax(gross, F.col("tax_type")).alias("net"),
        labels.classify(
            [
                (F.col("store").startswith("H"), "Hiper"),
                (F.substring("store", 1, 1).isin("S", "T", "W"), "Super"),
            ]
        ).alias("format"),
    )
