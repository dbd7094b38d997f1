"""Daily sales, scheduled orders, ticket sales and order locations.

Amounts come in hundredths as whole numbers, so totals are exact whatever the
order of addition; they are divided once, at the end.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import clock, labels, money
from tributary.operators.joins import enrich, latest_per_key
from tributary.operators.tables import replace_keys
from tributary.operators.windows import top_per_key


@dataclass(frozen=True)
class ChannelRules:
    """How raw order lines are classed. Names of sellers and sites come from the caller."""

    store_sellers: tuple[str, ...] = ()
    store_seller_patterns: tuple[str, ...] = ()
    app_patterns: tuple[str, ...] = ()
    pickup_patterns: tuple[str, ...] = ("%REC%", "%RETIRO%", "%AUTO%")
    warehouses: tuple[tuple[tuple[str, ...], str], ...] = ()
    store_aliases: tuple[tuple[str, str], ...] = ()


def _like_any(c: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | c.like(p)
    return F.coalesce(found, F.lit(False))


def order_classes(lines: DataFrame, rules: ChannelRules) -> DataFrame:
    """Operation, store, channel and dispatch of each line.

    lines(seller, site, courier, utm_source). A line of a store seller is
    ``TIENDA``, any other ``ALMACEN``; a warehouse line takes the code its site
    maps to, a store line the first four characters of its courier.
    """
    seller, courier = F.col("seller"), F.col("courier")
    from_store = F.coalesce(seller.isin(list(rules.store_sellers)), F.lit(False)) | _like_any(
        seller, rules.store_seller_patterns
    )
    prefix = F.substring(courier, 1, 4)
    codes = [(~from_store & _like_any(F.col("site"), patterns), F.lit(code)) for patterns, code in rules.warehouses]
    codes += [(prefix == old, F.lit(new)) for old, new in rules.store_aliases]
    store = prefix
    for condition, value in reversed(codes):
        store = F.when(condition, value).otherwise(store)
    return lines.withColumns(
        {
            "operation": F.when(from_store, "TIENDA").otherwise("ALMACEN"),
            "store": store,
            "channel": F.when(_like_any(F.col("utm_source"), rules.app_patterns), "APP").otherwise("WEB"),
            "dispatch": F.when(_like_any(courier, rules.pickup_patterns), "RETIRO EN TIENDA").otherwise("DELIVERY"),
        }
    )


def taxed_parts(lines: DataFrame, materials: DataFrame, exempt=money.TAX_EXEMPT_TYPES) -> DataFrame:
    """Lines with ``taxed``: the part of ``gross`` that carries tax."""
    types = materials.select("material_id", "tax_type")
    taxed = F.when(money.is_exempt(F.col("tax_type"), exempt), F.lit(0)).otherwise(F.col("gross"))
    return lines.join(types, "material_id").withColumn("taxed", taxed.cast("bigint")).drop("tax_type")


def order_totals(lines: DataFrame, *sums: str) -> DataFrame:
    """Lines rolled up to one row per order, before any join with order attributes."""
    return lines.groupBy("order_id").agg(*[F.sum(c).alias(c) for c in sums])


def net_amount(gross: Column, taxed: Column, factor: float = money.TAX_FACTOR) -> Column:
    return money.net_from_parts((gross - taxed).cast("double"), taxed.cast("double"), factor)


def daily_sales(
    lines: DataFrame,
    orders: DataFrame,
    materials: DataFrame,
    exempt=money.TAX_EXEMPT_TYPES,
    factor: float = money.TAX_FACTOR,
) -> DataFrame:
    """Gross, net and orders by chain, channel, month, day, week, prime and status group.

    lines(order_id, material_id, gross), materials(material_id, tax_type),
    orders(order_id, chain, channel, created, prime, status_group), one row per
    order. Lines shrink to one row per order first, so orders are counted
    without a distinct.
    """
    per_order = order_totals(taxed_parts(lines, materials, exempt), "gross", "taxed")
    joined = per_order.join(orders, "order_id")
    dims = {
        "month": clock.month_key(F.col("created")),
        "day": clock.day_key(F.col("created")),
        "week": F.weekofyear("created"),
        "prime": F.when(F.coalesce(F.col("prime"), F.lit(False)), "SI").otherwise("NO"),
        "status_group": labels.grouped_status(F.col("status_group")),
    }
    grouped = joined.withColumns(dims).groupBy("chain", "channel", *dims)
    totals = grouped.agg(
        money.exact_sum(F.col("gross")).alias("gross"),
        money.exact_sum(F.col("taxed")).alias("taxed"),
        F.count(F.lit(1)).alias("orders"),
    )
    return totals.select(
        "chain", "channel", *dims,
        money.major(F.col("gross")).alias("gross"),
        (net_amount(F.col("gross"), F.col("taxed"), factor) / 100.0).alias("net"),
        "orders",
    )


def scheduled_invoiced(
    orders: DataFrame,
    shipping: DataFrame,
    invoiced_from,
    invoiced_to,
    delivery_patterns: list[str],
    excluded_status: tuple[str, ...] = (labels.VOIDED_AND_RETURNED,),
) -> DataFrame:
    """Orders by store, scheduled day and invoiced day.

    orders(order_id, chain, store, region, invoiced, delivery_type, status_group);
    shipping(id, order_id, window_start): the first row per order decides.
    """
    first = latest_per_key(shipping, "order_id", "id", first=True).select("order_id", "window_start")
    wanted = F.lit(False)
    for p in delivery_patterns:
        wanted = wanted | F.col("delivery_type").like(p)
    chosen = orders.filter(F.col("invoiced").between(F.lit(invoiced_from), F.lit(invoiced_to))).filter(
        wanted & ~F.col("status_group").isin(list(excluded_status))
    )
    days = {
        "scheduled_day": clock.day_key(F.col("window_start")),
        "invoiced_day": clock.day_key(F.col("invoiced")),
        "invoiced_month": clock.month_key(F.col("invoiced")),
    }
    return (
        chosen.join(first, "order_id")
        .withColumns(days)
        .groupBy("chain", "store", "region", *days)
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def ticket_key(store: Column, day: Column, till: Column, ticket: Column, time_label: Column) -> Column:
    """``store-day-till-ticket-hhmm``; ``time_label`` is ``HH:mm``."""
    hhmm = F.concat(F.substring(time_label, 1, 2), F.substring(time_label, -2, 2))
    return F.concat_ws("-", store, day.cast("string"), till, ticket, hhmm)


def ticket_sales(lines: DataFrame, materials: DataFrame, documents: DataFrame, order_by: list[Column]) -> DataFrame:
    """Sold lines with material attributes and, where known, the document of their ticket.

    lines(ticket_key, material_id, …), materials(material_id, …),
    documents(ticket_key, document_type, folio); several documents per ticket
    are reduced by ``order_by``.
    """
    named = lines.join(materials, "material_id")
    return enrich(named, documents, ["ticket_key"], ["document_type", "folio"], order_by)


def ticket_refresh(
    stored: DataFrame,
    lines: DataFrame,
    materials: DataFrame,
    documents: DataFrame,
    numbers: DataFrame,
    as_of: date,
    days: int = 10,
    channel: int = 2,
) -> DataFrame:
    """``stored`` ticket lines with the last days' tickets replaced by what is known of them now.

    lines(ticket_key, material_id, sold_on, channel, …) of one channel, from ``days`` before ``as_of`` up to the day
    before it; documents as in ``ticket_sales``, the first folio counts; numbers(ticket_key, order_number), of which
    the smallest counts and keeps eight characters. A ticket in that window replaces all its stored lines.
    """
    on = F.col("sold_on")
    recent = lines.filter((on >= F.lit(as_of - timedelta(days=days))) & (on < F.lit(as_of)) & (F.col("channel") == channel))
    named = ticket_sales(recent.drop("channel"), materials, documents, [F.col("folio").asc_nulls_last(), F.col("document_type")])
    short = numbers.select("ticket_key", F.substring("order_number", 1, 8).alias("order_number"))
    fresh = enrich(named, short, ["ticket_key"], ["order_number"], [F.col("order_number").asc_nulls_last()])
    return replace_keys(stored, fresh.select(*stored.columns), ["ticket_key"])


def order_locations(
    orders: DataFrame,
    points: DataFrame,
    groups: tuple[str, ...] = labels.SOLD_GROUPS,
) -> DataFrame:
    """One location per order (largest latitude), without zero or missing places.

    orders(order_id, …, pickup, status_group), points(order_id, lat, lng).
    """
    one = top_per_key(
        points.select("order_id", "lat", "lng").filter(F.col("lat").isNotNull()),
        ["order_id"],
        [F.col("lat").desc(), F.col("lng").desc()],
    ).filter(F.col("lat") != 0)
    chosen = orders.filter(F.col("status_group").isin(list(groups)) & ~F.col("pickup"))
    return chosen.join(one, "order_id")


def closed_month_locations(
    orders: DataFrame,
    points: DataFrame,
    lines: DataFrame,
    as_of: date,
    months: int = 3,
    groups: tuple[str, ...] = labels.SOLD_GROUPS,
) -> DataFrame:
    """``order_locations`` of the last closed months, with the day and the gross amount of each order.

    orders(order_id, created, …, pickup, status_group), points(order_id, lat, lng), lines(order_id, gross in
    hundredths). The months bound ``created`` itself, so they reach the scan. Orders without lines are left out.
    """
    since, until = clock.closed_months(as_of, months)
    created = F.col("created")
    recent = orders.filter((created >= F.lit(since)) & (created < F.lit(until)))
    dated = recent.withColumns({"month": clock.month_key(created), "day": clock.day_key(created)}).drop("created")
    # Joined on the order and grouped by it: one shuffle of the lines serves both.
    keys = dated.columns
    sold = lines.select("order_id", "gross").join(dated, "order_id").groupBy(*keys).agg(money.exact_sum(F.col("gross")).alias("gross"))
    return order_locations(sold, points, groups).withColumn("gross", money.major(F.col("gross")))
