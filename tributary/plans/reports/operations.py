"""Delivery windows, lead times and order progress flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import clock, labels
from tributary.operators.joins import adjacent, enrich, range_join

# Window states.
OPEN = "Abierta"
CLOSED_FULL = "Cierre Capacidad"
CLOSED_PLANNED = "Cierre Programado"
EARLY_MINUTES = -30


def window_state(blocked: Column, planned: Column) -> Column:
    """Never blocked: open. Blocked over a minute before plan: full. Else: as planned."""
    soon = F.timestamp_add("MINUTE", F.lit(1), blocked)
    return (
        F.when(blocked.isNull(), F.lit(OPEN))
        .when(soon < planned, F.lit(CLOSED_FULL))
        .otherwise(F.lit(CLOSED_PLANNED))
    )


def delivery_windows(windows: DataFrame) -> DataFrame:
    """Windows with planned close, state and the end of the window that follows.

    windows(window_id, carrier, starts, ends, blocked, offset_hours, quota,
    quantity). Windows without quota or orders are left out.
    """
    planned = F.timestamp_add("HOUR", -F.col("offset_hours").cast("int"), F.col("ends"))
    rich = windows.withColumn("planned_close", planned).withColumn("day", clock.day_key(F.col("starts")))
    rich = adjacent(rich, ["day", "carrier"], "starts", "ends", {"ends": "next_ends"})
    state = window_state(F.col("blocked"), F.col("planned_close"))
    early = F.when(
        state == CLOSED_FULL, F.abs(clock.minute_boundaries(F.col("blocked"), F.col("planned_close")))
    )
    return rich.filter("quota <> 0 and quantity <> 0").withColumns(
        {
            "state": state,
            "is_open": F.when(state == OPEN, 1).otherwise(0),
            "minutes_closed_early": early,
            "early_start": F.timestamp_add("HOUR", F.lit(-3), F.col("starts")),
        }
    )


def _mean_minutes(matched: DataFrame, until: str, prefix: str) -> DataFrame:
    minutes = F.abs(clock.minute_boundaries(F.col("ordered"), F.col(until)))
    return matched.groupBy("window_id").agg(
        F.count(F.lit(1)).alias(f"{prefix}_orders"), F.avg(minutes).alias(f"{prefix}_minutes")
    )


def window_lead_time(windows: DataFrame, orders: DataFrame, bucket_seconds: int = 4 * 3600) -> DataFrame:
    """Average lead time per window, in minutes; ``H.MM`` text only for display.

    Operative: orders placed between the block and the planned close, up to the
    end of the following window. Global: orders from three hours before the
    window to its end. orders(order_id, carrier, ordered), one row per order.
    """
    rich = delivery_windows(windows)
    operative = range_join(
        orders, rich.select("window_id", "carrier", "blocked", "planned_close", "next_ends"),
        ["carrier"], "ordered", "blocked", "planned_close", bucket_seconds,
    )
    overall = range_join(
        orders, rich.select("window_id", "carrier", "early_start", "ends"),
        ["carrier"], "ordered", "early_start", "ends", bucket_seconds,
    )
    out = rich.join(_mean_minutes(operative, "next_ends", "operative"), "window_id", "left").join(
        _mean_minutes(overall, "ends", "global"), "window_id", "left"
    )
    return out.withColumn("global_display", clock.hours_dot_minutes(F.floor(F.col("global_minutes"))))


def ops_flags(orders: DataFrame, providers: DataFrame, default_provider: str, pickup: bool = False) -> DataFrame:
    """Progress flags, provider and minutes early per order.

    orders(order_id, store, status, window_start, delivered), providers(store,
    provider). Minutes are counted for delivered orders only.
    """
    label = F.col("status_label")
    flagged = orders.withColumn("status_label", labels.code_label(F.col("status")))
    flagged = flagged.withColumns(
        {
            "picked": labels.label_in(label, labels.PICKED),
            "dispatched": labels.label_in(label, labels.DISPATCHED),
            "delivered_flag": labels.label_in(label, labels.DELIVERED),
            "provider": F.lit(default_provider),
        }
    )
    named = enrich(flagged, providers, ["store"], ["provider"], [F.col("provider").asc()])
    minutes = F.when(
        F.col("delivered_flag") == 1, clock.minute_boundaries(F.col("window_start"), F.col("delivered"))
    )
    early = F.when(minutes <= EARLY_MINUTES, 1).otherwise(0)
    out = named.withColumns({"minutes_from_window": minutes, "early_over_30": early})
    return out.withColumn("collected", F.col("delivered_flag")) if pickup else out
