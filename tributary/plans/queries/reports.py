"""The reports, with the driver's tables in the role of their inputs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tributary.functions import clock
from tributary.functions.money import minor
from tributary.operators.windows import top_per_key
from tributary.plans.registry import query, table
from tributary.plans.reports import kpi, operations, picking, promotions, sales, wholesale


def lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("material_id"),
        minor(F.col("l_extendedprice")).alias("gross"),
    )


def materials(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("material_id"), (F.col("p_size") % 8).alias("tax_type"))


def places(spark, sf):
    """Customer to store (nation) and chain (region)."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("n_name").alias("store"),
        F.col("r_name").alias("chain"),
        F.col("c_mktsegment").alias("segment"),
    )


def status_group():
    return (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .when(F.col("o_orderstatus") == "F", "ENTREGADO")
        .when(F.col("o_orderstatus") == "O", "EN PROCESO")
        .otherwise("ANULADO")
    )


_GROUP_SQL = """CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderstatus = 'F' THEN 'ENTREGADO'
                 WHEN o_orderstatus = 'O' THEN 'EN PROCESO' ELSE 'ANULADO' END"""
_PLACES_SQL = """(SELECT c_custkey, n_name AS store, r_name AS chain, c_mktsegment AS segment FROM customer
                 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_TAXED_SQL = """(SELECT l_orderkey, l_partkey, l_quantity, l_discount, l_returnflag, g,
                   CASE WHEN p_size % 8 IN (0, 3, 4, 5) THEN 0 ELSE g END AS taxed
                 FROM (SELECT *, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS g FROM lineitem)
                 JOIN part ON p_partkey = l_partkey)"""
_NET_SQL = "(CAST(gross - taxed AS DOUBLE) + CAST(taxed AS DOUBLE) / 1.18)"


@query(
    "daily_sales",
    f"""
    WITH o AS (
      SELECT o_orderkey, chain, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'APP' ELSE 'WEB' END AS channel,
             CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day,
             CAST(week(o_orderdate) AS INTEGER) AS week, CASE WHEN segment = 'BUILDING' THEN 'SI' ELSE 'NO' END AS prime,
             CASE {_GROUP_SQL} WHEN 'ANULADO' THEN 'ANULADO Y DEVOLUCIONES' ELSE coalesce({_GROUP_SQL}, 'POR IDENTIFICAR') END
               AS status_group
      FROM orders JOIN {_PLACES_SQL} ON c_custkey = o_custkey),
    t AS (SELECT chain, channel, month, day, week, prime, status_group, sum(g) AS gross, sum(taxed) AS taxed,
                 count(DISTINCT o_orderkey) AS orders
          FROM {_TAXED_SQL} JOIN o ON o_orderkey = l_orderkey GROUP BY ALL)
    SELECT chain, channel, month, day, week, prime, status_group, CAST(gross AS DOUBLE) / 100.0 AS gross,
           {_NET_SQL} / 100.0 AS net, orders FROM t
    """,
)
def daily_sales(spark, sf):
    orders = table(spark, sf, "orders").join(places(spark, sf), "o_custkey").select(
        F.col("o_orderkey").alias("order_id"),
        "chain",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "APP").otherwise("WEB").alias("channel"),
        F.col("o_orderdate").alias("created"),
        (F.col("segment") == "BUILDING").alias("prime"),
        status_group().alias("status_group"),
    )
    return sales.daily_sales(lines(spark, sf), orders, materials(spark, sf))


@query(
    "scheduled_invoiced",
    f"""
    WITH f AS (SELECT l_orderkey, min(l_linenumber * 1000000000000 + epoch_us(l_shipdate) // 1000000) AS k FROM lineitem GROUP BY 1)
    SELECT chain, store, chain AS region,
           CAST(strftime(TIMESTAMP '1970-01-01' + to_seconds(k % 1000000000000), '%Y%m%d') AS INTEGER) AS scheduled_day,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS invoiced_day,
           CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS invoiced_month, count(DISTINCT o_orderkey) AS orders
    FROM orders JOIN {_PLACES_SQL} ON c_custkey = o_custkey JOIN f ON l_orderkey = o_orderkey
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '2000-12-31' AND o_orderstatus <> 'P'
      AND (o_orderpriority LIKE '%URGENT%' OR o_orderpriority LIKE '%HIGH%' OR o_orderpriority LIKE '%LOW%')
    GROUP BY ALL
    """,
)
def scheduled_invoiced(spark, sf):
    orders = table(spark, sf, "orders").join(places(spark, sf), "o_custkey").select(
        F.col("o_orderkey").alias("order_id"),
        "chain",
        "store",
        F.col("chain").alias("region"),
        F.col("o_orderdate").alias("invoiced"),
        F.col("o_orderpriority").alias("delivery_type"),
        F.when(F.col("o_orderstatus") == "P", "ANULADO Y DEVOLUCIONES").otherwise("ENTREGADO").alias("status_group"),
    )
    ident = F.col("l_linenumber").cast("bigint") * 1000000000000 + clock.to_epoch(F.col("l_shipdate"))
    shipping = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), ident.alias("id"), F.col("l_shipdate").alias("window_start")
    )
    return sales.scheduled_invoiced(
        orders, shipping, "1997-01-01", "2000-12-31", ["%URGENT%", "%HIGH%", "%LOW%"]
    )


@query(
    "order_classes",
    """
    WITH l AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS seller, c_mktsegment AS site,
                 CASE WHEN o_custkey % 3 = 0 THEN 'S001 REC x' WHEN o_custkey % 3 = 1 THEN 'TH12 d' END AS courier,
                 o_orderstatus || 'App' AS utm FROM orders JOIN customer ON c_custkey = o_custkey),
    t AS (SELECT *, coalesce(seller IN ('1-URGENT') OR seller LIKE '%HIGH%', FALSE) AS st FROM l)
    SELECT o_orderkey, CASE WHEN st THEN 'TIENDA' ELSE 'ALMACEN' END AS operation,
           CASE WHEN NOT st AND site LIKE '%BUILD%' THEN 'W001' WHEN NOT st AND (site LIKE 'MACH%' OR site = 'FURNITURE') THEN 'W002'
                WHEN courier LIKE 'TH12%' THEN 'W101' ELSE substring(courier, 1, 4) END AS store,
           CASE WHEN utm LIKE '%FApp%' THEN 'APP' ELSE 'WEB' END AS channel,
           CASE WHEN courier LIKE '%REC%' OR courier LIKE '%RETIRO%' OR courier LIKE '%AUTO%' THEN 'RETIRO EN TIENDA'
                ELSE 'DELIVERY' END AS dispatch
    FROM t
    """,
)
def order_classes(spark, sf):
    turn = F.col("o_custkey") % 3
    raw = table(spark, sf, "orders").join(places(spark, sf), "o_custkey").select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("seller"),
        F.col("segment").alias("site"),
        F.when(turn == 0, "S001 REC x").when(turn == 1, "TH12 d").alias("courier"),
        F.concat("o_orderstatus", F.lit("App")).alias("utm_source"),
    )
    rules = sales.ChannelRules(
        store_sellers=("1-URGENT",),
        store_seller_patterns=("%HIGH%",),
        app_patterns=("%FApp%",),
        warehouses=((("%BUILD%",), "W001"), (("MACH%", "FURNITURE"), "W002")),
        store_aliases=(("TH12", "W101"),),
    )
    return sales.order_classes(raw, rules).select("o_orderkey", "operation", "store", "channel", "dispatch")


_KPI_INPUT = f"""
    l AS (SELECT l_orderkey, sum(g) AS gross, sum(taxed) AS taxed, sum(l_quantity) AS units,
                 coalesce(sum(CASE WHEN l_returnflag = 'R' THEN CAST(floor(g * l_discount + 0.5) AS BIGINT) END), 2729) AS margin,
                 bool_or(l_discount >= 0.1) AS promo FROM {_TAXED_SQL} GROUP BY 1),
    k AS (SELECT o_custkey, o_orderdate, gross, taxed, CAST(units AS BIGINT) AS units, margin,
                 CASE WHEN promo OR o_orderpriority = '1-URGENT' THEN 'PRIME' ELSE 'NO PRIME' END AS segment
          FROM l JOIN orders ON o_orderkey = l_orderkey)
"""
_KPI_OUT = f"""
    SELECT period, segment, customers, orders, CAST(gross AS DOUBLE) / 100.0 AS gross, CAST(units AS BIGINT) AS units,
           {_NET_SQL} / 100.0 AS net, CAST(margin AS DOUBLE) / 100.0 AS margin,
           CAST(gross AS DOUBLE) / CAST(customers AS DOUBLE) / 100.0 AS spend_per_customer,
           CAST(orders AS DOUBLE) / CAST(customers AS DOUBLE) AS frequency,
           CAST(gross AS DOUBLE) / CAST(orders AS DOUBLE) / 100.0 AS ticket,
           CAST(units AS DOUBLE) / CAST(orders AS DOUBLE) AS units_per_ticket,
           CAST(gross AS DOUBLE) / CAST(units AS DOUBLE) / 100.0 AS unit_price,
           CAST(margin AS DOUBLE) / {_NET_SQL} AS margin_share
    FROM t
"""
_KPI_SUMS = """count(DISTINCT o_custkey) AS customers, count(*) AS orders, sum(gross) AS gross, sum(taxed) AS taxed,
    sum(units) AS units, sum(margin) AS margin"""
_WEEK_SQL = "CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER)"
_MONTH_SQL = "CAST(strftime(o_orderdate, '%Y%m') AS INTEGER)"


def kpi_orders(spark, sf):
    raw = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("material_id"),
        minor(F.col("l_extendedprice")).alias("gross"),
        F.col("l_quantity").cast("bigint").alias("units"),
        F.when(F.col("l_returnflag") == "R", minor(minor(F.col("l_extendedprice")) * F.col("l_discount"), 0)).alias("margin"),
        (F.col("l_discount") >= 0.1).alias("promo_prime"),
    )
    rich = sales.taxed_parts(raw, materials(spark, sf))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created"),
        (F.col("o_orderpriority") == "1-URGENT").alias("prime"),
    )
    return kpi.order_kpi_input(rich, orders, default_margin=2729)


def _iso_week():
    created = F.col("created")
    return (F.extract(F.lit("YEAROFWEEK"), created) * 100 + F.weekofyear(created)).cast("int")


@query(
    "customer_kpis_week",
    f"WITH {_KPI_INPUT}, t AS (SELECT {_WEEK_SQL} AS period, segment, {_KPI_SUMS} FROM k GROUP BY 1, 2) {_KPI_OUT}",
)
def customer_kpis_week(spark, sf):
    return kpi.customer_kpis(kpi_orders(spark, sf), _iso_week())


@query(
    "customer_kpis_month",
    f"WITH {_KPI_INPUT}, t AS (SELECT {_MONTH_SQL} AS period, segment, {_KPI_SUMS} FROM k GROUP BY 1, 2) {_KPI_OUT}",
)
def customer_kpis_month(spark, sf):
    return kpi.customer_kpis(kpi_orders(spark, sf), clock.month_key(F.col("created")))


@query(
    "kpi_totals",
    f"""WITH {_KPI_INPUT}, t AS (
        SELECT {_MONTH_SQL} AS period, segment, {_KPI_SUMS} FROM k GROUP BY 1, 2
        UNION ALL SELECT {_MONTH_SQL}, 'TOTAL', {_KPI_SUMS} FROM k GROUP BY 1) {_KPI_OUT}""",
)
def kpi_totals(spark, sf):
    return kpi.customer_kpis_with_total(kpi_orders(spark, sf), clock.month_key(F.col("created")))


@query(
    "discount_share",
    """
    WITH l AS (SELECT l_orderkey AS order_id, l_returnflag AS material_id, l_linenumber, l_partkey, l_quantity AS quantity,
                 CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS net,
                 -CAST(floor(l_extendedprice * l_discount * 100 + 0.5) AS BIGINT) AS discount,
                 CAST(floor(l_extendedprice * 25 + 0.5) AS BIGINT) AS margin FROM lineitem),
    s AS (SELECT *, abs(sum(discount) OVER w) AS dt, sum(margin) OVER w AS margin_total, sum(quantity) OVER w AS quantity_total
          FROM l WINDOW w AS (PARTITION BY order_id, material_id)),
    p AS (SELECT *, floor(coalesce(CAST(abs(discount) AS DOUBLE) / nullif(CAST(dt AS DOUBLE), 0), 1.0) * 100 + 0.5) / 100 AS share FROM s),
    m AS (SELECT *, floor(CAST(margin_total AS DOUBLE) / 100.0 * share * 100 + 0.5) / 100 AS pm FROM p)
    SELECT order_id, material_id, l_linenumber, l_partkey, share, quantity_total,
           CASE WHEN quantity_total > quantity AND pm > net / 100.0 THEN pm / quantity_total * quantity ELSE pm END AS promo_margin
    FROM m
    """,
)
def discount_share(spark, sf):
    price = F.col("l_extendedprice")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_returnflag").alias("material_id"),
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").alias("quantity"),
        minor(price).alias("net"),
        (-minor(price * F.col("l_discount"))).alias("discount"),
        minor(price * 25, 0).alias("margin"),
    )
    return promotions.discount_share(rows, stored=True).select(
        "order_id", "material_id", "l_linenumber", "l_partkey", "share", "quantity_total", "promo_margin"
    )


@query(
    "promotion_allocation",
    """
    WITH l AS (SELECT l_orderkey AS order_id, l_returnflag AS material_id, l_linenumber AS line, CAST(l_quantity AS BIGINT) AS q,
                 CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS net, CAST(floor(l_extendedprice * l_discount * 100 + 0.5) AS BIGINT) AS d,
                 CAST(floor(l_extendedprice * l_tax * 100 + 0.5) AS BIGINT) AS t, CAST(floor(l_extendedprice * 250 + 0.5) AS BIGINT) AS m FROM lineitem),
    i AS (SELECT order_id, material_id, CAST(sum(q) AS BIGINT) AS iq, CAST(sum(m) AS BIGINT) AS im FROM l GROUP BY ALL),
    p AS (SELECT order_id, material_id, 'coupon' AS promotion, line, q, net, d AS discount FROM l
          UNION ALL SELECT order_id, material_id, 'season', line, q, net, t FROM l),
    w AS (SELECT *, CASE WHEN sum(discount) OVER it > 0 THEN discount ELSE 1 END AS wt FROM p WINDOW it AS (PARTITION BY order_id, material_id)),
    c AS (SELECT w.*, iq, im, row_number() OVER o AS n, sum(wt) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS u, sum(wt) OVER (PARTITION BY order_id, material_id) AS a
          FROM w JOIN i USING (order_id, material_id) WINDOW o AS (PARTITION BY order_id, material_id ORDER BY promotion, line, discount, q, net)),
    s AS (SELECT *, (floor(100.0::DOUBLE * u::DOUBLE / a::DOUBLE + 0.5) - floor(100.0::DOUBLE * (u - wt)::DOUBLE / a::DOUBLE + 0.5)) / 100 AS share,
                 floor(im::DOUBLE * u::DOUBLE / a::DOUBLE + 0.5) - floor(im::DOUBLE * (u - wt)::DOUBLE / a::DOUBLE + 0.5) AS m0 FROM c),
    g AS (SELECT *, CASE WHEN iq > q AND m0 > net THEN floor(m0::DOUBLE * q / iq + 0.5) ELSE m0 END AS m1 FROM s)
    SELECT order_id, material_id, promotion, line, share, CAST(m1 AS BIGINT) AS promo_margin,
           CAST(CASE WHEN n = 1 THEN im - sum(m1) OVER (PARTITION BY order_id, material_id) ELSE 0 END AS BIGINT) AS rest_margin
    FROM g
    """,
)
def promotion_allocation(spark, sf):
    """Two promotions on every sold line: item facts join once per item, shares add up to 1, margins to the item's."""
    price = F.col("l_extendedprice")
    sold = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("material_id"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("bigint").alias("quantity"), minor(price).alias("net"), minor(price * 250, 0).alias("margin"),
        F.array(
            F.struct(F.lit("coupon").alias("promotion"), minor(price * F.col("l_discount")).alias("discount")),
            F.struct(F.lit("season").alias("promotion"), minor(price * F.col("l_tax")).alias("discount")),
        ).alias("promotions"),
    )
    items = sold.groupBy("order_id", "material_id").agg(F.sum("quantity").alias("quantity"), F.sum("net").alias("net"), F.sum("margin").alias("margin"))
    lines = sold.select("order_id", "material_id", "line", "quantity", "net", F.explode("promotions").alias("p")).select("*", "p.*").drop("p")
    out = promotions.allocate(items, lines, tie=["line"])
    return out.select("order_id", "material_id", "promotion", "line", "share", "promo_margin", "rest_margin")


@query(
    "promotion_summary",
    """
    SELECT event_type AS promotion, count(*) AS lines, CAST(sum(q) AS BIGINT) AS quantity, CAST(sum(n) AS BIGINT) AS net
    FROM (SELECT CASE WHEN event_type = 'view' THEN 'Free Delivery' ELSE event_type END AS event_type, user_id AS q,
                 CAST(floor(value * 100 + 0.5) AS BIGINT) AS n FROM events)
    WHERE event_type NOT LIKE '%Deliver%' GROUP BY 1
    """,
)
def promotion_summary(spark, sf):
    rows = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "view", "Free Delivery").otherwise(F.col("event_type")).alias("promotion"),
        F.col("user_id").alias("quantity"),
        minor(F.col("value")).alias("net"),
        F.lit(0).alias("discount"),
        F.lit(0.0).alias("promo_margin"),
    )
    _, rest = promotions.split_delivery(rows)
    summary = promotions.promotion_summary(rest, ["promotion"])
    counts = rest.groupBy("promotion").agg(F.count(F.lit(1)).alias("lines"))
    return summary.join(counts, "promotion").select("promotion", "lines", "quantity", "net")


_BULK_SQL = """
    d AS (SELECT o_custkey AS customer_id, l_partkey AS material_id, r_name AS chain, o_orderkey AS order_id,
                 l_quantity AS units, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS net,
                 CAST(floor(l_extendedprice * 100 * (0.05 - l_discount) + 0.5) AS BIGINT) AS margin,
                 CASE WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'FOOD' WHEN p_type = 'PROMO' THEN 'ELECTRO' ELSE 'OTHER' END
                   AS area
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
          JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
"""


@query(
    "bulk_buyers",
    f"""
    WITH {_BULK_SQL},
    c AS (SELECT customer_id, material_id, chain, area, sum(units) AS u FROM d GROUP BY ALL
          HAVING sum(margin) / nullif(CAST(sum(net) AS DOUBLE), 0) < 0)
    SELECT DISTINCT d.* FROM d JOIN (
        SELECT * FROM c WHERE area = 'FOOD' AND u >= 12 UNION ALL SELECT * FROM c WHERE area = 'ELECTRO' AND u >= 3) b
      ON b.customer_id = d.customer_id AND b.material_id = d.material_id AND b.chain = d.chain
    """,
)
def bulk_buyers(spark, sf):
    price = F.col("l_extendedprice")
    raw = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("material_id"),
        F.col("l_quantity").alias("units"),
        minor(price).alias("net"),
        minor(price * 100 * (0.05 - F.col("l_discount")), 0).alias("margin"),
    )
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("material_id"),
        F.when(F.col("p_type").isin("STANDARD", "ECONOMY"), "FOOD")
        .when(F.col("p_type") == "PROMO", "ELECTRO")
        .otherwise("OTHER")
        .alias("area"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(
        places(spark, sf).select("o_custkey", "chain"), "o_custkey"
    )
    detail = raw.join(orders, "o_orderkey").join(parts, "material_id").select(
        F.col("o_custkey").alias("customer_id"), "material_id", "chain", F.col("o_orderkey").alias("order_id"), "units",
        "net", "margin", "area",
    )
    return wholesale.bulk_buyers(detail)


def items(spark, sf):
    """One row per (order, line): every third line replaces the line before it."""
    one = top_per_key(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
            "l_linestatus",
        ),
        ["l_orderkey", "l_linenumber"],
        [F.col(c).asc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")],
    )
    ident = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return one.select(
        ident.alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku"),
        F.when(F.col("l_linestatus") == "O", "kg").otherwise("un").alias("unit"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_quantity") - F.col("l_linenumber") % 2).alias("quantity_picked"),
        minor(F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linenumber") % 3 == 0, ident - 1).alias("substitute_of"),
    )


_ITEMS_SQL = """
    i AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku,
                 CASE WHEN l_linestatus = 'O' THEN 'kg' ELSE 'un' END AS unit, l_quantity AS quantity,
                 l_quantity - l_linenumber % 2 AS quantity_picked, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS price,
                 CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey * 10 + l_linenumber - 1 END AS substitute_of, l_linenumber
          FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem) WHERE n = 1)
"""


def status_code():
    return F.when(F.col("o_orderstatus") == "F", 90).when(F.col("o_orderstatus") == "O", 40).otherwise(100)


_STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 90 WHEN 'O' THEN 40 ELSE 100 END"


@query(
    "pick_detail",
    f"""
    WITH {_ITEMS_SQL},
    w AS (SELECT l_orderkey * 10 + l_linenumber AS item_id, sum(l_quantity * 980) AS weight FROM lineitem GROUP BY 1),
    x AS (SELECT i.*, w.weight, (p_size % 4 + 1) * 0.25::DOUBLE AS kgf, (p_size % 2 + 1) * 0.5::DOUBLE AS unf
          FROM i LEFT JOIN w ON item_id = id LEFT JOIN part ON p_partkey = sku),
    j AS (SELECT m.*, r.sku AS rsku, r.unit AS ru, r.weight AS rw, r.quantity_picked AS rq, r.unf AS runf
          FROM (SELECT * FROM x WHERE substitute_of IS NULL) m LEFT JOIN x r ON r.substitute_of = m.id),
    g AS (SELECT *, CAST(CASE unit WHEN 'kg' THEN floor(quantity * 1000 * kgf + 0.5) ELSE floor(quantity * 1000 * unf + 0.5) END AS BIGINT) AS rg,
                 CAST(CASE unit WHEN 'kg' THEN coalesce(floor(weight + 0.5), 0) ELSE floor(quantity_picked * 1000 * unf + 0.5) END AS BIGINT) AS pg,
                 CAST(CASE ru WHEN 'kg' THEN floor(rw + 0.5) WHEN 'un' THEN floor(rq * 1000 * runf + 0.5) END AS BIGINT) AS xg FROM j)
    SELECT order_id, id, sku, unit, quantity AS requested_units, quantity_picked AS picked_units,
           quantity - quantity_picked AS difference_units, rg AS requested_grams, pg AS picked_grams,
           rg - pg AS difference_grams, price * quantity AS amount_requested, rsku AS replacement_sku, xg AS replaced_grams
    FROM g JOIN orders ON o_orderkey = order_id WHERE {_STATUS_SQL} <> 100
    """,
)
def pick_detail(spark, sf):
    weights = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"), (F.col("l_quantity") * 980).alias("weight")
    )
    skus = table(spark, sf, "part").select(
        F.col("p_partkey").alias("sku"),
        ((F.col("p_size") % 4 + 1) * 0.25).alias("kg_factor"),
        ((F.col("p_size") % 2 + 1) * 0.5).alias("unit_factor"),
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), status_code().alias("status"))
    return picking.pick_detail(items(spark, sf), weights, skus, orders)


@query(
    "stockouts",
    f"""
    WITH {_ITEMS_SQL},
    a AS (SELECT order_id, CASE sku % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'S' WHEN 2 THEN 'T' ELSE 'X' END || (sku % 10) AS store,
                 sku AS material_id, price, CASE WHEN substitute_of IS NULL THEN 'NO' ELSE 'SI' END AS sub, upper(unit) AS unit,
                 quantity AS requested, CASE unit WHEN 'kg' THEN quantity_picked * 980 / 1000 ELSE quantity_picked END AS picked FROM i),
    b AS (SELECT order_id, store, material_id, price, sub, unit, sum(requested) AS requested,
                 least(sum(picked), sum(requested)) AS c FROM a WHERE sub = 'NO' GROUP BY ALL),
    e AS (SELECT *, CASE WHEN unit = 'KG' THEN CASE WHEN c / nullif(requested, 0) > 0.9 THEN requested ELSE 0 END ELSE c END AS final FROM b)
    SELECT order_id, store, material_id, unit, requested, final AS picked, requested - final AS missing,
           (requested - final) * price / 100.0 AS gross,
           CASE WHEN p_size % 8 IN (0, 3, 4, 5) THEN (requested - final) * price / 100.0
                ELSE (requested - final) * price / 100.0 / 1.18::DOUBLE END AS net,
           CASE WHEN store LIKE 'H%' THEN 'Hiper' WHEN store LIKE 'S%' OR store LIKE 'T%' OR store LIKE 'W%' THEN 'Super' END AS format
    FROM e JOIN part ON p_partkey = material_id WHERE requested - final > 0
    """,
)
def stockouts(spark, sf):
    i = items(spark, sf)
    letter = F.col("sku") % 4
    store = F.concat(
        F.when(letter == 0, "H").when(letter == 1, "S").when(letter == 2, "T").otherwise("X"),
        (F.col("sku") % 10).cast("string"),
    )
    rows = i.select(
        "order_id", F.col("sku").alias("material_id"), store.alias("store"), "price",
        F.when(F.col("substitute_of").isNull(), "NO").otherwise("SI").alias("substitute"),
        F.upper("unit").alias("unit"),
        F.col("quantity").alias("requested"),
        F.when(F.col("unit") == "kg", F.col("quantity_picked") * 980 / 1000).otherwise(F.col("quantity_picked")).alias("picked"),
    )
    return picking.stockouts(rows, materials(spark, sf))


@query(
    "window_lead_time",
    """
    WITH w AS (
      SELECT event_type AS carrier, (epoch_us(ts) // 1000000) // 14400 AS slot, count(*) AS quantity,
             CASE WHEN count(*) >= 8 THEN max(CASE WHEN value < 12 THEN ts END) END AS blocked
      FROM events GROUP BY 1, 2),
    x AS (SELECT *, event_slot(slot) AS starts, event_slot(slot + 1) AS ends, event_slot(slot + 1) - INTERVAL 1 HOUR AS planned FROM w),
    y AS (SELECT a.*, b.ends AS next_ends,
                 CASE WHEN a.blocked IS NULL THEN 'Abierta' WHEN a.blocked + INTERVAL 1 MINUTE < a.planned THEN 'Cierre Capacidad'
                      ELSE 'Cierre Programado' END AS state
          FROM x a LEFT JOIN x b ON b.carrier = a.carrier AND b.starts = a.ends
            AND strftime(b.starts, '%Y%m%d') = strftime(a.starts, '%Y%m%d')),
    op AS (SELECT y.carrier, slot, count(*) AS n, avg(abs((epoch_us(next_ends) // 1000000) // 60 - (epoch_us(ts) // 1000000) // 60)) AS m
           FROM y JOIN events e ON e.event_type = y.carrier AND ts >= blocked AND ts < planned GROUP BY 1, 2),
    gl AS (SELECT y.carrier, slot, count(*) AS n, avg(abs((epoch_us(ends) // 1000000) // 60 - (epoch_us(ts) // 1000000) // 60)) AS m
           FROM y JOIN events e ON e.event_type = y.carrier AND ts >= starts - INTERVAL 3 HOUR AND ts < ends GROUP BY 1, 2)
    SELECT y.carrier || ':' || y.slot AS window_id, state, quantity, CAST(CASE WHEN state = 'Abierta' THEN 1 ELSE 0 END AS INTEGER) AS is_open,
           CASE WHEN state = 'Cierre Capacidad' THEN (epoch_us(planned) // 1000000) // 60 - (epoch_us(blocked) // 1000000) // 60 END AS minutes_closed_early,
           op.n AS operative_orders, op.m AS operative_minutes, gl.n AS global_orders, gl.m AS global_minutes,
           CAST(CAST(floor(gl.m) AS BIGINT) // 60 AS VARCHAR) || '.' || lpad(CAST(CAST(floor(gl.m) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS global_display
    FROM y LEFT JOIN op ON op.carrier = y.carrier AND op.slot = y.slot LEFT JOIN gl ON gl.carrier = y.carrier AND gl.slot = y.slot
    """.replace("event_slot(slot + 1)", "(TIMESTAMP '1970-01-01' + to_seconds((slot + 1) * 14400))").replace(
        "event_slot(slot)", "(TIMESTAMP '1970-01-01' + to_seconds(slot * 14400))"
    ),
)
def window_lead_time(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    slot = F.floor(clock.to_epoch(F.col("ts")) / 14400)
    slots = e.groupBy(F.col("event_type").alias("carrier"), slot.alias("slot")).agg(
        F.count(F.lit(1)).alias("quantity"), F.max(F.when(F.col("value") < 12, F.col("ts"))).alias("seen")
    )
    windows = slots.select(
        F.concat("carrier", F.lit(":"), F.col("slot").cast("string")).alias("window_id"),
        "carrier",
        clock.epoch_to_utc(F.col("slot") * 14400).alias("starts"),
        clock.epoch_to_utc((F.col("slot") + 1) * 14400).alias("ends"),
        F.when(F.col("quantity") >= 8, F.col("seen")).alias("blocked"),
        F.lit(1).alias("offset_hours"),
        F.lit(10).alias("quota"),
        "quantity",
    )
    orders = e.select(F.col("event_id").alias("order_id"), F.col("event_type").alias("carrier"), F.col("ts").alias("ordered"))
    return operations.window_lead_time(windows, orders).select(
        "window_id", "state", "quantity", "is_open", "minutes_closed_early", "operative_orders", "operative_minutes",
        "global_orders", "global_minutes", "global_display",
    )


@query(
    "ops_flags",
    """
    WITH s AS (SELECT l_orderkey, min(l_shipdate) AS delivered FROM lineitem GROUP BY 1),
    o AS (SELECT o_orderkey, c_nationkey AS store, CASE WHEN o_orderstatus = 'F' THEN 90 WHEN o_orderstatus = 'O' THEN
                 CASE WHEN o_orderpriority = '1-URGENT' THEN 70 ELSE 30 END ELSE 10 END AS code,
                 o_orderdate + INTERVAL 2 DAY AS ws, delivered
          FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN s ON l_orderkey = o_orderkey),
    p AS (SELECT s_nationkey, min(s_name) AS provider FROM supplier GROUP BY 1),
    m AS (SELECT *, CASE WHEN code = 90 THEN (epoch_us(delivered) // 1000000) // 60 - (epoch_us(ws) // 1000000) // 60 END AS mins FROM o)
    SELECT o_orderkey AS order_id, CASE code WHEN 90 THEN 'ENTREGADO' WHEN 70 THEN 'DESPACHADO' WHEN 30 THEN 'PICKEADO POR FACTURAR'
             ELSE 'PENDIENTE DE PICKING' END AS status_label, CAST(code <> 10 AS INTEGER) AS picked,
           CAST(code IN (70, 90) AS INTEGER) AS dispatched, CAST(code = 90 AS INTEGER) AS delivered_flag,
           coalesce(provider, 'OWN FLEET') AS provider, mins AS minutes_from_window,
           CAST(CASE WHEN mins <= -30 THEN 1 ELSE 0 END AS INTEGER) AS early_over_30
    FROM m LEFT JOIN p ON s_nationkey = store
    """,
)
def ops_flags(spark, sf):
    shipped = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("delivered")
    )
    code = (
        F.when(F.col("o_orderstatus") == "F", 90)
        .when(F.col("o_orderstatus") == "O", F.when(F.col("o_orderpriority") == "1-URGENT", 70).otherwise(30))
        .otherwise(10)
    )
    stores = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("store"))
    orders = table(spark, sf, "orders").join(stores, "o_custkey").join(shipped, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"), "store", code.alias("status"),
        F.timestamp_add("DAY", F.lit(2), F.col("o_orderdate")).alias("window_start"), "delivered",
    )
    providers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("store"), F.col("s_name").alias("provider"))
    return operations.ops_flags(orders, providers, "OWN FLEET").select(
        "order_id", "status_label", "picked", "dispatched", "delivered_flag", "provider", "minutes_from_window",
        "early_over_30",
    )


@query(
    "one_location_per_order",
    f"""
    WITH p AS (SELECT l_orderkey, CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_suppkey % 7 = 0 THEN 0.0 ELSE s_acctbal / 100 END AS lat,
                      CAST(l_suppkey AS DOUBLE) AS lng FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY lat DESC, lng DESC) AS n FROM p
                           WHERE lat IS NOT NULL) WHERE n = 1 AND lat <> 0)
    SELECT o_orderkey AS order_id, chain, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month, lat, lng
    FROM orders JOIN {_PLACES_SQL} ON c_custkey = o_custkey JOIN one ON l_orderkey = o_orderkey
    WHERE {_GROUP_SQL} IN ('ENTREGADO', 'EN PROCESO') AND o_orderpriority <> '5-LOW'
    """,
)
def one_location_per_order(spark, sf):
    spots = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    key = F.col("l_suppkey")
    lat = F.when(key % 5 == 0, F.lit(None)).when(key % 7 == 0, F.lit(0.0)).otherwise(F.col("s_acctbal") / 100)
    points = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").join(spots, "l_suppkey").select(
        F.col("l_orderkey").alias("order_id"), lat.alias("lat"), key.cast("double").alias("lng")
    )
    orders = table(spark, sf, "orders").join(places(spark, sf), "o_custkey").select(
        F.col("o_orderkey").alias("order_id"), "chain", clock.month_key(F.col("o_orderdate")).alias("month"),
        (F.col("o_orderpriority") == "5-LOW").alias("pickup"), status_group().alias("status_group"),
    )
    return sales.order_locations(orders, points).drop("pickup", "status_group")


@query(
    "closed_month_locations",
    f"""
    WITH p AS (SELECT l_orderkey, CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_suppkey % 7 = 0 THEN 0.0 ELSE s_acctbal / 100 END AS lat,
                      CAST(l_suppkey AS DOUBLE) AS lng FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY lat DESC, lng DESC) AS n FROM p
                           WHERE lat IS NOT NULL) WHERE n = 1 AND lat <> 0),
    sold AS (SELECT l_orderkey, sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) / 100.0 AS gross FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey AS order_id, chain, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day, CAST(gross AS DOUBLE) AS gross, lat, lng
    FROM orders JOIN {_PLACES_SQL} ON c_custkey = o_custkey JOIN one ON one.l_orderkey = o_orderkey JOIN sold ON sold.l_orderkey = o_orderkey
    WHERE {_GROUP_SQL} IN ('ENTREGADO', 'EN PROCESO') AND o_orderpriority <> '5-LOW'
      AND o_orderdate >= DATE '1995-11-01' AND o_orderdate < DATE '1996-02-01'
    """,
)
def closed_month_locations(spark, sf):
    spots = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    key = F.col("l_suppkey")
    lat = F.when(key % 5 == 0, F.lit(None)).when(key % 7 == 0, F.lit(0.0)).otherwise(F.col("s_acctbal") / 100)
    lines = table(spark, sf, "lineitem")
    points = lines.select("l_orderkey", "l_suppkey").join(spots, "l_suppkey").select(
        F.col("l_orderkey").alias("order_id"), lat.alias("lat"), key.cast("double").alias("lng")
    )
    orders = table(spark, sf, "orders").join(places(spark, sf), "o_custkey").select(
        F.col("o_orderkey").alias("order_id"), "chain", F.col("o_orderdate").alias("created"),
        (F.col("o_orderpriority") == "5-LOW").alias("pickup"), status_group().alias("status_group"),
    )
    sold = lines.select(F.col("l_orderkey").alias("order_id"), minor(F.col("l_extendedprice")).alias("gross"))
    return sales.closed_month_locations(orders, points, sold, date(1996, 2, 15)).drop("pickup", "status_group")


@query(
    "ticket_sales",
    """
    WITH t AS (SELECT o_orderkey, 'S' || (o_custkey % 50) || '-' || strftime(o_orderdate, '%Y%m%d') || '-' || (o_orderkey % 9) || '-' ||
                      o_orderkey || '-0000' AS ticket_key, o_orderpriority, o_totalprice FROM orders)
    SELECT a.ticket_key, l_linenumber, l_partkey AS material_id, p_brand AS brand, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS gross,
           CASE WHEN a.o_orderpriority <> '5-LOW' THEN a.o_orderpriority END AS document_type,
           CASE WHEN a.o_orderpriority <> '5-LOW' THEN 'F' || a.o_orderkey END AS folio
    FROM lineitem JOIN t a ON a.o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    """,
)
def ticket_sales(spark, sf):
    key = sales.ticket_key(
        F.concat(F.lit("S"), (F.col("o_custkey") % 50).cast("string")),
        clock.day_key(F.col("o_orderdate")),
        (F.col("o_orderkey") % 9).cast("string"),
        F.col("o_orderkey").cast("string"),
        clock.clock_label(F.col("o_orderdate")),
    )
    tickets = table(spark, sf, "orders").withColumn("ticket_key", key)
    sold = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_partkey").alias("material_id"),
        minor(F.col("l_extendedprice")).alias("gross"),
    ).join(tickets.select("o_orderkey", "ticket_key"), "o_orderkey").drop("o_orderkey")
    documents = tickets.filter("o_orderpriority <> '5-LOW'").select(
        "ticket_key", F.col("o_orderpriority").alias("document_type"),
        F.concat(F.lit("F"), F.col("o_orderkey").cast("string")).alias("folio"),
    )
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("material_id"), F.col("p_brand").alias("brand"))
    return sales.ticket_sales(sold, brands, documents, [F.col("folio").asc()])


@query(
    "ticket_refresh",
    """
    WITH l AS (SELECT 'S' || (o_custkey % 50) || '-' || o_orderkey AS ticket_key, l_linenumber, l_partkey AS material_id,
                      CAST(o_orderdate AS DATE) AS sold_on, o_custkey % 3 AS channel, o_orderkey, o_orderpriority,
                      CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS gross FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    fresh AS (SELECT ticket_key, l_linenumber, material_id, sold_on, gross, p_brand AS brand,
                     CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS document_type,
                     CASE WHEN o_orderpriority <> '5-LOW' THEN 'F' || o_orderkey END AS folio,
                     CASE WHEN o_orderkey % 4 <> 0 THEN substr(CAST(10000000 + o_orderkey AS VARCHAR) || '-01', 1, 8) END AS order_number
              FROM l JOIN part ON p_partkey = material_id
              WHERE channel = 2 AND sold_on >= DATE '1996-02-05' AND sold_on < DATE '1996-02-15'),
    stored AS (SELECT ticket_key, l_linenumber, material_id, sold_on, CAST(0 AS BIGINT) AS gross, CAST(NULL AS VARCHAR) AS brand,
                      CAST(NULL AS VARCHAR) AS document_type, CAST(NULL AS VARCHAR) AS folio, CAST(NULL AS VARCHAR) AS order_number
               FROM l WHERE channel = 2 AND sold_on < DATE '1996-02-12')
    SELECT * FROM stored WHERE ticket_key NOT IN (SELECT ticket_key FROM fresh) UNION ALL SELECT * FROM fresh
    """,
)
def ticket_refresh(spark, sf):
    key = F.concat(F.lit("S"), (F.col("o_custkey") % 50).cast("string"), F.lit("-"), F.col("o_orderkey").cast("string"))
    tickets = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", key.alias("ticket_key"), F.to_date("o_orderdate").alias("sold_on"), (F.col("o_custkey") % 3).alias("channel")
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_partkey").alias("material_id"), minor(F.col("l_extendedprice")).alias("gross")
    ).join(tickets.drop("o_orderpriority"), "o_orderkey")
    documents = tickets.filter("o_orderpriority <> '5-LOW'").select(
        "ticket_key", F.col("o_orderpriority").alias("document_type"), F.concat(F.lit("F"), F.col("o_orderkey").cast("string")).alias("folio")
    )
    number = F.concat((F.col("o_orderkey") + 10000000).cast("string"), F.lit("-01"))
    numbers = tickets.filter("o_orderkey % 4 <> 0").select("ticket_key", number.alias("order_number"))
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("material_id"), F.col("p_brand").alias("brand"))
    unknown = [F.lit(None).cast("string").alias(c) for c in ("brand", "document_type", "folio", "order_number")]
    known = ["ticket_key", "l_linenumber", "material_id", "sold_on"]
    stored = lines.filter((F.col("channel") == 2) & (F.col("sold_on") < F.lit(date(1996, 2, 12)))).select(*known, F.lit(0).cast("bigint").alias("gross"), *unknown)
    return sales.ticket_refresh(stored, lines.drop("o_orderkey"), brands, documents, numbers, date(1996, 2, 15))
