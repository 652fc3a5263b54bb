"""Side-table roll-ups to one row per applicant (D1-D5) and their assembly.

The mart SQL of the original workflow is not available, so the columns are
our design over the fixture tables (counts, sums, means, extremes, shares of a
status, days late, recency).

Plan shape, chosen for size:

* ``lineitem`` (the largest table) is scanned and shuffled **once**:
  ``order_facts`` left-joins it to ``orders`` on the order key and aggregates
  per order inside the join's partitioning (no second exchange); lines of an order
  that holds more of them than a partition should are joined by broadcast instead;
* one ``groupBy(customer)`` over those order rows computes every order- and
  line-based column (D1, D2, D3, D5) in a single shuffle of order rows, with
  map-side partial aggregation, so a customer holding a third of all orders
  still sends one partial row per map task;
* events are pre-aggregated per user before any join (D4);
* ``build_features`` joins the application table to those two roll-ups: two
  key joins, each one row per key (no fan-out).

Per-mart functions are projections of the same roll-ups, so a mart computed
alone equals its columns in the assembled table.

Sums are exact, so no result depends on the order rows arrive in: money is
held in integer cents and rates in basis points.  Line-level sums are plain
longs (as fast as doubles; an order's lines cannot overflow them); the
order -> customer sums run as ``decimal(38,0)`` on the four-times-smaller
order rows, so even a customer holding a third of all orders cannot
overflow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..sources.fixtures import Tables, application
from .joins import broadcast_checked, hot_keys
from .quality import replace_sentinels

# Day counts are relative to these fixed dates (our design; fixture data ends
# before them).
ORDER_REFERENCE_DATE = "2002-01-01"
EVENT_REFERENCE_DATE = "2024-01-31"
LATE_DAYS = 60

CENTS = 100          # money unit: 1/100
BASIS = 10_000       # rate unit: 1/10,000
WIDE = "decimal(38,0)"

BUREAU_COLS = ["BURO_N_ORDERS", "BURO_SUM_PRICE", "BURO_SHARE_F", "BURO_N_LINES", "BURO_SHARE_R"]
PREV_COLS = ["PREV_N_ORDERS", "PREV_AVG_PRICE", "PREV_MIN_PRICE", "PREV_MAX_PRICE",
             "PREV_SHARE_URGENT", "PREV_N_OPEN", "PREV_DAYS_FIRST_ORDER", "PREV_DAYS_LAST_ORDER"]
INST_COLS = ["INST_N_LINES", "INST_AVG_DAYS_LATE", "INST_MAX_DAYS_LATE", "INST_SHARE_LATE"]
POS_COLS = ["POS_N_EVENTS", "POS_SHARE_ERROR", "POS_AVG_VALUE", "DAYS_SINCE_EVENT",
            "POS_DAYS_SINCE_LAST_EVENT"]
CC_COLS = ["CC_AVG_DISCOUNT", "CC_MAX_DISCOUNT", "CC_AVG_TAX", "CC_SUM_REVENUE"]


def _dbl(c: F.Column) -> F.Column:
    return c.cast("double")


def _scaled(c: str, unit: int) -> F.Column:
    """A decimal amount as an exact integer count of 1/unit."""
    return F.rint(F.col(c) * F.lit(float(unit))).cast("long")


def _wide_sum(c: str) -> F.Column:
    return F.sum(F.col(c).cast(WIDE))


def _share(cond) -> F.Column:
    """Mean of a 0/1 flag as a double (literal 1e0, trap T8)."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_price_cents", "o_totalprice",
              "o_orderdate", "o_orderpriority")


def order_facts(t: Tables) -> DataFrame:
    """One row per order with its line statistics (lines may be absent).

    Orders meet their lines in one left join, and the per-order aggregate runs
    in its partitioning (all order columns are grouping keys): ``orders`` and
    ``lineitem`` are each scanned and shuffled once.

    Lines of a hot order (``joins.hot_keys``) are not shuffled at all: the few
    hot orders are broadcast to them, and partial aggregation leaves a row per
    task and hot order.
    """
    # an order without key or customer reaches no applicant
    o = t.orders.where(F.col("o_orderkey").isNotNull() & F.col("o_custkey").isNotNull()).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        _scaled("o_totalprice", CENTS).alias("o_price_cents"), "o_totalprice",
        "o_orderdate", "o_orderpriority")
    li = t.lineitem.select("l_orderkey", "l_returnflag", "l_shipdate", "l_discount",
                           "l_tax", "l_extendedprice")
    dd = F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))
    disc = _scaled("l_discount", BASIS)

    def per_order(orders: DataFrame, lines: DataFrame, how: str) -> DataFrame:
        return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), how).groupBy(*ORDER_COLS).agg(
            F.count("l_orderkey").alias("n_lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
            F.sum(dd).alias("sum_late"),
            F.max(dd).alias("max_late"),
            F.count_if(dd > LATE_DAYS).alias("n_late"),
            F.sum(disc).alias("sum_discount_bp"),
            F.max("l_discount").alias("max_discount"),
            F.sum(_scaled("l_tax", BASIS)).alias("sum_tax_bp"),
            # price in cents x (1 - discount) in basis points: units of 1e-6
            F.sum(_scaled("l_extendedprice", CENTS) * (F.lit(BASIS) - disc)).alias("sum_revenue_u"),
        )

    hot = hot_keys(li, "l_orderkey")
    if not hot:
        return per_order(o, li, "left")
    is_hot, of_hot = F.col("o_orderkey").isin(hot), F.col("l_orderkey").isin(hot)
    return (per_order(o.where(~is_hot), li.where(~of_hot), "left")
            .unionByName(per_order(broadcast_checked(o.where(is_hot)), li.where(of_hot), "inner")))


def _previous_columns() -> list[F.Column]:
    """D2 aggregates over order rows."""
    days = F.datediff(F.col("o_orderdate"), F.to_date(F.lit(ORDER_REFERENCE_DATE)))
    n_orders = F.count(F.lit(1))
    sum_price = _dbl(_wide_sum("o_price_cents")) / F.lit(float(CENTS))
    return [
        n_orders.alias("PREV_N_ORDERS"),
        (sum_price / n_orders).alias("PREV_AVG_PRICE"),
        F.min("o_totalprice").alias("PREV_MIN_PRICE"),
        F.max("o_totalprice").alias("PREV_MAX_PRICE"),
        _share(F.col("o_orderpriority") == "1-URGENT").alias("PREV_SHARE_URGENT"),
        F.count_if(F.col("o_orderstatus") == "O").alias("PREV_N_OPEN"),
        F.min(days).alias("PREV_DAYS_FIRST_ORDER"),
        F.max(days).alias("PREV_DAYS_LAST_ORDER"),
    ]


def customer_order_rollup(t: Tables, facts: DataFrame | None = None) -> DataFrame:
    """D1 + D2 + D3 + D5 in one aggregation of order rows by applicant.

    Line-based columns (INST_*, CC_*) are null for applicants whose orders
    have no line, as a separate line mart left-joined would give.
    """
    f = facts if facts is not None else order_facts(t)
    n_orders = F.count(F.lit(1))
    n_lines = F.sum("n_lines")
    has_lines = n_lines > 0
    sum_price = _dbl(_wide_sum("o_price_cents")) / F.lit(float(CENTS))
    return f.groupBy(F.col("o_custkey").alias(K.KEY)).agg(
        # D1 bureau_features: two-level roll-up, lines -> order -> applicant
        n_orders.alias("BURO_N_ORDERS"),
        sum_price.alias("BURO_SUM_PRICE"),
        _share(F.col("o_orderstatus") == "F").alias("BURO_SHARE_F"),
        n_lines.alias("BURO_N_LINES"),
        F.try_divide(_dbl(F.sum("n_returned")), n_lines).alias("BURO_SHARE_R"),
        # D2 previous_app_features: orders by applicant
        *_previous_columns(),
        # D3 installments_features: days between order and shipment, per line
        F.when(has_lines, n_lines).alias("INST_N_LINES"),
        F.try_divide(_dbl(F.sum("sum_late")), n_lines).alias("INST_AVG_DAYS_LATE"),
        F.max("max_late").alias("INST_MAX_DAYS_LATE"),
        F.try_divide(_dbl(F.sum("n_late")), n_lines).alias("INST_SHARE_LATE"),
        # D5 credit_card_features: discount, tax and revenue of the lines
        (F.try_divide(_dbl(_wide_sum("sum_discount_bp")), n_lines) / F.lit(float(BASIS)))
        .alias("CC_AVG_DISCOUNT"),
        F.max("max_discount").alias("CC_MAX_DISCOUNT"),
        (F.try_divide(_dbl(_wide_sum("sum_tax_bp")), n_lines) / F.lit(float(BASIS)))
        .alias("CC_AVG_TAX"),
        (_dbl(_wide_sum("sum_revenue_u")) / F.lit(float(CENTS * BASIS))).alias("CC_SUM_REVENUE"),
    )


def event_rollup(t: Tables) -> DataFrame:
    """Events pre-aggregated per user (sparse: only users with events)."""
    since = F.datediff(F.to_date(F.lit(EVENT_REFERENCE_DATE)), F.col("ts"))
    return t.events.groupBy(F.col("user_id").alias(K.KEY)).agg(
        F.count(F.lit(1)).alias("__ev_n"),
        F.count_if(F.col("event_type") == "error").alias("__ev_error"),
        F.sum(_scaled("value", CENTS)).alias("__ev_value_cents"),
        F.max(since).alias("__ev_max_since"),
        F.min(since).alias("__ev_min_since"),
    )


def _pos_columns() -> list[F.Column]:
    """D4 columns after the left join; no event gives the sentinel."""
    n = F.col("__ev_n")
    return [
        F.coalesce(n, F.lit(0)).cast("long").alias("POS_N_EVENTS"),
        F.try_divide(_dbl(F.col("__ev_error")), n).alias("POS_SHARE_ERROR"),
        (F.try_divide(_dbl(F.col("__ev_value_cents")), n) / F.lit(float(CENTS))).alias("POS_AVG_VALUE"),
        F.coalesce(F.col("__ev_max_since"), F.lit(K.SENTINEL_VALUE)).alias("DAYS_SINCE_EVENT"),
        F.coalesce(F.col("__ev_min_since"), F.lit(K.SENTINEL_VALUE)).alias("POS_DAYS_SINCE_LAST_EVENT"),
    ]


def bureau_features(t: Tables) -> DataFrame:
    """Two-level roll-up, lines -> order -> applicant."""
    return customer_order_rollup(t).select(K.KEY, *BUREAU_COLS)


def previous_app_features(t: Tables) -> DataFrame:
    """Roll-up of orders by applicant; lines are not read."""
    o = t.orders.where(F.col("o_orderkey").isNotNull() & F.col("o_custkey").isNotNull()).select(
        "o_custkey", _scaled("o_totalprice", CENTS).alias("o_price_cents"), "o_totalprice",
        "o_orderstatus", "o_orderpriority", "o_orderdate")
    return o.groupBy(F.col("o_custkey").alias(K.KEY)).agg(*_previous_columns())


def installments_features(t: Tables) -> DataFrame:
    """D3: applicants without any line get no row (null after the left join)."""
    return customer_order_rollup(t).where(F.col("INST_N_LINES").isNotNull()).select(K.KEY, *INST_COLS)


def pos_cash_features(t: Tables) -> DataFrame:
    """Every applicant; one without events gets the sentinel."""
    keys = t.customer.select(F.col("c_custkey").alias(K.KEY))
    return keys.join(event_rollup(t), K.KEY, "left").select(K.KEY, *_pos_columns())


def credit_card_features(t: Tables) -> DataFrame:
    """Applicants with at least one line."""
    return customer_order_rollup(t).where(F.col("INST_N_LINES").isNotNull()).select(K.KEY, *CC_COLS)


# Named roll-ups in order (table name -> builder).
def feature_queries(t: Tables) -> dict[str, Callable[[], DataFrame]]:
    return {
        "bureau_features": lambda: bureau_features(t),
        "previous_app_features": lambda: previous_app_features(t),
        "installments_features": lambda: installments_features(t),
        "pos_cash_features": lambda: pos_cash_features(t),
        "credit_card_features": lambda: credit_card_features(t),
    }


def build_features(t: Tables, replace_sentinel: bool = True) -> DataFrame:
    """C1 + B4: application table left-joined to the roll-ups.

    Both roll-ups have one row per key, so the application table's row count
    is kept.  The sentinel is replaced at the end (after the marts), as the
    original workflow does; raw tables carry no ``DAYS_`` columns here.
    """
    app = application(t)
    orders = customer_order_rollup(t)
    events = event_rollup(t)
    j = app.join(orders, K.KEY, "left").join(events, K.KEY, "left")
    out = j.select(*app.columns, *BUREAU_COLS, *PREV_COLS, *INST_COLS, *_pos_columns(), *CC_COLS)
    return replace_sentinels(out) if replace_sentinel else out
