"""Order-book levels: summaries, depth bands and executable-size quotes.

``levels`` has ``market_id, side ('yes'|'no'), price, quantity`` with decimal
prices strictly between 0 and 1. Levels of equal price are combined first, so a
book holds at most one row per price tick however many orders rest on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.session import dealt

# Depth bands in cents, and executable sizes in contracts.
DEPTH_BANDS = (1, 5, 10, 25)
EXECUTION_SIZES = (1, 10, 100, 500, 1000)
# Resting orders that one task holds, on average.
ORDERS_PER_TASK = 500_000


def combine_levels(levels: DataFrame) -> DataFrame:
    """One row per market, side and price; a market's rows lie in one task from here on, and tasks hold some ``ORDERS_PER_TASK`` orders."""
    return dealt(levels, ORDERS_PER_TASK, "market_id").groupBy("market_id", "side", "price").agg(
        F.sum("quantity").alias("quantity"), F.count("*").alias("level_count"))


def book_summary(combined: DataFrame) -> DataFrame:
    """Totals of both sides, best quotes, spread and midpoint, one row per market."""
    yes, no = F.col("side") == "yes", F.col("side") == "no"
    notional = F.col("price") * F.col("quantity")
    best = F.struct("price", "quantity")
    summary = combined.groupBy("market_id").agg(
        *[column for side, here in (("yes", yes), ("no", no)) for column in (
            F.coalesce(F.sum(F.when(here, F.col("level_count"))), F.lit(0)).alias(f"{side}_level_count"),
            F.coalesce(F.sum(F.when(here, F.col("quantity"))), F.lit(0)).alias(f"{side}_contracts"),
            F.coalesce(F.sum(F.when(here, notional)), F.lit(0)).alias(f"{side}_bid_notional_dollars"),
            F.max(F.when(here, best)).alias(f"_{side}"))])
    bid, ask = F.col("_yes.price"), F.lit(1).cast("decimal(18,4)") - F.col("_no.price")
    return summary.select(
        "market_id", bid.alias("best_yes_bid_dollars"), ask.alias("best_yes_ask_dollars"),
        ((bid + ask) / 2).alias("yes_midpoint_dollars"), (ask - bid).alias("yes_spread_dollars"),
        F.col("_yes.quantity").alias("best_yes_bid_size_contracts"), F.col("_no.quantity").alias("best_yes_ask_size_contracts"),
        "yes_level_count", "no_level_count", "yes_contracts", "no_contracts", "yes_bid_notional_dollars",
        "no_bid_notional_dollars", (F.col("yes_contracts") + F.col("no_contracts")).alias("total_resting_contracts"),
        (F.col("yes_bid_notional_dollars") + F.col("no_bid_notional_dollars")).alias("total_resting_bid_notional_dollars"))


def quote_ladder(combined: DataFrame) -> DataFrame:
    """Both sides as seen by a ``yes`` trader: bids as they are, asks as one minus the opposite bid."""
    bid = F.col("side") == "yes"
    price = F.when(bid, F.col("price")).otherwise(F.lit(1).cast("decimal(18,4)") - F.col("price"))
    return combined.select("market_id", F.when(bid, "bid").otherwise("ask").alias("book_side"),
                           price.cast("decimal(18,4)").alias("price"), "quantity")


def band_depth(combined: DataFrame) -> DataFrame:
    """Contracts and notional within each band of the best price, per market and book side."""
    ladder = quote_ladder(combined)
    key = ["market_id", "book_side"]
    # One row per price tick, so a window holds at most one book's ticks.
    mine = Window.partitionBy(*key)
    bid = F.col("book_side") == "bid"
    away = F.when(bid, F.col("_high") - F.col("price")).otherwise(F.col("price") - F.col("_low"))
    near = ladder.filter(F.col("market_id").isNotNull()).withColumns({
        "_high": F.max("price").over(mine), "_low": F.min("price").over(mine)}).withColumn("away", away)

    def inside(cents: int, value: Column) -> Column:
        band = F.lit(cents).cast("decimal(18,4)") / 100
        return F.coalesce(F.sum(F.when(F.col("away") <= band, value)), F.lit(0))

    return near.groupBy(*key).agg(*[column for cents in DEPTH_BANDS for column in (
        inside(cents, F.col("quantity")).alias(f"within_{cents}c_contracts"),
        inside(cents, F.col("price") * F.col("quantity")).alias(f"within_{cents}c_notional"))])


def execution_quotes(combined: DataFrame) -> DataFrame:
    """Fill of each requested size against the ladder, best price first.

    Buying walks the asks upwards, selling walks the bids downwards.
    """
    ladder = quote_ladder(combined).withColumn(
        "_rank", F.when(F.col("book_side") == "bid", -F.col("price")).otherwise(F.col("price")))
    key = ["market_id", "book_side"]
    # One row per price tick, so a window holds at most one book's ticks.
    ahead = Window.partitionBy(*key).orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    walked = ladder.withColumn("_ahead", F.coalesce(F.sum("quantity").over(ahead), F.lit(0)))
    sized = walked.withColumn("requested_contracts", F.explode(F.array(*[F.lit(s) for s in EXECUTION_SIZES])))
    take = F.greatest(F.lit(0), F.least(F.col("quantity"), F.col("requested_contracts") - F.col("_ahead")))
    taken = sized.withColumn("take", take)
    filled = taken.groupBy(*key, "requested_contracts").agg(
        F.sum("take").alias("fillable_contracts"), F.sum(F.col("take") * F.col("price")).alias("consideration_dollars"),
        F.max(F.when(F.col("take") > 0, F.struct("_rank", "price"))).alias("_worst"))
    return filled.select(
        "market_id", F.when(F.col("book_side") == "ask", "buy_yes").otherwise("sell_yes").alias("action"),
        "requested_contracts", "fillable_contracts",
        (F.col("fillable_contracts") >= F.col("requested_contracts")).alias("fully_fillable"),
        F.try_divide(F.col("consideration_dollars").cast("double"), F.col("fillable_contracts").cast("double")).alias("vwap_dollars"),
        F.col("_worst.price").alias("worst_price_dollars"), "consideration_dollars")
