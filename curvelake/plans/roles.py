"""The given tables in the roles the operators expect.

Orders are weekly history (customer as player, segment as position, order priority
as team), events are quotes (event type as source, user as player), order lines
are resting book levels, parts and suppliers are names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvelake.operators import books, history, quotes
from curvelake.operators.calibrate import window_rows
from curvelake.operators.consensus import keep_first
from curvelake.operators.power_fit import READS, rolling_calibration
from curvelake.rules import (
    AggregationRules, CalibrationRules, HistoryRules, MeanRules, NameRules, PowerFitRules, PricingRules, ScoringRules,
    SourceRules,
)
from curvelake.session import cut, stage

STATS = ("quantity", "line_count", "returned_quantity")
RUN_ID, SEASON = "run", "2024"

HISTORY = HistoryRules(
    stats=STATS,
    opportunity_by_stat={"quantity": "order_count", "line_count": "order_count", "returned_quantity": "shipped_lines"},
    minimum_opportunity={"order_count": 1.0, "shipped_lines": 3.0}, signed_stats=frozenset(),
    plausible_maximum={"quantity": 5000.0, "line_count": 500.0, "returned_quantity": 5000.0},
    schedule=((1990, 16), (1998, 17)), ingest_start_season=1995, calibration_start_season=1997,
    latest_completed_season=2000, holdout_seasons=1, minimum_player_seasons_per_stat=20,
    power_fit=PowerFitRules(minimum_seasons=2, minimum_validation_seasons=1, exponent_bounds=(0.02, 3.0)))
HEADERS = {c: (c,) for c in (history.ENTITY, "player_name", "team", "position", *HISTORY.opportunities, *STATS)}
CALIBRATION = CalibrationRules(
    dispersion_bounds={s: (0.05, 1000.0) for s in STATS}, sensitivity_start_seasons=(1997, 1998, 1999))

# ``click`` and ``view`` are two-sided books; the others quote thresholds.
SOURCES = {
    "click": SourceRules("book", True, 1.0), "view": SourceRules("book", True, 2.0),
    "purchase": SourceRules("contract", True, 1.0), "signup": SourceRules("contract", True, 0.0),
    "error": SourceRules("contract", False, 5.0),
}
PRICING, NAMES, AGGREGATION = PricingRules(), NameRules(), AggregationRules(max_absolute_disagreement=10.0)
MEANS = MeanRules(
    mean_bounds={s: (0.01, 5000.0) for s in STATS}, dispersion_bounds={s: (0.05, 1000.0) for s in STATS})
SCORING = ScoringRules(
    weights={"quantity": 0.1, "line_count": 6.0, "cancelled_quantity": -2.0}, bonus_component="returned_quantity",
    required_profiles={"volume": ("quantity", "line_count"), "returns": ("line_count", "returned_quantity")})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- history --------------------------------------------------------------------------

def weekly_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order in the ingested years; the date range reaches the scan."""
    first, last = HISTORY.ingest_start_season, HISTORY.latest_completed_season
    orders = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderdate") >= F.lit(f"{first}-01-01").cast("timestamp"))
        & (F.col("o_orderdate") < F.lit(f"{last + 1}-01-01").cast("timestamp")))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    quantity = F.col("l_quantity")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(quantity).alias("quantity"), F.count("*").cast("double").alias("lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", quantity).otherwise(0.0)).alias("returned"))
    zero = F.lit(0.0)
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        customers, F.col("o_custkey") == F.col("c_custkey")).select(
            F.year("o_orderdate").alias("season"), F.weekofyear("o_orderdate").alias("week"),
            F.when(F.col("o_orderstatus") == "P", "POST").otherwise("REG").alias("season_type"),
            F.col("o_custkey").cast("string").alias(history.ENTITY), F.col("c_name").alias("player_name"),
            F.col("o_orderpriority").alias("team"), F.col("c_mktsegment").alias("position"),
            F.lit(1.0).alias("order_count"), F.coalesce("lines", zero).alias("shipped_lines"),
            F.coalesce("quantity", zero).alias("quantity"), F.coalesce("lines", zero).alias("line_count"),
            F.coalesce("returned", zero).alias("returned_quantity"), F.col("o_orderkey").alias("source_order"))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.canonical_weekly(weekly_raw(spark, sf_dir), HISTORY, HEADERS, order="source_order")


@stage
def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.season_totals(history.merge_weeks(weekly(spark, sf_dir), HISTORY), HISTORY)


@stage
def raw_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.backtest_predictions(seasons(spark, sf_dir), HISTORY)


@stage
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_calibration(raw_predictions(spark, sf_dir), HISTORY)


def predictions_for(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """The calibrated predictions of all rows with some of their columns, for gates: the others are neither made nor written."""
    raw = history.backtest_predictions(seasons(spark, sf_dir), HISTORY)
    raw = cut(raw.select(*[c for c in raw.columns if c in {*READS, *columns}]))
    return cut(rolling_calibration(raw, HISTORY).select(*columns))


@stage
def calibration_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_rows(predictions(spark, sf_dir), HISTORY)


# --- quotes ---------------------------------------------------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their statistic, read from the JSON properties."""
    k = F.from_json("props", "k int")["k"]
    stat = F.element_at(F.array(*[F.lit(s) for s in STATS]), F.pmod(F.col("k"), F.lit(len(STATS))) + 1)
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", k.alias("k")).withColumn("stat", stat)


def over_odds(i: Column) -> Column:
    return F.when(i % 2 == 0, -105 - i % 37).otherwise(100 + i % 29).cast("int")


def under_odds(i: Column) -> Column:
    return F.when(i % 2 == 0, -105 - i % 11).otherwise(-135 - i % 53).cast("int")


def current_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per source, user and statistic (and threshold, for contracts)."""
    books_ = quotes.names_of(SOURCES, "book")
    line = F.floor("value").cast("double")
    threshold = F.when(~F.col("event_type").isin(books_), line + 1.0)
    keyed = events(spark, sf_dir).withColumns({"line": line + 0.5, "threshold": threshold})
    newest = keep_first(keyed.withColumn("age", -F.unix_micros("ts")), ["event_type", "user_id", "stat", "threshold"], ["age", "event_id"])
    return newest.drop("age")


def _snapshots(rows: DataFrame) -> DataFrame:
    """Every source's newest quote time. One row per configured source."""
    return rows.groupBy("event_type").agg(F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("snapshot_utc"))


def _player(rows: DataFrame) -> list[Column]:
    name = F.concat(F.lit("User #"), F.col("user_id").cast("string"))
    return [F.lit(SEASON).alias("season"), name.alias("player"), F.concat(F.lit("T"), F.col("user_id") % 7).alias("team"),
            F.lit(None).cast("string").alias("team_abbreviation"), F.col("stat"), F.lit("units").alias("threshold_unit")]


def book_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sided markets in the nested snapshot form."""
    rows = current_quotes(spark, sf_dir)
    i = F.col("event_id")

    def side(name: str, odds: Column) -> Column:
        decimal = F.when(odds > 0, 1.0 + odds / 100.0).otherwise(1.0 + 100.0 / -odds)
        return F.struct(F.concat(F.lit(name + "-"), i.cast("string")).alias("selection_id"),
                        F.concat(F.lit(name.title() + " "), F.col("line").cast("string")).alias("label"),
                        odds.alias("american_odds"), F.round(decimal, 12).alias("decimal_odds"))

    market = F.struct(
        i.cast("string").alias("market_id"), *_player(rows), F.col("line").alias("market_line"),
        F.struct(F.lit(">").alias("over"), F.lit("<").alias("under")).alias("threshold_operators"),
        F.struct(side("over", over_odds(i)).alias("over"), side("under", under_odds(i)).alias("under")).alias("probability"),
        F.struct(F.lit(None).cast("string").alias("sportsbook_page")).alias("source_urls"))
    chosen = rows.filter(F.col("event_type").isin(quotes.names_of(SOURCES, "book")))
    return chosen.join(_snapshots(rows), "event_type").select(
        F.col("event_type").alias("source"), "snapshot_utc", i.alias("market_index"), market.alias("market"))


def contract_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold contracts in the nested snapshot form, priced by a logistic curve per user."""
    rows = current_quotes(spark, sf_dir)
    i, k = F.col("event_id"), F.col("threshold")
    centre = 20.0 + 4 * (F.col("user_id") % 20)
    mid = F.round(100.0 / (1.0 + F.exp((k - centre) / (1.0 + centre / 4.0))))
    half = 1.0 + i % 12
    bid = F.when(i % 17 != 0, mid - half)
    ask = mid + half
    market = F.struct(
        i.cast("string").alias("ticker"), *_player(rows), F.lit(">=").alias("threshold_operator"), k.alias("threshold"),
        F.struct(bid.alias("yes_bid_percent"), ask.alias("yes_ask_percent"),
                 F.when(i % 3 == 0, mid).alias("last_trade_percent")).alias("probability"),
        F.struct((F.col("k") * 7).cast("double").alias("volume_contracts"),
                 (i % 500).cast("double").alias("open_interest_contracts")).alias("trading_activity"),
        F.struct(((ask - bid) / 100.0).alias("yes_spread_dollars")).alias("orderbook"),
        F.struct(F.lit(None).cast("string").alias("market_api")).alias("source_urls"))
    chosen = rows.filter(F.col("event_type").isin(quotes.names_of(SOURCES, "contract")))
    return chosen.join(_snapshots(rows), "event_type").select(
        F.col("event_type").alias("source"), "snapshot_utc", i.alias("market_index"), market.alias("market"))


@stage
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.normalize([
        quotes.normalize_books(book_markets(spark, sf_dir), RUN_ID),
        quotes.normalize_contracts(contract_markets(spark, sf_dir), RUN_ID)])


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.price_quotes(normalized(spark, sf_dir), SOURCES, PRICING)


@stage
def model_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced quotes with an identity (the user) and their model eligibility."""
    rows = quotes.annotate_eligibility(priced(spark, sf_dir), MEANS)
    return rows.withColumns({
        "canonical_player_id": F.concat(F.lit("user:"), F.substring("raw_player_name", 7, 20)),
        "canonical_player_name": F.col("raw_player_name"), "canonical_position": F.col("team")})


@stage
def dispersions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A historical dispersion per statistic, derived from the spread of quoted values.

    The moment estimate ``mean**2 / (variance - mean)`` with a band of one log unit.
    """
    k = F.floor("value").cast("double")
    moments = events(spark, sf_dir).groupBy("stat").agg(F.avg(k).alias("m"), F.var_samp(k).alias("v"))
    r = F.round(F.col("m") * F.col("m") / (F.col("v") - F.col("m")), 3)
    return moments.select(
        "stat", F.lit("negative_binomial").alias("distribution_family"), F.lit("moments").alias("calibration_version"),
        F.lit("passed").alias("status"), r.alias("historical_dispersion"), F.log(r).alias("historical_log_dispersion"),
        F.exp(F.log(r) - 0.5).alias("historical_dispersion_lower"), F.exp(F.log(r) + 0.5).alias("historical_dispersion_upper"),
        (F.log(r) - 0.5).alias("historical_log_dispersion_lower"), (F.log(r) + 0.5).alias("historical_log_dispersion_upper"))


#: Dispersions of the past for the curves below: near to what they follow, far from it, and near again.
PAST_DISPERSIONS = {"quantity": 1.15, "line_count": 60.0, "returned_quantity": 1.3}
#: Half the band of their logarithms.
PRIOR_BAND = 0.3


@stage
def curve_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four thresholds of every user's statistic, priced by a count with a shared dispersion of one.

    Some curves of the first statistic have one price far off; those of the last statistic are off everywhere, up and down in turn.
    """
    u, j = F.col("user_id"), F.col("j")
    place = F.array_position(F.array(*[F.lit(s) for s in STATS]), F.col("stat")) - 1
    rows = events(spark, sf_dir).select("user_id", "stat").distinct().withColumn("s", place).select("*", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("j"))
    k, mean = 2 + 4 * j + u % 3, 4.0 + F.pmod(u * 7 + F.col("s") * 3, F.lit(10))
    p = F.pow(mean / (mean + 1.0), k)
    off = F.when((F.col("s") == 0) & (u % 7 == 3) & (j == 2), 1.6).when(F.col("s") == 2, F.when((u + j) % 2 == 0, 0.9).otherwise(-0.9)).otherwise(0.0)
    priced = rows.withColumns({"k": k, "p": F.round(1.0 / (1.0 + F.exp(-(F.log(p / (1.0 - p)) + off))), 4)})
    inside = F.col("p").between(MEANS.probability_floor, MEANS.probability_ceiling)
    return priced.select(
        F.lit(RUN_ID).alias("run_id"), F.lit(SEASON).alias("season"), F.concat(F.lit("user:"), u.cast("string")).alias("canonical_player_id"), "stat",
        F.when(j % 2 == 0, "purchase").otherwise("signup").alias("source"), F.col("k").cast("int").alias("canonical_threshold"), F.col("p").alias("modeling_probability"),
        F.when(inside, "included").otherwise("excluded").alias("model_inclusion_status"))


def past_dispersions(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(PAST_DISPERSIONS.items()), "stat string, historical_dispersion double")
    log = F.log("historical_dispersion")
    return rows.select(
        "stat", F.lit("negative_binomial").alias("distribution_family"), F.lit("listed").alias("calibration_version"), F.lit("passed").alias("status"), "historical_dispersion",
        log.alias("historical_log_dispersion"), F.exp(log - PRIOR_BAND).alias("historical_dispersion_lower"), F.exp(log + PRIOR_BAND).alias("historical_dispersion_upper"),
        (log - PRIOR_BAND).alias("historical_log_dispersion_lower"), (log + PRIOR_BAND).alias("historical_log_dispersion_upper"))


# --- books ----------------------------------------------------------------------------

def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resting levels per order: discounts as price offsets, quantities as contracts."""
    discount = F.col("l_discount").cast("decimal(18,4)")
    yes = F.col("l_returnflag") != "N"
    base = F.when(yes, F.lit("0.3")).otherwise(F.lit("0.5")).cast("decimal(18,4)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("market_id"), F.when(yes, "yes").otherwise("no").alias("side"),
        (base + discount).cast("decimal(18,4)").alias("price"), F.col("l_quantity").cast("decimal(18,4)").alias("quantity"))


def combined_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books.combine_levels(levels(spark, sf_dir))
