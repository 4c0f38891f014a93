"""Weekly history to season totals, exact lags, cohorts and leakage-free baselines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.functions import numeric as N
from curvelake.rules import OPTIONAL_HEADERS, WEEKLY_HEADERS, HistoryRules

ENTITY = "gsis_player_id"
DESCRIPTORS = ("player_name", "position")
WEEK_GRAIN = ("season", "week", ENTITY, "team")
LAGS_PUBLISHED = 3


def resolve_columns(df: DataFrame, headers: Mapping[str, Sequence[str]], required: bool = True) -> dict[str, str]:
    """Canonical name to the first accepted header that the input carries."""
    found = {}
    for canonical, accepted in headers.items():
        name = next((h for h in accepted if h in df.columns), None)
        if name is not None:
            found[canonical] = name
        elif required:
            raise ValueError(f"input lacks {canonical}; accepted names: {', '.join(accepted)}")
    return found


def schedule_length(season: Column, rules: HistoryRules) -> Column:
    """Scheduled games of a season; NULL before the first known season."""
    value = F.lit(None).cast("int")
    for first, games in rules.schedule:
        value = F.when(season >= first, F.lit(games)).otherwise(value)
    return value


def canonical_weekly(
    raw: DataFrame, rules: HistoryRules, headers: Mapping[str, Sequence[str]] = WEEKLY_HEADERS,
    order: str | None = None,
) -> DataFrame:
    """Rename, coerce and filter weekly rows; ``source_order`` keeps the input order of duplicates."""
    for name in ("season", "season_type", "week"):
        if name not in raw.columns:
            raise ValueError(f"input lacks {name}")
    names = resolve_columns(raw, headers)
    extra = resolve_columns(raw, OPTIONAL_HEADERS, required=False)
    numbers = (*rules.opportunities, *rules.stats)
    picked = [
        N.safe_double(F.col("season")).cast("int").alias("season"),
        F.col("season_type").cast("string").alias("season_type"),
        N.safe_double(F.col("week")).cast("int").alias("week"),
        N.clean_text(F.col(names[ENTITY])).alias(ENTITY),
        *[N.clean_text(F.col(names[c])).alias(c) for c in ("player_name", "team", "position")],
        *[N.safe_double(F.col(names[c])).alias(c) for c in dict.fromkeys(numbers)],
        *[N.safe_double(F.col(extra[c])).alias(c) if c in extra else F.lit(None).cast("double").alias(c)
          for c in OPTIONAL_HEADERS],
        (F.col(order) if order else F.monotonically_increasing_id()).alias("source_order"),
    ]
    return raw.select(*picked).filter(
        (F.col("season_type") == rules.season_type)
        & F.col("season").between(rules.ingest_start_season, rules.latest_completed_season))


def merge_weeks(weekly: DataFrame, rules: HistoryRules) -> DataFrame:
    """One row per player-week-team: complementary rows are summed, the last descriptors kept.

    ``exact_duplicate`` and ``conflicting`` mark the groups that a gate must reject.
    """
    numbers = tuple(dict.fromkeys((*rules.opportunities, *rules.stats)))
    described = (*DESCRIPTORS, *OPTIONAL_HEADERS)
    whole = F.struct(*[c for c in weekly.columns if c != "source_order"])
    conflict = [F.min(c) != F.max(c) for c in DESCRIPTORS]
    return weekly.groupBy(*WEEK_GRAIN).agg(
        *[F.sum(c).alias(c) for c in numbers],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("source_order"))).alias(c) for c in described],
        F.count("*").alias("merged_rows"),
        ((F.count("*") > 1) & (F.min(whole) == F.max(whole))).alias("exact_duplicate"),
        F.coalesce(conflict[0] | conflict[1], conflict[0], conflict[1], F.lit(False)).alias("conflicting"),
    )


def season_totals(weekly: DataFrame, rules: HistoryRules) -> DataFrame:
    """Season totals per player. A group holds at most one row per week and team."""
    numbers = tuple(dict.fromkeys((*rules.opportunities, *rules.stats)))
    when = F.struct("week", "team")
    seen = F.array_sort(F.collect_list(F.when(F.col("team").isNotNull(), when)))
    grouped = weekly.groupBy("season", ENTITY).agg(
        *[F.sum(c).alias(c) for c in numbers],
        F.size(F.collect_set("week")).alias("games"),
        F.count("*").alias("source_week_rows"),
        N.pipe_join(F.array_distinct(F.transform(seen, lambda s: s["team"]))).alias("team"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in (*DESCRIPTORS, *OPTIONAL_HEADERS)],
    )
    return grouped.withColumn("team", F.nullif("team", F.lit(""))).withColumn(
        "schedule_games", schedule_length(F.col("season"), rules))


def _by_stat(rules: HistoryRules, fields) -> Column:
    """Explode helper: one struct per statistic."""
    return F.inline(F.array(*[F.struct(*fields(stat, rules.opportunity_by_stat[stat])) for stat in rules.stats]))


def long_totals(seasons: DataFrame, rules: HistoryRules) -> DataFrame:
    """One row per player-season-statistic with rates per reference season and per game."""
    per = F.lit(float(rules.reference_games)) / F.col("schedule_games")
    shared = ["season", ENTITY, "player_name", "team", "position", "games", "schedule_games",
              "source_week_rows", *rules.opportunities, *OPTIONAL_HEADERS]
    long = seasons.select(*shared, _by_stat(rules, lambda stat, opportunity: (
        F.lit(stat).alias("stat"), F.col(stat).alias("stat_total"),
        F.lit(opportunity).alias("opportunity_name"), F.col(opportunity).alias("opportunity"))))
    suffix = f"per_{rules.reference_games}"
    return long.select(
        "*", *[(F.col(o) * per).alias(f"{o}_{suffix}") for o in rules.opportunities],
        (F.col("stat_total") * per).alias(f"stat_total_{suffix}"),
        F.try_divide("stat_total", "games").alias("stat_per_game"),
        (F.col("opportunity") * per).alias(f"opportunity_{suffix}"))


def unreconciled_weeks(weekly: DataFrame, seasons: DataFrame, rules: HistoryRules) -> DataFrame:
    """Totals that differ between sum-then-unpivot and unpivot-then-sum."""
    keys = ["season", ENTITY, "stat"]
    independent = weekly.unpivot(["season", ENTITY], list(rules.stats), "stat", "value").groupBy(*keys).agg(
        F.sum("value").alias("weekly_total"))
    published = seasons.unpivot(["season", ENTITY], list(rules.stats), "stat", "season_total")
    differs = ~(F.abs(F.col("weekly_total") - F.col("season_total")) <= 1e-9)
    one_sided = F.col("weekly_total").isNull() != F.col("season_total").isNull()
    return independent.join(published, keys, "full_outer").filter(differs | one_sided)


def unreconciled_summaries(
    raw: DataFrame, seasons: DataFrame, rules: HistoryRules, entity: str, summaries: Mapping[str, str],
) -> DataFrame:
    """Independent season summaries (statistic to its raw column) that conflict or disagree with the totals."""
    given = raw.select(F.col("season").cast("int").alias("season"), F.col(entity).cast("string").alias(ENTITY), F.inline(
        F.array(*[F.struct(F.lit(stat).alias("stat"), N.safe_double(F.col(c)).alias("value"))
                  for stat, c in summaries.items()])))
    claimed = given.groupBy("season", ENTITY, "stat").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    totals = seasons.unpivot(["season", ENTITY], list(summaries), "stat", "season_total")
    off = F.abs(F.col("high") - F.col("season_total")) > 1e-9
    return claimed.join(totals, ["season", ENTITY, "stat"]).withColumn(
        "conflicting", F.col("low") != F.col("high")).filter(F.col("conflicting") | off)


def summary_columns(raw: DataFrame, rules: HistoryRules, headers=WEEKLY_HEADERS) -> dict[str, str]:
    """Season-summary columns that the input happens to carry, by statistic."""
    names, found = resolve_columns(raw, headers), {}
    for stat in rules.stats:
        candidates = (f"season_{names[stat]}", f"{names[stat]}_season", f"{stat}_season_total")
        column = next((c for c in candidates if c in raw.columns), None)
        if column:
            found[stat] = column
    return found


def with_lags(seasons: DataFrame, rules: HistoryRules) -> DataFrame:
    """Attach ``lag_1`` ... as structs: the row exactly that many seasons earlier, NULL over a gap.

    One shuffle on the player; a player has one row per season, so windows stay small.
    """
    carried = F.struct("season", "games", "schedule_games", "position", *OPTIONAL_HEADERS,
                       *dict.fromkeys((*rules.stats, *rules.opportunities)))
    timeline = Window.partitionBy(ENTITY).orderBy("season")
    lags = max(rules.prior_seasons, LAGS_PUBLISHED)
    return seasons.select("*", *[
        F.max(carried).over(timeline.rangeBetween(-i, -i)).alias(f"lag_{i}") for i in range(1, lags + 1)])


def cohort_means(seasons: DataFrame, rules: HistoryRules) -> DataFrame:
    """Recency-weighted mean per (target season, position, statistic) over the trailing seasons.

    Members of a season share one weight, so rows are first reduced to one line per
    season and position; only that small table is spread over the target seasons.
    """
    per = F.lit(float(rules.reference_games)) / F.col("schedule_games")

    def qualifies(stat):
        opportunity = rules.opportunity_by_stat[stat]
        return F.col(opportunity) >= rules.minimum_opportunity[opportunity]

    reduced = seasons.withColumn("position", N.clean_text(F.col("position"))).filter(
        F.col("position").isNotNull()).groupBy("season", "position").agg(*[
            F.struct(F.sum(F.when(qualifies(stat), F.col(stat) * per)).alias("total"),
                     F.count_if(qualifies(stat) & F.col(stat).isNotNull()).alias("members")).alias(stat)
            for stat in rules.stats])
    spread = reduced.select(
        "season", "position",
        F.inline(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(f"{s}.total"), F.col(f"{s}.members"))
                           for s in rules.stats])),
    ).filter("members > 0").withColumn("target_season", F.explode(F.filter(
        F.sequence(F.col("season") + 1, F.col("season") + rules.prior_seasons),
        lambda t: t.between(rules.calibration_start_season, rules.latest_completed_season))))
    weight = N.half_life_weight(F.col("target_season") - F.col("season") - 1, rules.recency_half_life_seasons)
    return spread.groupBy("target_season", "position", "stat").agg(
        (F.sum(weight * F.col("total")) / F.sum(weight * F.col("members"))).alias("cohort_component_per_17"),
        F.sum("members").alias("cohort_player_seasons"),
        F.array_sort(F.collect_set("season")).alias("cohort_seasons"))


def backtest_predictions(seasons: DataFrame, rules: HistoryRules) -> DataFrame:
    """Baseline per target season, player and statistic from lagged seasons and cohorts only."""
    lags, published = range(1, rules.prior_seasons + 1), range(1, LAGS_PUBLISHED + 1)
    start, latest = rules.calibration_start_season, rules.latest_completed_season
    per = float(rules.reference_games)
    targets = with_lags(seasons, rules).filter(F.col("season").between(start, latest))
    used = [F.col(f"lag_{i}") for i in lags]
    cohort_position = F.coalesce(*[N.clean_text(lag["position"]) for lag in used])

    def fields(stat, opportunity):
        return (
            F.lit(stat).alias("stat"), F.col(stat).alias("realized_total"),
            F.col(opportunity).alias("realized_target_opportunity"),
            F.lit(opportunity).alias("prior_opportunity_name"),
            F.lit(float(rules.minimum_opportunity[opportunity])).alias("prior_opportunity_minimum"),
            *[F.col(f"lag_{i}.{stat}").alias(f"lag_{i}_total") for i in published],
            *[F.col(f"lag_{i}.{opportunity}").alias(f"lag_{i}_opportunity") for i in published],
            F.array(*[lag[stat] * per / lag["schedule_games"] for lag in used]).alias("_values"),
        )

    long = targets.select(
        F.col("season").alias("target_season"), ENTITY, "player_name", "team", "position",
        F.col("games").alias("target_games"), F.col("schedule_games").alias("target_schedule_games"),
        *[F.col(f"lag_{i}.{c}").alias(f"lag_{i}_{c}") for i in published
          for c in ("season", "games", "schedule_games", "position", *OPTIONAL_HEADERS)],
        cohort_position.alias("_cohort_position"),
        F.array_compact(F.array(*[lag["season"] for lag in used])).alias("_seasons"),
        _by_stat(rules, fields))

    rates = [(f"lag_{i}_{name}", F.try_divide(F.col(f"lag_{i}_{top}") * scale, F.col(f"lag_{i}_{bottom}")))
             for i in published
             for name, top, scale, bottom in (
                 ("total_per_17", "total", per, "schedule_games"), ("per_game", "total", 1.0, "games"),
                 ("opportunity_per_17", "opportunity", per, "schedule_games"))]
    long = long.select("*", *[c.alias(name) for name, c in rates])

    cohorts = cohort_means(seasons, rules).withColumnRenamed("position", "_cohort_position")
    joined = long.join(cohorts, ["target_season", "_cohort_position", "stat"], "left")

    weights = F.array(*[F.lit(0.5 ** ((i - 1) / rules.recency_half_life_seasons)) for i in lags])
    weighted = F.zip_with("_values", weights, lambda v, w: v * w)
    present = F.zip_with("_values", weights, lambda v, w: F.when(v.isNotNull(), w))

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))

    history, cohort = F.col("player_history_seasons"), F.col("cohort_component_per_17")
    player = F.col("player_component_per_17")
    share = F.col("player_shrinkage_weight")
    blended = F.when(player.isNotNull() & cohort.isNotNull(), share * player + (1.0 - share) * cohort).otherwise(
        F.coalesce(player, cohort))
    enough = history >= rules.minimum_training_seasons
    known = F.col("prior_opportunity").isNotNull()
    eligible = known & (F.col("prior_opportunity") >= F.col("prior_opportunity_minimum"))
    available = F.col("baseline_mean").isNotNull()
    status = (F.when((history == 0) & available, "rookie_cohort_baseline")
              .when(history == 0, "rookie_no_baseline")
              .when(~enough, "insufficient_history")
              .when(~known, "missing_prior_opportunity")
              .when(~eligible, "below_prior_opportunity")
              .when(cohort.isNull(), "missing_cohort")
              .otherwise("training_eligible"))
    lineage = F.array_sort(F.array_union("_seasons", F.coalesce("cohort_seasons", F.array().cast("array<int>"))))
    return (
        joined
        .withColumn("player_history_seasons", F.size("_seasons"))
        .withColumn("player_component_per_17", F.try_divide(total(weighted), total(present)))
        .withColumn("cohort_player_seasons", F.coalesce("cohort_player_seasons", F.lit(0)))
        .withColumn("player_shrinkage_weight", F.when(history == 0, 0.0).when(
            cohort.isNull(), 1.0).otherwise(history / (history + rules.minimum_training_seasons)))
        .withColumn("baseline_mean", blended * F.col("target_schedule_games") / per)
        .withColumn("prior_opportunity", F.col("lag_1_opportunity"))
        .withColumns({
            "baseline_available": available,
            "opportunity_eligible": F.coalesce(eligible, F.lit(False)),
            "training_eligible": F.coalesce(available & enough & eligible, F.lit(False)),
            "cohort_status": status,
            "baseline_formula": F.lit("recency_weighted_player_plus_position_cohort_v1"),
            "feature_seasons": N.pipe_join(lineage),
            "max_feature_season": F.array_max(lineage),
        })
        .drop("_cohort_position", "_values", "_seasons", "cohort_seasons"))


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of NULLs per column, one row per column, from a single pass."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return rates.unpivot([], list(columns), "column_name", "missing_rate")
