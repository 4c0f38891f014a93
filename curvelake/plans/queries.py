"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Values are rounded only here, for comparison with the SQL equivalents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.functions import numeric as N
from curvelake.functions import odds as O
from curvelake.functions import special as S
from curvelake.functions import text as X
from curvelake.operators import (
    audit, books, calibrate, checks, consensus, history, history_gates, means, names, nearest, power_fit, publish, quotes, score,
)
from curvelake.plans import landing as _landing  # noqa: F401 - registers its queries
from curvelake.plans import roles as R
from curvelake.plans.registry import QUERIES as QUERIES
from curvelake.plans.registry import detailed as _detailed
from curvelake.plans.registry import gate as _gate
from curvelake.plans.registry import query, tidy
from curvelake.session import cut, growing, shared_folder, stage
from curvelake.sources.readers import source_profile
from curvelake.sources.writers import write_checks

# --- history --------------------------------------------------------------------------

@query
def entity_period_totals(spark, sf):
    return tidy(R.seasons(spark, sf).drop("age", "experience"))


@query
def long_metrics(spark, sf):
    return tidy(history.long_totals(R.seasons(spark, sf), R.HISTORY).drop("age", "experience"))


@query
def reconcile_totals(spark, sf):
    raw = R.weekly_raw(spark, sf)
    weekly = R.weekly(spark, sf)
    seasons = history.season_totals(history.merge_weeks(weekly, R.HISTORY), R.HISTORY)
    weeks = history.unreconciled_weeks(weekly, seasons, R.HISTORY).agg(F.count("*").alias("unreconciled"))
    # Yearly sums of the order lines stand in for an independent summary.
    summary = raw.filter(F.col("season_type") == R.HISTORY.season_type).groupBy("season", history.ENTITY).agg(
        F.sum("quantity").alias("season_quantity"))
    claims = history.unreconciled_summaries(summary, seasons, R.HISTORY, history.ENTITY, {"quantity": "season_quantity"}).agg(
        F.count("*").alias("unreconciled"))
    duplicates = checks.duplicate_keys(weekly, history.WEEK_GRAIN).agg(F.count("*").alias("unreconciled"))
    return tidy(weeks.withColumn("test", F.lit("weeks")).unionByName(claims.withColumn("test", F.lit("summaries"))).unionByName(
        duplicates.withColumn("test", F.lit("repeated_weeks"))))


@query
def exact_lags(spark, sf):
    lagged = history.with_lags(R.seasons(spark, sf), R.HISTORY)
    return tidy(lagged.select("season", history.ENTITY, *[c for i in (1, 2, 3) for c in (
        F.col(f"lag_{i}.season").cast("double").alias(f"lag_{i}_season"), F.col(f"lag_{i}.quantity").alias(f"lag_{i}_quantity"),
        F.col(f"lag_{i}.position").alias(f"lag_{i}_position"))]))


@query
def cohort_means(spark, sf):
    cohorts = history.cohort_means(R.seasons(spark, sf), R.HISTORY)
    return tidy(cohorts.withColumn("cohort_seasons", N.pipe_join(F.col("cohort_seasons"))))


BASELINE = ("target_season", history.ENTITY, "stat", "position", "realized_total", "lag_1_total_per_17", "lag_2_per_game",
            "lag_3_opportunity_per_17", "player_history_seasons", "player_component_per_17", "cohort_component_per_17",
            "cohort_player_seasons", "player_shrinkage_weight", "baseline_mean", "baseline_available", "opportunity_eligible",
            "training_eligible", "cohort_status", "feature_seasons")


@query
def lagged_baseline(spark, sf):
    return tidy(R.raw_predictions(spark, sf).select(*BASELINE))


@query
def missingness(spark, sf):
    raw = R.raw_predictions(spark, sf)
    return tidy(history.missingness(raw, ["baseline_mean", "lag_1_total", "lag_2_total", "lag_3_total", "prior_opportunity"]))


@query
def history_gate(spark, sf):
    weekly = R.weekly(spark, sf)
    merged = history.merge_weeks(weekly, R.HISTORY)
    return _gate(checks.all_checks(
        history_gates.weekly_gate(weekly, merged, R.HISTORY),
        history_gates.season_gate(R.seasons(spark, sf), R.HISTORY),
        history_gates.prediction_gate(R.predictions_for(spark, sf, history_gates.PREDICTION_READS), R.HISTORY)))


@query
def input_profile(spark, sf):
    return tidy(source_profile(R.weekly_raw(spark, sf)))


@query
def missing_seasons(spark, sf):
    """Configured seasons without a row, by statistic with any volume."""
    long = history.long_totals(R.seasons(spark, sf), R.HISTORY)
    expected = list(range(R.HISTORY.ingest_start_season - 2, R.HISTORY.latest_completed_season + 3))
    return tidy(checks.missing_values(long, expected, "season"))


# --- quotes ---------------------------------------------------------------------------

@query
def normalize_quotes(spark, sf):
    return tidy(R.normalized(spark, sf).drop("source_url", "team_abbreviation"))


@query
def odds_convert(spark, sf):
    i = F.col("event_id")
    text = F.when(i % 7 == 0, "EVEN").when(i % 7 == 1, F.concat(F.lit("−"), (105 + i % 300).cast("string"))).when(
        i % 7 == 2, F.concat(F.lit("–"), (110 + i % 90).cast("string"))).when(i % 7 == 3, "0").when(i % 7 == 4, "off").otherwise(
            F.concat(F.lit("+"), (100 + i % 400).cast("string")))
    odds = O.parse_american_odds(F.col("shown"))
    decimal = O.american_to_decimal(F.col("american"))
    return tidy(R.table(spark, sf, "events").select("event_id", "value", text.alias("shown")).withColumn("american", odds).select(
        "event_id", F.col("american").cast("double").alias("american_odds"), decimal.alias("decimal_odds"),
        O.implied_probability(decimal).alias("implied"), O.decimal_to_american(decimal).alias("round_trip"),
        O.format_american(F.col("american")).alias("signed"),
        O.display_percent(F.concat(F.col("value").cast("string"), F.lit("%"))).alias("percent"),
        O.fractional_text(F.col("event_id") % 9, F.col("event_id") % 4).alias("fraction")))


@query
def two_way_devig(spark, sf):
    rows = R.normalized(spark, sf).filter(F.col("source").isin(quotes.names_of(R.SOURCES, "book")))
    return tidy(quotes.price_books(rows, R.PRICING).select(
        "source", "source_market_id", "stat", "canonical_threshold", "decimal_odds", "raw_implied_probability", "market_overround",
        "no_vig_probability", "paired_under_decimal_odds", "paired_under_no_vig_probability", "inclusion_status", "exclusion_reason"), 8)


@query
def threshold_quote_filter(spark, sf):
    rows = R.normalized(spark, sf).filter(F.col("source").isin(quotes.names_of(R.SOURCES, "contract")))
    return tidy(quotes.price_contracts(rows, R.PRICING).select(
        "source", "source_market_id", "stat", F.col("canonical_threshold").cast("double").alias("canonical_threshold"),
        "decimal_odds", "modeling_probability", "bid_probability", "ask_probability", "inclusion_status", "exclusion_reason"))


@query
def multiway_devig(spark, sf):
    """Runners are users' events of a type; the market is the event type and day."""
    i = F.col("event_id")
    runners = R.table(spark, sf, "events").select(
        "event_id", "event_type", F.to_date("ts").cast("string").alias("day"),
        O.american_implied_probability(F.when(i % 997 != 0, 100 + F.floor(F.col("value") * 10))).alias("probability"))
    return tidy(quotes.multiway_devig(runners, ["event_type", "day"], "probability"))


@query
def model_eligibility(spark, sf):
    return tidy(quotes.annotate_eligibility(R.priced(spark, sf), R.MEANS).groupBy(
        "source", "stat", "inclusion_status", "model_inclusion_status", "model_exclusion_reason").agg(
            F.count("*").alias("quotes"), F.sum("modeling_probability").alias("total_probability")))


@query
def probability_fallback(spark, sf):
    i, v = F.col("event_id"), F.round(F.pmod(F.col("value"), F.lit(1.0)), 2)
    bid, ask = F.when(i % 5 != 0, v), F.when(i % 3 != 0, v + 0.02)
    last = F.when(i % 4 == 0, v + 0.01).when(i % 4 == 1, F.lit(0.0))
    estimate, method = quotes.probability_fallback(bid, ask, last)
    return tidy(R.table(spark, sf, "events").select(
        "event_id", estimate.alias("estimate"), method.alias("method"), quotes.strike_threshold(F.floor("value") + 0.5).alias("threshold")))


@query
def snapshot_assembly(spark, sf):
    return tidy(_assembled(spark, sf).drop("over", "under"))


def _assembled(spark, sf) -> DataFrame:
    """Orders as markets, customers of some segments as events, order lines as selections."""
    markets = R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("market_id"), F.col("o_custkey").alias("event_id"))
    found = R.table(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("event_id"), F.col("c_name").alias("player"))
    odds = F.when(F.col("l_tax") > 0.01, -105 - F.col("l_quantity").cast("int")).when(F.col("l_tax") > 0.0, F.lit(0)).otherwise(F.lit(100))
    selections = R.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("market_id"), F.when(F.col("l_linestatus") == "O", "Over").otherwise("Under").alias("outcome"),
        (F.floor(F.col("l_discount") * 20) + 0.5).alias("line"), odds.alias("american_odds"))
    return quotes.assemble_two_sided(markets, found, selections)


@query
def snapshot_counters(spark, sf):
    return tidy(quotes.assembly_counters(_assembled(spark, sf)))


@query
def volume_counters(spark, sf):
    rows = R.events(spark, sf).select("stat", "user_id", F.col("k").cast("bigint").alias("k"))
    return tidy(quotes.volume_counters(rows, "stat", "user_id", "k").withColumn("stat", F.coalesce("stat", F.lit("all"))))


@query
def conflicting_records(spark, sf):
    lines = R.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"), "l_partkey", "l_returnflag")
    return tidy(quotes.conflicting_records(lines, "line_id"))


def _expected_rows(spark, sf) -> int:
    """Two outcomes for a two-sided market, one for a contract."""
    return 2 * R.book_markets(spark, sf).count() + R.contract_markets(spark, sf).count()


def _faulty(spark, sf) -> DataFrame:
    """Canonical rows with planted faults: lost thresholds, void odds, impossible prices, repeated keys."""
    kind = F.conv(F.substring(F.md5(F.concat_ws("/", "source_market_id", "outcome_side")), 1, 4), 16, 10).cast("int") % 40
    book = F.col("source").isin(quotes.names_of(R.SOURCES, "book"))
    rows = R.normalized(spark, sf).withColumn("_kind", kind)
    faulty = rows.withColumns({
        "threshold": F.when(F.col("_kind") != 0, F.col("threshold")),
        "american_odds": F.when((F.col("_kind") == 1) & book, 0).otherwise(F.col("american_odds")),
        "yes_ask_probability": F.when((F.col("_kind") == 2) & ~book, 1.5).otherwise(F.col("yes_ask_probability"))})
    return faulty.unionByName(faulty.filter("_kind = 3")).drop("_kind")


@query
def normalized_faults(spark, sf):
    """The gate of canonical rows over rows with planted faults."""
    return _detailed(quotes.normalized_gate(_faulty(spark, sf), R.SOURCES, R.STATS, F.lit(_expected_rows(spark, sf))))


@query
def checks_report(spark, sf):
    """The gate of faulty rows published as a report and read again."""
    path = shared_folder(spark, "report")
    write_checks(quotes.normalized_gate(_faulty(spark, sf), R.SOURCES, R.STATS, F.lit(_expected_rows(spark, sf))), path)
    return _detailed(spark.read.schema("name string, passed boolean, severity string, message string, details map<string, string>").json(path))


@query
def quote_gates(spark, sf):
    rows = R.normalized(spark, sf)
    priced = quotes.price_quotes(rows, R.SOURCES, R.PRICING)
    snapshots = rows.select("source", "snapshot_utc").distinct()
    return _gate(checks.all_checks(
        quotes.normalized_gate(rows, R.SOURCES, R.STATS, F.lit(_expected_rows(spark, sf))), quotes.pricing_gate(priced, R.SOURCES, R.PRICING),
        quotes.snapshot_skew(snapshots, R.PRICING.max_cross_source_skew_minutes, len(R.SOURCES))))


@query
def snapshot_gate(spark, sf):
    """Per-market checks of a snapshot document per two-sided source."""
    markets = R.book_markets(spark, sf)
    checked = []
    for source in quotes.names_of(R.SOURCES, "book"):
        m = F.col("market")
        mine = markets.filter(F.col("source") == source)
        bad = [F.count_if(~F.coalesce(c, F.lit(False))) for c in (
            m["season"] == R.SEASON, N.is_finite(m["market_line"]),
            X.label_line(m["probability"]["over"]["label"]) == m["market_line"],
            X.label_line(m["probability"]["under"]["label"]) == m["market_line"],
            (m["threshold_operators"]["over"] == ">") & (m["threshold_operators"]["under"] == "<"))]
        age = N.age_hours(F.lit("2024-02-01T00:00:00Z").cast("timestamp"), F.max(N.parse_utc(F.col("snapshot_utc"))))
        checked.append(mine.agg(F.lit(source).alias("source"), F.count("*").alias("markets"), age.alias("age_hours"), *[
            b.alias(n) for b, n in zip(bad, ("season", "line", "over_label", "under_label", "operators"))]))
    return tidy(checked[0].unionByName(checked[1]))


# --- order books ----------------------------------------------------------------------

@query
def book_summary(spark, sf):
    return tidy(books.book_summary(R.combined_levels(spark, sf)), 4)


@query
def book_depth(spark, sf):
    return tidy(books.band_depth(R.combined_levels(spark, sf)), 4)


@query
def book_fill_vwap(spark, sf):
    return tidy(books.execution_quotes(R.combined_levels(spark, sf)))


# --- text -----------------------------------------------------------------------------

@query
def page_embedded_json(spark, sf):
    """Pages with an assigned object in a script, read back from the whole page."""
    pages = R.table(spark, sf, "pages")
    page = F.concat(F.lit("<script>window.pageData = "), F.to_json(F.struct("page_id", "url")), F.lit(";</script>"), F.col("html"))
    data = X.embedded_json(page, "pageData", "page_id long, url string")
    return pages.select("page_id", F.length(page).cast("bigint").alias("page_chars"), data["page_id"].alias("json_id"), data["url"].alias("json_url"),
                        X.embedded_json(page, "other", "page_id long").isNull().alias("other_absent"))


@query
def title_regex(spark, sf):
    i, v = F.col("event_id"), F.floor("value")
    side = F.when(i % 2 == 0, "Over").otherwise("Under")
    runner = F.concat_ws(" ", F.lit("User"), F.col("user_id").cast("string"), side, F.concat(v.cast("string"), F.lit(".5")))
    title = F.concat_ws(" ", F.lit("User"), F.col("user_id").cast("string"), F.lit("Regular Season"), F.col("event_type"), F.lit("2024-25"))
    player, season = X.split_title(title, F.lit("Regular Season"))
    event = F.concat_ws(" ", F.lit("NFL 2024/25 Props -"), F.col("event_type"))
    rows = R.table(spark, sf, "events")
    people = F.filter(F.array(
        F.struct(F.col("event_type").alias("name"), F.lit(None).cast("string").alias("team_id"), F.lit(None).cast("string").alias("short_name"), (i % 3 > 0).alias("here")),
        F.struct(F.lit("second").alias("name"), F.lit(None).cast("string").alias("team_id"), F.lit(None).cast("string").alias("short_name"), (i % 5 == 0).alias("here")),
        F.struct(F.lit("Team").alias("name"), F.lit("7").alias("team_id"), F.lit("TM").alias("short_name"), (i % 2 == 0).alias("here"))),
        lambda p: p["here"])
    named, team, short = X.participant_names(event, people)
    return tidy(rows.select(
        "event_id", X.extract(runner, X.RUNNER_PATTERN, 1).alias("runner"), X.extract(runner, X.RUNNER_PATTERN, 2).alias("outcome"),
        X.label_line(runner).alias("line"), X.season_from_title(event).alias("slash_season"), player.alias("player"),
        season.alias("season"), named.alias("participant"), team.alias("team"), short.alias("short"),
        N.title_label(F.concat_ws("_", F.lit("by"), F.col("event_type"))).alias("label")))


@query
def match_keys(spark, sf):
    """Keys of whole utterances: accents, punctuation and suffixes over real text."""
    rows = R.table(spark, sf, "conversations")
    return rows.select("conv_id", "turn", X.match_key(F.col("text")).alias("match_key"))


def _names(spark, sf) -> DataFrame:
    """Part names as known players: brand as team, type as statistic."""
    return R.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("gsis_player_id"), F.concat_ws(" ", "p_name", "p_brand").alias("player_name"),
        F.col("p_type").alias("position"), F.col("p_brand").alias("team"), F.col("p_type").alias("stat"))


@query
def stable_ids(spark, sf):
    key = X.match_key(F.col("player_name"))
    return _names(spark, sf).select("gsis_player_id", key.alias("match_key"), X.stable_id(key).alias("stable_id"),
                                    X.initials_match(F.concat(F.substring("player_name", 1, 1), F.lit(" "), F.element_at(F.split(key, " "), -1)), key).alias("initials"))


NAME_SOURCES = {name: R.SOURCES[name] for name in ("click", "purchase", "view")}


def _name_quotes(spark, sf) -> DataFrame:
    """Suppliers' quotes of parts under altered names: as is, accented, with a suffix, a letter off, initials."""
    lines = R.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    full, kind = F.concat_ws(" ", "p_name", "p_brand"), F.col("p_partkey") % 8
    raw = (F.when(kind == 0, full).when(kind == 1, F.concat(F.upper(F.translate(full, "aeiou", "áéîöù")), F.lit(" Jr."))).when(
        kind == 2, F.concat(F.substring(full, 1, 3), F.substring(full, 5, 100))).when(
            kind == 3, F.concat(F.substring(full, 1, 1), F.lit(". "), F.element_at(F.split(full, " "), -1))).when(
                kind == 4, F.concat(full, F.lit("x"))).when(kind == 5, F.concat_ws("-", "p_name", "p_brand")).when(
                    kind == 6, F.concat(F.lit("unknown "), F.md5(full))).otherwise(F.concat(F.lit(" "), full, F.lit(" III"))))
    # The altered names are made once per part, before the join with the lines.
    parts = R.table(spark, sf, "part").select(
        "p_partkey", raw.alias("raw_player_name"), F.col("p_type").alias("stat"), F.col("p_brand").alias("team"))
    source = F.element_at(F.array(*[F.lit(s) for s in sorted(NAME_SOURCES)]), (F.col("l_suppkey") % 3 + 1).cast("int"))
    return lines.join(growing(parts), F.col("l_partkey") == F.col("p_partkey")).select(
        source.alias("source"), "raw_player_name", "stat", "team", F.lit(None).cast("string").alias("team_abbreviation"))


def _aliases(spark, sf) -> DataFrame:
    """An alias for the name of every brand's first part."""
    parts = R.table(spark, sf, "part")
    firsts = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("key")).select("key")
    named = parts.groupBy(F.concat_ws(" ", "p_name", "p_brand").alias("full")).agg(F.min("p_partkey").alias("key")).join(firsts, "key")
    return named.select(
        F.when(F.col("key") % 2 == 0, "*").otherwise("click").alias("source"), F.col("full").alias("raw_player_name"),
        F.concat(F.lit("listed:"), F.col("key").cast("string")).alias("canonical_player_id"),
        F.concat(F.lit("Listed "), F.col("full")).alias("canonical_player_name"), F.lit("reviewed").alias("notes"))


@stage
def _identities(spark, sf) -> DataFrame:
    return names.market_identities(_name_quotes(spark, sf), sorted(NAME_SOURCES))


@query
def candidate_table(spark, sf):
    table = names.candidate_table(_names(spark, sf))
    return table.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in table.dtypes])


@query
def market_identities(spark, sf):
    table = _identities(spark, sf)
    return table.select("source", "raw_player_name", "match_key", F.array_join("stats", "|").alias("stats"), F.array_join("teams", "|").alias("teams"))


@query
def alias_match(spark, sf):
    found = names.match_aliases(_identities(spark, sf), _aliases(spark, sf))
    return found.filter(F.col("alias_id").isNotNull()).select("source", "raw_player_name", "alias_id", "alias_name")


@query
def exact_match(spark, sf):
    return names.exact_matches(_identities(spark, sf), names.id_range(names.pool_from_history(_names(spark, sf))))


@query
def similar_names(spark, sf):
    """Distinct quoted and known keys at least 90 alike, or alike by initials."""
    quoted = _identities(spark, sf).select(F.col("match_key").alias("query_key")).distinct()
    known = names.pool_from_history(_names(spark, sf)).select("match_key").distinct()
    return tidy(names.similar_keys(quoted, known, 90.0))


@stage
def _resolved(spark, sf) -> DataFrame:
    return names.reconcile(_name_quotes(spark, sf), _names(spark, sf), _aliases(spark, sf), NAME_SOURCES, R.NAMES)


@query
def player_map(spark, sf):
    return tidy(names.player_map(_resolved(spark, sf)))


@query
def suggestions(spark, sf):
    return tidy(names.review_suggestions(_resolved(spark, sf)))


@query
def decorated_quotes(spark, sf):
    """Every quote with its identity, counted by name, statistic and team."""
    quoted = _name_quotes(spark, sf)
    found = names.decorate(quoted, names.player_map(_resolved(spark, sf)))
    return found.groupBy("source", F.trim("raw_player_name").alias("raw_player_name"), "stat", "team", "canonical_player_id",
                         "identity_review_status").agg(F.count("*").alias("quotes"))


@query
def identity_checks(spark, sf):
    """The identity gate with its details."""
    quoted, resolved = _name_quotes(spark, sf), _resolved(spark, sf)
    gate = names.identity_gate(quoted, names.decorate(quoted, names.player_map(resolved)), resolved)
    return _detailed(gate)


@query
def identity_summary(spark, sf):
    quoted = _name_quotes(spark, sf)
    resolved = _resolved(spark, sf)
    decorated = names.decorate(quoted, names.player_map(resolved))
    gate = checks.gate_status(names.identity_gate(quoted, decorated, resolved))
    summary = names.identity_summary(resolved)
    return tidy(summary.unionByName(decorated.agg(F.lit("decorated").alias("review_status"), F.count("*").alias("names"))).unionByName(
        gate.select(F.concat(F.lit("gate "), "status").alias("review_status"), F.col("errors").alias("names"))))


@query
def promoted_aliases(spark, sf):
    reviewed = names.review_suggestions(_resolved(spark, sf)).filter(F.col("candidate_canonical_player_id").isNotNull()).withColumn(
        "review_status", F.lit("approved"))
    grown, problems = names.promote_suggestions(reviewed, _aliases(spark, sf), sorted(NAME_SOURCES))
    return tidy(grown.agg(F.count("*").alias("aliases")).unionByName(problems.agg(F.count("*").alias("aliases"))).withColumn(
        "kind", F.lit("rows")))


@query
def review_candidates(spark, sf):
    """Best known player and runner-up of every name that the review floor leaves without a candidate."""
    open_ = _resolved(spark, sf).filter("reason = 'below_review_floor'").select(*names.WHO)
    history = _names(spark, sf)
    rows = names.candidate_rows(history)
    asked = _identities(spark, sf).join(growing(open_), names.WHO, "left_semi")
    found = nearest.best_two(asked, names.pool_from_history(history), rows.filter("team is not null").select("canonical_player_id", "team").distinct())
    known = rows.groupBy("canonical_player_id").agg(F.max("player_name").alias("candidate_name"))
    return tidy(found.join(growing(known), found["best_id"] == known["canonical_player_id"]).select(
        *names.WHO, F.col("best_id").alias("candidate_canonical_player_id"), "candidate_name", F.col("best_score").alias("match_score"), "runner_up_score"))


@query
def alias_actions(spark, sf):
    """Promotion row by row, and once more on the grown table; suggestions repeat, contradict or lack what is listed, too."""
    found = names.review_suggestions(_resolved(spark, sf)).filter(F.col("candidate_canonical_player_id").isNotNull()).select(
        "source", "raw_player_name", "candidate_canonical_player_id", "candidate_canonical_player_name")
    aliases = _aliases(spark, sf)
    key = F.regexp_extract("canonical_player_id", "[0-9]+$", 0).cast("bigint")
    again = aliases.select("source", "raw_player_name", F.when(key % 3 == 1, "listed:0").when(key % 3 == 0, F.col("canonical_player_id")).alias("candidate_canonical_player_id"),
                           F.col("canonical_player_name").alias("candidate_canonical_player_name"))
    reviewed = found.unionByName(again).withColumn("review_status", F.lit("approved"))
    first = cut(names.alias_actions(reviewed, aliases, sorted(NAME_SOURCES)))
    second = names.alias_actions(reviewed, names.appended(aliases, first), sorted(NAME_SOURCES))
    return tidy(first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2))).drop("match_key"))


# --- distributions --------------------------------------------------------------------

def _counts(spark, sf) -> DataFrame:
    """Lines of an order as a count, its mean quantity as the mean."""
    lines = R.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("y"), F.avg("l_quantity").alias("mu"), F.count("*").alias("n"))
    return lines.withColumn("r", 0.5 + F.col("n"))


@query
def nb_logpmf(spark, sf):
    y, mu, r = F.col("y"), F.col("mu"), F.col("r")
    return tidy(_counts(spark, sf).select(
        "l_orderkey", S.nb_logpmf(y, mu, r).alias("log_pmf"), S.poisson_logpmf(y, mu).alias("log_poisson"),
        S.nb_probability(mu, r).alias("probability"), S.nb_variance(mu, r).alias("variance"),
        S.nb_logpmf(y, F.lit(0.0), r).isin(float("-inf")).alias("impossible")))


@query
def nb_survival(spark, sf):
    k = F.floor("mu").cast("double") + F.col("n")
    return tidy(_counts(spark, sf).select("l_orderkey", k.alias("k"), S.nb_survival(k, F.col("mu"), F.col("r")).alias("survival")), 8)


@query
def nb_interval(spark, sf):
    mu, r = F.col("mu"), F.col("r")
    return tidy(_counts(spark, sf).select(
        "l_orderkey", S.nb_quantile(F.lit(0.1), mu, r).alias("low"), S.nb_quantile(F.lit(0.9), mu, r).alias("high")))


# --- calibration ----------------------------------------------------------------------

@stage
def _fits(spark, sf) -> DataFrame:
    raw = R.raw_predictions(spark, sf).withColumn("baseline_mean_raw", F.col("baseline_mean"))
    return power_fit.power_fits(cut(power_fit.observations(raw, R.HISTORY)), R.HISTORY)


@query
def poisson_power_fit(spark, sf):
    fits = _fits(spark, sf).withColumn("training_seasons", N.pipe_join(F.col("training_seasons")))
    return tidy(fits.select("stat", "reference_season", "half_life", "intercept", "exponent", "bound_hit",
                            F.col("objective_poisson_nll").alias("objective"), "training_player_seasons", "training_seasons"), 4)


@query
def half_life_selection(spark, sf):
    chosen = power_fit.select_half_lives(_fits(spark, sf), R.HISTORY)
    return tidy(chosen.withColumn("validation_seasons", N.pipe_join(F.col("validation_seasons"))), 5)


@query
def rolling_correction(spark, sf):
    columns = ("target_season", history.ENTITY, "stat", "baseline_mean_raw", "baseline_mean", "baseline_bias_method",
               "baseline_bias_intercept", "baseline_bias_exponent", "baseline_bias_training_seasons", "feature_seasons")
    return tidy(R.predictions(spark, sf).select(*columns), 4)


@stage
def _training(spark, sf) -> DataFrame:
    return calibrate.training_rows(R.calibration_rows(spark, sf), R.HISTORY)


@stage
def _dispersion_fits(spark, sf) -> DataFrame:
    windows = cut(calibrate.with_windows(_training(spark, sf), R.HISTORY, R.CALIBRATION))
    return calibrate.fit_dispersion(windows, ["stat", "window"], R.CALIBRATION)


@query
def dispersion_fit(spark, sf):
    return tidy(_dispersion_fits(spark, sf).select("stat", "window", "log_dispersion", "nll_per_weight", "player_seasons", "bound_hit"), 4)


@query
def window_sensitivity(spark, sf):
    return tidy(calibrate.window_sensitivity(_dispersion_fits(spark, sf), R.HISTORY, R.CALIBRATION), 4)


@query
def bootstrap_dispersion(spark, sf):
    replicates = calibrate.bootstrap_dispersion(_training(spark, sf), _dispersion_fits(spark, sf), R.CALIBRATION)
    return tidy(calibrate.bootstrap_summary(replicates, R.CALIBRATION).select(
        "stat", "samples_requested", "successful_samples", "bound_hit_samples", "failed_samples", "success_rate",
        "log_dispersion_lower", "log_dispersion_upper", "passed"), 3)


@stage
def _holdout(spark, sf) -> DataFrame:
    fits = _dispersion_fits(spark, sf).filter("window = 'full'").withColumn("dispersion", F.round("dispersion", 4))
    return calibrate.holdout_rows(R.calibration_rows(spark, sf), fits)


@query
def holdout_metrics(spark, sf):
    return tidy(calibrate.holdout_summary(_holdout(spark, sf)), 4)


@query
def brier_events(spark, sf):
    return tidy(calibrate.brier_events(_holdout(spark, sf), R.CALIBRATION), 4)


@query
def interval_coverage(spark, sf):
    return tidy(calibrate.interval_coverage(_holdout(spark, sf), R.CALIBRATION), 4)


@query
def mean_bins(spark, sf):
    return tidy(calibrate.mean_bins(_holdout(spark, sf), R.CALIBRATION), 4)


@query
def cohort_metrics(spark, sf):
    return tidy(calibrate.cohort_metrics(_holdout(spark, sf)), 4)


@query
def calibration_gate(spark, sf):
    lags = [f"lag_{i}_season" for i in range(1, history.LAGS_PUBLISHED + 1)]
    predictions = R.predictions_for(spark, sf, [*calibrate.PREDICTION_READS, *lags])
    rows = calibrate.window_rows(predictions, R.HISTORY)
    return _gate(checks.all_checks(calibrate.prediction_contract(predictions, R.HISTORY),
                                   calibrate.cohort_gate(rows, R.HISTORY, R.CALIBRATION)))


@stage
def _published(spark, sf) -> DataFrame:
    """Dispersion table and gate in one table, so that the calibration runs once: the gate's rows have a name."""
    table, gates = calibrate.calibrate(R.predictions(spark, sf), R.HISTORY, R.CALIBRATION)
    return table.unionByName(gates.select("name", "passed"), allowMissingColumns=True)


@query
def dispersion_table(spark, sf):
    """The published calibration, from weekly rows to the status of every statistic."""
    return tidy(_published(spark, sf).filter("name IS NULL").drop("name", "passed"), 4)


@query
def tolerance_gate(spark, sf):
    """The calibration's tolerances per statistic; what always holds by construction is left to calibration_gate."""
    always = ("optimizer_converged", "integer_outcomes", "baseline_domain", "signed_negative_observations")
    named = _published(spark, sf).filter(F.size(F.split("name", r"\.")) == 3)
    return named.filter(~F.element_at(F.split("name", r"\."), -1).isin(*always)).select("name", "passed")


# --- means ----------------------------------------------------------------------------

def _mean_inputs(spark, sf) -> tuple[DataFrame, DataFrame]:
    return R.model_quotes(spark, sf), R.dispersions(spark, sf)


@query
def mean_inversion(spark, sf):
    quoted, table = _mean_inputs(spark, sf)
    rows = means.included(quoted).join(table.select("stat", F.col("historical_dispersion").alias("r")), "stat")
    solved = means.invert_quotes(rows.select("source", "source_market_id", "stat", "k", "p", "r"), R.MEANS)
    return tidy(solved.select("source", "source_market_id", "mean", "bound_hit", "modeled_probability"), 5)


def _contract_curves(spark, sf) -> DataFrame:
    quoted, table = _mean_inputs(spark, sf)
    rows = means.included(quoted).filter(F.col("source").isin(quotes.names_of(R.SOURCES, "contract"))).join(
        table.select("stat", F.col("historical_dispersion").alias("r")), "stat")
    lo, hi = R.MEANS.mean_bounds[R.STATS[0]]
    return rows.select("source", "canonical_player_id", "stat", "k", "p", "r", F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))


@query
def curve_fit(spark, sf):
    keys = ["source", "canonical_player_id", "stat"]
    fits = means.fit_curves(_contract_curves(spark, sf), keys, R.MEANS, holdout=False)
    return tidy(fits.select(*keys, "quotes", "mean", "objective", "logit_rmse", "logit_mae", "max_abs_logit_residual"), 4)


@query
def curve_leave_one_out(spark, sf):
    keys = ["source", "canonical_player_id", "stat"]
    fits = means.fit_curves(_contract_curves(spark, sf), keys, R.MEANS)
    return tidy(fits.select(*keys, F.col("holdout_count"), "holdout_failed_fits", "holdout_logit_mae"), 4)


@query
def dispersion_choice(spark, sf):
    """The update over curves that support the past, contradict it, or are too rough to tell."""
    chosen = means.update_dispersions(R.curve_quotes(spark, sf), R.past_dispersions(spark), R.MEANS)
    return tidy(chosen.select(
        "stat", "method", "fallback_reason", "final_dispersion", "current_market_only_dispersion", "current_market_map_dispersion", "current_market_group_count",
        "current_market_quote_count", "quarantined_groups", "current_market_prior_log_sd", "current_market_only_objective", "current_market_map_objective",
        "current_market_only_logit_rmse", "current_market_map_logit_rmse", "current_market_only_holdout_logit_mae", "current_market_map_holdout_logit_mae",
        "current_market_log_dispersion_delta", "current_market_only_validation_passed", "current_market_map_validation_passed"), 3)


def _historical_only(table: DataFrame) -> DataFrame:
    return table.withColumns({"final_dispersion": F.col("historical_dispersion"), "dispersion_source": F.lit("historical_only")})


@stage
def _projections(spark, sf) -> DataFrame:
    quoted, table = _mean_inputs(spark, sf)
    return means.source_projections(quoted, _historical_only(table), R.SOURCES, R.MEANS)


@query
def source_projections(spark, sf):
    return tidy(_projections(spark, sf).select(
        *means.GROUP, "quote_count", "eligible_quote_count", "mean", "sensitivity_low", "sensitivity_high", "projection_method",
        "thresholds_used", F.col("holdout_failed_fits").cast("double").alias("holdout_failed_fits"), "quality_status", "exclusion_reason"), 4)


@query
def projection_lineage(spark, sf):
    """Every quote under the key of its projection."""
    return tidy(means.projection_lineage(R.model_quotes(spark, sf)))


@query
def quote_backfill(spark, sf):
    return tidy(means.backfill_quotes(R.model_quotes(spark, sf), _projections(spark, sf)).select(
        "source", "source_market_id", "model_inclusion_status", "source_projection_mean", "modeled_probability",
        "probability_residual", "logit_probability_residual", "source_projection_quality_status"), 4)


@query
def near_even_gate(spark, sf):
    backfilled = means.backfill_quotes(R.model_quotes(spark, sf), _projections(spark, sf))
    near = means.near_even_violations(backfilled, R.SOURCES, R.MEANS)
    return tidy(near.select("source", "source_market_id", "median_proxy", "absolute_shift", "maximum_shift", "violation"), 4)


@query
def model_gate(spark, sf):
    projections = _projections(spark, sf)
    backfilled = cut(means.backfill_quotes(R.model_quotes(spark, sf), projections).select(*means.GATE_READS))
    return _gate(means.model_gate(projections, backfilled, _historical_only(R.dispersions(spark, sf)), R.SOURCES, R.MEANS))


# --- consensus, scores, audit ---------------------------------------------------------

@stage
def _estimates(spark, sf) -> DataFrame:
    """A closed-form estimate per source, user and statistic, so that later stages compare exactly in SQL.

    The mean is the average quoted threshold; users' estimates with one quote fail.
    """
    rows = R.model_quotes(spark, sf)
    k = F.coalesce(F.col("canonical_threshold").cast("double"), F.col("threshold"))
    grouped = rows.groupBy(*means.GROUP).agg(
        F.max("canonical_player_name").alias("canonical_player_name"), F.max("canonical_position").alias("canonical_position"),
        F.count("*").alias("quote_count"), F.count_if(F.col("model_inclusion_status") == "included").alias("eligible_quote_count"),
        F.avg(k).alias("average"), F.max(k).alias("top"))
    passed = (F.col("eligible_quote_count") > 0) & (F.col("top") > 3)
    return grouped.select(
        *means.GROUP, "canonical_player_name", "canonical_position", "quote_count", "eligible_quote_count",
        F.col("average").alias("mean"), (F.col("average") * 0.9).alias("sensitivity_low"), (F.col("average") * 1.2).alias("sensitivity_high"),
        F.when(passed, "passed").otherwise("failed").alias("quality_status"))


def _consensus(spark, sf) -> DataFrame:
    return consensus.consensus(_estimates(spark, sf), R.SOURCES, R.AGGREGATION)


@query
def weighted_consensus(spark, sf):
    rows = _consensus(spark, sf)
    return tidy(rows.select(
        *consensus.KEYS, "canonical_player_name", "source_list", "source_count", "configured_weight_sum", "effective_weight_sum",
        "click_mean", "view_mean", "purchase_mean", "click_effective_weight", "consensus_mean", "sensitivity_low", "sensitivity_high",
        "minimum_source_mean", "maximum_source_mean", "source_range", "relative_disagreement", "disagreement_flag", "quality_status",
        "exclusion_reason"))


@query
def consensus_gate(spark, sf):
    rows = _estimates(spark, sf)
    return _gate(consensus.consensus_gate(rows, consensus.consensus(rows, R.SOURCES, R.AGGREGATION), R.SOURCES, R.AGGREGATION))


def _scored(spark, sf) -> DataFrame:
    return score.score(_consensus(spark, sf), R.SCORING)


@query
def score_profiles(spark, sf):
    return tidy(_scored(spark, sf))


@query
def scoring_gate(spark, sf):
    return _gate(score.scoring_gate(_consensus(spark, sf), _scored(spark, sf), R.SCORING))


PAIRS = (("click", "view"), ("click", "purchase"), ("view", "purchase"))


def _pivot(spark, sf) -> DataFrame:
    return audit.pivot_sources(_estimates(spark, sf), sorted(R.SOURCES))


@query
def source_pivot(spark, sf):
    return tidy(_pivot(spark, sf))


@query
def source_agreement(spark, sf):
    return tidy(audit.pair_agreement(cut(audit.pair_rows(_pivot(spark, sf), PAIRS))))


@query
def source_agreement_by_stat(spark, sf):
    return tidy(audit.pair_agreement_by_stat(cut(audit.pair_rows(_pivot(spark, sf), PAIRS))))


def _liquidity(spark, sf) -> DataFrame:
    rows = R.model_quotes(spark, sf).filter((F.col("source") == "purchase") & (F.col("inclusion_status") == "included"))
    size = F.col("source_market_id").cast("bigint") % 90
    return audit.curve_liquidity(rows.withColumns({
        "volume_24h": (F.col("volume") % 3).cast("double"), "min_top_size": F.when(size > 10, size.cast("double"))}))


@query
def curve_liquidity(spark, sf):
    return tidy(_liquidity(spark, sf))


@query
def projection_liquidity(spark, sf):
    eligible = audit.eligible_means(_estimates(spark, sf)).filter(F.col("source") == "purchase")
    return tidy(audit.with_liquidity(eligible.select(*audit.PLAYER_STAT, "mean"), _liquidity(spark, sf)).groupBy("stat").agg(
        F.count("*").alias("curves"), F.count_if(F.col("volume_24h") == 0).alias("idle"), F.count("total_volume").alias("quoted"),
        F.sum("total_volume").alias("volume")))


@query
def disagreement_rate(spark, sf):
    return tidy(audit.disagreement_rate(_consensus(spark, sf), "purchase"))


def _three(spark, sf) -> DataFrame:
    return audit.three_source_rows(_pivot(spark, sf), _consensus(spark, sf), ("click", "view"), "purchase")


@query
def three_source(spark, sf):
    return tidy(audit.three_source_by_stat(cut(_three(spark, sf))))


@query
def top_outliers(spark, sf):
    rows = audit.top_rows(_three(spark, sf), "absolute_contract_vs_books", 15, tie=audit.PLAYER_STAT)
    named = audit.with_names(rows, audit.player_names(_estimates(spark, sf)))
    return tidy(named.select(*audit.PLAYER_STAT, "canonical_player_name", "canonical_position", "contract_vs_books", "consensus_vs_books"))


@query
def rank_correlation(spark, sf):
    rows = audit.with_liquidity(_three(spark, sf), _liquidity(spark, sf))
    return tidy(audit.rank_correlation(cut(rows), "absolute_contract_vs_books", "total_volume"))


@query
def line_ratios(spark, sf):
    rows = R.model_quotes(spark, sf).filter(F.col("source").isin(quotes.names_of(R.SOURCES, "book")))
    mean = _estimates(spark, sf).select(*means.GROUP, F.col("mean").alias("source_projection_mean"))
    return tidy(audit.line_ratios(cut(rows.join(mean, means.GROUP))))


@query
def funnel(spark, sf):
    rows = R.model_quotes(spark, sf)
    estimates = _estimates(spark, sf)
    status = estimates.select(*means.GROUP, F.col("quality_status").alias("source_projection_quality_status"))
    return tidy(audit.contract_funnel(rows.join(status, means.GROUP), estimates, _historical_only(R.dispersions(spark, sf)), "purchase"))


@query
def headline_counts(spark, sf):
    return tidy(audit.headline_counts(_consensus(spark, sf)))


@query
def source_skew(spark, sf):
    return tidy(audit.source_skew_seconds(R.normalized(spark, sf).select("source", "snapshot_utc").distinct()))


@query
def top_scores(spark, sf):
    return tidy(audit.top_rows(_scored(spark, sf).select("canonical_player_id", "scoring_profile", "fpts_standard", "fpts_full_ppr"),
                               "fpts_standard", 15, tie=["canonical_player_id"]))


@query
def projection_mart(spark, sf):
    """The published table in its column order, read back as SQL views."""
    scored = _scored(spark, sf)
    audit.register_views({"published_projections": publish.projection_mart(scored, R.SCORING)})
    return tidy(spark.table("published_projections"))


@query
def checks_mart(spark, sf):
    rows = R.normalized(spark, sf)
    gates = {"normalized": quotes.normalized_gate(rows, R.SOURCES, R.STATS),
             "scoring": score.scoring_gate(_consensus(spark, sf), _scored(spark, sf), R.SCORING)}
    return publish.checks_mart(gates).drop("observed_value")


@query
def mart_gate(spark, sf):
    scored = cut(_scored(spark, sf))
    return _gate(publish.mart_gate(publish.projection_mart(scored, R.SCORING), scored, _estimates(spark, sf), "projections"))


@query
def warning_rollup(spark, sf):
    seasons = history_gates.season_gate(R.seasons(spark, sf), R.HISTORY)
    return checks.failed_warnings(seasons)


@query
def run_info(spark, sf):
    warnings = checks.failed_warnings(history_gates.season_gate(R.seasons(spark, sf), R.HISTORY))
    return publish.run_info_mart(spark, {"run_id": R.RUN_ID, "season": R.SEASON}, warnings)


@query
def settings_with_use(spark, sf):
    """Scoring settings with the number of scored players whose profile uses the setting."""
    scored = _scored(spark, sf)
    used = scored.select(F.explode(F.split("components_used", r"\|")).alias("setting")).filter("setting <> ''").groupBy("setting").agg(
        F.count("*").alias("players"))
    return tidy(publish.settings_mart(spark, R.SCORING, R.STATS).join(used, "setting", "left").withColumn(
        "players", F.coalesce("players", F.lit(0))))


from curvelake.plans import chain as _chain  # noqa: E402,F401 - these register queries that read the stages above
from curvelake.plans import faults as _faults  # noqa: E402,F401
