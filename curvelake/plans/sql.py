"""SQL equivalents of the registered queries for DuckDB.

Survival probabilities come from summing the mass function, power fits from
bisection and dispersions from ternary search. Two parts follow the same steps as
the Spark side and so check the arithmetic, not the method: curve fits (same start
and secant rule, since a robust cost can have several minima) and the bootstrap
(same hashes and nodes).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from curvelake.operators.calibrate import HASH_PRIME, UNIT_POISSON
from curvelake.plans import roles as R

ORACLES: dict[str, str] = {}
STATS = R.STATS
OPPORTUNITY = R.HISTORY.opportunity_by_stat


def r(expression: str, digits: int = 6, name: str | None = None) -> str:
    alias = name or expression.split(".")[-1]
    return f"(round(({expression})::DOUBLE, {digits}) + 0.0::DOUBLE) AS {alias}"


def rs(columns: str, digits: int = 6) -> str:
    return ", ".join(r(c, digits) for c in columns.split())


def big(columns: str) -> str:
    return ", ".join(f"({c})::BIGINT AS {c.split('.')[-1]}" for c in columns.split())


def with_(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


# --- history --------------------------------------------------------------------------

WEEKLY = """
order_lines AS (SELECT l_orderkey, sum(l_quantity) AS q, count(*)::DOUBLE AS n,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS ret FROM lineitem GROUP BY 1),
weekly_all AS (SELECT year(o_orderdate) AS season, weekofyear(o_orderdate) AS week, o_orderstatus <> 'P' AS regular,
    o_custkey::VARCHAR AS gsis_player_id, c_name AS player_name, o_orderpriority AS team, c_mktsegment AS position,
    1.0::DOUBLE AS order_count, coalesce(n, 0) AS shipped_lines, coalesce(q, 0) AS quantity, coalesce(n, 0) AS line_count,
    coalesce(ret, 0) AS returned_quantity
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN order_lines ON l_orderkey = o_orderkey
    WHERE year(o_orderdate) BETWEEN 1995 AND 2000),
weekly AS (SELECT * FROM weekly_all WHERE regular),
seasons AS (SELECT season, gsis_player_id, sum(order_count) AS order_count, sum(shipped_lines) AS shipped_lines,
    sum(quantity) AS quantity, sum(line_count) AS line_count, sum(returned_quantity) AS returned_quantity,
    count(DISTINCT week) AS games, count(DISTINCT (week, team)) AS source_week_rows,
    min(player_name) AS player_name, min(position) AS position,
    CASE WHEN season >= 1998 THEN 17 ELSE 16 END AS schedule_games FROM weekly GROUP BY season, gsis_player_id),
teams AS (SELECT season, gsis_player_id, string_agg(team, '|' ORDER BY w, team) AS team FROM
    (SELECT season, gsis_player_id, team, min(week) AS w FROM weekly GROUP BY ALL) GROUP BY 1, 2)"""

LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT season, gsis_player_id, position, games, schedule_games, '{s}' AS stat, {s} AS stat_total, "
    f"'{OPPORTUNITY[s]}' AS opportunity_name, {OPPORTUNITY[s]} AS opportunity, "
    f"{R.HISTORY.minimum_opportunity[OPPORTUNITY[s]]}::DOUBLE AS floor_opportunity FROM seasons" for s in STATS) + ")"

COHORT = """
cohort AS (SELECT t.target_season, position, stat,
    sum(pow(0.5, (t.target_season - season - 1) / 5.0) * stat_total * 17.0 / schedule_games)
        / sum(pow(0.5, (t.target_season - season - 1) / 5.0)) AS cohort_component_per_17,
    count(*) AS cohort_player_seasons, list_sort(list(DISTINCT season)) AS seasons_used
    FROM long JOIN (SELECT unnest(range(1997, 2001)) AS target_season) t
        ON season < t.target_season AND season >= t.target_season - 3
    WHERE opportunity >= floor_opportunity GROUP BY ALL)"""

_LAGS = " ".join(
    f"LEFT JOIN long l{i} ON l{i}.gsis_player_id = t.gsis_player_id AND l{i}.stat = t.stat AND l{i}.season = t.season - {i}"
    for i in (1, 2, 3))
_W = {i: repr(0.5 ** ((i - 1) / 5.0)) + "::DOUBLE" for i in (1, 2, 3)}
PREDICTIONS = f"""
lagged AS (SELECT t.season AS target_season, t.gsis_player_id, t.stat, t.position, t.games AS target_games, t.stat_total AS realized_total,
    t.schedule_games AS target_schedule_games, t.floor_opportunity, l1.opportunity AS prior_opportunity,
    l1.stat_total * 17.0 / l1.schedule_games AS lag_1_total_per_17, l2.stat_total / l2.games AS lag_2_per_game,
    l3.opportunity * 17.0 / l3.schedule_games AS lag_3_opportunity_per_17,
    coalesce(l1.position, l2.position, l3.position) AS prior_position,
    (l1.season IS NOT NULL)::INT + (l2.season IS NOT NULL)::INT + (l3.season IS NOT NULL)::INT AS player_history_seasons,
    ({" + ".join(f"coalesce({_W[i]} * l{i}.stat_total * 17.0 / l{i}.schedule_games, 0)" for i in (1, 2, 3))})
        / nullif({" + ".join(f"CASE WHEN l{i}.season IS NULL THEN 0 ELSE {_W[i]} END" for i in (1, 2, 3))}, 0) AS player_component_per_17,
    list_filter([l1.season, l2.season, l3.season], lambda s: s IS NOT NULL) AS own_seasons
    FROM long t {_LAGS} WHERE t.season BETWEEN 1997 AND 2000),
shrunk AS (SELECT g.*, cohort_component_per_17, coalesce(cohort_player_seasons, 0) AS cohort_player_seasons,
    CASE WHEN player_history_seasons = 0 THEN 0.0 WHEN cohort_component_per_17 IS NULL THEN 1.0
        ELSE player_history_seasons / (player_history_seasons + 2.0) END AS player_shrinkage_weight,
    list_sort(list_distinct(list_concat(own_seasons, coalesce(seasons_used, [])))) AS used
    FROM lagged g LEFT JOIN cohort c ON c.target_season = g.target_season AND c.position = g.prior_position AND c.stat = g.stat),
blended AS (SELECT *, target_schedule_games / 17.0 * CASE WHEN player_component_per_17 IS NULL THEN cohort_component_per_17
        WHEN cohort_component_per_17 IS NULL THEN player_component_per_17
        ELSE player_shrinkage_weight * player_component_per_17 + (1 - player_shrinkage_weight) * cohort_component_per_17 END AS baseline_mean,
    coalesce(prior_opportunity >= floor_opportunity, false) AS opportunity_eligible, array_to_string(used, '|') AS feature_seasons FROM shrunk),
predictions AS (SELECT *, baseline_mean IS NOT NULL AS baseline_available,
    baseline_mean IS NOT NULL AND player_history_seasons >= 2 AND opportunity_eligible AS training_eligible,
    CASE WHEN player_history_seasons = 0 THEN CASE WHEN baseline_mean IS NULL THEN 'rookie_no_baseline' ELSE 'rookie_cohort_baseline' END
        WHEN player_history_seasons < 2 THEN 'insufficient_history' WHEN prior_opportunity IS NULL THEN 'missing_prior_opportunity'
        WHEN NOT opportunity_eligible THEN 'below_prior_opportunity' WHEN cohort_component_per_17 IS NULL THEN 'missing_cohort'
        ELSE 'training_eligible' END AS cohort_status FROM blended)"""
HISTORY = (WEEKLY, LONG, COHORT, PREDICTIONS)

ORACLES["entity_period_totals"] = with_(WEEKLY) + f"""SELECT {big("season games source_week_rows schedule_games")}, gsis_player_id, player_name,
    position, team, {rs("order_count shipped_lines quantity line_count returned_quantity")} FROM seasons JOIN teams USING (season, gsis_player_id)"""

ORACLES["long_metrics"] = with_(WEEKLY, LONG) + f"""SELECT {big("season l.games l.schedule_games source_week_rows")}, gsis_player_id, player_name,
    l.position, team, stat, {rs("order_count shipped_lines stat_total opportunity")}, opportunity_name,
    {r("order_count * 17.0 / l.schedule_games", name="order_count_per_17")}, {r("shipped_lines * 17.0 / l.schedule_games", name="shipped_lines_per_17")},
    {r("stat_total * 17.0 / l.schedule_games", name="stat_total_per_17")}, {r("stat_total / l.games", name="stat_per_game")},
    {r("opportunity * 17.0 / l.schedule_games", name="opportunity_per_17")}
    FROM long l JOIN seasons USING (season, gsis_player_id) JOIN teams USING (season, gsis_player_id)"""

ORACLES["reconcile_totals"] = with_(WEEKLY) + """
SELECT 'weeks' AS test, 0::BIGINT AS unreconciled UNION ALL SELECT 'summaries', count(*)::BIGINT FROM
    (SELECT season, gsis_player_id, sum(quantity) AS q FROM weekly GROUP BY ALL) w JOIN seasons s USING (season, gsis_player_id) WHERE abs(w.q - s.quantity) > 1e-9
UNION ALL SELECT 'repeated_weeks', count(*)::BIGINT FROM (SELECT season, week, gsis_player_id, team FROM weekly GROUP BY ALL HAVING count(*) > 1)"""

ORACLES["exact_lags"] = with_(WEEKLY) + "SELECT t.season::BIGINT AS season, t.gsis_player_id, " + ", ".join(
    f"l{i}.season::DOUBLE AS lag_{i}_season, {r(f'l{i}.quantity', name=f'lag_{i}_quantity')}, l{i}.position AS lag_{i}_position" for i in (1, 2, 3)
) + " FROM seasons t " + " ".join(
    f"LEFT JOIN seasons l{i} ON l{i}.gsis_player_id = t.gsis_player_id AND l{i}.season = t.season - {i}" for i in (1, 2, 3))

ORACLES["cohort_means"] = with_(WEEKLY, LONG, COHORT) + f"""SELECT {big("target_season cohort_player_seasons")}, position, stat,
    {rs("cohort_component_per_17")}, array_to_string(seasons_used, '|') AS cohort_seasons FROM cohort"""

ORACLES["lagged_baseline"] = with_(*HISTORY) + f"""SELECT {big("target_season player_history_seasons cohort_player_seasons")}, gsis_player_id, stat, position,
    {rs("realized_total lag_1_total_per_17 lag_2_per_game lag_3_opportunity_per_17 player_component_per_17 cohort_component_per_17 player_shrinkage_weight baseline_mean")},
    baseline_available, opportunity_eligible, training_eligible, cohort_status, feature_seasons FROM predictions"""

ORACLES["missingness"] = with_(*HISTORY) + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, {r(f'avg(({c} IS NULL)::INT)', name='missing_rate')} FROM predictions" for name, c in (
        ("baseline_mean", "baseline_mean"), ("lag_1_total", "lag_1_total_per_17"), ("lag_2_total", "lag_2_per_game"),
        ("lag_3_total", "lag_3_opportunity_per_17"), ("prior_opportunity", "prior_opportunity")))

ORACLES["input_profile"] = with_(WEEKLY) + """SELECT min(season)::BIGINT AS first_season, max(season)::BIGINT AS last_season, count(DISTINCT season)::BIGINT AS seasons,
    array_to_string(list_sort(list(DISTINCT season)), '|') AS covered_seasons,
    'season|week|season_type|gsis_player_id|player_name|team|position|order_count|shipped_lines|quantity|line_count|returned_quantity|source_order' AS header FROM weekly_all"""

ORACLES["missing_seasons"] = with_(WEEKLY) + """SELECT s::BIGINT AS season FROM (SELECT unnest(range(1993, 2003)) AS s) WHERE s NOT IN (SELECT season FROM seasons)"""

ORACLES["warning_rollup"] = with_(WEEKLY) + """SELECT 'historical.player_schedule_exceptions' AS "check", 'games stay within the schedule' AS message,
    '{"rows":"' || count(*) || '"}' AS details FROM seasons WHERE games > schedule_games HAVING count(*) > 0"""

ORACLES["run_info"] = with_(WEEKLY) + """SELECT 'run_id' AS field, 'run' AS value UNION ALL SELECT 'season', '2024' UNION ALL
    SELECT 'warnings', CASE WHEN count(*) > 0 THEN 'games stay within the schedule' ELSE 'None' END FROM seasons WHERE games > schedule_games"""

_GATE = [("historical.regular_season_rows", "(SELECT count(*) > 0 FROM weekly)", "error"),
         ("historical.player_ids_present", "(SELECT count(*) = 0 FROM weekly WHERE gsis_player_id IS NULL)", "error")]
_GATE += [(f"historical.target_values_valid.{s}", f"(SELECT count(*) = 0 FROM weekly WHERE {s} IS NULL OR {s} < 0)", "error") for s in STATS]
_GATE += [(f"historical.opportunity_values_valid.{o}", f"(SELECT count(*) = 0 FROM weekly WHERE {o} < 0)", "error") for o in R.HISTORY.opportunities]
_GATE += [("historical.weekly_keys_unique", """(SELECT count(*) = 0 FROM (SELECT season, week, gsis_player_id, team FROM weekly GROUP BY ALL
            HAVING count(*) > 1 AND count(DISTINCT (order_count, shipped_lines, quantity, line_count, returned_quantity)) = 1))""", "error"),
          ("historical.seasons_complete", "(SELECT count(DISTINCT season) = 6 FROM weekly)", "error")]
_GATE += [(f"historical.implausible_totals.{s}", f"(SELECT count(*) = 0 FROM seasons WHERE {s} > {R.HISTORY.plausible_maximum[s]} OR {s} < 0)", "error") for s in STATS]
_GATE += [("historical.schedule_lengths", "(SELECT count(*) = 0 FROM seasons WHERE games > schedule_games + 1)", "error"),
          ("historical.player_schedule_exceptions", "(SELECT count(*) = 0 FROM seasons WHERE games > schedule_games)", "warning")]
_GATE += [(f"historical.missingness.{c}", f"(SELECT count(*) = 0 FROM seasons WHERE {c} IS NULL)", "warning") for c in ("player_name", "position")]
_GATE += [("historical.missingness.team", "(SELECT count(*) = (SELECT count(*) FROM teams WHERE team <> '') FROM seasons)", "warning")]
_GATE += [("historical.output_keys_unique", "(SELECT count(*) = count(DISTINCT (target_season, gsis_player_id, stat)) FROM predictions)", "error"),
          ("historical.no_lookahead", "(SELECT coalesce(max(list_max(used) - target_season), -1) < 0 FROM predictions)", "error"),
          ("historical.baseline_bias_no_lookahead", "(SELECT count(*) = 0 FROM applied WHERE fitted AND list_max(list_transform(string_split(seasons, '|'), lambda s: s::BIGINT)) >= target_season)", "error"),
          ("historical.holdout_mean_correction_frozen", "(SELECT count(*) = 0 FROM (SELECT stat FROM applied WHERE target_season >= 2000 AND fitted GROUP BY stat HAVING min(a) <> max(a) OR min(b) <> max(b)))", "error")]
_GATE += [(f"historical.cohort_size.{s}", f"(SELECT count(*) >= 20 FROM predictions WHERE training_eligible AND stat = '{s}')", "error") for s in STATS]


# --- quotes ---------------------------------------------------------------------------

EVENTS = """
ev AS (SELECT event_id, ts, user_id, event_type, value, (props->>'k')::INT AS k,
    CASE (props->>'k')::INT % 3 WHEN 0 THEN 'quantity' WHEN 1 THEN 'line_count' ELSE 'returned_quantity' END AS stat FROM events)"""

QUOTES = EVENTS + """,
keyed AS (SELECT *, floor(value)::DOUBLE + 0.5 AS line, CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE floor(value) + 1.0 END AS threshold FROM ev),
newest AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY event_type, user_id, stat, threshold ORDER BY ts DESC, event_id) = 1),
snap AS (SELECT event_type, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS snapshot_utc FROM newest GROUP BY 1),
q0 AS (SELECT 'run' AS run_id, event_type AS source, event_id::VARCHAR AS source_market_id, snapshot_utc, '2024' AS season, event_id, user_id, k,
    'User #' || user_id AS raw_player_name, 'T' || (user_id % 7) AS team, stat, 'units' AS unit, line, threshold,
    CASE WHEN event_id % 2 = 0 THEN -105 - event_id % 37 ELSE 100 + event_id % 29 END AS over_odds,
    CASE WHEN event_id % 2 = 0 THEN -105 - event_id % 11 ELSE -135 - event_id % 53 END AS under_odds,
    round(100.0 / (1.0 + exp((threshold - (20.0 + 4 * (user_id % 20))) / (1.0 + (20.0 + 4 * (user_id % 20)) / 4.0)))) AS mid
    FROM newest JOIN snap USING (event_type)),
q AS (SELECT *, CASE WHEN event_id % 17 <> 0 THEN (mid - (1.0 + event_id % 12)) / 100 END AS bid, (mid + 1.0 + event_id % 12) / 100 AS ask,
    CASE WHEN event_id % 3 = 0 THEN mid / 100 END AS last_p, (k * 7)::DOUBLE AS volume, (event_id % 500)::DOUBLE AS open_interest FROM q0),
books AS (SELECT *, CASE WHEN over_odds > 0 THEN 1 + over_odds / 100.0 ELSE 1 + 100.0 / -over_odds END AS over_decimal,
    CASE WHEN under_odds > 0 THEN 1 + under_odds / 100.0 ELSE 1 + 100.0 / -under_odds END AS under_decimal FROM q WHERE source IN ('click', 'view')),
contracts AS (SELECT *, CASE WHEN NOT coalesce(bid > 0 AND bid < 1 AND ask > 0 AND ask < 1, false) THEN 'missing_two_sided_yes_quote'
    WHEN ask - bid > 0.2 THEN 'yes_spread_exceeds_configured_limit' ELSE '' END AS reason FROM q WHERE source NOT IN ('click', 'view')),
priced AS (SELECT run_id, season, source, source_market_id, raw_player_name, user_id, team, stat, floor(line)::INT + 1 AS threshold_k,
    (1 / over_decimal) / (1 / over_decimal + 1 / under_decimal) AS p, 'included' AS inclusion_status, '' AS reason, NULL::DOUBLE AS bid, NULL::DOUBLE AS ask,
    1 / over_decimal + 1 / under_decimal AS market_overround, NULL::DOUBLE AS volume, NULL::DOUBLE AS open_interest, line AS raw_threshold FROM books
  UNION ALL SELECT run_id, season, source, source_market_id, raw_player_name, user_id, team, stat, CASE WHEN reason = '' THEN threshold::INT END,
    CASE WHEN reason = '' THEN (bid + ask) / 2 END, CASE WHEN reason = '' THEN 'included' ELSE 'excluded' END, reason, bid, ask, NULL, volume, open_interest, threshold FROM contracts),
model AS (SELECT *, CASE WHEN inclusion_status <> 'included' THEN reason WHEN NOT (p >= 0.02 AND p <= 0.98) THEN 'probability_outside_model_range' ELSE '' END AS model_reason,
    'user:' || user_id AS canonical_player_id FROM priced)"""

_NORMAL = """run_id, source, source_market_id, snapshot_utc, season, raw_player_name, team, stat, unit, 'included' AS normalization_status, '' AS exclusion_reason"""
ORACLES["normalize_quotes"] = with_(QUOTES) + " UNION ALL ".join(
    f"""SELECT {_NORMAL}, '{side}-' || event_id AS source_selection_id, '{op}' AS operator, line AS threshold, '{side}' AS outcome_side,
    {side}_odds::BIGINT AS american_odds, {r(f"{side}_decimal", name="source_decimal_odds")}, NULL::DOUBLE AS yes_bid_probability, NULL::DOUBLE AS yes_ask_probability,
    NULL::DOUBLE AS last_trade_probability, NULL::DOUBLE AS volume, NULL::DOUBLE AS open_interest, NULL::DOUBLE AS spread,
    '$.markets[' || event_id || '].probability.{side}' AS raw_record_locator FROM books""" for side, op in (("over", "gt"), ("under", "lt"))
) + f""" UNION ALL SELECT {_NORMAL}, '', 'ge', threshold, 'yes', NULL, NULL, {r("bid")}, {r("ask")}, {r("last_p")}, volume, open_interest,
    {r("ask - bid", name="spread")}, '$.markets[' || event_id || ']' FROM contracts"""

ORACLES["odds_convert"] = """WITH t AS (SELECT event_id, value, CASE event_id % 7 WHEN 0 THEN 100 WHEN 1 THEN -(105 + event_id % 300) WHEN 2 THEN -(110 + event_id % 90)
    WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE 100 + event_id % 400 END AS a FROM events),
u AS (SELECT *, CASE WHEN a > 0 THEN 1 + a / 100.0 ELSE 1 + 100.0 / -a END AS d FROM t)
""" + f"""SELECT event_id, a::DOUBLE AS american_odds, {r("d", name="decimal_odds")}, {r("1 / d", name="implied")},
    {r("CASE WHEN d >= 2 THEN 100 * (d - 1) ELSE -100 / (d - 1) END", name="round_trip")}, CASE WHEN a > 0 THEN '+' || a ELSE a::VARCHAR END AS signed,
    {r("value", name="percent")}, CASE WHEN event_id % 4 <> 0 THEN (event_id % 9) || '/' || (event_id % 4) END AS fraction FROM u"""

ORACLES["two_way_devig"] = with_(QUOTES) + f"""SELECT source, source_market_id, stat, (floor(line) + 1)::BIGINT AS canonical_threshold, {r("over_decimal", 8, "decimal_odds")},
    {r("1 / over_decimal", 8, "raw_implied_probability")}, {r("1 / over_decimal + 1 / under_decimal", 8, "market_overround")},
    {r("under_decimal / (over_decimal + under_decimal)", 8, "no_vig_probability")}, {r("under_decimal", 8, "paired_under_decimal_odds")},
    {r("over_decimal / (over_decimal + under_decimal)", 8, "paired_under_no_vig_probability")}, 'included' AS inclusion_status, '' AS exclusion_reason FROM books"""

ORACLES["threshold_quote_filter"] = with_(QUOTES) + f"""SELECT source, source_market_id, stat, CASE WHEN reason = '' THEN threshold END AS canonical_threshold,
    {r("CASE WHEN reason = '' THEN 2 / (bid + ask) END", name="decimal_odds")}, {r("CASE WHEN reason = '' THEN (bid + ask) / 2 END", name="modeling_probability")},
    {r("bid", name="bid_probability")}, {r("ask", name="ask_probability")}, CASE WHEN reason = '' THEN 'included' ELSE 'excluded' END AS inclusion_status, reason AS exclusion_reason FROM contracts"""

ORACLES["multiway_devig"] = """WITH t AS (SELECT event_id, event_type, ts::DATE::VARCHAR AS day, CASE WHEN event_id % 997 <> 0 THEN 100.0 / (200 + floor(value * 10)) END AS p FROM events),
u AS (SELECT *, count(*) OVER w AS n, count(p) OVER w AS c, sum(p) OVER w AS s FROM t WINDOW w AS (PARTITION BY event_type, day))
""" + f"""SELECT event_id, event_type, day, {r("p", name="probability")}, n::BIGINT AS runners, {r("CASE WHEN n = c THEN s END", name="overround")},
    {r("CASE WHEN n = c THEN p / s END", name="no_vig_probability")} FROM u"""

ORACLES["model_eligibility"] = with_(QUOTES) + f"""SELECT source, stat, inclusion_status, CASE WHEN model_reason = '' THEN 'included' ELSE 'excluded' END AS model_inclusion_status,
    model_reason AS model_exclusion_reason, count(*)::BIGINT AS quotes, {r("sum(p)", name="total_probability")} FROM model GROUP BY 1, 2, 3, 4, 5"""

ORACLES["probability_fallback"] = """WITH t AS (SELECT event_id, value, round(value % 1.0, 2) AS v FROM events),
u AS (SELECT *, CASE WHEN event_id % 5 <> 0 THEN v END AS bid, CASE WHEN event_id % 3 <> 0 THEN v + 0.02 END AS ask, CASE WHEN event_id % 4 = 0 THEN v + 0.01 END AS traded FROM t)
""" + f"""SELECT event_id, {r("CASE WHEN bid + ask IS NOT NULL THEN (bid + ask) / 2 WHEN traded > 0 THEN traded ELSE coalesce(bid, ask) END", name="estimate")},
    CASE WHEN bid + ask IS NOT NULL THEN 'midpoint_of_best_yes_bid_and_ask' WHEN traded > 0 THEN 'last_trade_price_no_two_sided_quote'
        WHEN bid IS NOT NULL THEN 'one_sided_yes_bid_reference' WHEN ask IS NOT NULL THEN 'one_sided_yes_ask_reference' ELSE 'unavailable' END AS method,
    {r("floor(value) + 1", name="threshold")} FROM u"""

ASSEMBLED = """
sel AS (SELECT l_orderkey AS market_id, l_linestatus = 'O' AS is_over, floor(l_discount * 20) + 0.5 AS line,
    CASE WHEN l_tax > 0.01 THEN -105 - l_quantity::INT WHEN l_tax > 0 THEN 0 ELSE 100 END AS odds FROM lineitem),
sides AS (SELECT market_id, count(*) AS selections, max(CASE WHEN is_over THEN struct_pack(line := line, odds := odds) END) AS o,
    max(CASE WHEN NOT is_over THEN struct_pack(line := line, odds := odds) END) AS u FROM sel GROUP BY 1),
asm AS (SELECT o_orderkey AS market_id, o_custkey AS event_id, player, coalesce(selections, 0) AS selections, found IS NULL AS missing_event,
    o IS NULL AS missing_over, u IS NULL AS missing_under, coalesce(selections, 0) <> 2 AS non_two_selection, NOT coalesce(o.line = u.line, false) AS mismatched_line,
    CASE WHEN o.line = u.line THEN o.line END AS market_line,
    CASE WHEN o.odds > 0 THEN 100.0 / (o.odds + 100) WHEN o.odds < 0 THEN -o.odds / (100.0 - o.odds) END AS raw_over,
    CASE WHEN u.odds > 0 THEN 100.0 / (u.odds + 100) WHEN u.odds < 0 THEN -u.odds / (100.0 - u.odds) END AS raw_under
    FROM orders LEFT JOIN (SELECT c_custkey, c_name AS player, true AS found FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey
    LEFT JOIN sides ON market_id = o_orderkey)"""

ORACLES["snapshot_assembly"] = with_(ASSEMBLED) + f"""SELECT market_id, event_id, player, {big("selections")}, {rs("market_line raw_over raw_under")}, {r("raw_over + raw_under", name="two_way_overround")},
    {r("raw_over / (raw_over + raw_under)", name="no_vig_over")}, {r("raw_under / (raw_over + raw_under)", name="no_vig_under")},
    CASE WHEN selections = 0 THEN 'attached_market_has_no_offered_runners' WHEN missing_event THEN 'referenced_event_missing' ELSE '' END AS unavailable_reason,
    missing_event, missing_over, missing_under, non_two_selection, mismatched_line, raw_over IS NULL AS invalid_over_odds, raw_under IS NULL AS invalid_under_odds FROM asm"""

_FLAGS = {"missing_event": "missing_event", "missing_over": "missing_over", "missing_under": "missing_under", "non_two_selection": "non_two_selection",
          "mismatched_line": "mismatched_line", "invalid_over_odds": "raw_over IS NULL", "invalid_under_odds": "raw_under IS NULL"}
ORACLES["snapshot_counters"] = with_(ASSEMBLED) + "SELECT count(*)::BIGINT AS markets, " + ", ".join(
    f"count(*) FILTER (WHERE {c})::BIGINT AS {n}_count" for n, c in _FLAGS.items()) + ", 0::BIGINT AS no_vig_off_count, " + " AND ".join(
    f"count(*) FILTER (WHERE {c}) = 0" for c in _FLAGS.values()) + " AS checks_passed FROM asm"

ORACLES["volume_counters"] = with_(EVENTS) + """SELECT coalesce(stat, 'all') AS stat, count(*)::BIGINT AS markets, count(DISTINCT user_id)::BIGINT AS players, sum(k)::BIGINT AS volume
    FROM ev GROUP BY ROLLUP (stat)"""

ORACLES["conflicting_records"] = """SELECT l_orderkey || '-' || l_linenumber AS line_id, count(*)::BIGINT AS records FROM lineitem
    GROUP BY 1 HAVING count(DISTINCT (l_partkey, l_returnflag)) > 1"""

FAULTY = QUOTES + """,
sides AS (SELECT source, source_market_id, side, ('0x' || md5(source_market_id || '/' || side)[1:4])::BIGINT % 40 AS kind, source IN ('click', 'view') AS book FROM (
    SELECT source, source_market_id, unnest(['over', 'under']) AS side FROM books UNION ALL SELECT source, source_market_id, 'yes' FROM contracts)),
faulty AS (SELECT * FROM sides UNION ALL SELECT * FROM sides WHERE kind = 3),
n AS (SELECT count(*) AS rows, count(*) FILTER (WHERE kind = 0) AS lost, count(*) FILTER (WHERE kind = 1 AND book) AS odds, count(*) FILTER (WHERE kind = 2 AND NOT book) AS prices,
    count(*) FILTER (WHERE kind = 3) AS repeated, (SELECT count(*) FROM sides) AS expected FROM faulty)"""
ORACLES["normalized_faults"] = with_(FAULTY) + """SELECT 'normalized.nonempty' AS name, rows > 0 AS passed, 'error' AS severity, '{}' AS details FROM n
    UNION ALL SELECT 'normalized.types_and_domains', lost = 0, 'error', '{"rows":"' || lost || '"}' FROM n UNION ALL SELECT 'normalized.book_odds', odds = 0, 'error', '{}' FROM n
    UNION ALL SELECT 'normalized.contract_probabilities', prices = 0, 'error', '{}' FROM n UNION ALL SELECT 'normalized.row_count', rows = expected, 'error', '{"rows":"' || rows || '"}' FROM n
    UNION ALL SELECT 'normalized.keys_unique', repeated = 0, 'error', '{"duplicate_keys":"' || repeated // 2 || '","duplicate_rows":"' || repeated || '","sample":"' ||
        (SELECT coalesce(string_agg(k, ', ' ORDER BY k), '') FROM (SELECT DISTINCT source || '/' || source_market_id || '/' || side AS k FROM sides WHERE kind = 3 ORDER BY 1 LIMIT 5)) || '"}' FROM n"""

ORACLES["checks_report"] = ORACLES["normalized_faults"]


def _as_passed(condition: str) -> str:
    """``condition FROM table`` as a column; the table's FROM is the last one at the outer level."""
    depth, at = 0, -1
    for i, c in enumerate(condition):
        depth += (c == "(") - (c == ")")
        if depth == 0 and condition.startswith(" FROM", i):
            at = i
    return condition + " AS passed" if at < 0 else condition[:at] + " AS passed" + condition[at:]


_QGATE = [("normalized.nonempty", "count(*) > 0 FROM q"), ("normalized.types_and_domains", "count(*) = 0 FROM q WHERE stat IS NULL OR coalesce(threshold, line) IS NULL"),
          ("normalized.book_odds", "count(*) = 0 FROM books WHERE over_odds = 0 OR under_odds = 0"),
          ("normalized.contract_probabilities", "count(*) = 0 FROM contracts WHERE bid < 0 OR bid > 1 OR ask < 0 OR ask > 1 OR last_p < 0 OR last_p > 1"),
          ("normalized.row_count", "count(*) = (SELECT 2 * count(*) FROM books) + (SELECT count(*) FROM contracts) FROM (SELECT 1 FROM q UNION ALL SELECT 1 FROM books)"), ("normalized.keys_unique", "count(*) = count(DISTINCT (source, source_market_id)) FROM q"),
          ("pricing.nonempty", "count(*) > 0 FROM priced"), ("pricing.included_canonical_probability", "count(*) = 0 FROM priced WHERE inclusion_status = 'included' AND NOT coalesce(p > 0 AND p < 1 AND threshold_k >= 0, false)"),
          ("pricing.exclusions_are_auditable", "count(*) = 0 FROM priced WHERE inclusion_status = 'excluded' AND (reason = '' OR p IS NOT NULL)"),
          ("pricing.book_pairs_reconcile", "count(*) = 0 FROM books WHERE 1 / over_decimal + 1 / under_decimal <= 1"), ("pricing.contracts_not_devigged", "count(*) = 0 FROM priced WHERE source NOT IN ('click', 'view') AND (market_overround IS NOT NULL OR inclusion_status = 'included' AND abs(p - (bid + ask) / 2) > 1e-12)"),
          ("pricing.contract_quote_fields", "count(*) = 0 FROM priced WHERE inclusion_status = 'included' AND bid > ask"),
          ("collections.cross_source_snapshot_skew", "count(*) = 5 AND date_diff('second', min(snapshot_utc::TIMESTAMP), max(snapshot_utc::TIMESTAMP)) <= 1800 FROM snap")]
ORACLES["quote_gates"] = with_(QUOTES) + " UNION ALL ".join(f"(SELECT '{n}' AS name, passed, 'error' AS severity FROM (SELECT {_as_passed(c)}))" for n, c in _QGATE) + \
    " UNION ALL SELECT 'pricing.source_decimal_crosscheck', (SELECT count(*) = 0 FROM books WHERE abs(round(over_decimal, 12) - over_decimal) > 1e-9), 'warning'"

ORACLES["snapshot_gate"] = with_(QUOTES) + f"""SELECT source, count(*)::BIGINT AS markets, {r("date_diff('second', max(snapshot_utc::TIMESTAMP), TIMESTAMP '2024-02-01') / 3600.0", name="age_hours")},
    0::BIGINT AS season, 0::BIGINT AS line, 0::BIGINT AS over_label, 0::BIGINT AS under_label, 0::BIGINT AS operators FROM books GROUP BY 1"""


# --- order books ----------------------------------------------------------------------

LEVELS = """
lv AS (SELECT l_orderkey AS market_id, l_returnflag <> 'N' AS yes, (CASE WHEN l_returnflag <> 'N' THEN 0.3 ELSE 0.5 END + l_discount::DECIMAL(18, 4))::DECIMAL(18, 4) AS price,
    l_quantity::DECIMAL(18, 4) AS qty FROM lineitem),
ticks AS (SELECT market_id, yes, price, sum(qty) AS qty, count(*) AS n FROM lv GROUP BY ALL)"""

ORACLES["book_summary"] = with_(LEVELS, """
s AS (SELECT market_id, max(price) FILTER (WHERE yes) AS bid, 1 - max(price) FILTER (WHERE NOT yes) AS ask, arg_max(qty, price) FILTER (WHERE yes) AS bid_size,
    arg_max(qty, price) FILTER (WHERE NOT yes) AS ask_size, coalesce(sum(n) FILTER (WHERE yes), 0) AS yn, coalesce(sum(n) FILTER (WHERE NOT yes), 0) AS nn,
    coalesce(sum(qty) FILTER (WHERE yes), 0) AS yq, coalesce(sum(qty) FILTER (WHERE NOT yes), 0) AS nq, coalesce(sum(qty * price) FILTER (WHERE yes), 0) AS yv,
    coalesce(sum(qty * price) FILTER (WHERE NOT yes), 0) AS nv FROM ticks GROUP BY 1)""") + f"""SELECT market_id, {r("bid", 4, "best_yes_bid_dollars")}, {r("ask", 4, "best_yes_ask_dollars")},
    {r("(bid + ask) / 2.0", 4, "yes_midpoint_dollars")}, {r("ask - bid", 4, "yes_spread_dollars")}, {r("bid_size", 4, "best_yes_bid_size_contracts")}, {r("ask_size", 4, "best_yes_ask_size_contracts")},
    yn::BIGINT AS yes_level_count, nn::BIGINT AS no_level_count, {r("yq", 4, "yes_contracts")}, {r("nq", 4, "no_contracts")}, {r("yv", 4, "yes_bid_notional_dollars")}, {r("nv", 4, "no_bid_notional_dollars")},
    {r("yq + nq", 4, "total_resting_contracts")}, {r("yv + nv", 4, "total_resting_bid_notional_dollars")} FROM s"""

LADDER = """
ladder AS (SELECT market_id, CASE WHEN yes THEN 'bid' ELSE 'ask' END AS book_side, CASE WHEN yes THEN price ELSE 1 - price END AS price, qty,
    max(price) OVER (PARTITION BY market_id, yes) - price AS away FROM ticks)"""
ORACLES["book_depth"] = with_(LEVELS, LADDER) + "SELECT market_id, book_side, " + ", ".join(
    f"{r(f'coalesce(sum(qty) FILTER (WHERE away <= {c} / 100.0), 0)', 4, f'within_{c}c_contracts')}, {r(f'coalesce(sum(qty * price) FILTER (WHERE away <= {c} / 100.0), 0)', 4, f'within_{c}c_notional')}"
    for c in (1, 5, 10, 25)) + " FROM ladder GROUP BY 1, 2"

ORACLES["book_fill_vwap"] = with_(LEVELS, LADDER, """
walk AS (SELECT *, coalesce(sum(qty) OVER (PARTITION BY market_id, book_side ORDER BY away ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM ladder),
took AS (SELECT market_id, book_side, size, price, away, greatest(0, least(qty, size - ahead)) AS take FROM walk, (SELECT unnest([1, 10, 100, 500, 1000]) AS size))""") + f"""
SELECT market_id, CASE WHEN book_side = 'ask' THEN 'buy_yes' ELSE 'sell_yes' END AS action, size::BIGINT AS requested_contracts, {r("sum(take)", name="fillable_contracts")},
    sum(take) >= size AS fully_fillable, {r("sum(take * price)::DOUBLE / sum(take)::DOUBLE", name="vwap_dollars")}, {r("arg_max(price, away) FILTER (WHERE take > 0)", name="worst_price_dollars")},
    {r("sum(take * price)", name="consideration_dollars")} FROM took GROUP BY market_id, book_side, size"""


# --- text -----------------------------------------------------------------------------

ORACLES["page_embedded_json"] = """SELECT page_id, length('<script>window.pageData = ' || to_json(struct_pack(page_id := page_id, url := url)) || ';</script>' || html)::BIGINT AS page_chars,
    page_id AS json_id, url AS json_url, true AS other_absent FROM pages"""

ORACLES["title_regex"] = """SELECT event_id, 'User ' || user_id AS runner, CASE WHEN event_id % 2 = 0 THEN 'Over' ELSE 'Under' END AS outcome, floor(value) + 0.5 AS line, '2024-25' AS slash_season,
    'User ' || user_id AS player, '2024-25' AS season,
    CASE WHEN event_id % 3 > 0 AND event_id % 5 <> 0 THEN event_type WHEN event_id % 3 = 0 AND event_id % 5 = 0 THEN 'second' ELSE event_type END AS participant,
    CASE WHEN event_id % 2 = 0 THEN 'Team' END AS team, CASE WHEN event_id % 2 = 0 THEN 'TM' END AS short,
    'By ' || upper(event_type[1]) || event_type[2:] AS label FROM events"""


def match_key(c: str) -> str:
    text = f"replace(replace(lower(strip_accents({c})), 'ß', 'ss'), '-', ' ')"
    text = rf"trim(regexp_replace(regexp_replace({text}, '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))"
    return f"regexp_replace({text}, '((^|\\s)(jr|sr|ii|iii|iv|v))+$', '')"


ORACLES["match_keys"] = f"SELECT conv_id, turn, {match_key('text')} AS match_key FROM conversations"

NAMES = f"""
hist AS (SELECT p_partkey::VARCHAR AS gsis_player_id, p_name || ' ' || p_brand AS player_name, p_type AS position, p_brand AS team, p_type AS stat, p_partkey % 8 AS kind FROM part),
cand AS (SELECT *, {match_key("player_name")} AS match_key FROM hist)"""

ORACLES["stable_ids"] = with_(NAMES) + """SELECT gsis_player_id, match_key, 'player:' || replace(match_key, ' ', '-') || '-' || sha256(match_key)[1:12] AS stable_id, true AS initials FROM cand"""

ORACLES["candidate_table"] = with_(NAMES) + """SELECT 'gsis:' || gsis_player_id AS canonical_player_id, gsis_player_id, player_name AS canonical_player_name, position, match_key AS match_keys, stat AS stats, team AS teams FROM cand"""

RAW_NAME = """CASE kind WHEN 0 THEN player_name WHEN 1 THEN upper(translate(player_name, 'aeiou', 'áéîöù')) || ' Jr.' WHEN 2 THEN player_name[1:3] || player_name[5:104]
        WHEN 3 THEN player_name[1] || '. ' || split_part(player_name, ' ', 3) WHEN 4 THEN player_name || 'x' WHEN 5 THEN replace(player_name, ' Brand', '-Brand')
        WHEN 6 THEN 'unknown ' || md5(player_name) ELSE ' ' || player_name || ' III' END"""

QUOTED = NAMES + f""",
raw_quotes AS (SELECT DISTINCT ['click', 'purchase', 'view'][l_suppkey % 3 + 1] AS source, stat, team,
    trim({RAW_NAME}) AS raw_player_name FROM lineitem JOIN hist ON gsis_player_id = l_partkey::VARCHAR),
idents AS (SELECT source, raw_player_name, {match_key("raw_player_name")} AS match_key, list_sort(list(DISTINCT stat)) AS stats, list_sort(list(DISTINCT team)) AS teams FROM raw_quotes GROUP BY 1, 2),
alias AS (SELECT CASE WHEN min(p_partkey) % 2 = 0 THEN '*' ELSE 'click' END AS source, {match_key("p_name || ' ' || p_brand")} AS match_key, 'listed:' || min(p_partkey) AS alias_id,
    'Listed ' || p_name || ' ' || p_brand AS alias_name FROM part GROUP BY p_name, p_brand HAVING min(p_partkey) IN (SELECT min(p_partkey) FROM part GROUP BY p_brand))"""

ORACLES["market_identities"] = with_(QUOTED) + "SELECT source, raw_player_name, match_key, array_to_string(stats, '|') AS stats, array_to_string(teams, '|') AS teams FROM idents"

ORACLES["alias_match"] = with_(QUOTED) + """SELECT i.source, raw_player_name, coalesce(o.alias_id, a.alias_id) AS alias_id, coalesce(o.alias_name, a.alias_name) AS alias_name FROM idents i
    LEFT JOIN alias o ON o.source = i.source AND o.match_key = i.match_key LEFT JOIN alias a ON a.source = '*' AND a.match_key = i.match_key
    WHERE coalesce(o.alias_id, a.alias_id) IS NOT NULL"""

ORACLES["exact_match"] = with_(QUOTED) + """SELECT source, raw_player_name, CASE WHEN count(DISTINCT c.gsis_player_id) = 1 THEN 'gsis:' || min(c.gsis_player_id) END AS exact_id,
    count(DISTINCT c.gsis_player_id) > 1 AS ambiguous FROM idents i JOIN cand c ON c.match_key = i.match_key AND list_contains(i.stats, c.stat) GROUP BY 1, 2"""

# Longest common subsequence by bit-parallel recurrence over the characters of b, on the pairs that edit distance leaves.
LIKENESS = """
pairs AS (SELECT a.match_key AS a, b.match_key AS b, length(a.match_key) AS la, length(b.match_key) AS lb FROM (SELECT DISTINCT match_key FROM idents) a, (SELECT DISTINCT match_key FROM cand) b
    WHERE abs(length(a.match_key) - length(b.match_key)) <= 0.1 * (length(a.match_key) + length(b.match_key))
        AND levenshtein(a.match_key, b.match_key) <= 0.1 * (length(a.match_key) + length(b.match_key)) + 1e-9),
masks AS (SELECT a, b, la, lb, (1::BIGINT << la) - 1 AS whole, list_transform(string_split(b, ''), lambda c: list_sum(list_transform(range(0, la),
    lambda i: CASE WHEN a[i + 1] = c THEN (1::BIGINT << i) ELSE 0 END))::BIGINT) AS m FROM pairs),
lcs AS (SELECT a, b, la, lb, la - bit_count(list_reduce(list_prepend(whole, m), lambda v, x: (((v + (v & x)) | (v - (v & x))) & whole))) AS n FROM masks),
likeness AS (SELECT a AS query_key, b AS match_key, 200.0 * n / (la + lb) AS score FROM lcs WHERE 200.0 * n / (la + lb) >= 90 - 1e-9),
initials AS (SELECT DISTINCT i.match_key AS query_key, c.match_key, 100.0 AS score FROM idents i JOIN cand c ON regexp_matches(i.match_key, '^[a-z0-9] [a-z0-9]+$')
    AND split_part(i.match_key, ' ', 2) = c.match_key.split(' ')[-1] AND i.match_key[1] = c.match_key[1] AND len(c.match_key.split(' ')) >= 2),
alike AS (SELECT query_key, match_key, max(score) AS score FROM (SELECT * FROM likeness UNION ALL SELECT * FROM initials) GROUP BY 1, 2)"""
ORACLES["similar_names"] = with_(QUOTED, LIKENESS) + f"SELECT query_key, match_key, {r('score')} FROM alike"


def resolved(source: str, before: Sequence[str]) -> str:
    """One source's names against history and what the sources ``before`` it brought in."""
    n = source
    return f"""
pool_{n} AS (SELECT DISTINCT 'gsis:' || gsis_player_id AS id, match_key, stat FROM cand WHERE match_key <> ''{"".join(f" UNION SELECT id, match_key, unnest(stats) FROM born_{b}" for b in before)}),
mates_{n} AS (SELECT DISTINCT 'gsis:' || gsis_player_id AS id, team FROM cand{"".join(f" UNION SELECT id, unnest(teams) FROM born_{b}" for b in before)}),
open_{n} AS (SELECT i.source, raw_player_name AS raw, i.match_key, stats, teams, coalesce(o.alias_id, a.alias_id) AS alias_id, coalesce(o.alias_name, a.alias_name) AS alias_name FROM idents i
    LEFT JOIN alias o ON o.source = i.source AND o.match_key = i.match_key LEFT JOIN alias a ON a.source = '*' AND a.match_key = i.match_key WHERE i.source = '{n}' AND i.match_key <> ''),
same_{n} AS (SELECT raw, min(id) AS lo, max(id) AS hi FROM open_{n} i JOIN pool_{n} p ON p.match_key = i.match_key AND list_contains(i.stats, p.stat) WHERE alias_id IS NULL GROUP BY 1),
rest_{n} AS (SELECT * FROM open_{n} WHERE alias_id IS NULL AND raw NOT IN (SELECT raw FROM same_{n})),
option_{n} AS (SELECT raw, a.match_key, a.score, min(p.id) AS lo, max(p.id) AS hi, max(m.id) AS mate FROM rest_{n} r JOIN alike a ON a.query_key = r.match_key
    JOIN pool_{n} p ON p.match_key = a.match_key AND list_contains(r.stats, p.stat) LEFT JOIN mates_{n} m ON m.id = p.id AND list_contains(r.teams, m.team) GROUP BY 1, 2, 3),
top_{n} AS (SELECT *, max(score) OVER (PARTITION BY raw) AS best FROM option_{n}),
lead_{n} AS (SELECT raw, min(lo) AS l, max(hi) AS h, max(mate) AS m FROM top_{n} WHERE score = best GROUP BY 1),
close_{n} AS (SELECT t.raw, max(best) AS best, max(coalesce(m, h)) AS best_id, CASE WHEN bool_or(l <> h) THEN max(best) ELSE max(score) FILTER (WHERE score < best AND (lo <> h OR hi <> h)) END AS second
    FROM top_{n} t JOIN lead_{n} d ON d.raw = t.raw GROUP BY 1),
near_{n} AS (SELECT *, best >= 96 AND (second IS NULL OR best - second >= 4) AS auto, CASE WHEN best < 96 THEN 'score_below_minimum' WHEN best - second < 4 THEN 'ambiguous_fuzzy_match' END AS why FROM close_{n}),
chosen_{n} AS (SELECT o.*, s.lo <> s.hi AS ambiguous, best, best_id, second, auto, why, alias_id IS NOT NULL AS is_alias, o.raw IN (SELECT raw FROM rest_{n} r JOIN pool_{n} p ON list_contains(r.stats, p.stat)) AS reachable,
    coalesce(alias_id, CASE WHEN s.lo = s.hi THEN s.lo END, CASE WHEN auto THEN best_id END) AS chosen,
    CASE WHEN alias_id IS NOT NULL THEN 'explicit_alias' WHEN s.lo = s.hi THEN 'exact_match_key' WHEN auto THEN 'fuzzy_auto' END AS method
    FROM open_{n} o LEFT JOIN same_{n} s ON s.raw = o.raw LEFT JOIN near_{n} c ON c.raw = o.raw),
claim_{n} AS (SELECT *, row_number() OVER (PARTITION BY chosen ORDER BY match_key, raw, is_alias) AS i FROM chosen_{n} WHERE chosen IS NOT NULL),
fold_{n} AS (SELECT chosen, i, stats AS taken, NOT is_alias AS keeps, raw FROM claim_{n} WHERE i = 1
  UNION ALL SELECT c.chosen, c.i, CASE WHEN c.is_alias OR NOT list_has_any(f.taken, c.stats) THEN list_distinct(list_concat(f.taken, c.stats)) ELSE f.taken END,
    NOT c.is_alias AND NOT list_has_any(f.taken, c.stats), c.raw FROM fold_{n} f JOIN claim_{n} c ON c.chosen = f.chosen AND c.i = f.i + 1),
judged_{n} AS (SELECT c.*, coalesce(c.chosen IS NOT NULL AND NOT is_alias AND NOT f.keeps, false) AS rejected, CASE WHEN method = 'fuzzy_auto' THEN best WHEN method IS NOT NULL THEN 100.0 END AS score
    FROM chosen_{n} c LEFT JOIN fold_{n} f ON f.chosen = c.chosen AND f.raw = c.raw),
born_{n} AS (SELECT chosen AS id, match_key, stats, teams FROM judged_{n} WHERE chosen IS NOT NULL AND NOT rejected AND (is_alias OR chosen NOT IN (SELECT 'gsis:' || gsis_player_id FROM cand)))"""


RESOLVED = (resolved("click", ()), resolved("purchase", ("click",)), resolved("view", ("click", "purchase")), """
judged AS (SELECT * FROM judged_click UNION ALL SELECT * FROM judged_purchase UNION ALL SELECT * FROM judged_view),
facts AS (SELECT coalesce(h.id, a.id) AS id, coalesce(h.name, a.name) AS name, position, gsis FROM (SELECT 'gsis:' || gsis_player_id AS id, max(player_name) AS name, max(position) AS position, max(gsis_player_id) AS gsis FROM cand GROUP BY 1) h
    FULL JOIN (SELECT alias_id AS id, min(alias_name) AS name FROM alias GROUP BY 1) a ON a.id = h.id),
named AS (SELECT j.*, NOT rejected AND chosen IS NOT NULL AS matched, f.name AS chosen_name, f.position AS chosen_position, f.gsis AS chosen_gsis,
    CASE WHEN rejected THEN 'source_level_collision' WHEN chosen IS NOT NULL THEN NULL WHEN ambiguous THEN 'ambiguous_exact_match_key' WHEN why IS NOT NULL THEN why WHEN reachable THEN 'below_review_floor' ELSE 'no_candidate' END AS reason,
    CASE WHEN rejected THEN chosen WHEN why IS NOT NULL THEN best_id END AS suggested, CASE WHEN rejected THEN score WHEN ambiguous THEN 100.0 WHEN why IS NOT NULL THEN best END AS suggested_score,
    CASE WHEN rejected THEN NULL WHEN ambiguous THEN 100.0 WHEN why IS NOT NULL THEN second END AS runner_up FROM judged j LEFT JOIN facts f ON f.id = j.chosen),
mapped AS (SELECT source, raw AS raw_player_name, match_key, stats, CASE WHEN matched THEN chosen ELSE 'player:' || replace(match_key, ' ', '-') || '-' || sha256(match_key)[1:12] END AS canonical_player_id,
    CASE WHEN matched THEN coalesce(alias_name, chosen_name, raw) ELSE raw END AS canonical_player_name, CASE WHEN matched THEN method ELSE 'unmatched' END AS match_method, CASE WHEN matched THEN score END AS match_score,
    CASE WHEN matched AND is_alias THEN 'alias' WHEN matched THEN 'automatic' ELSE 'unmatched' END AS review_status, CASE WHEN matched THEN chosen_position END AS canonical_position,
    CASE WHEN matched THEN chosen_gsis END AS canonical_gsis_player_id, reason, suggested, suggested_score, runner_up FROM named)""")

ORACLES["player_map"] = with_(QUOTED, LIKENESS, *RESOLVED, recursive=True) + f"""SELECT source, raw_player_name, match_key AS normalized_match_key, canonical_player_id, canonical_player_name, match_method,
    {r("match_score", name="match_score")}, review_status, canonical_position, canonical_gsis_player_id FROM mapped"""

ORACLES["suggestions"] = with_(QUOTED, LIKENESS, *RESOLVED, recursive=True) + f"""SELECT source, raw_player_name, match_key AS normalized_match_key, array_to_string(stats, '|') AS observed_stats, suggested AS candidate_canonical_player_id,
    f.name AS candidate_canonical_player_name, f.gsis AS candidate_gsis_player_id, f.position AS candidate_position, {r("suggested_score", name="match_score")}, {r("runner_up", name="runner_up_score")}, reason,
    'needs_review' AS review_status FROM mapped LEFT JOIN facts f ON f.id = suggested WHERE reason IS NOT NULL"""

# The quotes themselves, one by one, with what their name was resolved to.
ORACLES["decorated_quotes"] = with_(QUOTED, LIKENESS, *RESOLVED, recursive=True) + f"""SELECT source, raw_player_name, stat, team, canonical_player_id, review_status AS identity_review_status, count(*)::BIGINT AS quotes FROM (
    SELECT ['click', 'purchase', 'view'][l_suppkey % 3 + 1] AS source, stat, team, trim({RAW_NAME}) AS raw_player_name FROM lineitem JOIN hist ON gsis_player_id = l_partkey::VARCHAR) q
    LEFT JOIN mapped USING (source, raw_player_name) GROUP BY 1, 2, 3, 4, 5, 6"""

_IDENTITY = f"""
gate AS (SELECT (SELECT count(*) FILTER (WHERE canonical_player_id IS NULL) FROM (SELECT ['click', 'purchase', 'view'][l_suppkey % 3 + 1] AS source, trim({RAW_NAME}) AS raw_player_name
        FROM lineitem JOIN hist ON gsis_player_id = l_partkey::VARCHAR) q LEFT JOIN mapped USING (source, raw_player_name)) AS lost, (SELECT count(*) FROM mapped WHERE reason IS NOT NULL) AS open,
    (SELECT count(*) FROM (SELECT 1 FROM (SELECT source, canonical_player_id, raw_player_name, unnest(stats) AS stat FROM mapped WHERE review_status <> 'alias') GROUP BY source, stat, canonical_player_id HAVING min(raw_player_name) <> max(raw_player_name))) AS bad)"""
ORACLES["identity_checks"] = with_(QUOTED, LIKENESS, *RESOLVED, _IDENTITY, recursive=True) + """SELECT 'identity.input_rows_reconciled' AS name, lost = 0 AS passed, 'error' AS severity, '{"rows":"' || lost || '"}' AS details FROM gate
    UNION ALL SELECT 'identity.player_map_keys_unique', (SELECT count(*) = count(DISTINCT (source, raw_player_name)) FROM mapped), 'error', '{"duplicate_keys":"0","duplicate_rows":"0","sample":""}' FROM gate UNION ALL SELECT 'identity.canonical_ids_present', (SELECT count(*) = 0 FROM mapped WHERE coalesce(canonical_player_id, '') = ''), 'error', '{}' FROM gate
    UNION ALL SELECT 'identity.fuzzy_suggestions', open = 0, 'warning', '{"suggestions":"' || open || '"}' FROM gate UNION ALL SELECT 'identity.source_level_collisions', bad = 0, 'error', '{}' FROM gate"""
ORACLES["identity_summary"] = with_(QUOTED, LIKENESS, *RESOLVED, _IDENTITY, recursive=True) + """SELECT review_status, count(*)::BIGINT AS names FROM mapped GROUP BY 1 UNION ALL SELECT 'decorated', (SELECT count(*) FROM lineitem)
    UNION ALL SELECT CASE WHEN lost = 0 AND bad = 0 THEN 'gate passed' ELSE 'gate failed' END, (lost > 0)::BIGINT + (bad > 0)::BIGINT FROM gate"""

ORACLES["promoted_aliases"] = with_(QUOTED, LIKENESS, *RESOLVED, """
ap AS (SELECT m.source, m.match_key, suggested AS id, f.name FROM mapped m LEFT JOIN facts f ON f.id = suggested WHERE reason IS NOT NULL AND suggested IS NOT NULL)""", recursive=True) + """
SELECT (SELECT count(*) FROM alias) + (SELECT count(*) FROM (SELECT DISTINCT source, match_key FROM ap WHERE name IS NOT NULL AND (source, match_key) NOT IN (SELECT (source, match_key) FROM alias))) AS aliases, 'rows' AS kind
UNION ALL SELECT (SELECT count(*) FROM ap LEFT JOIN alias a USING (source, match_key) WHERE name IS NULL OR alias_id <> id OR alias_name <> name), 'rows'"""

# Names below the floor: all pairs of a statistic, the common letters counted anew.
ORACLES["review_candidates"] = with_(QUOTED, LIKENESS, *RESOLVED, """
lost AS (SELECT m.source, m.raw_player_name AS raw, m.match_key AS a, i.stats, i.teams, length(m.match_key) AS la FROM mapped m JOIN idents i USING (source, raw_player_name) WHERE reason = 'below_review_floor'),
met AS (SELECT DISTINCT l.a, l.la, c.match_key AS b, length(c.match_key) AS lb FROM lost l JOIN cand c ON list_contains(l.stats, c.stat) WHERE c.match_key <> ''),
held AS (SELECT a, b, la, lb, (1::BIGINT << la) - 1 AS whole, list_transform(string_split(b, ''), lambda c: list_sum(list_transform(range(0, la),
    lambda i: CASE WHEN a[i + 1] = c THEN (1::BIGINT << i) ELSE 0 END))::BIGINT) AS m FROM met),
told AS (SELECT a, b, 200.0 * (la - bit_count(list_reduce(list_prepend(whole, m), lambda v, x: (((v + (v & x)) | (v - (v & x))) & whole)))) / (la + lb) AS score FROM held),
each AS (SELECT l.source, l.raw, 'gsis:' || c.gsis_player_id AS id, max(score) AS score, bool_or(list_contains(l.teams, c.team)) AS mate FROM lost l JOIN cand c ON list_contains(l.stats, c.stat)
    JOIN told t ON t.a = l.a AND t.b = c.match_key GROUP BY 1, 2, 3),
placed AS (SELECT *, row_number() OVER (PARTITION BY source, raw ORDER BY score DESC, mate DESC, id DESC) AS i FROM each)""", recursive=True) + f"""
SELECT p.source, p.raw AS raw_player_name, p.id AS candidate_canonical_player_id, f.name AS candidate_name, {r("p.score", name="match_score")}, {r("q.score", name="runner_up_score")}
FROM placed p JOIN facts f ON f.id = p.id LEFT JOIN placed q ON q.source = p.source AND q.raw = p.raw AND q.i = 2 WHERE p.i = 1"""

ORACLES["alias_actions"] = with_(QUOTED, LIKENESS, *RESOLVED, """
ap AS (SELECT m.source, m.raw_player_name, m.match_key, suggested AS id, f.name FROM mapped m LEFT JOIN facts f ON f.id = suggested WHERE reason IS NOT NULL AND suggested IS NOT NULL
    UNION ALL SELECT source, alias_name[8:], match_key, CASE split_part(alias_id, ':', 2)::BIGINT % 3 WHEN 1 THEN 'listed:0' WHEN 0 THEN alias_id END, alias_name FROM alias),
sound AS (SELECT *, coalesce(source <> '*' AND id IS NOT NULL AND name IS NOT NULL, false) AS whole FROM ap),
placed AS (SELECT *, row_number() OVER w AS place, first(struct_pack(id := id, name := name)) OVER w AS lead FROM sound WINDOW w AS (PARTITION BY source, match_key, whole ORDER BY raw_player_name, id, name)),
met AS (SELECT p.*, a.alias_id, a.alias_name, coalesce(struct_pack(id := alias_id, name := alias_name), lead) AS there FROM placed p LEFT JOIN alias a USING (source, match_key)),
acted AS (SELECT source, raw_player_name, id, name, CASE WHEN NOT whole THEN 'incomplete' WHEN alias_id IS NULL AND place = 1 THEN 'append'
    WHEN coalesce(alias_id, lead.id) = id AND coalesce(alias_name, lead.name) = name THEN 'present' ELSE 'conflict' END AS action FROM met)""", recursive=True) + """
SELECT source, raw_player_name, id AS canonical_player_id, name AS canonical_player_name, action, 1::BIGINT AS round FROM acted
UNION ALL SELECT source, raw_player_name, id, name, CASE action WHEN 'append' THEN 'present' ELSE action END, 2 FROM acted
UNION ALL SELECT source, alias_name[8:], alias_id, alias_name, 'kept', unnest([1, 2]) FROM alias WHERE (source, match_key) NOT IN (SELECT (source, match_key) FROM ap)"""


# --- distributions --------------------------------------------------------------------

COUNTS = """
counts AS (SELECT l_orderkey, sum(l_quantity) AS y, avg(l_quantity) AS mu, count(*) AS n, 0.5 + count(*) AS r FROM lineitem GROUP BY 1)"""


def nb_log(y: str, mu: str, shape: str) -> str:
    return (f"(lgamma({y} + {shape}) - lgamma({shape}) - lgamma({y} + 1.0) + {shape} * ln({shape} / ({shape} + {mu})) + {y} * ln({mu} / ({shape} + {mu})))")


ORACLES["nb_logpmf"] = with_(COUNTS) + f"""SELECT l_orderkey, {r(nb_log("y", "mu", "r::DOUBLE"), name="log_pmf")}, {r("y * ln(mu) - mu - lgamma(y + 1)", name="log_poisson")},
    {r("r / (r + mu)", name="probability")}, {r("mu + mu * mu / r", name="variance")}, y > 0 AS impossible FROM counts"""

ORACLES["nb_survival"] = with_(COUNTS, f"""
mass AS (SELECT l_orderkey, k, sum(exp({nb_log("j", "mu", "r::DOUBLE")})) AS below FROM (SELECT *, floor(mu) + n AS k, unnest(range(0, (floor(mu) + n)::BIGINT)) AS j FROM counts) GROUP BY 1, 2)""") + f"""
SELECT l_orderkey, k::DOUBLE AS k, {r("1 - below", 8, "survival")} FROM mass"""

ORACLES["nb_interval"] = with_(COUNTS, f"""
cdf AS (SELECT l_orderkey, j, sum(exp({nb_log("j", "mu", "r::DOUBLE")})) OVER (PARTITION BY l_orderkey ORDER BY j) AS c
    FROM (SELECT *, unnest(range(0, (mu * 12 + 60)::BIGINT)) AS j FROM counts))""") + """
SELECT l_orderkey, min(j) FILTER (WHERE c >= 0.1)::DOUBLE AS low, min(j) FILTER (WHERE c >= 0.9)::DOUBLE AS high FROM cdf GROUP BY 1"""


# --- calibration ----------------------------------------------------------------------

POWER = """
obs AS (SELECT stat, target_season AS s, ln(baseline_mean) AS x, realized_total AS y FROM predictions
    WHERE training_eligible AND baseline_mean > 0 AND realized_total >= 0 AND target_season BETWEEN 1997 AND 1999),
keys AS (SELECT DISTINCT stat, ref, h FROM obs, (SELECT unnest([1997, 1998, 1999]) AS ref), (SELECT unnest([1.0, 3.0, 5.0, 10.0]) AS h) WHERE s <= ref),
weighted AS (SELECT stat, ref, h, s, x, y, pow(0.5, (ref - s) / h::DOUBLE) AS w FROM keys JOIN obs USING (stat) WHERE s <= ref),
target AS (SELECT stat, ref, h, sum(w * x * y) / sum(w * y) AS c FROM weighted GROUP BY ALL),
bisect AS (SELECT stat, ref, h, c, 0.02::DOUBLE AS lo, 3.0::DOUBLE AS hi, 0 AS i FROM target
  UNION ALL SELECT stat, ref, h, c, CASE WHEN g < 0 THEN mid ELSE lo END, CASE WHEN g < 0 THEN hi ELSE mid END, i + 1 FROM (
    SELECT b.stat, b.ref, b.h, any_value(c) AS c, lo, hi, i, (lo + hi) / 2 AS mid, sum(w * x * exp((lo + hi) / 2 * x)) / sum(w * exp((lo + hi) / 2 * x)) - any_value(c) AS g
    FROM bisect b JOIN weighted o ON o.stat = b.stat AND o.ref = b.ref AND o.h = b.h WHERE i < 48 GROUP BY b.stat, b.ref, b.h, lo, hi, i)),
fit0 AS (SELECT stat, ref, h, (lo + hi) / 2 AS b FROM bisect WHERE i = 48),
fit1 AS (SELECT stat, ref, h, b, ln(sum(w * y) / sum(w * exp(b * x))) AS a, count(*) AS n, sum(w) AS sw, array_to_string(list_sort(list(DISTINCT s)), '|') AS seasons,
    count(DISTINCT s) AS ns FROM fit0 JOIN weighted USING (stat, ref, h) GROUP BY ALL),
fits AS (SELECT stat, ref, h, b, a, n, seasons, ns, any_value(n / sw) * sum(w * (exp(a + b * x) - y * (a + b * x) + lgamma(y + 1))) AS objective,
    b - 0.02 <= 2.98e-6 OR 3 - b <= 2.98e-6 AS bound_hit FROM fit1 JOIN weighted USING (stat, ref, h) GROUP BY ALL)"""

ORACLES["poisson_power_fit"] = with_(*HISTORY, POWER, recursive=True) + f"""SELECT stat, ref::BIGINT AS reference_season, h::DOUBLE AS half_life, {r("a", 4, "intercept")}, {r("b", 4, "exponent")},
    bound_hit, {r("objective", 4)}, n::BIGINT AS training_player_seasons, seasons AS training_seasons FROM fits"""

SELECTION = """
folds AS (SELECT f.stat, f.ref + 1 AS v, f.h, f.bound_hit, sum(exp(a + b * x) - y * (a + b * x) + lgamma(y + 1)) AS nll, count(*) AS rows FROM fits f JOIN obs o ON o.stat = f.stat AND o.s = f.ref + 1
    WHERE ns >= 2 GROUP BY ALL),
refs AS (SELECT DISTINCT stat, ref FROM fits WHERE ns >= 2),
scores AS (SELECT refs.stat, refs.ref, h, sum(nll) / sum(rows) AS score, bool_or(bound_hit) AS failed, list_sort(list(DISTINCT v)) AS vs FROM refs JOIN folds ON folds.stat = refs.stat AND v <= refs.ref GROUP BY ALL),
best AS (SELECT stat, ref, arg_min(h, (score, h)) FILTER (WHERE NOT failed) AS h, min(score) FILTER (WHERE NOT failed) AS score, any_value(vs) AS vs FROM scores GROUP BY 1, 2),
chosen AS (SELECT refs.stat, refs.ref, CASE WHEN vs IS NULL THEN 5.0 ELSE best.h END AS h, score, coalesce(array_to_string(vs, '|'), '') AS vs FROM refs LEFT JOIN best USING (stat, ref))"""
ORACLES["half_life_selection"] = with_(*HISTORY, POWER, SELECTION, recursive=True) + f"""SELECT stat, ref::BIGINT AS reference_season, h::DOUBLE AS half_life,
    {r("score", 5, "selection_score")}, vs AS validation_seasons FROM chosen"""

ROLLING = """
applied AS (SELECT p.*, f.a, f.b, f.seasons, f.a IS NOT NULL AS fitted, CASE WHEN f.a IS NULL THEN baseline_mean ELSE exp(f.a + f.b * ln(baseline_mean)) END AS corrected
    FROM predictions p LEFT JOIN (chosen JOIN fits f0 USING (stat, ref, h)) f ON f.stat = p.stat AND f.ref = least(p.target_season - 1, 1999) AND p.baseline_mean > 0)"""
CORRECTED = (*HISTORY, POWER, SELECTION, ROLLING.replace("(chosen JOIN fits f0 USING (stat, ref, h)) f", "(SELECT stat, ref, a, b, seasons FROM chosen JOIN fits USING (stat, ref, h)) f"))
ORACLES["rolling_correction"] = with_(*CORRECTED, recursive=True) + f"""SELECT target_season::BIGINT AS target_season, gsis_player_id, stat, {r("baseline_mean", 4, "baseline_mean_raw")},
    {r("corrected", 4, "baseline_mean")}, CASE WHEN fitted THEN 'rolling_power_poisson' ELSE 'identity_insufficient_history' END AS baseline_bias_method,
    {r("coalesce(a, 0)", 4, "baseline_bias_intercept")}, {r("coalesce(b, 1)", 4, "baseline_bias_exponent")}, coalesce(seasons, '') AS baseline_bias_training_seasons,
    CASE WHEN fitted THEN array_to_string(list_sort(list_distinct(list_concat(used, list_transform(string_split(seasons, '|'), lambda s: s::BIGINT)))), '|') ELSE feature_seasons END AS feature_seasons FROM applied"""

ORACLES["history_gate"] = with_(*CORRECTED, recursive=True) + " UNION ALL ".join(
    f"SELECT '{n}' AS name, {p} AS passed, '{s}' AS severity" for n, p, s in _GATE)

_LO, _HI = math.log(0.05), math.log(1000.0)
TRAINING = f"""
usable AS (SELECT stat, target_season AS season, gsis_player_id, position, target_games, realized_total AS y, corrected AS mu, baseline_mean AS raw_mu, pow(0.5, (1999 - target_season) / 5.0) AS w
    FROM applied WHERE training_eligible AND corrected > 0),
training AS (SELECT * FROM usable WHERE season < 2000),
windowed AS (SELECT stat, unnest(list_filter(['full', '1997', CASE WHEN season >= 1998 THEN '1998' END, CASE WHEN season >= 1999 THEN '1999' END], lambda z: z IS NOT NULL)) AS win, y, mu, w FROM training),
search AS (SELECT stat, win, {_LO}::DOUBLE AS lo, {_HI}::DOUBLE AS hi, 0 AS i FROM windowed GROUP BY 1, 2
  UNION ALL SELECT stat, win, CASE WHEN f1 > f2 THEN m1 ELSE lo END, CASE WHEN f1 > f2 THEN hi ELSE m2 END, i + 1 FROM (
    SELECT s.stat, s.win, lo, hi, i, lo + (hi - lo) / 3 AS m1, hi - (hi - lo) / 3 AS m2, sum(-w * {nb_log("y", "mu", "exp(lo + (hi - lo) / 3)")}) AS f1,
        sum(-w * {nb_log("y", "mu", "exp(hi - (hi - lo) / 3)")}) AS f2 FROM search s JOIN windowed o ON o.stat = s.stat AND o.win = s.win WHERE i < 48 GROUP BY ALL)),
disp AS (SELECT s.stat, win, (lo + hi) / 2 AS log_r, sum(-w * {nb_log("y", "mu", "exp((lo + hi) / 2)")}) / sum(w) AS nll, count(*) AS n FROM search s JOIN windowed USING (stat, win) WHERE i = 48 GROUP BY ALL)"""
DISPERSION = (*CORRECTED, TRAINING)
ORACLES["dispersion_fit"] = with_(*DISPERSION, recursive=True) + f"""SELECT stat, win AS "window", {r("log_r", 4, "log_dispersion")}, {r("nll", 4, "nll_per_weight")}, n::BIGINT AS player_seasons,
    log_r - {_LO} <= 1e-4 OR {_HI} - log_r <= 1e-4 AS bound_hit FROM disp"""

ORACLES["window_sensitivity"] = with_(*DISPERSION, recursive=True) + f"""SELECT f.stat, t.start::BIGINT AS configured_start_season, t.start::BIGINT AS effective_start_season, coalesce(d.n, 0)::BIGINT AS player_seasons,
    CASE WHEN coalesce(d.n, 0) < 25 THEN 'insufficient_data' ELSE 'passed' END AS status, {r("CASE WHEN d.n >= 25 THEN exp(d.log_r) END", 4, "dispersion")},
    {r("CASE WHEN d.n >= 25 THEN abs(d.log_r - f.log_r) END", 4, "log_dispersion_delta")}
    FROM (SELECT * FROM disp WHERE win = 'full') f, (SELECT unnest([1997, 1998, 1999]) AS start) t LEFT JOIN disp d ON d.stat = f.stat AND d.win = t.start::VARCHAR"""

# Every replicate is searched over the whole bounds, on an even grid of its own.
_SEED, _B, _N = R.CALIBRATION.random_seed, R.CALIBRATION.bootstrap_samples, 128


def _hash(text: str, start: int) -> str:
    return f"(('0x' || md5({text})[{start}:{start + 6}])::BIGINT % {HASH_PRIME})"


_NODES = ", ".join(f"-w * {nb_log('y', 'mu', f'{math.exp(_LO + (_HI - _LO) * i / (_N - 1))!r}::DOUBLE')} AS c{i}" for i in range(_N))
_TIMES = " + ".join(f"(u >= {c!r})::INT" for c in UNIT_POISSON)
BOOTSTRAP = f"""
rowcost AS (SELECT stat, season, {_hash(f"'{_SEED}|' || stat || '|' || season || '|' || gsis_player_id", 1)} AS h1, {_hash(f"'{_SEED}|' || stat || '|' || season || '|' || gsis_player_id", 8)} AS h2,
    {_NODES} FROM training),
listed AS (SELECT stat, list_sort(list(DISTINCT season)) AS ss FROM training GROUP BY 1),
draws AS (SELECT stat, b, ss[({_hash(f"'{_SEED}|' || stat || '|' || b || '|' || slot", 1)} % len(ss))::INT + 1] AS season, b * len(ss) + slot + 1 AS ticket
    FROM (SELECT stat, ss, b, unnest(range(0, len(ss))) AS slot FROM listed, (SELECT unnest(range(0, {_B})) AS b))),
hit AS (SELECT *, {_TIMES} AS times FROM (SELECT *, ((z * z + ticket) % {HASH_PRIME}) / {float(HASH_PRIME)}::DOUBLE AS u FROM (
    SELECT rowcost.*, b, ticket, (h1 + ticket * h2) % {HASH_PRIME} AS z FROM rowcost JOIN draws USING (stat, season)))),
reps AS (SELECT stat, b, [{", ".join(f"sum(times * c{i})" for i in range(_N))}] AS costs FROM hit GROUP BY ALL),
placed AS (SELECT *, list_position(costs, list_min(costs)) AS best, greatest(3, least({_N - 2}, list_position(costs, list_min(costs)))) AS c FROM reps),
quart AS (SELECT *, (costs[c - 2] - 8 * costs[c - 1] + 8 * costs[c + 1] - costs[c + 2]) / 12 AS d1, (-costs[c - 2] + 16 * costs[c - 1] - 30 * costs[c] + 16 * costs[c + 1] - costs[c + 2]) / 12 AS d2,
    (-costs[c - 2] + 2 * costs[c - 1] - 2 * costs[c + 1] + costs[c + 2]) / 2 AS d3, costs[c - 2] - 4 * costs[c - 1] + 6 * costs[c] - 4 * costs[c + 1] + costs[c + 2] AS d4 FROM placed),
roots AS (SELECT *, list_reduce([best - c, 1.0, 2.0, 3.0, 4.0], lambda x, n: x - (d1 + d2 * x + d3 * x * x / 2 + d4 * x * x * x / 6) / (d2 + d3 * x + d4 * x * x / 2)) AS x FROM quart),
estimates AS (SELECT stat, b, {_LO!r}::DOUBLE + {(_HI - _LO) / (_N - 1)!r}::DOUBLE * (c - 1 + x) AS log_r, best > 1 AND best < {_N} AS ok FROM roots)"""
ORACLES["bootstrap_dispersion"] = with_(*DISPERSION, BOOTSTRAP, recursive=True) + f"""SELECT stat, {_B}::BIGINT AS samples_requested, count(*) FILTER (WHERE ok)::BIGINT AS successful_samples, 0::BIGINT AS bound_hit_samples,
    count(*) FILTER (WHERE NOT ok)::BIGINT AS failed_samples, {r(f"count(*) FILTER (WHERE ok) / {_B}.0", 3, "success_rate")}, {r("quantile_cont(log_r, 0.05) FILTER (WHERE ok)", 3, "log_dispersion_lower")},
    {r("quantile_cont(log_r, 0.95) FILTER (WHERE ok)", 3, "log_dispersion_upper")}, count(*) FILTER (WHERE ok) >= 0.9 * {_B} AS passed FROM estimates GROUP BY 1"""

HOLDOUT = (*DISPERSION, f"""
holdout AS (SELECT row_number() OVER () AS id, u.stat, season, gsis_player_id, position, target_games, y, mu, raw_mu, round(exp(log_r), 4) AS r, {nb_log("y", "mu", "round(exp(log_r), 4)")} AS log_nb,
    y * ln(mu) - mu - lgamma(y + 1) AS log_poisson FROM usable u JOIN disp d ON d.stat = u.stat AND d.win = 'full' WHERE season >= 2000)""")
ORACLES["holdout_metrics"] = with_(*HOLDOUT, recursive=True) + f"""SELECT stat, count(*)::BIGINT AS count, {r("-sum(log_nb)", 4, "negative_log_likelihood")}, {r("-avg(log_nb)", 4, "negative_log_likelihood_per_player_season")},
    {r("-avg(log_poisson)", 4, "poisson_negative_log_likelihood_per_player_season")}, {r("avg(log_poisson - log_nb)", 4, "nll_regret_vs_poisson_per_player_season")}, {r("avg(y - mu)", 4, "bias")},
    {r("avg(abs(y - mu))", 4, "mean_absolute_error")}, {r("sum(y - mu) / sum(mu)", 4, "relative_bias")}, {r("avg(y - raw_mu)", 4, "raw_baseline_bias")},
    {r("avg(abs(y - raw_mu))", 4, "raw_baseline_mean_absolute_error")}, {r("sum(y - raw_mu) / sum(raw_mu)", 4, "raw_baseline_relative_bias")} FROM holdout GROUP BY 1"""

CDF = f"""
cdf AS (SELECT id, j, sum(exp({nb_log("j", "mu", "r")})) OVER (PARTITION BY id ORDER BY j) AS c FROM (SELECT id, mu, r, unnest(range(0, (mu * 12 + 100)::BIGINT)) AS j FROM holdout))"""
ORACLES["brier_events"] = with_(*HOLDOUT, CDF, """
ev AS (SELECT id, level, min(j) FILTER (WHERE c >= level) + 1 AS k, 1 - min(c) FILTER (WHERE c >= level) AS predicted FROM cdf, (SELECT unnest([0.25, 0.5, 0.75]) AS level) GROUP BY 1, 2),
hits AS (SELECT stat, level, predicted, (y >= k)::INT AS hit FROM ev JOIN holdout USING (id))""", recursive=True) + f"""SELECT stat, level::DOUBLE AS cdf_level, count(*)::BIGINT AS rows,
    {r("avg(pow(predicted - hit, 2))", 4, "brier_score")}, {r("avg(predicted)", 4, "mean_predicted_probability")}, {r("avg(hit)", 4, "empirical_event_rate")}, {r("abs(avg(predicted) - avg(hit))", 4, "calibration_gap")} FROM hits GROUP BY 1, 2"""

ORACLES["interval_coverage"] = with_(*HOLDOUT, CDF, """
iv AS (SELECT id, level, min(j) FILTER (WHERE c >= (1 - level) / 2) AS low, min(j) FILTER (WHERE c >= 1 - (1 - level) / 2) AS high FROM cdf, (SELECT unnest([0.5, 0.8, 0.9])::DOUBLE AS level) GROUP BY 1, 2),
mass AS (SELECT stat, level, (y BETWEEN low AND high)::INT AS inside, h.c - coalesce(l.c, 0) AS mass FROM iv JOIN holdout USING (id) JOIN cdf h ON h.id = iv.id AND h.j = iv.high
    LEFT JOIN cdf l ON l.id = iv.id AND l.j = iv.low - 1)""", recursive=True) + f"""SELECT stat, level AS nominal_level, {r("avg(mass)", 4, "mean_model_implied_coverage")}, {r("avg(inside)", 4, "empirical_coverage")},
    {r("abs(avg(inside) - avg(mass))", 4, "absolute_error")} FROM mass GROUP BY 1, 2"""

_METRICS = f"""count(*)::BIGINT AS count, {r("avg(mu)", 4, "mean_baseline")}, {r("avg(y)", 4, "mean_realized")}, {r("avg(y - mu)", 4, "bias")}, {r("avg(abs(y - mu))", 4, "mean_absolute_error")},
    {r("-avg(log_nb)", 4, "negative_log_likelihood_per_player_season")}"""
ORACLES["mean_bins"] = with_(*HOLDOUT, """
ranked AS (SELECT *, row_number() OVER (PARTITION BY stat ORDER BY mu, season, gsis_player_id) AS rn, count(*) OVER (PARTITION BY stat) AS n FROM holdout)""", recursive=True) + f"""
SELECT stat, greatest(1, ((rn - 1) * least(10, n) + n - 2) // nullif(n - 1, 0))::BIGINT AS bin, {_METRICS} FROM ranked GROUP BY 1, 2"""

ORACLES["cohort_metrics"] = with_(*HOLDOUT, recursive=True) + f"""SELECT stat, 'position' AS cohort_kind, position AS cohort, {_METRICS} FROM holdout GROUP BY 1, 2, 3 UNION ALL
    SELECT stat, 'availability', CASE WHEN target_games <= 8 THEN '0-8' WHEN target_games <= 13 THEN '9-13' ELSE '14+' END, {_METRICS} FROM holdout GROUP BY 1, 2, 3"""

_CGATE = [("input_keys", "(SELECT count(*) = count(DISTINCT (target_season, gsis_player_id, stat)) FROM applied)"),
          ("input_types", "(SELECT count(*) = 0 FROM applied WHERE target_season IS NULL OR realized_total IS NULL OR target_games IS NULL)"),
          ("supported_stats", f"(SELECT count(*) = 0 FROM applied WHERE stat NOT IN {STATS})"),
          ("no_lookahead", "(SELECT count(*) = 0 FROM applied WHERE greatest(list_max(used), list_max(list_transform(string_split(seasons, '|'), lambda s: s::BIGINT))) >= target_season)"),
          ("feature_lineage", "(SELECT count(*) = 0 FROM applied WHERE list_max(used) IS DISTINCT FROM list_max(list_transform(string_split(nullif(feature_seasons, ''), '|'), lambda s: s::BIGINT)))"),
          ("feature_lineage_format", r"(SELECT count(*) = 0 FROM applied WHERE feature_seasons <> '' AND NOT regexp_full_match(feature_seasons, '[0-9]+(\|[0-9]+)*'))")]
_CGATE += [("baseline_bias_correction", "(SELECT count(*) = 0 FROM applied WHERE fitted AND (b - 0.02 <= 2.98e-6 OR 3 - b <= 2.98e-6))")]
_CGATE += [(f"{s}.{n}", f"(SELECT count(*) = 0 FROM applied WHERE stat = '{s}' AND training_eligible AND {c})") for s in STATS for n, c in (
    ("integer_outcomes", "abs(realized_total - round(realized_total)) > 1e-9"), ("baseline_domain", "(corrected IS NULL OR corrected < 0)"))]
_CGATE += [(f"{s}.zero_baseline_consistency", f"(SELECT count(*) = 0 FROM applied WHERE stat = '{s}' AND training_eligible AND corrected = 0 AND realized_total > 0)") for s in STATS]
_CGATE += [(f"{s}.training_cohort", f"(SELECT count(*) >= 20 FROM training WHERE stat = '{s}')") for s in STATS]
_CGATE += [(f"{s}.holdout_cohort", f"(SELECT count(*) >= 30 FROM usable WHERE stat = '{s}' AND season >= 2000)") for s in STATS]
ORACLES["calibration_gate"] = with_(*DISPERSION, recursive=True) + " UNION ALL ".join(
    f"SELECT 'historical_calibration.{n}' AS name, {p} AS passed, 'error' AS severity" for n, p in _CGATE) + "".join(
    f" UNION ALL SELECT 'historical_calibration.{s}.signed_negative_observations', (SELECT count(*) = 0 FROM applied WHERE stat = '{s}' AND training_eligible AND realized_total < 0), 'warning'" for s in STATS)

# The published table with its status: every tolerance is checked anew.
GATED = (*HOLDOUT, BOOTSTRAP, CDF, """
ev AS (SELECT id, level, min(j) FILTER (WHERE c >= level) + 1 AS k, 1 - min(c) FILTER (WHERE c >= level) AS predicted FROM cdf, (SELECT unnest([0.25, 0.5, 0.75]) AS level) GROUP BY 1, 2),
gap AS (SELECT stat, max(g) AS gap FROM (SELECT stat, abs(avg(predicted) - avg((y >= k)::INT)) AS g FROM ev JOIN holdout USING (id) GROUP BY stat, level) GROUP BY 1),
iv AS (SELECT id, level, min(j) FILTER (WHERE c >= (1 - level) / 2) AS low, min(j) FILTER (WHERE c >= 1 - (1 - level) / 2) AS high FROM cdf, (SELECT unnest([0.5, 0.8, 0.9])::DOUBLE AS level) GROUP BY 1, 2),
miss AS (SELECT stat, max(e) AS miss FROM (SELECT stat, abs(avg((y BETWEEN low AND high)::INT) - avg(h.c - coalesce(l.c, 0))) AS e FROM iv JOIN holdout USING (id) JOIN cdf h ON h.id = iv.id AND h.j = iv.high
    LEFT JOIN cdf l ON l.id = iv.id AND l.j = iv.low - 1 GROUP BY stat, level) GROUP BY 1),
sens AS (SELECT f.stat, count(*) FILTER (WHERE coalesce(d.n, 0) < 25) AS bad, max(CASE WHEN d.n >= 25 THEN abs(d.log_r - f.log_r) END) AS delta
    FROM (SELECT * FROM disp WHERE win = 'full') f, (SELECT unnest([1997, 1998, 1999]) AS start) t LEFT JOIN disp d ON d.stat = f.stat AND d.win = t.start::VARCHAR GROUP BY 1),
held AS (SELECT stat, -avg(log_nb) AS nll, -avg(log_poisson) AS pnll, sum(y - mu) / sum(mu) AS bias, sum(y - raw_mu) / sum(raw_mu) AS raw_bias, count(*) AS n_held FROM holdout GROUP BY 1),
booted AS (SELECT stat, count(*) FILTER (WHERE ok) / %d::DOUBLE AS success, quantile_cont(log_r, 0.05) FILTER (WHERE ok) AS low, quantile_cont(log_r, 0.95) FILTER (WHERE ok) AS high FROM estimates GROUP BY 1),
cohorts AS (SELECT stat, count(*) FILTER (WHERE target_season < 2000 AND corrected > 0) AS n_train, count(*) FILTER (WHERE corrected = 0 AND realized_total = 0) AS zeros,
    count(*) FILTER (WHERE corrected = 0 AND realized_total > 0) AS impossible, array_to_string(list_sort(list(DISTINCT target_season) FILTER (WHERE target_season < 2000 AND corrected > 0)), '|') AS train_seasons,
    array_to_string(list_sort(list(DISTINCT target_season) FILTER (WHERE target_season >= 2000 AND corrected > 0)), '|') AS held_seasons FROM applied
    WHERE training_eligible AND target_season BETWEEN 1997 AND 2000 GROUP BY 1),
verdict AS (SELECT c.*, d.log_r, d.nll AS train_nll, h.*EXCLUDE (stat), b.*EXCLUDE (stat), gap, miss, bad, delta FROM cohorts c JOIN (SELECT * FROM disp WHERE win = 'full') d ON d.stat = c.stat
    LEFT JOIN held h ON h.stat = c.stat LEFT JOIN booted b ON b.stat = c.stat LEFT JOIN gap ON gap.stat = c.stat LEFT JOIN miss ON miss.stat = c.stat LEFT JOIN sens ON sens.stat = c.stat)""" % _B)
_LIMITS = {
    "dispersion_not_on_bound": f"log_r - {_LO} > 1e-4 AND {_HI} - log_r > 1e-4", "bootstrap": "success >= 0.9 AND low IS NOT NULL", "holdout_likelihood": "nll <= pnll + 0.05",
    "holdout_brier_calibration": "gap <= 0.1", "holdout_interval_coverage": "miss <= 0.1", "holdout_bias": "abs(bias) <= 0.1", "sensitivity_stability": "bad = 0 AND delta <= 1",
    "training_cohort": "n_train >= 20", "holdout_cohort": "n_held >= 30", "zero_baseline_consistency": "impossible = 0"}
ORACLES["dispersion_table"] = with_(*GATED, recursive=True) + f"""SELECT stat, 'negative_binomial' AS distribution_family, '{R.CALIBRATION.calibration_version}' AS calibration_version, 'historical_only' AS method,
    {r("exp(log_r)", 4, "historical_dispersion")}, {r("log_r", 4, "historical_log_dispersion")}, {r("exp(low)", 4, "historical_dispersion_lower")}, {r("exp(high)", 4, "historical_dispersion_upper")},
    {r("low", 4, "historical_log_dispersion_lower")}, {r("high", 4, "historical_log_dispersion_upper")}, {r("exp(log_r)", 4, "final_dispersion")}, 'historical_only' AS dispersion_source,
    n_train::BIGINT AS training_player_seasons, n_held::BIGINT AS holdout_player_seasons, train_seasons AS training_seasons, held_seasons AS holdout_seasons, 0::BIGINT AS negative_outcomes_excluded,
    zeros::BIGINT AS zero_baselines_excluded, {r("train_nll * n_train", 4, "objective_nll")}, true AS optimizer_converged, NOT ({_LIMITS["dispersion_not_on_bound"]}) AS dispersion_bound_hit,
    {r("success", 4, "bootstrap_success_rate")}, {r("nll", 4, "holdout_nll_per_player_season")}, {r("pnll", 4, "holdout_poisson_nll_per_player_season")}, {r("bias", 4, "holdout_relative_bias")},
    {r("raw_bias", 4, "holdout_raw_baseline_relative_bias")}, CASE WHEN {" AND ".join(f"coalesce({c}, false)" for c in _LIMITS.values())} THEN 'passed' ELSE 'failed' END AS status FROM verdict"""
ORACLES["tolerance_gate"] = with_(*GATED, recursive=True) + " UNION ALL ".join(
    f"SELECT 'historical_calibration.' || stat || '.{n}' AS name, coalesce({c}, false) AS passed FROM verdict" for n, c in _LIMITS.items())


# --- means ----------------------------------------------------------------------------

MEANS = QUOTES + """,
disp0 AS (SELECT stat, round(avg(floor(value)) * avg(floor(value)) / (var_samp(floor(value)) - avg(floor(value))), 3) AS r FROM ev GROUP BY 1),
shapes AS (SELECT stat, 'point' AS which, r AS rr FROM disp0 UNION ALL SELECT stat, 'low', exp(ln(r) - 0.5) FROM disp0 UNION ALL SELECT stat, 'high', exp(ln(r) + 0.5) FROM disp0),
coef AS (SELECT stat, which, rr, list_transform(range(0, (SELECT max(threshold_k) + 2 FROM priced)), lambda j: lgamma(j + rr) - lgamma(rr) - lgamma(j + 1)) AS a FROM shapes),
elig AS (SELECT source, source_market_id, user_id, stat, threshold_k AS k, p, bid, ask FROM model WHERE model_reason = '')"""


def survival(k: str, t: str) -> str:
    """P(X >= k) at log-mean t by summing the mass function; needs columns a and rr."""
    return (f"(1 - list_sum(list_transform(range(0, {k}), lambda j: exp(a[j + 1] - rr * ln(1 + exp({t}) / rr) - j * ln(1 + rr / exp({t}))))))")


def solver(problems: str) -> str:
    """Bracketed descent of the soft-L1 cost from the median single-quote root, for problems ``pid, stat, which, k, p``."""
    return f"""
problems AS ({problems}),
rowsets AS (SELECT pid, k, p, rr, a FROM problems JOIN coef USING (stat, which)),
single AS (SELECT stat, which, k, p, ln(0.01) AS lo, ln(5000.0) AS hi, 0 AS i FROM problems GROUP BY ALL
  UNION ALL SELECT stat, which, k, p, CASE WHEN v < p THEN mid ELSE lo END, CASE WHEN v < p THEN hi ELSE mid END, i + 1 FROM (
    SELECT s.*, (lo + hi) / 2 AS mid, {survival("k", "(lo + hi) / 2")} AS v FROM single s JOIN coef USING (stat, which) WHERE i < 40)),
start AS (SELECT pid, coalesce(median(lo) FILTER (WHERE lo > ln(0.01) + 2e-6 AND lo < ln(5000.0) - 2e-6), (ln(0.01) + ln(5000.0)) / 2) AS t0 FROM problems JOIN single USING (stat, which, k, p) WHERE i = 40 GROUP BY 1),
solve AS (SELECT pid, ln(0.01) AS lo, ln(5000.0) AS hi, t0 AS mid, NULL::DOUBLE AS pt, NULL::DOUBLE AS pg, 0 AS i FROM start
  UNION ALL SELECT pid, l2, h2, CASE WHEN mid - g / s >= l2 AND mid - g / s <= h2 THEN mid - g / s ELSE (l2 + h2) / 2 END, mid, g, i + 1 FROM (
    SELECT *, CASE WHEN g < 0 THEN mid ELSE lo END AS l2, CASE WHEN g < 0 THEN hi ELSE mid END AS h2, CASE WHEN mid <> pt AND (g - pg) / (mid - pt) > 0 THEN (g - pg) / (mid - pt) ELSE h END AS s FROM (
    SELECT pid, lo, hi, i, mid, any_value(pt) AS pt, any_value(pg) AS pg, sum(f * slope / (sv * (1 - sv)) / sqrt(1 + f * f)) AS g, sum(pow(slope / (sv * (1 - sv)), 2) / pow(1 + f * f, 1.5)) AS h FROM (
        SELECT *, ln(sv / (1 - sv)) - ln(p / (1 - p)) AS f,
            exp(lgamma(k + rr) - lgamma(k) - lgamma(rr) - k * ln(1 + rr / exp(mid)) - rr * ln(1 + exp(mid) / rr)) AS slope FROM (
            SELECT s.pid, lo, hi, i, mid, pt, pg, k, p, rr, greatest(1e-300, least(1 - 1e-15, {survival("k", "mid")})) AS sv
            FROM solve s JOIN rowsets q ON q.pid = s.pid WHERE i < 60)) GROUP BY pid, lo, hi, i, mid))),
roots AS (SELECT pid, mid AS t FROM solve WHERE i = 60),
resid AS (SELECT pid, t, k, p, sv, ln(sv / (1 - sv)) - ln(p / (1 - p)) AS f FROM (SELECT pid, t, k, p, greatest(1e-300, least(1 - 1e-15, {survival("k", "t")})) AS sv FROM roots JOIN rowsets USING (pid))),
fitted AS (SELECT pid, any_value(t) AS t, exp(any_value(t)) AS mean, count(*) AS n, sum(sqrt(1 + f * f) - 1) AS objective, sqrt(avg(f * f)) AS rmse, avg(abs(f)) AS mae, max(abs(f)) AS worst FROM resid GROUP BY 1)"""


ORACLES["mean_inversion"] = with_(MEANS, solver("SELECT source || '/' || source_market_id AS pid, stat, 'point' AS which, k, p FROM elig"), recursive=True) + f"""
SELECT split_part(pid, '/', 1) AS source, split_part(pid, '/', 2) AS source_market_id, {r("mean", 5)}, false AS bound_hit, {r("sv", 5, "modeled_probability")} FROM fitted JOIN resid USING (pid)"""

_CURVES = "SELECT source || '/' || user_id || '/' || stat AS pid, stat, 'point' AS which, k, p FROM elig WHERE source NOT IN ('click', 'view')"
_PID = "split_part(pid, '/', 1) AS source, 'user:' || split_part(pid, '/', 2) AS canonical_player_id, split_part(pid, '/', 3) AS stat"
ORACLES["curve_fit"] = with_(MEANS, solver(_CURVES), recursive=True) + f"""SELECT {_PID}, n::BIGINT AS quotes, {r("mean", 4)}, {r("objective", 4)}, {r("rmse", 4, "logit_rmse")},
    {r("mae", 4, "logit_mae")}, {r("worst", 4, "max_abs_logit_residual")} FROM fitted"""

_LEFT_OUT = """SELECT e.source || '/' || e.user_id || '/' || e.stat || '/' || h.k AS pid, e.stat, 'point' AS which, e.k, e.p FROM elig e
    JOIN elig h ON h.source = e.source AND h.user_id = e.user_id AND h.stat = e.stat AND h.k <> e.k WHERE e.source NOT IN ('click', 'view')"""
_LOO = f"""
loo AS (SELECT source, user_id, stat, k, abs(ln(sv / (1 - sv)) - ln(p / (1 - p))) AS e FROM (
    SELECT e.*, greatest(1e-300, least(1 - 1e-15, {survival("k", "t")})) AS sv FROM elig e JOIN fitted f ON f.pid = e.source || '/' || e.user_id || '/' || e.stat || '/' || e.k
    JOIN coef c ON c.stat = e.stat AND c.which = 'point'))"""
ORACLES["curve_leave_one_out"] = with_(MEANS, solver(_LEFT_OUT), _LOO, recursive=True) + f"""SELECT e.source, 'user:' || e.user_id AS canonical_player_id, e.stat, count(loo.e)::BIGINT AS holdout_count,
    0::BIGINT AS holdout_failed_fits, {r("avg(loo.e)", 4, "holdout_logit_mae")} FROM elig e LEFT JOIN loo ON loo.source = e.source AND loo.user_id = e.user_id AND loo.stat = e.stat AND loo.k = e.k
    WHERE e.source NOT IN ('click', 'view') GROUP BY e.source, e.user_id, e.stat"""

# Every fit a projection needs, as one set of problems: point, scenarios, and left-out curves.
_ALL = ("SELECT source || '/' || user_id || '/' || stat || '#' || which AS pid, stat, which, k, p FROM elig, (SELECT unnest(['point', 'low', 'high']) AS which) UNION ALL "
        + " UNION ALL ".join(f"SELECT source || '/' || user_id || '/' || stat || '#{c}' || which, stat, which, k, {c} FROM elig, (SELECT unnest(['low', 'high']) AS which) WHERE source NOT IN ('click', 'view')"
                             for c in ("bid", "ask")) + " UNION ALL " + _LEFT_OUT.replace("|| '/' || h.k", "|| '/' || h.k"))
PROJECTED = (MEANS, solver(_ALL), _LOO, """
tally AS (SELECT source, user_id, stat, any_value(run_id) AS run_id, any_value(season) AS season, count(*) AS quote_count, count(*) FILTER (WHERE model_reason = '') AS eligible,
    array_to_string(list_sort(list(threshold_k) FILTER (WHERE model_reason = '')), '|') AS thresholds_used,
    array_to_string(list_sort(list(DISTINCT model_reason) FILTER (WHERE model_reason <> '')), '|') AS reasons FROM model GROUP BY 1, 2, 3),
tried AS (SELECT *, ln(5000.0) - t <= 1.4e-6 OR t - ln(0.01) <= 1.4e-6 AS edge FROM fitted),
point AS (SELECT split_part(pid, '#', 1) AS gid, mean, rmse, edge FROM tried WHERE pid LIKE '%#point'),
scen AS (SELECT split_part(pid, '#', 1) AS gid, CASE WHEN NOT bool_or(edge) THEN min(mean) END AS low, CASE WHEN NOT bool_or(edge) THEN max(mean) END AS high FROM tried WHERE pid LIKE '%#%' GROUP BY 1),
held AS (SELECT source, user_id, stat, avg(e) AS mae FROM loo GROUP BY 1, 2, 3),
proj AS (SELECT t.*, CASE WHEN source IN ('click', 'view') AND eligible <> 1 THEN NULL ELSE point.mean END AS mean, edge, low, high, rmse, mae, source IN ('click', 'view') AS book FROM tally t
    LEFT JOIN point ON point.gid = source || '/' || user_id || '/' || stat LEFT JOIN scen USING (gid) LEFT JOIN held USING (source, user_id, stat)),
projected AS (SELECT *, CASE WHEN eligible = 0 THEN coalesce(nullif(reasons, ''), 'no_eligible_quotes') WHEN mean IS NULL THEN 'mean_fit_failed:a two-sided group needs exactly one eligible quote'
    WHEN edge THEN 'mean_bound_hit' WHEN low IS NULL THEN 'sensitivity_not_identifiable' WHEN book THEN '' ELSE concat_ws('|', CASE WHEN rmse > 0.35 THEN source || '_curve_residual_exceeds_limit' END, CASE WHEN eligible > 1 AND (mae IS NULL OR mae > 0.6) THEN source || '_curve_holdout_exceeds_limit' END) END AS exclusion_reason FROM proj),
quality AS (SELECT *, CASE WHEN eligible > 0 AND (mean IS NULL OR edge OR low IS NULL) THEN 'failed' WHEN exclusion_reason = '' THEN 'passed' ELSE 'excluded' END AS quality_status FROM projected)""")
ORACLES["source_projections"] = with_(*PROJECTED, recursive=True) + f"""SELECT run_id, season, 'user:' || user_id AS canonical_player_id, stat, source, quote_count::BIGINT AS quote_count, eligible::BIGINT AS eligible_quote_count,
    {r("mean", 4)}, {r("CASE WHEN mean IS NOT NULL THEN low END", 4, "sensitivity_low")}, {r("CASE WHEN mean IS NOT NULL THEN high END", 4, "sensitivity_high")},
    CASE WHEN eligible = 0 THEN 'unavailable' WHEN mean IS NULL THEN 'failed' WHEN book THEN 'single_threshold_bounded_inversion' ELSE 'robust_multi_threshold_logit_fit' END AS projection_method,
    coalesce(thresholds_used, '') AS thresholds_used, CASE WHEN eligible > 0 THEN 0.0::DOUBLE END AS holdout_failed_fits, quality_status, exclusion_reason FROM quality"""

ORACLES["projection_lineage"] = with_(MEANS, recursive=True) + """SELECT run_id, season, 'user:' || user_id AS canonical_player_id, stat, source, source_market_id, trim(raw_player_name) AS raw_player_name,
    threshold_k::BIGINT AS threshold, CASE WHEN model_reason = '' THEN 'included' ELSE 'excluded' END AS model_inclusion_status, nullif(model_reason, '') AS model_exclusion_reason FROM model"""

BACKFILLED = (*PROJECTED, f"""
back AS (SELECT m.*, model_reason = '' AS used, mean, quality_status, CASE WHEN model_reason = '' THEN {survival("threshold_k", "ln(mean)")} END AS sv FROM model m
    JOIN quality g ON g.source = m.source AND g.user_id = m.user_id AND g.stat = m.stat JOIN coef c ON c.stat = m.stat AND c.which = 'point')""")
ORACLES["quote_backfill"] = with_(*BACKFILLED, recursive=True) + f"""SELECT source, source_market_id, CASE WHEN used THEN 'included' ELSE 'excluded' END AS model_inclusion_status,
    {r("CASE WHEN used THEN mean END", 4, "source_projection_mean")}, {r("sv", 4, "modeled_probability")}, {r("sv - p", 4, "probability_residual")},
    {r("ln(sv / (1 - sv)) - ln(p / (1 - p))", 4, "logit_probability_residual")}, CASE WHEN used AND mean IS NOT NULL THEN quality_status END AS source_projection_quality_status FROM back"""

NEAR = (*BACKFILLED, """
near AS (SELECT *, threshold_k - 0.5 AS proxy, abs(mean - (threshold_k - 0.5)) AS shift, greatest(2.0, 0.1 * (threshold_k - 0.5)) AS lim FROM back
    WHERE source IN ('click', 'view') AND used AND quality_status = 'passed' AND p BETWEEN 0.45 AND 0.55)""")
ORACLES["near_even_gate"] = with_(*NEAR, recursive=True) + f"""SELECT source, source_market_id, {r("proxy", 4, "median_proxy")}, {r("shift", 4, "absolute_shift")}, {r("lim", 4, "maximum_shift")}, shift > lim AS violation FROM near"""

_MGATE = [("current_market_thresholds_unique_within_source", "(SELECT count(*) = count(DISTINCT (source, user_id, stat, k)) FROM elig)"), ("source_projection_keys", "(SELECT count(*) = count(DISTINCT (run_id, season, source, user_id, stat)) FROM quality)"),
          ("at_least_one_projection", "(SELECT count(*) > 0 FROM quality WHERE quality_status = 'passed')"), ("mean_optimizers", "(SELECT count(*) = 0 FROM quality WHERE eligible > 0 AND (mean IS NULL OR edge))"),
          ("sensitivity_bounds", "(SELECT count(*) = 0 FROM quality WHERE eligible > 0 AND (mean IS NULL OR low IS NULL))"), ("book_back_substitution", "(SELECT coalesce(max(abs(sv - p)), 0) <= 1e-6 FROM back WHERE used AND mean IS NOT NULL AND source IN ('click', 'view'))"),
          ("curve_source_residuals", f"(SELECT coalesce(max(rmse), 0) <= {R.MEANS.max_curve_logit_rmse} FROM quality WHERE quality_status = 'passed' AND NOT book)"),
          ("curve_source_holdout", f"(SELECT coalesce(max(mae), 0) <= {R.MEANS.max_curve_holdout_logit_mae} FROM quality WHERE quality_status = 'passed' AND NOT book)"),
          ("mean_domains", "(SELECT count(*) = 0 FROM quality WHERE quality_status = 'passed' AND NOT (low <= mean + 1e-9 AND mean <= high + 1e-9 AND mean < 5000))"), ("pricing_included_quote_contract", "(SELECT count(*) = 0 FROM priced WHERE inclusion_status = 'included' AND NOT coalesce(threshold_k >= 1 AND p > 0 AND p < 1, false))"),
          ("quote_inclusion_lineage", "(SELECT count(*) = 0 FROM back WHERE used AND mean IS NULL)"), ("near_even_market_mean_plausibility", "(SELECT count(*) = 0 FROM near WHERE shift > lim)"),
          ("fitted_survival_monotonicity", """(SELECT count(*) = 0 FROM (SELECT max(sv) - lag(min(sv)) OVER (PARTITION BY source, user_id, stat ORDER BY threshold_k) AS up FROM back
              WHERE sv IS NOT NULL GROUP BY source, user_id, stat, threshold_k) WHERE up > 1e-12)"""), ("final_dispersions", "(SELECT min(r) > 0 FROM disp0)")]
ORACLES["model_gate"] = with_(*NEAR, recursive=True) + " UNION ALL ".join(f"SELECT 'model.{n}' AS name, {p} AS passed, 'error' AS severity" for n, p in _MGATE) + \
    " UNION ALL SELECT 'model.curves_quarantined', (SELECT count(*) = 0 FROM quality WHERE NOT book AND quality_status = 'excluded' AND mean IS NOT NULL), 'warning'"


# --- consensus, scores, audit ---------------------------------------------------------

ESTIMATES = QUOTES + """,
est AS (SELECT run_id, season, source, user_id, 'user:' || user_id AS canonical_player_id, stat, max(raw_player_name) AS canonical_player_name, max(team) AS canonical_position, count(*) AS quote_count,
    count(*) FILTER (WHERE model_reason = '') AS eligible_quote_count, avg(coalesce(threshold_k, raw_threshold)) AS mean, avg(coalesce(threshold_k, raw_threshold)) * 0.9 AS low,
    avg(coalesce(threshold_k, raw_threshold)) * 1.2 AS high, CASE WHEN count(*) FILTER (WHERE model_reason = '') > 0 AND max(coalesce(threshold_k, raw_threshold)) > 3 THEN 'passed' ELSE 'failed' END AS quality_status
    FROM model GROUP BY run_id, season, source, user_id, stat),
weights AS (SELECT * FROM (VALUES ('click', 1.0::DOUBLE), ('view', 2.0::DOUBLE), ('purchase', 1.0::DOUBLE)) w(source, weight)),
usable AS (SELECT * FROM est JOIN weights USING (source) WHERE quality_status = 'passed'),
cons AS (SELECT e.run_id, e.season, e.canonical_player_id, e.stat, max(e.canonical_player_name) AS canonical_player_name, string_agg(u.source, '|' ORDER BY u.source) AS source_list, count(u.source) AS source_count,
    coalesce(sum(u.weight), 0.0) AS wsum, max(u.mean) FILTER (WHERE u.source = 'click') AS click_mean, max(u.mean) FILTER (WHERE u.source = 'view') AS view_mean,
    max(u.mean) FILTER (WHERE u.source = 'purchase') AS purchase_mean, sum(u.weight * u.mean) / sum(u.weight) AS consensus_mean, sum(u.weight * u.low) / sum(u.weight) AS sensitivity_low,
    sum(u.weight * u.high) / sum(u.weight) AS sensitivity_high, min(u.mean) AS lo, max(u.mean) AS hi FROM est e LEFT JOIN usable u USING (run_id, season, source, canonical_player_id, stat) GROUP BY 1, 2, 3, 4),
consensus AS (SELECT *, hi - lo AS source_range, (hi - lo) / greatest(abs(consensus_mean), 1e-12) AS relative_disagreement, (hi - lo) > 10 OR (hi - lo) / greatest(abs(consensus_mean), 1e-12) > 0.2 AS disagreement_flag,
    CASE WHEN source_count > 0 THEN 'passed' ELSE 'excluded' END AS quality_status FROM cons)"""

ORACLES["weighted_consensus"] = with_(ESTIMATES) + f"""SELECT run_id, season, canonical_player_id, stat, canonical_player_name, coalesce(source_list, '') AS source_list, source_count::BIGINT AS source_count,
    {r("wsum", name="configured_weight_sum")}, {r("CASE WHEN wsum > 0 THEN 1 ELSE 0 END", name="effective_weight_sum")}, {rs("click_mean view_mean purchase_mean")},
    {r("CASE WHEN click_mean IS NULL THEN 0 ELSE 1 / wsum END", name="click_effective_weight")}, {rs("consensus_mean sensitivity_low sensitivity_high")}, {r("lo", name="minimum_source_mean")},
    {r("hi", name="maximum_source_mean")}, {rs("source_range relative_disagreement")}, disagreement_flag, quality_status, CASE WHEN source_count > 0 THEN '' ELSE 'minimum_sources_not_met' END AS exclusion_reason FROM consensus"""

_NGATE = [("aggregation.known_sources", "(SELECT count(*) = 0 FROM est WHERE source NOT IN ('click', 'view', 'purchase', 'signup', 'error'))"),
          ("aggregation.eligible_values", "(SELECT count(*) = 0 FROM usable WHERE mean IS NULL)"), ("aggregation.source_projection_keys", "(SELECT count(*) = count(DISTINCT (run_id, season, canonical_player_id, stat, source)) FROM est)"),
          ("aggregation.consensus_keys", "(SELECT count(*) = count(DISTINCT (run_id, season, canonical_player_id, stat)) FROM consensus)"),
          ("aggregation.eligible_lineage", "(SELECT count(*) > 0 FROM consensus WHERE quality_status = 'passed')")]
ORACLES["consensus_gate"] = with_(ESTIMATES) + " UNION ALL ".join(f"SELECT '{n}' AS name, {p} AS passed, 'error' AS severity" for n, p in _NGATE)

_MODES = R.SCORING.bonuses
SCORED = ESTIMATES + """,
wide AS (SELECT run_id, season, canonical_player_id, max(canonical_player_name) AS canonical_player_name, max(consensus_mean) FILTER (WHERE stat = 'quantity') AS quantity,
    max(consensus_mean) FILTER (WHERE stat = 'line_count') AS line_count, max(consensus_mean) FILTER (WHERE stat = 'returned_quantity') AS returned_quantity FROM consensus GROUP BY 1, 2, 3),
points AS (SELECT *, coalesce(quantity, 0) * 0.1 + coalesce(line_count, 0) * 6 AS base, quantity IS NOT NULL OR line_count IS NOT NULL OR returned_quantity IS NOT NULL AS scored,
    concat_ws('|', CASE WHEN line_count IS NOT NULL THEN 'returns' END, CASE WHEN quantity IS NOT NULL OR line_count IS NOT NULL THEN 'volume' END) AS scoring_profile,
    concat_ws('|', CASE WHEN line_count IS NOT NULL THEN 'line_count' END, CASE WHEN quantity IS NOT NULL THEN 'quantity' END, CASE WHEN returned_quantity IS NOT NULL THEN 'returned_quantity' END) AS components_used,
    concat_ws('|', 'cancelled_quantity', CASE WHEN line_count IS NULL THEN 'line_count' END, CASE WHEN quantity IS NULL THEN 'quantity' END, CASE WHEN returned_quantity IS NULL THEN 'returned_quantity' END) AS components_missing,
    NOT ((quantity IS NOT NULL OR line_count IS NOT NULL) AND quantity IS NOT NULL AND line_count IS NOT NULL AND (line_count IS NULL OR returned_quantity IS NOT NULL)) AS blank FROM wide)"""
def _score(digits: int = 6) -> str:
    return f"""SELECT run_id, season, canonical_player_id, coalesce(canonical_player_name, '') AS canonical_player_name, scoring_profile, components_used, components_missing, false AS projection_complete,
    'market_supported_stats_only' AS scoring_scope, {rs("quantity line_count returned_quantity", digits)}, NULL::DOUBLE AS cancelled_quantity, """ + ", ".join(
        r(f"CASE WHEN scored THEN base + coalesce(returned_quantity * {b}, 0) END", digits, f"partial_fpts_{m}") + ", " + r(f"CASE WHEN scored AND NOT blank THEN base + coalesce(returned_quantity * {b}, 0) END", digits, f"fpts_{m}")
        for m, b in _MODES.items()) + " FROM points"


_SCORE = _score()
ORACLES["score_profiles"] = with_(SCORED) + _SCORE
ORACLES["projection_mart"] = with_(SCORED) + _SCORE
# From projections of sources (``est``) onwards.
AFTER = SCORED[SCORED.index("weights AS (SELECT * FROM (VALUES"):]
_SGATE = [("scoring.input_keys", "(SELECT count(*) = count(DISTINCT (run_id, season, canonical_player_id, stat)) FROM consensus)"),
          ("scoring.player_grain", "(SELECT count(*) = count(DISTINCT (run_id, season, canonical_player_id)) FROM points)"),
          ("scoring.no_missing_to_zero", "(SELECT count(*) = 0 FROM points WHERE scored AND blank AND components_missing = '')")]
_SGATE += [(f"scoring.{n}", f"""(SELECT count(*) = 0 FROM (SELECT base + coalesce(returned_quantity * {_MODES['full_ppr']}, 0) AS hi, base + coalesce(returned_quantity * {_MODES['standard']}, 0) AS lo, * FROM points WHERE {w})
    WHERE abs(hi - lo - coalesce(returned_quantity, 0) * {_MODES['full_ppr'] - _MODES['standard']}) > 1e-9)""") for n, w in (("full_ppr_identity", "scored"), ("full_ppr_publishable_identity", "scored AND NOT blank"))]
ORACLES["scoring_gate"] = with_(SCORED) + " UNION ALL ".join(f"SELECT '{n}' AS name, {p} AS passed, 'error' AS severity" for n, p in _SGATE) + \
    " UNION ALL SELECT 'scoring.ppr_monotonicity', (SELECT count(*) = 0 FROM points WHERE returned_quantity < 0), 'error'"
ORACLES["mart_gate"] = with_(SCORED, "mart AS (" + _SCORE + ")") + """SELECT 'mart.projections.row_count' AS name, (SELECT count(*) FROM wide) = (SELECT count(DISTINCT (run_id, season, canonical_player_id)) FROM est) AS passed, 'error' AS severity
    UNION ALL SELECT 'mart.projections.headers', (SELECT count(*) = count(DISTINCT column_name) FROM (DESCRIBE mart)), 'error' UNION ALL
    SELECT 'mart.projections.no_error_values', (SELECT count(*) = 0 FROM points WHERE isnan(base) OR isinf(base)), 'error' UNION ALL
    SELECT 'mart.projections.source_lineage', (SELECT count(*) = 0 FROM wide WHERE canonical_player_id NOT IN (SELECT canonical_player_id FROM est)), 'error'"""
_TEXTS = {"normalized.nonempty": "rows are present", "normalized.types_and_domains": "values are canonical", "normalized.book_odds": "two-sided rows keep valid odds",
          "normalized.contract_probabilities": "probabilities lie in [0, 1]", "normalized.row_count": "every outcome is represented", "normalized.keys_unique": "keys are unique",
          "scoring.input_keys": "consensus grain is unique", "scoring.player_grain": "one row per player", "scoring.no_missing_to_zero": "missing values are not turned into zero",
          "scoring.full_ppr_identity": "top mode equals base plus bonus units", "scoring.full_ppr_publishable_identity": "published modes reconcile", "scoring.ppr_monotonicity": "modes rise with the bonus"}
ORACLES["checks_mart"] = "WITH g AS (" + ORACLES["quote_gates"] + "), s AS (" + ORACLES["scoring_gate"] + "), t AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{m}')" for n, m in _TEXTS.items()) + """) v(name, message))
SELECT split_part(name, '.', 1) AS task, name AS check_name, severity, message AS expected_rule, passed, message FROM (SELECT * FROM g UNION ALL SELECT * FROM s) JOIN t USING (name)"""

PAIRED = ESTIMATES + """,
pivoted AS (SELECT canonical_player_id, stat, max(mean) FILTER (WHERE source = 'click') AS click, max(mean) FILTER (WHERE source = 'error') AS error, max(mean) FILTER (WHERE source = 'purchase') AS purchase,
    max(mean) FILTER (WHERE source = 'signup') AS signup, max(mean) FILTER (WHERE source = 'view') AS view FROM est WHERE quality_status = 'passed' GROUP BY 1, 2),
paired AS (SELECT *, 2 * abs(b - a) / (a + b) AS sym, (b - a) / a AS signed FROM (SELECT 'click|view' AS pair, stat, click AS a, view AS b FROM pivoted UNION ALL SELECT 'click|purchase', stat, click, purchase FROM pivoted
    UNION ALL SELECT 'view|purchase', stat, view, purchase FROM pivoted) WHERE a IS NOT NULL AND b IS NOT NULL)"""
ORACLES["source_pivot"] = with_(PAIRED) + f"SELECT canonical_player_id, stat, {rs('click error purchase signup view')} FROM pivoted"
ORACLES["source_agreement"] = with_(PAIRED) + f"""SELECT pair, count(*)::BIGINT AS overlap, {r("corr(a, b)", name="correlation")}, {r("median(sym)", name="median_abs_difference")},
    {r("avg(signed)", name="mean_signed_difference")} FROM paired GROUP BY 1"""
_LABEL = "CASE stat WHEN 'quantity' THEN 'Quantity' WHEN 'line_count' THEN 'Line Count' ELSE 'Returned Quantity' END AS stat_label"
ORACLES["source_agreement_by_stat"] = with_(PAIRED) + f"""SELECT pair, stat, {_LABEL}, count(*)::BIGINT AS overlap, {r("median(sym)", name="median_abs_difference")},
    {r("median(b / a)", name="median_right_to_left_ratio")} FROM paired GROUP BY 1, 2"""

LIQUID = """
liquid AS (SELECT canonical_player_id, stat, count(*) AS contributing_quotes, sum(volume) AS total_volume, sum(open_interest) AS total_open_interest, min(open_interest) AS minimum_open_interest,
    sum(volume % 3) AS volume_24h, median(ask - bid) AS median_spread, max(ask - bid) AS maximum_spread, min(CASE WHEN source_market_id::BIGINT % 90 > 10 THEN source_market_id::BIGINT % 90 END)::DOUBLE AS minimum_top_size
    FROM model WHERE source = 'purchase' AND inclusion_status = 'included' GROUP BY 1, 2)"""
ORACLES["curve_liquidity"] = with_(QUOTES, LIQUID) + f"""SELECT canonical_player_id, stat, contributing_quotes::BIGINT AS contributing_quotes,
    {rs("total_volume total_open_interest minimum_open_interest volume_24h median_spread maximum_spread minimum_top_size")} FROM liquid"""
ORACLES["projection_liquidity"] = with_(ESTIMATES, LIQUID) + f"""SELECT stat, count(*)::BIGINT AS curves, count(*) FILTER (WHERE volume_24h = 0)::BIGINT AS idle, count(total_volume)::BIGINT AS quoted,
    {r("sum(total_volume)", name="volume")} FROM est LEFT JOIN liquid USING (canonical_player_id, stat) WHERE source = 'purchase' AND quality_status = 'passed' GROUP BY 1"""
ORACLES["disagreement_rate"] = with_(ESTIMATES) + f"""SELECT list_contains(string_split(source_list, '|'), 'purchase') AS has_source, count(*)::BIGINT AS rows, count(*) FILTER (WHERE disagreement_flag)::BIGINT AS flags,
    {r("avg(disagreement_flag::INT)", name="rate")} FROM consensus WHERE quality_status = 'passed' GROUP BY 1"""

THREE = PAIRED + """,
three AS (SELECT canonical_player_id, stat, (purchase - (click + view) / 2) / ((click + view) / 2) AS contract_vs_books, (consensus_mean - (click + view) / 2) / ((click + view) / 2) AS consensus_vs_books, disagreement_flag
    FROM pivoted JOIN consensus USING (canonical_player_id, stat) WHERE click IS NOT NULL AND view IS NOT NULL AND purchase IS NOT NULL)"""
ORACLES["three_source"] = with_(THREE) + f"""SELECT stat, {_LABEL}, count(*)::BIGINT AS overlaps, count(*) FILTER (WHERE disagreement_flag)::BIGINT AS disagreement_flags, {r("median(contract_vs_books)", name="median_contract_vs_books")},
    {r("median(abs(contract_vs_books))", name="median_abs_contract_vs_books")}, {r("median(consensus_vs_books)", name="median_consensus_shift")} FROM three GROUP BY 1"""
ORACLES["top_outliers"] = with_(THREE) + f"""SELECT canonical_player_id, stat, canonical_player_name, canonical_position, {rs("contract_vs_books consensus_vs_books")}
    FROM (SELECT * FROM three ORDER BY abs(contract_vs_books) DESC, canonical_player_id, stat LIMIT 15)
    LEFT JOIN (SELECT canonical_player_id, min(canonical_player_name) AS canonical_player_name, min(canonical_position) AS canonical_position FROM est GROUP BY 1) USING (canonical_player_id)"""
ORACLES["rank_correlation"] = with_(THREE, LIQUID, """
xy AS (SELECT abs(contract_vs_books) AS x, total_volume AS y FROM three LEFT JOIN liquid USING (canonical_player_id, stat) WHERE total_volume IS NOT NULL),
ranked AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM xy),
rho AS (SELECT corr(rx, ry) AS rho, count(*) AS n FROM ranked),
tail AS (SELECT rho, n, exp(lgamma((n - 2) / 2.0 + 0.5) - lgamma((n - 2) / 2.0) - lgamma(0.5)) * 2 * (1 - abs(rho)) / 20000 / 3 AS scale,
    unnest(range(0, 20001)) AS i FROM rho)""") + f"""SELECT {r("any_value(rho)", name="rho")}, any_value(n)::BIGINT AS n,
    {r("sum(scale * CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(greatest(0, 1 - pow(abs(rho) + (1 - abs(rho)) * i / 20000, 2)), (n - 2) / 2.0 - 1))", name="p_value")} FROM tail"""
ORACLES["line_ratios"] = with_(ESTIMATES) + f"""SELECT m.source, m.stat, count(*)::BIGINT AS quotes, {r("median(mean / threshold_k)", name="median_mean_to_threshold")}, {r("median(market_overround)", name="median_overround")},
    CASE m.source WHEN 'click' THEN 'Click' ELSE 'View' END AS source_label, {_LABEL.replace("CASE stat", "CASE m.stat")} FROM model m JOIN est USING (source, user_id, stat) WHERE m.source IN ('click', 'view') GROUP BY 1, 2"""
ORACLES["funnel"] = with_(ESTIMATES) + """SELECT 'raw_quotes' AS stage, count(*)::BIGINT AS count FROM model WHERE source = 'purchase' UNION ALL SELECT 'priced_quotes', count(*) FROM model WHERE source = 'purchase' AND inclusion_status = 'included'
    UNION ALL SELECT 'contributing_quotes', count(*) FROM model JOIN est USING (source, user_id, stat) WHERE source = 'purchase' AND quality_status = 'passed'
    UNION ALL SELECT 'eligible_curves', count(*) FROM est WHERE source = 'purchase' AND quality_status = 'passed'
    UNION ALL SELECT 'single_threshold_curves', count(*) FROM est WHERE source = 'purchase' AND quality_status = 'passed' AND eligible_quote_count = 1 UNION ALL SELECT 'dispersion_updates', 0"""
ORACLES["headline_counts"] = with_(ESTIMATES) + f"""SELECT count(*) FILTER (WHERE source_count > 0)::BIGINT AS published_rows, count(*) FILTER (WHERE source_count = 1)::BIGINT AS single_source_rows,
    {r("count(*) FILTER (WHERE source_count = 1) / count(*) FILTER (WHERE source_count > 0)", name="single_source_rate")}, count(*) FILTER (WHERE source_count > 0 AND disagreement_flag)::BIGINT AS disagreement_rows FROM consensus"""
ORACLES["source_skew"] = with_(QUOTES) + f"SELECT {r("date_diff('second', min(snapshot_utc::TIMESTAMP), max(snapshot_utc::TIMESTAMP))", name='source_skew_seconds')} FROM snap"
ORACLES["top_scores"] = with_(SCORED) + f"""SELECT canonical_player_id, scoring_profile, {r("base", name="fpts_standard")}, {r("base + coalesce(returned_quantity, 0)", name="fpts_full_ppr")} FROM points
    WHERE scored AND NOT blank ORDER BY base DESC, canonical_player_id LIMIT 15"""

_SETTINGS = [("missing_stat_policy", R.SCORING.missing_stat_policy, True)] + [(c, str(w), c in STATS) for c, w in R.SCORING.weights.items()] + [
    (f"reception_bonus.{m}", str(b), True) for m, b in _MODES.items()] + [(f"required_profiles.{p}", "|".join(n), set(n) <= set(STATS)) for p, n in R.SCORING.required_profiles.items()]
ORACLES["settings_with_use"] = with_(SCORED, "settings AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', {str(c).lower()})" for a, b, c in _SETTINGS) + ") v(setting, value, supported))") + """
SELECT setting, value, supported AS supported_by_current_markets, coalesce(players, 0)::BIGINT AS players FROM settings
    LEFT JOIN (SELECT setting, count(*) AS players FROM (SELECT unnest(string_split(components_used, '|')) AS setting FROM points WHERE components_used <> '') GROUP BY 1) USING (setting)"""
