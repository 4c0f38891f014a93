"""SQL equivalents of the gates over planted faults: every check and its details are counted from the rows."""

from __future__ import annotations

from curvelake.plans import roles as R
from curvelake.plans.sql import CORRECTED, ESTIMATES, HISTORY, NEAR, QUOTES, SCORED, STATS, WEEKLY, with_

ORACLES: dict[str, str] = {}


def check(name: str, passed: str, details: dict[str, str], source: str = "n", severity: str = "error") -> str:
    """One check row; details are keys (in order) and expressions."""
    parts = " || ',' || ".join(f"""'"{k}":' || coalesce('"' || ({v}) || '"', 'null')""" for k, v in sorted(details.items()))
    return f"SELECT {name if chr(39) in name else chr(39) + name + chr(39)} AS name, coalesce({passed}, false) AS passed, '{severity}' AS severity, '{{' || {parts or chr(39) * 2} || '}}' AS details FROM {source}"


def zero(name: str, count: str, key: str = "rows", severity: str = "error", source: str = "n") -> str:
    return check(name, f"({count}) = 0", {key: count}, source, severity)


def grain(name: str, rows: str, key: str) -> str:
    """Repeated keys of ``rows``; ``key`` is an expression."""
    return check(name, "d = 0", {"duplicate_keys": "d", "duplicate_rows": "r", "sample": "s"}, f"""(SELECT count(*) AS d, coalesce(sum(c), 0)::BIGINT AS r,
        coalesce((SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT {key} AS k FROM {rows} GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 5)), '') AS s
        FROM (SELECT {key} AS k, count(*) AS c FROM {rows} GROUP BY 1 HAVING count(*) > 1))""")


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


# --- history --------------------------------------------------------------------------

FAULTY_SEASONS = """
late AS (SELECT s.* REPLACE (CASE WHEN gsis_player_id::INT % 50 = 1 THEN 1e6 ELSE quantity END AS quantity, CASE gsis_player_id::INT % 50 WHEN 2 THEN schedule_games + 2
    WHEN 3 THEN schedule_games + 1 ELSE games END AS games, CASE WHEN gsis_player_id::INT % 50 <> 4 THEN player_name END AS player_name),
    CASE WHEN gsis_player_id::INT % 50 <> 5 THEN team END AS team FROM seasons s JOIN teams USING (season, gsis_player_id)),
m AS (SELECT * FROM (SELECT 1) """ + " ".join(f", (SELECT count(*) FILTER (WHERE {s} > {R.HISTORY.plausible_maximum[s]} OR {s} < 0) AS bad_{s} FROM late)" for s in STATS) + """,
    (SELECT count(*) FILTER (WHERE games > schedule_games + 1) AS impossible, count(*) FILTER (WHERE games > schedule_games) AS long, avg((player_name IS NULL)::INT) AS no_name,
        avg((team IS NULL)::INT) AS no_team, avg((position IS NULL)::INT) AS no_position FROM late))"""
ORACLES["weekly_faults"] = with_(WEEKLY, FAULTY_SEASONS, f"""
w0 AS (SELECT w.*, o_orderkey AS i FROM (SELECT o_orderkey, year(o_orderdate) AS season, weekofyear(o_orderdate) AS week, o_custkey::VARCHAR AS gsis_player_id, c_name AS player_name,
    o_orderpriority AS team, c_mktsegment AS position, 1.0::DOUBLE AS order_count, coalesce(n, 0) AS shipped_lines, coalesce(q, 0) AS quantity, coalesce(n, 0) AS line_count, coalesce(ret, 0) AS returned_quantity
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN order_lines ON l_orderkey = o_orderkey WHERE year(o_orderdate) BETWEEN 1995 AND 2000 AND o_orderstatus <> 'P') w WHERE season <> 1996),
w1 AS (SELECT * EXCLUDE (i, o_orderkey) REPLACE (CASE WHEN i % 97 <> 1 THEN gsis_player_id END AS gsis_player_id, CASE WHEN i % 97 <> 2 THEN quantity END AS quantity,
    CASE WHEN i % 97 = 3 THEN -1 ELSE line_count END AS line_count, CASE WHEN i % 97 = 5 THEN -1 ELSE shipped_lines END AS shipped_lines) FROM (SELECT * FROM w0 UNION ALL SELECT * FROM w0 WHERE i % 97 = 7)),
g AS (SELECT count(*) AS c, count(*) > 1 AND count(DISTINCT (player_name, position, order_count, shipped_lines, quantity, line_count, returned_quantity)) = 1 AS exact,
    min(player_name) <> max(player_name) OR min(position) <> max(position) AS conflicting FROM w1 GROUP BY season, week, gsis_player_id, team),
n AS (SELECT count(*) AS rows, count(*) FILTER (WHERE gsis_player_id IS NULL) AS no_id, {", ".join(f"count(*) FILTER (WHERE {s} IS NULL OR {s} < 0) AS bad_{s}" for s in STATS)},
    {", ".join(f"count(*) FILTER (WHERE {o} < 0) AS bad_{o}" for o in R.HISTORY.opportunities)} FROM w1),
k AS (SELECT count(*) AS rows, count(*) FILTER (WHERE exact) AS exact, count(*) FILTER (WHERE conflicting) AS conflicting, count(*) FILTER (WHERE c > 1) AS merged FROM g)""") + union(
    check("historical.regular_season_rows", "rows > 0", {"rows": "rows"}), zero("historical.player_ids_present", "no_id", "missing_rows"),
    *[zero(f"historical.target_values_valid.{s}", f"bad_{s}") for s in STATS], *[zero(f"historical.opportunity_values_valid.{o}", f"bad_{o}") for o in R.HISTORY.opportunities],
    check("historical.weekly_keys_unique", "exact = 0 AND conflicting = 0", {"rows": "rows", "duplicate_groups_aggregated": "merged", "exact_duplicates": "exact", "conflicting": "conflicting"}, "k"),
    check("historical.seasons_complete", "false", {"missing": "1996"}), *[zero(f"historical.implausible_totals.{s}", f"bad_{s}", source="m") for s in STATS],
    zero("historical.schedule_lengths", "impossible", source="m"), zero("historical.player_schedule_exceptions", "long", severity="warning", source="m"),
    *[zero(f"historical.missingness.{c}", f"no_{n}", "missingness_rate", "warning", "m") for c, n in (("player_name", "name"), ("team", "team"), ("position", "position"))])
ORACLES["fired_warnings"] = with_(WEEKLY, FAULTY_SEASONS) + """SELECT 'historical.player_schedule_exceptions' AS "check", 'games stay within the schedule' AS message, '{"rows":"' || long || '"}' AS details FROM m WHERE long > 0
UNION ALL SELECT 'historical.missingness.player_name', 'descriptor is always present', '{"missingness_rate":"' || no_name || '"}' FROM m WHERE no_name > 0
UNION ALL SELECT 'historical.missingness.team', 'descriptor is always present', '{"missingness_rate":"' || no_team || '"}' FROM m WHERE no_team > 0"""

FAULTY_PREDICTIONS = """
f0 AS (SELECT *, gsis_player_id::INT % 50 AS f FROM applied),
f1 AS (SELECT * REPLACE (CASE f WHEN 5 THEN NULL WHEN 9 THEN -5 WHEN 10 THEN 2.5 ELSE realized_total END AS realized_total, CASE WHEN f = 6 THEN 'other' ELSE stat END AS stat,
    CASE f WHEN 11 THEN NULL WHEN 12 THEN 0 ELSE corrected END AS corrected) FROM (SELECT * FROM f0 UNION ALL SELECT * FROM f0 WHERE f = 3)),
c AS (SELECT stat, realized_total AS y, corrected AS mu, target_season FROM f1 WHERE training_eligible AND target_season BETWEEN 1997 AND 2000),
u AS (SELECT stat, target_season, CASE WHEN y < 0 THEN 'negative' WHEN abs(y - round(y)) > 1e-9 THEN 'noninteger' WHEN mu IS NULL THEN 'invalid' WHEN mu = 0 AND y > 0 THEN 'impossible' WHEN mu = 0 THEN 'zero' ELSE '' END AS why FROM c),
per AS (SELECT stat, count(*) FILTER (WHERE why = 'negative') AS negative, count(*) FILTER (WHERE why = 'noninteger') AS noninteger, count(*) FILTER (WHERE why = 'invalid') AS invalid,
    count(*) FILTER (WHERE why = 'impossible') AS impossible, count(*) FILTER (WHERE why = '' AND target_season < 2000) AS training, count(*) FILTER (WHERE why = '' AND target_season >= 2000) AS held FROM u GROUP BY 1),
sized AS (SELECT stat, count(*) FILTER (WHERE training_eligible) AS eligible FROM f1 GROUP BY 1),
thaw AS (SELECT stat, bool_or(f = 2) OR min(a) <> max(a) OR min(CASE WHEN f = 8 THEN -1 ELSE b END) <> max(CASE WHEN f = 8 THEN -1 ELSE b END) AS varies FROM f1 WHERE target_season >= 2000 AND fitted GROUP BY 1),
n AS (SELECT count(*) FILTER (WHERE f = 1) AS leaks, count(*) FILTER (WHERE f = 2) AS fit_leaks, count(*) FILTER (WHERE f IN (1, 2)) AS mismatches, count(*) FILTER (WHERE f = 5) AS untyped,
    count(*) FILTER (WHERE f = 6) AS unknown, count(*) FILTER (WHERE f = 7) AS unparsed, count(*) FILTER (WHERE fitted AND (f = 8 OR b - 0.02 <= 2.98e-6 OR 3 - b <= 2.98e-6)) AS unsound,
    (SELECT count(*) FILTER (WHERE varies) FROM thaw) AS thawed FROM f1)"""
_KEY = "target_season || '/' || gsis_player_id || '/' || stat"
_C = "historical_calibration"
ORACLES["prediction_faults"] = with_(*CORRECTED, FAULTY_PREDICTIONS, recursive=True) + union(
    grain("historical.output_keys_unique", "f1", _KEY), zero("historical.no_lookahead", "leaks"), zero("historical.baseline_bias_no_lookahead", "fit_leaks"),
    zero("historical.holdout_mean_correction_frozen", "thawed", "stats"),
    check("'historical.cohort_size.' || stat", "eligible >= 20", {"eligible_player_seasons": "eligible"}, "sized"),
    grain(f"{_C}.input_keys", "f1", _KEY), zero(f"{_C}.input_types", "untyped"), zero(f"{_C}.supported_stats", "unknown"), zero(f"{_C}.no_lookahead", "fit_leaks"),
    zero(f"{_C}.feature_lineage", "mismatches"), zero(f"{_C}.feature_lineage_format", "unparsed"), zero(f"{_C}.baseline_bias_correction", "unsound"),
    zero(f"'{_C}.' || stat || '.signed_negative_observations'", "negative", severity="warning", source="per"), zero(f"'{_C}.' || stat || '.integer_outcomes'", "noninteger", source="per"),
    zero(f"'{_C}.' || stat || '.baseline_domain'", "invalid", source="per"), zero(f"'{_C}.' || stat || '.zero_baseline_consistency'", "impossible", source="per"),
    check(f"'{_C}.' || stat || '.training_cohort'", "training >= 20", {"observed": "training"}, "per"), check(f"'{_C}.' || stat || '.holdout_cohort'", "held >= 30", {"observed": "held"}, "per"))

# --- quotes and means -----------------------------------------------------------------

ORACLES["pricing_faults"] = with_(QUOTES, """
s AS (SELECT *, source_market_id::INT % 40 AS f, source IN ('click', 'view') AS book, inclusion_status = 'included' AS inc FROM priced),
n AS (SELECT count(*) AS rows, count(*) FILTER (WHERE inc AND f = 0) AS canonical, count(*) FILTER (WHERE NOT inc AND f = 1) AS auditable,
    count(*) FILTER (WHERE inc AND book AND f IN (0, 2)) AS pairs, count(*) FILTER (WHERE NOT book AND (f = 3 OR f = 0 AND inc OR f = 1 AND NOT inc)) AS devigged,
    count(*) FILTER (WHERE inc AND NOT book AND f = 5) AS quotes, count(*) FILTER (WHERE book AND f = 7) AS decimals FROM s)""") + union(
    check("pricing.nonempty", "rows > 0", {}), zero("pricing.included_canonical_probability", "canonical"), zero("pricing.exclusions_are_auditable", "auditable"),
    zero("pricing.book_pairs_reconcile", "pairs"), zero("pricing.contracts_not_devigged", "devigged"), zero("pricing.contract_quote_fields", "quotes"),
    zero("pricing.source_decimal_crosscheck", "decimals", severity="warning"))

ORACLES["model_faults"] = with_(*NEAR, """
p0 AS (SELECT *, user_id % 29 AS f, eligible > 0 AS tried FROM quality),
p1 AS (SELECT * FROM p0 UNION ALL SELECT * FROM p0 WHERE f = 4),
b0 AS (SELECT *, user_id % 31 AS f, used AND mean IS NOT NULL AS fit FROM back),
b1 AS (SELECT *, CASE WHEN f = 1 AND NOT used THEN 0.5 WHEN f = 2 THEN NULL WHEN f = 3 AND fit THEN threshold_k / 1e6 ELSE sv END AS shown FROM (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE fit AND f = 5)),
points AS (SELECT source, user_id, stat, threshold_k, min(shown) AS lo, max(shown) AS hi FROM b1 WHERE shown IS NOT NULL GROUP BY ALL),
steps AS (SELECT (hi - lag(lo) OVER (PARTITION BY source, user_id, stat ORDER BY threshold_k NULLS FIRST) > 1e-12)::INT AS up FROM points),
n AS (SELECT (SELECT count(*) FILTER (WHERE quality_status = 'passed') FROM p1) AS passed, (SELECT count(*) FILTER (WHERE tried AND (mean IS NULL OR edge OR f = 1)) FROM p1) AS unsolved,
    (SELECT count(*) FILTER (WHERE tried AND (mean IS NULL OR low IS NULL OR f = 2)) FROM p1) AS no_bounds, (SELECT count(*) FILTER (WHERE quality_status = 'passed' AND f IN (2, 3)) FROM p1) AS outside,
    (SELECT count(*) FILTER (WHERE NOT book AND quality_status = 'excluded' AND mean IS NOT NULL) FROM p1) AS quarantined, (SELECT count(*) = 0 FROM p1 WHERE f = 5 AND book AND tried) AS book_fine,
    (SELECT count(*) = 0 FROM p1 WHERE f = 6 AND NOT book AND quality_status = 'passed') AS curves_fine, (SELECT count(*) = 0 FROM p1 WHERE NOT book AND quality_status = 'passed' AND mae > 0.6) AS held_fine,
    (SELECT 2 * count(*) FROM b0 WHERE fit AND f = 5) AS repeated, (SELECT count(*) FROM b1 WHERE NOT used AND shown IS NOT NULL) AS excluded_contributed,
    (SELECT count(*) FROM b1 WHERE used AND shown IS NULL) AS included_missing, (SELECT count(*) FROM b1 WHERE inclusion_status = 'included' AND f = 6) AS broken,
    (SELECT count(*) + count(*) FILTER (WHERE user_id % 31 = 5) FROM near) AS evaluated, (SELECT count(*) FILTER (WHERE abs(mean + CASE WHEN user_id % 31 = 4 THEN 100 ELSE 0 END - proxy) > lim)
        + count(*) FILTER (WHERE user_id % 31 = 5 AND shift > lim) FROM near) AS violations, (SELECT coalesce(sum(up), 0)::BIGINT FROM steps) AS rising)""", recursive=True) + union(
    zero("model.current_market_thresholds_unique_within_source", "repeated", "duplicate_rows"),
    grain("model.source_projection_keys", "p1", "run_id || '/' || season || '/user:' || user_id || '/' || stat || '/' || source"),
    check("model.at_least_one_projection", "passed > 0", {"eligible_rows": "passed"}), zero("model.mean_optimizers", "unsolved"), zero("model.sensitivity_bounds", "no_bounds"),
    check("model.book_back_substitution", "book_fine", {}), check("model.curve_source_residuals", "curves_fine", {}), check("model.curve_source_holdout", "held_fine", {}),
    zero("model.curves_quarantined", "quarantined", "curves", "warning"), zero("model.mean_domains", "outside"), zero("model.pricing_included_quote_contract", "broken"),
    check("model.quote_inclusion_lineage", "excluded_contributed = 0 AND included_missing = 0", {"excluded_contributed": "excluded_contributed", "included_missing": "included_missing"}),
    check("model.near_even_market_mean_plausibility", "violations = 0", {"evaluated_quotes": "evaluated", "violations": "violations"}),
    zero("model.fitted_survival_monotonicity", "rising", "thresholds"), check("model.final_dispersions", "false", {"statistics": "1"}))

# --- consensus, scores, marts ---------------------------------------------------------

_PLAYER = "run_id || '/' || season || '/' || canonical_player_id"
ORACLES["consensus_faults"] = with_(ESTIMATES, """
e1 AS (SELECT *, user_id % 29 AS f FROM (SELECT * FROM est UNION ALL SELECT * FROM est WHERE user_id % 29 = 3)),
e2 AS (SELECT * REPLACE (CASE WHEN f = 1 AND source = 'error' THEN 'nowhere' ELSE source END AS source) FROM e1),
c1 AS (SELECT *, canonical_player_id[6:]::INT % 31 AS f FROM consensus), c2 AS (SELECT * FROM c1 UNION ALL SELECT * FROM c1 WHERE f = 4),
n AS (SELECT (SELECT count(*) FROM e2 WHERE source = 'nowhere') AS unknown, (SELECT count(*) FROM e2 JOIN weights USING (source) WHERE f = 2 AND quality_status = 'passed') AS invalid,
    (SELECT count(*) FROM c2 WHERE quality_status = 'passed') AS published, (SELECT count(*) FROM c2 WHERE quality_status = 'passed' AND f = 5) AS thin)""") + union(
    zero("aggregation.known_sources", "unknown"), zero("aggregation.eligible_values", "invalid", "invalid_rows"),
    grain("aggregation.source_projection_keys", "e2", _PLAYER + " || '/' || stat || '/' || source"), grain("aggregation.consensus_keys", "c2", _PLAYER + " || '/' || stat"),
    check("aggregation.eligible_lineage", "published > 0 AND thin = 0", {"consensus_rows": "published", "too_few_sources": "thin"}))

ORACLES["scoring_faults"] = with_(SCORED, """
c1 AS (SELECT *, canonical_player_id[6:]::INT % 31 AS f FROM consensus), c2 AS (SELECT * FROM c1 UNION ALL SELECT * FROM c1 WHERE f = 4),
s1 AS (SELECT *, canonical_player_id[6:]::INT % 29 AS f FROM points), s2 AS (SELECT * FROM s1 UNION ALL SELECT * FROM s1 WHERE f = 3),
n AS (SELECT count(*) FILTER (WHERE f = 6 AND scored) AS hidden, count(*) FILTER (WHERE f = 5 AND scored) AS partial, count(*) FILTER (WHERE f = 2 AND scored AND NOT blank) AS published,
    count(*) FILTER (WHERE f = 5 AND scored AND coalesce(returned_quantity, 0) >= 0) AS falling FROM s2)""") + union(
    grain("scoring.input_keys", "c2", _PLAYER + " || '/' || stat"), grain("scoring.player_grain", "s2", _PLAYER), zero("scoring.no_missing_to_zero", "hidden"),
    zero("scoring.full_ppr_identity", "partial"), zero("scoring.full_ppr_publishable_identity", "published"), zero("scoring.ppr_monotonicity", "falling"))

ORACLES["mart_faults"] = with_(SCORED, """
s1 AS (SELECT *, canonical_player_id[6:]::INT % 29 AS f FROM points),
n AS (SELECT count(*) FILTER (WHERE f <> 1) AS rows, count(*) AS expected, count(*) FILTER (WHERE f = 2) AS broken, count(DISTINCT canonical_player_id) FILTER (WHERE f = 3) AS missing FROM s1)""") + union(
    check("mart.projections.row_count", "rows = expected", {"rows": "rows", "expected": "expected"}), check("mart.projections.headers", "false", {"repeated": "'scoring_scope'"}),
    zero("mart.projections.no_error_values", "broken"), zero("mart.projections.source_lineage", "missing", "missing"))
