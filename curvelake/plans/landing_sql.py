"""SQL equivalents of the queries over files: what the files must say when they are read back."""

from __future__ import annotations

from curvelake.plans import roles as R
from curvelake.plans.sql import QUOTES, WEEKLY, big, match_key, r, with_

ORACLES: dict[str, str] = {}

# --- snapshot files -------------------------------------------------------------------

DOCUMENTS = QUOTES + """,
market AS (SELECT source, event_id, event_id // 250 AS doc, event_id % 50 AS f, snapshot_utc, source IN ('click', 'view') AS book, bid, ask FROM q),
document AS (SELECT source, doc, any_value(snapshot_utc) AS taken, bool_or(book) AS book, source = 'click' AND doc % 5 = 3 AS broken,
    'source=' || source || '/document=' || doc AS file FROM market GROUP BY source, doc),
fresh AS (SELECT *, round(date_diff('second', taken::TIMESTAMP, TIMESTAMP '2024-01-31') / 3600.0, 4) AS age FROM document WHERE NOT broken),
read AS (SELECT m.* FROM market m JOIN fresh USING (source, doc)),
per AS (SELECT source, bool_or(book) AS book, count(*) FILTER (WHERE f = 7) AS season, count(*) FILTER (WHERE f = 11) AS stat,
    count(*) FILTER (WHERE f = 13 OR f = 17) AS over_side, count(*) FILTER (WHERE f = 19) AS operators, count(*) FILTER (WHERE f = 23) AS one_side,
    count(*) FILTER (WHERE f = 29) AS operator, count(*) FILTER (WHERE f = 31) AS probability, count(*) FILTER (WHERE f = 37) AS threshold,
    count(*) FILTER (WHERE f = 41) AS book_side, count(*) FILTER (WHERE f = 43) AS again FROM read GROUP BY source),
sample AS (SELECT source, string_agg(id, ', ' ORDER BY id) AS names FROM (SELECT source, event_id::VARCHAR AS id FROM read WHERE f = 43
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY event_id::VARCHAR) <= 5) GROUP BY 1),
lost AS (SELECT source, count(*) AS documents, count(*) FILTER (WHERE broken) AS unreadable, coalesce((SELECT string_agg(file, ', ' ORDER BY file) FROM
    (SELECT file FROM document b WHERE b.source = d.source AND b.broken ORDER BY file LIMIT 5)), '') AS names FROM document d GROUP BY source)"""
_NAMED = "'{\"file\":\"' || file || '\"}'"
_OF_DOCUMENT = [("schema", "NOT (source = 'error' AND doc % 5 = 0)"), ("season", "NOT (source = 'purchase' AND doc % 5 = 2)"),
                ("collector_quality", "NOT (source = 'view' AND doc % 5 = 1) AND NOT (source = 'error' AND doc % 5 = 0)"), ("nonempty", "true")]
_OF_MARKETS = [("season", "season", "true"), ("stat", "stat", "true"), ("line", "0", "book"), ("two_sided", "one_side", "book"), ("operators", "operators", "book"),
               ("over", "over_side", "book"), ("under", "one_side", "book"), ("threshold", "threshold", "NOT book"), ("operator", "operator", "NOT book"),
               ("probability", "probability", "NOT book"), ("book", "book_side", "NOT book")]
ORACLES["snapshot_files"] = with_(DOCUMENTS) + " UNION ALL ".join([
    """SELECT 'collections.' || source || '.readable' AS name, unreadable = 0 AS passed, 'error' AS severity,
    '{"documents":"' || documents || '","sample":"' || names || '","unreadable":"' || unreadable || '"}' AS details FROM lost""",
    *[f"SELECT 'collections.' || source || '.{n}', {c}, 'error', {_NAMED} FROM fresh" for n, c in _OF_DOCUMENT],
    f"""SELECT 'collections.' || source || '.freshness', NOT (source = 'signup' AND doc % 5 = 1) AND age BETWEEN 0 AND {R.PRICING.max_snapshot_age_hours}, 'error', '{{' ||
    CASE WHEN source = 'signup' AND doc % 5 = 1 THEN '"age_hours":null,' ELSE '"age_hours":"' || age::DOUBLE || '",' END || '"file":"' || file || '"}}' FROM fresh""",
    """SELECT 'collections.' || source || '.expected_placeholders', NOT (source = 'click' AND doc % 5 = 0), 'warning',
    '{"count":"' || CASE WHEN source = 'click' AND doc % 5 = 0 THEN 2 ELSE 0 END || '","file":"' || file || '"}' FROM fresh WHERE book""",
    """SELECT 'collections.' || source || '.unrelated_markets_excluded', NOT (source = 'view' AND doc % 5 = 2), 'warning',
    '{"count":"' || CASE WHEN source = 'view' AND doc % 5 = 2 THEN 1 ELSE 0 END || '","file":"' || file || '"}' FROM fresh WHERE book""",
    *[f"""SELECT 'collections.' || source || '.market.{n}', {c} = 0, 'error', '{{"markets":"' || {c} || '"}}' FROM per WHERE {w}""" for n, c, w in _OF_MARKETS],
    """SELECT 'collections.' || source || '.unique_market_ids', again = 0, 'error',
    '{"duplicate_keys":"' || again || '","duplicate_rows":"' || 2 * again || '","sample":"' || coalesce(names, '') || '"}' FROM per LEFT JOIN sample USING (source)"""])

# --- landed history -------------------------------------------------------------------

ORACLES["landed_seasons"] = with_(WEEKLY) + f"""SELECT {big("season")}, count(*)::BIGINT AS rows, count(DISTINCT week)::BIGINT AS weeks, {r("sum(quantity)", name="quantity")}
    FROM weekly WHERE season >= 1998 GROUP BY season"""
ORACLES["differing_headers"] = with_(WEEKLY) + f"""SELECT {big("season")}, count(*)::BIGINT AS rows, count(DISTINCT gsis_player_id)::BIGINT AS players, min(player_name) AS first_name,
    max(team) AS last_team, {r("sum(quantity)", name="quantity")}, CASE WHEN season >= 1999 THEN sum(week % 40)::DOUBLE END AS age, 0::BIGINT AS experienced FROM weekly GROUP BY season"""

# --- published tables -----------------------------------------------------------------

OUTCOMES = QUOTES + """,
outcome AS (SELECT source, source_market_id, side AS outcome_side, event_id, CASE WHEN side = 'yes' THEN threshold ELSE line END AS threshold,
    CASE side WHEN 'over' THEN over_odds WHEN 'under' THEN under_odds END AS odds, CASE WHEN side = 'yes' THEN ask END AS ask
    FROM (SELECT *, unnest(CASE WHEN source IN ('click', 'view') THEN ['over', 'under'] ELSE ['yes'] END) AS side FROM q))"""
ORACLES["ordered_publication"] = with_(OUTCOMES) + """SELECT ((i - 1) // 400)::BIGINT AS file, arg_min(k, i) AS first_key, arg_max(k, i) AS last_key, count(*)::BIGINT AS rows, 1::BIGINT AS parts
    FROM (SELECT source || '/' || source_market_id || '/' || outcome_side AS k, row_number() OVER (ORDER BY source, source_market_id, outcome_side) AS i FROM outcome) GROUP BY 1"""
ORACLES["republished_csv"] = with_(OUTCOMES) + f"""SELECT source, source_market_id, outcome_side, threshold, CASE WHEN event_id % 9 > 1 THEN odds::BIGINT END AS american_odds,
    {r("ask", name="yes_ask_probability")} FROM outcome"""
ORACLES["alias_faults"] = f"""WITH a AS (SELECT p_partkey AS i, CASE WHEN i % 31 = 0 THEN 'nowhere' WHEN i % 2 = 0 THEN '*' ELSE 'click' END AS source,
    CASE WHEN i % 37 = 0 THEN '—' ELSE p_name || ' ' || p_brand || ' ' || i END AS raw, CASE WHEN i % 41 <> 0 THEN 'listed:' || i % 1000 END AS id,
    CASE WHEN i % 43 <> 0 THEN 'Listed ' || i % 1000 || CASE WHEN i % 47 = 0 THEN ' II' ELSE '' END END AS name FROM part),
b AS (SELECT *, {match_key("raw")} AS k FROM (SELECT * FROM a UNION ALL SELECT i, source, raw, 'listed:again', name FROM a WHERE i % 53 = 0)),
n AS (SELECT (SELECT count(*) FROM b WHERE source = 'nowhere' OR id IS NULL OR name IS NULL) AS incomplete, (SELECT count(*) FROM b WHERE k = '') AS empty,
    (SELECT count(*) FROM (SELECT 1 FROM b GROUP BY source, k HAVING min((coalesce(id, ''), coalesce(name, ''))) <> max((coalesce(id, ''), coalesce(name, ''))))) AS keys,
    (SELECT count(*) FROM (SELECT 1 FROM b GROUP BY id HAVING min(name) <> max(name))) AS ids)
SELECT 'identity.alias_values' AS name, incomplete = 0 AS passed, 'error' AS severity, '{{"rows":"' || incomplete || '"}}' AS details FROM n
UNION ALL SELECT 'identity.alias_keys', empty = 0, 'error', '{{"rows":"' || empty || '"}}' FROM n
UNION ALL SELECT 'identity.alias_contradictions.key', keys = 0, 'error', '{{"keys":"' || keys || '"}}' FROM n
UNION ALL SELECT 'identity.alias_contradictions.id', ids = 0, 'error', '{{"ids":"' || ids || '"}}' FROM n"""

# --- linked payloads ------------------------------------------------------------------

CHAIN = """WITH card AS (SELECT c_custkey, c_name, c_custkey // 50 AS document, c_mktsegment = 'BUILDING' AS mine, c_custkey % 17 <> 0 AS kept FROM customer),
coupon AS (SELECT o_orderkey AS i, o_custkey, substr(o_orderpriority, 1, 1) AS priority FROM orders JOIN card ON o_custkey = c_custkey),
followed AS (SELECT document, c_custkey::VARCHAR AS card_id, c_name, kept, i::VARCHAR AS coupon_id, i % 19 <> 0 AS found,
    CASE WHEN NOT kept OR i % 19 = 0 OR i % 11 = 0 THEN NULL WHEN i % 29 = 0 THEN 'again' ELSE i::VARCHAR END AS market_id, i,
    kept AND i % 19 <> 0 AND i % 13 <> 0 AND i % 11 <> 0 AND i % 29 <> 0 AS attached, priority
    FROM card LEFT JOIN coupon ON o_custkey = c_custkey AND kept WHERE mine AND (NOT kept OR i IS NOT NULL)),
chain AS (SELECT document, card_id, CASE WHEN kept THEN c_name END AS card_title, coupon_id, market_id, CASE WHEN attached THEN 'Market ' || coupon_id END AS market_name,
    CASE WHEN attached THEN 'e' || i % 23 END AS event_id, CASE WHEN attached AND i % 23 % 7 <> 0 THEN 'Name e' || i % 23 END AS event_name,
    CASE WHEN attached THEN priority END AS competition_id, CASE WHEN attached AND priority <> '4' THEN 'Name ' || priority END AS competition_name,
    CASE WHEN NOT kept THEN 'missing_card' WHEN NOT found THEN 'missing_coupon' WHEN i % 11 = 0 AND i % 2 = 1 THEN 'coupon_placeholder_has_no_attached_market'
        WHEN NOT attached THEN 'referenced_market_missing_from_attachments' WHEN i % 23 % 7 = 0 THEN 'referenced_event_missing'
        WHEN priority = '4' THEN 'referenced_competition_missing' WHEN i % 17 = 0 THEN 'attached_market_has_no_offered_runners' ELSE 'linked' END AS status FROM followed)"""
ORACLES["link_chain"] = CHAIN + " SELECT document::BIGINT AS document, * EXCLUDE (document) FROM chain"
_ENDS = ("linked", "missing_card", "missing_coupon", "coupon_placeholder_has_no_attached_market", "referenced_market_missing_from_attachments",
         "referenced_event_missing", "referenced_competition_missing", "attached_market_has_no_offered_runners")
ORACLES["link_counters"] = CHAIN + ", ended AS (SELECT document, count(*) AS links, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in _ENDS) + """,
    count(market_id) - count(DISTINCT market_id) AS repeated, list_distinct(list(event_id)) AS events, list_distinct(list(card_id)) AS cards FROM chain GROUP BY document),
whole AS (SELECT document, count(*) FILTER (WHERE kept) AS cards FROM card GROUP BY document),
parts AS (SELECT c.document, count(*) FILTER (WHERE i % 19 <> 0) AS coupons, count(*) FILTER (WHERE i % 13 <> 0 AND i % 11 <> 0 AND i % 29 <> 0) AS markets,
    count(*) FILTER (WHERE i % 19 <> 0 AND mine AND kept) AS own_coupons, count(*) FILTER (WHERE i % 13 <> 0 AND i % 11 <> 0 AND i % 29 <> 0 AND i % 19 <> 0 AND mine AND kept) AS own_markets
    FROM card c JOIN coupon ON o_custkey = c_custkey GROUP BY 1)
SELECT w.document::BIGINT AS document, """ + ", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ("links", *_ENDS)) + """, coalesce(repeated, 0)::BIGINT AS repeated_market_ids,
    (w.cards - (SELECT count(*) FROM card k WHERE k.document = w.document AND mine AND kept AND c_custkey IN (SELECT card_id::BIGINT FROM chain)))::BIGINT AS orphan_cards,
    coalesce(coupons - own_coupons, 0)::BIGINT AS orphan_coupons, coalesce(markets - own_markets, 0)::BIGINT AS orphan_markets,
    (19 - (SELECT count(DISTINCT e) FROM (SELECT unnest(events) AS e) WHERE e[2:]::INT % 7 <> 0))::BIGINT AS orphan_events,
    coalesce(links > 0 AND repeated + """ + " + ".join(s for s in _ENDS if s.startswith(("missing", "referenced"))) + """ = 0, false) AS checks_passed
FROM whole w LEFT JOIN ended USING (document) LEFT JOIN parts p USING (document)"""

ORACLES["runner_counters"] = """WITH run AS (SELECT l_orderkey AS m, CASE WHEN l_orderkey % 101 = 0 THEN 0 ELSE l_orderkey END || '-' || l_linenumber AS sid, l_linenumber % 2 = 1 AS is_over,
    l_suppkey % 3 + 0.5 AS line, CASE WHEN l_tax > 0.07 THEN 0 WHEN l_discount > 0.05 THEN -105 - l_quantity::INT ELSE 100 + l_quantity::INT END AS odds FROM lineitem),
priced AS (SELECT *, CASE WHEN odds > 0 THEN 1 + odds / 100.0 WHEN odds < 0 THEN 1 + 100.0 / -odds END + CASE WHEN m % 97 = 0 THEN 0.01 ELSE 0 END AS decimal FROM run),
side AS (SELECT m, count(*) AS n, max(CASE WHEN is_over THEN (line, odds, decimal) END) AS o, max(CASE WHEN NOT is_over THEN (line, odds, decimal) END) AS u,
    count(*) FILTER (WHERE odds = 0) AS invalid, count(*) FILTER (WHERE odds <> 0 AND m % 97 = 0) AS apart FROM priced GROUP BY m),
counted AS (SELECT count(*)::BIGINT AS markets, count(*) FILTER (WHERE o IS NULL)::BIGINT AS missing_over, count(*) FILTER (WHERE u IS NULL)::BIGINT AS missing_under,
    count(*) FILTER (WHERE (o IS NULL) <> (u IS NULL))::BIGINT AS one_sided_markets, count(*) FILTER (WHERE n <> 2)::BIGINT AS non_two_selection,
    count(*) FILTER (WHERE NOT coalesce(o[1] = u[1], false))::BIGINT AS mismatched_lines, sum(invalid)::BIGINT AS invalid_odds, sum(apart)::BIGINT AS decimal_american_mismatches FROM side)
SELECT *, (SELECT (count(*) - count(DISTINCT sid))::BIGINT FROM run) AS duplicate_selection_ids, false AS checks_passed FROM counted"""

ORACLES["contract_counters"] = """WITH m AS (SELECT CASE WHEN o_orderkey % 71 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS t, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 104 END AS estimate FROM orders),
b AS (SELECT l_orderkey AS t, bool_or(l_returnflag = 'N') AS bid, bool_or(l_returnflag <> 'N') AS ask FROM lineitem WHERE l_orderkey % 13 <> 0 GROUP BY 1),
j AS (SELECT m.*, b.t IS NOT NULL AS booked, coalesce(bid, false)::INT + coalesce(ask, false)::INT AS sides FROM m LEFT JOIN b USING (t))
SELECT *, duplicate_tickers + missing_orderbooks + invalid_estimates = 0 AS checks_passed FROM (SELECT count(*)::BIGINT AS markets, (count(*) - count(DISTINCT t))::BIGINT AS duplicate_tickers,
    count(DISTINCT t) FILTER (WHERE NOT booked)::BIGINT AS missing_orderbooks, count(*) FILTER (WHERE sides = 2)::BIGINT AS two_sided, count(*) FILTER (WHERE sides = 1)::BIGINT AS one_sided,
    count(*) FILTER (WHERE sides = 0)::BIGINT AS no_quotes, count(*) FILTER (WHERE estimate > 100)::BIGINT AS invalid_estimates FROM j)"""

ORACLES["contract_series"] = """WITH e AS (SELECT value, event_id % 37 = 0 AS lost, CASE (props->>'k')::INT % 3 WHEN 0 THEN 'quantity' WHEN 1 THEN 'line_count' ELSE 'returned_quantity' END AS stat FROM events)
SELECT CASE WHEN NOT lost THEN stat END AS stat, CASE WHEN NOT lost THEN 'units' END AS unit, CASE WHEN lost THEN 'unknown_series' END AS reason, count(*)::BIGINT AS contracts,
    sum(CASE WHEN NOT lost THEN floor(value) + 0.5 END)::DOUBLE AS thresholds FROM e GROUP BY 1, 2, 3"""

ORACLES["page_script_values"] = """SELECT page_id, regexp_extract(html, 'var t="([^"]*)"', 1) AS assigned, regexp_extract(html, 'track[(]([0-9]+)[)]', 1)::BIGINT AS tracked,
    CASE WHEN contains(html, 'window.absent') THEN '' END AS absent FROM pages"""
