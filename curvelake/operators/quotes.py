"""Quote snapshots: flattening, assembly, margin removal, threshold quotes, gates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.functions import numeric as N
from curvelake.functions import odds as O
from curvelake.functions import text as X
from curvelake.operators.checks import Check, all_checks, check_table, grain_check
from curvelake.rules import MeanRules, PricingRules, SourceRules

# Canonical operators, order-free.
OPERATORS = ("gt", "ge", "lt", "le")

NORMALIZED_COLUMNS = (
    "run_id", "source", "source_market_id", "snapshot_utc", "season", "raw_player_name", "team",
    "team_abbreviation", "stat", "unit", "normalization_status", "exclusion_reason", "source_selection_id",
    "operator", "threshold", "outcome_side", "american_odds", "source_decimal_odds", "yes_bid_probability",
    "yes_ask_probability", "last_trade_probability", "volume", "open_interest", "spread", "source_url",
    "raw_record_locator",
)


def names_of(sources: Mapping[str, SourceRules], kind: str) -> list[str]:
    return sorted(name for name, rule in sources.items() if rule.kind == kind)


def explode_markets(snapshot: DataFrame, source: str) -> DataFrame:
    """One row per market of a snapshot document, with its position and document fields."""
    return snapshot.select(
        F.lit(source).alias("source"), F.col("metadata.snapshot_utc").alias("snapshot_utc"),
        F.posexplode("markets").alias("market_index", "market"))


def _base(run_id: str, market_id: Column) -> list[Column]:
    m = F.col("market")
    return [
        F.lit(run_id).alias("run_id"), F.col("source"), market_id.cast("string").alias("source_market_id"),
        F.col("snapshot_utc"), m["season"].alias("season"), m["player"].alias("raw_player_name"),
        m["team"].alias("team"), m["team_abbreviation"].alias("team_abbreviation"), m["stat"].alias("stat"),
        m["threshold_unit"].alias("unit"), F.lit("included").alias("normalization_status"),
        F.lit("").alias("exclusion_reason"),
    ]


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _locator(tail: str = "") -> Column:
    return F.concat(F.lit("$.markets["), F.col("market_index").cast("string"), F.lit("]" + tail))


def normalize_books(markets: DataFrame, run_id: str) -> DataFrame:
    """Two canonical rows (over, under) per two-sided market."""
    m = F.col("market")

    def side(name: str, operator: str) -> Column:
        quoted = m["probability"][name]
        return F.struct(
            quoted["selection_id"].cast("string").alias("source_selection_id"), F.lit(operator).alias("operator"),
            m["market_line"].cast("double").alias("threshold"), F.lit(name).alias("outcome_side"),
            quoted["american_odds"].cast("int").alias("american_odds"),
            quoted["decimal_odds"].cast("double").alias("source_decimal_odds"),
            *[_null("double").alias(c) for c in (
                "yes_bid_probability", "yes_ask_probability", "last_trade_probability", "volume", "open_interest",
                "spread")],
            m["source_urls"]["sportsbook_page"].alias("source_url"),
            _locator(f".probability.{name}").alias("raw_record_locator"))

    return markets.select(*_base(run_id, m["market_id"]), F.inline(F.array(side("over", "gt"), side("under", "lt"))))


def normalize_contracts(markets: DataFrame, run_id: str) -> DataFrame:
    """One canonical ``yes`` row per threshold contract."""
    m = F.col("market")
    p, book, activity = m["probability"], m["orderbook"], m["trading_activity"]
    return markets.select(
        *_base(run_id, m["ticker"]), F.lit("").alias("source_selection_id"), F.lit("ge").alias("operator"),
        m["threshold"].cast("double").alias("threshold"), F.lit("yes").alias("outcome_side"),
        _null("int").alias("american_odds"), _null("double").alias("source_decimal_odds"),
        N.percent_to_probability(p["yes_bid_percent"]).alias("yes_bid_probability"),
        N.percent_to_probability(p["yes_ask_percent"]).alias("yes_ask_probability"),
        N.percent_to_probability(p["last_trade_percent"]).alias("last_trade_probability"),
        activity["volume_contracts"].cast("double").alias("volume"),
        activity["open_interest_contracts"].cast("double").alias("open_interest"),
        book["yes_spread_dollars"].cast("double").alias("spread"), m["source_urls"]["market_api"].alias("source_url"),
        _locator().alias("raw_record_locator"))


def normalize(parts: Iterable[DataFrame]) -> DataFrame:
    """Union of the sources' canonical rows."""
    first, *rest = [part.select(*NORMALIZED_COLUMNS) for part in parts]
    for part in rest:
        first = first.unionByName(part)
    return first


# --- pricing --------------------------------------------------------------------------

def pair_sides(rows: DataFrame) -> DataFrame:
    """One row per two-sided market with both sides as structs, paired in a single shuffle."""
    carried = F.struct("source_selection_id", "american_odds", "source_decimal_odds", "threshold")
    shared = [c for c in rows.columns if c not in (
        "source", "source_market_id", "source_selection_id", "operator", "threshold", "outcome_side",
        "american_odds", "source_decimal_odds", "raw_record_locator", "exclusion_reason")]
    over, under = F.col("outcome_side") == "over", F.col("outcome_side") == "under"
    return rows.groupBy("source", "source_market_id").agg(
        *[F.max(F.when(over, F.col(c))).alias(c) for c in shared],
        F.max(F.when(over, F.col("raw_record_locator"))).alias("raw_record_locator"),
        F.max(F.when(over, carried)).alias("over"), F.max(F.when(under, carried)).alias("under"),
        F.count_if(over).alias("over_rows"), F.count_if(under).alias("under_rows"), F.count("*").alias("side_rows"))


def price_books(rows: DataFrame, pricing: PricingRules) -> DataFrame:
    """Margin-free ``P(X >= k)`` per two-sided market; broken pairs keep a reason and no price."""
    pairs = pair_sides(rows)
    over, under = F.col("over"), F.col("under")
    over_decimal, under_decimal = O.american_to_decimal(over["american_odds"]), O.american_to_decimal(under["american_odds"])
    q_over, q_under = O.implied_probability(over_decimal), O.implied_probability(under_decimal)
    k = O.canonical_threshold(over["threshold"], pricing.reject_ambiguous_integer_lines)
    reason = (F.when((F.col("side_rows") != 2) | (F.col("over_rows") != 1) | (F.col("under_rows") != 1), "unpaired_sides")
              .when(~(over["threshold"].eqNullSafe(under["threshold"])), "mismatched_lines")
              .when(q_over.isNull() | q_under.isNull(), "invalid_odds")
              .when(k.isNull(), "invalid_line").otherwise(""))
    ok = F.col("exclusion_reason") == ""
    priced = pairs.withColumn("exclusion_reason", reason)
    share = O.devig(q_over, q_under)
    return priced.select(
        *[c for c in pairs.columns if c not in ("over", "under", "over_rows", "under_rows", "side_rows")],
        F.lit("gt").alias("operator"), F.lit("over").alias("outcome_side"),
        over["threshold"].alias("threshold"), over["source_selection_id"].alias("source_selection_id"),
        over["american_odds"].alias("american_odds"), over["source_decimal_odds"].alias("source_decimal_odds"),
        F.lit("P(X >= k)").alias("canonical_event"), F.lit("ge").alias("canonical_operator"),
        F.when(ok, k).alias("canonical_threshold"), F.when(ok, over_decimal).alias("decimal_odds"),
        F.when(ok, q_over).alias("raw_implied_probability"),
        F.when(ok, O.overround(q_over, q_under)).alias("market_overround"), F.lit("proportional").alias("devig_method"),
        F.when(ok, share).alias("no_vig_probability"), F.when(ok, share).alias("modeling_probability"),
        under["source_selection_id"].alias("paired_under_selection_id"),
        under["american_odds"].alias("paired_under_american_odds"),
        F.when(ok, under_decimal).alias("paired_under_decimal_odds"),
        F.when(ok, q_under).alias("paired_under_raw_implied_probability"),
        F.when(ok, O.devig(q_under, q_over)).alias("paired_under_no_vig_probability"),
        *[_null("double").alias(c) for c in ("bid_probability", "ask_probability", "midpoint_probability")],
        F.when(ok, "included").otherwise("excluded").alias("inclusion_status"), "exclusion_reason")


def price_contracts(rows: DataFrame, pricing: PricingRules) -> DataFrame:
    """Midpoint ``P(X >= k)`` per threshold contract; excluded rows keep the first reason that applies."""
    bid, ask, k = F.col("yes_bid_probability"), F.col("yes_ask_probability"), F.col("threshold")
    interest = F.col("open_interest")

    def inside(p):
        return F.coalesce(N.is_finite(p) & (p > 0) & (p < 1), F.lit(False))

    reason = (
        F.when(~F.coalesce(N.is_finite(k) & (k >= 0) & (k == F.floor(k)), F.lit(False)),
               F.concat(F.lit("invalid_"), F.col("source"), F.lit("_threshold")))
        .when(~(inside(bid) & inside(ask)), "missing_two_sided_yes_quote")
        .when(bid > ask, "invalid_yes_quote_order")
        .when(ask - bid > pricing.max_spread_probability_points / 100.0, "yes_spread_exceeds_configured_limit")
        .when(interest.isNotNull() & (~N.is_finite(interest) | (interest < pricing.min_open_interest_contracts)),
              "open_interest_below_configured_minimum")
        .otherwise(""))
    ok = F.col("exclusion_reason") == ""
    mid = F.when(ok, (bid + ask) / 2.0)
    return rows.filter("outcome_side = 'yes'").withColumn("exclusion_reason", reason).withColumns({
        "canonical_event": F.lit("P(X >= k)"), "canonical_operator": F.lit("ge"),
        "canonical_threshold": F.when(ok, k.cast("int")), "decimal_odds": 1.0 / mid,
        "raw_implied_probability": mid, "market_overround": _null("double"),
        "devig_method": F.concat(F.lit("not_applicable_"), F.col("source")),
        "no_vig_probability": mid, "modeling_probability": mid,
        "paired_under_selection_id": _null("string"), "paired_under_american_odds": _null("int"),
        "paired_under_decimal_odds": _null("double"), "paired_under_raw_implied_probability": _null("double"),
        "paired_under_no_vig_probability": _null("double"),
        "bid_probability": bid, "ask_probability": ask, "midpoint_probability": mid,
        "inclusion_status": F.when(ok, "included").otherwise("excluded"),
    })


def price_quotes(rows: DataFrame, sources: Mapping[str, SourceRules], pricing: PricingRules) -> DataFrame:
    books = price_books(rows.filter(F.col("source").isin(names_of(sources, "book"))), pricing)
    contracts = price_contracts(rows.filter(F.col("source").isin(names_of(sources, "contract"))), pricing)
    return books.unionByName(contracts, allowMissingColumns=True)


def multiway_devig(runners: DataFrame, market: Sequence[str], probability: str) -> DataFrame:
    """Each runner's share of its market's total, only where every runner is priced."""
    totals = runners.groupBy(*market).agg(
        F.sum(probability).alias("_total"), F.count("*").alias("runners"), F.count(probability).alias("_priced"))
    complete = F.col("runners") == F.col("_priced")
    return runners.join(totals, list(market)).select(
        *runners.columns, "runners", F.when(complete, F.col("_total")).alias("overround"),
        F.when(complete, F.col(probability) / F.col("_total")).alias("no_vig_probability")).drop("_total", "_priced")


def annotate_eligibility(priced: DataFrame, rules: MeanRules) -> DataFrame:
    """Model status and the first exclusion reason of each priced quote."""
    k, p = F.col("canonical_threshold").cast("double"), F.col("modeling_probability")
    reason = (
        F.when(F.col("inclusion_status") != "included",
               F.coalesce(N.clean_text(F.col("exclusion_reason")), F.lit("excluded_by_pricing")))
        .when(~F.coalesce(N.is_finite(k) & (k >= 1) & (k == F.floor(k)), F.lit(False)), "invalid_model_threshold")
        .when(~F.coalesce(N.is_finite(p) & (p > 0) & (p < 1), F.lit(False)), "invalid_model_probability")
        .when(~p.between(rules.probability_floor, rules.probability_ceiling), "probability_outside_model_range")
        .otherwise(""))
    return priced.withColumn("model_exclusion_reason", reason).withColumn(
        "model_inclusion_status", F.when(F.col("model_exclusion_reason") == "", "included").otherwise("excluded"))


# --- assembly and counters ------------------------------------------------------------

def assemble_two_sided(markets: DataFrame, events: DataFrame, selections: DataFrame) -> DataFrame:
    """Market with its event and its two selections, left-joined, with what is missing.

    ``markets``: market_id, event_id. ``events``: event_id plus any fields.
    ``selections``: market_id, outcome, line, american_odds. A market's selections
    are reduced to counts and its Over and Under before the join.
    """
    quoted = F.struct("line", "american_odds")
    over, under = F.col("outcome") == "Over", F.col("outcome") == "Under"
    sides = selections.groupBy("market_id").agg(
        F.count("*").alias("selections"), F.max(F.when(over, quoted)).alias("over"),
        F.max(F.when(under, quoted)).alias("under"))
    joined = markets.join(events.withColumn("event_found", F.lit(True)), "event_id", "left").join(sides, "market_id", "left")
    over, under = F.col("over"), F.col("under")
    same = F.coalesce(over["line"] == under["line"], F.lit(False))
    q_over, q_under = O.american_implied_probability(over["american_odds"]), O.american_implied_probability(under["american_odds"])
    flags = {
        "missing_event": F.col("event_found").isNull(), "missing_over": over.isNull(), "missing_under": under.isNull(),
        "non_two_selection": F.col("selections") != 2, "mismatched_line": ~same,
        "invalid_over_odds": q_over.isNull(), "invalid_under_odds": q_under.isNull(),
    }
    reason = (F.when(F.coalesce(F.col("selections"), F.lit(0)) == 0, "attached_market_has_no_offered_runners")
              .when(F.col("event_found").isNull(), "referenced_event_missing").otherwise(""))
    return joined.withColumn("selections", F.coalesce("selections", F.lit(0))).withColumns({
        "market_line": F.when(same, over["line"]), "raw_over": q_over, "raw_under": q_under,
        "two_way_overround": O.overround(q_over, q_under), "no_vig_over": O.devig(q_over, q_under),
        "no_vig_under": O.devig(q_under, q_over), "unavailable_reason": reason, **flags,
    }).drop("event_found")


def assembly_counters(assembled: DataFrame) -> DataFrame:
    """Snapshot quality counters and the collector's own verdict, one row."""
    flags = ("missing_event", "missing_over", "missing_under", "non_two_selection", "mismatched_line",
             "invalid_over_odds", "invalid_under_odds")
    off = F.abs(F.col("no_vig_over") + F.col("no_vig_under") - 1.0) > 1e-12
    counted = assembled.agg(
        F.count("*").alias("markets"), *[F.count_if(c).alias(f"{c}_count") for c in flags],
        F.count_if(off).alias("no_vig_off_count"))
    clean = F.lit(True)
    for c in (*flags, "no_vig_off"):
        clean = clean & (F.col(f"{c}_count") == 0)
    return counted.withColumn("checks_passed", clean)


def volume_counters(markets: DataFrame, by: str, player: str, volume: str) -> DataFrame:
    """Markets, distinct players and volume per statistic, with a total line."""
    return markets.rollup(by).agg(
        F.count("*").alias("markets"), F.count_distinct(player).alias("players"), F.sum(volume).alias("volume"))


def conflicting_records(records: DataFrame, key: str) -> DataFrame:
    """Ids whose repeated records differ in content.

    Records are compared by two independent 64-bit digests of all their fields, so that no payload leaves its task.
    """
    fields = [F.to_json(F.struct(c)) if records.schema[c].dataType.typeName() == "map" else F.col(c) for c in records.columns if c != key]
    marks = [F.col(c).isNull() for c in records.columns if c != key]  # a missing field hashes like nothing
    first, second = F.xxhash64(*fields, *marks), F.xxhash64(F.lit(1), *marks, *reversed(fields))
    return records.groupBy(key).agg(
        F.count("*").alias("records"), *[x for name, d in (("_a", first), ("_b", second)) for x in (F.min(d).alias(name + "0"), F.max(d).alias(name + "1"))]
    ).filter("_a0 <> _a1 or _b0 <> _b1").select(key, "records")


def probability_fallback(bid: Column, ask: Column, last: Column) -> tuple[Column, Column]:
    """(estimate, method): midpoint, else last trade, else a one-sided reference."""
    traded = F.when(last > 0, last)
    mid = (bid + ask) / 2.0
    method = (F.when(mid.isNotNull(), "midpoint_of_best_yes_bid_and_ask")
              .when(traded.isNotNull(), "last_trade_price_no_two_sided_quote")
              .when(bid.isNotNull(), "one_sided_yes_bid_reference")
              .when(ask.isNotNull(), "one_sided_yes_ask_reference").otherwise("unavailable"))
    return F.coalesce(mid, traded, bid, ask), method


def strike_threshold(floor_strike: Column) -> Column:
    return floor_strike + 0.5


# --- gates ----------------------------------------------------------------------------

def snapshot_gate(snapshot: DataFrame, source: str, rule: SourceRules, season: str, now: Column,
                  stats: Sequence[str], pricing: PricingRules) -> DataFrame:
    """Document-level and per-market checks of one source's snapshot."""
    return snapshot_checks(snapshot.withColumn("source", F.lit(source)), rule.kind, season, now, stats, pricing)


def _failures(condition: Column) -> Column:
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def _book_conditions(m: Column) -> dict[str, Column]:
    def side(name: str) -> Column:
        s = m["probability"][name]
        return ((s["american_odds"] != 0) & (F.coalesce(s["selection_id"], F.lit("")) != "")
                & (X.label_line(s["label"]) == m["market_line"]))

    return {"line": N.is_finite(m["market_line"]),
            "two_sided": m["probability"]["over"].isNotNull() & m["probability"]["under"].isNotNull(),
            "operators": (m["threshold_operators"]["over"] == ">") & (m["threshold_operators"]["under"] == "<"),
            "over": side("over"), "under": side("under")}


def _contract_conditions(m: Column) -> dict[str, Column]:
    book, p = m["orderbook"], m["probability"]
    bid, ask = book["best_yes_bid_dollars"], book["best_yes_ask_dollars"]

    def within(c: Column, top: float) -> Column:
        return c.isNull() | (N.is_finite(c) & c.between(0, top))

    return {"threshold": (m["threshold"] >= 0) & (m["threshold"] == F.floor(m["threshold"])),
            "operator": m["threshold_operator"] == ">=",
            "probability": within(p["yes_bid_percent"], 100) & within(p["yes_ask_percent"], 100) & within(p["yes_midpoint_percent"], 100),
            "book": within(bid, 1) & within(ask, 1) & (bid.isNull() | ask.isNull() | (bid <= ask))}


def first_names(rows: DataFrame, name: str, samples: int = 5) -> DataFrame:
    """The first few names of each source, as one text; a window cut before anything is listed."""
    place = Window.partitionBy("source").orderBy("_name")
    return rows.select("source", F.col(name).alias("_name")).withColumn("_i", F.row_number().over(place)).filter(
        F.col("_i") <= samples).groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("_name")), ", ").alias("sample"))


def snapshot_checks(snapshots: DataFrame, kind: str, season: str, now: Column, stats: Sequence[str], pricing: PricingRules) -> DataFrame:
    """Checks of snapshot documents of any number of sources of one kind (column ``source``).

    Document checks have a row per document, which names its ``file`` if there is such a column; checks of markets count the failures of
    a source's documents. With a column ``_corrupt_record``, unreadable documents are counted and named, and take no part in the others.
    """
    prefix = F.concat(F.lit("collections."), F.col("source"), F.lit("."))
    tables = []
    readable = snapshots
    if "_corrupt_record" in snapshots.columns:
        broken = snapshots.filter(F.col("_corrupt_record").isNotNull())
        counted = snapshots.groupBy("source").agg(F.count("*").alias("documents"), F.count("_corrupt_record").alias("unreadable"))
        tables.append(check_table(counted.join(first_names(broken, "file"), "source", "left"), [Check(
            F.concat(prefix, F.lit("readable")), F.col("unreadable") == 0, "documents are JSON objects",
            details={"documents": F.col("documents"), "unreadable": F.col("unreadable"), "sample": F.coalesce("sample", F.lit(""))})]))
        readable = snapshots.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    file = {"file": F.col("file")} if "file" in snapshots.columns else {}
    age = N.age_hours(now, N.parse_utc(F.col("metadata.snapshot_utc")))
    tables.append(check_table(readable.withColumn("age", age), [
        Check(F.concat(prefix, F.lit("schema")), F.col("metadata").isNotNull() & F.col("data_quality").isNotNull()
              & F.col("markets").isNotNull(), "metadata, data_quality and markets are present", details=file),
        Check(F.concat(prefix, F.lit("season")), F.col("metadata.season") == season, "season equals the configured season", details=file),
        Check(F.concat(prefix, F.lit("freshness")), F.col("age").between(0, pricing.max_snapshot_age_hours),
              "snapshot is parseable and fresh", details=file | {"age_hours": F.round("age", 4)}),
        Check(F.concat(prefix, F.lit("collector_quality")), F.col("data_quality.checks_passed"), "collector checks passed", details=file),
        Check(F.concat(prefix, F.lit("nonempty")), F.size("markets") > 0, "markets are present", details=file)]))
    for column, name in (("unavailable_player_prop_references", "expected_placeholders"),
                         ("other_player_markets", "unrelated_markets_excluded")):
        if column in readable.columns:
            size = F.greatest(F.coalesce(F.size(column), F.lit(0)), F.lit(0))
            tables.append(check_table(readable, [Check(
                F.concat(prefix, F.lit(name)), size == 0, "retained as a warning", "warning", file | {"count": size})]))
    m = F.col("market")
    markets = readable.select("source", F.explode("markets").alias("market"))
    wanted = {"season": m["season"] == season, "stat": m["stat"].isin(*stats)} | (_book_conditions(m) if kind == "book" else _contract_conditions(m))
    counted = readable.select("source").distinct().join(
        markets.groupBy("source").agg(*[_failures(c).alias(name) for name, c in wanted.items()]), "source", "left").na.fill(0)
    tables.append(check_table(counted, [Check(F.concat(prefix, F.lit(f"market.{name}")), F.col(name) == 0, f"market {name} is valid",
                                              details={"markets": F.col(name)}) for name in wanted]))
    ids = markets.select("source", (m["market_id"] if kind == "book" else m["ticker"]).alias("id"))
    repeated = ids.groupBy("source", "id").agg(F.count("*").alias("rows")).filter((F.col("rows") > 1) | (F.coalesce("id", F.lit("")) == ""))
    unique = readable.select("source").distinct().join(repeated.groupBy("source").agg(
        F.count("*").alias("duplicate_keys"), F.sum("rows").alias("duplicate_rows")), "source", "left").join(
            first_names(repeated, "id"), "source", "left").na.fill(0).na.fill("", ["sample"])
    tables.append(check_table(unique, [Check(F.concat(prefix, F.lit("unique_market_ids")), F.col("duplicate_keys") == 0, "market ids are present and unique",
                                             details={c: F.col(c) for c in ("duplicate_keys", "duplicate_rows", "sample")})]))
    return all_checks(*tables)


def snapshot_skew(snapshots: DataFrame, max_minutes: float, expected: int) -> DataFrame:
    """Cross-source skew of ``source, snapshot_utc`` rows."""
    taken = F.unix_micros(N.parse_utc(F.col("snapshot_utc")))
    skew = snapshots.agg(((F.max(taken) - F.min(taken)) / 6e7).alias("skew_minutes"),
                         F.count_if(taken.isNotNull()).alias("parsed"))
    return check_table(skew, [Check(
        "collections.cross_source_snapshot_skew",
        (F.col("parsed") == expected) & (F.col("skew_minutes") <= max_minutes),
        "snapshots are within the configured skew", details={"skew_minutes": F.round("skew_minutes", 4)})])


def normalized_gate(rows: DataFrame, sources: Mapping[str, SourceRules], stats: Sequence[str],
                    expected_rows: Column | None = None) -> DataFrame:
    """Domains, odds, probabilities and key uniqueness of canonical rows."""
    books = F.col("source").isin(names_of(sources, "book"))
    domain = (F.col("source").isin(*sources) & F.col("stat").isin(*stats) & F.col("operator").isin(*OPERATORS)
              & N.is_finite(F.col("threshold")))

    def failures(condition: Column) -> Column:
        return F.count_if(~F.coalesce(condition, F.lit(False)))

    def unit(c):
        return F.col(c).isNull() | (N.is_finite(F.col(c)) & F.col(c).between(0, 1))

    counted = rows.agg(
        F.count("*").alias("rows"), failures(domain).alias("domain"),
        failures(~books | (F.col("american_odds") != 0)).alias("odds"),
        failures(books | (unit("yes_bid_probability") & unit("yes_ask_probability") & unit("last_trade_probability")))
        .alias("probabilities"))
    expected = F.col("rows") if expected_rows is None else expected_rows
    return all_checks(
        check_table(counted, [
            Check("normalized.nonempty", F.col("rows") > 0, "rows are present"),
            Check("normalized.types_and_domains", F.col("domain") == 0, "values are canonical",
                  details={"rows": F.col("domain")}),
            Check("normalized.book_odds", F.col("odds") == 0, "two-sided rows keep valid odds"),
            Check("normalized.contract_probabilities", F.col("probabilities") == 0, "probabilities lie in [0, 1]"),
            Check("normalized.row_count", F.col("rows") == expected, "every outcome is represented",
                  details={"rows": F.col("rows")})]),
        grain_check(rows, ["source", "source_market_id", "outcome_side"], "normalized.keys_unique", "keys are unique"))


def pricing_gate(priced: DataFrame, sources: Mapping[str, SourceRules], pricing: PricingRules) -> DataFrame:
    """Arithmetic and auditability of priced quotes, in one pass."""
    tol = pricing.probability_tolerance
    included = F.col("inclusion_status") == "included"
    book = F.col("source").isin(names_of(sources, "book"))
    p = F.col("modeling_probability")

    def failures(scope: Column, condition: Column) -> Column:
        return F.count_if(scope & ~F.coalesce(condition, F.lit(False)))

    counted = priced.agg(
        F.count("*").alias("rows"), F.count_if(included).alias("included_rows"),
        failures(included, (F.col("canonical_event") == "P(X >= k)") & (F.col("canonical_operator") == "ge")
                 & (F.col("canonical_threshold") >= 0) & N.is_finite(p) & (p > 0) & (p < 1)).alias("canonical"),
        failures(~included, (F.col("exclusion_reason") != "") & p.isNull()).alias("auditable"),
        failures(included & book, (F.abs(F.col("no_vig_probability") + F.col("paired_under_no_vig_probability") - 1) <= tol)
                 & (F.abs(p - F.col("no_vig_probability")) <= tol) & (F.col("market_overround") > 1)).alias("pairs"),
        failures(~book, F.col("market_overround").isNull() & p.eqNullSafe(F.col("midpoint_probability"))).alias("devigged"),
        failures(included & ~book, F.col("bid_probability") <= F.col("ask_probability")).alias("quotes"),
        failures(book & F.col("source_decimal_odds").isNotNull(),
                 F.abs(F.col("source_decimal_odds") - F.col("decimal_odds")) <= tol).alias("decimals"))

    def zero(name, column, message, severity="error"):
        return Check(f"pricing.{name}", F.col(column) == 0, message, severity, {"rows": F.col(column)})

    return check_table(counted, [
        Check("pricing.nonempty", F.col("rows") > 0, "priced quotes are present"),
        zero("included_canonical_probability", "canonical", "included rows have a threshold and probability"),
        zero("exclusions_are_auditable", "auditable", "excluded rows state a reason and carry no probability"),
        zero("book_pairs_reconcile", "pairs", "no-vig pairs sum to one"),
        zero("contracts_not_devigged", "devigged", "contract probabilities stay midpoints"),
        zero("contract_quote_fields", "quotes", "included contracts keep ordered quotes"),
        zero("source_decimal_crosscheck", "decimals", "collector decimals agree", "warning")])
