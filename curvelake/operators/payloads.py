"""Snapshot payloads whose parts refer to each other by id: links followed through keyed maps, and quality counters.

A payload is one document with maps of its cards, coupons, markets, events and competitions. Every link is a look-up in a map of
the same row, so following them needs no join and no shuffle, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvelake.functions import odds as O

#: The parts of a payload. Tabs name their cards, cards their coupons, coupons a market, markets an event and a competition.
PAYLOAD = """
    tabs map<string, struct<title: string, cards: array<struct<id: string>>>>,
    cards map<string, struct<title: string, hasAttachments: boolean, coupons: array<struct<id: string>>>>,
    coupons map<string, struct<marketId: string, hasAttachments: boolean>>,
    markets map<string, struct<marketName: string, eventId: string, competitionId: string, runners: int>>,
    events map<string, struct<name: string>>,
    competitions map<string, struct<name: string>>
"""
#: What can become of a link, in the order in which it is followed.
LINKS = ("linked", "missing_card", "missing_coupon", "coupon_placeholder_has_no_attached_market", "referenced_market_missing_from_attachments",
         "referenced_event_missing", "referenced_competition_missing", "attached_market_has_no_offered_runners")


def _at(parts: str, key: Column) -> Column:
    return F.try_element_at(F.col(parts), key)


def link_chain(payloads: DataFrame, document: str, tab: str) -> DataFrame:
    """One row per link of the tab of that title, followed as far as it leads, with what became of it.

    Columns ``document``, the ids and names along the chain, ``status``. A document without the tab gives no rows.
    """
    tabs = payloads.withColumn("_tab", F.get(F.filter(F.map_values("tabs"), lambda t: t["title"] == tab), 0))
    # A card without coupons and a coupon without a market are rows too.
    cards = tabs.select("*", F.explode("_tab.cards").alias("_card_ref")).withColumns({
        "card_id": F.col("_card_ref.id"), "_card": _at("cards", F.col("_card_ref.id"))})
    coupons = cards.select("*", F.explode_outer("_card.coupons").alias("_coupon_ref")).withColumns({
        "coupon_id": F.col("_coupon_ref.id"), "_coupon": _at("coupons", F.col("_coupon_ref.id"))})
    named = coupons.filter(F.col("_card").isNull() | F.col("_coupon_ref").isNotNull())
    market_id = F.coalesce(F.col("_coupon.marketId"), F.lit(""))
    followed = named.withColumn("market_id", F.when(market_id != "", market_id)).withColumn("_market", _at("markets", F.col("market_id"))).withColumns({
        "event_id": F.col("_market.eventId"), "competition_id": F.col("_market.competitionId"),
        "_event": _at("events", F.col("_market.eventId")), "_competition": _at("competitions", F.col("_market.competitionId"))})
    placeholder = F.col("market_id").isNull() & ~F.coalesce(F.col("_coupon.hasAttachments"), F.lit(False))
    status = (F.when(F.col("_card").isNull(), "missing_card").when(F.col("_coupon").isNull(), "missing_coupon")
              .when(placeholder, "coupon_placeholder_has_no_attached_market").when(F.col("_market").isNull(), "referenced_market_missing_from_attachments")
              .when(F.col("_event").isNull(), "referenced_event_missing").when(F.col("_competition").isNull(), "referenced_competition_missing")
              .when(F.coalesce(F.col("_market.runners"), F.lit(0)) == 0, "attached_market_has_no_offered_runners").otherwise("linked"))
    return followed.select(
        document, "card_id", F.col("_card.title").alias("card_title"), "coupon_id", "market_id", F.col("_market.marketName").alias("market_name"), "event_id",
        F.col("_event.name").alias("event_name"), "competition_id", F.col("_competition.name").alias("competition_name"), status.alias("status"))


def link_counters(payloads: DataFrame, document: str, tab: str) -> DataFrame:
    """Per document: links, how many ended where, repeated market ids, orphans (parts that no link of the tab reaches), and the verdict.

    Placeholders and markets without runners are expected; everything else that is not linked fails the document.
    """
    chain = link_chain(payloads, document, tab)
    ended = chain.groupBy(document).agg(
        F.count("*").alias("links"), *[F.count_if(F.col("status") == s).alias(s) for s in LINKS],
        *[F.array_distinct(F.collect_list(F.col(c))).alias(f"_{p}") for c, p in (("card_id", "cards"), ("coupon_id", "coupons"), ("market_id", "markets"), ("event_id", "events"))],
        F.count("market_id").alias("_named"))
    joined = payloads.select(document, *[F.map_keys(p).alias(p) for p in ("cards", "coupons", "markets", "events")]).join(ended, document, "left")
    orphans = [F.size(F.array_except(p, F.coalesce(f"_{p}", F.array().cast("array<string>")))).alias(f"orphan_{p}") for p in ("cards", "coupons", "markets", "events")]
    counted = joined.select(document, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("links", *LINKS)],
                            (F.coalesce("_named", F.lit(0)) - F.coalesce(F.size(F.col("_markets")), F.lit(0))).alias("repeated_market_ids"), *orphans)
    fatal = [s for s in LINKS if s not in ("linked", "coupon_placeholder_has_no_attached_market", "attached_market_has_no_offered_runners")]
    clean = F.col("repeated_market_ids") == 0
    for name in fatal:
        clean = clean & (F.col(name) == 0)
    return counted.withColumn("checks_passed", clean & (F.col("links") > 0))


def runner_counters(runners: DataFrame) -> DataFrame:
    """Counters of two-sided markets from their runners, one row.

    ``runners``: ``market_id, selection_id, outcome, line, american_odds, decimal_odds``. A market's runners are reduced to counts and
    its two sides first; the rest is one aggregation.
    """
    quoted = F.struct("line", "american_odds", "decimal_odds")
    over, under = F.col("outcome") == "Over", F.col("outcome") == "Under"
    raw = O.american_implied_probability(F.col("american_odds"))
    # American and decimal odds of a runner must imply the same probability.
    apart = raw.isNotNull() & (F.col("decimal_odds") > 0) & (F.abs(raw - 1.0 / F.col("decimal_odds")) > 1e-9)
    repeated = runners.groupBy("selection_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_selection_ids"))
    markets = runners.groupBy("market_id").agg(
        F.count("*").alias("runners"), F.max(F.when(over, quoted)).alias("over"), F.max(F.when(under, quoted)).alias("under"),
        F.count_if(apart).alias("apart"), F.count_if(raw.isNull()).alias("invalid"))
    over, under = F.col("over"), F.col("under")
    counted = markets.agg(
        F.count("*").alias("markets"), F.count_if(over.isNull()).alias("missing_over"), F.count_if(under.isNull()).alias("missing_under"),
        F.count_if(over.isNull() != under.isNull()).alias("one_sided_markets"), F.count_if(F.col("runners") != 2).alias("non_two_selection"),
        F.count_if(~F.coalesce(over["line"] == under["line"], F.lit(False))).alias("mismatched_lines"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_odds"), F.coalesce(F.sum("apart"), F.lit(0)).alias("decimal_american_mismatches")).crossJoin(F.broadcast(repeated))
    faults = ("missing_over", "missing_under", "non_two_selection", "mismatched_lines", "invalid_odds", "decimal_american_mismatches", "duplicate_selection_ids")
    return counted.withColumn("checks_passed", sum((F.col(c) for c in faults), F.lit(0)) == 0)


def contract_counters(markets: DataFrame, books: DataFrame) -> DataFrame:
    """Counters of threshold contracts and their order books, one row.

    ``markets``: ``ticker, estimate`` (a percentage). ``books``: ``ticker, bid, ask``, one row per ticker at most.
    """
    met = markets.join(books.select("ticker", "bid", "ask", F.lit(True).alias("_book")), "ticker", "left")
    sides = F.col("bid").isNotNull().cast("int") + F.col("ask").isNotNull().cast("int")
    tickers = met.groupBy("ticker").agg(
        F.count("*").alias("rows"), F.count("_book").alias("booked"), *[F.count_if(sides == n).alias(f"sides_{n}") for n in range(3)],
        F.count_if(F.col("estimate").isNotNull() & ~F.col("estimate").between(0, 100)).alias("impossible"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counted = tickers.agg(
        total("rows").alias("markets"), total(F.col("rows") - 1).alias("duplicate_tickers"), F.count_if(F.col("booked") == 0).alias("missing_orderbooks"),
        total("sides_2").alias("two_sided"), total("sides_1").alias("one_sided"), total("sides_0").alias("no_quotes"), total("impossible").alias("invalid_estimates"))
    return counted.withColumn("checks_passed", F.col("duplicate_tickers") + F.col("missing_orderbooks") + F.col("invalid_estimates") == 0)


def infer_series(contracts: DataFrame, series: Mapping[str, tuple[str, str]], ticker: str = "series_ticker") -> tuple[DataFrame, DataFrame]:
    """(contracts with ``stat`` and ``unit`` of their series, contracts of unknown series with a reason).

    The table has as many rows as the rules, and is broadcast.
    """
    table = contracts.sparkSession.createDataFrame([(t, *v) for t, v in series.items()], f"{ticker} string, stat string, unit string")
    met = contracts.join(F.broadcast(table), ticker, "left")
    return met.filter(F.col("stat").isNotNull()), met.filter(F.col("stat").isNull()).select(*contracts.columns, F.lit("unknown_series").alias("reason"))
