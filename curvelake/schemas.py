"""Explicit schemas of the snapshot files."""

from __future__ import annotations

_SIDE = ("struct<selection_id: string, label: string, outcome_type: string, "
         "american_odds: int, decimal_odds: double>")

# One snapshot document of a two-sided book.
BOOK_SNAPSHOT = f"""
    metadata struct<season: string, snapshot_utc: string>,
    data_quality struct<checks_passed: boolean>,
    markets array<struct<
        market_id: string, event_id: string, player: string, team: string, team_abbreviation: string,
        season: string, stat: string, market_line: double, threshold_unit: string,
        threshold_operators: struct<over: string, under: string>,
        probability: struct<over: {_SIDE}, under: {_SIDE}>,
        source_urls: struct<sportsbook_page: string>>>,
    other_player_markets array<struct<market_id: string>>,
    unavailable_player_prop_references array<struct<reason: string>>,
    _corrupt_record string
"""

# One snapshot document of a threshold-contract exchange.
CONTRACT_SNAPSHOT = """
    metadata struct<season: string, snapshot_utc: string>,
    data_quality struct<checks_passed: boolean>,
    markets array<struct<
        ticker: string, event_ticker: string, player: string, team: string, team_abbreviation: string,
        season: string, stat: string, threshold_operator: string, threshold: double,
        threshold_unit: string, status: string,
        probability: struct<yes_bid_percent: double, yes_ask_percent: double,
                            yes_midpoint_percent: double, last_trade_percent: double>,
        trading_activity: struct<volume_contracts: double, volume_24h_contracts: double,
                                 open_interest_contracts: double>,
        orderbook: struct<best_yes_bid_dollars: double, best_yes_ask_dollars: double,
                          yes_spread_dollars: double, best_yes_bid_size_contracts: double,
                          best_yes_ask_size_contracts: double>,
        source_urls: struct<market_api: string>>>,
    _corrupt_record string
"""
