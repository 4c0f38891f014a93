"""Golden and negative cases of the table operators."""

import json

import pytest
from pyspark.sql import functions as F

from curvelake.functions import odds as O
from curvelake.functions import text as X
from curvelake.operators import books, checks, consensus, history, names, quotes, score
from curvelake.rules import SOURCES, AggregationRules, HistoryRules, NameRules, PricingRules, ScoringRules, SourceRules
from curvelake.sources import readers, writers


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).collect()[0]


def test_odds_and_line(spark):
    row = one(spark, long=O.american_to_decimal(F.lit(340)), short=O.american_to_decimal(F.lit(-625)), even=O.american_to_decimal(F.lit("EVEN")), zero=O.american_to_decimal(F.lit(0)),
              k=O.canonical_threshold(F.lit(17.5)), low=O.canonical_threshold(F.lit(0.5)), whole=O.canonical_threshold(F.lit(64.0)), back=O.decimal_to_american(F.lit(5.2)))
    assert (row.long, row.short, row.even, row.zero) == (pytest.approx(4.4), pytest.approx(1.16), 2.0, None)
    assert (row.k, row.low, row.whole) == (18, 1, None) and row.back == pytest.approx(420.0)


@pytest.mark.parametrize("name, key", [
    ("Q. L’Écuyer", "q lecuyer"), ("K'Lani-Ortega Sr.", "klani ortega"), ("Søren Håkansson III", None),
    ("Bay-Lee Mc. Trout V", "bay lee mc trout"), ("ﬂo Weiß Ⅲ", "flo weiss"), ("sr", "")])
def test_match_key(spark, name, key):
    got = one(spark, k=X.match_key(F.lit(name))).k
    assert got == key if key is not None else got.endswith("hakansson")


QUOTE = "source string, raw_player_name string, stat string, team string, team_abbreviation string"
HIST = "gsis_player_id string, player_name string, position string, team string, stat string"
ALIAS = "source string, raw_player_name string, canonical_player_id string, canonical_player_name string, notes string"


def resolve(spark, quoted, known, aliases=()):
    quoted = [(s, n, "passing_yards", "EXM", None) for s, n in quoted]
    known = [(i, n, "QB", "EXM", "passing_yards") for i, n in known]
    rows = names.reconcile(spark.createDataFrame(quoted, QUOTE), spark.createDataFrame(known, HIST),
                           spark.createDataFrame(list(aliases), ALIAS), SOURCES, NameRules()).collect()
    return {(row.source, row.raw_player_name): row for row in rows}


def test_names_initials_ambiguity_collision_and_fuzzy(spark):
    rows = resolve(spark, [("draftkings", "M. D’Arbanville"), ("fanduel", "T. Okafor"), ("kalshi", "Lena Vastberg"), ("kalshi", "Quite Unheard Of"),
                           ("draftkings", "Theodor Brennecker")],
                   [("21", "Marcus DArbanville"), ("22", "Tunde Okafor"), ("23", "Temi Okafor"), ("24", "Lena Vastberg"), ("25", "Theodore Brenneckar")])
    assert rows["draftkings", "M. D’Arbanville"].canonical_player_id == "gsis:21"
    assert rows["fanduel", "T. Okafor"].reason == "ambiguous_fuzzy_match" and rows["fanduel", "T. Okafor"].review_status == "unmatched"
    assert rows["kalshi", "Lena Vastberg"].match_method == "exact_match_key"
    lost = rows["kalshi", "Quite Unheard Of"]
    assert lost.canonical_player_id.startswith("player:quite-unheard-of-") and lost.reason == "below_review_floor"
    close = rows["draftkings", "Theodor Brennecker"]
    assert (close.reason, close.candidate_canonical_player_id) == ("score_below_minimum", "gsis:25")
    clash = resolve(spark, [("draftkings", "T Okafor"), ("draftkings", "Tunde Okafor")], [("22", "Tunde Okafor")])
    assert clash["draftkings", "T Okafor"].canonical_player_id == "gsis:22"
    assert clash["draftkings", "Tunde Okafor"].reason == "source_level_collision"


def test_quotes_keep_their_row_whatever_blanks_surround_the_name(spark):
    quoted = spark.createDataFrame([("draftkings", "  Lena Vastberg ", "passing_yards", "EXM", None), ("draftkings", "Lena Vastberg", "passing_yards", "EXM", None),
                                    (" draftkings", "Lena Vastberg\t", "passing_yards", None, None), ("draftkings", None, "passing_yards", None, None)], QUOTE)
    known = spark.createDataFrame([("24", "Lena Vastberg", "QB", "EXM", "passing_yards")], HIST)
    resolved = names.reconcile(quoted, known, spark.createDataFrame([], ALIAS), SOURCES, NameRules())
    out = names.decorate(quoted, names.player_map(resolved)).collect()
    assert sorted(str(r.raw_player_name) for r in out) == sorted(str(r.raw_player_name) for r in quoted.collect())
    assert [r.canonical_player_id for r in out if r.raw_player_name and "\t" not in r.raw_player_name] == ["gsis:24"] * 2


def test_aliases_override_and_reach_later_sources(spark):
    alias = [("draftkings", n, "gsis:31", "Ingrid Halloran", "") for n in ("I Halloran", "Ingrid Halloran")] + [("draftkings", "Fresh Face", "listed:77", "Fresh Face", "")]
    rows = resolve(spark, [("draftkings", "I Halloran"), ("draftkings", "Ingrid Halloran"), ("draftkings", "Fresh Face"), ("fanduel", "Fresh Face"), ("kalshi", "Fresh Facer")],
                   [("32", "Isolde Halloran")], alias)
    assert {rows["draftkings", n].canonical_player_id for n in ("I Halloran", "Ingrid Halloran")} == {"gsis:31"}
    assert rows["fanduel", "Fresh Face"].canonical_player_id == "listed:77" and rows["fanduel", "Fresh Face"].review_status == "automatic"
    assert rows["kalshi", "Fresh Facer"].candidate_canonical_player_id == "listed:77"
    bad = spark.createDataFrame([("*", "Kim Vo", "1", "Kim", ""), ("*", "kim vo", "2", "Vo", "")], ALIAS)
    with pytest.raises(checks.GateError):
        checks.require(names.alias_gate(bad, sorted(SOURCES)))


def test_similarity_blocking_is_complete(spark):
    words = ["mara quill", "maro quill", "marra quil", "mira quille", "quill mara", "ma qui", "maraa quill", "bartholomew finch", "bartolomew finch", "aaaa aaaa", "aaaaa aaa", "x", "xy"]
    frame = spark.createDataFrame([(w,) for w in words], "match_key string")
    got = {(r.query_key, r.match_key) for r in names.similar_keys(frame.withColumnRenamed("match_key", "query_key"), frame, 80.0).collect()}

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]
    assert got == {(a, b) for a in words for b in words if 200 * lcs(a, b) / (len(a) + len(b)) >= 80}


def test_names_meet_in_parts_and_not_in_the_driver(spark):
    history_rows = spark.createDataFrame([(str(i), f"Player Number{i}", "QB", "T", "yards") for i in range(30)], "gsis_player_id string, player_name string, position string, team string, stat string")
    quoted = spark.createDataFrame([("book", f"Player Numbe{i}", "yards", "T", None) for i in range(30)], "source string, raw_player_name string, stat string, team string, team_abbreviation string")
    pool = names.pool_from_history(history_rows)
    pairs = names.similar_keys(pool.select(F.col("match_key").alias("query_key")).distinct(), pool.select("match_key").distinct(), 90.0)
    identities = names.market_identities(quoted, ["book"])
    mapped = quoted.select("source", "raw_player_name", *[F.lit("x").alias(c) for c in (
        "canonical_player_id", "canonical_player_name", "canonical_position", "canonical_gsis_player_id", "match_method", "match_score", "review_status")])
    for table in (pool, pairs, names.exact_matches(identities, names.id_range(pool)), names.decorate(quoted, mapped)):
        table.collect()
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_equal_quotes_are_dropped_before_their_sets_are_made(spark):
    quoted = spark.createDataFrame([("book", n, s, t, None) for n in ("Ann Lee", " Ann Lee", "Bo") for s in ("yards", None) for t in ("A", None)] * 3, QUOTE)
    table = names.market_identities(quoted, ["book"])
    assert [tuple(r) for r in table.orderBy("raw_player_name").collect()] == [("book", "Ann Lee", ["yards"], ["A"], "ann lee"), ("book", "Bo", ["yards"], ["A"], "bo")]
    # Two groupings: by all columns (hashed, however many kinds there are), then by name.
    assert table._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2


def test_later_sources_do_not_go_through_the_pool_again(spark, monkeypatch):
    sizes, plain = [], names.id_range
    monkeypatch.setattr(names, "id_range", lambda pool: (sizes.append(pool.distinct().count()), plain(pool))[1])
    known = [(str(i), f"Player Number{i}", "QB", "T", "yards") for i in range(30)]
    # The alias gives gsis:1 a second key, with its old team, and a new team, with its old key.
    known += [("1", "Lena Vastberg", "QB", "OLD", "yards"), ("8", "Lena Vastberg", "QB", "T", "yards"), ("9", "Nick Name", "QB", "T", "yards")]
    quoted = [("draftkings", "Nick Name", "yards", "NEW", None), ("fanduel", "Nick Namee", "yards", "OLD", None), ("fanduel", "Lena Vastbergg", "yards", "NEW", None),
              ("kalshi", "Nick Namee", "yards", "ELSE", None), ("kalshi", "Lena Vastbergg", "yards", "OLD", None), ("kalshi", "Player Number7", "yards", None, None)]
    alias = [("draftkings", "Nick Name", "gsis:1", "Lena Vastberg", "")]
    rows = names.reconcile(spark.createDataFrame(quoted, QUOTE), spark.createDataFrame(known, HIST), spark.createDataFrame(alias, ALIAS), SOURCES, NameRules()).collect()
    best = {(r.source, r.raw_player_name): r.candidate_canonical_player_id or r.canonical_player_id for r in rows}
    assert best == {("draftkings", "Nick Name"): "gsis:1", ("fanduel", "Nick Namee"): "gsis:1", ("fanduel", "Lena Vastbergg"): "gsis:1", ("kalshi", "Nick Namee"): "gsis:9",
                    ("kalshi", "Lena Vastbergg"): "gsis:1", ("kalshi", "Player Number7"): "gsis:7"}
    assert sizes[0] >= 33 and max(sizes[1:]) < 10


@pytest.mark.parametrize("floor", [80.0, 87.0, 90.0, 100.0])
def test_names_of_even_letters_meet_by_segments(spark, monkeypatch, floor):
    import random
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    known = sorted({word(8) + " " + word(rng.choice([3, 8, 8, 15])) for _ in range(400)} | {word(n) for n in (1, 2, 5, 6)})
    asked = set()
    for key in known:
        for edits in range(6):
            letters = list(key)
            for _ in range(edits):
                at = rng.randrange(len(letters) + 1)
                if rng.random() < 0.5 and at < len(letters) and len(letters) > 1:
                    del letters[at]
                else:
                    letters.insert(at, rng.choice("0123456789abcdef "))
            asked.add("".join(letters))
    met = []
    count = names._meetings
    monkeypatch.setattr(names, "_meetings", lambda *a: met.append(count(*a)) or met[-1])
    got = names.similar_keys(spark.createDataFrame([(q,) for q in asked], "query_key string"), spark.createDataFrame([(k,) for k in known], "match_key string"), floor)
    found = {(r.query_key, r.match_key) for r in got.collect() if r.score < 100 or r.query_key == r.match_key}

    def likeness(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(row[j], last[j + 1]))
        return 200 * row[-1] / (len(a) + len(b))

    sample = rng.sample(sorted(asked), 120)
    for q in sample:
        for k in known:
            close = abs(len(q) - len(k)) <= (1 - floor / 100) * (len(q) + len(k)) + 1e-9 and likeness(q, k) >= floor - 1e-9
            assert ((q, k) in found) == close, (q, k)
    if floor >= 87:
        assert met[0] * 20 < met[1]  # segments, far fewer than by pieces


def test_books_are_dealt_into_tasks_of_bounded_size(spark, monkeypatch):
    from decimal import Decimal
    monkeypatch.setattr(books, "ORDERS_PER_TASK", 100)
    rows = [(i % 250 if i else None, "yes" if i % 3 else "no", Decimal(30 + i % 41) / 100, Decimal(1 + i % 7)) for i in range(2000)]
    levels = spark.createDataFrame(rows, "market_id long, side string, price decimal(18,4), quantity decimal(18,4)")
    combined = books.combine_levels(levels)
    depth, fills = books.band_depth(combined), books.execution_quotes(combined)
    for table in (combined, depth, fills):
        assert table.rdd.getNumPartitions() == 20
        plan = table._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange") == 1
    got = {(r.market_id, r.book_side): r for r in depth.collect()}
    for market in range(250):
        for side, here in (("yes", "bid"), ("no", "ask")):
            mine = [(p if side == "yes" else 1 - p, q) for m, s, p, q in rows if m == market and s == side]
            if not mine:
                assert (market, here) not in got
                continue
            best = max(p for p, _ in mine) if side == "yes" else min(p for p, _ in mine)
            for cents in books.DEPTH_BANDS:
                near = [(p, q) for p, q in mine if abs(p - best) <= Decimal(cents) / 100]
                assert got[market, here][f"within_{cents}c_contracts"] == sum(q for _, q in near)
                assert got[market, here][f"within_{cents}c_notional"] == sum(p * q for p, q in near)
    assert (None, "ask") not in got


def test_execution_quotes_against_a_plain_walk(spark):
    raw = [(1, "no", "0.60", "5"), (1, "no", "0.55", "20"), (1, "yes", "0.35", "3"), (1, "yes", "0.30", "500"), (1, "yes", "0.35", "4")]
    levels = spark.createDataFrame(raw, "market_id long, side string, price string, quantity string").select(
        "market_id", "side", F.col("price").cast("decimal(18,4)").alias("price"), F.col("quantity").cast("decimal(18,4)").alias("quantity"))
    combined = books.combine_levels(levels)
    got = {(r.action, r.requested_contracts): r for r in books.execution_quotes(combined).collect()}
    assert got["buy_yes", 10].vwap_dollars == pytest.approx((5 * 0.40 + 5 * 0.45) / 10) and float(got["buy_yes", 10].worst_price_dollars) == 0.45
    assert float(got["buy_yes", 100].fillable_contracts) == 25 and not got["buy_yes", 100].fully_fillable
    assert got["sell_yes", 10].vwap_dollars == pytest.approx((7 * 0.35 + 3 * 0.30) / 10)
    summary = books.book_summary(combined).collect()[0]
    assert (float(summary.best_yes_bid_dollars), float(summary.best_yes_ask_dollars), summary.yes_level_count) == (0.35, 0.40, 3)


CONSENSUS = "run_id string, season string, canonical_player_id string, canonical_player_name string, stat string, source string, mean double, sensitivity_low double, sensitivity_high double, quality_status string"


def blend(spark, rows, sources, rules):
    frame = spark.createDataFrame([("run", "2026-27", "p1", "Player", "receiving_yards", s, m, m - 10, m + 10, q) for s, m, q in rows], CONSENSUS)
    return consensus.consensus(frame, sources, rules).collect()[0]


def test_consensus_golden(spark):
    book = {n: SourceRules("book", True, 1.0) for n in SOURCES}
    rules = AggregationRules(max_absolute_disagreement=250.0, max_relative_disagreement=0.25)
    row = blend(spark, [("draftkings", 612.0, "passed"), ("fanduel", 655.0, "passed"), ("kalshi", 743.0, "passed")], book, rules)
    assert row.consensus_mean == pytest.approx(670) and row.source_range == 131 and not row.disagreement_flag
    weighted = {"draftkings": SourceRules("book", True, 2.0), "fanduel": SourceRules("book", True, 5.0), "kalshi": SourceRules("contract", False, 9.0)}
    row = blend(spark, [("draftkings", 305.0, "passed"), ("fanduel", 410.0, "passed"), ("kalshi", 77.0, "passed")], weighted, AggregationRules(max_absolute_disagreement=40.0))
    assert row.consensus_mean == pytest.approx(380) and row.disagreement_flag
    row = blend(spark, [("draftkings", 512.0, "passed")], book, AggregationRules(minimum_sources=2))
    assert row.consensus_mean is None and row.exclusion_reason == "minimum_sources_not_met"


def test_scoring_golden_and_invalid_rules(spark):
    rows = [("run", "s", "p1", "QB", stat, v, "passed") for stat, v in (("passing_yards", 3150.0), ("passing_touchdowns", 21.0), ("receptions", 6.0))]
    rows += [("run", "s", "p2", "WR", "receiving_yards", 640.0, "passed"), ("run", "s", "p2", "WR", "receiving_touchdowns", 4.5, "passed")]
    frame = spark.createDataFrame(rows, "run_id string, season string, canonical_player_id string, canonical_player_name string, stat string, consensus_mean double, quality_status string")
    scored = score.score(frame, ScoringRules())
    got = {r.canonical_player_id: r for r in scored.collect()}
    assert [got["p1"][f"fpts_{m}"] for m in ("standard", "half_ppr", "three_quarter_ppr", "full_ppr")] == pytest.approx([210, 213, 214.5, 216])
    assert got["p2"].fpts_standard is None and got["p2"].partial_fpts_standard == pytest.approx(91) and not got["p2"].projection_complete
    checks.require(score.scoring_gate(frame, scored, ScoringRules()))
    with pytest.raises(ValueError):
        score.score(frame, ScoringRules(missing_stat_policy="zero"))


WEEK = "season,season_type,week,player_id,player_name,position,recent_team,attempts,carries,targets,passing_yards,passing_tds,rushing_yards,rushing_tds,receiving_yards,receiving_tds,receptions"


def weekly_file(tmp_path, rows):
    path = tmp_path / "weekly.csv"
    path.write_text("\n".join([WEEK, *rows]) + "\n")
    return str(path)


def test_weekly_file_to_season_totals(spark, tmp_path):
    path = weekly_file(tmp_path, [
        "2021,REG,4,z9,Mo Ferrant,RB,KLM,0,11,4,0,0,61,1,18,0,2", "2021,REG,5,z9,Mo Ferrant,RB,NOP,0,14,2,0,0,43,0,9,0,1",
        "2021,REG,5,z9,,RB,NOP,1,3,,7,0,8,1,0,0,0", "2021,REG,6,z9,Mo Ferrant,RB,NOP,0,9,5,0,0,-3,0,27,1,4", "2021,POST,19,z9,Mo Ferrant,RB,NOP,5,5,5,5,5,5,5,5,5,5",
        "2020,REG,4,z9,Mo Ferrant,RB,KLM,6,6,6,6,6,6,6,6,6,6"])
    rules = HistoryRules(ingest_start_season=2021, latest_completed_season=2021)
    raw = readers.read_weekly(spark, path)
    weekly = history.canonical_weekly(raw, rules)
    merged = history.merge_weeks(weekly, rules)
    totals = history.season_totals(merged, rules)
    row = totals.collect()[0]
    assert (row.rushing_yards, row.receiving_yards, row.passing_yards, row.games, row.team, row.targets, row.source_week_rows) == (109, 54, 7, 3, "KLM|NOP", 11, 3)
    long = {r.stat: r for r in history.long_totals(totals, rules).collect()}
    assert long["rushing_yards"].stat_total_per_17 == pytest.approx(109) and long["receptions"].stat_per_game == pytest.approx(7 / 3) and len(long) == 7
    assert history.unreconciled_weeks(weekly, totals, rules).count() == 0
    out = str(tmp_path / "out")
    writers.write_csv(totals.select("season", "gsis_player_id", "rushing_yards"), out)
    assert readers.read_typed_csv(spark, out, "season int, gsis_player_id string, rushing_yards double").collect()[0].rushing_yards == 109.0
    with pytest.raises(Exception):
        writers.write_csv(totals.select("season"), out)


def test_future_seasons_do_not_change_a_baseline(spark):
    rules = HistoryRules(stats=("receptions",), opportunity_by_stat={"receptions": "targets"}, minimum_opportunity={"targets": 1.0},
                         signed_stats=frozenset(), calibration_start_season=2012, latest_completed_season=2015)

    def baseline(last):
        rows = [(s, p, p, "T", "WR" if s < 2015 else "TE", 16, 16, 16, 50.0, float(40 + s - 2009 + (last if s == 2015 else 0)), None, None)
                for s in range(2009, 2016) for p in ("a", "b") if not (p == "b" and s == 2013)]
        frame = spark.createDataFrame(rows, "season int, gsis_player_id string, player_name string, team string, position string, games int, schedule_games int, source_week_rows int, targets double, receptions double, age double, experience double")
        return {(r.target_season, r.gsis_player_id): r for r in history.backtest_predictions(frame, rules).collect()}
    first, second = baseline(0), baseline(500)
    assert all(first[k].baseline_mean == second[k].baseline_mean for k in first)
    gap = first[2014, "b"]
    assert gap.lag_1_season is None and gap.lag_2_season == 2012 and gap.feature_seasons == "2011|2012|2013"


def test_snapshot_files_normalise_and_price(spark, tmp_path):
    side = lambda name, line, odds: {"selection_id": f"{name}/7", "label": f"{name.title()} {line}", "american_odds": odds}
    market = lambda i, who, stat, line, over, under: {"market_id": i, "player": who, "season": "2031-32", "stat": stat, "market_line": line, "threshold_operators": {"over": ">", "under": "<"},
                                                      "probability": {"over": side("over", line, over), "under": side("under", line, under)}}
    book = {"metadata": {"season": "2031-32", "snapshot_utc": "2031-05-02T07:30:00Z"}, "data_quality": {"checks_passed": True},
            "markets": [market("q-8", "Oda Winther", "receptions", 62.5, 150, -200), market("q-9", "Ravi Sund", "rushing_touchdowns", 4.5, -300, 240)]}
    contract = {"metadata": book["metadata"], "data_quality": {"checks_passed": True}, "markets": [
        {"ticker": "w-3", "player": "Oda Winther", "season": "2031-32", "stat": "receptions", "threshold_operator": ">=", "threshold": 70,
         "probability": {"yes_bid_percent": 22.0, "yes_ask_percent": 28.0}, "orderbook": {"best_yes_bid_dollars": 0.22, "best_yes_ask_dollars": 0.28}},
        {"ticker": "w-4", "player": "Ravi Sund", "season": "2031-32", "stat": "receptions", "threshold_operator": ">=", "threshold": 40, "probability": {"yes_ask_percent": 9.0}}]}
    for name, doc in (("book", book), ("contract", contract)):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    snaps = {kind: readers.read_snapshot(spark, str(tmp_path / f"{kind}.json"), kind) for kind in ("book", "contract")}
    rows = quotes.normalize([quotes.normalize_books(quotes.explode_markets(snaps["book"], "draftkings"), "run"),
                             quotes.normalize_contracts(quotes.explode_markets(snaps["contract"], "kalshi"), "run")])
    assert rows.count() == 6
    priced = {r.source_market_id: r for r in quotes.price_quotes(rows, SOURCES, PricingRules()).collect()}
    assert (priced["q-8"].canonical_threshold, priced["q-9"].canonical_threshold, priced["w-3"].canonical_threshold) == (63, 5, 70)
    # Implied 0.4 and 2/3; 0.75 and 5/17.
    assert priced["q-8"].no_vig_probability == pytest.approx(0.375) and priced["q-8"].market_overround == pytest.approx(16 / 15)
    assert priced["q-9"].no_vig_probability == pytest.approx(51 / 71) and priced["w-3"].modeling_probability == pytest.approx(0.25)
    assert (priced["w-4"].inclusion_status, priced["w-4"].exclusion_reason) == ("excluded", "missing_two_sided_yes_quote")
    now = F.lit("2031-05-02T09:00:00Z").cast("timestamp")
    stats = ("receptions", "rushing_touchdowns")
    for kind, source in (("book", "draftkings"), ("contract", "kalshi")):
        gate = quotes.snapshot_gate(snaps[kind], source, SOURCES[source], "2031-32", now, stats, PricingRules())
        checks.require(gate)
        stale = quotes.snapshot_gate(snaps[kind], source, SOURCES[source], "2030-31", now, stats[:1], PricingRules())
        with pytest.raises(checks.GateError):
            checks.require(stale)
    (tmp_path / "broken.json").write_text("{not json")
    with pytest.raises(ValueError):
        readers.read_snapshot(spark, str(tmp_path / "broken.json"), "book")


def test_names_with_an_exact_match_ask_for_no_similar_ones(spark, monkeypatch):
    """The search grows with the product of both sides; what an exact match settles needs none of it."""
    asked, search = [], names.similar_keys
    monkeypatch.setattr(names, "similar_keys", lambda queries, keys, floor: asked.extend(r[0] for r in queries.collect()) or search(queries, keys, floor))
    rows = resolve(spark, [("draftkings", "Lena Vastberg"), ("fanduel", "Lena Vastberg"), ("draftkings", "Theodor Brennecker")],
                   [("24", "Lena Vastberg"), ("25", "Theodore Brenneckar")])
    assert asked == ["theodor brennecker"]
    assert rows["draftkings", "Lena Vastberg"].match_method == rows["fanduel", "Lena Vastberg"].match_method == "exact_match_key"
    assert rows["draftkings", "Theodor Brennecker"].candidate_canonical_player_id == "gsis:25"
