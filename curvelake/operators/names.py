"""Conservative reconciliation of source names with known players.

Candidates are kept as plain rows (id, key, statistic), never as per-name lists:
a match key shared by very many players is reduced to its smallest and largest
id, which is all that a uniqueness test needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvelake.functions import numeric as N
from curvelake.functions.similarity import asked_pieces, asked_segments, filed_segments, has_segments, indel_ratio, pieces, within_edits
from curvelake.functions.text import initials_match, match_key, stable_id
from curvelake.operators.checks import Check, all_checks, check_table, grain_check
from curvelake.rules import NameRules, SourceRules
from curvelake.session import cut, growing, hashed, spread

WHO = ["source", "raw_player_name"]


# --- inputs ---------------------------------------------------------------------------

def _named(history: DataFrame) -> DataFrame:
    """History rows that name a player, as they come, in clean form."""
    return history.select(
        N.clean_text(F.col("gsis_player_id")).alias("gsis_player_id"), N.clean_text(F.col("player_name")).alias("player_name"),
        N.clean_text(F.col("position")).alias("position"), N.clean_text(F.col("team")).alias("team"),
        N.clean_text(F.col("stat")).alias("stat"),
    ).filter(F.col("gsis_player_id").isNotNull() & F.col("player_name").isNotNull())


def _known_id() -> Column:
    return F.concat(F.lit("gsis:"), F.col("gsis_player_id")).alias("canonical_player_id")


def candidate_rows(history: DataFrame) -> DataFrame:
    """Named history rows with their match key (computed once per distinct name)."""
    named = _named(history)
    distinct = named.groupBy(*named.columns).agg(F.count("*").alias("history_rows"))
    return distinct.withColumn("match_key", match_key(F.col("player_name"))).withColumn("canonical_player_id", _known_id())


def candidate_table(history: DataFrame) -> DataFrame:
    """One row per known player: greatest name and position, and the sets of keys, statistics and teams."""
    rows = candidate_rows(history)
    keys = F.array_sort(F.collect_set(F.nullif("match_key", F.lit(""))))
    table = rows.groupBy("canonical_player_id", "gsis_player_id").agg(
        F.max("player_name").alias("canonical_player_name"), F.max("position").alias("position"),
        keys.alias("match_keys"), F.array_sort(F.collect_set("stat")).alias("stats"),
        F.array_sort(F.collect_set("team")).alias("teams"))
    return table.filter((F.size("match_keys") > 0) & (F.size("stats") > 0))


def market_identities(quotes: DataFrame, sources: Sequence[str]) -> DataFrame:
    """One row per (source, raw name): match key and the sets of statistics and teams quoted."""
    team = F.coalesce(N.clean_text(F.col("team")), N.clean_text(F.col("team_abbreviation")))
    named = quotes.select(
        N.clean_text(F.col("source")).alias("source"), N.clean_text(F.col("raw_player_name")).alias("raw_player_name"),
        N.clean_text(F.col("stat")).alias("stat"), team.alias("team"),
    ).filter(F.col("source").isin(*sources) & F.col("raw_player_name").isNotNull())
    # Equal quotes are dropped first, by hash: sets of more than a few names at once are collected by sorting every row. The filter on
    # their number keeps all, but without it the optimizer would take the first grouping for superfluous.
    kinds = named.groupBy(*named.columns).agg(F.count("*").alias("quotes")).filter("quotes > 0")
    grouped = kinds.groupBy(*WHO).agg(
        F.array_sort(F.collect_set("stat")).alias("stats"), F.array_sort(F.collect_set("team")).alias("teams"))
    # One condition on key and group, so that keys are computed per name and not per quote.
    return grouped.withColumn("match_key", match_key(F.col("raw_player_name"))).filter(
        F.when(F.size("stats") > 0, F.col("match_key") != ""))


def prepared_aliases(aliases: DataFrame) -> DataFrame:
    return aliases.select(
        N.clean_text(F.col("source")).alias("source"), N.clean_text(F.col("raw_player_name")).alias("raw_player_name"),
        N.clean_text(F.col("canonical_player_id")).alias("canonical_player_id"),
        N.clean_text(F.col("canonical_player_name")).alias("canonical_player_name"),
    ).withColumn("match_key", match_key(F.col("raw_player_name")))


def alias_gate(aliases: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Known sources, complete rows, one identity per (source, key), one name per id."""
    prepared = prepared_aliases(aliases)
    incomplete = (~F.coalesce(F.col("source").isin(*sources, "*"), F.lit(False)) | F.col("raw_player_name").isNull()
                  | F.col("canonical_player_id").isNull() | F.col("canonical_player_name").isNull())
    identity = F.struct("canonical_player_id", "canonical_player_name")
    by_key = prepared.groupBy("source", "match_key").agg((F.min(identity) != F.max(identity)).alias("bad"))
    by_id = prepared.groupBy("canonical_player_id").agg(
        (F.min("canonical_player_name") != F.max("canonical_player_name")).alias("bad"))
    bad = F.count_if("bad").alias("n")
    return all_checks(
        check_table(prepared.agg(F.count_if(incomplete).alias("n"), F.count_if(F.col("match_key") == "").alias("empty")), [
            Check("identity.alias_values", F.col("n") == 0, "aliases are complete and name a known source", details={"rows": F.col("n")}),
            Check("identity.alias_keys", F.col("empty") == 0, "alias names have a key", details={"rows": F.col("empty")})]),
        check_table(by_key.agg(bad), [Check("identity.alias_contradictions.key", F.col("n") == 0,
                                            "a source and name map to one identity", details={"keys": F.col("n")})]),
        check_table(by_id.agg(bad), [Check("identity.alias_contradictions.id", F.col("n") == 0,
                                           "an id has one display name", details={"ids": F.col("n")})]))


def match_aliases(identities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Attach the explicit alias of each identity: source-specific first, then wildcard."""
    known = prepared_aliases(aliases).groupBy("source", "match_key").agg(
        F.min(F.struct("canonical_player_id", "canonical_player_name")).alias("a"))
    own = known.select("source", "match_key", F.col("a").alias("_own"))
    any_ = known.filter("source = '*'").select("match_key", F.col("a").alias("_any"))
    alias = F.coalesce("_own", "_any")
    return identities.join(own, ["source", "match_key"], "left").join(any_, "match_key", "left").select(
        *identities.columns, alias["canonical_player_id"].alias("alias_id"), alias["canonical_player_name"].alias("alias_name"))


# --- matching -------------------------------------------------------------------------

def pool_from_history(history: DataFrame) -> DataFrame:
    """Candidate pool rows: id, key, statistic (a player is known under all its keys for all its statistics)."""
    named = _named(history)
    names = named.groupBy("gsis_player_id", "player_name").agg(F.count("*").alias("rows"))
    # A row count in the key keeps it above the first grouping, one in the filter keeps the filter above the second: a key is computed once per name.
    key = match_key(F.when(F.col("rows") > 0, F.col("player_name")))
    keys = names.select(_known_id(), key.alias("match_key")).groupBy("canonical_player_id", "match_key").agg(F.count("*").alias("names")).filter(
        F.when(F.col("names") > 0, F.col("match_key") != "")).select("canonical_player_id", "match_key")
    stats = named.filter(F.col("stat").isNotNull()).select(_known_id(), "stat").distinct()
    return keys.join(growing(stats), "canonical_player_id")


def id_range(pool: DataFrame) -> DataFrame:
    """Smallest and largest candidate id per key and statistic."""
    return pool.groupBy("match_key", "stat").agg(
        F.min("canonical_player_id").alias("low_id"), F.max("canonical_player_id").alias("high_id"))


def team_range(pool: DataFrame, teams: DataFrame) -> DataFrame:
    """Largest candidate id per key, statistic and team."""
    return pool.join(growing(teams), "canonical_player_id").groupBy("match_key", "stat", "team").agg(
        F.max("canonical_player_id").alias("team_id"))


def exact_matches(identities: DataFrame, ranges: DataFrame) -> DataFrame:
    """Identities whose key is known for a shared statistic: the id if unique, else ambiguous."""
    asked = identities.select(*WHO, "match_key", F.explode("stats").alias("stat"))
    return asked.join(growing(ranges), ["match_key", "stat"]).groupBy(*WHO).agg(
        F.min("low_id").alias("low_id"), F.max("high_id").alias("high_id")).select(
            *WHO, F.when(F.col("low_id") == F.col("high_id"), F.col("low_id")).alias("exact_id"),
            (F.col("low_id") != F.col("high_id")).alias("ambiguous"))


def _rarest(rows: DataFrame, key: str, counts: DataFrame, floor: float) -> DataFrame:
    """``key, piece``: the rarest pieces of every key, as many as a similar key must share one of."""
    each = rows.select(key, "piece").join(growing(counts), "piece", "left")
    # A key's pieces: no more than it has letters.
    listed = each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece"))).alias("_p"))
    return listed.select(key, F.explode(F.slice("_p", F.lit(1), asked_pieces(F.length(key), floor))).alias("_p")).select(key, "_p.piece")


def _by_pieces(queries: DataFrame, keys: DataFrame, floor: float) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides by the rarest pieces of their keys."""
    # Outer: a plain explode would also filter on the (costly) array's size.
    asked = cut(spread(queries, "query_key").select("query_key", F.explode_outer(pieces("query_key", floor)).alias("piece")))
    filed = cut(spread(keys, "match_key").select("match_key", F.explode_outer(pieces("match_key", floor)).alias("piece")))
    counts = filed.groupBy("piece").agg(F.count("*").alias("n"))
    return cut(_rarest(asked, "query_key", counts, floor)), cut(_rarest(filed, "match_key", counts, floor)), ["piece"]


def _meetings(asked: DataFrame, filed: DataFrame, by: list[str]) -> int:
    """How many rows the join of both sides has."""
    sizes = [side.groupBy(*by).agg(F.count("*").cast("double").alias(n)) for side, n in ((asked, "_a"), (filed, "_f"))]
    return sizes[0].join(growing(sizes[1]), by).agg(F.coalesce(F.sum(F.col("_a") * F.col("_f")), F.lit(0.0)).alias("n")).first()["n"]


def _near(queries: DataFrame, keys: DataFrame, floor: float) -> DataFrame:
    """Pairs that may lie above the floor, from rare pieces or from segments, whichever makes fewer.

    Rare pieces do well where texts share words; segments where letters are even, so that no piece is rare and pairs
    by pieces would be a fixed share of all.
    """
    ways = [_by_pieces(queries, keys, floor)]
    long = has_segments("length(match_key)", floor)
    if not keys.filter(long).isEmpty():
        by = ["size", "place", "segment"]
        segments = cut(asked_segments(spread(queries, "query_key"), "query_key", floor)), cut(filed_segments(keys, "match_key", floor)), by
        asked, filed, _ = ways[0]
        if _meetings(*segments) < _meetings(asked, filed.filter(long), ["piece"]):
            ways = [(asked, filed.filter(~long), ["piece"]), segments]
    pairs = [asked.join(growing(filed), by).filter(within_edits("query_key", "match_key", floor)).select("query_key", "match_key") for asked, filed, by in ways]
    return reduce(DataFrame.unionByName, pairs).distinct()


def similar_keys(queries: DataFrame, keys: DataFrame, floor: float) -> DataFrame:
    """Pairs ``query_key, match_key, score`` with similarity of at least ``floor``, or matching initials (100).

    Both inputs hold distinct keys. Pairs come from equi-joins on each key's rarest
    pieces or its segments, of which every pair above the floor shares one, and on initials. Lengths and
    edit distance drop pairs inside the join, before anything is grouped.
    """
    if not 70.0 <= floor <= 100.0:
        raise ValueError("the similarity floor must lie between 70 and 100")
    # Each set of keys is read twice, for pieces and for initials.
    queries, keys = cut(queries), cut(keys)
    near = _near(queries, keys, floor)
    scored = near.select("query_key", "match_key", indel_ratio("query_key", "match_key").alias("score")).filter(
        F.col("score") >= floor - 1e-9)

    def last(c):
        return F.element_at(F.split(c, " "), -1)

    first = F.substring("query_key", 1, 1)
    short = queries.filter(F.col("query_key").rlike(r"^([a-z0-9] )+[a-z0-9]+$")).select(
        "query_key", last("query_key").alias("_last"), first.alias("_first"))
    full = keys.filter(F.contains("match_key", F.lit(" "))).select(
        "match_key", last("match_key").alias("_last"), F.substring("match_key", 1, 1).alias("_first"))
    initials = short.join(growing(full), ["_last", "_first"]).filter(
        initials_match(F.col("query_key"), F.col("match_key"))).select(
            "query_key", "match_key", F.lit(100.0).alias("score"))
    return scored.unionByName(initials).groupBy("query_key", "match_key").agg(F.max("score").alias("score"))


def rank_candidates(identities: DataFrame, pairs: DataFrame, ranges: DataFrame, team_ranges: DataFrame) -> DataFrame:
    """Best candidate and runner-up score per identity, ordered by score, team overlap and id.

    Rows are per similar key, not per candidate: players sharing a key share its score.
    """
    asked = identities.select(*WHO, F.col("match_key").alias("query_key"), "teams", F.explode("stats").alias("stat"))
    met = asked.join(growing(pairs), "query_key")
    ids = met.join(growing(ranges), ["match_key", "stat"]).groupBy(*WHO, "match_key", "score").agg(
        F.min("low_id").alias("low_id"), F.max("high_id").alias("high_id"))
    teammates = met.select(*WHO, "match_key", "stat", F.explode("teams").alias("team")).join(
        growing(team_ranges), ["match_key", "stat", "team"]).groupBy(*WHO, "match_key").agg(F.max("team_id").alias("team_id"))
    options = ids.join(growing(teammates), [*WHO, "match_key"], "left")
    # A window spans one identity's similar keys.
    mine = Window.partitionBy(*WHO)
    top = F.col("score") == F.col("best_score")
    placed = options.withColumn("best_score", F.max("score").over(mine)).withColumns({
        "_low": F.min(F.when(top, F.col("low_id"))).over(mine), "_high": F.max(F.when(top, F.col("high_id"))).over(mine),
        "_team": F.max(F.when(top, F.col("team_id"))).over(mine)})
    shared = F.col("_low") != F.col("_high")
    other = (F.col("low_id") != F.col("_high")) | (F.col("high_id") != F.col("_high"))
    return placed.groupBy(*WHO).agg(
        F.max("best_score").alias("best_score"),
        F.max(F.coalesce("_team", "_high")).alias("best_id"),
        F.max(F.when(shared, F.col("best_score")).when(~top & other, F.col("score"))).alias("runner_up_score"))


def decide_fuzzy(ranked: DataFrame, rules: NameRules) -> DataFrame:
    """Automatic match, or the reason for review."""
    gap = F.coalesce(F.col("best_score") - F.col("runner_up_score"), F.lit(float("inf")))
    good = F.col("best_score") >= rules.minimum_score
    auto = F.lit(rules.automatic_fuzzy_match) & good & (gap >= rules.minimum_runner_up_gap)
    reason = (F.when(auto, F.lit(None).cast("string"))
              .when(F.lit(not rules.automatic_fuzzy_match), "automatic_fuzzy_disabled")
              .when(~good, "score_below_minimum").otherwise("ambiguous_fuzzy_match"))
    return ranked.select(*WHO, "best_score", "best_id", "runner_up_score", auto.alias("fuzzy_auto"), reason.alias("fuzzy_reason"))


def accepted_names(chosen: DataFrame) -> DataFrame:
    """Names that keep their id when several names of a source claim it for the same statistic.

    In order of match key and name, a name is kept if none of its statistics was
    taken before; aliases always take theirs. Only the first name per statistic
    set can be kept, so a group holds at most one row per set of statistics.
    Input: ``source, raw_player_name, match_key, stats, chosen_id, is_alias``.
    """
    first = chosen.filter(F.col("chosen_id").isNotNull()).groupBy("source", "chosen_id", "stats", "is_alias").agg(
        F.min(F.struct("match_key", "raw_player_name")).alias("at"))
    row = F.struct(F.col("at.match_key").alias("match_key"), F.col("at.raw_player_name").alias("raw_player_name"),
                   "is_alias", "stats")
    nothing = F.array().cast("array<string>")
    start = F.struct(nothing.alias("taken"), nothing.alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        clash = F.arrays_overlap(acc["taken"], x["stats"])
        keep = ~x["is_alias"] & ~clash
        taken = F.when(x["is_alias"] | keep, F.array_union(acc["taken"], x["stats"])).otherwise(acc["taken"])
        kept = F.when(keep, F.array_append(acc["kept"], x["raw_player_name"])).otherwise(acc["kept"])
        return F.struct(taken.alias("taken"), kept.alias("kept"))

    folded = first.groupBy("source", "chosen_id").agg(
        F.aggregate(F.array_sort(F.collect_list(row)), start, step, lambda acc: acc["kept"]).alias("kept"))
    return folded.select("source", F.col("chosen_id"), F.explode("kept").alias("raw_player_name"))


def _floor(rules: NameRules) -> float:
    return min(rules.review_floor, rules.minimum_score - rules.minimum_runner_up_gap)


def _resolve_source(identities: DataFrame, ranges: DataFrame, team_ranges: DataFrame, pairs: DataFrame, rules: NameRules) -> DataFrame:
    """Match one source's identities against the ids visible to it; ``pairs`` are the similar keys."""
    open_ = identities.filter(F.col("alias_id").isNull())
    exact = cut(exact_matches(open_, ranges))
    rest = open_.join(growing(exact), WHO, "left_anti")
    fuzzy = decide_fuzzy(rank_candidates(rest, pairs, ranges, team_ranges), rules)
    reachable = rest.select(*WHO, F.explode("stats").alias("stat")).join(
        ranges.select("stat").distinct(), "stat", "left_semi").select(*WHO).distinct().withColumn("has_candidates", F.lit(True))
    joined = identities.join(growing(exact), WHO, "left").join(growing(fuzzy), WHO, "left").join(growing(reachable), WHO, "left")
    chosen = F.coalesce("alias_id", "exact_id", F.when(F.col("fuzzy_auto"), F.col("best_id")))
    method = (F.when(F.col("alias_id").isNotNull(), "explicit_alias").when(F.col("exact_id").isNotNull(), "exact_match_key")
              .when(F.col("fuzzy_auto"), "fuzzy_auto"))
    reason = (F.when(chosen.isNotNull(), F.lit(None).cast("string"))
              .when(F.col("ambiguous"), "ambiguous_exact_match_key")
              .when(F.col("fuzzy_reason").isNotNull(), F.col("fuzzy_reason"))
              .when(F.col("has_candidates"), "below_review_floor")
              .otherwise("no_candidate"))
    found = joined.withColumns({
        "is_alias": F.col("alias_id").isNotNull(), "chosen_id": chosen, "method": method, "reason": reason})
    kept = accepted_names(found).withColumn("kept", F.lit(True))
    guarded = found.join(growing(kept), ["source", "chosen_id", "raw_player_name"], "left")
    rejected = F.col("chosen_id").isNotNull() & ~F.col("is_alias") & F.col("kept").isNull()
    score = F.when(F.col("method") == "fuzzy_auto", F.col("best_score")).when(F.col("method").isNotNull(), 100.0)
    return guarded.withColumn("rejected", rejected).select(
        *WHO, "match_key", "stats", "teams", "alias_name", "is_alias",
        F.when(~rejected, F.col("chosen_id")).alias("chosen_id"),
        F.when(rejected, "unmatched").otherwise(F.coalesce("method", F.lit("unmatched"))).alias("match_method"),
        F.when(~rejected, score).alias("match_score"),
        F.when(rejected, "source_level_collision").otherwise(F.col("reason")).alias("reason"),
        F.when(rejected, F.col("chosen_id")).otherwise(F.when(F.col("fuzzy_reason").isNotNull(), F.col("best_id"))).alias("suggested_id"),
        F.when(rejected, score).when(F.col("ambiguous"), 100.0).when(F.col("fuzzy_reason").isNotNull(), F.col("best_score")).alias("suggested_score"),
        F.when(~rejected & F.col("ambiguous"), 100.0).when(~rejected & F.col("fuzzy_reason").isNotNull(), F.col("runner_up_score")).alias("runner_up_score"))


def reconcile(quotes: DataFrame, history: DataFrame, aliases: DataFrame, sources: Mapping[str, SourceRules],
              rules: NameRules) -> DataFrame:
    """Resolve every (source, raw name); one pass per source, in name order.

    Ids that aliases introduce become candidates for the sources that follow.
    """
    names = sorted(sources)
    identities = cut(match_aliases(market_identities(quotes, names), aliases))
    named = _named(history).select("*", _known_id())
    pool = cut(pool_from_history(history))
    teams = cut(named.filter(F.col("team").isNotNull()).select("canonical_player_id", "team").distinct())
    # The pool's ranges are made once; a source adds its few ids to them, since a smallest or largest id needs no other rows.
    past_ranges, past_teams = cut(id_range(pool)), cut(team_range(pool, teams))
    # Only ids of aliases join the pool, so the known players that they name are all that later sources need of it.
    alias_ids = cut(identities.filter(F.col("alias_id").isNotNull()).select(F.col("alias_id").alias("canonical_player_id")).distinct())
    listed, listed_teams = (cut(t.join(hashed(alias_ids), "canonical_player_id", "left_semi")) for t in (pool, teams))
    unknown = cut(alias_ids.join(growing(listed), "canonical_player_id", "left_anti").withColumn("_new", F.lit(True)))
    # The pool is filed once, for the keys of all sources that neither an alias nor an exact match settles: sources add ids but take none
    # away, so a name that meets its own key now never asks for similar ones.
    open_ = identities.filter(F.col("alias_id").isNull())
    settled = exact_matches(open_, past_ranges).select(*WHO)
    open_keys = cut(open_.join(growing(settled), WHO, "left_anti").select(F.col("match_key").alias("query_key")).distinct())
    known_keys = cut(pool.select("match_key").distinct())
    pairs = cut(similar_keys(open_keys, known_keys, _floor(rules)))
    parts, born = [], None
    for source in names:
        ranges, team_ranges, met = past_ranges, past_teams, pairs
        if born is not None:
            fresh = cut(born.select("match_key").distinct().join(growing(known_keys), "match_key", "left_anti"))
            if not fresh.isEmpty():
                met = pairs.unionByName(similar_keys(open_keys, fresh, _floor(rules)))
            seen = listed.unionByName(born.select("canonical_player_id", "match_key", F.explode("stats").alias("stat")))
            seen_teams = listed_teams.unionByName(born.select("canonical_player_id", F.explode("teams").alias("team"))).distinct()
            ranges = cut(past_ranges.unionByName(id_range(seen)).groupBy("match_key", "stat").agg(
                F.min("low_id").alias("low_id"), F.max("high_id").alias("high_id")))
            team_ranges = cut(past_teams.unionByName(team_range(seen.distinct(), seen_teams)).groupBy("match_key", "stat", "team").agg(
                F.max("team_id").alias("team_id")))
        resolved = cut(_resolve_source(identities.filter(F.col("source") == source), ranges, team_ranges, met, rules))
        parts.append(resolved)
        added = resolved.filter(F.col("chosen_id").isNotNull()).select(
            F.col("chosen_id").alias("canonical_player_id"), "match_key", "stats", "teams", "is_alias").join(
                growing(unknown), "canonical_player_id", "left").filter(F.col("is_alias") | F.col("_new")).drop("is_alias", "_new")
        born = added if born is None else born.unionByName(added)
    resolved = parts[0]
    for part in parts[1:]:
        resolved = resolved.unionByName(part)
    alias_names = prepared_aliases(aliases).groupBy("canonical_player_id").agg(F.min("canonical_player_name").alias("listed_name"))
    # The facts of the players that were found, not of all.
    found = resolved.select(F.explode(F.array("chosen_id", "suggested_id")).alias("canonical_player_id")).distinct()
    known = named.join(hashed(found), "canonical_player_id", "left_semi").groupBy("canonical_player_id").agg(
        F.max("player_name").alias("known_name"), F.max("position").alias("known_position"),
        F.max("gsis_player_id").alias("known_gsis_id"))
    described_ids = cut(known.join(alias_names, "canonical_player_id", "full_outer"))

    def described(df: DataFrame, id_column: str, prefix: str) -> DataFrame:
        facts = described_ids.select(
            F.col("canonical_player_id").alias(id_column), F.coalesce("known_name", "listed_name").alias(f"{prefix}_name"),
            F.col("known_position").alias(f"{prefix}_position"), F.col("known_gsis_id").alias(f"{prefix}_gsis_id"))
        return df.join(growing(facts), id_column, "left")

    full = described(described(resolved, "chosen_id", "chosen"), "suggested_id", "suggested")
    matched = F.col("chosen_id").isNotNull()
    return full.select(
        *WHO, F.col("match_key").alias("normalized_match_key"), "stats",
        F.coalesce("chosen_id", stable_id(F.col("match_key"))).alias("canonical_player_id"),
        F.when(matched, F.coalesce("alias_name", "chosen_name", "raw_player_name")).otherwise(
            F.col("raw_player_name")).alias("canonical_player_name"),
        "match_method", "match_score",
        F.when(F.col("is_alias") & matched, "alias").when(matched, "automatic").otherwise("unmatched").alias("review_status"),
        F.when(matched, F.col("chosen_position")).alias("canonical_position"),
        F.when(matched, F.col("chosen_gsis_id")).alias("canonical_gsis_player_id"),
        "reason", F.col("suggested_id").alias("candidate_canonical_player_id"),
        F.col("suggested_name").alias("candidate_canonical_player_name"),
        F.col("suggested_position").alias("candidate_position"), F.col("suggested_gsis_id").alias("candidate_gsis_player_id"),
        F.col("suggested_score").alias("suggested_score"), "runner_up_score")


def player_map(resolved: DataFrame) -> DataFrame:
    return resolved.select(
        *WHO, "normalized_match_key", "canonical_player_id", "canonical_player_name", "match_method", "match_score",
        "review_status", "canonical_position", "canonical_gsis_player_id")


def review_suggestions(resolved: DataFrame) -> DataFrame:
    """Names that need a reviewer, with the reason and the best candidate if any."""
    return resolved.filter(F.col("reason").isNotNull()).select(
        *WHO, "normalized_match_key", F.array_join("stats", "|").alias("observed_stats"), "candidate_canonical_player_id",
        "candidate_canonical_player_name", "candidate_gsis_player_id", "candidate_position",
        F.col("suggested_score").alias("match_score"), "runner_up_score", "reason",
        F.lit("needs_review").alias("review_status"))


def decorate(quotes: DataFrame, mapped: DataFrame) -> DataFrame:
    """Quotes with the identity of their source and raw name, met in clean form; the texts of the quotes stay as they are."""
    identity = mapped.select(
        F.col("source").alias("_source"), F.col("raw_player_name").alias("_name"), "canonical_player_id", "canonical_player_name",
        "canonical_position", "canonical_gsis_player_id",
        F.col("match_method").alias("identity_match_method"), F.col("match_score").alias("identity_match_score"),
        F.col("review_status").alias("identity_review_status"))
    met = (N.clean_text(F.col("source")) == F.col("_source")) & (N.clean_text(F.col("raw_player_name")) == F.col("_name"))
    return quotes.join(growing(identity), met, "left").drop("_source", "_name")


def identity_summary(mapped: DataFrame) -> DataFrame:
    return mapped.groupBy("review_status").agg(F.count("*").alias("names"))


def identity_gate(quotes: DataFrame, decorated: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every quote reconciled, unique map, ids present, no unaliased collision."""
    mapped = player_map(resolved)
    found = F.col("canonical_player_id").isNotNull()
    counts = quotes.select(F.lit("asked").alias("kind")).unionByName(decorated.select(F.when(found, "found").otherwise("lost").alias("kind"))).agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("asked", "found", "lost")])
    claims = resolved.filter("review_status <> 'alias'").select(
        "source", "canonical_player_id", "raw_player_name", F.explode("stats").alias("stat"))
    collisions = claims.groupBy("source", "stat", "canonical_player_id").agg(
        (F.min("raw_player_name") != F.max("raw_player_name")).alias("bad")).agg(F.count_if("bad").alias("bad"))
    counted = resolved.agg(F.count_if(F.col("reason").isNotNull()).alias("open"), F.count_if(
        F.coalesce(F.col("canonical_player_id"), F.lit("")) == "").alias("no_id"))
    return all_checks(
        check_table(counts, [Check("identity.input_rows_reconciled", (F.col("lost") == 0) & (F.col("asked") == F.col("found")),
                                   "every quote has one identity", details={"rows": F.col("lost")})]),
        grain_check(mapped, WHO, "identity.player_map_keys_unique", "map keys are unique"),
        check_table(counted, [
            Check("identity.canonical_ids_present", F.col("no_id") == 0, "every name has an id"),
            Check("identity.fuzzy_suggestions", F.col("open") == 0, "names need review", "warning", {"suggestions": F.col("open")})]),
        check_table(collisions, [Check("identity.source_level_collisions", F.col("bad") == 0,
                                       "unaliased names do not share an id and statistic")]))


def alias_actions(suggestions: DataFrame, aliases: DataFrame, sources: Sequence[str]) -> DataFrame:
    """What promoting approved suggestions does to an alias table, row by row.

    ``source, raw_player_name, match_key, canonical_player_id, canonical_player_name, action`` for every approved suggestion:
    ``append`` (the first of its source and key), ``present`` (its identity is there already), ``conflict`` (another one is) or ``incomplete``;
    and ``kept`` for every alias that no suggestion names. Applied to the grown table, no row appends again.
    """
    approved = suggestions.filter(F.lower(F.trim("review_status")).isin("approved", "approved_alias")).select(
        N.clean_text(F.col("source")).alias("source"), N.clean_text(F.col("raw_player_name")).alias("raw_player_name"),
        N.clean_text(F.col("candidate_canonical_player_id")).alias("canonical_player_id"),
        N.clean_text(F.col("candidate_canonical_player_name")).alias("canonical_player_name"))
    keyed = approved.withColumn("match_key", match_key(F.col("raw_player_name")))
    complete = (F.col("source").isin(*sources) & (F.col("match_key") != "") & F.col("canonical_player_id").isNotNull() & F.col("canonical_player_name").isNotNull())
    identity = F.struct("canonical_player_id", "canonical_player_name")
    # The suggestions of one source and key: few by meaning, and only their first matters.
    same_key = Window.partitionBy("source", "match_key", "_whole").orderBy("raw_player_name", "canonical_player_id", "canonical_player_name")
    placed = keyed.withColumn("_whole", F.coalesce(complete, F.lit(False))).withColumns({
        "_place": F.row_number().over(same_key), "_first": F.first(identity).over(same_key)})
    existing = prepared_aliases(aliases).groupBy("source", "match_key").agg(
        F.min(F.struct("canonical_player_id", "canonical_player_name")).alias("_there"), F.min("raw_player_name").alias("_listed"))
    met = placed.withColumn("_asked", F.lit(True)).join(existing, ["source", "match_key"], "full_outer")
    action = (F.when(F.col("_asked").isNull(), "kept").when(~F.col("_whole"), "incomplete")
              .when(F.col("_there").isNull() & (F.col("_place") == 1), "append")
              .when(F.coalesce("_there", "_first") == identity, "present").otherwise("conflict"))
    kept = F.col("_asked").isNull()
    return met.select(
        "source", F.when(kept, F.col("_listed")).otherwise(F.col("raw_player_name")).alias("raw_player_name"), "match_key",
        F.when(kept, F.col("_there.canonical_player_id")).otherwise(F.col("canonical_player_id")).alias("canonical_player_id"),
        F.when(kept, F.col("_there.canonical_player_name")).otherwise(F.col("canonical_player_name")).alias("canonical_player_name"), action.alias("action"))


def appended(aliases: DataFrame, actions: DataFrame) -> DataFrame:
    """The alias table with the rows that ``alias_actions`` appends."""
    fresh = actions.filter("action = 'append'").select(
        "source", "raw_player_name", "canonical_player_id", "canonical_player_name", F.lit("Promoted from review").alias("notes"))
    return aliases.unionByName(fresh, allowMissingColumns=True)


def promote_suggestions(suggestions: DataFrame, aliases: DataFrame, sources: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(aliases with approved suggestions appended, approved suggestions that conflict or are incomplete)."""
    approved = suggestions.filter(F.lower(F.trim("review_status")).isin("approved", "approved_alias")).select(
        "source", "raw_player_name", F.col("candidate_canonical_player_id").alias("canonical_player_id"),
        F.col("candidate_canonical_player_name").alias("canonical_player_name"), F.lit("Promoted from review").alias("notes"))
    keyed = approved.withColumn("match_key", match_key(F.col("raw_player_name")))
    existing = prepared_aliases(aliases).select(
        "source", "match_key", F.col("canonical_player_id").alias("_id"), F.col("canonical_player_name").alias("_name"))
    complete = (F.col("source").isin(*sources) & N.clean_text(F.col("raw_player_name")).isNotNull()
                & N.clean_text(F.col("canonical_player_id")).isNotNull() & N.clean_text(F.col("canonical_player_name")).isNotNull())
    complete = F.coalesce(complete, F.lit(False))
    clash = F.col("_id").isNotNull() & ((F.col("_id") != F.col("canonical_player_id")) | (F.col("_name") != F.col("canonical_player_name")))
    checked = keyed.join(existing, ["source", "match_key"], "left")
    problems = checked.filter(~complete | clash).select(
        "source", "raw_player_name", F.when(~complete, "incomplete").otherwise("conflicts_with_alias").alias("problem"))
    # One addition per (source, key); the first name wins.
    fresh = keyed.filter(complete).join(existing, ["source", "match_key"], "left_anti").groupBy("source", "match_key").agg(
        F.min_by(F.struct("raw_player_name", "canonical_player_id", "canonical_player_name", "notes"), "raw_player_name").alias("a")
    ).select("source", "a.*")
    return aliases.unionByName(fresh, allowMissingColumns=True), problems
