"""The two nearest candidates of names that no similarity floor reaches.

A floor makes pairs by an equi-join on rare pieces, but says nothing about names below it. Here the floor is widened in steps
for the names that are still short of two candidates (an anti-join after each step); what is left after the last step is searched
in blocks: the known keys of a statistic lie in parts of bounded size, the open names pass each part of their statistics one by
one, and a part answers with its best levels of score, as few as hold two different players. So no pair is materialised, and a
part needs no other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvelake.operators.names import WHO, id_range, rank_candidates, similar_keys
from curvelake.session import cut, growing, spread

#: Known keys of one statistic that lie in one part.
PART = 4096
#: Code points of a key that one machine word covers.
WORD = 63


class Keys:
    """Known keys as a matrix of code points, one row per key."""

    def __init__(self, keys: Sequence[str]):
        self.sizes = np.array([len(k) for k in keys], np.int64)
        self.letters = np.zeros((len(keys), int(self.sizes.max(initial=0))), np.int32)
        for i, key in enumerate(keys):
            self.letters[i, :len(key)] = np.frombuffer(key.encode("utf-32-le"), np.int32)

    def common(self, query: str) -> np.ndarray:
        """Longest common subsequence of the query with every key, bit-parallel over the query, in words of its letters."""
        words = -(-len(query) // WORD)
        whole = [(1 << min(WORD, len(query) - WORD * w)) - 1 for w in range(words)]
        points = {c: [0] * words for c in query}
        for i, c in enumerate(query):
            points[c][i // WORD] |= 1 << i % WORD
        names = np.array(sorted(map(ord, points)), np.int32)
        masks = np.array([points[chr(c)] for c in names] + [[0] * words], np.uint64)
        at = np.searchsorted(names, self.letters)
        at = np.where((at < len(names)) & (names[np.minimum(at, len(names) - 1)] == self.letters), at, len(names))
        rows = [np.full(len(self.sizes), w, np.uint64) for w in whole]
        for j in range(self.letters.shape[1]):
            carry = np.zeros(len(self.sizes), np.uint64)
            for w in range(words):
                met = rows[w] & masks[at[:, j], w]
                total = rows[w] + met + carry
                carry = total >> np.uint64(whole[w].bit_length())
                rows[w] = (total | (rows[w] - met)) & np.uint64(whole[w])
        return len(query) - sum(np.bitwise_count(r).astype(np.int64) for r in rows)

    def scores(self, query: str) -> np.ndarray:
        """Similarity of 0 to 100: twice the common letters over all letters."""
        return 200.0 * self.common(query) / np.maximum(self.sizes + len(query), 1)


def levels(score: np.ndarray, low: np.ndarray, high: np.ndarray, mates: np.ndarray) -> Iterator[tuple[float, str, str, str | None]]:
    """From the best score downwards, each level's smallest and largest id and largest teammate, until two players are seen."""
    seen: set[str] = set()
    for value in np.unique(score)[::-1]:
        here = np.flatnonzero(score == value)
        least, most = min(low[here]), max(high[here])
        friends = [m for m in mates[here] if m is not None]
        yield float(value), least, most, max(friends) if friends else None
        seen |= {least, most}
        if len(seen) > 1:
            return


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by statistic and part, known keys (side 0) before names (side 1)."""
    names = ["source", "raw_player_name", "score", "low_id", "high_id", "team_id"]
    kinds = [pa.string(), pa.string(), pa.float64(), pa.string(), pa.string(), pa.string()]
    current, known, part = None, [], None
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            if (row["stat"], row["part"]) != current:
                current, known, part = (row["stat"], row["part"]), [], None
            if row["side"] == 0:
                known.append(row)
                continue
            if not known:
                continue
            if part is None:
                part = (Keys([k["match_key"] for k in known]), np.array([k["low_id"] for k in known], object), np.array([k["high_id"] for k in known], object),
                        [dict(k["mates"] or ()) for k in known])
            keys, low, high, mates = part
            own = row["teams"] or ()
            friends = np.empty(len(mates), object)
            friends[:] = [max((m[t] for t in own if t in m), default=None) for m in mates]
            made += [(row["source"], row["raw_player_name"], *level) for level in levels(keys.scores(row["match_key"]), low, high, friends)]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=names)


def in_blocks(asked: DataFrame, ranges: DataFrame, team_ranges: DataFrame) -> DataFrame:
    """``source, raw_player_name, score, low_id, high_id, team_id``: the best levels of every part of a name's statistics."""
    mates = team_ranges.groupBy("match_key", "stat").agg(F.map_from_entries(F.collect_list(F.struct("team", "team_id"))).alias("mates"))
    sizes = ranges.groupBy("stat").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    none = F.lit(None)
    known = ranges.join(growing(mates), ["match_key", "stat"], "left").join(sizes, "stat").select(
        "stat", F.pmod(F.xxhash64("match_key"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("side"), none.cast("string").alias("source"),
        none.cast("string").alias("raw_player_name"), "match_key", "low_id", "high_id", "mates", none.cast("array<string>").alias("teams"))
    open_ = asked.select(*WHO, "match_key", "teams", F.explode("stats").alias("stat")).join(sizes, "stat").select(
        "stat", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("side"), *WHO, "match_key", none.cast("string").alias("low_id"),
        none.cast("string").alias("high_id"), none.cast("map<string, string>").alias("mates"), "teams")
    dealt = spread(known.unionByName(open_), "stat", "part").sortWithinPartitions("stat", "part", "side")
    return dealt.mapInArrow(_search, "source string, raw_player_name string, score double, low_id string, high_id string, team_id string")


def best_of(options: DataFrame) -> DataFrame:
    """Best candidate and runner-up of each name from its levels: ``best_score, best_id, runner_up_score``.

    Order: score, then team overlap, then id, the largest first.
    """
    mine = Window.partitionBy(*WHO)  # a few levels per part
    top = F.col("score") == F.col("best_score")
    placed = options.withColumn("best_score", F.max("score").over(mine)).withColumns({
        "_low": F.min(F.when(top, F.col("low_id"))).over(mine), "_high": F.max(F.when(top, F.col("high_id"))).over(mine)})
    shared = F.col("_low") != F.col("_high")
    other = (F.col("low_id") != F.col("_high")) | (F.col("high_id") != F.col("_high"))
    return placed.groupBy(*WHO).agg(
        F.max("best_score").alias("best_score"), F.coalesce(F.max(F.when(top, F.col("team_id"))), F.max("_high")).alias("best_id"),
        F.max(F.when(shared, F.col("best_score")).when(~top & other, F.col("score"))).alias("runner_up_score"))


def best_two(asked: DataFrame, pool: DataFrame, teams: DataFrame, floors: Sequence[float] = (80.0, 70.0)) -> DataFrame:
    """``source, raw_player_name, best_score, best_id, runner_up_score`` for every name with a candidate of one of its statistics.

    ``asked``: names with ``match_key, stats, teams``. ``pool``: ``canonical_player_id, match_key, stat``; ``teams``:
    ``canonical_player_id, team``. A name is settled at the first floor above which two players lie: all others are below it.
    """
    ranges = cut(id_range(pool))
    team_ranges = cut(pool.join(growing(teams), "canonical_player_id").groupBy("match_key", "stat", "team").agg(F.max("canonical_player_id").alias("team_id")))
    keys = pool.select("match_key").distinct()
    open_, settled = cut(asked), None
    for floor in floors:
        pairs = similar_keys(open_.select(F.col("match_key").alias("query_key")).distinct(), keys, floor)
        found = cut(rank_candidates(open_, pairs, ranges, team_ranges).filter("runner_up_score is not null"))
        settled = found if settled is None else settled.unionByName(found)
        open_ = cut(open_.join(growing(found), WHO, "left_anti"))
    rest = best_of(in_blocks(open_, ranges, team_ranges))
    return rest if settled is None else settled.select(rest.columns).unionByName(rest)
