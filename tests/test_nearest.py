"""Best candidate and runner-up without a floor, against all pairs."""

import random

from curvelake.operators import nearest


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_letters_in_words():
    rng = random.Random(3)
    keys = ["".join(rng.choice("abcdé 𝔞") for _ in range(rng.randrange(0, 150))) for _ in range(60)] + [""]
    held = nearest.Keys(keys)
    for n in (1, 5, 62, 63, 64, 126, 127, 200):
        query = "".join(rng.choice("abcdé 𝔞z") for _ in range(n))
        assert held.common(query).tolist() == [lcs(query, k) for k in keys]


def plain(asked, pool, teams):
    out = {}
    for source, name, key, stats, own in asked:
        scores = {}
        for player, k, stat in pool:
            if stat in stats:
                s = 200.0 * lcs(key, k) / (len(key) + len(k))
                mate = any(t in own for p, t in teams if p == player)
                scores[player] = max(scores.get(player, (0.0, mate, player)), (s, mate, player))
        ranked = sorted(scores.values(), reverse=True)
        if ranked:
            out[source, name] = (ranked[0][2], round(ranked[0][0], 9), round(ranked[1][0], 9) if len(ranked) > 1 else None)
    return out


def found(spark, asked, pool, teams, **kw):
    rows = nearest.best_two(
        spark.createDataFrame(asked, "source string, raw_player_name string, match_key string, stats array<string>, teams array<string>"),
        spark.createDataFrame(pool, "canonical_player_id string, match_key string, stat string"),
        spark.createDataFrame(teams, "canonical_player_id string, team string"), **kw).collect()
    assert len({(r.source, r.raw_player_name) for r in rows}) == len(rows)
    return {(r.source, r.raw_player_name): (r.best_id, round(r.best_score, 9), None if r.runner_up_score is None else round(r.runner_up_score, 9)) for r in rows}


def case(seed, players=60, names=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(2, 7)))
    pool, teams = [], []
    for i in range(players):
        for key in {f"{word()} {word()}" for _ in range(rng.randrange(1, 3))}:
            pool += [(f"p{i:03}", key, s) for s in rng.sample("xyz", rng.randrange(1, 3))]
        teams += [(f"p{i:03}", t) for t in rng.sample("ABCD", rng.randrange(3))]
    pool += [("p900", pool[0][1], pool[0][2]), ("p901", "only one", "w")]
    asked = [("s", f"n{i}", f"{word()} {word()}", rng.sample("xyz", rng.randrange(1, 3)), rng.sample("ABCD", rng.randrange(3))) for i in range(names)]
    asked += [("s", "same", pool[0][1], [pool[0][2]], []), ("s", "alone", "quite other", ["w"], ["A"]), ("s", "nobody", "ab cd", ["v"], []), ("t", "near", pool[9][1] + "x", list("xyz"), ["A", "B"])]
    return asked, sorted(set(pool)), sorted(set(teams))


def test_against_all_pairs(spark):
    asked, pool, teams = case(1)
    got = found(spark, asked, pool, teams)
    assert got == plain(asked, pool, teams) and ("s", "nobody") not in got and got["s", "alone"][2] is None


def test_small_parts_and_no_floor(spark, monkeypatch):
    monkeypatch.setattr(nearest, "PART", 5)
    asked, pool, teams = case(2)
    assert found(spark, asked, pool, teams, floors=()) == plain(asked, pool, teams)
    assert found(spark, [], pool, teams) == {}
