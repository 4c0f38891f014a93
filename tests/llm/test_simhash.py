import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from curvelake.llm import links, simhash

BLANK = " \t\n\x0b\x0c\r"


def plain_print(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in BLANK:
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    values = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_groups(rows, distance=4):
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= distance and group[i] != group[j]:
            old = group[j]
            group = [group[i] if g == old else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return sorted(((d, f"{p:016x}", least[g]) for (d, _), p, g in zip(rows, prints, group, strict=True)), key=str)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["w" + str(i) for i in range(300)] + ["Été", "ÄB", "x y"]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.randrange(1, 160))]
        for _ in range(rng.randrange(1, 6)):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(own)))
    return rows + [(900, None), (901, ""), (902, " \n"), (None, "solo"), (None, rows[0][1]), (5, rows[5][1]), (903, "W1 w2"), (904, "w1 W2")]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id int, text string, print int, component_id string").repartition(5)
    found = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert found == plain_groups(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0


@pytest.mark.parametrize("blocks", [5, 7, 8])
def test_every_choice_of_blocks_shares_a_key(blocks):
    rng = random.Random(1)
    masks = simhash.block_masks(4, blocks)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << i for i in rng.sample(range(64), 4))
        assert any(a & m == b & m for m in masks)


def test_one_hot_key_in_tiles(spark):
    """A dense cloud of fingerprints around one centre, with tiles far smaller than the cloud."""
    rng = random.Random(9)
    prints = {0x0123456789ABCDEF ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(7))) for _ in range(400)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print bigint")
    found = links.components(simhash.links(table, tile=50))
    got = {r.node % 2**64: r.component for r in found.collect()}
    group = {p: p for p in prints}
    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 4 and group[a] != group[b]:
            old, new = group[b], group[a]
            group = {p: new if g == old else g for p, g in group.items()}
    def classes(of):
        out = {}
        for p, g in of.items():
            out.setdefault(g, set()).add(p)
        return {frozenset(v) for v in out.values() if len(v) > 1}
    assert classes(got) == classes(group)


def test_links_are_verified_and_span():
    values = np.array([0, 1, 3, 7, 15, 31, 1 << 40], np.uint64)
    pairs = simhash.forest(values, 1)
    assert all((a ^ b).bit_count() <= 1 for a, b in pairs) and len(pairs) == 5 + 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.component for r in links.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}


def test_one_of_each(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id int, text string, component_id string")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for d, _, c in plain_groups(rows) if d is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == sorted(want) and got.count(None) == 2


def test_growing_tables_never_pass_the_driver(spark):
    """Spark takes the 70 keys of a fingerprint for one row, so small tables show what larger ones under its limit would do."""
    plan = simhash.links(spark.range(20).selectExpr("id print"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_chosen_documents_never_pass_the_driver(spark):
    docs = spark.createDataFrame([(*r, "c") for r in corpus()], "doc_id int, text string, component_id string")
    plan = simhash.one_of_each(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
