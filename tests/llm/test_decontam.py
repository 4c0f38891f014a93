import random
from itertools import combinations

import pytest

from curvelake.llm import decontam

VOCABULARY = [f"w{i}" for i in range(400)] + ["été", "Größe", "the", "of"]


def plain(docs, items, similarity=0.8, min_words=12):
    """Every diagonal of every pair; of the segments with 80 % equal words, the longest."""
    out = set()
    for doc, text in docs:
        w = decontam.words(text)
        for item, it in set(items):
            v = decontam.words(it)
            if len(v) < decontam.MIN_ITEM:
                continue
            need = min(min_words, -(-len(v) * 8 // 10))
            for d in range(-len(v), len(w)):
                same = [w[q + d] == v[q] for q in range(max(0, -d), min(len(v), len(w) - d))]
                if sum(same) < need:
                    continue
                best = max((b - a, a, b) for a in range(len(same) + 1) for b in range(a, len(same) + 1) if 10 * sum(same[a:b]) >= 8 * (b - a))
                best = sum(same[best[1]:best[2]])
                if best >= need:
                    out.add((doc, item))
    return out


def corpus(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(rng.choice([5, 8, 12, 13, 14, 15, 20, 40])))) for i in range(30)]
    docs = []
    for i in range(80):
        body = [rng.choice(VOCABULARY) for _ in range(rng.randrange(30))]
        if rng.random() < 0.6:
            own = rng.choice(items)[1].split()
            gap = rng.choice([None, 6, 7, 9, 15])
            if gap:
                own = [rng.choice(VOCABULARY) if k % gap == gap // 2 else x for k, x in enumerate(own)]
            if rng.random() < 0.3:
                own = own[: rng.randrange(3, len(own) + 1)]
            at = rng.randrange(len(body) + 1)
            body[at:at] = [x.upper() + rng.choice(["", ",", ".", "!"]) for x in own]
        docs.append((i, rng.choice([" ", "\n"]).join(body)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_against_brute_force(seed):
    docs, items = corpus(seed)
    block = decontam.Items(items, 0.8, 12)
    got = {(d, hit[0]) for d, t in docs for hit in block.search(t)}
    want = plain(docs, items)
    assert got == want and len(want) > 10


@pytest.mark.parametrize("size", [15, 22, 50])
def test_whole_items_with_a_substitution_in_every_seventh_word_are_found(size):
    rng = random.Random(size)
    item = [f"q{i}" for i in range(size)]
    block = decontam.Items([(1, " ".join(item))], 0.8, 12)
    for shift in range(7):
        own = [x if k % 7 != shift else "other" for k, x in enumerate(item)]
        assert [h[0] for h in block.search("before " + " ".join(own) + " after")] == [1], shift
    assert block.search(" ".join(rng.sample(item, size))) == []


@pytest.mark.parametrize("size", range(4, 25))
def test_no_permitted_pattern_of_equal_words_is_lost(size):
    """All substitutions that 0.8 allows in a whole item, or in any 15 words of a longer one."""
    block = decontam.Items([(1, " ".join(f"q{i}" for i in range(size)))], 0.8, 12)
    need = min(12, -(-size * 8 // 10))
    width = min(size, 15)
    lost = []
    for gone in range(width - need + 1):
        for holes in combinations(range(width), gone):
            if 10 * (width - gone) < 8 * width:
                continue
            for at in range(size - width + 1):
                own = [f"q{i}" if at <= i < at + width and i - at not in holes else f"x{i}" for i in range(size)]
                if [h[0] for h in block.search(" ".join(own))] != [1]:
                    lost.append((at, holes))
    assert not lost


def test_place_and_counts():
    block = decontam.Items([(7, "one two three four five six seven eight")], 0.8, 12)
    assert block.search("x y One, two THREE four five six nine eight z") == [(7, 7, 8, 2, 0)]
    assert block.search("one two three") == [] and block.search(None) == [] and block.search("") == []


def test_blocks_and_odd_rows(spark):
    docs, items = corpus(5)
    docs += [(500, None), (501, ""), (None, docs[0][1]), docs[1], (502, "filler " * 50_000 + items[0][1])]
    items += [(100, None), (101, ""), (102, "one two"), items[3], (None, "a b c d e f")]
    table = spark.createDataFrame([(*r, "x") for r in docs], "doc_id int, text string, item_id string").repartition(3)
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id int, text string, doc_id string")
    block = decontam.Items([r for r in set(items) if r[0] is not None and r[1]], 0.8, 12)
    want = sorted(((d, *h) for d, t in docs for h in block.search(t)), key=str)
    assert sorted(map(tuple, decontam.overlaps(table, bench).collect()), key=str) == want
    assert sorted(map(tuple, decontam.overlaps(table, bench, block_bytes=500).collect()), key=str) == want
    kept = decontam.without_overlaps(table, bench)
    bad = {r[0] for r in want}
    assert kept.columns == table.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, _ in docs if d is None or d not in bad), key=str)
    assert decontam.overlaps(table, bench.limit(0)).count() == 0 and decontam.overlaps(table.limit(0), bench).count() == 0
