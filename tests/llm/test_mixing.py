import hashlib
from collections import defaultdict
from math import ceil, floor, log

import pytest

from curvelake.llm import mixing
from curvelake.llm.mixing import Mixture


def md5(*parts):
    return hashlib.md5(":".join(["mix", *map(str, parts)]).encode()).hexdigest()


def plain(rows, mixture):
    """(doc_id, source, text) -> {(source, doc_id): copies}, weights; one halving after another."""
    n = [(d, s or "", max(1, len((t or "").split(" ")) - (t or "").split(" ").count(""))) for d, s, t in rows]
    tokens = defaultdict(int)
    for _, s, k in n:
        tokens[s] += k
    total = sum(tokens.values())
    share = {s: k / total for s, k in tokens.items()}

    def fits(a):
        mass = sum(p ** a for p in share.values())
        w = {s: p ** a / mass for s, p in share.items()}
        if mixture.entropy is not None:
            return -sum(x * log(x) for x in w.values()) <= mixture.entropy
        big = max(share, key=share.get)
        budget = mixture.budget or tokens[big] / w[big]
        return max(budget * w[s] / tokens[s] for s in w) <= mixture.max_epochs * (1 + 1e-12)
    lo, hi = -1, 1 << 30
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid / 2 ** 30) else (mid, hi)
    a = hi / 2 ** 30
    mass = sum(p ** a for p in share.values())
    weight = {s: floor(p ** a / mass * 1e9 + 0.5) / 1e9 for s, p in share.items()}
    out = {}
    big = max(tokens, key=lambda s: (tokens[s], s))
    for s, k in tokens.items():
        if mixture.budget is None:
            budget = max(k, floor(ceil(tokens[big] / weight[big]) * weight[s]))
        else:
            budget = floor(min(mixture.budget, k * mixture.max_epochs / weight[s]) * weight[s])
        whole, rest = divmod(budget, k)
        blocks = ceil(k / mixture.block_tokens)
        held = defaultdict(list)
        for d, own, c in n:
            if own == s:
                held[int(md5("" if d is None else d)[:8], 16) % blocks].append((md5(whole, "" if d is None else d), -1 if d is None else d, c, d))
        for b in sorted(held, key=lambda b: (md5(s, whole, b), b)):
            size = sum(x[2] for x in held[b])
            used = 0
            for _, _, c, d in sorted(held[b]):
                used += c
                out[s, d] = whole + (1 if rest >= size or (rest > 0 and used <= rest) else 0)
            rest -= size
    return out, weight


ROWS = [(i, "abcdef"[min(5, i % 23 // 3)], " ".join(["w"] * (i * 7 % 31))) for i in range(400)] + [(900, None, "a b c"), (901, "a", None), (902, "f", "x " * 3000)]


@pytest.mark.parametrize("mixture", [Mixture(), Mixture(block_tokens=100), Mixture(max_epochs=1.5, block_tokens=64), Mixture(max_epochs=None, entropy=1.6, block_tokens=200),
                                     Mixture(budget=2000, block_tokens=50), Mixture(budget=60_000, max_epochs=2.0), Mixture(max_epochs=1.0)])
def test_copies_against_plain_python(spark, mixture):
    docs = spark.createDataFrame([(*r, 7) for r in ROWS], "doc_id int, source string, text string, copies int").repartition(3)
    if mixture.entropy is not None:
        want, weight = plain(ROWS, Mixture(max_epochs=None, entropy=mixture.entropy, block_tokens=mixture.block_tokens))
    else:
        want, weight = plain(ROWS, mixture)
    got = mixing.copies(docs, mixture).collect()
    assert {(r.source, r.doc_id): r.copies for r in got} == want and len(got) == len(ROWS)
    assert {r.source: r.weight for r in got} == weight
    if mixture.budget is None:
        assert min(want.values()) >= 1
    if mixture.max_epochs:
        assert max(want.values()) <= ceil(mixture.max_epochs)


def test_schedule_permutes_blocks_anew_in_every_epoch(spark):
    docs = spark.createDataFrame(ROWS, "doc_id int, source string, text string")
    mixture = Mixture(block_tokens=100)
    taken = mixing.copies(docs, mixture)
    rows = mixing.schedule(taken, mixture).collect()
    want = {(r.source, r.doc_id): r.copies for r in taken.collect()}
    got = defaultdict(list)
    for r in rows:
        got[r.source, r.doc_id].append(r.epoch)
    assert {k: len(v) for k, v in got.items()} == want and all(sorted(v) == list(range(len(v))) for v in got.values())
    for (source, epoch), blocks in {(r.source, r.epoch): {(x.block_rank, x.block) for x in rows if (x.source, x.epoch) == (r.source, r.epoch)} for r in rows}.items():
        assert [b for _, b in sorted(blocks)] == sorted({b for _, b in blocks}, key=lambda b: (md5(source, epoch, b), b))
    orders = {e: [b for _, b in sorted({(x.block_rank, x.block) for x in rows if x.source == "a" and x.epoch == e})] for e in (0, 1)}
    assert orders[0] != orders[1]


def test_mixed_keeps_columns(spark):
    rows = [(1, "a", "x y", 5), (2, "b", "x", 6), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, source string, text string, mix_copies int")
    out = mixing.mixed(docs)
    assert out.columns == ["doc_id", "source", "text", "mix_weight", "mix_copies"] and out.count() == 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, source string, text string")
    assert mixing.schedule(mixing.copies(docs)).count() == 0
