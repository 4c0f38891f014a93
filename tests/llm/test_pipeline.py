"""The pipeline against plain versions of its stages, one after another."""

import random

import numpy as np
import pyarrow.parquet as pq
import zlib

import corpus_pipeline
from curvelake.llm import decontam, langid
from curvelake.llm.mixing import Mixture
from test_decontam import plain as plain_overlaps
from test_langid import plain_vector
from test_mixing import plain as plain_mixture
from test_simhash import plain_groups

FOLDER = "/root/testdata/sf0.001"


def plain_accepted(rows):
    fold = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    vectors = {d: plain_vector(t or "", langid.DIMENSIONS) for d, t, _, _ in rows}
    sums = {}
    for d, t, lang, _ in rows:
        if not fold(d) and lang and vectors[d].any():
            n = sum(c.isalpha() for c in t.lower())
            sums[lang] = sums.get(lang, 0) + vectors[d] / n
    unit = np.stack([s / np.linalg.norm(s) for s in sums.values()])
    return [r for r in rows if vectors[r[0]].any() and max(unit @ vectors[r[0]]) / np.linalg.norm(vectors[r[0]]) >= corpus_pipeline.MIN_COSINE]


def plain_lines(rows):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for d, t, _, _ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders.setdefault(key(x), set()).add(d)
    goes = lambda d, x: len(holders.get(key(x), ())) >= 5 and max(holders[key(x)]) != d
    return [(d, "\n".join(x for x in (t or "").split("\n") if not goes(d, x)), lang, s) for d, t, lang, s in rows]


def test_pipeline_against_plain_stages(spark):
    source = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    rows = plain_lines(plain_accepted([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in source]))
    firsts = {d for d, _, first in plain_groups([(r[0], r[1]) for r in rows]) if d == first}
    rows = [r for r in rows if r[0] in firsts]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    # The plain comparison takes all diagonals of pairs that share any four words in a row.
    four = lambda t: {tuple(w[i:i + 4]) for w in [decontam.words(t)] for i in range(len(w) - 3)}
    near = [(r, [i for i in items if four(i[1]) & four(r[1])]) for r in rows]
    hit = {d for r, some in near if some for d, _ in plain_overlaps([(r[0], r[1])], some)}
    assert hit
    rows = [r for r in rows if r[0] not in hit]
    copies, weight = plain_mixture([(d, s, t.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "})) for d, t, _, s in rows], Mixture())
    want = sorted((d, t, s, weight[s], copies[s, d]) for d, t, _, s in rows)
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_weight", "mix_copies"]
    assert sorted((r.doc_id, r.text, r.source, r.mix_weight, r.mix_copies) for r in found.collect()) == want
    assert 100 < len(want) < 200


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [(i, f"some plain words of the document number {i} in the house of the sun" * 3, "en", "s", i, "x") for i in range(30)]
    rows += [(40, None, "en", "s", None, "x"), (41, "", None, None, 0, "x"), (None, "some words of the house", "en", "s", 1, "x"), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, n_chars int, print string")
    for part in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, part, FOLDER)
            assert out.columns == docs.columns
            part = spark.createDataFrame(out.collect(), docs.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, part, FOLDER)
        assert set(docs.columns) < set(last.columns) and last.count() == part.count()


def test_documents_in_unlearned_scripts_go_and_short_texts_stay(spark):
    rng = random.Random(8)
    known = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in known]
    word = lambda low, high: "".join(chr(rng.randrange(low, high)) for _ in range(rng.randrange(2, 9)))
    scripts = [(0x3B1, 0x3CA), (0x430, 0x450), (0x4E00, 0x5000), (0x627, 0x64B)]
    unlike = [(10_000 + i, " ".join(word(*scripts[i % 4]) for _ in range(150)), None) for i in range(80)]
    short = [(20_000 + i, rng.choice(rng.choice(rows)[1].split()) + " a", None) for i in range(80)]
    docs = spark.createDataFrame(rows + unlike + short, "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, FOLDER).collect()}
    assert not kept & {d for d, _, _ in unlike}
    assert {d for d, _, _ in short} <= kept
    assert {d for d, t, _ in rows if any(c.isalpha() for c in t or "")} <= kept


def test_decisions_go_by_row(spark):
    """Two texts under one id, ids in two sources and rows without an id: nothing unrelated is lost."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    text = lambda n=80: " ".join(word() for _ in range(n))
    same, other, third, item = text(), text(), text(), text(30)
    docs = spark.createDataFrame([(1, same, "en", "s"), (2, same, "en", "s"), (2, other, "en", "s"), (3, third, "en", "s"), (3, third, "en", "s"), (None, same, "en", "s")],
                                 "doc_id int, text string, lang string, source string")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert sorted(map(str, kept.collect())) == sorted(map(str, [r for i, r in enumerate(docs.collect()) if i not in (1, 4)]))
    docs = spark.createDataFrame([(1, "x " + item), (1, text()), (None, item), (None, other)], "doc_id int, text string")
    items = spark.createDataFrame([(None, item), (7, text(20))], "item_id long, text string")
    assert sorted(map(str, decontam.without_overlaps(docs, items, block_bytes=100).collect())) == sorted(map(str, [docs.collect()[1], docs.collect()[3]]))
    assert {r.item_id for r in decontam.overlaps(docs, items).collect()} == {None}
    known = [(i, text(), "en") for i in range(20)]
    docs = spark.createDataFrame(known + [(50, "12 34", "en"), (50, text(), "en"), (None, "...", None), (None, text(), None)], "doc_id int, text string, lang string")
    assert sorted(str(r.doc_id) for r in langid.accepted(docs, 0.1).collect()) == sorted([str(i) for i in range(20)] + ["50", "None"])


def test_weights_go_by_source(spark):
    rows = [(None, "a b c", "small"), (None, " ".join("x" * 1 for _ in range(200)), "big"), (5, "d e f", "small"), (5, " ".join("y" for _ in range(300)), "big")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    found = {(r.doc_id, r.source): (r.mix_weight, r.mix_copies) for r in corpus_pipeline.mixture(spark, docs, FOLDER).collect()}
    assert len(found) == 4 and found[None, "small"][0] == found[5, "small"][0] < 0.1 < 0.9 < found[None, "big"][0] == found[5, "big"][0]
    assert {found[k][1] for k in found if k[1] == "big"} == {1} and max(found[k][1] for k in found if k[1] == "small") > 1
