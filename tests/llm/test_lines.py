import hashlib
import random

import pytest

from curvelake.llm import lines, queries


def plain(rows, min_chars=40, min_docs=5):
    """rows of (doc_id, text) -> sorted (doc_id, n_lines, n_dropped, sha256)."""
    def key(line):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
        return low if len(low) >= min_chars else None
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if (k := key(line)) is not None:
                holders.setdefault(k, set()).add(doc)
    out = []
    for doc, text in rows:
        own = (text or "").split("\n")
        def stays(line):
            k = key(line)
            if k is None or len(holders[k]) < min_docs:
                return True
            named = [d for d in holders[k] if d is not None]
            return doc == (max(named) if named else None)
        kept = [x for x in own if stays(x)]
        out.append((doc, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, docs=80):
    rng = random.Random(seed)
    shared = ["Common line number %d with enough characters to count é" % i for i in range(12)] + ["short", "", "x" * 39, "x" * 40, "é" * 40, "é" * 39]
    rows = []
    for i in range(docs):
        own = [rng.choice(shared) if rng.random() < 0.6 else "own %d %d" % (i, rng.random() * 1e9) + "y" * 30 for _ in range(rng.randrange(8))]
        own = [rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < .3 and x.isascii() else x) + rng.choice(["", "  ", "\r"]) for x in own]
        rows.append((i, "\n".join(own + ["The hottest line of them all, held by every document"])))
    return rows + [(900, None), (901, ""), (902, "\n\n"), rows[3], (None, rows[4][1]), (None, rows[5][1]), (7, rows[8][1])]


def result(spark, rows, partitions=7):
    docs = spark.createDataFrame([(*r, 1, b"k") for r in rows], "doc_id int, text string, pos int, keep binary").repartition(partitions)
    return sorted(map(tuple, queries.digest_of_lines(docs).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert result(spark, rows) == plain(rows)


@pytest.mark.parametrize("partitions", [1, 40])
def test_a_run_over_many_partitions(spark, partitions):
    """One line in 3000 documents, dealt over range partitions that each hold a part of the run."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(i, "this is the one line that all of the documents hold together\n%d" % i) for i in range(3000)]
        rows += [(5000 + i, "a line that only four documents hold is a line that stays here") for i in range(4)]
        assert result(spark, rows, 3) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])


def test_streamed_batches_of_any_size():
    """The runs of one sorted partition, cut into batches at every place, give the same decisions."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(4)
    rows = sorted([(int(h), 0, int(d), 7, p, 9) for h in range(12) for d in rng.choice(30, rng.integers(1, 12), replace=False) for p in range(rng.integers(1, 3))],
                  key=lambda r: (r[0], -r[2], r[4]))
    def run(size):
        batches = (pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + size])], names=list("abcdef")) for i in range(0, len(rows), size))
        out = [tuple(r.values()) for b in lines._stream(batches, 5) for r in b.to_pylist()]
        return sorted(out)
    whole = run(10_000)
    assert all(run(size) == whole for size in (1, 2, 3, 7, 20))


def test_the_stage_keeps_columns_and_updates_lengths(spark):
    text = "a line that is long enough and that five documents share, all"
    rows = [(i, f"{text}\nown {i}", 99, "kept") for i in range(5)] + [(9, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_chars int, keep string")
    out = lines.without_repeated_lines(docs)
    assert out.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars, r.keep) for r in out.collect()}
    assert got == {i: (f"own {i}", 5, "kept") for i in range(4)} | {4: (f"{text}\nown 4", len(text) + 6, "kept"), 9: (None, None, None)}


def test_empty_table(spark):
    assert queries.digest_of_lines(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_bitmaps_never_pass_the_driver(spark):
    docs, marks = spark.range(20).selectExpr("id doc_id", "'text' text"), spark.range(20).selectExpr("id doc", "id print", "1L n_lines", "1L n_dropped", "X'00' keep")
    plan = lines.with_bitmaps(docs, marks)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
