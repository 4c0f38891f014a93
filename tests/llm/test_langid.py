import numpy as np
import pytest
import zlib

from curvelake.llm import langid
from curvelake.llm.common import table


def plain_vector(text, dimensions):
    """Windows bound and bundled one by one."""
    out = np.zeros(dimensions)
    low = "\0" + text.lower() + "\0"
    code = [ord(c) if c.isalpha() else 0 for c in low]
    for a, b, c in zip(code, code[1:], code[2:]):
        if b:
            v = [langid.letter_vector(x, dimensions).astype(int) for x in (a, b, c)]
            out += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return out


TEXTS = ["The quick brown fox", "", "123 !?", "Größe und ÜBER", "日本語テキスト", None, "a", "İstanbul ŉ 𝒳x", "x\0y"]


@pytest.mark.parametrize("held", [langid.HELD, 5])
def test_batches_equal_single_windows(monkeypatch, held):
    monkeypatch.setattr(langid, "HELD", held)
    for t, got in zip(TEXTS, langid.Windows(TEXTS, 64).documents(), strict=True):
        want = plain_vector(t or "", 64)
        assert (got is None and not want.any()) or np.allclose(got, want)


def test_prediction_against_plain_profiles(spark):
    rows = [(i, t, l, "x") for i, (t, l) in enumerate([("the house of the rising sun and the sea", "en"), ("das haus und die sonne über dem meer", "de"),
            ("la maison de la mer et le soleil", "fr")] * 6)]
    rows += [(100, None, "en", "x"), (101, "12 34", "de", "x"), (102, "the sun and the house", None, "x"), (None, "die sonne und das meer", "de", "x"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, score string").repartition(4)
    fold = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 5 == 0
    sums = {}
    for d, t, l, _ in rows:
        if not fold(d) and l and t and any(c.isalpha() for c in t):
            n = len([c for c in t if c.isalpha()])
            sums[l] = sums.get(l, 0) + plain_vector(t, langid.DIMENSIONS) / n
    want = []
    for d, t, l, _ in rows:
        v = plain_vector(t or "", langid.DIMENSIONS)
        if not v.any():
            want.append((d, fold(d), "und", 0.0))
            continue
        cos = {k: v @ s / np.linalg.norm(v) / np.linalg.norm(s) for k, s in sums.items()}
        best = max(sorted(cos), key=cos.get)
        want.append((d, fold(d), best, round(max(0, cos[best]), 4)))
    got = [(r.doc_id, r.held_out, r.lang_pred, round(r.score, 4)) for r in langid.identify(docs).collect()]
    key = lambda r: str(r[:3])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 2e-4


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    found = langid.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 20 and np.mean([r.lang == r.lang_pred for r in found]) > 0.95


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None), (2, None, "en")], "doc_id int, text string, lang string")
    assert sorted(tuple(r) for r in langid.identify(docs).select("doc_id", "lang_pred", "score").collect()) == [(1, "und", 0.0), (2, "und", 0.0)]
    assert langid.identify(docs.limit(0)).count() == 0


def test_accepted(spark):
    rows = [(i, "the house of the sun and the sea by the hill", "en") for i in range(20)] + [(50, "1 2 3", "en"), (51, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    kept = langid.accepted(docs, 0.1)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(20))
