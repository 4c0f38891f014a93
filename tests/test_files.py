"""Tables and documents as files: landing, differing headers, ordered publication, snapshots, linked payloads, promotion."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from curvelake.operators import checks, names, payloads, quotes
from curvelake.plans import landing
from curvelake.sources import readers, writers

FOLDER = "/root/testdata/sf0.001"


def test_landed_table_reads_only_the_wanted_folders(spark):
    rows = landing.landed(spark, FOLDER)
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "dynamicpruning" in plan
    assert {int(p.split("season=")[1][:4]) for p, in rows.select("_metadata.file_path").distinct().collect()} == {1998, 1999, 2000}
    rows.collect()
    scans = [n for n in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in n]
    assert any("dynamicpruningexpression" in n for n in scans)


def test_a_large_partition_is_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # such small parts would be joined again
    writers.write_partitioned(spark.range(1000).selectExpr("id", "if(id < 900, 'big', if(id < 999, 'small', null)) p"), path, "p", rows_per_file=100)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(path).select("p", "id", F.col("_metadata.file_name").alias("f")).groupBy("p").agg(F.count_distinct("f").alias("f"), F.count("*").alias("n")).collect()
    got = {r.p: (r.f, r.n) for r in files}
    assert got["small"] == (1, 99) and got[None] == (1, 1) and got["big"][1] == 900 and 2 <= got["big"][0] <= 9
    with pytest.raises(Exception, match="exists"):
        writers.write_partitioned(spark.range(1).selectExpr("id", "'x' p"), path, "p")


ACCEPTED = {"id": ("id", "key"), "name": ("display", "name")}


def test_headers_that_differ_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,more\n1,Ann,x\n2,,y\n")
    (tmp_path / "b.csv").write_text('﻿age,"name",key,display\n30,wrong,3,"Bo, Jr."\n')
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write("key,name\n4,Cy\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "_note").write_text("no data")
    found = readers.read_differing(spark, str(tmp_path), ACCEPTED, {"age": ("age",)})
    assert sorted(map(tuple, found.collect())) == [("1", "Ann", None), ("2", None, None), ("3", "Bo, Jr.", "30"), ("4", "Cy", None)]
    (tmp_path / "e.csv").write_text("id,title\n5,Di\n")
    with pytest.raises(ValueError, match="e.csv lacks name; accepted names: display, name"):
        readers.read_differing(spark, str(tmp_path), ACCEPTED, {})


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.csv").write_text(("id,name\n" if i % 2 else "name,id\n") + f"{i},{i}\n")
    groups = readers.headers_of(spark, readers.file_paths(spark, str(tmp_path)))
    assert {h: len(p) for h, p in groups.items()} == {("id", "name"): 3, ("name", "id"): 3}
    with pytest.raises(ValueError, match="no file with a header"):
        readers.read_differing(spark, str(tmp_path / "0.csv")[:-5] + "none", ACCEPTED, {}) if (tmp_path / "none").mkdir() is None else None


def test_ordered_files_do_not_overlap(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice("aab"), i, rng.random()) for i in rng.sample(range(10_000), 700)]
    path = str(tmp_path / "o")
    writers.write_ordered(spark.createDataFrame(rows, "k string, i long, v double").repartition(7), path, ["k", "i"], rows_per_file=64)
    found = sorted(writers.ordered_files(spark, path, ["k", "i"]).collect(), key=lambda r: r.file)
    want = sorted(rows)
    assert [r.file for r in found] == list(range(11)) and [r.rows for r in found] == [64] * 10 + [60] and {r.parts for r in found} == {1}
    assert [(tuple(r.first), tuple(r.last)) for r in found] == [(want[a][:2], want[min(a + 63, 699)][:2]) for a in range(0, 700, 64)]
    # Inside a file, rows lie in order.
    for n in (0, 5):
        part = spark.read.parquet(f"{path}/file={n}").coalesce(1).select("k", "i", "v").collect()
        assert [tuple(r) for r in part] == want[64 * n:64 * n + 64]
    writers.write_ordered(spark.createDataFrame([], "k string, i long"), str(tmp_path / "none"), ["k", "i"])


def test_documents_keep_their_file_and_their_faults(spark, tmp_path):
    good = {"metadata": {"season": "s", "snapshot_utc": "2024-01-01T00:00:00Z"}, "data_quality": {"checks_passed": True}, "markets": [{"market_id": "m", "market_line": 1.5}]}
    texts = {"good.json": json.dumps(good, indent=2), "cut.json": json.dumps(good)[:40], "list.json": json.dumps([good]), "empty.json": "", "number.json": "7",
             "bare.json": "{}", "odd.json": json.dumps(good | {"markets": [{"market_id": 5, "market_line": "x"}]})}
    for name, text in texts.items():
        (tmp_path / "source=s").mkdir(exist_ok=True)
        (tmp_path / "source=s" / name).write_text(text)
    rows = {r.file: r for r in readers.read_documents(spark, str(tmp_path), "book").collect()}
    assert {f.removeprefix("source=s/") for f, r in rows.items() if r._corrupt_record is None} >= {"good.json", "bare.json"}
    assert {f.removeprefix("source=s/") for f, r in rows.items() if r._corrupt_record is not None} >= {"cut.json", "list.json", "number.json", "empty.json"} and len(rows) == len(texts)
    assert rows["source=s/good.json"].markets[0].market_line == 1.5 and rows["source=s/bare.json"].metadata is None and rows["source=s/cut.json"].markets is None


def test_an_archive_gives_the_documents_of_its_files(spark, tmp_path):
    good = {"metadata": {"season": "s"}, "markets": [{"market_id": "m", "market_line": 1.5}]}
    texts = {"good": json.dumps(good, indent=2), "cut": json.dumps(good)[:40], "list": json.dumps([good]), "empty": "", "number": "7", "bare": " {}", "quoted": '{"a": "\\u2028 \\" \r\n'}
    (tmp_path / "files").mkdir()
    for name, text in texts.items():
        (tmp_path / "files" / name).write_bytes(text.encode())
    writers.write_archive(spark.createDataFrame(list(texts.items()), "file string, value string").repartition(2), str(tmp_path / "archive"))
    one, other = readers.read_documents(spark, str(tmp_path / "files"), "book"), readers.read_archive(spark, str(tmp_path / "archive"), "book")
    assert one.columns == other.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())) and one.count() == len(texts)


def test_snapshot_documents_fill_few_files(spark, tmp_path, monkeypatch):
    events = spark.range(4000).selectExpr("id event_id", "timestamp'2024-01-30' + make_interval(0, 0, 0, 0, 0, 0, id) ts", "id user_id",
                                          "element_at(array('click', 'view', 'purchase'), cast(id % 3 + 1 as int)) event_type", "cast(id % 90 as double) value", "'{\"k\": 4}' props")
    events.write.parquet(str(tmp_path / "in" / "events.parquet"))
    monkeypatch.setattr(landing, "shared_folder", lambda _, name: str(tmp_path / name))
    found = landing.snapshot_files(spark, str(tmp_path / "in"))
    files = readers.file_paths(spark, str(tmp_path / "snapshots-book"))
    assert found.filter("name like '%.season' and name not like '%market%'").count() == 45 and 0 < len(files) <= 4  # three of 48 documents are cut off


def test_snapshot_checks_tell_sources_and_files_apart(spark, tmp_path):
    side = lambda line: {"selection_id": "s", "label": f"Over {line}", "american_odds": -120}
    market = lambda i, line=20.5, **kw: {"market_id": i, "season": "s", "stat": "t", "market_line": line, "threshold_operators": {"over": ">", "under": "<"},
                                         "probability": {"over": side(line), "under": side(line)}} | kw
    document = lambda *m, **kw: {"metadata": {"season": "s", "snapshot_utc": "2024-01-01T00:00:00Z"}, "data_quality": {"checks_passed": True}, "markets": list(m)} | kw
    files = {"a": {"1": document(market("x"), market("y")), "2": document(market("z"))}, "b": {"1": document(market("x"), market("x"), market("", 7.5, stat="u")), "2": None}}
    for source, own in files.items():
        (tmp_path / f"source={source}").mkdir()
        for name, d in own.items():
            (tmp_path / f"source={source}" / name).write_text("{" if d is None else json.dumps(d))
    rules = quotes.PricingRules()
    table = quotes.snapshot_checks(readers.read_documents(spark, str(tmp_path), "book"), "book", "s", F.lit("2024-01-01T01:00:00Z").cast("timestamp"), ["t"], rules).collect()
    failed = {(r.name, tuple(sorted(r.details.items()))) for r in table if not r.passed}
    assert failed == {("collections.b.readable", (("documents", "2"), ("sample", "source=b/2"), ("unreadable", "1"))), ("collections.b.market.stat", (("markets", "1"),)),
                      ("collections.b.unique_market_ids", (("duplicate_keys", "2"), ("duplicate_rows", "3"), ("sample", ", x")))}
    assert sum(r.name == "collections.a.schema" for r in table) == 2


def test_links_end_where_they_break(spark):
    document = {"tabs": {"t": {"title": "T", "cards": [{"id": c} for c in ("a", "b", "lost")]}, "u": {"title": "U", "cards": [{"id": "a"}]}},
                "cards": {"a": {"title": "A", "coupons": [{"id": str(i)} for i in range(1, 9)]}, "b": {"title": "B", "coupons": []}, "c": {"title": "C"}},
                "coupons": {str(i): {"marketId": m, "hasAttachments": h} for i, (m, h) in enumerate(
                    [("m1", True), ("", False), ("", True), ("gone", True), ("m2", True), ("m3", True), ("m4", True)], 1)},
                "markets": {"m1": {"eventId": "e", "competitionId": "c", "runners": 2}, "m2": {"eventId": "none", "competitionId": "c", "runners": 2},
                            "m3": {"eventId": "e", "competitionId": None, "runners": 2}, "m4": {"eventId": "e", "competitionId": "c", "runners": 0}, "m5": {"eventId": "e"}},
                "events": {"e": {"name": "E"}, "f": {"name": "F"}}, "competitions": {"c": {"name": "C"}}}
    rows = spark.createDataFrame([(1, json.dumps(document)), (2, json.dumps({"tabs": {}}))], "document int, value string")
    table = rows.select("document", F.from_json("value", payloads.PAYLOAD).alias("p")).select("document", "p.*")
    chain = [(r.card_id, r.coupon_id, r.status) for r in payloads.link_chain(table, "document", "T").collect()]
    assert sorted(chain, key=str) == sorted([("a", "1", "linked"), ("a", "2", "coupon_placeholder_has_no_attached_market"), ("a", "3", "referenced_market_missing_from_attachments"),
                                             ("a", "4", "referenced_market_missing_from_attachments"), ("a", "5", "referenced_event_missing"), ("a", "6", "referenced_competition_missing"),
                                             ("a", "7", "attached_market_has_no_offered_runners"), ("a", "8", "missing_coupon"), ("lost", None, "missing_card")], key=str)
    one, two = sorted(payloads.link_counters(table, "document", "T").collect())
    assert (one.links, one.linked, one.orphan_cards, one.orphan_markets, one.orphan_events, one.checks_passed) == (9, 1, 2, 1, 1, False)
    assert (two.links, two.checks_passed) == (0, False)


def test_counters_of_a_clean_snapshot(spark):
    runners = spark.createDataFrame([("m", "1", "Over", 2.5, -110, 1 + 100 / 110), ("m", "2", "Under", 2.5, 105, 2.05)],
                                    "market_id string, selection_id string, outcome string, line double, american_odds int, decimal_odds double")
    assert payloads.runner_counters(runners).collect()[0].checks_passed
    late = payloads.runner_counters(runners.withColumn("decimal_odds", F.col("decimal_odds") + 0.001)).collect()[0]
    assert late.decimal_american_mismatches == 2 and not late.checks_passed
    markets = spark.createDataFrame([("a", 50.0), ("b", None)], "ticker string, estimate double")
    books = spark.createDataFrame([("a", 0.4, 0.6), ("b", None, 0.2)], "ticker string, bid double, ask double")
    found = payloads.contract_counters(markets, books).collect()[0]
    assert (found.two_sided, found.one_sided, found.checks_passed) == (1, 1, True)
    known, unknown = payloads.infer_series(spark.createDataFrame([("A",), ("B",), (None,)], "series_ticker string"), {"A": ("s", "u")})
    assert [tuple(r) for r in known.collect()] == [("A", "s", "u")] and unknown.count() == 2


def test_promotion_is_repeatable(spark):
    aliases = spark.createDataFrame([("s", "Ann Lee", "1", "Ann", ""), ("*", "Bo", "2", "Bo", "")], "source string, raw_player_name string, canonical_player_id string, canonical_player_name string, notes string")
    asked = [("s", "ann lee", "1", "Ann", "approved"), ("s", "ANN-LEE", "9", "Else", "approved"), ("s", "New One", "3", "New", "approved_alias"), ("s", "new one", "3", "New", "Approved"),
             ("s", "New  One!", "4", "Other", "approved"), ("s", "Gap", None, "x", "approved"), ("z", "Who", "5", "Who", "approved"), ("s", "Wait", "6", "Wait", "needs_review")]
    reviewed = spark.createDataFrame(asked, "source string, raw_player_name string, candidate_canonical_player_id string, candidate_canonical_player_name string, review_status string")
    first = names.alias_actions(reviewed, aliases, ["s"])
    got = {(r.raw_player_name, r.action) for r in first.collect()}
    assert got == {("ann lee", "present"), ("ANN-LEE", "conflict"), ("New  One!", "append"), ("New One", "conflict"), ("new one", "conflict"), ("Gap", "incomplete"), ("Who", "incomplete"), ("Bo", "kept")}
    grown = names.appended(aliases, first)
    second = names.alias_actions(reviewed, grown, ["s"])
    assert grown.count() == 3 and {(r.raw_player_name, r.action) for r in second.collect()} == {(n, "present" if a == "append" else a) for n, a in got}
    assert names.appended(grown, second).count() == 3


def test_records_differ_by_any_field(spark):
    rows = [(1, "a", None), (1, "a", None), (2, "a", None), (2, None, "a"), (3, "x", "y"), (3, "y", "x"), (4, "q", "r")]
    table = spark.createDataFrame(rows, "id int, a string, b string")
    assert sorted(map(tuple, quotes.conflicting_records(table, "id").collect())) == [(2, 2), (3, 2)]
    assert "to_json" not in quotes.conflicting_records(table, "id")._jdf.queryExecution().toString()


def test_published_report_and_typed_fields(spark, tmp_path):
    table = checks.check_table(spark.range(1), [checks.Check("n", F.col("id") > 0, "m", details={"rows": F.col("id")})])
    writers.write_checks(table, str(tmp_path / "r"))
    back = spark.read.schema(table.schema).json(str(tmp_path / "r")).collect()
    assert back == table.collect() and back[0].details == {"rows": "0"}
