"""Record-table operators: golden rows, traps and invariants."""

import json
import random
import re
import uuid
from collections import defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from ledgerleaf.functions import helpers, scalars as S
from ledgerleaf.operators import evidence, identity, linking, load, quality, text
from ledgerleaf.plans import queries as own
from ledgerleaf.sources import tables as sources
from ledgerleaf.specs import SPECS, TableSpec


def one(spark, column, *values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.x for r in rows.select("i", column(F.col("c")).alias("x")).orderBy("i").collect()]


def test_normalize_for_match(spark):
    got = one(spark, S.normalize_for_match, "  Hello \t World\n", "emission-\nreduction", "emission-\r\nreduction", "A B", "", None)
    assert got == ["hello world", "emission reduction", "emission reduction", "a b", "", None]
    assert one(spark, S.normalize_for_match, "a- \nb", "a-\rb", "a-\n\r\n b", "a-b") == ["a- b", "a b", "a b", "a-b"]


def test_numbers(spark):
    assert one(spark, S.first_number, "1,471,000", "4%", "around 300 MW", "2,5", "-5", "abc", "3.75") == ["1471000", "4", "300", "25", "-5", "abc", "3.75"]
    assert [None if x is None else float(x) for x in one(spark, S.verified_decimal, "1,471,000", "2,5", "1,250", "none")] == [1471000.0, 2.5, 1250.0, None]
    assert one(spark, S.first_number, "0.125", "1.471", "3.141 t", "1.471.000", "1.471,5", "1,471.5", "12,5, then", "007") == ["0.125", "1.471", "3.141", "1471000", "1471.5", "1471.5", "125", "7"]
    assert one(spark, lambda c: S.first_number(c, True), "1,471,000", "0.5.7") == ["1471", "0.5"]
    got = one(spark, S.verified_decimal, "2,5.", "12,5, then", "1.234", "at 3.", "-1,250.75 t", None)
    assert [None if x is None else float(x) for x in got] == [2.5, 12.5, 1.234, 3.0, -1250.75, None]
    assert one(spark, S.verified_int, "5250", "5250 tCO2e", "-5", "abc") == [5250, 52502, -5, None]
    assert one(spark, S.year_int, "by 2030", "1850", "2019-05-01") == [2030, None, 2019]
    assert one(spark, S.year_to_date_text, "2030", "soon") == ["2030-01-01", "soon"]


def test_coercions(spark):
    assert [str(x) for x in one(spark, lambda c: S.coerce(c, "date"), "2023/05/01", "2023-05-01T10:00:00Z", "2030", "20230501", "", "abc")] == ["2023-05-01", "2023-05-01", "2030-01-01", "2023-05-01", "None", "None"]
    assert one(spark, lambda c: S.coerce(c, "int"), " 12 ", "1,000", "x", "") == [12, 1000, None, None]
    assert one(spark, lambda c: S.coerce(c, "int"), "5.7", "1_000", "5.0", "-7", "1e3") == [None, 1000, 5, -7, None]
    assert [str(x) for x in one(spark, lambda c: S.coerce(c, "date"), "12", "2023-05-01Z", "2023-02-30", "0000")] == ["None", "2023-05-01", "None", "None"]
    assert [str(x) for x in one(spark, lambda c: S.coerce(c, "date", F.lit(True)), "12", "12345")] == ["0012-01-01", "None"]
    assert [str(x) for x in one(spark, lambda c: S.coerce(c, "timestamp"), "2030", "2023/05/01T10:00:00+02:00", "2023-05-01", "12")] == ["2030-01-01 00:00:00", "2023-05-01 08:00:00", "2023-05-01 00:00:00", "None"]
    texts = ["2023-05-01T10:00:00Z", "2023-05-01 10:00:00.25-0530", "2023-10-29T02:30:00+01:00", "2023-05-01T10:00", "2023-05-01 10:00 Europe/Paris", "2023-05-01T25:00:00Z"]
    want = ["2023-05-01 10:00:00", "2023-05-01 15:30:00.250000", "2023-10-29 01:30:00", "2023-05-01 10:00:00", "None", "None"]
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert [str(x) for x in one(spark, lambda c: S.coerce(c, "timestamp"), *texts)] == want
    u = str(uuid.uuid4())
    assert one(spark, lambda c: S.coerce(c, "uuid"), "{" + u.upper() + "}", "urn:uuid:" + u, "bad") == [u, u, None]
    assert one(spark, S.is_placeholder_uuid, "00000000-0000-0000-0000-000000000001", u, None) == [True, False, False]


def test_uuid5_and_canonical_json(spark):
    space = S.class_namespace("City")
    assert one(spark, lambda c: S.uuid5(space, c), "a", "ü") == [str(uuid.uuid5(space, "a")), str(uuid.uuid5(space, "ü"))]
    raw = '{"b": 1.10, "a": "é", "misc": {"z": 1}}'
    assert one(spark, lambda c: helpers.canonical_json(c, ("misc",)), raw, "broken", None) == [json.dumps({"a": "é", "b": 1.1}, ensure_ascii=False), None, None]


def test_text_scalars(spark):
    assert one(spark, S.sanitize_markdown, "a\r\nb\\nc\n\n\n\nd") == ["a\nb\nc\n\nd"]
    assert one(spark, S.normalize_toc, "1.2 Title  \n\n\n\n- item", "2030", "1. 2024 Budget", "2020 35.2 40", "- 2030 target", " \t x\r\n\t\n \ny") == ["Title\n\nitem", "0", "2024 Budget", "35.2 40", "2030 target", "x\n\ny"]
    assert one(spark, S.split_sentences, "One. Two! Three? rest") == [["One.", "Two!", "Three?", "rest"]]


def test_quotes(spark):
    docs = spark.createDataFrame([("d", "The emission-\nreduction is 5,000,000 t."), ("e", " ")], "doc_id string, text string")
    cases = [("d", "emission reduction", True), ("d", "REDUCTION  is", True), ("d", "absent", False), ("d", " ", False), ("e", "x", False), ("f", "x", False), ("d", "5,000,000", True)]
    got = evidence.quotes_found(spark.createDataFrame([(d, q, w) for d, q, w in cases], "doc_id string, quote string, want boolean"), docs).collect()
    assert len(got) == len(cases) and all(r.found == r.want for r in got)


def test_verify_records(spark):
    docs = spark.createDataFrame([("d", "Target 2030 and value 5250 t")], "doc_id string, text string")
    rows = [(0, "2030", "Target 2030", 0.0), (1, "2030", "", 0.5), (2, "2030", "Target 2030", 1.5), (3, None, None, None), (4, None, "Target 2030", 1.0), (5, "none", "Target 2030", 0.5), (6, "2030", "not there", 0.5)]
    claims = spark.createDataFrame([("d", *r) for r in rows], "doc_id string, rec_idx int, y string, y_quote string, y_confidence double")
    good, bad = evidence.verify_records(claims, docs, {"y": "year"})
    assert {r.rec_idx: r.y for r in good.collect()} == {0: 2030, 3: None, 4: None}
    assert {r.rec_idx for r in bad.collect()} == {1, 2, 5, 6}


def test_chunks(spark):
    docs = spark.createDataFrame([(1, "# H\n\npara one here\n\na | b\n--- | ---\n1 | 2\n\npara two. And more! Is it? yes"), (2, None)], "doc_id long, text string")
    blocks = text.parse_blocks(docs).orderBy("block_no").collect()
    assert [b.kind for b in blocks] == ["paragraph", "paragraph", "table", "paragraph"] and blocks[2].heading_path == "H"
    chunks = text.chunk_documents(docs, 5).orderBy("chunk_index").collect()
    assert sum("1 | 2" in c.text for c in chunks) == 1 and sum("a | b\n--- | ---\n1 | 2" in c.text for c in chunks) == 1
    assert "And more!" in [c.text for c in chunks]
    with pytest.raises(ValueError):
        text.chunk_documents(docs, 5, 5)
    assert [(c.chunk_index, c.token_count, c.end_line) for c in text.route_and_chunk(docs.where("doc_id = 1"), 100, 200, 5).collect()] == [(0, 28, 9)]
    assert text.route_and_chunk(docs.where("doc_id = 1"), 100, 20, 5).count() == 0
    assert text.route_and_chunk(docs.where("doc_id = 1"), 10, 20, 5).count() == text.chunk_documents(docs, 5).count()
    assert {r.doc_id: r.route for r in text.size_gate(docs, 10, 5).collect()} == {1: "chunk", 2: "whole"}


def test_blocks():
    body = "## B\n# A\ntext\n| - |\n\n#no\n### C\n\n  # D  \n x | y\n:--- | ---:\n|1|2|\n a | b\n--- | ---\nrest\n\n - | -\n--- | ---\n\n# E | F\n---|---\n\nu | v\n---\n"
    got = [(b[0], b[2], b[3], b[4], b[5]) for b in text.blocks_of(body)]
    assert got == [
        ("paragraph", 1, 4, "B", None),
        ("paragraph", 6, 7, "B", None),
        ("paragraph", 9, 9, "D", None),
        ("table", 10, 14, "D", "x | y"),
        ("paragraph", 15, 15, "D", None),
        ("paragraph", 17, 18, "D", None),
        ("table", 20, 21, "E | F", "# E | F"),
        ("paragraph", 23, 24, "E | F", None),
    ]
    assert text.blocks_of(None) == [] and text.blocks_of(" \n\t\n") == []
    assert [b[4] for b in text.blocks_of("#### x\n\n## y\n\n### z\n\n# w")] == ["x", "x > y", "x > y > z", "w"]


def test_chunks_against_a_plain_version(spark):
    r = random.Random(4)
    docs = []
    for d in range(60):
        parts = []
        for _ in range(r.randrange(0, 12)):
            kind = r.randrange(4)
            words = lambda n: " ".join(r.choice(["a", "bb", "ccc."]) for _ in range(n))
            parts.append("# " + words(2) if kind == 0 else "h | k\n--- | ---\n" + "\n".join("1 | 2" for _ in range(r.randrange(4))) if kind == 1 else words(r.randrange(1, 40)))
        docs.append((d, "\n\n".join(parts)))
    count = lambda t: int(helpers.count_words(pd.Series([t])).iloc[0])
    for size, overlap in ((10, 0), (10, 4), (25, 24)):
        got = defaultdict(list)
        for c in sorted(text.chunk_documents(spark.createDataFrame(docs, "doc_id long, text string"), size, overlap).collect(), key=lambda c: (c.doc_id, c.chunk_index)):
            got[c.doc_id].append((c.text, c.token_count))
        for d, t in docs:
            pieces = []
            for b in text.blocks_of(t):
                pieces += [b[1]] if b[0] == "table" or count(b[1]) <= size else [x for x in re.split(r"(?<=[.!?])\s+", b[1]) if x]
            base = []
            for x in pieces:
                if base and sum(map(count, base[-1])) + count(x) <= size:
                    base[-1].append(x)
                else:
                    base.append([x])
            want = []
            for k, own in enumerate(base):
                lead = []
                while k and overlap and len(lead) < len(base[k - 1]) and sum(map(count, lead)) < overlap:
                    lead.insert(0, base[k - 1][-1 - len(lead)])
                joined = "\n\n".join([*lead, *own])
                want.append((joined, count(joined)))
            assert got[d] == want


def test_topo_sort(spark):
    rows = [(0, "a", None), (1, "c", "b"), (2, "b", "a"), (3, "x", "y"), (4, "y", "x"), (5, "m", "lost"), (6, "a", None), (7, None, "a")]
    got, missing = quality.topo_sort(spark.createDataFrame(rows, "rec_idx long, id string, parent string"), "id", "parent")
    assert {r.rec_idx: (r.level, r.is_extra) for r in got.collect()} == {0: (0, False), 2: (1, False), 1: (2, False), 3: (None, False), 4: (None, False), 5: (0, False), 6: (None, True), 7: (None, True)}
    assert [r.missing_parent for r in missing.collect()] == ["lost"]


def test_deep_trees_and_falsy_ids(spark):
    n = 3000
    chain = [(k, f"t{k}", f"t{k - 1}" if k else None) for k in range(n)]
    good, bad = load.enforce_constraints({"TefCategory": spark.createDataFrame([*chain[::-1], (n, "x", "y"), (n + 1, "y", "x")], "rec_idx long, tefId string, parentId string")})
    assert sorted(r.rec_idx for r in good["TefCategory"].collect()) == list(range(n)) and {r.rec_idx for r in bad.collect()} == {n, n + 1}
    rows = [(0, "", None), (1, "", None), (2, "a", ""), (3, "b", "a"), (4, None, "a"), (5, None, None)]
    got, missing = quality.topo_sort(spark.createDataFrame(rows, "rec_idx long, id string, parent string"), "id", "parent")
    assert {r.rec_idx: (r.level, r.is_extra) for r in got.collect()} == {0: (None, True), 1: (None, True), 2: (0, False), 3: (1, False), 4: (None, True), 5: (None, True)}
    assert missing.count() == 0 and len(got.collect()) == len(rows)


def test_city_scope_in_any_order(spark):
    c = spark.createDataFrame([("i1", "a"), ("i2", "b")], "indicatorId string, cityId string")
    v = spark.createDataFrame([("v1", "i1"), ("v2", "i2")], "indicatorValueId string, indicatorId string")
    w = spark.createDataFrame([("w1", "v1"), ("w2", "v2")], "id string, v string")
    chain = {"IndicatorValue": ("indicatorId", "Indicator"), "deep": ("v", "IndicatorValue"), "lost": ("x", "nowhere")}
    specs = SPECS | {"deep": TableSpec("deep", "id"), "lost": TableSpec("lost", "id")}
    got = load.filter_city({"deep": w, "IndicatorValue": v, "lost": w.withColumn("x", F.lit("y")), "Sector": w, "Indicator": c}, "a", specs=specs, chain=chain)
    assert {n: df.count() for n, df in got.items()} == {"deep": 1, "IndicatorValue": 1, "lost": 0, "Sector": 2, "Indicator": 1}


def test_quotes_of_a_document_given_twice(spark):
    docs = spark.createDataFrame([("d", "alpha beta"), ("d", "gamma")], "doc_id string, text string")
    got = evidence.quotes_found(spark.createDataFrame([("d", "alpha"), ("d", "gamma")], "doc_id string, quote string"), docs).collect()
    assert sorted((r.quote, r.found) for r in got) == [("alpha", True), ("gamma", False)]


def test_nested_evidence(spark):
    docs = spark.createDataFrame([("d", "It is 2,5. times")], "doc_id string, text string")
    rows = spark.createDataFrame([("d", 0, ("2,5.", "is 2,5.", 0.9)), ("d", 1, ("7", "not there", 0.9))], "doc_id string, rec_idx int, x struct<value:string,quote:string,confidence:double>")
    good, bad = evidence.verify_records(rows, docs, {"x": "decimal"})
    assert [(r.rec_idx, float(r.x)) for r in good.collect()] == [(0, 2.5)] and [r.rec_idx for r in bad.collect()] == [1]


def test_duplicates_skip_blank_keys(spark):
    rows = [(0, "a", 1), (1, "a", 1), (2, None, 1), (3, None, 1), (4, "", 1), (5, "", 1)]
    df = spark.createDataFrame(rows, "rec_idx long, k string, y int")
    assert [(r.key, r["rows"]) for r in quality.duplicate_groups({"t": df}, {"t": [("k", "y")]}).collect()] == [("a|1", [0, 1])]
    spec = {"t": TableSpec("t", "k", (), (("k", "y"),))}
    got = {r.check: (r.missing, r.groups, r["rows"]) for r in quality.key_quality({"t": df}, spec).collect()}
    assert got == {"pk": (2, 2, 4), "k,y": (2, 2, 4)}
    assert sum(r.is_repeat for r in quality.flag_repeats(df, ["k"]).collect()) == 1


def test_rewrite_and_cascade(spark):
    t = spark.createDataFrame([(0, "p", "s"), (1, "p", "s"), (2, "q", "u")], "rec_idx long, id string, seed string")
    new, ids = identity.rewrite_pk(t, "City", "id")
    assert new.select("id").distinct().count() == 3
    child = spark.createDataFrame([(0, "p"), (1, None), (2, "z")], "rec_idx long, cityId string")
    out, report = identity.cascade_fk({"CityBudget": child}, {"City": ids}, SPECS)
    last = {r.rec_idx: r.id for r in new.collect()}[1]
    assert {r.rec_idx: r.cityId for r in out["CityBudget"].collect()} == {0: last, 1: None, 2: "z"}
    assert report.first().changed == 1
    given = identity.assign_pk(t, "City", "id").collect()
    assert len({r.id for r in given}) == 3 and all(uuid.UUID(r.id) for r in given)


def test_validate_absent_is_not_null(spark):
    spec = SPECS["Sector"]
    u = str(uuid.uuid4())
    rows = [(0, json.dumps({"sectorId": u, "sectorName": "x"})), (1, json.dumps({"sector_id": u})), (2, json.dumps({"sectorId": "bad", "sectorName": None})), (3, json.dumps({"sectorId": u, "sectorName": "x", "more": 1}))]
    got = load.normalize_columns(spark.createDataFrame(rows, "rec_idx long, raw string"), spec)
    valid, errors = load.validate(got, spec)
    assert {(r.rec_idx, r.field, r.type) for r in errors.collect()} == {(1, "sectorName", "missing"), (2, "sectorId", "type"), (2, "sectorName", "null"), (3, "more", "extra")}
    assert [r.rec_idx for r in valid.collect()] == [0]
    assert {r.rec_idx for r in load.validate(got, spec, "permissive")[0].collect()} == {0, 3}


def test_enforce_constraints_drops_orphans(spark):
    city = spark.createDataFrame([(0, "a"), (1, "a"), (2, None)], "rec_idx long, cityId string")
    tef = spark.createDataFrame([(0, "r", None), (1, "k", "r"), (2, "l", "lost"), (3, "m", "l")], "rec_idx long, tefId string, parentId string")
    budget = spark.createDataFrame([(0, "x", "a"), (1, "y", "b"), (2, "z", None)], "rec_idx long, budgetId string, cityId string")
    good, bad = load.enforce_constraints({"City": city, "CityBudget": budget, "TefCategory": tef})
    assert {n: sorted(r.rec_idx for r in df.collect()) for n, df in good.items()} == {"City": [0], "CityBudget": [0, 2], "TefCategory": [0, 1]}
    assert bad.count() == 5


def test_selections(spark):
    records = spark.createDataFrame([("d", 0, i) for i in range(3)], "doc_id string, batch_no int, batch_idx int")
    answer = json.dumps({"results": [{"record_index": 0, "selections": [{"field": "f", "index": 2}]}, {"record_index": 1, "selections": [{"field": "f", "id": "own", "index": 1}]}, {"record_index": 9, "selections": []}]})
    options = spark.createDataFrame([("d", "f", 1, "one"), ("d", "f", 2, "two")], "doc_id string, field string, index int, id string")
    for text_ in (answer, json.dumps(json.loads(answer)["results"])):
        responses = spark.createDataFrame([("d", 0, text_)], "doc_id string, batch_no int, response string")
        assert {r.batch_idx: r.f for r in linking.apply_selections(records, responses, options, ["f"]).collect()} == {0: "two", 1: "own", 2: None}


def test_all_shapes_of_answers(spark):
    records = spark.createDataFrame([("d", 0, i) for i in range(3)], "doc_id string, batch_no int, batch_idx int")
    options = spark.createDataFrame([("d", "f", 1, "one"), ("d", "f", 2, "two")], "doc_id string, field string, index int, id string")
    pick = lambda **x: [{"field": "f", **x}]
    cases = [
        ({"batch_results": [{"record_index": 1, "selections": pick(index=2)}]}, {1: "two"}),
        ({"batch_results": {"record_index": 2, "selections": pick(id="x")}}, {2: "x"}),
        ({"batch_results": {"0": {"selections": pick(index="1")}, "2": {"record_index": 1, "selections": pick(id="y")}, "z": {"selections": pick(id="no")}}}, {0: "one", 1: "y"}),
        ({"selections": pick(id="z")}, {0: "z"}),
        ({"batch_results": [{"record_index": 0, "selections": [*pick(index=1), *pick(index=9)]}, {"record_index": 7, "selections": pick(id="out")}, {"record_index": -1, "selections": pick(id="out")}]}, {0: "one"}),
        ({"batch_results": [{"record_index": 0, "selections": [*pick(index=1), *pick(id=None)]}]}, {}),
        ({"batch_results": "none"}, {}),
    ]
    for body, want in cases:
        responses = spark.createDataFrame([("d", 0, json.dumps(body))], "doc_id string, batch_no int, response string")
        got = {r.batch_idx: r.f for r in linking.apply_selections(records, responses, options, ["f"]).collect()}
        assert got == {0: None, 1: None, 2: None} | want, body
    broken = spark.createDataFrame([("d", 0, "{"), ("d", 0, None)], "doc_id string, batch_no int, response string")
    assert all(r.f is None for r in linking.apply_selections(records, broken, options, ["f"]).collect())


def test_linking_loses_no_pair_by_common_tokens(spark):
    r = random.Random(3)
    word = lambda: r.choice(["a", "a", "b", "b", "c", "d", "e", "f", "g", "h"])
    left = [("d", k, " ".join(word() for _ in range(r.randrange(0, 7)))) for k in range(60)]
    right = [("d", f"o{k}", " ".join(word() for _ in range(r.randrange(1, 7)))) for k in range(60)]
    for least in (0.2, 0.6, 1.0):
        got = {x.rec_idx: x.linked_id for x in linking.link_fk(spark.createDataFrame(left, "doc_id string, rec_idx long, text string"), spark.createDataFrame(right, "doc_id string, id string, label string"), least).collect()}
        for _, k, t in left:
            a = set(t.split())
            scores = [(-len(a & b) / len(a | b), i) for _, i, x in right for b in [set(x.split())] if a & b and len(a & b) / len(a | b) >= least]
            assert got[k] == (min(scores)[1] if scores else None), (least, k)


def test_validate_json_types_and_stop(spark):
    spec = SPECS["Sector"]
    u = str(uuid.uuid4())
    rows = [(0, json.dumps({"sectorId": u, "sectorName": {"a": 1}})), (1, json.dumps({"sectorId": u, "sectorName": 5})), (2, "[1]"), (3, "{broken"), (4, json.dumps({"sectorId": u, "sectorName": "x", "misc": {"a": [1]}})), (5, None)]
    got = load.normalize_columns(spark.createDataFrame(rows, "rec_idx long, raw string"), spec)
    valid, errors = load.validate(got, spec)
    assert {(r.rec_idx, r.field, r.type) for r in errors.collect()} == {(0, "sectorName", "type"), (1, "sectorName", "type"), (2, None, "type"), (3, None, "type"), (5, None, "type")}
    assert [(r.rec_idx, r.misc) for r in valid.collect()] == [(4, '{"a":[1]}')]
    with pytest.raises(ValueError, match=r"Sector\[0\] sectorName: type"):
        load.validate(got, spec, on_error="stop")


def test_sources(spark, tmp_path):
    (tmp_path / "run").mkdir()
    (tmp_path / "run" / "City.json").write_text('[\n  {"a": 1},\n  {"b": null}\n]\n')
    (tmp_path / "run" / "Sector.json").write_text('{"a": 1}')
    got = sources.read_tables(spark, f"{tmp_path}/run", on_corrupt="empty")
    assert [(r.doc_id, r.rec_idx, json.loads(r.raw)) for r in got["City"].orderBy("rec_idx").collect()] == [("run", 0, {"a": 1}), ("run", 1, {"b": None})]
    assert got["Sector"].count() == 0 and got["Indicator"].count() == 0
    with pytest.raises(Exception, match="no JSON list"):
        sources.read_table(spark, f"{tmp_path}/run/Sector.json").collect()
    sources.write_tables({"City": got["City"]}, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/City").count() == 2
    many = spark.range(1000).withColumnRenamed("id", "rec_idx")
    sources.write_report({"counts": got["City"].select("rec_idx"), "none": many.limit(0)}, f"{tmp_path}/report", {"errors": (many.repartition(5), ["rec_idx"])}, 3)
    lines = {(r.part, r.total, r.position, r.row) for r in spark.read.schema("part string, total long, position int, row string").json(f"{tmp_path}/report").collect()}
    assert lines == {("counts", 2, None, '{"rec_idx":0}'), ("counts", 2, None, '{"rec_idx":1}'), ("none", 0, None, None)} | {("errors", 1000, k + 1, f'{{"rec_idx":{k}}}') for k in range(3)}
    (tmp_path / "run" / "doc.md").write_text("# a\nb\n")
    assert [(r.doc_id, r.text) for r in sources.read_documents(spark, f"{tmp_path}/run/*.md").collect()] == [("run", "# a\nb\n")]


def test_a_batch_counts_when_it_is_whole(spark, tmp_path):
    df = spark.createDataFrame([(0, "a"), (1, "b")], "rec_idx long, cityId string")
    for batch, rows in (("one", df), ("two", df.limit(1)), ("two", df.limit(1))):
        load.load_tables({"City": rows}, SPECS, f"{tmp_path}", batch=batch)
    df.write.parquet(f"{tmp_path}/City/batch=three")
    assert sorted(r.batch for r in load.read_loaded(spark, f"{tmp_path}", "City").collect()) == ["one", "one", "two"]
    assert quality.file_sizes(spark, {"City": f"{tmp_path}/City", "Sector": f"{tmp_path}/none"}).first().bytes > 0


def test_linking_never_links_to_itself(spark):
    rows = [("d", 0, "1", "solar roof"), ("d", 1, "2", "solar roof plan"), ("d", 2, "3", "other")]
    df = spark.createDataFrame(rows, "doc_id string, rec_idx long, id string, t string")
    assert {r.rec_idx: r.linked_id for r in linking.link_parent(df, "id", "t", "t").collect()} == {0: "2", 1: "1", 2: None}


def test_records_of_the_same_tokens_are_compared_once(spark, monkeypatch):
    r = random.Random(4)
    texts = ["solar roof plan", "solar roof", "plan roof", "other", "", None, "Roof, solar"]
    rows = [("d" if k % 3 else "e", k, str(100 - k) if k % 11 else None, r.choice(texts), r.choice(texts)) for k in range(90)]
    df = spark.createDataFrame(rows, "doc_id string, rec_idx long, id string, t string, l string")
    words = lambda t: set((t or "").lower().replace(",", "").split())
    jaccard, dice = lambda a, b: len(a & b) / len(a | b), lambda a, b: 2 * len(a & b) / (len(a) + len(b))
    sizes, inner = [], getattr(linking, "_best_of", None)
    monkeypatch.setattr(linking, "_best_of", lambda scored, own, opts: sizes.append((own.count(), opts.count())) or inner(scored, own, opts), raising=False)
    for like, more in ((jaccard, {}), (jaccard, {"min_score": 0.6}), (dice, {"scorer": lambda s, a, b: 2 * s / (a + b)})):
        got = {x.rec_idx: x.linked_id for x in linking.link_parent(df, "id", "t", "l", **more).collect()}
        for doc, k, own, t, _ in rows:
            found = [(-like(words(t), words(m)), i is not None, i or "") for d, _, i, _, m in rows if d == doc and i != own and words(t) & words(m) and like(words(t), words(m)) >= more.get("min_score", 0.2)]
            assert (got[k] or "") == (min(found)[2] if found else ""), (k, more)
    assert max(a for a, _ in sizes) <= 8 and max(b for _, b in sizes) <= 8  # four sets in two documents


@pytest.mark.parametrize("name", ["fk_issues", "duplicate_groups", "validate", "reconcile", "cascade_fk", "topo_sort", "prior_context"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    folder = "/root/testdata/sf0.001"
    for t in "region nation customer supplier part orders lineitem events documents benchmark conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = own.QUERIES[name](spark, folder)
    want = con.execute(own.ORACLE_SQL[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(df.columns)
    rows = sorted(map(str, (tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())))
    assert rows == sorted(map(str, want.fetchall()))


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_quotes_and_proofs_by_the_written_rules(spark):
    """A row a rule: (source, quote, whether it is there), and (value, quote, confidence, whether the record stands)."""
    sources_ = [
        ("cut by 40% until 2035", "40%", True),
        ("cut until 2035", "60%", False),
        ("Waste   Water\nPlants", "Waste Water Plants", True),
        ("The Base Year was 1990", "base year", True),
        ("All \t plants\n\nby 2031-06-30", "plants by 2031-06-30", True),
        ("district heat-\ning grid", "heat ing", True),
        ("some words", "", False),
        ("", "words", False),
        ("some words", " \n\t", False),
        (" \t\n", "words", False),
        ("It was 3.75 tonnes a head in 2018.", "3.75 tonnes", True),
        ("EUR 7,250,000 were spent", "7,250,000", True),
        ("number 4711", "123", False),
        ("our targets", "target", True),
        ("| year | flats |\n| 2030 | 1,800 |", "1,800", True),
        (None, "words", False),
        ("words", None, False),
    ]
    docs = spark.createDataFrame([(f"d{k}", s) for k, (s, _, _) in enumerate(sources_)], "doc_id string, text string")
    got = evidence.quotes_found(spark.createDataFrame([(f"d{k}", q) for k, (_, q, _) in enumerate(sources_)], "doc_id string, quote string"), docs)
    assert {r.doc_id: r.found for r in got.collect()} == {f"d{k}": w for k, (_, _, w) in enumerate(sources_)}
    proofs = [("2031", "in 2031", 0.9, True), (None, "in 2031", 0.9, True), ("2031", "", 0.9, False), ("2031", "  ", 0.9, False), ("2031", "in 2031", 1.2, False), ("2031", "in 2031", -0.2, False), (None, "in 2031", 0.0, True), ("2031", "in 2031", 1.0, True), ("2031", "in 2031", None, False), ("x", "in 2031", 0.5, False)]
    rows = spark.createDataFrame([("d", k, *p[:3]) for k, p in enumerate(proofs)], "doc_id string, rec_idx long, y string, y_quote string, y_confidence double")
    good, _ = evidence.verify_records(rows, spark.createDataFrame([("d", "Done in 2031.")], "doc_id string, text string"), {"y": "int"})
    assert {r.rec_idx for r in good.collect()} == {k for k, p in enumerate(proofs) if p[3]}
