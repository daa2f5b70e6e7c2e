"""Rows of several documents, names that clash, keys to a fixpoint, the store, links settled: against plain versions."""

import random
import uuid
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from ledgerleaf import frames
from ledgerleaf.functions import helpers, scalars
from ledgerleaf.operators import evidence, identity, linking, load, quality, text
from ledgerleaf.sources import store as store_module
from ledgerleaf.sources.store import Conflict, Store
from ledgerleaf.specs import Fk, SPECS, TableSpec


def two(spark):
    rows = [("d1", 0, "a", 1), ("d2", 0, "a", 1), ("d2", 1, "b", 1), ("d1", 1, "c", 2), ("d2", 2, None, 1), ("d3", 0, "a", 9)]
    return spark.createDataFrame(rows, "doc_id string, rec_idx long, k string, y int")


def places(df):
    return sorted((r.doc_id, r.rec_idx) for r in df.collect())


def test_rows_are_known_by_document_and_number(spark):
    df = two(spark)
    got = {(r.doc_id, r.rec_idx): (r.first_doc_id, r.first, r.is_repeat) for r in quality.flag_repeats(df, ["k"]).collect()}
    assert got[("d2", 0)] == ("d1", 0, True) and got[("d3", 0)] == ("d1", 0, True) and got[("d1", 0)] == ("d1", 0, False) and got[("d2", 2)] == (None, None, False)
    kept, gone = identity.dedupe_records(df, None, "k")
    assert places(gone) == [("d2", 0), ("d3", 0)] and len(places(kept)) == 4
    group = quality.duplicate_groups({"t": df}, {"t": [("k", "y")], "none": [("x",)]}).collect()
    assert [(g.key, g.first_doc_id, g.first, g.doc_ids, g["rows"]) for g in group] == [("a|1", "d1", 0, ["d1", "d2"], [0, 0])]
    spec = {"p": TableSpec("p", "id"), "t": TableSpec("t", "y", (Fk("k", "p"),))}
    issues = quality.fk_issues({"p": spark.createDataFrame([("a",)], "id string"), "t": df}, spec)
    assert sorted((r.doc_id, r.rec_idx, r.kind) for r in issues.collect()) == [("d1", 1, "not_found"), ("d2", 1, "not_found"), ("d2", 2, "missing")]
    feedback = {(r.doc_id, r.rec_idx): r.messages for r in linking.retry_feedback(issues, quality.duplicate_groups({"t": df}, {"t": [("k", "y")]}), spec, {}).collect()}
    assert len(feedback) == 5 and len(feedback[("d1", 0)]) == len(feedback[("d2", 0)]) == 1
    said = linking.summarise(df, ["k"], spark.createDataFrame([("d2", 0, "no")], "doc_id string, rec_idx long, feedback string"))
    assert {(r.doc_id, r.rec_idx) for r in said.where("summary LIKE '%no%'").collect()} == {("d2", 0)}
    errors = spark.createDataFrame([("t", "d1", 0), ("t", "d2", 0), ("t", "d2", 0)], "table string, doc_id string, rec_idx long")
    report = load.load_report(spark.createDataFrame([("t", 5)], "table string, loaded long"), errors).first()
    assert (report.failed, report.failed_rows) == (3, 2)
    raw = spark.createDataFrame([("d1", 0, "{}"), ("d2", 0, "[]")], "doc_id string, rec_idx long, raw string")
    found = load.validate(load.normalize_columns(raw, SPECS["Sector"]), SPECS["Sector"])[1]
    assert {(r.doc_id, r.field) for r in found.collect()} == {("d1", "sectorId"), ("d1", "sectorName"), ("d2", None)}


def test_names_never_clash(spark):
    odd = ["_id", "_first", "_again", "_bad", "_k", "_text", "_city", "_at", "_seed", "first", "a.b", "key", "again", "no", "new", "at", "row", "value", "n", "level_", "id", "k0", "rank"]
    base = two(spark)
    df = base.select("*", *[F.lit(n).alias(n) for n in odd])
    city = spark.createDataFrame([("d1", "c1")], "doc_id string, cityId string")
    u = [str(uuid.UUID(int=k + (1 << 120))) for k in range(3)]
    store = spark.createDataFrame([(u[0],)], "pk string")
    keyed = df.withColumn("pk", F.when(F.col("k") == "a", u[0]).otherwise(F.lit(u[1]))).withColumn("seed", F.col("k")).withColumn("cityId", F.lit("x"))
    outs = {
        "repeats": quality.flag_repeats(df, ["k", "a.b"]),
        "dedupe": identity.dedupe_records(df, df.limit(0), "a.b")[0],
        "assign": identity.assign_pk(keyed, "t", "pk", existing=store),
        "rewrite": identity.rewrite_pk(keyed, "t", "pk", "a.b")[0],
        "topo": quality.topo_sort(df, "k", "a.b")[0],
        "quotes": evidence.quotes_found(df.withColumn("quote", F.lit("q")), spark.createDataFrame([("d1", "a q b")], "doc_id string, text string")),
        "city": linking.apply_city(keyed, city),
        "batches": linking.make_batches(df, 2),
        "cascade": identity.cascade_fk({"CityBudget": keyed}, {"City": spark.createDataFrame([("x", "y")], "old_id string, new_id string")})[0]["CityBudget"],
        "constraints": load.enforce_constraints({"t": keyed}, {"t": TableSpec("t", "pk", (), (("a.b", "k"),))})[0]["t"],
    }
    want = {"repeats": 6, "dedupe": 1, "assign": 6, "rewrite": 6, "topo": 6, "quotes": 6, "city": 6, "batches": 6, "cascade": 6, "constraints": 2}
    for name, out in outs.items():
        rows = out.collect()
        assert len(rows) == want[name], name
        own = [n for n in odd if n != "first" or name != "repeats"]
        assert all(r[n] == n for r in rows for n in own), name
    assert quality.duplicate_groups({"t": df}, {"t": [("a.b",)]}).count() == 1 and quality.key_quality({"t": df}, {"t": TableSpec("t", "a.b")}).first().groups == 1


def test_no_tables(spark):
    for out in (quality.duplicate_groups({}, {}), quality.key_quality({}), quality.fk_presence({}), quality.sample_rows({}), linking.city_mismatch({}, None), quality.fk_issues({})):
        assert out.collect() == []
    none = spark.createDataFrame([], "signature string, seq long, item string")
    assert linking.merge_items(none, none).collect() == []


@pytest.mark.parametrize("hot", [1_000_000, 3])
def test_numbers_of_hot_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(frames, "HOT_ROWS", hot)
    r = random.Random(1)
    rows = [(r.choice("aab") if k % 7 else None, f"d{r.randrange(3)}", k) for k in range(300)]
    got = frames.numbered(spark.createDataFrame(rows, "by string, doc_id string, rec_idx long").repartition(7), "by", "no").collect()
    for key in ("a", "b", None):
        own = sorted((x.doc_id, x.rec_idx, x.no) for x in got if x.by == key)
        assert [x[2] for x in own] == list(range(1, len(own) + 1))


def plain_keys(rows, table, existing):
    used, out = set(existing), {}
    for at, pk, seed in sorted(rows):
        bad = True
        try:
            bad = str(pk).startswith("00000000-0000-0000-0000-") or not uuid.UUID(pk) or pk in used
        except (ValueError, AttributeError, TypeError):
            pass
        if bad:
            k, pk = 1, None
            while pk is None or pk in used:
                pk = str(uuid.uuid5(uuid.uuid5(uuid.UUID(int=0), table), (seed if k == 1 else f"{seed}|{k}") + "id"))
                k += 1
        used.add(pk)
        out[at] = pk
    return out


def test_keys_until_none_clashes(spark):
    r = random.Random(4)
    space = uuid.uuid5(uuid.UUID(int=0), "t")
    key = lambda s, k: str(uuid.uuid5(space, (s if k == 1 else f"{s}|{k}") + "id"))
    existing = [key("s0", 1), key("s0", 3), key("s1", 2), key("s3", 1), key("s3", 2), key("s3", 3)]
    rows = [((f"d{r.randrange(3)}", k), r.choice([None, "bad", "none"]), f"s{r.randrange(5)}") for k in range(60)]
    rows += [(("d9", k), x, "other") for k, x in enumerate(existing)]
    df = spark.createDataFrame([(d, k, p, s) for (d, k), p, s in rows], "doc_id string, rec_idx long, id string, seed string")
    stored = spark.createDataFrame([(x,) for x in existing], "id string")
    got = {(x.doc_id, x.rec_idx): x.id for x in identity.assign_pk(df, "t", "id", existing=stored).collect()}
    assert got == plain_keys(rows, "t", existing) and len(set(got.values()) | set(existing)) == len(rows) + len(existing)
    again = spark.createDataFrame([(d, k, i, "s0") for (d, k), i in got.items()], "doc_id string, rec_idx long, id string, seed string")
    assert {(x.doc_id, x.rec_idx): x.id for x in identity.assign_pk(again, "t", "id").collect()} == got
    new, ids = identity.rewrite_pk(again.union(spark.createDataFrame([("e", 0, got[("d9", 0)], "s0")], again.schema)), "t", "id")
    first = {(x.doc_id, x.rec_idx): x.id for x in new.collect()}
    assert len(set(first.values())) == 67 and not set(first.values()) & set(got.values())
    second, ids = identity.rewrite_pk(new, "t", "id")
    assert {(x.doc_id, x.rec_idx): x.id for x in second.collect()} == first and ids.count() == 0


def walk(rows):
    """Breadth first, as a queue does it."""
    seen, good, extra = set(), [], []
    for at, i, up in sorted(rows):
        (extra if not i or i in seen else good).append((at, i, up))
        seen.add(i)
    ids, below, queue, order = {i for _, i, _ in good}, {}, deque(), []
    for at, i, up in good:
        if up and up in ids:
            below.setdefault(up, []).append((at, i))
        else:
            queue.append((at, i))
    while queue:
        at, i = queue.popleft()
        order.append(at)
        queue.extend(below.get(i, ()))
    done = set(order)
    return order + [at for at, _, _ in good if at not in done] + [at for at, _, _ in extra]


@pytest.mark.parametrize("hot", [1, 1_000_000])
def test_tried_keys_are_not_saved(spark, monkeypatch, hot):
    """Seeds of several rows miss keys in several rounds; only keys that are taken are ever written, not each row's."""
    rng, space, kept = random.Random(9), scalars.class_namespace("t"), []
    key = lambda s, n: str(uuid.uuid5(space, (s if n == 1 else f"{s}|{n}") + "id"))
    rows = [(rng.randrange(3), k, None, None if k % 11 == 0 else f"s{rng.randrange(12)}") for k in range(120)]
    taken = {key(f"s{s}", n) for s in range(6) for n in range(1, 40) if rng.random() < 0.6}
    stored = spark.createDataFrame([(k,) for k in sorted(taken)], "id string")

    def keep(df, name, *more, old=frames.save):
        out = old(df, name, *more)
        kept.append((out, [c for c, t in out.dtypes if t == "string"]))
        return out

    monkeypatch.setattr(frames, "HOT_ROWS", hot)
    monkeypatch.setattr(identity, "save", keep)
    got = {r.rec_idx: r.id for r in identity.assign_pk(spark.createDataFrame(rows, "doc_id int, rec_idx long, id string, seed string"), "t", "id", existing=stored).collect()}
    want, next_ = {}, Counter()
    for _, k, _, s in sorted(rows, key=lambda r: r[:2]):
        while s:
            next_[s] += 1
            if (new := key(s, next_[s])) not in taken:
                break
        want[k] = new if s else None
    assert got == want
    written = [r[c] for df, names in kept for r in df.collect() for c in names if r[c] and len(r[c]) == 36]
    assert written and set(written) <= taken and len(written) == len(set(written))


def test_order_of_a_breadth_first_walk(spark):
    r = random.Random(9)
    for n in (1, 40, 200):
        rows = [((f"d{r.randrange(2)}", k), r.choice([f"n{r.randrange(n)}", f"n{k}", None, ""]), r.choice([None, "", "lost", *[f"n{r.randrange(n)}"] * 6])) for k in range(n)]
        df = spark.createDataFrame([(d, k, i, u) for (d, k), i, u in rows], "doc_id string, rec_idx long, id string, up string")
        got = quality.topo_sort(df.repartition(5), "id", "up")[0].orderBy("order").collect()
        assert [x.order for x in got] == list(range(n)) and [(x.doc_id, x.rec_idx) for x in got] == walk(rows)
    assert quality.topo_sort(df.limit(0), "id", "up")[0].count() == 0


def test_chains_are_not_sorted_each_round(spark, monkeypatch):
    """Rows of several ranges: chains through all of them, branches below chains, rings inside a range and across."""
    r, old, sorts = random.Random(4), quality._in_order, []
    monkeypatch.setattr(quality, "_in_order", lambda *a: sorts.append(1) or old(*a))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # ranges stay apart
    try:
        for branches, n in ((0, 300), (3, 300)):
            ups = [k - 1 if k % 100 else None for k in range(n)]
            ups = [r.randrange(n) if branches and r.random() < 0.3 else u for u in ups]
            place = list(range(n))
            r.shuffle(place)  # of each row: chains lead through all ranges
            ups += [n + 1, n, n + 3, n + 4, n + 2, n + 4]
            place += range(n, n + 6)
            rows = [(("d", place[k]), f"n{k}", None if u is None else f"n{u}") for k, u in enumerate(ups)]
            df = spark.createDataFrame([(d, k, i, u) for (d, k), i, u in rows], "doc_id string, rec_idx long, id string, up string")
            sorts.clear()
            got = quality.topo_sort(df, "id", "up")[0].orderBy("order").collect()
            assert [(x.doc_id, x.rec_idx) for x in got] == walk(rows)
            up = {i: u for _, i, u in rows}
            for x in got:
                i, level = x.id, 0
                while up[i] is not None and level <= n:
                    i, level = up[i], level + 1
                assert (x.level, x.root) == ((None, None) if level > n else (level, i))
            assert branches or len(sorts) == 2  # the numbering of rows and the result
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_feedback_takes_one_shuffle(spark):
    """Rows meet by their key once, messages by their record once; lists aren't built before they are shuffled."""
    steps = lambda df: df._jdf.queryExecution().executedPlan().toString()
    df, rule = two(spark), {"t": [("k", "y")]}
    assert steps(quality.duplicate_groups({"t": df}, rule, None)).count("Exchange hashpartitioning") == 1
    spec = {"t": TableSpec("t", "id", (Fk("a", "p"), Fk("b", "p")))}
    issues = spark.createDataFrame([("t", "d1", 1, f, m) for f, m in (("b", "no"), ("a", "lost"), ("a", None))], "table string, doc_id string, rec_idx long, field string, message string")
    groups = spark.createDataFrame([("t", k, v, "d1", n, [n, 1], ["d1", "d1"]) for k, v, n in (("y,z", ["1", "2"], 0), ("x", ["3"], 0), ("w", ["4"], -1))], "table string, key_fields string, values array<string>, first_doc_id string, first long, rows array<long>, doc_ids array<string>")
    got = linking.retry_feedback(issues, groups, spec, {})
    assert steps(got).count("Exchange hashpartitioning") == 1 and "ObjectHashAggregate" not in steps(got)
    said = {r.rec_idx: r for r in got.collect()}
    keys = [linking.REPEATED % x for x in (("w", "w=4"), ("x", "x=3"), ("y, z", "y=1, z=2"))]
    assert said[1].messages == [None, "a: lost", "b: no", *keys] and said[1].text == " ".join(["a: lost", "b: no", *keys])
    assert said[0].messages == keys[1:] and said[-1].messages == keys[:1] and len(said) == 3


def insert(rows, keys, parents):
    """Rows one by one, as a database takes them."""
    held, inside = [set() for _ in keys], []
    for row in sorted(rows, key=lambda x: (x["doc_id"], x["rec_idx"])):
        values = [None if any(row[c] is None for c in k) else tuple(row[c] for c in k) for k in keys]
        if row["id"] is None or row["up"] is not None and row["up"] not in parents or any(v is not None and v in h for v, h in zip(values, held)):
            continue
        for v, h in zip(values, held):
            h.add(v)
        inside.append((row["doc_id"], row["rec_idx"]))
    return sorted(inside)


SPEC = {"p": TableSpec("p", "id"), "t": TableSpec("t", "id", (Fk("up", "p"),), (("x", "y"), ("z",)))}


def made_rows(r, n, start=0):
    pick = lambda *v: r.choice(v)
    return [dict(doc_id=f"d{r.randrange(3)}", rec_idx=k + start, id=pick(None, *[f"i{j}" for j in range(n)]), up=pick(None, "p0", "p1", "p2", "lost"), x=pick(None, 1, 2, 3), y=pick(1, 2, 3, 4), z=pick(None, *range(n))) for k in range(n)]


KIND = "doc_id string, rec_idx long, id string, up string, x long, y long, z long"
PARENTS = [("d0", k, f"p{k}") for k in range(3)]


@pytest.mark.parametrize("seed", range(3))
def test_constraints_as_rows_are_inserted(spark, seed):
    rows = made_rows(random.Random(seed), 40)
    t = spark.createDataFrame([tuple(x.values()) for x in rows], KIND)
    p = spark.createDataFrame(PARENTS, "doc_id string, rec_idx long, id string")
    good, bad = load.enforce_constraints({"p": p, "t": t}, SPEC)
    want = insert(rows, [("id",), ("x", "y"), ("z",)], {"p0", "p1", "p2"})
    assert places(good["t"]) == want and places(bad) == sorted({(x["doc_id"], x["rec_idx"]) for x in rows} - set(want))


def test_batches_meet_what_the_store_holds(spark, tmp_path):
    r, folder = random.Random(7), f"file://{tmp_path}/store"
    store, rows, want = Store(spark, folder, SPEC, buckets=2), [], None
    p = spark.createDataFrame(PARENTS, "doc_id string, rec_idx long, id string")
    for k in range(3):
        own = made_rows(r, 25, 100 * k)
        for x in own:
            x["doc_id"] = f"b{k}"
        rows += own
        tables = {"t": spark.createDataFrame([tuple(x.values()) for x in own], KIND)} | ({"p": p} if k == 0 else {})
        version, bad = load.load_batch(store, f"batch{k}", tables)
        want = insert(rows, [("id",), ("x", "y"), ("z",)], {"p0", "p1", "p2"})  # one run over all of them so far
        assert version == k + 1 and places(store.read("t")) == want
        assert places(bad) == sorted({(x["doc_id"], x["rec_idx"]) for x in own} - set(want))
    assert load.load_batch(store, "batch2", tables)[0] == 4 and places(store.read("t")) == want  # repeated: its own rows don't stand in its way
    assert len(places(store.read("t", 2))) < len(want) and store.batches() == ["batch0", "batch1", "batch2"]
    store.clean()
    assert places(store.read("t")) == want and places(Store(spark, folder, SPEC).read("p")) == [("d0", 0), ("d0", 1), ("d0", 2)]


def test_a_failing_repeat_leaves_the_old_rows(spark, tmp_path):
    folder = f"file://{tmp_path}/store"
    df = spark.createDataFrame([("d", 0, "a"), ("d", 1, "b")], "doc_id string, rec_idx long, cityId string")
    load.load_tables({"City": df}, SPECS, folder, batch="one")
    broken = df.withColumn("cityId", F.when(F.col("rec_idx") == 0, F.col("cityId")).otherwise(F.raise_error(F.lit("gone")).cast("string")))
    with pytest.raises(Exception, match="gone"):
        load.load_tables({"City": broken}, SPECS, folder, batch="one")
    assert places(load.read_loaded(spark, folder, "City")) == [("d", 0), ("d", 1)]
    with pytest.raises(ValueError, match="holds no rows"):
        load.read_loaded(spark, folder, "Sector")


def test_two_writers(spark, tmp_path):
    one, two_ = (Store(spark, f"file://{tmp_path}/store") for _ in range(2))
    city = lambda *ids: spark.createDataFrame([("d", k, i) for k, i in enumerate(ids)], "doc_id string, rec_idx long, cityId string")
    sector = spark.createDataFrame([("d", 0, "s")], "doc_id string, rec_idx long, sectorId string")
    seen = (one.version(), two_.version())
    a, b, c = one.write("a", {"City": city("x")}), two_.write("b", {"City": city("x", "y")}), two_.write("c", {"Sector": sector})
    assert one.commit("a", a, seen[0]) == 1
    assert two_.commit("c", c, seen[1]) == 2  # another table: the next name is tried
    with pytest.raises(Conflict):
        two_.commit("b", b, seen[1])
    version, bad = load.load_batch(two_, "b", {"City": city("x", "y")})
    assert version == 3 and [r.reason for r in bad.collect()] == ["duplicate primary key"] and sorted(r.cityId for r in one.read("City").collect()) == ["x", "y"]
    assert not one._publish(3, [], [])  # the name is taken


def test_all_or_nothing(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", buckets=2)
    city = spark.createDataFrame([("d", k, i) for k, i in enumerate(["x", "y", "z"])], "doc_id string, rec_idx long, cityId string")
    stats = spark.createDataFrame([("d", 0, "s0", "x", 1), ("d", 1, "s1", "x", 1), ("d", 2, "s2", "y", 1), ("d", 3, "s3", "z", 1)], "doc_id string, rec_idx long, statId string, cityId string, year int")
    indicator = spark.createDataFrame([("d", 0, "i", "x"), ("d", 1, "j", "y")], "doc_id string, rec_idx long, indicatorId string, cityId string")
    target = spark.createDataFrame([("d", 0, "t", "y", "i"), ("d", 1, "u", "z", "j")], "doc_id string, rec_idx long, cityTargetId string, cityId string, indicatorId string")
    values = spark.createDataFrame([("d", 0, "v", "i", 1), ("d", 1, "w", "j", 1)], "doc_id string, rec_idx long, indicatorValueId string, indicatorId string, year int")
    tables = {"City": city, "CityAnnualStats": stats, "Indicator": indicator, "CityTarget": target, "IndicatorValue": values}
    version, bad = load.load_batch(store, "all", tables, "atomic")
    assert version is None and store.version() == 0 and [r.reason for r in bad.collect()] == ["duplicate cityId,year"]
    assert load.load_batch(store, "all", {"City": city}, "atomic", spark.createDataFrame([("q",)], "cityId string"))[0] is None
    # x repeats a key; y refers to a row of x and z to one of y, so both follow
    version, bad = load.load_batch(store, "cities", tables, "city")
    assert version is None and {(r.table, r.rec_idx) for r in bad.collect()} == {("CityAnnualStats", 1), ("CityTarget", 0), ("CityTarget", 1)}
    version, bad = load.load_batch(store, "cities", {n: df for n, df in tables.items() if n != "CityTarget"}, "city", spark.createDataFrame([("z",)], "cityId string"))
    assert version == 1 and {n: sorted(x[SPECS[n].pk] for x in store.read(n).collect()) for n in ("City", "CityAnnualStats", "IndicatorValue")} == {"City": ["y"], "CityAnnualStats": ["s2"], "IndicatorValue": ["w"]}


def test_rows_that_nothing_is_said_against_are_not_moved(spark, monkeypatch):
    saved = []
    keep = load.save
    monkeypatch.setattr(load, "save", lambda df, name, *more: saved.append((name, keep(df, name, *more))) or saved[-1][1])
    spec = {"T": TableSpec("T", "id", (), (("a", "b"),))}
    rows = [("d", k, k, k // 2 if k < 6 else k, 1) for k in range(400)] + [("d", 400, 9, 900, 1)]
    good, bad = load.enforce_constraints({"T": spark.createDataFrame(rows, "doc_id string, rec_idx long, id long, a long, b long")}, spec)
    assert {(x.rec_idx, x.reason) for x in bad.collect()} == {(1, "duplicate a,b"), (3, "duplicate a,b"), (5, "duplicate a,b"), (400, "duplicate primary key")}
    assert good["T"].count() == 397
    assert sorted(df.count() for name, df in saved if name in ("rows-judged", "keys-repeated", "hashes-repeated"))[-1] <= 8


def stable(prefs, held):
    """Deferred acceptance, one record at a time."""
    choice, keeps, free = {r: 0 for r in prefs}, {}, sorted(prefs)
    while free:
        r = free.pop()
        own = [(-s, i) for i, s in prefs[r] if i not in held]
        own.sort()
        while choice[r] < len(own):
            s, i = own[choice[r]]
            if i not in keeps or (s, r) < keeps[i][:2]:
                if i in keeps:
                    free.append(keeps[i][1])
                    choice[keeps[i][1]] += 1
                keeps[i] = (s, r)
                break
            choice[r] += 1
    return {r: i for i, (_, r) in keeps.items()}


def test_links_settle_as_a_stable_matching(spark):
    r = random.Random(11)
    for n in (5, 25):
        prefs = {("d", k): [(f"o{i}", r.randrange(1, 5) / 4) for i in r.sample(range(n), r.randrange(0, n))] for k in range(n)}
        rows = [(d, k, i, s) for (d, k), own in prefs.items() for i, s in own]
        got = linking.settle_links(spark.createDataFrame(rows, "doc_id string, rec_idx long, id string, score double"), spark.createDataFrame([("o1",)], "id string")).collect()
        assert {(x.doc_id, x.rec_idx): x.id for x in got} == stable(prefs, {"o1"})


def test_records_of_the_same_options_settle_in_few_rounds(spark):
    r = random.Random(6)
    kinds = [[(i, s) for i in range(40) if (s := round(r.choice([0, 0.25, 0.5, 0.5, 0.75]), 2))] for _ in range(3)]
    prefs = {(f"d{k % 2}", k): [(f"o{i:02}", s) for i, s in kinds[k % 3]] for k in range(60)}
    rows = [(d, k, i, s) for (d, k), own in prefs.items() for i, s in own]
    table = spark.createDataFrame(rows, "doc_id string, rec_idx long, id string, score double").repartition(3).cache()
    got = linking.settle_links(table).collect()
    assert {(x.doc_id, x.rec_idx): x.id for x in got} == stable(prefs, set())
    assert max(x.round for x in got) < 20  # one option after another takes more than 30
    one = linking.settle_links(table, rounds=2).collect()
    assert {x.round for x in one} == {1, 2} and len(one) < len(got)


def test_bad_links_are_made_anew(spark):
    rows = [("d", 0, "t1", 2020), ("d", 1, "t1", 2020), ("d", 2, "gone", 2020), ("d", 3, None, 2020), ("d", 4, "t2", 2021), ("d", 5, "gone", None), ("e", 0, "t3", 2020)]
    records = spark.createDataFrame(rows, "doc_id string, rec_idx long, link string, year int")
    targets = spark.createDataFrame([(f"t{k}",) for k in range(1, 5)], "id string")
    scored = [("d", 0, "t1", 0.9), ("d", 0, "t2", 0.8), ("d", 1, "t1", 0.95), ("d", 2, "t1", 0.99), ("d", 2, "gone", 1.0), ("d", 3, "t3", 0.9), ("d", 3, "t2", 0.7), ("d", 5, "t1", 0.5), ("x", 9, "t1", 1.0)]
    candidates = spark.createDataFrame(scored, "doc_id string, rec_idx long, id string, score double")
    out, changes = linking.retry_links(records, "link", candidates, targets, ("year",))
    # (t1, 2020) goes to the record of 0.99; (t3, 2020) is held by a good row
    assert {(x.doc_id, x.rec_idx): x.link for x in out.collect()} == {("d", 0): "t2", ("d", 1): None, ("d", 2): "t1", ("d", 3): None, ("d", 4): "t2", ("d", 5): "t1", ("e", 0): "t3"}
    assert changes.count() == 4
    assert quality.duplicate_groups({"t": out}, {"t": [("link", "year")]}).count() == 0
    plain, _ = linking.retry_links(records, "link", candidates, targets)
    assert {(x.doc_id, x.rec_idx): x.link for x in plain.collect()}[("d", 2)] == "t1" and plain.count() == len(rows)


@pytest.mark.parametrize("shared", [False, True])
def test_links_settled_by_sets_are_those_settled_by_pairs(spark, monkeypatch, shared):
    r = random.Random(7)
    word = lambda: r.choice(["solar", "wind", "roof", "bus", "tree"])
    texts = [(f"d{k % 3}", k // 3, " ".join(word() for _ in range(r.randrange(0, 4)))) for k in range(150)] + [("d0", 3, "bus tree"), ("d1", 5, "solar")]
    labels = [(f"d{k % 3}", f"o{k}", " ".join(word() for _ in range(r.randrange(1, 4)))) for k in range(120)] + [("d0", "o6", "wind"), ("d0", "ß1", "wind"), ("d0", "😀", "wind"), ("d1", None, "wind")] + [("d2", "o6", "bus")] * shared
    records = spark.createDataFrame([(d, k, f"o{k}" if k % 5 == 0 else None) for d, k, _ in texts[:150]], "doc_id string, rec_idx int, link string")
    sets = linking.link_sets(spark.createDataFrame(texts, "doc_id string, rec_idx int, text string"), spark.createDataFrame(labels, "doc_id string, id string, label string"))
    targets = spark.createDataFrame([(o,) for _, o, _ in labels if o != "o7"], "id string")
    plain = lambda df: sorted(map(tuple, df.collect()), key=str)
    want = plain(linking.retry_links(records, "link", sets.pairs(), targets, ())[0])
    if not shared:
        monkeypatch.setattr(linking, "settle_links", None)  # no pair is made
    out, changes = linking.retry_links(records, "link", sets, targets, ())
    assert plain(out) == want and sum(link is not None for _, _, link in want) > 90
    assert changes.count() > 90 and out.schema == records.schema


def test_bounds_lose_no_best_option(spark):
    r = random.Random(2)
    word = lambda: r.choice(["the"] * 6 + ["of"] * 4 + [f"w{k}" for k in range(12)])
    records = [(f"d{k % 2}", k, " ".join(word() for _ in range(r.randrange(0, 8))), f"o{r.randrange(50)}") for k in range(60)]
    options = [(f"d{k % 2}", f"o{k}", " ".join(word() for _ in range(r.randrange(1, 8)))) for k in range(60)]
    recs = spark.createDataFrame(records, "doc_id string, rec_idx long, text string, own_id string")
    opts = spark.createDataFrame(options, "doc_id string, id string, label string")
    dice = lambda s, a, b: 2 * s / (a + b)
    for weights, scorer, not_self in ((None, dice, False), (linking.idf(opts), None, True)):
        pairs = linking.link_scores(recs, opts, 0.15, scorer, weights).collect()
        want = {}
        for p in pairs:
            if not (not_self and records[p.rec_idx][3] == p.id):
                key = (p.doc_id, p.rec_idx)
                want[key] = min(want.get(key, (0, "~")), (-round(p.score, 9), p.id))
        got, looked = linking.link_bounded(recs, opts, 0.15, scorer, weights, not_self)
        assert {(g.doc_id, g.rec_idx): (-round(g.score, 9), g.id) for g in got.collect()} == want
        every = recs.select("doc_id", "rec_idx", F.explode(linking.tokens(F.col("text"))).alias("w")).join(opts.select("doc_id", "id", F.explode(linking.tokens(F.col("label"))).alias("w")), ["doc_id", "w"]).select("doc_id", "rec_idx", "id").distinct().count()
        assert 0 < sum(x.candidates for x in looked.collect()) < every


def test_many_quotes_are_found_in_one_scan(spark, monkeypatch):
    r = random.Random(3)
    monkeypatch.setattr(evidence, "MANY", 5)
    monkeypatch.setattr(evidence, "PART", 7)
    word = lambda: r.choice(["Emis-\nsion", "goal", "2030", "CO2", "ü", "a  b"])
    texts = {f"d{k}": " ".join(word() for _ in range(40)) for k in range(4)} | {"blank": " ", "lost": None}
    quotes = [(d, " ".join(word() for _ in range(r.randrange(0, 4)))) for d in ["d0"] * 60 + ["d1"] * 20 + ["d2"] * 3 + ["blank"] * 9 + ["lost"] * 9 + ["none"] * 9] + [(None, "goal")] * 8 + [("d0", None)]
    docs = spark.createDataFrame([*texts.items(), (None, "goal")], "doc_id string, text string")
    got = evidence.quotes_found(spark.createDataFrame(quotes, "doc_id string, quote string"), docs).collect()
    plain = lambda t: " ".join(t.replace("-\n", " ").split()).lower() if t else ""
    assert Counter((g.doc_id, g.quote, g.found) for g in got) == Counter((d, q, bool(plain(q)) and plain(q) in plain(texts.get(d))) for d, q in quotes)


@pytest.mark.parametrize("few", [0, 4 << 20])
def test_quotes_travel_as_numbers(spark, monkeypatch, few):
    monkeypatch.setattr(evidence, "FEW", few, raising=False)
    docs = spark.createDataFrame([(k, f"Text {k} of solar roofs {'and wind' * (k % 2)}") for k in range(20)], "doc_id long, text string")
    asked = ["solar  ROOFS", "and wind", "nowhere", "text 3", " "]
    quotes = docs.select("doc_id", F.explode(F.array(*map(F.lit, asked))).alias("quote"))
    got = evidence.quotes_found(quotes, docs, many=2)
    assert {(r.doc_id, r.quote) for r in got.where("found").collect()} == {(k, q) for k in range(20) for q, there in zip(asked, (True, k % 2, False, k == 3, False)) if there}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 100 and "no#" in plan  # rows meet by numbers, not by texts


@pytest.mark.parametrize("few", [0, 4 << 20])
def test_one_list_of_quotes_in_all_documents(spark, monkeypatch, few):
    monkeypatch.setattr(evidence, "FEW", few)
    texts = [(1, "Solar ROOFS and wind"), (1, "wind"), (2, None), (3, " "), (None, "solar roofs"), (4, "solar-\nroofs")]
    asked = [("a", "solar  roofs"), ("b", "wind"), ("b", "Wind"), ("c", " "), ("d", None), ("e", "nowhere"), ("f", "s")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = evidence.quotes_in_all(spark.createDataFrame(asked, "item_id string, quote string"), docs)
    plain = lambda t: " ".join(t.replace("-\n", " ").split()).lower() if t else ""
    want = Counter((d, i, q, bool(plain(q)) and plain(q) in plain(t)) for d, t in texts for i, q in asked)
    assert Counter(tuple(r) for r in got.select("doc_id", "item_id", "quote", "found").collect()) == want
    if few:  # documents stay where they are
        assert "Exchange hash" not in got._jdf.queryExecution().executedPlan().toString()
    assert evidence.quotes_in_all(spark.createDataFrame([], "item_id string, quote string"), docs).count() == 0


def test_large_key_tables_are_not_sent_to_every_task(spark, tmp_path, monkeypatch):
    specs = {"u": TableSpec("u", "id"), "t": TableSpec("t", "id", (Fk("up", "u"),), (("a", "b"),))}
    up = spark.createDataFrame([("d", k, k) for k in range(0, 60, 2)], "doc_id string, rec_idx long, id long")
    rows = lambda n: spark.createDataFrame([("d", k, k, k % 50, k % 7, k % 5) for k in range(n)], "doc_id string, rec_idx long, id long, up long, a long, b long")
    found = {}
    for few in (1_000_000, 3):
        monkeypatch.setattr(frames, "FEW_ROWS", few, raising=False)
        monkeypatch.setattr(store_module, "FEW_ROWS", few, raising=False)
        store = Store(spark, f"file://{tmp_path}/store{few}", specs, buckets=2)
        load.load_batch(store, "a", {"u": up, "t": rows(20)})
        good, bad = load.enforce_constraints({"t": rows(60)}, specs, store)
        found[few] = [sorted(map(tuple, df.collect())) for df in (good["t"], bad, store.read("t").select("id"))]
        assert ("BroadcastHashJoin" in good["t"]._jdf.queryExecution().executedPlan().toString()) == (few > 3)
        asked = store.stored("t", ("id",), spark.range(60).select(store_module.key_value([F.col("id")]).alias("value")))
        assert ("BroadcastHashJoin" in asked._jdf.queryExecution().executedPlan().toString()) == (few > 3)
        found[few].append(sorted(r.value for r in asked.collect()))
    assert found[3] == found[1_000_000] and all(found[3])


def test_records_given_twice(spark):
    docs = spark.createDataFrame([("d", "Target 2030")], "doc_id string, text string")
    claims = spark.createDataFrame([("d", 0, "2030", "Target 2030", 0.9), ("d", 0, "2030", "2030", 0.5)], "doc_id string, rec_idx int, y string, y_quote string, y_confidence double")
    good, bad = evidence.verify_records(claims, docs, {"y": "year"})
    assert [r.proofs["y"].quote for r in good.collect()] == ["2030", "2030"] and bad.count() == 0


def test_digests_tell_where_a_store_differs(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", {"t": TableSpec("t", "id")}, buckets=4)
    rows = lambda ids: spark.createDataFrame([("d", k, k) for k in ids], "doc_id string, rec_idx long, id long")
    assert load.reconcile_store({"t": rows(range(5))}, store).first()[1:] == (5, 0, 0, 5, 0, False, False, 0)
    load.load_batch(store, "a", {"t": rows(range(0, 3000, 2))})
    load.load_batch(store, "b", {"t": rows(range(1, 3000, 2))})
    got = load.reconcile_store({"t": rows([*range(10, 3000), 5000, 5000]).unionByName(spark.createDataFrame([("d", 9, None)], "doc_id string, rec_idx long, id long"))}, store).first()
    assert (got.source_count, got.target_count, got.matched, got.missing, got.extra, got.ok) == (2991, 3000, 2990, 1, 10, False) and 10 <= got.compared < 200
    assert load.reconcile_store({"t": rows(range(3000))}, store).first().compared == 0


def test_digests_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "PARTS", 1)
    monkeypatch.setattr(store_module, "RANGE_KEYS", 8, raising=False)
    store = Store(spark, f"file://{tmp_path}/store", {"t": TableSpec("t", "id")}, buckets=2)
    rows = lambda ids: spark.createDataFrame([("d", k, k) for k in ids], "doc_id string, rec_idx long, id long")
    edges = (0, 20, 1500, 3000)  # the first batch has too few ranges for the whole table
    for k in range(3):
        load.load_batch(store, f"b{k}", {"t": rows(range(edges[k], edges[k + 1]))})
    got = load.reconcile_store({"t": rows([*range(5, 2995), 4000])}, store).first()
    assert (got.source_count, got.target_count, got.matched, got.missing, got.extra) == (2991, 3000, 2990, 1, 10) and 10 <= got.compared < 600
    assert load.reconcile_store({"t": rows(range(3000))}, store).first().compared == 20  # the first batch's


def test_named_encodings(spark):
    import public_tokenizers
    import tiktoken

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    counter = helpers.register_encoding("own", path, pattern)
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello world, été! <|endoftext|>", "", None, "x" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n for r in docs.select("doc_id", helpers.token_count(F.col("text"), helpers.encoding("own")).alias("n")).collect()}
    assert got == {k: len(plain.encode_ordinary(t or "")) for k, t in enumerate(texts)}
    chunks = text.chunk_documents(docs, 6, 0, counter).where("doc_id = 0").collect()
    assert sum(c.token_count for c in chunks) <= got[0] and all(c.token_count == len(plain.encode_ordinary(c.text)) for c in chunks)
    with pytest.raises(ValueError, match="no encoding"):
        helpers.encoding("nobody")


def test_chunks_count_each_text_once(monkeypatch):
    import public_tokenizers

    r = random.Random(6)
    odd = ["don't", "it's", "x" * 30, "1234", "été", "中文字", "...", "!\x1c!", "\x1d", "a\x1fb.", "'", "'r", "é", "😀", "#1", "|", "$5.", "no?", "yes!", "- ", "​", "﻿"]
    gaps = [" ", "  ", "\n", " \n\n", "\t", "\xa0", " ", "　 ", "\x85", "\x1c", "\r\n", "\n\n\n", "\n\na | b\n--- | ---\n1 | 2\n\n"]
    texts = ["".join(r.choice(odd) + (r.choice(gaps) if r.random() < 0.2 else " ") for _ in range(r.randrange(400))) for _ in range(80)] + [None, "", " \x1c "]
    coded = helpers.Encoded(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for counter in (coded, helpers.count_words):
        for size, overlap in ((200, 20), (5, 0), (40, 39)):
            seen = []

            def plain(s):
                seen.extend(s)
                return counter(s)

            want = text._chunks(texts, size, overlap, text._Counted(plain))  # nothing is known of its tokens
            every, seen = sum(map(len, seen)), []
            plain.seam = counter.seam
            got = text._chunks(texts, size, overlap, text._Counted(plain))
            assert got == want and sum(map(len, want)) > 80
            assert sum(map(len, seen)) < 0.8 * every
        n = sum(len(t or "") for t in texts)
        assert size > 30 and sum(map(len, seen)) < 1.4 * n  # and not once more for blocks and chunks


def test_words_are_counted_without_python(spark):
    """Each code point by itself, in a word and between words, as Python's own pattern counts it."""
    points = [chr(k) for k in range(1, 0x110000) if not 0xD800 <= k < 0xE000]
    texts = ["".join(f"{x}{x} a{x}b " for x in points[k : k + 50]) for k in range(0, len(points), 50)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None, ""])], "doc_id long, text string")
    gated = text.size_gate(docs, 1000, 300)
    got = {r.doc_id: r.token_count for r in gated.select("doc_id", "token_count").collect()}
    assert got == {k: len(helpers._TOKEN.findall(t)) for k, t in enumerate([*texts, "", ""])}
    assert "regexp_extract_all" in gated._jdf.queryExecution().executedPlan().toString()
