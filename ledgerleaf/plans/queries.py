"""The registered queries of the library's own operators and their SQL. The driver's star schema stands in for record tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..frames import save
from ..functions import helpers as H
from ..functions import scalars as S
from ..operators import evidence, identity, linking, load, quality, text
from ..sources import tables as sources
from ..sources.store import Store
from ..specs import Fk, TableSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

STAR: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec("region", "r_regionkey"),
        TableSpec("nation", "n_nationkey", (Fk("n_regionkey", "region"),)),
        TableSpec("customer", "c_custkey", (Fk("c_nationkey", "nation"),)),
        TableSpec("supplier", "s_suppkey", (Fk("s_nationkey", "nation"),)),
        TableSpec("part", "p_partkey"),
        TableSpec("orders", "o_orderkey", (Fk("o_custkey", "customer"),)),
        TableSpec("lineitem", "rec_idx", (Fk("l_orderkey", "orders"), Fk("l_partkey", "part"), Fk("l_suppkey", "supplier")), (("l_orderkey", "l_linenumber"),)),
    )
}
CHAIN = {"orders": ("o_custkey", "customer"), "lineitem": ("l_orderkey", "orders")}
KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey"}
LI = """li AS (SELECT *, l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS rec_idx FROM lineitem)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A star-schema table with rec_idx; a line item's row number counts inside its order."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "lineitem":
        from pyspark.sql import Window as W

        w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
        return df.withColumn("rec_idx", F.col("l_orderkey") * 1000 + F.row_number().over(w))
    return df.withColumn("rec_idx", F.col(KEYS[name]).cast("long")) if name in KEYS else df


def star(spark: SparkSession, sf_dir: str, *names: str) -> quality.Tables:
    return {n: table(spark, sf_dir, n) for n in names}


def holed(spark: SparkSession, sf_dir: str) -> quality.Tables:
    """Line items and their parents, of which a fixed part is missing."""
    t = star(spark, sf_dir, "orders", "part", "supplier", "lineitem")
    return {**t, "orders": t["orders"].where("o_orderkey % 7 <> 0"), "part": t["part"].where("p_partkey % 11 <> 0")}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH {LI}, o AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0), p AS (SELECT * FROM part WHERE p_partkey % 11 <> 0)
SELECT 'lineitem' AS "table", rec_idx, field, CAST(v AS VARCHAR) AS value, 'not_found' AS kind, 'value ' || v || ' not found in ' || target AS message FROM (
SELECT rec_idx, 'l_orderkey' AS field, l_orderkey AS v, 'orders' AS target FROM li WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)
UNION ALL SELECT rec_idx, 'l_partkey', l_partkey, 'part' FROM li WHERE l_partkey NOT IN (SELECT p_partkey FROM p)
UNION ALL SELECT rec_idx, 'l_suppkey', l_suppkey, 'supplier' FROM li WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))""")
def fk_issues(spark, sf_dir):
    return quality.fk_issues({k: v for k, v in holed(spark, sf_dir).items()}, STAR)


@query(f"""WITH {LI} SELECT 'lineitem' AS "table", 'l_orderkey,l_linenumber' AS key_fields, l_orderkey || '|' || l_linenumber AS key, min(rec_idx) AS first, list(rec_idx ORDER BY rec_idx) AS rows
FROM li GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_groups(spark, sf_dir):
    return quality.duplicate_groups(star(spark, sf_dir, "lineitem"), {"lineitem": [("l_orderkey", "l_linenumber")]}, None).drop("values")


@query(f"""WITH {LI}, g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM li GROUP BY ALL)
SELECT 'lineitem' AS "table", 'pk' AS "check", (SELECT count(*) FROM li) AS records, 0 AS missing, 0 AS groups, 0 AS rows
UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber', sum(n), 0, count(*) FILTER (n > 1), coalesce(sum(n) FILTER (n > 1), 0) FROM g
UNION ALL SELECT 'orders', 'pk', sum(n), coalesce(sum(n) FILTER (k IS NULL), 0), count(*) FILTER (k IS NOT NULL AND n > 1), coalesce(sum(n) FILTER (k IS NOT NULL AND n > 1), 0)
FROM (SELECT CASE WHEN o_orderkey % 13 > 0 THEN o_orderkey - o_orderkey % 3 END AS k, count(*) AS n FROM orders GROUP BY 1)""")
def key_quality(spark, sf_dir):
    t = star(spark, sf_dir, "lineitem", "orders")
    holes = F.when(F.col("o_orderkey") % 13 > 0, F.col("o_orderkey") - F.col("o_orderkey") % 3)
    return quality.key_quality({**t, "orders": t["orders"].withColumn("o_orderkey", holes)}, STAR)


@query("""SELECT 'lineitem' AS "table", count(*) AS records, count(*) FILTER (l_orderkey % 5 = 0) + count(*) FILTER (l_partkey % 9 = 0) AS blank FROM lineitem
UNION ALL SELECT 'orders', count(*), 0 FROM orders""")
def fk_presence(spark, sf_dir):
    t = star(spark, sf_dir, "lineitem", "orders")
    t["lineitem"] = t["lineitem"].withColumns({"l_partkey": F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey")), "l_orderkey": F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey"))})
    return quality.fk_presence(t, STAR)


@query(f"""WITH {LI} SELECT rec_idx, min(rec_idx) OVER (PARTITION BY l_orderkey, l_linenumber) AS first, rec_idx > min(rec_idx) OVER (PARTITION BY l_orderkey, l_linenumber) AS is_repeat FROM li""")
def flag_repeats(spark, sf_dir):
    return quality.flag_repeats(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).select("rec_idx", "first", "is_repeat")


def _forest(spark, sf_dir):
    """A forest with parents that aren't there, pairs that are each other's parent, and chains of up to 64 orders."""
    t = star(spark, sf_dir, "region", "nation", "customer", "supplier", "orders")
    row = lambda df, i, p: df.select(F.expr(i).cast("long").alias("id"), F.expr(p).cast("long").alias("parent"))
    parts = [
        row(t["region"], "r_regionkey", "NULL"),
        row(t["nation"], "100 + n_nationkey", "n_regionkey"),
        row(t["customer"], "1000 + c_custkey", "IF(c_custkey % 9 = 0, -1, 100 + c_nationkey)"),
        row(t["supplier"].join(F.broadcast(t["supplier"].agg((2 * F.floor(F.count(F.lit(1)) / 2)).alias("n"))), F.col("s_suppkey") < F.col("n")), "10000000 + s_suppkey", "10000000 + s_suppkey + IF(s_suppkey % 2 = 0, -1, 1)"),  # one row
        row(t["orders"], "20000000 + o_orderkey", "IF(o_orderkey % 64 > 0, 20000000 + o_orderkey - 1, NULL)"),
    ]
    return quality.union(parts).withColumn("rec_idx", F.col("id"))


@query("""WITH RECURSIVE t AS (SELECT r_regionkey AS id, NULL AS parent FROM region UNION ALL SELECT 100 + n_nationkey, n_regionkey FROM nation
UNION ALL SELECT 1000 + c_custkey, CASE WHEN c_custkey % 9 = 0 THEN -1 ELSE 100 + c_nationkey END FROM customer UNION ALL SELECT 10000000 + s_suppkey, 10000000 + s_suppkey + CASE WHEN s_suppkey % 2 = 0 THEN -1 ELSE 1 END FROM supplier WHERE s_suppkey < 2 * (SELECT count(*) // 2 FROM supplier)
UNION ALL SELECT 20000000 + o_orderkey, CASE WHEN o_orderkey % 64 > 0 THEN 20000000 + o_orderkey - 1 END FROM orders),
ids AS (SELECT id FROM t), w AS (SELECT id, 0 AS level FROM t WHERE parent IS NULL OR parent NOT IN (SELECT id FROM ids) UNION ALL SELECT t.id, w.level + 1 FROM t JOIN w ON t.parent = w.id)
SELECT t.id, CAST(t.parent AS VARCHAR) AS parent, w.level FROM t LEFT JOIN w USING (id)""")
def topo_sort(spark, sf_dir):
    return quality.topo_sort(_forest(spark, sf_dir), "id", "parent")[0].select("id", F.col("parent").cast("string").alias("parent"), "level")


@query("""SELECT * FROM (SELECT o_orderkey AS rec_idx, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50), (SELECT count(*) AS total FROM orders)""")
def cap_details(spark, sf_dir):
    rows, total = quality.cap(table(spark, sf_dir, "orders").select("rec_idx", "o_totalprice"), [F.desc("o_totalprice"), "rec_idx"])
    return rows.crossJoin(F.broadcast(total))  # one row


_SAMPLED = {"region": "r_name", "nation": "n_name", "customer": "c_name", "supplier": "s_name", "part": "p_name", "orders": "o_orderstatus", "lineitem": "l_returnflag"}


@query(f"WITH {LI} " + " UNION ALL ".join(f"""(SELECT '{n}' AS "table", (SELECT count(*) FROM {n}) AS total, CAST({KEYS.get(n, 'rec_idx')} AS BIGINT) AS rec_idx, {c} AS name FROM {'li' if n == 'lineitem' else n} ORDER BY 3 LIMIT 3)""" for n, c in _SAMPLED.items()))
def sample_rows(spark, sf_dir):
    name = F.coalesce(*[F.when(F.col("table") == n, F.get_json_object("row", f"$.{c}")) for n, c in _SAMPLED.items()])
    return quality.sample_rows(star(spark, sf_dir, *_SAMPLED), 3).select("table", "total", "rec_idx", name.alias("name"))


@query("""SELECT 'region' AS "table", true AS "exists", count(*) AS records, 0 AS bytes, 'ok' AS status FROM region UNION ALL SELECT 'orders', true, count(*), 0, 'ok' FROM orders
UNION ALL SELECT unnest(['nation', 'customer', 'supplier', 'part', 'lineitem']), false, 0, 0, 'missing'""")
def table_profile(spark, sf_dir):
    return quality.table_profile(star(spark, sf_dir, "region", "orders"), None, STAR)


@query("""SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, (SELECT count(o_custkey) FROM orders) AS cleared FROM orders""")
def clear_fields(spark, sf_dir):
    rows, n = linking.clear_fields(table(spark, sf_dir, "orders"), ["o_custkey"])
    return rows.select("o_orderkey", "o_custkey").crossJoin(F.broadcast(n))  # one row


@query("""SELECT p_partkey % 10 AS doc_id, CAST(p_partkey AS VARCHAR) AS id, 'p_brand=' || p_brand || ' | p_type=' || p_type AS label, CAST(row_number() OVER (PARTITION BY p_partkey % 10 ORDER BY p_partkey) AS INTEGER) AS index FROM part""")
def build_options(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("doc_id", F.col("p_partkey") % 10)
    return linking.build_options(df, "p_partkey", ["p_brand", "p_type"], True)


@query("""SELECT s_suppkey, CAST((row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) // 15 AS INTEGER) AS batch_no, CAST((row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) % 15 AS INTEGER) AS batch_idx FROM supplier""")
def make_batches(spark, sf_dir):
    return linking.make_batches(table(spark, sf_dir, "supplier"), 15, "s_nationkey").select("s_suppkey", "batch_no", "batch_idx")


@query("""SELECT p_partkey AS rec_idx, '{"p_name":"' || p_name || '","p_size":' || p_size || '}' AS summary FROM part""")
def summarise(spark, sf_dir):
    return linking.summarise(table(spark, sf_dir, "part"), ["p_name", "p_size"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'default' END AS source FROM orders""")
def fill_default(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).otherwise(" ").alias("status"), F.lit(None).cast("map<string,string>").alias("misc"))
    rows, _ = linking.fill_default(df, "status", "unknown", "status_source")
    return rows.select("o_orderkey", "status", F.element_at("misc", "status_source").alias("source"))


@query("""WITH c AS (SELECT n_nationkey AS doc_id, min(c_custkey) AS k FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)
SELECT doc_id, '10000000-0000-0000-0000-' || lpad(CAST(k AS VARCHAR), 12, '0') AS "cityId" FROM c WHERE k IS NOT NULL""")
def canonical_city(spark, sf_dir):
    id_ = F.concat(F.lit("10000000-0000-0000-0000-"), F.lpad(F.col("c_custkey").cast("string"), 12, "0"))
    cities = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("doc_id"), "rec_idx", id_.alias("cityId"), F.col("c_name").alias("cityName"), F.lit("x").alias("country"), F.lit(None).cast("string").alias("locode"))
    got = linking.canonical_city(cities, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("doc_id")))
    return got.where("cityName IS NOT NULL").select("doc_id", "cityId")


def _cities(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("doc_id"), F.when(F.col("c_custkey") % 4 == 0, "other").otherwise(F.concat(F.lit("n"), "c_nationkey")).alias("cityId"))
    return rows, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("doc_id"), F.concat(F.lit("n"), "n_nationkey").alias("cityId"))


@query("""SELECT c_custkey, 'n' || c_nationkey AS "cityId", c_custkey % 4 = 0 AS changed FROM customer""")
def apply_city(spark, sf_dir):
    rows, city = _cities(spark, sf_dir)
    return linking.apply_city(rows, city).select("c_custkey", "cityId", "changed")


@query("""SELECT 'customer' AS "table", count(*) FILTER (c_custkey % 4 = 0) AS mismatches FROM customer""")
def city_mismatch(spark, sf_dir):
    rows, city = _cities(spark, sf_dir)
    return linking.city_mismatch({"customer": rows}, city)


_SCOPE = """c AS (SELECT * FROM customer WHERE {}), o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)), l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
SELECT 'customer' AS "table", count(*) AS n FROM c UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM l"""


def _counts(tables: quality.Tables) -> DataFrame:
    return quality.union([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table"), "n") for n, df in tables.items()])


def _by_city(spark, sf_dir):
    t = star(spark, sf_dir, "customer", "orders", "lineitem")
    return {**t, "customer": t["customer"].withColumn("cityId", F.col("c_nationkey").cast("string"))}


@query("WITH " + _SCOPE.format("c_nationkey IN (1, 2, 3)"))
def city_scope(spark, sf_dir):
    ids = table(spark, sf_dir, "nation").where("n_nationkey IN (1, 2, 3)").select(F.col("n_nationkey").cast("string").alias("cityId"))
    return _counts(load.city_scope(_by_city(spark, sf_dir), ids, STAR, CHAIN))


@query("WITH " + _SCOPE.format("c_nationkey = 7"))
def filter_city(spark, sf_dir):
    return _counts(load.filter_city(_by_city(spark, sf_dir), "7", specs=STAR, chain=CHAIN))


@query("WITH bad AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal < -900), " + _SCOPE.format("c_nationkey NOT IN (SELECT k FROM bad)"))
def gate_by_city(spark, sf_dir):
    t = _by_city(spark, sf_dir)
    return _counts(load.gate_by_city(t, t["customer"].where("c_acctbal < -900").select("cityId"), specs=STAR, chain=CHAIN))


@query("""SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS "cityId" FROM customer""")
def city_ids(spark, sf_dir):
    return load.city_ids(_by_city(spark, sf_dir))


@query(f"""WITH {LI}, c AS (SELECT * FROM customer WHERE c_custkey % 5 <> 0), o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
f AS (SELECT *, min(rec_idx) OVER (PARTITION BY l_orderkey, l_linenumber) AS first FROM li),
l AS (SELECT *, l_orderkey IN (SELECT o_orderkey FROM o) AS ok FROM f WHERE rec_idx = first)
SELECT 'orders' AS "table", 'o_custkey not in customer' AS reason, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM c)
UNION ALL SELECT 'lineitem', 'duplicate l_orderkey,l_linenumber', count(*) FROM f WHERE rec_idx > first
UNION ALL SELECT 'lineitem', 'l_orderkey not in orders', count(*) FROM l WHERE NOT ok
UNION ALL SELECT 'lineitem', 'accepted', count(*) FROM l WHERE ok""")
def enforce_constraints(spark, sf_dir):
    t = star(spark, sf_dir, "customer", "orders", "lineitem")
    good, bad = load.enforce_constraints({**t, "customer": t["customer"].where("c_custkey % 5 <> 0")}, STAR)
    kept = good["lineitem"].agg(F.count(F.lit(1)).alias("n")).select(F.lit("lineitem").alias("table"), F.lit("accepted").alias("reason"), "n")
    return bad.groupBy("table", "reason").agg(F.count(F.lit(1)).alias("n")).unionByName(kept)


_EVENT = TableSpec("events", "id", (), (), {"id": ("long", True), "userId": ("long", True), "eventType": ("string", True), "value": ("decimal", False), "day": ("date", True)})


def _events(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    m = F.col("event_id") % 10
    body = F.struct(
        F.when(m != 1, F.col("event_id")).alias("id"),
        F.when(m != 2, F.col("user_id")).alias("user_id"),
        F.when(m == 3, " ").when(m == 6, "{").otherwise(F.col("event_type")).alias("eventType"),
        F.when(m == 4, "much").otherwise("5").alias("value"),
        F.date_format("ts", "yyyy/MM/dd").alias("day"),
        F.when(m == 5, "x").alias("other"),
    )
    raw = F.to_json(body)
    return e.select(F.col("event_id").alias("rec_idx"), F.when(m == 6, F.replace(raw, F.lit('"{"'), F.lit('{"a":1}'))).when(m == 7, F.concat(F.lit("["), raw, F.lit("]"))).when(m == 8, F.regexp_replace(raw, '"value":"5"', '"value":5.0')).otherwise(raw).alias("raw"))


_ERRORS = """e AS (SELECT 'events' AS "table", event_id AS rec_idx, CASE event_id % 10 WHEN 1 THEN 'id' WHEN 2 THEN 'userId' WHEN 3 THEN 'eventType' WHEN 4 THEN 'value' WHEN 5 THEN 'other' WHEN 6 THEN 'eventType' END AS field,
CASE event_id % 10 WHEN 1 THEN 'missing' WHEN 2 THEN 'missing' WHEN 3 THEN 'null' WHEN 4 THEN 'type' WHEN 5 THEN 'extra' ELSE 'type' END AS type FROM events WHERE event_id % 10 BETWEEN 1 AND 7)"""


@query("""SELECT event_id AS rec_idx, CASE WHEN event_id % 10 NOT IN (2, 7) THEN CAST(user_id AS VARCHAR) END AS "userId", event_id % 10 = 5 AS has_unknown FROM events""")
def normalize_columns(spark, sf_dir):
    got = load.normalize_columns(_events(spark, sf_dir), _EVENT)
    return got.select("rec_idx", "userId", (F.size("unknown") > 0).alias("has_unknown"))


@query(f"WITH {_ERRORS} SELECT * FROM e")
def validate(spark, sf_dir):
    return load.validate(load.normalize_columns(_events(spark, sf_dir), _EVENT), _EVENT)[1]


@query(f"WITH {_ERRORS} SELECT field, count(*) AS n FROM e WHERE type = 'missing' GROUP BY field")
def missing_fields(spark, sf_dir):
    return load.missing_fields(validate(spark, sf_dir))


@query(f"""WITH {_ERRORS} SELECT 'events' AS "table", (SELECT count(*) FROM events) AS loaded, count(*) AS failed, count(DISTINCT rec_idx) AS failed_rows, count(*) > 50 AS truncated FROM e""")
def load_report(spark, sf_dir):
    counts = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.count(F.lit(1)).alias("loaded")).select(F.lit("events").alias("table"), "loaded")
    return load.load_report(counts, validate(spark, sf_dir))


@query("""SELECT event_id AS rec_idx, strftime(ts, '%Y-%m-%d') AS day, CAST(5 AS DOUBLE) AS value FROM events WHERE event_id % 10 NOT BETWEEN 1 AND 7""")
def validated_rows(spark, sf_dir):
    good = load.validate(load.normalize_columns(_events(spark, sf_dir), _EVENT), _EVENT)[0]
    return good.select("rec_idx", F.col("day").cast("string").alias("day"), F.col("value").cast("double").alias("value"))


@query("""SELECT 'orders' AS "table", count(*) FILTER (s) AS source_count, count(*) FILTER (t) AS target_count, count(*) FILTER (s AND t) AS matched, count(*) FILTER (s AND NOT t) AS missing,
count(*) FILTER (t AND NOT s) AS extra, count(*) FILTER (s AND NOT t) = 0 AS ok, false AS shared FROM (SELECT o_orderkey % 5 <> 0 AS s, o_orderkey % 3 <> 0 AS t FROM orders)
UNION ALL SELECT 'customer', count(*), count(*), count(*), 0, 0, true, true FROM customer WHERE c_nationkey IN (1, 2, 3)""")
def reconcile(spark, sf_dir):
    t = star(spark, sf_dir, "orders")
    people = table(spark, sf_dir, "customer").withColumn("cityId", F.col("c_nationkey").cast("string"))
    cities = table(spark, sf_dir, "nation").where("n_nationkey IN (1, 2, 3)").select(F.col("n_nationkey").cast("string").alias("cityId"))
    there = people.where("c_nationkey IN (1, 2, 3, 4)")
    return load.reconcile({"orders": t["orders"].where("o_orderkey % 5 <> 0"), "customer": people}, {"orders": t["orders"].where("o_orderkey % 3 <> 0"), "customer": there}, STAR, ("customer",), cities)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'missing' WHEN o_orderkey % 5 = 0 THEN 'extra' ELSE 'matched' END AS side FROM orders""")
def id_sets(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return load.id_sets(o.where("o_orderkey % 3 = 0 OR o_orderkey % 5 <> 0"), o.where("o_orderkey % 3 <> 0"), "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0")
def absent_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return identity.absent_ids(o, o.where("o_orderkey % 3 <> 0"), "o_orderkey")


def _uuid_sql(namespace: uuid.UUID, name: str) -> str:
    h = f"sha1(unhex('{namespace.hex}') || encode({name}))"
    return f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"


@query(f"""SELECT o_orderkey AS rec_idx, {_uuid_sql(S.class_namespace('orders'), "'order ' || o_orderkey")} AS id FROM orders""")
def uuid5(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("rec_idx", S.uuid5(S.class_namespace("orders"), F.concat(F.lit("order "), "o_orderkey")).alias("id"))


@query(f"""SELECT o_orderkey AS rec_idx, {_uuid_sql(S.class_namespace('orders'), "'order ' || o_orderkey")} AS id FROM orders""")
def fill_pk(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("rec_idx", F.lit(None).cast("string").alias("id"), S.uuid5(S.class_namespace("orders"), F.concat(F.lit("order "), "o_orderkey")).alias("new"))
    return load.fill_pk(df, "id", "new")


_NAMED = f"""{LI}, s AS (SELECT rec_idx, l_orderkey || '/' || l_linenumber AS seed, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY rec_idx) AS k FROM li)"""


@query(f"""WITH {_NAMED} SELECT rec_idx, {_uuid_sql(S.class_namespace('lineitem'), "CASE WHEN k = 1 THEN seed ELSE seed || '|' || k END || 'id'")} AS id FROM s""")
def assign_pk(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("rec_idx", F.lit("none").alias("id"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("seed"))
    return identity.assign_pk(df, "lineitem", "id").select("rec_idx", "id")


def _rewritten(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("rec_idx", F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("o"), "o_orderkey").alias("seed"))
    return identity.rewrite_pk(o, "orders", "id")


_REWRITE = uuid.uuid5(uuid.UUID(int=0), "rewrite:orders")


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS old_id, {_uuid_sql(_REWRITE, "'o' || o_orderkey")} AS new_id FROM orders""")
def rewrite_pk(spark, sf_dir):
    return _rewritten(spark, sf_dir)[1]


@query(f"""WITH {LI} SELECT rec_idx, {_uuid_sql(_REWRITE, "'o' || l_orderkey")} AS l_orderkey FROM li""")
def cascade_fk(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("rec_idx", F.col("l_orderkey").cast("string").alias("l_orderkey"))
    return identity.cascade_fk({"lineitem": li}, {"orders": _rewritten(spark, sf_dir)[1]}, STAR)[0]["lineitem"]


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE doc_id % 50 = 0) AND doc_id % 50 <> 0) WHERE n = 1""")
def dedupe_records(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("doc_id").alias("rec_idx"), S.content_key(F.col("text")).alias("content_key"))
    return identity.dedupe_records(d.where("doc_id % 50 <> 0"), d.where("doc_id % 50 = 0"))[0].select("doc_id")


@query("""SELECT event_type AS signature, list(v ORDER BY a, b) AS items FROM (SELECT event_type, user_id % 20 AS v, min(event_id % 2) AS a, min_by(event_id, (event_id % 2, event_id)) AS b FROM events GROUP BY ALL) GROUP BY 1""")
def merge_items(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("signature"), F.col("event_id").alias("seq"), (F.col("user_id") % 20).alias("item"))
    return linking.merge_items(e.where("seq % 2 = 0"), e.where("seq % 2 = 1"))


@query("""WITH i AS (SELECT user_id AS doc_id, event_type AS signature, CAST(hour(ts) AS INTEGER) AS chunk, event_id % 7 AS item FROM events),
f AS (SELECT doc_id, signature, item, min(chunk) AS item_chunk FROM i GROUP BY ALL), c AS (SELECT DISTINCT doc_id, signature, chunk FROM i)
SELECT c.doc_id, signature, c.chunk AS chunk_index, item, item_chunk FROM c JOIN f USING (doc_id, signature) WHERE item_chunk < c.chunk""")
def prior_context(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    i = e.select(F.col("user_id").alias("doc_id"), F.lit("e").alias("class"), F.col("event_type").alias("signature"), F.hour("ts").alias("chunk_index"), F.col("event_id").alias("seq"), (F.col("event_id") % 7).alias("item"))
    return linking.prior_context(i, i).drop("class", "at")


@query("""WITH r AS (SELECT s_suppkey AS rec_idx, s_nationkey AS doc_id, (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) AS pos FROM supplier)
SELECT rec_idx, CASE WHEN pos % 15 % 3 = 0 THEN 'id-' || (pos % 15) WHEN pos % 15 % 3 = 1 THEN 'opt-' || (1 + pos % 15 % 2) END AS chosen FROM r""")
def apply_selections(spark, sf_dir):
    rows = linking.make_batches(table(spark, sf_dir, "supplier").select("rec_idx", F.col("s_nationkey").alias("doc_id")))
    body = F.when(F.col("batch_idx") % 3 == 0, F.struct(F.lit("chosen").alias("field"), F.concat(F.lit("id-"), "batch_idx").alias("id"), F.lit(1).alias("index"))).otherwise(F.struct(F.lit("chosen").alias("field"), F.lit(None).cast("string").alias("id"), (1 + F.col("batch_idx") % 2).cast("int").alias("index")))
    answered = rows.where("batch_idx % 3 < 2").select("doc_id", "batch_no", F.struct(F.col("batch_idx").alias("record_index"), F.array(body).alias("selections")).alias("r"))
    responses = answered.groupBy("doc_id", "batch_no").agg(F.to_json(F.collect_list("r")).alias("response"))
    options = rows.select("doc_id").distinct().select("doc_id", F.lit("chosen").alias("field"), F.explode(F.array(F.lit(1), F.lit(2))).alias("index")).withColumn("id", F.concat(F.lit("opt-"), "index"))
    return linking.apply_selections(rows, responses, options, ["chosen"]).select("rec_idx", "chosen")


_TOKENS = r"list_distinct(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> ''))"


@query(f"""WITH p AS (SELECT p_partkey, p_partkey % 50 AS doc_id, {_TOKENS.format('p_name')} AS t, {_TOKENS.format("p_type || ' ' || p_name")} AS l FROM part),
s AS (SELECT a.p_partkey AS rec_idx, CAST(b.p_partkey AS VARCHAR) AS id, len(list_intersect(a.t, b.l)) / (len(a.t) + len(b.l) - len(list_intersect(a.t, b.l))) AS score FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.p_partkey <> b.p_partkey WHERE len(list_intersect(a.t, b.l)) > 0),
r AS (SELECT rec_idx, id, row_number() OVER (PARTITION BY rec_idx ORDER BY score DESC, id) AS n FROM s WHERE score >= 0.2)
SELECT p_partkey AS rec_idx, id AS linked_id FROM p LEFT JOIN r ON r.rec_idx = p_partkey AND n = 1""")
def link_parent(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("rec_idx", (F.col("p_partkey") % 50).alias("doc_id"), "p_partkey", "p_name", F.concat_ws(" ", "p_type", "p_name").alias("label"))
    return linking.link_parent(p, "p_partkey", "p_name", "label").select("rec_idx", "linked_id")


@query(f"""WITH p AS (SELECT p_partkey % 50 AS doc_id, p_partkey, {_TOKENS.format("p_type || ' ' || p_brand")} AS l FROM part), r AS (SELECT p_partkey AS rec_idx, p_partkey % 50 AS doc_id, {_TOKENS.format("p_brand || ' ' || p_name")} AS t FROM part),
s AS (SELECT rec_idx, CAST(p_partkey AS VARCHAR) AS id, len(list_intersect(t, l)) / (len(t) + len(l) - len(list_intersect(t, l))) AS score FROM r JOIN p USING (doc_id) WHERE len(list_intersect(t, l)) > 0)
SELECT r.rec_idx, x.id AS linked_id FROM r LEFT JOIN (SELECT rec_idx, id, row_number() OVER (PARTITION BY rec_idx ORDER BY score DESC, id) AS n FROM s WHERE score >= 0.2) x ON x.rec_idx = r.rec_idx AND n = 1""")
def link_candidates(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("doc_id", F.col("p_partkey") % 50)
    records = p.select("doc_id", "rec_idx", F.concat_ws(" ", "p_brand", "p_name").alias("text"))
    options = p.select("doc_id", F.col("p_partkey").cast("string").alias("id"), F.concat_ws(" ", "p_type", "p_brand").alias("label"))
    return linking.link_fk(records, options).select("rec_idx", "linked_id")


_FEED = f"""WITH {LI}, fk AS (SELECT rec_idx, 0 AS kind, 0 AS seq, 'l_orderkey: value ' || l_orderkey || ' not found in orders' AS m FROM li WHERE l_orderkey % 7 = 0
UNION ALL SELECT rec_idx, 0, 1, 'l_partkey: value ' || l_partkey || ' not found in part' FROM li WHERE l_partkey % 11 = 0),
g AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM li),
x AS (SELECT * FROM fk UNION ALL SELECT rec_idx, 1, 0, 'Duplicate unique key on (l_orderkey, l_linenumber): l_orderkey=' || l_orderkey || ', l_linenumber=' || l_linenumber || '. Choose a different match if possible to make this combination unique.' FROM g WHERE n > 1)
SELECT 'lineitem' AS "table", rec_idx, count(*) AS n_messages, string_agg(m, ' ' ORDER BY kind, seq) AS text, 'again' AS target FROM x GROUP BY rec_idx"""


@query(_FEED)
def retry_feedback(spark, sf_dir):
    t = holed(spark, sf_dir)
    groups = quality.duplicate_groups(t, {"lineitem": [("l_orderkey", "l_linenumber")]}, None)
    got = linking.retry_feedback(quality.fk_issues({"lineitem": t["lineitem"], "orders": t["orders"], "part": t["part"]}, STAR), groups, STAR, {"lineitem": "again"}, {"again"})
    return got.select("table", "rec_idx", F.size("messages").cast("long").alias("n_messages"), "text", "target")


_NORM = r"lower(trim(regexp_replace(regexp_replace({}, '-[\r\n]+', ' ', 'g'), '\s+', ' ', 'g')))"


@query(f"""SELECT doc_id, {_NORM.format('text')} AS norm FROM documents""")
def normalize_text(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", S.normalize_for_match(F.col("text")).alias("norm"))


@query(r"""SELECT doc_id, regexp_replace(replace(replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\n', chr(10)), '\t', chr(9)), '\n{3,}', chr(10) || chr(10), 'g') AS clean FROM documents""")
def sanitize(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", S.sanitize_markdown(F.col("text")).alias("clean"))


@query(r"""WITH l AS (SELECT doc_id, list_transform(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)), lambda x: regexp_replace(regexp_replace(x, '\s+$', ''), '^\s*[\d.\-]*\s*(.+)$', '\1')) AS x FROM documents),
b AS (SELECT doc_id, list_filter(x, lambda y, i: y <> '' OR i = 1 OR x[i - 1] <> '') AS x FROM l) SELECT doc_id, regexp_replace(array_to_string(x, chr(10)), '^\s+|\s+$', '', 'g') AS toc FROM b""")
def normalize_toc(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", S.normalize_toc(F.col("text")).alias("toc"))


@query(f"""WITH q AS (SELECT d.doc_id, d.text AS whole, b.text AS quote FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % 40)
SELECT doc_id, contains({_NORM.format('whole')}, {_NORM.format('quote')}) AS found FROM q""")
def quotes_found(spark, sf_dir):
    d, b = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    quotes = d.select("doc_id", (F.col("doc_id") % 40).alias("item_id")).join(b.select("item_id", F.col("text").alias("quote")), "item_id").select("doc_id", "quote")
    return evidence.quotes_found(quotes, d).select("doc_id", "found")


def _claims(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    m = F.col("doc_id") % 5
    quote = F.when(m == 0, F.substring("text", 1, 30)).when(m == 1, "no such words anywhere 123").when(m == 2, " ").otherwise(F.substring("text", 5, 20))
    return d, d.select("doc_id", F.lit(0).alias("rec_idx"), F.lit("1,250 t").alias("value"), quote.alias("value_quote"), F.when(m == 3, 1.5).otherwise(0.5).alias("value_confidence"))


@query(f"""SELECT doc_id, 1250.0 AS value FROM documents WHERE (doc_id % 5 = 0 AND {_NORM.format('substr(text, 1, 30)')} <> '') OR (doc_id % 5 = 4 AND {_NORM.format('substr(text, 5, 20)')} <> '')""")
def verify_records(spark, sf_dir):
    d, claims = _claims(spark, sf_dir)
    return evidence.verify_records(claims, d, {"value": "decimal"})[0].select("doc_id", F.col("value").cast("double").alias("value"))


@query(f"""WITH k AS (SELECT doc_id FROM documents WHERE (doc_id % 5 = 0 AND {_NORM.format('substr(text, 1, 30)')} <> '') OR (doc_id % 5 = 4 AND {_NORM.format('substr(text, 5, 20)')} <> ''))
SELECT 'value' AS field, count(*) AS present, count(*) AS proven, 0 AS missing_required FROM k""")
def audit_proofs(spark, sf_dir):
    d, claims = _claims(spark, sf_dir)
    return evidence.audit_proofs(evidence.verify_records(claims, d, {"value": "decimal"})[0], d, {"value": True})


@query("""SELECT lang AS class, count(*) FILTER (n_chars > 500) AS accepted, count(*) FILTER (n_chars <= 500) AS errors, CASE WHEN count(*) FILTER (n_chars <= 500) = 0 THEN 'ok' ELSE 'partial' END AS status, count(*) FILTER (n_chars > 500) AS stored FROM documents GROUP BY lang""")
def acceptance(spark, sf_dir):
    return evidence.acceptance(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("lang").alias("class"), (F.col("n_chars") > 500).alias("accepted")))


@query(f"""WITH {LI} SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem""")
def flatten_values(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("values"))
    return evidence.flatten_values(li, "l_orderkey")[1].drop("value_idx")


@query("""SELECT conv_id AS doc_id, trim(string_agg(trim(text), chr(10) ORDER BY turn, trim(text))) AS text FROM conversations GROUP BY conv_id""")
def assemble_pages(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return text.assemble_pages(c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), F.col("text").alias("markdown")))


@query("""SELECT conv_id AS doc_id, turn AS page_no, nxt AS next_no FROM (SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations) WHERE nxt IS NOT NULL""")
def page_pairs(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return text.page_pairs(c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), F.col("text").alias("markdown"))).select("doc_id", "page_no", "next_no")


_N = r"len(regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]'))"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
#: Paragraphs of the documents, which hold no headings and tables: runs of lines that aren't blank.
_PARAGRAPHS = f"""l AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS x FROM documents, unnest(generate_series(1, len(string_split(text, chr(10))))) AS g(i)),
m AS (SELECT *, regexp_matches(x, '\\S') AS worded, sum(CASE WHEN regexp_matches(x, '\\S') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM l),
p AS (SELECT doc_id, {_STRIP.format('string_agg(x, chr(10) ORDER BY i)')} AS text, min(i) AS a, max(i) AS z FROM m WHERE worded GROUP BY doc_id, gap),
q AS (SELECT *, {_N.format('text')} AS n, row_number() OVER (PARTITION BY doc_id ORDER BY a) - 1 AS k FROM p)"""


def _chunk_sql(size: int, overlap: int) -> str:
    """CTEs over ``_PARAGRAPHS``: pieces packed one by one, ``chunk`` at the end."""
    return f"""s AS (SELECT doc_id, a, z, unnest(CASE WHEN n <= {size} THEN [text] ELSE string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) END) AS text, k, generate_subscripts(CASE WHEN n <= {size} THEN [text] ELSE string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) END, 1) AS j FROM q),
t AS (SELECT doc_id, a, z, text, {_N.format('text')} AS n, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) AS k FROM s WHERE text <> ''),
w AS (SELECT doc_id, k, 0 AS c, n AS held FROM t WHERE k = 1 UNION ALL SELECT t.doc_id, t.k, CASE WHEN w.held + t.n <= {size} THEN w.c ELSE w.c + 1 END, CASE WHEN w.held + t.n <= {size} THEN w.held + t.n ELSE t.n END FROM w JOIN t ON t.doc_id = w.doc_id AND t.k = w.k + 1),
o AS (SELECT t.*, w.c, coalesce(sum(n) OVER (PARTITION BY t.doc_id, w.c ORDER BY t.k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS behind FROM t JOIN w USING (doc_id, k)),
u AS (SELECT doc_id, c, a, z, text, k, true AS own FROM o UNION ALL SELECT doc_id, c + 1, a, z, text, k, false FROM o JOIN (SELECT doc_id, max(c) AS last FROM w GROUP BY doc_id) USING (doc_id) WHERE c < last AND behind < {overlap}),
chunk AS (SELECT doc_id, CAST(c AS INTEGER) AS chunk_index, string_agg(text, chr(10) || chr(10) ORDER BY k) AS text, CAST({_N.format("string_agg(text, chr(10) || chr(10) ORDER BY k)")} AS BIGINT) AS token_count,
  CAST(min(a) AS INTEGER) AS start_line, CAST(max(z) FILTER (own) AS INTEGER) AS end_line, CAST([] AS VARCHAR[]) AS signatures FROM u GROUP BY doc_id, c)"""


@query(f"WITH RECURSIVE {_PARAGRAPHS}, {_chunk_sql(200, 20)} SELECT * FROM chunk")
def chunk_documents(spark, sf_dir):
    return text.chunk_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), 200, 20)


@query(f"""WITH RECURSIVE {_PARAGRAPHS}, {_chunk_sql(500, 0)}, d AS (SELECT doc_id, text, CAST({_N.format('text')} AS BIGINT) AS n FROM documents)
SELECT doc_id, 0 AS chunk_index, text, n AS token_count, 1 AS start_line, len(string_split(text, chr(10))) AS end_line, CAST([] AS VARCHAR[]) AS signatures FROM d WHERE n <= 1000
UNION ALL SELECT chunk.* FROM chunk JOIN d USING (doc_id) WHERE d.n > 1000""")
def route_and_chunk(spark, sf_dir):
    return text.route_and_chunk(spark.read.parquet(f"{sf_dir}/documents.parquet"), 1000, 100000, 500)


@query(f"""WITH {_PARAGRAPHS} SELECT doc_id, CAST(k AS INTEGER) AS block_no, 'paragraph' AS kind, text, CAST(a AS INTEGER) AS start_line, CAST(z AS INTEGER) AS end_line, CAST(n AS BIGINT) AS token_count,
CAST(NULL AS VARCHAR) AS heading_path, CAST(NULL AS VARCHAR) AS header, CAST(NULL AS VARCHAR) AS signature FROM q""")
def parse_blocks(spark, sf_dir):
    return text.parse_blocks(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query("""SELECT min(p_partkey) AS doc_id, substr(sha1(p_brand || ' > sizes|key | name'), 1, 12) AS signature, 'Key | Name' AS header, p_brand || ' > sizes' AS heading_path, 5 AS start_line, CAST(6 + count(*) AS INTEGER) AS end_line FROM part GROUP BY p_brand
UNION ALL SELECT min(p_partkey), substr(sha1(p_brand || '|| size | parts |'), 1, 12), '| size | parts |', p_brand, CAST(10 + count(*) AS INTEGER), CAST(11 + count(*) AS INTEGER) FROM part GROUP BY p_brand""")
def extract_tables(spark, sf_dir):
    """Each part as a row of a Markdown table of its brand, under two headings, and a table without rows under one."""
    p = table(spark, sf_dir, "part").withColumn("row", F.concat_ws(" | ", F.col("p_partkey"), "p_name"))
    doc = p.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list("row")), "\n").alias("rows"), F.min("p_partkey").alias("doc_id"))
    body = F.concat(F.lit("# "), "p_brand", F.lit("\n\n## sizes\n\nKey | Name\n---- | :---:\n"), "rows", F.lit("\n\n# "), "p_brand", F.lit("\n\n| size | parts |\n|---|---|\nend of the table"))
    return text.extract_tables(doc.select("doc_id", body.alias("text")))


@query("""SELECT 'doc=' || s_nationkey AS doc_id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS rec_idx, CAST(s_suppkey AS BIGINT) AS s_suppkey FROM supplier""")
def read_tables(spark, sf_dir):
    """Suppliers written as JSON lists, a file for each nation, and read back."""
    row = F.struct("s_suppkey", F.to_json(F.struct("s_suppkey", "s_name")).alias("row"))
    lists = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("doc")).agg(F.array_sort(F.collect_list(row)).alias("r"))
    folder = sources.new_folder(spark, "lists")
    lists.select("doc", F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x["row"]), ","), F.lit("]")).alias("value")).write.partitionBy("doc").text(f"{folder}/supplier.json")
    got = sources.read_tables(spark, folder, {"supplier": STAR["supplier"]})["supplier"]
    return got.select("doc_id", "rec_idx", F.get_json_object("raw", "$.s_suppkey").cast("long").alias("s_suppkey"))


@query("""SELECT 'list=' || ascii(o_orderpriority) AS doc_id, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS rec_idx, CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) || '0' AS price, o_orderstatus || ',"[]' AS status FROM orders""")
def read_lists(spark, sf_dir):
    """Orders written as one JSON list for each priority, with marks inside strings and prices of three places, and read back as written."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(15,2)").alias("price"))
    text_ = F.format_string('{"o_orderkey": %d, "status": "%s,\\"[]",\n "price": %s0}', F.col("o_orderkey").cast("long"), "o_orderstatus", F.col("price").cast("string"))
    # a file is written by one task, in the order of the windows: the writer sorts anew by any other, and where that sort spills, rows of a list change places
    every = W.partitionBy("list").orderBy("o_orderkey")
    first, last = (f("o_orderkey").over(every).isNull() for f in (F.lag, F.lead))
    lines = o.select(F.ascii("o_orderpriority").alias("list"), "o_orderkey", text_.alias("text")).select("list", F.concat(F.when(first, "[ ").otherwise(""), "text", F.when(last, " ]").otherwise(" ,")).alias("value"))
    folder = sources.new_folder(spark, "lists")
    lines.write.partitionBy("list").text(folder)
    got = sources.read_table(spark, folder)
    return got.select("doc_id", "rec_idx", F.get_json_object("raw", "$.o_orderkey").cast("long").alias("o_orderkey"), F.regexp_extract("raw", r'"price": ([0-9.]+)', 1).alias("price"), F.get_json_object("raw", "$.status").alias("status"))


@query("SELECT 'item=' || item_id AS doc_id, text || chr(10) AS text FROM benchmark")
def read_documents(spark, sf_dir):
    """The benchmark's passages written as files and read back."""
    folder = sources.new_folder(spark, "passages")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.col("item_id").alias("item"), F.col("text").alias("value")).write.partitionBy("item").text(folder)
    return sources.read_documents(spark, f"{folder}/*/*").select("doc_id", "text")


@query("""SELECT 'orders' AS "table", CAST(o_orderkey AS BIGINT) AS key FROM orders UNION ALL SELECT 'customer', c_custkey FROM customer""")
def write_tables(spark, sf_dir):
    folder = sources.new_folder(spark, "stage")
    sources.write_tables(star(spark, sf_dir, "orders", "customer"), folder)
    read = lambda n: spark.read.parquet(f"{folder}/{n}").select(F.lit(n).alias("table"), F.col(KEYS[n]).cast("long").alias("key"))
    return read("orders").unionByName(read("customer"))


@query("""SELECT CAST(o_orderkey AS BIGINT) AS key, CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE 'b' END AS batch FROM orders WHERE o_orderkey % 3 < 2""")
def load_tables(spark, sf_dir):
    """Three batches of orders: one loaded, one loaded twice, as after a failure, and one that broke off before its mark."""
    o, folder = table(spark, sf_dir, "orders"), sources.new_folder(spark, "store")
    for batch, part in (("a", 0), ("b", 1), ("b", 1)):
        load.load_tables({"orders": o.where(F.col("o_orderkey") % 3 == part)}, STAR, folder, batch=batch)
    o.where("o_orderkey % 3 = 2").write.parquet(f"{folder}/orders/batch=c")
    return load.read_loaded(spark, folder, "orders").select(F.col("o_orderkey").cast("long").alias("key"), "batch")


@query("""SELECT 'counts' AS part, count(DISTINCT o_orderstatus) OVER () AS total, CAST(NULL AS INTEGER) AS position, '{"o_orderstatus":"' || o_orderstatus || '","n":' || n || '}' AS row FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
UNION ALL SELECT * FROM (SELECT 'errors', (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0), CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER), '{"rec_idx":' || o_orderkey || '}' FROM orders WHERE o_orderkey % 7 = 0 ORDER BY o_orderkey LIMIT 50)""")
def write_report(spark, sf_dir):
    o, folder = table(spark, sf_dir, "orders"), sources.new_folder(spark, "report")
    counts = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    sources.write_report({"counts": counts}, folder, {"errors": (o.where("o_orderkey % 7 = 0").select("rec_idx"), ["rec_idx"])})
    return spark.read.schema("part string, total long, position int, row string").json(folder)


@query(r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS BIGINT) AS token_count, CASE WHEN len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) > 1000 THEN 'chunk' WHEN len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) > 300 THEN 'reject' ELSE 'whole' END AS route FROM documents""")
def size_gate(spark, sf_dir):
    return text.size_gate(spark.read.parquet(f"{sf_dir}/documents.parquet"), 1000, 300).select("doc_id", "token_count", "route")


@query(r"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> ''), chr(1)) AS sentences FROM documents""")
def split_sentences(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.array_join(S.split_sentences(F.col("text")), "\x01").alias("sentences"))


#: Text; first number; verified decimal; whole number to load; date to load. By the written rules, not by the operators.
_HARD = (
    ("0.125", "0.125", 0.125, None, None), ("1,471,000", "1471000", 1471000.0, 1471000, None), ("around 3.141 t", "3.141", 3.141, None, None), ("2,5.", "25", 2.5, None, None),
    ("12,5, then", "125", 12.5, None, None), ("1.471.000", "1471000", 1471000.0, None, None), ("5.7", "5.7", 5.7, None, None), ("1_000", "1", 1.0, 1000, None),
    ("-7", "-7", -7.0, -7, None), ("none", "none", None, None, None), ("12", "12", 12.0, 12, None), ("2023-05-01Z", "2023", 2023.0, None, "2023-05-01"),
    ("2030", "2030", 2030.0, 2030, "2030-01-01"), ("20230501", "20230501", 20230501.0, 20230501, "2023-05-01"), ("1,250 t", "1250", 1250.0, None, None), (" ", " ", None, None, None),
)
_LITERAL = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
_COERCED = f"""WITH hard(k, text, n, d, i, day) AS (VALUES {", ".join(f"({k}, {', '.join(map(_LITERAL, row))})" for k, row in enumerate(_HARD))})
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(o_orderkey AS BIGINT) AS digits, CAST(d AS DOUBLE) AS d, n, CAST(i AS BIGINT) AS i, day, CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS t,
CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS slashed, o_orderkey % 2 = 0 AS is_uuid, o_orderkey % 4 = 0 AS is_placeholder FROM orders JOIN hard ON k = o_orderkey % {len(_HARD)}"""


@query(_COERCED)
def coercions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    year, key = F.year("o_orderdate").cast("string"), F.col("o_orderkey").cast("string")
    hard = F.get(F.array(*[F.lit(row[0]) for row in _HARD]), (F.col("o_orderkey") % len(_HARD)).cast("int"))
    id_ = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(key, 12, "0"))).when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("{1F000000-0000-0000-0000-"), F.lpad(key, 12, "0"), F.lit("}"))).otherwise(key)
    return o.select(
        "o_orderkey",
        S.year_int(F.concat(F.lit("in "), year, F.lit(" or so"))).alias("y"),
        S.verified_int(F.concat(key, F.lit(" units"))).alias("digits"),
        S.verified_decimal(hard).cast("double").alias("d"),
        S.first_number(hard).alias("n"),
        S.coerce(hard, "long").alias("i"),
        S.coerce(hard, "date").cast("string").alias("day"),
        S.year_to_date_text(year).alias("t"),
        S.coerce(F.date_format("o_orderdate", "yyyy/MM/dd"), "date").cast("string").alias("slashed"),
        S.is_uuid(id_).alias("is_uuid"),
        S.is_placeholder_uuid(id_).alias("is_placeholder"),
    )


@query("""SELECT o_orderkey AS rec_idx, '{"key": ' || o_orderkey || ', "status": "' || o_orderstatus || '"}' AS json, sha256('{"key": ' || o_orderkey || ', "status": "' || o_orderstatus || '"}') AS key FROM orders""")
def canonical_json(spark, sf_dir):
    raw = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"), F.lit("x").alias("misc")))
    got = table(spark, sf_dir, "orders").select("rec_idx", H.canonical_json(raw, ("misc",)).alias("json"))
    return got.withColumn("key", S.content_key(F.col("json")))


@query(f"""SELECT o_orderkey AS rec_idx, {_uuid_sql(S.class_namespace('Order'), """ '{"key": ' || o_orderkey || '}id' """)} AS id FROM orders""")
def placeholder_ids(spark, sf_dir):
    spec = TableSpec("Order", "id", columns={"id": ("uuid", True)})
    df = table(spark, sf_dir, "orders").select("rec_idx", F.lit("bad").alias("id"), F.to_json(F.struct(F.col("o_orderkey").alias("key"))).alias("raw"))
    return H.fill_placeholder_ids(df, spec).select("rec_idx", "id")


@query("""SELECT p_partkey, substr(sha1(p_brand || '|' || lower(trim(p_name))), 1, 12) AS signature FROM part""")
def table_signature(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.table_signature(F.concat(F.lit("  "), "p_name"), F.col("p_brand")).alias("signature"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'aa11' WHEN p_partkey % 3 = 1 THEN 'bb22' END AS signature FROM part""")
def signature_from_notes(spark, sf_dir):
    m = F.col("p_partkey") % 3
    notes = F.when(m == 0, "see table_signature = aa11").when(m == 2, "table_signature = ff99")
    known = F.when(m == 1, F.array(F.lit("bb22"))).otherwise(F.array(F.lit("aa11"), F.lit("bb22")))
    return table(spark, sf_dir, "part").select("p_partkey", S.signature_from_notes(notes, known).alias("signature"))


@query("""SELECT p_partkey, p_name AS value_proof, 'kept' AS unit_proof FROM part""")
def merge_proofs(spark, sf_dir):
    misc = F.create_map(F.lit("unit_proof"), F.lit("kept"))
    got = S.merge_proofs(misc, F.create_map(F.lit("value"), F.col("p_name"), F.lit("unit"), F.col("p_brand")))
    return table(spark, sf_dir, "part").select("p_partkey", F.element_at(got, "value_proof").alias("value_proof"), F.element_at(got, "unit_proof").alias("unit_proof"))


@query("""SELECT p_brand AS stem, max(p_partkey) AS newest FROM part GROUP BY p_brand""")
def latest_documents(spark, sf_dir):
    from ..sources.tables import latest_documents as latest

    p = table(spark, sf_dir, "part")
    files = p.select(F.concat(F.lit("20240101_120000_"), "p_brand").alias("doc_id"), F.col("p_partkey").alias("modified"))
    return latest(files).select("stem", F.col("modified").alias("newest"))


# Tables of several documents, in each of which rows are numbered anew: (doc_id, rec_idx) is a row's identity.
_DOC = """ld AS (SELECT * EXCLUDE rec_idx, 'd' || l_orderkey % 7 AS doc_id, l_orderkey // 7 * 1000 + rec_idx % 1000 AS rec_idx FROM li)"""
_RUNS = {
    "orders": STAR["orders"],
    "lineitem": TableSpec("lineitem", "id", (Fk("l_orderkey", "orders"),), (("l_partkey", "l_linenumber"),)),
}


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items dealt to seven documents by their order."""
    li = table(spark, sf_dir, "lineitem")
    doc, number = F.concat(F.lit("d"), F.col("l_orderkey") % 7), F.floor(F.col("l_orderkey") / 7) * 1000 + F.col("rec_idx") % 1000
    return li.withColumns({"doc_id": doc, "rec_idx": number}).withColumn("id", F.concat_ws("/", "doc_id", "rec_idx"))


@query(f"""WITH {LI}, {_DOC}, f AS (SELECT doc_id, rec_idx, min((doc_id, rec_idx)) OVER (PARTITION BY l_partkey, l_linenumber) AS m FROM ld)
SELECT doc_id, rec_idx, m[1] AS first_doc_id, m[2] AS first, (doc_id, rec_idx) > m AS is_repeat FROM f""")
def flag_repeats_documents(spark, sf_dir):
    return quality.flag_repeats(runs(spark, sf_dir), ["l_partkey", "l_linenumber"]).select("doc_id", "rec_idx", "first_doc_id", "first", "is_repeat")


@query(f"""WITH {LI}, {_DOC}, o AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0), r AS (SELECT doc_id, rec_idx, l_orderkey IN (SELECT o_orderkey FROM o) AS fits, min((doc_id, rec_idx)) OVER (PARTITION BY l_partkey, l_linenumber) AS every,
min((doc_id, rec_idx)) FILTER (l_orderkey IN (SELECT o_orderkey FROM o)) OVER (PARTITION BY l_partkey, l_linenumber) AS inside FROM ld)
SELECT 'lineitem' AS "table", doc_id, rec_idx, CASE WHEN (doc_id, rec_idx) > every THEN 'duplicate l_partkey,l_linenumber' ELSE 'l_orderkey not in orders' END AS reason FROM r WHERE NOT fits OR (doc_id, rec_idx) > inside""")
def enforce_documents(spark, sf_dir):
    t = {"orders": table(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").drop("o_custkey"), "lineitem": runs(spark, sf_dir)}
    return load.enforce_constraints(t, _RUNS)[1].where("table = 'lineitem'").select("table", "doc_id", "rec_idx", "reason")


@query(f"""WITH {LI}, {_DOC}, g AS (SELECT *, count(*) OVER (PARTITION BY l_partkey, l_linenumber) AS n FROM ld),
x AS (SELECT doc_id, rec_idx, 0 AS kind, 'l_orderkey: value ' || l_orderkey || ' not found in orders' AS m FROM ld WHERE l_orderkey % 5 = 0
UNION ALL SELECT doc_id, rec_idx, 1, 'Duplicate unique key on (l_partkey, l_linenumber): l_partkey=' || l_partkey || ', l_linenumber=' || l_linenumber || '. Choose a different match if possible to make this combination unique.' FROM g WHERE n > 1)
SELECT doc_id, rec_idx, string_agg(m, ' ' ORDER BY kind) AS text FROM x GROUP BY ALL""")
def retry_feedback_documents(spark, sf_dir):
    lines = save(runs(spark, sf_dir).select("doc_id", "rec_idx", "l_orderkey", "l_partkey", "l_linenumber"), "line-items")  # numbered once, read by both reports
    t = {"orders": table(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").drop("o_custkey"), "lineitem": lines}
    groups = quality.duplicate_groups(t, {"lineitem": list(_RUNS["lineitem"].unique_keys)}, None)
    return linking.retry_feedback(quality.fk_issues(t, _RUNS), groups, _RUNS, {}).select("doc_id", "rec_idx", "text")


_OWN = S.class_namespace("lineitem")


@query(f"""WITH {LI}, {_DOC}, r AS (SELECT doc_id, rec_idx, CAST(l_orderkey AS VARCHAR) AS seed, row_number() OVER (PARTITION BY l_orderkey ORDER BY doc_id, rec_idx) AS j, count(*) OVER (PARTITION BY l_orderkey) AS m FROM ld),
e AS (SELECT {_uuid_sql(_OWN, "o_orderkey || 'id'")} AS k FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT {_uuid_sql(_OWN, "o_orderkey || '|3id'")} FROM orders WHERE o_orderkey % 5 = 0),
t AS (SELECT DISTINCT seed, unnest(generate_series(1, m + 2)) AS n FROM r), k AS (SELECT seed, n, {_uuid_sql(_OWN, "CASE WHEN n = 1 THEN seed ELSE seed || '|' || n END || 'id'")} AS k FROM t),
f AS (SELECT seed, k, row_number() OVER (PARTITION BY seed ORDER BY n) AS j FROM k WHERE k NOT IN (SELECT k FROM e)) SELECT doc_id, rec_idx, k AS id FROM r JOIN f USING (seed, j)""")
def assign_pk_existing(spark, sf_dir):
    """Keys where some that would be generated are stored already: the next ones that are free."""
    o, space = table(spark, sf_dir, "orders"), S.class_namespace("lineitem")
    stored = lambda part, end: o.where(part).select(S.uuid5(space, F.concat(F.col("o_orderkey").cast("string"), F.lit(end))).alias("id"))
    existing = stored("o_orderkey % 3 = 0", "id").unionByName(stored("o_orderkey % 5 = 0", "|3id"))
    df = runs(spark, sf_dir).select("doc_id", "rec_idx", F.lit(None).cast("string").alias("id"), F.col("l_orderkey").cast("string").alias("seed"))
    return identity.assign_pk(df, "lineitem", "id", existing=existing).select("doc_id", "rec_idx", "id")


@query("""WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, 'b' || o_orderkey % 3 AS batch FROM orders WHERE o_custkey % 7 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY batch, o_orderkey) AS n FROM o) SELECT o_orderkey, batch FROM r WHERE n = 1""")
def load_against_store(spark, sf_dir):
    """Three batches of orders, each checked against what the store holds: customers of the first, keys of all before; the second comes twice."""
    specs = {"customer": TableSpec("customer", "c_custkey"), "orders": TableSpec("orders", "o_orderkey", (Fk("o_custkey", "customer"),), (("o_custkey", "o_orderpriority"),))}
    store, o = Store(spark, sources.new_folder(spark, "store"), specs, buckets=8), table(spark, sf_dir, "orders")
    for k in (0, 1, 1, 2):
        tables = {"orders": o.where(F.col("o_orderkey") % 3 == k).withColumn("doc_id", F.lit(f"b{k}"))}
        if k == 0:
            tables["customer"] = table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0")
        load.load_batch(store, f"b{k}", tables)
    return store.read("orders").select("o_orderkey", "batch")


@query("""WITH RECURSIVE t AS (SELECT r_regionkey AS id, NULL AS parent FROM region UNION ALL SELECT 100 + n_nationkey, n_regionkey FROM nation
UNION ALL SELECT 1000 + c_custkey, CASE WHEN c_custkey % 9 = 0 THEN -1 ELSE 100 + c_nationkey END FROM customer UNION ALL SELECT 10000000 + s_suppkey, 10000000 + s_suppkey + CASE WHEN s_suppkey % 2 = 0 THEN -1 ELSE 1 END FROM supplier WHERE s_suppkey < 2 * (SELECT count(*) // 2 FROM supplier)
UNION ALL SELECT 20000000 + o_orderkey, CASE WHEN o_orderkey % 64 > 0 THEN 20000000 + o_orderkey - 1 END FROM orders),
ids AS (SELECT id FROM t), w AS (SELECT id, 0 AS level, [id] AS path FROM t WHERE parent IS NULL OR parent NOT IN (SELECT id FROM ids) UNION ALL SELECT t.id, w.level + 1, list_append(w.path, t.id) FROM t JOIN w ON t.parent = w.id)
SELECT t.id, row_number() OVER (ORDER BY w.level NULLS LAST, w.path, t.id) - 1 AS "order" FROM t LEFT JOIN w USING (id)""")
def topo_order(spark, sf_dir):
    """The forest of ``topo_sort`` in the order of a breadth-first walk."""
    return quality.topo_sort(_forest(spark, sf_dir), "id", "parent")[0].select("id", "order")


@query(f"""WITH p AS (SELECT p_partkey % 50 AS doc_id, p_partkey, {_TOKENS.format("p_type || ' ' || p_brand")} AS l FROM part), r AS (SELECT p_partkey AS rec_idx, p_partkey % 50 AS doc_id, {_TOKENS.format("p_brand || ' ' || p_name")} AS t FROM part),
s AS (SELECT rec_idx, CAST(p_partkey AS VARCHAR) AS id, 2 * len(list_intersect(t, l)) / (len(t) + len(l)) AS score FROM r JOIN p USING (doc_id) WHERE len(list_intersect(t, l)) > 0)
SELECT r.rec_idx, x.id AS linked_id FROM r LEFT JOIN (SELECT rec_idx, id, row_number() OVER (PARTITION BY rec_idx ORDER BY score DESC, id) AS n FROM s WHERE score >= 0.2) x ON x.rec_idx = r.rec_idx AND n = 1""")
def link_scored(spark, sf_dir):
    """``link_candidates`` with a scorer of one's own, by bounds."""
    p = table(spark, sf_dir, "part").withColumn("doc_id", F.col("p_partkey") % 50)
    records = p.select("doc_id", "rec_idx", F.concat_ws(" ", "p_brand", "p_name").alias("text"))
    options = p.select("doc_id", F.col("p_partkey").cast("string").alias("id"), F.concat_ws(" ", "p_type", "p_brand").alias("label"))
    return linking.link_fk(records, options, scorer=lambda shared, own, option: 2 * shared / (own + option)).select("rec_idx", "linked_id")


@query()
def retry_links(spark, sf_dir):
    """Parts linked to a part of their brand that isn't there or that others have too, linked anew: no option twice."""
    p = table(spark, sf_dir, "part").withColumn("doc_id", F.col("p_partkey") % 50)
    records = p.select("doc_id", "rec_idx", F.when(F.col("p_partkey") % 3 > 0, F.concat("p_brand", F.lit("-"), F.col("p_partkey") % 2)).otherwise(F.col("p_partkey").cast("string")).alias("link"), "p_brand", "p_name")
    options = p.where("p_partkey % 4 > 0").select("doc_id", F.col("p_partkey").cast("string").alias("id"), F.concat_ws(" ", "p_type", "p_brand").alias("label"))
    scored = linking.link_sets(records.select("doc_id", "rec_idx", F.concat_ws(" ", "p_brand", "p_name").alias("text")), options)
    return linking.retry_links(records.select("doc_id", "rec_idx", "link"), "link", scored, options.select("id"), ())[0]


@query(f"""WITH b AS (SELECT item_id, text AS quote FROM benchmark) SELECT doc_id, item_id, contains({_NORM.format('d.text')}, {_NORM.format('quote')}) AS found FROM documents d, b""")
def quotes_scanned(spark, sf_dir):
    """Every passage of the benchmark in every document, whose text is scanned once for all of them."""
    d, b = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    return evidence.quotes_in_all(b.select("item_id", F.col("text").alias("quote")), d).select("doc_id", "item_id", "found")


@query("""SELECT 'orders' AS "table", count(*) FILTER (s) AS source_count, count(*) FILTER (t) AS target_count, count(*) FILTER (s AND t) AS matched, count(*) FILTER (s AND NOT t) AS missing, count(*) FILTER (t AND NOT s) AS extra,
count(*) FILTER (s AND NOT t) = 0 AS ok, false AS shared, true AS read_less FROM (SELECT o_orderkey % 499 <> 0 AS s, o_orderkey % 997 <> 0 AS t FROM orders)""")
def reconcile_store(spark, sf_dir):
    """Two batches of orders in a store, of which few are missing or more than in the source: digests tell where."""
    specs = {"orders": TableSpec("orders", "o_orderkey")}
    store, o = Store(spark, sources.new_folder(spark, "store"), specs, buckets=8), table(spark, sf_dir, "orders")
    for k in (0, 1):
        load.load_batch(store, f"b{k}", {"orders": o.where(f"o_orderkey % 2 = {k} AND o_orderkey % 997 <> 0")})
    got = load.reconcile_store({"orders": o.where("o_orderkey % 499 <> 0")}, store)
    return got.withColumn("read_less", F.col("compared") < F.col("target_count")).drop("compared")


@query()
def chunk_encoded(spark, sf_dir):
    """Chunks of up to 200 tokens of a registered encoding."""
    counter = H.register_encoding("byte_bpe_50k", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return text.chunk_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), 200, 20, counter).select("doc_id", "chunk_index", "token_count", "start_line", "end_line")
