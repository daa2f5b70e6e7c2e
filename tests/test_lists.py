"""List files cut by byte ranges against Python's json."""

import json
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerleaf.sources import lists, tables


def value(r, deep):
    kind = r.randrange(9 if deep else 6)
    if kind < 3:
        return "".join(r.choice('ab,"\\[]{}: \nß😀') for _ in range(r.randrange(12)))
    if kind < 6:
        return r.choice([None, True, 0, -7, 2.5, 1e30])
    if kind == 6:
        return [value(r, deep - 1) for _ in range(r.randrange(4))]
    return {f"k{i},": value(r, deep - 1) for i in range(r.randrange(4))}


@pytest.mark.parametrize("size", ["53b", "400b", "128m"])
def test_lists_in_byte_ranges(spark, tmp_path, size):
    r = random.Random(5)
    files = {f"d{k}": [value(r, 3) for _ in range(n)] for k, n in enumerate([0, 1, 2, 60, 250])}
    for name, rows in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "T.json").write_text(json.dumps(rows, indent=r.choice([None, 2]), ensure_ascii=r.random() < 0.5), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = tables.read_table(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = {(x.doc_id, x.rec_idx): None if x.raw is None else json.loads(x.raw) for x in got}
    assert len(found) == len(got)
    assert found == {(name, i): v for name, rows in files.items() for i, v in enumerate(rows)}


def test_texts_stay_as_written(spark, tmp_path):
    (tmp_path / "T.json").write_text('[ {"a" : 1.10, "b": 12345678901234567890123}, "x" , 1e2 ]')
    assert [x.raw for x in tables.read_table(spark, f"{tmp_path}/T.json").orderBy("rec_idx").collect()] == ['{"a" : 1.10, "b": 12345678901234567890123}', '"x"', "1e2"]


def test_what_is_no_list(spark, tmp_path):
    broken = ["", " ", "{}", "1", "[1", "1]", "[1]]", "[1],[2]", "[1][2]", "[1] x", "[1,]", "[,1]", "[1,,2]", '["a]', '[{"a": 1]', "[{]}", "[nul]", "[1 2]", "[[1], 2", "x[1]"]
    for k, text in enumerate(broken):
        (tmp_path / f"b{k}").mkdir()
        (tmp_path / f"b{k}" / "T.json").write_text(text)
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "T.json").write_text(" [ 1 , [2, 3] ]\n")
    got = tables.read_table(spark, str(tmp_path), on_corrupt="empty").orderBy("doc_id", "rec_idx").collect()
    assert [(x.doc_id, x.rec_idx, x.raw) for x in got] == [("good", 0, "1"), ("good", 1, "[2, 3]")]
    bad = tables.list_elements(spark, str(tmp_path)).where("NOT ok").select(F.element_at(F.split("file", "/"), -2).alias("d")).distinct().collect()
    assert {x.d for x in bad} == {f"b{k}" for k in range(1, len(broken))}  # a file of no bytes isn't read
    with pytest.raises(Exception, match="no JSON list"):
        tables.read_table(spark, f"{tmp_path}/b2/T.json").count()


def test_no_task_sorts_a_whole_range(spark, tmp_path):
    (tmp_path / "d").mkdir()
    rows = [{"k": i, "t": 'a,"]'} for i in range(7000)]
    (tmp_path / "d" / "T.json").write_text(json.dumps(rows))
    sizes = [r["count"] for r in lists._pieces(spark, str(tmp_path)).groupBy(*lists.RANGE).count().collect()]
    assert max(sizes) <= 4096 and sum(sizes) == 21000  # one range of the file
    got = tables.read_table(spark, str(tmp_path)).orderBy("rec_idx").collect()
    assert [json.loads(x.raw) for x in got] == rows and [x.rec_idx for x in got] == list(range(7000))


SPILLING = """
import sys
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{sys.argv[1]}/shared").config("spark.driver.memory", "2g").config("spark.shuffle.spill.numElementsForceSpillThreshold", "200").getOrCreate()
import __spark_entry__
got = __spark_entry__.queries()["read_lists"](s, "/root/testdata/sf0.001")
want = s.read.parquet("/root/testdata/sf0.001/orders.parquet").selectExpr("'list=' || ascii(o_orderpriority) AS doc_id", "row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1L AS rec_idx", "o_orderkey")
assert sorted(got.select("doc_id", "rec_idx", "o_orderkey").collect()) == sorted(want.collect())
"""


def test_lists_are_written_in_order_where_sorts_spill(tmp_path):
    done = subprocess.run([sys.executable, "-c", SPILLING, str(tmp_path)], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
