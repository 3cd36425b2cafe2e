"""Readers, writers, exports, model storage and the stream."""

import json
from datetime import date as D

import pytest
from pyspark.sql import functions as F

from panelkit.operators import models
from panelkit.sources import readers, writers
from panelkit.streaming.arms import arm_stats, arm_stats_stream, arm_ucb
from tests.conftest import rows


def test_dirty_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;d;v;flag;note\n1;2014/07/31;-99;\\1;NULL\n2;2014-07-30;x;\\0; \n3;19790800;7;NULL;ok;extra;cells\n')
    out = readers.read_csv(spark, str(tmp_path / "a.csv"), "id int, d date, v int, flag boolean, note string", sep=";", sentinels=(-99,), bits=("flag",), keep_corrupt=True)
    got = [tuple(r)[:5] for r in out.orderBy("id").collect()]
    assert got == [(1, D(2014, 7, 31), None, True, None), (2, D(2014, 7, 30), None, False, None), (3, None, 7, None, "ok")]
    assert [r["id"] for r in out.select("id", readers.CORRUPT).collect() if r[readers.CORRUPT]] == [3]
    odd = spark.createDataFrame([("0.448***", 19790800), ("?0.025", 19270618)], "s string, n int")
    assert rows(odd.select(readers.starred_number("s"), readers.star_level("s"), readers.compact_date("n"))) == [(-0.025, 0, D(1927, 6, 18)), (0.448, 3, None)]


def test_csv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "b.csv").write_text("b,a\n1,x\n2,y\n")
    assert rows(readers.read_csv(spark, str(tmp_path / "b.csv"), "a string, b int")) == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "b.csv"), "a string, c int")


def test_csv_tsv_json_parquet_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, s string")
    writers.write_csv_single(df, f"{tmp_path}/csv")
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    assert rows(readers.read_csv(spark, f"{tmp_path}/csv", "id int, s string")) == rows(df)
    (tmp_path / "r.tsv").write_text('Review\tLiked\n"Wow" it\t1\n')
    assert rows(readers.read_tsv(spark, f"{tmp_path}/r.tsv", "Review string, Liked int")) == [('"Wow" it', 1)]
    writers.write_json(df, f"{tmp_path}/json")
    assert rows(readers.read_json(spark, f"{tmp_path}/json", "id int, s string", multi_line=False)) == rows(df)
    (tmp_path / "list.json").write_text(json.dumps([{"id": 1, "s": "a"}, {"id": 2, "s": "b"}]))
    assert rows(readers.read_json(spark, f"{tmp_path}/list.json", "id int, s string")) == [(1, "a"), (2, "b")]
    writers.write_parquet(df, f"{tmp_path}/p/t.parquet", files=1)
    writers.copy_table(spark, f"{tmp_path}/p/t.parquet", f"{tmp_path}/p/u.parquet")
    assert rows(readers.read_table(spark, f"{tmp_path}/p", "u")) == rows(df) == rows(readers.sql_scan(spark, f"{tmp_path}/p/t.parquet"))
    (tmp_path / "b.txt").write_text("milk\tbread\n\n")
    assert [r[0] for r in readers.read_transactions(spark, f"{tmp_path}/b.txt").collect()] == [["milk", "bread"], [""]]


def test_triples_and_rules_export(spark, tmp_path):
    df = spark.createDataFrame([("k1", 'say "hi"', 3), (None, "lost", 1), ("k2", None, 5)], "id string, name string, n int")
    out = writers.to_triples(df, "id", {"name": ("p/name", "xsd:string"), "n": ("p/n", "xsd:int")}, "b/")
    assert rows(out) == [("b/k1", "p/n", "3", "xsd:int"), ("b/k1", "p/name", 'say "hi"', "xsd:string"), ("b/k2", "p/n", "5", "xsd:int")]
    assert writers.count_keyless(df, "id").first()[0] == 1
    writers.write_triples(out, f"{tmp_path}/nt")
    assert '<b/k1> <p/name> "say \\"hi\\""^^<xsd:string> .' in [r[0] for r in spark.read.text(f"{tmp_path}/nt").collect()]
    rule = spark.createDataFrame([(["a"], ["b"], 0.5, 0.25, 1.0), ([], ["b"], 0.5, 0.5, 1.0)],
                                 "items_base array<string>, items_add array<string>, support double, confidence double, lift double")
    writers.export_rules(rule, f"{tmp_path}/tsv", "tsv")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/tsv").collect()] == ["a\tb\t0.50000000\t0.25000000\t1.00000000"]
    writers.export_rules(rule, f"{tmp_path}/rj")
    assert spark.read.json(f"{tmp_path}/rj").count() == 2
    with pytest.raises(ValueError):
        writers.export_rules(rule, f"{tmp_path}/x", "xml")


def test_model_storage_and_jdbc_options(spark, tmp_path):
    df = spark.range(40).select((F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("a"), F.rand(1).alias("b"))
    model = models.tree_fit(df, "y", ["a", "b"], "tree")
    writers.save_model(model, ["a", "b"], f"{tmp_path}/m")
    again, cols = writers.load_model(spark, f"{tmp_path}/m")
    assert cols == ["a", "b"] and rows(again.transform(df).select("a", "prediction")) == rows(model.transform(df).select("a", "prediction"))
    segment = models.leaf_id(again, df, F.lit("S"))
    assert rows(segment.select("a", "micro_segment")) == rows(models.leaf_id(model, df, F.lit("S")).select("a", "micro_segment"))
    assert writers.jdbc_options("jdbc:x", "t", user="u") == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    with pytest.raises(ValueError):
        writers.jdbc_options("http://x", "t")


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    def put(name, data):
        spark.createDataFrame(data, "arm string, hit int").coalesce(1).write.parquet(f"{tmp_path}/in/{name}.parquet")

    put("a", [("x", 1), ("x", 0), ("y", 1)])
    schema = spark.read.parquet(f"{tmp_path}/in/a.parquet").schema
    run = lambda: rows(arm_stats_stream(spark, f"{tmp_path}/in/*.parquet", schema, "arm", F.col("hit"), f"{tmp_path}/out", f"{tmp_path}/state"))
    assert run() == [("x", 2, 1, 0.5, 2, 2), ("y", 1, 1, 1.0, 2, 1)]
    put("b", [("y", 0)])
    assert run() == [("x", 2, 1, 0.5, 2, 2), ("y", 2, 1, 0.5, 2, 2)] == rows(arm_stats(spark.read.parquet(f"{tmp_path}/in/*.parquet"), "arm", F.col("hit")))
    first = arm_ucb(spark.read.parquet(f"{tmp_path}/in/*.parquet"), "arm", F.col("hit"), ["x", "y", "z"]).first()
    assert first["arm"] == "z" and first["upper_bound"] == float("inf")
