"""Edge cases that the driver's tables do not show: NULL, NaN, ties, errors, concurrent commits, pruning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.functions import aggregates as G
from spillway.functions import arrays as A
from spillway.functions import jsonx as J
from spillway.functions import mathx as M
from spillway.functions import rowvalue as R
from spillway.functions import strings as S
from spillway.functions import temporal as D
from spillway.operators import relational as O
from spillway.operators import writes as W
from spillway.operators.export import export_parquet
from spillway.operators.tiered import Node, Partition, Store, TieredStore, TierError, align
from spillway.plans.command import capture
from spillway.queries import QUERIES
from spillway.sources import dynamic, files
from spillway.sources.snapshots import ConcurrentCommit, VersionedTable
from spillway.types import inspect, store_name


def one(spark, *exprs):
    return spark.range(1).select(*exprs).first()


def test_strings(spark):
    rows = spark.createDataFrame([(1, "Alpha"), (2, "alpha"), (3, "A%c"), (4, "A_c"), (5, "$cash"), (6, "%lead"), (7, None)], "id int, name string")
    found = lambda cond: [r.id for r in rows.filter(cond).orderBy("id").collect()]
    assert found(S.search_ci(F.col("name"), "%")) == [3, 6]
    assert found(S.search_ci(F.col("name"), "a_C")) == [4]
    assert found(S.search_ci(F.col("name"), "$CASH", "starts")) == [5]
    assert found(~S.contains(F.col("name"), "lpha")) == [3, 4, 5, 6, 7]
    x = F.lit("left|middle|right")
    assert tuple(one(spark, S.split_part(x, "|", 2), S.split_part(x, "|", 0), S.split_part(x, "|", 9), S.split_part(x, "|", -1))) == ("middle", "", "", "right")
    assert tuple(one(spark, S.index_of(x, "zz"), S.index_of(x, "zz", 3), S.index_of(x, "e", 2))) == (-1, 2, 10)
    assert one(spark, S.join("-", F.lit(None).cast("string"), F.lit("b")))[0] == "-b"


def test_math(spark):
    nan, neg = F.lit(float("nan")), F.lit(-1.0)
    assert tuple(one(spark, M.unary("sqrt", neg), M.no_nan(nan), M.log(F.lit(0.0)), M.log(neg), M.atanh(F.lit(2.0)))) == (None, None, float("-inf"), None, None)
    assert tuple(one(spark, M.to_int(F.lit(2.5)), M.to_int(F.lit(3.5)), M.to_int(F.lit(2.7)))) == (2, 4, 3)
    assert tuple(one(spark, M.trunc(F.lit(-2.7)), M.round_to(F.lit(-2.5)), M.shift_left(F.lit(-1), 2))) == (-2.0, -3.0, None)
    assert M.quotient_type(18, 3, 18, 3) == (38, 20) and M.quotient_type(5, 2, 5, 2) == (13, 8)
    a, b = F.lit(1).cast("decimal(18,3)"), F.lit(3).cast("decimal(18,3)")
    assert float(one(spark, F.round(M.divide_decimal(a, b), 3))[0]) == 0.333


def test_temporal(spark):
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, D.diff("hours", t("2024-01-01 11:00:00"), t("2024-01-01 10:59:59")))[0] == 1.0
    assert one(spark, D.diff("days", t("2024-01-01 00:00:00"), t("2024-01-02 23:00:00")))[0] == -1.0
    assert one(spark, D.add_months(t("2024-01-31 00:00:00"), 1))[0] == dt.datetime(2024, 2, 29)
    assert one(spark, D.millisecond(t("2024-01-01 00:00:05.123")), D.millisecond_in_minute(t("2024-01-01 00:00:05.123"))) == (123, 5123)
    assert one(spark, D.day_of_week(F.lit("2024-01-07").cast("date")))[0] == 0


def test_arrays_json_rows(spark):
    a = F.array(F.lit(None).cast("int"), F.lit(3), F.lit(1), F.lit(3))
    assert tuple(one(spark, A.contains(a, 9), A.contains(a, 3), A.distinct(a), A.element(a, 9), A.skip(a, 2), A.skip(a, 9))) == (False, True, [1, 3], None, [1, 3], [])
    assert one(spark, J.value(F.lit('{"a.b": [1, 2]}'), "a.b", 1, kind="int"))[0] == 2
    with pytest.raises(ValueError):
        J.path("it's")
    null = F.lit(None).cast("int")
    assert one(spark, R.compare([F.lit(1), null], "<", [1, 2]))[0] is None
    assert one(spark, R.compare([F.lit(0), null], "<", [1, 2]))[0] is True
    with pytest.raises(ValueError):
        R.equal([F.lit(1)], [1, 2])


def test_aggregates(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "id int, label string, v int")
    assert tuple(df.agg(G.arg_max(F.col("label"), F.col("v")), G.arg_min(F.col("label"), F.col("v")), G.stddev_sample(F.col("v")), G.arg_max(F.col("label"), F.col("v"), F.col("v") < 20)).first()) == ("b", "a", 10.0, "a")
    assert df.filter("v > 99").agg(G.total(F.col("v"), "bigint", or_zero=True)).first()[0] == 0
    assert O.scalar_terminal(df.filter("v > 99"), "sum", "v") == 0
    with pytest.raises(ValueError):
        O.scalar_terminal(df.filter("v > 99"), "max", "v")
    with pytest.raises(ValueError):
        O.single(df)
    assert [r.id for r in O.order_by(df, "label").collect()] == [1, 2, 3] and O.last(df, ["id"]).id == 3 and O.element_at(df, ["id"], 1).id == 2


def test_not_in_with_null(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert O.not_in(a, "x", spark.createDataFrame([(1,), (None,)], "y int"), "y").count() == 0
    assert [r.x for r in O.not_in(a, "x", spark.createDataFrame([(1,)], "y int"), "y").collect()] == [2]


def test_types():
    assert inspect("INT8").spark == T.LongType() and inspect("INTEGER[]").kind == "ScalarProperty" and inspect("INTEGER[3]").kind == "RawReaderOnly"
    assert inspect("STRUCT(a INTEGER, b STRUCT(c VARCHAR))").kind == "ComplexProperty" and inspect("MAP(VARCHAR, INTEGER)").kind == "RawReaderOnly"
    assert inspect("DECIMAL(10,2)").spark == T.DecimalType(10, 2) and inspect("MYINTEGER").spark == T.LongType() and inspect("WHAT").kind == "Unsupported"
    assert store_name(T.ArrayType(T.IntegerType())) == "INTEGER[]"


def test_file_sources(spark, tmp_path):
    p = tmp_path / "data'quoted.csv"
    p.write_text("Id\n1\n2\n3\n4\n")
    assert files.scan_csv(spark, str(p), "Id int").count() == 4
    (tmp_path / "a.json").write_text('[{"Id":10},{"Id":20},{"Id":30}]')
    (tmp_path / "b.json").write_text('{"Id":10}\n{"Id":20}\n')
    assert files.scan_json(spark, str(tmp_path / "a.json"), "Id int").count() == 3 and files.scan_json(spark, str(tmp_path / "b.json"), "Id int").count() == 2
    with pytest.raises(ValueError):
        files.register_table_function("a.b.c", None)
    with pytest.raises(LookupError):
        files.scan_function(spark, "nope", "x")
    result = dynamic.query(spark, "SELECT 1 AS a, 'x' AS b")
    assert [c[:2] for c in result.columns] == [("a", "INTEGER"), ("b", "VARCHAR")] and len(list(result.rows())) == 1
    with pytest.raises(RuntimeError):
        list(result.rows())


def test_export_rules(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "a", (1,))], "id int, v int, c string, s struct<x:int>")
    for bad in (["nope"], ["s"], ["c", "c"]):
        with pytest.raises(ValueError):
            export_parquet(df, str(tmp_path / "o"), bad)
    export_parquet(df, str(tmp_path / "o"), ["c"])
    with pytest.raises(Exception, match="exists"):
        export_parquet(df, str(tmp_path / "o"), ["c"])


def test_upserts(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, n int")
    s = spark.createDataFrame([(1, "x", 9, 0), (2, "y", 9, 1), (3, "z", 9, 2), (3, "w", 8, 3)], "id int, name string, n int, at int")
    assert sorted(W.upsert(t, s, ["id"], "at").collect()) == [(1, "x", 9), (2, "y", 9), (3, "w", 8)]
    assert sorted(W.upsert(t, s, ["id"], "at", update=["name"]).collect()) == [(1, "x", 1), (2, "y", 2), (3, "w", 8)]
    keys = spark.createDataFrame([(2,), (3,), (3,)], "id int").withColumn("at", F.monotonically_increasing_id())
    assert sorted(r.id for r in W.upsert(t.select("id"), keys, ["id"], "at").collect()) == [1, 2, 3]
    with pytest.raises(W.CardinalityError):
        W.upsert_merge(t.union(t), s.drop("at"), ["id"])
    with pytest.raises(ValueError):
        W.rows_frame(spark, [{"id": 1}], t.schema)


def test_snapshots(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    df = spark.range(3)
    table.overwrite(df, at=1.0)
    table.append(df, at=2.0)
    assert (table.read().count(), table.read(snapshot=1).count(), table.read(timestamp=1.5).count()) == (6, 3, 3)
    with pytest.raises(ConcurrentCommit):
        table.overwrite(df, base=1)
    with pytest.raises(ValueError):
        table.read(snapshot=1, timestamp=1.0)
    pinned = VersionedTable(spark, table.path, pinned=1)
    assert pinned.read().count() == 3
    with pytest.raises(PermissionError):
        pinned.append(df)
    with pytest.raises(LookupError):
        table.read(timestamp=0.5)
    with pytest.raises(W.AffectedRowsError):
        W.publish(table, df, 2, expected_rows=4)


def test_tier(spark, tmp_path):
    rows = [(1, 10, "2024-01-15"), (2, 10, "2024-02-01"), (3, 10, None), (4, 20, "2024-03-15")]
    roots = spark.createDataFrame(rows, "id int, grp int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    parts = spark.createDataFrame([(1, 1, "x"), (2, 1, "y"), (3, 1, "z"), (4, 1, "u")], "rid int, no int, t string")
    store = TieredStore(spark, Store(Node("r", ("id",)), "at", f"file://{tmp_path}/tier", "month", (Partition("grp", alias="root_group"), Partition("at", "month")), (Node("p", ("rid", "no"), "r", (("rid", "id"),)),)))
    tables = {"r": roots, "p": parts}
    store.archive(tables, dt.datetime(2024, 3, 9))
    assert store.watermark() == dt.datetime(2024, 3, 1)
    hot = store.delete_hot(tables)
    assert sorted(r.id for r in hot["r"].collect()) == [3, 4] and sorted(r.rid for r in hot["p"].collect()) == [3, 4]
    assert sorted(store.view_root(hot["r"]).collect()) == sorted(roots.collect()) or store.view_root(hot["r"]).count() == 4
    assert sorted(store.view_child("p", hot).collect()) == sorted(parts.collect())
    plan = store.cold(bounds=[("at", "<", dt.datetime(2024, 2, 1)), ("grp", "=", 10)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "root_group" in plan
    with pytest.raises(TierError):
        store.archive(tables, dt.datetime(2024, 1, 1))
    with pytest.raises(TierError):
        store.archive({"r": roots.withColumn("grp", F.lit(5)), "p": parts}, dt.datetime(2024, 4, 1))
    with pytest.raises(ValueError):
        Store(Node("r", ("id",)), "at", "x", "month", (Partition("grp"),))
    assert align(dt.datetime(2024, 5, 9, 3), "day") == dt.datetime(2024, 5, 9)


def test_tier_publishes_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    from spillway.sources import fs

    roots = spark.createDataFrame([(i, f"2024-0{1 + i % 5}-10") for i in range(20)], "id int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    store = TieredStore(spark, Store(Node("r", ("id",)), "at", f"file://{tmp_path}/tier"))
    store.archive({"r": roots}, dt.datetime(2024, 2, 1))
    before, real = store.control(), fs.publish_text

    def killed(spark, path, text):
        fs.write_text(spark, path + ".0.tmp", text)  # the first step is done, the second is not
        raise OSError("killed")

    monkeypatch.setattr(fs, "publish_text", killed)
    with pytest.raises(OSError, match="killed"):
        store.archive({"r": roots}, dt.datetime(2024, 4, 1))
    assert store.control() == before and store.cold().count() == 4 and [g["state"] for g in store.inventory()] == ["active", "candidate"]
    # Two runs from one state: one publishes.
    monkeypatch.setattr(fs, "publish_text", lambda spark, path, text: (real(spark, path, "{}"), real(spark, path, text)))
    with pytest.raises(TierError, match="first"):
        store.archive({"r": roots}, dt.datetime(2024, 4, 1))
    fs.delete(spark, store._control_path(2))
    monkeypatch.setattr(fs, "publish_text", real)
    after = store.archive({"r": roots}, dt.datetime(2024, 4, 1))
    assert set(before.files["r"]) < set(after.files["r"]) and store.cold().count() == 12
    assert sorted(r.id for r in store.key_index().collect()) == sorted(r.id for r in store.cold().collect())
    kept = [f for f in after.files["r"] if "tier_month=2024-01" not in f]
    assert store.purge_older_than(dt.datetime(2024, 2, 20)) == 4 and store.control().files["r"] == kept and store.key_index().count() == 8
    with pytest.raises(TierError):
        store.scope()
    with pytest.raises(TierError):
        store.scope(keys=spark.range(1))
    other = TieredStore(spark, Store(Node("s", ("id",)), "at", f"file://{tmp_path}/tier"))
    fs.write_text(spark, store._marker("x"), '{"store": "r"}')
    with pytest.raises(TierError, match="begun"):
        other.inventory()


def test_table_logs(spark, tmp_path, monkeypatch):
    from spillway.sources import fs, snapshots

    monkeypatch.setattr(snapshots, "CHECKPOINT", 3)
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    rows = spark.range(40).select(F.col("id").cast("int"), F.lit("a").alias("v"))
    table.overwrite(rows.repartitionByRange(4, "id"), at=1.0)
    for i in range(6):
        table.append(rows.limit(1).select(F.lit(100 + i).alias("id"), F.lit("b").alias("v")), at=2.0 + i)
    assert table._numbers("checkpoint") == [3, 6] and [len(table.files(i)) for i in (1, 2, 7)] == [4, 5, 10]
    assert table.read(snapshot=4).count() == 43 and table.as_of(4.5).id == 4
    base = table.current()
    made = W.merge_into(table, spark.createDataFrame([(3, "x"), (100, "y"), (999, "z")], "id int, v string"), ["id"])
    assert len(made.removed) == 2 and set(table.files(base.id)) - set(made.removed) <= set(table.files(made.id))
    assert {r.id: r.v for r in table.read().filter("v not in ('a', 'b')").collect()} == {3: "x", 100: "y", 999: "z"} and table.read().count() == 47
    assert W.update_rows(table, F.col("id") > 1000, {"v": F.lit("q")}) == 0 and table.newest() == made.id
    with pytest.raises(W.AffectedRowsError):
        W.delete_rows(table, F.col("id") >= 100, expected=1)
    assert W.delete_rows(table, F.col("id") >= 100, expected=7) == 7
    table.set_message(1, "first", "me")
    assert table.expire(keep_last=2, dry_run=False) == list(range(1, made.id))
    assert [s.id for s in table.snapshots()] == [made.id, made.id + 1] and table.snapshots(expired=True)[0].message == "first"
    assert table.read().count() == 40 and table.cleanup_old_files(dry_run=False) and table.read().count() == 40
    with pytest.raises(LookupError):
        table.read(snapshot=2)
    with pytest.raises(FileExistsError):
        fs.publish_text(spark, table._log(1), "{}")
    table.compact(file_bytes=1 << 30)
    assert len(table.files(table.newest())) == 1 and table.read().count() == 40


def test_upsert_needs_single_keys(spark):
    t = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(Exception, match="not unique"):
        W.upsert(t, spark.createDataFrame([(2, "x"), (2, "y")], "id int, v string"), ["id"]).collect()
    assert sorted(tuple(r) for r in W.upsert(t, spark.createDataFrame([(None, "x"), (None, "y")], "id int, v string"), ["id"]).collect() if r.id) == [(1, "a")]
    ties = spark.createDataFrame([(1, "b", 5), (1, "c", 5)], "id int, v string, at int")
    assert {W.last_wins(ties.orderBy(F.rand()), ["id"], "at").first().v for _ in range(4)} == {"c"}


def test_exact_division_and_joins(spark):
    from spillway.operators.joins import asof_join, range_join

    assert one(spark, M.divide_int(F.lit(9007199254740993), F.lit(1)), M.divide_int(F.lit(-7), F.lit(2)), M.divide_int(F.lit(1), F.lit(0))) == (9007199254740993, -3, None)
    left = spark.createDataFrame([("a", 1), ("a", 9), ("a", 25), (None, 9), ("b", 3)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 9, "y"), (None, 1, "n"), ("b", 4, "z")], "k string, rt int, v string")
    want = [(None, 9, None), ("a", 1, None), ("a", 9, "y"), ("a", 25, "y"), ("b", 3, None)]
    for bucket in (None, F.floor(F.col("__at") / 5)):
        got = asof_join(left, right, ["k"], "t", "rt", ["v"], bucket).select("k", "t", "v").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    points, ranges = spark.range(30).select(F.col("id").cast("double").alias("p")), spark.createDataFrame([(0, 3.0, 17.0), (1, 5.0, 5.0), (2, -4.0, 1.0)], "r int, lo double, hi double")
    got = range_join(points, ranges, F.col("p"), F.col("lo"), F.col("hi"), 4.0).select("p", "r").collect()
    assert sorted(map(tuple, got)) == sorted((float(p), r) for p in range(30) for r, lo, hi in ((0, 3, 17), (2, -4, 1)) if lo <= p < hi)


def test_json_documents(spark):
    a, b = F.lit('{"x": 1, "y": {"p": 1, "q": [1, 2]}}'), F.lit('{"y":{"q":[1,2],"p":1},"x":1}')
    assert one(spark, J.equal(a, b), J.equal(a, F.lit("{}")), J.equal(F.lit("not json"), a), J.equal(F.lit(None).cast("string"), F.lit(None).cast("string"))) == (True, False, False, True)
    assert one(spark, J.value(F.lit('{"it\'s": {"a": {"b\'c": 7}}}'), "it's", "a", "b'c", kind="int"), J.value(F.lit("{}"), "it's"))  == (7, None)


def test_plans(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert capture("SELECT * FROM three WHERE id > :x", "count", x=0).replay(spark) == 2
    assert capture("SELECT * FROM three WHERE id > 9", "max", "id").replay(spark) is None
    assert "Physical Plan" in capture("SELECT * FROM three").explain(spark)
    with pytest.raises(ValueError):
        capture("SELECT 1", "max")


def test_stream_upsert(spark, tmp_path):
    from spillway.streaming.sinks import stream_upsert

    (tmp_path / "in").mkdir()
    spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "c", 2)], "id int, v string, at int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    stream = spark.readStream.schema("id int, v string, at int").parquet(str(tmp_path / "in"))
    stream_upsert(stream, table, ["id"], str(tmp_path / "cp"), "at").awaitTermination()
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "c"), (2, "b")]


def test_entry_stands_without_optional_parts(tmp_path):
    import pathlib
    import shutil
    import subprocess
    import sys

    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    top = pathlib.Path(entry.__file__).parent
    shutil.copytree(top / "spillway", tmp_path / "spillway", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    say = "import __spark_entry__ as e; print(len(e.queries()), *[n for n in e.queries() if n.startswith('op') and n[2].isdigit() or n == 'pipeline'])"
    run = lambda: subprocess.run([sys.executable, "-B", "-c", say], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=False)
    assert run().stdout.split() == [str(len(QUERIES))]
    # A part that is there but does not import is an error.
    (tmp_path / "spillway/llm").mkdir()
    (tmp_path / "spillway/llm/__init__.py").write_text("")
    (tmp_path / "spillway/llm/queries.py").write_text("import no_such_module\n")
    assert "no_such_module" in run().stderr
