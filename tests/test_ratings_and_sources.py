import math

import pytest
from pyspark.sql import functions as F

from lumetra.operators import ratings as R
from lumetra.session import scratch_path, shared_dir
from lumetra.sources import jdbc
from lumetra.sources.logs import read_lines, replace_days
from lumetra.sources.ratings_file import read_ratings_file
from lumetra.sources.tables import create_table, read_table, replace_table, table_columns


def frame(spark, rows):
    return spark.createDataFrame(rows, "user int, item int, rating double")


def test_ratings_file(spark, tmp_path):
    (tmp_path / "ratings.dat").write_text("1::122::5::838985046\n1::122::3::838985047\n2::7::4.5::1\n2::7::1::0\n")
    got = {(r["user"], r["item"]): r["rating"] for r in read_ratings_file(spark, str(tmp_path / "*.dat")).collect()}
    assert got == {(1, 122): 3.0, (2, 7): 4.5}


def test_lines_of_a_glob(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\ny\n")
    (tmp_path / "b.log").write_text("z\n")
    assert sorted(r["value"] for r in read_lines(spark, str(tmp_path / "*.log")).collect()) == ["x", "y", "z"]


def test_create_fails_if_the_table_exists_and_replace_does_not(spark):
    create_table(spark.range(3), "t_create")
    with pytest.raises(Exception, match="t_create"):
        create_table(spark.range(3), "t_create")
    replace_table(spark.range(5).withColumnRenamed("id", "n"), "t_create")
    assert read_table(spark, "t_create").count() == 5
    assert table_columns(spark, "t_create") == ["n"]


def test_cast_takes_any_three_columns_and_reports_bad_rows(spark):
    table = spark.createDataFrame([("1", 2, "3.5"), ("x", 2, "1"), ("1", 2, None), ("99999999999", 2, "1")], "`a.b` string, i bigint, r string")
    rows = R.cast_ratings(table).collect()
    assert [(r["user"], r["item"], r["rating"]) for r in rows if r["reason"] is None] == [(1, 2, 3.5)]
    assert sum(r["reason"] == "bad_rating" for r in rows) == 3
    with pytest.raises(ValueError, match="three columns"):
        R.cast_ratings(table.select("i", "r"))


def test_split_and_baseline(spark):
    ratings = frame(spark, [(u, i, float(u + i)) for u in range(30) for i in range(20)])
    parts = R.split_parts(ratings, R.SPLIT_60_20_20)
    row = R.profile(parts).first()
    assert row["n_train"] + row["n_validation"] + row["n_test"] == row["n_ratings"] == 600
    assert (row["n_users"], row["n_items"]) == (30, 20)
    known = [r["rating"] for r in parts.filter("part <> 'test'").collect()]
    test = [r["rating"] for r in parts.filter("part = 'test'").collect()]
    mean = sum(known) / len(known)
    base = R.mean_baseline(parts).first()
    assert math.isclose(base["mean_rating"], mean) and base["n_scored"] == len(test)
    assert math.isclose(base["rmse"], math.sqrt(sum((mean - t) ** 2 for t in test) / len(test)))


def test_random_split_is_a_partition_and_repeats(spark):
    ratings = frame(spark, [(u, i, 1.0) for u in range(40) for i in range(20)])
    first, again = ([sorted(map(tuple, p.collect())) for p in R.split_random(ratings)] for _ in range(2))
    assert first == again
    assert sorted(sum(first, [])) == sorted(map(tuple, ratings.collect()))


def test_unique_pairs_and_errors_of_nothing(spark):
    assert R.unique_pairs(frame(spark, [(1, 1, 1.0), (1, 1, 2.0)])).collect()[0]["rating"] == 1.5
    row = R.error_metrics(frame(spark, []).withColumn("prediction", F.lit(1.0))).first()
    assert row["rmse"] is None and row["n_scored"] == 0


def test_list_length_by_source():
    assert [R.top_n_for(s) for s in R.TOP_N] == [5, 50, 50, 20, 20]
    with pytest.raises(ValueError, match="other"):
        R.top_n_for("other")


def test_improvement():
    assert R.improvement(2.0, 1.5) == 25.0


def test_grid_coverage(spark):
    got = {r["user"]: tuple(r)[1:] for r in R.grid_coverage(frame(spark, [(1, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0)])).collect()}
    assert got == {1: (3, 2, 1), 2: (3, 1, 2)}


def test_shared_dir_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark)) and scratch_path(spark, "x") != scratch_path(spark, "x")


class Writer:
    """Records what would be written; no database takes part."""

    def __init__(self):
        self.calls = []

    def mode(self, m):
        self.calls.append(m)
        return self

    def jdbc(self, url, table, properties):
        self.calls.append((url, table, properties))


class Frame:
    def __init__(self):
        self.write = Writer()


def test_jdbc_writes(monkeypatch):
    target = jdbc.JdbcTarget("jdbc:x:y", "t", user="u", password="p", num_partitions=4)
    df = Frame()
    jdbc.append_jdbc(df, target)
    jdbc.truncate_load_jdbc(df, target)
    append, (url, table, properties), overwrite, (_, _, truncating) = df.write.calls
    assert (append, overwrite, url, table) == ("append", "overwrite", "jdbc:x:y", "t")
    assert properties == {"user": "u", "password": "p", "batchsize": "10000", "numPartitions": "4"}
    assert truncating == properties | {"truncate": "true"}
    assert "p'" not in repr(target).replace("'t'", "")


def test_jdbc_target_from_the_environment(monkeypatch):
    monkeypatch.delenv("LUMETRA_JDBC_URL", raising=False)
    with pytest.raises(ValueError, match="LUMETRA_JDBC_URL"):
        jdbc.JdbcTarget.from_env("t")
    monkeypatch.setenv("LUMETRA_JDBC_URL", "jdbc:x")
    monkeypatch.setenv("LUMETRA_JDBC_USER", "u")
    target = jdbc.JdbcTarget.from_env("t")
    assert (target.url, target.user, target.password) == ("jdbc:x", "u", None)


def test_jdbc_parts_hold_each_row_once(spark, monkeypatch):
    keys = spark.createDataFrame([(k,) for k in [None, *[1] * 500, *range(2, 400)]], "k int")
    bounds = jdbc.key_bounds(keys, "k", 6)
    predicates = jdbc.key_predicates("k", bounds)
    counts = [keys.where(p).count() for p in predicates]
    assert sum(counts) == keys.count() and len(predicates) == len(bounds) + 1 and max(counts[1:]) < 2 * keys.count() / 6 + 500
    assert jdbc.key_bounds(keys.where("false"), "k", 6) == [] == jdbc.key_bounds(keys, "k", 1)
    assert jdbc.key_predicates("k", ["a'b"]) == ["k < 'a''b' OR k IS NULL", "k >= 'a''b'"]
    asked = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **options: asked.update(options) or (url, table))
    assert jdbc.read_jdbc(spark, jdbc.JdbcTarget("jdbc:x", "t"), "k", bounds) == ("jdbc:x", "t") and asked["predicates"] == predicates
    asked.clear()
    jdbc.read_jdbc(spark, jdbc.JdbcTarget("jdbc:x", "t"))
    assert "predicates" not in asked


def test_replaced_days_are_balanced_and_not_doubled(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id < 900 THEN '2024-01-01' ELSE '2024-01-02' END AS dt")
    replace_days(rows, path)
    replace_days(rows.where("dt = '2024-01-02' AND id < 950"), path)
    got = {str(r["dt"]): r["count"] for r in spark.read.orc(path).groupBy("dt").count().collect()}
    assert got == {"2024-01-01": 900, "2024-01-02": 50}


@pytest.mark.parametrize("ids", [
    [], [None], [0], [-1, 0, 1, 32767, 32768, 32769, -32767, -32768, -32769], [2**31 - 1, -(2**31), 5, 5, None],
    [i * 7919 % 100003 - 50000 for i in range(30000)],
])
def test_distinct_ids_by_bitmaps(spark, ids):
    rows = spark.createDataFrame([(i, 1, 2.0) for i in ids], "user int, item int, rating double").repartition(5)
    assert R.distinct_ids(rows, "user").first()["n"] == len(set(ids) - {None})
    assert tuple(R.distinct_counts(rows).first()) == (len(set(ids) - {None}), min(len(ids), 1))
    plan = R.distinct_ids(rows, "user")._jdf.queryExecution().toString()
    assert "bitmap_construct_agg" in plan and "Expand" not in plan
