import pytest

from __spark_entry__ import queries
from lumetra.operators import logs as L
from lumetra.streaming.weblog import stream_detail
from tests.test_logs import line


def test_streamed_files_give_the_batch_result(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = [line(), "bad", line("/MobileInternet/index/sn?userid=1")]
    second = [line("/MobileInternet/user/welcome?userid=2")]
    seen = []
    for batch in (first, second):
        seen += batch
        spark.createDataFrame([(v,) for v in batch], "value string").write.mode("append").text(source)
        assert stream_detail(spark, source, out, state).awaitTermination(120)
        want = L.good_rows(L.detail_rows(L.parse_lines(spark.createDataFrame([(v,) for v in seen], "value string"))))
        got = spark.read.orc(out).select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


# Queries that only plan; the others run jobs while they are built.
LAZY = [
    "log_parse", "log_page_filter", "log_detail_table", "etl_row_counts", "json_module_label", "reverse_geocode_nearest",
    "dataset_profile", "topk_per_user", "user_item_grid", "baseline_mean_rmse", "rating_prediction_join", "topn_config_join",
    "item_cosine_topk", "user_topk_from_factors", "user_pearson", "item_pearson", "nearest_n_users", "relevance_threshold",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_product_of_rows_in_any_plan(name, spark, sf_dir):
    plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name,columns", [
    ("dataset_profile", "user_id:bigint,props:string"),
    ("topk_per_user", "event_id:bigint,user_id:bigint,value:double,props:string"),
])
def test_scan_reads_the_needed_columns_only(name, columns, spark, sf_dir, capsys):
    queries()[name](spark, sf_dir).explain("formatted")
    assert f"ReadSchema: struct<{columns}>" in capsys.readouterr().out
