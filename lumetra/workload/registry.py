"""The registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetra.functions import weblog as W
from lumetra.functions.sql import register_sql_functions
from lumetra.operators import als as A
from lumetra.operators import evaluate as E
from lumetra.operators import factors as B
from lumetra.operators import logs as L
from lumetra.operators import neighborhood as N
from lumetra.operators import ratings as R
from lumetra.operators import similarity as S
from lumetra.operators import topk as K
from lumetra.operators.geo import nearest_place
from lumetra.plans.log_jobs import etl_row_counts as row_counts
from lumetra.plans.log_jobs import run_detail_job, run_page_job
from lumetra.plans.recommend_job import flat_recommendations, run_recommendation_job
from lumetra.schemas import LOG_CLEAN_COLUMNS, LOG_DETAIL_COLUMNS, LOG_RAW_COLUMNS
from lumetra.session import scratch_path, stored
from lumetra.sources.logs import append_orc, read_lines, replace_days
from lumetra.sources.ratings_file import read_ratings_file
from lumetra.sources.tables import create_table, read_table, replace_table
from lumetra.workload import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIN_COSINE = 0.2
JOB_ALS = A.AlsParams(**A.SIMILARITY_PARAMS)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return L.parse_lines(X.raw_log_lines(spark, sf))


def _detail(spark: SparkSession, sf: str) -> DataFrame:
    return L.good_rows(L.detail_rows(_parsed(spark, sf)))


def _stored_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """The ratings, computed once for queries that read them several times."""
    return stored(X.ratings(spark, sf))


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return R.split_parts(X.ratings(spark, sf), R.SPLIT_60_20_20)


def _part(parts: DataFrame, *names: str) -> DataFrame:
    return parts.filter(F.col("part").isin(*names)).drop("part")


def _name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def _rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


# ---- sources and sinks ----


@query
def scan_text_lines(spark, sf):
    path = scratch_path(spark, "lines")
    X.raw_log_lines(spark, sf).select("value").write.text(path)
    return read_lines(spark, f"{path}/*.txt")


@query
def scan_table(spark, sf):
    name = _name("customer_view")
    X.table(spark, sf, "customer").createOrReplaceTempView(name)
    return read_table(spark, name)


@query
def scan_ratings_file(spark, sf):
    path = scratch_path(spark, "ratings")
    item = F.get_json_object("props", "$.k")
    X.table(spark, sf, "events").select(F.concat_ws("::", "user_id", item, "value", "event_id")).write.text(path)
    return read_ratings_file(spark, path)


@query
def sink_orc_append(spark, sf):
    path = scratch_path(spark, "orc")
    good = L.good_rows(_parsed(spark, sf))
    append_orc(good, path)
    append_orc(good, path)
    return spark.read.orc(path)


@query
def sink_orc_days(spark, sf):
    """The cleaned lines by day, written twice: the rerun replaces its days."""
    path = scratch_path(spark, "days")
    cleaned = L.good_rows(L.clean(_parsed(spark, sf))).select("event_id", *LOG_CLEAN_COLUMNS).withColumn("dt", F.substring("time", 1, 10))
    replace_days(cleaned, path)
    replace_days(cleaned, path)
    days = spark.read.schema(cleaned.schema).orc(path)
    return days.groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_events"), F.sum("event_id").alias("sum_ids"))


@query
def sink_table_create(spark, sf):
    name = _name("detail")
    create_table(_detail(spark, sf), name, scratch_path(spark, name))
    return read_table(spark, name).select(*LOG_DETAIL_COLUMNS)


@query
def sink_table_replace(spark, sf):
    name = _name("ratings")
    path = scratch_path(spark, name)
    ratings = X.ratings(spark, sf)
    replace_table(ratings.withColumn("rating", F.lit(0.0)), name, path)
    replace_table(ratings, name, path)
    return read_table(spark, name)


@query
def etl_row_counts(spark, sf):
    return row_counts(X.raw_log_lines(spark, sf))


@query
def log_jobs_detail(spark, sf):
    """Both jobs in a row: text lines to the page table, and that catalog table to the detail table."""
    lines, folder, pages, detail = scratch_path(spark, "lines"), scratch_path(spark, "pages"), _name("pages"), _name("detail")
    X.raw_log_lines(spark, sf).select("value").write.text(lines)
    run_page_job(spark, f"{lines}/*.txt", folder)
    create_table(spark.read.orc(folder), pages, scratch_path(spark, pages))
    run_detail_job(spark, pages, detail, path=scratch_path(spark, detail))
    return read_table(spark, detail).select(*LOG_DETAIL_COLUMNS)


# ---- access logs ----


@query
def log_parse(spark, sf):
    return L.good_rows(_parsed(spark, sf))


@query
def log_quarantine(spark, sf):
    return L.quarantine(L.detail_rows(_parsed(spark, sf)))


@query
def log_page_filter(spark, sf):
    return L.page_filter(L.good_rows(_parsed(spark, sf)))


@query
def log_page_filter_semi(spark, sf):
    return L.page_filter(L.good_rows(_parsed(spark, sf)), dedupe=True)


@query
def log_time_format(spark, sf):
    cut = L.good_rows(_parsed(spark, sf)).selectExpr("event_id", f"{W.strip_brackets('time')} AS t")
    return cut.selectExpr("event_id", f"{W.log_time_text('t')} AS time")


@query
def log_clean(spark, sf):
    return L.good_rows(L.clean(_parsed(spark, sf))).select("event_id", *LOG_CLEAN_COLUMNS)


@query
def log_typed(spark, sf):
    cleaned = L.typed_extras(L.good_rows(L.clean(_parsed(spark, sf))))
    return cleaned.select(
        "event_id", F.col("status_code").cast("bigint").alias("status_code"), "size_bytes",
        F.date_format("event_ts", "yyyy-MM-dd HH").alias("event_hour"),
    )


@query
def log_get_only(spark, sf):
    return L.good_rows(L.only_get(L.clean(_parsed(spark, sf)))).select("event_id", "method", "request")


@query
def url_decode_targets(spark, sf):
    cut = L.good_rows(_parsed(spark, sf)).selectExpr("event_id", f"{W.request_target('request')} AS target")
    return cut.filter("target <> ''").selectExpr("event_id", "target", f"{W.url_text('target')} AS decoded")


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return L.good_rows(L.clean(_parsed(spark, sf)))


@query
def interface_type(spark, sf):
    cut = _requests(spark, sf).selectExpr("event_id", f"{W.url_path('request')} AS path")
    return cut.selectExpr("event_id", "path", f"{W.interface_of('path')} AS interface_type")


@query
def url_param(spark, sf):
    names = ["userid", "page", "type", "appname", "city", "location", "longitude", "latitude", "absent"]
    values = [f"{W.url_param('request', W.text(n))} AS {n}" for n in names]
    return _requests(spark, sf).selectExpr("event_id", *values)


def _labels(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return L.good_rows(L.with_labels(L.clean(_parsed(spark, sf)))).select("event_id", *columns)


@query
def log_action(spark, sf):
    return _labels(spark, sf, "action", "unmapped_interface")


@query
def log_act(spark, sf):
    return _labels(spark, sf, "act")


@query
def log_detail(spark, sf):
    return _labels(spark, sf, "detail")


@query
def log_location(spark, sf):
    return _labels(spark, sf, "location")


@query
def log_detail_table(spark, sf):
    return _detail(spark, sf).select(*LOG_DETAIL_COLUMNS)


@query
def json_module_label(spark, sf):
    return L.label_modules(X.module_events(spark, sf)).select("event_id", "label", "reason")


@query
def reverse_geocode_nearest(spark, sf):
    return nearest_place(X.points(spark, sf), X.places(spark, sf), max_km=30.0).select("id", "address")


@query
def reverse_geocode_town(spark, sf):
    """As many places as there are customers, all in one town."""
    return nearest_place(X.town_points(spark, sf), X.town_places(spark, sf), max_km=5.0).select("id", "address")


@query
def sql_function_surface(spark, sf):
    register_sql_functions(spark)
    requests, modules = _name("requests"), _name("modules")
    lines = L.good_rows(_parsed(spark, sf))
    cut = lines.selectExpr(
        "event_id", f"{W.strip_brackets('time')} AS t", f"{W.request_target('request')} AS u"
    )
    cut.filter("u <> ''").createOrReplaceTempView(requests)
    X.module_events(spark, sf).createOrReplaceTempView(modules)
    return spark.sql(f"""
        SELECT event_id, log_time_text(t) AS time, url_param(url_text(u), 'city') AS city,
               url_param(url_text(u), 'appname') AS appname,
               interface_of(split_part(url_text(u), '?', 1)) AS interface_type, module_label(json) AS label
        FROM {requests} JOIN {modules} USING (event_id)
    """)


# ---- relational steps ----


@query
def filter_predicates(spark, sf):
    c = F.col
    return X.table(spark, sf, "events").select("event_id", "event_type", "value", "props").filter(
        (c("event_type") != "error") & (c("value") > 0) & (c("value") >= 0.6)
        & ((c("event_type") == "click") | c("props").contains("7"))
    )


@query
def sample_limit(spark, sf):
    return K.ordered_limit(X.ratings(spark, sf), [F.asc("user"), F.asc("item")], 1000)


@query
def dataset_profile(spark, sf):
    return R.profile(_parts(spark, sf))


@query
def distinct_users_items(spark, sf):
    return R.distinct_counts(X.ratings(spark, sf))


@query
def user_item_grid(spark, sf):
    return R.grid_coverage(X.ratings(spark, sf))


@query
def rating_prediction_join(spark, sf):
    parts = _parts(spark, sf)
    test = _part(parts, "test")
    predicted = R.user_mean_predictions(_part(parts, "train"), test)
    return _rounded(R.join_predictions(predicted, test), "prediction", places=8)


@query
def split_union_mean(spark, sf):
    return _rounded(R.known_mean(_parts(spark, sf)), "mean_rating")


def _top_ratings(spark: SparkSession, sf: str, k: int = 10) -> DataFrame:
    return K.top_k(X.ratings(spark, sf), ["user"], [F.desc("rating"), F.asc("item")], k)


@query
def topk_per_user(spark, sf):
    ratings = X.ratings(spark, sf)
    ranked = K.top_k(ratings, ["user"], [F.desc("rating"), F.asc("item")], 10, rank="rank")
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


@query
def sequential_id(spark, sf):
    flat = X.ratings(spark, sf).withColumnRenamed("rating", "predict")
    return K.sequential_id(flat, [F.asc("user"), F.desc("predict"), F.asc("item")])


@query
def explode_recommendations(spark, sf):
    lists = K.as_list(_top_ratings(spark, sf), "user", "item", "rating")
    return K.flatten_list(lists, "user")


@query
def split_deterministic(spark, sf):
    return _parts(spark, sf)


@query
def split_random(spark, sf):
    names = ["train", "validation", "test"]
    parts = R.split_random(_stored_ratings(spark, sf))
    labelled = [df.withColumn("part", F.lit(n)) for n, df in zip(names, parts)]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


@query
def ratings_cast(spark, sf):
    events = X.table(spark, sf, "events")
    item = F.when(F.col("event_type") == "signup", F.col("event_type")).otherwise(F.get_json_object("props", "$.k"))
    return R.cast_ratings(events.select("user_id", item, "value")).drop("raw")


# ---- matrix factorisation ----


def _als(spark: SparkSession, sf: str):
    parts = stored(_parts(spark, sf))
    return parts, A.fit(_part(parts, "train"), JOB_ALS)


@query
def als_fit_factors(spark, sf):
    _, model = _als(spark, sf)
    users = model.userFactors.select(F.lit("user").alias("side"), "id", "features")
    return users.unionByName(model.itemFactors.select(F.lit("item").alias("side"), "id", "features"))


@query
def als_predict(spark, sf):
    parts, model = _als(spark, sf)
    return A.predict(model, _part(parts, "test"))


@query
def rmse(spark, sf):
    parts = _parts(spark, sf)
    test = _part(parts, "test")
    predicted = R.user_mean_predictions(_part(parts, "train"), test)
    return _rounded(R.error_metrics(R.join_predictions(predicted, test)), "mae", "rmse")


@query
def als_rmse(spark, sf):
    parts, model = _als(spark, sf)
    return R.error_metrics(A.predict(model, _part(parts, "validation")))


@query
def als_grid_search(spark, sf):
    parts = _parts(spark, sf)
    return A.grid_search(_part(parts, "train"), _part(parts, "validation")).leaderboard


@query
def als_test_rmse(spark, sf):
    parts, found = _best_model(spark, sf)
    return _test_errors(parts, found)


def _best_model(spark: SparkSession, sf: str):
    parts = stored(_parts(spark, sf))
    return parts, A.grid_search(_part(parts, "train"), _part(parts, "validation"))


def _test_errors(parts: DataFrame, found) -> DataFrame:
    base = R.mean_baseline(parts).first()["rmse"]
    return R.error_metrics(A.predict(found.model, _part(parts, "test"))).withColumn(
        "improvement_percent", (F.lit(base) - F.col("rmse")) / F.lit(base) * 100
    )


@query
def baseline_mean_rmse(spark, sf):
    return _rounded(R.mean_baseline(_parts(spark, sf)), "mean_rating", "rmse")


@query
def als_recommend_flat(spark, sf):
    model = A.fit(_stored_ratings(spark, sf), JOB_ALS)
    return flat_recommendations(model, R.top_n_for("music_recommend_app.genre_col_model"), "user", "item")


SOURCE_CASE = """
CASE user % 6 WHEN 0 THEN 'music_recommend_app.genre_col_model' WHEN 1 THEN 'music_recommend_app.music_num_model'
  WHEN 2 THEN 'music_recommend_app.music_play_model' WHEN 3 THEN 'music_recommend_app.rec_score_model'
  WHEN 4 THEN 'music_recommend_app.rec_cli_model' ELSE 'another.table' END
"""


@query
def topn_config_join(spark, sf):
    scored = X.ratings(spark, sf).withColumnRenamed("rating", "predict").withColumn("source", F.expr(SOURCE_CASE))
    return R.source_top_n(scored)


def _factor_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Even vectors as users, odd ones as items."""
    v = X.vectors(spark, sf)
    return v.filter(F.col("id") % 2 == 0), v.filter(F.col("id") % 2 == 1)


@query
def user_topk_from_factors(spark, sf):
    lists = B.user_lists(B.best_items(*_factor_sides(spark, sf)))
    return _rounded(K.flatten_list(lists, "uid"), "rating")


@query
def als_user_recs(spark, sf):
    _, model = _als(spark, sf)
    return K.flatten_list(B.user_lists(A.positive_lists(model)), "uid")


@query
def item_cosine_topk(spark, sf):
    lists = B.item_lists(B.similar_items(X.vectors(spark, sf), min_similarity=MIN_COSINE))
    return _rounded(K.flatten_list(lists, "mid"), "rating")


@query
def item_similar_at_60(spark, sf):
    """The similarity that the job asks for."""
    lists = B.item_lists(B.similar_items(X.vectors(spark, sf), min_similarity=0.6))
    return _rounded(K.flatten_list(lists, "mid"), "rating")


@query
def als_item_recs(spark, sf):
    _, model = _als(spark, sf)
    return K.flatten_list(B.item_lists(A.item_similarity(model)), "mid")


@query
def rec_job(spark, sf):
    name = _name("recommended")
    run_recommendation_job(
        spark, X.ratings(spark, sf), name, top_n=5, path=scratch_path(spark, name)
    )
    return read_table(spark, name)


# ---- neighbourhoods ----


@query
def user_pearson(spark, sf):
    return _rounded(S.user_pearson(_stored_ratings(spark, sf)), "sim")


@query
def item_pearson(spark, sf):
    return _rounded(S.item_pearson(_stored_ratings(spark, sf)), "sim")


@query
def nearest_n_users(spark, sf):
    return _rounded(S.nearest(_stored_ratings(spark, sf), 100), "sim")


@query
def customer_pearson(spark, sf):
    return _rounded(S.user_pearson(stored(X.purchases(spark, sf))), "sim")


@query
def part_pearson(spark, sf):
    return _rounded(S.item_pearson(stored(X.purchases(spark, sf))), "sim")


@query
def nearest_n_customers(spark, sf):
    return _rounded(S.nearest(stored(X.purchases(spark, sf)), 10), "sim")


def _user_based(ratings: DataFrame, neighbours: int = 100, how_many: int = 10) -> DataFrame:
    return N.recommend(stored(S.nearest(ratings, neighbours)), ratings, how_many)


@query
def user_based_recommend(spark, sf):
    return _rounded(_user_based(_stored_ratings(spark, sf)), "prediction")


@query
def recommended_because(spark, sf):
    ratings = _stored_ratings(spark, sf)
    targets = stored(_user_based(ratings).select("user", "item"))
    return _rounded(N.recommended_because(targets, ratings), "score")


@query
def eval_mae_holdout(spark, sf):
    return _rounded(E.holdout_errors(_stored_ratings(spark, sf)), "mae").select("mae", "n_scored")


@query
def eval_rms_holdout(spark, sf):
    return _rounded(E.holdout_errors(_stored_ratings(spark, sf)), "rmse").select("rmse", "n_scored")


@query
def eval_precision_recall_at_k(spark, sf):
    return _rounded(E.precision_recall(_stored_ratings(spark, sf)), "precision", "recall")


@query
def relevance_threshold(spark, sf):
    return _rounded(E.relevance_threshold(X.ratings(spark, sf)), "threshold")
