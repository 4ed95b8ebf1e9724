"""Facts about the output of the fitted models that follow from the tables alone, each with its checking SQL.

Factors and scores depend on the solver, so no SQL gives them. Which ids get factors, which pairs get a prediction, how
long the lists are, how they are ordered and numbered, and that the winner is the lowest row, does follow from the ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetra.operators import als as A
from lumetra.operators import ratings as R
from lumetra.operators.factors import user_lists
from lumetra.operators.topk import flatten_list
from lumetra.session import stored
from lumetra.workload import fixtures as X
from lumetra.workload import registry as Q
from lumetra.workload.oracles import ORACLES, _P, _R
from lumetra.workload.registry import query

_TOLERANCE = 1e-9
_KNOWN = """known AS (SELECT * FROM p WHERE "user" IN (SELECT "user" FROM p WHERE part = 'train')
  AND item IN (SELECT item FROM p WHERE part = 'train'))"""


@query
def als_fit_ids(spark, sf):
    """The ids that have a vector, its length, and whether its numbers are finite."""
    finite = F.forall("features", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return Q.als_fit_factors(spark, sf).select("side", "id", F.size("features").alias("rank"), finite.alias("finite"))


ORACLES["als_fit_ids"] = f"""WITH {_P}
SELECT DISTINCT 'user' AS side, "user" AS id, {A.SIMILARITY_PARAMS["rank"]} AS rank, true AS finite FROM p WHERE part = 'train'
UNION ALL SELECT DISTINCT 'item', item, {A.SIMILARITY_PARAMS["rank"]}, true FROM p WHERE part = 'train'"""


@query
def als_predicted_pairs(spark, sf):
    return Q.als_predict(spark, sf).select("user", "item", "rating", F.isnan("prediction").alias("missing"))


ORACLES["als_predicted_pairs"] = f"""WITH {_P}, {_KNOWN}
SELECT "user", item, rating, false AS missing FROM known WHERE part = 'test'"""


@query
def als_scored_pairs(spark, sf):
    """Number of validation pairs that the error is taken over, and whether mean error and RMSE are in order."""
    return Q.als_rmse(spark, sf).select("n_scored", (F.col("mae") <= F.col("rmse") + _TOLERANCE).alias("in_order"))


ORACLES["als_scored_pairs"] = f"""WITH {_P}, {_KNOWN}
SELECT count(*) AS n_scored, true AS in_order FROM known WHERE part = 'validation'"""


@query
def als_leaderboard(spark, sf):
    """The parameter rows of the grid in order, and whether exactly the lowest one is marked."""
    board = Q.als_grid_search(spark, sf)
    lowest = board.agg(F.min(F.struct("validation_rmse", "ord")).alias("_low"))
    marked = F.col("is_best") == (F.col("ord") == F.col("_low.ord"))
    return board.join(F.broadcast(lowest)).select(
        F.col("ord").cast("bigint"), F.col("rank").cast("bigint"), "reg", F.col("max_iter").cast("bigint"),
        marked.alias("marked_right"),
    )


_GRID = [(rank, reg, n) for rank in A.GRID_RANKS for reg in A.GRID_REGS for n in A.GRID_ITERS]
ORACLES["als_leaderboard"] = "SELECT ord, rank, reg, max_iter, true AS marked_right FROM (VALUES {}) g(ord, rank, reg, max_iter)".format(
    ", ".join(f"({i}::BIGINT, {rank}::BIGINT, {reg}::DOUBLE, {n}::BIGINT)" for i, (rank, reg, n) in enumerate(_GRID, 1))
)


@query
def als_test_facts(spark, sf):
    """Scored test pairs of the best model, the baseline that its improvement was reckoned from, and whether the error is
    that of the products of its vectors."""
    parts, found = Q._best_model(spark, sf)
    errors = Q._test_errors(parts, found)
    users, items = (f.select(F.col("id").alias(c), F.col("features").alias(v)) for f, c, v in (
        (found.model.userFactors, "user", "_f"), (found.model.itemFactors, "item", "_g")))
    product = F.aggregate(F.zip_with("_f", "_g", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    own = Q._part(parts, "test").join(users, "user").join(items, "item").select(
        F.sum((product - F.col("rating")) ** 2).alias("squares"), F.count(F.lit(1)).alias("n"))
    base = F.col("rmse") / (1 - F.col("improvement_percent") / 100)
    right = F.abs(F.col("rmse") ** 2 * F.col("n") - F.col("squares")) <= F.lit(1e-5) * F.col("squares")
    return errors.join(F.broadcast(own)).select("n_scored", F.round(base, 6).alias("baseline_rmse"), right.alias("rmse_right"))


ORACLES["als_test_facts"] = f"""WITH {_P}, {_KNOWN}, m AS (SELECT avg(rating) AS mean FROM p WHERE part <> 'test')
SELECT (SELECT count(*) FROM known WHERE part = 'test') AS n_scored,
  (SELECT round(sqrt(avg((mean - rating) ** 2)), 6) FROM p, m WHERE part = 'test') AS baseline_rmse, true AS rmse_right"""


def _list_facts(flat: DataFrame) -> DataFrame:
    """Per user: places in the numbering, length, distinct items, and whether scores fall along the ids."""
    pairs = F.array_sort(F.collect_list(F.struct("id", "predict")))
    ordered = F.forall(
        F.sequence(F.lit(1), F.size("_l") - 1),
        lambda i: (F.size("_l") < 2) | (F.get("_l", i)["predict"] <= F.get("_l", i - 1)["predict"]),
    )
    per_user = flat.groupBy("user").agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("item").alias("n_items"), pairs.alias("_l"),
    )
    return per_user.select(
        "user", "first_id", "last_id", "n_rows", "n_items", F.when(F.size("_l") < 2, F.lit(True)).otherwise(ordered).alias("in_order")
    )


_LISTS = f"""WITH {_R}, u AS (SELECT "user", row_number() OVER (ORDER BY "user") AS n FROM (SELECT DISTINCT "user" FROM r)),
k AS (SELECT least(5, count(DISTINCT item)) AS k FROM r)
SELECT "user", (n - 1) * k + 1 AS first_id, n * k AS last_id, k AS n_rows, k AS n_items, true AS in_order FROM u, k"""


@query
def als_recommend_lists(spark, sf):
    return _list_facts(Q.als_recommend_flat(spark, sf))


@query
def rec_job_lists(spark, sf):
    return _list_facts(Q.rec_job(spark, sf))


ORACLES["als_recommend_lists"] = _LISTS
ORACLES["rec_job_lists"] = _LISTS


@query
def als_list_scores(spark, sf):
    """Per user with a vector: how many listed scores differ from the product of the two vectors or are not positive, and
    whether the list is as long as positive products allow and leaves none out that is higher than its last."""
    parts = stored(Q._parts(spark, sf))
    model = A.fit(Q._part(parts, "train"), Q.JOB_ALS)
    listed = flatten_list(user_lists(A.positive_lists(model)), "uid")
    users = model.userFactors.select(F.col("id").alias("uid"), F.col("features").alias("_f"))
    items = model.itemFactors.select(F.col("id").alias("product"), F.col("features").alias("_g"))
    product = F.aggregate(F.zip_with("_f", "_g", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    wrong = (F.col("rating") <= 0) | (F.abs(F.col("rating") - product) > _TOLERANCE)
    counted = listed.join(users, "uid").join(items, "product").groupBy("uid").agg(
        F.count_if(wrong).alias("n_wrong"), F.count(F.lit(1)).alias("n"), F.min("rating").alias("last")
    )
    return _complete(users.select("uid"), counted, _products(users, items, "uid", "product", product), "uid", 0.0)


def _products(left, right, key: str, other: str, score):
    """Every pair of a vector with another's item, and its score. Facts about the lists need them all; items are dealt in
    blocks, not broadcast."""
    blocks = 8
    dealt = left.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = dealt.join(right.withColumn("_b", F.pmod(F.xxhash64(other), F.lit(blocks)).cast("int")), "_b")
    return (met.where(F.col(key) != F.col(other)) if key == "id" else met).select(key, score.alias("score"))


def _complete(keys, counted, products, key: str, least: float):
    """``n_wrong``, and whether the list of each key has all that it should: by counts of the scores above the lowest that
    may be listed, and above the last that is."""
    bounds = keys.join(counted, key, "left")
    met = products.join(bounds.select(key, "last"), key).groupBy(key).agg(
        F.count_if(F.col("score") > least + _TOLERANCE).alias("must"), F.count_if(F.col("score") > least - _TOLERANCE).alias("may"),
        F.count_if(F.col("score") > F.col("last") + _TOLERANCE).alias("above"),
    )
    n = F.coalesce("n", F.lit(0))
    return bounds.join(met, key, "left").select(
        key, F.coalesce("n_wrong", F.lit(0)).alias("n_wrong"),
        (n.between(F.least(F.coalesce("must", F.lit(0)), F.lit(10)), F.least(F.coalesce("may", F.lit(0)), F.lit(10)))
         & (F.coalesce("above", F.lit(0)) < F.greatest(n, F.lit(1)))).alias("complete"),
    )


ORACLES["als_list_scores"] = f"""WITH {_P}
SELECT DISTINCT "user" AS uid, 0::BIGINT AS n_wrong, true AS complete FROM p WHERE part = 'train'"""


@query
def als_similar_items(spark, sf):
    """Per item with a vector: how many listed cosines differ from that of the two vectors, are too low, or its own, and
    whether the list holds as many as there are, and the highest."""
    parts = stored(Q._parts(spark, sf))
    model = A.fit(Q._part(parts, "train"), Q.JOB_ALS)
    listed = A.item_similarity(model)

    def dot(f, g):
        return F.aggregate(F.zip_with(f, g, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)

    own = model.itemFactors.select("id", F.col("features").alias("_f"))
    others = model.itemFactors.select(F.col("id").alias("other"), F.col("features").alias("_g"))
    cosine = dot("_f", "_g") / F.sqrt(dot("_f", "_f") * dot("_g", "_g"))
    wrong = (F.abs(F.col("score") - cosine) > _TOLERANCE) | (F.col("score") < 0.6) | (F.col("id") == F.col("other"))
    counted = listed.join(own, "id").join(others, "other").groupBy("id").agg(
        F.count_if(wrong).alias("n_wrong"), F.count(F.lit(1)).alias("n"), F.min("score").alias("last")
    )
    return _complete(own.select("id"), counted, _products(own, others, "id", "other", cosine), "id", 0.6).withColumnRenamed("id", "mid")


ORACLES["als_similar_items"] = f"""WITH {_P}
SELECT DISTINCT item AS mid, 0::BIGINT AS n_wrong, true AS complete FROM p WHERE part = 'train'"""


@query
def split_random_pairs(spark, sf):
    """Every pair of the ratings, and the number of parts that hold it."""
    parts = Q.split_random(spark, sf)
    return parts.groupBy("user", "item").agg(F.count(F.lit(1)).alias("n_parts"))


ORACLES["split_random_pairs"] = f'WITH {_R} SELECT "user", item, 1::BIGINT AS n_parts FROM r'


@query
def table_columns_of_ratings(spark, sf):
    """The columns of a catalog table and their places, by which the recommendation job names its output."""
    from lumetra.sources.tables import create_table, table_columns

    name = Q._name("ratings")
    create_table(X.ratings(spark, sf), name, Q.scratch_path(spark, name))
    return R.distinct_counts(spark.table(name).toDF(*table_columns(spark, name)))


ORACLES["table_columns_of_ratings"] = ORACLES["distinct_users_items"]
