"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetra.operators.interfaces import RULES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores if the input has fewer splits, as one small file has."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# Every spelling of the rules, a page without a rule, and a path that is no interface.
LOG_PATHS = [*(rule[0] for rule in RULES), "/MobileInternet/Service/canLink", "/health"]


def _path_arms() -> str:
    def literal(path: str) -> str:  # a backslash is written differently by the two engines
        return f"concat('{path[:-1]}', chr(92))" if path.endswith("\\") else f"'{path}'"

    return " ".join(f"WHEN {i} THEN {literal(p)}" for i, p in enumerate(LOG_PATHS))


def _own_parameter_arms() -> str:
    """The parameter of a path's label where the lines do not carry it anyway; absent or empty at times."""
    common = ("userid", "page", "type", "appname", "city", "location")
    return " ".join(
        f"WHEN {i} THEN concat('&{rule[5]}=', CASE WHEN event_id % 3 = 0 THEN '' ELSE concat('%E6%AD%8C', event_id % 50, '.1-b') END)"
        for i, rule in enumerate(RULES) if rule[5] and rule[5] not in common
    )


# Shared by Spark SQL and the checking engine; {ts} and {k} are the only parts that differ.
LOG_LINE_SQL = f"""
CASE WHEN event_id % 97 = 0 THEN 'bad line'
     WHEN event_id % 89 = 0 THEN concat('10.0.0.1 - - [', {{ts}}, ' +0800] "GARBAGE" 400 - "-" "-"')
     ELSE concat('10.', user_id % 200, '.', event_id % 250, '.1 - - [',
       CASE WHEN event_id % 79 = 0 THEN '' ELSE concat({{ts}}, ' +0800') END, '] "',
       CASE WHEN event_id % 10 = 0 THEN 'POST' ELSE 'GET' END, ' ',
       CASE event_id % {len(LOG_PATHS)} {_path_arms()} END,
       '?userid=', user_id, '&page=', {{k}}, '&type=', event_id % 2,
       '&appname=', CASE WHEN event_id % 3 = 0 THEN '' ELSE 'MJ' END,
       '&city=%E5%90%88%E8%82%A5',
       CASE WHEN event_id % 4 = 0 THEN '' ELSE '&location=%E5%90%88%E8%82%A5+A1' END,
       CASE WHEN event_id % 5 = 0 THEN '' ELSE CASE event_id % {len(LOG_PATHS)} {_own_parameter_arms()} ELSE '' END END,
       '&longitude=117.', event_id % 1000, '&latitude=32.', event_id % 900,
       CASE WHEN event_id % 53 = 0 THEN '&ref=/MobileInternet/index/sn' ELSE '' END,
       CASE WHEN event_id % 83 = 0 THEN '&note=%E5%9' ELSE '' END,
       ' HTTP/1.1" ', CASE WHEN event_type = 'error' THEN 500 ELSE 200 END, ' ', event_id % 5000,
       ' "-" "ua/1 (x)"') END
"""


def raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, value)``: one access-log line per event."""
    line = LOG_LINE_SQL.format(
        ts="date_format(cast(ts AS timestamp_ntz), 'dd/MMM/yyyy:HH:mm:ss')", k="get_json_object(props, '$.k')"
    )
    return spread(table(spark, sf_dir, "events")).select("event_id", F.expr(line).alias("value"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user, item, rating)``: the latest value of each user and item of the events."""
    item = F.get_json_object("props", "$.k").try_cast("int")
    return (
        table(spark, sf_dir, "events")
        .select(F.col("user_id").cast("int").alias("user"), item.alias("item"), "value", "event_id")
        .groupBy("user", "item")
        .agg(F.max_by("value", "event_id").alias("rating"))
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user, item, rating)``: the quantity of each part that each customer ordered; sparse in both directions."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias("user"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").cast("int").alias("item"), "l_quantity")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy("user", "item").agg(F.sum(F.col("l_quantity").cast("double")).alias("rating"))
    )


MODULE_JSON_SQL = """
CASE WHEN event_id % 13 = 0 THEN '{{"module":"radio","album_name":' ELSE
concat('{{"module":"',
  CASE event_id % 8 WHEN 0 THEN 'playlist' WHEN 1 THEN 'radio' WHEN 2 THEN 'voice_search'
                    WHEN 3 THEN 'wechat' WHEN 4 THEN 'qq_music' WHEN 5 THEN 'video'
                    WHEN 6 THEN 'mobile_music' ELSE 'telescope' END,
  '","song_source":"s', {k}, '"',
  CASE WHEN event_id % 11 = 0 THEN '' ELSE concat(',"',
    CASE event_id % 8 WHEN 1 THEN 'album_name' WHEN 2 THEN 'end_point' WHEN 3 THEN 'user_name'
                      WHEN 4 THEN 'music_name' WHEN 5 THEN 'video_name' ELSE 'song_name' END,
    '":"名', {k}, '"') END, '}}')
END
"""


def module_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, json)``: one module event per event."""
    text = MODULE_JSON_SQL.format(k="get_json_object(props, '$.k')")
    return spread(table(spark, sf_dir, "events")).select("event_id", F.expr(text).alias("json"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, features)``: the embeddings as factor vectors of doubles."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features")
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        n.alias("place_id"),
        (F.lit(110.0) + n * F.lit(0.4)).alias("lon"),
        (F.lit(30.0) + (n % 5) * F.lit(0.4)).alias("lat"),
        F.col("n_name").alias("address"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        e.alias("id"),
        (F.lit(110.0) + (e % 1000) / F.lit(100.0)).alias("lon"),
        (F.lit(30.0) + (e % 200) / F.lit(100.0)).alias("lat"),
    )


def town_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a place, all within a town of some ten kilometres."""
    k = F.col("c_custkey").cast("bigint")
    return table(spark, sf_dir, "customer").select(
        k.alias("place_id"),
        (F.lit(117.2) + (k * 7919 % 10007) / F.lit(100000.0)).alias("lon"),
        (F.lit(31.8) + (k * 104729 % 10009) / F.lit(100000.0)).alias("lat"),
        F.col("c_name").alias("address"),
    )


def town_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a point in or around the town."""
    e = F.col("event_id").cast("bigint")
    return spread(table(spark, sf_dir, "events")).select(
        e.alias("id"),
        (F.lit(117.15) + (e * 31 % 20011) / F.lit(100000.0)).alias("lon"),
        (F.lit(31.75) + (e * 17 % 20021) / F.lit(100000.0)).alias("lat"),
    )
