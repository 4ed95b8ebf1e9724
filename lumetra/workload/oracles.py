"""Checking SQL for the registered queries, in another engine's dialect.

The texts rebuild the same inputs from the given tables and compute the result the plain way
(self-joins, cross joins), which is fine at checking size and independent of how Spark does it.
"""

from __future__ import annotations

from lumetra.functions.weblog import INTERFACE_PATTERN, LINE_PATTERN, MODULE_LABELS, PARAM_VALUE_CLASS
from lumetra.operators import interfaces as I
from lumetra.operators.geo import EARTH_KM
from lumetra.operators.ratings import TOP_N
from lumetra.schemas import LOG_RAW_COLUMNS
from lumetra.workload.fixtures import LOG_LINE_SQL, MODULE_JSON_SQL
from lumetra.workload.registry import MIN_COSINE, SOURCE_CASE

ORACLES: dict[str, str] = {}

_K = "json_extract_string(props, '$.k')"


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


# ---- access logs ----

_LINES = "lines AS (SELECT event_id, {} AS value FROM events)".format(
    LOG_LINE_SQL.format(ts="strftime(ts, '%d/%b/%Y:%H:%M:%S')", k=_K)
)
_RAW = f"""{_LINES},
found AS (SELECT event_id, value, regexp_matches(value, {_q(LINE_PATTERN)}) AS ok,
          regexp_extract(value, {_q(LINE_PATTERN)}, {LOG_RAW_COLUMNS}) AS f FROM lines),
raw AS (SELECT event_id, value, unnest(f) FROM found WHERE ok)"""

_TIME = "strftime(try_strptime(regexp_extract(time, '([0-9]{2}/[A-Za-z]{3}/[0-9:]+)', 1), '%d/%b/%Y:%H:%M:%S'), '%Y-%m-%d %H:%M:%S')"
_TARGET = "replace(split_part(request, ' ', 2), '\"', '')"
_METHOD = "replace(split_part(request, ' ', 1), '\"', '')"

_BAD_ESCAPE = f"contains(regexp_replace({_TARGET}, '%[0-9A-Fa-f]{{2}}', '', 'g'), '%')"

_CLEAN = f"""{_RAW},
clean AS (SELECT event_id, ipaddress, {_TIME} AS time, {_METHOD} AS method,
          CASE WHEN NOT {_BAD_ESCAPE} THEN url_decode({_TARGET}) END AS request,
          status, size, referer, agent, value FROM raw WHERE {_TARGET} <> '' AND NOT {_BAD_ESCAPE} AND {_TIME} IS NOT NULL)"""


def _param(name: str, url: str = "request") -> str:
    hit = f"nullif(regexp_extract({url} || '&', '[?&]#?{name}={PARAM_VALUE_CLASS}*&', 0), '')"
    return f"replace(split_part({hit}, '=', 2), '&', '')"


def _interface(path: str) -> str:
    return f"nullif(regexp_extract({path}, {_q(INTERFACE_PATTERN)}, 0), '')"


_PATH = "split_part(request, '?', 1)"
_RULES = "rules(path, act, action, kind, prefix, param, suffix, loc) AS (VALUES {})".format(
    ", ".join("(" + ", ".join(_q(x) for x in r) + ")" for r in I.RULES)
)
_ANY_PARAM = "CASE r.param " + " ".join(f"WHEN '{p}' THEN {_param(p)}" for p in I.detail_params()) + " END"
_ANY_PLACE = "CASE s.loc " + " ".join(f"WHEN '{p}' THEN {_param(p)}" for p in I.location_params()) + " END"
_LABELS = f"""{_CLEAN}, {_RULES},
labels AS (
  SELECT c.*, r.act, r.action, r.act IS NULL AS unmapped_interface,
    CASE r.kind WHEN 'text' THEN r.prefix WHEN 'bare' THEN {_ANY_PARAM}
      WHEN 'wrap' THEN r.prefix || coalesce({_ANY_PARAM}, 'null') || r.suffix
      WHEN 'choice' THEN CASE WHEN {_param('type')} = '0' THEN '{I.COLLECTED_SONGS}' ELSE '{I.COLLECTED_LISTS}' END
    END AS detail,
    CASE WHEN s.loc = '' THEN '{I.NO_LOCATION}'
      WHEN s.loc IS NOT NULL THEN '{I.LOCATION_PREFIX}' || coalesce({_ANY_PLACE}, 'null') END AS location
  FROM clean c LEFT JOIN rules r ON r.path = {_PATH} LEFT JOIN rules s ON s.path = replace({_PATH}, '//', '/'))"""
_DETAIL = f"""{_LABELS},
detail_rows AS (
  SELECT event_id, ipaddress, time, method, {_interface(_PATH)} AS interface_type, request AS parm, status, size, referer,
    agent, {_param('userid')} AS user_id, action, act, detail, location, {_param('longitude')} AS longitude,
    {_param('latitude')} AS latitude, unmapped_interface
  FROM labels WHERE method = 'GET')"""
_DETAIL_SELECT = f"WITH {_DETAIL} SELECT * EXCLUDE (event_id, unmapped_interface) FROM detail_rows WHERE interface_type IS NOT NULL"

ORACLES["scan_text_lines"] = f"WITH {_LINES} SELECT value FROM lines"
ORACLES["scan_table"] = "SELECT * FROM customer"
ORACLES["sink_orc_append"] = f"""WITH {_RAW}, kept AS (SELECT * EXCLUDE (value) FROM raw)
SELECT * FROM kept UNION ALL SELECT * FROM kept"""
ORACLES["sink_table_create"] = _DETAIL_SELECT
ORACLES["log_parse"] = f"WITH {_RAW} SELECT * EXCLUDE (value) FROM raw"
ORACLES["log_quarantine"] = f"""WITH {_DETAIL}
SELECT value AS raw, 'unparsable_line' AS reason FROM found WHERE NOT ok
UNION ALL SELECT value, CASE WHEN {_TARGET} = '' THEN 'no_target' WHEN {_BAD_ESCAPE} THEN 'bad_encoding' ELSE 'bad_time' END
  FROM raw WHERE {_TARGET} = '' OR {_BAD_ESCAPE} OR {_TIME} IS NULL
UNION ALL SELECT value, 'no_interface' FROM detail_rows JOIN lines USING (event_id) WHERE interface_type IS NULL"""
_PAGES = "pages_listed(page) AS (VALUES {})".format(", ".join(f"('{p}')" for p in I.PAGES))
ORACLES["log_page_filter"] = f"""WITH {_RAW}, {_PAGES}
SELECT raw.* EXCLUDE (value), page FROM raw JOIN pages_listed ON contains(request, page)"""
ORACLES["log_page_filter_semi"] = f"""WITH {_RAW}, {_PAGES}
SELECT raw.* EXCLUDE (value) FROM raw WHERE EXISTS (SELECT 1 FROM pages_listed WHERE contains(request, page))"""
ORACLES["log_jobs_detail"] = f"""WITH {_DETAIL}, {_PAGES}
SELECT d.* EXCLUDE (event_id, unmapped_interface) FROM detail_rows d
JOIN (SELECT event_id AS id, request AS asked FROM raw) ON id = event_id JOIN pages_listed ON contains(asked, page)
WHERE interface_type IS NOT NULL"""
ORACLES["log_time_format"] = f"WITH {_RAW} SELECT event_id, {_TIME} AS time FROM raw"
ORACLES["log_clean"] = f"WITH {_CLEAN} SELECT * EXCLUDE (value) FROM clean"
ORACLES["sink_orc_days"] = f"""WITH {_CLEAN}
SELECT substr(time, 1, 10) AS dt, count(*) AS n_rows, count(DISTINCT event_id) AS n_events, sum(event_id)::BIGINT AS sum_ids
FROM clean GROUP BY 1"""
ORACLES["log_typed"] = f"""WITH {_CLEAN}
SELECT event_id, try_cast(status AS BIGINT) AS status_code, try_cast(size AS BIGINT) AS size_bytes,
  time[1:13] AS event_hour FROM clean"""
ORACLES["log_get_only"] = f"WITH {_CLEAN} SELECT event_id, method, request FROM clean WHERE method = 'GET'"
ORACLES["url_decode_targets"] = f"""WITH {_RAW}
SELECT event_id, {_TARGET} AS target, CASE WHEN NOT {_BAD_ESCAPE} THEN url_decode({_TARGET}) END AS decoded FROM raw WHERE {_TARGET} <> ''"""
ORACLES["interface_type"] = f"""WITH {_CLEAN}
SELECT event_id, {_PATH} AS path, {_interface(_PATH)} AS interface_type FROM clean"""
_NAMES = ["userid", "page", "type", "appname", "city", "location", "longitude", "latitude", "absent"]
ORACLES["url_param"] = "WITH {} SELECT event_id, {} FROM clean".format(
    _CLEAN, ", ".join(f'{_param(n)} AS "{n}"' for n in _NAMES)
)
ORACLES["log_action"] = f"WITH {_LABELS} SELECT event_id, action, unmapped_interface FROM labels"
ORACLES["log_act"] = f"WITH {_LABELS} SELECT event_id, act FROM labels"
ORACLES["log_detail"] = f"WITH {_LABELS} SELECT event_id, detail FROM labels"
ORACLES["log_location"] = f"WITH {_LABELS} SELECT event_id, location FROM labels"
ORACLES["log_detail_table"] = _DETAIL_SELECT
ORACLES["etl_row_counts"] = f"""WITH {_DETAIL}
SELECT (SELECT count(*) FROM lines) AS lines, (SELECT count(*) FROM raw) AS parsed,
  (SELECT count(*) FROM clean) AS cleaned,
  (SELECT count(*) FROM detail_rows WHERE interface_type IS NOT NULL) AS detail,
  (SELECT count(*) FROM detail_rows WHERE interface_type IS NOT NULL AND unmapped_interface) AS unmapped"""

_MODULES = """modules AS (SELECT event_id, CASE WHEN json_valid(said) THEN said END AS json
  FROM (SELECT event_id, {} AS said FROM events))""".format(MODULE_JSON_SQL.format(k=_K))


def _json(field: str) -> str:
    return f"coalesce(json_extract_string(json, '$.{field}'), 'null')"


_LABEL = (
    "CASE json_extract_string(json, '$.module') "
    + " ".join(f"WHEN '{m}' THEN {_json('song_source')} || ':' || {_json('song_name')}" for m in ("playlist", "mobile_music"))
    + " " + " ".join(f"WHEN '{m}' THEN '{p}' || {_json(f)}" for m, (p, f) in MODULE_LABELS.items())
    + " END"
)
ORACLES["json_module_label"] = f"""WITH {_MODULES}
SELECT event_id, {_LABEL} AS label, CASE WHEN json IS NULL THEN 'bad_json' WHEN {_LABEL} IS NULL THEN 'unknown_module' END AS reason
FROM modules"""
ORACLES["sql_function_surface"] = f"""WITH {_RAW}, {_MODULES}, asked AS (
  SELECT event_id, {_TIME} AS time, CASE WHEN NOT {_BAD_ESCAPE} THEN url_decode({_TARGET}) END AS request
  FROM raw WHERE {_TARGET} <> '')
SELECT event_id, time, {_param('city')} AS city, {_param('appname')} AS appname,
  {_interface(_PATH)} AS interface_type, {_LABEL} AS label FROM asked JOIN modules USING (event_id)"""
def _nearest(places: str, points: str, max_km: int) -> str:
    return f"""
WITH places AS ({places}), points AS ({points}),
met AS (SELECT id, place_id, address, round(2 * {EARTH_KM} * asin(sqrt(least(1.0,
      pow(sin(radians(q.lat - p.lat) / 2), 2)
      + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2)))), 9) AS km
    FROM points p, places q)
SELECT id, arg_min(address, (km, place_id)) FILTER (km <= {max_km}) AS address FROM met GROUP BY id"""


ORACLES["reverse_geocode_nearest"] = _nearest(
    """SELECT n_nationkey AS place_id, 110.0::DOUBLE + n_nationkey * 0.4::DOUBLE AS lon,
    30.0::DOUBLE + (n_nationkey % 5) * 0.4::DOUBLE AS lat, n_name AS address FROM nation""",
    """SELECT event_id AS id, 110.0::DOUBLE + (event_id % 1000) / 100.0::DOUBLE AS lon,
    30.0::DOUBLE + (event_id % 200) / 100.0::DOUBLE AS lat FROM events""", 30,
)
ORACLES["reverse_geocode_town"] = _nearest(
    """SELECT c_custkey::BIGINT AS place_id, 117.2::DOUBLE + (c_custkey::BIGINT * 7919 % 10007) / 100000.0::DOUBLE AS lon,
    31.8::DOUBLE + (c_custkey::BIGINT * 104729 % 10009) / 100000.0::DOUBLE AS lat, c_name AS address FROM customer""",
    """SELECT event_id::BIGINT AS id, 117.15::DOUBLE + (event_id::BIGINT * 31 % 20011) / 100000.0::DOUBLE AS lon,
    31.75::DOUBLE + (event_id::BIGINT * 17 % 20021) / 100000.0::DOUBLE AS lat FROM events""", 5,
)

# ---- ratings ----

_R = f"""r AS (SELECT user_id::INT AS "user", ({_K})::INT AS item, arg_max(value, event_id) AS rating
  FROM events GROUP BY ALL)"""
_BUCKET = '("user"::BIGINT * 7919 + item::BIGINT * 104729) % 100'
_P = f"""{_R}, p AS (SELECT *, CASE WHEN {_BUCKET} < 60 THEN 'train' WHEN {_BUCKET} < 80 THEN 'validation'
  ELSE 'test' END AS part FROM r)"""
_RATINGS = f'WITH {_R} SELECT "user", item, rating FROM r'

ORACLES["scan_ratings_file"] = _RATINGS
ORACLES["sink_table_replace"] = _RATINGS
ORACLES["filter_predicates"] = """SELECT event_id, event_type, value, props FROM events
WHERE event_type <> 'error' AND value > 0 AND value >= 0.6 AND (event_type = 'click' OR contains(props, '7'))"""
ORACLES["sample_limit"] = f'WITH {_R} SELECT "user", item, rating FROM r ORDER BY "user", item LIMIT 1000'
ORACLES["dataset_profile"] = f"""WITH {_P}
SELECT count(*) AS n_ratings, count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items,
  count(*) FILTER (part = 'train') AS n_train, count(*) FILTER (part = 'validation') AS n_validation,
  count(*) FILTER (part = 'test') AS n_test FROM p"""
ORACLES["distinct_users_items"] = f"""WITH {_R}
SELECT count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items FROM r"""
ORACLES["user_item_grid"] = f"""WITH {_R},
grid AS (SELECT * FROM (SELECT DISTINCT "user" FROM r), (SELECT DISTINCT item FROM r))
SELECT "user", count(*) AS n_cells, count(rating) AS n_rated, count(*) - count(rating) AS n_open
FROM grid LEFT JOIN r USING ("user", item) GROUP BY "user\""""
_USER_MEAN = f"""{_P}, m AS (SELECT "user", avg(rating) AS prediction FROM p WHERE part = 'train' GROUP BY "user"),
scored AS (SELECT "user", item, prediction, rating FROM p JOIN m USING ("user") WHERE part = 'test')"""
ORACLES["rating_prediction_join"] = f"""WITH {_USER_MEAN}
SELECT "user", item, round(prediction, 8) AS prediction, rating FROM scored"""
_ERRORS = """round(avg(abs(prediction - rating)), 6) AS mae, round(sqrt(avg((prediction - rating) ** 2)), 6) AS rmse,
  count(*) AS n_scored"""
ORACLES["rmse"] = f"WITH {_USER_MEAN} SELECT {_ERRORS} FROM scored"
ORACLES["split_union_mean"] = f"""WITH {_P}
SELECT round(avg(rating), 6) AS mean_rating, count(*) AS n_ratings FROM p WHERE part IN ('train', 'validation')"""
ORACLES["baseline_mean_rmse"] = f"""WITH {_P}, m AS (SELECT avg(rating) AS mean FROM p WHERE part <> 'test')
SELECT round(any_value(mean), 6) AS mean_rating, round(sqrt(avg((mean - rating) ** 2)), 6) AS rmse, count(*) AS n_scored
FROM p, m WHERE part = 'test'"""
_TOP = f"""{_R}, top AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS rank FROM r)"""
ORACLES["topk_per_user"] = f'WITH {_TOP} SELECT "user", item, rating, rank FROM top WHERE rank <= 10'
ORACLES["explode_recommendations"] = f'WITH {_TOP} SELECT "user", item AS product, rating FROM top WHERE rank <= 10'
ORACLES["sequential_id"] = f"""WITH {_R}
SELECT row_number() OVER (ORDER BY "user", rating DESC, item) AS id, "user", item, rating AS predict FROM r"""
ORACLES["split_deterministic"] = f'WITH {_P} SELECT "user", item, rating, part FROM p'
ORACLES["ratings_cast"] = f"""WITH c AS (SELECT user_id::INT AS "user",
    try_cast(CASE WHEN event_type = 'signup' THEN event_type ELSE {_K} END AS INT) AS item, value AS rating FROM events)
SELECT *, CASE WHEN item IS NULL THEN 'bad_rating' END AS reason FROM c"""
_LENGTHS = "lengths(source, n) AS (VALUES {})".format(", ".join(f"('{s}', {n})" for s, n in TOP_N.items()))
ORACLES["topn_config_join"] = f"""WITH {_R}, {_LENGTHS},
ranked AS (SELECT *, {SOURCE_CASE.replace('user %', '"user" %')} AS source,
  row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS rank FROM r)
SELECT source, "user", item, rating AS predict FROM ranked JOIN lengths USING (source) WHERE rank <= n"""

# ---- factor vectors ----

_V = "v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS f FROM embeddings)"
ORACLES["user_topk_from_factors"] = f"""WITH {_V},
scored AS (SELECT u.id AS uid, i.id AS product, round(list_inner_product(u.f, i.f), 12) AS s
  FROM v u, v i WHERE u.id % 2 = 0 AND i.id % 2 = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY s DESC, product) AS n FROM scored WHERE s > 0)
SELECT uid, product, round(s, 6) AS rating FROM ranked WHERE n <= 10"""
for _name, _least in (("item_cosine_topk", MIN_COSINE), ("item_similar_at_60", 0.6)):
    ORACLES[_name] = f"""WITH {_V},
scored AS (SELECT a.id AS mid, b.id AS product, round(list_cosine_similarity(a.f, b.f), 12) AS s
  FROM v a, v b WHERE a.id <> b.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY s DESC, product) AS n FROM scored WHERE s >= {_least})
SELECT mid, product, round(s, 6) AS rating FROM ranked WHERE n <= 10"""

# ---- neighbourhoods ----


def _pearson(name: str, key: str, dim: str, left: str = "r", right: str = "r", ordered: bool = False) -> str:
    """Pairs ``a < b`` (or all pairs) of keys of two rating relations. The ratings have two decimals at most; their sums
    are exact decimals, so that equal similarities tie."""
    pairs = "<>" if ordered else "<"
    one, two = (f"""(SELECT "{key}", "{dim}", rating::DECIMAL(12, 2) AS r FROM {side})""" for side in (left, right))
    return f"""{name}_sums AS (
  SELECT x."{key}"::BIGINT AS a, y."{key}"::BIGINT AS b, count(*) AS n, sum(x.r) AS sa, sum(y.r) AS sb,
    sum(x.r * x.r) AS saa, sum(y.r * y.r) AS sbb, sum(x.r * y.r) AS sab
  FROM {one} x JOIN {two} y ON x."{dim}" = y."{dim}" AND x."{key}" {pairs} y."{key}" GROUP BY ALL),
{name}_var AS (SELECT *, n * saa - sa * sa AS va, n * sbb - sb * sb AS vb, n * sab - sa * sb AS c FROM {name}_sums),
{name} AS (SELECT a, b, n, CASE WHEN va > 0 AND vb > 0
  THEN round(c::DOUBLE / sqrt(va::DOUBLE * vb::DOUBLE), 12) END AS sim FROM {name}_var)"""


def _nearest(name: str, pairs: str, n: int) -> str:
    return f"""{name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rn
  FROM {pairs} WHERE sim IS NOT NULL),
{name} AS (SELECT a AS "user", b AS other, sim FROM {name}_ranked WHERE rn <= {n})"""


def _estimates(name: str, neighbours: str, ratings: str) -> str:
    return f"""{name}_votes AS (
  SELECT n."user", o.item, count(*) AS votes, sum(sim * rating) / nullif(sum(sim), 0) AS e
  FROM {neighbours} n JOIN {ratings} o ON o."user" = n.other GROUP BY ALL),
{name} AS (SELECT "user", item, greatest(least(e, (SELECT max(rating) FROM {ratings})),
    (SELECT min(rating) FROM {ratings})) AS prediction FROM {name}_votes WHERE votes >= 2 AND e IS NOT NULL)"""


def _recommend(name: str, estimates: str, seen: str, k: int) -> str:
    return f"""{name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY round(prediction, 12) DESC, item) AS rn
  FROM {estimates} e WHERE NOT EXISTS (SELECT 1 FROM {seen} s WHERE s."user" = e."user" AND s.item = e.item)),
{name} AS (SELECT "user", item, prediction FROM {name}_ranked WHERE rn <= {k})"""


ORACLES["user_pearson"] = f"WITH {_R}, {_pearson('u', 'user', 'item')} SELECT a, b, n, round(sim, 6) AS sim FROM u"
ORACLES["item_pearson"] = f"WITH {_R}, {_pearson('i', 'item', 'user')} SELECT a, b, n, round(sim, 6) AS sim FROM i"
_NEAR = f"{_R}, {_pearson('u', 'user', 'item', ordered=True)}, {_nearest('near', 'u', 100)}"
ORACLES["nearest_n_users"] = f'WITH {_NEAR} SELECT "user", other, round(sim, 6) AS sim FROM near'
_BOUGHT = """r AS (SELECT o_custkey AS "user", l_partkey AS item, sum(l_quantity) AS rating
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)"""
ORACLES["customer_pearson"] = f"WITH {_BOUGHT}, {_pearson('u', 'user', 'item')} SELECT a, b, n, round(sim, 6) AS sim FROM u"
ORACLES["part_pearson"] = f"WITH {_BOUGHT}, {_pearson('i', 'item', 'user')} SELECT a, b, n, round(sim, 6) AS sim FROM i"
ORACLES["nearest_n_customers"] = f"""WITH {_BOUGHT}, {_pearson('u', 'user', 'item', ordered=True)}, {_nearest('near', 'u', 10)}
SELECT "user", other, round(sim, 6) AS sim FROM near"""
_RECOMMEND = f"{_NEAR},{_estimates('est', 'near', 'r')}, {_recommend('rec', 'est', 'r', 10)}"
ORACLES["user_based_recommend"] = f"""WITH {_RECOMMEND}
SELECT "user"::BIGINT AS "user", item, round(prediction, 6) AS prediction FROM rec"""
ORACLES["recommended_because"] = f"""WITH {_RECOMMEND}, {_pearson('i', 'item', 'user', ordered=True)},
scored AS (SELECT t."user", t.item, o.item AS because, (1 + sim) * o.rating AS score
  FROM rec t JOIN r o ON o."user" = t."user" AND o.item <> t.item JOIN i ON i.a = t.item AND i.b = o.item
  WHERE sim IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "user", item ORDER BY round(score, 12) DESC, because) AS rn FROM scored)
SELECT "user"::INT AS "user", item, because, round(score, 6) AS score FROM ranked WHERE rn <= 10"""
_HOLDOUT = f"""{_R}, train AS (SELECT * FROM r WHERE {_BUCKET} < 70), test AS (SELECT * FROM r WHERE {_BUCKET} >= 70),
{_pearson('u', 'user', 'item', 'train', 'train', ordered=True)}, {_nearest('near', 'u', 2)}, {_estimates('est', 'near', 'train')},
scored AS (SELECT prediction, rating FROM est JOIN test USING ("user", item))"""
ORACLES["eval_mae_holdout"] = f"""WITH {_HOLDOUT}
SELECT round(avg(abs(prediction - rating)), 6) AS mae, count(*) AS n_scored FROM scored"""
ORACLES["eval_rms_holdout"] = f"""WITH {_HOLDOUT}
SELECT round(sqrt(avg((prediction - rating) ** 2)), 6) AS rmse, count(*) AS n_scored FROM scored"""
_THRESHOLD = """limits AS (SELECT "user", count(*) AS n_ratings, coalesce(avg(rating) + stddev_samp(rating), '-inf'::DOUBLE)
  AS threshold FROM r GROUP BY "user")"""
ORACLES["relevance_threshold"] = f"""WITH {_R}, {_THRESHOLD}
SELECT "user", n_ratings, round(threshold, 6) AS threshold FROM limits"""
ORACLES["eval_precision_recall_at_k"] = f"""WITH {_TOP}, {_THRESHOLD},
rel AS (SELECT t."user", item FROM top t JOIN limits l USING ("user")
  WHERE rank <= 4 AND rating >= threshold AND n_ratings >= 8),
judged AS (SELECT "user", count(*) AS n_relevant FROM rel GROUP BY "user"),
reduced AS (SELECT r.* FROM r JOIN judged USING ("user") ANTI JOIN rel USING ("user", item)),
{_pearson('u', 'user', 'item', 'reduced', 'r', ordered=True)}, {_nearest('near', 'u', 4)}, {_estimates('est', 'near', 'r')},
{_recommend('rec', 'est', 'reduced', 4)},
by_user AS (SELECT "user", count(*) AS n_rec, count(h.item) AS n_hit FROM rec LEFT JOIN rel h USING ("user", item) GROUP BY "user")
SELECT round(avg(n_hit / n_rec), 6) AS "precision", round(avg(coalesce(n_hit, 0) / n_relevant), 6) AS recall,
  count(*) AS n_users, coalesce(sum(n_rec), 0)::BIGINT AS n_recommended, sum(coalesce(n_hit, 0))::BIGINT AS n_hits
FROM judged LEFT JOIN by_user USING ("user")"""
