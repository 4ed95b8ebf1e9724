import pytest
from pyspark.sql import functions as F

from lumetra.operators import interfaces as I
from lumetra.operators import logs as L
from lumetra.plans.log_jobs import run_detail_job, run_page_job
from lumetra.schemas import LOG_CLEAN, LOG_DETAIL_COLUMNS, LOG_RAW_COLUMNS, select_schema
from lumetra.sources.logs import append_orc


def line(target="/MobileInternet/user/welcome?userid=7", method="GET", time="17/Aug/2021:08:12:30 +0800", size="5"):
    return f'1.2.3.4 - - [{time}] "{method} {target} HTTP/1.1" 200 {size} "-" "ua"'


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def detail(spark, *values, **options):
    return L.detail_rows(L.parse_lines(lines(spark, *values)), **options)


def test_bad_rows_are_quarantined_with_a_reason(spark):
    rows = detail(
        spark, "bad line", '1 - - [17/Aug/2021:08:12:30 +0800] "GARBAGE" 400 - "-" "-"', line("/A/b/c?x=%zz"),
        line(time=""), line("/A/b"), line("/A/b/c", method="POST"), line("/x/%zz", method="POST"), line(),
    )
    bad = {r["raw"]: r["reason"] for r in L.quarantine(rows).collect()}
    assert sorted(bad.values()) == [
        "bad_encoding", "bad_encoding", "bad_time", "no_interface", "no_target", "unparsable_line"
    ]
    assert bad["bad line"] == "unparsable_line"
    assert [r["user_id"] for r in L.good_rows(rows).collect()] == ["7"]


def test_strict_raises_with_counts(spark):
    with pytest.raises(ValueError, match="unparsable_line.*2"):
        L.check_strict(L.parse_lines(lines(spark, "x", "y", line())))
    L.check_strict(L.parse_lines(lines(spark, line())))


def test_a_page_named_in_the_query_counts_once_per_page(spark):
    parsed = L.good_rows(L.parse_lines(lines(
        spark, line("/MobileInternet/user/welcome?ref=/MobileInternet/index/sn&again=/MobileInternet/index/sn"),
        line("/mobileinternet/index/sn"), line("/MobileInternet/Radio/collectRadio_list"),
    )))
    pages = sorted(r["page"] for r in L.page_filter(parsed).collect())
    assert pages == ["/MobileInternet/Radio/collectRadio_list", "/MobileInternet/index/sn", "/MobileInternet/user/welcome"]
    assert L.page_filter(parsed, dedupe=True).count() == 2
    assert L.page_filter(parsed, pages=["(", "a.b"]).count() == 0
    assert L.page_filter(parsed, pages=["w.lcome"], dedupe=True).count() == 0


def expected_labels(path, url_params):
    """The rules by plain Python, for one path spelling."""
    by_path = {r[0]: r for r in I.RULES}
    rule, single = by_path.get(path), by_path.get(path.replace("//", "/"))

    def shown(name):
        return str(url_params.get(name)) if url_params.get(name) is not None else "null"

    text = None
    if rule and rule[3] == "text":
        text = rule[4]
    elif rule and rule[3] == "wrap":
        text = rule[4] + shown(rule[5]) + rule[6]
    elif rule and rule[3] == "bare":
        text = url_params.get(rule[5])
    elif rule and rule[3] == "choice":
        text = I.COLLECTED_SONGS if url_params.get("type") == "0" else I.COLLECTED_LISTS
    where = None
    if single and single[7] is not None:
        where = I.NO_LOCATION if single[7] == "" else I.LOCATION_PREFIX + shown(single[7])
    return (rule[1], rule[2], text, where) if rule else (None, None, None, where)


@pytest.mark.parametrize("params", [{}, {"type": "0", "page": "3", "city": "合肥", "location": "路1", "title": "t", "track_name": "屋顶"}])
def test_every_rule(spark, params):
    paths = [r[0] for r in I.RULES] + ["/MobileInternet/service/getIcon", "//MobileInternet/index/sn"]
    query = "&".join(f"{k}={v}" for k, v in params.items())
    cleaned = spark.createDataFrame([(p + "?" + query, None) for p in paths], "request string, reason string")
    rows = {r["request"]: r for r in L.with_labels(cleaned).collect()}
    assert len(rows) == len(paths)
    for path in paths:
        r = rows[path + "?" + query]
        assert (r["act"], r["action"], r["detail"], r["location"]) == expected_labels(path, params), path
        assert r["unmapped_interface"] == (r["act"] is None)


def test_rules_are_unique_and_pages_distinct():
    assert len({r[0] for r in I.RULES}) == len(I.RULES) == 35
    assert len(set(I.PAGES)) == len(I.PAGES) == 31


def test_city_fallback_is_an_option(spark):
    url = line("/MobileInternet/user/welcome?city=X&location=")
    assert detail(spark, url).first()["location"] == "上报位置："
    assert detail(spark, url, fallback_to_city=True).first()["location"] == "上报位置：X"


def test_typed_extras(spark):
    row = L.typed_extras(L.clean(L.parse_lines(lines(spark, line(size="-"))))).first()
    assert (row["status_code"], row["size_bytes"], str(row["event_ts"])) == (200, None, "2021-08-17 08:12:30")


def test_decoding_comes_before_the_parameters_are_cut(spark):
    row = detail(spark, line("/MobileInternet/user/putSearchRecord?addr=a%26userid=9&userid=7")).first()
    assert (row["detail"], row["user_id"]) == ("a", "9")


def test_label_modules_sets_reasons(spark):
    events = spark.createDataFrame(
        [(1, '{"module":"video","video_name":"v"}'), (2, "{oops"), (3, '{"module":"x"}'), (4, None)], "id int, json string"
    )
    got = {r["id"]: (r["label"], r["reason"]) for r in L.label_modules(events).collect()}
    assert got == {1: ("投屏内容：v", None), 2: (None, "bad_json"), 3: (None, "unknown_module"), 4: (None, "bad_json")}


def test_select_schema_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="ipaddress"):
        select_schema(spark.range(1), LOG_CLEAN)


def test_page_job_then_detail_job(spark, tmp_path):
    texts = [line(), line("/MobileInternet/service/getIcon"), "bad", line("/other/a/b"), line("/MobileInternet/index/sn?x=%zz")]
    lines(spark, *texts).write.text(str(tmp_path / "in"))
    run_page_job(spark, str(tmp_path / "in" / "*.txt"), str(tmp_path / "ods"), quarantine_path=str(tmp_path / "bad"))
    ods = spark.read.orc(str(tmp_path / "ods"))
    assert ods.columns == LOG_RAW_COLUMNS and ods.count() == 3
    assert [r["raw"] for r in spark.read.orc(str(tmp_path / "bad")).collect()] == ["bad"]

    counts = run_detail_job(spark, ods, "detail_job", quarantine_path=str(tmp_path / "bad2"))
    assert counts == {"detail_rows": 2, "bad_rows": 1, "unmapped_rows": 1}
    table = spark.table("detail_job")
    assert table.columns == LOG_DETAIL_COLUMNS and table.count() == 2
    bad = spark.read.orc(str(tmp_path / "bad2")).first()
    assert (bad["reason"], bad["raw"]) == ("bad_encoding", texts[4])
    with pytest.raises(Exception, match="detail_job"):
        run_detail_job(spark, ods, "detail_job")
    assert run_detail_job(spark, ods, "detail_job", replace=True)["detail_rows"] == 2
    with pytest.raises(ValueError, match="bad_encoding"):
        run_detail_job(spark, ods, "detail_job", replace=True, strict=True)


def test_stored_lines_rebuild_the_raw_line(spark):
    parsed = L.good_rows(L.parse_lines(lines(spark, line())))
    assert L.from_table(parsed).first()["raw"] == line()


def test_parse_runs_one_regex_stage_and_detail_does_not_shuffle(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    append_orc(L.good_rows(L.parse_lines(lines(spark, line()))), path)
    plan = L.good_rows(L.detail_rows(L.from_table(spark.read.orc(path))))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Python" not in plan
    read = plan.split("ReadSchema")[1].split("\n")[0]
    assert "request" in read


def test_partitioned_append(spark, tmp_path):
    df = spark.range(6).withColumn("dt", F.col("id") % 2)
    append_orc(df, str(tmp_path / "p"), coalesce_to=1, partition_by=["dt"])
    append_orc(df, str(tmp_path / "p"), coalesce_to=1, partition_by=["dt"])
    assert spark.read.orc(str(tmp_path / "p")).count() == 12
    assert len(list((tmp_path / "p" / "dt=0").glob("*.orc"))) == 2


def test_a_null_line_is_unparsable(spark):
    row = L.parse_lines(spark.createDataFrame([(None,)], "value string")).first()
    assert row["reason"] == "unparsable_line"
