import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumetra.functions import weblog as W
from lumetra.functions.sql import register_sql_functions


def evaluate(spark, value, expr):
    df = spark.createDataFrame(pa.table({"v": pa.array([value], pa.string())}))
    return df.selectExpr(f"{expr} AS r").first()["r"]


PARAMS = [
    ("/p?page=2", "2"), ("/p?page=", ""), ("/p?x=1", None), ("/p?page=a b&page=7", "7"),
    ("/p?apage=3&page=4", "4"), ("/p?page=a=b", "a"), ("/p?#page=9", "9"), ("/p?page=a%b", None),
    ("/p?page==b", ""), ("/p?page=屋顶&x=1", "屋顶"), ("/p?x=1&page=(+3.5)", "(+3.5)"), ("page=1", None),
    ("/p?page=1&page=2", "1"), (None, None),
]


@pytest.mark.parametrize("url,want", PARAMS)
def test_url_param(spark, url, want):
    assert evaluate(spark, url, W.url_param("v", "'page'")) == want


INTERFACES = [
    ("//MobileInternet/index/get_Banner\\", "/MobileInternet/index/get_Banner"), ("/A/b", None),
    ("/A/b/c2", "/A/b/c"), ("/Mobile1/b/c", None), ("/A/b/c/", "/A/b/c"), ("/A//c", "/A//c"), ("", None),
]


@pytest.mark.parametrize("path,want", INTERFACES)
def test_interface_of(spark, path, want):
    assert evaluate(spark, path, W.interface_of("v")) == want


TIMES = [
    ("17/Aug/2021:08:12:30 +0800", "2021-08-17 08:12:30"), ("17/aug/2021:08:12:30", "2021-08-17 08:12:30"),
    ("32/Aug/2021:08:12:30 +0800", "2021-09-01 08:12:30"), ("29/Feb/2019:00:00:00", "2019-03-01 00:00:00"),
    ("31/Dec/2019:24:00:00", "2020-01-01 00:00:00"), ("29/Feb/2020:23:59:59", "2020-02-29 23:59:59"),
    ('"01/Jan/2020:00:00:00"', "2020-01-01 00:00:00"), ("17/Foo/2021:08:12:30", ""), ("soon", ""),
    ("05/Jan/2019:05:61:00", "2019-01-05 06:01:00"), ("  ", None), ("", None), (None, None),
]


@pytest.mark.parametrize("time,want", TIMES)
def test_log_time_text(spark, time, want):
    assert evaluate(spark, time, W.log_time_text("v")) == want


def test_time_keeps_the_wall_clock_in_any_zone(spark):
    """02:30 does not exist on that day in New York; the text must not move."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert evaluate(spark, "10/Mar/2019:02:30:00 +0800", W.log_time_text("v")) == "2019-03-10 02:30:00"
        assert evaluate(spark, "41/Feb/2019:02:30:00", W.log_time_text("v")) == "2019-03-13 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


DECODED = [
    ("%E5%B1%8B%E9%A1%B6", "屋顶"), ("a+b", "a+b"), ("a+%20b", "a+ b"), ("%zz", None), ("%4", None), ("plain", "plain"),
    ("\\x00\\x9C+<M", "\\x00\\x9C+<M"), ("", ""),
]


@pytest.mark.parametrize("url,want", DECODED)
def test_url_text(spark, url, want):
    assert evaluate(spark, url, W.url_text("v")) == want


def test_url_text_with_plus_as_space(spark):
    assert evaluate(spark, "a+%2Bb", W.url_text("v", plus_as_space=True)) == "a +b"


LINE = '1.2.3.4 - u [17/Aug/2021:08:12:30 +0800] "GET /a?b=\\"c HTTP/1.1" 200 - "-" "ua x" trailing'
FIELDS = ["1.2.3.4", "-", "u", "[17/Aug/2021:08:12:30 +0800]", '"GET /a?b=\\"c HTTP/1.1"', "200", "-", '"-"', '"ua x"']


@pytest.mark.parametrize("line", [LINE, "noise " + LINE, "\u0085 " + LINE])
def test_line_fields_like_one_extraction_per_group(spark, line):
    one_by_one = [f"regexp_extract(v, {W.text(W.LINE_PATTERN)}, {i})" for i in range(1, 10)]
    want = evaluate(spark, line, f"array({', '.join(one_by_one)})")
    assert evaluate(spark, line, W.line_fields("v")) == want
    assert len(want) == 9


def test_line_fields(spark):
    assert evaluate(spark, LINE.replace('\\"', ""), W.line_fields("v")) == [f.replace('\\"', "") for f in FIELDS]
    with_separator = LINE.replace('\\"', "").replace("ua x", "ua\u0001x")
    assert evaluate(spark, with_separator, W.line_fields("v"))[8] == '"ua\u0001x"'
    assert len(evaluate(spark, "bad line", W.line_fields("v"))) != 9
    assert len(evaluate(spark, "a\u0001b\u0001c\u0001d\u0001e\u0001f\u0001g\u0001h\u0001i", W.line_fields("v"))) != 9


MODULES = [
    ('{"module":"playlist","song_source":"车友歌单","song_name":"光的方向"}', "车友歌单:光的方向"),
    ('{"module":"mobile_music","song_source":"a"}', "a:null"), ('{"module":"radio","album_name":"x"}', "收听电台:x"),
    ('{"module":"voice_search","end_point":"y"}', "搜索内容：y"), ('{"module":"wechat","user_name":"n"}', "昵称：n"),
    ('{"module":"qq_music","music_name":7}', "qq音乐：7"), ('{"module":"video"}', "投屏内容：null"),
    ('{"module":"other"}', None), ('{"song_name":"x"}', None), ("{broken", None), (None, None),
]


@pytest.mark.parametrize("json,want", MODULES)
def test_module_label_as_sql_function(spark, json, want):
    register_sql_functions(spark)
    assert evaluate(spark, json, "module_label(v)") == want


def test_sql_functions_equal_the_expressions(spark):
    register_sql_functions(spark)
    for time, want in TIMES:
        assert evaluate(spark, time, "log_time_text(v)") == want
    for url, want in PARAMS:
        assert evaluate(spark, url, "url_param(v, 'page')") == want
    for path, want in INTERFACES:
        assert evaluate(spark, path, "interface_of(v)") == want
    for url, want in DECODED:
        assert evaluate(spark, url, "url_text(v)") == want


def test_no_python_udf_in_the_functions(spark):
    register_sql_functions(spark)
    df = spark.range(1).select(F.expr("url_param('/p?page=1', 'page')").alias("r"))
    assert "Python" not in df._jdf.queryExecution().toString()
