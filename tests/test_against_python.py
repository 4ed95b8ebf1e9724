"""The text expressions against the same rules in plain Python, on many random texts."""

import random
import re
from datetime import datetime, timedelta

import pyarrow as pa

from lumetra.functions import weblog as W


def texts(pieces, n, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(length))) for _ in range(n)]


def evaluated(spark, values, expr):
    """Evaluated by generated code: the rows come from a shuffle, not from a local relation."""
    df = spark.createDataFrame(pa.table({"i": list(range(len(values))), "v": values})).repartition(2)
    return [r["r"] for r in df.selectExpr("i", f"{expr} AS r").orderBy("i").collect()]


URL_PARAMS = [
    ("?page=12", "12"), ("/a?x=1&page=ab&y=2", "ab"), ("?page=", ""), ("&#page=屋&z", "屋"), ("?apage=3", None),
    ("?page=%20", None), ("?page=a b&page=c", "c"), ("page=1", None), ("?page=a=b", "a"), ("?page=1.5", "1.5"), ("", None),
    ("?Page=1", None), ("?page=x&page=y", "x"), ("??page=7", "7"), ("?##page=7", None), ("/page/9?page", None),
]


def test_url_param(spark):
    urls, values = zip(*URL_PARAMS, strict=True)
    assert evaluated(spark, list(urls), W.url_param("v", "'page'")) == list(values)


def test_interface(spark):
    def rule(path):
        hit = re.search(W.INTERFACE_PATTERN, path)
        return hit and hit.group(0)

    paths = texts(["/", "//", "Ab", "c", "1", "_", "\\", ".", "-"], 4000, 14, 2)
    assert evaluated(spark, paths, W.interface_of("v")) == [rule(p) for p in paths]


def test_line_fields(spark):
    pattern = re.compile(W.LINE_PATTERN)

    def rule(line):
        hit = pattern.search(line)
        return hit and list(hit.groups())

    pieces = [" ", " ", '"', "[", "]", "-", "12", "a", "\u0001", "$1", "\\", " - ", '"x" ', ' "y"', "[t] "]
    lines = texts(pieces, 3000, 30, 3)
    rng = random.Random(4)
    for _ in range(3000):
        parts = ["h", "-", "u", "[t [z]]", '"GET /a b"', rng.choice(["200", "-", ""]), rng.choice(["7", "-"]), '"r"', '"a"']
        line = " ".join(parts)
        cut = rng.randrange(len(line))
        lines.append(line[:cut] + rng.choice(pieces) + line[cut:] if rng.random() < 0.7 else "x " + line + " tail")
    got = [f if len(f) == 9 else None for f in evaluated(spark, lines, W.line_fields("v"))]
    want = [rule(line) for line in lines]
    assert sum(w is not None for w in want) > 2000
    assert [(a, g, w) for a, g, w in zip(lines, got, want) if g != w] == []


def test_lenient_time(spark):
    rng = random.Random(5)
    values, want = [], []
    for _ in range(2000):
        d, h, mi, s = rng.randrange(1, 45), rng.randrange(0, 30), rng.randrange(0, 75), rng.randrange(0, 75)
        m, y = rng.randrange(12), rng.randrange(1990, 2040)
        name = rng.choice([str.upper, str.lower, str.title])(W.MONTHS[m])
        values.append(f"{d:02d}/{name}/{y}:{h:02d}:{mi:02d}:{s:02d} +0{rng.randrange(10)}00")
        want.append(str(datetime(y, m + 1, 1) + timedelta(days=d - 1, hours=h, minutes=mi, seconds=s)))
    assert evaluated(spark, values, W.log_time_text("v")) == want
