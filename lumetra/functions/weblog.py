"""Expressions over access-log fields, as Spark SQL text.

Each function takes SQL text (a column name, mostly) and returns SQL text, for ``F.expr`` and
``selectExpr``; ``functions.sql`` registers the same texts as SQL functions. All are built-in
expressions; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

# ---- Fixed values: patterns and formats of the log fields ----
LINE_PATTERN = r'([^ ]*) ([^ ]*) ([^ ]*) (\[.*\]) (".*?") (-|[0-9]*) (-|[0-9]*) (".*?") (".*?")'
INTERFACE_PATTERN = r"/([A-Za-z]+/.*/.*[A-Za-z]+)"
PARAM_VALUE_CLASS = r"[一-龥A-Za-z0-9_(-?]"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# ---- end of fixed values ----

N_FIELDS = 9


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def line_fields(line: str) -> str:
    """The nine fields of a log line as an array, or an array of another size if it does not match.

    The pattern is searched, not anchored, and runs once per line: the match is rewritten to
    its groups joined by a separator character. A line that itself holds that character takes
    the slower way of one extraction per group.
    """
    pattern, groups = text(LINE_PATTERN), range(1, N_FIELDS + 1)
    whole = text(f"^(?s:.*?){LINE_PATTERN}(?s:.*)$")
    joined = "'" + r"\u0001".join(f"${i}" for i in groups) + "'"
    once = rf"split(regexp_replace({line}, {whole}, {joined}), '\u0001')"
    each = ", ".join(f"regexp_extract({line}, {pattern}, {i})" for i in groups)
    by_group = f"CASE WHEN rlike({line}, {pattern}) THEN array({each}) ELSE array({line}) END"
    return rf"CASE WHEN contains({line}, '\u0001') THEN {by_group} ELSE {once} END"


def strip_brackets(c: str) -> str:
    return f"translate({c}, '[]', '')"


def _month_number(name: str) -> str:
    numbers = ", ".join(f"'{m.lower()}', '{i:02d}'" for i, m in enumerate(MONTHS, start=1))
    return f"try_element_at(map({numbers}), lower({name}))"


def log_time_text(time: str) -> str:
    """``dd/MMM/yyyy:HH:mm:ss ...`` to ``yyyy-MM-dd HH:mm:ss``; wall clock kept, offset ignored.

    Blank gives NULL, unreadable gives ''. Out-of-range parts roll over (day 32 is the next
    month's first or second), as a lenient calendar does. No session time zone takes part.
    """
    strict = text(r"^(0[1-9]|1\d|2[0-8])/[A-Za-z]{3}/\d{4}:([01]\d|2[0-3]):[0-5]\d:[0-5]\d")
    plain = (
        f"concat(substr({time}, 8, 4), '-', {_month_number(f'substr({time}, 4, 3)')}, '-', "
        f"substr({time}, 1, 2), ' ', substr({time}, 13, 8))"
    )
    loose = text(r"^(\d{1,4})/([A-Za-z]{3})/(\d{4}):(\d{1,5}):(\d{1,5}):(\d{1,5})")

    def part(i: int) -> str:
        return f"regexp_extract(replace({time}, '\"', ''), {loose}, {i})"

    first = f"try_cast(concat({part(3)}, '-', {_month_number(part(2))}, '-01 00:00:00') AS TIMESTAMP_NTZ)"
    day, hour, minute, second = (f"try_cast({part(i)} AS INT)" for i in (1, 4, 5, 6))
    shift = f"make_dt_interval({day} - 1, {hour}, {minute}, cast({second} AS DECIMAL(18,6)))"
    return (
        f"CASE WHEN rlike({time}, {strict}) THEN coalesce({plain}, '') "
        f"WHEN {time} IS NULL OR trim({time}) = '' THEN NULL "
        f"ELSE coalesce(date_format({first} + {shift}, 'yyyy-MM-dd HH:mm:ss'), '') END"
    )


def request_method(request: str) -> str:
    return f"replace(split_part({request}, ' ', 1), '\"', '')"


def request_target(request: str) -> str:
    """Second space-separated token without quotes; '' when there is none."""
    return f"replace(split_part({request}, ' ', 2), '\"', '')"


def url_text(url: str, plus_as_space: bool = False) -> str:
    """Percent-decode as UTF-8; a bad escape gives NULL. A ``+`` stays unless asked otherwise."""
    if plus_as_space:
        return f"try_url_decode({url})"
    return f"CASE WHEN contains({url}, '%') THEN try_url_decode(replace({url}, '+', '%2B')) ELSE {url} END"


def url_path(url: str) -> str:
    return f"split_part({url}, '?', 1)"


def interface_of(path: str) -> str:
    """First ``/letters/.../...letters`` part of a path, or NULL."""
    return f"nullif(regexp_extract({path}, {text(INTERFACE_PATTERN)}, 0), '')"


def _param_hit(url: str, name: str) -> str:
    """The matching ``?name=value&`` of a URL that ends in ``&``, or ''."""
    pattern = f"concat('[?&]#?', {name}, {text(f'={PARAM_VALUE_CLASS}*&')})"
    return f"regexp_extract({url}, {pattern}, 0)"


def _param_value(hit: str) -> str:
    return f"replace(split_part(nullif({hit}, ''), '=', 2), '&', '')"


def url_param(url: str, name: str) -> str:
    """Value of a query parameter: NULL if absent, '' if empty. ``name`` is SQL text as well.

    The first occurrence whose value holds allowed characters only counts; the value ends at
    a further ``=``.
    """
    return _param_value(_param_hit(f"concat({url}, '&')", name))


def one_param(closed_url: str, which: str, names: Sequence[str]) -> str:
    """The parameter that the column ``which`` names, of a URL that ends in ``&``. One constant
    pattern per name: patterns compile once per task, and only the row's own arm runs."""
    arms = " ".join(f"WHEN '{n}' THEN {_param_hit(closed_url, text(n))}" for n in names)
    return _param_value(f"CASE {which} {arms} END")


def printed(c: str) -> str:
    """NULL as the text 'null', as string concatenation prints it."""
    return f"coalesce({c}, 'null')"


# ---- Fixed values: label of each module, as (prefix, JSON field) ----
SONG_MODULES = ["playlist", "mobile_music"]
MODULE_LABELS = {
    "radio": ("收听电台:", "album_name"),
    "voice_search": ("搜索内容：", "end_point"),
    "wechat": ("昵称：", "user_name"),
    "qq_music": ("qq音乐：", "music_name"),
    "video": ("投屏内容：", "video_name"),
}
# ---- end of fixed values ----


def module_fields(json: str) -> str:
    """A module event's JSON text as a struct, parsed once; ``_corrupt_record`` holds a bad text."""
    names = ["module", "song_source", "song_name", *(f for _, f in MODULE_LABELS.values()), "_corrupt_record"]
    schema = ", ".join(f"{n} STRING" for n in names)
    return f"from_json({json}, '{schema}', map('columnNameOfCorruptRecord', '_corrupt_record'))"


def module_label(event: str) -> str:
    """Label of the struct ``module_fields`` gives; NULL for an unknown module."""
    songs = ", ".join(f"'{m}'" for m in SONG_MODULES)
    song = f"concat({printed(f'{event}.song_source')}, ':', {printed(f'{event}.song_name')})"
    arms = [f"WHEN {event}.module IN ({songs}) THEN {song}"]
    for name, (prefix, field) in MODULE_LABELS.items():
        arms.append(f"WHEN {event}.module = '{name}' THEN concat('{prefix}', {printed(f'{event}.{field}')})")
    return "CASE " + " ".join(arms) + " END"
