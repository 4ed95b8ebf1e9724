"""Personal data in texts: fixed patterns, and boosted trees over looser candidates.

Only DataFrame and SQL functions touch the texts. High-recall patterns propose overlapping spans; each gets format and
context features. The trees learn from what the fixed patterns confirm, by positive-unlabelled learning: a candidate that
overlaps a confirmed span of its kind is an example, any other is unlabelled and only ranks below what looks more like the
examples. The features leave out what tells a confirmed form from a loose one ('+' and country code, '@' and '.', the kind
of separator), so that loose forms look as the confirmed ones do. Features take few values, so the training data of any
number of documents is a table of counts per feature row, and the trees are grown on that. Per kind, a threshold is set on
documents that the trees did not learn from.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

#: The fixed patterns, written so that they neither backtrack nor recurse on long texts. A possessive run before '@' has
#: to start where the run does, or where the match before ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of these has none of the fixed pattern (of the loose pattern); they are cheap to test.
HINT = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?+[0-9]){11}",
    "phone": r"\+[0-9]",
}
LOOSE_HINT = {
    "email": r"@|[(\[]at[)\]]",
    "ip": r"[0-9][.,][0-9]++[.,][0-9]++[.,][0-9]",
    "card": r"[0-9](?:[\x20.-]{0,2}+[0-9]){11}",
    "phone": r"[0-9](?:[\x20().-]{0,3}+[0-9]){8}",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:[.,][0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]{0,2}+[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9])[0-9](?:[\x20().-]{0,3}+[0-9]){8,14}+(?![0-9])",
}
#: Words before a span that speak for its kind.
NEAR = r"(?i)(?:mail|contact|tel|phone|call|fax|mobile|card|visa|amex|iban|account|ip|host|server|address)\W*$"

FEATURES = ("digits", "groups", "last", "prior", "first", "before", "after", "near")
MAX_DIGITS = 20


@dataclass(frozen=True)
class Split:
    """A node of a tree: ``feature <= at`` goes to ``yes``, else to ``no``; leaves are numbers."""

    feature: str
    at: int
    yes: Split | float
    no: Split | float

    def sql(self) -> str:
        def branch(node: Split | float) -> str:
            return node.sql() if isinstance(node, Split) else f"{node!r}D"

        return f"CASE WHEN c.{self.feature} <= {self.at} THEN {branch(self.yes)} ELSE {branch(self.no)} END"

    def value(self, row: dict[str, int]) -> float:
        node = self.yes if row[self.feature] <= self.at else self.no
        return node.value(row) if isinstance(node, Split) else node


@dataclass(frozen=True)
class Boosted:
    """Boosted trees per kind and the probability from which a candidate is taken; kinds without trees add nothing."""

    bias: dict[str, float]
    trees: dict[str, tuple[Split, ...]]
    threshold: dict[str, float]

    def probability(self, kind: str) -> str:
        terms = [f"{self.bias[kind]!r}D", *(t.sql() for t in self.trees[kind])]
        return f"1 / (1 + exp(-({' + '.join(terms)})))"


#: Elements of an array that are summed up at a time: appending copies what is there.
BLOCK = 256


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(values: str, following: str) -> str:
    """SQL for what ``following`` (of ``a.at`` and ``x``; a sum or maximum) gives over the elements before each one, from 0.
    Blocks first, then the elements of each, so that long arrays take time in proportion to their length."""

    def scan(items: str, start: str) -> str:
        return f"""aggregate({items}, named_struct('at', {start}, 'out', cast(array() as array<int>)),
          (a, x) -> named_struct('at', {following}, 'out', array_append(a.out, a.at)), a -> a.out)"""

    total = f"aggregate(b, named_struct('at', 0), (a, x) -> named_struct('at', {following}), a -> a.at)"
    blocks = f"transform(sequence(0, greatest(size(v) - 1, 0) DIV {BLOCK}), b -> slice(v, int(b) * {BLOCK} + 1, {BLOCK}))"
    return _let("v", values, _let("w", blocks, _let("o", scan(f"transform(w, b -> {total})", "0"),
                f"flatten(transform(w, (b, i) -> {scan('b', 'o[i]')}))")))


def _below(spans: str, c: str) -> str:
    """SQL for the number of ``spans`` (none overlaps another, in order) that end before ``c`` starts, by halving."""
    further = "n + shiftleft(1, j)"
    return f"""aggregate(sequence(char_length(bin(size({spans}))) - 1, 0, -1), 0, (n, j) ->
      CASE WHEN {further} <= size({spans}) AND {spans}[{further} - 1].e <= {c}.s THEN {further} ELSE n END)"""


def _meets(spans: str, c: str) -> str:
    """SQL for whether one of ``spans`` overlaps ``c``."""
    return f"(size({spans}) > 0 AND {_let('n', _below(spans, c), f'n < size({spans}) AND {spans}[n].s < {c}.e')})"


def _matches(text: str, pattern: str) -> str:
    """SQL for the matches in order: start and end as code points, the text, some of what stands before, and what
    two characters come after. ``split`` and ``regexp_extract_all`` find the same matches."""
    start = "at[i] + char_length(g[i])"
    return _let("f", f"regexp_extract_all({text}, r'{pattern}', 0)", _let("g", f"split({text}, r'{pattern}', -1)", _let(
        "at", _running("transform(f, (m, i) -> char_length(g[i]) + char_length(m))", "a.at + x"),
        f"""transform(f, (m, i) -> named_struct('s', {start}, 'e', {start} + char_length(m), 'm', m,
          'before', right(g[i], 16), 'after', left(g[i + 1], 2)))""")))


_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
_LUHN = f"""aggregate(sequence(1, char_length({_DIGITS})), 0, (a, i) -> a +
  CASE WHEN i % 2 = 1 THEN int(substr({_DIGITS}, char_length({_DIGITS}) - i + 1, 1))
       WHEN int(substr({_DIGITS}, char_length({_DIGITS}) - i + 1, 1)) > 4
         THEN 2 * int(substr({_DIGITS}, char_length({_DIGITS}) - i + 1, 1)) - 9
       ELSE 2 * int(substr({_DIGITS}, char_length({_DIGITS}) - i + 1, 1)) END) % 10 = 0"""
_VALID = {
    "email": "true",
    "ip": r"""forall(transform(split(x.m, r'\.'), p -> ltrim('0', p)),
      p -> char_length(p) < 3 OR char_length(p) = 3 AND p <= '255')""",
    "card": f"CASE WHEN char_length({_DIGITS}) BETWEEN 12 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"char_length({_DIGITS}) BETWEEN 9 AND 15",
}
_NONE = "cast(array() as array<struct<s:int,k:int,e:int>>)"


def _base(kind: str) -> str:
    k = KINDS.index(kind)
    return f"""CASE WHEN _text RLIKE r'{HINT[kind]}' THEN
      transform(filter({_matches('_text', BASE[kind])}, x -> {_VALID[kind]}),
                x -> named_struct('s', x.s, 'k', {k}, 'e', x.e)) ELSE {_NONE} END"""


#: The form of a candidate without what only the fixed pattern of its kind has. A phone number has no country code (what
#: comes first after '+' or 00) and no 0 in front; separators are alike.
_INTERNATIONAL = r"(x.before RLIKE r'[+][(]?$' OR x.m RLIKE '^00[1-9]')"
_PHONE = r"regexp_replace(x.m, r'[\x20().-]+', '-')"
FORM = {
    "email": r"regexp_replace(regexp_replace(x.m, r'\x20?[(\[]at[)\]]\x20?', '@'), r'\x20?[(\[]dot[)\]]\x20?', '.')",
    "ip": "replace(x.m, ',', '.')",
    "card": r"regexp_replace(x.m, r'[\x20.-]+', '-')",
    "phone": f"""ltrim('0-', CASE WHEN {_INTERNATIONAL} THEN regexp_replace({_PHONE}, '^(?:00)?[0-9]{{1,3}}-', '')
      ELSE {_PHONE} END)""",
}
#: What shows that a candidate is not of its kind, whatever its form and context.
AGAINST = {
    "email": "false",
    # a number above 255, or a part of a longer list
    "ip": f"(NOT ({_VALID['ip'].replace('x.m', FORM['ip'])}) OR x.before RLIKE '[0-9][.,]$' OR x.after RLIKE '^[.,][0-9]')",
    "card": f"NOT ({_VALID['card']})",
    "phone": r"x.before RLIKE r'[0-9][\x20().-]{1,3}$'",  # the end of a longer number
}


def _features(kind: str) -> dict[str, str]:
    """SQL by feature over ``y``: the ``parts`` of the form, and ``before`` and ``after`` the candidate."""
    digits = "char_length(regexp_replace(array_join({}, ''), '[^0-9]', ''))"
    length = "coalesce(least(char_length(try_element_at(y.parts, {})), 5), 0)"
    digits = {"email": digits.format("slice(y.parts, -1, 1)"), "ip": f"least({digits.format('y.parts')}, 9)",
              "card": digits.format("y.parts"), "phone": f"least({digits.format('y.parts')}, 10)"}[kind]
    return {
        # a mail address may have any digits but at its end; a number without separators may begin with a country code
        "digits": f"least({digits}, {MAX_DIGITS})",
        # a card number has no groups or groups of four and more; three threes in a row may be thousands
        "groups": {"card": "int(exists(y.parts, p -> char_length(p) < 4))",
                   "ip": "int(forall(slice(y.parts, 2, 3), p -> char_length(p) = 3))"}.get(kind, "least(size(y.parts), 3)"),
        "last": "0" if kind in ("ip", "card") else length.format(-1),
        "prior": length.format(-2) if kind == "phone" else "0",
        "first": "int(left(y.parts[0], 1))" if kind == "card" else "0",
        "before": r"int(regexp_replace(y.before, '[+(]+$', '') RLIKE r'[\p{L}0-9]$')",
        "after": r"int(y.after RLIKE r'^[\p{L}0-9]')",
        "near": f"int(y.before RLIKE r'{NEAR}')",
    }


def _loose(kind: str) -> str:
    """Candidates of a kind with their features, all of them small whole numbers, whether something speaks against them, and
    whether they overlap a confirmed span of the same kind or of another (``base``, a list per kind)."""
    k = KINDS.index(kind)
    other = " OR ".join(_meets(f"base[{i}]", "y") for i in range(len(KINDS)) if i != k)
    features = ", ".join(f"'{f}', {sql}" for f, sql in _features(kind).items())
    return f"""CASE WHEN _text RLIKE r'{LOOSE_HINT[kind]}' THEN transform(transform({_matches('_text', LOOSE[kind])},
      x -> named_struct('s', x.s, 'e', x.e, 'parts', split({FORM[kind]}, '[^0-9A-Za-z]+'), 'before', x.before,
        'after', x.after, 'against', {AGAINST[kind]})),
      y -> named_struct('s', y.s, 'e', y.e, 'k', {k}, 'against', y.against, 'same', {_meets(f'base[{k}]', 'y')},
        'other', {other}, {features})) ELSE
      cast(array() as array<struct<s:int,e:int,k:int,against:boolean,same:boolean,other:boolean,{','.join(f'{f}:int' for f in FEATURES)}>>) END"""


def with_candidates(texts: DataFrame) -> DataFrame:
    """``texts`` (with a text ``_text``, null as empty) with ``_base`` (confirmed spans as s, k, e) and ``_loose`` (candidates)."""
    base = ", ".join(f"filter(_base, x -> x.k = {k})" for k in range(len(KINDS)))
    return (
        texts.withColumn("_text", F.coalesce("_text", F.lit("")))
        .withColumn("_base", F.expr(f"array_sort(concat({', '.join(map(_base, KINDS))}))"))
        .withColumn("_loose", F.expr(_let("base", f"array({base})", f"concat({', '.join(map(_loose, KINDS))})")))
    )


def _grow(rows: list[tuple[dict[str, int], float, float]], depth: int) -> Split | float:
    """A regression tree on (features, gradient, hessian) sums. No split lets a word that speaks for the kind speak against it."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (1e-6, None, 0)
    for f in FEATURES if depth else ():
        sums: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
        for x, gi, hi in rows:
            sums[x[f]][0] += gi
            sums[x[f]][1] += hi
        gl = hl = 0.0
        for value in sorted(sums)[:-1]:
            gl, hl = gl + sums[value][0], hl + sums[value][1]
            if f != "near" or gl / (hl + 1) <= (g - gl) / (h - hl + 1):
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                best = max(best, (gain, f, value), key=lambda b: b[0])
    if best[1] is None:
        return g / (h + 1)
    yes = [r for r in rows if r[0][best[1]] <= best[2]]
    no = [r for r in rows if r[0][best[1]] > best[2]]
    return Split(best[1], best[2], _grow(yes, depth - 1), _grow(no, depth - 1))


def boost(rows: list[tuple[dict[str, int], int, int]], rounds: int, depth: int, rate: float) -> tuple[float, tuple[Split, ...]]:
    """Logistic boosting on (features, positives, all) counts."""
    positive, n = sum(r[1] for r in rows), sum(r[2] for r in rows)
    bias = math.log((positive + 0.5) / (n - positive + 0.5))
    scores, trees = [bias] * len(rows), []

    def scaled(node: Split | float) -> Split | float:
        if isinstance(node, Split):
            return Split(node.feature, node.at, scaled(node.yes), scaled(node.no))
        return round(rate * node, 9)

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-s)) for s in scores]
        tree = scaled(_grow([(x, pos - k * q, k * q * (1 - q)) for (x, pos, k), q in zip(rows, p, strict=True)], depth))
        if not isinstance(tree, Split):
            break
        trees.append(tree)
        scores = [s + tree.value(x) for s, (x, _, _) in zip(scores, rows, strict=True)]
    return bias, tuple(trees)


def fit(found: DataFrame, rounds: int = 25, depth: int = 3, rate: float = 0.3, precision: float = 0.98,
        recall: float = 0.95) -> Boosted:
    """Trees and thresholds from all candidates in ``found`` (from ``with_candidates``).

    Candidates are counted per feature row, label and fold; the number of such rows is bounded by the features' values,
    not by the data. A fifth of the documents, by a hash of the text, only sets thresholds: the probability that ``recall``
    of that fold's confirmed candidates reach, or a higher one from which at least ``precision`` of the candidates that are
    known are confirmed. Known are confirmed ones, and those that something speaks against: a check digit, a number
    above 255, more digits around, a confirmed span of another kind. If a fold has no confirmed candidates of a kind, the other serves for
    both; kinds without any add nothing.
    """
    counts = (
        # outer: the filter that Spark infers from a plain one would compute the candidates twice
        found.select(F.expr("pmod(xxhash64(_text), 5) = 0").alias("fold"), F.explode_outer("_loose").alias("c"))
        .where("c IS NOT NULL")
        .select("fold", F.col("c.same").alias("label"), F.expr("c.against OR c.other").alias("against"), "c.k",
                *[f"c.{f}" for f in FEATURES])
        .groupBy("fold", "k", *FEATURES)
        .agg(F.count_if("label").alias("positive"), F.count_if(~F.col("label") & F.col("against")).alias("against"), F.count("*").alias("n"))
        .collect()
    )
    bias, trees, threshold = {}, {}, {}
    for k, kind in enumerate(KINDS):
        folds = [
            sorted(
                [({f: r[f] for f in FEATURES}, r["positive"], r["n"], r["against"])
                 for r in counts if r["k"] == k and r["fold"] == fold],
                key=lambda r: tuple(r[0].values()),
            )
            for fold in (False, True)
        ]
        usable = [part for part in folds if any(r[1] for r in part)]
        if not usable:
            continue
        learn, check = usable[0], usable[-1]
        bias[kind], trees[kind] = boost([r[:3] for r in learn], rounds, depth, rate)
        scored = sorted(
            ((1 / (1 + math.exp(-bias[kind] - sum(t.value(x) for t in trees[kind]))), pos, no) for x, pos, _, no in check),
            reverse=True,
        )
        enough, sure, wrong, threshold[kind] = recall * sum(r[1] for r in check), 0, 0, 2.0
        for i, (p, pos, no) in enumerate(scored):
            sure, wrong = sure + pos, wrong + no
            if i + 1 == len(scored) or scored[i + 1][0] < p:
                if sure >= precision * (sure + wrong):
                    threshold[kind] = p
                if sure >= enough:
                    break
    return Boosted(bias, trees, threshold)


def spans(found: DataFrame, model: Boosted) -> DataFrame:
    """``found`` with ``_spans``: the confirmed spans and the candidates that the model adds, by start, kind and end.

    Added spans overlap neither a confirmed span nor each other; of overlapping ones the likelier, then the longer
    one stays. Of candidates that something speaks against, only card numbers are added (a wrong digit).
    """
    kinds = []
    for kind in model.trees:
        k = KINDS.index(kind)
        kinds.append(
            f"""filter(transform(filter(_loose, c -> c.k = {k} AND NOT c.same AND NOT c.other
                {"" if kind == "card" else "AND NOT c.against"}),
              c -> named_struct('p', -({model.probability(kind)}), 'l', c.s - c.e, 's', c.s, 'k', c.k, 'e', c.e)),
              c -> c.p <= {-(model.threshold[kind] - 1e-12)!r}D)"""
        )
    if not kinds:
        return found.withColumn("_spans", F.col("_base"))
    # most overlap no other candidate; the others are taken in turn
    marked = ", ".join(
        f"""transform(likely[{i}], c -> named_struct('p', c.p, 'l', c.l, 's', c.s, 'k', c.k, 'e', c.e, 'clash',
          {' OR '.join(_meets(f'likely[{j}]', 'c') for j in range(len(kinds)) if j != i) or 'false'}))"""
        for i in range(len(kinds))
    )
    span = "named_struct('s', c.s, 'k', c.k, 'e', c.e)"
    taken = f"""aggregate(array_sort(filter(marked, c -> c.clash)), {_NONE}, (t, c) -> {_let('n', _below('t', 'c'),
      f"CASE WHEN n < size(t) AND t[n].s < c.e THEN t ELSE array_insert(t, n + 1, {span}) END")})"""
    added = _let("likely", f"array({', '.join(kinds)})", _let("marked", f"concat({marked})",
                 f"concat(transform(filter(marked, c -> NOT c.clash), c -> {span}), {taken})"))
    return found.withColumn("_spans", F.expr(f"array_sort(concat(_base, {added}))"))


def span_text(column: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({column}, x -> concat(array({kinds})[x.k], ':', x.s, ':', x.e)), ',')")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of confirmed spans of each kind, ``base`` and ``spans`` as text.

    Fits on all of ``docs``, then reads them again. Null texts are empty; texts without personal data have zeros and
    empty strings; repeated rows are reported each. Other columns of ``docs`` are not read. An empty table fits nothing. The
    time that a text takes grows as its length and number of spans; only candidates that overlap each other, of different
    kinds and none of them confirmed, are put in order one by one.
    """
    found = with_candidates(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("_text")))
    done = spans(found, fit(found))
    return done.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(_base, x -> x.k = {k})) as long)").alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        span_text("_base").alias("base"), span_text("_spans").alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span in ``text_col`` replaced by its kind in brackets; spans that overlap become one.

    All other columns stay under any name, null texts too. Fits on all of ``docs`` first.
    """
    found = with_candidates(docs.select(F.struct("*").alias("_row"), F.col(f"`{text_col}`").cast("string").alias("_text")))
    kinds = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    # per block of spans a part of the text, since places in a text are found by reading it from its start
    inside = f"""flatten(transform(b, x -> CASE WHEN x.s < x.at THEN cast(array() as array<string>) ELSE
      array(substr(part, x.at - b[0].at + 1, x.s - x.at), array({kinds})[x.k]) END))"""
    block = _let("part", "substr(_text, b[0].at + 1, b[size(b) - 1].s - b[0].at)", inside)
    pieces = _let("at", _running("transform(_spans, x -> x.e)", "greatest(a.at, x)"), _let(
        "z", "transform(_spans, (x, i) -> named_struct('at', at[i], 's', x.s, 'k', x.k))",
        f"""flatten(transform(sequence(0, (size(z) - 1) DIV {BLOCK}), j -> {_let('b', f'slice(z, int(j) * {BLOCK} + 1, {BLOCK})', block)}))"""))
    text = f"""CASE WHEN size(_spans) = 0 THEN _row.`{text_col}` ELSE
      concat(array_join({pieces}, ''), substr(_text, array_max(transform(_spans, x -> x.e)) + 1)) END"""
    done = spans(found, fit(found))
    return done.select(*[
        F.expr(text).alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns
    ])
