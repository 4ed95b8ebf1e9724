"""Plain versions of the text operators, for small inputs."""

from __future__ import annotations

import collections
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

#: Null and empty texts, few words, copies, copies but for case, one word changed, a passage in common, repeated rows.
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One  two"), (6, BASE), (7, BASE.upper()), (8, BASE.replace("w30", "x")),
    (9, "a b " + " ".join(f"w{i}" for i in range(20, 50)) + " c d"), (9, "a b " + " ".join(f"w{i}" for i in range(20, 50)) + " c d"),
    (10, "z " * 40), (11, "z " * 50), (12, "ü😀 é\x1cß " * 10), (13, " ".join(f"w{i % 7}" for i in range(90))),
    (14, "w3 " + " ".join(f"w{i % 7}" for i in range(80))), (15, "x" * 5000),
]


def frame(spark, rows=TEXTS):
    """The texts with further columns that carry names of results."""
    return spark.createDataFrame(
        [(i, t, "en", "s", None, 1, "x", None) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars int, n_words int, kept string, score double",
    )


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def components(rows, size, percent):
    sets = collections.defaultdict(list)
    for i, t in rows:
        sets[i].append(shingles(t, size))
    least = {i: i for i in sets}
    changed = True
    linked = [
        (a, b) for a in sets for b in sets if a < b
        and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
    ]
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


def removed(rows, k):
    """Kept words by row."""
    first: dict = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(t or "")
        for at in range(len(words) - k + 1):
            first.setdefault(tuple(words[at : at + k]), i)
    out = []
    for i, t in rows:
        words = WORD.findall(t or "")
        gone = set()
        for at in range(len(words) - k + 1):
            if first[tuple(words[at : at + k])] < i:
                gone.update(range(at, at + k))
        out.append((i, words, [w for at, w in enumerate(words) if at not in gone]))
    return out


def interpolated(rows, folds):
    """Scores by deleted interpolation, token by token: ``folds`` has test, learn or weigh for each row. The weights are
    learnt on estimates rounded to quarter octaves, as the model states."""
    tokens = [[*WORD.findall((t or "").translate(LOWER)), 0] for _, t in rows]

    def model(of):
        words, pairs, documents = collections.Counter(), collections.Counter(), 0
        for ws, fold in zip(tokens, folds, strict=True):
            if fold in of:
                documents += 1
                words.update(ws)
                pairs.update(zip([None, *ws], ws))
        return words, pairs, documents, sum(words.values())

    everything, rest = model(("learn", "weigh")), model(("learn",))
    unseen = 1 / (len(everything[0]) + 1)

    def estimates(ws, found):
        words, pairs, documents, n = found
        for before, w in zip([None, *ws], ws):
            context = documents if before is None else words[before]
            yield min(context.bit_length(), 39), (pairs[before, w] / context if context else 0.0, words[w] / max(n, 1), unseen)

    def level(p):
        return p and 2.0 ** (min(round(4 * math.log2(p)), 0) / 4)

    cells = [(b, (level(p[0]), level(p[1]), p[2])) for ws, f in zip(tokens, folds) if f == "weigh" for b, p in estimates(ws, rest)]

    def learnt(start, of):
        weights, mine = start, [p for b, p in cells if of(b)]
        for _ in range(60 if mine else 0):
            sums = [1e-6] * 3
            for p in mine:
                parts = [w * x for w, x in zip(weights, p)]
                sums = [s + x / sum(parts) for s, x in zip(sums, parts)]
            weights = [s / sum(sums) for s in sums]
        return weights

    pooled = learnt([0.4, 0.5, 0.1], lambda _: True)
    weights = {b: learnt(pooled, lambda c: c == b) for b in range(40)}  # noqa: B023
    return [sum(math.log10(sum(w * x for w, x in zip(weights[b], p))) for b, p in estimates(ws, everything)) for ws in tokens]
