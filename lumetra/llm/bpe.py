"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a state machine.

The encoding of a prefix is unique, and a row of tokens is the encoding of its text exactly if each neighbouring pair
survives the merges. So one pass keeps, for each position, the last token of the encoding of the text up to there. The
next token starts at most ``lookahead`` symbols back (the longest token of the merge list): what all positions in
that window share can no longer change, and is emitted.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lumetra.llm.common import Memo, id_and_text, per_batch


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 stands for itself, the other bytes
    take the code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """The merge list of a tokenizer file as tables of whole numbers, with what the transducer needs of it.

    Tokens go by their ids. The states of a suffix-linked trie stand for the starts of tokens; each knows the tokens that
    end there, longest first, inside a word (``inner``) and at its end (``last``). ``plain`` gives the tables as built-in
    containers (their size is bounded by the file), ``of`` takes them back, so that they are built once and broadcast.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.width = max(self.ids.values()) + 1
        self.rank: dict[int, int] = {}
        self.made, self.first, self.second = ([-1] * self.width for _ in range(3))
        for r, rule in enumerate(model["merges"]):
            a, b = rule if isinstance(rule, list) else rule.split(" ")
            whole, a, b = self.ids[a + b], self.ids[a], self.ids[b]
            self.rank[a * self.width + b] = r
            self.made[whole], self.first[whole], self.second[whole] = r, a, b
        words = [(t, i) for t, i in self.ids.items() if t not in self.special and self.reachable(i)]
        self.lookahead = max(len(self.bare(t)) for t, _ in words)
        self._trie(words)
        self._start()

    def _start(self) -> None:
        self.pairs = Memo(lambda pair: self.holds(*divmod(pair, self.width)), 500_000)
        self.steps = Memo(self._next, 500_000)
        self.letters = byte_letters()

    def plain(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("pairs", "steps", "letters")}

    @classmethod
    def of(cls, plain: dict) -> Merges:
        self = cls.__new__(cls)
        vars(self).update(plain)
        self._start()
        return self

    def _trie(self, words: list[tuple[str, int]]) -> None:
        """``step`` leads from state and letter to the next state, ``shorter`` to the state of the longest ending."""
        step: dict[int, int] = {}
        at, parent, letter = [{}, {}], [0], [0]
        for t, i in words:
            state = 0
            for c in map(ord, self.bare(t)):
                key = state << 9 | c
                if key not in step:
                    step[key] = len(parent)
                    parent.append(state)
                    letter.append(c)
                state = step[key]
            ends = bool(self.end) and t.endswith(self.end)
            for kind in (0, 1) if not self.end else (int(ends),):
                at[kind][state] = (len(self.bare(t)), i)
        depth = [0] * len(parent)
        for state in range(1, len(parent)):  # a state comes after its parent
            depth[state] = depth[parent[state]] + 1
        shorter = [0] * len(parent)
        self.step, self.shorter = step, shorter
        found: list[list[tuple]] = [[()] * len(parent) for _ in range(2)]
        for state in sorted(range(1, len(parent)), key=depth.__getitem__):
            if depth[state] > 1:
                shorter[state] = self._next(shorter[parent[state]] << 9 | letter[state])
            for kind in range(2):
                own = (at[kind][state],) if state in at[kind] else ()
                found[kind][state] = own + found[kind][shorter[state]]
        self.inner, self.last = found

    def _next(self, key: int) -> int:
        """The state of the longest ending of state and letter that starts a token."""
        state, c = key >> 9, key & 511
        while state and state << 9 | c not in self.step:
            state = self.shorter[state]
        return self.step.get(state << 9 | c, 0)

    def bare(self, token: str) -> str:
        return token.removesuffix(self.end) if self.end else token

    def holds(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Does the border between two tokens outlive all merges of a rank below ``until``? Merges are undone from the
        last one back, which gives the parts that touch the border at the same time; a merge of two of them takes place
        while both are there. At equal rank the merge further left comes first."""
        made, rank, width = self.made, self.rank, self.width
        used_left = used_right = until
        while True:
            made_left, made_right = made[left], made[right]
            r = rank.get(left * width + right)
            if r is not None and r < until and made_left < r < used_left and made_right < r <= used_right:
                return False
            if made_left > made_right:
                used_left, left = made_left, self.second[left]
            elif made_right >= 0:
                used_right, right = made_right, self.first[right]
            else:
                return True

    def reachable(self, token: int) -> bool:
        """Does the token's own text encode to it?"""
        if self.made[token] < 0:
            return True
        left, right = self.first[token], self.second[token]
        return self.holds(left, right, self.made[token]) and self.reachable(left) and self.reachable(right)


class Encoder:
    """Takes the symbols of one word in turn; gives out the ids of tokens once they are stable.

    ``feed`` and ``finish`` yield ids. No more than about twice ``lookahead`` positions are kept, plus those
    on which the paths still differ.
    """

    def __init__(self, merges: Merges):
        self.m = merges
        self.clear()

    def clear(self) -> None:
        # states[i]: of the trie after text[:i]; before[i]: the last token of the encoding of text[:i], None if not asked
        # yet; starts[i]: where it starts
        self.text, self.states, self.before, self.starts = "", [0], [-1], [0]

    def _take(self, symbols: str) -> None:
        step, states, state = self.m.steps, self.states, self.states[-1]
        for c in map(ord, symbols):
            state = step[state << 9 | c]
            states.append(state)
        self.text += symbols
        self.before += [None] * len(symbols)
        self.starts += [0] * len(symbols)

    def _last(self, n: int, ending: list[tuple]) -> int:
        """The last token of the encoding of ``text[:n]``: the one whose border with the encoding before it holds. A token
        that would start before the window is none: all paths meet where the window starts."""
        before = self.before
        for size, token in ending[self.states[n]]:
            if size <= n:
                left = before[n - size]
                if left is None:
                    left = self._last(n - size, self.m.inner)
                if left < 0 or self.m.pairs[left * self.m.width + token]:
                    before[n], self.starts[n] = token, n - size
                    return token
        raise ValueError(f"no token for {self.text[:n]!r}")

    def _ends(self, at: int) -> list[int]:
        """Positions down from ``at`` to 0 where tokens end."""
        out = [at]
        while at > 0:
            if self.before[at] is None:
                self._last(at, self.m.inner)
            at = self.starts[at]
            out.append(at)
        return out

    def feed(self, symbols: str) -> Iterator[int]:
        size = self.m.lookahead
        for i in range(0, len(symbols), size):
            self._take(symbols[i : i + size])
            if len(self.text) > 2 * size:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        n = len(self.text)
        shared = set(self._ends(n))
        for at in range(n - self.m.lookahead, n):
            shared.intersection_update(self._ends(at))
        cut = max(shared)
        if cut > 0:
            yield from (self.before[i] for i in reversed(self._ends(cut)[:-1]))
            # the token before the cut stays, as the left neighbour of what follows
            self.text, self.states, self.before = self.text[cut:], self.states[cut:], self.before[cut:]
            self.starts = [max(0, i - cut) for i in self.starts[cut:]]

    def finish(self, symbols: str) -> list[int]:
        """Ends the word with its last symbols, one at least; the tokens that were still open."""
        self._take(symbols)
        at = len(self.text)
        self._last(at, self.m.last)
        out, before, starts = [], self.before, self.starts
        while at > 0:
            out.append(self._last(at, self.m.inner) if before[at] is None else before[at])
            at = starts[at]
        self.clear()
        return out[::-1]


class Decoder:
    """Turns ids into text step by step. For byte-level files it holds back the bytes of an unfinished character;
    files that name no decoder give their tokens with spaces between."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.token = {i: t for t, i in [*merges.ids.items(), *merges.special.items()]}
        self.byte = {c: b for b, c in enumerate(merges.letters)}
        self.clear()

    def clear(self) -> None:
        self.started, self.bytes = False, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        tokens = list(map(self.token.__getitem__, ids))
        if not self.m.byte_level:
            text = (" " if self.started and tokens else "") + " ".join(tokens)
            self.started = self.started or bool(tokens)
            return text
        out = []
        for t in tokens:
            raw = bytes(self.byte[c] for c in t) if t not in self.m.special else t.encode()
            out.append(self.bytes.decode(raw))
        return "".join(out)

    def finish(self) -> str:
        rest = self.bytes.decode(b"", final=True)
        self.clear()
        return rest


#: How the word tokenizer's file splits a normalised text.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


#: Where a long text may be cut: a word ends at any white space.
BREAK = regex.compile(r"[\x20\x09-\x0D]")
#: White space for ``str.split`` but not for the word pattern.
SEPARATORS = regex.compile(r"[\x1C-\x1F]")
PIECE = 1 << 18


class WordBpe:
    """Encodes and decodes texts for a word tokenizer file (lower case, white space dropped, word ends).

    Words are independent of each other, so the ids of a word, and of what stands between two white spaces, are kept for
    a while (``Memo``). Decoding takes the stream of ids.
    """

    def __init__(self, merges: Merges | str, memo: int = 200_000):
        self.m = Merges(merges) if isinstance(merges, str) else merges
        self.encoder, self.decoder = Encoder(self.m), Decoder(self.m)
        self.split = regex.compile(WORD_PATTERN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.m.special)) + ")")
        self.symbols = dict(enumerate(self.m.letters))
        self.word, self.chunk = Memo(self._word, memo), Memo(self._chunk, memo)

    def _word(self, word: str) -> bytes:
        symbols = word.encode().decode("latin-1").translate(self.symbols)
        ahead = self.m.lookahead  # nothing of a shorter word is stable before its end
        ids = list(self.encoder.feed(symbols[:-ahead])) if len(symbols) > ahead else []
        ids += self.encoder.finish(symbols[-ahead:])
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, text: str) -> bytes:
        if text.isascii() and text.isalpha():
            return self.word[text.lower()]
        return b"".join(map(self.word.__getitem__, self.split.findall(self.normal(text))))

    @staticmethod
    def normal(text: str) -> str:
        """Composed and in lower case, which goes by single characters: a final sigma has no form of its own. Nothing
        composes across white space."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def stream(self, text: str) -> Iterator[tuple[bytes, str]]:
        """The ids as little-endian unsigned 32-bit integers and the text they decode to, in turn for some quarter of a
        million characters each."""
        self.decoder.clear()
        at = 0
        while at < len(text):
            stop = BREAK.search(text, at + PIECE)
            end = stop.end() if stop else len(text)
            ids = self._ids(text[at:end])
            yield ids, self.decoder.feed(memoryview(ids).cast("I") if sys.byteorder == "little" else
                                         struct.unpack(f"<{len(ids) // 4}I", ids))
            at = end
        yield b"", self.decoder.finish()

    def _ids(self, text: str) -> bytes:
        out = []
        for part in self.specials.split(text) if "<|" in text else [text]:
            if part in self.m.special:
                out.append(struct.pack("<I", self.m.special[part]))
            elif SEPARATORS.search(part):
                out.append(self._chunk(part))
            else:
                out += map(self.chunk.__getitem__, part.split())
        return b"".join(out)

    def run(self, text: str) -> tuple[bytes, str]:
        """All ids and all decoded text of ``stream``."""
        ids, said = zip(*self.stream(text), strict=True)
        return b"".join(ids), "".join(said)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` of each text, one narrow pass.

    Null and empty texts have no ids and decode to the empty text; repeated rows are kept. ``path`` is the tokenizer
    file; the driver reads it and broadcasts its tables. Other columns of ``docs`` are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def whole(stream: Iterator[tuple[bytes, str]]) -> dict:
        ids, said = zip(*stream, strict=True)
        return {"ids": b"".join(ids), "decoded": "".join(said)}

    return _each_text(docs, path, schema, whole)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``round_trip``, with the number of tokens and SHA-256 digests in place of ids and text, which are never whole
    in memory."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())
    ])

    def digest(stream: Iterator[tuple[bytes, str]]) -> dict:
        n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        for ids, said in stream:
            n += len(ids) // 4
            of_ids.update(ids)
            of_text.update(said.encode())
        return {"n_tokens": n, "ids_sha256": of_ids.hexdigest(), "decoded_sha256": of_text.hexdigest()}

    return _each_text(docs, path, schema, digest)


def _each_text(docs: DataFrame, path: str, schema: pa.Schema, result) -> DataFrame:
    tables = docs.sparkSession.sparkContext.broadcast(Merges(path).plain())

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(Merges.of(tables.value))

        def of(batch: pa.RecordBatch) -> dict:
            rows = [result(bpe.stream(x or "")) for x in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id")} | {
                f.name: [r[f.name] for r in rows] for f in schema if f.name != "doc_id"
            }

        return per_batch(of, schema)(batches)

    from pyspark.sql.pandas.types import from_arrow_schema

    return id_and_text(docs).mapInArrow(start, from_arrow_schema(schema))
