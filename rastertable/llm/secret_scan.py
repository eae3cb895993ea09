"""Secrets by a trigram index: a regex becomes a Boolean query over trigrams, postings are
intersected, and only candidates meet the regex.

A task indexes the texts of a slice: for each trigram that any rule asks for, the slice's documents
that hold it, letters lowered. A rule that needs no trigram is tried on every text. The index lives
and dies with its slice, so nothing shuffles and no posting list outgrows a slice.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, flattened, nested, slices, text_or_empty, texts

ANY = True  # a query that every text satisfies
MOST_STRINGS = 64
MOST_CHARS = 8


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a regex, and the least length of one of its groups (0: the match)."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The base kinds, in their order.
BASE = (
    Rule("assign", f"({'|'.join(map(_either, ('password', 'passwd', 'secret', 'token')))}|{_either('api')}_?{_either('key')})"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]+", 24),
)
#: Kinds beyond the base, by the public formats of their issuers.
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", "[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("maps", "AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE


def _and(*queries):
    parts = {q for q in queries if q is not ANY}
    return ANY if not parts else parts.pop() if len(parts) == 1 else ("and", frozenset(parts))


def _or(queries):
    parts = set(queries)
    return ANY if ANY in parts or not parts else parts.pop() if len(parts) == 1 else ("or", frozenset(parts))


def _of_strings(strings) -> object:
    """Some string of these occurs."""
    if any(len(s.encode()) < 3 for s in strings):
        return ANY
    return _or(_and(*{s.encode()[i:i + 3] for i in range(len(s.encode()) - 2)}) for s in strings)


def _chars(items) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(_lower(chr(value)))
        elif kind is op.RANGE and value[1] - value[0] < 2 * MOST_CHARS:
            found |= {_lower(chr(c)) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_CHARS else None


def _lower(c: str) -> str:
    return c.lower() if c.isascii() else c


def _parts(nodes) -> tuple[set[str] | None, object]:
    """Of a sequence: all strings it can match if they are few, and the query of any match."""
    strings: set[str] | None = {""}
    whole, queries = True, []

    def close():
        nonlocal strings
        queries.append(_of_strings(strings))
        strings = {""}

    for kind, value in nodes:
        own, query = _node(kind, value)
        if own is None:
            close()
            queries.append(query)
            whole = False
        elif len(strings) * len(own) > MOST_STRINGS:
            close()
            strings, whole = own, False
        else:
            strings = {a + b for a in strings for b in own}
    if whole:
        return strings, _of_strings(strings)
    close()
    return None, _and(*queries)


def _node(kind, value) -> tuple[set[str] | None, object]:
    if kind is op.LITERAL:
        return {_lower(chr(value))}, ANY
    if kind is op.IN:
        return _chars(value), ANY
    if kind is op.SUBPATTERN:
        return _parts(value[-1])
    if kind is op.BRANCH:
        sides = [_parts(x) for x in value[1]]
        if all(s is not None for s, _ in sides) and sum(len(s) for s, _ in sides) <= MOST_STRINGS:
            return set().union(*(s for s, _ in sides)), ANY
        return None, _or(q for _, q in sides)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        own, query = _parts(inner)
        if own is not None and (least, most) == (0, 1):
            return own | {""}, ANY
        return None, query if least else ANY
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}, ANY
    return None, ANY


def trigram_query(pattern: str):
    """What any match of ``pattern`` needs: ANY, a trigram of bytes, or ('and' | 'or', queries)."""
    return _parts(_parser.parse(pattern))[1]


def _needed(query) -> set[bytes]:
    if query is ANY:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_needed, query[1]))


class Index:
    """Postings of one slice: for each needed trigram, the sorted numbers of the texts with it."""

    def __init__(self, text: pa.Array, needed: list[bytes]):
        self.everything = np.arange(len(text))
        data, at = flat_bytes(text)
        upper = (data >= 65) & (data <= 90)
        low = (data + 32 * upper).astype(np.uint32)
        code = low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]
        table = np.zeros(1 << 24, np.uint16)
        for i, t in enumerate(needed):
            table[int.from_bytes(t, "big")] = i + 1
        which = table[code]
        hits = np.flatnonzero(which)
        owner = np.searchsorted(at, hits, "right") - 1
        inside = hits + 3 <= at[owner + 1]  # a trigram of one text, not of two neighbours
        pairs = np.unique(which[hits[inside]].astype(np.int64) * max(1, len(text)) + owner[inside])
        kind, doc = np.divmod(pairs, max(1, len(text)))
        edges = np.searchsorted(kind, np.arange(1, len(needed) + 2))
        self.postings = {t: doc[edges[i]:edges[i + 1]] for i, t in enumerate(needed)}

    def find(self, query) -> np.ndarray:
        if query is ANY:
            return self.everything
        if isinstance(query, bytes):
            return self.postings[query]
        sides = sorted((self.find(q) for q in query[1]), key=len)
        found = sides[0]
        for other in sides[1:]:
            found = np.intersect1d(found, other, True) if query[0] == "and" else np.union1d(found, other)
        return found


def _verified(rule: Rule, regex: re.Pattern, text: str):
    for m in regex.finditer(text):
        if m.end(rule.group) - m.start(rule.group) >= rule.least:
            yield m.start(), m.end()


def _runs(rule: Rule) -> str:
    """A class repeated at will, with a least length: the longest runs are the matches, so shorter
    ones need not be found at all."""
    parsed = _parser.parse(rule.pattern)
    lone = len(parsed) == 1 and parsed[0][0] is op.MAX_REPEAT and parsed[0][1][0] == 1
    if lone and rule.least and len(parsed[0][1][2]) == 1 and rule.pattern.endswith("+"):
        return f"{rule.pattern[:-1]}{{{rule.least},}}"
    return rule.pattern


def scan(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every input row with ``secrets``: an array of (kind, start, end), code points, end exclusive.

    Matches are leftmost and non-overlapping per kind, ordered by start, then kind as listed. Null and
    empty texts have none.
    """
    kinds = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                      T.StructField("end", T.LongType())]))

    def run(batches):
        queries = [trigram_query(r.pattern) for r in rules]
        needed = sorted(set().union(*map(_needed, queries)))
        regexes = [re.compile(_runs(r)) for r in rules]
        for batch in batches:
            for part in slices(batch, "text"):
                text = texts(part)
                index = Index(text, needed)
                found: list[list[tuple]] = [[] for _ in range(len(text))]
                strings: dict[int, str] = {}
                for k, (rule, regex, query) in enumerate(zip(rules, regexes, queries)):
                    for i in index.find(query):
                        if i not in strings:
                            strings[i] = text[i].as_py()
                        found[i] += [(a, k, b) for a, b in _verified(rule, regex, strings[i])]
                spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(x)] for x in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(spans, pa.list_(pa.struct(
                        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], ["row", "secrets"])

    rows = nested(docs, text=text_or_empty(f"`{text_col}`"))
    return flattened(rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("secrets", kinds)])), "secrets")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    base = [r.kind for r in BASE]

    def written(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    mine = F.filter("secrets", lambda s: s["kind"].isin(base))
    counts = [F.size(F.filter("secrets", _is(k))).cast("bigint").alias(f"n_{k}") for k in base]
    return scanned.select(F.col(f"`{id_col}`"), *counts, F.sha2(written(mine), 256).alias("base_sha256"),
                          written(F.col("secrets")).alias("spans"))
