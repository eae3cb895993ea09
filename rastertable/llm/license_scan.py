"""License texts by template markup: templates become token automata that read a text's words.

A template holds mandatory words, optional regions and replaceable regions (a number of words of any
kind). Its automaton accepts a run of words when the mandatory wording matches exactly and in order.
Automata start only where a text has a pair of words that can begin one of them; a task finds those
places for a whole slice of texts at once, so most words are never looked at one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, flattened, nested, slices, text_or_empty, texts
from .license_templates import PHRASES, TEMPLATES

MARK = re.compile(r"<<(/?optional|words (\d+) (\d+))>>")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: A replaceable region takes this many words at most, so that an automaton's life has a bound.
MOST_WORDS = 64
_WORD_BYTE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def tokens(text: str) -> list[str]:
    """Words of a text: letters A-Z lowered, runs of ASCII letters, digits and anything beyond ASCII."""
    return TOKEN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


@dataclass
class Automaton:
    """Nondeterministic, over words. ``word[s]`` maps a word to states, ``any[s]`` holds the states
    that any word leads to; moves without a word are already closed. ``ends`` are accepting."""
    word: list[dict[str, set[int]]] = field(default_factory=list)
    any: list[set[int]] = field(default_factory=list)
    starts: frozenset[int] = frozenset()
    ends: frozenset[int] = frozenset()

    def first(self) -> set[str]:
        return {w for s in self.starts for w in self.word[s]}

    def step(self, states: Iterable[int], word: str) -> set[int]:
        out: set[int] = set()
        for s in states:
            out.update(self.any[s], self.word[s].get(word, ()))
        return out

    def longest(self, words: Iterable[str]) -> int | None:
        """Length of the longest accepted run at the beginning of ``words``."""
        states, length = set(self.starts), None
        for i, word in enumerate(words, 1):
            states = self.step(states, word)
            if not states:
                break
            if not self.ends.isdisjoint(states):
                length = i
        return length


def compile_template(template: str) -> Automaton:
    """The automaton of a template. Raises ValueError where regions do not close, a replaceable region
    is too wide or the empty text would match, and where no mandatory or optional word comes first."""
    moves: list[tuple[int, str | None, int]] = []  # None: without a word; "": any word
    at, count, open_regions = 0, 1, []

    def move(word: str | None) -> int:
        nonlocal count
        moves.append((at, word, count))
        count += 1
        return count - 1

    place = 0
    for mark in [*MARK.finditer(template), None]:
        for word in tokens(template[place:mark.start() if mark else len(template)]):
            at = move(word)
        if mark is None:
            break
        place = mark.end()
        if mark[1] == "optional":
            open_regions.append(at)
        elif mark[1] == "/optional":
            if not open_regions:
                raise ValueError("a region ends that did not begin")
            begin = open_regions.pop()
            at = move(None)
            moves.append((begin, None, at))
        else:
            least, most = int(mark[2]), int(mark[3])
            if not least <= most <= MOST_WORDS:
                raise ValueError(f"a replaceable region takes at most {MOST_WORDS} words: {mark[0]}")
            stops = []
            for k in range(most):
                if k >= least:
                    stops.append(at)
                at = move("")
            end = move(None)
            moves.extend((s, None, end) for s in stops)
            at = end
    if open_regions:
        raise ValueError("a region does not end")
    free: list[set[int]] = [set() for _ in range(count)]
    for a, word, b in moves:
        if word is None:
            free[a].add(b)

    def closed(state: int) -> set[int]:
        seen, todo = {state}, [state]
        while todo:
            new = free[todo.pop()] - seen
            seen |= new
            todo += new
        return seen

    out = Automaton([{} for _ in range(count)], [set() for _ in range(count)], frozenset(closed(0)), frozenset({at}))
    for a, word, b in moves:
        if word:
            out.word[a].setdefault(word, set()).update(closed(b))
        elif word == "":
            out.any[a] |= closed(b)
    if out.starts & out.ends:
        raise ValueError("the template matches the empty text")
    if any(out.any[s] for s in out.starts):
        raise ValueError("a template begins with a word, not with a replaceable region")
    return out


@dataclass(frozen=True)
class Template:
    """A named template. ``base`` marks the plain phrases whose places are counted as such."""
    label: str
    text: str
    base: bool = False


#: The base phrases, then the templates with markup.
ALL = (*(Template(label, phrase, True) for label, phrase in PHRASES),
       *(Template(label, text) for label, several in TEMPLATES.items() for text in several))


class Matcher:
    """All automata over one vocabulary, and which pairs of words can begin which of them."""

    def __init__(self, templates: tuple[Template, ...]):
        self.automata = [compile_template(t.text) for t in templates]
        vocabulary = sorted({w for a in self.automata for moves in a.word for w in moves})
        self.words = pa.array(vocabulary, pa.large_string())
        self.spelled = ["", *vocabulary]  # 0: a word of no template
        number = {w: i + 1 for i, w in enumerate(vocabulary)}
        size = len(self.spelled)
        self.begins = np.zeros((size, size + 1), bool)  # by first and second word; the last column: no second
        self.by_first: dict[int, list[int]] = {}
        for k, automaton in enumerate(self.automata):
            for first in automaton.first():
                row, after = number[first], automaton.step(automaton.starts, first)
                self.by_first.setdefault(row, []).append(k)
                if not automaton.ends.isdisjoint(after) or any(automaton.any[s] for s in after):
                    self.begins[row] = True
                for s in after:
                    self.begins[row, [number[w] for w in automaton.word[s]]] = True

    def numbers(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts in a row as numbers, and where each text's words begin."""
        data, at = flat_bytes(text)
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        inside = _WORD_BYTE[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = at[:-1][at[:-1] < len(data)]
        begins[edges] = inside[edges]  # a text's first byte goes on with no word of the text before
        places = np.flatnonzero(begins)
        kept = np.concatenate([[0], np.cumsum(inside)])
        offsets = np.append(kept[places], kept[-1])
        spelled = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
        found = pc.fill_null(pc.index_in(spelled, self.words), -1).to_numpy(zero_copy_only=False) + 1
        return found, np.searchsorted(places, at)

    def find(self, text: pa.Array) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
        """Words per text, and (text, start, end, template) of every accepted run, longest per start."""
        found, at = self.numbers(text)
        follow = np.append(found[1:], len(self.spelled))
        follow[at[1:][at[1:] > 0] - 1] = len(self.spelled)
        out = []
        for place in np.flatnonzero(self.begins[found, follow]):
            doc = int(np.searchsorted(at, place, "right")) - 1
            start = int(place - at[doc])
            for k in self.by_first[int(found[place])]:
                length = self.automata[k].longest(self.spelled[w] for w in found[place:at[doc + 1]])
                if length is not None:
                    out.append((doc, start, start + length, k))
        return np.diff(at), out


SPANS = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = ALL) -> DataFrame:
    """Every input row with ``n_words`` and ``licenses``: an array of (label, base, start, end).

    Positions are words, from 0, end exclusive. Each place where a template is accepted counts, the
    longest run per template and place; overlapping runs all stand, equal ones (same label, both base or
    both not) once; ordered by start, end, label. Null and empty texts have no words and no licenses;
    equal rows get equal results; columns named like a result give way to it. Texts are read whole; a
    slice takes about 30 bytes of a task's memory per byte of text, so a long text's size is its bound.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates)
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, runs = matcher.find(texts(part))
                spans: list[set] = [set() for _ in sizes]
                for doc, start, end, k in runs:
                    spans[doc].add((start, end, templates[k].label, templates[k].base))
                rows = [[{"label": x, "base": b, "start": s, "end": e} for s, e, x, b in sorted(found)] for found in spans]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(sizes, pa.int64()), pa.array(rows, _ARROW)],
                                                 ["row", "n_words", "licenses"])

    rows = nested(docs, text=text_or_empty(f"`{text_col}`"))
    found = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()),
                                               T.StructField("licenses", SPANS)]))
    return flattened(found, "n_words", "licenses")


def covered(spans: Column, n_words: Column) -> Column:
    """Share of a text's words inside any span (ordered by start); 0 without words."""
    start = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).cast("bigint").alias("upto"))
    total = F.aggregate(spans, start, lambda acc, s: F.struct(
        (acc["words"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(s["start"], acc["upto"]))).alias("words"),
        F.greatest(acc["upto"], s["end"]).alias("upto")), lambda acc: acc["words"])
    return F.coalesce(F.try_divide(total.cast("double"), n_words), F.lit(0.0))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number and first and last place of the base phrases, their labels, all labels, and ``score``:
    the share of a text's words that phrases and templates cover."""
    base = F.filter("licenses", lambda s: s["base"])

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"])
    return scanned.select(
        F.col(f"`{id_col}`"), "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("licenses")).alias("labels"),
        covered(F.col("licenses"), F.col("n_words")).alias("score"))
