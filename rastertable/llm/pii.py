"""Personal data by a semi-Markov conditional random field, beside fixed base patterns.

The field sees regions: runs of neighbouring words of which each holds a digit or an ``@``. It scores
whole candidate segments of up to ``MOST_WORDS`` words by features of the segment as a whole (its
shape, digits, check sum, the word before it), so a phone number in three pieces is one decision. A
dynamic program over bounded segments picks boundaries and types together. Weights maximize the
likelihood of segmentations that the base patterns give for a bounded sample of regions.

Base spans are always reported. Segments add to them where they overlap none and are near certain.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, flattened, nested, slices, text_or_empty, texts

KINDS = ("email", "ip", "card", "phone")  # the order of base kinds
TYPES = ("other", *KINDS)
MOST_WORDS = 5
#: Regions the field is fitted on, picked by a hash, and the longest one among them.
FIT_REGIONS, FIT_WORDS = 1500, 40
EPOCHS, RATE, PENALTY = 4, 0.3, 1e-4
CERTAIN = 0.9

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Matches can only begin at a run's first digit, and runs never give back: the same matches as the
# plain patterns', in linear time on any text.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(WORD)
_EDGE = ".,;:!?()[]{}<>\"'|%&*#$"


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns, kind by kind."""
    found, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            found.append((start, domain.end(), 0))
            last = domain.end()
        at = text.find("@", at + 1)
    found += [(*m.span(), 1) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), 2))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append((*m.span(), 3))
    return found


@dataclass
class Region:
    """Neighbouring words with their places, and the word before them."""
    words: list[str]
    spans: list[tuple[int, int]]
    before: str


def regions(text: str):
    """Longest runs of words that hold a digit or an @."""
    held, before = Region([], [], ""), ""
    for m in _WORD.finditer(text):
        word = m[0]
        if "@" in word or any(c in word for c in "0123456789"):
            if not held.words:
                held.before = before
            held.words.append(word)
            held.spans.append(m.span())
        elif held.words:
            yield held
            held = Region([], [], "")
        before = word
    if held.words:
        yield held


def _trimmed(region: Region, i: int, j: int) -> tuple[int, int]:
    """Start and end of words i to j - 1 without marks around them."""
    first, last = region.words[i], region.words[j - 1]
    start = region.spans[i][0] + len(first) - len(first.lstrip(_EDGE))
    end = region.spans[j - 1][1] - (len(last) - len(last.rstrip(_EDGE)))
    return start, end


def _shape_of(word: str) -> str:
    word = re.sub("[0-9]{5,}", "N", word[:64])
    word = re.sub("[A-Za-z\u0080-\U0010ffff]+", "a", word)
    return re.sub("[0-9]", "9", word)


def features(region: Region, i: int, j: int) -> list[str]:
    """Names of what is true of words i to j - 1 as a whole."""
    words = [w.strip(_EDGE) if k in (0, j - i - 1) else w for k, w in enumerate(region.words[i:j])]
    whole = " ".join(words)
    digits = re.sub("[^0-9]", "", whole)
    n = len(digits)
    before = (region.words[i - 1] if i else region.before).lower().strip(_EDGE)[:12]
    found = ["bias", f"words={j - i}", f"digits={n if n < 20 else 20}", f"before={before}",
             "shape=" + " ".join(map(_shape_of, words))[:40], f"at={whole.count('@')}",
             f"dots={min(whole.count('.'), 4)}", f"first={_shape_of(whole[:1])}", f"last={_shape_of(whole[-1:])}",
             f"letters={any(c.isalpha() for c in whole)}", f"size={len(whole).bit_length()}"]
    if 13 <= n <= 19:
        found.append(f"luhn={luhn(digits)}")
    parts = whole.split(".")
    if len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts):
        found.append(f"octets={all(map(_octet, parts))}")
    if "@" in whole:
        found.append(f"domain={bool(_DOMAIN.fullmatch(whole.split('@')[-1]))}")
    if re.fullmatch(r"[0-9 ().+-]+", whole):
        found.append("dialled")
    return found


@dataclass(frozen=True)
class Field:
    """Feature numbers and their weights, one column per type."""
    numbers: dict[str, int]
    weights: np.ndarray

    def scores(self, region: Region) -> np.ndarray:
        """[end, length - 1, type]: the score of the segment of that length before ``end``."""
        n = len(region.words)
        out = np.full((n + 1, MOST_WORDS, len(TYPES)), -np.inf)
        for end in range(1, n + 1):
            for size in range(1, min(MOST_WORDS, end) + 1):
                known = [self.numbers[f] for f in features(region, end - size, end) if f in self.numbers]
                out[end, size - 1] = self.weights[known].sum(0)
        out[:, 1:, 0] = -np.inf  # other: one word at a time
        return out

    def segments(self, region: Region) -> list[tuple[int, int, int, float]]:
        """The best segmentation: (first, end, type, probability) of its typed segments."""
        s = self.scores(region)
        n = len(region.words)
        best, back = np.full(n + 1, -np.inf), [(0, 0)] * (n + 1)
        best[0] = 0
        for end in range(1, n + 1):
            for size in range(1, min(MOST_WORDS, end) + 1):
                k = int(np.argmax(s[end, size - 1]))
                if best[end - size] + s[end, size - 1, k] > best[end]:
                    best[end], back[end] = best[end - size] + s[end, size - 1, k], (size, k)
        ahead, behind = _sums(s)
        found, end = [], n
        while end:
            size, k = back[end]
            if k:
                sure = np.exp(ahead[end - size] + s[end, size - 1, k] + behind[end] - ahead[n])
                found.append((end - size, end, k, float(sure)))
            end -= size
        return found[::-1]


def _log_sum(x: np.ndarray) -> float:
    top = x.max()
    return top if not np.isfinite(top) else top + np.log(np.exp(x - top).sum())


def _sums(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the summed scores of all segmentations up to, and from, each place."""
    n = len(s) - 1
    ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    ahead[0] = behind[n] = 0
    for end in range(1, n + 1):
        ahead[end] = _log_sum(np.concatenate([ahead[end - z] + s[end, z - 1] for z in range(1, min(MOST_WORDS, end) + 1)]))
    for at in range(n - 1, -1, -1):
        behind[at] = _log_sum(np.concatenate([behind[at + z] + s[at + z, z - 1]
                                              for z in range(1, min(MOST_WORDS, n - at) + 1)]))
    return ahead, behind


def _gold(region: Region, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]] | None:
    """The base spans inside a region as segments; of overlapping ones the first. None where words of a
    base span belong to no segment, because it has too many or goes on beyond the region: taken for
    ``other``, they would teach the field the opposite."""
    found, used, met = [], set(), set()
    for start, end, kind in base:
        touched = [k for k, (a, b) in enumerate(region.spans) if b > start and a < end]
        met |= set(touched)
        if touched and region.spans[0][0] <= start and end <= region.spans[-1][1]:
            i, j = touched[0], touched[-1] + 1
            if j - i <= MOST_WORDS and not used & set(range(i, j)):
                found.append((i, j, kind + 1))
                used |= set(range(i, j))
    return found if met <= used else None


def fit_field(examples: list[tuple[Region, list[tuple[int, int, int]]]], seed: int = 0) -> Field:
    """Weights by stochastic gradient ascent on the likelihood of the given segmentations."""
    numbers: dict[str, int] = {}
    cached = []
    for region, gold in examples:
        n, own = len(region.words), {}
        for end in range(1, n + 1):
            for size in range(1, min(MOST_WORDS, end) + 1):
                own[end, size] = np.array([numbers.setdefault(f, len(numbers)) for f in features(region, end - size, end)])
        covered = {k for i, j, _ in gold for k in range(i, j)}
        path = [(j, j - i, t) for i, j, t in gold] + [(k + 1, 1, 0) for k in range(n) if k not in covered]
        cached.append((n, own, path))
    w, g2 = np.zeros((len(numbers), len(TYPES))), np.full((len(numbers), len(TYPES)), 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for e in rng.permutation(len(cached)):
            n, own, path = cached[e]
            s = np.full((n + 1, MOST_WORDS, len(TYPES)), -np.inf)
            for (end, size), f in own.items():
                s[end, size - 1] = w[f].sum(0)
            s[:, 1:, 0] = -np.inf
            ahead, behind = _sums(s)
            touched: dict[int, np.ndarray] = {}
            for (end, size), f in own.items():
                expected = np.exp(ahead[end - size] + s[end, size - 1] + behind[end] - ahead[n])
                for k in f:
                    touched[k] = touched.get(k, 0) - expected
            for end, size, t in path:
                for k in own[end, size]:
                    touched[k] = touched[k] + np.eye(len(TYPES))[t]
            k = np.fromiter(touched, int, len(touched))
            step = np.array(list(touched.values())) - PENALTY * w[k]
            g2[k] += step ** 2
            w[k] += RATE * step / np.sqrt(g2[k])
    return Field(numbers, w)


def _promising(text: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring_regex(text, "[0-9@]").to_numpy(zero_copy_only=False))


def fit(docs: DataFrame, text_col: str = "text", fit_regions: int = FIT_REGIONS) -> Field:
    """A field fitted on at most ``fit_regions`` distinct regions of all documents, the first by a hash.
    The hash knows nothing of base spans, so their share among the regions is the same at every size."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                text = texts(part)
                rows = []
                for i in _promising(text):
                    whole = text[i].as_py()
                    base = base_spans(whole)
                    for region in regions(whole):
                        if len(region.words) <= FIT_WORDS:
                            gold = _gold(region, base)
                            if gold is not None:
                                rows.append((region.words, region.before, [x for g in gold for x in g]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.list_(pa.string())), pa.array([r[1] for r in rows], pa.string()),
                     pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["words", "before", "gold"])

    found = (docs.select(text_or_empty(f"`{text_col}`").alias("text"))
             .mapInArrow(run, "words array<string>, before string, gold array<int>"))
    held = ["words", "before", "gold"]
    picked = found.distinct().orderBy(F.xxhash64(*held), *held).limit(fit_regions)
    examples = []
    for r in picked.collect():  # bounded by fit_regions and FIT_WORDS
        ends = np.cumsum([len(x) + 1 for x in r.words])
        spans = [(int(e) - len(x) - 1, int(e) - 1) for e, x in zip(ends, r.words)]
        examples.append((Region(r.words, spans, r.before), [tuple(r.gold[k:k + 3]) for k in range(0, len(r.gold), 3)]))
    return fit_field(examples)


def find(text: str, field: Field) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of a text: base spans, and near certain segments that overlap none."""
    base = base_spans(text)
    found = [(k, a, b, True) for a, b, k in base]
    taken = sorted((a, b) for a, b, _ in base)
    for region in regions(text):
        low, high = region.spans[0][0], region.spans[-1][1]
        near = [(a, b) for a, b in taken if a < high and b > low]
        for i, j, kind, sure in field.segments(region):
            a, b = _trimmed(region, i, j)
            if sure >= CERTAIN and a < b and not any(x < b and y > a for x, y in near):
                found.append((kind - 1, a, b, False))
    return sorted(found)


def personal_data(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """Every input row with ``spans``: an array of (kind, start, end, base), code points, end exclusive,
    by kind as listed, then start. Null and empty texts have none."""
    kind = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                text = texts(part)
                spans: list[list[dict]] = [[] for _ in range(len(text))]
                for i in _promising(text):
                    spans[i] = [{"kind": KINDS[k], "start": a, "end": b, "base": own}
                                for k, a, b, own in find(text[i].as_py(), field)]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(spans, arrow)], ["row", "spans"])

    rows = nested(docs, text=text_or_empty(f"`{text_col}`"))
    schema = T.StructType([rows.schema["row"], T.StructField("spans", T.ArrayType(kind))])
    return flattened(rows.mapInArrow(run, schema), "spans")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    def written(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _is(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select(F.col(f"`{id_col}`"), *counts, F.sha2(written(base), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))
