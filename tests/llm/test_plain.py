"""What SQL cannot express, against plain versions: learned scores, and the field over segments."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rastertable.llm import pii, quality

# --- quality -----------------------------------------------------------------------------------


def plain_statistics(text: str) -> dict[str, float]:
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    n, size = max(1, len(text)), [len(w) for w in words] or [0]
    share = lambda test: sum(map(test, text)) / n
    return {
        "log_words": np.log1p(len(words)), "word_length": np.log1p(np.mean(size)), "word_length_spread": np.log1p(np.std(size)),
        "distinct_words": len(set(words)) / max(1, len(words)),
        "adjacent_repeats": sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)),
        "commonest_word": max(Counter(words).values(), default=0) / max(1, len(words)),
        "repeated_lines": 1 - len(set(lines)) / len(lines), "log_words_per_line": np.log1p(len(words) / len(lines)),
        "upper": share(lambda c: "A" <= c <= "Z"), "digits": share(lambda c: "0" <= c <= "9"),
        "sentence_marks": share(lambda c: c in ".,;:?'\"()-"), "exclamation": share(lambda c: c == "!"),
        "symbols": share(lambda c: c in "#$%&*+/<=>@[\\]^_`{|}~"),
        "controls": share(lambda c: c < " " and c not in "\t\n\v\f\r" or c == "\x7f"),
        "not_ascii": share(lambda c: c > "\x7f"), "white_space": share(lambda c: c in " \t\n\v\f\r")}


def plain_steps(s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of binned scores by its min-max formula; equal shares are one pool."""
    bins = np.floor((s + 0.5) / 2 * quality.BINS)
    own = [(s[bins == b].sum(), y[bins == b].sum(), (bins == b).sum()) for b in np.unique(bins)]
    total = np.concatenate([[[0, 0, 0]], np.cumsum(own, axis=0)])
    mean = lambda a, b: (total[b, 1] - total[a, 1]) / (total[b, 2] - total[a, 2])
    n = len(own)
    fitted = [max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
    pools = [[i for i, _ in g] for _, g in itertools.groupby(enumerate(fitted), lambda p: round(p[1], 12))]
    middle = [(total[p[-1] + 1, 0] - total[p[0], 0]) / (total[p[-1] + 1, 2] - total[p[0], 2]) for p in pools]
    return np.array(middle), np.array([fitted[p[0]] for p in pools])


@pytest.fixture(scope="module")
def marked():
    """Labels that the statistics explain only in part."""
    rng = random.Random(11)
    words = ["".join(rng.choices("aeioulmnrstÄé", k=rng.randint(1, 9))) for _ in range(200)]
    rows = []
    for i in range(300):
        text = " ".join(rng.choices(words, k=rng.randint(0, 50)))
        good = rng.random() < 0.5
        if rng.random() < 0.7:
            text = text.capitalize() + ". " if good else text.upper() + rng.choice(["!!", " 99%", "\n" + text])
        rows.append((i, text, int(good)))
    return [*rows, (300, "", 0), (301, " \n\x01\n ", 1), (302, "Ä", 0)]


def test_statistics(marked):
    got = quality.statistics(pa.array([text for _, text, _ in marked], pa.large_string()))
    want = [[plain_statistics(text)[name] for name in quality.NAMES] for _, text, _ in marked]
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_scores_are_those_of_plain_ridge_and_pools(spark, marked):
    """All rows at once: least squares with the penalty as further rows, the halves scored by each other."""
    df = spark.createDataFrame(marked, "doc_id bigint, text string, quality int").repartition(5)
    model = quality.fit(quality.features(df), df, n_features=48, seed=3)
    x = np.array([[plain_statistics(text)[name] for name in quality.NAMES] for _, text, _ in marked])
    y = np.array([label for *_, label in marked], float)
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i, *_ in marked])
    learn = fold > 0
    spread = x[learn].std(axis=0)
    z = np.clip((x - x[learn].mean(axis=0)) / np.where(spread > 1e-9, spread, 1), -8, 8)
    z = np.hstack([np.cos(z @ model.directions + model.phases) * np.sqrt(2 / 48), np.ones((len(z), 1))])

    def ridge(rows):
        penalty = np.sqrt(quality.RIDGE * rows.sum() / 48) * np.eye(49)
        return np.linalg.lstsq(np.vstack([z[rows], penalty]), np.concatenate([y[rows], np.zeros(49)]), rcond=None)[0]

    first, second = learn & (fold <= 2), fold > 2
    raw = np.clip(np.where(second, z @ ridge(first), z @ ridge(second)), -0.5, 1.5)
    knots, shares = plain_steps(raw[learn], y[learn])
    np.testing.assert_allclose(model.knots, knots, atol=1e-7)
    np.testing.assert_allclose(model.shares, shares, atol=1e-9)
    last = z @ ridge(learn)
    want = (1 - quality.LEAST) * np.interp(last, knots, shares) + quality.LEAST * np.clip((last + 1) / 3, 0, 1)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    np.testing.assert_allclose([got[i] for i, *_ in marked], want, atol=1e-6)


def test_cosines_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(2)
    d, n = len(quality.NAMES), 20_000
    model = quality.Model(np.zeros(d), np.ones(d), rng.standard_normal((d, n)) / np.sqrt(d) * 1.5,
                          rng.uniform(0, 2 * np.pi, n), None, None, None)
    x = rng.standard_normal((12, d))
    z = model.cosines(x)[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.testing.assert_allclose(z @ z.T, np.exp(-apart * 1.5 ** 2 / d / 2), atol=0.04)


# --- the field over segments -------------------------------------------------------------------

def segmentations(n: int, at: int = 0):
    """All of them, as tuples of (end, length, type); other is one word at a time."""
    if at == n:
        yield ()
        return
    for size in range(1, min(pii.MOST_WORDS, n - at) + 1):
        for kind in range(len(pii.TYPES)):
            if kind or size == 1:
                for rest in segmentations(n, at + size):
                    yield ((at + size, size, kind), *rest)


def region_of(words: list[str]) -> pii.Region:
    return next(pii.regions("before " + " ".join(words)))


@pytest.mark.parametrize("seed", range(12))
def test_best_segments_and_their_probability(seed):
    """The dynamic program against every segmentation of a region of up to six words."""
    rng = np.random.default_rng(seed)
    pool = ["+1", "(743)", "555-3824", "4111", "1111", "a1@mail.example.com", "10.0.0.1", "2019,", "9"]
    region = region_of(rng.choice(pool, 1 + seed % 6).tolist())
    n = len(region.words)
    names = sorted({f for i in range(n) for j in range(i + 1, min(n, i + pii.MOST_WORDS) + 1) for f in pii.features(region, i, j)})
    weights = rng.normal(0, 0.8, (len(names), len(pii.TYPES)))
    number = {f: k for k, f in enumerate(names)}
    value = {}
    for i in range(n):
        for j in range(i + 1, min(n, i + pii.MOST_WORDS) + 1):
            value[j, j - i] = sum(weights[number[f]] for f in pii.features(region, i, j))
    every = list(segmentations(n))
    score = np.array([sum(value[end, size][kind] for end, size, kind in path) for path in every])
    share = np.exp(score - score.max())
    share /= share.sum()
    best = every[int(np.argmax(score))]
    field = pii.Field(number, weights)
    got = field.segments(region)
    assert [(i, j, kind) for i, j, kind, _ in got] == [(end - size, end, kind) for end, size, kind in best if kind]
    for i, j, kind, sure in got:
        assert sure == pytest.approx(sum(p for p, path in zip(share, every) if (j, j - i, kind) in path))
    ahead, behind = pii._sums(field.scores(region))
    whole = score.max() + np.log(np.exp(score - score.max()).sum())
    assert ahead[n] == pytest.approx(whole) and behind[0] == pytest.approx(whole)
    for k in range(n + 1):  # places where a segmentation can be cut
        cut = [s for s, path in zip(score, every) if k in {0, *(end for end, *_ in path)}]
        assert ahead[k] + behind[k] == pytest.approx(np.logaddexp.reduce(cut))


def test_fit_ascends_to_the_likelihood_of_the_given_segments(monkeypatch):
    """After training, given segmentations hold most of the probability among all."""
    monkeypatch.setattr(pii, "EPOCHS", 40)
    examples = [(region_of(["+1", "(743)", f"555-38{k}"]), [(0, 3, 4)]) for k in range(10, 30)]
    examples += [(region_of([f"{k}", "2019"]), []) for k in range(10, 30)]
    field = pii.fit_field(examples)
    for region, gold in examples:
        s, n = field.scores(region), len(region.words)
        every = list(segmentations(n))
        score = np.array([sum(s[end, size - 1, kind] for end, size, kind in path) for path in every])
        want = tuple((j, j - i, k) for i, j, k in gold) or tuple((k + 1, 1, 0) for k in range(n))
        assert np.exp(score[every.index(want)] - np.logaddexp.reduce(score)) > 0.9
