"""License templates, hard negatives and the dataset manifest against plain versions."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rastertable.llm import hard_negatives, license_scan, license_templates, manifest

from . import brute

# --- 11 ----------------------------------------------------------------------------------------

MIT = license_templates.TEMPLATES["mit"][0]
PLAIN_MIT = brute.MARK.sub(lambda m: "the authors" if m[1].startswith("words") else " ", MIT)
TEXTS = [
    None, "", " \n", "word", "MIT", "released under the MIT license.", "UNDER the.MIT/license under the mit license",
    "under the mit licenses", "xunder the mit license", "under the mit\x00license", "under the mité license",
    "Licensed under the Apache License, Version 2.0.", "apache license version 2", "Apache Software License 2.0",
    "is licensed under the terms of the Apache Software License version 2.0 now", "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc",
    "licensed under a CC BY-NC-SA 4.0 license", "licensed under cc by 3.0", "cc by", "Copyright 2020\n" + PLAIN_MIT + " end",
    PLAIN_MIT.replace("sublicense", "lend"), PLAIN_MIT.replace("the authors", "a b c d e f g h i j k l m n o"),
    PLAIN_MIT + PLAIN_MIT, "licensed under the GNU General Public License, version 3.",
    "redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
    "Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "SPDX-License-Identifier: Apache-2.0", "licensed " * 500 + "under the mit license", "İ ſ K under the mit license",
    "words " * 300_000 + "under the mit license",  # longer than a slice beside the others
]
SCHEMA = "doc_id int, text string, ROW string, n_words string, licenses int, label string"


@pytest.fixture(scope="module")
def licensed(spark):
    return spark.createDataFrame([(i, t, "r", "n", i, "x") for i, t in enumerate([*TEXTS, *TEXTS[:20]])], SCHEMA).repartition(3)


def test_licenses(licensed):
    out = {r.doc_id: r for r in license_scan.scan(licensed).collect()}
    assert len(out) == len(TEXTS) + 20 and out[5].ROW == "r" and out[5].label == "x"
    for i, text in enumerate([*TEXTS, *TEXTS[:20]]):
        short = text[-200:] if text and len(text) > 100_000 else text
        words, shift = brute.license_words(text), len(brute.license_words(text)) - len(brute.license_words(short))
        want = [(x, b, s + shift, e + shift) for x, b, s, e in brute.licenses(short, license_scan.ALL)]
        assert out[i].n_words == len(words) and [tuple(s) for s in out[i].licenses] == want, text[:80]


def test_license_digest(licensed):
    out = {r.doc_id: r for r in license_scan.digest(license_scan.scan(licensed)).collect()}
    assert (out[6].n_base, out[6].first_word, out[6].last_word, out[6].base_labels) == (2, 0, 4, "mit")
    assert (out[0].n_words, out[0].n_base, out[0].first_word, out[0].labels, out[0].score) == (0, 0, None, "", 0.0)
    assert out[15].labels == "cc-by-nc" and out[17].labels == "cc-by-nc,cc-by-nc-sa" and out[17].base_labels == "cc-by-nc"
    assert out[5].score == 1.0 and 0.9 < out[20].score < 1.0 and out[20].labels == "mit" and out[20].n_base == 0
    assert out[21].labels == "" and out[22].labels == "" and out[24].labels == "gpl-3" and out[25].labels == "lgpl-2"
    phrases = [(x, brute.license_words(p)) for x, p in license_templates.PHRASES]
    for i, text in enumerate(TEXTS):
        words = brute.license_words(text)
        at = sorted((k, x) for x, p in phrases for k in range(len(words)) if words[k:k + len(p)] == p)
        assert (out[i].n_base, out[i].first_word, out[i].last_word, out[i].base_labels) == (
            len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at})))


def test_licenses_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert license_scan.digest(license_scan.scan(empty)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.recursive(st.sampled_from(["a", "b", "c", "<<words 0 2>>", "<<words 1 3>>"]),
                    lambda t: st.lists(t, min_size=1, max_size=4).map(lambda p: "<<optional>>" + " ".join(p) + "<</optional>>")
                    | st.lists(t, min_size=1, max_size=4).map(" ".join), max_leaves=8),
       st.lists(st.sampled_from("abcd"), max_size=12))
def test_templates_against_backtracking(template, words):
    template = "a " + template
    automaton = license_scan.compile_template(template)
    ends = brute.template_ends(brute.template_tree(template), words, 0)
    assert automaton.longest(words) == (max(ends) if ends else None)


def test_templates_that_cannot_be():
    for bad in ("a <<optional>> b", "a <</optional>>", "<<words 1 2>> a", "<<optional>>a<</optional>>", "a <<words 1 900>>"):
        with pytest.raises(ValueError):
            license_scan.compile_template(bad)


def test_words_of_neighbouring_texts():
    """A word ends with its text, and a phrase does not go on in the next one."""
    found = license_scan.Matcher(license_scan.ALL).find(pa.array(["under the", "mit license", "", "under the mit", "license"], pa.large_string()))
    assert found[0].tolist() == [2, 2, 0, 3, 1] and found[1] == []


# --- 12 ----------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, score string, anchor int"


def _vectors(seed: int, n: int = 120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        base = [rng.choice([-1.0, 0.25, 0.5, 1.0]) + (rng.random() / 50 if kind < 0.5 else 0) for _ in range(4)]
        rows.append((i, rng.choice([0, 1, 2]), base))
    third = [(200 + i, i % 2, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]  # one vector, both labels: all scores tie
    odd = [(300, 0, [0.0] * 4), (301, 1, [0.0] * 4), (302, None, [1.0] * 4), (303, 1, None), (304, 1, [float("nan"), 1.0, 1.0, 1.0]),
           (305, 1, [None, 1.0, 1.0, 1.0]), (306, 1, [float("inf"), 1.0, 1.0, 1.0]), (None, 1, [1.0] * 4), (310, 0, [1.0, 1.0]),
           (311, 0, [1.0, 0.5]), (312, 1, [1.0, 0.9]), (313, 9, [1.0] * 4), (320, 0, []), (321, 0, []), (322, 1, []),
           (330, 0, [9e5, 1.0, 3.0, 1.0]), (331, 0, [9e5, 2.0, 1.0, 1.0]), (332, 1, [9e5, 1.0, 1.0, 1.0]),
           (-10, 2, [1.0, 0.5, 0.25, 1.0])]
    return rows + third + odd + rows[:9] + third[:5]  # rows that repeat


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    """The same with many small blocks, batches and sections."""
    if small:
        for name, value in (("BLOCK", 7), ("BATCH", 3), ("SECTION", 40)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = _vectors(3)
    df = spark.createDataFrame([(i, v, x, "s", 1) for i, x, v in rows], VECTORS).repartition(5)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == brute.mined(rows, lambda i: i % 10 == 0)
    how = hard_negatives.Mining(positives=2, negatives=3, low=50, high=90)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, how=how)
    assert sorted(map(tuple, got.collect())) == brute.mined(rows, lambda i: i % 10 == 0, 2, 3, 50, 90)


def test_hard_negatives_of_large_components(spark):
    """Scores beyond what doubles hold stay exact; a component that a long cannot carry takes no part."""
    rows = [(0, 0, [4e6, 3.0]), (1, 0, [4e6, 2.0]), (2, 1, [4e6, 1.0]), (3, 1, [4e6, 1.5]), (4, 0, [1e300, 1.0])]
    df = spark.createDataFrame([(i, v, x, "s", 1) for i, x, v in rows], VECTORS)
    got = hard_negatives.mine(df, F.col("vec_id") == 0)
    assert sorted(map(tuple, got.collect())) == brute.mined(rows[:4], lambda i: i == 0)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(empty, F.col("vec_id") % 10 == 0).collect() == []
    alone = spark.createDataFrame([(1, [1.0], 0, "s", 1), (2, [1.0], 1, "s", 1)], VECTORS)
    assert hard_negatives.mine(alone, F.col("vec_id") > 5).collect() == []  # no anchors
    assert hard_negatives.mine(alone, F.col("vec_id") > 0).collect() == []  # no positives


# --- 13 ----------------------------------------------------------------------------------------

DOCS = "doc_id bigint, text string, lang string, n_chars bigint, ROW string, leaf int, address string, path string"
FIELDS = ["doc_id", "lang", "n_chars", "text"]


def _docs(sizes: dict):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            text = None if i % 11 == 0 else "" if i % 7 == 0 else f"Text É{i % 5} " * (i % 4)
            rows.append((None if i % 13 == 0 else i * 37 % 101, text, lang, None if i % 9 == 0 else i, "r", 1, "a", "p"))
    return rows


@pytest.mark.parametrize("sizes,fanout", [
    ({"en": 70, None: 9, "ä": 1, "": 8, "b": 65}, 8), ({"en": 1}, 8), ({"en": 5}, 8), ({"a": 1, "b": 1}, 8),
    ({chr(97 + k): 1 + k % 3 for k in range(20)}, 3), ({"en": 33}, 2)])
def test_manifest(spark, sizes, fanout):
    rows = _docs(sizes)
    rows += rows[:4] * 9  # rows that repeat whole: equal leaves, equal nodes
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    claim = manifest.leaf_digest(*[F.lower("text") if c == "text" else F.col(c) for c in FIELDS])
    built = manifest.build(df, FIELDS, fanout=fanout, more={"low": F.when(F.col("n_chars") % 2 == 0, claim)})
    got = manifest.audit(built, claimed="low").collect()

    def claimed(r):
        return [r[0], r[2], r[3], r[1].lower() if r[1] and r[3] and r[3] % 2 == 0 else r[1]]

    want = brute.manifest([(r[0], r[2], [r[0], r[2], r[3], r[1]], claimed(r)) for r in rows], fanout)
    # of rows with equal id and different claims, neighbours are ordered by leaf alone
    assert sorted(map(tuple, got), key=str) == want
    assert any(r.verified for r in got)
    for r in built.records.collect():
        children = bytes(r.children)
        assert brute.sha(children.hex()) == bytes(r.digest).hex() and 1 <= len(children) // 32 <= fanout


def test_manifest_requests(spark):
    """Asked for a few leaves, some twice, some not there."""
    built = manifest.build(spark.createDataFrame(_docs({"en": 70, "de": 9}), DOCS), FIELDS)
    known = built.leaves.orderBy("address").collect()
    asked = [known[0].address, known[0].address, known[-1].address, "0", "0999", "zz", "0" * 30, "", None]
    df = spark.createDataFrame([(a, k, "p", "d") for k, a in enumerate(asked)], "address string, n int, prefix string, digit string")
    out = {r.n: r for r in manifest.proofs(built, df).collect()}
    assert set(out) == {0, 1, 2, 3} and out[0].prefix == "p" and out[0].path == out[1].path
    assert out[0].path[-1:] == out[3].path  # "0" is the node of a partition
    again = manifest.proofs(built, df.where("n < 3").join(built.leaves.select("address", "leaf"), "address"))
    assert {r[0] for r in again.select(manifest.folded(F.col("leaf"), F.col("path"))).collect()} == {built.root.hex()}


def test_manifest_of_nothing(spark):
    built = manifest.build(spark.createDataFrame([], DOCS), FIELDS)
    assert built.root is None and manifest.audit(built).collect() == []
    with pytest.raises(ValueError):
        manifest.build(spark.createDataFrame([], DOCS), FIELDS, fanout=1)
