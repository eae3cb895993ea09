"""Registered queries, and the pipeline stage by stage against plain versions."""

from __future__ import annotations

import hashlib
import os

import pytest

import corpus_pipeline
from checks.run import database, difference
from rastertable.llm import quality
from rastertable.llm.encoding import word_tokenizer
from rastertable.llm.queries import ORACLES, QUERIES

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.mark.parametrize("name", ORACLES)
def test_query_against_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert difference(got, database(SF).execute(ORACLES[name]).df()) is None


def test_quality_of_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")  # the smallest table holds too few labels
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op3_quality"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert rows and right >= 0.95 * len(rows)


def mixed(docs):
    """(id, words in order) of a mix of (id, text, source)."""
    words = {i: brute.WORD.findall(t) for i, t, _ in docs}
    sizes: dict = {}
    for i, _, s in docs:
        sizes[s] = sizes.get(s, 0) + len(words[i])
    out = []
    for source, target in brute.mix_targets(sizes).items():
        own = sorted((i for i, _, s in docs if s == source),
                     key=lambda i: (hashlib.md5(f"0:{i}:{len(words[i])}".encode()).hexdigest()[:15], i))
        budget = int(target + 0.5)
        while budget > 0:
            for i in own:
                if budget > 0 and words[i]:
                    out.append((i, words[i][:budget]))
                    budget -= len(words[i])
    return out


def test_stages(spark):
    """The classifier's own threshold, then plain versions of the other stages on what it keeps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SF).cache()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    assert good.columns == docs.columns
    assert sum(labels[i] == 1 for i in kept if i in labels) >= 0.9 * sum(labels.values())
    rows = [(r.doc_id, r.text, r.source) for r in good.collect()]
    unique = brute.exact([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if unique[r[0]][2]]
    found = brute.near([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if found[r[0]][1] == r[0]]
    tokenizer = word_tokenizer(None)
    want = sorted((i, tokenizer.encode(" ".join(w), add_special_tokens=False).ids) for i, w in mixed(rows))
    table = good
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        table = stage(spark, table, SF)
        assert table.columns == docs.columns, name
    got = corpus_pipeline.STAGES[-1][1](spark, table, SF).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == want
    assert quality.THRESHOLD == 0.3


def test_empty_documents(spark, tmp_path):
    """Stages without rows, or without a row that the one before keeps."""
    for name in ("documents", "labels"):
        whole = spark.read.parquet(f"{SF}/{name}.parquet")
        whole.where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "n_tokens", "ids"} <= set(out.columns)
