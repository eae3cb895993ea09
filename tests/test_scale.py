"""What tasks hold, rounds write and shuffles carry stays small, with the same results."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import rastertable as rt

from .helpers import as_array, cell_layer, layout, random_raster
from .test_distance import dijkstra, nearest, point_table, through


def test_cost_rounds_write_news_only(spark, monkeypatch):
    """one path winds through all regions, so a round changes few strips however many there are."""
    from rastertable.operators import cost
    monkeypatch.setattr(cost, "REGION", 4)
    monkeypatch.setattr(cost, "AGED", 3, raising=False)  # tables of tables of news, too
    f = np.full((23, 12), np.nan)
    f[::2] = 1.0
    f[1::4, -1], f[3::4, 0] = 2.0, 3.0
    rows = []

    def counted(df, path):
        out = through(df, path)
        if "round=" in path:
            rows.append(out.count())
        return out

    monkeypatch.setattr(cost, "through_table", counted)
    got = as_array(rt.cost_distance(cell_layer(spark, f), point_table(spark, [(0.5, -0.5)])), 23, 12)
    np.testing.assert_allclose(got, dijkstra(f, [(0, 0)], np.inf), atol=1e-9)
    assert len(rows) > 10 and max(rows) <= 8


def test_regions_of_narrow_maps_are_longer():
    from rastertable.operators import cost
    narrow = cost._Regions(rt.Layout(rt.Extent(0.0, -65536.0, 64.0, 0.0), 4, 4096, 16, 16))
    flat = cost._Regions(rt.Layout(rt.Extent(0.0, -64.0, 65536.0, 0.0), 4096, 4, 16, 16))
    assert (narrow.w, narrow.h) == (64, 1024) and (flat.w, flat.h) == (1024, 64)


def test_cells_of_a_slice():
    """F2, F4 to F10, F12, F14, F15: a run of rows is worked on without the rest of its batch."""
    from rastertable.operators.fold import read_cells
    for kind in (pa.int64(), pa.float64()):
        column = pa.array([[1, 2], [], [3, None], [5]], pa.list_(kind))
        values, ok, ends = read_cells(column.slice(2, 2))
        assert len(values) == 3 and ok.tolist() == [True, False, True] and ends.tolist() == [0, 2, 3]


def test_tasks_work_in_parts(monkeypatch):
    from rastertable.operators import fold, scatter
    batch = pa.RecordBatch.from_arrays([pa.array([[1.0] * 100] * 1000)], ["flat"])
    monkeypatch.setattr(fold, "PART_BYTES", 8000)
    parts = list(fold.in_parts([batch]))
    assert sum(map(len, parts)) == 1000 and max(map(len, parts)) <= 10
    monkeypatch.setattr(scatter, "PART_BYTES", 4096)
    held = scatter._Held(fold.First("bigint"), 1, layout(16, 16, 16))
    for k in range(5):
        held.add((k, 0), 2, 3, (np.full((1, 2, 4), k), np.zeros((1, 2, 4), np.int64)))
    found = list(held.passed_on())
    assert [len(keys) for keys, _, _ in found] == [1] * 5 and not held.tiles
    assert all(boxes == [(2, 3, 4, 2)] and states[0][0].tolist() == [keys[0][0]] * 8 for keys, boxes, states in found)


def test_wide_neighbourhoods_send_tiles_to_few(spark):
    """a tile goes to the blocks near it, not to every tile within reach."""
    from rastertable.operators import focal
    a = random_raster(48, 40, 8, 0.2)
    tiles = rt.to_tiles(cell_layer(spark, a))
    r = 10
    block = focal.block_tiles(tiles.meta.layout, r)
    sent = focal.block_halo(tiles.df, F.get("bands", F.lit(0)), tiles.meta.layout, r, ["col", "row"], block)
    assert sent.select(F.sum(F.size("pieces"))).first()[0] <= 4 * tiles.df.count()  # tile to tile it was more than 20
    got = as_array(rt.focal(tiles, "Max", rt.Square(r)), 48, 40)
    padded = np.pad(np.where(np.isnan(a), -1, a), r, constant_values=-1)
    windows = np.lib.stride_tricks.sliding_window_view(padded, (2 * r + 1, 2 * r + 1))
    np.testing.assert_array_equal(got, windows.max(axis=(2, 3)))
    twice = tiles.with_df(tiles.df.unionByName(tiles.df))
    with pytest.raises(Exception, match="duplicate tile key"):
        rt.focal(twice, "Max", rt.Square(r)).df.collect()
    assert focal.block_tiles(layout(64, 64, 16), 1) is None


def test_distance_of_a_narrow_strip_repeats_nothing(spark, monkeypatch):
    """nodes of a level are bounded by the sources' box, and points travel once to each square."""
    from rastertable.operators import distance
    monkeypatch.setattr(distance, "BROADCAST_BYTES", 32 * 99 - 1)
    monkeypatch.setattr(distance, "salted_join", lambda *a, **b: pytest.fail("every row of a side is repeated"))
    monkeypatch.setattr(distance, "SQUARE", 2, raising=False)
    rng = np.random.default_rng(4)
    found = [(float(x), -float(y)) for x, y in zip(rng.uniform(0, 8, 99), rng.uniform(0, 600, 99))]
    got = as_array(rt.euclidean_distance(layout(600, 8), 3857, point_table(spark, found)), 600, 8)
    rows = ~np.isnan(got).all(axis=1)
    np.testing.assert_allclose(got[rows], nearest(found, 600, 8)[rows])


def test_ids_of_a_block_are_gathered_in_runs(monkeypatch):
    """Pipeline: the ids of a run of documents at a time, the same as those of all."""
    from rastertable.llm import bpe
    texts = ["alpha beta", "", "gamma  delta alpha", "omega", "beta " * 9, ""]
    rows = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(range(6)), pa.array(texts), pa.array([0] * 6, pa.int32())],
                                      ["id", "print", "text", "block"])
    packed = pa.Table.from_batches(list(bpe._packed([rows])))
    words = bpe._block_words(1, pa.int64())((pa.scalar(0),), packed)
    answers = bpe._bucket_ids(None)((pa.scalar(0),), words)
    run = bpe._block_ids(None, 1, pa.int64(), True, True)
    whole = run(packed, answers)
    monkeypatch.setattr(bpe, "WORDS_TOGETHER", 4)
    parts = run(packed, answers)
    assert parts.to_pylist() == whole.to_pylist() and parts.column("ids").num_chunks > 2
    assert run(packed.slice(0, 0), answers.slice(0, 0)).num_rows == 0
