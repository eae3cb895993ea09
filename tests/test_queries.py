"""Every registered query against its SQL on the small tables, and the plans of the joins."""

import os

import pytest

from checks.all_queries import ORACLES, QUERIES
from checks.run import database, difference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert difference(got, con.execute(ORACLES[name]).df()) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [
    "mask", "polygonal_sum", "sum_series", "point_values", "focal_Median_Circle", "slope",
    "tile_to_layout", "resample_Bilinear", "pyramid_average", "reproject_tiles", "rasterize",
    "read_tiles_zoomed", "combine_bands", "merge", "quantile_breaks_exact", "filter_by_geometry"])
def test_no_pairing_of_everything(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """A driver elsewhere finds the package by path only; its Python workers do not."""
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
import __spark_entry__ as e
from checks.run import session
spark = session(2)
for name in ("slope", "merge", "pyramid_average"):
    assert e.queries()[name](spark, {SF!r}).count() > 0
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=300)
