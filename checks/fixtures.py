"""Rasters derived from the driver's tables; every one grows with its table.

Each fixture is one SQL text per engine (``FIXTURES.md`` part C).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertable.model import CellType, Extent, Layer, Layout, Meta, from_cells, from_scenes, from_tiles

# A strip 128 cells wide; its height holds as many rows as the tables give. Cell size 1.
TALL = Layout(Extent(0.0, -float(1 << 22), 128.0, 0.0), 8, 1 << 18, 16, 16)
SMALL = Layout(Extent(0.0, -32.0, 32.0, 0.0), 4, 4, 8, 8)
KEYED = Layout(Extent(0.0, -float(1 << 22), 128.0, 0.0), 16, 1 << 19, 8, 8)
SCENES = Layout(Extent(0.0, -float(1 << 22), 32.0, 0.0), 4, 1 << 19, 8, 8)

INT32 = CellType.parse("int32")

FX1 = """
SELECT CAST(l_partkey % 128 AS BIGINT) AS x, CAST(floor(l_orderkey / 32) AS BIGINT) AS y,
       0 AS band, CAST(SUM(l_quantity) AS BIGINT) AS v FROM lineitem GROUP BY 1, 2
UNION ALL
SELECT CAST(l_partkey % 128 AS BIGINT) AS x, CAST(floor(l_orderkey / 32) AS BIGINT) AS y,
       1 AS band, CAST(COUNT(*) AS BIGINT) AS v FROM lineitem GROUP BY 1, 2"""

FX2 = """
SELECT CAST(user_id % 32 AS BIGINT) AS x, CAST(event_id % 32 AS BIGINT) AS y,
       date_trunc('hour', ts) AS instant, 0 AS band,
       CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS v
FROM events GROUP BY 1, 2, 3"""

FX3 = """
SELECT CAST(vec_id % 16 AS BIGINT) * 8 + (i - 1) % 8 AS x,
       CAST(floor(vec_id / 16.0) AS BIGINT) * 8 + CAST(floor((i - 1) / 8.0) AS BIGINT) AS y,
       CAST(floor(CAST(embedding[i] AS DOUBLE) * 1000) AS BIGINT) AS v, label
FROM (SELECT vec_id, embedding, label, unnest(range(1, 65)) AS i FROM embeddings) t"""

FX5 = """
SELECT CAST((vec_id * 7) % 24 + (i - 1) % 8 AS BIGINT) AS x,
       CAST(vec_id + CAST(floor((i - 1) / 8.0) AS BIGINT) AS BIGINT) AS y,
       CAST(floor(CAST(embedding[i] AS DOUBLE) * 1000) AS BIGINT) AS v,
       label, vec_id AS priority
FROM (SELECT vec_id, embedding, label, unnest(range(1, 65)) AS i FROM embeddings) t"""

# x and y in cell coordinates, y south; one customer in five lies east of the layer.
PT1 = """
SELECT c_custkey AS point_id, CAST((c_custkey * 7) % 160 AS DOUBLE) + 0.25 AS x,
       CAST(floor(c_custkey / 4) AS DOUBLE) + 0.625 AS y FROM customer"""

# Corner offsets of the three shapes: triangle, square with hole, two parts.
_SHAPES = """
SELECT * FROM (VALUES
 (0,0, 0.0, 0.0,24.0, 8.0),(0,0,24.0, 8.0,10.0,32.0),(0,0,10.0,32.0, 0.0, 0.0),
 (1,0, 0.0, 0.0,20.0, 0.0),(1,0,20.0, 0.0,20.0,20.0),(1,0,20.0,20.0, 0.0,20.0),(1,0, 0.0,20.0, 0.0, 0.0),
 (1,1, 5.0, 5.0,15.0, 5.0),(1,1,15.0, 5.0,15.0,15.0),(1,1,15.0,15.0, 5.0,15.0),(1,1, 5.0,15.0, 5.0, 5.0),
 (2,0, 0.0, 0.0,12.0, 0.0),(2,0,12.0, 0.0, 0.0,12.0),(2,0, 0.0,12.0, 0.0, 0.0),
 (2,1,16.0, 4.0,30.0, 4.0),(2,1,30.0, 4.0,30.0,24.0),(2,1,30.0,24.0,16.0,24.0),(2,1,16.0,24.0,16.0, 4.0)
) AS t(shape, ring, ax, ay, cx, cy)"""

# One polygon per supplier, in cell coordinates, y south.
GEO = f"""
SELECT s_suppkey AS geom_id, CAST(ring AS INT) AS ring,
       (s_suppkey * 13) % 96 + CAST(ax AS DOUBLE) AS x0, s_suppkey * 4 + CAST(ay AS DOUBLE) AS y0,
       (s_suppkey * 13) % 96 + CAST(cx AS DOUBLE) AS x1, s_suppkey * 4 + CAST(cy AS DOUBLE) AS y1
FROM supplier JOIN ({_SHAPES}) s ON s.shape = s_suppkey % 3"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Spark run of a fixture text over the given tables."""
    names = {}
    for name, df in tables.items():
        view = f"fixture_{name}"
        df.createOrReplaceTempView(view)
        names[name] = view
    for name, view in names.items():
        text = text.replace(f"FROM {name}", f"FROM {view}")
    return spark.sql(text)


def fx1_cells(spark: SparkSession, sf_dir: str) -> Layer:
    """FX1 with both bands from one aggregation."""
    x = (F.col("l_partkey") % 128).alias("x")
    y = F.floor(F.col("l_orderkey") / 32).alias("y")
    sums = table(spark, sf_dir, "lineitem").groupBy(x, y).agg(
        F.sum("l_quantity").cast("bigint").alias("total"), F.count(F.lit(1)).alias("n"))
    rows = sums.select("x", "y", F.posexplode(F.array("total", "n")).alias("band", "v"))
    return from_cells(rows, Meta(INT32, TALL, 3857, 2))


def fx1_band(spark: SparkSession, sf_dir: str) -> Layer:
    """Band 0 alone."""
    layer = fx1_cells(spark, sf_dir)
    return layer.with_df(layer.df.where("band = 0"), bands=1)


def fx2_cells(spark: SparkSession, sf_dir: str) -> Layer:
    rows = _sql(spark, FX2, events=table(spark, sf_dir, "events"))
    rows = rows.withColumn("instant", F.col("instant").cast("timestamp_ntz"))
    return from_cells(rows, Meta(INT32, SMALL, 3857, 1, temporal=True))


def _values(df: DataFrame):
    return F.transform("embedding", lambda e: F.floor(e.cast("double") * 1000).cast("bigint"))


def fx3_tiles(spark: SparkSession, sf_dir: str) -> Layer:
    df = table(spark, sf_dir, "embeddings")
    rows = df.select((F.col("vec_id") % 16).cast("int").alias("col"),
                     F.floor(F.col("vec_id") / 16).cast("int").alias("row"),
                     F.array(_values(df)).alias("bands"))
    return from_tiles(rows, Meta(INT32, KEYED, 3857, 1))


def fx3_labels(spark: SparkSession, sf_dir: str) -> Layer:
    """The same tile grid with the label in every cell."""
    df = table(spark, sf_dir, "embeddings")
    rows = df.select((F.col("vec_id") % 16).cast("int").alias("col"),
                     F.floor(F.col("vec_id") / 16).cast("int").alias("row"),
                     F.array(F.array_repeat(F.col("label").cast("bigint"), 64)).alias("bands"))
    return from_tiles(rows, Meta(INT32, KEYED, 3857, 1))


def fx5_scenes(spark: SparkSession, sf_dir: str, temporal: bool = False) -> Layer:
    df = table(spark, sf_dir, "embeddings")
    x0 = ((F.col("vec_id") * 7) % 24).cast("double")
    top = -F.col("vec_id").cast("double")
    names = [F.col("vec_id").alias("scene_id"), F.lit(3857).alias("epsg"), x0.alias("xmin"),
             (top - 8).alias("ymin"), (x0 + 8).alias("xmax"), top.alias("ymax"),
             F.lit(8).alias("cols"), F.lit(8).alias("rows"), F.array(_values(df)).alias("bands")]
    if temporal:
        day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("label"))
        names.append(day.cast("timestamp_ntz").alias("instant"))
    return from_scenes(df.select(*names), Meta(INT32, None, 3857, 1, temporal=temporal))


def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT1 in map coordinates."""
    rows = _sql(spark, PT1, customer=table(spark, sf_dir, "customer"))
    return rows.withColumn("y", -F.col("y"))


def map_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO in map coordinates."""
    rows = _sql(spark, GEO, supplier=table(spark, sf_dir, "supplier"))
    return rows.withColumns({"y0": -F.col("y0"), "y1": -F.col("y1")})
