"""Text sinks for profile results and the store for fitted models.

The inputs are aggregates. Rows are ordered with a range-partitioned sort, so a small result
becomes one part file (adaptive execution merges the partitions) and a large one becomes many
parts that are ordered among themselves; nothing is gathered into one task by force.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: How a missing value is written in tables, Values, Tags and Ranges; '' is written as "".
MISSING = r"\N"


def write_series(series: DataFrame, base: str, tag: str, value: str) -> None:
    """A series as a CSV table at <base>, plus its two columns as <base>Values and <base>Tags.

    Line i of Values belongs to line i of Tags: both are ordered by the unique tag.
    """
    table = write_table(series.select(tag, value).orderBy(tag), base).orderBy(tag)
    _write_lines(table.select(value), base + "Values")
    _write_lines(table.select(tag), base + "Tags")


def write_histogram(histogram: DataFrame, base: str) -> None:
    """A histogram as a CSV table at <base>, its counts as <base>Values and its n+1 edges as
    <base>Ranges. A histogram is one partition of as many rows as it has buckets."""
    table = write_table(histogram, base).coalesce(1)
    _write_lines(table.sortWithinPartitions("bucket").select("n"), base + "Values")
    edges = table.select("lo").union(table.agg(F.max("hi"))).filter("lo is not null")
    _write_lines(edges.coalesce(1).sortWithinPartitions("lo"), base + "Ranges")


def write_grid(grid: DataFrame, path: str) -> None:
    """Density cells as bare 'lat,lon,count' lines, densest first over all parts."""
    cells = grid.orderBy(F.desc("n"), "lat", "lon").select("lat", "lon", "n")
    cells.write.mode("overwrite").csv(path)  # a missing coordinate stays an empty field


def write_matrix(matrix: DataFrame, base: str) -> None:
    """A pivoted correlation matrix (row, then one column per variable) as <base>Values, with the
    variable names as one line in <base>Tags."""
    names = [c for c in matrix.columns if c not in ("row", "position")]
    # one row per variable, already in one partition
    _write_lines(
        matrix.coalesce(1).sortWithinPartitions("position").select(names), base + "Values"
    )
    tags = matrix.sparkSession.range(0, 1, 1, 1).select(F.lit(",".join(names)))
    tags.write.mode("overwrite").text(base + "Tags")


def write_table(table: DataFrame, base: str) -> DataFrame:
    """Write a CSV table and return it as stored, so that the source is read only once."""
    table.write.mode("overwrite").options(header=True, nullValue=MISSING).csv(base)
    return read_series(table.sparkSession, base, table.schema)


def _write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("nullValue", MISSING).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Store a fitted feature-and-model chain, replacing what is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_series(spark: SparkSession, base: str, schema) -> DataFrame:
    """Read back a table written by write_series or write_histogram."""
    return spark.read.schema(schema).options(header=True, nullValue=MISSING).csv(base)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, text): the lines of a text sink, numbered from 1 over all of its parts in order.

    Every split of a part counts its own lines; offsets come from the counts, a row per split, so
    that no line is sorted. Equal line numbers of a series' Values and Tags belong together.
    """
    split = ["file", "block"]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),  # ascends by one within a split
        F.col("value").alias("text"),
    )
    counts = lines.groupBy(split).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # part numbers have five digits or more
    before = Window.orderBy(F.length("file"), *split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*split, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("k"))
    return lines.join(offsets, split).select(
        (F.col("k") + F.col("at") - F.col("first") + 1).alias("line"), "text"
    )
