"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.scratch import scratch_dir

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Lower-cases A-Z in UTF-8 bytes and leaves every other byte alone.
LOWER = bytes.maketrans(UPPER, UPPER.lower())
#: Also turns every ASCII byte that is no letter or digit into a blank.
WORDS = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in (LOWER[i] for i in range(256))
)
SPACE = b"\x20\t\n\x0b\x0c\r"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that a task hands to its Python worker at once.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back.

    Cuts lineage so that nothing above runs twice, and survives lost executors. The folder is
    the one of spark.checkpoint.dir (see sources/scratch.py).
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the two columns that operators read; null text becomes empty.

    Any further columns of docs are left behind, so their names cannot clash.
    """
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, changed where a column of docs has one of them already."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        out.append(name)
    return out


def utf8(batch, name: str = "text") -> list[bytes]:
    """A text column of an Arrow batch as bytes, without decoding."""
    import pyarrow as pa

    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def arrow_rows(rows: list[tuple], schema: str):
    """Tuples as an Arrow batch; schema in Spark's words, of the types named below."""
    import pyarrow as pa

    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(),
        "array<bigint>": pa.list_(pa.int64()),
    }
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand rows to Python workers in Arrow batches of BATCH_BYTES and at most a row more.

    By default a batch has 10,000 rows or 64 MB, of which the JVM and the worker hold several copies
    each. Workers are used again by later stages and keep much of what their largest batch took, so
    a chain of stages adds up. The rows are the same; a lower limit of the session stays.
    """
    number, unit = re.match(r"\s*(\d+)([kmg]?)", spark.conf.get(_BATCH).lower()).groups()
    if int(number) << 10 * " kmg".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(_BATCH, BATCH_BYTES)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to executors that cannot import it from their own path."""
    import shutil
    import tempfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_tripmill_sent", False):
        return spark
    root = Path(__file__).resolve().parents[2]
    # the driver's own folder: Spark's file server hands the archive to executors
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="tripmill-")) / "tripmill"), "zip", root, "tripmill"
    )
    context.addPyFile(archive)
    context._tripmill_sent = True
    return spark
