"""Reading the input tables and cutting lineage with stored tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlake.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``(doc_id long, text string)`` of any documents table; other columns are
    left out, so their names and types don't matter."""
    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later jobs start from the files, so a lost executor costs no more than its
    own tasks, and no stage is computed twice.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, column: str) -> DataFrame:
    """Like ``stored``, bucketed by ``column`` (one file a bucket), so that
    joins on it move only the other side.

    The catalog entry that bucketing needs goes at once; the files stay in the
    shared folder.
    """
    spark = df.sparkSession
    name = f"llm_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartition(n, column)
    path = f"{checkpoint_dir(spark)}/{name}"
    spread.write.bucketBy(n, column).option("compression", "none").option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def crc_mod(column: str, n: int) -> Column:
    """crc32 of a column as text, modulo n (null for null)."""
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % F.lit(n)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send the library to the Python workers, once per application, so that
    they need no installation of it."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(path))
        _SHIPPED.add(sc.applicationId)


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(),
}


def map_rows(df: DataFrame, fn: Callable[[Iterator[list]], Iterator[list]], schema: str) -> DataFrame:
    """``mapInArrow`` over plain Python values.

    ``fn`` gets an iterator of batches, each a list of columns, each column a
    list of values (None for null, whole numbers exact), and yields batches as
    lists of row tuples in the order of ``schema``.
    """
    ship_code(df.sparkSession)
    fields = [f.split() for f in schema.split(",")]
    arrow = pa.schema([(name, _ARROW[kind]) for name, kind in fields])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in fn([c.to_pylist() for c in b.columns] for b in batches):
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(mapped, schema)
