"""Helpers the training-data operators share."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words are runs of anything but the six ASCII space characters.
SPACES = " \t\n\x0b\x0c\r"
PACKAGE = "askgauge-sources.zip"
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A folder every executor reaches: the session's checkpoint folder, else one in the warehouse."""
    checkpoints = spark.conf.get("spark.checkpoint.dir", None)
    return checkpoints or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, so a lost executor costs a reread only."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession) -> SparkSession:
    """The session, once its Python workers can import this package, wherever they run and start from.

    Spark's file server hands every executor a copy of the package's sources.
    """
    context = spark.sparkContext
    if PACKAGE not in context._python_includes:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="askgauge-"), PACKAGE)
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(path)
    return spark


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with workers that know this package."""
    shipped(df.sparkSession)
    return df.mapInArrow(function, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % n


def is_held_out(key: Column, n: int) -> Column:
    """Whether the remainder is 2; rows without a key are not held out."""
    return F.coalesce(remainder(key, n) == 2, F.lit(False))


def words(text: Column) -> Column:
    """The words of a text; none for a null or blank one."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, WORD_GAP)).otherwise(F.array().cast("array<string>"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


LOWER_ASCII = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def slices(batches, rows: int):
    """Record batches of at most ``rows`` rows each, so that what Python makes of one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def replace_columns(batch, new: dict):
    """The batch with the given columns appended; an input column of the same name gives way."""
    import pyarrow as pa

    taken = {n.lower() for n in new}
    kept = [i for i, n in enumerate(batch.schema.names) if n.lower() not in taken]
    arrays = [batch.column(i) for i in kept] + list(new.values())
    return pa.RecordBatch.from_arrays(arrays, [batch.schema.names[i] for i in kept] + list(new))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as keep it apart from the frame's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def schema_with(df: DataFrame, added: str) -> str:
    """DDL of the frame's columns followed by ``added``; clashing input columns give way."""
    from pyspark.sql.types import StructType

    extra = StructType.fromDDL(added)
    taken = {f.name.lower() for f in extra}
    return StructType([f for f in df.schema if f.name.lower() not in taken] + list(extra))
