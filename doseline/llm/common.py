"""What the text operators share: the word pattern, durable intermediate tables, shipping."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import doseline

# White space is exactly these six ASCII characters; everything else belongs to words. In
# bytes this is what bytes.split() without arguments does.
WORD = r"[^\x20\x09-\x0D]+"

SPACE_BYTE = re.compile(rb"[\x20\x09-\x0D]")
BYTES_AT_ONCE = 1 << 20


def text_blocks(data: bytes, size: int = BYTES_AT_ONCE) -> Iterator[bytes]:
    """A text in order, cut at white space, so that a very long one needs little memory."""
    at = 0
    while at < len(data):
        end = len(data)
        if at + size < end and (cut := SPACE_BYTE.search(data, at + size)):
            end = cut.start()
        yield data[at:end]
        at = end


def struct(**kinds: T.DataType) -> T.StructType:
    """A schema from names and types; unlike DDL text it needs no session."""
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(id_col: str, text_col: str) -> Column:
    """Id and whole text of a row in one: decisions on rows must not go by an id alone, which
    may be null or repeat with another text."""
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    return F.concat_ws(":", sha, F.col(id_col).cast("string"))


def beside(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows of `docs`, each packed whole in one column `row`, beside working columns made from
    them: none of these can clash with a caller's column, which `select("row.*")` brings back."""
    working = [column.alias(name) for name, column in columns.items()]
    return docs.select(F.struct(F.col("*")).alias("row"), *working)


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Unset, a temporary one, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="doseline-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_doseline_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(doseline.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="doseline-package-"), "doseline.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    context._doseline_shipped = True
