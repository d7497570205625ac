"""Binary files through Spark's own writer and reader.

Spark has no binary sink, but its text sink writes a string column's bytes as
they are, each row followed by the line separator. Where every chunk of a file
format can be made to end in one known byte, that byte is the separator, and
the files come out byte for byte as the format asks. They go through Spark's
commit protocol and to any file system Spark can write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_chunks(chunks: DataFrame, path: str, last: bytes) -> None:
    """Write the binary column ``chunk`` of each partition as one file.

    Each chunk comes without its final byte, which is ``last`` for all.
    """
    (chunks.select(F.col("chunk").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", last.decode("latin-1"))
     .option("compression", "none").text(path))


def read_files(spark: SparkSession, path: str, names: str = "part-*") -> DataFrame:
    """(path, content) of the non-empty files of such names at any depth, in no order; by default what Spark wrote."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", True)
            .load(path).where("length > 0").select("path", "content"))
