"""SQL scripts: several statements, the last of which is the result.

``CREATE TEMPORARY VIEW .. USING json | parquet OPTIONS (path ..)`` opens a topic
or the rows of a keyed table, ``INSERT INTO view SELECT ..`` appends to one: the
file is visible only once the whole statement has succeeded.  The script is one
of Spark's compound statements; nothing is parsed here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_script(spark: SparkSession, text: str) -> DataFrame:
    """Run the statements of ``text``, separated by semicolons; the rows of the last one."""
    return spark.sql(f"BEGIN\n{text.strip().rstrip(';')};\nEND")
