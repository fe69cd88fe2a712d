"""Reading the raw export, cleaned tables and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keepwell.functions.exprs import strict_number
from keepwell.session import written
from keepwell.sources.schemas import RAW_FILES, RAW_TABLES, TABLES


def load_raw(
    spark: SparkSession, folder: str, files: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """The nine raw CSV tables by role, with the declared types.

    A role is read from one file: the name given in ``files``, or the only one that carries the
    role's name part.  A missing file, several of them, and a header that differs from the
    declared columns are errors.  Columns are read as text and cast strictly, so bad numbers and
    further decimals raise when the rows are used.  Review texts hold line feeds, which keeps
    that file in one task; it is written once as Parquet and read in parts from there.
    """
    tables = {}
    for role, schema in RAW_TABLES.items():
        name = (files or {}).get(role)
        path = f"{folder}/{name}" if name else _only_match(spark, folder, RAW_FILES[role], role)
        text = StructType([StructField(f.name, StringType()) for f in schema])
        reader = spark.read.schema(text).option("enforceSchema", False).option("mode", "FAILFAST")
        try:
            table = reader.csv(path, header=True, multiLine=role == "reviews", escape='"')
        except AnalysisException as err:
            raise FileNotFoundError(f"no raw file for {role}: {path}") from err
        if role == "reviews":
            table = written(table)
        tables[role] = table.select(
            *[
                F.col(f.name) if f.dataType == StringType() else strict_number(f.name, f.dataType.simpleString()).alias(f.name)
                for f in schema
            ]
        )
    return tables


def _only_match(spark: SparkSession, folder: str, part: str, role: str) -> str:
    """The one file of the folder whose name holds the part, looked up in the folder's own store."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*{part}*.csv")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = sorted(f.getPath().toString() for f in found)
    if not paths:
        raise FileNotFoundError(f"no raw file for {role}: {pattern.toString()}")
    if len(paths) > 1:
        raise ValueError(f"several raw files for {role}: {', '.join(paths)}")
    return paths[0]


def load_tables(
    spark: SparkSession, folder: str, names: list[str] | None = None
) -> dict[str, DataFrame]:
    """Cleaned tables written by :func:`keepwell.sources.writers.write_tables`."""
    return {
        name: spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}") for name in names or TABLES
    }


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run SQL text over the tables; values are bound with ``:name``, never pasted in."""
    register_views(tables or {})
    return spark.sql(text, args=dict(args or {}))
