"""Listing of input folders."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.schema import BINARY_FILE_SCHEMA, FILES_SCHEMA
from tillbook.sources.settings import listing, settings

# Fixed value: .xlsx, .xls and .xlsm in any case.
WORKBOOK_GLOB = "*.[xX][lL][sS]{,x,X,m,M}"

# Files of any age are loaded: a copied file may keep an old time.
_ANY_AGE = "100000d"


def _pattern(folder: str) -> str:
    """Path pattern of the workbooks directly in a folder, whatever its name."""
    literal = re.sub(r"([\\{}\[\]*?])", r"\\\1", folder.rstrip("/"))
    return f"{literal}/{WORKBOOK_GLOB}"


def workbook_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, modificationTime)`` of all workbooks directly in ``folder``; no content is read."""
    try:
        with settings(spark, listing(spark)):
            files = spark.read.format("binaryFile").load(_pattern(folder))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES_SCHEMA)
    return files.select(*FILES_SCHEMA.fieldNames())


def workbook_stream(spark: SparkSession, folder: str, files_per_trigger: int = 10_000) -> DataFrame:
    """The same folder as a stream: present files first, then new ones.

    ``files_per_trigger=1`` loads file after file in order of arrival. A file
    that is gone before its turn is passed over.
    """
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger).option("maxFileAge", _ANY_AGE)
    with settings(spark, listing(spark)):
        return reader.option("ignoreMissingFiles", "true").load(_pattern(folder)).select(*FILES_SCHEMA.fieldNames())


def new_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files that are not among the loaded ones; a file put back under its old name counts as new."""
    seen = loaded.select("path", F.col("modified_at").alias("modificationTime"))
    return files.select(*FILES_SCHEMA.fieldNames()).distinct().join(seen, FILES_SCHEMA.fieldNames(), "left_anti")
