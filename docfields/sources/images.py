"""Image files waiting to be recognised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Top level only: loading the folder itself would read a `k=v` subfolder as a partition and hide the files beside it.
IMAGE_GLOB = "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[pP][nN][gG]}"


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """Image files of a folder, by name (O3). Contents are read only where a later step asks for them."""
    files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{IMAGE_GLOB}")
    return files.select("path", "modificationTime", "length").orderBy("path")


def image_names(files: DataFrame) -> DataFrame:
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"))
