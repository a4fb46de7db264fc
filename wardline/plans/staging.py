"""Tables that are written once per session and data folder, then read.

A deployment has its messages on a topic and its results in two tables before
anyone asks a question; scoring and monitoring never go back to raw messages.
The queries get the same footing: the first one to need a table writes it to
the shared folder, later ones - and tasks rerun after an executor loss - read
it.  A table is written anew when the data it came from has changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wardline.session import shared_dir
from wardline.sources.tables import is_complete, state_of

_FOLDERS: dict[tuple, str] = {}


def forget() -> None:
    """Write every table anew on its next use."""
    _FOLDERS.clear()


def written_once(
    spark: SparkSession,
    directory: str,
    source: str,
    name: str,
    schema: StructType,
    build: Callable[[], DataFrame],
) -> DataFrame:
    """The table ``name`` derived by ``build`` from a table of ``directory``."""
    state = state_of(spark, directory, source)
    key = (spark.sparkContext.applicationId, directory, source, state, name)
    folder = _FOLDERS.get(key)
    if folder is None or not is_complete(spark, folder):
        folder = shared_dir(spark, name)
        build().write.option("compression", "zstd").parquet(folder)  # JSON text takes half of what snappy leaves
        _FOLDERS[key] = folder
    return spark.read.schema(schema).parquet(folder)


def folder_once(
    spark: SparkSession, directory: str, source: str, name: str, build: Callable[[str], None]
) -> str:
    """A folder that ``build`` fills from a table of ``directory``; filled once like ``written_once``."""
    key = (spark.sparkContext.applicationId, directory, source, state_of(spark, directory, source), name)
    if key not in _FOLDERS:
        folder = shared_dir(spark, name)
        build(folder)
        _FOLDERS[key] = folder
    return _FOLDERS[key]
