"""Files that tasks write and read in the folder all executors share.

Paths are URIs of any file system that Arrow knows. A task writes under a name
of its own attempt and moves the finished file to its final name, so a lost
executor or a second attempt leaves one whole file.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, and its path there."""
    return fs.FileSystem.from_uri(uri)


@contextmanager
def finished_file(uri: str) -> Iterator:
    """A stream for the file at ``uri``, which appears when the block ends well."""
    system, path = file_system(uri)
    system.create_dir(posixpath.dirname(path), recursive=True)
    draft = posixpath.join(posixpath.dirname(path), f"_{uuid.uuid4().hex}")
    try:
        with system.open_output_stream(draft, compression=None) as stream:
            yield stream
        system.move(draft, path)
    except BaseException:
        if system.get_file_info(draft).type != fs.FileType.NotFound:
            system.delete_file(draft)
        raise


def listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``path`` and ``length`` of the files of a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length")
