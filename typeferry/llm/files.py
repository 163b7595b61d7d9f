"""Files that tasks write and read in the folder all executors share."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


class NewFile:
    """A file under a name of its own. A task that is run again writes another; only the
    names that a finished task returns count."""

    def __init__(self, folder: str, suffix: str):
        system, place = file_system(folder)
        system.create_dir(place, recursive=True)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        path = os.path.join(place, self.name)
        self.stream = system.open_output_stream(path, compression=None)  # not by the suffix
        self.size = 0

    def write(self, data: bytes | memoryview) -> None:
        self.stream.write(data)
        self.size += memoryview(data).nbytes

    def close(self) -> None:
        self.stream.close()


def read_file(folder: str, name: str) -> bytes:
    system, place = file_system(folder)
    with system.open_input_file(os.path.join(place, name)) as file:
        return file.read()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this library wrote under the shared one."""
    if "/typeferry-llm/" not in folder:
        raise ValueError(f"not a folder of this library: {folder}")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
