"""Files that tasks write to and read from the folder that the cluster shares."""

from __future__ import annotations

import uuid

import numpy as np
from pyarrow import fs
from pyspark.sql import SparkSession

from docfields.session import run_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A URI in this application's part of the shared folder that nothing else uses."""
    folder = run_folder(spark)
    if folder.startswith("/"):
        folder = f"file://{folder}"
    elif folder.startswith("file:/") and not folder.startswith("file://"):
        folder = f"file://{folder[5:]}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def create(uri: str):
    """An output stream to a new file; its folder is made if the store has folders."""
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def opened(uri: str):
    """A file that can be read at any place."""
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def mapped(uri: str, dtype, count: int, offset: int = 0) -> np.ndarray:
    """``count`` values of a file: memory-mapped where the shared folder is mounted, else read."""
    if not count:
        return np.zeros(0, dtype=dtype)
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r", offset=offset, shape=(count,))
    with store.open_input_file(path) as f:
        f.seek(offset)
        return np.frombuffer(f.read(count * np.dtype(dtype).itemsize), dtype=dtype)


def attempt_name(prefix: str, suffix: str) -> str:
    """A file name for this attempt of this task: an attempt that is lost or repeated leaves no file that is used."""
    from pyspark import TaskContext

    return f"{prefix}-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}{suffix}"
