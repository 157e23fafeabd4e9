"""Ranges of ids, and files in shared storage that tasks write themselves."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame


def id_bounds(df: DataFrame, parts: int, column: str = "doc_id") -> np.ndarray:
    """Ascending ids that split the rows into at most ``parts`` ranges of like size. They come from
    one scan of the id column; the driver gets ``parts`` numbers."""
    if parts < 2:
        return np.empty(0, np.int64)
    found = df.select(df[column].cast("long").alias("id")).approxQuantile("id", [i / parts for i in range(1, parts)], 0.2 / parts)
    return np.unique(np.array(found, np.float64).astype(np.int64))


def part_of(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Range of each id; null ids are in the first."""
    lowest = np.iinfo(np.int64).min
    return np.searchsorted(bounds, ids.fill_null(lowest).to_numpy(zero_copy_only=False), side="right").astype(np.int32)


def storage(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a folder that every executor reaches. The folder is made. Tasks
    write through Arrow, which knows local paths, ``file``, ``hdfs``, ``viewfs``, ``s3``, ``gs`` and ``abfs``."""
    try:
        files, path = fs.FileSystem.from_uri(folder if "://" in folder else folder.removeprefix("file:"))
    except (pa.ArrowInvalid, OSError) as error:
        raise ValueError(f"tasks cannot write files to {folder}: {error}") from error
    files.create_dir(path, recursive=True)
    return files, path
