"""Single objects on any file system that executors reach through ``pyarrow.fs``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _opener() -> Callable[[str], tuple[fs.FileSystem, str]]:
    """A function from a URI to its file system and path; nested, so that executors need no
    copy of this package."""

    def locate(uri: str) -> tuple[fs.FileSystem, str]:
        if uri.startswith("file:") and "://" not in uri:
            uri = "file://" + uri.removeprefix("file:")
        return fs.FileSystem.from_uri(uri)

    return locate


def write_objects(rows: DataFrame, path: str = "path", content: str = "content") -> int:
    """Write one object per row; returns how many.

    An object is replaced as a whole, so a task that runs twice leaves the same files.
    """

    locate = _opener()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, text in zip(batch["path"], batch["content"], strict=True):
                system, name = locate(uri)
                system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(name) as out:
                    out.write(text.encode("utf-8"))
            yield pd.DataFrame({"written": [len(batch)]})

    named = rows.select(F.col(path).alias("path"), F.col(content).alias("content"))
    total = named.mapInPandas(write, "written bigint").agg(F.sum("written")).first()[0]
    return total or 0


def delete_objects(rows: DataFrame, path: str = "path") -> int:
    """Delete one object per row; an object that is gone already is fine."""

    locate = _opener()

    def delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                system, name = locate(uri)
                if system.get_file_info(name).type == fs.FileType.File:
                    system.delete_file(name)
            yield pd.DataFrame({"deleted": [len(batch)]})

    named = rows.select(F.col(path).alias("path"))
    total = named.mapInPandas(delete, "deleted bigint").agg(F.sum("deleted")).first()[0]
    return total or 0
