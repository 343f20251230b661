"""Rows as files of their own, written by the tasks."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Files of one folder at most.
FOLDER_FILES = 1_000


def write_blobs(df: DataFrame, value: str, path: str) -> list[str]:
    """One file per row of a text column, which a line break ends, and the folders below ``path`` that hold them.

    Where ``path`` is a folder of the file system, tasks write the files themselves: Spark's writer sets the mode of each file there by a process
    of its own, and keeps a second file with its checksum. An attempt of a task writes into folders of its own and names them when it has ended, so
    what a failed attempt has left is in no folder that is returned. One name per ``FOLDER_FILES`` files or task reaches the driver. Elsewhere
    Spark's writer writes one folder.
    """
    where = urlsplit(path)
    if where.scheme not in ("", "file"):
        # Tasks move their files to the folder themselves, so that the driver does not rename them one by one when the job ends.
        writer = df.select(F.col(value).alias("value")).write.option("maxRecordsPerFile", 1)
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
        return [path]
    root, most = unquote(where.path) if where.scheme else path, FOLDER_FILES

    # A function within this one goes to the workers by value: they need not have this package.
    def write(batches):
        import os
        import uuid

        import pyarrow as pa

        attempt, folder, n = uuid.uuid4().hex, None, 0
        for batch in batches:
            for text in batch.column(0):
                if n % most == 0:
                    if folder is not None:
                        yield pa.RecordBatch.from_pydict({"folder": [folder]})
                    folder = f"{attempt}-{n // most:06d}"
                    os.makedirs(f"{root}/{folder}")
                content = text.as_py()
                with open(f"{root}/{folder}/{n % most:06d}.txt", "xb", buffering=0) as file:
                    left = memoryview((content or b"") + b"\n")
                    while left:
                        left = left[file.write(left):]
                n += 1
        if folder is not None:
            yield pa.RecordBatch.from_pydict({"folder": [folder]})

    written = df.select(F.col(value).cast("binary").alias("value")).mapInArrow(write, "folder string").collect()
    return [f"{path.rstrip('/')}/{r['folder']}" for r in written]
