"""One delimited file out of parts that are written side by side and joined by the file system."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from impressa.session import delete_at_end, scratch_path
from impressa.sources.schemas import FIELD_SEPARATOR

_CHUNK = 1 << 22


def _parts(df: DataFrame, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the written parts in the order of the rows."""
    target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).listStatus(target)
    sized = [(f.getPath().toString(), f.getLen()) for f in files if f.getPath().getName().startswith("part-")]
    return sorted(part for part in sized if part[1])


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if "://" in path or path.startswith("file:") else path


def _copy_parts(target: str):
    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size, start in batch.itertuples(index=False):
                out = os.open(target, os.O_WRONLY)
                try:
                    with open(_local(path), "rb") as part:
                        at = start
                        while chunk := part.read(_CHUNK):
                            view = memoryview(chunk)
                            while view:
                                done = os.pwrite(out, view, at)
                                view, at = view[done:], at + done
                    if at != start + size:
                        raise OSError(f"{path} changed while it was copied")
                    os.fsync(out)
                finally:
                    os.close(out)
            yield batch[["size"]]

    return copy


def write_one_file(df: DataFrame, path: str, sep: str = FIELD_SEPARATOR, header: bool = True) -> None:
    """Write ``df`` as the single file ``path``, rows in the order of its partitions.

    Every task writes its part; then the parts become one file: on a file system that joins files by
    their blocks (HDFS) in place, on a shared folder by tasks that each copy one part to its own place in
    the file. A copy that is repeated after a lost executor writes the same bytes again. The file appears
    under its name when it is whole. Elsewhere (object stores) this is refused: keep the parts there.
    Column names are the first line if ``header``; an empty table gives that line, or an empty file.
    """
    spark = df.sparkSession
    folder, hadoop = scratch_path(spark), spark._jvm.org.apache.hadoop.fs
    delete_at_end(spark, folder)
    options = {"sep": sep, "header": False}
    if sep == FIELD_SEPARATOR:
        options |= {"quote": "", "emptyValue": ""}
    df.write.options(**options).csv(f"{folder}/rows")
    names = spark.createDataFrame([tuple(df.columns)], [f"c{i}" for i in range(len(df.columns))])
    if header:
        names.write.options(**options).csv(f"{folder}/names")
    parts = (_parts(df, f"{folder}/names") if header else []) + _parts(df, f"{folder}/rows")
    final = hadoop.Path(path)
    system = final.getFileSystem(spark._jsc.hadoopConfiguration())
    growing = hadoop.Path(final.getParent(), f".{final.getName()}.{os.path.basename(folder)}")
    scheme = system.getScheme()
    if scheme in ("hdfs", "viewfs"):
        system.create(growing, True).close()
        if parts:
            sources = spark.sparkContext._gateway.new_array(hadoop.Path, len(parts))
            for i, (part, _) in enumerate(parts):
                sources[i] = hadoop.Path(part)
            system.concat(growing, sources)
    elif scheme == "file":
        # Without the checksum file of an empty file beside it.
        system.getRaw().create(growing, True).close()
        if parts:
            _copy_side_by_side(df, parts, _local(growing.toString()))
    else:
        raise ValueError(f"files cannot be joined on {scheme}: {path}")
    if system.exists(final):
        system.delete(final, False)
    if not system.rename(growing, final):
        raise OSError(f"{growing.toString()} could not be renamed to {path}")


def _copy_side_by_side(df: DataFrame, parts: list[tuple[str, int]], target: str) -> None:
    """Copies of the parts to their places, a task for each few of them; the list has a row a part."""
    starts, at = [], 0
    for _, size in parts:
        starts.append(at)
        at += size
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(p, size, start) for (p, size), start in zip(parts, starts, strict=True)],
        "path string, size bigint, start bigint",
    )
    copied = table.repartition(min(len(parts), 1000)).mapInPandas(_copy_parts(target), "size bigint")
    if copied.agg(F.sum("size")).first()[0] != at:
        raise OSError(f"{target} is not whole")
