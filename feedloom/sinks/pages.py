"""Page snapshots as files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.sources.pages import snapshot_name

SAVED = "file_name string, size bigint, problem string"


def save_snapshots(pages: DataFrame, folder: str, url: Column, captured_at: Column, html: str = "html") -> DataFrame:
    """One HTML file per page in the folder, named by address and time; gives a row per file.

    Files are written by the tasks, wherever the folder is, when the result is used. A page that
    cannot be written is reported and does not stop the rest. Pages of one name would overwrite one another: they are
    found beforehand (names alone are counted), reported and not written; give them times that differ. A repeated task
    writes the same files again.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        for batch in batches:
            sizes, problems = [], []
            for name, text, times in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                content = (text or "").encode()
                if times:
                    sizes.append(0)
                    problems.append(f"{times} pages have this name")
                    continue
                try:
                    with target.open_output_stream(f"{root}/{name}") as out:
                        out.write(content)
                    sizes.append(len(content))
                    problems.append("")
                except OSError as error:
                    sizes.append(0)
                    problems.append(str(error))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(problems, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["file_name", "size", "problem"])

    named = pages.select(snapshot_name(url, captured_at).alias("file_name"), F.col(html).alias("html"))
    counts = named.groupBy(F.col("file_name").alias("name")).agg(F.count("*").alias("times")).where("times > 1")
    checked = named.join(counts, F.col("file_name") == F.col("name"), "left").select("file_name", "html", "times")
    return checked.mapInArrow(save, SAVED)
