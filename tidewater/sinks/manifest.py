"""A transactional stream sink: Parquet files that count only once a manifest
names them.

Every task writes its rows to a file of its own and reports its name and
number of rows to the driver.  When all tasks of a micro-batch have succeeded,
``commit`` writes the batch's manifest in one step; readers take the files of
manifests and nothing else, so a task that was killed midway, a second attempt
or an aborted batch leaves no visible row.  A replayed batch whose manifest is
there keeps it: its new files are removed.

Every ``MERGE`` batches the manifests are merged into one; the ones it replaces
stay for the next ``MERGE`` batches, as a reader may have listed them.  Files
that no manifest names are removed at the same time, once they are older than
``GRACE_S`` -- a lost attempt may still be writing a young one.  So there are at
most ``2 * MERGE`` small manifests, and dead files do not pile up.

The driver holds names and row counts of the files, never rows.  Tables go to
any store that Arrow opens by its URI.

Cases: an empty micro-batch has a manifest without files; a task without rows
writes no file; a table without manifests reads as empty.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

MERGE = 16
GRACE_S = 24 * 3600.0


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class Place:
    """A table's folder: ``data/`` has the files, ``manifests/`` the batches."""

    def __init__(self, uri: str):
        from pyarrow import fs
        self.fs, self.path = fs.FileSystem.from_uri(uri) if re.match(r"[a-z0-9+.-]+:", uri) else (fs.LocalFileSystem(), uri)
        self.data, self.manifests = f"{self.path}/data", f"{self.path}/manifests"

    def create(self) -> None:
        for folder in (self.data, self.manifests):
            self.fs.create_dir(folder, recursive=True)

    def _listed(self, folder: str):
        from pyarrow import fs
        return [f for f in self.fs.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.is_file]

    def _put(self, name: str, content: dict) -> None:
        """Written under another name first: a manifest is whole or not there."""
        draft = f"{self.manifests}/_{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            out.write(json.dumps(content).encode())
        self.fs.move(draft, f"{self.manifests}/{name}")

    def _get(self, name: str) -> dict:
        with self.fs.open_input_stream(f"{self.manifests}/{name}") as src:
            return json.loads(src.read())

    def batches(self) -> tuple[list[int], list[int]]:
        """Numbers of the single and of the merged manifests, ascending."""
        names = [f.base_name for f in self._listed(self.manifests)]
        of = lambda kind: sorted(int(n.split("-")[1]) for n in names if n.startswith(f"{kind}-"))
        return of("batch"), of("merged")

    def live(self) -> list[tuple[str, int]]:
        """(file, rows) of every committed file."""
        single, merged = self.batches()
        upto = merged[-1] if merged else -1
        parts = [self._get(f"merged-{upto}")] if merged else []
        parts += [self._get(f"batch-{b}") for b in single if b > upto]
        return [(f, n) for part in parts for f, n in part["files"]]

    def has(self, batch: int) -> bool:
        single, merged = self.batches()
        return batch in single or bool(merged and batch <= merged[-1])

    def remove(self, files) -> None:
        for f in files:
            if self.fs.get_file_info(f"{self.data}/{f}").is_file:
                self.fs.delete_file(f"{self.data}/{f}")

    def commit(self, batch: int, files: list[tuple[str, int]], grace_s: float = GRACE_S) -> None:
        if self.has(batch):
            self.remove([f for f, _ in files])
            return
        self._put(f"batch-{batch}", {"files": files})
        if batch % MERGE == MERGE - 1:
            self._put(f"merged-{batch}", {"files": self.live()})
            self.clean(grace_s)

    def clean(self, grace_s: float = GRACE_S) -> None:
        """Remove the manifests that were merged before the last time and the
        old files that no manifest names."""
        single, merged = self.batches()
        if len(merged) > 1:
            for name in [f"batch-{b}" for b in single if b <= merged[-2]] + [f"merged-{b}" for b in merged[:-2]]:
                self.fs.delete_file(f"{self.manifests}/{name}")
        named, before = {f for f, _ in self.live()}, time.time() - grace_s
        for folder in (self.data, self.manifests):
            for f in self._listed(folder):
                dead = f.base_name not in named if folder == self.data else f.base_name.startswith("_")
                if dead and f.mtime_ns / 1e9 < before:
                    self.fs.delete_file(f.path)


class ManifestWriter(DataSourceStreamArrowWriter):
    def __init__(self, uri: str, grace_s: float):
        self.uri, self.grace_s = uri, grace_s
        Place(uri).create()

    def write(self, iterator: Iterator) -> Written:
        import pyarrow.parquet as pq
        place, name, rows, out = Place(self.uri), f"{uuid.uuid4().hex}.parquet", 0, None
        sink = None
        try:
            for batch in iterator:
                if batch.num_rows:
                    if out is None:
                        sink = place.fs.open_output_stream(f"{place.data}/{name}")
                        out = pq.ParquetWriter(sink, batch.schema)
                    out.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
                sink.close()
        return Written([(name, rows)] if rows else [])

    def commit(self, messages: list, batchId: int) -> None:
        Place(self.uri).commit(batchId, [f for m in messages if m for f in m.files], self.grace_s)

    def abort(self, messages: list, batchId: int) -> None:
        Place(self.uri).remove([f for m in messages if m for f, _ in m.files])


class ManifestSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "manifest"

    def streamWriter(self, schema, overwrite: bool) -> ManifestWriter:
        return ManifestWriter(self.options["path"], float(self.options.get("grace_s", GRACE_S)))


def write_manifest_table(stream: DataFrame, path: str, checkpoint: str, grace_s: float = GRACE_S, **trigger) -> StreamingQuery:
    """Start appending a stream to the table at ``path``."""
    stream.sparkSession.dataSource.register(ManifestSink)
    return (stream.writeStream.format("manifest").outputMode("append").option("path", path).option("grace_s", grace_s)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def read_manifest_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The committed rows."""
    files = [f"{path.rstrip('/')}/data/{f}" for f, _ in Place(path).live()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
