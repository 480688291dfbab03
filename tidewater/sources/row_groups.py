"""A user-defined source with checkpointed offsets: the row groups of a
Parquet table as a stream.

The offset is the number of row groups handed on, of the table's files in the
order of their modification time and name; files may be added, not changed.
Spark stores the offsets with the query, so a restarted query goes on at the
first row group that it has not committed.  Each row group is a partition of
its own and is read as Arrow batches by the task that gets it; the driver
reads file footers only, one per new file.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class RowGroup(InputPartition):
    def __init__(self, path: str, group: int):
        super().__init__(None)
        self.path, self.group = path, group


class RowGroupReader(DataSourceStreamReader):
    def __init__(self, uri: str, columns: list[str]):
        self.uri, self.columns = uri, columns
        self.groups_of: dict[str, int] = {}       # footers read so far

    def _open(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.uri) if "://" in self.uri or self.uri.startswith("file:") \
            else (fs.LocalFileSystem(), self.uri)

    def _groups(self) -> list[RowGroup]:
        import pyarrow.parquet as pq
        from pyarrow import fs
        system, path = self._open()
        info = system.get_file_info(path)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        files = sorted((f.mtime_ns or 0, f.path) for f in found
                       if f.is_file and f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")))
        for _, f in files:
            if f not in self.groups_of:
                with system.open_input_file(f) as src:
                    self.groups_of[f] = pq.ParquetFile(src).num_row_groups
        return [RowGroup(f, g) for _, f in files for g in range(self.groups_of[f])]

    def initialOffset(self) -> dict:
        return {"groups": 0}

    def latestOffset(self) -> dict:
        return {"groups": len(self._groups())}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        return self._groups()[start["groups"]:end["groups"]]

    def read(self, partition: RowGroup) -> Iterator:
        import pyarrow.parquet as pq
        system, _ = self._open()
        with system.open_input_file(partition.path) as src:
            for batch in pq.ParquetFile(src).iter_batches(row_groups=[partition.group], columns=self.columns):
                yield batch.select(self.columns)

    def commit(self, end: dict) -> None:
        pass


class RowGroupSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "row_groups"

    def streamReader(self, schema) -> RowGroupReader:
        return RowGroupReader(self.options["path"], schema.fieldNames())


def read_row_groups(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stream of the rows of a Parquet table; ``schema`` names the columns
    that are read."""
    spark.dataSource.register(RowGroupSource)
    return spark.readStream.format("row_groups").schema(schema).option("path", path).load()


def run_until_read(stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet") -> str:
    """Append what the source has now to files and stop."""
    q = (stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
         .option("path", out_path).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return out_path
