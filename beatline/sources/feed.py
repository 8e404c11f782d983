"""A table of changes that grows by deliveries, and the stream of its changes in the order of the cursor.

A delivery is a folder of Parquet files, complete once its ``_SUCCESS`` file is there.  Beside the columns of the records
the files hold the place of each record in the order of changes (see ``sources.changes``) as plain columns, and their
rows are in that order, so that footers tell which row groups a range of changes is in.
"""

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from beatline.sources.changes import keys

PLACE = ["_micros", "_kind", "_number", "_text"]
# Kinds of IDs in their order: a number, none, a text.
_NUMBER, _MISSING, _TEXT = 0, 1, 2
# The place before every record.
_START = {"micros": -(2**62), "kind": 0, "number": 0, "text": ""}


def append_changes(records: DataFrame, path: str) -> str:
    """Add the records that have a change time as one delivery, whose folder is returned.

    A stream has gone on to the last change that it saw, so a delivery should hold no older ones; records that may come late
    belong into ``run_increment`` with a lookback.
    """
    moment, place = keys(records)
    kind = F.when(~place["other"], _NUMBER).when(place["text"] == "", _MISSING).otherwise(_TEXT)
    placed = records.select(
        *(F.col(f"`{c}`") for c in records.columns),
        F.unix_micros(moment).alias("_micros"),
        kind.alias("_kind"),
        F.coalesce(place["number"], F.lit(0)).alias("_number"),
        F.coalesce(place["text"], F.lit("")).alias("_text"),
    ).where(F.col("_micros").isNotNull())
    folder = f"{path}/delivery-{uuid.uuid4().hex}"
    placed.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE).write.parquet(folder)
    return folder


def stream_changes(spark: SparkSession, path: str) -> DataFrame:
    """The records of all deliveries, those there and those to come, as an unbounded table.

    A micro-batch is what lies between two places in the order of changes; the checkpoint of the query keeps the
    places, so that a restart repeats nothing and skips nothing.
    """
    spark.dataSource.register(ChangeFeed)
    stored = spark.read.option("recursiveFileLookup", "true").parquet(path).drop(*PLACE).schema
    return spark.readStream.format(ChangeFeed.name()).schema(stored).load(path)


class ChangeFeed(DataSource):
    """The feed for ``readStream``; its schema is that of the records, given by the reader."""

    @classmethod
    def name(cls) -> str:
        return "incident_changes"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _FeedReader(self.options["path"], schema.names)


class _RowGroups(InputPartition):
    def __init__(self, file: str, groups: list[int], start: dict, end: dict) -> None:
        self.file, self.groups, self.start, self.end = file, groups, start, end


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def _after(rows: pa.Table, place: dict) -> pa.Array:
    """Which rows come after the place."""
    found = pc.greater(rows["_text"], place["text"])
    for column, value in (("_number", place["number"]), ("_kind", place["kind"]), ("_micros", place["micros"])):
        found = pc.or_(pc.greater(rows[column], value), pc.and_(pc.equal(rows[column], value), found))
    return found


class _FeedReader(DataSourceStreamReader):
    """Places as offsets.  The driver reads footers, each once, and the place columns of the row groups of the last moment."""

    def __init__(self, path: str, columns: list[str]) -> None:
        self.path, self.columns = path, columns
        self.known: dict[str, list[tuple[int, int]]] = {}

    def initialOffset(self) -> dict:
        return dict(_START)

    def _look(self) -> None:
        """Add the files of deliveries that were completed since, with the least and greatest time of each row group."""
        files, root = _open(self.path)
        for delivery in files.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            inside = files.get_file_info(pafs.FileSelector(delivery.path)) if delivery.is_file is False else []
            if not any(f.base_name == "_SUCCESS" for f in inside):
                continue
            for f in inside:
                if f.base_name.endswith(".parquet") and f.path not in self.known:
                    with files.open_input_file(f.path) as source:
                        self.known[f.path] = _bounds(pq.ParquetFile(source))

    def latestOffset(self) -> dict:
        self._look()
        last = max((high for groups in self.known.values() for _, high in groups), default=None)
        if last is None:
            return dict(_START)
        place = dict(_START)
        files, _ = _open(self.path)
        for name, groups in self.known.items():
            wanted = [i for i, (_, high) in enumerate(groups) if high == last]
            if wanted:
                with files.open_input_file(name) as source:
                    rows = pq.ParquetFile(source).read_row_groups(wanted, columns=PLACE)
                ends = rows.filter(_after(rows, place)).sort_by([(c, "descending") for c in PLACE])
                if len(ends):
                    values = ends.slice(0, 1).to_pylist()[0]
                    place = {key: values[f"_{key}"] for key in _START}
        return place

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self._look()
        found = []
        for name, groups in self.known.items():
            wanted = [i for i, (low, high) in enumerate(groups) if high >= start["micros"] and low <= end["micros"]]
            found += [_RowGroups(name, [group], start, end) for group in wanted]
        return found

    def read(self, partition: _RowGroups) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.path)
        with files.open_input_file(partition.file) as source:
            rows = pq.ParquetFile(source).read_row_groups(partition.groups, columns=[*self.columns, *PLACE])
        wanted = pc.and_(_after(rows, partition.start), pc.invert(_after(rows, partition.end)))
        yield from rows.filter(wanted).select(self.columns).to_batches(max_chunksize=10_000)

    def commit(self, end: dict) -> None:
        """Nothing to do: the checkpoint keeps the place."""


def _bounds(file: pq.ParquetFile) -> list[tuple[int, int]]:
    """Least and greatest change time of each row group."""
    column = file.schema_arrow.names.index("_micros")
    groups = [file.metadata.row_group(i) for i in range(file.metadata.num_row_groups)]
    # place columns are plain, so their number among the leaves is found by path
    leaves = [groups[0].column(i).path_in_schema for i in range(groups[0].num_columns)] if groups else []
    leaf = leaves.index("_micros") if "_micros" in leaves else column
    return [(g.column(leaf).statistics.min, g.column(leaf).statistics.max) for g in groups if g.num_rows]
