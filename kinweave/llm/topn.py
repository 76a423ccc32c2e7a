"""Best N rows of every group, reading only the row groups that can still matter.

The rows are written once to the shared folder, clustered by group and sorted inside a file
by group and score, in small row groups whose footers hold the statistics. A second job
takes the row groups of each file in the order of their best score and leaves out those
that hold one group only and are strictly worse than that group's N-th row so far. Groups
with many rows are spread over several files, copies of one row among them; what the files
keep of a group is merged last, where copies that met in no file become one.

Footers are read by Arrow. Where the shared folder is in a store that Arrow cannot open, the
clustered table is read whole by Spark instead; the result is the same.

Defined results: rows that lack a part of group, score or tie rule (null or NaN) are left out; copies of
a row count once; ties are broken by the columns in ``ties`` and so never by chance; groups
with fewer than N rows are returned whole; an empty table has no groups.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators.skew import hot_values, salt
from kinweave.session import shared_dir, width

#: Files that a group with many rows is spread over, and rows in a row group.
SALTS, ROW_GROUP = 32, 4096


#: Schemes that Arrow opens, some under another name than Hadoop's.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def arrow_uri(path: str) -> str | None:
    """``path`` as Arrow names it, or None if Arrow cannot open its store."""
    scheme, found, rest = path.partition(":")
    if not found:
        return path
    return f"{_SCHEMES[scheme]}:{rest}" if scheme in _SCHEMES else None


def cluster(rows: DataFrame, group: list[str], score: list[str], ties: list[str]) -> str:
    """Writes the rows clustered by group, and returns the folder.

    Rows of a hot group follow the hash of the row and of the task that read it, so that many
    copies of one row do not meet in one task either."""
    spark = rows.sparkSession
    entity = F.xxhash64(*group)
    hot = hot_values(rows, entity)
    own = F.xxhash64(F.col(ties[-1]), F.spark_partition_id())
    spread = salt(entity, hot, own, SALTS) - F.when(entity.isin(hot), 0).otherwise(1) if hot else F.lit(-1)
    path = shared_dir(spark, "clustered")
    (
        rows.withColumn("_salt", spread.cast("int"))
        .repartition(max(width(spark), 2), *group, "_salt")
        .dropDuplicates([*group, "_salt", *score, *ties])
        .sortWithinPartitions(*group, "_salt", *score, *ties)
        .write.option("parquet.block.row.count.limit", ROW_GROUP)
        .option("parquet.page.row.count.limit", ROW_GROUP)
        .option("compression", "zstd")
        .parquet(path)
    )
    return path


def _reader(paths: list[str], n: int, group: list[str], score: list[str]):
    """For mapInArrow over file numbers: the first N rows of each group in each row group read."""

    def bound(meta, at: dict[str, int], name: str):
        stats = meta.column(at[name]).statistics
        return (stats.min, stats.max) if stats is not None and stats.has_min_max else None

    def one_file(path: str) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem

        store, inner = FileSystem.from_uri(path)
        with store.open_input_file(inner) as handle:
            file = pq.ParquetFile(handle)
            at = {name: i for i, name in enumerate(file.schema_arrow.names)}
            keys, blocks = [*group, "_salt"], []
            for i in range(file.num_row_groups):
                meta = file.metadata.row_group(i)
                span, best = [bound(meta, at, k) for k in keys], [bound(meta, at, s) for s in score]
                only = tuple(s[0] for s in span) if all(s is not None and s[0] == s[1] for s in span) else None
                blocks.append((tuple(b[0] for b in best) if all(best) else (), only, i))
            nth: dict[tuple, list[tuple]] = {}  # best N scores so far, of groups that reach the edge of a row group
            for best, only, i in sorted(blocks, key=lambda b: (b[0], b[2])):
                if only is not None and best and len(nth.get(only, ())) == n and best > nth[only][-1]:
                    continue
                data = file.read_row_group(i)
                size = data.num_rows
                change = np.zeros(size, bool)
                change[:1] = True
                for k in keys:
                    column = data[k].combine_chunks()
                    change[1:] |= pc.not_equal(column.slice(1), column.slice(0, size - 1)).to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(change)
                position = np.arange(size) - np.repeat(starts, np.diff(np.append(starts, size)))
                for begin in {int(starts[0]), int(starts[-1])}:
                    later = starts[np.searchsorted(starts, begin, "right") :]
                    end = min(int(later[0]) if len(later) else size, begin + n)
                    edge = data.slice(begin, end - begin)
                    who = tuple(edge[k][0].as_py() for k in keys)
                    scores = list(zip(*[edge[s].to_pylist() for s in score], strict=True))
                    nth[who] = sorted(nth.get(who, []) + scores)[:n]
                kept = data.filter(pa.array(position < n)).drop_columns(["_salt"])
                yield from kept.to_batches()

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from one_file(paths[i])

    return read


def top_n(rows: DataFrame, n: int, group: list[str], score: list[str], ties: list[str]) -> DataFrame:
    """The N rows of each ``group`` with the smallest ``score``, then the smallest ``ties``.

    ``ties`` ends with the column that identifies a row. Returns group, score, ties, rank."""
    columns = [*group, *score, *ties]
    whole = rows.select(*columns).dropna()
    path = cluster(whole, group, score, ties)
    spark = rows.sparkSession
    table = spark.read.parquet(path)
    paths = [arrow_uri(p) for p in sorted(table.inputFiles())]
    kept = table.select(*columns)
    if paths and all(paths):
        schema = table.select(*[c for c in table.columns if c != "_salt"]).schema
        files = spark.range(0, len(paths), 1, len(paths))
        kept = files.mapInArrow(_reader(paths, n, group, score), schema).select(*columns)
    once = kept.repartition(*group).dropDuplicates()  # at most N rows of a group and file
    order = Window.partitionBy(*group).orderBy(*score, *ties)
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
