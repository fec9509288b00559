"""Token ids of whole texts in Arrow files of fixed-size-list batches.

Documents are put in ascending ``doc_id`` order by a range partitioning.
Every partition writes two Arrow files into one shared folder:

* ``<name>.tokens``: one row per sequence of ``length`` ids with its mask
  (fixed-size lists of ``uint16``, ``uint32`` for vocabularies over 65,536
  ids, and of bits), the partition's ids one after the other, only the last sequence padded (mask 0). Rows all
  have one size, so id ``i`` lies at row ``i // length`` and a memory map
  gives it without a copy.
* ``<name>.index``: ``doc_id, start, n_tokens`` inside the partition.

A task attempt writes files of its own name and reports that name, so only
whole files of attempts that counted are read. Only one row per partition (its number
of ids) is added up to turn starts into global ones.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .encoder import encoder

SEQUENCE = 1024
#: Sequences per record batch: 4 MB of ids.
BATCH_ROWS = 1024


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder that Spark names. Spark's s3a and
    s3n are Arrow's s3, dbfs is mounted on every machine; file, s3, gs, hdfs,
    viewfs and abfs(s) go to Arrow as they are."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), uri
    if scheme == "dbfs":
        return pafs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    elif scheme not in ("file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss", "mock"):
        raise ValueError(f"Arrow can't write to {scheme}: folders; set spark.checkpoint.dir to file, s3a, gs, hdfs, abfss or dbfs")
    return pafs.FileSystem.from_uri(uri)


class TokenWriter:
    """Appends id arrays to one token file; memory holds one batch."""

    def __init__(self, sink, length: int, dtype: type):
        self.length, self.left, self.held, self.dtype = length, [], 0, dtype
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.left.append(ids.astype(self.dtype))
        self.held += len(ids)
        while self.held >= self.length * BATCH_ROWS:  # all batches but the last have one size
            self._write(self.length * BATCH_ROWS)

    def _write(self, n: int, pad: int = 0) -> None:
        flat = np.concatenate(self.left) if self.left else np.zeros(0, self.dtype)
        self.left, self.held = [flat[n:]], len(flat) - n
        flat = np.concatenate([flat[:n], np.zeros(pad, self.dtype)])
        mask = np.ones(len(flat), bool)
        mask[n:] = False
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._write(self.held, -self.held % self.length)
        self.writer.close()


def write_token_files(docs: DataFrame, folder: str, path: str, keeps_space: bool, end_id: int,
                      length: int = SEQUENCE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write the files; one row per partition: part, n_ids, n_docs, name.

    Ties in ``doc_id`` are ordered by text, a null ``doc_id`` comes first, a
    null or empty text has its end id alone. Lazy: each run of the result
    writes the files once more."""
    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = encoder(path, keeps_space), TaskContext.get().partitionId()
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        mine = uuid.uuid4().hex
        names, starts, counts, total = [], [], [], 0
        with fs.open_output_stream(f"{base}/{mine}.tokens") as sink:
            writer = TokenWriter(sink, length, np.uint16 if codec.vocabulary <= 1 << 16 and end_id < 1 << 16 else np.uint32)
            for rb in batches:
                names += rb.column(0).to_pylist()
                for _, ids, bounds in codec.encode(rb.column(1), end_id):
                    writer.add(ids)
                    starts.append(bounds[:-1] + total)
                    counts.append(np.diff(bounds))
                    total += len(ids)
            writer.close()
        if not names:
            fs.delete_file(f"{base}/{mine}.tokens")
            return
        index = pa.table({"doc_id": pa.array(names, pa.int64()), "start": np.concatenate(starts),
                          "n_tokens": np.concatenate(counts)})
        with fs.open_output_stream(f"{base}/{mine}.index") as sink, pa.ipc.new_file(sink, index.schema) as w:
            w.write_table(index, max_chunksize=1 << 16)
        yield pa.record_batch({"part": pa.array([part], pa.int32()), "n_ids": pa.array([total], pa.int64()),
                               "n_docs": pa.array([len(names)], pa.int64()), "name": pa.array([mine])})

    ordered = (docs.select(id_column, text_column)
               .repartitionByRange(id_column).sortWithinPartitions(id_column, text_column))
    return ordered.mapInArrow(partition, "part int, n_ids bigint, n_docs bigint, name string")


def read_token_files(spark: SparkSession, parts: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of the files named by ``parts`` (part, n_ids): doc_id, global
    start, n_tokens, ids_crc32 (and the ids). Files are memory-mapped where
    the folder is local, and read by batch elsewhere."""
    base_rows = parts.select("name", (F.sum("n_ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("base"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        local = isinstance(fs, pafs.LocalFileSystem)

        def source(name):
            return pa.memory_map(name) if local else fs.open_input_file(name)

        for rb in batches:
            for name, before in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                tokens = pa.ipc.open_file(source(f"{base}/{name}.tokens"))
                index = pa.ipc.open_file(source(f"{base}/{name}.index"))
                length = tokens.schema.field("ids").type.list_size
                cursor = _Cursor(tokens, length)
                for j in range(index.num_record_batches):
                    ib = index.get_batch(j)
                    starts, counts = ib.column(1).to_numpy(), ib.column(2).to_numpy()
                    crcs, texts = [], []
                    for a, n in zip(starts.tolist(), counts.tolist()):
                        crc, pieces = 0, []
                        for x in cursor.slices(a, n):
                            crc = zlib.crc32(x.astype("<u4").tobytes(), crc)
                            if with_ids:
                                pieces.append(x)
                        crcs.append(crc)
                        if with_ids:
                            texts.append(np.concatenate(pieces).astype(np.int64))
                    cols = [ib.column(0), pa.array(starts + (before or 0)), pa.array(counts), pa.array(crcs, pa.int64())]
                    if with_ids:
                        cols.append(pa.array(texts, pa.list_(pa.int64())))
                    yield pa.record_batch(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    # about one file a task: a number that is given is not merged again
    spread = base_rows.repartition(max(parts.count(), 1), "name")
    return spread.mapInArrow(read, schema)


class _Cursor:
    """Ids at any place of a token file, a record batch at a time."""

    def __init__(self, tokens: pa.ipc.RecordBatchFileReader, length: int):
        self.tokens, self.length, self.at, self.ids = tokens, length, -1, None

    def slices(self, start: int, n: int) -> Iterator[np.ndarray]:
        size = self.length * BATCH_ROWS
        at, skip = divmod(start, size)
        while n > 0:
            if at != self.at:
                batch = self.tokens.get_batch(at)
                self.ids = batch.column(0).flatten().to_numpy()
                self.at = at
            piece = self.ids[skip:skip + n]
            yield piece
            n -= len(piece)
            at, skip = at + 1, 0


def token_files(spark: SparkSession, docs: DataFrame, path: str, keeps_space: bool, end_id: int,
                folder: str | None = None, length: int = SEQUENCE) -> DataFrame:
    """Write the documents' token files and read the documents back from them.

    The folder is a fresh one under the shared checkpoint folder unless given.
    An empty table writes no file and gives no rows."""
    folder = folder or scratch_dir(spark, "tokens")
    # the written parts are a table of their own: reading it never writes again
    write_token_files(docs, folder, path, keeps_space, end_id, length).write.parquet(f"{folder}/parts")
    return read_token_files(spark, spark.read.parquet(f"{folder}/parts"), folder)
