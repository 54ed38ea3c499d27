"""Token ids in Arrow files of fixed-size lists.

Documents are tokenized in ascending id order and their ids form one stream, cut into files (one per
task), each an Arrow file of record batches with two columns: ``ids``, fixed-size lists of ``width``
unsigned integers, and ``mask``, as many packed bits, 0 where the last sequence of a file is padded.
All sequences have the same length, so sequence i of a file is batch ``i // rows``, row ``i % rows``:
memory-mapped files give views on it without a copy. A table beside the files says where each
document lies.

The text is shuffled once, by ranges of the id. A file is written under a name of the attempt and
then moved to its final name, so a task that runs again replaces its file by an equal one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.bpe import encoder
from loamline.llm.tables import slices
from loamline.rows import local_frame

WIDTH = 2048
ROWS = 256


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share; local paths need no scheme."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Appends ids to one Arrow file of equal-length sequences."""

    def __init__(self, sink, dtype, width: int = WIDTH, rows: int = ROWS):
        if width % 8:
            raise ValueError("the width must be a multiple of 8")
        self.dtype, self.width, self.rows = dtype, width, rows
        value = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(value, width)), ("mask", pa.list_(pa.uint8(), width // 8))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.parts: list[bytes] = []
        self.held = self.total = 0

    def append(self, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.parts.append(ids)
        self.held += n
        self.total += n
        if self.held >= self.width * self.rows:
            self._write(False)

    def _write(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.parts), self.dtype)
        block = self.width * self.rows
        at = 0
        while len(ids) - at >= block:
            self._batch(ids[at : at + block], block)
            at += block
        rest = ids[at:]
        if last and len(rest):
            padded = np.zeros(-(-len(rest) // self.width) * self.width, self.dtype)
            padded[: len(rest)] = rest
            self._batch(padded, len(rest))
            rest = rest[:0]
        self.parts, self.held = [rest.tobytes()], len(rest)

    def _batch(self, ids, used: int) -> None:
        mask = np.packbits(np.arange(len(ids)) < used)
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), field.type.list_size)
            for values, field in zip((ids, mask), self.schema)
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        self._write(True)
        self.writer.close()


class SequenceReader:
    """Views on the sequences of one file; local files are mapped, not read."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        source = pa.memory_map(path) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.width = self.reader.schema.field("ids").type.list_size
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1

    def batch(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask bits of batch i, a row per sequence."""
        got = self.reader.get_batch(i)
        ids, mask = (got.column(k).flatten().to_numpy(zero_copy_only=True) for k in (0, 1))
        return ids.reshape(-1, self.width), mask.reshape(-1, self.width // 8)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        ids, mask = self.batch(i // self.rows)
        return ids[i % self.rows], np.unpackbits(mask[i % self.rows]).astype(bool)

    def span(self, start: int, n: int) -> np.ndarray:
        """n ids from place ``start`` of the file's stream."""
        block = self.width * self.rows
        parts = []
        while n > 0:
            ids = self.batch(start // block)[0].reshape(-1)
            part = ids[start % block : start % block + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, "<u2")


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    width: int = WIDTH,
    rows: int = ROWS,
) -> DataFrame:
    """Writes the files and returns where each document lies: id, file, position, n_tokens.

    ``position`` counts the file's ids before the document. The returned frame runs the writing
    whenever it is evaluated; write it once. Null ids come first; null text is empty; repeated rows
    are documents of their own, in any order among themselves. An empty table writes no file.
    """
    plain = docs.select(docs[id_col].alias("id"), docs[text].alias("text"))
    schema = f"`{id_col}` {plain.schema['id'].dataType.simpleString()}, file string, position long, n_tokens long"

    def run(batches):
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.arrow"
        system, path = file_system(folder)
        trial = f"{path}/.{name}.{context.taskAttemptId()}"
        tokens, writer, sink = encoder(tokenizer), None, None
        end = np.array([end_id], tokens.dtype).tobytes()
        for batch in batches:
            if writer is None and batch.num_rows:
                system.create_dir(path, recursive=True)
                sink = system.open_output_stream(trial)
                writer = SequenceWriter(sink, tokens.dtype, width, rows)
            for part in slices(batch, 500):
                places, sizes = [], []
                for ids in tokens.encode(part.column(1).to_pylist()):
                    places.append(writer.total)
                    writer.append(ids + end)
                    sizes.append(writer.total - places[-1])
                names = pa.array([name] * part.num_rows)
                columns = [part.column(0), names, pa.array(places, pa.int64()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "file", "position", "n_tokens"])
        if writer is not None:
            writer.close()
            sink.close()
            system.move(trial, f"{path}/{name}")

    return plain.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(run, schema)


def with_starts(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before it. One number per file passes the driver."""
    totals = sorted(index.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    before, sums = 0, []
    for name, n in totals:
        sums.append((name, before))
        before += n
    starts = local_frame(spark, sums, "file string, file_start long")
    return index.join(F.broadcast(starts), "file").withColumn("start", F.col("file_start") + F.col("position"))


def read_token_files(index: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Adds ``ids`` (little-endian unsigned 32 bit) to each row of the index, read from the files."""
    kind = index.schema[id_col].dataType.simpleString()
    wanted = index.select(id_col, "file", "position", "n_tokens", "start")
    schema = f"`{id_col}` {kind}, file string, position long, n_tokens long, start long, ids binary"

    def run(batches):
        name, reader = None, None
        for batch in batches:
            for part in slices(batch, 500):
                out = []
                for file, position, n in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                    if file != name:
                        name, reader = file, SequenceReader(f"{folder}/{file}")
                    out.append(reader.span(position, n).astype("<u4").tobytes())
                columns = [*part.columns, pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "ids"])

    files = index.select("file").distinct().count()
    by_file = wanted.repartition(max(1, files), "file").sortWithinPartitions("file", "position")
    return by_file.mapInArrow(run, schema)
