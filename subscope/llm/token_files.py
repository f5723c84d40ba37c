"""Token ids in Arrow IPC files: equal-length sequences with masks, read in place from any offset.

A file holds the documents of one range of keys, one after another, cut into sequences of a fixed
length. Every record batch has the same number of sequences but the last, so token ``t`` of a file is in
batch ``t // (rows * length)``, and a mapped file hands it out without copying. Beside each file a
second one lists its documents, and ``manifest`` lists the files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subscope.llm.encoding import encoder
from subscope.llm.spans import by_bytes

SEQUENCE = 2048  # tokens
ROWS = 64  # sequences in a record batch

_DOCS = pa.schema([("start", pa.int64()), ("n_tokens", pa.int64())])


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system a path or URI belongs to, as workers open it, and the path there."""
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark resolves it: without one, workers would take it for their own disk."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


class _Writer:
    """Takes ids as they come and writes full batches of sequences; the last is padded and masked."""

    def __init__(self, sink: pa.NativeFile, id_type: pa.DataType, length: int, rows: int):
        self.length, self.rows, self.held, self.size = length, rows, [], 0
        self.schema = pa.schema([
            ("tokens", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length)),
        ], metadata={"rows": str(rows)})
        self.out = pa.ipc.new_file(sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.size += len(ids)
        full = self.length * self.rows
        if self.size >= full:
            ids = np.concatenate(self.held)
            for at in range(0, len(ids) - full + 1, full):
                self._batch(ids[at : at + full], np.ones(full, bool))
            self.held = [ids[len(ids) // full * full :]]
            self.size = len(self.held[0])

    def _batch(self, ids: np.ndarray, mask: np.ndarray) -> None:
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids, self.schema.field("tokens").type.value_type), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ]
        self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.size:
            ids = np.concatenate(self.held)
            padded = np.zeros(-(-len(ids) // self.length) * self.length, ids.dtype)
            padded[: len(ids)] = ids
            self._batch(padded, np.arange(len(padded)) < len(ids))
        self.out.close()


class SequenceFile:
    """Random access to one file: sequences with masks, and runs of ids by token offset."""

    def __init__(self, path: str):
        store, at = filesystem(path)
        local = isinstance(store, pa.fs.LocalFileSystem)
        self.source = pa.memory_map(at) if local else store.open_input_file(at)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("tokens").type.list_size
        self.rows = int(self.reader.schema.metadata[b"rows"])
        self._last: tuple[int, pa.RecordBatch] | None = None

    def _get(self, i: int) -> pa.RecordBatch:
        if self._last is None or self._last[0] != i:
            self._last = (i, self.reader.get_batch(i))
        return self._last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``, as views of the file where it is mapped; a mask has a bit for each id."""
        batch, at = self._get(i // self.rows), i % self.rows * self.length
        tokens, mask = (batch.column(c).values.slice(at, self.length) for c in (0, 1))
        return tokens.to_numpy(), mask

    def runs(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, ``n`` in all, as views, one for each batch that holds some."""
        full = self.length * self.rows
        while n > 0:
            at = start % full
            got = self._get(start // full).column(0).values.to_numpy()[at : at + n]
            yield got
            start, n = start + len(got), n - len(got)


@dataclass(frozen=True)
class Stored:
    """A written set of files."""

    folder: str
    key: str

    def manifest(self, spark: SparkSession) -> DataFrame:
        """``file, part, n_docs, n_tokens, start``: start is the number of tokens in earlier files.

        One row for each file, so the running sum is over as many rows as tasks wrote.
        """
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        listed = spark.read.parquet(f"{self.folder}/manifest")
        return listed.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def documents(self, spark: SparkSession) -> DataFrame:
        """``key, start, n_tokens, ids_crc32`` of every document, read from the files."""
        key = self.key
        kind = spark.read.parquet(f"{self.folder}/manifest").schema["first"].dataType
        listed = self.manifest(spark).select("file", "start")
        files = listed.repartition(max(1, listed.count()), "file")  # a task for each file, however small the list

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for file, base in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                    yield from _documents(file, base)

        return files.mapInArrow(
            read, f"key {kind.simpleString()}, start long, n_tokens long, ids_crc32 long"
        ).withColumnRenamed("key", key)


def _documents(file: str, base: int) -> Iterator[pa.RecordBatch]:
    held = SequenceFile(file)
    store, at = filesystem(f"{file}.docs")
    for docs in pa.ipc.open_file(store.open_input_file(at)).read_all().to_batches(65536):
        sums = []
        starts, counts = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
        for start, n in zip(starts.tolist(), counts.tolist()):
            crc = 0
            for ids in held.runs(start, n):
                crc = zlib.crc32(ids.astype("<u4"), crc)
            sums.append(crc)
        yield pa.RecordBatch.from_arrays(
            [docs.column("key"), pa.array(starts + base), docs.column("n_tokens"), pa.array(sums, pa.int64())],
            names=["key", "start", "n_tokens", "ids_crc32"],
        )


def write_tokens(
    docs: DataFrame, tokenizer: str, folder: str, *, key: str = "doc_id", text: str = "text",
    end_id: int = 1, length: int = SEQUENCE, rows: int = ROWS,
) -> Stored:
    """Encode every text, append ``end_id`` to each and write the ids in ascending order of the key.

    Documents are dealt out by ranges of the key, and each task writes its range while it encodes, a
    batch of text at a time. Rows with equal keys follow one another, equal texts together, in as many
    files as they fill; a null key comes first. Null and empty texts are the end id alone. An empty table gives a manifest
    without files. A task that is run again writes a new file; the manifest names the one that counts.
    Ids are kept in 16 bits where the vocabulary allows it, else in 32. Only the two columns named are
    read. ``folder`` must be one that all executors reach.
    """
    largest = max(end_id, encoder(tokenizer).tokenizer.get_vocab_size() - 1)
    id_type = pa.uint16() if largest < 1 << 16 else pa.uint32()
    dealt = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dealt.schema["key"].dataType.simpleString()
    # a key that many rows have is dealt out by its texts, and a text that many have by its rows
    order = ["key", "hash", "row"]
    dealt = dealt.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    folder = qualified(docs.sparkSession, folder)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task, at, n_docs, first = encoder(tokenizer), TaskContext.get(), 0, 0, None
        out = None
        for batch in by_bytes(batches):
            if out is None:
                files, base = filesystem(folder)
                files.create_dir(f"{base}/tokens")
                name = f"tokens/{task.partitionId():06d}-{task.taskAttemptId()}.arrow"
                sinks = [files.open_output_stream(f"{base}/{name}{x}") for x in ("", ".docs")]
                out = _Writer(sinks[0], id_type, length, rows)
                schema = pa.schema([pa.field("key", batch.schema.field("key").type), *_DOCS])
                listed = pa.ipc.new_file(sinks[1], schema)
                first = batch.column("key")[:1]
            ids, bounds = _ended(*tokens.encode(batch.column("text")), end_id)
            out.add(ids)
            listed.write_batch(pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(bounds[:-1] + at), pa.array(np.diff(bounds))], schema=schema
            ))
            at, n_docs = at + len(ids), n_docs + batch.num_rows
        if out is None:
            return
        out.close()
        listed.close()
        for sink in sinks:
            sink.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{name}"]), pa.array([task.partitionId()], pa.int32()), first,
             pa.array([n_docs], pa.int64()), pa.array([at], pa.int64())],
            names=["file", "part", "first", "n_docs", "n_tokens"],
        )

    manifest = dealt.mapInArrow(store, f"file string, part int, first {kind}, n_docs long, n_tokens long")
    manifest.write.parquet(f"{folder}/manifest")
    return Stored(folder, key)


def _ended(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """With the end id after each document."""
    return np.insert(ids, bounds[1:], end_id).astype(np.uint32), bounds + np.arange(len(bounds))
