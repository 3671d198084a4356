"""``u16shard``: token shards as flat little-endian unsigned 16-bit files.

One file per shard at ``<path>/<source>/<split>/shard_NNNNN.bin``, no header.
Writing keeps one shard in one task (a shard has a fixed token budget); reading
splits files into byte ranges that start on block edges.

A write is visible as a whole or not at all.  Tasks write below a folder of
their own in ``<path>/_staged``; when all have ended, the driver moves the files
of the attempts that count into place and writes the marker ``_COMMITTED``.
Readers ask for the marker, so a folder half moved is not read.  A job that
fails removes what it staged.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from corpusmill.functions.text import MAX_TOKEN_ID

TOKEN_BYTES = 2
SPLIT_BYTES = 16 << 20
BATCH_TOKENS = 4 << 20
#: files moved at a time when a write is committed
MOVERS = 16
STAGED, MARKER = "_staged", "_COMMITTED"
SHARD_SCHEMA = "path string, source string, split string, shard_id bigint, block_in_shard bigint, tokens array<int>"


def _open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system; one without a scheme is in the cluster's default one, as for Spark's own sources."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def is_committed(path: str) -> bool:
    fs, root = _open_fs(path)
    return fs.get_file_info(f"{root}/{MARKER}").type == pafs.FileType.File


def _ask_for_marker(path: str) -> None:
    if not is_committed(path):
        raise FileNotFoundError(f"{path} has no {MARKER}: its write has not ended, or other software wrote it")


@dataclass
class ShardRange(InputPartition):
    """Byte ranges (file, first block, bytes) read by one task."""

    ranges: list = field(default_factory=list)


@dataclass
class ShardsWritten(WriterCommitMessage):
    """Files of one task: (staged path, source, split, name, tokens)."""

    files: list = field(default_factory=list)


class TokenShardReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.block_size = int(options.get("block_size", 2048))
        self.keep_tail = options.get("keep_tail", "false").lower() == "true"
        self.split = options.get("split")
        self.committed = options.get("committed", "true").lower() == "true"

    def partitions(self):
        if self.committed:
            _ask_for_marker(self.root)
        fs, root = _open_fs(self.root)
        block_bytes = self.block_size * TOKEN_BYTES
        per_task = max(1, SPLIT_BYTES // block_bytes)
        tasks, current, room = [], [], per_task
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.path.endswith(".bin") and f"/{STAGED}/" not in f.path)
        if self.split:
            files = [f for f in files if f[0].split("/")[-2] == self.split]
        if not files:
            raise FileNotFoundError(f"no .bin shards under {self.root}")
        for path, size in files:
            if size % TOKEN_BYTES:
                raise ValueError(f"{path} has an odd number of bytes")
            n_blocks = -(-size // block_bytes) if self.keep_tail else size // block_bytes
            first = 0
            while first < n_blocks:
                take = min(room, n_blocks - first)
                current.append((path, first, min(take * block_bytes, size - first * block_bytes)))
                first, room = first + take, room - take
                if not room:
                    tasks.append(ShardRange(ranges=current))
                    current, room = [], per_task
        if current or not tasks:
            tasks.append(ShardRange(ranges=current))
        return tasks

    def read(self, partition: ShardRange) -> Iterator[pa.RecordBatch]:
        fs, _ = _open_fs(self.root)
        batch_blocks = max(1, BATCH_TOKENS // self.block_size)
        for path, first, n_bytes in partition.ranges:
            source, split, name = path.split("/")[-3:]
            shard_id = int(name.removeprefix("shard_").removesuffix(".bin"))
            start = first * self.block_size * TOKEN_BYTES
            with fs.open_input_file(path) as file:
                done = 0
                while done < n_bytes:
                    size = min(batch_blocks * self.block_size * TOKEN_BYTES, n_bytes - done)
                    ids = np.frombuffer(file.read_at(size, start + done), dtype="<u2").astype(np.int32)
                    n = -(-len(ids) // self.block_size)
                    ends = np.minimum(np.arange(n + 1, dtype=np.int32) * self.block_size, len(ids)).astype(np.int32)
                    block = first + done // (self.block_size * TOKEN_BYTES)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * n),
                            pa.array([source] * n),
                            pa.array([split] * n),
                            pa.array(np.full(n, shard_id, dtype=np.int64)),
                            pa.array(np.arange(block, block + n, dtype=np.int64)),
                            pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)),
                        ],
                        names=["path", "source", "split", "shard_id", "block_in_shard", "tokens"],
                    )
                    done += size


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, str, int], np.ndarray]]:
    """The shards of a batch in order, each with all its tokens there."""
    source, split, shard_id, tokens = (batch.column(batch.schema.get_field_index(c)) for c in ("source", "split", "shard_id", "tokens"))
    codes = [source.dictionary_encode().indices.to_numpy(), split.dictionary_encode().indices.to_numpy(), shard_id.to_numpy()]
    starts = np.flatnonzero(np.any([np.diff(c, prepend=c[0] + 1) != 0 for c in codes], axis=0))
    ends = np.append(starts[1:], batch.num_rows)
    values = tokens.flatten().to_numpy(zero_copy_only=False)
    if len(values) and (values.min() < 0 or values.max() > MAX_TOKEN_ID):
        raise ValueError(f"token id outside 0..{MAX_TOKEN_ID}")
    at = np.concatenate(([0], np.cumsum(tokens.value_lengths().fill_null(0).to_numpy())))
    for first, last in zip(starts, ends):
        yield (source[first].as_py(), split[first].as_py(), shard_id[first].as_py()), values[at[first] : at[last]]


class TokenShardWriter(DataSourceArrowWriter):
    """Appends blocks, already in order, to the staged file of their shard."""

    def __init__(self, options):
        self.root = options["path"]
        self.job = uuid.uuid4().hex

    def _staged(self, root: str) -> str:
        return f"{root}/{STAGED}/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ShardsWritten:
        fs, root = _open_fs(self.root)
        folder = f"{self._staged(root)}/{uuid.uuid4().hex}"  # of this attempt alone
        fs.create_dir(folder, recursive=True)
        files: list[list] = []
        key = file = None
        try:
            for batch in iterator:
                for here, values in _runs(batch) if batch.num_rows else ():
                    if here != key:
                        if file is not None:
                            file.close()
                        key = here
                        files.append([f"{folder}/{len(files)}", here[0], here[1], f"shard_{here[2]:05d}.bin", 0])
                        file = fs.open_output_stream(files[-1][0])
                    file.write(values.astype("<u2").tobytes())
                    files[-1][4] += len(values)
        finally:
            if file is not None and not file.closed:
                file.close()
        return ShardsWritten(files)

    def commit(self, messages) -> None:
        """Move the files of all tasks into place, then say so; a repeated name means one shard came from two tasks."""
        fs, root = _open_fs(self.root)
        files = [file for message in messages if message for file in message.files]
        names = [f"{source}/{split}/{name}" for _, source, split, name, _ in files]
        if len(set(names)) != len(names):
            self.abort(messages)
            raise ValueError("a shard was written by two tasks")
        for folder in {name.rsplit("/", 1)[0] for name in names}:
            fs.create_dir(f"{root}/{folder}", recursive=True)
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda i: fs.move(files[i][0], f"{root}/{names[i]}"), range(len(files))))
        self.abort(messages)  # the staged folders are empty
        summary = {"n_shards": len(files), "n_tokens": sum(file[4] for file in files)}
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{MARKER}") as marker:
            marker.write(json.dumps(summary).encode())

    def abort(self, messages) -> None:
        fs, root = _open_fs(self.root)
        if fs.get_file_info(self._staged(root)).type == pafs.FileType.Directory:
            fs.delete_dir(self._staged(root))
        staged = f"{root}/{STAGED}"
        if fs.get_file_info(staged).type == pafs.FileType.Directory and not fs.get_file_info(pafs.FileSelector(staged)):
            fs.delete_dir(staged)


class TokenShardSource(DataSource):
    @classmethod
    def name(cls):
        return "u16shard"

    def schema(self):
        return SHARD_SCHEMA

    def reader(self, schema):
        return TokenShardReader(self.options)

    def writer(self, schema, overwrite):
        fs, root = _open_fs(self.options["path"])
        target = fs.get_file_info(root)
        if target.type != pafs.FileType.NotFound and fs.get_file_info(pafs.FileSelector(root)):
            raise FileExistsError(f"{root} is not empty; shards are written to a fresh folder")
        return TokenShardWriter(self.options)


def write_token_shards(blocks: DataFrame, path: str, decode: Callable[[Column], Column] | None = None) -> None:
    """Write blocks (source, split, shard_id, block_in_shard, tokens) as shard files.

    ``decode`` makes the ids of ``tokens``, if that has them in another form; it
    is called where a shard is written, so that only the shorter form moves.
    """
    blocks.sparkSession.dataSource.register(TokenShardSource)
    keys = ["source", "split", "shard_id"]
    ordered = blocks.select(*keys, "block_in_shard", "tokens").repartition(*keys).sortWithinPartitions(*keys, "block_in_shard")
    (
        (ordered.withColumn("tokens", decode(F.col("tokens"))) if decode else ordered)
        .write.format("u16shard")
        .mode("append")
        .option("path", qualified(blocks.sparkSession, path))
        .save()
    )


def read_token_shards(
    spark: SparkSession, path: str, block_size: int, split: str | None = None, keep_tail: bool = False, committed: bool = True
) -> DataFrame:
    """Blocks of all shards under ``path``; an incomplete last block is dropped unless kept.

    ``committed=False`` reads folders without a marker, which other software wrote.
    """
    spark.dataSource.register(TokenShardSource)
    reader = spark.read.format("u16shard").option("block_size", block_size).option("keep_tail", str(keep_tail).lower())
    reader = reader.option("committed", str(committed).lower())
    if split:
        reader = reader.option("split", split)
    return reader.load(qualified(spark, path))


def list_shards(spark: SparkSession, path: str, split: str | None = None, committed: bool = True) -> DataFrame:
    """One row per shard file with its token count; contents are not read."""
    if committed:
        _ask_for_marker(qualified(spark, path))
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.bin")
        .load(path)
        .select("path", F.split("path", "/").alias("parts"), "length")
    )
    shards = files.select(
        F.element_at("parts", -3).alias("source"),
        F.element_at("parts", -2).alias("split"),
        F.regexp_extract(F.element_at("parts", -1), r"shard_(\d+)\.bin", 1).cast("bigint").alias("shard_id"),
        (F.col("length") / TOKEN_BYTES).cast("bigint").alias("n_tokens"),
        "path",
    )
    return shards.where(F.col("split") == split) if split else shards
