"""Message logs in the MCAP container as a Spark data source, split by chunks.

Layout (public specification, fixed values): eight magic bytes at both ends; records of an opcode byte, a 64-bit length and a
body; messages lie in chunks; the footer points to a summary with the channels and an index of the chunks.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK, CHUNK_INDEX, STATISTICS, DATA_END = 1, 2, 3, 4, 5, 6, 8, 11, 15
FOOTER_BYTES = 1 + 8 + 20
#: Bytes of chunks that one task reads, and rows of a batch.
SPLIT_BYTES, BATCH_ROWS = 64 << 20, 4096
COLUMNS = "file string, topic string, log_ts_ns long, payload binary"


def records(body: bytes | memoryview) -> Iterator[tuple[int, memoryview]]:
    """(opcode, body) of the records in a run of bytes."""
    view, at = memoryview(body), 0
    while at + 9 <= len(view):
        op, size = view[at], struct.unpack_from("<Q", view, at + 1)[0]
        yield op, view[at + 9 : at + 9 + size]
        at += 9 + size


def _text(view: memoryview, at: int) -> tuple[str, int]:
    size = struct.unpack_from("<I", view, at)[0]
    return bytes(view[at + 4 : at + 4 + size]).decode(), at + 4 + size


def _channel(view: memoryview) -> tuple[int, str]:
    return struct.unpack_from("<H", view)[0], _text(view, 4)[0]


@dataclass(frozen=True)
class Summary:
    """Topics by channel, chunks as (offset, length, channels), and message counts by channel (None: not recorded)."""

    topics: dict[int, str]
    chunks: list[tuple[int, int, tuple[int, ...]]]
    counts: dict[int, int] | None


def read_summary(file, size: int) -> Summary:
    file.seek(0)
    if size < 2 * len(MAGIC) + FOOTER_BYTES or file.read(len(MAGIC)) != MAGIC:
        raise ValueError("not an MCAP file, or cut short")
    file.seek(size - len(MAGIC) - FOOTER_BYTES)
    start = struct.unpack("<Q", file.read(FOOTER_BYTES)[9:17])[0]
    if not start:
        raise ValueError("an MCAP file without a summary: index it first")
    file.seek(start)
    topics, chunks, counts = {}, [], None
    for op, body in records(file.read(size - len(MAGIC) - FOOTER_BYTES - start)):
        if op == CHANNEL:
            number, topics_name = _channel(body)
            topics[number] = topics_name
        elif op == CHUNK_INDEX:
            offset, length, n = *struct.unpack_from("<QQ", body, 16), struct.unpack_from("<I", body, 32)[0] // 10
            chunks.append((offset, length, tuple(struct.unpack_from("<H", body, 36 + 10 * i)[0] for i in range(n))))
        elif op == STATISTICS:
            n = struct.unpack_from("<I", body, 42)[0] // 10
            counts = dict(struct.unpack_from("<HQ", body, 46 + 10 * i) for i in range(n))
    return Summary(topics, chunks, counts)


def unpack_chunk(body: memoryview) -> bytes:
    """The records in a chunk's body."""
    kind, at = _text(body, 28)
    size, packed = struct.unpack_from("<Q", body, 16)[0], body[at + 8 :]
    if kind == "":
        return bytes(packed)
    if kind == "zstd":
        return zstandard.ZstdDecompressor().decompress(bytes(packed), max_output_size=size)
    if kind == "lz4":
        return pa.input_stream(io.BytesIO(bytes(packed)), compression="lz4").read()
    raise ValueError(f"unknown chunk compression {kind}")


@dataclass
class ChunkSplit(InputPartition):
    path: str
    chunks: tuple[tuple[int, int], ...]
    topics: dict[int, str]


class McapReader(DataSourceReader):
    """One task per ``SPLIT_BYTES`` of chunks that hold a wanted topic."""

    def __init__(self, path: str, topics: list[str] | None) -> None:
        self.path, self.topics = path, None if topics is None else set(topics)
        self.pushed: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("topic",):
                wanted = {f.value}
            elif isinstance(f, In) and f.attribute == ("topic",):
                wanted = set(f.value)
            else:
                yield f
                continue
            self.pushed = wanted if self.pushed is None else self.pushed & wanted

    def partitions(self) -> list[InputPartition]:
        fs, base = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(base)
        files = [info] if info.is_file else [f for f in fs.get_file_info(pafs.FileSelector(base, recursive=True)) if f.path.endswith(".mcap")]
        out: list[InputPartition] = []
        for f in sorted(files, key=lambda f: f.path):
            with fs.open_input_file(f.path) as file:
                summary = read_summary(file, f.size)
            if self.topics is not None and (missing := self.topics - set(summary.topics.values())):
                raise ValueError(f"{f.path} has no topics {', '.join(sorted(missing))}")
            wanted = {n: t for n, t in summary.topics.items() if (self.topics is None or t in self.topics) and (self.pushed is None or t in self.pushed)}
            split, size = [], 0
            for offset, length, channels in sorted(summary.chunks):
                if channels and not wanted.keys() & set(channels):
                    continue
                split.append((offset, length))
                size += length
                if size >= SPLIT_BYTES:
                    out.append(ChunkSplit(f.path, tuple(split), wanted))
                    split, size = [], 0
            if split:
                out.append(ChunkSplit(f.path, tuple(split), wanted))
        return out

    def read(self, partition: ChunkSplit) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        schema = pa.schema([("file", pa.string()), ("topic", pa.string()), ("log_ts_ns", pa.int64()), ("payload", pa.binary())])
        rows: list[tuple[str, int, bytes]] = []

        def batch() -> pa.RecordBatch:
            topics, times, payloads = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(rows)), pa.array(topics), pa.array(times, pa.int64()), pa.array(payloads, pa.binary())], schema=schema)

        with fs.open_input_file(partition.path) as file:
            for offset, length in partition.chunks:
                file.seek(offset)
                for op, body in records(unpack_chunk(memoryview(file.read(length))[9:])):
                    if op == MESSAGE:
                        channel, _, log = struct.unpack_from("<HIQ", body)
                        if channel in partition.topics:
                            rows.append((partition.topics[channel], log, bytes(body[22:])))
                            if len(rows) >= BATCH_ROWS:
                                yield batch()
                                rows.clear()
        if rows:
            yield batch()


class McapSource(DataSource):
    """``spark.read.format("mcap").option("topics", "a,b").load(uri)``: all or some topics; an unknown one is an error."""

    @classmethod
    def name(cls) -> str:
        return "mcap"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> DataSourceReader:
        topics = self.options.get("topics")
        return McapReader(self.options["path"], topics.split(",") if topics else None)


def read_mcap(spark: SparkSession, uri: str, topics: list[str] | None = None) -> DataFrame:
    """Messages (file, topic, log_ts_ns, payload); filters on topic reach the source."""
    spark.dataSource.register(McapSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("mcap")
    return (reader.option("topics", ",".join(topics)) if topics else reader).load(uri)


def topic_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(F.count("*").alias("n"))


def write_mcap(file, messages: Iterator[tuple[str, int, bytes]], chunk_rows: int = 1000, compression: str = "zstd") -> None:
    """Write (topic, time in ns, payload) messages, in order, with a summary: for tests and small exports."""
    at = 0

    def put(data: bytes) -> None:
        nonlocal at
        file.write(data)
        at += len(data)

    def record(op: int, body: bytes) -> bytes:
        return struct.pack("<BQ", op, len(body)) + body

    text = lambda s: struct.pack("<I", len(s.encode())) + s.encode()
    channels: dict[str, int] = {}
    counts: dict[int, int] = {}
    index = []
    put(MAGIC + record(HEADER, text("") + text("tempora")))
    rows = list(messages)
    channel_records = {}
    for i in range(0, len(rows), chunk_rows):
        body, seen = b"", {}
        some = rows[i : i + chunk_rows]
        for topic, _, _ in some:
            if topic not in channels:
                channels[topic] = len(channels) + 1
                channel_records[topic] = record(CHANNEL, struct.pack("<HH", channels[topic], 0) + text(topic) + text("") + struct.pack("<I", 0))
                body += channel_records[topic]
        for k, (topic, ns, payload) in enumerate(some):
            number = channels[topic]
            seen.setdefault(number, len(body))
            counts[number] = counts.get(number, 0) + 1
            body += record(MESSAGE, struct.pack("<HIQQ", number, k, ns, ns) + payload)
        packed = zstandard.ZstdCompressor().compress(body) if compression == "zstd" else body
        times = [ns for _, ns, _ in some]
        chunk = record(CHUNK, struct.pack("<QQQI", min(times), max(times), len(body), 0) + text(compression) + struct.pack("<Q", len(packed)) + packed)
        offsets = b"".join(struct.pack("<HQ", c, 0) for c in seen)
        index.append(record(CHUNK_INDEX, struct.pack("<QQQQ", min(times), max(times), at, len(chunk)) + struct.pack("<I", len(offsets)) + offsets + struct.pack("<Q", 0) + text(compression) + struct.pack("<QQ", len(packed), len(body))))
        put(chunk)
    put(record(DATA_END, struct.pack("<I", 0)))
    start = at
    per = b"".join(struct.pack("<HQ", c, n) for c, n in counts.items())
    put(b"".join(channel_records.values()) + b"".join(index) + record(STATISTICS, struct.pack("<QHIIIIQQ", len(rows), 0, len(channels), 0, 0, len(index), min((r[1] for r in rows), default=0), max((r[1] for r in rows), default=0)) + struct.pack("<I", len(per)) + per))
    put(record(FOOTER, struct.pack("<QQI", start, 0, 0)) + MAGIC)
