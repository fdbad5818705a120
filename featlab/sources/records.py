"""Record files of integer sequences as a Spark data source.

    spark.dataSource.register(SequenceRecords)
    df.write.format("sequence_records").mode("append").save(folder)
    spark.read.format("sequence_records").schema("label long, seq0 array<long>").load(folder)

A file is a chain of records: the length (unsigned 64-bit), the masked checksum
of these eight bytes, the payload, the masked checksum of the payload (CRC-32C,
rotated right by 15 bits plus a constant; numbers are little-endian). A payload
holds, per column of the schema in order, a length (signed 64-bit, -1 for NULL;
-2 for a plain number) and the 64-bit numbers. Every task writes one file, under
a temporary name until the job commits; a file is one split. A record whose
length or checksum is wrong ends the read with an error that names file and
place. Folders may be local, HDFS or object store paths.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import ArrayType, LongType, StructType

#: CRC-32C: reversed polynomial; the mask's constant (fixed values of the format).
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8
SUFFIX = ".records"
#: Records whose checksums are computed together.
BATCH = 1024
NULL, NUMBER = -1, -2


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def masked_checksums(payloads: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of every payload, byte after byte over all of them at once."""
    lens = np.fromiter(map(len, payloads), np.int64, len(payloads))
    order = np.argsort(-lens, kind="stable")
    data = np.frombuffer(b"".join(payloads), np.uint8)
    starts = (np.cumsum(lens) - lens)[order]
    crc = np.full(len(payloads), 0xFFFFFFFF, np.uint32)
    live = np.searchsorted(-lens[order], -np.arange(1, int(lens.max(initial=0)) + 1), side="right")
    for at, n in enumerate(live.tolist()):
        crc[:n] = _TABLE[(crc[:n] ^ data[starts[:n] + at]) & 0xFF] ^ (crc[:n] >> 8)
    crc = ~crc
    out = np.empty(len(payloads), np.uint32)
    out[order] = (((crc >> np.uint32(15)) | (crc << np.uint32(17))).astype(np.uint64) + MASK).astype(np.uint32)
    return out


def encode(row: tuple) -> bytes:
    parts = []
    for v in row:
        if v is None:
            parts.append(struct.pack("<q", NULL))
        elif isinstance(v, (list, tuple)):
            parts.append(struct.pack(f"<q{len(v)}q", len(v), *v))
        else:
            parts.append(struct.pack("<qq", NUMBER, v))
    return b"".join(parts)


def decode(payload: bytes, columns: int) -> tuple:
    out, at = [], 0
    for _ in range(columns):
        n, = struct.unpack_from("<q", payload, at)
        at += 8
        if n == NUMBER:
            out.append(struct.unpack_from("<q", payload, at)[0])
            at += 8
        else:
            out.append(None if n == NULL else list(struct.unpack_from(f"<{n}q", payload, at)))
            at += 8 * max(n, 0)
    if at != len(payload):
        raise ValueError(f"payload of {len(payload)} bytes, {at} read")
    return tuple(out)


def framed(payloads: list[bytes]) -> bytes:
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    return b"".join(b"".join((h, c.tobytes(), p, d.tobytes())) for h, c, p, d in zip(heads, masked_checksums(heads), payloads, masked_checksums(payloads)))


def records(stream, name: str) -> Iterator[bytes]:
    """Payloads of a file, checked; a batch at a time."""
    def full(n: int, what: str) -> bytes:
        data = stream.read(n)
        if len(data) != n:
            raise ValueError(f"{name}: ends inside {what} at byte {place}")
        return data
    place, held = 0, []

    def checked() -> Iterator[bytes]:
        if held:
            wants = masked_checksums([h[1] for h in held]), masked_checksums([h[3] for h in held])
            for k, (at, _, head_crc, payload, crc) in enumerate(held):
                if head_crc != int(wants[0][k]) or crc != int(wants[1][k]):
                    raise ValueError(f"{name}: wrong checksum in the record at byte {at}")
                yield payload
            held.clear()
    while head := stream.read(8):
        if len(head) != 8:
            raise ValueError(f"{name}: ends inside a length at byte {place}")
        head_crc, = struct.unpack("<I", full(4, "a length"))
        if head_crc != int(masked_checksums([head])[0]):  # before the length is trusted
            raise ValueError(f"{name}: wrong checksum in the record at byte {place}")
        n, = struct.unpack("<Q", head)
        payload = full(n, "a record")
        held.append((place, head, head_crc, payload, struct.unpack("<I", full(4, "a record"))[0]))
        place += 16 + n
        if len(held) >= BATCH:
            yield from checked()
    yield from checked()


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _check(schema: StructType) -> None:
    for f in schema.fields:
        kind = f.dataType.elementType if isinstance(f.dataType, ArrayType) else f.dataType
        if not isinstance(kind, LongType):
            raise ValueError(f"column {f.name}: only long and array<long> are stored, not {f.dataType.simpleString()}")


@dataclass
class FileSplit(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, path: str):
        _check(schema)
        self.columns, self.path = len(schema.fields), path

    def partitions(self) -> list[InputPartition]:
        files, folder = _folder(self.path)
        found = [i.path for i in files.get_file_info(fs.FileSelector(folder)) if i.is_file and i.base_name.endswith(SUFFIX)]
        return [FileSplit(p) for p in sorted(found)] or [FileSplit("")]

    def read(self, partition: FileSplit) -> Iterator[tuple]:
        if not partition.path:
            return
        files, _ = _folder(self.path)
        with files.open_input_stream(partition.path) as stream:
            for payload in records(stream, partition.path):
                yield decode(payload, self.columns)


@dataclass
class Written(WriterCommitMessage):
    name: str


class _Writer(DataSourceWriter):
    def __init__(self, schema: StructType, path: str, overwrite: bool):
        _check(schema)
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, rows: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext
        files, folder = _folder(self.path)
        files.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{self.job}-{task.taskAttemptId()}{SUFFIX}"
        held: list[bytes] = []
        with files.open_output_stream(f"{folder}/.{name}") as out:
            for row in rows:
                held.append(encode(tuple(row)))
                if len(held) == BATCH:
                    out.write(framed(held))
                    held = []
            if held:
                out.write(framed(held))
        return Written(name)

    def commit(self, messages: list) -> None:
        files, folder = _folder(self.path)
        files.create_dir(folder, recursive=True)
        old = [i.path for i in files.get_file_info(fs.FileSelector(folder)) if i.is_file and i.base_name.endswith(SUFFIX) and not i.base_name.startswith(".")]
        for m in messages:
            files.move(f"{folder}/.{m.name}", f"{folder}/{m.name}")
        for path in old if self.overwrite else []:
            files.delete_file(path)

    def abort(self, messages: list) -> None:
        files, folder = _folder(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{folder}/.{m.name}")


class SequenceRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sequence_records"

    def schema(self):
        raise ValueError("give the schema of the records, e.g. .schema('label long, seq0 array<long>')")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(schema, self.options["path"], overwrite)
