"""Binary alignment files (block-compressed): a reader in tasks, one for each file."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from contigloom.runtime import ship, tidy

SCHEMA = "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string"
#: Fixed values of the format: CIGAR operations and base codes in order.
_OPS, _BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"


def _blocks(stream) -> Iterator[bytes]:
    """The inflated blocks of a file; each block is a gzip member that tells its own size in its extra field."""
    while len(head := stream.read(18)) == 18:
        size = struct.unpack_from("<H", head, 16)[0] + 1
        extra = struct.unpack_from("<H", head, 10)[0]
        body = stream.read(size - 18)
        yield zlib.decompress(body[extra - 6 : -8], -15)


class _Bytes:
    """Exact reads from a stream of blocks."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.held, self.at = blocks, b"", 0

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n:
            more = next(self.blocks, None)
            if more is None:
                return b""
            self.held, self.at = self.held[self.at :] + more, 0
        out = self.held[self.at : self.at + n]
        self.at += n
        return out


def records(stream) -> Iterator[tuple]:
    """The eleven text columns of each alignment, positions 1-based, as in the text format."""
    data = _Bytes(_blocks(stream))
    if data.take(4) != b"BAM\x01":
        raise ValueError("not a binary alignment file")
    data.take(struct.unpack("<i", data.take(4))[0])
    names = []
    for _ in range(struct.unpack("<i", data.take(4))[0]):
        names.append(data.take(struct.unpack("<i", data.take(4))[0])[:-1].decode())
        data.take(4)
    names.append("*")  # reference -1
    while size := data.take(4):
        r = data.take(struct.unpack("<i", size)[0])
        ref, pos, l_name, mapq, _, n_ops, flag, l_seq, next_ref, next_pos, tlen = struct.unpack_from("<iiBBHHHiiii", r)
        at = 32 + l_name
        qname = r[32 : at - 1].decode()
        ops = struct.unpack_from(f"<{n_ops}I", r, at)
        at += 4 * n_ops
        packed = r[at : at + (l_seq + 1) // 2]
        seq = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in packed)[:l_seq]
        qual = r[at + len(packed) : at + len(packed) + l_seq]
        shown = "*" if not qual or qual[0] == 255 else bytes(q + 33 for q in qual).decode()
        rnext = "=" if next_ref == ref and ref >= 0 else names[next_ref]
        yield qname, flag, names[ref], pos + 1, mapq, "".join(f"{o >> 4}{_OPS[o & 15]}" for o in ops) or "*", rnext, next_pos + 1, tlen, seq or "*", shown


def read_bam(spark: SparkSession, paths: list[str], rows: int = 8192) -> DataFrame:
    """The columns of read_sam() from binary alignment files, each streamed by one task; deal large inputs as many files."""
    ship(spark)
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int32() if c.split()[1] == "int" else pa.string() for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column(0).to_pylist()):
            where, name = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
            held = []
            with where.open_input_stream(name, buffer_size=1 << 20) as stream:
                for r in records(stream):
                    held.append(r)
                    if len(held) == rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names=columns)
                        held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names=columns)

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    return files.mapInArrow(tidy(run), SCHEMA)
