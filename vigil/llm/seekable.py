"""Files of ids: independent zstandard frames, an index of documents, a seek table.

Frames hold a fixed number of ids each, as little-endian integers of two or four
bytes, so a document may begin and end inside frames. After them come two
skippable frames: the index (an Arrow stream of id and n_ids, in file order) and
the seek table of the public seekable format, whose entries give the compressed
size, the plain size and a checksum of each frame. A reader takes the table from
the file's end and decompresses only the frames that a document touches.
"""

import io
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard

#: Fixed values of the seekable format.
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pyarrow.fs.FileSystem.from_uri(uri)


class IdWriter:
    """Append documents of packed 32-bit ids; close() writes index and table."""

    def __init__(self, stream, id_type: pa.DataType, width: int, frame_ids: int, level: int = 3):
        self.stream, self.width, self.frame_bytes = stream, width, frame_ids * width
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.pending, self.frames = bytearray(), []
        self.index = (pa.schema([("id", id_type), ("n_ids", pa.int64())])
                      .with_metadata({"width": str(width)}))
        self.ids, self.sizes = [], []

    def add(self, doc_id, packed: bytes) -> None:
        ids = np.frombuffer(packed, "<u4")
        self.ids.append(doc_id)
        self.sizes.append(len(ids))
        self.pending += ids.astype(f"<u{self.width}").tobytes()
        while len(self.pending) >= self.frame_bytes:
            self._frame(bytes(self.pending[: self.frame_bytes]))
            del self.pending[: self.frame_bytes]

    def _frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.stream.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.pending:
            self._frame(bytes(self.pending))
        out = io.BytesIO()
        with pa.ipc.new_stream(out, self.index) as writer:
            writer.write_batch(pa.record_batch(
                [pa.array(self.ids, self.index.field("id").type), pa.array(self.sizes, pa.int64())],
                schema=self.index))
        index = out.getvalue()
        self.stream.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.frames.append((len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUMS, FOOTER_MAGIC)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, len(table) + len(footer)) + table + footer)


class IdReader:
    """Documents of one file, by position in it."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != FOOTER_MAGIC or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums")
        table = np.frombuffer(source.read_at(12 * count, size - 9 - 12 * count), "<u4").reshape(count, 3)
        self.at = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        self.plain = np.concatenate([[0], np.cumsum(table[:, 1], dtype=np.int64)])
        self.checks = table[:, 2]
        index = source.read_at(int(table[-1, 0]) - 8, int(self.at[-2]) + 8)
        with pa.ipc.open_stream(index) as reader:
            batch = reader.read_all()
        self.width = int(batch.schema.metadata[b"width"])
        self.ids = batch.column("id")
        self.sizes = batch.column("n_ids").to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.cached: tuple[int, bytes] = (-1, b"")
        self.decompressed = 0

    def _frame(self, k: int) -> bytes:
        if self.cached[0] != k:
            begin, end = int(self.at[k]), int(self.at[k + 1])
            data = zstandard.ZstdDecompressor().decompress(self.source.read_at(end - begin, begin))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checks[k]:
                raise ValueError(f"frame {k} is damaged")
            self.cached = (k, data)
            self.decompressed += 1
        return self.cached[1]

    def document(self, position: int) -> np.ndarray:
        begin = int(self.starts[position]) * self.width
        end = int(self.starts[position + 1]) * self.width
        k, parts = int(np.searchsorted(self.plain, begin, "right")) - 1, []
        while begin < end:
            until = min(end, int(self.plain[k + 1]))
            base = int(self.plain[k])
            parts.append(self._frame(k)[begin - base: until - base])
            begin, k = until, k + 1
        return np.frombuffer(b"".join(parts), f"<u{self.width}")

    def documents(self) -> Iterator[np.ndarray]:
        return map(self.document, range(len(self.sizes)))
