"""Token ids in binary files of independent zstandard frames.

A file is: a skippable frame with the ids' width, one zstandard frame per
document (its ids, little-endian, with a content checksum), a skippable frame with the
documents' ids, and a seek table in the public seekable format: per frame its
compressed and original size and the low 32 bits of the XXH64 of its content.
A reader takes the table from the file's end and decompresses only
the documents it wants. Files follow each other in ascending order of doc_id.

A document is encoded from its distinct words: a single space between two
characters that are no white space always begins a new pre-token, so the text is cut there
and each distinct part of a slice of texts goes through the tokenizer once.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.plans.sizing import input_bytes

from .common import ranges, scratch, shuffle_width, slices, stored, text_bytes

SLICE_BYTES = 12 << 20
JOINED = 2048                 # parts that go through the tokenizer as one text
FILE_BYTES = 64 << 20         # a file ends with the document that reaches this

# Fixed values of the public zstandard seekable format.
_SKIPPABLE = 0x184D2A50
_SEEK_TABLE = 0x184D2A5E
_SEEKABLE_MAGIC = 0x8F92EAB1


_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True          # as str.isspace
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in "'<|>"]] = True


def cut_points(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the parts of all texts begin: at each text, at each single space inside it, and at signs after letters.

    Beside the space there must be printable ASCII, or a character whose lead byte no white space has.
    A sign begins a pre-token after an ASCII letter; an apostrophe may belong to a contraction and the
    signs of the special token's text to it, so there is no cut at these.
    """
    n = len(raw)
    graph = (raw > 0x20) & (raw < 0x7F)
    space = np.flatnonzero(raw == 0x20)
    space = space[(space > 0) & (space < n - 1)]
    lead2 = (raw >= 0xC3) & (raw <= 0xDF)
    lead3 = (raw >= 0xE4) & (raw <= 0xED)
    before = graph[space - 1] | ((raw[space - 1] >= 0x80) & (
        ((space > 1) & lead2[space - 2]) | ((space > 2) & lead3[space - 3])))
    after = graph[space + 1] | lead2[space + 1] | lead3[space + 1]
    cut = np.zeros(n, bool)
    cut[space[before & after]] = True
    cut[1:] |= _SIGN[raw[1:]] & _LETTER[raw[:-1]]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class PartTable:
    """Ids of parts of texts that a task has met, as Arrow and numpy arrays; forgets all beyond ``LIMIT`` parts or ``BYTES`` of them."""

    LIMIT, BYTES = 1 << 20, 96 << 20
    ENTRY = 64                 # bytes of a part beside its characters and ids, with its place in the table that looks it up

    def __init__(self, encode):
        self.encode = encode       # large string array -> (ids of all, sizes)
        self._forget()

    def _forget(self) -> None:
        import pyarrow as pa

        self.known = pa.array([], pa.large_string())
        self.flat, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.held = 0

    def of(self, parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin of each part in them, size of each part) for an array of distinct parts."""
        import pyarrow as pa
        import pyarrow.compute as pc

        def found():
            return pc.fill_null(pc.index_in(parts, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)

        at = found()
        new = parts.filter(pa.array(at < 0))
        length = len(text_bytes(new)[0])
        if len(self.known) and (len(self.known) + len(new) > self.LIMIT
                                or self.held + self.ENTRY * len(new) + 4 * length > self.BYTES):
            self._forget()
            at, new = np.full(len(parts), -1), parts
            length = len(text_bytes(new)[0])
        if len(new):
            flat, size = self.encode(new)
            self.held += self.ENTRY * len(new) + length + 4 * len(flat)
            at[at < 0] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            self.size = np.concatenate([self.size, size])
        return self.flat, (np.cumsum(self.size) - self.size)[at], self.size[at]


def _plain(parts, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which parts begin with one space and do not end with white space."""
    begin, size = offsets[:-1], np.diff(offsets)
    plain = size > 1
    plain[plain] = raw[begin[plain]] == 0x20
    ends = np.stack([raw[begin[plain] + 1], raw[offsets[1:][plain] - 1]])
    white = _WHITE[ends].any(0)
    wide = np.flatnonzero((ends >= 0x80).any(0) & ~white)      # white space may be wider than a byte
    at = np.flatnonzero(plain)
    white[wide] = [p[1].isspace() or p[-1].isspace() for p in parts.take(at[wide]).to_pylist()]
    plain[at[white]] = False
    return plain


class Encoder:
    """Ids of many texts at once, by the tokenizers library."""

    def __init__(self, path: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        vocabulary = self.tokenizer.get_vocab()
        self.width = 2 if max(*vocabulary.values(), end_id or 0) < 1 << 16 else 4
        # a byte-level token has a character for each of its bytes
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.cache = PartTable(self._parts)

    def _encoded(self, texts: list) -> list:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts. Parts that begin with one space and do not end with white space
        are encoded many at once, and told apart by the bytes of their ids."""
        import pyarrow as pa

        plain = _plain(parts, *text_bytes(parts))
        size = np.zeros(len(parts), np.int64)
        lists = self._encoded(parts.filter(pa.array(~plain)).to_pylist())
        size[~plain] = [len(x) for x in lists]
        raw, offsets = text_bytes(parts.filter(pa.array(plain)))
        ends = [min(a + JOINED, len(offsets) - 1) for a in range(0, len(offsets) - 1, JOINED)]
        joined = self._encoded([raw[offsets[z - 1 - (z - 1) % JOINED]:offsets[z]].tobytes().decode() for z in ends])
        cut = []                  # of the ids in each joined text, where a part ends
        for z, ids in zip(ends, joined):
            a = z - 1 - (z - 1) % JOINED
            at = np.searchsorted(np.cumsum(self.bytes[ids]), offsets[a + 1:z + 1] - offsets[a]) + 1
            cut.append(np.diff(at, prepend=0))
        size[plain] = np.concatenate([np.zeros(0, np.int64), *cut])
        total = np.concatenate([np.zeros(0, np.int32), *lists, *joined])
        begin = np.zeros(len(parts), np.int64)      # where each part's ids are in ``total``
        order = np.concatenate([np.flatnonzero(~plain), np.flatnonzero(plain)])
        begin[order] = np.cumsum(size[order]) - size[order]
        return ranges(total, begin, size), size

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n + 1 offsets), the end id after each text; null is empty."""
        import pyarrow as pa

        raw, offsets = text_bytes(texts)
        n = len(offsets) - 1
        cuts = cut_points(raw, offsets) if len(raw) else np.zeros(0, np.int64)
        parts = pa.LargeStringArray.from_buffers(
            len(cuts), pa.py_buffer(np.append(cuts, len(raw)).astype(np.int64)),
            pa.py_buffer(np.ascontiguousarray(raw))).dictionary_encode()
        index = parts.indices.to_numpy(zero_copy_only=False)
        flat, begin, size = self.cache.of(parts.dictionary)
        at = np.searchsorted(cuts, offsets)
        if self.end_id is not None:     # one more part, after each text
            index = np.insert(index, at[1:], len(size))
            begin, size = np.append(begin, len(flat)), np.append(size, 1)
            flat = np.append(flat, np.int32(self.end_id))
            at = at + np.arange(n + 1)
        size = size[index]
        return ranges(flat, begin[index], size), np.append(0, np.cumsum(size))[at]


class FileWriter:
    """One file of frames; ``close`` writes the tables."""

    def __init__(self, stream, width: int):
        import zstandard

        self.stream, self.width, self.table, self.docs = stream, width, [], []
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.size, self.tokens = 0, 0
        self._skippable(_SKIPPABLE, struct.pack("<I", width))

    def _skippable(self, magic: int, content: bytes) -> None:
        frame = struct.pack("<II", magic, len(content)) + content
        self.stream.write(frame)
        self.size += len(frame)
        if magic != _SEEK_TABLE:
            self.table.append((len(frame), 0, 0))

    def add(self, doc_id, ids: np.ndarray) -> None:
        import xxhash

        content = ids.astype(f"<u{self.width}").tobytes()
        frame = self.packer.compress(content)
        self.stream.write(frame)
        self.table.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.docs.append(doc_id)
        self.size += len(frame)
        self.tokens += len(ids)

    def close(self) -> None:
        known = np.array([d is not None for d in self.docs], np.uint8)
        ids = np.array([d or 0 for d in self.docs], "<i8")
        self._skippable(_SKIPPABLE, known.tobytes() + ids.tobytes())
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        self._skippable(_SEEK_TABLE, entries + struct.pack("<IBI", len(self.table), 0x80, _SEEKABLE_MAGIC))
        self.stream.close()


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        end = source.size()
        frames, _, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
        if magic != _SEEKABLE_MAGIC:
            raise ValueError("not a file of seekable frames")
        table = np.frombuffer(source.read_at(12 * frames, end - 9 - 12 * frames), "<u4").reshape(-1, 3)
        self.sizes, self.checks = table[:, 1].astype(np.int64), table[:, 2]
        self.ends = np.cumsum(table[:, 0].astype(np.int64))
        self.width = struct.unpack("<I", source.read_at(4, 8))[0]
        count = frames - 2
        content = source.read_at(9 * count, int(self.ends[-2]) + 8)
        known = np.frombuffer(content[:count], np.uint8)
        self.docs = [int(d) if k else None for k, d in zip(known, np.frombuffer(content[count:], "<i8"))]

    def ids(self, number: int) -> np.ndarray:
        """The ids of the document at this place; reads and decompresses its frame only."""
        import xxhash

        at = int(self.ends[number])          # the frame before is the one with the width
        frame = self.source.read_at(int(self.ends[number + 1]) - at, at)
        content = self.unpacker.decompress(frame)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[number + 1]:
            raise ValueError(f"checksum of document {self.docs[number]} does not match")
        return np.frombuffer(content, f"<u{self.width}")


def open_store(path: str):
    """The file system of a folder's address and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_token_files(documents: DataFrame, tokenizer: str, end_id: int | None = 2,
                      path: str | None = None) -> DataFrame:
    """Encode every whole text and write the ids in ascending doc_id order.

    ``tokenizer`` is the path of a tokenizers file that every executor has, ``path`` a folder
    that all share (default: a new one below the checkpoint folder). Returns the manifest, one row per
    file: file, partition, part (in order of doc_id), docs, tokens. A file of a lost attempt is in no manifest.
    Null text is empty; a null doc_id comes first; rows of one doc_id are all written, ordered by text.
    An empty table gives an empty manifest. Other columns are ignored.
    """
    folder = path or scratch(documents.sparkSession, "tokens")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        encoder, partition, part = Encoder(tokenizer, end_id), TaskContext.get().partitionId(), 0
        writer = name = None

        def done():
            writer.close()
            return pa.RecordBatch.from_pylist([{
                "file": name, "partition": partition, "part": part, "docs": len(writer.docs),
                "tokens": writer.tokens}], schema=pa.schema([
                    ("file", pa.string()), ("partition", pa.int32()), ("part", pa.int32()),
                    ("docs", pa.int64()), ("tokens", pa.int64())]))

        for batch in batches:
            for rows in slices(batch, SLICE_BYTES):
                ids, ends = encoder.encode(rows.column("text"))
                for doc_id, a, z in zip(rows.column("doc_id").to_pylist(), ends[:-1], ends[1:]):
                    if writer is None:
                        name = f"{partition:06d}-{part:04d}-{uuid.uuid4().hex}.ids.zst"
                        writer = FileWriter(store.open_output_stream(f"{base}/{name}", compression=None),
                                            encoder.width)
                    writer.add(doc_id, ids[a:z])
                    if writer.size >= FILE_BYTES:
                        yield done()
                        writer, part = None, part + 1
        if writer is not None:
            yield done()

    # large parts share more words; twice what a task reads
    read = documents.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        documents.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    size = input_bytes(documents)
    unknown = size >= 1 << 62        # Spark's own default where it knows no size
    parts = shuffle_width(documents.sparkSession) if unknown else max(1, -(-size // (2 * read)))
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = rows.mapInArrow(run, "file string, partition int, part int, docs long, tokens long")
    return stored(manifest, "token-manifest").withColumn("folder", F.lit(folder))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is over the ids as
    little-endian unsigned 32-bit integers.
    """
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                store, base = open_store(row["folder"])
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    reader = FileReader(source)
                    sizes = reader.sizes[1:-1] // reader.width
                    starts = row["before"] + np.cumsum(sizes) - sizes
                    crc = [zlib.crc32(reader.ids(i).astype("<u4").tobytes()) for i in range(len(reader.docs))]
                    for a in range(0, len(crc), 8192):
                        part = slice(a, a + 8192)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(reader.docs[part], pa.int64()), pa.array(starts[part], pa.int64()),
                             pa.array(sizes[part], pa.int64()), pa.array(crc[part], pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])

    earlier = Window.orderBy("partition", "part").rowsBetween(Window.unboundedPreceding, -1)
    files = stored(manifest.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))),
                   "token-files")       # one row per file
    return files.repartition(shuffle_width(files.sparkSession), "file").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_ids(folder: str, file: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document of a file; only its own frames are decompressed."""
    store, base = open_store(folder)
    with store.open_input_file(f"{base}/{file}") as source:
        reader = FileReader(source)
        return [reader.ids(i) for i, d in enumerate(reader.docs) if d == doc_id]
