"""Token-id files with bit-plane shuffled, zstandard compressed blocks and a chunk index.

A file holds a range of documents in ascending id order::

    magic | chunk ... | index | length of the index (8 bytes) | magic

Ids are cut into chunks of a fixed number. A chunk is transposed into planes, one for
each bit (or byte) of an id, and each plane is compressed by itself; planes of zeros only
take no space. The index, an Arrow table compressed with zstandard, names for each chunk
its place, its number of ids and the sizes of its planes, and for each document its id and
its number of tokens. A reader needs one chunk at a time.

Files are written by the tasks that sorted them, to a name of their own and then moved,
so that a repeated or speculative task leaves one whole file. ``path`` must be reachable
by all executors: a mounted folder, or a store that pyarrow's filesystems know.

Defined cases: null and empty texts have only the end id; rows with equal ids follow in
the order of their texts' hashes; null ids come first; an empty table gives no file and no
rows; other columns are left alone.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stayflow.llm.text import TEXT, slices
from stayflow.llm.tokens import encoder
from stayflow.session import materialize, new_folder

MAGIC = b"IDPLANE1"
CHUNK_IDS = 65_536
FILE_CHARS = 16_000_000
ROW_CHARS = 64  # what a document adds to its file's size besides its text
END_ID = 1
LEVEL = 3
READ_BATCH_BYTES = 4 << 20


def to_planes(ids: np.ndarray, unit: str = "bit") -> list[bytes]:
    """The planes of little-endian 32-bit ids, lowest first; a plane of zeros only is empty."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    out = []
    for column in map(np.ascontiguousarray, raw.T):
        used = int(np.bitwise_or.reduce(column, initial=0))
        if unit == "bit":
            out += [np.packbits(column & np.uint8(1 << b)).tobytes() if used >> b & 1 else b"" for b in range(8)]
        else:
            out.append(column.tobytes() if used else b"")
    return out


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """Inverse of :func:`to_planes`; the unit follows from the number of planes."""
    raw, each = np.zeros((n, 4), np.uint8), len(planes) // 4
    for i, plane in enumerate(planes):
        if plane and each == 1:
            raw[:, i] = np.frombuffer(plane, np.uint8)
        elif plane:
            raw[:, i // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << np.uint8(i % 8)
    return raw.view("<u4").ravel()


def file_system(uri: str):
    """The pyarrow file system of a folder and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("s3://" + uri[6:] if uri.startswith("s3a://") else uri)


class Writer:
    """Writes one file to an open stream."""

    def __init__(self, stream, id_type: pa.DataType, unit: str = "bit", chunk_ids: int = CHUNK_IDS, level: int = LEVEL):
        self.stream, self.unit, self.chunk = stream, unit, 4 * chunk_ids
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.id_type, self.at = id_type, len(MAGIC)
        self.held, self.size = [], 0
        self.chunks: list[tuple[int, int, list[int]]] = []
        self.docs, self.counts = [], []
        stream.write(MAGIC)

    def add(self, doc_ids: pa.Array, raws: list[bytes]) -> None:
        self.docs.append(doc_ids)
        self.counts += [len(r) // 4 for r in raws]
        for raw in raws:
            self.held.append(raw)
            self.size += len(raw)
            if self.size >= self.chunk:
                self._cut()

    def _cut(self) -> None:
        data, at = b"".join(self.held), 0
        while len(data) - at >= self.chunk:
            self._put(data[at : at + self.chunk])
            at += self.chunk
        self.held, self.size = [data[at:]], len(data) - at

    def _put(self, data: bytes) -> None:
        planes = [self.compress(p) if p else b"" for p in to_planes(np.frombuffer(data, "<u4"), self.unit)]
        self.chunks.append((self.at, len(data) // 4, [len(p) for p in planes]))
        for p in planes:
            self.stream.write(p)
            self.at += len(p)

    def close(self) -> int:
        """Writes what is left and the index; returns the number of ids."""
        if rest := b"".join(self.held):
            self._put(rest)
        chunks = pa.table({"at": pa.array([c[0] for c in self.chunks], pa.int64()), "n": pa.array([c[1] for c in self.chunks], pa.int64()), "planes": pa.array([c[2] for c in self.chunks], pa.list_(pa.int64()))})
        docs = pa.table({"id": pa.chunked_array(self.docs, self.id_type), "n_tokens": pa.array(self.counts, pa.int64())})
        index = self.compress(_table_bytes(chunks)), self.compress(_table_bytes(docs))
        sizes = np.array([len(x) for x in index], "<u8").tobytes()
        for x in (*index, sizes, MAGIC):
            self.stream.write(x)
        self.stream.flush()
        return sum(self.counts)


def _table_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def read_file(f) -> Iterator[tuple[pa.Array, list[int], list[bytes]]]:
    """(ids of documents, token counts, ids of each as bytes) in runs, from a random-access file."""
    size = f.size()
    tail = f.read_at(16 + len(MAGIC), size - 16 - len(MAGIC))
    if f.read_at(len(MAGIC), 0) != MAGIC or tail[16:] != MAGIC:
        raise ValueError("not an id file, or not whole")
    n_chunks, n_docs = np.frombuffer(tail[:16], "<u8").tolist()
    at = size - len(tail) - n_docs - n_chunks
    unpack = zstandard.ZstdDecompressor().decompress
    chunks = pa.ipc.open_stream(unpack(f.read_at(n_chunks, at))).read_all().to_pylist()
    docs = pa.ipc.open_stream(unpack(f.read_at(n_docs, at + n_chunks))).read_all().combine_chunks()
    counts = docs.column("n_tokens").to_pylist()
    ids = docs.column("id").combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) and ids.num_chunks else ids
    buffer, first, done = bytearray(), 0, 0
    for chunk in [*chunks, None]:
        if chunk is not None:
            data, planes, p = f.read_at(sum(chunk["planes"]), chunk["at"]), [], 0
            for length in chunk["planes"]:
                planes.append(unpack(data[p : p + length]) if length else b"")
                p += length
            buffer += from_planes(planes, chunk["n"]).tobytes()
        used, run = 0, []
        while done < len(counts) and used + 4 * counts[done] <= len(buffer):
            run.append(bytes(buffer[used : used + 4 * counts[done]]))
            used += 4 * counts[done]
            done += 1
        if run:
            yield ids.slice(first, len(run)), counts[first:done], run
            first = done
        del buffer[:used]
    if buffer or done < len(counts):
        raise ValueError("the index does not fit the chunks")


def n_files(docs: DataFrame, text_col: str, file_chars: int = FILE_CHARS) -> int:
    chars, rows = docs.agg(F.sum(F.length(text_col)), F.count("*")).first()
    return max(1, -(-((chars or 0) + ROW_CHARS * rows) // file_chars))


def write_ids(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, tokenizer: str | None = None,
    unit: str = "bit", chunk_ids: int = CHUNK_IDS, file_chars: int = FILE_CHARS,
) -> DataFrame:
    """Writes the files below ``path``; returns one row for each: (file, part, n_docs, n_tokens, start)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias(TEXT))
    order = ["id", F.xxhash64(TEXT)]
    dealt = source.repartitionByRange(n_files(source, TEXT, file_chars), *order).sortWithinPartitions(*order)
    id_type = to_arrow_schema(source.select("id").schema).field(0).type
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, n_docs = None, None, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for piece in slices(batch, TEXT):
                if out is None:
                    encode = encoder(tokenizer).encode
                    system, folder = file_system(path)
                    system.create_dir(folder, recursive=True)
                    name = f"part-{part:06d}.ids"
                    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
                    stream = system.open_output_stream(attempt)
                    out = Writer(stream, id_type, unit, chunk_ids)
                out.add(piece.column("id"), [r + end for r in encode(piece.column(TEXT).to_pylist())])
                n_docs += piece.num_rows
        if out is not None:
            n_tokens = out.close()
            stream.close()
            system.move(attempt, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, part, n_docs, n_tokens)], names=["file", "part", "n_docs", "n_tokens"])

    # the list is kept, so that reading it again does not write the files again
    files = materialize(dealt.mapInArrow(run, "file string, part long, n_docs long, n_tokens long"), "id-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_ids(files: DataFrame, path: str, id_col: str, id_type: T.DataType) -> DataFrame:
    """(id, start, n_tokens, ids) of every document, read back from the files."""
    schema = T.StructType([T.StructField(id_col, id_type), *T._parse_datatype_string("start long, n_tokens long, ids binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, folder = file_system(path)
                start = row["start"]
                with system.open_input_file(f"{folder}/{row['file']}") as f:
                    for ids, counts, raws in read_file(f):
                        starts = start + np.concatenate([[0], np.cumsum(counts)])
                        start = int(starts[-1])
                        yield pa.RecordBatch.from_arrays([ids, pa.array(starts[:-1].astype(np.int64)), pa.array(counts, pa.int64()), pa.array(raws, pa.binary())], names=schema.names)

    n = max(1, files.count())
    return files.select("file", "start").repartitionByRange(n, "start").mapInArrow(run, schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, **options) -> DataFrame:
    """Writes the ids of ``docs`` and returns (id, start, n_tokens, ids_crc32), all from the files."""
    path = path or new_folder(docs.sparkSession, "id-planes")
    files = materialize(write_ids(docs, path, id_col, text_col, **options), "id-starts")
    back = read_ids(files, path, id_col, docs.schema[id_col].dataType)
    return back.select(id_col, "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
