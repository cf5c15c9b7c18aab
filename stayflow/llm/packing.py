"""Cost-balanced packing of token ids into training sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n``, its matrix products and its
attention. A document's whole sequences are cut off first. The rests of a shard, longest
first, each go to the sequence of lowest cost that has room for them; if none has, the one
of lowest cost with any room is filled and the rest goes on. A shard opens as many whole
sequences as its rests fill; what is left of the shortest rests then, less than one
sequence, stays loose. The loose pieces of all shards are put together and packed again by
the same rule, and only there what is left beyond whole sequences goes to sequences of a
power of two, which need no padding. So nothing is padded, and of these short sequences
there are at most twelve for each ``shard_tokens`` of loose tokens, however many partitions
the documents came in: less than one in forty thousand.

A shard is a run of documents of one input partition, a few million tokens at most, so
packing needs no shuffle but for the loose pieces, and a task holds one shard. Sequence ids
carry the partition's number in their upper bits, and a mark above it for the second round.

Defined cases: null and empty texts are one token, the end id; a document of any length is
cut; rests of equal length go in the order they are read, and of sequences of equal cost the
first is taken; repeated rows are packed each; an empty table gives no rows; the id column is kept as
it is, null or not; no other column is read.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from stayflow.llm.text import TEXT, slices
from stayflow.llm.tokens import encoder
from stayflow.session import materialize

SEQUENCE = 4096
END_ID = 2
SHARD_TOKENS = 2_000_000
LINEAR, QUADRATIC = 1.0, 1.0 / SEQUENCE
PARTITION_SHIFT = 40
SECOND_ROUND = 1 << 62
FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double"


def rooms(rest: int, size: int) -> list[int]:
    """Room of the sequences for ``rest`` tokens: whole ones, then powers of two."""
    return [size] * (rest // size) + [1 << b for b in range(size.bit_length() - 1, -1, -1) if (rest % size) >> b & 1]


def pack(lengths: np.ndarray, size: int = SEQUENCE, linear: float = LINEAR, quadratic: float = QUADRATIC, loose: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (document, start, length, sequence, offset), one row each, and each sequence's cost.

    With ``loose`` there are whole sequences only, and pieces without room have sequence -1.
    """
    cost_of = lambda n: linear * n + quadratic * n * n
    pieces: list[tuple[int, int, int, int, int]] = []
    whole = 0
    for doc, n in enumerate(lengths.tolist()):
        for k in range(n // size):
            pieces.append((doc, k * size, size, whole, 0))
            whole += 1
    rest = lengths % size
    total = int(rest.sum())
    room = np.array([size] * (total // size) if loose else rooms(total, size), np.int64)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    for doc in np.argsort(-rest, kind="stable").tolist():
        left = int(rest[doc])
        start = int(lengths[doc]) - left
        while left:
            free = room - used
            fits = free >= left
            if not fits.any():
                fits = free > 0
            if not fits.any():
                pieces.append((doc, start, left, -1, 0))
                break
            at = int(np.where(fits, cost, np.inf).argmin())
            n = min(left, int(free[at]))
            pieces.append((doc, start, n, whole + at, int(used[at])))
            used[at] += n
            cost[at] += cost_of(n)
            start, left = start + n, left - n
    costs = np.concatenate([np.full(whole, cost_of(size)), cost])
    return np.array(pieces, np.int64).reshape(-1, 5), costs


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID, tokenizer: str | None = None,
    shard_tokens: int = SHARD_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC, with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of a document; ``with_ids`` adds its ids as little-endian 32-bit binary."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias(TEXT))
    fields = T._parse_datatype_string(FIELDS + ", ids binary").fields
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType), *fields])
    end = np.array([end_id], "<u4").tobytes()

    def flush(ids: list[pa.Array], raw: list[bytes], begins: np.ndarray, tokens: np.ndarray, base: int, loose: bool) -> tuple[pa.RecordBatch, int]:
        """The pieces of texts, or of loose pieces that begin somewhere in theirs."""
        pieces, costs = pack(np.array([len(r) // 4 for r in raw], np.int64), size, linear, quadratic, loose)
        doc, start, length, sequence, offset = pieces.T
        cut = [raw[d][4 * s : 4 * (s + n)] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
        free = sequence < 0
        columns = [pa.concat_arrays(ids).take(pa.array(doc))]
        columns += [pa.array(c) for c in (begins[doc] + start, length, np.array([zlib.crc32(x) for x in cut], np.int64), tokens[doc])]
        columns += [pa.array(base + sequence, mask=free), pa.array(offset, mask=free), pa.array(costs[sequence] if len(costs) else np.zeros(len(doc)), mask=free)]
        columns.append(pa.array([x if with_ids or f else None for x, f in zip(cut, free.tolist())], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=schema.names), base + len(costs)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        base = TaskContext.get().partitionId() << PARTITION_SHIFT
        ids, raw, total = [], [], 0
        whole = lambda: (np.zeros(len(raw), np.int64), np.array([len(r) // 4 for r in raw], np.int64))
        for batch in batches:
            for part in slices(batch, TEXT):
                found = [r + end for r in encode(part.column(TEXT).to_pylist())]
                ids.append(part.column("id"))
                raw += found
                total += sum(map(len, found)) // 4
                if total >= shard_tokens:
                    out, base = flush(ids, raw, *whole(), base, True)
                    yield out
                    ids, raw, total = [], [], 0
        if raw:
            yield flush(ids, raw, *whole(), base, True)[0]

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = SECOND_ROUND + (TaskContext.get().partitionId() << PARTITION_SHIFT)
        held: list[pa.RecordBatch] = []

        def out() -> tuple[pa.RecordBatch, int]:
            column = lambda c: np.concatenate([b.column(c).to_numpy() for b in held])
            raw = [x for b in held for x in b.column("ids").to_pylist()]
            return flush([b.column("id") for b in held], raw, column("start"), column("doc_tokens"), base, False)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.column("ids").nbytes for b in held) >= 8 * shard_tokens:
                done, base = out()
                yield done
                held = []
        if held:
            yield out()[0]

    names = [f.name for f in fields if with_ids or f.name != "ids"]
    pieces = materialize(source.mapInArrow(first, schema), "pieces")
    left = pieces.filter("sequence_id IS NULL")
    tokens = left.agg(F.sum("length")).first()[0] or 0
    out = pieces.filter("sequence_id IS NOT NULL")
    if tokens:
        out = out.unionByName(left.repartition(-(-tokens // shard_tokens)).mapInArrow(second, schema))
    return out.select(F.col("id").alias(id_col), *names)
