"""Packing by concatenate and cut.

Pass 1 tokenizes each partition where it lies and keeps a running token
offset inside the partition. The partitions' token totals (one row each) are
turned into global offsets by a prefix sum. Pass 2 cuts the one global token
stream at multiples of ``seq_len``: a document that crosses a window gets one
boundary record (piece) per window. No text or id is shuffled.

The token table is written to the shared folder between the passes, with its
partition number and offsets as columns, so a lost executor or another split
of the files cannot move an offset. Offsets are therefore a function of the
written table alone.

Defined cases: null text is the empty text (it has the end id only); null and
repeated ids are packed row by row, each under its id as given; an empty table
gives no piece; further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from implicit_rank.llm import common, tokens

TOKEN_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids binary"
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long, ids binary")


def id_type(vocab_size: int):
    return np.dtype("<u2") if vocab_size <= 1 << 16 else np.dtype("<u4")


def token_table(docs: DataFrame, path: str, end_id: int, dtype: np.dtype) -> DataFrame:
    """Pass 1: (doc_id, part, local_start, n_tokens, ids) of every row."""

    def tokenize(batches):
        part, at = TaskContext.get().partitionId(), 0
        for chunk in common.text_chunks(batches):
            ids, offsets = tokens.token_ids(common.texts_of(chunk), path, end_id)
            data = ids.astype(dtype).tobytes()
            counts = np.diff(offsets)
            n = len(counts)
            cells = pa.Array.from_buffers(pa.large_binary(), n, [
                None, pa.py_buffer((offsets * dtype.itemsize).astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([
                common.one_array(chunk.column("doc_id")), pa.array(np.full(n, part, np.int32)),
                pa.array(at + offsets[:-1]), pa.array(counts), cells.cast(pa.binary()),
            ], names=["doc_id", "part", "local_start", "n_tokens", "ids"])
            at += int(offsets[-1])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenize, TOKEN_SCHEMA)


def pack(docs: DataFrame, path: str, seq_len: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: where each stretch of each document's ids lies.

    doc_id, start (ids of the document before the piece), length, ids_crc32
    (of the piece's ids as little-endian unsigned 32-bit integers), doc_tokens,
    sequence_id, offset in the sequence and, if asked for, the ids themselves
    (little-endian unsigned 32-bit). Every sequence but the last is full.
    """
    dtype = id_type(tokens.load(path).get_vocab_size(with_added_tokens=True))
    table = common.save(token_table(docs, path, end_id, dtype), "packed-tokens")
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    base = common.prefix_totals(totals, "part", "total")  # one row per partition

    def cut(batches):
        for batch in batches:
            out = {name: [] for name in ("row", "start", "length", "crc", "sequence", "offset", "ids")}
            starts = batch.column("start").to_numpy()
            cells = batch.column("ids")
            for row, first in enumerate(starts.tolist()):
                ids = np.frombuffer(cells[row].as_buffer(), dtype)
                done = 0
                while done < len(ids):
                    offset = (first + done) % seq_len
                    length = min(seq_len - offset, len(ids) - done)
                    piece = ids[done:done + length].astype("<u4").tobytes()
                    for name, value in zip(out, (row, done, length, zlib.crc32(piece), (first + done) // seq_len,
                                                 offset, piece if with_ids else None)):
                        out[name].append(value)
                    done += length
            rows = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(rows), *(pa.array(out[x], pa.int64()) for x in ("start", "length", "crc")),
                batch.column("n_tokens").take(rows), pa.array(out["sequence"], pa.int64()),
                pa.array(out["offset"], pa.int64()), pa.array(out["ids"], pa.binary()),
            ], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    placed = (table.join(F.broadcast(base), "part")
              .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids"))
    pieces = placed.mapInArrow(cut, PIECE_SCHEMA)
    return pieces if with_ids else pieces.drop("ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) from pieces packed with their ids.

    A group is one sequence, so it holds at most ``seq_len`` ids.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
