"""Token ids in Arrow files of fixed-size lists.

``write`` sorts the documents by id over range partitions, tokenizes each
partition and writes one pair of Arrow IPC files per partition to the shared
folder:

* ``part-<k>.arrow``: batches of ``ids: fixed_size_list<uint16|uint32>[L]`` and
  ``mask: fixed_size_list<uint8>[L / 8]``, one row per sequence. The token stream of
  the partition fills the rows in order; only its last row is padded. The mask
  has one bit per position (least significant first), 1 for a token.
* ``part-<k>.docs.arrow``: ``doc_id, start, n_tokens``, one row per document;
  start counts the partition's ids before it.

Neither file is compressed, and every batch but the last holds ``BATCH_ROWS``
rows, so any row is found by arithmetic and read from a memory map without a
copy. A partition is written under an attempt's own name and then renamed, so
a task that is run again leaves the same file and a lost executor no half one.

Partition totals (one row each) give each partition's global start.

Defined cases: null text is the empty text (its end id only); null ids come
first, equal ids in the order of their texts' hashes; an empty table gives no file;
further columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from implicit_rank.llm import common, pack, tokens
from implicit_rank.session import shared_folder

BATCH_ROWS = 256
MANIFEST = "part int, path string, n_docs long, n_tokens long, seq_len int"


def _schema(dtype: np.dtype, seq_len: int) -> pa.Schema:
    ids = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(ids, seq_len), False),
                      pa.field("mask", pa.list_(pa.uint8(), seq_len // 8), False)])


def _rows(ids: np.ndarray, n_tokens: int, schema: pa.Schema, seq_len: int) -> pa.RecordBatch:
    """Sequences of ids (whole rows, zero padded) of which ``n_tokens`` are tokens."""
    mask = np.packbits(np.arange(len(ids)) < n_tokens, bitorder="little")
    return pa.RecordBatch.from_arrays([
        pa.FixedSizeListArray.from_arrays(pa.array(ids), type=schema.field("ids").type),
        pa.FixedSizeListArray.from_arrays(pa.array(mask), type=schema.field("mask").type)], schema=schema)


def _filesystem(folder: str):
    """(filesystem, path) of the shared folder: a local mount or an object store."""
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write(docs: DataFrame, path: str, seq_len: int = 2048, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the files and return the manifest (part, path, n_docs, n_tokens, seq_len).

    ``seq_len`` is a multiple of 8. The manifest is written beside the files.
    """
    if seq_len <= 0 or seq_len % 8:
        raise ValueError("seq_len must be a positive multiple of 8")
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")
    dtype = pack.id_type(tokens.load(path).get_vocab_size(with_added_tokens=True))
    schema = _schema(dtype, seq_len)
    docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
    whole = BATCH_ROWS * seq_len

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = common.text_chunks(batches)
        first = next(chunks, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        name, trial = f"{base}/part-{part:06d}", f"{base}/.trial-{part:06d}-{uuid.uuid4().hex}"
        n_docs = n_tokens = 0
        held = np.zeros(0, dtype)
        with fs.open_output_stream(f"{trial}.arrow") as out, fs.open_output_stream(f"{trial}.docs.arrow") as index, \
                pa.ipc.new_file(out, schema) as writer, pa.ipc.new_file(index, docs_schema) as lists:
            for chunk in _with(first, chunks):
                ids, offsets = tokens.token_ids(common.texts_of(chunk), path, end_id)
                lists.write_batch(pa.RecordBatch.from_arrays(
                    [common.one_array(chunk.column("doc_id")), pa.array(n_tokens + offsets[:-1]),
                     pa.array(np.diff(offsets))], schema=docs_schema))
                n_docs, n_tokens = n_docs + chunk.num_rows, n_tokens + len(ids)
                held = np.concatenate([held, ids.astype(dtype)])
                for at in range(0, len(held) - whole + 1, whole):
                    writer.write_batch(_rows(held[at:at + whole], whole, schema, seq_len))
                held = held[len(held) - len(held) % whole:]
            if len(held):
                padded = np.zeros(-(-len(held) // seq_len) * seq_len, dtype)
                padded[:len(held)] = held
                writer.write_batch(_rows(padded, len(held), schema, seq_len))
        fs.move(f"{trial}.docs.arrow", f"{name}.docs.arrow")
        fs.move(f"{trial}.arrow", f"{name}.arrow")
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([f"{folder}/part-{part:06d}"]), pa.array([n_docs]),
             pa.array([n_tokens]), pa.array([seq_len], pa.int32())],
            names=["part", "path", "n_docs", "n_tokens", "seq_len"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # a frequent id is cut into ranges by its texts, equal rows by a number
    by = ["doc_id", "tie", "salt"]
    ordered = (rows.withColumn("tie", F.xxhash64("text")).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
               .repartitionByRange(*by).sortWithinPartitions(*by))
    return common.save(ordered.mapInArrow(run, MANIFEST), "token-files-manifest")


def _with(first, rest):
    yield first
    yield from rest


class TokenFile:
    """Random access to one pair of files; slices are views of the mapped file."""

    def __init__(self, path: str):
        fs, base = _filesystem(path)
        self.source = fs.open_input_file(f"{base}.arrow") if not isinstance(fs, pa.fs.LocalFileSystem) \
            else pa.memory_map(f"{base}.arrow")
        self.file = pa.ipc.open_file(self.source)
        self.seq_len = self.file.schema.field("ids").type.list_size
        self.index = lambda: pa.ipc.open_file(fs.open_input_file(f"{base}.docs.arrow"))

    def batch(self, k: int) -> np.ndarray:
        """All ids of batch ``k`` in a row (a view)."""
        return self.file.get_batch(k).column("ids").flatten().to_numpy()

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask bits) of one equal-length sequence."""
        batch = self.file.get_batch(row // BATCH_ROWS)
        at = row % BATCH_ROWS
        mask = batch.column("mask")[at].values.to_numpy()
        return batch.column("ids")[at].values.to_numpy(), np.unpackbits(mask, bitorder="little")

    def tokens(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids start .. start + n - 1 as one view per batch that holds some."""
        size = BATCH_ROWS * self.seq_len
        while n > 0:
            at = start % size
            view = self.batch(start // size)[at:at + n]
            yield view
            start, n = start + len(view), n - len(view)


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    start counts the ids of all documents before it over all files; ids_crc32
    is over the ids as little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                file = TokenFile(path)
                index = file.index()
                for k in range(index.num_record_batches):
                    rows = index.get_batch(k)
                    crcs = []
                    for start, n in zip(rows.column("start").to_pylist(), rows.column("n_tokens").to_pylist()):
                        crc = 0
                        for view in file.tokens(start, n):
                            crc = zlib.crc32(view.astype("<u4").tobytes(), crc)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id"), pa.array(rows.column("start").to_numpy() + base),
                         rows.column("n_tokens"), pa.array(crcs, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    base = common.prefix_totals(manifest, "part", "n_tokens")  # one row per file
    files = manifest.join(F.broadcast(base), "part").select("path", "base", "part")
    n = max(1, manifest.count())  # one task per file
    return files.drop("part").repartition(n).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
