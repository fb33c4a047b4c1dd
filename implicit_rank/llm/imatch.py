"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon is the terms whose document frequency lies in a band, given as
shares of all documents (1/1000 to 1/10: an inverse document frequency of 2.3
to 6.9). A document keeps its distinct lexicon terms, sorted, and hashes them:
once whole (the classic signature) and once for each of ``SUBSETS`` randomised
subsets of the lexicon, at ``RATES`` nested sampling rates. The rates follow the
number of kept terms, so that a subset holds about one or two of them: then a
changed quarter of a text leaves many subset signatures as they were. Two
fingerprints are alike to the share of subset signatures that agree, among the
subsets that hold a term of either, at the rates both have.

A group of copies that holds more than a tenth of the documents takes its own
terms out of the lexicon, and rare terms never enter it. So every text also has
subset signatures over all its terms, in the lexicon or not. They decide
wherever either of two texts has few lexicon terms: below 1 / ``FEW`` of its own.

All documents are counted. The lexicon has at most (mean distinct terms) /
(lower share) terms whatever the number of documents, which is why it is
broadcast.

Terms are what white space separates in the lower-cased text, known by their
64-bit hash.

Defined cases: a null text is the empty text; a text without lexicon terms
keeps all its terms instead, also for the whole signature; without any term the
signatures are zero, and two such are alike to 1; equal texts have equal fingerprints; null ids come first,
equal ids in the order of their texts' hashes; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from implicit_rank.llm import common, words

BAND = (0.001, 0.1)  # shares of documents
SUBSETS = 32
RATES = 3            # sampling rates, each half the one before
FEW = 4              # lexicon terms are few below one in so many of a text's terms
GAPS = 16            # samples between two bounds of a chunk
SAMPLES = 1 << 20    # about the most ids sampled for bounds

_ODD, _MULTIPLY, _MULTIPLY2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over an array (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLY
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLY2
    return x ^ (x >> np.uint64(31))


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct term hashes of each text in a row, n + 1 offsets)."""
    vocabulary, codes, offsets = words.split_words(pc.utf8_lower(texts))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(map(digest, common.strings(vocabulary)), np.uint64, len(vocabulary))
    rank = np.argsort(np.argsort(hashes, kind="stable"), kind="stable")
    by_rank = np.sort(hashes)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    pairs = np.unique(doc * max(1, len(hashes)) + rank[codes])
    doc, rank = np.divmod(pairs, max(1, len(hashes)))
    return by_rank[rank], np.searchsorted(doc, np.arange(n + 1))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Sorted hashes of the terms whose document frequency lies in the band."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in common.text_chunks(batches):
            found, _ = terms(common.texts_of(chunk))
            term, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], names=["term", "n"])

    n_docs = docs.count()
    low, high = max(2, int(np.ceil(band[0] * n_docs))), band[1] * n_docs
    counts = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    kept = counts.filter((F.col("n") >= low) & (F.col("n") <= high)).select("term").toArrow()
    return np.sort(kept.column("term").to_numpy().astype(np.int64).view(np.uint64))


class Fingerprints:
    """Signatures of many texts.

    Of the lexicon terms: whole (n), scale (n), subsets (n, RATES, SUBSETS). Of
    all terms: all_scale and all_subsets. few (n): whether the latter decide.
    """

    FIELDS = ("whole", "scale", "subsets", "few", "all_scale", "all_subsets")

    def __init__(self, texts: pa.Array, known: np.ndarray):
        found, offsets = terms(texts)
        n, sizes = len(offsets) - 1, np.diff(offsets)
        doc = np.repeat(np.arange(n), sizes)
        keep = np.zeros(len(found), bool)
        if len(known):
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            keep = known[at] == found
        kept = np.bincount(doc[keep], minlength=n)
        self.few = FEW * kept < sizes
        keep |= (kept == 0)[doc]  # no lexicon term: all terms
        self.whole = self._sums(mix(found[keep] * _ODD), doc[keep], n)
        self.scale, self.all_scale = self._scale(np.bincount(doc[keep], minlength=n)), self._scale(sizes)
        self.subsets, self.all_subsets = (np.zeros((n, RATES, SUBSETS), np.uint16) for _ in range(2))
        limits, all_limits = self._limits(self.scale), self._limits(self.all_scale)
        most = np.where(keep, limits[0][doc], all_limits[0][doc])  # a kept term's limit is the higher one
        for k in range(SUBSETS):
            draw = mix(found ^ mix(np.uint64([k + 1]) * _ODD))
            member = np.flatnonzero(draw <= most)
            draw, of, kept = draw[member], doc[member], keep[member]
            value = mix(draw + _ODD)
            for step in range(RATES):
                self._sign(self.subsets[:, step, k], value, of, kept & (draw <= limits[step][of]))
                self._sign(self.all_subsets[:, step, k], value, of, draw <= all_limits[step][of])

    @staticmethod
    def _scale(sizes: np.ndarray) -> np.ndarray:
        return np.where(sizes > 0, np.floor(np.log2(np.maximum(sizes, 1))) + 1, 0).astype(np.int64)

    @staticmethod
    def _limits(scale: np.ndarray) -> list[np.ndarray]:
        """Up to which draw a term of each document is in a subset, at each rate."""
        return [np.uint64(0xFFFFFFFFFFFFFFFF) >> (scale + step).astype(np.uint64) for step in range(RATES)]

    @classmethod
    def _sign(cls, out: np.ndarray, values: np.ndarray, doc: np.ndarray, chosen: np.ndarray) -> None:
        """Signatures of one subset; 0 stands for a subset without a term."""
        doc = doc[chosen]
        sums = cls._sums(values[chosen], doc, len(out))
        out[doc] = np.maximum(sums[doc] >> np.uint64(48), np.uint64(1))

    @staticmethod
    def _sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Sums (modulo 2**64) of the values of each document; ``doc`` ascends."""
        out = np.zeros(n, np.uint64)
        if len(doc):
            starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            out[doc[starts]] = np.add.reduceat(values, starts)
        return out

    def strings(self) -> list[str]:
        """``<lexicon part>-<few>-<scale>-<subset signatures>``, the last two of all terms, in hex."""
        return [f"{part}-{few:d}-{s:02x}-{x.tobytes().hex()}" for part, few, s, x in zip(
            self.lexicon_strings(), self.few.tolist(), self.all_scale.tolist(), self._bytes(self.all_subsets))]

    def lexicon_strings(self) -> list[str]:
        """``<whole>-<scale>-<subset signatures>`` of the lexicon terms in hex."""
        return [f"{w:016x}-{s:02x}-{x.tobytes().hex()}" for w, s, x in zip(
            self.whole.tolist(), self.scale.tolist(), self._bytes(self.subsets))]

    @staticmethod
    def _bytes(subsets: np.ndarray) -> np.ndarray:
        return subsets.astype(">u2").reshape(len(subsets), -1)

    def take(self, rows: np.ndarray) -> Fingerprints:
        out = object.__new__(Fingerprints)
        for name in self.FIELDS:
            setattr(out, name, getattr(self, name)[rows])
        return out

    @classmethod
    def parse(cls, strings: list[str]) -> Fingerprints:
        out = object.__new__(cls)
        parts = [s.split("-") for s in strings]
        subsets = lambda k: np.array([np.frombuffer(bytes.fromhex(p[k]), ">u2") for p in parts],
                                     np.uint16).reshape(-1, RATES, SUBSETS)
        out.whole = np.array([int(p[0], 16) for p in parts], np.uint64)
        out.scale, out.all_scale = (np.array([int(p[k], 16) for p in parts], np.int64) for k in (1, 4))
        out.subsets, out.all_subsets = subsets(2), subsets(5)
        out.few = np.array([p[3] == "1" for p in parts], bool)
        return out

    @staticmethod
    def _share(scale: np.ndarray, subsets: np.ndarray, scale2: np.ndarray, subsets2: np.ndarray) -> np.ndarray:
        """Share of the subset signatures that agree, of each pair of rows."""
        agree, either = np.zeros(len(scale)), np.zeros(len(scale))
        for a in range(RATES):
            for b in range(RATES):
                shared = (scale + a == scale2 + b)[:, None]
                x, y = subsets[:, a], subsets2[:, b]
                agree += (shared & (x == y) & (x > 0)).sum(axis=1)
                either += (shared & ((x > 0) | (y > 0))).sum(axis=1)
        return agree / np.maximum(either, 1)

    def likeness(self, other: Fingerprints) -> np.ndarray:
        """0 to 1 for each pair of rows."""
        same = (self.whole == other.whole) & (self.scale == other.scale)
        out = np.where(same, 1.0, self._share(self.scale, self.subsets, other.scale, other.subsets))
        few = np.flatnonzero(self.few | other.few)
        x, y = self.take(few), other.take(few)
        out[few] = self._share(x.all_scale, x.all_subsets, y.all_scale, y.all_subsets)
        return out


def fingerprints(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """(doc_id, fingerprint) of every row: the lexicon part alone, equal where the lexicon terms are."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in common.text_chunks(batches):
            prints = Fingerprints(common.texts_of(chunk), shared.value)
            yield pa.RecordBatch.from_arrays(
                [common.one_array(chunk.column("doc_id")), pa.array(prints.lexicon_strings(), pa.string())],
                names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """(chunk, helper, doc_id, tie, n_bytes, packed): rows in ascending doc_id, dealt in chunks.

    Chunks are ranges of ids between sampled ids, of even size. The rows with
    the id that begins a chunk are also sent to the chunk before it (and those
    with the first id to the last chunk) as helpers, so that every row finds
    the row after it in its own chunk: texts are shuffled once, compressed, and
    no partition waits for another. tie is the text's hash, the order of equal
    ids. At most about SAMPLES ids reach the driver.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    n, least, nulls = rows.agg(F.count(F.lit(1)), F.min("doc_id"),
                               F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    every = max(4, -(-n // SAMPLES))
    sample = (rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).filter("doc_id IS NOT NULL")
              .select("doc_id").toArrow())
    bounds = np.unique(sample.column("doc_id").to_numpy().astype(np.int64))[GAPS - 1::GAPS]
    first = None if nulls else least
    shared = docs.sparkSession.sparkContext.broadcast((bounds, first))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, first = shared.value
        for chunk in common.text_chunks(batches):
            ids = common.one_array(chunk.column("doc_id"))
            missing, values = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            own = np.where(missing, 0, np.searchsorted(bounds, values, side="right"))
            begins = ~missing & (own > 0)
            begins[begins] = bounds[own[begins] - 1] == values[begins]
            is_first = missing if first is None else ~missing & (values == first)
            row = np.concatenate([np.arange(len(own)), np.flatnonzero(begins), np.flatnonzero(is_first)])
            to = np.concatenate([own, own[begins] - 1, np.full(is_first.sum(), len(bounds))])
            cells, sizes = common.packed(common.texts_of(chunk))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to.astype(np.int64)), pa.array(np.arange(len(row)) >= len(own)), ids.take(take),
                 common.one_array(chunk.column("tie")).take(take), sizes.take(take), cells.take(take)],
                names=["chunk", "helper", "doc_id", "tie", "n_bytes", "packed"])

    return (rows.withColumn("tie", F.xxhash64("text"))
            .mapInArrow(deal, "chunk long, helper boolean, doc_id long, tie long, n_bytes long, packed binary")
            .repartition("chunk").sortWithinPartitions("chunk", "helper", "doc_id", "tie"))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_text(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the next."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def compare_edits(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = None  # the row that waits for the one after it
        for chunk in common.text_chunks(batches, "packed", size_column="n_bytes"):
            if pending is not None:
                chunk = pa.concat_tables([pending, chunk])
            helper = chunk.column("helper").to_numpy()
            texts = common.unpacked(common.one_array(chunk.column("packed")), common.one_array(chunk.column("n_bytes")))
            plain = common.strings(texts)
            own = np.flatnonzero(~helper[:-1])
            pending = None if helper[-1] else chunk.slice(len(helper) - 1)
            if not len(own):
                continue
            edited = [edited_text(plain[i], plain[i + 1]) for i in own.tolist()]
            prints = Fingerprints(texts, shared.value)
            mine, changed, following = prints.take(own), Fingerprints(pa.array(edited, pa.large_string()), shared.value), prints.take(own + 1)
            yield pa.RecordBatch.from_arrays([
                common.one_array(chunk.column("doc_id")).take(pa.array(own)),
                pa.array([len(plain[i]) for i in own.tolist()], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited]),
                pa.array(mine.strings()), pa.array(changed.strings()),
                pa.array(mine.likeness(changed)), pa.array(mine.likeness(following)),
            ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs).mapInArrow(run, RESULT)
