"""Language identification of mixed-language text.

Every word gets a score per language: mean log-probability of its hashed
character trigrams, scaled by a word's letters, under counts learned from a
bounded sample of labelled texts. The scripts of a word's letters (ranges of
code points) narrow the languages to those seen in that script. Viterbi over
the words of a text, with a penalty for each switch of language, labels spans;
the text's language is the one with most letters in its spans, and the score
is that share of all letters.

Defined cases: null text and a text without a letter are ``und`` with score 0
and no spans; words without letters take the language around them; ties go to
the first language in code point order; null ids and repeated rows are labelled
row by row; a null lang teaches nothing; without labelled rows every text is
``und``; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from implicit_rank.llm import common, words
from implicit_rank.llm.tokens import spread

BUCKETS = 1 << 16
SAMPLE_DOCS = 20_000  # at most so many labelled texts are learned from
SWITCH = 12.0         # penalty of one change of language, in nats
UNSEEN = 50.0         # penalty of a language outside a word's scripts

# First code points of script ranges (Unicode blocks, merged) and
# the script of each; 0 is anything else.
RANGES = [0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0980, 0x0E00, 0x0E80,
          0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0]
SCRIPTS = ["Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "other", "Devanagari", "other", "Thai", "other",
           "Georgian", "Hangul", "other", "Latin", "Greek", "other", "Hiragana", "Katakana", "other", "Han", "other",
           "Hangul", "other"]
SCRIPT_NAMES = sorted(set(SCRIPTS))
SCRIPT_OF = np.array([SCRIPT_NAMES.index(s) for s in SCRIPTS], np.int8)


def _chars(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of ``^word$`` of all words in a row, n + 1 offsets), lower case."""
    framed = [f"^{x}$" for x in common.strings(pc.utf8_lower(vocabulary))]
    points = np.frombuffer("".join(framed).encode("utf-32-le"), "<u4")
    lengths = np.fromiter(map(len, framed), np.int64, len(framed))
    return points, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


@dataclass
class Shapes:
    """What the model needs of each distinct word."""
    grams: np.ndarray    # trigram buckets of all words in a row
    offsets: np.ndarray  # n + 1 offsets into grams
    letters: np.ndarray  # letters of each word
    scripts: np.ndarray  # bit set of the scripts of its letters


def shapes(vocabulary: pa.Array) -> Shapes:
    points, offsets = _chars(vocabulary)
    n = len(offsets) - 1
    if not n:
        return Shapes(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    distinct, inverse = np.unique(points, return_inverse=True)
    is_letter = np.array([chr(c).isalpha() for c in distinct.tolist()], bool)[inverse]
    script = SCRIPT_OF[np.searchsorted(RANGES, distinct, side="right") - 1][inverse]
    p = points.astype(np.uint64)
    mixed = (p[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ p[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ p[2:] * np.uint64(0x165667B19E3779F9))
    mixed = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)
    lengths = np.diff(offsets)
    inside = np.maximum(lengths - 2, 0)  # trigrams that begin in a word and end in it
    grams = mixed[spread(offsets[:-1], inside)].astype(np.int64)
    letters = np.add.reduceat(is_letter.astype(np.int64), offsets[:-1])
    scripts = np.bitwise_or.reduceat(np.where(is_letter, 1 << script.astype(np.int64), 0), offsets[:-1])
    return Shapes(grams, np.concatenate([[0], np.cumsum(inside)]), letters, scripts)


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray    # (BUCKETS, langs), float32
    allowed: np.ndarray  # (2 ** scripts bits are tested one by one) (scripts, langs) bool

    def word_scores(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words x langs scores, letters of each word)."""
        s = shapes(vocabulary)
        n, k = len(s.letters), len(self.langs)
        sums = np.zeros((n, k), np.float32)
        some = np.flatnonzero(np.diff(s.offsets) > 0)
        if len(some):
            sums[some] = np.add.reduceat(self.logp[s.grams], s.offsets[some], axis=0)
        # relative to the best language, so that long words do not dominate the sums' precision
        sums -= sums.max(axis=1, keepdims=True) if n else 0
        for bit in range(len(SCRIPT_NAMES)):
            has = (s.scripts >> bit) & 1 == 1
            if has.any() and self.allowed[bit].any():
                sums[has] -= UNSEEN * ~self.allowed[bit]
        sums[s.letters == 0] = 0
        return sums, s.letters


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", bound: int = SAMPLE_DOCS) -> Model:
    """Fit on at most ``bound`` rows of ``docs`` with a lang, taken by hash order of id and text.

    Only trigram counts per language reach the driver (at most BUCKETS rows a
    language), not texts.
    """
    picked = (docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
              .select(F.xxhash64("doc_id", text).alias("h"), "doc_id").orderBy("h", "doc_id").limit(bound).select("h").distinct())
    rows = (docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
            .select(F.xxhash64("doc_id", text).alias("h"), F.col(text).alias("text"), F.col(lang).alias("lang"))
            .join(F.broadcast(picked), "h").groupBy("h", "lang").agg(F.first("text").alias("text")))

    def count(batches):
        for chunk in common.text_chunks(batches):
            langs = common.one_array(chunk.column("lang")).dictionary_encode()
            vocabulary, codes, offsets = words.split_words(common.texts_of(chunk))
            s = shapes(vocabulary)
            of_doc = langs.indices.to_numpy(zero_copy_only=False)
            lang_of_word = np.repeat(of_doc, np.diff(offsets))
            for k, name in enumerate(langs.dictionary.to_pylist()):
                times = np.bincount(codes[lang_of_word == k], minlength=len(vocabulary))
                counts = np.bincount(s.grams, weights=np.repeat(times, np.diff(s.offsets)), minlength=BUCKETS)
                seen = np.flatnonzero(counts)
                script = [(int((times * s.letters)[(s.scripts >> b) & 1 == 1].sum())) for b in range(len(SCRIPT_NAMES))]
                bucket = np.concatenate([seen, BUCKETS + np.arange(len(SCRIPT_NAMES))])
                value = np.concatenate([counts[seen].astype(np.int64), np.array(script, np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(bucket), pa.string()), pa.array(bucket.astype(np.int32)), pa.array(value)],
                    names=["lang", "bucket", "n"])

    found = (rows.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas())
    langs = sorted(found["lang"].unique().tolist())
    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    if langs:
        counts[found["bucket"].to_numpy(), [langs.index(x) for x in found["lang"]]] = found["n"].to_numpy()
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    share = scripts / np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    smooth = grams + 0.2
    return Model(langs, np.log(smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32), share >= 0.001)


def viterbi(scores: np.ndarray, offsets: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word of every text.

    ``scores`` are the words' rows in text order. All texts step together, the
    longest first, so that the texts still running are a prefix.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = offsets[:-1][order], lengths[order]
    n, k = scores.shape
    code = np.min_scalar_type(-max(1, k))  # the least signed type that holds k codes
    path = np.zeros(n, code)
    if not n:
        return path
    back = np.zeros((n, k), code)
    running = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")  # texts with more than t words
    best = scores[starts[:running[0]]].astype(np.float64)
    last = best
    for t in range(1, int(lengths[0])):
        m = running[t]
        if m < len(best):
            best = best[:m]
        top = best.argmax(axis=1)
        change = best[np.arange(m), top][:, None] - switch
        stay = best >= change
        back[starts[:m] + t] = np.where(stay, np.arange(k), top[:, None])
        new = np.where(stay, best, change) + scores[starts[:m] + t]
        last[:m] = new
        best = last[:m]
    at = last.argmax(axis=1)  # the state after each text's last word
    for t in range(int(lengths[0]) - 1, -1, -1):
        m = running[t]
        here = starts[:m] + t
        path[here] = at[:m]
        if t:
            at[:m] = back[here, at[:m]]
    return path


def _label(model: Model, texts: pa.Array):
    """(words, offsets, language code of each word, letters of each word) of a chunk."""
    vocabulary, codes, offsets = words.split_words(texts)
    scores, letters = model.word_scores(vocabulary)
    return vocabulary, codes, offsets, viterbi(scores[codes], offsets), letters[codes]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    def run(batches):
        model = shared.value
        k = len(model.langs)
        for chunk in common.text_chunks(batches):
            n = chunk.num_rows
            total = np.zeros((n, max(k, 1)))
            if k:
                _, _, offsets, path, letters = _label(model, common.texts_of(chunk))
                doc = np.repeat(np.arange(n), np.diff(offsets))
                total = np.bincount(doc * k + path, weights=letters, minlength=n * k).reshape(n, k)
            every, best = total.sum(axis=1), total.argmax(axis=1)
            known = every > 0
            names = np.array(model.langs + ["und"], object)[np.where(known, best, k)]
            score = np.where(known, total[np.arange(n), best] / np.maximum(every, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [common.one_array(chunk.column("doc_id")), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, span, lang, n_words, text): the spans of every text, in order.

    Words of a span are joined by one space; a line end within is `` . ``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for chunk in common.text_chunks(batches):
            if not model.langs:
                continue
            vocabulary, codes, offsets, path, letters = _label(model, common.texts_of(chunk))
            known = common.strings(vocabulary)
            ids = chunk.column("doc_id").to_pylist()
            out = []
            for i, doc_id in enumerate(ids):
                lo, hi = int(offsets[i]), int(offsets[i + 1])
                if not letters[lo:hi].any():
                    continue
                cuts = [lo, *(lo + 1 + np.flatnonzero(np.diff(path[lo:hi]))).tolist(), hi]
                out += [(doc_id, s, model.langs[path[a]], b - a, " ".join(known[c] for c in codes[a:b]))
                        for s, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string()))],
                    names=["doc_id", "span", "lang", "n_words", "text"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, span int, lang string, n_words long, text string")
