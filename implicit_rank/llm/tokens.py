"""Token ids of whole texts by a vocabulary file of the tokenizers library.

A text is cut at spaces, each distinct piece of a chunk is encoded once, and
the ids are gathered back by array operations. A cut is only made where the
tokenizer itself always ends a piece, so the ids are those of the whole text;
texts where that does not hold (white space beside a space, see
``_plain``, or one of the vocabulary's added tokens, such as ``<|endoftext|>``,
which is one id wherever it stands) are encoded whole.
"""

from __future__ import annotations

import functools
import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from implicit_rank.llm.common import strings

# White space by any definition that a tokenizer's pattern may use.
SPACE_POINTS = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C),
                0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
SPACES = "[" + "".join(map(chr, SPACE_POINTS)) + "]"
ENCODE_AT_ONCE = 4096


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


@functools.lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer as the library loads it: a special token's string within a text is its id."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


# A piece that every byte-level tokenizer cuts into letters and marks: these go
# straight to the vocabulary's model, once for each distinct run of letters.
SIMPLE = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:|*%$&#]*)")
PROBES = ["a", " a", "Straße", " Übergrößen.", "naïve,", " façade!!", " Hello", "WORLD|", " ñandú?", "ionatly;", " mot%%%", "x&&&", " w***", " x.:", "ÿ", " æ",
          " end.\nNext", "a\nb!\nC"]
KNOWN_MOST = 200_000    # runs of letters kept by a worker
PIECES_MOST = 800_000   # pieces kept by a worker, of at most PIECE_LENGTH letters
PIECE_LENGTH = 48
POOL_MOST = 1 << 23     # ids kept by a worker


def _byte_letters() -> dict[int, str]:
    """Letters as byte-level tokenizers write their UTF-8 bytes: a printable byte is
    itself, the others follow from code point 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    sign = {b: chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)} | {32: sign[32]}


BYTE_LETTERS = _byte_letters()
BYTE_SPACE = BYTE_LETTERS[32]


class Encoder:
    """Ids of pieces of text; ``way`` says how runs of letters reach the model.

    ``spaced``: as they are, with the space before them; ``lower``: in lower
    case, without it; None: everything is encoded by the whole tokenizer. A way
    is taken only if it gives the tokenizer's own ids for all PROBES. The ids
    of pieces stay in one array of the worker, so later chunks only encode
    pieces that are new; it is emptied when it is full.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.known: dict[str, list[int]] = {}
        self._empty()
        self.marks: dict[str, list[int]] = {"\n": self._whole(["\n"])[0]}
        self.way = None
        for way in ("spaced", "lower"):
            self.way = way
            if [self._lines(p) for p in PROBES] == self._whole(PROBES):
                break
            self.known.clear()
            self.way = None

    def _empty(self) -> None:
        self.pieces: dict[str, int] = {}   # piece: its place in starts and counts
        self.pool = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.used = 0

    def _store(self, lists: list[list[int]]) -> np.ndarray:
        """Places of new id lists in the pool."""
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(counts.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + total] = np.fromiter(chain.from_iterable(lists), np.uint32, total)
        first = len(self.starts)
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.used += total
        return np.arange(first, len(self.starts))

    def _whole(self, pieces: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _simple(self, space: str, letters: str, marks: str) -> list[int]:
        run = space + letters if self.way == "spaced" else letters.lower()
        ids = self.known.get(run)
        if ids is None:
            if len(self.known) >= KNOWN_MOST:
                self.known.clear()
            plain = letters.isascii()
            as_bytes = (BYTE_SPACE if run[0] == " " else "") + run.lstrip(" ") if plain else run.translate(BYTE_LETTERS)
            ids = self.known[run] = [t.id for t in self.model.tokenize(as_bytes)]
        if not marks:
            return ids
        if marks not in self.marks:
            if len(self.marks) >= KNOWN_MOST:
                self.marks = {"\n": self.marks["\n"]}
            self.marks[marks] = self._whole([marks])[0]
        return ids + self.marks[marks]

    def _lines(self, piece: str) -> list[int] | None:
        """Ids of a piece whose lines all are simple, None for any other."""
        ids: list[int] = []
        for n, line in enumerate(piece.split("\n")):
            m = SIMPLE.fullmatch(line)
            if not m or n and m[1]:
                return None
            ids = ids + self.marks["\n"] + self._simple(*m.groups()) if n else self._simple(*m.groups())
        return ids

    def without_added(self, texts: pa.Array) -> np.ndarray:
        """Texts that hold no added token; none if some are looked for in normalized text."""
        added = self.tokenizer.get_added_tokens_decoder().values()
        out = np.full(len(texts), not any(t.normalized for t in added))
        for token in added:
            out &= ~pc.match_substring(texts, token.content).to_numpy(zero_copy_only=False)
        return out

    def encode(self, pieces: list[str], n_cut: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(an array of ids, where in it each piece's ids begin, how many they are).

        The first ``n_cut`` pieces hold no added token.
        """
        if len(self.pieces) > PIECES_MOST or self.used > POOL_MOST:
            self._empty()
        at = np.fromiter(map(self.pieces.get, pieces[:n_cut], repeat(-1)), np.int64, n_cut)
        fresh = np.flatnonzero(at < 0)
        new = [pieces[k] for k in fresh.tolist()]
        at[fresh] = self._store(self._encoded(new, True))
        self.pieces.update((p, k) for p, k in zip(new, at[fresh].tolist()) if len(p) <= PIECE_LENGTH)
        tails = self._encoded(pieces[n_cut:], False)
        counts = np.fromiter(map(len, tails), np.int64, len(tails))
        ids = self.pool[:self.used]
        if tails:
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(tails), np.uint32, int(counts.sum()))])
        return (ids, np.concatenate([self.starts[at], self.used + np.cumsum(counts) - counts]),
                np.concatenate([self.counts[at], counts]))

    def _encoded(self, pieces: list[str], cut: bool) -> list[list[int]]:
        """Ids of each piece; ``cut`` pieces hold no added token."""
        found: list[list[int] | None] = [None] * len(pieces)
        if self.way and cut:
            match, simple, lines = SIMPLE.fullmatch, self._simple, self._lines
            for k, piece in enumerate(pieces):
                if (m := match(piece)):
                    found[k] = simple(*m.groups())
                elif "\n" in piece:
                    found[k] = lines(piece)
        left = [k for k, ids in enumerate(found) if ids is None]
        for at in range(0, len(left), ENCODE_AT_ONCE):
            part = left[at:at + ENCODE_AT_ONCE]
            for k, ids in zip(part, self._whole([pieces[k] for k in part])):
                found[k] = ids
        return found


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _plain(texts: pa.Array) -> np.ndarray:
    """Texts in which no white space stands beside a space, at the start or at the end."""
    beside = f"{SPACES} | {SPACES}|^ | $"
    try:
        hit = pc.match_substring_regex(texts, beside)
    except pa.ArrowInvalid:  # texts over RE2's limits
        hit = pa.array([bool(re.search(beside, t)) for t in texts.to_pylist()])
    return ~hit.to_numpy(zero_copy_only=False)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + counts[i] - 1 of all i, in a row."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - shift, counts)


def token_ids(texts: pa.Array, path: str, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row as uint32, n + 1 offsets).

    ``end_id`` is appended to each text. The empty text has no ids besides.
    """
    texts = texts.cast(pa.large_string())
    by = encoder(path)
    plain = _plain(texts) & by.without_added(texts)
    cut = pc.split_pattern(texts.filter(pa.array(plain)), " ")
    n_pieces = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    pieces = cut.flatten()
    # all pieces but a text's first are encoded with the space before them
    first = np.zeros(len(pieces), bool)
    first[(np.cumsum(n_pieces) - n_pieces)[n_pieces > 0]] = True
    heads, tails = pieces.filter(pa.array(first)).dictionary_encode(), pieces.filter(pa.array(~first)).dictionary_encode()
    distinct = strings(heads.dictionary)
    base = len(distinct)
    distinct += [" " + x for x in strings(tails.dictionary)]
    whole = np.flatnonzero(~plain)
    known = len(distinct)
    distinct += [texts[int(i)].as_py() for i in whole]
    ids, starts, counts = by.encode(distinct, known)

    code = np.empty(len(pieces), np.int64)
    code[first] = heads.indices.to_numpy(zero_copy_only=False)
    code[~first] = tails.indices.to_numpy(zero_copy_only=False).astype(np.int64) + base
    # pieces in text order: a whole text is one piece
    per_text = np.ones(len(texts), np.int64)
    per_text[plain] = n_pieces
    order = np.empty(int(per_text.sum()), np.int64)
    at = np.cumsum(per_text) - per_text
    order[spread(at[plain], n_pieces)] = code
    order[at[whole]] = known + np.arange(len(whole))
    lengths = counts[order]
    tokens = ids[spread(starts[order], lengths)]
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(per_text)]
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    if end_id is None:
        return tokens, offsets
    n = len(texts)
    out = np.empty(len(tokens) + n, np.uint32)
    stops = offsets[1:] + np.arange(n)  # where each text's end id goes
    keep = np.ones(len(out), bool)
    keep[stops] = False
    out[stops] = end_id
    out[keep] = tokens
    return out, np.concatenate([[0], stops + 1])
