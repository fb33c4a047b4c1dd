"""Words of text chunks as arrays: every distinct word once, plus codes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each word, n + 1 offsets of the texts).

    Words are what white space separates (any Unicode white space); a line end
    counts as the word ``.`` so that it also ends a clause.
    """
    lines = pc.replace_substring(texts.cast(pa.large_string()), "\n", " . ")
    lists = pc.utf8_split_whitespace(lines)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False)
    # a text that begins or ends with white space has an empty word there
    empty = np.flatnonzero(pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    if len(empty):
        keep = codes != empty[0]
        kept = np.concatenate([[0], np.cumsum(keep)])
        codes, offsets = codes[keep], kept[offsets]
    return words.dictionary, codes, offsets
