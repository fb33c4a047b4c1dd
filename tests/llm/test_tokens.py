"""Packing and token files against the plain encoding of whole texts."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from implicit_rank.llm import arrowfile, common, pack, tokens

from .conftest import ODD

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def plain(name, text):
    return tokens.load(tokens.vocabulary(name)).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab Z1 \n.,'\té 　́ñ!|<>漢", max_size=30), max_size=6))
def test_ids_are_those_of_whole_texts(name, texts):
    texts = [*texts, "<|endoftext|> is text", "plain words, only these"]
    ids, offsets = tokens.token_ids(pa.array(texts, pa.string()), tokens.vocabulary(name), 2)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain(name, t) + [2] for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_added_tokens_are_one_id(name):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(tokens.vocabulary(name))
    texts = ["one <|endoftext|> two", "a b<|endoftext|>c d", "<|endoftext|>", "<|startoftext|> words <|ENDOFTEXT|>", "<|endoftext|", "plain words"]
    ids, offsets = tokens.token_ids(pa.array(texts, pa.string()), tokens.vocabulary(name), 2)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [
        own.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert ids[offsets[2]:offsets[3]].tolist() == [own.token_to_id("<|endoftext|>"), 2]


def test_pack_is_concatenate_and_cut(odd):
    name = "word_bpe_49k.json"
    pieces = pack.pack(odd.selectExpr("*", "1 AS start", "2 AS part"), tokens.vocabulary(name), seq_len=64, with_ids=True)
    rows = pieces.toPandas().sort_values(["sequence_id", "offset"])
    at = 0
    for r in rows.itertuples():  # one gapless stream
        assert r.sequence_id * 64 + r.offset == at and 0 < r.length <= 64 - r.offset
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        at += r.length
    found = {}
    for r in rows.sort_values("start", kind="stable").itertuples():
        found.setdefault((r.doc_id, r.doc_tokens), []).append(np.frombuffer(r.ids, "<u4"))
    want = sorted((plain(name, t or "") + [2] for _, t in ODD), key=len)
    assert at == sum(map(len, want))
    eights = [r for r in rows.itertuples() if r.doc_id == 8]
    text8 = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(eights, key=lambda r: r.start)])
    assert text8.tolist() == plain(name, ODD[7][1]) + [2]
    whole = pack.sequences(pieces).toPandas().set_index("sequence_id")
    assert (whole["n_tokens"].sort_index()[:-1] == 64).all()
    assert all(len(i) == 4 * n for i, n in zip(whole["ids"], whole["n_tokens"]))


def test_pack_of_nothing(empty):
    assert pack.pack(empty, tokens.vocabulary("word_bpe_49k.json")).count() == 0


def test_token_files_round_trip(shipped, odd, empty):
    name = "byte_bpe_50k.json"
    manifest = arrowfile.write(odd.selectExpr("*", "1 AS path"), tokens.vocabulary(name), seq_len=16)
    rows = arrowfile.read(shipped, manifest).toPandas().sort_values("start")
    tie = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t or "", 42)).astype(np.int64))
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))
    at = 0
    for r, (doc_id, text) in zip(rows.itertuples(), order, strict=True):
        ids = plain(name, text or "") + [2]
        assert (None if r.doc_id != r.doc_id else r.doc_id) == doc_id
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    for part in manifest.collect():
        file = arrowfile.TokenFile(part["path"])
        n = -(-part["n_tokens"] // 16)
        ids, mask = file.sequence(n - 1)
        assert len(ids) == len(mask) == 16
        assert mask.sum() == (part["n_tokens"] - 1) % 16 + 1 and not ids[mask == 0].any()
        assert not file.batch(0).flags.owndata  # a view of the mapped file
    assert arrowfile.read(shipped, arrowfile.write(empty, tokens.vocabulary(name))).count() == 0
    with pytest.raises(ValueError):
        arrowfile.write(odd, tokens.vocabulary(name), seq_len=12)


def test_text_chunks_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 50, 3, 3, 3)] + [None], "k": list(range(7))})
    chunks = list(common.text_chunks(iter([batch, batch]), limit=10))
    assert [k for c in chunks for k in c.column("k").to_pylist()] == list(range(7)) * 2
    assert max(c.num_rows for c in chunks) < 7


def test_pieces_kept_across_chunks(monkeypatch):
    """Ids do not depend on which pieces a worker knows, nor on when it forgets them."""
    import random

    import pyarrow as pa

    path = tokens.vocabulary("byte_bpe_50k.json")
    rng = random.Random(8)
    words = ["the", "naïve", "Straße.", "x" * 60, "end\nNext", "<|endoftext|>", "漢字", "don't", "a,b", "WORLD", ""]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    plain = tokens.load(path)
    monkeypatch.setattr(tokens, "PIECES_MOST", 5)
    for at in (0, 20, 40, 0):
        part = texts[at:at + 20]
        ids, offsets = tokens.token_ids(pa.array(part), path)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in part]
