"""Token files, byte-level BPE and edited counts, against the libraries on whole texts."""

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgermill.llm import byte_bpe, edit_counts, tokens_out
from ledgermill.llm.queries import BYTE_RANKS, EDIT_RANKS, WORD_TOKENIZER

PATTERN = public_tokenizers.PATTERN
TEXTS = st.text(st.sampled_from(list("aAbé ñ\n\t .,!'s3你\U0001f600 ́\x1cx<|")) | st.characters(codec="utf-8"), max_size=60)


def rank_encoder(path):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(WORD_TOKENIZER)


def test_token_files(spark, docs, rows, word_tokenizer, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    tokens_out.write_tokens(docs, folder, WORD_TOKENIZER, frame_bytes=1000)
    found = tokens_out.read_tokens(spark, folder).drop("file").collect()
    expected, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(word_tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected


def test_token_files_of_an_empty_table(spark, frame, tmp_path):
    tokens_out.write_tokens(frame([]), f"file://{tmp_path}/t", WORD_TOKENIZER)
    assert tokens_out.read_tokens(spark, f"file://{tmp_path}/t").count() == 0


class Watched(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        self.read_bytes += n
        return super().read(n)


def packed(documents, frame_bytes):
    out = io.BytesIO()
    writer = tokens_out.FrameWriter(out, 2, frame_bytes)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, "<u2").tobytes())
    writer.close()
    return out.getvalue()


def test_reader_fetches_only_the_frames_of_a_document():
    draw = random.Random(1)
    documents = [(k, [draw.randrange(50_000) for _ in range(draw.randrange(1, 900))]) for k in range(300)]
    data = packed(documents, 2048)
    for k in (0, 17, 299):
        source = Watched(data)
        reader = tokens_out.FrameReader(source, len(data))
        before = source.read_bytes
        assert reader.get(k).tolist() == documents[k][1]
        assert source.read_bytes - before < 8192 < len(data) / 20
    assert [(i, ids.tolist()) for i, _, ids in reader.documents()] == documents
    with pytest.raises(KeyError):
        reader.get(300)


def test_reader_refuses_a_damaged_frame():
    data = bytearray(packed([(1, range(500)), (2, range(500))], 512))
    data[20] ^= 1
    with pytest.raises(Exception, match="damaged|decompress|corrupt|checksum|Data"):
        list(tokens_out.FrameReader(io.BytesIO(data), len(data)).documents())


SPECIAL = st.sampled_from(["<|endoftext|>", "a<|endoftext|>", "<|startoftext|>.", "<|ENDOFTEXT|>", "it's!!", "Ünï.»", "x_"])


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS | st.lists(SPECIAL, max_size=4).map(" ".join), min_size=1, max_size=4))
def test_word_pieces_encode_as_whole_texts(texts):
    own = tokens_out.encoder(WORD_TOKENIZER)
    for text, ids in zip(texts, own.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, own.kind).tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_memory_of_pieces_is_bounded():
    own = tokens_out.Encoder(WORD_TOKENIZER, limit=100)
    for k in range(20):
        text = " ".join(f"p{k}q{j}" for j in range(20)) + " often. again"
        ids = np.frombuffer(own.encode([text.encode()])[0], own.kind).tolist()
        assert ids == own.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(own.known) <= 60 and len(own.older) <= 60


def test_round_trip(docs, rows):
    plain = rank_encoder(BYTE_RANKS)
    expected = []
    for doc_id, text in rows:
        ids = plain.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    found = [tuple(r) for r in byte_bpe.round_trip(docs, BYTE_RANKS, PATTERN).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_encode_then_decode(docs, rows):
    encoded = byte_bpe.encode(docs, BYTE_RANKS, PATTERN)
    found = byte_bpe.decode(encoded, BYTE_RANKS, PATTERN).collect()
    assert sorted(map(tuple, found), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


@pytest.fixture(scope="module")
def byte_models():
    return byte_bpe.ByteBpe(BYTE_RANKS, PATTERN), rank_encoder(BYTE_RANKS)


def test_every_character_encodes_as_by_ranks(byte_models):
    bpe, plain = byte_models
    for start in range(0, 0x30000, 0x400):
        text = " ".join(chr(c) + "a" for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000)
        assert bpe.encode(text)[0].tolist() == plain.encode_ordinary(text), hex(start)


def test_texts_encode_as_by_ranks(byte_models):
    bpe, plain = byte_models

    @settings(max_examples=300, deadline=None)
    @given(TEXTS)
    def check(text):
        ids, joined = bpe.encode(text)
        assert ids.tolist() == plain.encode_ordinary(text)
        assert joined == ",".join(map(str, ids.tolist()))
        assert bpe.decode_bytes(ids) == text.encode()
        assert not text or bpe.ends(ids)[-1] == len(text)

    check()


def test_signs_make_no_pieces_of_their_own_with_words():
    bpe, plain = byte_bpe.ByteBpe(BYTE_RANKS, PATTERN, limit=4), rank_encoder(BYTE_RANKS)
    text = "some words, some more: words. More some"
    assert bpe.encode("some words, some words.")[0].tolist() == plain.encode_ordinary("some words, some words.")
    assert set(bpe.pieces) == {"some", " words", ",", " some", "."}
    assert bpe.encode(text)[0].tolist() == plain.encode_ordinary(text)
    assert " words," not in bpe.pieces and len(bpe.pieces) <= 4 + 2  # forgotten, but for what the text brought in


def test_offsets_of_split_characters(byte_models):
    bpe, _ = byte_models
    ids, _ = bpe.encode("a\U00012345b")
    assert len(ids) > 3 and bpe.ends(ids)[0] == 1 and bpe.ends(ids)[-1] == 3
    assert bpe.ends(ids)[1] == 1  # bytes of an open character complete none


def edited(text, edits):
    for position, deleted, inserted in edits:
        p = min(max(position or 0, 0), len(text))
        text = text[:p] + (inserted or "") + text[p + max(deleted or 0, 0) :]
    return text


def test_edited_counts(spark, rows):
    plain, draw = rank_encoder(EDIT_RANKS), random.Random(3)
    made = []
    for k, (_, text) in enumerate(rows * 3):
        edits = [
            (draw.randrange(len(text or "") + 3), draw.choice([0, 1, 7, 60, 500]), draw.choice(["", " ", "\n", "it's", " new words ", "  "]))
            for _ in range(draw.randrange(5))
        ]
        made.append((k, text, edits if k % 7 else None))
    docs = spark.createDataFrame(made, f"doc_id long, text string, edits {edit_counts.EDITS}")
    found = {r.doc_id: r for r in edit_counts.recounted(docs, EDIT_RANKS, PATTERN, leaf_chars=20).collect()}
    trees = edit_counts.apply_edits(edit_counts.build(docs, EDIT_RANKS, PATTERN, 20), EDIT_RANKS, PATTERN, 20)
    stored = {r.doc_id: r for r in trees.collect()}
    for k, text, edits in made:
        after = edited(text or "", edits or [])
        assert found[k].n_tokens == len(plain.encode_ordinary(text or ""))
        assert found[k].n_tokens_edited == len(plain.encode_ordinary(after)) == stored[k].tokens[1]
        assert "".join(stored[k].leaves) == after and found[k].n_chars_edited == len(after)


def test_an_edit_encodes_its_surroundings_only(rows):
    counter = edit_counts.Counter(EDIT_RANKS, PATTERN)
    text = next(t for i, t in rows if i == 10)
    tree = edit_counts.Tree.of(text, counter, 160)
    tree.edit(len(text) // 2, 3, "new", counter, 160)
    assert 0 < tree.reencoded < 600 < len(text) / 20
