"""Byte-level BPE with a rank file: encoding by the tokenizers library over Arrow batches, decoding by the byte table.

The rank file becomes a BPE model over the byte-to-character mapping: every way to put a token together from two others
is a merge, in the order of ranks; a piece that is itself a token is taken whole. The result equals that of a rank-based
encoder. A text is cut where the split pattern must cut whatever stands further off (before a single space or line feed
between visible characters, after such a line feed, and between an ASCII letter and an ASCII character that is none); the
pieces are encoded alone and remembered, and those that a text brings in new are encoded in one call.

Decoding looks every id up in the byte table. A character can be split over tokens: the decoder keeps the open bytes and
gives the character to the token that completes it, and bytes that never become a character read as U+FFFD.

Defined results: null and empty texts have no ids; bytes that are not UTF-8 are encoded as U+FFFD; null ids and repeated
rows stay, one row out per row in; other columns are ignored.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.common import batches, decoded, id_and_bytes, released, slices

SAFE_CUT = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
# The pieces between certain cuts: mostly a word, found without looking for the other cuts; else up to the next of any sort.
PIECE = re.compile(
    r" ?[A-Za-z]++(?![^\x00-\x7F])"
    r"|(?s:.+?)(?:(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)|(?<=[A-Za-z])(?=[\x00-@\[-`{-\x7F])|\Z)"
)
ROUND = 50_000  # pieces looked up, and if new encoded, at once
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])
_DECODED = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def byte_characters() -> list[str]:
    """The public byte-to-character mapping: printable bytes are themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, path: str, pattern: str, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        characters = byte_characters()
        shown = {token: "".join(characters[b] for b in token) for token in ranks}
        merges = [
            (shown[token[:i]], shown[token[i:]])
            for token in sorted(ranks, key=ranks.get)
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        model = models.BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        ])
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.shown = list(map(str, range(len(self.table))))
        self.pieces: dict[str, bytes] = {}
        self.limit = limit

    def remember(self, pieces: list[str]) -> None:
        """Encode pieces that are not known, in one call; all others are forgotten where there would be too many."""
        if len(self.pieces) + len(pieces) > self.limit:
            self.pieces.clear()
        for piece, found in zip(pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)):
            self.pieces[piece] = array("i", found.ids).tobytes()

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids, and the same ids as decimals joined by commas."""
        pieces, found = PIECE.findall(text), []
        for part in (pieces[start : start + ROUND] for start in range(0, len(pieces), ROUND)):
            known = list(map(self.pieces.get, part))
            if None in known:
                self.remember(list({p for p, x in zip(part, known) if x is None}))
                known = [self.pieces[p] if x is None else x for p, x in zip(part, known)]
            found += known
        ids = np.frombuffer(b"".join(found), "<i4")
        return ids, ",".join(map(self.shown.__getitem__, ids.tolist()))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))

    def ends(self, ids: np.ndarray) -> list[int]:
        """For each token the number of whole characters that the tokens up to it complete."""
        reader, total, found = codecs.getincrementaldecoder("utf-8")("replace"), 0, []
        for i in ids.tolist():
            total += len(reader.decode(self.table[i]))
            found.append(total)
        if found:
            found[-1] += len(reader.decode(b"", True))
        return found


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, ends (characters complete after each token: the offsets of the tokens in the text)."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in rows:
            ids = [bpe.encode(decoded(t.as_py()))[0] for t in batch.column("text")]
            yield batches({"doc_id": batch.column("doc_id"), "ids": ids, "ends": [bpe.ends(x) for x in ids]}, _ENCODED)

    return id_and_bytes(docs).mapInArrow(released(run), "doc_id long, ids array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids read as none."""

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in rows:
            ids = (np.array(x.as_py() or [], "<i4") for x in batch.column("ids"))
            yield batches({"doc_id": batch.column("doc_id"), "text": [decoded(bpe.decode_bytes(x)) for x in ids]}, _DECODED)

    return encoded.select("doc_id", "ids").mapInArrow(released(run), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode, decode the ids, and return doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked for."""
    schema = _DIGESTS.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _DIGESTS

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in (s for part in rows for s in slices(part)):
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for text in batch.column("text"):
                ids, joined = bpe.encode(decoded(text.as_py()))
                columns["n_tokens"].append(len(ids))
                columns["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                columns["decoded_sha256"].append(hashlib.sha256(bpe.decode_bytes(ids)).hexdigest())
                if with_ids:
                    columns["ids"].append(ids)
            yield batches(columns, schema)

    ids = ", ids array<int>" if with_ids else ""
    return id_and_bytes(docs).mapInArrow(released(run), f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{ids}")
