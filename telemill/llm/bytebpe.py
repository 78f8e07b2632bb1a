"""Byte-level BPE through sentencepiece: the ranks of a vocabulary as a sentencepiece model."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemill.llm.shared import mapped, pick, whole

#: Byte b is written as the character of this code point plus b, a letter for every byte.
FIRST_LETTER = 0x100
LETTERS = {byte: chr(FIRST_LETTER + byte) for byte in range(256)}
#: Pre-tokens whose ids a task remembers, at most.
REMEMBERED = 400_000
#: Pre-tokens of texts that are encoded together.
PRE_TOKENS_A_TURN = 1 << 19


@cache
def vocabulary(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model that merges as the ranks do.

    Sentencepiece merges the adjacent pair whose piece scores highest, the leftmost of equals, so
    a score of minus the rank gives the merges of the ranks. Bytes are written as letters, texts
    are taken as they are, and the piece of rank r has id r.
    """
    from sentencepiece import sentencepiece_model_pb2 as proto

    made = proto.ModelProto()
    for rank, (token, found) in enumerate(sorted(ranks.items(), key=lambda item: item[1])):
        if rank != found:
            raise ValueError(f"ranks must be 0 up without gaps; {rank} is missing")
        made.pieces.add(piece=token.decode("latin-1").translate(LETTERS), score=-float(rank))
    made.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    spec = made.trainer_spec
    spec.model_type, spec.vocab_size = proto.TrainerSpec.BPE, len(made.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(ranks), -1, -1, -1
    rule = made.normalizer_spec
    rule.name = "identity"
    rule.add_dummy_prefix = rule.remove_extra_whitespaces = rule.escape_whitespaces = False
    return made.SerializeToString()


@cache
def _processor(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=model(vocabulary(path)))


@cache
def _newer():
    """Letters and digits that this process's ``regex`` knows and tiktoken, which has its own
    edition of Unicode, does not, and the first of them; None if there are none."""
    import regex
    import tiktoken

    bytes_only = {bytes([byte]): byte for byte in range(256)}
    rule = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=bytes_only, special_tokens={})
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    known = bytes(rule.encode_ordinary(every)).decode()
    newer = sorted(map(ord, set(regex.findall(r"[\p{L}\p{N}]", every)).difference(known)))
    # As ranges, which are searched many times faster than single characters.
    opens = [c for c, before in zip(newer, [-1, *newer]) if c != before + 1]
    closes = [c for c, after in zip(newer, [*newer[1:], -1]) if c != after - 1]
    ranges = "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(opens, closes))
    return (re.compile(f"[{ranges}]"), chr(newer[0])) if newer else None


def pre_tokens(text: str, matcher) -> list[str]:
    """The matches of a compiled pattern, with letters and digits as tiktoken knows them."""
    newer = None if text.isascii() else _newer()
    if newer is None or max(text) < newer[1] or not newer[0].search(text):
        return matcher.findall(text)
    return [text[slice(*match.span())] for match in matcher.finditer(newer[0].sub("\uffff", text))]


class PreTokenIds(dict):
    """The ids of pre-tokens as bytes, four native ones each; forgets all when full."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self._processor = _processor(path)

    def learn(self, pre_tokens: set[str]) -> None:
        if len(self) > REMEMBERED:
            self.clear()
        unknown = [x for x in pre_tokens if x not in self]
        letters = [x.encode().decode("latin-1").translate(LETTERS) for x in unknown]
        found = self._processor.encode(letters, num_threads=1) if letters else []
        self.update((x, np.array(ids, np.int32).tobytes()) for x, ids in zip(unknown, found))


def encode(
    docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The ids of every text: columns ``doc_id, ids``.

    A text is cut into the matches of ``pattern``, its pre-tokens, and each is encoded by itself.
    What no match covers is left out. A null text is an empty one and has no ids. A task encodes
    a pre-token once and remembers it; what it remembers is bounded.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        matcher, known = regex.compile(pattern), PreTokenIds(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            at = 0
            while at < len(keys):
                turn, size = [], 0
                while at + len(turn) < len(keys) and size < PRE_TOKENS_A_TURN:
                    turn.append(pre_tokens(texts[at + len(turn)].as_py(), matcher))
                    size += len(turn[-1])
                known.learn(set().union(*turn))
                ids = [b"".join(map(known.__getitem__, found)) for found in turn]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                yield pa.record_batch([keys[at : at + len(turn)], lists], names=["doc_id", "ids"])
                at += len(turn)

    rows = pick(docs, doc_id=F.col(key).cast("long"), text=whole(text))
    return mapped(rows, work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The bytes of ``ids`` by the inverse mapping: columns ``doc_id, ids, decoded``. Null ids
    give null; an id outside the vocabulary is an error."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in vocabulary(path).items()}
        for batch in batches:
            found = [
                None if ids is None else b"".join(map(tokens.__getitem__, ids.values.to_numpy().tolist()))
                for ids in batch.column(1)
            ]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.binary())], names=["doc_id", "ids", "decoded"])

    return mapped(encoded.select("doc_id", "ids"), work, "doc_id long, ids array<int>, decoded binary")
