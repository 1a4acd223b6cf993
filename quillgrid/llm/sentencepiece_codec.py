"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model's protobuf is parsed here; normaliser, metaspace marker, piece scores
(or the merges that they imply) and byte fallback are rebuilt in the backend.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _store, _word_ids

MARK = "▁"
#: Flags of a chunk: the SentencePiece library gives the same ids; they decode to the chunk.
SAME, BACK = 1, 2

# Fixed values of the model format: kinds of model and of piece.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None and kind == 2 else size
        if size is None or at + size > len(data):
            raise ValueError("not a SentencePiece model")
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What is read from the model file."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def read(cls, path: str) -> Model:
        with open(path, "rb") as f:
            data = f.read()
        out = cls()
        for number, value in wire_fields(data):
            if number == 1:
                part = dict(wire_fields(value))
                out.pieces.append((part[1].decode("utf-8"), struct.unpack("<f", part.get(2, b"\0\0\0\0"))[0], part.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(wire_fields(value))
                out.kind = trainer.get(3, UNIGRAM)
                out.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                norm = dict(wire_fields(value))
                out.charsmap = norm.get(2, b"")
                out.dummy_prefix, out.squeeze, out.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        if out.kind not in (UNIGRAM, BPE):
            raise ValueError(f"models of kind {out.kind} are not supported")
        return out


class Codec:
    """Encodes and decodes as the SentencePiece model at path does."""

    def __init__(self, path: str, verify: bool = True):
        _word_ids.bounded_threads()
        from tokenizers import Tokenizer, models, normalizers

        m = self.model = Model.read(path)
        vocab = {p: i for i, (p, _, kind) in enumerate(m.pieces)}
        usable = {p for p, _, kind in m.pieces if kind in (NORMAL, USER)}
        unknown = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), None)
        if m.kind == BPE:
            merges = []
            for piece, score, kind in sorted((p for p in m.pieces if p[2] in (NORMAL, USER)), key=lambda p: (-p[1], vocab[p[0]])):
                merges += [(piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in usable and piece[k:] in usable]
            self.backend = Tokenizer(models.BPE(vocab, merges, unk_token=m.pieces[unknown][0] if unknown is not None else None, fuse_unk=True, byte_fallback=m.byte_fallback))
        else:
            self.backend = Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], unknown, m.byte_fallback))
        self.normal = normalizers.Precompiled(m.charsmap) if m.charsmap else None
        #: Whether no piece has a mark after another character: then no token reaches over a blank.
        self.chunked = all(MARK not in p.lstrip(MARK) for p in usable)
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode("utf-8") for p, _, kind in m.pieces]
        if unknown is not None:
            self.bytes[unknown] = " ⁇ ".encode()
        self.leads = np.array([p.startswith(MARK) for p, _, _ in m.pieces])
        self.judge = None
        if verify:
            import sentencepiece

            self.judge = sentencepiece.SentencePieceProcessor(model_file=path)

    def normalise(self, text: str) -> str:
        """With blanks, not marks; the dummy prefix included."""
        if self.normal is not None:
            text = self.normal.normalize_str(text)
        if MARK in text:
            text = text.replace(MARK, " ")
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return " " + text if text and self.model.dummy_prefix else text

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of normalised texts, in one multithreaded batch."""
        return [e.ids for e in self.backend.encode_batch_fast([t.replace(" ", MARK) for t in texts], add_special_tokens=False)]

    def _flags(self, texts: list[str], ids: list[list[int]]) -> list[int]:
        """Flags of normalised texts, held against the SentencePiece library."""
        lead = int(self.model.dummy_prefix)
        theirs = ids if self.judge is None else self.judge.encode([t[lead:] for t in texts])
        out = []
        for text, mine, other in zip(texts, ids, theirs, strict=True):
            # a text without the prefix or a lone blank can't be asked for: the library gives an empty text no prefix
            fair = text.startswith(" ") and text != " " if lead else True
            out.append(SAME * (not fair or mine == other) + BACK * (b"".join(map(self.bytes.__getitem__, mine)) == text.encode("utf-8")))
        return out

    def chunks(self, text: str) -> list[str]:
        """A normalised text's chunks, which no token reaches over."""
        return re.findall(" +[^ ]*|[^ ]+", text) if self.chunked else [text] if text else []

    def checked(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        """(ids as little-endian 32-bit numbers, whether every chunk agrees with the SentencePiece library, whether decoding gives the text again)."""
        normal = [self.normalise(t) for t in texts]
        plain = [self.chunked and t.startswith(" ") and t[-1] != " " and "  " not in t for t in normal]  # a blank before each word and no more
        parts, cut = _word_ids.split(pa.array([t[1:] for t, p in zip(normal, plain, strict=True) if p], pa.large_string()))
        coded = parts.dictionary_encode()
        flat, count, flags = _word_ids.learn(coded.dictionary, self._ids, self.leads, self._flags, SAME | BACK)
        odd = [self.chunks(t) for t, p in zip(normal, plain, strict=True) if not p]
        more = list(dict.fromkeys(c for chunks in odd for c in chunks))
        ids, place = self._ids(more), {c: len(count) + i for i, c in enumerate(more)}
        rest, many = _word_ids.flattened(ids)
        numbers = np.concatenate([coded.indices.to_numpy(), np.array([place[c] for chunks in odd for c in chunks], dtype=np.int64)])
        count = np.concatenate([count, many])
        flags = np.concatenate([flags, np.array(self._flags(more, ids), dtype=np.uint8)])[numbers]
        flat, begin = _word_ids.gather(np.concatenate([flat, rest]), count, numbers)
        bounds = np.concatenate([cut, cut[-1] + np.cumsum([len(c) for c in odd], dtype=np.int64)])
        lacks = np.concatenate([[0], np.cumsum(flags & SAME == 0)]), np.concatenate([[0], np.cumsum(flags & BACK == 0)])
        all_flags = SAME * (np.diff(lacks[0][bounds]) == 0) + BACK * (np.diff(lacks[1][bounds]) == 0)
        raw, at = flat.astype("<u4").tobytes(), (4 * begin[bounds]).tolist()
        found = list(zip((raw[s:e] for s, e in zip(at, at[1:], strict=False)), all_flags.tolist(), strict=True))
        regular, rest = iter(found[: len(cut) - 1]), iter(found[len(cut) - 1 :])
        out = []
        lead = int(self.model.dummy_prefix)
        for text, made, p in zip(texts, normal, plain, strict=True):
            ids, flag = next(regular if p else rest)
            back = text == (made[lead:] if made.startswith(" ") else made) if flag & BACK else self.decode(np.frombuffer(ids, dtype="<u4")) == text
            out.append((ids, bool(flag & SAME), back))
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """(ids, parity) of checked()."""
        return [x[:2] for x in self.checked(texts)]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One for each process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_documents(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: id, ids (array), parity, round_trip.

    parity: whether the SentencePiece library gives the same ids. round_trip:
    whether decoding gives the text again. A null or empty text has no ids and
    both hold. Repeated rows stay repeated; only id and text are read.
    """
    _store.prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model)
        for batch in _word_ids.units(batches, 1):
            found = tool.checked(batch.column(1).to_pylist())
            ids = [np.frombuffer(x[0], dtype="<u4").astype(np.int32) for x in found]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))), *(pa.array([x[k] for x in found], pa.bool_()) for k in (1, 2))], ["id", "ids", "parity", "round_trip"])

    return df.select(_store.id_of(id_col).alias("id"), _store.text_of(text_col).alias("text")).mapInArrow(_store.resting(run), "id long, ids array<int>, parity boolean, round_trip boolean").withColumnRenamed("id", id_col)


def digest_documents(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode_documents with the ids as their number and SHA-256 (little-endian 32-bit numbers)."""
    _store.prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model)
        for batch in _word_ids.units(batches, 1):
            rows = [(len(ids) // 4, hashlib.sha256(ids).hexdigest(), same, back) for ids, same, back in tool.checked(batch.column(1).to_pylist())]
            kinds = (pa.int64(), pa.string(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], ["id", "n_tokens", "ids_sha256", "parity", "round_trip"])

    return df.select(_store.id_of(id_col).alias("id"), _store.text_of(text_col).alias("text")).mapInArrow(_store.resting(run), "id long, n_tokens long, ids_sha256 string, parity boolean, round_trip boolean").withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of arrays of ids; null and empty arrays give the empty text."""
    _store.prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model)
        for batch in batches:
            texts = [tool.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return df.select(_store.id_of(id_col).alias("id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids")).mapInArrow(_store.resting(run), "id long, text string").withColumnRenamed("id", id_col)
