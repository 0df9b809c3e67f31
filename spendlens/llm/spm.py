"""SentencePiece encoding and decoding on the tokenizers library.

``parse_model`` reads the model's protobuf fields directly.  ``Codec`` rebuilds
the model as a tokenizer: the normaliser (compiled character map, white space
rules, dummy prefix, marker for blanks), unigram scores or the merges that the
scores of a merge vocabulary imply, and byte fallback.  Encoding runs on batches
(``encode_batch_fast``, which uses several threads unless the environment limits
them).  In vocabularies whose pieces carry the marker only in front, no piece
reaches from one marked word into the next; then each distinct segment is
encoded once (``segments``), which changes no id.  Other models are encoded text
by text.

Parity: the result says for each document whether the sentencepiece library gives
the same ids.  Where pieces cannot cross words in a merge model that leaves the
text as it is, every distinct segment is compared when it is encoded; for all other
models (unigram scores, a character map, removed blanks) every whole text is.
Segmentations of equal score are told apart by the tokenizers library's own rule,
which on long texts, whose 32-bit sums round, may differ from the other library's;
the flag is false there.  Every text is decoded again, too.

Texts are handled in slices of ``SLICE_CHARS`` characters, so a worker holds the
segments of one slice, not those of a whole batch.

Defined results: null and empty texts have no ids; repeated rows have equal ids;
a text that holds the marker character itself decodes to blanks there, as with
the sentencepiece library; an empty table gives an empty table.  Models with
user-defined symbols are refused.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .chunks import by_bytes
from .segments import SegmentEncoder
from .tables import fresh, read

MARK = "▁"
#: Characters of texts whose segments are held at a time, distinct segments kept.
SLICE_CHARS, HELD = 1 << 20, 250_000
# Fixed values of the model format: piece types, model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Piece:
    text: str = ""
    score: float = 0.0
    type: int = NORMAL


@dataclass
class Model:
    pieces: list[Piece] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    whitespace_suffix: bool = False


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message; bytes, int or 4/8-byte raw values."""
    at = 0

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value
    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            if kind == 2:
                size = varint()
            if size is None or at + size > len(raw):
                raise ValueError("not a SentencePiece model")
            yield tag >> 3, raw[at:at + size]
            at += size


def parse_model(raw: bytes) -> Model:
    # Field numbers of the public model format.
    m = Model()
    for number, value in _fields(raw):
        if number == 1:
            p = Piece()
            for n, v in _fields(value):
                if n == 1:
                    p.text = v.decode("utf-8")
                elif n == 2:
                    p.score = struct.unpack("<f", v)[0]
                elif n == 3:
                    p.type = v
            m.pieces.append(p)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    m.model_type = v
                elif n == 35:
                    m.byte_fallback = bool(v)
                elif n == 24:
                    m.whitespace_suffix = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.add_dummy_prefix = bool(v)
                elif n == 4:
                    m.remove_extra_whitespaces = bool(v)
                elif n == 5:
                    m.escape_whitespaces = bool(v)
    return m


def merges(pieces: list[Piece]) -> list[tuple[str, str]]:
    """Merges of a merge vocabulary: every split of a piece into two pieces, best score first."""
    score = {p.text: p.score for p in pieces if p.type == NORMAL}
    found = []
    for order, p in enumerate(pieces):
        if p.type == NORMAL:
            for cut in range(1, len(p.text)):
                left, right = p.text[:cut], p.text[cut:]
                if left in score and right in score:
                    found.append((-p.score, order, cut, left, right))
    return [(left, right) for _, _, _, left, right in sorted(found)]


_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, verify: bool = True):
        from tokenizers import Tokenizer, models, normalizers
        with open(path, "rb") as f:
            raw = f.read()
        self.model = m = parse_model(raw)
        if any(p.type == USER_DEFINED for p in m.pieces):
            raise ValueError("models with user-defined symbols are not supported")
        if m.whitespace_suffix or not m.escape_whitespaces:
            raise ValueError("only models with blanks marked in front of words are supported")
        unk = next(i for i, p in enumerate(m.pieces) if p.type == UNKNOWN)
        if m.model_type == BPE:
            core = models.BPE(vocab={p.text: i for i, p in enumerate(m.pieces)}, merges=merges(m.pieces),
                              unk_token=m.pieces[unk].text, fuse_unk=True, byte_fallback=m.byte_fallback)
        elif m.model_type == UNIGRAM:
            low = min(p.score for p in m.pieces if p.type == NORMAL)
            core = models.Unigram([(p.text, p.score if p.type == NORMAL else low - 1e4) for p in m.pieces],
                                  unk_id=unk, byte_fallback=m.byte_fallback)
        else:
            raise ValueError(f"model type {m.model_type} is not supported")
        self.tokenizer = Tokenizer(core)
        self.charsmap = normalizers.Precompiled(m.charsmap) if m.charsmap else None
        texts = [p.text for p in m.pieces if p.type == NORMAL]
        self.independent = not any(MARK in t.lstrip(MARK) for t in texts)
        self.bytes = [self._spelled(p) for p in m.pieces]
        self.unk = unk
        self.other = None
        if verify:
            import sentencepiece
            self.other = sentencepiece.SentencePieceProcessor(model_proto=raw)
        # Whether comparing each distinct segment says as much as comparing the whole text.
        self.by_segment = (self.independent and m.model_type == BPE and not m.charsmap and not m.remove_extra_whitespaces)
        self.differing: set[str] = set()          # segments of the store on which the libraries differ
        # Lengths in bytes of the normalised text.
        weight = np.array([1 if p.type == BYTE else len(p.text.encode()) for p in m.pieces], np.int64)
        # Ids of unknown characters have no length of their own: without byte fallback nothing is joined.
        joins = self.independent and m.byte_fallback and m.add_dummy_prefix
        self.encoder = SegmentEncoder(self._encode_segments, weight, lambda x: len(x.encode("utf-8")),
                                      lambda x: joins and x[0] == MARK and x[-1] != MARK, held=HELD, on_clear=self.differing.clear)

    @staticmethod
    def _spelled(p: Piece) -> bytes:
        if p.type == BYTE:
            return bytes([int(p.text[3:5], 16)])
        if p.type == CONTROL:
            return b""
        if p.type == UNKNOWN:
            return " ⁇ ".encode()
        return p.text.replace(MARK, " ").encode()

    def normalise(self, text: str) -> str:
        """The text as the model sees it, with the marker for blanks."""
        if self.charsmap is not None:
            text = self.charsmap.normalize_str(text)
        if self.model.remove_extra_whitespaces:
            text = re.sub(" {2,}", " ", text.strip(" "))
        if text and self.model.add_dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def _encode_segments(self, segments: list[str]) -> list[list[int]]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]
        if self.other is not None and self.by_segment:
            # The library puts the dummy prefix in front itself.
            drop = 1 if self.model.add_dummy_prefix else 0
            theirs = self.other.encode([s[drop:].replace(MARK, " ") for s in segments])
            for text, a, b in zip(segments, ids, theirs):
                if text == MARK and drop:   # alone it would be an empty text; behind a word it is not
                    b = self.other.encode("a ")[len(self.other.encode("a")):]
                if a != b:
                    self.differing.update(self.split(text))
        return ids

    def split(self, normalised: str) -> list[str]:
        return _SEGMENT.findall(normalised) if self.independent else ([normalised] if normalised else [])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """(ids, whether both libraries agree) of each text."""
        at = 0
        while at < len(texts):
            stop, size = at + 1, len(texts[at])
            while stop < len(texts) and size + len(texts[stop]) <= SLICE_CHARS:
                size += len(texts[stop])
                stop += 1
            yield from self._encode_slice(texts[at:stop])
            at = stop

    def _encode_slice(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
        split = [self.split(self.normalise(t)) for t in texts]
        for text, segments, ids in zip(texts, split, self.encoder.texts(split)):
            if self.other is None or self.by_segment:
                yield ids, not self.differing or self.differing.isdisjoint(segments)
            else:
                yield ids, self.other.encode(text) == ids.tolist()

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.add_dummy_prefix and text.startswith(" ") else text

    def plain(self, text: str) -> str:
        """What decoding the ids of a text should give."""
        n = self.normalise(text).replace(MARK, " ")
        return n[1:] if self.model.add_dummy_prefix and n else n


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process and model."""
    if path not in _CODECS:
        _CODECS.clear()
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


OUT = "doc_id long, n_chars long, n_tokens long, n_byte_tokens long, ids_crc32 long, parity boolean, round_trip boolean"


def _digests(path: str):
    names = [x.strip().split(" ")[0] for x in OUT.split(",")]
    kinds = (*[pa.int64()] * 5, pa.bool_(), pa.bool_())

    def run(batches):
        c = codec(path)
        is_byte = np.array([p.type == BYTE for p in c.model.pieces])
        for b in by_bytes(batches, 1):
            doc_ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            rows = [(d, len(t), len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.astype("<u4").tobytes()), same,
                     c.decode(ids.tolist()) == c.plain(t)) for d, t, (ids, same) in zip(doc_ids, texts, c.encode(texts))]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*rows)) or [()] * 7, kinds)], names)
        c.encoder.clear()
    return run


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Counts, checksum of the ids (little-endian 32 bit), parity and round trip of every text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_digests(path or default_model()), OUT)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """All columns of ``docs`` and the columns ``piece_ids`` and ``parity`` (other names where those are taken)."""
    path = path or default_model()
    ids_name, parity_name = fresh(docs, "piece_ids", "parity")
    names = [*docs.columns, ids_name, parity_name]
    at = docs.columns.index("text")

    def run(batches):
        c = codec(path)
        for b in by_bytes(batches, at):
            found = list(c.encode([t or "" for t in b.column(at).to_pylist()]))
            ends = np.cumsum([0, *(len(ids) for ids, _ in found)])
            ids = np.concatenate([np.zeros(0, np.uint32), *(ids for ids, _ in found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                                              pa.array([same for _, same in found], pa.bool_())], names)
        c.encoder.clear()
    schema = StructType(list(docs.schema.fields)).add(ids_name, ArrayType(IntegerType())).add(parity_name, "boolean")
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ids_col: str = "piece_ids", path: str | None = None) -> DataFrame:
    """``encoded`` with the column ``decoded``: the texts of the ids (null ids: null)."""
    path = path or default_model()
    name, = fresh(encoded, "decoded")

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else codec(path).decode(list(x)) for x in ids], dtype=object)
    return encoded.withColumn(name, run(F.col(ids_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents").select("doc_id", "text"))
