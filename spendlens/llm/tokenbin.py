"""Token ids in flat binary files.

Format, below one folder: for every part a file ``part-NNNNN-*.ids`` of unsigned
little-endian ids (16 bit where the vocabulary allows it, else 32 bit) and a file
``part-NNNNN-*.idx`` of little-endian 64-bit words: the number of documents n,
the n document ids (signed; the smallest number stands for null), then n + 1
offsets into the part's ids.  Parts are in ascending document id, and so are the
documents inside a part.  The table ``manifest`` lists the parts with their
files, document and id counts, and their bases: the exclusive prefix sums of the
counts, so that base + offset is a document's place among all ids.

Writing: the documents are range-partitioned and sorted by id (equal ids by the
hash of the text); each task encodes its range and writes its two files under
names of its own, so a retried or doubled task leaves no half-written part:
only files named in the manifest count.  Only the per-part counts reach the
driver.  Reading: a task maps its part into memory and cuts the documents out.

Every document ends with id 0.  Byte-level pretokens never reach over a point
between a non-blank and a blank, nor over a point between a letter and one of
``POINT``, so each distinct segment between such points is encoded once
(``segments``), which changes no id.

Defined results: null and empty texts have only the end id; null ids come first;
repeated rows are kept; an empty table has a manifest without documents; further
columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .segments import SegmentEncoder
from .tables import read, shuffle_partitions, written

NULL_ID = -(1 << 63)
# The blanks of the tokenizer's pattern (Unicode White_Space).
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters that are certain to be letters, marks that are certain to be neither letter, digit nor blank.
LETTER, POINT = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", r".,;:!?*#%$&|"
_SEGMENT = re.compile(f"[{BLANK}]*+[{LETTER}]++(?=[{POINT}])|[{BLANK}]*+[^{BLANK}]++|[{BLANK}]++")
BLANKS = frozenset(chr(c) for c in range(0x3001) if re.match(f"[{BLANK}]", chr(c)))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class ByteEncoder:
    """Ids of texts under a byte-level tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # An added token with a blank inside would cross segments.
        self.whole = any(re.search(f"[{BLANK}]", s) for s in special)
        # Byte-level vocabularies write every byte as one character.
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        weight = np.zeros(max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1, np.int64)
        for text, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            weight[i] = len(added[i].encode()) if i in added else len(text)
        # A segment that begins with a blank may stand behind one that ends with none.
        self.segments = SegmentEncoder(self._encode, weight, lambda x: len(x.encode("utf-8")),
                                       lambda x: x[0] in BLANKS and x[-1] not in BLANKS, held=450_000)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        return self.segments.texts([t] if self.whole else _SEGMENT.findall(t) for t in texts)


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


def _filesystem(folder: str):
    """(filesystem, path) of a folder of the shared storage."""
    from pyarrow import fs
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


PARTS = "part int, name string, docs long, ids long"


def _write_parts(folder: str, path: str, end: int):
    def run(batches):
        from pyspark import TaskContext
        enc = encoder(path)
        kind = id_type(enc.size)
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        where, base = _filesystem(folder)
        doc_ids, sizes = [], []
        with where.open_output_stream(f"{base}/{name}.ids") as out:
            for b in batches:
                doc_ids += [NULL_ID if d is None else d for d in b.column(0).to_pylist()]
                for ids in enc.texts([t or "" for t in b.column(1).to_pylist()]):
                    out.write(np.append(ids, end).astype(kind).tobytes())
                    sizes.append(len(ids) + 1)
        offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        with where.open_output_stream(f"{base}/{name}.idx") as out:
            out.write(np.concatenate([[len(doc_ids)], np.array(doc_ids, np.int64), offsets]).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name],
                                          "docs": pa.array([len(doc_ids)], pa.int64()),
                                          "ids": pa.array([int(offsets[-1])], pa.int64())})
    return run


def write(docs: DataFrame, folder: str, path: str | None = None, end: int = 0) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into ``folder``; returns the manifest, a
    table (part, name, docs, ids, doc_base, id_base), which is written there too."""
    spark = docs.sparkSession
    where, base = _filesystem(folder)
    where.create_dir(base, recursive=True)
    tie = F.xxhash64("text")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tie.alias("tie"))
            .repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "tie")
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text"))
    parts = written(rows.mapInArrow(_write_parts(folder, path or default_tokenizer(), end), PARTS), "token-parts")
    # One row a part: the prefix sums are small work.
    doc_base = id_base = 0
    lines = []
    for r in sorted(parts.collect(), key=lambda r: r.part):
        lines.append((r.part, r.name, r.docs, r.ids, doc_base, id_base))
        doc_base, id_base = doc_base + r.docs, id_base + r.ids
    manifest = spark.createDataFrame(lines, PARTS + ", doc_base long, id_base long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class Part:
    """One part, mapped into memory where the storage is a mounted folder."""

    def __init__(self, folder: str, name: str, kind: str):
        from pyarrow import fs
        where, base = _filesystem(folder)
        with where.open_input_file(f"{base}/{name}.idx") as f:
            raw = np.frombuffer(f.readall(), "<i8")
        n = int(raw[0])
        self.doc_ids, self.offsets = raw[1:n + 1], raw[n + 1:]
        self.kind = np.dtype(kind)
        self.file = None
        if not self.offsets[-1]:
            self.ids = np.zeros(0, kind)
        elif isinstance(where, fs.LocalFileSystem):
            self.ids = np.memmap(f"{base}/{name}.ids", kind, "r")
        else:
            self.file = where.open_input_file(f"{base}/{name}.ids")

    def document(self, i: int) -> np.ndarray:
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        if self.file is None:
            return self.ids[a:b]
        size = self.kind.itemsize
        return np.frombuffer(self.file.read_at((b - a) * size, a * size), self.kind)


OUT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read_parts(folder: str, kind: str, with_ids: bool):
    def run(batches):
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = Part(folder, name, kind)
                for at in range(0, len(part.doc_ids), 2000):
                    some = range(at, min(at + 2000, len(part.doc_ids)))
                    ids = [part.document(i).astype("<u4") for i in some]
                    cols = {"doc_id": pa.array([None if part.doc_ids[i] == NULL_ID else int(part.doc_ids[i]) for i in some], pa.int64()),
                            "start": pa.array([base + int(part.offsets[i]) for i in some], pa.int64()),
                            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())}
                    if with_ids:
                        cols["ids"] = pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(cols)
    return run


def read_back(spark: SparkSession, folder: str, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Documents of a folder: (doc_id, start, n_tokens, ids_crc32) and, if asked for, the ids."""
    size = encoder(path or default_tokenizer()).size
    manifest = spark.read.parquet(f"{folder}/manifest").select("name", "id_base", "part")
    n = max(1, manifest.count())
    return (manifest.repartitionByRange(n, "part").select("name", "id_base")
            .mapInArrow(_read_parts(folder, id_type(size), with_ids), OUT + (", ids array<long>" if with_ids else "")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"token-ids-{uuid.uuid4().hex}")
    write(read(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return read_back(spark, folder)
