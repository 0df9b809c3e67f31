"""Alignment of two tokenizers over a corpus, each distinct text once.

A is a byte-level vocabulary (``tokenizers`` file), B a SentencePiece merge model.
A text is read as blank + text, which is what B encodes.  The places where a token
of A and one of B both end cut the tokens into groups; an A and a B token are
linked where their bytes overlap.  ``pair_counts`` counts the linked id pairs of
the corpus, ``align`` returns the groups and measures of every document.

Steps (exact-text deduplication)
1. The documents are shuffled by their full text; equal texts become one row with
   the number of copies.  Copies are counted before the shuffle, so a text that a
   third of the documents share sends one row a task.
2. Each distinct text is encoded and aligned; its links count once per copy.
   Tasks add up their counts before they send them.
3. Each distinct text is aligned again beside the finished counts, which gives its
   measures.
4. The measures are joined to the document ids by the SHA-256 of the text.  Texts
   with more than a thousandth of the documents, of which there are fewer than a
   thousand, are joined by broadcast; so no key of the shuffled join is hot.

Most of a text are words that occur again and again.  Neither tokenizer has a
token that reaches from a non-blank into a blank after it, or from a letter into
one of certain marks after it (for B: where no piece holds the two in a row, which
is read off the model).  The text falls into segments there, each distinct segment
is aligned once while it is held, and a text's result is put together from those
of its segments.  The store is cleared at a bound.

The table of pair counts is read by the tasks from the shared folder, in slices of
``SLICE_PAIRS`` pairs; with more pairs than that, step 3 runs once per slice and
the measures are added up.

Defined results: null and empty texts, and texts whose joined tokens of A or B are
not blank + text (such as texts that hold U+2581), have no tokens: zeros and the
empty digest.  Repeated rows count each time and are returned each time; null ids
are kept; strings of special tokens are plain text; an empty table gives an empty
table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .chunks import by_bytes
from .spm import BYTE, CONTROL, MARK, NORMAL, UNKNOWN, parse_model
from .tables import read, written
from .tokenbin import BLANKS, LETTER, POINT, _filesystem

#: Segments and bytes of segments held, segments encoded as one text, bytes of texts at a time, pairs read at a time.
HELD, HELD_BYTES, JOINED, TEXT_BYTES, SLICE_PAIRS = 300_000, 16 << 20, 500, 2 << 20, 4_000_000


@dataclass(frozen=True)
class Models:
    a: str
    b: str


def default_models() -> Models:
    import public_tokenizers
    return Models(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for
    themselves, the others for the characters from U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Aligner:
    """Both tokenizers and the segments aligned so far."""

    def __init__(self, models: Models):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(models.a)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(self.a.get_vocab(with_added_tokens=True).values()) + 1)
        for text, i in vocab.items():
            if all(c in alphabet for c in text):
                self.bytes_a[i] = bytes(alphabet[c] for c in text)
        with open(models.b, "rb") as f:
            raw = f.read()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=raw)
        m = parse_model(raw)
        if not m.add_dummy_prefix or m.remove_extra_whitespaces or m.charsmap or m.whitespace_suffix:
            raise ValueError("B has to put a blank in front and to leave the text as it is otherwise")
        self.bytes_b = [bytes([int(p.text[3:5], 16)]) if p.type == BYTE
                        else b"" if p.type in (CONTROL, UNKNOWN) else p.text.replace(MARK, " ").encode() for p in m.pieces]
        self.mark = next((i for i, p in enumerate(m.pieces) if p.text == MARK and p.type == NORMAL), None)
        several = [p.text for p in m.pieces if p.type == NORMAL and len(p.text) > 1]
        independent = not any(MARK in t.lstrip(MARK) for t in several) and self.mark is not None
        inside = set().union(*several) if several else set()
        cut = {c for c in BLANKS if c not in inside and c != " "} | ({" "} if independent else set())
        blank, stuck = re.escape("".join(sorted(BLANKS))), re.escape("".join(sorted(BLANKS - cut)))
        more = f"(?:[{stuck}][{blank}]*+[^{blank}]*+)*+" if stuck else ""
        points = "".join(c for c in POINT if not any(re.search(f"[{LETTER}]{re.escape(c)}", t) for t in several))
        word = f"[{blank}]*+[{LETTER}]++(?=[{re.escape(points)}])|" if points else ""
        self.split = re.compile(f"{word}[{blank}]*+[^{blank}]++{more}|[{blank}]++").findall
        self.first = cut | {" "}                  # first characters of segments that may follow any that end in no blank
        self.before = self.b.encode("a")
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.names = [str(i) for i in range(max(len(self.len_a), len(self.len_b)))]
        self.pairs, self.told = None, False
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.held = 0
        # Of each segment: A and B tokens, groups, links, links of best count, sum of counts; whether it has a reading.
        self.stats = np.zeros((1 << 12, 6), np.int64)
        self.good = np.zeros(1 << 12, bool)
        self.groups: list[str] = []
        self.keys: list[np.ndarray] = []          # pairs of the links, in order of the segments
        self.weight = np.zeros(1 << 12, np.int64)

    def begin(self, pairs=None, told: bool = False) -> None:
        """Clear the store.  ``pairs``: counts to look links up in (sorted keys, counts,
        whether best); ``told``: whether the groups are wanted as text."""
        self.pairs, self.told = pairs, told
        self.clear()

    def _encoded(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A and B of a segment or several in a row.  B puts a blank in front by itself."""
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        if text == " ":
            return a, [self.mark]
        if text[0] == " ":
            return a, self.b.encode(text[1:])
        if text[0] in BLANKS:
            b = self.b.encode(text)
            return a, b[1:] if b and b[0] == self.mark else []
        b = self.b.encode("a" + text)             # a mark, cut off behind a letter
        return a, b[len(self.before):] if b[:len(self.before)] == self.before else []

    def _reads(self, a, b, raw: bytes) -> bool:
        return (b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw)

    def _add(self, new: list[str]) -> None:
        ok = [x[0] in self.first and x[-1] not in BLANKS and MARK not in x for x in new]
        joined = [x for x, y in zip(new, ok) if y]
        groups = [joined[i:i + JOINED] for i in range(0, len(joined), JOINED)]
        groups += [[x] for x, y in zip(new, ok) if not y]
        order, sizes, all_a, all_b, good = [], [], [], [], []
        while groups:
            g = groups.pop()
            text = "".join(g)
            a, b = self._encoded(text)
            ok = self._reads(a, b, text.encode())
            if not ok and len(g) > 1:             # find the segment that has no reading
                groups += [[x] for x in g]
                continue
            order += g
            good += [ok] * len(g)
            sizes += [len(x.encode()) if ok else 0 for x in g]
            if ok:
                all_a += a
                all_b += b
        n, first = len(order), len(self.slot)
        while first + n > len(self.stats):
            self.stats = np.concatenate([self.stats, np.zeros_like(self.stats)])
            self.good = np.concatenate([self.good, np.zeros_like(self.good)])
            self.weight = np.concatenate([self.weight, np.zeros_like(self.weight)])
        a, b = np.array(all_a, np.int64), np.array(all_b, np.int64)
        stats, keys, texts = self._aligned(a, b, np.cumsum(sizes, dtype=np.int64))
        self.stats[first:first + n] = stats
        self.good[first:first + n] = good
        self.groups += texts
        self.keys.append(keys)
        self.slot.update(zip(order, range(first, first + n)))
        self.held += sum(sizes)

    def _aligned(self, a, b, edges):
        """Figures, link pairs and groups of segments that end at the given bytes of one line of tokens."""
        la, lb = self.len_a[a], self.len_b[b]
        end_a, end_b = np.cumsum(la), np.cumsum(lb)
        both_a = end_b[np.minimum(np.searchsorted(end_b, end_a), len(b) - 1)] == end_a if len(b) else np.zeros(len(a), bool)
        both_b = end_a[np.minimum(np.searchsorted(end_a, end_b), len(a) - 1)] == end_b if len(a) else np.zeros(len(b), bool)
        low, high = np.searchsorted(end_b, end_a - la, "right"), np.searchsorted(end_b - lb, end_a, "left")
        n = high - low
        total = np.cumsum(n)
        pairs = (np.repeat(a, n) << 32) | b[np.repeat(low - (total - n), n) + np.arange(int(total[-1]) if len(n) else 0)]
        upto_a, upto_b = np.searchsorted(end_a, edges, "right"), np.searchsorted(end_b, edges, "right")

        def each(counted, upto):
            return np.diff(np.concatenate([[0], counted])[upto], prepend=0)
        upto_links = np.concatenate([[0], total])[upto_a]
        stats = np.zeros((len(edges), 6), np.int64)
        stats[:, 0], stats[:, 1] = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        stats[:, 2], stats[:, 3] = each(np.cumsum(both_a), upto_a), np.diff(upto_links, prepend=0)
        if self.pairs is not None and len(pairs):
            known, count, best = self.pairs
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            stats[:, 4] = np.diff(np.concatenate([[0], np.cumsum(hit & best[at])])[upto_links], prepend=0)
            stats[:, 5] = np.diff(np.concatenate([[0], np.cumsum(np.where(hit, count[at], 0))])[upto_links], prepend=0)
        if not self.told:
            return stats, pairs, []
        # Groups as text: ids with commas, A|B.
        name = self.names.__getitem__
        names_a, names_b = list(map(name, a.tolist())), list(map(name, b.tolist()))
        cut_a, cut_b = (np.flatnonzero(both_a) + 1).tolist(), (np.flatnonzero(both_b) + 1).tolist()
        told, i, j = [], 0, 0
        for x, y in zip(cut_a, cut_b):
            told.append(f"{names_a[i] if x == i + 1 else ','.join(names_a[i:x])}|{names_b[j] if y == j + 1 else ','.join(names_b[j:y])}")
            i, j = x, y
        stops = np.cumsum(stats[:, 2]).tolist()
        return stats, pairs, [";".join(told[i:j]) for i, j in zip([0, *stops], stops)]

    def slots(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(segment numbers of the texts in one line, ends of the texts)."""
        line = list(chain.from_iterable(split))
        ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        at = np.fromiter(map(self.slot.get, line, repeat(-1)), np.int64, len(line))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = list(dict.fromkeys(line[i] for i in unknown.tolist()))
            self._add(new)
            at[unknown] = np.fromiter((self.slot[line[i]] for i in unknown.tolist()), np.int64, len(unknown))
        return at, ends

    @property
    def full(self) -> bool:
        return len(self.slot) > HELD or self.held > HELD_BYTES

    def read(self, texts: list[str]):
        """(segment numbers, first and last + 1 of each text, whether each has a reading)."""
        at, ends = self.slots([self.split(" " + t) if t else [] for t in texts])
        starts = np.concatenate([[0], ends[:-1]])
        bad = np.concatenate([[0], np.cumsum(~self.good[at])])
        return at, starts, ends, (bad[ends] == bad[starts]) & (ends > starts)

    def count(self, texts: list[str], copies: list[int]) -> None:
        at, starts, ends, good = self.read(texts)
        np.add.at(self.weight, at, np.repeat(np.where(good, np.array(copies, np.int64), 0), ends - starts))

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """(pairs, counts) of the links since the store was cleared."""
        n = len(self.slot)
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        found, which = np.unique(keys, return_inverse=True)
        counts = np.zeros(len(found), np.int64)
        np.add.at(counts, which, np.repeat(self.weight[:n], self.stats[:n, 3]))
        return found[counts > 0], counts[counts > 0]

    def measures(self, texts: list[str]) -> tuple[np.ndarray, list[str]]:
        """Figures (one row a text) and the groups of the texts."""
        at, starts, ends, good = self.read(texts)
        sums = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(self.stats[at], axis=0)])
        out = np.where(good[:, None], sums[ends] - sums[starts], 0)
        said = list(map(self.groups.__getitem__, at.tolist()))
        return out, [";".join(said[i:j]) if ok else "" for i, j, ok in zip(starts.tolist(), ends.tolist(), good.tolist())]


_ALIGNERS: dict[Models, Aligner] = {}


def aligner(models: Models) -> Aligner:
    """One aligner per worker process and pair of models."""
    if models not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[models] = Aligner(models)
    return _ALIGNERS[models]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(key, text, copies) of every distinct text, the empty one left out; key: SHA-256 of the text."""
    return (docs.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
            .select(text_key("text").alias("key"), "text", "copies"))


def text_key(text: str):
    return F.when(F.length(text) > 0, F.unhex(F.sha2(F.col(text).cast("binary"), 256)))


def _counts(models: Models):
    def run(batches):
        al = aligner(models)
        al.begin()

        def out():
            keys, n = al.counted()
            al.clear()
            for i in range(0, len(keys), 100_000):
                k = keys[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(k >> 32, pa.int32()), pa.array(k & 0xFFFFFFFF, pa.int32()),
                                                  pa.array(n[i:i + 100_000])], ["a", "b", "n"])
        for b in by_bytes(batches, 0, TEXT_BYTES):
            al.count(b.column(0).to_pylist(), b.column(1).to_pylist())
            if al.full:
                yield from out()
        yield from out()
    return run


def pair_counts(texts: DataFrame, models: Models) -> DataFrame:
    """(a, b, n, best): how often two ids are linked in all copies of the texts, and
    whether no other A id is linked to that B id more often."""
    parts = texts.select("text", "copies").mapInArrow(_counts(models), "a int, b int, n long")
    pairs = written(parts.groupBy("a", "b").agg(F.sum("n").alias("n")), "pair-counts")
    # At most one row for each id of B's vocabulary.
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


_TABLES: dict[str, tuple] = {}


def _pair_table(folder: str):
    """One slice of the pair counts, sorted by pair; kept by the worker."""
    if folder not in _TABLES:
        import pyarrow.parquet as pq
        where, base = _filesystem(folder)
        t = pq.read_table(base, filesystem=where, partitioning=None, columns=["a", "b", "n", "best"])
        key = (t.column("a").to_numpy().astype(np.int64) << 32) | t.column("b").to_numpy()
        order = np.argsort(key)
        _TABLES.clear()
        _TABLES[folder] = (key[order], t.column("n").to_numpy()[order], t.column("best").to_numpy()[order])
    return _TABLES[folder]


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _measured(models: Models, folder: str, with_groups: bool):
    def run(batches):
        al = aligner(models)
        al.begin(_pair_table(folder), told=True)
        for b in by_bytes(batches, 1, TEXT_BYTES):
            figures, groups = al.measures(b.column(1).to_pylist())
            cols = [b.column(0), *(pa.array(figures[:, i]) for i in range(6)),
                    pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups], pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(groups, pa.string())] if with_groups else []),
                                             ["key", *FIGURES, "groups_sha256"] + ["groups"] * with_groups)
            if al.full:
                al.clear()
        al.clear()
    return run


def measures(texts: DataFrame, pairs: DataFrame, models: Models, with_groups: bool = False,
             slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """(key, figures, groups_sha256 and, if asked for, groups) of each distinct text."""
    spark = texts.sparkSession
    folder = scratch_path(spark, f"pair-table-{uuid.uuid4().hex}")
    # Every slice has a file, also where there are no pairs at all.
    n = max(1, -(-pairs.count() // slice_pairs))
    sliced = pairs.withColumn("slice", F.pmod(F.xxhash64("a", "b"), F.lit(n)).cast("int"))
    none = spark.range(n).select(F.lit(-1).alias("a"), F.lit(-1).alias("b"), F.lit(0).cast("long").alias("n"),
                                 F.lit(False).alias("best"), F.col("id").cast("int").alias("slice"))
    sliced.unionByName(none).write.partitionBy("slice").parquet(folder)
    schema = "key binary, " + ", ".join(f"{c} long" for c in FIGURES) + ", groups_sha256 string" + ", groups string" * with_groups
    out = None
    for s in range(n):
        rows = texts.select("key", "text").mapInArrow(_measured(models, f"{folder}/slice={s}", with_groups), schema)
        rows = rows.withColumn("slice", F.lit(s))
        out = rows if out is None else out.unionByName(rows)
    if n == 1:
        return out.drop("slice")
    first = [F.max(F.when(F.col("slice") == 0, F.col(c))).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    told = [F.max(F.when(F.col("slice") == 0, F.col(c))).alias(c) for c in ["groups_sha256"] + ["groups"] * with_groups]
    return out.groupBy("key").agg(*first, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), *told)


def align(docs: DataFrame, models: Models | None = None, with_groups: bool = False,
          slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """(doc_id, figures, groups_sha256 and, if asked for, groups) of every document (doc_id, text)."""
    models = models or default_models()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = written(distinct_texts(rows), "distinct-texts")
    pairs = written(pair_counts(texts, models), "pairs")
    found = written(measures(texts, pairs, models, with_groups, slice_pairs).join(texts.select("key", "copies"), "key"), "measures")
    ids = rows.select("doc_id", text_key("text").alias("key"))
    total = texts.agg(F.sum("copies")).first()[0] or 0
    common = F.col("copies") * 1000 > F.lit(total)
    cols = [*FIGURES, "groups_sha256"] + ["groups"] * with_groups
    hot, rest = F.broadcast(found.where(common)), found.where(~common)
    keyed = ids.where(F.col("key").isNotNull())
    empty = ids.where(F.col("key").isNull()).select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in FIGURES], *[F.lit("").alias(c) for c in cols[6:]])
    return (keyed.join(hot, "key").select("doc_id", *cols)
            .unionByName(keyed.join(hot.select("key"), "key", "left_anti").join(rest, "key").select("doc_id", *cols))
            .unionByName(empty))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(read(spark, sf_dir, "documents").select("doc_id", "text"))
