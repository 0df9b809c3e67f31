"""Document fingerprints by I-Match with randomised lexicons.

Terms are the ``\\w+`` runs of the lower-cased text.  The lexicon keeps the terms
whose inverse document frequency ln(N / df) lies in a band, so neither function
words nor rare words decide.  A document is its set of distinct lexicon terms
(all its terms where none is in the lexicon), sorted and hashed: once in full,
and once per randomised lexicon subset.  Subsets come in ``draws`` independent
draws; within a draw, level l keeps a term with probability 2**-l, so texts of
any length have subsets in which they keep only a few terms.

The fingerprint is the hex text of the full signature (64 bit) and of the
subset signatures (16 bit each, 0 for an empty subset).  The likeness of two
fingerprints is the share of equal signatures among those that at least one of
them has (not empty); equal fingerprints have likeness 1.

Lexicon size: a term of the lexicon has df >= N * exp(-idf_max), and all df add
up to N times the mean number of distinct terms per document; so there are at
most exp(idf_max) * (mean distinct terms) terms, whatever N is.  That bound, and
a check of the real count, let the lexicon travel to the tasks; a lexicon over
``max_broadcast`` terms is joined to the terms of the documents instead.

Defined results: null and empty texts have the all-zero fingerprint; repeated
rows give repeated rows; an empty table gives an empty table; further columns
of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import neighbours

TERM = re.compile(r"\w+")
#: Documents after which a task gives away its counts (bounds its memory).
CHUNK_TERMS = 400_000


@dataclass(frozen=True)
class IMatchParams:
    idf_min: float = math.log(1 / 0.2)
    idf_max: float = math.log(1 / 0.001)
    draws: int = 10
    levels: int = 11
    seed: int = 20240501
    max_broadcast: int = 3_000_000


def terms_of(text: str | None) -> set[str]:
    return set(TERM.findall(text.lower())) if text else set()


def term_hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), 7)


def _mixed(h: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One uniform 64-bit number per (draw, term)."""
    with np.errstate(over="ignore"):
        z = h[None, :] ^ seeds[:, None]
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class Signer:
    """Signatures of term sets under fixed parameters."""

    def __init__(self, p: IMatchParams):
        self.p = p
        self.seeds = np.array([xxhash.xxh64_intdigest(f"{p.seed}:{r}") for r in range(p.draws)], np.uint64)
        self.cuts = np.array([1 << (64 - l) for l in range(1, p.levels + 1)], np.uint64)
        self.n_sigs = p.draws * p.levels
        self.empty = "0" * (16 + 4 * self.n_sigs)

    def sign(self, hashes) -> str:
        if not hashes:
            return self.empty
        h = np.unique(np.fromiter(hashes, np.uint64, len(hashes)))
        u = _mixed(h, self.seeds)
        sigs = np.zeros(self.n_sigs, ">u2")
        for r in range(self.p.draws):
            order = np.argsort(u[r], kind="stable")
            sorted_u = u[r][order]
            raw = memoryview(h[order].tobytes())
            for l, k in enumerate(np.searchsorted(sorted_u, self.cuts, "left").tolist()):
                if not k:
                    break
                sigs[r * self.p.levels + l] = xxhash.xxh32_intdigest(raw[:8 * k], l + 1) % 65536 or 1
        return f"{xxhash.xxh64_intdigest(h.tobytes(), 11) or 1:016x}" + sigs.tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal signatures among those that at least one text has."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s[16:]), ">u2") for s in (a, b))
    there = (x != 0) | (y != 0)
    n = int(there.sum()) + 1
    return (int(((x == y) & there).sum()) + (a[:16] == b[:16])) / n


# ---------------------------------------------------------------- lexicon

def _frequent_candidates(least: int, total: int):
    """Terms whose share of the documents of some chunk is at least least / total.

    A term in ``least`` of all ``total`` documents has such a share in at least one
    chunk (in whole numbers: c * total >= least * n), so no term of the band is
    missed however the table is cut, and the many rare terms are never shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df.update(terms_of(text))
                n += 1
                if len(df) >= CHUNK_TERMS:
                    yield pa.RecordBatch.from_pydict({"term": pa.array([t for t, c in df.items() if c * total >= least * n], pa.string())})
                    df, n = Counter(), 0
        yield pa.RecordBatch.from_pydict({"term": pa.array([t for t, c in df.items() if c * total >= least * n], pa.string())})
    return run


def _counts_of(candidates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = candidates.value
        df = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df.update(wanted & terms_of(text))
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(df), pa.string()),
                                          "df": pa.array(list(df.values()), pa.int64())})
    return run


def _all_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            df.update(terms_of(text))
            if len(df) >= CHUNK_TERMS:
                yield pa.RecordBatch.from_pydict({"term": list(df), "df": list(df.values())})
                df = Counter()
    yield pa.RecordBatch.from_pydict({"term": pa.array(list(df), pa.string()),
                                      "df": pa.array(list(df.values()), pa.int64())})


def band(n: int, p: IMatchParams) -> tuple[int, int]:
    """Smallest and largest document frequency of the band among ``n`` documents, in whole numbers."""
    eps = 1e-9 * max(1, n)
    return math.ceil(n * math.exp(-p.idf_max) - eps), math.floor(n * math.exp(-p.idf_min) + eps)


def lexicon(docs: DataFrame, text_col: str = "text", p: IMatchParams = IMatchParams()) -> DataFrame:
    """(term, df) of the terms whose inverse document frequency is in the band,
    counted over all documents."""
    texts = docs.select(F.col(text_col).alias("text"))
    n = docs.count()
    least, most = band(n, p)
    cand = texts.mapInArrow(_frequent_candidates(least, n), "term string").distinct()
    got = [r.term for r in cand.limit(p.max_broadcast + 1).collect()]
    if len(got) <= p.max_broadcast:
        shared = docs.sparkSession.sparkContext.broadcast(frozenset(got))
        counted = texts.mapInArrow(_counts_of(shared), "term string, df long")
    else:
        counted = texts.mapInArrow(_all_counts, "term string, df long")
    return counted.groupBy("term").agg(F.sum("df").alias("df")).where(F.col("df").between(least, most))


# ---------------------------------------------------------------- fingerprints

OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
    """(doc_id, text, next text) from rows (range, copy, doc_id, text) in range order."""
    held = None
    for batch in batches:
        for rng, copy, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            if held is not None and held[0] == rng:
                yield held[1], held[2], text
                held = None
            held = None if copy else (rng, doc_id, text)


def _by_broadcast(shared, p: IMatchParams):
    def run(batches):
        lex, signer = shared.value, Signer(p)

        def sign(text: str) -> str:
            terms = terms_of(text)
            kept = [lex[t] for t in terms if t in lex]
            return signer.sign(kept or [term_hash(t) for t in terms])

        rows, after = [], None
        for doc_id, text, following in _pairs(batches):
            own = after[1] if after is not None and after[0] is text else sign(text)
            after = (following, sign(following))
            edited = _edited(text, following)
            fp = sign(edited)
            rows.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, fp,
                         likeness(own, fp), likeness(own, after[1])))
            if len(rows) == 2000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)
    return run


def _batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 7
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = [x.strip().split(" ")[0] for x in OUT.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            p: IMatchParams = IMatchParams()) -> DataFrame:
    """Fingerprint of every text and of its edited text (second half replaced by
    the start of the next document), with the likenesses to the edited text and
    to the next document."""
    sc = docs.sparkSession.sparkContext
    lex = lexicon(docs, text_col, p)
    got = lex.select("term").limit(p.max_broadcast + 1).collect()
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, rng, cpy = neighbours.with_range_copies(plain, "doc_id")
    rows = rows.select(rng, cpy, "doc_id", "text")
    if len(got) <= p.max_broadcast:
        shared = sc.broadcast({r.term: term_hash(r.term) for r in got})
        return rows.mapInArrow(_by_broadcast(shared, p), OUT)
    return _by_join(rows, lex, p)


# A lexicon beyond the bound: the terms of the texts are joined to it.

TERMS = "doc_id long, n_chars long, edited_sha256 string, kind int, term string, occurrence long"


def _term_rows(batches):
    from pyspark import TaskContext
    at = TaskContext.get().partitionId() << 40
    for doc_id, text, following in _pairs(batches):
        edited = _edited(text, following)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        for kind, t in enumerate((text, edited, following)):
            terms = sorted(terms_of(t)) or [None]
            n = len(terms)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([doc_id] * n, pa.int64()), "n_chars": pa.array([len(text)] * n, pa.int64()),
                "edited_sha256": [sha] * n, "kind": pa.array([kind] * n, pa.int32()),
                "term": pa.array(terms, pa.string()), "occurrence": pa.array([at] * n, pa.int64())})
        at += 1


def _signed(p: IMatchParams):
    def run(batches):
        signer = Signer(p)
        for b in batches:
            d = b.to_pydict()
            rows = []
            for i in range(b.num_rows):
                f = [signer.sign([term_hash(t) for t in (d[f"in{k}"][i] or d[f"all{k}"][i])]) for k in range(3)]
                rows.append((d["doc_id"][i], d["n_chars"][i], d["edited_sha256"][i], f[0], f[1],
                             likeness(f[0], f[1]), likeness(f[0], f[2])))
            yield _batch(rows)
    return run


def _by_join(rows: DataFrame, lex: DataFrame, p: IMatchParams) -> DataFrame:
    terms = rows.mapInArrow(_term_rows, TERMS)
    marked = terms.join(lex.select("term", F.lit(True).alias("inside")), "term", "left")
    sets = []
    for k in range(3):
        mine = F.when(F.col("kind") == k, F.col("term"))
        sets += [F.collect_list(F.when(F.col("inside"), mine)).alias(f"in{k}"),
                 F.collect_list(mine).alias(f"all{k}")]
    return (marked.groupBy("occurrence", "doc_id", "n_chars", "edited_sha256").agg(*sets)
            .mapInArrow(_signed(p), OUT))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tables import read
    return fingerprints_with_edits(read(spark, sf_dir, "documents").select("doc_id", "text"))
