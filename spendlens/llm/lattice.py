"""LM scores by the likelihood of a subword lattice.

A text is its words (A-Z lowered), each with the word marker in front, and one
end.  A word can be cut into pieces of an existing vocabulary in many ways; its
probability is the sum over all segmentations of the product of the piece
probabilities.  No piece crosses a word, so the marginal probability of a text is
the product of the marginals of its words and of the end, and a word's marginal
comes from a forward recursion in log space.  Characters without a piece take
the byte pieces of their UTF-8 bytes.

Piece probabilities.  A unigram vocabulary's scores are its log probabilities and
stay as they are (scaled by the probability that a text does not end).  The scores
of a merge vocabulary are no probabilities but ranks; they start as Zipf's law,
1 / (rank + 10), and expectation maximisation over the training words (forward and
backward recursion, expected piece counts) fits them to the training part of the
corpus, until the probabilities move by less than ``tolerance`` in all or
``iterations`` passes are done.  ``refit`` asks for either way with any vocabulary.
The pieces themselves are never changed.

Work at scale.  Words are counted per task before the shuffle.  The recursion
runs once per distinct word, in tasks, vectorised over words of one length.
Scores return to the documents in two ways with one result: words found in at
least ``share`` of all documents (at most mean distinct words / share of them,
whatever the number of documents; the real number is checked) travel to the
tasks; all other (word, document) pairs are joined by word and summed by
document.

Defined results: null and empty texts have one token, the end; repeated rows are
scored alike and each is learned from; a null id counts as the empty text for the
held-out rule; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import crc_bucket, read, written

MARK = "▁"
CHUNK_WORDS = 300_000
LONG_WORD = 48


@dataclass(frozen=True)
class LatticeParams:
    vocabulary: str = ""          # path of a SentencePiece model; empty: the public 32k pieces
    held_out_of: int = 10
    refit: bool | None = None     # whether to fit the scores to the corpus; None: those of merge vocabularies only
    iterations: int = 3
    tolerance: float = 0.01
    share: float = 0.0005
    max_broadcast: int = 2_000_000
    smoothing: float = 0.1


def has_scores(path: str) -> bool:
    """Whether the scores of a model file are log probabilities."""
    from . import spm
    with open(path, "rb") as f:
        return spm.parse_model(f.read()).model_type == spm.UNIGRAM


def vocabulary(path: str) -> tuple[list[str], np.ndarray, dict[int, int]]:
    """(pieces, initial natural-log probabilities, byte value -> piece) of a model file."""
    from . import spm
    model = spm.parse_model(open(path, "rb").read())
    usable = [(i, p) for i, p in enumerate(model.pieces) if p.type in (spm.NORMAL, spm.BYTE)]
    texts = [p.text if p.type == spm.NORMAL else "" for _, p in usable]
    if model.model_type == spm.UNIGRAM:
        low = min(p.score for _, p in usable if p.type == spm.NORMAL)
        logp = np.array([p.score if p.type == spm.NORMAL else low - 10 for _, p in usable])
    else:
        rank = np.array([-p.score if p.type == spm.NORMAL else len(usable) for _, p in usable], float)
        logp = -np.log(rank + 10)
    logp = logp - np.logaddexp.reduce(logp)
    bytes_ = {int(p.text[3:5], 16): k for k, (_, p) in enumerate(usable) if p.type == spm.BYTE}
    return texts, logp, bytes_


class Lattice:
    """Forward and backward recursions over words of one length at a time."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, texts: list[str], logp: np.ndarray, bytes_: dict[int, int]):
        self.logp, self.bytes = logp, bytes_
        self.longest = max(map(len, texts))
        keys, ids = [], []
        # Places of the hashes of all beginnings of pieces: where no piece goes on, a search ends.
        self.begins = np.zeros(1 << 22, bool)
        for n in range(1, self.longest + 1):
            some = [(i, t) for i, t in enumerate(texts) if len(t) == n]
            if some:
                codes = np.array([[ord(c) for c in t] for _, t in some], np.uint64)
                h = np.zeros(len(some), np.uint64)
                for j in range(n):
                    h = self._step(h, codes[:, j])
                    self.begins[self._place(h)] = True
                keys.append(h)
                ids += [i for i, _ in some]
        key, ids = np.concatenate(keys), np.array(ids)
        assert len(np.unique(key)) == len(key), "two pieces share a hash"
        # Open tables by the upper bits of the hash: a piece whose place is taken
        # goes to a further table.
        self.tables = []
        while len(key):
            place = self._place(key)
            _, first = np.unique(place, return_index=True)
            table = np.full(1 << 22, -1, np.int32)
            table[place[first]] = np.arange(len(first))
            self.tables.append((table, key[first], ids[first]))
            key, ids = np.delete(key, first), np.delete(ids, first)

    @staticmethod
    def _place(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(42)).astype(np.int64)

    @classmethod
    def _step(cls, h: np.ndarray, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            z = (h ^ (codes + np.uint64(1))) * cls.BASE
            return z ^ (z >> np.uint64(29))

    def _lookup(self, h: np.ndarray) -> np.ndarray:
        """Piece of a hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        rest, place = np.arange(len(h)), self._place(h)
        for table, key, ids in self.tables:
            at = table[place[rest]]
            there = at >= 0
            at, rest = at[there], rest[there]
            hit = key[at] == h[rest]
            out[rest[hit]] = ids[at[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
        return out

    def _edges(self, codes: np.ndarray):
        """(start, end, rows, pieces) of all pieces found in words of equal
        length, and (position, rows, characters) without a piece of their own."""
        n, size = codes.shape
        edges, bare = [], []
        for s in range(size):
            rows, h = np.arange(n), np.zeros(n, np.uint64)
            for e in range(s + 1, min(size, s + self.longest) + 1):
                h = self._step(h, codes[rows, e - 1])
                if e > s + 1:
                    on = self.begins[self._place(h)]
                    rows, h = rows[on], h[on]
                    if not len(rows):
                        break
                piece = self._lookup(h)
                found = piece >= 0
                if found.any():
                    edges.append((s, e, rows[found], piece[found]))
                if e == s + 1 and not found.all():
                    bare.append((s, rows[~found], codes[rows[~found], s]))
        return edges, bare

    def _bytes_of(self, chars: np.ndarray):
        kinds, back = np.unique(chars, return_inverse=True)
        spelled = [[self.bytes[b] for b in chr(int(c)).encode("utf-8", "surrogatepass")] for c in kinds]
        cost = np.array([self.logp[x].sum() for x in spelled])
        return spelled, cost, back

    def run(self, words: list[str], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural-log marginals of the words, and (with counts) the expected
        piece counts of all words."""
        out = np.zeros(len(words))
        expected = None if counts is None else np.zeros(len(self.logp))
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w) + 1, []).append(i)
        for size, members in by_size.items():
            step = max(1, 400_000 // size) if size <= LONG_WORD else max(1, 40_000 // size)
            for at in range(0, len(members), step):
                some = members[at:at + step]
                text = "".join([MARK + words[i] for i in some])
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(some), size)
                weight = None if counts is None else counts[some]
                out[some] = self._group(codes.astype(np.uint64), weight, expected)
        return out, expected

    def _group(self, codes, weight, expected) -> np.ndarray:
        n, size = codes.shape
        edges, bare = self._edges(codes)
        spelled = [self._bytes_of(c) for _, _, c in bare]
        steps = [(s, e, rows, self.logp[p], ("piece", p)) for s, e, rows, p in edges]
        steps += [(s, s + 1, rows, cost[back], ("bytes", sp, back)) for (s, rows, _), (sp, cost, back) in zip(bare, spelled)]
        alpha = np.full((size + 1, n), -np.inf)
        alpha[0] = 0
        for s, e, rows, lp, _ in sorted(steps, key=lambda x: x[0]):
            if len(rows) == n:
                np.logaddexp(alpha[e], alpha[s] + lp, out=alpha[e])
            else:
                alpha[e, rows] = np.logaddexp(alpha[e, rows], alpha[s, rows] + lp)
        total = alpha[size]
        if expected is not None:
            beta = np.full((size + 1, n), -np.inf)
            beta[size] = 0
            for s, e, rows, lp, what in sorted(steps, key=lambda x: -x[1]):
                through = lp + beta[e, rows]
                beta[s, rows] = np.logaddexp(beta[s, rows], through)
                mass = np.exp(alpha[s, rows] + through - total[rows]) * weight[rows]
                if what[0] == "piece":
                    expected += np.bincount(what[1], mass, len(expected))
                else:
                    for k, m in enumerate(np.bincount(what[2], mass, len(what[1]))):
                        for b in what[1][k]:
                            expected[b] += m
        return total


# ---------------------------------------------------------------- corpus

def tokens(text: str | None) -> list[str]:
    """Words with A-Z lowered (ASCII blanks only)."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return [w.decode("utf-8", "surrogatepass") for w in raw]


def _strings(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _bytes_tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


COUNTS = "word string, trained long, docs long"


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: training occurrences and documents of every word."""
    trained, docs = Counter(), Counter()

    def out():
        keys = list(docs)
        return pa.RecordBatch.from_pydict({"word": _strings(keys),
                                           "trained": pa.array([trained.get(k, 0) for k in keys], pa.int64()),
                                           "docs": pa.array(list(docs.values()), pa.int64())})
    for batch in batches:
        for held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ws = _bytes_tokens(text)
            docs.update(set(ws))
            if not held:
                trained.update(ws)
            if len(docs) >= CHUNK_WORDS:
                yield out()
                trained, docs = Counter(), Counter()
    yield out()


def _larger(batches: Iterator[pa.RecordBatch], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Batches joined to ``rows`` rows: larger groups of words of one length."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _expected(model, n: int):
    def run(batches):
        lattice = Lattice(*model.value)
        total = np.zeros(n)
        for b in _larger(batches):
            total += lattice.run(b.column(0).to_pylist(), b.column(1).to_numpy().astype(float))[1]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(at, pa.int32()), "mass": pa.array(total[at], pa.float64())})
    return run


def _word_scores(model):
    def run(batches):
        lattice = Lattice(*model.value)
        for b in _larger(batches):
            lp = lattice.run(b.column(0).to_pylist())[0] / math.log(10)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lp, pa.float64())], ["word", "trained", "docs", "logp"])
    return run


def fit(counts: DataFrame, path: str, train_docs: int, p: LatticeParams):
    """(pieces, fitted log probabilities, byte pieces, log10 probability of the end)."""
    sc = counts.sparkSession.sparkContext
    texts, logp, bytes_ = vocabulary(path)
    train = counts.where("trained > 0").select("word", "trained")
    if not (p.refit if p.refit is not None else not has_scores(path)):
        words = train.agg(F.sum("trained")).first()[0] or 0
        share = (train_docs + p.smoothing) / (words + train_docs + 2 * p.smoothing)
        return texts, logp + math.log1p(-share), bytes_, math.log10(share)
    end = 0.0
    for _ in range(p.iterations):
        rows = (train.mapInArrow(_expected(sc.broadcast((texts, logp, bytes_)), len(texts)), "piece int, mass double")
                .groupBy("piece").agg(F.sum("mass").alias("mass")).collect())   # one row a piece of the vocabulary
        mass = np.full(len(texts), p.smoothing)
        for r in rows:
            mass[r.piece] += r.mass
        total = mass.sum() + train_docs + p.smoothing
        moved = np.abs(np.exp(logp) - mass / total).sum()
        logp = np.log(mass / total)
        end = math.log10((train_docs + p.smoothing) / total)
        if moved < p.tolerance:
            break
    return texts, logp, bytes_, end


SUMS = "doc_id long, held_out boolean, row long, n_tokens long, n_known long, base double, score double, word string, times long"


def _document_sums(shared):
    """One row per document with the sums over frequent words, and one row for
    each of its other words."""
    names = [x.strip().split(" ")[0] for x in SUMS.split(",")]
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.int64())

    def batch(n: int, **given) -> pa.RecordBatch:
        cols = [given[c] if c in given else pa.nulls(n, k) for c, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def run(batches):
        known = shared.value
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        docs, at, rare, often = [], [], [], []
        for b in batches:
            for doc_id, held, text in zip(*(c.to_pylist() for c in b.columns)):
                bag = Counter(_bytes_tokens(text))
                seen, base, score = 0, 0.0, 0.0
                rest = len(rare)
                for w, times in bag.items():
                    v = known.get(w)
                    if v is None:
                        rare.append(w)
                        often.append(times)
                    else:
                        seen += times * v[0]
                        base += times * v[1]
                        score += times * v[2]
                at += [row] * (len(rare) - rest)
                docs.append((doc_id, held, row, bag.total() + 1, seen, base, score))
                row += 1
                if len(rare) >= 50_000:
                    yield batch(len(rare), row=at, word=_strings(rare), times=often)
                    at, rare, often = [], [], []
            if docs:
                yield batch(len(docs), **dict(zip(names, zip(*docs))))
                docs = []
        yield batch(len(rare), row=at, word=_strings(rare), times=often)
    return run


def score(docs: DataFrame, p: LatticeParams = LatticeParams()) -> DataFrame:
    """Base and lattice scores of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    path = p.vocabulary
    if not path:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    held = crc_bucket("doc_id", p.held_out_of) == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("held_out")).alias("train")).first()
    counts = written(rows.select("held_out", "text").mapInArrow(_word_counts, COUNTS).groupBy("word")
                     .agg(F.sum("trained").alias("trained"), F.sum("docs").alias("docs")), "lm-counts")
    seen = counts.where("trained > 0").agg(F.sum("trained").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = sizes.train
    n_train, v_train = (seen.n or 0) + ends, seen.v + (1 if ends else 0)
    texts, logp, bytes_, end = fit(counts, path, ends, p)
    model = spark.sparkContext.broadcast((texts, logp, bytes_))
    scored = written(counts.mapInArrow(_word_scores(model), COUNTS + ", logp double"), "lm-words")
    floor = math.log10(n_train + 0.1 * (v_train + 1))
    base = F.log10(F.col("trained") + 0.1) - F.lit(floor)
    often = scored.where(F.col("docs") >= F.lit(p.share * sizes.n)).select("word", "trained", base.alias("base"), "logp")
    got = often.limit(p.max_broadcast + 1).collect()
    shared = {} if len(got) > p.max_broadcast else {
        r.word.encode("utf-8", "surrogatepass"): (int(r.trained > 0), r.base, r.logp) for r in got}
    sums = written(rows.mapInArrow(_document_sums(spark.sparkContext.broadcast(shared)), SUMS), "lm-sums")
    rest = (sums.where(F.col("word").isNotNull()).select("row", "word", "times")
            .join(scored.select("word", "trained", "logp"), "word")
            .groupBy("row").agg(F.sum(F.col("times") * (F.col("trained") > 0).cast("long")).alias("known"),
                                F.sum(F.col("times") * base).alias("rare_base"),
                                F.sum(F.col("times") * F.col("logp")).alias("rare_score")))
    end_base = math.log10(ends + 0.1) - floor
    zero = F.lit(0.0)
    return (sums.where(F.col("word").isNull()).drop("word", "times").join(rest, "row", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("rare_base", zero) + F.lit(end_base)).alias("base_score"),
                    (F.col("score") + F.coalesce("rare_score", zero) + F.lit(end)).alias("score")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents").select("doc_id", "text"))
