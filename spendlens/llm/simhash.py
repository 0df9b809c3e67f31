"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints: a bit is set if it is set in more than half of the XXH64 hashes of
the word shingles.  Links: fingerprints that differ in at most ``max_bits``
bits.  Only distinct fingerprints are compared.

Index.  The top nodes are shared bit patterns under a mask: the 64 bits are cut
into blocks, and for every choice of ``blocks - max_bits`` blocks the
fingerprints that agree on (the first bits of) them form a group.  Two linked
fingerprints differ in at most ``max_bits`` blocks, so they meet in at least one
group.  The masks only deal the work out: they are as coarse as groups of about
``NODE`` random fingerprints allow, and up to ``NODE`` fingerprints are one group.
Inside a group the fingerprints are sorted by Gray rank, where neighbours share
most bits.  Leaves are runs of that order; every node keeps the bits that all its
members share and that its parent does not already hold, and upper nodes are built
the same way.  A search walks down with the accumulated number of differing bits
and drops a whole node as soon as it exceeds ``max_bits``.

A group does not return its pairs but a forest that connects the same members,
at most one link per member.  A group with more than ``GROUP`` members is not
gathered: its members are sorted by Gray rank across tasks, cut into chunks of
``CHUNK``, every chunk becomes a node (shared pattern), chunk pairs whose nodes
already differ in too many bits are pruned, and the other pairs are searched
chunk against chunk.

Defined results: null and empty texts have the fingerprint zero, linked like any
other; repeated rows link to themselves; a null document id never becomes the
component id unless no other id is in the component; an empty table gives an
empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .tables import fresh, read, written

GROUP, CHUNK, LEAF, FAN, NODE = 40_000, 20_000, 8, 8, 8192
SHINGLES_AT_ONCE = 200_000


@dataclass(frozen=True)
class SimHashParams:
    shingle: int = 4
    max_bits: int = 4
    seed: int = 42
    group: int = GROUP
    chunk: int = CHUNK


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, p: SimHashParams = SimHashParams()) -> int:
    """Unsigned 64-bit SimHash of a text."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not ws:
        return 0
    joined = b" ".join(ws)
    k = min(p.shingle, len(ws))
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(ws) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    hash_, seed = xxhash.xxh64_intdigest, p.seed
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        h = [hash_(joined[s:e], seed) for s, e in zip(starts[at:at + SHINGLES_AT_ONCE], ends[at:at + SHINGLES_AT_ONCE])]
        raw = np.array(h, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def fingerprint_udf(p: SimHashParams):
    @F.pandas_udf("long")
    def run(texts):
        import pandas as pd
        return pd.Series([signed(fingerprint(t, p)) for t in texts], dtype="int64")
    return run


# ---------------------------------------------------------------- index

def gray_rank(v: np.ndarray) -> np.ndarray:
    """Position of a bit pattern in Gray-code order."""
    g = v.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        g = g ^ (g >> np.uint64(s))
    return g


def masks(max_bits: int, n: int, node: int = NODE) -> list[int]:
    """Masks of the top nodes: all choices of exact blocks, each cut to as many bits
    as make groups of about ``node`` random fingerprints out of ``n``."""
    bits = max(0, (max(n, 1) - 1) // node).bit_length()
    if not bits:
        return [0]
    for extra in (1, 2, 3, 4):
        blocks = max_bits + extra
        if 64 * extra // blocks >= bits:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    each = -(-bits // extra)
    parts = [((1 << min(each, edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    return [sum(parts[i] for i in c) for c in combinations(range(blocks), extra)]


class GrayIndex:
    """Hierarchical index over fingerprints sorted by Gray rank."""

    def __init__(self, fps: np.ndarray):
        self.values = fps[np.argsort(gray_rank(fps), kind="stable")]
        self.met = self.dropped = 0             # nodes that searches met, and dropped with all below them
        self.levels = []          # leaves first: (pattern, residual mask), child c of node i: FAN*i <= c
        size = LEAF
        ands, ors = self._reduce(self.values, self.values, LEAF)
        while True:
            self.levels.append([ands & ~(ands ^ ors), ~(ands ^ ors)])
            if len(ands) == 1:
                break
            ands, ors = self._reduce(ands, ors, FAN)
            size *= FAN
        # Keep at each node only the shared bits that its parent does not hold.
        for low, high in zip(self.levels, self.levels[1:]):
            low[1] = low[1] & ~np.repeat(high[1], FAN)[:len(low[1])]

    @staticmethod
    def _reduce(ands, ors, n):
        at = np.arange(0, len(ands), n)
        return np.bitwise_and.reduceat(ands, at), np.bitwise_or.reduceat(ors, at)

    def search(self, queries: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query positions, member positions) within ``max_bits``, in bounded blocks."""
        for at in range(0, len(queries), 512):
            q = queries[at:at + 512]
            who = np.arange(len(q))
            node = np.zeros(len(q), np.int64)
            acc = np.zeros(len(q), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                pattern, mask = self.levels[depth]
                acc = acc + np.bitwise_count((q[who] ^ pattern[node]) & mask[node])
                ok = acc <= max_bits
                self.met += len(ok)
                self.dropped += len(ok) - int(ok.sum())
                who, node, acc = who[ok], node[ok], acc[ok]
                if depth:
                    child = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    there = child < len(self.levels[depth - 1][0])
                    who, acc, node = np.repeat(who, FAN)[there], np.repeat(acc, FAN)[there], child[there]
            for cut in range(0, len(who), 100_000):
                w, n = who[cut:cut + 100_000], node[cut:cut + 100_000]
                member = (n[:, None] * LEAF + np.arange(LEAF)).ravel()
                there = member < len(self.values)
                w, member = np.repeat(w, LEAF)[there], member[there]
                hit = np.bitwise_count(q[w] ^ self.values[member]) <= max_bits
                yield w[hit] + at, member[hit]


class Forest:
    """Union of positions, vectorised: labels fall to the smallest position."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def _flat(self, x):
        while True:
            y = self.root[x]
            if np.array_equal(x, y):
                return x
            x = y

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self._flat(a), self._flat(b)
            off = a != b
            a, b = a[off], b[off]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        top = self._flat(np.arange(len(self.root)))
        rest = np.flatnonzero(top != np.arange(len(top)))
        return rest, top[rest]


def linked(fps: np.ndarray, others: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest (pairs of fingerprints) that connects what is within
    ``max_bits`` inside ``fps``, or between ``fps`` and ``others``."""
    if others is None and len(fps) <= LEAF:
        # A single leaf: compare its members.
        i, j = np.triu_indices(len(fps), 1)
        hit = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
        forest = Forest(len(fps))
        forest.link(i[hit], j[hit])
        a, b = forest.links()
        return fps[a], fps[b]
    index = GrayIndex(fps)
    nodes = index.values if others is None else np.concatenate([index.values, others])
    queries, base = (index.values, 0) if others is None else (others, len(fps))
    forest = Forest(len(nodes))
    for who, member in index.search(queries, max_bits):
        forest.link(who + base, member)
    a, b = forest.links()
    return nodes[a], nodes[b]


# ---------------------------------------------------------------- Spark

def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys."""
    n = len(keys[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


FOUND = "heavy boolean, tab int, key long, a long, b long"


def _found(heavy, tab, key, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(heavy, pa.bool_()), pa.array(tab, pa.int32()), pa.array(key, pa.int64()),
                                       pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                      ["heavy", "tab", "key", "a", "b"])


def _search_groups(p: SimHashParams):
    """Links inside the groups (tab, key); members of groups over the bound are
    passed on as heavy rows as they come, without being gathered."""
    def solve(tab, key, fp):
        out = []
        starts = _runs(tab, key)
        ends = np.append(starts[1:], len(fp))
        size = ends - starts
        # Pairs of two, by far the most frequent groups, at once.
        two = starts[size == 2]
        near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= p.max_bits]
        out.append((fp[near], fp[near + 1]))
        for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist()):
            out.append(linked(fp[s:e], None, p.max_bits))
        a = np.concatenate([x for x, _ in out]).view(np.int64)
        b = np.concatenate([x for _, x in out]).view(np.int64)
        none = np.zeros(len(a), np.int64)
        return _found(np.zeros(len(a), bool), none, none, a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.array([], np.int32), np.array([], np.int64), np.array([], np.uint64)]
        hot = None
        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            tab, key, fp = (np.concatenate([x, y]) for x, y in zip(held, new))
            if hot is not None:   # rows of the heavy group that goes on
                more = int(np.argmin(np.append((tab == hot[0]) & (key == hot[1]), False)))
                if more:
                    yield _found(np.ones(more, bool), tab[:more], key[:more], *[fp[:more].view(np.int64)] * 2)
                    tab, key, fp = tab[more:], key[more:], fp[more:]
                if not len(fp):
                    held = [tab, key, fp]
                    continue
                hot = None
            last = int(_runs(tab, key)[-1]) if len(fp) else 0
            if len(fp) - last > p.group:
                if last:
                    yield solve(tab[:last], key[:last], fp[:last])
                hot = (tab[last], key[last])
                tab, key, fp = tab[last:], key[last:], fp[last:]
                yield _found(np.ones(len(fp), bool), tab, key, *[fp.view(np.int64)] * 2)
                held = [x[:0] for x in (tab, key, fp)]
            elif last > 100_000:
                yield solve(tab[:last], key[:last], fp[:last])
                held = [tab[last:], key[last:], fp[last:]]
            else:
                held = [tab, key, fp]
        if len(held[2]):
            yield solve(*held)
    return run


def _number_chunks(chunk: int):
    """Sorted heavy rows cut into chunks of one group each."""
    def run(batches):
        from pyspark import TaskContext
        at, n, now = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            out = []
            for tab, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (tab, key) != now or n == chunk:
                    at, n, now = at + 1, 0, (tab, key)
                n += 1
                out.append(at)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.int64())],
                                             ["tab", "key", "fp", "chunk"])
    return run


def _search_pairs(p: SimHashParams):
    """Links between the two chunks of each pair (rows left, right, side, fp in pair order)."""
    def run(batches):
        now, sides = None, ([], [])
        def solve():
            left = np.array(sides[0], np.int64).view(np.uint64)
            right = np.array(sides[1], np.int64).view(np.uint64)
            a, b = linked(left, None if now[0] == now[1] else right, p.max_bits)
            none = np.zeros(len(a), np.int64)
            return _found(np.zeros(len(a), bool), none, none, a.view(np.int64), b.view(np.int64))
        for batch in batches:
            for l, r, side, fp in zip(*(c.to_pylist() for c in batch.columns)):
                if (l, r) != now:
                    if now is not None:
                        yield solve()
                    now, sides = (l, r), ([], [])
                sides[side].append(fp)
        if now is not None:
            yield solve()
    return run


def _heavy_links(heavy: DataFrame, p: SimHashParams) -> DataFrame:
    gray = F.col("fp")
    for s in (1, 2, 4, 8, 16, 32):
        gray = gray.bitwiseXOR(F.shiftrightunsigned(gray, s))
    # A signed column sorts negative numbers first; the top bit is turned for unsigned order.
    rows = (heavy.select("tab", "key", F.col("a").alias("fp"))
            .withColumn("rank", gray.bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
            .repartitionByRange("tab", "key", "rank").sortWithinPartitions("tab", "key", "rank")
            .select("tab", "key", "fp"))
    chunks = written(rows.mapInArrow(_number_chunks(p.chunk), "tab int, key long, fp long, chunk long"), "simhash-chunks")
    nodes = chunks.groupBy("tab", "key", "chunk").agg(F.bit_and("fp").alias("p"), F.bit_or("fp").alias("o"))
    nodes = nodes.select("tab", "key", "chunk", "p", F.bitwise_not(F.col("p").bitwiseXOR(F.col("o"))).alias("m"))
    l, r = nodes.alias("l"), nodes.alias("r")
    apart = F.bit_count(F.col("l.p").bitwiseXOR(F.col("r.p")).bitwiseAND(F.col("l.m")).bitwiseAND(F.col("r.m")))
    pairs = (l.join(r, (F.col("l.tab") == F.col("r.tab")) & (F.col("l.key") == F.col("r.key"))
                    & (F.col("l.chunk") <= F.col("r.chunk")))
             .where(apart <= p.max_bits).select(F.col("l.chunk").alias("left"), F.col("r.chunk").alias("right")))
    pairs = written(pairs, "simhash-chunk-pairs")
    one = pairs.join(chunks.select(F.col("chunk").alias("left"), "fp"), "left").select("left", "right", F.lit(0).alias("side"), "fp")
    two = (pairs.where("left <> right").join(chunks.select(F.col("chunk").alias("right"), "fp"), "right")
           .select("left", "right", F.lit(1).alias("side"), "fp"))
    return (one.unionByName(two).repartition("left", "right").sortWithinPartitions("left", "right", "side")
            .mapInArrow(_search_pairs(p), FOUND).select("a", "b"))


def links(distinct: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints ``fp`` of ``distinct``
    which are connected by pairs within ``max_bits``."""
    n = distinct.count()
    nodes = [F.struct(F.lit(t).alias("tab"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("key"))
             for t, m in enumerate(masks(p.max_bits, n))]
    members = distinct.select("fp", F.explode(F.array(*nodes)).alias("at")).select("at.tab", "at.key", "fp")
    found = written(members.repartition("tab", "key").sortWithinPartitions("tab", "key")
                    .mapInArrow(_search_groups(p), FOUND), "simhash-links")
    out = found.where(~F.col("heavy")).select("a", "b")
    heavy = found.where("heavy")
    if heavy.limit(1).count():
        out = out.unionByName(_heavy_links(heavy, p))
    return out


def component_ids(prints: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """(fp, label, component_id) of every distinct fingerprint of ``prints`` (doc_id, fp)."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-distinct")
    labels = components(links(distinct, p))
    tops = written(distinct.join(labels, distinct["fp"] == labels["node"], "left")
                   .select("fp", "doc_id", F.coalesce("label", "fp").alias("label")), "simhash-labels")
    # Only fingerprints that have links need their component's smallest id.
    least = tops.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return tops.join(least, "label").select("fp", "label", "component_id")


def near_duplicates(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text)."""
    prints = written(docs.select("doc_id", fingerprint_udf(p)(F.col("text")).alias("fp")), "simhash-prints")
    return prints.join(component_ids(prints, p), "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """One row of each component of ``docs``: the row with the smallest id (of
    repeated rows with that id, one)."""
    fp, comp, label, one = fresh(docs, "fp", "component_id", "label", "copy")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    marked = written(docs.withColumn(fp, fingerprint_udf(p)(F.col("text"))), "simhash-docs")
    ids = component_ids(marked.select("doc_id", F.col(fp).alias("fp")), p)
    found = marked.join(ids.select(F.col("fp").alias(fp), F.col("component_id").alias(comp),
                                     F.col("label").alias(label)), fp)
    found = found.where(F.col("doc_id").eqNullSafe(F.col(comp)))
    # Ids that are repeated among the chosen rows are few; only their rows are grouped.
    counts = marked.groupBy("doc_id").agg(F.count(F.lit(1)).alias(one)).where(F.col(one) > 1).drop(one)
    twice = written(counts.select(F.col("doc_id").alias(one)), "simhash-repeated-ids")
    if not twice.limit(1).count():
        return found.select(*cols)
    same = F.col("doc_id").eqNullSafe(F.col(one))
    single = found.join(twice, same, "left_anti")
    repeated = found.join(twice, same, "left_semi")
    first = F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64(*cols)))
    return single.select(*cols).unionByName(repeated.withColumn(one, first).where(F.col(one) == 1).select(*cols))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
