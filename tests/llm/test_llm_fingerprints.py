"""I-Match fingerprints and SimHash near-duplicates against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spendlens.llm import components, imatch, simhash

from llm_cases import EDGE, SCHEMA, rows_of, unions


def imatch_brute(rows, p):
    """(doc_id, text) rows -> expected result rows."""
    texts = [t or "" for _, t in rows]
    df = Counter()
    for t in texts:
        df.update(imatch.terms_of(t))
    n = len(texts)
    lex = {t for t, c in df.items() if n * math.exp(-p.idf_max) - 1e-6 <= c <= n * math.exp(-p.idf_min) + 1e-6}
    signer = imatch.Signer(p)

    def sign(t):
        terms = imatch.terms_of(t)
        return signer.sign([imatch.term_hash(x) for x in (terms & lex or terms)])
    order = sorted(range(n), key=lambda i: rows[i][0])
    out = []
    for k, i in enumerate(order):
        t, nxt = texts[i], texts[order[(k + 1) % n]]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        a, b, c = sign(t), sign(edited), sign(nxt)
        out.append((rows[i][0], len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b,
                    imatch.likeness(a, b), imatch.likeness(a, c)))
    return out


@pytest.mark.parametrize("max_broadcast", [3_000_000, 0])
def test_imatch_equals_brute_force(spark, docs, max_broadcast):
    p = imatch.IMatchParams(idf_min=math.log(1 / 0.3), idf_max=math.log(1 / 0.02), max_broadcast=max_broadcast)
    some = docs.where("doc_id < 80 and length(text) < 6000") if not max_broadcast else docs
    rows = [(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in imatch.fingerprints_with_edits(some, p=p).collect())
    assert got == sorted(imatch_brute(rows, p))


@pytest.mark.parametrize("n", [1000, 2000])
def test_imatch_lexicon_and_fingerprints_do_not_depend_on_partitions_or_path(spark, n):
    """Documents whose terms lie at, just under and just over both ends of the band, cut in different ways."""
    text = F.concat_ws(" ", *[F.when(F.col("id") % k == 0, F.concat(F.lit(f"t{k}x"), (F.col("id") % 3).cast("string")))
                              for k in (2, 5, 7, 50, 100, 333, 334, 499, 500, 501, 999, 1000)],
                       F.concat(F.lit("own"), "id"))
    base = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    p = imatch.IMatchParams(draws=2, levels=6)
    rows = [(r.doc_id, r.text) for r in base.collect()]
    want = sorted(imatch_brute(rows, p))
    low, high = imatch.band(n, p)
    assert low == n // 1000 and high == n // 5
    terms = None
    for parts, bound in ((1, 3_000_000), (8, 3_000_000), (51, 3_000_000), (8, 0)):
        df = base.repartition(parts)
        q = imatch.IMatchParams(draws=2, levels=6, max_broadcast=bound)
        lex = sorted((r.term, r.df) for r in imatch.lexicon(df, p=q).collect())
        terms = terms or lex
        assert lex == terms
        assert sorted(tuple(r) for r in imatch.fingerprints_with_edits(df, p=q).collect()) == want


def test_imatch_signature_does_not_depend_on_order_and_empty_is_zero():
    s = imatch.Signer(imatch.IMatchParams())
    h = [imatch.term_hash(t) for t in "a b c d".split()]
    assert s.sign(h) == s.sign(h[::-1]) == s.sign(h + h)
    assert set(s.sign([])) == {"0"} and imatch.likeness(s.sign([]), s.sign([])) == 1.0
    assert 0 <= imatch.likeness(s.sign(h), s.sign(h[:2])) < 1


def test_imatch_edge_rows(edge, empty):
    got = imatch.fingerprints_with_edits(edge).collect()
    assert len(got) == len(EDGE)
    by_text = {}
    texts = Counter((d, len(t or "")) for d, t, *_ in EDGE)
    assert Counter((r.doc_id, r.n_chars) for r in got) == texts
    for r in got:
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert {r.fingerprint for r in got if r.doc_id in (3, 4, 5)} == {imatch.Signer(imatch.IMatchParams()).empty}
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert imatch.fingerprints_with_edits(empty).count() == 0


def test_imatch_single_document_follows_itself(spark):
    one = spark.createDataFrame([(7, "alpha beta gamma delta")], "doc_id long, text string")
    r = imatch.fingerprints_with_edits(one).first()
    text = "alpha beta gamma delta"
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256((text[:11] + text[:11]).encode()).hexdigest()


# ---------------------------------------------------------------- SimHash

def simhash_brute(text, k=4):
    ws = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
          .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints_equal_brute_force_and_spark_hash(spark, docs):
    texts = [t for _, t, *_ in EDGE if t is None or len(t) < 10_000] + [r.text for r in docs.limit(40).collect()]
    for t in texts:
        assert simhash.fingerprint(t) == simhash_brute(t)
    one = "single shingle here"
    assert spark.range(1).select(F.xxhash64(F.lit(one))).first()[0] == simhash.signed(simhash.fingerprint(one))


def clusters(seed=3, centres=12, each=60):
    rng = np.random.default_rng(seed)
    out = []
    for c in rng.integers(0, 2**63, centres, dtype=np.uint64):
        for _ in range(each):
            v = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 8)):
                v ^= 1 << int(b)
            out.append(v)
    return sorted(set(out))


def brute_components(values, bits=4):
    v = np.array(values, np.uint64)
    i, j = np.triu_indices(len(v), 1)
    hit = np.bitwise_count(v[i] ^ v[j]) <= bits
    return unions(range(len(v)), zip(i[hit].tolist(), j[hit].tolist()))


def test_gray_rank_orders_neighbours_one_bit_apart():
    v = np.arange(256, dtype=np.uint64)
    order = v[np.argsort(simhash.gray_rank(v))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


def test_index_finds_every_pair():
    v = np.array(clusters(), np.uint64)
    index = simhash.GrayIndex(v)
    got = set()
    for who, member in index.search(index.values, 4):
        got |= {(int(index.values[a]), int(index.values[b])) for a, b in zip(who, member)}
    want = {(int(a), int(b)) for a in v for b in v if (int(a) ^ int(b)).bit_count() <= 4}
    assert got == want


@pytest.mark.parametrize("n", [10, 10**5, 10**7, 10**10, 10**13])
def test_masks_cover_all_pairs_within_four_bits(n):
    ms = simhash.masks(4, n)
    rng = np.random.default_rng(1)
    for _ in range(3000):
        x = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(m & x == 0 for m in ms)


@pytest.mark.parametrize("n", [1, 8192, 8193, 10**5, 10**7, 10**10])
def test_groups_are_as_large_as_a_node(n):
    """Random fingerprints meet in groups of about a node, not in groups too small to index."""
    ms = simhash.masks(4, n)
    bits = {m.bit_count() for m in ms}
    assert all(n / 2**b <= 2 * simhash.NODE and (b == 0 or n / 2**b > simhash.NODE / 8) for b in bits)


def test_the_index_carries_the_search_of_the_query(spark):
    """The groups of the query on the fingerprints of sf0.1: all members are in groups of
    many leaves, and searches drop two nodes in five with all below them."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    prints = docs.select(simhash.fingerprint_udf(simhash.SimHashParams())(F.col("text")).alias("fp")).distinct()
    fps = np.array(sorted(r.fp % 2**64 for r in prints.collect()), np.uint64)
    met = dropped = indexed = compared = pairs = 0
    ms = simhash.masks(4, len(fps))
    for m in ms:
        key = fps & np.uint64(m)
        for k in np.unique(key):
            group = fps[key == k]
            if len(group) <= simhash.LEAF:
                continue
            index = simhash.GrayIndex(group)
            for who, _ in index.search(index.values, 4):
                pass
            met, dropped, indexed, pairs = met + index.met, dropped + index.dropped, indexed + len(group), pairs + len(group) ** 2
    assert indexed == len(fps) * len(ms)
    assert dropped > 0.35 * met and met < 0.2 * pairs


def test_components_with_hubs(spark, monkeypatch):
    """Stars and chains whose hubs go the broadcast way."""
    monkeypatch.setattr(components, "HUB_SHARE", 0.05)
    rng = np.random.default_rng(3)
    edges = [(0, i) for i in range(1, 150)] + [(200, i) for i in range(140, 260) if i != 200] + [(int(a), int(b)) for a, b in rng.integers(300, 400, (60, 2))]
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    at = {v: i for i, v in enumerate(nodes)}
    want = unions(range(len(nodes)), [(at[a], at[b]) for a, b in edges if a != b])
    assert got == {v: nodes[want[i]] for v, i in at.items()}


@pytest.mark.parametrize("group,chunk", [(40_000, 20_000), (30, 16)])
def test_links_connect_as_all_pairs_do(spark, group, chunk):
    """The second case sends every larger group through the chunked path."""
    values = clusters()
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long").repartition(7)
    p = simhash.SimHashParams(group=group, chunk=chunk)
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(df, p).collect()]
    at = {v: i for i, v in enumerate(values)}
    assert all((a ^ b).bit_count() <= 64 for a, b in links)
    assert unions(range(len(values)), [(at[a], at[b]) for a, b in links]) == brute_components(values)


def test_hot_group_is_linear_in_links(spark):
    """One group of near copies: the links stay below one per member and index table."""
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**63))
    values = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (1500, 2))})
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    p = simhash.SimHashParams(group=200, chunk=100)
    out = components.components(simhash.links(df, p))
    assert out.select("label").distinct().count() == 1 and out.count() == len(values)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [simhash_brute(t) for _, t in rows]
    values = sorted(set(fps))
    comp = dict(zip(values, brute_components(values)))
    least = {}
    for (d, _), f in zip(rows, fps):
        least[comp[f]] = min(d, least.get(comp[f], d))
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f, least[comp[f]]) for (d, _), f in zip(rows, fps)}


def test_simhash_edge_rows(spark, edge, empty):
    got = simhash.near_duplicates(edge).collect()
    assert len(got) == len(EDGE)
    assert {r.fp for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5)} == {3}
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    kept = simhash.deduplicate(edge)
    assert kept.columns == edge.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[3] == 1 and ids[4] == 0 and ids[None] == 1
    twice = spark.createDataFrame(rows_of([(2, "same words in both of these rows", "en", "a")] * 3), SCHEMA)
    assert simhash.deduplicate(twice).count() == 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0
