"""Phrase collocations and the alignment of two tokenizers, against plain loops."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from spendlens.llm import alignment, collocations
from spendlens.llm.collocations import Params

from llm_cases import EDGE, LONG

# ---------------------------------------------------------------- collocations


def brute_phrases(rows, p):
    """Every language's first phrases, by counting all phrases of all pieces."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, p.longest + 1):
                    if i + k <= len(w):
                        f[lang, tuple(w[i:i + k])] += 1
    cand = {x: a for x, a in f.items() if a >= p.least and len(x[1]) > 1}
    out = defaultdict(list)
    for (lang, w), a in cand.items():
        if any(lg == lang and len(v) > len(w) and b >= a and any(v[i:i + len(w)] == w for i in range(len(v)))
               for (lg, v), b in cand.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), a, f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i + 1, x[2].decode(), x[3], x[4], x[5], n[lang], -x[0])
            for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:p.top])}


def phrases(df, p):
    return {tuple(r) for r in collocations.ranked(collocations.collocations(df, p), p.top).collect()}


PROSE = ["new york city is not new york state", "New York,New York! a b a b a b a b", "a b\ta b c\na b a a a a a a a",
         "ÄRGER ärger Ärger, \xa0x y\xa0z", "x  y  z x y z x y z", "one.two three:one two three;one two", ",,, .\n", "", None]
PHRASES = [(lang, t) for lang in ("en", "de", None, "und", "") for t in PROSE for _ in range(2)]


@pytest.mark.parametrize("parts,hot", [(1, None), (7, 5)])
def test_phrases_equal_counting_everything(spark, monkeypatch, parts, hot):
    if hot:                         # many slices and blocks
        monkeypatch.setattr(collocations, "HOT", hot)
        monkeypatch.setattr(collocations, "TOKENS", 40)
        monkeypatch.setattr(collocations, "SLICES", 3)
    df = spark.createDataFrame([(i, t, lang, "clash") for i, (lang, t) in enumerate(PHRASES)],
                               "doc_id long, text string, lang string, n string").repartition(parts)
    for p in (Params(least=4, top=50), Params(least=2, longest=4, top=7)):
        assert phrases(df, p) == brute_phrases(PHRASES, p)


def test_phrases_of_odd_rows(spark, edge, empty):
    p = Params(least=3, top=100)
    assert phrases(edge, p) == brute_phrases([(lang, t) for _, t, lang, _ in EDGE], p)
    assert phrases(empty, p) == set()
    assert phrases(edge.where("length(text) < 2"), p) == set()


def test_a_full_bitmap_changes_no_count(spark, monkeypatch):
    """With eight bits almost every hash meets another."""
    monkeypatch.setattr(collocations, "_marked", lambda bitmap, h: h == h)
    df = spark.createDataFrame([(t, lang) for lang, t in PHRASES], "text string, lang string").repartition(3)
    p = Params(least=4, top=50)
    assert phrases(df, p) == brute_phrases(PHRASES, p)


def test_each_bitmap_is_sent_once(spark, monkeypatch):
    """One bitmap in a broadcast: of the frequent phrases of each length but the last once, of the hot prefixes of each level."""
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, value: sent.append(value) or send(sc, value))
    df = spark.createDataFrame([(t, lang) for lang, t in PHRASES], "text string, lang string")
    levels = collocations.stripes(df, Params(least=2, longest=4))
    assert len(levels) == 4 and all(isinstance(v, bytes) for v in sent) and len(sent) == 3 + 3


def test_stripe_totals(spark):
    df = spark.createDataFrame([(t, lang) for lang, t in PHRASES], "text string, lang string")
    first = collocations.stripes(df, Params(least=4))[0].collect()
    n = Counter()
    for lang, t in PHRASES:
        n["und" if lang is None else lang] += len(re.findall(r"[^\x20\x09-\x0D.,;:!?]+", t or ""))
    assert sum(n.values()) == sum(r.n for r in first if not r.next)


@pytest.mark.parametrize("a,n,l,r", [(100, 10**13, 100, 100), (10**12, 10**15, 10**12, 10**12 + 1), (199, 1000, 199, 1000),
                                     (10**14, 10**17, 10**14, 10**14), (123456789, 987654321987, 123456790, 123456791)])
def test_scores_are_exact(spark, a, n, l, r):
    cols = [F.lit(x).cast("long") for x in (a, n, l, r)]
    assert spark.range(1).select(collocations.exact_score(*cols)).first()[0] == 1000 * a * n // (l * r)


def test_phrase_query_equals_its_sql(spark, sf_small, monkeypatch):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    want = con.execute(collocations.SQL).fetchall()
    got = collocations.query(spark, sf_small)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == set(want) and want


# ---------------------------------------------------------------- alignment


def both():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute_alignment(texts):
    """Whole texts by both libraries; every pair of tokens is compared by its bytes."""
    a, b = both()
    alphabet = alignment.byte_alphabet()
    name = {i: t for t, i in a.get_vocab().items()}
    read = {}
    for text in set(texts):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(alphabet[c] for c in name[i]) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or {b"".join(raw_a), b"".join(raw_b)} != {(" " + text).encode()}:
            read[text] = None
            continue

        def spans(raw):
            at, out = 0, []
            for x in raw:
                out.append((at, at + len(x)))
                at += len(x)
            return out
        sa, sb = spans(raw_a), spans(raw_b)
        links, j0 = [], 0
        for x, (s, e) in zip(ids_a, sa):
            while sb[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][0] < e:
                links.append((x, ids_b[j]))
                j += 1
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, left = [], [list(zip(ids_a, sa))[::-1], list(zip(ids_b, sb))[::-1]]
        for e in ends:
            sides = []
            for tokens in left:
                side = []
                while tokens and tokens[-1][1][1] <= e:
                    side.append(str(tokens.pop()[0]))
                sides.append(",".join(side))
            groups.append("|".join(sides))
        read[text] = ids_a, ids_b, links, groups
    count = Counter(x for t in texts if read[t] for x in read[t][2])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = {}
    for text, r in read.items():
        out[text] = (0, 0, 0, 0, 0, 0, "", "") if r is None else (
            len(r[0]), len(r[1]), len(r[3]), len(r[2]), sum(count[x] == best[x[1]] for x in r[2]), sum(count[x] for x in r[2]),
            hashlib.sha256(";".join(r[3]).encode()).hexdigest(), ";".join(r[3]))
    return out


HARD = ["", "a", " ", "  ", "   a  b ", "a ", "a\n", "\n", "\n\na", "a \n b", "a\n \n b\t\tc", "x\r\ny\r z", "it's they'll can't", "naïve café ÀÉ",
        "日本語 テキスト", "𝄞 clef", "emoji 👩‍👩‍👧 ok", "<|endoftext|> here", "<s> </s> <unk> <0x41>", "▁", "a▁b c", "\x00 z", "\xa0x\xa0y ", "　z q",
        "1234567 89,000.5", "snake_case CamelCase", "...!!!???", "x" * 300, "ab " * 50, "﻿bom", "é combining", "tab\tend\t", "-" * 80, "ﬁ ligature", "\x85n\x1cq"]


@pytest.mark.parametrize("parts,pairs", [(1, 4_000_000), (5, 30)])
def test_alignment_equals_brute_force(spark, monkeypatch, parts, pairs):
    """One slice of pairs, and many of them; with repeats, null texts and null ids."""
    rows = [(i, t) for i, t in enumerate(HARD + HARD[:9] + [t for _, t, _, _ in EDGE if t != LONG])] + [(None, "a"), (None, None), (7, "a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, copies int").repartition(parts)
    want = brute_alignment([t or "" for _, t in rows])
    got = Counter(tuple(r) for r in alignment.align(df, with_groups=True, slice_pairs=pairs).collect())
    assert got == Counter((d, *want[t or ""]) for d, t in rows)


def test_a_full_store_changes_nothing(spark, docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute_alignment([t or "" for _, t in rows])
    models = alignment.default_models()
    al = alignment.Aligner(models)
    texts = [t for _, t in rows if t]
    total = Counter()
    for i in range(0, len(texts), 20):       # cleared after every few texts
        al.count(texts[i:i + 20], [1] * len(texts[i:i + 20]))
        for k, n in zip(*(x.tolist() for x in al.counted())):
            total[k >> 32, k & 0xFFFFFFFF] += n
        al.clear()
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs).collect()}
    assert got == {d: want[t or ""][:7] for d, t in rows}
    pairs = alignment.pair_counts(alignment.distinct_texts(docs), models).collect()
    assert {(r.a, r.b): r.n for r in pairs} == dict(total)


def test_alignment_of_long_texts_and_empty_tables(spark, empty):
    df = spark.createDataFrame([(1, LONG), (2, "word " * 60_000), (3, "y" * 50_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in alignment.align(df).collect()}
    want = brute_alignment([LONG, "word " * 60_000, "y" * 50_000])
    assert got[1].n_links == want[LONG][3] and got[2].groups_sha256 == want["word " * 60_000][6] and got[3].n_b == want["y" * 50_000][1]
    assert alignment.align(empty).collect() == []


def test_copies_are_joined_without_a_hot_key(spark):
    """A text of a third of the rows comes back on every one of them."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "the very same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    out = alignment.align(df.withColumnRenamed("id", "doc_id"))
    assert out.count() == 3000 and out.where("doc_id % 3 = 0").select("groups_sha256").distinct().count() == 1
