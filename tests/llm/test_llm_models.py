"""SentencePiece, token files, lattice scores, the PU classifier and the pipeline."""

import math
import os
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from spendlens.llm import lattice, pu, segments, spm, tokenbin

from llm_cases import EDGE, LONG, SCHEMA, rows_of

ODD = ["", " ", "  a  b ", "\n\n x", "▁▁x", "日本語 𝄞 é\t<s> </s> <0x41> <unk>", "a" * 3000, "don't  it's\t\tok 12³ ñ", "a\n  b", "\n\nb",
       "x \x1c!y", "a\xa0 b c  ", "é.e É,x 1.5,foo;bar", "\x00\x01", "word.Word ,x", LONG]


# ---------------------------------------------------------------- SentencePiece

@pytest.fixture(scope="module")
def texts(docs):
    return [r.text for r in docs.select("text").collect()] + ODD


def field(number, kind, payload):
    tag = bytes([number << 3 | kind]) if number < 16 else bytes([(number << 3 | kind) & 127 | 128, number >> 4])
    return tag + payload


def message(number, raw):
    size, out = len(raw), b""
    while size > 127:
        out += bytes([size & 127 | 128])
        size >>= 7
    return field(number, 2, out + bytes([size]) + raw)


def unigram_model(path):
    """A unigram model file over pieces of the public vocabulary, with made log probabilities."""
    base = spm.parse_model(open(spm.default_model(), "rb").read())
    raw = b""
    for i, p in enumerate(base.pieces[:6000] + [p for p in base.pieces[6000:] if len(p.text) == 1]):
        score = -4 - math.log(i + 2) - 0.01 * (i % 7) if p.type == spm.NORMAL else 0.0
        raw += message(1, message(1, p.text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([p.type])))
    trainer = field(3, 0, bytes([spm.UNIGRAM])) + field(35, 0, b"\x01")
    normalizer = message(1, b"identity") + message(2, b"") + field(3, 0, b"\x01") + field(4, 0, b"\x01") + field(5, 0, b"\x01")
    path.write_bytes(raw + message(2, trainer) + message(3, normalizer))
    return str(path)


def test_whole_text_parity_and_round_trip(texts):
    c = spm.Codec(spm.default_model())
    other = sentencepiece.SentencePieceProcessor(model_file=spm.default_model())
    for text, (ids, same) in zip(texts, c.encode(texts)):
        ids = ids.tolist()
        assert ids == other.encode(text) and same
        assert c.decode(ids) == other.decode(ids) == c.plain(text)
        if "▁" not in text:
            assert c.decode(ids) == text


def test_unigram_scores_and_whitespace_rules(tmp_path, texts):
    path = unigram_model(tmp_path / "u.model")
    c = spm.Codec(path)
    assert c.model.model_type == spm.UNIGRAM and c.model.remove_extra_whitespaces
    other = sentencepiece.SentencePieceProcessor(model_file=path)
    # The other library sums scores in 32 bits along the whole text; on long texts near ties fall either way.
    lines = [line[:400] for t in texts for line in t.split("\n")]
    differ = 0
    for text, (ids, same) in zip(lines, c.encode(lines)):
        theirs = other.encode(text)
        assert same == (ids.tolist() == theirs)
        assert c.decode(ids.tolist()) == other.decode(ids.tolist())
        if not same:              # equal scores only
            score = [sum(c.model.pieces[i].score for i in x) for x in (ids.tolist(), theirs)]
            assert abs(score[0] - score[1]) < 1e-3
            differ += 1
    assert differ < 0.02 * len(lines)


def test_segments_give_the_ids_of_whole_texts(texts):
    c = spm.Codec(spm.default_model(), verify=False)
    whole = [e.ids for e in c.tokenizer.encode_batch_fast([c.normalise(t) for t in texts], add_special_tokens=False)]
    for held in (10, 10**6):
        c.encoder.held = held
        assert [ids.tolist() for ids, _ in c.encode(texts)] == whole


def test_parity_is_carried_by_encode(spark, tmp_path, docs):
    """Texts on which the other library has other ids are marked, whatever the model."""
    path = unigram_model(tmp_path / "u.model")
    other = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = spm.encode(docs, path).select("text", "piece_ids", "parity").collect()
    assert all(r.parity == (list(r.piece_ids) == other.encode(r.text or "")) for r in rows)


def test_a_slice_of_texts_changes_nothing(texts, monkeypatch):
    c = spm.Codec(spm.default_model())
    want = [(ids.tolist(), same) for ids, same in c.encode(texts)]
    for size in (1, 5000):
        monkeypatch.setattr(spm, "SLICE_CHARS", size)
        c.encoder.clear()
        assert [(ids.tolist(), same) for ids, same in c.encode(texts)] == want


def test_parity_is_reported(texts):
    c = spm.Codec(spm.default_model())
    real = c.other
    class Other:
        def encode(self, batch):
            return [[0] if "lorem" in t else real.encode(t) for t in batch]
    c.other = Other()
    got = [same for _, same in c.encode(["lorem ipsum", "plain words", "ipsum"])]
    assert not got[0] and got[2] or got == [False, False, False]


def test_sentencepiece_edge_rows(spark, edge, empty, docs):
    got = spm.digests(edge).collect()
    assert len(got) == len(EDGE) and all(r.parity and r.round_trip for r in got)
    other = sentencepiece.SentencePieceProcessor(model_file=spm.default_model())
    for r in got:
        assert r.doc_id is not None or r.n_tokens > 0
    want = sorted((str(d), len(other.encode(t or "")), zlib.crc32(np.array(other.encode(t or ""), "<u4").tobytes())) for d, t, *_ in EDGE)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    out = spm.encode(edge)
    assert out.columns == [*edge.columns, "_piece_ids", "parity"] and out.where("not parity").count() == 0
    back = spm.decode(out, "_piece_ids").select("text", "decoded").collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in back)
    assert spm.digests(empty).count() == 0 and spm.encode(empty).count() == 0


def test_damaged_model_is_refused(tmp_path):
    with pytest.raises(ValueError):
        spm.parse_model(b"\x0a\xff\x01abc")


# ---------------------------------------------------------------- token files

def test_segment_store_survives_clearing():
    calls = []

    def encode(batch):
        calls.append(len(batch))
        return [[ord(c) for c in t] for t in batch]
    e = segments.SegmentEncoder(encode, np.ones(0x3000, np.int64), len, lambda s: s[0] == " ", held=3)
    rows = [["a", " b", " c"], [], [" b", " d", " e", "a"], ["zz"]]
    for _ in range(3):
        assert ["".join(map(chr, x.tolist())) for x in e.texts(rows)] == ["".join(r) for r in rows]


def test_ids_equal_whole_text_encoding(texts):
    t = Tokenizer.from_file(tokenbin.default_tokenizer())
    e = tokenbin.ByteEncoder(tokenbin.default_tokenizer())
    whole = [x.ids for x in t.encode_batch_fast([*texts, "<|endoftext|> a<|endoftext|>"], add_special_tokens=False)]
    assert [x.tolist() for x in e.texts([*texts, "<|endoftext|> a<|endoftext|>"])] == whole


def expected_files(rows):
    """(doc_id, text) rows in ascending order -> digest rows; ties in any order."""
    t = Tokenizer.from_file(tokenbin.default_tokenizer())
    start, out = 0, []
    for d, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_read_back(spark, docs, tmp_path):
    folder = f"file://{tmp_path}/ids"
    tokenbin.write(docs.repartition(5).select("doc_id", "text"), folder)
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    want = expected_files(rows)
    got = tokenbin.read_back(spark, folder, with_ids=True).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
    # The files themselves: parts in order are one flat run of ids.
    parts = sorted(spark.read.parquet(f"{folder}/manifest").collect(), key=lambda r: r.part)
    flat = np.concatenate([np.fromfile(f"{tmp_path}/ids/{p.name}.ids", "<u2") for p in parts])
    assert len(flat) == want[-1][1] + want[-1][2]
    for r in got:
        assert flat[r.start:r.start + r.n_tokens].tolist() == r.ids
    for p in parts:
        idx = np.fromfile(f"{tmp_path}/ids/{p.name}.idx", "<i8")
        assert idx[0] == p.docs and len(idx) == 2 * p.docs + 2 and idx[-1] == p.ids


def test_token_files_ignore_leftovers_of_failed_tasks(spark, tmp_path):
    folder = str(tmp_path / "ids")
    tokenbin.write(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), folder)
    (tmp_path / "ids" / "part-00000-dead.ids").write_bytes(b"\x01\x02\x03")
    got = sorted(tuple(r) for r in tokenbin.read_back(spark, folder).collect())
    assert got == expected_files([(1, "a b"), (2, None)])


def test_token_files_edge_rows(spark, edge, empty, tmp_path):
    tokenbin.write(edge.select("doc_id", "text", "tie"), str(tmp_path / "a"))
    got = tokenbin.read_back(spark, str(tmp_path / "a")).collect()
    rows = sorted(((d, t) for d, t, *_ in EDGE), key=lambda r: (r[0] is not None, r[0] or 0))
    want = expected_files(rows)
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    tokenbin.write(empty.select("doc_id", "text"), str(tmp_path / "b"))
    assert tokenbin.read_back(spark, str(tmp_path / "b")).count() == 0


# ---------------------------------------------------------------- lattice

def brute_marginal(word, texts, logp, bytes_):
    ids = {t: i for i, t in enumerate(texts) if t}
    s = lattice.MARK + word

    def at(i):
        if i == len(s):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(s) + 1):
            k = ids.get(s[i:j])
            if k is not None:
                total += math.exp(logp[k]) * at(j)
            elif j == i + 1:
                total += math.exp(sum(logp[bytes_[b]] for b in s[i:j].encode())) * at(j)
        return total
    return math.log(at(0))


def test_marginal_is_the_sum_over_all_segmentations():
    texts, logp, bytes_ = lattice.vocabulary(spm.default_model())
    words = ["the", "thon", "étion", "über", "𝄞a", "a", "x" * 9, "ingthe.", "▁"]
    got = lattice.Lattice(texts, logp, bytes_).run(words)[0]
    assert np.allclose(got, [brute_marginal(w, texts, logp, bytes_) for w in words], rtol=1e-10)
    long = lattice.Lattice(texts, logp, bytes_).run(["ab" * 5000])[0]
    assert np.isfinite(long).all() and long[0] < -10_000


def test_expected_counts_are_the_gradient_of_the_likelihood():
    texts, logp, bytes_ = lattice.vocabulary(spm.default_model())
    words, counts = ["thing", "others", "ñandú"], np.array([3.0, 2.0, 1.0])
    _, expected = lattice.Lattice(texts, logp, bytes_).run(words, counts)
    piece = texts.index("th")
    up, down = logp.copy(), logp.copy()
    up[piece] += 1e-5
    down[piece] -= 1e-5
    slope = (counts @ (lattice.Lattice(texts, up, bytes_).run(words)[0] - lattice.Lattice(texts, down, bytes_).run(words)[0])) / 2e-5
    assert abs(expected[piece] - slope) < 1e-5


def brute_scores(rows, p):
    from collections import Counter
    train = [t for d, t in rows if zlib.crc32(str("" if d is None else d).encode()) % p.held_out_of]
    c = Counter(w for t in train for w in lattice.tokens(t))
    n, v = sum(c.values()) + len(train), len(c) + bool(train)
    texts, logp, bytes_ = lattice.vocabulary(spm.default_model())
    words = list(c)
    end = 0.0
    for _ in range(p.iterations):
        mass = lattice.Lattice(texts, logp, bytes_).run(words, np.array([c[w] for w in words], float))[1] + p.smoothing
        total = mass.sum() + len(train) + p.smoothing
        moved = np.abs(np.exp(logp) - mass / total).sum()
        logp, end = np.log(mass / total), math.log10((len(train) + p.smoothing) / total)
        if moved < p.tolerance:
            break
    model = lattice.Lattice(texts, logp, bytes_)
    floor = math.log10(n + 0.1 * (v + 1))
    out = []
    for d, t in rows:
        ws = lattice.tokens(t)
        base = sum(math.log10(c[w] + 0.1) - floor for w in ws) + math.log10(len(train) + 0.1) - floor
        score = sum(model.run(ws)[0]) / math.log(10) + end if ws else end
        out.append((d, zlib.crc32(str("" if d is None else d).encode()) % p.held_out_of == 0, len(ws) + 1,
                    sum(c[w] > 0 for w in ws) + bool(train), n, base, score))
    return out


@pytest.mark.parametrize("max_broadcast", [2_000_000, 0])
def test_scores_equal_brute_force(spark, docs, edge, max_broadcast):
    p = lattice.LatticeParams(max_broadcast=max_broadcast, share=0.02)
    some = docs.where("length(text) < 3000").select("doc_id", "text").union(edge.where("length(text) < 999 or text is null").select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in some.collect()]
    got = sorted((tuple(r) for r in lattice.score(some, p).collect()), key=str)
    want = sorted(brute_scores(rows, p), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_scores_of_a_unigram_vocabulary_stay(spark, docs, tmp_path):
    """No refit: every text scores the sum over its words of the lattice under the file's own scores."""
    path = unigram_model(tmp_path / "u.model")
    some = docs.where("length(text) < 2000").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in some.collect()]
    texts, logp, bytes_ = lattice.vocabulary(path)
    train = [t for d, t in rows if zlib.crc32(str(d).encode()) % 10]
    words = sum(len(lattice.tokens(t)) for t in train)
    share = (len(train) + 0.1) / (words + len(train) + 0.2)
    model = lattice.Lattice(texts, logp + math.log1p(-share), bytes_)
    want = {d: (sum(model.run(lattice.tokens(t))[0]) if lattice.tokens(t) else 0.0) / math.log(10) + math.log10(share) for d, t in rows}
    got = {r.doc_id: r.score for r in lattice.score(some, lattice.LatticeParams(vocabulary=path)).collect()}
    assert got.keys() == want.keys() and np.allclose([got[d] for d in want], list(want.values()), rtol=1e-9)
    fitted = lattice.score(some, lattice.LatticeParams(vocabulary=path, refit=True)).agg(F.sum("score")).first()[0]
    assert fitted > sum(want.values())


def test_lattice_edge_tables(spark, empty):
    assert lattice.score(empty.select("doc_id", "text")).count() == 0
    one = lattice.score(spark.createDataFrame([(1, None), (1, LONG)], "doc_id long, text string")).collect()
    assert sorted(r.n_tokens for r in one) == [1, 40002]
    assert all(math.isfinite(r.score) and r.score < 0 for r in one)


# ---------------------------------------------------------------- PU classifier

def test_features_are_finite_for_odd_texts():
    x = pu.matrix([*ODD, None])
    assert np.isfinite(x).all() and (x[0] == x[-1]).all()


def test_pu_separates_without_negative_labels():
    rng = np.random.default_rng(2)
    def draw(n, shift):
        x = rng.normal(0, 1, (n, pu.N_FEATURES))
        x[:, :4] += shift
        return x
    positive = draw(2000, 1.0)
    unlabelled = np.concatenate([draw(1600, 1.0), draw(400, -1.5)])
    model = pu.fit(positive, unlabelled, 0.8)
    good, bad = pu.apply(model, draw(1000, 1.0)), pu.apply(model, draw(1000, -1.5))
    assert (good[:, None] > bad[None, :]).mean() > 0.99
    assert (good >= 0.5).mean() > 0.98 and good.mean() - bad.mean() > 0.4


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = pu.query(spark, folder).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.quality for r in got])
    kept = np.mean([r.predicted for r in got if r.quality == 1])
    dropped = np.mean([1 - r.predicted for r in got if r.quality == 0])
    assert right > 0.93 and kept > 0.95 and dropped > 0.6
    rank = [(r.score, r.quality) for r in got]
    ones, zeros = [s for s, q in rank if q], [s for s, q in rank if not q]
    assert np.mean([[a > b for b in zeros] for a in ones]) > 0.95


def test_pu_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (6, 1), (99, 1), (None, 1), (10, None)], "doc_id long, quality int")
    model = pu.learn(edge, labels)
    got = pu.score(edge, model).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)
    assert pu.keep_good(edge, labels).columns == edge.columns
    none = pu.learn(edge, labels.limit(0))
    assert [r.score for r in pu.score(edge, none).collect()] == pytest.approx([0.8] * len(EDGE))
    assert pu.score(empty, model).count() == 0
    assert pu.score(empty, pu.learn(empty, labels)).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_equals_its_stages_one_by_one(spark, sf_small):
    """run() against the stages applied to collected rows; each decision is checked on its own input."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, sf_small)
        assert out.columns == docs.columns, name
        rows = out.collect()
        before = {r.doc_id: r for r in now.collect()}
        assert rows and all(before[r.doc_id] == r for r in rows)
        now = spark.createDataFrame(rows, docs.schema)
    want = {r.doc_id: (r.text, list(r.piece_ids)) for r in corpus_pipeline.STAGES[-1][1](spark, now, sf_small).collect()}
    got = corpus_pipeline.run(spark, sf_small)
    assert got.columns == [*docs.columns, "piece_ids", "parity", "n_pieces"] and got.where("not parity").count() == 0
    assert {r.doc_id: (r.text, list(r.piece_ids)) for r in got.collect()} == want
    other = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(other.encode(t) == ids for t, ids in want.values())


def test_pipeline_leaves_its_result_only(spark, sf_small, tmp_path, monkeypatch):
    from spendlens.llm import tables
    monkeypatch.setattr(tables, "scratch_path", lambda s, name: str(tmp_path / name))
    out = corpus_pipeline.run(spark, sf_small)
    assert [d.name.rsplit("-", 1)[0] for d in tmp_path.iterdir()] == ["stage-sentencepiece"]
    assert out.count() > 0 and not tables._OPEN


def test_pipeline_stages_take_odd_rows(spark, edge, empty, sf_small):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge, sf_small)
        assert out.columns[:len(edge.columns)] == edge.columns, name
        assert out.count() <= len(EDGE)
        assert stage(spark, empty, sf_small).count() == 0, name


def test_entry_without_the_subpackage(tmp_path):
    """The entry still lists the other queries when the subpackage is gone."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", ".git", "spendlens"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "spendlens")
    for name in os.listdir(f"{root}/spendlens"):
        if name != "llm":
            os.symlink(f"{root}/spendlens/{name}", tmp_path / "spendlens" / name)
    with open(f"{root}/__spark_entry__.py") as f:
        text = f.read()
    os.unlink(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(text)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    n, found, oracles = said.stdout.split()[-3:]
    assert int(n) >= 50 and found == "False" and int(oracles) >= 50
