"""Chat formatting, token rollups, raking and host rules."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import chat, hostrules, raking, rollup

from llm_cases import EDGE, LONG

# ---------------------------------------------------------------- chat

EVENT = "conv_id long, seq long, message long, event string, role string, text string, formatted string"


def log(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], EVENT)


def fold_brute(rows):
    """conv -> [(role, text)] of an event log, one event after the other."""
    convs = defaultdict(dict)
    for c, s, m, e, role, text in sorted(set(rows), key=lambda r: (r[0], r[1], r[3], r[5] or "")):
        msgs = convs[c]
        if e == "regenerate":
            for later in [k for k in msgs if k > m]:
                del msgs[later]
        if e in ("message", "edit"):
            body = text or ""
        elif e == "regenerate":
            body = ""
        else:
            body = msgs.get(m, (None, ""))[1] + (text or "")
        msgs[m] = (role if role is not None else msgs.get(m, ("",))[0] or "", body)
    return {c: [v for _, v in sorted(msgs.items())] for c, msgs in convs.items()}


LOG = [
    (1, 1, 1, "message", "user", "hello "), (1, 2, 1, "delta", None, "there"),
    (1, 3, 2, "message", "assistant", ""), (1, 4, 2, "delta", None, "Hi"), (1, 5, 2, "delta", None, "!"),
    (1, 6, 2, "regenerate", None, None), (1, 7, 2, "delta", None, "Good day"),
    (1, 8, 3, "message", "user", "x"), (1, 9, 1, "edit", None, "HELLO"), (1, 10, 4, "message", "assistant", "old"),
    (1, 11, 2, "regenerate", None, None), (1, 12, 2, "delta", None, "Again"), (1, 13, 3, "message", "user", "new </s>"),
    (4, 1, 1, "message", "user", "q"), (4, 2, 2, "delta", "assistant", "gone"), (4, 3, 3, "edit", "user", "gone too"),
    (4, 4, 1, "regenerate", None, None), (4, 5, 1, "delta", None, "q2"), (4, 6, 2, "delta", "assistant", "only "), (4, 7, 2, "delta", None, "deltas"),
    (5, 1, 1, "message", "user", "a"), (5, 2, 2, "message", "assistant", "b"), (5, 3, 1, "regenerate", None, None), (5, 4, 2, "delta", "assistant", "late"),
    (2, 1, 1, "message", "system", "<|turn|>\\<|end|>"), (2, 1, 1, "message", "system", "<|turn|>\\<|end|>"),
    (3, 5, 1, "message", "assistant", "a"), (3, 6, 1, "delta", None, "b"), (3, 6, 1, "delta", None, "b"),
]


def test_fold_equals_replay(spark):
    got = defaultdict(list)
    for r in sorted(chat.fold(log(spark, LOG)).collect(), key=lambda r: (r.conv_id, r.message)):
        got[r.conv_id].append((r.role, r.text))
    assert dict(got) == fold_brute(LOG)


def read_all(df):
    out = df.select("conv_id", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("turns"),
                    chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r.conv_id: r for r in out.collect()}


def test_render_reads_back_and_masks_assistants(spark):
    texts = [chat.CHALLENGE, "<|turn|>x<|text|>y<|end|>", "\\", "\\\\<s>", "<\\s>", "<", "[", "[INST", "<<SYS>>a<</SYS>>", "", "日本 𝄞",
             "a\\<|end|>", "<|<|end|>|>"]
    rows = [(1, i, i, "message", ("assistant", "user", "<|text|>")[i % 3], t) for i, t in enumerate(texts)]
    r = read_all(chat.format_log(log(spark, rows)))[1]
    assert [(t.role, t.text) for t in r.turns] == [(x[4], x[5]) for x in rows]
    assert r.loss == "".join(x[5] for x in rows if x[4] == "assistant")
    raw = r.formatted.encode()
    for span, want in zip(r.loss_spans, [x[5] for x in rows if x[4] == "assistant"]):
        cut = raw[span.start:span.start + span.bytes].decode()
        assert not any(c in cut for c in chat.CONTROL) and len(cut) >= len(want)
    assert r.formatted.count(chat.TURN) == r.formatted.count(chat.END) == len(rows)


def test_chat_edge_rows(spark):
    rows = [(None, 1, 1, "message", None, None), (4, None, None, "message", "assistant", None), (5, 1, 1, "odd", "user", "t"),
            (6, 1, 1, "message", "assistant", LONG)]
    got = read_all(chat.format_log(log(spark, rows)))
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")]
    assert [(t.role, t.text) for t in got[4].turns] == [("assistant", "")] and got[4].loss == ""
    assert [(t.role, t.text) for t in got[5].turns] == [("user", "t")]
    assert got[6].loss == LONG
    assert chat.format_log(log(spark, [])).count() == 0


def test_the_log_of_a_table_needs_folding(spark, sf_small):
    """Deltas, an edit and a regeneration in every conversation; unfolded, the texts are others."""
    turns = spark.read.parquet(f"{sf_small}/conversations.parquet").withColumn("message", F.lit("clash")).withColumn("cut", F.lit(1))
    events = chat.as_log(turns)
    kinds = {r.event for r in events.select("event").distinct().collect()}
    assert kinds == {"message", "delta", "edit", "regenerate"}
    got = sorted(map(tuple, chat.fold(events).select("conv_id", "message", "role", "text").collect()))
    by = defaultdict(list)
    for r in turns.collect():
        by[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    assert got == sorted((c, i + 1, role, text) for c, rows in by.items() for i, (_, role, text) in enumerate(sorted(rows)))
    assert got == sorted((c, i + 1, *m) for c, ms in fold_brute([tuple(r) for r in events.select(*chat.EVENTS).collect()]).items()
                         for i, m in enumerate(ms))


def test_turns_with_ties_and_repeats_are_all_kept(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = read_all(chat.format_log(chat.as_log(df)))[1]
    assert [(t.role, t.text) for t in r.turns] == [("system", ""), ("user", "a"), ("user", "a"), ("user", "b")]


def test_op2_query_digests(spark, sf_small):
    rows = {r.conv_id: r for r in chat.query(spark, sf_small).collect()}
    want = f"user\n{chat.CHALLENGE}\nassistant\n{chat.CHALLENGE}\n"
    assert rows[-1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert rows[-1].loss_sha256 == hashlib.sha256(chat.CHALLENGE.encode()).hexdigest()
    assert rows[-1].loss_chars == len(chat.CHALLENGE) and rows[-1].n_turns == 2


# ---------------------------------------------------------------- rollups

CHANGE = "old struct<source:string,lang:string,tokenizer:string,tokens:long>, new struct<source:string,lang:string,tokenizer:string,tokens:long>"


def totals(ledger):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in ledger.totals().collect()}


def test_ledger_is_additive_idempotent_and_compacts(spark, tmp_path):
    a, b = ("s1", "en", "v1"), ("s1", "en", "v2")
    ledger = rollup.TokenLedger(spark, str(tmp_path / "ledger"))
    insert = spark.createDataFrame([(None, (*a, 10)), (None, (*a, 5)), (None, (*a, 5)), (None, (None, None, "v1", None))], CHANGE)
    ledger.commit(1, rollup.deltas(insert))
    assert totals(ledger) == {a: (3, 20), (None, None, "v1"): (1, 0)}
    revise = spark.createDataFrame([((*a, 10), (*b, 12)), ((*a, 5), None)], CHANGE)
    for _ in range(3):
        ledger.commit(2, rollup.deltas(revise))
    want = {a: (1, 5), b: (1, 12), (None, None, "v1"): (1, 0)}
    assert totals(ledger) == want
    small = ledger.compact(str(tmp_path / "small"), 1)
    assert totals(small) == want
    small.commit(2, rollup.deltas(revise))
    assert totals(small) == want
    ledger.commit(2, rollup.deltas(revise.limit(0)))   # an empty batch takes its old rows away
    assert totals(ledger) == {a: (3, 20), (None, None, "v1"): (1, 0)}
    ledger.commit(3, rollup.deltas(spark.createDataFrame([((*a, 10), None), ((*a, 5), None), ((*a, 5), None)], CHANGE)))
    assert totals(ledger) == {(None, None, "v1"): (1, 0)}


def test_a_batch_that_was_compacted_is_closed(spark, tmp_path):
    key = ("s", "en", "v1")
    rows = rollup.deltas(spark.createDataFrame([(None, (*key, 10))], CHANGE))
    ledger = rollup.TokenLedger(spark, str(tmp_path / "ledger"))
    assert ledger.watermark() == -1 and all(ledger.commit(b, rows) for b in (0, 1, 2, 3))
    small = ledger.compact(str(tmp_path / "small"), 2)
    assert small.watermark() == 2 and totals(small) == {key: (4, 40)}
    assert not small.commit(2, rows) and not small.commit(0, rows) and small.commit(3, rows)
    assert totals(small) == {key: (4, 40)}
    less = small.compact(str(tmp_path / "less"), 1)       # an earlier bound opens nothing again
    assert less.watermark() == 2 and not less.commit(2, rows) and totals(less) == {key: (4, 40)}
    assert less.commit(4, rows) and totals(less) == {key: (5, 50)}
    with pytest.raises(ValueError):
        ledger.commit(-1, rows)


def test_rollup_odd_rows_and_empty_tables(spark, edge, empty, tmp_path):
    for name, docs in (("edge", edge), ("empty", empty)):
        path = tmp_path / name
        docs.write.parquet(str(path / "documents.parquet"))
        got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.query(spark, str(path)).collect()}
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
        want = {x[:3]: x[3:] for x in con.execute(rollup.SQL).fetchall()}
        assert got == want


def test_rollup_of_a_later_batch_first(spark, tmp_path):
    ledger = rollup.TokenLedger(spark, str(tmp_path / "ledger"))
    key = ("s", "en", "v1")
    ledger.commit(9, rollup.deltas(spark.createDataFrame([((*key, 4), (*key, 7))], CHANGE)))
    ledger.commit(8, rollup.deltas(spark.createDataFrame([(None, (*key, 4))], CHANGE)))
    assert totals(ledger) == {key: (1, 7)}


# ---------------------------------------------------------------- raking

def ipf_brute(mass, targets, sweeps=60):
    """numpy raking of a dict cell -> mass."""
    cells = sorted(mass, key=str)
    w = np.array([mass[c] if all(targets[d].get(c[k], 0) > 0 for k, d in enumerate(raking.DIMS)) else 0.0 for c in cells], float)
    goals = {}
    for k, d in enumerate(raking.DIMS):
        live = {c[k] for c, x in zip(cells, w) if x > 0}
        total = sum(v for c, v in targets[d].items() if c in live)
        goals[d] = {c: v / total for c, v in targets[d].items() if c in live}
    for _ in range(sweeps):
        for k, d in enumerate(raking.DIMS):
            for c, goal in goals[d].items():
                at = [i for i, x in enumerate(cells) if x[k] == c]
                if w[at].sum() > 0:
                    w[at] *= goal / w[at].sum()
    return dict(zip(cells, w))


def test_raking_meets_marginals_and_numpy(spark):
    rng = np.random.default_rng(4)
    cells = [(s, l, t, float(rng.integers(1, 1000)), 5) for s in ("a", "b", None) for l in ("en", "de") for t in ("x", "y")]
    cells.append(("a", "zz", "x", 50.0, 2))       # no target for this language
    cells.append(("b", "en", "z", 0.0, 3))        # no mass
    df = spark.createDataFrame(cells, "source string, lang string, topic string, mass double, docs long")
    targets = {"source": {"a": 1.0, "b": 2.0, None: 1.0, "unseen": 5.0}, "lang": {"en": 0.9, "de": 0.1},
               "topic": {"x": 3.0, "y": 1.0, "z": 1.0}}
    tables = {d: spark.createDataFrame(list(t.items()), "value string, share double") for d, t in targets.items()}
    got = {(r.source, r.lang, r.topic): r.weight for r in raking.rake(df, tables).collect()}
    want = ipf_brute({(s, l, t): m for s, l, t, m, _ in cells}, targets)
    assert got.keys() == want.keys()
    assert all(abs(got[c] - want[c]) < 1e-8 for c in want)
    assert abs(sum(v for c, v in got.items() if c[0] == "b") - 0.5) < 1e-8
    assert got[("a", "zz", "x")] == got[("b", "en", "z")] == 0.0


def test_probabilities_hit_the_raked_shares(spark, docs):
    tokens = docs.select("doc_id", "source", "lang", raking.form_topic(F.col("text")).alias("topic"),
                         raking.word_count("text").alias("tokens"))
    cell = raking.cells(tokens)
    raked = raking.rake(cell, raking.flattened(cell))
    rows = raking.probabilities(raked).collect()
    expected = np.array([r.keep_p * r.mass for r in rows])
    assert np.allclose(expected / expected.sum(), [r.weight for r in rows])
    assert max(r.keep_p for r in rows) == 1.0 and min(r.keep_p for r in rows) >= 0


def test_mix_keeps_by_hash_and_by_chunks_alike(spark, docs, monkeypatch):
    kept = sorted(r.doc_id for r in raking.mix(docs).collect())
    monkeypatch.setattr(raking, "SMALL_CELLS", 3)     # the distributed windows and the shuffle join
    assert sorted(r.doc_id for r in raking.mix(docs.limit(10**6)).collect()) == kept
    assert 0 < len(kept) < docs.count()


def test_one_small_source_does_not_set_the_sample_size(spark, docs):
    d = docs.select("doc_id", "source", "lang", "text")
    d = d.unionByName(spark.createDataFrame([(-77, "one-document source", "en", "only three words")], d.schema))
    tokens = d.select("doc_id", "source", "lang", raking.form_topic(F.col("text")).alias("topic"),
                      raking.word_count("text").alias("tokens")).cache()
    kept = {r.doc_id for r in raking.mix(d).collect()}
    share = sum(r.tokens for r in tokens.collect() if r.doc_id in kept) / sum(r.tokens for r in tokens.collect())
    assert -77 in kept and abs(share - raking.KEEP) < 0.1


def test_full_cells_leave_their_targets_to_the_others(spark):
    cells = [("a", "en", "x", 600.0, 6), ("a", "de", "x", 300.0, 3), ("b", "en", "x", 90.0, 3), ("c", "de", "x", 10.0, 1)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, mass double, docs long")
    targets = {"source": {"a": 1.0, "b": 1.0, "c": 1.0}, "lang": {"en": 1.0, "de": 1.0}, "topic": {"x": 1.0}}
    tables = {d: spark.createDataFrame(list(t.items()), "value string, share double") for d, t in targets.items()}
    rows = raking.probabilities(raking.rake(df, tables, keep=0.4)).collect()
    got = {(r.source, r.lang): r.keep_p * r.mass for r in rows}
    # Of 400 tokens b and c, whose targets exceed them, give all 100; a gives 300, so that en and de have 200 each.
    assert np.allclose([got["b", "en"], got["c", "de"], got["a", "en"], got["a", "de"]], [90, 10, 110, 190], atol=1e-4)


def tables_of(spark, targets):
    return {d: spark.createDataFrame(list(t.items()), "value string, share double") for d, t in targets.items()}


def test_targets_that_cannot_be_met_are_reported(spark):
    """Two cells on a diagonal: source asks for halves, language for 9 to 1."""
    df = spark.createDataFrame([("a", "en", "x", 10.0, 1), ("b", "de", "x", 10.0, 1)], "source string, lang string, topic string, mass double, docs long")
    raked = raking.rake(df, tables_of(spark, {"source": {"a": 1.0, "b": 1.0}, "lang": {"en": 9.0, "de": 1.0}, "topic": {"x": 1.0}}))
    row = raked.first()
    assert max(row.gap_source, row.gap_lang) > 0.3 and row.gap_topic < 1e-9
    with pytest.raises(raking.TargetsNotMet) as off:
        raking.refuse(raked, 0.01)
    assert set(off.value.gaps) == {"source", "lang", "topic"}


def test_targets_met_only_in_the_limit_end_with_their_gap(spark):
    """A cell would have to vanish: the gap falls ever more slowly and is told."""
    cells = [("a", "en", "x", 10.0, 1), ("b", "en", "x", 10.0, 1), ("b", "de", "x", 10.0, 1)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, mass double, docs long")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"x": 1.0}}
    rows = raking.rake(df, tables_of(spark, targets)).collect()
    have = sum(r.weight for r in rows if r.source == "a")
    assert abs(abs(have - 0.5) - rows[0].gap_source) < 1e-12 and raking.TOLERANCE < max(rows[0].gap_source, rows[0].gap_lang) < 0.05


def capped_brute(mass, targets, keep, sweeps=3000):
    """Raking with rooms in numpy: cell -> probability of its documents."""
    cells = sorted(mass, key=str)
    w = np.array([mass[c] if all(targets[d].get(c[k], 0) > 0 for k, d in enumerate(raking.DIMS)) else 0.0 for c in cells], float)
    room = w / (keep * w.sum())
    live = w > 0

    def fill(share, cap):                 # shares in proportion, none above its cap, one in all
        f = 0.0
        for _ in range(1000):
            full = cap <= f * share
            free = share[~full].sum()
            g = max(1 - cap[full].sum(), 0) / free if free > 0 else np.inf
            if g <= f * (1 + 1e-13):
                break
            f = g
        return np.minimum(f * share, cap)
    goals = []
    for k, d in enumerate(raking.DIMS):
        names = sorted({c[k] for c, x in zip(cells, live) if x}, key=str)
        groups = [np.array([live[i] and c[k] == n for i, c in enumerate(cells)]) for n in names]
        goals.append(list(zip(groups, fill(np.array([targets[d][n] for n in names]), np.array([room[g].sum() for g in groups])))))
    for _ in range(sweeps):
        for dim in goals:
            for g, to in dim:
                full = g & (w >= room)
                held, free = room[full].sum(), w[g & ~full].sum()
                by = (to - held) / free if free > 0 and to > held else to / (held + free) if to < held + free else 1.0
                w[g] *= by
    w[live] = fill(w[live], room[live])
    return {c: (min(x / r, 1.0) if r > 0 else 0.0) for c, x, r in zip(cells, w, room)}


def test_op4_query_equals_brute_force(spark, sf_small):
    """The whole query: cells, targets, probabilities and decisions, worked out row by row."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = docs.select("doc_id", "source", "lang", raking.form_topic(F.col("text")).alias("topic"), "text",
                       raking.uniform(F.col("doc_id"), 17).alias("u")).collect()
    mass = defaultdict(float)
    for r in rows:
        mass[r.source, r.lang, r.topic] += len([w for w in re.split("[\x20\x09-\x0D]+", r.text or "") if w])
    targets = {}
    for k, d in enumerate(raking.DIMS):
        total = defaultdict(float)
        for c, m in mass.items():
            total[c[k]] += m
        targets[d] = {v: m ** raking.FLATTEN[d] for v, m in total.items() if m > 0}
    p = capped_brute(mass, targets, raking.KEEP)
    got = {r.doc_id: r for r in raking.query(spark, sf_small).collect()}
    sure = [r for r in rows if abs(p[r.source, r.lang, r.topic] - r.u) > 1e-5]
    assert len(sure) > 0.99 * len(rows)
    assert all((r.doc_id in got) == (r.u < p[r.source, r.lang, r.topic]) for r in sure)
    assert all(abs(r.keep_p - p[r.source, r.lang, r.topic]) < 1e-5 for r in got.values())


def test_mix_edge_rows(edge, empty):
    got = raking.mix(edge)
    assert got.columns == edge.columns
    ids = Counter(r.doc_id for r in got.collect())
    assert ids[2] in (0, 2) and ids[None] in (0, 1, 2)
    assert raking.mix(empty).count() == 0


# ---------------------------------------------------------------- host rules

def rules_brute(text):
    blanks = " \t\n\r\x0b\x0c"
    t = text or ""
    ws, lines, cover, seen = [], set(), set(), defaultdict(list)
    word = ""
    for c in t + " ":
        if c in blanks:
            if word:
                ws.append(word)
            word = ""
        else:
            word += c
    for i in range(len(ws) - 2):
        seen[tuple(ws[i:i + 3])].append(i)
    for places in seen.values():
        if len(places) > 1:
            cover |= {i + k for i in places for k in range(3)}
    dup = 0
    for line in t.split("\n"):
        if any(c not in blanks for c in line):
            dup += line in lines
            lines.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_counts_equal_brute_force(edge, docs):
    for df in (edge, docs):
        rows = df.select("text", hostrules.stats(F.col("text")).alias("s")).collect()
        for r in rows:
            got = (r.s.w.n_words, r.s.word_chars, r.s.n_symbols, r.s.n_dup_lines, r.s.w.n_repeat_words)
            assert got == rules_brute(r.text)


def test_bad_host_is_rejected_and_small_hosts_are_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", "good") for i in range(400)]
    rows += [(1000 + i, good if i % 20 == 0 else "short", "bad") for i in range(200)]
    rows += [(2000, "short", "tiny"), (2001, good, "tiny"), (3000, good, None)]
    rows += [(4000 + 10 * h + i, good if i else "short", f"h{h}") for h in range(5) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in hostrules.judge(df).collect()}
    assert not got[1000].base_failed and not got[1000].kept          # a good document of a bad host
    assert got[1].kept and got[2001].kept and got[3000].kept
    assert not any(r.kept for r in got.values() if r.base_failed)
    kept = hostrules.apply_rules(df)
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


def test_host_rules_edge_rows(edge, empty):
    got = hostrules.judge(edge).collect()
    assert len(got) == len(EDGE) and all(r.base_failed for r in got)   # all short or repetitive
    assert hostrules.apply_rules(edge).columns == edge.columns and hostrules.apply_rules(edge).count() == 0
    assert hostrules.judge(empty).count() == 0 and hostrules.apply_rules(empty).count() == 0
