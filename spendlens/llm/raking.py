"""Mixing sources to target weights by iterative proportional fitting.

The token mass of the corpus is summed into cells (source, lang, topic).
Raking scales the cell weights to the target shares of one dimension after the
other until the marginals of all dimensions agree with their targets, or until
their gaps no longer fall (targets that no weights of the cells there are can
meet); the gap left of each dimension is returned with the cells, and ``mix`` can
be told to refuse a gap (``max_gap``).  The size
of the sample is a parameter (``keep``, a share of the tokens): a document of a
cell is kept with probability min(1, c * weight / mass), and the cells below one
are raked to what the full cells leave of the targets, so the expected token
shares of the sample are the raked weights.  A category whose target is more
than all its tokens is kept whole, however few they are; it takes nothing from
the sample of the others.  Keeping is decided by a hash of the document id:
every run and every retry decides alike.

Only cells are raked, never documents.  Their number is checked: up to
``SMALL_CELLS`` they are raked in one partition without any exchange and sent to
the documents by broadcast; beyond that the same windows run distributed and
the documents are joined by a shuffle of ids.

Everything is DataFrame functions.  Defined results: null source, language or
topic is a category of its own; a category that has tokens but no target, or a
target but no tokens, gets no weight, and the remaining targets are scaled to
one; documents without tokens have no mass and take the probability of their
cell, or zero where the cell has no mass; rows with the same id share one
decision; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import fresh, read, word_count, written

DIMS = ("source", "lang", "topic")
SMALL_CELLS = 50_000
SWEEPS_PER_STEP, TOLERANCE = 6, 1e-9
#: Steps without a gap below this share of the least one so far, after which raking ends; most steps at all.
STALLED, FALLING, STEPS = 10, 0.9, 100
#: Flattening exponents of the query: a category with share s gets a target in proportion to s ** exponent.
FLATTEN = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Share of the tokens that the sample has (the expected value).
KEEP = 0.5


def form_topic(text: Column) -> Column:
    """Topic of a text by its form (the documents carry no topic column)."""
    t = F.coalesce(text, F.lit(""))
    bars = F.char_length(t) - F.char_length(F.replace(t, F.lit("|"), F.lit("")))
    lines = F.char_length(t) - F.char_length(F.replace(t, F.lit("\n"), F.lit("")))
    n = F.char_length(t)
    return (F.when(bars * 100 > n, "table").when(n < 600, "note")
            .when(lines * 400 > n, "lines").when(n > 6000, "long").otherwise("prose"))


def cells(tokens: DataFrame) -> DataFrame:
    """Token mass and document count of every (source, lang, topic)."""
    return tokens.groupBy(*DIMS).agg(F.sum("tokens").cast("double").alias("mass"), F.count(F.lit(1)).alias("docs"))


def flattened(cell: DataFrame, exponents: dict[str, float] = FLATTEN) -> dict[str, DataFrame]:
    """Targets (value, share) per dimension from the corpus' own shares."""
    return {d: cell.groupBy(F.col(d).alias("value")).agg(F.sum("mass").alias("m")).where("m > 0")
            .select("value", F.pow("m", F.lit(e)).alias("share")) for d, e in exponents.items()}


def _factors(parts: DataFrame) -> dict[str, float]:
    """For every ``dim`` the factor by which the sum of least(room, factor * share) is one
    (beyond the sum of the rooms: infinite)."""
    found: dict[str, float] = {}
    while True:
        f = reduce(lambda e, d: e.when(F.col("dim") == d, F.lit(found[d])), found, F.when(F.lit(False), F.lit(0.0)))
        full = F.col("room") <= F.coalesce(f, F.lit(0.0)) * F.col("share")
        sums = (parts.groupBy("dim").agg(F.sum(F.when(full, F.col("room")).otherwise(0.0)).alias("held"),
                                         F.sum(F.when(~full, F.col("share")).otherwise(0.0)).alias("free")).collect())
        # The sum is concave in the factor, so these steps only rise and end with the last part that fills up.
        now = {r["dim"]: max(1.0 - r["held"], 0.0) / r["free"] if r["free"] > 0 else float("inf") for r in sums}
        if all(x <= found.get(d, -1.0) * (1 + 1e-12) for d, x in now.items()):
            return found
        found = {d: max(x, found.get(d, 0.0)) for d, x in now.items()}


def _scale(held: Column, free: Column, to: Column) -> Column:
    """Factor of a category's weights towards its target, with ``held`` in full cells and ``free`` in others."""
    return (F.when((free > 0) & (to > held), (to - held) / free).when(to < held + free, to / (held + free))
            .otherwise(F.lit(1.0)))


def rake(cell: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE,
         keep: float | None = None) -> DataFrame:
    """The cells with their raked ``weight`` (all weights sum to one) and, the same in
    every row, the largest gap between a target and its marginal in each dimension
    (``gap_source`` ..): at most ``tolerance``, or what cannot be met.

    ``targets`` has a table (value, share) for each dimension; shares need not
    sum to one.  ``keep`` is the share of the tokens (of cells with targets) that
    the sample shall have: then no weight exceeds the ``room`` of its cell, which
    is the cell's mass as a share of the sample.  A category whose target exceeds
    its room is taken whole, and the other targets of the dimension rise in
    proportion.  Without ``keep`` the room is infinite."""
    if keep is not None and not 0 < keep <= 1:
        raise ValueError(f"keep is a share above 0 and up to 1, not {keep}")
    rows = cell.select(*DIMS, "mass", "docs")
    for d, t in targets.items():
        t = t.groupBy(F.col("value").alias("value")).agg(F.sum("share").cast("double").alias(f"to_{d}"))
        rows = rows.join(t, rows[d].eqNullSafe(t["value"]), "left").drop("value")
    known = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"to_{d}"), F.lit(0.0)) > 0 for d in targets])
    start = F.when(known & (F.col("mass") > 0), F.col("mass")).otherwise(F.lit(0.0))
    rows = written(rows.select(*DIMS, "mass", "docs", *[F.col(f"to_{d}") for d in targets], start.alias("weight")),
                   "raking-cells")
    small = rows.limit(SMALL_CELLS + 1).count() <= SMALL_CELLS
    rows = rows.coalesce(1) if small else rows
    size = None if keep is None else keep * (rows.agg(F.sum("weight")).first()[0] or 1.0)
    room = F.lit(float("inf")) if size is None else F.col("weight") / F.lit(size)
    rows = rows.withColumn("room", F.when(F.col("weight") > 0, room).otherwise(F.lit(0.0)))
    # Targets of categories that have weight, scaled to one within their room.
    goals = reduce(DataFrame.unionByName, [
        rows.where("weight > 0").groupBy(d).agg(F.max(f"to_{d}").alias("share"), F.sum("room").alias("room"))
        .select(F.lit(d).alias("dim"), "share", "room") for d in targets])
    factors = _factors(written(goals, "raking-goals"))
    for d in targets:
        rows = rows.withColumn(f"to_{d}", F.least(F.col(f"to_{d}") * F.lit(factors.get(d, 1.0)),
                                                  F.sum("room").over(Window.partitionBy(d))))
    taken = F.least("weight", "room")
    least, idle = float("inf"), 0
    for _ in range(STEPS):
        for _ in range(SWEEPS_PER_STEP):
            for d in targets:
                # Full cells keep to their room; the others share what is left of the target.  A full
                # cell is scaled with its category, so it may come below its room again.
                of, full = Window.partitionBy(d), F.col("weight") >= F.col("room")
                held = F.sum(F.when(full, F.col("room")).otherwise(0.0)).over(of)
                free = F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).over(of)
                sums = F.array(F.struct(held.alias("held"), free.alias("free"), F.col(f"to_{d}").alias("to")))
                by = F.transform(sums, lambda x: _scale(x["held"], x["free"], x["to"]))[0]
                rows = rows.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight") * by).otherwise(F.lit(0.0)))
        rows = written(rows, "raking-step")
        gaps = [F.coalesce(F.max(F.abs(F.col(f"have_{d}") - F.col(f"to_{d}"))), F.lit(0.0)).alias(d) for d in targets]
        seen = rows.coalesce(1) if small else rows
        for d in targets:
            seen = seen.withColumn(f"have_{d}", F.sum(taken).over(Window.partitionBy(d)))
        gap = seen.where("weight > 0").agg(*gaps).first().asDict()
        largest = max(gap.values())
        idle = 0 if largest < FALLING * least else idle + 1
        least = min(least, largest)
        if largest <= tolerance or idle == STALLED:
            break
        rows = rows.coalesce(1) if small else rows
    if keep is not None:
        # The sample has its size whatever gap is left.
        last = _factors(rows.where("weight > 0").select(F.lit("all").alias("dim"), F.col("weight").alias("share"), "room"))
        rows = rows.withColumn("weight", F.when(F.col("weight") > 0, F.least(
            F.col("weight") * F.lit(last.get("all", 1.0)), F.col("room"))).otherwise(F.lit(0.0)))
    return rows.select(*DIMS, "mass", "docs", "room", "weight", *[F.lit(gap[d]).alias(f"gap_{d}") for d in targets])


class TargetsNotMet(ValueError):
    """Raked marginals that are off their targets; ``gaps`` by dimension."""

    def __init__(self, gaps: dict[str, float]):
        super().__init__(f"targets cannot be met: largest gaps {gaps}")
        self.gaps = gaps


def refuse(raked: DataFrame, max_gap: float) -> DataFrame:
    """``raked``, unless a dimension is off its targets by more than ``max_gap``."""
    cols = [c for c in raked.columns if c.startswith("gap_")]
    row = raked.select(*cols).first()
    gaps = {} if row is None else {c.removeprefix("gap_"): row[c] for c in cols}
    if any(g > max_gap for g in gaps.values()):
        raise TargetsNotMet(gaps)
    return raked


def probabilities(raked: DataFrame) -> DataFrame:
    """The cells with the probability ``keep_p`` of their documents: the share of
    its room that a cell fills.  Cells raked without a sample size get the largest
    probabilities that keep all marginals, so one rare cell may make them small."""
    ratio = F.when(F.col("mass") > 0, F.col("weight") / F.col("mass")).otherwise(F.lit(0.0))
    sized = F.col("room") < F.lit(float("inf"))
    top = raked.agg(F.max(F.when(~sized, ratio))).first()[0] or 1.0
    filled = F.when(F.col("room") > 0, F.least(F.col("weight") / F.col("room"), F.lit(1.0))).otherwise(F.lit(0.0))
    return raked.withColumn("keep_p", F.when(sized, filled).otherwise(ratio / F.lit(top)))


def uniform(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) from a document id and a seed."""
    return F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11) / F.lit(float(1 << 53))


def with_probability(docs: DataFrame, chances: DataFrame, keys: dict[str, Column], name: str) -> DataFrame:
    """``docs`` with the column ``name``: the probability of the cell given by ``keys``."""
    tmp = dict(zip(DIMS, fresh(docs, *[f"cell_{d}" for d in DIMS])))
    right = chances.select(*[F.col(d).alias(f"of_{d}") for d in DIMS], F.col("keep_p").alias("of_p"))
    if chances.limit(SMALL_CELLS + 1).count() <= SMALL_CELLS:
        right = F.broadcast(right)
    left = docs.select("*", *[keys[d].alias(tmp[d]) for d in DIMS])
    on = reduce(lambda a, b: a & b, [left[f"`{tmp[d]}`"].eqNullSafe(right[f"of_{d}"]) for d in DIMS])
    return (left.join(right, on, "left")
            .select(*[left[f"`{c}`"] for c in docs.columns], F.coalesce(right["of_p"], F.lit(0.0)).alias(name)))


def mix(docs: DataFrame, topic: Column | None = None, targets: dict[str, DataFrame] | None = None,
        seed: int = 17, keep: float = KEEP, max_gap: float | None = None) -> DataFrame:
    """The sampled rows of ``docs`` (all its columns), with target shares
    ``targets`` or the flattened shares of the corpus; ``keep`` is the expected
    share of the tokens in the sample.  With ``max_gap``, targets that cannot be met
    within it raise ``TargetsNotMet``."""
    keys = {"source": F.col("source"), "lang": F.col("lang"), "topic": form_topic(F.col("text")) if topic is None else topic}
    tokens = docs.select(*[keys[d].alias(d) for d in DIMS], word_count("text").alias("tokens"))
    cell = written(cells(tokens), "cells")
    raked = rake(cell, targets or flattened(cell), keep=keep)
    chances = probabilities(raked if max_gap is None else refuse(raked, max_gap))
    p, = fresh(docs, "keep_p")
    return (with_probability(docs, chances, keys, p)
            .where(uniform(F.col("doc_id"), seed) < F.col(p)).drop(p))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled documents with the probability by which each was kept."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    tokens = written(docs.select("doc_id", "source", "lang", form_topic(F.col("text")).alias("topic"),
                                 word_count("text").alias("tokens")), "mix-tokens")
    cell = written(cells(tokens), "cells")
    chances = probabilities(rake(cell, flattened(cell), keep=KEEP))
    out = with_probability(tokens, chances, {d: F.col(d) for d in DIMS}, "keep_p")
    return out.where(uniform(F.col("doc_id"), 17) < F.col("keep_p"))
