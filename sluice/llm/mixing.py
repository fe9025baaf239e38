"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted for each cell, a combination of one value of each dimension (source, language, topic). Raking then gives
each cell a keep probability so that the expected kept tokens of every value of every dimension meet its target, and
documents are drawn with these probabilities. A document can only be kept or not, so raking is bounded: no probability
exceeds 1, and what a value cannot supply goes to the others in proportion.

A target is either a table of shares by value or a power p: the value's share of all tokens, raised to p (0: all values
alike, 1: as they are). Values that a table does not list, null among them, stay at their share of all tokens and the listed
ones are raked among themselves for the rest; if the table lists `OTHER`, they get its share together, each by its tokens.
Every value of a dimension has a marginal of its own; null counts as the value `OTHER`.

Cells are stored and measured. If they are small enough to be broadcast, they are raked on the driver, else on Spark: in each round
the tokens of each dimension's values are summed, combined before the shuffle, and the factors joined back to the cells; the factors of
dimensions that are measured as small are kept on the driver meanwhile. All ways take the same steps, so p does not depend on the way but
for the rounding of sums. Nothing of the size of the cells then passes the driver or a broadcast.

Rounds go on until the worst value is within `CLOSE` of all tokens of its goal. Goals that contradict each other can't all be met:
rounds end when `PATIENCE` of them have not brought the worst value nearer by a tenth; the goals of the last dimension are then met as
far as its values can, and the others as that allows. `reached` shows what came of every goal.

A draw depends on seed, id and text alone: repeated rows share their fate, runs agree. Null and empty texts have
no token; cells without tokens are kept whole. A table with no rows gives an empty result. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored, whole_row
from sluice.operators.skew import join_facts
from sluice.plans.sizes import BROADCAST_BYTES, fits_broadcast
from sluice.sources.tables import drop_table, write_scratch_table

OTHER = "(other)"
ROUNDS, CLOSE, PATIENCE, REPLAYED = 1_000_000, 1e-6, 50, 10
Target = float | Mapping[str, float]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def form_of(text: Column) -> Column:
    """A topic that needs no model: the form of a text. Any other column of few values can take its place."""
    size = F.coalesce(F.char_length(text), F.lit(0))
    signs = size - F.char_length(F.translate(text, "#*$%&|<>", ""))
    return (
        F.when(signs * 50 > size, "signs").when(size < 400, "note").when(size < 4000, "article").otherwise("long")
    )


def sample(
    docs: DataFrame, dimensions: Mapping[str, Column], tokens: Column, targets: Mapping[str, Target], keep: float,
    text: str = "text", doc_id: str = "doc_id", seed: int = 7, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every row of `docs` with its fate: row (a struct of its columns), one column for each dimension, n_tokens, p, kept.

    `keep` is the share of all tokens that is to stay. Cells of more than `limit` bytes are raked on Spark.
    """
    names = list(dimensions)
    rows = docs.select(
        *[F.coalesce(c.cast("string"), F.lit(OTHER)).alias(n) for n, c in dimensions.items()], tokens.alias("n_tokens"),
        (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 11) / F.lit(float(1 << 53))).alias("draw"),
        whole_row(docs).alias("row"),
    )
    cells = stored(rows.groupBy(*names).agg(F.sum("n_tokens").alias("n_tokens")))
    if fits_broadcast(cells, limit):
        found = cells.orderBy(*names).toArrow()
        p = rake(
            found["n_tokens"].to_numpy().astype(float), [found[n].to_pylist() for n in names], [targets[n] for n in names], keep
        )
        shares = found.drop_columns("n_tokens").append_column("p", pa.array(p, pa.float64()))
        rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame(shares)), names)
    else:
        rows = join_facts(rows, raked(cells, names, targets, keep, limit), names, "left", limit=limit)
    return rows.select("row", *names, "n_tokens", "p", (F.col("draw") < F.col("p")).alias("kept"))


def rake(tokens: np.ndarray, values: list[list[str]], targets: list[Target], keep: float) -> np.ndarray:
    """Keep probabilities of cells with `tokens`; `values[d]` has their values of dimension d."""
    p = np.ones(len(tokens))
    total = tokens.sum()
    if not total:
        return p
    goals: list[tuple[np.ndarray, np.ndarray]] = []
    for of, target in zip(values, targets):
        number = {v: k for k, v in enumerate(sorted(set(of)))}
        codes = np.fromiter(map(number.__getitem__, of), np.int64, len(of))
        held = np.bincount(codes, tokens)
        if isinstance(target, Mapping):
            share = _listed(list(number), held, target)
        else:
            share = np.where(held > 0, np.power(np.maximum(held, 1) / total, target), 0.0)
        goals.append((codes, _shared_out(held, share, keep * total)))
    p *= keep
    progress = _Progress(total)
    for _ in range(ROUNDS):
        worst = 0.0
        for codes, goal in goals:
            worst = max(worst, np.abs(np.bincount(codes, tokens * p) - goal).max())
            p = _scaled(tokens, p, codes, goal)
        if progress.ends(worst):
            break
    return np.where(tokens > 0, p, 1.0)


class _Progress:
    """When rounds end: the same for both ways."""

    def __init__(self, total: float) -> None:
        self._close, self._worst = CLOSE * total, []

    def ends(self, worst: float) -> bool:
        self._worst = [*self._worst[-PATIENCE:], worst]
        return worst <= self._close or len(self._worst) > PATIENCE and worst > 0.9 * self._worst[0]


def reached(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Of `sample`'s rows: dimension, value, its tokens, and those expected to stay and kept, for every value of every dimension."""
    sums = [
        F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_tokens") * F.col("p")).alias("expected"),
        F.sum(F.when(F.col("kept"), F.col("n_tokens")).otherwise(0)).alias("kept"),
    ]
    cells = stored(rows.groupBy(*names).agg(*sums))
    each = [cells.groupBy(F.lit(n).alias("dimension"), F.col(n).alias("value")).agg(*[F.sum(c).alias(c) for c in cells.columns[-3:]]) for n in names]
    return reduce(DataFrame.unionByName, each)


def _listed(names: list[str], held: np.ndarray, target: Mapping[str, float]) -> np.ndarray:
    """Shares by a table; values without one of their own share what is left to them by their tokens."""
    own = np.array([v in target and v != OTHER for v in names])
    share = np.array([float(target[v]) if o else 0.0 for v, o in zip(names, own)])
    rest = held[~own].sum()
    if OTHER in target:
        return np.where(own, share, float(target[OTHER]) * held / max(rest, 1))
    listed = share[held > 0].sum()
    return np.where(own, share * (held.sum() - rest) / (listed or 1.0), held)


def _shared_out(held: np.ndarray, share: np.ndarray, total: float) -> np.ndarray:
    """`total` in proportion to `share`, none more than it holds."""
    weight = np.divide(share, held, out=np.zeros(len(held)), where=held > 0)
    return held * _scaled(held, weight, np.zeros(len(held), np.int64), np.array([total]))


def _scaled(tokens: np.ndarray, p: np.ndarray, codes: np.ndarray, goals: np.ndarray) -> np.ndarray:
    """min(1, f * p) with the f of each code for which its tokens kept come to its goal; all that can be kept if that is less.

    A code's f grows from one that is too small, which keeps no cell whole, by the cells that it would keep whole.
    """
    f, whole = np.zeros(len(goals)), np.zeros(len(p), bool)
    while True:
        full = np.bincount(codes, np.where(whole, tokens, 0.0), len(goals))
        rest = np.bincount(codes, np.where(whole, 0.0, tokens * p), len(goals))
        f = np.maximum(f, np.divide(goals - full, rest, out=np.full(len(goals), np.inf), where=rest > 0))
        some = p > 0
        scaled = np.multiply(f[codes], p, out=np.zeros(len(p)), where=some)
        more = (scaled > 1) & ~whole & (tokens > 0)
        if not more.any():
            return np.minimum(1.0, scaled)
        whole |= more


def raked(cells: DataFrame, names: list[str], targets: Mapping[str, Target], keep: float, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`rake` on Spark, for `cells` of any number: their values of `names`, and p.

    Cells and factors are scratch tables, dropped when those of the next round are written.
    """
    spark = cells.sparkSession
    held = cells.filter("n_tokens > 0")
    total = float(held.agg(F.sum("n_tokens")).first()[0] or 0)
    goals = [(n, stored(_goals(held, n, targets[n], keep * total, total))) for n in names] if total else []
    few = {n: fits_broadcast(goal, limit) for n, goal in goals}
    none = cells.filter("not coalesce(n_tokens > 0, false)").select(*names, F.lit(1.0).alias("p"))
    if goals and all(few.values()):
        return stored(_raked_by_factors(held, dict(goals), keep, total).select(*names, "p").unionByName(none))
    at, made, progress = held.withColumn("p", F.lit(float(keep))), [], _Progress(total)
    for _ in range(ROUNDS if goals else 0):
        worst, before = 0.0, made
        made = []
        for n, goal in goals:
            name, off = _factors(at, n, goal, few[n])
            worst, made = max(worst, off), [*made, name]
            at = _times(at, spark.table(name), n, few[n]).drop("f")
        made = [*made, write_scratch_table(at)]
        at = spark.table(made[-1])
        for name in before:
            drop_table(spark, name)
        if progress.ends(worst):
            break
    out = stored(at.select(*names, "p").unionByName(none))
    for name in made:
        drop_table(spark, name)
    return out


def _raked_by_factors(held: DataFrame, goals: Mapping[str, DataFrame], keep: float, total: float) -> DataFrame:
    """For dimensions whose values are measured as few: their factors are on the driver, and cells are not written in each round. A cell's p
    is what its values' factors of all rounds make of `keep`, one after the other; every `REPLAYED` rounds it is written instead."""
    spark, names = held.sparkSession, list(goals)
    goal = {n: {r[n]: r["goal"] for r in g.collect()} for n, g in goals.items()}
    at, progress = held.withColumn("p", F.lit(float(keep))), _Progress(total)
    past: dict[str, list[dict[str, float]]] = {n: [] for n in names}

    def joined(rows: DataFrame, n: str, values: Mapping[str, object], name: str, kind: str) -> DataFrame:
        return rows.join(F.broadcast(spark.createDataFrame(list(values.items()), f"`{n}` string, {name} {kind}")), n)

    def replayed() -> DataFrame:
        """The cells with p as it is now: the current round may have been done for some dimensions only."""
        rows, rounds = at, min(map(len, past.values()))
        for k, n in enumerate(names):
            if past[n]:
                rows = joined(rows, n, {v: [f[v] for f in past[n]] for v in goal[n]}, f"f{k}", "array<double>")
        p = F.col("p")
        if rounds:

            def one_round(p: Column, r: Column) -> Column:
                for k in range(len(names)):
                    p = _times_factor(p, F.get(f"f{k}", r))
                return p

            p = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), p, one_round)
        for k, n in enumerate(names):
            if len(past[n]) > rounds:
                p = _times_factor(p, F.get(f"f{k}", F.lit(rounds)))
        return rows.select(*names, "n_tokens", p.alias("p"))

    for _ in range(ROUNDS):
        worst = 0.0
        for n in names:
            f, cells = dict.fromkeys(goal[n], 0.0), replayed()
            first = True
            while True:
                whole = F.lit(False) if first else (F.col("p") > 0) & (F.col("f") * F.col("p") > 1)
                sums = (cells if first else joined(cells, n, f, "f", "double")).groupBy(n).agg(
                    F.sum(F.when(whole, F.col("n_tokens")).otherwise(0)).alias("full"),
                    F.sum(F.when(whole, 0.0).otherwise(F.col("n_tokens") * F.col("p"))).alias("rest"),
                    F.coalesce(F.max(F.when(~whole, F.col("p"))), F.lit(0.0)).alias("top"),
                ).collect()  # a row for each value
                more = False
                for r in sums:
                    v, rest = r[n], r["rest"]
                    if first:
                        worst = max(worst, abs(rest - goal[n][v]))
                    f[v] = max(f[v], (goal[n][v] - r["full"]) / rest if rest > 0 else float("inf"))
                    more |= r["top"] > 0 and f[v] * r["top"] > 1
                first = False
                if not more:
                    break
            past[n].append(f)
        if progress.ends(worst):
            break
        if len(past[names[0]]) >= REPLAYED:
            at, past = stored(replayed()), {n: [] for n in names}
    return replayed()


def _times_factor(p: Column, f: Column) -> Column:
    return F.when(p > 0, F.least(F.lit(1.0), f * p)).otherwise(0.0)


def _goals(cells: DataFrame, n: str, target: Target, kept: float, total: float) -> DataFrame:
    """The tokens that are to stay of each value: `_shared_out` with the shares of `rake`."""
    held = stored(cells.groupBy(n).agg(F.sum("n_tokens").cast("double").alias("held")))
    if isinstance(target, Mapping):
        own = {v: float(t) for v, t in target.items() if v != OTHER}
        table = cells.sparkSession.createDataFrame(list(own.items()), f"`{n}` string, own double")
        held = held.join(table, n, "left")
        listed, sums = F.col("own").isNotNull(), {"t": F.sum("own"), "rest": F.sum(F.when(F.col("own").isNull(), F.col("held")))}
        listed_sum, rest = (float(x or 0) for x in held.agg(*[s.alias(k) for k, s in sums.items()]).first())
        if OTHER in target:
            share = F.when(listed, F.col("own")).otherwise(F.col("held") * float(target[OTHER]) / max(rest, 1.0))
        else:
            share = F.when(listed, F.col("own") * ((total - rest) / (listed_sum or 1.0))).otherwise(F.col("held"))
    else:
        share = F.pow(F.col("held") / total, F.lit(float(target)))
    weights = stored(held.select(n, "held", (share / F.col("held")).alias("w")))
    f, whole = 0.0, F.lit(False)
    while True:
        full, rest, top = weights.agg(
            F.sum(F.when(whole, F.col("held"))), F.sum(F.when(~whole, F.col("held") * F.col("w"))), F.max(F.when(~whole, F.col("w")))
        ).first()
        f = max(f, (kept - (full or 0.0)) / rest if rest else float("inf"))
        if not rest or f * top <= 1:
            break
        whole = F.col("w") * f > 1
    scaled = F.when(F.col("w") > 0, F.least(F.lit(1.0), F.col("w") * f)).otherwise(0.0)
    return weights.select(n, (F.col("held") * scaled).alias("goal"))


def _factors(at: DataFrame, n: str, goal: DataFrame, few: bool) -> tuple[str, float]:
    """A scratch table of the factor f of each value, as in `_scaled`, and how far the worst value was from its goal."""
    spark, off, last = at.sparkSession, None, None
    whole = F.lit(False)
    cells = at
    while True:
        sums = cells.groupBy(n).agg(
            F.coalesce(F.sum(F.when(whole, F.col("n_tokens"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~whole, F.col("n_tokens") * F.col("p"))), F.lit(0.0)).alias("rest"),
            F.coalesce(F.max(F.when(~whole, F.col("p"))), F.lit(0.0)).alias("top"),
            (F.max("f") if last else F.lit(0.0)).alias("was"),
        )
        wanted = F.when(F.col("rest") > 0, (F.col("goal") - F.col("full")) / F.col("rest")).otherwise(float("inf"))
        sums = sums.join(F.broadcast(goal) if few else goal, n)
        found = write_scratch_table(
            sums.select(n, F.greatest("was", wanted).alias("f"), "top", F.abs(F.col("rest") - F.col("goal")).alias("off"))
        )
        more, worst = spark.table(found).agg(
            F.max((F.col("top") > 0) & (F.col("f") * F.col("top") > 1)), F.max("off")
        ).first()
        off = worst if off is None else off
        if last:
            drop_table(spark, last)
        if not more:
            return found, off
        last = found
        cells = _joined(at, spark.table(found), n, few)
        whole = (F.col("p") > 0) & (F.col("f") * F.col("p") > 1)


def _joined(at: DataFrame, factors: DataFrame, n: str, few: bool) -> DataFrame:
    factors = factors.select(n, "f")
    return at.join(F.broadcast(factors) if few else factors, n)


def _times(at: DataFrame, factors: DataFrame, n: str, few: bool) -> DataFrame:
    p = F.when(F.col("p") > 0, F.least(F.lit(1.0), F.col("f") * F.col("p"))).otherwise(0.0)
    return _joined(at, factors, n, few).withColumn("p", p)
