"""Histograms, node scores, lattice search and the anonymised output.

The rows are aggregated once to a histogram over base coordinates. Scores of lattice
nodes come from the histogram alone: while it is small (a checked bound) on the
driver with arrays, beyond it in Spark, many nodes a job. The search then picks nodes
one by one from these scores. The output is one projection, one aggregation over the
published labels, and a join of the rows with the labels of failing classes.
"""
from __future__ import annotations

import json
import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspark.operators.qi import INLINE, QI, bind, category, typed, value_counts
from veilspark.plans.errors import RunError
from veilspark.session import cut, spread

MAX_NODES = 1_000_000
#: A histogram of up to this many cells is scored on the driver.
LOCAL_CELLS = 200_000
#: Cells times nodes that one Spark job scores at most.
JOB_CELLS = 50_000_000
#: Nodes that a search scores at once in Spark, where that many fit a job.
AHEAD = 32
GRID_K, GRID_SIGMA = (5, 10, 50, 100), (0.0, 0.01, 0.1)


def allowed(sigma: float, records: int) -> int:
    """How many records may be suppressed."""
    return max(0, math.floor(sigma * records + 1e-9))


# histogram


def placed(values: DataFrame, qis: Sequence[QI]) -> DataFrame:
    """``v0 … vn`` of a frame as base coordinates ``c0 … cn``; other columns stay."""
    out = values
    for i, q in enumerate(qis):
        v = F.col(f"v{i}")
        if q.kind != "category":
            out = out.withColumn(f"c{i}", q.fine(v))
        elif len(q.domain) <= INLINE:
            out = out.withColumn(f"c{i}", F.coalesce(F.array_position(F.array(*[F.lit(x) for x in q.domain]), v), F.lit(0)).cast("bigint") - 1 if q.domain else F.lit(-1).cast("bigint"))
        else:  # at most MAX_DOMAIN short rows; Spark decides by their size whether to broadcast
            table = values.sparkSession.createDataFrame([(x, j) for j, x in enumerate(q.domain)], f"__d{i} string, c{i} bigint")
            out = out.join(table, v == F.col(f"__d{i}"), "left").drop(f"__d{i}").withColumn(f"c{i}", F.coalesce(f"c{i}", F.lit(-1).cast("bigint")))
    return out.drop(*[f"v{i}" for i in range(len(qis))])


def coordinates(df: DataFrame, qis: Sequence[QI], keep: Sequence[Column] = ()) -> DataFrame:
    """``c0 … cn``: the base coordinate of every row, and ``keep``."""
    return placed(df.select(*[q.cell().alias(f"v{i}") for i, q in enumerate(qis)], *keep), qis)


def histogram_of(counts: DataFrame, qis: Sequence[QI], initial: Sequence[int] | None = None) -> DataFrame:
    """``(c0 … cn, n)``: rows per base cell; uniform coordinates floored to the initial width."""
    at = placed(counts, qis)
    for i, (q, w) in enumerate(zip(qis, initial or [1] * len(qis))):
        if q.kind == "uniform" and w > 1:
            c = F.col(f"c{i}")
            at = at.withColumn(f"c{i}", F.when(c < 0, c).otherwise(c - c % w))
    return at.groupBy(*[f"c{i}" for i in range(len(qis))]).agg(F.sum("n").alias("n"))


def histogram(df: DataFrame, qis: Sequence[QI], initial: Sequence[int] | None = None) -> DataFrame:
    """:func:`histogram_of` of a table."""
    return histogram_of(value_counts(df, qis), qis, initial)


def prepare(df: DataFrame, qis: Sequence[QI]) -> tuple[list[QI], int, DataFrame]:
    """Bound quasi-identifiers, number of rows, and the compared values that a histogram at any width is made of."""
    rows = df.select(*[f"`{q.name}`" for q in typed(df, qis)])
    bound, records = bind(rows, qis)
    return bound, records, rows.select(*[q.cell().alias(f"v{i}") for i, q in enumerate(bound)], F.lit(1).cast("bigint").alias("n"))


def radices(qis: Sequence[QI]) -> list[int]:
    """Base of each coordinate in the one-number key; numeric ones keep 0 for "no bin"."""
    return [len(q.domain) if q.kind == "category" else (q.span if q.kind == "uniform" else len(q.intervals.levels[0])) + 1 for q in qis]


def z_weights(qis: Sequence[QI]) -> list[int] | None:
    """Weight of each coordinate in the key, or None when it exceeds 64 bits."""
    out, w = [], 1
    for r in reversed(radices(qis)):
        out.append(w)
        w *= max(1, r)
        if w > 2**63 - 1:
            return None
    return out[::-1]


def z_histogram(hist: DataFrame, qis: Sequence[QI]) -> DataFrame:
    """``(z, n)``: the histogram under one packed key."""
    weights = z_weights(qis)
    if weights is None:
        raise RunError("GENERALIZATION_FAILED", "the packed key exceeds 64 bits")
    z = sum(((F.col(f"c{i}") + int(q.kind != "category")) * F.lit(w) for i, (q, w) in enumerate(zip(qis, weights))), F.lit(0).cast("bigint"))
    return hist.groupBy(z.alias("z")).agg(F.sum("n").alias("n"))


def z_decode(z: DataFrame, qis: Sequence[QI]) -> DataFrame:
    """The coordinates of packed keys."""
    weights, bases = z_weights(qis), radices(qis)
    cols = [(F.floor(F.col("z") / F.lit(w)).cast("bigint") % F.lit(max(1, r)) - F.lit(int(q.kind != "category"))).alias(f"c{i}") for i, (q, w, r) in enumerate(zip(qis, weights, bases))]
    return z.select(*cols, "n")


def merge(hist: DataFrame, qis: Sequence[QI], node: Sequence[int]) -> DataFrame:
    """The histogram re-keyed to the bins of one node."""
    keys = [q.coarse(F.col(f"c{i}"), F.lit(int(lv)).cast("bigint")).alias(f"g{i}") for i, (q, lv) in enumerate(zip(qis, node))]
    return hist.select(*keys, "n").groupBy(*[f"g{i}" for i in range(len(qis))]).agg(F.sum("n").alias("n"))


def equivalence_space(qis: Sequence[QI]) -> float:
    """Number of possible base cells."""
    out = 1.0
    for q in qis:
        out *= float(len(q.domain) if q.kind == "category" else q.span if q.kind == "uniform" else len(q.intervals.levels[0]))
    return out


def choose_flow(mode: str, records: int, qis: Sequence[QI]) -> str:
    """The report's flow: direct when N log2 N is at most the space and the key fits."""
    if mode in ("original", "direct"):
        picked = mode
    else:
        picked = "direct" if records * max(0.0, math.log2(records) if records > 0 else 0.0) <= equivalence_space(qis) else "original"
    return "original" if picked == "direct" and z_weights(qis) is None else picked


def sensitive_values(df: DataFrame, qis: Sequence[QI], attributes: Sequence[str], at_most: int) -> DataFrame:
    """``(c0 … cn, attribute, value)``: at most ``at_most`` distinct values per cell and attribute.

    More would not change whether a class has that many; Spark cuts the groups before the shuffle.
    """
    at = coordinates(df, qis, [category(F.col(a)).alias(f"__s{i}") for i, a in enumerate(attributes)])
    cells = [f"c{i}" for i in range(len(qis))]
    pairs = F.array(*[F.struct(F.lit(i).alias("attribute"), F.col(f"__s{i}").alias("value")) for i in range(len(attributes))])
    rows = at.select(*cells, F.explode(pairs).alias("p")).select(*cells, "p.*").distinct()
    order = Window.partitionBy(*cells, "attribute").orderBy("value")
    return rows.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= at_most).drop("__r")


# scores of nodes


@dataclass(frozen=True)
class Score:
    suppressed: int
    dm_star: int
    classes: int

    def order(self, node: Sequence[int]) -> tuple:
        return (self.dm_star, self.suppressed, -self.classes, tuple(node))


class Scorer:
    """Scores of nodes for several k at once; every node is computed at most once."""

    def __init__(self, hist: DataFrame, qis: Sequence[QI], ks: Sequence[int], sensitive: DataFrame | None = None, l: int = 1, local_cells: int = LOCAL_CELLS):
        self.hist, self.qis, self.ks, self.sensitive, self.l = hist.persist(), list(qis), list(ks), sensitive, l
        self.cells = self.hist.count()
        self.known: dict[tuple[int, ...], list[Score]] = {}
        self.evaluated = 0
        self.local, self.bins = None, {}
        if self.cells <= local_cells and sensitive is None:
            frame = self.hist.toPandas()
            self.local = (frame[[f"c{i}" for i in range(len(qis))]].to_numpy(np.int64), frame["n"].to_numpy(np.int64))

    def close(self) -> None:
        self.hist.unpersist()

    def scores(self, nodes: Iterable[Sequence[int]]) -> list[list[Score]]:
        nodes = [tuple(int(v) for v in n) for n in nodes]
        new = [n for n in dict.fromkeys(nodes) if n not in self.known]
        self.evaluated += len(new)
        if self.local is not None:
            for n in new:
                self.known[n] = self._local(n)
        else:
            size = max(1, JOB_CELLS // max(1, self.cells))
            for i in range(0, len(new), size):
                self._spark(new[i : i + size])
        return [self.known[n] for n in nodes]

    def _binned(self, i: int, lv: int) -> tuple[np.ndarray, int]:
        """The bins of one quasi-identifier at one level, from 0 for "no bin", and their number; made once."""
        if (i, lv) not in self.bins:
            q, u = self.qis[i], self.local[0][:, i]
            if q.kind == "uniform":
                g = np.where(u < 0, -1, u // lv)
            else:
                table = np.array([row[lv - 1] for row in q.intervals.up] if q.kind == "interval" else q.groups[lv - 1] if q.groups else [], dtype=np.int64)
                g = np.where(u < 0, -1, table[np.maximum(u, 0)]) if len(table) else np.full(len(u), -1)
            g += 1
            width = int(g.max()) + 1
            self.bins[i, lv] = g.astype(np.int32) if width < 2**31 else g, width
        return self.bins[i, lv]

    def _local(self, node: tuple[int, ...]) -> list[Score]:
        cells, n = self.local
        if not len(n):
            return [Score(0, 0, 0) for _ in self.ks]
        key, fits = np.zeros(len(n), np.int64), 1
        columns = [self._binned(i, lv) for i, lv in enumerate(node)]
        for g, width in columns:
            fits *= width
            if fits < 2**62:
                key *= width
                key += g
        if fits <= 16 * len(n):  # few possible classes: count them in place
            size = np.bincount(key, weights=n).astype(np.int64)
            return self._judged(size[size > 0])
        if fits < 2**62:
            _, at = np.unique(key, return_inverse=True)
        else:
            _, at = np.unique(np.stack([g for g, _ in columns], 1), axis=0, return_inverse=True)
        return self._judged(np.bincount(at.ravel(), weights=n).astype(np.int64))

    def _judged(self, size: np.ndarray) -> list[Score]:
        out = []
        for k in self.ks:
            ok = size[size >= k]
            out.append(Score(int(size[size < k].sum()), int(np.dot(ok.astype(object), ok.astype(object))) if len(ok) and int(ok.max()) > 2**31 else int((ok * ok).sum()), len(ok)))
        return out

    def classes(self, nodes: Sequence[Sequence[int]]) -> DataFrame:
        """``(node, g0 … gn, n, diverse)``: the classes of many nodes in one aggregation."""
        # a constant of the plan, written as one literal
        listed = json.dumps([{"node": i} | {f"l{j}": int(v) for j, v in enumerate(n)} for i, n in enumerate(nodes)])
        levels = F.from_json(F.lit(listed), "array<struct<node:int," + ",".join(f"l{j}:bigint" for j in range(len(self.qis))) + ">>")
        keys = [q.coarse(F.col(f"c{i}"), F.col(f"x.l{i}")).alias(f"g{i}") for i, q in enumerate(self.qis)]
        names = ["node", *[f"g{i}" for i in range(len(self.qis))]]
        sizes = self.hist.select("*", F.explode(levels).alias("x")).select("x.node", *keys, "n").groupBy(*names).agg(F.sum("n").alias("n"))
        if self.sensitive is None or self.l <= 1:
            return sizes.withColumn("diverse", F.lit(True))
        values = self.sensitive.select("*", F.explode(levels).alias("x")).select("x.node", *keys, "attribute", "value").distinct()
        per = values.groupBy(*names, "attribute").agg(F.count("*").alias("d")).groupBy(*names).agg((F.min("d") >= self.l).alias("diverse"))
        return sizes.join(per, names, "left").withColumn("diverse", F.coalesce("diverse", F.lit(False)))

    def _spark(self, nodes: list[tuple[int, ...]]) -> None:
        c = self.classes(nodes)
        good = lambda k: (F.col("n") >= k) & F.col("diverse")
        aggs = []
        for i, k in enumerate(self.ks):
            aggs += [F.sum(F.when(good(k), 0).otherwise(F.col("n"))).alias(f"s{i}"), F.sum(F.when(good(k), F.col("n").cast("decimal(38,0)") * F.col("n")).otherwise(0)).alias(f"d{i}"), F.count_if(good(k)).alias(f"c{i}")]
        rows = {r["node"]: r for r in c.groupBy("node").agg(*aggs).collect()}
        for j, n in enumerate(nodes):
            r = rows.get(j)
            self.known[n] = [Score(int(r[f"s{i}"]), int(r[f"d{i}"]), int(r[f"c{i}"])) if r else Score(0, 0, 0) for i in range(len(self.ks))]


# lattice


class Lattice:
    """All nodes above an initial one: a box of places, one axis for each quasi-identifier.

    What lies above a node is the box from its place upwards, what lies below the box
    down from it, so settling either is one slice of an array.
    """

    def __init__(self, qis: Sequence[QI], initial: Sequence[int]):
        self.chains = [q.chain(int(v)) for q, v in zip(qis, initial)]
        self.shape = tuple(map(len, self.chains))
        self.size = math.prod(self.shape)
        if self.size > MAX_NODES:
            raise RunError("LATTICE_TOO_LARGE", "the lattice is too large to search", f"{self.size} nodes, at most {MAX_NODES}")
        self.level = sum(np.ix_(*[np.arange(n) for n in self.shape]), np.zeros(self.shape, np.int64)).astype(np.int32)
        order = np.argsort(self.level, axis=None, kind="stable")  # by level, then in the order of nodes
        self.levels = np.split(order, np.cumsum(np.bincount(self.level.ravel()))[:-1])

    @classmethod
    def build(cls, qis: Sequence[QI], initial: Sequence[int]) -> Lattice:
        return cls(qis, initial)

    @property
    def nodes(self) -> list[tuple[int, ...]]:
        return list(product(*self.chains))

    def node(self, at: int) -> tuple[int, ...]:
        return tuple(c[i] for c, i in zip(self.chains, np.unravel_index(at, self.shape)))


class Tags:
    """Which nodes are settled for one (k, limit), and how many of each level are not."""

    def __init__(self, lattice: Lattice):
        self.lattice, self.open = lattice, np.ones(lattice.shape, dtype=bool)
        self.left = np.bincount(lattice.level.ravel())

    def settle(self, at: int, passes: bool) -> None:
        """A passing node settles all above it, a failing one all below."""
        place = np.unravel_index(at, self.lattice.shape)
        box = tuple(slice(i, None) if passes else slice(None, i + 1) for i in place)
        part = self.open[box]
        self.left -= np.bincount(self.lattice.level[box][part], minlength=len(self.left))
        part[...] = False


class Halving:
    """The next node to look at: the middle one of the open nodes of the middle open level, nodes in falling order."""

    def __init__(self, lattice: Lattice, tags: Sequence[Tags]):
        self.lattice, self.tags, self.waiting = lattice, tags, list(lattice.levels)

    def next(self) -> tuple[int, np.ndarray] | None:
        levels = np.flatnonzero(sum(t.left for t in self.tags))
        if not len(levels):
            return None
        level = levels[len(levels) // 2]
        flat = self.waiting[level]
        is_open = np.zeros(len(flat), dtype=bool)
        for t in self.tags:
            is_open |= t.open.ravel()[flat]
        flat = self.waiting[level] = flat[is_open]
        return int(flat[len(flat) - 1 - len(flat) // 2]), flat


def look_ahead(scorer: Scorer, lattice: Lattice, at: int, candidates: np.ndarray) -> None:
    """Where Spark scores, score with a node those next to it in its level: as many as one job takes, at most ``AHEAD``."""
    if scorer.local is None:
        most = min(AHEAD, JOB_CELLS // max(1, scorer.cells))
        i = int(np.searchsorted(candidates, at))
        near = candidates[max(0, i - most // 2) : i + most // 2 + 1]
        scorer.scores([lattice.node(at), *(lattice.node(int(n)) for n in near)])


def first_node(qis: Sequence[QI], max_classes: int) -> list[int]:
    """The lexicographically smallest node whose estimated number of classes is within the bound."""
    if not qis:
        raise RunError("ANON_NO_QIS", "no quasi-identifiers are named")
    if max_classes <= 0:
        raise RunError("GENERALIZATION_FAILED", "the bound on classes must be above 0")
    fitting = [n for n in Lattice.build(qis, [1] * len(qis)).nodes if math.prod(max(1, q.bins(v)) for q, v in zip(qis, n)) <= max_classes]
    if not fitting:
        raise RunError("ANON_INFEASIBLE", "no node is within the bound on classes")
    return list(min(fitting))


@dataclass
class Found:
    """The answer of a search, with the nodes it looked at."""

    node: tuple[int, ...]
    score: Score
    top: list[tuple[tuple[int, ...], Score]]
    trace: list[tuple[tuple[int, ...], Score, bool]] = field(default_factory=list)
    lattice_size: int = 0


def search(scorer: Scorer, initial: Sequence[int], k: int, sigma: float, records: int, ahead: bool = True) -> Found:
    """The passing node that distorts least, by halving the levels with tags above and below.

    A passing node settles all nodes above it, a failing one all below. ``ahead`` lets
    Spark score neighbours of a node in the same job.
    """
    if k <= 0 or not 0 <= sigma <= 1 or records <= 0:
        raise RunError("GENERALIZATION_FAILED", "k and the number of records must be above 0 and suppression_limit in [0, 1]")
    which, limit = scorer.ks.index(k), allowed(sigma, records)
    lat = Lattice.build(scorer.qis, initial)
    tags, passing, trace = Tags(lat), [], []
    halving = Halving(lat, [tags])
    while (found := halving.next()) is not None:
        at, candidates = found
        node = lat.node(at)
        if ahead:
            look_ahead(scorer, lat, at, candidates)
        s = scorer.scores([node])[0][which]
        ok = s.suppressed <= limit
        trace.append((node, s, ok))
        tags.settle(at, ok)
        if ok:
            passing.append((node, s))
    passing.sort(key=lambda x: x[1].order(x[0]))
    if not passing:
        raise RunError("GENERALIZATION_FAILED", "no node satisfies k within the suppression limit")
    return Found(*passing[0], passing[:5], trace, lat.size)


@dataclass(frozen=True)
class Cell:
    """One (k, suppression limit) of the parameter grid."""

    k: int
    sigma: float
    node: tuple[int, ...] = ()
    score: Score = Score(-1, -1, 0)

    @property
    def feasible(self) -> bool:
        return bool(self.node)


def parameter_grid(scorer: Scorer, initial: Sequence[int], records: int, ks: Sequence[int] = GRID_K, sigmas: Sequence[float] = GRID_SIGMA) -> list[Cell]:
    """The best node of every (k, sigma), k first; all cells share the scores of the nodes."""
    if records <= 0:
        return [Cell(k, s) for k in ks for s in sigmas]
    lat = Lattice.build(scorer.qis, initial)
    combos = [(k, s) for k in ks for s in sigmas]
    tags = [Tags(lat) for _ in combos]
    halving, seen = Halving(lat, tags), []
    while (found := halving.next()) is not None:
        at, candidates = found
        node = lat.node(at)
        look_ahead(scorer, lat, at, candidates)
        scores = scorer.scores([node])[0]
        seen.append(node)
        for t, (k, sigma) in zip(tags, combos):
            if t.open.ravel()[at]:
                t.settle(at, scores[scorer.ks.index(k)].suppressed <= allowed(sigma, records))
    out = []
    for k, sigma in combos:
        i = scorer.ks.index(k)
        fit = [(n, scorer.known[n][i]) for n in seen]
        fit = [x for x in fit if x[1].suppressed <= allowed(sigma, records)]
        out.append(Cell(k, sigma, *min(fit, key=lambda x: x[1].order(x[0]))) if fit else Cell(k, sigma))
    return out


def k_optimal(hist: DataFrame, qis: Sequence[QI], sigma: float, records: int) -> int:
    """Largest class size at the coarsest node whose smaller classes may all be suppressed.

    Class sizes are counted first, so the driver gets one row per distinct size.
    """
    sizes = merge(hist, qis, [q.top for q in qis]).groupBy("n").agg(F.count("*").alias("classes")).orderBy("n").toLocalIterator()
    best, before, limit = 1, 0, allowed(sigma, records)
    for size, classes in sizes:
        if before > limit:
            break
        best = size
        before += size * classes
        if classes > 1 and before - size > limit:
            break
    return best


# output


@dataclass(frozen=True)
class Diversity:
    l: int
    attributes: tuple[str, ...]


def generalise(df: DataFrame, qis: Sequence[QI], node: Sequence[int]) -> DataFrame:
    """``df`` with every quasi-identifier replaced by its label at the node."""
    return df.withColumns({q.name: q.label(int(v)) for q, v in zip(qis, node)})


def class_verdicts(labelled: DataFrame, qis: Sequence[QI], k: int, diversity: Diversity | None = None) -> DataFrame:
    """``(labels, size, passes)`` of every class."""
    names = [q.name for q in qis]
    sizes = labelled.groupBy(*names).agg(F.count("*").alias("size"))
    if diversity is None or diversity.l <= 1:
        return sizes.withColumn("passes", F.col("size") >= k)
    pairs = F.array(*[F.struct(F.lit(i).alias("a"), category(F.col(a)).alias("v")) for i, a in enumerate(diversity.attributes)])
    values = labelled.select(*names, F.explode(pairs).alias("p")).select(*names, "p.a", "p.v").distinct()
    per = values.groupBy(*names, "a").agg(F.count("*").alias("d")).groupBy(*names).agg(F.min("d").alias("d"))
    return sizes.join(per, names).withColumn("passes", (F.col("size") >= k) & (F.col("d") >= diversity.l)).drop("d")


@dataclass(frozen=True)
class Summary:
    total_records: int
    classes: int
    dm_star: int
    suppressed: int
    published_suppressed: int
    removed: int
    failing_k: int
    failing_l: int
    sizes: dict[int, int]

    def size_stats(self) -> dict:
        """Smallest, median, mean and largest class; the median is the first size that reaches half the classes."""
        n = sum(self.sizes.values())
        if not n:
            return {"min": 0, "median": 0, "mean": 0.0, "max": 0}
        run, median = 0, 0
        for s in sorted(self.sizes):
            run += self.sizes[s]
            if 2 * run >= n:
                median = s
                break
        return {"min": min(self.sizes), "median": median, "mean": sum(s * c for s, c in self.sizes.items()) / n, "max": max(self.sizes)}


@dataclass(frozen=True)
class Release:
    table: DataFrame
    summary: Summary


def release(df: DataFrame, qis: Sequence[QI], node: Sequence[int], k: int, diversity: Diversity | None = None) -> Release:
    """The published table: failing classes become ``*`` if that class itself passes, else they go.

    The verdict is known before anything is written. Only failing classes are joined
    back, so rows of passing classes are not matched against a table of all classes.
    """
    names = [q.name for q in qis]
    labelled = generalise(spread(df), qis, node)
    verdicts = cut(class_verdicts(labelled, qis, k, diversity))  # one row per class
    l = diversity.l if diversity else 1
    row = verdicts.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("total"), F.count_if("passes").alias("classes"), F.coalesce(F.sum(F.when(F.col("passes"), F.col("size").cast("decimal(38,0)") * F.col("size"))), F.lit(0)).alias("dm"),
        F.coalesce(F.sum(F.when(~F.col("passes"), F.col("size"))), F.lit(0)).alias("star"), F.count_if(F.col("size") < k).alias("failing_k"), F.count_if(~F.col("passes") & (F.col("size") >= k)).alias("failing_l"),
    ).first()
    sizes = {r[0]: r[1] for r in verdicts.filter("passes").groupBy("size").count().collect()}
    bad = verdicts.filter(~F.col("passes")).select(*[F.col(n).alias(f"__b{i}") for i, n in enumerate(names)])
    match = F.lit(True)
    for i, n in enumerate(names):
        match = match & (F.col(n) == F.col(f"__b{i}"))
    star = int(row["star"])
    publish = star == 0 or star >= k
    if publish and star and l > 1:
        # no more than l distinct values of an attribute matter here either
        failing = labelled.join(bad, match, "left_semi").select(*[category(F.col(a)).alias(f"a{i}") for i, a in enumerate(diversity.attributes)])
        counts = failing.agg(*[F.count_distinct(f"a{i}").alias(f"d{i}") for i in range(len(diversity.attributes))]).first()
        publish = min(counts) >= l
    if star == 0:
        table = labelled
    elif not publish:
        table = labelled.join(bad, match, "left_anti")
    else:
        marked = labelled.join(bad.withColumn("__bad", F.lit(True)), match, "left")
        hidden = F.coalesce(F.col("__bad"), F.lit(False))
        table = marked.select(*[F.when(hidden, F.lit("*")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])
    summary = Summary(int(row["total"]), row["classes"], int(row["dm"]), star, star if publish else 0, 0 if publish else star, row["failing_k"], row["failing_l"], sizes)
    return Release(table.select(*df.columns), summary)
