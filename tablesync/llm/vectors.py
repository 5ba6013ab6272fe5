"""Embedding near-duplicates: inverted multi-index over vector halves, multi-sequence traversal, verification in blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import Stage, bounded_sample
from .components import components

COSINE = 0.98
#: Rows on which codebooks and stopping bound are fitted; the index itself holds every row.
SAMPLE = 8192
#: Share of near neighbours that a traversal must reach.
RECALL = 0.995
#: Rows of a cell that are compared at once with as many visitors, and rows that the number of cells aims at for each.
BLOCK, CELL_ROWS = 1024, 512


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    x = np.unique(x, axis=0)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _squares(x, c).argmin(axis=1)
        c = np.array([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
    return c


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)


class MultiIndex:
    """Two codebooks, one for each half of the unit vectors, and the bound at which a traversal may stop."""

    def __init__(self, sample: np.ndarray, rows: int, cosine: float, recall: float):
        rng = np.random.default_rng(7)
        x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.half = x.shape[1] // 2
        # cells follow the rows; a codebook entry needs a few vectors of the sample
        k = max(1, min(math.ceil(math.sqrt(rows / CELL_ROWS)), max(256, len(x) // 4)))
        self.books = [_k_means(h, k, rng) for h in self._halves(x)]
        # neighbours at the largest distance that still counts, in random directions, and those in the sample
        noise = rng.normal(size=x.shape)
        y = x + noise / np.linalg.norm(noise, axis=1, keepdims=True) * math.sqrt(2 - 2 * cosine)
        a, b = [x], [y / np.linalg.norm(y, axis=1, keepdims=True)]
        for at in range(0, len(x), BLOCK):
            near = x[at:at + BLOCK] @ x.T >= cosine
            near[np.arange(len(near)), at + np.arange(len(near))] = False
            pairs = np.flatnonzero(near)
            pairs = pairs[::max(1, -(-len(pairs) // BLOCK))]  # as many as the block has rows, spread evenly
            a.append(x[at + pairs // len(x)])
            b.append(x[pairs % len(x)])
        needed = np.concatenate([self._bound_of(p[at:at + BLOCK], q[at:at + BLOCK]) for p, q in zip(a, b) for at in range(0, len(p), BLOCK)])
        self.stop = float(np.quantile(needed, recall)) + 1e-12

    def _halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, :self.half], x[:, self.half:]]

    def bounds(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half the squared least distance from each vector to each codebook cell; the nearest has 0."""
        out = []
        for h, c in zip(self._halves(x), self.books):
            d = _squares(h, c)
            near = d.argmin(axis=1)
            apart = np.sqrt(_squares(c, c))[near]
            gap = (d - d[np.arange(len(h)), near][:, None]) / np.maximum(2 * apart, 1e-12)
            gap[np.arange(len(h)), near] = 0
            out.append(np.maximum(gap, 0) ** 2)
        return out

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u, v = (_squares(h, c).argmin(axis=1) for h, c in zip(self._halves(x), self.books))
        return u, v

    def _bound_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        (a, b), (u, v), at = self.bounds(x), self.home(y), np.arange(len(x))
        return a[at, u] + b[at, v]

    def traverse(self, x: np.ndarray) -> Iterator[list[tuple[int, int]]]:
        """For each vector its cells, nearest first: both halves' cells in ascending order, combined while the sum is within the bound."""
        a, b = self.bounds(x)
        for p, q in zip(a, b):
            us, vs = np.flatnonzero(p <= self.stop), np.flatnonzero(q <= self.stop)
            total = p[us][:, None] + q[vs][None, :]
            i, j = np.nonzero(total <= self.stop)
            order = np.argsort(total[i, j], kind="stable")
            yield list(zip(us[i[order]].tolist(), vs[j[order]].tolist()))


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values])


def _usable(embedding: Column, label: Column) -> Column:
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return label.isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(embedding, lambda x: x != 0)


def _seen_by(visits: list, codes: np.ndarray) -> np.ndarray:
    """Whether each row of a cell (columns) visits the home cell of each visitor (rows)."""
    row = np.repeat(np.arange(len(visits)), [len(v) for v in visits])
    cell = np.concatenate([np.asarray(v, dtype=np.int64) for v in visits])
    out = np.zeros((len(codes), len(visits)), dtype=bool)
    for c in np.unique(codes):
        out[np.ix_(np.flatnonzero(codes == c), row[cell == c])] = True
    return out


def _compare(cosine: float):
    """Verifies one block: visitors against the rows of a cell. Gives counts and links that keep components whole.

    A link counts for the visitor, and also for the row of the cell if that doesn't visit the visitor's home, where it would find it.
    """

    def each(p: pd.DataFrame) -> pd.DataFrame:
        h, q = p[p["home"]], p[~p["home"]]
        none = pd.DataFrame({"cid": [], "found": [], "root": []}).astype("int64")
        if h.empty or q.empty:
            return none
        x, y = _matrix(q["embedding"]), _matrix(h["embedding"])
        links = (x @ y.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None, :] >= cosine
        links &= q["cid"].to_numpy()[:, None] != h["cid"].to_numpy()[None, :]
        a, b = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
        if not len(a):
            return none
        links, h, q = links[np.ix_(a, b)], h.iloc[b], q.iloc[a]
        found = links @ h["n"].to_numpy(np.int64)
        alone = links & ~_seen_by(list(h["visits"]), q["code"].to_numpy(np.int64))
        mirrored = q["n"].to_numpy(np.int64) @ alone
        ra, rb = q["cid"].to_numpy(), h["cid"].to_numpy()
        top = np.iinfo(np.int64).max
        while True:
            nb = np.minimum(rb, np.where(links, ra[:, None], top).min(axis=0))
            na = np.minimum(ra, np.where(links, nb[None, :], top).min(axis=1))
            if (na == ra).all() and (nb == rb).all():
                break
            ra, rb = na, nb
        return pd.DataFrame({"cid": np.concatenate((q["cid"].to_numpy(), h["cid"].to_numpy())), "found": np.concatenate((found, mirrored)), "root": np.concatenate((ra, rb))})

    return each


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors of equal label (not null) and length are linked from ``cosine`` on, computed in double precision. Equal vectors of a label
    are one class with a count, so copies cost no pairs. Codebooks and the stopping bound are fitted on at most ``sample``
    classes, the index holds all. Each class visits the cells of its traversal; visitors and rows of a cell meet in blocks of
    ``block``, so no task holds a whole cell, and a block returns counts and a spanning forest, never its pairs. Null labels, and vectors that
    are null, empty, zero or hold null or non-finite numbers link with nothing: no links, own component. Repeated ids are vectors of
    their own; other columns are ignored.
    """
    spark, stage = vectors.sparkSession, Stage(vectors.sparkSession, "vectors")
    rows = vectors.select("vec_id", "label", "embedding", _usable(F.col("embedding"), F.col("label")).alias("ok"))
    good = rows.where("ok").withColumn("h", F.xxhash64("label", "embedding"))
    classes = good.groupBy("h", "label", "embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))
    classes = stage.write(classes.withColumn("cid", F.monotonically_increasing_id()))
    # bounded: `sample` vectors for each length; lengths beyond the sample share one cell
    taken = bounded_sample(classes.select("cid", "embedding"), F.col("cid"), sample).toPandas()["embedding"]
    by_size: dict[int, list] = {}
    for e in taken:
        by_size.setdefault(len(e), []).append(e)
    rows_in_all = classes.count()
    index = {d: MultiIndex(_matrix(pd.Series(e)), rows_in_all, cosine, recall) for d, e in by_size.items()}

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            size = b["embedding"].map(len)
            for d, part in b.groupby(size):
                at = index.get(int(d))
                if at is None:
                    homes, visits = [(0, 0)] * len(part), [[(0, 0)]] * len(part)
                else:
                    x = _matrix(part["embedding"])
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    homes, visits = list(zip(*at.home(x))), list(at.traverse(x))
                out = [(c, int(d), int(u) << 16 | int(v), [x << 16 | y for x, y in cs]) for c, (u, v), cs in zip(part["cid"], homes, visits)]
                yield pd.DataFrame(out, columns=["cid", "size", "code", "visits"])

    placed = classes.select("cid", "embedding").mapInPandas(cells, "cid bigint, size int, code bigint, visits array<bigint>")
    placed = stage.write(classes.select("cid", "label", "n", "embedding").join(placed, "cid"))
    home = F.array(F.struct(F.col("code").alias("cell"), F.lit(True).alias("home")))
    visit = F.transform("visits", lambda c: F.struct(c.alias("cell"), F.lit(False).alias("home")))
    members = placed.select("label", "size", "cid", F.explode(F.concat(home, visit)).alias("m")).select("label", "size", "cid", "m.*")
    cell = ["label", "size", "cell"]
    counts = members.groupBy(*cell).agg(F.count_if("home").alias("nh"), F.count_if(~F.col("home")).alias("nq")).where("nh > 1 OR nq > 1")
    parts = lambda n: F.ceil(F.col(n) / block).cast("int")
    dealt = members.join(counts, cell).where("nh > 0 AND nq > 0").withColumns({"ph": parts("nh"), "pq": parts("nq")})
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("home"), F.col("ph")).otherwise(F.col("pq"))).cast("int")
    dealt = dealt.select(*cell, "cid", "home", own.alias("own"), F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("pq")).otherwise(F.col("ph")) - 1)).alias("other"))
    dealt = dealt.select(*cell, "cid", "home", F.when(F.col("home"), F.col("own")).otherwise(F.col("other")).alias("bh"), F.when(F.col("home"), F.col("other")).otherwise(F.col("own")).alias("bq"))
    full = dealt.join(placed.select("cid", "n", "embedding", "code", "visits"), "cid")
    full = full.select(*cell, "bh", "bq", "cid", "home", "n", "embedding", "code", F.when(F.col("home"), F.col("visits")).alias("visits"))
    found = stage.write(full.groupBy(*cell, "bh", "bq").applyInPandas(_compare(cosine), "cid bigint, found bigint, root bigint"))
    comp = components(found.select("cid", "root"), stage)
    links = found.groupBy("cid").agg(F.sum("found").alias("found"))
    named = classes.select("h", "label", "embedding", "cid", "n", "first_id").join(links, "cid", "left")
    named = named.join(comp, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    table = named.join(least, "root").select(
        F.col("h").alias("_h"), F.col("label").alias("_l"), F.col("embedding").alias("_e"), (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    same = (F.col("h") == F.col("_h")) & (F.col("label") == F.col("_l")) & (F.col("embedding") == F.col("_e"))
    alone = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = good.join(table, same).select("vec_id", "n_links", "component_id").unionAll(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
