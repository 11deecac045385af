"""The most similar vectors of every vector, by robust-pruned graphs over shards.

Method. Vectors are normalised; equal ones are one class, so a group of copies of any size is one point. Centroids fitted
on a bounded sample route a class to its home shard and to other shards as a visitor: to a stated number of the next best
ones, or, where only pairs of a stated similarity are wanted, to all whose border with the home shard is so near that such
pairs may lie across it, up to a number that grows with the logarithm of the shards. A shard of more than twice SHARD_ROWS
is routed once more within its task, by centroids of its own, so graphs stay small when there are more vectors than the
bounded sample can give centroids for. In each shard a directed graph is built: a greedy beam search from the medoid and
entry points spread over the shard proposes neighbours for each point, robust pruning with a relaxed distance (ALPHA)
keeps few and diverse edges, edges are also put in backwards and pruned again. Then a beam search over the finished graph
answers the members of the shard and its visitors. Results of the shards are merged to the k best.

Every vector is indexed and every vector is a query. A shard whose home rows pass SHARD_MAX is split by hash of the id and
its queries go to each part; one with more than VISITS_MAX queries has them spread by hash over several tasks, each of
which gets the members. So no task has more rows than these numbers say. Vectors that are null, of another width than `dims`, all zero, or not finite take no part.
Repeated ids count once, with their newest valid row (the last by `newest`, where that is given). Equal similarities are ordered by id; among copies the smallest ids
are the most similar. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatlake.runtime import cut

#: Vectors sampled to fit the centroids (more for many centroids, up to the second number), rows of a shard aimed at and
#: at most, shards that a vector searches, its own first.
SAMPLE, SAMPLE_MAX, SHARD_ROWS, SHARD_MAX, PROBES = 20_000, 200_000, 1_000, 100_000, 5
#: Queries of one task.
VISITS_MAX = 50_000
#: Borders that a pair may lie across: nearer than so many standard deviations of the way, along a given direction, from a
#: vector to one at the wanted similarity.
BORDER = 1.5
#: Edges of a point, width of the beam, relaxation of the pruning, points that a beam opens at a time.
DEGREE, BEAM, ALPHA, OPEN = 24, 36, 1.2, 4
#: Entry points of a shard of n points: so many times the square root of n.
ENTRIES = 2.0
_BATCH = 256


class Graph:
    """A directed graph over unit vectors, built by greedy search and robust pruning."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 1):
        self.x, self.degree, self.beam, self.alpha = x, degree, beam, alpha
        n = len(x)
        rng = np.random.default_rng(seed)
        # entries: the medoid and points spread over the shard, of which a search takes the nearest
        spread = rng.choice(n, min(n, max(1, int(ENTRIES * n**0.5))), replace=False) if n else np.zeros(0, int)
        self.entries = np.unique(np.append(spread, int(np.argmax(x @ x.mean(0))))) if n else spread
        # a sparse random graph keeps every point reachable while the first edges are made
        self.edges = np.full((n, degree), -1, np.int32)
        if n > 1:
            k = min(4, degree, n - 1)
            self.edges[:, :k] = (np.arange(n)[:, None] + rng.integers(1, n, (n, k))) % n
        for at in np.array_split(rng.permutation(n), max(1, math.ceil(n / _BATCH))):
            if n > 1:
                self._insert(at)

    def _insert(self, p: np.ndarray) -> None:
        found, _ = self.search(self.x[p], self.beam)
        cand = np.concatenate([found, self.edges[p]], 1)
        self.edges[p] = self._prune(p, cand)
        # backwards
        to, frm = self.edges[p].ravel(), np.repeat(p, self.degree).astype(np.int32)
        ok = to >= 0
        to, frm = to[ok], frm[ok]
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        heads, first, counts = np.unique(to, return_index=True, return_counts=True)
        wide = counts.max(initial=0)
        new = np.full((len(heads), wide), -1, np.int32)
        new[np.repeat(np.arange(len(heads)), counts), np.arange(len(to)) - np.repeat(first, counts)] = frm
        old = self.edges[heads]
        free = (old < 0).sum(1)
        fits = counts <= free
        if fits.any():
            both = np.concatenate([old[fits], new[fits]], 1)
            both = np.take_along_axis(both, np.argsort(both < 0, 1, kind="stable"), 1)
            self.edges[heads[fits]] = both[:, : self.degree]
        for part in np.array_split(np.flatnonzero(~fits), max(1, math.ceil((~fits).sum() / _BATCH))):
            if len(part):
                self.edges[heads[part]] = self._prune(heads[part], np.concatenate([old[part], new[part]], 1))

    def _prune(self, p: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """Per point: take the nearest candidate, drop those that are nearer to it, relaxed, than to the point; repeat."""
        cand = np.sort(cand, 1)
        bad = (cand < 0) | (cand == p[:, None])
        bad[:, 1:] |= cand[:, 1:] == cand[:, :-1]
        v = self.x[np.where(bad, 0, cand)]
        d = 1 - np.einsum("bcd,bd->bc", v, self.x[p])
        d[bad] = np.inf
        order = np.argsort(d, 1)[:, : 2 * self.beam]
        cand, d, v = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1), np.take_along_axis(v, order[:, :, None], 1)
        between = 1 - np.matmul(v, v.transpose(0, 2, 1))
        alive, rows = np.isfinite(d), np.arange(len(p))
        out = np.full((len(p), self.degree), -1, np.int32)
        for k in range(self.degree):
            pick = alive.argmax(1)
            has = alive[rows, pick]
            if not has.any():
                break
            out[has, k] = cand[rows, pick][has]
            alive &= self.alpha * between[rows, pick] > d
            alive[rows, pick] = False
        return out

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the beam of each query, best first; ids are -1 where a beam is not full."""
        n, b = len(self.x), len(q)
        beam = min(beam, n)
        ids = np.full((b, beam), -1, np.int32)
        sims = np.full((b, beam), -np.inf, np.float32)
        opened = np.zeros((b, beam), bool)
        seen = np.zeros((b, n), bool)
        rows = np.arange(b)
        first = q @ self.x[self.entries].T
        k = min(beam, OPEN, first.shape[1])
        near = np.argpartition(-first, k - 1, axis=1)[:, :k]
        ids[:, :k], sims[:, :k] = self.entries[near], np.take_along_axis(first, near, 1)
        seen[rows[:, None], ids[:, :k]] = True
        while len(rows):
            wait = ~opened[rows] & (ids[rows] >= 0)
            live = wait.any(1)
            rows, wait = rows[live], wait[live]
            if not len(rows):
                break
            # the best unopened ones of each beam
            nth = np.cumsum(wait, 1)
            now = wait & (nth <= OPEN)
            opened[rows] |= now
            r, c = np.nonzero(now)
            nb = self.edges[ids[rows[r], c]]
            slot = nth[r, c] - 1
            wide = np.full((len(rows), OPEN, self.degree), -1, np.int32)
            wide[r, slot] = nb
            wide = np.sort(wide.reshape(len(rows), -1), 1)
            ok = wide >= 0
            ok[:, 1:] &= wide[:, 1:] != wide[:, :-1]
            ok &= ~seen[rows[:, None], wide]
            r, c = np.nonzero(ok)
            pts = wide[r, c]
            seen[rows[r], pts] = True
            got = np.full(wide.shape, -np.inf, np.float32)
            got[r, c] = np.einsum("ij,ij->i", self.x[pts], q[rows[r]])
            all_s, all_i = np.concatenate([sims[rows], got], 1), np.concatenate([ids[rows], np.where(ok, wide, -1)], 1)
            all_o = np.concatenate([opened[rows], np.zeros(wide.shape, bool)], 1)
            top = np.argsort(-all_s, 1, kind="stable")[:, :beam]
            sims[rows], ids[rows], opened[rows] = np.take_along_axis(all_s, top, 1), np.take_along_axis(all_i, top, 1), np.take_along_axis(all_o, top, 1)
        return ids, sims


def fit_centroids(x: np.ndarray, count: int, rounds: int = 6, seed: int = 3) -> np.ndarray:
    """Unit centroids by spherical k-means."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(count, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        s = np.zeros_like(c)
        np.add.at(s, own, x)
        norm = np.linalg.norm(s, axis=1, keepdims=True)
        c = np.where(norm > 0, s / np.maximum(norm, 1e-12), c)
    return c.astype(np.float32)


def _unit_rows(dims: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dims)
            norm = np.linalg.norm(x.astype(np.float64), axis=1)
            ok = np.isfinite(norm) & (norm > 0)
            ids, new = b.column(0).filter(pa.array(ok)), b.column(2).filter(pa.array(ok))
            raw = [r.tobytes() for r in x[ok]]
            unit = [r.tobytes() for r in (x[ok] / norm[ok, None]).astype(np.float32)]
            keys = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.string()), pa.array(keys, pa.binary()), pa.array(unit, pa.binary()), new], names=["id", "key", "v", "new"])

    return run


def _matrix(column: object) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float32).reshape(len(values), -1) if values else np.zeros((0, 1), np.float32)


def visits(x: np.ndarray, cents: np.ndarray, probes: int | None, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(shards, whether to search them) of each vector, its home first.

    With `probes`, the shards of so many best centroids. Without, all whose border is within reach at `min_cosine`, which
    must be above 0; at most max(PROBES, 2 log2 of the shards), nearest first.
    """
    wide = min(len(cents), probes or max(PROBES, 2 * math.ceil(math.log2(max(2, len(cents))))))
    sims = x @ cents.T
    if probes:
        to = np.argsort(-sims, axis=1, kind="stable")[:, :wide]
        return to, np.ones(to.shape, bool)
    more = min(len(cents), 2 * wide)  # a border may be nearer than that of a better centroid
    to = np.argpartition(-sims, more - 1, axis=1)[:, :more]
    sims = np.take_along_axis(sims, to, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    to, sims = np.take_along_axis(to, order, 1), np.take_along_axis(sims, order, 1)
    reach = BORDER * math.sqrt(max(0.0, min_cosine**-2 - 1) / x.shape[1])
    away = np.full(sims.shape, np.inf, np.float32)
    i, j = np.nonzero(sims[:, :1] - sims <= 2 * reach)  # unit centroids are at most 2 apart
    away[i, j] = (sims[i, 0] - sims[i, j]) / np.maximum(np.linalg.norm(cents[to[i, j]] - cents[to[i, 0]], axis=1), 1e-6)
    away[:, 0] = -1.0
    order = np.argsort(away, axis=1, kind="stable")[:, :wide]
    return np.take_along_axis(to, order, 1), np.take_along_axis(away, order, 1) <= reach


def nearest(x: np.ndarray, members: np.ndarray, queries: np.ndarray, k: int, probes: int | None, min_cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, member, cosine): up to k and one members of each query in the rows of one task, as row numbers.

    Many members are split by centroids of their own, and queries routed to these, as all vectors are to the shards.
    """
    frm, to, cos = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    if len(members) > 2 * SHARD_ROWS:
        count = math.ceil(len(members) / SHARD_ROWS)
        some = members[:: max(1, len(members) // min(len(members), max(SAMPLE, 8 * count)))]
        cents = fit_centroids(x[some], count)
        own = np.concatenate([(x[members[at : at + 4096]] @ cents.T).argmax(1) for at in range(0, len(members), 4096)])
        routes = [visits(x[queries[at : at + 4096]], cents, probes, min_cosine) for at in range(0, len(queries), 4096)]
        shards, go = (np.concatenate(c) for c in zip(*routes, strict=True)) if routes else (np.zeros((0, 1), int), np.zeros((0, 1), bool))
        groups = [(members[own == c], queries[((shards == c) & go).any(1)]) for c in range(len(cents))]
    else:
        groups = [(members, queries)]
    for mine, asked in groups:
        if not len(mine) or not len(asked):
            continue
        g = Graph(np.ascontiguousarray(x[mine]))
        for at in range(0, len(asked), _BATCH):
            q = asked[at : at + _BATCH]
            ids, sims = g.search(x[q], max(BEAM, 2 * k))
            ids, sims = ids[:, : k + 1], sims[:, : k + 1]
            other = mine[np.maximum(ids, 0)]
            r, c = np.nonzero((ids >= 0) & (sims >= min_cosine) & (other != q[:, None]))
            frm.append(q[r])
            to.append(other[r, c])
            cos.append(np.minimum(sims[r, c], 1.0))
    return np.concatenate(frm), np.concatenate(to), np.concatenate(cos)


def knn_classes(classes: DataFrame, k: int, probes: int | None, min_cosine: float) -> DataFrame:
    """(key, other, cosine): up to k most similar other classes of each class (key binary, v binary of float32)."""
    n = classes.count()
    out = "key binary, other binary, cosine float"
    if n < 2:
        return classes.sparkSession.createDataFrame([], out)
    count = max(1, math.ceil(n / SHARD_ROWS))
    take = min(SAMPLE_MAX, max(SAMPLE, 8 * count))
    count = min(count, max(1, take // 8))
    sample = classes.select("v").filter(F.pmod(F.xxhash64("key"), F.lit(max(1, n // take))) == 0).toArrow()  # at most about 2 * SAMPLE_MAX vectors
    cents = fit_centroids(_matrix(sample.column("v")), count) if sample.num_rows else _matrix(classes.select("v").limit(1).toArrow().column("v"))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                to, go = visits(_matrix(b.column(0)), cents, probes, min_cosine)
                members, queries = np.bincount(to[:, 0], minlength=len(cents)), np.bincount(to[go], minlength=len(cents))
                at = np.flatnonzero(queries)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(members[at]), pa.array(queries[at])], names=["shard", "members", "queries"])

    counted = classes.select("v").mapInArrow(homes, "shard int, members bigint, queries bigint").groupBy("shard").agg(F.sum("members").alias("m"), F.sum("queries").alias("q")).collect()  # one row per centroid
    parts = {r["shard"]: math.ceil(r["m"] / SHARD_MAX) for r in counted if r["m"] > SHARD_MAX}
    rooms = {r["shard"]: math.ceil(r["q"] / VISITS_MAX) for r in counted if r["q"] > VISITS_MAX}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            to, go = visits(_matrix(b.column(1)), cents, probes, min_cosine)
            rows, shard, part, home = [], [], [], []
            keys = b.column(0).to_pylist() if parts else []
            for j in range(to.shape[1]):
                at = np.flatnonzero(go[:, j])
                s = to[at, j]
                rows.append(at)
                shard.append(s)
                own = np.zeros(len(s), np.int64)
                part.append(own)
                home.append(np.full(len(s), j == 0))
                for i in np.flatnonzero(np.isin(s, list(parts))) if parts else ():
                    p, mine = parts[int(s[i])], int.from_bytes(keys[at[i]][:4], "little") % parts[int(s[i])]
                    own[i] = mine
                    rest = [q for q in range(p) if q != mine]
                    rows.append(np.full(len(rest), at[i]))
                    shard.append(np.full(len(rest), s[i]))
                    part.append(np.array(rest))
                    home.append(np.zeros(len(rest), bool))
            at, shard, part, home = np.concatenate(rows), np.concatenate(shard), np.concatenate(part), np.concatenate(home)
            # each query is asked in one room, and members stand in all rooms of their shard
            room, ask = np.zeros(len(at), np.int64), np.ones(len(at), bool)
            crowded = np.flatnonzero(np.isin(shard, list(rooms))) if rooms else ()
            if len(crowded):
                keys = keys or b.column(0).to_pylist()
                more = []
                for i in crowded:
                    n, room[i] = rooms[int(shard[i])], int.from_bytes(keys[at[i]][4:8], "little") % rooms[int(shard[i])]
                    more += [(i, r) for r in range(n) if home[i] and r != room[i]]
                if more:
                    i, r = np.array(more).T
                    at, shard, part, home = (np.concatenate([c, c[i]]) for c in (at, shard, part, home))
                    room, ask = np.concatenate([room, r]), np.concatenate([ask, np.zeros(len(i), bool)])
            rows = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(room.astype(np.int32)), pa.array(home), pa.array(ask), b.column(0).take(rows), b.column(1).take(rows)], names=["shard", "part", "room", "home", "ask", "key", "v"]
            )

    def search(t: pa.Table) -> pa.Table:
        x, home, ask = _matrix(t.column("v")), t.column("home").to_numpy(), t.column("ask").to_numpy()
        keys = np.array(t.column("key").to_pylist(), object)
        frm, to, cos = nearest(x, np.flatnonzero(home), np.flatnonzero(ask), k, probes, min_cosine)
        return pa.table({"key": pa.array(keys[frm], pa.binary()), "other": pa.array(keys[to], pa.binary()), "cosine": pa.array(cos, pa.float32())})

    routed = classes.select("key", "v").mapInArrow(route, "shard int, part int, room int, home boolean, ask boolean, key binary, v binary")
    hits = routed.groupBy("shard", "part", "room").applyInArrow(search, out)
    best = W.partitionBy("key").orderBy(F.desc("cosine"), "other")
    return hits.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r")


def most_similar(df: DataFrame, id_col: str, vec_col: str, k: int = 5, dims: int = 128, probes: int | None = PROBES, min_cosine: float = -1.0, newest: str | None = None) -> DataFrame:
    """(id, other, cosine): up to k most similar other vectors of each, at least `min_cosine` alike.

    `probes` may only be None, for shards by their borders (`visits`), with a `min_cosine` above 0.
    """
    if not probes and min_cosine <= 0:
        raise ValueError("give probes where min_cosine is not above 0")
    src = df.filter(F.col(id_col).isNotNull() & (F.size(vec_col) == dims) & ~F.exists(vec_col, lambda e: e.isNull())).select(F.col(id_col).cast("string").alias("id"), F.col(vec_col).cast("array<float>").alias("v"), (F.col(newest).cast("timestamp") if newest else F.lit(None).cast("timestamp")).alias("new"))
    rows = src.mapInArrow(_unit_rows(dims), "id string, key binary, v binary, new timestamp")
    members = cut(rows.groupBy("id").agg(F.max(F.struct("new", "key")).alias("m")).select("id", "m.key"), "members")
    classes = cut(rows.groupBy("key").agg(F.first("v").alias("v")).join(members.select("key").distinct(), "key", "left_semi"), "classes")
    near = cut(knn_classes(classes, k, probes, min_cosine), "near")

    # the k + 1 smallest ids of each class stand for it in lists
    w = W.partitionBy("key").orderBy("id")
    heads = members.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1).groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("heads"))
    heads = cut(heads.join(members.groupBy("key").agg(F.count("*").alias("m")), "key"), "heads")
    entry = lambda ids, s: F.transform(ids, lambda i: F.struct((-s).alias("d"), i.alias("id")))
    others = near.join(heads.select(F.col("key").alias("other"), "heads"), "other").groupBy("key").agg(F.flatten(F.collect_list(entry(F.col("heads"), F.col("cosine").cast("double")))).alias("far"))
    lists = heads.join(others, "key", "left").select("key", "m", "heads", F.array_sort(F.concat(F.when(F.col("m") > 1, entry(F.col("heads"), F.lit(1.0))).otherwise(F.array().cast("array<struct<d:double,id:string>>")), F.coalesce("far", F.array().cast("array<struct<d:double,id:string>>")))).alias("list"))
    lists = cut(lists.filter(F.size("list") > 0), "lists")
    single = lists.filter("m = 1").select(F.col("heads")[0].alias("id"), "list")
    salts = 8
    many = lists.filter("m > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select("key", "salt", "list")
    copied = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).join(many, ["key", "salt"]).select("id", "list")
    both = single.unionByName(copied)
    own = F.slice(F.filter("list", lambda e: e["id"] != F.col("id")), 1, k)
    return both.select("id", F.explode(own).alias("e")).select("id", F.col("e.id").alias("other"), (-F.col("e.d")).alias("cosine"))


def similar_pairs(df: DataFrame, id_col: str, vec_col: str, min_cosine: float = 0.8, k: int = 5, dims: int = 128, probes: int | None = None, newest: str | None = None) -> DataFrame:
    """(id_a, id_b), id_a < id_b: pairs at least `min_cosine` alike of which one is among the k most similar of the other."""
    near = most_similar(df, id_col, vec_col, k, dims, probes, min_cosine, newest)
    return near.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
