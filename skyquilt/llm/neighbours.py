"""Approximate nearest neighbours by inner product: a graph by NN-descent, searched greedily.

Equal vectors are one class, for which its smallest vec_id stands, so that a crowd of copies is one node. Classes are
dealt to shards of a bounded size. Building: random projections put like vectors side by side, runs of CHUNK of them are
compared to give each vector first neighbours; then rounds of NN-descent join each vector's neighbours, forward and
reverse, with their vectors, compare neighbours of a vector with one another and offer each the better ones, until a round
changes less than STILL of all neighbours. Every round is a Spark join keyed by the vector, so no task holds more than a
neighbourhood or a chunk. Searching: a task holds one shard's graph, past which a share of the queries streams in blocks;
each walks greedily from the best of some entry points, and widens until none of the WIDTH best found has an unseen
neighbour. The shards' lists are merged by exact scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.plans.scratch import Scratch

#: Neighbours kept, random projections to begin with, vectors of a chunk.
DEGREE, TREES, CHUNK = 32, 4, 512
#: Rounds end once a smaller share of the neighbours is new, and after MOST rounds in any case.
STILL, MOST = 0.1, 8
#: Classes of a shard on average, queries of a block, width of a search, entry points.
SHARD, QUERIES, WIDTH, ENTRIES = 16_384, 128, 160, 256
#: Tasks that a shard's queries are dealt to at most; each gets a copy of the shard's graph.
PARTS = 4
_EDGE = "shard int, u long, v array<long>, s array<float>, fresh int"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of double) of the vectors that take part, each vec_id once."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False))).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The rows of a column of lists of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1), flat.dtype)


def _lists(flat: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(flat, kind))


def _edges(shard: np.ndarray, u: np.ndarray, v: np.ndarray, s: np.ndarray, sizes: np.ndarray, fresh: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(shard, pa.int32()), pa.array(u, pa.int64()), _lists(v, sizes, pa.int64()), _lists(s, sizes, pa.float32()), pa.array(np.asarray(fresh, np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["shard", "u", "v", "s", "fresh"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows sorted by their first ``keys`` columns, cut between groups: tables of whole groups, and where each group begins."""
    held: list[pa.RecordBatch] = []

    def starts(t: pa.RecordBatch) -> np.ndarray:
        own = [t.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([x[1:] != x[:-1] for x in own]))))

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not len(batch):
            continue
        at = starts(batch)
        if len(at) > 1 or held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in range(keys)):
            # The last group may go on in the next batch.
            held.append(batch.slice(0, at[-1]))
            held = [x for x in held if len(x)]
            if held:
                whole = joined()
                yield whole, starts(whole)
            held = [batch.slice(at[-1])]
        else:
            held.append(batch)
    if held:
        whole = joined()
        yield whole, starts(whole)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, tree, place, vec_id, x) in order to edges inside runs of CHUNK rows of a tree."""
    for table, starts in _runs(batches):
        ids, x = table.column(3).to_numpy(), _matrix(table.column(4))
        shard = table.column(0).to_numpy()
        for a, b in zip(starts, [*starts[1:], len(ids)], strict=True):
            for at in range(a, b, CHUNK):
                to = min(at + CHUNK, b)
                if to - at < 2:
                    continue
                near = x[at:to] @ x[at:to].T
                np.fill_diagonal(near, -np.inf)
                k = min(DEGREE, to - at - 1)
                best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                n = to - at
                yield _edges(shard[at:to], ids[at:to], ids[at:to][best].ravel(), np.take_along_axis(near, best, 1).ravel(), np.full(n, k), np.zeros(n))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches, gathered to a few runs at least, and where a tree begins in each; a tree may go on in the next."""
    held, n = [], 0

    def out():
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        own = [whole.column(k).to_numpy() for k in (0, 1)]
        return whole, np.flatnonzero(np.concatenate(([True], (own[0][1:] != own[0][:-1]) | (own[1][1:] != own[1][:-1]))))

    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        if n >= 8 * CHUNK:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def _nearest(who: np.ndarray, v: np.ndarray, s: np.ndarray, offered: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the neighbours ``v`` of each of ``who`` the DEGREE nearest, each once; of equal ones that which wasn't offered."""
    by = np.lexsort((offered, v, who))
    who, v, s, offered = who[by], v[by], s[by], offered[by]
    new = np.concatenate(([True], (who[1:] != who[:-1]) | (v[1:] != v[:-1])))[: len(who)]
    who, v, s, offered = who[new], v[new], s[new], offered[new]
    by = np.lexsort((v, -s, who))
    who, v, s, offered = who[by], v[by], s[by], offered[by]
    keep = np.arange(len(who)) - np.searchsorted(who, who) < DEGREE
    return who[keep], v[keep], s[keep], offered[keep]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of edges, sorted by shard and u, to one row per u with its DEGREE best and how many of them were offered in this round."""
    for table, starts in _groups(batches, 2):
        of = np.zeros(len(table), np.int64)
        of[starts[1:]] = 1
        of = np.cumsum(of)
        sizes = np.diff(table.column(2).offsets.to_numpy())
        who = np.repeat(of, sizes)
        v, s = table.column(2).flatten().to_numpy(), table.column(3).flatten().to_numpy()
        offered = np.repeat(table.column(4).to_numpy(), sizes)
        who, v, s, offered = _nearest(who, v, s, offered)
        n = len(starts)
        yield _edges(table.column(0).to_numpy()[starts], table.column(1).to_numpy()[starts], v, s, np.bincount(who, minlength=n), np.bincount(who, offered, n))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, u, a, least, x), sorted by shard and u: neighbours of one vector are compared with one another.

    Each gets those that are nearer than the farthest neighbour it has, DEGREE from each batch at most.
    """
    for table, starts in _groups(batches, 2):
        ids, least, x = table.column(2).to_numpy(), table.column(3).to_numpy(), _matrix(table.column(4))
        shard = table.column(0).to_numpy()
        found = []
        for a, b in zip(starts, [*starts[1:], len(ids)], strict=True):
            near = x[a:b] @ x[a:b].T
            good = near > least[a:b, None]
            np.fill_diagonal(good, False)
            row, col = np.nonzero(good)
            found.append((a + row, ids[a:b][col], near[row, col]))
        at, v, s = (np.concatenate(z) for z in zip(*found, strict=True))
        if len(at):
            # One row for each vector that is offered some, with the nearest of them: a hub is offered some by every vector.
            names, place, who = np.unique(ids, return_index=True, return_inverse=True)
            who, v, s, _ = _nearest(who[at], v, s, np.ones(len(at), bool))
            first = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
            yield _edges(shard[place[who[first]]], names[who[first]], v, s, np.diff(np.append(first, len(who))), np.ones(len(first)))


def _by_vector(edges: DataFrame) -> DataFrame:
    return edges.repartition("shard", "u").sortWithinPartitions("shard", "u").mapInArrow(_merge, _EDGE)


def _shard(shards: int):
    return F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")


def build_graph(vectors: DataFrame, shards: int, size: int) -> DataFrame:
    """shard, u, v and s: the DEGREE nearest found for each vector inside its shard, and their inner products.

    ``vectors`` has vec_id, each once, and embedding, of ``size`` numbers. Reverse neighbours take part in a round up to
    DEGREE, the nearest first.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.save(vectors.select(_shard(shards).alias("shard"), "vec_id", F.col("embedding").cast("array<float>").alias("x")))
    planes = np.random.default_rng(11).normal(size=(TREES, size))
    dots = [F.aggregate(F.zip_with("x", F.array(*map(F.lit, p.tolist())), lambda a, b: a * b), F.lit(0.0), lambda s, y: s + y) for p in planes]
    trees = rows.select("shard", F.posexplode(F.array(*dots)).alias("tree", "place"), "vec_id", "x")
    # A range of places is a partition, so a crowd of like vectors is split over neighbouring runs.
    runs = trees.repartitionByRange("shard", "tree", "place", "vec_id").sortWithinPartitions("shard", "tree", "place", "vec_id")
    graph = scratch.save(_by_vector(runs.select("shard", "tree", "place", "vec_id", "x").mapInArrow(_chunks, _EDGE)))
    for _ in range(MOST):
        pairs = graph.select("shard", "u", F.explode(F.arrays_zip("v", "s")).alias("e")).select("shard", "u", F.col("e.v").alias("a"), F.col("e.s").alias("s"))
        back = pairs.select("shard", F.col("a").alias("u"), F.col("u").alias("a"), "s")
        back = back.withColumn("r", F.row_number().over(Window.partitionBy("shard", "u").orderBy(F.desc("s"), "a"))).where(F.col("r") <= DEGREE).drop("r")
        near = pairs.union(back).select("shard", "u", "a").distinct()
        # A short list takes whatever comes.
        farthest = F.when(F.size("s") < DEGREE, F.lit(float("-inf")).cast("float")).otherwise(F.array_min("s"))
        least = graph.select("shard", F.col("u").alias("a"), farthest.alias("least"))
        known = rows.select("shard", F.col("vec_id").alias("a"), "x").join(least, ["shard", "a"])
        near = near.join(known, ["shard", "a"]).select("shard", "u", "a", "least", "x")
        offers = near.repartition("shard", "u").sortWithinPartitions("shard", "u").mapInArrow(_compare, _EDGE)
        after = scratch.save(_by_vector(offers.union(graph.withColumn("fresh", F.lit(0)))))
        scratch.drop(graph)
        graph = after
        changed = graph.agg(F.sum("fresh"), F.sum(F.size("v"))).first()
        if not changed[1] or changed[0] < STILL * changed[1]:
            break
    scratch.drop(rows)
    return graph.drop("fresh")


class Walk:
    """Greedy search on one shard's graph, for many queries side by side."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, edges: np.ndarray, sizes: np.ndarray):
        """``edges``: the neighbours' ids of each vector, one after another; ``sizes``: how many it has."""
        order = np.argsort(ids)
        self.ids, self.exact, self.x = ids[order], x[order], x[order].astype(np.float32)
        n = len(ids)
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        of, to = np.repeat(back, sizes), np.searchsorted(self.ids, edges)
        code = np.unique(np.concatenate([of * n + to, to * n + of]))
        a, b = code // n, code % n
        # Reverse edges make hubs; their farthest are cut, as the other end still leads to the hub.
        score = np.concatenate([np.einsum("ij,ij->i", self.x[a[k : k + 65536]], self.x[b[k : k + 65536]]) for k in range(0, len(a), 65536)] or [np.empty(0)])
        by = np.lexsort((-score, a))
        a, b = a[by], b[by]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        self.near = np.full((n, 2 * DEGREE), n, np.int32)
        keep = rank < 2 * DEGREE
        self.near[a[keep], rank[keep]] = b[keep]
        self.entries = np.random.default_rng(5).permutation(n)[:ENTRIES].astype(np.int32)
        self.order = order

    def search(self, q: np.ndarray, k: int) -> np.ndarray:
        """The places of the best WIDTH candidates found for each query, or of 4 k, if that is more."""
        m, n = len(q), len(self.ids)
        width = min(n, max(WIDTH, 4 * k))
        seen = np.zeros((m, n + 1), bool)
        seen[:, n] = True
        rows = np.arange(m)[:, None]
        first = np.broadcast_to(self.entries, (m, len(self.entries)))
        seen[rows, first] = True
        place, score = first.copy(), q @ self.x[self.entries].T
        fresh = np.ones_like(place, bool)
        while True:
            if place.shape[1] > width:
                top = np.argpartition(-score, width - 1, axis=1)[:, :width]
                place, score, fresh = (np.take_along_axis(z, top, 1) for z in (place, score, fresh))
            # Each query expands its best few candidates that aren't yet expanded.
            open_ = np.where(fresh, score, -np.inf)
            step = min(8, place.shape[1])
            pick = np.argpartition(-open_, step - 1, axis=1)[:, :step]
            live = np.isfinite(np.take_along_axis(open_, pick, 1))
            if not live.any():
                return place
            fresh[rows, pick] &= ~live
            near = np.where(live[:, :, None], self.near[np.take_along_axis(place, pick, 1)], n).reshape(m, -1)
            near = np.sort(near, 1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            near = np.where(seen[rows, near], n, near)
            seen[rows, near] = True
            # Unseen neighbours go left, so that the block is no wider than the longest list of them.
            near = np.sort(near, 1)[:, : max(1, int((near < n).sum(1).max()))]
            who, at = np.nonzero(near < n)
            value = np.full(near.shape, -np.inf, np.float32)
            value[who, at] = np.einsum("ij,ij->i", q[who], self.x[near[who, at]])
            near = np.where(near == n, 0, near)
            place, score = np.concatenate([place, near], 1), np.concatenate([score, value], 1)
            fresh = np.concatenate([fresh, np.isfinite(value)], 1)


class _Shard:
    """What has come of a shard so far, and its searches."""

    def __init__(self):
        self.ids, self.x, self.edges, self.sizes, self.members, self.counts, self.walk = [], [], [], [], [], [], None

    def add(self, part: pa.RecordBatch) -> None:
        self.ids.append(part.column(3).to_numpy())
        self.x.append(_matrix(part.column(4)))
        for column, flat, sizes in ((5, self.edges, self.sizes), (6, self.members, self.counts)):
            flat.append(part.column(column).flatten().to_numpy(zero_copy_only=False))
            sizes.append(part.column(column).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))

    def answers(self, part: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, float]]:
        if not self.ids:
            return
        if self.walk is None:
            ids, x, edges, sizes, members, counts = map(np.concatenate, (self.ids, self.x, self.edges, self.sizes, self.members, self.counts))
            self.walk = Walk(ids, x, edges.astype(np.int64), sizes)
            self.members, self.ends, self.counts = members.astype(np.int64), np.cumsum(counts)[self.walk.order], counts[self.walk.order]
            self.ids, self.x, self.edges, self.sizes = [True], [], [], []
        walk, asked, own = self.walk, part.column(3).to_numpy(), _matrix(part.column(4))
        for at in range(0, len(asked), QUERIES):
            q = own[at : at + QUERIES]
            for query, vector, place in zip(asked[at : at + QUERIES].tolist(), q, walk.search(q.astype(np.float32), k), strict=True):
                place = np.unique(place)
                score = (walk.exact[place] * vector).sum(1)
                best = place[np.lexsort((walk.ids[place], -score))[: k + 1]]
                n = self.counts[best]
                vec = np.concatenate([self.members[self.ends[b] - self.counts[b] : self.ends[b]] for b in best])
                score = np.repeat((walk.exact[best] * vector).sum(1), n)
                score, vec = score[vec != query], vec[vec != query]
                top = np.lexsort((vec, -score))[:k]
                yield from zip([query] * len(top), vec[top].tolist(), score[top].tolist(), strict=True)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, part, query, id, x, v, members), sorted by these: a shard's graph, then its queries."""
        key, shard = None, _Shard()
        for batch in batches:
            if not len(batch):
                continue
            own = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            cuts = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in own])) + 1
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if (now := (own[0][a], own[1][a])) != key:
                    key, shard = now, _Shard()
                part = batch.slice(a, b - a)
                if own[2][a]:
                    out += shard.answers(part, k)
                else:
                    shard.add(part)
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k vectors found nearest each query by inner product.

    Both frames have vec_id and embedding; a query's own vec_id is left out. Vectors that are null, zero or
    hold null or non-finite components take no part, nor do rows without a vec_id; a vec_id that is repeated
    counts once, with its smallest vector. Vectors of different lengths raise a ValueError. Ties go to the smaller
    vec_id, fewer than k candidates give fewer rows. Scores are exact; which vectors are found is approximate.

    Every query is put to every shard, so that the search's work is the number of queries times that of shards. What is
    shipped for it is a copy of a shard for each of at most PARTS tasks, and of a query for each shard.
    """
    scratch = Scratch(vectors.sparkSession)
    rows, asked = scratch.save(usable(vectors)), scratch.save(usable(queries))
    lengths = rows.select(F.size("embedding").alias("n")).union(asked.select(F.size("embedding"))).agg(F.min("n"), F.max("n")).first()
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors have from {lengths[0]} to {lengths[1]} components")
    # Of a crowd of equal vectors the k + 1 smallest ids are enough: no query can want more, itself left out.
    order = Window.partitionBy("embedding").orderBy("vec_id")
    first = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    classes = first.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.sort_array(F.collect_list("vec_id")).alias("members"))
    classes = scratch.save(classes.select("vec_id", "embedding", "members"))
    n, m = classes.count(), asked.count()
    shards, parts = max(1, math.ceil(n / SHARD)), max(1, min(PARTS, math.ceil(m / QUERIES)))
    graph = build_graph(classes, shards, lengths[0] or 1)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = lambda x: F.lit(None).cast("array<long>").alias(x)
    held = classes.withColumn("shard", _shard(shards)).join(graph.select("shard", F.col("u").alias("vec_id"), "v"), ["shard", "vec_id"], "left")
    held = held.select("shard", each(parts).alias("part"), F.lit(False).alias("query"), "vec_id", "embedding", "v", "members")
    put = asked.select(each(shards).alias("shard"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), F.lit(True).alias("query"), "vec_id", "embedding", none("v"), none("members"))
    found = held.unionByName(put).repartition(shards * parts, "shard", "part").sortWithinPartitions("shard", "part", "query").mapInArrow(_search(k), "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
