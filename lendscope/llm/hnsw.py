"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Each shard's graph is kept as flat neighbour arrays, one per layer, and stored as one row of a
table in the shared folder; query blocks search every shard, and the shards' results are merged. As a
table grows, its shards grow and not their number, until one fills the memory it may take.
Largest inner product becomes smallest distance by one more component that lifts all vectors
of a shard to equal length. Insertion and search run many points in lockstep on arrays.

Pruning links back can cut a layer into parts (tight clusters do), so the index holds start points of
the lowest layer, from which every point is one link away at most; a search enters at the nearest of
them and at what the upper layers find. The beam of a query is doubled until its result stands still, so
hard queries get the wide beams and easy ones don't pay for them; a wider beam goes on where the last ended.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.common import materialize

M = 16  # links a point makes in an upper layer; the lowest layer keeps twice as many
EF_BUILD = 64
EF_SEARCH = 24  # the first beam of a query, at least
STARTS = 16  # start points a search enters at
INSERT_AT_ONCE = 1024
LINKED_AT_ONCE = 256
SEARCH_AT_ONCE = 1024
PIECE = 1 << 16  # vector components gathered at once
SEEN_AT_ONCE = 1 << 25  # bytes that mark the points met
SHARDS = 8  # more only if their vectors would not fit SHARD_COMPONENTS
SHARD_COMPONENTS = 1 << 22  # vector components of the largest shard, which bounds a task's memory
BLOCK_COMPONENTS = 1 << 22  # those of the queries that go to a shard together


class _Beams:
    """Beam searches in one layer for many queries in lockstep, from ``entry``: start points of each
    query, -1 for none. ``pool`` holds the nearest points met, sorted, each as one number: squared
    distance, point, and in the lowest bit whether its links were followed; ``NONE`` pads."""

    NONE = np.uint64(2**64 - 1)

    def __init__(self, data, norms, links, queries, entry, width):
        self.data, self.norms, self.links, self.queries = data, norms, links, queries
        self.own = (queries * queries).sum(1)
        self.seen = np.zeros((len(queries), len(data) + 1), dtype=bool)  # the first column stands for -1
        self.seen[:, 0] = True
        self.pool = np.full((len(queries), width), self.NONE)
        rows = np.arange(len(queries))
        self._merge(rows, np.concatenate([self._fresh(rows, entry[:, c:c + 1]) for c in range(entry.shape[1])], 1))

    def _fresh(self, at, points):
        """``points`` with those that the queries ``at`` met before as -1."""
        seen = self.seen.reshape(-1)
        place = (at * self.seen.shape[1] + 1)[:, None] + points
        points = np.where(seen[place], -1, points)
        seen[place] = True
        return points

    def _merge(self, at, found):
        """Take new points ``found`` (-1 padded) of the queries ``at`` into their pools."""
        i, j = np.nonzero(found >= 0)
        p, q = found[i, j], at[i]
        dist = self.norms[p] + self.own[q] - 2 * self._products(p, q)
        dist = np.maximum(dist, 0).astype(np.float32)  # the bits of floats from 0 on sort as the floats do
        number = dist.view(np.uint32).astype(np.uint64) << np.uint64(32) | p.astype(np.uint64) << np.uint64(1)
        better = number < self.pool[q, -1]
        i, number = i[better], number[better]
        if len(i):
            count = np.bincount(i, minlength=len(at))
            new = np.full((len(at), count.max()), self.NONE)
            new[i, np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)] = number
            self.pool[at] = np.sort(np.concatenate([self.pool[at], new], 1), axis=1)[:, :self.pool.shape[1]]

    def _products(self, p, q):
        """Inner products of points ``p`` and queries ``q``, by pieces that fit the cache."""
        out, step = np.empty(len(p), dtype=np.float32), max(1, PIECE // self.data.shape[1])
        for lo in range(0, len(p), step):
            piece = slice(lo, lo + step)
            out[piece] = np.einsum("ij,ij->i", self.data[p[piece]], self.queries[q[piece]])
        return out

    def run(self, ef):
        """Follow links until those of each query's ``ef`` nearest points met are all followed."""
        active, expand = np.arange(len(self.pool)), max(4, ef // 8)
        while len(active):
            open_ = self.pool[active, :ef] & np.uint64(1) == 0
            go = open_.any(1)
            active, open_ = active[go], open_[go]
            if not len(active):
                break
            turn = np.cumsum(open_, axis=1)
            i, j = np.nonzero(open_ & (turn <= expand))
            points = np.full((len(active), expand), -1, dtype=np.int64)
            points[i, turn[i, j] - 1] = self.points(self.pool[active[i], j])
            self.pool[active[i], j] |= np.uint64(1)
            self._merge(active, np.concatenate(
                [self._fresh(active, np.where(c[:, None] >= 0, self.links[c], -1)) for c in points.T], 1))
        return self

    def widen(self, some, ef):
        """Go on for the queries ``some`` alone, with beams of ``ef``."""
        self.queries, self.own, self.seen = self.queries[some], self.own[some], self.seen[some]
        more = np.full((len(some), max(0, 2 * ef - self.pool.shape[1])), self.NONE)
        self.pool = np.concatenate([self.pool[some], more], 1)
        return self.run(ef)

    @staticmethod
    def points(pool):
        return (np.where(pool == _Beams.NONE, 0, (pool >> np.uint64(1)) & np.uint64(2**31 - 1)).astype(np.int64)
                - (pool == _Beams.NONE))

    def result(self, ef):
        """(points, squared distances), nearest first, padded with -1 and infinity."""
        best = self.pool[:, :ef]
        dist = (best >> np.uint64(32)).astype(np.uint32).view(np.float32)
        return self.points(best), np.where(best == self.NONE, np.float32(np.inf), dist)


def _parts(n_queries, n):
    """Slices of queries searched in lockstep among ``n`` points, which bounds the working arrays."""
    step = max(1, min(SEARCH_AT_ONCE, SEEN_AT_ONCE // (n + 1)))
    return [slice(lo, lo + step) for lo in range(0, n_queries, step)]


def _beam(data, norms, links, queries, entry, ef):
    """(points, squared distances) that beam searches of the queries find, see ``_Beams``."""
    found = [_Beams(data, norms, links, queries[part], entry[part], ef).run(ef).result(ef)
             for part in _parts(len(queries), len(data))]
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _diverse(data, points, candidates, dist, keep):
    """Of each point's candidates (nearest first, -1 padded) up to ``keep`` that are nearer to the
    point than to any candidate kept before, then the nearest others."""
    vectors = data[candidates]
    norms = (vectors * vectors).sum(2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    kept = np.zeros(candidates.shape, dtype=bool)
    closest = np.full(candidates.shape, np.inf, dtype=np.float32)
    count = np.zeros(len(candidates), dtype=np.int64)
    for c in range(candidates.shape[1]):
        take = (candidates[:, c] >= 0) & (dist[:, c] < closest[:, c]) & (count < keep)
        kept[:, c] = take
        count += take
        closest = np.where(take[:, None], np.minimum(closest, between[:, c, :]), closest)
    order = np.argsort(np.where(candidates < 0, 2, ~kept), axis=1, kind="stable")[:, :keep]
    chosen = np.take_along_axis(candidates, order, 1)
    if chosen.shape[1] < keep:
        chosen = np.pad(chosen, ((0, 0), (0, keep - chosen.shape[1])), constant_values=-1)
    return chosen


def _layer(data, entry_of, keep):
    """Flat neighbour array of one layer over ``data``; ``entry_of(points)`` gives start points
    among those inserted before (the first point is always one)."""
    n = len(data)
    links = np.full((n, keep), -1, dtype=np.int64)
    lengths = (data * data).sum(1)
    begin = 0
    while begin < n:
        stop = min(n, begin + min(INSERT_AT_ONCE, max(256, begin)))
        batch = np.arange(begin, stop)
        own, norms = data[batch], lengths[batch]
        mutual = norms[:, None] + norms[None, :] - 2 * own @ own.T
        np.fill_diagonal(mutual, np.inf)
        width = min(EF_BUILD, len(batch))
        near = np.argpartition(mutual, width - 1, axis=1)[:, :width]
        near_d = np.take_along_axis(mutual, near, 1)
        cand, cand_d = np.where(np.isinf(near_d), -1, near + begin), near_d
        if begin:
            got, got_d = _beam(data[:begin], lengths[:begin], links[:begin], own, entry_of(batch, begin), EF_BUILD)
            cand, cand_d = np.concatenate([got, cand], 1), np.concatenate([got_d, cand_d], 1)
        order = np.argsort(cand_d, axis=1, kind="stable")[:, :EF_BUILD]
        cand, cand_d = np.take_along_axis(cand, order, 1), np.take_along_axis(cand_d, order, 1)
        links[batch] = _diverse(data, batch, cand, cand_d, keep)
        # Links back: the points linked to choose again among what they have and the new ones. Those
        # with as many new ones go together, so that a few much linked points don't widen all arrays.
        source, slot = np.nonzero(links[batch] >= 0)
        target, source = links[batch][source, slot], batch[source]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        touched, first, n_new = np.unique(target, return_index=True, return_counts=True)
        by_count = np.argsort(n_new, kind="stable")
        touched, first, n_new = touched[by_count], first[by_count], n_new[by_count]
        for lo in range(0, len(touched), LINKED_AT_ONCE):
            some, count = touched[lo:lo + LINKED_AT_ONCE], n_new[lo:lo + LINKED_AT_ONCE]
            place = np.arange(count.max())
            extra = np.where(place < count[:, None], source[np.minimum(first[lo:lo + LINKED_AT_ONCE, None] + place, len(source) - 1)], -1)
            extra = np.where((extra[:, :, None] == links[some][:, None, :]).any(2), -1, extra)
            cand = np.concatenate([links[some], extra], 1)
            diff = data[cand] - data[some][:, None, :]
            cand_d = np.where(cand < 0, np.inf, (diff * diff).sum(2))
            order = np.argsort(cand_d, axis=1, kind="stable")[:, :3 * keep]
            links[some] = _diverse(data, some, np.take_along_axis(cand, order, 1), np.take_along_axis(cand_d, order, 1), keep)
        begin = stop
    return links


def build_graph(vectors: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """The shard's index: lifted vectors in order of falling layer, ``perm`` (their rows), the
    number of points in each layer and each layer's flat neighbour array."""
    n = len(vectors)
    norms = (vectors.astype(np.float64) ** 2).sum(1)
    lift = np.sqrt(np.maximum(norms.max() - norms, 0))
    data = np.concatenate([vectors, lift[:, None]], 1).astype(np.float32)
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(M)).astype(np.int64)
    perm = np.argsort(-level, kind="stable")
    data, level = data[perm], level[perm]
    sizes = [int((level >= top).sum()) for top in range(int(level.max()) + 1)]  # points of layer 0, 1, ...
    index = {"data": data, "perm": perm, "sizes": np.array(sizes)}
    lengths = (data * data).sum(1)
    for layer in reversed(range(len(sizes))):
        above = range(len(sizes) - 1, layer, -1)

        def entry_of(points, inserted, above=above):
            at = np.zeros((len(points), 1), dtype=np.int64)
            for upper in above:
                size = min(sizes[upper], inserted)
                links = index[f"links{upper}"][:size].astype(np.int64)
                at = _beam(data[:size], lengths[:size], np.where(links < size, links, -1), data[points], at, 4)[0][:, :1]
                at = np.maximum(at, 0)
            return at

        keep = 2 * M if layer == 0 else M
        index[f"links{layer}"] = _layer(data[:sizes[layer]], entry_of, keep).astype(np.int32)
    index["starts"] = start_points(index["links0"])
    return index


def start_points(links: np.ndarray) -> np.ndarray:
    """Points that cover all: every point is one of them or linked from one of them."""
    covered, starts = np.zeros(len(links) + 1, dtype=bool), []  # the last entry stands for -1
    for point in range(len(links)):
        if not covered[point]:
            starts.append(point)
            covered[point] = covered[links[point]] = True
    return np.array(starts, dtype=np.int64)


def search_graph(index: dict[str, np.ndarray], queries: np.ndarray, k: int, ef: int = EF_SEARCH) -> np.ndarray:
    """Rows (of the vectors given to ``build_graph``) found nearest to each query, nearest first, -1
    padded: at least ``k``, if there are as many."""
    lifted = np.concatenate([queries, np.zeros((len(queries), 1))], 1).astype(np.float32)
    data, sizes, starts = index["data"], index["sizes"], index["starts"]
    lengths = (data * data).sum(1)
    links = [index[f"links{layer}"].astype(np.int64) for layer in range(len(sizes))]
    ef = min(max(ef, 2 * k + 6), len(data))

    def search(asked):
        at = np.zeros((len(asked), 1), dtype=np.int64)
        for layer in reversed(range(1, len(sizes))):
            at = _beam(data[:sizes[layer]], lengths[:sizes[layer]], links[layer], asked, at, 4)[0]
            at[:, 0] = np.maximum(at[:, 0], 0)
        apart = lengths[starts] - 2 * asked @ data[starts].T
        near = starts[np.argpartition(apart, min(STARTS, len(starts)) - 1, axis=1)[:, :STARTS]]
        entry = np.concatenate([at, np.where((near[:, :, None] == at[:, None, :]).any(2), -1, near)], 1)
        beams = _Beams(data, lengths, links[0], asked, entry, 2 * ef).run(ef)
        found, todo, width = beams.result(ef)[0], np.arange(len(asked)), ef
        changed = todo
        while len(changed) and width < len(data):
            width = min(2 * width, len(data))
            wider = beams.widen(changed, width).result(ef)[0]
            todo = todo[changed]
            changed = np.flatnonzero((wider[:, :k] != found[todo, :k]).any(1))
            found[todo] = wider
        return found

    found = np.concatenate([search(lifted[part]) for part in _parts(len(lifted), len(data))])
    return np.where(found >= 0, index["perm"][found], -1)


def pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack_arrays(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(blob)))


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is not null, empty or zero and holds no null or non-finite component."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                         & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def shard_count(n_points: int, components: int, shard_rows: int) -> int:
    """Shards of about ``shard_rows`` points up to ``SHARDS`` of them, then larger ones: every query
    searches every shard, and a graph of twice the size costs a search little more."""
    return max(1, min(-(-n_points // shard_rows), SHARDS), -(-components // SHARD_COMPONENTS))


def nearest(df: DataFrame, query_step: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = 8192, query_rows: int = 2048, ef: int = EF_SEARCH) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``query_step`` the
    ``k`` rows found with the largest inner product, ties to the smaller id, its own id left out.

    Every usable row is in the index of one shard. Equal vectors are one point that keeps its
    ``k + 1`` smallest ids, all that any result can need, so copies do not crowd the graph. Rows
    with a null id, or a vector that is null, zero or holds null or non-finite components, take
    no part; a row repeated in id and vector counts once; an id with several vectors has one
    result list per vector's best, under one query id. Vectors are compared with those of their
    own length only. Scores are computed in double precision on the vectors as stored. Empty
    tables, and queries without candidates, give no rows.
    """
    rows = usable(df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("embedding")))
    rows = rows.dropDuplicates(["vec_id", "embedding"])
    order = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    points = (rows.withColumn("place", order).where(F.col("place") <= k + 1)
              .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
              .withColumn("dim", F.size("embedding")))
    points = materialize(points, "hnsw-points")
    count_size = [F.count(F.lit(1)), F.coalesce(F.sum(F.col("dim").cast("long")), F.lit(0))]
    n_points, components = points.agg(*count_size).first()
    n_shards = shard_count(n_points, components, shard_rows)
    queries = materialize(rows.where(F.col("vec_id") % query_step == 0).withColumn("dim", F.size("embedding")), "hnsw-queries")
    # Each block of queries gets its own copy of a shard's graph: as few blocks as memory allows.
    n_blocks = max(1, -(-queries.agg(*count_size).first()[1] // BLOCK_COMPONENTS))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ids", key=lambda s: s.map(lambda x: x[0]), ignore_index=True)
        vectors = np.stack(pdf["embedding"].to_numpy())
        lengths = pdf["ids"].map(len).to_numpy()
        blob = pack_arrays(build_graph(vectors) | {
            "vectors": vectors, "ids": np.concatenate(pdf["ids"].to_numpy()), "first": np.r_[0, np.cumsum(lengths)]})
        return pdf.iloc[:1][["dim", "shard"]].assign(blob=[blob])

    index = (points.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(n_shards)))
             .groupBy("dim", "shard").applyInPandas(build, "dim int, shard long, blob binary"))
    index = materialize(index, "hnsw-index")

    # Points lie in shards by a hash, so a shard holds its share of a query's nearest, give or take: the
    # beams of a shard go on until so many of its results stand still; more of them in larger graphs.
    doubled = int(np.ceil(np.log2(max(1, n_points / (n_shards * shard_rows)))))
    settle = min(k + 1, -(-3 * (k + 1) // (2 * n_shards)) + 6 + 3 * doubled)

    def search(found_index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(found_index) or not len(asked):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        graph = unpack_arrays(found_index["blob"].iloc[0])
        asked = asked.sort_values("vec_id", kind="stable")
        return pd.concat([search_some(graph, asked.iloc[lo:lo + query_rows]) for lo in range(0, len(asked), query_rows)])

    def search_some(graph: dict[str, np.ndarray], asked: pd.DataFrame) -> pd.DataFrame:
        q = np.stack(asked["embedding"].to_numpy())
        hit = search_graph(graph, q, settle, ef)
        at, slot = np.nonzero(hit >= 0)
        point = hit[at, slot]
        score = (q[at] * graph["vectors"][point]).sum(1)
        copies = graph["first"][point + 1] - graph["first"][point]
        row = np.repeat(np.arange(len(point)), copies)
        ids = graph["ids"][graph["first"][point[row]] + np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)]
        query_id = asked["vec_id"].to_numpy()[at[row]]
        out = pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": score[row]})
        out = out[out["query_id"] != out["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        out = out.drop_duplicates(["query_id", "vec_id"])
        return out[out.groupby("query_id").cumcount() < k]

    asked = (queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)).cast("array<bigint>"))))
    blocks = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>")))
    key = ["dim", "shard", "block"]
    found = (blocks.groupBy(*key).cogroup(asked.groupBy(*key))
             .applyInPandas(search, "query_id long, vec_id long, score double"))
    ranked = (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
              .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
