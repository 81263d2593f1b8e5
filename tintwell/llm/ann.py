"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, results merged.

Rows are dealt by id over shards, so equal vectors spread over all of them. Within a shard equal vectors are one node with
a list of ids. A node's level is drawn by a keyed hash; the layers are built from the top. Nodes are inserted batch by
batch: each is searched for in the graph so far, entering at what the layer above finds nearest, and linked to those found
that are nearer to it than to each other; the links go both ways, and a list that grows too long keeps the links of the
same kind. Each layer is stored as one flat array of neighbours. All queries of a block walk through a graph together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintwell.operators.scratch import bounded_batches, staged

LINKS, CANDIDATES, BEAM, WIDTH = 16, 64, 256, 4
INDEX = "dim int, shard int, ids binary, starts binary, vectors binary, layers array<struct<nodes: binary, links: binary>>"
_FAR = np.float32(np.inf)


def _gaps(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = x - q
    return np.einsum("...k,...k->...", d, d)


def beam(x: np.ndarray, q: np.ndarray, entry: np.ndarray, links: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The `size` nearest nodes that a walk from each query's entry finds, nearest first, and their squared distances.

    links holds the neighbours of each node, filled up with -1. In each step the WIDTH nearest nodes that have not been
    looked at open their neighbours; a walk ends when all that it holds have been. Missing nodes are -1, at infinity.
    """
    n, cap = links.shape
    node, gap = np.full((len(q), size), -1, np.int32), np.full((len(q), size), _FAR, x.dtype)
    node[:, 0], gap[:, 0] = entry, _gaps(x[entry], q)
    opened, seen = np.zeros((len(q), size), bool), np.zeros((len(q), n), bool)
    live = np.arange(len(q))
    seen[live, entry] = True
    width = min(WIDTH, size)
    while len(live):
        open_gap = np.where(opened[live], _FAR, gap[live])
        pick = np.argpartition(open_gap, width - 1, axis=1)[:, :width]
        good = np.take_along_axis(open_gap, pick, 1) < _FAR
        going = good.any(1)
        live, pick, good = live[going], pick[going], good[going]
        if not len(live):
            break
        row = np.repeat(np.arange(len(live)), width)[good.reshape(-1)]
        opened[live[row], pick[good]] = True
        around = links[node[live[row], pick[good]]]
        row, around = np.repeat(row, cap)[around.reshape(-1) >= 0], around[around >= 0]
        new = ~seen[live[row], around]
        code = np.unique(row[new].astype(np.int64) * n + around[new])
        row, around = np.divmod(code, n)
        seen[live[row], around] = True
        near = _gaps(x[around], q[live[row]])
        column = size + np.arange(len(row)) - np.searchsorted(row, row)
        wide = max(size, int(column.max(initial=0)) + 1)
        all_gap, all_node = np.full((len(live), wide), _FAR, x.dtype), np.full((len(live), wide), -1, np.int32)
        all_gap[:, :size], all_node[:, :size] = gap[live], node[live]
        all_gap[row, column], all_node[row, column] = near, around
        was = np.zeros((len(live), wide), bool)
        was[:, :size] = opened[live]
        best = np.argpartition(all_gap, size - 1, axis=1)[:, :size]
        gap[live], node[live], opened[live] = (np.take_along_axis(a, best, 1) for a in (all_gap, all_node, was))
    order = np.argsort(gap, axis=1, kind="stable")
    return np.take_along_axis(node, order, 1), np.take_along_axis(gap, order, 1)


def diverse(x: np.ndarray, node: np.ndarray, gap: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first, at most `most` that are nearer to the row's point than to any chosen before.

    Where these are less than half of most, the nearest others fill up. Missing candidates are -1, at infinity.
    """
    there = node >= 0
    own = x[np.maximum(node, 0)]
    square = np.einsum("rck,rck->rc", own, own)
    pair = square[:, :, None] + square[:, None, :] - 2 * np.matmul(own, own.transpose(0, 2, 1))
    chosen, count, closest = np.zeros(node.shape, bool), np.zeros(len(node), int), np.full(node.shape, _FAR, x.dtype)
    for c in range(node.shape[1]):
        take = there[:, c] & (count < most) & (gap[:, c] <= closest[:, c])
        chosen[:, c] = take
        count += take
        closest[take] = np.minimum(closest[take], pair[take, c])
    rest = there & ~chosen
    chosen |= rest & (np.cumsum(rest, 1) <= (most // 2 - count)[:, None])
    order = np.argsort(~chosen, axis=1, kind="stable")[:, :most]
    return np.where(np.take_along_axis(chosen, order, 1), np.take_along_axis(node, order, 1), -1)


def _added(x: np.ndarray, links: np.ndarray, to: np.ndarray, source: np.ndarray) -> None:
    """Links from each of to to each of source; a list that is too long keeps the diverse ones, whatever their number."""
    cap = links.shape[1]
    order = np.lexsort((source, to))
    to, source = to[order], source[order]
    place = np.arange(len(to)) - np.searchsorted(to, to)
    for start in range(0, int(place.max(initial=-1)) + 1, cap):
        now = (place >= start) & (place < start + cap)
        at, row = np.unique(to[now], return_inverse=True)
        both = np.full((len(at), 2 * cap), -1, np.int32)
        both[:, :cap] = links[at]
        both[row, cap + place[now] - start] = source[now]
        room = (both >= 0).sum(1) <= cap
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        links[at[room]] = packed[room, :cap]
        some, nodes = at[~room], packed[~room]
        if len(some):
            gap = np.where(nodes >= 0, _gaps(x[np.maximum(nodes, 0)], x[some][:, None]), _FAR)
            near = np.argsort(gap, axis=1, kind="stable")
            links[some] = diverse(x, np.take_along_axis(nodes, near, 1), np.take_along_axis(gap, near, 1), cap)


def build_layer(x: np.ndarray, entry: np.ndarray, most: int, cap: int, candidates: int) -> np.ndarray:
    """Links of the rows of x, inserted in order; entry: a row before each one, from which it is searched for."""
    n = len(x)
    links = np.full((n, cap), -1, np.int32)
    at = min(n, 1)
    while at < n:
        to = min(n, at + max(1, min(at // 2, 512, 2**25 // n)))
        q, k = x[at:to], min(candidates, at)
        if at <= 4 * candidates:  # so few are compared as they are
            gap = _gaps(x[None, :at], q[:, None])
            node = np.argsort(gap, axis=1, kind="stable")[:, :k].astype(np.int32)
            gap = np.take_along_axis(gap, node, 1)
        else:
            node, gap = beam(x, q, entry[at:to], links, candidates)
        own = _gaps(q[None], q[:, None])  # those of the batch that come before, too
        own[np.arange(to - at)[None, :] >= np.arange(to - at)[:, None]] = _FAR
        few = np.argsort(own, axis=1, kind="stable")[:, :LINKS]
        near = np.take_along_axis(own, few, 1)
        node, gap = np.concatenate([node, np.where(near < _FAR, few + at, -1).astype(np.int32)], 1), np.concatenate([gap, near], 1)
        order = np.argsort(gap, axis=1, kind="stable")[:, :candidates]
        chosen = diverse(x, np.take_along_axis(node, order, 1), np.take_along_axis(gap, order, 1), most)
        links[at:to, : chosen.shape[1]] = chosen
        source, column = np.nonzero(chosen >= 0)
        _added(x, links, chosen[source, column].astype(np.int64), (source + at).astype(np.int32))
        at = to
    return links


def _plain(x: np.ndarray) -> np.ndarray:
    """The vectors in single precision, scaled where their squares would be too large or small for it."""
    most = np.abs(x).max(initial=0.0)
    return (x / most if most > 1e15 or 0 < most < 1e-15 else x).astype(np.float32)


def build(dim: int, shard: int, ids: np.ndarray, vectors: np.ndarray, most: int = LINKS, candidates: int = CANDIDATES) -> dict:
    """The index row of one shard: members of node i are ids[starts[i]:starts[i+1]], ascending; layer 0 holds all nodes.

    Nodes come in descending order of their level, so those of a layer are the first ones of the layer below.
    """
    order = np.lexsort((ids, *vectors.T))
    ids, vectors = ids[order], vectors[order]
    first = np.flatnonzero(np.r_[True, (vectors[1:] != vectors[:-1]).any(1)])
    draw = np.array([xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), 7) for i in ids[first]], np.uint64)
    level = np.floor(-np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53) / np.log(most)).astype(int)
    shuffle = np.lexsort((draw, -level))
    ends = np.r_[first[1:], len(ids)]
    members = [ids[first[i] : ends[i]] for i in shuffle]
    vectors = vectors[first[shuffle]]
    x = _plain(vectors)
    layers, above, found = [], 0, np.zeros(0, np.int64)
    for k in range(int(level.max(initial=0)), -1, -1):
        m = int((level >= k).sum())
        entry = np.zeros(m, np.int64)
        if above:
            for at in range(above, m, 2048):  # the layer above is complete
                entry[at : at + 2048] = beam(x[:above], x[at : min(m, at + 2048)], np.zeros(min(m, at + 2048) - at, int), links, 8)[0][:, 0]
        links = build_layer(x[:m], entry, most, 2 * most if k == 0 else most, candidates)
        layers.append({"nodes": np.array([m], np.int32).tobytes(), "links": links.tobytes()})
        above = m
    starts = np.r_[0, np.cumsum([len(m) for m in members])].astype(np.int32)
    exact = vectors.astype(np.float32)
    stored = exact if (exact == vectors).all() else vectors
    return {"dim": dim, "shard": shard, "ids": np.concatenate(members).astype(np.int64).tobytes(), "starts": starts.tobytes(), "vectors": stored.tobytes(), "layers": layers}


class Graph:
    """A stored graph, ready to be searched."""

    def __init__(self, dim: int, ids: bytes, starts: bytes, vectors: bytes, layers: list):
        self.ids, self.starts = np.frombuffer(ids, np.int64), np.frombuffer(starts, np.int32)
        n = len(self.starts) - 1
        self.x = np.frombuffer(vectors, np.float32 if len(vectors) == 4 * n * dim else np.float64).reshape(n, dim)
        most = float(np.abs(self.x).max(initial=0.0))
        self.scale = most if most > 1e15 or 0 < most < 1e-15 else 1.0
        self.plain = (self.x / self.scale).astype(np.float32)
        counts = [int(np.frombuffer(layer["nodes"], np.int32)[0]) for layer in layers]
        self.layers = [np.frombuffer(layer["links"], np.int32).reshape(m, -1) for layer, m in zip(layers, counts, strict=True)]

    def near(self, q: np.ndarray, own: np.ndarray, k: int, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row, ids, distances) of the k nearest that are found for each row of q, without the id in own; in double precision."""
        step = max(16, 2**25 // len(self.x))
        for start in range(0, len(q), step):
            some = q[start : start + step]
            plain = np.clip(some / self.scale, -1e18, 1e18).astype(np.float32)
            at = np.zeros(len(some), np.int64)
            for links in self.layers[:-1]:
                at = beam(self.plain[: len(links)], plain, at, links, 8)[0][:, 0]
            nodes = beam(self.plain, plain, at, self.layers[-1], max(size, k + 1))[0]
            for r, row in enumerate(nodes):
                row = row[row >= 0]
                d = self.x[row].astype(np.float64) - some[r]
                most = np.abs(d).max(axis=1, initial=0.0)
                large = (most > 1e150) | ((most < 1e-150) & (most > 0))
                gap = np.sqrt((d * d).sum(1))
                gap[large] = most[large] * np.sqrt(np.square(d[large] / most[large, None]).sum(1))
                n = self.starts[row + 1] - self.starts[row]
                ids, gaps = self.ids[np.repeat(self.starts[row] - (np.cumsum(n) - n), n) + np.arange(n.sum())], np.repeat(gap, n)
                ids, gaps = ids[ids != own[start + r]], gaps[ids != own[start + r]]
                best = np.lexsort((ids, gaps))[:k]
                yield start + r, ids[best], gaps[best]


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, v), each pair of id and vector once, of the rows that take part: those with an id and a vector of finite numbers that are not all zero."""
    v = F.col(vector_col).cast("array<double>")
    fine = rows.select(F.col(id_col).cast("bigint").alias("id"), F.size(v).alias("dim"), v.alias("v")).where("id is not null and v is not null and dim > 0")
    return fine.where("forall(v, e -> e is not null and not isnan(e) and abs(e) < double('infinity')) and exists(v, e -> e <> 0)").distinct()


def index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = 100_000, least_rows: int = 4096) -> DataFrame:
    """The index table of all rows that take part (see usable): a graph for each shard of vectors of one length.

    A shard has about shard_rows rows, so a task's share stays the same at every size; a smaller table is dealt over all
    cores, at no less than least_rows each. Vectors of different lengths have no distance and are in different graphs.
    Rows that share an id are each a candidate unless they are equal. An empty table gives an empty index.
    """
    fine = staged(usable(rows, id_col, vector_col), "vectors")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    share = F.least(F.lit(shard_rows), F.greatest(F.lit(least_rows), F.ceil(F.col("n") / cores)))
    sizes = fine.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select("dim", F.ceil(F.col("n") / share).cast("int").alias("shards"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, dim = table.column("id").to_numpy(), key[0].as_py()
        vectors = np.array(table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(ids), dim)
        return pa.Table.from_pylist([build(dim, key[1].as_py(), ids, vectors)], schema=schema)

    layer = pa.list_(pa.struct([("nodes", pa.binary()), ("links", pa.binary())]))
    schema = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("ids", pa.binary()), ("starts", pa.binary()), ("vectors", pa.binary()), ("layers", layer)])
    shard = F.pmod(F.xxhash64(F.lit("shard"), "id", "v"), F.col("shards")).cast("int").alias("shard")
    total = max(1, sizes.agg(F.sum("shards")).first()[0] or 0)  # a task for each shard, however few bytes it has
    return staged(fine.join(sizes, "dim").select("dim", shard, "id", "v").repartition(total, "dim", "shard").groupBy("dim", "shard").applyInArrow(run, INDEX), "graphs")


def search(graphs: DataFrame, rows: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, size: int = BEAM, block: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by Euclidean distance that the graphs find for each query row.

    Queries are the rows for which the column holds that take part (see usable); a query's own id is no candidate. Nearest
    come first, ties go to the smaller id. Blocks of queries are sent to each shard, where a graph is read once for a whole
    block, and the shards' best k of each query are merged.
    """
    asked = usable(rows, id_col, vector_col)
    asked = staged(asked.where(queries) if queries is not None else asked, "queries")
    blocks = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    number = F.xxhash64("id", "v")  # rows of one id with different vectors are different queries
    at = F.pmod(F.xxhash64(F.lit("block"), "id", "v"), F.col("blocks")).cast("int")
    packed = asked.join(blocks, "dim").groupBy("dim", at.alias("block")).agg(F.sort_array(F.collect_list(F.struct("id", number.alias("number"), "v"))).alias("asked"))  # about `block` rows each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                some = row["asked"].values
                ids, number = some.field("id").to_numpy(), some.field("number").to_numpy()
                q = some.field("v").flatten().to_numpy().reshape(len(ids), row["dim"].as_py())
                graph = Graph(*(row[c].as_py() for c in ("dim", "ids", "starts", "vectors", "layers")))
                got = list(graph.near(q, ids, k, size))
                n = [len(found) for _, found, _ in got]
                at = np.repeat([r for r, _, _ in got], n)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(number[at]), pa.array(np.concatenate([f for _, f, _ in got])), pa.array(np.concatenate([s for _, _, s in got]))], names=["query_id", "number", "vec_id", "score"])

    both = packed.select("dim", "asked").join(graphs, "dim").select("dim", "asked", "ids", "starts", "vectors", "layers")
    found = bounded_batches(both).mapInArrow(run, "query_id bigint, number bigint, vec_id bigint, score double")
    place = F.row_number().over(Window.partitionBy("query_id", "number").orderBy("score", "vec_id"))
    return found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
