"""Approximate nearest neighbours by hierarchical navigable small-world graphs, one per shard of the rows.

Rows are dealt to shards by a hash. Each shard's graph is kept as flat arrays: the vectors, one array of neighbour numbers
per level with a fixed number of places a node, and the nodes of each level. A query descends from the top level to the
nodes nearest to it and widens into a beam on the lowest level; every shard is asked and the shards' results are merged by
their exact scores.

Nearness is the inner product. Vectors of different lengths get one more component that makes all of a shard equally long,
so the order by inner product is the order by distance and the graph is built on distances. Equal vectors are one node with
a list of ids, so a vector that many rows share is not a clique that the beam can't leave.

Nodes are inserted in batches, the nodes of upper levels first. A batch is searched in the graph so far and within itself;
links are chosen so that they point in different directions, and each link is answered by one back.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.llm import vector_blocks as vb
from vigilake.session import staged

LINKS = 16              # links of a node on an upper level; twice as many on the lowest
BEAM_BUILD = 64         # width of the beam while building
BEAM = 96               # width of the beam of a search; at least twice the neighbours asked for
EXPANDED = 4            # nodes of the beam that are expanded at once
BATCH = 256             # nodes inserted, or queries searched, side by side
SHARD_BYTES = 1 << 24   # of components in one shard
INDEX = ("dim int, block int, ids binary, starts binary, nodes binary, levels array<binary>, links array<binary>")


def _smallest(distances: np.ndarray, k: int) -> np.ndarray:
    """Per row the places of the k smallest distances, in ascending order."""
    if distances.shape[1] > k:
        near = np.argpartition(distances, k - 1, axis=1)[:, :k]
        return np.take_along_axis(near, np.argsort(np.take_along_axis(distances, near, 1), axis=1, kind="stable"), 1)
    return np.argsort(distances, axis=1, kind="stable")


@dataclass
class Graph:
    """Nodes are numbered with the upper levels first, so the nodes of level l are the first ``sizes[l]`` numbers."""

    vectors: np.ndarray        # [node, dim + 1], equally long
    links: list[np.ndarray]    # per level [node, places]; -1 is no link
    sizes: list[int]

    def distances(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each point to its own row of nodes; infinite for node -1."""
        found = self.vectors[nodes]
        out = 2.0 * (self._square - np.matmul(found, points[:, :, None])[:, :, 0])
        out[nodes < 0] = np.inf
        return out

    def __post_init__(self):
        self._square = float(np.square(self.vectors[0]).sum()) if len(self.vectors) else 0.0

    def beam(self, points: np.ndarray, level: int, entry: np.ndarray, width: int, known: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, distances) [point, width]: the nearest nodes met from ``entry`` [point, any], nearest first.

        ``known``: nodes with greater numbers aren't linked yet.
        """
        links, rows = self.links[level], np.arange(len(points))[:, None]
        seen = np.zeros((len(points), known + 1), dtype=bool)  # the last place takes what isn't a node
        seen[:, known] = True
        seen[rows, entry] = True
        seen[:, known] = True
        nodes, distances = entry, self.distances(points, entry)
        order = _smallest(distances, width)
        nodes, distances = np.take_along_axis(nodes, order, 1), np.take_along_axis(distances, order, 1)
        open_ = nodes >= 0
        active = np.arange(len(points))
        step = max(1, min(EXPANDED, width))
        while len(active):
            # the nearest unexpanded nodes of each beam; a beam is done when it has none
            waiting = np.where(open_[active], distances[active], np.inf)
            chosen = _smallest(waiting, step)
            usable = np.take_along_axis(waiting, chosen, 1) < np.inf
            going = usable.any(axis=1)
            active, chosen, usable = active[going], chosen[going], usable[going]
            if not len(active):
                break
            at = active[:, None]
            open_[at, chosen] = False
            near = np.where(usable[:, :, None], links[np.where(usable, nodes[at, chosen], 0)], -1).reshape(len(active), -1)
            near = np.where(seen[at, near], -1, near)
            # a node that several expanded nodes link to is new only once
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            seen[at, near] = True
            seen[:, known] = True
            fresh = self.distances(points[active], near)
            all_nodes = np.concatenate([nodes[active], near], axis=1)
            all_distances = np.concatenate([distances[active], fresh], axis=1)
            all_open = np.concatenate([open_[active], near >= 0], axis=1)
            order = _smallest(all_distances, width)
            if nodes.shape[1] < order.shape[1]:
                more = order.shape[1] - nodes.shape[1]
                nodes = np.pad(nodes, ((0, 0), (0, more)), constant_values=-1)
                distances = np.pad(distances, ((0, 0), (0, more)), constant_values=np.inf)
                open_ = np.pad(open_, ((0, 0), (0, more)))
            nodes[active] = np.take_along_axis(all_nodes, order, 1)
            distances[active] = np.take_along_axis(all_distances, order, 1)
            open_[active] = np.take_along_axis(all_open, order, 1)
        return nodes, distances

    def descend(self, points: np.ndarray, to: int, known: list[int]) -> np.ndarray:
        """Entry nodes [point, 1] of level ``to`` by greedy steps through the levels above it."""
        entry = np.zeros((len(points), 1), dtype=np.int64)
        for level in range(len(self.links) - 1, to, -1):
            if known[level]:
                entry = self.beam(points, level, entry, 1, known[level])[0][:, :1]
        return entry

    def search(self, points: np.ndarray, width: int) -> np.ndarray:
        """Nodes [point, at most width], nearest first; -1 where there are fewer."""
        out = []
        for at in range(0, len(points), BATCH):
            part = points[at:at + BATCH]
            out.append(self.beam(part, 0, self.descend(part, 0, self.sizes), width, self.sizes[0])[0])
        most = max(o.shape[1] for o in out)
        return np.concatenate([np.pad(o, ((0, 0), (0, most - o.shape[1])), constant_values=-1) for o in out])


def _spread(graph: Graph, points: np.ndarray, nodes: np.ndarray, distances: np.ndarray, places: int) -> np.ndarray:
    """Links [point, places]: nearest first, each nearer to the point than to any link before it; then the nearest others."""
    order = np.argsort(distances, axis=1, kind="stable")
    nodes, distances = np.take_along_axis(nodes, order, 1), np.take_along_axis(distances, order, 1)
    found = graph.vectors[nodes]
    between = 2.0 * (graph._square - np.matmul(found, found.transpose(0, 2, 1)))
    kept = np.zeros(nodes.shape, dtype=bool)
    real = np.isfinite(distances)
    for i in range(nodes.shape[1]):
        blocked = (kept[:, :i] & (between[:, i, :i] < distances[:, i, None])).any(axis=1)
        kept[:, i] = real[:, i] & ~blocked & (kept[:, :i].sum(axis=1) < places)
    rank = np.where(kept, 0, np.where(real, 1, 2))
    first = np.argsort(rank, axis=1, kind="stable")[:, :places]
    out = np.where(np.take_along_axis(real, first, 1), np.take_along_axis(nodes, first, 1), -1)
    return np.pad(out, ((0, 0), (0, places - out.shape[1])), constant_values=-1) if out.shape[1] < places else out


def _link_back(graph: Graph, level: int, new: np.ndarray, links: np.ndarray) -> None:
    """Answer the links of nodes ``new`` by links back; a node with too many keeps those that point in different directions."""
    table = graph.links[level]
    places = table.shape[1]
    sources, targets = np.repeat(new, links.shape[1]), links.ravel()
    real = targets >= 0
    sources, targets = sources[real], targets[real]
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    changed, starts, counts = np.unique(targets, return_index=True, return_counts=True)
    column = np.arange(len(targets)) - np.repeat(starts, counts)
    added = np.full((len(changed), int(counts.max(initial=0))), -1, dtype=np.int64)
    added[np.repeat(np.arange(len(changed)), counts), column] = sources
    own = table[changed]
    added[(added[:, :, None] == own[:, None, :]).any(axis=2)] = -1
    # rows with room, then rows that must choose
    free = (own < 0).sum(axis=1)
    wanted = (added >= 0).sum(axis=1)
    both = np.concatenate([own, added], axis=1)
    fits = np.flatnonzero(wanted <= free)
    packed = np.argsort(both[fits] < 0, axis=1, kind="stable")[:, :places]
    table[changed[fits]] = np.take_along_axis(both[fits], packed, 1)
    tight = np.flatnonzero(wanted > free)
    for at in range(0, len(tight), BATCH):
        part = tight[at:at + BATCH]
        points = graph.vectors[changed[part]]
        near = both[part]
        distances = graph.distances(points, near)
        # of very many candidates the nearest are enough to choose from
        closest = _smallest(distances, min(near.shape[1], 3 * places))
        near, distances = np.take_along_axis(near, closest, 1), np.take_along_axis(distances, closest, 1)
        table[changed[part]] = _spread(graph, points, near, distances, places)


def build(vectors: np.ndarray, seed: int = 11, links: int = LINKS, beam: int = BEAM_BUILD) -> tuple[Graph, np.ndarray]:
    """(graph, order): the graph of distinct ``vectors`` [n, dim], whose node i is vector ``order[i]``."""
    rng = np.random.default_rng(seed)
    level_of = np.minimum((-np.log(rng.random(len(vectors))) / np.log(links)).astype(int), 12)
    order = np.argsort(-level_of, kind="stable")
    own = vectors[order].astype(np.float64)
    squares = np.square(own).sum(axis=1)
    longest = squares.max(initial=0.0)
    # one length for all, and at most 1, whatever the scale of the input
    scale = 1.0 / np.sqrt(longest) if longest > 0 else 1.0
    rest = np.sqrt(np.maximum(longest - squares, 0.0))
    whole = (np.concatenate([own, rest[:, None]], axis=1) * scale).astype(np.float32)
    top = int(level_of.max(initial=0))
    sizes = [int((level_of >= level).sum()) for level in range(top + 1)]
    tables = [np.full((sizes[level], links * (2 if level == 0 else 1)), -1, dtype=np.int64) for level in range(top + 1)]
    graph = Graph(whole, tables, sizes)
    for level in range(top, -1, -1):
        done, table = 0, tables[level]
        places = table.shape[1]
        while done < sizes[level]:
            new = np.arange(done, min(sizes[level], done + (BATCH if done >= BATCH else max(64, done))))
            points = whole[new]
            # earlier nodes of the same batch
            inside = 2.0 * (graph._square - points @ points.T)
            inside[np.triu_indices(len(new))] = np.inf
            near_new = _smallest(inside, min(beam, len(new)))
            nodes, distances = new[near_new], np.take_along_axis(inside, near_new, 1)
            if done:
                # the nodes of the upper levels come first here as well; until they are all linked, the beam starts from the first
                upper = level < top and done >= sizes[level + 1]
                entry = graph.descend(points, level, sizes) if upper else np.zeros((len(new), 1), dtype=np.int64)
                met, apart = graph.beam(points, level, entry, beam, done)
                nodes, distances = np.concatenate([met, nodes], axis=1), np.concatenate([apart, distances], axis=1)
            distances = np.where(nodes < 0, np.inf, distances)
            closest = _smallest(distances, min(beam, nodes.shape[1]))
            nodes, distances = np.take_along_axis(nodes, closest, 1), np.take_along_axis(distances, closest, 1)
            chosen = _spread(graph, points, nodes, distances, places)
            table[new] = chosen
            _link_back(graph, level, new, chosen)
            done += len(new)
    return graph, order


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v, dim, key): rows that take part, equal rows once. Zero vectors have no direction and take no part."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    own = vb.distinct_rows(rows, doubles).filter(F.exists("v", lambda x: x != 0))
    return vb.with_key(own)


def index(own: DataFrame, shard_bytes: int = SHARD_BYTES, least: int = vb.LEAST_BLOCKS) -> tuple[DataFrame, int]:
    """(INDEX table, number of shards) over ``usable`` rows; one row per shard and dimension, staged in the shared folder."""
    number = vb.number_of_blocks(own, shard_bytes, least)

    def make(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        dim = table.column("dim")[0].as_py()
        vectors = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
        distinct, node_of = np.unique(vectors, axis=0, return_inverse=True)
        graph, order = build(distinct)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        node_of = place[node_of.ravel()]
        by_node = np.lexsort((ids, node_of))
        starts = np.searchsorted(node_of[by_node], np.arange(len(order) + 1))
        blob = lambda a, kind: a.astype(kind).tobytes()
        row = {"dim": dim, "block": table.column("block")[0].as_py(), "ids": blob(ids[by_node], np.int64),
               "starts": blob(starts, np.int32), "nodes": blob(distinct[order], np.float64),
               "levels": [blob(np.array([n]), np.int32) for n in graph.sizes], "links": [blob(t, np.int32) for t in graph.links]}
        return pa.Table.from_pylist([row], schema=_INDEX)

    dealt = own.withColumn("block", F.pmod(F.xxhash64("vec_id", "key"), F.lit(number)).cast("int"))
    return staged(dealt.select("dim", "block", "vec_id", "v").groupBy("dim", "block").applyInArrow(make, INDEX), "graphs"), number


class Shard:
    """One row of the index, ready to be searched."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.ids = vb.longs(row["ids"])
        self.starts = np.frombuffer(row["starts"], dtype=np.int32)
        self.nodes = np.frombuffer(row["nodes"], dtype=np.float64).reshape(-1, dim)
        sizes = [int(np.frombuffer(b, dtype=np.int32)[0]) for b in row["levels"]]
        links = [np.frombuffer(b, dtype=np.int32).reshape(n, -1).astype(np.int64) for b, n in zip(row["links"], sizes)]
        squares = np.square(self.nodes).sum(axis=1)
        longest = squares.max()
        self.scale = 1.0 / np.sqrt(longest)
        rest = np.sqrt(np.maximum(longest - squares, 0.0))
        whole = (np.concatenate([self.nodes, rest[:, None]], axis=1) * self.scale).astype(np.float32)
        self.graph = Graph(whole, links, sizes)

    def nearest(self, queries: np.ndarray, own: np.ndarray, k: int, width: int):
        """(query number, vec_id, score) of the k nearest rows other than the query's own, by exact double scores."""
        length = np.sqrt(np.square(queries).sum(axis=1, keepdims=True))
        points = np.concatenate([queries / length, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        # the query's own node may take one place
        nodes = self.graph.search(points, max(width, 2 * k) + 1)
        for i in range(len(queries)):
            met = nodes[i][nodes[i] >= 0]
            scores = np.array([float(np.dot(queries[i], self.nodes[n])) for n in met]) if len(met) < 8 else self.nodes[met] @ queries[i]
            rows = []
            least = np.sort(scores)[::-1][min(k, len(scores) - 1)]  # k + 1 nodes: one may hold the query alone
            for n in np.flatnonzero(scores >= least):
                members = self.ids[self.starts[met[n]]:self.starts[met[n] + 1]]
                # members ascend; equal ids are distinct rows of other shards or keys
                members = members[members != own[i]] if len(members) <= k + 1 else _without(members, own[i], k)
                rows += [(-float(scores[n]), int(m)) for m in members[:k]]
            rows.sort()
            yield from ((i, m, -s) for s, m in rows[:k])


def _without(members: np.ndarray, own: int, k: int) -> np.ndarray:
    first = members[:4 * k + 1]
    kept = first[first != own]
    return kept if len(kept) >= k else members[members != own]


def nearest(rows: DataFrame, is_query: Column, k: int = 20, beam: int = BEAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, by inner product in double precision.

    ``rows``: vec_id bigint, embedding array of numbers, and what ``is_query`` reads; further columns are ignored. Rows with
    a null vec_id or vector, a null or non-finite component or a zero vector take no part. Equal rows count once; rows
    that share only the vec_id are rows of their own and not each other's neighbours, and a query id on several such rows ranks the hits of all
    together. Vectors meet their own dimension only. Ties go to the smaller vec_id. No queries or rows give no rows.
    Every row is indexed; with fewer than k candidates all reachable ones are returned.
    """
    own = staged(usable(rows), "vectors")
    graphs, number = index(own, shard_bytes)
    queries = usable(rows.filter(is_query))
    parts = vb.number_of_blocks(queries, vb.QUERY_BYTES, 1)

    def search(row: dict):
        asked = vb.longs(row["q_ids"])
        shard = Shard(row)
        points = np.frombuffer(row["q_vectors"], dtype=np.float64).reshape(len(asked), row["dim"])
        for i, vec_id, score in shard.nearest(points, asked, k, beam):
            yield int(asked[i]), vec_id, score

    met = vb.meetings(vb.packed(queries, parts), graphs, number)
    found = met.mapInArrow(vb.per_row(search, _HIT), "query_id bigint, vec_id bigint, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_HIT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_INDEX = pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("starts", pa.binary()), ("nodes", pa.binary()),
                    ("levels", pa.list_(pa.binary())), ("links", pa.list_(pa.binary()))])
