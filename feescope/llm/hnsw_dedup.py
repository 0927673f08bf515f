"""Near-duplicate embeddings by hierarchical navigable small-world graphs.

Vectors of one label are dealt to shards of about ``shard_rows`` rows by hash,
and each shard gets a graph.  Every vector is searched in every shard of its
label for vectors with a cosine of at least ``threshold``; candidates are
verified in double precision, links counted and united into components.

Beams.  A search keeps its ``beam`` nearest nodes.  If all of them are links
there may be more, so that search runs again with twice the beam, and beyond
``scan_beam`` it compares the whole shard.  Every block of queries is audited with
links that are known: ``AUDIT_LINKS`` nodes of the shard are turned away to a cosine
just above the threshold and searched for (so the audit holds links however rare
true ones are), and a sixteenth of the queries is compared with brute force, hits of
a vector on itself left out.  While less than ``recall`` of either kind is found, the
block is searched again with twice the beam; only if the widest fails is the block
compared whole.  Two shards meet in one task that
searches both ways; a link counts for both ends when either search finds it.  A task
marks the links of two shards in a matrix of one byte a pair, which no density of
links makes larger, and counts and unites them there.

Copies.  Equal vectors of one label are one node with a count, so a vector
that a third of all rows share adds nothing to the graph.  A task returns one
row per node (its number of links and one edge of a spanning forest), never
the pairs.

Defined cases: null, empty, zero and non-finite vectors and rows without a
label link with nothing and are components of their own; vectors of different
lengths never link; repeated ids each give a row, and count as other vectors;
an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feescope.llm.ann_search import usable
from feescope.llm.common import connected_components, ship_code
from feescope.session import materialize

SHARD_ROWS = 8192
LINKS = 16       # neighbours a node chooses; twice as many are kept on the lowest layer
BEAM = 48
SCAN_BEAM = 512
EXPAND = 4       # nodes expanded at once per search
RECALL = 0.99
AUDIT_LINKS = 256
AUDIT_SHARE = 16


# ---------------------------------------------------------------- graph

def unit_rows(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow in the norm
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


class Layer:
    """One graph: node numbers of the shard, rows of neighbours (-1: none)."""

    def __init__(self, nodes: int, degree: int):
        self.near = np.full((nodes, degree), -1, np.int32)

    def search(self, x: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities), each (queries, beam), nearest first, from the entries (queries, any)."""
        n, rows = len(q), np.arange(len(q))[:, None]
        seen = np.zeros((n, len(x) + 1), bool)
        seen[:, -1] = True  # of the absent node -1
        entry = np.where(np.triu(entry[:, :, None] == entry[:, None, :], 1).any(1), -1, entry)  # first of equal ones
        ids = np.full((n, max(beam, entry.shape[1])), -1, np.int32)
        ids[:, :entry.shape[1]] = entry
        seen[rows, entry] = True
        sim = np.where(ids >= 0, np.einsum("nkd,nd->nk", x[ids], q), -np.inf).astype(np.float32)
        done = ids < 0
        while True:
            order = np.argsort(-sim, axis=1, kind="stable")[:, :beam]
            ids, sim, done = ids[rows, order], sim[rows, order], done[rows, order]
            active = np.nonzero(~done.all(1))[0]
            if not len(active):
                return ids, sim
            first = np.argsort(done[active], axis=1, kind="stable")[:, :EXPAND]
            a = active[:, None]
            pick = np.where(done[a, first], -1, ids[a, first])
            done[a, first] = True
            new = np.where(pick[:, :, None] >= 0, self.near[pick], -1).reshape(len(active), -1)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new = np.where(seen[a, new], -1, new)
            seen[a, new] = True
            got = np.where(new >= 0, np.einsum("nkd,nd->nk", x[new], q[active]), -np.inf).astype(np.float32)
            wide = new.shape[1]
            ids = np.concatenate((ids, np.full((n, wide), -1, np.int32)), 1)
            sim = np.concatenate((sim, np.full((n, wide), -np.inf, np.float32)), 1)
            done = np.concatenate((done, np.ones((n, wide), bool)), 1)
            ids[active, -wide:], sim[active, -wide:], done[active, -wide:] = new, got, new < 0

    def connect(self, x: np.ndarray, batch: np.ndarray, ids: np.ndarray, sim: np.ndarray, choose: int) -> None:
        """Link the nodes of ``batch`` with a spread choice of their candidates, both ways."""
        keep = spread_choice(x, ids, sim, choose)
        chosen = np.where(keep, ids, -1)
        width = self.near.shape[1]
        order = np.argsort(chosen < 0, axis=1, kind="stable")[:, :width]
        mine = np.take_along_axis(chosen, order, 1)
        self.near[batch, :mine.shape[1]] = mine
        r, c = np.nonzero(keep)
        target, source, s = ids[r, c], batch[r], sim[r, c]
        order = np.lexsort((-s, target))
        target, source, s = target[order], source[order], s[order]
        heads, start, count = np.unique(target, return_index=True, return_counts=True)
        rank = np.arange(len(target)) - np.repeat(start, count)
        fits = rank < width  # of the new links of one node the nearest ``width`` are considered
        new = np.full((len(heads), min(width, int(count.max(initial=1)))), -1, np.int32)
        new[np.repeat(np.arange(len(heads)), count)[fits], rank[fits]] = source[fits]
        all_ids = np.concatenate((self.near[heads], new), 1)
        over = (all_ids >= 0).sum(1) > width
        order = np.argsort(all_ids < 0, axis=1, kind="stable")
        self.near[heads[~over]] = np.take_along_axis(all_ids, order, 1)[~over, :width]
        for lo in range(0, int(over.sum()), 256):
            h = np.nonzero(over)[0][lo:lo + 256]
            cand = all_ids[h]
            sims = np.where(cand >= 0, np.einsum("nkd,nd->nk", x[cand], x[heads[h]]), -np.inf)
            order = np.argsort(-sims, axis=1, kind="stable")
            cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
            keep = spread_choice(x, cand, sims, width)
            kept = np.where(keep, cand, -1)
            self.near[heads[h]] = np.take_along_axis(kept, np.argsort(kept < 0, axis=1, kind="stable"), 1)[:, :width]


def spread_choice(x: np.ndarray, ids: np.ndarray, sim: np.ndarray, choose: int) -> np.ndarray:
    """Mask of up to ``choose`` candidates per row (nearest first): first those nearer to the
    node than to any chosen one, then the nearest others."""
    n, k = ids.shape
    v = x[ids]
    between = np.matmul(v, v.transpose(0, 2, 1))
    keep = np.zeros((n, k), bool)
    closest = np.full((n, k), -np.inf, np.float32)
    left = np.full(n, choose)
    for j in range(k):
        ok = (ids[:, j] >= 0) & (closest[:, j] < sim[:, j]) & (left > 0)
        keep[:, j] = ok
        left -= ok
        np.maximum(closest, between[:, j], out=closest, where=ok[:, None])
    rest = (ids >= 0) & ~keep
    keep |= rest & (np.cumsum(rest, axis=1) <= left[:, None])
    return keep


class Graph:
    """A shard's layers, lowest first, over unit vectors in single precision."""

    def __init__(self, x: np.ndarray, links: int = LINKS, beam: int = BEAM, batch: int = 256, seed: int = 7):
        self.x = x.astype(np.float32)
        n = len(x)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(links)).astype(int)
        self.order = np.argsort(-level, kind="stable").astype(np.int32)  # higher nodes first
        sizes = [int((level >= k).sum()) for k in range(level.max(initial=0) + 1)]
        while len(sizes) > 1 and sizes[-1] < links:
            sizes.pop()
        self.layers: list[Layer] = []
        self.top = self.order[:min(sizes[-1], 4 * links)] if n else self.order
        for k in range(len(sizes) - 1, -1, -1):
            layer = Layer(n, links if k else 2 * links)
            nodes = self.order[:sizes[k]]
            for lo in range(0, len(nodes), batch):
                b = nodes[lo:lo + batch]
                within = self.x[b] @ self.x[b].T
                np.fill_diagonal(within, -np.inf)
                near = np.argsort(-within, axis=1, kind="stable")[:, :links]
                ids, sim = b[near], np.take_along_axis(within, near, 1)
                if lo:
                    found, s = layer.search(self.x, self.x[b], self.entries(self.x[b], nodes[:lo]), beam)
                    ids, sim = np.concatenate((ids, found), 1), np.concatenate((sim, s), 1)
                ids = np.where(np.isfinite(sim), ids, -1)
                order = np.argsort(-sim, axis=1, kind="stable")
                layer.connect(self.x, b, np.take_along_axis(ids, order, 1).astype(np.int32),
                              np.take_along_axis(sim, order, 1).astype(np.float32), links)
            self.layers.insert(0, layer)

    def entries(self, q: np.ndarray, inserted: np.ndarray | None = None) -> np.ndarray:
        """Entry nodes for the layer below those built so far (all of its first nodes are in it)."""
        top = self.top if inserted is None else self.top[:len(inserted)]
        entry = top[np.argsort(-(q @ self.x[top].T), axis=1, kind="stable")[:, :4]]
        for layer in reversed(self.layers if inserted is not None else self.layers[1:]):
            found, _ = layer.search(self.x, q, entry, 8)
            entry = np.where(found >= 0, found, entry[:, :1])[:, :4]
        if inserted is not None:  # a node of the layer above may not be in this one yet
            known = np.zeros(len(self.x), bool)
            known[inserted] = True
            entry = np.where(known[entry], entry, inserted[0])
        return entry

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        return self.layers[0].search(self.x, q, self.entries(q), beam)


# ---------------------------------------------------------------- links between a block of queries and a shard

def _scan(x: np.ndarray, q: np.ndarray, least: float) -> list[np.ndarray]:
    s = q @ x.T
    return [np.nonzero(r >= least)[0] for r in s]


def planted_queries(unit: np.ndarray, nodes: np.ndarray, threshold: float, seed: int = 11) -> np.ndarray:
    """Unit rows whose cosine with the given nodes lies a twentieth of the way from the threshold to 1."""
    c = threshold + (1 - threshold) / 20
    x = unit[nodes]
    away = np.random.default_rng(seed).normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    length = np.sqrt((away * away).sum(1, keepdims=True))
    away = np.divide(away, length, out=np.zeros_like(away), where=length > 1e-9)  # one component: no way to turn
    return unit_rows(c * x + np.sqrt(1 - c * c) * away)


def _searched(graph: Graph, q: np.ndarray, least: float, beam: int, rows: int) -> Iterator[tuple[int, np.ndarray]]:
    """(query, nodes found for it); a full beam of hits is searched again with twice the beam."""
    todo, width = np.arange(len(q)), beam
    while len(todo):
        full = []
        for lo in range(0, len(todo), rows):
            part = todo[lo:lo + rows]
            if width >= min(len(graph.x), SCAN_BEAM):
                yield from zip(part.tolist(), _scan(graph.x, q[part], least))
                continue
            ids, sim = graph.search(q[part], width)
            hit = (sim >= least) & (ids >= 0)
            again = hit.all(1)
            full.append(part[again])
            for i in np.nonzero(~again)[0].tolist():
                yield int(part[i]), ids[i][hit[i]].astype(np.int64)
        todo, width = (np.concatenate(full) if full else todo[:0]), 2 * width


class LinkRows:
    """The nodes linked to each query, held as one byte a pair of a block: dense blocks take no more than sparse ones."""

    def __init__(self, linked: np.ndarray):
        self.linked = linked

    def __len__(self) -> int:
        return len(self.linked)

    def __getitem__(self, i: int) -> np.ndarray:
        return np.nonzero(self.linked[i])[0]


def find_links(graph: Graph, unit: np.ndarray, q: np.ndarray, threshold: float, beam: int = BEAM,
               recall: float = RECALL, rows: int = 256, own: np.ndarray | None = None,
               audit_links: int = AUDIT_LINKS, report: list | None = None) -> Sequence[np.ndarray]:
    """For each query (unit rows, double) the nodes with a cosine of at least ``threshold``.

    ``own`` is each query's own node (-1: none); a hit on it is no link of the audit.
    ``report`` gets (beam, planted recall, recall of the sample or None) of every try.
    """
    least = threshold - 1e-5  # single precision; verified below
    q32 = q.astype(np.float32)
    n = len(graph.x)
    if not n or not len(q):
        return [np.zeros(0, np.int64)] * len(q)

    def verified(i: int, ids: np.ndarray) -> np.ndarray:
        return ids[unit[ids] @ q[i] >= threshold] if len(ids) else ids

    spread = np.random.default_rng(len(q)).permutation(len(q))[:-(-len(q) // AUDIT_SHARE)]
    audited = np.nonzero(own[spread] >= 0)[0] if own is not None else spread[:0]

    def counted(linked: np.ndarray) -> int:
        """Links of the audited queries, hits on themselves left out."""
        return int(linked.sum()) - (int(linked[audited, own[spread[audited]]].sum()) if len(audited) else 0)

    truth = np.zeros((len(spread), n), bool)
    for lo in range(0, len(spread), rows):
        part = spread[lo:lo + rows]
        for k, ids in enumerate(_scan(graph.x, q32[part], least)):
            truth[lo + k, verified(part[k], ids)] = True
    want = counted(truth)
    nodes = np.random.default_rng(n).permutation(n)[:audit_links]
    planted = planted_queries(unit, nodes, threshold).astype(np.float32)
    while True:
        hits = sum(int((ids == nodes[i]).any()) for i, ids in _searched(graph, planted, least, beam, rows))
        share, real = hits / len(nodes), None
        if share >= recall or beam >= n:  # else the queries need not be searched with this beam
            linked = np.zeros((len(q), n), bool)
            for i, ids in _searched(graph, q32, least, beam, rows):
                linked[i, verified(i, ids)] = True
            real = counted(linked[spread] & truth) / want if want else None
        if report is not None:
            report.append((beam, share, real))
        if (share >= recall and (real is None or real >= recall)) or beam >= n:
            linked[spread] = truth
            return LinkRows(linked)
        beam *= 2


def cell_matrix(left: Graph, left_unit: np.ndarray, right: Graph, right_unit: np.ndarray, threshold: float, beam: int = BEAM,
                recall: float = RECALL, same: bool = False) -> np.ndarray:
    """Which (left node, right node) of two shards are linked, by the search from either side;
    within one shard (``same``) each link stands there both ways and none is a node's own."""
    linked = np.zeros((len(left_unit), len(right_unit)), bool)
    own = np.arange(len(left_unit)) if same else None
    for i, ids in enumerate(find_links(right, right_unit, left_unit, threshold, beam, recall, own=own)):
        linked[i, ids] = True
    if same:
        linked |= linked.T.copy()
        np.fill_diagonal(linked, False)
    else:
        for i, ids in enumerate(find_links(left, left_unit, right_unit, threshold, beam, recall)):
            linked[ids, i] = True
    return linked


def cell_links(left: Graph, left_unit: np.ndarray, right: Graph, right_unit: np.ndarray, threshold: float, beam: int = BEAM,
               recall: float = RECALL, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(left nodes, right nodes) of the links between two shards (:func:`cell_matrix` as pairs)."""
    return np.nonzero(cell_matrix(left, left_unit, right, right_unit, threshold, beam, recall, same))


def link_counts(linked: np.ndarray, copies: np.ndarray, copies2: np.ndarray, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Linked vectors of each left and each right node, copies counted."""
    left, right = np.zeros(len(copies), np.int64), np.zeros(len(copies2), np.int64)
    for lo in range(0, len(copies), rows):
        part = linked[lo:lo + rows].astype(np.int64)
        left[lo:lo + rows] = part @ copies2
        right += copies[lo:lo + rows] @ part
    return left, right


def forest(linked: np.ndarray, nodes: np.ndarray, nodes2: np.ndarray, same: bool, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of every node that has a link.

    Breadth first from both sides; each row and each column of the matrix is read once.
    """
    seen = np.zeros(len(nodes), bool)
    seen2 = seen if same else np.zeros(len(nodes2), bool)
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in np.nonzero(linked.any(1))[0].tolist():
        if seen[start]:
            continue
        seen[start] = True
        fresh, members = np.array([start]), [nodes[[start]]]
        while len(fresh):
            reached = np.zeros(len(nodes2), bool)
            for lo in range(0, len(fresh), rows):
                reached |= linked[fresh[lo:lo + rows]].any(0)
            fresh = np.nonzero(reached & ~seen2)[0]
            seen2[fresh] = True
            members.append(nodes2[fresh])
            if same:
                continue
            reached = np.zeros(len(nodes), bool)
            for lo in range(0, len(fresh), rows):
                reached |= linked[:, fresh[lo:lo + rows]].any(1)
            fresh = np.nonzero(reached & ~seen)[0]
            seen[fresh] = True
            members.append(nodes[fresh])
        whole = np.concatenate(members)
        u.append(whole)
        v.append(np.full(len(whole), whole.min()))
    return np.concatenate(u), np.concatenate(v)


# ---------------------------------------------------------------- Spark

def _build(links: int, beam: int):
    def build(key, pdf):
        pdf = pdf.sort_values("node")
        x = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        graph = Graph(unit_rows(x), links, beam)
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "shard": [key[2]], "shards": [int(pdf["shards"].iloc[0])],
                             "nodes": [pdf["node"].to_numpy(np.int64).tobytes()],
                             "copies": [pdf["copies"].to_numpy(np.int64).tobytes()], "vectors": [x.tobytes()],
                             "graph": [pickle.dumps((graph.order, graph.top, [y.near for y in graph.layers]))]})
    return build


def _load(x: np.ndarray, state: bytes) -> Graph:
    g = Graph.__new__(Graph)
    g.x = x.astype(np.float32)
    g.order, g.top, near = pickle.loads(state)
    g.layers = []
    for a in near:
        layer = Layer(0, 1)
        layer.near = a
        g.layers.append(layer)
    return g


def _links(threshold: float, beam: int, recall: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                dim, same, *sides = (c[i].as_py() for c in b.columns)
                shard = []
                for nodes, copies, vec, state in (sides[:4], sides[4:]):
                    unit = unit_rows(np.frombuffer(vec).reshape(-1, dim))
                    shard.append((np.frombuffer(nodes, np.int64), np.frombuffer(copies, np.int64), unit, _load(unit, state)))
                (nodes, copies, unit, graph), (nodes2, copies2, unit2, graph2) = shard
                linked = cell_matrix(graph, unit, graph2, unit2, threshold, beam, recall, same)
                counts = link_counts(linked, copies, copies2)
                held, n_links = ([nodes], [counts[0]]) if same else ([nodes, nodes2], [*counts])
                u, v = forest(linked, nodes, nodes2, same)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((*held, u))), pa.array(np.concatenate((*n_links, np.zeros(len(u), np.int64)))),
                     pa.array(np.concatenate((*held, v)))], names=["node", "n_links", "root"])
    return run


def near_duplicates(rows: DataFrame, threshold: float = 0.93, shard_rows: int = SHARD_ROWS, links: int = LINKS,
                    beam: int = BEAM, recall: float = RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.  ``rows`` has vec_id, embedding, label."""
    ship_code(rows.sparkSession)
    key = ["label", "h1", "h2"]  # label and 128 hash bits of the vector stand for it
    vector = F.col("embedding").cast("array<double>")
    rows = rows.select("vec_id", "label", vector.alias("embedding")).withColumns({
        "ok": usable() & F.col("label").isNotNull(), "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})
    nodes = rows.where("ok").groupBy(*key).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("vector"))
    nodes = materialize(nodes.withColumns({"node": F.xxhash64(*key), "dim": F.size("vector")}), "hnsw-nodes")
    shards = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(shard_rows)).alias("shards"))
    dealt = nodes.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.col("node"), F.col("shards")))
    label = nodes.schema["label"].dataType.simpleString()
    graphs = materialize(
        dealt.select("label", "dim", "shard", "shards", "node", "copies", "vector").groupBy("label", "dim", "shard").applyInPandas(
            _build(links, beam), f"label {label}, dim int, shard long, shards long, nodes binary, copies binary, "
                                 "vectors binary, graph binary"), "hnsw-graphs")
    # every two shards of a label meet once, and each shard itself
    parts = ("nodes", "copies", "vectors", "graph")
    other = graphs.select("label", "dim", "shard", *(F.col(c).alias(f"{c}_2") for c in parts))
    asked = graphs.select("label", "dim", F.col("shard").alias("first"), *parts,
                          F.explode(F.sequence(F.col("shard"), F.col("shards") - 1)).alias("shard"))
    cells = asked.join(other, ["label", "dim", "shard"]).select(
        "dim", (F.col("first") == F.col("shard")).alias("same"), *parts, *(f"{c}_2" for c in parts))
    found = materialize(cells.mapInArrow(_links(threshold, beam, recall), "node long, n_links long, root long"), "hnsw-links")
    roots = connected_components(found.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")), "hnsw")
    known = nodes.join(found.groupBy("node").agg(F.sum("n_links").alias("n_links")), "node").join(roots, "node", "left").select(
        *key, "least", "copies", "n_links", F.coalesce("root", "node").alias("root"))
    known = materialize(known, "hnsw-known")
    component = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(component, "root").select(*key, (F.col("n_links") + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.where("ok").select("vec_id", *key).join(known, key).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
