"""Near-duplicates of embeddings: small-world graphs per shard, every shard queried.

Vectors of one label are dealt over shards of bounded size, each with a graph of its own. Blocks of
queries visit every shard of their label. Within a visit a sample of the queries is audited against
all vectors of the shard: a beam that misses one of their nearest other nodes, however far these are,
or a link gives way to comparing all vectors. Found pairs are verified by cosine in double precision. A visit returns link counts and a spanning forest of its
links, so a group of any size yields rows in proportion to its vectors, not to its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexflume.llm.hnsw import LINKS, Graph, levels_of
from lexflume.llm.relations import attach, connected
from lexflume.session import stored

# Vectors per graph at most (on average, by hash), and queries per visit.
SHARD_ROWS = 65_536
BLOCK_ROWS = 2_048
# Queries audited per visit, nearest other nodes each must find, and the beam.
AUDITED = 64
NEAREST = 10
BEAM = 32
# A beam of 1/WIDEST of the nodes costs more than comparing all of them.
WIDEST = 4


def _units(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)


def build_shard(rows: pa.Table) -> pa.Table:
    """Index rows of one shard: its vectors by falling level, with their links in every layer."""
    keys = rows.column("vec_id").to_numpy()
    vectors = _matrix(rows.column("embedding"))
    levels = levels_of(keys)
    order = np.lexsort((keys, -levels))
    graph = Graph.built(_units(vectors[order]), levels[order])
    linked = [
        np.concatenate([layer[i] for layer in graph.layers[: int(levels[k]) + 1]]).astype(np.int32).tobytes()
        for i, k in enumerate(order)
    ]
    return pa.table({
        "shard": pa.array([rows.column("shard")[0].as_py()] * len(order), pa.string()),
        "at": pa.array(np.arange(len(order))),
        "vec_id": pa.array(keys[order]),
        "embedding": rows.column("embedding").combine_chunks().take(pa.array(order)),
        "level": pa.array(levels[order]),
        "links": pa.array(linked, pa.binary()),
    })


def _graph(index: pa.Table) -> tuple[Graph, np.ndarray, np.ndarray]:
    """Graph, vec_ids and vectors of a shard's index rows."""
    index = index.sort_by("at")
    vectors = _matrix(index.column("embedding"))
    levels = index.column("level").to_numpy()
    packed = [np.frombuffer(b, np.int32).astype(np.int64) for b in index.column("links").to_pylist()]
    layers = []
    for level in range(int(levels[0]) + 1):
        begin = 0 if level == 0 else LINKS * (level + 1)
        width = LINKS * (2 if level == 0 else 1)
        layers.append(np.stack([p[begin : begin + width] for p in packed[: int((levels >= level).sum())]]))
    return Graph(_units(vectors), levels, layers), index.column("vec_id").to_numpy(), vectors


def audited_links(graph: Graph, vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, least: float) -> list[np.ndarray]:
    """Nodes whose cosine with each query is ``least`` or more, in double precision.

    The beam's finds count when the audited queries miss neither a link nor one of their NEAREST other
    nodes that a scan of all nodes finds, so a shard without links gives evidence too. Else the scan,
    the widest beam there is and by measurement cheaper than a wider one, answers the whole block.
    """
    units, lengths = _units(queries), np.linalg.norm(vectors, axis=1)

    def verified(found: list[np.ndarray], of: np.ndarray) -> list[np.ndarray]:
        out = []
        for q, nodes in zip(of, found, strict=True):
            cosine = (vectors[nodes] @ q) / (lengths[nodes] * np.linalg.norm(q)) if len(nodes) else np.empty(0)
            out.append(nodes[cosine >= least])
        return out

    sample = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))
    if WIDEST * BEAM < len(vectors):
        closest = graph.true_nearest(units[sample], own[sample], NEAREST)
        if (graph.nearest(units[sample], own[sample], NEAREST, BEAM) >= closest - 1e-5).all():
            there = [len(x) for x in verified(graph.scan(units[sample], least), queries[sample])]
            found = verified(graph.within(units, own, least, BEAM), queries)
            if all(len(found[i]) >= n for i, n in zip(sample, there, strict=True)):
                return found
    return verified(graph.scan(units, least), queries)


def visit(queries: pa.Table, index: pa.Table, least: float) -> pa.Table:
    """(vec_id, n_links, root): links of the queries within a shard, and a spanning forest of these links."""
    kinds = {"vec_id": pa.int64(), "n_links": pa.int64(), "root": pa.int64()}
    if not queries.num_rows or not index.num_rows:
        return pa.table({k: pa.array([], t) for k, t in kinds.items()})
    graph, keys, vectors = _graph(index)
    asked = queries.column("vec_id").to_numpy()
    order = np.argsort(keys, kind="stable")
    at = order[np.minimum(np.searchsorted(keys[order], asked), len(keys) - 1)]
    own = np.where(keys[at] == asked, at, -1)
    links = audited_links(graph, vectors, _matrix(queries.column("embedding")), own, least)
    names, place = np.unique(np.concatenate([keys, asked]), return_inverse=True)
    of_node, of_query = place[: len(keys)], place[len(keys) :]
    parent = np.arange(len(names))
    counts = np.zeros(len(asked), np.int64)

    def roots(nodes: np.ndarray) -> np.ndarray:
        while not np.array_equal(up := parent[nodes], nodes):
            nodes = up
        return nodes

    touched = np.zeros(len(names), bool)
    for i, nodes in enumerate(links):
        others = of_node[nodes][keys[nodes] != asked[i]]
        counts[i] = len(others)
        if len(others):
            members = np.append(others, of_query[i])
            touched[members] = True
            tops = np.unique(roots(members))
            parent[tops] = tops[0]
            parent[members] = tops[0]
    held = np.flatnonzero(touched)
    return pa.table({
        "vec_id": pa.array(np.concatenate([asked, names[held]]), pa.int64()),
        "n_links": pa.array(np.concatenate([counts, np.zeros(len(held), np.int64)]), pa.int64()),
        "root": pa.array(np.concatenate([asked, names[roots(held)]]), pa.int64()),
    })


def comparable(vectors: DataFrame, by: Iterable[str] = ("label",)) -> DataFrame:
    """Distinct (group, vec_id, embedding) of vectors that can link: no null key, group or component, all finite, not zero."""
    x = F.col("embedding")
    clean = F.size(x) > 0
    clean &= F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    some = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & clean)
    for c in by:
        some = some.where(F.col(c).isNotNull())
    group = F.concat_ws(":", *[F.col(c).cast("string") for c in by], F.size(x).cast("string"))
    return some.select(
        group.alias("group"), F.col("vec_id").cast("bigint").alias("vec_id"), x.cast("array<double>").alias("embedding")
    ).distinct()


def near_duplicates(vectors: DataFrame, least: float = 0.93, by: Iterable[str] = ("label",)) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vec_id.

    Vectors of equal non-null ``by`` columns and length are linked when their cosine is ``least`` or
    more. Defined cases: vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and keep themselves, as do those with a null label or vec_id; a repeated row
    counts once; different vectors under one vec_id are one node with the links of all; an empty
    table gives an empty result; other columns are not read.
    """
    usable = stored(comparable(vectors, by), "vectors")
    sizes = usable.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    sizes = stored(
        sizes.select(
            "group", "_n",
            F.ceil(F.col("_n") / SHARD_ROWS).cast("bigint").alias("shards"),
            F.ceil(F.col("_n") / BLOCK_ROWS).cast("bigint").alias("blocks"),
        ),
        "groups",
    )
    placed = stored(attach(usable, sizes, "group", "_n", "vec_id", "inner"), "placed")
    code = F.xxhash64("vec_id")
    named = placed.withColumn("shard", F.concat_ws("#", "group", F.pmod(code, F.col("shards")).cast("string")))
    index = named.select("shard", "vec_id", "embedding").groupBy("shard").applyInArrow(
        build_shard, "shard string, at bigint, vec_id bigint, embedding array<double>, level bigint, links binary"
    )
    index = stored(index, "index")

    def visits(df: DataFrame, count: str, name: str) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1)))

    asked = visits(placed, "shards", "_s").select(
        F.concat_ws("#", "group", F.col("_s").cast("string")).alias("shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).alias("block"),
        "vec_id",
        "embedding",
    )
    shards = index.withColumn("group", F.regexp_replace("shard", "#[0-9]+$", "")).join(sizes.select("group", "blocks"), "group")
    shards = visits(shards, "blocks", "block").drop("group", "blocks")
    found = asked.groupBy("shard", "block").cogroup(shards.groupBy("shard", "block")).applyInArrow(
        lambda queries, held: visit(queries, held, least), "vec_id bigint, n_links bigint, root bigint"
    )
    found = stored(found, "visits")
    counts = found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    roots = connected(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id")).distinct()
    component = F.coalesce("root", "vec_id")
    return (
        every.join(counts, "vec_id", "left")
        .join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
