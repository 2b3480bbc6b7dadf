"""Match groups: connected components of the link graph.

Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014) on edges that point from the larger to the smaller id.  The
number of edges never grows, and each round is an aggregate and a join.

Many links, as a similarity join lists them for a dense crowd, are thinned out first: what a
task reads in a row has the same components as a forest of it, with less than a link a node.

Large graphs of up to `ONE_TASK_NODES` nodes are not hung over round by round: their nodes are numbered,
and what is left of the links, two numbers each, is united in one task that holds a number per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.session import cut


# A node with this many edges is a hub: its join partition is left to AQE's skew split.
HUB_DEGREE = 1_000_000

# Above so many edges, the half-way result of a round is a table: it is read three times.
WORTH_CUTTING = 100_000

# From so many links on they are thinned out, in runs of so many: a few MB of a task.
MANY_LINKS = 1_000_000
RUN = 200_000
ONE_RUN = 1_000_000

# Graphs from so many links on are united by node numbers, up to so many nodes: 4 bytes each in one task.
WORTH_NUMBERING = 400_000
ONE_TASK_NODES = 64_000_000


def thinned(links: DataFrame, many: int = MANY_LINKS, run: int = RUN) -> DataFrame:
    """Links (a, b) with the same components, and fewer of them where there are many.

    `links` is counted, and read again by the caller: meant for a table.
    """
    a, b = links.columns
    simple = isinstance(links.schema[a].dataType, (T.StringType, T.IntegralType)) and links.schema[a].dataType == links.schema[b].dataType
    if not simple or links.count() < many:
        return links

    # A function of its own: executors need no copy of this package.
    def forests(batches):
        import numpy as np
        import pyarrow as pa

        def forest(held):
            """Every node but the roots, linked to its root: roots are hung under smaller ones until no link is left."""
            table = pa.Table.from_batches(held)
            ends = pa.chunked_array([*table.column(0).chunks, *table.column(1).chunks]).combine_chunks().dictionary_encode()
            x, y = np.split(ends.indices.to_numpy(), 2)
            root = np.arange(len(ends.dictionary))
            while len(x):
                x, y = root[x], root[y]
                apart = x != y
                x, y = x[apart], y[apart]
                root[np.maximum(x, y)] = np.minimum(x, y)
                while (root != root[root]).any():
                    root = root[root]
            node = np.flatnonzero(root != np.arange(len(root)))
            sides = [ends.dictionary.take(pa.array(i)) for i in (node, root[node])]
            return pa.RecordBatch.from_arrays(sides, schema=table.schema)

        held, size = [], 0
        for batch in batches:
            held, size = [*held, batch], size + batch.num_rows
            if size >= run:
                held = [forest(held)]
                size = held[0].num_rows
                if 2 * size >= run:
                    yield held[0]
                    held, size = [], 0
        if size:
            yield forest(held)

    return links.where(F.col(a) != F.col(b)).mapInArrow(forests, links.schema)


def _lowest(edges: DataFrame, hubs: bool) -> DataFrame:
    """The smallest `lo` of every `hi`.  With hubs around it is cut into a table, because
    AQE splits a skewed join partition only where no aggregate stands before the join."""
    lowest = edges.groupBy("hi").agg(F.min("lo").alias("lower"))
    return cut(lowest, "lowest") if hubs else lowest


def _large_star(edges: DataFrame, hubs: bool) -> DataFrame:
    """Re-hang each node from its smaller neighbour's own smallest neighbour."""
    lowest = _lowest(edges, hubs).withColumnRenamed("hi", "lo")
    return (
        edges.join(lowest, "lo", "left")
        .select("hi", F.coalesce("lower", "lo").alias("lo")).distinct()
    )


def _small_star(edges: DataFrame, hubs: bool) -> DataFrame:
    """Hang a node and its smaller neighbours from the smallest of them."""
    lowest = _lowest(edges, hubs)
    others = edges.join(lowest, "hi").where("lo <> lower").select(F.col("lo").alias("hi"), "lower")
    return lowest.unionByName(others).select("hi", F.col("lower").alias("lo")).distinct()


def _shape(edges: DataFrame, hub_degree: int) -> tuple[bool, bool, int]:
    """(settled, hubs, edges).  Settled: every `hi` has one `lo`, and no `lo` is itself a `hi`."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(
        edges.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    open_nodes, degree, size = nodes.agg(
        F.count_if(F.expr("up > 1 or (up = 1 and down > 0)")), F.max(F.col("up") + F.col("down")), F.sum("up")
    ).first()
    return open_nodes == 0, (degree or 0) >= hub_degree, size or 0


def _numbered(edges: DataFrame) -> DataFrame:
    """(id, n), cut: every node with a number, which says the part of the table that it is in, and its place there."""
    nodes = edges.select(F.col("hi").alias("id")).unionByName(edges.select(F.col("lo").alias("id"))).distinct()
    return cut(nodes.withColumn("n", F.monotonically_increasing_id()), "nodes")


def _united(edges: DataFrame, size: int, nodes: DataFrame, parts: dict[int, int]) -> DataFrame:
    """(id, root) for the ends of `size` `edges` (hi, lo), whose numbers are in `nodes`; `parts`: how many nodes each part holds.

    One task unites what the links' forests leave.  It reads them in batches and holds an array of all nodes,
    so its memory is bounded by `ONE_TASK_NODES`, whatever the number of links.
    """
    first, total = {}, 0
    for part, count in sorted(parts.items()):
        first[part], total = total, total + count

    # A function of its own: executors need no copy of this package.
    def unite(batches):
        import numpy as np
        import pyarrow as pa

        start = np.zeros(max(first) + 1, np.int64)
        start[list(first)] = list(first.values())
        place = (1 << 33) - 1
        root = np.arange(total, dtype=np.int32)

        def found(x):
            while True:
                up = root[x]
                if (up == x).all():
                    return x
                x = up

        for batch in batches:
            x, y = (start[n >> 33] + (n & place) for n in (c.to_numpy(zero_copy_only=False) for c in batch.columns))
            while len(x):
                x, y = found(x), found(y)
                apart = x != y
                x, y = x[apart], y[apart]
                root[np.maximum(x, y)] = np.minimum(x, y)
        for part, at in first.items():
            for low in range(at, at + parts[part], 1 << 16):
                own = np.arange(low, min(low + (1 << 16), at + parts[part]))
                top = found(own).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own - at + (part << 33)), pa.array(top)], names=["n", "top"])

    ends = edges
    for end in ("hi", "lo"):
        ends = ends.join(nodes.withColumnsRenamed({"id": end, "n": f"n_{end}"}), end)
    ends = ends.select("n_hi", "n_lo")
    if size > 4 * total:  # Fewer are nearly a forest already.
        ends = thinned(cut(ends, "numbered"), WORTH_NUMBERING, ONE_RUN)
    tops = cut(ends.repartition(1).mapInArrow(unite, "n long, top long"), "tops")
    labelled = cut(nodes.join(tops, "n").select("id", "top"), "labelled")
    return labelled.join(cut(labelled.groupBy("top").agg(F.min("id").alias("root")), "roots"), "top").select("id", "root")


def components(links: DataFrame, a: str = "id_a", b: str = "id_b", hub_degree: int | None = None) -> DataFrame:
    """(id, root) for every linked id; `root` is the smallest id of its component.

    Runs jobs: each round is cut into the shared checkpoint folder, so a lost executor
    costs tasks of the current round only.
    """
    edges = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    )
    edges = cut(edges, "edges")
    whole = hub_degree is None
    hub_degree = HUB_DEGREE if hub_degree is None else hub_degree
    settled, hubs, size = _shape(edges, hub_degree)
    if whole and not settled and size >= WORTH_NUMBERING:
        nodes = _numbered(edges)
        parts = {r.part: r["count"] for r in nodes.groupBy(F.shiftright("n", 33).cast("int").alias("part")).count().collect()}
        if sum(parts.values()) <= ONE_TASK_NODES:
            return _united(edges, size, nodes, parts)
    while not settled:
        re_hung = _large_star(edges, hubs)
        re_hung = cut(re_hung, "edges") if hubs or size >= WORTH_CUTTING else re_hung
        edges = cut(_small_star(re_hung, hubs), "edges")
        settled, hubs, size = _shape(edges, hub_degree)
    members = edges.select(F.col("hi").alias("id"), F.col("lo").alias("root"))
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("root")).distinct()
    return members.unionByName(roots)
