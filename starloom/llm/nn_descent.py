"""Embedding near-duplicates by NN-descent.

1. A first neighbour graph: vectors are sorted along several random
   projections (sign bits first, then a value), dealt out in ranges, and each
   is compared with the next few in the order.
2. Rounds of local joins: the neighbours of a vector, in either direction,
   are compared with each other; every vector keeps its ``K`` best so far.
   Rounds end when they bring few new threshold edges.
3. Lists in which every neighbour is over the threshold are saturated: more
   may lie beyond them.  They are enlarged exactly.  A link that both of its
   ends have left out may be all that joins two components: vectors of
   saturated lists are dealt to balls (centre and radius) within their
   component, and balls of different components are compared wherever these
   allow a link (``bridges``).  Then all links of a vector lie within its
   component, so the components that hold a saturated list are compared in
   blocks.  Lists are not written out for that; each block adds up its counts
   of links.
4. Recall of direct links is audited against brute force on a fixed number of
   vectors (``AUDIT``, chosen by hash), as the mean over these; while it is
   below ``RECALL``, more projections and rounds are added, ``RETRIES`` times,
   and as often again while it is below ``LEAST_RECALL``; then the job fails.

Cosines are in double precision; links have a cosine of ``threshold`` or more.
NULL, empty and zero vectors and vectors with NULL or non-finite parts link
with nothing, nor do vectors of different lengths with each other (the audit
leaves short of ``AUDIT`` when there are fewer vectors).  Equal vectors are
merged first and count as links of each other; equal vectors of one id count
once.  Each row is returned; rows that share an id belong to one component,
linked or not.  Rows with a NULL id link with nothing, have no component and
are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import components, staged

K = 12
PROJECTIONS, BITS, AHEAD = 10, 10, 6
ROUNDS, SETTLED = 6, 0.002
AUDIT, RECALL, RETRIES, LEAST_RECALL = 128, 0.995, 4, 0.9
BLOCK = 512
#: Vectors of a ball at most, and balls of a block that are compared with each other at once.
BALL, BALLS = 256, 1024
#: Neighbours of one vector that are compared with each other at once.
JOIN = 48


def _unit(v) -> tuple[int, bytes] | tuple[None, None]:
    """Length and bytes of the unit vector, nothing for a vector of no use."""
    if v is not None and len(v):
        x = np.array([np.nan if y is None else y for y in v], np.float64)
        if np.isfinite(x).all() and (top := np.abs(x).max()) > 0:
            x = x / top
            return len(x), (x / np.sqrt(x @ x)).tobytes()
    return None, None


def _clean(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's id and unit vector in the bytes of doubles."""
    for batch in rows:
        units = [_unit(v) for v in batch.column("v").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([u[0] for u in units], pa.int32()),
                                          pa.array([u[1] for u in units], pa.binary())], names=["id", "dim", "unit"])


def _matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def _projected(rows: Iterator[pd.DataFrame], seed: int) -> Iterator[pd.DataFrame]:
    """Each vector once per projection, with its place in the order."""
    for pdf in rows:
        for dim, g in pdf.groupby("dim"):
            x = _matrix(list(g["unit"]))
            for t in range(PROJECTIONS):
                r = np.random.default_rng([seed, t, int(dim)]).standard_normal((int(dim), BITS + 1))
                y = x @ r
                key = (y[:, :BITS] > 0) @ (1 << np.arange(BITS))
                yield pd.DataFrame({"t": t, "dim": g["dim"], "sign": key, "along": y[:, BITS], "node": g["node"], "unit": g["unit"]})


def _pairs_frame(a, b, sim) -> pd.DataFrame:
    return pd.DataFrame({"a": np.concatenate([a, b]), "b": np.concatenate([b, a]), "sim": np.concatenate([sim, sim])})


def _along(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each vector with the next ``AHEAD`` in the order; a batch takes the end
    of the one before along."""
    rest = None
    for pdf in rows:
        n_old = 0 if rest is None else len(rest)
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        t, dim, node = pdf["t"].to_numpy(), pdf["dim"].to_numpy(), pdf["node"].to_numpy()
        for d in np.unique(dim):
            at = np.flatnonzero(dim == d)
            x = _matrix(list(pdf["unit"].to_numpy()[at]))
            for s in range(1, AHEAD + 1):
                i, j = np.arange(len(at) - s), np.arange(s, len(at))
                ok = (t[at[i]] == t[at[j]]) & (at[j] >= n_old)
                i, j = i[ok], j[ok]
                yield _pairs_frame(node[at[i]], node[at[j]], np.einsum("ij,ij->i", x[i], x[j]))
        rest = pdf.tail(AHEAD)


def _local(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by centre: the vectors around one are compared, and a
    pair is told if it is better than the worst one that either end has."""
    def around(g: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(list(g["unit"]))
        node, worst = g["node"].to_numpy(), g["worst"].to_numpy()
        sim = x @ x.T
        i, j = np.nonzero(np.triu((sim > worst[:, None]) | (sim > worst[None, :]), 1))
        ok = node[i] != node[j]
        return _pairs_frame(node[i[ok]], node[j[ok]], sim[i[ok], j[ok]])

    rest = None
    for pdf in rows:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        whole = (pdf["centre"] != pdf["centre"].iloc[-1]).to_numpy() | (pdf["part"] != pdf["part"].iloc[-1]).to_numpy()
        rest, pdf = pdf[~whole], pdf[whole]
        out = [around(g) for _, g in pdf.groupby(["centre", "part", "dim"], sort=False)]
        if out:
            yield pd.concat(out).drop_duplicates(["a", "b"])
    if rest is not None and len(rest):
        yield around(rest)


def _best(pairs: DataFrame, k: int = K) -> DataFrame:
    order = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return pairs.groupBy("a", "b").agg(F.max("sim").alias("sim")) \
        .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")


def _round(graph: DataFrame, nodes: DataFrame, deal: int) -> DataFrame:
    worst = graph.groupBy("a").agg(F.when(F.count(F.lit(1)) >= K, F.min("sim")).otherwise(F.lit(-2.0)).alias("worst"))
    near = graph.select(F.col("a").alias("centre"), F.col("b").alias("node")) \
        .unionByName(graph.select(F.col("b").alias("centre"), F.col("a").alias("node"))).distinct()
    # many vectors may have one neighbour: its surroundings are dealt to parts that are joined on their own, anew each round
    parts = near.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / F.lit(JOIN)).alias("parts"))
    near = near.join(parts, "centre").withColumn("part", F.pmod(F.xxhash64("node", "centre", F.lit(deal)), F.col("parts")))
    rows = near.join(nodes, "node").join(worst, F.col("node") == worst["a"], "left") \
        .select("centre", "part", "node", "dim", "unit", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
    return rows.repartition("centre", "part").sortWithinPartitions("centre", "part") \
        .mapInPandas(_local, graph.schema)


def _search(graph: DataFrame | None, nodes: DataFrame, seed: int, threshold: float) -> DataFrame:
    """Projections into the graph, and rounds until it settles."""
    id_type = dict(nodes.dtypes)["node"]
    order = nodes.mapInPandas(lambda it: _projected(it, seed),
                              f"t int, dim int, sign long, along double, node {id_type}, unit binary") \
        .repartitionByRange("t", "dim", "sign", "along", "node") \
        .sortWithinPartitions("t", "dim", "sign", "along", "node")
    pairs = order.mapInPandas(_along, f"a {id_type}, b {id_type}, sim double")
    graph = staged(_best(pairs if graph is None else pairs.unionByName(graph)), "graph")
    for r in range(ROUNDS):
        better = staged(_best(_round(graph, nodes, ROUNDS * seed + r).unionByName(graph)), "graph")
        edges = better.filter(F.col("sim") >= threshold)
        changed, size = edges.join(graph, ["a", "b"], "left_anti").count(), edges.count()
        graph = better
        if changed <= SETTLED * size:
            break
    return graph


def _dense(links: DataFrame, label: DataFrame) -> DataFrame:
    """Components in which some vector's list is full of links: there links
    are counted in blocks.  Elsewhere lists hold all that was found."""
    full = links.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= K)
    return label.join(full.select("node"), "node").select("component").distinct()


def _balls(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by component and along a projection: runs of up to
    ``BALL`` vectors of a component, named after their first; the first row has
    the centre and the largest angle to it."""
    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        run = ((pdf["component"] != pdf["component"].shift()) | (pdf["dim"] != pdf["dim"].shift())).cumsum()
        out = []
        for _, g in pdf.groupby([run, pdf.groupby(run, sort=False).cumcount() // BALL], sort=False):
            x = _matrix(list(g["unit"]))
            c = x.sum(axis=0)
            c = c / size if (size := np.sqrt(c @ c)) > 1e-6 else x[0]
            others = [None] * (len(g) - 1)
            out.append(g[["node", "component", "dim", "unit"]].assign(
                ball=g["node"].iloc[0], centre=[c.tobytes(), *others], radius=[np.arccos(np.clip(x @ c, -1, 1)).max(), *others]))
        return pd.concat(out)

    for pdf in rows:  # a batch that ends amid a component ends a ball
        if len(pdf):
            yield cut(pdf.reset_index(drop=True))


def _ordered(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors with their place along one projection."""
    for pdf in rows:
        for dim, g in pdf.groupby("dim"):
            y = _matrix(list(g["unit"])) @ np.random.default_rng([0, int(dim)]).standard_normal((int(dim), BITS + 1))
            yield g.assign(sign=(y[:, :BITS] > 0) @ (1 << np.arange(BITS)), along=y[:, BITS])


def _by_block(rows: Iterator[pd.DataFrame], pairs) -> Iterator[pd.DataFrame]:
    """``pairs`` of each block; rows come sorted by block."""
    rest = None
    for pdf in rows:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        whole = (pdf["block"] != pdf["block"].iloc[-1]).to_numpy()
        rest, pdf = pdf[~whole], pdf[whole]
        out = [pairs(g) for _, g in pdf.groupby("block", sort=False)]
        if out:
            yield pd.concat(out)
    if rest is not None and len(rest):
        yield pairs(rest)


def _may_link(g: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Balls of different components whose centres are no farther apart than
    their radii and the threshold's angle add up to."""
    side, ball, part = g["side"].to_numpy(), g["ball"].to_numpy(), g["component"].to_numpy()
    c, r, most = _matrix(list(g["centre"])), g["radius"].to_numpy(), np.arccos(np.clip(threshold, -1, 1)) + 1e-6
    out = []
    for s, o in ((0, 1), (2, 2)):
        i, j = np.flatnonzero(side == s), np.flatnonzero(side == o)
        near = np.arccos(np.clip(c[i] @ c[j].T, -1, 1)) <= r[i][:, None] + r[j][None, :] + most
        near &= part[i][:, None] != part[j][None, :]
        x, y = np.nonzero(np.triu(near, 1) if s == 2 else near)
        out.append(pd.DataFrame({"x": ball[i[x]], "y": ball[j[y]]}))
    return pd.concat(out)


def _one_link(g: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """The best link between two balls, if there is one."""
    side, node = g["side"].to_numpy(), g["node"].to_numpy()
    x = _matrix(list(g["unit"]))
    i, j = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    sim = x[i] @ x[j].T
    a, b = np.unravel_index(np.argmax(sim), sim.shape)
    some = sim[a, b] >= threshold
    return pd.DataFrame({"a": node[i[[a]]], "b": node[j[[b]]]}) if some else pd.DataFrame({"a": node[:0], "b": node[:0]})


def bridges(links: DataFrame, label: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b in both directions) between components that lists full of
    links leave out: at least one for each two components that have any
    between vectors with such lists.  Where an end's list is not full, it holds
    the link."""
    full = links.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= K).select("node")
    of = staged(label.join(full, "node"), "full")
    if of.select("component").distinct().limit(2).count() < 2:
        return links.limit(0)
    id_type, kinds = dict(nodes.dtypes)["node"], dict(label.dtypes)["component"]
    cols = f"node {id_type}, dim int, unit binary, component {kinds}"
    order = of.join(nodes.select("node", "dim", "unit"), "node").select("node", "dim", "unit", "component") \
        .mapInPandas(_ordered, f"{cols}, sign long, along double") \
        .repartitionByRange("component", "dim", "sign", "along", "node") \
        .sortWithinPartitions("component", "dim", "sign", "along", "node")
    member = staged(order.mapInPandas(_balls, f"node {id_type}, component {kinds}, dim int, unit binary, ball {id_type}, centre binary, radius double"),
                    "balls")
    balls = member.filter("centre is not null").select("ball", "component", "dim", "centre", "radius")
    parts = balls.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(BALLS)).cast("int").alias("parts"))
    dealt = balls.join(parts, "dim").withColumn("own", F.pmod(F.xxhash64("ball"), F.col("parts")).cast("int")) \
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("ball", "component", "centre", "radius",
                F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0).otherwise(1).alias("side"),
                F.struct("dim", F.least("own", "with"), F.greatest("own", "with")).cast("string").alias("block"))
    near = staged(dealt.repartition("block").sortWithinPartitions("block")
                  .mapInPandas(lambda it: _by_block(it, lambda g: _may_link(g, threshold)), f"x {id_type}, y {id_type}"), "near-balls")
    pair = F.struct("x", "y").cast("string").alias("block")
    met = near.select("x", pair, F.lit(0).alias("side")).unionByName(near.select(F.col("y").alias("x"), pair, F.lit(1).alias("side"))) \
        .join(member.select("node", "unit", "ball"), F.col("x") == F.col("ball")).select("node", "unit", "side", "block")
    found = met.repartition("block").sortWithinPartitions("block") \
        .mapInPandas(lambda it: _by_block(it, lambda g: _one_link(g, threshold)), f"a {id_type}, b {id_type}")
    found = staged(found, "bridges")
    return found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _audit(links: DataFrame, nodes: DataFrame, threshold: float, label: DataFrame | None = None) -> float:
    """Mean share of its direct links that an audited vector has found, by
    brute force over all vectors; each vector with a link counts the same, so
    a large cluster doesn't outweigh small ones.  The audited ones are few,
    whatever there is."""
    id_type = dict(nodes.dtypes)["node"]
    asked = nodes.orderBy(F.xxhash64("node")).limit(AUDIT).toPandas()
    if not len(asked):
        return 1.0
    shared = nodes.sparkSession.sparkContext.broadcast(
        {int(d): (g["node"].to_numpy(), _matrix(list(g["unit"]))) for d, g in asked.groupby("dim")})

    def brute(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for d, g in pdf.groupby("dim"):
                if int(d) in shared.value:
                    q, x = shared.value[int(d)]
                    i, j = np.nonzero(x @ _matrix(list(g["unit"])).T >= threshold)
                    a, b = q[i], g["node"].to_numpy()[j]
                    yield pd.DataFrame({"a": a[a != b], "b": b[a != b]})

    true = nodes.mapInPandas(brute, f"a {id_type}, b {id_type}")
    if label is None:
        label = staged(components(links), "labels")
    dense = _dense(links, label).withColumn("dense", F.lit(True))
    at = true.join(links.withColumn("listed", F.lit(True)), ["a", "b"], "left") \
        .join(label.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left") \
        .join(label.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left") \
        .join(dense.withColumnRenamed("component", "ca"), "ca", "left")
    found = F.col("listed").isNotNull() | F.coalesce((F.col("ca") == F.col("cb")) & F.col("dense"), F.lit(False))
    recall = at.groupBy("a").agg(F.avg(found.cast("int")).alias("r")).agg(F.avg("r")).first()[0]
    return 1.0 if recall is None else recall


def _block_counts(rows: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Rows come sorted by block: links of each vector with those of the other
    part, equal vectors counted as often as they occur."""
    def counts(g: pd.DataFrame) -> pd.DataFrame:
        out = []
        side, times, node = g["side"].to_numpy(), g["times"].to_numpy(np.int64), g["node"].to_numpy()
        x = _matrix(list(g["unit"]))
        for s, o in ((0, 1), (1, 0), (2, 2)):
            i, j = np.flatnonzero(side == s), np.flatnonzero(side == o)
            if len(i) and len(j):
                near = x[i] @ x[j].T >= threshold
                if s == 2:
                    near |= np.eye(len(i), dtype=bool)  # itself, however its cosine is rounded
                out.append(pd.DataFrame({"node": node[i], "n": near @ times[j]}))
        return pd.concat(out) if out else pd.DataFrame({"node": node[:0], "n": times[:0]})

    yield from _by_block(rows, counts)


def link_counts(label: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links of every vector of the components in ``label`` (node, component),
    equal vectors and itself included."""
    id_type = dict(nodes.dtypes)["node"]
    sizes = label.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = label.join(sizes, "component").join(nodes, "node").withColumn("own", own) \
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("node", "unit", "times", F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0)
                .otherwise(1).alias("side"),
                F.xxhash64("component", "dim", F.least("own", "with"), F.greatest("own", "with")).alias("block"))
    return dealt.repartition("block").sortWithinPartitions("block") \
        .mapInPandas(lambda it: _block_counts(it, threshold), f"node {id_type}, n long") \
        .groupBy("node").agg(F.sum("n").alias("n"))


def near_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: the id, n_links, component_id and
    kept."""
    id_type = dict(vectors.dtypes)[id_col]
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    usable = staged(rows.mapInArrow(_clean, f"id {id_type}, dim int, unit binary"), "units")
    filled = usable.filter("id is not null and unit is not null")
    # equal vectors: one node, numbered as it is written
    nodes = staged(filled.groupBy("dim", "unit").agg(F.min("id").alias("first"), F.countDistinct("id").alias("times"))
                   .select(F.monotonically_increasing_id().alias("node"), "dim", "unit", "first", "times"), "nodes")
    member = staged(filled.join(nodes.select("dim", "unit", "node"), ["dim", "unit"]).select("id", "node"), "members")
    # rows that share an id belong to one component, linked or not
    shared = member.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("top")).filter("a < top")
    alike = member.distinct().join(shared, "id").filter("node <> a").select("a", F.col("node").alias("b"))
    graph, seed = None, 1
    while True:
        graph = _search(graph, nodes.select("node", "dim", "unit"), seed, threshold)
        links = staged(graph.filter(F.col("sim") >= threshold).select("a", "b"), "links")
        label = staged(components(links), "labels")
        more = bridges(links, label, nodes, threshold)
        if not more.isEmpty():
            links = links.unionByName(more)
            label = staged(components(links), "labels")
        recall = _audit(links, nodes.select("node", "dim", "unit"), threshold, label)
        if recall >= RECALL or seed > RETRIES and recall >= LEAST_RECALL:
            break
        if seed > 2 * RETRIES:
            raise RuntimeError(f"recall of direct links is {recall:.3f} after {seed} searches; at least {LEAST_RECALL} is asked for")
        seed += 1
    # a list that is not full of links holds all its vector's links; where one in a component is full, count in blocks
    counted = staged(link_counts(label.join(_dense(links, label), "component"), nodes, threshold), "counted")
    times = nodes.select(F.col("node").alias("b"), F.col("times").alias("tb"))
    listed = links.join(times, "b").groupBy(F.col("a").alias("node")).agg(F.sum("tb").alias("n")) \
        .join(nodes.select("node", "times"), "node").select("node", (F.col("n") + F.col("times")).alias("n")) \
        .join(counted.select("node"), "node", "left_anti")
    n = listed.unionByName(counted)
    if not alike.isEmpty():
        label = components(links.unionByName(alike))
    named = staged(label.join(nodes.select("node", "first"), "node"), "labels")
    names = named.groupBy("component").agg(F.min("first").alias("name"))
    of = staged(nodes.select("node", "first", "times").join(named.join(names, "component").select("node", "name"), "node", "left")
                .join(n, "node", "left").select("node", F.coalesce("name", "first").alias("name"),
                                                (F.coalesce("n", "times") - 1).alias("n_links")), "named")
    linked = member.join(of, "node").select("id", "n_links", F.col("name").alias("component"))
    # the others: no usable vector, or no id; theirs is the component of a usable row of their id
    of_id = linked.select("id", "component").distinct()
    rest = usable.filter("unit is null or id is null").select("id").join(of_id, "id", "left") \
        .select("id", F.lit(0).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))
    out = linked.unionByName(rest)
    return out.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def digest(vectors: DataFrame) -> DataFrame:
    """The query's columns."""
    return near_vectors(vectors)
