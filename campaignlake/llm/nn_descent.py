"""Near-duplicate vectors by NN-descent.

A neighbour graph starts from leaves of random projections and is refined by local joins: the neighbours
of a vector, forward and backward, are compared with each other, and every vector keeps its best. A list
that holds links only is saturated: it may hide more links, so it is doubled before the next join, up to
WIDEST entries. Threshold edges of the lists connect vectors into groups. What even the widest list cannot
hold is not lost: all that is compared also reports a spanning forest of its links. Each further round has
new projections and looks for neighbours in other groups only; rounds go on until no groups merge. Links within a group are then counted in tiles that
report counts and never list pairs. A stated sample of vectors is compared with all rows to audit the
recall, by vector and for vectors with few links, and rounds are added until both are high enough.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, parallel
from .components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Entries of a neighbour list at first, and at most after saturated ones were doubled.
LIST, WIDEST = 8, 32
LEAF = 512
# Members of a pivot that are compared with each other at a time.
RUN = 96
TILE = 512
TABLES = 6
# Vectors to a bucket of a projection table that the number of directions aims at, times the labels.
BUCKET = 3500
# Vectors of the audit: those with an id divisible by this.
AUDIT_EVERY = 20
RECALL = 0.98
# Most projection tables; all vectors are compared with all if the recall does not hold with these.
MOST_TABLES = 8 * TABLES

EDGES = "src long, dst long, cosine double, bridge boolean"


def unit_vectors(rows: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(id, label, unit, content) of every row; `content` names equal vectors of one label.

    `unit` and `content` are null for rows that cannot have links: without an id or label, with a null,
    empty or zero vector, or with a null or non-finite component.
    """
    read = rows.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"),
        F.transform(F.col(vector_column), lambda x: x.cast("double")).alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.when(
        F.col("id").isNotNull() & F.col("label").isNotNull() & sound,
        F.array_max(F.transform("vector", F.abs)))
    # Divided by the largest component first, so that no square overflows or vanishes.
    even = read.withColumn("top", largest).withColumn(
        "vector", F.when(F.col("top") > 0, F.expr("transform(vector, x -> x / top)")))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    units = even.withColumn("norm", norm).select(
        "id", "label", F.expr("transform(vector, x -> x / norm)").alias("unit"))
    return units.withColumn("content", F.when(F.col("unit").isNotNull(), F.xxhash64("label", "unit")))


def _unit(batch, name: str) -> np.ndarray:
    """A list column of equal lengths as a matrix; one of mixed lengths padded with zeros."""
    column = batch.column(name)
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == lengths[0]).all():
        return flat.reshape(len(lengths), -1)
    out, at = np.zeros((len(lengths), lengths.max(initial=0))), 0
    for i, n in enumerate(lengths):
        out[i, :n] = flat[at : at + n]
        at += n
    return out


def _in_groups(batches, key: str, size: int):
    """(ids, vectors, seats) of runs of at most `size` rows with one key; rows come sorted by key."""
    held: list = []
    current, n = None, 0
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if a == b:
                continue
            if held and keys[a] != current:
                yield held
                held, n = [], 0
            current = keys[a]
            while a < b:
                step = min(b - a, size - n)
                held.append(batch.slice(a, step))
                n, a = n + step, a + step
                if n == size:
                    yield held
                    held, n = [], 0
    if held:
        yield held


def _compared(group, threshold: float) -> pa.RecordBatch:
    """The `width` most similar vectors of other groups for each vector of a tile, and bridges between groups.

    The bridges are a spanning forest of all links >= threshold that the tile holds between groups.
    """
    ids, parts, wide = (np.concatenate([b.column(c).to_numpy() for b in group]) for c in ("id", "component", "width"))
    blocks = [_unit(b, "unit") for b in group]
    width = max(b.shape[1] for b in blocks)
    units = np.concatenate([np.pad(b, ((0, 0), (0, width - b.shape[1]))) for b in blocks])
    near = units @ units.T
    near[parts[:, None] == parts[None, :]] = -2.0
    size = min(int(wide.max(initial=0)), len(ids) - 1)
    src, dst, cosine = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if size > 0:
        best = np.argpartition(-near, size - 1, axis=1)[:, :size]
        order = np.argsort(-np.take_along_axis(near, best, axis=1), axis=1)
        best = np.take_along_axis(best, order, axis=1)
        cosine = np.take_along_axis(near, best, axis=1).ravel()
        good = (cosine > -1.5) & (np.arange(size) < wide[:, None]).ravel()
        src, dst, cosine = np.repeat(np.arange(len(ids)), size)[good], best.ravel()[good], cosine[good]
    linked = near >= threshold
    seen = ~linked.any(axis=1)
    forest: list[tuple[int, int]] = []
    for root in np.flatnonzero(~seen).tolist():
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            at = todo.pop()
            fresh = np.flatnonzero(linked[at] & ~seen).tolist()
            seen[fresh] = True
            forest += [(at, x) for x in fresh]
            todo += fresh
    a, b = (np.array([f[i] for f in forest], dtype=np.int64) for i in (0, 1))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[np.concatenate([src, a])]), pa.array(ids[np.concatenate([dst, b])]),
         pa.array(np.concatenate([cosine, near[a, b]])), pa.array(np.arange(len(src) + len(a)) >= len(src))],
        names=["src", "dst", "cosine", "bridge"],
    )


def leaf_neighbours(vectors: DataFrame, tables: range, bits: int, threshold: float) -> DataFrame:
    """Best neighbours in other groups, and bridges to them, within the leaves of random projections.

    In each table a vector's side of `bits` random directions names its bucket and a further one orders it
    there; consecutive rows form leaves of at most LEAF. Rows are placed by ranges of (bucket, order), so a
    bucket that holds a large share of all rows spreads over many tasks.
    """
    def project(batches):
        for batch in batches:
            units = _unit(batch, "unit")
            for t in tables:
                directions = np.random.default_rng(1000 + t).standard_normal((bits + 1, units.shape[1] if len(units) else 1))
                sides = units @ directions.T
                code = ((sides[:, :bits] > 0) << np.arange(bits)).sum(axis=1) + (t << bits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("component"), batch.column("width"), batch.column("label"),
                     pa.array(code, pa.int64()), pa.array(np.ascontiguousarray(sides[:, bits])), batch.column("unit")],
                    names=["id", "component", "width", "label", "code", "place", "unit"],
                )

    kind = vectors.schema["label"].dataType.simpleString()
    spread = vectors.select("id", "component", "width", "label", "unit").mapInArrow(
        project, f"id long, component long, width int, label {kind}, code long, place double, unit array<double>")
    keyed = spread.select("id", "component", "width", F.xxhash64("label", "code").alias("key"), "place", "unit")
    placed = keyed.repartitionByRange(parallel(vectors.sparkSession), "key", "place").sortWithinPartitions(
        "key", "place", "id")

    def compare(batches):
        for group in _in_groups(batches, "key", LEAF):
            yield _compared(group, threshold)

    return placed.mapInArrow(compare, EDGES)


def best_lists(edges: DataFrame, widths: DataFrame) -> DataFrame:
    """The best distinct neighbours of every vector, as many as its list is wide.

    `widths` has (id, width) of the lists wider than LIST.
    """
    once = edges.where("NOT bridge").groupBy("src", "dst").agg(F.max("cosine").alias("cosine"))
    order = Window.partitionBy("src").orderBy(F.desc("cosine"), "dst")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= WIDEST)
    wide = widths.select(F.col("id").alias("src"), "width")
    return ranked.join(wide, "src", "left").where(F.col("rank") <= F.coalesce("width", F.lit(LIST))).select("src", "dst", "cosine")


def enlarged(lists: DataFrame, widths: DataFrame, threshold: float) -> DataFrame:
    """`widths` with the saturated lists doubled: those that are full and hold links only, up to WIDEST."""
    held = lists.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("worst"))
    both = held.join(widths, "id", "full").withColumn("width", F.coalesce("width", F.lit(LIST)))
    saturated = (F.col("n") >= F.col("width")) & (F.col("worst") >= threshold)
    grown = F.when(saturated, F.least(F.col("width") * 2, F.lit(WIDEST))).otherwise(F.col("width"))
    return both.select("id", grown.cast("int").alias("width")).where(F.col("width") > LIST)


def local_join(lists: DataFrame, vectors: DataFrame, seed: int, threshold: float) -> DataFrame:
    """Best pairs, and bridges, of different groups among the forward and backward neighbours of every vector.

    A vector that very many others list is a pivot of many members; a seeded hash deals them to runs of
    about RUN, other runs in each round, so that no task sees all members of a pivot.
    """
    members = lists.select(F.col("src").alias("pivot"), F.col("dst").alias("id")).union(
        lists.select(F.col("dst").alias("pivot"), F.col("src").alias("id"))).union(
        lists.select(F.col("src").alias("pivot"), F.col("src").alias("id"))).distinct()
    crowds = members.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / RUN).alias("runs"))
    runs = members.join(crowds, "pivot").withColumn("run", F.expr(f"pmod(xxhash64(id, {int(seed)}), runs)"))
    keyed = runs.select("id", F.xxhash64("pivot", "run").alias("key")).join(
        vectors.select("id", "component", "width", "unit"), "id")
    placed = keyed.repartition(parallel(vectors.sparkSession), "key").sortWithinPartitions("key", "id")

    def compare(batches):
        for group in _in_groups(batches, "key", 2 * RUN):
            yield _compared(group, threshold)

    return placed.mapInArrow(compare, EDGES)


def group_links(vectors: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(id, links): how many other vectors of its group each vector links with, counted with weights.

    A group is cut into slices of about TILE vectors; a task compares two slices at a time. Only counts
    per vector and tile leave a task.
    """
    members = groups.join(vectors, groups["vertex"] == vectors["id"]).select("id", "component", "weight", "unit")
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("slices"))
    cut = members.join(sizes, "component").select(
        "*", F.expr("int(pmod(xxhash64(id), slices))").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other"))
    tiled = cut.select(
        "id", "weight", "unit",
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("key"))
    placed = tiled.repartition(parallel(vectors.sparkSession), "key").sortWithinPartitions("key", "id")

    def compare(batches):
        for group in _in_groups(batches, "key", 1 << 60):
            ids, weights, sides = (
                np.concatenate([b.column(c).to_numpy() for b in group]) for c in ("id", "weight", "side"))
            units = np.concatenate([_unit(b, "unit") for b in group])
            near = units @ units.T >= threshold
            if sides.any():
                near &= sides[:, None] != sides[None, :]
            np.fill_diagonal(near, False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array((near @ weights).astype(np.int64))], names=["id", "links"])

    counted = placed.mapInArrow(compare, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def audit(vectors: DataFrame, sample: DataFrame, threshold: float) -> DataFrame:
    """Links of the vectors of `sample`, a column id, compared with all vectors in blocks.

    Returns (id, there, others, bridge): per vector and block the rows and the vectors it links with, and
    one row with the `bridge` to each other group that it links with.
    """
    rows = vectors.select("id", "component", "weight", F.xxhash64("label").alias("label"), "unit")
    picked = rows.join(sample.select("id"), "id", "left_semi")

    def slices(table: DataFrame, name: str) -> DataFrame:
        return table.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / (4 * TILE)).cast("int").alias(name))

    counts = slices(rows, "cuts").join(slices(picked, "takes"), "label")

    def cut(table: DataFrame, own: str, other: str, side: bool) -> DataFrame:
        """Each row with the key of every block pair it takes part in."""
        sliced = table.join(counts, "label").withColumn("own", F.expr(f"int(pmod(xxhash64(id), {own}))")).select(
            "id", "component", "weight", "label", "unit", "own",
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("other"))
        pair = (F.col("own"), F.col("other")) if side else (F.col("other"), F.col("own"))
        return sliced.select("id", "component", "weight", "unit", F.lit(side).alias("picked"), F.xxhash64("label", *pair).alias("key"))

    both = cut(picked, "takes", "cuts", True).union(cut(rows, "cuts", "takes", False))
    placed = both.repartition(parallel(vectors.sparkSession), "key").sortWithinPartitions("key", "id")

    def compare(batches):
        for group in _in_groups(batches, "key", 1 << 60):
            ids, parts, weights, sides = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in group])
                                          for c in ("id", "component", "weight", "picked"))
            blocks = [_unit(b, "unit") for b in group]
            width = max(b.shape[1] for b in blocks)
            units = np.concatenate([np.pad(b, ((0, 0), (0, width - b.shape[1]))) for b in blocks])
            own, all_ = np.flatnonzero(sides), np.flatnonzero(~sides)
            near = units[own] @ units[all_].T >= threshold
            near &= ids[own][:, None] != ids[all_][None, :]
            at, to = np.nonzero(near & (parts[own][:, None] != parts[all_][None, :]))
            # One bridge for each vector and other group.
            _, first = np.unique(np.stack([at, parts[all_][to]]), axis=1, return_index=True)
            src, dst = ids[own][at[first]], ids[all_][to[first]]
            none = np.zeros(len(src), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[own], src])),
                 pa.array(np.concatenate([(near @ weights[all_]).astype(np.int64), none])),
                 pa.array(np.concatenate([near.sum(axis=1).astype(np.int64), none])),
                 pa.array(np.concatenate([ids[own], dst]), mask=np.arange(len(own) + len(src)) < len(own))],
                names=["id", "there", "others", "bridge"])

    return placed.mapInArrow(compare, "id long, there long, others long, bridge long")


def recalls(audited: DataFrame, counted: DataFrame) -> tuple[float | None, float | None]:
    """Mean recall of the audited vectors with links, and of those with at most LIST linked vectors.

    Each vector counts the same, however many links it has. None where there is no such vector.
    """
    there = audited.groupBy("id").agg(F.sum("there").alias("there"), F.sum("others").alias("others")).where("there > 0")
    share = F.least(F.coalesce("links", F.lit(0)), F.col("there")) / F.col("there")
    return tuple(there.join(counted, "id", "left").agg(
        F.avg(share), F.avg(F.when(F.col("others") <= LIST, share))).first())


def near_vectors(
    rows: DataFrame, threshold: float = 0.93, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Links of cosine >= threshold between vectors of one label, as counts and components.

    Returns vec_id, n_links (other vectors linked directly), component_id (smallest reachable id) and kept,
    one row per input row. A vector that is null, empty, zero or holds a null or non-finite component, and
    one without a label or id, links with nothing and is its own component. Vectors of unequal lengths
    compare as if padded with zeros. Every row counts as a vector, also one that repeats an id. Other columns are not read. An empty table gives no rows.
    """
    base = materialize(unit_vectors(rows, id_column, vector_column, label_column), "vectors")
    # Equal vectors are one vertex with a weight.
    vectors = materialize(base.where("content IS NOT NULL").groupBy(F.col("content").alias("id")).agg(
        F.min("id").alias("smallest"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"),
        F.first("unit").alias("unit")), "vertices")
    n = vectors.count()
    # Buckets keep their size as the table grows.
    bits = max(4, math.ceil(math.log2(max(1, n) / BUCKET)))
    sample = base.where((F.col("id") % AUDIT_EVERY == 0) & F.col("content").isNotNull()).select(
        F.col("content").alias("id")).distinct()

    def grouped(found: DataFrame, wide: DataFrame) -> DataFrame:
        """The vectors with the group that the links found so far put them in, and how wide their lists are."""
        named = found.withColumnRenamed("vertex", "id")
        return vectors.join(named, "id", "left").join(wide, "id", "left").withColumns({
            "component": F.coalesce("component", "id"), "width": F.coalesce("width", F.lit(LIST))})

    def joined_by(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        groups = materialize(components(links, "src", "dst"), "groups")
        return groups, materialize(group_links(vectors, groups, threshold), "counted")

    link = "src long, dst long"
    links = rows.sparkSession.createDataFrame([], link)
    lists = rows.sparkSession.createDataFrame([], "src long, dst long, cosine double")
    groups = rows.sparkSession.createDataFrame([], "vertex long, component long")
    counted = rows.sparkSession.createDataFrame([], "id long, links long")
    widths = rows.sparkSession.createDataFrame([], "id long, width int")
    tables = 0
    while n > 1:
        placed = grouped(groups, widths)
        fresh = materialize(leaf_neighbours(placed, range(tables, tables + TABLES), bits, threshold), "leaves")
        # Links of the leaves join groups at once, so that the joins below need not compare a group with itself.
        bridges = materialize(fresh.where("bridge").select("src", "dst").distinct(), "bridges")
        merged = not bridges.isEmpty()
        if merged:
            links = links.union(bridges)
            groups = materialize(components(links, "src", "dst"), "groups")
            placed = grouped(groups, widths)
        of = materialize(placed.select(F.col("id").alias("src"), F.col("component").alias("own")), "own")

        def across(edges: DataFrame) -> DataFrame:
            """The neighbours, also those of earlier rounds, that are in another group still."""
            return edges.join(of, "src").join(of.toDF("dst", "other"), "dst").where("own <> other").select(
                "src", "dst", "cosine", F.lit(False).alias("bridge"))

        near_leaf = fresh.where("NOT bridge").select("src", "dst", "cosine")
        lists = materialize(best_lists(across(near_leaf.union(lists)), widths), "lists")
        near = lists.where(F.col("cosine") >= threshold).count()
        found = []
        for step in range(3):
            widths = materialize(enlarged(lists, widths, threshold), "widths")
            joined = materialize(local_join(lists, grouped(groups, widths), tables + step, threshold), "joined")
            found.append(joined.where("bridge").select("src", "dst"))
            lists = materialize(best_lists(joined.union(lists.withColumn("bridge", F.lit(False))), widths), "lists")
            before, near = near, lists.where(F.col("cosine") >= threshold).count()
            if near == before:
                break
        tables += TABLES
        # Threshold edges of the graph, and the bridges for what the widest lists could not hold.
        new = lists.where(F.col("cosine") >= threshold).select("src", "dst")
        for more in found:
            new = new.union(more)
        new = materialize(new.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(), "edges")
        if not new.isEmpty():
            merged, links = True, links.union(new)
            groups = materialize(components(links, "src", "dst"), "groups")
        if merged:
            counted = materialize(group_links(vectors, groups, threshold), "counted")
        audited = materialize(audit(grouped(groups, widths), sample, threshold), "audited")
        mean, few = recalls(audited, counted)
        done = not merged and mean is not None and mean >= RECALL and (few is None or few >= RECALL)
        # A sample without links shows nothing; then, or if the recall never holds, all vectors are audited.
        if not done and (tables >= MOST_TABLES or (mean is None and not merged)):
            audited, done = materialize(audit(grouped(groups, widths), vectors, threshold), "audited"), True
        # Links that the audit met are links like all others.
        missed = audited.where("bridge IS NOT NULL").select(F.col("id").alias("src"), F.col("bridge").alias("dst"))
        if not missed.isEmpty():
            links = links.union(missed)
            groups, counted = joined_by(links)
        if done:
            break

    named = vectors.select("id", "smallest", "weight").join(
        groups.withColumnRenamed("vertex", "id"), "id", "left").select(
        "id", "smallest", "weight", F.coalesce("component", "id").alias("component"))
    lowest = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    result = named.join(lowest, "component").join(counted, "id", "left").select(
        F.col("id").alias("content"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"))
    return base.select("id", "content").join(result, "content", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    ).select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
