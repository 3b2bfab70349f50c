"""Cross-validated scores of many forest settings, with a journal that a stopped search resumes from.

Settings that differ in the number of trees or the depth alone are one family: the first trees of a forest
are a smaller forest, and a tree cut at a level is the tree of that depth, so the largest member's trees
serve all. A unit of work is a family on a fold; its trees are dealt over tasks, which also score the
held-out rows, and units run side by side. The scores of a unit are a table in the journal, complete once
its time is written beside it. A later run of the same search on the same rows reads what is complete.
"""

from __future__ import annotations

import hashlib
import json
import sys
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from campaignlake.operators import forest as fo
from campaignlake.operators.forest import UNIT, grow_tree, matrix, slot_groups
from campaignlake.session import BROADCAST_BYTES, materialize, shared_dir

# Workers get this module by value, and what tasks use of `forest` by name, so neither need be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Trees that a task grows; it sends a sum per held-out row, so more trees send fewer rows.
BLOCK = 50
SHARED = ("n_estimators", "max_depth")


def families(settings: Mapping[str, Mapping]) -> list[dict[str, Mapping]]:
    """Settings by name, in groups that differ in SHARED parameters only.

    A `min_samples_split` up to twice `min_samples_leaf` changes no tree, so it sets no settings apart.
    """
    groups: dict[str, dict[str, Mapping]] = {}
    for name, s in settings.items():
        p = tree_params(s)
        rest = {k: v for k, v in s.items() if k not in SHARED}
        rest["min_samples_split"] = max(2, p.min_samples_split, 2 * p.min_samples_leaf)
        groups.setdefault(json.dumps(rest, sort_keys=True), {})[name] = s
    return list(groups.values())


def tree_params(setting: Mapping) -> fo.TreeParams:
    names = ("max_depth", "min_samples_split", "min_samples_leaf", "max_features", "max_samples", "class_weight")
    return fo.TreeParams(**{"class_weight": "balanced", **{k: setting[k] for k in names if k in setting}})


def journal_path(folds: Sequence, settings: Mapping[str, Mapping], key: str, target: str, seed: int) -> str:
    """Folder of this search in the shared folder: named by the settings and a digest of all folds' rows."""
    row = F.xxhash64(key, target, F.col("features").cast("string")).cast("decimal(38,0)").alias("row")
    parts = [part for fold in folds for part in (fold.train, fold.test)]
    rows = reduce(DataFrame.unionAll, [part.select(F.lit(i).alias("part"), row) for i, part in enumerate(parts)])
    found = {r["part"]: [str(r["n"]), str(r["total"])] for r in rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("row").alias("total")).collect()}
    digests = [found.get(i, ["0", "None"]) for i in range(len(parts))]
    named = json.dumps([settings, key, target, seed, digests], sort_keys=True)
    return f"{shared_dir(folds[0].train.sparkSession)}/search-{hashlib.md5(named.encode()).hexdigest()}"


def _work(family: Mapping[str, Mapping]) -> int:
    """Levels of all trees of a family, an unlimited tree taken as one of 40."""
    return max(s.get("n_estimators", 100) for s in family.values()) * max(s.get("max_depth") or 40 for s in family.values())


def _complete(spark, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/time/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


class FoldData:
    """A fold's binned rows: stored tables, and broadcast where both are small enough."""

    def __init__(self, fold, key: str, target: str, most: int):
        self.number, self.spark = fold.number, fold.train.sparkSession
        self.cuts = fo.learn_cuts(fold.train)
        self.train = materialize(fo.binned(fold.train, self.cuts, key, target), "binned")
        self.test = materialize(fo.binned(fold.test, self.cuts, key, target), "binned")
        counted = {r["label"]: r["count"] for r in self.train.groupBy("label").count().collect()}
        self.label_counts = {c: counted.get(c, 0) for c in (0, 1)}
        self.shared, self.blocks = None, None
        if fo.fits_broadcast(self.train, self.cuts, most) and fo.fits_broadcast(self.test, self.cuts, most):
            test = self.test.toArrow()
            parts = fo.matrix(self.train.select("row", "label", "bins").toArrow()), fo.matrix(test), test.column("id").combine_chunks()
            self.shared = self.spark.sparkContext.broadcast(parts)
        else:
            self.blocks = fo.packed(self.train, self.cuts)

    def schema(self):
        return StructType([self.test.schema["id"], *StructType.fromDDL("model string, label int, total long")])


def _sums(names, ids, label, totals):
    """Rows (id, model, label, total) of the sums of several models over the same held-out rows."""
    for name, total in zip(names, totals):
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([name] * len(label), pa.string()), pa.array(label.astype(np.int32)), pa.array(total)],
            names=["id", "model", "label", "total"])


def _add(total: np.ndarray, tree: fo.Tree, number: int, bins: np.ndarray, members: Sequence[tuple[int, int | None]]) -> None:
    reached: dict[int | None, np.ndarray] = {}
    for i, (n, depth) in enumerate(members):
        if number < n:
            if depth not in reached:
                reached[depth] = np.rint(tree.reach(bins, depth) * UNIT).astype(np.int64)
            total[i] += reached[depth]


def unit_scores(data: FoldData, family: Mapping[str, Mapping], seed: int) -> DataFrame:
    """(id, model, label, score) of the fold's held-out rows under every member of a family."""
    names = list(family)
    members = [(family[n].get("n_estimators", 100), family[n].get("max_depth")) for n in names]
    most = max(n for n, _ in members)
    depths = [d for _, d in members]
    params = tree_params({**family[names[0]], "max_depth": None if None in depths else max(depths)})
    if data.shared:
        shared, widths = data.shared, fo.slot_widths(data.cuts)
        weights = fo.class_weights(params, data.label_counts)

        def grow(batches):
            (rows, label, bins), (_, held_label, held_bins), ids = shared.value
            groups = slot_groups(bins, widths)
            for batch in batches:
                for block in batch.column("id").to_pylist():
                    total = np.zeros((len(members), len(held_label)), dtype=np.int64)
                    for number in range(block * BLOCK, min(most, (block + 1) * BLOCK)):
                        tree = grow_tree(rows, bins, label, widths, number, params, seed, weights, groups)
                        _add(total, tree, number, held_bins, members)
                    yield from _sums(names, ids, held_label, total)

        blocks = -(-most // BLOCK)
        sums = data.spark.range(0, blocks, 1, blocks).mapInArrow(grow, data.schema())
    else:
        sums = None
        for first in range(0, most, BLOCK):
            numbers = range(first, min(most, first + BLOCK))
            grown = data.spark.sparkContext.broadcast(
                list(zip(numbers, fo.grow_over_partitions(
                    data.train, data.cuts, numbers, params, seed, blocks=data.blocks, label_counts=data.label_counts))))

            def reach(batches, grown=grown):
                for batch in batches:
                    _, label, bins = matrix(pa.Table.from_batches([batch]))
                    total = np.zeros((len(members), len(label)), dtype=np.int64)
                    for number, tree in grown.value:
                        _add(total, tree, number, bins, members)
                    yield from _sums(names, batch.column("id"), label, total)

            part = materialize(data.test.mapInArrow(reach, data.schema()), "sums")
            sums = part if sums is None else sums.unionAll(part)
    size = F.create_map(*[F.lit(x) for n, (k, _) in zip(names, members) for x in (n, k)])
    summed = sums.groupBy("model", "id", "label").agg(F.sum("total").alias("total"))
    return summed.select("id", "model", "label", (F.col("total") / (F.lit(float(fo.UNIT)) * size[F.col("model")])).alias("score"))


def search_scores(
    folds: Sequence, settings: Mapping[str, Mapping], key: str, target: str, seed: int, parallelism: int = 1,
    journal: str | None = None, most: int = BROADCAST_BYTES,
) -> tuple[DataFrame, list[tuple[str, int, float, float]]]:
    """(scores, times) of all settings on all folds, like `models.fold_scores`.

    Gives a table (id, label, score, model, fold) and (model, fold, fit, score) seconds, where a unit's time
    counts for each of its members and holds growing and scoring. `journal` names the folder; by default it
    follows from the settings and the rows.
    """
    spark = folds[0].train.sparkSession
    journal = journal or journal_path(folds, settings, key, target, seed)
    groups = families(settings)
    units = [(i, fold) for i in range(len(groups)) for fold in folds]
    named = [hashlib.md5(json.dumps(g, sort_keys=True).encode()).hexdigest() for g in groups]
    place = {(i, fold.number): f"{journal}/family={named[i]}/fold={fold.number}" for i, fold in units}
    open_ = [(i, fold) for i, fold in units if not _complete(spark, place[i, fold.number])]
    needed = [fold for fold in folds if any(fold is f for _, f in open_)]
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        data = dict(zip([f.number for f in needed], pool.map(lambda fold: FoldData(fold, key, target, most), needed)))

    def run(unit):
        i, fold = unit
        start = time.perf_counter()
        path = place[i, fold.number]
        scores = unit_scores(data[fold.number], groups[i], seed).withColumn("fold", F.lit(fold.number + 1))
        scores.write.mode("overwrite").parquet(f"{path}/scores")
        seconds = spark.range(1).select(
            F.lit(named[i]).alias("unit"), F.lit(fold.number).alias("part"), F.lit(time.perf_counter() - start).alias("seconds"))
        seconds.write.mode("overwrite").parquet(f"{path}/time")

    # Long units first, so that none is left over at the end.
    open_.sort(key=lambda u: -_work(groups[u[0]]))
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        list(pool.map(run, open_))
    id_type = folds[0].train.schema[key].dataType.simpleString()
    schema = f"id {id_type}, model string, label int, score double, fold int"
    scored = spark.read.schema(schema).parquet(*[f"{place[i, f.number]}/scores" for i, f in units])
    took = spark.read.schema("unit string, part int, seconds double").parquet(*[f"{p}/time" for p in place.values()]).collect()
    seconds = {(r["unit"], r["part"]): r["seconds"] for r in took}
    times = [(name, f.number + 1, seconds[named[i], f.number], 0.0) for i, f in units for name in groups[i]]
    return scored, times
