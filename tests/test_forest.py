import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from campaignlake.operators import evaluation as e
from campaignlake.operators import forest as fo
from campaignlake.operators import models as m
from campaignlake.operators import tuning

PARAMS = [
    fo.TreeParams(6, 2, 1, "sqrt", None, "balanced"),
    fo.TreeParams(None, 10, 3, 0.5, 0.7, "balanced_subsample"),
    fo.TreeParams(9, 2, 5, "log2", 0.85, None),
]


@pytest.fixture(scope="module")
def signal(spark):
    """(id, label, features): two informative columns of six, one of them with few values."""
    i = F.col("id")
    h = [F.pmod(F.xxhash64(i, F.lit(k)), F.lit(1000)) / 1000 for k in range(7)]
    df = spark.range(4000).select("id", *[x.alias(f"x{k}") for k, x in enumerate(h[:4])], (h[4] > 0.7).cast("double").alias("x4"),
                                  F.floor(h[5] * 4).cast("double").alias("x5"), h[6].alias("noise"))
    df = df.withColumn("label", (F.col("noise") < 0.05 + 0.5 * (F.col("x0") > 0.6).cast("int") * (F.col("x4") + 0.3)).cast("int"))
    return VectorAssembler(inputCols=[f"x{k}" for k in range(6)], outputCol="features").transform(df).select(
        "id", "label", "features").persist()


@pytest.fixture(scope="module")
def data(spark, signal):
    cuts = fo.learn_cuts(signal)
    rows = fo.materialize(fo.binned(signal, cuts, "id", "label"), "binned")
    return cuts, rows, fo.matrix(rows.toArrow())


def test_cuts_are_distinct_values_or_quantiles(signal, data):
    cuts, _, (_, _, bins) = data
    assert cuts[4].tolist() == [0.0] and cuts[5].tolist() == [0.0, 1.0, 2.0]
    assert all(len(c) == fo.BINS - 1 for c in cuts[:4])
    sizes = np.bincount(bins[:, 0].astype(int), minlength=fo.BINS)
    assert sizes.min() > 60 and sizes.sum() == 4000


def test_bags_are_poisson_and_seeded():
    rows = np.arange(50_000, dtype=np.int64)
    bag = fo.bag(rows, 3, 0.7, 42)
    assert abs(bag.mean() - 0.7) < 0.02 and abs(bag.var() - 0.7) < 0.03
    assert (bag == fo.bag(rows, 3, 0.7, 42)).all() and (bag != fo.bag(rows, 4, 0.7, 42)).any()
    assert (fo.bag(rows[::-1].copy(), 3, 0.7, 42)[::-1] == bag).all()


def plain_tree(rows, bins, label, widths, number, p, seed, weights):
    """A tree as nested dicts, one node at a time; the open features come from the operator's own draws."""
    weight = fo.bag(rows, number, p.max_samples or 1.0, seed)
    if weights is None:
        drawn = [weight[label == c].sum() for c in (0, 1)]
        weights = [sum(drawn) / (2 * d) for d in drawn]
    probe = fo.Growth(number, widths, p, seed, (1.0, 1.0))

    def purity(of):
        a, b = (weights[c] * weight[of][label[of] == c].sum() for c in (0, 1))
        return (a * a + b * b) / (a + b) if a + b else 0.0

    def grow(of, path, level):
        a, b = (weights[c] * weight[of][label[of] == c].sum() for c in (0, 1))
        node = {"value": b / (a + b)}
        if (p.max_depth is not None and level >= p.max_depth) or len(of) < max(2, p.min_samples_split) or not a or not b:
            return node
        probe.feature, probe.open, probe.paths = np.full(1, -1), np.zeros(1, dtype=np.int64), np.array([path], dtype=np.uint64)
        probe._lay_out()
        best, found = purity(of) * (1 + 1e-12), None
        for f in probe.features[0]:
            for cut in range(widths[f]):
                left, right = of[bins[of, f] <= cut], of[bins[of, f] > cut]
                if min(len(left), len(right)) >= p.min_samples_leaf and purity(left) + purity(right) > best * (1 + 1e-11):
                    best, found = purity(left) + purity(right), (f, cut, left, right)
        if found:
            f, cut, left, right = found
            node |= {"feature": f, "cut": cut, "left": grow(left, 2 * path, level + 1), "right": grow(right, 2 * path + 1, level + 1)}
        return node

    return grow(np.flatnonzero(weight), 1, 0)


@pytest.mark.parametrize("p", PARAMS)
def test_trees_equal_a_plain_recursion(data, p):
    cuts, _, (rows, label, bins) = data
    widths = fo.slot_widths(cuts)
    rows, label, bins = rows[:700], label[:700], bins[:700]
    weights = fo.class_weights(p, {c: int((label == c).sum()) for c in (0, 1)})
    for number in range(3):
        tree = fo.grow_tree(rows, bins, label, widths, number, p, 7, weights)
        plain = plain_tree(rows, bins, label, widths, number, p, 7, weights)

        def same(node, i):
            assert tree.value[i] == pytest.approx(node["value"])
            assert (tree.feature[i] >= 0) == ("feature" in node)
            if "feature" in node:
                assert (tree.feature[i], tree.cut[i]) == (node["feature"], node["cut"])
                same(node["left"], tree.child[i])
                same(node["right"], tree.child[i] + 1)

        same(plain, 0)


@pytest.mark.parametrize("p", PARAMS)
def test_both_ways_grow_the_same_trees(data, p):
    cuts, rows, _ = data
    whole = fo.grow_trees(rows, cuts, 5, p, 42, block=2)
    spread = fo.grow_over_partitions(rows.repartition(5), cuts, range(5), p, 42, chunk=3)
    for a, b in zip(whole, spread):
        for name in ("feature", "cut", "child", "value", "level"):
            assert np.array_equal(getattr(a, name), getattr(b, name))


def test_settings_hold(data):
    cuts, rows, (number, label, bins) = data
    for p in PARAMS:
        for tree in fo.grow_trees(rows, cuts, 3, p, 1):
            assert p.max_depth is None or tree.level.max() <= p.max_depth
    split = fo.grow_trees(rows, cuts, 1, fo.TreeParams(min_samples_split=400), 1)[0]
    free = fo.grow_trees(rows, cuts, 1, fo.TreeParams(), 1)[0]
    assert len(split.feature) < len(free.feature) / 4


def test_a_cut_tree_is_the_shallower_tree(data):
    cuts, rows, (_, _, bins) = data
    deep = fo.grow_trees(rows, cuts, 4, fo.TreeParams(12, class_weight="balanced"), 3)
    flat = fo.grow_trees(rows, cuts, 2, fo.TreeParams(5, class_weight="balanced"), 3)
    for a, b in zip(deep, flat):
        assert np.array_equal(a.reach(bins, 5), b.reach(bins))


def test_model_scores_saves_and_learns(spark, signal, tmp_path):
    train, test = signal.where("id % 4 <> 0"), signal.where("id % 4 = 0")
    spec = m.ModelSpec("bagged", "bagged", True, {"n_estimators": 40, "max_depth": 8, "min_samples_leaf": 5})
    model = m.fit_classifier(spec, train, "label", key="id")
    scored = m.score(model, test).select("id", "label", "score")
    auc = e.probability_metrics(scored).first()["roc_auc"]
    spark_auc = e.probability_metrics(m.score(
        m.fit_classifier(m.ModelSpec("forest", "forest", True, spec.params), train, "label", key="id"), test
    ).select("id", "label", "score")).first()["roc_auc"]
    assert auc > 0.7 and auc > spark_auc - 0.02
    model.save(spark, f"{tmp_path}/forest")
    again = m.score(fo.ForestModel.load(spark, f"{tmp_path}/forest"), test)
    assert again.join(scored.select("id", F.col("score").alias("other")), "id").where("score <> other").count() == 0
    spread = fo.fit_forest(train, "id", "label", 40, tuning.tree_params({"class_weight": "balanced", **spec.params}), 42, most=0)
    assert m.score(spread, test).join(scored.select("id", F.col("score").alias("other")), "id").where("score <> other").count() == 0
    with pytest.raises(ValueError, match="key"):
        m.fit_classifier(spec, train, "label")


def test_bag_table_counts(spark, signal):
    rows = fo.bag_table(signal.repartition(7), "id", "label", 6, 0.85, 42).collect()
    assert len(rows) == 12
    for t in range(6):
        draws = {r["label"]: r["draws"] for r in rows if r["tree"] == t}
        for r in rows:
            if r["tree"] == t:
                assert r["class_weight"] == sum(draws.values()) / (2 * draws[r["label"]])


SETTINGS = {
    "a": {"n_estimators": 6, "max_depth": 3, "min_samples_leaf": 2}, "b": {"n_estimators": 45, "max_depth": None, "min_samples_leaf": 2},
    "c": {"n_estimators": 8, "max_depth": 4, "min_samples_leaf": 2, "class_weight": "balanced_subsample", "min_samples_split": 20},
}


def folds_of(signal):
    return [m.Fold(k, signal.where(F.col("id") % 2 != k), signal.where(F.col("id") % 2 == k)) for k in range(2)]


def scores_of(scored):
    return {(r["model"], r["fold"], r["id"]): (r["label"], r["score"]) for r in scored.collect()}


def test_families_share_trees(signal, tmp_path):
    assert [sorted(x) for x in tuning.families(SETTINGS)] == [["a", "b"], ["c"]]
    folds = folds_of(signal)
    scored, times = tuning.search_scores(folds, SETTINGS, "id", "label", 5, 2, f"{tmp_path}/all")
    assert sorted(t[:2] for t in times) == [(x, k) for x in "abc" for k in (1, 2)]
    found = scores_of(scored)
    assert len(found) == 3 * 4000
    for name in "ac":  # alone, a setting gives the scores that it gives in its family
        alone = scores_of(tuning.search_scores(folds, {name: SETTINGS[name]}, "id", "label", 5, 1, f"{tmp_path}/{name}")[0])
        assert alone == {k: v for k, v in found.items() if k[0] == name}
    over = scores_of(tuning.search_scores(folds, {"c": SETTINGS["c"]}, "id", "label", 5, 1, f"{tmp_path}/over", most=0)[0])
    assert over == {k: v for k, v in found.items() if k[0] == "c"}


def test_a_stopped_search_resumes_to_the_same_table(signal, tmp_path, monkeypatch):
    folds, done = folds_of(signal), []
    real = tuning.unit_scores

    def stops(data, family, seed):
        if len(done) == 2:
            raise RuntimeError("executor lost")
        done.append((data.number, tuple(family)))
        return real(data, family, seed)

    monkeypatch.setattr(tuning, "unit_scores", stops)
    with pytest.raises(RuntimeError):
        tuning.search_scores(folds, SETTINGS, "id", "label", 5, 1, f"{tmp_path}/journal")
    again = []
    monkeypatch.setattr(tuning, "unit_scores", lambda data, family, seed: again.append((data.number, tuple(family))) or real(data, family, seed))
    resumed, _ = tuning.search_scores(folds, SETTINGS, "id", "label", 5, 1, f"{tmp_path}/journal")
    assert len(again) == 2 and not set(again) & set(done)
    whole, _ = tuning.search_scores(folds, SETTINGS, "id", "label", 5, 1, f"{tmp_path}/whole")
    assert scores_of(resumed) == scores_of(whole)


def test_journals_differ_by_rows_and_settings(signal):
    folds = folds_of(signal)
    path = tuning.journal_path(folds, SETTINGS, "id", "label", 5)
    assert path == tuning.journal_path(folds_of(signal.repartition(3)), SETTINGS, "id", "label", 5)
    assert path != tuning.journal_path(folds, SETTINGS, "id", "label", 6)
    assert path != tuning.journal_path(folds_of(signal.where("id <> 9")), SETTINGS, "id", "label", 5)


def test_batches_are_counted_together():
    batches = [fo.pa.RecordBatch.from_pydict({"row": list(range(i, i + 3))}) for i in range(0, 15, 3)]
    tables = list(fo.joined(iter(batches), 6))
    assert [t.num_rows for t in tables] == [6, 6, 3]
    assert [x for t in tables for x in t.column("row").to_pylist()] == list(range(15))


def test_bags_count_the_steps_that_a_draw_reaches():
    rows = np.arange(50_000)
    for rate in (0.7, 0.85, 1.0):
        salt = np.uint64(((42 * fo._ROW) ^ (3 * fo._TREE)) & (2**64 - 1))
        draw = fo.hashed(fo.hashed(rows.view(np.uint64)) ^ salt) >> np.uint64(11)
        plain = np.searchsorted(np.array(fo.poisson_cuts(rate), dtype=np.uint64), draw, side="right")
        assert (fo.bag(rows, 3, rate, 42) == plain).all()


def one_hot(n=3000):
    """(rows, bins, label, widths): two wide slots, two categories of one-hot slots, a flag and a constant slot."""
    rows = np.arange(n)
    h = [fo.hashed(rows + 7919 * k) >> np.uint64(40) for k in range(6)]
    a, b = (h[2] % np.uint64(4)).astype(int), (h[3] % np.uint64(30)).astype(int)
    bins = np.column_stack([h[0] % np.uint64(32), h[1] % np.uint64(5), np.eye(4)[a], np.eye(30)[b], h[4] % np.uint64(9) == 0, np.zeros(n)])
    bins = np.ascontiguousarray(bins, dtype=np.uint8)
    label = ((h[5] % np.uint64(100)) < 20 + 30 * (bins[:, 0] > 20) * (a == 1) + 20 * (b < 9)).astype(np.int32)
    return rows, bins, label, np.array([32, 5, *[2] * 35, 1])


@pytest.mark.parametrize("times", [1, 1 << 14])  # few draws, whose counts share a number, and too many for that
@pytest.mark.parametrize("p", PARAMS)
def test_counting_all_slots_grows_the_trees_of_the_drawn_ones(monkeypatch, p, times):
    rows, bins, label, widths = one_hot()
    real = fo.bag
    monkeypatch.setattr(fo, "bag", lambda *x: real(*x) * times)
    weights = fo.class_weights(p, {c: int((label == c).sum()) for c in (0, 1)})
    for number in range(3):
        monkeypatch.setattr(fo, "MOST_GROUPS", 100)
        found = fo.grow_tree(rows, bins, label, widths, number, p, 7, weights)
        monkeypatch.setattr(fo, "MOST_GROUPS", 0)
        drawn = fo.grow_tree(rows, bins, label, widths, number, p, 7, weights)
        assert len(found.feature) > 20
        for name in ("feature", "cut", "child", "value", "level"):
            assert np.array_equal(getattr(found, name), getattr(drawn, name))


def test_slots_of_a_category_are_one_value():
    rows, bins, label, widths = one_hot()
    groups = fo.slot_groups(bins, widths)
    assert sum(1 if left is None else left.shape[1] for _, _, left in groups) == len(widths)
    assert len(groups) <= 5
    for first, value, left in groups:
        if left is not None:
            assert len(left) <= fo.GROUP_VALUES
            assert np.array_equal(1 - left[value], bins[:, first:first + left.shape[1]])


def test_only_the_smaller_child_is_counted(monkeypatch):
    rows, bins, label, widths = one_hot()
    counted, real = [], fo.Sums.of
    monkeypatch.setattr(fo.Sums, "of", lambda self, rows, node, nodes: counted.append(len(rows)) or real(self, rows, node, nodes))
    tree = fo.grow_tree(rows, bins, label, widths, 0, fo.TreeParams(8, max_features=0.5), 7, (1.0, 1.0))
    assert tree.level.max() == 8 and len(counted) == 8
    assert max(counted[1:]) <= counted[0] / 2


def test_a_split_size_that_leaves_rule_out_sets_no_family_apart():
    a = {"n_estimators": 3, "min_samples_leaf": 20, "min_samples_split": 5}
    b, c = {**a, "min_samples_split": 10, "n_estimators": 5}, {**a, "min_samples_split": 41}
    assert [sorted(x) for x in tuning.families({"a": a, "b": b, "c": c})] == [["a", "b"], ["c"]]


def test_workers_need_not_have_the_package(tmp_path):
    sent = cloudpickle.dumps((fo.grow_tree, tuning._add, tuning._sums))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    load = "import pickle, sys; pickle.load(sys.stdin.buffer); assert 'campaignlake' not in sys.modules"
    subprocess.run([sys.executable, "-c", load], input=sent, cwd=tmp_path, env=env, check=True)


def test_passes_over_blocks_count_the_smaller_children(data, monkeypatch):
    cuts, rows, (number, label, bins) = data
    blocks = fo.packed(rows.repartition(3), cuts)
    found = [x for batch in blocks.toArrow().to_batches() for x in fo._blocks([batch], len(cuts))]
    assert len(found) == 3 and sorted(np.concatenate([x[0] for x in found])) == sorted(number)
    counted, grow = [], fo.Spread.grow

    def record(spread, pieces):
        counted.append((spread.counting.every, spread.counting.nodes, len(spread.growth.open), spread.growth.level_now))
        grow(spread, pieces)

    monkeypatch.setattr(fo.Spread, "grow", record)
    p = fo.TreeParams(5, 2, 3, "sqrt", 0.7, "balanced_subsample")
    whole = fo.grow_trees(rows, cuts, 3, p, 42)
    kept = fo.SUM_BYTES
    # All levels, none, and the first ones: two open nodes take more than 2,500 bytes a tree.
    for most, levels in ((kept, 5), (0, 0), (3 * 5000, 1)):
        counted.clear()
        monkeypatch.setattr(fo, "SUM_BYTES", most)
        trees = fo.grow_over_partitions(rows, cuts, range(3), p, 42, chunk=2, blocks=blocks)
        assert all(every == (level < levels) for every, _, _, level in counted)
        assert all(nodes <= max(1, 2 ** level // 2) for every, nodes, _, level in counted if every)
        for a, b in zip(whole, trees):
            assert all(np.array_equal(getattr(a, x), getattr(b, x)) for x in ("feature", "cut", "child", "value", "level"))
