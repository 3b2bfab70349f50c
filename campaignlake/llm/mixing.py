"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down a tree of levels (here domain, language, source). Every node gives its children
their weights' shares; a child that cannot use its share, because its documents run out after
`max_epochs` passes, leaves the rest to its siblings, and only what no sibling can use goes back to the
level above. A leaf then reads its documents in seeded order, epoch by epoch, up to its budget.

Weights and token counts are integers, so the shares are exact in any engine. The order of an epoch is
that of a seeded digest; the document where a leaf's budget ends is found from token sums by digest
prefix, so no leaf is ever sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.scan import ordered_scan
from ..session import broadcast_checked
from .common import materialize, row_key, text_or_empty, words

# Hex digits of a digest whose token sums locate the end of a leaf's budget.
PREFIX = 3
# Rows that one step of an expansion makes of one row.
BLOCK = 4096


def weight_of(weights: dict[tuple[str, ...], int], path: list[str], default: int) -> Column:
    """Weight of the node that the columns of `path` name; nodes without an entry have the default."""
    own = {k: v for k, v in weights.items() if len(k) == len(path)}
    if not own:
        return F.lit(default).cast("long")
    named = F.create_map(*[F.lit(x) for k, v in sorted(own.items()) for x in ("\x1f".join(k), v)])
    return F.coalesce(F.element_at(named, F.concat_ws("\x1f", *path)), F.lit(default)).cast("long")


def share_out(children: DataFrame, parent: list[str], node: str) -> DataFrame:
    """Budget of each child from its parent's `budget`, its `weight` and its `room` (most it can use).

    Children are filled in the order in which they run out; the others share what is left by weight,
    rounded down. Children without weight get nothing.
    """
    by_parent = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ratio = F.col("room").cast("double") / F.col("weight").cast("double")
    running = by_parent.orderBy(ratio, node).rowsBetween(Window.unboundedPreceding, 0)
    summed = children.where("weight > 0").select(
        "*", F.sum("room").over(running).alias("_room"), F.sum("weight").over(running).alias("_weight"),
        F.sum("weight").over(by_parent).alias("_all"),
    )
    full = summed.withColumn(
        "_full", F.expr("_room * weight + room * (_all - _weight) <= budget * weight")
    )
    rest = full.select(
        "*", F.sum(F.when(F.col("_full"), F.col("room")).otherwise(0)).over(by_parent).alias("_used"),
        F.sum(F.when(~F.col("_full"), F.col("weight")).otherwise(0)).over(by_parent).alias("_open"),
    )
    given = F.when(F.col("_full"), F.col("room")).otherwise(F.expr("(budget - _used) * weight div nullif(_open, 0)"))
    hidden = ["budget", "_room", "_weight", "_all", "_full", "_used", "_open"]
    return rest.withColumn("_given", given).drop(*hidden).withColumnRenamed("_given", "budget")


def leaf_budgets(
    leaves: DataFrame, levels: list[str], weights: dict[tuple[str, ...], int], budget: int, max_epochs: int,
    default_weight: int = 1,
) -> DataFrame:
    """Token budget of every leaf; `leaves` has one row per leaf, its levels and its `supply` of tokens.

    Leaves at or below a node of weight 0 get nothing and are left out, before any room is summed.
    """
    tree = leaves.select(*levels, "supply", (F.col("supply") * max_epochs).alias("room"))
    for depth in range(1, len(levels) + 1):
        tree = tree.where(weight_of(weights, levels[:depth], default_weight) > 0)
    above = None
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = tree.groupBy(*path).agg(F.sum("room").alias("room"), F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", weight_of(weights, path, default_weight))
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("long"))
        else:
            nodes = nodes.join(above.select(*levels[: depth - 1], "budget"), levels[: depth - 1])
        above = share_out(nodes, levels[: depth - 1], levels[depth - 1])
    return above.select(*levels, "supply", "budget")


def digest(seed: int, epoch: Column, id_column: str) -> Column:
    """Sort key of a document in an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(id_column).cast("string")).cast("binary"))


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row of `df` as often as its column `times` says, without that column; no array is longer than the
    row count divided by BLOCK, or than BLOCK."""
    kept = [c for c in df.columns if c != times]
    blocks = df.where(F.col(times) > 0).withColumn("_block", F.explode(F.expr(f"sequence(0, ({times} - 1) div {BLOCK})")))
    inside = F.expr(f"sequence(1, least({BLOCK}, {times} - _block * {BLOCK}))")
    return blocks.select(*kept, F.explode(inside).alias("_at")).drop("_at")


def readings(
    docs: DataFrame, levels: dict[str, Column], weights: dict[tuple[str, ...], int], budget_share: float = 0.6,
    budget: int | None = None, max_epochs: int = 3, seed: int = 17, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """How often each document is read, so that the tokens read meet the target weights.

    `levels` names the tree's levels from the root and gives each as a column. The budget is `budget`
    tokens, or `budget_share` of all tokens. Tokens are words. Returns one row per document that is read:
    key_id, key_text (see `row_key`), the levels, n_tokens, `copies` (rows that share all of these),
    `passes` (whole epochs) and `extra` (copies read once more, in the partial epoch). That epoch takes
    rows in seeded order while their running token sum stays within what is left of the leaf's budget.

    A null or empty text has no tokens and is read where its place in the order is reached. A null level
    is the node "". Repeated rows count in full and stand next to each other in the order, so the budget may
    end between two of them; rows of one id and text but other levels belong to their own leaves. Missing
    ids order by text hash. Texts of any length are read whole. Other columns are not read. An empty table
    gives no rows.
    """
    names = list(levels)
    # Repeated rows meet in the partial aggregation, so a row that repeats very often is one row per task.
    counted = materialize(docs.select(
        *row_key(id_column, text_column),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()],
        F.size(words(text_or_empty(text_column))).cast("long").alias("n_tokens"),
    ).groupBy("key_id", "key_text", *names).agg(
        F.max("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("copies"),
    ).withColumn("leaf", F.concat_ws("\x1f", *names)), "counted")
    leaves = materialize(counted.groupBy(*names).agg(F.sum(F.expr("n_tokens * copies")).alias("supply")), "leaves")
    if budget is None:
        total = leaves.agg(F.sum("supply")).first()[0] or 0
        budget = int(total * round(budget_share * 1_000_000)) // 1_000_000
    plan = leaf_budgets(leaves, names, weights, budget, max_epochs).select(
        F.concat_ws("\x1f", *names).alias("leaf"), F.expr("if(supply > 0, budget div supply, 0)").alias("passes"),
        F.expr("if(supply > 0, budget % supply, 0)").alias("rest"),
    )
    plan = materialize(plan, "plan")
    order = digest(seed, F.col("passes"), "key_id")
    # `plan` and `ends` have one row per leaf. Beyond a broadcast's size, joins go by leaf and by its levels in
    # turn, so that no later grouping leans on a join's placement of rows: a join may then split a large leaf.
    rows = counted.join(broadcast_checked(plan), "leaf").withColumn("place", order).withColumn(
        "slot", F.substring("place", 1, PREFIX))

    # Token sums by leaf and digest prefix, at most 16 ** PREFIX rows per leaf.
    sums = rows.where("rest > 0").groupBy(*names, "slot", "rest").agg(F.sum(F.expr("n_tokens * copies")).alias("n"))
    before = Window.partitionBy(*names).orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    ends = sums.withColumn("upto", F.sum("n").over(before)).where("upto - n <= rest AND rest < upto")
    ends = materialize(ends.select(*names, F.col("slot").alias("last"), (F.col("upto") - F.col("n")).alias("ahead")), "ends")
    placed = rows.join(broadcast_checked(ends), names, "left")

    inside = Window.partitionBy("leaf", "slot").orderBy("place", "key_id", "key_text").rowsBetween(
        Window.unboundedPreceding, 0)
    border = placed.where("slot = last").withColumn(
        "left", F.col("rest") - F.col("ahead") - F.sum(F.expr("n_tokens * copies")).over(inside) + F.expr("n_tokens * copies"))
    fit = F.expr("CASE WHEN left < 0 THEN 0L WHEN n_tokens = 0 THEN copies ELSE least(copies, left div n_tokens) END")
    border = border.withColumn("extra", fit).drop("left")
    other = placed.where("last IS NULL OR slot <> last").withColumn(
        "extra", F.when(F.col("slot") < F.col("last"), F.col("copies")).otherwise(F.lit(0).cast("long")))
    return border.unionByName(other).where("passes > 0 OR extra > 0").select(
        "key_id", "key_text", *names, "n_tokens", "copies", "passes", "extra")


def mix(docs: DataFrame, levels: dict[str, Column], *args, **options) -> DataFrame:
    """The documents that `readings` chooses: one row per row and epoch that reads it.

    Takes the arguments of `readings` and treats all cases as it does. Returns key_id, key_text, the levels,
    n_tokens and epoch.
    """
    read = readings(docs, levels, *args, **options).withColumn(
        "epoch", F.explode(F.expr("sequence(0, cast(passes AS int) - if(extra > 0, 0, 1))")))
    read = read.withColumn("times", F.when(F.col("epoch") < F.col("passes"), F.col("copies")).otherwise(F.col("extra")))
    return repeated(read.select("key_id", "key_text", *levels, "n_tokens", "epoch", "times"), "times")


def mixed_documents(
    docs: DataFrame, levels: dict[str, Column], *args, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The chosen rows of `docs`, all columns unchanged, once per epoch that reads them.

    Takes the arguments of `readings` and treats all cases as it does. Where the budget ends between rows of
    one id, text and leaf that differ in other columns, the order of a hash of the row decides.
    """
    taken, keys = docs.columns, ["key_id", "key_text", *levels]
    read = readings(docs, levels, *args, id_column=id_column, text_column=text_column, **options)
    read = materialize(read.drop("n_tokens"), "readings")
    keyed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in taken]).alias("_row"), *row_key(id_column, text_column),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()],
    )
    # Nothing leans on the join's placement of rows, so it may split a key that repeats very often.
    split = F.expr("extra > 0 AND extra < copies")
    whole = keyed.join(read.where(~split), keys).select("_row", (F.col("passes") + F.expr("if(extra > 0, 1, 0)")).alias("_times"))
    parted = read.where(split)  # at most one document per leaf
    if not parted.isEmpty():
        cut = keyed.join(broadcast_checked(parted), keys).withColumn("_one", F.lit(1).cast("long"))
        cut = cut.withColumn("_hash", F.xxhash64("_row")).withColumn("_place", F.monotonically_increasing_id())
        numbered = ordered_scan(materialize(cut, "cut"), ["_hash", "_place"], keys, sums=["_one"])
        more = F.expr("passes + if(cum__one <= extra, 1, 0)").alias("_times")
        whole = whole.unionByName(numbered.select("_row", more).where("_times > 0"))
    return whole.select(F.explode(F.array_repeat("_row", F.col("_times").cast("int"))).alias("_row")).select(
        *[F.col("_row")[c].alias(c) for c in taken])
