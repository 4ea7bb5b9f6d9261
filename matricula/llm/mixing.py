"""Mixing sources to target weights: budgets down a tree, then a token prefix of seeded epochs from every leaf.

The tree is domain, language, source.  A node's budget is shared among its children by weight; a child that cannot use
its share (all its tokens in the allowed epochs) is filled up and what it leaves goes to its siblings by weight, and
only what all siblings together cannot use was never given to the node: it went to the node's own siblings.  All sums
are whole tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matricula.session import stored

LEVELS = ("domain", "lang", "source")
WIDE = "decimal(38,0)"


def tokens(text: Column) -> Column:
    """Words between white space; null and empty texts have none."""
    line = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(line == "", 0).otherwise(F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("long")


def shares(children: DataFrame, by: list[str], name: str) -> DataFrame:
    """Budgets of children rows (by..., name, weight, cap, parent_budget) as budget.

    In order of cap over weight the children that get less than their share allows come first; they are filled, and the
    rest of the budget is cut at whole tokens along the running weight of the others.  The parent's budget is at most
    the sum of the caps.  Weights are whole and positive; a weight of zero gets nothing before all others are full."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    usual = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0).cast(WIDE)
    rows = children.withColumn("w", usual).withColumn("ratio", F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w").cast("double")).otherwise(F.lit(float("inf"))))
    order = group.orderBy("ratio", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("left_budget", (F.col("parent_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast(WIDE))
    rows = rows.withColumn("left_weight", (F.sum("w").over(group) - F.coalesce(F.sum("w").over(before), F.lit(0))).cast(WIDE))
    rows = rows.withColumn("full", F.when(F.col("left_weight") > 0, F.col("cap").cast(WIDE) * F.col("left_weight") <= F.col("left_budget") * F.col("w")).otherwise(F.col("cap") <= F.col("left_budget")))
    # Once a child is not full none after it is.
    rows = rows.withColumn("full", F.min(F.col("full").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    rest = F.col("parent_budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group)
    open_w = F.when(F.col("full"), 0).otherwise(F.col("w")).cast(WIDE)
    rows = rows.withColumn("rest", rest.cast(WIDE)).withColumn("open_weight", F.sum(open_w).over(group).cast(WIDE)).withColumn("upto", F.sum(open_w).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast(WIDE))
    exact = lambda w: F.expr(f"(rest * ({w})) div open_weight").cast("long")
    share = F.when(F.col("open_weight") > 0, exact("upto") - exact("upto - w")).otherwise(F.lit(0))
    # Children of weight zero take, in order, what is left when all others are full.
    spare = F.when(F.col("open_weight") == 0, F.greatest(F.lit(0), F.least(F.col("cap"), F.col("left_budget").cast("long")))).otherwise(share)
    return rows.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(spare).cast("long")).drop("w", "ratio", "left_budget", "left_weight", "full", "rest", "open_weight", "upto")


def leaf_budgets(sizes: DataFrame, weights: DataFrame, total: Column | int, epochs: int) -> DataFrame:
    """Budgets of leaves: domain, lang, source, n_tokens, budget.

    sizes: the leaves with n_tokens.  weights: path ("domain", "domain/lang" or "domain/lang/source") and weight, at
    most one row each; a node without a row has weight 1.  total: tokens wanted, cut to what the epochs hold."""
    caps = sizes.withColumn("cap", (F.col("n_tokens") * epochs).cast("long"))
    parent, by = caps.agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("all"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("once")), []
    wanted = F.floor(total * F.col("once")).cast("long") if isinstance(total, float) else F.lit(total).cast("long")
    parent = parent.select(F.least(F.col("all"), wanted).cast("long").alias("parent_budget"))
    for depth, level in enumerate(LEVELS, 1):
        path = list(LEVELS[:depth])
        nodes = caps.groupBy(*path).agg(F.sum("cap").alias("cap"), F.sum("n_tokens").alias("n_tokens"))
        nodes = nodes.withColumn("path", F.concat_ws("/", *path)).join(weights.select("path", "weight"), "path", "left").drop("path").withColumn("weight", F.coalesce("weight", F.lit(1)))
        # The root has one row: a stated single row, not a product of tables.
        nodes = nodes.join(parent, by) if by else nodes.join(F.broadcast(parent))
        budget = shares(nodes, by, level)
        by = path
        parent = budget.select(*path, F.col("budget").alias("parent_budget"))
        last = budget
    return last.select(*LEVELS, "n_tokens", "budget")


def mix(docs: DataFrame, weights: DataFrame, domain: Column, total: float | int = 0.5, epochs: int = 3, seed: int = 0) -> DataFrame:
    """The chosen copies: doc_id, lang, source, domain, epoch, n_tokens and the leaf's budget.

    Each leaf reads its documents epoch after epoch, every epoch in an order of its own that the seed fixes, and a copy
    is taken if fewer tokens than the budget come before it.  total: tokens wanted, or as a float a share of the tokens
    there are.  Null domain, lang or source count as "none"; documents without tokens are never taken; rows with equal
    id and text share one place in the order and are taken together.

    No leaf is sorted as a whole: documents fall into 4096 slices by the first digits of their order, the slices' sums
    say which one holds the budget's end, and only that slice's documents are ordered."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", *[F.coalesce(c, F.lit("none")).alias(n) for n, c in zip(LEVELS, (domain, F.col("lang"), F.col("source")), strict=True)],
                       F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text)).alias("own"), tokens(F.col("text")).alias("n_tokens")).where("n_tokens > 0")
    # Repeated rows become one with a count; written once, it is read by the sizes and the choice.
    rows = stored(rows.groupBy("doc_id", *LEVELS, "own").agg(F.first("n_tokens").alias("one"), F.count("*").alias("times")).withColumn("n_tokens", F.col("one") * F.col("times")), "mix")
    sizes = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n_tokens"))
    leaves = stored(leaf_budgets(sizes, weights, total, epochs), "leaves").where("budget > 0")
    leaves = leaves.withColumn("whole", F.expr("budget div n_tokens").cast("int")).withColumn("part", F.expr("budget % n_tokens")).drop("n_tokens")
    placed = rows.join(leaves, list(LEVELS))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), "own"))
    cutting = placed.where("part > 0").withColumn("place", order).withColumn("slice", F.substring("place", 1, 3))
    sums = cutting.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").alias("in_slice"))
    by_leaf = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("slice_begin", F.coalesce(F.sum("in_slice").over(by_leaf), F.lit(0)))
    # Whole slices before the cut are taken; the slice with the cut is ordered document by document.
    near = cutting.join(sums, [*LEVELS, "slice"]).where("slice_begin < part")
    taken = near.where("slice_begin + in_slice <= part").select("doc_id", *LEVELS, "own")
    in_order = Window.partitionBy(*LEVELS).orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = near.where("slice_begin + in_slice > part").withColumn("begin", F.col("slice_begin") + F.coalesce(F.sum("n_tokens").over(in_order), F.lit(0)))
    taken = taken.unionByName(cut.where("begin < part").select("doc_id", *LEVELS, "own"))
    last = placed.join(taken.select(*[F.col(c).alias(f"t_{c}") for c in ("doc_id", *LEVELS, "own")]),
                       F.col("doc_id").eqNullSafe(F.col("t_doc_id")) & (F.col("own") == F.col("t_own")) & (F.col("domain") == F.col("t_domain")) & (F.col("lang") == F.col("t_lang")) & (F.col("source") == F.col("t_source")), "left_semi")
    full = placed.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
    chosen = full.unionByName(last.withColumn("epoch", F.col("whole")))
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "doc_id", "domain", "lang", "source", F.col("epoch").cast("int").alias("epoch"), F.col("one").alias("n_tokens"), F.col("budget"))
