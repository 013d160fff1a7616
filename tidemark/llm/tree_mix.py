"""Mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree (domain, language, source). A token budget is spread from the
root: at each node its children share the budget by weight, but no child gets more than
its subtree holds (tokens times ``max_epochs``). What a child cannot take goes to its
siblings by weight; only if all siblings are full does the budget of the parent itself
fall short, and then the parent's siblings share it, because every level is filled with
the capacities of whole subtrees.

A leaf with budget ``b`` and ``a`` tokens gives ``b div a`` whole epochs, and from the
next epoch the longest prefix, in that epoch's own seeded order, that fits into the rest.

Scale: the leaf totals are one map-side combined aggregate. The prefix is found in two
steps, so a leaf with a third of all rows is never sorted in one task: the order's hash
space is cut into slices of about ``slice_rows`` rows, the slices' token sums are added
up in order, and only the single slice in which the budget runs out is looked at row by
row. What remains is one cutoff per leaf, so texts are filtered where they are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, hash60, stage

MAX_BROADCAST_LEAVES = 200_000  # leaf rows are under 200 bytes
_SPACE = 1 << 60


@dataclass(frozen=True)
class Mix:
    """``weights`` maps a node's path ('news', 'news/en', 'news/en/src1') to an integer weight.

    Nodes that are not listed weigh ``default_weight``; weight 0 excludes a subtree. The
    budget is ``budget`` tokens, or ``budget_percent`` of all tokens if ``budget`` is None.
    """

    weights: dict[str, int] = field(default_factory=dict)
    default_weight: int = 100
    budget: int | None = None
    budget_percent: int = 100
    max_epochs: int = 1
    seed: int = 0
    slice_rows: int = 1024


def step_name(level: Column) -> Column:
    """A level's part of a node path. NULL is '', '/' inside a value is doubled."""
    return F.coalesce(F.replace(level.cast("string"), F.lit("/"), F.lit("//")), F.lit(""))


def _weight(mix: Mix, path: str) -> Column:
    w = F.lit(mix.default_weight).cast("long")
    if not mix.weights:
        return w
    pairs = [x for k, v in sorted(mix.weights.items()) for x in (F.lit(k), F.lit(v).cast("long"))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(path)), w)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def water_fill(nodes: DataFrame, parent: str, budget: str) -> DataFrame:
    """Adds ``share``: the node's part of its parent's ``budget``.

    ``nodes`` has ``parent``, ``path``, ``capacity``, ``weight`` and ``budget``. Nodes are
    taken by capacity per weight; a node is full if the budget left for it and the later
    ones, split by weight, covers its capacity. The others split the rest by weight, with
    cumulative rounding, so the shares add up to the whole.
    """
    order = Window.partitionBy(parent).orderBy("fill", "path")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    zero, big = F.lit(0).cast("long"), "decimal(18,0)"
    n = nodes.filter((F.col("weight") > 0) & (F.col("capacity") > 0))
    n = n.withColumn("fill", F.col("capacity").cast("double") / F.col("weight"))
    n = (n.withColumn("left_over", F.greatest(
            F.col(budget) - F.coalesce(F.sum("capacity").over(before), zero), zero))
         .withColumn("w_later", F.sum("weight").over(later)))
    n = n.withColumn("full", F.col("left_over").cast(big) * F.col("weight").cast(big)
                     >= F.col("capacity").cast(big) * F.col("w_later").cast(big))
    group = Window.partitionBy(parent)
    open_w = F.when(~F.col("full"), F.col("weight")).otherwise(zero)
    n = (n.withColumn("rest", F.max(F.when(~F.col("full"), F.col("left_over"))).over(group))
         .withColumn("w_open", F.sum(open_w).over(group))
         .withColumn("w_upto", F.sum(open_w).over(order.rowsBetween(Window.unboundedPreceding, 0))))
    rest = F.col("rest").cast(big)
    upto = _div(rest * F.col("w_upto").cast(big), F.col("w_open").cast(big))
    prior = _div(rest * (F.col("w_upto") - F.col("weight")).cast(big), F.col("w_open").cast(big))
    share = F.when(F.col("full"), F.col("capacity")).otherwise((upto - prior).cast("long"))
    return n.withColumn("share", share).drop("fill", "left_over", "w_later", "full", "rest", "w_open", "w_upto")


def leaf_budgets(leaves: DataFrame, levels: list[str], mix: Mix) -> DataFrame:
    """``leaves`` (levels, ``available`` tokens, ``docs``) plus ``budget``, ``epochs``, ``rest``."""
    depth = len(levels)
    for i in range(depth):
        leaves = leaves.withColumn(f"p{i + 1}", F.concat_ws("/", *[step_name(F.col(c)) for c in levels[:i + 1]]))
    leaves = leaves.withColumn("p0", F.lit("")).withColumn(
        "capacity", F.col("available") * mix.max_epochs)
    for i in range(1, depth + 1):  # an excluded subtree holds nothing for its ancestors
        leaves = leaves.withColumn("capacity", F.when(_weight(mix, f"p{i}") > 0, F.col("capacity")).otherwise(0))
    budgets = None
    for i in range(1, depth + 1):
        nodes = leaves.groupBy(f"p{i - 1}", f"p{i}").agg(
            F.sum("capacity").alias("capacity"), F.sum("available").alias("held"))
        nodes = nodes.withColumn("path", F.col(f"p{i}")).withColumn("weight", _weight(mix, "path"))
        if budgets is None:  # the root's budget
            held = F.sum("held").over(Window.partitionBy("p0"))
            nodes = nodes.withColumn("budget", F.lit(mix.budget).cast("long") if mix.budget is not None
                                     else _div(held * mix.budget_percent, F.lit(100).cast("long")))
        else:
            nodes = nodes.join(budgets, f"p{i - 1}")
        budgets = water_fill(nodes, f"p{i - 1}", "budget").select(f"p{i}", F.col("share").alias("budget"))
    leaf = f"p{depth}"
    out = leaves.join(budgets, leaf, "left").withColumn("budget", F.coalesce("budget", F.lit(0).cast("long")))
    whole = F.when(F.col("available") > 0, _div(F.col("budget"), F.col("available"))).otherwise(0).cast("long")
    return (out.withColumn("epochs", whole)
            .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available"))
            .select(F.col(leaf).alias("leaf"), "available", "docs", "budget", "epochs", "rest"))


def epoch_order(mix: Mix, epoch: Column, key: Column) -> Column:
    """Place of a document in an epoch's seeded order."""
    return hash60(F.lit(mix.seed), epoch, key)


def cutoffs(rows: DataFrame, leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` plus ``cutoff``: documents at or before it belong to the last epoch's prefix.

    ``rows`` has ``leaf``, ``key`` and ``tokens``. Rows of equal place (repeated keys) count
    as one unit, taken together or not at all.
    """
    slices = F.greatest(_div(F.col("docs"), F.lit(mix.slice_rows).cast("long")), F.lit(1).cast("long"))
    width = _div(F.lit(_SPACE).cast("long"), slices) + 1
    part = leaves.filter("rest > 0").select("leaf", "epochs", "rest", width.alias("width"))
    units = (rows.join(part, "leaf")
             .withColumn("place", epoch_order(mix, F.col("epochs"), F.col("key")))
             .withColumn("slice", _div(F.col("place"), F.col("width"))))
    sums = units.groupBy("leaf", "rest", "width", "slice").agg(F.sum("tokens").alias("tokens"))
    upto = Window.partitionBy("leaf").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("tokens").over(upto))
    # First slice in which the budget runs out, and what is left when it starts.
    edge = sums.filter("upto > rest").groupBy("leaf").agg(
        F.min(F.struct("slice", "upto", "tokens", "rest", "width")).alias("e")).select(
        "leaf", F.col("e.slice").alias("slice"),
        (F.col("e.rest") - F.col("e.upto") + F.col("e.tokens")).alias("room"),
        (F.col("e.slice") * F.col("e.width") - 1).alias("before"))
    edge = stage(edge)
    inside = (units.join(_few(edge), ["leaf", "slice"])
              .groupBy("leaf", "room", "place").agg(F.sum("tokens").alias("tokens")))
    run = Window.partitionBy("leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = (inside.withColumn("used", F.sum("tokens").over(run)).filter("used <= room")
            .groupBy("leaf").agg(F.max("place").alias("last")))
    found = edge.join(last, "leaf", "left").select("leaf", F.coalesce("last", "before").alias("found"))
    everything = F.when(F.col("rest") > 0, F.lit(_SPACE).cast("long")).otherwise(F.lit(-1).cast("long"))
    return leaves.join(found, "leaf", "left").withColumn(
        "cutoff", F.coalesce("found", everything)).drop("found")


def _few(leaves: DataFrame) -> DataFrame:
    return F.broadcast(leaves) if leaves.count() <= MAX_BROADCAST_LEAVES else leaves


def plan_mix(rows: DataFrame, levels: list[str], mix: Mix) -> DataFrame:
    """Budgets and cutoffs per leaf for staged ``rows`` (levels, ``leaf``, ``key``, ``tokens``)."""
    totals = rows.groupBy(*levels, "leaf").agg(
        F.sum("tokens").alias("available"), F.count("*").alias("docs"))
    leaves = stage(leaf_budgets(totals.drop("leaf"), levels, mix))
    return stage(cutoffs(rows.select("leaf", "key", "tokens"), _few(leaves), mix))


def copies(mix: Mix, key: Column) -> Column:
    """How often a document is taken, given the joined row of its leaf."""
    extra = (epoch_order(mix, F.col("epochs"), key) <= F.col("cutoff")).cast("long")
    return F.coalesce(F.col("epochs") + extra, F.lit(0).cast("long"))


def _leaf(levels: dict[str, Column]) -> Column:
    return F.concat_ws("/", *[step_name(c) for c in levels.values()])


def _narrow(docs: DataFrame, levels: dict[str, Column], key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return stage(docs.select(
        F.col(f"`{key}`").alias("key"), *[c.alias(n) for n, c in levels.items()],
        _leaf(levels).alias("leaf"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("tokens")))


def mix_rows(docs: DataFrame, levels: dict[str, Column], mix: Mix, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its leaf, tokens, the leaf's budget and ``copies``.

    Tokens are words. NULL texts have none and are taken with their place in the order.
    NULL levels form nodes of their own. An empty table gives an empty result; other
    columns of ``docs`` are ignored.
    """
    rows = _narrow(docs, levels, key, text)
    plan = plan_mix(rows, list(levels), mix)
    out = rows.join(_few(plan), "leaf", "left")
    return out.select(F.col("key").alias("doc_id"), *levels, "tokens", F.col("budget").alias("leaf_budget"),
                      copies(mix, F.col("key")).alias("copies"))


def mixed(docs: DataFrame, levels: dict[str, Column], mix: Mix, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its ``copies``, own columns only."""
    plan = plan_mix(_narrow(docs, levels, key, text), list(levels), mix)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        F.col(f"`{key}`").alias("key"), _leaf(levels).alias("leaf"))
    out = whole.join(_few(plan), "leaf").withColumn("copies", copies(mix, F.col("key"))).filter("copies > 0")
    if mix.max_epochs > 1:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select("doc.*")
