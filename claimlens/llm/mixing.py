"""Mixing sources to target weights by hierarchical budgeting.

A budget of tokens goes down a tree (domain, language, source). At each node it is shared among the
children by their weights; a child that cannot use its share keeps what it can supply, and
its shortage is shared among its siblings by their weights, and so on. A parent's own supply
is the sum of its children's, so a shortage reaches an ancestor's siblings only when all
siblings below are used up. Each leaf then gives whole epochs of its documents and a
token-prefix of one more, in an order seeded by epoch.

All of it is DataFrame windows and joins over sums; the texts are never shuffled, as a
prefix is a cutoff in the seeded order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stored

BUCKET_DIGITS = 3  # hex digits of the seeded key that name a bucket of a leaf
NONE = "(none)"


def word_tokens(text: Column) -> Column:
    """Words between ASCII blanks, the default measure of a document's tokens."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(1)
    for value, w in sorted(weights.get(level, {}).items()):
        out = F.when(F.col(level) == value, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def _share(children: DataFrame, parents: list[str], level: str) -> DataFrame:
    """``budget`` of each child: water-filling of the parent's budget ``given`` among siblings.

    ``supply`` bounds a child. In order of supply per weight, a child is used up while its
    fair share of what is left reaches its supply; the others share the rest by weight,
    rounded down.
    """
    big = "decimal(38,0)"
    order = [F.col("supply") / F.col("weight"), F.col(level)]
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    after = group.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    used_up = F.col("supply").cast(big) * F.col("weight_left") <= (F.col("given") - F.col("supply_before")).cast(big) * F.col("weight")
    return (
        children.withColumn("weight_left", F.sum("weight").over(after))
        .withColumn("supply_before", F.coalesce(F.sum("supply").over(before), F.lit(0)))
        .withColumn("used_up", F.coalesce(used_up, F.lit(False)))
        .withColumn("taken", F.coalesce(F.sum(F.when(F.col("used_up"), F.col("supply"))).over(group), F.lit(0)))
        .withColumn("open", F.sum(F.when(~F.col("used_up"), F.col("weight"))).over(group))
        .withColumn(
            "budget",
            F.when(F.col("used_up"), F.col("supply"))
            .otherwise(F.expr(f"cast(cast(given - taken as {big}) * weight div open as long)")),
        )
        .drop("weight_left", "supply_before", "used_up", "taken", "open")
    )


def leaf_budgets(
    supplies: DataFrame, levels: list[str], weights: Mapping[str, Mapping[str, int]], target_percent: int, max_epochs: int
) -> DataFrame:
    """``levels..., tokens, budget`` for each leaf of ``supplies(levels..., tokens)``."""
    leaves = supplies.withColumn("supply", F.col("tokens") * max_epochs)
    # sums of each inner node, from the leaves (at most as many rows as leaves)
    current = None
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = leaves.groupBy(*path).agg(F.sum("supply").alias("supply"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", _weight(path[-1], weights))
        if current is None:
            whole = Window.partitionBy(F.lit(0))
            target = F.expr(f"sum(tokens) over (partition by 0) * {int(target_percent)} div 100")
            nodes = nodes.withColumn("given", F.least(target, F.sum("supply").over(whole)))
        else:
            nodes = nodes.join(current.select(*path[:-1], F.col("budget").alias("given")), path[:-1])
        current = _share(nodes, path[:-1], path[-1])
    return current.select(*levels, "tokens", "budget")


def _seeded(ident: Column, seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), ident))


def mix_sources(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, int]],
    target_percent: int = 50,
    max_epochs: int = 2,
    seed: int = 17,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with two more columns: ``n_tokens`` and ``copies`` (rows taken, 1 or more).

    ``levels`` names the tree from the root down, each with its column; ``weights`` gives the
    integer weights of a level's values (others weigh 1). The budget is ``target_percent`` of
    all tokens. A leaf with budget b and supply s gives b div s whole epochs (at most
    ``max_epochs``) and, of the next epoch's seeded order, the longest prefix within the
    remaining b mod s tokens.

    The order is by md5 of seed, epoch, id and the text's md5, so it ignores partitioning.
    Repeated rows tie and are taken together or not at all. A null level value is the
    leaf "(none)", a null text has no tokens; documents without tokens go with their
    place in the order, and a leaf without any token is left out. Existing columns
    ``n_tokens`` and ``copies`` are replaced. An empty table gives no rows.

    Skew: sums are combined map-side; a leaf's order is cut by buckets of the md5, and only
    the bucket in which the prefix ends is sorted, so a leaf with a third of all rows costs
    a group of a 4,096th of it. Texts are read twice and joined with the leaf table (one row a leaf).
    """
    names = [fresh(docs, f"level_{n}") for n in levels]
    ident, tok, key = fresh(docs, "mix_ident"), fresh(docs, "mix_tokens"), fresh(docs, "mix_key")
    text = F.col(f"`{text_col}`").cast("string")
    own_id = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(NONE))
    tagged = docs.select(
        "*",
        *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in zip(names, levels.values(), strict=True)],
        (word_tokens(text) if tokens is None else tokens).alias(tok),
        F.concat_ws("|", own_id, F.md5(F.coalesce(text, F.lit("")))).alias(ident),
    )
    narrow, _ = stored(
        tagged.select(*names, F.col(tok).alias("tokens"), F.col(ident).alias("ident")), "mix"
    )
    by_name = {n: weights.get(level, {}) for n, level in zip(names, levels, strict=True)}
    budgets = leaf_budgets(narrow.groupBy(*names).agg(F.sum("tokens").alias("tokens")), names, by_name, target_percent, max_epochs)
    plan, _ = stored(
        budgets.where("tokens > 0").select(
            *names, F.expr("cast(budget div tokens as int)").alias("epochs"), F.expr("budget % tokens").alias("rest")
        ),
        "plan",
    )
    keyed = narrow.join(plan.where("rest > 0"), names).select(
        *names, "rest", "tokens", _seeded(F.col("ident"), seed, F.col("epochs")).alias("key")
    ).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    along = Window.partitionBy(*names).orderBy("bucket")
    sums = (
        keyed.groupBy(*names, "bucket").agg(F.sum("tokens").alias("own"), F.max("key").alias("last_key"), F.first("rest").alias("rest"))
        .withColumn("upto", F.sum("own").over(along))
    )
    sums, _ = stored(sums, "buckets")
    whole = sums.where("upto <= rest").groupBy(*names).agg(F.max("last_key").alias("key"))
    cut = sums.where("upto > rest and upto - own <= rest").select(*names, "bucket", (F.col("upto") - F.col("own")).alias("before"))
    inside = Window.partitionBy(*names, "bucket").orderBy("key")
    part = (
        keyed.join(cut, [*names, "bucket"])
        .withColumn("upto", F.col("before") + F.sum("tokens").over(inside))
        .where("upto <= rest").groupBy(*names).agg(F.max("key").alias("key"))
    )
    cutoffs = whole.unionByName(part).groupBy(*names).agg(F.max("key").alias("cutoff"))
    plan, _ = stored(plan.join(cutoffs, names, "left").select(*names, "epochs", "cutoff"), "cutoffs")
    epochs, cutoff = fresh(docs, "mix_epochs"), fresh(docs, "mix_cutoff")
    chosen = (
        tagged.join(plan.withColumnsRenamed({"epochs": epochs, "cutoff": cutoff}), names)
        .withColumn(key, _seeded(F.col(ident), seed, F.col(epochs)))
    )
    copies = F.col(epochs) + F.when(F.col(key) <= F.col(cutoff), 1).otherwise(0)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_tokens", "copies")]
    return chosen.select(*kept, F.col(tok).alias("n_tokens"), copies.cast("int").alias("copies")).where("copies > 0")


def repeat_copies(mixed: DataFrame) -> DataFrame:
    """The rows of :func:`mix_sources`, each as many times as it was taken."""
    n = fresh(mixed, "copy_no")
    return mixed.withColumn(n, F.explode(F.sequence(F.lit(1), F.col("copies")))).drop(n)
