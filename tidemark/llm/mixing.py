"""Operator 6, mixing sources to target weights by hierarchical budgeting (DataFrame functions only).

Documents hang below a tree of levels, by default domain, language, source. A token budget is
handed down from the root: the children of a node share its budget by their weights, a child
gets no more than its subtree can give (``max_epochs`` times its tokens), and what it cannot
take goes to its siblings by weight. Only what all siblings together cannot take is missing
at their parent, where the parent's own siblings take it up in the same way, since a node's
limit is the sum over its subtree. Each leaf then takes a prefix of its documents: whole
epochs first, then a prefix of one more, every epoch in its own seeded order.

All arithmetic is on integers (decimals without a fraction), so results are exact.

Defined results: a null level is a value of its own and has the default weight; a document
without words has no tokens and is taken with the epochs its place in the order falls in;
rows with the same id and text stand or fall together; the prefix never exceeds the leaf's budget;
a budget above the whole supply takes everything ``max_epochs`` times; empty tables give empty
results; extra columns pass through, clashing ones are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, n_words, with_replaced

Weights = Mapping[str, int]
BIG = "decimal(38,0)"
ROWS_PER_BUCKET = 4096


def domain_of(source: Column) -> Column:
    """Default domain of a source: its trailing number modulo 4 ('d0' .. 'd3'), else 'none'."""
    digits = F.regexp_extract(source, r"(\d{1,9})$", 1)
    return F.when(digits == "", F.lit("none")).otherwise(
        F.concat(F.lit("d"), (F.try_to_number(digits, F.lit("999999999")).cast("int") % 4).cast("string")))


def _weight(level: Column, weights: Weights, default: int) -> Column:
    out = None
    for k, v in weights.items():
        out = F.when(level == k, F.lit(int(v))) if out is None else out.when(level == k, F.lit(int(v)))
    return (F.lit(default) if out is None else F.coalesce(out.otherwise(F.lit(default)), F.lit(default))).cast(BIG)


def _share(nodes: DataFrame, group: list[str], child: str) -> DataFrame:
    """Fill children in the order of limit / weight: as long as a child's limit is below its
    share of what is left it is filled; the rest share the remainder by weight."""
    order = Window.partitionBy(*group).orderBy(F.col("ratio"), F.col(child).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*group)
    left = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("decimal(27,0)")
    t = (
        nodes.withColumn("ratio", (F.col("cap") / F.col("w")).cast("double"))
        .withColumn("left", left).withColumn("w_left", F.sum("w").over(after).cast("decimal(10,0)"))
        .withColumn("full", F.col("cap").cast("decimal(27,0)") * F.col("w_left") <= F.col("left") * F.col("w").cast("decimal(10,0)"))
        .withColumn("rest", F.max(F.when(~F.col("full"), F.col("left"))).over(whole))
        .withColumn("w_rest", F.max(F.when(~F.col("full"), F.col("w_left"))).over(whole))
    )
    share = F.expr("cast((rest * cast(w as decimal(10,0))) div w_rest as decimal(38,0))")
    return t.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share).cast(BIG)) \
        .drop("ratio", "left", "w_left", "full", "rest", "w_rest")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Weights],
                 budget_share: tuple[int, int], default_weight: int = 1) -> DataFrame:
    """The leaves with ``budget``, of ``leaves`` with ``supply`` (tokens) and ``cap`` (most it can give).

    The total is ``budget_share`` (numerator, denominator) of the supply. Every table here has
    one row per node of the tree, so its size follows the distinct leaves, not the documents.
    """
    levels = list(levels)
    whole = Window.partitionBy("root")  # one row per node of the first level
    num, den = budget_share
    parent = None
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").cast(BIG).alias("cap"), F.sum("supply").cast(BIG).alias("supply"))
        nodes = nodes.withColumn("w", _weight(F.col(level), weights.get(level, {}), default_weight))
        if parent is None:
            total = F.expr(f"cast((cast(supply_all as decimal(27,0)) * cast({int(num)} as decimal(10,0))) div {int(den)} as {BIG})")
            nodes = nodes.withColumn("root", F.lit(0)).withColumn("supply_all", F.sum("supply").over(whole)) \
                .withColumn("budget", F.least(total, F.sum("cap").over(whole).cast(BIG))).drop("supply_all")
            parent = _share(nodes, ["root"], level).drop("root", "cap", "supply", "w")
            continue
        up = parent.select(*[F.col(c).alias(f"p_{c}") for c in path[:-1]], "budget")
        on = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in path[:-1]]
        nodes = nodes.join(up, on).drop(*[f"p_{c}" for c in path[:-1]])
        parent = _share(nodes, path[:-1], level).drop("cap", "w", *([] if depth == len(levels) - 1 else ["supply"]))
    return parent if len(levels) > 1 else parent.join(leaves.select(*levels, "supply"), levels)


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in a seeded epoch: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _bucket(key: Column, buckets: Column) -> Column:
    """Key range of a key, among as many equal ranges as ``buckets`` says; grows with the key."""
    return F.floor(F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48)) * buckets).cast("long")


def mix(docs: DataFrame, weights: Mapping[str, Weights], *, budget_share: tuple[int, int] = (4, 5),
        max_epochs: int = 2, seed: int = 7, levels: Sequence[str] = ("domain", "lang", "source"),
        domain: Column | None = None, tokens: Column | None = None, doc_id: str = "doc_id") -> DataFrame:
    """One row per document and epoch taken: ``docs`` with ``domain`` and ``epoch`` (int, from 0)."""
    level_of = {c: (domain if domain is not None else domain_of(F.col("source"))) if c == "domain" else F.col(c) for c in levels}
    level_of = {f"__{c}": v.cast("string") for c, v in level_of.items()}
    names = list(level_of)
    size = (tokens if tokens is not None else n_words(F.col("text"))).cast("long")
    light = materialise(docs.select(F.col(doc_id).alias("id"), size.alias("tokens"),
                                    *[v.alias(c) for c, v in level_of.items()]), "mix_light")
    leaves = light.groupBy(*names).agg(F.sum("tokens").alias("supply"), F.count("*").alias("docs"),
                                       (F.sum("tokens") * max_epochs).alias("cap"))
    leaf_weights = {f"__{c}": v for c, v in weights.items()}
    given = leaf_budgets(leaves, names, leaf_weights, budget_share)
    size_of = leaves.select(*[F.col(c).alias(f"s_{c}") for c in names], "docs")
    same = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in names]
    whole = F.when(F.col("supply") > 0, F.expr("cast(budget div supply as int)")).otherwise(0)
    plan = materialise(
        given.join(size_of, same).select(
            *names, whole.alias("epochs"),
            F.when(F.col("supply") > 0, F.expr("cast(budget % supply as bigint)")).otherwise(0).cast("long").alias("rest"),
            F.greatest(F.lit(1), F.ceil(F.col("docs") / ROWS_PER_BUCKET)).cast("long").alias("buckets")), "mix_plan")

    def leaf_of(df: DataFrame, leaf: DataFrame) -> DataFrame:
        """The leaf's row beside each row; broadcast if the planner's size limit allows, else a join
        whose hot keys the adaptive skew join splits."""
        other = leaf.select(*[F.col(c).alias(f"p_{c}") for c in names], *[c for c in leaf.columns if c not in names])
        return df.join(other, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in names], "left").drop(*[f"p_{c}" for c in names])

    # the prefix of the next epoch, found by key ranges of bounded size: sums of the ranges
    # first, then single rows of the one range in which the budget ends
    keyed = leaf_of(light, plan).where(F.col("epochs") < max_epochs).withColumn("key", _key(seed, F.col("epochs"), F.col("id")))
    keyed = keyed.withColumn("bucket", _bucket(F.col("key"), F.col("buckets")))
    by_bucket = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = keyed.groupBy(*names, "rest", "bucket").agg(F.sum("tokens").alias("n")) \
        .withColumn("up_to", F.sum("n").over(by_bucket))
    # the first range in which the running sum passes the budget
    edge = materialise(
        sums.where((F.col("up_to") > F.col("rest")) & (F.col("up_to") - F.col("n") <= F.col("rest")))
        .select(*names, F.col("bucket").alias("cut_bucket"), (F.col("up_to") - F.col("n")).alias("before")), "mix_edge")
    inside = leaf_of(keyed, edge).where(F.col("bucket") == F.col("cut_bucket"))
    in_order = Window.partitionBy(*names).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    last = inside.withColumn("sum", F.col("before") + F.sum("tokens").over(in_order)).where("sum <= rest") \
        .groupBy(*names).agg(F.max("key").alias("cut_key"))
    cuts = materialise(leaf_of(leaf_of(plan, edge.drop("before")), last), "mix_cuts")

    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"),
                      F.col(doc_id).alias("id"), *[v.alias(c) for c, v in level_of.items()])
    out = leaf_of(out, cuts).withColumn("key", _key(seed, F.col("epochs"), F.col("id")))
    place = _bucket(F.col("key"), F.col("buckets"))
    # no cut bucket: the whole epoch fits; past the last epoch nothing is left to take
    in_prefix = (F.col("epochs") < max_epochs) & (
        F.col("cut_bucket").isNull() | (place < F.col("cut_bucket"))
        | ((place == F.col("cut_bucket")) & F.coalesce(F.col("key") <= F.col("cut_key"), F.lit(False))))
    times = F.col("epochs") + in_prefix.cast("int")
    domain_value = F.col("__domain") if "__domain" in names else F.lit(None).cast("string")
    out = out.where(times > 0).select("kept", domain_value.alias("__d"), F.explode(F.sequence(F.lit(0), times - 1)).alias("__e"))
    out = out.select("kept.*", "__d", "__e")
    return with_replaced(out, {"domain": F.col("__d"), "epoch": F.col("__e").cast("int")}).drop("__d", "__e")
