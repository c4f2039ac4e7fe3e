"""Mixing sources to target weights by hierarchical budgets.

A budget of tokens runs down a tree (say domain, language, source). At every node the children share
it by weight; a child that cannot use its share gives the rest to its siblings, and only what all
siblings together cannot use goes back to the level above. A leaf can give its tokens ``max_epochs``
times. It gives whole epochs, then the prefix of one more epoch in that epoch's own seeded order.

Only (id, leaf, tokens) is written and shuffled, and it is summed before every window. The prefix
of a leaf is a cut in its order, found in two steps (sums of hash buckets, then the rows of one
bucket), so a leaf with a third of all rows is never one task's work. The cut is a value of the
leaf, so the texts themselves are selected by an expression and are not moved.

Defined results: a null or empty text has no tokens; null levels are the empty name; a leaf without
tokens or with weight 0 at any level gives nothing; integer shares leave less than one token per
child unused; a row that would pass the leaf's budget ends its prefix; rows with the same id are
taken or left together; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import fresh_names, words_of, written

_WHOLE = "decimal(19,0)"  # products of two of these are exact


@dataclass(frozen=True)
class Level:
    """One level of the tree: its name, the SQL that gives it (also read by other engines), and weights."""

    name: str
    sql: str
    weights: Mapping[str, int] = field(default_factory=dict)
    other: int = 1  # of names not listed

    def weight_sql(self) -> str:
        cases = "".join(f" when {_quoted(k)} then {int(w)}" for k, w in self.weights.items())
        return f"case {self.name}{cases} else {int(self.other)} end" if cases else str(int(self.other))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@dataclass(frozen=True)
class Mixture:
    levels: Sequence[Level]
    total_tokens: int | None = None  # of the mixture; None: as many as there are
    max_epochs: int = 2
    seed: int = 17
    bucket_rows: int = 20_000  # rows of a leaf in one hash bucket, about


def token_count(text: Column) -> Column:
    """Words as tokens."""
    return F.size(words_of(F.coalesce(text, F.lit("")))).cast("long")


def _order(seed: int, epoch: Column, row_id: Column) -> Column:
    """Place of a row in an epoch's order: the same everywhere, another in each epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(row_id.cast("string"), F.lit(""))))


def _shares(nodes: DataFrame, parent: list[str], key: str) -> DataFrame:
    """``budget`` of each node from ``above``, its parent's; nodes have ``weight`` and ``cap``."""
    group = Window.partitionBy(*[F.col(p) for p in parent] or [F.lit(0)])
    rising = group.orderBy("ratio", key)
    nodes = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight")).otherwise(0.0))
    nodes = nodes.withColumns({
        "full_before": F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "weight_from": F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)),
    })
    # in order of cap by weight, the nodes that their share fills come first
    nodes = nodes.withColumn("full", F.expr(
        f"cast(cap as {_WHOLE}) * cast(weight_from as {_WHOLE}) <= cast(weight as {_WHOLE}) * cast(above - full_before as {_WHOLE})"))
    nodes = nodes.withColumns({
        "rest": F.col("above") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0)),
        "rest_weight": F.sum(F.when(~F.col("full"), F.col("weight"))).over(group),
    })
    share = F.expr(f"(cast(weight as {_WHOLE}) * cast(rest as {_WHOLE})) div cast(rest_weight as {_WHOLE})")
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share).cast("long"))


def leaf_budgets(leaves: DataFrame, mixture: Mixture) -> DataFrame:
    """``budget`` per leaf. ``leaves`` has the levels' names and ``tokens``, a row per leaf."""
    names = [level.name for level in mixture.levels]
    allowed = F.lit(True)
    for level in mixture.levels:
        allowed = allowed & (F.expr(level.weight_sql()) > 0)
    caps = leaves.withColumn("cap", F.when(allowed, F.col("tokens") * mixture.max_epochs).otherwise(0).cast("long"))
    wanted = F.sum("tokens") if mixture.total_tokens is None else F.lit(mixture.total_tokens)
    above = caps.agg(F.least(F.coalesce(wanted, F.lit(0)), F.coalesce(F.sum("cap"), F.lit(0))).cast("long").alias("above"))
    budgets = above.withColumn("on", F.lit(0))
    for depth, level in enumerate(mixture.levels):
        parent = names[:depth]
        nodes = caps.groupBy(*names[: depth + 1]).agg(F.sum("cap").alias("cap")).withColumn("on", F.lit(0))
        nodes = nodes.withColumn("weight", F.expr(level.weight_sql()).cast("long"))
        nodes = nodes.join(budgets, [*parent, "on"]).drop("on")
        shared = _shares(nodes, parent, level.name).select(*names[: depth + 1], F.col("budget").alias("above"))
        budgets = shared.withColumn("on", F.lit(0))
    return budgets.select(*names, F.col("above").alias("budget"))


def _cuts(slim: DataFrame, plan: DataFrame, names: list[str], mixture: Mixture, most_rows: int, small: bool) -> DataFrame:
    """Per leaf the last place of its partial epoch that fits, as ``cut``."""
    digits = 1
    while 16**digits * mixture.bucket_rows < most_rows:
        digits += 1
    part = plan.where("left_over > 0").select(*names, "epochs", "left_over")
    rows = slim.join(F.broadcast(part) if small else part, names)
    rows = rows.withColumn("place", _order(mixture.seed, F.col("epochs") + 1, F.col("id")))
    rows = rows.select(*names, "left_over", "tokens", "place", F.substring("place", 1, digits).alias("bucket"))
    by_leaf = Window.partitionBy(*names).orderBy("bucket")
    sums = rows.groupBy(*names, "left_over", "bucket").agg(F.sum("tokens").alias("n"), F.max("place").alias("last"))
    sums = written(sums.withColumn("upto", F.sum("n").over(by_leaf)), "mixing-buckets")
    whole = sums.where("upto <= left_over").groupBy(*names).agg(F.max("last").alias("cut"))
    torn = sums.where("upto > left_over").groupBy(*names).agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")), "bucket").alias("at"))
    torn = torn.select(*names, F.col("at.bucket").alias("bucket"), F.col("at.before").alias("before"))
    inside = rows.join(F.broadcast(torn) if small else torn, [*names, "bucket"])
    # equal places (rows with the same id) count together, so that they share their fate
    upto = F.sum("tokens").over(Window.partitionBy(*names).orderBy("place").rangeBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("upto", F.col("before") + upto).where("upto <= left_over")
    inside = inside.groupBy(*names).agg(F.max("place").alias("cut"))
    return whole.unionByName(inside).groupBy(*names).agg(F.max("cut").alias("cut"))


@dataclass(frozen=True)
class Plan:
    leaves: DataFrame  # a row per leaf: names, tokens, rows, budget, epochs, left_over, cut
    slim: DataFrame  # a row per document: id, names, tokens
    small: bool


#: Leaves up to which their plan is broadcast: 200 bytes each, so 10 MB. More are joined by shuffle.
BROADCAST_LEAVES = 50_000


def plan_mixture(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text") -> Plan:
    names = [level.name for level in mixture.levels]
    columns = [F.coalesce(F.expr(level.sql).cast("string"), F.lit("")).alias(level.name) for level in mixture.levels]
    slim = written(docs.select(F.col(id_col).alias("id"), *columns, token_count(F.col(text_col)).alias("tokens")), "mixing")
    leaves = written(slim.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "mixing-leaves")
    n, most = leaves.agg(F.count("*"), F.max("rows")).first()
    small = n <= BROADCAST_LEAVES
    plan = leaves.join(leaf_budgets(leaves, mixture), names)
    plan = plan.withColumn("epochs", F.expr("if(tokens > 0, budget div tokens, 0)"))
    plan = written(plan.withColumn("left_over", F.expr("budget - epochs * tokens")), "mixing-budgets")
    cuts = _cuts(slim, plan, names, mixture, most or 0, small)
    return Plan(written(plan.join(cuts, names, "left"), "mixing-plan"), slim, small)


def _taken(rows: DataFrame, plan: Plan, names: list[str], mixture: Mixture, row_id: Column, epoch: str) -> DataFrame:
    """``rows`` (with the levels' names) once per epoch that takes them, ``epoch`` counted from 1."""
    cut, whole = fresh_names(rows, "mix_cut", "mix_epochs")
    leaves = plan.leaves.where("budget > 0").select(*names, F.col("cut").alias(cut), F.col("epochs").alias(whole))
    rows = rows.join(F.broadcast(leaves) if plan.small else leaves, names)
    partial = F.coalesce(_order(mixture.seed, F.col(whole) + 1, row_id) <= F.col(cut), F.lit(False))
    copies = (F.col(whole) + partial.cast("int")).cast("int")
    return rows.withColumn(epoch, F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)))).drop(cut, whole)


def mixed_ids(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document and epoch that takes it: id, the levels, ``tokens``, ``epoch``."""
    names = [level.name for level in mixture.levels]
    plan = plan_mixture(docs, mixture, id_col, text_col)
    return _taken(plan.slim, plan, names, mixture, F.col("id"), "epoch").select(
        F.col("id").alias(id_col), *names, "tokens", "epoch")


def mixed(docs: DataFrame, mixture: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of the mixture with their own columns, repeated by epoch. Texts are not shuffled."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    names = fresh_names(docs, *[f"mix_{level.name}" for level in mixture.levels])
    (epoch,) = fresh_names(docs, "mix_epoch")
    plan = plan_mixture(docs, mixture, id_col, text_col)
    renamed = Plan(plan.leaves.withColumnsRenamed(dict(zip([v.name for v in mixture.levels], names, strict=True))), plan.slim, plan.small)
    columns = {n: F.coalesce(F.expr(v.sql).cast("string"), F.lit("")) for n, v in zip(names, mixture.levels, strict=True)}
    return _taken(docs.withColumns(columns), renamed, names, mixture, F.col(id_col), epoch).select(*own)


#: The mixture of the registered query and the pipeline, over the columns of ``documents``.
_GROUPS = {"web": range(0, 5), "books": range(5, 10), "forums": range(10, 15), "news": range(15, 20)}
_DOMAIN = "case " + " ".join(
    f"when source in ({', '.join(_quoted(f'src{i}') for i in numbers)}) then {_quoted(name)}" for name, numbers in _GROUPS.items()
) + " else 'rest' end"
PRODUCTION = Mixture([
    Level("domain", _DOMAIN, {"web": 40, "books": 25, "forums": 15, "news": 15, "rest": 5}),
    Level("lang", "lower(lang)", {"en": 55, "fr": 15, "de": 15, "es": 10}, 5),
    Level("source", "source"),
])
