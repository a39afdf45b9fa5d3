"""Mixing sources to target weights by hierarchical budgets, DataFrame
functions only.

Documents are leaves' rows in a tree domain - language - source. Every node
has an integer weight (DEFAULT where none is given; 0 leaves it out). A
token budget flows from the root: a node's budget is split among its children
in proportion to their weights, but no child gets more than its subtree can
give (tokens times ``max_epochs``). What a child cannot take goes to its
siblings, in proportion again; only what all siblings together cannot take
stays with the parent's own siblings, because a parent's capacity is the sum
of its children's. The split is exact integer arithmetic in closed form: in
the order of capacity per weight the nodes that fill up come first, so prefix
sums in one window per parent decide it, without iterating.

A leaf with budget T and A tokens takes T div A whole epochs and, of the next
one, the longest prefix with at most the remaining tokens in that epoch's own
order: by md5 of seed, epoch and document. The prefix is cut without sorting
a leaf: token sums of 4096 hash buckets locate the bucket, and only its rows
are ordered. Texts are not shuffled while the table of leaves is small (its
size is checked; else it is a shuffle join).

Defined results: null and empty lang or source are one leaf; a null or empty
text has 0 tokens and is taken where its place in the order falls; rows of
one doc_id share a place and are taken together or not at all (rows without
doc_id: those of one text); a leaf whose budget reaches its capacity gives
``max_epochs`` epochs; an empty table or budget gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from recfold.llm.common import drop_columns, materialize

LEVELS = ["domain", "lang", "source"]
DEFAULT = 1
MAX_EPOCHS = 4
SEED = 7
#: Budget as a share of all tokens.
BUDGET = (1, 2)
DOMAIN_WEIGHTS = {"domain0": 5, "domain1": 3, "domain2": 2, "other": 1}
LANG_WEIGHTS = {"en": 4, "de": 3, "fr": 2, "es": 2}
#: Leaves up to which their table is broadcast (about 100 bytes each).
BROADCAST_LEAVES = 100_000
TOKEN = r"[^\x20\x09-\x0D]+"


def domain_of_source(source: str = "source"):
    """Domain of a source name: its trailing number modulo 3, else ``other``."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("other")).otherwise(
        F.concat(F.lit("domain"), F.pmod(number.cast("int"), F.lit(3)).cast("string")))


def _weight(column: str, weights: dict[str, int]):
    if not weights:
        return F.lit(DEFAULT)
    out = F.lit(DEFAULT)
    for k in sorted(weights):
        out = F.when(F.col(column) == k, F.lit(int(weights[k]))).otherwise(out)
    return out


def share(nodes: DataFrame, parent: list[str], node: str) -> DataFrame:
    """Split ``budget`` (equal on all rows of a parent) among its ``node`` rows
    by ``weight``, none above ``cap``; adds ``given``."""
    big = "decimal(20,0)"
    live = nodes.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0).cast(big))
    live = live.withColumn("w", F.greatest(F.col("weight"), F.lit(0)).cast("decimal(17,0)"))
    key = [F.col(c) for c in parent] or [F.lit(0)]
    ratio = F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w").cast("double"))
    by = W.partitionBy(*key).orderBy(ratio.asc_nulls_last(), F.col(node))
    before, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy(*key)
    placed = live.withColumns({"c": F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(big),
                               "s": F.sum("w").over(after).cast("decimal(17,0)")})
    full = (F.col("w") > 0) & (F.col("cap") * F.col("s") <= (F.col("budget").cast(big) - F.col("c")) * F.col("w"))
    placed = placed.withColumn("full", full)
    rest = F.col("budget").cast(big) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    open_ = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(whole)
    placed = placed.withColumns({"rest": rest.cast(big), "open": open_.cast("decimal(17,0)")})
    floor = F.when(F.col("full"), F.col("cap").cast("bigint")).when(
        F.col("open") > 0, F.expr("cast((rest * w) div open as bigint)")).otherwise(F.lit(0))
    placed = placed.withColumn("floor", floor)
    # single tokens left by rounding down go to the first open nodes by name
    takes = ~F.col("full") & (F.col("w") > 0)
    left = F.col("rest").cast("bigint") - F.sum(F.when(takes, F.col("floor")).otherwise(0)).over(whole)
    nth = F.sum(F.when(takes, 1).otherwise(0)).over(W.partitionBy(*key).orderBy(node).rowsBetween(W.unboundedPreceding, 0))
    given = F.col("floor") + F.when(takes & (nth <= left), 1).otherwise(0)
    return placed.withColumn("given", given.cast("bigint")).select(*nodes.columns, "given")


def allocate(leaves: DataFrame, budget: int, weights: dict[str, dict[str, int]], max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Token budget ``given`` of every leaf (LEVELS, tokens)."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for level in LEVELS:
        caps = caps.withColumn(f"w_{level}", _weight(level, weights.get(level, {})))
    # a weight of 0 anywhere above takes the leaf out of every capacity
    alive = (F.col("w_domain") > 0) & (F.col("w_lang") > 0) & (F.col("w_source") > 0)
    caps = caps.withColumn("cap", F.when(alive, F.col("cap")).otherwise(0))
    total = caps.agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("c")).first()["c"]
    above = None
    for i, level in enumerate(LEVELS):
        path = LEVELS[:i]
        nodes = caps.groupBy(*LEVELS[:i + 1]).agg(F.sum("cap").alias("cap"), F.max(f"w_{level}").alias("weight"))
        nodes = (nodes.withColumn("budget", F.lit(min(budget, total)).cast("bigint")) if above is None
                 else nodes.join(above, path))
        above = share(nodes, path, level).select(*LEVELS[:i + 1], F.col("given").alias("budget"))
    return leaves.join(above, LEVELS).withColumnRenamed("budget", "given")


def _key():
    """What a document is called in the orders of the epochs."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))


def _order(seed: int, epoch, key):
    return F.md5(F.concat_ws("/", F.lit(str(seed)), epoch.cast("string"), key).cast("binary"))


def mix(docs: DataFrame, budget: int | tuple[int, int] = BUDGET, weights: dict[str, dict[str, int]] | None = None,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, domain=None) -> DataFrame:
    """``docs`` with ``domain``, ``n_tokens`` and ``epoch`` (from 0), one row
    per document and epoch taken. ``budget``: tokens, or a share of all tokens."""
    weights = {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS} if weights is None else weights
    named = drop_columns(docs, ["domain", "n_tokens", "epoch"])
    named = named.withColumns({"domain": domain_of_source() if domain is None else domain,
                               "n_tokens": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TOKEN)).cast("bigint")})
    leaf = [F.col("domain").alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")]
    rows = materialize(named.select(*leaf, _key().alias("key"), "n_tokens"), "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    if isinstance(budget, tuple):
        total = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
        budget = total * budget[0] // budget[1]
    given = allocate(materialize(leaves, "mix-leaves"), budget, weights, max_epochs).filter("tokens > 0")
    plan = materialize(given.withColumns({"epochs": F.expr("given div tokens").cast("int"), "rest": F.expr("given % tokens")})
                       .select(*LEVELS, "epochs", "rest"), "mix-plan")

    # the cut of each leaf's last epoch
    open_ = plan.filter("rest > 0")
    ordered = rows.join(open_, LEVELS).withColumn("h", _order(seed, F.col("epochs"), F.col("key")))
    ordered = ordered.withColumn("bucket", F.substring("h", 1, 3))
    sums = ordered.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n_tokens").alias("t"))
    run = W.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    edge = (sums.withColumn("upto", F.sum("t").over(run)).filter("upto > rest").groupBy(*LEVELS)
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before"))).alias("edge"))
            .select(*LEVELS, F.col("edge.bucket").alias("bucket"), F.col("edge.before").alias("before")))
    inside = ordered.join(edge, [*LEVELS, "bucket"])
    peers = W.partitionBy(*LEVELS).orderBy("h").rangeBetween(W.unboundedPreceding, 0)
    last = (inside.withColumn("upto", F.col("before") + F.sum("n_tokens").over(peers)).filter("upto > rest")
            .groupBy(*LEVELS).agg(F.min("h").alias("stop")))
    cuts = materialize(plan.join(last, LEVELS, "left").select(
        *[F.col(c).alias(f"__{c}") for c in LEVELS], F.col("epochs").alias("__epochs"),
        # rows before ``stop`` are taken; all rows are if nothing exceeds the rest
        F.when(F.col("rest") > 0, F.coalesce("stop", F.lit("g"))).alias("__stop")), "mix-cuts")
    if cuts.count() <= BROADCAST_LEAVES:
        cuts = F.broadcast(cuts)
    key = _key()
    on = [leaf_col.eqNullSafe(F.col(f"__{c}")) for c, leaf_col in zip(
        LEVELS, (F.col("domain"), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))))]
    taken = named.join(cuts, on[0] & on[1] & on[2])
    whole = F.when(F.col("__epochs") > 0, F.sequence(F.lit(0), F.col("__epochs") - 1)).otherwise(F.array().cast("array<int>"))
    part = F.when(_order(seed, F.col("__epochs"), key) < F.col("__stop"), F.array("__epochs")).otherwise(F.array().cast("array<int>"))
    return taken.withColumn("epoch", F.explode(F.concat(whole, part))).select(*named.columns, "epoch")


def report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")
