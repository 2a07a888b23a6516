"""Reproducible splits, samples and negative sampling.

Every random choice is a counter-based draw (see ``functions.rng``), so a
split or sample does not depend on partitioning and survives task retries
unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.rng import uniform
from tabulon.operators.windows import bucketed_position, dense_index
from tabulon.session import checkpoint_dir


BLOCK = 4096  # draws made from one row


def random_split(df: DataFrame, weights: list[float], seed: int, key_cols: list[str],
                 part_col: str = "part") -> DataFrame:
    """Tag each row with a part number 0..len(weights)-1 drawn with the given
    (normalised) weights from a hash of ``key_cols``."""
    total = float(sum(weights))
    u = uniform(seed, *key_cols)
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    e = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        e = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(e)
    return df.withColumn(part_col, e)


def sample_fraction(df: DataFrame, fraction: float, seed: int, key_cols: list[str]) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.where(uniform(seed, *key_cols) < F.lit(fraction))


def index_items(items: DataFrame, item: str = "item_id") -> DataFrame:
    """(item, item_idx 0..N-1) in item order, whatever the ids' spread."""
    return dense_index(items, item, "item_idx")


def sample_negatives(positives: DataFrame, items: DataFrame, seed: int, user: str = "user_id",
                     item: str = "item_id") -> DataFrame:
    """Per user, as many negatives as positives: draw j = 0, 1, 2, ... picks a
    uniformly random item of the catalogue; a draw counts when the item is not
    one of the user's positives (repeats allowed); the first p counting draws
    are kept, and at most N draws (N = catalogue size) are made per user.

    Draws are generated in rounds of growing width only for users still
    short, so the result equals the full definition without materialising N
    draws per user."""
    checkpoint_dir(positives.sparkSession)
    idx = index_items(items, item).checkpoint()
    n_items = idx.count()
    pos = positives.select(user, item).distinct()
    need = pos.groupBy(user).agg(F.count(F.lit(1)).alias("_p"))
    chosen = pos.limit(0).withColumn("_j", F.lit(0).cast("bigint"))
    start = F.lit(0).cast("bigint")
    state = need.select(user, "_p", start.alias("_j0"), F.lit(0).cast("bigint").alias("_have"))
    width = 4
    while True:  # every round raises _j0 of all users still short, up to N
        todo = state.where((F.col("_have") < F.col("_p")) & (F.col("_j0") < F.lit(n_items)))
        if todo.isEmpty():
            break
        # draws j in [_j0, _j0 + w) with w = width * p + 16, capped at N
        w = F.least(F.col("_p") * width + 16, F.lit(n_items) - F.col("_j0"))
        # by blocks first, so that no array grows with a user's positives
        blocks = todo.select(user, "_p", "_have", F.col("_j0").alias("_first"), (F.col("_j0") + w).alias("_end"),
                             F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((w - 1) / F.lit(BLOCK)))).alias("_k"))
        begin = F.col("_first") + F.col("_k") * BLOCK
        draws = blocks.select(user, "_p", "_have", F.explode(F.sequence(begin, F.least(begin + BLOCK, F.col("_end")) - 1)).alias("_j"))
        draws = draws.withColumn("item_idx", F.floor(uniform(seed, user, "_j") * F.lit(n_items)).cast("bigint"))
        draws = draws.join(idx, "item_idx").join(pos, [user, item], "left_anti")
        # rank of each counting draw within its user, cut into blocks of draws
        ranked = bucketed_position(draws.withColumn("_jb", F.floor(F.col("_j") / F.lit(BLOCK))), user, "_jb",
                                   ["_j"], "_r")
        got = ranked.where(F.col("_have") + F.col("_r") <= F.col("_p")).select(user, item, "_j").checkpoint()
        chosen = chosen.unionByName(got)
        counts = got.groupBy(user).agg(F.count(F.lit(1)).alias("_g"))
        state = (todo.join(counts, user, "left")
                 .select(user, "_p", (F.col("_j0") + w).alias("_j0"),
                         (F.col("_have") + F.coalesce("_g", F.lit(0))).alias("_have"))).checkpoint()
        width *= 4
    return chosen.select(user, item, "_j")
