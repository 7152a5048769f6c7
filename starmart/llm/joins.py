"""A lookup join that no key can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds over 1/HOT of all counted rows, so there are
#: fewer than HOT such keys whatever the data: a proven broadcast bound.
HOT = 1024


def join_counted(big: DataFrame, small: DataFrame, key: str, count: str, spread: str,
                 how: str = "left") -> DataFrame:
    """``big`` with the columns of ``small``, which has one row per key and in
    ``count`` the number of rows of ``big`` with that key.  Rows of hot keys
    meet a broadcast of under HOT rows and are dealt out by ``spread`` in the
    shuffle join that serves all other keys.  ``small`` should be a written
    table, as it is read three times.  ``how``: left or inner."""
    values = [c for c in small.columns if c not in (key, count)]
    total = small.agg(F.sum(count)).first()[0] or 0
    hot = small.filter(F.col(count) * HOT > F.lit(total)).select(
        F.col(key).alias("__jc_hk"), *[F.col(v).alias(f"__jc_h_{v}") for v in values])
    rows = big.join(F.broadcast(hot), F.col(key) == F.col("__jc_hk"), "left")
    is_hot = F.col("__jc_hk").isNotNull()
    rows = rows.withColumns({
        "__jc_key": F.when(~is_hot, F.col(key)),
        "__jc_salt": F.when(is_hot | F.col(key).isNull(), F.xxhash64(spread).bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long")),
    })
    # 0, but no constant: a constant would leave the join's keys and with it the partitioning
    zero = F.xxhash64(key).bitwiseAND(F.lit(0).cast("long"))
    rest = small.filter(F.col(count) * HOT <= F.lit(total)).select(
        F.col(key).alias("__jc_key"), zero.alias("__jc_salt"), F.lit(True).alias("__jc_found"),
        *[F.col(v).alias(f"__jc_l_{v}") for v in values])
    out = rows.join(rest, ["__jc_key", "__jc_salt"], "left")
    if how == "inner":
        out = out.filter(is_hot | F.col("__jc_found"))
    return out.select(*[F.col(c) for c in big.columns],
                      *[F.when(is_hot, F.col(f"__jc_h_{v}")).otherwise(F.col(f"__jc_l_{v}")).alias(v) for v in values])
