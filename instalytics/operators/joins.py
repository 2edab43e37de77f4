"""Join shapes used by the features.

Algorithms are left to Catalyst + AQE (sort-merge by default, runtime
broadcast when a materialised side is small, skew splitting of the streamed
side). The helpers only fix the *shape*: which side carries a residual, where
a left join must stay outer, and how a fan-out is avoided.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import latest_per_key


def presence_flag(left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str) -> DataFrame:
    """Left rows + ``name`` = 1 if some right row has the key, else 0.

    Right keys are de-duplicated first (existence join), so a key present
    many times on the right never multiplies left rows."""
    keys = right.select(F.col(right_key).alias("_pk")).where(F.col("_pk").isNotNull()).distinct()
    out = left.join(keys, left[left_key] == keys["_pk"], "left")
    return out.withColumn(name, F.when(F.col("_pk").isNotNull(), F.lit(1)).otherwise(F.lit(0))).drop("_pk")


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows with no right row of the same key (``LEFT JOIN ... IS NULL``)."""
    r = right.select(F.col(right_key).alias("_ak"))
    return left.join(r, left[left_key] == r["_ak"], "left_anti")


def asof_latest(left: DataFrame, right: DataFrame, left_key: str, right_key: str, cond, pick, order, tiebreak=()) -> DataFrame:
    """As-of join for a ``left`` that is unique on ``left_key``.

    For each left row: among right rows of the same key passing
    ``cond(l, r)``, the one first under ``order`` DESC NULLS FIRST (ties:
    ``tiebreak``), projected by ``pick(l, r)`` (a list of named columns that
    ``order`` / ``tiebreak`` refer to). Left rows without a match are kept
    with nulls.

    Shape: inner equi-join with the residual as a filter of the joined rows
    (no cartesian product; a hot key on the right is the streamed side, which
    AQE can split), top-1 per key as a partial aggregate, then a 1:1 left join
    back. Output = left columns + picked columns.
    """
    lk = left.select(F.col(left_key).alias("_k"), *[c for c in left.columns if c != left_key])
    pairs = lk.join(right, lk["_k"] == right[right_key], "inner").where(cond(lk, right))
    sel = pairs.select("_k", *pick(lk, right))
    top = latest_per_key(sel, ["_k"], list(order), list(tiebreak))
    return left.join(top, left[left_key] == top["_k"], "left").drop("_k")


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """``df`` itself, failing at run time if a key occurs more than once. One
    more aggregate on the keys, which re-uses their partitioning and order."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*[F.col(c) for c in rest])).alias("_row"))
    said = F.concat(F.lit(f"more than one row for {', '.join(keys)} = "), *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    row = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(said))
    return one.select(*keys, row.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def star_join(base: DataFrame, sides, check_unique: bool = False) -> DataFrame:
    """``base`` LEFT JOIN each (side, keys) in turn. With ``check_unique`` the
    run fails if a side repeats its keys."""
    if check_unique:
        sides = [(assert_unique(df, keys), keys) for df, keys in sides]
    return reduce(lambda acc, s: acc.join(s[0], s[1], "left"), sides, base)


def star_union(base: DataFrame, key: str, sides, per_country=()) -> DataFrame:
    """``base`` LEFT JOIN every side on ``key``, as one union and one grouped
    aggregate instead of a join per side: each side's rows are tagged, and a key's
    row takes the one row of each tag. The run fails if base or a side holds a
    key twice.

    ``sides``: DataFrames of the key and columns that no other has.
    ``per_country``: DataFrames of the key, ``country_code`` and such columns,
    unique on key and country; a key takes the row of the base's
    ``country_code`` (null equals null), else that of the greatest country. What
    is collected for these is one row per country of the key."""
    frames = [base, *sides, *per_country]
    payload = [F.struct(*[F.col(c) for c in df.columns if c != key]) for df in frames]
    kinds = [df.select(p.alias("p")).schema["p"].dataType for df, p in zip(frames, payload, strict=True)]
    tagged = [df.select(F.col(key), *[(payload[i] if i == j else F.lit(None).cast(t)).alias(f"_s{j}") for j, t in enumerate(kinds)])
              for i, df in enumerate(frames)]
    single = range(len(frames) - len(per_country))
    several = range(len(single), len(frames))
    aggs = [F.max(f"_s{i}").alias(f"_s{i}") for i in single] + [F.collect_list(f"_s{i}").alias(f"_s{i}") for i in several]
    counts = [F.count(f"_s{i}").alias(f"_n{i}") for i in single]
    one = reduce(lambda a, b: a.unionByName(b), tagged).groupBy(key).agg(*aggs, *counts).where("_n0 > 0")
    said = F.concat(F.lit(f"more than one row for {key} = "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    once = reduce(lambda a, b: a & b, [F.col(f"_n{i}") <= 1 for i in single])
    one = one.withColumn("_s0", F.when(once, F.col("_s0")).otherwise(F.raise_error(said)))
    for i in several:
        rows, home = F.col(f"_s{i}"), F.col("_s0.country_code")
        same = F.filter(rows, lambda r: r["country_code"].eqNullSafe(home))
        # a null country is greater than any, as in ORDER BY country DESC
        unknown = F.filter(rows, lambda r: r["country_code"].isNull())
        one = one.withColumn(f"_s{i}", F.coalesce(F.get(same, F.lit(0)), F.get(unknown, F.lit(0)), F.array_max(rows)))
    out = [F.col(key)]
    for i, df in enumerate(frames):
        out += [F.col(f"_s{i}.{c}").alias(c) for c in df.columns if c != key and (c != "country_code" or i == 0)]
    return one.select(*out)


def left_join_residual(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], residual, hot_share: int | None = None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` ON the key pairs AND ``residual(l, r)``,
    where ``residual`` gets the columns of the two by name. It references both sides, so it must
    stay in ON, else unmatched left rows would be lost. Output: all columns of both.

    Spark cannot split the right side of a left join, so a right key with a
    large share of the rows would meet in one task. Here the matches are an inner
    join in which the rows of a hot right key are dealt over salts by a hash of
    the row and its left rows are repeated once per salt; a key is hot from one
    part in ``hot_share`` (the shuffle partitions) of the right rows, so there are
    fewer hot keys than that (broadcast) and a salt holds about one such part.
    Left rows without a match are found by an anti join on the whole left row,
    which gives equal rows equal answers. Null keys match nothing."""
    share = hot_share or max(2, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if set(left.columns) & set(right.columns):
        raise ValueError(f"columns of both sides: {sorted(set(left.columns) & set(right.columns))}")
    # names of their own inside, so that no column is of two frames
    lname = {c: f"_l{i}" for i, c in enumerate(left.columns)}
    rname = {c: f"_r{i}" for i, c in enumerate(right.columns)}
    key = [f"_k{i}" for i in range(len(keys))]
    l = left.select(*[F.col(f"`{c}`").alias(n) for c, n in lname.items()], *[F.col(f"`{a}`").alias(k) for (a, _), k in zip(keys, key, strict=True)])
    r = right.select(*[F.col(f"`{c}`").alias(n) for c, n in rname.items()], *[F.col(f"`{b}`").alias(k) for (_, b), k in zip(keys, key, strict=True)])
    r = r.na.drop(subset=key)
    sizes = r.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n")).scalar()
    hot = F.broadcast(sizes.where(F.col("_n") * share > total).select(*key, F.ceil(F.col("_n") * share / total).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    r = r.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*rname.values()), salts).cast("int")).drop("_salts")
    spread = l.na.drop(subset=key).join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    met = spread.join(r, [*key, "_salt"]).where(residual({c: F.col(n) for c, n in lname.items()}, {c: F.col(n) for c, n in rname.items()}))
    row = F.struct(*[F.col(n) for n in lname.values()]).alias("_row")
    alone = l.select("*", row).join(met.select(row).distinct(), "_row", "left_anti")
    back = [F.col(n).alias(c) for c, n in lname.items()]
    matched = met.select(*back, *[F.col(n).alias(c) for c, n in rname.items()])
    alone = alone.select(*back, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rname])
    return matched.unionByName(alone)
