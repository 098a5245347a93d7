"""Joins that Spark has no single operator for, stated as hash joins on equal keys."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstile.functions.times import epoch_second, plus_seconds

BUCKET = "__bucket"
SALT = "__salt"


def interval_join_left(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    left_ts: str,
    right_ts: str,
    seconds: int,
    condition: Column | None = None,
    salts: int = 1,
) -> DataFrame:
    """Left join: equal keys and ``right_ts`` in ``[left_ts, left_ts + seconds]``, closed.

    The keys may be few (a dozen cities), so time is made part of the hash key.
    Time is cut into buckets as wide as the tolerance.  A left row has one
    bucket; a right row can only match from its own bucket or the one before,
    so it is sent to both.  Each left row stays whole in one bucket, hence a
    left outer join is right and no pair comes out twice.

    Left rows without key or time cannot match; they are spread by their
    content, as they would otherwise all meet in one task.  ``salts`` splits
    every left bucket further and copies the right rows that many times, for a
    tolerance so wide that single buckets are hot and adaptive skew handling
    is off.  Column names of the two sides must differ.
    """
    width = max(int(seconds), 1)

    def bucket(ts: str) -> Column:
        return F.floor(epoch_second(ts) / F.lit(width))

    cannot_match = F.lit(False)
    for name in (*keys, left_ts):
        cannot_match = cannot_match | F.col(name).isNull()
    spread = F.xxhash64(*[F.col(c) for c in left.columns])
    lefts = left.withColumn(BUCKET, F.when(cannot_match, spread).otherwise(bucket(left_ts)))

    own = bucket(right_ts)
    rights = right.dropna(subset=[*keys.values(), right_ts]).withColumn(
        BUCKET + "_r", F.explode(F.array(own - 1, own))
    )
    pairs = [F.col(a) == F.col(b) for a, b in keys.items()]
    pairs.append(F.col(BUCKET) == F.col(BUCKET + "_r"))
    helpers = [BUCKET, BUCKET + "_r"]
    if salts > 1:
        lefts = lefts.withColumn(SALT, F.pmod(spread, F.lit(salts)))
        rights = rights.withColumn(
            SALT + "_r", F.explode(F.array(*[F.lit(i).cast("long") for i in range(salts)]))
        )
        pairs.append(F.col(SALT) == F.col(SALT + "_r"))
        helpers += [SALT, SALT + "_r"]
    pairs.append(F.col(right_ts).between(F.col(left_ts), plus_seconds(left_ts, seconds)))
    if condition is not None:
        pairs.append(condition)
    return lefts.join(rights, pairs, "left").drop(*helpers)


def interval_totals_left(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    left_ts: str,
    right_ts: str,
    seconds: int,
    group: str,
    count: str,
    best: str,
) -> DataFrame:
    """What the interval join would sum up per left row and ``group``, without its pairs.

    Gives the left columns with ``group``, ``times`` (sum of ``count``) and
    ``best`` (maximum of ``best``) of the right rows in the interval; a left row
    without any has one row of nulls.

    With buckets as wide as the interval, the interval of a left row is the
    rest of its own bucket and the beginning of the next one.  Right rows go to
    their own bucket under their time, and to the bucket before under their
    time less the interval.  There, what a left row matches lies after it among
    the former and before it among the latter: two running totals.  The work
    grows with the rows, however many of them meet within one interval, and
    both sides are shuffled once.  Precondition: ``group`` has few values (answers
    on a survey's menu); the distinct ones of a bucket are gathered, and each
    left row is compared with each of them.
    """
    if seconds == 0:  # equal times: summed before they are joined, so that the grain is the same
        at = [*keys.values(), right_ts]
        sums = right.dropna(subset=at).groupBy(*at, group).agg(F.sum(count).alias("times"), F.max(best).alias("best")).where("times > 0")
        pairs = interval_join_left(left, sums, keys, left_ts, right_ts, 0)
        return pairs.select(*left.columns, group, "times", "best")

    places = [f"__k{i}" for i in range(len(keys))]
    own = F.floor(epoch_second(right_ts) / F.lit(seconds))
    copies = F.array(
        F.struct(own.alias(BUCKET), F.col(right_ts).alias("__at"), F.lit(True).alias("__own")),
        F.struct((own - 1).alias(BUCKET), plus_seconds(right_ts, -seconds).alias("__at"), F.lit(False).alias("__own")),
    )
    rights = right.dropna(subset=[*keys.values(), right_ts]).select(
        *[F.col(b).alias(p) for b, p in zip(keys.values(), places)],
        F.inline(copies),
        F.col(group).alias("__g"),
        F.col(count).alias("__n"),
        F.col(best).alias("__q"),
    )
    cannot_match = F.lit(False)
    for name in (*keys, left_ts):
        cannot_match = cannot_match | F.col(name).isNull()
    spread = F.xxhash64(*[F.col(c) for c in left.columns])
    lefts = left.select(
        *[F.col(a).alias(p) for a, p in zip(keys, places)],
        F.when(cannot_match, spread)
        .otherwise(F.floor(epoch_second(left_ts) / F.lit(seconds)))
        .alias(BUCKET),
        F.col(left_ts).alias("__at"),
        F.struct(*left.columns).alias("__left"),
        (~cannot_match).alias("__can"),
    )
    both = lefts.unionByName(rights, allowMissingColumns=True)

    spot = [*places, BUCKET]
    is_left = F.col("__left").isNotNull()
    slot = lambda everything, g: F.struct(F.lit(everything).alias("__all"), g.alias("__group"))
    nothing = F.lit(None).cast(right.schema[group].dataType)
    seen = F.collect_set(F.when(~is_left, slot(False, F.col("__g")))).over(Window.partitionBy(*spot))
    every = F.array(slot(True, nothing))
    slots = F.when(is_left, F.concat(every, F.col("__seen"))).otherwise(
        F.concat(every, F.array(slot(False, F.col("__g"))))
    )
    rows = both.withColumn("__seen", seen).withColumn("__slot", F.explode(slots)).select(
        *spot, "__at", "__left", "__can", "__slot.*",
        *[F.when(F.col("__own"), F.col(c)).alias(f"{c}_own") for c in ("__n", "__q")],
        *[F.when(~F.col("__own"), F.col(c)).alias(f"{c}_next") for c in ("__n", "__q")],
    )
    within = Window.partitionBy(*spot, "__all", "__group")
    after, before = within.orderBy(F.col("__at").desc()), within.orderBy(F.col("__at").asc())
    zero = F.lit(0)
    summed = rows.select(
        "__left", "__can", "__all", "__group",
        (F.coalesce(F.sum("__n_own").over(after), zero) + F.coalesce(F.sum("__n_next").over(before), zero)).alias("times"),
        F.greatest(F.max("__q_own").over(after), F.max("__q_next").over(before)).alias("best"),
    ).where(is_left)
    hit = F.col("__can") & (F.col("times") > 0)
    kept = summed.where(F.when(F.col("__all"), ~hit).otherwise(hit))
    found = lambda c: F.when(~F.col("__all"), F.col(c))
    return kept.select(
        "__left.*", found("__group").alias(group), found("times").alias("times"), found("best").alias("best")
    )


def to_spelling_pairs(
    df: DataFrame, names: DataFrame, either: tuple[str, str], key: str
) -> DataFrame:
    """Rows with the pair of spellings ``(__a, __b)`` their key stands for.

    A key that spells several pairs gives a row for each, one that spells none
    gives no row.
    """
    a, b = either
    spelled = (
        names.select(F.col(a).alias("__a"), F.col(b).alias("__b"))
        .distinct()
        .withColumn("__spelling", F.explode(F.array_distinct(F.array("__a", "__b"))))
    )
    return df.join(spelled, F.col(key) == F.col("__spelling"), "inner").drop("__spelling")


def left_join_pairs(
    left: DataFrame, known: DataFrame, on: Sequence[str], either: tuple[str, str]
) -> DataFrame:
    """Left join on ``on`` and the pair of spellings, all of them equal keys."""
    right = known.withColumnsRenamed({c: f"__on_{c}" for c in on})
    same = [F.col(c) == F.col(f"__on_{c}") for c in on]
    same += [F.col(c).eqNullSafe(F.col(p)) for c, p in zip(either, ("__a", "__b"))]
    return left.join(right, same, "left").drop("__a", "__b", *[f"__on_{c}" for c in on])


def left_join_either(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    either: tuple[str, str],
    right_key: str,
    names: DataFrame | None = None,
) -> DataFrame:
    """Left join on ``on`` and (``a = right_key`` or ``b = right_key``).

    A pair matches once even where both spellings are equal.  The right rows
    are first brought to the pair of spellings they stand for, through the
    distinct pairs (``names``, by default those of the left side), and then
    joined on equal keys only.  An OR inside the join would compare every left
    row of a key with every right row of it.
    """
    known = to_spelling_pairs(right, left if names is None else names, either, right_key)
    return left_join_pairs(left, known, on, either)


SIZE_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size of a frame is within the session's broadcast limit.

    The planner takes sizes from the files; for what it cannot know it assumes
    far too much, so a frame passes only on a real bound.
    """
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", limit).groups()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= int(number) * SIZE_UNITS[unit]


def aggregate_then_join(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: Column | str,
    dimension_key: str,
    fact_groups: Sequence[Column],
    groups: Sequence[str],
    sums: Mapping[str, Column],
    how: str = "inner",
) -> DataFrame:
    """Sums of a fact table by attributes of a dimension.

    A dimension of proven small size is broadcast: the facts then meet it where
    they are, and one shuffle of sums is left.  For a larger one the facts are
    summed by the join key first, so a key that holds a large part of all rows
    shrinks on the map side and the join moves sums, not rows.  A dimension
    that lists a key twice counts its rows twice either way.
    """
    key = (F.col(fact_key) if isinstance(fact_key, str) else fact_key).alias("__key")
    totals = [F.sum(name).alias(name) for name in sums]
    if fits_broadcast(dimension):
        rows = facts.select(key, *fact_groups, *[c.alias(name) for name, c in sums.items()])
        dimension = F.broadcast(dimension)
    else:
        rows = facts.groupBy(key, *fact_groups).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    joined = rows.join(dimension, F.col("__key") == F.col(dimension_key), how)
    return joined.groupBy(*groups).agg(*totals)


def rows_absent_from(df: DataFrame, target: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold (null keys are never held)."""
    return df.join(target.select(*on).distinct(), list(on), "left_anti")


def spine(
    members: DataFrame,
    periods: DataFrame,
    period: Sequence[str],
    channels: Sequence[str],
    spread_by: str | None = None,
) -> DataFrame:
    """Every period for every member (city) and every channel.

    The periods are distinct calendar periods, so there are at most 53 a year;
    they arrive as one array and are unfolded per member, as is the fixed list
    of channels.  Nothing is cross joined and no row of a fact table moves.
    The members are spread by a column of theirs before they multiply: windows
    over that column (and more) then need no further shuffle.
    """
    listed = periods.select(F.struct(*period).alias("p")).distinct()
    if spread_by is not None:
        tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        members = members.repartition(tasks, spread_by)
    unfolded = members.withColumn("__p", F.explode(listed.agg(F.collect_list("p")).scalar()))
    return unfolded.select(
        *[F.col(f"__p.{c}").alias(c) for c in period],
        *[F.col(c) for c in members.columns],
        F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"),
    )
