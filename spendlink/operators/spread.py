"""Joins on very unequal keys: the frequent keys are found first, and each is spread over several tasks.

1. One pass with Spark's mergeable top-k sketch over key hashes finds the keys of the larger side that hold more than a task's
   even share of its rows. There are fewer of them than tasks, whatever the table's size.
2. A row of such a key gets a number below the key's fan, from a hash of the row; the other side's rows of that key are copied
   once per number, ``SPLIT`` times the number of tasks in all if the other side's keys are unique. All other rows get 0.
3. The join runs on the keys and the number. It gives the rows of the plain join; the sketch's error only moves rows between
   tasks. Without a frequent key it is the plain join.

Adaptive skew splitting needs partitions beyond its thresholds and a sort-merge join; this holds with either turned off. Null keys
are keys like any other here: in a left join they would all go to one task. Rows equal in all of ``by`` stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts per even share of a frequent key: several small parts spread better than one of just the right size.
SPLIT = 8
#: Keys reported at most, and keys a task's sketch tracks. A key left out holds less than a TRACKED-th of the rows or so, or there
#: are more than MOST keys larger than a task's share, each at most a MOST-th of the rows.
MOST, TRACKED = 1024, 1 << 16


def _hash(df: DataFrame, keys: list[str]) -> Column:
    kinds = dict(df.dtypes)
    if wrong := [k for k in keys if kinds[k] in ("float", "double")]:
        raise ValueError(f"floating keys have several forms of one value: {', '.join(wrong)}")
    return F.xxhash64(*(F.col(f"`{k}`") for k in keys))


def _unused(name: str, *tables: DataFrame) -> str:
    taken = {c.lower() for t in tables for c in t.columns}
    while name in taken:
        name += "_"
    return name


def frequent_keys(df: DataFrame, keys: list[str], tasks: int | None = None) -> dict[int, int]:
    """Fan by hash of the keys that hold more than an even share of the rows of ``df``; empty for an empty table.

    Reads only the key columns of ``df``. At most ``MOST`` entries reach the driver.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = F.expr(f"approx_top_k(h, {min(tasks, MOST)}, {TRACKED})")
    found = df.select(_hash(df, keys).alias("h")).agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    share = max(1.0, found.n / tasks)
    return {e["item"]: min(SPLIT * tasks, -int(-SPLIT * e["count"] // share)) for e in found.top or [] if e["count"] > share}


def spread_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", by: list[str] | None = None,
    null_safe: bool = False, fans: dict[int, int] | None = None,
) -> DataFrame:
    """``left`` joined with ``right`` on equally named ``keys`` of equal types; ``how`` is ``left`` or ``inner``.

    ``fans`` are those of ``frequent_keys``, found in ``left`` if not given; a caller can find them earlier in a plan, where the
    keys are cheaper to read. ``by`` names columns of ``left`` that tell its rows apart, by default all. With ``null_safe``, null keys match
    each other. The result has the columns of ``left``, then those of ``right`` without the keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"{how!r} is not left or inner")
    kinds = dict(left.dtypes), dict(right.dtypes)
    if wrong := [k for k in keys if kinds[0][k] != kinds[1][k]]:
        raise ValueError(f"keys of different types: {', '.join(wrong)}")
    fans = frequent_keys(left, keys) if fans is None else fans
    salt, placed = _unused("__salt", left, right), _unused("__hash", left, right)
    matched = [_unused(f"__right_{k.lower()}", left, right) for k in keys]
    pairs = list(zip(keys, matched, strict=True))
    if fans:
        fan = _unused("__fan", left, right)
        hot = F.broadcast(left.sparkSession.createDataFrame(sorted(fans.items()), f"{placed} bigint, {fan} int"))
        number = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in by or left.columns), F.lit("part")), F.col(fan))
        columns = left.columns
        left = left.withColumn(placed, _hash(left, keys)).join(hot, placed, "left")
        left = left.select(*(f"`{c}`" for c in columns), F.coalesce(number, F.lit(0)).cast("int").alias(salt))
        numbers = F.sequence(F.lit(0), F.coalesce(F.col(fan), F.lit(1)) - 1)
        right = right.withColumn(placed, _hash(right, keys)).join(hot, placed, "left").withColumn(salt, F.explode(numbers))
        right = right.drop(placed, fan)
        pairs.append((salt, f"{salt}right"))
    renamed = dict(pairs)
    right = right.select(*(F.col(f"`{c}`").alias(renamed.get(c, c)) for c in right.columns))
    same = "<=>" if null_safe else "="
    joined = left.join(right, F.expr(" AND ".join(f"`{a}` {same} `{b}`" for a, b in pairs)), how)
    return joined.drop(*(b for _, b in pairs), salt)
