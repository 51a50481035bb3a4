"""Dataflow operators over manifest-like tables: joins, branches, groups, value columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from virotide.operators.tiles import attach
from virotide.session import cut_lineage


def match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on the key element; rows without a partner vanish."""
    return left.join(right, list(keys), "inner")


def match_all(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on null-safe keys; each side is read and moved once.

    Keys are those of manifests and sites. For a key that holds much of one table use `salted_match`.
    """
    same = reduce(lambda x, y: x & y, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    both = left.alias("l").join(right.alias("r"), same, "full_outer")
    keyed = [F.coalesce(f"l.{c}", f"r.{c}").alias(c) if c in keys else F.col(f"l.{c}") for c in left.columns]
    return both.select(*keyed, *[F.col(f"r.{c}") for c in right.columns if c not in keys])


def product(left: DataFrame, right: DataFrame, slots: int = 64) -> DataFrame:
    """Every left row with every right row, for frames whose product is the result itself.

    ``left`` is dealt to ``slots`` by its content and ``right`` copied to each slot: an equi-join over
    many tasks, with no list in one cell.
    """
    dealt = left.withColumn("_slot", F.pmod(F.xxhash64(*left.columns), F.lit(slots)).cast("int"))
    copied = right.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return dealt.join(copied, "_slot").drop("_slot")


def _plain(columns: Sequence[str]) -> dict[str, Column]:
    """Each column as a text that tells its values and null apart, under a name of its own: a join key that needs no null-safe test."""
    return {f"_key_{i}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for i, c in enumerate(columns)}


def product_with(
    left: DataFrame, right: DataFrame, values: DataFrame, block: Sequence[str], pair: Sequence[str], slots: int = 64, runs: bool = False
) -> DataFrame:
    """`product`, with the other columns of ``values`` where that holds the pair (else null).

    ``values`` has the columns of ``left`` (distinct rows), those of ``block`` and of ``pair``, by which it is unique; ``right`` has the latter
    two. A block holds some hundred right rows. Only (left row, block) moves, once, with its values as a map: the product
    comes out of the last join and is never shuffled. Values that are dealt by left row and block do not move to become maps.
    With ``runs`` the rows of one right row follow each other, so its columns are written as runs; else those of one left row.
    """
    extra = [c for c in values.columns if c not in (*left.columns, *block, *pair)]
    key = [*left.columns, *block]
    entries = F.collect_list(F.struct(F.struct(*pair).alias("key"), F.struct(*extra).alias("value")))
    maps = values.groupBy(*key).agg(F.map_from_entries(entries).alias("_values")).withColumn("_asked", F.lit(False))
    frame = product(left, right.select(*block).distinct(), slots).withColumn("_asked", F.lit(True))
    plain = _plain(block)
    slot = F.pmod(F.xxhash64(*left.columns), F.lit(slots)).cast("int")
    both = frame.unionByName(maps, allowMissingColumns=True).withColumn("_slot", slot).withColumns(plain)
    # Dealt as the join below needs it: a left row's block meets its values here, nulls included.
    dealt = both.repartition("_slot", *plain).groupBy(*key, "_slot", *plain).agg(
        F.first("_values", ignorenulls=True).alias("_values"), F.max("_asked").alias("_asked")
    ).filter("_asked")
    copied = right.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).withColumns(plain)
    same = reduce(lambda x, y: x & y, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("_slot", *plain)])
    # The planner takes exploded rows for as few as those before, and would send all copies through the driver.
    dealt, copied = dealt.hint("shuffle_merge").alias("l"), copied.hint("shuffle_merge").alias("r")
    sides = (copied, dealt) if runs else (dealt, copied)
    held = F.try_element_at("l._values", F.struct(*[F.col(f"r.{c}") for c in pair]))
    out = sides[0].join(sides[1], same).select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in right.columns], held.alias("_held"))
    return out.select("*", *[F.col(f"_held.{c}").alias(c) for c in extra]).drop("_held")


def hot_keys(df: DataFrame, keys: Sequence[str], slots: int = 64) -> DataFrame:
    """Keys that hold more than 1/``slots`` of the rows: fewer than ``slots`` rows by construction."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counts.filter(F.col("_n") * slots > total.scalar()).select(*keys)


def salted_match(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", slots: int = 64
) -> DataFrame:
    """Inner or left join that spreads the hot keys of ``left`` over ``slots`` tasks.

    Rows of hot keys get a salt from their content and the right rows of those keys are copied to
    each salt. The hot-key list has fewer than ``slots`` rows, which is why it may be broadcast.
    """
    if how not in ("inner", "left"):
        raise ValueError("salting needs an inner or left join")
    hot = F.broadcast(hot_keys(left, keys, slots).withColumn("_hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(slots)).cast("int")
    marked = attach(left, hot, keys).withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0)))
    spread = attach(right, hot, keys).withColumn("_salt", F.explode(copies)).drop("_hot")
    return marked.drop("_hot").join(spread, [*keys, "_salt"], how).drop("_salt")


def with_value(df: DataFrame, value: DataFrame, column: str) -> DataFrame:
    """Pair each row with the one value of a value table (more than one row is an error)."""
    return df.withColumn(column, value.select(column).scalar())


def mix(*tables: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def concat(*tables: DataFrame, tag: str = "part") -> DataFrame:
    """Ordered union: ``tag`` keeps the place of each table for sinks that sort."""
    return mix(*[t.withColumn(tag, F.lit(i)) for i, t in enumerate(tables)])


def branch(df: DataFrame, rules: Mapping[str, Column], label: str = "branch") -> DataFrame:
    """Label rows with the first rule that holds; rows that match none are dropped."""
    chain = F
    for name, rule in rules.items():
        chain = chain.when(rule, F.lit(name))
    return df.withColumn(label, chain).filter(F.col(label).isNotNull())


def or_default(df: DataFrame, **defaults: object) -> DataFrame:
    """The table itself, or one row of defaults if it is empty (decided inside the plan)."""
    one = df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in defaults.items()])
    filled = df.agg(F.count(F.lit(1)).alias("n"))
    return df.select(*defaults).unionByName(one.filter(filled.scalar() == 0))


def first_row(df: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """First row per key by ``order``, as an aggregate (combines map side, no sort)."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )


def last_row(df: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
    )


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "idx") -> DataFrame:
    """Zero-based place of each row within its key, for text orders that have no numeric axis.

    Rows are range-partitioned by (keys, order); the partition number becomes part of the window
    key, so a hot key is numbered by many tasks, and each key's offset per partition comes from the
    counts of its earlier partitions. The range partitioning is cut by a checkpoint because both
    halves must see the same partition numbers.
    """
    sorted_parts = df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    fixed = cut_lineage(sorted_parts)
    counts = fixed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    numbered = attach(fixed, offsets, [*keys, "_part"])
    return numbered.withColumn(out, (place - 1 + F.col("_offset")).cast("bigint")).drop("_part", "_offset")


def group_tuple(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Group rows by key in long form: the group keeps one row per element, with its place and size.

    A list per key would put a hot key into one cell; place and size say the same at any size.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("group_size"))
    return number_within(df, [key], order).join(sizes, key)


def contig_difference(wanted: DataFrame, known: DataFrame, column: str = "contig") -> DataFrame:
    """Set intersection and difference of two lists: each wanted value, with whether it is known."""
    seen = known.select(column).distinct().withColumn("known", F.lit(True))
    return wanted.select(column).distinct().join(seen, column, "left").fillna(False, ["known"])
