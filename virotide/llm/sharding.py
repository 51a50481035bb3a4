"""Sharding by balanced label propagation: documents with equal texts move together, shards stay even.

Documents of one text are linked. Linked documents start dealt round robin; in each round every document looks at its
text's documents in other shards and wants to go where most of them are. Capacity quotas bound the moves between two
shards: as many may go as come back, and more as long as the target has room. Documents of one text in one shard move
alike, so a round works on the table ``(text, shard, count)``: three small joins and aggregates, whatever the number of
copies. Documents without a link fill the room that is left at the end.

The law is ``rows``: counts of any two shards differ by one at most. Where a text has more copies than a shard holds,
it takes several shards.

Defined cases: a null text is the empty text; a null or repeated ``doc_id`` is a row like any other; repeated rows are
copies; other columns are ignored; an empty table gives no rows. All steps are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from virotide.llm.common import keep

SHARDS, ROUNDS = 8, 12
#: Copies of a text beyond this part of all rows are dealt over ``SALTS``; there are at most ``HOT_PART`` such texts.
HOT_PART, SALTS = 64, 256
BUCKET_ROWS = 100_000


def _before(df: DataFrame, keys: list[str], amount: str, order: list[Column]) -> DataFrame:
    """``df`` with ``before``: the sum of ``amount`` of the rows that come earlier within ``keys``, by ``bucket`` and ``order``.

    Buckets are summed first, so that no key meets in one task. There are as many sums as keys times buckets, both bounded.
    """
    sums = df.groupBy(*keys, "bucket").agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return out.join(F.broadcast(sums), [*keys, "bucket"]).withColumn("before", F.col("_offset") + F.col("_within")).drop("_offset", "_within")


def _quotas(flows: dict[tuple[int, int], int], room: list[int]) -> list[int]:
    """Documents that may go from shard i to shard j, at place ``i * shards + j``."""
    shards = len(room)
    out = [0] * shards**2
    for j in range(shards):
        left = max(room[j], 0)
        for i in range(shards):
            wanted = flows.get((i, j), 0)
            back = min(wanted, flows.get((j, i), 0))
            more = min(wanted - back, left)
            left -= more
            out[i * shards + j] = back + more
    return out


def _held(places: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["held"] for r in places.groupBy("shard").agg(F.sum("c").alias("held")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _moved(places: DataFrame, moves: DataFrame) -> DataFrame:
    """``places`` after ``moves`` ``(hub, from, to, k)``."""
    gone = moves.select("hub", F.col("from").alias("shard"), (-F.col("k")).alias("c"))
    come = moves.select("hub", F.col("to").alias("shard"), F.col("k").alias("c"))
    return places.unionByName(gone).unionByName(come).groupBy("hub", "shard").agg(F.sum("c").alias("c")).where("c > 0")


def propagate(hubs: DataFrame, capacity: list[int], rounds: int = ROUNDS) -> DataFrame:
    """``(hub, shard, c)``: how many of a hub's ``n`` members go to each shard, at most ``capacity[shard]`` of all hubs.

    ``hubs`` has one row ``(hub, n)`` for each group of linked rows.
    """
    shards = len(capacity)
    turn = F.pmod(F.col("shard") - F.pmod(F.xxhash64("hub"), F.lit(shards)), F.lit(shards))
    dealt = hubs.withColumn("shard", F.explode(F.array(*map(F.lit, range(shards)))))
    dealt = dealt.withColumn("c", F.floor(F.col("n") / shards) + (turn < F.col("n") % shards).cast("long")).where("c > 0")
    places = keep(dealt.select("hub", "shard", "c"), "places")
    idle = 0
    for step in range(rounds):
        room = [most - held for most, held in zip(capacity, _held(places, shards), strict=True)]
        # Every second round all shards are wanted, so that full ones can exchange documents.
        wanted = [s for s in range(shards) if step % 2 or room[s] > 0]
        tie = F.xxhash64("hub", "shard", F.lit(step))
        mine = places.withColumn("pull", F.struct(F.col("c"), tie.alias("tie")))
        best = mine.where(F.col("shard").isin(wanted)).groupBy("hub").agg(F.max(F.struct("pull", "shard")).alias("best"))
        moving = mine.join(best, "hub").where("shard <> best.shard AND pull < best.pull")
        # Small groups first: they come together whole, and what is left goes to groups that no shard holds.
        moving = moving.select(
            "hub", F.col("shard").alias("from"), F.col("best.shard").alias("to"), "c",
            (F.log2(F.col("c").cast("double")).cast("int") * 64 + F.pmod(F.xxhash64("hub", F.lit(step)), F.lit(64))).alias("bucket"),
        )
        moving = keep(moving, "moving")
        flows = {(r["from"], r["to"]): r["c"] for r in moving.groupBy("from", "to").agg(F.sum("c").alias("c")).collect()}
        quota = _quotas(flows, room)
        idle = 0 if sum(quota) else idle + 1
        if idle == 2:
            break
        if not sum(quota):
            continue
        allowed = F.element_at(F.array(*[F.lit(q).cast("long") for q in quota]), (F.col("from") * shards + F.col("to") + 1).cast("int"))
        admitted = _before(moving, ["from", "to"], "c", [F.col("hub")]).withColumn("k", F.least("c", allowed - F.col("before"))).where("k > 0")
        places = keep(_moved(places, admitted), "places")
    return _settle(places, capacity)


def _settle(places: DataFrame, capacity: list[int]) -> DataFrame:
    """``places`` within ``capacity``: what is too much leaves, of the largest groups first, for shards with room."""
    shards = len(capacity)
    held = _held(places, shards)
    over = [max(h - most, 0) for h, most in zip(held, capacity, strict=True)]
    if not sum(over):
        return places
    room = [max(most - h, 0) for h, most in zip(held, capacity, strict=True)]
    starts = [sum(over[:s]) for s in range(shards)]
    pick = lambda numbers, at: F.element_at(F.array(*[F.lit(x).cast("long") for x in numbers]), (at + 1).cast("int"))
    ordered = places.where(F.col("shard").isin([s for s in range(shards) if over[s]])).withColumn("from", F.col("shard"))
    ordered = ordered.withColumn("bucket", (63 - F.log2(F.col("c").cast("double")).cast("int")) * 64 + F.pmod(F.xxhash64("hub"), F.lit(64)))
    leaving = _before(ordered, ["from"], "c", [F.col("hub")]).withColumn("k", F.least("c", pick(over, F.col("from")) - F.col("before"))).where("k > 0")
    leaving = leaving.withColumn("start", pick(starts, F.col("from")) + F.col("before"))
    low = [sum(room[:s]) for s in range(shards)]
    spread = leaving.withColumn("to", F.explode(F.array(*[F.lit(s) for s in range(shards) if room[s]])))
    first, last = F.greatest("start", pick(low, F.col("to"))), F.least(F.col("start") + F.col("k"), pick(low, F.col("to")) + pick(room, F.col("to")))
    moves = spread.withColumn("k", last - first).where("k > 0").select("hub", "from", "to", "k")
    return keep(_moved(places, moves), "places")


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("hub"),
    )


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row."""
    rows = keep(_narrow(docs), "rows")
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    hubs = keep(rows.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1"), "hubs")
    places = propagate(hubs, capacity, rounds)

    # Copies are numbered within their text; those of a frequent text in shares, which are put one behind the other.
    order = F.xxhash64("doc_id", "hub")
    hot = hubs.where(F.col("n") * HOT_PART > total).select("hub", F.lit(True).alias("hot"))
    salted = rows.join(F.broadcast(hot), "hub", "left")
    salted = salted.withColumn("salt", F.when(F.col("hot"), F.pmod(order, F.lit(SALTS)).cast("int")).otherwise(0))
    shares = salted.where("hot").groupBy("hub", "salt").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("hub").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("hub", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    lists = places.groupBy("hub").agg(F.sort_array(F.collect_list(F.struct("shard", "c"))).alias("places"))
    plan = lists.join(F.broadcast(shares), "hub", "left")
    plan = plan.select("hub", "places", F.coalesce("salt", F.lit(0)).alias("salt"), F.coalesce("start", F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("hub", "salt").orderBy("doc_id")) - 1
    numbered = salted.select("doc_id", "size", "text_crc32", "hub", "salt", number.alias("number"))
    place = F.expr(
        "aggregate(places, struct(number + start AS left, -1 AS shard), (got, x) -> CASE WHEN got.shard >= 0 THEN got"
        " WHEN got.left < x.c THEN struct(got.left AS left, x.shard AS shard) ELSE struct(got.left - x.c AS left, -1 AS shard) END).shard"
    )
    buckets = max(64, min(1 << 16, total // BUCKET_ROWS))
    placed = numbered.join(plan, ["hub", "salt"], "left").select(
        "doc_id", "size", "text_crc32", F.coalesce(place, F.lit(-1)).alias("_shard"), F.pmod(order, F.lit(buckets)).cast("int").alias("bucket"), F.lit(1).alias("_one")
    )
    placed = keep(placed, "placed")
    held = [r - h for r, h in zip(capacity, _held(placed.withColumnRenamed("_shard", "shard").withColumn("c", F.col("_one")).where("shard >= 0"), shards), strict=True)]

    # Rows without links (shard -1 so far) fill the room; linked rows of a shard have its first slots.
    found = _before(placed, ["_shard"], "_one", [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    free, slot, at = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        inside = (F.col("before") >= at) & (F.col("before") < at + held[s])
        free = F.when(inside, F.lit(s)).otherwise(free)
        slot = F.when(inside, F.col("before") - at + capacity[s] - held[s]).otherwise(slot)
        at += held[s]
    linked = F.col("_shard") >= 0
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.when(linked, F.col("_shard")).otherwise(free).cast("int").alias("shard"),
        F.when(linked, F.col("before")).otherwise(slot).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
