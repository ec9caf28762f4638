"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are dealt into blocks. With w slots of every c for a source, its block j is released at
slot floor(j c / w) and due by slot ceil((j + 1) c / w). Earliest deadline first among the released blocks fills one
cycle of c slots; as the weights add up to the whole cycle, every block meets its deadline, each source
has exactly w slots in a cycle, and at every slot it is less than one block away from its share. The cycle repeats,
so the slot of any block follows from its number alone: no task sees a whole source and nothing is simulated
beyond one cycle. All rows are kept: when a source runs out its slots stay empty, and the others keep their proportion.

Sources with fewer than ``SMALL`` slots of a cycle would be rounded far off their weights, so they form one group that has exactly
its weight, however many they are: of every two parts of summed weight x and c - x, block j of the first is
at ceil((j + 1) c / x) - 1 and block k of the second at floor(k c / (c - x)), which fills all slots with less than one block of
deviation. The group and the cycle are two such parts, and the group is halved by a balanced tree down to its sources; a slot follows from the number of the block by one step a level.

Numbers inside a source come from buckets of its rows (leading digits of a hash): counts of the buckets
are added up first, and each bucket is numbered on its own, so a hot source is spread over many tasks.

The cycle has one entry for each slot, and fewer than RESOLUTION / SMALL sources have a place in it, which bounds its length.
Sources of the group have no slots in it (null ``mix_slots`` and ``mix_cycle``).

Defined results: rows without a source form a source of their own; the order inside a source is by the MD5 of the id,
then the id (null first), copies of an id in any order; text is never read; sources without rows get no slots; an
empty table gives an empty one; columns of any names are kept, but for those of the names of the results, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, RESOLUTION, MAX_SOURCES = 16, 1000, 2000
BUCKET_ROWS, SMALL = 20_000, 10
_RESULTS = ("mix_slots", "mix_cycle", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position")


def _digest(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def target_weights(docs: DataFrame, source: str = "source") -> DataFrame:
    """source, weight: the square root of the number of rows (in thousandths, cut), which lifts small sources."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.floor(F.sqrt(F.count("*")) * 1000).cast("long").alias("weight"))


def cycle(weights: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """source, slots, cycle and the array ``plan`` of the slots that its blocks take in one cycle.

    Each source has its rounded share of ``resolution`` slots, one at least; the cycle is as long as all of them.
    """
    total = F.sum("weight").over(Window.partitionBy())
    w = weights.filter("weight > 0").select("source", F.greatest(F.lit(1), F.floor((2 * resolution * F.col("weight") + total) / (2 * total))).cast("int").alias("slots"))
    # one row of at most MAX_SOURCES entries
    packed = w.groupBy().agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNotNull().alias("named"), "source", "slots"))).alias("s"))
    packed = packed.filter(F.size("s") > 0).withColumn("s", F.when(F.size("s") <= MAX_SOURCES, F.col("s")).otherwise(F.raise_error(F.lit("too many sources to mix"))))
    packed = packed.withColumn("w", F.transform("s", lambda x: x["slots"]))
    packed = packed.withColumn("cycle", F.aggregate("w", F.lit(0), lambda a, x: a + x))

    # the pick is made inside each step; its result is applied to the counts and appended to the list
    pick = """array_min(filter(transform(w, (x, i) -> named_struct(
            'due', (cast(acc.done[i] + 1 as bigint) * cycle + x - 1) div x, 'i', i, 'released', (cast(acc.done[i] as bigint) * cycle) div x)),
            b -> b.released <= t)).i"""
    fold = f"""aggregate(sequence(0, cycle - 1),
        named_struct('done', transform(w, x -> 0), 'taken', cast(array() as array<int>)),
        (acc, t) -> aggregate(array({pick}), acc, (old, p) -> named_struct(
            'done', transform(old.done, (n, i) -> n + if(i = p, 1, 0)), 'taken', concat(old.taken, array(p)))),
        acc -> acc.taken)"""
    taken = packed.withColumn("taken", F.expr(fold))
    return taken.select("cycle", "taken", F.posexplode("s").alias("i", "x")).select(
        F.col("x.source").alias("source"), F.col("x.slots").alias("slots"), "cycle", F.expr("filter(transform(taken, (p, t) -> if(p = i, t, -1)), t -> t >= 0)").alias("plan")
    )


def levels(weights: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """source, small, levels: from the source outwards, the parts it is in as structs (first, own, whole) of weights; null weights and zeros are left out."""
    everything = Window.partitionBy()
    w = weights.filter("weight > 0").select("source", F.col("weight").cast("decimal(19,0)").alias("weight"))
    w = w.withColumn("total", F.sum("weight").over(everything)).withColumn("small", F.col("weight") * resolution < F.col("total") * SMALL)
    big = w.filter("not small").withColumn("own", F.sum("weight").over(everything))
    big = big.select("source", "small", F.expr("if(own < total, array(named_struct('first', false, 'own', cast(own as decimal(19,0)), 'whole', cast(total as decimal(19,0)))), array())").alias("levels"))
    order = Window.orderBy(F.col("source").asc_nulls_first())
    few = w.filter("small").withColumn("i", F.row_number().over(order) - 1).withColumn("upto", F.sum("weight").over(order).cast("decimal(19,0)"))
    ends = few.groupBy().agg(F.expr("concat(array(cast(0 as decimal(19,0))), transform(array_sort(collect_list(struct(i, upto))), x -> x.upto)) as ends"))
    few = few.crossJoin(F.broadcast(ends)).withColumn("n", F.size("ends") - 1)
    part = "cast(ends[least(n, shiftleft(shiftright(i, {0}) + 1, {0}))] - ends[shiftleft(shiftright(i, {0}), {0})] as decimal(19,0))"
    inner = f"""transform(filter(sequence(0, 30), k -> shiftleft(1L, k) < n), k -> named_struct('first', shiftright(i, k) % 2 = 0, 'own', {part.format("k")},
        'whole', {part.format("(k + 1)")}))"""
    few = few.select("source", "small", F.expr(f"concat({inner}, array(named_struct('first', true, 'own', ends[n], 'whole', cast(total as decimal(19,0)))))").alias("levels"))
    return big.unionByName(few)


def _outward(slot: str, levels: str = "mix__levels") -> str:
    """SQL of the slot outside all parts of a slot inside the innermost."""
    at = "if(x.first, (cast(s + 1 as decimal(19,0)) * x.whole + x.own - 1) div x.own - 1, (cast(s as decimal(19,0)) * x.whole) div x.own)"
    return f"aggregate({levels}, cast({slot} as bigint), (s, x) -> cast({at} as bigint))"


def mix(docs: DataFrame, weights: DataFrame | None = None, source: str = "source", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """docs with mix_slots, mix_cycle, mix_block, mix_release, mix_deadline, mix_slot, mix_position; sort by mix_position for the mixture.

    Rows of sources without a weight are kept behind all others (null position last).
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower() in _RESULTS and c not in (source, key)))
    held = "held__"
    while any(c.lower().startswith(held) for c in docs.columns):
        held += "_"
    held = {c: f"{held}{i}" for i, c in enumerate(docs.columns) if c.lower().startswith(("mix__", "by__")) and c not in (source, key)}
    docs = docs.withColumnsRenamed(held)
    weights = target_weights(docs, source) if weights is None else weights
    parts = levels(weights)
    inside = parts.filter("not small").select(F.col("source").alias("big__"))
    plan = cycle(weights.join(F.broadcast(inside), weights["source"].eqNullSafe(inside["big__"]), "left_semi"))
    parts = parts.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("mix__source"), F.col("small").alias("mix__small"), F.col("levels").alias("mix__levels"))
    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # never null, so that one exchange serves window and joins
    plan = plan.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("mix__source"),
        F.col("slots").alias("mix_slots"), F.col("cycle").alias("mix_cycle"), F.col("plan").alias("mix__plan"),
    )
    plan = parts.join(plan, "mix__source", "left")
    total, digits = docs.count(), 1
    while 16**digits * BUCKET_ROWS < total * 8 and digits < 6:
        digits += 1
    rows = docs.withColumn("mix__source", named).withColumn("mix__digest", _digest(key)).withColumn("mix__bucket", F.substring("mix__digest", 1, digits))
    by = rows.groupBy("mix__source", "mix__bucket").agg(F.count("*").alias("by__n"))
    before = Window.partitionBy("mix__source").orderBy("mix__bucket").rowsBetween(Window.unboundedPreceding, -1)
    by = by.select("mix__source", "mix__bucket", F.coalesce(F.sum("by__n").over(before), F.lit(0)).alias("by__before"))
    own = Window.partitionBy("mix__source", "mix__bucket").orderBy("mix__digest", F.col(key).asc_nulls_first())
    rows = rows.withColumn("mix__n", F.row_number().over(own) - 1)
    rows = rows.join(by, ["mix__source", "mix__bucket"]).join(plan, "mix__source", "left")
    index = F.col("by__before") + F.col("mix__n")
    rows = rows.withColumn("mix_block", F.expr(f"(by__before + mix__n) div {block}"))
    # a source of the group has its window in its innermost part
    least = "mix__levels[0].whole", "mix__levels[0].own", "slice(mix__levels, 2, size(mix__levels))"
    rows = rows.withColumn("mix_slot", F.expr(f"if(mix__small, {_outward('mix_block')}, {_outward('mix_block div mix_slots * mix_cycle + mix__plan[cast(mix_block % mix_slots as int)]')})"))
    release = f"cast((cast(mix_block as decimal(19,0)) * {least[0]}) div {least[1]} as bigint)"
    rows = rows.withColumn("mix_release", F.expr(f"if(mix__small, {_outward(release, least[2])}, {_outward('mix_block * mix_cycle div mix_slots')})"))
    last = f"cast((cast(mix_block + 1 as decimal(19,0)) * {least[0]} + {least[1]} - 1) div {least[1]} - 1 as bigint)"
    rows = rows.withColumn("mix_deadline", F.expr(f"1 + if(mix__small, {_outward(last, least[2])}, {_outward('((mix_block + 1) * mix_cycle + mix_slots - 1) div mix_slots - 1')})"))
    rows = rows.withColumn("mix_position", F.col("mix_slot") * block + index % block)
    return rows.drop("mix__source", "mix__digest", "mix__bucket", "mix__n", "mix__plan", "mix__small", "mix__levels", "by__before").withColumnsRenamed({new: old for old, new in held.items()})


ORACLE = f"""
WITH RECURSIVE counted AS (SELECT source, CAST(floor(sqrt(count(*)) * 1000) AS BIGINT) AS weight FROM documents GROUP BY source),
total AS (SELECT CAST(sum(weight) AS BIGINT) AS total FROM counted),
slots AS (SELECT source, CAST(greatest(1, (2 * {RESOLUTION} * weight + total) // (2 * total)) AS BIGINT) AS slots FROM counted, total),
packed AS (SELECT list(slots ORDER BY source NULLS FIRST) AS w, list(source ORDER BY source NULLS FIRST) AS names, CAST(sum(slots) AS BIGINT) AS cyc FROM slots),
steps AS (
  SELECT -1::BIGINT AS t, list_transform(w, lambda x: 0::BIGINT) AS done, -1::BIGINT AS pick FROM packed
  UNION ALL
  SELECT t + 1, list_transform(range(len(w)), lambda i: done[i + 1] + CASE WHEN i = p THEN 1 ELSE 0 END), p FROM (
    SELECT t, done, w, cyc, (list_min(list_filter(list_transform(range(len(w)), lambda i:
        {{'due': ((done[i + 1] + 1) * cyc + w[i + 1] - 1) // w[i + 1], 'i': i, 'released': done[i + 1] * cyc // w[i + 1]}}),
        lambda b: b.released <= t + 1))).i AS p
    FROM steps, packed WHERE t + 1 < cyc)
),
plan AS (SELECT names[pick + 1] AS source, w[pick + 1] AS slots, cyc, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k, t FROM steps, packed WHERE t >= 0),
numbered AS (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1) AS n FROM documents)
SELECT doc_id, numbered.source AS source, CAST(slots AS INTEGER) AS slots, n // {BLOCK} AS block, (n // {BLOCK}) * cyc // slots AS release,
  ((n // {BLOCK} + 1) * cyc + slots - 1) // slots AS deadline, (n // {BLOCK}) // slots * cyc + t AS slot,
  ((n // {BLOCK}) // slots * cyc + t) * {BLOCK} + n % {BLOCK} AS position
FROM numbered JOIN plan ON numbered.source IS NOT DISTINCT FROM plan.source AND (n // {BLOCK}) % slots = k
"""
