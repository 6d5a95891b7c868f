"""Mixing sources to target weights by Sainte-Lague apportionment (operator 12, DataFrame functions only).

1. Sizes are word counts. Rows that agree in source, id, text and size are one row with a count before any shuffle.
2. Targets: sources by code point (null last) take the ``weights`` in turn and share ``share`` of all words. A target
   stops at ``repeat`` times its source's size; the water level of the others rises until none is above. Only
   sums over the table of sources reach the driver.
3. The words to take are blocks of ``block_tokens`` words. Blocks go to the sources with the highest quotients
   ``target / (2 j + 1)``, and a source's blocks go to its shards in the same way. Not every quotient is listed:
   with divisors that are surely too strict and too mild, the sure blocks of each unit are arithmetic, and only
   about two quotients a unit are ranked (by a range-partitioned sort).
4. A shard is a hash part of a source of about ``shard_rows`` rows, so a source with a third of all rows is many shards.
   Its rows, in seeded order, are a ring of words; its quota of blocks is taken from a seeded start on, at most
   ``repeat`` times round. All blocks are equal: they may cut a text, and a text is taken at most ``repeat`` times.

Everything is drawn by hashes of seed, id and text: reruns agree, whatever the partitions.

Defined cases: null or blank texts have size 0 and are never taken; the null source is a source of its own, after all
others; rows without id are told apart by their texts; repeated rows are taken one after another; a very long text is one row
and can be taken in part; an empty table (or one without words) takes nothing; columns other than id, text and source
are not read by ``mix``; ``mixed_texts`` returns id, source and text only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorlab.llm.common import globally_ranked, read_documents, written

WEIGHTS = (5, 2, 1)
SHARE, REPEAT = 1.5, 2
BLOCK_TOKENS = 16
SHARD_ROWS = 500
SEED = "mix"
#: A word, as in the sizes.
WORD = r"[^\x20\x09-\x0D]+"
#: Sources (or shards) up to this count are broadcast to the rows; beyond it the join shuffles, with equal results.
BROADCAST_ROWS = 100_000


def _number(*parts: Column) -> Column:
    """Unsigned 32-bit number from a hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def water_level(sources: DataFrame, amount: float) -> float:
    """Level at which targets ``least(weight * level, cap)`` add up to ``amount`` (infinite if all reach their caps).

    Each round is one sum over the sources; the set of capped ones only grows.
    """
    level, capped = 0.0, -1
    while True:
        over = F.col("cap") < F.col("weight") * level
        sums = sources.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("cap"),
                           F.sum(F.when(~over, F.col("weight")).otherwise(0.0)).alias("weight")).first()
        if sums["n"] == capped:
            return level
        capped = sums["n"]
        if not sums["weight"]:
            return math.inf
        level = (amount - sums["cap"]) / sums["weight"]


def apportion(units: DataFrame) -> DataFrame:
    """Sainte-Lague seats: ``(grp, unit, quota)`` from ``(grp, unit, votes double, seats long)``, seats equal within a group.

    A group's seats go to its highest quotients ``votes / (2 j + 1)``, ties to the smaller unit. With u units and s
    seats the divisor votes / (s - u / 2) gives s seats at most and votes / (s + u / 2) s at least: seats that every
    unit gets under the first are sure, those it lacks under the second are out of reach, and the quotients between are ranked.
    """
    units = units.filter("votes > 0")
    sums = units.groupBy("grp").agg(F.sum("votes").alias("all_votes"), F.count(F.lit(1)).alias("n"))
    with_sums = units.join(sums, "grp")
    share = F.col("votes") / F.col("all_votes")
    # one more on both sides, for the rounding of doubles
    low = F.greatest(F.lit(0), F.floor(share * (F.col("seats") - F.col("n") / 2) + 0.5) - 1).cast("long")
    high = (F.floor(share * (F.col("seats") + F.col("n") / 2) + 0.5) + 1).cast("long")
    ranged = written(with_sums.select("grp", "unit", "votes", "seats", low.alias("low"), high.alias("high")), "apportion")
    candidates = ranged.select("grp", "unit", "votes", F.explode(F.sequence("low", F.col("high") - 1)).alias("j"))
    candidates = candidates.select("grp", "unit", (F.col("votes") / (2 * F.col("j") + 1)).alias("quotient"))
    ranked = globally_ranked(candidates, "rank", F.col("grp"), F.col("quotient").desc(), F.col("unit"))
    groups = ranged.groupBy("grp").agg(F.max("seats").alias("seats"), F.sum("low").alias("sure"))
    groups = groups.join(ranked.groupBy("grp").agg(F.min("rank").alias("first")), "grp")
    won = ranked.join(groups, "grp").filter(F.col("rank") - F.col("first") < F.col("seats") - F.col("sure"))
    won = won.groupBy("grp", "unit").agg(F.count(F.lit(1)).alias("won"))
    return ranged.join(won, ["grp", "unit"], "left").select(
        "grp", "unit", (F.col("low") + F.coalesce("won", F.lit(0))).cast("long").alias("quota"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeat: int = REPEAT,
             block_tokens: int = BLOCK_TOKENS, shard_rows: int = SHARD_ROWS, seed: str = SEED) -> DataFrame:
    """One row per distinct (source, id, text): ``(source, doc_id, text_key, size, copies, source_size, target, shard,
    quota, spans)``. ``spans`` lists what the mix takes: ``(copy, first, last)``, words first + 1 to last of that copy."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("doc_id"), F.md5(text).alias("text_key"),
                       F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long").alias("size"))
    rows = written(rows.groupBy("source", "doc_id", "text_key", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-rows")

    words = F.sum(F.col("size") * F.col("copies"))
    sources = rows.groupBy("source").agg(words.alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = globally_ranked(sources, "src", F.col("source").asc_nulls_last())
    turn = F.pmod(F.col("src") - 1, F.lit(len(weights))).cast("int") + 1
    sources = written(sources.withColumns({
        "grp": F.lit(0), "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn),
        "cap": (F.col("source_size") * repeat).cast("double"),
        "shards": F.ceil(F.col("rows") / shard_rows).cast("long")}), "mix-sources")
    sums = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("source_size").alias("words"), F.sum("shards").alias("shards")).first()
    amount = share * (sums["words"] or 0)
    level = water_level(sources, amount)
    target = F.col("cap") if math.isinf(level) else F.least("cap", F.col("weight") * level)
    sources = sources.withColumn("target", target)
    blocks = math.floor(amount / block_tokens + 0.5)
    quotas = apportion(sources.select("grp", F.col("src").alias("unit"), F.col("target").alias("votes"),
                                      F.lit(blocks).cast("long").alias("seats")))

    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text_key", F.lit("")))
    small = _small(sources.select("source", "src", "source_size", "target", "shards"), sums["n"])
    keyed = rows.withColumn("draw", F.md5(key)).join(small.withColumnRenamed("source", "_source"),
                                                     F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    shard = F.pmod(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long"), F.col("shards"))
    keyed = written(keyed.withColumn("shard", shard).drop("shards"), "mix-keyed")

    shards = keyed.groupBy("src", "shard").agg(words.alias("ring"))
    seats = quotas.select(F.col("unit").alias("grp"), F.col("quota").alias("seats"))
    shared = apportion(shards.withColumnRenamed("src", "grp").join(seats, "grp").select(
        "grp", F.col("shard").alias("unit"), F.col("ring").cast("double").alias("votes"), "seats"))
    most = F.floor(F.col("ring") * repeat / block_tokens)   # no text more than ``repeat`` times
    shards = shards.join(shared.select(F.col("grp").alias("src"), F.col("unit").alias("shard"), "quota"), ["src", "shard"], "left")
    shards = shards.withColumn("quota", F.least(F.coalesce("quota", F.lit(0)), most).cast("long"))
    start = F.pmod(_number(F.lit(f"{seed}:start"), F.col("src").cast("string"), F.col("shard").cast("string")),
                   F.greatest(F.lit(1), F.ceil(F.col("ring") / block_tokens))) * block_tokens
    shards = written(shards.withColumn("start", start.cast("long")), "mix-shards")

    placed = keyed.join(shards, ["src", "shard"])
    order = Window.partitionBy("src", "shard").orderBy("draw", "doc_id", "text_key", "size")
    before = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("at", before)
    stop = F.col("start") + F.col("quota") * block_tokens

    def overlaps(copy: Column) -> Column:
        def of_turn(turn: Column) -> Column:
            first = F.col("at") + copy * F.col("size") + turn * F.col("ring")
            return F.struct(copy.alias("copy"), (F.greatest(first, F.col("start")) - first).alias("first"),
                            (F.least(first + F.col("size"), stop) - first).alias("last"))
        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(repeat).cast("long")), of_turn)

    copies = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)
    spans = F.filter(F.flatten(F.transform(copies, overlaps)), lambda s: s["first"] < s["last"])
    return placed.select("source", "doc_id", "text_key", "size", "copies", "source_size", "target", "shard", "quota",
                         spans.alias("spans"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source, source_size, target, taken, spans)``: one row per row of ``docs``."""
    plan = mix_plan(docs, **options)
    rows = plan.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = rows.withColumn("spans", F.filter("spans", lambda s: s["copy"] == F.col("copy")))
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])
    return rows.select("doc_id", "size", "source", "source_size", "target", taken.alias("taken"), "spans")


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``(doc_id, source, text)``: the mix itself, one row per span taken; words keep what stands between them."""
    plan = mix_plan(docs, id_col, text_col, source_col, **options).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_key").alias("_key"), "spans")
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), text.alias("text"))
    texts = texts.withColumn("key", F.md5("text")).dropDuplicates(["doc_id", "source", "key"])
    taken = texts.join(plan, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
                       & (F.col("key") == F.col("_key")))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    pieces = F.transform("spans", lambda s: F.rtrim(F.array_join(F.slice(words, (s["first"] + 1).cast("int"), (s["last"] - s["first"]).cast("int")), "")))
    return taken.select("doc_id", "source", F.explode(pieces).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    return mix(read_documents(spark, sf_dir, "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


#: Brute force: every quotient is listed and ranked, targets by sorting the caps.
ORACLE = r"""
WITH rows_ AS (
  SELECT source, doc_id, md5(text) AS text_key, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
grouped AS (
  SELECT source, doc_id, text_key, size, count(*) AS copies,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text_key, '')) AS draw
  FROM rows_ GROUP BY source, doc_id, text_key, size),
src AS (
  SELECT source, sum(size * copies) AS source_size, count(*) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS src
  FROM grouped GROUP BY source),
weighed AS (
  SELECT *, CASE (src - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
    CAST(2 * source_size AS DOUBLE) AS cap, CAST(ceil(n / 500.0) AS BIGINT) AS shards FROM src),
total AS (SELECT CAST(sum(source_size) AS DOUBLE) * 1.5::DOUBLE AS amount, sum(w) AS w_all FROM weighed),
levels AS (
  SELECT cap, w, (amount - coalesce(sum(cap) OVER before, 0)) / (w_all - coalesce(sum(w) OVER before, 0)) AS level,
    row_number() OVER (ORDER BY cap / w, src) AS i
  FROM weighed, total
  WINDOW before AS (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT arg_min(level, i) AS level FROM levels WHERE cap >= w * level),
targets AS (SELECT weighed.*, CASE WHEN level IS NULL THEN cap ELSE least(cap, w * level) END AS target FROM weighed, water),
quotients AS (
  SELECT src, target / CAST(2 * j + 1 AS DOUBLE) AS quotient
  FROM (SELECT src, target, unnest(range(0, CAST(2 * target / 16 AS BIGINT) + 3)) AS j FROM targets WHERE target > 0)),
seats AS (
  SELECT src, count(*) AS seats FROM (
    SELECT src, row_number() OVER (ORDER BY quotient DESC, src) AS r FROM quotients), total
  WHERE r <= floor(amount / 16 + 0.5) GROUP BY src),
keyed AS (
  SELECT g.*, t.src, t.source_size, t.target, CAST('0x' || substr(draw, 1, 8) AS BIGINT) % t.shards AS shard
  FROM grouped g JOIN targets t ON g.source IS NOT DISTINCT FROM t.source),
rings AS (SELECT src, shard, CAST(sum(size * copies) AS BIGINT) AS ring FROM keyed GROUP BY src, shard),
parts AS (
  SELECT src, shard, ring / CAST(2 * j + 1 AS DOUBLE) AS quotient
  FROM (SELECT src, shard, CAST(ring AS DOUBLE) AS ring, unnest(range(0, CAST(2 * ring / 16 AS BIGINT) + 3)) AS j FROM rings WHERE ring > 0)),
quotas AS (
  SELECT src, shard, count(*) AS quota FROM (
    SELECT src, shard, row_number() OVER (PARTITION BY src ORDER BY quotient DESC, shard) AS r FROM parts) JOIN seats USING (src)
  WHERE r <= seats GROUP BY src, shard),
shards AS (
  SELECT src, shard, ring, least(coalesce(quota, 0), ring * 2 // 16) * 16 AS words,
    (CAST('0x' || substr(md5('mix:start:' || src || ':' || shard), 1, 8) AS BIGINT) % greatest(1, (ring + 15) // 16)) * 16 AS start
  FROM rings LEFT JOIN quotas USING (src, shard)),
placed AS (
  SELECT k.*, ring, words, start, coalesce(sum(size * copies) OVER (PARTITION BY src, shard ORDER BY draw, doc_id, text_key, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_
  FROM keyed k JOIN shards USING (src, shard)),
copies_ AS (SELECT *, unnest(range(0, copies)) AS copy FROM placed),
turns AS (
  SELECT *, greatest(0, least(a + size, start + words) - greatest(a, start)) AS part
  FROM (SELECT *, at_ + copy * size + turn * ring AS a FROM copies_, (SELECT unnest([0, 1, 2]) AS turn)))
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(sum(part) AS BIGINT) AS taken
FROM turns GROUP BY source, doc_id, text_key, size, copy, source_size, target
"""
