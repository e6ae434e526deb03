"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Documents with equal texts are linked. Law ``rows``: the shards' row counts are at most one apart, always.

* Every document starts in a shard by hash. The documents of one text in one shard are interchangeable, so the
  state of the propagation is (text, shard, count): a text with a third of all rows is a few dozen rows of it.
* A round joins each (text, shard) with the text's fullest shard that has room, and moves the documents there as
  far as the shard's free quota goes (the same share of all that want in). It ends when nothing moves, or after
  ``rounds`` rounds: a few rounds bring nearly all there is to gain, and any state gives balanced shards.
* Then documents take their places: a document's rank inside its text falls into a count's interval, which gives
  its shard; ranks inside a shard give slots; what lies beyond a shard's quota (unlinked documents come last and
  go first) fills the free seats of others. Ranks are computed in two levels, by counts of small salted parts and
  row numbers inside a part, so that no window holds a whole shard or a whole text.

DataFrame functions only. The driver sees a few numbers per shard. Each state is a written table.

Defined results: a null text counts as no bytes and is equal to the empty text; repeated rows each get a slot of
their own; a null doc_id is placed like any other; further columns are not read; an empty table gives an empty
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provenant.llm.common import documents, drop_written, written

#: Ranks of a text that are joined with their places in one group.
STRETCH = 256
#: Parts of a shard for the second level of its ranks: a constant, so the table of counts is bounded.
PARTS = 256
RESULT = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, h): all that is needed of a text. ``h`` with size and CRC stands for the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"))


def ranked_in_text(base: DataFrame, salts: int) -> DataFrame:
    """``base`` with n (documents of the same text) and r (0-based rank among them)."""
    key = ["h", "size", "text_crc32"]
    salted = base.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    counts = salted.groupBy(*key, "salt").agg(F.count("*").alias("m"))
    before = W.partitionBy(*key).orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*key, "salt", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"), F.sum("m").over(W.partitionBy(*key)).alias("n"))
    rank = F.row_number().over(W.partitionBy(*key, "salt").orderBy("doc_id")) - 1
    return salted.withColumn("k", rank).join(counts, [*key, "salt"]).select("doc_id", *key, "n", (F.col("before") + F.col("k")).alias("r"))


def at(values: list[int], index: Column) -> Column:
    """Element of a short list of constants."""
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), index + 1)


def shares(flow: dict[tuple[int, int], int], room: list[int]) -> list[float]:
    """The share of the movers into each shard that fits, when what moves out makes room too."""
    share = [1.0] * len(room)
    for _ in range(50):
        into, out = [0.0] * len(room), [0.0] * len(room)
        for (i, j), n in flow.items():
            into[j] += n
            out[i] += n * share[j]
        share = [min(share[j], max(0.0, room[j] + out[j]) / into[j]) if into[j] else 1.0 for j in range(len(room))]
    return share


def propagate(spark: SparkSession, state: DataFrame, quotas: list[int], rounds: int) -> DataFrame:
    """Move the counts of ``state`` (h, size, text_crc32, shard, m) until nothing moves."""
    key, shut = ["h", "size", "text_crc32"], set()
    for n in range(rounds):
        load = dict(state.groupBy("shard").agg(F.sum("m")).collect())  # a row for each shard
        weight = F.struct("m", F.xxhash64(*key, "shard"), "shard")
        best = state.filter(~F.col("shard").isin(*shut, -1)).groupBy(*key).agg(F.max(weight).alias("goal"))
        wants = state.join(best, key).filter(F.col("goal") > weight).select(*key, "shard", F.col("goal.shard").alias("to"), "m")
        wants = written(spark, wants)
        flow = {(r["shard"], r["to"]): r["m"] for r in wants.groupBy("shard", "to").agg(F.sum("m").alias("m")).collect()}
        share = shares(flow, [q - load.get(j, 0) for j, q in enumerate(quotas)])
        part = F.col("m") * F.element_at(F.array(*map(F.lit, share)), F.col("to") + 1)
        draw = F.pmod(F.xxhash64(*key, "shard", F.lit(n)), F.lit(1 << 20)) / (1 << 20)
        moves = wants.select(*key, "shard", "to", F.floor(part + draw).cast("long").alias("m")).filter("m > 0")
        after = state.unionByName(moves.select(*key, "shard", (-F.col("m")).alias("m"))).unionByName(moves.select(*key, F.col("to").alias("shard"), "m"))
        after = written(spark, after.groupBy(*key, "shard").agg(F.sum("m").alias("m")).filter("m > 0"))
        drop_written(spark, wants, state)
        state = after
        full = {j for _, j in flow if share[j] < 0.02}
        if not flow or (full and full <= shut):
            break
        shut = full
    return state


def balanced_shards(spark: SparkSession, docs: DataFrame, shards: int = 24, rounds: int = 8) -> DataFrame:
    """The columns of ``RESULT`` for each row of ``docs`` (doc_id, text)."""
    key = ["h", "size", "text_crc32"]
    base = written(spark, measured(docs))
    total = base.count()
    quotas = [total // shards + (j < total % shards) for j in range(shards)]
    ranked = written(spark, ranked_in_text(base, max(16, total // 4000)))
    drop_written(spark, base)

    first = F.pmod(F.xxhash64("h", "doc_id"), F.lit(shards)).cast("int")
    state = ranked.filter("n > 1").groupBy(*key, first.alias("shard")).agg(F.count("*").alias("m"))
    state = propagate(spark, written(spark, state), quotas, rounds)

    upto = F.sum("m").over(W.partitionBy(*key).orderBy("shard"))
    places = state.select(*key, "shard", (upto - F.col("m")).alias("lo"), upto.alias("hi"))
    # A text's documents meet their places by stretches of ranks, so that a hot text is many small joins.
    places = places.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("lo") / STRETCH), F.floor((F.col("hi") - 1) / STRETCH))))
    ranks = ranked.filter("n > 1").withColumn("stretch", F.floor(F.col("r") / STRETCH))
    linked = ranks.join(places, [*key, "stretch"]).filter("r >= lo and r < hi").select(*ranked.columns, "shard", F.lit(0).alias("single"))
    single = ranked.filter("n = 1").select("*", first.alias("shard"), F.lit(1).alias("single"))
    placed = linked.unionByName(single).withColumn("part", F.pmod(F.xxhash64("doc_id", "h"), F.lit(PARTS)).cast("int"))
    placed = written(spark, placed)

    counts = placed.groupBy("shard", "single", "part").agg(F.count("*").alias("m"))
    sums = W.partitionBy("shard").orderBy("single", "part")
    counts = counts.select("shard", "single", "part", (F.sum("m").over(sums) - F.col("m")).alias("before"))
    load = dict(placed.groupBy("shard").count().collect())
    loads = [load.get(j, 0) for j in range(shards)]
    over = [max(0, n - q) for n, q in zip(loads, quotas, strict=True)]
    free = [max(0, q - n) for n, q in zip(loads, quotas, strict=True)]
    over_before, free_upto = [sum(over[:j]) for j in range(shards)], [sum(free[: j + 1]) for j in range(shards)]

    within = F.row_number().over(W.partitionBy("shard", "single", "part").orderBy("doc_id", "h")) - 1
    out = placed.withColumn("k", within).join(F.broadcast(counts), ["shard", "single", "part"])  # at most 48 * PARTS rows
    out = out.withColumn("k", F.col("before") + F.col("k"))
    beyond = F.col("k") - at(quotas, F.col("shard"))
    seat = at(over_before, F.col("shard")) + beyond
    to = F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in free_upto)), lambda x: x <= F.col("seat")))
    out = out.withColumn("seat", F.when(beyond >= 0, seat)).withColumn("to", F.when(F.col("seat").isNotNull(), to))
    taken = [n + f - u for n, f, u in zip(loads, free, free_upto, strict=True)]
    return out.select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        F.coalesce("to", "shard").cast("int").alias("shard"),
        F.coalesce(at(taken, F.col("to")) + F.col("seat"), F.col("k")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(spark, documents(spark, sf_dir))
