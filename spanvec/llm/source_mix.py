"""Mixing sources to target weights with a low-discrepancy schedule.

Every source gets a target share of the words. The words of a source, in a
shuffled order of its documents, are a stream that may be read several times;
the stream is cut into blocks of equal word counts. Slot ``i`` of the mix has
the golden-ratio point ``frac(i * phi)``; the source whose interval of the
cumulative weights holds the point gets the slot, and the ``r``-th slot of a
source takes the ``r``-th block of its stream. Only DataFrame functions run.

Defined results for odd input:

* a NULL or blank text has size 0, takes no words, and is still returned;
* documents without a source form a source of their own, the last one;
* repeated rows are documents of their own: each has a place in the stream;
* an empty table gives an empty result;
* other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanvec.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
#: i is split here, so that the point of a large i keeps its digits.
SPLIT = 1 << 20
GOLDEN_OF_SPLIT = 0.607787409740351  # frac(SPLIT * phi)
CELLS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def point(i: Column) -> Column:
    """``frac(i * phi)`` with the high and low digits of ``i`` taken apart."""
    high = F.floor(i / SPLIT) * F.lit(GOLDEN_OF_SPLIT)
    low = F.pmod(i, F.lit(SPLIT)) * F.lit(GOLDEN)
    total = (high - F.floor(high)) + (low - F.floor(low))
    return total - F.floor(total)


def targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """``source, source_size`` with ``sid``, ``target`` and ``words``, the target in whole words.

    Sources weigh ``weights`` in turn, in code-point order, NULL last. A target
    stops at ``most`` times its source's size; what is cut is shared out again by
    weight until no target is above. The table has a row per source, so it is
    numbered as a whole; documents are not.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    sid = F.row_number().over(order)
    turn = F.pmod(sid - 1, F.lit(len(weights))) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))
    most_words = F.col("source_size") * F.lit(float(most))
    table = materialize(sources.withColumn("sid", sid).withColumn("weight", weight).withColumn("most", most_words))
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.col("most") <= F.col("weight") * F.lit(level)
        held, free, count = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(over.cast("int")), F.lit(0)),
        ).first()
        if count == capped or not free:
            break
        level, capped = max(0.0, total - held) / free, count
    target = F.least("most", F.col("weight") * F.lit(level)) if total else F.lit(0.0)
    return table.withColumn("target", target).withColumn("words", F.round("target").cast("bigint"))


def schedule(table: DataFrame, block_words: int, total: int) -> DataFrame:
    """``sid, rank, slot``: which block of which source each slot of the mix takes.

    The counts of a low-discrepancy schedule are a few slots off the targets:
    slots beyond a source's target are left out and missing ones follow at the end.
    """
    spark = table.sparkSession
    n = -(-total // block_words)
    upto = F.sum("target").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0))
    need = F.ceil(F.col("words") / F.lit(block_words)).cast("bigint")
    shares = table.where("words > 0").select(
        "sid", need.alias("need"), ((upto - F.col("target")) / F.lit(max(1, total))).alias("lo"), (upto / F.lit(max(1, total))).alias("hi")
    )
    last = F.lit(CELLS - 1).cast("bigint")
    spans = shares.withColumn(
        "cell", F.explode(F.sequence(F.least(last, F.floor(F.col("lo") * CELLS)), F.least(last, F.floor(F.col("hi") * CELLS))))
    )
    points = spark.range(n).select(F.col("id").alias("slot"), point(F.col("id")).alias("p"))
    points = points.withColumn("cell", F.floor(F.col("p") * CELLS))
    placed = points.join(spans, "cell").where("lo <= p and p < hi").select("sid", "need", "slot")
    # Ranks: slots before this chunk of the schedule, then those before this slot in it.
    placed = placed.withColumn("chunk", F.floor(F.col("slot") / 65536))
    chunks = placed.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("sid", "chunk").orderBy("slot")
    ranked = placed.join(chunks, ["sid", "chunk"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    ranked = ranked.where("rank < need").select("sid", "rank", "slot")
    have = placed.groupBy("sid").agg(F.count("*").alias("have"))
    short = shares.join(have, "sid", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < need")
    tail = short.select("sid", F.explode(F.sequence("have", F.col("need") - 1)).alias("rank"))
    return ranked.unionByName(tail.withColumn("slot", F.lit(n) + F.col("rank")))


def place(docs: DataFrame, *, weights=(5.0, 2.0, 1.0), most=3.0, seed: int = 17, docs_per_bucket: int = 4096) -> tuple[DataFrame, DataFrame, int]:
    """Every document with its place in its source's shuffled stream; the sources; all words.

    The shuffled order is a bucket of the hash, then the hash. Offsets come from the
    words of the buckets, so a source with most documents is never in one task.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = materialize(sized.withColumn("h", F.xxhash64("doc_id", "source", "size", F.lit(seed))))
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = materialize(targets(stats, tuple(weights), most))
    rows, total = sized.agg(F.count("*"), F.sum("size")).first()
    buckets = max(1, -(-rows // docs_per_bucket))
    of_source = table.select(F.col("source").alias("_source"), "sid", "source_size", "target", "words")
    known = sized.join(of_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    known = known.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    sums = known.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = known.join(sums, ["sid", "bucket"]).withColumn("start", start).drop("before", "bucket", "h")
    return placed, table, int(total or 0)


def pieces(placed: DataFrame, table: DataFrame, total: int, block_words: int) -> DataFrame:
    """The mix: ``slot, sid, rank``, the document's ``start`` and ``doc_id``, ``epoch``, and the ``words`` it gives there."""
    live = placed.where("size > 0 and words > 0")
    rounds = F.ceil(F.col("words") / F.col("source_size")).cast("bigint")
    read = live.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), rounds - 1)))
    first = F.col("epoch") * F.col("source_size") + F.col("start")
    read = read.withColumn("a", first).withColumn("b", F.least(F.col("a") + F.col("size"), "words")).where("a < b")
    size = F.lit(block_words)
    cut = read.withColumn("rank", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor((F.col("b") - 1) / size))))
    given = F.least("b", (F.col("rank") + 1) * size) - F.greatest("a", F.col("rank") * size)
    cut = cut.select("sid", "rank", "start", "doc_id", "epoch", given.alias("given"))
    return schedule(table, block_words, total).join(cut, ["sid", "rank"])


def mix(docs: DataFrame, *, weights=(5.0, 2.0, 1.0), most: float = 3.0, block_words: int = 512, seed: int = 17) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for each row of ``doc_id, source, text``."""
    placed, table, total = place(docs, weights=weights, most=most, seed=seed)
    placed = materialize(placed)
    taken = pieces(placed, table, total, block_words).groupBy("sid", "start").agg(F.sum("given").alias("taken"))
    out = placed.withColumn("_at", F.when(F.col("size") > 0, F.col("start")))
    out = out.join(taken.select(F.col("sid").alias("_sid"), F.col("start").alias("_start"), "taken"), (F.col("sid") == F.col("_sid")) & (F.col("_at") == F.col("_start")), "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents, all their columns, as often as the mix takes them, to the nearest whole number.

    Rows that share id and source share what is taken of them.
    """
    by_row = mix(docs, **options).groupBy("doc_id", "source").agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
    by_row = by_row.where("_taken > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.round(F.col("_taken") / F.col("_size")).cast("int").alias("_copies")
    )
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & docs["source"].eqNullSafe(F.col("_source"))
    often = docs.join(by_row, same).where("_copies > 0")
    return often.withColumn("_copies", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).select(*[docs[c] for c in docs.columns])
