"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, and may be played twice. A pass
of a document gets a virtual finish time: the words its source has played up to its end, divided
by the source's weight. All passes are sorted by that time over the whole corpus and the order
is cut where the budget of words is spent. A source that runs dry leaves the rest of the budget
to the others in proportion to their weights, so the cut order meets the capped targets.

The running word counts come from bucket sums, so no task holds a whole source: a document's
place is the sum of the buckets before its own plus its place inside. The shuffle is a hash of
the id, the text and a number among rows equal in both, hence reruns agree, and rows spread over
the buckets though they share an id or have none.

Null source: a source of its own, ordered last. Documents without words have size 0 and take
nothing. Repeated rows are queued each. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotegrid.llm.common import PLACE, few_files, place, settle, stable, text_of, words_of
from quotegrid.llm.turns import numbered

#: Fixed by the contract: weights in source order, share of all words, passes at most.
WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_PASSES = 2

SEED = "mix-1"
ROWS_PER_BUCKET = 1_000
ROWS_PER_PART = 8_000
MAX_PARTS = 4_000


def sizes(docs: DataFrame) -> DataFrame:
    """The narrow form of ``stable`` documents: id, source, words, place in the shuffle."""
    text = text_of()
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    source = F.col("source").cast("string")
    narrow = docs.select(
        "doc_id",
        F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source)).alias("queue"),
        F.size(words_of(text)).cast("bigint").alias("size"),
        F.concat(F.lit(f"{SEED}:"), named, F.lit(":"), F.md5(text)).alias("name"),
        *place(),
    )
    # Rows equal in id and text are numbered, without gathering them in a task.
    shuffled = F.md5(F.concat("name", F.lit(":"), F.col("pos").cast("string")))
    return numbered(narrow, "name", []).withColumn("place", shuffled).drop("name", "pos")


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: weight, size and the words it should give.

    Sources are few; the windows without a key run over one row per source.
    """
    by_name = Window.orderBy(F.col("queue") == "0", "queue")
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    sources = (
        sized.groupBy("queue")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.get(weights, (F.col("rank") - 1) % len(WEIGHTS)))
        .withColumn("cap", MAX_PASSES * F.col("source_size"))
    )
    everything = Window.partitionBy()
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    filled = sources.select(
        "*",
        (F.sum("source_size").over(everything) * BUDGET_SHARE).alias("budget"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.sum("weight")
        .over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        .alias("weight_left"),
    ).withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("weight_left"))
    dry = F.col("cap") <= F.col("weight") * F.col("level")
    # The level of the first source that does not run dry holds for all after it.
    common = F.min_by(F.when(~dry, F.col("level")), F.when(~dry, F.col("cap") / F.col("weight")))
    return filled.withColumn("common", common.over(everything)).select(
        "queue",
        "rank",
        "weight",
        "source_size",
        "budget",
        F.when(dry, F.col("cap").cast("double"))
        .otherwise(F.col("weight") * F.col("common"))
        .alias("target"),
    )


def _hex_digits(rows: int) -> int:
    """Leading hex digits of the place that make buckets of about ROWS_PER_BUCKET rows."""
    return max(1, math.ceil(math.log(max(rows / ROWS_PER_BUCKET, 1), 16)))


def queued(sized: DataFrame, rows: int) -> DataFrame:
    """Adds ``before``: the words of the source's documents that come earlier."""
    split = sized.withColumn("bucket", F.substring("place", 1, _hex_digits(rows)))
    sums = split.groupBy("queue", "bucket").agg(F.sum("size").alias("bucket_size"))
    offsets = sums.select(
        "queue",
        "bucket",
        (
            F.sum("bucket_size").over(Window.partitionBy("queue").orderBy("bucket"))
            - F.col("bucket_size")
        ).alias("bucket_before"),
    )
    inside = (
        Window.partitionBy("queue", "bucket")
        .orderBy("place", *PLACE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        split.withColumn("inside", F.sum("size").over(inside))
        .join(offsets, ["queue", "bucket"])
        .withColumn("before", F.col("bucket_before") + F.col("inside") - F.col("size"))
    )


def finish_time(turn: int) -> Column:
    played = turn * F.col("source_size") + F.col("before") + F.col("size")
    return played / F.col("weight")


def _cut(passes: DataFrame, rows: int, budget: float) -> tuple[float, int] | None:
    """The last (finish time, source rank) of the globally sorted passes within the budget.

    The part in which the budget ends is sorted in one task if it is small, else dealt out again.
    """
    best, spent, left = None, 0, rows * MAX_PASSES
    per_part = Window.orderBy("part")  # one row per part
    while True:
        parts = min(MAX_PARTS, max(1, math.ceil(left / ROWS_PER_PART)))
        dealt = passes.repartitionByRange(parts, "finish", "rank")
        ordered = settle(dealt.withColumn("part", F.spark_partition_id()), "mix-order")
        sums = ordered.groupBy("part").agg(
            F.sum("size").alias("words"),
            F.count("*").alias("n"),
            F.max(F.struct("finish", "rank")).alias("last"),
        )
        upto = F.lit(spent) + F.sum("words").over(per_part)
        sums = sums.withColumn("upto", upto).withColumn("within", F.col("upto") <= budget)
        last = sums.filter("within").agg(F.max("last").alias("last")).first()["last"]
        if last is not None:
            best = max(best or (last["finish"], last["rank"]), (last["finish"], last["rank"]))
        crossing = sums.filter("NOT within").orderBy("part").first()
        if crossing is None:
            return best
        spent = crossing["upto"] - crossing["words"]
        passes = ordered.filter(F.col("part") == crossing["part"]).drop("part")
        if crossing["n"] <= 4 * ROWS_PER_PART or crossing["n"] == left:
            break
        left = crossing["n"]
    running = Window.orderBy("finish", "rank", "size")
    inside = passes.withColumn("upto", F.lit(spent) + F.sum("size").over(running))
    last = inside.filter(F.col("upto") <= budget).agg(F.max(F.struct("finish", "rank")).alias("l")).first()["l"]
    return best if last is None else (last["finish"], last["rank"])


def mix(docs: DataFrame) -> DataFrame:
    """Every document with its source's target and the passes the mix takes of it, by PLACE."""
    sized = settle(sizes(stable(docs)), "mix-sizes")
    rows = sized.count()
    goals = settle(targets(sized), "mix-targets")
    lined = settle(few_files(queued(sized, rows).join(goals, "queue"), rows), "mix-queues")
    some = goals.select("budget").first()
    passes = lined.select(
        "rank",
        "size",
        F.explode(F.array(*(finish_time(turn) for turn in range(MAX_PASSES)))).alias("finish"),
    ).filter("size > 0")
    cut = _cut(passes, rows, some["budget"]) if some else None
    taken = F.lit(0)
    if cut is not None:
        time, rank = cut
        for turn in range(MAX_PASSES):
            finish = finish_time(turn)
            in_time = (finish < time) | ((finish == time) & (F.col("rank") <= rank))
            taken = taken + F.when(in_time, 1).otherwise(0)
    source = F.when(F.col("queue") != "0", F.expr("substring(queue, 2)"))
    return lined.select(
        "doc_id",
        source.alias("source"),
        "size",
        "source_size",
        "target",
        taken.alias("passes"),
        (F.col("size") * taken).cast("bigint").alias("taken"),
        *PLACE,
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix plays them: each row as often as it is taken, columns as they are.

    A document without words follows its place in the queue.
    """
    docs = stable(docs)
    taken = mix(docs).filter("passes > 0").select(*PLACE, "passes")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), *place())
    return (
        rows.join(taken, PLACE)
        .withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("passes"))))
        .select("row.*")
    )
