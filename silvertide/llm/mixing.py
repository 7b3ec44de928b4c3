"""Mixing sources to target weights by fitting subset sums.

A source takes all of its documents once or twice as often as its target has room for that, and a subset of them for the
rest. The subset is planned on the counts of documents by exact length: every length gives its share, and a bounded
knapsack over the lengths that are left closes the remaining budget. Which documents of a length are taken is decided
by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silvertide.llm.shared import materialize, named, plain_id, spare_name
from silvertide.llm.text_buffers import NON_SPACE, pieces, word_spans

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_TIMES = 2
SEED = 20240
#: Largest budget that is left to the knapsack where documents allow it.
KNAPSACK = 1 << 16
#: Hash ranges that the documents of one source and length are dealt over, so that no length is ranked in one task.
RANGES = 1024
#: Most equal rows that are ranked as one; more of them are dealt over the ranges in chunks.
CHUNK = 4096


def row_mark() -> Column:
    """Tells rows with the same doc_id apart by text and source."""
    return F.xxhash64("text", "source")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, mark, size): words of each whole text; null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text"):
            counts = word_spans(data, offsets, NON_SPACE)[2].astype(np.int64)
            names = ["doc_id", "source", "mark"]
            yield pa.RecordBatch.from_arrays([*map(rows.column, names), pa.array(counts)], [*names, "size"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "source", row_mark().alias("mark"), "text").mapInArrow(run, f"doc_id {kind}, source string, mark long, size long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_TIMES) -> DataFrame:
    """(named, source, source_size, target) of a table with one row per source.

    Sources in the order of their code points, null last, weigh as given, in turns. Together they get share times all
    sizes; none gets more than most times its own size, and what it leaves is shared out again by weight. In the order of
    cap / weight the capped sources come first, so the level of the others is found by running sums.
    """
    ordered = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("named"), "source")) - 1)
    level = Window.orderBy("ratio", "rank")
    caps = (
        ordered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    everything = Window.partitionBy()
    running = (
        caps.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("capped", F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("weight_left", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("height", (F.col("total") - F.coalesce("capped", F.lit(0.0))) / F.col("weight_left"))
    )
    # The first source in that order whose cap is not reached sets the level for all from there on.
    final = running.withColumn("level", F.min(F.when(F.col("height") <= F.col("ratio"), F.struct("ratio", "rank", "height"))).over(everything))
    target = F.when(F.col("level").isNull() | (F.col("cap") <= F.col("level.height") * F.col("weight")), F.col("cap"))
    return final.select("named", "source", "source_size", target.otherwise(F.col("level.height") * F.col("weight")).alias("target"))


def fit_lengths(lengths: list[int], counts: list[int], budget: int, knapsack: int = KNAPSACK) -> list[int]:
    """How many documents of each length to take so that their sum comes closest to budget from below.

    Shares first, then the largest that fit while the rest is above the knapsack's size, then dynamic programming on a
    bit set of reachable sums, which ends as soon as the rest is met exactly. budget is below the sum of all.
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if budget <= 0 or total <= 0:
        return [0] * len(lengths)
    taken = [c * budget // total for c in counts]
    rest = budget - sum(n * t for n, t in zip(lengths, taken, strict=True))
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if lengths[i] and rest - knapsack >= lengths[i]:
            more = min(counts[i] - taken[i], (rest - knapsack) // lengths[i])
            taken[i] += more
            rest -= more * lengths[i]
    parts: list[tuple[int, int]] = []  # place and number of documents that are taken together
    reached, before, limit = 1, [], (1 << (rest + 1)) - 1
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i]):
        left, bundle = (min(counts[i] - taken[i], rest // lengths[i]) if lengths[i] else 0), 1
        while left > 0 and not reached >> rest & 1:
            bundle = min(bundle, left)
            before.append(reached)
            parts.append((i, bundle))
            reached |= reached << (bundle * lengths[i]) & limit
            left -= bundle
            bundle *= 2
    best = reached.bit_length() - 1
    for (i, bundle), old in zip(reversed(parts), reversed(before), strict=True):
        if not old >> best & 1:
            taken[i] += bundle
            best -= bundle * lengths[i]
    return taken


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """One source: how often all documents are taken, and how many of each length once more."""
    group = group.sort_values("size")
    lengths, counts = group["size"].tolist(), group["n"].tolist()
    own, want = int(group["source_size"].iloc[0]), round(float(group["target"].iloc[0]))
    times = want // own if own else 0
    return group.assign(times=times, extra=fit_lengths(lengths, counts, want - times * own))


def counted(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, mark, named, source, size, n, lot, part): rows of sized(), equal ones counted by at most CHUNK in a row.

    lot is the seeded hash that orders the rows of a length; chunks of the same rows have lots of their own.
    """
    known = rows.select("doc_id", "mark", F.col("source").isNotNull().alias("named"), F.coalesce("source", F.lit("")).alias("source"), "size")
    groups = known.groupBy("doc_id", "mark", "named", "source", "size").agg(F.count(F.lit(1)).alias("all"))
    chunks = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr(f"int((`all` - 1) div {CHUNK})"))))
    first = F.xxhash64(F.lit(seed), "doc_id", "mark")
    lot = F.when(F.col("chunk") == 0, first).otherwise(F.xxhash64(first, "chunk"))
    return chunks.select(
        "doc_id", "mark", "named", "source", "size", F.least(F.lit(CHUNK), F.col("all") - F.col("chunk") * CHUNK).alias("n"),
        lot.alias("lot"), F.pmod(lot, F.lit(RANGES)).cast("int").alias("part"),
    )


def mix(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, mark, size, source_size, target, taken) for each row of sized().

    taken is 0, size or twice size. A null source is a source, the last in order. Rows with equal doc_id, source
    and text change places freely, so they are counted and ranked together. Sources without words have target 0. An empty
    table gives no rows.
    """
    rows = materialize(counted(rows, seed), "mix-counted")
    key = ["named", "source", "size"]
    ranges = rows.groupBy(*key, "part").agg(F.sum("n").alias("n"))
    histogram = materialize(ranges.groupBy(key).agg(F.sum("n").alias("n")), "mix-lengths")
    wanted = targets(histogram.groupBy("named", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    schema = "named boolean, source string, size long, n long, source_size long, target double, times long, extra long"
    # A group has one row per length that occurs in the source, not one per document.
    plan = histogram.join(wanted, ["named", "source"]).select("named", "source", "size", "n", "source_size", "target")
    plan = materialize(plan.groupBy("named", "source").applyInPandas(_plan, schema).drop("n"), "mix-plan")
    running = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    quota = ranges.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))).join(plan, key)
    quota = quota.select(*key, "part", "source_size", "target", "times", (F.col("extra") - F.col("before")).alias("quota"))
    own = Window.partitionBy(*key, "part").orderBy("lot", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("place", F.coalesce(F.sum("n").over(own), F.lit(0)))
    each = ranked.join(quota, [*key, "part"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    once_more = F.when(F.col("place") + F.col("copy") <= F.col("quota"), F.col("size")).otherwise(F.lit(0))
    return each.select("doc_id", "mark", "size", "source_size", "target", (F.col("times") * F.col("size") + once_more).alias("taken"))


def mix_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """mix() of whole documents; their texts are read once and not shuffled."""
    return mix(sized(docs), seed)


def taken_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of docs, with all columns, as many times as the mix takes them: never, once or twice.

    Columns of docs may have any names besides doc_id, text and source.
    """
    place, taken_id, twice, some = (spare_name(docs, n) for n in ("place", "taken_id", "taken_twice", "taken_at_all"))
    keys = [spare_name(docs, n) for n in ("no_id", "plain_id", "row_mark")]
    times = F.col("taken") / F.col("size")
    turns = mix_documents(docs, seed).where("taken > 0").groupBy(F.col("doc_id").alias(taken_id), F.col("mark").alias(keys[2])).agg(
        F.count_if(times == 2).alias(twice), F.count(F.lit(1)).alias(some)
    )
    turns = turns.select(*(c.alias(n) for c, n in zip(plain_id(F.col(taken_id)), keys, strict=False)), keys[2], twice, some)
    own = Window.partitionBy(*keys).orderBy(keys[2])
    placed = docs.withColumns(dict(zip(keys, [*plain_id(F.col("doc_id")), row_mark()], strict=True)))
    # The join and the numbering of repeated rows have the same keys: texts are shuffled once.
    taken = placed.join(turns, keys).withColumn(place, F.row_number().over(own)).where(F.col(place) <= F.col(some))
    turn = F.explode(F.sequence(F.lit(1), F.when(F.col(place) <= F.col(twice), 2).otherwise(1))).alias(spare_name(docs, "turn"))
    columns = [named(c) for c in docs.columns]
    return taken.select(*columns, turn).select(*columns)
