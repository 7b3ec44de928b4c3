"""Quality rules by weak supervision: rules vote or abstain, and their accuracies come from agreement alone.

Columns and aggregates only. Each rule says good, bad or nothing about a document. Expectation-maximisation over the
counts of vote patterns (at most three to the number of rules, however many documents) estimates how often each rule
says what of good and of bad documents; the posterior of a document's pattern replaces the demand that all rules pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvertide.llm.shared import materialize

SPACE = "[\\x20\\x09-\\x0D]+"
#: Most rounds of estimation, and the change of the share of good documents that ends it.
ROUNDS, SETTLED = 20, 1e-7
#: Where estimation starts: the share of good documents, and how probable each vote is of good and of bad ones.
PRIOR = 0.8
START = {-1: (0.05, 0.3), 0: (0.5, 0.5), 1: (0.45, 0.2)}
#: Pseudo-counts that keep a rule's table away from zero.
SMOOTH = 1.0
KEEP = 0.5


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """Names a value, so that it is computed once however often the expression uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _zero() -> Column:
    return F.lit(0).cast("long")


def _repeated(words: Column) -> Column:
    """Words in windows of three that occur at least twice in the text; every occurrence counts."""

    def covered(places: Column) -> Column:
        """Words in windows that begin at these places, which are in order."""
        steps = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
        return F.aggregate(steps, _zero(), lambda n, x: n + x)

    def in_order(windows: Column) -> Column:
        """Windows with the place where they begin, equal ones beside each other."""
        return F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))

    def equal_beside(rows: Column) -> Column:
        same = F.filter(rows, lambda x, k: (F.get(rows, k + 1)["h"] == x["h"]) | ((k > 0) & (F.get(rows, k - 1)["h"] == x["h"])))
        return F.sort_array(F.transform(same, lambda x: x["k"]))

    def count(windows: Column) -> Column:
        some = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(some, let(in_order(windows), lambda rows: let(equal_beside(rows), covered))).otherwise(_zero())

    window = lambda k: F.xxhash64(F.get(words, k), F.get(words, k + 1), F.get(words, k + 2))
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)
    return F.when(F.size(words) >= 3, let(windows, count)).otherwise(_zero())


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper) of every whole text.

    Null and empty texts have zeros. Lines count only if they hold a word.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    removed = lambda pattern: (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def measured(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated(words).alias("n_repeat_words"),
        )

    line_counts = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    return docs.select(
        "doc_id",
        let(F.array_remove(F.split(text, SPACE, -1), ""), measured).alias("w"),
        line_counts.alias("l"),
        removed("[#*$%&|<>]").alias("n_symbols"),
        removed("[A-Z]").alias("n_upper"),
    ).select("doc_id", "w.n_words", "w.word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), "w.n_repeat_words", F.col("l.n").alias("n_lines"), "n_upper")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def votes() -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains. Most rules know one kind of fault and say nothing otherwise."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    symbols, repeats, capitals, length = share("n_symbols", "n_words"), share("n_repeat_words", "n_words"), share("n_upper", "word_chars"), share("word_chars", "n_words")
    bad = lambda fault: F.when(fault, -1).otherwise(0).cast("int")
    prose = (symbols < 0.05) & (repeats < 0.45) & (capitals < 0.2) & length.between(2.5, 12)
    return {
        "symbols": bad(symbols > 0.1),
        "repeats": bad(repeats > 0.45),
        "lines": bad(share("n_dup_lines", "n_lines") > 0.3),
        "capitals": bad(capitals > 0.3),
        "word_length": bad((length < 2.5) | (length > 12)),
        "size": F.when(F.col("n_words") < 20, -1).when(F.col("n_words") >= 100, 1).otherwise(0).cast("int"),
        "prose": F.when(prose, 1).otherwise(0).cast("int"),
    }


Table = dict[str, dict[int, tuple[float, float]]]


def estimated(patterns: DataFrame, rules: list[str], rounds: int = ROUNDS) -> tuple[float, Table]:
    """Share of good documents, and for each rule and vote how probable it is of good and of bad ones.

    patterns: one row per vote pattern with its count n. Each round is one aggregate with three rows per rule at most.
    """
    prior, table = PRIOR, {r: START for r in rules}
    given = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(r).alias("vote")) for k, r in enumerate(rules)])).alias("given")
    for _ in range(rounds):
        weighed = patterns.withColumn("good", F.col("n") * posterior(prior, table)).select("n", "good", given)
        sums = weighed.groupBy("given").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect()
        now = {(rules[r.given.rule], r.given.vote): (r.n, r.good) for r in sums}  # three rows per rule at most
        total = sum(n for (rule, _), (n, _) in now.items() if rule == rules[0])
        if not total:
            break
        good = sum(g for (rule, _), (_, g) in now.items() if rule == rules[0])
        before, prior = prior, (good + SMOOTH) / (total + 2 * SMOOTH)

        def rate(rule: str, vote: int, now=now, good=good, bad=total - good) -> tuple[float, float]:
            n, own = now.get((rule, vote), (0, 0.0))
            return (own + SMOOTH) / (good + len(START) * SMOOTH), (n - own + SMOOTH) / (bad + len(START) * SMOOTH)

        table = {r: {v: rate(r, v) for v in START} for r in rules}
        if abs(prior - before) < SETTLED:
            break
    return prior, table


def posterior(prior: float, table: Table) -> Column:
    """Probability that a document with these votes is good; an abstention tells what it tells of both classes.

    The log-odds of all votes are one array, which keeps the compiled code the same from round to round.
    """
    said = [math.log(rows[v][0] / rows[v][1]) for rows in table.values() for v in sorted(rows)]
    values = F.array(*[F.lit(x) for x in (math.log(prior / (1 - prior)), *said)])
    odds = F.get(values, F.lit(0))
    for k, rule in enumerate(table):
        odds = odds + F.get(values, F.col(rule) + (3 * k + 2))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def judge(docs: DataFrame) -> DataFrame:
    """features() with the votes, quality (posterior probability of good), base_failed and kept.

    kept is false where a base rule fails, else whether quality is at least KEEP. Counts of vote patterns cover all
    rows; repeated rows count each time. An empty table gives no rows.
    """
    rules = votes()
    rows = materialize(features(docs).withColumns(rules), "quality-votes")
    patterns = materialize(rows.groupBy(*rules).agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    prior, table = estimated(patterns, list(rules))
    return rows.withColumns({"quality": posterior(prior, table), "base_failed": base_failed()}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP)
    )
