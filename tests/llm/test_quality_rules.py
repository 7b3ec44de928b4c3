import re
from collections import Counter

import pytest

from silvertide.llm import quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


PROSE = " ".join(f"word{i} and" for i in range(80)) + ".\nAnother line of it."
TEXTS = [
    None, "", " \n\t", "a", "a b c a b c", "x\nx\n x\nx \n\n\nx", "a b c d " * 400, "#*$ %&|<> é\U0001f600 ü", PROSE, PROSE + "\n" + PROSE,
    " ".join(f"w{i}$$$" for i in range(90)), " ".join(f"LOUD{i}!!" for i in range(90)), "\x0b\x0c a\rb", "a  b\x1fc", "one two\n" * 3,
    " ".join(str(i % 5000) for i in range(20_000)),
]


def test_base_equals_brute_force(spark, documents):
    got = quality_rules.judge(documents(list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "b")])).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        want = brute(TEXTS[r.doc_id] if r.doc_id is not None else "b")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.doc_id
        assert not (r.base_failed and r.kept)


def reference(patterns, rounds):
    """Estimation in plain Python over {votes: count}."""
    import math

    rules = len(next(iter(patterns)))
    prior, table = quality_rules.PRIOR, [quality_rules.START] * rules
    quality = {}
    for turn in range(rounds + 1):
        for p in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[j][v][0] / table[j][v][1]) for j, v in enumerate(p))
            quality[p] = 1 / (1 + math.exp(-odds))
        if turn == rounds:
            return quality
        n, good = sum(patterns.values()), sum(c * quality[p] for p, c in patterns.items())
        own = lambda j, v, w: sum(c * w(quality[p]) for p, c in patterns.items() if p[j] == v)
        table = [
            {v: ((own(j, v, lambda q: q) + 1) / (good + 3), (own(j, v, lambda q: 1 - q) + 1) / (n - good + 3)) for v in (-1, 0, 1)}
            for j in range(rules)
        ]
        before, prior = prior, (good + 1) / (n + 2)
        if abs(prior - before) < quality_rules.SETTLED:
            rounds = turn + 1
    return quality


def test_posterior_equals_plain_estimation(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = list(quality_rules.votes())
    got = quality_rules.judge(docs).collect()
    want = reference(Counter(tuple(r[k] for k in rules) for r in got), quality_rules.ROUNDS)
    for r in got:
        assert r.quality == pytest.approx(want[tuple(r[k] for k in rules)], abs=1e-9)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)


def test_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    kept = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "base_failed", "kept")
    rows = kept.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.98 * len(rows)


def test_plan_has_no_python(spark, documents, sf_dir):
    plan = quality_rules.features(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert quality_rules.judge(documents([])).count() == 0
