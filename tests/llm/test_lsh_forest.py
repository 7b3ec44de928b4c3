import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from silvertide.llm import lsh_forest


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)} or ({" ".join(words)} if words else set())


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets, root = [brute_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    order = lambda v: (v is None, v)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc, key=order)
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)]


def near_texts(seed, n, edits=(0, 0, 1, 2, 4)):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["Été", "ß"]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 5, 60, 200]))] for _ in range(9)]
    out = []
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice(edits)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return out


ODD = [None, "", " \t\n", "one", "ONE", "one two", "one TWO ", "a\x0bb c\x0dd", "long " * 20_000, "x" * 200_000]


def fixture(seed, n=220):
    rows = list(enumerate(near_texts(seed, n) + ODD))
    return rows + [(5, rows[5][1]), (None, rows[6][1]), (None, "only without an id"), (None, None), (7, "another text of seven")]


def result(df):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=key)


def wanted(rows):
    return sorted(brute(rows), key=lambda r: tuple((x is None, x) for x in r))


def test_report_equals_brute_force(spark, documents):
    rows = fixture(1)
    report = lsh_forest.near_duplicate_report(documents(rows).withColumn("signature", F.lit("x")).withColumn("node", F.lit(1)))
    assert report.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(report) == wanted(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in report.collect())


@pytest.mark.parametrize(("docs", "shingles"), [(3, 1 << 20), (1000, 150), (2, 1)])
def test_large_groups_are_split_without_loss(spark, documents, docs, shingles):
    rows = fixture(2, 120)
    assert result(lsh_forest.near_duplicates(documents(rows), docs, shingles)) == wanted(rows)


def test_hot_group_of_near_copies(spark, documents):
    rows = list(enumerate(near_texts(3, 10, (0,)) * 1 + near_texts(3, 260, (1, 2, 3))))
    assert result(lsh_forest.near_duplicates(documents(rows), 16, 1 << 20)) == wanted(rows)


def test_empty_table(spark, documents):
    assert lsh_forest.near_duplicate_report(documents([])).count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(5)
    for share in (0.5, 0.85, 0.95):
        common, own = rng.integers(0, 1 << 63, int(4000 * share), np.uint64), rng.integers(0, 1 << 63, (2, 4000 - int(4000 * share)), np.uint64)
        a, b = (np.unique(np.concatenate([common, x])) for x in own)
        signature = lsh_forest.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
        true = len(common) / (len(a) + len(b) - len(common))
        assert abs((signature[0] == signature[1]).mean() - true) < 5 * (0.25 / lsh_forest.VALUES) ** 0.5


def test_chance_to_miss_a_pair_is_below_a_millionth():
    reach = lambda depth, orders: (1 - (lsh_forest.THRESHOLD / 100) ** depth) ** orders
    assert reach(lsh_forest.SHALLOW, lsh_forest.WIDE) < 1e-6 and reach(lsh_forest.DEEP, lsh_forest.ORDERS) < 1e-6


def test_searched_groups_are_stars():
    """Links in a row, as of a path of near copies, come out as a star: components then need one round."""
    near = lambda i, others: abs(others - i) <= 2
    assert sorted(zip(*lsh_forest._searched(40, near), strict=True)) == [(0, j) for j in range(1, 40)]
    apart = lambda i, others: others // 10 == i // 10
    assert sorted(zip(*lsh_forest._searched(30, apart), strict=True)) == [(j // 10 * 10, j) for j in range(30) if j % 10]
