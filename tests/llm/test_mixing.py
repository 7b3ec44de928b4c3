import random
from collections import Counter, defaultdict

import pytest

from silvertide.llm import mixing


def brute_targets(sizes):
    """sizes by source (None last): shares of what is left, again and again, until no source is above twice its size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in free}
        for s in above:
            out[s] = 2.0 * sizes[s]
            free.discard(s)
        left -= sum(out[s] for s in above)
    return out


def rows_of(seed, n=900):
    rng = random.Random(seed)
    sources = ["a", "B", "é", "", "zz", None, "hot", "\U0001f600", "￰"]
    return [(i, " ".join(["w"] * rng.choice([0, 1, 2, 3, 5, 8, 60, 61, 300])), "hot" if rng.random() < 0.33 else rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_fits_targets(spark, documents, seed):
    rows = rows_of(seed) + [(10_000, None, "a"), (None, "x y", "a"), (None, "x y", "a"), (10_001, "q " * 50_000, "zz")]
    sizes, by_source = defaultdict(int), defaultdict(list)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    wanted = brute_targets(sizes)
    source_of = {d: s for d, _, s in rows if d is not None}
    got = mixing.mix_documents(documents(rows)).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len((t or "").split())) for d, t, _ in rows)
    for r in got:
        source = source_of.get(r.doc_id, "a")
        assert r.source_size == sizes[source] and r.target == pytest.approx(wanted[source])
        assert r.taken in (0, r.size, 2 * r.size)
        by_source[source].append(r)
    for source, own in by_source.items():
        taken, largest = sum(r.taken for r in own), max(r.size for r in own)
        assert taken <= round(wanted[source]) and taken >= wanted[source] - max(1, 0 if largest < 1000 else largest)


def test_reruns_agree(spark, documents):
    rows = rows_of(3)
    key = lambda df: sorted((r.doc_id, r.taken) for r in df.collect())
    assert key(mixing.mix_documents(documents(rows))) == key(mixing.mix_documents(documents(rows[::-1]).repartition(7)))


def test_fit_lengths_against_all_subsets():
    rng = random.Random(5)
    for _ in range(300):
        lengths = rng.sample(range(1, 30), rng.randrange(1, 5))
        counts = [rng.randrange(1, 5) for _ in lengths]
        total = sum(a * b for a, b in zip(lengths, counts, strict=True))
        budget = rng.randrange(0, total)
        taken = mixing.fit_lengths(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts, strict=True))
        got, shares = sum(a * b for a, b in zip(lengths, taken, strict=True)), [c * budget // total for c in counts]
        reach = {0}
        for n, c, s in zip(lengths, counts, shares, strict=True):
            reach = {r + n * k for r in reach for k in range(s, c + 1)}
        assert got == max(r for r in reach if r <= budget)


def test_large_budgets_leave_little():
    lengths, counts = list(range(1, 3000, 7)), [5] * 429
    budget = sum(a * b for a, b in zip(lengths, counts, strict=True)) * 2 // 3
    taken = mixing.fit_lengths(lengths, counts, budget, knapsack=5000)
    assert sum(a * b for a, b in zip(lengths, taken, strict=True)) == budget


def test_empty_and_wordless_tables(spark, documents):
    assert mixing.mix_documents(documents([])).count() == 0
    rows = mixing.mix_documents(documents([(1, None), (2, "", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_taken_documents_repeat_rows(spark, documents):
    rows = rows_of(4, 300) + [(7, "p q r", "a"), (7, "p q r", "a"), (None, "p q r", "a"), (None, "p q", "a")]
    docs = documents(rows)
    want = Counter()
    for r in mixing.mix_documents(docs).collect():
        if r.taken:
            want[(r.doc_id, r.size)] += r.taken // r.size
    got = mixing.taken_documents(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, len((r.text or "").split())) for r in got.collect()) == want


def test_one_row_as_a_third_of_the_table(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 16)
    rows = rows_of(6, 600) + [(None, "the same row", "hot")] * 300
    counted = mixing.counted(mixing.sized(documents(rows))).where("doc_id is null").collect()
    assert sum(r.n for r in counted) == 300 and max(r.n for r in counted) == 16
    assert len({r.part for r in counted}) > 10
    got = mixing.mix_documents(documents(rows)).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len((t or "").split())) for d, t, _ in rows)
    source_of = {d: s for d, _, s in rows}
    for source in set(source_of.values()):
        own = [r for r in got if source_of[r.doc_id] == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
    again = mixing.mix_documents(documents(rows[::-1]).repartition(5)).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)
