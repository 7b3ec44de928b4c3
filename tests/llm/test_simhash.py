import random
import re

import numpy as np
import pytest
import xxhash

from silvertide.llm import simhash
from silvertide.llm.components import component_roots


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(prints):
    """Smallest index reachable by links of at most four bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def near_texts(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 400]))] for _ in range(8)]
    out = []
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return out


def test_rows_equal_brute_force(spark, documents):
    texts = near_texts(1) + [None, "", "  \t\n", "one", "One TWO three", "É É é x", "a\x0bb c\x0dd", "long " * 30000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    prints = [brute_print(t) for _, t in rows]
    wanted = {(rows[i][0], prints[i], rows[r][0]) for i, r in enumerate(brute_components(prints))}
    found = simhash.near_duplicates(documents(rows)).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in found} == wanted


@pytest.mark.parametrize("chunk", [4, 512])
def test_links_join_all_near_fingerprints(spark, chunk):
    """Crowded balls around a few centres: every pair within four bits is joined, in chunks of any size."""
    rng = random.Random(7)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(60):
            flipped = centre
            for b in rng.sample(range(64), rng.randrange(6)):
                flipped ^= 1 << b
            prints.add(flipped)
    prints = sorted(prints)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), chunk).collect()
    root = {r.node: r.root for r in component_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = brute_components(prints)
    groups = {}
    for p, w in zip(signed, wanted, strict=True):
        groups.setdefault(w, set()).add(root.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_every_pair_within_four_bits_shares_a_key(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(1, 5)):
            b ^= 1 << bit
        rows.append((i, *(int(np.uint64(x).view(np.int64)) for x in (a, b))))
    df = spark.createDataFrame(rows, "i long, a long, b long")
    from pyspark.sql import functions as F

    assert df.where(~F.arrays_overlap(simhash._keys(F.col("a")), simhash._keys(F.col("b")))).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)] + [(3, 4)]
    roots = {r.node: r.root for r in component_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}
    assert component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_representatives_with_null_and_repeated_ids(spark, documents):
    same = " ".join("w%d" % i for i in range(60))
    other = " ".join("v%d" % i for i in range(60))
    third = " ".join("u%d" % i for i in range(60))
    rows = [(5, same), (9, same), (5, other), (None, other), (None, third), (None, third), (5, same)]
    kept = simhash.representatives(documents(rows)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text[:2]) for r in kept) == [(-1, "u0"), (5, "v0"), (5, "w0")]
    assert simhash.representatives(documents([])).count() == 0
    named = documents(rows).withColumnRenamed("lang", "fp")
    assert simhash.representatives(named).columns == named.columns


def test_stars_need_one_round(spark, monkeypatch):
    from silvertide.llm import components

    written = []
    store = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: written.append(name) or store(df, name))
    links = [(1, 5), (1, 6), (6, 1), (1, 6), (2, 9), (3, 3)]
    roots = sorted(map(tuple, component_roots(spark.createDataFrame(links, "a long, b long")).collect()))
    assert roots == [(5, 1), (6, 1), (9, 2)] and len(written) == 1
    path = [(i, i + 1) for i in range(20)]
    assert {tuple(r) for r in component_roots(spark.createDataFrame(path, "a long, b long")).collect()} == {(i, 0) for i in range(1, 21)}
