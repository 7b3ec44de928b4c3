import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from silvertide.llm import importance
from silvertide.llm.text_buffers import buffers


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def buckets(text, run=1, most=10_000):
    own = words(text)
    return [zlib.crc32(" ".join(own[i : i + n]).encode()) % most for n in range(1, run + 1) for i in range(len(own) - n + 1)]


def brute(docs, target, run=1, most=10_000, least=20, percent=10, seed=2024):
    s, t = Counter(b for _, x in docs for b in buckets(x, run, most)), Counter(b for x in target for b in buckets(x, run, most))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + most) / ((s[b] + 1) * (all_t + most))))
    rows = []
    for doc, text in docs:
        own = buckets(text, run, most)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    drawn = order[: len(order) * percent // 100]
    ranked = [(*r[:4], i + 1) for i, r in enumerate(drawn)]
    rest = Counter(rows) - Counter(drawn)
    return ranked + [(*r[:4], None) for r in rest.elements()]


def key(row):
    return tuple((x is not None, x) for x in row)


def fixture():
    say = ["The cat-sat on 1 mat.", "Über élan  tok3n", "", "a\x7fb{c}", "word", "x" * 70 + " y" * 3, "日本 語", "\x01 \x02z"]
    docs = [(i, " ".join(say[(i * j + i) % len(say)] for j in range(i % 17 + 1))) for i in range(160)]
    odd = [(None, docs[40][1]), (None, docs[40][1]), (41, docs[41][1]), (300, None), (301, ""), (302, "lone " * 60_000), (303, "y" * 400_000), (304, ("z" * 80 + " ") * 30)]
    return docs + odd, ["The cat sat", None, "", "élan " * 4, "z" * 80]


@pytest.mark.parametrize("options", [{}, {"max_run": 3, "buckets": 97, "percent": 35, "least_words": 5}])
def test_report_equals_brute_force(spark, documents, options):
    docs, target = fixture()
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    named = documents(docs).withColumn("weight", F.lit("x")).withColumn("place", F.lit("y"))
    got = importance.importance_report(named, benchmark, **options).drop("mark").collect()
    names = {"max_run": "run", "buckets": "most", "least_words": "least", "percent": "percent"}
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs, target, **{names[k]: v for k, v in options.items()}), key=key)


def test_composed_checksums():
    left, right = [b"", b"abc", "é".encode() * 9, b"x" * 5000], [b"tail", b"", b"y" * 70_000, b"z"]
    got = importance.composed(*(np.array([zlib.crc32(x) for x in side], np.uint32) for side in (left, right)), np.array([len(x) for x in right]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right, strict=True)]


def test_scan_emits_every_word_in_order():
    texts = ["a b a", None, "", "ab a b", "w" * 65 + " a " + "w" * 65, "\x02 \x01 1", "é" * 64 + " É"]
    crc, spaced, size, row = importance.payloads(*buffers(pa.array(texts, pa.string())))
    assert crc.tolist() == [zlib.crc32(w.encode()) for t in texts for w in words(t)]
    assert row.tolist() == [i for i, t in enumerate(texts) for _ in words(t)]
    assert size.tolist() == [len(w.encode()) + 1 for t in texts for w in words(t)]


def test_empty_tables_and_drawn_documents(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.importance_report(documents([]), none).count() == 0
    docs = documents([(i, f"word{i} " * 25) for i in range(40)]).withColumn("text_mark", F.lit("own"))
    drawn = importance.drawn_documents(docs, none)
    report = importance.importance_report(docs, none).where("rank IS NOT NULL")
    assert drawn.columns == docs.columns and report.count() == 4
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in report.collect()}
