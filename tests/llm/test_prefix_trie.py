import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from silvertide.llm import prefix_trie


def brute(rows):
    """rows: (conv_id, turn, role, text) with distinct turns in a conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    rebuilt = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - c % 20, [])[:h] + mine[h:]
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        inside = [p for p in nodes if p[: len(path)] == path]
        childless = [p for p in inside if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in inside)]
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in inside if p)
        ends = ",".join(str(c) for c in sorted(members) if rebuilt[c] == list(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), sum(len(p) == len(path) + 1 for p in inside), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie.prefix_trie(df.withColumn("key", F.lit("x")).withColumn("depth", F.lit(9))).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def conversations(seed, n=150, texts=3, most=7):
    rng = random.Random(seed)
    say = ["Hello there", "yes", "", "no  way\n", "é à", None, "x " * 50][:texts]
    return [
        (c, t if t or rng.random() < 0.8 else None, rng.choice(["user", "assistant", None]), rng.choice(say))
        for c in rng.sample(range(400), n) for t in range(rng.randrange(1, most))
    ]


@pytest.mark.parametrize(("seed", "texts", "most"), [(1, 2, 5), (2, 7, 9), (3, 1, 30)])
def test_nodes_equal_brute_force(spark, seed, texts, most):
    check(spark, conversations(seed, texts=texts, most=most))


@pytest.mark.parametrize("block", [1, 60, 400])
def test_every_cut_into_blocks_gives_the_same_nodes(spark, monkeypatch, block):
    rows = conversations(4, 60)
    batches = []
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ordered = prefix_trie.rebuilt(df).orderBy("seq", "conv_id").collect()
    whole = prefix_trie.block_nodes([bytes(r.seq) for r in ordered], __import__("numpy").array([r.conv_id for r in ordered]))
    assert sum(whole.column("depth").to_numpy() == 1) == len({bytes(r.seq)[:20] for r in ordered if r.seq})
    monkeypatch.setattr(prefix_trie, "BLOCK_BYTES", block)
    import pyarrow as pa

    source = pa.RecordBatch.from_arrays([pa.array([bytes(r.seq) for r in ordered], pa.binary()), pa.array([r.conv_id for r in ordered])], ["seq", "conv_id"])
    for part in prefix_trie._shard(iter([source])):
        batches.append(part)
    # Closed nodes are whole wherever the cut lies: each is in exactly one block.
    closed = [r for b in batches for r in b.to_pylist() if r["key"] is None]
    wanted = {key(r) for r in brute(rows)}
    for r in closed:
        if r["parent_key"] is None:
            assert key([r[c] for c in prefix_trie.RESULT]) in wanted


def test_shared_beginnings_copies_and_depth(spark):
    hot = [(c, t, "user", "same start") for c in range(300) for t in range(2)]
    tails = [(c, 2, "assistant", f"answer {c % 7}") for c in range(0, 300, 2)]
    deep = [(1000 + c, t, "user", "again and again") for c in range(3) for t in range(200)]
    check(spark, hot + tails + deep)


def test_long_text_single_and_empty(spark):
    check(spark, [(0, 0, "user", "word " * 100_000)])
    check(spark, [(40, 0, None, None), (41, 0, "user", "a"), (-5, 1, "user", "a"), (None, 0, "user", "a")][:2] + [(None, 0, "user", "a")])
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(none).count() == 0


def test_list_of_ends_may_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 3)
    check(spark, [(c, 0, "user", "all equal") for c in range(50)])
