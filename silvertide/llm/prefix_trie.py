"""Prefix trie of conversations from sorted range shards.

A conversation is one row of 20-byte marks, one for each turn: 16 bytes that tell role and text, 4 that count the words.
Rows are sorted by range into shards. Within a block of a shard the marks become a padded matrix of turn numbers, a panel
of columns at a time: a lexsort orders the rows, change masks accumulated from column to column show where a node begins,
and reduceat gives every depth its sums. Only the nodes on the paths of a block's first and last row can go on in other
blocks. These are recombined by their prefix; they are two paths a block, however many conversations there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvertide.llm.shared import materialize

MARK_BYTES = 20
#: A conversation starts with up to HEADS - 1 turns of the first one of its group of GROUP ids.
GROUP = 20
HEADS = 4
#: Columns of the padded matrix at a time; rows that end before a panel are not in it.
PANEL = 16
#: Bytes of marks in a block, and in a shard on average.
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 32 << 20
#: Ids that one piece of a list of ending conversations holds.
PIECE_IDS = 4096
ROOT_KEY = hashlib.md5(b"").digest()
NO_ENDS = hashlib.sha256(b"").hexdigest()

_COLUMNS = {
    "conv_id": "long", "depth": "long", "parent_conv_id": "long", "n_convs": "long", "n_children": "long", "n_leaves": "long",
    "saved_tokens": "long", "ends_sha256": "string", "words": "long", "key": "binary", "parent_key": "binary", "top": "binary",
}
_NODES = ", ".join(f"{c} {t}" for c, t in _COLUMNS.items()) + ", pieces array<struct<first_id: bigint, ids: string>>"
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, marks) of every conversation in the order of its turns, marks in hexadecimal digits."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    known = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.lpad(F.hex(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")), 8, "0")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").isNotNull(), "turn", F.concat(known, words).alias("mark")).alias("t")
    )
    listed = F.transform(F.sort_array(F.collect_list("t")), lambda t: t["mark"])
    return turns.groupBy("conv_id").agg(F.array_join(listed, "").alias("marks"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq) with the borrowed first turns in front of each conversation's own later ones."""
    own = materialize(sequences(conversations), "trie-sequences")
    digits = 2 * MARK_BYTES
    heads = own.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.substring("marks", 1, digits * (HEADS - 1)).alias("head"))
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int") * digits
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("base"), "left")
    marks = F.concat(F.substr(F.coalesce("head", F.lit("")), F.lit(1), n), F.substr("marks", n + 1, F.length("marks")))
    return joined.select("conv_id", F.unhex(marks).alias("seq"))


def _levels(seqs: list[bytes], ids: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The nodes of every depth, root first, in the order of their sequences; rows come sorted by sequence and id."""
    lens = np.array([len(s) for s in seqs]) // MARK_BYTES
    marks, local = np.unique(np.frombuffer(b"".join(seqs), f"S{MARK_BYTES}"), return_inverse=True)
    words = np.frombuffer(marks.tobytes(), ">u4").reshape(-1, MARK_BYTES // 4)[:, -1].astype(np.int64)
    first = np.cumsum(lens) - lens
    node, rows = np.zeros(len(seqs), np.int64), np.arange(len(seqs))
    levels = [{"parent": np.array([-1]), "n_convs": np.array([len(seqs)]), "conv_id": ids.min(keepdims=True), "words": np.zeros(1, np.int64), "ends": rows[lens == 0], "end_node": node[lens == 0]}]
    for top in range(0, int(lens.max()), PANEL):
        rows = rows[lens[rows] > top]
        columns = top + np.arange(min(PANEL, int(lens[rows].max()) - top))
        inside = columns < lens[rows][:, None]
        matrix = np.full(inside.shape, -1, np.int64)
        matrix[inside] = local[(first[rows][:, None] + columns)[inside]]
        order = np.lexsort((*matrix.T[::-1], node[rows]))
        rows, matrix, inside = rows[order], matrix[order], inside[order]
        change = np.ones(matrix.shape, bool)
        change[1:] = (matrix[1:] != matrix[:-1]) | (node[rows[1:]] != node[rows[:-1]])[:, None]
        np.logical_or.accumulate(change, axis=1, out=change)
        for c in range(len(columns)):
            at = np.flatnonzero(inside[:, c])
            member, starts = rows[at], np.flatnonzero(change[at, c])
            parent = node[member[starts]]
            node[member] = np.cumsum(change[at, c]) - 1
            ending = member[lens[member] == top + c + 1]
            levels.append({
                "parent": parent, "n_convs": np.diff(np.append(starts, len(at))), "conv_id": np.minimum.reduceat(ids[member], starts),
                "words": words[matrix[at[starts], c]], "ends": ending, "end_node": node[ending],
            })
    return levels


def _prefix_keys(seq: bytes) -> list[bytes]:
    """A key for each prefix of whole marks, the empty one first."""
    state, keys = hashlib.md5(), [ROOT_KEY]
    for at in range(0, len(seq), MARK_BYTES):
        state.update(seq[at : at + MARK_BYTES])
        keys.append(state.copy().digest())
    return keys


def block_nodes(seqs: list[bytes], ids: np.ndarray) -> pa.RecordBatch:
    """Nodes of sorted rows. A node with a key is open: its sums leave out other open nodes, its own tokens and leaf."""
    levels = _levels(seqs, ids)
    ways = {0: _prefix_keys(seqs[0]), -1: _prefix_keys(seqs[-1])}
    for depth, x in enumerate(levels):
        x["keys"] = {(len(x["parent"]) - 1 if end else 0): keys[depth] for end, keys in ways.items() if depth < len(keys)}
        x["tops"] = {(len(x["parent"]) - 1 if end else 0): keys[1] for end, keys in ways.items() if 0 < depth < len(keys)}
        x["open"] = np.zeros(len(x["parent"]), bool)
        x["open"][list(x["keys"])] = True
        for name in ("n_children", "n_leaves", "saved_tokens"):
            x[name] = np.zeros(len(x["parent"]), np.int64)
    out: dict[str, list] = {c: [] for c in (*_COLUMNS, "pieces")}
    for depth in range(len(levels) - 1, -1, -1):
        x, above = levels[depth], levels[depth - 1] if depth else None
        closed = ~x["open"]
        x["n_leaves"] += closed & (x["n_children"] == 0)
        x["saved_tokens"] += np.where(closed, (x["n_convs"] - 1) * x["words"], 0)
        if above:
            for name, value in (("n_children", 1), ("n_leaves", x["n_leaves"][closed]), ("saved_tokens", x["saved_tokens"][closed])):
                np.add.at(above[name], x["parent"][closed], value)
    for depth, x in enumerate(levels):
        above, n = levels[depth - 1] if depth else None, len(x["parent"])
        digests, pieces = [NO_ENDS] * n, [None] * n
        edges = np.flatnonzero(np.diff(x["end_node"], prepend=-1, append=-1)) if len(x["ends"]) else [0]
        for a, b in zip(edges, edges[1:], strict=False):
            at, own = int(x["end_node"][a]), ids[x["ends"][a:b]].tolist()
            if at in x["keys"]:
                digests[at] = None
                pieces[at] = [{"first_id": own[i], "ids": ",".join(map(str, own[i : i + PIECE_IDS]))} for i in range(0, len(own), PIECE_IDS)]
            else:
                digests[at] = hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        parents = x["parent"].tolist()
        known = [None] * n if not above else [None if p in above["keys"] else c for p, c in zip(parents, above["conv_id"][x["parent"]].tolist(), strict=True)]
        for name in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words"):
            out[name] += x[name].tolist()
        out["depth"] += [depth] * n
        out["parent_conv_id"] += known
        out["ends_sha256"] += digests
        out["pieces"] += pieces
        out["key"] += [x["keys"].get(i) for i in range(n)]
        out["top"] += [x["tops"].get(i) for i in range(n)]
        out["parent_key"] += [above["keys"].get(p) if above else None for p in parents]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = {c: kinds[t] for c, t in _COLUMNS.items()} | {"pieces": pa.list_(pa.struct([("first_id", pa.int64()), ("ids", pa.string())]))}
    return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in types.items()], list(types))


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.array([len(x) for x in batch.column("seq").to_pylist()]) if batch.num_rows else np.zeros(0, np.int64)
        ends, first = np.cumsum(sizes), 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BLOCK_BYTES, "right")))
            block = batch.slice(first, last - first)
            yield block_nodes(block.column("seq").to_pylist(), block.column("conv_id").to_numpy())
            first = last


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key from its pieces, which follow one another; only the running state is kept."""
    key, state = None, None
    for batch in batches:
        done = []
        for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if own != key:
                done += [(key, state.hexdigest())] if state else []
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["key", "digest"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "digest"])


def _recombined(group: pd.DataFrame) -> pd.DataFrame:
    """The open nodes below one first turn, each merged from its blocks: sums from the deepest up, parents by key."""
    group = group.sort_values("depth", kind="stable").reset_index(drop=True)
    place = {k: i for i, k in enumerate(group["key"])}
    parent = np.array([place.get(k, -1) for k in group["parent_key"]])
    depth, (children, leaves, saved) = group["depth"].to_numpy(), (group[c].to_numpy().copy() for c in ("n_children", "n_leaves", "saved_tokens"))
    saved += (group["n_convs"].to_numpy() - 1) * group["words"].to_numpy()
    edges = np.append(np.unique(depth, return_index=True)[1], len(depth))
    for a, b in zip(edges[-2::-1], edges[:0:-1], strict=True):
        leaves[a:b] += children[a:b] == 0
        if a:
            for sums, value in ((children, 1), (leaves, leaves[a:b]), (saved, saved[a:b])):
                np.add.at(sums, parent[a:b], value)
    ids = group["conv_id"].to_numpy()
    above = pd.Series(np.where(parent >= 0, ids[np.maximum(parent, 0)], 0), dtype="Int64").mask(pd.Series(parent < 0))
    return group.assign(n_children=children, n_leaves=leaves, saved_tokens=saved, parent_conv_id=above)[["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "key"]]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn, null first, and equal ones by a hash of role and text; null role and text are empty. Rows
    without conv_id belong to no conversation. Repeated rows are turns of their own. An empty table gives no node, not
    even a root. Other columns are ignored. A conversation is one row of 20 bytes a turn; texts leave the first stage as
    marks only. Equal conversations, and those with a common beginning, are spread over shards like any others.
    """
    spark = conversations.sparkSession
    rows = materialize(rebuilt(conversations), "trie-rows")
    size = rows.agg(F.sum(F.length("seq"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    sharded = rows.select("seq", "conv_id").repartitionByRange(shards, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    nodes = materialize(sharded.mapInArrow(_shard, _NODES), "trie-nodes")
    parts = nodes.where("key IS NOT NULL")
    total = lambda c: F.sum(c).alias(c)
    merged = materialize(parts.groupBy("key", "parent_key", "top", "depth", "words").agg(
        F.min("conv_id").alias("conv_id"), *map(total, ("n_convs", "n_children", "n_leaves", "saved_tokens"))
    ), "trie-open")
    root = merged.where("depth = 0").first()
    if root is None:
        return nodes.select(*RESULT)
    pieces = parts.select("key", F.explode("pieces").alias("p")).select("key", "p.first_id", "p.ids")
    digests = pieces.repartition("key").sortWithinPartitions("key", "first_id").mapInArrow(_digests, "key binary, digest string")
    below = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, key binary"
    opened = materialize(merged.where("depth > 0").groupBy("top").applyInPandas(_recombined, below), "trie-recombined")
    tops = opened.where("depth = 1").agg(F.count(F.lit(1)), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    children = root.n_children + tops[0]
    own_root = [(root.conv_id, 0, None, root.n_convs, children, root.n_leaves + (tops[1] or 0) or 1, root.saved_tokens + (tops[2] or 0), bytearray(root.key))]
    opened = opened.withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root.conv_id)).otherwise(F.col("parent_conv_id")))
    opened = opened.unionByName(spark.createDataFrame(own_root, below)).join(digests, "key", "left")
    opened = opened.withColumn("ends_sha256", F.coalesce("digest", F.lit(NO_ENDS)))
    closed = nodes.where("key IS NULL")
    inner = closed.where("parent_key IS NULL")
    first = closed.where("depth = 1").withColumn("parent_conv_id", F.lit(root.conv_id))
    # Nodes whose parent is open: the open nodes are few, so this is a lookup unless they outgrow Spark's own bound.
    outer = closed.where("depth > 1 AND parent_key IS NOT NULL").drop("parent_conv_id").join(
        merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key"
    )
    return inner.select(*RESULT).unionByName(first.select(*RESULT)).unionByName(outer.select(*RESULT)).unionByName(opened.select(*RESULT))
