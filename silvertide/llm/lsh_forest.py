"""MinHash near-duplicates by an LSH forest, confirmed on full shingle sets.

A signature of 180 least hashes is sorted in 30 orders of six values each. Documents whose longest common prefix in an order
reaches the depth of their region are candidates. The depth adapts: regions of three values in the first 15 orders; the
documents of a region with more members than one task compares go six values deep in all 30 orders. Either way a pair at
the threshold of 0.85 has one region in common but for a chance below 1e-6 (0.386 ** 15 and 0.623 ** 30), and a pair above
it far more surely.

Candidates that agree on too few values of the whole signature are pruned, and what is left joined to clusters. The shingle
sets of a cluster meet in one task, where a breadth-first search confirms links; clusters beyond a task's size meet region
by region, and regions beyond it chunk by chunk, first with one common document, then every document that is not yet joined to
its region's largest component with all others. So no group is paired out, and no candidate is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvertide.llm.components import component_roots
from silvertide.llm.shared import materialize
from silvertide.llm.text_buffers import NON_SPACE, Words, mixed, pieces

SHINGLE = 3
#: Similarity in hundredths from which documents are linked.
THRESHOLD = 85
ORDERS, DEEP, WIDE, SHALLOW = 30, 6, 15, 3
VALUES = ORDERS * DEEP
#: Equal values of the signature that a candidate pair must have: six deviations below what the threshold gives.
LEAST_EQUAL = int(VALUES * THRESHOLD / 100 - 6 * (VALUES * THRESHOLD / 100 * (1 - THRESHOLD / 100)) ** 0.5)
#: Documents, and shingles of all of them, that are compared in one task.
GROUP_DOCS = 512
GROUP_SHINGLES = 4 << 20

_RULE = np.random.default_rng(11)
_FACTORS = _RULE.integers(0, 1 << 63, VALUES // 2, np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, ascending, one row after the other, and how many each row has."""
    words = Words(data, offsets, NON_SPACE)
    gram, whole = words.grams(SHINGLE)
    rows, hashes = [words.row[: len(gram)][whole]], [gram[whole]]
    for n in range(1, SHINGLE):  # fewer words: the whole sequence
        at = words.firsts[:-1][words.counts == n]
        if len(at):
            rows.append(words.row[at]), hashes.append(words.grams(n)[0][at])
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(row[new], minlength=len(words.counts))


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """VALUES least 32-bit hashes of each non-empty set, two from each product."""
    filled = counts[counts > 0]
    starts = np.cumsum(filled) - filled
    out = np.zeros((len(filled), VALUES), np.uint32)
    for i, factor in enumerate(_FACTORS if len(filled) else ()):
        y = values * factor
        y ^= y >> np.uint64(29)
        y *= _SECOND
        out[:, 2 * i] = np.minimum.reduceat(y >> np.uint64(32), starts)
        y ^= y >> np.uint64(31)
        out[:, 2 * i + 1] = np.minimum.reduceat(y.astype(np.uint32), starts)
    return out


def _keys(signature: np.ndarray, depth: int, orders: int) -> np.ndarray:
    """A key for the first depth values in each of the first orders."""
    ordered = signature.reshape(len(signature), ORDERS, DEEP)[:, :orders, :depth].astype(np.uint64)
    key = np.broadcast_to(np.arange(orders, dtype=np.uint64) + np.uint64(depth << 8), ordered.shape[:2]).copy()
    for i in range(depth):
        key = mixed(key * _SECOND + ordered[:, :, i])
    return key.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n_shingles, set_a, set_b, signature, shallow, deep) of every row, whole texts; without words all but the count are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text"):
            values, counts = shingle_sets(data, offsets)
            filled = np.flatnonzero(counts)
            place = np.full(len(counts), -1)
            place[filled] = np.arange(len(filled))
            at = pa.array(place, mask=place < 0)
            starts = np.cumsum(counts[filled]) - counts[filled]
            sums = [np.add.reduceat(mixed(values ^ np.uint64(i)), starts).view(np.int64) if len(filled) else np.zeros(0, np.int64) for i in (1, 2)]
            signature = signatures(values, counts)
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(_keys(signature, depth, orders).ravel()), orders).cast(pa.list_(pa.int64()))
                for depth, orders in ((SHALLOW, WIDE), (DEEP, ORDERS))
            ]
            low = pa.array([x.tobytes() for x in (signature & np.uint32(255)).astype(np.uint8)], pa.binary())
            columns = [pa.array(sums[0]), pa.array(sums[1]), low, *lists]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("mark"), pa.array(counts.astype(np.int64)), *(c.take(at) for c in columns)],
                ["doc_id", "mark", "n_shingles", "set_a", "set_b", "signature", "shallow", "deep"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, mark long, n_shingles long, set_a long, set_b long, signature binary, shallow array<long>, deep array<long>"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, schema)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups of sorted keys, with the place where each group begins and the end."""
    kept: list[pa.RecordBatch] = []

    def cut(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(parts).combine_chunks()
        key = table.column("key").to_numpy()
        return table, np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        edges = np.flatnonzero(np.diff(key)) + 1
        if kept and kept[-1].column("key")[-1].as_py() != key[0]:
            yield cut(kept)
            kept = []
        if len(edges):
            yield cut([*kept, batch.slice(0, int(edges[-1]))])
            kept = []
        kept.append(batch.slice(int(edges[-1]) if len(edges) else 0))
    if kept:
        yield cut(kept)


def _searched(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """Links from the first of each component to all others of it; near(i, others) tells which of others are linked with i."""
    left, right, open_ = [], [], np.arange(n)
    while len(open_) > 1:
        first, open_ = int(open_[0]), open_[1:]
        queue = [first]
        while queue and len(open_):
            i = queue.pop()
            found = near(i, open_)
            for j in open_[found].tolist():
                left.append(first), right.append(j), queue.append(j)
            open_ = open_[~found]
    return left, right


def _pairs(links: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([x[i] for x in links]) if links else np.zeros(0, np.int64) for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], ["a", "b"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that join all members of a group whose signatures agree on LEAST_EQUAL values, directly or by others."""
    for table, edges in _whole_groups(batches):
        node = table.column("node").to_numpy()
        values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, VALUES)
        size = np.diff(edges)
        two = edges[:-1][size == 2]
        two = two[(values[two] == values[two + 1]).sum(axis=1) >= LEAST_EQUAL]
        links = [(node[two], node[two + 1])]
        for first, n in zip(edges[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            own = values[first : first + n]
            i, j = _searched(n, lambda i, others, own=own: (own[others] == own[i]).sum(axis=1) >= LEAST_EQUAL)
            links.append((node[first + np.array(i, np.int64)], node[first + np.array(j, np.int64)]))
        yield _pairs(links)


def confirmed_links(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Links that join all sets whose intersection and union reach the threshold, directly or by others."""
    size = np.array([len(s) for s in sets])
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(size) - size
    marked = np.zeros(len(values), bool)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        found = np.minimum(size[others], size[i]) * 100 >= THRESHOLD * np.maximum(size[others], size[i])
        asked = others[found]
        if len(asked):
            marked[code[starts[i] : starts[i] + size[i]]] = True
            if len(asked) * 8 > len(sets):
                common = np.add.reduceat(marked[code].astype(np.int64), starts)[asked]
            else:
                common = np.array([np.count_nonzero(marked[code[starts[j] : starts[j] + size[j]]]) for j in asked.tolist()])
            marked[code[starts[i] : starts[i] + size[i]]] = False
            found[found] = 100 * common >= THRESHOLD * (size[asked] + size[i] - common)
        return found

    return _searched(len(sets), near)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, edges in _whole_groups(batches):
        node, raw = table.column("node").to_numpy(), table.column("shingles")
        links = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a > 1:
                i, j = confirmed_links([np.frombuffer(raw[k].as_py(), np.uint64) for k in range(a, b)])
                links.append((node[a + np.array(i, np.int64)], node[a + np.array(j, np.int64)]))
        yield _pairs(links)


def _grouped(units: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    # By node, so that links lead to the least node of what a task joins and few rounds make stars of them.
    dealt = units.repartition("key").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(run, "a long, b long").where("a != b").distinct()


def _regions(nodes: DataFrame, most_docs: int, most_shingles: int) -> tuple[DataFrame, DataFrame]:
    """(key, node) of regions that fit one task, and (key, node, parts) of the deepest ones that do not.

    nodes: node, n_shingles, shallow, deep. Sizes are counted before any region is formed.
    """
    fits = (F.col("docs") <= most_docs) & (F.col("load") <= most_shingles)

    def split(keys: str, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
        keyed = chosen.select(F.explode(keys).alias("key"), "node", "n_shingles")
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("load")).where("docs > 1")
        parts = F.greatest(F.ceil(F.col("docs") / most_docs), F.ceil(F.col("load") / most_shingles)).cast("int")
        # Stored, as both results come from this join.
        sized = materialize(keyed.join(sizes, "key").select("key", "node", parts.alias("parts"), fits.alias("fits")), "forest-regions")
        return sized.where("fits").select("key", "node"), sized.where("NOT fits").select("key", "node", "parts")

    units, dense = split("shallow", nodes)
    deep_units, hot = split("deep", nodes.join(dense.select("node").distinct(), "node"))
    return units.union(deep_units), hot


def clusters(nodes: DataFrame, most_docs: int = GROUP_DOCS) -> DataFrame:
    """(node, root) of documents that may be linked: within a cluster, never between two."""
    units, hot = _regions(nodes, most_docs, 1 << 62)
    signed_units = units.join(nodes.select("node", "signature"), "node").select("key", "node", "signature")
    hub = hot.groupBy("key").agg(F.min("node").alias("a"))
    # A pair may share many regions; a round would meet each of its copies at the hub.
    whole = hot.join(hub, "key").where("a != node").select("a", F.col("node").alias("b")).distinct()
    roots = component_roots(materialize(_grouped(signed_units, _alike).union(whole), "forest-candidates"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _chunk(parts: Column) -> Column:
    return F.pmod(F.xxhash64("node"), parts)


def _large_links(nodes: DataFrame, sets: DataFrame, most_docs: int, most_shingles: int) -> DataFrame:
    """Links within clusters that do not fit one task, region by region."""
    units, hot = _regions(nodes, most_docs, most_shingles)
    pivots = hot.groupBy("key", "parts").agg(F.min("node").alias("node")).select("key", "node", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("chunk"))
    chunks = hot.select("key", "node", _chunk(F.col("parts")).alias("chunk")).union(pivots).distinct()
    first = units.union(chunks.select(F.xxhash64("key", "chunk").alias("key"), "node"))
    links = materialize(_grouped(first.join(sets, "node").select("key", "node", "shingles"), _confirmed), "forest-links")
    if hot.isEmpty():
        return links
    # Every document outside the largest component of its hot region meets all chunks of the region.
    roots = component_roots(links)
    labelled = hot.join(roots, "node", "left").select("key", "node", "parts", F.coalesce("root", "node").alias("root"))
    largest = labelled.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
    minor = labelled.join(largest, "key").where("root != largest").select("key", "node", "parts")
    counted = minor.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / most_docs).cast("int").alias("rows"))
    own = minor.join(counted, "key").select(
        "key", "node", _chunk(F.col("rows")).alias("row"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("chunk")
    )
    others = hot.join(counted, "key").select(
        "key", "node", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), _chunk(F.col("parts")).alias("chunk")
    )
    second = own.select("key", "node", "row", F.col("chunk").cast("long").alias("chunk")).union(others.select("key", "node", F.col("row").cast("long").alias("row"), "chunk")).distinct()
    second = second.select(F.xxhash64("key", "row", "chunk").alias("key"), "node")
    joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))  # of what the links join already
    return joined.union(_grouped(second.join(sets, "node").select("key", "node", "shingles"), _confirmed))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the rows named by wanted (doc_id, mark, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text"):
            values, counts = shingle_sets(data, offsets)
            ends = np.cumsum(counts).tolist()
            raw = [values[b - n : b].tobytes() for b, n in zip(ends, counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("node"), pa.array(raw, pa.binary())], ["node", "shingles"])

    asked = wanted.select(F.col("doc_id").alias("own_id"), F.col("mark").alias("own_mark"), "node")
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    texts = marked.join(asked, (F.col("mark") == F.col("own_mark")) & F.col("doc_id").eqNullSafe(F.col("own_id"))).select("node", "text")
    return texts.dropDuplicates(["node"]).mapInArrow(run, "node long, shingles binary")


def near_duplicates(docs: DataFrame, most_docs: int = GROUP_DOCS, most_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id) of every row: the least doc_id reachable by links at the threshold.

    Rows with equal sets are one node. Null and empty texts, and those without words, have no shingles and are linked with
    nothing: their component is their own id. Null ids come after all others, so a null component_id means that no row
    of the component has an id. Repeated rows stay repeated; other columns are ignored; an empty table gives none.
    """
    rows = materialize(signed(docs), "forest-rows")
    filled = rows.where("n_shingles > 0")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("least")
    same = [F.any_value(c).alias(c) for c in ("n_shingles", "signature", "shallow", "deep")]
    nodes = materialize(filled.groupBy("set_a", "set_b").agg(least, *same).withColumn("node", F.monotonically_increasing_id()), "forest-nodes")
    placed = materialize(clusters(nodes, most_docs), "forest-clusters")
    members = placed.join(nodes, "node").select("node", "root", "n_shingles", F.col("least.doc_id").alias("doc_id"), F.col("least.mark").alias("mark"))
    sets = materialize(_sets(docs, members), "forest-sets")
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("load"))
    small = (F.col("docs") <= most_docs) & (F.col("load") <= most_shingles)
    sized = materialize(members.join(sizes, "root").select("node", "root", small.alias("small")), "forest-sized")
    links = _grouped(sized.where("small").select(F.col("root").alias("key"), "node").join(sets, "node").select("key", "node", "shingles"), _confirmed)
    large = nodes.select("node", "n_shingles", "shallow", "deep").join(sized.where("NOT small").select("node"), "node")
    if not large.isEmpty():
        links = links.union(_large_links(materialize(large, "forest-large"), sets, most_docs, most_shingles))
    roots = component_roots(materialize(links, "forest-confirmed"))
    joined = nodes.join(roots, "node", "left").select("set_a", "set_b", "least", F.coalesce("root", "node").alias("root"))
    component = joined.groupBy("root").agg(F.min("least").alias("first"))
    named = joined.join(component, "root").select("set_a", "set_b", F.col("first.doc_id").alias("component_id"))
    found = filled.select("doc_id", "mark", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"]).drop("set_a", "set_b")
    bare = rows.where("n_shingles = 0").select("doc_id", "mark", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(bare)


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs; see near_duplicates."""
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
