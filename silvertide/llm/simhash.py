"""SimHash near-duplicates: pigeonring candidates, Hamming check, components by star contraction.

Sixty-four bits are five segments in a ring, and the budget of four differing bits is shared out in proportion. If two
fingerprints differ in at most four bits, some segment starts a chain whose first l segments differ in at most
floor(4 l / 5) bits for every l: 0, 1, 2, 3, 4. The first segment is therefore equal and the second differs in one bit at
most, so one of its halves is equal too. Segment, half and place in the ring are the key that candidates must share; the
rest of the chain prunes them before the whole distance is counted.

A key that many fingerprints share is dealt out as pairs of bounded chunks. A chunk pair gives a spanning forest of its
links and not its pairs, so the copies of a group never meet in one task and are never paired out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silvertide.llm.components import component_roots
from silvertide.llm.shared import materialize, named, plain_id, spare_name
from silvertide.llm.text_buffers import LOWER, NON_SPACE, joined_words, pieces, word_spans

SEED = 42
SHINGLE = 4
MAX_DISTANCE = 4
#: First bit and width of the segments, in the order of the ring.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints that one chunk of a key holds on average.
CHUNK = 512
#: Groups up to this size are compared by shifted arrays, larger ones as a matrix.
SMALL_GROUP = 8


def fingerprint_rows(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """One signed 64-bit fingerprint per row; rows without words get zero."""
    starts, stops, counts = word_spans(data, offsets, NON_SPACE)
    prints = np.zeros(len(counts), np.int64)
    if not len(starts):
        return prints
    text, begins, ends = joined_words(LOWER[data], starts, stops)
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    rows = np.repeat(np.arange(len(counts)), shingles)
    first = np.arange(int(shingles.sum())) - np.repeat(np.cumsum(shingles) - shingles, shingles) + firsts[rows]
    last = np.minimum(first + shingle, (firsts + counts)[rows]) - 1
    view, digest = memoryview(text), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(begins[first].tolist(), ends[last].tolist(), strict=True)), np.uint64, len(first))
    worded = np.flatnonzero(counts)
    at = 0
    for row in worded.tolist():  # unpacked bits of one text at a time
        n = int(shingles[row])
        ones = np.zeros(64, np.int64)
        for part in range(at, at + n, 1 << 16):
            own = hashes[part : min(part + (1 << 16), at + n)]
            ones += np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        prints[row] = np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0]
        at += n
    return prints


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp) of every row of docs, whole texts; mark is a hash of the text. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("mark"), pa.array(fingerprint_rows(data, offsets))], ["doc_id", "mark", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_mark().alias("mark")).mapInArrow(run, f"doc_id {kind}, mark long, fp long")


def text_mark() -> Column:
    """Tells rows with the same doc_id apart by their texts."""
    return F.xxhash64("text")


def _bits(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fp: Column) -> Column:
    """The ten keys of a fingerprint: place in the ring, equal first segment, equal half of the second."""
    keys = []
    for i, (first, width) in enumerate(SEGMENTS):
        start, size = SEGMENTS[(i + 1) % len(SEGMENTS)]
        low = size // 2
        for half, (at, bits) in enumerate(((start, low), (start + low, size - low))):
            value = F.shiftleft(_bits(fp, first, width), 16).bitwiseOR(_bits(fp, at, bits))
            keys.append(value + F.lit((2 * i + half) << 40))
    return F.array(*keys)


def _chain(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether differing bits x keep the proportional budgets of the chain that starts at place, then of the whole."""
    masks = np.array([((1 << w) - 1) << s for s, w in SEGMENTS], np.uint64)
    kept, total, n = np.ones(x.shape, bool), np.zeros(x.shape, np.uint8), len(SEGMENTS)
    for l in range(n):
        total += np.bitwise_count(x & masks[(place + l) % n])
        kept &= total <= (l + 1) * MAX_DISTANCE // n
    return kept & (np.bitwise_count(x) <= MAX_DISTANCE)


def _forest(prints: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each fingerprint to the first of its component within the group."""
    prints = np.unique(prints)
    n = len(prints)
    near = _chain(prints[:, None] ^ prints[None, :], np.int64(place))
    label = np.arange(n)
    while True:
        new = np.where(near, label[None, :], n).min(axis=1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return prints[moved], prints[label[moved]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of units that follow one another in sorted batches; a unit may run on into the next batch."""
    kept: pa.Table | None = None

    def linked(table: pa.Table) -> pa.RecordBatch:
        key, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
        fp, place = table.column("fp").to_numpy().view(np.uint64), key >> 41
        edge = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        start = np.concatenate([[0], edge])
        size = np.diff(np.concatenate([start, [len(key)]]))
        own = np.repeat(size, size)
        group = np.repeat(np.arange(len(size)), size)
        left, right = [], []
        for d in range(1, SMALL_GROUP):
            at = np.flatnonzero((own[:-d] <= SMALL_GROUP) & (group[:-d] == group[d:]))
            at = at[_chain(fp[at] ^ fp[at + d], place[at])]
            left.append(fp[at]), right.append(fp[at + d])
        for g in np.flatnonzero(size > SMALL_GROUP):
            a, b = _forest(fp[start[g] : start[g] + size[g]], int(place[start[g]]))
            left.append(a), right.append(b)
        pair = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0).view(np.int64)
        pair = pair[pair[:, 0] != pair[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([kept, table]) if kept is not None else table
        if not table.num_rows:
            continue
        key, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
        last = len(key) - 1
        ends = np.flatnonzero((key != key[last]) | (i != i[last]) | (j != j[last]))
        cut = int(ends[-1]) + 1 if len(ends) else 0
        kept = table.slice(cut).combine_chunks()
        if cut:
            yield linked(table.slice(0, cut))
    if kept is not None and kept.num_rows:
        yield linked(kept)


def near_links(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between different fingerprints, enough to join all that lie within four bits of each other.

    prints: distinct (fp). No pair within four bits is left unconnected. A link of a large group leads to the first of
    those that the group connects, so it may join two that only a path of near ones connects.
    """
    keyed = prints.select(F.explode(_keys(F.col("fp"))).alias("key"), "fp")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    placed = keyed.join(shared, "key").select("key", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    units = (
        placed.select("key", "fp", "own", other.alias("other"))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    dealt = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp, component_id, component_mark): each row's fingerprint, and the least row reachable by links.

    Null and empty texts have fingerprint zero and are linked like any other. Null ids come after all others, so a null
    component_id means that no row of the component has an id. Repeated rows stay repeated. Other columns are ignored;
    an empty table gives none.
    """
    rows = materialize(fingerprints(docs), "simhash-rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark"))
    prints = materialize(rows.groupBy("fp").agg(least.alias("least")), "simhash-prints")
    roots = component_roots(materialize(near_links(prints.select("fp")), "simhash-links"))
    named = prints.join(roots, prints.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("least"))
    components = named.select("fp", "root").join(smallest, "root").select(
        "fp", F.col("least.doc_id").alias("component_id"), F.col("least.mark").alias("component_mark")
    )
    return rows.join(components, "fp").select("doc_id", "mark", "fp", "component_id", "component_mark")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, that stand for their component: one for each.

    Columns of docs may have any names besides doc_id and text. Of rows with equal doc_id and text the one stays whose
    whole row has the least hash, whatever the order of the rows. Texts are shuffled once: the join and the choice among
    equal rows have the same keys.
    """
    kept_id, turn = (spare_name(docs, n) for n in ("kept_id", "turn"))
    own = [spare_name(docs, n) for n in ("no_id", "plain_id", "text_mark")]
    found = near_duplicates(docs).select(F.col("component_id").alias(kept_id), F.col("component_mark").alias(own[2])).distinct()
    found = found.select(*(c.alias(n) for c, n in zip(plain_id(F.col(kept_id)), own, strict=False)), own[2])
    marked = docs.withColumns(dict(zip(own, [*plain_id(F.col("doc_id")), text_mark()], strict=True)))
    hashed = [named(f.name) for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    first = Window.partitionBy(*own).orderBy(F.xxhash64(*hashed))
    return marked.join(found, own, "left_semi").withColumn(turn, F.row_number().over(first)).where(F.col(turn) == 1).select(*map(named, docs.columns))


def fingerprint_text(fp: Column) -> Column:
    """Sixteen lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
