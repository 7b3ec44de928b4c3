"""Benchmark decontamination by winnowing: least k-gram hash of each sliding window, shared fingerprints, extended hits.

A span of WINDOW shared words holds WINDOW - k + 1 k-grams. Both sides keep every k-gram that is the least of some
window of that many consecutive k-grams, so each such span has a k-gram that both sides keep. A hit is extended word by
word to both sides and counts if the run reaches WINDOW words. Items with fewer words are one window of their own length;
for each such length all of a document's word runs of it are compared, as winnowing promises nothing below WINDOW words.

Equal words have equal hashes, so no shared span is missed; a run found by hashes is compared byte for byte.

A benchmark whose measured size is within BLOCK_BYTES is broadcast, and each task extends its hits in place. A larger one
is winnowed in tasks like the documents, and their windows are joined on the least k-gram hash and a digest of all words;
windows side by side make up the extended hit. A bit set of bounded size spares most windows of documents that join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvertide.llm.shared import materialize, named, spare_name
from silvertide.llm.text_buffers import ALNUM, Words, buffers, joined_words, pieces

WINDOW = 10
GRAM = 5
#: Bytes of benchmark text up to which an index of it is broadcast; a larger benchmark is joined by its fingerprints.
BLOCK_BYTES = 16 << 20
#: Bits of the set of benchmark fingerprints that is broadcast before the join, a power of two: 16 MB.
SIEVE_BITS = 1 << 27


class Index:
    """Fingerprints of a block of benchmark items, for all lengths of window that occur."""

    def __init__(self, item_ids: list, texts: list[str]):
        column = pa.array(texts, pa.large_string())
        self.ids = item_ids
        self.words = Words(*buffers(column), ALNUM)
        self.tables = []
        at, gram = self.words.winnowed(GRAM, WINDOW)
        if len(at):
            self.tables.append((GRAM, WINDOW, *self._table(at, gram)))
        counts = self.words.counts
        for n in sorted(set(counts[(counts > 0) & (counts < WINDOW)].tolist())):
            gram, _ = self.words.grams(n)
            at = self.words.firsts[:-1][counts == n]
            self.tables.append((n, n, *self._table(at, gram[at])))

    @staticmethod
    def _table(at: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(gram, kind="stable")
        hashes, first = np.unique(gram[order], return_index=True)
        seen = np.zeros(1 << 20, bool)
        seen[hashes & np.uint64((1 << 20) - 1)] = True
        return hashes, np.append(first, len(order)), at[order], seen

    def hits(self, doc: Words) -> tuple[np.ndarray, list[set]]:
        """Which of the documents' words lie in a window, and for each document the places of the items that occur."""
        hit = np.zeros(len(doc.hashes) + 1, np.int64)
        found: list[set] = [set() for _ in doc.counts]
        for k, window, hashes, first, places, seen in self.tables:
            if window == WINDOW:
                at, gram = doc.winnowed(k, window)
            else:
                gram, whole = doc.grams(k)
                at = np.flatnonzero(whole)
                gram = gram[at]
            near = seen[gram & np.uint64((1 << 20) - 1)]
            at, gram = at[near], gram[near]
            slot = np.searchsorted(hashes, gram)
            slot[slot == len(hashes)] = 0
            equal = hashes[slot] == gram
            done: dict[tuple[int, int], int] = {}  # on a diagonal of a document and an item: where its last run ended
            for i, s in zip(at[equal].tolist(), slot[equal].tolist(), strict=True):
                for q in places[first[s] : first[s + 1]].tolist():
                    if done.get((i - q, int(self.words.row[q])), -1) > i:
                        continue
                    begin, end = self._extend(doc, i, q, window)
                    if end - begin >= window and doc.same(begin, self.words, begin - i + q, end - begin):
                        done[(i - q, int(self.words.row[q]))] = end
                        hit[begin] += 1
                        hit[end] -= 1
                        found[int(doc.row[i])].add(int(self.words.row[q]))
        return np.cumsum(hit[:-1]) > 0, found

    def _extend(self, doc: Words, i: int, q: int, window: int) -> tuple[int, int]:
        """The longest run of equal words around document word i and item word q."""
        item, row = int(self.words.row[q]), int(doc.row[i])
        if window < WINDOW:
            return i, i + window
        back = min(i - int(doc.firsts[row]), q - int(self.words.firsts[item]))
        ahead = min(int(doc.firsts[row + 1]) - i, int(self.words.firsts[item + 1]) - q)
        differ = np.flatnonzero(doc.hashes[i - back : i][::-1] != self.words.hashes[q - back : q][::-1])
        after = np.flatnonzero(doc.hashes[i : i + ahead] != self.words.hashes[q : q + ahead])
        return i - (int(differ[0]) if len(differ) else back), i + (int(after[0]) if len(after) else ahead)


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of docs plus n_words, hit_ranges (begin and end of hit words, disjoint, in order) and hit_items.

    hit_items holds the distinct ids of the items that occur, as sorted strings: several items with one id count once, and
    items without an id hit words but have no id to list. Null and empty texts have no words and are never hit; null or
    empty items have no window. Columns of docs named like the new ones are replaced. A benchmark above block_bytes is
    not broadcast but joined.
    """
    kept = docs.drop("n_words", "hit_ranges", "hit_items")
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    if size > block_bytes:
        return _joined(kept, items)
    out = kept.withColumns({
        "n_words": F.lit(None).cast("long"),
        "hit_ranges": F.array().cast(RANGES),
        "hit_items": F.array().cast("array<string>"),
    })
    rows = items.collect()  # within block_bytes, as just measured
    return out.mapInArrow(_marker(docs.sparkSession.sparkContext.broadcast(([r.item_id for r in rows], [r.text for r in rows]))), out.schema)


RANGES = "array<struct<begin: bigint, end: bigint>>"
RANGES_TYPE = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _ranges(hit: np.ndarray) -> list[dict]:
    """Runs of true values as begin and end."""
    turns = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))).tolist()
    return [{"begin": b, "end": e} for b, e in zip(turns[::2], turns[1::2], strict=True)]


def _marker(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = block.value
        index = Index(ids, texts)
        for rows, data, offsets in pieces(batches, "text"):
            doc = Words(data, offsets, ALNUM)
            hit, found = index.hits(doc)
            ranges, items = [[] for _ in doc.counts], [[] for _ in doc.counts]
            for r in np.unique(doc.row[hit]).tolist():
                ranges[r] = _ranges(hit[doc.firsts[r] : doc.firsts[r + 1]])
                items[r] = sorted({index.ids[i] for i in found[r] if index.ids[i] is not None})
            new = {"n_words": pa.array(doc.counts.astype(np.int64)), "hit_ranges": pa.array(ranges, RANGES_TYPE), "hit_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(name, rows.column(name)) for name in rows.schema.names], rows.schema.names)

    return run


def _least(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows of n words inside one text, and the least hash of the k-grams in each.

    Below WINDOW words the only k-gram of a window is the window itself.
    """
    k = GRAM if n == WINDOW else n
    gram, _ = words.grams(k)
    total = len(words.hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.int64), gram[:0]
    least = gram[:total].copy()
    for j in range(1, n - k + 1):
        np.minimum(least, gram[j : total + j], out=least)
    at = np.flatnonzero(words.row[:total] == words.row[n - 1 :])
    return at, least[at]


def _digests(words: Words, at: np.ndarray, n: int) -> pa.Array:
    """A digest of the n words from each place on."""
    text, begins, ends = joined_words(words.data, words.starts, words.stops)
    raw = memoryview(text)
    spans = zip(begins[at].tolist(), ends[at + n - 1].tolist(), strict=True)
    return pa.array([hashlib.md5(raw[b:e]).digest() for b, e in spans], pa.binary())


def _item_windows(items: DataFrame) -> DataFrame:
    """(item_id, n, gram, digest): all windows of the items, each with its least k-gram hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "text"):
            words = Words(data, offsets, ALNUM)
            for n in range(1, WINDOW + 1):
                at, gram = _least(words, n)
                own = words.counts[words.row[at]] >= n if n == WINDOW else words.counts[words.row[at]] == n
                at, gram = at[own], gram[own]
                if len(at):
                    ids = rows.column("item_id").take(pa.array(words.row[at]))
                    sizes = pa.array(np.full(len(at), n, np.int32))
                    yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(gram.view(np.int64)), _digests(words, at, n)], ["item_id", "n", "gram", "digest"])

    return items.mapInArrow(run, "item_id string, n int, gram long, digest binary")


def _doc_windows(texts: DataFrame, sieve, lengths: list[int]) -> DataFrame:
    """(text_key, begin, n, gram, digest): windows of documents whose least k-gram hash passes the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sieve.value, np.uint8)
        for rows, data, offsets in pieces(batches, "text"):
            words = Words(data, offsets, ALNUM)
            for n in lengths:
                at, gram = _least(words, n)
                place = gram & np.uint64(8 * len(bits) - 1)
                known = bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1
                at, gram = at[known], gram[known]
                if len(at):
                    keys = rows.column("text_key").take(pa.array(words.row[at]))
                    begin, sizes = pa.array(at - words.firsts[words.row[at]]), pa.array(np.full(len(at), n, np.int32))
                    yield pa.RecordBatch.from_arrays([keys, begin, sizes, pa.array(gram.view(np.int64)), _digests(words, at, n)], ["text_key", "begin", "n", "gram", "digest"])

    return texts.mapInArrow(run, "text_key string, begin long, n int, gram long, digest binary")


def _sieve(grams: DataFrame, bits: int) -> bytes:
    """A bit set of the hashes modulo its size; rows of 4 KB, as many as the size fixes, reach the driver."""
    place = F.col("gram").bitwiseAND(F.lit(bits - 1)) + 1
    rows = grams.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = bytearray(bits // 8)
    for r in rows.collect():
        begin = (r.bucket - 1) * len(r.bits)
        out[begin : begin + len(r.bits)] = r.bits
    return bytes(out)


def _joined(kept: DataFrame, items: DataFrame, sieve_bits: int = SIEVE_BITS) -> DataFrame:
    """decontaminate() by joining the windows of documents and items.

    What a document shares depends on its text alone, so windows carry a digest of the text and equal texts have one result.
    Windows that the same items have share one list of them. The documents are read twice, whatever the benchmark's size,
    and shuffled once at most, when the marks come back to them.
    """
    spark = kept.sparkSession
    same = ["gram", "digest", "n"]
    found = _item_windows(items).groupBy(*same).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    windows = materialize(found.withColumn("list_id", F.sha2(F.to_json("ids").cast("binary"), 256)), "item-windows")
    # At most WINDOW lengths.
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())
    sieve = spark.sparkContext.broadcast(_sieve(windows, sieve_bits))
    key = F.sha2(F.col("text").cast("binary"), 256)
    texts = kept.where("text is not null").select(key.alias("text_key"), "text")
    shared = _doc_windows(texts, sieve, lengths).join(windows.select(*same, "list_id"), same).select("text_key", "begin", "n", "list_id")
    shared = materialize(shared.groupBy("text_key", "begin", "n").agg(F.first("list_id").alias("list_id")), "shared-windows")
    lists = windows.groupBy("list_id").agg(F.first("ids").alias("ids"))
    listed = shared.select("text_key", "list_id").distinct().join(lists, "list_id").select("text_key", F.explode_outer("ids").alias("item_id"))
    names = listed.groupBy("text_key").agg(F.array_sort(F.collect_set("item_id")).alias("hit_items"))
    spans = shared.groupBy("text_key").agg(F.collect_list(F.struct("begin", (F.col("begin") + F.col("n")).alias("end"))).alias("hit_ranges"))
    marks = materialize(spans.join(names, "text_key"), "hit-texts")
    own = spare_name(kept, "text_key")
    marked = kept.withColumn(own, key).join(marks.withColumnRenamed("text_key", own), own, "left").withColumn("n_words", F.lit(None).cast("long"))
    none = {"hit_ranges": F.coalesce("hit_ranges", F.array().cast(RANGES)), "hit_items": F.coalesce("hit_items", F.array().cast("array<string>"))}
    out = marked.select(*[named(c) for c in kept.columns], "n_words", *[c.alias(n) for n, c in none.items()])
    return out.mapInArrow(_merge_spans, out.schema)


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts the words and unites overlapping windows in hit_ranges."""
    for rows, data, offsets in pieces(batches, "text"):
        counts = Words(data, offsets, ALNUM).counts
        ranges = []
        for n, spans in zip(counts.tolist(), rows.column("hit_ranges"), strict=True):
            hit = np.zeros(n if len(spans) else 0, bool)
            for x in spans.as_py():
                hit[x["begin"] : x["end"]] = True
            ranges.append(_ranges(hit))
        new = {"n_words": pa.array(counts.astype(np.int64)), "hit_ranges": pa.array(ranges, RANGES_TYPE)}
        yield pa.RecordBatch.from_arrays([new.get(name, rows.column(name)) for name in rows.schema.names], rows.schema.names)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    n_hit = F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])
    listed = F.array_join(F.array_sort("hit_items"), ",")
    return decontaminate(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
