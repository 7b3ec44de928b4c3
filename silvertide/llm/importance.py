"""Importance resampling towards a target distribution over hashed word features.

Each piece of text gets a dictionary of its distinct words, bounded by delimiters, as an Aho-Corasick automaton; a word's
payload is its CRC and its length. One scan emits the payloads in the order of the text. The CRC of a run of words is
composed from adjacent payloads, without going back to the text, and its remainder is the bucket of the feature. The same
scan serves twice: bucket counts of both corpora, and the weight of each document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvertide.llm.shared import materialize, named, numbered, spare_name
from silvertide.llm.text_buffers import ALNUM, LOWER, pieces

MAX_RUN = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Bytes of text that share one dictionary; a longer single text has one of its own.
PIECE_BYTES = 4 << 20
#: Longer words stand in the scanned text as short signs, so that the automaton stays small; their payload is the whole word's.
LONG_WORD = 64

_PLAIN = np.where(ALNUM[LOWER], LOWER, 0x20).astype(np.uint8).tobytes()
#: Ends a document in the scanned text; no word holds control characters.
_END = "\x02"
_POLYNOMIAL = 0xEDB88320


def _zero_bytes(power: int) -> np.ndarray:
    """The image of each of the 32 bits of a CRC when 2**power zero bytes are appended."""
    images = np.array([1 << i for i in range(32)], np.uint32)
    for _ in range(8):
        images = (images >> np.uint32(1)) ^ np.where(images & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    for _ in range(power):
        images = _apply(images, images)
    return images


def _apply(images: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where(values >> np.uint32(bit) & np.uint32(1), images[bit], np.uint32(0))
    return out


def composed(left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
    """CRCs of joined strings from the CRCs of their halves and the lengths of the second ones."""
    left = left.copy()
    for power in range(int(right_bytes.max(initial=0)).bit_length()):
        at = np.flatnonzero(right_bytes >> power & 1)
        left[at] = _apply(_zero_bytes(power), left[at])
    return left ^ right


def payloads(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """CRC of every word, CRC and length of a space and the word, and the row of each, in the order of the texts."""
    plain = data.tobytes().translate(_PLAIN)
    bounds = offsets.tolist()
    texts = [plain[a:b].decode() for a, b in zip(bounds, bounds[1:], strict=False)]
    words: dict[str, int] = {}
    for i, text in enumerate(texts):
        own = text.split(" ")
        long = {w for w in own if len(w) > LONG_WORD}
        if long:
            signs = {w: f"\x01{words.setdefault(w, len(words) + 1)}" for w in sorted(long)}
            texts[i] = " ".join([signs.get(w, w) for w in own])
        for w in set(own) - long:
            if w:
                words.setdefault(w, len(words) + 1)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    crc, spaced, size = (np.zeros(len(words) + 1, t) for t in (np.uint32, np.uint32, np.int64))
    automaton.add_word(f" {_END} ", 0)
    for word, i in words.items():
        raw = word.encode()
        crc[i], spaced[i], size[i] = zlib.crc32(raw), zlib.crc32(b" " + raw), len(raw) + 1
        automaton.add_word(f" {word} " if len(word) <= LONG_WORD else f" \x01{i} ", i)
    automaton.make_automaton()
    scanned = " " + f" {_END} ".join(texts) + " "
    found = np.fromiter(map(itemgetter(1), automaton.iter(scanned)), np.int64)
    row = np.cumsum(found == 0)[found > 0]
    found = found[found > 0]
    return crc[found], spaced[found], size[found], row


def features(data: np.ndarray, offsets: np.ndarray, max_run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every run of 1 to max_run words, and how many words each row has."""
    crc, spaced, size, row = payloads(data, offsets)
    runs, rows, run = [crc], [row], crc
    for n in range(2, max_run + 1):
        inside = row[: max(len(row) - n + 1, 0)] == row[n - 1 :]
        run = composed(run[: len(inside)], spaced[n - 1 :], size[n - 1 :])
        runs.append(run[inside]), rows.append(row[: len(inside)][inside])
    return np.concatenate(runs) % np.uint32(buckets), np.concatenate(rows), np.bincount(row, minlength=len(offsets) - 1)


def bucket_counts(texts: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all whole texts fall into each bucket. A task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for _, data, offsets in pieces(batches, "text", PIECE_BYTES):
            counts += np.bincount(features(data, offsets, max_run, buckets)[0], minlength=buckets)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), pa.array(counts[own])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS) -> list[int]:
    """Floor of 1000 times the log ratio of a bucket's smoothed shares, target to docs. One row per bucket reaches the driver."""
    counted = []
    for side in (target, docs):
        counts = [0] * buckets
        for r in bucket_counts(side, max_run, buckets).collect():
            counts[r.bucket] = r.n
        counted.append(counts)
    wanted, own = counted
    whole_wanted, whole_own = sum(wanted) + buckets, sum(own) + buckets
    return [
        math.floor(1000 * math.log((t + 1.0) * whole_own / ((s + 1.0) * whole_wanted))) for t, s in zip(wanted, own, strict=True)
    ]


def weighed(docs: DataFrame, gain: list[int], max_run: int = MAX_RUN) -> DataFrame:
    """(doc_id, mark, n_words, n_features, weight) of every row; weight is the floored mean gain of its features, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for rows, data, offsets in pieces(batches, "text", PIECE_BYTES):
            bucket, row, words = features(data, offsets, max_run, len(gain))
            n = np.bincount(row, minlength=len(words))
            total = np.zeros(len(words), np.int64)
            np.add.at(total, row, gain[bucket])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            columns = [rows.column("doc_id"), rows.column("mark"), *map(pa.array, (words.astype(np.int64), n.astype(np.int64), weight))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, mark long, n_words long, n_features long, weight long"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, schema)


def score(seed: int = SEED) -> Column:
    """Weight plus a Gumbel variable drawn from the document's id; a null id counts as an empty one."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(drawn, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.col("weight") + F.floor(F.lit(-1000.0) * F.ln(-F.ln(uniform)))


def importance_report(
    docs: DataFrame, target: DataFrame, max_run: int = MAX_RUN, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """(doc_id, mark, n_features, weight, score, rank) of every row of docs, drawn towards the texts of target.

    Of the rows with at least least_words words, the given percentage (rounded down) with the highest scores are drawn and
    ranked 1, 2, 3, ...; equal scores go to the smaller doc_id, null ids last, then to more features and by the text's hash.
    The rank of the others is null. Null and empty texts have no features and weight 0; an empty target or empty docs are
    allowed. Repeated rows are drawn one by one. Other columns are ignored. Rows are sorted by range over all tasks, and a
    table with one row per range numbers them.
    """
    weights = materialize(weighed(docs, gains(docs, target, max_run, buckets), max_run), "importance-weights")
    scored = weights.withColumns({"score": score(seed), "passes": F.col("n_words") >= least_words})
    drawn = scored.agg(F.count_if("passes")).first()[0] * percent // 100
    order = [F.desc("passes"), F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), "mark"]
    placed = numbered(scored, order, "place")
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    return placed.select("doc_id", "mark", "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, **options: int) -> DataFrame:
    """The rows of docs, with all columns, whose doc_id and text are drawn; see importance_report.

    Of rows with equal doc_id and text all stay if one is drawn. Columns of docs may have any names besides doc_id and text.
    """
    mark, drawn_id, drawn_mark = (spare_name(docs, n) for n in ("text_mark", "drawn_id", "drawn_mark"))
    drawn = importance_report(docs, target, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias(drawn_id), F.col("mark").alias(drawn_mark))
    own = F.col("doc_id").eqNullSafe(F.col(drawn_id)) & F.col(mark).eqNullSafe(F.col(drawn_mark))
    return docs.withColumn(mark, F.xxhash64("text")).join(drawn, own, "left_semi").select(*map(named, docs.columns))
