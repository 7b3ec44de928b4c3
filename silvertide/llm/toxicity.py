"""Toxicity by the nearest labelled examples: TF-IDF cosine, exact over the chosen terms, by a block-max inverted index.

Terms are words, the beginnings of words and repeated beginnings, lower-cased, as 64-bit hashes. The vocabulary is what tells the classes of
the labelled sample apart most, by chi-squared; document frequencies are counted over all documents. The index holds for
each term its examples in blocks with the largest weight of each block. A search sums these maxima to a bound for every
block, scores the best blocks exactly, and then only those blocks whose bound reaches the k-th similarity so far, so the
neighbours are the exact ones. Their votes, weighted by similarity, are calibrated on the examples themselves, each left
out of its own search.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvertide.llm.labelled import Platt, fit_platt, fold, labelled_sample
from silvertide.llm.shared import materialize
from silvertide.llm.text_buffers import ALNUM, Words, mixed, pieces

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Bounds of the labelled sample.
CLEAN_EXAMPLES, TOXIC_EXAMPLES = 3500, 1500
TERMS = 1500
#: A term must occur in so many examples.
LEAST_EXAMPLES = 3
#: Chi-squared that a term must reach.
LEAST_CHI = 3.84
NEIGHBOURS = 20
BLOCK = 64
#: Blocks scored before any bound is compared.
FIRST_BLOCKS = 4
#: Lengths of beginnings in bytes, and how often one of the first length must occur for the terms that say so.
PREFIXES, REPEATS = (4, 5), (2, 3)
EVIDENCE = 3


def _beginnings(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with more than so many bytes, and the hashes of what they begin with."""
    longer = np.flatnonzero(words.stops - words.starts > size)
    begin = np.zeros(len(longer), np.uint64)
    for j in range(size):
        begin = begin * np.uint64(256) + words.data[words.starts[longer] + j].astype(np.uint64)
    return longer, mixed(begin + np.uint64(size << 40))


def _repeated(terms: np.ndarray, times: int) -> np.ndarray:
    """The terms that say that a beginning occurs at least so often in a text."""
    return mixed(terms + np.uint64(times))


def _unmixed(x: np.ndarray) -> np.ndarray:
    """What mixed() has made x of."""
    x = (x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = (x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def _counted(rows: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of row and term in order, and how often each occurs."""
    order = np.lexsort((terms, rows))
    rows, terms = rows[order], terms[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])])) if len(rows) else np.zeros(0, np.int64)
    return rows[first], terms[first], np.diff(np.append(first, len(rows)))


def term_counts(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every different term of every row, in order of rows.

    Terms are words, beginnings of words, and beginnings that occur repeatedly. wanted: a table of the low bits of the
    hashes that matter; others are left out early, beginnings that repeat among them.
    """
    words = Words(data, offsets, ALNUM)
    low = np.uint64((1 << 20) - 1)
    kept = lambda terms: np.arange(len(terms)) if wanted is None else np.flatnonzero(wanted[terms & low])
    near = kept(words.hashes)
    parts = [_counted(words.row[near], words.hashes[near])]
    for size in PREFIXES:
        longer, terms = _beginnings(words, size)
        near = kept(terms)
        parts.append(_counted(words.row[longer[near]], terms[near]))
    rows, terms, counts = parts[1]
    for times in REPEATS:
        often = counts >= times
        parts.append((rows[often], _repeated(terms[often], times), np.ones(int(often.sum()), np.int64)))
    rows, terms, counts = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((terms, rows))
    return rows[order], terms[order], counts[order]


class Vocabulary:
    """Chosen terms, sorted, with a table that rules out most others at once.

    The table also lets through every beginning whose repetition would be a chosen term.
    """

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms.astype(np.uint64))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.terms & np.uint64((1 << 20) - 1)] = True
        for times in REPEATS:
            self.seen[(_unmixed(self.terms) - np.uint64(times)) & np.uint64((1 << 20) - 1)] = True

    def places(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which terms are chosen ones, and their places."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.searchsorted(self.terms, terms)
        place[place == len(self.terms)] = 0
        known = np.flatnonzero(self.terms[place] == terms)
        return known, place[known].astype(np.int64)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, place of the term and count for the terms of the vocabulary."""
        rows, terms, counts = term_counts(data, offsets, self.seen)
        known, place = self.places(terms)
        return rows[known], place, counts[known]


class BlockMaxIndex:
    """Unit vectors of the examples by term, in blocks of examples with their largest weights."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_rows: int, n_terms: int):
        self.n, self.blocks = n_rows, -(-n_rows // BLOCK)
        order = np.lexsort((rows, terms))
        self.rows, self.weights, own = rows[order], weights[order], terms[order]
        self.first = np.searchsorted(own, np.arange(n_terms + 1))
        cell = own * max(self.blocks, 1) + self.rows // BLOCK
        start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        self.cell_block, self.cell_start = self.rows[start] // BLOCK, np.append(start, len(cell))
        self.cell_max = np.maximum.reduceat(self.weights, start) if len(start) else np.zeros(0)
        self.cell_first = np.searchsorted(own[start], np.arange(n_terms + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine with a unit vector, and the cosines; ties by place, zeros left out."""
        cells = _ranges(self.cell_first[terms], self.cell_first[terms + 1])
        scale = np.repeat(weights, self.cell_first[terms + 1] - self.cell_first[terms])
        bound = np.bincount(self.cell_block[cells], self.cell_max[cells] * scale, self.blocks)
        by_bound = np.argsort(-bound, kind="stable")
        turn = np.zeros(self.blocks, np.int8)
        turn[by_bound[:FIRST_BLOCKS]] = 1
        score = self._exact(cells, scale, turn == 1)
        if without >= 0:
            score[without] = 0
        top, kth = self._best(score, k)
        if kth < bound.max(initial=0.0):
            turn[(turn == 0) & (bound >= kth - 1e-9) & (bound > 0)] = 2
            if (turn == 2).any():
                score += self._exact(cells, scale, turn == 2)
                if without >= 0:
                    score[without] = 0
                top, _ = self._best(score, k)
        top = top[np.lexsort((top, -score[top]))][:k]
        return top, score[top]

    @staticmethod
    def _best(score: np.ndarray, k: int) -> tuple[np.ndarray, float]:
        """Examples that reach the k-th largest score, ties included, and that score; zeros do not count."""
        top = np.flatnonzero(score > 0)
        if len(top) < k:
            return top, 0.0
        own = score[top]
        kth = float(np.partition(own, len(own) - k)[len(own) - k])
        return top[own >= kth], kth

    def _exact(self, cells: np.ndarray, scale: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        own = wanted[self.cell_block[cells]]
        cells, scale = cells[own], scale[own]
        a, b = self.cell_start[cells], self.cell_start[cells + 1]
        at = _ranges(a, b)
        return np.bincount(self.rows[at], self.weights[at] * np.repeat(scale, b - a), self.n)


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers of several ranges, one after the other."""
    size = last - first
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


@dataclass
class Model:
    """What a task needs to score texts; its size is bounded by the sample and the vocabulary."""

    vocabulary: Vocabulary
    idf: np.ndarray
    index: BlockMaxIndex
    labels: np.ndarray
    ids: list[str]
    votes: np.ndarray
    rate: float
    platt: Platt

    def weighted(self, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Weights of unit length."""
        w = (1 + np.log(np.maximum(counts, 1))) * self.idf[terms]
        length = np.sqrt(np.bincount(rows, w * w, n))
        return w / np.maximum(length[rows], 1e-12)

    def vote(self, near: np.ndarray, similarity: np.ndarray) -> float:
        """Share of toxic votes: similarity squared, times how many labelled documents an example stands for."""
        weight = similarity**2 * self.votes[near]
        drawn = 1e-3 * self.votes.mean() if len(self.votes) else 1.0
        return float((weight[self.labels[near] == 1].sum() + drawn * self.rate) / (weight.sum() + drawn))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
        """Calibrated scores, and for each row its nearest examples as evidence."""
        n = len(offsets) - 1
        raw, evidence = np.full(n, self.rate), [[] for _ in range(n)]
        rows, terms, counts = self.vocabulary.counts(data, offsets)
        if self.index.n and len(rows):
            weights = self.weighted(rows, terms, counts, n)
            edge = np.searchsorted(rows, np.arange(n + 1))
            for r in np.flatnonzero(np.diff(edge)).tolist():
                a, b = edge[r], edge[r + 1]
                near, similarity = self.index.nearest(terms[a:b], weights[a:b], NEIGHBOURS)
                raw[r] = self.vote(near, similarity)
                evidence[r] = [
                    {"doc_id": self.ids[e], "similarity": float(s), "toxic": int(self.labels[e])}
                    for e, s in zip(near[:EVIDENCE].tolist(), similarity[:EVIDENCE].tolist(), strict=True)
                ]
        return self.platt(raw), evidence


def choose_terms(names: np.ndarray, toxic: np.ndarray, clean: np.ndarray, p: int, n: int, most: int = TERMS) -> np.ndarray:
    """Terms of enough examples with the largest chi-squared between occurring and being toxic.

    toxic and clean say in how many of the p toxic and n clean examples each of the names occurs.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (toxic * (n - clean) - clean * (p - toxic)) ** 2 * (p + n) / ((toxic + clean) * (p + n - toxic - clean) * p * n)
    chi = np.where((toxic + clean >= LEAST_EXAMPLES) & np.isfinite(chi), chi, 0)
    best = np.lexsort((names, -chi))[:most]
    return names[best[chi[best] >= LEAST_CHI]]


def fit(docs: DataFrame, labels: DataFrame, negatives: int = CLEAN_EXAMPLES, positives: int = TOXIC_EXAMPLES) -> Model:
    """Learns from a bounded sample of labels outside the held-out fold; document frequencies come from all of docs."""
    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, negatives, positives)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "text"):
            rows, terms, counts = term_counts(data, offsets)
            edge = pa.array(np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edge, pa.array(x)) for x in (terms.view(np.int64), counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("label"), *lists], ["doc_id", "label", "terms", "counts"])

    # At most negatives + positives rows with the terms of one text each; they are counted where they are.
    examples = materialize(sample.rows.mapInArrow(listed, "doc_id string, label int, terms array<long>, counts array<long>"), "toxicity-examples")
    sizes = {r.label: r.n for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    occurring = examples.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean")
    ).where(F.col("toxic") + F.col("clean") >= LEAST_EXAMPLES).toArrow()
    seen = [occurring.column(c).to_numpy().astype(np.int64) for c in ("term", "toxic", "clean")]
    vocabulary = Vocabulary(choose_terms(seen[0].view(np.uint64), seen[1], seen[2], sizes.get(1, 0), sizes.get(0, 0)))

    def known_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(c) for c in ("terms", "counts")]
            flat = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
            edge = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))])
            known, place = vocabulary.places(flat[0].astype(np.int64).view(np.uint64))
            own = pa.array(np.searchsorted(known, edge).astype(np.int32))
            kept = [pa.ListArray.from_arrays(own, pa.array(x)) for x in (place, flat[1][known].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *kept], ["doc_id", "label", "places", "counts"])

    # Only the chosen terms of the examples reach the driver.
    found = examples.mapInArrow(known_terms, "doc_id string, label int, places array<long>, counts array<long>").toArrow().sort_by("doc_id")
    label = found.column("label").to_numpy().astype(np.int64)
    edge = np.concatenate([[0], np.cumsum([len(x) for x in found.column("places")])]).astype(np.int64)
    rows = np.repeat(np.arange(len(label)), np.diff(edge))
    place, counts = (found.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("places", "counts"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n = np.zeros(len(vocabulary.terms), np.int64), 0
        for batch, data, offsets in pieces(batches, "text"):
            own += np.bincount(vocabulary.counts(data, offsets)[1], minlength=len(own))
            n += batch.num_rows
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(own[at], n))], ["term", "n"])

    sums = docs.select("text").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, n_docs = np.zeros(len(vocabulary.terms)), 0
    for r in sums:  # one row per chosen term
        if r.term < 0:
            n_docs = r.n
        else:
            df[r.term] = r.n
    idf = np.log((1 + n_docs) / (1 + df))
    in_sample = {1: max(int(label.sum()), 1), 0: max(int((1 - label).sum()), 1)}
    votes = np.where(label == 1, sample.rate / in_sample[1], (1 - sample.rate) / in_sample[0]) * max(len(label), 1)
    model = Model(vocabulary, idf, None, label, found.column("doc_id").to_pylist(), votes, sample.rate, Platt(1.0, 0.0))
    weights = model.weighted(rows, place, counts, len(label))
    model.index = BlockMaxIndex(rows, place, weights, len(label), len(vocabulary.terms))
    raw = np.full(len(label), sample.rate)
    for r in np.flatnonzero(np.diff(edge)).tolist():
        a, b = edge[r], edge[r + 1]
        raw[r] = model.vote(*model.index.nearest(place[a:b], weights[a:b], NEIGHBOURS, without=r))
    model.platt = fit_platt(raw, label, sample.rate)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with toxicity (0 to 1) and evidence, the nearest labelled examples.

    Null and empty texts, and texts without any known term, get the calibrated share of toxic labels. Columns of docs
    named like the new ones are replaced; all others, repeated rows and null ids stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("doc_id", pa.string()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, data, offsets in pieces(batches, "text"):
            scores, evidence = own.score(data, offsets)
            new = [pa.array(scores), pa.array(evidence, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "toxicity", "evidence"])

    kept = docs.drop("toxicity", "evidence")
    extra = kept.limit(0).select("*", F.lit(0.0).alias("toxicity"), F.array().cast("array<struct<doc_id: string, similarity: double, toxic: int>>").alias("evidence"))
    return kept.mapInArrow(run, extra.schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and evidence."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "evidence",
    )
