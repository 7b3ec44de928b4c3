"""Document quality by a linear-chain conditional random field over lines.

Every line that holds a word is good or bad. Its features and those of its two neighbours score both states, a
transition table scores neighbouring states, and forward-backward gives the marginal probability that a line is good.
A document's raw quality is the mean of its lines' marginals by length, calibrated to a probability. Training takes a
document's label as that of its lines, on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvertide.llm.labelled import Platt, fit_platt, fold, labelled_sample
from silvertide.llm.text_buffers import NON_SPACE, byte_set, mixed, pieces, word_spans

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
#: Bounds of the labelled sample, by label.
BAD_EXAMPLES, GOOD_EXAMPLES = 2000, 2000
ROUNDS, RATE, RIDGE = 150, 0.1, 1e-3
#: Columns of line_features(), in order.
FEATURES = ("log_words", "symbols", "exclamations", "capitals", "digits", "word_length", "repeats", "repeated_line")

_SYMBOLS = byte_set((0x23, 0x26), (0x2A, 0x2A), (0x3C, 0x3C), (0x3E, 0x3E), (0x7C, 0x7C))
_EXCLAMATIONS, _CAPITALS, _DIGITS = byte_set((0x21, 0x21)), byte_set((0x41, 0x5A)), byte_set((0x30, 0x39))


def _per_range(table: np.ndarray, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many bytes of a set lie between consecutive edges."""
    at = np.flatnonzero(table[data])
    return np.diff(np.searchsorted(at, edges))


def _span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes that depends on nothing but its bytes, by differences of one running sum."""
    position = np.arange(len(data), dtype=np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(position), base, np.uint64)]))
    back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(position), inverse, np.uint64)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
    return mixed((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64))


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and length of each line with a word, and how many such lines each row has."""
    breaks = np.flatnonzero(data == 0x0A)
    edges = np.unique(np.concatenate([offsets, breaks + 1]))
    begins, ends = edges[:-1], edges[1:]
    starts, stops, _ = word_spans(data, offsets, NON_SPACE)
    line = np.searchsorted(begins, starts, "right") - 1
    words = np.bincount(line, minlength=len(begins)).astype(np.float64)
    row = np.searchsorted(offsets[1:], begins, "right")
    used = np.flatnonzero(words)
    counts = np.bincount(row[used], minlength=len(offsets) - 1)
    if not len(used):
        return np.zeros((0, len(FEATURES))), np.zeros(0), counts
    hashes, own = _span_hashes(data, starts, stops), row[line]
    # Windows of three words that occur more than once in their text; a window belongs to the line where it begins.
    repeats = np.zeros(len(begins))
    if len(hashes) >= 3:
        inside = own[:-2] == own[2:]
        windows = mixed(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7))
        _, place, times = np.unique(mixed(windows + own[:-2].astype(np.uint64)), return_inverse=True, return_counts=True)
        repeats = np.bincount(line[:-2], (times[place] > 1) & inside, len(begins))
    whole = mixed(_span_hashes(data, begins[used], ends[used] - (data[ends[used] - 1] == 0x0A)) + row[used].astype(np.uint64))
    _, place, times = np.unique(whole, return_inverse=True, return_counts=True)
    letters = np.bincount(line, stops - starts, len(begins))
    share = lambda x, y: x[used] / np.maximum(y[used], 1)
    columns = (
        np.log1p(words[used]) / 4,
        np.minimum(share(_per_range(_SYMBOLS, data, edges), words), 3),
        np.minimum(share(_per_range(_EXCLAMATIONS, data, edges), words), 3),
        share(_per_range(_CAPITALS, data, edges), letters),
        share(_per_range(_DIGITS, data, edges), letters),
        np.minimum(share(letters, words), 30) / 10,
        share(repeats, words),
        (times[place] > 1).astype(np.float64),
    )
    return np.stack(columns, axis=1), letters[used], counts


def with_neighbours(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it in its text (zeros at the ends), and a constant."""
    n, width = features.shape
    first = np.cumsum(counts) - counts
    first, last = first[counts > 0], (first + counts - 1)[counts > 0]
    before, after = np.zeros((n, width)), np.zeros((n, width))
    before[1:], after[:-1] = features[:-1], features[1:]
    before[first], after[last] = 0, 0
    return np.concatenate([features, before, after, np.ones((n, 1))], axis=1)


@dataclass
class Chain:
    """Weights of the state good against bad, and of the four pairs of neighbouring states (bad 0, good 1)."""

    weights: np.ndarray
    pairs: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return with_neighbours((features - self.mean) / self.scale, counts)

    def marginals(self, inputs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability that each line is good, and expected numbers of pairs of states.

        All texts advance line by line together, the longest first, so that those with a next line are a prefix.
        """
        n = len(inputs)
        local = np.exp(np.clip(np.stack([np.zeros(n), inputs @ self.weights], axis=1), -30, 30))
        local /= local.sum(axis=1, keepdims=True)
        move = np.exp(self.pairs)
        first = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        order = order[: int((counts > 0).sum())]
        first, size = first[order], counts[order]
        active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
        forward, backward = np.zeros((n, 2)), np.ones((n, 2))
        for step, many in enumerate(active.tolist()):
            at = first[:many] + step
            value = local[at] if step == 0 else (forward[at - 1] @ move) * local[at]
            forward[at] = value / value.sum(axis=1, keepdims=True)
        pairs = np.zeros((2, 2))
        for step in range(len(active) - 1, 0, -1):
            at = first[: active[step]] + step
            ahead = local[at] * backward[at]
            joint = forward[at - 1][:, :, None] * move * ahead[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            value = ahead @ move.T
            backward[at - 1] = value / value.sum(axis=1, keepdims=True)
        both = forward * backward
        return both[:, 1] / both.sum(axis=1), pairs


def train(features: np.ndarray, counts: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> Chain:
    """Gradient ascent (Adam) on the conditional likelihood of the lines' states."""
    scale = features.std(axis=0)
    chain = Chain(np.zeros(3 * features.shape[1] + 1), np.zeros((2, 2)), features.mean(axis=0), np.where(scale > 1e-9, scale, 1.0))
    inputs, state, n = chain.inputs(features, counts), np.repeat(label, counts).astype(np.float64), max(len(features), 1)
    linked = np.maximum(counts - 1, 0)
    seen = np.zeros((2, 2))
    seen[0, 0], seen[1, 1] = linked[label == 0].sum(), linked[label == 1].sum()
    moment, spread = np.zeros(len(chain.weights) + 4), np.zeros(len(chain.weights) + 4)
    for turn in range(1, rounds + 1):
        good, pairs = chain.marginals(inputs, counts)
        slope = np.concatenate([inputs.T @ (state - good) / n - RIDGE * chain.weights, ((seen - pairs) / n - RIDGE * chain.pairs).ravel()])
        moment, spread = 0.9 * moment + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
        step = RATE * moment / (1 - 0.9**turn) / (np.sqrt(spread / (1 - 0.999**turn)) + 1e-8)
        chain.weights += step[:-4]
        chain.pairs += step[-4:].reshape(2, 2)
    return chain


@dataclass
class Model:
    chain: Chain
    platt: Platt
    rate: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated quality of each text, its lines with a word, and how many of them are more likely bad."""
        features, length, counts = line_features(data, offsets)
        raw, bad = self.raw(features, length, counts)
        return self.platt(raw), counts, bad

    def raw(self, features: np.ndarray, length: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(counts)
        good, _ = self.chain.marginals(self.chain.inputs(features, counts), counts)
        row = np.repeat(np.arange(n), counts)
        total = np.bincount(row, length, n)
        raw = np.where(total > 0, np.bincount(row, length * good, n) / np.maximum(total, 1), self.rate)
        return raw, np.bincount(row, good < 0.5, n).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, bad: int = BAD_EXAMPLES, good: int = GOOD_EXAMPLES) -> Model:
    """Learns from a bounded sample of labels outside the held-out fold; without both classes scores are the rate alone."""
    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, bad, good)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, "text"):
            features, length, counts = line_features(data, offsets)
            edge = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(edge * len(FEATURES), pa.int32()), pa.array(features.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.string()), batch.column("label"), flat, pa.ListArray.from_arrays(pa.array(edge), pa.array(length))],
                ["doc_id", "label", "features", "length"],
            )

    # At most bad + good rows with a few numbers per line.
    found = sample.rows.mapInArrow(listed, "doc_id string, label int, features array<double>, length array<double>").toArrow().sort_by("doc_id")
    label = found.column("label").to_numpy().astype(np.int64)
    counts = np.array([len(x) for x in found.column("length")], np.int64)
    flat = [found.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in ("features", "length")]
    features = flat[0].reshape(-1, len(FEATURES))
    if not counts.sum() or label.min() == label.max():
        width = len(FEATURES)
        chain = Chain(np.zeros(3 * width + 1), np.zeros((2, 2)), np.zeros(width), np.ones(width))
        return Model(chain, fit_platt(np.zeros(0), np.zeros(0, np.int64), sample.rate), sample.rate)
    model = Model(train(features, counts, label), Platt(1.0, 0.0), sample.rate)
    raw, _ = model.raw(features, flat[1], counts)
    worded = counts > 0
    model.platt = fit_platt(raw[worded], label[worded], sample.rate)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with quality (0 to 1), n_lines and n_bad_lines.

    Null and empty texts get the calibrated share of good labels. Columns of docs named like the new ones are replaced;
    all others, repeated rows and null ids stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["quality", "n_lines", "n_bad_lines"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, data, offsets in pieces(batches, "text"):
            new = [pa.array(x) for x in own.score(data, offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    kept = docs.drop(*names)
    extra = kept.limit(0).select("*", F.lit(0.0).alias("quality"), F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_bad_lines"))
    return kept.mapInArrow(run, extra.schema)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_lines and n_bad_lines."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("quality").alias("score"),
        F.when(F.col("quality") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "n_lines", "n_bad_lines",
    )
