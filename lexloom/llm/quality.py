"""Document quality by a linear-chain conditional random field over lines.

Every line of a document is labelled good or bad. The field scores a line's label by features
of the line itself and of the lines before and after it, and a pair of labels in a row by a
weight of its own. Forward and backward sums give each line's probability of being good; a
document's score is their mean, weighted by the lengths of the lines.

Only documents have labels: in training, each line has that of its document. Lines that good
and bad documents share therefore say little, and the chain lets their neighbours decide. A
logistic curve fitted to the training documents turns the mean into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.batches import map_columns, quoted, released, ship
from lexloom.sources import Staging

# At most so many labelled documents are used for training: those with the least hashed keys.
TRAINING_DOCUMENTS = 4000
# And at most so many of their lines.
TRAINING_LINES = 500_000
ROUNDS = 150
STEP = 0.1
NEWTON_ROUNDS = 30
PENALTY = 1e-3
# Documents whose lines are labelled together.
DOCUMENTS_AT_ONCE = 256
# Lines that these have when all are filled up to the longest; a longer document is alone.
CELLS_AT_ONCE = 1 << 20
# Lines from which a document alone is gone through in segments.
LONG_LINES = 20_000
# Code points read together when characters are counted.
TEXTS_AT_ONCE = 200

# Shares and sizes are put into slots with these edges; a slot is a feature.
SHARES = (0.001, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
EDGES = {
    "characters": (1, 10, 30, 80, 200, 500, 1500, 5000),
    "words": (1, 2, 5, 10, 30, 100, 300, 1000),
    "word_length": (2, 3, 4, 5, 6, 7, 9, 12),
    "letters": SHARES,
    "upper_letters": SHARES,
    "digits": SHARES,
    "symbols": SHARES,
    "words_ending_in_symbols": SHARES,
    "words_of_symbols": SHARES,
    "different_words": SHARES,
    "words_like_the_last": SHARES,
    "stopped": (0.5,),
}
SLOTS = max(len(edges) for edges in EDGES.values()) + 1
KINDS = len(EDGES)
# The line itself, the one before and the one after; a slot more where there is none.
WEIGHTS = 3 * KINDS * (SLOTS + 1)
LETTER, UPPER, DIGIT, SPACE, SYMBOL = 1, 2, 4, 8, 16


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Classes of each code point, as bits."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            table[code] = LETTER | UPPER * c.isupper()
        elif c.isdigit():
            table[code] = DIGIT
        elif c.isspace():
            table[code] = SPACE
        else:
            table[code] = SYMBOL
    return table


def _word_counts(line: str) -> tuple[int, int, int]:
    """Words, different words, and words like the one before."""
    words = line.split()
    return len(words), len(set(words)), sum(map(eq, words, words[1:]))


def _measure(lines: list[str]) -> np.ndarray:
    """The slot of each line in each of EDGES."""
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _classes()[codes]
    lengths = np.array([len(line) for line in lines], np.int64)
    stops = np.cumsum(lengths + 1)
    starts = stops - lengths - 1

    def count(found: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(found)))
        return total[stops] - total[starts]

    symbol, space = (kinds & SYMBOL) > 0, (kinds & SPACE) > 0
    before_space, after_space = np.append(space[1:], True), np.append(True, space[:-1])
    symbol_before = np.append(False, symbol[:-1])
    letters = count((kinds & LETTER) > 0)
    words, different, like_last = np.array([_word_counts(x) for x in lines], np.int64).T
    visible = lengths + 1 - count(space)
    per_word, per_visible = np.maximum(words, 1), np.maximum(visible, 1)
    values = {
        "characters": lengths,
        "words": words,
        "word_length": visible / per_word,
        "letters": letters / per_visible,
        "upper_letters": count((kinds & UPPER) > 0) / np.maximum(letters, 1),
        "digits": count((kinds & DIGIT) > 0) / per_visible,
        "symbols": count(symbol) / per_visible,
        "words_ending_in_symbols": count(symbol & before_space & symbol_before) / per_word,
        "words_of_symbols": count(symbol & before_space & after_space) / per_word,
        "different_words": different / per_word,
        "words_like_the_last": like_last / per_word,
        "stopped": np.array([x.rstrip()[-1:] in (".", "!", "?") for x in lines], float),
    }
    slots = [np.searchsorted(edges, values[name], "right") for name, edges in EDGES.items()]
    return np.stack(slots, axis=1).astype(np.uint8)


def line_slots(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slots, lengths) of the lines of each text; blank lines count as lines."""
    out = []
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        cut = [text.split("\n") for text in texts[at : at + TEXTS_AT_ONCE]]
        slots = _measure([line for lines in cut for line in lines])
        ends = np.cumsum([len(lines) for lines in cut])
        for lines, part in zip(cut, np.split(slots, ends[:-1])):
            out.append((part, np.array([len(line) for line in lines], np.float64)))
    return out


def _features(slots: np.ndarray) -> np.ndarray:
    """Numbers of the features of each line, its neighbours' among them."""
    none = np.full((1, KINDS), SLOTS, np.int64)
    around = np.concatenate((none, slots.astype(np.int64), none))
    joined = np.concatenate((around[1:-1], around[:-2], around[2:]), axis=1)
    return joined + np.arange(3 * KINDS) * (SLOTS + 1)


def _log_odds(means: np.ndarray) -> np.ndarray:
    means = np.clip(means, 1e-6, 1 - 1e-6)
    return np.log(means / (1 - means))


def _groups(sizes: list[int]) -> Iterator[slice]:
    """Slices of ascending sizes that are labelled together."""
    start = 0
    for stop, size in enumerate(sizes):
        n = stop - start
        if n and (n == DOCUMENTS_AT_ONCE or (n + 1) * size > CELLS_AT_ONCE):
            yield slice(start, stop)
            start = stop
    if start < len(sizes):
        yield slice(start, len(sizes))


def _joined_marginals(local: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The probability of good of each line of one very long document.

    `local` has a weight per line and label. The lines are cut into segments. The products of
    a segment's transfer matrices, worked out for all segments side by side, carry the forward
    and backward states from segment to segment; then all segments are gone through at once.
    """
    n = len(local)
    size = math.isqrt(n - 1) + 1
    segments = -(-n // size)
    moves = np.zeros((segments * size, 2, 2))
    moves[:n] = step * local[:, None, :]
    moves[0] = local[0]  # no label stands before the first line
    moves[n:] = np.eye(2)
    moves = moves.reshape(segments, size, 2, 2)
    whole = np.broadcast_to(np.eye(2), (segments, 2, 2))
    for at in range(size):
        whole = whole @ moves[:, at]
        whole = whole / whole.sum(axis=(1, 2), keepdims=True)
    ahead, behind = np.ones((segments + 1, 2)), np.ones((segments + 1, 2))
    for i in range(segments):
        ahead[i + 1] = ahead[i] @ whole[i]
        ahead[i + 1] /= ahead[i + 1].sum()
    for i in range(segments - 1, -1, -1):
        behind[i] = whole[i] @ behind[i + 1]
        behind[i] /= behind[i].sum()
    forward, backward = np.empty((2, segments, size, 2))
    now = ahead[:-1, None, :]
    for at in range(size):
        now = now @ moves[:, at]
        now = now / now.sum(axis=2, keepdims=True)
        forward[:, at] = now[:, 0]
    now = behind[1:, :, None]
    for at in range(size - 1, -1, -1):
        backward[:, at] = now[:, :, 0]
        now = moves[:, at] @ now
        now = now / now.sum(axis=1, keepdims=True)
    both = (forward * backward).reshape(-1, 2)[:n]
    return both[:, 1] / both.sum(axis=1)


class Field:
    """Weights of a line for being good, of label pairs (row: the label before), and of label 1.

    `slope` and `shift` belong to the curve from a document's mean to its score.
    """

    def __init__(self, weights: np.ndarray, pairs: np.ndarray, bias: float):
        self.weights, self.pairs, self.bias = weights, pairs, bias
        self.slope, self.shift = 1.0, 0.0

    @staticmethod
    def from_values(values: np.ndarray) -> Field:
        return Field(values[:WEIGHTS], values[WEIGHTS:-1].reshape(2, 2), float(values[-1]))

    def marginals(self, sizes: np.ndarray, features: np.ndarray):
        """Per line the probability of good, and the expected label pairs over all lines.

        `features` has the lines of documents of `sizes` lines one after another.
        """
        longest, n = int(sizes.max()), len(sizes)
        inside = np.arange(longest)[None, :] < sizes[:, None]
        scores = np.zeros((n, longest, 2))
        scores[..., 1][inside] = self.weights[features].sum(axis=1) + self.bias
        step = np.exp(self.pairs)
        local = np.exp(np.clip(scores - scores.max(axis=2, keepdims=True), -50, 0))
        forward = np.empty_like(local)
        backward = np.ones_like(local)
        now = local[:, 0]
        forward[:, 0] = now = now / now.sum(axis=1, keepdims=True)
        for t in range(1, longest):
            now = (now @ step) * local[:, t]
            forward[:, t] = now = now / now.sum(axis=1, keepdims=True)
        now = backward[:, -1]
        for t in range(longest - 2, -1, -1):
            now = (local[:, t + 1] * now) @ step.T
            now /= now.sum(axis=1, keepdims=True)
            # Behind its last line nothing speaks for either label.
            now = np.where(inside[:, t + 1, None], now, 1.0)
            backward[:, t] = now
        both = forward * backward
        good = both[..., 1] / both.sum(axis=2)
        pairs = forward[:, :-1, :, None] * step * (local * backward)[:, 1:, None, :]
        pairs /= pairs.sum(axis=(2, 3), keepdims=True)
        return good[inside], pairs[inside[:, 1:]].sum(axis=0)

    def long_marginals(self, slots: np.ndarray) -> np.ndarray:
        """`marginals` of one document of many lines, in bounded memory per line."""
        scores = np.zeros((len(slots), 2))
        for at in range(0, len(slots), LONG_LINES):
            # With the lines beside the stretch, whose own features are then left out.
            first, last = max(at - 1, 0), min(at + LONG_LINES + 1, len(slots))
            features = _features(slots[first:last])[at - first :][:LONG_LINES]
            scores[at : at + len(features), 1] = self.weights[features].sum(axis=1) + self.bias
        local = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -50, 0))
        return _joined_marginals(local, np.exp(self.pairs))

    def score(self, slots: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The probability that each document is good."""
        return 1.0 / (1.0 + np.exp(-self.slope * _log_odds(self.means(slots)) - self.shift))

    def calibrate(self, slots: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        """Fit the curve from means to labels, by Newton's method with a small penalty."""
        x = np.stack((_log_odds(self.means(slots)), np.ones(len(slots))), axis=1)
        curve = np.array([1.0, 0.0])
        for _ in range(NEWTON_ROUNDS):
            p = 1.0 / (1.0 + np.exp(-np.clip(x @ curve, -30, 30)))
            slope = x.T @ (p - labels) / len(labels) + PENALTY * curve
            bend = (x * (p * (1 - p))[:, None]).T @ x / len(labels) + PENALTY * np.eye(2)
            curve = curve - np.linalg.solve(bend, slope)
        self.slope, self.shift = float(max(curve[0], 0.0)), float(curve[1])

    def means(self, slots: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The length-weighted mean of the lines' probabilities of each document."""
        out = np.empty(len(slots))
        order = np.argsort([len(lengths) for _, lengths in slots], kind="stable")
        for group in _groups([len(slots[i][1]) for i in order]):
            chosen = order[group]
            sizes = np.array([len(slots[i][1]) for i in chosen])
            if len(sizes) == 1 and sizes[0] > LONG_LINES:
                good = self.long_marginals(slots[chosen[0]][0])
            else:
                features = np.concatenate([_features(slots[i][0]) for i in chosen])
                good, _ = self.marginals(sizes, features)
            # A blank line weighs something, so that a blank text has a score too.
            weights = np.concatenate([slots[i][1] for i in chosen]) + 1e-6
            starts = np.cumsum(sizes) - sizes
            total = np.add.reduceat(weights, starts)
            out[chosen] = np.add.reduceat(weights * good, starts) / total
        return np.clip(out, 0.0, 1.0)


def train(documents: list[tuple[np.ndarray, np.ndarray, int]]) -> Field:
    """The field fitted to (slots, lengths of lines, label) by penalised likelihood, with Adam.

    Without documents of both labels there is nothing to tell apart: the field then gives
    every line the one label's score, or 0.5 without any.
    """
    values = np.zeros(WEIGHTS + 5)
    labels = {label for *_, label in documents}
    if labels != {0, 1}:
        values[-1] = 10.0 * (2 * labels.pop() - 1) if labels else 0.0
        return Field.from_values(values)
    documents = sorted(documents, key=lambda d: len(d[0]))
    parts = []
    for group in _groups([len(slots) for slots, *_ in documents]):
        some = documents[group]
        sizes = np.array([len(slots) for slots, *_ in some])
        label = np.repeat([label for *_, label in some], sizes)
        follows = np.zeros((2, 2))
        for size, (*_, one) in zip(sizes, some):
            follows[one, one] += size - 1
        features = np.concatenate([_features(slots) for slots, *_ in some])
        parts.append((sizes, features, label, follows))
    lines = sum(len(label) for _, _, label, _ in parts)
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, ROUNDS + 1):
        field, gradient = Field.from_values(values), np.zeros_like(values)
        for sizes, features, label, follows in parts:
            good, pairs = field.marginals(sizes, features)
            error = label - good
            gradient[:WEIGHTS] += np.bincount(
                features.ravel(), np.repeat(error, features.shape[1]), WEIGHTS
            )
            gradient[WEIGHTS:-1] += (follows - pairs).ravel()
            gradient[-1] += error.sum()
        gradient = gradient / lines - PENALTY * values
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        shift = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        values = values + STEP * shift
    field = Field.from_values(values)
    field.calibrate([d[:2] for d in documents], np.array([d[2] for d in documents]))
    return field


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    text: str = "text",
    key: str = "doc_id",
    documents: int = TRAINING_DOCUMENTS,
    lines: int = TRAINING_LINES,
) -> Field:
    """The field trained on `documents` labelled documents and `lines` lines at most.

    Labels are 0 and 1; rows of `labels` with a null key or another label are left out, and of
    a key with both the label 0 counts. Documents are chosen by their hashed keys; of several
    texts with one key that with the least hash is taken. Documents that do not fit into the
    lines left are passed over. Only the chosen documents' features, twenty bytes a line, are
    brought to the driver, so neither a frequent key nor long texts can make them many.
    """
    ship(docs.sparkSession)
    marked = labels.select(F.col(quoted(key)).alias("key"), F.col(quoted(label)).alias("label"))
    marked = marked.filter("key IS NOT NULL AND label IN (0, 1)")
    marked = marked.groupBy("key").agg(F.min("label").alias("label"))
    own = docs.select(
        F.col(quoted(key)).alias("key"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text")
    )
    with Staging(docs.sparkSession) as staging:
        chosen = marked.orderBy(F.xxhash64("key"), "key").limit(documents)
        chosen = staging.write(chosen, "training-keys")
        # At most `documents` rows of two numbers are broadcast.
        found = own.join(F.broadcast(chosen), "key").groupBy("key", "label")
        least = F.struct(F.xxhash64("text"), F.length("text"))
        texts = found.agg(F.min_by("text", least).alias("text"))

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in released(batches):
                found = line_slots(batch.column("text").to_pylist()) if batch.num_rows else []
                columns = [batch.column("key"), batch.column("label")]
                columns.append(pa.array([len(pair[1]) for pair in found], pa.int64()))
                for i in (0, 1):
                    columns.append(pa.array([pair[i].tobytes() for pair in found], pa.binary()))
                names = ["key", "label", "n_lines", "slots", "lengths"]
                yield pa.RecordBatch.from_arrays(columns, names)

        kinds = dict(texts.dtypes)
        schema = f"key {kinds['key']}, label {kinds['label']}, n_lines bigint"
        schema += ", slots binary, lengths binary"
        measured = texts.select("key", "label", "text").mapInArrow(measure, schema)
        measured = staging.write(measured, "training-lines")
        taken, room = [], lines
        sizes = measured.select("key", "n_lines", F.xxhash64("key").alias("order")).collect()
        for row in sorted(sizes, key=lambda r: (r["order"], r["key"])):
            if row["n_lines"] <= room:
                taken.append((row["key"],))
                room -= row["n_lines"]
        taken = docs.sparkSession.createDataFrame(taken, f"key {kinds['key']}")
        rows = measured.join(F.broadcast(taken), "key").collect()
    rows.sort(key=lambda r: (r["key"], r["label"], bytes(r["slots"])))
    return train(
        [
            (
                np.frombuffer(r["slots"], np.uint8).reshape(-1, KINDS),
                np.frombuffer(r["lengths"], np.float64),
                int(r["label"]),
            )
            for r in rows
        ]
    )


def quality_scores(
    docs: DataFrame, field: Field, text: str = "text", keep: tuple = ("doc_id",)
) -> DataFrame:
    """`keep` and score (0 to 1, higher is better) of each row's whole text.

    A null text counts as empty; an empty text is one blank line. Repeated rows are each
    scored, very long texts as a whole; an empty table gives no rows. Other columns are not
    read.
    """

    def make():
        return lambda texts: (field.score(line_slots([t or "" for t in texts])).tolist(),)

    return map_columns(docs, make, [text], keep, "score double")
