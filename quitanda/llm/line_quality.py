"""Document quality from a linear-chain conditional random field over lines, good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm.tables import small_batches

UPPER, LOWER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
SYMBOLS, CALLS, STOPS = b"#*$%&|<>{}[]=+~^_\\/@", b"!?", b".,;:"
OWN = 15
DOCUMENT = 3
# Own features of a line, those of the line before and after it, the document's, both ends and a constant.
WIDTH = 3 * OWN + DOCUMENT + 3
GOOD_FROM = 0.7


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the fit. Labelled documents of more lines than ``lines`` are not fitted."""

    documents: int = 3000
    lines: int = 120
    steps: int = 150
    rate: float = 0.08
    decay: float = 1e-3


@dataclass(frozen=True)
class Model:
    """``emission`` weighs features for good against bad; ``step[i][j]`` is the score of state j after i."""

    emission: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))


def lines_of(text: str) -> list[bytes]:
    """The lines that have a word, or one empty line."""
    return [line for line in text.encode().split(b"\n") if line.strip()] or [b""]


def features(lines: list[bytes]) -> np.ndarray:
    """One row of WIDTH numbers per line."""
    own, seen, all_words = [], set(), []
    for line in lines:
        words, size = line.split(), max(len(line), 1)
        n, distinct = len(words), len(set(words))
        count = lambda chars: size - len(line.translate(None, chars)) if line else 0
        up, low = count(UPPER), count(LOWER)
        marks = count(SYMBOLS)
        own.append(
            (
                np.log1p(n) / 5,
                min(size / max(n, 1) / 10, 3),
                up / max(up + low, 1),
                1.0 if up > low else 0.0,
                count(DIGITS) / size,
                marks / size * 4,
                min(marks / max(n, 1), 3),
                min(count(CALLS) / max(n, 1), 3),
                min(count(STOPS) / max(n, 1), 3),
                min(line.count(b"|") / max(n, 1), 3),
                1 - distinct / n if n else 0.0,
                1.0 if line in seen else 0.0,
                1.0 if line.rstrip()[-1:] in (b".", b"!", b"?") else 0.0,
                1.0 if n < 3 else 0.0,
                1.0 if line[:1] in (b"-", b"*", b"#", b"|", b"<") else 0.0,
            )
        )
        seen.add(line)
        all_words += words
    own = np.array(own, np.float32)
    windows = list(zip(all_words, all_words[1:], all_words[2:]))
    whole = [
        np.log1p(len(all_words)) / 8,
        1 - len(set(windows)) / len(windows) if windows else 0.0,
        1 - len(seen) / len(lines),
    ]
    n = len(lines)
    result = np.zeros((n, WIDTH), np.float32)
    result[:, :OWN] = own
    result[1:, OWN : 2 * OWN] = own[:-1]
    result[:-1, 2 * OWN : 3 * OWN] = own[1:]
    result[:, 3 * OWN : 3 * OWN + DOCUMENT] = whole
    result[0, -3] = result[-1, -2] = result[:, -1] = 1
    return result


def marginals(scores: np.ndarray, step: np.ndarray) -> list[float]:
    """Per line the probability of being good, by forward and backward sums, rescaled at every line."""
    weight = np.exp(np.clip(scores, -30, 30)).tolist()
    (bb, bg), (gb, gg) = np.exp(step).tolist()
    bad, good, forward = 1.0, weight[0], []
    forward.append(good / (bad + good))
    for w in weight[1:]:
        good_before = forward[-1]
        bad = (1 - good_before) * bb + good_before * gb
        good = ((1 - good_before) * bg + good_before * gg) * w
        forward.append(good / (bad + good))
    result, after_bad, after_good = forward[:], 1.0, 1.0
    for i in range(len(weight) - 2, -1, -1):
        w = weight[i + 1]
        after_bad, after_good = bb * after_bad + bg * w * after_good, gb * after_bad + gg * w * after_good
        total = after_bad + after_good
        after_bad, after_good = after_bad / total, after_good / total
        good = forward[i] * after_good
        result[i] = good / (good + (1 - forward[i]) * after_bad)
    return result


def score(text: str, model: Model) -> float:
    """The lines' probabilities of being good, weighed by their lengths."""
    lines = lines_of(text)
    good = marginals(features(lines) @ model.emission, model.step)
    sizes = [max(len(line), 1) for line in lines]
    return min(1.0, max(0.0, sum(g * s for g, s in zip(good, sizes)) / sum(sizes)))


def _gradient(x: np.ndarray, mask: np.ndarray, y: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Observed less expected features and steps of padded documents, all lines of which are labelled y."""
    n, length, _ = x.shape
    scores = np.stack([np.zeros((n, length)), x @ model.emission], 2)
    step = model.step
    alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    alpha[:, 0] = scores[:, 0]
    for i in range(1, length):
        new = np.logaddexp.reduce(alpha[:, i - 1, :, None] + step[None], 1) + scores[:, i]
        alpha[:, i] = np.where(mask[:, i, None], new, alpha[:, i - 1])
    for i in range(length - 2, -1, -1):
        new = np.logaddexp.reduce(step[None] + (scores[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
        beta[:, i] = np.where(mask[:, i + 1, None], new, 0.0)
    whole = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    good = np.where(mask, np.exp(alpha[:, :, 1] + beta[:, :, 1] - whole[:, None]), 0.0)
    emission = np.einsum("nl,nlf->f", np.where(mask, y[:, None], 0.0) - good, x)
    pair_mask = mask[:, 1:]
    pairs = np.exp(
        alpha[:, :-1, :, None] + step[None, None] + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - whole[:, None, None, None]
    )
    steps = -np.where(pair_mask[:, :, None, None], pairs, 0.0).sum((0, 1))
    for state in (0, 1):
        steps[state, state] += pair_mask[y == state].sum()
    return emission, steps


def fit(documents: list[tuple[np.ndarray, int]], settings: Fit = Fit()) -> Model:
    """A model for documents given as line features and label; without both labels, one that scores 0.5."""
    if len({y for _, y in documents}) < 2:
        return Model()
    documents = sorted(documents, key=lambda d: len(d[0]))
    batches = []
    for at in range(0, len(documents), 250):
        some = documents[at : at + 250]
        length = len(some[-1][0])
        x, mask = np.zeros((len(some), length, WIDTH), np.float32), np.zeros((len(some), length), bool)
        for i, (rows, _) in enumerate(some):
            x[i, : len(rows)], mask[i, : len(rows)] = rows, True
        batches.append((x, mask, np.array([y for _, y in some])))
    total = sum(len(rows) for rows, _ in documents)
    weights, first, second = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for t in range(1, settings.steps + 1):
        model = Model(weights[:WIDTH], weights[WIDTH:].reshape(2, 2))
        gradient = -settings.decay * weights
        for batch in batches:
            emission, steps = _gradient(*batch, model)
            gradient += np.concatenate([emission, steps.ravel()]) / total
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weights = weights + settings.rate * first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Model(weights[:WIDTH], weights[WIDTH:].reshape(2, 2))


def held_out(key: str) -> Column:
    """Rows no model may learn from: remainder 2 of the crc32 of the key as text, modulo 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def learned(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", settings: Fit = Fit()
) -> Model:
    """A model of the labelled rows that are not held out, at most ``settings.documents`` of them, drawn by hash.

    Their ids, and then their features, are bounded by the settings; only these reach the driver.
    Rows without key or label are left out.
    """
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
    drawn = (
        usable.groupBy(F.col(key).alias("_id"))
        .agg(F.max(label).alias("_y"))
        .orderBy(F.xxhash64(F.col("_id").cast("string")), "_id")
        .limit(settings.documents)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(y, lines_of(t or "")) for y, t in zip(*(c.to_pylist() for c in batch.columns))]
            kept = [(y, lines) for y, lines in kept if len(lines) <= settings.lines]
            arrays = [
                pa.array([y for y, _ in kept], pa.int32()),
                pa.array([features(lines).tobytes() for _, lines in kept], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["y", "x"])

    joined = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(
        F.broadcast(drawn), F.col("_key") == F.col("_id")
    )
    rows = small_batches(joined).select(F.col("_y").cast("int"), "_text").mapInArrow(extract, "y int, x binary")
    rows = rows.orderBy(F.xxhash64("x")).limit(2 * settings.documents).collect()
    return fit([(np.frombuffer(r.x, np.float32).reshape(-1, WIDTH), r.y) for r in rows], settings)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, score (0 to 1) and predicted (1 from 0.7).

    Only the text's lines enter the score. A NULL or empty text is one empty line; repeated rows
    score alike; extra columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """

    def score_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score(t.as_py() or "", model) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["_key", "held_out", "score"]
            )

    rows = docs.select(F.col(key).alias("_key"), held_out(key).alias("held_out"), F.col(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    result = small_batches(rows).mapInArrow(score_all, f"_key {kind}, held_out boolean, score double")
    predicted = F.when(F.col("score") >= GOOD_FROM, 1).otherwise(0)
    return result.select(F.col("_key").alias(key), "held_out", "score", predicted.alias("predicted"))
