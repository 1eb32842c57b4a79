"""Quality classifier: a linear-chain conditional random field that labels every line of a document good or bad.

A line is described by numbers of its own and of the lines before and after it: symbols, marks, capitals and digits for
each word or letter, repeated words, word length, words, repeats of earlier lines. The field has one weight for each number
and one for each pair of neighbouring labels. Forward and backward sums give each line's chance to be good, and the mean of
these, weighted by the lines' characters, is the document's score. It is trained on documents whose lines all carry the
document's label, by gradient steps on the conditional likelihood.

Training reads a sample of about ``MOST_LABELLED`` labelled documents (a documented bound), of which the driver gets the lines'
numbers; scoring is one pass over all documents without a shuffle. Whole texts count; a long text is handled on its own.

Cases: a text without a word (NULL, empty, white space) has score 0; repeated rows get equal scores; NULL ids are kept and never
held out; without any labelled document, or with labels of one kind, the field keeps neutral weights and scores 0.5; an empty
table gives an empty result; extra input columns are ignored by ``score_quality`` and kept, whatever their names, by
``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.labelled import remainder, training_rows
from tabkit.llm.text import SPACE, runs, slices, span_hashes, text_bytes

MOST_LABELLED = 4_000
FOLDS, HELD_OUT = 4, 2
LEAST_SCORE = 0.7
STEPS, RATE, DECAY = 150, 0.2, 1e-3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def line_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of every line with a word, with a 1 in front; the line's characters; offsets of the texts in the lines)."""
    data, offsets = text_bytes(texts)
    starts, ends = runs(~SPACE[data], offsets)
    if not len(starts):
        return np.zeros((0, 1 + 3 * _OWN)), np.zeros(0), np.zeros(len(texts) + 1, np.int64)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    feeds = np.concatenate([[0], np.cumsum(data == 10)])[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (feeds[1:] != feeds[:-1])
    first = np.flatnonzero(new)
    line = np.cumsum(new) - 1
    begin, end, text = starts[first], ends[np.append(first[1:], len(starts)) - 1], owner[first]
    of = np.searchsorted(text, np.arange(len(texts) + 1))
    words = np.bincount(line).astype(float)

    def share(member: np.ndarray, by: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(member)])
        return np.minimum((sums[end] - sums[begin]) / np.maximum(by, 1), 1)

    follows = np.zeros(len(data), bool)
    follows[1:] = data[:-1] == 0xC3
    upper = (data >= 65) & (data <= 90) | follows & (data >= 0x80) & (data <= 0x9E)
    lower = (data >= 97) & (data <= 122) | follows & (data >= 0x9F) & (data <= 0xBF)
    letters = upper | lower
    sums = np.concatenate([[0], np.cumsum(letters)])
    n_letters = sums[end] - sums[begin]
    hashes = span_hashes(data, starts, ends)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & ~new[1:]
    order = np.lexsort((hashes, line))
    known = np.zeros(len(starts), bool)
    known[1:] = (line[order][1:] == line[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    repeats = np.bincount(line[order], weights=known) / words
    whole = span_hashes(data, begin, end)
    order = np.lexsort((np.arange(len(whole)), whole, text))
    again = np.zeros(len(whole))
    again[order[1:]] = (whole[order][1:] == whole[order][:-1]) & (text[order][1:] == text[order][:-1])
    length = (end - begin).astype(float)
    trust = np.minimum(words / 20, 1)  # repeats say little in a short line
    values = [share(_SYMBOL[data], words), share(data == ord("|"), words), share(data == ord("!"), words), share(upper, n_letters),
              share((data >= 48) & (data <= 57), length), np.bincount(line, weights=same) / words * trust, repeats * trust,
              np.minimum(np.bincount(line, weights=ends - starts) / words / 12, 1),
              np.minimum(np.log1p(words) / 6, 1), again, share(~(letters | SPACE[data]), length)]
    values += [values[i] > 0.15 for i in (0, 1, 2, 3, 5, 6)]
    own = np.stack(values, 1).astype(float)
    around = np.zeros((len(own), 2, own.shape[1]))
    near = text[1:] == text[:-1]
    around[1:, 0][near], around[:-1, 1][near] = own[:-1][near], own[1:][near]
    return np.concatenate([np.ones((len(own), 1)), own, around.reshape(len(own), -1)], 1), length, of


_OWN = 17


@dataclass
class Field:
    """Weights of the line numbers for the label good, and of the label pairs [before, after]; 0 is bad, 1 is good."""
    weights: np.ndarray
    pairs: np.ndarray


def forward_backward(field: Field, numbers: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chance of good of every line, chances of every label pair with the line before, log of each text's total), all texts side by side."""
    unary = np.stack([np.zeros(len(numbers)), numbers @ field.weights], 1)
    counts = np.diff(of)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    first, sizes = of[order], counts[order]
    alpha, beta = unary.copy(), np.zeros_like(unary)

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        most = x.max(axis, keepdims=True)
        return np.log(np.exp(x - most).sum(axis)) + most.squeeze(axis)

    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest + 1), side="left")  # texts with more lines than the step
    for t in range(1, longest):
        at = first[:alive[t]] + t
        alpha[at] = unary[at] + total(alpha[at - 1][:, :, None] + field.pairs, 1)
    for t in range(longest - 2, -1, -1):
        at = first[:alive[t + 1]] + t
        beta[at] = total(field.pairs + (unary[at + 1] + beta[at + 1])[:, None, :], 2)
    logs = np.zeros(len(counts))
    logs[order] = total(alpha[first + sizes - 1], 1)
    per_line = np.repeat(logs, counts)
    chance = np.exp(alpha[:, 1] + beta[:, 1] - per_line)
    inner = np.ones(len(numbers), bool)
    inner[of[:-1][counts > 0]] = False
    at = np.flatnonzero(inner)
    joint = np.exp(alpha[at - 1][:, :, None] + field.pairs + (unary[at] + beta[at])[:, None, :] - per_line[at][:, None, None])
    return chance, joint, logs


def train(numbers: np.ndarray, of: np.ndarray, labels: np.ndarray) -> Field:
    """Most likely weights for texts all of whose lines carry the text's label."""
    field = Field(np.zeros(numbers.shape[1]), np.zeros((2, 2)))
    if len(numbers) == 0 or len(np.unique(labels)) < 2:
        return field
    counts = np.diff(of)
    line = np.repeat(labels, counts).astype(float)
    texts = max(1, int((counts > 0).sum()))
    # every text weighs the same, whatever its number of lines
    weight = np.repeat(1 / np.maximum(counts, 1), counts)
    inner = np.ones(len(numbers), bool)
    inner[of[:-1][counts > 0]] = False
    pair_weight = weight[inner]
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = pair_weight[line[inner] == label].sum()
    moments = [np.zeros(numbers.shape[1]), np.zeros(numbers.shape[1]), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, STEPS + 1):
        chance, joint, _ = forward_backward(field, numbers, of)
        slopes = (numbers.T @ ((line - chance) * weight) / texts - DECAY * field.weights,
                  (seen - (joint * pair_weight[:, None, None]).sum(0)) / texts - DECAY * field.pairs)
        for i, (values, slope) in enumerate(zip((field.weights, field.pairs), slopes)):
            moments[2 * i] = 0.9 * moments[2 * i] + 0.1 * slope
            moments[2 * i + 1] = 0.99 * moments[2 * i + 1] + 0.01 * slope ** 2
            values += RATE * (moments[2 * i] / (1 - 0.9 ** step)) / (np.sqrt(moments[2 * i + 1] / (1 - 0.99 ** step)) + 1e-8)
    return field


def scores(field: Field, texts: pa.Array) -> np.ndarray:
    """Mean chance of good of each text's lines, weighted by their characters; 0 without a word."""
    numbers, length, of = line_numbers(texts)
    chance, _, _ = forward_backward(field, numbers, of)
    sums, weights = np.concatenate([[0], np.cumsum(chance * length)]), np.concatenate([[0], np.cumsum(length)])
    return np.clip((sums[of[1:]] - sums[of[:-1]]) / np.maximum(weights[of[1:]] - weights[of[:-1]], 1), 0, 1)


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> Field:
    """The field trained on labelled documents outside the held-out fold."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                numbers, _, of = line_numbers(part.column(1))
                rows = [numbers[a:b].astype("<f4").tobytes() for a, b in zip(of[:-1], of[1:])]
                yield pa.record_batch([part.column(0), pa.array(rows, pa.binary())], ["label", "numbers"])

    rows = training_rows(df, labels, "quality", most, FOLDS, HELD_OUT, id_col, text_col).mapInArrow(task, "label int, numbers binary")
    got = sorted(rows.collect(), key=lambda r: (r.label, bytes(r.numbers)))  # the same sums in the same order on every run
    each = [np.frombuffer(r.numbers, "<f4").reshape(-1, 1 + 3 * _OWN).astype(float) for r in got]
    of = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
    return train(np.concatenate([np.zeros((0, 1 + 3 * _OWN)), *each]), of, np.array([r.label for r in got], int))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> DataFrame:
    """One row per input row: the id, held_out, score (0 to 1) and predicted (1 if the score is ``LEAST_SCORE`` or more)."""
    field = fit(df, labels, id_col, text_col, most)
    kind = df.schema[id_col].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.record_batch([part.column(0), pa.array(scores(field, part.column(1)))], ["id", "score"])

    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    scored = docs.mapInArrow(task, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), (remainder(F.col("id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> DataFrame:
    """The input without the documents whose score is below ``LEAST_SCORE``."""
    field, names, place = fit(df, labels, id_col, text_col, most), df.columns, df.columns.index(text_col)
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, f"c{place}"):
                yield part.filter(pa.array(scores(field, part.column(place)) >= LEAST_SCORE))

    return plain.mapInArrow(task, plain.schema).toDF(*names)
