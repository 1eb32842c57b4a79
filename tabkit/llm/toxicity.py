"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence's chance p is logistic in the features of its words, and a document's chance is the noisy-or of its sentences,
1 - product of (1 - p). Only documents carry labels; the gradient of the document's likelihood shares the blame out among the
sentences, so the trained weights also tell which sentences offend. Features are hashes of the lower-case words and of their
first 3 to 6 and last 4 to 6 bytes, which reach inflected and unseen forms; of these the ``FEATURES`` that occur in toxic
documents most above their rate elsewhere are kept.

Training reads a sample of about ``MOST_LABELLED`` labelled documents (a documented bound); Spark counts the features, and the
driver gets, for the sample, the chosen features of each sentence. Scoring is one pass over all documents without a shuffle.

Cases: a text without a word (NULL, empty) has score 0; repeated rows get equal scores; NULL ids are kept and never held out;
without a toxic labelled document all scores are close to 0; an empty table gives an empty result; extra input columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.labelled import remainder, training_rows
from tabkit.llm.text import WORD, slices, span_hashes, text_bytes, words_of

MOST_LABELLED = 20_000
FOLDS, HELD_OUT = 5, 0
TOXIC_FROM = 0.5
SENTENCE_FROM = 0.2  # a sentence with that chance is reported; of a toxic document without one the likeliest
FEATURES = 4_000
LEAST_TOXIC_DOCUMENTS = 2
STEPS, RATE, DECAY = 500, 0.1, 1e-5
_PARTS = (("word", 0), ("first", 3), ("first", 4), ("first", 5), ("first", 6), ("last", 4), ("last", 5), ("last", 6))
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    """Feature hashes in ascending order, their weights, and the bias of a sentence."""
    features: np.ndarray
    weights: np.ndarray
    bias: float


def word_features(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes by kind, sentence number of every word, text of every word, bytes, word starts); sentences count on over all texts."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    starts, ends, first = words_of(data, offsets, WORD)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    ended = np.concatenate([[0], np.cumsum(_ENDS[data])])[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (ended[1:] != ended[:-1]) | (owner[1:] != owner[:-1])
    kinds = []
    for n, (kind, size) in enumerate(_PARTS):
        a, b = starts, ends
        if kind == "first":
            b = np.minimum(ends, starts + size)
        elif kind == "last":
            a = np.maximum(starts, ends - size)
        kinds.append((a, b, np.uint64((n + 1) * 0x9E3779B97F4A7C15 % 2**64)))
    # one pass over the bytes for all kinds
    hashes = span_hashes(data, np.concatenate([k[0] for k in kinds]), np.concatenate([k[1] for k in kinds])).reshape(len(kinds), -1)
    return [h ^ k[2] for h, k in zip(hashes, kinds)], np.cumsum(new) - 1, owner, data, starts


def chances(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def train(sentences: np.ndarray, hits: np.ndarray, hit_sentence: np.ndarray, sentence_text: np.ndarray, plain: np.ndarray, labels: np.ndarray,
          features: int) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps on the noisy-or likelihood.

    ``sentences``: number of sentences with a feature; ``hits``: feature of each occurrence; ``plain``: sentences without a
    feature of each text.
    """
    weights, bias = np.zeros(features), -6.0
    if not len(labels):
        return weights, bias
    moments = np.zeros((2, features + 1))
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(hit_sentence, weights=weights[hits], minlength=int(sentences))
        total = np.bincount(sentence_text, weights=softplus(z), minlength=len(labels)) + plain * softplus(np.array(bias))
        total = np.maximum(total, 1e-9)
        # d loss / d total: 1 for a clean text, -1 / (e^total - 1) for a toxic one
        slope = np.where(labels == 1, -1 / np.expm1(np.minimum(total, 50)), 1.0)
        by_sentence = slope[sentence_text] * chances(z)
        grad = np.append(np.bincount(hits, weights=by_sentence[hit_sentence], minlength=features),
                         by_sentence.sum() + (slope * plain).sum() * chances(np.array(bias))) / len(labels)
        grad[:-1] += DECAY * weights
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad ** 2
        move = RATE * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.99 ** step)) + 1e-8)
        weights, bias = np.maximum(weights - move[:-1], 0), min(bias - move[-1], -3.0)
    return weights, float(bias)


def _found(model_features: np.ndarray, kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) of every occurrence of a chosen feature."""
    small = np.zeros(1 << 16, bool)
    small[(model_features >> np.uint64(48)).astype(np.int64)] = True
    words, features = [], []
    for h in kinds:
        maybe = np.flatnonzero(small[(h >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(model_features, h[maybe]), max(len(model_features) - 1, 0))
        real = model_features[at] == h[maybe] if len(model_features) else np.zeros(len(maybe), bool)
        words.append(maybe[real])
        features.append(at[real])
    return np.concatenate(words), np.concatenate(features)


def choose_features(rows: DataFrame, most: int = FEATURES) -> np.ndarray:
    """The hashes that occur in toxic documents most above their rate in others; documents are counted, once each."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                kinds, _, owner, _, _ = word_features(part.column(1))
                label = part.column(0).to_numpy()
                both = np.concatenate(kinds) if kinds else np.zeros(0, np.uint64)
                text = np.tile(owner, len(kinds))
                order = np.lexsort((both, text))
                new = np.ones(len(order), bool)
                new[1:] = (both[order][1:] != both[order][:-1]) | (text[order][1:] != text[order][:-1])
                names, at = np.unique(both[order][new], return_inverse=True)
                toxic = np.bincount(at, weights=label[text[order][new]] == 1, minlength=len(names))
                yield pa.record_batch([pa.array(names.view(np.int64)), pa.array(toxic.astype(np.int64)),
                                       pa.array((np.bincount(at, minlength=len(names)) - toxic).astype(np.int64))], ["f", "toxic", "clean"])

    totals = rows.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = float(totals.toxic or 0), float(totals.n - (totals.toxic or 0))
    counted = rows.mapInArrow(task, "f bigint, toxic bigint, clean bigint").groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = (F.col("toxic") + 0.5) / F.lit(toxic + 1) / ((F.col("clean") + 0.5) / F.lit(clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = (counted.where(F.col("toxic") >= LEAST_TOXIC_DOCUMENTS).withColumn("z", F.ln(odds) / error).where("z > 1.0")
            .orderBy(F.desc("z"), "f").limit(most).select("f").collect())
    return np.sort(np.array([r.f for r in best], np.int64).view(np.uint64))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> Model:
    """The model trained on labelled documents outside the held-out fold."""
    rows = training_rows(df, labels, "toxic", most, FOLDS, HELD_OUT, id_col, text_col)
    features = choose_features(rows)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                kinds, sentence, owner, _, _ = word_features(part.column(1))
                word, feature = _found(features, kinds)
                first = np.searchsorted(owner, np.arange(part.num_rows + 1))
                total = [len(np.unique(sentence[a:b])) for a, b in zip(first[:-1], first[1:])]
                pairs = np.unique(np.stack([owner[word], sentence[word], feature], 1), axis=0) if len(word) else np.zeros((0, 3), np.int64)
                ends = np.searchsorted(pairs[:, 0], np.arange(part.num_rows + 1))
                packed = [pairs[a:b, 1:].astype("<i4").tobytes() for a, b in zip(ends[:-1], ends[1:])]
                yield pa.record_batch([part.column(0), pa.array(total, pa.int64()), pa.array(packed, pa.binary())], ["label", "total", "pairs"])

    got = sorted(rows.mapInArrow(task, "label int, total bigint, pairs binary").collect(), key=lambda r: (r.label, r.total, bytes(r.pairs)))
    hits, hit_sentence, sentence_text, plain = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], np.zeros(len(got))
    known = 0
    for i, r in enumerate(got):
        pairs = np.frombuffer(r.pairs, "<i4").reshape(-1, 2).astype(np.int64)
        names, at = np.unique(pairs[:, 0], return_inverse=True)
        hits.append(pairs[:, 1])
        hit_sentence.append(at + known)
        sentence_text += [i] * len(names)
        known += len(names)
        plain[i] = r.total - len(names)
    weights, bias = train(known, np.concatenate(hits), np.concatenate(hit_sentence), np.array(sentence_text, np.int64), plain,
                          np.array([r.label for r in got], int), len(features))
    return Model(features, weights, bias)


def score_texts(model: Model, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores of the texts, and their offending sentences (start, end in code points, score)."""
    kinds, sentence, owner, data, starts = word_features(texts)
    if not len(sentence):
        return np.zeros(len(texts)), [[] for _ in range(len(texts))]
    word, feature = _found(model.features, kinds)
    once = np.unique(np.stack([sentence[word], feature], 1), axis=0) if len(word) else np.zeros((0, 2), np.int64)
    z = model.bias + np.bincount(once[:, 0], weights=model.weights[once[:, 1]] if len(once) else None, minlength=int(sentence[-1]) + 1)
    first = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]]))
    of = owner[first]
    score = -np.expm1(-np.bincount(of, weights=softplus(z), minlength=len(texts)))
    spans: list[list[dict]] = [[] for _ in range(len(texts))]
    found = chances(z) >= SENTENCE_FROM
    # many unlikely sentences: the likeliest ones that make up half of the noisy-or's exponent
    for i in np.setdiff1d(np.flatnonzero(score >= TOXIC_FROM), of[found]):
        own = np.flatnonzero(of == i)
        own = own[np.argsort(-z[own], kind="stable")]
        share = np.cumsum(softplus(z[own]))
        found[own[:1 + int(np.searchsorted(share, share[-1] / 2))]] = True
    offending = np.flatnonzero(found)
    if len(offending):
        _, offsets = text_bytes(pc.utf8_lower(texts))
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        stops = np.append(starts[first][1:], len(data))
        for s in offending:
            i = int(of[s])
            begin, end = int(starts[first[s]]), int(min(stops[s], offsets[i + 1]))
            spans[i].append({"start": int(points[begin] - points[offsets[i]]), "end": int(points[end] - points[offsets[i]]), "score": float(chances(z[s:s + 1])[0])})
    return np.clip(score, 0, 1), spans


def score_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED) -> DataFrame:
    """One row per input row: the id, held_out, score (0 to 1), predicted (1 if the score is ``TOXIC_FROM`` or more) and
    sentences, the offending ones: array of (start, end, score), from a sentence's first word to before the next one's, in code
    points of the lower-case text."""
    model = fit(df, labels, id_col, text_col, most)
    kind = df.schema[id_col].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score, found = score_texts(model, part.column(1))
                yield pa.record_batch([part.column(0), pa.array(score), pa.array(found, spans)], ["id", "score", "sentences"])

    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    scored = docs.mapInArrow(task, f"id {kind}, score double, sentences array<struct<start:bigint,end:bigint,score:double>>")
    return scored.select(F.col("id").alias(id_col), (remainder(F.col("id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "sentences")
