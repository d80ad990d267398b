"""Quality scores by Bradley-Terry ranking of labelled pairs.

A document is a vector of text statistics (repetition, symbols, case, lengths,
each also squared).  Every pair of a good and a bad labelled document is a
contest that the good one should win: P(win) = sigmoid(strength difference),
strength = w . features, and w minimises the logistic loss on the feature
differences (Newton steps, ridge penalty).  All documents are scored, and the
threshold is the quantile of all scores at the labelled share of bad ones;
the strength is mapped to (0, 1) so that this quantile stands at `cutoff`.

Rules
- null counts as the empty text, which is a document like any other (all
  statistics 0); rows are scored one by one, so repeated rows score alike.
- without both labels in the sample all weights are 0 and every score is the
  cutoff; an empty table gives no rows.
- at most `sample_rows` labelled rows are collected, as feature vectors; each
  bad one meets `PAIRS` good ones in a fixed rotation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.llm import words as W
from measures.llm.common import cut_lineage, ship_package, text_buffer, text_chunks
from measures.llm.labelled import is_held_out, learning_sample

SAMPLE_ROWS = 16_000
PAIRS = 24
RIDGE = 1e-3
CUTOFF = 0.3
FEATURES = ("log_words", "word_length", "distinct_share", "adjacent_repeats", "top_word_share",
            "symbol_share", "upper_share", "digit_share", "line_share", "short_word_share",
            "symbol_ended_words", "capital_words", "bang_share", "lag2_repeats",
            "bytes_per_line", "non_ascii_share")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_ALNUM = W.ALNUM.is_word
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(33, 127) if not _ALNUM[b] and chr(b) not in ".,"]] = True


def features(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per text."""
    n_docs = len(offsets) - 1
    starts, ends, hashes, first = W.find_words(buf, offsets, W.SPACED)
    n_words = np.diff(first)
    n_bytes = np.diff(offsets)
    doc = np.repeat(np.arange(n_docs), n_words)

    def per_doc(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(flags)])
        return (run[edges[1:]] - run[edges[:-1]]).astype(np.float64)

    words = np.maximum(n_words, 1)
    size = np.maximum(n_bytes, 1)
    length = ends - starts
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    lag2 = np.zeros(len(hashes), bool)
    lag2[2:] = (hashes[2:] == hashes[:-2]) & (doc[2:] == doc[:-2])
    distinct, top = np.zeros(n_docs), np.zeros(n_docs)
    for d in np.flatnonzero(n_words).tolist():
        own = np.sort(hashes[first[d]:first[d + 1]])
        cuts = np.flatnonzero(np.diff(own, prepend=own[0] ^ np.uint64(1)))
        distinct[d] = len(cuts)
        top[d] = np.max(np.diff(np.append(cuts, len(own))))
    last = buf[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    head = buf[starts] if len(starts) else np.zeros(0, np.uint8)
    lines = per_doc(buf == 10, offsets)
    base = np.stack([
        np.log1p(n_words), per_doc(length, first) / words, distinct / words,
        per_doc(same, first) / words, top / words,
        per_doc(_SYMBOL[buf], offsets) / size, per_doc(_UPPER[buf], offsets) / size,
        per_doc(_DIGIT[buf], offsets) / size, lines / words,
        per_doc(length <= 2, first) / words, per_doc(_SYMBOL[last], first) / words,
        per_doc(_UPPER[head], first) / words, per_doc(buf == 33, offsets) / size,
        per_doc(lag2, first) / words, np.log1p(n_bytes / (lines + 1)),
        per_doc(buf >= 128, offsets) / size], axis=1)
    return base


def expand(base: np.ndarray) -> np.ndarray:
    """Each statistic, its square root and its square."""
    return np.concatenate([base, np.sqrt(base), base * base], axis=1)


def feature_rows(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("_text")):
                part = batch.slice(a, b - a)
                x = features(*text_buffer(part.column("_text")))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
                yield pa.record_batch([*part.columns[:-1], flat.cast(pa.list_(pa.float64()))],
                                      names=[*part.schema.names[:-1], "x"])

    return rows.mapInArrow(run, fields + ", x array<double>")


class BradleyTerry:
    """Strengths from pairs: logistic loss on feature differences."""

    def __init__(self, x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE):
        n_features = expand(np.zeros((1, len(FEATURES)))).shape[1]
        self.mean, self.scale = np.zeros(n_features), np.ones(n_features)
        self.w = np.zeros(n_features)
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        if not len(good) or not len(bad):
            return
        z = expand(x)
        self.mean = z.mean(axis=0)
        self.scale = np.maximum(z.std(axis=0), 1e-9)
        z = (z - self.mean) / self.scale
        turn = np.arange(len(bad) * pairs)
        # A stride without a common factor walks over all the good rows.
        stride = next(s for s in range(7919, 7919 + len(good) + 2) if math.gcd(s, len(good)) == 1)
        diff = z[good[(turn * stride) % len(good)]] - z[bad[turn % len(bad)]]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(diff @ self.w, -30, 30)))
            grad = diff.T @ (p - 1) / len(diff) + ridge * self.w
            hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) \
                + ridge * np.eye(n_features)
            step = np.linalg.solve(hess, grad)
            self.w -= step
            if np.max(np.abs(step)) < 1e-6:
                break

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((expand(x) - self.mean) / self.scale) @ self.w


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        sample_rows: int = SAMPLE_ROWS) -> tuple[BradleyTerry, float]:
    """The model, and the share of bad documents among all learning labels."""
    ship_package(docs.sparkSession)
    sample = learning_sample(docs, labels, label, sample_rows)
    rows = feature_rows(sample, ["doc_id", "y"], "text").orderBy("doc_id").collect()
    share = labels.where(~is_held_out(F.col("doc_id"))).agg(
        F.avg((F.col(label) == 0).cast("double"))).first()[0]
    x = np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES))
    return BradleyTerry(x, np.array([r.y for r in rows])), share or 0.0


def score(docs: DataFrame, model: BradleyTerry, bad_share: float, cutoff: float = CUTOFF,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, strength, score in (0, 1); the score is at least `cutoff`
    for all but the lowest `bad_share` of all documents."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                part = batch.slice(a, b - a)
                s = model.strength(features(*text_buffer(part.column("text"))))
                yield pa.record_batch([part.column("id"), pa.array(s)], names=["id", "strength"])

    kind = rows.schema["id"].dataType.simpleString()
    strengths = cut_lineage(rows.mapInArrow(run, f"id {kind}, strength double"))
    at = strengths.agg(F.percentile_approx("strength", float(bad_share), 100_000)).first()[0] or 0.0
    if bad_share:  # what stands at the quantile, ties included, is below the threshold
        above = strengths.where(F.col("strength") > at).agg(F.min("strength")).first()[0]
        at = at if above is None else (at + above) / 2
    shift = math.log(cutoff / (1 - cutoff))
    return strengths.withColumn(
        "score", 1 / (1 + F.exp(-(F.col("strength") - F.lit(at) + F.lit(shift)))))
