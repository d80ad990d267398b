"""Toxicity by the nearest labelled examples.

Documents and examples are unit TF-IDF vectors over all words of their whole
texts.  Terms that lean toxic in a bounded learning sample (likelihood-ratio
test, at a level where less than one of all terms tested would pass by chance)
weigh `emphasis` times as much; among these are also the first 4, 5 and 6 bytes
of longer words, and words met "at least 2 / 3 / 4 / 6 times".  The examples, of
both labels, stand in an inverted index.  A document adds up the postings of
its terms, but for the common ones, those of more than a quarter of the
examples: over these, no example can add more than the product of both norms.
Only the examples that could still reach the k-th neighbour found have their
common terms added too: the k nearest are exact.

The score is the neighbours' vote, each weighted by its squared cosine (so by
closeness), with a prior weight at the base rate of the labels: far neighbours
alone move it little, and a document that shares no term with any example
scores the base rate.

Rules
- null or empty text scores the base rate; without labels every score is 0.
- words that no example holds are left out of a document's vector.
- ties between neighbours go to the smaller example id; rows are scored one
  by one, so repeated rows score alike; an empty table gives no rows.
- very long texts are scored whole; examples are the labelled rows with the
  smallest hashes of their ids, at most `sample_rows` of them, of at most
  `sample_bytes` of text together and a 32nd of that each.  That bounds all
  that is collected or broadcast.
- columns other than the id, the text and `keep` are not read, so extra
  columns may have any name; `keep` may not name `score` or `evidence`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.llm import words as W
from measures.llm.common import cut_lineage, ship_package, text_buffer, text_chunks
from measures.llm.labelled import is_held_out, learning_sample

SAMPLE_ROWS = 8_000
SAMPLE_BYTES = 32 << 20
EMPHASIS = 100.0
NEIGHBOURS = 16
PRIOR_WEIGHT = 1.0
LEAST_DOCS = 3
LEVELS = (1, 2, 3, 4, 6)
COMMON = 0.25  # share of the examples from which on a term is common
PREFIXES = (4, 5, 6)


def terms_of(buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, term hash) of every word and every prefix, kind by kind."""
    starts, ends, hashes, first = W.find_words(buf, offsets, W.ALNUM)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    yield doc, hashes
    for n in PREFIXES:
        long = ends - starts > n
        s = starts[long]
        yield doc[long], W.hash_ranges(buf, s, s + n, W.ALNUM.value) + np.uint64(n)


class Vocabulary:
    """Terms (hash, level), behind a bit table that settles most misses."""

    def __init__(self, hashes: np.ndarray, levels: np.ndarray, emphasis: np.ndarray):
        order = np.lexsort((levels, hashes))
        self.terms, self.levels = hashes[order].astype(np.uint64), levels[order]
        self.emphasis = emphasis[order]
        self.mask = np.uint64((1 << 22) - 1)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.terms & self.mask] = True
        self.distinct, self.term_from = np.unique(self.terms, return_index=True)
        self.term_from = np.append(self.term_from, len(self.terms))

    def counts(self, buf: np.ndarray, offsets: np.ndarray):
        """(document, term, count) of all vocabulary terms, by document."""
        docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for doc, hashes in terms_of(buf, offsets):
            maybe = np.flatnonzero(self.seen[hashes & self.mask])
            if len(maybe):
                at = np.minimum(np.searchsorted(self.distinct, hashes[maybe]),
                                len(self.distinct) - 1)
                good = self.distinct[at] == hashes[maybe]
                docs.append(doc[maybe[good]])
                places.append(at[good])
        size = len(self.distinct) + 1
        key, n = np.unique(np.concatenate(docs) * np.int64(size) + np.concatenate(places),
                           return_counts=True)
        doc, place = key // size, key % size
        many = self.term_from[place + 1] - self.term_from[place]
        term = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) \
            + np.repeat(self.term_from[place], many)
        doc, n = np.repeat(doc, many), np.repeat(n, many)
        reached = n >= self.levels[term]
        return doc[reached], term[reached], n[reached]


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [start, end), and how many each has."""
    many = ends - starts
    last = np.cumsum(many, dtype=np.int32)
    at = np.repeat(starts - (last - many), many)
    at += np.arange(len(at), dtype=np.int32)
    return at, many


class NeighbourIndex:
    """Unit TF-IDF vectors of the examples, as postings by term."""

    def __init__(self, vocabulary: Vocabulary, ids: np.ndarray, labels: np.ndarray,
                 cuts: np.ndarray, terms: np.ndarray, counts: np.ndarray, n_sample: int,
                 base_rate: float):
        # Example i, of at least one term, has terms[cuts[i]:cuts[i + 1]].
        self.vocabulary, self.base_rate = vocabulary, base_rate
        n_terms, n = len(vocabulary.terms), len(ids)
        df = np.bincount(terms, minlength=n_terms)
        self.idf = np.log1p(n_sample / np.maximum(df, 1))
        owner = np.repeat(np.arange(n), np.diff(cuts))
        weight = (1 + np.log(counts)) * self.idf[terms] * vocabulary.emphasis[terms]
        weight /= np.sqrt(np.bincount(owner, weight * weight, minlength=n))[owner]
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order].astype(np.float64)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        by_term = np.lexsort((rank[owner], terms))
        self.post_term = terms[by_term].astype(np.int32)
        self.post_rank = rank[owner][by_term].astype(np.int32)
        self.post_weight = weight[by_term]
        # 32 bits hold all places: the sample has at most SAMPLE_BYTES words.
        self.post_from = np.searchsorted(self.post_term, np.arange(n_terms + 1)).astype(np.int32)

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms] * self.vocabulary.emphasis[terms]
        return w / np.sqrt(np.sum(w * w))

    @cached_property
    def common(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each term's place among the common ones (or -1), the examples' weights
        at these, and the norms of them: at most 1 / COMMON cells a posting.
        Made where it is first used, so that only postings are broadcast."""
        often = np.flatnonzero(np.diff(self.post_from) > COMMON * len(self.ids))
        place = np.full(len(self.idf), -1, np.int32)
        place[often] = np.arange(len(often))
        own = np.flatnonzero(place[self.post_term] >= 0)
        rows = np.zeros((len(self.ids), len(often)))
        rows[self.post_rank[own], place[self.post_term[own]]] = self.post_weight[own]
        return place, rows, np.sqrt(np.sum(rows * rows, axis=1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int):
        """Ranks and cosines of the exact k nearest examples (cosine > 0)."""
        place, rows, norms = self.common
        place = place[terms]
        rare = place < 0
        post, many = ranges(self.post_from[terms[rare]], self.post_from[terms[rare] + 1])
        score = np.bincount(self.post_rank[post],
                            np.repeat(weights[rare], many) * self.post_weight[post],
                            minlength=len(self.ids))
        query = np.zeros(rows.shape[1])
        query[place[~rare]] = weights[~rare]
        bound = score + np.sqrt(np.sum(query * query)) * norms
        floor, tried = 0.0, 4 * k
        if tried < len(bound):
            # The k-th best of some: the k-th best of all is no less.
            some = np.argpartition(bound, -tried)[-tried:]
            floor = np.partition(score[some] + rows[some] @ query, -k)[-k]
        here = np.flatnonzero((bound > 0) & (bound >= floor - 1e-9))
        cosines = score[here] + rows[here] @ query
        here, cosines = here[cosines > 0], cosines[cosines > 0]
        best = np.lexsort((self.ids[here], -np.round(cosines, 12)))[:k]
        return here[best], np.minimum(cosines[best], 1.0)

    def vote(self, ranks: np.ndarray, cosines: np.ndarray, prior: float) -> float:
        weight = cosines * cosines
        return float((np.sum(weight * self.labels[ranks]) + prior * self.base_rate)
                     / (np.sum(weight) + prior))


def toxic_terms(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and levels of the terms that lean toxic."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                part = batch.slice(a, b - a)
                y = part.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
                for doc, hashes in terms_of(*text_buffer(part.column("text"))):
                    order = np.lexsort((doc, hashes))
                    doc, hashes = doc[order], hashes[order]
                    new = np.ones(len(doc), bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
                    cut = np.flatnonzero(new)
                    times = np.diff(np.append(cut, len(doc)))
                    for level in LEVELS:
                        own = cut[times >= level]
                        terms, at, n = np.unique(hashes[own], return_inverse=True,
                                                 return_counts=True)
                        pos = np.bincount(at, weights=y[doc[own]], minlength=len(terms))
                        yield pa.record_batch(
                            [pa.array(terms.view(np.int64)),
                             pa.array(np.full(len(terms), level, np.int32)),
                             pa.array(n), pa.array(pos.astype(np.int64))],
                            names=["term", "level", "n", "pos"])

    total, toxic = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not toxic or toxic == total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    seen = cut_lineage(
        sample.mapInArrow(count, "term bigint, level int, n bigint, pos bigint")
        .groupBy("term", "level").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
        .where(f"n >= {LEAST_DOCS}"))
    g2 = 2 * math.log(max(seen.count(), 1)) + 2

    def part(seen_here: str, expected: str) -> str:
        return f"if({seen_here} > 0, {seen_here} * ln({seen_here} / ({expected})), 0)"

    t, p = float(total), float(toxic)
    ratio = " + ".join(["2 * (" + part("pos", f"n * {p} / {t}"),
                        part("(n - pos)", f"n * {t - p} / {t}"),
                        part(f"({p} - pos)", f"({t} - n) * {p} / {t}"),
                        part(f"({t} - n - {p} + pos)", f"({t} - n) * {t - p} / {t}") + ")"])
    kept = seen.where(f"({ratio}) >= {g2} AND pos / {p} > (n - pos) / {t - p}")
    rows = [(r.term, r.level) for r in kept.select("term", "level").toLocalIterator()]
    return (np.array([r[0] for r in rows], np.int64).view(np.uint64),
            np.array([r[1] for r in rows], np.int64))


def all_words(sample: DataFrame) -> np.ndarray:
    """Hashes of the words of the sample; its size bounds them."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                text = text_buffer(batch.column("text").slice(a, b - a))
                hashes = np.unique(W.find_words(*text, W.ALNUM)[2])
                yield pa.record_batch([pa.array(hashes.view(np.int64))], names=["term"])

    found = sample.mapInArrow(words, "term bigint").distinct().toArrow()
    return found.column("term").to_numpy().astype(np.int64).view(np.uint64)


def choose_vocabulary(sample: DataFrame, emphasis: float) -> Vocabulary:
    """Every word of the sample, and the terms that lean toxic."""
    hashes, levels = toxic_terms(sample)
    words = np.setdiff1d(all_words(sample), hashes[levels == 1])
    return Vocabulary(np.concatenate([hashes, words]),
                      np.concatenate([levels, np.ones(len(words), np.int64)]),
                      np.concatenate([np.full(len(hashes), emphasis), np.ones(len(words))]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic",
        sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES,
        emphasis: float = EMPHASIS) -> NeighbourIndex | None:
    """Index the labelled examples; None without any label."""
    ship_package(docs.sparkSession)
    sample = learning_sample(docs, labels, label, sample_rows, sample_bytes)
    total, positive = sample.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not total:
        return None
    vocabulary = choose_vocabulary(sample, emphasis)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                part = batch.slice(a, b - a)
                doc, term, n = vocabulary.counts(*text_buffer(part.column("text")))
                cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
                some = np.flatnonzero(np.diff(cuts))
                edges = np.append(cuts[some], len(doc)).astype(np.int32)
                yield pa.record_batch(
                    [part.column("doc_id").take(pa.array(some)), part.column("y").take(pa.array(some)),
                     pa.ListArray.from_arrays(edges, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(edges, pa.array(n.astype(np.int32)))],
                    names=["doc_id", "y", "terms", "counts"])

    found = sample.mapInArrow(
        vectors, "doc_id bigint, y int, terms array<int>, counts array<int>").toArrow()
    rows = found.combine_chunks()
    sizes = pc.list_value_length(rows.column("terms")).to_numpy().astype(np.int64)
    terms, counts = (pc.list_flatten(rows.column(c)).to_numpy().astype(np.int64)
                     for c in ("terms", "counts"))
    return NeighbourIndex(vocabulary, rows.column("doc_id").to_numpy(), rows.column("y").to_numpy(),
                         np.append(0, np.cumsum(sizes)), terms, counts, total, positive / total)


def score(docs: DataFrame, index: NeighbourIndex | None, id_col: str = "doc_id",
          text_col: str = "text", k: int = NEIGHBOURS, prior: float = PRIOR_WEIGHT,
          keep: list[str] | None = None) -> DataFrame:
    """Per row: the columns of `keep` (the id by default), score, and evidence:
    the neighbours as (example, cosine, label), nearest first."""
    ship_package(docs.sparkSession)
    keep = keep or [id_col]
    shared = docs.sparkSession.sparkContext.broadcast(index)
    rows = docs.select(*keep, *[c for c in [text_col] if c not in keep])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema
                       if f.name in keep)
    evidence = pa.list_(pa.struct([("example", pa.int64()), ("cosine", pa.float64()),
                                   ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for a, b in text_chunks(batch.column(text_col)):
                part = batch.slice(a, b - a)
                scores = np.full(part.num_rows, index.base_rate if index else 0.0)
                proof: list[list] = [[] for _ in range(part.num_rows)]
                if index and len(index.ids):
                    doc, term, n = index.vocabulary.counts(*text_buffer(part.column(text_col)))
                    cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
                    for d in np.flatnonzero(np.diff(cuts)).tolist():
                        own = slice(cuts[d], cuts[d + 1])
                        ranks, cosines = index.nearest(term[own], index.unit(term[own], n[own]), k)
                        scores[d] = index.vote(ranks, cosines, prior)
                        proof[d] = [{"example": int(index.ids[r]), "cosine": float(c),
                                     "label": int(index.labels[r])}
                                    for r, c in zip(ranks, cosines, strict=True)]
                yield pa.record_batch(
                    [*(part.column(c) for c in keep), pa.array(scores), pa.array(proof, evidence)],
                    names=[*keep, "score", "evidence"])

    return rows.mapInArrow(run, fields + ", score double, evidence array<struct<"
                                         "example:bigint,cosine:double,label:int>>")


def with_fold(scored: DataFrame, threshold: float, id_col: str = "doc_id") -> DataFrame:
    return (scored.withColumn("held_out", is_held_out(F.col(id_col)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
