"""Ranked lexical search, exact, over posting lists with range-maximum tables.

* `build_index` cuts documents into shards (SHARD_BYTES of text each, in order
  of id) and stores one row per shard: its documents and the posting list of
  every term.  Terms are known by a 64-bit hash.
* `search` takes the queries in blocks of BLOCK_BYTES.  A first job counts, per
  term of a block, the documents that hold it; a second one searches.  In each
  shard the impacts of the block's terms are known numbers, and every posting
  list gets a sparse table of the places of its range maxima.  A query starts
  with one interval of documents, bounded by the sum of its lists' maxima.  The
  interval of greatest bound is split at the document of its greatest impact,
  which is scored; a bound for each half is the sum of the halves' range
  maxima.  It ends when no bound can reach the k-th score; a task keeps the
  k best of all its shards, so later shards start from their scores.

Nothing is cut: long documents are one shard if need be, and every document
that can be among the k best is scored.  Shards are cut from the rows as they are
read, so no source, term or group of copies meets in one task.  Null texts have
no terms; documents without terms are not counted and never found.  Rows that share an id
are documents of their own; a null id ranks after all others of equal score.
Query rows without an id are none; those that share an id are one query with
the terms of all its different texts.  An empty table gives no rows.  Only the
named columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from measures.llm.common import ship_package, stored, text_buffer, text_chunks
from measures.llm.words import ALNUM, find_words

SHARD_BYTES = 16 << 20  # text of a shard, but for a single longer document
SHARD_DOCS = 1 << 16  # document numbers of a shard take two bytes
BLOCK_BYTES = 2 << 20  # text of the queries broadcast at once
AT_ONCE = 48  # intervals split together
NO_ID = 1 << 63  # above every id

SHARD = ("n_found bigint, n_terms bigint, n_null int, ids binary, sizes binary, terms binary, "
         "starts binary, docs binary, tfs binary")


# --- index ---------------------------------------------------------------------------------------

def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard, stored in the shared folder."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(_shards, SHARD), "lexical-index")


class _Shard:
    """Documents gathered until a shard is full."""

    def __init__(self):
        self.ids, self.hashes, self.numbers, self.sizes = [], [], [], []
        self.n_docs = self.n_bytes = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        buf, offsets = text_buffer(texts)
        _, _, hashes, first = find_words(buf, offsets, ALNUM)
        sizes = np.diff(first)
        self.ids.append(ids)
        self.hashes.append(hashes)
        self.numbers.append(np.repeat(np.arange(len(sizes)) + self.n_docs, sizes)
                            .astype(np.uint16))
        self.sizes.append(sizes)
        self.n_docs += len(sizes)
        self.n_bytes += len(buf)

    def row(self) -> tuple:
        """The shard's columns; documents in order of id, nulls last."""
        ids = pa.concat_arrays(self.ids)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        order = np.lexsort((ids, null))
        rank = np.empty(len(ids), np.uint16)
        rank[order] = np.arange(len(ids))
        sizes = np.concatenate(self.sizes)[order]
        hashes, docs = np.concatenate(self.hashes), rank[np.concatenate(self.numbers)]
        by_doc = np.argsort(docs, kind="stable")
        hashes, docs = hashes[by_doc], docs[by_doc]
        by_term = np.argsort(hashes, kind="stable")
        hashes, docs = hashes[by_term], docs[by_term]
        new_term = np.ones(len(hashes), bool)
        new_term[1:] = hashes[1:] != hashes[:-1]
        new = new_term.copy()
        new[1:] |= docs[1:] != docs[:-1]
        at = np.flatnonzero(new)
        tfs = np.diff(np.append(at, len(hashes)))
        small = next(t for t in (np.uint8, np.uint16, np.uint32)
                     if len(tfs) == 0 or tfs.max() <= np.iinfo(t).max)
        starts = np.append(np.flatnonzero(new_term[at]), len(at)).astype(np.int32)
        return (int((sizes > 0).sum()), int(sizes.sum()), int(null.sum()), ids[order].tobytes(),
                sizes.astype(np.int32).tobytes(), hashes[new_term].tobytes(), starts.tobytes(),
                docs[at].tobytes(), tfs.astype(small).tobytes())


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SHARD.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 6
    now = _Shard()
    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text")
        for a, b in text_chunks(texts):
            size = min(b - a, SHARD_DOCS)
            for c in range(a, b, size):
                if now.n_docs and (now.n_bytes >= SHARD_BYTES or now.n_docs + size > SHARD_DOCS):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t) for v, t in zip(now.row(), types)], names=names)
                    now = _Shard()
                end = min(c + size, b)
                now.add(ids[c:end], texts[c:end])
    if now.n_docs:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(now.row(), types)], names=names)


# --- queries -------------------------------------------------------------------------------------

@dataclass
class Block:
    """Queries that are searched together: per query its id, the numbers of its
    terms in `vocab` and their repeats; `weights` once they are known."""

    ids: list
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocab: np.ndarray
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0


def _block(ids: list, texts: list[str]) -> Block:
    buf, offsets = text_buffer(pa.array(texts, pa.large_string()))
    _, _, hashes, first = find_words(buf, offsets, ALNUM)
    vocab, number = np.unique(hashes, return_inverse=True)
    pairs = [np.unique(number[a:b], return_counts=True) for a, b in zip(first, first[1:])]
    return Block(ids, [t for t, _ in pairs], [c for _, c in pairs], vocab)


def blocks_of(queries: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """The queries in blocks; the driver holds one at a time."""
    rows = (queries.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
            .where("id IS NOT NULL").groupBy("id")
            .agg(F.array_join(F.sort_array(F.collect_set("text")), "\n").alias("text")))
    ids, texts, size = [], [], 0
    for r in rows.toLocalIterator():
        n = len(r.text.encode())
        if ids and size + n > BLOCK_BYTES:
            yield _block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r.id)
        texts.append(r.text)
        size += n
    if ids:
        yield _block(ids, texts)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(index: DataFrame, queries: DataFrame, k: int, id_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """Each query's k best documents: (id_col, rank, doc_id, score)."""
    spark = index.sparkSession
    ship_package(spark)
    n_docs, n_terms = index.agg(F.sum("n_found"), F.sum("n_terms")).head()
    id_type = queries.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, doc_id bigint, score bigint"
    best = spark.createDataFrame([], schema)
    for block in blocks_of(queries, id_col, text_col):
        block.n_docs, block.n_terms = n_docs or 0, n_terms or 0
        sent = spark.sparkContext.broadcast(block)
        held = index.select("terms", "starts").mapInArrow(
            lambda batches, sent=sent: _count(batches, sent.value), "term int, df bigint")
        # One row per term of the block at most.
        counts = {r.term: r.df for r in held.groupBy("term").agg(F.sum("df").alias("df")).collect()}
        sent.destroy()
        block.weights = np.array([weight(block.n_docs, counts.get(t, 0))
                                  for t in range(len(block.vocab))], np.int64)
        sent = spark.sparkContext.broadcast(block)
        found = index.mapInArrow(lambda batches, sent=sent: _best(batches, sent.value, k), schema)
        best = best.unionByName(stored(_ranked(found, k).drop("rank"), "lexical-best"))
        sent.destroy()
    return _ranked(best, k).select(F.col("id").alias(id_col), "rank", "doc_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _count(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term of the block, in this task's shards."""
    df = np.zeros(len(block.vocab), np.int64)
    for batch in batches:
        for terms, starts in zip(batch.column("terms"), batch.column("starts")):
            terms = np.frombuffer(terms.as_buffer(), np.uint64)
            starts = np.frombuffer(starts.as_buffer(), np.int32)
            if not len(terms):
                continue
            at = np.minimum(np.searchsorted(terms, block.vocab), len(terms) - 1)
            df += np.where(terms[at] == block.vocab, starts[at + 1] - starts[at], 0)
    known = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(known, pa.int32()), pa.array(df[known], pa.int64())],
                                     names=["term", "df"])


# --- search in a shard ---------------------------------------------------------------------------

def _best(batches: Iterator[pa.RecordBatch], block: Block, k: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of each query over all shards of this task."""
    tops: list[list] = [[] for _ in block.ids]
    for batch in batches:
        columns = {n: batch.column(n) for n in batch.schema.names}
        for i in range(batch.num_rows):
            shard = Postings({n: c[i] for n, c in columns.items()}, block)
            for top, terms, repeats in zip(tops, block.terms, block.repeats):
                shard.search(terms, repeats, top, k)
    rows = [(q, score, None if doc == -NO_ID else -doc)
            for q, top in zip(block.ids, tops) for score, doc in top]
    kind = pa.array(block.ids).type
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64()),
         pa.array([r[1] for r in rows], pa.int64())], names=["id", "doc_id", "score"])


class Postings:
    """The block's posting lists of one shard, one after the other: documents,
    impacts, and `table[j][i]`, the place of the (first) greatest impact among
    the 2**j postings from i on."""

    def __init__(self, shard: dict, block: Block):
        view = lambda name, kind: np.frombuffer(shard[name].as_buffer(), kind)
        ids, sizes = view("ids", np.int64), view("sizes", np.int32).astype(np.int64)
        n_null = shard["n_null"].as_py()
        self.ids = ids.tolist()
        if n_null:
            self.ids[len(ids) - n_null:] = [NO_ID] * n_null
        terms, starts = view("terms", np.uint64), view("starts", np.int32)
        self.n_docs = len(ids)
        if not len(terms):
            self.begin = self.end = np.zeros(len(block.vocab), np.int64)
            return
        at = np.minimum(np.searchsorted(terms, block.vocab), len(terms) - 1)
        here = (terms[at] == block.vocab) & (block.weights > 0)
        a = starts[at].astype(np.int64)
        size = np.where(here, starts[at + 1] - a, 0)
        self.end = np.cumsum(size)
        self.begin = self.end - size
        places = np.repeat(a - self.begin, size) + np.arange(size.sum())
        raw = shard["tfs"].as_buffer()
        tf = np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: np.uint32}[
            max(1, len(raw) // max(1, starts[-1]))])[places].astype(np.int64)
        self.docs = view("docs", np.uint16)[places].astype(np.int64)
        m = 100 - 25 + np.array([25 * n * block.n_docs // block.n_terms for n in sizes.tolist()],
                                np.int64)
        of = np.repeat(np.arange(len(size)), size)
        self.impacts = block.weights[of] * (1_000_000_000 * tf // (
            1000 * tf + 12 * m[self.docs]))
        self.keys = of * self.n_docs + self.docs
        self._tabulate(int(size.max(initial=0)))

    def _tabulate(self, longest: int) -> None:
        n = len(self.impacts)
        self.table = np.empty((max(1, longest.bit_length()), n), np.int32)
        self.table[0] = np.arange(n)
        for j in range(1, len(self.table)):
            below, half = self.table[j - 1], 1 << (j - 1)
            left, right = below[:n - half], below[half:]
            self.table[j, :n - half] = np.where(
                self.impacts[left] >= self.impacts[right], left, right)
            self.table[j, n - half:] = below[n - half:]
        self.level = np.zeros(longest + 2, np.int8)
        for j in range(1, len(self.table)):
            self.level[1 << j:] = j

    def greatest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Place of the greatest impact in each [lo, hi), -1 where it is empty."""
        j = self.level[np.maximum(hi - lo, 0)]
        last = len(self.impacts) - 1
        left = self.table[j, np.minimum(lo, last)]
        right = self.table[j, np.clip(hi - (1 << j.astype(np.int64)), 0, last)]
        best = np.where(self.impacts[left] >= self.impacts[right], left, right)
        return np.where(hi > lo, best, -1)

    def search(self, terms: np.ndarray, repeats: np.ndarray, top: list, k: int) -> None:
        """Raise `top`, a heap of the k best (score, -id), by this shard's documents."""
        here = self.end[terms] > self.begin[terms]
        terms, repeats = terms[here], repeats[here]
        if not len(terms):
            return
        edge = terms * self.n_docs
        # Intervals ever opened: ends in each list, place of each list's maximum.
        lo, hi = self.begin[terms][None, :], self.end[terms][None, :]
        pool = _Pool(lo, hi, self.greatest(lo, hi))
        bound = int((self.impacts[pool.peak[0]] * repeats).sum())
        waiting = [(-bound, int(self.docs[lo[0]].min()), 0)]
        while waiting:
            chosen = []
            while waiting and len(chosen) < AT_ONCE:
                if len(top) >= k and (-waiting[0][0], -self.ids[waiting[0][1]]) <= top[0]:
                    waiting.clear()  # nor can any other: bounds fall, then ids rise
                    break
                chosen.append(heapq.heappop(waiting)[2])
            if not chosen:
                return
            lo, hi, peak = pool.lo[chosen], pool.hi[chosen], pool.peak[chosen]
            worth = np.where(peak >= 0, self.impacts[peak] * repeats, 0)
            doc = self.docs[np.take_along_axis(peak, worth.argmax(1)[:, None], 1)]
            wanted = edge + doc
            mid = np.searchsorted(self.keys, wanted)
            held = self.keys[np.minimum(mid, len(self.keys) - 1)] == wanted
            scores = (self.impacts[np.minimum(mid, len(self.keys) - 1)] * repeats * held).sum(1)
            for score, d in zip(scores.tolist(), doc[:, 0].tolist()):
                entry = (score, -self.ids[d])
                if len(top) < k:
                    heapq.heappush(top, entry)
                elif entry > top[0]:
                    heapq.heapreplace(top, entry)
            lo, hi = np.concatenate([lo, mid + held]), np.concatenate([mid, hi])
            peak = self.greatest(lo, hi)
            bounds = np.where(peak >= 0, self.impacts[peak] * repeats, 0).sum(1)
            heads = np.where(peak >= 0, self.docs[np.minimum(lo, len(self.docs) - 1)],
                             self.n_docs).min(1)
            open_ = np.flatnonzero(bounds > (top[0][0] - 1 if len(top) >= k else 0))
            first = pool.add(lo[open_], hi[open_], peak[open_])
            for i, (b, h) in enumerate(zip(bounds[open_].tolist(), heads[open_].tolist())):
                heapq.heappush(waiting, (-b, h, first + i))


class _Pool:
    """Rows of intervals, appended to arrays that double."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, peak: np.ndarray):
        self.n, self.lo, self.hi, self.peak = len(lo), lo, hi, peak

    def add(self, lo: np.ndarray, hi: np.ndarray, peak: np.ndarray) -> int:
        first, self.n = self.n, self.n + len(lo)
        if self.n > len(self.lo):
            room = max(2 * len(self.lo), self.n, 256)
            for name in ("lo", "hi", "peak"):
                old = getattr(self, name)
                new = np.empty((room, old.shape[1]), np.int32)
                new[:first] = old[:first]
                setattr(self, name, new)
        self.lo[first:self.n], self.hi[first:self.n], self.peak[first:self.n] = lo, hi, peak
        return first
