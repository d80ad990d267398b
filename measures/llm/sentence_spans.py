"""Substring dedup by sliding sentence spans.

Texts are cut into sentences, every run of `sentences` consecutive ones is
hashed (96 bits, of folded words), and equal runs are joined globally: the
first by (id, place) is the original, and every sentence covered by any other
one is removed.

Sentences end after a word ending in `.`, `!` or `?` and at line breaks.  One of
at least `long` words is cut further, after the word of least hash in each
stretch of `long` words, so that equal passages are cut alike wherever their
sentences begin.  A word of over LONG_WORD bytes (a script without white space)
counts as its characters.  With the defaults any passage of 51 words holds a
whole run, however it is cut out of its sentences: at most 8 words at either end
depend on what stands around it, and 35 words hold three whole pieces of at most
8.  Of a repeated passage those ends may stay.

Hashes alone are counted first; a bitmap of those that occur twice or more
(MAX_FILTER_BITS at most, false hits are dropped by the join) goes to all tasks,
and only the runs it lets through are shuffled whole.

Rules
- null, empty or wordless text has no sentence and is kept as it is, and so is a
  text of fewer than `sentences` sentences.
- runs inside one text repeat each other too: the first stays.
- rows that share an id are told apart by their text; identical rows with one
  id are one document: they keep and lose the same sentences.  A null id comes
  before all others.  An empty table gives no rows.
- texts of any length are read whole; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.llm import words as W
from measures.llm.common import cut_lineage, ship_package, stored, text_buffer, text_chunks

SENTENCES = 3
LONG = 8
LONG_WORD = 200
BROADCAST_IDS = 500_000  # 8 MB of keys; more are joined by a shuffle
MAX_FILTER_BITS = 1 << 27
_BLOCK = 1 << 15  # bits of Spark's bitmap aggregate
_SECOND = np.uint64(0xA24BAED4963EE407)
_CHOICE = np.uint64(0x9FB21C651E98DF25)
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


def find_words(buf: np.ndarray, offsets: np.ndarray):
    """Starts, ends and hashes of words, long ones cut into characters, and the
    index of each text's first word."""
    starts, ends, hashes, first = W.find_words(buf, offsets, W.SPACED)
    long = np.flatnonzero(ends - starts > LONG_WORD)
    if len(long):
        inside = np.zeros(len(buf) + 1, np.int8)
        inside[starts[long]] += 1
        inside[ends[long]] -= 1
        chars = np.flatnonzero((np.cumsum(inside[:-1]) > 0) & ((buf & 0xC0) != 0x80))
        run_end = np.repeat(ends[long], np.diff(np.append(
            np.searchsorted(chars, starts[long]), len(chars))))
        char_end = np.minimum(np.append(chars[1:], len(buf)), run_end)
        short = ends - starts <= LONG_WORD
        starts = np.concatenate([starts[short], chars])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.concatenate([ends[short], char_end])[order]
        hashes = W.hash_ranges(buf, starts, ends, W.SPACED.value)
        first = np.searchsorted(starts, offsets).astype(np.int64)
    return starts, ends, hashes, first


class Sentences:
    """Sentences of many texts: word ranges, byte starts, and whose they are."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, long: int = LONG):
        starts, ends, self.hashes, first = find_words(buf, offsets)
        n = len(starts)
        doc_of_word = np.repeat(np.arange(len(first) - 1), np.diff(first))
        breaks = np.concatenate([[0], np.cumsum(buf == 10)])
        last = np.zeros(n, bool)
        if n:
            last[:-1] = (breaks[starts[1:]] > breaks[ends[:-1]]) \
                | (doc_of_word[1:] != doc_of_word[:-1])
            last |= _END[buf[ends - 1]]
            last[-1] = True
            last[self._minima(last, long)] = True
        self.end = np.flatnonzero(last) + 1  # word ranges [begin, end)
        self.begin = np.concatenate([[0], self.end[:-1]])[:len(self.end)]
        self.doc = doc_of_word[self.begin] if n else self.begin
        self.first = np.searchsorted(self.doc, np.arange(len(offsets)))
        # A sentence owns the bytes from its first word to the next sentence's.
        self.byte = starts[self.begin] if n else self.begin

    def _minima(self, last: np.ndarray, long: int) -> np.ndarray:
        """The (first) word of least hash in every stretch of `long` words that
        lies in one sentence."""
        if len(last) < long:
            return np.zeros(0, np.int64)
        rank = np.lib.stride_tricks.sliding_window_view(W.mix(self.hashes ^ _CHOICE), long)
        ends = np.concatenate([[0], np.cumsum(last)])
        whole = np.flatnonzero(ends[long - 1:-1] == ends[:len(last) - long + 1])
        chosen = np.zeros(len(last), bool)
        for a in range(0, len(whole), 1 << 16):  # a block at a time, to bound memory
            at = whole[a:a + (1 << 16)]
            chosen[at + rank[at].argmin(axis=1)] = True
        return np.flatnonzero(chosen)

    def runs(self, sentences: int):
        """(first sentence, two hashes) of every run of `sentences` of a text."""
        at = np.arange(max(len(self.end) - sentences + 1, 0))
        at = at[self.doc[at] == self.doc[at + sentences - 1]]
        a, b = self.begin[at], self.end[at + sentences - 1]
        return at, _ranges(self.hashes, a, b), _ranges(W.mix(self.hashes + _SECOND), a, b)


def _ranges(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    prefix = np.concatenate([np.zeros(1, np.uint64),
                             np.cumsum(hashes * W.powers(len(hashes)), dtype=np.uint64)])
    h = (prefix[b] - prefix[a]) * W.inverse_powers(len(prefix))[a]
    return W.mix(h + (b - a).astype(np.uint64))


RUN = "h1 bigint, h2 int, id bigint, th bigint, place int"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_chunks(batch.column("text")):
            yield batch.slice(a, b - a)


def repeated_hashes(rows: DataFrame, sentences: int, long: int) -> DataFrame:
    """First hashes of the runs that occur more than once."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            _, h1, _ = Sentences(*text_buffer(part.column("text")), long).runs(sentences)
            yield pa.record_batch([pa.array(h1.view(np.int64))], names=["h1"])

    return stored(rows.select("text").mapInArrow(hashes, "h1 bigint").groupBy("h1").agg(
        F.count(F.lit(1)).alias("times")).where("times > 1").select("h1"), "repeated-spans")


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """A bit per hash, by its low bits; at most MAX_FILTER_BITS."""
    bits, n = _BLOCK, hashes.count()
    while bits < min(16 * n, MAX_FILTER_BITS):
        bits *= 2
    slot = F.col("h1").bitwiseAND(F.lit(bits - 1))
    blocks = (hashes.select(F.shiftright(slot, 15).alias("block"), (slot % _BLOCK).alias("bit"))
              .repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit")).collect())
    bitmap = np.zeros(bits // 8, np.uint8)
    for block, some in blocks:
        at = block * _BLOCK // 8
        bitmap[at:at + _BLOCK // 8] = np.frombuffer(some, np.uint8)
    return bitmap


def runs_met(rows: DataFrame, sentences: int, long: int) -> DataFrame:
    """The runs that may occur more than once, with their places."""
    shared = rows.sparkSession.sparkContext.broadcast(
        bitmap_of(repeated_hashes(rows, sentences, long)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        mask = np.uint64(8 * len(known) - 1)
        for part in _parts(batches):
            s = Sentences(*text_buffer(part.column("text")), long)
            at, h1, h2 = s.runs(sentences)
            slot = (h1 & mask).astype(np.int64)
            may = np.flatnonzero(known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            doc = s.doc[at[may]]
            whose = pa.array(doc)
            yield pa.record_batch(
                [pa.array(h1[may].view(np.int64)), pa.array(h2[may].astype(np.uint32).view(np.int32)),
                 part.column("id").take(whose), part.column("th").take(whose),
                 pa.array((at[may] - s.first[doc]).astype(np.int32))],
                names=[x.split()[0] for x in RUN.split(", ")])

    return stored(rows.mapInArrow(run, RUN), "sentence-runs")


def covered_by_later(runs: DataFrame) -> DataFrame:
    """Per text (i, t): the places of its runs that stand elsewhere first."""
    place = F.struct("id", "th", "place")
    # Stored, so that the join shuffles both sides and the skew rule can split a
    # run that very many texts share.
    first = stored(runs.groupBy("h1", "h2").agg(
        F.min(place).alias("original"), F.count(F.lit(1)).alias("times")).where("times > 1"),
        "sentence-originals")
    again = runs.hint("merge").join(first, ["h1", "h2"]).where(
        ~place.eqNullSafe(F.col("original")))
    return stored(again.groupBy(F.col("id").alias("i"), F.col("th").alias("t")).agg(
        F.collect_list("place").alias("covered")), "sentence-covered")  # at most a text's sentences


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          sentences: int = SENTENCES, long: int = LONG) -> DataFrame:
    """Per row: id, n_sentences, n_removed (sentences), kept (text)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    unclear = rows.groupBy("id").count().where("id IS NULL OR count > 1").limit(1).count()
    rows = rows.withColumn("th", F.xxhash64("text") if unclear else F.lit(0).cast("bigint"))
    per_doc = covered_by_later(runs_met(rows, sentences, long))
    keys = cut_lineage(per_doc.select("i", "t"))
    if keys.count() <= BROADCAST_IDS:
        keys = F.broadcast(keys)
    named = F.expr("id <=> i AND th = t")
    touched = rows.join(keys, named, "left_semi").hint("merge").join(per_doc, named)
    schema = "id bigint, n_sentences bigint, n_removed bigint, kept string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield _cut(part, sentences, long)

    none = F.array().cast("array<int>").alias("covered")
    clean = rows.join(keys, named, "left_anti").select("id", "text", none)
    return clean.mapInArrow(cut, schema).union(
        touched.select("id", "text", "covered").mapInArrow(cut, schema))


def _cut(part: pa.RecordBatch, sentences: int, long: int) -> pa.RecordBatch:
    """Rows (id, text, covered) without the sentences of their covered runs."""
    buf, offsets = text_buffer(part.column("text"))
    s = Sentences(buf, offsets, long)
    n = np.diff(s.first)
    places = part.column("covered")
    if not len(places.flatten()):
        return pa.record_batch(
            [part.column("id"), pa.array(n), pa.array(np.zeros_like(n)), part.column("text")],
            names=["id", "n_sentences", "n_removed", "kept"])
    at = np.repeat(s.first[:-1], places.value_lengths().to_numpy()) + places.flatten().to_numpy()
    m = len(s.end)
    edge = np.bincount(at, minlength=m + 1) - np.bincount(at + sentences, minlength=m + 1)
    gone = np.cumsum(edge[:m]) > 0
    # A sentence owns the bytes up to the next one; a text's first one, all before it.
    own = np.append(s.byte, len(buf))
    heads = s.first[:-1][n > 0]
    own[heads] = offsets[:-1][n > 0]
    stays = np.ones(len(buf), bool)
    flip = np.zeros(len(buf) + 1, np.int64)
    stop = own[1:].copy()
    stop[(s.first[1:] - 1)[n > 0]] = offsets[1:][n > 0]
    np.add.at(flip, own[:-1][gone], 1)
    np.add.at(flip, stop[gone], -1)
    stays = np.cumsum(flip[:-1]) == 0
    removed = np.concatenate([[0], np.cumsum(~stays)])[offsets]
    kept = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), part.num_rows,
        [None, pa.py_buffer((offsets - removed).astype(np.int64)), pa.py_buffer(buf[stays])])
    return pa.record_batch(
        [part.column("id"), pa.array(n),
         pa.array(np.diff(np.concatenate([[0], np.cumsum(gone)])[s.first])),
         kept.cast(pa.binary()).cast(pa.string())], names=["id", "n_sentences", "n_removed", "kept"])
