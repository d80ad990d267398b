"""Benchmark decontamination with an FM-index per shard of training text.

A benchmark item is cut into windows of `window` consecutive words (a shorter
item is one window).  Each shard (a few MB of training text inside a task)
keeps the runs of words that occur in the benchmark at all and are long
enough to hold a window, indexes them, and all windows are searched backward
at once; located occurrences are merged into spans of hit words.

Words are `[0-9a-z, non-ASCII]+` after folding A-Z.  Words are compared by a
64-bit hash: a false window needs a full run of benchmark words in order with
one more word colliding, which is out of reach at any corpus size.

Rules
- null or empty text has no words and is never hit; items without words have
  no window; rows of the benchmark with a null id are left out; rows that
  share an item id are one item.
- every row is judged by itself: repeated rows get equal results.
- the benchmark is taken in blocks of at most `block_windows` windows, each
  broadcast; the corpus is read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.llm import words as W
from measures.llm.common import blocks_for, ship_package, text_buffer, text_chunks
from measures.llm.fm_index import FMIndex

WINDOW = 13
BLOCK_BYTES = 16 << 20


class Windows:
    """Windows of a block of benchmark items as rows of vocabulary ids."""

    def __init__(self, rows: list[tuple[object, str]], window: int):
        found: dict[tuple, set] = {}
        for item, text in rows:
            buf = np.frombuffer((text or "").encode(), np.uint8)
            _, _, hashes, _ = W.find_words(buf, np.array([0, len(buf)]), W.ALNUM)
            h = hashes.tolist()
            size = min(window, len(h))
            for i in range(len(h) - size + 1 if size else 0):
                found.setdefault(tuple(h[i:i + size]), set()).add(str(item))
        keys = sorted(found)
        self.vocab = np.unique(np.array([w for k in keys for w in k], np.uint64))
        self.lengths = np.array([len(k) for k in keys], np.int64)
        self.shortest = int(self.lengths.min()) if keys else 0
        self.patterns = np.zeros((len(keys), window), np.int64)
        for i, k in enumerate(keys):
            self.patterns[i, window - len(k):] = np.searchsorted(
                self.vocab, np.array(k, np.uint64)) + 1
        names = sorted({x for v in found.values() for x in v})
        place = {x: i for i, x in enumerate(names)}
        self.items = names
        self.item_of = np.array([place[x] for k in keys for x in sorted(found[k])], np.int64)
        self.item_from = np.concatenate([[0], np.cumsum([len(found[k]) for k in keys])]).astype(
            np.int64)

    def occurrences(self, hashes: np.ndarray, first_word: np.ndarray):
        """(window, word index) of every occurrence in a shard's words."""
        none = np.zeros(0, np.int64)
        if not len(self.lengths) or not len(hashes):
            return none, none
        at = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        symbol = np.where(self.vocab[at] == hashes, at + 1, 0)
        # Maximal runs of benchmark words inside one text.
        on = symbol > 0
        new = np.empty(len(on), bool)
        new[0] = True
        new[1:] = on[1:] != on[:-1]
        new[first_word[:-1][first_word[:-1] < len(on)]] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(on))
        good = on[starts] & (ends - starts >= self.shortest)
        starts, ends = starts[good], ends[good]
        if not len(starts):
            return none, none
        sizes = ends - starts + 1  # each run is followed by a separator
        text_from = np.concatenate([[0], np.cumsum(sizes)])
        text = np.zeros(text_from[-1], np.int64)
        inside = np.arange(text_from[-1])
        word = inside - np.repeat(text_from[:-1] - starts, sizes)
        gap = np.zeros(len(text), bool)
        gap[text_from[1:] - 1] = True
        text[~gap] = symbol[word[~gap]]
        index = FMIndex(text, len(self.vocab) + 1)
        lo, hi = index.search(self.patterns, self.lengths)
        many = hi - lo
        window = np.repeat(np.arange(len(many)), many)
        rows = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
        return window, word[index.locate(rows)]


def load_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int,
                block_bytes: int) -> list:
    """The benchmark's windows, broadcast in blocks of bounded size."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where(
        "item IS NOT NULL AND text IS NOT NULL")
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = blocks_for(n_bytes, block_bytes)
    out = []
    for b in range(n):  # a block: some items, whole
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b)
        out.append(spark.sparkContext.broadcast(
            Windows([(r.item, r.text) for r in part.toLocalIterator()], window)))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None
                       ) -> DataFrame:
    """Per row: the columns of `keep` (the id by default), n_words, n_hit, spans (byte ranges of merged hit words,
    for removal), items (ids of items with an occurring window, sorted as
    strings)."""
    ship_package(docs.sparkSession)
    blocks = load_blocks(benchmark, item_col, item_text_col, window, block_bytes)

    keep = keep or [id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column(text_col)):
                shard = batch.slice(a, b - a)
                yield _judge(shard, text_col, keep, [x.value for x in blocks])

    rows = docs.select(*keep, *[c for c in [text_col] if c not in keep])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema
                       if f.name in keep)
    return rows.mapInArrow(run, f"{fields}, n_words bigint, n_hit bigint, "
                                "spans array<struct<start:bigint,end:bigint>>, items array<string>")


def _judge(shard: pa.RecordBatch, text_col: str, keep: list[str],
           blocks: list[Windows]) -> pa.RecordBatch:
    buf, offsets = text_buffer(shard.column(text_col))
    starts, ends, hashes, first_word = W.find_words(buf, offsets, W.ALNUM)
    n_docs = shard.num_rows
    edge = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set] = {}
    for block in blocks:
        window, at = block.occurrences(hashes, first_word)
        if not len(window):
            continue
        np.add.at(edge, at, 1)
        np.add.at(edge, at + block.lengths[window], -1)
        doc = np.searchsorted(first_word, at, side="right") - 1
        for d, w in np.unique(np.stack([doc, window]), axis=1).T.tolist():
            items.setdefault(d, set()).update(
                block.items[i] for i in block.item_of[block.item_from[w]:block.item_from[w + 1]])
    hit = np.cumsum(edge[:-1]) > 0
    hits_before = np.concatenate([[0], np.cumsum(hit)])
    n_hit = hits_before[first_word[1:]] - hits_before[first_word[:-1]]
    spans: list[list] = [[] for _ in range(n_docs)]
    for d in np.flatnonzero(n_hit).tolist():
        a, b = int(first_word[d]), int(first_word[d + 1])
        flips = np.flatnonzero(np.diff(hit[a:b].astype(np.int8), prepend=0, append=0))
        for s, e in flips.reshape(-1, 2).tolist():
            spans[d].append({"start": int(starts[a + s] - offsets[d]),
                             "end": int(ends[a + e - 1] - offsets[d])})
    return pa.record_batch(
        [*(shard.column(c) for c in keep), pa.array(np.diff(first_word)), pa.array(n_hit),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
         pa.array([sorted(items.get(d, ())) for d in range(n_docs)], pa.list_(pa.string()))],
        names=[*keep, "n_words", "n_hit", "spans", "items"])


def items_digest(items: set) -> str:
    """Digest of item ids as the query carries it (for tests)."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def contaminated(found: DataFrame) -> DataFrame:
    """The contract's rule: some hit word, and hit words at least 1 in 20."""
    return found.withColumn("contaminated",
                            (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
