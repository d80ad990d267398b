"""Removal of repeated substrings by sorted suffixes.

Every byte covered by a `length`-byte string that also starts anywhere else in
the corpus is removed, judged on the input.

1. Anchors.  Each window of `length` bytes is keyed by its least hashed
   `K`-gram, which equal windows share.  The windows of one anchor are one
   fragment of text; (key, fragment) is counted over the corpus and only keys
   that occur twice go on, each distinct fragment once, with its count.
2. All windows of a key with a single distinct fragment repeat.  The fragments
   of the others are sharded by key.  In a shard the text is cut at local hash
   minima into short tokens, and the suffixes of all fragments are sorted by
   linear grouping of Lyndon prefixes (`grouping_sort`).  Neighbours in that
   order that share the tokens of the middle of a window are the candidates;
   the exact check then compares the windows around them.
3. A window repeats when its occurrences, counted with their fragments'
   counts, are two or more.  Repeated windows go back to every occurrence of
   their fragment and are merged per document.

A key with more than `KEY_FRAGMENTS` distinct fragments (a short common
string) would make its shard too large; the windows of such fragments are
counted one by one through a shuffle instead, with the same result.

Rules
- null text is empty; texts shorter than `length` keep every byte; matches
  never cross texts; the two places may lie in one text and may overlap.
- every row is a text of its own, also when rows share an id or have none:
  identical rows repeat each other.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.llm import words as W
from measures.llm.common import (blocks_for, cut_lineage, ship_package, stored,
                                 text_buffer, text_chunks)
from measures.llm.grouping_sort import suffix_order

LENGTH = 200
K = 64  # long enough that two fragments seldom meet by chance
PIECE = 1 << 20
SHARD_BYTES = 1 << 20
KEY_FRAGMENTS = 5_000
BROADCAST_IDS = 500_000  # 4 MB of ids; more are joined by a shuffle
TOKEN_GRAM, TOKEN_WINDOW = 4, 13
_SECOND = W.mix(W._VALUE + np.uint64(77))  # values of the second, independent hash


class Hashed:
    """Prefix sums of a polynomial hash, so that any range hashes in O(1)."""

    def __init__(self, buf: np.ndarray, value: np.ndarray = W._VALUE):
        self.prefix = np.empty(len(buf) + 1, np.uint64)
        self.prefix[0] = 0
        np.cumsum(value[buf] * W.powers(len(buf)), out=self.prefix[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.prefix[ends] - self.prefix[starts]) * W.inverse_powers(len(self.prefix))[starts]
        return W.mix(h ^ ((ends - starts).astype(np.uint64) * W._BASE))


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of `width` values."""
    n = len(h)
    if n < width:
        return h[:0]
    rows = -(-n // width)
    full = np.full(rows * width, np.uint64(2**64 - 1))
    full[:n] = h
    full = full.reshape(rows, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(back[:m], ahead[width - 1:width - 1 + m])


def pieces(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray,
                                                           np.ndarray]]:
    """(bytes, offsets, row, start in the text) of bounded parts of the texts;
    parts of one long text overlap by length - 1 bytes, so no window is lost
    or met twice."""
    for a, b in text_chunks(texts, PIECE):
        buf, offsets = text_buffer(texts.slice(a, b - a))
        if b - a > 1 or len(buf) <= 2 * PIECE:
            yield buf, offsets, np.arange(a, b), np.zeros(b - a, np.int64)
        else:
            for s in range(0, len(buf) - length + 1, PIECE):
                part = buf[s:s + PIECE + length - 1]
                yield part, np.array([0, len(part)]), np.array([a]), np.array([s])


def fragments(buf: np.ndarray, offsets: np.ndarray, length: int, k: int):
    """Key, hash, text, first and last window of every anchor's fragment."""
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none
    hashed = Hashed(buf)
    at = np.arange(len(buf) - k + 1)
    gram = hashed.ranges(at, at + k)
    least = sliding_least(gram, length - k + 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(least)]
    ok = np.arange(len(least)) + length <= offsets[text + 1]
    change = np.ones(len(least) + 1, bool)
    # A window that began with its own anchor hands over to the next anchor.
    change[1:-1] = ((least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~ok[1:] | ~ok[:-1]
                    | (gram[:len(least) - 1] == least[:-1]))
    first = np.flatnonzero(change[:-1] & ok)
    last = np.flatnonzero(change[1:] & ok)
    return least[first], hashed.ranges(first, last + length), text[first], first, last


# A fragment's name is (key, f): 64 bits tell apart the fragments of one key.
OCCURRENCE = "key bigint, f bigint, uid bigint, start bigint, windows int, times int"


def occurrences(docs: DataFrame, length: int, k: int) -> DataFrame:
    """Every fragment met; one row for `times` equal ones that follow each
    other in a text (they start `windows` bytes apart), as in periodic text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("uid").to_numpy(zero_copy_only=False)
            for buf, offsets, row, base in pieces(batch.column("text"), length):
                key, f, text, first, last = fragments(buf, offsets, length, k)
                if not len(key):
                    continue
                new = np.ones(len(key), bool)
                new[1:] = ((key[1:] != key[:-1]) | (f[1:] != f[:-1])
                           | (text[1:] != text[:-1]) | (first[1:] != last[:-1] + 1))
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(key))).astype(np.int32)
                key, f, text, first, last = key[at], f[at], text[at], first[at], last[at]
                yield pa.record_batch(
                    [pa.array(key.view(np.int64)), pa.array(f.view(np.int64)),
                     pa.array(ids[row[text]]),
                     pa.array(first - offsets[text] + base[text]),
                     pa.array((last - first + 1).astype(np.int32)), pa.array(times)],
                    names=[x.split()[0] for x in OCCURRENCE.split(", ")])

    return docs.mapInArrow(run, OCCURRENCE)


REPEATS = "key bigint, f bigint, lo array<int>, hi array<int>"


def repeated_windows(length: int, shard: pa.Table) -> pa.Table:
    """Of one shard's fragments: the runs [lo, hi] of repeated windows."""
    weight = shard.column("copies").to_numpy()
    texts = shard.column("bytes").combine_chunks()
    buf, offsets = text_buffer(texts)
    repeated = _repeated(buf, offsets, weight, length)
    # Windows of all fragments in one line; a gap between fragments is False.
    flips = np.diff(repeated.astype(np.int8), prepend=0, append=0)
    lo, hi = np.flatnonzero(flips == 1), np.flatnonzero(flips == -1) - 1
    cuts = np.searchsorted(lo, offsets)
    some = np.flatnonzero(np.diff(cuts))
    edges = np.append(cuts[some], len(lo)).astype(np.int32)
    base = np.repeat(offsets[some], np.diff(edges))
    keep = pa.array(some)
    return pa.table([shard.column(c).take(keep) for c in ("key", "f")]
                    + [pa.ListArray.from_arrays(edges, pa.array((x - base).astype(np.int32)))
                       for x in (lo, hi)], names=["key", "f", "lo", "hi"])


def _repeated(buf: np.ndarray, offsets: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """For each position of the shard: does a repeated window start there?"""
    n = len(buf)
    hashed = Hashed(buf)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    grams = np.arange(max(n - TOKEN_GRAM + 1, 0))
    h = hashed.ranges(grams, grams + TOKEN_GRAM)
    least = sliding_least(h, TOKEN_WINDOW)
    reach = TOKEN_WINDOW + TOKEN_GRAM - 1  # bytes that decide one cut
    inside = np.arange(len(least)) + reach <= offsets[text[:len(least)] + 1]
    # The cut of a window of grams: the first gram that has the least hash.
    cut = np.zeros(n + 1, bool)
    view = np.lib.stride_tricks.sliding_window_view(h, TOKEN_WINDOW)
    for a in range(0, len(least), 1 << 16):  # a block at a time, to bound memory
        b = min(a + (1 << 16), len(least))
        first = np.argmin(view[a:b], axis=1) + np.arange(a, b)
        cut[first[inside[a:b]]] = True
    cuts = np.flatnonzero(cut)
    run = length - 2 * reach - 2 * TOKEN_WINDOW
    # Tokens between neighbouring cuts of one fragment; a separator after each fragment.
    of = text[cuts]
    joined = of[1:] == of[:-1]
    token_at = np.flatnonzero(joined)
    name = hashed.ranges(cuts[token_at], cuts[token_at + 1])
    _, symbol = np.unique(name, return_inverse=True)
    n_tokens = np.bincount(of[token_at], minlength=len(offsets) - 1)
    where = np.arange(len(token_at)) + of[token_at]
    line = np.empty(len(token_at) + len(offsets) - 1, np.int64)
    gaps = np.cumsum(n_tokens) + np.arange(len(n_tokens))
    line[gaps] = np.arange(len(gaps))[::-1]
    line[where] = symbol + len(gaps)
    order = suffix_order(line)
    # Clusters: neighbours in suffix order with the same run of tokens.
    back = np.full(len(line), -1, np.int64)
    back[where] = token_at
    sorted_cuts = back[order]
    sorted_cuts = sorted_cuts[sorted_cuts >= 0]
    start = cuts[sorted_cuts]
    stop_at = np.searchsorted(cuts, start + run)
    stop = cuts[np.minimum(stop_at, len(cuts) - 1)] if len(cuts) else start
    whole = (stop_at < len(cuts)) & (text[np.minimum(stop, n - 1)] == text[start])
    sorted_cuts, start, stop = sorted_cuts[whole], start[whole], stop[whole]
    middle = hashed.ranges(start, stop)
    cluster = np.full(len(cuts) + 1, -1, np.int64)
    cluster[sorted_cuts] = np.cumsum(np.append(True, middle[1:] != middle[:-1]))[:len(middle)]
    # The exact check: equal windows at equal distance from their cluster's cut.
    windows = np.flatnonzero(np.arange(n) + length <= offsets[text + 1])
    middle_cut = np.searchsorted(cuts, windows + reach)
    known = cluster[np.minimum(middle_cut, len(cuts))]
    content = hashed.ranges(windows, windows + length)
    distance = cuts[np.minimum(middle_cut, len(cuts) - 1)] - windows if len(cuts) else windows
    same = W.mix(content + W.mix((known * 64 + distance).astype(np.uint64)))
    _, at = np.unique(same, return_inverse=True)
    total = np.bincount(at, weights=weight[text[windows]])
    out = np.zeros(n, bool)
    out[windows[(known >= 0) & (total[at] >= 2)]] = True
    return out


def fetch_bytes(reps: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of each distinct fragment, from its first occurrence."""
    per_doc = reps.groupBy("uid").agg(F.collect_list(
        F.struct("key", "f", "start", "windows", "copies")).alias("parts"))
    found = narrowed(docs, per_doc.select("uid")).hint("merge").join(per_doc, "uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                part = batch.slice(a, b - a)
                buf, offsets = text_buffer(part.column("text"))
                lists = part.column("parts")
                parts = lists.flatten()
                doc = np.repeat(np.arange(b - a), lists.value_lengths().to_numpy())
                starts = parts.field("start").to_numpy() + offsets[doc]
                sizes = parts.field("windows").to_numpy() + (length - 1)
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                place = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
                cut = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(buf[place])])
                yield pa.record_batch(
                    [parts.field(c) for c in ("key", "f", "copies")] + [cut.cast(pa.binary())],
                    names=["key", "f", "copies", "bytes"])

    return found.select("text", "parts").mapInArrow(
        run, "key bigint, f bigint, copies bigint, bytes binary")


def narrowed(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents named by `ids`; few ids are broadcast, so that only the
    named texts are shuffled afterwards."""
    ids = cut_lineage(ids)
    if ids.count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(ids), "uid", "left_semi")
    return docs


def removal_runs(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """Per fragment met that has repeated windows: uid, start, windows, times
    and the runs [lo, hi] of repeated windows inside the fragment."""
    found = occurrences(docs, length, k)
    met = found.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key")
    candidates = stored(found.hint("merge").join(met, "key"), "fragments-met")
    frags = stored(candidates.groupBy("key", "f").agg(
        F.min(F.struct("uid", "start", "windows")).alias("at"), F.sum("times").alias("copies"))
        .select("key", "f", "at.*", "copies"), "fragments")
    # A key whose fragments are all equal needs no bytes: every window repeats.
    several = cut_lineage(frags.groupBy("key").agg(F.count("*").alias("several")).where("several > 1"))
    alone = frags.hint("merge").join(several, "key", "left_anti").select(
        "key", "f", F.array(F.lit(0)).alias("lo"), F.array(F.col("windows") - 1).alias("hi"))
    frags = frags.hint("merge").join(several.select("key"), "key", "left_semi")
    crowded = cut_lineage(several.where(F.col("several") > KEY_FRAGMENTS).select("key"))
    texts = fetch_bytes(frags, docs, length)
    if crowded.limit(1).count():
        texts = stored(texts, "fragment-texts")
        usual = texts.hint("merge").join(crowded, "key", "left_anti")
        extra = window_by_window(texts.hint("merge").join(crowded, "key", "left_semi"), length)
    else:
        usual, extra = texts, None
    n_bytes = frags.agg(F.sum(F.col("windows") + length - 1)).first()[0] or 0
    shards = blocks_for(n_bytes, SHARD_BYTES)
    repeats = (usual.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
               .groupBy("shard").applyInArrow(
                   lambda shard: repeated_windows(length, shard), REPEATS))
    repeats = alone.union(repeats if extra is None else repeats.union(extra))
    repeats = stored(repeats, "repeats")
    return (candidates.hint("merge").join(repeats, ["key", "f"])
            .select("uid", "start", "windows", "times", "lo", "hi"))


def window_by_window(frags: DataFrame, length: int) -> DataFrame:
    """The same result for fragments of crowded keys: every window is a row."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("bytes"), 1 << 18):
                part = batch.slice(a, b - a)
                buf, offsets = text_buffer(part.column("bytes"))
                text = np.repeat(np.arange(b - a), np.diff(offsets))
                at = np.flatnonzero(np.arange(len(buf)) + length <= offsets[text + 1])
                row = pa.array(text[at])
                yield pa.record_batch(
                    [part.column(c).take(row) for c in ("key", "f", "copies")]
                    + [pa.array((at - offsets[text[at]]).astype(np.int32)),
                       pa.array(Hashed(buf).ranges(at, at + length).view(np.int64)),
                       pa.array(Hashed(buf, _SECOND).ranges(at, at + length).view(np.int64))],
                    names=["key", "f", "copies", "at", "h1", "h2"])

    rows = frags.select("key", "f", "copies", "bytes").mapInArrow(
        explode, "key bigint, f bigint, copies bigint, at int, h1 bigint, h2 bigint")
    twice = cut_lineage(rows.groupBy("h1", "h2").agg(F.sum("copies").alias("n")).where("n > 1")
                        .select("h1", "h2"))
    # Few windows of a crowded key repeat; then the others are not shuffled again.
    met = rows.join(F.broadcast(twice), ["h1", "h2"]) if twice.count() <= BROADCAST_IDS \
        else rows.hint("merge").join(twice, ["h1", "h2"])
    return (met.groupBy("key", "f")
            .agg(F.sort_array(F.collect_list("at")).alias("lo"))  # at most one fragment's windows
            .select("key", "f", "lo", F.col("lo").alias("hi")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, k: int = K) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept (binary)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
                       .alias("text"))
    # Rows are told apart by id; where ids are missing or repeated, by id and
    # text, so that only identical rows fall together (and get equal results).
    unclear = rows.groupBy("id").count().where("id IS NULL OR count > 1").limit(1).count()
    rows = rows.withColumn("uid", F.xxhash64("id", "text") if unclear else F.col("id"))
    per_doc = cut_lineage(removal_runs(rows, length, k).groupBy("uid").agg(F.collect_list(
        F.struct("start", "windows", "times", "lo", "hi")).alias("runs")))
    ids = per_doc.select("uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                yield _cut(batch.slice(a, b - a), length)

    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    cut = narrowed(rows, ids).hint("merge").join(per_doc, "uid").select(
        "id", "text", "runs").mapInArrow(run, schema)
    few = ids.count() <= BROADCAST_IDS
    clean = rows.join(F.broadcast(ids) if few else ids, "uid", "left_anti").select(
        "id", F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"),
        F.col("text").alias("kept"))
    return clean.union(cut)


def _cut(part: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Rows (id, text, runs) without the bytes of their repeated windows."""
    buf, offsets = text_buffer(part.column("text"))
    lists = part.column("runs")
    runs = lists.flatten()
    base = np.repeat(offsets[:-1], lists.value_lengths().to_numpy())
    start, windows, times = (runs.field(c).to_numpy() for c in ("start", "windows", "times"))
    many = runs.field("lo").value_lengths().to_numpy()
    lo, hi = (runs.field(c).flatten().to_numpy() for c in ("lo", "hi"))
    # Equal fragments in a row: the run again, `windows` bytes further each time.
    step, n = np.repeat(windows, many), np.repeat(times, many)
    first = np.repeat(base + start, many)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    shift = np.repeat(first, n) + nth * np.repeat(step, n)
    edge = np.bincount(shift + np.repeat(lo, n), minlength=len(buf) + 1) \
        - np.bincount(shift + np.repeat(hi, n) + length, minlength=len(buf) + 1)
    gone = np.cumsum(edge[:-1]) > 0
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    opens[heads] = gone[heads]
    removed, spans = (np.concatenate([[0], np.cumsum(x)])[offsets] for x in (gone, opens))
    kept_ends = offsets - removed
    kept = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), part.num_rows,
        [None, pa.py_buffer(kept_ends.astype(np.int64)), pa.py_buffer(buf[~gone])])
    return pa.record_batch(
        [part.column("id"), pa.array(np.diff(offsets)), pa.array(np.diff(removed)),
         pa.array(np.diff(spans)), kept.cast(pa.binary())],
        names=["id", "n_bytes", "n_removed", "n_spans", "kept"])
