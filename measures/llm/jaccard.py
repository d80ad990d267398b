"""Exact n-gram Jaccard join with a token-group matrix.

A document is its set of distinct runs of `size` words.  Two link when their
Jaccard similarity is at least `percent` / 100; the result is the connected
components of all links.

1. Document frequencies.  Tasks send packed token arrays to token buckets;
   each bucket sends back, packed by batch of documents, the tokens that occur
   in two documents or more.  Tokens common in a sample skip the trip (they
   are known to be shared) and come last in the token order; otherwise rarer
   tokens come first.  A document with too few shared tokens to reach the
   threshold with anyone is settled here.
2. Equal sets become one document.
3. Groups.  Similar documents (equal least token hash) form groups of about
   `GROUP` documents; a group stores its members' sets, the union of their
   tokens, and the union of their prefix tokens.  The latter are the matrix:
   (token, group).  Linked documents share a prefix token, so each row of the
   matrix names the groups that may link.
4. Groups are opened in two rounds: first each group with the leading group of
   each of its matrix rows; then, of the groups that still lie in different
   components, all that share a row.  When a group is opened, each document
   is first bounded by its overlap with the other group's union, and only
   documents that pass are compared with the members, exactly.

Rules
- null, empty or wordless text has an empty set and links with nothing; a
  text of fewer than `size` words has one token, its whole word sequence.
- rows that share an id are one document and link to each other; rows with a
  null id are never linked and have a null component.
- an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.llm import words as W
from measures.llm.common import (blocks_for, cut_lineage, shared_path, ship_package,
                                 text_buffer, text_chunks)
from measures.llm.components import components

SIZE = 5
PERCENT = 80
GROUP = 48
BATCH_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
SAMPLE_DOCS = 20_000
COMMON_IN = 200  # a token in one of so many sampled documents is common
_LOW = np.uint64((1 << 48) - 1)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct token hashes of each text."""
    buf, offsets = text_buffer(texts)
    _, _, hashes, first = W.find_words(buf, offsets, W.SPACED)
    runs = W.run_hashes(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(runs[a:b - size + 1]))
        else:
            out.append(W.sequence_hash(hashes[a:b]) if b > a else hashes[:0])
    return out


def needed(n: int, percent: int = PERCENT) -> int:
    """Least overlap of a set of n with any set it links to."""
    return -(-percent * n // 100)


def common_tokens(docs: DataFrame, size: int, sample: int, one_in: int) -> np.ndarray:
    """Tokens in at least one of `one_in` sampled documents.  The sample has at
    most `sample` rows and only orders tokens; results don't depend on it."""
    ids = docs.select("id").orderBy(F.xxhash64("id"), "id").limit(sample)
    # At most `sample` ids are broadcast.
    texts = docs.join(F.broadcast(ids.distinct()), "id", "left_semi").select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_chunks(batch.column("text")):
                sets = shingle_sets(batch.column("text").slice(a, b - a), size)
                tokens, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.record_batch([pa.array(tokens.view(np.int64)), pa.array(n)],
                                      names=["token", "n"])

    counts = texts.mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(
        F.sum("n").alias("n"))
    least = max(3, -(-ids.count() // one_in))
    # Every sampled document holds few of them on average: at most
    # one_in * (mean set size) tokens can be this common.
    found = counts.where(F.col("n") >= least).select("token").toLocalIterator()
    return np.sort(np.array([r.token for r in found], np.int64).view(np.uint64))


def _pack(arrays: list[np.ndarray], kind) -> bytes:
    return np.concatenate(arrays).astype(kind).tobytes() if arrays else b""


SENT = "bucket int, batch bigint, counts binary, low binary, high binary, ids binary"


def send_tokens(docs: DataFrame, size: int, n_buckets: int, common) -> DataFrame:
    """Packed tokens of each batch of documents, one row per token bucket, and
    one row per batch (bucket -1) with ids, set sizes and common tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = common.value
        number = TaskContext.get().partitionId() << 32
        for record in batches:
            for a, b in text_chunks(record.column("text"), BATCH_BYTES):
                part = record.slice(a, b - a)
                yield from _send(part, number, hot, size, n_buckets)
                number += 1

    return docs.mapInArrow(run, SENT)


def _send(part: pa.RecordBatch, number: int, hot: np.ndarray, size: int,
          n_buckets: int) -> Iterator[pa.RecordBatch]:
    n_docs = part.num_rows
    sets: list[np.ndarray] = []
    for a, b in text_chunks(part.column("text")):
        sets += shingle_sets(part.column("text").slice(a, b - a), size)
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets)
    sets.clear()
    doc = np.repeat(np.arange(n_docs), sizes)
    is_hot = np.zeros(len(tokens), bool)
    if len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens
    rows = [(-1, number,
             _pack([sizes, np.bincount(doc[is_hot], minlength=n_docs)], np.uint32),
             tokens[is_hot].tobytes(), b"",
             part.column("id").to_numpy(zero_copy_only=False).tobytes())]
    doc, tokens = doc[~is_hot], tokens[~is_hot]
    bucket = ((tokens >> np.uint64(48)) % np.uint64(n_buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")  # by bucket, then document
    doc, tokens, bucket = doc[order], tokens[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
    for k in range(n_buckets):
        own = slice(cuts[k], cuts[k + 1])
        if cuts[k] < cuts[k + 1]:
            rows.append((k, number, _pack([np.bincount(doc[own], minlength=n_docs)], np.uint32),
                         _pack([tokens[own] & np.uint64(0xFFFFFFFF)], np.uint32),
                         _pack([(tokens[own] & _LOW) >> np.uint64(32)], np.uint16), b""))
    yield _rows(rows, SENT)


_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(),
          "array<bigint>": pa.list_(pa.int64())}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split(" ") for x in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.record_batch([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds, strict=True)],
                           names=list(names))


REPLY = "batch bigint, counts binary, tokens binary, dfs binary, ids binary"


def reply_shared(bucket: pa.Table) -> pa.Table:
    """Of one token bucket: per batch, the tokens of two documents or more."""
    k = bucket.column("bucket")[0].as_py()
    rows, values, docs, batches = [], [], [], bucket.to_pylist()
    for r in batches:
        counts = np.frombuffer(r["counts"], np.uint32)
        if k < 0:
            rows.append((r["batch"], r["counts"], r["low"], b"", r["ids"]))
            continue
        value = (np.frombuffer(r["high"], np.uint16).astype(np.uint64) << np.uint64(32)) \
            | np.frombuffer(r["low"], np.uint32).astype(np.uint64)
        values.append(value)
        docs.append(counts)
    if values:
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        cut = np.flatnonzero(np.diff(ordered, prepend=ordered[0] ^ np.uint64(1)))
        df = np.empty(len(every), np.int64)
        df[order] = np.repeat(np.diff(np.append(cut, len(ordered))),
                              np.diff(np.append(cut, len(ordered))))
        at = 0
        for r, counts, value in zip(batches, docs, values, strict=True):
            own = df[at:at + len(value)]
            at += len(value)
            kept = own >= 2
            if kept.any():
                doc = np.repeat(np.arange(len(counts)), counts)[kept]
                token = value[kept] | (np.uint64(k) << np.uint64(48))
                rows.append((r["batch"], _pack([np.bincount(doc, minlength=len(counts))], np.uint32),
                             token.tobytes(), _pack([np.minimum(own[kept], 2**31)], np.uint32),
                             b""))
    return pa.Table.from_batches([_rows(rows, REPLY)])


SETTLED = ("id bigint, n int, s1 bigint, s2 bigint, least bigint, tokens binary, prefix binary")


def settle(percent: int, batch: pa.Table) -> pa.Table:
    """Per document of one batch: set size, and for those that may link their
    signature, shared tokens (sorted) and shared prefix tokens."""
    rows = batch.to_pylist()
    head = next(r for r in rows if not r["dfs"])
    ids = np.frombuffer(head["ids"], np.int64)
    n_docs = len(ids)
    both = np.frombuffer(head["counts"], np.uint32)
    sizes, n_hot = both[:n_docs].astype(np.int64), both[n_docs:]
    docs, tokens = [np.repeat(np.arange(n_docs), n_hot)], [np.frombuffer(head["tokens"], np.uint64)]
    order = [np.full(len(tokens[0]), 2**40, np.int64)]  # common tokens come last
    for r in rows:
        if r["dfs"]:
            counts = np.frombuffer(r["counts"], np.uint32)
            docs.append(np.repeat(np.arange(len(counts)), counts))
            tokens.append(np.frombuffer(r["tokens"], np.uint64))
            order.append(np.frombuffer(r["dfs"], np.uint32).astype(np.int64))
    doc, token, rank = map(np.concatenate, (docs, tokens, order))
    place = np.lexsort((token, rank, doc))
    doc, token = doc[place], token[place]
    cuts = np.searchsorted(doc, np.arange(n_docs + 1))
    out = []
    for d in range(n_docs):
        n, shared = int(sizes[d]), token[cuts[d]:cuts[d + 1]]
        if n == 0 or len(shared) < needed(n, percent):
            out.append((int(ids[d]), n, None, None, None, None, None))
            continue
        prefix = shared[:max(n - needed(n, percent) + 1 - (n - len(shared)), 0)]
        hashed = W.mix(shared)
        # A set with tokens of its own has no equal: its id is signed too.  Sets of one id
        # that agree in size and shared tokens have the same links.
        signed = hashed if len(shared) == n else np.append(
            hashed, W.mix(ids[d:d + 1].view(np.uint64)))
        out.append((int(ids[d]), n, int(np.sum(signed, dtype=np.uint64).view(np.int64)),
                    int(np.bitwise_xor.reduce(signed * np.uint64(0x9E3779B97F4A7C15))
                        .view(np.int64)), int(hashed.min().view(np.int64)),
                    np.sort(shared).tobytes(), prefix.tobytes()))
    return pa.Table.from_batches([_rows(out, SETTLED)])


def set_sizes(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_chunks(batch.column("text")):
            part = batch.slice(a, b - a)
            n = [len(s) for s in shingle_sets(part.column("text"), size)]
            yield pa.record_batch([part.column("id"), pa.array(n, pa.int64()), part.column("id")],
                                  names=["id", "n_shingles", "component_id"])


class Links:
    """Union-find over the documents opened in one task call."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (u := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(u, u)
            x = u
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def unpack(payload: dict) -> tuple[list[int], list[int], list[np.ndarray], np.ndarray]:
    ends = np.cumsum(payload["lengths"])
    flat = np.frombuffer(payload["tokens"], np.uint64)
    return payload["ids"], payload["sizes"], np.split(flat, ends[:-1]), \
        np.frombuffer(payload["every"], np.uint64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted distinct arrays."""
    if not len(a) or not len(b):
        return 0
    if len(a) > len(b):
        a, b = b, a
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))


def open_groups(one: dict, other: dict | None, percent: int) -> Iterator[tuple]:
    """Links between the documents of two groups (or inside one), as many as
    it takes to connect what is linked: the groups' own links are known."""
    links = Links()
    for known in (one, other or one):
        for a, b in zip(known["a"], known["b"], strict=True):
            links.join(a, b)
    ids, sizes, sets, _ = unpack(one)
    ids2, sizes2, sets2, every = unpack(other) if other else (ids, sizes, sets, None)
    for i in range(len(ids)):
        if other and overlap(sets[i], every) < needed(sizes[i], percent):
            continue  # the union of the group can't reach the threshold
        for j in range(len(ids2) if other else i):
            if links.find(ids[i]) == links.find(ids2[j]):
                continue
            small, large = sorted((sizes[i], sizes2[j]))
            if 100 * small < percent * large:
                continue
            both = overlap(sets[i], sets2[j])
            if 100 * both >= percent * (sizes[i] + sizes2[j] - both):
                links.join(ids[i], ids2[j])
                yield ids[i], ids2[j]


GROUPED = ("g bigint, ids array<bigint>, sizes array<bigint>, lengths array<bigint>, "
           "tokens binary, every binary, prefix array<bigint>, a array<bigint>, b array<bigint>")


def build_group(percent: int, members: pa.Table) -> pa.Table:
    rows = sorted(members.to_pylist(), key=lambda r: r["id"])
    sets = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
    prefix = np.unique(np.concatenate([np.frombuffer(r["prefix"], np.uint64) for r in rows]))
    group = {"ids": [r["id"] for r in rows], "sizes": [r["n"] for r in rows],
             "lengths": [len(s) for s in sets], "tokens": _pack(sets, np.uint64),
             "every": np.unique(np.concatenate(sets)).tobytes(), "a": [], "b": []}
    found = list(open_groups(group, None, percent))
    return pa.Table.from_batches([_rows([(
        rows[0]["g"], group["ids"], group["sizes"], group["lengths"], group["tokens"],
        group["every"], prefix.view(np.int64).tolist(),
        [x for x, _ in found], [y for _, y in found])], GROUPED)])


def open_pairs(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Exact links between the documents of each pair (g, h) of groups."""
    payload = F.struct("ids", "sizes", "lengths", "tokens", "every", "a", "b")
    left = groups.select("g", payload.alias("one"))
    right = groups.select(F.col("g").alias("h"), payload.alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                found += open_groups(batch.column("one")[i].as_py(),
                                     batch.column("other")[i].as_py(), percent)
            yield _rows(found, "a bigint, b bigint")

    joined = (pairs.select("g", "h").hint("merge").join(left, "g")
              .hint("merge").join(right, "h").select("one", "other"))
    return joined.mapInArrow(run, "a bigint, b bigint")


def joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels after further links: components of the components."""
    a, b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
            for c in ("a", "b"))
    tops = more.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    merged = components(tops.where("a <> b")).withColumnsRenamed({"node": "old", "label": "new"})
    # A label that had no link before is a document of its own.
    everyone = labels.union(tops.select("a", "a")).union(tops.select("b", "b")).distinct()
    return cut_lineage(everyone.hint("merge").join(merged, everyone.label == merged.old, "left")
                       .select("node", F.coalesce("new", "label").alias("label")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles, component_id (least id reachable by links)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    named = rows.where("id IS NOT NULL")
    n_bytes = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = min(blocks_for(n_bytes, BUCKET_BYTES), 30_000)
    common = spark.sparkContext.broadcast(common_tokens(named, size, SAMPLE_DOCS, COMMON_IN))

    sent = send_tokens(named, size, n_buckets, common)
    reply = sent.groupBy("bucket").applyInArrow(reply_shared, REPLY)
    path = shared_path(spark, "jaccard")
    reply.groupBy("batch").applyInArrow(
        lambda batch: settle(percent, batch), SETTLED).write.parquet(path + "/settled")
    settled = spark.read.schema(SETTLED).parquet(path + "/settled")

    # Equal sets are one document: the least id of each signature stands for all.
    able = settled.where("tokens IS NOT NULL")
    equal = cut_lineage(able.groupBy("s1", "s2", "n").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    same = cut_lineage(able.select("id", "s1", "s2", "n").hint("merge").join(
        equal, ["s1", "s2", "n"]).select("id", "rep"))
    reps = equal.where("rep IS NOT NULL").select(F.col("rep").alias("id"), "s1", "s2", "n")
    sets = able.join(reps, ["id", "s1", "s2", "n"], "left_semi").dropDuplicates(
        ["id", "s1", "s2", "n"])

    # Groups of similar documents; a large one is split by id.
    alike = sets.select("id", "least")
    parts = cut_lineage(alike.groupBy("least").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(GROUP)).alias("parts")))
    keyed = sets.hint("merge").join(parts, "least").withColumn(
        "g", F.xxhash64("least", F.pmod(F.xxhash64("id"), "parts")))
    keyed.select("g", "id", "n", "tokens", "prefix").groupBy("g").applyInArrow(
        lambda members: build_group(percent, members), GROUPED).write.parquet(path + "/groups")
    groups = spark.read.schema(GROUPED).parquet(path + "/groups")
    inner = groups.select(F.explode(F.arrays_zip("a", "b")).alias("x")).select("x.a", "x.b")

    # Round 1: each group with the leading group of each of its matrix rows.
    matrix = groups.select("g", F.explode("prefix").alias("token"))
    leaders = cut_lineage(matrix.groupBy("token").agg(
        F.min("g").alias("h"), F.count(F.lit(1)).alias("groups")).where("groups > 1"))
    rows_of = matrix.hint("merge").join(leaders, "token")
    first = cut_lineage(rows_of.where("g <> h").select("g", "h").distinct())
    links = cut_lineage(inner.union(open_pairs(first, groups, percent)))
    labels = components(links)

    # Round 2: groups that share a row and don't lie in one component alone.
    lone = groups.select("g", F.explode("ids").alias("node")).join(labels, "node", "left").select(
        "g", F.coalesce("label", "node").alias("label"))
    lying = cut_lineage(lone.groupBy("g").agg(F.min("label").alias("low"),
                                              F.max("label").alias("high")))
    placed = cut_lineage(rows_of.select("token", "g").hint("merge").join(lying, "g"))
    mixed = placed.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("u")).where(
        "l < u").select("token")
    open_rows = cut_lineage(placed.hint("merge").join(mixed, "token"))
    x, y = open_rows.alias("x"), open_rows.alias("y")
    rest = (x.join(y, F.expr("x.token = y.token AND x.g < y.g AND NOT "
                             "(x.low = x.high AND y.low = y.high AND x.low = y.low)"))
            .select(F.col("x.g").alias("g"), F.col("y.g").alias("h")).distinct())
    done = first.select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h"))
    second = cut_lineage(rest.join(done, ["g", "h"], "left_anti"))
    if second.limit(1).count():
        more = cut_lineage(open_pairs(second, groups, percent))
        if more.limit(1).count():
            labels = joined(labels, more)

    # Back to all documents.
    known = cut_lineage(same.hint("merge").join(
        labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "id", F.coalesce("label", "rep").alias("label"))
        .groupBy("id").agg(F.min("label").alias("label")))
    nameless = rows.where("id IS NULL").mapInArrow(
        functools.partial(set_sizes, size), "id bigint, n_shingles bigint, component_id bigint")
    out = settled.select("id", F.col("n").cast("bigint").alias("n_shingles")).join(
        known, "id", "left").select(
        "id", "n_shingles", F.coalesce("label", "id").alias("component_id"))
    return out.union(nameless)
