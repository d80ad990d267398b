"""Prefix trie of conversations: a Z-fast trie whose nodes are rows.

A conversation is a path of keys: the key of depth d is a 128-bit chained hash
of its first d turns, so equal prefixes, and only these, share a key.  The trie
holds compacted nodes only.  A node's edge covers the depths (lo, hi]; its
handle is the key at the two-fattest depth of that interval (the one divisible
by the greatest power of two), and the table of nodes is hashed on it.

* `locate` finds each path's exit node by fat binary search: an interval of
  depths shrinks by one join on the handle a step, as many steps as the longest
  path has binary digits; one more join finds the edge on which it leaves.
* `insert` works in batches.  Paths that leave the trie by the same new first
  turn form a group; the first GROUP of each group (by hash) are inserted at
  once, as a small compacted trie read off their sorted paths, and the rest are
  located again below it.  So a first turn that a third of all conversations
  share is never handled by one task, and the rounds grow with the logarithm of
  the input.
* `summarise` adds values up the tree by pointer doubling, and `expand` turns
  each edge into one row per depth.

A conversation is one row of 24 bytes a turn; turns, texts and copies are not
carried into the trie.  Rows without a conversation id belong to none.  Null
roles and texts are empty.  Turns of equal number are ordered by the hash of
role and text, null numbers first; repeated rows are repeated turns.  An empty
table has no nodes, not even a root.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from measures.llm.common import ship_package, stored

KEY = 16  # bytes of a prefix key
GROUP = 1000  # paths of a group that are inserted at once
FIRST_BATCH = 16  # one path in so many is inserted before the rest is located
BROADCAST_NODES = 100_000  # at most 10 MB of handles or short edges; more are shuffled
BROADCAST_KEYS = 1_000_000  # and at most so many keys on their edges

NODE = "first binary, lo int, hi int, edge binary, cum array<bigint>, up binary"
PATH = "id binary, length int, path binary, cum array<bigint>"


# --- paths ---------------------------------------------------------------------------------------

def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as key and words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    one = F.struct(
        F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
                      .cast("binary"))).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"))
    return (turns.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("bigint").alias("conv_id"), one.alias("one"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(
                t["key"].alias("key"), t["words"].alias("words"))).alias("turns")))


def paths_of(lists: DataFrame) -> DataFrame:
    """(conv_id, turns) -> (conv_id, id, length, path, cum).  `path` is the keys
    of depths 1.. one after the other, `id` the last one (empty without turns),
    `cum` the words of the first 0, 1, .. turns."""
    ship_package(lists.sparkSession)
    return lists.select("conv_id", "turns").mapInArrow(_chain, "conv_id bigint, " + PATH)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = batch.column("turns")
        ends = np.concatenate([[0], np.cumsum(turns.value_lengths().to_numpy())]).tolist()
        flat = turns.flatten()
        keys, words = flat.field("key").to_pylist(), flat.field("words").to_numpy()
        paths, cums = [], []
        for a, b in zip(ends, ends[1:]):
            last, out = b"", []
            for key in keys[a:b]:
                last = hashlib.md5(last + key, usedforsecurity=False).digest()
                out.append(last)
            paths.append(b"".join(out))
            cums.append(np.concatenate([[0], np.cumsum(words[a:b])]).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array([p[-KEY:] for p in paths], pa.binary()),
             pa.array([len(p) // KEY for p in paths], pa.int32()), pa.array(paths, pa.binary()),
             pa.array(cums, pa.list_(pa.int64()))],
            names=["conv_id", "id", "length", "path", "cum"])


def distinct_paths(paths: DataFrame) -> DataFrame:
    """One row per distinct path, with the number of conversations and the
    least conv_id: equal conversations meet here, once."""
    return paths.groupBy("id").agg(
        F.first("length").alias("length"), F.first("path").alias("path"),
        F.first("cum").alias("cum"), F.count("*").alias("copies"),
        F.min("conv_id").alias("conv_id"))


def key_at(path: Column, depth: Column) -> Column:
    return F.substring(path, (depth - 1) * KEY + 1, F.lit(KEY))


def two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] divisible by the greatest power of two."""
    zeros = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, zeros), zeros)


# --- the trie ------------------------------------------------------------------------------------

class Trie:
    """The compacted nodes below the root, stored in the shared folder."""

    def __init__(self, nodes: DataFrame):
        self.nodes = stored(nodes, "trie-nodes")
        size = self.nodes.agg(F.count("*"), F.sum("hi") - F.sum("lo")).head()
        self.small = size[0] <= BROADCAST_NODES and (size[1] or 0) <= BROADCAST_KEYS

    def lookup(self, rows: DataFrame, table: DataFrame, on: Column) -> DataFrame:
        """rows left-joined with a part of the node table; a key of many rows
        is split by the skew rule where the table is too large to broadcast."""
        if self.small:
            return rows.join(F.broadcast(table), on, "left")
        return rows.hint("merge").join(table, on, "left")


def locate(trie: Trie, paths: DataFrame, longest: int) -> DataFrame:
    """Where each path leaves the trie: `depth` of its longest prefix in it,
    and `exit_first`, the first key of the edge that it leaves before that
    edge's end (null where it leaves at a node)."""
    handles = trie.nodes.select(
        key_at(F.col("edge"), two_fattest(F.col("lo"), F.col("hi")) - F.col("lo")).alias("handle"),
        F.col("lo").alias("h_lo"), F.col("hi").alias("h_hi"),
        F.substring("edge", -KEY, KEY).alias("h_extent"))
    zero = F.lit(0)
    rows = paths.select(*paths.columns, zero.alias("a"), F.col("length").alias("b"),
                        zero.alias("n_lo"), zero.alias("n_hi"),
                        F.lit(b"").alias("n_extent"))
    for _ in range(longest.bit_length()):
        rows = rows.withColumn("f", F.when(F.col("a") < F.col("b"),
                                           two_fattest(F.col("a"), F.col("b"))))
        rows = rows.withColumn("probe", key_at(F.col("path"), F.col("f")))
        met = F.col("handle").isNotNull()
        rows = trie.lookup(rows, handles, F.expr("probe = handle")).select(
            *paths.columns,
            F.when(met, F.col("h_hi")).otherwise(F.col("a")).alias("a"),
            F.when(met | F.col("f").isNull(), F.col("b")).otherwise(F.col("f") - 1).alias("b"),
            *[F.when(met, F.col(f"h_{c}")).otherwise(F.col(f"n_{c}")).alias(f"n_{c}")
              for c in ("lo", "hi", "extent")])
    whole = (F.col("n_hi") == 0) | ((F.col("n_hi") <= F.col("length")) & (
        key_at(F.col("path"), F.col("n_hi")) == F.col("n_extent")))
    rows = rows.withColumn("next", F.when(whole, F.col("n_hi")).otherwise(F.col("n_lo")) + 1)
    rows = rows.withColumn("probe", F.when(F.col("next") <= F.col("length"),
                                           key_at(F.col("path"), F.col("next"))))
    edges = trie.nodes.select(F.col("first").alias("e_first"), F.col("lo").alias("e_lo"),
                              F.col("hi").alias("e_hi"), F.col("edge").alias("e_edge"))
    rows = trie.lookup(rows, edges, F.expr("probe = e_first"))
    same = F.size(F.filter(
        F.sequence(F.lit(1), F.least("e_hi", "length") - F.col("e_lo")),
        lambda i: key_at(F.col("e_edge"), i) == key_at(F.col("path"), F.col("e_lo") + i)))
    depth = F.when(F.col("e_first").isNull(), F.col("next") - 1).otherwise(F.col("e_lo") + same)
    return rows.withColumn("depth", depth).select(
        *paths.columns, "depth",
        F.when(F.col("depth") < F.col("e_hi"), F.col("e_first")).alias("exit_first"))


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (branch, depth, path, cum) -> the compacted nodes of each branch.

    `marks` are the depths of the nodes on the current path; they close as soon
    as the next path leaves above them."""
    branch, base, path, cum, marks = None, 0, b"", [], []
    out: list[tuple] = []

    def close(shared: int) -> None:
        """Emit the edges below `shared`, and mark a node there."""
        while marks[-1] > shared:
            hi = marks.pop()
            lo = max(marks[-1], shared)
            out.append((path[lo * KEY:(lo + 1) * KEY], lo, hi, path[lo * KEY:hi * KEY],
                        cum[lo:hi + 1], path[(lo - 1) * KEY:lo * KEY] if lo else b""))
            if lo > marks[-1]:
                marks.append(lo)

    def emitted() -> pa.RecordBatch:
        types = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()),
                 pa.binary()]
        columns = zip(*out) if out else [[] for _ in types]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["first", "lo", "hi", "edge", "cum", "up"])
        out.clear()
        return batch

    for batch in batches:
        for new, depth, p, c in zip(*(batch.column(n).to_pylist()
                                      for n in ("branch", "depth", "path", "cum"))):
            if new != branch:
                if marks:
                    close(base)
                branch, base, marks = new, depth, [depth]
            else:
                shared = depth
                most = min(len(path), len(p)) // KEY
                while shared < most and path[shared * KEY:(shared + 1) * KEY] == \
                        p[shared * KEY:(shared + 1) * KEY]:
                    shared += 1
                close(shared)
            path, cum = p, c
            marks.append(len(p) // KEY)
        yield emitted()
    if marks:
        close(base)
    yield emitted()


def insert(trie: Trie | None, paths: DataFrame, longest: int) -> Trie:
    """The trie with distinct paths (id, length, path, cum) inserted."""
    spark = paths.sparkSession
    ship_package(spark)
    empty = spark.createDataFrame([], NODE)
    trie = trie or Trie(empty)
    waiting = paths.select("id", "length", "path", "cum").where("length > 0")
    while True:
        found = stored(locate(trie, waiting, longest), "trie-exits")
        branch = key_at(F.col("path"), F.col("depth") + 1)
        place = Window.partitionBy("branch").orderBy(F.xxhash64("id"), "id")
        chosen = (found.where("depth < length").withColumn("branch", branch)
                  .withColumn("place", F.row_number().over(place)).where(f"place <= {GROUP}"))
        grown = (chosen.select("branch", "depth", "path", "cum").repartition("branch")
                 .sortWithinPartitions("branch", "path").mapInArrow(_grow, NODE))
        trie = Trie(_split(trie.nodes, found).unionByName(grown))
        left = found.where("depth < length").withColumn("branch", branch).groupBy("branch").agg(
            F.count("*").alias("n")).where(f"n > {GROUP}")
        # At most one row per GROUP rows that wait.
        if left.limit(1).count() == 0:
            return trie
        waiting = stored(found.where("depth < length").withColumn("branch", branch)
                         .hint("merge").join(left, "branch", "left_semi")
                         .select("id", "length", "path", "cum"), "trie-waiting")


def _split(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """The nodes, cut at the depths where paths leave inside an edge."""
    cuts = found.where("exit_first IS NOT NULL").groupBy("exit_first").agg(
        F.sort_array(F.collect_set("depth")).alias("cuts"))
    rows = nodes.join(cuts, F.expr("first = exit_first"), "left")
    none = F.array().cast("array<int>")
    inner = F.coalesce("cuts", none)
    pieces = F.arrays_zip(F.concat(F.array("lo"), inner).alias("from"),
                          F.concat(inner, F.array("hi")).alias("to"))
    piece = rows.withColumn("piece", F.explode(pieces))
    a, b = F.col("piece")["from"], F.col("piece")["to"]
    return piece.select(
        key_at(F.col("edge"), a - F.col("lo") + 1).alias("first"), a.alias("lo"), b.alias("hi"),
        F.substring("edge", (a - F.col("lo")) * KEY + 1, (b - a) * KEY).alias("edge"),
        F.slice("cum", a - F.col("lo") + 1, b - a + 1).alias("cum"),
        F.when(a == F.col("lo"), F.col("up")).otherwise(
            key_at(F.col("edge"), a - F.col("lo"))).alias("up"))


def build(paths: DataFrame) -> Trie:
    """The trie over distinct paths: a small batch first, then the rest, each
    path located in what stands."""
    longest = paths.agg(F.max("length")).head()[0] or 0
    early = F.abs(F.xxhash64(F.lit("batch"), "id") % FIRST_BATCH) == 0
    trie = insert(None, paths.where(early), longest)
    return insert(trie, paths.where(~early), longest)


# --- what is asked of it -------------------------------------------------------------------------

def summarise(trie: Trie, paths: DataFrame) -> DataFrame:
    """Per compacted node, root included: extent (the key at hi), its place,
    and over its subtree n (conversations), conv_id (least), leaves, spent
    (words of all conversations from the root), held (words of its distinct
    turns); `kids` are its children."""
    nodes = trie.nodes
    root = nodes.sparkSession.createDataFrame(
        [(None, 0, 0, b"", [0], None)], NODE)
    below = nodes.groupBy("up").agg(F.count("*").alias("kids")).withColumnRenamed("up", "k_up")
    ends = paths.select(F.col("id").alias("p_id"), "copies", "conv_id",
                        F.element_at("cum", -1).alias("words"))
    copies = F.coalesce("copies", F.lit(0))
    base = (nodes.unionByName(root)
            .withColumn("extent", F.substring("edge", -KEY, KEY))
            .join(below, F.expr("extent = k_up"), "left")
            .join(ends, F.expr("extent = p_id"), "left"))
    rows = stored(base.select(
        "extent", "lo", "hi", "cum", "up", F.coalesce("kids", F.lit(0)).alias("kids"),
        F.col("up").alias("above"), copies.alias("n"), "conv_id",
        F.when(F.col("kids").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
        (copies * F.coalesce("words", F.lit(0))).alias("spent"),
        (F.element_at("cum", -1) - F.element_at("cum", 1)).alias("held")), "trie-sums")
    sums = ("n", "leaves", "spent", "held")
    while rows.where("above IS NOT NULL").limit(1).count():
        up = rows.where("above IS NOT NULL").groupBy(F.col("above").alias("s_above")).agg(
            *[F.sum(c).alias(f"s_{c}") for c in sums], F.min("conv_id").alias("s_conv_id"))
        # The root has none above it, so the rows below it need no lookup.
        higher = rows.where("above IS NOT NULL").select(
            F.col("extent").alias("h_extent"), F.col("above").alias("h_above"))
        rows = stored(
            trie.lookup(rows, higher, F.expr("above = h_extent AND above <> X''"))
            .join(up, F.expr("extent = s_above"), "left")
            .select("extent", "lo", "hi", "cum", "up", "kids", F.col("h_above").alias("above"),
                    *[(F.col(c) + F.coalesce(f"s_{c}", F.lit(0))).alias(c) for c in sums],
                    F.least("conv_id", "s_conv_id").alias("conv_id")), "trie-sums")
    return rows


def expand(trie: Trie, nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """One row per depth of every edge of the summarised nodes; `ends` (id,
    ends_sha256) are the digests of the conversations that end at a key."""
    over = nodes.select(F.col("extent").alias("u_extent"), F.col("conv_id").alias("u_conv_id"))
    rows = (trie.lookup(nodes, over, F.expr("up = u_extent"))
            .join(ends, F.expr("extent = id"), "left")
            .withColumn("depth", F.explode(F.when(F.col("hi") == 0, F.array(F.lit(0))).otherwise(
                F.sequence(F.col("lo") + 1, F.col("hi"))))))
    before = F.when(F.col("hi") == 0, F.lit(0)).otherwise(
        F.get("cum", F.col("depth") - F.col("lo") - 1))  # words of the turns above
    at_end = F.col("depth") == F.col("hi")
    saved = (F.col("spent") - F.col("n") * before) - (
        F.col("held") - (before - F.element_at("cum", 1)))
    return rows.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"),
        F.when(F.col("depth") == F.col("lo") + 1, F.col("u_conv_id")).when(
            F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(at_end, F.col("kids")).otherwise(1).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.coalesce(F.when(at_end, F.col("ends_sha256")), F.sha2(F.lit(""), 256)).alias(
            "ends_sha256"))


def end_digests(paths: DataFrame) -> DataFrame:
    """(id, ends_sha256): SHA-256 of the conv_ids that end at a key, ascending,
    comma-joined.  The ids are joined in ranges of key and conv_id, whichever
    key they belong to; only these pieces of a digest meet, and are hashed as
    they stream by."""
    ship_package(paths.sparkSession)
    parts = (paths.select("id", "conv_id").repartitionByRange("id", "conv_id")
             .sortWithinPartitions("id", "conv_id")
             .mapInArrow(_join_ids, "id binary, least bigint, part string"))
    return (parts.repartition("id").sortWithinPartitions("id", "least")
            .mapInArrow(_digest, "id binary, ends_sha256 string"))


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, convs = batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()
        if not keys:
            continue
        starts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[i] for i in starts], pa.binary()),
             pa.array([convs[i] for i in starts], pa.int64()),
             pa.array([",".join(map(str, convs[a:b]))
                       for a, b in zip(starts, [*starts[1:], len(keys)])], pa.string())],
            names=["id", "least", "part"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, state = None, None
    for batch in batches:
        ids, digests = [], []
        for key, part in zip(batch.column("id").to_pylist(), batch.column("part").to_pylist()):
            if key == now:
                state.update(b"," + part.encode())
                continue
            if state is not None:
                ids.append(now)
                digests.append(state.hexdigest())
            now, state = key, hashlib.sha256(part.encode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(digests, pa.string())],
                                         names=["id", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())],
            names=["id", "ends_sha256"])


def trie_table(lists: DataFrame) -> DataFrame:
    """(conv_id, turns) -> one row per trie node, expanded."""
    paths = stored(paths_of(lists), "trie-paths")
    distinct = stored(distinct_paths(paths), "trie-distinct")
    trie = build(distinct)
    # Without conversations there is no root either.
    return expand(trie, summarise(trie, distinct), end_digests(paths)).where("n_convs > 0")
