"""The Z-fast trie against prefixes counted one by one."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import rng
from measures.llm import prefix_trie as T
from measures.llm import queries

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(said):
    members, kids = defaultdict(list), defaultdict(list)
    for c in sorted(said):
        for d in range(len(said[c]) + 1):
            members[tuple(said[c][:d])].append(c)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * words
    return sorted((m[0], len(n), members[n[:-1]][0] if n else -1, len(m), len(kids[n]), leaves[n],
                   saved[n], hashlib.sha256(",".join(
                       str(c) for c in m if len(said[c]) == len(n)).encode()).hexdigest())
                  for n, m in members.items())


def table(found):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in found.collect())


def check(spark, rows, schema=TURNS):
    turns = spark.createDataFrame(rows, schema).repartition(3)
    assert table(T.trie_table(queries.rebuilt(turns))) == brute(rebuilt([r[:4] for r in rows]))


def forest(seed, convs, words):
    """Conversations that often go on as an earlier one did."""
    r, rows, said = rng(seed), [], []
    for c in range(convs):
        old = r.choice(said) if said and r.random() < 0.7 else []
        turns = old[:r.randint(0, len(old))] + [
            ("ab"[i % 2], " ".join(r.choice(words) for _ in range(r.randint(0, 3))))
            for i in range(r.randint(0, 5))]
        said.append(turns)
        rows += [(c * r.choice([1, 1, 7]) if c % 20 else c, i, role, text)
                 for i, (role, text) in enumerate(turns)]
    return rows


def test_random_conversations(spark):
    check(spark, forest(1, 150, ["x", "yy", "z\tz", "é"]))


@pytest.mark.parametrize("small", [True, False])
def test_many_batches_and_both_kinds_of_join(spark, monkeypatch, small):
    monkeypatch.setattr(T, "GROUP", 2)
    monkeypatch.setattr(T, "FIRST_BATCH", 3)
    if not small:
        monkeypatch.setattr(T, "BROADCAST_NODES", 0)
    check(spark, forest(2, 60, ["x", "y"]))


def test_copies_nulls_and_repeated_rows(spark):
    rows = [(c, i, "u", f"same {i}") for c in range(1, 60) for i in range(3)]
    rows += [(None, 0, "u", "nobody's"), (61, None, None, "first"), (61, 0, None, None),
             (61, 0, None, None), (62, 1, "", ""), (62, 2, "a", "b c d")]
    check(spark, rows)


def test_long_conversations_that_part_everywhere(spark):
    long = [("u", f"t{i}") for i in range(120)]
    rows = []
    for c, cut in enumerate([119, 0, 1, 2, 63, 64, 65, 100, 118, 120]):
        turns = long[:cut] + ([] if cut == 120 else [("u", f"own {c}"), ("u", "x " * 5000)])
        rows += [(100 * c + 20 * c, i, *t) for i, t in enumerate(turns)]
    check(spark, rows)


def test_turnless_conversation_is_a_member_of_the_root(spark):
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    check(spark, [(turnless, 0, "u", "gone"), (turnless, 1, "u", "too"), (45, 0, "u", "a")])


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert table(T.trie_table(queries.rebuilt(empty))) == []
    rows = [(c, i, "u", f"w{c % 3}", "x", 1, 2) for c in range(25) for i in range(4)]
    check(spark, rows, TURNS + ", id string, turns int, path int")


def test_exit_nodes_are_found(spark):
    """Every path of the trie, and every path that leaves it, at its own depth."""
    rows = forest(4, 80, ["x", "y", "z"])
    lists = T.turn_lists(spark.createDataFrame(rows, TURNS))
    paths = T.distinct_paths(T.paths_of(lists)).cache()
    inside = F.abs(F.xxhash64("id")) % 2 == 0
    trie = T.build(paths.where(inside))
    known = {r.path[i:i + T.KEY] for r in paths.where(inside).collect()
             for i in range(0, len(r.path), T.KEY)}
    longest = max(r.length for r in paths.collect())
    for r in T.locate(trie, paths, longest).collect():
        keys = [bytes(r.path[i:i + T.KEY]) for i in range(0, len(r.path), T.KEY)]
        assert r.depth == sum(k in known for k in keys)
