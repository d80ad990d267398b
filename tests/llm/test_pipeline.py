"""The pipeline against its stages' rules, and the registered queries."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from helpers import rng, sentence
from measures.llm import queries
from test_decontaminate import brute as hits
from test_jaccard import shingles

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark labels pages".split()


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    r, d = rng(21), str(tmp_path_factory.mktemp("sf"))
    items = [(i, sentence(r, 20)) for i in range(3)]
    rows = []
    for i in range(240):
        words = sentence(r, r.randint(20, 50)).split()
        if i % 4 == 0:
            words[3:3] = ["vileword", "nastyone", "vileword"]
        rows.append([i, " ".join(words)])
    rows += [[300, rows[1][1]], [301, rows[1][1] + " tail"], [302, items[0][1] + " x"],
             [303, None], [304, ""], [305, None], [306, sentence(r, 5000)]]
    docs = [(i, t, "en", None if i % 7 == 0 else f"src{i % 3}", 1, f"s{i}", 0.5) for i, t in rows]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, "
                                "n_chars bigint, slot string, score double"
                          ).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)],
                          "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, {i: t for i, t in rows}, items


def test_run_against_brute_force(spark, small):
    d, docs, items = small
    got = corpus_pipeline.run(spark, d)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "slot", "score",
                           "mix_slot", "place"]
    left = {i: t for i, t in docs.items() if not (i < 240 and i % 4 == 0)}
    left = {i: t for i, t in left.items() if i == max(j for j in left if (left[j] or "") == (t or ""))}
    for i in sorted(left):
        mine = shingles(left.get(i))
        for j in [j for j in sorted(left) if j > i]:
            other = shingles(left[j])
            if mine and 100 * len(mine & other) >= 80 * len(mine | other):
                del left[j]
    bad = hits(list(left.values()), items)
    want = sorted(i for i, h in zip(left, bad) if not h[3])
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == want
    assert {r.doc_id: r.text for r in rows} == {i: docs[i] for i in want}
    assert len({(r.mix_slot, r.place) for r in rows}) == len(rows)


def test_stages_on_an_empty_table(spark, small):
    empty = spark.read.parquet(f"{small[0]}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small[0]).count() == 0, name


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = __spark_entry__.queries()[name](spark, SF)
    want = con.sql(queries.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == \
        sorted(want.select(", ".join(columns)).fetchall(), key=str)


def test_all_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {n[:n.index("_") + 1] for n in names if n[:2] == "op"}
    assert "pipeline" in names
