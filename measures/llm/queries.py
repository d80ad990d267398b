"""One query per corpus operator over the driver tables, and their SQL twins.

Each takes (spark, sf_dir), reads whole tables and returns its full result.
The checked-in parameters are the production ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measures.llm import (decontaminate, exact_dedup, jaccard, lexical_search, mixing, prefix_trie,
                          quality, secrets, sentence_spans, suffix_dedup, token_counts, toxicity,
                          warc)
from measures.llm.common import shared_path

TOXIC_AT = 0.5
QUALITY_AT = 0.3
RANKED = 20
# Target shares of the mix; every other source has share 1.
MIX_SHARES = {"src0": 6, "src1": 4, "src2": 3, "src3": 2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(label: str) -> str:
    """A table name that no other run uses."""
    return f"{label}_{uuid.uuid4().hex}"


def op1_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_SHARES).withColumnRenamed(
        "id", "doc_id")


def op2_fm_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"),
                                             table(spark, sf_dir, "benchmark"))
    return decontaminate.contaminated(found).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_token_group_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed(
        "id", "doc_id")


def op4_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_fold(toxicity.score(docs, index), TOXIC_AT)


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeated_spans(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_sentences", "n_removed",
        F.octet_length("kept").cast("bigint").alias("kept_bytes"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op6_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, fresh_name("digest_index"))
    return index.ingest(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents")).withColumnRenamed(
        "id", "doc_id")


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    crawled, lean = shared_path(spark, "warc"), shared_path(spark, "warc-deduplicated")
    warc.write_archive(table(spark, sf_dir, "pages"), crawled)
    warc.write_deduplicated(spark, crawled, lean)
    return warc.read_archive(spark, lean).select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        "refers_to")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))


def op10_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, bad_share = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, bad_share, QUALITY_AT).withColumnRenamed("id", "doc_id")
    return toxicity.with_fold(scored, QUALITY_AT)


def op11_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    many = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"), many("assign").alias("n_assign"),
        many("access").alias("n_access"), many("hex").alias("n_hex"),
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(secrets.in_order(F.concat("base", "added"))).alias("spans"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """The contract's conversations: the first h turns of conv_id - conv_id % 20,
    then the own turns after the first h."""
    own = prefix_trie.turn_lists(turns)
    heads = own.where("conv_id % 20 = 0").select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    none = F.slice("turns", 1, 0)
    return (own.join(heads, F.expr("conv_id - conv_id % 20 = head_id"), "left")
            .select("conv_id", F.concat(
                F.coalesce(F.slice("head", F.lit(1), h), none),
                F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns")))


def op12_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_table(rebuilt(table(spark, sf_dir, "conversations")))


def op13_rmq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), RANKED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pfair_mix": op1_pfair_mix,
    "op2_fm_decontaminate": op2_fm_decontaminate,
    "op3_token_group_jaccard": op3_token_group_jaccard,
    "op4_toxicity_neighbours": op4_toxicity_neighbours,
    "op5_sentence_spans": op5_sentence_spans,
    "op6_digest_index": op6_digest_index,
    "op7_token_counts": op7_token_counts,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_pairwise_quality": op10_pairwise_quality,
    "op11_entropy_secrets": op11_entropy_secrets,
    "op12_zfast_trie": op12_zfast_trie,
    "op13_rmq_search": op13_rmq_search,
}

ORACLES: dict[str, str] = {
    "op2_fm_decontaminate": """
WITH folded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size,
         array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
        FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM folded CROSS JOIN sizes WHERE len(w) >= size)),
hits AS (
  SELECT doc_id, i, p.size, item_id FROM places p JOIN windows USING (win) WHERE p.size = windows.size),
words_hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM folded LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
""",
    "op3_token_group_jaccard": """
WITH RECURSIVE folded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + least(len(w), 5) - 1], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i
        FROM folded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
""",
    "op6_digest_index": """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op11_entropy_secrets": secrets.oracle_sql(),
    "op12_zfast_trie": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(strlen(role)::VARCHAR || ':' || role || text ORDER BY turn NULLS FIRST, md5(strlen(role)::VARCHAR || ':' || role || text)) AS said,
         list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) ORDER BY turn NULLS FIRST, md5(strlen(role)::VARCHAR || ':' || role || text)) AS words
  FROM turns GROUP BY conv_id),
hashed AS (
  SELECT *, (4294967295 - list_reduce(
      list_prepend(4294967295::BIGINT, [ord(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')]),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT for i in range(8)]),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END))) % 4 AS h
  FROM own),
rebuilt AS (
  SELECT a.conv_id,
         list_concat(coalesce(b.said[1:a.h], []), a.said[a.h + 1:]) AS said,
         list_concat(coalesce(b.words[1:a.h], []), a.words[a.h + 1:]) AS words
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
places AS (
  SELECT conv_id, len(said) AS n, d, sha256(array_to_string([md5(x) for x in said[1:d]], ' ')) AS key,
         sha256(array_to_string([md5(x) for x in said[1:d - 1]], ' ')) AS up,
         CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM (SELECT *, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT key, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
  FROM places GROUP BY key, d),
kids AS (SELECT up, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
whole AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.key),
paths AS (SELECT DISTINCT key, d, unnest(list_transform(range(0, d + 1), lambda i: sha256(array_to_string([md5(x) for x in said[1:i]], ' ')))) AS above
  FROM (SELECT DISTINCT said[1:d] AS said, d, key FROM (
    SELECT said, d, sha256(array_to_string([md5(x) for x in said[1:d]], ' ')) AS key
    FROM (SELECT said, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)))),
sums AS (
  SELECT above, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
         sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM paths JOIN whole USING (key, d) GROUP BY above)
SELECT a.conv_id, a.d AS depth, CASE WHEN a.d > 0 THEN b.conv_id END AS parent_conv_id, a.n_convs,
       a.n_children, n_leaves, saved_tokens, sha256(a.ends) AS ends_sha256
FROM whole a JOIN sums ON sums.above = a.key LEFT JOIN nodes b ON b.key = a.up AND b.d = a.d - 1
""",
    "op8_warc_revisits": """
SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN strlen(payload) >= 100 AND page_id > first_id THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN strlen(payload) >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS payload,
             min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
""",
    "op13_rmq_search": """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
           translate(string_agg(DISTINCT coalesce(text, ''), chr(10)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id),
sums AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM texts WHERE len(w) > 0),
asked AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest(w) AS term FROM items) GROUP BY item_id, term),
held AS (
  SELECT doc_id, term, n, count(*) AS tf
  FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM texts)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term, n),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight
  FROM held, sums GROUP BY term),
scores AS (
  SELECT item_id, doc_id, sum(repeats * weight * (1000000000 * tf // (
           1000 * tf + 12 * (100 - 25 + 25 * n * n_docs // n_terms))))::BIGINT AS score
  FROM held JOIN weights USING (term) JOIN asked USING (term), sums GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 20
""",
}
