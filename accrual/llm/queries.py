"""Driver queries of the corpus operators, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accrual.llm.best_fit_packing import pack_documents
from accrual.llm.bpe_transducer import count_tokens, read_tokenizer
from accrual.llm.common import ready, table
from accrual.llm.decontaminate import contamination
from accrual.llm.grid_order_join import near_duplicate_vectors
from accrual.llm.hard_negatives import mine_embeddings
from accrual.llm.histogram_sort import shard_documents
from accrual.llm.jaccard_join import jaccard_components
from accrual.llm.language_id import identify_documents
from accrual.llm.license_index import scan_licenses
from accrual.llm.main_text import extract_main_text, train_trees
from accrual.llm.prefix_trie import prefix_trie, rebuilt_paths
from accrual.llm.sentencepiece_backend import encode_texts, read_model
from accrual.llm.warc import deduplicate_pages

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(ready(spark), sf_dir, "documents"))


def op2_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(ready(spark), sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text", "places")


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_pages(table(ready(spark), sf_dir, "pages")).drop("url")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(ready(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(ready(spark), sf_dir, "embeddings"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(ready(spark), sf_dir, "documents"), read_tokenizer())


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(ready(spark), sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(ready(spark), sf_dir, "documents").select("doc_id", "text")
    return encode_texts(documents, read_model(), keep_ids=False, keep_text=False)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(ready(spark), sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages, train_trees(pages)).drop("html")


def op10_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(ready(spark), sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_documents(documents).drop("text", "lang")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt_paths(table(ready(spark), sf_dir, "conversations")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_embeddings(table(ready(spark), sf_dir, "embeddings"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(ready(spark), sf_dir, "documents"), read_tokenizer())


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP4_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_SQL_WORDS} AS w FROM documents
), b AS (
  SELECT item_id, {_SQL_WORDS} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, w[i + 1:i + 13] AS ws
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT len(ws) AS n FROM win
), spots AS (
  SELECT rid, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM d, lengths
), hit AS (
  SELECT rid, i, n, item_id FROM (SELECT rid, i, n, w[i + 1:i + n] AS ws FROM spots) JOIN win USING (ws)
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

_SQL_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, {5 * part + 1}, 5) AS INTEGER)"
    f" >> {shift}) & 31) + 1, 1)"
    for part in range(8)
    for shift in (15, 10, 5, 0)
)

OP3_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_SQL_LETTERS} AS payload_digest,
         min(page_id) OVER (PARTITION BY h) AS first_page FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
FROM d
"""

OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings
), good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
  SELECT a.rid AS a, b.rid AS b FROM good a JOIN good b
    ON a.label = b.label AND a.rid <> b.rid AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT rid, vec_id AS root FROM v
  UNION
  SELECT links.a, reach.root FROM links JOIN reach ON reach.rid = links.b
), least AS (
  SELECT rid, min(root) AS component_id FROM reach GROUP BY rid
), number AS (
  SELECT a AS rid, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, FALSE) AS kept
FROM v JOIN least USING (rid) LEFT JOIN number USING (rid)
"""

OP7_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT rid, w[i + 1:i + 3] AS gram
  FROM (SELECT rid, w, unnest(range(greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), links AS (
  SELECT x.a, x.b FROM (
    SELECT l.rid AS a, r.rid AS b, count(*) AS both FROM s l JOIN s r ON l.gram = r.gram AND l.rid <> r.rid
    GROUP BY l.rid, r.rid) x
  JOIN n p ON p.rid = x.a JOIN n q ON q.rid = x.b WHERE 100 * x.both >= 90 * (p.n + q.n - x.both)
), reach AS (
  SELECT rid, doc_id AS root FROM d
  UNION
  SELECT links.a, reach.root FROM links JOIN reach ON reach.rid = links.b
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (rid) JOIN (SELECT rid, min(root) AS component_id FROM reach GROUP BY rid) USING (rid)
"""

# CRC-32 of a decimal number, bit by bit.
_SQL_CRC = (
    "xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),"
    " lambda c: CAST(ord(c) AS BIGINT))), lambda h, c: list_reduce([xor(h, c), 0, 0, 0, 0, 0, 0, 0, 0],"
    " lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
)

OP11_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, '')) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, l, {_SQL_CRC} % 9 AS h FROM own
), p AS (
  SELECT c.conv_id, list_concat(coalesce(b.l, [])[1:c.h], c.l[c.h + 1:]) AS p
  FROM h c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), member AS (
  SELECT conv_id, len(p) AS total, unnest(range(len(p) + 1)) AS d, p FROM p
), node AS (
  SELECT p[1:d] AS path, d, min(conv_id) AS conv_id, count(*) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
           FILTER (WHERE total = d), '')) AS ends
  FROM member GROUP BY path, d
), child AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL
), own_sums AS (
  SELECT node.*, coalesce(child.n, 0) AS children,
         CASE WHEN node.d = 0 THEN 0 ELSE (node.n - 1) * strlen(path[node.d].t) END AS saved
  FROM node LEFT JOIN child USING (path, d)
), spread AS (
  SELECT path, children, saved, unnest(range(d + 1)) AS a FROM own_sums
), tree AS (
  SELECT path[1:a] AS path, a AS d, count(*) FILTER (WHERE children = 0) AS leaves, sum(saved) AS saved
  FROM spread GROUP BY ALL
)
SELECT s.conv_id, s.d AS depth, up.conv_id AS parent_conv_id, s.n AS n_convs, s.children AS n_children,
       tree.leaves AS n_leaves, CAST(tree.saved AS BIGINT) AS saved_tokens, s.ends AS ends_sha256
FROM own_sums s JOIN tree USING (path, d) LEFT JOIN node up ON up.path = s.path[1:s.d - 1] AND up.d = s.d - 1
"""

OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pair AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0
), near AS (
  SELECT * FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
)
SELECT n.anchor_id, n.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY n.anchor, n.rid ORDER BY f.score DESC, f.vec_id) AS INTEGER) AS rank,
       f.vec_id AS negative_id, n.score AS positive_score, f.score AS negative_score
FROM near n JOIN pair f ON f.anchor = n.anchor AND NOT f.same
WHERE 80 * n.score <= 100 * f.score AND f.score <= n.score
QUALIFY row_number() OVER (PARTITION BY n.anchor, n.rid ORDER BY f.score DESC, f.vec_id) <= 5
"""

_QUERIES: dict[str, QueryFn] = {
    f.__name__: f
    for f in (
        op1_histogram_shards,
        op2_license_index,
        op3_warc_revisits,
        op4_decontaminate,
        op5_grid_order_join,
        op6_token_counts,
        op7_jaccard_join,
        op8_sentencepiece,
        op9_main_text,
        op10_output_codes,
        op11_prefix_trie,
        op12_hard_negatives,
        op13_best_fit_packing,
    )
}
_ORACLES = {
    "op3_warc_revisits": OP3_SQL,
    "op4_decontaminate": OP4_SQL,
    "op5_grid_order_join": OP5_SQL,
    "op7_jaccard_join": OP7_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}


def callables() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
