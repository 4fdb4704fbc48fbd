"""Registered queries of the subpackage, each over its whole table, and the SQL of those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.decontamination import contaminated
from tallyworks.llm.embedding_dedup import embedding_near_duplicates
from tallyworks.llm.language_model import language_scores
from tallyworks.llm.license_scan import license_scan
from tallyworks.llm.line_dedup import dedup_lines
from tallyworks.llm.packing import packed
from tallyworks.llm.pii import find_pii
from tallyworks.llm.quality import score_quality
from tallyworks.llm.ranked_search import ranked_search
from tallyworks.llm.simhash import near_duplicates
from tallyworks.llm.spelling import spelling_variants
from tallyworks.llm.url_filter import host_of, judge_urls
from tallyworks.llm.word_bpe import encoded

URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Hosts whose pages make up the list of the URL query: parts of names of unwanted sites.
UNWANTED = r"(^|[.-])(ads|adult|bets|casino|pills|spam)[.-]|-(bets|farm|pills|track|win|x)\."


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packed(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every URL of pages. Listed are the URLs on hosts with unwanted names."""
    pages = read(spark, sf_dir, "pages")
    listed = pages.select("url").filter(host_of(F.col("url")).rlike(UNWANTED))
    return judge_urls(pages, listed, URL_RULES)


OP8_SQL = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
k AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/)$', '') AS key FROM p),
listed AS (
  SELECT DISTINCT key FROM k WHERE key <> '' AND regexp_matches(host,
    '(^|[.-])(ads|adult|bets|casino|pills|spam)[.-]|-(bets|farm|pills|track|win|x)\.')),
rules(kind, rhost, rpath) AS (VALUES ('allow','org','/'), ('block','example.org','/es/'),
  ('block','example.org','/en/1'), ('allow','com','/fr/'), ('block','com','/de/')),
fit AS (
  SELECT k.page_id, k.host, k.path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
    max_by(kind, length(rhost || rpath)) AS kind
  FROM k JOIN rules ON (k.host = rhost OR ends_with(k.host, '.' || rhost)) AND starts_with(k.path, rpath)
  GROUP BY ALL)
SELECT k.page_id, k.host, k.path, fit.rule,
  coalesce(fit.kind, CASE WHEN listed.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM k LEFT JOIN fit USING (page_id) LEFT JOIN listed ON k.key = listed.key
"""

def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate component of every vector."""
    return embedding_near_duplicates(read(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links,
  (SELECT min(b) FROM r WHERE r.a = v.vec_id) AS component_id,
  v.vec_id = (SELECT min(b) FROM r WHERE r.a = v.vec_id) AS kept
FROM v
"""


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every document, exactly and with errors."""
    return license_scan(read(spark, sf_dir, "documents"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_pii(read(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines, and how many lines match others."""
    return dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "n_links", "text")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and network score of every document."""
    return language_scores(read(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, for all documents and items."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH iw AS (
  SELECT item_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (
  SELECT item_id, least(len(w), 5) AS m, list_distinct([array_to_string(w[j:j + least(len(w), 5) - 1], ' ')
    FOR j IN range(1, len(w) - least(len(w), 5) + 2)]) AS s
  FROM iw WHERE len(w) > 0),
iu AS (SELECT item_id, m, len(s) AS n, unnest(s) AS sh FROM i),
dw AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
du AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[j:j + m - 1], ' ') FOR j IN range(1, len(w) - m + 2)]) AS sh
  FROM dw, (SELECT DISTINCT m FROM i))
SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_shingles, CAST(count(*) AS INTEGER) AS n_shared,
  count(*) / n::DOUBLE AS containment
FROM du JOIN iu USING (sh) GROUP BY doc_id, item_id, n HAVING count(*) >= 0.8 * n
"""


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    return encoded(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all words of the documents."""
    return spelling_variants(read(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
n AS (SELECT doc_id, t, len(t) AS n FROM d WHERE len(t) > 0),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM n)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term),
g AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n.n * s.docs) // s.total))) AS gain
  FROM tf JOIN w USING (term) JOIN n USING (doc_id), s),
r AS (SELECT item_id, doc_id, sum(gain)::BIGINT AS score FROM q JOIN g USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality": op3_quality,
    "op4_language_model": op4_language_model,
    "op5_simhash": op5_simhash,
    "op6_decontamination": op6_decontamination,
    "op7_packing": op7_packing,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_word_bpe": op11_word_bpe,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_ranked_search": op13_ranked_search,
}

SQL: dict[str, str] = {
    "op6_decontamination": OP6_SQL,
    "op8_url_filter": OP8_SQL,
    "op9_embedding_dedup": OP9_SQL,
    "op13_ranked_search": OP13_SQL,
}
