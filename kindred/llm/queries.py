"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import pii, quality, toxicity
from kindred.llm.balanced_shards import shard_documents
from kindred.llm.byte_bpe import decode_ids, encode_texts
from kindred.llm.folds import held_out
from kindred.llm.grid_order import near_duplicates
from kindred.llm.hilbert_blocks import hard_negatives
from kindred.llm.packing import pack
from kindred.llm.posting_lists import nearest
from kindred.llm.prefix_trie import conversation_trie
from kindred.llm.token_counts import token_counts
from kindred.llm.token_groups import jaccard_components
from kindred.llm.url_filter import ALLOW, BLOCK, HostRule, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Register ``build`` under its own name."""
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose five-word shingle sets are similar."""
    return jaccard_components(table(spark, folder, "documents"))


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text, learned from positive and unlabelled texts."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in windows of 2048 tokens, best fit decreasing."""
    pieces = pack(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


URL_RULES = (
    HostRule(ALLOW, "com", "/"),
    HostRule(BLOCK, "example.com", "/en/"),
    HostRule(ALLOW, "www.example.com", "/en/"),
    HostRule(BLOCK, "net", "/es/"),
    HostRule(BLOCK, "net", "/fr/"),
)


@query
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every page's URL."""
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


ORACLES["op4_url_filter"] = """
WITH cut AS (
    SELECT page_id,
           CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END
               AS rest
    FROM pages
), split AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
           regexp_extract(rest, '^[^?#]*') AS upto
    FROM cut
), named AS (
    SELECT page_id,
           translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           substr(upto, length(raw) + 1) AS path
    FROM split
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND prefix(path, '/en/')
            THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/en/')
            THEN 'example.com/en/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND prefix(path, '/') THEN 'com/'
    END AS rule
    FROM named
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN prefix(host || path, 'ads.') OR contains(host || path, '/cgi-bin/')
        OR contains(host || path, '/wp-login.php') THEN 'block'
    ELSE 'allow'
END AS verdict
FROM ruled
"""


@query
def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector, by inner product."""
    return nearest(table(spark, folder, "embeddings"))


@query
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of vectors of a label with cosine 0.93 and more."""
    return near_duplicates(table(spark, folder, "embeddings"))


# every pair of a label: for a check on small tables only
ORACLES["op6_near_duplicates"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), component AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counted AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counted USING (vec_id)
"""


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text by heap merging."""
    return token_counts(table(spark, folder, "documents"))


@query
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text: base kinds, and secrets that the labelers agree on."""
    docs = table(spark, folder, "documents")
    found = pii.find_spans(docs, pii.train(docs))

    def of(kind: str):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id", *(F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in pii.BASE_KINDS),
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every text by quadratic discriminant analysis."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every text by recursive contraction, decode the identifiers, digest both."""
    decoded = decode_ids(encode_texts(table(spark, folder, "documents")))
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix trie of all conversations, rebuilt on shared beginnings."""
    return conversation_trie(table(spark, folder, "conversations"), shared_heads=True)


ORACLES["op11_prefix_trie"] = """
WITH t AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    -- CRC-32, bit by bit
    SELECT c, xor(list_reduce(
        [4294967295::UBIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::UBIGINT),
        lambda a, b: list_reduce(
            [xor(a, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))
    ), 4294967295::UBIGINT) % 4 AS h
    FROM (SELECT DISTINCT c FROM t)
), rebuilt AS (
    SELECT convs.c, 0 AS own, pos, role, text
    FROM convs JOIN t ON t.c = convs.c - convs.c % 20 AND pos <= h
    UNION ALL
    SELECT convs.c, 1, pos, role, text FROM convs JOIN t USING (c) WHERE pos > h
), listed AS (
    SELECT c, list({'role': role, 'text': text} ORDER BY own, pos) AS turns FROM rebuilt GROUP BY c
), filled AS (
    SELECT c, coalesce(turns, []) AS turns FROM convs LEFT JOIN listed USING (c)
), prefixes AS (
    SELECT c, len(turns) AS length, d, turns[1:d] AS key
    FROM filled, unnest(range(0, len(turns) + 1)) AS r(d)
), nodes AS (
    SELECT key, d, min(c) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (length = d), '')) AS ends_sha256,
           (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE
               len(regexp_extract_all(key[d].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM prefixes GROUP BY key, d
), edges AS (
    SELECT parent.key, parent.d, count(*) AS n_children
    FROM nodes child JOIN nodes parent ON child.d = parent.d + 1 AND child.key[1:parent.d] = parent.key
    GROUP BY ALL
), below AS (
    SELECT u.key[1:e] AS key, e AS d, sum(u.saved) AS saved_tokens,
           count(*) FILTER (edges.n_children IS NULL) AS n_leaves
    FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM nodes) u LEFT JOIN edges USING (key, d)
    GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(edges.n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       n.ends_sha256
FROM nodes n JOIN below USING (key, d) LEFT JOIN edges USING (key, d)
LEFT JOIN nodes up ON up.d = n.d - 1 AND n.key[1:up.d] = up.key
"""


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, by zone maps of Hilbert-ordered blocks."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10)
    vectors = table(spark, folder, "embeddings").withColumn(
        "label", label.otherwise(F.col("label").cast("bigint"))
    )
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


ORACLES["op12_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
           list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER
           AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query
def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of equally many rows, equal texts together."""
    return shard_documents(table(spark, folder, "documents"))
