"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (bpe, decontamination, lexical_search, near_duplicates, pii, quality, repeats, revisits, sentence_pieces, sharding,
                           url_templates, whitening, wrappers)
from tradewind.llm.util import table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["after"] - h["first"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "score")


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is captured twice: in full, and some days later as a revisit under the plain form of its URL.

    Every fifth revisit names another entity tag, every seventh none. Pages whose URLs are variants of one canonical URL
    are captures of one resource.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("tag"))
    at = F.lit(1_600_000_000) + F.col("page_id") * 97
    later = at + 500_000 + F.col("page_id") % 1000 * 1000
    kv = lambda **h: F.map_from_arrays(F.array(*[F.lit(k) for k in h]), F.array(*h.values()))
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", at.alias("at"),
        F.col("tag").alias("etag"), at.cast("string").alias("last_modified"),
        kv(ETag=F.col("tag"), Date=at.cast("string"), Server=F.lit("origin")).alias("headers"))
    tag = F.when(F.col("page_id") % 7 == 0, F.lit(None)).when(F.col("page_id") % 5 == 0, F.md5("url")).otherwise(F.col("tag"))
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"),
        F.regexp_replace("url", "#top$", "").alias("url"), later.alias("at"), tag.alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        kv(Date=later.cast("string"), Server=F.lit("cache"), ETag=tag).alias("headers"))
    found = revisits.resolve(full.unionByName(again))
    header = lambda name: F.element_at("headers", F.lit(name))
    return found.select("record_id", "canonical_url", "at", "response_id", "response_at", "status",
                        header("date").alias("date"), header("server").alias("server"), header("etag").alias("etag"))


OP3_SQL = r"""
WITH p AS (SELECT page_id, url, md5(coalesce(html, '')) AS tag, 1600000000 + page_id * 97 AS ts FROM pages),
c AS (SELECT page_id * 2 AS record_id, 'response' AS kind, url, ts, tag AS etag FROM p
      UNION ALL SELECT page_id * 2 + 1, 'revisit', regexp_replace(url, '#top$', ''), ts + 500000 + page_id % 1000 * 1000,
             CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN md5(url) ELSE tag END FROM p),
r AS (SELECT *, regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM c),
q AS (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '(?s)\?(.*)$', 1), '&'),
        lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]*|ref|fbclid|gclid)(=|$)'))), '&') AS query FROM r),
u AS (SELECT record_id, kind, ts, etag,
        regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '(?s)^.*@', ''),
                       ':(80|443)$', ''), '^www\.', '')
        || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
        || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canonical_url FROM q),
a AS (SELECT v.record_id, v.canonical_url, v.ts, v.etag, f.record_id AS response_id, f.ts AS response_at, f.etag AS full_tag
      FROM (SELECT * FROM u WHERE kind = 'revisit') v
      ASOF LEFT JOIN (SELECT canonical_url, ts, max(record_id) AS record_id, max_by(etag, record_id) AS etag FROM u
                      WHERE kind = 'response' GROUP BY 1, 2) f
      ON v.canonical_url = f.canonical_url AND v.ts > f.ts),
s AS (SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN etag <> full_tag THEN 'changed'
                     WHEN etag = full_tag THEN 'resolved' ELSE 'unchecked' END AS status FROM a)
SELECT record_id, canonical_url, ts AS "at", response_id, response_at, status, CAST(ts AS VARCHAR) AS date,
       CASE WHEN status IN ('resolved', 'unchecked') THEN 'origin' END AS server,
       CASE WHEN status = 'unchecked' THEN full_tag ELSE etag END AS etag
FROM s
"""


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.cluster(table(spark, sf_dir, "documents"), words=4, percent=80).drop("t")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.deduplicate(table(spark, sf_dir, "documents"), keep_first=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, ("email", "ip", "card", "phone")),
                        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def vocabulary_path() -> str:
    """The public tokenizer file that the query encodes with; a package of the environment has it on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenize(table(spark, sf_dir, "documents"), vocabulary_path(), result=bpe.digests())


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))[0]


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a label. The number in a page's path is the document that the page shows; one of low quality or toxic
    is bad. A document labelled more than once is bad if any label says so."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("label"))
    shown = F.regexp_extract(F.coalesce("url", F.lit("")), r"://[^?#]*?/([0-9]{1,18})(?:[/.?#]|$)", 1)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.when(shown != "", shown.cast("long")).alias("doc_id"))
    return pages.join(labels, "doc_id", "left").drop("doc_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(page_labels(spark, sf_dir), URL_RULES)


def piece_model_path() -> str:
    """The public model file that the query encodes with; a package of the environment has it on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.tokenize(table(spark, sf_dir, "documents"), piece_model_path(), sentence_pieces.digests())


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n) AS terms FROM lengths),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM wanted) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, whole),
m AS (SELECT doc_id, CAST(50 + (50 * n * docs) // terms AS BIGINT) AS m FROM lengths, whole),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
           FROM wanted JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = found.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    # The operator's deviation is exact at any size; as a long it is null where it doesn't fit.
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"),
                       "c.whitened", "c.explained", "identity_error")


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_revisits": op3_revisits,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_repeats": op5_repeats,
    "op6_pii": op6_pii,
    "op7_bpe": op7_bpe,
    "op8_html": op8_html,
    "op9_sharding": op9_sharding,
    "op10_url_filter": op10_url_filter,
    "op11_sentence_pieces": op11_sentence_pieces,
    "op12_lexical_search": op12_lexical_search,
    "op13_whitening": op13_whitening,
}
ORACLES = {"op3_revisits": OP3_SQL, "op12_lexical_search": OP12_SQL}
