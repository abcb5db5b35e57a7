"""Registered queries of this subpackage, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachscope.llm import (
    best_fit,
    decontamination,
    exact_dedup,
    hard_negatives,
    jaccard,
    language,
    licenses,
    line_dedup,
    packing,
    sharding,
    suffixes,
    url_filter,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures_and_list(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Captures with a time of fetch, and a dated list about their hosts and paths.

    The tables hold neither, so both are derived from `pages`: the time from the page id,
    the entries from the checksum of each host, parent domain and first path segment.
    """
    start = F.to_date(F.lit("2024-01-01"))
    captures = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.date_add(start, F.pmod(F.col("page_id") * 37, F.lit(365)).cast("int")).alias("fetched_at")
    )
    host = url_filter.host_of(F.col("url"))
    names = captures.select(
        F.explode(
            F.array(
                host,
                F.regexp_replace(host, r"^[^.]+\.", ""),
                F.concat_ws("/", host, F.regexp_extract("url", "^[^:]+://[^/]+/([^/?#]+)", 1)),
            )
        ).alias("pattern")
    ).where("pattern IS NOT NULL").distinct()
    # Up to three entries for each name whose first checksum digit says so.
    mark = F.conv(F.substring(F.md5("pattern"), 1, 4), 16, 10).cast("int")
    dated = names.withColumn("mark", mark).where("mark % 5 < 2").select(
        "pattern",
        F.explode(
            F.array(
                F.struct(F.when(F.col("mark") % 3 == 0, "allow").otherwise("block").alias("action"),
                         (F.col("mark") % 200).alias("day")),
                F.struct(F.lit("remove").alias("action"), (F.col("mark") % 200 + 60).alias("day")),
                F.struct(F.lit("block").alias("action"), (F.col("mark") % 200 + 60 + F.col("mark") % 97).alias("day")),
            )
        ).alias("e"),
    )
    return captures, dated.select(
        "pattern", "e.action", F.date_add(start, F.col("e.day").cast("int")).alias("listed_at")
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = url_filter.filter_urls(*captures_and_list(spark, sf_dir))
    return decided.select("page_id", "host", "fetched_at", "blocked", "action", "pattern", "since")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


SHARDS = 40


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document: line numbers apart, its text as a digest."""
    short = line_dedup.deduplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return short.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), jaccard.Rule(4, 85, 100))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.wide_crc(pieces)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, ~language.held_out())
    predicted = language.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth row asks; every seventh row's label is moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = best_fit.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows))


_TEXT = "coalesce(text, '')"

_OP3 = f"""
WITH d AS (
 SELECT doc_id, sha256(translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
 FROM documents
), g AS (
 SELECT doc_id, s, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, s AS text_sha256 FROM g
"""


_OP1 = """
WITH c AS (
 SELECT page_id, url, CAST(DATE '2024-01-01' + CAST((page_id*37)%365 AS INT) AS DATE) AS fetched_at,
  nullif(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)),
   '^www\\.', ''), '\\.$', ''), '') AS host,
  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path
 FROM pages
), names AS (
 SELECT DISTINCT pattern FROM (
  SELECT host AS pattern FROM c
  UNION ALL SELECT regexp_replace(host, '^[^.]+\\.', '') FROM c
  UNION ALL SELECT host || '/' || regexp_extract(url, '^[^:]+://[^/]+/([^/?#]+)', 1) FROM c
 ) WHERE pattern IS NOT NULL
), marked AS (
 SELECT pattern, CAST('0x' || substr(md5(pattern),1,4) AS INT) AS mark FROM names
), e AS (
 SELECT pattern, CASE WHEN mark%3=0 THEN 'allow' ELSE 'block' END AS action, mark%200 AS day FROM marked WHERE mark%5<2
 UNION ALL SELECT pattern, 'remove', mark%200+60 FROM marked WHERE mark%5<2
 UNION ALL SELECT pattern, 'block', mark%200+60+mark%97 FROM marked WHERE mark%5<2
), once AS (
 SELECT pattern, CAST(DATE '2024-01-01' + day AS DATE) AS valid_from, max(action) AS action FROM e GROUP BY ALL
), spans AS (
 SELECT *, lead(valid_from) OVER (PARTITION BY pattern ORDER BY valid_from) AS valid_to FROM once
), keys AS (
 SELECT page_id, url, fetched_at, array_to_string(l[i:], '.') AS pattern, len(l)-i+1 AS specific
 FROM (SELECT *, string_split(host,'.') AS l FROM c WHERE host IS NOT NULL),
  unnest(range(1, len(l)+1)) AS r(i)
 UNION ALL
 SELECT page_id, url, fetched_at, host || '/' || array_to_string(g[:k], '/'), 1000+k
 FROM (SELECT *, list_filter(string_split(path,'/'), lambda x: x <> '') AS g FROM c WHERE host IS NOT NULL),
  unnest(range(1, len(g)+1)) AS r(k)
), best AS (
 SELECT k.page_id, s.action, s.pattern, s.valid_from AS since,
  row_number() OVER (PARTITION BY k.page_id ORDER BY k.specific DESC) AS n
 FROM keys k JOIN spans s ON k.pattern=s.pattern AND s.valid_from<=k.fetched_at
  AND (s.valid_to IS NULL OR k.fetched_at<s.valid_to)
 WHERE s.action IN ('block','allow')
)
SELECT c.page_id, c.host, c.fetched_at, coalesce(b.action='block', FALSE) AS blocked, b.action, b.pattern, b.since
FROM c LEFT JOIN best b ON b.page_id=c.page_id AND b.n=1
"""


_OP11 = """
WITH r AS (
 SELECT vec_id, CASE WHEN vec_id%7=0 THEN (label+1)%10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256*CAST(x AS DOUBLE))) AS q
 FROM embeddings
 WHERE label IS NOT NULL AND len(embedding)>0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x)))=0
), s AS (
 SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label=b.label AS same,
  CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
 FROM r a JOIN r b ON a.vec_id%100=0 AND a.vec_id<>b.vec_id
), p AS (
 SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id)<=5
)
SELECT anchor_id, positive_id,
 CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
 id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30*positive_score<=100*score AND 100*score<=90*positive_score
QUALIFY rank<=10
"""


def _licence_sql() -> str:
    """The same canonical form in the second engine's functions."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def lines(x: str) -> str:
        out = f"regexp_replace(lower({x}), {quoted(licenses.COPYRIGHT_LINE)}, '', 'g')"
        for spelling, into in licenses.SPELLINGS:
            out = f"replace({out}, {quoted(spelling)}, {quoted(into)})"
        out = f"regexp_replace({out}, '[^a-z0-9\\n]+', ' ', 'g')"
        out = f"regexp_replace({out}, {quoted(licenses.VERSION)}, 'version \\1', 'g')"
        trimmed = f"list_transform(string_split({out}, chr(10)), lambda l: trim(l))"
        return f"list_filter({trimmed}, lambda l: l <> '')"

    known = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in licenses.known_texts())
    return f"""
WITH known AS (
 SELECT array_to_string({lines("t")}, ' ') AS form, min(license) AS license
 FROM (VALUES {known}) AS v(license, t) GROUP BY 1
), d AS (
 SELECT doc_id, {lines("text")} AS l FROM documents WHERE text IS NOT NULL
), rest AS (
 SELECT doc_id, l[i] AS line, array_to_string(l[i:], ' ') AS r FROM d, unnest(range(1, len(l)+1)) AS x(i)
), hits AS (
 SELECT doc_id, 'whole' AS kind, license FROM d JOIN known ON array_to_string(l, ' ')=form WHERE form<>''
 UNION ALL
 SELECT doc_id, 'line', license FROM rest JOIN known ON line=form
 UNION ALL
 SELECT doc_id, 'run', license FROM rest JOIN known
 ON length(form)>={licenses.ANCHOR} AND substr(r, 1, {licenses.ANCHOR})=substr(form, 1, {licenses.ANCHOR})
  AND starts_with(r || ' ', form || ' ')
), found AS (
 SELECT doc_id, max(license) FILTER (kind='whole') AS whole, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
  count(*) FILTER (kind='line') AS n_notices FROM hits GROUP BY doc_id
)
SELECT d.doc_id, f.whole, coalesce(f.licenses, '') AS licenses, coalesce(f.n_notices, 0) AS n_notices
FROM documents d LEFT JOIN found f ON d.doc_id=f.doc_id
"""


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_decontamination": op2_decontamination,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_license_scan": op4_license_scan,
        "op5_sharding": op5_sharding,
        "op6_line_dedup": op6_line_dedup,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_packing": op8_packing,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_language_id": op10_language_id,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_best_fit": op12_best_fit,
        "op13_whitening": op13_whitening,
    }


def texts() -> dict[str, str]:
    return {
        "op1_url_filter": _OP1,
        "op3_exact_dedup": _OP3,
        "op4_license_scan": _licence_sql(),
        "op11_hard_negatives": _OP11,
    }
