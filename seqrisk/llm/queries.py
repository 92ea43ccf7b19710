"""Registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seqrisk.llm import (conversation_repair, embed_dedup, exact_dedup, html_extract, labelled_pages, langid, line_dedup, minhash, mixing,
                         packing, quality, secret_scan, token_alignment, url_filter)
from seqrisk.llm.common import read

URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]

# Words that mark the host or path of a labelled URL as unwanted.
UNWANTED_WORDS = ["casino", "bets", "pills", "adult", "spam", "ads-track"]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document."""
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    return embed_dedup.near_vectors(read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans of every document."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.train(docs, ~F.coalesce(held_out, F.lit(False)))
    found = langid.predict(docs, model)
    own = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), own.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


TOP_GRADE = 2


def grades(labels: DataFrame) -> DataFrame:
    """Graded ratings from the labels: 0 low quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))


def op4_quality_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, expected_grade, p_good (grade 1 or more), p_best (grade 2), kept (by p_best) of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, grades(read(spark, sf_dir, "labels")), top=TOP_GRADE)
    rated = quality.rate(docs, model)
    best = F.element_at("tails", TOP_GRADE)
    return rated.select("doc_id", "expected_grade", F.element_at("tails", 1).alias("p_good"), best.alias("p_best"),
                        (best >= model.least).alias("kept"))


LEAST_LINE = 5


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, clean_sha256 (of the text that is left) of every document. Lines of
    ``LEAST_LINE`` characters or more go for one edit, shorter ones (list marks, numbers) only when equal."""
    clean = line_dedup.dedup_lines(read(spark, sf_dir, "documents"), min_chars=LEAST_LINE)
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("clean_sha256"))


def finding_label():
    """Labelled findings: an assignment to a secret's name with digits in the
    value, or the fixed form of an access key, is one; a value of letters only or
    of digits only is not; the others have no label."""
    value, before = F.col("value"), F.col("before")
    named = F.rlike(before, F.lit(secret_scan.NAMES + r"\s*[=:]\s*[\"']?$")) & F.rlike(value, F.lit("[0-9]"))
    return F.when(named | F.rlike(value, F.lit("^AKIA[0-9A-Z]{16}$")), 1).when(F.rlike(value, F.lit("^([A-Za-z]+|[0-9]+)$")), 0)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, place, length, value_sha256, probability, is_secret of every candidate of every document."""
    found = secret_scan.scan(read(spark, sf_dir, "documents"), finding_label())
    return found.select(F.col("id").alias("doc_id"), "place", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"),
                        F.round("probability", 6).alias("probability"), "is_secret")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, component_id, kept of every document."""
    member, _ = minhash.near_duplicates(read(spark, sf_dir, "documents"))
    return member.withColumnRenamed("id", "doc_id")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    return exact_dedup.mark_duplicates(read(spark, sf_dir, "documents"))


def labelled_urls(pages: DataFrame, limit: int = url_filter.MAX_LABELLED) -> DataFrame:
    """The small labelled table: the ``limit`` different urls of smallest hash, labelled 1
    if the host or path holds an unwanted word."""
    bounded = pages.where("url is not null").select("url").distinct().orderBy(F.xxhash64("url"), "url").limit(limit)
    return bounded.select("url", F.lower("url").rlike("|".join(UNWANTED_WORDS)).cast("int").alias("label"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit_urls(labelled_urls(pages))
    return url_filter.judge_urls(pages, model, URL_RULES).drop("url")


def vocabulary() -> str:
    """Path of the byte-level vocabulary; a parameter of the packing operator."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op10_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary())


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return html_extract.extract(read(spark, sf_dir, "pages"), html_extract.fit(labelled_pages.labelled_pages()))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    import public_tokenizers
    return token_alignment.align_tokens(read(spark, sf_dir, "documents"), vocabulary(), public_tokenizers.path("piece_bpe_32k.model"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    return conversation_repair.repair_conversations(read(spark, sf_dir, "conversations"))


QUERIES = {"op1_mix_sources": op1_mix_sources, "op8_exact_dedup": op8_exact_dedup, "op9_url_filter": op9_url_filter,
           "op2_embedding_dedup": op2_embedding_dedup, "op3_language_id": op3_language_id, "op4_quality_grade": op4_quality_grade,
           "op5_line_dedup": op5_line_dedup,
           "op6_secret_scan": op6_secret_scan,
           "op7_minhash_dedup": op7_minhash_dedup, "op10_pack_documents": op10_pack_documents,
           "op11_html_extraction": op11_html_extraction, "op12_token_alignment": op12_token_alignment, "op13_conversation_repair": op13_conversation_repair}

ORACLE = {
    "op8_exact_dedup": """
        WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                   'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
    """,
    # links by plain cosines within a label, components by reachability
    "op2_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        x AS (SELECT vec_id, label, len(e) AS dim, i, e[i] AS x FROM v, unnest(range(1, len(e) + 1)) t(i)),
        f AS (SELECT vec_id, label, list(x ORDER BY i) AS e FROM x WHERE x IS NOT NULL GROUP BY vec_id, label, dim HAVING count(*) = dim),
        u AS (SELECT *, list_dot_product(e, e) AS n2 FROM f),
        w AS (SELECT vec_id, label, e, sqrt(n2) AS n FROM u WHERE label IS NOT NULL AND isfinite(n2) AND n2 > 0),
        links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM w a JOIN w b ON a.label = b.label AND a.vec_id <> b.vec_id
                  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93 END),
        reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
        low AS (SELECT x, min(y) AS m FROM reach GROUP BY 1), many AS (SELECT x, count(*) AS n FROM links GROUP BY 1)
        SELECT vec_id, coalesce(many.n, 0) AS n_links, least(vec_id, coalesce(low.m, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(low.m, vec_id)) AS kept
        FROM v LEFT JOIN low ON low.x = vec_id LEFT JOIN many ON many.x = vec_id
    """,
    # lines within one edit share the first or the last half of the longer one's length; then the place of the edit is sought
    "op5_line_dedup": """
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        l AS (SELECT doc_id, i AS line, parts[i] AS raw, trim(translate(parts[i], chr(9) || chr(13) || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     '  abcdefghijklmnopqrstuvwxyz'), ' ') AS norm FROM d, unnest(range(1, len(parts) + 1)) t(i)),
        p AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, line) AS place FROM l),
        c AS (SELECT norm, length(norm) AS n, min(place) AS place FROM p WHERE norm <> '' GROUP BY 1),
        z AS (SELECT *, n + i AS longest FROM c, (VALUES (0), (1)) t(i) WHERE n >= 5),
        k AS (SELECT *, 0 AS side, left(norm, longest // 2) AS part FROM z UNION ALL SELECT *, 1, right(norm, longest // 2) FROM z),
        pairs AS (SELECT DISTINCT a.norm AS a, a.n AS na, b.norm AS b, b.n AS nb FROM k a JOIN k b USING (longest, side, part)
                  WHERE a.place < b.place AND greatest(a.n, b.n) = longest),
        near AS (SELECT DISTINCT b AS norm FROM pairs, unnest(range(0, greatest(na, nb))) t(i)
                 WHERE left(a, i) = left(b, i) AND substr(a, i + CASE WHEN na >= nb THEN 2 ELSE 1 END) = substr(b, i + CASE WHEN nb >= na THEN 2 ELSE 1 END)),
        marked AS (SELECT p.*, p.norm <> '' AND (near.norm IS NOT NULL OR p.place > c.place) AS gone
                   FROM p LEFT JOIN c ON p.norm = c.norm LEFT JOIN near ON p.norm = near.norm)
        SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_dropped,
               sha256(coalesce(string_agg(raw, chr(10) ORDER BY line) FILTER (WHERE NOT gone), '')) AS clean_sha256
        FROM marked GROUP BY doc_id
    """,
}
