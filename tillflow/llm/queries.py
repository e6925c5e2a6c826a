"""The operators over the whole tables, as registered queries."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import decontaminate, dedup, infill, language, licenses, pii, resample, shards, wrappers
from tillflow.llm.jaccard import Join, near_classes
from tillflow.llm.lm import LanguageModel, score
from tillflow.llm.pieces import PieceModel, encode
from tillflow.llm.quality import score_quality
from tillflow.session import scratch_dir


#: A public SentencePiece model; any other can be given to the operators.
PIECE_MODEL = os.environ.get("TILLFLOW_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_index(spark: SparkSession) -> dedup.DigestIndex:
    """An empty index in the shared folder."""
    name = f"digest_index_{uuid.uuid4().hex}"
    return dedup.DigestIndex(spark, name, f"{scratch_dir(spark)}/{name}")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), LanguageModel())
    return found.select(
        "doc_id", "n_words", "n_backed_off", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 4).alias("mean_log_score")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.deduplicate(table(spark, sf_dir, "documents"), new_index(spark))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "documents"), PieceModel.load(PIECE_MODEL))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "exact", "ids")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"), Join(n=3, percent=90))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < pii.KINDS.index("term"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.KINDS),
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = language.remainder(F.col("doc_id"), 3) == 1
    found, _ = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.remainder(F.col("doc_id"), 4) == 2
    found = language.identify(docs, language.train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "spans")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.restore(infill.fill_in_middle(table(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_html_extraction": op4_html_extraction,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_language_id": op10_language_id,
    "op11_license_scan": op11_license_scan,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_importance_resampling": op13_importance_resampling,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_ALL_WORDS = _WORDS.format(_LOWER.format("coalesce(text, '')"))


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _licenses_sql() -> str:
    """Every block against every template."""
    step = licenses.stride(licenses.TEMPLATES)
    values = ", ".join(
        f"('{t.label}', {t.base}, {t.phrase}, {t.least}, {_list(t.words)}, {_list(sorted(set(t.words)))})" for t in licenses.TEMPLATES
    )
    return f"""
        WITH t(label, base, phrase, least, words, distinct_words) AS (VALUES {values}),
        d AS (SELECT row_number() OVER () AS r, doc_id, {_ALL_WORDS} AS w FROM documents),
        blocks AS (
            SELECT r, b * {step} AS first_word, w[b * {step} + 1 : (b + 2) * {step}] AS w
            FROM (SELECT r, w, unnest(range(0, (len(w) + {step} - 1) // {step})) AS b FROM d)
        ), pairs AS (
            SELECT r, label, base, phrase, len(list_intersect(distinct_words, w)) / len(distinct_words) AS share,
                   list_transform(list_filter(range(0, least(len(w), {step})), lambda p: w[p + 1 : p + len(words)] = words), lambda p: p + first_word) AS places
            FROM blocks, t WHERE len(list_intersect(distinct_words, w)) >= least
        ), found AS (
            SELECT r, sum(len(places)) FILTER (WHERE base)::BIGINT AS n_base, min(list_min(places)) FILTER (WHERE base) AS first_word,
                   max(list_max(places)) FILTER (WHERE base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
            FROM pairs WHERE NOT phrase OR len(places) > 0 GROUP BY r
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
        FROM d LEFT JOIN found USING (r)
    """


# A checksum of each different word, byte by byte, with a table that follows from the polynomial.
_CRC32 = """
    crc_table AS (
        SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
               lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries
    ), checksums AS (
        SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(word))),
                   lambda i: ('0x' || hex(encode(word))[2 * i + 1 : 2 * i + 2])::BIGINT)),
               lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
        FROM (SELECT DISTINCT word FROM words), crc_table
    )
"""

SQL: dict[str, str] = {
    "op1_lm_scoring": f"""
        WITH d AS (
            SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
        ), tokens AS (
            SELECT doc_id, p, w[p] AS w1, CASE WHEN p > 1 THEN w[p - 1 : p] END AS w2, CASE WHEN p > 2 THEN w[p - 2 : p] END AS w3,
                   CASE WHEN p > 1 THEN w[p - 1] END AS v1, CASE WHEN p > 2 THEN w[p - 2 : p - 1] END AS v2
            FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)
        ), c1 AS (SELECT w1 AS g, count(*) AS n FROM tokens GROUP BY g),
        c2 AS (SELECT w2 AS g, count(*) AS n FROM tokens WHERE w2 IS NOT NULL GROUP BY g),
        c3 AS (SELECT w3 AS g, count(*) AS n FROM tokens WHERE w3 IS NOT NULL GROUP BY g),
        scored AS (
            SELECT doc_id,
                   CASE WHEN c3.n > 1 THEN ln((c3.n - 1) / (b2.n - 1)) WHEN c2.n > 1 THEN ln((c2.n - 1) / (b1.n - 1))
                        ELSE ln(c1.n / (SELECT count(*) FROM tokens)) END AS s,
                   CASE WHEN c3.n > 1 THEN 0 WHEN c2.n > 1 THEN least(p, 3) - 2 ELSE least(p, 3) - 1 END AS back
            FROM tokens JOIN c1 ON c1.g = w1 LEFT JOIN c2 ON c2.g = w2 LEFT JOIN c3 ON c3.g = w3
            LEFT JOIN c1 b1 ON b1.g = v1 LEFT JOIN c2 b2 ON b2.g = v2
        ), sums AS (
            SELECT doc_id, count(*) AS n_words, sum(back > 0)::BIGINT AS n_backed_off, sum(s + back * ln(0.4)) AS log_score
            FROM scored GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_backed_off, 0)::BIGINT AS n_backed_off,
               round(coalesce(log_score, 0), 3) AS log_score, round(log_score / n_words, 4) AS mean_log_score
        FROM documents LEFT JOIN sums USING (doc_id)
    """,
    "op2_decontamination": f"""
        WITH i AS (
            SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark
        ), i_windows AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS k, w[p : p + least(len(w), 13) - 1] AS grams
            FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM i WHERE len(w) > 0)
        ), d AS (
            SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
        ), d_windows AS (
            SELECT doc_id, k, p, w[p : p + k - 1] AS grams
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i_windows))
        ), found AS (
            SELECT doc_id, d_windows.k, p, item_id FROM d_windows JOIN i_windows USING (grams)
        ), hits AS (
            SELECT doc_id, count(*) AS n_hit
            FROM (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS word FROM found) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op5_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, coalesce(length(text), 0) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
    """,
    "op11_license_scan": _licenses_sql(),
    "op12_fill_in_middle": r"""
        WITH h AS (SELECT *, sha256('42:' || doc_id) AS hex FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
        u AS (
            SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                   ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR ('0x' || hex[17:24])::BIGINT % 100 >= 50 THEN 'plain'
                        WHEN ('0x' || hex[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM h
        ), cut AS (
            SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM u
        ), parts AS (
            SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1 : b], '') AS middle, array_to_string(u[b + 1 :], '') AS suffix FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op13_importance_resampling": f"""
        WITH d AS (SELECT doc_id, {_ALL_WORDS} AS w FROM documents),
        words AS (SELECT unnest(w) AS word, true AS source FROM d UNION ALL SELECT unnest({_ALL_WORDS}), false FROM benchmark),
        {_CRC32}, counts AS (
            SELECT bucket, count(*) FILTER (WHERE source) AS s, count(*) FILTER (WHERE NOT source) AS t,
                   sum(s) OVER () AS sum_s, sum(t) OVER () AS sum_t
            FROM words JOIN checksums USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (sum_s + 10000) / ((s + 1.0::DOUBLE) * (sum_t + 10000))))::BIGINT AS gain FROM counts
        ), of_word AS (SELECT word, gain FROM checksums JOIN gains USING (bucket)),
        weights AS (
            SELECT doc_id, count(*) AS n_features, floor(sum(gain)::BIGINT / count(*))::BIGINT AS weight
            FROM (SELECT doc_id, unnest(w) AS word FROM d) JOIN of_word USING (word) GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM d LEFT JOIN weights USING (doc_id)
        ), placed AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
        FROM scored LEFT JOIN placed USING (doc_id)
    """,
}
