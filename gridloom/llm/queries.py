"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, mixing, packing, pii, quality_classifier, quality_rules, simhash, suffix_dedup, token_counts, token_files

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir), table(spark, sf_dir, "labels"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.shared_spans(table(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir), vocabulary(), end_id=2)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(spark, table(spark, sf_dir), vocabulary(), end_id=1)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir)).drop("class_distance", "word_distance")


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_quality_classifier, op3_simhash_near_dedup, op4_token_counts, op5_suffix_dedup, op6_packing, op7_mixing,
        op8_token_files, op9_exact_dedup, op10_quality_rules,
    )
}

SQL = {
    "op9_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{exact_dedup.UPPER}', '{exact_dedup.LOWER}') AS t FROM documents),
             h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM d)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM h WINDOW w AS (PARTITION BY text_sha256)""",
}


def _quality_sql() -> str:
    known = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in quality_rules.COMMON.items()) + " END"
    counts, rest = [], "t"
    for pattern in quality_rules.CLASSES.values():
        after = f"regexp_replace({rest}, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g')"
        counts.append(f"length({rest}) - length({after})")
        rest = after
    n_class, width = len(counts) + 1, max(map(len, quality_rules.COMMON.values())) + 1
    js = """sqrt(greatest(0.0, (list_sum(list_transform(list_zip({p}, {q}), lambda z: CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END
        + CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END))) / 2))"""
    share = "list_transform({c}, lambda x: x / greatest(1, list_sum({c})))"
    r = quality_rules
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS words, {known} AS known,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
    g AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    twice AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
    marked AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
    m AS (SELECT w.rid, doc_id, lang, known, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
            [{", ".join(counts)}, length({rest})] AS cls,
            list_transform(known, lambda k: len(list_filter(words, lambda x: x = k))) AS c0 FROM w LEFT JOIN marked USING (rid)),
    b AS (SELECT *, CASE WHEN known IS NOT NULL THEN list_append(c0, n_words - list_sum(c0)) END AS com,
            n_words < {r.MIN_WORDS} OR 100 * n_repeat_words > {r.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
    ref AS (SELECT lang, sum(n_words) AS rw, [{", ".join(f"sum(cls[{i}])" for i in range(1, n_class + 1))}] AS rc0,
            [{", ".join(f"sum(com[{i}])" for i in range(1, width + 1))}] AS rk0 FROM b WHERE NOT base_failed GROUP BY lang),
    s AS (SELECT lang AS rl, rw, {share.format(c="rc0")} AS rc, {share.format(c="rk0")} AS rk FROM ref),
    j AS (SELECT b.*, CASE WHEN rw >= {r.MIN_REFERENCE_WORDS} AND list_sum(cls) >= {r.MIN_CHARS_COMPARED} THEN {js.format(p=share.format(c="cls"), q="rc")} END AS dc,
            CASE WHEN rw >= {r.MIN_REFERENCE_WORDS} AND n_words >= {r.MIN_WORDS_COMPARED} AND com IS NOT NULL THEN {js.format(p=share.format(c="com"), q="rk")} END AS dw
          FROM b LEFT JOIN s ON lang IS NOT DISTINCT FROM rl)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(dc, 0) <= {r.MAX_CLASS_DISTANCE} AND coalesce(dw, 0) <= {r.MAX_WORD_DISTANCE} AS kept FROM j"""


SQL["op10_quality_rules"] = _quality_sql()
