"""The operators' queries over whole tables: name -> (spark, folder) -> DataFrame, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm import code_search, hard_negatives, language_id, lm_scoring, mixing, packing, periodic_runs, quality, secrets, simhash, sketches, token_output, url_rules
from ledgerlift.llm.common import documents, prepared, written

#: The file of the tokenizer that op2 encodes with, by its public name.
TOKENIZER = "word_bpe_49k.json"
Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir), shingle=3, max_bits=3)


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output.encoded(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_pairs(documents(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_words(documents(spark, sf_dir))
    return placed.drop("h")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(documents(spark, sf_dir)).drop("key")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classified(documents(spark, sf_dir), labels, F.col("source"), F.col("lang"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = language_id.identified(docs.select("doc_id", "text"), language_id.learned(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = prepared(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    codes = written(code_search.binary_codes(vectors), "binary-codes")
    return code_search.nearest(codes, codes.where("id % 50 = 0"), k=10)


#: Rules of hosts and paths that op11 judges by before any pattern.
SITE_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = prepared(spark).read.parquet(f"{sf_dir}/pages.parquet")
    return url_rules.judged(pages, url_rules.rules(pages.sparkSession, SITE_RULES)).drop("pattern")


def with_planted_periods(doc_id: Column, text: Column) -> Column:
    """A text whose words repeat from some word on, for a tenth of the ids; the others as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.nullif(F.size(words), F.lit(0))
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")
    return F.coalesce(F.when(h % 10 == 0, made), text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", with_planted_periods(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.periodic_runs(docs)
    none = F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)")
    higher = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", none, lambda best, r: F.when(higher(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n")))
    digested = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return digested.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli, "runs_sha256", "collapsed_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = prepared(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mined(moved, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_simhash, op2_token_output, op3_fingerprints, op4_best_fit_packing, op5_lm_scoring, op6_mixing, op7_secrets, op8_quality_classifier, op9_language_id, op10_code_search, op11_url_rules, op12_periodic_runs, op13_hard_negatives)}

_HOST, _PATH = (f"coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', {i}, 's'), '')" for i in (1, 2))
_SITES = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in SITE_RULES)
_PATTERNS = ", ".join(f"({of_host}, '{p.removeprefix('@@')}', '{'allow' if p.startswith('@@') else 'block'}')" for of_host, listed in ((True, url_rules.HOSTS), (False, url_rules.PATTERNS)) for p in listed)
#: Every rule against every page.
_OP11 = rf"""
WITH p AS (SELECT page_id, translate({_HOST}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, {_PATH} AS path,
           translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded FROM pages),
site AS (SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, instr(rule, '/')) AS start FROM (VALUES {_SITES}) AS r(rule, verdict)),
quoted AS (SELECT of_host, verdict, replace(replace(regexp_replace(pattern, '([^a-z0-9*^|])', '\\\1', 'g'), '||', '<'), '|', '>') AS q FROM (VALUES {_PATTERNS}) AS r(of_host, pattern, verdict)),
pattern AS (SELECT of_host, verdict, replace(replace(replace(replace(q, '*', '.*'), '^', '(?:[^a-z0-9]|\A|\z)'), '<', '^[^:/?#]*://(?:[^/?#]*\.)?'), '>', '\z') AS re FROM quoted)
SELECT page_id, host, path,
       (SELECT arg_max(rule, length(rule)) FROM site WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, start)) AS rule,
       coalesce((SELECT arg_max(verdict, length(rule)) FROM site WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, start)),
                (SELECT min(verdict) FROM pattern WHERE regexp_matches(if(of_host, p.host, p.folded), re, 's')), 'allow') AS verdict
FROM p"""
_OP13 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike,
                  list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i]))::BIGINT AS score
           FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE alike
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
WHERE 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) <= 5"""
ORACLES: dict[str, str] = {"op11_url_rules": _OP11, "op13_hard_negatives": _OP13}
