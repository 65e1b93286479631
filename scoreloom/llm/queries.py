"""The registered queries: each operator on its whole table with production parameters, and SQL where that can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import fingerprints, hmm, licenses, mixing, packing, pieces, pii, prefixes, quality_rules, repair, simhash, token_store, url_filter
from scoreloom.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


#: The tokenizer's file and the id that ends a document.
END_ID = 2


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_quality_rules")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judged(read(spark, sf, "documents"))


@query("op2_simhash")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.linked(read(spark, sf, "documents"))


@query("op3_token_store")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return token_store.read_back(token_store.write(read(spark, sf, "documents"), tokenizer(), END_ID))


@query("op4_license_scan")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scanned(read(spark, sf, "documents"))


@query("op5_packing")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(read(spark, sf, "documents"), tokenizer(), END_ID)


@query("op6_multiset_hash")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compared(read(spark, sf, "documents"))


@query("op7_hidden_markov")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return hmm.scored(read(spark, sf, "documents"))


@query(
    "op8_source_mix",
    """
    WITH RECURSIVE rows AS (
      SELECT doc_id, source, md5('mix:' || coalesce(doc_id::VARCHAR, '')) || md5(coalesce(text, '')) AS key,
             len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
      FROM documents
    ), sources AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
      FROM rows GROUP BY source
    ), shares AS (
      SELECT source, source_size, weight, 3 * source_size AS cap,
             (SELECT sum(source_size)::BIGINT FROM sources) AS whole FROM sources
    ), levels AS (
      SELECT *, (whole - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
                / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
             row_number() OVER o AS n
      FROM shares WINDOW o AS (ORDER BY cap / weight, source NULLS FIRST)
    ), goals AS (
      SELECT source, source_size,
             CASE WHEN cap <= level * weight THEN cap::DOUBLE
                  ELSE (SELECT arg_min(level, n) FROM levels WHERE cap > level * weight) * weight END AS target
      FROM levels
    ), placed AS (
      SELECT r.doc_id, r.size, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
             sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
      FROM rows r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source
    )
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size = 0 THEN 0 ELSE
             (budget // source_size) * size + greatest(0, least(size, budget % source_size - upto + size)) END AS taken
    FROM placed
    """,
)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(read(spark, sf, "documents")).drop("source")


#: The rules to judge by.
URL_RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)
_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query(
    "op9_url_filter",
    f"""
    WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_ROWS}),
    split AS (
      SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
             row_number() OVER () AS n
      FROM pages
    ), fits AS (
      SELECT n, max_by(struct_pack(rule := rule_host || rule_path, verdict := rule_verdict),
                       2 * length(rule_host || rule_path) + (rule_verdict = 'block')::INT) AS best
      FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY n
    )
    SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
    FROM split LEFT JOIN fits USING (n)
    """,
)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_filter.judged(read(spark, sf, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op10_pii")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return pii.detected(read(spark, sf, "documents"))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op11_sentencepiece")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encoded(read(spark, sf, "documents"), vocabulary())


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return repair.audited(repair.damaged(read(spark, sf, "conversations")))


@query("op13_prefix_trie")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.nodes(read(spark, sf, "conversations"))
