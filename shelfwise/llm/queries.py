"""Registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (bpe, decontaminate, iblt, langid, linededup, periodic, quality, resample, simhash, substrings, tokencounts, toxicity,
                           urlfilter)
from shelfwise.llm.common import read

#: Where the public tokenizer files lie; any path that the driver can open.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, toxicity.learn(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item, its place and its edits."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contaminations(docs, read(spark, sf_dir, "benchmark"), short_items=True, short_edits=True)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lose sentences, with the text left and the documents that keep what went."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return substrings.remove_repeats(docs, only_changed=True, report=True)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprint_versions(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.identify(docs, langid.learn(docs))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    return linededup.drop_boilerplate(docs, dropped="n_dropped").select("doc_id", "text", "n_dropped")


#: (host, path) rules of the production filter.
URL_RULES = (
    urlfilter.host_rule(urlfilter.BLOCK, "net", "/"), urlfilter.host_rule(urlfilter.ALLOW, "example.net", "/en/"),
    urlfilter.host_rule(urlfilter.BLOCK, "example.com", "/de/"), urlfilter.host_rule(urlfilter.ALLOW, "org", "/fr/"),
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


URL_SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
named AS (SELECT page_id, path, '.' || h AS dotted, h AS host FROM (SELECT *, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h FROM parts)),
ruled AS (SELECT *, CASE WHEN dotted LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN dotted LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN dotted LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/' WHEN dotted LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM named)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path()).select("doc_id", "n_tokens")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return quality.score(docs, quality.learn(docs, read(spark, sf_dir, "labels", "doc_id", "quality")))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth of the documents that is drawn towards the benchmark's words, with every document's score."""
    drawn = resample.resample(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


RESAMPLE_SQL = r"""
WITH step AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
docs AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
wanted AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
used AS (SELECT r, unnest(words) AS w FROM docs),
hexed AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM used UNION SELECT w FROM wanted)),
bytes AS (SELECT w, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)) AS b FROM hexed),
buckets AS (SELECT w, xor(list_reduce(list_prepend(4294967295, b), lambda c, d: xor(c >> 8, t[(xor(c, d) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM bytes, step),
source AS (SELECT bucket, count(*) AS n FROM used JOIN buckets USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM wanted JOIN buckets USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM used)::DOUBLE AS s, (SELECT count(*) FROM wanted)::DOUBLE AS t),
gains AS (SELECT source.bucket, floor(1000 * ln(((coalesce(target.n, 0) + 1.0::DOUBLE) * (totals.s + 10000)) /
    ((source.n + 1.0::DOUBLE) * (totals.t + 10000))))::BIGINT AS gain FROM source LEFT JOIN target USING (bucket), totals),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM used JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, r, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) +
    floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM docs LEFT JOIN weights USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (r)
"""


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words, after runs are planted in a tenth of the documents."""
    docs = periodic.with_planted_runs(read(spark, sf_dir, "documents", "doc_id", "text"))
    return periodic.digests(periodic.periodic_runs(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontaminate": op2_decontaminate,
    "op3_simhash": op3_simhash,
    "op4_substrings": op4_substrings,
    "op5_fingerprints": op5_fingerprints,
    "op6_langid": op6_langid,
    "op7_line_dedup": op7_line_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_token_counts": op9_token_counts,
    "op10_bpe": op10_bpe,
    "op11_quality": op11_quality,
    "op12_resample": op12_resample,
    "op13_periodic": op13_periodic,
}

#: DuckDB SQL of those that SQL can express.
SQL: dict[str, str] = {
    "op7_line_dedup": linededup.SQL,
    "op8_url_filter": URL_SQL,
    "op12_resample": RESAMPLE_SQL,
}
