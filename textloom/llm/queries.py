"""Queries over the operators of this subpackage and, where SQL can express them, their checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, decontaminate, divergence, host_rules, licences, neighbours, passages, pii, prefix_trie, simhash, token_files, toxicity, warc
from textloom.plans.session import stage_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            CHECKS[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document and the text they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), path, decoded="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


@query()
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token files of all documents hold, read back from them."""
    path = stage_path(spark, "tokens")
    token_files.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    tokens = token_files.with_crc32(token_files.with_start(token_files.read(spark, path)))
    return tokens.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


_BASE_COUNTS = r"""
WITH words AS (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, coalesce(text, '') AS t FROM documents),
windows AS (
  SELECT doc_id, p, list_slice(w, p, p + 4) AS five FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM words WHERE len(w) >= 5)
),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows) WHERE n > 1),
inside AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS lines, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
counted AS (
  SELECT words.doc_id, source, len(w) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(lines.lines, 0) AS n_lines, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(inside.n, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN lines ON words.doc_id = lines.doc_id LEFT JOIN inside ON words.doc_id = inside.doc_id
),
ruled AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
failing AS (
  SELECT source, unnest(['base', 'symbols', 'lines', 'words']) AS rule, unnest([base_failed, 100 * n_symbols > 10 * word_chars,
    100 * n_dup_lines > 30 * n_lines, word_chars < 2 * n_words OR word_chars > 15 * n_words]) AS fails FROM ruled
),
hosts AS (SELECT source, rule, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE fails) AS DOUBLE) AS failed FROM failing GROUP BY source, rule),
moments AS (SELECT rule, count(*) AS k, sum(n) AS n, sum(n * n) AS squares, sum(failed) / sum(n) AS m, sum(failed) AS failed, sum(failed * (failed / n)) AS by_rate FROM hosts GROUP BY rule),
fitted AS (
  SELECT rule, m, CASE WHEN m * (1 - m) <= 0 OR n - squares / n - (k - 1) <= 0 THEN 0.0
    ELSE ((by_rate - m * failed) / (m * (1 - m)) - (k - 1)) / (n - squares / n - (k - 1)) END AS correlation FROM moments
),
prior AS (SELECT rule, m, CASE WHEN correlation <= 0 THEN 10000.0 ELSE least(10000.0, greatest(1.0, 1 / correlation - 1)) END AS strength FROM fitted),
verdicts AS (
  SELECT source, bool_or((failed + m * strength) / (n + strength) >= least(0.5, greatest(0.3, m + 3 * sqrt(m * (1 - m) / (strength + 1))))) AS host_failed
  FROM hosts JOIN prior ON hosts.rule = prior.rule GROUP BY source
)
"""


@query(_BASE_COUNTS + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_failed AS kept
FROM ruled JOIN verdicts ON ruled.source IS NOT DISTINCT FROM verdicts.source
""")
def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of each document and its host."""
    return host_rules.judge(_table(spark, sf_dir, "documents")).drop("host", "n_lines", "host_failed")


@query(r"""
WITH item_words AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc_words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM item_words WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc_words, sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, p, places.n, item_id FROM places JOIN windows ON places.win = windows.win AND places.n = windows.n),
hit_words AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(a.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(b.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, a.n IS NOT NULL AS contaminated
FROM doc_words d LEFT JOIN hit_words a ON d.doc_id = a.doc_id LEFT JOIN hit_items b ON d.doc_id = b.doc_id
""")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside passages of the benchmark, and the items they come from."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each document by a model that has seen the labels of two thirds of the labelled keys."""
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.train(documents, _table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS holder FROM p)
SELECT page_id, payload_bytes, sha1(encode(html)) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < holder THEN holder END AS refers_to
FROM q
""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's record as read back from the archives."""
    records = warc.round_trip(spark, _table(spark, sf_dir, "pages"))
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document, as counts and offsets."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, pii.KINDS))

    def joined(spans):
        one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(one, ",")

    counts = [F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{name}") for i, name in enumerate(pii.KINDS)]
    spans = F.sort_array(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(spans).alias("spans"))


@query()
def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document repeats from one with a smaller id."""
    found = passages.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("other", "other_doc_id")


def _templates_sql() -> str:
    rows = ", ".join(f"('{name}', '{text}')" for name, text in sorted(licences.TEMPLATES.items()))
    return f"(SELECT * FROM (VALUES {rows}) AS v(license, body))"


@query(f"""
WITH parts AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS body FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
  UNION ALL SELECT doc_id, 0, text FROM documents WHERE contains(text, chr(10))
),
bodies AS (SELECT doc_id, line, body FROM parts UNION ALL SELECT -1, row_number() OVER (ORDER BY license), body FROM {_templates_sql()}),
cut AS (SELECT doc_id, line, regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS w FROM bodies),
pairs AS (SELECT DISTINCT doc_id, line, w[p] || ' ' || w[p + 1] AS pair FROM (SELECT *, unnest(range(1, len(w))) AS p FROM cut WHERE len(w) > 1)),
sizes AS (SELECT doc_id, line, count(*) AS n FROM pairs GROUP BY doc_id, line),
met AS (
  SELECT a.doc_id, a.line, b.line AS t, count(*) AS shared FROM pairs a JOIN pairs b ON a.pair = b.pair AND b.doc_id = -1 AND a.doc_id <> -1
  GROUP BY a.doc_id, a.line, b.line
),
named AS (SELECT row_number() OVER (ORDER BY license) AS t, license FROM {_templates_sql()}),
scored AS (
  SELECT met.doc_id, met.line, license, 2 * shared / (a.n + b.n) AS dice
  FROM met JOIN sizes a ON met.doc_id = a.doc_id AND met.line = a.line JOIN sizes b ON b.doc_id = -1 AND met.t = b.line JOIN named ON met.t = named.t
)
SELECT doc_id, CAST(line AS INTEGER) AS line, license, dice FROM scored WHERE dice >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license) = 1
""")
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licences.scan(_table(spark, sf_dir, "documents"))


@query(r"""
WITH docs AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT i, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
langs AS (SELECT d.lang, count(term) AS v, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang FROM docs) d LEFT JOIN kept ON d.lang = kept.lang GROUP BY d.lang),
counted AS (SELECT words.lang, source, words.term, count(*) AS c FROM words JOIN kept ON words.lang = kept.lang AND words.term = kept.term GROUP BY ALL),
sizes AS (SELECT lang, source, sum(c) AS n FROM counted GROUP BY ALL),
pairs_of AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
  SELECT g.lang, g.source, kept.term, coalesce(counted.c, 0) AS c,
    1 + 1000000000 * (coalesce(counted.c, 0) + 1) // (coalesce(sizes.n, 0) + v) AS p, 1 + 1000000000 * (kept.c + 1) // (langs.n + v) AS whole
  FROM pairs_of g JOIN langs ON g.lang = langs.lang JOIN kept ON g.lang = kept.lang
  LEFT JOIN sizes ON g.lang = sizes.lang AND g.source = sizes.source
  LEFT JOIN counted ON g.lang = counted.lang AND g.source = counted.source AND kept.term = counted.term
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(apart.value, 0) AS value
  FROM pairs_of a JOIN pairs_of b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON a.lang = apart.lang AND a.source = apart.source AND b.source = apart.item
  UNION ALL SELECT lang, source, 'term', term, CAST((p - whole) * (p - whole) // whole AS BIGINT) FROM shares WHERE c > 0 AND p > whole
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM both_parts
QUALIFY part = 'pair' OR rank <= 200
""")
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of each source to its peers, and the terms in which it stands out from its language."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


@query("""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS t,
    list_reduce(
      list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda x, s: CASE WHEN s >= 0 THEN xor(x, s) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
    ) AS inverted
  FROM c GROUP BY conv_id
),
heads AS (SELECT *, (4294967295 - inverted) % 6 AS h FROM own),
again AS (SELECT a.conv_id, list_concat(list_slice(coalesce(b.t, []), 1, a.h), list_slice(a.t, a.h + 1, len(a.t))) AS t FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
begun AS (SELECT conv_id, d, len(t) = d AS ends, md5(CAST(list_slice(t, 1, d) AS VARCHAR)) AS node, md5(CAST(list_slice(t, 1, d - 1) AS VARCHAR)) AS parent, CASE WHEN d = 0 THEN 0 ELSE length(t[d].text) END AS n
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM again)),
nodes AS (
  SELECT d, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM begun GROUP BY d, node
),
children AS (SELECT d - 1 AS d, parent AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
totals AS (
  SELECT begun.d, begun.node, sum(saved) AS saved, count(*) FILTER (WHERE children.n IS NULL) AS leaves
  FROM nodes LEFT JOIN children ON nodes.d = children.d AND nodes.node = children.node JOIN begun ON begun.conv_id = nodes.conv_id AND begun.d <= nodes.d GROUP BY ALL
)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children, leaves AS n_leaves,
  CAST(totals.saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN totals ON nodes.d = totals.d AND nodes.node = totals.node
LEFT JOIN children ON nodes.d = children.d AND nodes.node = children.node
LEFT JOIN nodes up ON up.d = nodes.d - 1 AND up.node = nodes.parent
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations' beginnings, with what sharing them would save."""
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


@query()
def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors found for every twentieth id."""
    return neighbours.search(_table(spark, sf_dir, "embeddings"), "id % 20 = 0")
