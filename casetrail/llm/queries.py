"""The operators' queries, each with checking SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrail.llm import alignment, chat, common_lines, decontaminate, exact_dedup, language, lm_score, near_dedup, pieces, quality, runs, substrings, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query(
    f"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn ASC NULLS LAST, role ASC NULLS FIRST, text ASC NULLS FIRST) AS said
  FROM turns GROUP BY conv_id
), one AS (
  SELECT said, min(conv_id) AS conv_id, count(*) AS n_copies FROM whole GROUP BY said
), begun AS (
  SELECT DISTINCT said[1:k] AS said FROM (SELECT said, unnest(range(1, len(said))) AS k FROM one)
)
SELECT conv_id, len(said) AS n_turns, n_copies,
       list_aggregate([concat('{chat.OPEN}', coalesce(x.r, '{chat.DEFAULT_ROLE}'), chr(10), coalesce(x.t, ''), '{chat.CLOSE.strip()}', chr(10)) FOR x IN said], 'string_agg', '') || '{chat.END}' AS chat
FROM one ANTI JOIN begun USING (said)
"""
)
def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


@query(
    """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The older half of the documents, by id, is the history; the newer half comes in."""
    history, incoming = exact_dedup.older_half(table(spark, folder, "documents"))
    return exact_dedup.find_repeats(history, incoming).drop("in_history")


_LEAK_WORDS = """list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""


@query(
    f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_LEAK_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS win FROM (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT doc_id, {_LEAK_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
starts AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)
),
hits AS (SELECT doc_id, i, n, item_id FROM starts JOIN windows USING (win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
)
def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_leaks").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_leaks").cast("binary"), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


@query(
    """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM w
), n AS (SELECT doc_id, len(s) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n_shingles + b.n_shingles - c)
), sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  WITH RECURSIVE r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, sides.y FROM r JOIN sides ON r.y = sides.x) SELECT * FROM r
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept
FROM n JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""
)
def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.find_near_duplicates(table(spark, folder, "documents"), size=3, percent=85)


@query()
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, its ``lang`` as the declared language and its ``source`` as the host."""
    documents = table(spark, folder, "documents")
    return language.identify(documents, "text", "lang", F.lower("source"), carried=["doc_id"])


@query()
def page_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, with the declared language of its markup, its host and that host's suffix."""
    pages = table(spark, folder, "pages")
    read = pages.select(
        "page_id",
        F.regexp_extract("html", "(?i)<html[^>]*\\slang=[\"']?([A-Za-z-]+)", 1).alias("declared"),
        "url",
        F.regexp_replace("html", "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|&[a-z]+;", " ").alias("text"),
    )
    return language.identify(read, "text", "declared", language.host_of(F.col("url")), carried=["page_id"])


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score_toxicity(documents, toxicity.learn(documents, table(spark, folder, "labels")))


@query()
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality.score_quality(documents, quality.train(documents, table(spark, folder, "labels")))


@query(
    """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 12], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)
), first AS (SELECT g, min(doc_id) AS least FROM s GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM s JOIN first USING (g) WHERE least < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
)
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents")).drop("kept_text")


@query()
def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_texts(table(spark, folder, "documents"))


@query()
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces, and whether decoding them gives its text (but for the space mark) back."""
    documents = table(spark, folder, "documents")
    encoded = pieces.encode_texts(documents, pieces.load_model(pieces.default_model()))
    return encoded.select("doc_id", "n_pieces", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query(
    """
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), e AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM l
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e
), common AS (
  SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS t, count(*) AS n
  FROM k LEFT JOIN common USING (key) WHERE keep_id IS NULL OR keep_id = doc_id GROUP BY doc_id
)
SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id)
"""
)
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = common_lines.drop_common_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def tokenizer_files() -> tuple[str, str]:
    """The public files of the machine this runs on."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query()
def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.score_links(table(spark, folder, "documents"), alignment.Pair.read(*tokenizer_files()))


def _with_made_runs(id: int | None, raw: bytes | None) -> list[bytes]:
    """The words, in a tenth of the documents made periodic from a place on, both by a checksum of the id."""
    words = runs.words_of(id, raw)
    h, n = zlib.crc32(str(id).encode()), len(words)
    if id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + k % p] for k in range(n - a))]


@query()
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's runs after a tenth of the documents were made periodic; the run of most periods, and digests."""
    found = runs.find_runs(table(spark, folder, "documents"), read=_with_made_runs)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    # Runs come by start and period, so the first of equal ones stays.
    more = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    best = found.withColumn("best", F.aggregate("runs", none, lambda best, x: F.when(more(best, x), x).otherwise(best)))
    line = lambda x: F.concat(x["start"], F.lit(","), x["length"], F.lit(","), x["period"], F.lit("\n"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )
