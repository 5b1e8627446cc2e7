"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import (
    collocations, decontamination, language_id, licenses, line_dedup, packing, periodic_runs, quality_rules, secret_scan, simhash, toxicity,
    url_filters, warc,
)

TOKENIZER_FILE, RANKS_FILE = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
# The rules of the query's contract.
HOST_RULES = (
    url_filters.prefix_rule("block", "net"),
    url_filters.prefix_rule("allow", "example.net", "/en/"),
    url_filters.prefix_rule("block", "example.com", "/de/"),
    url_filters.prefix_rule("allow", "org", "/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_paths(tokenizer: str = TOKENIZER_FILE, ranks: str = RANKS_FILE) -> tuple[str, str, str]:
    """Tokenizer file, ranks file and pattern of the public tokenizers that are installed."""
    import public_tokenizers

    return public_tokenizers.path(tokenizer), public_tokenizers.path(ranks), public_tokenizers.PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    names = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return judged.select(F.col("id").alias("doc_id"), "n_words", *names)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), *tokenizer_paths()).withColumnRenamed("id", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, _, _ = warc.archive(_table(spark, sf_dir, "pages"))
    return warc.numbered(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "order_no")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.array_join("licenses", ",").alias("licenses"), "matches", F.round("best", 6).alias("best"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secret_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", F.sha2(F.col("secret").cast("binary"), 256).alias("secret_sha256"), F.round("probability", 6).alias("probability"), "is_secret")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The query's SQL has one word for lines of every length; the pipeline takes the bound that grows.
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), words_per_edit=None)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filters.rule_table(spark, HOST_RULES + url_filters.DEFAULT_PATTERNS)
    judged = url_filters.judge(_table(spark, sf_dir, "pages"), rules)
    by_host = F.col("rank") >= 1_000_000
    return judged.select(
        F.col("id").alias("page_id"), "host", "path", F.when(by_host, F.col("rule")).alias("rule"), "verdict", F.when(~by_host, F.col("rule")).alias("pattern")
    )


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """The tables have flags only, so toxic documents are graded by their dose of telling words."""
    return toxicity.train(docs, labels, grade_column="toxic", by_dose=True)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, _table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), F.round("severity", 6).alias("severity"), F.round("p_toxic", 6).alias("p_toxic"), "toxic")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    found = language_id.identify(docs, language_id.learn(docs.where(fold != 2)))
    of_id = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4))
    return found.select(
        F.col("id").alias("doc_id"), F.coalesce(of_id == 2, F.lit(False)).alias("held_out"), F.col("lang").alias("lang_pred"), F.round("score", 6).alias("score")
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's rewriting of a tenth of the documents, chosen and shaped by their ids."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words are a column of their own, so that they are split once and only where they change.
    rows = docs.withColumn("__h", h).withColumn("__words", F.when(F.pmod("__h", F.lit(10)) == 0, split)).withColumn("__g", F.floor(F.col("__h") / 10))
    n = F.size("__words")
    rows = rows.withColumn("__a", F.when(n > 0, F.pmod("__g", n)).cast("int"))
    rows = rows.withColumn("__p", (1 + F.floor((n - F.col("__a")) / (3 + F.pmod("__g", F.lit(8))))).cast("int"))
    period = F.slice("__words", F.col("__a") + 1, F.col("__p"))
    tail = F.flatten(F.array_repeat(period, F.ceil((n - F.col("__a")) / F.col("__p")).cast("int")))
    rewritten = F.slice(F.concat(F.slice("__words", F.lit(1), F.col("__a")), tail), F.lit(1), n)
    return rows.withColumn("text", F.when(F.col("__a").isNotNull(), F.array_join(rewritten, " ")).otherwise(F.col("text"))).select(docs.columns)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.periodic_runs(docs)
    # Of two runs the one with the greater length / period comes first, by whole numbers.
    best = F.expr("""
        aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>), (best, r) ->
          IF(best IS NULL OR CAST(r.length AS DECIMAL(19)) * best.period > CAST(best.length AS DECIMAL(19)) * r.period, r, best))""")
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    sha256 = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select("id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), sha256(listed).alias("runs"), sha256(F.col("text")).alias("text")).select(
        F.col("id").alias("doc_id"), "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"), F.col("runs").alias("runs_sha256"), F.col("text").alias("collapsed_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_simhash": op5_simhash,
    "op6_license_scan": op6_license_scan,
    "op7_secret_scan": op7_secret_scan,
    "op8_line_dedup": op8_line_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_toxicity": op10_toxicity,
    "op11_language_id": op11_language_id,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

SQL: dict[str, str] = {
    "op2_decontamination": f"""
WITH docs AS (SELECT doc_id, {_WORDS.format("text")} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(words)) AS size, array_to_string(words[i:i + 12], ' ') AS w
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, sizes WHERE len(words) >= size)),
hits AS (SELECT DISTINCT doc_id, item, i, runs.size FROM runs JOIN windows ON runs.w = windows.w AND runs.size = windows.size),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op4_warc": r"""
WITH cut AS (SELECT *, regexp_replace(url, '^[^:/?#]*://', '') AS rest FROM pages),
parts AS (SELECT *, regexp_extract(rest, '^([^/?#]*)', 1) AS host FROM cut),
keyed AS (
  SELECT page_id, html, array_to_string(list_reverse(string_split(regexp_replace(lower(host), '^www\.', ''), '.')), ',') || ')'
    || lower(regexp_replace(substr(rest, length(host) + 1), '#.*$', '')) AS url_key,
    strftime(TIMESTAMP '2020-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS captured,
    CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first
  FROM parts)
SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to,
  url_key, captured, row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS order_no
FROM keyed
""",
    "op8_line_dedup": r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
lines AS (SELECT doc_id, pos, line, list_filter(regexp_split_to_array(line, '[\t\n\x0B\x0C\r ]+'), lambda w: w <> '') AS words FROM split),
named AS (SELECT *, array_to_string(words, ' ') AS k FROM lines WHERE len(words) > 0),
firsts AS (SELECT k, any_value(words) AS words, min((doc_id, pos)) AS e FROM named GROUP BY k),
gaps AS (SELECT k, words, e, unnest(range(1, len(words) + 1)) AS gap FROM firsts WHERE len(words) >= 5),
variants AS (SELECT k, len(words) AS n, e, gap, array_to_string(list_concat(words[:gap - 1], words[gap + 1:]), ' ') AS v FROM gaps),
same_gap AS (SELECT v, gap, min(e) AS e FROM variants GROUP BY v, gap),
near AS (
  SELECT variants.k FROM variants JOIN same_gap USING (v, gap) WHERE same_gap.e < variants.e
  UNION SELECT variants.k FROM variants JOIN firsts ON variants.v = firsts.k WHERE variants.n >= 6 AND firsts.e < variants.e
  UNION SELECT firsts.k FROM variants JOIN firsts ON variants.v = firsts.k WHERE variants.n >= 6 AND variants.e < firsts.e),
gone AS (
  SELECT doc_id, pos FROM named JOIN firsts USING (k) WHERE (doc_id, pos) <> e OR k IN (SELECT k FROM near)),
judged AS (SELECT lines.*, gone.pos IS NOT NULL AS out FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.pos = gone.pos),
summed AS (
  SELECT doc_id, count(*) FILTER (len(words) > 0) AS n_lines, count(*) FILTER (out) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT out), '') AS kept FROM judged GROUP BY doc_id)
SELECT documents.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS text_sha256
FROM documents LEFT JOIN summed USING (doc_id)
""",
    "op9_url_filters": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*([^#]*)', 1) AS query FROM cut),
full_form AS (SELECT *, host || path || query AS f FROM named),
judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE WHEN host = '' THEN NULL
    WHEN regexp_matches(f, '^([^/?]*\.)?spam-farm[.-][^/?]*/') THEN 'spam farms'
    WHEN regexp_matches(f, '^([^/?]*[.-])?(cheap|online|buy)-pills[.-][^/?]*/') THEN 'pill shops'
    WHEN regexp_matches(f, '^([^/?]*[.-])?casino[.-][^/?]*/') THEN 'casino hosts'
    WHEN regexp_matches(f, '^([^/?]*[.-])?(free|live)-bets[.-][^/?]*/') THEN 'betting hosts'
    WHEN regexp_matches(f, '^([^/?]*\.)?ads-track(er|ing)?[.-][^/?]*/') THEN 'ad trackers'
    WHEN regexp_matches(f, '^[^?]*/\d+\.html$') THEN 'archived pages'
    WHEN regexp_matches(f, '\?(.*&)?utm_source=feed(&|$)') THEN 'campaign feeds' END AS other FROM full_form)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN other IS NULL OR other = 'archived pages' THEN 'allow' ELSE 'block' END AS verdict,
  CASE WHEN rule IS NULL THEN other END AS pattern
FROM judged
""",
    "op12_periodic_runs": r"""
WITH coded AS (
  SELECT row_number() OVER () AS doc, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda b: (ascii(c) >> b) & 1))) AS bits
  FROM documents),
named AS (
  SELECT *, len(words) AS n, xor(4294967295, list_reduce(list_prepend(4294967295, bits),
    lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END))) AS h FROM coded),
shaped AS (SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS parts FROM named),
docs AS (
  SELECT doc, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END]) ELSE words END AS words FROM shaped),
placed AS (SELECT doc, n, unnest(range(n)) AS i, unnest(words) AS w FROM docs),
same AS (
  SELECT x.doc, x.i, y.i - x.i AS q FROM placed x JOIN placed y ON x.doc = y.doc AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // 4),
grouped AS (SELECT *, i - row_number() OVER (PARTITION BY doc, q ORDER BY i) AS island FROM same),
stretched AS (SELECT doc, q, min(i) AS s, count(*) + q AS m FROM grouped GROUP BY doc, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc, s, m, min(q) AS q FROM stretched GROUP BY doc, s, m),
best AS (
  SELECT doc, s, m, q FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY CAST(m AS DECIMAL(38, 18)) / q DESC, s, q) AS place FROM runs) WHERE place = 1),
listed AS (SELECT doc, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM runs GROUP BY doc),
dropped AS (SELECT DISTINCT doc, unnest(range(s + q, s + m)) AS i FROM runs),
kept AS (
  SELECT doc, string_agg(w, ' ' ORDER BY i) AS kept FROM placed ANTI JOIN dropped USING (doc, i) GROUP BY doc)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(s AS BIGINT) AS start, CAST(m AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
  CAST(1000 * m // q AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (doc) LEFT JOIN best USING (doc) LEFT JOIN kept USING (doc)
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
starts AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM split, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
counts AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM starts GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k >= 2 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM candidates),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS score FROM cuts
  JOIN counts x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[:c], ' ')
  JOIN counts y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[c + 1:], ' ')),
cut AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scored) WHERE place = 1),
inner_size AS (SELECT lang, ws, k, a AS f, unnest(range(2, k)) AS size FROM candidates),
inner_place AS (SELECT *, unnest(range(1, k - size + 2)) AS i FROM inner_size),
longer AS (SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, max(f) AS longer FROM inner_place GROUP BY ALL),
kept AS (
  SELECT cut.* FROM cut LEFT JOIN longer ON cut.lang = longer.lang AND cut.phrase = longer.phrase WHERE coalesce(100 * longer < 80 * a, true)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
}
