"""The named queries of this package, each over its whole table, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import (
    decontamination, exact_dedup, filter_audit, html_extraction, licenses, mixing, ngram_join, periodic_runs, quality, repetition,
    token_counts, toxicity, warc,
)
from brindle.session import tune
from brindle.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql.strip()
        return fn

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_toxicity")
def op2_toxicity(t: Tables) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.scores(t.documents, t.labels, "toxic", modulus=3, keep_out=1, at=0.7)


@query("op3_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY sha256({LOWERED}) ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256({LOWERED}) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY sha256({LOWERED}))
""")
def op3_exact_dedup(t: Tables) -> DataFrame:
    """Which document of equal texts stays."""
    return exact_dedup.decide(t.documents)


@query("op6_quality")
def op6_quality(t: Tables) -> DataFrame:
    """Quality of every document."""
    return quality.scores(t.documents, t.labels, "quality", modulus=5, keep_out=0, at=0.3)


@query("op8_token_counts")
def op8_token_counts(t: Tables) -> DataFrame:
    """Tokens of every document."""
    return token_counts.token_counts(t.documents, tokenizer_path(), limit=1024)


WORDS = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(LOWERED)


@query("op1_decontamination", f"""
WITH item AS (
  SELECT item_id, words, least(len(words), 13) AS k
  FROM (SELECT item_id, {WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL) WHERE len(words) > 0
), win AS (
  SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS g
  FROM (SELECT item_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM item)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents
), place AS (
  SELECT r, k, p, array_to_string(words[p:p + k - 1], ' ') AS g
  FROM (SELECT r, k, words, unnest(range(1, len(words) - k + 2)) AS p FROM doc, (SELECT DISTINCT k FROM item))
), found AS (
  SELECT r, p, k, item_id FROM place JOIN win USING (k, g)
), hit AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""")
def op1_decontamination(t: Tables) -> DataFrame:
    """Words of every document that stand in windows of benchmark items."""
    found = decontamination.contamination(t.documents, t.benchmark)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("benchmark_proximity")
def benchmark_proximity(t: Tables) -> DataFrame:
    """Benchmark items whose windows stand in a document with up to three other words in between, or none."""
    found = decontamination.proximity(t.documents, t.benchmark)
    return found.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_starts"), F.min("start").alias("first_start"),
        F.min("apart").alias("least_apart"), F.max("apart").alias("most_apart"),
    )


@query("op9_ngram_join", f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
gram AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM d
), sets AS (
  SELECT doc_id, md5(string_agg(s, '|' ORDER BY s)) AS h, count(*) AS n FROM gram GROUP BY doc_id
), class AS (
  SELECT h, min(doc_id) AS class_id, count(*) AS class_size, max(n) AS n FROM sets GROUP BY h
), own AS (
  SELECT class_id, s FROM class JOIN gram ON doc_id = class_id
), pair AS (
  SELECT a.class_id AS a, b.class_id AS b, count(*) AS shared FROM own a JOIN own b USING (s) WHERE a.class_id <> b.class_id GROUP BY ALL
), link AS (
  SELECT a, b FROM pair JOIN class x ON x.class_id = a JOIN class y ON y.class_id = b WHERE 5 * shared >= 4 * (x.n + y.n - shared)
), reach AS (
  SELECT class_id AS a, class_id AS b FROM class UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
), grouped AS (
  SELECT a AS class_id, min(b) AS group_id FROM reach GROUP BY a
), counted AS (
  SELECT a AS class_id, count(*) AS n_links FROM link GROUP BY a
)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(class_size, 1) AS class_size, coalesce(n_links, 0) AS n_links,
       coalesce(group_id, d.doc_id) AS group_id
FROM d LEFT JOIN sets USING (doc_id) LEFT JOIN class USING (h) LEFT JOIN grouped USING (class_id) LEFT JOIN counted USING (class_id)
""")
def op9_ngram_join(t: Tables) -> DataFrame:
    """Class, links and group of every document under the Jaccard coefficient of word 5-grams, 0.8 or more."""
    return ngram_join.similar(t.documents)


#: What part of the tokens each domain is to have; of those that are left if other domains, which keep theirs, are there.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the mixture: labelled documents, whose domain is their language."""
    return docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text", F.col("lang").alias("domain"))


@query("op5_mixing")
def op5_mixing(t: Tables) -> DataFrame:
    """Rate of every document, so that languages have their parts of the tokens."""
    return mixing.rates(t.documents, domains(t.documents, t.labels), TARGETS, keep_others=True).drop("text_key")


HTML = "coalesce(html, '')"


@query("op4_warc", f"""
WITH p AS (
  SELECT page_id, strlen({HTML}) AS n, sha1({HTML}) AS digest, max(page_id) OVER (PARTITION BY {HTML}) AS best FROM pages
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM best THEN best END AS refers_to
FROM p
""")
def op4_warc(t: Tables) -> DataFrame:
    """Archives of all pages, written and read back."""
    found = warc.read(warc.write(t.pages), t.pages.schema["page_id"].dataType.simpleString(), with_payload=False)
    return found.drop("url")


@query("op7_html_extraction")
def op7_html_extraction(t: Tables) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract(t.pages)


@query("op10_license_scan")
def op10_license_scan(t: Tables) -> DataFrame:
    """License notices of every document."""
    return licenses.scan(t.documents)


BLANK_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


@query("op11_repetition", f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {BLANK_WORDS} AS w FROM documents
), line AS (
  SELECT r, count(*) - count(DISTINCT x) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY r
), repeat_of_three AS (
  SELECT r, p FROM (
    SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n
    FROM (SELECT r, unnest(range(1, len(w) - 1)) AS p, unnest([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) AS g FROM d)
  ) WHERE n > 1
), n_3 AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 3)) AS q FROM repeat_of_three) GROUP BY r),
long_repeat AS (
  SELECT r, p FROM (
    SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n
    FROM (SELECT r, unnest(range(1, len(w) - {repetition.LEAST_REPEAT} + 2)) AS p,
                 unnest([array_to_string(w[i:i + {repetition.LEAST_REPEAT} - 1], ' ') FOR i IN range(1, len(w) - {repetition.LEAST_REPEAT} + 2)]) AS g FROM d)
  ) WHERE n > 1
), n_long AS (
  SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + {repetition.LEAST_REPEAT})) AS q FROM long_repeat) GROUP BY r
), start AS (SELECT r, list(p) AS ps FROM long_repeat GROUP BY r),
too_long AS (
  SELECT DISTINCT r FROM (
    SELECT r, count(*) OVER (PARTITION BY r, g) AS n
    FROM (SELECT r, unnest([hash(w[i:i + {repetition.LONGEST_REPEAT}]) FOR i IN ps IF i + {repetition.LONGEST_REPEAT} <= len(w)]) AS g FROM d JOIN start USING (r))
  ) WHERE n > 1
), counted AS (
  SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(line.n, 0) AS n_dup_lines,
         coalesce(n_3.n, 0) AS n_repeat_words, coalesce(n_long.n, 0) AS n_covered
  FROM d LEFT JOIN line USING (r) LEFT JOIN n_3 USING (r) LEFT JOIN n_long USING (r)
), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_covered <= {repetition.MOST_COVERED} * n_words AND too_long.r IS NULL AS kept
FROM judged LEFT JOIN too_long ON too_long.r = judged.r
""")
def op11_repetition(t: Tables) -> DataFrame:
    """What every document repeats, and whether that is little enough to keep it."""
    found = repetition.judge(t.documents)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op12_filter_audit", f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {BLANK_WORDS} AS w FROM documents
), least AS (SELECT text, min(doc_id) AS doc_id FROM d GROUP BY text),
label AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
row_of AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
          100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * length(d.text),
          regexp_matches(d.text, '[#$%&*|]'), coalesce(least.doc_id < d.doc_id, false)] AS fails
  FROM d JOIN least USING (text) LEFT JOIN label ON label.doc_id = d.doc_id
), counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM row_of GROUP BY part, fails
), letter AS (SELECT unnest(range(1, 6)) AS k),
filter_list AS (
  SELECT [a.k, b.k, c.k, e.k, f.k] AS ks FROM letter a, letter b, letter c, letter e, letter f
  WHERE len(list_distinct([a.k, b.k, c.k, e.k, f.k])) = 5
), step_of AS (
  SELECT array_to_string([chr(CAST(64 + k AS INTEGER)) FOR k IN ks], '') AS filter_order, CAST(step AS INTEGER) AS step, ks[step] AS k, ks[1:step - 1] AS before
  FROM (SELECT ks, unnest(range(1, 6)) AS step FROM filter_list)
), each AS (
  SELECT part, filter_order, step, k, n, good, toxic, fails[k] AS failing,
         coalesce(list_bool_or([fails[b] FOR b IN before]), false) AS gone,
         fails[k] AND len([1 FOR f IN fails IF f]) = 1 AS only_one
  FROM counted, step_of
), summed AS (
  SELECT part, filter_order, step, k,
         CAST(coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (failing AND NOT gone), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (failing AND gone), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (only_one), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (failing AND NOT gone), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (failing AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM each GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM summed
""")
def op12_filter_audit(t: Tables) -> DataFrame:
    """What each of five filters removes from every source, in each order of the filters."""
    return filter_audit.audit(t.documents, t.labels)


#: The CRC-32 of the decimal doc_id, bit by bit; NULL has none.
CRC = """
  SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295,
    [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) AS h
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
"""


@query("op13_periodic_runs", f"""
WITH crc AS ({CRC}),
d AS (
  SELECT row_number() OVER () AS r, doc_id, w, len(w) AS n, h % 10 = 0 AS moved, h // 10 AS g
  FROM (SELECT doc_id, {BLANK_WORDS} AS w FROM documents) LEFT JOIN crc USING (doc_id)
), place AS (SELECT *, unnest(range(n)) AS i FROM d),
word AS (
  SELECT r, i, n, CASE WHEN moved AND i >= g % n THEN w[g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) + 1] ELSE w[i + 1] END AS v
  FROM place
), equal AS (
  SELECT a.r, b.i - a.i AS q, a.i FROM word a JOIN word b ON a.r = b.r AND a.v = b.v AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
), island AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM equal) GROUP BY r, q, k
  HAVING count(*) + q >= greatest(6, 4 * q)
), run AS (SELECT r, start, length, min(q) AS period FROM island GROUP BY r, start, length),
per AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM run GROUP BY r
), top AS (
  SELECT r, start, length, period FROM run
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY 1000000000000 * length // period DESC, start, period) = 1
), dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run),
rest AS (
  SELECT r, string_agg(v, ' ' ORDER BY i) AS kept FROM word ANTI JOIN dropped USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (r) LEFT JOIN top USING (r) LEFT JOIN rest USING (r)
""")
def op13_periodic_runs(t: Tables) -> DataFrame:
    """Periodic runs of words in every document."""
    return periodic_runs.digests(t.documents)
