"""One query per operator, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import align, bitsliced, html, idcoder, langid, mixing, neardup, onebit, packing, phrases, quality, ring, warc
from weirflow.llm.common import table
from weirflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_unigram_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query
def op2_context_mixing_ids(spark, sf_dir):
    return idcoder.encode_documents(table(spark, sf_dir, "documents"))


@_query
def op3_ring_shards(spark, sf_dir):
    return ring.shard_documents(table(spark, sf_dir, "documents"))


@_query
def op5_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op6_mix_sources(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@_query
def op4_bit_sliced_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return bitsliced.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


ORACLE_SQL["op4_bit_sliced_top_k"] = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""


@_query
def op7_genetic_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_query
def op8_main_text(spark, sf_dir):
    return html.extract_main_text(table(spark, sf_dir, "pages"))


@_query
def op9_one_bit_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return onebit.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@_query
def op10_warc_fixity(spark, sf_dir):
    """All pages as WARC files in two replicas. In the second, every page whose
    id is 13 modulo 97 is damaged; the audit has to find them, and all pages are
    read back from where they are intact."""
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    index = warc.write_replicas(pages, path, damage=F.col("page_id") % 97 == 13)
    damaged = warc.audit(index, path)
    records = warc.read_records(index, path, damaged)
    return records.select(
        "page_id",
        "url",
        F.octet_length("html").cast("long").alias("n_bytes"),
        F.sha2("html", 256).alias("sha256"),
        F.concat_ws(",", F.col("damaged_replicas").cast("array<string>")).alias("damaged_replicas"),
    )


ORACLE_SQL["op10_warc_fixity"] = """
SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS n_bytes, sha256(html) AS sha256,
  CASE WHEN page_id % 97 = 13 THEN '1' ELSE '' END AS damaged_replicas
FROM pages
"""


@_query
def op12_quality_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept", "broken_rules")


_STOPS = ", ".join(f"'{word}'" for word in quality.stop_words())
ORACLE_SQL["op12_quality_rules"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT r, doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT r, unnest(range(1, len(words) - 6)) AS p,
    unnest(list_transform(range(1, len(words) - 6), lambda i: words[i:i + 7])) AS w
  FROM cut WHERE len(words) >= 8
), twice AS (
  SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1
), covered AS (
  SELECT r, count(DISTINCT p + k) AS n
  FROM windows JOIN twice USING (r, w), range(8) AS t(k) GROUP BY r
), measured AS (
  SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
    len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(words, lambda w: rtrim(w, '.,;:!?') IN ({_STOPS}))) AS n_stop_words
  FROM cut LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    concat_ws(',',
      CASE WHEN n_words < 20 THEN 'too_few_words' END,
      CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 'repeated_words' END,
      CASE WHEN 100 * word_chars NOT BETWEEN 250 * n_words AND 1200 * n_words THEN 'word_length' END,
      CASE WHEN 100 * n_symbols > 10 * n_words THEN 'symbols' END,
      CASE WHEN 100 * n_exclamations > 30 * n_words THEN 'exclamations' END,
      CASE WHEN 100 * n_stop_words < 4 * n_words AND (lang IS NULL OR lang IN ('de', 'en', 'es', 'fr'))
        THEN 'stop_words' END,
      CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 'repeated_lines' END
    ) AS broken_rules
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  broken_rules = '' AS kept, broken_rules
FROM judged
"""


@_query
def op11_token_alignment(spark, sf_dir):
    return align.align_documents(table(spark, sf_dir, "documents"))


@_query
def op13_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _phrase_counts(words: int) -> str:
    """SQL for the occurrences of all phrases of so many words."""
    return f"""
  SELECT lang, {words} AS words, w AS phrase, count(*) AS n FROM (
    SELECT lang, unnest(list_transform(range(1, len(ws) - {words - 2}),
      lambda i: array_to_string(ws[i:i + {words - 1}], ' '))) AS w
    FROM pieces WHERE len(ws) >= {words}
  ) GROUP BY ALL{" HAVING count(*) >= 100" if words > 1 else ""}"""


ORACLE_SQL["op13_phrase_collocations"] = rf"""
WITH cut AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM cut
), counts AS ({" UNION ALL ".join(map(_phrase_counts, range(1, 6)))}
), totals AS (
  SELECT lang, sum(n) AS n FROM counts WHERE words = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE words > 1
), scored AS (
  SELECT c.lang, c.phrase, c.words, c.n AS a, k, f.n AS l, g.n AS r, t.n AS n,
    (1000::HUGEINT * c.n::HUGEINT * t.n::HUGEINT) // (f.n::HUGEINT * g.n::HUGEINT) AS score
  FROM candidates c JOIN range(1, 5) AS cuts(k) ON k < c.words
  JOIN counts f ON f.lang = c.lang AND f.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN counts g ON g.lang = c.lang AND g.phrase = array_to_string(c.ws[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN candidates q
    ON s.lang = q.lang AND s.words < q.words AND 100 * q.n >= 100 * s.n
    AND contains(' ' || q.phrase || ' ', ' ' || s.phrase || ' ')
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest ANTI JOIN inside USING (lang, phrase)
)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
