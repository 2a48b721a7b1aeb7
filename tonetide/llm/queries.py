"""Queries over the test tables: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.llm import alignment, contamination, html, jaccard, language, licenses, mixing
from tonetide.llm import negatives, repeats, sequences, topk, toxicity, urls
from tonetide.llm.shared import held_out
from tonetide.sources.stages import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE_SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A public vocabulary file, installed wherever tasks run."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    """
    WITH ints AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
      FROM ints q JOIN ints c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
      WHERE q.vec_id % 50 = 0
    ),
    ranked AS (
      SELECT query_id, vec_id, score,
        row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
      FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """
)
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products for every fiftieth vector."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query(
    r"""
    WITH sized AS (
      SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        md5(coalesce(text, '')) AS hash
      FROM documents
    ),
    sources AS (
      SELECT source, sum(size)::BIGINT AS source_size,
        [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight
      FROM sized GROUP BY source
    ),
    prefix AS (
      SELECT *,
        1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS total,
        coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE AS words_before,
        coalesce(sum(weight) OVER before, 0) AS weight_before,
        sum(weight) OVER () AS weight_all,
        row_number() OVER (ORDER BY 2.0 * source_size / weight, source) AS place
      FROM sources
      WINDOW before AS (ORDER BY 2.0 * source_size / weight, source
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    levels AS (
      SELECT *, (total - words_before) / (weight_all - weight_before)::DOUBLE AS level FROM prefix
    ),
    chosen AS (
      SELECT coalesce(min_by(level, place), 0) AS level FROM levels
      WHERE 2 * source_size > weight * level
    ),
    goals AS (
      SELECT source, source_size,
        CASE WHEN 2 * source_size <= weight * chosen.level THEN (2 * source_size)::DOUBLE
          ELSE weight * chosen.level END AS target
      FROM levels, chosen
    ),
    drawn AS (
      SELECT d.doc_id, d.size, g.source_size, g.target,
        coalesce(g.target / nullif(g.source_size, 0), 0) AS rate,
        ('0x' || substr(md5(concat_ws(':', 'mix', coalesce(d.doc_id::VARCHAR, ''), d.hash,
          row_number() OVER (PARTITION BY d.doc_id, d.source, d.hash))), 1, 13))::BIGINT
          / 4503599627370496.0::DOUBLE AS draw
      FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
    ),
    copied AS (
      SELECT *, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::INTEGER
        AS copies FROM drawn
    )
    SELECT doc_id, size, source_size, target, copies, (size * copies)::BIGINT AS taken FROM copied
    """
)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.plan(table(spark, sf_dir, "documents"))


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = language.identify(docs.drop("lang"), language.fit(docs), keep_text=False)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query(
    r"""
    WITH split AS (
      SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
      FROM documents
    ),
    windows AS (
      SELECT doc_id, p, md5(array_to_string(words[p:p + 49], ' ')) AS seen
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p
            FROM split WHERE len(words) >= 50)
    ),
    firsts AS (SELECT seen, min(doc_id) AS first FROM windows GROUP BY seen),
    gone AS (
      SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS place
      FROM windows JOIN firsts USING (seen) WHERE doc_id > first
    ),
    listed AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words,
      coalesce(len(places), 0)::BIGINT AS n_removed,
      sha256(array_to_string(
        list_filter(words, lambda x, i: NOT coalesce(list_contains(places, i), FALSE)), ' '
      )) AS kept_sha256
    FROM split LEFT JOIN listed USING (doc_id)
    """
)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of what is left of every document without passages of earlier documents."""
    return repeats.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    r"""
    WITH RECURSIVE split AS (
      SELECT doc_id,
        regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x20\x09-\x0D]+'
        ) AS words
      FROM documents
    ),
    shingles AS (
      SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS p
            FROM split WHERE len(words) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
      FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY ALL
    ),
    links AS (
      SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * common >= 80 * (x.n + y.n - common)
    ),
    reached AS (
      SELECT doc_id AS a, doc_id AS b FROM sizes
      UNION
      SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
    ),
    least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
      coalesce(component_id, doc_id) AS component_id
    FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
    """
)
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of similar texts for every document."""
    return jaccard.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    found = toxicity.scores(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items of which they hold a stretch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination.leaks(docs, table(spark, sf_dir, "benchmark"))


@query()
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License paragraphs of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.fit(docs))


_URL_PARTS = r"""
      rests AS (
        SELECT page_id, url,
          CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages
      ),
      parts AS (
        SELECT page_id, url,
          translate(regexp_extract(rest, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
          regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
        FROM rests
      ),
      tokens AS (
        SELECT *, list_distinct(list_filter(
          list_transform(string_split(host, '.'), lambda w: 'host:' || w)
          || list_transform(
               string_split_regex(lower(path), '[^\p{L}\p{N}]+'), lambda w: 'path:' || w)
          || list_transform(
               string_split(lower(query), '&'), lambda w: 'query:' || split_part(w, '=', 1)),
          lambda w: NOT regexp_matches(w, '^[a-z]+:[0-9]*$')
        )) AS tokens
        FROM parts
      )
"""

URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


@query(
    rf"""
    WITH {_URL_PARTS},
      bad AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY doc_id),
      labelled AS (
        SELECT row_number() OVER () AS row, tokens, bad FROM tokens
        JOIN bad ON doc_id = TRY_CAST(
          nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:[^0-9]|$)', 1), '') AS BIGINT)
        WHERE url IS NOT NULL AND bad IS NOT NULL
      ),
      totals AS (
        SELECT count(*) AS n, count_if(bad) AS n_bad,
          ceil(least(1.0::DOUBLE, greatest(0.002::DOUBLE, 10.0::DOUBLE / greatest(count(*), 1)))
            * count(*)) AS least_rows
        FROM labelled
      ),
      frequent AS (
        SELECT token FROM (SELECT unnest(tokens) AS token FROM labelled WHERE bad)
        GROUP BY token HAVING count(*) >= (SELECT least_rows FROM totals)
      ),
      kept AS (
        SELECT row, bad, list(token ORDER BY token) AS items
        FROM (SELECT row, bad, unnest(tokens) AS token FROM labelled)
        WHERE token IN (SELECT token FROM frequent) GROUP BY row, bad
      ),
      subsets AS (
        SELECT bad, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS part
        FROM (SELECT bad, items, unnest(range(1, 1::BIGINT << len(items))) AS mask FROM kept)
      ),
      rules AS (
        SELECT part, count_if(bad)::DOUBLE / count(*) AS confidence
        FROM subsets GROUP BY part
        HAVING count_if(bad) >= (SELECT least_rows FROM totals)
          AND count_if(bad)::DOUBLE / count(*) >= 0.6::DOUBLE
          AND count_if(bad)::DOUBLE / count(*)
            / ((SELECT n_bad FROM totals)::DOUBLE / (SELECT n FROM totals)) >= 2.0::DOUBLE
      ),
      pruned AS (
        SELECT * FROM rules r WHERE NOT EXISTS (
          SELECT 1 FROM rules s WHERE len(s.part) < len(r.part)
            AND list_has_all(r.part, s.part) AND s.confidence >= r.confidence)
      ),
      found AS (
        SELECT url, max({{'confidence': confidence, 'matched': part}}) AS best
        FROM (SELECT DISTINCT url, tokens FROM tokens WHERE url IS NOT NULL) u
        JOIN pruned ON list_has_all(u.tokens, part) GROUP BY url
      ),
      listed AS (
        SELECT verdict, rule, split_part(rule, '/', 1) AS rule_host,
          substr(rule, instr(rule, '/')) AS rule_path
        FROM (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
                     ('allow', 'com/fr/'), ('block', 'com/de/')) t(verdict, rule)
      ),
      fitting AS (
        SELECT host, path, max_by(rule, len(rule)) AS rule, max_by(verdict, len(rule)) AS verdict
        FROM (SELECT DISTINCT host, path FROM parts) JOIN listed
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY host, path
      )
    SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
      coalesce(verdict, CASE WHEN best IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
      array_to_string(best.matched, ' ') AS matched, best.confidence AS confidence
    FROM parts LEFT JOIN fitting USING (host, path) LEFT JOIN found USING (url)
    """
)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url.

    The number in a page's path is the id of the document that it shows, so the document's label is
    the page's: bad if of low quality or toxic.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    shown = F.regexp_extract(urls.path(F.col("url")), r"/([0-9]{1,18})(?:\D|$)", 1)
    numbered = pages.withColumn("__doc", shown.try_cast("long"))
    labelled = numbered.join(labels, F.col("__doc") == F.col("doc_id")).select("url", "bad")
    judged = urls.judge(pages, urls.mine(labelled), URL_RULES)
    return judged.withColumn("matched", F.array_join("matched", " "))


@query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query(
    """
    WITH ints AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
      SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::BIGINT AS score
      FROM ints a JOIN ints c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
      WHERE a.vec_id % 100 = 0
    ),
    positives AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score
      FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
      (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER
        AS rank,
      vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
    """
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, some labels shifted first."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings")
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0, label=shifted)


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in every document."""
    return alignment.align(
        table(spark, sf_dir, "documents"),
        tokenizer_path("byte_bpe_50k.json"),
        tokenizer_path("piece_bpe_32k.model"),
    )


@query()
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as equal-length sequences and read from those files."""
    folder = f"{shared_dir(spark)}/ids"
    docs = table(spark, sf_dir, "documents")
    sequences.write(docs, folder, tokenizer_path("byte_bpe_50k.json"))
    return sequences.digest(spark, folder)
