"""One query per operator, each over its whole table, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.llm import (
    collocations, decontaminate, htmltext, lines, mixing, near_dup, passages, periodic, perplexity, quality, quotations, sharding, toxicity)
from weftline.session import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


SHARDS = [f"shard-{i:02d}" for i in range(16)]
SLOTS = sharding.prime_at_least(sharding.SLOTS_PER_SHARD * len(SHARDS) + 1)

SHARD_TABLE_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i, printf('shard-%02d', i) AS shard,
         ('0x' || substr(md5('start:' || printf('shard-%02d', i)), 1, 8))::BIGINT % {SLOTS} AS start,
         ('0x' || substr(md5('step:' || printf('shard-%02d', i)), 1, 8))::BIGINT % {SLOTS - 1} + 1 AS step
  FROM range({len(SHARDS)}) AS r(i)),
orders AS (
  SELECT i, list((start + t * step) % {SLOTS} ORDER BY t) AS prefs FROM shards, range({SLOTS}) AS q(t) GROUP BY i),
turns(n, slot, free) AS (
  SELECT 0::BIGINT, -1::BIGINT, range({SLOTS})::BIGINT[]
  UNION ALL
  SELECT n + 1, x.slot, list_filter(free, lambda f: f <> x.slot)
  FROM (SELECT t.n, t.free, list_filter(o.prefs, lambda p: list_contains(t.free, p))[1] AS slot
        FROM turns t JOIN orders o ON o.i = t.n % {len(SHARDS)} WHERE t.n < {SLOTS}) x),
claimed AS (SELECT slot, printf('shard-%02d', (n - 1) % {len(SHARDS)}) AS shard FROM turns WHERE n > 0)
"""


@query(SHARD_TABLE_SQL + f"""
SELECT doc_id, slot, shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0))), 1, 8))::BIGINT % {SLOTS} AS slot FROM documents)
JOIN claimed USING (slot)""")
def op1_shard_placement(spark: SparkSession, folder: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.assign(table(spark, folder, "documents"), "doc_id", SHARDS, SLOTS).select("doc_id", "slot", "shard")


@query("""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
held AS (SELECT key, min(doc_id) AS lo, count(DISTINCT doc_id) AS n FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.doc_id, pos, line, (n >= 2 AND k.doc_id <> lo) IS TRUE AS gone FROM keyed k LEFT JOIN held USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Line counts, dropped lines and a digest of the kept text of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    applied = lines.apply_bitmaps(docs, lines.dedup_bitmaps(docs))
    return applied.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source),
total AS (SELECT sum(source_size)::BIGINT AS t FROM sources),
levels(step, rest, weights) AS (
  SELECT 0, (SELECT t FROM total), (SELECT sum(weight)::BIGINT FROM sources)
  UNION ALL
  SELECT step + 1, (SELECT t FROM total) - s.o, s.u FROM levels l, LATERAL (
    SELECT coalesce(sum(3 * source_size) FILTER (3 * source_size * l.weights <= l.rest * weight), 0)::BIGINT AS o,
           coalesce(sum(weight) FILTER (NOT 3 * source_size * l.weights <= l.rest * weight), 0)::BIGINT AS u FROM sources) s
  WHERE s.u > 0 AND (s.u <> l.weights OR (SELECT t FROM total) - s.o <> l.rest)),
level AS (SELECT rest, weights FROM levels ORDER BY step DESC LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN 3 * source_size * weights <= rest * weight THEN (3 * source_size)::DOUBLE
         ELSE rest::DOUBLE * weight::DOUBLE / weights::DOUBLE END AS target FROM sources, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken FROM rated""")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Size, source target and words taken of every document."""
    planned = mixing.plan_copies(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


@query("""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT i, j FROM common JOIN sizes x ON x.doc_id = i JOIN sizes y ON y.doc_id = j WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT i, j FROM links UNION ALL SELECT j, i FROM links),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT ways.j, reach.root FROM reach JOIN ways ON ways.i = reach.doc_id),
roots AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id,
       d.doc_id = coalesce(root, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN roots USING (doc_id)""")
def op8_minhash_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    """Shingle count, component and verdict of every document."""
    found = near_dup.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


@query()
def op9_qgram_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the passage, the edits and where it ends."""
    return decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every paragraph of a cluster that reaches over several documents, and every run of words that several hold.

    ``word`` is the number of a run's first word, and null for a whole line.
    """
    found = passages.repeats(table(spark, folder, "documents"))
    return found.select(F.col("doc").alias("doc_id"), F.col("pos").alias("paragraph"), "n_words", "first_doc",
                        F.col("first_pos").alias("first_paragraph"), "n_docs", "removed", "word")


@query()
def op5_weak_supervision_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; one fold of the labels is never read."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"), ~toxicity.held_out())
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op6_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; one fold of the labels is never read."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"), ~quality.held_out())
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


BASE_SQL = """
WITH worded AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM worded)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
spots AS (
  SELECT doc_id, i, w[i:i + 2] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) > 2)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM spots) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) AS r(k) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
       (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
       coalesce(n, 0)::BIGINT AS n_repeat_words,
       len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed
FROM worded w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)"""


@query()
def op4_ngram_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts, perplexities and verdict of every document (``BASE_SQL`` checks the counts)."""
    judged = perplexity.judge(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "per_byte", "per_word")


def quoting_mails(spark: SparkSession, folder: str) -> DataFrame:
    """``conversations`` as mails: each message quotes an earlier one and, one level deeper, what that quoted.

    The table holds no quote marks, so they are put there: message t answers message
    t - 1 - (conv_id + t) % 3, where there is one.
    """
    told = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    back = 1 + (F.col("conv_id") + F.col("turn")) % 3
    asked = told.withColumn("parent", F.col("turn") - back)
    def quoted(body: Column, mark: str) -> Column:
        return F.concat(F.lit(mark), F.replace(body, F.lit("\n"), F.lit("\n" + mark)), F.lit("\n"))
    first = asked.alias("p").select("conv_id", F.col("turn").alias("parent"), F.col("text").alias("said"), F.col("parent").alias("older"))
    second = told.select("conv_id", F.col("turn").alias("older"), F.col("text").alias("said_before"))
    return (asked.join(first, ["conv_id", "parent"], "left").join(second, ["conv_id", "older"], "left")
            .select("conv_id", "turn", F.concat(
                F.coalesce(quoted(F.col("said_before"), "> > "), F.lit("")), F.coalesce(quoted(F.col("said"), "> "), F.lit("")),
                F.coalesce("text", F.lit(""))).alias("text")))


@query("""
WITH RECURSIVE asked AS (SELECT conv_id, turn, text, turn - 1 - (conv_id + turn) % 3 AS parent FROM conversations),
mails AS (
  SELECT a.conv_id, a.turn, a.text, p.text AS said, g.text AS said_before
  FROM asked a LEFT JOIN asked p ON p.conv_id = a.conv_id AND p.turn = a.parent
  LEFT JOIN asked g ON g.conv_id = a.conv_id AND g.turn = p.parent),
split_lines AS (
  SELECT conv_id, turn, 0 AS level, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM mails UNION ALL
  SELECT conv_id, turn, 1, unnest(string_split(said, chr(10))) FROM mails WHERE said IS NOT NULL UNION ALL
  SELECT conv_id, turn, 2, unnest(string_split(said_before, chr(10))) FROM mails WHERE said_before IS NOT NULL),
lines AS (
  SELECT conv_id, turn, level, lower(trim(regexp_replace(line, '\\s+', ' ', 'g'))) AS norm FROM split_lines
  WHERE trim(regexp_replace(line, '\\s+', ' ', 'g')) <> ''),
sources AS (
  SELECT q.conv_id, q.turn, q.level, q.norm, count(*) AS n,
         (SELECT max(o.turn) FROM lines o WHERE o.level = 0 AND o.conv_id = q.conv_id AND o.norm = q.norm AND o.turn < q.turn) AS source
  FROM lines q WHERE level > 0 GROUP BY ALL),
counted AS (
  SELECT conv_id, turn, max(level)::INT AS quote_levels, sum(n)::BIGINT AS n_quoted,
         sum(n) FILTER (source IS NOT NULL)::BIGINT AS n_linked FROM sources GROUP BY ALL),
votes AS (SELECT conv_id, turn, level, source, sum(n) AS n FROM sources WHERE source IS NOT NULL GROUP BY ALL),
replies AS (
  SELECT conv_id, turn, source AS reply_to FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, source DESC) = 1),
nodes AS (SELECT c.conv_id, c.turn, c.text, r.reply_to FROM conversations c LEFT JOIN replies r USING (conv_id, turn)),
paths AS (
  SELECT conv_id, turn, [turn] AS path FROM nodes WHERE reply_to IS NULL UNION ALL
  SELECT n.conv_id, n.turn, list_append(p.path, n.turn) FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.turn = n.reply_to)
SELECT n.conv_id, n.turn, n.reply_to, coalesce(quote_levels, 0) AS quote_levels, coalesce(n_quoted, 0) AS n_quoted,
       coalesce(n_linked, 0) AS n_linked, row_number() OVER (PARTITION BY n.conv_id ORDER BY path) - 1 AS position,
       (len(path) - 1)::BIGINT AS depth, md5(trim(coalesce(n.text, ''), ' ' || chr(9) || chr(10) || chr(13))) AS body_md5
FROM nodes n JOIN paths USING (conv_id, turn) LEFT JOIN counted USING (conv_id, turn)""")
def op3_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    """Links, reply order and a digest of the own text of every message of the quoting mails."""
    found = quotations.link_conversations(quoting_mails(spark, folder))
    return found.select(F.col("conv").alias("conv_id"), "turn", "reply_to", "quote_levels", "n_quoted", "n_linked",
                        "position", "depth", F.md5(F.col("body").cast("binary")).alias("body_md5"))


@query()
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document (one in ten made periodic first): number, the longest, digests of the runs and of the cut text."""
    docs = periodic.planted(table(spark, folder, "documents"))
    found = periodic.find_runs(docs, collapsed=False)
    return found.select("doc_id", "n_runs", "start", "length", "period",
                        F.floor(1000 * F.col("length") / F.col("period")).cast("bigint").alias("exponent_milli"),
                        "runs_sha256", "collapsed_sha256")


COLLOCATION_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sized AS (SELECT lang, w, unnest(range(1, least(len(w), 5) + 1)) AS m FROM worded WHERE len(w) > 0),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM sized),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
inside AS (
  SELECT DISTINCT c.lang, c.phrase FROM counted c JOIN (
    SELECT lang, m, f, string_split(phrase, ' ') AS w FROM counted WHERE m > 2) x ON x.lang = c.lang AND x.m > c.m AND 100 * x.f >= 100 * c.f
  WHERE c.m > 1 AND len(list_filter(range(1, x.m - c.m + 2), lambda i: array_to_string(x.w[i:i + c.m - 1], ' ') = c.phrase)) > 0),
cuts AS (
  SELECT lang, m, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM counted, range(1, 5) AS r(k) WHERE m > 1 AND k < m),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest
  JOIN totals t ON t.lang = c.lang),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest ANTI JOIN inside USING (lang, phrase) QUALIFY rank <= 2000"""


@query(COLLOCATION_SQL)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 strongest phrases of each language."""
    found = collocations.ranked(collocations.mine(table(spark, folder, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query()
def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, folder, "pages"))
