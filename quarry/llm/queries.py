"""Registered queries of the subpackage: one for each operator, with its production parameters."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bpe, chat, embed_dup, filter_audit, fingerprints, licenses, mixing, near_dup, pii, quality, search, sharding,
                        suffix_dedup)
from quarry.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The vocabulary file of the encoding queries, in the folder of public_tokenizers.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return bpe.load_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, *vocabulary())


@query
def op2_setsketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query
def op3_systematic_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mixture(docs, keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"), "copies")


ORACLES["op3_systematic_mixture"] = r"""
WITH sized AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
  FROM sources),
tried AS (  -- a level for each set of sources that stop at their cap
  SELECT t.level FROM (
    SELECT a.source_size * 2.0 / a.weight AS reach,
      (1.5::DOUBLE * (SELECT sum(source_size) FROM weighted)
        - coalesce(sum(CASE WHEN b.source_size * 2.0 / b.weight < a.source_size * 2.0 / a.weight THEN b.source_size * 2.0 END), 0.0))
      / sum(CASE WHEN b.source_size * 2.0 / b.weight >= a.source_size * 2.0 / a.weight THEN b.weight END) AS level
    FROM weighted a, weighted b GROUP BY a.source, a.source_size, a.weight) t
  WHERE t.level <= t.reach),
aims AS (
  SELECT source, source_size, least(source_size * 2.0, coalesce((SELECT max(level) FROM tried), 'inf'::DOUBLE) * weight)::DOUBLE AS target
  FROM weighted),
placed AS (
  SELECT s.doc_id, s.size, a.source_size, a.target,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) - 1 AS place,
    CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0 END AS expected,
    ('0x' || substr(md5(concat_ws('|', coalesce(s.source, ''), '7')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
taken AS (
  SELECT *, least(floor(start + (place + 1) * expected) - floor(start + place * expected), ceil(expected))::BIGINT AS copies FROM placed)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM taken
"""


@query
def op9_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored.select("doc_id", "held_out", "score", "predicted")


#: Key of the pseudonyms in the registered queries; a production job passes its own secret.
PSEUDONYM_KEY = "quarry-registered-query"


@query
def op7_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


@query
def op10_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


@query
def op8_pq_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dup.near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op8_pq_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.low, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(l.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id
"""


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50)


def _document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: source and language are the directories."""
    return docs.select("doc_id", F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")),
                                             F.col("doc_id").cast("string")).alias("path"), "text")


@query
def op4_tfidf_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licences(_document_paths(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "path", "licence", "origin", "score", "licence_dir",
                        F.concat_ws(",", "licences").alias("licences"))


def _licence_sql() -> str:
    phrases = ", ".join(f"('{name}', {k}, '{w}', {n}::DOUBLE)" for name, k, w, n in (
        (name, k, w, n) for k, (name, p) in enumerate((name, p) for name, ps in licenses.PHRASES.items() for p in ps)
        for w, n in Counter(licenses.words_of(p)).items()))
    return rf"""
WITH files AS (
  SELECT doc_id, concat_ws('/', coalesce(source, '_'), coalesce(lang, '_'), doc_id::VARCHAR) AS path, coalesce(text, '') AS text
  FROM documents),
phrase(name, number, word, n) AS (VALUES {phrases}),
total AS (SELECT count(*)::DOUBLE AS files FROM files),
has AS (
  SELECT word, count(*) AS files FROM (
    SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{licenses.WORD}'))) AS word FROM files)
  WHERE word IN (SELECT word FROM phrase) GROUP BY word),
idf AS (
  SELECT DISTINCT p.word, ln((1 + t.files) / (1 + coalesce(h.files, 0))) + 1 AS idf
  FROM phrase p CROSS JOIN total t LEFT JOIN has h ON h.word = p.word),
unit AS (
  SELECT name, number, word, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY number)) AS value
  FROM phrase JOIN idf USING (word)),
lines AS (
  SELECT path, line FROM (
    SELECT path, unnest(list_distinct(string_split_regex(text, '{licenses.LINE_END}'))) AS line FROM files)
  WHERE regexp_matches(lower(line), 'licen|permission|redistribution|creative|gnu|apache|mit|cc')),
counts AS (
  SELECT path, line, word, count(*) AS n FROM (
    SELECT path, line, unnest(regexp_extract_all(lower(line), '{licenses.WORD}')) AS word FROM lines)
  GROUP BY ALL),
weighed AS (
  SELECT c.path, c.line, c.word, c.n, c.n * coalesce(i.idf, ln(1 + t.files) + 1) AS x
  FROM counts c CROSS JOIN total t LEFT JOIN idf i ON i.word = c.word),
sizes AS (SELECT path, line, sqrt(sum(x * x)) AS size, sum(n) AS line_words FROM weighed GROUP BY ALL),
scores AS (
  SELECT w.path, w.line, u.name, u.number, s.line_words, round(sum(w.x * u.value) / s.size, 6) AS score, count(*) AS shared
  FROM weighed w JOIN unit u ON u.word = w.word JOIN sizes s ON s.path = w.path AND s.line = w.line
  GROUP BY w.path, w.line, u.name, u.number, s.line_words, s.size),
best AS (
  SELECT path, line, name, score, line_words FROM scores WHERE score >= {licenses.THRESHOLD} AND shared >= {licenses.SHARED_WORDS}
  QUALIFY row_number() OVER (PARTITION BY path, line ORDER BY score DESC, name) = 1),
own AS (
  SELECT b.path, first(b.name ORDER BY b.score DESC, b.name) AS licence, max(b.score) AS score,
    list_sort(list_distinct(list(b.name))) AS licences,
    sum(b.line_words) >= {licenses.LICENCE_PART} * any_value(len(regexp_extract_all(lower(f.text), '{licenses.WORD}'))) AS mostly
  FROM best b JOIN files f ON f.path = b.path GROUP BY b.path),
holders AS (
  SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, first(licence ORDER BY score DESC, licence) AS from_dir
  FROM own WHERE mostly GROUP BY 1),
placed AS (
  SELECT doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(path, '^(.*)/[^/]*/[^/]*$', 1) AS up
  FROM files)
SELECT p.doc_id, p.path, coalesce(o.licence, h.from_dir, u.from_dir) AS licence,
  CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN coalesce(h.from_dir, u.from_dir) IS NOT NULL THEN 'inherited' END AS origin,
  o.score AS score, CASE WHEN o.licence IS NULL THEN coalesce(h.dir, u.dir) END AS licence_dir,
  coalesce(array_to_string(o.licences, ','), '') AS licences
FROM placed p LEFT JOIN own o ON o.path = p.path LEFT JOIN holders h ON h.dir = p.dir LEFT JOIN holders u ON u.dir = p.up
"""


ORACLES["op4_tfidf_licences"] = _licence_sql()


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
flags AS (
  SELECT t.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
  FROM texts t LEFT JOIN marks m ON m.doc_id = t.doc_id),
letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, s::INTEGER AS step, filter_order[s] AS f, filter_order[1:s - 1] AS before FROM orders, range(1, 6) AS r(s)),
patterns AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY ALL),
counted AS (
  SELECT p.part, s.filter_order, s.step, s.f, p.n, p.good, p.toxic, contains(p.failed, s.f) AS fails,
    translate(p.failed, s.before, '') <> p.failed AS gone, p.failed = s.f AS alone
  FROM patterns p, steps s),
audited AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counted GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM audited
"""


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


ORACLES["op12_ranked_search"] = r"""
WITH split AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM split GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM size),
norm AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM size, total),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, docs),
asked AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT a.item_id, t.doc_id, sum(a.repeats * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * n.m)))::BIGINT AS score
  FROM asked a JOIN tf t USING (term) JOIN weight w USING (term) JOIN norm n ON n.doc_id = t.doc_id GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


#: A conversation that says the template's own control strings, added to the given ones.
CONTROL_CONVERSATION = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@query
def op13_prefix_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.read_back(*chat.prefix_trees(given.unionByName(added)))


ORACLES["op13_prefix_tree_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
marked AS (  -- a turn: "### ", role, ": ", text, "</turn>" and a line end; a backslash before each control string
  SELECT *, length(role) + len(regexp_extract_all(role, '[\\:]')) + 14 + length(text) + len(regexp_extract_all(text, '\\|</turn>'))
    + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS chars
  FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
