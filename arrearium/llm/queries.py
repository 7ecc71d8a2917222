"""The operators as queries over whole tables, and their DuckDB statements where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearium.llm import (chat, decontaminate, language, near_dup, negatives, packing, phrases, quality, secret_scan, sharding, topk,
                           url_filter, vector_dup)
from arrearium.llm.common import ROW, held_out, table

SEQUENCE_TOKENS = 1024
SHARDS = 8
URL_RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, mixed by source as in the corpus."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), sequence_tokens=SEQUENCE_TOKENS, with_ids=False)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.rules_of(URL_RULES)).drop("url")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS, payload=["doc_id"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).drop(ROW)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(ROW)


def op5_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the three rarest words of a benchmark item stand within ten words of each other."""
    return decontaminate.item_proximity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; three quarters of the labelled ones are learned from."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out("doc_id")))
    named = docs.select("doc_id", held_out("doc_id").alias("held_out"), language.identify(docs, model).alias("l"))
    return named.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), "l.score", "l.ambiguous")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, owners being the sources."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "owned")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in secret_scan.KINDS], F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
                        secret_scan.joined(F.col("spans")).alias("spans"))


def op7_secret_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each secret: its verdict, and in how many sources and documents of the corpus the string stands."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.explode("spans").alias("s")).select(
        "doc_id", *[f"s.{c}" for c in ("kind", "start", "end", "verdict", "owners", "repositories")])


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    two = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(
        "assistant").alias("role"), F.lit(text).alias("text"))
    return _formatted(chat.format_conversations(rows.unionByName(two)))


def op8_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation told as a log of deltas, edits, regenerations and deletions, folded, formatted and read back."""
    log = chat.as_log(table(spark, sf_dir, "conversations"))
    return _formatted(chat.read_back(chat.render(chat.fold(log))))


def _formatted(done: DataFrame) -> DataFrame:
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return done.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op9_vector_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked vectors within each label."""
    return vector_dup.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; three quarters of the labels are learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score_quality(docs, labels, lambda doc_id: ~held_out(doc_id))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).drop(ROW)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the label of every seventh is shifted by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_url_filter, op3_sharding, op4_minhash, op5_decontamination, op5_proximity, op6_language_id, op7_secret_scan, op7_secret_verdicts,
    op8_chat_format, op8_event_log, op9_vector_dup, op10_quality, op11_phrases, op12_topk, op13_hard_negatives)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"


def _spans(kind: str, rank: int, pattern: str, keep: str = "true") -> str:
    """Start and end of all matches: the pieces between them and their own lengths add up to the positions."""
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, source, '{kind}' AS kind, {rank} AS r, m,
      sum(length(piece)) OVER w + coalesce(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
    FROM (SELECT doc_id, source, unnest(f) AS m, unnest(string_split_regex(text, '{p}')[1:len(f)]) AS piece, unnest(range(len(f))) AS i
          FROM (SELECT *, regexp_extract_all(text, '{p}') AS f FROM d) WHERE len(f) > 0)
    WINDOW w AS (PARTITION BY doc_id ORDER BY i) QUALIFY {keep}"""


_ASSIGN_SQL = secret_scan._ASSIGN

ORACLES = {
    "op5_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::varchar AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, w[i + 1:i + 10] AS g FROM (SELECT *, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
spots AS (SELECT doc_id, n, i, w[i + 1:i + n] AS g FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM spots JOIN win USING (g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY ALL),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY ALL)
SELECT d.doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op7_secret_scan": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
base AS ({_spans("assign", 0, _ASSIGN_SQL)} UNION ALL {_spans("access", 1, secret_scan._ACCESS)} UNION ALL {_spans("hex", 2, secret_scan._HEX)}),
kept AS (SELECT * FROM base WHERE kind <> 'assign' OR length(regexp_extract(m, '{_ASSIGN_SQL.replace("'", "''")}', 2)) >= 12),
more AS ({_spans("owned", 3, secret_scan._CANDIDATE)}),
free AS (SELECT * FROM more WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')
  AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.doc_id = more.doc_id AND k.s < more.s + length(more.m) AND more.s < k.s + length(k.m))),
both_ AS (SELECT * FROM kept UNION ALL SELECT * FROM free),
own AS (SELECT m, count(DISTINCT source) AS o, count(DISTINCT doc_id) AS r FROM both_ GROUP BY m),
fin AS (SELECT b.*, kind || ':' || s::bigint || ':' || (s + length(b.m))::bigint AS x FROM both_ b JOIN own USING (m)
  WHERE kind <> 'owned' OR o = 1),
agg AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h,
  string_agg(x, ',' ORDER BY s, r) FILTER (kind <> 'owned') AS bs, string_agg(x, ',' ORDER BY s, r) AS al FROM fin GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::bigint AS n_assign, coalesce(c, 0)::bigint AS n_access, coalesce(h, 0)::bigint AS n_hex,
  sha256(coalesce(bs, '')) AS base_sha256, coalesce(al, '') AS spans FROM d LEFT JOIN agg USING (doc_id)""",
    "op8_chat_format": r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '(<\|/?|<</?|</?|\[/?)(\\*)((?:im_start|im_end|endoftext)\|>|SYS>>|s>|INST\])', '\1\\\2\3', 'g') AS safe FROM c)
SELECT conv_id, count(*)::bigint AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>' || role || chr(10) || safe || '<|im_end|>' || chr(10)))::bigint AS formatted_chars
FROM e GROUP BY conv_id""",
    "op9_vector_dup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::double[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::bigint AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id""",
}

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_WHOLE = "list_transform(embedding, lambda x: floor(256 * x::double))"

# The log folds back to the conversations.
ORACLES["op8_event_log"] = ORACLES["op8_chat_format"].replace(
    "UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'", "")

ORACLES["op11_phrases"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::bigint AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM c),
sc AS (SELECT cut.lang, cut.phrase, a, k, l.f AS l, r.f AS r, (2000000::hugeint * a // (l.f + r.f))::bigint AS score FROM cut
  JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sub AS (SELECT lang, a, s, unnest(list_transform(range(1, m - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
  FROM c, (SELECT unnest([2, 3]) AS s) WHERE s < m),
cover AS (SELECT lang, phrase, max(a) AS longest FROM sub GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM low LEFT JOIN cover USING (lang, phrase) JOIN n USING (lang) WHERE longest IS NULL OR 100 * longest < 80 * a QUALIFY rank <= 2000"""

ORACLES["op12_topk"] = f"""
WITH v AS (SELECT vec_id, {_WHOLE} AS e FROM embeddings WHERE {_FINITE}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::int AS rank, vec_id, score FROM s QUALIFY rank <= 5"""

ORACLES["op13_hard_negatives"] = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS e FROM embeddings
  WHERE label IS NOT NULL AND {_FINITE}),
s AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_dot_product(q.e, c.e)::bigint AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
m AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::int AS rank,
  negative_id, positive_score, negative_score FROM m QUALIFY rank <= 5"""

ORACLES["op5_proximity"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
pos AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
b AS (SELECT DISTINCT item_id::varchar AS item_id, unnest({_WORDS}) AS word FROM benchmark),
f AS (SELECT word, count(*) AS f FROM pos GROUP BY word),
r AS (SELECT item_id, word, row_number() OVER (PARTITION BY item_id ORDER BY coalesce(f, 0), word) AS k FROM b LEFT JOIN f USING (word)),
t AS (SELECT item_id, max(word) FILTER (k = 1) AS a, max(word) FILTER (k = 2) AS b, max(word) FILTER (k = 3) AS c FROM r GROUP BY item_id HAVING count(*) >= 3),
s AS (SELECT item_id, x.doc_id, x.p AS place, least(x.p, y.p, z.p) AS s, greatest(x.p, y.p, z.p) AS e
  FROM t JOIN pos x ON x.word = t.a JOIN pos y ON y.word = t.b AND y.doc_id = x.doc_id AND abs(y.p - x.p) < 10
  JOIN pos z ON z.word = t.c AND z.doc_id = x.doc_id AND abs(z.p - x.p) < 10 AND abs(z.p - y.p) < 10)
SELECT item_id, doc_id, place::int AS place, s::int AS "start", e::int AS "end" FROM s
QUALIFY row_number() OVER (PARTITION BY item_id, doc_id, place ORDER BY e - s, s) = 1"""

# The same spans and counts as in the statement above it; owners alone decide.
ORACLES["op7_secret_verdicts"] = ORACLES["op7_secret_scan"].split("fin AS (")[0].rstrip().rstrip(",") + """
SELECT doc_id, kind, s::bigint AS "start", (s + length(b.m))::bigint AS "end", CASE WHEN o = 1 THEN 'live' ELSE 'example' END AS verdict,
  o::bigint AS owners, own.r::bigint AS repositories
FROM both_ b JOIN own USING (m) WHERE kind <> 'owned' OR o = 1"""
