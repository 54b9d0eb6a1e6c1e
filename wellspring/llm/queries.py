"""One query per operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontaminate, langid, lengths, merkle, minhash, mixing, negatives, pieces, quality, topk, warc
from .common import crc_fold, stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_minhash(spark, sf_dir):
    """Near-duplicate components on 3-word shingles at a similarity of 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 3, 85, 100)


ORACLES["op1_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least_of AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, d.doc_id) AS component_id,
  coalesce(low, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON a = d.doc_id
"""


@query
def op2_warc(spark, sf_dir):
    """Pages written to WARC archives and read back. A broken record is an error."""
    read = warc.archived(spark, table(spark, sf_dir, "pages"), revisit_from=0)
    read = read.withColumn("record_type", F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(F.raise_error("problem")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op2_warc"] = """
WITH pages_in AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS first FROM pages_in GROUP BY hex)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM pages_in JOIN firsts USING (hex)
"""


def not_crc(folds: int, held: int):
    """Rows whose fold is not the held-out one."""
    return crc_fold(F.col("doc_id"), folds) != held


@query
def op3_language_id(spark, sf_dir):
    """Language of every document by the byte network."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, not_crc(3, 1))
    return found.select("doc_id", (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op5_exact_topk(spark, sf_dir):
    """The 5 highest integer inner products of every 50th vector."""
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows.where("vec_id % 50 = 0"), rows, 5)


ORACLES["op5_exact_topk"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op9_permutation_index(spark, sf_dir):
    """The 5 nearest found of every 50th vector by cosine."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows.where("vec_id % 50 = 0"), rows, 5)


@query
def op10_quality(spark, sf_dir):
    """Quality of every document by kernel ridge regression."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality.quality(docs, labels, not_crc(5, 0))
    held = crc_fold(F.col("doc_id"), 5) == 0
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_sentencepiece(spark, sf_dir):
    """Two distinct sampled segmentations of every document, and their decoded texts."""
    found = pieces.sample(table(spark, sf_dir, "documents"), k=2)
    return found.select(
        "doc_id", "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "log_inclusion",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_chat_format(spark, sf_dir):
    """All conversations formatted in budgeted windows and read back."""
    columns = ["conv_id", "turn", "role", "text"]
    rows = table(spark, sf_dir, "conversations").select(*columns)
    said = r"\### Assistant: </turn> ok"
    rows = rows.union(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema))
    read = chat.read_back(chat.windows(rows))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select("conv_id", "window", turns.alias("turns"), F.size("turns").alias("n"), "loss", "chars")
    in_order = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("window", c))), lambda x: x[c]), "")
    found = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), in_order("turns").alias("turns"), in_order("loss").alias("loss"), F.sum("chars").alias("formatted_chars")
    )
    return found.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLES["op6_chat_format"] = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    '### ' || replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\t'), ':', '\c') || ': '
    || replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\t') || '</turn>' || chr(10) AS line
  FROM given),
counted AS (
  SELECT *, pos = 1 AND role = 'system' AS sys, len(regexp_extract_all(line, '[A-Za-z]+|[^A-Za-z\x20\x09-\x0D]')) AS tokens
  FROM lines),
placed AS (
  SELECT *, coalesce(sum(CASE WHEN sys THEN 0 ELSE tokens END) OVER (
      PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    coalesce(max(CASE WHEN sys THEN tokens END) OVER (PARTITION BY conv_id), 0) AS sys_tokens,
    coalesce(max(CASE WHEN sys THEN length(line) END) OVER (PARTITION BY conv_id), 0) AS sys_chars
  FROM counted),
spans AS (SELECT *, greatest(768 - sys_tokens, 1) AS size, start // greatest(768 - sys_tokens, 1) AS span FROM placed),
windows AS (
  SELECT conv_id, span, min(start) AS first, sum(CASE WHEN sys THEN 0 ELSE tokens END) AS tokens, sum(length(line)) AS chars,
    any_value(sys_chars) AS sys_chars, any_value(sys_tokens) AS sys_tokens, any_value(size) AS size
  FROM spans GROUP BY conv_id, span),
again AS (
  SELECT w.conv_id, w.span, sum(length(s.line)) AS chars
  FROM windows w JOIN spans s ON s.conv_id = w.conv_id AND s.span = w.span - 1 AND NOT s.sys
    AND w.first - s.start <= least(least(256, w.size), 1024 - w.sys_tokens - w.tokens)
  GROUP BY w.conv_id, w.span),
sizes AS (
  SELECT conv_id, sum(w.chars + coalesce(a.chars, 0) + CASE WHEN span > 0 THEN sys_chars ELSE 0 END) AS chars
  FROM windows w LEFT JOIN again a USING (conv_id, span) GROUP BY conv_id),
texts AS (
  SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '') AS loss
  FROM lines GROUP BY conv_id)
SELECT conv_id, n AS n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  chars::BIGINT AS formatted_chars
FROM texts JOIN sizes USING (conv_id)
"""


@query
def op7_mixing(spark, sf_dir):
    """Document rates at which good, low and toxic tokens reach their target weights."""
    labels = table(spark, sf_dir, "labels")
    domain = F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
    rows, names = mixing.mixed(
        table(spark, sf_dir, "documents"), labels.select("doc_id", domain.alias("domain")), {"good": 0.85, "low": 0.08, "toxic": 0.07}
    )
    p = (F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(names))
    return rows.select("doc_id", "tokens", *p, "rate", mixing.copies(F.col("rate"), F.col("doc_id")).alias("copies"))


@query
def op8_token_counts(spark, sf_dir):
    """Token totals of all documents for every context limit."""
    return lengths.limits(stored(lengths.histogram(table(spark, sf_dir, "documents")), "lengths"))


@query
def op11_merkle(spark, sf_dir):
    """Merkle manifest of the documents, a tree per language, and proofs checked
    against documents of which every seventh is changed."""
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    chars = F.col("n_chars").cast("decimal(20,0)")  # beyond 64 bits no error
    found = merkle.manifest(
        docs, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"n_chars": F.when(changed, chars + 1).otherwise(chars)}
    )
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLES["op11_merkle"] = """
WITH RECURSIVE given AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS id, coalesce(strlen(source) || ':' || source, '-') AS src,
    coalesce(strlen(lang) || ':' || lang, '-') AS lng, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
    coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-') AS more,
    coalesce(strlen(text) || ':' || text, '-') AS txt, coalesce('1' || lang, '0') AS tree
  FROM documents),
{crc},
hashed AS (
  SELECT doc_id, tree, sha256(id || src || lng || chars || txt) AS leaf,
    sha256(id || src || lng || CASE WHEN crc % 7 = 0 THEN more ELSE chars END || txt) AS other
  FROM given LEFT JOIN crcs USING (doc_id)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed),
nodes(tree, level, place, n, node) AS (
  SELECT tree, 0, place, n, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 2, (n + 1) // 2, h FROM (
    SELECT tree, level, place, n, sha256(node || coalesce(lead(node) OVER (PARTITION BY tree, level ORDER BY place), '')) AS h
    FROM nodes WHERE n > 1)
  WHERE place % 2 = 0),
subroots AS (
  SELECT tree, node AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops(level, place, n, node) AS (
  SELECT 0, place, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, (n + 1) // 2, h FROM (
    SELECT level, place, n, sha256(node || coalesce(lead(node) OVER (PARTITION BY level ORDER BY place), '')) AS h FROM tops WHERE n > 1)
  WHERE place % 2 = 0),
every AS (
  SELECT tree, level, place, n, node FROM nodes WHERE n > 1
  UNION ALL SELECT '', level, place, n, node FROM tops WHERE n > 1),
steps AS (
  SELECT l.doc_id, l.leaf, e.level AS step, l.place // (1::BIGINT << e.level) AS spot, b.node AS beside
  FROM leaves l JOIN every e ON e.tree = l.tree AND e.place = l.place // (1::BIGINT << e.level)
  LEFT JOIN every b ON b.tree = e.tree AND b.level = e.level AND b.place = xor(e.place, 1)
  UNION ALL
  SELECT l.doc_id, l.leaf, s.height + e.level, s.place // (1::BIGINT << e.level), b.node
  FROM leaves l JOIN subroots s USING (tree) JOIN every e ON e.tree = '' AND e.place = s.place // (1::BIGINT << e.level)
  LEFT JOIN every b ON b.tree = '' AND b.level = e.level AND b.place = xor(e.place, 1)),
folds(doc_id, leaf, step, node) AS (
  SELECT doc_id, leaf, 0, other FROM leaves
  UNION ALL
  SELECT f.doc_id, f.leaf, f.step + 1, sha256(CASE WHEN beside IS NULL THEN node WHEN spot % 2 = 1 THEN beside || node ELSE node || beside END)
  FROM folds f JOIN steps s ON s.doc_id = f.doc_id AND s.leaf = f.leaf AND s.step = f.step),
folded AS (SELECT doc_id, leaf, arg_max(node, step) AS folded_root FROM folds GROUP BY doc_id, leaf),
proofs AS (SELECT doc_id, leaf, string_agg(beside, '' ORDER BY step) AS proof FROM steps GROUP BY doc_id, leaf)
SELECT l.doc_id, l.leaf, subroot, node AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = node AS verified
FROM leaves l JOIN subroots USING (tree) CROSS JOIN (SELECT node FROM tops WHERE n = 1)
JOIN folded f ON f.doc_id = l.doc_id AND f.leaf = l.leaf LEFT JOIN proofs p ON p.doc_id = l.doc_id AND p.leaf = l.leaf
""".replace(
    "{crc}",
    """crc_bits(doc_id, rest, crc, bit) AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR, 4294967295::BIGINT, 8 FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, CASE WHEN bit = 8 THEN substr(rest, 2) ELSE rest END,
    CASE WHEN bit = 8 THEN xor(crc, ascii(rest)) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END,
    CASE WHEN bit = 8 THEN 0 ELSE bit + 1 END
  FROM crc_bits WHERE bit < 8 OR rest <> ''),
crcs AS (SELECT doc_id, xor(crc, 4294967295) AS crc FROM crc_bits WHERE bit = 8 AND rest = '')""",
)


@query
def op13_decontaminate(spark, sf_dir):
    """Benchmark passages of 10 words in every document."""
    found = decontaminate.benchmark_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op13_decontaminate"] = r"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
asked AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM asked WHERE len(w) > 0)),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n),
hits AS (
  SELECT doc_id, i, p.n, item_id FROM places JOIN phrases p ON p.n = places.n AND p.phrase = array_to_string(w[i:i + places.n - 1], ' ')),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hits), range(10) r(k) WHERE k < n GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every 50th vector, among vectors with some labels changed."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


ORACLES["op12_hard_negatives"] = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 3
"""
