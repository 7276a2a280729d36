"""Registered queries of the training-data operators, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import chat, decontaminate, extract, fingerprints, jaccard, lm, manifest, mixing, passages, quality, tokens, toxicity, whitening

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_token_counts")
def op1_token_counts(spark, folder):
    """Tokens of every document by the public byte-level BPE."""
    return tokens.count_tokens(table(spark, folder, "documents"))


@query("op2_html_extraction")
def op2_html_extraction(spark, folder):
    """Main text of every page by the recurrent block labeller."""
    return extract.extract_text(table(spark, folder, "pages"))


_OP3_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
                + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


@query("op3_chat_formatting", _OP3_SQL)
def op3_chat_formatting(spark, folder):
    """Every conversation as a chain of replies, formatted and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], turns.schema)
    done = chat.format_trees(chat.chained(turns.unionByName(extra)))
    turns_back, learned = F.col("turns"), F.array_join(F.col("learned"), "")
    done = done.withColumn("turns", chat.read_back(F.col("formatted")))
    done = done.withColumn("learned", chat.masked_texts(F.col("formatted"), F.col("loss_mask")))
    said = F.array_join(F.transform(turns_back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    conversation = F.nullif(F.split_part("root", F.lit(":"), F.lit(1)), F.lit("")).cast(turns.schema["conv_id"].dataType)
    return done.select(
        conversation.alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_OP4_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, chr(9))]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p : p + 3], chr(9)))) END AS set
    FROM d),
t AS (SELECT doc_id, hash(unnest(set)) AS token FROM s),
shared AS (SELECT token FROM t GROUP BY 1 HAVING count(*) > 1),
u AS (SELECT doc_id, token FROM t SEMI JOIN shared USING (token)),
alive AS (SELECT doc_id, n FROM (SELECT doc_id, len(set) AS n FROM s) JOIN (SELECT doc_id, count(*) AS m FROM u GROUP BY 1) USING (doc_id) WHERE 100 * m >= 85 * n),
v AS (SELECT u.*, n FROM u JOIN alive USING (doc_id)),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM v a JOIN v b ON a.token = b.token AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
class AS (SELECT doc_id, hash(list_sort(set)) AS c FROM s),
linked AS (
    SELECT x, count(DISTINCT b.c) AS n FROM pairs JOIN class a ON a.doc_id = x JOIN class b ON b.doc_id = y WHERE a.c <> b.c GROUP BY x)
SELECT s.doc_id, CAST(len(set) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(y), s.doc_id)) AS component_id,
       CAST(coalesce(max(n), 0) AS BIGINT) AS n_links
FROM s LEFT JOIN reach ON s.doc_id = reach.x LEFT JOIN linked ON s.doc_id = linked.x GROUP BY s.doc_id, set"""


@query("op4_ngram_jaccard_join", _OP4_SQL)
def op4_ngram_jaccard_join(spark, folder):
    """Groups of documents whose four-word shingle sets have a similarity of 0.85 or more."""
    return jaccard.jaccard_join(table(spark, folder, "documents"), k=4, num=85, den=100)


@query("op5_source_mixing")
def op5_source_mixing(spark, folder):
    """Documents mixed so that the sources, weighing 3, 1, 2 in turn, share 150 % of all words."""
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@query("op6_quality_classifier")
def op6_quality_classifier(spark, folder):
    """Quality of every document from its own text, its source and the source's languages."""
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_toxicity")
def op7_toxicity(spark, folder):
    """Toxicity of every document by subword-bag embeddings, learnt outside the held-out fold."""
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


_OP8_SQL = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
i AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
iw AS (
    SELECT item_id, least(10, len(w)) AS size, array_to_string(list_slice(w, p, p + least(10, len(w)) - 1), ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
    SELECT r, size, p, array_to_string(list_slice(w, p, p + size - 1), ' ') AS gram
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT DISTINCT r, p, dw.size, item_id FROM dw JOIN iw USING (size, gram)),
cover AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS q FROM (SELECT DISTINCT r, p, size FROM hits)) GROUP BY 1),
items AS (
    SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN items USING (r)"""


@query("op8_benchmark_decontamination", _OP8_SQL)
def op8_benchmark_decontamination(spark, folder):
    """Words of every document inside a ten-word window of a benchmark item."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query("op9_substring_dedup")
def op9_substring_dedup(spark, folder):
    """Passages of fifty or more words that two documents share, exactly or nearly."""
    return passages.repeated_passages(table(spark, folder, "documents"))


@query("op10_merkle_fingerprints")
def op10_merkle_fingerprints(spark, folder):
    """Merkle fingerprints of every document and of its edited text."""
    return fingerprints.compare_with_next(table(spark, folder, "documents"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, folder):
    """Whitened coordinates of every vector along the four leading components of the distinct vectors."""
    return whitening.whiten(table(spark, folder, "embeddings"))


_FRAME = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = " || ".join(_FRAME.format(name) for name in ("doc_id", "source", "lang", "{n_chars}", "text"))


def _nodes_sql(name: str, lowest: str) -> str:
    """All nodes of trees: ``tree``, ``lev``, ``place``, ``node`` and the number ``n`` of nodes of the level."""
    return f"""{name} AS (
    {lowest}
    UNION ALL
    SELECT tree, lev + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), max((n + 1) // 2)
    FROM {name} WHERE n > 1 GROUP BY tree, lev, place // 2)"""


def _climb_sql(name: str, start: str, nodes: str) -> str:
    """Every row's way up: the digest so far and the siblings met."""
    return f"""{name} AS (
    {start}
    UNION ALL
    SELECT c.r, c.tree, c.lev + 1, c.place // 2,
           sha256(CASE WHEN s.node IS NULL THEN c.folded WHEN c.place % 2 = 1 THEN s.node || c.folded ELSE c.folded || s.node END),
           c.siblings || coalesce(s.node, '')
    FROM {name} c JOIN {nodes} o ON o.tree = c.tree AND o.lev = c.lev AND o.place = c.place AND o.n > 1
    LEFT JOIN {nodes} s ON s.tree = c.tree AND s.lev = c.lev AND s.place = xor(c.place, 1))"""


# The checksum's table has 256 entries, made from its polynomial (a fixed value).
_OP12_SQL = f"""
WITH RECURSIVE crc AS (
    SELECT i, CAST(i AS BIGINT) AS c, 0 AS s FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, s + 1 FROM crc WHERE s < 8),
tab AS (SELECT i, c FROM crc WHERE s = 8),
numbered AS (SELECT row_number() OVER () AS r, *, CAST(doc_id AS VARCHAR) AS digits FROM documents),
sums AS (
    SELECT r, digits, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM numbered WHERE digits IS NOT NULL
    UNION ALL
    SELECT r, digits, k + 1, xor(tab.c, sums.c >> 8)
    FROM sums JOIN tab ON tab.i = xor(sums.c, CAST(ascii(substr(digits, k + 1, 1)) AS BIGINT)) & 255 WHERE k < length(digits)),
hits AS (SELECT r FROM sums WHERE k = length(digits) AND xor(c, 4294967295) % 7 = 0),
d AS (SELECT *, r IN (SELECT r FROM hits) AS hit FROM numbered),
leaf AS (
    SELECT r, doc_id, lang, sha256({_LEAF.format(n_chars="n_chars")}) AS leaf,
           sha256({_LEAF.format(n_chars="(n_chars + CASE WHEN hit THEN 1 ELSE 0 END)")}) AS altered FROM d),
langs AS (SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM leaf)),
placed AS (
    SELECT r, doc_id, leaf, altered, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY tree) AS n
    FROM leaf JOIN langs ON leaf.lang IS NOT DISTINCT FROM langs.lang),
{_nodes_sql("nodes", "SELECT tree, 0 AS lev, place, leaf AS node, n FROM placed")},
subroots AS (SELECT tree, node FROM nodes WHERE n = 1),
{_nodes_sql("tops", "SELECT 0 AS tree, 0 AS lev, tree AS place, node, (SELECT count(*) FROM subroots) AS n FROM subroots")},
{_climb_sql("climb", "SELECT r, tree, 0 AS lev, place, altered AS folded, '' AS siblings FROM placed", "nodes")},
arrived AS (SELECT c.* FROM climb c JOIN nodes o ON o.tree = c.tree AND o.lev = c.lev AND o.place = c.place AND o.n = 1),
{_climb_sql("rise", "SELECT r, 0 AS tree, 0 AS lev, tree AS place, folded, siblings FROM arrived", "tops")},
done AS (SELECT c.r, folded, siblings, o.node AS root FROM rise c JOIN tops o ON o.lev = c.lev AND o.place = c.place AND o.n = 1)
SELECT doc_id, leaf, s.node AS subroot, root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed JOIN done USING (r) JOIN subroots s ON s.tree = placed.tree"""


@query("op12_merkle_manifest", _OP12_SQL)
def op12_merkle_manifest(spark, folder):
    """Leaf, roots and proof of every document, and the root that the document leads to once some counts are raised by one."""
    documents = table(spark, folder, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % manifest.TAMPER == 0
    found = manifest.manifest(documents, altered={"n_chars": F.when(hit, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))})
    others = F.filter("siblings", lambda s: s.isNotNull())
    proof = F.sha2(F.array_join(F.transform(others, lambda s: s["node"]), ""), 256)
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


@query("op13_lm_scores")
def op13_lm_scores(spark, folder):
    """Log probability of every document by bigrams of the documents outside the held-out tenth."""
    training = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    return lm.score_texts(table(spark, folder, "documents"), training)
