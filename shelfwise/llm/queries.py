"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm.block_search import exact_top_k
from shelfwise.llm.bpe import decoded, encode_texts, ids_text
from shelfwise.llm.collocations import collocations
from shelfwise.llm.exact_dedup import exact_groups
from shelfwise.llm.lang_id import fit, held_out, identify
from shelfwise.llm.memory import text_batches
from shelfwise.llm.ngram_join import jaccard_components
from shelfwise.llm.packing import pack_documents
from shelfwise.llm.pii import with_surrogates
from shelfwise.llm.secrets import find_secrets, with_counts
from shelfwise.llm.settings import SURROGATE_KEY, bpe_file
from shelfwise.llm.sharding import shard_documents
from shelfwise.llm.substring_dedup import without_repeats
from shelfwise.llm.warc import round_trip
from shelfwise.llm.whitening import by_component, whiten
from shelfwise.session import materialize


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


QUERIES: dict[str, Query] = {}


def _register(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = Query(run, sql)
        return run

    return add


LOWER_TEXT = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"


@_register("op10_exact_dedup", f"""
    WITH d AS (SELECT doc_id, {LOWER_TEXT} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           coalesce(doc_id = max(doc_id) OVER w, true) AS kept, sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)
""")
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


@_register("op3_ngram_jaccard_join", f"""
    WITH RECURSIVE
    w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER_TEXT}, '{WORD}') AS ws FROM documents),
    s AS MATERIALIZED (
        SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM w WHERE len(ws) > 0)),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS MATERIALIZED (
        SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
                          GROUP BY ALL) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
        WHERE 100 * c >= 80 * (p.n + q.n - c)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = w.doc_id) AS component_id
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id
""")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


@_register("op2_substring_dedup", f"""
    WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
    windows AS (
        SELECT doc_id, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM w WHERE len(ws) >= 35)),
    repeats AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS i FROM repeats),
    words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w WHERE len(ws) > 0),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, len(ws) - coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
""")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"), digest=True)


@_register("op5_bpe_encoding")
def bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text by forced-boundary splitting, and the text decoded from them again."""
    ids = encode_texts(table(spark, folder, "documents").select("doc_id", "text"), bpe_file())
    digests = ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids_text("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded("ids", bpe_file()).cast("binary"), 256).alias("decoded_sha256"),
    )
    with text_batches(spark):  # written here, as small batches hold only while a step runs
        return materialize(digests, "digests")


@_register("op7_nnls_packing")
def nnls_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 1024 tokens."""
    return pack_documents(table(spark, folder, "documents"), bpe_file())


@_register("op8_vector_sharding")
def vector_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes, tokens and rows."""
    return shard_documents(table(spark, folder, "documents"))


@_register("op1_warc_dictionary", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    f AS (SELECT *, strlen(html) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS first FROM p),
    r AS (SELECT *, CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f)
    SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
    FROM r
""")
def warc_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to dictionary-compressed archives and read back."""
    return round_trip(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_register("op9_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents, learned from four fifths of them."""
    docs = table(spark, folder, "documents")
    model = fit(docs.filter(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_register("op4_pii_surrogates")
def pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with surrogates for the personal data in them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_surrogates(docs, SURROGATE_KEY).select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


@_register("op6_block_top_k", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
               WHERE vec_id IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""")
def block_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector with all the others."""
    return exact_top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@_register("op11_qd_whitening")
def qd_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first eight whitened components of every vector."""
    return by_component(whiten(table(spark, folder, "embeddings")))


@_register("op12_secret_grammar")
def secret_grammar(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents, by patterns and by automata learned from what these find."""
    return with_counts(find_secrets(table(spark, folder, "documents")))


@_register("op13_phrase_collocations", f"""
    WITH RECURSIVE
    w AS MATERIALIZED (
        SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
        FROM (SELECT lang, unnest(string_split_regex({LOWER_TEXT}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
    g AS MATERIALIZED (
        SELECT lang, k::INTEGER AS k, array_to_string(ws[i:i + k - 1], ' ') AS p, count(*) AS a
        FROM (SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM w, generate_series(1, 4) t(k) WHERE len(ws) >= k)
        GROUP BY ALL HAVING count(*) >= 30),
    c AS MATERIALIZED (SELECT lang, k, p AS phrase, a, string_split(p, ' ') AS ws FROM g WHERE k > 1),
    cuts AS (SELECT c.*, j, array_to_string(ws[:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp
             FROM c, generate_series(1, 3) t(j) WHERE j < k),
    scored AS (
        SELECT cuts.lang, phrase, cuts.a, x.a AS l, y.a AS r, ((2000000::HUGEINT * cuts.a) // (x.a + y.a))::BIGINT AS score, j
        FROM cuts JOIN g x ON x.lang = cuts.lang AND x.p = lp JOIN g y ON y.lang = cuts.lang AND y.p = rp),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inner_ AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS most
               FROM (SELECT c.*, m, unnest(generate_series(1, k - m + 1)) AS i FROM c, generate_series(2, 3) t(m) WHERE m < k) GROUP BY ALL),
    kept AS (SELECT s.* FROM lowest s LEFT JOIN inner_ i USING (lang, phrase) WHERE i.most IS NULL OR 100 * i.most < 80 * s.a)
    SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang)
    WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000
""")
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations(table(spark, folder, "documents"))


QUERIES["pipeline"] = Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
