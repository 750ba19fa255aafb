"""One query per operator over the whole of its table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import alignment, chat_windows, decontaminate, jaccard_join, language, line_dedup, packing, phrase_automata, quality, suffix_dedup, token_blocks, top_k, vector_codes
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WORD_BPE = "public:word_bpe_49k.json"
BYTE_BPE = "public:byte_bpe_50k.json"
PIECE_BPE = "public:piece_bpe_32k.model"


def _query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@_query("op1_token_blocks")
def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, read back from the written blocks."""
    files = token_blocks.write_token_files(table(spark, sf_dir, "documents"), WORD_BPE, "dropped", end_id=1)
    return token_blocks.token_digests(spark, files)


@_query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    return packing.pack(packing.cut_pieces(table(spark, sf_dir, "documents"), BYTE_BPE, "leading", end_id=0))


@_query(
    "op9_line_dedup",
    r"""
    WITH l AS (
      SELECT doc_id, u.line AS line, u.pos AS pos,
        lower_ascii AS key
      FROM (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
      ) u, LATERAL (SELECT translate(trim(u.line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii)
    ), f AS (
      SELECT key, min(doc_id) AS first_doc FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
    ), m AS (
      SELECT l.*, f.first_doc IS NOT NULL AND l.doc_id <> f.first_doc AS gone FROM l LEFT JOIN f USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document without the lines that an earlier document holds."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup.line_digests(docs, line_dedup.keep_bitmaps(docs))


@_query("op5_chat_windows")
def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its written windows."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = turns.unionByName(chat_windows.probe_conversation(spark))
    return chat_windows.conversation_digests(chat_windows.write_windows(chat_windows.windows(rows, BYTE_BPE, "leading")))


@_query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query(
    "op8_exact_top_k",
    """
    WITH v AS (
      SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
      WHERE embedding IS NOT NULL
        AND coalesce(list_bool_and([x IS NOT NULL AND isfinite(x) for x in embedding]), true)
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
        list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    ), r AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best others of every 50th vector."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query("op7_decontaminate")
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage in every document, with its place and similarity."""
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op10_phrase_automata")
def op10_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document without the words that earlier documents hold in passages."""
    return phrase_automata.repeated_words(table(spark, sf_dir, "documents"))


@_query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document without the 400-byte strings that occur elsewhere."""
    return suffix_dedup.byte_digests(table(spark, sf_dir, "documents"))


@_query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of two tokenizers' tokens of every document, and how common its links are."""
    return alignment.document_figures(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


@_query("op12_quality")
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds as one query: an assignment and an update for each round, then the last assignment."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (
          SELECT rn, part, first(x) AS x, min(dist * {entries} + entry) % {entries} AS entry, min(dist) AS dist FROM (
            SELECT p.rn, p.part, p.x, c.entry, list_sum(list_transform(list_zip(p.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
            FROM p JOIN c{r} c ON c.part = p.part) GROUP BY rn, part)""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} AS MATERIALIZED (
          SELECT c.part, c.entry, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
            SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
              SELECT part, entry, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{r}, range(1, len(x) + 1) t(i) GROUP BY part, entry, i)
            GROUP BY part, entry) m ON m.part = c.part AND m.entry = c.entry)""")
    return f"""
    WITH k AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND coalesce(list_bool_and([x IS NOT NULL AND isfinite(x) for x in embedding]), true)
    ), n AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id, v) AS rn FROM k
    ), p AS MATERIALIZED (
      SELECT rn, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) AS x FROM n, range({parts}) t(part)
    ), c0 AS MATERIALIZED (SELECT part, rn - 1 AS entry, x AS c FROM p WHERE rn <= {entries}), {",".join(steps)},
    e AS (SELECT rn, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a{rounds} GROUP BY rn),
    h AS (SELECT sha256(string_agg(c[i]::VARCHAR, ',' ORDER BY part, entry, i)) AS digest FROM c{rounds}, range(1, len(c) + 1) t(i))
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
    FROM n JOIN e USING (rn), h
    """


@_query("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product code of every vector, its error, and the errors of its label."""
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))
