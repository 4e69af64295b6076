"""One query per operator, over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from gristmill.llm import best_fit, byte_bpe, chat_tools, cross_align, decontaminate, line_dedup, ngram_join, quality_qda, secret_scan, shard_shuffle, spelling, suffix_dedup, topk_search
from gristmill.llm.common import pick
from gristmill.llm.settings import SHARDS, THRESHOLD, table, tokenizer, vocabulary
from gristmill.scratch import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXPECTED: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            EXPECTED[name] = sql
        return function

    return register


@query("op1_shard")
def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows are exchanged; the digests are taken where they arrive."""
    dealt = shard_shuffle.shuffle_into_shards(table(spark, sf_dir, "documents"), SHARDS)
    raw = F.coalesce("text", F.lit("")).cast("binary")
    return dealt.select(
        "doc_id", (F.length(raw).cast("long") + 1).alias("size"), F.crc32(raw).alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialize(quality_qda.measure(table(spark, sf_dir, "documents")), "quality-statistics")
    learned = measured.where(~quality_qda.held_out(F.col("doc_id")))
    model = quality_qda.fit(learned, table(spark, sf_dir, "labels"), "quality")
    scored = measured.select("doc_id", quality_qda.held_out(F.col("doc_id")).alias("held_out"), model.column(F.col("statistics")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), *tokenizer())


#: A user's turn is a call, the assistant's next turn its result.  What the turns do not hold is derived from the least number n
#: of characters of a turn: n % 4 = 0 (in turns with turn % 8 < 4) lets a call depend on the user's next one, else that one depends
#: on it; multiples of 5 give the turn as text, of 7 leave out a parameter, of 11 add one, of 13 name a tool without
#: schema, of 17 depend on a call that does not exist.
OP5_SQL = """
WITH asked AS (
  SELECT conv_id, turn, text, 'call_' || conv_id || '_' || turn AS call_id,
    min(coalesce(length(text), 1)) OVER (PARTITION BY conv_id, turn) AS n FROM conversations WHERE role = 'user'),
turns AS (SELECT conv_id, turn, any_value(n) AS n FROM asked GROUP BY ALL),
directed AS (
  SELECT t.conv_id, t.turn, t.n % 4 = 0 AND t.turn % 8 < 4 AND later.turn IS NOT NULL AS waits
  FROM turns t LEFT JOIN turns later ON later.conv_id = t.conv_id AND later.turn = t.turn + 2),
placed AS (
  SELECT d.conv_id, d.turn, d.waits, coalesce(NOT b.waits, false) AS follows,
    min(CASE WHEN NOT d.waits THEN d.turn END) OVER (PARTITION BY d.conv_id, d.turn % 2 ORDER BY d.turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS place
  FROM directed d LEFT JOIN directed b ON b.conv_id = d.conv_id AND b.turn = d.turn - 2),
calls AS (
  SELECT a.conv_id, a.turn, a.call_id, p.place, CASE WHEN n % 13 = 0 THEN 'search' ELSE 'answer' END AS name, n % 17 = 0 AS lost,
    '{' || concat_ws(',', CASE WHEN n % 7 <> 0 THEN '"characters":' || length(text) END, CASE WHEN n % 11 = 0 THEN '"extra":true' END,
      CASE WHEN text IS NOT NULL THEN '"text":' || to_json(text) END, '"turn":' || CASE WHEN n % 5 = 0 THEN '"' || a.turn || '"' ELSE a.turn::VARCHAR END) || '}' AS arguments,
    concat_ws('; ', CASE WHEN n % 7 = 0 OR text IS NULL THEN 'missing characters' END, CASE WHEN text IS NULL THEN 'missing text' END,
      CASE WHEN n % 5 = 0 THEN 'type of turn' END, CASE WHEN n % 11 = 0 THEN 'unexpected extra' END) AS wrong,
    to_json(list_sort(list_filter([
      CASE WHEN p.follows THEN 'call_' || a.conv_id || '_' || (a.turn - 2) END, CASE WHEN p.waits THEN 'call_' || a.conv_id || '_' || (a.turn + 2) END,
      CASE WHEN n % 17 = 0 THEN 'call_' || a.conv_id || '_none' END], lambda x: x IS NOT NULL))) AS depends_on,
    row_number() OVER (PARTITION BY a.conv_id, a.turn ORDER BY to_json(text)) AS number
  FROM (SELECT DISTINCT * FROM asked) a JOIN placed p ON p.conv_id = a.conv_id AND p.turn = a.turn),
results AS (
  SELECT DISTINCT conv_id, turn, 'call_' || conv_id || '_' || (turn - 1) AS call_id, text,
    dense_rank() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) AS number FROM conversations WHERE role = 'assistant'),
linked AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.place, r.turn) AS order_position,
    coalesce((c.place - c.turn) // 2, 0) AS order_level,
    CASE WHEN c.call_id IS NULL THEN 'no_call' WHEN lost THEN 'unknown_dependency' WHEN name = 'search' THEN 'unknown_tool' WHEN wrong <> '' THEN 'invalid'
      WHEN r.call_id IS NULL THEN 'no_result' ELSE 'ok' END AS status,
    CASE WHEN name = 'answer' THEN wrong ELSE '' END AS errors,
    '{' || concat_ws(',', '"arguments":' || arguments, '"depends_on":' || depends_on, '"id":"' || coalesce(c.call_id, r.call_id) || '"',
      '"name":"' || name || '"', CASE WHEN r.text IS NOT NULL THEN '"result":' || to_json(r.text) END) || '}' AS message
  FROM (SELECT * FROM calls WHERE number = 1) c FULL JOIN (SELECT * FROM results WHERE number = 1) r ON c.conv_id = r.conv_id AND c.call_id = r.call_id)
SELECT conv_id, call_id, order_position, CAST(order_level AS BIGINT) AS order_level, status, errors, message FROM linked
UNION ALL
SELECT conv_id, call_id, turn, 0, 'repeated', '', '{"arguments":' || arguments || ',"depends_on":' || depends_on || ',"id":"' || call_id || '","name":"' || name || '"}'
FROM calls WHERE number > 1
UNION ALL
SELECT conv_id, call_id, turn, 0, 'repeated', '', '{"id":"' || call_id || '","result":' || to_json(text) || '}' FROM results WHERE number > 1
UNION ALL
SELECT conv_id, NULL, turn, 0, 'message', '', '{"content":' || to_json(text) || ',"role":"' || role || '"}'
FROM conversations WHERE role NOT IN ('user', 'assistant')
"""


@query("op5_chat_tools", OP5_SQL)
def op5_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    name = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    asked = turns.where("role = 'user'")
    known = materialize(asked.groupBy("conv_id", "turn").agg(F.min(F.coalesce(F.length("text"), F.lit(1))).alias("n")), "chat-turns")
    later = known.select("conv_id", (F.col("turn") - 2).alias("turn"), F.lit(True).alias("has_later"))
    waits = (F.col("n") % 4 == 0) & (F.col("turn") % 8 < 4) & F.col("has_later").isNotNull()
    known = known.join(later, ["conv_id", "turn"], "left").select("conv_id", "turn", "n", waits.alias("waits"))
    before = known.select("conv_id", (F.col("turn") + 2).alias("turn"), (~F.col("waits")).alias("follows"))
    known = known.join(before, ["conv_id", "turn"], "left")
    depends_on = F.array(
        F.when(F.col("follows"), name(F.col("turn") - 2)), F.when(F.col("waits"), name(F.col("turn") + 2)), F.when(F.col("n") % 17 == 0, name(F.lit("none")))
    )

    def arguments(turn):
        given = F.when(F.col("n") % 7 != 0, F.length("text")).alias("characters"), F.when(F.col("n") % 11 == 0, True).alias("extra")
        return F.to_json(F.struct(turn.alias("turn"), "text", *given))

    calls = asked.join(known, ["conv_id", "turn"]).select(
        "conv_id", name(F.col("turn")).alias("call_id"), F.col("turn").alias("position"),
        F.when(F.col("n") % 13 == 0, "search").otherwise("answer").alias("name"),
        F.when(F.col("n") % 5 == 0, arguments(F.col("turn").cast("string"))).otherwise(arguments(F.col("turn"))).alias("arguments"),
        depends_on.alias("depends_on"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )
    schemas = spark.createDataFrame(
        [("answer", "turn", "integer", True), ("answer", "text", "string", True), ("answer", "characters", "integer", True)],
        "name string, parameter string, type string, required boolean",
    )
    linked = chat_tools.link_calls(calls, results, schemas)
    rest = turns.where("role IS NULL OR role NOT IN ('user', 'assistant')").select("conv_id", F.col("turn").alias("position"), "role", F.col("text").alias("content"))
    return linked.unionByName(chat_tools.plain_messages(rest)).withColumn("errors", F.concat_ws("; ", "errors"))


@query("op7_topk")
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


@query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM benchmark),
items AS (SELECT item_id, words, len(words) AS n, least(len(words), 5) AS k FROM b WHERE len(words) > 0),
item_shingles AS (
  SELECT item_id, n, k, array_to_string(words[i:i + k - 1], ' ') AS s, count(*) AS in_item
  FROM (SELECT *, unnest(range(1, n - k + 2)) AS i FROM items) GROUP BY ALL),
doc_shingles AS (
  SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS s, len(words) AS length
  FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM items))),
hits AS (SELECT d.doc_id, d.length, d.i, t.item_id, t.n, t.k, d.s FROM doc_shingles d JOIN item_shingles t USING (k, s)),
starts AS (
  SELECT DISTINCT doc_id, item_id, n, k, unnest(range(greatest(1, i + k - n), least(i, length - n + 1) + 1)) AS start FROM hits),
counted AS (
  SELECT p.doc_id, p.item_id, p.n, p.k, p.start, h.s, count(*) AS in_window
  FROM starts p JOIN hits h ON h.doc_id = p.doc_id AND h.item_id = p.item_id AND h.i BETWEEN p.start AND p.start + p.n - p.k GROUP BY ALL),
shared AS (
  SELECT doc_id, item_id, n, k, start, sum(least(in_window, in_item)) AS shared
  FROM counted c JOIN item_shingles t USING (item_id, n, k, s) GROUP BY ALL)
SELECT doc_id, item_id, CAST(arg_max(start, (shared / (2 * (n - k + 1) - shared), -start)) - 1 AS INTEGER) AS start_word, any_value(n) AS n_words,
  CAST(max(shared) AS BIGINT) AS shared, CAST(min(2 * (n - k + 1) - shared) AS BIGINT) AS total
FROM shared WHERE 4 * shared >= 3 * (2 * (n - k + 1) - shared) GROUP BY doc_id, item_id
"""


@query("op9_decontaminate", OP9_SQL)
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start_word", "n_words", "shared", "total")


@query("op2_ngram_jaccard")
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("row", "root")


@query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    plain, kept, n_gone = line_dedup.without_repeated_lines(docs)
    lines = F.when(F.col("__1").isNull(), 0).otherwise(F.size(F.split("__1", "\n"))).cast("long")
    return plain.select(
        F.col("__0").alias("doc_id"), lines.alias("n_lines"), n_gone.alias("n_removed"),
        F.sha2(F.coalesce(kept, F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


@query("op11_spelling")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op12_cross_align")
def op12_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_align.linked(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = materialize(best_fit.pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")), "pieces")
    return best_fit.packed(cut).drop("number")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
