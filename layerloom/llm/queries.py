"""Queries that apply each operator to its whole table, next to SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm import (
    block_names,
    contamination,
    languages,
    lexical_search,
    line_chunks,
    packing,
    simhash,
    substrings,
    token_counts,
    tool_calls,
    toxicity,
    vector_codes,
    vector_search,
)
from layerloom.llm.scratch import ROW, numbered_scan


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contained_items(
        load(spark, folder, "documents"), load(spark, folder, "benchmark")
    )


#: The tools that the turns of a conversation are read as calls of.
TOOLS = [
    (
        "measure",
        '{"properties": {"of": {"type": "object"}, "words": {"type": "integer", "minimum": 1, "maximum": 60}, '
        '"unit": {"type": "string", "enum": ["word", "line"]}}, "required": ["of", "words"], '
        '"additionalProperties": false}',
    ),
    ("answer", '{"properties": {"text": {"type": "string"}}, "required": ["text", "turn"]}'),
]


def transcripts(conversations: DataFrame) -> DataFrame:
    """Conversations as tool transcripts: every turn of the table becomes a call or a result.

    A user's turn asks for two calls, the first of which uses the second; an assistant's turn is the result of
    the second call of the turn before; a system turn calls a tool that has no schema.
    """
    call_id = lambda turn, which: F.concat_ws("-", F.lit("call"), turn.cast("string"), F.lit(which))
    turn, text = F.col("turn"), F.coalesce(F.col("text"), F.lit(""))
    measure = F.to_json(
        F.struct(
            F.size(F.split(text, r"\s+")).alias("words"),
            F.when(turn % 4 == 0, F.lit("line")).otherwise(F.lit("letter")).alias("unit"),
            F.struct(call_id(turn, "b").alias("$ref")).alias("of"),
        )
    )
    answer = F.to_json(F.struct(turn.alias("turn"), text.alias("text")))
    one = lambda which, name, arguments: F.concat(
        F.lit('{"id": "'), call_id(turn, which), F.lit(f'", "name": "{name}", "arguments": '), arguments, F.lit("}")
    )
    calls = F.concat(
        F.lit('{"tool_calls": ['), one("a", "measure", measure), F.lit(", "), one("b", "answer", answer), F.lit("]}")
    )
    configure = F.concat(F.lit('{"tool_calls": ['), one("s", "configure", answer), F.lit("]}"))
    result = F.to_json(F.struct(call_id(turn - 1, "b").alias("tool_call_id"), text.alias("content")))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", "tool").otherwise("assistant").alias("role"),
        F.when(F.col("role") == "user", calls)
        .when(F.col("role") == "assistant", result)
        .otherwise(configure)
        .alias("text"),
    )


def op2_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    schemas = spark.createDataFrame(TOOLS, "name string, schema string")
    return tool_calls.link_calls(transcripts(load(spark, folder, "conversations")), schemas)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    filters = languages.train(docs, taught=~held_out)
    found = languages.identify(docs, filters)
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    docs = numbered_scan(load(spark, folder, "documents"))
    found = line_chunks.drop_repeated_chunks(docs, row_column=ROW)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocab = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(load(spark, folder, "documents"), vocab)


def op6_substrings(spark: SparkSession, folder: str) -> DataFrame:
    docs = numbered_scan(load(spark, folder, "documents"))
    found = substrings.drop_shared_strings(docs, row_column=ROW)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    vocab = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(load(spark, folder, "documents"), vocab)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, folder, "documents"))


def op9_block_names(spark: SparkSession, folder: str) -> DataFrame:
    found = block_names.duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.train(docs, load(spark, folder, "labels"), taught=~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(numbered_scan(load(spark, folder, "embeddings")), row_column=ROW)[0]


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def op13_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = numbered_scan(load(spark, folder, "embeddings"))
    return vector_search.search(vectors, F.col("vec_id") % 50 == 0, row_column=ROW)


QUERIES = {
    "op1_contamination": op1_contamination,
    "op2_tool_calls": op2_tool_calls,
    "op3_language": op3_language,
    "op4_line_chunks": op4_line_chunks,
    "op5_token_counts": op5_token_counts,
    "op6_substrings": op6_substrings,
    "op7_packing": op7_packing,
    "op8_simhash": op8_simhash,
    "op9_block_names": op9_block_names,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_lexical_search": op12_lexical_search,
    "op13_vector_search": op13_vector_search,
}

#: Vectors of ``embeddings`` that take part, as whole numbers in doubles.
USABLE_VECTORS = """
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""


def codebook_sql() -> str:
    """Four rounds of assignment and means over each of four parts; a distance and its entry are one number."""
    steps = [
        f"v AS MATERIALIZED ({USABLE_VECTORS.format(scale=1024)})",
        """p AS MATERIALIZED (
            SELECT vec_id, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS x FROM v, range(4) t(part)
        )""",
        """b0 AS MATERIALIZED (
            SELECT part, entry, x AS y FROM p JOIN (
                SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT 256
            ) USING (vec_id)
        )""",
    ]
    for i in range(5):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT vec_id, part, any_value(x) AS x, CAST(min(
                (list_dot_product(x, x) - 2 * list_dot_product(x, y) + list_dot_product(y, y)) * 256 + entry) AS BIGINT) AS best
            FROM p JOIN b{i} USING (part) GROUP BY vec_id, part
        )""")
        steps.append(f"""b{i + 1} AS MATERIALIZED (
            WITH m AS (
                SELECT part, entry, i, floor(sum(c) / count(*)) AS c
                FROM (SELECT part, best % 256 AS entry, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a{i})
                GROUP BY part, entry, i
            ), n AS (SELECT part, entry, list(c ORDER BY i) AS y FROM m GROUP BY part, entry)
            SELECT part, entry, coalesce(n.y, b.y) AS y FROM b{i} b LEFT JOIN n USING (part, entry)
        )""")
    return f"""
        WITH {", ".join(steps[:-1])},
        c AS (
            SELECT vec_id, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code,
                   CAST(sum(best // 256) AS BIGINT) AS error
            FROM a4 GROUP BY vec_id
        ), h AS (
            SELECT sha256(string_agg(array_to_string(list_transform(y, lambda z: CAST(z AS BIGINT)), ','), ',' ORDER BY part, entry))
                   AS codebooks_sha256
            FROM b4
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM c JOIN v USING (vec_id), h
    """

ORACLE_SQL = {
    "op1_contamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
        ), i AS (
            SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
        ), ish AS (
            SELECT DISTINCT item_id, least(len(w), 5) AS width, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS s
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p FROM i WHERE len(w) > 0)
        ), n AS (SELECT item_id, count(*) AS n FROM ish GROUP BY item_id),
        widths AS (SELECT DISTINCT width FROM ish),
        dsh AS (
            SELECT DISTINCT doc_id, array_to_string(w[p:p + width - 1], ' ') AS s
            FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS p FROM d, widths WHERE len(w) >= width)
        )
        SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_shingles, CAST(count(*) AS INTEGER) AS n_found,
               count(*) / n AS containment
        FROM dsh JOIN ish USING (s) JOIN n USING (item_id)
        GROUP BY doc_id, item_id, n HAVING count(*) >= n * 0.8
    """,
    "op2_tool_calls": r"""
        WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations),
        r AS (
            SELECT conv_id, turn - 1 AS asked, turn AS result_turn, t AS result FROM c WHERE role = 'assistant'
        ), calls AS (
            SELECT conv_id, turn, 1 AS level, 0 AS place, 'call-' || turn || '-a' AS call_id, 'measure' AS name,
                   '{"of":{"$ref":"call-' || turn || '-b"},"unit":"' || CASE WHEN turn % 4 = 0 THEN 'line' ELSE 'letter' END
                   || '","words":' || len(regexp_split_to_array(t, '\s+')) || '}' AS arguments,
                   concat_ws(',', CASE WHEN turn % 4 <> 0 THEN 'enum:unit' END,
                             CASE WHEN len(regexp_split_to_array(t, '\s+')) > 60 THEN 'range:words' END) AS errors
            FROM c WHERE role = 'user'
            UNION ALL
            SELECT conv_id, turn, 0, CASE role WHEN 'user' THEN 1 ELSE 0 END,
                   'call-' || turn || CASE role WHEN 'user' THEN '-b' ELSE '-s' END,
                   CASE role WHEN 'user' THEN 'answer' ELSE 'configure' END,
                   '{"text":' || CAST(to_json(t) AS VARCHAR) || ',"turn":' || turn || '}',
                   CASE role WHEN 'user' THEN '' ELSE 'unknown_tool' END
            FROM c WHERE role <> 'assistant'
        )
        SELECT calls.conv_id, calls.turn, level, place, call_id, name, arguments, errors,
               CAST(1 AS BIGINT) AS n_calls_of_id, CAST(CASE WHEN r.asked IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_results,
               result_turn, result
        FROM calls LEFT JOIN r
          ON calls.conv_id = r.conv_id AND calls.turn = r.asked AND call_id = 'call-' || r.asked || '-b'
        UNION ALL
        SELECT r.conv_id, NULL, NULL, NULL, 'call-' || asked || '-b', NULL, NULL, NULL, 0, 1, result_turn, result
        FROM r LEFT JOIN c ON c.conv_id = r.conv_id AND c.turn = asked AND c.role = 'user' WHERE c.turn IS NULL
    """,
    "op4_line_chunks": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
            FROM documents
        ), h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM l),
        o AS (
            SELECT *, (h + 31 * coalesce(lag(h) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0)) % 1000003 AS r,
                   count(*) OVER (PARTITION BY doc_id) AS n_lines
            FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)
        ), e AS (
            SELECT *, i = n_lines OR i BETWEEN 2 AND n_lines - 2
                   AND r < lag(r) OVER (PARTITION BY doc_id ORDER BY i)
                   AND r < lead(r) OVER (PARTITION BY doc_id ORDER BY i) AS ends
            FROM o
        ), n AS (
            SELECT *, coalesce(sum(CAST(ends AS INTEGER)) OVER (
                PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
            FROM e
        ), c AS (
            SELECT doc_id, place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk
            FROM n GROUP BY doc_id, place
        ), r AS (
            SELECT doc_id, place, n > 1 AND regexp_matches(chunk, '[^\x20\x09-\x0D]')
                   AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, place) > 1 AS gone
            FROM c
        )
        SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines,
               CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM n JOIN r USING (doc_id, place) GROUP BY doc_id
    """,
    "op9_block_names": r"""
        WITH d AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
            FROM documents
        ), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    "op11_vector_codes": codebook_sql(),
    "op12_lexical_search": r"""
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), v AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
        d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM v GROUP BY doc_id),
        c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
        m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM d, c),
        w AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM v, c GROUP BY term
        ), i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), s AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM i JOIN v USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
        ), r AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                   doc_id, score
            FROM s WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
    """,
    "op13_vector_search": f"""
        WITH v AS MATERIALIZED ({USABLE_VECTORS.format(scale=256)}),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
