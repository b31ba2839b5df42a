"""Queries of the core by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import generate
from loomline.functions.text import FENCE_LANGUAGES, corrected, token_count
from loomline.operators import formats, monitor, nested, pages, quality, validate, vectors
from loomline.operators.deliveries import latest
from loomline.operators.ranks import percentiles
from loomline.sources.tables import documents, samples, table
from loomline.streaming.monitor import streamed_throughput

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Nested records.

_ONCE = "once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ingested_at DESC) AS k FROM syncfusion_tool_calling_dataset) WHERE k = 1)"
_ARGS = f"""{_ONCE}, c AS (SELECT sample_id, unnest(tool_calls) AS c, generate_subscripts(tool_calls, 1) - 1 AS pos FROM once),
    a0 AS (SELECT sample_id, pos, c.function.arguments AS j FROM c WHERE json_valid(c.function.arguments)),
    a AS (SELECT sample_id, pos, CASE WHEN json_type(j) = 'VARCHAR' AND json_valid(j::JSON ->> '$') THEN (j::JSON ->> '$')::JSON ELSE j::JSON END AS j FROM a0)"""
_PLAIN = """replace(regexp_replace(regexp_replace(n.fullkey, '^\\$\\.?', ''), '\\[(\\d+)\\]', '.\\1', 'g'), '"', '')"""
_TOOLS = f"""{_ONCE}, t AS (SELECT sample_id, unnest(tools) AS t, generate_subscripts(tools, 1) - 1 AS pos FROM once),
    s0 AS (SELECT sample_id, pos, t::JSON AS j FROM t WHERE json_valid(t)),
    s AS (SELECT sample_id, pos, coalesce(j -> '$.function.parameters', j -> '$.parameters', j -> '$.input_schema') AS j FROM s0),
    p AS (SELECT sample_id, pos, n.type AS json_kind, n.value AS v, replace(n.fullkey, '"', '') AS f FROM s, json_tree(s.j) n WHERE s.j IS NOT NULL AND regexp_matches(replace(n.fullkey, '"', ''), '^\\$(\\.(items\\.)?properties\\.[^.]+)+$'))"""
_NAME = "regexp_replace(regexp_replace(f, '\\.(items\\.)?properties\\.', '.', 'g'), '^\\$\\.', '')"


@_query(
    f"""WITH {_ARGS}, {_TOOLS.removeprefix(_ONCE + ", ")}
    SELECT sample_id, 'tool_calls' AS holder, pos::INT AS pos, {_PLAIN} AS leaf_path FROM a, json_tree(a.j) n WHERE n.type NOT IN ('OBJECT', 'ARRAY')
    UNION ALL SELECT sample_id, 'tools', pos::INT, {_NAME} FROM p"""
)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.leaf_paths(samples(spark, d))


@_query(
    f"""WITH {_ONCE} SELECT sample_id, pos::INT AS pos, c.id AS call_id, c.type AS call_type, c.function.name AS name, coalesce(json_valid(c.function.arguments), false) AS arguments_readable
    FROM (SELECT sample_id, unnest(tool_calls) AS c, generate_subscripts(tool_calls, 1) - 1 AS pos FROM once)"""
)
def p4_calls(spark: SparkSession, d: str) -> DataFrame:
    return nested.call_table(samples(spark, d))


_NODES = """replace(regexp_replace(regexp_replace(n.{c}, '^\\$\\.?', ''), '\\[(\\d+)\\]', '.\\1', 'g'), '"', '')"""


@_query(
    f"""WITH {_ARGS}, n AS (SELECT a.sample_id, a.pos, n.key, n.type AS kind, n.atom, ltrim({_NODES.format(c="fullkey")}, '.') AS path, ltrim({_NODES.format(c="path")}, '.') AS up, n.fullkey FROM a, json_tree(a.j) n)
    SELECT sample_id, pos::INT AS pos, path, CASE WHEN fullkey <> '$' THEN up END AS parent_path, CASE WHEN fullkey NOT LIKE '%]' AND fullkey <> '$' THEN key END AS key_name,
    CASE WHEN fullkey LIKE '%]' THEN key::INT END AS array_index, CASE kind WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'scalar' END AS kind,
    CASE WHEN kind NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN atom ->> '$' END AS value FROM n"""
)
def p4_arguments(spark: SparkSession, d: str) -> DataFrame:
    return nested.argument_table(samples(spark, d))


@_query(
    f"""WITH {_TOOLS}, named AS (SELECT sample_id, pos, {_NAME} AS path, v ->> '$.type' AS type FROM p)
    SELECT sample_id, pos::INT AS pos, path, regexp_replace(path, '\\.?[^.]+$', '') AS parent_path, regexp_extract(path, '[^.]+$') AS name, type FROM named"""
)
def p4_parameters(spark: SparkSession, d: str) -> DataFrame:
    return nested.parameter_table(samples(spark, d))


# Layouts of conversations.


def _conversations(spark: SparkSession, d: str) -> DataFrame:
    """Each conversation once; deliveries of an id are alike, the greatest turns and component count."""
    rows = table(spark, d, "generated_conversations").select("id", "conversations", F.try_element_at("metadata", F.lit("component")).alias("component"))
    return rows.groupBy("id").agg(F.max("conversations").alias("conversations"), F.max("component").alias("component"))


_CONV = """conv AS (SELECT id, list_filter(coalesce(max(conversations), []), lambda x: x.sender IS NOT NULL AND x.value IS NOT NULL) AS t FROM generated_conversations GROUP BY id)"""
_ROLE = "CASE lower(trim({x})) WHEN 'user' THEN '{u}' WHEN 'human' THEN '{u}' WHEN 'assistant' THEN '{a}' WHEN 'gpt' THEN '{a}' ELSE lower(trim({x})) END"
_OPENAI_ROLE = _ROLE.format(x="x.sender", u="user", a="assistant")


@_query(f"WITH {_CONV} SELECT id, to_json(list_transform(t, lambda x: {{'role': {_OPENAI_ROLE}, 'content': x.value}}))::VARCHAR AS messages FROM conv")
def openai_messages(spark: SparkSession, d: str) -> DataFrame:
    return formats.openai(_conversations(spark, d)).select("id", F.to_json("messages").alias("messages"))


@_query(f"WITH {_CONV} SELECT id, to_json(list_transform(t, lambda x: {{'from': {_ROLE.format(x='x.sender', u='human', a='gpt')}, 'value': x.value}}))::VARCHAR AS conversations FROM conv")
def sharegpt_conversations(spark: SparkSession, d: str) -> DataFrame:
    return formats.sharegpt(_conversations(spark, d)).select("id", F.to_json("conversations").alias("conversations"))


_FLAT = f"flat AS (SELECT id, unnest(t) AS x, generate_subscripts(t, 1) - 1 AS turn FROM conv), turns AS (SELECT id, turn, {_OPENAI_ROLE} AS role, x.value AS value FROM flat)"


@_query(
    f"""WITH {_CONV}, {_FLAT}, nexts AS (SELECT *, lead(role) OVER w AS next_role, lead(value) OVER w AS output FROM turns WINDOW w AS (PARTITION BY id ORDER BY turn))
    SELECT id, turn::INT AS turn, value AS instruction, '' AS input, output FROM nexts WHERE role = 'user' AND next_role = 'assistant'"""
)
def alpaca_pairs(spark: SparkSession, d: str) -> DataFrame:
    return formats.alpaca(_conversations(spark, d))


@_query(f"WITH {_CONV} SELECT id, coalesce(array_to_string(list_transform(t, lambda x: {_OPENAI_ROLE} || ': ' || x.value), chr(10)), '') AS transcript FROM conv")
def transcripts(spark: SparkSession, d: str) -> DataFrame:
    return formats.transcript(_conversations(spark, d))


@_query(
    f"""WITH {_CONV}, {_FLAT}, lagged AS (SELECT *, lag(role) OVER (PARTITION BY id ORDER BY turn) AS before FROM turns)
    SELECT id, count(turn) AS n_turns, coalesce(sum(length(value)), 0)::BIGINT AS n_chars, count(*) FILTER (role = before) AS n_repeated_roles FROM conv LEFT JOIN lagged USING (id) GROUP BY id"""
)
def conversation_turn_stats(spark: SparkSession, d: str) -> DataFrame:
    return formats.turn_stats(_conversations(spark, d))


@_query(f"WITH {_CONV}, {_FLAT} SELECT id, turn::INT AS turn, role, value FROM turns WHERE turn < 2")
def conversation_first_turns(spark: SparkSession, d: str) -> DataFrame:
    return formats.first_turns(_conversations(spark, d), 2)


@_query(f"WITH {_CONV}, {_FLAT} SELECT id, turn::INT AS turn, role, substr(value, 1, 100) AS value_preview FROM turns")
def turn_previews(spark: SparkSession, d: str) -> DataFrame:
    return formats.turn_previews(_conversations(spark, d))


@_query("SELECT instruction, input, output FROM syncfusion_tool_calling_dataset")
def instruction_rows(spark: SparkSession, d: str) -> DataFrame:
    return formats.instruction_rows(samples(spark, d))


@_query(
    """SELECT id, to_json([{'role': 'system', 'content': 'You answer questions about ' || component || '.'}, {'role': 'user', 'content': coalesce(title, '') || chr(10) || chr(10) || content}])::VARCHAR AS messages
    FROM source_documents WHERE component IS NOT NULL AND trim(coalesce(content, '')) <> ''"""
)
def prompt_messages(spark: SparkSession, d: str) -> DataFrame:
    made = generate.prompt_messages(table(spark, d, "source_documents"))
    return made.where("messages IS NOT NULL").select("id", F.to_json("messages").alias("messages"))


@_query("SELECT key AS metadata_key, count(*) AS n_conversations FROM (SELECT id, unnest(map_keys(metadata)) AS key FROM generated_conversations) GROUP BY key")
def metadata_keys(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "generated_conversations").select("id", F.explode(F.map_keys("metadata")).alias("metadata_key"))
    return keys.groupBy("metadata_key").agg(F.count("*").alias("n_conversations"))


@_query(
    """SELECT id, 'user' AS role_1, 'How is ' || component || ' used? ' || coalesce(title, '') AS prompt, content AS answer FROM source_documents
    WHERE component IS NOT NULL AND trim(coalesce(content, '')) <> ''"""
)
def generated_from_documents(spark: SparkSession, d: str) -> DataFrame:
    made = generate.template_conversations(table(spark, d, "source_documents"))
    return made.where("conversations IS NOT NULL").select("id", F.lit("user").alias("role_1"), F.col("conversations")[0]["value"].alias("prompt"), F.col("conversations")[1]["value"].alias("answer"))


@_query(
    """SELECT count(*) AS n_documents, count(*) FILTER (component IS NOT NULL AND trim(coalesce(content, '')) <> '') AS n_generated,
    count(*) FILTER (NOT (component IS NOT NULL AND trim(coalesce(content, '')) <> '')) AS n_failed FROM source_documents"""
)
def generation_stats(spark: SparkSession, d: str) -> DataFrame:
    return generate.generation_stats(generate.template_conversations(table(spark, d, "source_documents")))


# Validation and statistics.


@_query("SELECT coalesce(c.function.name, 'unknown') AS tool_name, count(*) AS n_calls FROM (SELECT unnest(tool_calls) AS c FROM syncfusion_tool_calling_dataset) GROUP BY 1")
def tool_usage(spark: SparkSession, d: str) -> DataFrame:
    return validate.tool_usage(samples(spark, d))


@_query(
    """SELECT count(*) AS n_samples, count(*) FILTER (contains(lower(coalesce(output, '')), 'grid')) AS n_grid, count(*) FILTER (contains(lower(coalesce(output, '')), 'chart')) AS n_chart,
    count(*) FILTER (contains(lower(coalesce(output, '')), 'xlsio')) AS n_xlsio, count(*) FILTER (contains(coalesce(output, ''), 'Basic Grid Configuration')) AS n_marker FROM syncfusion_tool_calling_dataset"""
)
def component_counts(spark: SparkSession, d: str) -> DataFrame:
    return validate.component_counts(samples(spark, d))


def _json_samples(spark: SparkSession, d: str) -> DataFrame:
    """The samples as JSON objects; null fields have no key."""
    return samples(spark, d).select("sample_id", "ingested_at", F.to_json(F.struct("instruction", "input", "output", "tools", "tool_calls")).alias("json"))


_MISSING = "array_to_string(list_filter(['input', 'instruction', 'output', 'tool_calls', 'tools'], lambda f: CASE f WHEN 'input' THEN input IS NULL WHEN 'instruction' THEN instruction IS NULL WHEN 'output' THEN output IS NULL WHEN 'tools' THEN tools IS NULL ELSE tool_calls IS NULL END), ',')"


@_query(f"SELECT coalesce({_MISSING}, '') AS missing, count(*) AS n_samples FROM syncfusion_tool_calling_dataset GROUP BY 1")
def required_fields(spark: SparkSession, d: str) -> DataFrame:
    checked = validate.required_fields(_json_samples(spark, d))
    return checked.groupBy(F.array_join("missing", ",").alias("missing")).agg(F.count("*").alias("n_samples"))


@_query(f"WITH {_ONCE} SELECT count(*) FILTER (coalesce({_MISSING}, '') = '') AS n_valid, 10::BIGINT AS denominator, count(*) AS n_checked FROM (SELECT * FROM once ORDER BY sample_id LIMIT 10)")
def first_ten_validity(spark: SparkSession, d: str) -> DataFrame:
    checked = validate.required_fields(latest(_json_samples(spark, d), "sample_id", "ingested_at"))
    return validate.validity_report(checked, "sample_id")


@_query(
    """SELECT sample_id, instruction, coalesce(array_to_string(list_transform(coalesce(tool_calls, []), lambda c: c.function.name), ','), '') AS tools_called, substr(output, 1, 100) || '...' AS output_preview
    FROM syncfusion_tool_calling_dataset ORDER BY sample_id, ingested_at LIMIT 2"""
)
def sample_previews(spark: SparkSession, d: str) -> DataFrame:
    return validate.sample_previews(samples(spark, d), "sample_id")


@_query(
    """SELECT count(*) AS total_samples, count(DISTINCT source) AS sections_processed, coalesce(avg(length(coalesce(instruction, ''))), 0) AS avg_instruction_length,
    coalesce(avg(length(coalesce(output, ''))), 0) AS avg_output_length FROM syncfusion_tool_calling_dataset"""
)
def dataset_stats(spark: SparkSession, d: str) -> DataFrame:
    return validate.dataset_stats(samples(spark, d), "source")


@_query("SELECT 0::BIGINT AS total_samples, 0::BIGINT AS sections_processed, 0.0::DOUBLE AS avg_instruction_length, 0.0::DOUBLE AS avg_output_length")
def dataset_stats_empty(spark: SparkSession, d: str) -> DataFrame:
    return validate.dataset_stats(samples(spark, d).where("sample_id IS NULL AND sample_id IS NOT NULL"), "source")


@_query("SELECT doc_id, length(text) AS n_code_points, coalesce(len(regexp_extract_all(text, '\\S+')), 0)::INT AS n_tokens FROM documents")
def text_stats(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", F.length("text").alias("n_code_points"), token_count(F.col("text")).alias("n_tokens"))


@_query("SELECT lang, count(*) AS n, quantile_cont(n_chars, 0.5) AS p50, quantile_cont(n_chars, 0.95) AS p95, max(n_chars) AS longest FROM documents GROUP BY lang")
def length_percentiles(spark: SparkSession, d: str) -> DataFrame:
    own = documents(spark, d).select("lang", "n_chars")
    counted = own.groupBy("lang").agg(F.count("*").alias("n"), F.max("n_chars").alias("longest")).alias("c")
    found = percentiles(own, "n_chars", {"p50": 0.5, "p95": 0.95}, "lang").alias("p")
    return counted.join(found, F.col("c.lang").eqNullSafe(F.col("p.lang"))).select("c.lang", "n", "p50", "p95", "longest")


@_query("SELECT source, lang, count(*) AS n_documents, sum(n_chars)::BIGINT AS n_chars, (grouping(source) * 2 + grouping(lang))::BIGINT AS grouped FROM documents GROUP BY ROLLUP (source, lang)")
def source_rollup(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).rollup("source", "lang").agg(F.count("*").alias("n_documents"), F.sum("n_chars").alias("n_chars"), F.grouping_id().alias("grouped"))


# Joins with the page headers and source documents.


@_query("SELECT d.doc_id, h.product, h.version FROM documents d JOIN (SELECT page_id, max(product) AS product, max(version) AS version FROM page_headers GROUP BY page_id) h USING (page_id)")
def documents_with_headers(spark: SparkSession, d: str) -> DataFrame:
    headers = table(spark, d, "page_headers").groupBy("page_id").agg(F.max("product").alias("product"), F.max("version").alias("version"))
    return documents(spark, d).select("doc_id", "page_id").join(headers, "page_id").select("doc_id", "product", "version")


@_query("SELECT page_id FROM (SELECT DISTINCT page_id FROM page_headers WHERE page_id IS NOT NULL) h WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.page_id = h.page_id)")
def headers_without_document(spark: SparkSession, d: str) -> DataFrame:
    known = documents(spark, d).select("page_id")
    return table(spark, d, "page_headers").where("page_id IS NOT NULL").select("page_id").distinct().join(known, "page_id", "left_anti")


@_query("SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM page_headers h WHERE h.page_id = d.page_id)")
def documents_with_sidecar(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", "page_id").join(table(spark, d, "page_headers").select("page_id"), "page_id", "left_semi").select("doc_id")


@_query(
    f"""WITH {_ONCE} SELECT coalesce(s.component, 'none') AS component, count(*) AS n_samples, round(avg(s.quality_score), 6) AS mean_score
    FROM once o LEFT JOIN source_documents s ON s.id = o.source_doc_id GROUP BY 1"""
)
def samples_by_component(spark: SparkSession, d: str) -> DataFrame:
    once = latest(samples(spark, d).select("sample_id", "ingested_at", "source_doc_id"), "sample_id", "ingested_at")
    sources = table(spark, d, "source_documents").select(F.col("id").alias("source_doc_id"), "component", "quality_score")
    joined = once.join(sources, "source_doc_id", "left")
    return joined.groupBy(F.coalesce("component", F.lit("none")).alias("component")).agg(F.count("*").alias("n_samples"), F.round(F.avg("quality_score"), 6).alias("mean_score"))


@_query("SELECT id, 'samples' AS origin FROM (SELECT source_doc_id AS id FROM syncfusion_tool_calling_dataset WHERE source_doc_id IS NOT NULL) UNION ALL SELECT id, 'documents' FROM source_documents")
def references_union(spark: SparkSession, d: str) -> DataFrame:
    used = samples(spark, d).where("source_doc_id IS NOT NULL").select(F.col("source_doc_id").alias("id"), F.lit("samples").alias("origin"))
    return used.unionByName(table(spark, d, "source_documents").select("id", F.lit("documents").alias("origin")))


# Quality.


@_query("SELECT id, quality_score FROM source_documents WHERE quality_score >= 0.7")
def quality_filter(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_filter(table(spark, d, "source_documents")).select("id", "quality_score")


@_query("SELECT doc_id FROM documents WHERE coalesce(len(regexp_extract_all(text, '\\S+')), 0) <= 8192")
def length_filter(spark: SparkSession, d: str) -> DataFrame:
    return quality.length_filter(documents(spark, d)).select("doc_id")


@_query(
    """SELECT count(*) AS n_rows, count(*) FILTER (trim(coalesce(content, '')) <> '') AS n_text, count(quality_score) AS n_scored, count(*) FILTER (quality_score >= 0.7) AS n_good,
    count(*) FILTER (coalesce(len(regexp_extract_all(content, '\\S+')), 0) <= 8192) AS n_short,
    count(*) FILTER (trim(coalesce(content, '')) <> '' AND quality_score >= 0.7 AND len(regexp_extract_all(content, '\\S+')) <= 8192) AS n_kept FROM source_documents"""
)
def quality_funnel(spark: SparkSession, d: str) -> DataFrame:
    return quality.funnel(table(spark, d, "source_documents"))


@_query(
    """SELECT id, concat_ws(',', CASE WHEN trim(coalesce(content, '')) = '' THEN 'no_text' END, CASE WHEN quality_score IS NULL THEN 'no_score' END, CASE WHEN quality_score < 0.7 THEN 'low_score' END,
    CASE WHEN len(regexp_extract_all(content, '\\S+')) > 8192 THEN 'too_long' END) AS reasons FROM source_documents"""
)
def rejection_reasons(spark: SparkSession, d: str) -> DataFrame:
    return quality.reasons(table(spark, d, "source_documents"))


@_query("SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY md5(coalesce(text, chr(0)))")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return quality.exact_duplicates(documents(spark, d))


_GRAMS = f"""{_ONCE}, said AS (SELECT sample_id, concat_ws(chr(10), instruction, output) AS text FROM once),
    reps AS (SELECT min(sample_id) AS id, any_value(text) AS text FROM said GROUP BY md5(text)),
    w AS (SELECT id, regexp_extract_all(lower(text), '\\S+') AS w FROM reps),
    g AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0),
    size AS (SELECT id, count(*) AS n FROM g GROUP BY id),
    shared AS (SELECT a.id AS a, b.id AS b, count(*) AS n FROM g a JOIN g b ON a.s = b.s AND a.id < b.id GROUP BY a.id, b.id),
    similar_pair AS (SELECT a, b, s.n / (x.n + y.n - s.n) AS similarity FROM shared s JOIN size x ON x.id = a JOIN size y ON y.id = b WHERE s.n / (x.n + y.n - s.n) > {{above}})"""


def _said(spark: SparkSession, d: str) -> DataFrame:
    """What each sample says, question and answer, once."""
    said = samples(spark, d).select("sample_id", "ingested_at", F.concat_ws("\n", "instruction", "output").alias("text"))
    return latest(said, "sample_id", "ingested_at")


@_query(f"WITH {_GRAMS.format(above=0.8)} SELECT a, b, similarity FROM similar_pair")
def near_duplicate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return quality.similar_pairs(_said(spark, d), "sample_id", above=0.8)


@_query(f"WITH {_GRAMS.format(above=0.9)} SELECT id AS sample_id FROM reps WHERE id NOT IN (SELECT b FROM similar_pair)")
def near_duplicate_drop(spark: SparkSession, d: str) -> DataFrame:
    return quality.without_similar(_said(spark, d), "sample_id")


@_query("SELECT id, max(1.0 - quality_score) AS toxicity FROM source_documents WHERE 1.0 - quality_score <= 0.1 GROUP BY id")
def safety_filter(spark: SparkSession, d: str) -> DataFrame:
    """No table holds a toxicity; what a score lacks to 1 stands in for one."""
    scored = table(spark, d, "source_documents").select("id", (F.lit(1.0) - F.col("quality_score")).alias("toxicity"))
    return quality.safety_filter(scored)


@_query("SELECT doc_id, CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 10000 < 9000 THEN 'train' ELSE 'test' END AS split FROM documents")
def train_test_split(spark: SparkSession, d: str) -> DataFrame:
    return quality.split(documents(spark, d))


@_query("SELECT id, quality_score FROM source_documents ORDER BY quality_score DESC NULLS LAST, id LIMIT 50")
def target_cap(spark: SparkSession, d: str) -> DataFrame:
    return quality.capped(table(spark, d, "source_documents"), 50).select("id", "quality_score")


@_query("SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 100")
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    return quality.hash_sample(documents(spark, d), 100, "doc_id").select("doc_id")


def _corrected_sql() -> str:
    out = "regexp_replace(text, '\\r\\n?', chr(10), 'g')"
    out = f"regexp_replace({out}, '\\A\\s*```[ \\t]*(?:html|markdown|md)?[ \\t]*\\n([\\s\\S]*?)\\n```[ \\t]*\\s*\\z', '\\1')"
    out = f"regexp_replace({out}, '(?m)[ \\t]+$', '', 'g')"
    out = f"regexp_replace({out}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    for canonical in sorted(set(FENCE_LANGUAGES.values())):
        others = "|".join(sorted((k.replace(".", "\\.") for k, v in FENCE_LANGUAGES.items() if v == canonical and k != canonical), key=len, reverse=True))
        out = f"regexp_replace({out}, '(?im)^([ \\t]*```)(?:{others})[ \\t]*$', '\\1{canonical}', 'g')"
    return f"SELECT doc_id, md5({out}) AS corrected_md5 FROM documents"


@_query(_corrected_sql())
def auto_correction(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", F.md5(corrected(F.col("text"))).alias("corrected_md5"))


# Pages.

_UNIX = "regexp_replace(text, '\\r\\n?', chr(10), 'g')"


def _field_sql(key: str) -> str:
    line = f"trim(regexp_extract({_UNIX}, '(?m)^[^\\S\\n]*(?:<!--[^\\S\\n]*)?{key}:[^\\S\\n]*(.*?)[^\\S\\n]*(?:-->)?[^\\S\\n]*$', 1))"
    json = f"""trim(regexp_extract({_UNIX}, '"{key}"\\s*:\\s*"([^"\\n]*)"', 1))"""
    return f"coalesce(nullif({line}, ''), nullif({json}, ''))"


@_query("SELECT doc_id, " + ", ".join(f"{_field_sql(k)} AS {'ts' if k == 'timestamp' else k}" for k in pages.HEADER_KEYS) + f", try_cast({_field_sql('page_number')} AS INT) AS page FROM documents")
def page_metadata(spark: SparkSession, d: str) -> DataFrame:
    return pages.header(documents(spark, d))


_WHEN = "coalesce(" + ", ".join(f"try_strptime(nullif(trim(ts), ''), '{f}')::TIMESTAMP" for f in ("%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M", "%d.%m.%Y %H:%M", "%Y-%m-%d")) + ")"


@_query(
    f"""SELECT trim(page_id) AS page_id, max(nullif(regexp_extract(lower(language), '^\\s*([a-z]{{2}})', 1), '')) AS language, max(regexp_replace(lower(nullif(trim(document_name), '')), '[\\s_]+', '-', 'g')) AS document_name,
    max(try_cast(trim(page_number) AS INT)) AS page, max(nullif(trim(version), '')) AS version, max({_WHEN}) AS made_at FROM page_headers WHERE trim(page_id) <> '' GROUP BY 1"""
)
def header_rows(spark: SparkSession, d: str) -> DataFrame:
    return pages.normalised_headers(table(spark, d, "page_headers"))


_T = f"coalesce({_UNIX}, '')"


@_query(
    f"""SELECT doc_id, len(regexp_extract_all({_T}, '(?m)^#{{1,6}}[ \\t]+\\S')) AS n_headings, len(regexp_extract_all({_T}, '(?m)^[ \\t]*```')) AS n_fences,
    len(regexp_extract_all({_T}, '(?m)^[ \\t]*\\|.*\\|[ \\t]*$')) AS n_table_rows, len(regexp_extract_all({_T}, '(?m)^[ \\t]*(?:[-*+]|\\d+[.)])[ \\t]+\\S')) AS n_list_items,
    len(regexp_extract_all({_T}, '!\\[[^\\]\\n]*\\]\\(')) AS n_images, len(regexp_extract_all({_T}, '(?m)^[ \\t]*```')) % 2 = 1 AS unbalanced FROM documents"""
)
def page_block_stats(spark: SparkSession, d: str) -> DataFrame:
    return pages.block_stats(documents(spark, d))


@_query(
    f"""WITH lines AS (SELECT doc_id, unnest(string_split({_UNIX}, chr(10))) AS content, generate_subscripts(string_split({_UNIX}, chr(10)), 1) - 1 AS line FROM documents WHERE text IS NOT NULL),
    kinds AS (SELECT *, CASE WHEN regexp_matches(content, '^#{{1,6}}\\s+\\S') THEN 'heading' WHEN regexp_matches(content, '^\\s*```') THEN 'fence' WHEN regexp_matches(content, '^\\s*\\|.*\\|\\s*$') THEN 'table_row'
        WHEN regexp_matches(content, '!\\[[^\\]]*\\]\\(') THEN 'image' WHEN regexp_matches(content, '^\\s*(?:[-*+]|\\d+[.)])\\s+\\S') THEN 'list_item' END AS kind FROM lines)
    SELECT doc_id, line::INT AS line, kind, CASE WHEN kind = 'heading' THEN length(regexp_extract(content, '^(#{{1,6}})', 1))::INT END AS level, content FROM kinds WHERE kind IS NOT NULL"""
)
def page_blocks(spark: SparkSession, d: str) -> DataFrame:
    return pages.blocks(documents(spark, d))


@_query(
    f"""WITH l AS (SELECT lower(unnest(regexp_extract_all({_UNIX}, '(?m)^[ \\t]*```[ \\t]*([A-Za-z][\\w#+.-]*)[ \\t]*$', 1))) AS l FROM documents)
    SELECT CASE WHEN l IN ('csharp', 'cs', 'c#') THEN 'csharp' WHEN l IN ('vb', 'vb.net', 'vbnet', 'visualbasic') THEN 'vbnet' ELSE l END AS language, count(*) AS n_fences FROM l GROUP BY 1"""
)
def fence_languages(spark: SparkSession, d: str) -> DataFrame:
    return pages.fence_languages(documents(spark, d))


@_query(
    f"""SELECT DISTINCT doc_id, tag FROM (SELECT doc_id, trim(unnest(string_split_regex(array_to_string(regexp_extract_all({_UNIX}, '<!--\\s*tags:\\s*\\[?([^\\]]*?)\\]?\\s*(?:keywords:|-->)', 1), chr(10)), '[,\\n]'))) AS tag FROM documents) WHERE tag <> ''"""
)
def page_tags(spark: SparkSession, d: str) -> DataFrame:
    return pages.tags(documents(spark, d))


@_query(
    """SELECT count(*) AS n_pages, count(*) FILTER (contains(text, chr(13))) AS n_carriage_returns, count(*) FILTER (len(regexp_extract_all(text, '(?m)^[ \\t]*```')) % 2 = 1) AS n_unbalanced,
    count(*) FILTER (contains(text, chr(65533))) AS n_replacement, count(*) FILTER (regexp_matches(text, '(?i)\\[unclear\\]')) AS n_unclear, count(*) FILTER (contains(lower(text), 'example.com')) AS n_example_links,
    count(*) FILTER (contains(lower(text), 'all rights')) AS n_footers, count(*) FILTER (NOT contains(coalesce(text, ''), 'page_id')) AS n_without_page_id FROM documents"""
)
def page_irregularities(spark: SparkSession, d: str) -> DataFrame:
    return pages.irregularities(documents(spark, d))


@_query("SELECT doc_id, document_name FROM documents WHERE document_name IN ('release-digest', 'guide-tilegrid')")
def section_scan(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).where(F.col("document_name").isin("release-digest", "guide-tilegrid")).select("doc_id", "document_name")


@_query("SELECT doc_id, document_name FROM documents ORDER BY document_name, doc_id LIMIT 10")
def first_n_scan(spark: SparkSession, d: str) -> DataFrame:
    return validate.first_rows(documents(spark, d), 10, "document_name", "doc_id").select("doc_id", "document_name")


# Vectors.


@_query(
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), s AS (SELECT q.vec_id AS query_id, r.vec_id, round(list_cosine_similarity(q.e, r.e), 5) AS similarity
        FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
    SELECT query_id, vec_id, similarity, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""
)
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    return vectors.top_k(table(spark, d, "embeddings"), 10)


@_query(
    """WITH x AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), f AS (SELECT label, unnest(e) AS v, generate_subscripts(e, 1) AS dim FROM x),
    c AS (SELECT label, list(m ORDER BY dim) AS c FROM (SELECT label, dim, avg(v) AS m FROM f GROUP BY label, dim) GROUP BY label),
    s AS (SELECT x.vec_id, x.label, c.label AS l, round(-list_dot_product(x.e, c.c) / sqrt(list_dot_product(c.c, c.c)), 5) AS s FROM x, c)
    SELECT vec_id, label, nearest FROM (SELECT vec_id, label, l AS nearest, row_number() OVER (PARTITION BY vec_id ORDER BY s, l) AS k FROM s) WHERE k = 1"""
)
def vector_nearest_centroid(spark: SparkSession, d: str) -> DataFrame:
    return vectors.nearest_centroid(table(spark, d, "embeddings"))


@_query("SELECT label, (dim - 1)::INT AS dim, round(avg(x), 6) AS mean FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings) GROUP BY 1, 2")
def vector_centroids(spark: SparkSession, d: str) -> DataFrame:
    return vectors.centroids(table(spark, d, "embeddings"))


# Monitoring.


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


@_query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 32)::BIGINT AS batch FROM documents")
def batch_assign(spark: SparkSession, d: str) -> DataFrame:
    return monitor.batches(documents(spark, d))


@_query("SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY event_id) AS done FROM events")
def progress_running(spark: SparkSession, d: str) -> DataFrame:
    return monitor.running_count(_events(spark, d))


@_query(
    """SELECT ts::DATE AS day, event_type, count(*) AS n_events, count(*) >= 80 AS pressed, CASE WHEN count(*) >= 80 THEN 16 ELSE 32 END::INT AS batch_size FROM events GROUP BY 1, 2"""
)
def backpressure_flags(spark: SparkSession, d: str) -> DataFrame:
    return monitor.backpressure(_events(spark, d))


@_query("SELECT range::BIGINT AS attempt, power(2.0, range)::DOUBLE AS delay_s FROM range(3)")
def retry_schedule(spark: SparkSession, d: str) -> DataFrame:
    return monitor.retry_schedule(spark)


@_query("SELECT time_bucket(INTERVAL 1 hour, ts) AS started, event_type, count(*) AS n_events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def throughput_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return monitor.throughput(_events(spark, d))


@_query("SELECT ts::DATE::TIMESTAMP AS started, count(*) AS n_events, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY 1")
def value_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return monitor.value_percentiles(_events(spark, d))


@_query(
    """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 minutes THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n_events FROM s GROUP BY user_id, k"""
)
def user_sessions(spark: SparkSession, d: str) -> DataFrame:
    return monitor.sessions(_events(spark, d))


_RATE = "rate AS (SELECT user_id, count(*) AS n_total, count(*) FILTER (event_type <> 'error') AS n_success, count(*) FILTER (event_type = 'error') AS n_failed, round(100.0::DOUBLE * count(*) FILTER (event_type <> 'error') / count(*), 2) AS success_rate FROM events GROUP BY user_id)"


@_query(f"WITH {_RATE} SELECT * FROM rate")
def success_rate(spark: SparkSession, d: str) -> DataFrame:
    return monitor.success_rates(_events(spark, d))


@_query(f"WITH {_RATE} SELECT user_id, CASE WHEN success_rate >= 90 THEN 'success' WHEN success_rate >= 50 THEN 'degraded' ELSE 'failed' END AS status FROM rate")
def health_status(spark: SparkSession, d: str) -> DataFrame:
    return monitor.health(monitor.success_rates(_events(spark, d)))


@_query(
    """WITH once AS (SELECT run_id, max(source) AS source, max(total_requests) AS t, max(successful_requests) AS s, max(failed_requests) AS f FROM client_stats WHERE run_id IS NOT NULL GROUP BY run_id)
    SELECT source, count(*) AS n_runs, sum(t)::BIGINT AS total_requests, sum(s)::BIGINT AS successful_requests, sum(f)::BIGINT AS failed_requests, round(100.0::DOUBLE * sum(s) / nullif(sum(t), 0), 2) AS success_rate FROM once GROUP BY source"""
)
def client_stats(spark: SparkSession, d: str) -> DataFrame:
    return monitor.client_totals(table(spark, d, "client_stats"))


@_query("SELECT time_bucket(INTERVAL 1 hour, ts) AS started, event_type, count(*) AS n_events FROM events GROUP BY 1, 2")
def throughput_streamed(spark: SparkSession, d: str) -> DataFrame:
    return streamed_throughput(spark, d)
