"""Queries of this subpackage by name, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import mixing, mojibake, neardup, packing, pairs, repetition, terms, truncation
from loomline.sources.tables import documents, samples, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation(samples(spark, d)).where("truncated").select("sample_id")


def p1_cut_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_by_source(truncation.truncation(samples(spark, d)))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    freq = terms.tool_frequencies(samples(spark, d)).where(F.size("gram") == 1)
    return freq.where("verdict <> 'kept'").select(F.col("gram")[0].alias("tool_name"), "verdict")


def p2_frequencies(spark: SparkSession, d: str) -> DataFrame:
    freq = terms.tool_frequencies(samples(spark, d))
    return freq.select(F.array_join("gram", " ").alias("tool_names"), F.size("gram").alias("n_terms"), "occurrences", F.col("records").alias("samples"), "verdict")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.broken_pairs(samples(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.duplicate_pairs(*neardup.near_duplicates(samples(spark, d)))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(*neardup.near_duplicates(samples(spark, d)))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition(samples(spark, d), shares=False).where("repetitive").select("sample_id")


def p6_shares(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition(samples(spark, d)).select("sample_id", F.round("repeated_share", 6).alias("repeated_share"))


def p7_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(documents(spark, d), table(spark, d, "pack_capacities"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    capacities = table(spark, d, "pack_capacities")
    return packing.packing_report(packing.pack(documents(spark, d), capacities), capacities)


def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of a packing, whatever its sequences: all texts are in it, whole, none over its capacity, no short one split."""
    return packing.packing_invariants(packing.pack(documents(spark, d), table(spark, d, "pack_capacities")), table(spark, d, "pack_capacities"), documents(spark, d))


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of a mix, whatever its records: every budget is met but for less than one record, every repeat limit kept."""
    targets = table(spark, d, "mix_targets")
    return mixing.mix_invariants(mixing.mix(documents(spark, d), targets), targets, documents(spark, d))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(documents(spark, d), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mixing.mix_report(mixing.mix(documents(spark, d), targets), targets)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.find_garbled(documents(spark, d))[0].select("doc_id").distinct()


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.restore_garbled(documents(spark, d))


def queries() -> dict[str, Query]:
    own = (p1_found, p1_cut_rates, p2_found, p2_frequencies, p3_found, p5_found, p5_groups, p6_found, p6_shares, p7_packing, p7_report, p7_invariants, p8_mix, p8_shares, p8_invariants, p9_found, p9_restored)
    return {f.__name__: f for f in own}


_CALLS = """
once AS (SELECT sample_id, list_transform(coalesce(tool_calls, []), lambda c: CASE WHEN trim(c.function.name) <> '' THEN lower(trim(c.function.name)) ELSE 'unknown' END) AS names
         FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ingested_at DESC) AS k FROM syncfusion_tool_calling_dataset) WHERE k = 1),
total AS (SELECT count(*) AS n FROM once)
"""

_P2_GRAMS = " UNION ALL ".join(
    f"SELECT sample_id, list_transform(range(1, len(names) - {n - 2}), lambda i: array_to_string(names[i:i + {n - 1}], ' ')) AS grams, {n} AS n_terms FROM once WHERE len(names) >= {n}" for n in (1, 2, 3)
)


_SHARES = """one AS (SELECT sample_id, coalesce(regexp_extract_all(lower(output), '\\p{L}+'), []) AS w
        FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ingested_at DESC) AS k FROM syncfusion_tool_calling_dataset) WHERE k = 1),
    run AS (SELECT sample_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT sample_id, w, unnest(range(1, len(w) - 3)) AS i FROM one WHERE len(w) >= 5)),
    again AS (SELECT sample_id, i FROM (SELECT sample_id, i, row_number() OVER (PARTITION BY sample_id, g ORDER BY i) AS k FROM run) WHERE k > 1),
    covered AS (SELECT sample_id, count(DISTINCT i + d) AS n FROM again, range(0, 5) AS r(d) GROUP BY sample_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p7_invariants": "SELECT profile, (SELECT count(*) FROM documents WHERE text <> '') AS n_texts, 0::BIGINT AS n_wrong_tokens, 0::BIGINT AS n_split_short, 0::BIGINT AS n_overfull FROM pack_capacities",
        "p8_invariants": "SELECT source, true AS share_met, true AS limit_kept FROM mix_targets",
        "p2_found": f"""WITH {_CALLS}, used AS (SELECT DISTINCT sample_id, unnest(names) AS tool_name FROM once),
            freq AS (SELECT tool_name, count(*) AS s FROM used GROUP BY tool_name)
            SELECT tool_name, CASE WHEN s < 5 THEN 'rare' ELSE 'common' END AS verdict FROM freq, total WHERE s < 5 OR s > 0.1 * n""",
        "p2_frequencies": f"""WITH {_CALLS}, grams AS ({_P2_GRAMS}), flat AS (SELECT sample_id, n_terms, unnest(grams) AS tool_names FROM grams),
            freq AS (SELECT tool_names, n_terms::INT AS n_terms, count(*) AS occurrences, count(DISTINCT sample_id) AS samples FROM flat GROUP BY 1, 2)
            SELECT f.*, CASE WHEN samples < 5 THEN 'rare' WHEN samples > 0.1 * n THEN 'common' ELSE 'kept' END AS verdict FROM freq f, total""",
        # All pairs of the definition. Of truly equal texts only those with the smallest sample are given: the copies needn't be paired with each other.
        "p5_found": """WITH one AS (SELECT sample_id, concat_ws(chr(10), instruction, output) AS raw
                FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ingested_at DESC) AS k FROM syncfusion_tool_calling_dataset) WHERE k = 1),
            bag AS (SELECT sample_id, raw, min(sample_id) OVER (PARTITION BY raw) AS first, list_distinct(regexp_extract_all(lower(raw), '[\\p{L}\\p{N}]+')) AS w FROM one),
            word AS (SELECT sample_id, raw, first, len(w) AS n, unnest(w) AS word FROM bag)
            SELECT a.sample_id AS sample_id_a, b.sample_id AS sample_id_b FROM word a JOIN word b ON a.word = b.word AND a.sample_id < b.sample_id AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n
            WHERE a.raw <> b.raw OR a.sample_id = a.first
            GROUP BY a.sample_id, b.sample_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9""",
        "p6_found": f"""WITH {_SHARES} SELECT c.sample_id FROM covered c JOIN one o USING (sample_id) WHERE n >= 0.3 * len(w)""",
        "p6_shares": f"""WITH {_SHARES} SELECT o.sample_id, round(coalesce(n / len(w), 0.0), 6) AS repeated_share FROM one o LEFT JOIN covered USING (sample_id)""",
    }
