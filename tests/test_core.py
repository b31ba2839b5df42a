"""Settings, layouts, validation, quality, monitoring, vectors, files, steps and the command line."""

from __future__ import annotations

import json
import math
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomline.__main__ import main
from loomline.functions import generate
from loomline.functions.text import corrected, preview, token_count
from loomline.operators import formats, monitor, quality, validate, vectors
from loomline.operators.deliveries import latest
from loomline.operators.ranks import running_number
from loomline.plans import config, logs, scratch, timeouts
from loomline.plans.steps import run_steps
from loomline.sources import files

CONV = "id string, conversations array<struct<sender:string,value:string>>"


def test_batch_config_rules_in_order():
    config.BatchConfig().validate()
    for broken, word in (
        ({"batch_size": 15}, "batch_size"), ({"batch_size": 101}, "batch_size"), ({"max_concurrent": 0}, "max_concurrent"), ({"backpressure_threshold": 0.0}, "backpressure"),
        ({"backpressure_threshold": math.nan}, "backpressure"), ({"degradation_threshold": 1.0}, "degradation_threshold"), ({"degradation_factor": 1.0}, "degradation_factor"),
        ({"degradation_factor": 0.0, "batch_size": 1}, "batch_size"),
    ):
        with pytest.raises(ValueError, match=word):
            config.BatchConfig(**broken).validate()
    config.BatchConfig(max_queue_size=-1, task_timeout=-1, max_retries=-1).validate()
    assert config.BatchConfig().retry_delays() == [1.0, 2.0, 4.0]


def test_config_files(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text('project_name: "X: y"  # note\ntarget_count: 7\nformats: ["alpaca", "openai"]\ntest_mode: true\nqdrant_port: 6333\nmin_quality_score: 0.5\nsteps:\n  - "md_processing"\n  - "quality_validation"  # off\n')
    got = config.load_config(str(path))
    assert (got.project_name, got.target_count, got.formats, got.test_mode, got.steps, got.other) == ("X: y", 7, ["alpaca", "openai"], True, ["md_processing", "quality_validation"], {"qdrant_port": 6333})
    assert config.validate_config_file(str(path)) == []
    assert config.validate_config_file(str(tmp_path / "none.yaml"))
    path.write_text("formats: [xml]\ntarget_count: 0\nlog_level: loud\nsteps: [nothing]\n")
    assert len(config.validate_config_file(str(path))) == 4
    path.write_text("what is this")
    assert config.validate_config_file(str(path))
    config.create_default_config(str(path))
    assert config.load_config(str(path)) == config.PipelineConfig()


def test_formatter_factory(spark):
    assert formats.supported_formats() == ["sharegpt", "alpaca", "openai"]
    with pytest.raises(ValueError):
        formats.formatter("xml")
    assert formats.describe_format("OpenAI") == formats.DESCRIPTIONS["openai"] and formats.describe_format("xml") == formats.UNKNOWN
    turns = [("Human", "q"), ("gpt", "a"), None, ("user", None), ("assistant", "b"), ("system", "s"), ("user", "q2")]
    df = spark.createDataFrame([("c", turns), ("e", []), ("n", None)], CONV)
    share = {r["id"]: r["conversations"] for r in formats.formatter("ShareGPT")(df).collect()}
    assert [(t["from"], t["value"]) for t in share["c"]] == [("human", "q"), ("gpt", "a"), ("gpt", "b"), ("system", "s"), ("human", "q2")] and share["e"] == share["n"] == []
    assert [tuple(r) for r in formats.alpaca(df).collect()] == [("c", 0, "q", "", "a")]
    assert {r["id"]: r["n_repeated_roles"] for r in formats.turn_stats(df).collect()} == {"c": 1, "e": 0, "n": 0}
    assert formats.first_turns(df, 2).count() == 2


def test_required_fields_know_missing_from_null(spark):
    full = {k: None for k in validate.REQUIRED}
    rows = [(1, json.dumps(full)), (2, json.dumps({"input": 1})), (3, "[]"), (4, "no json"), (5, None)]
    got = {r["k"]: (r["missing"], r["valid"]) for r in validate.required_fields(spark.createDataFrame(rows, "k int, json string")).collect()}
    assert got[1] == ([], True) and got[2][0] == ["instruction", "output", "tool_calls", "tools"] and all(len(got[k][0]) == 5 for k in (3, 4, 5))
    report = validate.validity_report(validate.required_fields(spark.createDataFrame(rows, "k int, json string")), "k").first()
    assert tuple(report) == (1, 10, 5)


def test_text_expressions(spark):
    df = spark.createDataFrame([("a b c  d",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(token_count(F.col("t"))).collect()] == [3, 0, 0]
    assert [r[0] for r in df.select(preview(F.col("t"), 2)).collect()] == ["a ...", "...", None]
    page = "```html\n# T  \r\n\r\n\r\n\r\nx\n```C#\ny\n```\n```"
    assert spark.createDataFrame([(page,)], "t string").select(corrected(F.col("t"))).first()[0] == "# T\n\nx\n```csharp\ny\n```"


def test_latest_counts_once_and_knows_ties(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "x"), (None, 9, "y")], "k int, o int, v string")
    assert sorted(tuple(r) for r in latest(df, "k", "o").collect()) == [(1, 2, "c"), (2, None, "x")]


def test_similar_pairs_against_brute_force(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(120)] for _ in range(12)]
    texts = []
    for words in base:
        texts.append(" ".join(words))
        edited = words.copy()
        edited[rng.randrange(3, 110)] = "edit"
        texts += [" ".join(edited), " ".join(words), " ".join(words[:60])]
    texts += [None, "", "short text", "short text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    texts += ["two words", "two  words", "Two words"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    grams = lambda t: {tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} if t.split() else set()
    first = {t: i for i, t in reversed(list(enumerate(texts)))}
    reps = [i for t, i in first.items() if t and grams(t)]
    want = {(a, b) for a in reps for b in reps if a < b and len(grams(texts[a]) & grams(texts[b])) > 0.8 * len(grams(texts[a]) | grams(texts[b]))}
    assert {(r["a"], r["b"]) for r in quality.similar_pairs(df, above=0.8).collect()} == want and want
    kept = {r["doc_id"] for r in quality.without_similar(df, above=0.8).collect()}
    assert kept == {i for t, i in first.items() if t is not None and i not in {b for _, b in want}} | {len(texts) - 7}
    assert quality.similar_pairs(df.limit(0)).count() == 0


def test_vectors_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)] + [(300, None), (350, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in vectors.top_k(df, 3).collect()}
    norm = {i: math.sqrt(sum(x * x for x in v)) for i, v in rows if v}
    for q in range(0, 300, 50):
        sim = sorted((-round(sum(a * b for a, b in zip(rows[q][1], v, strict=True)) / norm[q] / norm[i], 5), i) for i, v in rows if v and i != q and norm[i])
        assert [got[q, k + 1] for k in range(3)] == [i for _, i in sim[:3]]
    assert vectors.top_k(df.limit(0), 3).count() == 0


def test_monitoring(spark):
    df = spark.createDataFrame([(i * 3,) for i in range(100)], "doc_id bigint")
    got = monitor.batches(df, 32).orderBy("doc_id").collect()
    assert [r["batch"] for r in got] == [i // 32 for i in range(100)]
    rates = spark.createDataFrame([(1, 95.0), (2, 60.0), (3, 1.0), (4, None)], "user_id int, success_rate double")
    assert {r["user_id"]: r["status"] for r in monitor.health(rates).collect()} == {1: "success", 2: "degraded", 3: "failed", 4: "unknown"}
    assert spark.range(1).select(monitor.degraded(F.lit(32)), monitor.degraded(F.lit(20)), monitor.degraded(F.lit(80))).first()[0:3] == (16, 16, 40)


def test_running_numbers_in_small_ranges(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice("aab")) for k in rng.sample(range(-500, 90_000), 700)]
    got = {(r["k"], r["g"]): r["number"] for r in running_number(spark.createDataFrame(rows, "k bigint, g string"), "k", "g", size=3).collect()}
    assert got == {(k, g): n for g in "ab" for n, k in enumerate(sorted(k for k, h in rows if h == g))}


def test_sessions_over_midnight_and_hot_users(spark):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    times = sorted(start + timedelta(minutes=rng.randrange(0, 60 * 24 * 4)) for _ in range(300))
    df = spark.createDataFrame([(1, t) for t in times] + [(2, start), (None, start), (3, None)], "user_id int, ts timestamp_ntz")
    want = []
    for i, t in enumerate(times):
        if i and t - times[i - 1] < timedelta(minutes=30):
            want[-1][2:] = [t, want[-1][3] + 1]
        else:
            want.append([1, t, t, 1])
    got = sorted(list(r) for r in monitor.sessions(df).collect())
    assert got == sorted([*want, [2, start, start, 1]])


def test_generation(spark):
    df = spark.createDataFrame([("a", "C", "T", "text"), ("b", None, "T", "text"), ("c", "C", None, " ")], "id string, component string, title string, content string")
    assert tuple(generate.generation_stats(generate.template_conversations(df)).first()) == (3, 1, 2)

    def client(record):
        if record["component"] is None:
            raise ValueError("no component")
        return ("q", record["content"])

    got = {r["id"]: r["conversations"] for r in generate.generate(df, client, concurrent=2, retries=1, delay=0.0).collect()}
    assert got["b"] is None and got["a"][1]["value"] == "text"


def _pages(root):
    for section, n, body in (("grid", 3, "# Grid\n\nText."), ("grid", 1001, "# More\n\nText."), ("chart", 10, "# Chart\n\nText.")):
        folder = root / section
        folder.mkdir(exist_ok=True)
        (folder / f"page_{n:03d}.md").write_text(f"<!--\npage_id: {section}#page_{n}\n-->\n{body}\n", encoding="utf-8")


def test_files_steps_and_command_line(spark, tmp_path, capsys):
    root = tmp_path / "pages"
    root.mkdir()
    _pages(root)
    scanned = files.page_scan(spark, str(root))
    assert sorted((r["section"], r["page"]) for r in scanned.collect()) == [("chart", 10), ("grid", 3), ("grid", 1001)]
    assert files.page_scan(spark, str(root), ["grid"]).count() == 2
    assert files.with_sidecar(scanned, spark.createDataFrame([("grid", 3)], "section string, page int")).count() == 1
    files.compact_pages(scanned, str(tmp_path / "compact"))
    assert spark.read.parquet(str(tmp_path / "compact")).where("section = 'grid'").count() == 2

    settings = tmp_path / "c.yaml"
    settings.write_text(f"md_staging_path: {root}\noutput_directory: {tmp_path}/out\nformats: [alpaca, openai]\n")
    run = run_steps(spark, config.load_config(str(settings)))
    assert run.tables["pages"].count() == 3 and run.tables["alpaca"].count() == 3 and run.tables["funnel"].first()["n_kept"] == 3
    assert main(["list-steps"]) == 0 and main(["validate-config", "--config", str(settings)]) == 0
    assert main(["generate", "--config", str(settings)]) == 0
    assert spark.read.json(f"{tmp_path}/out/openai").count() == 3
    assert json.loads((tmp_path / "out/dataset_stats.json").read_text())["sections_processed"] == 2
    assert run_steps(spark, config.load_config(str(settings)), ["grid"]).tables["pages"].count() == 2
    settings.write_text("formats: [xml]\n")
    assert main(["validate-config", "--config", str(settings)]) == 1
    capsys.readouterr()


def test_thresholds_decide_what_is_written(spark, tmp_path):
    words = [f"w{i}" for i in range(300)]
    for n, body in enumerate((" ".join(words), " ".join(words), " ".join([*words[:-1], "last"]), "quite another page", "")):
        (tmp_path / "pages/grid").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"pages/grid/page_{n:03d}.md").write_text(f"<!--\npage_id: grid#page_{n}\n-->\n{body}\n", encoding="utf-8")
    settings = tmp_path / "c.yaml"
    head = f"md_staging_path: {tmp_path}/pages\noutput_directory: {tmp_path}/out\nmd_output_path: {tmp_path}/none\nformats: [alpaca]\n"
    for more, want in (("", 2), ("max_similarity_threshold: 1.0\n", 3)):
        settings.write_text(head + more)
        run = run_steps(spark, config.load_config(str(settings)))
        assert run.tables["alpaca"].count() == want
        assert tuple(run.tables["funnel"].select("n_rows", "n_kept", "n_unlike").first()) == (5, 4, want)
    settings.write_text(head)
    assert main(["generate", "--config", str(settings)]) == 0
    assert json.loads((tmp_path / "out/funnel.json").read_text())["n_unlike"] == 2


def test_batch_settings_vectors_sidecars_and_scores_reach_the_run(spark, tmp_path):
    root = tmp_path / "pages"
    root.mkdir()
    _pages(root)
    side = tmp_path / "side/grid"
    side.mkdir(parents=True)
    (side / "page_003.json").write_text("{}")
    spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "vectors"))
    settings = tmp_path / "c.yaml"
    settings.write_text(
        f"md_staging_path: {root}\nmd_output_path: {tmp_path}/none\noutput_directory: {tmp_path}/out\nformats: [alpaca]\nlog_file: {tmp_path}/run.log\nsidecar_path: {tmp_path}/side\n"
        f"vectors_path: {tmp_path}/vectors\ntop_k: 1\nmax_concurrent: 2\nmax_retries: 1\nretry_delay: 0.0\nbatch_timeout: 120.0\n"
    )
    cfg = config.load_config(str(settings))
    assert (cfg.batch.max_concurrent, cfg.batch.max_retries, cfg.batch.batch_timeout, cfg.problems()) == (2, 1, 120.0, [])
    run = run_steps(spark, cfg, generator=generate.Client().generator())
    assert [(r["section"], r["page"]) for r in run.tables["pages"].collect()] == [("grid", 3)]
    assert run.tables["conversations"].first()["conversations"][1]["sender"] == "gpt" and run.tables["alpaca"].count() == 1
    assert [(r["query_id"], r["vec_id"]) for r in run.tables["neighbours"].collect()] == [(0, 1)]
    assert main(["generate", "--config", str(settings)]) == 0
    assert "1 rows written" in (tmp_path / "run.log").read_text() and spark.read.json(f"{tmp_path}/out/neighbours").count() == 1
    settings.write_text("batch_size: 1\n")
    assert main(["validate-config", "--config", str(settings)]) == 1


def test_percentiles_of_large_and_small_groups(spark, monkeypatch):
    from loomline.operators import ranks

    monkeypatch.setattr(ranks, "WHOLE", 1000)
    rng = random.Random(1)
    rows = [("big", round(rng.gauss(0, 1), 3)) for _ in range(40_000)] + [("tied", 7.0)] * 5000 + [("tied", float(i)) for i in range(2000)] + [("small", float(i)) for i in (5, 1, 9, 2)] + [("one", 3.0), ("none", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: (r["p50"], r["p95"], r["p1"]) for r in ranks.percentiles(df, "x", {"p50": 0.5, "p95": 0.95, "p1": 1.0}, "g").collect()}
    want = {r["g"]: (r["p50"], r["p95"], r["p1"]) for r in df.groupBy("g").agg(F.percentile("x", 0.5).alias("p50"), F.percentile("x", 0.95).alias("p95"), F.percentile("x", 1.0).alias("p1")).collect()}
    assert set(got) == set(want) and all(a == b or abs(a - b) < 1e-9 for k in want for a, b in zip(got[k], want[k], strict=True))


def test_resources(spark):
    got = logs.resources(spark)
    assert got["executors"] == 1 and 0 < got["free"] <= got["memory"] and got["driver_peak"] > 0


def test_client_counts_its_requests():
    def down(messages):
        raise OSError("no server")

    client, broken = generate.Client(), generate.Client(down)
    assert client.test_connection() and client.chat_completion([{"role": "user", "content": "two words"}]) == {"content": "two words", "tokens_used": 2, "finish_reason": "stop"}
    assert not broken.test_connection()
    assert client.get_stats() == {"total_requests": 2, "successful_requests": 2, "failed_requests": 0, "success_rate": 100.0}
    assert broken.get_stats() == {"total_requests": 1, "successful_requests": 0, "failed_requests": 1, "success_rate": 0.0} and generate.Client().get_stats()["success_rate"] == 0.0


def test_whole_file_validation(spark, tmp_path, capsys):
    path = tmp_path / "d.json"
    assert files.validate_file(spark, str(path)) == (False, {})
    rows = [{"instruction": "i", "input": None, "output": "a Grid", "tools": ["{}"], "tool_calls": [{"function": {"name": "f"}}]}, {"instruction": "i", "output": "Basic Grid Configuration"}]
    path.write_text(json.dumps(rows))
    sound, found = files.validate_file(spark, str(path))
    assert sound and [tuple(r) for r in found["tool_usage"].collect()] == [("f", 1)]
    assert tuple(found["validity"].first()) == (1, 10, 2) and found["component_counts"].first()["n_grid"] == 2 and found["previews"].count() == 2
    path.write_text(json.dumps(rows)[:-5])
    assert files.validate_file(spark, str(path))[0] is False
    # A fault far from the start is found as well.
    path.write_text("[" + ", ".join([json.dumps(rows[0])] * 3000) + ', {"instruction": ]')
    assert files.read_dataset(spark, str(path)) is None
    stats = validate.dataset_stats(spark.createDataFrame([("ab", "c", "s")], "instruction string, output string, section string"), "section")
    assert validate.printed_means(stats) == "samples: 1, mean instruction length: 2.0, mean output length: 1.0"


def test_a_cluster_without_shared_folder_is_an_error():
    class Fake:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getConf():  # noqa: N802
                return {}

        conf = {}

    with pytest.raises(RuntimeError):
        scratch.scratch_dir(Fake)


def test_dataset_files(spark, tmp_path):
    path = tmp_path / "d.json"
    assert files.read_dataset(spark, str(path)) is None
    path.write_text("not json")
    assert files.read_dataset(spark, str(path)) is None
    df = spark.createDataFrame([("frage", "é", "antwort")], "instruction string, input string, output string")
    assert files.export_json_array(df, str(path)) == 1 and "é" in path.read_text(encoding="utf-8")
    assert files.read_dataset(spark, str(path)).count() == 1
    with pytest.raises(ValueError):
        files.export_json_array(spark.range(5), str(path), most=4)
    files.write_json_lines(df, str(tmp_path / "lines"))
    assert files.read_json_objects(spark, str(tmp_path / "lines")).count() == 1
    files.write_stats(df.agg(F.count("*").alias("n")), str(path))
    assert json.loads(path.read_text()) == {"n": 1}


def test_time_limits(spark):
    assert timeouts.within(spark, 60, lambda: spark.range(5).count()) == 5
    with pytest.raises(timeouts.TimeLimitExceeded):
        timeouts.within(spark, 1.5, lambda: spark.range(0, 10**13, 1, 4).selectExpr("sum(id % 7)").collect())
    with pytest.raises(ValueError):
        timeouts.within(spark, 60, lambda: int("x"))


def test_stream_of_many_files_loses_no_event(spark, tmp_path):
    from loomline.streaming.monitor import streamed_throughput

    start = datetime(2025, 1, 1)
    # The first files read are the newest ones: the others are a day and more behind.
    df = spark.createDataFrame([(start - timedelta(days=i), "a") for i in range(70)], "ts timestamp_ntz, event_type string").repartition(1)
    for i in range(70):
        df.where(F.col("ts") == F.lit(start - timedelta(days=i))).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    got = streamed_throughput(spark, str(tmp_path)).collect()
    assert len(got) == 70 and sum(r["n_events"] for r in got) == 70


def test_stream_progress(spark, tmp_path):
    spark.range(20).write.parquet(str(tmp_path / "in"))
    seen = timeouts.Progress()
    spark.streams.addListener(seen)
    try:
        q = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        for _ in range(50):
            if seen.rows == 20 and not seen.running:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    assert seen.rows == 20 and seen.batches >= 1 and not seen.running


def test_safety_and_modes(spark):
    assert quality.safety_filter(spark.createDataFrame([(0.1,), (0.2,), (None,)], "toxicity double")).count() == 1
    df = spark.createDataFrame([("a", "C", None, "text")], "id string, component string, title string, content string")
    assert generate.conversations(df).first()["conversations"][0]["sender"] == "human"
    with pytest.raises(ValueError):
        generate.conversations(df, generate.GenerationMode.LLM_ASSISTED)
    made = generate.conversations(df, generate.GenerationMode.LLM_ASSISTED, lambda r: ("q", "a"), concurrent=1)
    assert made.first()["conversations"][1]["value"] == "a"


def test_logs(spark, tmp_path):
    logs.create_logger("loomline.test", "debug", str(tmp_path / "x.log")).debug("hello")
    assert "hello" in (tmp_path / "x.log").read_text()
    watch = logs.Metrics("watched")
    watch.watch(spark.createDataFrame([(1,), (None,)], "a int")).collect()
    assert watch.get() == {"rows": 2, "null_a": 1}
    assert logs.health(spark) == {"status": "success"}
