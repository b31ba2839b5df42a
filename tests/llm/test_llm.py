"""Operators on training text: against brute force, round trips, and on every odd input."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import mixing, mojibake, neardup, packing, pairs, queries, repetition, shingles, terms, tokens, truncation
from loomline.sources.tables import samples

VOCABULARY = tokens.VOCABULARY
SAMPLE = (
    "sample_id bigint, instruction string, input string, output string, tools array<string>, tool_calls array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>,"
    " source string, ingested_at timestamp, id string, row string, body string, seen string, size int, word string, key string"
)
T0 = datetime(2025, 1, 1)


def frame(spark, *rows):
    """Rows of sample_id, instruction, output, source, with columns whose names the operators use themselves."""
    return spark.createDataFrame([(r[0], r[1], None, r[2], None, r[4] if len(r) > 4 else None, r[3] if len(r) > 3 else "s", T0, "i", "r", "b", "s", 1, "w", "k") for r in rows], SAMPLE)


def texts(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], "doc_id bigint, text string, source string, id string, n_tokens int, word string, row int")


SENTENCES = [
    "The panel keeps a list of open windows on every platform.", "Call the handler before the first paint of the grid.", "Users may reorder items by dragging them onto the board.",
    "The exporter writes one block for each record in the store.", "Sizes below nine pixels are rounded up without a warning.", "Turn on the filter so that totals follow the group rows.",
]


def corpus(n, seed=3):
    rng = random.Random(seed)
    return [" ".join(rng.sample(SENTENCES, 4)) for _ in range(n)]


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, data, duck, name):
    df = queries.queries()[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert got == sorted(tuple(r[names.index(c)] for c in cols) for r in cursor.fetchall()) and got


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_gives_rows(spark, data, name):
    assert queries.queries()[name](spark, data).count() > 0


def operators(spark):
    capacities = spark.createDataFrame([("p", 16, 1)], "profile string, capacity_tokens int, separator_tokens int")
    targets = spark.createDataFrame([("x", 1.0, 2)], "source string, target_share double, max_repeats int")
    return {
        "truncation": lambda d: truncation.truncation(d), "cut rates": lambda d: truncation.truncation_by_source(truncation.truncation(d)),
        "terms": lambda d: terms.tool_frequencies(d), "pairs": lambda d: pairs.broken_pairs(d),
        "neardup": lambda d: neardup.duplicate_pairs(*neardup.near_duplicates(d)), "groups": lambda d: neardup.groups(*neardup.near_duplicates(d)),
        "repetition": lambda d: repetition.repetition(d), "repetition without shares": lambda d: repetition.repetition(d, shares=False),
    }, {
        "packing": lambda d: packing.pack(d, capacities), "packing report": lambda d: packing.packing_report(packing.pack(d, capacities), capacities),
        "mixing": lambda d: mixing.mix(d, targets), "mix report": lambda d: mixing.mix_report(mixing.mix(d, targets), targets),
        "garbled": lambda d: mojibake.find_garbled(d)[0], "restored": lambda d: mojibake.restore_garbled(d),
    }


def test_empty_tables(spark):
    of_samples, of_documents = operators(spark)
    for name, run in of_samples.items():
        assert run(frame(spark, (1, "a", "b")).limit(0)).count() == 0, name
    for name, run in of_documents.items():
        assert run(texts(spark, [(1, "a", "x")]).limit(0)).count() == (1 if name == "mix report" else 0), name


def test_nulls_empties_ties_and_repeated_rows(spark):
    long = "word " * 30_000 + "end."
    rows = [(1, None, None, None), (2, "", "", ""), (3, "ask", long, "s"), (3, "ask", long, "s"), (4, None, "x", None), (None, "a", "b", "c"), (5, "q", "​", "s"), (6, "one two three four", "one two three four", "s")]
    of_samples, of_documents = operators(spark)
    for name, run in of_samples.items():
        assert run(frame(spark, *rows)).collect() is not None, name
    docs = [(1, None, "x"), (2, "", "x"), (3, "a" * 70_000, "x"), (4, "same text", None), (5, "same text", "x"), (5, "same text", "x"), (None, "text", "x"), (6, "힣�", "x")]
    for name, run in of_documents.items():
        assert run(texts(spark, docs)).collect() is not None, name


# 1


def test_structure_of_ends():
    cut, whole, left = truncation.CUT, truncation.WHOLE, truncation.OPEN
    for text, want in (
        (None, whole), ("", whole), ("null", whole), ("A sentence.", whole), ("Code:\n```cs\nvar a = 1;", cut), ("Code:\n```cs\nvar a;\n```", whole), ("| a | b |\n|---|---|\n| 1 | 2", cut),
        ("| a | b |\n|---|---|\n| 1 | 2 |", whole), ("| a | b |\n| 1 |", whole), ("Steps:\n-", cut), ("Call it (see also", cut), ("Ends with a comma,", cut), ("Ask. (Checked with build 9)", whole), ("open end of", left), ("It is `A = true`", whole),
    ):
        assert truncation.structure(text) == want, text
    assert truncation.structure("How do I do this thing", "How do I do this thing?") == whole


def test_alignment_shows_early_ends():
    full = "The panel keeps a list of open windows on every platform and reports changes to its owner before anything is drawn. Done."
    assert truncation.ends_early(full[:70], full) == truncation.CUT
    assert truncation.ends_early(full[: full.index(" before")], full) == truncation.CUT
    assert truncation.ends_early(full.removesuffix(". Done."), full) == truncation.WHOLE
    assert truncation.ends_early("Something else entirely stands in this other text here", full) == truncation.OPEN


def test_truncation_finds_planted_cuts(spark):
    rng = random.Random(9)
    rows, want = [], set()
    for i, t in enumerate(corpus(300)):
        if i % 10 == 0:
            at = rng.randrange(len(t) // 3, len(t) - 8)
            while t[at] in " ." or t[at - 1] in " .":
                at += 1
            t = t[:at]
            want.add(i)
        elif i % 10 == 1:
            t = t.removesuffix(".")
        rows.append((i, "How?", t, f"s{i % 3}"))
    found = truncation.truncation(frame(spark, *rows))
    got = {r["sample_id"] for r in found.where("truncated").collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got - want) <= 0.05 * len(want)
    rates = {r["source"]: r for r in truncation.truncation_by_source(found).collect()}
    assert sum(r["truncated"] for r in rates.values()) == len(got) and sum(r["records"] for r in rates.values()) == 300


def test_alignment_goes_on_past_the_longest_copy(spark):
    words = [f"w{i}" for i in range(200)]
    short = " ".join(words)
    settles = short + " goes on until the end."
    # Longer copies that diverge before the end of the short one.
    others = [" ".join([*words[:-2], *[f"v{k}x{i}" for i in range(12)]]) + "." for k in range(12)]
    rows = [(1, "How?", short), (2, "How?", settles), *[(10 + k, "How?", t) for k, t in enumerate(others)]]
    got = {r["sample_id"]: (r["truncated"], r["evidence"]) for r in truncation.truncation(frame(spark, *rows)).collect()}
    assert got[1] == (True, "alignment")


def test_cut_near_copies_are_found_wherever_they_are_cut(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for k in range(200):
        words = [f"w{rng.randrange(4000)}" for _ in range(150)]
        at = int(len(words) * (0.4, 0.5, 0.6, 0.7, 0.9)[k % 5])
        edited = [f"e{rng.randrange(10**6)}" if j < at - 6 and rng.random() < 0.015 else w for j, w in enumerate(words)]
        rows += [(2 * k, "How?", " ".join(words) + "."), (2 * k + 1, "How?", " ".join(edited[:at]))]
        want[2 * k + 1] = truncation.ends_early(rows[-1][2], rows[-2][2]) == truncation.CUT
    got = {r["sample_id"]: r for r in truncation.truncation(frame(spark, *rows)).collect()}
    similar = [k for k, cut in want.items() if cut]
    assert len(similar) > 120 and sum(got[k]["truncated"] and got[k]["evidence"] == "alignment" for k in similar) >= 0.98 * len(similar)
    for k in range(5):
        own = [x for x in similar if x // 2 % 5 == k]
        assert sum(got[x]["evidence"] == "alignment" for x in own) >= 0.9 * len(own), k
    assert not any(got[2 * k]["truncated"] for k in range(200))


def test_others_of_a_bucket_follow_where_the_first_is_too_unlike(spark):
    words = [f"w{i}" for i in range(120)]
    short = " ".join(words)
    tail = " goes on until the end."
    # Alike enough to share buckets, and with the same continuation, but below the similarity: they may stand for the one that settles.
    poor = [" ".join(f"v{k}x{i}" if i % 23 == k % 23 and i < 110 else w for i, w in enumerate(words)) + tail for k in range(60)]
    rows = [(1, "How?", short), (2, "How?", short + tail), *[(10 + k, "How?", t) for k, t in enumerate(poor)]]
    got = {r["sample_id"]: (r["truncated"], r["evidence"]) for r in truncation.truncation(frame(spark, *rows)).collect()}
    assert got[1] == (True, "alignment")


def test_cuts_with_dots_are_no_evidence_of_an_end(spark):
    whole = corpus(200)
    rows = [(i, "How?", t) for i, t in enumerate(whole)]
    # The same fragment before dots again and again, as in any large table, and the same cut without dots.
    rows += [(1000 + i, "How?", f"{t} Users may reord...") for i, t in enumerate(whole[:12])] + [(1100 + i, "How?", f"{t} Users may reord") for i, t in enumerate(whole[12:24])]
    rows += [(1200 + i, "How?", f"{t} To finish, open the menu {i} and choose Browse…") for i, t in enumerate(whole[24:44])]
    got = {r["sample_id"] for r in truncation.truncation(frame(spark, *rows)).where("truncated").collect()}
    assert got == {*range(1000, 1012), *range(1100, 1112)}


def test_a_block_cut_open_is_not_closed_by_the_next_one():
    text = "Set it.\n```cs\nvar book = new X(\nSet it.\n```cs\nvar book = new X(book);\n```\nDone now"
    assert truncation._prose_words(text) == ["set", "it", "done", "now"]
    assert truncation._prose_words("a\n```cs\nvar x;\n```\nb\n```\ny\n```\nc") == ["a", "b", "c"]


def test_emptiness_knows_no_length():
    for text in ("```csharp\n" * 9, "<p></p>" * 40, "```\n```\n" * 30):
        assert truncation.is_empty(text) and pairs.defect("How do I sort the grid?", text) == "empty" and truncation.structure(text) == truncation.WHOLE
    assert not truncation.is_empty("```csharp\nvar a = 1;\n```") and not truncation.is_empty("none " * 12)


# 2


def test_terms_against_brute_force(spark):
    rng = random.Random(4)
    rows = [[rng.choice("aaaaabcd") for _ in range(rng.randrange(0, 9))] for _ in range(200)] + [["a"] * 50, None, []]
    df = spark.createDataFrame([(r,) for r in rows], "t array<string>")
    count, records = Counter(), Counter()
    for r in rows:
        grams = [tuple(r[i : i + n]) for n in range(1, 5) for i in range(len(r) - n + 1)] if r else []
        count.update(grams)
        records.update(set(grams))
    got = {tuple(r["gram"]): (r["occurrences"], r["records"]) for r in terms.term_frequencies(df, "t", 4).collect()}
    assert got == {g: (count[g], records[g]) for g in count}


def test_a_long_record_is_counted_in_one_pass(spark):
    long = ["a", "b", "c"] * 20_000
    got = {tuple(r["gram"]): (r["occurrences"], r["records"]) for r in terms.term_frequencies(spark.createDataFrame([(long,)], "t array<string>"), "t", 3).collect()}
    assert got[("a",)] == (20_000, 1) and got[("c", "a", "b")] == (19_999, 1) and len(got) == 9


def test_tool_names(spark):
    call = lambda n: ("c", "f", (n, None))
    df = frame(spark, (1, "", "", "", [call(" Get "), call("get"), None, ("c", "f", None), call(None), call("  ")]), (1, "", "", "", [call(" Get "), call("get"), None, ("c", "f", None), call(None), call("  ")]), (2, "", "", "", None))
    got = {tuple(r["gram"]): (r["occurrences"], r["records"], r["verdict"]) for r in terms.tool_frequencies(df, 1).collect()}
    assert got == {("get",): (2, 1, "rare"), ("unknown",): (4, 1, "rare")}


# 3


@pytest.mark.parametrize(
    ("prompt", "response", "want"),
    [
        ("How do I sort the grid by two columns?", None, "empty"), ("x", "  ​", "empty"), ("x", "```csharp\n\n```", "empty"), ("x", "<answer></answer>", "empty"), ("x", "N/A", "empty"),
        ("How do I sort the grid by two columns?", "**How do I sort the grid by two columns?**", "copied_question"), ("How do I sort the grid by two columns?", "HOW DO I SORT THE GRID BY TWO COLUMNS\nHow do I sort the grid by two columns", "copied_question"),
        ("How do I sort the grid by two columns?", "Answer: how  do I sort the grid by two columns", "copied_question"), ("How do I sort the grid by two columns?", "I'm sorry, but I can't help with the grid. Please consult the owner of it.", "refusal"),
        ("Wie sortiere ich die Tabelle nach zwei Spalten?", "Es tut mir leid, aber dazu kann ich keine Auskunft geben.", "refusal"), ("How do I sort the grid by two columns?", "Sorry for the long text: the grid cannot sort by itself, so call Sort twice.", None),
        ("How do I sort the grid by two columns?", "Sie können die Tabelle mit der Methode und nach dem Laden für jede Spalte sortieren.", "other_language"), ("Answer in German: How do I sort the grid?", "Sie können die Tabelle mit der Methode und nach dem Laden für jede Spalte sortieren.", None),
        ("Wie kann ich die Tabelle nach zwei Spalten sortieren?", "默认情况下，对象保存所有打开的窗口，缓存不会被清空。", "other_language"), ("How do I sort the grid by two columns?", "`Sort(1, 2)`", None), ("How do I sort the grid by two columns?", "Yes. Set AllowSort first.", None), (None, "Anything goes here.", None),
    ],
)
def test_defects(prompt, response, want):
    assert pairs.defect(prompt, response) == want


def test_languages_without_function_words_are_other(spark):
    english = [" ".join(random.Random(i).sample(SENTENCES, 3)) for i in range(200)]
    rows = [(i, f"How do I use the panel number {i} of the grid with a filter?", t) for i, t in enumerate(english)]
    foreign = {1000: "Mřížka zobrazuje všechny řádky tabulky, pokud uživatel nezmění nastavení stránky nebo neodstraní sloupec.", 1001: "A táblázat minden sorát megjeleníti, kivéve ha a felhasználó megváltoztatja az oldal beállításait.", 1002: "Bảng hiển thị tất cả các hàng trừ khi người dùng thay đổi cài đặt của trang hoặc xóa một cột."}
    rows += [(k, "How do I use the panel of the grid with a filter?", t) for k, t in foreign.items()] + [(2000, "How do I use the panel of the grid with a filter?", "Open windows list; items reorder; totals follow group rows; sizes round up.")]
    got = {r["sample_id"]: r["defect"] for r in pairs.broken_pairs(frame(spark, *rows)).collect()}
    assert {k for k, d in got.items() if d == "other_language"} == set(foreign)


def test_pairs_cut_before_dots_stay_truncated_however_many_they_are(spark):
    whole = corpus(120)
    rows = [(i, "How do I use the panel of the grid with a filter?", t) for i, t in enumerate(whole)]
    rows += [(1000 + i, r[1], f"{r[2]} Users may reord{'...' if i % 2 else ''}") for i, r in enumerate(rows[:24])]
    got = {r["sample_id"]: r["defect"] for r in pairs.broken_pairs(frame(spark, *rows)).collect()}
    assert got == {1000 + i: "truncated" for i in range(24)}


def test_profiles_count_every_text_once(spark):
    rows = [(i, f"How do I use the panel number {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} of the grid with a filter?", "The rows of the grid are sorted by the first column when it is loaded.") for i in range(9000)]
    made = pairs.train_profiles(frame(spark, *rows, *rows[:50]), "instruction", "output")
    want = sum(len(pairs._trigrams(pairs._prose(t))) for t in {x for r in rows for x in r[1:]})
    counts = np.bincount(np.concatenate([pairs._trigrams(pairs._prose(t)) for t in {x for r in rows for x in r[1:]}]), minlength=pairs.PROFILE)
    assert np.allclose(made.log["en"], np.log((counts + 0.5) / (want + 0.5 * pairs.PROFILE)), atol=1e-4)


ODD = ["", " ", "naïve Ärger 2²½ µ ÿß", "a–b “c” …d_e 3x", "ΑΣ'Α ΟΔΟΣ İstanbul Ⅷ", "한국어 SfGrid.AllowSort を x\x85y\xa0z", "Kelvin K ſ ﬁ", "the `code` | a | b\n| row | x |\nHTMLText a1 _b fooBar Foo"]


def test_words_by_table_are_those_of_the_patterns():
    for text in ODD:
        assert shingles.words_of(text) == shingles.LETTERS_DIGITS.findall(text.lower())
        assert pairs._letters(text) == shingles.LETTERS.findall(text.lower())
        assert pairs._whole_words(text) == re.findall(r"\w+", text)
        assert pairs._distinct_words(text) == " ".join(dict.fromkeys(shingles.LETTERS.findall(pairs._prose(text))))


def test_scores_of_many_texts_at_once():
    """Trigrams and scores of texts one after another are those of each text alone, without its own trigrams in the profile."""
    rng = np.random.default_rng(7)
    texts = ["", "a", *("".join(rng.choice(list("abcde é한")) for _ in range(int(rng.integers(1, 400)))) for _ in range(100))]
    alone = [pairs._word_trigrams([t])[0] for t in texts]
    grams, owner = pairs._word_trigrams(texts)
    assert [grams[owner == k].tolist() for k in range(len(texts))] == [g.tolist() for g in alone]
    counts = np.bincount(grams, minlength=pairs.PROFILE).astype(float)
    want = []
    for g in alone:
        if len(g) >= pairs.TELLING_GRAMS:
            others = counts - np.bincount(g, minlength=pairs.PROFILE)
            want.append(np.log((others[g] + 0.5) / (others.sum() + 0.5 * pairs.PROFILE)).mean())
    assert np.allclose(pairs._scores(counts, texts), want, atol=1e-9) and len(want) > 50


def test_parts_of_all_names_at_once():
    lexicon = truncation._Lexicon()
    seen = ["fooBar", "fooBar", "word", "_", "é_é", "HTMLFooBar2", "barFoo", "Foo_Bar"]
    lexicon.saw(np.array(lexicon.numbers(seen)))
    want = {}
    for name in (x for x in seen if truncation._norm(x) == "\x01name"):
        parts = truncation._PART.findall(name)
        for sign, own in (("\x02", parts), ("\x03", [f"{x} {y}" for x, y in itertools.pairwise(parts)])):
            for k, part in enumerate(own):
                n, ends = want.get(key := truncation._H(sign + part), (0, 0))
                want[key] = n + 1, ends + (k == len(own) - 1)
    assert {int(k): (n, e) for k, n, e in zip(*lexicon.name_parts(), strict=True)} == want


def test_refusals_are_aligned_by_token():
    for response in ("I'm sory, but I cant help with the grid.", "I am really not able to answer that.", "Lo siento, no puedo respondr a eso."):
        assert pairs.defect("How do I sort the grid by two columns?", response) == "refusal", response
    for response in ("I am able to provide the list of columns.", "I can help with that: call Sort.", "I'm sure you can sort by two columns.", "I want to be able to sort it."):
        assert pairs.refusal_score(response) == 0, response


@pytest.mark.parametrize(
    "response",
    [
        "I'm unable to answer the question " + "how the grid and the panel beside it are sorted by two columns " * 40, "I cannot help. " * 9,
        "Es tut mir leid, aber dazu kann ich keine Auskunft geben. Bitte wenden Sie sich an den Hersteller.", "Je ne peux pas répondre à cette question. N'hésitez pas à consulter le manuel.",
        "Lo siento, no puedo responder a eso. ¿Hay algo más en lo que pueda ayudarle?", "죄송하지만 답변을 드릴 수 없습니다. 다른 질문이 있으시면 알려 주세요.",
    ],
)
def test_refusals_of_any_length_and_language(response):
    assert pairs.is_refusal(response, pairs._tokens(response))
    assert not pairs.is_refusal(f"{response} Set AllowSort to true and call Sort twice.".replace("columns  Set", "columns. Set"), pairs._tokens(response))


def test_longest_common_subsequence_against_table():
    rng = random.Random(2)
    for _ in range(50):
        a, b = [rng.choices("abcd", k=rng.randrange(0, 30)) for _ in range(2)]
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert pairs._common_subsequence(a, b) == t[-1, -1]


# 5


def brute_pairs(rows, threshold=0.8):
    sets = {i: frozenset(re.findall(r"[^\W_]+", t.lower())) for i, t in rows.items()}
    return {(a, b) for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-12}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(7)
    rows = {}
    for k in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(3, 60))] + rng.sample(["the", "of", "and", "to", "for", "with", "grid", "row"], 5)
        for v in range(4):
            edited = words.copy()
            for _ in range(v * len(words) // 12):
                edited[rng.randrange(len(edited))] = f"e{rng.randrange(10**6)}"
            rng.shuffle(edited)
            rows[len(rows)] = " ".join(edited)
    members, links = neardup.near_duplicates(frame(spark, *[(i, t, None) for i, t in rows.items()]))
    classes = {r["sample_id"]: r["class_id"] for r in members.collect()}
    want = {(classes[a], classes[b]) for a, b in brute_pairs(rows) if classes[a] != classes[b]}
    assert {(r["class_a"], r["class_b"]) for r in links.collect()} == {(min(p), max(p)) for p in want} and len(want) > 40
    group = {r["sample_id"]: r["group_id"] for r in neardup.groups(members, links).collect()}
    assert all(group[a] == group[b] for a, b in brute_pairs(rows))


def test_a_third_of_all_rows_alike_stays_linear(spark):
    rows = [(i, "the very same question as ever", "and the very same answer") for i in range(400)] + [(1000 + i, f"q{i}", f"other {i * 7}") for i in range(800)]
    members, links = neardup.near_duplicates(frame(spark, *rows))
    assert neardup.duplicate_pairs(members, links).where("sample_id_a < 1000").count() == 399


def test_pairs_of_equal_words_in_different_texts(spark):
    words = [f"w{i}" for i in range(20)]
    near = ["other", *words[1:]]
    rows = {1: " ".join(words), 2: " ".join(words[::-1]), 3: " ".join(words).upper(), 4: ", ".join(words), 5: " ".join(near), 6: " ".join(near[::-1]), 7: " ".join(near).upper(), 8: "nothing like it"}
    got = [tuple(r) for r in neardup.duplicate_pairs(*neardup.near_duplicates(frame(spark, *[(i, t, None) for i, t in rows.items()]))).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(rows)
    copies = {**rows, 9: rows[2], 10: rows[2], 11: rows[5]}
    got = [tuple(r) for r in neardup.duplicate_pairs(*neardup.near_duplicates(frame(spark, *[(i, t, None) for i, t in copies.items()]))).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(copies) - {(9, 10)}


def test_hot_pairs_of_words_get_a_third(spark):
    """With keys that turn hot at three records, single words, pairs and triples are all used, and none is lost."""
    rng = random.Random(11)
    common = [f"c{i}" for i in range(40)]
    rows = {}
    for k in range(60):
        words = rng.sample(common, 24) + [f"r{k}"]
        for v in range(3):
            rows[len(rows)] = " ".join([*words[: len(words) - v], *[f"x{v}" for _ in range(v > 0)]])
    members, links = neardup.near_duplicates(frame(spark, *[(i, t, None) for i, t in rows.items()]), alone=3)
    got = {tuple(r) for r in neardup.duplicate_pairs(members, links).collect()}
    assert got == brute_pairs(rows) and len(got) > 100


def test_unfinished_groups_are_an_error(spark):
    members = spark.createDataFrame([(i, i) for i in range(60)], "sample_id bigint, class_id bigint")
    links = spark.createDataFrame([(i, i + 1) for i in range(59)], "class_a bigint, class_b bigint")
    with pytest.raises(RuntimeError):
        neardup.groups(members, links, rounds=1)
    assert {r["group_id"] for r in neardup.groups(members, links).collect()} == {0}


def test_pruning_keeps_what_may_reach_the_threshold():
    rng = np.random.default_rng(1)
    for bits in (64, 128):
        kept = rng.binomial(bits, 0.9, 200_000) >= neardup.least_matches(bits)
        assert 1 - kept.mean() < 1e-4
        assert (rng.binomial(bits, 0.6, 20_000) >= neardup.least_matches(bits)).mean() < 0.2


# 6


def brute_share(text):
    w = re.findall(r"[^\W\d_]+", (text or "").lower())
    seen, hit = set(), [False] * len(w)
    for i in range(len(w) - 4):
        g = tuple(w[i : i + 5])
        if g in seen:
            hit[i : i + 5] = [True] * 5
        seen.add(g)
    return sum(hit) / len(w) if w else 0.0


def test_shares_against_brute_force():
    rng = random.Random(8)
    given = [" ".join(rng.choices(["a", "b", "c9d", "e_f", "Ä"], k=rng.randrange(0, 60))) for _ in range(300)] + [None, "", "one two three four", "la " * 50]
    got = repetition.repeated_share(shingles.Batch(given, shingles.LETTERS, shingles.WordHasher()))
    assert np.allclose(got, [brute_share(t) for t in given])


def test_scorer_on_held_out_rows(spark):
    rng = random.Random(6)
    made = lambda: " ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(80))
    rows = [(i, "q", made() if i % 5 else " ".join([made()[:90]] * 4)) for i in range(1200)]
    df = frame(spark, *rows)
    scorer = repetition.train(df.where("sample_id < 600"), "output")
    held = repetition.repetition(df.where("sample_id >= 600"), scorer=scorer).toPandas()
    truth = held["repetitive"].to_numpy()
    assert truth.sum() == 120 and ((held["probability"] > 0.5).to_numpy() == truth).mean() > 0.98
    assert abs(held["probability"].mean() - truth.mean()) < 0.05
    found = repetition.repetition(df.where("sample_id >= 600"), scorer=scorer, shares=False).cache()
    assert found.where("repetitive").count() == 120 and found.count() == 600
    assert found.where("repetitive and evidence = 'probability'").count() > 60 and found.where("evidence = 'probability' and repeated_share is not null").count() == 0
    # Without a scorer that knows anything, the exact share decides every row.
    blind = repetition.repetition(df.where("sample_id >= 600"), scorer=repetition.Scorer(), shares=False)
    assert blind.where("repetitive").count() == 120 and blind.where("evidence <> 'share'").count() == 0


def test_proof_never_contradicts_the_share():
    rng = random.Random(3)
    given = [" ".join(rng.choices([f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(rng.choice([3, 20, 60, 300]))], k=rng.randrange(0, 80))) for _ in range(400)]
    b = shingles.Batch(given, shingles.LETTERS, shingles.WordHasher())
    assert not (repetition.proven(b) & (repetition.repeated_share(b) >= repetition.REPETITIVE)).any()
    assert repetition.proven(b).any()


# 7


@pytest.mark.parametrize(("capacity", "separator"), [(16, 0), (64, 1), (300, 2)])
def test_plans_hold_the_histogram(capacity, separator):
    rng = np.random.default_rng(capacity)
    sizes = packing.edges_of(capacity)
    histogram = np.bincount(np.minimum(rng.geometric(0.05, 5000), len(sizes)) - 1, minlength=len(sizes))
    plan = packing.make_plan(histogram, sizes, capacity, separator)
    used = np.zeros(len(sizes), int)
    for p, n in plan:
        assert n > 0 and sum(sizes[i] for i in p) + separator * (len(p) - 1) <= capacity
        for i in p:
            used[i] += n
    assert (used == histogram).all()
    total = sum(sizes[i] * histogram[i] for i in range(len(sizes)))
    assert total / (capacity * sum(n for _, n in plan)) > 0.9


def test_most_pieces_are_in_fitted_patterns():
    rng = np.random.default_rng(5)
    for capacity in (512, 2048, 8192):
        sizes = packing.edges_of(capacity)
        lengths = np.minimum(rng.lognormal(5.5, 1.1, 4000).astype(int) + 1, capacity)
        histogram = np.bincount(np.searchsorted(sizes, lengths, "left"), minlength=len(sizes))
        _, left = packing.fitted(histogram, sizes, capacity, 1)
        assert 1 - left.sum() / histogram.sum() >= 0.8, capacity


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        weights, prices = rng.integers(1, 12, 5), rng.random(5)
        best = np.zeros(31)
        for c in range(1, 31):
            best[c] = max([best[c - 1], *(best[c - w] + p for w, p in zip(weights, prices, strict=True) if w <= c)])
        found = packing.knapsack(prices, weights, 30)
        assert all(sum(weights[list(p)]) <= 30 for p in found) and abs(max(sum(prices[list(p)]) for p in found) - best[30]) < 1e-9


def test_packing_places_every_token_once(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["word"] * rng.choice([1, 2, 5, 9, 30, 200])), "x") for i in range(400)] + [(400, None, "x"), (401, "", "x"), (402, "one", "x"), (402, "one", "x")]
    df = texts(spark, rows)
    caps = spark.createDataFrame([("a", 32, 1), ("b", 7, 0)], "profile string, capacity_tokens int, separator_tokens int")
    packed = packing.pack(df, caps).cache()
    sizes = Counter()
    for r in tokens.token_sizes(df, "doc_id", "text", vocabulary=VOCABULARY).collect():
        sizes[r["id"]] += r["n_tokens"]
    for profile, capacity, separator in (("a", 32, 1), ("b", 7, 0)):
        own = packed.where(F.col("profile") == profile).collect()
        got = Counter()
        for r in own:
            got[r["doc_id"]] += r["n_tokens"]
        assert got == Counter({k: v for k, v in sizes.items() if v})
        by = {}
        for r in own:
            by.setdefault(r["sequence_id"], []).append(r)
        assert all(sum(r["n_tokens"] for r in s) + separator * (len(s) - 1) <= capacity and len({r["slot"] for r in s}) == len(s) for s in by.values())
        single = Counter(i for i, t, _ in rows)
        pieces = Counter((r["doc_id"]) for r in own)
        assert all(pieces[i] == max(1, math.ceil(sizes[i] / capacity)) for i in pieces if single[i] == 1)
    assert all(r["utilisation"] > 0.9 and r["overfull"] == 0 for r in packing.packing_report(packed, caps).collect())


# 8


def test_mix_meets_shares_and_limits(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["word"] * rng.randrange(1, 40)), ["big", "mid", "small"][0 if i % 10 else 1 if i % 20 else 2]) for i in range(3000)] + [(5000, "word", "untargeted"), (5001, "word", None)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.2, 4), ("absent", 0.0, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(texts(spark, rows), targets).cache()
    report = {r["source"]: r for r in mixing.mix_report(mixed, targets).collect()}
    for name, share in (("big", 0.5), ("mid", 0.3), ("small", 0.2)):
        assert abs(report[name]["actual_share"] - share) < 0.01 and report[name]["most_copies"] <= report[name]["max_repeats"]
    assert mixed.select("source").distinct().count() == 3
    assert mixed.groupBy("doc_id", "epoch").count().where("count > 1").count() == 0
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mixing.mix(texts(spark, rows).repartition(7), targets).collect()))


# 9


def test_garbled_documents_are_found_and_restored(spark):
    clean = ["Für die Größe müssen Sie über das Menü gehen.", "L’élément récupère la hauteur de l’en-tête.", "화면을 새로 그립니다. 값을 저장합니다.", "Costs are shown as € or £ here."] * 3
    rows = list(enumerate(clean))
    chains = [("utf-8", "cp1252"), ("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437")]
    broken = {100 + i: clean[i].encode(a).decode(b, "replace") for i, (a, b) in enumerate(chains)}
    broken[200] = "Ohne " + "Größe".encode("cp1252").decode("utf-8", "replace") + " geht es nicht."
    examples = {300: 'Sample string: "â€™" (a known symptom).', 301: "The reader prints � (U+FFFD) for bytes.", 302: "The Â-shaped glyph.", 303: 'Set it to "Привет" now.', 304: "café, naïve, Ångström, ÎNCHIDE"}
    df = spark.createDataFrame([*rows, *broken.items(), *examples.items(), (400, None), (401, "")], "doc_id bigint, text string")
    got = {r["doc_id"] for r in mojibake.find_garbled(df)[0].select("doc_id").distinct().collect()}
    assert got == set(broken)
    restored = {r["doc_id"]: r for r in mojibake.restore_garbled(df).collect()}
    assert restored[100]["restored"] == clean[0] and restored[102]["restored"] == clean[2] and restored[100]["unresolved"] == 0


def test_copies_of_a_garbled_page_are_found(spark):
    page = "Für die Größe müssen Sie über das Menü gehen."
    clean = [(i, f"{page} Seite {i}.") for i in range(5)]
    broken = [(100 + i, page.encode("cp1252").decode("mac_roman")) for i in range(20)]
    got = mojibake.find_garbled(spark.createDataFrame([*clean, *broken], "doc_id bigint, text string"))[0]
    assert {r["doc_id"] for r in got.select("doc_id").distinct().collect()} == {i for i, _ in broken}


def test_words_of_any_length_and_shape_are_garbled():
    triple = lambda w: w.encode("utf-8").decode("cp1252", "replace").encode("utf-8").decode("latin-1").encode("utf-8").decode("cp1252", "replace")
    for word in ("über", "Größenänderungsmodus", "GrößeÄndern"):
        assert triple(word) in mojibake.garbled_forms(word), word


def test_camel_case_words_with_foreign_signs_are_originals(spark):
    clean = [(i, f"Die Methode größeÄndern der Tabelle {i}.") for i in range(4)]
    broken = (100, "Die Methode " + "größeÄndern".encode().decode("cp437") + " der Tabelle.")
    got = mojibake.find_garbled(spark.createDataFrame([*clean, broken], "doc_id bigint, text string"))[0]
    assert {(r["doc_id"], r["original"]) for r in got.collect()} >= {(100, "größeÄndern")}


def test_every_chain_is_undone_by_its_table():
    for word in ("größer", "élève", "값을"):
        for form, chain in mojibake.garbled_forms(word).items():
            assert form != word and not form.isascii() and chain


def test_token_counts_are_the_tokenizer_s(spark):
    df = texts(spark, [(1, "Hello world", "x"), (2, None, "x"), (3, "", "x")])
    got = {r["id"]: r["n_tokens"] for r in tokens.token_sizes(df, "doc_id", "text").collect()}
    assert got == {1: len(tokens.encoder().encode_ordinary("Hello world")), 2: 0, 3: 0}


def test_samples_load(spark, data):
    assert samples(spark, data).count() > 0
