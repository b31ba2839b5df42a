"""Invented pages with the irregularities of real ones."""

from __future__ import annotations

import pytest

from loomline.operators import pages

HEAD = "source: image\ndomain: demo\ntask: t\nlanguage: en\nsource_filename: page_0007.jpeg\ndocument_name: guide-x\npage_number: 0007\npage_id: guide-x#page_7\nproduct: P\nversion: 1.2\ntimestamp: 2025-08-20T17:19:33Z\nfidelity: lossless"
BODY = "# Title\n\nText.\n\n```vb.net\nDim x\n```\n\n| a | b |\n|---|---|\n| 1 |\n\n- item\n1. first\n\n![pic](p.png)\n"
TAGS = "\n<!-- tags: [Alpha, Beta] keywords: [k] -->\n"

LAYOUTS = {
    "plain": f"<!--\n{HEAD}\n-->\n{BODY}{TAGS}",
    "wrapped": f"```html\n<!--\n{HEAD}\n-->\n{BODY}{TAGS}```",
    "glued": f"```html<!--\n{HEAD}\n--># Title\n{BODY}{TAGS}",
    "bad closer": f"<!--\n{HEAD}\n--}}\n{BODY}{TAGS}",
    "element": f"<html-comment>\n{HEAD}\n</html-comment>\n{BODY}{TAGS}",
    "fence": f"```comment\n{HEAD}\n```\n{BODY}{TAGS}",
    "comment a line": "\n".join(f"<!-- {x} -->" for x in HEAD.split("\n")) + f"\n{BODY}{TAGS}",
    "json": '{"source": "image", "page_id": "guide-x#page_7", "page_number": "0007", "document_name": "guide-x", "version": "1.2"}\n' + BODY + TAGS,
    "crlf": f"<!--\n{HEAD}\n-->\n{BODY}{TAGS}".replace("\n", "\r\n"),
}


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_header_in_every_layout(spark, layout):
    row = pages.header(frame(spark, LAYOUTS[layout])).first()
    assert (row["page_id"], row["page"], row["document_name"], row["version"]) == ("guide-x#page_7", 7, "guide-x", "1.2")


def test_pages_without_header(spark):
    for row in pages.header(frame(spark, BODY, "", None, "page_id:\nversion:   \n")).collect():
        assert row["page_id"] is None and row["page"] is None


def test_blocks_and_stats(spark):
    got = pages.block_stats(frame(spark, LAYOUTS["plain"], None, "```\nopen")).orderBy("doc_id").collect()
    assert tuple(got[0])[1:] == (1, 2, 3, 2, 1, False)
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, False)
    assert got[2]["unbalanced"]
    kinds = [r["kind"] for r in pages.blocks(frame(spark, BODY)).orderBy("line").collect()]
    assert kinds == ["heading", "fence", "fence", "table_row", "table_row", "table_row", "list_item", "list_item", "image"]


@pytest.mark.parametrize("comment", ["<!-- tags: [Alpha, Beta] -->", "<!-- tags: Alpha, Beta\nkeywords: k -->", "<!-- tags:\n  Alpha,\n  Beta\nkeywords:\n  k\n-->"])
def test_tags(spark, comment):
    assert {r["tag"] for r in pages.tags(frame(spark, BODY + comment)).collect()} == {"Alpha", "Beta"}


def test_fence_languages(spark):
    text = "```cs\n```\n```C#\n```\n```vb.NET\n```\n```python\n```\n```\n```"
    assert {r["language"]: r["n_fences"] for r in pages.fence_languages(frame(spark, text)).collect()} == {"csharp": 2, "vbnet": 1, "python": 1}


def test_normalised_headers(spark):
    schema = "page_id string, language string, document_name string, page_number string, version string, ts string"
    rows = [("a#1", "EN", "Guide X", "001", "1", "2025-08-20T17:19:33Z"), ("a#1", "EN", "Guide X", "001", "1", "2025-08-20T17:19:33Z"), (None, "en", "x", "1", "1", None), ("b#1", "en (as printed)", " ", "", None, "not a time")]
    got = {r["page_id"]: r for r in pages.normalised_headers(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"a#1", "b#1"} and got["a#1"]["document_name"] == "guide-x" and got["a#1"]["page"] == 1 and got["b#1"]["language"] == "en" and got["b#1"]["made_at"] is None
