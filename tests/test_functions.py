import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import answers, scalars
from tessera.operators import layout, pages


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_video_ids(spark):
    got = values(spark, scalars.is_video_id(F.col("x")), [("abcdefghijk",), ("a-_DEF45678",), ("https://a.b/watch?v=abcdefghijk",), ("invalid$id!",), ("abcdefghijk\n",), (None,)], "x string")
    assert got == [True, True, False, False, False, False]


def test_hub_ids(spark):
    cases = {
        "stanfordnlp/imdb": "stanfordnlp/imdb", " imdb ": "imdb", "https://huggingface.co/datasets/stanfordnlp/imdb": "stanfordnlp/imdb",
        "https://www.huggingface.co/datasets/a/b/tree/main?x=1#y": "a/b", "https://huggingface.co/datasets/imdb/tree/main": "imdb/tree", "https://example.com/datasets/a/b": None,
        "https://huggingface.co/stanfordnlp/imdb": None, "http://huggingface.co/datasets/a/b": None, "a/b/c": None, "-a": None, "huggingface.co/imdb": "huggingface.co/imdb", "https://huggingface.co/datasets/a%2Eb": "a.b", "": None,
    }
    got = values(spark, scalars.hub_dataset_id(F.col("x")), [(k,) for k in cases], "x string")
    assert dict(zip(cases, got, strict=True)) == cases


def test_png_header(spark):
    head = bytes.fromhex("89504E470D0A1A0A0000000D49484452") + (960).to_bytes(4, "big") + (720).to_bytes(4, "big")
    got = values(spark, scalars.png_size(F.col("x")), [(head,), (head[:20],), (b"x" + head[1:],), (head[:16] + bytes(8),)], "x binary")
    assert got[0].asDict() == {"width": 960, "height": 720} and got[1:] == [None] * 3


def test_bbox(spark):
    got = values(spark, scalars.bbox(F.col("x")), [(["1", "2.345", "3", "4"],), (["1", "2", "3"],), (["1", "2", "3", "wide"],), (None,), (["0.125", "0", "0", "0"],)], "x array<string>")
    assert got == [[1.0, 2.34, 3.0, 4.0], None, None, None, [0.12, 0.0, 0.0, 0.0]]


def test_geometry(spark):
    row = spark.range(1).select(
        scalars.downscaled(F.lit(2000), F.lit(1000), 1450).alias("a"), scalars.downscaled(F.lit(100), F.lit(1), 50).alias("b"), scalars.downscaled(F.lit(9), F.lit(9), 0).alias("c"),
        scalars.focal_length(F.lit(0), F.lit(3), F.lit(4)).alias("f"), scalars.srgb_linear(F.lit("#FF0080")).alias("s"), scalars.project(F.lit(1.0), F.lit(2.0), F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(0.0)).alias("p"), scalars.corners(1.0, 2.0).alias("k"), scalars.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("n"),
    ).first()
    assert tuple(row.a) == (1450, 725) and tuple(row.b) == (50, 1) and tuple(row.c) == (9, 9)
    assert row.f == 5.0 and row.s[0] == 1.0 and row.s[1] == 0.0 and math.isclose(row.s[2], ((128 / 255 + 0.055) / 1.055) ** 2.4) and row.s[3] == 1.0
    assert row.p.u is None and len(row.k) == 4 and row.n is None


def test_parameters():
    assert scalars.positive(1) == 1 and scalars.not_negative(0) == 0
    for bad in (0, -1):
        with pytest.raises(ValueError):
            scalars.positive(bad)
    with pytest.raises(ValueError):
        scalars.not_negative(-1)
    assert scalars.resolved(None, " m ", "d") == "m" and scalars.resolved("a", "m", "d") == "a" and scalars.resolved(None, "", "d") == "d"


def test_answers():
    items = answers.items
    assert items('Sure:\n```json\n[{"category": "Title", "bbox": [1, 2, 3, 4], "text": "x"}]\n```\n') == [{"category": "Title", "bbox": [1, 2, 3, 4], "text": "x"}]
    assert items('[{"text": "first"}, {"text": "sec') == [{"text": "first"}]
    assert items("a sentence") == [] and items(None) == [] and items("[]") == []
    assert items('{"layout": [{"a": 1}]}') == [{"a": 1}] and items('{"other": 1}') == []
    assert items('[1, {"a": 1}]') == [{"a": 1}]
    assert items('[{"a": 1}] and that is all') == [{"a": 1}]
    assert items('see [1] then [{"a": 1}]') == []  # a stray bracket defeats the parse
    assert items('```\n[1]\n``` and ```json\n[{"a": 1}]\n```') == []  # the first list counts
    assert items('[{"a": "]}\\""}, {"b": [1, {"c": 2}]}, 3, {"d": 4}') == [{"a": ']}"'}, {"b": [1, {"c": 2}]}]
    assert items('[{"a": 1}{"b": 2} x {"c": 3}') == [{"a": 1}, {"b": 2}] and items('[{"a": nope}, {"b": 2}') == []
    assert items("```JSON\n[]\n``` [{}") == []


def test_boxes():
    assert answers.box([1, "2.346", True, 4.999]) == [1.0, 2.35, 1.0, 5.0]
    assert answers.box([1, 2, 3]) is None and answers.box([1, 2, 3, "x"]) is None and answers.box([1, 2, 3, None]) is None and answers.box("1234") is None and answers.box([1, 2, 3, [4]]) is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.text(max_size=4), st.one_of(st.integers(), st.text(max_size=6)), max_size=3), max_size=4), st.integers(0, 200))
def test_salvage_finds_the_whole_objects(found, cut):
    text = json.dumps(found)
    got = answers.whole_objects(text[:cut])
    if cut >= len(text):
        assert got == found
    else:
        ends = [len(json.dumps(found[: k + 1])) - 1 for k in range(len(found))]
        assert got == found[: sum(cut >= e for e in ends)]


def test_blocks(spark):
    rows = [([{"category": " ", "bbox": [1.0, 2.0, 3.0], "text": None}, {"category": "Table", "bbox": [1.005, 2.0, 3.0, 4.0], "text": "<table></table>"}, {"category": "Odd", "bbox": None, "text": "7"}],)]
    got = values(spark, layout.blocks(F.col("x")), rows, f"x {answers.ITEM}")[0]
    assert [(b["index"], b.category, b.text_format, b.text) for b in got] == [(1, "Text", "markdown", ""), (2, "Table", "html", "<table></table>"), (3, "Odd", "markdown", "7")]
    assert got[0].bbox is None and got[2].bbox is None


def markdown(text):
    """A plain version of the rules, for comparison."""
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;").replace("'", "&#x27;")
    out, run, kind = [], [], None

    def close():
        if kind == "p":
            out.append("<p>" + esc(" ".join(run)) + "</p>")
        if kind == "ul":
            out.extend(["<ul>", *(f"<li>{esc(x)}</li>" for x in run), "</ul>"])

    for line in text.splitlines():
        s = line.strip()
        now = None if not s else "ul" if s[:2] in ("- ", "* ") else "p"
        if now != kind:
            close()
            run, kind = [], now
        if now:
            run.append(s[2:].strip() if now == "ul" else s)
    close()
    return "\n".join(out) or "<p></p>"


def test_markdown(spark):
    texts = ["a line\n- one\n* two", "", "-", "a\n\nb & <c> \"d\" 'e'\n", " - x \r\n\ty", "one\x0btwo\x85- three four", "- a\n\n- b", "\n\n"]
    assert values(spark, layout.markdown_to_html(F.col("x")), [(t,) for t in texts], "x string") == [markdown(t) for t in texts]


def test_fragments(spark):
    cases = [("Table", "<TABLE><tr></tr></TABLE>"), ("Table", "a < b"), ("Formula", "<script>"), ("Picture", "gone"), ("Caption", "c"), ("List-item", "- i")]
    got = values(spark, layout.block_to_html(F.lit(3), F.col("k"), F.col("t")), cases, "k string, t string")
    assert "<TABLE>" in got[0] and "block-table" in got[0] and "<p>a &lt; b</p>" in got[1] and "<code>&lt;script&gt;</code>" in got[2]
    assert "gone" not in got[3] and 'class="block caption"' in got[4] and "<li>i</li>" in got[5] and all("#3 " in g for g in got)


def test_page_specs(spark):
    cases = [("all", 4), ("1,3", 5), ("2-4", 5), ("1-2,2,5", 5), (" * ", 2), (None, 1), ("", 2), ("all", 0)]
    assert values(spark, pages.page_list(F.col("s"), F.col("n")), cases, "s string, n int") == [[1, 2, 3, 4], [1, 3], [2, 3, 4], [1, 2, 5], [1, 2], [1], [1, 2], []]
    bad = [("abc", 5), ("4-2", 5), ("9", 5), (",", 5), ("0", 5), ("1-", 5), ("1;2", 5), ("99999999999", 5)]
    assert values(spark, pages.page_list(F.col("s"), F.col("n")), bad, "s string, n int") == [None] * len(bad)


def test_names(spark):
    row = spark.createDataFrame([("/a.b/c.d.mp4",)], "p string").select(scalars.suffix("p"), scalars.output_name(F.col("p"), ".asr.json"), scalars.page_name(F.lit(7)), scalars.frame_name(F.lit(7))).first()
    assert tuple(row) == (".mp4", "/a.b/c.d.asr.json", "page-0007.png", "00000007.jpg")
    assert values(spark, scalars.suffix("p"), [("/a.b/c",), ("/a/.hidden",), ("x.PNG",)], "p string") == ["", "", ".png"]
