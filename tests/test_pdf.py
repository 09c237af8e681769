"""Page counts and pages of generated PDFs: plain, compressed, updated, deep and broken."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.plans import fixtures
from tessera.sources import pdf
from tessera.sources.ranged import Broken, Bytes


def count(data):
    return pdf.count(Bytes.of(data))


@pytest.mark.parametrize("compressed", [False, True])
@pytest.mark.parametrize(("pages", "fan"), [(0, 5), (1, 5), (9, 9), (10, 9), (257, 2), (1000, 10)])
def test_counts(compressed, pages, fan):
    assert count(fixtures.pdf(pages, fan, compressed)) == pages


@pytest.mark.parametrize("compressed", [False, True])
def test_updates_replace_objects(compressed):
    page = b"<< /Type /Page >>"
    doc = fixtures.Pdf(compressed).update({1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Count 1 /Kids [3 0 R] >>", 3: page})
    assert count(bytes(doc.data)) == 1
    doc.update({2: b"<< /Type /Pages /Count 99 /Kids [3 0 R 10 0 R 11 0 R] >>", 10: page, 11: page})
    assert count(bytes(doc.data)) == 3  # whatever the node says
    doc.compressed = not compressed  # sections of both kinds
    doc.update({11: b"<< /Type /Pages /Kids [20 0 R 21 0 R] >>", 20: page, 21: page})
    assert count(bytes(doc.data)) == 4


def test_syntax():
    whole = rb"""<< /A [1 -2.5 +3 .5 (a \) (nested) string) <48 65> /Name true null 4 0 R 5] % a comment
      /B<</C(x)>>/D 7 0 R /E 8 >> tail"""
    value, end = pdf.parse(whole)
    assert value[b"/A"][:5] == [1, -2.5, 3, 0.5, rb"a \) (nested) string"] and value[b"/A"][6:] == [b"/Name", True, None, pdf.Ref(4), 5]
    assert value[b"/B"] == {b"/C": b"x"} and value[b"/D"] == pdf.Ref(7) and value[b"/E"] == 8 and whole[end:] == b" tail"
    for k in range(1, end - 1):
        with pytest.raises(Broken):
            pdf.parse(whole[:k])


@pytest.mark.parametrize("kind", range(5))
def test_predictors(kind):
    rng = random.Random(kind)
    rows, columns = [bytes(rng.randrange(256) for _ in range(9)) for _ in range(6)], 9
    coded, above = b"", bytes(columns)
    for row in rows:
        out = bytearray()
        for i, x in enumerate(row):
            a, b, c = row[i - 1] if i else 0, above[i], above[i - 1] if i else 0
            p = a + b - c
            best = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            out.append((x - (0, a, b, (a + b) // 2, best)[kind]) % 256)
        coded += bytes([kind]) + bytes(out)
        above = row
    assert pdf.unpredicted(coded, columns) == b"".join(rows)


def test_few_bytes_are_read_of_a_large_file():
    whole, read = fixtures.pdf(20, filler=30_000_000), []
    assert pdf.count(Bytes(len(whole), lambda at, n: read.append(n) or whole[at : at + n])) == 20 and sum(read) < 300_000


@pytest.mark.parametrize("compressed", [False, True])
def test_broken_files_are_errors_and_never_crash(compressed):
    whole, rng = fixtures.pdf(12, 4, compressed), random.Random(2)
    for end in range(0, len(whole) - 20, 7):
        with pytest.raises(Broken):
            count(whole[:end])
    for _ in range(300):
        data = bytearray(whole)
        for _ in range(rng.randint(1, 5)):
            data[rng.randrange(len(data))] = rng.randrange(256)
        try:
            assert count(bytes(data)) >= 0
        except Broken:
            pass
    circle = fixtures.Pdf().update({1: b"<< /Pages 2 0 R >>", 2: b"<< /Kids [3 0 R] >>", 3: b"<< /Kids [2 0 R] >>"})
    with pytest.raises(Broken, match="circle"):
        count(bytes(circle.data))
    with pytest.raises(Broken, match="isn't there"):
        count(bytes(fixtures.Pdf().update({1: b"<< /Pages 9 0 R >>"}).data))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("pdfs")
    (root / "sub").mkdir()
    (root / "a.pdf").write_bytes(fixtures.pdf(5))
    (root / "sub/long.pdf").write_bytes(fixtures.pdf(700, 8, True))
    (root / "notes.txt").write_text("not a PDF")
    return root


def test_counts_of_files(spark, folder):
    rows = [(str(folder / n),) for n in ("a.pdf", "sub/long.pdf", "notes.txt", "none.pdf")]
    got = {r.path.rsplit("/", 1)[-1]: r for r in pdf.page_counts(spark.createDataFrame(rows, "path string")).collect()}
    assert (got["a.pdf"].pages, got["long.pdf"].pages, got["notes.txt"].pages, got["none.pdf"].pages) == (5, 700, None, None)
    assert got["notes.txt"].error and got["none.pdf"].error and got["a.pdf"].error is None
    assert pdf.page_counts(spark.createDataFrame([], "path string")).count() == 0


def test_pages_as_rows(spark, folder):
    df = pdf.read_pages(spark, str(folder), dpi=144, max_side=1000)
    rows = {(r.doc_id.rsplit("/", 1)[-1], r.page): r for r in df.collect()}
    assert len(rows) == 705 and {p for d, p in rows if d == "a.pdf"} == {1, 2, 3, 4, 5}
    odd, even = rows["a.pdf", 3], rows["a.pdf", 2]
    assert (odd.width_pt, odd.height_pt) == (612, 792) and (even.width_pt, even.height_pt) == (612, 794)
    assert max(odd.pixel_width, odd.pixel_height) == 1000 and odd.pixel_width == round(1224 * 1000 / 1584)
    assert rows["long.pdf", 700].height_pt == 792 + 700


def test_filters_decide_what_is_planned(spark, folder):
    """The reader plans the wanted pages only, a long document over many partitions."""
    reader = pdf.PagesReader({"path": str(folder), "pages_per_task": "50"})
    assert len(reader.partitions()) == 1 + 14
    reader = pdf.PagesReader({"path": str(folder), "pages_per_task": "50"})
    rest = list(reader.pushFilters([pdf.GreaterThan(("page",), 690), pdf.LessThanOrEqual(("page",), 695), pdf.EqualTo(("rotation",), 0)]))
    assert [type(f) for f in rest] == [pdf.EqualTo] and [(p.first, p.last) for p in reader.partitions()] == [(691, 695)]
    reader = pdf.PagesReader({"path": str(folder)})
    assert not list(reader.pushFilters([pdf.In(("page",), (2, 3, 5, 9, 9999))]))
    ranges = sorted((p.path.rsplit("/", 1)[-1], p.first, p.last) for p in reader.partitions())
    assert ranges == [("a.pdf", 2, 3), ("a.pdf", 5, 5), ("long.pdf", 2, 3), ("long.pdf", 5, 5), ("long.pdf", 9, 9)]
    df = pdf.read_pages(spark, str(folder)).where((F.col("page") >= 3) & (F.col("page") < 6) & F.col("doc_id").endswith("long.pdf"))
    assert sorted(r.page for r in df.collect()) == [3, 4, 5]
    one = pdf.read_pages(spark, str(folder), pages_per_task=50).where("page = 650")
    assert one.rdd.getNumPartitions() == 1 and [r.page for r in one.collect()] == [650]
    assert pdf.read_pages(spark, str(folder), pages_per_task=50).rdd.getNumPartitions() == 15


def test_selected_pages_of_files(spark, folder):
    from tessera.sources import media

    one = spark.createDataFrame([(str(folder / "a.pdf"),)], "path string")
    assert [(r.page, r.image) for r in media.pdf_pages(one, spec="2,4-5").collect()] == [(2, "page-0002.png"), (4, "page-0004.png"), (5, "page-0005.png")]
    with pytest.raises(Exception, match="notes.txt"):
        media.pdf_pages(spark.createDataFrame([(str(folder / "notes.txt"),)], "path string")).collect()
