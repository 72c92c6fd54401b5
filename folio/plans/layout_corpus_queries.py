"""Registered queries: the whole job from words and rules (H3 -> H8 -> G4), with and without crop, and the sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import assemble as A
from folio.operators import raster as K
from folio.plans.corpus_queries import CORPUS_CTES
from folio.plans.layout_queries import EXTRACT_CTES, EXTRACT_SQL, _all_words, _cropped_ctes, page_text_sql
from folio.plans.registry import query
from folio.session import scratch_path
from folio.sources import corpus_io as IO
from folio.sources import fixtures as fx

FIXTURES = ("files", "pages", "ocr_lines", "words", "grid_words", "edges")


def _found_tables(ctes: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The extraction CTEs, then ``found_cells``, their table cells."""
    return [*ctes, ("found_cells", EXTRACT_SQL)]


def _corpus_ctes(ctes: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return _found_tables(ctes) + [(n, s.replace("from cells group", "from found_cells group")) for n, s in CORPUS_CTES]


def _corpus(spark, d, crop: bool):
    n = fx.parts(spark, d)
    return A.build_corpus_from_layout(fx.files(spark, d), fx.pages(spark, d), _all_words(spark, d, n), fx.edges(spark, d, n), fx.ocr_lines(spark, d), crop=crop)


@query("build_corpus_from_layout", FIXTURES, "select * from corpus", _corpus_ctes(EXTRACT_CTES), recursive=True)
def q_build_corpus_from_layout(spark, d):
    return _corpus(spark, d, crop=False)


@query("build_corpus_from_layout_cropped", FIXTURES, "select * from corpus", _corpus_ctes(_cropped_ctes()), recursive=True)
def q_build_corpus_from_layout_cropped(spark, d):
    return _corpus(spark, d, crop=True)


LAYOUT_SQL = """select p.doc_id, p.page as page_number, concat(coalesce(t.text, ''), coalesce(chr(10) || chr(10) || m.md, '')) as page_content,
       l.lv1, l.lv2, l.lv3, l.path as source
from pages p left join ptext t on p.doc_id = t.doc_id and p.page = t.page
left join last_md m on p.doc_id = m.doc_id and p.page = m.page
join levels l on p.doc_id = l.doc_id
where ends_with(l.path, '.pdf')"""


def _layout_ctes() -> list[tuple[str, str]]:
    # a document is cropped if the A4 box fits each of its pages; the rest keeps its rules and words
    kept = "select doc_id, bool_and(width >= 590 and height >= 770) as c from pages group by doc_id"
    out = [("fits", kept)]
    for name, sql in _cropped_ctes():
        if name == "edges_c":
            sql = f"""select * from ({sql}) x where doc_id in (select doc_id from fits where c)
union all select doc_id, page, orient, pos, lo, hi from edges where doc_id not in (select doc_id from fits where c)"""
        if name == "allw":
            whole = "select doc_id, page, word_no, word, x0, x1, top, bottom from words union all select doc_id, page, -1, word, x0, x1, top, bottom from grid_words"
            sql = f"""select * from ({sql}) x where doc_id in (select doc_id from fits where c)
union all select * from ({whole}) y where doc_id not in (select doc_id from fits where c)"""
        out.append((name, sql))
    out = _found_tables(out)
    out += [(n, s.replace("from cells group", "from found_cells group")) for n, s in CORPUS_CTES if n in ("levels", "md_rows", "md_tables", "last_md")]
    return [*out, ("ptext", page_text_sql("allw", "doc_id, page"))]


@query("layout_pages", ("files", "pages", "words", "grid_words", "edges"), LAYOUT_SQL, _layout_ctes(), recursive=True)
def q_layout_pages(spark, d):
    """The older converter: words and tables cropped, documents that the box does not fit uncropped."""
    n = fx.parts(spark, d)
    return A.layout_pages(fx.files(spark, d), fx.pages(spark, d), _all_words(spark, d, n), fx.edges(spark, d, n))


@query("read_docs", ("files", "pages", "ocr_lines", "cells"), "select * from corpus", CORPUS_CTES)
def q_read_docs(spark, d):
    """A6 then A7: the corpus written to the shared folder, partitioned by its first division, and loaded again."""
    path = scratch_path(spark, "docs")
    docs = A.build_corpus(fx.files(spark, d), fx.pages(spark, d), fx.ocr_lines(spark, d), fx.cells(spark, d), lang="en")
    IO.write_docs(docs, path)
    return IO.read_docs(spark, path)


@query("read_older_snapshot", ("files", "pages", "ocr_lines", "cells"), "select * from corpus", CORPUS_CTES)
def q_read_older_snapshot(spark, d):
    """A6 with snapshots: the corpus is written, then replaced by what was read from itself with upper-case contents; the older one is read."""
    path = scratch_path(spark, "snapshots")
    docs = A.build_corpus(fx.files(spark, d), fx.pages(spark, d), fx.ocr_lines(spark, d), fx.cells(spark, d), lang="en")
    first = IO.write_docs(docs, path)
    IO.write_docs(IO.read_docs(spark, path).withColumn("page_content", F.upper("page_content")), path)
    return IO.read_docs(spark, path, snapshot=first)


@query(
    "written_regions",
    ("pixels", "pixel_regions"),
    """select image_id, 'ROI_0.jpg' as name, max(ry) + 1 as h, max(rx) + 1 as w, string_agg(cast(v as varchar), ',' order by ry, rx) as pixels
from (select p.image_id, p.y - r.y as ry, p.x - r.x as rx, p.v
      from pixels p join pixel_regions r on p.image_id = r.image_id
      where p.y >= r.y and p.y < r.y + r.h and p.x >= r.x and p.x < r.x + r.w) c
group by image_id""",
)
def q_written_regions(spark, d):
    """C6 then A8: the pixels cut out for each region, written under the region's file name, and loaded again."""
    path = scratch_path(spark, "regions")
    regions = fx.pixel_regions(spark, d).withColumn("roi", F.lit(0))
    IO.write_regions(IO.region_crops(K.region_pixels(fx.pixels(spark, d), regions, region_cols=("roi",))), path)
    back = spark.read.parquet(path)
    return back.select("image_id", "name", F.col("h").cast("long"), F.col("w").cast("long"), F.array_join(F.col("pixels").cast("array<string>"), ",").alias("pixels"))
