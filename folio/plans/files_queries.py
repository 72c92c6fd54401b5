"""Registered queries: file listings and folders, OCR predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions.paths import levels, parts
from folio.operators import folders as FD
from folio.operators import ocr as O
from folio.operators import pages as PG
from folio.plans.corpus_queries import STEM_SQL
from folio.plans.registry import query
from folio.session import scratch_path
from folio.sources import fixtures as fx
from folio.sources.files import BUNDLE_SCHEMA, bundled_documents, decode
from folio.sources.ranges import bundled_pages, decode_ranges

ANCESTORS_SQL = """select doc_id, p, len(p) as n, unnest(range(1, len(p))) as k
from (select doc_id, string_split(path, chr(92)) as p from files)"""


@query(
    "has_subfolders",
    ("files",),
    "select array_to_string(p[1:k], chr(92)) as folder, bool_or(n - k > 1) as has_subfolders from anc group by 1",
    [("anc", ANCESTORS_SQL)],
)
def q_has_subfolders(spark, d):
    return FD.has_subfolders(fx.files(spark, d))


@query(
    "folder_tree",
    ("files",),
    """select folder, parent, cast(sum(f) as bigint) as n_files, count(distinct child) as n_dirs
from (select array_to_string(p[1:k], chr(92)) as folder,
             case when k > 1 then array_to_string(p[1:k - 1], chr(92)) end as parent,
             case when n - k = 1 then 1 else 0 end as f,
             case when n - k > 1 then p[k + 1] end as child
      from anc) a
group by folder, parent""",
    [("anc", ANCESTORS_SQL)],
)
def q_folder_tree(spark, d):
    return FD.folder_tree(fx.files(spark, d))


@query(
    "listing_order",
    ("files",),
    """select doc_id, path, row_number() over (order by lkey, path) - 1 as listing_no
from (select doc_id, path, string_agg(case when i = n then '0' else '1' end || part || chr(1), '' order by i) as lkey
      from (select doc_id, path, len(p) as n, unnest(p) as part, unnest(range(1, len(p) + 1)) as i
            from (select doc_id, path, string_split(path, chr(92)) as p from files) s) u
      where i >= 3 group by doc_id, path) k""",
)
def q_listing_order(spark, d):
    return FD.listing_order(fx.files(spark, d).drop("listing_no"))


@query(
    "union_listings",
    ("files",),
    "select doc_id, path from files union all select doc_id, path from files where len(string_split(path, chr(92))) >= 4",
)
def q_union_listings(spark, d):
    f = fx.files(spark, d).select("doc_id", "path")
    return FD.union_listings(f, f.where(F.size(parts("path")) >= 4))


LV_SQL = """select doc_id, path, listing_no,
       case when p[3] is not null and p[3] <> '' then replace(p[len(p)], '.pdf', '') end as lv3
from (select doc_id, path, listing_no, string_split(path, chr(92)) as p from files)"""


@query(
    "last_wins",
    ("files",),
    """select lv3 as title, arg_max(doc_id, listing_no) as doc_id, arg_max(path, listing_no) as path, max(listing_no) as listing_no
from lv group by lv3""",
    [("lv", LV_SQL)],
)
def q_last_wins(spark, d):
    f = fx.files(spark, d)
    t = f.select(levels("path")["lv3"].alias("title"), "doc_id", "path", "listing_no")
    return FD.last_wins(t, "title", "listing_no")


@query(
    "collisions",
    ("files",),
    f"""select kind, name, count(*) as n_files, min(path) as first_path, max(path) as last_path
from (select 'title' as kind, lv3 as name, path from lv
      union all select 'image' as kind, {STEM_SQL} as name, path from files) a
where name is not null group by kind, name having count(*) > 1""",
    [("lv", LV_SQL)],
)
def q_collisions(spark, d):
    return FD.collisions(fx.files(spark, d))


# ---------------------------------------------------------------- OCR predictions

@query(
    "annotation_layout",
    ("predictions",),
    """select image_id, idx, word, side, ann_index, 1.0e0 - cast(ann_index as double) / cast(n_side as double) as text_y,
       case when side = 'left' then -0.05e0 else 1.05e0 end as text_x,
       x0 / img_w as anchor_x, 1.0e0 - top / img_h as anchor_y,
       case when side = 'left' then 'right' else 'left' end as align
from (select *, row_number() over (partition by image_id, side order by miny, idx) - 1 as ann_index,
             count(*) over (partition by image_id, side) as n_side
      from (select *, case when least(x0, x1) < img_w / 2 then 'left' else 'right' end as side, least(top, bottom) as miny
            from predictions) a) b""",
)
def q_annotation_layout(spark, d):
    return O.annotation_layout(fx.predictions(spark, d))


@query("box_bounds", ("predictions",), "select image_id, idx, least(x0, x1) as min_x, least(top, bottom) as min_y from predictions")
def q_box_bounds(spark, d):
    return O.box_bounds(fx.predictions(spark, d))


@query("prediction_words", ("predictions",), "select image_id, idx, word from predictions")
def q_prediction_words(spark, d):
    return O.prediction_words(fx.predictions(spark, d))


@query(
    "flatten_boxes",
    ("predictions",),
    """select image_id, box_no, 0 as corner, x0 as x, top as y from nb union all
select image_id, box_no, 1, x1, top from nb union all
select image_id, box_no, 2, x1, bottom from nb union all
select image_id, box_no, 3, x0, bottom from nb""",
    [("nb", "select *, cast(row_number() over (partition by image_id order by idx) - 1 as int) as box_no from predictions")],
)
def q_flatten_boxes(spark, d):
    return O.flatten_boxes(fx.predictions(spark, d))


# ---------------------------------------------------------------- decoder seam

def _bundles(spark, d) -> str:
    """The documents written as files of many documents each, into the shared checkpoint folder."""
    base = scratch_path(spark, "decode-pages")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("page", "raw"))), lambda p: p["raw"])
    per_doc = fx.raw_pages(spark, d).groupBy("doc_id").agg(ordered.alias("pages"))
    per_doc.select(F.to_json(F.struct("doc_id", "pages")).alias("value")).write.option("maxRecordsPerFile", 1000).text(base)
    return base


@query("decode_pages", ("raw_pages",), "select doc_id, page, raw as page_text from raw_pages")
def q_decode_pages(spark, d):
    """J1 end to end: the documents are written as files of many documents each, then the files are decoded back into
    pages by a plug-in decoder running inside the cluster."""
    base = _bundles(spark, d)
    rows, _errors = decode(spark, base, bundled_documents, BUNDLE_SCHEMA, suffix=".txt")
    return rows.select("doc_id", "page", "page_text")


@query("decode_ranges", ("raw_pages",), "select doc_id, page, raw as page_text from raw_pages")
def q_decode_ranges(spark, d):
    """J1 on byte ranges: the same files, each decoded by several tasks."""
    rows, _errors = decode_ranges(spark, _bundles(spark, d), bundled_pages, BUNDLE_SCHEMA, suffix=".txt", split_bytes=1 << 17)
    return rows.select("doc_id", "page", "page_text")


@query("decode_selected_page", ("raw_pages",), "select doc_id, page, raw as page_text from raw_pages where page = 5")
def q_decode_selected_page(spark, d):
    """J1 with B5 in the decoder: the sixth page of each document, from byte ranges."""
    rows, _errors = decode_ranges(spark, _bundles(spark, d), bundled_pages, BUNDLE_SCHEMA, suffix=".txt", split_bytes=1 << 17, pages=[5])
    return PG.select_page(rows, 5).select("doc_id", "page", "page_text")
