"""Registered queries: text, pages, OCR text, markdown tables, page documents, corpus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from folio.functions import paths as P
from folio.functions import text as T
from folio.operators import assemble as A
from folio.operators import markdown as M
from folio.operators import ocr as O
from folio.operators import pages as PG
from folio.operators import sentences as S
from folio.operators import trigram_index as X
from folio.operators.numbering import ordinal
from folio.plans.registry import query
from folio.session import scratch_path, stored
from folio.sources import title_index as TI
from folio.sources import fixtures as fx

# ---------------------------------------------------------------- text

@query("clean_text", ("pages",), "select doc_id, page, replace(replace(replace(page_text, chr(10), ' '), '- ', ''), '  ', ' ') as text from pages")
def q_clean_text(spark, d):
    return fx.pages(spark, d).select("doc_id", "page", T.clean_text("page_text").alias("text"))


@query("clean_text_v2", ("pages",), "select doc_id, page, replace(replace(page_text, chr(10), ' '), '- ', '') as text from pages")
def q_clean_text_v2(spark, d):
    return fx.pages(spark, d).select("doc_id", "page", T.clean_text("page_text", squeeze=False).alias("text"))


@query("flatten_lines", ("pages",), "select doc_id, page, replace(raw, chr(10), ' ') as text from pages")
def q_flatten_lines(spark, d):
    return fx.pages(spark, d).select("doc_id", "page", T.flatten_lines("raw").alias("text"))


@query(
    "drop_boilerplate",
    ("pages_warn",),
    r"""select doc_id, page,
       regexp_replace(page_text, '(Evaluation\s+Warning\s+:\s+The\s+document\s+was\s+created\s+with\s+Spire\.XLS\s+for\s+Python)', '', 'g') as text
from pages_warn""",
)
def q_drop_boilerplate(spark, d):
    p = fx.pages_with_warning(spark, d)
    return p.select("doc_id", "page", T.drop_boilerplate("page_text", [fx.WARNING_SENTENCE]).alias("text"))


SEARCH_PATTERN = "ent[a-z]*ion"


@query(
    "search_pages",
    ("pages",),
    f"""select doc_id, page, cast(len(regexp_extract_all(page_text, '(?i){SEARCH_PATTERN}')) as bigint) as n_matches,
       regexp_extract(page_text, '(?i){SEARCH_PATTERN}', 0) as first_match
from pages where regexp_matches(page_text, '(?i){SEARCH_PATTERN}')""",
)
def q_search_pages(spark, d):
    hit, n, first = T.search("page_text", SEARCH_PATTERN, ignore_case=True)
    return fx.pages(spark, d).where(hit).select("doc_id", "page", n.cast("long").alias("n_matches"), first.alias("first_match"))


# patterns of the indexed search: a required word part, alternatives, a repeated group, and one that requires no trigram
INDEX_PATTERNS = [SEARCH_PATTERN, "(tion|ment|heit) (en|in|on)[a-z]+", "(ing|ver){2}", "[xyz][aeiou]{2}[xyz]"]


@query(
    "search_index",
    ("pages",),
    " union all ".join(
        f"""select '{p}' as pattern, doc_id, page, cast(len(regexp_extract_all(page_text, '(?i){p}')) as bigint) as n_matches,
       regexp_extract(page_text, '(?i){p}', 0) as first_match
from pages where regexp_matches(page_text, '(?i){p}')"""
        for p in INDEX_PATTERNS
    ),
)
def q_search_index(spark, d):
    """B11 by the trigram index: written once, then searched for several patterns."""
    path = scratch_path(spark, "trigrams")
    X.write_index(fx.pages(spark, d).select("doc_id", "page", "page_text"), path)
    found = [X.search_index(spark, path, p).select(F.lit(p).alias("pattern"), "doc_id", "page", "n_matches", "first_match") for p in INDEX_PATTERNS]
    return reduce(lambda a, b: a.unionByName(b), found)


SENTENCE_CTES = [
    (
        "sentences materialized",
        r"""select row_number() over (order by sentence) as sentence_no, sentence, string_split(sentence, ' ') as sw
from (select array_to_string(regexp_extract_all(txt, '\S+'), ' ') as sentence
      from (select doc_id, unnest(string_split(text, chr(10))) as txt from documents) t
      group by 1 having count(distinct doc_id) >= 2 and sentence like '% %') s""",
    ),
    ("worded materialized", r"select doc_id, page, page_text, regexp_extract_all(page_text, '\S+') as w, regexp_extract_all(page_text, '\s*\S+|\s+') as pieces from pages"),
    (
        "met materialized",
        """select p.doc_id, p.page, p.pos, s.sentence_no, len(s.sw) as n
from (select doc_id, page, w, unnest(range(len(w))) as pos from worded) p
join sentences s on p.w[pos + 1] = s.sw[1] and p.w[pos + 2] = s.sw[2] and list_slice(p.w, pos + 1, pos + len(s.sw)) = s.sw""",
    ),
    (
        "first_met materialized",
        "select doc_id, page, pos, arg_min(n, sentence_no) as n from met group by doc_id, page, pos",
    ),
    (
        "taken",
        """select doc_id, page, min(pos) as pos, arg_min(n, pos) as n from first_met group by doc_id, page
union all
select doc_id, page, pos, n
from (select m.doc_id, m.page, m.pos, m.n, row_number() over (partition by m.doc_id, m.page order by m.pos) as k
      from taken t join first_met m on m.doc_id = t.doc_id and m.page = t.page and m.pos >= t.pos + t.n) x where k = 1""",
    ),
    (
        "cleaned",
        r"""select doc_id, page, string_agg(piece, '' order by i) as text
from (select u.doc_id, u.page, u.i, case when t.pos = u.i then regexp_extract(u.piece, '^\s*') else u.piece end as piece
      from (select doc_id, page, unnest(pieces) as piece, unnest(range(len(pieces))) as i from worded) u
      left join taken t on t.doc_id = u.doc_id and t.page = u.page and u.i >= t.pos and u.i < t.pos + t.n
      where t.pos is null or t.pos = u.i) y group by doc_id, page""",
    ),
]


@query(
    "drop_sentences",
    ("pages",),
    """select w.doc_id, w.page, case when k.n is null then w.page_text else coalesce(c.text, '') end as text, coalesce(k.n, 0) as n_dropped
from worded w left join cleaned c on w.doc_id = c.doc_id and w.page = c.page
left join (select doc_id, page, count(*) as n from taken group by doc_id, page) k on w.doc_id = k.doc_id and w.page = k.page""",
    SENTENCE_CTES,
    recursive=True,
)
def q_drop_sentences(spark, d):
    """T4 for a table of sentences: the lines that two documents or more share, of at least two words."""
    lines = fx.table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("txt"))
    lines = lines.select("doc_id", F.array_join(S.words(F.col("txt")), " ").alias("sentence")).where(F.contains("sentence", F.lit(" ")))
    lines = lines.withColumn("_mark", F.xxhash64("sentence"))
    two = F.col("a") < F.col("b")
    both = lambda by: lines.groupBy(by).agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where(two)
    # numbers first: of the text, only lines that can be shared are shuffled
    marks = stored(both("_mark").select("_mark"), "shared-marks")
    lines = lines.join(F.broadcast(marks) if marks.count() <= S.BROADCAST_MARKS else marks, "_mark", "left_semi")
    shared = both("sentence").select("sentence")
    numbered = ordinal(stored(shared, "shared-lines"), [], ["sentence"], name="sentence_no", base=1)
    out = S.drop_sentences(fx.pages(spark, d).select("doc_id", "page", "page_text"), numbered)
    return out.select("doc_id", "page", F.col("page_text").alias("text"), F.size("dropped").cast("long").alias("n_dropped"))


# ---------------------------------------------------------------- paths

LEVELS_SQL = """select doc_id, path, p[2] as lv1,
       case when p[3] is not null and p[3] <> '' and p[3] <> p[len(p)] then p[3] end as lv2,
       case when p[3] is not null and p[3] <> '' then replace(p[len(p)], '.pdf', '') end as lv3
from (select doc_id, path, listing_no, string_split(path, chr(92)) as p from files)"""

STEM_SQL = r"""regexp_replace(split_part(string_split(path, chr(92))[-1], '.', 1), '^\s+|\s+$', '', 'g')"""


@query("extract_levels", ("files",), LEVELS_SQL)
def q_extract_levels(spark, d):
    f = fx.files(spark, d)
    lv = P.levels("path")
    return f.select("doc_id", "path", lv["lv1"].alias("lv1"), lv["lv2"].alias("lv2"), lv["lv3"].alias("lv3"))


@query("file_stem", ("files",), f"select doc_id, {STEM_SQL} as stem from files")
def q_file_stem(spark, d):
    return fx.files(spark, d).select("doc_id", P.file_stem("path").alias("stem"))


@query(
    "title_line",
    ("files",),
    """select l.doc_id, case when d.lang = 'en' then concat('This page explains ', coalesce(l.lv3, 'None'), '.')
            else concat('이 문서의 제목은 ', coalesce(l.lv3, 'None'), ' 입니다.') end as title_line
from levels l join documents d on l.doc_id = d.doc_id""",
    [("levels", LEVELS_SQL)],
)
def q_title_line(spark, d):
    f = fx.files(spark, d).join(fx.doc_lang(spark, d), "doc_id")
    return f.select("doc_id", T.title_line(P.levels("path")["lv3"], F.col("lang")).alias("title_line"))


@query(
    "page_metadata",
    ("files", "pages"),
    """select p.doc_id, p.page, l.lv1 as first_division, l.lv2 as second_division, l.lv3 as file_name, l.path as file_path
from pages p join levels l on p.doc_id = l.doc_id""",
    [("levels", LEVELS_SQL)],
)
def q_page_metadata(spark, d):
    f = fx.files(spark, d)
    lv = P.levels("path")
    meta = f.select(
        "doc_id", lv["lv1"].alias("first_division"), lv["lv2"].alias("second_division"), lv["lv3"].alias("file_name"), F.col("path").alias("file_path")
    )
    return fx.pages(spark, d).select("doc_id", "page").join(meta, "doc_id")


@query(
    "page_image_path",
    ("files", "pages"),
    f"""select p.doc_id, p.page, concat('images/', s.stem, '/', s.stem, '_', p.page, '.png') as image_path
from pages p join (select doc_id, {STEM_SQL} as stem from files) s on p.doc_id = s.doc_id""",
)
def q_page_image_path(spark, d):
    stems = fx.files(spark, d).select("doc_id", P.file_stem("path").alias("stem"))
    j = fx.pages(spark, d).select("doc_id", "page").join(stems, "doc_id")
    return j.select("doc_id", "page", P.page_image_path("stem", "page").alias("image_path"))


# ---------------------------------------------------------------- pages

@query("select_page", ("pages",), "select doc_id, page, width, height, page_text from pages where page = 5")
def q_select_page(spark, d):
    return PG.select_page(fx.pages(spark, d), 5).select("doc_id", "page", "width", "height", "page_text")


@query(
    "empty_pages",
    ("pages",),
    "select doc_id, page from pages where length(replace(replace(replace(page_text, chr(10), ' '), '- ', ''), '  ', ' ')) = 0",
)
def q_empty_pages(spark, d):
    return PG.empty_pages(fx.pages(spark, d))


@query("number_pages", ("pages",), "select doc_id, page, page + 1 as page_number from pages")
def q_number_pages(spark, d):
    return PG.number_pages(fx.pages(spark, d).select("doc_id", "page"), base=1)


@query("page_count", ("pages",), "select doc_id, count(*) as n_pages from pages group by doc_id")
def q_page_count(spark, d):
    return PG.page_count(fx.pages(spark, d))


@query(
    "pages_without_tables",
    ("pages", "cells"),
    "select doc_id, page from pages p where not exists (select 1 from cells c where c.doc_id = p.doc_id and c.page = p.page)",
)
def q_pages_without_tables(spark, d):
    return PG.pages_without_tables(fx.pages(spark, d), fx.cells(spark, d))


# ---------------------------------------------------------------- OCR text

OCR_TEXT_SQL = """select doc_id, page, coalesce(string_agg(txt, ' ' order by line_no), '') as ocr_text
from (select *, max(result_idx) over (partition by doc_id, page) as m from ocr_lines) t
where result_idx = m group by doc_id, page"""


@query("ocr_text", ("ocr_lines",), OCR_TEXT_SQL)
def q_ocr_text(spark, d):
    return O.ocr_text(fx.ocr_lines(spark, d))


@query(
    "ocr_batch",
    ("ocr_lines",),
    "select doc_id, page, ocr_text, row_number() over (partition by doc_id order by page) - 1 as image_no from ot",
    [("ot", OCR_TEXT_SQL)],
)
def q_ocr_batch(spark, d):
    return O.ocr_batch(fx.ocr_lines(spark, d))


CLEAN_SQL = "replace(replace(replace(page_text, chr(10), ' '), '- ', ''), '  ', ' ')"
FALLBACK_SQL = f"""select p.doc_id, p.page,
       case when length({CLEAN_SQL}) = 0 then coalesce(o.ocr_text, '') else {CLEAN_SQL} end as text
from pages p left join ot o on p.doc_id = o.doc_id and p.page = o.page"""


@query("ocr_fallback", ("pages", "ocr_lines"), FALLBACK_SQL, [("ot", OCR_TEXT_SQL)])
def q_ocr_fallback(spark, d):
    return O.page_texts(fx.pages(spark, d), fx.ocr_lines(spark, d))


# ---------------------------------------------------------------- markdown

ROWS_SQL = """select doc_id, page, table_no, row_no,
       concat('|', string_agg(coalesce(replace(txt, chr(10), ' '), 'None'), '|' order by col_no), '|') as md_row
from cells group by doc_id, page, table_no, row_no"""

TABLES_SQL = r"""select doc_id, page, table_no,
       concat(max(case when rn = 1 then md_row end), chr(10),
              regexp_replace(regexp_replace(max(case when rn = 1 then md_row end), '[^|]', '-', 'g'), '\|\|', '|-|'),
              coalesce(chr(10) || string_agg(md_row, chr(10) order by row_no) filter (where rn > 1), '')) as md
from (select *, row_number() over (partition by doc_id, page, table_no order by row_no) as rn from md_rows) r
group by doc_id, page, table_no"""


@query("markdown_tables", ("cells",), "select * from md_tables", [("md_rows", ROWS_SQL), ("md_tables", TABLES_SQL)])
def q_markdown_tables(spark, d):
    return M.markdown_tables(fx.cells(spark, d), together=True)


@query(
    "last_table",
    ("cells",),
    "select doc_id, page, arg_max(md, table_no) as md from md_tables group by doc_id, page",
    [("md_rows", ROWS_SQL), ("md_tables", TABLES_SQL)],
)
def q_last_table(spark, d):
    return M.markdown_tables(fx.cells(spark, d), keep="last", together=True)


HEADER_SQL = "select doc_id, page, table_no, arg_min(md_row, row_no) as header from md_rows group by doc_id, page, table_no"


@query(
    "header_separator",
    ("cells",),
    r"""select doc_id, page, table_no, header,
       regexp_replace(regexp_replace(header, '[^|]', '-', 'g'), '\|\|', '|-|') as separator from hdr""",
    [("md_rows", ROWS_SQL), ("hdr", HEADER_SQL)],
)
def q_header_separator(spark, d):
    h = M.header_rows(fx.cells(spark, d), together=True)
    return h.select("doc_id", "page", "table_no", "header", T.header_separator("header").alias("separator"))


@query(
    "header_separator_v1",
    ("cells",),
    "select doc_id, page, table_no, header, regexp_replace(header, '[^|]', '-', 'g') as separator from hdr",
    [("md_rows", ROWS_SQL), ("hdr", HEADER_SQL)],
)
def q_header_separator_v1(spark, d):
    h = M.header_rows(fx.cells(spark, d), together=True)
    return h.select("doc_id", "page", "table_no", "header", T.header_separator("header", repair=False).alias("separator"))


@query(
    "clean_cell",
    ("cells",),
    "select doc_id, page, table_no, row_no, col_no, coalesce(replace(txt, chr(10), ' '), 'None') as cell from cells",
)
def q_clean_cell(spark, d):
    c = fx.cells(spark, d)
    return c.select("doc_id", "page", "table_no", "row_no", "col_no", T.clean_cell("txt").alias("cell"))


# ---------------------------------------------------------------- page documents

def _title_sql(style: str) -> str:
    en = "concat('This page explains ', coalesce(l.lv3, 'None'), '.')" if style == "v3" else "concat('This page explains ', coalesce(l.lv3, 'None'))"
    return f"case when d.lang = 'en' then {en} else concat('이 문서의 제목은 ', coalesce(l.lv3, 'None'), ' 입니다.') end"


def _assemble_sql(style: str, text_sql: str) -> str:
    tail = "coalesce(chr(10) || chr(10) || t.md, '')"
    if style == "levels":
        return f"""select p.doc_id, p.page as page_number, concat({text_sql}, {tail}) as page_content,
       l.lv1, l.lv2, l.lv3, l.path as source
from pages p left join last_md t on p.doc_id = t.doc_id and p.page = t.page
join levels l on p.doc_id = l.doc_id"""
    gap = "chr(10)" if style == "v3" else "chr(10), chr(10)"
    return f"""select p.doc_id, p.page, concat({_title_sql(style)}, {gap}, {text_sql}, {tail}) as page_content,
       l.lv1 as first_division, l.lv2 as second_division, l.lv3 as file_name, l.path as file_path
from pages p left join last_md t on p.doc_id = t.doc_id and p.page = t.page
join levels l on p.doc_id = l.doc_id join documents d on d.doc_id = p.doc_id"""


ASSEMBLE_CTES = [
    ("levels", LEVELS_SQL),
    ("md_rows", ROWS_SQL),
    ("md_tables", TABLES_SQL),
    ("last_md", "select doc_id, page, arg_max(md, table_no) as md from md_tables group by doc_id, page"),
]


def _assemble(spark, d, style: str, text_col):
    files = fx.files(spark, d).join(fx.doc_lang(spark, d), "doc_id").select("doc_id", "path", "lang")
    texts = fx.pages(spark, d).select("doc_id", "page", text_col.alias("text"))
    tables = M.markdown_tables(fx.cells(spark, d), keep="last", together=True)
    out = A.assemble_pages(files, texts, tables, lang=F.col("lang"), style=style)
    return out.drop("lang")


@query("assemble_pages", ("files", "pages", "cells"), _assemble_sql("v3", CLEAN_SQL.replace("page_text", "p.page_text")), ASSEMBLE_CTES)
def q_assemble_pages(spark, d):
    return _assemble(spark, d, "v3", T.clean_text("page_text"))


@query(
    "assemble_pages_v2",
    ("files", "pages", "cells"),
    _assemble_sql("v2", "replace(replace(p.page_text, chr(10), ' '), '- ', '')"),
    ASSEMBLE_CTES,
)
def q_assemble_pages_v2(spark, d):
    return _assemble(spark, d, "v2", T.clean_text("page_text", squeeze=False))


@query("assemble_pages_levels", ("files", "pages", "cells"), _assemble_sql("levels", "p.page_text"), ASSEMBLE_CTES)
def q_assemble_pages_levels(spark, d):
    return _assemble(spark, d, "levels", F.col("page_text"))


CORPUS_CTES = ASSEMBLE_CTES + [
    ("ot", OCR_TEXT_SQL),
    ("texts", FALLBACK_SQL),
    ("pdfs", "select * from levels where ends_with(path, '.pdf') and doc_id in (select doc_id from pages)"),
    ("winners", "select lv3 as title, arg_max(doc_id, listing_no) as doc_id from pdfs group by lv3"),
    (
        "corpus",
        """select l.lv3 as title, x.page,
       concat('This page explains ', coalesce(l.lv3, 'None'), '.', chr(10), x.text, coalesce(chr(10) || chr(10) || t.md, '')) as page_content,
       l.lv1 as first_division, l.lv2 as second_division, l.lv3 as file_name, l.path as file_path
from texts x left join last_md t on x.doc_id = t.doc_id and x.page = t.page
join pdfs l on x.doc_id = l.doc_id
where x.doc_id in (select doc_id from winners)""",
    ),
]
CORPUS_CTES[0] = ("levels", LEVELS_SQL.replace("select doc_id, path, p[2]", "select doc_id, path, listing_no, p[2]"))


def _corpus(spark, d):
    return A.build_corpus(fx.files(spark, d), fx.pages(spark, d), fx.ocr_lines(spark, d), fx.cells(spark, d), lang="en")


@query("build_corpus", ("files", "pages", "ocr_lines", "cells"), "select * from corpus", CORPUS_CTES)
def q_build_corpus(spark, d):
    return _corpus(spark, d)


@query(
    "collect_docs",
    ("files", "pages", "ocr_lines", "cells"),
    "select title, count(*) as n_pages, string_agg(page_content, chr(12) order by page) as content from corpus group by title",
    CORPUS_CTES,
)
def q_collect_docs(spark, d):
    docs = A.collect_docs(_corpus(spark, d))
    return docs.select(
        "title", F.size("pages").cast("long").alias("n_pages"), F.array_join(F.transform("pages", lambda p: p["page_content"]), "\f").alias("content")
    )


SUMMARY_SQL = """select count(*) as n_docs, arg_min(title, first_no) as first_title
from (select lv3 as title, min(listing_no) as first_no from pdfs group by lv3)"""


@query("corpus_summary", ("files", "pages", "ocr_lines", "cells"), "select * from summary", CORPUS_CTES + [("summary", SUMMARY_SQL)])
def q_corpus_summary(spark, d):
    return A.corpus_summary(fx.files(spark, d), fx.pages(spark, d))


@query(
    "sample_page",
    ("files", "pages", "ocr_lines", "cells"),
    """select c.* from corpus c join summary s on c.title = s.first_title
where c.page = (select page from (select page, row_number() over (order by page) - 1 as pos
                                  from corpus where title = (select first_title from summary)) where pos = 5)""",
    CORPUS_CTES + [("summary", SUMMARY_SQL)],
)
def q_sample_page(spark, d):
    summary = A.corpus_summary(fx.files(spark, d), fx.pages(spark, d))
    return A.sample_page(_corpus(spark, d), summary, 5)


@query(
    "title_lookup",
    ("files", "pages", "ocr_lines", "cells"),
    "select c.* from corpus c join summary s on c.title = s.first_title",
    CORPUS_CTES + [("summary", SUMMARY_SQL)],
)
def q_title_lookup(spark, d):
    """The corpus laid out by title, then the page documents of its first title from the files that hold it."""
    path = scratch_path(spark, "by-title")
    TI.write_by_title(_corpus(spark, d), path)
    first = A.corpus_summary(fx.files(spark, d), fx.pages(spark, d)).first()["first_title"]
    return TI.read_titles(spark, path, [first])


@query(
    "nth_pages",
    ("files", "pages", "ocr_lines", "cells"),
    """select title, page, page_content, first_division, second_division, file_name, file_path
from (select *, row_number() over (partition by title order by page) - 1 as pos from corpus) c where pos = 5""",
    CORPUS_CTES,
)
def q_nth_pages(spark, d):
    """S3: the sixth page document of every title that has one."""
    return A.nth_pages(_corpus(spark, d), 5)


@query(
    "corpus_titles",
    ("files", "pages", "ocr_lines", "cells"),
    "select title, row_number() over (order by first_no) - 1 as title_no from (select lv3 as title, min(listing_no) as first_no from pdfs group by lv3) t",
    CORPUS_CTES,
)
def q_corpus_titles(spark, d):
    return A.corpus_titles(fx.files(spark, d), fx.pages(spark, d))


ALL_TABLES_CTES = [
    (n, "select doc_id, page, string_agg(md, chr(10) || chr(10) order by table_no) as md from md_tables group by doc_id, page")
    if n == "last_md"
    else (n, s)
    for n, s in CORPUS_CTES
]


@query("build_corpus_all_tables", ("files", "pages", "ocr_lines", "cells"), "select * from corpus", ALL_TABLES_CTES)
def q_build_corpus_all_tables(spark, d):
    """G4 with ``tables_kept='all'``: every table of a page, not only the last, joined by a blank line."""
    return A.build_corpus(fx.files(spark, d), fx.pages(spark, d), fx.ocr_lines(spark, d), fx.cells(spark, d), lang="en", tables_kept="all")
