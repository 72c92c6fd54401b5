"""Registered queries: page geometry, text lines, columns, ruled tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import layout as L
from folio.operators import ruling as R
from folio.plans.registry import query
from folio.sources import fixtures as fx

WORD_COLS = ["doc_id", "page", "word_no", "word", "x0", "x1", "top", "bottom"]


def page_text_sql(src: str, keys: str, name: str = "text") -> str:
    """DuckDB: words of ``src`` -> one text per ``keys`` (lines by top within 3, words by x0)."""
    return f"""select {keys}, string_agg(line, chr(10) order by line_no) as {name}
from (select {keys}, line_no, string_agg(word, ' ' order by x0, word_no, word) as line
      from (select *, sum(case when prev is null or top - prev > 3 then 1 else 0 end)
                        over (partition by {keys} order by top) - 1 as line_no
            from (select *, lag(top) over (partition by {keys} order by top) as prev from {src}) a) b
      group by {keys}, line_no) c
group by {keys}"""


# ---------------------------------------------------------------- crop / bbox / scale

@query(
    "crop_page",
    ("words",),
    """select doc_id, page, word_no, word, greatest(x0, 3.0e0) as x0, least(x1, 590.0e0) as x1,
       greatest(top, 70.0e0) as top, least(bottom, 770.0e0) as bottom
from words
where least(x1, 590.0e0) - greatest(x0, 3.0e0) >= 0 and least(bottom, 770.0e0) - greatest(top, 70.0e0) >= 0
  and (least(x1, 590.0e0) - greatest(x0, 3.0e0)) + (least(bottom, 770.0e0) - greatest(top, 70.0e0)) > 0""",
)
def q_crop_page(spark, d):
    return L.crop(fx.words(spark, d)).select(*WORD_COLS)


@query("within_bbox", ("words",), "select * from words where x0 >= 3 and x1 <= 590 and top >= 70 and bottom <= 770")
def q_within_bbox(spark, d):
    return L.within_bbox(fx.words(spark, d)).select(*WORD_COLS)


@query(
    "crop_or_whole",
    ("words", "pages"),
    """select w.doc_id, w.page, w.word_no, w.word,
       case when f.cropped then greatest(x0, 3.0e0) else x0 end as x0,
       case when f.cropped then least(x1, 590.0e0) else x1 end as x1,
       case when f.cropped then greatest(top, 70.0e0) else top end as top,
       case when f.cropped then least(bottom, 770.0e0) else bottom end as bottom,
       f.cropped
from words w join (select doc_id, bool_and(590 <= width and 770 <= height) as cropped from pages group by doc_id) f
  on w.doc_id = f.doc_id
where not f.cropped or (least(x1, 590.0e0) - greatest(x0, 3.0e0) >= 0 and least(bottom, 770.0e0) - greatest(top, 70.0e0) >= 0
  and (least(x1, 590.0e0) - greatest(x0, 3.0e0)) + (least(bottom, 770.0e0) - greatest(top, 70.0e0)) > 0)""",
)
def q_crop_or_whole(spark, d):
    return L.crop_or_whole(fx.words(spark, d), fx.pages(spark, d)).select(*WORD_COLS, "cropped")


@query(
    "rescale_pages",
    ("words", "pages"),
    """select w.doc_id, w.page, w.word_no, w.word, x0 * s as x0, x1 * s as x1, top * s as top, bottom * s as bottom, s as scale
from words w join (select doc_id, page, least(842.0e0 / width, 1191.0e0 / height) as s from pages) p
  on w.doc_id = p.doc_id and w.page = p.page""",
)
def q_rescale_pages(spark, d):
    return L.rescale_pages(fx.words(spark, d), fx.pages(spark, d)).select(*WORD_COLS, "scale")


# ---------------------------------------------------------------- histogram / columns

@query(
    "x_histogram",
    ("words",),
    "select doc_id, page, cast(floor(x0 / 2) * 2 as bigint) as bin, count(*) as n from words group by doc_id, page, floor(x0 / 2) * 2",
)
def q_x_histogram(spark, d):
    return L.x_histogram(fx.words(spark, d))


COLUMN_THRESHOLD = 12  # the fixture's pages hold ~200 words; see FIXTURES.md


@query(
    "detect_columns",
    ("words", "pages"),
    f"""select p.doc_id, p.page + 1 as page_number, coalesce(c.n, 0) as n_clusters, coalesce(c.n, 0) > 1 as multi_column,
       case when coalesce(c.n, 0) > 1
            then concat('Page ', p.page + 1, ': Detected a multi-column layout ', coalesce(c.n, 0), '.')
            else concat('Page ', p.page + 1, ': Single-column layout detected. ', coalesce(c.n, 0)) end as report
from pages p left join (
  select doc_id, page, count(*) filter (where n > {COLUMN_THRESHOLD}) as n
  from (select doc_id, page, floor(x0 / 2) as b, count(*) as n from words group by doc_id, page, floor(x0 / 2)) h
  group by doc_id, page) c on p.doc_id = c.doc_id and p.page = c.page""",
)
def q_detect_columns(spark, d):
    return L.detect_columns(fx.words(spark, d), fx.pages(spark, d), threshold=COLUMN_THRESHOLD)


# ---------------------------------------------------------------- text lines (E5, H6)

@query(
    "page_lines",
    ("words",),
    """select doc_id, page, cast(line_no as bigint) as line_no, string_agg(word, ' ' order by x0, word_no, word) as line
from (select *, sum(case when prev is null or top - prev > 3 then 1 else 0 end)
                  over (partition by doc_id, page order by top) - 1 as line_no
      from (select *, lag(top) over (partition by doc_id, page order by top) as prev from words) a) b
group by doc_id, page, line_no""",
)
def q_page_lines(spark, d):
    return L.page_lines(fx.words(spark, d))


@query("page_text", ("words",), page_text_sql("words", "doc_id, page"))
def q_page_text(spark, d):
    return L.page_text(fx.words(spark, d))


@query(
    "split_columns",
    ("words", "pages"),
    "select p.doc_id, p.page, coalesce(l.text, '') as left_text, coalesce(r.text, '') as right_text "
    "from pages p left join lt l on p.doc_id = l.doc_id and p.page = l.page left join rt r on p.doc_id = r.doc_id and p.page = r.page",
    [
        (
            "sided",
            """select w.*, case when x0 >= 0 and x1 <= p.width / 2 and top >= 0 and bottom <= p.height then 'left'
                             when x0 >= p.width / 2 and x1 <= p.width and top >= 0 and bottom <= p.height then 'right' end as side
from words w join pages p on w.doc_id = p.doc_id and w.page = p.page""",
        ),
        ("lw", "select * from sided where side = 'left'"),
        ("rw", "select * from sided where side = 'right'"),
        ("lt", page_text_sql("lw", "doc_id, page")),
        ("rt", page_text_sql("rw", "doc_id, page")),
    ],
)
def q_split_columns(spark, d):
    return L.split_columns(fx.words(spark, d, by=("doc_id", "page")), fx.pages(spark, d))


VERTICAL_TEXT_SQL = """select doc_id, page, 'v' as orient, anchor, min(v) as pos, min(top) as lo, max(bottom) as hi
from (select *, sum(case when prev is null or v - prev > 3 then 1 else 0 end)
                  over (partition by doc_id, page, anchor order by v) as cl
      from (select *, lag(v) over (partition by doc_id, page, anchor order by v) as prev
            from (select doc_id, page, top, bottom, 'x0' as anchor, x0 as v from words
                  union all select doc_id, page, top, bottom, 'x1', x1 from words
                  union all select doc_id, page, top, bottom, 'center', (x0 + x1) / 2 from words) a) b) c
group by doc_id, page, anchor, cl having count(*) >= 3"""

HORIZONTAL_TEXT_SQL = """select doc_id, page, 'h' as orient, 'top' as anchor, min(top) as pos, min(x0) as lo, max(x1) as hi
from (select *, sum(case when prev is null or top - prev > 3 then 1 else 0 end)
                  over (partition by doc_id, page order by top) as cl
      from (select *, lag(top) over (partition by doc_id, page order by top) as prev from words) a) b
group by doc_id, page, cl having count(*) >= 1"""


@query("edges_from_words", ("words",), VERTICAL_TEXT_SQL + "\nunion all\n" + HORIZONTAL_TEXT_SQL)
def q_edges_from_words(spark, d):
    return L.edges_from_words(fx.words(spark, d))


# ---------------------------------------------------------------- ruled tables

SNAP_SQL = """select doc_id, page, orient, round(avg(pos) over (partition by doc_id, page, orient, grp), 6) as pos, lo, hi
from (select *, sum(case when prev is null or pos - prev > 3 then 1 else 0 end)
                  over (partition by doc_id, page, orient order by pos) as grp
      from (select *, lag(pos) over (partition by doc_id, page, orient order by pos) as prev from edges) a) b"""

JOIN_SQL = """select doc_id, page, orient, pos, min(lo) as lo, max(hi) as hi
from (select *, sum(case when reach is null or lo > reach + 3 then 1 else 0 end)
                  over (partition by doc_id, page, orient, pos order by lo) as grp
      from (select *, max(hi) over (partition by doc_id, page, orient, pos order by lo, hi
                                    rows between unbounded preceding and 1 preceding) as reach from snapped) a) b
group by doc_id, page, orient, pos, grp"""

PTS_SQL = """select v.doc_id, v.page, v.pos as x, h.pos as y, v.lo as v_lo, v.hi as v_hi, h.lo as h_lo, h.hi as h_hi
from clean v join clean h on v.doc_id = h.doc_id and v.page = h.page
where v.orient = 'v' and h.orient = 'h' and v.lo <= h.pos + 3 and v.hi >= h.pos - 3
  and v.pos >= h.lo - 3 and v.pos <= h.hi + 3"""

CELLS_SQL = """select doc_id, page, x as x0, y as top, x2 as x1, y2 as bottom
from (select *, row_number() over (partition by doc_id, page, x, y order by y2, x2) as rn
      from (select d.doc_id, d.page, d.x, d.y, r.x2, d.y2
            from down d join rgt r on d.doc_id = r.doc_id and d.page = r.page and d.x = r.x and d.y = r.y
            where exists (select 1 from down cd where cd.doc_id = d.doc_id and cd.page = d.page
                            and cd.x = r.x2 and cd.y = d.y and cd.y2 = d.y2)
              and exists (select 1 from rgt bd where bd.doc_id = d.doc_id and bd.page = d.page
                            and bd.x = d.x and bd.y = d.y2 and bd.x2 = r.x2)) c) r
where rn = 1"""

RULE_CTES = [
    ("snapped", SNAP_SQL),
    ("clean", f"select * from ({JOIN_SQL}) j where hi - lo >= 3"),  # the joined edges must also be long enough
    ("pts", PTS_SQL),
    ("vp", "select distinct doc_id, page, x, y, v_lo from pts"),
    ("hp", "select distinct doc_id, page, x, y, h_lo from pts"),
    (
        "down",
        """select distinct a.doc_id, a.page, a.x, a.y, b.y as y2 from vp a join vp b
  on a.doc_id = b.doc_id and a.page = b.page and a.x = b.x and a.v_lo = b.v_lo and b.y > a.y""",
    ),
    (
        "rgt",
        """select distinct a.doc_id, a.page, a.x, a.y, c.x as x2 from hp a join hp c
  on a.doc_id = c.doc_id and a.page = c.page and a.y = c.y and a.h_lo = c.h_lo and c.x > a.x""",
    ),
    ("cells_found", CELLS_SQL),
]

GROUP_CTES = RULE_CTES + [
    ("cid", "select *, row_number() over (order by doc_id, page, top, x0) as id from cells_found"),
    (
        "corners",
        """select id, doc_id, page, x0 as cx, top as cy from cid union all
select id, doc_id, page, x1, top from cid union all
select id, doc_id, page, x0, bottom from cid union all
select id, doc_id, page, x1, bottom from cid""",
    ),
    (
        "adj",
        """select distinct a.id as a, b.id as b from corners a join corners b
  on a.doc_id = b.doc_id and a.page = b.page and a.cx = b.cx and a.cy = b.cy and a.id <> b.id""",
    ),
    (
        "cc(id, lab) using key (id)",
        """select id, id from cid
union
select u.b as id, min(c.lab) as lab
from cc c join adj u on c.id = u.a join recurring.cc r on r.id = u.b
group by u.b, r.lab having min(c.lab) < r.lab""",
    ),
    (
        "tcells",
        """select c.doc_id, c.page, cast(dense_rank() over (partition by c.doc_id, c.page order by k.lab) - 1 as int) as table_no,
       c.x0, c.top, c.x1, c.bottom
from cid c join cc k on c.id = k.id""",
    ),
]

GRID_WORDS_SQL = """select doc_id, page, word_no, word, x0, x1, top, bottom from words
union all
select doc_id, page, -1 as word_no, word, x0, x1, top, bottom from grid_words"""


def _all_words(spark, d, n):
    """All words by document, in ``n`` parts: a union of tables that lie alike lies so too."""
    g = fx.grid_words(spark, d, n).select("doc_id", "page", F.lit(-1).alias("word_no"), "word", "x0", "x1", "top", "bottom")
    return fx.words(spark, d, n=n).select(*WORD_COLS).unionByName(g)


@query("snap_edges", ("edges",), SNAP_SQL)
def q_snap_edges(spark, d):
    return R.snap_edges(fx.edges(spark, d))


@query("join_edges", ("edges",), JOIN_SQL, [("snapped", SNAP_SQL)])
def q_join_edges(spark, d):
    return R.join_edges(R.snap_edges(fx.edges(spark, d)))


@query(
    "explicit_lines",
    ("edges", "pages"),
    """select doc_id, page, orient, pos, lo, hi from edges
union all select doc_id, page, 'v', 30.0e0, 0.0e0, height from pages
union all select doc_id, page, 'h', 20.0e0, 0.0e0, width from pages""",
)
def q_explicit_lines(spark, d):
    return R.explicit_lines(fx.edges(spark, d), fx.pages(spark, d), vertical=(30.0,), horizontal=(20.0,))


# one equality join, of verticals with their page's list of horizontals: no choice of join by ranges for the engine
MEETING_CTES = [
    RULE_CTES[0],
    ("clean materialized", RULE_CTES[1][1]),
    ("verticals materialized", "select doc_id, page, pos as x, lo as v_lo, hi as v_hi from clean where orient = 'v'"),
    ("horizontals materialized", "select doc_id, page, list({'y': pos, 'lo': lo, 'hi': hi}) as hs from clean where orient = 'h' group by doc_id, page"),
]
MEETING_SQL = """select doc_id, page, x, h.y as y, v_lo, v_hi, h.lo as h_lo, h.hi as h_hi
from (select v.*, unnest(list_filter(p.hs, lambda e: v.v_lo <= e.y + 3 and v.v_hi >= e.y - 3 and v.x >= e.lo - 3 and v.x <= e.hi + 3)) as h
      from verticals v join horizontals p on v.doc_id = p.doc_id and v.page = p.page) m"""


@query("edge_intersections", ("edges",), MEETING_SQL, MEETING_CTES)
def q_edge_intersections(spark, d):
    return R.edge_intersections(R.clean_edges(fx.edges(spark, d)))


@query("find_cells", ("edges",), "select * from cells_found", RULE_CTES)
def q_find_cells(spark, d):
    return R.find_cells(fx.edges(spark, d))


@query("group_cells", ("edges",), "select * from tcells", GROUP_CTES, recursive=True)
def q_group_cells(spark, d):
    return R.group_cells(R.find_cells(fx.edges(spark, d)), together=True).select("doc_id", "page", "table_no", "x0", "top", "x1", "bottom")


@query(
    "table_boxes",
    ("edges",),
    "select doc_id, page, table_no, min(x0) as x0, min(top) as top, max(x1) as x1, max(bottom) as bottom from tcells group by all",
    GROUP_CTES,
    recursive=True,
)
def q_table_boxes(spark, d):
    return R.table_boxes(R.group_cells(R.find_cells(fx.edges(spark, d)), together=True))


@query(
    "words_in_cells",
    ("words", "grid_words", "edges"),
    """select w.doc_id, w.page, w.word_no, w.word, c.x0 as c_x0, c.top as c_top, c.x1 as c_x1, c.bottom as c_bottom
from allw w join cells_found c on w.doc_id = c.doc_id and w.page = c.page
where c.x0 <= (w.x0 + w.x1) / 2 and (w.x0 + w.x1) / 2 < c.x1 and c.top <= (w.top + w.bottom) / 2 and (w.top + w.bottom) / 2 < c.bottom""",
    RULE_CTES + [("allw", GRID_WORDS_SQL)],
)
def q_words_in_cells(spark, d):
    n = fx.parts(spark, d)
    j = R.words_in_cells(_all_words(spark, d, n), edges=fx.edges(spark, d, n))
    return j.select("doc_id", "page", "word_no", "word", "c_x0", "c_top", "c_x1", "c_bottom")


EXTRACT_CTES = GROUP_CTES + [
    ("allw", GRID_WORDS_SQL),
    (
        "grid",
        """select *, cast(dense_rank() over (partition by doc_id, page, table_no order by top) - 1 as int) as row_no,
       cast(dense_rank() over (partition by doc_id, page, table_no order by x0) - 1 as int) as col_no
from tcells""",
    ),
    (
        "slots",
        """select doc_id, page, table_no, row_no, cast(unnest(range(0, ncols + 1)) as int) as col_no
from (select distinct doc_id, page, table_no, row_no, max(col_no) over (partition by doc_id, page, table_no) as ncols from grid) s""",
    ),
    (
        "cw",
        """select g.doc_id, g.page, g.table_no, g.row_no, g.col_no, w.word_no, w.word, w.x0, w.x1, w.top, w.bottom
from allw w join grid g on w.doc_id = g.doc_id and w.page = g.page
where g.x0 <= (w.x0 + w.x1) / 2 and (w.x0 + w.x1) / 2 < g.x1 and g.top <= (w.top + w.bottom) / 2 and (w.top + w.bottom) / 2 < g.bottom""",
    ),
    ("ct", page_text_sql("cw", "doc_id, page, table_no, row_no, col_no")),
]


@query(
    "extract_tables",
    ("words", "grid_words", "edges"),
    """select s.doc_id, s.page, s.table_no, s.row_no, s.col_no,
       case when g.x0 is null then null else coalesce(t.text, '') end as txt
from slots s
left join grid g on s.doc_id = g.doc_id and s.page = g.page and s.table_no = g.table_no and s.row_no = g.row_no and s.col_no = g.col_no
left join ct t on s.doc_id = t.doc_id and s.page = t.page and s.table_no = t.table_no and s.row_no = t.row_no and s.col_no = t.col_no""",
    EXTRACT_CTES,
    recursive=True,
)
def q_extract_tables(spark, d):
    n = fx.parts(spark, d)
    return R.extract_tables(_all_words(spark, d, n), fx.edges(spark, d, n))


TABLE_WORDS_SQL = "select doc_id, page, -1 as word_no, word, x0, x1, top, bottom from grid_words"
TEXT_EDGES_SQL = (
    "select doc_id, page, orient, pos, lo, hi from edges where orient = 'h' union all select doc_id, page, orient, pos, lo, hi from ("
    + VERTICAL_TEXT_SQL.replace("from words", "from grid_words")
    + ") v"
)


def _text_strategy_ctes():
    out = [("edges_t", TEXT_EDGES_SQL)]
    for name, sql in EXTRACT_CTES:
        if name == "snapped":
            sql = sql.replace("from edges) a) b", "from edges_t) a) b")
        if name == "allw":
            sql = TABLE_WORDS_SQL
        out.append((name, sql))
    return out


EXTRACT_SQL = """select s.doc_id, s.page, s.table_no, s.row_no, s.col_no,
       case when g.x0 is null then null else coalesce(t.text, '') end as txt
from slots s
left join grid g on s.doc_id = g.doc_id and s.page = g.page and s.table_no = g.table_no and s.row_no = g.row_no and s.col_no = g.col_no
left join ct t on s.doc_id = t.doc_id and s.page = t.page and s.table_no = t.table_no and s.row_no = t.row_no and s.col_no = t.col_no"""


@query("extract_tables_text", ("grid_words", "edges"), EXTRACT_SQL, _text_strategy_ctes(), recursive=True)
def q_extract_tables_text(spark, d):
    """H3 with vertical rules from the words' alignment and horizontal ones from the ruling edges."""
    words = fx.grid_words(spark, d).select("doc_id", "page", F.lit(-1).alias("word_no"), "word", "x0", "x1", "top", "bottom")
    return R.extract_tables(words, fx.edges(spark, d), s=R.GridSettings(vertical_strategy="text"))


AROUND_CTES = GROUP_CTES + [
    ("boxes", "select doc_id, page, table_no, min(x0) as x0, min(top) as top, max(x1) as x1, max(bottom) as bottom from tcells group by all"),
    (
        "parts",
        """select w.*, b.table_no, case when w.x0 >= 0 and w.x1 <= p.width and w.top >= 0 and w.bottom <= b.top then 'above'
                                   when w.x0 >= 0 and w.x1 <= p.width and w.top >= b.bottom and w.bottom <= p.height then 'below' end as part
from words w join boxes b on w.doc_id = b.doc_id and w.page = b.page join pages p on w.doc_id = p.doc_id and w.page = p.page""",
    ),
    ("pa", "select * from parts where part = 'above'"),
    ("pb", "select * from parts where part = 'below'"),
    ("ta", page_text_sql("pa", "doc_id, page, table_no")),
    ("tb", page_text_sql("pb", "doc_id, page, table_no")),
]


@query(
    "text_around_tables",
    ("words", "pages", "edges"),
    """select b.doc_id, b.page, b.table_no, coalesce(a.text, '') as above, coalesce(c.text, '') as below
from boxes b left join ta a on b.doc_id = a.doc_id and b.page = a.page and b.table_no = a.table_no
left join tb c on b.doc_id = c.doc_id and b.page = c.page and b.table_no = c.table_no""",
    AROUND_CTES,
    recursive=True,
)
def q_text_around_tables(spark, d):
    boxes = R.table_boxes(R.group_cells(R.find_cells(fx.edges(spark, d)), together=True))
    return L.text_around_tables(fx.words(spark, d, by=("doc_id", "page")), boxes, fx.pages(spark, d))


BETWEEN_CTES = AROUND_CTES[: len(GROUP_CTES) + 1] + [
    (
        "bands",
        """select doc_id, page, cast(i as bigint) as band, coalesce(prev_bottom, 0.0e0) as lo, top as hi, width from ob
union all
select doc_id, page, cast(n as bigint), end_bottom, height, width from ob where i = n - 1""",
    ),
    (
        "bw",
        """select w.*, b.band from words w join bands b on w.doc_id = b.doc_id and w.page = b.page
where w.x0 >= 0 and w.x1 <= b.width and w.top >= b.lo and w.bottom <= b.hi""",
    ),
    ("bt", page_text_sql("bw", "doc_id, page, band")),
]
BETWEEN_CTES.insert(
    len(GROUP_CTES) + 1,
    (
        "ob",
        """select b.*, p.width, p.height, row_number() over (partition by b.doc_id, b.page order by b.top, b.table_no) - 1 as i,
       max(b.bottom) over (partition by b.doc_id, b.page order by b.top, b.table_no rows between unbounded preceding and 1 preceding) as prev_bottom,
       max(b.bottom) over (partition by b.doc_id, b.page) as end_bottom,
       count(*) over (partition by b.doc_id, b.page) as n
from boxes b join pages p on b.doc_id = p.doc_id and b.page = p.page""",
    ),
)


@query(
    "text_between_tables",
    ("words", "pages", "edges"),
    """select b.doc_id, b.page, string_agg(coalesce(t.text, ''), chr(10) order by b.band) as full_text
from bands b left join bt t on b.doc_id = t.doc_id and b.page = t.page and b.band = t.band
group by b.doc_id, b.page""",
    BETWEEN_CTES,
    recursive=True,
)
def q_text_between_tables(spark, d):
    boxes = R.table_boxes(R.group_cells(R.find_cells(fx.edges(spark, d)), together=True))
    return L.text_between_tables(fx.words(spark, d, by=("doc_id", "page")), boxes, fx.pages(spark, d))


# ---------------------------------------------------------------- tables on the cropped page (J2 crop, quirk 16)

EDGES_CROP_SQL = """select doc_id, page, orient, pos,
       case when orient = 'h' then greatest(lo, 3.0e0) else greatest(lo, 70.0e0) end as lo,
       case when orient = 'h' then least(hi, 590.0e0) else least(hi, 770.0e0) end as hi
from (select *, least(case when orient = 'h' then hi else pos end, 590.0e0) - greatest(case when orient = 'h' then lo else pos end, 3.0e0) as ow,
                least(case when orient = 'h' then pos else hi end, 770.0e0) - greatest(case when orient = 'h' then pos else lo end, 70.0e0) as oh
      from edges) e
where ow >= 0 and oh >= 0 and ow + oh > 0"""

WORDS_CROP_SQL = """select doc_id, page, word_no, word, greatest(x0, 3.0e0) as x0, least(x1, 590.0e0) as x1,
       greatest(top, 70.0e0) as top, least(bottom, 770.0e0) as bottom
from (""" + GRID_WORDS_SQL + """) w
where least(x1, 590.0e0) - greatest(x0, 3.0e0) >= 0 and least(bottom, 770.0e0) - greatest(top, 70.0e0) >= 0
  and (least(x1, 590.0e0) - greatest(x0, 3.0e0)) + (least(bottom, 770.0e0) - greatest(top, 70.0e0)) > 0"""


def _cropped_ctes():
    out = [("edges_c", EDGES_CROP_SQL)]
    for name, sql in EXTRACT_CTES:
        if name == "snapped":
            sql = sql.replace("from edges) a) b", "from edges_c) a) b")
        if name == "allw":
            sql = WORDS_CROP_SQL
        out.append((name, sql))
    return out


@query(
    "extract_tables_cropped",
    ("words", "grid_words", "edges"),
    """select s.doc_id, s.page, s.table_no, s.row_no, s.col_no,
       case when g.x0 is null then null else coalesce(t.text, '') end as txt
from slots s
left join grid g on s.doc_id = g.doc_id and s.page = g.page and s.table_no = g.table_no and s.row_no = g.row_no and s.col_no = g.col_no
left join ct t on s.doc_id = t.doc_id and s.page = t.page and s.table_no = t.table_no and s.row_no = t.row_no and s.col_no = t.col_no""",
    _cropped_ctes(),
    recursive=True,
)
def q_extract_tables_cropped(spark, d):
    n = fx.parts(spark, d)
    return R.extract_tables(_all_words(spark, d, n), fx.edges(spark, d, n), crop_box=L.CROP_BOX)
