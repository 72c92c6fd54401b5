"""DuckDB definitions of the decoded tables (FIXTURES.md), as CTEs.

``with_fixtures(body, names)`` prefixes an oracle query with the CTEs it needs,
in dependency order.  Same two widenings as ``folio.sources.fixtures``: edges
for every table, predictions for every page.
"""

from __future__ import annotations

FIX: dict[str, tuple[tuple[str, ...], str]] = {}


def _def(name: str, deps: tuple[str, ...], sql: str) -> None:
    FIX[name] = (deps, sql)


_def(
    "files",
    (),
    r"""select doc_id,
       concat('.', chr(92), '2024', chr(92),
         case doc_id % 5
           when 0 then concat(source, chr(92), 'doc_', doc_id, '.pdf')
           when 1 then concat('doc_', doc_id, '.pdf')
           when 2 then concat(source, chr(92), lang, chr(92), 'doc_', doc_id, '.pdf')
           when 3 then concat(source, chr(92), doc_id, chr(92), ' rev.', doc_id % 50, '.pdf')
           else concat(source, chr(92), 'note_', doc_id, '.txt') end) as path,
       doc_id as listing_no
from documents""",
)
_def(
    "raw_pages",
    (),
    r"""select doc_id, page, substr(text, page * 1800 + 1, 1800) as raw
from (select doc_id, text, cast(unnest(range(0, 1 + cast(floor((length(text) - 1) / 1800) as int))) as int) as page
      from documents)""",
)
_def(
    "table_pages",
    (),
    r"""select l_orderkey % (select count(*) from documents) as doc_id, cast(floor((count(distinct l_orderkey) - 1) / 2) as int) as last_page
from lineitem group by all""",
)
_def(
    "pages",
    ("table_pages",),
    r"""select doc_id, page,
       case when doc_id % 13 = 0 then 500.0e0 else 595.0e0 end as width,
       case when doc_id % 13 = 0 then 700.0e0 else 841.0e0 end as height,
       raw,
       case when (doc_id + page) % 7 = 0 then ''
            else replace(replace(replace(raw, 'th', concat('t-', chr(10), 'h')), ', ', ',  '),
                         '. ', '.    ') end as page_text
from (select doc_id, page, coalesce(substr(text, page * 1800 + 1, 1800), '') as raw
      from (select d.doc_id, d.text,
                   cast(unnest(range(0, 1 + greatest(coalesce(cast(floor((length(d.text) - 1) / 1800) as int), -1), coalesce(t.last_page, -1)))) as int) as page
            from documents d left join table_pages t on d.doc_id = t.doc_id) p) q""",
)
_def(
    "pages_warn",
    ("pages",),
    r"""select doc_id, page, width, height, raw,
       case when doc_id % 3 = 0
            then concat(page_text, 'Evaluation Warning : The document was created with  Spire.XLS for Python')
            else page_text end as page_text
from pages""",
)
_def(
    "raw_lines",
    ("raw_pages",),
    r"""select doc_id, page, cast(line_no as int) as line_no, txt
from (select doc_id, page, unnest(range(len(a))) as line_no, unnest(a) as txt
      from (select doc_id, page, string_split(raw, chr(10)) as a from raw_pages))""",
)
_def(
    "ocr_lines",
    ("raw_lines",),
    r"""select doc_id, page, case when doc_id % 11 = 0 then line_no % 2 else 0 end as result_idx, line_no, txt,
       cast(length(txt) % 100 as double) / 100.0e0 as conf
from raw_lines
where (doc_id + page) % 7 = 0 and (doc_id + page) % 14 <> 0""",
)
_def(
    "page_words",
    ("raw_pages",),
    r"""select doc_id, page, cast(word_no as int) as word_no, word,
       cast(sum(length(word) + 1) over (partition by doc_id, page order by word_no
                                        rows unbounded preceding) - length(word) - 1 as bigint) as off
from (select doc_id, page, unnest(range(len(a))) as word_no, unnest(a) as word
      from (select doc_id, page, string_split(replace(raw, chr(10), ' '), ' ') as a from raw_pages))""",
)
_def(
    "words",
    ("page_words",),
    r"""select doc_id, page, word_no, word,
       cast(36 + 6 * (off % 80) as double) as x0,
       cast(36 + 6 * (off % 80) + 6 * length(word) as double) as x1,
       cast(40 + 34 * floor(off / 80) as double) as top,
       cast(52 + 34 * floor(off / 80) as double) as bottom
from page_words where word <> ''""",
)
_def(
    "order_tables",
    (),
    r"""select l_orderkey, l_orderkey % (select count(*) from documents) as doc_id,
       row_number() over (partition by l_orderkey % (select count(*) from documents)
                          order by l_orderkey) - 1 as doc_table
from (select distinct l_orderkey from lineitem) t""",
)
_def(
    "table_rows",
    ("order_tables",),
    r"""select o.doc_id, cast(floor(o.doc_table / 2) as int) as page, cast(o.doc_table % 2 as int) as table_no,
       cast(row_number() over (partition by l.l_orderkey
            order by l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) as int) as row_no,
       l.l_linenumber, l.l_returnflag, l.l_linestatus, cast(l.l_quantity as int) as qty
from lineitem l join order_tables o on l.l_orderkey = o.l_orderkey""",
)
_def(
    "cells",
    ("table_rows",),
    r"""select doc_id, page, table_no, row_no, col_no,
       case col_no
         when 0 then case when row_no % 3 = 0 then null else concat('L', l_linenumber) end
         when 1 then concat(l_returnflag, chr(10), l_linestatus)
         when 2 then cast(qty as varchar)
         else '' end as txt
from table_rows cross join (values (0), (1), (2), (3)) v(col_no)
union all
select doc_id, page, table_no, 0 as row_no, col_no,
       case col_no when 1 then 'FLAG' when 2 then 'QTY' else '' end as txt
from (select distinct doc_id, page, table_no from table_rows) h
cross join (values (0), (1), (2), (3)) v(col_no)""",
)
_def(
    "grids",
    ("table_rows",),
    r"""select doc_id, page, table_no, n_rows,
       cast(60 + coalesce(sum(greatest(350, 20 * n_rows + 50))
            over (partition by doc_id, page order by table_no rows between unbounded preceding and 1 preceding), 0) as double) as y0
from (select doc_id, page, table_no, max(row_no) + 1 as n_rows from table_rows group by doc_id, page, table_no) g""",
)
_def(
    "edges",
    ("grids",),
    r"""select doc_id, page, 'h' as orient, y0 + 20.0e0 * r as pos, 50.0e0 as lo, 229.0e0 as hi
from (select *, unnest(range(0, n_rows + 1)) as r from grids) a
union all
select doc_id, page, 'h' as orient, y0 + 20.0e0 * r + 0.5e0 * (r % 3) as pos, 231.0e0 as lo, 410.0e0 as hi
from (select *, unnest(range(0, n_rows + 1)) as r from grids) b
union all
select doc_id, page, 'v' as orient, 50.0e0 + 90.0e0 * c as pos, y0 as lo, y0 + 20.0e0 * n_rows + 1.0e0 as hi
from (select *, unnest(range(0, 5)) as c from grids) c
union all
select doc_id, page, 'h' as orient, y0 + 9.0e0 as pos, 500.0e0 as lo, 502.0e0 as hi from grids""",
)
_def(
    "grid_words",
    ("cells", "grids"),
    r"""select c.doc_id, c.page, c.table_no, c.row_no, c.col_no,
       replace(c.txt, chr(10), '/') as word,
       55.0e0 + 90.0e0 * c.col_no as x0,
       55.0e0 + 90.0e0 * c.col_no + 6.0e0 * length(c.txt) as x1,
       g.y0 + 20.0e0 * c.row_no + 4.0e0 as top,
       g.y0 + 20.0e0 * c.row_no + 16.0e0 as bottom
from cells c join grids g on c.doc_id = g.doc_id and c.page = g.page and c.table_no = g.table_no
where c.txt is not null and c.txt <> ''""",
)
_def(
    "raw_pixels",
    (),
    r"""select vec_id as image_id, cast(p as int) as p, e
from (select vec_id, unnest(range(64)) as p, unnest(embedding) as e from embeddings)""",
)
_def(
    "pixels",
    ("raw_pixels",),
    r"""select image_id, cast(floor(p / 8) as int) as y, cast(p % 8 as int) as x,
       cast(greatest(0, least(255, floor((cast(e as double) + 0.55e0) * 230))) as int) as v
from raw_pixels""",
)
_def(
    "predictions",
    ("words",),
    r"""select doc_id * 1000 + page as image_id, word_no as idx, word, x0, top, x1, bottom,
       595.0e0 as img_w, 841.0e0 as img_h
from words""",
)
_def(
    "regions",
    (),
    r"""select l_orderkey % 50 as image_id, l_partkey % 400 as x, l_suppkey * 3 as y,
       20 + 10 * cast(l_quantity as int) as w, 10 + 25 * l_linenumber as h,
       (20 + 10 * cast(l_quantity as int)) * (10 + 25 * l_linenumber) as area, 500 as img_h
from lineitem""",
)
_def(
    "pixel_regions",
    (),
    r"""select vec_id as image_id, vec_id % 4 as x, vec_id % 3 as y, 1 + vec_id % 4 as w, 1 + vec_id % 5 as h
from embeddings""",
)


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for dep in FIX[n][0]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_fixtures(names: tuple[str, ...] | list[str], body: str, extra: list[tuple[str, str]] | None = None, recursive: bool = False) -> str:
    """``with <fixture ctes>, <extra ctes> <body>``; an extra CTE named "x materialized" is computed once."""
    parts = [f"{n} as (\n{FIX[n][1]}\n)" for n in _order(names)]
    parts += [f"{n.removesuffix(' materialized')} as {'materialized ' * n.endswith(' materialized')}(\n{sql}\n)" for n, sql in (extra or [])]
    if not parts:
        return body
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(parts) + "\n" + body
