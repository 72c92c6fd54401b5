"""Ruled tables from ruling edges.

``edges(<page keys>, orient, pos, lo, hi)``: ``orient`` 'h' (y = pos, x from lo to
hi) or 'v' (x = pos, y from lo to hi).  Every join is keyed by the page, and the
range join of words adds a coarse band of the range coordinate to the key; rules
are met by a sweep over each page.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.layout import crop, edges_from_words, unbounded

PAGE_KEYS = ("doc_id", "page")
BAND = 64.0  # points; band height used to key range joins


@dataclass(frozen=True)
class GridSettings:
    """The table-finding knobs (the reference's values are the defaults).

    A strategy says where an axis takes its rules from: "lines" the ruling
    edges, "text" the alignment of words (H7)."""

    vertical_strategy: str = "lines"
    horizontal_strategy: str = "lines"
    min_words_vertical: int = 3
    min_words_horizontal: int = 1
    text_x_tolerance: float = 3
    text_y_tolerance: float = 3
    explicit_vertical_lines: tuple[float, ...] = ()
    explicit_horizontal_lines: tuple[float, ...] = ()
    snap_x_tolerance: float = 3
    snap_y_tolerance: float = 3
    join_x_tolerance: float = 3
    join_y_tolerance: float = 3
    edge_min_length: float = 3
    intersection_x_tolerance: float = 3
    intersection_y_tolerance: float = 3


DEFAULT = GridSettings()


def explicit_lines(edges: DataFrame, pages: DataFrame, vertical=(), horizontal=(), keys=PAGE_KEYS) -> DataFrame:
    """Add full-height vertical and full-width horizontal lines at the given positions
    to the edges of every page, pages without rules included."""
    k = list(keys)
    if not vertical and not horizontal:
        return edges
    pg = pages.select(*k, "width", "height")
    extra = []
    if vertical:
        extra.append(
            pg.select(*k, F.explode(F.array(*[F.lit(float(v)) for v in vertical])).alias("pos"), "height").select(
                *k, F.lit("v").alias("orient"), "pos", F.lit(0.0).alias("lo"), F.col("height").alias("hi")
            )
        )
    if horizontal:
        extra.append(
            pg.select(*k, F.explode(F.array(*[F.lit(float(h)) for h in horizontal])).alias("pos"), "width").select(
                *k, F.lit("h").alias("orient"), "pos", F.lit(0.0).alias("lo"), F.col("width").alias("hi")
            )
        )
    out = edges.select(*k, "orient", "pos", "lo", "hi")
    for e in extra:
        out = out.unionByName(e)
    return out


def snap_edges(edges: DataFrame, x_tol: float = 3, y_tol: float = 3, keys=PAGE_KEYS) -> DataFrame:
    """Parallel rules whose sorted positions are within the tolerance of the previous
    one form a group and move to the group's mean position (rounded to 6 digits)."""
    k = list(keys)
    # partitioned by page alone: rules that are already together by page or by document are not shuffled
    w = Window.partitionBy(*k).orderBy("orient", "pos")
    tol = F.when(F.col("orient") == "v", F.lit(float(x_tol))).otherwise(F.lit(float(y_tol)))
    prev = F.when(F.lag("orient").over(w).eqNullSafe(F.col("orient")), F.lag("pos").over(w))
    new = F.when(prev.isNull() | ((F.col("pos") - prev) > tol), 1).otherwise(0)
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    g = edges.withColumn("_new", new).withColumn("_grp", F.sum("_new").over(upto))
    return g.withColumn("pos", F.round(F.avg("pos").over(Window.partitionBy(*k, "orient", "_grp")), 6)).drop("_new", "_grp")


def join_edges(edges: DataFrame, x_tol: float = 3, y_tol: float = 3, keys=PAGE_KEYS) -> DataFrame:
    """Collinear rules that overlap or whose ends are within the tolerance merge into one."""
    k = list(keys)
    w = Window.partitionBy(*k, "orient", "pos").orderBy("lo", "hi")
    tol = F.when(F.col("orient") == "h", F.lit(float(x_tol))).otherwise(F.lit(float(y_tol)))
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("lo") > reach + tol), 1).otherwise(0)
    # a start flag depends only on rules with a smaller start, so count starts by a RANGE over lo
    upto = Window.partitionBy(*k, "orient", "pos").orderBy("lo").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    g = edges.withColumn("_new", new).withColumn("_grp", F.sum("_new").over(upto))
    return g.groupBy(*k, "orient", "pos", "_grp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_grp")


def strategy_edges(edges: DataFrame, words: DataFrame | None, s: GridSettings = DEFAULT, keys=PAGE_KEYS) -> DataFrame:
    """The rules that the settings' strategies ask for: per axis the ruling edges or those of aligned words."""
    k = list(keys)
    axes = {"v": s.vertical_strategy, "h": s.horizontal_strategy}
    if unknown := set(axes.values()) - {"lines", "text"}:
        raise ValueError(f"unknown table strategy: {sorted(unknown)}")
    by_text = [o for o, how in axes.items() if how == "text"]
    if not by_text:
        return edges
    if words is None:
        raise ValueError("the text strategy needs the words")
    t = edges_from_words(words, s.text_x_tolerance, s.text_y_tolerance, s.min_words_vertical, s.min_words_horizontal, keys)
    cols = [*k, "orient", "pos", "lo", "hi"]
    return edges.where(~F.col("orient").isin(by_text)).select(*cols).unionByName(t.where(F.col("orient").isin(by_text)).select(*cols))


def clean_edges(edges: DataFrame, pages: DataFrame | None = None, s: GridSettings = DEFAULT, keys=PAGE_KEYS) -> DataFrame:
    """U2 -> E3 -> E4 -> drop rules shorter than ``edge_min_length``."""
    k = list(keys)
    e = edges.select(*k, "orient", "pos", "lo", "hi")
    if s.explicit_vertical_lines or s.explicit_horizontal_lines:
        if pages is None:
            raise ValueError("explicit lines need the pages")
        e = explicit_lines(e, pages, s.explicit_vertical_lines, s.explicit_horizontal_lines, keys)
    e = snap_edges(e, s.snap_x_tolerance, s.snap_y_tolerance, keys)
    e = join_edges(e, s.join_x_tolerance, s.join_y_tolerance, keys)
    return e.where((F.col("hi") - F.col("lo")) >= s.edge_min_length)


def _band(c) -> F.Column:
    return F.floor(c / F.lit(BAND)).cast("long")


def sweep(verticals, horizontals, x_tol: float, y_tol: float):
    """Pairs (vertical, horizontal) that meet, by position in their lists.

    ``verticals``: (x, lo, hi), ``horizontals``: (y, lo, hi).  A line sweeps the page downward; the verticals it
    crosses are kept in order of x, so a horizontal finds those it meets as one slice: what is looked at is what
    is returned, however many rules run over the whole page."""
    from bisect import bisect_left, bisect_right, insort
    from heapq import heappop, heappush

    begins = sorted(range(len(verticals)), key=lambda i: verticals[i][1])
    active, ends, at = [], [], 0
    for j in sorted(range(len(horizontals)), key=lambda j: horizontals[j][0]):
        y, lo, hi = horizontals[j]
        while at < len(begins) and verticals[begins[at]][1] <= y + y_tol:
            i = begins[at]
            insort(active, (verticals[i][0], i))
            heappush(ends, (verticals[i][2], i))
            at += 1
        while ends and not ends[0][0] >= y - y_tol:
            i = heappop(ends)[1]
            del active[bisect_left(active, (verticals[i][0], i))]
        first = bisect_left(active, (lo - x_tol,))
        for _, i in active[first : bisect_right(active, (hi + x_tol, len(verticals)), lo=first)]:
            yield i, j


PAIRS = 4096  # a page of at most so many (vertical, horizontal) pairs is met by comparing them, a fuller one by the sweep


def edge_intersections(edges: DataFrame, x_tol: float = 3, y_tol: float = 3, keys=PAGE_KEYS, then=None, names=("x", "v_lo", "v_hi", "y", "h_lo", "h_hi")) -> DataFrame:
    """C4: every (vertical, horizontal) pair that meets within the tolerances: ``(<keys>, x, v_lo, v_hi, y, h_lo, h_hi)``.

    A plane sweep a page (a page holds a bounded number of rules): rules are
    not copied, and nothing is joined.  Rules that are already partitioned by
    page, as ``clean_edges`` leaves them, are not shuffled again.

    ``then``: goes on with the meetings of some whole pages in the same task, where they are together, and returns ``names``
    (doubles): called with the rules, the page number of each rule, and the places of the meeting rules."""
    k = list(keys)
    whole = F.col("pos").isNotNull() & F.col("lo").isNotNull() & F.col("hi").isNotNull()
    # the window asks for the rows of a page together, in one order, and shuffles only if they are not
    page = Window.partitionBy(*k).orderBy("orient", "pos", "lo", "hi")
    rows = edges.where(whole & F.col("orient").isin("v", "h")).withColumn("_n", F.row_number().over(page))
    rows = rows.select(*k, (F.col("orient") == "v").alias("_up"), *[F.col(c).cast("double").alias(c) for c in ("pos", "lo", "hi")], "_n")
    schema = T.StructType([f for f in edges.schema.fields if f.name in k] + [T.StructField(c, T.DoubleType()) for c in names])
    return rows.mapInPandas(lambda it: _meetings_of_pages(it, k, x_tol, y_tol, then or _meeting_rows, list(names)), schema)


def _meetings_of_pages(batches, k, x_tol, y_tol, then, names):
    """``then`` of the meetings of each batch of whole pages: the place of a rule whose page it is, and its columns."""
    import pandas as pd

    from folio.operators.components import whole_groups

    for pdf in whole_groups(batches, k):
        no = (pdf["_n"] == 1).to_numpy().cumsum() - 1
        at, columns = then(pdf, no, *_meetings(pdf, no, x_tol, y_tol))
        if len(at):
            yield pd.concat([pdf.iloc[at][k].reset_index(drop=True), pd.DataFrame(dict(zip(names, columns)))], axis=1)


def _meeting_rows(pdf, no, v, h):
    place = [pdf[c].to_numpy() for c in ("pos", "lo", "hi")]
    return v, [*(c[v] for c in place), *(c[h] for c in place)]


def _meetings(pdf, no, x_tol, y_tol):
    """The places of the (vertical, horizontal) rules that meet; the horizontals of a page are before its verticals."""
    import numpy as np

    up, pos, lo, hi = (pdf[c].to_numpy() for c in ("_up", "pos", "lo", "hi"))
    n_v, n_h = np.bincount(no, up), np.bincount(no, ~up)
    first = np.flatnonzero(pdf["_n"].to_numpy() == 1)
    few = n_v * n_h <= PAIRS
    some = np.flatnonzero(up & few[no])
    each = n_h[no[some]].astype("int64")
    v = np.repeat(some, each)
    h = np.arange(len(v)) - np.repeat(each.cumsum() - each, each) + np.repeat(first[no[some]], each)
    met = (lo[v] <= pos[h] + y_tol) & (hi[v] >= pos[h] - y_tol) & (lo[h] - x_tol <= pos[v]) & (pos[v] <= hi[h] + x_tol)
    left, right = [v[met]], [h[met]]
    for page in np.flatnonzero(~few):
        a, b, c = first[page], first[page] + int(n_h[page]), first[page] + int(n_h[page] + n_v[page])
        rules = lambda i, j: list(zip(pos[i:j].tolist(), lo[i:j].tolist(), hi[i:j].tolist()))
        pairs = np.array(list(sweep(rules(b, c), rules(a, b), x_tol, y_tol)), dtype="int64").reshape(-1, 2)
        left.append(pairs[:, 0] + b)
        right.append(pairs[:, 1] + a)
    return np.concatenate(left), np.concatenate(right)


def find_cells(edges: DataFrame, pages: DataFrame | None = None, s: GridSettings = DEFAULT, keys=PAGE_KEYS) -> DataFrame:
    """H1: edges -> cells ``(<keys>, x0, top, x1, bottom)``.

    For each intersection A the cell is the smallest rectangle right-below A whose
    corners B (below A), C (right of A) and D all exist, with A-B and C-D on one
    vertical rule and A-C and B-D on one horizontal rule; "smallest" is the
    nearest B, then the nearest C.

    Rules of one line don't overlap (``join_edges``), so the points of a rule are
    neighbours on its line: where the rules of a page meet, in the same task, sorts
    find each corner's next point down (B) and right (C), and theirs: if C's next
    point down is at B's height and B's next point right is at C's x, that is the
    cell.  Only corners with a B and a C but no cell yet (merged or irregular
    cells) are searched one by one, a page at a time.

    The cells of a page come one after another, by top and x0."""
    e = clean_edges(edges, pages, s, keys)
    return edge_intersections(e, s.intersection_x_tolerance, s.intersection_y_tolerance, keys, _cells_at, ("x0", "top", "x1", "bottom"))


def _next_on_rule(point, rule, n_rules: int):
    """For each point, in the order of its line: whether a rule through it also goes through the next one."""
    import numpy as np

    through = np.unique(point * n_rules + rule)
    on = through[np.isin(through + n_rules, through, assume_unique=True)] // n_rules
    out = np.zeros(point.max() + 1, dtype=bool)
    out[on] = True
    return out


def _cells_at(pdf, no, v, h):
    """The cells of whole pages: a place of their page's rules, and (x0, top, x1, bottom)."""
    import numpy as np

    if not len(v):
        return v, []
    x, y, pg = pdf["pos"].to_numpy()[v], pdf["pos"].to_numpy()[h], no[v]
    order = np.lexsort((y, x, pg))
    x, y, pg, v, h = x[order], y[order], pg[order], v[order], h[order]
    new = np.r_[True, (np.diff(pg) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)]
    point = new.cumsum() - 1  # of each meeting; by page, x and y
    px, py, pp = x[new], y[new], pg[new]
    n = len(px)
    across = np.lexsort((px, py, pp))  # points by page, y and x
    rank = np.empty(n, dtype="int64")
    rank[across] = np.arange(n)
    # a rule lies on one line of one page, so a next point on it is on that line too
    down_on = np.r_[_next_on_rule(point, v, len(pdf))[:-1], False]
    right_on = np.r_[_next_on_rule(rank[point], h, len(pdf))[:-1], False][rank]
    down, right = np.minimum(np.arange(n) + 1, n - 1), across[np.minimum(rank + 1, n - 1)]
    both = down_on & right_on
    closes = both & down_on[right] & right_on[down] & (py[down[right]] == py[down]) & (px[right[down]] == px[right])
    x2, y2 = px[right], py[down]
    open_ = both & ~closes
    if open_.any():
        of = np.searchsorted(pp, [np.unique(pp[open_]), np.unique(pp[open_]) + 1])
        meets = np.searchsorted(point, np.arange(n + 1))
        for a, b in of.T:
            xs, ys = px[a:b].tolist(), py[a:b].tolist()
            at = {(xs[i - a], ys[i - a]): (set(v[meets[i] : meets[i + 1]].tolist()), set(h[meets[i] : meets[i + 1]].tolist())) for i in range(a, b)}
            column, line = {}, {}
            for px_, py_ in zip(xs, ys):
                column.setdefault(px_, []).append(py_)
                line.setdefault(py_, []).append(px_)
            for i in a + np.flatnonzero(open_[a:b]):
                found = _close(xs[i - a], ys[i - a], at, column, line)
                if found:
                    (x2[i], y2[i]), closes[i] = found, True
    cells = np.flatnonzero(closes)
    cells = cells[np.lexsort((px[cells], py[cells], pp[cells]))]
    first = np.flatnonzero(pdf["_n"].to_numpy() == 1)
    return first[pp[cells]], [px[cells], py[cells], x2[cells], y2[cells]]


def _close(x, y, at, column, line):
    """The nearest (x2, y2) that makes a cell with the corner (x, y), by height first; None if none does."""
    vs, hs = at[x, y]
    rights = [x2 for x2 in line[y] if x2 > x and hs & at[x2, y][1]]
    for y2 in column[x]:
        if y2 <= y or not vs & at[x, y2][0]:
            continue
        for x2 in rights:
            corner = at.get((x2, y2))
            if corner and corner[0] & at[x2, y][0] and corner[1] & at[x, y2][1]:
                return x2, y2
    return None


def group_cells(cells: DataFrame, keys=PAGE_KEYS, together: bool = False) -> DataFrame:
    """H2: cells sharing a corner belong to one table; tables numbered top-left first per page.

    A page is the unit: cells are shuffled once by page and sorted inside each
    partition (not if they are ``together``: as ``find_cells`` returns them); each Arrow batch (many whole pages, never a
    split page) is labelled by one vectorised union-find over the cell -- corner graph
    (``mapInPandas``).  A page holds a bounded number of cells, so no group is
    large.
    """
    k = list(keys)
    out_schema = T.StructType(
        [f for f in cells.schema.fields if f.name in k]
        + [T.StructField(c, T.DoubleType()) for c in ("x0", "top", "x1", "bottom")]
        + [T.StructField("table_no", T.IntegerType())]
    )
    c = cells.select(*k, *[F.col(x).cast("double") for x in ("x0", "top", "x1", "bottom")])
    if not together:
        c = c.repartition(*k).sortWithinPartitions(*k, "top", "x0", "x1", "bottom")
    return c.mapInPandas(lambda it: _tables_of_pages(it, k), out_schema)


def _tables_of_pages(batches, k):
    from folio.operators.components import whole_groups

    for pdf in whole_groups(batches, k):
        page = pdf.groupby(k, sort=False, dropna=False).ngroup().to_numpy()
        table, number = _tables_at(page, *(pdf[c].to_numpy() for c in ("x0", "top", "x1", "bottom")))
        yield pdf.assign(table_no=number[table].astype("int32"))


def _tables_at(page, x0, top, x1, bottom):
    """The table of each cell, counted over all pages, and each table's number on its page; cells by page, top and x0."""
    import numpy as np

    from folio.operators.components import union_find

    n = len(page)
    px, py, pp = np.r_[x0, x1, x0, x1], np.r_[top, top, bottom, bottom], np.tile(page, 4)
    order = np.lexsort((py, px, pp))
    point = np.empty(4 * n, dtype="int64")
    point[order] = np.r_[0, ((np.diff(pp[order]) != 0) | (np.diff(px[order]) != 0) | (np.diff(py[order]) != 0)).cumsum()]
    # bipartite graph: cells 0..n-1, corner points n..; rows are sorted by page, top, x0,
    # so a component's smallest cell index is its top-left cell
    lab = union_find(n + int(point.max()) + 1, np.tile(np.arange(n), 4), point + n)[:n]
    first, table = np.unique(lab, return_inverse=True)
    return table, np.arange(len(first)) - np.searchsorted(page[first], page[first])


def table_boxes(cells: DataFrame, keys=PAGE_KEYS) -> DataFrame:
    """Bounding box of every table."""
    return cells.groupBy(*keys, "table_no").agg(
        F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom")
    )


def words_in_cells(words: DataFrame, cells: DataFrame | None = None, keys=PAGE_KEYS, edges: DataFrame | None = None, s: GridSettings = DEFAULT) -> DataFrame:
    """Each word goes to the cell holding its centre (half-open: left/top edges in,
    right/bottom edges out).  Joined on (page, band of y).

    ``edges`` instead of ``cells``: the cells are those that ``find_cells`` finds among these rules, in the task that holds
    the page's words too, so that neither is shuffled to meet the other (the result is the same)."""
    k = list(keys)
    if cells is None:
        found = T.StructType([_field(words, c) for c in _WORD] + [T.StructField("c_" + c, T.DoubleType()) for c in ("x0", "top", "x1", "bottom")])
        return _pages_with_words(words, clean_edges(edges, None, s, keys), s, k, _words_with_cells, found)
    w = words.withColumn("_cx", (F.col("x0") + F.col("x1")) / 2).withColumn("_cy", (F.col("top") + F.col("bottom")) / 2)
    w = w.withColumn("_band", _band(F.col("_cy")))
    c = cells.select(
        *k, *[F.col(x).alias("c_" + x) for x in cells.columns if x not in k], F.explode(F.sequence(_band(F.col("top")), _band(F.col("bottom")))).alias("_band")
    )
    hit = (F.col("c_x0") <= F.col("_cx")) & (F.col("_cx") < F.col("c_x1")) & (F.col("c_top") <= F.col("_cy")) & (F.col("_cy") < F.col("c_bottom"))
    return w.join(c, [*k, "_band"]).where(hit).drop("_band", "_cx", "_cy")


_WORD = ("word_no", "word", "x0", "x1", "top", "bottom")


def _field(df: DataFrame, name: str) -> T.StructField:
    double = name in ("x0", "x1", "top", "bottom")
    return T.StructField(name, T.DoubleType() if double else df.schema[name].dataType)


def _pages_with_words(words: DataFrame, edges: DataFrame, s: GridSettings, k: list[str], then, fields: T.StructType) -> DataFrame:
    """``(<keys>, *fields)``: ``then`` of the cells of whole pages (H1) and the pages' words, in one task.

    A page's rules come before its words in one stream of rows.  Rules and words that lie by page or by document already, in as
    many parts, are not shuffled (a union of such tables lies so too)."""
    whole = F.col("pos").isNotNull() & F.col("lo").isNotNull() & F.col("hi").isNotNull()
    kind, no, word = words.schema["word_no"].dataType, F.lit(0), F.lit("")
    rules = edges.where(whole & F.col("orient").isin("v", "h")).select(
        *k,
        F.when(F.col("orient") == "v", 1).otherwise(0).alias("_kind"),
        *[F.col(c).cast("double").alias(a) for c, a in (("pos", "_a"), ("lo", "_b"), ("hi", "_c"))],
        F.lit(0.0).alias("_d"),
        no.cast(kind).alias("word_no"),
        word.alias("word"),
    )
    placed = words.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*k, "x0", "x1", "top", "bottom")]))
    own = {f.name: f.dataType for f in edges.schema.fields}
    same = [F.col(c) if words.schema[c].dataType == own[c] else F.col(c).try_cast(own[c]).alias(c) for c in k]
    placed = placed.select(*same, F.lit(2).alias("_kind"), *[F.col(c).cast("double").alias(a) for c, a in (("x0", "_a"), ("x1", "_b"), ("top", "_c"), ("bottom", "_d"))], "word_no", "word")
    # the window asks for the rows of a page together, in one order, and shuffles only if they are not
    page = Window.partitionBy(*k).orderBy("_kind", "_a", "_b", "_c")
    rows = rules.unionByName(placed).withColumn("_n", F.row_number().over(page))
    schema = T.StructType([f for f in edges.schema.fields if f.name in k] + fields.fields)
    tols = (s.intersection_x_tolerance, s.intersection_y_tolerance)
    return rows.mapInPandas(lambda it: _cells_and_words(it, k, tols, then, fields.names), schema)


def _cells_and_words(batches, k, tols, then, names):
    import numpy as np
    import pandas as pd

    from folio.operators.components import whole_groups

    for pdf in whole_groups(batches, k):
        is_rule = pdf["_kind"].to_numpy() < 2
        rules = pdf[is_rule].rename(columns={"_a": "pos", "_b": "lo", "_c": "hi"}).reset_index(drop=True)
        rules["_up"] = rules["_kind"] == 1
        no = (rules["_n"] == 1).to_numpy().cumsum() - 1
        at, cells = _cells_at(rules, no, *_meetings(rules, no, *tols))
        if not len(at):
            continue
        of_batch = (pdf["_n"] == 1).to_numpy().cumsum() - 1
        page_of = np.full(of_batch[-1] + 1, -1)  # a page of the batch among those that have rules
        page_of[of_batch[is_rule]] = no
        words = pdf[~is_rule].rename(columns={"_a": "x0", "_b": "x1", "_c": "top", "_d": "bottom"})
        page = page_of[of_batch[~is_rule]]
        words, page = words[page >= 0].reset_index(drop=True), page[page >= 0]
        of, columns = then(no[at], cells, page, words)
        if len(of):
            first = np.flatnonzero(rules["_n"].to_numpy() == 1)
            yield pd.concat([rules.iloc[first[of]][k].reset_index(drop=True), pd.DataFrame(dict(zip(names, columns)))], axis=1)


WORD_CELLS = 1_000_000  # pairs of a word and a cell that are looked at together


def _hits(cell_page, cells, word_page, x0, x1, top, bottom):
    """The places of the (word, cell) pairs where the cell holds the word's centre.

    A word is compared with the cells of its page that begin above its centre, by no more than the page's highest cell."""
    import numpy as np

    c_x0, c_top, c_x1, c_bottom = cells  # by page and top
    cx, cy = (x0 + x1) / 2, (top + bottom) / 2
    high = np.zeros(int(max(cell_page.max(), word_page.max(initial=0))) + 1)
    np.maximum.at(high, cell_page, c_bottom - c_top)

    def before(values, also_equal):
        """How many cells come before the place of each (page, value)."""
        tie = np.r_[np.full(len(c_top), 0 if also_equal else 1), np.full(len(values), 1 if also_equal else 0)]
        order = np.lexsort((tie, np.r_[c_top, values], np.r_[cell_page, word_page]))
        count = np.empty(len(order), dtype="int64")
        count[order] = (order < len(c_top)).cumsum()
        return count[len(c_top) :]

    begin = before(cy - high[word_page] * (1 + 1e-9) - 1e-6, False)
    each = np.maximum(before(cy, True) - begin, 0)
    part = each.cumsum() // WORD_CELLS
    found = []
    for a, b in zip(*((c := np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)])[:-1], c[1:])):
        n = each[a:b]
        w = np.repeat(np.arange(a, b), n)
        c = np.arange(len(w)) - np.repeat(n.cumsum() - n, n) + np.repeat(begin[a:b], n)
        hit = (c_x0[c] <= cx[w]) & (cx[w] < c_x1[c]) & (c_top[c] <= cy[w]) & (cy[w] < c_bottom[c])
        found.append((w[hit], c[hit]))
    return np.concatenate([w for w, _ in found]), np.concatenate([c for _, c in found])


def _places(words):
    return [words[c].to_numpy() for c in ("x0", "x1", "top", "bottom")]


def _words_with_cells(cell_page, cells, word_page, words):
    if not len(words):
        return [], []
    w, c = _hits(cell_page, cells, word_page, *_places(words))
    return word_page[w], [*(words[x].to_numpy()[w] for x in _WORD), *(x[c] for x in cells)]


def _dense(group, value):
    """The dense rank of each value inside its group, from 0."""
    import numpy as np

    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    new = np.r_[True, np.diff(g) != 0]
    step = (new | np.r_[True, np.diff(v) != 0]).cumsum()
    out = np.empty(len(order), dtype="int64")
    out[order] = step - step[new][new.cumsum() - 1]
    return out


def _rows_of_tables(cell_page, cells, word_page, words):
    """The rows of the tables (H2, H3): (table_no, row_no, the texts of its slots)."""
    import numpy as np

    x0, top = cells[:2]
    table, number = _tables_at(cell_page, *cells)
    row, col = _dense(table, top), _dense(table, x0)
    n_rows, n_cols = np.zeros(len(number), dtype="int64"), np.zeros(len(number), dtype="int64")
    np.maximum.at(n_rows, table, row + 1)
    np.maximum.at(n_cols, table, col + 1)
    begin = n_rows.cumsum() - n_rows
    texts = [[None] * n for n in np.repeat(n_cols, n_rows).tolist()]
    text = [""] * len(table)
    if len(words):
        for c, t in _texts(*_hits(cell_page, cells, word_page, *_places(words)), words):
            text[c] = t
    for r, c, t in zip((begin[table] + row).tolist(), col.tolist(), text):
        texts[r][c] = t
    of = np.repeat(np.arange(len(number)), n_rows)
    page = np.empty(len(number), dtype="int64")
    page[table] = cell_page
    return page[of], [number[of].astype("int32"), (np.arange(len(of)) - begin[of]).astype("int32"), texts]


def _texts(w, c, words, y_tol: float = 3):
    """(cell, text) of the cells that hold words: the lines (E5) of each, joined by newlines, as ``layout.page_text`` does."""
    import numpy as np
    import pandas as pd

    if not len(w):
        return
    top, x0, no, word = (words[x].to_numpy()[w] for x in ("top", "x0", "word_no", "word"))
    order = np.lexsort((top, c))
    c, top = c[order], top[order]
    new_cell = np.r_[True, np.diff(c) != 0]
    line = (new_cell | np.r_[True, np.diff(top) > y_tol]).cumsum()
    x0, no, word = x0[order], no[order], word[order]
    none = pd.isna(no)
    no = np.where(none, 0, no)
    spelled = np.array([x is not None for x in word])
    if len(word) > len({*zip(line.tolist(), x0.tolist(), no.tolist())}):  # words of one place and number: by their letters
        rank = {x: i for i, x in enumerate(sorted(set(word[spelled])))}
        letters = np.array([-1 if x is None else rank[x] for x in word])
    else:
        letters = np.zeros(len(word))
    order = np.lexsort((letters, no, ~none, x0, line))
    word, line, c, spelled = word[order], line[order], c[order], spelled[order]
    begins = np.flatnonzero(np.r_[True, np.diff(line) != 0]).tolist()
    ends = [*begins[1:], len(line)]
    lines = [word[a] if b == a + 1 and spelled[a] else " ".join(x for x in word[a:b] if x is not None) for a, b in zip(begins, ends)]
    cells = c[begins]
    begins = np.flatnonzero(np.r_[True, np.diff(cells) != 0]).tolist()
    for a, b in zip(begins, [*begins[1:], len(lines)]):
        yield int(cells[a]), "\n".join(lines[a:b])


def crop_edges(edges: DataFrame, box, of: Column | None = None) -> DataFrame:
    """B8 for rules: keep the rules that touch ``box`` and clip their span to it; with ``of``, only rows where it holds."""
    bx0, bt, bx1, bb = (F.lit(float(b)) for b in box) if of is None else unbounded(box, of)
    h = F.col("orient") == "h"
    x0 = F.when(h, F.col("lo")).otherwise(F.col("pos"))
    x1 = F.when(h, F.col("hi")).otherwise(F.col("pos"))
    top = F.when(h, F.col("pos")).otherwise(F.col("lo"))
    bottom = F.when(h, F.col("pos")).otherwise(F.col("hi"))
    ow = F.least(x1, bx1) - F.greatest(x0, bx0)
    oh = F.least(bottom, bb) - F.greatest(top, bt)
    keep = (ow >= 0) & (oh >= 0) & ((ow + oh) > 0)
    lo = F.when(h, F.greatest("lo", bx0)).otherwise(F.greatest("lo", bt))
    hi = F.when(h, F.least("hi", bx1)).otherwise(F.least("hi", bb))
    return edges.where(keep if of is None else ~of | keep).withColumn("lo", lo).withColumn("hi", hi)


def extract_tables(
    words: DataFrame,
    edges: DataFrame,
    pages: DataFrame | None = None,
    s: GridSettings = DEFAULT,
    keys=PAGE_KEYS,
    crop_box=None,
) -> DataFrame:
    """H3: ``(<keys>, table_no, row_no, col_no, txt)``; a slot without a cell is null, a cell
    without words is ''; the words of a cell become lines (E5) joined with newlines.

    ``crop_box`` (the reference's ``crop=True`` uses the A4 box (3, 70, 590, 770)) crops
    the page's rules and words before the tables are found, as the main parser does for
    tables only."""
    return table_rows(words, edges, pages, s, keys, crop_box).select(*keys, "table_no", "row_no", F.posexplode("txts").alias("col_no", "txt"))


def table_rows(
    words: DataFrame,
    edges: DataFrame,
    pages: DataFrame | None = None,
    s: GridSettings = DEFAULT,
    keys=PAGE_KEYS,
    crop_box=None,
) -> DataFrame:
    """H3, a row of a table at a time: ``(<keys>, table_no, row_no, txts)``, the texts of its slots in order.

    The cells of a page are found (H1), made tables (H2) and given their words (C3) and these lines (E5) in one task; only
    the text of the cells leaves it."""
    if crop_box is not None:
        edges = crop_edges(edges, crop_box)
        words = crop(words, crop_box)
    edges = clean_edges(strategy_edges(edges, words, s, keys), pages, s, keys)
    row = T.StructType().add("table_no", T.IntegerType()).add("row_no", T.IntegerType()).add("txts", T.ArrayType(T.StringType()))
    return _pages_with_words(words, edges, s, list(keys), _rows_of_tables, row)
