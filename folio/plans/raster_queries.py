"""Registered queries: raster operators over the F7 pixel images and F9 regions."""

from __future__ import annotations


from folio.operators import contours as C
from folio.operators import raster as K
from folio.plans.registry import query
from folio.sources import fixtures as fx


def refl(i: str, n: str) -> str:
    return f"(case when {i} < 0 then -({i}) when {i} >= {n} then 2 * {n} - 2 - ({i}) else {i} end)"


DIMS = ("dims", "select image_id, max(y) + 1 as h, max(x) + 1 as w from pixels group by image_id")
PLANES = (
    "planes",
    """select image_id // 3 as image_id,
       unnest(case when image_id < (select max(vec_id) from embeddings) then [['b', 'g', 'r'][image_id % 3 + 1]] else ['b', 'g', 'r'][image_id % 3 + 1:] end) as channel,
       y, x, v from pixels""",
)
GRAY_SQL = """select image_id, y, x, cast((sum(case channel when 'r' then 299 when 'g' then 587 else 114 end * v) + 500) // 1000 as int) as v
from planes group by image_id, y, x having count(distinct channel) = 3"""


def _kernel_values(offsets) -> str:
    return "(values " + ", ".join(f"({dy}, {dx}, {w})" for dy, dx, w in offsets) + ")"


def conv_sql(src: str, dims: str, offsets, out: str = "s") -> str:
    """DuckDB: sum of w * v at the reflected neighbours, per pixel of ``src``."""
    return f"""select t.image_id, t.y, t.x, sum(t.w * n.v) as {out}
from (select p.image_id, p.y, p.x, k.w, {refl('p.y + k.dy', 'd.h')} as sy, {refl('p.x + k.dx', 'd.w')} as sx
      from {src} p join {dims} d on p.image_id = d.image_id cross join {_kernel_values(offsets)} k(dy, dx, w)) t
join {src} n on n.image_id = t.image_id and n.y = t.sy and n.x = t.sx
group by t.image_id, t.y, t.x"""


def sep_sql(src: str, dims: str, weights) -> list[tuple[str, str]]:
    r = len(weights) // 2
    xo = [(0, i - r, w) for i, w in enumerate(weights)]
    yo = [(i - r, 0, w) for i, w in enumerate(weights)]
    return [
        (f"{src}_xs", conv_sql(src, dims, xo, "v")),
        (f"{src}_ys", conv_sql(f"{src}_xs", dims, yo, "s")),
        (f"{src}_ws", f"select a.image_id, a.y, a.x, p.v, a.s from {src}_ys a join {src} p on a.image_id = p.image_id and a.y = p.y and a.x = p.x"),
    ]


SHARPEN_OFFSETS = [(dy - 1, dx - 1, K.SHARPEN[dy][dx]) for dy in range(3) for dx in range(3)]


@query("to_gray", ("pixels",), "select * from gray", [PLANES, ("gray", GRAY_SQL)])
def q_to_gray(spark, d):
    return K.to_gray(fx.planes(spark, d))


@query(
    "sharpen",
    ("pixels",),
    "select image_id, y, x, cast(greatest(0, least(255, s)) as int) as v from sh",
    [DIMS, ("sh", conv_sql("pixels", "dims", SHARPEN_OFFSETS))],
)
def q_sharpen(spark, d):
    return K.convolve(fx.pixels(spark, d), K.SHARPEN)


@query(
    "preprocess",
    ("pixels",),
    "select image_id, y, x, cast(greatest(0, least(255, s)) as int) as v from sh",
    [PLANES, ("gray", GRAY_SQL), ("dims", "select image_id, max(y) + 1 as h, max(x) + 1 as w from gray group by image_id"), ("sh", conv_sql("gray", "dims", SHARPEN_OFFSETS))],
)
def q_preprocess(spark, d):
    return K.preprocess(fx.planes(spark, d))


BLUR_W = K.binomial(9)
BLUR_T = sum(BLUR_W) ** 2


@query(
    "blur",
    ("pixels",),
    f"select image_id, y, x, cast((s + {BLUR_T // 2}) // {BLUR_T} as int) as v from pixels_ws",
    [DIMS, *sep_sql("pixels", "dims", BLUR_W)],
)
def q_blur(spark, d):
    return K.blur(fx.pixels(spark, d), 9)


THR_W = K.binomial(11)
THR_T = sum(THR_W) ** 2
THRESHOLD_C = 5  # the fixture's 8x8 images are smooth; 5 makes both outcomes occur


@query(
    "adaptive_threshold",
    ("pixels",),
    f"select image_id, y, x, cast(case when v <= (s + {THR_T // 2}) // {THR_T} - {THRESHOLD_C} then 255 else 0 end as int) as v from pixels_ws",
    [DIMS, *sep_sql("pixels", "dims", THR_W)],
)
def q_adaptive_threshold(spark, d):
    return K.adaptive_threshold(fx.pixels(spark, d), 11, THRESHOLD_C)


def dilate_sql(src: str, r: int) -> str:
    return f"""select image_id, y, x, max(v) over (partition by image_id, x order by y range between {r} preceding and {r} following) as v
from (select image_id, y, x, max(v) over (partition by image_id, y order by x range between {r} preceding and {r} following) as v from {src}) a"""


@query("dilate", ("pixels",), dilate_sql("pixels", 1))
def q_dilate(spark, d):
    return K.dilate(fx.pixels(spark, d), size=3, iterations=1)


def regions_ctes(src: str, min_v: int) -> list[tuple[str, str]]:
    return [
        ("fg", f"select image_id, y, x, row_number() over (order by image_id, y, x) as id from {src} where v >= {min_v}"),
        (
            "adj",
            """select a.id as a, b.id as b from fg a join fg b on a.image_id = b.image_id
  and abs(a.y - b.y) <= 1 and abs(a.x - b.x) <= 1 and a.id <> b.id""",
        ),
        (
            "cc(id, lab) using key (id)",
            """select id, id from fg
union
select u.b as id, min(c.lab) as lab
from cc c join adj u on c.id = u.a join recurring.cc r on r.id = u.b
group by u.b, r.lab having min(c.lab) < r.lab""",
        ),
        (
            "reg",
            """select f.image_id, min(f.x) as x, min(f.y) as y, max(f.x) - min(f.x) + 1 as w, max(f.y) - min(f.y) + 1 as h, count(*) as area
from fg f join cc c on f.id = c.id group by f.image_id, c.lab""",
        ),
    ]


REGION_MIN_V = 128


@query("regions", ("pixels",), "select * from reg", regions_ctes("pixels", REGION_MIN_V), recursive=True)
def q_regions(spark, d):
    return K.regions(fx.pixels(spark, d), min_v=REGION_MIN_V)


def contour_ctes(src: str, min_v: int) -> list[tuple[str, str]]:
    """Contours by flooding: what the outside can't reach without crossing a component is the component filled up."""
    around4 = "abs(g.y - r.y) + abs(g.x - r.x) = 1"
    around8 = "abs(g.y - r.y) <= 1 and abs(g.x - r.x) <= 1"
    return [
        *regions_ctes(src, min_v)[:3],
        ("frame materialized", f"select image_id, max(y) + 1 as h, max(x) + 1 as w from {src} group by image_id"),
        (
            "grid materialized",
            """select c.image_id, c.y, c.x, cc.lab
from (select image_id, y, unnest(range(-1, w + 1)) as x from (select image_id, w, unnest(range(-1, h + 1)) as y from frame) a) c
left join fg f on f.image_id = c.image_id and f.y = c.y and f.x = c.x left join cc on cc.id = f.id""",
        ),
        ("bg materialized", "select *, row_number() over (order by image_id, y, x) as id from grid where lab is null"),
        ("badj materialized", f"select r.id as a, g.id as b from bg r join bg g on r.image_id = g.image_id and {around4}"),
        (
            "bc(id, lab) using key (id)",
            """select id, id from bg
union
select u.b as id, min(c.lab) as lab
from bc c join badj u on c.id = u.a join recurring.bc r on r.id = u.b
group by u.b, r.lab having min(c.lab) < r.lab""",
        ),
        ("blank materialized", "select b.image_id, b.y, b.x, c.lab, min(c.lab) over (partition by b.image_id) as outside from bg b join bc c on b.id = c.id"),
        (
            "cells materialized",
            """select image_id, y, x, false as hole, lab from grid where lab is not null
union all select image_id, y, x, true, lab from blank where lab <> outside""",
        ),
        ("shapes materialized", "select distinct image_id, hole, lab from cells"),
        (
            "reached(image_id, hole, lab, y, x)",
            f"""select image_id, hole, lab, -1, -1 from shapes
union
select r.image_id, r.hole, r.lab, g.y, g.x
from reached r join grid g on g.image_id = r.image_id and case when r.hole then {around8} else {around4} end
where not exists (select 1 from cells c where c.image_id = r.image_id and c.hole = r.hole and c.lab = r.lab and c.y = g.y and c.x = g.x)""",
        ),
        (
            "windows",
            """select image_id, hole, lab, wy, wx, count(*) as k
from (select s.image_id, s.hole, s.lab, g.y + o.dy as wy, g.x + o.dx as wx
      from shapes s join grid g on g.image_id = s.image_id cross join (values (0, 0), (0, -1), (-1, 0), (-1, -1)) o(dy, dx)
      where not exists (select 1 from reached r where r.image_id = s.image_id and r.hole = s.hole and r.lab = s.lab and r.y = g.y and r.x = g.x)) f
group by all""",
        ),
        (
            "areas",
            "select image_id, hole, lab, sum(case when k = 4 then 1.0 when hole then case when k = 1 then 0.5 else 1.0 end when k = 3 then 0.5 else 0.0 end) as area from windows group by all",
        ),
        (
            "found",
            """select image_id, hole, lab, min(x) - hole::int as x, min(y) - hole::int as y, max(x) - min(x) + 1 + 2 * hole::int as w,
       max(y) - min(y) + 1 + 2 * hole::int as h, min(y * 100000 + x) as first_cell, arg_min(x, y * 100000 + x) as fx, min(y) as fy
from cells group by image_id, hole, lab""",
        ),
        ("ranked", "select *, row_number() over (partition by image_id order by first_cell) - 1 as contour_no from found"),
        (
            "cnt",
            """select r.image_id, r.contour_no::int as contour_no, r.hole, coalesce(p.contour_no, -1)::int as parent_no, r.x::int as x, r.y::int as y, r.w::int as w, r.h::int as h, a.area::double as area
from ranked r join areas a on a.image_id = r.image_id and a.hole = r.hole and a.lab = r.lab
left join grid g on r.hole and g.image_id = r.image_id and g.y = r.fy and g.x = r.fx - 1
left join ranked p on p.image_id = r.image_id and not p.hole and p.lab = g.lab""",
        ),
    ]


@query("contours", ("pixels",), "select * from cnt", contour_ctes("pixels", REGION_MIN_V), recursive=True)
def q_contours(spark, d):
    return C.contours(fx.pixels(spark, d), min_v=REGION_MIN_V)


@query("filter_regions", ("regions",), "select image_id, x, y, w, h, area from regions where area > 10000 and w > h and h < 0.3 * img_h")
def q_filter_regions(spark, d):
    return K.filter_regions(fx.regions(spark, d)).select("image_id", "x", "y", "w", "h", "area")


@query(
    "number_regions",
    ("regions",),
    """select image_id, x, y, w, h, area, row_number() over (partition by image_id order by y, x, w, h) - 1 as roi,
       concat('ROI_', row_number() over (partition by image_id order by y, x, w, h) - 1, '.jpg') as name
from (select distinct image_id, x, y, w, h, area from regions where area > 10000 and w > h and h < 0.3 * img_h) r""",
)
def q_number_regions(spark, d):
    return K.number_regions(fx.regions(spark, d))


@query("region_count", ("regions",), "select image_id, count(*) as n_regions from regions group by image_id")
def q_region_count(spark, d):
    return K.region_count(fx.regions(spark, d))


@query(
    "region_pixels",
    ("pixels", "pixel_regions"),
    """select p.image_id, p.y - r.y as ry, p.x - r.x as rx, p.v
from pixels p join pixel_regions r on p.image_id = r.image_id
where p.y >= r.y and p.y < r.y + r.h and p.x >= r.x and p.x < r.x + r.w""",
)
def q_region_pixels(spark, d):
    return K.region_pixels(fx.pixels(spark, d), fx.pixel_regions(spark, d))


# the fixture's images are 8x8: a 3x3 dilation once, regions of at least 2 pixels, up to the image height
TEXT_REGION_PARAMS = dict(blur_size=9, block=11, c=THRESHOLD_C, dilate_size=3, iterations=1, min_area=2, max_h_ratio=1.0)


@query(
    "find_text_regions",
    ("pixels",),
    """select image_id, x, y, w, h, area, row_number() over (partition by image_id order by y, x, w, h) - 1 as roi,
       concat('ROI_', row_number() over (partition by image_id order by y, x, w, h) - 1, '.jpg') as name
from (select distinct r.image_id, r.x, r.y, r.w, r.h, r.area from cnt r join gdims g on r.image_id = g.image_id
      where r.area > 2 and r.w > r.h and r.h < 1.0 * g.h) k""",
    [
        PLANES,
        ("gray", GRAY_SQL),
        ("gdims", "select image_id, max(y) + 1 as h, max(x) + 1 as w from gray group by image_id"),
        *sep_sql("gray", "gdims", BLUR_W),
        ("blurred", f"select image_id, y, x, cast((s + {BLUR_T // 2}) // {BLUR_T} as int) as v from gray_ws"),
        *sep_sql("blurred", "gdims", THR_W),
        ("thr", f"select image_id, y, x, case when v <= (s + {THR_T // 2}) // {THR_T} - {THRESHOLD_C} then 255 else 0 end as v from blurred_ws"),
        ("mask materialized", dilate_sql("thr", 1)),
        *contour_ctes("mask", 1),
    ],
    recursive=True,
)
def q_find_text_regions(spark, d):
    return K.find_text_regions(fx.planes(spark, d), **TEXT_REGION_PARAMS).select("image_id", "x", "y", "w", "h", "area", "roi", "name")
