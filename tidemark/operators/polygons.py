"""Points in polygons by a quadtree of each polygon's border."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import staged, unstaged

#: Edges of a cell up to which it is not cut further; a cut makes 2 ** STEP cells on each side.
EDGES, STEP = 32, 2
#: Levels of the grid: a finest cell has 2 ** -LEVELS of the side of all polygons' square. A cell that is crowded down there stays so.
LEVELS = 40
#: The square's corner lies off the data by this part of its side, so that cells' sides do not run through edges' ends.
_OFF = 0.0381966011250105
_EDGE = ("x1", "y1", "x2", "y2")


def _above(at: Column | float) -> Column:
    """Whether the height lies between the edge's ends; one that it meets lies below."""
    return (F.col("y1") > at) != (F.col("y2") > at)


def _cross_x(y: Column) -> Column:
    return F.try_divide((F.col("x2") - F.col("x1")) * (y - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1")


def _turns(e, cx: Column, cy: Column, x: Column, y: Column) -> Column:
    """How often the way from (cx, cy) up to y and then right to x crosses an edge."""
    rise = F.try_divide((e["y2"] - e["y1"]) * (cx - e["x1"]), e["x2"] - e["x1"]) + e["y1"]  # null for an upright edge, which is not met
    up = ((e["x1"] > cx) != (e["x2"] > cx)) & (rise > cy) & (rise <= y)
    run = F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"]
    right = ((e["y1"] > y) != (e["y2"] > y)) & (run > cx) & (run <= x)
    return up.cast("int") + right.cast("int")


def _touches(side: Column) -> Column:
    """Whether the edge may meet the cell (cx, cy, side); true for some that do not."""
    wide = side * 1e-9
    lo_x, hi_x, lo_y, hi_y = F.col("cx") - wide, F.col("cx") + side + wide, F.col("cy") - wide, F.col("cy") + side + wide
    box = (F.least("x1", "x2") <= hi_x) & (F.greatest("x1", "x2") >= lo_x) & (F.least("y1", "y2") <= hi_y) & (F.greatest("y1", "y2") >= lo_y)
    at = [(F.col("x2") - F.col("x1")) * (y - F.col("y1")) - (F.col("y2") - F.col("y1")) * (x - F.col("x1")) for x in (lo_x, hi_x) for y in (lo_y, hi_y)]
    return box & (F.least(*at) <= 0) & (F.greatest(*at) >= 0)


def polygon_cells(edges: DataFrame, within: Sequence[str] = ()) -> tuple[DataFrame, tuple[float, float, float]]:
    """(polygon, within, level, i, j, cx, cy, odd, edges), written, and the square (x, y, side) whose cells they are.

    edges: (polygon, x1, y1, x2, y2), closed rings, and the columns of `within`. A polygon starts from the cells of about
    its own size. A cell with more than EDGES edges is cut; one without any is kept if it lies inside, with null edges; any
    other has its own edges, and whether its corner (cx, cy) lies inside. So no row holds a polygon, however long its
    border, and no cell is stored outside or twice over. A polygon is told by its number and `within`.
    """
    keys = [f"w{i}" for i in range(len(within))]
    rows = edges.select("polygon", *[F.col(c).alias(k) for c, k in zip(within, keys, strict=True)], *[F.col(c).cast("double").alias(c) for c in _EDGE])
    own = ["polygon", *keys]
    ends = rows.agg(F.min(F.least("x1", "x2")), F.min(F.least("y1", "y2")), F.max(F.greatest("x1", "x2")), F.max(F.greatest("y1", "y2"))).first()
    x0, y0, x_hi, y_hi = (0.0, 0.0, 1.0, 1.0) if ends[0] is None else ends
    side = max(x_hi - x0, y_hi - y0, 1e-300) * (1 + 2 * _OFF)
    x0, y0 = x0 - side * _OFF, y0 - side * _OFF
    width = lambda level: F.lit(side) / F.pow(F.lit(2.0), level)
    corner = lambda i, level, o: F.lit(o) + F.col(i) * width(F.col(level))
    box = rows.groupBy(*own).agg(F.min(F.least("x1", "x2")).alias("bx"), F.max(F.greatest("x1", "x2")).alias("ex"), F.min(F.least("y1", "y2")).alias("by"), F.max(F.greatest("y1", "y2")).alias("ey"))
    size = F.greatest(F.col("ex") - F.col("bx"), F.col("ey") - F.col("by"), F.lit(side / 2**LEVELS))
    box = box.withColumn("level", F.floor(F.log2(F.lit(side) / size)).cast("int"))
    at = lambda c, o: F.floor((F.col(c) - F.lit(o)) / width(F.col("level"))).cast("long")
    start = box.withColumn("i", F.explode(F.sequence(at("bx", x0), at("ex", x0)))).withColumn("j", F.explode(F.sequence(at("by", y0), at("ey", y0))))  # four at most
    start = start.withColumns({"cx": corner("i", "level", x0), "cy": corner("j", "level", y0)}).drop("bx", "ex", "by", "ey")
    start = start.toDF(*[f"s_{c}" if c in own else c for c in start.columns])
    same = F.lit(True)
    for c in own:
        same = same & F.col(c).eqNullSafe(F.col(f"s_{c}"))
    here = ["level", "i", "j", "cx", "cy"]
    both = rows.join(start, same).withColumns({"cross": (_above(F.col("cy")) & (_cross_x(F.col("cy")) > F.col("cx"))).cast("int"), "in": _touches(width(F.col("level")))})
    told = F.struct(*_EDGE)
    held, kept, level = [], [], 0
    cells = both.groupBy(*own, *here).agg((F.sum("cross") % 2).cast("int").alias("odd"), F.count_if("in").alias("n"))
    front = staged(cells, "cells")
    lines = staged(both.filter("in").select(*own, *here, *_EDGE), "lines")

    def joined(some: DataFrame, lines: DataFrame) -> DataFrame:
        """The edges of some cells, with what is known of the cells."""
        of = some.select(*[F.col(c).alias(f"s_{c}") for c in (*own, "level", "i", "j")], "odd")
        match = F.lit(True)
        for c in (*own, "level", "i", "j"):
            match = match & F.col(c).eqNullSafe(F.col(f"s_{c}"))
        return lines.join(of, match).select(*own, *here, "odd", *_EDGE)

    while True:
        crowded = (F.col("n") > EDGES) & (F.col("level") + STEP <= LEVELS) if level < LEVELS else F.lit(False)
        kept.append(front.filter("n = 0 and odd = 1").select(*own, *here, "odd", F.lit(None).cast("array<struct<x1: double, y1: double, x2: double, y2: double>>").alias("edges")))
        leaves = joined(front.filter((F.col("n") > 0) & ~crowded), lines).groupBy(*own, *here, "odd").agg(F.collect_list(told).alias("edges"))
        kept.append(leaves)
        held += [front, lines]
        cut = front.filter(crowded)
        if cut.isEmpty():
            break
        level += STEP
        parts = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(1 << STEP) for b in range(1 << STEP)]))
        down = joined(cut, lines).withColumns({"px": F.col("cx"), "py": F.col("cy"), "part": parts}).withColumn("level", F.col("level") + STEP)
        down = down.withColumns({"i": F.col("i") * (1 << STEP) + F.col("part.a"), "j": F.col("j") * (1 << STEP) + F.col("part.b")})
        down = down.withColumns({"cx": corner("i", "level", x0), "cy": corner("j", "level", y0)})
        down = down.withColumns({"turns": _turns({c: F.col(c) for c in _EDGE}, F.col("px"), F.col("py"), F.col("cx"), F.col("cy")), "in": _touches(width(F.col("level")))})
        cells = down.groupBy(*own, *here).agg(((F.first("odd") + F.sum("turns")) % 2).cast("int").alias("odd"), F.count_if("in").alias("n"))
        front, lines = staged(cells, "cells"), staged(down.filter("in").select(*own, *here, *_EDGE), "lines")
    out = kept[0]
    for df in kept[1:]:
        out = out.unionByName(df)
    out = staged(out, "cover")
    unstaged(*held)
    return out, (x0, y0, side)


def in_polygons(points: DataFrame, x: str, y: str, edges: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """points with `polygon`: one row for each polygon that holds the point, or null. edges: (polygon, x1, y1, x2, y2), and
    columns of `within`, which the point's of those names must equal.

    A polygon holds a point if a ray to the right crosses an odd number of its edges. A point meets the cells of each
    polygon's cover that it lies in, by an equi-join for the levels that occur: an inner cell holds it without a test, a
    border cell tests its own edges on the way from its corner. Points without coordinates get null; `polygon` replaces a
    column of that name, all others pass through.
    """
    cover, (x0, y0, side) = polygon_cells(edges, within)
    levels = sorted(r.level for r in cover.select("level").distinct().collect())  # LEVELS at most
    names = [c for c in points.columns if c != "polygon"]
    rows = staged(points.select(F.struct(*names).alias("row"), F.monotonically_increasing_id().alias("id")), "points")
    inside = lambda c, o: F.col(f"row.{c}").cast("double").between(o, o + side)
    here = F.coalesce(inside(x, x0) & inside(y, y0), F.lit(False))
    fine = lambda c, o: F.when(here, F.floor((F.col(f"row.{c}").cast("double") - o) / side * float(1 << LEVELS)).cast("long"))
    keyed = rows.select("id", F.col(f"row.{x}").cast("double").alias("x"), F.col(f"row.{y}").cast("double").alias("y"), *[F.col(f"row.{c}").alias(f"v{k}") for k, c in enumerate(within)], fine(x, x0).alias("fi"), fine(y, y0).alias("fj"), here.alias("here"))
    keyed = keyed.filter("here").withColumn("l", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    shifted = lambda c: F.expr(f"shiftright({c}, {LEVELS} - l)")
    on = (F.col("l") == F.col("level")) & (shifted("fi") == F.col("i")) & (shifted("fj") == F.col("j"))
    for k in range(len(within)):
        on = on & (F.col(f"v{k}") == F.col(f"w{k}"))
    turns = F.aggregate("edges", F.col("odd"), lambda n, e: n + _turns(e, F.col("cx"), F.col("cy"), F.col("x"), F.col("y")))
    hits = keyed.join(cover, on).filter(F.col("edges").isNull() | (turns % 2 == 1)).select(F.col("id").alias("hit"), "polygon")
    return rows.join(hits, F.col("id") == F.col("hit"), "left").select("row.*", "polygon")


def census_tracts(points: DataFrame, x: str, y: str, states: DataFrame, tracts: DataFrame, years: Sequence[int]) -> DataFrame:
    """A row for each point and year in which a state and one of its tracts hold it: points' columns, year, State, Tract.

    states: edges (year, polygon, x1, ..); tracts: edges (year, state, polygon, x1, ..), whose state is one of states'
    polygons. A point is looked for in the states, then in the tracts of its state. Points without coordinates, or outside
    all, have no row; a year's names of columns are the caller's to map onto these.
    """
    each = points.withColumn("year", F.explode(F.array(*[F.lit(v) for v in years])))
    placed = in_polygons(each, x, y, states, ["year"]).filter("polygon is not null").withColumnRenamed("polygon", "State")
    found = in_polygons(placed, x, y, tracts.withColumnRenamed("state", "State"), ["year", "State"])
    return found.filter("polygon is not null").withColumnRenamed("polygon", "Tract")
