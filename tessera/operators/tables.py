"""Tables of a page recovered from its drawn rules: lines that cross make cells, cells that share lines make a table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..sources import scratch

#: How far apart lines may lie that are meant to be one, and their ends that are meant to meet.
SNAP, REACH = 3.0, 3.0
_PAGE = ["stem", "page"]


def segments(rules: DataFrame, snap: float = SNAP, reach: float = REACH) -> DataFrame:
    """stem, page, kind (h or v), at, a, b, id of rules(stem, page, x0, y0, x1, y1): lines snapped to each other and merged.

    A rule whose ends differ by no more than snap in one direction is a line in the other; the rest, and points, are
    left out. Lines of one kind whose places follow each other within snap take the least of these places, and those at
    one place that overlap, or leave no more than reach between them, become one.
    """
    x, y = F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0"))
    kind = F.when((y <= snap) & (x > snap), "h").when((x <= snap) & (y > snap), "v")
    ends = lambda c: (F.least(f"{c}0", f"{c}1"), F.greatest(f"{c}0", f"{c}1"))
    pick = lambda h, v: F.when(F.col("kind") == "h", h).otherwise(v)
    lines = rules.withColumn("kind", kind).where("kind is not null")
    lines = lines.select(*_PAGE, "kind", pick(ends("y")[0], ends("x")[0]).alias("at"), pick(ends("x")[0], ends("y")[0]).alias("a"), pick(ends("x")[1], ends("y")[1]).alias("b"))
    by_place = Window.partitionBy(*_PAGE, "kind").orderBy("at")
    new = F.coalesce((F.col("at") - F.lag("at").over(by_place) > snap).cast("int"), F.lit(0))
    lines = lines.withColumn("new", new).withColumn("line", F.sum("new").over(by_place))
    along = Window.partitionBy(*_PAGE, "kind", "line").orderBy("a", "b")
    far = F.max("b").over(along.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.withColumn("apart", F.coalesce((F.col("a") > far + reach).cast("int"), F.lit(0))).withColumn("part", F.sum("apart").over(along))
    place = F.min("at").over(Window.partitionBy(*_PAGE, "kind", "line"))
    merged = lines.withColumn("at", place).groupBy(*_PAGE, "kind", "line", "part").agg(F.min("at").alias("at"), F.min("a").alias("a"), F.max("b").alias("b"))
    return merged.select(*_PAGE, "kind", "at", "a", "b", F.concat_ws(":", "kind", "line", "part").alias("id"))


def crossings(lines: DataFrame, reach: float = REACH) -> DataFrame:
    """stem, page, x, y, h, v: where a horizontal and a vertical line of segments() meet, or come within reach of it."""
    h = lines.where("kind = 'h'").select(*_PAGE, F.col("at").alias("y"), F.col("a").alias("ha"), F.col("b").alias("hb"), F.col("id").alias("h"))
    v = lines.where("kind = 'v'").select(*_PAGE, F.col("at").alias("x"), F.col("a").alias("va"), F.col("b").alias("vb"), F.col("id").alias("v"))
    meet = F.col("x").between(F.col("ha") - reach, F.col("hb") + reach) & F.col("y").between(F.col("va") - reach, F.col("vb") + reach)
    return h.join(v.hint("merge"), _PAGE).where(meet).select(*_PAGE, "x", "y", "h", "v")


def cells(points: DataFrame) -> DataFrame:
    """stem, page, x0, y0, x1, y1, h: the smallest rectangles whose corners are crossings and whose sides are lines.

    From each crossing the nearest one along its lines that closes a rectangle: first the least height, then the least
    width. h is the line along the top.
    """
    p = scratch.table(points, "crossings")
    name = lambda c: {o: F.col(f"{c}.{o}") for o in ("x", "y", "h", "v")}
    a, b, c, d = (name(n) for n in "abcd")
    on = lambda n: [F.col(f"a.{k}").eqNullSafe(F.col(f"{n}.{k}")) for k in _PAGE]
    both = lambda n, *more: [*on(n), *more]
    # Sorted and merged: files of few bytes hold many rows, too many to be broadcast.
    side = lambda n: p.alias(n).hint("merge")
    beside = p.alias("a").join(side("b"), both("b", a["h"] == b["h"], b["x"] > a["x"])).join(side("c"), both("c", a["v"] == c["v"], c["y"] > a["y"]))
    closed = beside.join(side("d"), both("d", d["h"] == c["h"], d["v"] == b["v"]))
    size = F.struct((c["y"] - a["y"]).alias("height"), (b["x"] - a["x"]).alias("width"), c["y"].alias("y1"), b["x"].alias("x1"))
    least = closed.groupBy(*[F.col(f"a.{k}").alias(k) for k in _PAGE], a["x"].alias("x0"), a["y"].alias("y0"), a["h"].alias("h"), a["v"].alias("v")).agg(F.min(size).alias("s"))
    return least.select(*_PAGE, "x0", "y0", "s.x1", "s.y1", "h", "v")


def _grouped(found: pd.DataFrame) -> pd.DataFrame:
    """The cells of one page with the number of their table: cells that share a corner are of one table."""
    root = list(range(len(found)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    at: dict[tuple, int] = {}
    found = found.sort_values(["y0", "x0"]).reset_index(drop=True)
    for i, r in enumerate(found.itertuples(index=False)):
        for corner in ((r.x0, r.y0), (r.x0, r.y1), (r.x1, r.y0), (r.x1, r.y1)):
            j = at.setdefault(corner, i)
            root[max(find(i), find(j))] = min(find(i), find(j))
    numbers: dict[int, int] = {}
    return found.assign(table=[numbers.setdefault(find(i), len(numbers)) for i in range(len(found))])


def grids(rules: DataFrame, words: DataFrame, snap: float = SNAP, reach: float = REACH, gap: str = " ") -> DataFrame:
    """stem, page, tables of pages with rules(stem, page, x0, y0, x1, y1) and words(stem, page, x, y, text).

    tables is an array of tables from top to bottom, each an array of rows of cell texts, as files.from_pages() takes
    them. A word belongs to the cell that its point lies in; a cell's words are joined from top to bottom and left to right.
    Where a cell reaches over several rows or columns it stands at its first, and the others are empty. Pages whose lines
    close no rectangle have no row. What a task holds at once are the cells of one page.
    """
    found = cells(crossings(segments(rules, snap, reach), reach)).select(*_PAGE, "x0", "y0", "x1", "y1")
    schema = T.StructType([*found.schema, T.StructField("table", T.IntegerType())])
    placed = scratch.table(found.groupBy(*_PAGE).applyInPandas(_grouped, schema), "cells")
    key = [*_PAGE, "table"]
    rank = lambda c: F.dense_rank().over(Window.partitionBy(*key).orderBy(c)) - 1
    sized = placed.withColumn("row", rank("y0")).withColumn("column", rank("x0"))
    inside = (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1"))
    said = sized.join(words.hint("merge"), _PAGE).where(inside).groupBy(*key, "row", "column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "text"))), lambda w: w["text"]), gap).alias("said"))
    full = sized.select(*key, "row", "column").join(said.hint("merge"), [*key, "row", "column"], "left")
    wide = full.groupBy(*key).agg((F.max("row") + 1).alias("rows"), (F.max("column") + 1).alias("columns"), F.map_from_entries(F.collect_list(F.struct(F.struct("row", "column").alias("k"), F.coalesce("said", F.lit("")).alias("v")))).alias("at"))
    cell = lambda r, c: F.coalesce(F.element_at("at", F.struct(r.alias("row"), c.alias("column"))), F.lit(""))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    rows = F.transform(every("rows"), lambda r: F.transform(every("columns"), lambda c: cell(r, c)))
    return wide.select(*key, rows.alias("grid")).groupBy(*_PAGE).agg(F.transform(F.array_sort(F.collect_list(F.struct("table", "grid"))), lambda t: t["grid"]).alias("tables"))
