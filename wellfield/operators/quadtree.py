"""The nearest of many nodes, by cells whose size follows how densely the nodes lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpointed

#: A cell with more nodes is split into SIDE x SIDE cells.
LEAF, SIDE = 64, 8
#: After so many splits a cell's side is a 2^51st of the grid's, less than what tells two doubles apart.
MOST_STEPS = 17


class Quadtree:
    """Cells over nodes (x, y, z). `directory` has a row per split cell (step, cx, cy): its cells that hold nodes, with
    their number and the box around them; SIDE * SIDE entries at most. `leaves` has a row per unsplit cell with its
    nodes, LEAF at most, as no two are at one place. The number of steps follows the densest spot, not the extent."""

    def __init__(self, nodes: DataFrame):
        whole = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
        known = nodes.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "z").where(whole("x") & whole("y"))
        known = checkpointed(known.groupBy("x", "y").agg(F.min("z").alias("z")))
        self.x0, x1, self.y0, y1 = known.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()  # four numbers
        self.directory: list[DataFrame] = []
        self.leaves: list[DataFrame] = []
        if self.x0 is None:
            return
        self.size = max(x1 - self.x0, y1 - self.y0) or 1.0
        for step in range(1, MOST_STEPS + 1):
            placed = known.withColumns({"cx": self._cell("x", self.x0, step), "cy": self._cell("y", self.y0, step)})
            box = [f(c).alias(f"{c}{n}") for c in ("x", "y") for f, n in ((F.min, 0), (F.max, 1))]
            cells = checkpointed(placed.groupBy("cx", "cy").agg(F.count("*").alias("n"), *box))
            up = lambda c: F.shiftright(F.col(c), 3).alias(f"p{c[1]}")
            entry = F.struct("cx", "cy", ((F.col("n") > LEAF) & (step < MOST_STEPS)).alias("split"), "x0", "x1", "y0", "y1")
            self.directory.append(checkpointed(cells.groupBy(up("cx"), up("cy")).agg(F.collect_list(entry).alias("cells"))))
            small = cells.where((F.col("n") <= LEAF) | (step == MOST_STEPS)).select("cx", "cy")
            held = placed.join(small, ["cx", "cy"]).groupBy("cx", "cy").agg(F.collect_list(F.struct("x", "y", "z")).alias("nodes"))
            self.leaves.append(checkpointed(held))
            large = cells.where((F.col("n") > LEAF) & (step < MOST_STEPS)).select("cx", "cy")
            if not large.limit(1).count():
                return
            known = checkpointed(placed.join(large, ["cx", "cy"], "left_semi").select("x", "y", "z"))

    def _cell(self, c: str, low: float, step: int) -> Column:
        """Powers of two times one factor, so that a cell's own cell one step up is its number without the last three bits."""
        return F.least(F.floor((F.col(c) - low) * (SIDE**step * (1 / self.size))), F.lit(SIDE**step - 1)).cast("long")


def _gap(low: Column, high: Column, at: Column) -> Column:
    return F.greatest(low - at, at - high, F.lit(0.0))


def nearest(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """points (id, x, y) with the z of the nearest node (x, y, z), however far; of equally near ones that with the lower
    (x, y), of several at one place the least z. Null without nodes, and for points without a place.

    Points go down a quadtree of the nodes. At each step a point looks at the cells of those that it has left, and keeps
    the ones that may hold a node nearer than the furthest place of the best cell's box. So what a point meets is a few
    lists of bounded length a step, also where it lies far off, or beside a crowd of nodes. `id` is unique."""
    tree = Quadtree(nodes)
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    wanted = points.select("id", x.alias("x"), y.alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    frontier = wanted.withColumns({"cx": F.lit(0).cast("long"), "cy": F.lit(0).cast("long"), "bound": F.lit(float("inf"))})
    best = None
    for directory, leaves in zip(tree.directory, tree.leaves):
        met = frontier.withColumnsRenamed({"cx": "px", "cy": "py"}).join(directory, ["px", "py"])
        x, y = F.col("x"), F.col("y")
        near = lambda c: F.hypot(_gap(c["x0"], c["x1"], x), _gap(c["y0"], c["y1"], y)) * (1 - 1e-12)  # noqa: E731, B023
        far = lambda c: F.hypot(F.greatest(F.abs(x - c["x0"]), F.abs(x - c["x1"])), F.greatest(F.abs(y - c["y0"]), F.abs(y - c["y1"]))) * (1 + 1e-12)  # noqa: E731, B023
        met = met.withColumn("bound", F.least("bound", F.array_min(F.transform("cells", far))))
        met = met.withColumn("bound", F.min("bound").over(Window.partitionBy("id")))
        left = met.select("id", "x", "y", "bound", F.explode(F.filter("cells", lambda c: near(c) <= F.col("bound"))).alias("c"))
        left = checkpointed(left.select("id", "x", "y", "bound", "c.cx", "c.cy", "c.split"))
        at = lambda n: F.struct(F.hypot(n["x"] - x, n["y"] - y).alias("gap"), n["x"].alias("x"), n["y"].alias("y"), n["z"].alias("z"))  # noqa: E731, B023
        seen = left.where("not split").join(leaves, ["cx", "cy"]).select("id", F.array_min(F.transform("nodes", at)).alias("n"))
        best = seen if best is None else best.unionByName(seen)
        frontier = left.where("split").select("id", "x", "y", "cx", "cy", "bound")
    if best is None:
        return points.withColumn("z", F.lit(None).cast("double"))
    found = best.groupBy("id").agg(F.min("n").alias("n")).select("id", F.col("n.z").alias("z"))
    return points.join(found, "id", "left")
