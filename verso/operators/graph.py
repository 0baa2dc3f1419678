"""Navigation graph of a page's whitespace, port choice, border penalty and shortest paths."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nodes(gutters: DataFrame, slits: DataFrame, docks: DataFrame) -> DataFrame:
    """(page_num, node_id, x, y, kind, chain, pos, port_of, compass): ids in the order ends, slit crossings, ports.

    A node with chain belongs to that gutter's or slit's chain at pos; a port has none.
    """
    g = gutters.select("page_num", "gutter_id", "line_idx_a", "line_idx_b", F.col("x0").cast("double").alias("x0"), F.col("x1").cast("double").alias("x1"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"))
    none, no_long, no_text = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("string")
    key = lambda phase, a, b=0, c=0, d=0: F.struct(F.lit(phase).alias("p"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"), F.lit(c).alias("c"), F.lit(d).alias("d"))
    ends = g.select("page_num", F.explode(F.array(*(F.struct(key(0, F.col("gutter_id"), i).alias("k"), F.col(x).alias("x"), F.col("cy").alias("y"), F.lit("gutter_end").alias("kind"), F.col("gutter_id").alias("chain"), F.col(x).alias("pos")) for i, x in enumerate(("x0", "x1"))))).alias("n"))
    above = g.where("line_idx_b is not null").select("page_num", F.col("line_idx_b").alias("line"), F.col("gutter_id").alias("up"), F.col("cy").alias("up_y"))
    below = g.where("line_idx_a is not null").select("page_num", F.col("line_idx_a").alias("line"), F.col("gutter_id").alias("down"), F.col("cy").alias("down_y"))
    s = slits.select("page_num", F.col("gutter_id").alias("slit"), F.col("line_idx_a").alias("line"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"), "y0", "y1").join(above, ["page_num", "line"], "left").join(below, ["page_num", "line"], "left")

    def crossing(i: int, gutter: str, at: str, edge: str) -> Column:
        y = F.coalesce(F.col(at), F.col(edge).cast("double"))
        return F.struct(key(1, F.col("slit"), i).alias("k"), F.col("cx").alias("x"), y.alias("y"), F.when(F.col(gutter).isNull(), "slit_end").otherwise("intersection").alias("kind"), F.col(gutter).alias("chain"), F.col("cx").alias("pos"))

    crossings = s.select("page_num", "slit", F.explode(F.array(crossing(0, "up", "up_y", "y0"), crossing(1, "down", "down_y", "y1"))).alias("n"))
    p = docks.select("page_num", "word_id", "line_idx", F.posexplode("ports").alias("i", "p")).select("page_num", "word_id", "line_idx", "i", "p.*")
    axis = g.select("page_num", "gutter_id", "cy", F.lit(None).cast("double").alias("cx")).unionAll(slits.select("page_num", "gutter_id", F.lit(None).cast("double"), (F.col("x0") + F.col("x1")) / 2))
    p = p.join(axis, ["page_num", "gutter_id"], "left")
    level = F.col("compass").isin("N", "S")
    port = F.struct(key(2, F.col("line_idx"), F.col("word_id"), F.col("i"), 0).alias("k"), F.col("x").alias("x"), F.col("y").alias("y"), F.lit("port").alias("kind"), none.alias("chain"), F.lit(None).cast("double").alias("pos"))
    inject = F.struct(key(2, F.col("line_idx"), F.col("word_id"), F.col("i"), 1).alias("k"), F.when(level, F.col("x")).otherwise(F.col("cx")).alias("x"), F.when(level, F.col("cy")).otherwise(F.col("y")).alias("y"), F.lit("inject").alias("kind"), F.col("gutter_id").alias("chain"), F.when(level, F.col("x")).otherwise(F.col("y")).alias("pos"))
    ports = p.select("page_num", "word_id", "compass", F.explode(F.array(port, inject)).alias("n"))
    all_ = ends.select("page_num", "n", none.alias("slit"), no_long.alias("word_id"), no_text.alias("compass")).unionAll(crossings.select("page_num", "n", "slit", no_long, no_text)).unionAll(ports.select("page_num", "n", none, "word_id", "compass"))
    number = F.row_number().over(Window.partitionBy("page_num").orderBy("n.k.p", "n.k.a", "n.k.b", "n.k.c", "n.k.d")) - 1
    return all_.select("page_num", number.alias("node_id"), F.col("n.x").alias("x"), F.col("n.y").alias("y"), F.col("n.kind").alias("kind"), F.col("n.chain").alias("chain"), F.col("n.pos").alias("pos"), "slit", "word_id", "compass", F.col("n.k.c").alias("nth"))


def edges(nodes_: DataFrame, gutters: DataFrame, slits: DataFrame) -> DataFrame:
    """(page_num, src, dst, cost, gutter_id), both directions: chains, near-duplicates at no cost, ports to their chains.

    slits need river_score. A chain's links cost their length, less along rivers and more through narrow slits, 0.5 at least.
    """
    ends = gutters.select("page_num", F.col("gutter_id").alias("c"), F.lit(1.0).alias("mult"))
    narrow = F.greatest(F.lit(1.0), 8.0 / F.greatest(F.lit(1.0), (F.col("x1") - F.col("x0")).cast("double")))
    chains = ends.unionAll(slits.select("page_num", F.col("gutter_id").alias("c"), narrow * (1.0 - 0.4 * F.col("river_score"))))
    in_chain = nodes_.where("chain is not null").select("page_num", "node_id", F.col("chain").alias("c"), "pos")
    through = nodes_.where("slit is not null").select("page_num", "node_id", F.col("slit").alias("c"), F.col("y").alias("pos"))
    order = Window.partitionBy("page_num", "c").orderBy("pos", "node_id")
    linked = in_chain.unionAll(through).select("page_num", "c", "node_id", "pos", F.lead("node_id").over(order).alias("dst"), F.lead("pos").over(order).alias("to")).where("dst is not null").join(chains, ["page_num", "c"])
    step = F.col("to") - F.col("pos")
    costs = F.array_compact(F.array(F.when(step <= 1.0, F.lit(0.0)), F.greatest(F.lit(0.5), step * F.col("mult"))))
    chain = linked.select("page_num", F.col("node_id").alias("a"), F.col("dst").alias("b"), F.explode(costs).alias("cost"), F.col("c").alias("gutter_id"))
    pair = nodes_.where("word_id is not null").groupBy("page_num", "word_id", "nth").agg(F.min("node_id").alias("a"), F.max("node_id").alias("b"), F.max("chain").alias("gutter_id"), F.min_by("x", "node_id").alias("ax"), F.min_by("y", "node_id").alias("ay"), F.max_by("x", "node_id").alias("bx"), F.max_by("y", "node_id").alias("by"))
    spur = pair.where("a <> b").select("page_num", "a", "b", F.sqrt((F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2).alias("cost"), "gutter_id")
    one = chain.unionAll(spur)
    both = F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst"))))
    return one.select("page_num", both.alias("e"), "cost", "gutter_id").select("page_num", "e.src", "e.dst", "cost", "gutter_id")


def adjacency(nodes_: DataFrame, edges_: DataFrame) -> DataFrame:
    """The page_graph table: nodes with edges as an array of (dst, cost, gutter_id)."""
    listed = edges_.groupBy("page_num", F.col("src").alias("node_id")).agg(F.sort_array(F.collect_list(F.struct("dst", "cost", "gutter_id"))).alias("edges"))
    return nodes_.join(listed, ["page_num", "node_id"], "left").select("page_num", "node_id", "x", "y", "kind", F.coalesce("edges", F.array().cast("array<struct<dst:int,cost:double,gutter_id:int>>")).alias("edges"))


def penalize_borders(nodes_: DataFrame, edges_: DataFrame, bodies: DataFrame, margin: float = 30, penalty: float = 30) -> DataFrame:
    """edges with the cost of those multiplied whose two ends are within margin of the same border."""
    n = nodes_.select("page_num", "node_id", "x", "y")
    b = bodies.select("page_num", *(F.col(c).alias("b" + c) for c in ("x0", "y0", "x1", "y1")))
    met = edges_.join(n.select("page_num", F.col("node_id").alias("src"), F.col("x").alias("sx"), F.col("y").alias("sy")), ["page_num", "src"]).join(n.select("page_num", F.col("node_id").alias("dst"), F.col("x").alias("tx"), F.col("y").alias("ty")), ["page_num", "dst"], "left").join(b, "page_num")
    near = (F.greatest("sy", "ty") <= F.col("by0") + margin) | (F.least("sy", "ty") >= F.col("by1") - margin) | (F.greatest("sx", "tx") <= F.col("bx0") + margin) | (F.least("sx", "tx") >= F.col("bx1") - margin)
    return met.select("page_num", "src", "dst", F.when(F.col("tx").isNotNull() & near, F.col("cost") * penalty).otherwise(F.col("cost")).alias("cost"), "gutter_id")


_X = {"N": 0.0, "S": 0.0, "E": 1.0, "W": -1.0}
_Y = {"N": -1.0, "S": 1.0, "E": 0.0, "W": 0.0}


def _vector(compass: Column) -> tuple[Column, Column]:
    return tuple(F.element_at(F.create_map(*(F.lit(v) for kv in table.items() for v in kv)), compass) for table in (_X, _Y))


def pick_ports(pairs: DataFrame) -> DataFrame:
    """pairs (page_num, a, b, ax, ay, bx, by, a_ports, b_ports) with the pair of ports that leads most directly from a to b.

    Adds a_port, b_port and score; of equal scores the first in port order. Pairs without ports on a side are dropped.
    """
    both = pairs.select("*", F.posexplode("a_ports").alias("i", "pa")).select("*", F.posexplode("b_ports").alias("j", "pb"))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    (ax, ay), (bx, by) = _vector(F.col("pa.compass")), _vector(F.col("pb.compass"))
    apart = F.sqrt((F.col("pa.x") - F.col("pb.x")) ** 2 + (F.col("pa.y") - F.col("pb.y")) ** 2)
    score = apart - 0.5 * (dx * ax + dy * ay) - 0.5 * (-dx * bx - dy * by)
    best = both.groupBy("page_num", "a", "b").agg(F.min(F.struct(score.alias("score"), "i", "j", F.col("pa.compass").alias("a_port"), F.col("pb.compass").alias("b_port"))).alias("m"))
    return best.select("page_num", "a", "b", "m.a_port", "m.b_port", "m.score")


def dijkstra(links: dict[int, list[tuple[int, float, int]]], start: int, end: int) -> tuple[float | None, list[int], list[int]]:
    """(cost, nodes, gutters) of the cheapest way; (None, [], []) if there is none."""
    if start == end:
        return 0.0, [start], []
    cost, came, queue = {start: 0.0}, {}, [(0.0, start)]
    while queue:
        c, node = heapq.heappop(queue)
        if node == end:
            break
        if c > cost[node]:
            continue
        for dst, step, gutter in links.get(node, ()):
            if c + step < cost.get(dst, float("inf")):
                cost[dst] = c + step
                came[dst] = node, gutter
                heapq.heappush(queue, (c + step, dst))
    if end not in cost:
        return None, [], []
    way, gutters, now = [end], [], end
    while now in came:
        now, gutter = came[now]
        way.append(now)
        gutters.append(gutter)
    return cost[end], way[::-1], gutters[::-1]


def shortest_paths(edges_: DataFrame, requests: DataFrame) -> DataFrame:
    """requests (page_num, start, end) answered with cost, node_ids and gutter_ids, page by page; edges of pages without requests don't leave their tasks."""

    def page(key: tuple, links: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        own: dict[int, list] = {}
        if len(asked):
            for src, dst, cost, gutter in zip(links["src"], links["dst"], links["cost"], links["gutter_id"], strict=True):
                own.setdefault(src, []).append((dst, cost, gutter))
        found = [dijkstra(own, s, e) for s, e in zip(asked["start"], asked["end"], strict=True)]
        return pd.DataFrame({"page_num": [key[0]] * len(asked), "start": asked["start"].to_numpy(), "end": asked["end"].to_numpy(), "cost": pd.Series([f[0] for f in found], dtype="float64"), "node_ids": [f[1] for f in found], "gutter_ids": [f[2] for f in found]})

    asked = requests.select(F.col("page_num").alias("page"), F.col("start").alias("start"), F.col("end").alias("end"))
    wanted = edges_.join(asked.select("page").distinct(), F.col("page_num") == F.col("page"), "left_semi")
    return wanted.groupBy("page_num").cogroup(asked.groupBy("page")).applyInPandas(page, "page_num long, start int, end int, cost double, node_ids array<int>, gutter_ids array<int>")


def between(pairs: DataFrame, nodes_: DataFrame, edges_: DataFrame) -> DataFrame:
    """pairs as for pick_ports to the way through the whitespace: (page_num, a, b, cost, points, gutter_ids); ways of under two nodes are dropped."""
    ports = nodes_.where("kind = 'port'").select("page_num", F.col("word_id").alias("w"), "compass", "node_id")
    chosen = pick_ports(pairs)
    chosen = chosen.join(ports.select("page_num", F.col("w").alias("a"), F.col("compass").alias("a_port"), F.col("node_id").alias("start")), ["page_num", "a", "a_port"]).join(ports.select("page_num", F.col("w").alias("b"), F.col("compass").alias("b_port"), F.col("node_id").alias("end")), ["page_num", "b", "b_port"])
    ways = shortest_paths(edges_, chosen.select("page_num", "start", "end").distinct()).where("size(node_ids) >= 2")
    steps = ways.select("page_num", "start", "end", "cost", "gutter_ids", F.posexplode("node_ids").alias("i", "node_id")).join(nodes_.select("page_num", "node_id", "x", "y"), ["page_num", "node_id"])
    drawn = steps.groupBy("page_num", "start", "end", "cost", "gutter_ids").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x", "y"))), lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"))).alias("points"))
    return chosen.join(drawn, ["page_num", "start", "end"]).select("page_num", "a", "b", "cost", "points", "gutter_ids")

