"""Leiden communities (Traag et al. 2019): local moves, refinement, merging; small components in a task each, great ones in rounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators.components import connected_components
from docweave.operators.ordering import positions
from docweave.operators.relational import top_per_key
from docweave.storage import discard, scratch

#: Edges of a component that one task takes by itself.
GROUP = 200_000
#: Before the last round, moves of a level go on until fewer than one node in so many gains.
FEW = 100
#: Gains up to this are rounding.
LEAST = 1e-10


# ---- a small component in one task ------------------------------------------------


class _Graph:
    """Nodes by number with neighbours (numbers and weights), weight inside, and strength."""

    def __init__(self, near: list[dict[int, float]], inside: list[float], strength: list[float]):
        self.near, self.inside, self.strength = near, inside, strength

    @staticmethod
    def of(pairs: dict[tuple[int, int], float], inside: list[float]) -> _Graph:
        near: list[dict[int, float]] = [{} for _ in inside]
        for (u, v), w in pairs.items():
            near[u][v] = near[v][u] = w
        return _Graph(near, inside, [sum(d.values()) + s for d, s in zip(near, inside, strict=True)])

    def merged(self, label: list[int]) -> tuple[_Graph, list[int]]:
        """The graph of the groups, and the group's number of each node."""
        number = {c: i for i, c in enumerate(dict.fromkeys(label))}
        of = [number[c] for c in label]
        inside = [0.0] * len(number)
        pairs: dict[tuple[int, int], float] = {}
        for u, d in enumerate(self.near):
            inside[of[u]] += self.inside[u]
            for v, w in d.items():
                if of[u] == of[v]:
                    inside[of[u]] += w
                elif of[u] < of[v]:
                    pairs[of[u], of[v]] = pairs.get((of[u], of[v]), 0.0) + w
        return _Graph.of(pairs, inside), of


def _moved(g: _Graph, label: list[int], pull: float) -> bool:
    """Moves nodes to the community of greatest gain (or one of their own) until none gains; pull is resolution / total weight."""
    weight: dict[int, float] = {}
    for u, c in enumerate(label):
        weight[c] = weight.get(c, 0.0) + g.strength[u]
    waiting, queued, any_moved = list(range(len(label))), [True] * len(label), False
    fresh = max(label, default=0) + 1
    for u in waiting:  # grows while it is read
        queued[u] = False
        old, k = label[u], g.strength[u]
        weight[old] -= k
        links: dict[int, float] = {old: 0.0}
        for v, w in g.near[u].items():
            links[label[v]] = links.get(label[v], 0.0) + w
        gains = {c: w - pull * k * weight.get(c, 0.0) for c, w in links.items()}
        best = max(gains, key=lambda c: (gains[c], -c))
        if max(gains[best], 0.0) <= gains[old] + LEAST:
            best = old
        elif gains[best] <= LEAST:  # alone is better than any company
            best, fresh = fresh, fresh + 1
        label[u] = best
        weight[best] = weight.get(best, 0.0) + k
        if best != old:
            any_moved = True
            for v in g.near[u]:
                if label[v] != best and not queued[v]:
                    queued[v] = True
                    waiting.append(v)
    return any_moved


def _refined(g: _Graph, label: list[int], pull: float) -> list[int]:
    """Each community split into well-connected parts: nodes still alone join the part of greatest gain inside it."""
    part = list(range(len(label)))
    total: dict[int, float] = {}
    for u, c in enumerate(label):
        total[c] = total.get(c, 0.0) + g.strength[u]
    weight, alone = list(g.strength), [True] * len(label)
    cut = [sum(w for v, w in g.near[u].items() if label[v] == label[u]) for u in range(len(label))]
    for u in range(len(label)):
        k, all_ = g.strength[u], total[label[u]]
        if not alone[u] or cut[u] < pull * k * (all_ - k):
            continue
        links: dict[int, float] = {}
        for v, w in g.near[u].items():
            if label[v] == label[u]:
                links[part[v]] = links.get(part[v], 0.0) + w
        fit = {p: w - pull * k * weight[p] for p, w in links.items() if p != part[u] and cut[p] >= pull * weight[p] * (all_ - weight[p])}
        best = max(fit, key=lambda p: (fit[p], -p), default=None)
        if best is None or fit[best] <= LEAST:
            continue
        cut[best] += cut[u] - 2 * links[best]
        weight[best] += k
        part[u], alone[best] = best, False
    return part


def _parts(g: _Graph, label: list[int]) -> list[int]:
    """Labels of what hangs together inside each community."""
    out = [-1] * len(label)
    for first in range(len(label)):
        if out[first] >= 0:
            continue
        out[first], todo = first, [first]
        while todo:
            u = todo.pop()
            for v in g.near[u]:
                if out[v] < 0 and label[v] == label[u]:
                    out[v] = first
                    todo.append(v)
    return out


def leiden(g: _Graph, pull: float, passes: int, label: list[int] | None = None) -> list[int]:
    """A label for each node: communities that hang together, in which no node gains by a move; from given labels on, or from single nodes."""
    label = list(range(len(g.near))) if label is None else list(label)
    for _ in range(passes):
        # Down: move, refine, merge, until merging changes nothing.
        level, on, of = g, label, list(range(len(label)))
        while True:
            _moved(level, on, pull)
            part = _refined(level, on, pull)
            merged, number = level.merged(part)
            after = [0] * len(merged.near)
            for u, i in enumerate(number):
                after[i] = on[u]
            of = [number[i] for i in of]
            if len(merged.near) == len(level.near):
                break
            level, on = merged, after
        label = [after[i] for i in of]
        # Up: single nodes, and communities that fell apart.
        moved = _moved(g, label, pull)
        parts = _parts(g, label)
        torn = len(set(parts)) > len(set(label))
        label = parts
        if not moved and not torn:
            break
    while _moved(g, label, pull) or len(set(_parts(g, label))) > len(set(label)):
        label = _parts(g, label)
    return label


def _small(pull: float, passes: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["u", "v"])
        names = np.unique(pdf[["u", "v"]].to_numpy().ravel())
        u, v = np.searchsorted(names, pdf.u), np.searchsorted(names, pdf.v)
        pairs = {(int(a), int(b)): float(w) for a, b, w in zip(u, v, pdf.w, strict=True)}
        return pd.DataFrame({"node": names, "label": names[np.array(_least(leiden(_Graph.of(pairs, [0.0] * len(names)), pull, passes)))]})

    return run


def _least(label: list[int]) -> list[int]:
    """Labels as the least member's number."""
    first: dict[int, int] = {}
    for u, c in enumerate(label):
        first.setdefault(c, u)
    return [first[c] for c in label]


# ---- a great component in rounds ---------------------------------------------------


class _Level:
    """Edges both ways (u, v, w) and nodes (u, k, c): strength and community; s: the community that refinement stays inside."""

    def __init__(self, edges: DataFrame, nodes: DataFrame):
        self.edges, self.nodes = edges, nodes


def _wishes(level: _Level, pull: float, base: int, inside: bool) -> DataFrame:
    """(u, k, c, d, gain): nodes that gain by going from c to d; d is base + u for a community of its own."""
    nodes = level.nodes
    nodes = nodes.join(nodes.groupBy("c").agg(F.sum("k").alias("held"), F.count("*").alias("members")), "c")
    movers = nodes
    if inside:
        # Only parts that hang well together in their community are joined, and only nodes that do join.
        whole = nodes.groupBy("s").agg(F.sum("k").alias("all"))
        out = level.edges.join(nodes.select("u", "c"), "u").join(nodes.select(F.col("u").alias("v"), F.col("c").alias("d")), "v").where("c <> d").groupBy("c").agg(F.sum("w").alias("cut"))
        sound = nodes.groupBy("c", "s").agg(F.sum("k").alias("held")).join(whole, "s").join(out, "c").where(F.col("cut") >= pull * F.col("held") * (F.col("all") - F.col("held"))).select("c")
        nodes = nodes.join(sound, "c", "left_semi")
        movers = nodes.where("members = 1")
    ends = nodes.select(F.col("u").alias("v"), F.col("c").alias("d"), F.col("held").alias("there"))
    links = level.edges.join(ends, "v").groupBy("u", "d").agg(F.sum("w").alias("w"), F.max("there").alias("there"))
    offers = movers.select("u", "k", "c").join(links, "u")
    to = F.struct((F.col("w") - pull * F.col("k") * F.col("there")).alias("gain"), (-F.col("d")).alias("turn"))
    best = offers.groupBy("u").agg(F.max(F.when(F.col("c") != F.col("d"), to)).alias("b"), F.max(F.when(F.col("c") == F.col("d"), F.col("w"))).alias("own"))
    stay = F.coalesce("own", F.lit(0.0)) - pull * F.col("k") * (F.col("held") - F.col("k"))
    both = movers.join(best, "u", "left").select("u", "k", "c", "members", stay.alias("stay"), F.col("b.gain").alias("to"), (-F.col("b.turn")).alias("d"))
    alone = (F.col("members") > 1) & F.lit(not inside) & (F.coalesce("to", F.lit(0.0)) <= LEAST)
    d = F.when(alone, F.col("u") + base).otherwise(F.col("d"))
    gain = F.when(alone, -F.col("stay")).otherwise(F.col("to") - F.col("stay"))
    return both.select("u", "k", "c", d.alias("d"), gain.alias("gain")).where(F.col("d").isNotNull() & (F.col("gain") > LEAST))


def _granted(wishes: DataFrame, pull: float, turn: int, base: int) -> DataFrame:
    """(u, d): moves that raise the quality whatever else moves with them.

    A community gives or takes in a round, as that one of the wishes on it has it
    whose hash is least; a wish that meets no other is always granted. Of two nodes
    u and v that leave one community, or come into one, together, the quality
    misses at most pull * k(u) * k(v) of what they gain one by one. So nodes go by
    falling gain, as far as each gains with all before it that leave and come with it.
    """
    toss = F.struct(F.xxhash64("u", F.lit(turn)).alias("toss"), "u")
    ends = wishes.select(F.col("c").alias("x"), toss.alias("toss"), F.lit(True).alias("gives"))
    ends = ends.unionByName(wishes.where(F.col("d") < base).select(F.col("d").alias("x"), toss.alias("toss"), F.lit(False).alias("gives")))
    role = ends.groupBy("x").agg(F.min_by("gives", "toss").alias("gives"))
    able = wishes.join(role.where("gives").select(F.col("x").alias("c")), "c", "left_semi").join(role.where("gives").select(F.col("x").alias("d")), "d", "left_anti")
    before = lambda c: F.coalesce(F.sum("k").over(Window.partitionBy(c).orderBy(F.desc("gain"), "u").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    both = able.withColumn("left", before("c")).withColumn("came", before("d"))
    return both.where(F.col("gain") > pull * F.col("k") * (F.col("left") + F.col("came")) + LEAST).select("u", "d")


def _settled(level: _Level, pull: float, base: int, inside: bool = False, least: int = 1, rounds: int = 10_000) -> tuple[DataFrame, bool]:
    """(nodes, whether any moved) after moves until fewer than `least` nodes gain."""
    nodes, moved = level.nodes, False
    for turn in range(rounds):
        fresh = base * (turn + 1)  # no name of a round before
        wishes = scratch(_wishes(_Level(level.edges, nodes), pull, fresh, inside), "wishes")
        if wishes.limit(least).count() < least:
            discard(wishes)
            break
        granted = _granted(wishes, pull, turn, fresh)
        after = scratch(nodes.join(granted, "u", "left").withColumn("c", F.coalesce("d", "c")).select(*nodes.columns), "moved")
        if moved:
            discard(nodes)
        discard(wishes)
        nodes, moved = after, True
    if moved and not inside:
        # A community is named by its least member, so that new names stay free.
        names = nodes.groupBy("c").agg(F.min("u").alias("least"))
        nodes = scratch(nodes.join(names, "c").withColumn("c", F.col("least")).select(*nodes.columns), "named")
    return nodes, moved


def _finished(level: _Level, pull: float, passes: int) -> DataFrame:
    """(u, c): a merged level that is small enough for one task, settled there on all levels above it."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf.v < 0].sort_values("u")
        names = own.u.to_numpy()
        at = lambda x: np.searchsorted(names, x.to_numpy())
        near = pdf[pdf.v >= 0].sort_values(["u", "v"])
        pairs = {(int(a), int(b)): float(w) for a, b, w in zip(at(near.u), at(near.v), near.w, strict=True)}
        g = _Graph.of(pairs, [0.0] * len(names))
        # What a node has beyond its links lies inside it.
        g.inside = [max(0.0, k - s) for k, s in zip(own.w.tolist(), g.strength, strict=True)]
        g.strength = own.w.tolist()
        found = leiden(g, pull, passes, at(own.c).tolist())
        return pd.DataFrame({"u": names, "c": names[np.array(_least(found))]})

    none = F.lit(-1).cast("long")
    rows = level.edges.where("u < v").select("u", "v", "w", none.alias("c")).unionByName(level.nodes.select("u", none.alias("v"), F.col("k").alias("w"), "c"))
    return rows.groupBy(F.lit(0).alias("all")).applyInPandas(run, "u long, c long")


def _great(edges: DataFrame, pull: float, passes: int, group_edges: int) -> DataFrame:
    """(node, label) of components given as (u, v, w) with each pair once; labels are members.

    Levels of group_edges pairs at most, once they are merged, are finished in one
    task. On the way down and up a few nodes that would still gain are left to the
    next pass; the last moves go on until none gains.
    """
    # Weights in thousandths are whole, so that their sums are exact in any order and the result hangs on nothing but the graph.
    edges, pull = edges.select("u", "v", F.round(F.col("w") * 1000).alias("w")), pull / 1000
    both = edges.select("u", "v", "w").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "w"))
    names = positions(both.select(F.col("u").alias("node")).distinct(), "place", ["node"]).select("node", F.col("place").cast("long").alias("place"))
    names = scratch(names, "names")
    count = names.count()
    base = 1 << max(1, count.bit_length() + 1)
    numbered = both.join(names.select(F.col("node").alias("u"), F.col("place").alias("pu")), "u").join(names.select(F.col("node").alias("v"), F.col("place").alias("pv")), "v")
    first = scratch(numbered.select(F.col("pu").alias("u"), F.col("pv").alias("v"), "w"), "edges")
    strength = scratch(first.groupBy("u").agg(F.sum("w").alias("k")), "strength")
    nodes = strength.select("u", "k", F.col("u").alias("c"))
    for _ in range(passes):
        level, of = _Level(first, nodes), nodes.select("u", F.col("u").alias("on"))
        while True:
            settled, _ = _settled(level, pull, base, least=max(1, level.nodes.count() // FEW))
            near = level.edges.join(settled.select("u", F.col("c").alias("cu")), "u").join(settled.select(F.col("u").alias("v"), F.col("c").alias("cv")), "v").where("cu = cv")
            apart = settled.select("u", "k", F.col("u").alias("c"), F.col("c").alias("s"))
            refined, merged = _settled(_Level(scratch(near.select("u", "v", "w"), "inside"), apart), pull, base, inside=True)
            if not merged:
                break
            part = scratch(refined.select("u", "c", "s"), "parts")
            up = lambda e: part.select(F.col("u").alias(e), F.col("c").alias(f"{e}_"))  # noqa: B023, E731
            edges_ = level.edges.join(up("u"), "u").join(up("v"), "v").where("u_ <> v_").groupBy(F.col("u_").alias("u"), F.col("v_").alias("v")).agg(F.sum("w").alias("w"))
            nodes_ = settled.select("u", "k").join(part, "u").groupBy(F.col("c").alias("u")).agg(F.sum("k").alias("k"), F.min("s").alias("s"))
            least = nodes_.groupBy("s").agg(F.min("u").alias("least"))
            of = scratch(of.join(part.select(F.col("u").alias("on"), F.col("c").alias("to")), "on").select("u", F.col("to").alias("on")), "of")
            level = _Level(scratch(edges_, "edges"), scratch(nodes_.join(least, "s").select("u", "k", F.col("least").alias("c")), "nodes"))
            if level.edges.count() <= 2 * group_edges and level.nodes.count() <= 2 * group_edges:
                settled = scratch(_finished(level, pull, passes), "finished")
                break
        back = of.join(settled.select(F.col("u").alias("on"), "c"), "on").select("u", "c")
        nodes = scratch(strength.join(back, "u"), "nodes")
        nodes, moved = _settled(_Level(first, nodes), pull, base, least=max(1, count // FEW))
        if not moved:
            break
    while True:
        nodes, moved = _settled(_Level(first, nodes), pull, base)
        parts, torn = _held_together(first, nodes)
        if not moved and not torn:
            break
        nodes = scratch(strength.join(parts, "u"), "nodes")
    label = names.select(F.col("place").alias("c"), F.col("node").alias("label"))
    return parts.join(names.withColumnRenamed("place", "u"), "u").join(label, "c").select("node", "label")


def _held_together(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, bool]:
    """((u, c), whether any fell apart): communities as what hangs together inside them."""
    near = edges.where("u < v").join(nodes.select("u", F.col("c").alias("cu")), "u").join(nodes.select(F.col("u").alias("v"), F.col("c").alias("cv")), "v").where("cu = cv")
    parts = connected_components(near.select("u", "v"), "u", "v").withColumnRenamed("node", "u")
    every = scratch(nodes.select("u", F.col("c").alias("was")).join(parts, "u", "left").select("u", "was", F.coalesce("component", "u").alias("c")), "parts")
    held = every.agg(F.countDistinct("was").alias("a"), F.countDistinct("c").alias("b")).first()
    return every.select("u", "c"), held["b"] > held["a"]


# ---- both --------------------------------------------------------------------------


def communities(edges: DataFrame, resolution: float = 1.0, min_size: int = 4, passes: int = 20, group_edges: int = GROUP) -> DataFrame:
    """(component, community, members): modularity communities of the usable edges (src, dst, weight), named by their least member.

    Weights are rounded to three decimals; null, NaN and what rounds to nothing
    is left out, as are edges of a node with itself; several edges of a pair add
    up. The total weight is that of the whole graph. Communities hang together,
    and no node gains by moving to another or to one of its own. Only those of
    at least min_size nodes are given. Components of group_edges pairs at most
    are one task each; greater ones go in rounds over all tasks. The result is the same for
    the same graph, but for a component's size on either side of group_edges.
    """
    usable = edges.where(F.col("weight").isNotNull() & ~F.isnan("weight")).select("src", "dst", F.bround(F.col("weight").cast("double"), 3).alias("w")).where("w > 0 AND src <> dst")
    pairs = scratch(usable.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(F.sum("w").alias("w")), "pairs")
    kind = pairs.schema["u"].dataType.simpleString()
    total = 2 * (pairs.agg(F.sum("w")).first()[0] or 0.0)
    if not total:
        return edges.sparkSession.createDataFrame([], f"component {kind}, community {kind}, members array<{kind}>")
    parts = scratch(connected_components(pairs, "u", "v").withColumnRenamed("node", "u"), "components")
    inside = scratch(pairs.join(parts, "u"), "pairs-in-components")
    sizes = inside.groupBy("component").agg(F.count("*").alias("n"))
    few, many = (inside.join(sizes.where(c).select("component"), "component", "left_semi") for c in (F.col("n") <= group_edges, F.col("n") > group_edges))
    found = few.groupBy("component").applyInPandas(_small(resolution / total, passes), f"node {kind}, label {kind}")
    if not many.isEmpty():
        found = found.unionByName(_great(many, resolution / total, passes, group_edges))
    held = found.join(parts.withColumnRenamed("u", "node"), "node")
    listed = held.groupBy("component", "label").agg(F.sort_array(F.collect_list("node")).alias("members"))
    return listed.where(F.size("members") >= min_size).select("component", F.get("members", F.lit(0)).alias("community"), "members")
