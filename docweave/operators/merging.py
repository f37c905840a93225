"""Greedy rules over evidence between rows, resolved in rounds so that no group is unbounded: guarded union-find and keep-lowest dedup."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators.components import connected_components
from docweave.operators.ordering import positions
from docweave.storage import discard, scratch

JUDGED_DIFFERENT = "judged_different"
JOINS_EXISTING = "joins_existing"

#: Edges of a component that one task resolves by itself.
GROUP = 200_000


# ---- guarded union-find -----------------------------------------------------------


def _sequential(pdf: pd.DataFrame) -> pd.DataFrame:
    """One small component, edge by edge: rows (place, a, b, x, y, kind, fx, fy); gives (x, root) of clusters and (a, b, reason) of refusals."""
    of: dict = {}
    members: dict = {}
    fixed: dict = {}
    for x, f in [*zip(pdf.x, pdf.fx, strict=True), *zip(pdf.y, pdf.fy, strict=True)]:
        of[x], members[x] = x, {x}
        fixed[x] = bool(f)
    apart: dict = {x: set() for x in of}  # cluster -> clusters it must not join, kept by roots
    for x, y in pdf.loc[pdf.kind == "apart", ["x", "y"]].itertuples(index=False):
        apart[x].add(y)
        apart[y].add(x)
    out = []
    for r in pdf[pdf.kind == "join"].sort_values("place").itertuples(index=False):
        x, y = of[r.x], of[r.y]
        if x == y:
            continue
        if y in apart[x]:
            out.append((None, None, r.a, r.b, JUDGED_DIFFERENT))
        elif fixed[x] and fixed[y]:
            out.append((None, None, r.a, r.b, JOINS_EXISTING))
        else:
            keep, drop = (x, y) if len(members[x]) >= len(members[y]) else (y, x)
            for m in members[drop]:
                of[m] = keep
            members[keep] |= members.pop(drop)
            fixed[keep] |= fixed.pop(drop)
            for z in apart.pop(drop):
                apart[z].discard(drop)
                apart[z].add(keep)
                apart[keep].add(z)
    least = {c: min(m) for c, m in members.items()}
    out += [(x, least[c], None, None, None) for x, c in of.items()]
    return pd.DataFrame(out, columns=["x", "root", "a", "b", "reason"])


class _State:
    """Joining edges between clusters (place, a, b, x, y), pairs of clusters that stay apart (x, y), clusters with a root of before (x)."""

    def __init__(self, joins: DataFrame, apart: DataFrame, fixed: DataFrame):
        self.joins, self.apart, self.fixed = joins, apart, fixed

    def relabelled(self, new: DataFrame, name: str) -> _State:
        """new: (x, root) of the clusters that change; what is inside a cluster then goes, and equal pairs collapse."""
        def both(df: DataFrame, more: list[str]) -> DataFrame:
            to = lambda c: new.select(F.col("x").alias(c), F.col("root").alias(f"{c}_"))
            joined = df.join(to("x"), "x", "left").join(to("y"), "y", "left")
            return joined.select(*more, F.coalesce("x_", "x").alias("x"), F.coalesce("y_", "y").alias("y")).where("x <> y")

        joins = scratch(both(self.joins, ["place", "a", "b"]), f"joins-{name}")
        pairs = both(self.apart, [])
        apart = scratch(pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), f"apart-{name}")
        fixed = scratch(self.fixed.join(new, "x", "left").select(F.coalesce("root", "x").alias("x")).distinct(), f"fixed-{name}")
        return _State(joins, apart, fixed)


def resolved(evidence: DataFrame, group_edges: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """((id, root), (a, b, reason)): clusters of guarded_union_find, and the edges that it refused.

    The greedy rule goes edge by edge; three facts let it go by components.
    Components of the joining edges don't affect each other. A component without
    a pair that must stay apart inside, and with one cluster of before at most,
    merges whole, whatever the order. And the stronger half of a component's
    edges comes before the weaker. So a component with a conflict is cut to its
    stronger half, again and again, until its parts are without conflict (and
    merge whole) or have group_edges edges at most (and are resolved edge by edge
    in one task). Clusters are then relabelled and the rest is looked at anew.
    """
    kind = evidence.schema["a"].dataType.simpleString()
    rows = evidence.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b", "kind", F.col("p").cast("double").alias("p"))
    nodes = evidence.select(F.explode(F.array("a", "b")).alias("id")).where("id IS NOT NULL").distinct()

    # Clusters of before: what hangs together by them; the last root, in order, stays.
    before = rows.where("kind = 'existing'")
    known = connected_components(before, "a", "b").withColumnRenamed("node", "x").withColumnRenamed("component", "root")
    known = scratch(known, "known")
    names = before.join(known.select(F.col("x").alias("b"), "root"), "b").groupBy("root").agg(F.max("b").alias("name"))
    names = scratch(names, "names")

    strength = F.when(F.col("kind") == "identical", 2.0).otherwise(F.coalesce(F.when(F.isnan("p"), None).otherwise(F.col("p")), F.lit(1.0)))
    joins = rows.where("kind IN ('identical', 'same')").withColumn("order_", -strength)
    joins = positions(joins, "place", ["order_", "a", "b"]).select("place", "a", "b", F.col("a").alias("x"), F.col("b").alias("y"))
    apart = rows.where("kind = 'different'").select(F.col("a").alias("x"), F.col("b").alias("y"))
    state = _State(joins, apart, names.select(F.col("root").alias("x"))).relabelled(known, "first")

    labels = scratch(nodes.join(known.select(F.col("x").alias("id"), "root"), "id", "left").select("id", F.coalesce("root", "id").alias("root")), "labels")
    refused = []
    turn = 0
    while True:
        new, some = _round(state, kind, group_edges, turn)
        if new is None:
            break
        refused.append(some)
        gone = some.select("place").unionByName(new.where("place IS NOT NULL").select("place"))
        moved = new.where("x IS NOT NULL").select("x", "root")
        rest = _State(state.joins.join(gone, "place", "left_anti"), state.apart, state.fixed).relabelled(moved, f"{turn}")
        for old in (state.joins, state.apart, state.fixed):
            discard(old)
        state = rest
        after = scratch(labels.join(moved.select(F.col("x").alias("root"), F.col("root").alias("to")), "root", "left").select("id", F.coalesce("to", "root").alias("root")), "labels")
        discard(labels)
        labels, turn = after, turn + 1
    # A cluster holds one of before at most; its name goes by the row that stood for that one.
    now = names.join(labels.withColumnRenamed("root", "now"), names["root"] == labels["id"]).select(F.col("now").alias("root"), "name")
    named = labels.join(now, "root", "left").select("id", F.coalesce("name", "root").alias("root"))
    out = evidence.sparkSession.createDataFrame([], f"a {kind}, b {kind}, reason string")
    for some in refused:
        out = out.unionByName(some.select("a", "b", "reason"))
    return named, out


def _round(state: _State, kind: str, group_edges: int, turn: int) -> tuple[DataFrame | None, DataFrame | None]:
    """((x, root) of clusters that merge and (place) of edges done with, refused edges): None where no edge is left."""
    active, level = state.joins, 0
    parts: list[DataFrame] = []
    if active.isEmpty():
        return None, None
    while True:
        held = scratch(connected_components(active, "x", "y").withColumnRenamed("node", "x"), f"parts-{turn}-{level}")
        end = lambda c: held.select(F.col("x").alias(c), F.col("component").alias(f"in_{c}"))
        inside = active.join(held, "x")
        sizes = inside.groupBy("component").agg(F.count("*").alias("edges"), F.percentile_approx("place", 0.5, 1000).alias("middle"))
        torn = state.apart.join(end("x"), "x").join(end("y"), "y").where("in_x = in_y").groupBy(F.col("in_x").alias("component")).agg(F.count("*").alias("pairs"))
        olds = state.fixed.join(held, "x").groupBy("component").agg(F.count("*").alias("olds"))
        told = sizes.join(torn, "component", "left").join(olds, "component", "left").select(
            "component", "middle", F.when(F.coalesce("pairs", F.lit(0)) + F.greatest(F.coalesce("olds", F.lit(0)) - 1, F.lit(0)) == 0, "whole").when(F.col("edges") <= group_edges, "group").otherwise("split").alias("how"))
        told = scratch(told, f"told-{turn}-{level}")
        how = lambda h: told.where(F.col("how") == h).select("component")
        whole = held.join(how("whole"), "component", "left_semi")
        none = F.lit(None)
        parts.append(whole.select("x", F.col("component").alias("root"), none.cast("long").alias("place"), none.cast(kind).alias("a"), none.cast(kind).alias("b"), none.cast("string").alias("reason")))
        done = inside.join(how("whole"), "component", "left_semi")
        parts.append(done.select(none.cast(kind).alias("x"), none.cast(kind).alias("root"), "place", none.cast(kind).alias("a"), none.cast(kind).alias("b"), none.cast("string").alias("reason")))

        mine = held.join(how("group"), "component", "left_semi")
        edges = active.join(mine, "x").select("component", F.lit("join").alias("kind"), "place", "a", "b", "x", "y")
        both = mine.select(F.col("x").alias("y"), F.col("component").alias("in_y"))
        stay = state.apart.join(mine, "x").join(both, "y").where("component = in_y").select("component", F.lit("apart").alias("kind"), none.cast("long").alias("place"), none.cast(kind).alias("a"), none.cast(kind).alias("b"), "x", "y")
        marked = state.fixed.select("x", F.lit(True).alias("f"))
        flagged = edges.unionByName(stay).join(marked.select("x", F.col("f").alias("fx")), "x", "left").join(marked.select(F.col("x").alias("y"), F.col("f").alias("fy")), "y", "left").fillna(False, ["fx", "fy"])
        small = flagged.groupBy("component").applyInPandas(_sequential, f"x {kind}, root {kind}, a {kind}, b {kind}, reason string")
        parts.append(small.select("x", "root", none.cast("long").alias("place"), "a", "b", "reason"))
        parts.append(edges.select(none.cast(kind).alias("x"), none.cast(kind).alias("root"), "place", none.cast(kind).alias("a"), none.cast(kind).alias("b"), none.cast("string").alias("reason")))

        split = told.where("how = 'split'")
        if split.isEmpty():
            break
        active = scratch(inside.join(split.select("component", "middle"), "component").where("place <= middle").select("place", "a", "b", "x", "y"), f"stronger-{turn}-{level}")
        level += 1
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = scratch(every, f"merged-{turn}")
    return every, every.where("reason IS NOT NULL").select("a", "b", "reason", F.lit(-1).cast("long").alias("place"))


def guarded_union_find(evidence: DataFrame, group_edges: int = GROUP) -> DataFrame:
    """(id, root) from rows (a, b, kind, p); kind: identical, same, different or existing (b is a's root).

    Evidence is merged greedily, identical pairs first, then by falling p (none:
    1), ties by (a, b). A union is refused if any pair across it was judged
    different, or if it would join two existing clusters. An existing root stays,
    else the least id is root; a node without joining evidence is its own. Rows
    with a null end only name their other end; repeated rows change nothing.
    """
    return resolved(evidence, group_edges)[0]


def refused_unions(evidence: DataFrame, group_edges: int = GROUP) -> DataFrame:
    """(a, b, reason): pairs that guarded_union_find saw evidence for and did not join."""
    return resolved(evidence, group_edges)[1]


# ---- keep the lowest --------------------------------------------------------------


def _lowest(pdf: pd.DataFrame) -> pd.DataFrame:
    gone: dict = {}
    for r in pdf.sort_values(["a", "b"]).itertuples(index=False):
        if r.a not in gone and r.b not in gone:
            gone[r.b] = r.a
    return pd.DataFrame(list(gone.items()), columns=["dropped", "kept"])


def greedy_dedup(pairs: DataFrame, group_edges: int = GROUP) -> DataFrame:
    """(dropped, kept): of similar pairs (a, b), in order of the lower id, the higher goes unless its partner went before.

    So a row stays if no lower neighbour stays (the lexicographically first
    independent set), and one that goes names the least lower neighbour that
    stays. Components of group_edges pairs at most are decided in one task each;
    greater ones in rounds: a row without undecided lower neighbours stays, its
    higher neighbours go. A row with one undecided lower neighbour is its
    opposite, so chains of such rows are followed by doubling, and a path of any
    length takes few rounds. Pairs with a null, or of a row with itself, count nothing.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    p = scratch(pairs.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    parts = connected_components(p, "a", "b")
    inside = scratch(p.join(parts.withColumnRenamed("node", "a"), "a"), "pairs-in-parts")
    sizes = inside.groupBy("component").agg(F.count("*").alias("n"))
    few, many = (inside.join(sizes.where(c).select("component"), "component", "left_semi") for c in (F.col("n") <= group_edges, F.col("n") > group_edges))
    out = few.groupBy("component").applyInPandas(_lowest, f"dropped {kind}, kept {kind}")
    left = scratch(many.select("a", "b"), "pairs-left")
    if left.isEmpty():
        return out
    stay = scratch(_independent(left, kind), "stay")
    gone = left.join(stay.select(F.col("id").alias("a")), "a", "left_semi").groupBy(F.col("b").alias("dropped")).agg(F.min("a").alias("kept"))
    return out.unionByName(gone)


def _independent(pairs: DataFrame, kind: str) -> DataFrame:
    """(id) of the rows that stay, by rounds over pairs (a < b)."""
    spark = pairs.sparkSession
    stay = spark.createDataFrame([], f"id {kind}")
    turn = 0
    while not pairs.isEmpty():
        lower = pairs.groupBy(F.col("b").alias("id")).agg(F.count("*").alias("n"), F.min("a").alias("to"))
        ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        # Where each row's state comes from: itself, or the opposite of its one lower neighbour.
        chain = scratch(ends.join(lower, "id", "left").select("id", F.when(F.col("n") == 1, F.col("to")).otherwise(F.col("id")).alias("to"), (F.col("n") == 1).cast("int").alias("odd"), F.col("n").isNull().alias("first")).fillna(0, ["odd"]), f"chain-{turn}")
        while True:
            ahead = chain.select(F.col("id").alias("to"), F.col("to").alias("far"), F.col("odd").alias("more"))
            farther = chain.join(ahead, "to").select("id", F.col("far").alias("to"), F.col("odd").bitwiseXOR(F.col("more")).alias("odd"), "first", (F.col("far") != F.col("to")).alias("moved"))
            farther = scratch(farther, f"chain-{turn}")
            discard(chain)
            chain = farther.drop("moved")
            chain._scratch = farther._scratch
            if farther.where("moved").isEmpty():
                break
        known = chain.where("first").select(F.col("id").alias("to"))
        told = scratch(chain.join(known, "to", "left_semi").select("id", (F.col("odd") == 0).alias("stays")), f"told-{turn}")
        stays = told.where("stays").select("id")
        stay = scratch(stay.unionByName(stays), f"stay-{turn}")
        # Higher neighbours of rows that stay go, and with them their pairs.
        gone = told.where("NOT stays").select("id").unionByName(pairs.join(stays.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id"))).distinct()
        done = scratch(gone.unionByName(stays).distinct(), f"done-{turn}")
        after = pairs.join(done.select(F.col("id").alias("a")), "a", "left_anti").join(done.select(F.col("id").alias("b")), "b", "left_anti")
        # A row whose pairs are all gone has no lower neighbour that stays.
        after = scratch(after.select("a", "b"), f"pairs-{turn}")
        freed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(done, "id", "left_anti").join(after.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_anti")
        stay = scratch(stay.unionByName(freed), f"stay-{turn}")
        pairs, turn = after, turn + 1
    return stay.distinct()
