"""SimHash near-duplicates, found exactly through a vantage-point tree over the fingerprints.

A tree of vantage points and radii, built on a bounded sample, divides the distinct fingerprints into
leaves: near ones (distance to the vantage point up to the radius) on one side, far ones on the other.
A fingerprint is a member of one leaf; it is also a query in every other leaf that the triangle
inequality cannot rule out, so each pair within the search radius meets in at least one leaf. A leaf is
compared in cells of bounded size, which report links to one representative, never all pairs. The links
are contracted to components by alternating star steps.
"""

from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from askgauge.llm.common import map_batches, replace_columns, schema_with, slices, unused, written

SHINGLE = 3
RADIUS = 3
SEED = 42
LEAF = 16_384  # fingerprints the tree aims at per leaf, and members a cell has at most
QUERIES = 16  # times as many queries as members at most in a cell: 8 MB, compared in blocks
SAMPLE = 65_536  # fingerprints the tree is built on
LEAST_SAMPLE = 16  # a leaf that has fewer in the sample is not divided
CANDIDATES = 12
BLOCK = 2**20  # comparisons made at once: 8 MB


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over the word shingles of a whole text, A-Z lower-cased; 0 for no words."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: the six ASCII spaces and A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    n = max(1, len(words) - shingle + 1)
    ends = (starts + sizes)[min(shingle, len(words)) - 1 :]
    cuts = map(slice, starts[:n].tolist(), ends.tolist())
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64, n)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        block = hashes[start : start + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """Add the shingle fingerprint of every text as a signed 64-bit integer."""

    def add(batches):
        for batch in slices(batches, 1024):
            prints = [text_fingerprint(t, shingle) for t in batch.column(text).to_pylist()]
            yield replace_columns(batch, {out: pa.array(np.array(prints, np.uint64).view(np.int64))})

    return map_batches(df, add, schema_with(df, f"`{out}` bigint"))


# --- The tree ---


@dataclass
class Tree:
    """Nodes in arrays; a child below zero is the leaf -1 - child."""

    vantage: np.ndarray
    radius: np.ndarray
    near: np.ndarray
    far: np.ndarray

    def route(self, prints: np.ndarray, reach: int):
        """Rows (index, leaf, is_member): each print's own leaf and those it has to be searched in."""
        found = []
        todo = [(0 if len(self.vantage) else -1, np.arange(len(prints)), np.ones(len(prints), bool))]
        while todo:
            node, at, own = todo.pop()
            if node < 0:
                found.append((at, np.full(len(at), -1 - node), own))
                continue
            apart = np.bitwise_count(prints[at] ^ self.vantage[node]).astype(np.int16)
            r = self.radius[node]
            inside = apart <= r
            # A member looks back only: a member beyond the radius is searched for within it, and the
            # pair is found that way round. A query looks at every side its ball touches.
            near = (apart - reach <= r) | (own & inside)
            far = np.where(own, ~inside, apart + reach > r)
            todo.append((int(self.near[node]), at[near], (own & inside)[near]))
            todo.append((int(self.far[node]), at[far], (own & ~inside)[far]))
            todo = [x for x in todo if len(x[1])]
        if not found:
            return np.array([], int), np.array([], int), np.array([], bool)
        return tuple(np.concatenate(x) for x in zip(*found))


def build_tree(sample: np.ndarray, total: int, leaf: int = LEAF) -> Tree:
    """Split at the median distance to the vantage point that spreads its part of the sample most."""
    nodes, leaves = [], 0
    share = total / max(1, len(sample))
    chooser = np.random.default_rng(SEED)

    def grow(part):
        nonlocal leaves
        if len(part) * share > leaf and len(part) >= 2 * LEAST_SAMPLE:
            tried = chooser.choice(part, min(CANDIDATES, len(part)), replace=False)
            apart = np.bitwise_count(part[None, :] ^ tried[:, None]).astype(np.int16)
            radii = np.median(apart, axis=1).astype(np.int16)
            # Fewest prints within reach of the boundary, then the most even halves.
            crossing = (np.abs(apart - radii[:, None]) <= RADIUS).sum(axis=1)
            uneven = np.abs((apart <= radii[:, None]).mean(axis=1) - 0.5)
            best = int(np.lexsort((uneven, crossing))[0])
            inside = apart[best] <= radii[best]
            if inside.any() and not inside.all():
                me = len(nodes)
                nodes.append([tried[best], radii[best], 0, 0])
                nodes[me][2] = grow(part[inside])
                nodes[me][3] = grow(part[~inside])
                return me
        leaves += 1
        return -leaves

    grow(sample)
    columns = list(zip(*nodes)) or [(), (), (), ()]
    return Tree(*(np.array(c, t) for c, t in zip(columns, (np.uint64, np.int16, np.int64, np.int64))))


# --- Links ---


def cell_links(members: np.ndarray, queries: np.ndarray, reach: int):
    """(print, representative) for every print that a chain of links within this cell ties to another."""
    nodes = np.unique(np.concatenate([members, queries]))
    label = np.arange(len(nodes))
    up = label.copy()

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    members = np.unique(members)
    places = np.searchsorted(nodes, members)
    rows = max(8, BLOCK // max(1, len(members)))
    for start in range(0, len(queries), rows):
        some = queries[start : start + rows]
        close = np.bitwise_count(some[:, None] ^ members[None, :]) <= reach
        own = np.searchsorted(nodes, some)
        for i in np.flatnonzero(close.any(axis=1)):
            touched = np.append(places[close[i]], own[i])
            met = {root(x) for x in np.unique(label[touched]).tolist()}
            least = min(met)
            for x in met:
                up[x] = least
            label[touched] = least
    final = np.array([root(x) for x in label.tolist()], np.int64)
    final = np.array([root(x) for x in final.tolist()], np.int64)
    tied = final != np.arange(len(nodes))
    return nodes[tied], nodes[final[tied]]


def links(prints: DataFrame, reach: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Links (a, b) between distinct prints ``fp`` whose components are those of all pairs within reach.

    Only a bounded sample of prints reaches the driver. Each leaf is dealt out in cells of about
    ``leaf`` members by ``QUERIES`` times as many queries at most, however many prints it has, so no
    task holds a whole group.
    """
    total = prints.count()
    sample = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow().column("fp").to_numpy().view(np.uint64)
    tree = build_tree(sample, total, leaf)

    def route(batches):
        for batch in batches:
            column = batch.column("fp").to_numpy().view(np.uint64)
            at, where, own = tree.route(column, reach)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column[at].view(np.int64)), pa.array(where.astype(np.int64)), pa.array(own)],
                ["fp", "leaf", "own"],
            )

    routed = written(map_batches(prints.select("fp"), route, "fp bigint, leaf bigint, own boolean"), "simhash-routed")
    sizes = routed.groupBy("leaf").agg(
        F.ceil(F.count_if("own") / leaf).cast("int").alias("m"), F.ceil(F.count("*") / (QUERIES * leaf)).cast("int").alias("q")
    )
    # A leaf without members has no pairs; the table has one row per leaf, at most SAMPLE / LEAST_SAMPLE.
    dealt = routed.join(F.broadcast(sizes.where("m > 0")), "leaf")
    spread = F.xxhash64("fp", F.lit(1))
    row, col = F.pmod(spread, F.col("m")).cast("int"), F.pmod(F.xxhash64("fp", F.lit(2)), F.col("q")).cast("int")

    def side(i, j, kind):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(kind).alias("kind"))

    def series(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    as_member = F.transform(series("q"), lambda j: side(row, j, "member"))
    as_query = F.transform(series("m"), lambda i: side(i, col, "query"))
    one_cell = (F.col("m") == 1) & (F.col("q") == 1)
    zero = F.lit(0)
    sides = (
        F.when(one_cell & F.col("own"), F.array(side(zero, zero, "both")))
        .when(F.col("own"), F.concat(as_member, as_query))
        .otherwise(as_query)
    )

    def compare(cell: pa.Table) -> pa.Table:
        column, kind = cell.column("fp").to_numpy().view(np.uint64), cell.column("kind").to_pandas()
        a, b = cell_links(column[kind != "query"], column[kind != "member"], reach)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    cells = dealt.select("fp", "leaf", F.explode(sides).alias("s")).select("fp", "leaf", "s.i", "s.j", "s.kind")
    found = cells.groupBy("leaf", "i", "j").applyInArrow(compare, "a bigint, b bigint")
    return found.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node of its component.

    Alternating large-star and small-star steps, each one grouped minimum and one join, which
    adaptive execution splits where a node has very many neighbours. Each round is written.
    """

    def step(edges, name, larger_only):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not larger_only:
            both = both.where("v <= u")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.join(least, "u")
        if larger_only:
            made = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            made = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return written(made.where("a <> b").distinct(), f"stars-{name}")

    def state(edges):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = written(edges, "stars-start")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = step(step(edges, "large", True), "small", False)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def component_ids(docs: DataFrame, reach: int = RADIUS) -> DataFrame:
    """(fp, component_id) for every distinct ``fp`` of a table with ``doc_id`` and ``fp``."""
    prints = written(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-prints")
    stars = components(links(prints, reach))
    rooted = prints.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return written(rooted.join(named, "root").select("fp", "root", "component_id"), "simhash-components")


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, reach: int = RADIUS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    Documents link where their fingerprints differ in at most ``reach`` bits; the component id is the
    smallest id reachable. Null, empty and blank texts have the fingerprint zero and link like any
    other. Equal fingerprints are one node from the start, so copies cost nothing beyond their count.
    Repeated rows come back as often as they came. A row without id is in its component but never
    names it: a component without any id has a null one. Other columns are not looked at.
    """
    chosen = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    docs = written(with_fingerprints(chosen, shingle=shingle).drop("text"), "simhash-docs")
    known = component_ids(docs, reach).select("fp", "component_id")
    return docs.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, reach: int = RADIUS
) -> DataFrame:
    """One document of each component of ``near_duplicates``, with all its columns: the one with the smallest id.

    Rows without an id come after all others. Rows that share id and component are told apart by the
    hash of their text, equal rows by their place in the table.
    """
    fp, place = unused(df, "fp"), unused(df, "place")
    marked = with_fingerprints(df, text, fp, shingle).withColumn(place, F.monotonically_increasing_id())
    full = written(marked, "simhash-docs")
    narrow = full.select(
        F.col(fp).alias("fp"), F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("h"), F.col(place).alias("place")
    )
    roots = component_ids(narrow, reach).select("fp", "root")
    order = F.struct(F.isnull("doc_id").alias("o"), "doc_id", "h", "place")
    first = narrow.join(roots, "fp").groupBy("root").agg(F.min(order).alias("first"))
    return full.join(first.select(F.col("first.place").alias(place)), place, "left_semi").select(*df.columns)
