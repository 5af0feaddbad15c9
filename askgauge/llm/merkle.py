"""Merkle manifest of a dataset: one tree per group over its rows in id order, one tree over the groups.

Where a leaf stands in its group is asked of a bitmap, not sorted out. The ids of a group are held in
compressed containers of 2**16 ids (a sorted list, or a bitmap with a directory of running popcounts),
merged from the fragments of all tasks. The directory goes on above the containers in three more
levels of 16 bits, each a running sum within one parent. Rank plus base is the coordinate of a leaf.
Coordinates deal the leaves into blocks of 8**4 slots; a block is reduced at once, its root is a slot
of the next level. Proofs go the other way, from the root down to the blocks.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from askgauge.llm.common import lower_ascii, map_batches, partitions, slices, written

FANOUT = 8
STEPS = 4  # levels that a block reduces
BLOCK_BITS = 12
BLOCK = FANOUT**STEPS
IDS = 65_536  # ids a container spans
PART_BITS = 12  # a container's ids are ranked in parts of 2**12, each with a copy of the container
LISTED = 4096  # a container of fewer ids is a sorted list of 16-bit numbers
PACKED = 2**20  # ids a task gathers before it packs them into fragments
SLOT = "struct<slot: int, count: int, hash: string, key: bigint, alt: string>"


def field(value: Column, binary: bool = False) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value if binary else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Hex SHA-256 of the fields of a row."""
    return F.sha2(F.concat(*(field(v) for v in values)).cast("binary"), 256)


# --- Containers ---


def pack(lows: np.ndarray) -> bytes:
    """Distinct sorted 16-bit numbers as a list, or from ``LISTED`` on as a bitmap, whichever is shorter."""
    if len(lows) < LISTED:
        return lows.astype("<u2").tobytes()
    bits = np.zeros(IDS, np.uint8)
    bits[lows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(container: bytes) -> np.ndarray:
    if len(container) < IDS // 8:
        return np.frombuffer(container, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8), bitorder="little"))


def directory(container: bytes) -> bytes:
    """The number of ids before each 64-bit word of a bitmap; nothing for a list."""
    if len(container) < IDS // 8:
        return b""
    ones = np.bitwise_count(np.frombuffer(container, "<u8")).astype(np.int64)
    return (np.cumsum(ones) - ones).astype("<u2").tobytes()


def ranks(container: bytes, heads: bytes, lows: np.ndarray) -> np.ndarray:
    """How many ids of the container are below each of ``lows``."""
    if not heads:
        return np.searchsorted(np.frombuffer(container, "<u2"), lows)
    words, before = np.frombuffer(container, "<u8"), np.frombuffer(heads, "<u2")
    below = words[lows >> 6] & ((np.uint64(1) << (lows & 63).astype(np.uint64)) - np.uint64(1))
    return before[lows >> 6].astype(np.int64) + np.bitwise_count(below)


def containers(ids: DataFrame) -> DataFrame:
    """(g, high, bits, heads, more_lows, more, ones, parts) per container of the distinct ids (g, key, n).

    ``more`` are the further rows of ids that have several; ``ones`` counts all rows; ``parts`` are the
    parts of the container that hold ids. Ids are
    distinct, so the fragments of a container hold 2**16 ids at most, however many tasks there are.
    """
    fragment = "g string, high bigint, bits binary, more_lows array<int>, more array<bigint>"

    def record(g, high, low, n):
        code, names = g.combine_chunks().dictionary_encode(), None
        code, names = code.indices.to_numpy(zero_copy_only=False), code.dictionary.to_pylist()
        order = np.lexsort((low, high, code))
        code, high, low, n = code[order], high[order], low[order], n[order]
        firsts = np.flatnonzero(np.concatenate([[True], (np.diff(code) != 0) | (np.diff(high) != 0)]))
        rows = []
        for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(code)]):
            several = np.flatnonzero(n[a:b] > 1)
            rows.append(
                (names[code[a]], int(high[a]), pack(low[a:b]), low[a:b][several].tolist(), (n[a:b][several] - 1).tolist())
            )
        types = (pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()))
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, ["g", "high", "bits", "more_lows", "more"])

    def fragments(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACKED:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held):
        rows = pa.Table.from_batches(held)
        key = rows.column("key").to_numpy()
        return record(rows.column("g"), key >> 16, key & 0xFFFF, rows.column("n").to_numpy())

    def merge(batches):
        for batch in slices(batches, 256):
            found = []
            for parts, lows, more in zip(*(batch.column(c).to_pylist() for c in ("parts", "more_lows", "more"))):
                here = np.sort(np.concatenate([unpack(p) for p in parts]))
                order = np.argsort(lows, kind="stable")
                bits = pack(here)
                found.append(
                    (
                        bits,
                        directory(bits),
                        np.array(lows, np.int32)[order].tolist(),
                        np.array(more, np.int64)[order].tolist(),
                        len(here) + sum(more),
                        np.unique(here >> PART_BITS).tolist(),
                    )
                )
            types = (pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()))
            arrays = [pa.array(c, t) for c, t in zip(zip(*found), types)] if found else [pa.array([], t) for t in types]
            names = ["g", "high", "bits", "heads", "more_lows", "more", "ones", "parts"]
            yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("high"), *arrays], names)

    made = map_batches(ids.select("g", "key", "n"), fragments, fragment)
    listed = made.groupBy("g", "high").agg(
        F.collect_list("bits").alias("parts"),
        F.flatten(F.collect_list("more_lows")).alias("more_lows"),
        F.flatten(F.collect_list("more")).alias("more"),
    )
    schema = "g string, high bigint, bits binary, heads binary, more_lows array<int>, more array<bigint>"
    return map_batches(listed, merge, f"{schema}, ones bigint, parts array<int>")


def with_bases(table: DataFrame) -> DataFrame:
    """Containers with ``base``: the rows of their group in the containers before them.

    A running sum per level of 16 bits: no window holds more than 2**16 rows, whatever the ids are.
    """
    level = table.select("g", "high", "ones")
    levels = []
    for _ in range(3):
        parent = F.shiftright("high", 16)
        before = Window.partitionBy("g", "parent").orderBy("high").rowsBetween(Window.unboundedPreceding, -1)
        summed = level.withColumn("parent", parent)
        levels.append(summed.select("g", "high", "parent", F.coalesce(F.sum("ones").over(before), F.lit(0)).alias("base")))
        level = summed.groupBy("g", F.col("parent").alias("high")).agg(F.sum("ones").alias("ones"))
    # What is left are the signs: at most two rows a group, the negative ids first.
    sign = Window.partitionBy("g").orderBy("high").rowsBetween(Window.unboundedPreceding, -1)
    based = level.select("g", "high", F.coalesce(F.sum("ones").over(sign), F.lit(0)).alias("base"))
    for below in reversed(levels):
        above = based.select("g", F.col("high").alias("parent"), F.col("base").alias("above"))
        based = below.join(above, ["g", "parent"]).select("g", "high", (F.col("base") + F.col("above")).alias("base"))
    return table.join(based, ["g", "high"])


def coordinates(ids: DataFrame, nulls: DataFrame) -> DataFrame:
    """``ids`` (g, key, n and more) with ``start``, the place of the first of their rows in the group."""
    held = written(containers(ids.where("key is not null")), "merkle-containers")
    based = with_bases(held).join(nulls, "g", "left").withColumn("base", F.col("base") + F.coalesce("nulls", F.lit(0)))
    kept = [c for c in ids.columns if c != "g"]
    empty = [F.lit(None).cast(ids.schema[c].dataType).alias(c) for c in kept]
    blank = "cast(null as {}) as {}".format
    sides = based.withColumn("part", F.explode("parts")).select(
        "g", "high", "part", F.lit(0).alias("side"), "base", "bits", "heads", "more_lows", "more", *empty
    )
    asked = ids.where("key is not null").select(
        "g",
        F.shiftright("key", 16).alias("high"),
        F.shiftright(F.col("key").bitwiseAND(IDS - 1), PART_BITS).cast("int").alias("part"),
        F.lit(1).alias("side"),
        *(F.expr(blank(t, c)) for c, t in (("base", "bigint"), ("bits", "binary"), ("heads", "binary"))),
        F.expr(blank("array<int>", "more_lows")),
        F.expr(blank("array<bigint>", "more")),
        *kept,
    )
    together = sides.unionByName(asked).repartition("g", "high", "part").sortWithinPartitions("g", "high", "part", "side")

    def rank(batches):
        base = bits = heads = lows = more = None
        for batch in batches:
            side, keys = batch.column("side").to_numpy(), batch.column("key")
            start = np.zeros(batch.num_rows, np.int64)
            turns = np.flatnonzero(side == 0)
            for a, b in zip([-1, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
                if a >= 0:
                    base, bits, heads, lows, more = (
                        batch.column(c)[a].as_py() for c in ("base", "bits", "heads", "more_lows", "more")
                    )
                    lows, more = np.array(lows, np.int64), np.concatenate([[0], np.cumsum(more)]).astype(np.int64)
                if b > a + 1:
                    low = keys.slice(a + 1, b - a - 1).to_numpy() & 0xFFFF
                    start[a + 1 : b] = base + ranks(bits, heads, low) + more[np.searchsorted(lows, low)]
            rows = pa.array(np.flatnonzero(side == 1))
            arrays = [batch.column(c).take(rows) for c in ("g", *kept)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(start).take(rows)], ["g", *kept, "start"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ids.schema) + ", start bigint"
    ranked = map_batches(together, rank, schema).select(*ids.columns, "start")
    return ranked.unionByName(ids.where("key is null").withColumn("start", F.lit(0).cast("bigint")))


# --- Trees ---


def levels_of(hashes: list[bytes], total: int) -> list[list[bytes]]:
    """The hashes of a block and of the levels above, up to its root; ``total`` are the nodes of the tree."""
    levels = [hashes]
    while len(levels) <= STEPS and total > 1:
        below = levels[-1]
        runs = (b"".join(below[i : i + FANOUT]) for i in range(0, len(below), FANOUT))
        levels.append([hashlib.sha256(run).hexdigest().encode() for run in runs])
        total = -(-total // FANOUT)
    return levels


def siblings(levels: list[list[bytes]]) -> list[list[tuple[bytes, bytes]]]:
    """For each node of each level but the root's, the hashes left and right of it in its run."""
    found = []
    for level in levels[:-1]:
        whole, width = b"".join(level), len(level[0])
        sides = []
        for i in range(len(level)):
            first = i - i % FANOUT
            sides.append((whole[first * width : i * width], whole[(i + 1) * width : (first + FANOUT) * width]))
        found.append(sides)
    return found


def slot_hashes(slots: list[dict]) -> list[bytes]:
    """The hashes of a block in the order of its slots; a slot entry may fill several slots."""
    filled = [b""] * sum(s["count"] for s in slots)
    for s in slots:
        filled[s["slot"] : s["slot"] + s["count"]] = [s["hash"].encode()] * s["count"]
    return filled


def block_roots(blocks: DataFrame) -> DataFrame:
    """(g, slot, hash): the root of every block (g, block, total, slots) as a node of the next level."""

    def reduce_blocks(batches):
        for batch in slices(batches, 16):
            rows = zip(*(batch.column(c).to_pylist() for c in ("slots", "total")))
            roots = [levels_of(slot_hashes(slots), total)[-1][0].decode() for slots, total in rows]
            arrays = [batch.column("g"), batch.column("block"), pa.array(roots, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["g", "place", "hash"])

    return map_batches(blocks, reduce_blocks, "g string, place bigint, hash string")


def in_blocks(nodes: DataFrame, totals: DataFrame) -> DataFrame:
    """Nodes (g, block, slot, count, hash, key, alt) as rows of slot arrays, with the nodes of their tree."""
    slot = F.struct("slot", "count", "hash", "key", "alt").cast(SLOT)
    gathered = nodes.groupBy("g", "block").agg(F.collect_list(slot).alias("slots"))
    return gathered.join(totals, "g").select("g", "block", "total", "slots")


def tree(nodes: DataFrame, totals: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every level, from the leaves up, and the root (g, hash) of every group."""
    most = totals.agg(F.max("total").alias("most")).first()["most"] or 0
    levels = []
    while True:
        levels.append(written(in_blocks(nodes, totals), f"merkle-{label}-{len(levels)}"))
        roots = written(block_roots(levels[-1]), f"merkle-{label}-roots-{len(levels)}")
        if most <= BLOCK:
            return levels, roots.select("g", "hash")
        most = -(-most // BLOCK)
        totals = totals.select("g", F.ceil(F.col("total") / BLOCK).cast("bigint").alias("total"))
        nodes = roots.select(
            "g",
            F.shiftright("place", BLOCK_BITS).alias("block"),
            F.col("place").bitwiseAND(BLOCK - 1).alias("slot"),
            F.lit(1).alias("count"),
            "hash",
            F.lit(None).alias("key"),
            F.lit(None).alias("alt"),
        )


PATH = "array<struct<left: binary, right: binary>>"


def paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(g, block, path): the siblings on the way up from each node of ``blocks``, for the block it roots.

    ``above`` has the path of the blocks themselves; the lowest siblings come first.
    """

    def walk(batches):
        for batch in slices(batches, 1):
            for g, block, total, slots, path in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                sides = siblings(levels_of(slot_hashes(slots), total))
                rows = []
                for i in range(sum(s["count"] for s in slots)):
                    own = [dict(zip(("left", "right"), level[i // FANOUT**k])) for k, level in enumerate(sides)]
                    rows.append((g, block * BLOCK + i, own + path))
                kind = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), kind))]
                yield pa.RecordBatch.from_arrays(arrays, ["g", "block", "path"])

    joined = blocks.join(above, ["g", "block"]).select("g", "block", "total", "slots", "path")
    return map_batches(joined, walk, f"g string, block bigint, path {PATH}")


def numbered(groups: DataFrame) -> DataFrame:
    """Groups (g, ...) with ``place`` in the order of ``g``: ranges are sorted apart and shifted by those before."""
    ranged = groups.repartitionByRange(max(1, partitions(groups.sparkSession)), "g")
    held = written(ranged.withColumn("part", F.spark_partition_id()), "merkle-groups")
    sizes = held.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    shifts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("g")) - 1
    return held.withColumn("own", own).join(shifts, "part").withColumn("place", F.col("own") + F.col("shift")).drop(
        "part", "own", "shift"
    )


def manifest(rows: DataFrame) -> DataFrame:
    """Root, proof and check of every row of ``rows``: (key bigint, group string, leaf string, alt string).

    ``leaf`` is the hash the manifest is made of; ``alt`` the one found later, null where it is the same.
    Returns key, leaf, subroot, root, proof_sha256, folded_root and verified, a row for every row. Within
    a group leaves stand by key (null first), then leaf hash; equal rows take places of their own, a
    null group is a group and comes first. An empty table gives an empty manifest.
    """
    g = F.coalesce(F.concat(F.lit("="), "group"), F.lit(""))  # null before all others, bytes in order
    counted = rows.groupBy(g.alias("g"), "key", "leaf", "alt").agg(F.count("*").alias("n"))
    leaves = written(counted, "merkle-leaves")
    ids = leaves.groupBy("g", "key").agg(
        F.sum("n").alias("n"), F.count("*").alias("kinds"), F.min(F.struct("leaf", "alt")).alias("one")
    )
    ids = ids.select("g", "key", "n", "kinds", F.col("one.leaf").alias("leaf"), F.col("one.alt").alias("alt"))
    nulls = ids.where("key is null").select("g", F.col("n").alias("nulls"))
    placed = written(coordinates(ids, nulls), "merkle-places")

    # Ids with several different rows: places by leaf hash, in 2**16 buckets so that no window grows with the id.
    several = placed.where("kinds > 1").select("g", F.col("key").alias("id"), "start")
    tied = leaves.alias("l").join(several.alias("s"), (F.col("l.g") == F.col("s.g")) & F.col("key").eqNullSafe(F.col("id")))
    tied = tied.select("l.g", "key", "n", "leaf", "alt", "start", F.substring("leaf", 1, 4).alias("bucket"))
    running = Window.unboundedPreceding, -1
    buckets = tied.groupBy("g", "key", "bucket").agg(F.sum("n").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("g", "key").orderBy("bucket").rowsBetween(*running))
    buckets = buckets.select("g", F.col("key").alias("id"), "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.sum("n").over(Window.partitionBy("g", "key", "bucket").orderBy("leaf", "alt").rowsBetween(*running))
    tied = tied.withColumn("within", F.coalesce(within, F.lit(0))).alias("t").join(
        buckets.alias("b"),
        (F.col("t.g") == F.col("b.g")) & F.col("key").eqNullSafe(F.col("id")) & (F.col("t.bucket") == F.col("b.bucket")),
    )
    tied = tied.select("t.g", "key", "n", "leaf", "alt", (F.col("start") + F.col("before") + F.col("within")).alias("start"))
    ranged = placed.where("kinds = 1").select("g", "key", "n", "leaf", "alt", "start").unionByName(tied)

    # A row that stands for many equal ones is cut where its places cross into the next block.
    end = F.col("start") + F.col("n")
    cut = ranged.withColumn("end", end).withColumn(
        "block", F.explode(F.sequence(F.shiftright("start", BLOCK_BITS), F.shiftright(F.col("end") - 1, BLOCK_BITS)))
    )
    floor = F.col("block") * BLOCK
    first = F.greatest("start", floor)
    nodes = cut.select(
        "g",
        "block",
        (first - floor).cast("int").alias("slot"),
        (F.least("end", floor + BLOCK) - first).cast("int").alias("count"),
        F.col("leaf").alias("hash"),
        "key",
        "alt",
    )
    totals = written(leaves.groupBy("g").agg(F.sum("n").alias("total")), "merkle-totals")
    levels, subroots = tree(nodes, totals, "rows")

    groups = numbered(subroots)
    top_nodes = groups.select(
        F.lit("").alias("g"),
        F.shiftright("place", BLOCK_BITS).alias("block"),
        F.col("place").bitwiseAND(BLOCK - 1).alias("slot"),
        F.lit(1).alias("count"),
        "hash",
        F.lit(None).alias("key"),
        F.lit(None).alias("alt"),
    )
    top_total = groups.groupBy(F.lit("").alias("g")).agg(F.count("*").alias("total"))
    top_levels, top = tree(top_nodes, top_total, "groups")
    root = (top.first() or {"hash": ""})["hash"]

    none = F.array().cast(PATH)
    above = top_total.select("g", F.lit(0).cast("bigint").alias("block"), none.alias("path"))
    for blocks in reversed(top_levels):
        above = paths(blocks, above)
    above = groups.join(above.select(F.col("block").alias("place"), "path"), "place").select(
        "g", F.lit(0).cast("bigint").alias("block"), "path"
    )
    for blocks in reversed(levels[1:]):
        above = written(paths(blocks, above), "merkle-paths")
    final = levels[0].join(above, ["g", "block"]).join(subroots.withColumnRenamed("hash", "subroot"), "g")

    def check(batches):
        names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        types = (pa.int64(), *[pa.string()] * 5, pa.bool_())
        for batch in slices(batches, 4):
            out = []
            for total, slots, path, subroot in zip(
                *(batch.column(c).to_pylist() for c in ("total", "slots", "path", "subroot"))
            ):
                sides = siblings(levels_of(slot_hashes(slots), total))
                rest = [(p["left"], p["right"]) for p in path]
                for s in slots:
                    for i in range(s["slot"], s["slot"] + s["count"]):
                        way = [level[i // FANOUT**k] for k, level in enumerate(sides)] + rest
                        proof = hashlib.sha256(b"".join(x + y for x, y in way)).hexdigest()
                        h = (s["alt"] or s["hash"]).encode()
                        for left, right in way:
                            h = hashlib.sha256(left + h + right).hexdigest().encode()
                        folded = h.decode()
                        out.append((s["key"], s["hash"], subroot, root, proof, folded, folded == root))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    schema = (
        "key bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    return map_batches(final, check, schema)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text found later: without capitals A-Z where 3 divides the CRC-32 of the id, null where it is the same."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, lower_ascii(text))


def document_manifest(df: DataFrame, doc_id="doc_id", group="lang", columns=("doc_id", "source", "lang", "n_chars", "text"), text="text"):
    """``manifest`` of the named columns of a table, against the same rows with some texts tampered with.

    Columns that are not named are not part of the leaf. A row without id is never tampered with.
    """
    values = {c: F.col(c) for c in columns}
    found = tampered_text(F.col(doc_id), F.col(text))
    alt = F.when(found.isNotNull(), leaf_hash(*(values | {text: found}).values()))
    rows = df.select(
        F.col(doc_id).cast("bigint").alias("key"),
        F.col(group).cast("string").alias("group"),
        leaf_hash(*values.values()).alias("leaf"),
        alt.alias("alt"),
    )
    return manifest(rows).withColumnRenamed("key", "doc_id")


def oracle(documents: str = "documents") -> str:
    """The same manifest in DuckDB SQL, for ids that are distinct within a language."""

    def piece(column):
        return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}::VARCHAR, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(piece(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    crc = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
            lambda c, x: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(c, x)),
            4294967295), 4294967295)"""
    return f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, coalesce('=' || lang, '') AS g, {leaf("text")} AS leaf,
        CASE WHEN text IS NOT NULL AND ({crc}) % 3 = 0
            THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS alt,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS place,
        count(*) OVER (PARTITION BY lang) AS n
    FROM {documents}),
low(g, level, place, n, h) AS (
    SELECT g, 0, place, n, leaf FROM leaves
    UNION ALL
    SELECT g, level + 1, place // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY place))
    FROM low WHERE n > 1 GROUP BY g, level, place // 8),
subroots AS (
    SELECT g, h, level, row_number() OVER (ORDER BY encode(g)) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
high(level, place, n, h) AS (
    SELECT 0, place, n, h FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY place))
    FROM high WHERE n > 1 GROUP BY level, place // 8),
root AS (SELECT h FROM high WHERE n = 1),
runs AS (
    SELECT a.g, a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS left_side,
        coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS right_side
    FROM low a JOIN low b ON a.g = b.g AND a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.n > 1 GROUP BY a.g, a.level, a.place),
top_runs AS (
    SELECT a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS left_side,
        coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS right_side
    FROM high a JOIN high b ON a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.n > 1 GROUP BY a.level, a.place),
way AS (
    SELECT l.g, l.place AS leaf_place, r.level AS step, left_side, right_side
    FROM leaves l JOIN runs r ON l.g = r.g AND r.place = l.place // (8 ** r.level)::BIGINT
    UNION ALL
    SELECT l.g, l.place, s.level + r.level, left_side, right_side
    FROM leaves l JOIN subroots s ON l.g = s.g JOIN top_runs r ON r.place = s.place // (8 ** r.level)::BIGINT),
folded(g, leaf_place, step, h) AS (
    SELECT g, place, 0, coalesce(alt, leaf) FROM leaves
    UNION ALL
    SELECT f.g, f.leaf_place, f.step + 1, sha256(left_side || f.h || right_side)
    FROM folded f JOIN way w ON f.g = w.g AND f.leaf_place = w.leaf_place AND f.step = w.step),
proofs AS (SELECT g, leaf_place, string_agg(left_side || right_side, '' ORDER BY step) AS proof FROM way GROUP BY g, leaf_place),
ends AS (SELECT g, leaf_place, arg_max(h, step) AS h FROM folded GROUP BY g, leaf_place)
SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
    e.h AS folded_root, e.h = root.h AS verified
FROM leaves l JOIN subroots s ON l.g = s.g CROSS JOIN root
LEFT JOIN proofs p ON l.g = p.g AND l.place = p.leaf_place JOIN ends e ON l.g = e.g AND l.place = e.leaf_place"""
