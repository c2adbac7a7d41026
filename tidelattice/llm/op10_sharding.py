"""K-d tree partitioning of documents into shards of near equal bytes, with DataFrame functions only.

A node of the tree stands for a run of shards.  Each level takes, for every
node, its widest metadata dimension (by the node's extent, each dimension
scaled to its extent over all rows) and splits at the weighted quantile that
fits the shards on either side, until each leaf is one shard and so holds the
target bytes.

The quantile comes from sums, never from sorted rows.  Rows of a node are
ordered by the dimension, then by text checksum, then by a hash of the id, so
equal texts stand side by side.  The cut is found twelve bits at a time: bytes
are summed per node and digit, and only the digit that holds the cut is taken
apart again.  What leaves the executors is at most shards x 4096 sums.  The
search ends early once the digit that holds the cut is lighter than
`tolerance` of a shard.

Defined results: a NULL text has no bytes; NULL metadata counts as the least
value; repeated rows are placed one by one, in any order among equals; an empty
table gives no rows; only the named columns are read.  Law `bytes`: shards
differ by about the weight of what their cuts may not divide.  The default
dimensions are metadata of the text (size, lines, gaps, bytes beyond one a
character) and follow from it alone, so equal texts share a shard unless a cut
runs through a group heavier than `group_tolerance`, as it must through one
that is larger than a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import ordinal
from .stages import kept

DIGIT = 12
BINS = 1 << DIGIT
VALUE_BITS, CHECK_BITS = 28, 32
OVERHEAD = 8


def _per_node(values: dict[int, int], kind: str = "long") -> Column:
    """The value of each row's node (column `shard`); there are never more nodes than shards."""
    out = F.lit(None)
    for node, value in values.items():
        out = F.when(F.col("shard") == node, F.lit(value)).otherwise(out)
    return out.cast(kind)


def _scaled(column: Column, low: float | None, high: float | None) -> Column:
    """A dimension as a whole number of VALUE_BITS bits over its extent; NULL as the least."""
    if low is None or low == high:
        return F.lit(0).cast("long")
    share = (column.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
    return F.coalesce(F.floor(share * F.lit((1 << VALUE_BITS) - 1)), F.lit(0)).cast("long")


def _find_cuts(rows: DataFrame, wanted: dict[int, float], slack: float, group_slack: float) -> dict[int, tuple[int, int | None]]:
    """For each node the bounds (main, tie): rows below `main`, or at main - 1 and below `tie`, go left.

    `tie` is None if no tie has to be broken.  `rows` has shard, size, main (60 bits) and tie (36 bits).
    """
    cuts: dict[int, tuple[int, int | None]] = {}
    main_of: dict[int, int] = {}  # nodes whose cut lies among rows of one main key
    for key, bits in (("main", VALUE_BITS + CHECK_BITS), ("tie", 36)):
        open_nodes = dict.fromkeys(wanted if key == "main" else main_of, 0)  # digits found so far
        for left in range(bits - DIGIT, -1, -DIGIT):
            if not open_nodes:
                break
            # Compared as a range of the key, not digit by digit: one pair of bounds per node.
            inside = (F.col(key) >= _per_node({n: p << (left + DIGIT) for n, p in open_nodes.items()})) & (
                F.col(key) < _per_node({n: (p + 1) << (left + DIGIT) for n, p in open_nodes.items()})
            )
            if key == "tie":
                inside &= F.col("main") == _per_node(main_of)
            sums = (
                rows.filter(F.col("shard").isin(list(open_nodes)) & inside)
                .groupBy("shard", F.shiftright(key, left).alias("digits"))
                .agg(F.sum("size").alias("size"))
                .collect()
            )
            by_node: dict[int, list[tuple[int, int]]] = {}
            for row in sums:
                by_node.setdefault(row["shard"], []).append((row["digits"], row["size"]))
            for node in list(open_nodes):
                bins = sorted(by_node[node])
                at = before = 0
                while at < len(bins) - 1 and wanted[node] > before + bins[at][1]:
                    before += bins[at][1]
                    at += 1
                digits, size = bins[at]
                wanted[node] -= before
                open_nodes[node] = digits
                if size <= slack or (left == 0 and (key == "tie" or size <= group_slack)):
                    # Cut before or after this digit, whichever is nearer.
                    bound = (digits + (2 * wanted[node] >= size)) << left
                    cuts[node] = (bound, None) if key == "main" else (main_of[node] + 1, bound)
                    del open_nodes[node]
        if key == "main":
            main_of = open_nodes
    return cuts


def text_dimensions(text: Column, size: Column) -> dict[str, Column]:
    """What the text alone says of a document; shares are of the bytes with the overhead, so never of none.

    Logarithm of the size, logarithm of the newlines, share of gaps between words, share of bytes beyond one a character.
    """
    text = F.coalesce(text, F.lit(""))
    held = F.octet_length(text)
    without = lambda c: held - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return {
        "_size": F.log2(size),
        "_lines": F.log2(without("\n") + 1),
        "_gaps": without(" ") / size,
        "_wide": (held - F.length(text)) / size,
    }


def split_tree(rows: DataFrame, dimensions: list[str], shards: int, tolerance: float, group_tolerance: float) -> DataFrame:
    """(doc_id, size, text_crc32, shard) from rows with scaled dimensions, checksum and tie."""
    rows = rows.withColumn("shard", F.lit(0))
    nodes = {0: shards}
    level = 0
    while any(n > 1 for n in nodes.values()):
        level += 1
        stats = (
            rows.groupBy("shard")
            .agg(
                F.sum("size").alias("size"),
                F.array(*[F.max(d) - F.min(d) for d in dimensions]).alias("extents"),
            )
            .collect()  # one row per node
        )
        if not stats:
            break
        split = {r["shard"]: r for r in stats if nodes[r["shard"]] > 1}
        widest = {n: max(range(len(dimensions)), key=r["extents"].__getitem__) for n, r in split.items()}
        value = F.lit(0).cast("long")
        for at, name in enumerate(dimensions):
            if mine := [n for n, d in widest.items() if d == at]:
                value = F.when(F.col("shard").isin(mine), F.col(name)).otherwise(value)
        keyed = rows.withColumn("main", F.shiftleft(value, CHECK_BITS) + F.col("text_crc32"))
        wanted = {n: r["size"] * (nodes[n] // 2) / nodes[n] for n, r in split.items()}
        leaf = sum(r["size"] for r in stats) / shards
        cuts = _find_cuts(keyed, wanted, tolerance * leaf, group_tolerance * leaf)
        main = _per_node({n: m for n, (m, _) in cuts.items()})
        tie = _per_node({n: t for n, (_, t) in cuts.items() if t is not None})
        goes_left = F.when(tie.isNull(), F.col("main") < main).otherwise(
            (F.col("main") < main - 1) | ((F.col("main") == main - 1) & (F.col("tie") < tie))
        )
        step = F.when(F.col("shard").isin(list(cuts)) & ~goes_left, _per_node({n: nodes[n] // 2 for n in cuts}, "int"))
        rows = kept(
            keyed.withColumn("shard", F.col("shard") + F.coalesce(step, F.lit(0))).drop("main"), f"tree-level-{level}"
        )
        for node in set(nodes) - {r["shard"] for r in stats}:
            nodes[node] = 1  # no rows to split
        for node in cuts:
            half = nodes[node] // 2
            nodes[node + half] = nodes[node] - half
            nodes[node] = half
    return rows


def shard(
    docs: DataFrame,
    shards: int = 24,
    tolerance: float = 0.001,
    group_tolerance: float = 0.01,
    numbers: tuple[str, ...] = (),
    labels: tuple[str, ...] = (),
    rows_per_block: int = 100_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: size, checksum, shard, and a gapless slot in the shard.

    Dimensions are those of `text_dimensions` and any further columns: `numbers`
    as they are, `labels` by their checksum.  The text's checksum orders what is
    equal in the dimension that a node splits.
    """
    text = F.col(text_column).cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")
    dims = {f"_n_{c}": F.col(c).cast("double") for c in numbers}
    dims |= text_dimensions(text, size)
    dims |= {f"_l_{c}": F.crc32(F.col(c).cast("string").cast("binary")).cast("double") for c in labels}
    flat = kept(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            size.alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            *[c.alias(n) for n, c in dims.items()],
        ),
        "shard-rows",
    )
    ends = flat.agg(F.count(F.lit(1)), *[f(n) for n in dims for f in (F.min, F.max)]).first()
    rows = flat.select(
        "doc_id",
        "size",
        "text_crc32",
        F.shiftrightunsigned(F.xxhash64("doc_id"), 28).alias("tie"),
        *[_scaled(F.col(n), ends[1 + 2 * k], ends[2 + 2 * k]).alias(n) for k, n in enumerate(dims)],
    )
    placed = split_tree(rows, list(dims), shards, tolerance, group_tolerance).select("doc_id", "size", "text_crc32", "shard")
    blocks = max(1, -(-ends[0] // (shards * rows_per_block)))
    block = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks))
    slots = ordinal(placed, ["shard"], ["doc_id", "text_crc32", "size"], block, "slot")
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("slot") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
