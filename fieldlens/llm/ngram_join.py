"""N-gram Jaccard join by vertical partitioning.

The global order of all n-grams, here the order of their 64-bit hashes, is cut into fragments, and so is the n-gram set of every document.
With at most D n-grams in which two linked documents can differ, D + 1 fragments leave at least one on which both agree wholly. Documents that
agree on a fragment are candidates. Their overlaps are counted fragment by fragment and summed per pair.

A hash of the order stands for an n-gram; the chance that two n-grams of a comparison share one is about 2**-50 for a million n-grams.
Documents of equal sets are one class from the start. Of the classes of a fragment group, pairs are candidates unless an exact bound rules them
out: each n-gram flips one of 512 parity bits, of as many as n-grams in larger sets, so sets that differ in d n-grams differ in at most d bits.
Classes that candidates tie together,
directly or by others, are a cluster, and only classes of one cluster are compared. A cluster is dealt into blocks of bounded size; a block is one row with the packed sets of its members, and all
pairs of blocks meet. There the overlaps of all members of two blocks are counted at once, fragment by fragment of the order as a product of two
incidence matrices, and summed over the fragments. What leaves the task is per member the number of its links and one edge to the smallest member
that it reaches, so rows grow with members, not with pairs, while every pair of a cluster is counted.

Texts without words, null and empty ones, have an empty set, no link, and are components of their own. Repeated rows are one class, and rows
of one doc_id are linked only if their texts are. A null id counts as the largest. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import mixed, pieces, row_key, saved, sized, word_hashes

#: Fragments of the order in which overlaps are counted and then summed.
COUNTED = 8
#: Expected members of a block of a cluster, and n-grams that they have together; blocks meet pair by pair.
BLOCK = 500
BLOCK_GRAMS = 1 << 20
#: Columns of an incidence matrix.
WIDE = 8192


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the n-word shingles of each text; of fewer words the whole sequence is one."""
    h, first = word_hashes(column)
    out, total = [], len(h)
    rows = max(0, total - n + 1)
    with np.errstate(over="ignore"):
        joined = np.zeros(rows, np.uint64)
        for k in range(n):
            joined = joined * np.uint64(0x9FB21C651E98DF25) + h[k:k + rows]
        joined = mixed(joined)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                out.append(np.unique(joined[a:b - n + 1]))
            elif b > a:
                one = np.uint64(b - a)
                for x in h[a:b]:
                    one = one * np.uint64(0x9FB21C651E98DF25) + x
                out.append(mixed(np.array([one], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def size_class(size: int, percent: int) -> int:
    """Classes 0, 1, 2, ... of sizes; sizes of linked documents are of the same class or of neighbours."""
    edges = _edges(percent, size)
    return int(np.searchsorted(edges, size, side="right")) - 1


_EDGES: dict[int, list[int]] = {}


def _edges(percent: int, size: int) -> list[int]:
    """Where classes begin: each holds sizes whose smallest is at least ``percent`` of the next class's smallest."""
    edges = _EDGES.setdefault(percent, [1])
    while edges[-1] <= size:
        edges.append(max(edges[-1] + 1, edges[-1] * 100 // percent))
    return edges


def differences(cls: int, percent: int) -> int:
    """The most n-grams in which linked sets of the classes cls - 1 and cls can differ."""
    edges = _edges(percent, 1)
    while len(edges) <= cls + 1:
        _edges(percent, edges[-1])
    most = edges[cls + 1] - 1
    # Overlap is at least percent / (100 + percent) of both sizes together, so the rest of both is what can differ.
    return (2 * most) * (100 - percent) // (100 + percent)


def fragments_of(cls: int, percent: int) -> int:
    """Fragments for that pair of classes: more than linked sets can differ in n-grams, by one and a quarter.

    Linked sets agree on as many fragments as there are more. In any order of all fragments, as many less one can be left out at the low end of
    both sets, and the highest on which they agree stays. Those of the fewest n-grams are low, which sets have in common by chance."""
    most = differences(cls, percent) + 1
    return most + most // 4


KEYED = "key long, node long"
PARITY = 8
#: Members of a fragment group up to which its pairs are looked at by their parity bits; a larger group is tied together whole.
LOOKED = 4096


def class_of(s: np.ndarray) -> np.int64:
    """One number for a set, equal for equal sets."""
    with np.errstate(over="ignore"):
        return mixed(np.array([np.add.reduce(mixed(s + np.uint64(1)), dtype=np.uint64) + np.uint64(len(s))])).view(np.int64)[0]


def parity(s: np.ndarray, width: int) -> bytes:
    """Of each of ``width`` residues, a power of two, whether an odd number of n-grams has it."""
    return np.packbits(np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1).tobytes()


def width_of(size: int) -> int:
    """Parity bits for a set: at least its n-grams, as bits fewer than two sets' differences say little about them."""
    return max(64 * PARITY, 1 << (size - 1).bit_length())


def folded(bits: bytes, width: int) -> np.ndarray:
    """Parity bits of fewer residues: those that become equal are added."""
    out = np.frombuffer(bits, np.uint64)
    while 64 * len(out) > width:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


def _measured(n: int):
    """Per document: its class, the size of its set and the parity bits; for a set of more n-grams than those also bits in its own width."""
    def run(batches):
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                sets = shingle_sets(batch.column("text")[lo:hi], n)
                wide = [parity(s, width_of(len(s))) if len(s) > 64 * PARITY else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[lo:hi], pa.array([class_of(s) if len(s) else 0 for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([parity(s, 64 * PARITY) for s in sets], pa.binary()), pa.array(wide, pa.binary())],
                    names=["doc_id", "node", "size", "bits", "wide"])

    return run


def _keyed(n: int, percent: int):
    """A key for each fragment of each set, registered in the class of its size and in the next; once per task for copies."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                keys, nodes = [], []
                for s in shingle_sets(batch.column("text")[lo:hi], n):
                    if not len(s):
                        continue
                    node, own = class_of(s), size_class(len(s), percent)
                    if int(node) in seen:
                        continue
                    seen.add(int(node))
                    with np.errstate(over="ignore"):
                        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(s, dtype=np.uint64)])
                        for cls in (own, own + 1):
                            parts = fragments_of(cls, percent)
                            number = np.arange(parts + 1, dtype=np.uint64)
                            cut = np.searchsorted(s, np.ceil(number[:-1] * (2.0 ** 64 / parts)).astype(np.uint64)).tolist() + [len(s)]
                            grams = np.diff(cut)
                            key = mixed((sums[cut[1:]] - sums[cut[:-1]]) + grams.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
                                        + mixed(number[:-1] + np.uint64(cls << 32))).view(np.int64)
                            kept = differences(cls, percent) + 1
                            if kept < parts:
                                key = key[np.lexsort((key, grams))[parts - kept:]]
                            keys.append(key)
                            nodes.append(np.full(len(key), node, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], names=["key", "node"])

    return run


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and node: (key, class, smallest class of the key) for every other class of a key with several."""
    key, low = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, nodes = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        new = np.append(keys[:1] != key if key is not None else [True], keys[1:] != keys[:-1])
        first = np.flatnonzero(new)
        lows = np.append(low, nodes[first])[np.cumsum(new)]
        other = lows != nodes
        yield pa.RecordBatch.from_arrays([pa.array(keys[other]), pa.array(nodes[other]), pa.array(lows[other])], ["key", "a", "b"])
        key, low = keys[-1], lows[-1]


def _likely(percent: int):
    """Of rows sorted by key, an edge from each class to the smallest that pairs within the bound lead to; others are ruled out for this key."""
    def tied(rows: list[tuple]) -> list[tuple[int, int]]:
        nodes = [rows[0][1]] + [r[0] for r in rows]
        if len(nodes) > LOOKED:
            return [(a, nodes[0]) for a in nodes[1:]]
        size = np.array([rows[0][3]] + [r[2] for r in rows], np.int64)
        # Sizes of a key are of two neighbouring classes, so the narrowest bits suit all.
        own = [rows[0][7] or rows[0][5]] + [r[6] or r[4] for r in rows]
        width = 8 * min(map(len, own))
        bits = np.array([folded(b, width) for b in own])
        near = np.zeros((len(nodes), len(nodes)), bool)
        for i in range(len(nodes)):
            apart = np.bitwise_count(bits ^ bits[i]).sum(1, dtype=np.int64)
            near[i] = (apart * (100 + percent) <= (size + size[i]) * (100 - percent)) & (np.minimum(size, size[i]) * 100 >= np.maximum(size, size[i]) * percent)
        label, old = np.arange(len(nodes)), None
        while old is None or (label != old).any():
            old = label
            label = np.where(near, label[None, :], len(nodes)).min(1)
        return [(nodes[i], nodes[k]) for i, k in enumerate(label.tolist()) if i != k]

    def run(batches):
        key, rows = None, []
        for batch in batches:
            edges = []
            for k, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "a", "b", "a_size", "b_size", "a_bits", "b_bits", "a_wide", "b_wide"))):
                if k != key and rows:
                    edges += tied(rows)
                    rows = []
                key = k
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([e[j] for e in edges], pa.int64()) for j in (0, 1)], ["a", "b"])
        edges = tied(rows) if rows else []
        yield pa.RecordBatch.from_arrays([pa.array([e[j] for e in edges], pa.int64()) for j in (0, 1)], ["a", "b"])

    return run


def _sets(n: int):
    """The packed set of each document."""
    def run(batches):
        for batch in batches:
            for lo, hi in pieces(batch, "text"):
                sets = [s for s in shingle_sets(batch.column("text")[lo:hi], n) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "grams"])

    return run


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``x`` with all of ``y``, counted per fragment of the order and summed."""
    out = np.zeros((len(x), len(y)), np.int64)
    if len(x) * len(y) <= 4:
        for i, a in enumerate(x):
            out[i] = [len(np.intersect1d(a, b, assume_unique=True)) for b in y]
        return out
    cut = np.array([k << 61 for k in range(1, COUNTED)], np.uint64)
    parts_x, parts_y = ([np.split(s, np.searchsorted(s, cut)) for s in side] for side in (x, y))
    for f in range(COUNTED):
        gx, gy = (np.concatenate([p[f] for p in side]) for side in (parts_x, parts_y))
        rx, ry = (np.repeat(np.arange(len(side)), [len(p[f]) for p in side]) for side in (parts_x, parts_y))
        both = np.intersect1d(gx, gy)
        if not len(both):
            continue
        cx, cy = np.searchsorted(both, gx), np.searchsorted(both, gy)
        in_x, in_y = (both[np.minimum(c, len(both) - 1)] == g for c, g in ((cx, gx), (cy, gy)))
        for start in range(0, len(both), WIDE):
            a, b = (np.zeros((len(side), min(WIDE, len(both) - start)), np.float32) for side in (x, y))
            for matrix, r, c, known in ((a, rx, cx, in_x), (b, ry, cy, in_y)):
                k = known & (c >= start) & (c < start + WIDE)
                matrix[r[k], c[k] - start] = 1
            out += (a @ b.T).astype(np.int64)  # sums of at most WIDE ones are exact
    return out


def linked(x: tuple, y: tuple | None, percent: int) -> pa.RecordBatch:
    """Per member of one or two blocks (nodes, copies, sets): rows of linked classes, and the smallest class reached by links; others give no row."""
    same = y is None
    y = x if same else y
    shared = overlaps(x[2], y[2])
    sizes = [np.array([len(s) for s in side[2]], np.int64) for side in (x, y)]
    link = shared * 100 >= (sizes[0][:, None] + sizes[1][None, :] - shared) * percent
    if same:
        np.fill_diagonal(link, False)
    nodes = x[0] if same else np.concatenate([x[0], y[0]])
    others = link @ y[1] if same else np.concatenate([link @ y[1], link.T @ x[1]])
    label, old = nodes.copy(), None
    big = np.iinfo(np.int64).max
    while old is None or (label != old).any():  # the smallest label of the neighbours, until nothing moves
        old = label
        lx, ly = (label, label) if same else (label[:len(x[0])], label[len(x[0]):])
        down = np.minimum(lx, np.where(link, ly[None, :], big).min(1, initial=big))
        label = down if same else np.concatenate([down, np.minimum(ly, np.where(link, down[:, None], big).min(0, initial=big))])
    k = np.flatnonzero(others)
    return pa.RecordBatch.from_arrays([pa.array(nodes[k]), pa.array(label[k]), pa.array(others[k].astype(np.int64))], ["node", "low", "others"])


#: Rows of links of a member, or of a packed block, with nulls in the columns of the other.
FOUND = {"node": pa.int64(), "low": pa.int64(), "others": pa.int64()}
PACKED = {"cluster": pa.int64(), "own": pa.int32(), "blocks": pa.int32(), "nodes": pa.binary(), "copies": pa.binary(), "sizes": pa.binary(), "grams": pa.binary()}
_FOUND = "node long, low long, others long"
_EITHER = f"{_FOUND}, cluster long, own int, blocks int, nodes binary, copies binary, sizes binary, grams binary"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of rows of one (cluster, own), sorted by node: (cluster, own, blocks, nodes, copies, sets), each class once."""
    held, rows = None, []

    def done():
        return (*held, np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), [np.frombuffer(r[2], np.uint64) for r in rows])

    for batch in batches:
        for cluster, own, blocks, node, copies, grams in zip(*(batch.column(c) for c in ("cluster", "own", "blocks", "node", "copies", "grams"))):
            at = (cluster.as_py(), own.as_py(), blocks.as_py())
            if at != held:
                if rows:
                    yield done()
                held, rows = at, []
            node = node.as_py()
            if not rows or rows[-1][0] != node:
                rows.append((node, copies.as_py(), grams.as_py()))
    if rows:
        yield done()


def _compared(percent: int):
    """The links of a cluster of one block; of other clusters each block as one row. Sets of near copies repeat each other, which packs well."""
    def run(batches):
        for cluster, own, blocks, nodes, copies, sets in _members(batches):
            if blocks == 1:
                if len(nodes) > 1:
                    found = linked((nodes, copies, sets), None, percent)
                    yield pa.RecordBatch.from_arrays([*found.columns, *(pa.nulls(found.num_rows, t) for t in PACKED.values())], [*FOUND, *PACKED])
                continue
            grams = zstandard.ZstdCompressor().compress(np.concatenate(sets).tobytes())
            row = (cluster, own, blocks, nodes.tobytes(), copies.tobytes(), np.array([len(s) for s in sets], np.int64).tobytes(), grams)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in FOUND.values()), *(pa.array([v], t) for v, t in zip(row, PACKED.values()))], [*FOUND, *PACKED])

    return run


def _between(percent: int):
    def block(row, side):
        nodes, copies, sizes = (np.frombuffer(row[f"{side}_{c}"], np.int64) for c in ("nodes", "copies", "sizes"))
        flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(row[f"{side}_grams"]), np.uint64)
        return nodes, copies, np.split(flat, np.cumsum(sizes)[:-1])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                yield linked(block(row, "x"), None if row["p"] == row["q"] else block(row, "y"), percent)

    return run


def _state(edges: DataFrame) -> tuple:
    """Number of edges and the sum of their hashes; equal sets of edges have equal ones."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable. Stars are drawn to the smallest neighbour until nothing moves."""
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    state = _state(edges)
    while True:
        # Large stars: every larger neighbour of a node moves to the smallest in its neighbourhood. Small stars: so do the others.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(edges.join(low, "u").select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        new = saved(small.filter("u > v").distinct())
        old, state = state, _state(new)
        edges = new
        if state == old:
            break
    roots = edges.groupBy("u").agg(F.min("v").alias("comp")).withColumnRenamed("u", "node")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))


def link_components(docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links_found) of every row of (doc_id, text).

    ``n_links_found`` is the number of other rows whose sets are linked to the document's own, rows of an equal set among them."""
    docs = docs.select("doc_id", "text")
    rows = saved(docs.mapInArrow(_measured(n), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, size long, bits binary, wide binary"))
    classes = saved(rows.filter("size > 0").groupBy("node").agg(F.min("doc_id").alias("low"), F.first("size").alias("size"), F.first("bits").alias("bits"),
                                                               F.first("wide").alias("wide"), F.count(F.lit(1)).alias("copies")))
    keyed = docs.mapInArrow(_keyed(n, percent), KEYED).repartition("key").sortWithinPartitions("key", "node")
    met = keyed.mapInArrow(_ties, "key long, a long, b long").distinct()
    for end in ("a", "b"):
        met = met.join(classes.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in ("size", "bits", "wide")]), end)
    ties = saved(met.repartition("key").sortWithinPartitions("key", "a").mapInArrow(_likely(percent), "a long, b long").distinct())
    ends = ties.select(F.col("a").alias("node")).unionByName(ties.select(F.col("b").alias("node"))).distinct()
    known = saved(components(ends, ties).withColumnRenamed("comp", "cluster").join(classes.drop("bits", "wide"), "node"))
    extent = known.groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    placed = sized(known.join(extent, "cluster").select("node", "cluster", "blocks", "copies", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")))
    texts = docs.join(sized(known.select(F.col("low").alias("rep")).distinct()), docs["doc_id"].eqNullSafe(F.col("rep")), "left_semi")
    sets = texts.mapInArrow(_sets(n), "node long, grams binary").join(placed, "node")

    met = saved(sets.repartition("cluster", "own").sortWithinPartitions("cluster", "own", "node").mapInArrow(_compared(percent), _EITHER))
    one, blocks = met.filter("node is not null").select(*FOUND), met.filter("cluster is not null").select(*PACKED)
    # All pairs of blocks of a cluster meet, one row each: a hot cluster is spread over many tasks, and no pair is left out.
    side = lambda name: F.struct("nodes", "copies", "sizes", "grams").alias(name)
    x = blocks.select("cluster", F.col("own").alias("p"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("q"), side("x"))
    y = blocks.select("cluster", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("p"), F.col("own").alias("q"), side("y"))
    pairs = x.join(y, ["cluster", "p", "q"]).select("p", "q", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("nodes", "copies", "sizes", "grams")])
    links = saved(one.unionByName(pairs.mapInArrow(_between(percent), _FOUND)))
    found = links.groupBy("node").agg(F.sum("others").alias("others"))
    links = links.select(F.col("node").alias("a"), F.col("low").alias("b"))
    nodes = known.select("node")
    state = components(nodes, links).join(known.select("node", "low"), "node")
    named = state.groupBy("comp").agg(F.min("low").alias("component_id"))
    state = state.join(named, "comp").join(found, "node", "left").select("node", "component_id", "others")
    alone = classes.select("node", "low", "copies").join(state, "node", "left").select(
        "node", F.coalesce("component_id", "low").alias("component_id"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links_found"))
    out = rows.drop("bits", "wide").join(alone, "node", "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                      .alias("component_id"), F.coalesce("n_links_found", F.lit(0)).cast("long").alias("n_links_found"))


def op1(docs: DataFrame) -> DataFrame:
    return link_components(docs, n=3, percent=90)


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are linked to one of a smaller id, null being the largest; rows of one id are told apart by their texts.
    Of rows equal in id and text one stays. Rows whose texts have no words all stay."""
    ordered = F.struct(docs["doc_id"].isNull().alias("nameless"), F.coalesce(docs["doc_id"], F.lit(0)).cast("long").alias("id"), row_key(docs).alias("key"))
    linked = link_components(docs.select(ordered.alias("doc_id"), "text")).groupBy("doc_id").agg(
        F.min("component_id").alias("_component"), ((F.count(F.lit(1)) > 1) & (F.max("n_shingles") > 0)).alias("_again"))
    kept = sized(linked.filter(F.col("doc_id") == F.col("_component")).select(F.col("doc_id.key").alias("_key"), "_again"))
    rows = docs.join(kept, row_key(docs) == F.col("_key"))
    once = rows.filter("not _again").select(*[docs[c] for c in docs.columns])
    again = rows.filter("_again").select(*[docs[c] for c in docs.columns]).dropDuplicates(["doc_id", "text"])
    return once.unionByName(again)
