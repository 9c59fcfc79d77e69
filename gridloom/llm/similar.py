"""Near-duplicates by SimHash, settled and completed by the exact similarity of word shingles.

Two documents link when the sets of their shingles of `width` words have a Jaccard similarity of
`least` or more. Candidates come from the SimHash links of the fingerprints and, because 64 bits
cannot reach every such pair, from shared shingles: with shingles in one common order, a pair
shares one of the first n - ceil(least * n) + 1 shingles of both, so documents that share one of
these are candidates and no pair is lost. The order puts the commonest shingles of a bounded sample last; any
order gives the same links, this one keeps the candidates few. A bitmap of every set bounds the
difference of two sets from below and drops most candidates; the texts themselves settle the rest.
Sets that share a shingle are compared by one task, which names them as families and not as pairs, and
of a family only the links that join it are rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Kept, arrow_rows, by_batch, cut, text_bytes
from .components import connected_components
from .simhash import keep_smallest, links, majority, shingle_hashes

WORDS = 16  # 64-bit words of a set's bitmap at least
MOST_WORDS = 256  # and at most, so that a group of sets stays small; texts of more than 16,384 shingles have fewer bits than these
BROADCAST_ROWS = 200_000  # of 8 to 24 bytes; how a side is joined, not which
BROADCAST_SHINGLES = 4_000_000  # of 8 bytes; whether unshared shingles are dropped before the join or by it
FAMILY_SHINGLES = 2_000_000  # of 8 bytes, of the sets of a family that one task holds; larger families go as pairs of parts
FIRST_HUBS = 2  # of a set that are settled first; all other pairs of its cells follow where these leave them apart
PARTNERS = 64  # of a text that are compared with one copy of it
BATCH_ROWS = 1_000  # texts, sets or their prefixes that an Arrow batch holds
BATCH_SETS = 200  # whole shingle sets that one holds


def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 of the word shingles; a text of fewer words is one shingle, one without words none."""
    return np.unique(shingle_hashes(text, width))


def prefix_length(n: int, least: float) -> int:
    return n - math.ceil(least * n - 1e-9) + 1 if n else 0


def set_digest(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes())


def bitmap(own: np.ndarray, words: int = WORDS) -> np.ndarray:
    """64-bit words: whether an odd number of elements falls into each of as many buckets as they have bits.

    What two sets share cancels, so the bits that differ are no more than the elements that do. The
    second half of a bitmap, folded onto the first by XOR, is the bitmap of half as many words.
    """
    bucket = (own * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    odd = np.bincount((bucket % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def wide_words(n: int) -> int:
    """Words of a bitmap with a bit for each element: WORDS, doubled as often as needed."""
    words = WORDS
    while 64 * words < n:
        words *= 2
    return words


def wide_bitmap(own: np.ndarray) -> np.ndarray:
    return bitmap(own, min(wide_words(len(own)), MOST_WORDS))


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap of fewer words."""
    while len(bits) > words:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def most_difference(n_u, n_v, least: float):
    """The elements in which sets of these sizes may differ."""
    return (1 - least) / (1 + least) * (n_u + n_v) + 1e-6


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).view(np.int64)))


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(F.col(text_col)).alias("body"))


def common_shingles(docs: DataFrame, id_col: str, text_col: str, width: int, sample_rows: int = 4096, one_in: int = 16, sample_docs: int = 3, most: int = 1_000_000) -> np.ndarray:
    """Sorted shingles of sample_docs or more of the documents of a sample; they only order the others.

    The sample is one document in one_in, or more where that gives fewer than sample_rows, so what counts
    as common does not change with the table, and cells of other shingles keep their size as it grows.
    """
    every = min(one_in, max(1, docs.count() // sample_rows))
    rows = _bodies(docs, id_col, text_col).filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([shingle_set(b, width) for b in batch.column(1).to_pylist()]).view(np.int64))], ["h"])

    found = rows.mapInArrow(by_batch(run), "h long").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= sample_docs)
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        kept = found.orderBy(F.desc("n"), "h").limit(most).select("h").toArrow()
    return np.sort(kept.column("h").to_numpy().view(np.uint64))


def _digests(docs: DataFrame, id_col: str, text_col: str, width: int, least: float, common: np.ndarray) -> DataFrame:
    """doc_id, digest (of the text), node (digest of the shingle set), n (its size), fp (SimHash), wide (bitmap of the set), prefix (the shingles by which it is found)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes, sizes, fps, wide, prefixes, late = [], [], [], [], [], shared.value
        for body in batch.column(2).to_pylist():
            hashes = shingle_hashes(body, width)
            own = np.unique(hashes)
            at = np.searchsorted(late, own)
            is_late = late[np.minimum(at, len(late) - 1)] == own if len(late) else np.zeros(len(own), bool)
            nodes.append(set_digest(own))
            sizes.append(len(own))
            fps.append(majority(hashes))
            wide.append(wide_bitmap(own))
            prefixes.append(np.concatenate([own[~is_late], own[is_late]])[: prefix_length(len(own), least)])
        signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), signed(nodes), pa.array(sizes, pa.int32()), signed(fps), _lists(wide), _lists(prefixes)], ["doc_id", "digest", "node", "n", "fp", "wide", "prefix"])

    rows = _bodies(docs, id_col, text_col).select("doc_id", F.xxhash64("body").alias("digest"), "body")
    return rows.mapInArrow(by_batch(run), "doc_id long, digest long, node long, n int, fp long, wide array<long>, prefix array<long>")


def _with(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, h of the prefix shingles that are wanted (h), looked up in a broadcast array."""
    known = rows.sparkSession.sparkContext.broadcast(np.sort(wanted.select("h").toArrow().column("h").to_numpy()))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        late, prefix = known.value, batch.column(1)
        h = prefix.flatten().to_numpy(zero_copy_only=False)
        node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(prefix.offsets.to_numpy()))
        kept = late[np.minimum(np.searchsorted(late, h), len(late) - 1)] == h if len(late) else np.zeros(len(h), bool)
        return pa.RecordBatch.from_arrays([pa.array(node[kept]), pa.array(h[kept])], ["node", "h"])

    return rows.select("node", "prefix").mapInArrow(by_batch(run), "node long, h long")


def _cells(rows: DataFrame, kept: Kept) -> DataFrame:
    """h, node, hub of every prefix shingle that several different sets have; the hub is the smallest of them."""
    found = rows.select("node", F.explode("prefix").alias("h"))
    shared = kept.keep(found.groupBy("h").agg(F.min("node").alias("hub"), F.max("node").alias("_last")).filter("hub < _last").select("h", "hub"))
    if shared.count() <= BROADCAST_SHINGLES:  # what is not shared need not move again
        found = _with(rows, shared)
    cells = kept.keep(found.join(_small(shared), "h").groupBy("h", "node").agg(F.first("hub").alias("hub")), BATCH_ROWS)
    kept.drop(shared)
    return cells


def _side_by_side(pairs: DataFrame, bodies: DataFrame, unpack: Callable, fits: Callable) -> DataFrame:
    """The pairs (u, v) whose bodies fit; bodies has one row (node, body) for each node in question.

    Of a pair the end with more pairs is its home; the home's body goes to a task once for PARTNERS of its
    partners, and each of these follows it, so a body moves once for a pair and not at both its ends. Tasks
    read the sorted rows as a stream and hold two bodies at a time: unpack(node, body) of the home, then
    fits(home, partner).
    """
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("pairs"))
    of = lambda end: ends.select(F.col("node").alias(end), F.col("pairs").alias(f"pairs_{end}"))
    swapped = F.col("pairs_v") > F.col("pairs_u")
    oriented = pairs.join(of("u"), "u").join(of("v"), "v").select(
        F.when(swapped, F.col("v")).otherwise(F.col("u")).alias("home"), F.when(swapped, F.col("u")).otherwise(F.col("v")).alias("node"), F.pmod(F.xxhash64("u", "v"), F.ceil(F.greatest("pairs_u", "pairs_v") / PARTNERS)).cast("int").alias("part")
    )
    homes = oriented.select("home", F.col("home").alias("node"), "part").distinct().withColumn("guest", F.lit(False))
    dealt = homes.unionByName(oriented.withColumn("guest", F.lit(True))).join(bodies, "node").select("home", "part", "guest", "node", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, None
        for batch in batches:
            home, part, guest, node = (c.to_pylist() for c in batch.columns[:4])
            found: list[tuple[int, int]] = []
            for row, key in enumerate(zip(home, part)):
                if not guest[row]:
                    group, own = key, unpack(node[row], batch.column(4)[row])
                elif key == group and fits(own, unpack(node[row], batch.column(4)[row])):
                    found.append((min(home[row], node[row]), max(home[row], node[row])))
            if found:
                u, v = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return dealt.repartition("home", "part").sortWithinPartitions("home", "part", "guest").mapInArrow(run, "u long, v long")


def _bounded(pairs: DataFrame, nodes: DataFrame, least: float, kept: Kept) -> DataFrame:
    """The pairs (u, v) that set sizes and bitmaps allow."""
    size = lambda end: nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"))
    near = F.least("n_u", "n_v") >= F.greatest("n_u", "n_v") * F.lit(least) - 1e-9
    sized = kept.keep(pairs.join(size("u"), "u").join(size("v"), "v").filter(near).select("u", "v"))

    def unpack(node: int, body: pa.Scalar) -> tuple[int, np.ndarray]:
        return body["n"].as_py(), body["wide"].values.to_numpy(zero_copy_only=False).view(np.uint64)

    def fits(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> bool:
        words = min(len(a[1]), len(b[1]))
        return int(np.bitwise_count(folded(a[1], words) ^ folded(b[1], words)).sum()) <= most_difference(a[0], b[0], least)

    found = kept.keep(_side_by_side(sized, nodes.select("node", F.struct("n", "wide").alias("body")), unpack, fits), BATCH_ROWS)
    kept.drop(sized)
    return found


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """node, root, n and a list of each, in order of n, for the rows (key, node, root, n, list) of one key after another."""

    def whole(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        columns = [c.chunk(0) for c in pa.Table.from_batches(held).combine_chunks().columns]
        node, root, n = (c.to_numpy(zero_copy_only=False) for c in columns[1:4])
        ends = np.cumsum(columns[4].value_lengths().to_numpy(zero_copy_only=False))
        lists = np.split(columns[4].flatten().to_numpy(zero_copy_only=False).view(np.uint64), ends[:-1])
        order = np.argsort(n, kind="stable")
        return node[order], root[order], n[order], [lists[i] for i in order]

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for lo, hi in zip(edges, edges[1:]):
            if held and hi > lo and key[lo] != last:
                yield whole(held)
                held = []
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                last = key[lo]
    if held:
        yield whole(held)


def _near(n: np.ndarray, root: np.ndarray, wide: list[np.ndarray], least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Of sets in order of size: one and those after it with another root that set sizes and bitmaps allow."""
    words = np.array([len(w) for w in wide])
    ends = np.searchsorted(n, n / least + 1e-6, side="right")
    for w in np.unique(words):
        lo, hi = np.searchsorted(words, w), np.searchsorted(words, w, side="right")
        bits = np.stack([folded(x, w) for x in wide[lo : ends[hi - 1]]])
        for i in range(lo, hi):
            at = np.flatnonzero(root[i + 1 : ends[i]] != root[i]) + i + 1
            if len(at):
                at = at[np.bitwise_count(bits[at - lo] ^ bits[i - lo]).sum(axis=1, dtype=np.int64) <= most_difference(n[at].astype(float), float(n[i]), least)]
            if len(at):
                yield i, at


def _top(parent: dict[int, int], x: int) -> int:
    while x in parent:
        parent[x] = parent.get(parent[x], parent[x])
        x = parent[x]
    return x


def _families(node: np.ndarray, root: np.ndarray, n: np.ndarray, wide: list[np.ndarray], least: float, most: int) -> Iterator[list[int]]:
    """Nodes that near pairs join, the sets of a list having about 2 * most shingles at most; each near pair is in a list."""
    parent: dict[int, int] = {}
    for i, at in _near(n, root, wide, least):
        for j in at.tolist():
            a, b = _top(parent, i), _top(parent, j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    families: dict[int, list[int]] = {}
    for i in sorted({*parent, *parent.values()}):
        families.setdefault(_top(parent, i), []).append(i)
    for family in families.values():
        part = (np.cumsum(n[family], dtype=np.int64) - n[family]) // most
        parts = [node[family][part == p] for p in np.unique(part)]
        for p, own in enumerate(parts):
            for other in parts[p + 1 :] if len(parts) > 1 else [own[:0]]:
                yield sorted(np.concatenate([own, other]).tolist())


def _joining(node: np.ndarray, root: np.ndarray, n: np.ndarray, sets: list[np.ndarray], least: float) -> Iterator[tuple[int, int]]:
    """(u, v), u < v: pairs with a similarity of `least` or more that join all roots that such pairs join; never all pairs."""
    parent: dict[int, int] = {}
    for i, at in _near(n, root, [wide_bitmap(x) for x in sets], least):
        for j in at.tolist():
            a, b = _top(parent, int(root[i])), _top(parent, int(root[j]))
            if a != b and similar(sets[i], sets[j], least):
                parent[max(a, b)] = min(a, b)
                yield min(int(node[i]), int(node[j])), max(int(node[i]), int(node[j]))


def _members(lists: DataFrame) -> DataFrame:
    """key, node of every different list (members); lists of one key by chance are compared together, which loses nothing."""
    return lists.select("members").distinct().select(F.xxhash64("members").alias("key"), F.explode("members").alias("node"))


def _rest(cells: DataFrame, docs: DataFrame, nodes: DataFrame, roots: DataFrame, id_col: str, text_col: str, width: int, least: float, cell_rows: int, kept: Kept) -> DataFrame:
    """(u, v), u < v: links that join all roots that the links of all cells join.

    A cell is dealt into chunks of about cell_rows rows, a root of cell_rows rows and more having
    chunks of its own; each pair of chunks is one group of bounded size, and chunks of one root are
    not compared, so a cell in which one root is common costs no square. Groups of the same sets, as
    cells of one passage give them, are one. A group's task says which of its sets set sizes and
    bitmaps allow to link, as families; those of a family are then settled by one task from their whole
    shingle sets. So neither step makes more rows than a group has sets, however many pairs they form.
    """
    rooted = kept.keep(cells.select("h", "node").join(roots, "node"))
    per_root = rooted.groupBy("h", "root").agg(F.count("*").alias("rows"))
    wide = F.col("rows") >= cell_rows
    per_cell = kept.keep(
        per_root.groupBy("h")
        .agg(F.count("*").alias("roots"), F.collect_list(F.when(wide, F.struct("root", F.ceil(F.col("rows") / cell_rows).cast("int").alias("k")))).alias("large"), F.sum(F.when(~wide, F.col("rows")).otherwise(0)).alias("small"))
        .filter("roots > 1")
        .select("h", "large", F.ceil(F.col("small") / cell_rows).cast("int").alias("k"))
    )
    own_large = F.try_element_at(F.filter("large", lambda x: x["root"] == F.col("root")), F.lit(1))
    spread = lambda k: F.pmod(F.xxhash64("node"), F.greatest(k, F.lit(1))).cast("int")
    chunk = lambda root, i: F.struct(root.alias("root"), i.alias("i"))
    counted = lambda k, root: F.transform(F.sequence(F.lit(1), k), lambda i: chunk(root, i - 1))
    none = F.lit(None).cast("long")
    small = F.when(F.col("k") > 0, counted(F.col("k"), none)).otherwise(F.array().cast("array<struct<root: bigint, i: int>>"))
    chunks = F.concat(small, F.flatten(F.transform("large", lambda x: counted(x["k"], x["root"]))))
    mine = F.col("_large")
    dealt = (
        rooted.join(_small(per_cell), "h")
        .withColumn("_large", F.when(F.size("large") > 0, own_large))
        .withColumn("own", F.when(mine.isNull(), chunk(none, spread(F.col("k")))).otherwise(chunk(mine["root"], spread(mine["k"]))))
        .withColumn("other", F.explode(F.filter(chunks, lambda x: mine.isNull() | x["root"].isNull() | (x["root"] != mine["root"]))))
        .groupBy("h", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
        .agg(F.sort_array(F.collect_list("node")).alias("members"))
        .filter(F.size("members") > 1)
    )
    known = nodes.select("node", "n", "wide").join(roots, "node").select("node", "root", "n", F.col("wide").alias("body"))

    def dealt_by_key(lists: DataFrame, bodies: DataFrame) -> DataFrame:
        return _members(lists).join(bodies, "node").select("key", "node", "root", "n", "body").repartition("key").sortWithinPartitions("key")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches):
            found = list(_families(*group, least, FAMILY_SHINGLES))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], ["members"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches):
            found = list(_joining(*group, least))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["u", "v"])

    families = kept.keep(dealt_by_key(dealt, known).mapInArrow(name, "members array<long>").distinct(), BATCH_ROWS)
    kept.drop(rooted, per_cell)
    texts = _texts(families.select(F.explode("members").alias("node")), docs, nodes, id_col, text_col, kept)

    def shingles(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(body, width) for body in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int32()), _lists(sets)], ["node", "n", "body"])

    sets = kept.keep(texts.select("node", "body").mapInArrow(by_batch(shingles), "node long, n int, body array<long>").join(roots, "node"), BATCH_SETS)
    links_ = kept.keep(dealt_by_key(families, sets).mapInArrow(settle, "u long, v long").distinct(), BATCH_SETS)
    kept.drop(families, texts, sets)
    return links_


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return both >= least * (len(a) + len(b) - both) - 1e-9


def _texts(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, kept: Kept) -> DataFrame:
    """node, body: one text of every wanted set."""
    first = nodes.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.digest").alias("digest"))
    named = kept.keep(wanted.distinct().join(first, "node"))
    bodies = _bodies(docs, id_col, text_col).join(_small(named), "doc_id").filter(F.xxhash64("body") == F.col("digest"))
    texts = kept.keep(bodies.groupBy("node").agg(F.first("body").alias("body")))  # of repeated rows one
    kept.drop(named)
    return texts


def _settled(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, least: float, kept: Kept) -> DataFrame:
    """The pairs whose whole shingle sets have a similarity of `least` or more, from one text of each set."""
    texts = _texts(pairs.select(F.explode(F.array("u", "v")).alias("node")), docs, nodes, id_col, text_col, kept)

    def unpack(node: int, body: pa.Scalar) -> np.ndarray:
        return shingle_set(body.as_py(), width)

    found = kept.keep(_side_by_side(pairs, texts, unpack, lambda a, b: similar(a, b, least)), batch_rows=500)
    kept.drop(texts)
    return found


def _parts(docs: DataFrame, id_col: str, text_col: str, width: int, least: float, cell_rows: int) -> DataFrame:
    """doc_id, digest, root, component_id for every row of docs."""
    kept = Kept(docs.sparkSession)
    rows = kept.keep(_digests(docs, id_col, text_col, width, least, common_shingles(docs, id_col, text_col, width)), batch_rows=1000)
    nodes = kept.keep(rows.groupBy("node").agg(F.min(F.struct("doc_id", "digest")).alias("first"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("wide").alias("wide")))
    cells = _cells(rows, kept)
    ordered = lambda df: df.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v").distinct()
    of_fp = kept.keep(nodes.groupBy("fp").agg(F.min("node").alias("hub")))
    equal = nodes.join(of_fp, "fp").select(F.col("hub").alias("u"), F.col("node").alias("v"))
    hub = lambda end: of_fp.select(F.col("fp").alias(f"fp_{end}"), F.col("hub").alias(end))
    near = links(of_fp.select("fp"), cell_rows=cell_rows).toDF("fp_u", "fp_v").join(hub("u"), "fp_u").join(hub("v"), "fp_v").select("u", "v")
    often = W.partitionBy("node").orderBy(F.desc("cells"), "hub")  # at most as many hubs as the node has prefix shingles
    hubs = cells.filter("hub <> node").groupBy("node", "hub").agg(F.count("*").alias("cells")).withColumn("place", F.row_number().over(often))
    stars = hubs.filter(F.col("place") <= FIRST_HUBS).select(F.col("hub").alias("u"), F.col("node").alias("v"))
    first = _bounded(ordered(stars.unionByName(equal).unionByName(near)), nodes, least, kept)
    edges = _settled(first, docs, nodes, id_col, text_col, width, least, kept)
    roots = kept.keep(nodes.select("node").join(connected_components(edges), "node", "left").withColumn("root", F.coalesce("root", "node")))
    more = _rest(cells, docs, nodes, roots, id_col, text_col, width, least, cell_rows, kept)
    kept.drop(cells, first, edges)
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    joined_roots = more.join(of("u"), "u").join(of("v"), "v").select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))
    merged = connected_components(joined_roots).select(F.col("node").alias("root"), F.col("root").alias("final"))
    joined = kept.keep(nodes.select("node", F.col("first.doc_id").alias("least")).join(roots, "node").join(merged, "root", "left").select("node", "least", F.coalesce("final", "root").alias("root")))
    smallest = kept.keep(joined.groupBy("root").agg(F.min("least").alias("component_id")))
    named = cut(rows.select("doc_id", "digest", "node").join(joined.join(smallest, "root").select("node", "root", "component_id"), "node").select("doc_id", "digest", "root", "component_id"))
    kept.close()
    return named


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8, cell_rows: int = 2048) -> DataFrame:
    """doc_id, component_id for every row of docs.

    Documents link when their shingle sets have a similarity of `least` or more; component_id is the smallest
    doc_id that can be reached. Equal sets are folded into one before any join. Texts without words
    (null and empty ones among them) are alike. SimHash links and every cell's smallest set are
    settled first; pairs that this leaves in different components are then compared in full, so a
    tight group of copies costs no square. Repeated rows are returned as often as they occur, null
    ids have no component of their own, an empty table gives no rows.
    """
    return _parts(docs, id_col, text_col, width, least, cell_rows).select("doc_id", "component_id")


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8) -> DataFrame:
    """The documents without near-duplicates: of each component only the document with its smallest id stays.

    Rows without an id cannot be named by a component and all stay; of repeated rows one stays; of
    different texts under one id each stays that leads a component of its own.
    """
    return keep_smallest(docs, _parts(docs.filter(F.col(id_col).isNotNull()), id_col, text_col, width, least, 2048), id_col, text_col)
