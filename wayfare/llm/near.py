"""Near-duplicate classes with an LSH forest, every link confirmed on the full sets of word shingles.

1. Each text becomes its set of distinct word shingles, a name of that set and
   a MinHash signature.  Equal sets are one class from here on, so exact copies
   never meet each other.
2. The forest: ``TREES`` orders of the classes, each sorted by its own sequence
   of signature values, so that those with the longest common prefix are
   neighbours.  Classes that share a prefix are a region.  Its depth adapts:
   ``SHALLOW`` values where no more than ``SPARSE`` classes share them, else
   ``DEPTH``.  All pairs of a region are candidates whose signatures agree
   often enough.  A region of more than ``REGION`` classes, and one that a
   border between sorted partitions may cut, is not searched but taken
   whole: its classes all count as candidates of each other, so no pair is
   lost to size or borders.  A region gives each of its classes one row, the
   class and a head that stands for all it is linked with, however many pairs
   there are.  Candidates only gather classes into clusters.
3. Inside each cluster every pair is compared that its signatures allow, on the
   full sets, save those already linked to each other by confirmed links.
   Clusters beyond a size are cut into blocks in two ways, and the classes of
   a block compared.  Most near copies are one group then, as the ways
   cross: each class goes to two tasks, however large its cluster.  What is left
   of the cluster beside its largest group is compared with that group and
   among itself, block by block, so all pairs of unlike groups are looked at
   and no cluster is dropped or sampled.  A task too gives each class one row
   at most.
4. Confirmed links join into components.

A pair at the threshold shares no region with probability (1 - 0.8**3)**16,
about 1e-5, at depth 3 and 1e-7 where regions are sparse.

Null or empty texts have an empty set and are linked with nothing.  A text
shorter than a shingle is one shingle of all its words.  Rows with equal ids
or equal texts stay separate rows with one component.  The component of rows
without any id is null; such rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayfare.llm import anchors, carried, flat
from wayfare.llm.anchors import written
from wayfare.llm.components import from_heads

SHINGLE = 5
SIMILARITY = 80  # percent

TREES = 16
DEPTH = 3
VALUES = TREES * DEPTH
#: Signature values that an order sorts by.
SORTED = 6
#: Values that a region shares where it has no more than SPARSE classes.
SHALLOW = 2
SPARSE = 64
#: Classes up to which a region's pairs are searched.
REGION = 2048
#: Neighbours that are compared all at once; the rest of larger regions follows class by class.
REACH = 4
#: Agreeing values of a pair at least; a link at the threshold has 38 on average and fewer than 26 once in 1e5.
AGREEING = 26

#: Shingles of the classes that one task compares, about.
BLOCK_SHINGLES = 400_000

_SEEDS = np.random.default_rng(77).integers(0, 2**64, (VALUES, 2), dtype=np.uint64) | np.uint64(1)


class ShingleSets:
    """The distinct shingles of each row, sorted, one row after another."""

    def __init__(self, texts: pa.Array, size: int):
        raw, at = flat.flat_bytes(texts)
        starts, ends, first = flat.word_spans(raw, at, flat.PLAIN_WORD)
        words = flat.word_hashes(raw, starts, ends, flat.FOLDED_VALUES)
        windows = flat.Windows(words)
        count = np.diff(first)
        begins = np.flatnonzero(anchors.whole(first, size))
        row = np.searchsorted(first, begins, "right") - 1
        short = np.flatnonzero((count > 0) & (count < size))
        hashes = np.concatenate([windows.of(begins, begins + size), windows.of(first[short], first[short] + count[short])])
        row = np.concatenate([row, short])
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        keep = np.ones(len(row), bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        self.hashes, self.row = hashes[keep], row[keep]
        self.at = np.searchsorted(self.row, np.arange(len(texts) + 1))

    def names(self) -> np.ndarray:
        """16 bytes that name each set."""
        out = np.zeros((len(self.at) - 1, 2), np.uint64)
        for lane, factor in enumerate((0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)):
            total = np.concatenate(([0], np.cumsum(flat.mix(self.hashes * np.uint64(factor))))).astype(np.uint64)
            out[:, lane] = flat.mix(total[self.at[1:]] - total[self.at[:-1]] + np.uint64(lane))
        return out

    def signatures(self) -> np.ndarray:
        """VALUES smallest hashes (32 bits) of each set; those of an empty set are 0."""
        full = np.flatnonzero(np.diff(self.at))
        out = np.zeros((len(self.at) - 1, VALUES), np.uint32)
        if len(full):
            for j, (add, factor) in enumerate(_SEEDS):
                mixed = (self.hashes ^ add) * factor
                out[full, j] = np.minimum.reduceat(mixed >> np.uint64(32), self.at[full]).astype(np.uint32)
        return out


def _fixed(rows: np.ndarray) -> pa.Array:
    """Each row of a byte matrix as one binary value."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _sketch(key: str, text: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            sets = ShingleSets(rows.column(text), size)
            names = sets.names().view(np.uint8).reshape(-1, 16)
            signatures = sets.signatures().astype(">u4").view(np.uint8).reshape(-1, 4 * VALUES)
            yield pa.record_batch(
                [rows.column(key), rows.column("_row"), pa.array(np.diff(sets.at).astype(np.int64)), _fixed(names),
                 _fixed(signatures)], names=[key, "_row", "n_shingles", "_node", "_signature"])

    return run


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each class once for each order: the values it is sorted by, and a byte of every value."""
    for rows in batches:
        for part in range(0, rows.num_rows, 4096):
            piece = rows.slice(part, 4096)
            n = piece.num_rows
            raw, _ = flat.flat_bytes(piece.column("_signature"))
            values = raw.reshape(n, VALUES, 4)
            low = _fixed(values[:, :, 3])
            for tree in range(TREES):
                picked = (np.arange(SORTED) + tree * DEPTH) % VALUES
                head = np.full((n, 1), tree, np.uint8)
                order = np.concatenate([head, values[:, picked].reshape(n, -1)], axis=1)
                yield pa.record_batch([_fixed(order), piece.column("_node"), low], names=["_order", "_node", "_low"])


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.count_nonzero(a == b, axis=-1)


def _opens(prefix: np.ndarray) -> np.ndarray:
    """True for each row whose prefix differs from the row before."""
    out = np.ones(len(prefix), bool)
    out[1:] = (prefix[1:] != prefix[:-1]).any(axis=1)
    return out


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Head and class for the candidates of each region of a sorted partition."""
    held: pa.RecordBatch | None = None
    opening = b""  # prefix of the partition's first region, which a border may cut
    dense = large = b""  # prefixes of held rows whose regions are known to be so
    for rows, last in _with_last(batches):
        if held is not None:
            rows = pa.concat_batches([held, rows])
        n = rows.num_rows
        if not n:
            continue
        order = flat.flat_bytes(rows.column("_order"))[0].reshape(n, -1)
        deep, shallow = order[:, : 1 + 4 * DEPTH], order[:, : 1 + 4 * SHALLOW]
        opens_deep, opens_shallow = _opens(deep), _opens(shallow)
        of_deep, of_shallow = np.cumsum(opens_deep) - 1, np.cumsum(opens_shallow) - 1
        is_dense = np.bincount(of_shallow) > SPARSE
        is_dense[0] |= shallow[0].tobytes() == dense
        whole = np.bincount(of_deep) > REGION
        opening = opening or deep[0].tobytes()
        whole[0] |= deep[0].tobytes() in (opening, large)
        whole[-1] |= last
        # What a following batch may go on with waits for it.
        cut = n if last else int(np.flatnonzero(opens_deep if is_dense[-1] else opens_shallow)[-1])
        dense = shallow[-1].tobytes() if is_dense[-1] else b""
        large = deep[-1].tobytes() if whole[-1] and is_dense[-1] else b""
        if large:
            cut = n
        held = rows.slice(cut) if cut < n else None
        node = rows.column("_node").to_numpy(zero_copy_only=False)
        taken = np.flatnonzero(whole[of_deep[:cut]])
        heads = [b"R" + deep[i].tobytes() for i in taken]
        opens = np.where(is_dense[of_shallow], opens_deep, opens_shallow)[:cut]
        low = flat.flat_bytes(rows.column("_low"))[0].reshape(n, VALUES)[:cut]
        head, member = _forest(np.flatnonzero(opens), low)
        yield pa.record_batch(
            [pa.array([*heads, *node[head]], pa.binary()), pa.array([*node[taken], *node[member]], pa.binary())],
            names=["head", "node"])


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Each batch, and whether it is the last one."""
    before = None
    for rows in batches:
        if before is not None:
            yield before, False
        before = rows
    if before is not None:
        yield before, True


def _forest(opens: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and head of every row that is linked with another one of its region; regions are sorted rows.

    Regions of more than REGION rows are left out: they count as linked anyway.
    """
    n = len(low)
    sizes = np.diff(np.append(opens, n))
    region = np.repeat(np.arange(len(opens)), sizes)
    a, b = [], []
    for step in range(1, min(REACH, n - 1) + 1):
        near = np.flatnonzero(region[step:] == region[:-step])
        near = near[sizes[region[near]] <= REGION]
        near = near[_agreement(low[near], low[near + step]) >= AGREEING]
        a.append(near)
        b.append(near + step)
    label = _joined(n, np.concatenate(a), np.concatenate(b)) if a else np.arange(n)
    for k in np.flatnonzero((sizes > REACH + 1) & (sizes <= REGION)):
        rows = slice(opens[k], opens[k] + sizes[k])
        _join_rest(label[rows], low[rows])
    times = np.bincount(label, minlength=n)
    member = np.flatnonzero(times[label] > 1)
    return label[member], member


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each row is linked with over the links a-b."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, before[a], least)
        np.minimum.at(label, before[b], least)
        label = np.minimum(label, label[label])
        if (label == before).all():
            return label


def _join_rest(label: np.ndarray, low: np.ndarray) -> None:
    """Join the labels of all rows of a region that agree; rows of the largest group meet the others from there."""
    values, times = np.unique(label, return_counts=True)
    largest = values[times.argmax()]
    for i in np.flatnonzero(label != largest):
        if label[i] == largest:
            continue
        met = np.unique(label[_agreement(low, low[i]) >= AGREEING])
        if len(met) > 1:
            to = met.min()
            label[np.isin(label, met)] = to
            largest = to if largest in met else largest


def _confirm(text: str, size: int, percent: int):
    """Head and group for the groups of each task that confirmed links connect; ``_group`` names what is known as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tasks(anchors.unlike_neighbours(batches, ["_task", "_node"])):
            sets = ShingleSets(rows.column(text), size)
            group = rows.column("_group")
            _, first, own = np.unique(group.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
            label = _links(sets, rows.column("_side").to_numpy(), first[own], percent)
            # The first row of each group speaks for it.
            member = first[np.bincount(label[first], minlength=len(label))[label[first]] > 1]
            yield pa.record_batch([group.take(pa.array(x)) for x in (label[member], member)], names=["head", "node"])

    return run


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of whole clusters (or pairs of blocks), sorted by ``_task``; small ones together."""
    held: list[pa.RecordBatch] = []
    for rows in batches:
        task = np.array(rows.column("_task").to_pylist(), object)
        cuts = [*(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), rows.num_rows]
        begin = 0
        for cut in cuts:
            part = rows.slice(begin, cut - begin)
            if held and held[-1].column("_task")[0].as_py() != task[begin]:
                yield pa.concat_batches(held)
                held = []
            held.append(part)
            begin = cut
    if held:
        yield pa.concat_batches(held)


def _links(sets: ShingleSets, side: np.ndarray, label: np.ndarray, percent: int) -> np.ndarray:
    """The labels of the rows after confirmed links, equal for rows that they connect.

    Rows of side 0 are compared with each other, those of sides 1 and 2 with the
    other side; rows that have one label already are not compared.
    """
    n = len(side)
    low = (sets.signatures() & np.uint32(0xFF)).astype(np.uint8)
    sizes = np.diff(sets.at)
    label = label.copy()
    for i in range(n):
        others = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        others = others[(side[others] == 0) | (side[others] != side[i])]
        smaller, larger = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
        others = others[(100 * smaller >= percent * larger) & (smaller > 0)]
        others = others[_agreement(low[others], low[i]) >= AGREEING]
        if not len(others):
            continue
        own = sets.hashes[sets.at[i] : sets.at[i + 1]]
        theirs = sets.hashes[flat.ragged_arange(sets.at[others], sizes[others])]
        place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        stops = np.concatenate(([0], np.cumsum(sizes[others])))
        met = np.concatenate(([0], np.cumsum(own[place] == theirs)))
        common = met[stops[1:]] - met[stops[:-1]]
        linked = others[100 * common >= percent * (sizes[i] + sizes[others] - common)]
        if len(linked):
            label[np.isin(label, label[linked])] = label[i]
    return label


def _blocks(shingles: Column) -> Column:
    """Blocks that so many shingles are cut into."""
    return F.ceil(shingles / BLOCK_SHINGLES).cast("int")


def _block(blocks: Column, way: int) -> Column:
    return F.pmod(F.xxhash64("_node", F.lit(way)), blocks).cast("int")


def _rest(inside: DataFrame, joined: DataFrame) -> DataFrame:
    """The classes of clusters of many blocks that are not one group yet.

    ``_group`` is what a class is joined with, ``_large`` whether that is the
    cluster's largest group, ``_blocks`` and ``_others`` into how many blocks
    that group and all the others are cut.
    """
    group = joined.select(F.col("node").alias("_node"), F.col("component").alias("_joined"))
    grouped = inside.select("_half", "component", "_node", "n_shingles").join(group, "_node", "left").select(
        "_half", "component", "_node", "n_shingles", F.coalesce("_joined", "_node").alias("_group"))
    sizes = grouped.groupBy("_half", "component", "_group").agg(F.sum("n_shingles").alias("_size"))
    known = sizes.groupBy("_half", "component").agg(
        F.max_by("_group", F.struct("_size", "_group")).alias("_largest"), F.max("_size").alias("_most"),
        F.sum("_size").alias("_all"),
    ).where((_blocks(F.col("_all")) > 1) & (F.col("_all") > F.col("_most"))).select(
        "_half", "component", "_largest", _blocks(F.col("_most")).alias("_blocks"),
        _blocks(F.col("_all") - F.col("_most")).alias("_others"),
    )
    return grouped.join(anchors.anew(known, "_half"), ["_half", "component"]).select(
        "_node", "component", "_group", (F.col("_group") == F.col("_largest")).alias("_large"), "_blocks", "_others")


def _opposed(rest: DataFrame, text: str) -> DataFrame:
    """Tasks that bring each class outside the largest group together with every class of its cluster."""
    large, other = _block(F.col("_blocks"), 3), _block(F.col("_others"), 4)

    def upto(blocks: str) -> Column:
        return F.sequence(F.lit(0), F.col(blocks) - 1)

    def task(kind: str, a: Column, b: Column) -> Column:
        return F.concat_ws("-", F.hex("component"), F.lit(kind), a, b).alias("_task")

    def side(is_: Column) -> Column:
        return is_.cast("int").alias("_side")

    names = F.transform(upto("_others"), lambda b: F.struct(task("large", large, b), side(F.lit(1))))
    against = F.transform(upto("_blocks"), lambda b: F.struct(task("large", b, other), side(F.lit(2))))
    among = F.transform(upto("_others"), lambda b: F.struct(
        task("other", F.least(b, other), F.greatest(b, other)),
        side(F.when(b == other, 0).when(b < other, 1).otherwise(2))))
    dealt = F.inline(F.when(F.col("_large"), names).otherwise(F.concat(against, among)))
    return rest.select("_group", "_node", text, dealt)


def classes(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = SIMILARITY,
) -> DataFrame:
    """Key, ``_row`` (a hash of the text), ``n_shingles`` and ``component_id`` of every row."""
    docs = docs.select(key, F.xxhash64(text).alias("_row"), text)
    field = docs.schema
    sketches = written(docs.mapInArrow(_sketch(key, text, shingle), T.StructType([
        field[key], field["_row"], T.StructField("n_shingles", T.LongType(), False),
        T.StructField("_node", T.BinaryType(), False), T.StructField("_signature", T.BinaryType(), False),
    ])), "sketches")

    rows = sketches.count()
    sets = written(sketches.where("n_shingles > 0").groupBy("_node").agg(
        F.min(key).alias("_least"), F.min_by(F.struct(key, "_row", "_signature"), "_row").alias("_one"),
        F.first("n_shingles").alias("n_shingles"),
    ).select("_node", "_least", "n_shingles", "_one.*"), "sets", rows)

    orders = sets.select("_node", "_signature").mapInArrow(_orders, T.StructType(
        [T.StructField(c, T.BinaryType(), False) for c in ("_order", "_node", "_low")]
    ))
    pair = T.StructType([T.StructField(c, T.BinaryType(), False) for c in ("head", "node")])
    ordered = orders.repartitionByRange("_order", "_node").sortWithinPartitions("_order", "_node")
    clusters = from_heads(ordered.mapInArrow(_regions, pair)).withColumnRenamed("node", "_node")

    gathered = clusters.count()
    inside = sets.select("_node", key, "_row", "n_shingles").join(clusters, "_node")
    inside = written(inside.withColumn("_half", F.xxhash64("component")), "clusters", gathered)
    sizes = inside.groupBy("_half", "component").agg(_blocks(F.sum("n_shingles")).alias("_blocks"))
    placed = inside.join(anchors.anew(sizes, "_half"), ["_half", "component"]).select(
        F.col(key).alias("_placed"), F.col("_row").alias("_text_row"), "_node", "component", "_blocks",
    )
    here = docs[key].eqNullSafe(F.col("_placed")) & (docs["_row"] == F.col("_text_row"))
    texts = docs.join(placed, here).select("_node", "component", "_blocks", text)
    # Repeated rows bring a text again, sorted next to each other by the join.
    texts = written(texts.mapInArrow(lambda batches: anchors.unlike_neighbours(batches, ["_node"]), texts.schema), "texts")

    def confirmed(tasks: DataFrame) -> DataFrame:
        dealt = tasks.select("_task", "_side", "_group", "_node", text).repartition("_task")
        return dealt.sortWithinPartitions("_task", "_node").mapInArrow(_confirm(text, shingle, percent), pair)

    ways = F.when(F.col("_blocks") == 1, F.array(F.lit("0"))).otherwise(F.array(*[
        F.concat_ws("-", F.lit(way), _block(F.col("_blocks"), way)) for way in (1, 2)]))
    joined = written(from_heads(confirmed(texts.withColumn("_way", F.explode(ways)).select(
        F.concat_ws("-", F.hex("component"), "_way").alias("_task"), F.lit(0).alias("_side"), F.col("_node").alias("_group"),
        "_node", text,
    ))), "joined", gathered)
    rest = written(_rest(inside, joined), "rest", gathered)
    if rest.limit(1).count():
        links = confirmed(_opposed(texts.select("_node", text).join(rest, "_node"), text))
        joined = from_heads(links.union(joined.select(F.col("component").alias("head"), "node")))
    joined = joined.withColumnRenamed("node", "_node")

    linked = written(sets.select("_node", "_least").join(joined, "_node").withColumn("_half", F.xxhash64("component")),
                     "linked", gathered)
    least = linked.groupBy("_half", "component").agg(F.min("_least").alias("component_id"))
    merged = linked.join(anchors.anew(least, "_half"), ["_half", "component"]).select("_node", "component", "component_id")
    named = sets.select("_node", "_least").join(merged, "_node", "left").select(
        "_node", F.xxhash64("_node").alias("_half"), F.coalesce("component", "_node").alias("component"),
        F.when(F.col("component").isNull(), F.col("_least")).otherwise(F.col("component_id")).alias("component_id"),
    )
    rows_of = sketches.select(key, "_row", "n_shingles", "_node", F.xxhash64("_node").alias("_half"))
    result = rows_of.join(anchors.anew(named, "_half"), ["_half", "_node"], "left")
    return result.select(
        key, "_row", "n_shingles", "component",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id"),
    )


def deduplicate(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every component, one with its smallest id; rows without words all stay.

    Rows that repeat both id and text count as one row.
    """
    rows = carried.packed(docs, key, text)
    key_, text_ = carried.KEY, carried.TEXT
    found = classes(rows, key=key_, text=text_, **options)
    leaders = found.where((F.col("n_shingles") > 0) & F.col(key_).eqNullSafe(F.col("component_id")))
    leaders = leaders.groupBy("component").agg(F.min_by(F.struct(key_, "_row"), "_row").alias("_one")).select("_one.*")
    stay = leaders.union(found.where("n_shingles = 0").select(key_, "_row")).select(
        F.col(key_).alias("_stay"), F.col("_row").alias("_text_row")
    ).distinct()
    named = rows.withColumn("_row", F.xxhash64(text_))
    here = named[key_].eqNullSafe(F.col("_stay")) & (named["_row"] == F.col("_text_row"))
    kept = named.join(stay, here, "left_semi").dropDuplicates([key_, "_row"])
    return carried.unpacked(kept, docs, key, text)
