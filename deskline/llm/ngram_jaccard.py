"""Similarity join of documents on the Jaccard similarity of their word n-grams, by the
rarest n-grams of each document and parity sketches.

Two sets with a similarity of t or more have at least t * size n-grams of either in
common. If all sets are put in one order, the first size - ceil(t * size) + 1 n-grams of
both therefore hold a common one (pigeonhole). The order is by how often an n-gram occurs
in the table, the rarest first, so documents are not brought together by a passage that
many share as long as a small part of them is their own.

Pairs found so are compared by sketches. Each set is dealt over parts by hash, and every
n-gram flips one of the bits of its part. An n-gram in one set only flips one bit, so the
Hamming distance of two sketches is at most the symmetric difference of their sets. Two
sets of at most u n-grams with a similarity of t or more differ by no more than
D = 2u(1-t)/(1+t); there are D + 1 parts, so that one at least is equal in both. Sketches
are made for each band of sizes, whose upper end gives u.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskline.llm.common import fresh, saved, table_of
from deskline.llm.components import connected_components
from deskline.llm.hashing import WordHasher, mix, seeded, shingles

# Sizes of a band lie between a power of this and the next one.
_BAND_GROWTH = 1.5
# Nodes of a shared n-gram that one task compares with those of another such block.
_BLOCK = 512
# N-grams that are counted together: those of a block of texts are sent to ranges of
# hashes, and come back with their counts.
_BLOCK_GRAMS = 1 << 20
_RANGE_GRAMS = 1 << 22
# Up to this many 64-bit keys are broadcast to fetch texts; more are joined by shuffle.
_BROADCAST_KEYS = 500_000
# Two nodes, the smaller one first, and a text of each.
_PAIRS = "a long, b long, key_a long, key_b long"


class Scheme(NamedTuple):
    """How the sets of one band are dealt. ``parts`` = D + 1."""

    band: int
    parts: int


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row for each row of ``docs``: ``id``, ``n_shingles`` (size of its set),
    ``component_id`` (the smallest id that links reach, itself included) and
    ``text_key`` (a hash of the text).

    Words are runs of anything but ASCII white space, with A-Z folded; a set holds the
    distinct runs of ``words`` words, or the whole sequence of a shorter text. Two rows
    link when 100 * intersection >= ``percent`` * union. Rows without words link with
    nothing.

    Equal sets are one node. How often each n-gram occurs is counted (see
    :func:`_rarest`), and nodes that share one of their rarest are first compared with the
    smallest of them only, by their sketches; then nodes of different such groups are, in
    blocks, and a spanning forest of the pairs within the bound is taken. These pairs are
    verified on whole texts. Where one is no link, the nodes that these pairs connect are
    compared by their whole sets, in blocks, until they are one component or no two
    components have a link. So pairs are in proportion to the size of a group, and no
    link between components is lost.

    Null texts count as empty. Rows with the same id are one document, their texts link.
    A null id is a document of its own; its component has the smallest id in it, null if
    there is none. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType
    sets = table_of(
        keyed.select("id", "text_key", "text").mapInArrow(
            lambda batches: _sets(batches, words), f"id {id_type.simpleString()}, text_key long, node long, n_shingles long"
        ),
        "jaccard-sets",
    )
    keys = table_of(_rarest(sets, keyed, words, percent), "jaccard-keys")
    # Of an n-gram in two nodes, the smallest and the largest node are all; only crowded
    # ones have to be looked up again.
    ends = [F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("n")]
    shared = table_of(keys.groupBy("key").agg(*ends).where("low != high"), "jaccard-shared")
    crowded = shared.where("n > 2").select("key", "low")
    if crowded.count() <= _BROADCAST_KEYS:
        crowded = F.broadcast(crowded)
    both = shared.where("n = 2").select("key", F.explode(F.array("low", "high")).alias("node"), "low")
    members = table_of(both.unionByName(keys.join(crowded, "key").distinct()), "jaccard-members")
    # Only nodes that share such an n-gram are looked at from here on: a text of each, and
    # one row for each of its sketches.
    touched = sets.join(members.select("node").distinct(), "node", "left_semi")
    wanted = touched.groupBy("node").agg(F.min("text_key").alias("text_key")).select("text_key")
    texts = table_of(_texts_of(keyed, wanted), "jaccard-texts")
    known = table_of(
        texts.mapInArrow(lambda batches: _sketches(batches, words, percent), "node long, size long, text_key long, slot int, folded binary"),
        "jaccard-known",
    )

    # Pairs within the bound: each node with the smallest of its n-gram, and what more it
    # takes to join nodes across these groups, a forest for each n-gram.
    star = members.where("node != low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    near = saved(_within_bound(star, known, percent))
    groups = near.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    pairs = saved(near.union(_across(members, groups, known, percent, 3)))
    links = saved(_verified(pairs, texts, words, percent))
    labels = saved(connected_components(links))
    # A pair that is no link may have hidden one between the same groups: of each group of
    # pairs that is more than one component, all nodes are compared by their sets.
    more = _same_id(sets)
    if not pairs.join(links, ["a", "b"], "left_anti").isEmpty():
        clusters = connected_components(pairs).select(F.col("component").alias("key"), "node")
        more = more.union(_across(clusters, labels, known, percent, 2, texts, words).select("a", "b"))
    more = saved(more)
    if not more.isEmpty():
        # Whole components are joined: the links between them are few.
        joined = connected_components(_renamed(_renamed(more, labels, "a"), labels, "b")).withColumnRenamed("component", "whole")
        all_nodes = labels.unionByName(
            more.select(F.col("a").alias("node")).union(more.select("b")).distinct().join(labels, "node", "left_anti").withColumn("component", F.col("node"))
        )
        labels = all_nodes.join(joined.withColumnRenamed("node", "component"), "component", "left").select(
            "node", F.coalesce("whole", "component").alias("component")
        )
    labelled = sets.join(labels, "node", "left").withColumn(
        "component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node"))
    )
    first = labelled.where("component is not null").groupBy("component").agg(F.min("id").alias("component_id"))
    return labelled.join(first, "component", "left").select(
        "id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"), "text_key"
    )


def _same_id(sets: DataFrame) -> DataFrame:
    """Links between the nodes of rows that share an id: these are one document."""
    rows = sets.where("id is not null and n_shingles > 0")
    shared = rows.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a != last")
    return rows.join(shared, "id").where("node != a").select("a", F.col("node").alias("b"))


def _renamed(links: DataFrame, labels: DataFrame, end: str) -> DataFrame:
    """Links with one end replaced by its component."""
    found = links.withColumnRenamed(end, "node").join(labels, "node", "left")
    return found.withColumn(end, F.coalesce("component", "node")).select("a", "b")


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` that :func:`ngram_jaccard_join` names components by: one of
    each group, that with the smallest id, with all its columns. Of several rows with
    this id one stays. Rows with a null id stay only if no id is in their component,
    once for each text."""
    found = ngram_jaccard_join(docs, id_col, text_col, words, percent)
    named = found.where("id = component_id").groupBy("id").agg(F.min("text_key").alias("text_key"))
    unnamed = found.where("component_id is null").select("id", "text_key").distinct()
    name = fresh(docs, "row_key")
    kept = named.union(unnamed).select(_row_key(F.col("id"), F.col("text_key")).alias(name))
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.withColumn(name, _row_key(F.col(id_col), text_key))
    # Both steps use the same key, so the rows are shuffled once.
    return keyed.join(kept, name, "left_semi").dropDuplicates([name]).drop(name)


def _row_key(row_id: Column, text_key: Column) -> Column:
    return F.concat(text_key.cast("string"), F.coalesce(F.concat(F.lit(":"), row_id.cast("string")), F.lit("")))


# -- bands and sketches --------------------------------------------------------


def bands(limit: int) -> list[int]:
    """First sizes of the bands, up to the one that holds ``limit``."""
    starts, power = [1], 1.0
    while starts[-1] <= limit:
        power *= _BAND_GROWTH
        starts.append(max(starts[-1] + 1, int(np.ceil(power))))
    return starts


def schemes(size: int, percent: int) -> list[Scheme]:
    """The schemes of a set: that of its band, and those of lower bands that hold a
    smaller set it may link with."""
    starts = bands(size)
    found = []
    for band in range(len(starts) - 2, -1, -1):
        upper = (starts[band + 1] - 1) * 100 // percent
        if upper < size:
            break
        found.append(Scheme(band, 2 * upper * (100 - percent) // (100 + percent) + 1))
    return found


def _sketch(found: np.ndarray, parts: int) -> np.ndarray:
    """The parities of the n-grams of each part, 8 bits for a part."""
    dealt = mix(found ^ seeded(1, 41)[0])
    part = ((dealt >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    flips = np.bincount(part * 8 + (dealt & np.uint64(7)).astype(np.int64), minlength=parts * 8) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little")


def _node(found: np.ndarray) -> int:
    """A 64-bit name of a set, from two sums over its hashes."""
    both = np.array([np.bitwise_xor.reduce(found), mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
    name = mix(mix(both[:1]) + both[1:] * np.uint64(3) + np.uint64(len(found)))
    return int(name.view(np.int64)[0])


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for batch in batches:
        names, sizes = [], []
        for _, hashes, first in hasher.texts(batch.column("text")):
            for start, end in zip(first[:-1], first[1:]):
                found = shingles(hashes[start:end], words)
                names.append(_node(found))
                sizes.append(len(found))
        columns = [batch.column("id"), batch.column("text_key"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "text_key", "node", "n_shingles"])


def _sketches(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The sketches of every set that has words, a row for each band (the slot)."""
    hasher = WordHasher()
    for batch in batches:
        text_keys = batch.column("text_key").to_pylist()
        rows: list[tuple] = []
        for row, hashes, first in hasher.texts(batch.column("text")):
            for i in np.flatnonzero(np.diff(first)):
                found = shingles(hashes[first[i] : first[i + 1]], words)
                head = (_node(found), len(found), text_keys[row + i])
                rows += [(*head, plan.band, _sketch(found, plan.parts).tobytes()) for plan in schemes(len(found), percent)]
            if len(rows) >= 2000:
                yield _sketch_batch(rows)
                rows = []
        yield _sketch_batch(rows)


def _sketch_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["node", "size", "text_key", "slot", "folded"])


# -- the rarest n-grams ----------------------------------------------------------


def _rarest(sets: DataFrame, keyed: DataFrame, words: int, percent: int) -> DataFrame:
    """``key`` and ``node`` for the first n-grams of every set, in the order of how often
    they occur in the table, as far as they occur more than once.

    The n-grams of a block of texts are sent to ranges of their hashes, four bytes for
    the place in a range and two for the text. A range counts them; those that occur more
    than once go back to their block with their count, where the first ones of each text
    are taken. Neighbouring hashes may be counted as one, which can only add candidates.
    """
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    partitions = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(max(min(4 * partitions, 1 << 12), -(-total // _RANGE_GRAMS)), 1 << 16)
    schema = "block long, place int, grams binary, texts binary, counts binary"
    sent = _once(sets, keyed.select("text_key", "text")).select("text").mapInArrow(lambda batches: _blocks(batches, words, ranges), schema)
    counted = sent.repartition("place").sortWithinPartitions("place").mapInArrow(_counted, schema)
    back = counted.repartition("block").sortWithinPartitions("block")
    return back.mapInArrow(lambda batches: _first(batches, percent), "key long, node long")


def _once(sets: DataFrame, keyed: DataFrame) -> DataFrame:
    """Every text once. Only texts that have copies are shuffled."""
    copied = saved(sets.groupBy("text_key").count().where("count > 1").select("text_key"))
    copies = copied.count()
    if not copies:
        return keyed
    if copies <= _BROADCAST_KEYS:
        copied = F.broadcast(copied)
    one = saved(keyed.join(copied, "text_key", "left_semi").dropDuplicates(["text_key"]))
    return keyed.join(copied, "text_key", "left_anti").unionByName(one)


def _blocks(batches: Iterator[pa.RecordBatch], words: int, ranges: int) -> Iterator[pa.RecordBatch]:
    """For each block of texts, a row for each range that has n-grams of it, and one
    (with a negative place) that lists its sets, their sizes and the number of rows.
    Blocks are named by their sets, so a task that runs again names them the same."""
    hasher = WordHasher()
    task = TaskContext.get().partitionId()
    held, size, number = [], 0, 0
    for batch in batches:
        for _, hashes, first in hasher.texts(batch.column("text")):
            for i in np.flatnonzero(np.diff(first)):
                held.append(shingles(hashes[first[i] : first[i + 1]], words))
                size += len(held[-1])
                if size >= _BLOCK_GRAMS or len(held) == 1 << 16:
                    yield _block(held, ranges, task, number)
                    held, size, number = [], 0, number + 1
    if held:
        yield _block(held, ranges, task, number)


def _block(held: list[np.ndarray], ranges: int, task: int, number: int) -> pa.RecordBatch:
    nodes = np.array([_node(found) for found in held], np.int64)
    sizes = np.array([len(found) for found in held], np.int64)
    # The upper 48 bits of a hash tell its range and its place there.
    spread = (np.concatenate(held) >> np.uint64(16)) * np.uint64(ranges)
    order = np.argsort(spread)
    spread, texts = spread[order], np.repeat(np.arange(len(held), dtype=np.uint16), sizes)[order]
    place = (spread >> np.uint64(48)).astype(np.int32)
    grams = (spread >> np.uint64(16)).astype(np.uint32)
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    ends = [*starts[1:], len(place)]
    seed = np.array([task, number], np.uint64)
    block = int(mix(mix(mix(nodes.view(np.uint64)) + np.arange(len(nodes), dtype=np.uint64)).sum(keepdims=True) + mix(mix(seed[:1]) + seed[1:])).view(np.int64)[0])
    rows = [(block, int(place[s]), grams[s:e].tobytes(), texts[s:e].tobytes(), None) for s, e in zip(starts, ends)]
    # Spread over tasks as well; any place below zero will do.
    listed = -1 - (block & 0xFFFFF)
    return _place_batch([*rows, (block, listed, nodes.tobytes(), sizes.tobytes(), np.int64(len(rows)).tobytes())])


def _place_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["block", "place", "grams", "texts", "counts"])


def _runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[list[tuple]]:
    """Rows that follow each other with the same value of ``by``."""
    held: list[tuple] = []
    for batch in batches:
        at = batch.schema.get_field_index(by)
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and row[at] != held[0][at]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the n-grams of each range those that occur more than once, with a rank by how
    often: four steps for each doubling. A row for each one received, so that the block
    can tell that all came back."""
    for rows in _runs(batches, "place"):
        if rows[0][1] < 0:
            yield _place_batch(rows)
            continue
        grams = [np.frombuffer(row[2], np.uint32) for row in rows]
        every = np.concatenate(grams)
        _, which, often = np.unique(every, return_inverse=True, return_counts=True)
        rank = np.ceil(4 * np.log2(often)).clip(0, 255).astype(np.uint8)[which]
        found, start = [], 0
        for (block, place, _, texts, _), own in zip(rows, grams):
            ranks = rank[start : start + len(own)]
            start += len(own)
            again = ranks > 0
            found.append((block, place, own[again].tobytes(), np.frombuffer(texts, np.uint16)[again].tobytes(), ranks[again].tobytes()))
        yield _place_batch(found)


def _first(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The first n-grams of the sets of each block. Those that did not come back occur
    once and are the first in any order, but no other set has them."""
    for rows in _runs(batches, "block"):
        listed = [row for row in rows if row[1] < 0]
        if len(listed) != 1 or np.frombuffer(listed[0][4], np.int64)[0] != len(rows) - 1:
            raise RuntimeError("n-grams of a block were lost: its input changed while it was counted")
        nodes, sizes = (np.frombuffer(column, np.int64) for column in listed[0][2:4])
        rows = [row for row in rows if row[1] >= 0 and row[2]]
        if not rows:
            continue
        grams, texts, ranks = (
            np.concatenate([np.frombuffer(row[i], kind) for row in rows]) for i, kind in ((2, np.uint32), (3, np.uint16), (4, np.uint8))
        )
        place = np.repeat(np.array([row[1] for row in rows], np.uint64), [len(row[4]) for row in rows])
        key = (place << np.uint64(32)) | grams
        order = np.lexsort((key, ranks, texts))
        key, texts = key[order], texts[order]
        back = np.bincount(texts, minlength=len(nodes))
        # size - ceil(t * size) + 1 in all.
        taken = sizes * (100 - percent) // 100 + 1 - (sizes - back)
        rank = np.arange(len(texts)) - np.repeat(np.cumsum(back) - back, back)
        kept = rank < taken[texts]
        yield pa.RecordBatch.from_arrays([pa.array(mix(key[kept]).view(np.int64)), pa.array(nodes[texts[kept]])], ["key", "node"])


# -- comparing -----------------------------------------------------------------


def _within_bound(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches of a common slot differ by no more bits than those of
    linked sets may."""

    def side(name: str) -> DataFrame:
        columns = ("size", "folded", "text_key")
        return known.select(F.col("node").alias(name), "slot", *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for a, b, key_a, key_b, size_a, size_b, left, right in zip(*(column.to_pylist() for column in batch.columns)):
                differ = np.bitwise_count(np.frombuffer(left, np.uint8) ^ np.frombuffer(right, np.uint8)).sum()
                if int(differ) * (100 + percent) <= (size_a + size_b) * (100 - percent):
                    kept.append((a, b, key_a, key_b))
            yield _pair_batch(kept)

    sketched = pairs.join(side("a"), "a").join(side("b"), ["b", "slot"])
    columns = ["a", "b", "text_key_a", "text_key_b", "size_a", "size_b", "folded_a", "folded_b"]
    return sketched.select(*columns).mapInArrow(near, _PAIRS).distinct()


def _pair_batch(pairs: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[i] for p in pairs], pa.int64()) for i in range(4)], ["a", "b", "key_a", "key_b"]
    )


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with a node, and its component: itself if it has no link."""
    found = nodes.join(labels, "node", "left")
    return found.select(*nodes.columns, F.coalesce("component", "node").alias("component"))


def _across(
    members: DataFrame, labels: DataFrame, known: DataFrame, percent: int, least: int, texts: DataFrame | None = None, words: int = 0
) -> DataFrame:
    """A spanning forest, for each key, of the pairs of nodes that share the key, lie in
    different components and are within the bound or, with ``texts``, link by the exact
    size of their intersection. Keys of ``least`` nodes and more are looked at. A task
    compares two blocks of the nodes of a key. Those of its largest component are in
    blocks of their own, which are not compared with each other."""
    labelled = _labelled(members, labels)
    weight = F.lit(1.0)
    if texts is not None:
        # Whole sets are held: blocks of long ones have fewer.
        labelled = labelled.join(known.groupBy("node").agg(F.max("size").alias("held")), "node")
        weight = F.greatest(weight, F.col("held") * _BLOCK / F.lit(_BLOCK_GRAMS))
    counts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("weight"))
    blocks = lambda n: F.ceil(n / _BLOCK).cast("int")
    crowded = (
        counts.groupBy("key")
        .agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.max(F.struct("weight", "component")).alias("most"), F.count(F.lit(1)).alias("components"))
        .where(f"n >= {least} and components > 1")
        .select("key", F.col("most.component").alias("largest"), blocks(F.col("most.weight")).alias("inner"), blocks(F.col("weight") - F.col("most.weight")).alias("outer"))
    )
    # Blocks of the largest component have numbers below zero.
    own = F.expr("cast(if(component = largest, -1 - pmod(xxhash64(node), inner), pmod(xxhash64(node), outer)) as int)")
    other = F.expr("explode(if(component = largest, sequence(0, outer - 1), sequence(-inner, outer - 1)))")
    placed = labelled.join(crowded, "key").withColumn("own", own).withColumn("other", other)
    tasks = placed.select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("pair"),
        (F.col("own") <= F.col("other")).alias("left"),
        (F.col("own") >= F.col("other")).alias("right"),
        "node",
        "component",
    )
    tasks = tasks.join(known, "node").select(
        F.xxhash64("pair", "slot").alias("task"), "left", "right", "node", "text_key", "component", "size", "folded"
    )

    if texts is not None:
        tasks = tasks.join(texts, "text_key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "task"):
            yield _pair_batch(_compare_blocks(rows, percent, words))

    order = ["task", "left", "right", "node", "text_key", "component", "size", "folded", *(["text"] if texts is not None else [])]
    return tasks.select(*order).repartition("task").sortWithinPartitions("task").mapInArrow(compare, _PAIRS).distinct()


def _compare_blocks(rows: list[tuple], percent: int, words: int) -> list[tuple[int, int, int, int]]:
    _, left, right, node, text_key, component, size, folded, *text = (list(c) for c in zip(*rows))
    sets = _sets_of(pa.array(text[0], pa.large_string()), words) if text else []
    bits = np.array([np.frombuffer(f, np.uint8) for f in folded])
    names, component = np.unique(component, return_inverse=True)
    size, others = np.array(size), np.flatnonzero(right)
    root = np.arange(len(names))
    pairs = []
    for i in np.flatnonzero(left):
        wanted = others[root[component[others]] != root[component[i]]]
        if not len(wanted):
            continue
        differ = np.bitwise_count(bits[wanted] ^ bits[i]).sum(axis=1, dtype=np.int64)
        near = differ * (100 + percent) <= (size[wanted] + size[i]) * (100 - percent)
        # The most alike first: they link most likely, and then no other has to be compared.
        for j in wanted[near][np.argsort(differ[near], kind="stable")]:
            a, b = root[component[i]], root[component[j]]
            if a == b or (text and not _linked(sets[i], sets[j], percent)):
                continue
            root[root == b] = a
            first, second = (i, j) if node[i] < node[j] else (j, i)
            pairs.append((node[first], node[second], text_key[first], text_key[second]))
    return pairs


def _sets_of(column: pa.Array, words: int) -> list[np.ndarray]:
    found = []
    for _, hashes, first in WordHasher().texts(column):
        found += [shingles(hashes[s:e], words) for s, e in zip(first[:-1], first[1:])]
    return found


def _linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    both = np.count_nonzero(right[np.searchsorted(right, left).clip(max=len(right) - 1)] == left)
    return 100 * both >= percent * (len(left) + len(right) - both)


def _texts_of(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text_key`` and ``text`` of the wanted keys."""
    wanted = saved(wanted)
    if wanted.count() <= _BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    return keyed.select("text_key", "text").join(wanted, "text_key", "left_semi").dropDuplicates(["text_key"])


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link by the exact size of their intersection."""
    both = pairs.join(texts.select(F.col("text_key").alias("key_a"), F.col("text").alias("text_a")), "key_a").join(
        texts.select(F.col("text_key").alias("key_b"), F.col("text").alias("text_b")), "key_b"
    )

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (_sets_of(batch.column(name), words) for name in ("text_a", "text_b"))
            ends = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), *sides)
            kept = [(a, b) for a, b, left, right in ends if _linked(left, right, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(exact, "a long, b long")
