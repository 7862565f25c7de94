"""MinHash near-duplicates by a multi-index Hamming join.

A text's signature is 40 MinHash values of 16 bits, cut into 8 chunks of 5. Two signatures that differ in
at most 15 values have a chunk with at most one error (pigeonhole), so every chunk is indexed under all its
forms with one value left out: pairs under that distance always share a bucket. At the
similarity limit of 0.8 a pair shares none with a chance of 2 in 100,000.

1. One pass makes sets of shingle hashes, signatures and digests. Equal sets form one class.
2. Buckets: a task links what it holds of a large bucket itself and sends one row, so no bucket is gathered whole. Small
   buckets compare 128 one-bit values of each pair, which drops chance meetings. What remains links classes to candidate groups.
3. A group is cut into blocks. The full sets of a block, and that of the group's first text with every block, are
   intersected at once, by matrix product. Near copies are connected by this alone, each text being sent once. Only the texts that do
   not belong to their group's largest part are then held against all blocks of their group. Parts are
   returned as stars about their smallest id, never as pairs, so that the same part found twice is the same links.
4. Components of the links, over classes, then over documents by their class.

Links are confirmed on the sets of 64-bit shingle hashes of whole texts.

Defined results: texts without words, NULL or empty, have no shingles and link with nothing; equal texts are one
component; rows without a doc_id are linked with nothing, their component is NULL and they are kept; repeated rows of a
doc_id give repeated results; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.arrow import text_bytes
from feedlens.llm.components import components
from feedlens.llm.hot_keys import join_split_hot
from feedlens.llm.id_filter import id_filter, possible_members
from feedlens.llm.shipping import ship_package
from feedlens.session import written_table

WIDTH, PERCENT = 5, 80
CHUNKS, CHUNK = 8, 5
CHECK_BITS = 128
#: One-bit values in which a pair at the limit may differ: its mean of 12.8 and near seven deviations. Chance meetings lie at 64.
CHECK_DISTANCE = 36
#: A bucket of more members is not compared: they are one candidate group.
COMPARED = 256
BLOCK = 256
#: Shingles in one matrix product.
COLUMNS = 1 << 14

_random = np.random.default_rng(20240229)
_HASHES = CHUNKS * CHUNK + CHECK_BITS
_FLIP = _random.integers(0, 2**64, _HASHES, np.uint64)
_TURN = _random.integers(0, 2**64, _HASHES, np.uint64) | np.uint64(1)
_PLACE = _random.integers(0, 2**64, 64, np.uint64) | np.uint64(1)
_LAST = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hashes of words, each computed once in a task's batch."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _LAST
    return values ^ (values >> np.uint64(29))


def shingle_set(text: bytes, width: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the text's ``width``-word shingles; fewer words are one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    total = np.full(len(words) - span + 1, np.uint64(span if span < width else 0), np.uint64)
    for place in range(span):
        total = total * _PLACE[0] + values[place:len(words) - span + 1 + place] * _PLACE[place % 64]
    return np.unique(_mixed(total))


def _lowest(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of all hash functions."""
    if len(shingles) <= 256:
        return ((shingles[None, :] ^ _FLIP[:, None]) * _TURN[:, None]).min(axis=1)
    return np.array([((shingles ^ flip) * turn).min() for flip, turn in zip(_FLIP, _TURN, strict=True)], np.uint64)


def _signature(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """The 16-bit values, and the one-bit values packed."""
    low = _mixed(_lowest(shingles))
    return (low[:CHUNKS * CHUNK] >> np.uint64(48)).astype("<u2").tobytes(), np.packbits((low[CHUNKS * CHUNK:] >> np.uint64(63)).astype(bool)).tobytes()


def _sketch(width: int):
    """``doc_id, n_shingles, digest, signature, check`` of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = _WordHashes()
            size, digest, signature, check = [], [], [], []
            for text in text_bytes(batch):
                shingles = shingle_set(text, width, hashes)
                size.append(len(shingles))
                digest.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                own = _signature(shingles) if len(shingles) else (b"", b"")
                signature.append(own[0])
                check.append(own[1])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array(size, pa.int64()),
                "digest": pa.array(digest, pa.binary()), "signature": pa.array(signature, pa.binary()), "check": pa.array(check, pa.binary()),
            })

    return run


def _bucket_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of every chunk with each of its values left out, one row per signature."""
    parts = []
    for chunk in range(CHUNKS):
        own = signatures[:, chunk * CHUNK:(chunk + 1) * CHUNK].astype(np.uint64)
        for left_out in range(CHUNK):
            key = np.full(len(own), np.uint64(chunk * CHUNK + left_out + 1), np.uint64) * _PLACE[1]
            for place in range(CHUNK):
                if place != left_out:
                    key = _mixed((key ^ own[:, place]) * _PLACE[2])
            parts.append(key)
    return np.stack(parts, axis=1).view(np.int64)


_BUCKET_ROW = "key long, id long, n long, check binary, other long"


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per key and class; of a large bucket, its smallest id (without check) and links to that (``other``)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(batch.num_rows, -1)
        order = np.argsort(batch.column("id").to_numpy(zero_copy_only=False), kind="stable")
        signatures, batch = signatures[order], batch.take(pa.array(order))
        ids, sizes = batch.column("id").to_numpy(zero_copy_only=False), batch.column("n").to_numpy(zero_copy_only=False)
        checks = batch.column("check").to_pylist()
        # By ascending id, so that the first row of a key is its smallest id.
        keys = _bucket_keys(signatures)
        member = np.repeat(np.arange(batch.num_rows), keys.shape[1])
        keys = keys.ravel()
        _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        large = counts[inverse] > COMPARED
        head = np.zeros(len(keys), bool)
        head[first] = True
        linked = large & ~head
        rows = np.flatnonzero(~linked)
        for start in range(0, len(rows), 20_000):
            part = rows[start:start + 20_000]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(keys[part]), "id": pa.array(ids[member[part]], pa.int64()), "n": pa.array(sizes[member[part]], pa.int64()),
                "check": pa.array([None if large[at] else checks[member[at]] for at in part], pa.binary()),
                "other": pa.nulls(len(part), pa.int64()),
            })
        pairs = np.unique(np.stack([ids[member[linked]], ids[member[first[inverse[linked]]]]]), axis=1)
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(pairs[0], pa.int64()), "id": pa.array(pairs[0], pa.int64()), "n": pa.nulls(pairs.shape[1], pa.int64()),
            "check": pa.nulls(pairs.shape[1], pa.binary()), "other": pa.array(pairs[1], pa.int64()),
        })


def _link_small(ids: np.ndarray, sizes: np.ndarray, checks: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Stars of the members of a bucket whose sizes and one-bit values allow the limit."""
    bits = np.frombuffer(b"".join(checks), np.uint64).reshape(len(ids), -1)
    apart = np.bitwise_count(bits[:, None, :] ^ bits[None, :, :]).sum(axis=2)
    small, large = np.minimum(sizes[:, None], sizes[None, :]), np.maximum(sizes[:, None], sizes[None, :])
    return _stars(ids, ids, (apart <= CHECK_DISTANCE) & (100 * small >= percent * large))


def _stars(left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """The parts that the matrix ``linked`` connects, as links from each part's smallest id to its others."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while parent.setdefault(node, node) != node:
            parent[node] = node = parent[parent[node]]
        return node

    for one, two in zip(*np.nonzero(linked), strict=True):
        first, second = root(int(left[one])), root(int(right[two]))
        # The smallest id of a part is its root.
        parent[max(first, second)] = min(first, second)
    return [(root(node), node) for node in list(parent) if root(node) != node]


def _bucket_links(percent: int):
    """Links from rows sorted by key and id; a bucket is held only up to ``COMPARED`` members, a larger one is a star about its first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, head = None, [], None

        def close() -> list[tuple[int, int]]:
            if len(members) < 2 or head is not None:
                return []
            ids, sizes, checks = zip(*members, strict=True)
            return _link_small(np.array(ids), np.array(sizes), list(checks), percent)

        for batch in batches:
            links = []
            keys = batch.column("key").to_numpy()
            columns = [batch.column(name).to_pylist() for name in ("id", "n", "check", "other")]
            # Keys on their own, which most are, need no look.
            alone = np.ones(len(keys), bool)
            alone[1:] &= keys[1:] != keys[:-1]
            alone[:-1] &= keys[:-1] != keys[1:]
            if len(keys):
                alone[0] = alone[-1] = False
            others = np.array([other is not None for other in columns[3]], bool)
            for at in np.flatnonzero(~alone | others):
                number, size, check, other = (column[at] for column in columns)
                if other is not None:
                    links.append((number, other))
                    continue
                if keys[at] != key:
                    links += close()
                    key, members, head = keys[at], [], None
                if head is not None:
                    links.append((head, number))
                    continue
                members.append((number, size, check))
                if check is None or len(members) > COMPARED:
                    head = members[0][0]
                    links += [(head, own) for own, _, _ in members[1:]]
                    members = []
            yield _pairs(links)
        yield _pairs(close())

    return run


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    unique = sorted({(min(link), max(link)) for link in links})
    return pa.RecordBatch.from_pydict({
        "a": pa.array([link[0] for link in unique], pa.int64()), "b": pa.array([link[1] for link in unique], pa.int64()),
    })


def candidate_links(classes: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that connect all classes whose signatures meet, from ``id, n, signature, check``."""
    rows = classes.select("id", "n", "signature", "check").mapInArrow(_bucket_rows, _BUCKET_ROW)
    dealt = rows.repartition("key").sortWithinPartitions("key", "id")
    return dealt.mapInArrow(_bucket_links(percent), "a long, b long").distinct()


def _blocked(groups: DataFrame, block: int) -> DataFrame:
    """``id, label, blocks, own`` of every group's members: the group's number of blocks, and the member's own."""
    counts = groups.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    counted = join_split_hot(groups, written_table(counts, "near-counts"), "label", "members")
    blocks = F.ceil(F.col("members") / block).cast("int")
    return counted.select("id", "label", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own"))


def _own_blocks(blocked: DataFrame) -> DataFrame:
    """``id, unit, place``: every member in its own block, a group's first member, whose id is the label, in all blocks."""
    first = F.col("id") == F.col("label")
    block = F.explode(F.when(first, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))).alias("block")
    return blocked.select("id", "label", block).select("id", F.xxhash64("label", "block").alias("unit"), F.lit(2).alias("place"))


def _rest_blocks(blocked: DataFrame, found: DataFrame, block: int) -> DataFrame | None:
    """``id, unit, place`` of groups of several blocks with members outside their largest part: these against all blocks."""
    several = blocked.where("blocks > 1").join(found.withColumnRenamed("label", "part"), "id", "left")
    several = written_table(several.withColumn("part", F.coalesce("part", "id")), "near-parts")
    sizes = several.groupBy("label", "part").agg(F.count(F.lit(1)).alias("size"))
    # max_by combines in the map tasks: of a group's parts, however many, one row per task is sent.
    main = sizes.groupBy("label").agg(
        F.max(F.struct("size", "part"))["part"].alias("main"), F.sum("size").alias("members"), (F.sum("size") - F.max("size")).alias("others")
    )
    main = written_table(main.where("others > 0").withColumn("rests", F.ceil(F.col("others") / block).cast("int")), "near-main")
    if main.isEmpty():
        return None
    members = written_table(join_split_hot(several, main, "label", "members"), "near-rest")
    rests = F.sequence(F.lit(0), F.col("rests") - 1)
    right = members.select("id", "label", F.explode(rests).alias("rest"), F.col("own").alias("block"), F.lit(1).alias("place"))
    own_rest = F.pmod(F.xxhash64(F.lit(1), "id"), "rests").cast("int")
    left = members.where("part <> main").select(
        "id", "label", own_rest.alias("rest"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("place")
    )
    return left.unionByName(right).select("id", F.xxhash64("label", "rest", "block").alias("unit"), "place")


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``left`` sets with ``right`` sets."""
    owner = np.repeat(np.arange(len(sets)), [len(own) for own in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    result = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(shared.sum()), COLUMNS):
        edge = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, int(shared.sum()) - start)), np.float32)
        part[owner[edge[0]:edge[1]], column[edge[0]:edge[1]] - start] = 1
        result += part[left] @ part[right].T
    return result.astype(np.int64)


def _verify(members: list[tuple[int, int, bytes]], width: int, percent: int) -> list[tuple[int, int]]:
    """Stars of the texts that confirmed links connect: those on the left (place 0 or 2) with those on the right (1 or 2)."""
    hashes = _WordHashes()
    sets = [shingle_set(text, width, hashes) for _, _, text in members]
    ids, place = np.array([member[0] for member in members]), np.array([member[1] for member in members])
    left, right = np.flatnonzero(place != 1), np.flatnonzero(place != 0)
    if not len(left) or not len(right):
        return []
    both = _intersections(sets, left, right)
    size = np.array([len(own) for own in sets])
    union = size[left][:, None] + size[right][None, :] - both
    return _stars(ids[left], ids[right], (both > 0) & (100 * both >= percent * union))


def _verify_units(width: int, percent: int):
    """Confirmed links from texts sorted by unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, members = None, []
        for batch in batches:
            links = []
            for key, number, place, text in zip(*[batch.column(name).to_pylist() for name in ("unit", "id", "place")], text_bytes(batch), strict=True):
                if key != unit:
                    links += _verify(members, width, percent) if len(members) > 1 else []
                    unit, members = key, []
                members.append((number, place, text))
            yield _pairs(links)
        yield _pairs(_verify(members, width, percent) if len(members) > 1 else [])

    return run


def _confirmed(documents: DataFrame, units: DataFrame, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` among the texts of each unit of ``units`` (``id, unit, place``)."""
    units = written_table(units, "near-units")
    # Only the texts of groups are shuffled: a bounded filter of their ids drops most others first.
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text").where("doc_id is not null")
    texts = possible_members(texts, "id", id_filter(units, "id")).join(units.hint("merge"), "id")
    texts = texts.repartition("unit").sortWithinPartitions("unit")
    return texts.mapInArrow(_verify_units(width, percent), "a long, b long").distinct()


def confirmed_parts(documents: DataFrame, groups: DataFrame, width: int, percent: int, block: int) -> DataFrame:
    """``id, label`` of the texts of candidate groups (``id, label``) that confirmed links connect."""
    blocked = written_table(_blocked(groups, block), "near-blocked")
    links = written_table(_confirmed(documents, _own_blocks(blocked), width, percent), "near-links")
    found = written_table(components(links), "near-found")
    rest = _rest_blocks(blocked, found, block)
    if rest is None:
        return found
    return components(links.unionByName(_confirmed(documents, rest, width, percent)))


def _sketched(documents: DataFrame, width: int) -> DataFrame:
    ship_package(documents.sparkSession)
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {doc_type}, n_shingles long, digest binary, signature binary, check binary"
    return written_table(documents.select("doc_id", "text").mapInArrow(_sketch(width), columns), "near-sketches")


def _worded(sketches: DataFrame) -> DataFrame:
    return sketches.where("n_shingles > 0 and doc_id is not null")


def _classes(sketches: DataFrame) -> DataFrame:
    """``digest, copies, id, n, signature, check`` of every distinct set, ``id`` being its smallest doc_id."""
    first = F.min(F.struct(F.col("doc_id").cast("long").alias("id"), F.col("n_shingles").alias("n"), "signature", "check")).alias("first")
    return written_table(
        _worded(sketches).groupBy("digest").agg(first, F.count(F.lit(1)).alias("copies")).select("digest", "copies", "first.*"), "near-classes"
    )


def sketched_classes(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    return _classes(_sketched(documents, width))


def near_duplicates(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, class_digest, component_id, kept`` of every document."""
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    sketches = _sketched(documents, width)
    worded = _worded(sketches)
    classes = _classes(sketches)
    groups = written_table(components(candidate_links(classes, percent)), "near-groups")
    found = confirmed_parts(documents, groups, width, percent, block)
    of_class = written_table(
        classes.join(found, "id", "left").select("digest", "copies", F.coalesce("label", "id").alias("component")), "near-components"
    )
    component = F.col("component").cast(doc_type)
    linked = join_split_hot(worded.select("doc_id", "n_shingles", "digest"), of_class, "digest", "copies").select(
        "doc_id", "n_shingles", "digest", component.alias("component_id")
    )
    alone = sketches.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", "digest", F.col("doc_id").alias("component_id")
    )
    return linked.unionAll(alone).select(
        "doc_id", "n_shingles", F.col("digest").alias("class_digest"), "component_id", _kept().alias("kept")
    )


def _kept() -> Column:
    return F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))


def deduplicated(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, in the columns of ``documents``.

    Repeated rows of a kept doc_id are reduced to one of them.
    """
    judged = written_table(near_duplicates(documents, width, percent).select("doc_id", "kept"), "near-judged")
    drop = judged.where("not kept").select("doc_id").distinct()
    # Always by shuffle: the list of dropped ids grows with the documents.
    kept = documents.join(drop.hint("merge"), "doc_id", "left_anti").select(*[F.col(f"`{name}`") for name in documents.columns])
    counts = judged.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    repeated = written_table(counts.where("rows > 1").select("doc_id"), "near-repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once).select(*kept.columns)


def near_report(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents, width=2).select("doc_id", "n_shingles", "component_id", "kept")
