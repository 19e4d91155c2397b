"""Near-duplicate groups (operator 1): DartMinHash signatures, banded joining, exact verification.

Each shingle, weighted by how often it stands in the text, owns a region of a plane of weight by rank. Hashed
darts fall on that plane, the same for every text; those inside a text's region are kept up to a rank at which about
``k ln k + 2k`` of them are in, and each of ``k`` coordinates takes its dart of lowest rank. Two texts agree in
a coordinate with the probability of their weighted Jaccard similarity.

Texts that agree in all coordinates of a band share a bucket. A bucket sends no pairs of all with all: its
members are held against one of them, the one that shares most buckets. Sketches rule out most pairs, the
rest are verified on the texts, and links make components. Buckets that then hold several components go on: small
ones are compared across components, the members of large ones are joined on the rarest of their shingles, one
of which any two that are similar share. Of both, only pairs are made whose parities allow them to be similar: a
parity says of each of 512 slots whether an odd number of shingles falls into it, so the slots in which two differ are at most as many as
the shingles that one text has and the other has not.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import count_up, encoded_slices, first_rows, id_order, mix, row_number, schema_with, scramble, slices, stored
from keyfold.llm.components import components
from keyfold.llm.fingerprints import shingle_hashes
from keyfold.llm.meeting import NAME, identified, packed, text_name, unpacked

COORDINATES = 96
BAND_ROWS = 4
SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Sketches that agree in a smaller share are not verified: of pairs at SIMILARITY, 1.4e-4.
SKETCH_SIMILARITY = 0.64
# Buckets of up to so many members are compared across all their components.
SMALL_BUCKET = 64
# Shingles are counted by their hash modulo this; the counts order them, and any order gives the same pairs.
SLOTS = 1 << 20
# Slots whose counts travel together.
BLOCK = 1 << 10
# A shingle that more texts are found by is joined in pieces of about so many.
CROWD = 1024

# A signature takes room for its darts, however short the text; a row counts as so many bytes of text more.
ROW_BYTES = 2048
# Slots of a parity, in 64-bit numbers.
PARITY = [f"parity{i}" for i in range(8)]

_STEP = 0x9E3779B97F4A7C15
#: A tile holds at least 1, 2, ... darts if its hash lies above these: the Poisson distribution of mean 1.
_POISSON = [
    np.uint64(min(2**64 - 1, int(2.0**64 * sum(math.exp(-1) / math.factorial(i) for i in range(n))))) for n in range(1, 18)
]
_NONE = np.uint64(2**64 - 1)


def _step(n: int) -> np.uint64:
    return np.uint64(n * _STEP % 2**64)


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, k: int = COORDINATES) -> np.ndarray:
    """DartMinHash of ``rows`` weighted sets, ``rows`` by ``k`` hashes of 32 bits; 0 throughout for an empty set.

    ``row`` ascends; ``weight`` is positive. The work is the number of elements plus ``k ln k`` a set.
    """
    total = np.bincount(row, weights=weight, minlength=rows)
    darts = k * math.log(k) + 2 * k
    limit = np.divide(darts, total, out=np.zeros(rows), where=total > 0)
    out = np.zeros((rows, k), np.uint32)
    todo = total > 0
    while todo.any():
        some = todo[row]
        best = np.full(rows * k, _NONE)
        for place, order in _throw(row[some], element[some], weight[some], limit, k):
            np.minimum.at(best, place, order)
        best = best.reshape(rows, k)
        full = todo & (best != _NONE).all(axis=1)
        out[full] = best[full].astype(np.uint32)  # the lower half is the dart's own hash
        todo &= ~full
        limit = limit * 2  # some coordinate got no dart yet: look at ranks twice as high
    return out


def _throw(row, element, weight, limit, k) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The darts inside the sets' regions: coordinate of the set, and rank before dart hash as one number.

    The plane is cut into bands of weight [0, 1), [1, 2), [2, 4), ... and these into tiles of area 1, so
    each tile has one dart on average.
    """
    low, height = 0.0, 1.0
    level = 0
    while True:
        inside = weight > low
        if not inside.any():
            return
        r, e, w = row[inside], element[inside], weight[inside]
        tiles = np.ceil(limit[r] * height).astype(np.int64)
        which = np.repeat(np.arange(len(r)), tiles)
        tile = np.arange(len(which)) - np.repeat(np.cumsum(tiles) - tiles, tiles)
        seed = scramble(mix(e + _step(level), e)[which] + tile.astype(np.uint64) * np.uint64(_STEP))
        for number, least in enumerate(_POISSON, 1):
            there = seed >= least
            if not there.any():
                break
            seed, which, tile = seed[there], which[there], tile[there]
            dart = scramble(seed + _step(number))
            across = low + height * ((dart >> np.uint64(32)).astype(np.float64) / 2.0**32)
            rank = (tile + (dart & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32) / height
            hit = (across < w[which]) & (rank < limit[r[which]])
            name = scramble(dart[hit])
            order = rank[hit].astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | name >> np.uint64(32)
            yield r[which[hit]] * k + (name % np.uint64(k)).astype(np.int64), order
        low, height = (1.0, 1.0) if level == 0 else (low * 2, height * 2)
        level += 1


def weighted_shingles(texts: list[bytes], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, shingle, count`` of some texts, in order."""
    found = shingle_hashes(texts, words)
    row = np.repeat(np.arange(len(texts)), [len(h) for h in found])
    shingle = np.concatenate(found) if found else np.zeros(0, np.uint64)
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    first = np.flatnonzero(new)
    return row[first], shingle[first], np.diff(np.append(first, len(row)))


def parities(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
    """The parities of some multisets of shingles, ``rows`` by 8 numbers; a shingle counts anew each time it stands."""
    each = mix(np.repeat(shingle, count), count_up(count).astype(np.uint64))
    slots = 64 * len(PARITY)
    place = np.repeat(row, count) * slots + (scramble(each) % np.uint64(slots)).astype(np.int64)
    place, often = np.unique(place, return_counts=True)
    odd = place[often & 1 == 1]
    # no place stands twice, so the bits of a byte add up
    filled = np.bincount(odd >> 3, weights=1 << (odd & 7), minlength=rows * slots // 8).astype(np.uint8)
    return filled.view("<i8").reshape(rows, len(PARITY))


def _may_be_similar(n: str, other_n: str, other: list[str]) -> F.Column:
    """Whether the parities of two texts of ``n`` and ``other_n`` shingles leave room for ``SIMILARITY``: of two similar texts at most
    (1 - 0.8) / (1 + 0.8) of all shingles stand in one alone."""
    differ = sum((F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(PARITY, other)), F.lit(0))
    return differ <= F.floor((1 - SIMILARITY) / (1 + SIMILARITY) * (F.col(n) + F.col(other_n)) + 1e-6)


def signed(docs: DataFrame) -> DataFrame:
    """``row, doc, part, more, doc_id, digest, sketch, bands``, the number ``n`` of shingles and their parity, of every document, stored: the first pass over
    the texts. Texts are compared in lower case by their words."""
    rows = identified(docs, row_number()).withColumn("text", F.lower("text"))
    more = ", ".join(f"{name} bigint" for name in PARITY)
    schema = schema_with(rows, ["row", *NAME, "doc_id"], f"digest binary, sketch binary, bands array<bigint>, n bigint, {more}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, some in encoded_slices(batch.column("text"), row_bytes=ROW_BYTES):
                row, shingle, count = weighted_shingles(some)
                found = signatures(row, shingle, count.astype(float), len(some))
                key = np.zeros((len(some), COORDINATES // BAND_ROWS), np.uint64)
                for at in range(BAND_ROWS):
                    key = mix(key, found[:, at::BAND_ROWS].astype(np.uint64))
                key = mix(key, np.arange(key.shape[1], dtype=np.uint64)[None, :]).view(np.int64)
                # texts without words are copies of each other and nothing else
                bands = [list(b) if a.any() else [] for a, b in zip(found, key.tolist())]
                digests = [hashlib.blake2b(b" ".join(t.split()), digest_size=16).digest() for t in some]
                sketches = [s.tobytes() for s in found.astype("<u2")]
                parity = parities(row, shingle, count, len(some))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(start, len(some)) for c in ("row", *NAME, "doc_id")),
                        pa.array(digests, pa.binary()),
                        pa.array(sketches, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(np.bincount(row, weights=count, minlength=len(some)).astype(np.int64)),
                        *(pa.array(np.ascontiguousarray(parity[:, i])) for i in range(len(PARITY))),
                    ],
                    names=schema.names,
                )

    return stored(rows.mapInArrow(run, schema), "signed")


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, likeness`` of the pairs whose sketches agree well enough."""
    sketches = nodes.select("row", "sketch")
    both = pairs.join(sketches.select(F.col("row").alias("a"), F.col("sketch").alias("first")), "a").join(
        sketches.select(F.col("row").alias("b"), F.col("sketch").alias("second")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, COORDINATES)
                for c in ("first", "second")
            ]
            likeness = (sides[0] == sides[1]).mean(axis=1)
            kept = np.flatnonzero(likeness >= SKETCH_SIMILARITY)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(kept)), batch.column("b").take(pa.array(kept)), pa.array(likeness[kept])],
                names=["a", "b", "likeness"],
            )

    return both.select("a", "b", "first", "second").mapInArrow(run, "a bigint, b bigint, likeness double")


def similarity(first: bytes, second: bytes, words: int = SHINGLE_WORDS) -> float:
    """Weighted Jaccard similarity of two texts' shingles."""
    return float(_similarities([first], [second], words)[0])


def _similarities(first: list[bytes], second: list[bytes], words: int = SHINGLE_WORDS) -> np.ndarray:
    n = len(first)
    row, shingle, count = weighted_shingles([*first, *second], words)
    pair = row % n
    order = np.lexsort((shingle, pair))
    pair, shingle, count = pair[order], shingle[order], count[order]
    twice = np.flatnonzero((pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1]))
    common = np.bincount(pair[twice], weights=np.minimum(count[twice], count[twice + 1]), minlength=n)
    total = np.bincount(pair, weights=count, minlength=n)
    return np.divide(common, total - common, out=np.ones(n), where=total > 0)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of ``pairs`` that are similar, by their texts."""
    both = pairs.join(texts.select(F.col("row").alias("a"), F.col("packed").alias("first")), "a").join(
        texts.select(F.col("row").alias("b"), F.col("packed").alias("second")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for c in ("first", "second") for x in batch.column(c).to_pylist()])
            sizes = sizes[: batch.num_rows] + sizes[batch.num_rows :]
            for start, end in slices(2 * sizes):
                part = batch.slice(start, end - start)
                found = _similarities(unpacked(part.column("first")), unpacked(part.column("second")))
                kept = pa.array(found >= SIMILARITY)
                yield pa.RecordBatch.from_arrays([part.column(c).filter(kept) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "first", "second").mapInArrow(run, "a bigint, b bigint")


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _against_hub(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Distinct pairs of the members of buckets (``key, row, label``) and the hub (``hub, hub_label``) of each,
    where they are not in one component."""
    return members.join(hubs, "key").filter("label != hub_label").select(*_pair("row", "hub")).distinct()


def _others() -> list:
    """The columns of a text's other side in a join."""
    return [F.col(name).alias(f"other_{name}") for name in ("label", "n", *PARITY)]


_OTHER_PARITY = [f"other_{name}" for name in PARITY]


def _across(members: DataFrame) -> DataFrame:
    """Distinct pairs of the members of small buckets that are not in one component and may be similar."""
    other = members.select("key", F.col("row").alias("other"), *_others())
    both = members.join(other, "key").filter("row < other AND label != other_label")
    return both.filter(_may_be_similar("n", "other_n", _OTHER_PARITY)).select(*_pair("row", "other")).distinct()


def _labelled(rows: DataFrame, column: str, labels: DataFrame, name: str) -> DataFrame:
    """``rows`` with the component of a node; a node without links is its own."""
    found = labels.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return rows.join(found, column, "left").withColumn(name, F.coalesce("_root", column)).drop("_root")


def _buckets(nodes: DataFrame) -> DataFrame:
    """``key, row, size, shares`` of the buckets with several members, stored. ``shares`` adds up the sizes
    of a member's buckets: the text most others come from has the highest."""
    bands = nodes.select("row", F.explode("bands").alias("key"))
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    crowded = bands.join(sizes, "key")
    shares = crowded.groupBy("row").agg(F.sum("size").alias("shares"))
    return stored(crowded.join(shares, "row").select("key", "row", "size", "shares"), "buckets")


def _linked(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, root`` of the components that verified links make; a node without links may be missing."""
    crowded = _buckets(nodes)
    places = crowded.select("row").distinct().join(nodes.select("row", *NAME), "row")
    lower = identified(docs).withColumn("text", F.lower("text"))
    texts = packed(lower).join(places, NAME).dropDuplicates(["row"])
    texts = stored(texts.select("row", "packed"), "texts")

    most = F.max_by("row", F.struct("shares", "row")).alias("hub")
    hubs = crowded.groupBy("key").agg(most).withColumn("hub_label", F.col("hub"))
    tried = stored(_alike(_against_hub(crowded.withColumn("label", F.col("row")), hubs), nodes), "pairs")
    labels = _closest_first(tried, None, texts)
    # buckets that still hold several components: small ones are compared across them, large ones joined
    inside = _labelled(crowded, "row", labels, "label")
    mixed = inside.groupBy("key").agg((F.min("label") != F.max("label")).alias("mixed")).filter("mixed")
    inside = stored(inside.join(mixed.select("key"), "key"), "mixed")
    across = _across(inside.filter(F.col("size") <= SMALL_BUCKET).join(nodes.select("row", "n", *PARITY), "row"))
    large = inside.filter(F.col("size") > SMALL_BUCKET).select("row", "label").distinct()
    joined = _sharing_rare(stored(texts.join(large, "row"), "large"))
    pairs = across.unionByName(joined).distinct().join(tried.select("a", "b"), ["a", "b"], "left_anti")
    return _closest_first(stored(_alike(pairs, nodes), "pairs"), labels, texts)


def _closest_first(tried: DataFrame, labels: DataFrame | None, texts: DataFrame) -> DataFrame:
    """The components ``labels`` joined by the similar pairs among ``tried`` (``a, b, likeness``): the most similar
    partner of each first, then only what that leaves apart."""
    sides = [
        tried.select(F.lit(side).alias("side"), F.col(of).alias("of"), F.col(other).alias("other"), "likeness")
        for side, of, other in ((0, "a", "b"), (1, "b", "a"))
    ]
    closest = sides[0].unionByName(sides[1]).groupBy("side", "of").agg(F.max_by("other", F.struct("likeness", "other")).alias("other"))
    first = stored(closest.select(*_pair("of", "other")).distinct(), "pairs")
    labels = components(stored(_verified(first, texts), "links"), labels)
    rest = tried.select("a", "b").join(first, ["a", "b"], "left_anti")
    return components(_confirmed(rest, labels, texts), labels)


def _shingle_counts(texts: DataFrame) -> np.ndarray:
    """How many of ``texts`` hold a shingle, by the slot of its hash. What a task has counted goes by blocks of slots, so it
    is ``SLOTS / BLOCK`` rows at most, however many texts it read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for _, some in _unpacked_slices(batch):
                counts += np.bincount((weighted_shingles(some)[1] % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        yield _blocks(counts)

    def added(blocks: pa.Table) -> pa.Table:
        total = sum(_counts(x) for x in blocks.column("counts").to_pylist())
        return pa.table({"block": blocks.column("block")[:1], "counts": pa.array([_packed_counts(total)], pa.binary())})

    schema = "block bigint, counts binary"
    found = texts.select("packed").mapInArrow(run, schema).groupBy("block").applyInArrow(added, schema).toArrow()
    out = np.zeros(SLOTS, np.int64)
    for block, counts in zip(found.column("block").to_pylist(), found.column("counts").to_pylist()):
        out[block * BLOCK : (block + 1) * BLOCK] = _counts(counts)
    return out


def _blocks(counts: np.ndarray) -> pa.RecordBatch:
    """``block, counts`` of the blocks in which something was counted."""
    rows = counts.reshape(-1, BLOCK)
    filled = np.flatnonzero(rows.any(axis=1))
    return pa.RecordBatch.from_arrays(
        [pa.array(filled), pa.array([_packed_counts(rows[i]) for i in filled], pa.binary())], names=["block", "counts"]
    )


def _packed_counts(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").tobytes())


def _counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<i8")


def _unpacked_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch, some rows at a time, and the number of the first."""
    column = batch.column("packed")
    # compressed texts; they take three to five times the room
    for start, end in slices(4 * np.array([len(x) for x in column.to_pylist()], np.int64) + ROW_BYTES):
        yield start, unpacked(column.slice(start, end - start))


def _rare_shingles(texts: DataFrame) -> DataFrame:
    """``shingle, row, label, n, place, found`` and the parity of the rarest of each text's ``n`` shingles, a repeated shingle being one
    each time it stands; ``place`` of them are rarer.

    All texts order shingles alike. Of two similar texts the larger has one of its first ``n - 0.8 n + 1`` among the
    first ``n - 1.6 / 1.8 n + 1`` (``found``) of the other: what they share is no less than 0.8 of the larger and
    1.6 / 1.8 of the smaller.
    """
    counts = _shingle_counts(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, some in _unpacked_slices(batch):
                weighted = weighted_shingles(some)
                row, shingle, count = weighted
                often = counts[(shingle % np.uint64(SLOTS)).astype(np.int64)]
                order = np.lexsort((shingle, often, row))
                times = count[order]
                shared = np.repeat(often[order], times) > 1
                row, shingle = np.repeat(row[order], times), np.repeat(shingle[order], times)
                shingle = mix(shingle, count_up(times).astype(np.uint64))
                parity = parities(*weighted, len(some))[row]
                total = np.bincount(row, minlength=len(some))
                place = count_up(total)
                n = total[row]
                # no other text has what one alone holds
                kept = (place <= n - np.ceil(SIMILARITY * n - 1e-9)) & shared
                found = place <= n - np.ceil(2 * SIMILARITY / (1 + SIMILARITY) * n - 1e-9)
                at = pa.array(start + row[kept])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shingle[kept].view(np.int64)),
                        batch.column("row").take(at),
                        batch.column("label").take(at),
                        pa.array(n[kept]),
                        pa.array(place[kept]),
                        pa.array(found[kept]),
                        *(pa.array(parity[kept, i]) for i in range(len(PARITY))),
                    ],
                    names=["shingle", "row", "label", "n", "place", "found", *PARITY],
                )

    more = ", ".join(f"{name} bigint" for name in PARITY)
    return texts.mapInArrow(run, f"shingle bigint, row bigint, label bigint, n bigint, place bigint, found boolean, {more}")


def _sharing_rare(texts: DataFrame) -> DataFrame:
    """Distinct pairs of ``texts`` (``row, label, packed``) in two components that share a rare shingle: all that are similar,
    and others. A shingle by which many are found is dealt in pieces."""
    rare = stored(_rare_shingles(texts), "rare")
    crowds = rare.filter("found").groupBy("shingle").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > CROWD)
    crowds = stored(crowds.select("shingle", F.ceil(F.col("size") / CROWD).cast("int").alias("pieces")), "crowds")
    dealt = rare.join(F.broadcast(crowds), "shingle", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    smaller = dealt.filter("found").select(
        "shingle",
        F.pmod(F.hash("row"), "pieces").alias("piece"),
        F.col("row").alias("other"),
        F.col("place").alias("other_place"),
        *_others(),
    )
    larger = dealt.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    needed = F.ceil(SIMILARITY / (1 + SIMILARITY) * (F.col("n") + F.col("other_n")) - 1e-6)
    both = larger.join(smaller, ["shingle", "piece"]).filter(
        (F.col("label") != F.col("other_label"))
        & (F.struct("other_n", "other") < F.struct("n", "row"))
        & (F.col("other_n") >= SIMILARITY * F.col("n") - 1e-9)
        # the first shingle two texts share has nothing in common ahead of it; so much has to be left behind
        & (F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place")) >= needed)
        & _may_be_similar("n", "other_n", _OTHER_PARITY)
    )
    return both.select(*_pair("row", "other")).distinct()


def _confirmed(pairs: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """The similar ones among the pairs that lie in two components."""
    both = _labelled(_labelled(pairs, "a", labels, "from"), "b", labels, "to")
    return stored(_verified(both.filter("from != to").select("a", "b"), texts), "links")


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc, part, more`` (see :func:`meeting.identified`), ``doc_id, class_id, group_size, kept`` of every document.

    Documents are linked when their multisets of five-word shingles, in lower case, have a weighted Jaccard
    similarity of 0.8 or more, and grouped by chains of links; a shorter text is a single shingle. ``class_id`` is
    the smallest ``doc_id`` of the group (integral; null behind all others), and its first row is the one
    kept. A null text counts as empty; texts without words are copies of each other; repeated rows are copies; other
    columns are ignored; an empty table gives no rows. ``number`` gives rows a name of their own.

    Banding finds a pair at 0.8 with probability 1 - 3e-6, sketches keep it with 1 - 1.4e-4; more similar
    pairs are missed more rarely still. Nothing is capped: whatever a bucket's size, its members in several
    components meet, by their rarest shingles where there are more than ``SMALL_BUCKET``.
    """
    rows = signed(docs)
    # copies: one row of each digest takes part, the others follow it
    copies = rows.groupBy("digest").agg(F.min(F.struct("doc", "row"))["row"].alias("leader"))
    copies = stored(copies, "copies")
    nodes = stored(rows.join(copies.select("leader"), F.col("row") == F.col("leader"), "left_semi"), "nodes")
    labels = _linked(nodes, docs)
    named = _labelled(rows.select("row", *NAME, "doc_id", "digest").join(copies, "digest"), "leader", labels, "label")
    named = stored(named.select("row", *NAME, "doc_id", "label"), "labelled")
    groups = named.groupBy("label").agg(
        F.min(F.struct("doc", "row", "doc_id")).alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    return named.join(groups, "label").select(
        *NAME,
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group, all columns as they are."""
    kept = near_groups(docs).filter("kept").select(*NAME)
    key = {"doc": id_order(F.col("doc_id")), **text_name(F.coalesce("text", F.lit("")))}
    return first_rows(docs, key, kept)
