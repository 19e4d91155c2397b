"""Merkle manifest of a table (operator 12): incremental witnesses over an append-only tree.

Each tree (a source) is a row of leaves in ascending order. Leaves arrive in appends; blocks of consecutive nodes, three levels
of ``FAN`` each, are the unit of work. A block that is full is closed for good, and its root is a further append to
the same tree one height up; of every tree and height at most one block is open. The witness of a
closed block, the siblings on the way to the root, is partial as long as the blocks above are open: each block that
closes above extends the witnesses of the blocks in it by three levels, and these are written once. Nothing is recomputed below a closed
block, and a proof puts the parts together from the top.

Levels inside a block that is not full depend on the size of the whole tree alone: if it has one block, until one node is
left, else three.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyfold.llm.common import id_order, row_number, stored
from keyfold.session import scratch_path

FAN = 16
# Levels of a block; it has FAN ** LEVELS nodes.
LEVELS = 3
DIGEST = 64
# Rows of one block: the digests of its nodes one after another.
BLOCKS = "tree string, block bigint, n int, digests string"


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else its length in UTF-8 bytes, ``:``, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _split(digests: str) -> list[str]:
    return [digests[i : i + DIGEST] for i in range(0, len(digests), DIGEST)]


def levels_of(nodes: list[str], alone: bool, levels: int = LEVELS) -> list[list[str]]:
    """The nodes of a block and the levels above them, its root last; up to one node if it is ``alone``."""
    out = [nodes]
    while len(out[-1]) > 1 if alone else len(out) <= levels:
        last = out[-1]
        out.append([_hash("".join(last[i : i + FAN])) for i in range(0, len(last), FAN)])
    return out


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """For each level below the root, what stands left and right of a node's ancestor in its run."""
    out = []
    for nodes in levels[:-1]:
        start = at - at % FAN
        out.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + FAN])))
        at //= FAN
    return out


def _written(path: list[tuple[str, str]]) -> str:
    """A path as text: per level ``left,right;``."""
    return "".join(f"{left},{right};" for left, right in path)


def folded(digest: str, path: str) -> str:
    """The root a digest leads to along a path."""
    for level in path.split(";")[:-1]:
        left, right = level.split(",")
        digest = _hash(left + digest + right)
    return digest


def proof(path: str) -> str:
    """The digest of all siblings on a path, from the leaf up, left to right."""
    return _hash(path.replace(",", "").replace(";", ""))


def indexed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, their place in their ``tree``, ascending by ``order``; nulls stand as Spark sorts them.

    Rows are dealt by ranges of (tree, order), counted per range and tree, and numbered inside their range: neither a tree nor
    a value is brought together. Rows alike in ``tree`` and ``order`` get their places by a stored row number. ``tree`` is never null.
    """
    named = stored(rows.withColumn("_row", row_number()), "leaves")
    ranged = named.repartitionByRange("tree", *order, "_row").sortWithinPartitions("tree", *order, "_row")
    dealt = stored(ranged.withColumn("_range", F.spark_partition_id()).withColumn("_place", row_number()), "ranges")
    counts = dealt.groupBy("_range", "tree").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    # one row per range that a tree reaches into
    earlier = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("_range").alias("_r"),
        F.col("tree").alias("_t"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    found = dealt.join(starts, (F.col("_range") == F.col("_r")) & (F.col("tree") == F.col("_t")))
    return found.withColumn("at", F.col("_place") + F.col("_shift")).drop("_row", "_range", "_place", "_r", "_t", "_shift")


def _roots(blocks: DataFrame, levels: int) -> DataFrame:
    """``tree, block, digest`` of blocks: their roots. ``alone`` says whether a block is all of its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = zip(batch.column("digests").to_pylist(), batch.column("alone").to_pylist())
            roots = [levels_of(_split(digests), alone, levels)[-1][0] for digests, alone in each]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("block"), pa.array(roots, pa.string())], names=["tree", "block", "digest"])

    return blocks.select("tree", "block", "digests", "alone").mapInArrow(run, "tree string, block bigint, digest string")


def _paths(blocks: DataFrame, levels: int) -> DataFrame:
    """``tree, at, path`` of every node of ``blocks``: its siblings inside the block."""
    size = FAN**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, digests, alone in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "digests", "alone"))):
                each = levels_of(_split(digests), alone, levels)
                n = len(each[0])
                # as many rows at a time as fit a few megabytes: a path has up to three times fifteen digests
                for start in range(0, n, 1024):
                    some = range(start, min(start + 1024, n))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([tree] * len(some), pa.string()),
                            pa.array([block * size + i for i in some], pa.int64()),
                            pa.array([_written(siblings(each, i)) for i in some], pa.string()),
                        ],
                        names=["tree", "at", "path"],
                    )

    return blocks.select("tree", "block", "digests", "alone").mapInArrow(run, "tree string, at bigint, path string")


def _gathered(nodes: DataFrame, size: int) -> DataFrame:
    """Nodes (``tree, at, digest``) as blocks of ``size`` at most."""
    each = F.array_sort(F.collect_list(F.struct("at", "digest")))
    blocks = nodes.groupBy("tree", F.floor(F.col("at") / size).alias("block")).agg(each.alias("each"))
    return blocks.select("tree", "block", F.size("each").alias("n"), F.array_join("each.digest", "").alias("digests"))


def _nodes(blocks: DataFrame, size: int) -> DataFrame:
    """The nodes of blocks one by one, ``tree, at, digest``."""
    places = F.sequence(F.lit(0), F.col("n") - 1)
    each = blocks.select("tree", "block", "digests", F.explode(places).alias("place"))
    return each.select(
        "tree", (F.col("block") * size + F.col("place")).alias("at"), F.substring("digests", F.col("place") * DIGEST + 1, F.lit(DIGEST)).alias("digest")
    )


class Manifest:
    """Trees under the folder ``path``, grown by :meth:`append`; a path that holds some is gone on with.

    Per height every append writes the blocks it touched, full ones for good and the open one of each tree anew, and the witness
    parts that members of full blocks got from them. The list of these folders is written last, so an append that fails leaves no trace.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, levels: int = LEVELS):
        self.spark = spark
        self.levels = levels
        self.size = FAN**levels
        self.path = path or scratch_path(spark, "manifest")
        self.version = 0
        # of each height: the folders of blocks, the last of them with the open ones; the folders of witness parts
        self.blocks: list[list[str]] = []
        self.extensions: list[list[str]] = []
        try:
            state = spark.read.schema("blocks array<array<string>>, extensions array<array<string>>, version int").parquet(f"{self.path}/state")
            last = state.orderBy(F.col("version").desc()).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        if last:
            self.version, self.blocks, self.extensions = last.version, last.blocks, last.extensions

    def append(self, leaves: DataFrame) -> None:
        """Adds leaves: ``tree, at, digest``, ``at`` going on where the tree ends (:meth:`sizes`)."""
        kept = self.blocks, self.extensions
        self.blocks, self.extensions = [list(x) for x in self.blocks], [list(x) for x in self.extensions]
        try:
            nodes, height = leaves, 0
            while nodes is not None:
                if height == len(self.blocks):
                    self.blocks.append([])
                    self.extensions.append([])
                nodes = self._grow(height, nodes)
                height += 1
            schema = "blocks array<array<string>>, extensions array<array<string>>"
            state = self.spark.createDataFrame([(self.blocks, self.extensions)], schema)
            state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/version={self.version + 1}")
        except BaseException:
            self.blocks, self.extensions = kept
            raise
        self.version += 1

    def sizes(self) -> DataFrame:
        """``tree, size``: the number of leaves of each tree so far."""
        every = self._full(0).unionByName(self._open(0)) if self.blocks else self._read()
        return every.groupBy("tree").agg(F.sum("n").alias("size"))

    def _grow(self, height: int, nodes: DataFrame) -> DataFrame | None:
        """Appends nodes at a height; what the blocks that it fills append one height up. A tree's open block is written
        again even where nothing is added to it: open blocks of all trees stand in the last folder."""
        nodes = nodes.select("tree", "at", "digest")
        if self.blocks[height]:
            nodes = nodes.unionByName(_nodes(self._open(height), self.size))
        folder = f"{self.path}/blocks/{height}-{self.version + 1}-{uuid.uuid4().hex}"
        _gathered(nodes, self.size).write.parquet(folder)
        self.blocks[height].append(folder)
        full = self._read(folder).filter(F.col("n") == self.size).withColumn("alone", F.lit(False))
        if full.isEmpty():
            return None
        if height:
            parts = f"{self.path}/extensions/{height}-{self.version + 1}-{uuid.uuid4().hex}"
            _paths(full, self.levels).write.parquet(parts)
            self.extensions[height].append(parts)
        return stored(_roots(full, self.levels).select("tree", F.col("block").alias("at"), "digest"), "roots")

    def _read(self, *folders: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], BLOCKS)
        return self.spark.read.schema(BLOCKS).parquet(*folders)

    def _full(self, height: int) -> DataFrame:
        return self._read(*self.blocks[height]).filter(F.col("n") == self.size)

    def _open(self, height: int) -> DataFrame:
        return self._read(self.blocks[height][-1]).filter(F.col("n") < self.size)

    def sealed(self) -> Sealed:
        """The trees as if nothing more came: the open blocks get their roots too, height by height. What is stored stays as it is."""
        last: list[DataFrame] = []
        ends: list[DataFrame] = []
        above: DataFrame | None = None
        height = 0
        while height < len(self.blocks) or above is not None:
            nodes = _nodes(self._open(height), self.size) if height < len(self.blocks) else None
            if above is not None:
                nodes = above if nodes is None else nodes.unionByName(above)
            # a tree's last block; it is the whole tree if it is also its first
            blocks = stored(_gathered(nodes, self.size).withColumn("alone", F.col("block") == 0), "sealed")
            last.append(blocks)
            roots = stored(_roots(blocks, self.levels), "roots")
            ends.append(roots.filter("block = 0").select("tree", F.col("digest").alias("subroot")))
            above = roots.filter("block > 0").select("tree", F.col("block").alias("at"), "digest")
            above = None if above.isEmpty() else above
            height += 1
        return Sealed(self, last, ends)


class Sealed:
    """The state of a :class:`Manifest` with roots and whole witnesses."""

    def __init__(self, manifest: Manifest, last: list[DataFrame], ends: list[DataFrame]):
        self.manifest = manifest
        self.last = last
        self.spark = manifest.spark
        roots = self.spark.createDataFrame([], "tree string, subroot string")
        for some in ends:
            roots = roots.unionByName(some)
        #: ``tree, subroot``
        self.roots = roots

    def _blocks(self, height: int) -> DataFrame:
        full = self.manifest._full(height) if height < len(self.manifest.blocks) else self.manifest._read()
        return full.withColumn("alone", F.lit(False)).unionByName(self.last[height])

    def _outer(self) -> DataFrame:
        """``tree, block, outer`` of the leaves' blocks: the path from a block's root to the root of its tree. Blocks that are the whole
        tree have no row."""
        outer = None
        for height in range(len(self.last) - 1, 0, -1):
            parts = _paths(self.last[height], self.manifest.levels)
            if height < len(self.manifest.extensions) and self.manifest.extensions[height]:
                written = self.spark.read.schema("tree string, at bigint, path string").parquet(*self.manifest.extensions[height])
                parts = parts.unionByName(written)
            if outer is not None:
                parts = parts.withColumn("above", F.floor(F.col("at") / self.manifest.size))
                upper = outer.select("tree", F.col("block").alias("above"), "outer")
                parts = parts.join(upper, ["tree", "above"], "left").withColumn("path", F.concat("path", F.coalesce("outer", F.lit(""))))
            outer = stored(parts.select("tree", F.col("at").alias("block"), F.col("path").alias("outer")), "outer")
        return self.spark.createDataFrame([], "tree string, block bigint, outer string") if outer is None else outer

    def paths(self) -> DataFrame:
        """``tree, at, path`` of every leaf; for few leaves, since a path is as long as its siblings."""
        inner = _paths(self._blocks(0), self.manifest.levels).withColumn("block", F.floor(F.col("at") / self.manifest.size))
        whole = inner.join(self._outer(), ["tree", "block"], "left")
        return whole.select("tree", "at", F.concat("path", F.coalesce("outer", F.lit(""))).alias("path"))

    def verified(self, claims: DataFrame, beyond: DataFrame) -> DataFrame:
        """``kept, tree, proof_sha256, folded_root`` of claims (``tree, at, claim, kept``): one at most for a leaf, ``claim`` being what is said
        to stand there. ``beyond`` (``tree, beyond``) is the path from a tree's root on. Claims go to their
        blocks, so no path leaves a task."""
        size, inside = self.manifest.size, self.manifest.levels
        block = F.floor(F.col("at") / size).alias("block")
        each = F.collect_list(F.struct((F.col("at") % size).cast("int").alias("place"), "claim", "kept"))
        asked = claims.groupBy("tree", block).agg(each.alias("each"))
        asked = asked.select("tree", "block", "each.place", "each.claim", "each.kept")
        rows = self._blocks(0).join(asked, ["tree", "block"]).join(self._outer(), ["tree", "block"], "left").join(beyond, "tree", "left")
        path = F.concat(F.coalesce("outer", F.lit("")), F.coalesce("beyond", F.lit("")))
        rows = rows.select("tree", "digests", "alone", "place", "claim", "kept", path.alias("outer"))
        kept = claims.schema["kept"].dataType.simpleString()
        schema = f"tree string, kept {kept}, proof_sha256 string, folded_root string"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i].as_py() for c in ("tree", "digests", "alone", "outer", "place", "claim")}
                    levels, outer = levels_of(_split(row["digests"]), row["alone"], inside), row["outer"]
                    proofs, roots = [], []
                    for place, claim in zip(row["place"], row["claim"]):
                        path = _written(siblings(levels, place)) + outer
                        proofs.append(proof(path))
                        roots.append(folded(claim, path))
                    column = batch.column("kept").slice(i, 1).flatten()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["tree"]] * len(proofs), pa.string()), column, pa.array(proofs, pa.string()), pa.array(roots, pa.string())],
                        names=["tree", "kept", "proof_sha256", "folded_root"],
                    )

        return rows.mapInArrow(run, schema)


def tree_key(source: Column) -> Column:
    """A source as the name of its tree: null sorts first, all others by their UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def manifest_of(docs: DataFrame, doc_id: Column, source: Column, leaf: Column, claim: Column) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row: one tree a source, and one over their roots.

    Leaves of a source ascend by ``doc_id`` (integral; null behind all others), rows that share one by their digests; rows that repeat as a
    whole are leaves of their own and interchangeable. A null source is a tree of its own, before all others. Empty and very long
    texts are like any others; other columns are ignored; an empty table gives no rows. A source's rows, however many,
    are numbered by ranges and worked on in blocks.
    """
    small = docs.select(id_order(doc_id).alias("order"), doc_id.alias("doc_id"), tree_key(source).alias("tree"), leaf.alias("digest"), claim.alias("claim"))
    leaves = stored(indexed(small, ["order", "digest"]), "indexed")
    manifest = Manifest(docs.sparkSession)
    manifest.append(leaves)
    sealed = manifest.sealed()
    # the trees' roots are the leaves of one more tree
    top = stored(indexed(sealed.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest")), ["name"]), "subroots")
    over = Manifest(docs.sparkSession)
    over.append(top)
    over = over.sealed()
    found = over.roots.first()
    root = F.lit(found["subroot"] if found else None)
    beyond = top.select("name", "at").join(over.paths(), "at").select(F.col("name").alias("tree"), F.col("path").alias("beyond"))
    kept = F.struct("doc_id", F.col("digest").alias("leaf"))
    checked = sealed.verified(leaves.select("tree", "at", "claim", kept.alias("kept")), stored(beyond, "beyond"))
    whole = checked.join(sealed.roots, "tree").select("kept.*", "subroot", root.cast("string").alias("root"), "proof_sha256", "folded_root")
    return whole.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of a table of documents, and what is left of it when the text of every fifth (by the crc32 of its id) has its capitals
    lowered: see :func:`manifest_of`."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fifth = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    lowered = F.translate("text", capitals, capitals.lower())
    leaf = leaf_digest(*columns, F.col("text"))
    claim = leaf_digest(*columns, F.when(fifth, lowered).otherwise(F.col("text")))
    return manifest_of(docs, F.col("doc_id"), F.col("source"), leaf, claim)
