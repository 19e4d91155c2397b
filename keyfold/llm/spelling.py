"""Spelling variants (operator 13): a frontier of states walked down a relational trie, all words at once.

The trie of the vocabulary is an edge table. Paths without a branch are one edge, so an edge has a label of several letters, and what
hangs below the last branch of a word is one edge to that word, its leaf. Edges are split by level, the number of branchings above
them. The frontier is a table of states (word, position, node, edits); level by level it is joined with the edges of its nodes.
A state without edits may follow an edge as it is, replace a letter on it or skip one of its own; a state with
an edit has to match. Leaves that end with one edit are neighbours.

An edit in the first half of a word lies in the second half of the word read backwards, so there are two tries, and each looks for
edits behind the half alone: the frontier starts at a word's own node there, where few words share a node, and never meets the
crowd at the root. Of two words of one length the smaller finds the other, else the longer one does, in exactly one of the tries.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import encoded_slices, mix, scramble, stored

# Fixed values of the words looked at.
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
#: One occurrence in so many loses a letter.
LOSES = 31
#: A form stands so many times as often as its variant.
RATIO = 10

# What may follow a node is kept in 63 bits: lengths share the last one, letters have one by their code point.
_BITS = 63
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: how often a word stands in the texts, those of ``MIN_LENGTH`` letters or more.

    Words of a task are counted there, a megabyte of text at a time, so a word however frequent sends few rows.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    long_run = re.compile(f"[{LETTERS}]{{{MIN_LENGTH},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        size = 0
        for batch in batches:
            for start, texts in encoded_slices(batch.column("text")):
                ids = batch.column("doc_id").slice(start, len(texts)).to_pylist()
                for doc_id, text in zip(ids, texts):
                    # bytes lower A-Z alone
                    found = Counter(long_run.findall(text.lower().decode()))
                    seed = zlib.crc32(f"{doc_id}:".encode())
                    for word, n in found.items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % LOSES == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < MIN_LENGTH:
                                continue
                        counts[word] += n
                        size += len(word)
                if size > 1 << 22:
                    yield _counted(counts)
                    counts, size = Counter(), 0
        yield _counted(counts)

    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def _names(rolled: np.ndarray, depth: np.ndarray, way: np.ndarray) -> np.ndarray:
    """Names of nodes by the rolling hash of their prefix, its length, and the trie they belong to."""
    return scramble(mix(rolled, (depth.astype(np.uint64) << np.uint64(1)) + way.astype(np.uint64))).view(np.int64)


def _prefixes(words: DataFrame) -> DataFrame:
    """``id, way, depth, node, next`` of every prefix of ``letters`` but the empty one: the name of its node, and the letter behind
    it, 0 at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ways = batch.column("id").to_numpy(), batch.column("way").to_numpy()
            # an array entry a letter, several arrays
            for start, texts in encoded_slices(batch.column("letters"), 1 << 18):
                points = [np.frombuffer(t.decode().encode("utf-32-le"), "<u4") for t in texts]
                sizes = np.array([len(p) for p in points])
                letter = np.concatenate(points).astype(np.uint64)
                ends = np.cumsum(sizes)
                depth = np.arange(len(letter)) - np.repeat(ends - sizes, sizes) + 1
                factor = np.full(int(sizes.max()) + 1, _STEP)
                factor[0] = 1
                rolled = np.cumsum(scramble(letter + _STEP) * np.multiply.accumulate(factor)[depth])
                before = np.concatenate((np.zeros(1, np.uint64), rolled))[ends - sizes]
                rolled -= np.repeat(before, sizes)
                behind = np.append(letter[1:], np.uint64(0))
                behind[ends - 1] = 0
                whose = slice(start, start + len(texts))
                way = np.repeat(ways[whose], sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids[whose], sizes)),
                        pa.array(way),
                        pa.array(depth.astype(np.int32)),
                        pa.array(_names(rolled, depth, way)),
                        pa.array(behind.astype(np.int32)),
                    ],
                    names=["id", "way", "depth", "node", "next"],
                )

    return words.select("id", "way", "letters").mapInArrow(run, "id bigint, way int, depth int, node bigint, next int")


def _root(way: int) -> int:
    return int(_names(np.zeros(1, np.uint64), np.zeros(1, np.int64), np.array([way]))[0])


def _length(text: str) -> Column:
    return F.char_length(text)


def _part(text: str, start: Column | int, length: Column) -> Column:
    """Some letters of a word, from a place that counts from 0."""
    return F.substring(F.col(text), (start if isinstance(start, Column) else F.lit(start)) + 1, length)


def _half() -> Column:
    """Where the half begins in which a trie looks for edits."""
    whole = _length("letters")
    half = F.floor(whole / 2).cast("int")
    return F.when(F.col("way") == 0, half).otherwise(whole - half)


def _bit(value: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), value.cast("int"))


def _length_bit(length: Column) -> Column:
    return _bit(F.least(length, F.lit(_BITS - 1)))


def _letter_bit(letter: Column) -> Column:
    """The bit of a letter; of no letter, bit 0."""
    return _bit(F.ascii(letter) % _BITS)


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges of both tries of ``words`` (``id, word, n``), and the states the frontier starts with.

    Edges: ``level, parent, label``, and ``child, lengths, letters_next`` of a branch or ``other, other_n`` of a leaf. Only edges behind the
    half are kept. States: ``level, letters, way, n, position, node, edits``.
    """
    both = F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("letters")), F.struct(F.lit(1).alias("way"), F.reverse("word").alias("letters"))))
    ways = words.select("id", "word", "n", both.alias("both")).select("id", "word", "n", "both.*")
    prefixes = _prefixes(ways)
    # where two letters may follow, or one and the end
    branches = prefixes.groupBy("node").agg(F.min("next").alias("least"), F.max("next").alias("most")).filter("least < most").select("node")
    on_path = prefixes.select("id", "way", "depth", "node").join(stored(branches, "branches"), "node", "left_semi")
    paths = on_path.groupBy("id", "way").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("path"))
    root = F.struct(F.lit(0).alias("depth"), F.when(F.col("way") == 0, F.lit(_root(0))).otherwise(F.lit(_root(1))).alias("node"))
    none = F.array().cast("array<struct<depth:int,node:bigint>>")
    whole = F.concat(F.array(root), F.coalesce("path", none))
    placed = ways.join(paths, ["id", "way"], "left").withColumn("path", whole)
    # the last branch before the half
    placed = placed.withColumn("start", F.size(F.filter("path", lambda x: x["depth"] <= _half())) - 1)
    placed = stored(placed.drop("id"), "paths")

    steps = placed.select("*", F.posexplode("path").alias("level", "at")).filter("level >= start")
    behind = F.get("path", F.col("level") + 1)
    length = F.coalesce(behind["depth"], _length("letters")) - F.col("at.depth")
    steps = steps.select("level", F.col("at.node").alias("parent"), behind.alias("to"), _part("letters", F.col("at.depth"), length).alias("label"), "letters", "word", "n")
    left = _length("letters") - F.col("to.depth")
    branch = (
        steps.filter("to IS NOT NULL")
        .select(
            "level", "parent", "label", F.col("to.node").alias("child"), _length_bit(left).alias("lengths"), _letter_bit(_part("letters", F.col("to.depth"), F.lit(1))).alias("letters_next")
        )
        .groupBy("level", "parent", "child")
        .agg(F.first("label").alias("label"), F.bit_or("lengths").alias("lengths"), F.bit_or("letters_next").alias("letters_next"))
    )
    leaves = steps.filter("to IS NULL").select("level", "parent", "label", F.col("word").alias("other"), F.col("n").alias("other_n"))
    edges = branch.unionByName(leaves, allowMissingColumns=True).sortWithinPartitions("level")
    at = F.get("path", F.col("start"))
    states = placed.select("letters", "way", "n", F.col("start").alias("level"), at["depth"].alias("position"), at["node"].alias("node"), F.lit(0).alias("edits"))
    return stored(edges, "edges"), stored(states.sortWithinPartitions("level"), "starts")


STATE = ["letters", "way", "n", "position", "node", "edits"]


def _walked(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level down: the states behind the edges, and rows with ``other, other_n`` where a leaf ends with one edit."""
    both = states.join(edges, states["node"] == edges["parent"])
    size = _length("label")
    here = _part("letters", F.col("position"), size)
    longer = _part("letters", F.col("position"), size + 1)
    matches, fresh = here == F.col("label"), F.col("edits") == 0

    def goes(condition: Column, by: Column, edits: Column) -> Column:
        place = F.col("position") + by
        left = _length("letters") - place
        follows = F.col("lengths").bitwiseAND(_length_bit(left)) != 0
        letter = F.col("letters_next").bitwiseAND(_letter_bit(_part("letters", place, F.lit(1)))) != 0
        # what matches throughout is the word's own path
        own = (edits == 0) | (follows & letter)
        state = F.struct(place.alias("position"), F.col("child").alias("node"), edits.cast("int").alias("edits"))
        return F.when(F.col("child").isNotNull() & condition & (left >= 0) & own, state)

    moves = F.array(
        goes(matches, size, F.col("edits")),
        goes(fresh & (F.char_length(here) == size) & (F.levenshtein(here, F.col("label"), 1) == 1), size, F.lit(1)),
        # a letter that may be skipped here or behind the edge is skipped there
        goes(fresh & ~matches & (F.char_length(longer) == size + 1) & (F.levenshtein(longer, F.col("label"), 1) == 1), size + 1, F.lit(1)),
        F.when(_ends(matches), F.struct(F.col("position"), F.col("node"), F.col("edits"))),
    )
    out = both.select("letters", "way", "n", F.explode(moves).alias("to"), "other", "other_n").filter("to IS NOT NULL")
    return out.select("letters", "way", "n", "to.*", "other", "other_n")


def _ends(matches: Column) -> Column:
    """Whether a leaf is a neighbour of the state's word that this word has to find in this trie."""
    rest = F.substring(F.col("letters"), F.col("position") + 1, _length("letters"))
    one_edit = F.when(F.col("edits") == 1, rest == F.col("label")).otherwise(F.levenshtein(rest, F.col("label"), 1) == 1)
    word = F.when(F.col("way") == 0, F.col("letters")).otherwise(F.reverse("letters"))
    way = F.when(F.col("way") == 0, F.col("other")).otherwise(F.reverse("other"))
    size, found = _length("letters"), _length("other")
    finds = (found == size - 1) | ((found == size) & (word < F.col("other")))
    here = F.substring(F.col("letters"), F.lit(1), _half()) == F.substring(way, F.lit(1), _half())
    # a doubled letter in the middle may be skipped on either side
    first = F.floor(size / 2).cast("int")
    there = (F.col("way") == 1) & (F.substring(word, F.lit(1), first) == F.substring(F.col("other"), F.lit(1), first))
    return F.col("other").isNotNull() & finds & one_edit & here & ~there & (F.levenshtein(word, F.col("other"), 1) == 1)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n`` of all words (``id, word, n``) that differ by one letter inserted, deleted or replaced: each pair once."""
    edges, starts = trie(words)
    top = starts.agg(F.max("level")).first()[0]
    found, carried, level = [], None, 0
    while carried is not None or (top is not None and level <= top):
        states = starts.filter(F.col("level") == level).select(*STATE)
        if carried is not None:
            states = states.unionByName(carried)
        walked = stored(_walked(states, edges.filter(F.col("level") == level)), "frontier")
        found.append(walked.filter("other IS NOT NULL"))
        carried = walked.filter("other IS NULL").select(*STATE)
        carried = None if carried.isEmpty() else carried
        level += 1
    pairs = words.sparkSession.createDataFrame([], "word string, n bigint, other string, other_n bigint")
    for some in found:
        word = F.when(F.col("way") == 0, F.col("letters")).otherwise(F.reverse("letters"))
        pairs = pairs.unionByName(some.select(word.alias("word"), "n", "other", "other_n"))
    return pairs


def _followed(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms (``word, form``) of a word lead in the end. Each round doubles the steps taken; a form stands ten times
    as often as its word, so there are few."""
    ahead = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ahead = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return ahead


def variant_groups(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    Words are the runs of ``LETTERS`` with A-Z lowered, of which one occurrence in ``LOSES`` (by the crc32 of ``<doc_id>:<word>``; a
    null ``doc_id`` is empty) loses a letter; those of ``MIN_LENGTH`` letters and ``MIN_COUNT`` occurrences count. ``n_near`` words differ from a word by one letter;
    its ``form`` is the most frequent of them, the smallest of equals, if it stands ``RATIO`` times as often. ``root`` is where forms of
    forms end. A null text has no words; rows that repeat count each time; other columns are ignored; an empty table gives no
    rows. A run of letters is one word however long: the walk takes a round a branching above it, not one a letter.
    """
    counts = word_counts(docs).filter(F.col("n") >= MIN_COUNT)
    words = stored(counts.withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = neighbours(words)
    links = pairs.select("word", "other", "other_n").unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("order"), "other")).alias("best")
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    often = -F.col("best.order") >= RATIO * F.col("n")
    named = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(often, F.col("best.other")).alias("form"),
        F.when(often, -F.col("best.order")).alias("form_n"),
    )
    named = stored(named, "forms")
    roots = _followed(named.filter("form IS NOT NULL").select("word", "form"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
