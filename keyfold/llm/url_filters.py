"""URL filters (operator 11): rules first, then a tree of path templates per host.

A url's path is generalised segment by segment, all hosts at once, a round a depth. Below a node of the tree, segments that carry a share
of its pages stay as they are, all others are variable and become wildcards of their kind. Of the segments that stay,
those whose branches look alike, by what follows them and how their pages are labelled, are merged. A template is
rejected when the share of blocked ones among its labelled pages, smoothed towards its host's, reaches a threshold.

A round keeps few segments a node, whatever its size, so what is merged is small; pages are only counted and looked up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import stored

# Segments of a path that the tree tells apart; what is deeper is one wildcard.
DEPTH = 4
# A segment stays if so many pages, and such a share of those of its node, have it.
SUPPORT = 20
SHARE = 0.02
# Branches are merged up to this distance (Jensen-Shannon, in bits).
DISTANCE = 0.05
# Weight of the host's share against a template's own labels, in pages; and from where on a template is rejected.
SMOOTHING = 4.0
REJECTED = 0.5


class Rule(NamedTuple):
    """``verdict`` for the urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def host_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lowered, and path of a url; both empty if it is null or has no ``://``."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = [F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit("")) for i in (1, 2)]
    return F.translate(found[0], capitals, capitals.lower()), found[1]


def matched(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does. Of equals the longer host decides, then ``block``. The
    rules become one expression, which holds some hundred."""
    ordered = sorted(rules, key=lambda r: (-len(str(r)), -len(r.host), r.verdict != "block"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(ordered):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        rule, verdict = F.when(fits, str(r)).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def kind(segment: Column) -> Column:
    """The wildcard of a segment: what it is made of, and a file extension as it is."""
    extension = F.regexp_extract(segment, r"\.([A-Za-z]{2,5})$", 0)
    name = F.regexp_replace(segment, r"\.[A-Za-z]{2,5}$", "")
    of = (
        F.when(name == "", "")
        .when(name.rlike("^[0-9]+$"), "{number}")
        .when(name.rlike("^[0-9a-fA-F]{8,}$|^[0-9a-fA-F-]{36}$"), "{id}")
        .when(name.rlike(r"^\p{L}+$"), "{word}")
        .when(name.rlike(r"^[\p{L}0-9]+([-_+.][\p{L}0-9]+)+$"), "{slug}")
        .otherwise("{any}")
    )
    return F.concat(of, F.lower(extension))


def _segments(path: Column) -> Column:
    """The segments of a path, what is beyond ``DEPTH`` as one; of an empty path none."""
    every = F.split(F.regexp_replace(path, "^/", ""), "/", DEPTH + 1)
    return F.when(path == "", F.array().cast("array<string>")).otherwise(every)


def _kind_at(segments: Column, depth: int) -> Column:
    """The kind of the segment at a depth: of none ``$``, of what is too deep ``**``."""
    segment = F.get(segments, F.lit(depth))
    if depth == DEPTH:
        return F.when(segment.isNull(), "$").otherwise("**")
    return F.when(segment.isNull(), "$").otherwise(kind(segment))


def distance(a: dict, b: dict) -> float:
    """Jensen-Shannon distance of two tables of counts, in bits."""
    sums, out = (sum(a.values()), sum(b.values())), 0.0
    for key in a.keys() | b.keys():
        p, q = a.get(key, 0) / sums[0], b.get(key, 0) / sums[1]
        middle = (p + q) / 2
        out += sum(x * math.log2(x / middle) / 2 for x in (p, q) if x)
    return out


def merged(branches: list[tuple[str, dict]]) -> list[list[str]]:
    """Groups of branches (segment and profile) that look alike: each, the largest first, goes to the first group whose profile, taken
    together, is near."""
    groups: list[tuple[list[str], dict]] = []
    for segment, profile in sorted(branches, key=lambda b: (-sum(b[1].values()), b[0])):
        for names, pooled in groups:
            if distance(pooled, profile) <= DISTANCE:
                names.append(segment)
                for key, n in profile.items():
                    pooled[key] = pooled.get(key, 0) + n
                break
        else:
            groups.append(([segment], dict(profile)))
    return [sorted(names) for names, _ in groups]


def _children(rows: DataFrame, depth: int) -> DataFrame:
    """``node, segment, child`` of the segments that stay below the nodes of a depth."""
    follows = F.struct(_kind_at(F.col("segments"), depth + 1).alias("kind"), F.coalesce("label", F.lit(-1)).alias("label"))
    counts = rows.groupBy("node", "segment", follows.alias("follows")).agg(F.count(F.lit(1)).alias("n"))
    branches = counts.groupBy("node", "segment").agg(F.sum("n").alias("n"), F.collect_list(F.struct("follows", "n")).alias("profile"))
    branches = stored(branches, "branches")
    totals = branches.groupBy("node").agg(F.sum("n").alias("total"))
    kept = branches.filter(F.col("n") >= SUPPORT).join(totals, "node").filter(F.col("n") >= SHARE * F.col("total"))
    # at most one in SHARE of a node
    nodes = kept.groupBy("node").agg(F.collect_list(F.struct("segment", "profile")).alias("branches"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str, str]] = []
            for node, branches in zip(batch.column("node").to_pylist(), batch.column("branches").to_pylist()):
                profiles = [
                    (b["segment"], {(p["follows"]["kind"], p["follows"]["label"]): p["n"] for p in b["profile"]}) for b in branches
                ]
                out += [(node, name, f"{node}/{'|'.join(names)}") for names in merged(profiles) for name in names]
            yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in out], pa.string()) for i in range(3)], names=["node", "segment", "child"])

    return nodes.mapInArrow(run, "node string, segment string, child string")


def templates(urls: DataFrame) -> DataFrame:
    """``urls`` (``host, path, label`` and others; ``label`` 1 if blocked, 0 if allowed, else null) with ``template``, stored."""
    kept = urls.columns
    rows = urls.withColumn("template", F.col("host"))
    for depth in range(DEPTH):
        at = rows.select("*", _segments(F.col("path")).alias("segments"), F.col("template").alias("node"))
        at = at.withColumn("segment", F.get("segments", F.lit(depth)))
        found = _children(at.filter("segment IS NOT NULL"), depth)
        wild = F.concat("node", F.lit("/"), kind(F.col("segment")))
        child = F.when(F.col("segment").isNull(), F.col("node")).otherwise(F.coalesce("child", wild))
        if depth == DEPTH - 1:
            child = F.when(F.get("segments", F.lit(DEPTH)).isNull(), child).otherwise(F.concat(child, F.lit("/**")))
        rows = stored(at.join(found, ["node", "segment"], "left").select(*kept, child.alias("template")), "templates")
    return rows


def purities(rows: DataFrame) -> DataFrame:
    """``template, labelled, purity``: labelled pages of each template, and the smoothed share of blocked ones."""
    counts = rows.groupBy("host", "template").agg(F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))
    counts = stored(counts, "labelled")
    hosts = counts.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("blocked").alias("host_blocked"))
    every = counts.agg(F.sum("labelled"), F.sum("blocked")).first()
    prior = every[1] / every[0] if every[0] else 0.0

    def smoothed(blocked: str, labelled: str, towards: Column) -> Column:
        return (F.col(blocked) + SMOOTHING * towards) / (F.col(labelled) + SMOOTHING)

    share = smoothed("blocked", "labelled", smoothed("host_blocked", "host_labelled", F.lit(prior)))
    return counts.join(hosts, "host").select("template", "labelled", share.alias("purity"))


def judged(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, labelled, purity`` of every row of ``pages``.

    The rules' verdicts are the labels the templates are judged by. A page without a rule is blocked if its template is rejected, and a
    template without labelled pages never is. A url that is null or no url has an empty host and path, and a template of its
    own; long urls are read whole, of their path the segments beyond ``DEPTH`` count as one; rows that repeat are judged each; other columns are
    ignored; an empty table gives no rows.
    """
    host, path = host_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matched(rules, F.col("host"), F.col("path"))
    urls = urls.select("*", rule.alias("rule"), verdict.alias("given"))
    label = F.when(F.col("given") == "block", 1).when(F.col("given") == "allow", 0)
    rows = templates(urls.withColumn("label", label))
    found = rows.join(purities(rows), "template")
    rejected = (F.col("labelled") > 0) & (F.col("purity") >= REJECTED)
    verdict = F.coalesce("given", F.when(rejected, "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "labelled", "purity")
