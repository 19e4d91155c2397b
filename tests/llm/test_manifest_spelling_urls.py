"""The manifest, spelling variants and URL filters against plain reference versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from keyfold.llm import merkle, spelling, url_filters
from keyfold.llm.queries import URL_RULES
from tests.llm.tables import SCHEMA, counted, messy, messy_rows, written

# --- manifest


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def entry(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    out = []
    for nodes in levels[:-1]:
        start = at // 16 * 16
        out.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + 16])))
        at //= 16
    return out


def led(leaf: str, way: list[tuple[str, str]]) -> str:
    for left, right in way:
        leaf = digest(left + leaf + right)
    return leaf


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    by_source = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        head = "".join(map(entry, (doc_id, source, lang, n_chars)))
        lowered = text
        if text is not None and zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0:
            lowered = text.encode().lower().decode()
        by_source[source].append((doc_id, digest(head + entry(text)), digest(head + entry(lowered))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by_source[source].sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        trees[source] = tree([r[1] for r in by_source[source]])
    top = tree([trees[s][-1][0] for s in order])
    root = top[-1][0] if order else None
    out = []
    for number, source in enumerate(order):
        for at, (doc_id, leaf, claim) in enumerate(by_source[source]):
            way = path(trees[source], at) + path(top, number)
            end = led(claim, way)
            out.append((doc_id, leaf, trees[source][-1][0], root, digest("".join(a + b for a, b in way)), end, end == root))
    return out


def test_manifest(spark):
    rows = messy_rows()
    rows += [(1000 + i, f"Text {i}", None, "many" if i % 7 else "s1", i) for i in range(300)]
    rows += [(9, "One", "en", s, 1) for s in ("", "ä", "z", "\U0001f600", "Z")]
    assert counted(merkle.document_manifest(messy(spark, rows=rows)).collect()) == counted(plain_manifest(rows))
    alone = [(7, "A", None, None, None)]
    assert counted(merkle.document_manifest(messy(spark, rows=alone)).collect()) == counted(plain_manifest(alone))
    assert merkle.document_manifest(messy(spark, rows=[])).collect() == []


@pytest.mark.parametrize("sizes", [(1,), (5, 11, 0, 240), (300, 4000, 20)])
def test_witnesses_grow_with_appends(spark, tmp_path, sizes):
    """Blocks of one level, so that few leaves make many heights; the folder is opened anew for each append."""
    leaves = {"a": [], "b": []}
    for size in sizes:
        batch = []
        for name, share in (("a", size), ("b", size // 3)):
            for _ in range(share):
                batch.append((name, len(leaves[name]), digest(f"{name}{len(leaves[name])}")))
                leaves[name].append(batch[-1][2])
        frame = spark.createDataFrame(batch, "tree string, at bigint, digest string")
        merkle.Manifest(spark, str(tmp_path / "m"), levels=1).append(frame)
        manifest = merkle.Manifest(spark, str(tmp_path / "m"), levels=1)
        assert {r.tree: r.size for r in manifest.sizes().collect()} == {k: len(v) for k, v in leaves.items() if v}
        sealed = manifest.sealed()
        want = {(k, tree(v)[-1][0]) for k, v in leaves.items() if v}
        assert {tuple(r) for r in sealed.roots.collect()} == want
    paths = {(r.tree, r.at): r.path for r in sealed.paths().collect()}
    for name, nodes in leaves.items():
        levels = tree(nodes) if nodes else []
        for at in range(0, len(nodes), 1 + len(nodes) // 60):
            assert paths[name, at] == "".join(f"{a},{b};" for a, b in path(levels, at))
    assert len(paths) == sum(map(len, leaves.values()))


def test_full_blocks_are_written_once(spark, tmp_path):
    manifest = merkle.Manifest(spark, str(tmp_path / "m"), levels=1)
    for number in range(4):
        batch = [("a", number * 100 + i, digest(f"{number} {i}")) for i in range(100)]
        manifest.append(spark.createDataFrame(batch, "tree string, at bigint, digest string"))
    full = manifest._full(0)
    assert full.count() == full.select("block").distinct().count() == 25
    parts = spark.read.parquet(*manifest.extensions[1])
    assert parts.count() == parts.select("at").distinct().count() == 16


def test_a_failed_append_leaves_no_trace(spark, tmp_path):
    manifest = merkle.Manifest(spark, str(tmp_path / "m"), levels=1)
    manifest.append(spark.createDataFrame([("a", i, digest(str(i))) for i in range(20)], "tree string, at bigint, digest string"))
    more = spark.createDataFrame([("a", 20, digest("20"))], "tree string, at bigint, digest string")
    with pytest.raises(Exception):
        manifest.append(more.withColumn("digest", F.raise_error(F.lit("lost"))))
    for again in (manifest, merkle.Manifest(spark, str(tmp_path / "m"), levels=1)):
        assert again.sealed().roots.first()["subroot"] == tree([digest(str(i)) for i in range(20)])[-1][0]


# --- spelling variants


def plain_variants(rows: list[tuple]) -> set[tuple]:
    counts = Counter()
    for doc_id, text, *_ in rows:
        for word in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = defaultdict(set)
    by_size = defaultdict(list)
    for word in counts:
        by_size[len(word)].append(word)
    for word in counts:
        for other in by_size[len(word)]:
            if sum(a != b for a, b in zip(word, other)) == 1:
                near[word].add(other)
        for other in by_size[len(word) - 1]:
            first = next((i for i, (a, b) in enumerate(zip(word, other)) if a != b), len(other))
            if word[first + 1 :] == other[first:]:
                near[word].add(other)
                near[other].add(word)
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda w: (-counts[w], w)) if others else None
        if best and counts[best] >= 10 * counts[word]:
            forms[word] = best

    def root(word):
        while word in forms:
            word = forms[word]
        return word

    return {(w, forms.get(w), root(w), n, len(near[w]), counts.get(forms.get(w))) for w, n in counts.items()}


def variant_rows() -> list[tuple]:
    rng = random.Random(5)
    rows = messy_rows()
    words = ["spelling", "spellings", "speling", "spellingg", "sspelling", "aabbaabb", "aabbaab", "aabbaabba", "Überraschung", "überraschung"]
    words += ["".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(250)]
    words += ["".join(rng.choice("abçÿ") for _ in range(8)) for _ in range(150)]
    long = "".join(rng.choice("abcdefgh") for _ in range(6000))
    words += [long, long[:5990] + long[5991:], long[:10] + "x" + long[11:], long + "y"]
    text = " ".join(w + " " + w.upper() if rng.random() < 0.3 else f"{w},{w}" for w in words)
    often = "spelling " * 300 + "spelings " * 3
    rows += [(2000 + i, f"{text} {often}", None, None, None) for i in range(3)]
    rows.append((2990, "chainword " * 400 + "chainwork " * 35 + "chaimwork " * 3, None, None, None))
    rows += [(3000 + i, "abbababb " * 12**i + "abbababa " * 2, None, None, None) for i in range(3)]
    return rows


def test_spelling_variants(spark):
    rows = variant_rows()
    got = [tuple(r) for r in spelling.variant_groups(messy(spark, rows=rows)).collect()]
    want = plain_variants(rows)
    assert len(got) == len(set(got)) == len(want)
    assert set(got) == want
    assert any(form and root != form for _, form, root, *_ in want)
    assert spelling.variant_groups(messy(spark, rows=[])).collect() == []


def test_edges_hold_unbranched_paths_whole(spark):
    """Two words of 3,000 letters that differ at the end take as many rounds as two short ones."""
    long = "x" * 3000
    words = spark.createDataFrame([(0, long, 5), (1, long[:-1] + "y", 2), (2, "x" * 2999 + "yz", 2)], "id bigint, word string, n bigint")
    edges, _ = spelling.trie(words)
    assert edges.agg(F.max("level")).first()[0] <= 3
    found = {tuple(sorted((r.word, r.other))) for r in spelling.neighbours(words).collect()}
    assert found == {(long, long[:-1] + "y"), (long[:-1] + "y", "x" * 2999 + "yz")}


# --- URL filters


def plain_host_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match("[^?#]*", rest[len(host) :])[0]


def plain_rule(host: str, path_: str) -> tuple[str | None, str | None]:
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path_.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (None, None) if best is None else (best.host + best.path, best.verdict)


def plain_kind(segment: str) -> str:
    extension = re.search(r"\.([A-Za-z]{2,5})\Z", segment)
    extension = extension[0] if extension else ""
    name = segment[: len(segment) - len(extension)]
    if name == "":
        of = ""
    elif re.fullmatch("[0-9]+", name):
        of = "{number}"
    elif re.fullmatch("[0-9a-fA-F]{8,}|[0-9a-fA-F-]{36}", name):
        of = "{id}"
    elif name.isalpha():
        of = "{word}"
    elif re.fullmatch(r"[^\W_]+([-_+.][^\W_]+)+", name):
        of = "{slug}"
    else:
        of = "{any}"
    return of + extension.lower()


def plain_judged(rows: list[tuple]) -> list[tuple]:
    """Page by page and node by node, in dictionaries."""
    depth_limit = url_filters.DEPTH
    pages = []
    for page_id, url in rows:
        host, path_ = plain_host_path(url)
        rule, given = plain_rule(host, path_)
        every = [] if path_ == "" else path_.removeprefix("/").split("/", depth_limit)
        pages.append({"id": page_id, "host": host, "path": path_, "rule": rule, "given": given, "segments": every, "node": host})
    label = {"block": 1, "allow": 0, None: -1}
    for depth in range(depth_limit):
        branches, totals = defaultdict(Counter), Counter()
        for p in pages:
            if depth < len(p["segments"]):
                if depth + 1 >= len(p["segments"]):
                    follows = "$"
                else:
                    follows = "**" if depth + 1 == depth_limit else plain_kind(p["segments"][depth + 1])
                branches[p["node"], p["segments"][depth]][follows, label[p["given"]]] += 1
                totals[p["node"]] += 1
        kept = defaultdict(list)
        for (node, segment), profile in branches.items():
            n = sum(profile.values())
            if n >= url_filters.SUPPORT and n >= url_filters.SHARE * totals[node]:
                kept[node].append((segment, dict(profile)))
        child = {}
        for node, some in kept.items():
            for names in url_filters.merged(some):
                child.update({(node, name): f"{node}/{'|'.join(names)}" for name in names})
        for p in pages:
            if depth < len(p["segments"]):
                segment = p["segments"][depth]
                p["node"] = child.get((p["node"], segment), f"{p['node']}/{plain_kind(segment)}")
                if depth == depth_limit - 1 and len(p["segments"]) > depth_limit:
                    p["node"] += "/**"
    by_host, by_template, every = defaultdict(list), defaultdict(list), []
    for p in pages:
        if p["given"]:
            for some in (by_host[p["host"]], by_template[p["node"]], every):
                some.append(label[p["given"]])
    prior = sum(every) / len(every) if every else 0.0
    out = []
    for p in pages:
        own, host = by_template[p["node"]], by_host[p["host"]]
        towards = (sum(host) + 4 * prior) / (len(host) + 4)
        purity = (sum(own) + 4 * towards) / (len(own) + 4)
        verdict = p["given"] or ("block" if own and purity >= 0.5 else "allow")
        out.append((p["id"], p["host"], p["path"], p["rule"], verdict, p["node"], len(own), round(purity, 9)))
    return out


def url_rows() -> list[tuple]:
    rng = random.Random(3)
    odd = [
        None,
        "",
        "no url",
        "://",
        "http://",
        "http://COM",
        "http://com/",
        "HTTP://WWW.Example.COM/en/1?x=/de/#y",
        "http://example.com/EN/1",
        "http://notexample.com/en/1",
        "http://a.example.com/en",
        "x://y://z/a",
        "http://h.net/es/1",
        "http://h.net/es",
        "http://h.net?/es/1",
        "http://h.net#/es/1",
        "http://ä.net/fr/\u00e9t\u00e9/a\nb",
        "http://h.org//a//b/c/d/e/f",
        "http://h.org/" + "x/" * 4000,
        "http://h.org/" + "9" * 9000 + ".HTML",
    ]
    for _ in range(1500):
        host = rng.choice(("a.net", "a.net", "a.net", "b.net", "www.example.com", "m.example.com", "c.org"))
        lang = rng.choice(("en", "en", "es", "fr", "de"))
        tail = rng.choice((f"{rng.randrange(9999)}", f"{rng.randrange(9999)}.html", f"{rng.randrange(99)}/", f"a-{rng.randrange(9)}/b/{rng.randrange(99)}/c/d"))
        odd.append(f"https://{host}/{lang}/{tail}")
    odd += [f"http://mix.net/{a}/{i}" for i in range(60) for a in ("es", "ES", "x")]
    rows = [(i, u) for i, u in enumerate(odd)]
    return rows + [rows[3], rows[40], (None, odd[41]), (None, None)]


def pages_frame(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string").repartition(3)
    names = ("host", "path", "rule", "verdict", "template", "node", "segment", "label", "html")
    return pages.select("*", *(F.lit(f"own {c}").alias(c) for c in names))


def test_urls(spark):
    rows = url_rows()
    got = url_filters.judged(pages_frame(spark, rows), URL_RULES).withColumn("purity", F.round("purity", 9))
    assert counted(got.collect()) == counted(plain_judged(rows))
    assert url_filters.judged(pages_frame(spark, []), URL_RULES).collect() == []


def test_templates_learn_from_labels(spark):
    """Pages that the rules leave out go by the pages of their template that the rules know."""
    rules = [url_filters.Rule("block", "h.org", f"/shop/{i}") for i in range(1, 10)]
    rows = [(i, f"http://h.org/shop/{i}") for i in range(100)] + [(1000 + i, f"http://h.org/news/{i}") for i in range(100)]
    got = {r.page_id: r for r in url_filters.judged(pages_frame(spark, rows), rules).collect()}
    assert got[0].template == "h.org/shop/{number}" and got[0].rule is None and got[0].verdict == "block"
    assert got[1005].template == "h.org/news/{number}" and got[1005].verdict == "allow"


def test_like_branches_are_merged():
    a, b, c = {("{number}", -1): 50}, {("{number}", -1): 30}, {("{number}", 1): 40}
    assert url_filters.merged([("en", a), ("de", b), ("es", c)]) == [["de", "en"], ["es"]]
    assert url_filters.distance(a, a) == 0 and url_filters.distance(a, c) == 1


def test_rules_of_equal_length():
    rules = [url_filters.Rule("allow", "a.b", "/"), url_filters.Rule("block", "a.b", "/")]
    assert "block" in str(url_filters.matched(rules, F.lit("a.b"), F.lit("/x"))[1])


def test_tables_of_other_schemas(spark, tmp_path):
    docs = written(messy(spark, clash=False, rows=[(1, "wonderful wonderful", None, None, None)] * 2).select("doc_id", "text"), tmp_path / "d")
    assert [r.word for r in spelling.variant_groups(docs).collect()] == ["wonderful"]
    assert SCHEMA.startswith("doc_id")
