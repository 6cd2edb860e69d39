"""URL filters, manifest and vector codes on small tables against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from dosegrid.llm import codes, common, manifest, registry, reputation

R = random.Random(5)
TEXT = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, name, rows, schema, parts=3):
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(f"{folder}/{name}.parquet")


# --- url filters -------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "https://Example.COM/en/a?q=1#f", "http://www.example.com/en/x", "http://a.www.example.com/en/", "http://example.com", "http://example.com?x=/en/"]
URLS += ["ftp://shop.NET/es/1", "http://net/es/", "http://x.net/fr/#a", "http://notnet/fr/", "http://x.net/FR/", "http://u@bad.co.uk:80/p://q", "http://10.0.0.1/z", "a://b://c/d", "http://é.example.org/ü?", "http://x.com/a\nb?c", "://h/p"]
URLS += [f"http://{h}.example.org/p{k}" for h in ("good", "bad", "rare") for k in range({"good": 60, "bad": 60, "rare": 2}[h])]
PAGES = [*enumerate(URLS), (None, "http://bad.example.org/x"), (30, "http://good.example.org/again"), (30, "http://good.example.org/again")]
LABELS = [(k, 0 if "bad" in (u or "") else 1, 0) for k, u in enumerate(URLS) if k % 4] + [(5, None, None), (5, 0, 0), (None, 0, 1), (30, None, 1), (31, 0, None), (31, 1, 0)]


def brute_urls(pages, labels):
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        tail = rest[cut:]
        end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]

    def names(host):
        bare = host.rsplit("@", 1)[-1].split(":")[0]
        p = bare.split(".")
        if len(p) == 4 and all(x.isdigit() for x in p):
            return bare, bare
        n = 2 if ".".join(p[-2:]) in reputation.SUFFIXES else 1
        return ".".join(p[-n - 1 :]), ".".join(p[-n:])

    outcome = {}
    for k, q, t in labels:
        bad = True if q == 0 or t == 1 else None if q is None or t is None else False
        if k is not None and bad is not None:
            outcome.setdefault(k, []).append(bad)
    hosts = {}
    for k, u in pages:
        hosts.setdefault(parts(u)[0], []).extend(outcome.get(k, []) if k is not None else [])

    def level(groups, above):
        """groups: name -> outcomes; above: name -> mean of the level above."""
        seen = {g: v for g, v in groups.items() if v}
        spread = sum(len(v) * (sum(v) / len(v) - above[g]) ** 2 / (above[g] * (1 - above[g])) for g, v in seen.items()) - len(seen)
        free = sum(len(v) - 1 for v in seen.values())
        weight = reputation.WEIGHTS[1] if not free or spread <= 0 else min(max(free / spread - 1, reputation.WEIGHTS[0]), reputation.WEIGHTS[1])
        return {g: (sum(v) + weight * above[g]) / (len(v) + weight) for g, v in groups.items()}, weight

    every = [b for v in hosts.values() for b in v]
    root = (sum(every) + 0.5) / (len(every) + 1)
    merged = lambda name: {n: [b for h, v in hosts.items() if name(h) == n for b in v] for n in {name(h) for h in hosts}}
    suffix, _ = level(merged(lambda h: names(h)[1]), dict.fromkeys({names(h)[1] for h in hosts}, root))
    domain, _ = level(merged(lambda h: names(h)[0]), {names(h)[0]: suffix[names(h)[1]] for h in hosts})
    mean, weight = level(hosts, {h: domain[names(h)[0]] for h in hosts})
    out = []
    for k, u in pages:
        host, path = parts(u)
        fits = [r for r in reputation.RULES for n, p in [r.text.split("/", 1)] if (host == n or host.endswith("." + n)) and path.startswith("/" + p)]
        rule = max(fits, key=lambda r: len(r.text), default=None)
        n, m, z = len(hosts[host]) + weight, mean[host], reputation.DEVIATIONS
        bound = (m + z * z / (2 * n) - z * math.sqrt(m * (1 - m) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        verdict = rule.verdict if rule else "block" if bound > reputation.TOLERATED else "allow"
        out.append((k, host, path, rule.text if rule else None, verdict, round(m, 6)))
    return Counter(out)


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages"))
    write(spark, folder, "pages", [(k, u, "h", 1) for k, u in PAGES], "page_id long, url string, host string, mean int")
    write(spark, folder, "labels", LABELS, "doc_id long, quality int, toxic int")
    return folder


@pytest.mark.parametrize("share", [1, 512])
def test_urls_equal_brute_force(spark, pages, monkeypatch, share):
    monkeypatch.setattr(common, "HOT_SHARE", share)  # 1: no group is hot
    rows = registry.QUERIES["op11_url_reputation"](spark, pages).collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], r["bad_share"]) for r in rows) == brute_urls(PAGES, LABELS)
    verdicts = {r["host"]: r["verdict"] for r in rows if r["rule"] is None}
    assert verdicts["bad.example.org"] == "block" and verdicts["good.example.org"] == verdicts["rare.example.org"] == "allow"


def test_urls_without_outcomes_or_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    rows = reputation.filtered(pages, none).collect()
    assert len(rows) == len(PAGES) and all(r["verdict"] == "allow" for r in rows if r["rule"] is None)
    assert reputation.filtered(pages.limit(0), none).count() == 0


def test_urls_need_no_python(spark, pages):
    plan = registry.QUERIES["op11_url_reputation"](spark, pages)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "MapInArrow"))


# --- manifest ----------------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(r):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])))

    def lower(t):
        return t if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    def climb(nodes):
        """The top, and for each node its runs of (before, after) up to it."""
        paths = [[] for _ in nodes]
        under = [[k] for k in range(len(nodes))]
        while len(nodes) > 1:
            up, over = [], []
            for i in range(0, len(nodes), 8):
                run = nodes[i : i + 8]
                for j in range(len(run)):
                    for k in under[i + j]:
                        paths[k].append((run[:j], run[j + 1 :]))
                up.append(H(*run))
                over.append([k for u in under[i : i + 8] for k in u])
            nodes, under = up, over
        return nodes[0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    tops, found = [], []
    for lang in langs:
        mine = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        top, paths = climb([leaf(r) for r in mine])
        tops.append(top)
        found.append((mine, paths))
    root, over = climb(tops) if tops else (None, [])
    out = []
    for (mine, paths), top, up in zip(found, tops, over, strict=True):
        for r, path in zip(mine, paths, strict=True):
            whole = path + up
            key = b"" if r["doc_id"] is None else str(r["doc_id"]).encode()
            at = leaf({**r, "text": lower(r["text"])}) if zlib.crc32(key) % 3 == 0 else leaf(r)
            for before, after in whole:
                at = H(*before, at, *after)
            out.append((r["doc_id"], leaf(r), top, root, H(*(d for b, a in whole for d in b + a)), at, at == root))
    return Counter(out)


def docs_of(n, langs):
    rows = [dict(doc_id=k * 3, text=R.choice([None, "", "Ab é\n", "lower", f"T{k}"]), lang=R.choice(langs), source=R.choice(["s", None, ""]), n_chars=R.choice([None, k])) for k in range(n)]
    return rows + [dict(rows[0]), dict(rows[0], text="Other"), dict(rows[1], doc_id=None), dict(rows[2], doc_id=None, text="Z")] if n > 3 else rows


@pytest.mark.parametrize("n, langs", [(0, [None]), (1, ["en"]), (3, ["en"]), (8, ["en"]), (90, ["en"]), (700, ["en", "en", "en", "de", None, ""]), (60, [*"abcdefghijk", None, "Z", "é"])])
def test_manifest_equals_brute_force(spark, tmp_path, n, langs):
    rows = docs_of(n, langs)
    folder = str(tmp_path)
    write(spark, folder, "documents", [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", 1) for r in rows], TEXT + ", digest string, lo int")
    found = registry.QUERIES["op12_merkle_manifest"](spark, folder).collect()
    assert Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in found) == brute_manifest(rows)
    assert n < 90 or {r["verified"] for r in found} == {True, False}


def test_nodes_are_nested_intervals(spark):
    made = spark.range(100).selectExpr("'' as grp", "id as key", "sha2(cast(id as string), 256) as digest", "id as carried")
    with common.Scratch(spark, "nested") as scratch:
        tree = manifest.tree_of(scratch, manifest.leaves_of(made, ["key"]), "t")
        spans = [sorted((r["lo"], r["hi"]) for r in level.collect()) for level in tree.levels]
    assert [len(s) for s in spans] == [13, 2, 1] and all(s[0][0] == 0 and s[-1][1] == 100 and all(a[1] == b[0] for a, b in zip(s, s[1:], strict=False)) for s in spans)


# --- vector codes ------------------------------------------------------------------------


def brute_codes(rows, parts=codes.PARTS, entries=codes.ENTRIES):
    good = [(k, [math.floor(4096 * np.float32(x).astype(float)) for x in v], lab) for k, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and v and len(v) % parts == 0]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    size = len(good[0][1]) // parts
    cut = [[tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for _, v, _ in good]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    near = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(codes.ROUNDS):
        for p in range(parts):
            mine = {}
            for c in cut:
                mine.setdefault(near(p, c[p])[1], []).append(c[p])
            for k, v in mine.items():
                books[p][k] = tuple(sum(x) // len(v) for x in zip(*v, strict=True))
    ends = [[near(p, c[p]) for p in range(parts)] for c in cut]
    by_label = Counter()
    for (_, _, lab), e in zip(good, ends, strict=True):
        by_label[lab] += sum(d for d, _ in e)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((k, "".join(f"{i:02x}" for _, i in e), sum(d for d, _ in e), by_label[lab], sha) for (k, _, lab), e in zip(good, ends, strict=True))


def vectors(n, dim, spread):
    rows = [(k, [R.choice([-1, 1]) * R.random() * spread for _ in range(dim)], R.choice([None, 1, 1, 1, 2])) for k in range(n)]
    rows += [(7, rows[7][1], 2), (7, rows[3][1], None), (None, rows[5][1], 1), (1000, None, 1), (1001, [None] + rows[0][1][1:], 1), (1002, [float("nan")] * dim, 1), (1003, [float("inf")] + rows[0][1][1:], 2)]
    rows += [(-5, None, 1), (1004, [], 1), (1005, [0.5] * (dim + 8), 1), (1006, [0.5] * 7, 1), *((2000 + k, [0.25] * dim, 3) for k in range(40))]
    return rows


@pytest.mark.parametrize("n, dim, spread", [(300, 64, 0.4), (12, 16, 0.001), (60, 8, 100.0)])
def test_codes_equal_brute_force(spark, tmp_path, n, dim, spread):
    rows = vectors(n, dim, spread)
    R.shuffle(rows)
    write(spark, str(tmp_path), "embeddings", [(k, v, lab, "x") for k, v, lab in rows], "vec_id long, embedding array<float>, label int, key string")
    found = registry.QUERIES["op13_vector_codes"](spark, str(tmp_path)).collect()
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in found) == brute_codes(rows)


def test_codes_of_few_or_no_vectors(spark, tmp_path):
    few = [(k, [float(k)] * 8, None) for k in range(3)]
    write(spark, str(tmp_path / "a"), "embeddings", few, "vec_id long, embedding array<float>, label int")
    found = registry.QUERIES["op13_vector_codes"](spark, str(tmp_path / "a")).collect()
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in found) == brute_codes(few)
    write(spark, str(tmp_path / "b"), "embeddings", [(1, None, 1)], "vec_id long, embedding array<float>, label int")
    assert registry.QUERIES["op13_vector_codes"](spark, str(tmp_path / "b")).collect() == []


def test_two_trees_assign_as_all_distances_do():
    rng = np.random.default_rng(3)
    for turn in range(60):
        n, d, m, scale = rng.integers(1, 200), rng.integers(1, 9), rng.integers(1, 17), rng.choice([2, 10, 1000])
        points, entries = rng.integers(-scale, scale, (n, d)), rng.integers(-scale, scale, (m, d))
        if turn % 3 == 0:  # many equal points and entries
            points, entries = points[rng.integers(0, n, n)], points[rng.integers(0, n, m)]
        points = points[codes.tree_order(points)]
        counts, sums, chosen = codes.assign(points, codes.Tree(points, codes.LEAF), entries, labels=True)
        wanted = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
        assert (chosen == wanted).all() and (counts == np.bincount(wanted, minlength=m)).all()
        assert all((sums[e] == points[wanted == e].sum(0)).all() for e in range(m))
