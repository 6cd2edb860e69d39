"""N-gram Jaccard join by chosen paths.

A text's set is that of its WORDS-word shingles (a shorter text is one shingle; texts
without words have no set and no links). Texts with equal sets are one class, kept
once with its number of members. Each class's set is embedded as T values, the
minimum of the set under each of T hash functions: two sets agree in a place with
probability equal to their Jaccard similarity.

A run splits all classes at places chosen at random with probability 1 / (0.8 T), by
the value there; a bucket that is not small is split again, at places chosen by a hash
of its path. Small buckets are compared pair by pair in their embeddings. Before a
large bucket is split, blocks of it are reduced to leaders: a class that is clearly
similar to an earlier one of its block is linked to it and leaves. So a bucket shrinks
whether its sets are alike or not. Of a pair at the threshold about one path goes on
at each split, so the deeper the splits, the more pairs lose all paths: RUNS runs are
the least, and runs with fresh places are added until there are as many as the deepest
split asks for. Then recall is measured: of about QUERIES classes drawn by hash, all
classes with embeddings alike in PROBE places are counted, and runs go on until TARGET
of these pairs are in one cluster; pairs of the drawn classes are added as they are.

Candidate links join classes to clusters. A cluster of more than a block may hold texts
that are alike but not similar, as pages of one template: it is taken apart first, by the
shingles that its classes have. Two similar sets share one of the first n - ceil(0.8 n) + 1
shingles of each in order of rarity within the cluster, so classes that share no such
shingle with any other leave, and the others form the parts that such shingles connect.
Then the exact similarity of every pair in a part is counted from the whole sets, part by
part or, for large ones, by pairs of blocks. Nothing is capped, and no similar pair is lost.

Null texts have no words. Repeated rows are members of one class and linked to each
other. Null ids are kept; a class's id is the smallest id among its documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common
from dosegrid.llm.components import components

WORDS, THRESHOLD = 5, 0.8
T, RUNS, SMALL = 64, 16, 512
#: Rows of a small bucket that are compared with all of it at once.
ROWS = 128
#: Rows of a block in which a large bucket is reduced to leaders.
BUCKET_BLOCK = 128
#: Share of pairs to be found, runs added when fewer are, classes drawn to measure it, and places in which their pairs agree (98% of pairs at the threshold do).
TARGET, MORE, QUERIES, PROBE = 0.99, 6, 512, 45
#: Places that two embeddings must agree in to be candidates: far below what similar sets have.
AGREE = 32
#: Classes, and shingles, that a verifying task holds of one block.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: Shingles of a batch that goes back to Spark.
ROWS_OUT = 100_000
_SEEDS = common.mix(np.arange(1, T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within rows, and how many each row has."""
    starts, ends, counts = common.word_spans(data, offsets)
    hashes, sizes = common.shingle_hashes(common.span_hashes(data, starts, ends), counts, WORDS)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes, owner))
    hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(sizes))


def class_keys(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """16 bytes for each row that stand for its set."""
    total = np.zeros((2, len(hashes) + 1), np.uint64)
    for k in range(2):
        np.cumsum(common.mix(hashes ^ _SEEDS[k]), out=total[k, 1:])
    end = np.cumsum(sizes)
    return np.ascontiguousarray((total[:, end] - total[:, end - sizes]).T)


def embeddings(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """T values of 32 bits for each row with a set."""
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), T), np.uint32)
    if len(full):
        first = (np.cumsum(sizes) - sizes)[full]
        for k in range(T):
            low = np.minimum.reduceat((hashes ^ _SEEDS[k]) * _SEEDS[T - 1 - k] >> np.uint64(20), first)
            out[full, k] = (low ^ (low >> np.uint64(22))).astype(np.uint32)
    return out


def tag_of(text: Column) -> Column:
    """A number of the text, which tells rows with one id, or none, apart."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def described(df: DataFrame, text: str, key: str) -> DataFrame:
    """(doc_id, tag, class, n, places) of each row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in common.steps(batch.column(1)):
                hashes, sizes = shingle_sets(data, offsets)
                keys = [k.tobytes() for k in class_keys(hashes, sizes)]
                places = [p.tobytes() for p in embeddings(hashes, sizes)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), batch.column(2).slice(row, end - row), pa.array(keys, pa.binary()), pa.array(sizes), pa.array(places, pa.binary())], names=["doc_id", "tag", "class", "n", "places"])

    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), tag_of(F.col(text)).alias("tag"))
    return common.in_arrow(rows, describe, f"doc_id {df.schema[key].dataType.simpleString()}, tag bigint, class binary, n bigint, places binary")


def chosen(path: np.ndarray) -> np.ndarray:
    """Places at which a path goes on: a row of T truth values for each path."""
    return common.mix(path[:, None] ^ _SEEDS[None]) < np.uint64(int(2**64 / (THRESHOLD * T)))


def runs_for(depth: int) -> int:
    """Runs that find TARGET of the pairs at the threshold after so many splits of the first buckets: one path goes on at each, on average."""
    alive = 1.0
    for _ in range(depth + 1):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - TARGET) / math.log(1 - alive))


def root_places(first: int = 0, runs: int = RUNS) -> list[tuple[int, int]]:
    """(run, place) of the first splits of runs from `first`; a run without a place gets one."""
    r = np.random.default_rng(1 + first)
    out = []
    for run in range(first, first + runs):
        places = np.flatnonzero(r.random(T) < 1 / (THRESHOLD * T))
        out += [(run, int(p)) for p in (places if len(places) else [r.integers(T)])]
    return out


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[np.ndarray | list]]:
    """Columns of each run of equal keys in sorted batches of numbers and binaries."""
    held: list[pa.RecordBatch] = []

    def out(parts: list[pa.RecordBatch]) -> list:
        table = pa.Table.from_batches(parts)
        return [c.to_numpy() if pa.types.is_integer(c.type) else c.to_pylist() for c in table.columns]

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(n_keys)])
        cuts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            key = tuple(keys[:, a].tolist())
            if held and key != last:
                yield out(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield out(held)


def agreement(places: np.ndarray, others: np.ndarray) -> np.ndarray:
    return (places[:, None] == others[None]).sum(-1, dtype=np.int16)


def roots_of(linked: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component; linked: a symmetric table of links."""
    root = np.arange(len(linked))
    while True:  # smallest root among neighbours, then the root's root, again and again
        new = np.minimum(root, np.where(linked, root[None], len(root)).min(1, initial=len(root)))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small buckets (path, id, places): each class linked to the first of its component in the bucket, so that there are no more links than classes."""
    a, b = [], []
    for _, ids, places in grouped(batches, 1):
        p = np.frombuffer(b"".join(places), np.uint32).reshape(-1, T)
        alike = np.concatenate([agreement(p[low : low + ROWS], p) >= AGREE for low in range(0, len(p), ROWS)])
        root = roots_of(alike)
        keep = np.flatnonzero(root < np.arange(len(p)))
        a.append(ids[keep])
        b.append(ids[root[keep]])
    none = np.zeros(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *a])), pa.array(np.concatenate([none, *b]))], names=["a", "b"])


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (path, block, id, places): (path, id, leader) of each class, a leader's own leader being itself."""
    for path, _, ids, places in grouped(batches, 2):
        p = np.frombuffer(b"".join(places), np.uint32).reshape(-1, T)
        leader = np.full(len(p), -1, np.int64)
        for k in range(len(p)):
            if leader[k] < 0:
                left = np.flatnonzero(leader < 0)
                leader[left[agreement(p[k : k + 1], p[left])[0] >= AGREE]] = k
                leader[k] = k
        yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(ids), pa.array(ids[leader])], names=["path", "id", "leader"])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, id, places) to (path, id) of the next level."""
    for batch in batches:
        path = batch.column(0).to_numpy().view(np.uint64)
        p = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, T)
        i, place = np.nonzero(chosen(path)) if len(path) else (np.zeros(0, int), np.zeros(0, int))
        new = common.mix(common.mix(path[i] + _SEEDS[place]) ^ p[i, place].astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(new), batch.column(1).take(pa.array(i))], names=["path", "id"])


def candidate_links(classes: DataFrame, first: int = 0, runs: int = RUNS) -> tuple[DataFrame, int]:
    """(a, b): ids of classes (id, places) that one of the runs from `first` has brought together and whose embeddings are alike; and how often buckets were split."""
    places = classes.select("id", "places")
    roots = F.array(*(F.xxhash64(F.lit(run), F.lit(p), F.substring("places", 4 * p + 1, 4)) for run, p in root_places(first, runs)))
    nodes, links, depth = classes.select(F.explode(roots).alias("path"), "id"), [], 0
    with common.Scratch(classes.sparkSession, "paths") as scratch:
        while True:
            nodes = scratch.kept(nodes, "nodes")
            sizes = nodes.groupBy("path").agg(F.count("id").alias("size")).where("size > 1")
            full = scratch.kept(nodes.join(sizes, "path").join(places, "id").select("path", "id", "places", "size"), "buckets")
            small = full.where(F.col("size") <= SMALL).select("path", "id", "places")
            links.append(scratch.kept(common.in_arrow(small.repartition("path").sortWithinPartitions("path", "id"), _compare, "a bigint, b bigint").distinct(), "links"))
            large = full.where(F.col("size") > SMALL)
            if not large.limit(1).count():
                break
            blocks = large.select("path", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BUCKET_BLOCK)).alias("block"), "id", "places")
            led = scratch.kept(common.in_arrow(blocks.repartition("path", "block").sortWithinPartitions("path", "block", "id"), _lead, "path bigint, id bigint, leader bigint"), "led")
            links.append(led.where("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct())
            depth += 1
            nodes = common.in_arrow(led.where("id = leader").select("path", "id").join(places, "id").select("path", "id", "places"), _split, "path bigint, id bigint")
        out = links[0]
        for more in links[1:]:
            out = out.union(more)
        return common.kept(out.distinct(), "links"), depth


def probed(classes: DataFrame) -> DataFrame:
    """(a, b): each of about QUERIES classes drawn by a hash, with every class whose embedding agrees with its own in PROBE places."""
    draw = F.pmod(F.xxhash64("class"), F.lit(max(1, classes.count() // QUERIES)))
    drawn = classes.where(draw == 0).select("id", "places").orderBy(F.xxhash64("class"), "id").limit(2 * QUERIES).collect()
    ids = np.array([r["id"] for r in drawn], np.int64)
    wanted = np.ascontiguousarray(np.frombuffer(b"".join(bytes(r["places"]) for r in drawn), np.uint32).reshape(-1, T).T)
    shared = classes.sparkSession.sparkContext.broadcast((ids, wanted))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted = shared.value
        for batch in batches:
            other = batch.column(0).to_numpy()
            p = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, T)
            for low in range(0, len(p), 512):
                part = p[low : low + 512]
                same = np.zeros((len(part), len(ids)), np.uint8)
                for k in range(T):
                    same += part[:, k, None] == wanted[k]
                i, j = np.nonzero(same >= PROBE)
                keep = other[low + i] != ids[j]
                yield pa.RecordBatch.from_arrays([pa.array(ids[j[keep]]), pa.array(other[low + i[keep]])], names=["a", "b"])

    return common.kept(common.in_arrow(classes.select("id", "places"), probe, "a bigint, b bigint"), "probed")


def clustered(classes: DataFrame) -> tuple[DataFrame, float, int]:
    """(id, root) of all classes with candidates, the share of probed pairs that the runs have put in one cluster, and the number of runs."""
    pairs = probed(classes)
    total = pairs.count()
    links, runs, wanted, deepest = None, 0, RUNS, 0
    while True:
        found, depth = candidate_links(classes, runs, wanted - runs)
        links = found if links is None else common.kept(links.union(found).distinct(), "links")
        runs, deepest = wanted, max(deepest, depth)
        if runs_for(deepest) > runs:
            wanted = runs_for(deepest)
            continue
        clusters = components(links)
        of = lambda k: clusters.select(F.col("id").alias(k), F.col("root").alias(f"root_{k}"))
        met = pairs.join(of("a"), "a").join(of("b"), "b").where("root_a = root_b").count()
        if met >= TARGET * total:
            break
        wanted = runs + MORE
    if met < total:
        clusters = components(links.union(pairs))
    return clusters, met / total if total else 1.0, runs


def taken_apart(scratch: common.Scratch, sets: DataFrame) -> DataFrame:
    """(id, cluster) of the classes (cluster, id, set) that share a rare enough shingle with another of their cluster; cluster: the smallest id of the part."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters = common.mix(batch.column(0).to_numpy().astype(np.uint64))
            for cluster, id_, body in zip(clusters, batch.column(1).to_numpy(), batch.column(2).to_pylist(), strict=True):
                keys = common.mix(np.frombuffer(body, np.uint64) ^ cluster).view(np.int64)
                for low in range(0, len(keys), ROWS_OUT):
                    some = keys[low : low + ROWS_OUT]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), id_)), pa.array(np.full(len(some), len(keys), np.int32)), pa.array(some)], names=["id", "n", "key"])

    rows = scratch.kept(common.in_arrow(sets.select("cluster", "id", "set"), shingles, "id bigint, n int, key bigint"), "shingles")
    shared = scratch.kept(rows.groupBy("key").agg(F.count("*").alias("c"), F.count("*").alias("rows")).where("c > 1"), "shared")
    ranked = common.joined_to_groups(rows, shared, "key", "rows").groupBy("id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("c", "key"))).alias("r"))
    # shingles that no other class has come first, and they connect nothing
    wanted = (F.col("n") - F.ceil(F.col("n") * THRESHOLD - 1e-9) + 1 - (F.col("n") - F.size("r"))).cast("int")
    prefix = scratch.kept(ranked.where(wanted > 0).select("id", F.explode(F.slice("r", F.lit(1), wanted)).alias("s")).select("id", "s.key"), "prefixes")
    heads = scratch.kept(prefix.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("rows")).where("rows > 1"), "heads")
    links = common.joined_to_groups(prefix, heads, "key", "rows").where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    return components(scratch.kept(links, "parts")).withColumnRenamed("root", "cluster")


def pair_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets `left` with the sets `right`."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    seen, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    wide = 4096
    for low in range(0, len(seen), wide):
        a, b = np.searchsorted(column, [low, low + wide])
        part = np.zeros((len(sets), min(wide, len(seen) - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part[left] @ part[right].T
    return out.astype(np.int64)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (cluster, i, j, side, id, members, set) to (id, links, root): links to other classes, by members; root: of id's component in this block."""
    for _, i, j, side, ids, members, bodies in grouped(batches, 3):
        sets = [np.frombuffer(b, np.uint64) for b in bodies]
        size = np.array([len(s) for s in sets])
        whole = i[0] == j[0]
        left = np.arange(len(ids)) if whole else np.flatnonzero(side == 0)
        right = left if whole else np.flatnonzero(side == 1)
        common_ = pair_counts(sets, left, right)
        linked = common_ >= THRESHOLD * (size[left][:, None] + size[right][None] - common_) - 1e-9
        if whole:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(ids), np.int64)
        links[left] += linked @ members[right]
        if not whole:
            links[right] += linked.T @ members[left]
        root = np.arange(len(ids))
        while True:  # smallest root among neighbours, again and again
            new = root.copy()
            a = np.where(linked, root[right][None], len(ids)).min(1, initial=len(ids))
            new[left] = np.minimum(new[left], a)
            b = np.where(linked, new[left][:, None], len(ids)).min(0, initial=len(ids))
            new[right] = np.minimum(new[right], b)
            new = new[new]
            if (new == root).all():
                break
            root = new
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(ids[root])], names=["id", "links", "root"])


def similarity_classes(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, class_id (smallest key among all that are linked with it, over any number of links) and n_links (rows whose similarity with it is THRESHOLD or more)."""
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), tag_of(F.col(text)).alias("tag"))
    rows = common.kept(described(docs, "text", "doc_id"), "described")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("first")
    full = rows.where("n > 0").groupBy("class").agg(first, F.count("*").alias("members"), F.first("places").alias("places"), F.first("n").alias("n")).select("class", "first.doc_id", "first.tag", "members", "places", "n")
    classes = common.kept(full.withColumn("id", F.monotonically_increasing_id()), "classes")
    with common.Scratch(df.sparkSession, "join") as scratch:  # whole sets go when they have been compared
        clusters = clustered(classes)[0].withColumnRenamed("root", "cluster")
        member = scratch.kept(clusters.join(classes.select("id", "class", "doc_id", "tag", "members", "n"), "id"), "clusters")
        blocks = F.greatest(F.ceil(F.count("id") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")

        def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, end, data, offsets in common.steps(batch.column(0)):
                    hashes, n = shingle_sets(data, offsets)
                    keys = [k.tobytes() for k in class_keys(hashes, n)]
                    part = batch.slice(row, end - row)
                    right = np.flatnonzero([a == b for a, b in zip(keys, part.column(1).to_pylist(), strict=True)])
                    bounds = np.concatenate([[0], np.cumsum(n)])
                    bodies = [hashes[bounds[k] : bounds[k + 1]].tobytes() for k in right]
                    yield pa.RecordBatch.from_arrays([*(part.column(k).take(pa.array(right)) for k in (2, 3)), pa.array(bodies, pa.binary())], names=["id", "members", "set"])

        # null keys meet too, those of one text: a class of rows without ids is found by null and tag
        wanted = member.select(F.col("doc_id").alias("_key"), F.col("tag").alias("_tag"), "class", "id", "members")
        found = docs.join(wanted.hint("merge"), docs["doc_id"].eqNullSafe(wanted["_key"]) & (docs["tag"] == wanted["_tag"])).select("text", "class", "id", "members")
        sets = scratch.kept(common.in_arrow(found, with_sets, "id bigint, members bigint, set binary").dropDuplicates(["id"]), "sets")
        sizes = scratch.kept(member.groupBy("cluster").agg(blocks), "sizes")
        large = sizes.where("blocks > 1").select("cluster")
        if large.limit(1).count():
            apart = taken_apart(scratch, sets.join(member.join(large, "cluster", "left_semi").select("id", "cluster"), "id"))
            member = member.select("id", "n", "cluster").join(large, "cluster", "left_anti").unionByName(member.select("id", "n").join(apart, "id"))
            sizes = member.groupBy("cluster").agg(blocks)
        place = member.select("id", "cluster").join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j"), (F.col("block") > k).cast("int").alias("side")))
        spread = sets.join(place.select("id", "cluster", F.explode(meets).alias("m")), "id").select("cluster", F.col("m.i").alias("i"), F.col("m.j").alias("j"), F.col("m.side").alias("side"), "id", "members", "set")
        checked = common.kept(common.in_arrow(spread.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "id"), _verify, "id bigint, links bigint, root bigint"), "verified")
    links = checked.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(checked.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    rooted = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    first = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    answer = rooted.join(first, "root").join(links, "id", "left").select("class", "class_id", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    return rows.join(answer, "class", "left").select("doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")).withColumnRenamed("doc_id", key)


def op6_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(common.documents(spark, sf_dir))
