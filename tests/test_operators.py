"""Operators on small hand-made tables: nulls, ties, repeats, empty inputs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dosegrid.functions import columns as C
from dosegrid.operators import consensus, druglist, metrics, neighbours, omics, pairs, scoring, sequence, splits
from dosegrid.sources import readers, sinks
from dosegrid.streaming import ingest


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_normalised_drops_nan_and_strips(spark):
    df = spark.createDataFrame([(" a\t", "c ", "1.5"), ("b", "c", "nan"), (None, "c", "2"), ("d", "c", "bad")], "d string, c string, p string")
    assert rows(consensus.normalised(df, "d", "c", "p", "M")) == [("a", "c", 1.5, "M")]


def test_read_sources_reports_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("drug,cell,p\nx,y,1\n")
    (tmp_path / "b.csv").write_text("drug,cell\nx,y\n")
    sources = [consensus.Source(m, str(tmp_path / f), "drug", "cell", ("q", "p")) for m, f in (("A", "a.csv"), ("B", "b.csv"), ("C", "c.csv"))]
    found, report = consensus.read_sources(spark, sources)
    assert rows(found) == [("x", "y", 1.0, "A")]
    assert rows(report) == [("A", "read"), ("B", "lacks a column"), ("C", "absent")]
    (tmp_path / "Precily_predictions_2.csv").write_text("drug_name,cell_line_name,predicted_ic50_mean\nd,c,4\n")
    found, report = consensus.read_sources(spark, consensus.standard_sources(str(tmp_path)))
    assert rows(found) == [("d", "c", 4.0, "Precily")] and report.where("status = 'absent'").count() == 8


def test_pivot_impute_top_k(spark):
    df = spark.createDataFrame([("d1", "c", 1.0, "A"), ("d1", "c", 3.0, "A"), ("d2", "c", 2.0, "A"), ("d2", "c", 5.0, "B")], "drug_name string, cell_line string, prediction double, method string")
    wide = consensus.imputed(consensus.pivoted(df, ["A", "B", "Z"]), ["A", "B", "Z"])
    assert rows(wide) == [("c", "d1", 2.0, 5.0, 0.0), ("c", "d2", 2.0, 5.0, 0.0)]
    ranked = consensus.top_k(wide.withColumn("score", F.col("A")), 1)
    assert [(r["drug_name"], r["rank"]) for r in ranked.collect()] == [("d1", 1)]


def test_drug_list_separator_and_header(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tCC\nb\tCO\n")
    assert rows(readers.drug_list(spark, str(tmp_path / "t.tsv"))) == [("a", "CC"), ("b", "CO")]
    (tmp_path / "h.csv").write_text("drug_id,smiles\na,CC\n")
    assert rows(readers.drug_list(spark, str(tmp_path / "h.csv"))) == [("a", "CC")]


def test_matrix_readers(spark, tmp_path):
    (tmp_path / "m.csv").write_text(",G1,G2\ns1,1.0,\ns2,2,x\n")
    assert rows(readers.matrix(spark, str(tmp_path / "m.csv"))) == [("s1", "G1", 0, 1.0), ("s1", "G2", 1, None), ("s2", "G1", 0, 2.0), ("s2", "G2", 1, None)]
    (tmp_path / "t.tsv").write_text("gene\tDATA.7\tDATA.8\nG1\t1\t2\n")
    (tmp_path / "q.csv").write_text(',"G,1",G2\n"s ""1""",1.0,2\n,"G,1",G2\n')
    assert rows(readers.matrix(spark, str(tmp_path / "q.csv"))) == [(None, "G,1", 0, None), (None, "G2", 1, None), ('s "1"', "G,1", 0, 1.0), ('s "1"', "G2", 1, 2.0)] or rows(readers.matrix(spark, str(tmp_path / "q.csv"))) == [("", "G,1", 0, None), ("", "G2", 1, None), ('s "1"', "G,1", 0, 1.0), ('s "1"', "G2", 1, 2.0)]
    (tmp_path / "p.txt").write_text("|A|B\ns|1|2\n")
    assert rows(readers.matrix(spark, str(tmp_path / "p.txt"), "|")) == [("s", "A", 0, 1.0), ("s", "B", 1, 2.0)]
    (tmp_path / "c.tsv").write_text("name\tx\nB\t1\nA\t2\nC\t3\n")
    assert rows(readers.feature_column(spark, str(tmp_path / "c.tsv"), 2)) == [(0, "B"), (1, "A")]
    (tmp_path / "j.json").write_text('{"a": 1,\n "b": [2]}')
    assert rows(readers.parameters(spark, str(tmp_path / "j.json"))) == [(1, [2])]
    (tmp_path / "w.csv").write_text("1,a\nx,b\n3,c\n")
    assert rows(readers.well_formed(spark, str(tmp_path / "w.csv"), "k int, v string")) == [(1, "a"), (3, "c")]
    assert rows(readers.transposed_matrix(spark, str(tmp_path / "t.tsv"))) == [("7", "G1", 0, 1.0), ("8", "G1", 1, 2.0)]
    assert rows(readers.feature_list(spark, str(tmp_path / "m.csv"))) == [(0, "G1"), (1, "G2")]
    (tmp_path / "v.txt").write_text("2 3\na 1 2 3\nb 1 2\n")
    assert rows(readers.word_vectors(spark, str(tmp_path / "v.txt"), 3)) == [("a", [1.0, 2.0, 3.0])]


def test_chunk_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (2, 1)], "x int, chunk_id int")
    sinks.write_chunks(df, str(tmp_path / "out"), "chunk_id")
    assert rows(readers.chunk_files(spark, str(tmp_path / "out/*/*.csv"), "x int", 0)) == [(1,), (2,)]
    scores = spark.createDataFrame([("a b", "x", 0.25), ("a b", "y", 0.12345), ("a b", "z", 9.0), ("a-b", "x", None)], "cell string, drug string, s double")
    sinks.write_reports(scores, str(tmp_path / "r"), 2, "cell", "drug", "s")
    found = spark.read.option("header", True).csv(str(tmp_path / "r"))
    assert rows(found.select("cell_key", "cell", "Rank", "drug", "s")) == [("a_b", "a b", "1", "y", "0.1235"), ("a_b", "a b", "2", "x", "0.2500"), ("a_b", "a-b", "1", "x", None)]
    sinks.write_global(scores, str(tmp_path / "g"), "s")
    assert sorted(line for f in (tmp_path / "g").glob("*.csv") for line in f.read_text().splitlines()[1:])[-1] == "a-b,x,"
    sinks.write_once(df, str(tmp_path / "o"))
    sinks.write_once(df.where("x = 1"), str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_drug_rules(spark):
    df = spark.createDataFrame([("a", "CC", "Early Phase 1"), ("b", " ", "Approved"), ("c", "Error 4", "Phase 1"), ("d", None, None)], "n string, s string, p string")
    assert [r["n"] for r in df.where(druglist.usable(F.col("s"))).collect()] == ["a"]
    assert sorted(r["n"] for r in druglist.by_class(df, "p", ["P1"]).collect()) == ["a", "c"]
    assert sorted(r["n"] for r in druglist.by_class(df, "p", ["p1", "nothing"]).collect()) == ["a", "c"]
    with pytest.raises(ValueError):
        druglist.by_class(df, "p", ["nothing"])
    assert druglist.pathway_phrase("Ca") == "Shikimates and Phenylpropanoids, Terpenoids" and druglist.pathway_phrase("ALL") is None
    assert druglist.pathway_phrase("abd") == "abd" and len(druglist.PATHWAYS) == 38
    named = df.withColumn("p", F.when(F.col("n") == "a", "Polyketides, Terpenoids").when(F.col("n") == "b", "abd, x").when(F.col("n") == "c", "Alkaloids"))
    found = lambda *codes: sorted(r["n"] for r in druglist.by_pathway(named, "p", codes).collect())
    assert found("c") == ["a"] and found("c", "abd") == ["a", "b"] and found("f", "all") == ["a", "b", "c"]
    with pytest.raises(ValueError):
        druglist.by_pathway(named, "p", [])


def test_alignment_policies(spark):
    m = spark.createDataFrame([("s", "A", 0, 1.0), ("s", "B", 1, None), ("s", "X", 2, 9.0)], "sample_id string, feature string, pos int, value double")
    ca = spark.createDataFrame([(0, "B"), (1, "A"), (2, "Q")], "pos int, feature string")
    assert rows(omics.packed(omics.aligned(m, ca, "zero"))) == [("s", [0.0, 1.0, 0.0])]
    assert [(r["pos"], r["value"]) for r in omics.aligned(m, ca).orderBy("pos").collect()] == [(0, None), (1, 1.0), (2, 0.0)]
    assert rows(omics.alignment_report(m, ca)) == [(2, 1, 1)]


def test_rescaling_edges(spark):
    df = spark.createDataFrame([(0.5, 1.0, 1.0), (None, 0.0, 2.0), (0.25, None, None)], "p double, lo double, hi double")
    found = df.select(C.unsquash(F.col("p")).alias("u"), C.denormalise(F.col("p"), F.col("lo"), F.col("hi")).alias("d"), C.clipped_scale(F.col("p"), F.lit(12.0)).alias("z")).collect()
    assert found[0]["u"] == 0 and found[1]["u"] is None
    assert found[0]["d"] == 0.5 and found[1]["d"] is None and found[2]["d"] == 0.25
    assert found[0]["z"] == 0.0 and found[1]["z"] is None


def test_metrics_constants_and_concordance(spark, monkeypatch):
    df = spark.createDataFrame([("k", 1.0, 2.0), ("k", 1.0, 3.0), ("one", 1.0, 1.0)], "g string, y double, f double")
    assert all(r["pearson"] is None and r["r2"] is None for r in metrics.errors(df, ["g"]).collect())
    r = np.random.default_rng(3)
    y, f = r.integers(0, 9, 60).astype(float), r.integers(0, 9, 60).astype(float)
    pairs_ = [(a, b) for a in range(60) for b in range(60) if y[a] > y[b]]
    wanted = sum(1.0 if f[a] > f[b] else 0.5 if f[a] == f[b] else 0.0 for a, b in pairs_) / len(pairs_)
    table = spark.createDataFrame([("a", float(p), float(q)) for p, q in zip(y, f, strict=True)] + [("b", 1.0, 2.0), ("b", 1.0, 3.0), ("c", None, 1.0), ("d", 1.0, 1.0), ("d", 2.0, 5.0)], "g string, y double, f double")
    for block in (1 << 16, 7, 1):
        monkeypatch.setattr(metrics, "BLOCK", block)
        found = {r["g"]: r["ci"] for r in metrics.concordance(table, "g").collect()}
        assert abs(found.pop("a") - wanted) < 1e-12 and found == {"b": None, "d": 1.0}
    monkeypatch.setattr(metrics, "PAIRED", 10)  # group a by counts, the others by pairs
    found = {r["g"]: r["ci"] for r in metrics.concordance_by_pairs(table, "g").collect()}
    assert abs(found.pop("a") - wanted) < 1e-12 and found == {"d": 1.0}


def test_concordance_of_many_groups_is_counted_in_one_deal(spark, monkeypatch):
    """Groups that are counted whole, together and across batches, equal all pairs; null, odd and single keys stay apart."""
    r = np.random.default_rng(11)
    data = [(None if g == 0 else g, float(r.integers(0, 6)), float(r.choice([0.0, -0.0, 1.5, 2.0, float("nan"), -3.0]))) for g in range(90) for _ in range(1 + g % 40)]
    table = spark.createDataFrame(data, "g long, y double, f double").repartition(5)
    rank = lambda v: float("inf") if v != v else v  # noqa: E731  # Spark and SQL: NaN is itself and above all
    wanted = {}
    for g in {g for g, _, _ in data}:
        mine = [(y, rank(f)) for k, y, f in data if k == g]
        found = [1.0 if a[1] > b[1] else 0.5 if a[1] == b[1] else 0.0 for a in mine for b in mine if a[0] > b[0]]
        wanted[g] = sum(found) / len(found) if found else None
    stages = []
    monkeypatch.setattr(metrics, "concordance_in_blocks", lambda *a, **k: stages.append(a))
    for held in (1 << 17, 100, 1):
        monkeypatch.setattr(metrics, "HELD", held)
        got = {x["g"]: x["ci"] for x in metrics.concordance(table, "g").collect()}
        assert got.keys() == wanted.keys() and not stages
        assert all(got[g] is None if w is None else abs(got[g] - w) < 1e-12 for g, w in wanted.items())
    floats = spark.createDataFrame([(0.0, 1.0, 1.0), (-0.0, 2.0, 5.0), (float("nan"), 1.0, 2.0), (float("nan"), 3.0, 1.0)], "g double, y double, f double")
    assert sorted((str(x["g"]), x["ci"]) for x in metrics.concordance(floats, "g").collect()) == [("0.0", 1.0), ("nan", 0.0)]
    assert metrics.concordance(floats.where("y > 9"), "g").count() == 0


def test_splits_are_complete_and_disjoint(spark):
    df = spark.createDataFrame([(k, k % 7, k % 2) for k in range(101)], "id long, drug long, y int")
    random = splits.random_split(df, "id", 0.2, "s")
    assert random.where("split = 'test'").count() == 21 and random.count() == 101
    keyed = splits.split_by_key(df, "drug", 0.3, "s")
    assert keyed.groupBy("drug").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert splits.balanced(df.where("y = 1"), "id", "y", 0.2, "s").count() == 0
    assert {r["split"] for r in splits.three_way(df, "drug", "s").collect()} <= {"train", "test", "validation"}


def test_numbering_and_synonyms(spark):
    df = spark.createDataFrame([(k,) for k in (5, 3, 9, 1)], "x int")
    assert rows(pairs.numbered(df, ["x"]).select("x", "row_no")) == [(1, 0), (3, 1), (5, 2), (9, 3)]
    drugs = spark.createDataFrame([(1, "A", "B, C"), (2, "B", None)], "id int, n string, s string")
    assert rows(pairs.synonyms(drugs, "id", "n", "s")) == [("A", 1), ("B", 2), ("C", 1)]
    assert pairs.chunk_plan(10, 0, 5) == (5, 2)


def merged(word, merges, end="</w>"):
    """The best pair of all is merged wherever it is, until no pair is known."""
    ranks = {m: k for k, m in reversed(list(enumerate(merges)))}
    parts = [*word[:-1], word[-1] + end] if word else []
    while known := [p for p in zip(parts, parts[1:], strict=False) if p in ranks]:
        best, out, k = min(known, key=ranks.get), [], 0
        while k < len(parts):
            pair = tuple(parts[k : k + 2]) == best
            out.append("".join(best) if pair else parts[k])
            k += 1 + pair
        parts = out
    return parts


def test_subwords_and_padding(spark):
    # the last two pairs make a part that an earlier pair needs, and one pair is listed twice
    merges = [("l", "o"), ("lo", "w"), ("a", "a"), ("x", "abc"), ("e", "r</w>"), ("a", "bc"), ("b", "c"), ("l", "o")]
    r = np.random.default_rng(1)
    words = ["lower", "", "a", "aaa", "aaaaa", "xabc", "xabcd", "lowlow", "loo</w>", "é\u20aclo", *("".join(r.choice(list("lowabcx"), 9)) for _ in range(60))]
    found = {x["w"]: x["p"] for x in spark.createDataFrame([(w,) for w in words], "w string").select("w", sequence.merged(F.col("w"), merges).alias("p")).collect()}
    assert found == {w: merged(w, merges) for w in words} and found["lower"] == ["low", "er</w>"] and found["xabc"] == ["x", "a", "b", "c</w>"]
    encoded = sequence.subword_encoded(spark.createDataFrame([("low",), (None,), ("low",)], "w string"), "w", merges)
    assert rows(encoded) == sorted([("low", ["lo", "w</w>"])] * 2 + [(None, None)], key=repr)
    assert rows(encoded.limit(1).select(sequence.merged(F.lit("ab"), []))) == [(["a", "b</w>"],)]
    df = spark.createDataFrame([([1, None],), ([4, 5, 6],), ([],)], "raw array<int>")
    assert rows(df.select(C.padded(F.col("raw"), 2), C.pad_mask(F.col("raw"), 2))) == sorted([([0, 0], [1, 0]), ([4, 5], [1, 1]), ([0, 0], [0, 0])], key=repr)
    marked = df.select(C.padded(F.col("raw"), 4, 8, 9), C.padded(F.col("raw"), 6, 8, 9, before=True), C.pad_mask(F.col("raw"), 4, 2))
    assert rows(marked) == sorted([([8, 0, 9, 0], [0, 0, 0, 8, 0, 9], [1, 1, 1, 0]), ([8, 4, 5, 6], [0, 8, 4, 5, 6, 9], [1, 1, 1, 1]), ([8, 9, 0, 0], [0, 0, 0, 0, 8, 9], [1, 1, 0, 0])], key=repr)
    text = spark.createDataFrame([("C[NH]Cl",), ("",)], "s string")
    assert [r[0] for r in text.select(sequence.tokenised(F.col("s"))).collect()] == [["C", "[NH]", "Cl"], []]


def test_scoring_survives_bad_rows(spark):
    def load():
        def model(batch: pd.DataFrame) -> pd.Series:
            if (batch["x"] < 0).any():
                raise ValueError
            return batch["x"] * 2

        return model

    df = spark.createDataFrame([(1, 1.0), (2, -1.0), (3, 4.0)], "id int, x double").coalesce(1)
    assert rows(scoring.score_pairs(df, load, ["id"])) == [(1, 2.0), (2, None), (3, 8.0)]


def test_ingest_resumes(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    job = lambda: ingest.ingest(spark, p("in"), "x int", p("out"), p("state"), F.when(F.col("x") < 0, "negative"), p("rejects"))
    spark.createDataFrame([(1,), (-1,)], "x int").write.mode("append").parquet(p("in"))
    job()
    spark.createDataFrame([(2,)], "x int").write.mode("append").parquet(p("in"))
    job()
    out = lambda: rows(spark.read.parquet(p("out")).select("x"))
    assert out() == [(1,), (2,)]
    assert rows(spark.read.parquet(p("rejects")).select("x", "reason")) == [(-1, "negative")]
    last = spark.read.parquet(p("out")).where("x = 2").first()["batch"]
    sinks.write_batch(spark.createDataFrame([(2,)], "x int"), p("out"), last)  # a batch that is done again
    assert out() == [(1,), (2,)]


@pytest.mark.parametrize("bins", [2, 1024])
def test_medians_are_exact(spark, monkeypatch, bins):
    monkeypatch.setattr(consensus, "BINS", bins)
    r = np.random.default_rng(2)
    a, b = r.integers(0, 9, 50).astype(float).tolist(), (r.normal(0, 1, 51) * 10.0 ** r.integers(-300, 300, 51)).tolist()
    wide = spark.createDataFrame([(x, y, None, 4.0) for x, y in zip([*a, None], b, strict=True)], "A double, B double, Z double, `C-1` double")
    found = consensus.medians(wide.withColumnRenamed("C-1", "C"), ["A", "B", "Z", "C"]).collect()
    assert [tuple(x) for x in found] == [(float(np.median(a)), float(np.median(b)), None, 4.0)]
    assert [tuple(x) for x in consensus.medians(wide.where("false"), ["A"]).collect()] == [(None,)]
    assert consensus.imputed(spark.createDataFrame([("c", "d", None)], "cell_line string, drug_name string, A double"), ["A"]).collect()[0]["A"] == 0.0


def test_lingos_pad_before_elements_become_letters(spark):
    df = spark.createDataFrame([("ClCC",), ("ClClCCCC",), ("BrCCCCCCCl",), ("",), (None,), ("CCCCCCCCC",)], "s string")
    found = [r[0] for r in df.select(sequence.lingos(F.col("s"), 8, ("Cl", "Br", "Si"), "QX")).collect()]
    assert found[0] == ["ClCC____"] and found[1] == ["ClClCCCC"] and found[2] == ["BrCCCCCCCl"]
    assert found[3] == found[4] == ["________"] and found[5] == ["CCCCCCCC"] * 2


@pytest.mark.parametrize("drugs, cells, n, first, ties", [(5, 4, 40, 4, True), (30, 25, 300, 1, False), (12, 9, 60, 2, True), (3, 2, 1, 1, True)])
def test_nearest_equals_brute_force(spark, monkeypatch, drugs, cells, n, first, ties):
    monkeypatch.setattr(neighbours, "FIRST", first)
    monkeypatch.setattr(neighbours, "GROWTH", 2)
    r = np.random.default_rng(4)
    dd, cd = (r.integers(0, 4, (drugs, drugs)) / 4, r.integers(0, 5, (cells, cells)) / 4) if ties else (r.random((drugs, drugs)), r.random((cells, cells)))
    table = lambda m: spark.createDataFrame([(a, b, float(m[a, b])) for a in range(len(m)) for b in range(len(m))], "a int, b int, dist double")
    train = [(k // 2, int(r.integers(drugs)), int(r.integers(max(1, cells - 1))), float(k)) for k in range(n)]  # ids occur twice
    train += [(900 + k, train[0][1], train[0][2], 0.5) for k in range(n)]  # a key with half of the rows
    test = [(k // 2, int(r.integers(drugs)), int(r.integers(cells))) for k in range(12)]
    got = neighbours.nearest(spark.createDataFrame(test, "test_id int, drug int, cell int"), spark.createDataFrame(train, "train_id int, drug int, cell int, label double"), table(dd), table(cd), 3)
    wanted = []
    for i, d, c in test:
        for scale, top in (("local", max(cd[c, x[2]] for x in train)), ("global", cd.max())):
            near = sorted((round(dd[d, x[1]] + (cd[c, x[2]] / top if top else 0.0), 9), x[0], x[3]) for x in train)[:3]
            wanted += [(i, scale, place, k, label) for place, (_, k, label) in enumerate(near, 1)]
    assert rows(got) == sorted(wanted, key=repr)


def test_near_keys_are_found_by_short_lists(spark):
    """All of a grid is trained on: the first turn is enough for every test key."""
    near = lambda n: spark.range(n).selectExpr("cast(id as int) as a").crossJoin(spark.range(n).selectExpr("cast(id as int) as b")).selectExpr("a", "b", "abs(a - b) / 10.0D as dist")
    train = spark.range(400).selectExpr("cast(id as int) as train_id", "cast(id / 20 as int) as drug", "cast(id % 20 as int) as cell", "1.0D as label")
    test = train.selectExpr("train_id as test_id", "drug", "cell")
    found = neighbours.nearest(test, train, near(20), near(20), 1)
    assert found.where("test_id = train_id and rank = 1").count() == 800 == found.count()


def test_tanimoto_within_equals_all_pairs(spark):
    r = np.random.default_rng(6)
    sets = [(k, [int(x) for x in np.flatnonzero(r.random(30) < r.choice([0.1, 0.5]))] + [99]) for k in range(60)]  # one bit that all have
    sets += [(100 + k, sets[k][1][::-1] + sets[k][1]) for k in range(10)] + [(200, []), (201, None), (202, []), (203, [1, None])] + [(300 + k, [5, 6]) for k in range(6)]
    df = spark.createDataFrame(sets, "k int, bits array<int>")
    clean = [(k, {x for x in v if x is not None}) for k, v in sets if v is not None and {x for x in v if x is not None}]
    for most in (0.0, 0.3, 0.6, 0.9):
        wanted = [(a, b, round(1 - len(x & y) / len(x | y), 9)) for a, x in clean for b, y in clean if a < b and 1 - len(x & y) / len(x | y) <= most + 1e-12]
        found = [(x["a"], x["b"], round(x["dist"], 9)) for x in neighbours.tanimoto_within(df, "k", "bits", most).collect()]
        assert sorted(found) == sorted(wanted)
    with pytest.raises(ValueError):
        neighbours.tanimoto_within(df, "k", "bits", 1.0)


def test_scan_of_groups_over_many_ranges(spark):
    """A group and a value with most rows, null groups and values, and sums, least values and mean places of equal values."""
    r = np.random.default_rng(8)
    data = [(r.choice(["hot", "hot", "hot", "a", None]), r.choice([7, 7, 7, 7, 1, 2, None]), k, int(r.integers(9)), r.choice([None, 3, 5])) for k in range(500)]
    data = [(None if g is None else str(g), None if v is None else int(v), k, x, None if y is None else int(y)) for g, v, k, x, y in data]
    df = spark.createDataFrame(data, "g string, v int, k int, x int, y int").repartition(7)
    kept_n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = pairs.scanned(df, ["g"], ["v", "k"], sums={"sx": F.col("x"), "sy": F.col("y")}, lows={"low": F.col("y")}).collect()
        tied = metrics.average_places(df.groupBy("g", "v").agg(F.count("*").alias("n")), ["g"], "v", "mean").collect()
        whole = pairs.scanned(df, [], ["k"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept_n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    wanted, means = {}, {}
    for g in ("hot", "a", None):
        mine = sorted((x for x in data if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        for p, row in enumerate(mine):
            before = [x[4] for x in mine[:p] if x[4] is not None]
            wanted[row[2]] = (p, sum(x[3] for x in mine[: p + 1]), sum(x[4] or 0 for x in mine[: p + 1]), min(before, default=None), len(mine))
            means.setdefault((g, row[1]), []).append(p)
    assert {x["k"]: (x["row_no"], x["sx"], x["sy"], x["low"], x["group_rows"]) for x in found} == wanted
    assert {(x["g"], x["v"]): x["mean"] for x in tied} == {key: np.mean(p) for key, p in means.items()}
    assert [x["row_no"] for x in sorted(whole, key=lambda x: x["k"])] == list(range(500)) and {x["group_rows"] for x in whole} == {500}


def test_ranks_and_running_statistics(spark):
    r = np.random.default_rng(9)
    data = [("hot" if k % 3 else "b", k, float(r.integers(4)), float(r.integers(4))) for k in range(120)] + [("c", 1, 1.0, 2.0), ("c", 2, 1.0, 3.0)]
    df = spark.createDataFrame(data, "g string, k int, y double, f double").repartition(5)
    frame = pd.DataFrame(data, columns=["g", "k", "y", "f"])
    found = {x["g"]: x["spearman"] for x in metrics.spearman(df, ["g"]).collect()}
    for g in ("hot", "b"):
        mine = frame[frame.g == g]
        assert abs(found[g] - np.corrcoef(mine.y.rank(), mine.f.rank())[0, 1]) < 1e-12
    assert found["c"] is None
    running = {(x["g"], x["idx"]): x["r"] for x in metrics.running_correlation(df, "g", "k", "y", "f", 10).collect()}
    for (g, idx), value in running.items():
        mine = frame[frame.g == g].sort_values("k").iloc[: idx + 1]
        assert abs(value - np.corrcoef(mine.y, mine.f)[0, 1]) < 1e-9
    assert len(running) == 7 + 3
    best = {(x["g"], x["k"]) for x in metrics.running_best(df, "g", "k", "y").collect() if x["is_best"]}
    assert best == {(g, k) for g, mine in frame.sort_values("k").groupby("g") for k, y, low in zip(mine.k, mine.y, mine.y.cummin().shift(), strict=True) if not y >= low}


def test_p_values(spark):
    """Against the closed form of 2 and 4 degrees of freedom, known values, and the normal tail for many pairs."""
    from math import erfc, sqrt

    cases = [(r, n) for r in (-0.9, 0.0, 1e-9, 0.3, 0.999, 1.0, None) for n in (2, 3, 4, 6, 12)] + [(0.6, 10), (0.002, 1_000_000), (0.01, 100_000)]
    found = {(x["r"], x["n"]): x["p_value"] for x in metrics.p_values(spark.createDataFrame(cases, "r double, n long"), "r", "n").collect()}
    for (r, n), p in found.items():
        if r is None or n < 3:
            assert p is None
        elif abs(r) == 1:
            assert p == 0
        elif n == 4:
            assert abs(p - (1 - abs(r))) < 1e-12
        elif n == 6:
            assert abs(p - (1 - 1.5 * abs(r) + abs(r) ** 3 / 2)) < 1e-12
    assert abs(found[(0.6, 10)] - 0.06668799) < 1e-8
    for r, n in ((0.002, 1_000_000), (0.01, 100_000)):
        t = r * sqrt((n - 2) / (1 - r * r))
        assert abs(found[(r, n)] - erfc(t / sqrt(2))) < 2e-5


def test_shards_and_unscored(spark):
    df = spark.createDataFrame([(k,) for k in range(11)], "x int")
    assert {r["shard"]: r["count"] for r in pairs.shards(df, ["x"], 3).groupBy("shard").count().collect()} == {0: 3, 1: 3, 2: 5}
    assert pairs.shards(df.where("x < 2"), ["x"], 3).select("shard").distinct().count() == 2
    scored = spark.createDataFrame([("a", "c1", 1.0)], "drug string, cell string, y double")
    drugs, cells = spark.createDataFrame([("a",), ("b",)], "drug string"), spark.createDataFrame([("c1",), ("c2",)], "cell string")
    assert rows(pairs.with_unscored(scored, drugs, cells, ("drug", "cell"))) == [("a", "c1", 1.0), ("b", "c1", None), ("b", "c2", None)]
    assert pairs.with_unscored(scored, drugs, cells, ("drug", "cell"), keep=False).count() == 1


def test_stored_model_keeps_its_features(spark, tmp_path):
    wide = spark.createDataFrame([("c", f"d{k}", float(k), float(k % 3)) for k in range(30)], "cell_line string, drug_name string, B double, A double")
    model = consensus.forest(wide.withColumn("y", F.col("B")), ["B", "A"], "y")
    consensus.save_model(model, str(tmp_path / "m"))
    long = wide.select("drug_name", "cell_line", F.explode(F.array(F.struct(F.lit("A").alias("method"), F.col("A").alias("prediction")), F.struct(F.lit("B").alias("method"), F.col("B").alias("prediction")), F.struct(F.lit("other").alias("method"), F.lit(1e9).alias("prediction")))).alias("r")).select("drug_name", "cell_line", "r.*")
    found = consensus.scored_by(spark, str(tmp_path / "m"), long)
    assert rows(found) == rows(model.transform(wide).select("cell_line", "drug_name", "ensemble_score"))
    # the same forest as a table of nodes, gone down by a fold
    consensus.save_trees(spark, consensus.tree_nodes(model), ["B", "A"], str(tmp_path / "t"))
    by_nodes = consensus.scored_by_trees(spark, str(tmp_path / "t"), long)
    same = {(x[0], x[1]): x[2] for x in rows(found)}
    assert all(abs(same[(c, d)] - v) < 1e-9 for c, d, v in rows(by_nodes)) and by_nodes.count() == len(same)


def test_forest_of_equal_rows_is_a_forest_of_all_rows(spark, tmp_path):
    """Rows with equal features are counted once for all; each tree's leaves hold the means of the labels that its bootstrap takes."""
    long = spark.range(6000).selectExpr("concat(' d', id % 3000) as drug", "concat('c', id div 3000) as cell", "if(id % 5 = 0, null, id % 4) as value", "concat('M', 1 + id div 3 % 2) as method", "id % 4 * 10D + id % 7 as y")
    both = ["M1", "M2"]
    rows_ = consensus.normalised(long, "drug", "cell", "value", F.col("method"), "y")
    wide = consensus.imputed(consensus.pivoted(rows_, both, "label"), both, "label").cache()
    plain = consensus.imputed(consensus.pivoted(consensus.normalised(long, "drug", "cell", "value", F.col("method")), both), both)
    assert wide.count() == 4800 and rows(wide.drop("label")) == rows(plain)
    model = consensus.forest_of_groups(wide, ["M1"], "label", trees=3)
    assert {m.getNumTrees for m in model.stages[1:]} == {3}
    consensus.save_model(model, str(tmp_path / "m"))
    found = consensus.scored_wide(str(tmp_path / "m"), wide.drop("label"))
    assert rows(found) == rows(model.transform(wide).select("cell_line", "drug_name", "ensemble_score"))
    counts = wide.select("*", *(consensus.drawn(t, 7).alias(f"w{t}") for t in range(3))).toPandas()
    assert abs(counts["w0"].mean() - 1) < 0.1 and abs(counts["w0"].var() - 1) < 0.15 and counts[["w0", "w1"]].corr().iloc[0, 1] < 0.1
    # depth suffices to part all values, so each has its own mean in each tree
    wanted = {}
    for key, part in counts.groupby("M1"):
        wanted[key] = sum((part["label"] * part[f"w{t}"]).sum() / part[f"w{t}"].sum() for t in range(3)) / 3
    scores = found.join(wide.select("cell_line", "drug_name", "M1"), ["cell_line", "drug_name"]).toPandas()
    assert len(scores) == 4800 and max(abs(wanted[a] - s) for a, s in zip(scores["M1"], scores["ensemble_score"], strict=True)) < 1e-6
    # features that hardly repeat are learned from row by row, by a forest of the same form
    apart = consensus.forest_of_groups(wide.withColumn("M1", F.col("M1") + F.rand(3)), both, "label", trees=2)
    assert apart.stages[-1].getNumTrees == 2


def test_feature_lists_in_another_encoding(spark, tmp_path):
    (tmp_path / "h.csv").write_bytes("样本,基因一,G2\ns,1,2\n".encode("gbk"))
    (tmp_path / "u.csv").write_bytes('样本,"G,1",G2\ns,1,2\n'.encode())
    (tmp_path / "c.tsv").write_bytes("gene_symbols\tx\n基因\t1\n\nB\t2\n".encode("gbk"))
    assert rows(readers.feature_list(spark, str(tmp_path / "h.csv"))) == [(0, "基因一"), (1, "G2")]
    assert rows(readers.feature_list(spark, str(tmp_path / "u.csv"))) == [(0, "G,1"), (1, "G2")]
    assert rows(readers.feature_column(spark, str(tmp_path / "c.tsv"))) == [(0, "基因"), (1, "B")]
    with pytest.raises(ValueError):
        readers.feature_column(spark, str(tmp_path / "c.tsv"), readers.MOST_FEATURES + 1)


def test_resume_by_chunk_number(spark, tmp_path):
    path = str(tmp_path / "out")
    chunks = lambda n, run: spark.range(n * 2).selectExpr("id", "cast(id div 2 + 1 as int) as chunk_id", f"'{run}' as run")
    read = lambda: sorted((int(x["chunk_id"]), x["run"]) for x in spark.read.option("header", True).csv(path).select("chunk_id", "run").distinct().collect())
    assert sinks.last_chunk(spark, path) == 0
    assert sinks.resume_chunks(chunks(2, "a"), path) == 1 and read() == [(1, "a"), (2, "a")]
    assert sinks.resume_chunks(chunks(12, "b"), path) == 3 and sinks.last_chunk(spark, path) == 12
    assert sinks.resume_chunks(chunks(12, "c"), path) == 13 and {r for _, r in read()} == {"a", "b"}
    assert sinks.resume_chunks(chunks(11, "d"), path, 11) == 11 and read()[-2:] == [(10, "b"), (11, "d")]


def test_global_file_in_one_part(spark, tmp_path, monkeypatch):
    df = spark.range(50).selectExpr("id", "id / 3 as s").repartition(6)
    sinks.write_global(df, str(tmp_path / "one"), "s", single=True)
    parts = list((tmp_path / "one").glob("*.csv"))
    assert len(parts) == 1 and len(parts[0].read_text().splitlines()) == 51
    monkeypatch.setattr(sinks, "SINGLE_ROWS", 49)
    with pytest.raises(ValueError):
        sinks.write_global(df, str(tmp_path / "two"), "s", single=True)


def test_kept_tables_are_cleared(spark):
    from dosegrid.sources import shared

    shared.clear(spark)
    df = pairs.numbered(spark.range(9), ["id"])
    assert df.count() == 9 and shared.clear(spark) == 1 and shared.clear(spark) == 0
    with pytest.raises(Exception, match="FILE_NOT_EXIST|FAILED_READ_FILE|does not exist"):
        df.count()


def test_rounded_keeps_the_sign_of_zero(spark):
    df = spark.createDataFrame([(-4e-7,), (4e-7,), (-0.0,), (-1.5e-6,), (float("nan"),), (None,)], "x double")
    found = [r[0] for r in df.select(F.transform(F.array("x"), lambda x: C.rounded(x, 6))[0]).collect()]
    assert [str(x) for x in found] == ["-0.0", "0.0", "-0.0", "-2e-06", "nan", "None"]


def test_mean_embeddings_equal_sql_to_the_sign_of_zero(spark, tmp_path):
    """The mean of the first feature's vectors is a little under zero."""
    import duckdb

    from dosegrid.plans import registry

    vectors = [(k, [-3e-7 if j == 0 else float(j + k) for j in range(64)], 0) for k in range(64)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    want = {k: repr(v) for k, v in con.execute(registry.ORACLE_SQL["top_features_mean_embedding"]).fetchall()}
    got = {r["sample_id"]: repr(list(r["vec"])) for r in registry.QUERIES["top_features_mean_embedding"](spark, str(tmp_path)).collect()}
    assert got == want and all("-0.0" in v for v in want.values())


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_grids_are_many_tasks_and_lose_no_pair(spark, monkeypatch, broadcast):
    for name, n in (("DRUG_BLOCK", 3), ("CELL_BLOCK", 4), ("TASK_PAIRS", 20), ("BROADCAST_ROWS", broadcast)):
        monkeypatch.setattr(pairs, name, n)
    a, b = [1, 2, 2, None, *range(5, 12)], [("x", 1), ("x", 1), (None, 2), *((f"y{k}", k) for k in range(8))]
    found = pairs.grid(spark.createDataFrame([(x,) for x in a], "d int").coalesce(1), spark.createDataFrame(b, "c string, n int"))
    assert found.columns == ["d", "c", "n"] and rows(found) == sorted(((x, *y) for x in a for y in b), key=repr)
    assert len({r[0] for r in found.select(F.spark_partition_id()).collect()}) > 1
    assert pairs.grid(spark.createDataFrame([], "d int"), spark.createDataFrame(b, "c string, n int")).count() == 0


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_no_stage_of_a_grid_goes_through_two_blocks(spark, monkeypatch, broadcast):
    """a compiled stage makes all rows of an input row before it gives one away, so none may hold both explodes."""
    monkeypatch.setattr(pairs, "BROADCAST_ROWS", broadcast)
    found = pairs.grid(spark.range(50).toDF("d"), spark.range(30).toDF("c"))
    assert found.distinct().count() == 1500
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().executedPlan()
    found.collect()
    lines = [line for line in plan.toString().split("== Initial Plan ==")[0].splitlines() if "Generate" in line or "Coalesce" in line]
    kinds = ["g" if "Generate" in line else "c" for line in lines]
    assert kinds == ["g", "c", "g"]


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_missing_pairs_never_shuffle_the_grid(spark, monkeypatch, broadcast):
    for name, n in (("CELL_BLOCK", 4), ("TASK_PAIRS", 50), ("BROADCAST_ROWS", broadcast)):
        monkeypatch.setattr(pairs, name, n)
    given = [(d, c) for d in (*range(9), None) for c in (*range(11), None) if d is None or c is None or (d * c + c) % 3 == 0 or d == 4]
    found = pairs.missing_pairs(spark.createDataFrame([*given, *given], "d int, c long"), "d", "c")
    assert "CartesianProduct" not in found._jdf.queryExecution().toString() and "LeftAnti" not in found._jdf.queryExecution().toString()
    drugs, cells = {d for d, _ in given}, {c for _, c in given}
    known = {(d, c) for d, c in given if d is not None and c is not None}
    assert rows(found) == sorted(((d, c) for d in drugs for c in cells if (d, c) not in known), key=repr)


def test_missing_pairs_shuffle_rows_once_and_no_pairs_of_blocks(spark, monkeypatch):
    """what is left when rows have been dealt moves a row for each drug, and shuffle files go with the step that needs them."""
    monkeypatch.setattr(pairs, "CELL_BLOCK", 4)
    given = [(d, c) for d in range(40) for c in range(30) if (d + c) % 7 == 0] + [(40, None), (None, 1)]
    found = pairs.missing_pairs(spark.createDataFrame(given, "d int, c int"), "d", "c")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Aggregate" not in plan and "LeftOuter" not in plan
    assert rows(found) == sorted(((d, c) for d in (*range(41), None) for c in (*range(30), None) if (d, c) not in given[:-2]), key=repr)
    assert pairs.missing_pairs(spark.createDataFrame([], "d int, c int"), "d", "c").count() == 0


def test_pivot_tasks_grow_with_the_rows(spark, monkeypatch):
    """Each task gathers so many rows on average, whatever the session's number of partitions."""
    monkeypatch.setattr(consensus, "TASK_ROWS", 50)
    given = [(f"d{k % 100}", f"c{k // 200}", float(k), "AB"[k // 100 % 2]) for k in range(1000)]
    wide = consensus.pivoted(spark.createDataFrame(given, "drug_name string, cell_line string, prediction double, method string"), ["A", "B", "Z"])
    assert wide.rdd.getNumPartitions() == 20 and rows(wide) == sorted(((f"c{c}", f"d{d}", 200.0 * c + d, 200.0 * c + 100 + d, None) for c in range(5) for d in range(100)), key=repr)


@pytest.mark.parametrize("words", [0, 4])
def test_near_sets_in_groups_equal_all_pairs(spark, monkeypatch, words):
    """Common bits only: by words in many groups, and by rare bits."""
    monkeypatch.setattr(neighbours, "MOST_WORDS", words)
    monkeypatch.setattr(neighbours, "GROUP_SETS", 7)
    rng = np.random.default_rng(3)
    sets = {k: sorted(int(b) for b in rng.choice(70, size=rng.integers(0, 6) + 60 * (k % 9 == 0), replace=False)) for k in range(60)}
    sets[60], sets[61] = sets[5], sets[9]
    found = neighbours.tanimoto_within(spark.createDataFrame(list(sets.items()), "k int, bits array<int>"), "k", "bits", 0.6)
    if words:
        assert "distinct" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    got = sorted((r["a"], r["b"], round(r["dist"], 9)) for r in found.collect())
    d = lambda a, b: 1 - len({*a} & {*b}) / len({*a} | {*b})
    assert got == sorted((i, j, round(d(sets[i], sets[j]), 9)) for i in sets for j in sets if i < j and sets[i] and sets[j] and d(sets[i], sets[j]) <= 0.6)


def test_euclid_pairs_in_groups_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SQUARE", 3)
    given = [(k, [float(k), k * 0.5, -1.0 * k]) for k in range(8)] + [(8, None), (9, [1.0, None, 2.0])]
    found = neighbours.euclid_pairs(spark.createDataFrame(given, "k int, v array<double>"), "k", "v")
    d = lambda u, v: None if u is None or v is None or None in u or None in v else float(np.sqrt(sum((x - y) ** 2 for x, y in zip(u, v))))
    assert rows(found) == sorted(((a, b, d(u, v)) for a, u in given for b, v in given), key=repr)


@pytest.mark.parametrize("most, n", [(1 << 23, 10), (0, 13), (0, 2)])
def test_vectors_of_euclid_pairs_do_not_travel_with_each_pair(spark, monkeypatch, most, n):
    """blocks are broadcast, or joined where they are large, and each two meet once; before, each vector was shuffled twice for each group."""
    for name, size in (("BROADCAST_VALUES", most), ("SQUARE", 3), ("WIDE_SQUARE", 3), ("STRIP_PAIRS", 4), ("TASK_DISTANCES", 30)):
        monkeypatch.setattr(neighbours, name, size)
    given = [(f"c{k // 2}" if k else None, [k * 0.5, -1.0 * k, 0.25 * k * k][: 3 - (k == 4)] if k != 6 else None) for k in range(n)]
    cells = spark.createDataFrame(given, "k string, v array<float>")
    found = neighbours.euclid_pairs(cells, "k", "v")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "CoGroup" not in plan and plan.count("RepartitionByExpression") == 1
    if most:
        found.collect()
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    given = [(k, None if v is None else np.array(v, np.float32).astype(float)) for k, v in given]
    d = lambda u, v: None if u is None or v is None or len(u) != len(v) else float(np.sqrt(sum((x - y) ** 2 for x, y in zip(u, v))))
    assert rows(found) == sorted(((a, b, d(u, v)) for a, u in given for b, v in given), key=repr)
    assert neighbours.euclid_pairs(cells.limit(0), "k", "v").count() == 0


@pytest.mark.parametrize("first, group, odd", [(1, 8192, False), (4, 7, False), (2, 7, True)])
def test_nearest_by_vectors_equals_all_distances(spark, monkeypatch, first, group, odd):
    """the table of all cell distances is never made; copies of cell lines and of drugs count as one while neighbours are searched."""
    r = np.random.default_rng(11)
    vectors = [r.normal(0, 1, 5).tolist() for _ in range(12)]
    given = [(c, vectors[c % 9]) for c in range(24)]
    given += [(24, None), (25, [1.0, None, 0.0, 0.0, 0.0]), (26, [1.0]), (27, [float("nan")] * 5), (28, [1e200] * 5)] if odd else [(24, [2.0] * 5), (25, [30.0] * 5)]
    cells = spark.createDataFrame(given, "cell int, vec array<double>")
    kind = r.integers(0, 3, 8)  # drugs of three kinds
    dd = spark.createDataFrame([(a, b, float(abs(kind[a] - kind[b])) / 4) for a in range(8) for b in range(8)], "a int, b int, dist double")
    train = spark.createDataFrame([(k // 2, int(r.integers(9)), int(r.integers(len(given))), float(k)) for k in range(120)], "train_id int, drug int, cell int, label double")
    test = spark.createDataFrame([(k, int(r.integers(9)), int(r.integers(len(given) + 1))) for k in range(60)], "test_id int, drug int, cell int")
    monkeypatch.setattr(neighbours, "LIST_LENGTH", 3)
    monkeypatch.setattr(neighbours, "SQUARE", 5)
    wanted = rows(neighbours.nearest(test, train, dd, neighbours.euclid_pairs(cells, "cell", "vec"), 3))
    monkeypatch.setattr(neighbours, "FIRST", first)
    monkeypatch.setattr(neighbours, "GROWTH", 2)
    monkeypatch.setattr(neighbours, "LIST_GROUP", group)
    monkeypatch.setattr(neighbours, "STRIP", 3)
    monkeypatch.setattr(neighbours, "euclid_pairs", None)
    assert rows(neighbours.nearest_by_vectors(test, train, dd, cells, "cell", "vec", 3)) == wanted and wanted


def test_folders_of_reports_are_dealt_to_more_tasks_as_they_grow(spark, tmp_path, monkeypatch):
    """the number of tasks goes with the number of cell lines, and reports stay one file for each."""
    monkeypatch.setattr(sinks, "TASK_FOLDERS", 1)
    scores = spark.range(60).selectExpr("concat('c', id % 30) as cell_line", "concat('d', id) as drug_name", "id / 4.0D as ensemble_score")
    sinks.write_reports(scores, str(tmp_path / "r"), 1)
    files = list((tmp_path / "r").glob("cell_key=*/*.csv"))
    assert len(files) == 30 and len({f.name[:10] for f in files}) > 4
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "r")).select("cell_key", "Rank", "ensemble_score")) == sorted((f"c{k}", "1", f"{k / 4:.4f}") for k in range(30))
