"""Predictions of many methods: normalised, pivoted, imputed, averaged, ranked."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import exp, factorial
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dosegrid.functions.columns import number, strip
from dosegrid.sources.shared import kept

#: Steps between two bounds in the search for a median.
BINS = 1024
#: Prediction rows that a task gathers by pair, whatever the number of partitions that the session sets.
TASK_ROWS = 1 << 19
#: Trees whose bootstrap counts are drawn in one pass, trees that are grown side by side, rows for each distinct one from which equal rows are counted once, and distinct rows of a task.
AT_ONCE, BESIDE, EQUAL_ROWS, GROUP_ROWS = 10, 8, 8, 1 << 17
#: Bootstrap counts of a row are Poisson's for a mean of one; larger ones have a chance under 1e-9.
MOST_DRAWN = 11


@dataclass(frozen=True)
class Source:
    """A method's file and its columns; prediction may have alternative names."""

    method: str
    path: str
    drug: str
    cell: str
    prediction: tuple[str, ...]


#: Each method's file, drug, cell and prediction columns.
STANDARD = (
    ("BANDRP", "bandrp_predictions*", "DrugName", "CellLineID", ("PredictedValue",)),
    ("DeepTTA", "DeepTTC_predictions*", "DrugName", "COSMIC_ID", ("Predicted_LN_IC50",)),
    ("DIPK", "DIPK_predictions*", "drug_id", "cell_line_name", ("predicted_ic50",)),
    ("GPDRP_GAT", "GPDRP_predictions_GAT*", "drug_name", "cell_line_name", ("predicted_ic50_original",)),
    ("GPDRP_GCN", "GPDRP_predictions_GCN*", "drug_name", "cell_line_name", ("predicted_ic50_original",)),
    ("GraphDRP_GAT_GCN", "GraphDRP_predictions_GAT_GCN*", "drug_name", "cell_line_name", ("IC50_original",)),
    ("GraphDRP_GATNet", "GraphDRP_predictions_GATNet*", "drug_name", "cell_line_name", ("IC50_original",)),
    ("paccmann", "paccmann_predictions*", "drug_name", "cell_line_name", ("predicted_value_denormalized",)),
    ("Precily", "Precily_predictions*", "drug_name", "cell_line_name", ("predicted_ic50", "predicted_ic50_mean")),
)


def standard_sources(folder: str) -> list[Source]:
    """The nine methods' files in a folder, by pattern, so that all parts of a file count."""
    return [Source(m, f"{folder.rstrip('/')}/{f}", d, c, p) for m, f, d, c, p in STANDARD]


def normalised(df: DataFrame, drug: str, cell: str, prediction: str, method: str | Column, label: str | None = None) -> DataFrame:
    """(drug_name, cell_line, prediction, method) without rows that lack a key or a number. With a label, that too, and rows that lack a number stay for it."""
    method = F.lit(method) if isinstance(method, str) else method
    beside = [F.col(label).alias("label")] if label else []
    rows = df.select(F.col(drug).alias("d"), F.col(cell).alias("c"), number(F.col(prediction)).alias("prediction"), method.alias("method"), *beside)
    rows = rows.dropna(subset=["d", "c"] if label else None)
    return rows.select(strip(F.col("d")).alias("drug_name"), strip(F.col("c")).alias("cell_line"), "prediction", "method", *(["label"] if label else []))


def read_sources(spark: SparkSession, sources: Sequence[Source]) -> tuple[DataFrame, DataFrame]:
    """All methods' rows, and (method, status) of each source: read, absent, or lacking a column."""
    found, report = None, []
    for s in sources:
        try:
            df = spark.read.option("header", True).csv(s.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            report.append((s.method, "absent"))
            continue
        name = next((p for p in s.prediction if p in df.columns), None)
        if name is None or not {s.drug, s.cell} <= set(df.columns):
            report.append((s.method, "lacks a column"))
            continue
        report.append((s.method, "read"))
        rows = normalised(df, s.drug, s.cell, name, s.method)
        found = rows if found is None else found.unionByName(rows)
    empty = spark.createDataFrame([], "drug_name string, cell_line string, prediction double, method string")
    return found if found is not None else empty, spark.createDataFrame(report, "method string, status string")


def pivoted(rows: DataFrame, methods: Sequence[str], label: str | None = None) -> DataFrame:
    """A row for each (cell_line, drug_name), a column for each method; repeats are averaged, absent methods are null. With a label, its mean over all rows of the pair too; pairs that only have rows without a number are left out.

    Rows are dealt by pair to tasks whose number grows with the rows, so that no task's table
    of pairs does; hardly any pair repeats, so rows are not combined before that.
    """
    mine, beside = F.col("method").isin(*methods), [label] if label else []
    found = rows if label else rows.where(mine)
    spark = rows.sparkSession
    tasks = max(-(-found.count() // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = found.select("cell_line", "drug_name", "method", "prediction", *beside).repartition(tasks, "cell_line", "drug_name")
    of = [F.avg(F.when(F.col("method") == m, F.col("prediction"))).alias(m) for m in methods]
    if not label:
        return dealt.groupBy("cell_line", "drug_name").agg(*of)
    some = F.count(F.when(mine, F.col("prediction"))).alias("_some")
    return dealt.groupBy("cell_line", "drug_name").agg(*of, F.avg(label).alias(label), some).where("_some > 0").drop("_some")


def medians(wide: DataFrame, methods: Sequence[str]) -> DataFrame:
    """One row of exact medians med_<method>.

    Each turn counts the values between two bounds in BINS steps, with each step's least and
    largest value, and goes on in the step that holds the middle one, until that has one value
    only. So a turn is one pass with counts of fixed size, whatever the number of rows.
    """
    spark = wide.sparkSession
    ends = wide.agg(*(f(F.col(m).cast("double")).alias(f"{n}_{m}") for m in methods for n, f in (("n", F.count), ("low", F.min), ("high", F.max)))).first()
    # (method, rank) -> bounds and the number of values under them
    open_ = {(m, r): (ends[f"low_{m}"], ends[f"high_{m}"], 0) for m in methods if (n := ends[f"n_{m}"]) for r in {(n - 1) // 2, n // 2}}
    found: dict[tuple[str, int], float] = {}
    while True:
        found |= {key: low for key, (low, high, _) in open_.items() if low == high}
        open_ = {key: v for key, v in open_.items() if v[0] != v[1]}
        if not open_:
            break
        bounds = spark.createDataFrame([(m, low, high) for m, low, high in {(m, *v[:2]) for (m, _), v in open_.items()}], "method string, low double, high double")
        values = wide.select(F.explode(F.array(*(F.struct(F.lit(m).alias("method"), F.col(m).cast("double").alias("x")) for m in {m for m, _ in open_}))).alias("v")).select("v.*").where("x is not null")
        inside = values.join(F.broadcast(bounds), "method").where("low <= x and x <= high")  # a row or two for each method
        step = F.least(F.floor((F.col("x") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * BINS), F.lit(BINS - 1))
        counts: dict[tuple, list] = {}
        for r in inside.groupBy("method", "low", "high", step.alias("step")).agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most")).collect():
            counts.setdefault((r["method"], r["low"], r["high"]), []).append((r["step"], r["n"], r["least"], r["most"]))
        for (m, rank), (low, high, under) in open_.items():
            for _, n, least, most in sorted(counts[(m, low, high)]):
                if rank < under + n:
                    open_[(m, rank)] = (least, most, under)
                    break
                under += n
    middle = {m: [v for (name, _), v in found.items() if name == m] for m in methods}
    row = [sum(v) / len(v) if v else None for v in middle.values()]
    return spark.createDataFrame([row], ", ".join(f"`med_{m}` double" for m in methods))


def imputed(wide: DataFrame, methods: Sequence[str], label: str | None = None) -> DataFrame:
    """Nulls as the method's exact median, or 0 where it has none; a label stays as it is. The wide table is computed once."""
    beside = [label] if label else []
    wide = kept(wide.select("cell_line", "drug_name", *methods, *beside), "wide")
    filled = wide.join(F.broadcast(medians(wide, methods)))  # one row
    return filled.select("cell_line", "drug_name", *(F.coalesce(m, f"med_{m}", F.lit(0.0)).alias(m) for m in methods), *beside)


def mean_of(methods: Sequence[str]) -> Column:
    """Mean of the methods that are not null."""
    total = sum((F.coalesce(m, F.lit(0.0)) for m in methods), F.lit(0.0))
    n = sum((F.col(m).isNotNull().cast("int") for m in methods), F.lit(0))
    return total / F.nullif(n, F.lit(0))


def top_k(scores: DataFrame, k: int, score: str = "score", cell: str = "cell_line", drug: str = "drug_name") -> DataFrame:
    """The k lowest scores of each cell line, ties by drug name."""
    w = Window.partitionBy(cell).orderBy(F.col(score).asc(), F.col(drug).asc())
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def forest(wide: DataFrame, methods: Sequence[str], label: str, trees: int = 20, depth: int = 5, seed: int = 7):
    """A random forest over the methods' columns in their order."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    steps = [VectorAssembler(inputCols=list(methods), outputCol="features"), RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="ensemble_score", numTrees=trees, maxDepth=depth, seed=seed)]
    return Pipeline(stages=steps).fit(wide)


def drawn(tree: int, seed: int) -> Column:
    """How often a tree's bootstrap takes a pair: Poisson's count by the pair's hash, so that it does not depend on how the table is cut."""
    x = F.xxhash64("cell_line", "drug_name", F.lit(seed), F.lit(tree))
    upto = [sum(exp(-1) / factorial(j) for j in range(k + 1)) for k in range(MOST_DRAWN)]
    count = F.when(x < int((upto[0] - 0.5) * 2**64), 0)
    for k in range(1, MOST_DRAWN):
        count = count.when(x < min(int((upto[k] - 0.5) * 2**64), 2**63 - 1), k)
    return count.otherwise(MOST_DRAWN)


def forest_of_groups(wide: DataFrame, methods: Sequence[str], label: str, trees: int = 20, depth: int = 5, seed: int = 7):
    """A random forest as `forest` grows it, of (cell_line, drug_name, methods, label), from sums over rows with equal features.

    Such rows are on the same side of every split, so a tree needs of them how often its
    bootstrap takes them and the mean of their labels as often. A pass draws counts row by row
    for AT_ONCE trees; the trees are then grown from tables that have each feature row once.
    Where features hardly repeat, rows are learned from one by one. Rows without a label are
    not learned from.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor

    rows = wide.where(F.col(label).isNotNull())
    n, distinct = rows.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(*methods))).first()
    if n < EQUAL_ROWS * distinct:
        return forest(kept(rows.select(*methods, label), "learned"), methods, label, trees, depth, seed)
    assembled = VectorAssembler(inputCols=list(methods), outputCol="features")

    def counted(low: int) -> DataFrame:
        some = range(low, min(low + AT_ONCE, trees))
        counts = rows.select(*methods, label, *(drawn(t, seed).alias(f"w{t}") for t in some))
        sums = (F.sum(c).alias(name) for t in some for name, c in ((f"n{t}", F.col(f"w{t}")), (f"s{t}", F.col(f"w{t}") * F.col(label))))
        return kept(counts.groupBy(*methods).agg(*sums), "groups")

    def grown(tree: int):
        n, total = F.col(f"n{tree}"), F.col(f"s{tree}")
        table = tables[tree // AT_ONCE].where(n > 0).select(*methods, (total / n).alias(label), n.cast("double").alias("weight")).coalesce(-(-distinct // GROUP_ROWS))
        one = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=1, bootstrap=False, featureSubsetStrategy="onethird", maxDepth=depth, seed=seed + tree, weightCol="weight")
        return one.fit(assembled.transform(table)).trees[0]

    tables = [counted(low) for low in range(0, trees, AT_ONCE)]
    with ThreadPool(BESIDE) as pool:
        grown_ = pool.map(grown, range(trees))
    sc = wide.sparkSession.sparkContext
    regression = sc._jvm.org.apache.spark.ml.regression
    array = sc._gateway.new_array(regression.DecisionTreeRegressionModel, trees)
    for t, tree in enumerate(grown_):
        array[t] = tree._java_obj
    whole = regression.RandomForestRegressionModel(f"forest_{seed}", array, len(methods))
    whole.set(whole.getParam("numTrees"), trees)
    model = RandomForestRegressionModel(whole)
    return PipelineModel([assembled, model.setFeaturesCol("features").setPredictionCol("ensemble_score")])


NODES = "tree int, node int, feature int, threshold double, low int, high int, prediction double"


def tree_nodes(model) -> list[tuple]:
    """Nodes of a fitted forest as rows of NODES: each tree's are numbered from its root, 0; feature is a place in the model's order; values up to the threshold go to low, others to high; a leaf has neither."""
    rows: list[tuple] = []

    def walk(tree: int, node, number: int, free: int) -> int:
        """Adds a node and all under it; free: the next number, which it returns."""
        if node.getClass().getSimpleName() == "LeafNode":
            rows.append((tree, number, None, None, None, None, node.prediction()))
            return free
        low, high = free, free + 1
        rows.append((tree, number, node.split().featureIndex(), node.split().threshold(), low, high, None))
        return walk(tree, node.rightChild(), high, walk(tree, node.leftChild(), low, free + 2))

    for k, tree in enumerate(model.stages[-1].trees):
        walk(k, tree._java_obj.rootNode(), 0, 1)
    return rows


def save_trees(spark: SparkSession, nodes: Sequence[tuple], methods: Sequence[str], path: str) -> None:
    """A forest as two tables: its nodes, and the methods in the order of its features."""
    spark.createDataFrame(list(nodes), NODES).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame(list(enumerate(methods)), "feature int, method string").write.mode("overwrite").parquet(f"{path}/features")


def scored_by_trees(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """As `scored_by`, for a forest that is a table of nodes: its rows are of fixed number, become one array for each tree and are gone down by a fold over the depth, all in the JVM."""
    features = spark.read.parquet(f"{path}/features").orderBy("feature").collect()
    methods = [r["method"] for r in features]
    nodes = spark.read.parquet(f"{path}/nodes")
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("node", "feature", "threshold", "low", "high", "prediction"))).alias("nodes"))
    forest_ = trees.agg(F.collect_list("nodes").alias("trees"))  # one row
    deepest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0]
    wide = imputed(pivoted(rows.withColumn("method", F.translate("method", "-", "_")), methods), methods)
    values = F.array(*(F.col(m).cast("double") for m in methods))

    def leaf(tree: Column, x: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            return F.when(node["feature"].isNull(), at).when(F.get(x, node["feature"]) <= node["threshold"], node["low"]).otherwise(node["high"])

        return F.get(tree, F.aggregate(F.sequence(F.lit(1), F.lit(max(1, (deepest or 1) // 2))), F.lit(0), down))["prediction"]

    mean = F.aggregate("trees", F.lit(0.0), lambda total, tree: total + leaf(tree, F.col("values")), lambda total: total / F.size("trees"))
    scored = wide.withColumn("values", values).join(F.broadcast(forest_))
    return scored.select("cell_line", "drug_name", mean.alias("ensemble_score"))


def save_model(model, path: str) -> None:
    """A fitted model with the order of its features."""
    model.write().overwrite().save(path)


def scored_by(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """(cell_line, drug_name, ensemble_score) of prediction rows under a stored model: its methods in its order, `-` in a method's name as `_`, other methods left out, gaps filled as in `imputed`."""
    from pyspark.ml import PipelineModel

    methods = list(PipelineModel.load(path).stages[0].getInputCols())
    named = rows.withColumn("method", F.translate("method", "-", "_"))
    return scored_wide(path, imputed(pivoted(named, methods), methods))


def scored_wide(path: str, filled: DataFrame) -> DataFrame:
    """(cell_line, drug_name, ensemble_score) of a wide table without gaps under a stored model."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path).transform(filled).select("cell_line", "drug_name", "ensemble_score")
