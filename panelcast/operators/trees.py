"""Tree ensembles on ``flat ++ one-hot(id)``, saved in columnar form and walked as JVM expressions.

An ensemble is a table with one row per node: ``horizon, tree, node, feature, threshold, left, right, value``.
Node 0 is a tree's root; a leaf has no ``left`` and gives ``value``; an inner node sends a row to ``left`` if
its feature is at most ``threshold``, else to ``right``, and so a NULL or NaN feature (``missing_left`` says
otherwise). The prediction of a horizon is the sum over its trees, plus the ensemble's ``base``.

Features 0 .. width-1 are the flat window; feature ``width + i`` is the one-hot member of entity id ``i``. It is
compared, never built, so neither a row nor a plan grows with the number of entities.

:func:`tree_scores` reads the model (its size is that of the model, checked against :data:`MOST_NODES`) into
literal arrays and walks every tree in ``aggregate`` steps: built-in functions only, no Python in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = ("horizon int, tree int, node int, feature int, threshold double, left int, right int, value double, "
               "missing_left boolean")
MOST_NODES = 1_000_000


def save_ensemble(nodes: DataFrame, path: str) -> None:
    """Parquet, one file per horizon's part; readable by any engine."""
    nodes.select(*[c.split()[0] for c in NODE_SCHEMA.split(", ")]).write.mode("overwrite").partitionBy("horizon").parquet(path)


def load_ensemble(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NODE_SCHEMA).parquet(path)


def check_ensemble(nodes: DataFrame) -> list:
    """The model's rows on the driver, by horizon, tree and node. Raises if a tree is not one: a child that is missing or
    has two parents, an inner node without a feature, a leaf without a value, or more nodes than :data:`MOST_NODES`."""
    rows = nodes.orderBy("horizon", "tree", "node").limit(MOST_NODES + 1).collect()
    if len(rows) > MOST_NODES:
        raise ValueError(f"an ensemble of more than {MOST_NODES} nodes")
    trees: dict[tuple[int, int], dict[int, object]] = {}
    for r in rows:
        if r.node in trees.setdefault((r.horizon, r.tree), {}):
            raise ValueError(f"horizon {r.horizon}, tree {r.tree}: node {r.node} is there twice")
        trees[r.horizon, r.tree][r.node] = r
    for (horizon, tree), own in trees.items():
        where, children = f"horizon {horizon}, tree {tree}", []
        for r in own.values():
            if r.left is None and r.right is None:
                if r.value is None:
                    raise ValueError(f"{where}: leaf {r.node} has no value")
            elif r.feature is None or r.threshold is None or r.left not in own or r.right not in own:
                raise ValueError(f"{where}: node {r.node} is incomplete")
            else:
                children += [r.left, r.right]
        if 0 not in own or len(children) != len(own) - 1 or set(children) != set(own) - {0}:
            raise ValueError(f"{where}: not a tree")
    return rows


def _depth(own: list) -> int:
    """Steps from the root to the deepest leaf."""
    children = {r.node: (r.left, r.right) for r in own if r.left is not None}
    level, depth = [0], 0
    while level := [c for n in level for c in children.get(n, ())]:
        depth += 1
    return depth


def _literal(values: list, kind: str) -> Column:
    return F.lit(values).cast(f"array<{kind}>")


def _prediction(rows: list, flat: Column, entity_id: Column, width: int, base: float) -> Column:
    """The sum of one horizon's trees: nodes of all trees side by side in arrays, each tree walked from its own root."""
    roots, at = [], {}
    for n, r in enumerate(rows):
        at[r.tree, r.node] = n
        if r.node == 0:
            roots.append(n)
    feature = _literal([-1 if r.left is None else r.feature for r in rows], "int")
    threshold = _literal([0.0 if r.threshold is None else r.threshold for r in rows], "double")
    # A leaf leads to itself, so every walk may take as many steps as the deepest tree.
    left = _literal([n if r.left is None else at[r.tree, r.left] for n, r in enumerate(rows)], "int")
    right = _literal([n if r.left is None else at[r.tree, r.right] for n, r in enumerate(rows)], "int")
    value = _literal([0.0 if r.value is None else r.value for r in rows], "double")
    lost = _literal([bool(r.missing_left) for r in rows], "boolean")
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r.tree, []).append(r)
    steps = F.sequence(F.lit(1), F.lit(max(1, *(_depth(own) for own in by_tree.values()))))

    def step(node: Column, _: Column) -> Column:
        wanted = F.get(feature, node)
        x = F.when(wanted < width, F.get(flat, wanted)).otherwise((entity_id == wanted - width).cast("double"))
        goes = F.coalesce(F.when(~F.isnan(x), x <= F.get(threshold, node)), F.get(lost, node))
        return F.when(wanted < 0, node).when(goes, F.get(left, node)).otherwise(F.get(right, node))

    return F.aggregate(_literal(roots, "int"), F.lit(float(base)),
                       lambda total, root: total + F.get(value, F.aggregate(steps, root, step)))


def tree_scores(df: DataFrame, nodes: DataFrame, width: int, keys: list[str], flat: str = "flat", id_col: str = "entity_id",
                name: str = "trees", base: dict[int, float] | None = None) -> DataFrame:
    """``keys, model, horizon, y``: the ensembles' predictions, one row for each horizon."""
    by_horizon: dict[int, list] = {}
    for r in check_ensemble(nodes):
        by_horizon.setdefault(r.horizon, []).append(r)
    if not by_horizon:
        raise ValueError("the ensemble has no trees")
    scored = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(h).alias("horizon"),
                                _prediction(rows, F.col(flat), F.col(id_col), width, (base or {}).get(h, 0.0)).alias("y"))
                       for h, rows in sorted(by_horizon.items())])
    return df.select(*keys, F.inline(scored))


def from_spark_ml(spark: SparkSession, saved: dict[int, str]) -> DataFrame:
    """The node table of saved Spark ML tree models (gradient-boosted, forest or one tree), one for each horizon.

    Reads the models' own Parquet; weights of the trees are multiplied into the leaves, a forest's mean likewise.
    """
    out = None
    for horizon, path in sorted(saved.items()):
        data = spark.read.parquet(f"{path}/data")
        if "nodeData" in data.columns:                       # an ensemble
            data = data.select("treeID", "nodeData.*")
            meta = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weights")
            kind = spark.read.text(f"{path}/metadata").first()[0]
            share = F.lit(1.0) if "GBT" in kind else F.lit(1.0) / F.lit(float(meta.count()))
            weights = meta.select("treeID", (F.col("weights") * share).alias("weight"))
            data = data.join(F.broadcast(weights), "treeID")         # one row for each tree of the model
        else:
            data = data.withColumns({"treeID": F.lit(0), "weight": F.lit(1.0)})
        leaf = F.col("leftChild") < 0
        limit, kinds = F.col("split.leftCategoriesOrThreshold"), F.col("split.numCategories")
        # A split of a binary feature (the one-hot members) names the value that goes left: 0 is a threshold, 1 its mirror.
        binary = (kinds == 2) & (F.size(limit) == 1)
        mirrored = binary & (limit[0] == 1.0)
        left, right = F.col("leftChild"), F.col("rightChild")
        rows = data.select(
            F.lit(horizon).alias("horizon"), F.col("treeID").cast("int").alias("tree"), F.col("id").cast("int").alias("node"),
            F.when(~leaf, F.col("split.featureIndex")).cast("int").alias("feature"),
            F.when(~leaf, F.when(binary, F.lit(0.5)).otherwise(limit[0])).alias("threshold"),
            F.when(~leaf, F.when(mirrored, right).otherwise(left)).cast("int").alias("left"),
            F.when(~leaf, F.when(mirrored, left).otherwise(right)).cast("int").alias("right"),
            F.when(leaf, F.col("prediction") * F.col("weight")).alias("value"), F.lit(False).alias("missing_left"),
            F.assert_true(leaf | binary | (kinds == -1), F.lit("a split on several categories")).alias("_checked"))
        rows = rows.where(F.col("_checked").isNull()).drop("_checked")
        out = rows if out is None else out.unionByName(rows)
    return out
