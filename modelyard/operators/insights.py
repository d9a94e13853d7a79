"""Explanation, causal effect, error analysis and counterfactual tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..spec import FeatureSpec
from ..session import cut_lineage, stored
from .models import forests_of
from .position import hash_position, running_total

# Request of the counterfactual step.
COUNTERFACTUALS = 10
DESIRED_RANGE = (16.0, 30.0)  # of predictions, in units of the reference target


@dataclass(frozen=True)
class InsightContext:
    """What every insight needs: the contract, the scored test rows, and the training rows
    and the identity of the model that scored them."""

    title: str
    spec: FeatureSpec
    categoricals: tuple[str, ...]
    scored: DataFrame
    prediction: str = "prediction"
    task_type: str = "regression"
    model: str = ""
    train: DataFrame | None = None

    @classmethod
    def build(cls, scored: DataFrame, spec: FeatureSpec, categoricals: Sequence[str], **more):
        context = cls(spec=spec, categoricals=tuple(categoricals), scored=scored, **more)
        if context.task_type != "regression":
            raise ValueError(f"unknown task type: {context.task_type}")
        spec.require(scored)
        spec.require(scored, (context.prediction,))
        if context.train is not None:
            spec.require(context.train)
        unknown = set(context.categoricals) - set(spec.features)
        if unknown:
            raise ValueError(f"categoricals outside the contract: {sorted(unknown)}")
        scored.persist(StorageLevel.MEMORY_AND_DISK)
        return context

    def describe(self) -> DataFrame:
        """One row: what is explained, by which model, over how many scored and training rows."""
        rows = F.lit(None).cast("bigint") if self.train is None else self.train.agg(F.count(F.lit(1))).scalar()
        return self.scored.agg(
            F.lit(self.title).alias("title"),
            F.lit(self.task_type).alias("task_type"),
            F.lit(self.model).alias("model"),
            F.max(rows).alias("train_rows"),
            F.lit(self.spec.target).alias("target"),
            F.lit(",".join(self.categoricals)).alias("categoricals"),
            F.lit(len(self.spec.features)).alias("features"),
            F.count(F.lit(1)).alias("n"),
            F.avg(self.prediction).alias("mean_prediction"),
        )

    def release(self) -> None:
        self.scored.unpersist()


def model_importance(model, spec: FeatureSpec) -> list[tuple[str, float]]:
    """Impurity importances of a fitted forest, in contract order: the mean over all its trees."""
    forests = forests_of(model)
    trees = sum(forest.getNumTrees for forest in forests)
    shares = sum(forest.featureImportances.toArray() * (forest.getNumTrees / trees) for forest in forests)
    return list(zip(spec.features, shares.tolist()))


def permutation_importance(
    df: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    target: str,
    predict: Callable[[DataFrame, str], DataFrame],
    seed: object = 0,
) -> DataFrame:
    """(feature, mse, permuted_mse, importance): growth of the squared error when a
    feature is taken from a randomly matched row.

    All features share one random match: rows are placed in a hash order once and kept,
    and the donor of a row is the next one in that order, the first for the last.
    """
    rows = cut_lineage(hash_position(df.select(*key, *features, target), key, f"{seed}-rows", "_pos"))
    size = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    donors = rows.select(
        F.when(F.col("_pos") == 1, size).otherwise(F.col("_pos") - 1).alias("_pos"),
        *[F.col(f).alias(f"_donor_{f}") for f in features],
    )
    wide = predict(rows.join(donors, "_pos"), "_base")
    for f in features:
        swapped = wide.withColumns({"_own": F.col(f), f: F.col(f"_donor_{f}")})
        wide = predict(swapped, f"_with_{f}").withColumn(f, F.col("_own")).drop("_own")

    def squared(prediction: str) -> Column:
        return F.avg((F.col(target) - F.col(prediction)) * (F.col(target) - F.col(prediction)))

    errors = wide.agg(
        squared("_base").alias("mse"), *[squared(f"_with_{f}").alias(f"_{f}") for f in features]
    )
    listed = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f"_{f}").alias("permuted_mse")) for f in features]
    )
    return errors.select("mse", F.inline(listed)).select(
        "feature", "mse", "permuted_mse", (F.col("permuted_mse") - F.col("mse")).alias("importance")
    )


def causal_effect(
    df: DataFrame,
    outcome: str,
    treatments: Sequence[str],
    controls: Sequence[str],
    heterogeneity: Sequence[str] = (),
) -> DataFrame:
    """(treatment, segment, level, n, effect): slope of the outcome on a treatment
    after both are centred inside each cell of the discrete controls.

    The slope of cell residuals is the sum of n * covariance over the sum of
    n * variance, so cells are aggregated once and no row is centred.
    """
    outside = set(heterogeneity) - set(controls)
    if outside:
        raise ValueError(f"heterogeneity features must be controls: {sorted(outside)}")
    y = F.col(outcome).cast("double")
    sums = [F.count(F.lit(1)).alias("_n")]
    for t in treatments:
        x = F.col(t).cast("double")
        sums += [F.covar_pop(y, x).alias(f"_cov_{t}"), F.var_pop(x).alias(f"_var_{t}")]
    cells = df.groupBy(*controls).agg(*sums)
    segments = [F.struct(F.lit("all").alias("segment"), F.lit("all").alias("level"))] + [
        F.struct(F.lit(h).alias("segment"), F.col(h).cast("string").alias("level"))
        for h in heterogeneity
    ]
    per_treatment = F.array(
        *[
            F.struct(
                F.lit(t).alias("treatment"),
                (F.col("_n") * F.col(f"_cov_{t}")).alias("top"),
                (F.col("_n") * F.col(f"_var_{t}")).alias("bottom"),
            )
            for t in treatments
        ]
    )
    spread = cells.withColumn("_t", per_treatment).select("_n", "_t", F.inline(F.array(*segments)))
    return (
        spread.select("_n", "segment", "level", F.inline("_t"))
        .groupBy("treatment", "segment", "level")
        .agg(
            F.sum("_n").alias("n"),
            F.try_divide(F.sum("top"), F.sum("bottom")).alias("effect"),
        )
    )


def _product_blocks(folds: int) -> Callable:
    """Arrow function from (fold, columns …) to a task's dense blocks: per fold the number of
    rows, the means and the products about these means, of a leading 1 and all columns."""

    def run(batches):
        n = mean = product = None
        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(len(fold)), *[c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]])
            if n is None:
                n, mean, product = np.zeros(folds, dtype="int64"), np.zeros((folds, z.shape[1])), np.zeros((folds, z.shape[1], z.shape[1]))
            for k in np.unique(fold):
                own = z[fold == k]
                centre = own.mean(axis=0)
                off, gap, total = own - centre, centre - mean[k], n[k] + len(own)
                product[k] += off.T @ off + np.outer(gap, gap) * (n[k] * len(own) / total)
                mean[k] += gap * len(own) / total
                n[k] = total
        for k in [] if n is None else np.flatnonzero(n):
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array([k], pa.int32()), "n": [n[k]], "mean": [mean[k].tolist()], "product": [product[k].ravel().tolist()],
            })

    return run


def _products(rows: DataFrame, folds: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The means of all columns, and per fold the products of a leading 1 and the centred columns.

    The rows are read once. Blocks are moved to the common centre before they are added, so
    sums keep their digits; the driver gets folds * (width + 1)^2 numbers.
    """
    blocks = cut_lineage(rows.mapInArrow(_product_blocks(folds), "fold int, n bigint, mean array<double>, product array<double>"))
    means = {
        r["place"]: r["mean"] for r in blocks.select("n", F.posexplode("mean").alias("place", "m"))
        .groupBy("place").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean")).collect()
    }
    if not means:
        raise ValueError("no rows to estimate an effect from")
    centre = np.array([0.0, *[means[i] for i in range(1, width + 1)]])  # the leading 1 stays
    c, size = F.array(*[F.lit(float(x)) for x in centre]), F.lit(width + 1)

    def gap(at: Column) -> Column:
        return F.get("mean", at) - F.get(c, at)

    moved = F.transform("product", lambda p, at: p + F.col("n") * gap((at / size).cast("int")) * gap(at % size))
    sums = blocks.select("fold", F.posexplode(moved).alias("place", "p")).groupBy("fold", "place").agg(F.sum("p").alias("p"))
    gram = np.zeros((folds, (width + 1) ** 2))
    for r in sums.collect():
        gram[r["fold"], r["place"]] = r["p"]
    return centre[1:], gram.reshape(folds, width + 1, width + 1)


def _coefficients(gram: np.ndarray, target: int, controls: list[int]) -> np.ndarray:
    """Least squares from products; columns are scaled alike first, and those that others make up count once."""
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    even = gram / np.outer(scale, scale)
    b = np.linalg.lstsq(even[np.ix_(controls, controls)], even[controls, target], rcond=1e-10)[0]
    return b * scale[target] / scale[controls]


def causal_effect_residual(
    df: DataFrame,
    key: Sequence[str],
    outcome: str,
    treatments: Sequence[str],
    features: Sequence[str],
    heterogeneity: Sequence[str] = (),
    folds: int = 2,
) -> DataFrame:
    """(treatment, segment, level, n, effect) with all other features as controls.

    Outcome and treatment are each regressed on the controls, on the rows of the other
    folds, and the effect is the slope between the residuals of the fold's own rows. The rows are
    made once and stored, so what `df` joins is joined once for the two passes. One pass makes a
    dense block of products per task, from which every regression is solved; a second pass takes
    the residuals. Rows without a number in one of the columns are left out.
    """
    columns = [*features, outcome]
    fold = F.pmod(F.xxhash64(*key), F.lit(folds)).cast("int")
    rows = df.select(
        fold.alias("_fold"), *heterogeneity_columns(heterogeneity), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]
    )
    names = [f"_x{i}" for i in range(len(columns))]
    for name in names:
        rows = rows.where(F.col(name).isNotNull() & ~F.isnan(name))
    rows = stored(rows, "residual-rows")
    centre, gram = _products(rows.select("_fold", *names), folds, len(columns))
    z = [F.lit(1.0), *[F.col(name) - F.lit(float(m)) for name, m in zip(names, centre)]]
    whole = gram.sum(axis=0)

    def residual(target: int, controls: list[int]) -> Column:
        """What the controls leave of a column, with the coefficients of the other folds."""
        out = F.lit(None).cast("double")
        for k in range(folds):
            b = _coefficients(whole - gram[k], target, controls)
            fit = reduce(lambda a, x: a + x, [F.lit(float(c)) * z[i] for c, i in zip(b, controls)])
            out = F.when(F.col("_fold") == k, z[target] - fit).otherwise(out)
        return out

    y, parts = len(columns), []
    for t in treatments:
        at = 1 + columns.index(t)
        controls = [0, *[1 + columns.index(f) for f in features if f != t]]
        parts.append(F.struct(
            F.lit(t).alias("treatment"), residual(y, controls).alias("ry"), residual(at, controls).alias("rt")
        ))
    segments = [F.struct(F.lit("all").alias("segment"), F.lit("all").alias("level"))] + [
        F.struct(F.lit(h).alias("segment"), F.col(f"_h_{h}").alias("level")) for h in heterogeneity
    ]
    spread = rows.select(F.array(*segments).alias("_s"), F.inline(F.array(*parts))).select(
        "treatment", "ry", "rt", F.inline("_s")
    )
    return spread.groupBy("treatment", "segment", "level").agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.sum(F.col("ry") * F.col("rt")), F.sum(F.col("rt") * F.col("rt"))).alias("effect"),
    )


def heterogeneity_columns(names: Sequence[str]) -> list[Column]:
    return [F.col(h).cast("string").alias(f"_h_{h}") for h in names]


def error_analysis(
    df: DataFrame, real: str, predicted: str, widths: Mapping[str, float]
) -> DataFrame:
    """Bins of the filter features with subtotals: rows, mse and share of the error.

    The rows are reduced to bin cells first; the cube runs over the cells.
    """
    error = F.col(real) - F.col(predicted)
    bins = [F.floor(F.col(f) / w).cast("bigint").alias(f"{f}_bin") for f, w in widths.items()]
    names = [f"{f}_bin" for f in widths]
    cells = df.groupBy(*bins).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(error * error).alias("_se")
    )
    # The total asks for the same columns as the cube, so both share one shuffle.
    total = cells.agg(F.struct(F.sum("_n").alias("n"), F.sum("_se").alias("se"))).scalar()
    return (
        cells.cube(*names)
        .agg(F.sum("_n").alias("n"), F.sum("_se").alias("_se"))
        .withColumn("_total", total)
        .select(
            *names, "n",
            (F.col("_se") / F.col("n")).alias("mse"),
            F.coalesce(F.try_divide(F.col("_se"), F.col("_total.se")), F.lit(0.0)).alias("error_share"),
        )
    )


def counterfactuals(
    scored: DataFrame,
    key: str,
    vary: Mapping[str, object],
    fixed: Sequence[str],
    low: object,
    high: object,
    prediction: str = "prediction",
    count: int = COUNTERFACTUALS,
) -> DataFrame:
    """Nearest observed values of one feature that bring the prediction into range.

    For each row outside [low, high] and each feature in `vary` (feature -> scale),
    the candidates are the observed values of that feature among rows in range that
    agree on all other features. The `count` nearest by scaled distance are kept.

    Values are ranked once in a global order, so the nearest ones of a row lie at
    known ranks around it: each profile asks for at most 2 * count ranks by
    equi-join, and no pair of rows is ever tried in vain.
    """
    inside = F.coalesce(F.col(prediction).between(low, high), F.lit(False))
    views = []
    for f in vary:
        others = [*fixed, *[o for o in vary if o != f]]
        block = F.to_json(F.struct(*others), {"ignoreNullFields": "false"})  # quoted, so values cannot run together
        views.append(
            F.struct(
                F.lit(f).alias("feature"), block.alias("block"),
                F.col(f).cast("double").alias("value"),
            )
        )
    spread = scored.select(F.col(key), inside.alias("_in"), F.inline(F.array(*views)))
    place = ["feature", "block", "value"]
    profiles = spread.groupBy(*place).agg(
        F.sum(F.col("_in").cast("int")).alias("support"),
        F.max((~F.col("_in")).cast("int")).alias("_asks"),
        F.min(F.when(F.col("_in"), F.col(key))).alias("example"),
    )
    flagged = profiles.withColumn("_cand", (F.col("support") > 0).cast("int"))
    ranked = running_total(flagged, place, "_cand", "_rank")
    candidates = ranked.where(F.col("_cand") == 1).select(
        "feature", "block", F.col("value").alias("new_value"), "support", "example", "_rank"
    )
    # Kept before they meet the rows, so that hot blocks and profiles can be split in the joins.
    spans = cut_lineage(
        candidates.groupBy("feature", "block").agg(F.min("_rank").alias("_lo"), F.max("_rank").alias("_hi"))
    )
    asks = ranked.where(F.col("_asks") == 1).join(spans, ["feature", "block"])
    near = F.sequence(
        F.greatest(F.col("_rank") - (count - 1), F.col("_lo")),
        F.least(F.col("_rank") + count, F.col("_hi")),
    )
    wanted = asks.select(*place, F.explode(near).alias("_rank"))
    scale = F.lit(None).cast("double")
    for f, s in vary.items():
        s = s if isinstance(s, Column) else F.lit(float(s))
        scale = F.when(F.col("feature") == f, s).otherwise(scale)
    found = wanted.join(candidates.drop("feature", "block"), "_rank").withColumn("_scale", scale)
    distance = F.abs(F.col("value") - F.col("new_value")) / F.col("_scale")
    choice = F.struct(distance.alias("distance"), "feature", "new_value", "example", "support")
    answers = cut_lineage(
        found.groupBy(*place).agg(F.slice(F.array_sort(F.collect_list(choice)), 1, count).alias("_near"))
    )
    outside = spread.where(~F.col("_in")).join(answers, place)
    best = outside.groupBy(key).agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("_near"))), 1, count).alias("_best")
    )
    ranks = F.transform(
        "_best",
        lambda c, i: F.struct(
            (i + 1).alias("rank"), c["feature"].alias("feature"),
            c["new_value"].alias("new_value"), c["distance"].alias("distance"),
            c["example"].alias("example"), c["support"].alias("support"),
        ),
    )
    return best.select(key, F.inline(ranks))


def prediction_range(scored: DataFrame, prediction: str = "prediction", spread: float = 0.25) -> tuple[Column, Column]:
    """The whole numbers next to the mean prediction less and plus a share of its deviation,
    as scalars of the plan that uses them."""
    mean, wide = F.avg(prediction), F.coalesce(F.stddev(prediction), F.lit(0.0)) * spread
    return scored.agg(F.round(mean - wide)).scalar(), scored.agg(F.round(mean + wide)).scalar()


def nearest_counterfactuals(
    scored: DataFrame,
    key: str,
    vary: Mapping[str, float],
    fixed: Sequence[str],
    low: object,
    high: object,
    prediction: str = "prediction",
    count: int = COUNTERFACTUALS,
) -> DataFrame:
    """(key, rank, new_<feature>..., distance, n_changed, example, support): nearest observed
    profiles, over all varied features together, that bring the prediction into range.

    A profile is a distinct combination of the features in `vary` (feature -> scale) within a
    block of rows that agree on `fixed`. Candidates are the profiles with rows in
    [low, high]; for every row outside the `count` nearest by scaled L1 distance are kept,
    ties in the order of their values, with the smallest key and the number of their rows.

    A block is a grid of cells that hold about `count` candidates each. A profile meets the
    candidates of its own cell and of the ring of cells around it by equi-join; all others
    are more than a cell away. If the last distance kept lies within a cell the answer is
    exact and final, else the profile goes on to a grid with cells twice as wide. Rows of
    one profile are searched once. A row without a prediction, or with a varied feature that
    is null or no finite number, takes no part; a block without candidates has no answers.
    """
    features = list(vary)
    inside = F.coalesce(F.col(prediction).between(low, high), F.lit(False))
    block = F.to_json(F.struct(*fixed), {"ignoreNullFields": "false"}) if fixed else F.lit("")
    values = [F.col(f).cast("double").alias(f"_v{i}") for i, f in enumerate(features)]
    place = ["_block", *[f"_v{i}" for i in range(len(features))]]
    known = scored.select(F.col(key), inside.alias("_in"), block.alias("_block"), *values).where(
        F.col(prediction).isNotNull() & reduce(lambda a, b: a & b, [F.abs(F.col(f).cast("double")) < np.inf for f in features])
    )
    profiles = cut_lineage(known.groupBy(*place).agg(
        F.sum(F.col("_in").cast("long")).alias("support"), F.max(~F.col("_in")).alias("_asks"),
        F.min(F.when(F.col("_in"), F.col(key))).alias("example"),
    ))
    scaled = [F.col(f"_v{i}") / F.lit(float(vary[f])) for i, f in enumerate(features)]
    given = F.col("support") > 0
    extent = F.greatest(*[F.max(s) - F.min(s) for s in scaled], F.lit(0.0))
    grids = profiles.groupBy("_block").agg(extent.alias("_extent"), F.sum(given.cast("long")).alias("_total"))
    share = F.pow(F.lit(float(count)) / F.col("_total"), F.lit(1.0 / len(features)))
    grids = cut_lineage(grids.where("_total > 0").select(
        "_block", "_total", F.when(F.col("_extent") > 0, F.col("_extent") * F.least(share, F.lit(1.0))).otherwise(1.0).alias("_cell")
    ))

    def cells(wide: Column) -> list[Column]:
        return [F.floor(s / wide).alias(f"_c{i}") for i, s in enumerate(scaled)]

    candidates = profiles.where(given).join(grids, "_block")
    asks = cut_lineage(profiles.where("_asks").join(grids, "_block").select(*place, "_total", "_cell"))
    named = [F.col(f"_v{i}").alias(f"new_{f}") for i, f in enumerate(features)]
    new = [f"new_{f}" for f in features]
    at = ["_block", *[f"_c{i}" for i in range(len(features))]]
    order = W.partitionBy(*place).orderBy("distance", *new)
    everything = W.partitionBy(*place)
    answers, factor = None, 1.0
    while not asks.isEmpty():
        wide = F.col("_cell") * factor
        held = candidates.select("_block", *cells(wide), *named, "support", "example")
        around = asks.select("*", *cells(wide))
        for i in range(len(features)):
            step = F.explode(F.array(*[F.lit(x).cast("long") for x in (-1, 0, 1)]))
            around = around.withColumn(f"_s{i}", step).withColumn(f"_c{i}", F.col(f"_c{i}") + F.col(f"_s{i}")).drop(f"_s{i}")
        gap = sum(
            (F.abs(F.col(f"_v{i}") - F.col(f"new_{f}")) / F.lit(float(vary[f])) for i, f in enumerate(features)), F.lit(0.0)
        )
        met = around.join(held, at).withColumn("distance", gap).withColumn("rank", F.row_number().over(order))
        best = met.where(F.col("rank") <= count).select(*place, "_total", "_cell", "rank", *new, "distance", "support", "example")
        last = F.max("distance").over(everything)
        enough = F.count(F.lit(1)).over(everything) == F.least(F.col("_total"), F.lit(count))
        near = last <= wide * (1 - 1e-9)
        done = cut_lineage(best.withColumn("_done", enough & (near | (F.col("_total") <= count))).where("_done"))
        found = done.select(*place, "rank", *new, "distance", "support", "example")
        answers = found if answers is None else answers.union(found)
        asks = cut_lineage(asks.join(done.where("rank = 1").select(*place), place, "left_anti"))
        factor *= 2
    outside = known.where(~F.col("_in"))
    if answers is None:
        empty = [F.lit(None).cast("double").alias(n) for n in (*new, "distance")]
        none = [F.lit(0).alias("n_changed"), F.col(key).alias("example"), F.lit(0).cast("long").alias("support")]
        return outside.select(key, F.lit(0).alias("rank"), *empty, *none).where("false")
    changed = sum(
        ((F.col(f"_v{i}") != F.col(f"new_{f}")).cast("int") for i, f in enumerate(features)), F.lit(0)
    )
    return outside.join(answers, place).select(
        key, "rank", *new, "distance", changed.alias("n_changed"), "example", "support"
    )


def counterfactual_importance(found: DataFrame) -> DataFrame:
    """Share of the chosen counterfactuals that change each feature."""
    per_feature = found.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # one row per feature
    return per_feature.select("feature", "n", (F.col("n") / F.sum("n").over(whole)).alias("share"))


def gather(parts: Mapping[str, DataFrame]) -> DataFrame:
    """All insight tables as one, tagged by insight; absent columns are null."""
    frames = [df.select(F.lit(name).alias("insight"), "*") for name, df in parts.items()]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged
