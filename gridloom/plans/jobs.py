"""Cleaning, preparation, search, training and evaluation jobs."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import ref
from gridloom.operators import attribution, clean, growing, importance, metrics, profile, project, ridge, trees
from gridloom.operators.clean import NumericCoder, ensure_numeric
from gridloom.operators.encode import OneHot, encode_on_train
from gridloom.operators.guards import OverlapError, assert_split_disjoint
from gridloom.operators.project import feature_columns, infer_target
from gridloom.operators.search import TRIALS, Param
from gridloom.operators.split import (
    FOLDS,
    SEED,
    SPLIT,
    TEST,
    TEST_FRACTION,
    TRAIN,
    VALIDATION,
    hold_out,
    sample_rows,
    with_validation,
)
from gridloom.sources.models import final_stage, load_coder, load_model, save_coder, save_model, stored_trees
from gridloom.sources.reports import (
    exists,
    read_best_params,
    read_report,
    rename,
    size_of,
    write_importance,
    write_mapping,
    write_report,
)
from gridloom.sources.splits import part, read_splits, write_splits
from gridloom.sources.tables import read_csv, read_parquet, write_table

LOG = logging.getLogger(__name__)

# The target of the modelling jobs, and accepted spellings of model names.
TARGET = "weight-(kg)"
MODEL_ALIASES = {
    "boosted": "boosted",
    "gbt": "boosted",
    "lightgbm": "boosted",
    "lgbm": "boosted",
    "random_forest": "random_forest",
    "randomforest": "random_forest",
    "random-forest": "random_forest",
    "rf": "random_forest",
    "ridge": "ridge",
    "both": "both",
    "all": "all",
}


def resolve_models(choice: str | None) -> tuple[str, ...]:
    """Tree models meant by a choice; nothing or an unknown name means both."""
    name = MODEL_ALIASES.get((choice or "").strip().lower().replace(" ", "-"), "both")
    if name in (trees.FOREST, trees.BOOSTED):
        return (name,)
    return (trees.BOOSTED, trees.FOREST)


def _source(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path)


# --------------------------------------------------------------------------------------------------------------


def clean_table(df: DataFrame) -> DataFrame:
    """P1-P4 in the order of the cleaning job; row-local, so it also runs on a stream."""
    named = project.normalize_names(df)
    return clean.round_columns(clean.binarize(named), clean.ONE_DECIMAL_COLUMNS, 1)


def run_clean(spark: SparkSession, source: str, folder: str, name: str = "dataset_cleaned_final") -> DataFrame:
    """G1: clean a CSV table, write it as Parquet and CSV, return the distribution of the indicator."""
    parquet, _ = write_table(clean_table(read_csv(spark, source)), folder, name)
    return profile.value_counts(read_parquet(spark, parquet), clean.INDICATOR_COLUMN)


def prepare_table(df: DataFrame, target: str, *, fraction: float = TEST_FRACTION, seed: object = SEED,
                  keys: Sequence[str] | None = None, guard: bool = True) -> tuple[DataFrame, OneHot]:
    """G2 on a frame: exact split, encoders fitted on train rows, guard on the raw and the encoded rows.

    The seeded digest order is a shuffle already, so the split needs no separate one. Equal rows encode to equal rows,
    so one pass over the encoded rows guards both; only a failure looks at the raw rows, to say which it was.
    """
    marked = hold_out(df, target, fraction, seed=seed, keys=keys)
    _, encoder = encode_on_train(part(marked, TRAIN))
    held = marked.withColumn("_held", (ref(SPLIT) == TEST).cast("int")).drop(SPLIT)
    encoded = encoder.apply(held)
    encoded = encoded.withColumn(SPLIT, F.when(F.col("_held") == 1, F.lit(TEST)).otherwise(F.lit(TRAIN))).drop("_held")
    if guard:
        try:
            assert_split_disjoint(encoded)
        except OverlapError:
            assert_split_disjoint(marked)
            raise
    return encoded, encoder


def run_prepare(spark: SparkSession, source: str, parquet: str, *, text: str | None = None,
                encoders_json: str | None = None, encoders_csv: str | None = None, target: str = TARGET,
                fraction: float = TEST_FRACTION, seed: object = SEED, keys: Sequence[str] | None = None,
                guard: bool = True) -> DataFrame:
    """Split and encode a cleaned table; return rows per split."""
    encoded, encoder = prepare_table(_source(spark, source), target, fraction=fraction, seed=seed, keys=keys, guard=guard)
    write_splits(encoded, parquet, text)
    if encoders_json and encoders_csv:
        write_mapping(spark, encoder, encoders_json, encoders_csv)
    return read_splits(spark, parquet).groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n_rows"))


# --------------------------------------------------------------------------------------------------------------


def run_search(spark: SparkSession, parquet: str, folder: str, *, models: str | None = None, target: str | None = None,
               trials: int = TRIALS, folds: int = FOLDS, seed: int = SEED, keys: Sequence[str] | None = None,
               drop: Sequence[str] = (), spaces: Mapping[str, Sequence[Param]] | None = None, parallelism: int = 4,
               resume: bool = False) -> dict[str, dict]:
    """Search the chosen tree models on the train rows; one JSON report each.

    With ``resume`` every finished trial is kept in the folder, and a search over the same rows, space and seed that was cut off goes on from there.
    """
    df = read_splits(spark, parquet)
    target = target or infer_target(df.columns)
    train = part(df, TRAIN)
    rows = train.count()
    reports = {}
    for kind in resolve_models(models):
        table, _ = trees.search_trees(train, target, kind, trials=trials, folds=folds, seed=seed, keys=keys, drop=drop,
                                      space=(spaces or {}).get(kind), parallelism=parallelism,
                                      ledger=f"{folder}/trials_{kind}" if resume else None)
        best = metrics.require_best(table)
        reports[kind] = {
            "best_params": trees.best_params(table, best),
            "best_value": best["cv_mse_mean"],
            "data_summary": {"train_rows": rows},
        }
        write_report(spark, reports[kind], f"{folder}/best_{kind}_params.json")
    return reports


def run_importance(spark: SparkSession, parquet: str, json_path: str, *, target: str | None = None,
                   repeats: int = importance.JOB_REPEATS, seed: int = SEED, keys: Sequence[str] | None = None,
                   drop: Sequence[str] = (), params: Mapping[str, Any] | None = None) -> DataFrame:
    """Forest fitted on train rows, importance measured on validation rows, written as JSON."""
    df = read_splits(spark, parquet)
    target = target or infer_target(df.columns)
    full = with_validation(df, target, seed=seed, keys=keys)
    scores = importance_scores(part(full, TRAIN), part(full, VALIDATION), target, repeats=repeats, seed=seed, keys=keys,
                               drop=drop, params=params)
    summary = importance.summarize_importance(scores)
    write_importance(summary, json_path)
    return summary


def importance_scores(train: DataFrame, check: DataFrame, target: str, *, repeats: int = importance.FUNCTION_REPEATS,
                      seed: int = SEED, keys: Sequence[str] | None = None, drop: Sequence[str] = (),
                      params: Mapping[str, Any] | None = None) -> DataFrame:
    """M10 with its forest: numeric frames by the type rules fitted on the train rows."""
    features = [c for c in feature_columns(train, target) if c not in drop]
    plain = train.select(*[ref(c) for c in features], ref(target))
    coder = NumericCoder.fit(plain)
    fit_rows = coder.apply(plain)
    model, _ = trees.fit_trees(fit_rows, target, trees.FOREST, params or {}, seed=seed, features=features)
    fitted = final_stage(model)
    used = fitted.featureImportances.toArray()
    unused = [c for c, v in zip(features, used) if v == 0.0]
    held = coder.apply(check.select(*[ref(c) for c in dict.fromkeys([*(keys or []), *features, target])]))
    return importance.permutation_scores(held, target, features, importance.model_score(fitted), repeats=repeats,
                                         seed=seed, keys=keys, unused=unused)


# --------------------------------------------------------------------------------------------------------------


@dataclass
class Trained:
    """What a training stage leaves behind."""

    path: str | None = None
    model: PipelineModel | None = None
    report: dict | None = None


def run_train(spark: SparkSession, parquet: str, params: Mapping[str, str], outputs: Mapping[str, str], *,
              models: str | None = "both", target: str = TARGET, seed: int = SEED, drop: Sequence[str] = ()
              ) -> dict[str, Trained]:
    """Fit the chosen tree models with stored parameters; store each model and a summary beside it."""
    train = part(read_splits(spark, parquet), TRAIN)
    features = [c for c in feature_columns(train, target) if c not in drop]
    texts = [c for c, t in train.dtypes if t == "string" and c in features]
    if texts:  # P17
        LOG.info("converting %d text columns to numbers: %s", len(texts), ", ".join(texts[:10]))
    plain = train.select(*[ref(c) for c in features], ref(target))
    coder = NumericCoder.fit(plain)
    numeric = coder.apply(plain)
    rows = train.count()
    results: dict[str, Trained] = {}
    blocks = None  # binned once, for all models
    for kind in resolve_models(models):
        if kind not in params or kind not in outputs:
            continue
        chosen = read_best_params(spark, params[kind])
        blocks = blocks or growing.make_blocks(numeric, features, target)
        model, applied = trees.fit_trees(numeric, target, kind, chosen, seed=seed, features=features, blocks=blocks)
        path = save_model(model, outputs[kind])
        save_coder(spark, coder, path)
        report = {
            "model_path": path, "parquet_path": parquet, "params_path": params[kind], "target_column": target,
            "random_state": seed, "training_rows": rows, "best_params": chosen, "parameters": applied,
        }
        write_report(spark, report, f"{path.rstrip('/')}_metrics.json")
        results[kind] = Trained(path, model, report)
    if not results:
        raise RuntimeError("no model was trained; check the choice of models")
    growing.discard(spark, blocks.path)
    return results


def run_baseline(spark: SparkSession, parquet: str, params_path: str, model_path: str, *, optimize: bool = False,
                 train: bool = False, target: str = TARGET, trials: int = TRIALS, folds: int = FOLDS, seed: int = SEED,
                 keys: Sequence[str] | None = None, drop: Sequence[str] = ()) -> Trained:
    """Search the ridge penalty, fit with the stored one, or both when neither is asked for."""
    rows = part(read_splits(spark, parquet), TRAIN)
    both = not optimize and not train
    result = Trained()
    if optimize or both:
        table, _ = ridge.ridge_search(rows, target, trials=trials, folds=folds, seed=seed, keys=keys, drop=drop)
        best, value, summary = ridge.best_ridge(table)
        result.report = {"best_params": best, "best_value": value, "cv_summary": summary}
        write_report(spark, result.report, params_path)
    if train or both:
        alpha = float(read_best_params(spark, params_path).get("alpha", ridge.DEFAULT_ALPHA))
        result.model = ridge.fit_ridge(rows, target, alpha, drop=drop)
        result.path = save_model(result.model, model_path)
    return result


# --------------------------------------------------------------------------------------------------------------


def attribution_report(spark: SparkSession, df: DataFrame, model: PipelineModel, path: str, features: Sequence[str], *,
                       displayed: int = attribution.DISPLAYED, sample: int | None = None, seed: object = SEED,
                       keys: Sequence[str] | None = None) -> dict:
    """Expected value and the strongest features of a stored tree model on a frame."""
    rows = sample_rows(df, sample, seed=seed, keys=keys)
    nodes, weights = stored_trees(spark, model, path)
    values, base = attribution.tree_attributions(rows, [], features, nodes, weights)
    summary = attribution.attribution_summary(attribution.long_attributions(values, [], features))
    top = attribution.top_attributions(summary, n_features=len(features), n_rows=rows.count(), displayed=displayed)
    return {"expected_value": base, "feature_impacts": [r.asDict() for r in top.collect()]}


class EvaluationError(RuntimeError):
    """Models that could not be evaluated as a whole (``failed``: the error of each); ``reports`` has what was written."""

    def __init__(self, failed: Mapping[str, Exception], reports: Mapping[str, dict]):
        super().__init__("; ".join(f"{label}: {type(e).__name__}: {e}" for label, e in failed.items()))
        self.failed, self.reports = dict(failed), dict(reports)


def evaluate_model(spark: SparkSession, parquet: str, model_path: str, *, target: str = TARGET, label: str = "",
                   displayed: int = 0, sample: int | None = None, seed: object = SEED,
                   keys: Sequence[str] | None = None) -> dict:
    """Test metrics of a stored model, and attributions of boosted trees when ``displayed`` is positive.

    Where attributions fail the metrics stand without them; ``shap_error`` then holds the error.
    """
    test = part(read_splits(spark, parquet), TEST)
    feature_columns(test, target)
    model = load_model(model_path)
    is_tree = hasattr(final_stage(model), "treeWeights")
    coder = load_coder(spark, model_path) if is_tree else None
    if coder is not None:
        test = coder.apply(test)
    elif is_tree:  # a model stored without rules was fitted on numbers
        test = ensure_numeric(test)
    scored = trees.score(model, test).select(ref(target).cast("double").alias(target), "prediction").persist()  # two numbers a row, measured several times
    try:
        report = metrics.regression_metrics(scored, target).first().asDict()
    finally:
        scored.unpersist()
    report["shap"] = report["shap_error"] = None
    if displayed > 0 and is_tree and label != trees.FOREST:
        features = model.stages[-2].getInputCols()
        try:
            report["shap"] = attribution_report(spark, test, model, model_path, features, displayed=displayed,
                                                sample=sample, seed=seed, keys=keys)
        except Exception as error:  # the metrics stand without attributions
            LOG.exception("attribution failed for %s", label or model_path)
            report["shap_error"] = error
    return report


def run_evaluate(spark: SparkSession, parquet: str, models: Mapping[str, str], folder: str, *, chosen: str = "all",
                 target: str = TARGET, displayed: int = attribution.DISPLAYED, skip_missing: bool = True) -> dict[str, dict]:
    """Evaluate stored models on the test rows, one JSON report each.

    A missing forest is an error when it alone was asked for. In a group missing models are skipped, unless ``skip_missing`` is
    off; where none is left, that is an error. A model that fails does not stop the others: their reports are written, then
    ``EvaluationError`` is raised. Failed attributions count as such, after the report without them is written.
    """
    wanted = {"all": (trees.BOOSTED, trees.FOREST, "ridge"), "both": (trees.BOOSTED, trees.FOREST)}.get(
        MODEL_ALIASES.get(chosen, chosen), (MODEL_ALIASES.get(chosen, chosen),))
    reports: dict[str, dict] = {}
    failed: dict[str, Exception] = {}
    for label in wanted:
        path = models.get(label)
        if path is None or not exists(spark, path):
            if wanted == (trees.FOREST,):
                raise FileNotFoundError(f"no stored forest at {path}")
            LOG.error("no stored %s model at %s", label, path)
            if not skip_missing:
                failed[label] = FileNotFoundError(f"no stored model at {path}")
            continue
        try:
            found = evaluate_model(spark, parquet, path, target=target, label=label,
                                   displayed=displayed if label == trees.BOOSTED else 0)
        except Exception as error:
            LOG.exception("evaluation failed for %s at %s", label, path)
            failed[label] = error
            continue
        impacts, unexplained = found.pop("shap"), found.pop("shap_error")
        if unexplained is not None:
            failed[label] = unexplained
        reports[label] = {"model_path": path, "parquet_path": parquet, "target_column": target, "metrics": found,
                          "shap": impacts}
        write_report(spark, reports[label], f"{folder}/{label}_test_metrics.json")
    if failed:
        raise EvaluationError(failed, reports) from next(iter(failed.values()))
    if not reports:
        raise FileNotFoundError(f"no stored model at any of {[models.get(label) for label in wanted]}")
    return reports


def run_all(spark: SparkSession, source: str, folder: str, *, target: str = TARGET, trials: int = TRIALS,
            folds: int = FOLDS, seed: int = SEED, keys: Sequence[str] | None = None, repeats: int = importance.JOB_REPEATS,
            spaces: Mapping[str, Sequence[Param]] | None = None, importance_params: Mapping[str, Any] | None = None,
            guard: bool = True, resume: bool = False) -> dict[str, dict]:
    """Clean, prepare, search, importance, train, baseline search, baseline fit, evaluate.

    Each finished stage is noted in the folder. With ``resume`` a run that was cut off goes on after the stages noted for the same
    source and settings, and a search after its last finished trial.
    """
    data, results = f"{folder}/data", f"{folder}/results"
    splits = f"{data}/dataset_splits_encoded.parquet"
    kinds = (trees.BOOSTED, trees.FOREST)
    stored = {k: f"{results}/models/{k}" for k in (*kinds, "ridge")}
    ridge_params = f"{results}/best_ridge_params.json"
    settings = [source, size_of(spark, source), target, trials, folds, seed, keys, repeats, spaces, importance_params, guard]
    stages = {
        "clean": lambda: run_clean(spark, source, data),
        "prepare": lambda: run_prepare(
            spark, f"{data}/dataset_cleaned_final.parquet", splits, text=f"{data}/dataset_splits_encoded.csv",
            encoders_json=f"{data}/encoders_mappings.json", encoders_csv=f"{data}/encoders_mappings.csv",
            target=target, seed=seed, keys=keys, guard=guard),
        "search": lambda: run_search(spark, splits, results, target=target, trials=trials, folds=folds, seed=seed, keys=keys,
                                     spaces=spaces, resume=resume),
        "importance": lambda: run_importance(spark, splits, f"{results}/feature_importances.json", target=target,
                                             repeats=repeats, seed=seed, keys=keys, params=importance_params),
        "train": lambda: run_train(spark, splits, {k: f"{results}/best_{k}_params.json" for k in kinds}, stored,
                                   target=target, seed=seed),
        "baseline": lambda: run_baseline(spark, splits, ridge_params, stored["ridge"], optimize=True, target=target,
                                         trials=trials, folds=folds, seed=seed, keys=keys),
        "baseline_fit": lambda: run_baseline(spark, splits, ridge_params, stored["ridge"], train=True, target=target),
    }
    mark = ""
    for name, stage in stages.items():
        mark = hashlib.md5(repr((mark, name, settings)).encode()).hexdigest()  # a changed setting redoes this stage and those after it
        note = f"{folder}/stages/{name}.json"
        if resume and exists(spark, note) and read_report(spark, note)["mark"] == mark:
            LOG.info("stage %s was finished before", name)
            continue
        stage()
        write_report(spark, {"mark": mark}, f"{note}.new")
        rename(spark, f"{note}.new", note)  # there is no half a note
    return run_evaluate(spark, splits, stored, f"{results}/eval", target=target, skip_missing=False)
