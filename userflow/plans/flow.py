"""End-to-end runs: train (features -> split -> rebalance -> fit -> save ->
report) and load-and-score, as library calls and as a spark-submit script.

    spark-submit userflow/plans/flow.py train --log s3://.../events --format json \
        --cutoff-ms 1543190400000 --look-back 21 --look-ahead 2 --extra 6 --interval 1 \
        --label churn --classifier gbt --model-out <path>
    spark-submit userflow/plans/flow.py score --log ... --model <path> --out <path> [--label churn] [--cutoff-ms ...]
"""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml import PipelineModel

from userflow.operators.evaluate import metrics
from userflow.operators.sampling import rebalance, split_by_key
from userflow.operators.windows import CutoffPlan, plan_offsets
from userflow.plans import modeling
from userflow.plans.transformer import WindowedFeatures
from userflow.session import SESSION_CONF, materialize, release
from userflow.sources.schema import LOG_PAGES, PAGE_CODES


@dataclass
class RunSettings:
    plan: CutoffPlan
    pages: dict[str, str] = field(default_factory=lambda: dict(LOG_PAGES))
    label: str = "churn"
    split_ratio: float = 0.7
    split_seed: int = 2710
    rebalance_seed: int = 2710
    kind: str = "gbt"
    params: dict = field(default_factory=dict)
    ties: str = "one"

    def feature_stage(self) -> WindowedFeatures:
        p = self.plan
        return WindowedFeatures(
            cutoffMs=p.cutoff_ms, lookBackDays=p.look_back_days, lookAheadDays=p.look_ahead_days,
            extraOffsets=p.n_extra, intervalDays=p.interval_days, ties=self.ties,
            pageNames=[self.pages[code] for code, _ in PAGE_CODES],
        )


def planned(log: DataFrame, look_back: int, look_ahead: int, interval: int, cutoff_ms: int | None = None,
            extra: int | None = None) -> CutoffPlan:
    """The cutoff plan of a log: what is not given comes from its history
    (the last cutoff with a whole look-ahead, and as many earlier ones as fit)."""
    if cutoff_ms is None or extra is None:
        found = plan_offsets(log, look_back, look_ahead, interval).head()
        if found is None or found["cutoff_ms"] is None:
            raise ValueError("an empty log has no cutoff")
        cutoff_ms = found["cutoff_ms"] if cutoff_ms is None else cutoff_ms
        extra = max(0, found["n_extra"]) if extra is None else extra
    return CutoffPlan(int(cutoff_ms), look_back, look_ahead, int(extra), interval)


def train(spark: SparkSession, log: DataFrame, s: RunSettings, model_path: str | None = None):
    """Fit on the rebalanced training users; returns (saved model path, report).
    The report carries the run's parameters and the fit time in seconds.

    The feature table is written once to the shared checkpoint folder (it is
    read by the split, the class counts, the fit and three evaluations).
    The saved model starts with the feature stage, so it scores raw logs.
    """
    stage = s.feature_stage()
    table = materialize(stage.transform(log))
    train_set, test_set = split_by_key(table, s.split_ratio, s.split_seed, key="user")
    balanced = materialize(rebalance(train_set, s.label, s.rebalance_seed, key="userId"))
    start = time.time()
    fitted = modeling.build_pipeline(s.label, s.kind, **s.params).fit(balanced)
    fit_s = round(time.time() - start, 3)
    path = modeling.save_model(spark, modeling.scoring_model(stage, fitted), model_path)
    report = modeling.evaluate_sets(fitted, {"test": test_set, "train": train_set, "rebalanced": balanced}, s.label)
    p = s.plan
    run = {"classifier": s.kind, "label": s.label, "cutoff_ms": p.cutoff_ms, "look_back_days": p.look_back_days,
           "look_ahead_days": p.look_ahead_days, "extra_offsets": p.n_extra, "interval_days": p.interval_days,
           "fit_seconds": fit_s}
    return path, report.select(*[F.lit(v).alias(k) for k, v in run.items()], "*")


def score(model_path: str, log: DataFrame, label: str | None = None, cutoff_ms: int | None = None) -> DataFrame:
    """Score a raw log with a saved model; with ``label`` the confusion metrics
    instead of the rows."""
    scored = modeling.score_log(model_path, log, cutoff_ms)
    return metrics(scored, label) if label else scored


def score_rows(model_path: str, log: DataFrame, out: str, cutoff_ms: int | None = None) -> None:
    """Write (userId, base_user, offset_idx, cutoff_ms, prediction) of a raw log as parquet."""
    scored = modeling.score_log(model_path, log, cutoff_ms)
    scored.select("userId", "base_user", "offset_idx", "cutoff_ms", "prediction").write.parquet(out)


def _main(argv=None) -> None:
    from userflow.sources.events import load_activity

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("mode", choices=["train", "score"])
    ap.add_argument("--log", required=True)
    ap.add_argument("--format", default="json")
    ap.add_argument("--cutoff-ms", type=int)
    ap.add_argument("--look-back", type=int, default=21)
    ap.add_argument("--look-ahead", type=int, default=2)
    ap.add_argument("--extra", type=int)
    ap.add_argument("--interval", type=int, default=1)
    ap.add_argument("--label", help="train: default churn; score: report metrics against it")
    ap.add_argument("--classifier", choices=modeling.KINDS, default="gbt")
    ap.add_argument("--split-ratio", type=float, default=0.7)
    ap.add_argument("--out", help="score: write the scored rows there as parquet")
    ap.add_argument("--exclude-user", action="append", default=[])
    ap.add_argument("--model")
    ap.add_argument("--model-out")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"userflow-{a.mode}").getOrCreate()
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    log = load_activity(spark, a.log, a.format)
    if a.exclude_user:
        from userflow.operators.clean import exclude_users

        log = exclude_users(log, a.exclude_user)
    if a.mode == "train":
        plan = planned(log, a.look_back, a.look_ahead, a.interval, a.cutoff_ms, a.extra)
        settings = RunSettings(plan=plan, label=a.label or "churn", kind=a.classifier, split_ratio=a.split_ratio)
        path, report = train(spark, log, settings, a.model_out)
        print(path)
        report.show(truncate=False)
        if a.classifier in ("gbt", "rf", "dt"):
            modeling.importances(spark, PipelineModel.load(path)).show(30, truncate=False)
        release(spark)
        return
    if a.out:  # at a fresh cutoff there are no labels yet: the rows are the result
        score_rows(a.model, log, a.out, a.cutoff_ms)
    if a.label:
        score(a.model, log, a.label, a.cutoff_ms).show(truncate=False)
    if not a.out and not a.label:
        ap.error("score needs --out, --label or both")


if __name__ == "__main__":
    _main()
