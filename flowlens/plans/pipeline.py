"""End-to-end plans: captures -> training windows -> models -> bundle; capture -> scores.

Materialisation points (checkpoint in the shared folder): the merged captures (read by the
offsets and every later pass) and the packet features (read by the rank boundaries, the
counts and the window job). Everything else stays one lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from flowlens.constants import (
    DOWNSAMPLE_LABELS,
    DOWNSAMPLE_MIN_KEEP,
    STEP_SIZE,
    WINDOW_SIZE,
)
from flowlens.operators import ml
from flowlens.operators.clean import clean_packets
from flowlens.operators.label import DEFAULT_RULES, label_captures
from flowlens.operators.packet_features import packet_features
from flowlens.operators.sample import downsample
from flowlens.operators.timeline import merge_timeline
from flowlens.operators.windows import window_features
from flowlens.session import materialize


def build_training_windows(
    captures: Sequence[tuple[str, DataFrame]],
    rules=DEFAULT_RULES,
    size: int = WINDOW_SIZE,
    step: int = STEP_SIZE,
    sample_frac: float | None = None,
    min_keep: int = DOWNSAMPLE_MIN_KEEP,
    downsample_labels=DOWNSAMPLE_LABELS,
    downsample_after_iat: bool = False,
    iat_scope: str = "flow",
    length_policy: str = "zero",
    method: str = "chunks",
) -> DataFrame:
    """Raw named captures (T1) -> labelled merged timeline -> downsample -> packet features ->
    windows (T4). All packets are used unless the caller gives ``sample_frac``. ``downsample_after_iat`` thins after the per-flow IAT is computed (the
    reference thins first, which stretches IAT of thinned classes)."""
    cleaned = [(name, clean_packets(df, length_policy)) for name, df in captures]
    tl = merge_timeline(label_captures(cleaned, rules), materialize)

    def thin(df):
        if sample_frac is None:
            return df
        return downsample(df, sample_frac, min_keep=min_keep, labels=downsample_labels)

    if downsample_after_iat:
        feats = thin(materialize(packet_features(tl, iat_scope)))
    else:
        feats = packet_features(thin(tl), iat_scope)
    return materialize(window_features(materialize(feats), size, step, method=method))


def run_training(windows: DataFrame, bundle_path: str, names: Sequence[str] | None = None,
                 tune_on: str = "test") -> DataFrame:
    """Split, scale, fit, tune, evaluate, compare (M22), keep the best (M23) and save the
    bundle (S4-S5). Returns the comparison table."""
    trained = ml.train_all(windows, names, ensemble=True, tune_on=tune_on)
    spark = windows.sparkSession
    comp = ml.metrics_table(spark, trained["results"])
    from flowlens.operators.evaluate import best_model, comparison

    best = best_model(comp).first()["model"]
    ml.save_bundle(bundle_path, trained, best)
    windows.write.mode("overwrite").parquet(bundle_path.rstrip("/") + "_features")
    return comparison(comp)


def score_capture(packets: DataFrame, bundle_path: str, model_name: str | None = None, rule: str = "tuned",
                  length_policy: str = "zero", dashboard: bool = False) -> DataFrame:
    """One capture -> clean -> packet features -> windows (bundle size/step) ->
    scores. ``rule="argmax"`` and ``dashboard=True`` give the dashboard variant."""
    spark = packets.sparkSession
    bundle = ml.load_bundle(spark, bundle_path)
    meta = bundle["meta"]
    feats = materialize(packet_features(clean_packets(packets, length_policy)))
    wins = window_features(feats, meta["window_size"], meta["step_size"], dashboard=dashboard)
    return ml.score_windows(bundle, wins, model_name, rule)
