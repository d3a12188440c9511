"""Model registry in a shared folder (X7, W8, X16): whole bundles, resolved by
stage.

A bundle is what serving needs: the fitted Spark ML pipeline, the encoder
tables, the known devices, the stored drift reference, and one JSON text with
feature order, threshold, metrics and fingerprint. Tables stay tables; nothing
but that text and a version's name passes the driver.

``stages`` is an append-only log of one record per action. A version counts
from its ``register`` record on, which is written after its bundle: a run that
fails before leaves nothing that a reader sees, and may be run again. Which
version serves follows from the log (``decisions.current_stages``), so promotion
and rollback append a record and move no file.
"""

from __future__ import annotations

import json
import re
import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.config import STAGE_PRODUCTION, FeatureConfig
from vigil.operators.decisions import current_stages
from vigil.operators.drift import DriftProfile
from vigil.operators.features import RiskMaps
from vigil.plans.training import Bundle, with_profile
from vigil.sources.history import load_history, write_record

LOG = T.StructType([T.StructField("model", T.StringType()), T.StructField("version", T.StringType()),
                    T.StructField("action", T.StringType()), T.StructField("about", T.StringType()),
                    T.StructField("seq", T.LongType())])
NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ stage log
    def log(self) -> DataFrame:
        return load_history(self.spark, f"{self.root}/stages", LOG)

    def _append(self, model: str, version: str, action: str, about: str | None = None) -> None:
        last = self.log().agg(F.max("seq")).first()[0] or 0
        row = self.spark.createDataFrame([(model, version, action, about)], T.StructType(LOG.fields[:-1]))
        write_record(row, f"{self.root}/stages", "seq", max(time.time_ns(), last + 1))

    def _records(self, model: str, version: str) -> list:
        """Register records of one version: one, or none."""
        return self.log().where((F.col("model") == model) & (F.col("version") == version)
                                & (F.col("action") == "register")).limit(1).collect()

    def promote(self, model: str, version: str) -> None:
        """``version`` serves from now on; the one before it is archived. A
        rollback is the promotion of an older version."""
        if not self._records(model, version):
            raise LookupError(f"model {model!r} has no version {version!r}")
        self._append(model, version, "promote")

    rollback = promote

    def versions(self, model: str) -> DataFrame:
        """Every version with its stage and key metrics, newest first."""
        log = self.log().where(F.col("model") == model)
        about = log.where("action = 'register'").select(
            "version", "seq", *[F.get_json_object("about", f"$.metrics.{m}").cast("double").alias(m) for m in ("pr_auc", "f1")])
        return current_stages(log).join(about, "version").orderBy(F.desc("seq"))

    def current(self, model: str, stage: str = STAGE_PRODUCTION) -> str | None:
        """The latest version in a stage."""
        row = self.versions(model).where(F.col("stage") == stage).limit(1).collect()
        return row[0]["version"] if row else None

    # -------------------------------------------------------------- bundles
    def _path(self, model: str, version: str) -> str:
        for name in (model, version):
            if not NAME.fullmatch(name):
                raise ValueError(f"{name!r} cannot name a model or a version")
        return f"{self.root}/bundles/model={model}/version={version}"

    def register(self, model: str, version: str, bundle: Bundle) -> str:
        """Writes a bundle and registers it (stage: Staging). A registered
        version is never written again."""
        path = self._path(model, version)
        if self._records(model, version):
            raise ValueError(f"model {model!r} already has a version {version!r}")
        bundle = with_profile(bundle)
        bundle.model.write().overwrite().save(f"{path}/pipeline")
        bundle.risk_maps.merchant.write.mode("overwrite").parquet(f"{path}/merchant_risk")
        bundle.risk_maps.category.write.mode("overwrite").parquet(f"{path}/category_risk")
        if bundle.known_devices is not None:
            bundle.known_devices.write.mode("overwrite").parquet(f"{path}/known_devices")
        bundle.profile.save(self.spark, f"{path}/drift_reference")
        row = bundle.metrics.first()
        about = {"kind": bundle.kind, "feature_cols": bundle.feature_cols, "threshold_info": bundle.threshold_info,
                 "metrics": row.asDict(), "metrics_schema": bundle.metrics.schema.jsonValue(),
                 "global_mean": bundle.risk_maps.global_mean, "has_devices": bundle.known_devices is not None,
                 "profile_version": bundle.profile.version, "windows_minutes": list(bundle.cfg.windows_minutes),
                 "smoothing": bundle.cfg.smoothing, "scope": bundle.cfg.scope, "raw_inputs": list(bundle.cfg.raw_inputs),
                 "fingerprint": bundle.info.get("fingerprint")}
        self._append(model, version, "register", json.dumps(about, default=str))
        return version

    def load(self, model: str, stage: str = STAGE_PRODUCTION, version: str | None = None) -> Bundle:
        """The bundle of a stage's current version, or of a named one."""
        version = version or self.current(model, stage)
        found = self._records(model, version) if version else []
        if not found:
            raise LookupError(f"model {model!r} has no version {version or 'in stage ' + stage!r}")
        about, path, read = json.loads(found[0]["about"]), self._path(model, version), self.spark.read.parquet
        metrics = self.spark.createDataFrame(
            [tuple(about["metrics"].values())], T.StructType.fromJson(about["metrics_schema"]))
        cfg = FeatureConfig(windows_minutes=tuple(about["windows_minutes"]), smoothing=about["smoothing"],
                            scope=about["scope"], raw_inputs=tuple(about["raw_inputs"]))
        return Bundle(
            PipelineModel.load(f"{path}/pipeline"), about["kind"], about["feature_cols"], about["threshold_info"], metrics,
            risk_maps=RiskMaps(read(f"{path}/merchant_risk"), read(f"{path}/category_risk"), about["global_mean"]),
            known_devices=read(f"{path}/known_devices") if about["has_devices"] else None, cfg=cfg,
            profile=DriftProfile.load(self.spark, f"{path}/drift_reference", about["profile_version"]),
            info={"version": version, "fingerprint": about["fingerprint"]})
