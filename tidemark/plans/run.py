"""One scheduled run: dictionaries, observations, weather, staging, model, and optionally a backup."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from tidemark.plans.mirror import ingest_observations, ingest_weather, refresh_dictionaries
from tidemark.plans.model import build_model
from tidemark.plans.stage import stage
from tidemark.session import owned
from tidemark.sources import staging
from tidemark.sources.oplog import BACKUP_CREATED, MIRROR_LOADED, RunLog
from tidemark.sources.snapshot import backed_up, snapshot
from tidemark.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Settings:
    """Where a run reads and writes, and its choices."""

    landing: str
    staging: str
    log: str
    locale: str
    dictionaries: str = "replace"
    weather_conflict: str = "ignore"
    weather_failure: str = "skip"
    hotspot_join: str = "left"
    family_side: bool = False
    drop_incomplete: bool = False
    staging_format: str = "parquet"
    backup: str | None = None
    multi_line: bool = True
    missing_views: str = "error"
    #: Feeds land in ``day=`` folders.
    by_day: bool = False
    location_stamp: str = "event"
    allowed_lateness: timedelta = timedelta(0)
    #: ``"event"`` or ``"arrival"``: what staging counts as new.
    staged_by: str = "event"
    #: Folder of the common-name dictionaries, if they are to be loaded.
    comnames: str | None = None


def run_once(spark: SparkSession, warehouse: Warehouse, settings: Settings, run_id: str, run_ts: datetime) -> None:
    """Take in everything new, in the order the steps depend on each other.

    A step that was already published under this ``run_id`` is not repeated, so a run that failed half way
    may be started again under the same id. Weather is asked for before this run's observations reach the
    model, so a new observation gets its weather in a later run. Intermediate results belong to the run and are
    removed when it ends, or when it begins again after its driver died.
    """
    with RunLog(spark, settings.log, run_id) as log, owned(spark, f"{warehouse.root} {run_id}"):

        def due(step: str) -> bool:
            return not warehouse.published(f"{run_id}/{step}")

        shared = {"log": log, "multi_line": settings.multi_line}
        if due("dictionaries"):
            refresh_dictionaries(
                spark, settings.landing, warehouse, f"{run_id}/dictionaries", settings.dictionaries,
                comnames=settings.comnames, **shared,
            )
        if due("observations"):
            ingest_observations(
                spark, settings.landing, warehouse, f"{run_id}/observations", run_ts,
                location_stamp=settings.location_stamp, by_day=settings.by_day, missing_views=settings.missing_views,
                allowed_lateness=settings.allowed_lateness, **shared,
            )
        if due("weather"):
            ingest_weather(
                spark,
                settings.landing,
                warehouse,
                f"{run_id}/weather",
                run_ts,
                settings.weather_conflict,
                settings.weather_failure,
                by_day=settings.by_day,
                **shared,
            )
        log.event(MIRROR_LOADED)
        if due("model"):
            path = f"{settings.staging}/{run_id}"
            arrived = stage(
                warehouse,
                path,
                settings.locale,
                settings.staging_format,
                settings.hotspot_join,
                settings.family_side,
                settings.drop_incomplete,
                settings.allowed_lateness,
                log=log,
                staged_by=settings.staged_by,
            )
            batch = staging.read_batch(spark, path, settings.staging_format)
            build_model(warehouse, batch, f"{run_id}/model", log, arrived)
        if settings.backup is not None and not backed_up(spark, f"{settings.backup}/{run_id}"):
            snapshot(warehouse, f"{settings.backup}/{run_id}")
            log.event(BACKUP_CREATED)
