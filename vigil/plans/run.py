"""M0: run all 21 checks - over a whole series, or over a (current,
previous) pair - as one fused plan."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, CheckConfig
from ..operators.checks import Checks
from ..operators.profile import Profile
from ..operators.score import metrics as _metrics
from ..sources.snapshots import KEY, nan_to_null, pair_series


@dataclass
class CheckRun:
    profile: Profile
    checks: Checks
    dataset_name: str = "ecommerce_sales"

    @property
    def key(self) -> str:
        return self.profile.key

    def results(self) -> DataFrame:
        """Envelope rows ``(key, check_index, check, passed, details)``."""
        return self.checks.envelope()

    def metrics(self, timestamp: _dt.datetime | None = None) -> DataFrame:
        return _metrics(self.checks, self.dataset_name, timestamp)

    def close(self) -> None:
        """Release the cached tables; frames made before still work."""
        self.profile.unpersist()
        self.checks.forget()

    def __enter__(self) -> CheckRun:
        return self

    def __exit__(self, *_exc) -> None:
        self.close()


def run_series(series: DataFrame, config: CheckConfig = DEFAULT, key: str = KEY,
               as_of: _dt.date | None = None, dataset_name: str = "ecommerce_sales",
               schemas: DataFrame | None = None, stored=None, keep: bool = False) -> CheckRun:
    """All checks for every snapshot of ``series``, each against its
    predecessor (the first snapshot has none). With ``schemas`` the type,
    column and schema-change checks judge every snapshot by its own columns;
    without it all snapshots have the schema of the series. ``stored``: the
    profile of earlier snapshots whose data need not be there any more. With
    ``keep`` a source that is slow to read (text) is read once and its rows
    stay on the executors' disks until the run is closed."""
    prof = Profile(nan_to_null(series, keep=(key,)), config, key=key, as_of=as_of, schemas=schemas, stored=stored, keep=keep)
    return CheckRun(prof, Checks(prof), dataset_name)


def run_all_checks(current: DataFrame, previous: DataFrame | None = None,
                   config: CheckConfig = DEFAULT, as_of: _dt.date | None = None,
                   dataset_name: str = "ecommerce_sales", key: str = "_snap") -> CheckRun:
    """Pair form: ``current`` against ``previous`` (may be None). The result
    frames hold only the current snapshot (key 1)."""
    current = nan_to_null(current)
    previous = None if previous is None else nan_to_null(previous)
    series, cur_key = pair_series(current, previous, key)
    prof = Profile(series, config, key=key, as_of=as_of,
                   prev_schema=None if previous is None else previous.schema,
                   keys=[cur_key] if previous is None else [0, 1])
    run = CheckRun(prof, Checks(prof), dataset_name)
    run.current_key = cur_key
    return run


def current_only(df: DataFrame, key: str = "_snap", cur_key=1) -> DataFrame:
    return df.filter(F.col(key) == cur_key).drop(key)
