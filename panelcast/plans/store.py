"""One stored feature table for training, scoring and reports.

It has every feature, target and actual of every panel row, incomplete rows included, so the panel is
read and its window runs once; training and scoring are filters and column choices on it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from panelcast.catalogue import Catalogue, source_fingerprint
from panelcast.operators.features import ACTUAL_AMOUNT, ACTUAL_VALUE, build_features
from panelcast.sources.writers import write_features
from panelcast.spec import PanelSpec


def feature_store(
    catalogue: Catalogue, panel: DataFrame, spec: PanelSpec, chunk_days: int | None = None
) -> DataFrame:
    """The stored table of `panel`, found in the catalogue or built. Rows without entity or
    day are not in it."""
    made_of = json.dumps({"panel": source_fingerprint(panel), "spec": spec.to_json()}, sort_keys=True)

    def build() -> DataFrame:
        return build_features(panel, spec, drop_incomplete=False, actuals=True, chunk_days=chunk_days)

    return catalogue.table("features", made_of, build, lambda df, path: write_features(df, path, spec))


def training_rows(store: DataFrame, spec: PanelSpec) -> DataFrame:
    """Complete rows with targets: the feature table."""
    return store.drop(ACTUAL_VALUE, ACTUAL_AMOUNT).na.drop("any")


def scoring_rows(store: DataFrame, spec: PanelSpec) -> DataFrame:
    """All rows with features and actuals, without targets."""
    return store.drop(*[t.alias for t in spec.targets])


def panel_rows(store: DataFrame, spec: PanelSpec) -> DataFrame:
    """The panel itself."""
    return store.select(*spec.key, *spec.measures)
