"""Feature preparation: clean -> impute -> engineer -> recode -> encode ->
request profile -> join -> fill -> scale.

``fit_prepare`` learns the state on training rows and returns it as small
DataFrames; ``apply_prepare`` reuses that state on test or scoring rows.
Building a plan runs small jobs: one value per imputed variable and two per
feature are read and become literals; the label mapping is joined. The
client table is never collected.

Defaults follow the production semantics (left join + fill 0, no one-hot
request counts); ``join_how="inner"`` and ``with_pivot_counts=True`` give
the local tracked pipeline (87 features).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from retenta.functions.features import engineer
from retenta.functions.scalar import empty_to_null
from retenta.functions.schema import EMPTY_AS_NULL_CLIENT, EMPTY_AS_NULL_REQUEST, ID
from retenta.operators.encoding import apply_label_encoder, fit_label_encoder, recode, string_columns
from retenta.operators.imputation import (CLIENT_IMPUTATION, REQUEST_IMPUTATION, apply_imputation, fit_imputation,
                                         imputation_values)
from retenta.operators.requests import categories_dict, learn_categories, request_profile
from retenta.operators.scaling import NOT_SCALED, apply_standardizer, feature_columns, fit_standardizer
from retenta.session import materialize


@dataclass
class PreparedState:
    imputation: DataFrame          # dataframe, variable, strategy, value
    encoder: DataFrame             # column, label, code
    categories: DataFrame | None   # column, value (one-hot vocabularies)
    moments: DataFrame             # feature, mean, std
    features: list[str]            # model input order
    join_how: str = "left"

    def feature_table(self, spark) -> DataFrame:
        return spark.createDataFrame([(i, f) for i, f in enumerate(self.features)], "pos int, name string")

    def tables(self, spark) -> dict[str, DataFrame]:
        """Everything that scoring needs, as tables; ``from_tables`` reads it back."""
        settings = spark.createDataFrame([("join_how", self.join_how), ("one_hot", str(self.categories is not None))],
                                         "name string, value string")
        none = spark.createDataFrame([], "column string, value string")
        return {"imputation": self.imputation, "encoding": self.encoder, "moments": self.moments,
                "features": self.feature_table(spark), "settings": settings,
                "categories": none if self.categories is None else self.categories}

    @staticmethod
    def from_tables(tables: dict[str, DataFrame]) -> PreparedState:
        settings = {r["name"]: r["value"] for r in tables["settings"].collect()}
        features = [r["name"] for r in tables["features"].orderBy("pos").collect()]
        return PreparedState(tables["imputation"], tables["encoding"],
                             tables["categories"] if settings["one_hot"] == "True" else None,
                             tables["moments"], features, settings["join_how"])


STATE_TABLES = ("imputation", "encoding", "moments", "features", "settings", "categories")


def clean_clients(df: DataFrame) -> DataFrame:
    return df.select(*[empty_to_null(c).alias(c) if c in EMPTY_AS_NULL_CLIENT else F.col(c) for c in df.columns])


def clean_requests(df: DataFrame) -> DataFrame:
    return df.select(*[empty_to_null(c).alias(c) if c in EMPTY_AS_NULL_REQUEST else F.col(c) for c in df.columns])


def _impute(clients: DataFrame, reqs: DataFrame, params: DataFrame) -> tuple[DataFrame, DataFrame]:
    c = apply_imputation(clients, imputation_values(params, "clientes", [v for v, _ in CLIENT_IMPUTATION]))
    r = apply_imputation(reqs, imputation_values(params, "requerimientos", [v for v, _ in REQUEST_IMPUTATION]))
    return c, r


def _join(clients: DataFrame, profile: DataFrame, how: str) -> DataFrame:
    joined = clients.join(profile, ID, how)
    if how == "left":
        # unmatched clients: no requests means zero counts; null lags and
        # features become 0 as well (production semantics)
        joined = joined.na.fill(0)
    return joined


def _unscaled(clients: DataFrame, reqs: DataFrame, encoder: DataFrame, categories: DataFrame | None,
              join_how: str, on_unseen: str) -> DataFrame:
    """From imputed requests and imputed, engineered and recoded clients."""
    coded = apply_label_encoder(clients, encoder, string_columns(clients), on_unseen=on_unseen)
    names = categories_dict(categories) if categories is not None else None
    return _join(coded, request_profile(reqs, categories=names), join_how)


def fit_prepare(clients: DataFrame, reqs: DataFrame, join_how: str = "left",
                with_pivot_counts: bool = False) -> tuple[DataFrame, PreparedState]:
    """Fit on training rows. The cleaned, imputed and engineered clients are
    written once; encoder and matrix read them. The unscaled matrix is
    written once too; moments and scaling read that. Fitted tables are
    written, so every later use reads a few rows."""
    clients, reqs = clean_clients(clients), clean_requests(reqs)
    params = materialize(fit_imputation(clients, reqs), "state-imputation")
    c, r = _impute(clients, reqs, params)
    c = materialize(recode(engineer(c)), "train-clients")
    categories = materialize(learn_categories(r), "state-categories") if with_pivot_counts else None
    encoder = materialize(fit_label_encoder(c, string_columns(c)), "state-encoding")
    joined = materialize(_unscaled(c, r, encoder, categories, join_how, "error"), "train-unscaled")
    features = feature_columns(joined.columns)
    moments = materialize(fit_standardizer(joined, features), "state-moments")
    return (apply_standardizer(joined, moments, features),
            PreparedState(params, encoder, categories, moments, features, join_how))


def apply_prepare(clients: DataFrame, reqs: DataFrame, state: PreparedState,
                  on_unseen: str = "error") -> DataFrame:
    """``on_unseen``: what a label not seen at fit time does (see ``apply_label_encoder``)."""
    c, r = _impute(clean_clients(clients), clean_requests(reqs), state.imputation)
    joined = _unscaled(recode(engineer(c)), r, state.encoder, state.categories, state.join_how, on_unseen)
    return apply_standardizer(joined, state.moments, state.features)


__all__ = ["PreparedState", "STATE_TABLES", "fit_prepare", "apply_prepare", "clean_clients",
           "clean_requests", "NOT_SCALED"]
