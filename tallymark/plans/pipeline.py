"""The audit from tables to explained cases, each shared stage stored once.

A stage that several results read (features, report, scores, risk) is written
to the shared checkpoint folder on first use and read back afterwards, so no
result recomputes another one's joins and nothing depends on executor memory.
What follows from a stored row alone (scaled features, the explanation) is added when read, and
columns of the tables that no later stage reads are not carried along.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, AuditConfig
from tallymark.functions.ordering import pin, remove_stored
from tallymark.operators import autoencoder, ensemble, explain, isolation, quality
from tallymark.operators import features as feat
from tallymark.operators import near_duplicates as nd
from tallymark.operators import risk as rk
from tallymark.operators import rules
from tallymark.plans.shipping import ship_package
from tallymark.sources import erp_views
from tallymark.sources.erp_views import stored_tables
from tallymark.sources.schemas import ErpTables


class Audit:
    def __init__(self, spark: SparkSession, tables: ErpTables, cfg: AuditConfig = DEFAULT):
        self.spark, self.tables, self.cfg = spark, tables, cfg
        ship_package(spark)

    # tables by short name
    @property
    def inv(self) -> DataFrame:
        return self.tables.invoices

    @property
    def po(self) -> DataFrame:
        return self.tables.purchase_orders

    @property
    def ven(self) -> DataFrame:
        return self.tables.vendors

    @property
    def bud(self) -> DataFrame:
        return self.tables.budget

    # rules
    @cached_property
    def near(self) -> DataFrame:
        """Near duplicates with the number of their partners."""
        return pin(nd.near_duplicates(self.inv, self.cfg, counted=True), "near")

    @cached_property
    def report(self) -> DataFrame:
        """Deduplicated exceptions with tier."""
        return pin(
            rules.exceptions_report(self.inv, self.po, self.ven, self.bud, self.cfg, self.near), "report"
        )

    # data quality
    @cached_property
    def integrity(self) -> DataFrame:
        """Keys and constraints of all tables, checked together."""
        return pin(quality.integrity(self.tables), "integrity")

    # features
    @cached_property
    def features(self) -> DataFrame:
        inv = self.inv.select(*[c for c in self.inv.columns if c in rk.EXPORT_COLUMNS])
        return pin(feat.build_features(inv, self.ven, self.po, self.bud, self.cfg), "features")

    @cached_property
    def scaler(self) -> DataFrame:
        return pin(feat.scaler(self.features), "scaler")

    def _rated(self, scored: DataFrame, label: str) -> DataFrame:
        """Scores and tiers, stored; of the looked-up columns only the features made of them."""
        return pin(rk.rated(scored.drop(*feat.LOOKED_UP), self.report, self.cfg), label)

    # risk with a plain statistic in the place of the models
    @cached_property
    def zscore_scored(self) -> DataFrame:
        """Features with |z-score of the amount| as ensemble_score."""
        return self.features.withColumn(
            "ensemble_score", F.round(F.abs("feat_amount_zscore"), 6)
        )

    @cached_property
    def zscore_risk(self) -> DataFrame:
        return rk.add_explanation(self._rated(self.zscore_scored, "risk-z"), self.cfg)

    # models
    @cached_property
    def scaled(self) -> DataFrame:
        return feat.scale(self.features, self.scaler)

    @cached_property
    def forest_nodes(self) -> DataFrame:
        return pin(isolation.fit_forest(self.scaled, cfg=self.cfg), "forest")

    @cached_property
    def forest(self) -> isolation.Forest:
        return isolation.load_forest(self.forest_nodes, self.cfg)

    # rows the autoencoder learns from; the label serves as the clean-data filter
    train_filter = "anomaly_flag = 0"

    @cached_property
    def autoencoder(self) -> autoencoder.Fitted:
        return autoencoder.fit(self.scaled.filter(self.train_filter), cfg=self.cfg)

    @cached_property
    def scored(self) -> DataFrame:
        """Invoices with features, both model scores (stored) and what follows from them by row."""
        return ensemble.score_models(
            self.scaled, self.forest, self.autoencoder.weights, self.train_filter, self.cfg
        )

    @cached_property
    def rated(self) -> DataFrame:
        return self._rated(self.scored, "risk")

    @cached_property
    def risk(self) -> DataFrame:
        return self._explainable(self.rated)

    def _explainable(self, rated: DataFrame) -> DataFrame:
        """With the explanation by rules and models, and what contributions are computed from."""
        return feat.scale(rk.add_explanation(rated, self.cfg), self.scaler)

    # risk with the forest alone in the place of the ensemble
    @cached_property
    def forest_scored(self) -> DataFrame:
        """Features with the forest's score as ensemble_score."""
        scored = isolation.add_score(self.scaled, self.forest)
        return pin(scored.withColumn("ensemble_score", F.col("iso_score")).drop("scaled"), "scored-forest")

    @cached_property
    def forest_risk(self) -> DataFrame:
        return self._explainable(self._rated(self.forest_scored, "risk-forest"))

    @cached_property
    def forest_cases(self) -> DataFrame:
        """Critical, High and the five highest cases by `forest_risk`, explained."""
        top = explain.top_cases(self.forest_risk, 5).select("invoice_number")
        cases = explain.priority_cases(self.forest_risk).unionByName(
            explain.priority_cases(self.forest_risk, others=True).join(F.broadcast(top), "invoice_number", "left_semi")
        )
        return pin(explain.add_sentence(explain.add_contributions(cases, self.forest)), "cases-forest")

    # explanations
    @cached_property
    def explained(self) -> DataFrame:
        """Every invoice with its contributions."""
        found = explain.add_contributions(self.scaled, self.forest)
        return pin(found.select("invoice_number", "contributions", "base_value"), "explained")

    @cached_property
    def explained_cases(self) -> DataFrame:
        """Critical and High cases with contributions and a sentence."""
        cases = explain.add_contributions(explain.priority_cases(self.risk), self.forest)
        return pin(explain.add_sentence(cases), "cases")

    @cached_property
    def explained_top(self) -> DataFrame:
        """The five highest cases, whatever their tier."""
        # stored first: below a Python function a limit would sort all cases
        cases = self._explainable(pin(explain.top_cases(self.rated, 5), "top-rated"))
        return pin(explain.add_sentence(explain.add_contributions(cases, self.forest)), "top")


_audits: dict[tuple[str, str], Audit] = {}


def close_audits(spark: SparkSession) -> None:
    """End of an audit: forget this application's audits and delete their
    intermediate tables. Collect or write the results before."""
    app = spark.sparkContext.applicationId
    for known in (_audits, erp_views.stored):
        for key in [k for k in known if k[0] == app]:
            del known[key]
    remove_stored(spark)


def audit(spark: SparkSession, sf_dir: str) -> Audit:
    """The audit over the tables derived from one data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    tables = stored_tables(spark, sf_dir)
    if key not in _audits:
        _audits[key] = Audit(spark, tables)
    return _audits[key]
