"""Lazily built, shared DataFrames for one (session, data folder).

A property builds a logical plan, except ``policy_table``, ``ml_table``, ``product_table``, the decisions and what is derived from
ranks: these are written to the shared folder when they are first used, and that runs jobs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from provisio.operators import features as fe
from provisio.operators import cycle as cy
from provisio.operators import ingest, policy
from provisio.session import materialize
from provisio.sources import adapter
from provisio.sources.tables import scan, task_count


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def line_tasks(self) -> int:
        """Tasks for order lines sent to a key; the count reads the files' footers."""
        return task_count(scan(self.spark, self.sf_dir, "lineitem").count())

    @cached_property
    def raw_orders(self) -> DataFrame:
        return adapter.raw_orders(self.spark, self.sf_dir, self.line_tasks)

    @cached_property
    def orders(self) -> DataFrame:
        return ingest.standardize_orders(self.raw_orders)

    @cached_property
    def lines(self) -> DataFrame:
        return fe.order_lines(self.orders)

    @cached_property
    def product_lines(self) -> DataFrame:
        """The order lines, each in the task of its product, for windows and aggregates by product."""
        return fe.order_lines(ingest.standardize_orders(adapter.raw_orders(self.spark, self.sf_dir, self.line_tasks, by_product=True)))

    @cached_property
    def raw_inventory(self) -> DataFrame:
        return adapter.raw_inventory(self.spark, self.sf_dir, self.line_tasks)

    @cached_property
    def inventory(self) -> DataFrame:
        return ingest.standardize_inventory(self.raw_inventory)

    @cached_property
    def fulfillment(self) -> DataFrame:
        return adapter.fulfillment(self.spark, self.sf_dir)

    @cached_property
    def features(self) -> DataFrame:
        return fe.procurement_features(self.product_lines, self.inventory, self.fulfillment)

    @cached_property
    def policy(self) -> DataFrame:
        return policy.procurement_policy(self.features)

    @cached_property
    def policy_table(self) -> DataFrame:
        """The product table materialized once in the shared checkpoint folder.

        Exploration queries read it many times (scalar subqueries, unions);
        cutting the lineage keeps each of them from re-running the two
        fact-sized shuffles and keeps the plans small."""
        return materialize(self.policy, "procurement_policy")

    @cached_property
    def products(self) -> DataFrame:
        return adapter.products(self.spark, self.sf_dir, self.inventory)

    @cached_property
    def product_table(self) -> DataFrame:
        """The product master materialized once: decisions, alerts and reports of one cycle read it, each of which would send
        the order lines to their months again."""
        return materialize(self.products, "product_master")

    @cached_property
    def supplier_pairs(self) -> DataFrame:
        return adapter.product_suppliers(self.spark, self.sf_dir, self.line_tasks)

    @cached_property
    def suppliers(self) -> DataFrame:
        return adapter.suppliers(self.spark, self.sf_dir, self.lines)

    @cached_property
    def scored(self) -> DataFrame:
        return adapter.model_scores(self.policy_table)

    @cached_property
    def scored_suppliers(self) -> DataFrame:
        return cy.supplier_score(self.suppliers)

    @cached_property
    def ranked_suppliers(self) -> DataFrame:
        return cy.supplier_ranking(self.scored_suppliers)

    @cached_property
    def decisions(self) -> DataFrame:
        """The immediate decisions materialized once: orders, negotiations, alerts, the schedule and appends read them several times."""
        return materialize(cy.procurement_decisions(self.product_table, self.scored, self.ranked_suppliers, pairs=self.supplier_pairs), "decisions")

    @cached_property
    def scheduled(self) -> DataFrame:
        return materialize(cy.scheduled_decisions(self.product_table, self.scored, self.ranked_suppliers, self.decisions,
                                                  pairs=self.supplier_pairs), "scheduled")

    @cached_property
    def orders_out(self) -> DataFrame:
        return cy.procurement_orders(self.decisions)

    @cached_property
    def candidates(self) -> DataFrame:
        return cy.negotiation_candidates(self.orders_out)

    @cached_property
    def negotiations(self) -> DataFrame:
        return cy.apply_negotiations(self.candidates, adapter.supplier_offers(self.candidates))

    @cached_property
    def alerts(self) -> DataFrame:
        return cy.alerts(self.product_table, self.decisions)

    @cached_property
    def ml_table(self) -> DataFrame:
        """Cleaned ML feature table, materialized once: every model fit runs many
        small jobs over it, which then scan a small table instead of re-running
        the encoding joins."""
        from provisio.operators import prep
        return materialize(prep.ml_features_raw(self.policy_table), "ml_features")
