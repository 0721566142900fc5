"""Composed layer jobs: bronze load, silver load, gold marts."""

from strata.plans.bronze import bronze_append, bronze_load, conform_bronze
from strata.plans.config import ObjectConfig, active_objects, silver_job
from strata.plans.marts import dim_appointment, fact_sales, fact_sales_delta
from strata.plans.silver import conform_silver, silver_batch, silver_load

__all__ = ["bronze_append", "bronze_load", "conform_bronze", "dim_appointment", "fact_sales",
           "fact_sales_delta", "conform_silver", "silver_batch", "silver_load", "ObjectConfig", "active_objects",
           "silver_job"]
