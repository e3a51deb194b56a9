"""slaflow: SLA, data-quality and process analytics on Spark.

Public entry points (imported lazily so that ``import slaflow`` needs no
Spark session):

* validation - ``annotate``, ``issue_table``, ``row_totals``, ``validation_report``,
  ``expectation_gate``
* layers and jobs - ``MedallionLayers``, ``write_medallion``, ``run_medallion``,
  ``write_analytics``, ``run_analytics``, ``write_process_intelligence``,
  ``validate_file``, ``write_report``, ``published_medallion``
* sources - ``bronze_from_csv``, ``bronze_requests``
* contract - ``load_contract``, ``default_contract``
"""

from __future__ import annotations

import importlib

_EXPORTS = {
    "annotate": "slaflow.operators.validation",
    "issue_table": "slaflow.operators.validation",
    "row_totals": "slaflow.operators.validation",
    "validation_report": "slaflow.operators.validation",
    "expectation_gate": "slaflow.operators.validation",
    "MedallionLayers": "slaflow.plans.layers",
    "write_medallion": "slaflow.plans.jobs",
    "run_medallion": "slaflow.plans.jobs",
    "run_analytics": "slaflow.plans.jobs",
    "published_medallion": "slaflow.plans.jobs",
    "write_analytics": "slaflow.plans.jobs",
    "write_process_intelligence": "slaflow.plans.jobs",
    "validate_file": "slaflow.plans.jobs",
    "write_report": "slaflow.plans.jobs",
    "bronze_from_csv": "slaflow.sources.bronze",
    "bronze_requests": "slaflow.sources.bronze",
    "load_contract": "slaflow.contract",
    "default_contract": "slaflow.contract",
}
__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'slaflow' has no attribute {name!r}")
