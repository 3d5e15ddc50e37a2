"""Spark library for a multi-market KPI warehouse.

Every operator takes and returns DataFrames, reads no clock (``as_of`` and ``run_ts`` are
arguments) and runs no action; only the job functions in ``kpiweave.plans.jobs`` and the
stream in ``kpiweave.streaming`` write.
"""
