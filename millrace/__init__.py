"""Declarative ETL and data-quality jobs as Spark DataFrame plans."""

from millrace.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
