"""Directory page snapshots to clean tables, as Spark jobs."""

from pagesift.config import RunConfig, SiteConfig
from pagesift.functions.tree import value_by_label
from pagesift.plans.run import run_list, run_profiles
from pagesift.session import build_session

__all__ = ["RunConfig", "SiteConfig", "build_session", "run_list", "run_profiles", "value_by_label"]
