"""Gaugeline: utility meter readings as Spark jobs.

``sources`` reads documents and tables and writes results, ``functions`` holds
column expressions, ``operators`` the DataFrame steps, and ``plans`` joins the
steps into the three stages translate, enrich and clean.
"""

from gaugeline.plans.stages import clean, enrich, lifecycle, translate, unparsed
from gaugeline.settings import Settings

__all__ = ["Settings", "clean", "enrich", "lifecycle", "translate", "unparsed"]
