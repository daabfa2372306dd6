"""trialscope: clinical-trial registry reports as Spark DataFrame jobs.

Inputs are four DataFrames (studies, sponsors, interventions, conditions);
every report is a lazy DataFrame built from built-in Spark SQL functions.
"""

from . import config, schemas  # noqa: F401
from .operators import *  # noqa: F401,F403
from .plans.reports import TrialReports  # noqa: F401

__version__ = "0.1.0"
