"""sitegauge: Spark DataFrame operators and batch jobs for price-history
tracking and periodic site scorecards.

Every operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``); jobs take the run date as a parameter and never read the
clock.
"""

__version__ = "0.1.0"
