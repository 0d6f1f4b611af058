"""kpiframe: period-over-period KPI reporting as Spark DataFrame plans.

Builders take DataFrames and a :class:`~kpiframe.functions.period.Period` and
return lazy DataFrames; nothing in the library calls ``collect``.
"""

from kpiframe.functions.period import Period
from kpiframe.labels import Labels

__all__ = ["Period", "Labels"]
