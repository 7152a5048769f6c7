"""starmart: a Spark-native retail star schema, marts and customer analytics.

Every public function is a DataFrame transformation: it takes DataFrames
(plus a :class:`~starmart.params.Params`) and returns a DataFrame whose plan
Catalyst optimizes and Spark executes on the cluster.
"""

from starmart.params import FIXTURE_PARAMS, Params
from starmart.session import get_session

__all__ = ["Params", "FIXTURE_PARAMS", "get_session"]
