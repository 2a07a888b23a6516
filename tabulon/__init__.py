"""tabulon: analytics operators written as Spark DataFrame plans.

Every operator takes DataFrames plus column names and returns a DataFrame,
so Catalyst sees one plan end to end (pushdown, pruning, codegen, AQE).

Sub-packages
- ``sources``   readers and parsers for line, CSV, XML and GeoJSON inputs; sinks
- ``functions`` column-expression helpers (time, geometry, hashing RNG, vectors)
- ``operators`` relational operators: cleaning, joins, aggregates, windows,
                 text model, graph, model evaluation, risk
- ``plans``     stand-in fixtures over the driver tables and the query catalog
- ``streaming`` the same stateless cleaning applied to a stream source
"""

from tabulon.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
