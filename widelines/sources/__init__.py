"""Sources: the seven normalised tables as DataFrames.

* ``fixtures.fixture_sources`` derives them from the test tables.
* ``parquet.read_sources`` reads them from a folder of Parquet tables.
* ``jdbc.read_sources_jdbc`` reads them from the operational database in
  parallel, split on the key column.
"""

from widelines.sources.model import Sources
from widelines.sources.tables import read_raw
from widelines.sources.fixtures import fixture_sources

__all__ = ["Sources", "read_raw", "fixture_sources"]
