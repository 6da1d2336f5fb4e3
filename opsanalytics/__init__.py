"""opsanalytics: operational-analytics operators as Spark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function.  Nothing is collected to the driver except one-row results that the
caller explicitly asks for (gate status, a p-value row).

Layout
------
functions/   Column -> Column helpers (null rules, parsing, labels, p-values)
sources/     readers and writers (CSV as strings, JSON payloads, HTML tables)
operators/   table operators (cleaning, quality gate, joins, summaries,
             series windows, reconciliation, statistics, planning, ML)
plans/       end-to-end jobs and the driver-table query catalogue
streaming/   incremental refresh of the batch job over newly landed files
"""

from opsanalytics.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
