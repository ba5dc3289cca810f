"""relayplan: plan and reconcile large file transfers with Spark DataFrames.

Every operator takes and returns DataFrames; nothing is collected to the
driver. See README.md for the operator map.
"""

__version__ = "0.1.0"
