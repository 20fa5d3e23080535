"""ledgerlift: bulk registry migration expressed as Spark DataFrame operators.

Messy spreadsheet-style extracts go in; cleaned, key-resolved, de-duplicated rows
are merged into a normalised set of tables under an explicit per-column policy.
Everything is declared with the DataFrame API; Catalyst and AQE choose the physical
strategy.
"""

__version__ = "0.1.0"
