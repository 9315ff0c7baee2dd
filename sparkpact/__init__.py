"""sparkpact: data contracts as Spark DataFrame jobs.

Contract documents are rows of a table, and contracts are enforced on the rows
of other tables. Every operator takes DataFrames and returns DataFrames.
"""

from sparkpact.model import Column, Contract, Metadata
from sparkpact.session import configure, scratch_dir

__all__ = ["Column", "Contract", "Metadata", "configure", "scratch_dir"]
