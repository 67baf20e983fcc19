"""Spark-native curation of large sequence repertoires.

Every public function takes and returns DataFrames; nothing that grows with
the data is collected to the driver.
"""

__version__ = "0.1.0"
