"""cdcflow: change-data-capture refinement as Spark DataFrame transforms.

Every operator is an ordinary ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function, so the same code runs on batch tables and on Structured Streaming.
"""

__version__ = "0.1.0"
