"""urbanlens: Spark-native text, location and listing analytics.

Every operator is a plain ``Column -> Column`` or ``DataFrame -> DataFrame``
function; nothing creates a session or reads the clock inside an operator.
"""

__version__ = "0.1.0"
