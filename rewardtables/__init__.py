"""Spark tables for the data work around answer-format and band-prediction models.

Every public function takes and returns a ``DataFrame`` or a ``Column``; there
is no global session and nothing runs until the caller asks for rows, except
where a function's docstring says otherwise.
"""

__version__ = "0.1.0"
