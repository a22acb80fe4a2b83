"""The one error type raised for requests that cannot be answered."""

from __future__ import annotations

from collections.abc import Iterable


class AnalysisError(ValueError):
    """An invalid request.

    ``code`` is a short stable identifier, ``available`` lists the accepted
    alternatives (column names, aggregates, periods) when there are any.
    """

    def __init__(self, code: str, message: str, available: Iterable[str] | None = None):
        super().__init__(message)
        self.code = code
        self.message = message
        self.available = list(available) if available is not None else None
