"""Errors raised by the batch jobs."""


class ContractError(RuntimeError):
    """A schema, namespace, table or column set differs from its contract."""


class SourceError(RuntimeError):
    """Source files are missing, unexpected, altered or malformed."""


class BatchError(RuntimeError):
    """At least one requested business date did not complete.

    ``summary`` holds the per-date summary rows, good dates included.
    """

    def __init__(self, message, summary=()):
        super().__init__(message)
        self.summary = list(summary)
