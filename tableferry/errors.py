"""Errors raised before a Spark job starts, so that bad input fails on the driver; and one of a load that stopped."""


class TransferError(ValueError):
    """Base class of every error raised by this package."""


class InvalidArgument(TransferError):
    """An option, mode or argument is not acceptable."""


class InvalidState(TransferError):
    """Something needed is missing: no query text, no data, too many bound rows."""


class TableExists(TransferError):
    """The target table is already there and the mode does not allow that."""


class NotFound(TransferError):
    """The named table or column does not exist."""


class LoadStopped(TransferError):
    """A load in groups came to a stop; ``rows`` of its first groups are committed and need not be loaded again."""

    def __init__(self, message: str, rows: int, group: int):
        super().__init__(message)
        self.rows, self.group = rows, group
