class SyncError(Exception):
    """Base of the errors raised while a plan is built or run."""


class ConfigError(SyncError):
    """The configuration cannot be used."""


class DataShapeError(SyncError):
    """The data does not have the shape an operator needs."""


class UnknownFormatError(SyncError):
    """A sitemap is in none of the supported formats."""


class WriteFailedError(SyncError):
    """Not a single row of a write was accepted."""
