"""Errors a caller can tell apart."""


class TablescopeError(Exception):
    """Base of every error raised by this package."""


class FileValidationError(TablescopeError):
    """The path is missing or cannot be read."""


class UnsupportedFileFormatError(TablescopeError):
    """The file suffix has no reader."""


class EmptyDatasetError(TablescopeError):
    """The data set has no rows or no columns."""


class InsufficientDataError(TablescopeError):
    """An analysis lacks the columns or rows it needs."""


class UnknownMethodError(TablescopeError, ValueError):
    """A method or algorithm name is not registered."""
