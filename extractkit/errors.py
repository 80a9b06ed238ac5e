"""Exceptions raised by the toolkit; all derive from :class:`ToolkitError`."""

from __future__ import annotations


class ToolkitError(Exception):
    """Base class."""


class StatementError(ToolkitError):
    """A SQL statement is not allowed where it was given, or failed."""


class ReadOnlyError(ToolkitError):
    """A change was asked of a read-only library or a file-backed table."""


class NameConflictError(ToolkitError):
    """A managed table would hide a file-backed alias."""


class FileFormatError(ToolkitError):
    """Unknown file format, or a folder that does not exist."""


class SchemaMismatchError(ToolkitError):
    """Two sides that must share a schema do not."""


class MissingKeyError(ToolkitError):
    """Key columns are absent from the data."""


class DuplicateKeyError(ToolkitError):
    """Several source rows match one target row, or an order key is not unique."""


class RowCountError(ToolkitError):
    """The rows written are not the rows planned."""


class FingerprintError(ToolkitError):
    """Work left by another plan is in the way of a resumed run."""


class ConcurrentCommitError(ToolkitError):
    """Another writer committed the same table version first."""


class ResolutionError(ToolkitError):
    """Registry selectors do not resolve to one configuration."""


class SourceChangedError(ToolkitError):
    """A source that is read twice gave different rows."""
