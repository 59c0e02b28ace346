"""Errors raised when a step must not go on."""


class ArchiveError(Exception):
    """Base of every error this package raises on purpose."""


class RangeError(ArchiveError):
    """Key ranges are not usable: out of order, or keys outside the archive."""


class ListingError(ArchiveError):
    """The object listing failed its coverage audit."""


class RecordError(ArchiveError):
    """Records could not be read, or none were found."""


class SceneError(ArchiveError):
    """Too many scene files could not be parsed."""


class GateError(ArchiveError):
    """One or more validation gates failed."""


class PublishError(ArchiveError):
    """What was stored differs from what passed the gates."""
