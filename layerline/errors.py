"""Error hierarchy; operators raise on the driver only, after looking at the offending rows."""


class EngineError(Exception):
    """Base class of every error this package raises."""


class FetchError(EngineError):
    """A source could not be acquired."""


class SourceChangedError(FetchError):
    """What was acquired does not have the expected shape."""


class IdMappingError(EngineError, ValueError):
    """An identifier cannot be mapped to canonical form."""


class OscalVersionError(EngineError):
    """The baseline document is newer than what the importer supports."""


class BaselineImportError(EngineError):
    """The baseline document is unusable."""


class OverlayParseError(EngineError):
    """An overlay page is unusable."""


class ProfileJoinError(EngineError):
    """The profile table is unusable or names unknown records."""


class SpreadsheetImportError(EngineError):
    """A profile workbook is unusable or disagrees with the profile table."""


class ReconciliationError(EngineError):
    """Strict reconciliation met an unresolved record or a doubled mapping."""


class ValidationFailed(EngineError):
    """Strict validation found errors."""
