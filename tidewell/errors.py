"""Errors of the engine.  Every check fails closed: it raises, or nothing is published."""


class TidewellError(Exception):
    """Base of all."""


class IndexError_(TidewellError):
    """A history index or its request is not as promised."""


class ImagesUnavailable(IndexError_):
    """The index is sound but bytes that it points to are missing or differ."""


class SchemaMismatch(TidewellError):
    """A table lacks columns, has others, or carries another format tag."""


class RuleViolation(TidewellError):
    """Validation rules returned rows; ``violations`` holds some of them."""

    def __init__(self, message: str, violations=()):
        super().__init__(message)
        self.violations = list(violations)


class ArchiveError(TidewellError):
    """An archive's bytes are not what its headers say, or are unsafe."""


class StateConflict(TidewellError):
    """Stored state belongs to another input, or another writer holds it."""
