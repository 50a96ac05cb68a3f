"""Errors of the engine."""


class EngineError(Exception):
    """Any error that the engine raises itself."""

    retryable = False


class NotFound(EngineError):
    """A query that must give a row gave none."""


class InvalidQuery(EngineError):
    """A query that cannot be planned."""


class SchemaMismatch(EngineError):
    """A frame whose columns are not those expected."""


class TypeParseError(EngineError):
    """A type string that does not follow the grammar."""


class MigrationError(EngineError):
    """A migration that cannot be read or applied."""
