"""Errors that users of the engine meet."""


class SiltstoneError(Exception):
    """Base of all errors of this package."""


class OptionError(SiltstoneError, ValueError):
    """An option is unknown, malformed or missing."""


class TypeMismatch(SiltstoneError, TypeError):
    """A file's type can't be read as, or written from, the declared one."""


class CatalogError(SiltstoneError, LookupError):
    """A server, table or file isn't there, or is there already."""


class ModifyError(SiltstoneError):
    """A statement that changes data can't be carried out."""


class UnsupportedOperation(SiltstoneError, NotImplementedError):
    """A clause that file tables don't support."""
