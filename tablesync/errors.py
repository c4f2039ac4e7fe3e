"""Errors raised by the library."""

from collections.abc import Iterator
from contextlib import contextmanager


class SyncError(Exception):
    """Base of every error raised here."""


class ConfigError(SyncError):
    """A spec, option or query text that cannot work."""


class ExtractError(SyncError):
    """Reading a source failed."""


class TransformError(SyncError):
    """A user transform failed."""


class LoadError(SyncError):
    """Writing a target failed."""


class DuplicateKeyError(LoadError):
    """A batch holds the same write key more than once."""


class ConcurrentWriteError(LoadError):
    """Another writer changed the same part of a target meanwhile."""


@contextmanager
def raised_as(kind: type[SyncError], message: str) -> Iterator[None]:
    """Any other error inside becomes one of ``kind``, which names the step."""
    try:
        yield
    except SyncError:
        raise
    except Exception as problem:
        raise kind(f"{message}: {problem}") from problem
