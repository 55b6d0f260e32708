"""Errors raised by the library."""


class WattlineError(Exception):
    """Base class."""


class IngestError(WattlineError):
    """A source is missing or cannot be read as declared."""


class ContractError(WattlineError):
    """A table breaks its schema contract."""


class OptionError(WattlineError, ValueError):
    """An option has a value the operator does not know."""


class TrainingError(WattlineError):
    """A model cannot be fitted or evaluated."""


class RegistryError(WattlineError):
    """The model registry or report table has no usable record."""
