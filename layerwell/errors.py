"""Exceptions raised by the library."""


class ConfigError(ValueError):
    """The configuration names something unknown or contradicts itself."""


class DataQualityError(ValueError):
    """A critical data-quality check failed."""


class WriteConflict(DataQualityError):
    """Another run has changed the table in the meantime."""


class MissingInputError(ValueError):
    """A table that a builder needs was not supplied or does not exist."""
