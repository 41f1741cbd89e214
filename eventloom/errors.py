"""Errors that name what is missing."""


class MissingColumns(ValueError):
    """Requested columns that a table lacks."""

    def __init__(self, missing, available):
        self.missing, self.available = list(missing), list(available)
        super().__init__(f"missing columns {self.missing}; available are {self.available}")


class SpecError(ValueError):
    """A table or pipeline description that cannot be used."""


class ConcurrentLoad(RuntimeError):
    """Two loads that extend the same table at the same time."""
