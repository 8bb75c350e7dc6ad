"""Errors raised before any row is written or published."""


class ContractError(ValueError):
    """A frame does not satisfy its table contract."""


class MissingColumnsError(ContractError):
    """Required columns are absent from the source; all of them are named."""
