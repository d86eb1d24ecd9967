"""Contract-driven batch loads on Spark DataFrames."""

from .contract import Contract, ContractError, Field, parse_contract, parse_contract_text

__all__ = ["Contract", "ContractError", "Field", "parse_contract", "parse_contract_text"]
