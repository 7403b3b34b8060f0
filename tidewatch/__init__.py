"""Feed-quality monitoring on Spark."""

from tidewatch.contract import Contract, load_contract
from tidewatch.session import prepare

__all__ = ["Contract", "load_contract", "prepare"]
