from vaultwright.plans.chain import ChainLoad, load_chain, load_chain_into
from vaultwright.plans.into import Loaded, load_into

__all__ = ["ChainLoad", "Loaded", "load_chain", "load_chain_into", "load_into"]
